"""Schema registries as a Spark data source: `spark.read.format("schema_registry")`.

A client answers six calls (registries, a registry, schemas, a schema, versions, a version), page by page; which client is an
option. The reader plans one partition per registry and share of its schemas, fetches only what the projection and
the pushed filters ask for, and paces its calls so that all partitions together keep the rate. The versions of a schema
are fetched by several threads (option `threads`).
"""

from __future__ import annotations

import importlib
import json
import os
import threading
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from schemaloom.functions.naming import glob_pattern

VERSIONS = "registry_name string, name string, data_format string, compatibility string, description string, version_number bigint, schema_version_id string, definition string, status string, created_time timestamp"


class RegistryClient(Protocol):
    """What a registry must answer. Lists come in pages: (items, token of the next page or None)."""

    def list_registries(self, token: str | None) -> tuple[list[dict], str | None]: ...
    def get_registry(self, name: str) -> dict: ...
    def list_schemas(self, registry: str, token: str | None) -> tuple[list[dict], str | None]: ...
    def get_schema(self, registry: str, name: str) -> dict: ...
    def list_versions(self, registry: str, name: str, token: str | None) -> tuple[list[int], str | None]: ...
    def get_version(self, registry: str, name: str, number: int) -> dict: ...


def pages(call, *args) -> Iterator:
    """The items of all pages of a list call."""
    token = None
    while True:
        items, token = call(*args, token)
        yield from items
        if not token:
            return


class FolderClient:
    """A registry kept in files: one JSON file per registry, {name, schemas: [{name, ..., versions: [...]}]}."""

    page = 50

    def __init__(self, options: dict[str, str], credentials: dict[str, str] | None = None):
        self.path = options["path"]

    def _load(self, registry: str) -> dict:
        at = os.path.join(self.path, f"{registry}.json")
        if not os.path.exists(at):
            raise LookupError(f"registry {registry!r} does not exist")
        with open(at, encoding="utf-8") as f:
            return json.load(f)

    def _page(self, items: list, token: str | None) -> tuple[list, str | None]:
        at = int(token or 0)
        end = at + self.page
        return items[at:end], str(end) if end < len(items) else None

    def list_registries(self, token):
        return self._page([{"name": f[:-5]} for f in sorted(os.listdir(self.path)) if f.endswith(".json")], token)

    def get_registry(self, name):
        return {k: v for k, v in self._load(name).items() if k != "schemas"}

    def list_schemas(self, registry, token):
        return self._page([{"name": s["name"]} for s in self._load(registry)["schemas"]], token)

    def _schema(self, registry: str, name: str) -> dict:
        return next(s for s in self._load(registry)["schemas"] if s["name"] == name)

    def get_schema(self, registry, name):
        return {k: v for k, v in self._schema(registry, name).items() if k != "versions"}

    def list_versions(self, registry, name, token):
        return self._page([int(v["version_number"]) for v in self._schema(registry, name)["versions"]], token)

    def get_version(self, registry, name, number):
        return next(v for v in self._schema(registry, name)["versions"] if v["version_number"] == number)


class TablesClient:
    """A registry kept in the catalog's Parquet tables under `path`, for rehearsals: a client holds one registry at a time.

    The latest row of a schema and the latest delivery of a version count.
    """

    page = 100

    def __init__(self, options: dict[str, str], credentials: dict[str, str] | None = None):
        self.path, self.loaded, self.lock = options["path"].rstrip("/"), None, threading.Lock()

    def _rows(self, name: str, columns: list[str], filters=None) -> list[dict]:
        import pyarrow.parquet as pq

        return pq.read_table(f"{self.path}/{name}.parquet", columns=columns, filters=filters).to_pylist()

    def _registry(self, name: str) -> tuple[dict, dict]:
        with self.lock:
            if self.loaded is None or self.loaded[0] != name:
                mine = [("registry_name", "=", name)]
                schemas, versions = {}, {}
                for r in sorted(self._rows("glue_schemas", ["name", "data_format", "compatibility", "description", "updated_time"], mine), key=lambda r: (r["updated_time"] is not None, r["updated_time"])):
                    schemas[r["name"]] = r
                for r in sorted(self._rows("glue_versions", ["schema_name", "version_number", "schema_version_id", "definition", "status", "ingested_at"], mine), key=lambda r: (r["ingested_at"] is not None, r["ingested_at"])):
                    versions.setdefault(r["schema_name"], {})[r["version_number"]] = r
                self.loaded = (name, schemas, versions)
            return self.loaded[1:]

    def _page(self, items: list, token: str | None) -> tuple[list, str | None]:
        end = int(token or 0) + self.page
        return items[end - self.page : end], str(end) if end < len(items) else None

    def list_registries(self, token):
        return self._page([{"name": n} for n in sorted({r["name"] for r in self._rows("registries", ["name"])})], token)

    def get_registry(self, name):
        found = self._rows("registries", ["name", "arn", "description"], [("name", "=", name)])
        if not found:
            raise LookupError(f"registry {name!r} does not exist")
        return found[0]

    def list_schemas(self, registry, token):
        return self._page([{"name": n} for n in sorted(self._registry(registry)[0])], token)

    def get_schema(self, registry, name):
        return self._registry(registry)[0][name]

    def list_versions(self, registry, name, token):
        return self._page(sorted(self._registry(registry)[1].get(name, {})), token)

    def get_version(self, registry, name, number):
        return self._registry(registry)[1][name][number]


def credentials(options: dict[str, str]) -> dict[str, str]:
    """Which credentials a client is to use: given keys, else a profile, else the environment's default chain."""
    if options.get("access_key_id") and options.get("secret_access_key"):
        return {"kind": "keys", "access_key_id": options["access_key_id"], "secret_access_key": options["secret_access_key"]}
    if options.get("profile"):
        return {"kind": "profile", "profile": options["profile"]}
    return {"kind": "default"}


def client(options: dict[str, str]) -> RegistryClient:
    """The client named by the option `client` (module:Class), by default the files under `path`.

    It is made with the options and with the credentials that they come down to.
    """
    at = options.get("client", "schemaloom.sources.registry:FolderClient")
    module, _, name = at.partition(":")
    return getattr(importlib.import_module(module), name)(options, credentials(options))


class Pacer:
    """Lets through so many calls a second, without bursts; threads may share it."""

    def __init__(self, per_second: float):
        self.gap, self.next = (1 / per_second if per_second > 0 else 0.0), 0.0
        self.lock = threading.Lock()

    def wait(self) -> None:
        if self.gap:
            with self.lock:
                now = time.monotonic()
                at, self.next = max(now, self.next), max(now, self.next) + self.gap
            if at > now:
                time.sleep(at - now)


def _time(text: str | None) -> datetime | None:
    try:
        return datetime.fromisoformat(text.replace("Z", "+00:00")) if text and "T" in text else None
    except ValueError:
        return None


class Share(InputPartition):
    def __init__(self, registry: str, names: list[str]):
        self.registry, self.names = registry, names


class VersionsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.registries: set[str] | None = None
        self.names: set[str] | None = None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute in (("registry_name",), ("name",)):
                which = "registries" if f.attribute == ("registry_name",) else "names"
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                now = getattr(self, which)
                setattr(self, which, values if now is None else now & values)
            else:
                yield f

    def partitions(self):
        c, share = client(self.options), int(self.options.get("schemas_per_partition", 100))
        glob = self.options.get("schema_filter")
        import re

        wanted = re.compile(rf"(?:{glob_pattern(glob)})\Z") if glob else None
        out = []
        for r in pages(c.list_registries):
            if self.registries is not None and r["name"] not in self.registries:
                continue
            names = [s["name"] for s in pages(c.list_schemas, r["name"])]
            names = [n for n in names if (self.names is None or n in self.names) and (wanted is None or wanted.match(n))]
            out += [Share(r["name"], names[i : i + share]) for i in range(0, len(names), share)]
        return out or [Share("", [])]

    def read(self, partition: Share):
        c = client(self.options)
        pace = Pacer(float(self.options.get("calls_per_second", 0)) / max(1, int(self.options.get("parallel", 1))))

        def version(name: str, n: int) -> dict:
            pace.wait()
            return c.get_version(partition.registry, name, n)

        with ThreadPoolExecutor(max(1, int(self.options.get("threads", 4)))) as pool:
            for name in partition.names:
                pace.wait()
                s = c.get_schema(partition.registry, name)
                pace.wait()
                head = (partition.registry, name, s.get("data_format"), s.get("compatibility"), s.get("description"))
                numbers = sorted(pages(c.list_versions, partition.registry, name))
                for n, v in zip(numbers, pool.map(lambda k, name=name: version(name, k), numbers)):
                    yield (*head, n, v.get("schema_version_id"), v.get("definition"), v.get("status"), _time(v.get("created_time")))
                if not numbers:  # a schema without versions is a row too
                    yield (*head, None, None, None, None, None)


class SchemaRegistry(DataSource):
    """The versions of all schemas of a registry service."""

    @classmethod
    def name(cls) -> str:
        return "schema_registry"

    def schema(self) -> str:
        return VERSIONS

    def reader(self, schema) -> DataSourceReader:
        return VersionsReader(self.options)


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SchemaRegistry)
