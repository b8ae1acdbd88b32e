"""Registration at the target: levels one after the other, schemas of a level in parallel, versions in order.

The work of a level is a DataFrame with a row per version; it is partitioned by schema and sorted by version number,
each partition posts its schemas one by one, with retries and a share of the rate. Results come back as rows; the
ledger is appended after each level, so a run that was broken off goes on where it stopped. A task that runs again
posts again: registration of the same text under the same subject is idempotent at the target.
"""

from __future__ import annotations

import base64
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.sources.registry import Pacer

RESULT = "key string, target string, versions int, ok boolean, error string"
MEDIA_TYPE = "application/vnd.schemaregistry.v1+json"


class Target(Protocol):
    """What a target must answer; the last two only where compatibility and metadata are to be set."""

    def register(self, subject: str, body: str) -> None: ...
    def set_compatibility(self, subject: str, level: str) -> None: ...
    def set_metadata(self, subject: str, metadata: dict) -> None: ...


@dataclass
class HttpTarget:
    """A schema registry behind HTTP."""

    url: str
    key: str = ""
    secret: str = ""
    timeout: float = 30.0

    def _call(self, method: str, path: str, body: str | None = None, also: tuple[int, ...] = ()) -> tuple[int, str]:
        head = {"Content-Type": MEDIA_TYPE, "Authorization": "Basic " + base64.b64encode(f"{self.key}:{self.secret}".encode()).decode()}
        req = urllib.request.Request(self.url.rstrip("/") + path, body.encode() if body is not None else None, head, method=method)
        try:
            with urllib.request.urlopen(req, timeout=self.timeout) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            if e.code in also:
                return e.code, ""
            raise RuntimeError(f"{method} {path}: {e.read().decode(errors='replace')} (status {e.code})") from e

    @staticmethod
    def _name(subject: str) -> str:
        return urllib.parse.quote(subject, safe=":@&=+$")

    def register(self, subject: str, body: str) -> None:
        self._call("POST", f"/subjects/{self._name(subject)}/versions", body)

    def set_compatibility(self, subject: str, level: str) -> None:
        self._call("PUT", f"/config/{self._name(subject)}", json.dumps({"compatibility": level}))

    def subjects(self) -> list[str]:
        return json.loads(self._call("GET", "/subjects")[1])

    def exists(self, subject: str) -> bool:
        return self._call("GET", f"/subjects/{self._name(subject)}/versions", also=(404,))[0] == 200

    def set_metadata(self, subject: str, metadata: dict) -> None:
        """Sets metadata; a target without that call is accepted."""
        self._call("PUT", f"/subjects/{self._name(subject)}/metadata", json.dumps(metadata), also=(404,))


@dataclass
class FolderTarget:
    """A target that appends to a file per subject. For tests and rehearsals."""

    path: str

    def register(self, subject: str, body: str) -> None:
        import os

        os.makedirs(self.path, exist_ok=True)
        at = os.path.join(self.path, urllib.parse.quote(subject, safe="") + ".jsonl")
        have = open(at, encoding="utf-8").read().splitlines() if os.path.exists(at) else []
        if body not in have:
            with open(at, "a", encoding="utf-8") as f:
                f.write(body + "\n")


def with_retry(call: Callable[[], None], attempts: int, delay: float, sleep: Callable[[float], None] = time.sleep) -> None:
    """Calls once and up to `attempts` times more, waiting twice as long each time; the last error is raised."""
    for i in range(attempts + 1):
        try:
            return call()
        except Exception:
            if i == attempts:
                raise
            sleep(delay * 2**i)


def register_level(rows: DataFrame, make: Callable[[], Target], *, partitions: int, retries: int = 3, delay: float = 5.0, per_second: float = 0.0) -> DataFrame:
    """A result per schema of rows(key, target, version_number, body); the first version that fails ends its schema.

    Where rows have compatibility or metadata, these are set at the target once the schema's versions are there.
    """
    more = [c for c in ("compatibility", "metadata") if c in rows.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, pace = make(), Pacer(per_second / partitions)
        key, goal, sent, error, last = None, None, 0, None, None

        def result() -> pd.DataFrame:
            nonlocal error
            if error is None and last is not None:
                try:
                    for c in more:
                        if (value := getattr(last, c)) is not None:
                            pace.wait()
                            call = (lambda v=value: target.set_compatibility(goal, v)) if c == "compatibility" else (lambda v=value: target.set_metadata(goal, json.loads(v)))
                            with_retry(call, retries, delay)
                except Exception as e:
                    error = str(e)
            return pd.DataFrame([(key, goal, sent, error is None, error)], columns=["key", "target", "versions", "ok", "error"])

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.key != key:
                    if key is not None:
                        yield result()
                    key, goal, sent, error = r.key, r.target, 0, None
                last = r
                if error is not None:
                    continue
                try:
                    pace.wait()
                    with_retry(lambda r=r: target.register(r.target, r.body), retries, delay)
                    sent += 1
                except Exception as e:
                    error = f"version {r.version_number}: {e}"
        if key is not None:
            yield result()

    d = rows.select("key", "target", "version_number", "body", *more).repartition(partitions, "key").sortWithinPartitions("key", "version_number")
    return d.mapInPandas(run, RESULT)


def append_ledger(results: DataFrame, path: str) -> None:
    """Adds what succeeded to the ledger table, and what failed to the table of failures beside it."""
    key = [F.col("key"), F.substring_index("key", ":", 1).alias("source_registry"), F.expr("substring(key, instr(key, ':') + 1)").alias("source_schema"), F.col("target").alias("target_subject")]
    results.where("ok").select(*key, "versions", F.current_timestamp().alias("completed_at")).write.mode("append").parquet(path)
    results.where("not ok").select(*key, "versions", "error", F.current_timestamp().alias("failed_at")).write.mode("append").parquet(failures_at(path))


def failures_at(path: str) -> str:
    return path.rstrip("/") + ".failed"


def failed(spark, path: str) -> DataFrame:
    """(key, error): the schemas whose last attempt by this ledger failed."""
    f = spark.read.parquet(failures_at(path)).groupBy("key").agg(F.max("failed_at").alias("failed_at"), F.max_by("error", "failed_at").alias("error"))
    done = spark.read.parquet(path).groupBy("key").agg(F.max("completed_at").alias("completed_at"))
    return f.join(done, "key", "left").where("completed_at is null or completed_at < failed_at").select("key", "error")
