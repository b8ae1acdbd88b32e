"""Names suggested by a model: context of a schema, prompt, cached and budgeted calls.

The model is called where a schema has no cached answer for that model and role, in batches on executors through
mapInPandas, each partition with its share of the rate and of the budget; what a round leaves of the budget goes to
the next. A provider is any object with complete(prompt) -> (text, cost).
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaloom.config import Config, Suggestions
from schemaloom.functions import naming as N
from schemaloom.functions import parsing as P
from schemaloom.functions import roles as R
from schemaloom.session import Workspace, exists, shuffle_partitions, union
from schemaloom.sources import files

CONTEXT_FIELDS = 10
DOC_BYTES = 200


class Provider(Protocol):
    def complete(self, prompt: str) -> tuple[str, float]: ...


@dataclass
class Fixed:
    """A provider without a model: the schema's own name, in the convention. For tests and dry runs."""

    cost: float = 0.0

    def complete(self, prompt: str) -> tuple[str, float]:
        lines = dict(line.split(": ", 1) for line in prompt.splitlines() if ": " in line)
        return f"{lines.get('Schema', '').lower().replace('_', '-').replace('.', '-')}-{lines.get('Role', 'value')}", self.cost


@dataclass
class Http:
    """A provider behind HTTP: where the request goes, how it is put, how the answer and its tokens are read."""

    url: str
    headers: dict[str, str]
    body: Callable[[str], dict]
    read: Callable[[dict], tuple[str, int, int]]
    input_cost: float = 0.0
    output_cost: float = 0.0
    timeout: float = 60.0

    def complete(self, prompt: str) -> tuple[str, float]:
        data = json.dumps(self.body(prompt)).encode()
        with urllib.request.urlopen(urllib.request.Request(self.url, data, {"Content-Type": "application/json", **self.headers}), timeout=self.timeout) as r:
            text, n_in, n_out = self.read(json.load(r))
        return text, n_in * self.input_cost + n_out * self.output_cost


def provider(s: Suggestions) -> Provider:
    """The provider of a configuration."""
    chat = lambda p: {"model": s.model, "messages": [{"role": "user", "content": p}], "max_tokens": 500, "temperature": 0.3}
    usage = lambda r, a, b: (int(r.get("usage", {}).get(a, 0)), int(r.get("usage", {}).get(b, 0)))
    said = lambda r: (r["choices"][0]["message"]["content"], *usage(r, "prompt_tokens", "completion_tokens"))
    if s.provider == "openai":
        return Http((s.base_url or "https://api.openai.com/v1").rstrip("/") + "/chat/completions", {"Authorization": f"Bearer {s.api_key}"}, chat, said, s.input_token_cost, s.output_token_cost)
    if s.provider == "anthropic":
        return Http((s.base_url or "https://api.anthropic.com/v1").rstrip("/") + "/messages", {"x-api-key": s.api_key, "anthropic-version": "2023-06-01"}, chat, lambda r: (r["content"][0]["text"], *usage(r, "input_tokens", "output_tokens")), s.input_token_cost, s.output_token_cost)
    if s.provider == "ollama":
        return Http(s.base_url.rstrip("/") + "/api/generate", {}, lambda p: {"model": s.model, "prompt": p, "stream": False}, lambda r: (r["response"], 0, 0))
    if s.provider == "local":
        return Http(s.base_url.rstrip("/") + "/chat/completions", {"Authorization": f"Bearer {s.api_key}"} if s.api_key else {}, chat, lambda r: (r["choices"][0]["message"]["content"], 0, 0))
    if s.provider == "bedrock":
        raise NotImplementedError("bedrock is not available")
    raise ValueError(f"unknown provider {s.provider!r}")


def prompt_type(raw: Column) -> Column:
    """A field's Avro type for a prompt: a name, an object's type or else its name, a union's plain members, else complex."""
    plain = lambda x: ~x.rlike(r"\A\s*[\[{]")
    text = lambda x: F.when(plain(x), x)
    members = F.array_join(F.filter(P._members(raw), plain), "|")
    of_object = F.coalesce(text(F.get_json_object(raw, "$.type")), text(F.get_json_object(raw, "$.name")))
    kind = F.when(raw.startswith("["), F.when(members != "", members)).when(raw.startswith("{"), of_object).otherwise(raw)
    return F.coalesce(kind, F.lit("complex"))


def context(definition: Column, data_format: Column) -> Column:
    """struct(record_name, namespace, documentation, field_count, key_fields) of a definition, for a prompt."""
    a, j, p = P.avro(definition), P.json_schema(definition), P.proto(definition, "first")
    raw = F.from_json(F.when(P.whole_json(definition), definition), P._AVRO)["fields"]
    avro_shown = F.transform(raw, lambda f: F.concat(F.coalesce(f["name"], F.lit("")), F.lit(" ("), prompt_type(f["type"]), F.lit(")")))
    shown = lambda f: F.concat(f["name"], F.lit(" ("), F.coalesce(f["type"], F.lit("object")), F.lit(")"))
    lines = P.proto_assignments(definition)
    token = lambda x, i: F.regexp_extract(x, r"\A(\S+)\s+(\S+)", i)
    parts = F.transform(F.filter(lines, lambda x: x.rlike(r"\A\S+\s+\S")), lambda x: F.concat(token(x, 2), F.lit(" ("), token(x, 1), F.lit(")")))
    by = lambda avro, js, pb: F.when(data_format == "AVRO", avro).when(data_format == "JSON", js).when(data_format == "PROTOBUF", pb)
    count = by(F.size(raw), F.size(j["fields"]), F.size(lines))
    keys = by(F.slice(avro_shown, 1, CONTEXT_FIELDS), F.slice(F.transform(j["fields"], shown), 1, CONTEXT_FIELDS), F.slice(parts, 1, CONTEXT_FIELDS))
    text = lambda x: F.coalesce(x, F.lit(""))
    return F.struct(
        text(by(a["record_name"], j["record_name"], p["record_name"])).alias("record_name"),
        text(by(a["namespace"], j["namespace"], p["namespace"])).alias("namespace"),
        N.truncate(text(by(a["documentation"], j["documentation"], p["documentation"])), DOC_BYTES).alias("documentation"),
        F.greatest(F.coalesce(count, F.lit(0)), F.lit(0)).alias("field_count"),
        F.coalesce(keys, F.array().cast("array<string>")).alias("key_fields"),
    )


def prompt(registry: Column, name: Column, data_format: Column, ctx: Column, role: Column) -> Column:
    """The question about one schema."""
    text = "\n".join((
        "Suggest the subject under which this schema is to be registered.",
        "Use lower case and hyphens; leave out environments, versions and vendor prefixes; end in the role.",
        "Schema: %s", "Registry: %s", "Format: %s", "Record: %s", "Namespace: %s", "Documentation: %s", "Fields: %s", "Field count: %d", "Role: %s",
        "Answer with the subject only, ending in -%s as it is a %s schema.",
    ))
    return F.format_string(text, name, registry, data_format, ctx["record_name"], ctx["namespace"], ctx["documentation"], F.array_join(ctx["key_fields"], ", "), ctx["field_count"], role, role, role)


CALLS = "registry_name string, name string, answer string, cost double, error string"


def ask(prompts: DataFrame, make: Callable[[], Provider], max_cost: float = 0.0, per_second: float = 0.0, partitions: int = 1) -> DataFrame:
    """(registry_name, name, answer, cost, error) of prompts(registry_name, name, prompt).

    A partition stops calling once its share of max_cost is spent (0: no limit); its further rows carry an error.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p, spent, last = make(), 0.0, 0.0
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if max_cost > 0 and spent >= max_cost / partitions:
                    rows.append((r.registry_name, r.name, None, 0.0, "cost limit reached"))
                    continue
                if per_second > 0:
                    time.sleep(max(0.0, last + partitions / per_second - time.monotonic()))
                    last = time.monotonic()
                try:
                    answer, cost = p.complete(r.prompt)
                    spent += cost
                    rows.append((r.registry_name, r.name, answer, cost, None))
                except Exception as e:  # a failed call is a row, not a failed job
                    rows.append((r.registry_name, r.name, None, 0.0, str(e)))
            yield pd.DataFrame(rows, columns=["registry_name", "name", "answer", "cost", "error"])

    d = prompts.select("registry_name", "name", "prompt")
    return (d.coalesce(1) if partitions == 1 else d.repartition(partitions, "registry_name", "name")).mapInPandas(run, CALLS)


def ask_all(prompts: DataFrame, make: Callable[[], Provider], max_cost: float = 0.0, per_second: float = 0.0, partitions: int = 1) -> DataFrame:
    """As ask(), but what some partitions leave of the budget is spent on what others could not ask any more."""
    if max_cost <= 0 or partitions == 1:
        return ask(prompts, make, max_cost, per_second, partitions)
    work = Workspace(prompts.sparkSession, "calls")
    todo, left, rounds = work.save(prompts.select("registry_name", "name", "prompt")), max_cost, []
    over = F.col("error").eqNullSafe("cost limit reached")
    while True:
        calls = work.save(ask(todo, make, left, per_second, partitions))
        t = calls.agg(F.count("answer").alias("n"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"), F.count(F.when(over, 1)).alias("over")).first()
        left -= t["cost"]
        if not t["over"] or not t["n"] or left <= 0:
            return union([*rounds, calls])
        rounds.append(calls.where(~over))
        todo = todo.join(calls.where(over).select("registry_name", "name"), ["registry_name", "name"], "left_semi")


def suggestions(prompts: DataFrame, cache: DataFrame, make: Callable[[], Provider], **limits) -> tuple[DataFrame, DataFrame]:
    """(answers(registry_name, name, suggested, is_cached), calls): cached answers and new ones; empty answers count as none."""
    known = cache.select("registry_name", "name", "suggested")
    calls = ask_all(prompts.join(known, ["registry_name", "name"], "left_anti"), make, **limits)
    new = calls.select("registry_name", "name", N.clean_answer(F.col("answer")).alias("suggested")).where("suggested <> ''")
    old = prompts.select("registry_name", "name").join(known, ["registry_name", "name"])
    return old.withColumn("is_cached", F.lit(True)).unionByName(new.withColumn("is_cached", F.lit(False))), calls


CACHED = "registry_name string, name string, role string, model string, suggested string, cached_at timestamp"


class Cache:
    """Answers kept between runs: a table of JSON lines, appended to; of repeated answers the latest counts.

    An answer belongs to a schema, its role and the model that gave it.
    """

    def __init__(self, spark, path: str, model: str):
        self.spark, self.path, self.model = spark, path, model

    def answers(self) -> DataFrame:
        """(registry_name, name, role, suggested) of this model."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], CACHED).select("registry_name", "name", "role", "suggested")
        all_ = self.spark.read.schema(CACHED).json(self.path).where(F.col("model") == self.model)
        return all_.groupBy("registry_name", "name", "role").agg(F.max_by("suggested", "cached_at").alias("suggested"))

    def get(self, registry: str, name: str, role: str) -> str | None:
        r = self.answers().where((F.col("registry_name") == registry) & (F.col("name") == name) & (F.col("role") == role)).first()
        return r["suggested"] if r else None

    def add(self, answers: DataFrame) -> None:
        """Keeps answers(registry_name, name, role, suggested)."""
        rows = answers.select("registry_name", "name", "role", F.lit(self.model).alias("model"), "suggested", F.current_timestamp().alias("cached_at"))
        rows.write.mode("append").json(self.path)

    def count(self) -> int:
        return self.answers().count()

    def clear(self) -> None:
        self.spark.createDataFrame([], CACHED).write.mode("overwrite").json(self.path)


def suggested_names(schemas: DataFrame, c: Config, make: Callable[[], Provider]) -> tuple[DataFrame, DataFrame]:
    """(answers(registry_name, name, suggested), calls) for schemas(registry_name, name, data_format, definition).

    Cached answers first; new ones are asked for within the budget, and kept if a cache file is configured.
    """
    spark = schemas.sparkSession
    work = Workspace(spark, "suggestions")
    record, _ = P.light_metadata(F.col("definition"), F.col("data_format"))
    over = files.role_overrides(c.key_value.role_override_file) if c.key_value.role_override_file else None
    role = R.detect(F.col("registry_name"), F.col("name"), record, None, c.key_value, over)["role"]
    text = prompt(F.col("registry_name"), F.col("name"), F.col("data_format"), context(F.col("definition"), F.col("data_format")), F.col("role"))
    prompts = work.save(schemas.withColumn("role", role).select("registry_name", "name", "role", text.alias("prompt")))
    cache = Cache(spark, c.llm.cache_file, c.llm.model) if c.llm.cache_file else None
    known = prompts.select("registry_name", "name", "role").join(cache.answers(), ["registry_name", "name", "role"]) if cache else prompts.select("registry_name", "name", F.lit("").alias("suggested")).where("false")
    known = work.save(known.select("registry_name", "name", "suggested"))
    rate = min(c.llm.rate_limit, c.concurrency.llm_rate_limit)
    calls = work.save(ask_all(prompts.join(known, ["registry_name", "name"], "left_anti"), make, max_cost=c.llm.max_cost, per_second=rate, partitions=max(1, min(c.concurrency.workers, shuffle_partitions(spark)))))
    new = calls.select("registry_name", "name", N.clean_answer(F.col("answer")).alias("suggested")).where("suggested <> ''")
    if cache:
        cache.add(new.join(prompts.select("registry_name", "name", "role"), ["registry_name", "name"]))
    return known.unionByName(new), calls


def totals(calls: DataFrame) -> DataFrame:
    """One row: calls answered and their cost."""
    return calls.agg(F.count("answer").alias("n_calls"), F.coalesce(F.sum("cost"), F.lit(0.0)).alias("cost"))
