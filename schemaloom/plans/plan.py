"""The plan of a migration as DataFrames, its summary and reports, and its execution."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.config import Config
from schemaloom.functions.keys import schema_key
from schemaloom.operators import catalog as C
from schemaloom.operators import graph as G
from schemaloom.operators import load as L
from schemaloom.operators import mapping as M
from schemaloom.operators import suggest as U
from schemaloom.operators.references import resolved
from schemaloom.session import Workspace, exists, shuffle_partitions, write_text
from schemaloom.sinks import registry as sink
from schemaloom.sources import files


@dataclass
class Plan:
    """mappings are written once, so that findings, summary and execution read them and parse nothing again."""

    schemas: DataFrame
    versions: DataFrame
    mappings: DataFrame
    references: DataFrame
    config: Config
    calls: DataFrame | None = None

    @property
    def edges(self) -> DataFrame:
        """(src, dst): the references that resolve to another schema."""
        return self.references.where("target is not null and src <> target").select("src", F.col("target").alias("dst")).distinct()

    @property
    def findings(self) -> DataFrame:
        """(severity, schema, message) of mappings and references."""
        m = self.config.migration
        return M.findings(self.mappings, m.reference_strategy).unionByName(M.reference_findings(self.mappings, self.references, m.reference_strategy, m.cross_registry_refs))


def build(spark, sf_dir: str | None, c: Config, *, catalog: C.Catalog | None = None, make: Callable[[], U.Provider] | None = None) -> Plan:
    """The plan over the catalog's tables in sf_dir, or over a catalog read from elsewhere (`catalog.from_registry`).

    With the strategy llm names are taken from the cache file or asked of the provider (make, or the configured one),
    and new ones are added to the cache.
    """
    cat = catalog or C.from_tables(spark, sf_dir)
    regs = C.select_registries(cat.registries, names=c.aws.registry_names, every=c.aws.registry_all, exclude=c.aws.registry_exclude).select(F.col("name").alias("registry_name"))
    schemas = C.filter_schemas(cat.schemas, c.aws.schema_filter).join(F.broadcast(regs) if not c.aws.registry_all else regs, "registry_name", "left_semi")
    n, work = c.naming, Workspace(spark, "plan")
    have = C.with_versions(schemas, cat.versions)
    suggested, calls = None, None
    if n.subject_strategy == "llm":
        suggested, calls = U.suggested_names(have, c, make or (lambda: U.provider(c.llm)))
    mapped = M.map_schemas(
        have,
        c,
        overrides=files.role_overrides(c.key_value.role_override_file) if c.key_value.role_override_file else None,
        names=files.name_mappings(n.name_mapping_file) if n.name_mapping_file else (),
        contexts=files.context_mappings(n.context_mapping_file) if n.context_mapping_file else None,
        suggestions=suggested,
    )
    refs = cat.parsed.select(F.col("registry_name").alias("source_registry"), F.col("name").alias("source_schema_name"), "references")
    mapped = mapped.join(refs, ["source_registry", "source_schema_name"], "left").withColumn("references", F.coalesce("references", F.array().cast("array<string>")))
    if c.migration.reference_strategy == "skip":
        mapped = mapped.withColumn("status", F.when(F.size("references") > 0, "skipped").otherwise(F.col("status")))
    if c.normalization.collision_check:
        mapped = M.resolve_collisions(mapped, c.normalization.collision_resolution)
    mapped = work.save(mapped)
    return Plan(schemas, cat.versions, mapped, resolved(cat.parsed, schemas), c, calls)


def summary(p: Plan) -> DataFrame:
    """One row: registries, schemas, versions, references, and mappings by status."""
    m = p.mappings.agg(
        F.countDistinct("source_registry").alias("registries"),
        F.count("*").alias("schemas"),
        F.coalesce(F.sum("source_versions"), F.lit(0)).alias("versions"),
        F.coalesce(F.sum(F.size("references")), F.lit(0)).alias("references"),
        *(F.count(F.when(F.col("status") == s, 1)).alias(n) for s, n in (("ready", "ready"), ("error", "errors"), ("skipped", "skipped"))),
    ).withColumn("one", F.lit(1))
    w = M.findings(p.mappings, p.config.migration.reference_strategy).agg(F.count(F.when(F.col("severity") == "warning", 1)).alias("warnings")).withColumn("one", F.lit(1))
    k = M.collisions(p.mappings.where("status <> 'skipped'")).agg(F.count("*").alias("collisions")).withColumn("one", F.lit(1))
    return m.join(w, "one").join(k, "one").drop("one")


def by_registry(p: Plan) -> DataFrame:
    """Per registry: schemas, versions, and references into other registries."""
    cross = p.edges.where(F.substring_index("src", ":", 1) != F.substring_index("dst", ":", 1)).groupBy(F.substring_index("src", ":", 1).alias("source_registry")).agg(F.count("*").alias("cross_refs"))
    m = p.mappings.groupBy("source_registry").agg(F.count("*").alias("n_schemas"), F.sum("source_versions").alias("n_versions"))
    return m.join(cross, "source_registry", "left").withColumn("cross_refs", F.coalesce("cross_refs", F.lit(0)))


def totals(p: Plan, results: DataFrame | None = None) -> DataFrame:
    """One row for the whole run: successful, failed and skipped schemas, versions sent, calls for names and their cost."""
    one = F.lit(1).alias("one")
    skipped = p.mappings.agg(F.count(F.when(F.col("status") == "skipped", 1)).alias("n_skipped")).withColumn("one", one)
    if results is None:
        done = p.mappings.agg(F.lit(0).cast("long").alias("n_successful"), F.lit(0).cast("long").alias("n_failed"), F.lit(0).cast("long").alias("n_versions")).withColumn("one", one)
    else:
        done = results.agg(F.count(F.when(F.col("ok"), 1)).alias("n_successful"), F.count(F.when(~F.col("ok"), 1)).alias("n_failed"), F.coalesce(F.sum("versions"), F.lit(0)).alias("n_versions")).withColumn("one", one)
    asked = U.totals(p.calls) if p.calls is not None else skipped.select(F.lit(0).cast("long").alias("n_calls"), F.lit(0.0).alias("cost"))
    return done.join(skipped, "one").join(asked.withColumn("one", one), "one").drop("one")


def write_report(p: Plan, path: str, how: str = "json", results: DataFrame | None = None, started: dt.datetime | None = None, dry_run: bool = False) -> None:
    """The report as a folder: summary.json, and the tables schemas, findings, collisions and results as JSON lines or CSV.

    summary.json says when and from where to where the run went, by which settings, and what came of it. Lists are joined
    by ; in CSV.
    """
    c, now = p.config, dt.datetime.now(dt.timezone.utc)
    spark = p.mappings.sparkSession
    formats = p.schemas.select(F.col("registry_name").alias("source_registry"), F.col("name").alias("source_schema_name"), L.schema_type(F.col("data_format")).alias("schema_type"))
    schemas = p.mappings.join(formats, ["source_registry", "source_schema_name"], "left")
    if results is not None:
        sent = results.select("key", F.col("versions").alias("versions_migrated"), "ok", F.col("error").alias("run_error"))
        schemas = schemas.withColumn("key", schema_key("source_registry", "source_schema_name")).join(sent, "key", "left").drop("key")
        schemas = schemas.withColumn("status", F.when(F.col("ok"), "success").when(~F.col("ok"), "failed").otherwise(F.col("status"))).withColumn("error", F.coalesce("run_error", "error")).drop("ok", "run_error")
    tables = {"schemas": schemas, "findings": p.findings, "collisions": M.collisions(p.mappings)} | ({"results": results} if results is not None else {})
    for name, df in tables.items():
        if how == "csv":
            flat = df.select(*(F.concat_ws(";", k).alias(k) if t.startswith("array") else F.col(k) for k, t in df.dtypes))
            flat.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
        else:
            df.write.mode("overwrite").json(f"{path}/{name}")
    started = started or now
    head = {
        "start_time": started.isoformat(),
        "end_time": now.isoformat(),
        "duration_seconds": round((now - started).total_seconds(), 3),
        "dry_run": dry_run,
        "source": {"region": c.aws.region, "registries": c.aws.registry_names or ("all" if c.aws.registry_all else [])},
        "target": {"url": c.confluent_cloud.url},
        "config": {"subject_strategy": c.naming.subject_strategy, "context_mapping": c.naming.context_mapping, "version_strategy": c.migration.version_strategy, "reference_strategy": c.migration.reference_strategy, "normalize_dots": c.normalization.normalize_dots, "normalize_case": c.normalization.normalize_case} | ({"llm_provider": c.llm.provider, "llm_model": c.llm.model} if c.naming.subject_strategy == "llm" else {}),
        "results": summary(p).first().asDict() | totals(p, results).first().asDict(),
    }
    write_text(spark, f"{path}/summary.json", json.dumps(head, indent=2))


def show(p: Plan, rows: int = 50) -> None:
    """The plan on the console: registries, some mappings, the summary."""
    by_registry(p).orderBy("source_registry").show(truncate=False)
    p.mappings.select(F.when(F.col("status") == "error", "[ERR]").otherwise("[OK]").alias("state"), F.concat_ws(".", "source_registry", "source_schema_name").alias("source"), M.full_target().alias("target"), "naming_strategy").orderBy("source").show(rows, truncate=False)
    summary(p).show(truncate=False)


def ledger_at(path: str) -> str:
    """Where the ledger's table lies: beside a state file in JSON, else the path itself."""
    return path[: -len(".json")] + ".ledger" if path.endswith(".json") else path


def done_before(spark, path: str) -> DataFrame:
    """(key): what earlier runs completed, by the ledger and by a state file. What exists and cannot be read raises."""
    keys = spark.createDataFrame([], "key string")
    if exists(spark, at := ledger_at(path)):
        keys = spark.read.parquet(at).select("key")
    if path.endswith(".json") and exists(spark, path):
        state = files.load_state(path)  # written by one process, so it fits the driver
        if state["completed_schemas"]:
            keys = keys.unionByName(spark.createDataFrame([(k,) for k in state["completed_schemas"]], "key string"))
    return keys.distinct()


def bodies(p: Plan, versions: DataFrame, observed: bool = False) -> DataFrame:
    """(key, target, version_number, body, compatibility, metadata): a registration per version of versions(key, version_number, definition).

    References name the subject that the mapping gave their target and the version it has there: its versions are
    registered in order, so the last one's number is how many there are. observed keeps the form of older runs: the
    raw name with -value, in the registry's context, version 1.
    """
    m = p.mappings.withColumn("key", schema_key("source_registry", "source_schema_name"))
    refs = None
    if p.config.migration.reference_strategy == "rewrite":
        if observed:
            m = m.withColumn("refs", L.observed_references(F.col("references"), F.col("target_context")))
        else:
            sent = versions.groupBy(F.col("key").alias("source")).agg(F.count("*").alias("version"))
            each = L.mapped_references(p.references, p.mappings, sent)
            lists = each.groupBy(F.col("src").alias("key")).agg(F.sort_array(F.collect_list(F.struct("pos", "name", "subject", "version"))).alias("r"))  # one schema's own
            lists = lists.select("key", F.transform("r", lambda x: F.struct(x["name"].alias("name"), x["subject"].alias("subject"), x["version"].alias("version"))).alias("refs"))
            m = m.join(lists, "key", "left")
        refs = F.col("refs")
    s = p.schemas.select(schema_key("registry_name", "name").alias("key"), "data_format", "compatibility", "description")
    meta = F.when(F.col("description") != "", F.to_json(F.struct(F.struct("description").alias("properties"))))
    t = p.config.confluent_cloud
    return m.join(s, "key").join(versions, "key").select("key", M.full_target().alias("target"), "status", "version_number", L.register_body(F.col("definition"), L.schema_type(F.col("data_format")), refs).alias("body"), (F.col("compatibility") if t.set_compatibility else F.lit(None).cast("string")).alias("compatibility"), (meta if t.set_metadata else F.lit(None).cast("string")).alias("metadata"))


def execute(spark, p: Plan, c: Config, ledger_path: str, make: Callable[[], sink.Target], observed_references: bool = False) -> DataFrame:
    """Registers the plan level by level and returns the results.

    With checkpoint.resume what the ledger has is left out, else all is sent. Fails before the first call if the plan has
    errors, the references have cycles, or a ledger that exists cannot be read.
    """
    work = Workspace(spark, "execute")
    if p.findings.where("severity = 'error'").limit(1).count():
        raise ValueError("the plan has errors: see its findings")
    keys = p.mappings.select(schema_key("source_registry", "source_schema_name").alias("key"))
    levels, cyclic = G.levels(keys, p.edges.join(keys.withColumnRenamed("key", "src"), "src", "left_semi").join(keys.withColumnRenamed("key", "dst"), "dst", "left_semi"))
    if cyclic.limit(1).count():
        raise ValueError("the references have cycles: no order of registration exists")
    ledger = done_before(spark, ledger_path) if c.checkpoint.resume else spark.createDataFrame([], "key string")
    versions = C.latest(p.versions) if c.migration.version_strategy == "latest" else p.versions
    versions = versions.select(schema_key("registry_name", "name").alias("key"), "version_number", "definition")
    todo = L.to_send(p.mappings, ledger).select("key")
    send = work.save(bodies(p, versions, observed_references).join(todo, "key", "left_semi").join(levels, "key"))
    parts = max(1, min(c.concurrency.workers, shuffle_partitions(spark)))
    results = None
    for level in sorted(r["level"] for r in send.select("level").distinct().collect()):  # as many as there are levels
        done = work.save(sink.register_level(send.where(F.col("level") == level), make, partitions=parts, retries=c.concurrency.retry_attempts, delay=c.concurrency.retry_delay, per_second=c.concurrency.cc_rate_limit).withColumn("level", F.lit(level)))
        sink.append_ledger(done, ledger_at(ledger_path))
        results = done if results is None else results.unionByName(done)
    if results is None:
        results = spark.createDataFrame([], sink.RESULT + ", level int")
    if ledger_path.endswith(".json"):
        n = totals(p, results).first()
        before = files.load_state(ledger_path) if c.checkpoint.resume and exists(spark, ledger_path) else {}
        files.save_state(ledger_path, before | {"total_schemas": p.mappings.count(), "completed_count": done_before(spark, ledger_path).count(), "failed_count": n["n_failed"], "ledger": ledger_at(ledger_path), "updated_at": dt.datetime.now(dt.timezone.utc)})
    return results
