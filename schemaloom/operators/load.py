"""What is sent to the target: request bodies, references, paths; what the ledger says of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaloom.functions import naming as N
from schemaloom.functions.keys import schema_key, target_key
from schemaloom.operators.mapping import full_target

REFERENCE = "array<struct<name:string,subject:string,version:int>>"


def observed_references(refs: Column, context: Column) -> Column:
    """References as older runs wrote them: the raw name with -value, in the registry's context, version 1."""
    def one(r: Column) -> Column:
        named = r.contains(":")
        name = F.when(named, F.regexp_extract(r, r"(?s)\A[^:]*:(.*)\z", 1)).otherwise(r)
        ctx = F.when(named, F.concat(F.lit("."), F.substring_index(r, ":", 1))).otherwise(context)
        return F.struct(name.alias("name"), target_key(ctx, F.concat(name, F.lit("-value"))).alias("subject"), F.lit(1).alias("version"))

    return F.transform(refs, one)


def mapped_references(refs: DataFrame, mappings: DataFrame, latest: DataFrame) -> DataFrame:
    """(src, pos, name, subject, version): references by the subjects that the mapping gave their targets.

    refs: src, pos, ref, target (resolved key). latest: source, version. One row per reference; name is the reference
    without the registry before it.
    """
    to = mappings.select(schema_key("source_registry", "source_schema_name").alias("target"), full_target().alias("subject"))
    name = F.when(F.col("ref") == F.col("target"), F.expr("substring(ref, instr(ref, ':') + 1)")).otherwise(F.col("ref"))
    return refs.where("target is not null").join(to, "target").join(latest.withColumnRenamed("source", "target"), "target", "left").select("src", "pos", name.alias("name"), "subject", F.coalesce("version", F.lit(1)).cast("int").alias("version"))


def schema_type(data_format: Column, observed: bool = False) -> Column:
    return F.lit("AVRO") if observed else F.coalesce(F.upper(data_format), F.lit("AVRO"))


def register_body(definition: Column, kind: Column, references: Column | None = None) -> Column:
    """The JSON body of a registration; absent parts are left out."""
    refs = F.when(F.size(references) > 0, references) if references is not None else F.lit(None).cast(REFERENCE)
    return F.to_json(F.struct(definition.alias("schema"), F.when(kind != "", kind).alias("schemaType"), refs.alias("references")))


def register_path() -> Column:
    return F.concat(F.lit("/subjects/"), N.path_escape(full_target()), F.lit("/versions"))


def to_send(mappings: DataFrame, ledger: DataFrame) -> DataFrame:
    """Mappings that are neither in the ledger nor in error nor skipped."""
    done = ledger.select("key").distinct()
    m = mappings.withColumn("key", schema_key("source_registry", "source_schema_name"))
    return m.join(done, "key", "left_anti").where(~F.col("status").isin("error", "skipped"))


def outcomes(levels: DataFrame, mappings: DataFrame, ledger: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """(level, n_done, n_failed, n_skipped, n_open) per dependency level."""
    m = mappings.select(schema_key("source_registry", "source_schema_name").alias("key"), "status")
    d = levels.join(m, "key").join(ledger.select("key", F.lit(True).alias("done")).distinct(), "key", "left")
    d = d.join(failed.select("key", F.lit(True).alias("failed")).distinct(), "key", "left") if failed is not None else d.withColumn("failed", F.lit(None).cast("boolean"))
    state = F.when(F.col("done"), "done").when(F.col("failed"), "failed").when(F.col("status").isin("error", "skipped"), "skipped").otherwise("open")
    d = d.select("level", state.alias("state"))
    count = lambda s: F.sum(F.when(F.col("state") == s, 1).otherwise(0)).alias(f"n_{s}")
    return d.groupBy("level").agg(*(count(s) for s in ("done", "failed", "skipped", "open")))


def progress(total: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: how many schemas, how many are in the ledger, the share in per cent, whether all are."""
    t = total.agg(F.count("*").alias("total"))
    d = ledger.select("key").distinct().agg(F.count("*").alias("completed"))
    one = F.lit(1).alias("_one")
    j = t.withColumn("_one", one).join(d.withColumn("_one", one), "_one").drop("_one")
    return j.select("total", "completed", F.when(F.col("total") == 0, 0.0).otherwise(100.0 * F.col("completed") / F.col("total")).alias("percent"), (F.col("completed") >= F.col("total")).alias("is_complete"))


def existing(mappings: DataFrame, subjects: DataFrame) -> DataFrame:
    """Mappings whose target exists already."""
    have = subjects.select(target_key("context", "name").alias("_t")).distinct()
    return mappings.withColumn("_t", full_target()).join(have, "_t", "left_semi").drop("_t")
