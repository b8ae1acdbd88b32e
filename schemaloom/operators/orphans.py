"""References to records that do not exist, were deleted or came later.

References and existence are changes to two signed counts per key: a reference adds to n_refs, a record that appears
adds 1 to n_exists and one that is deleted takes it away. The counts are sums, so changes may arrive in any order and
be merged into counts kept from before (`merge_counts`; streaming/orphans.py keeps them from a stream). A key with
references and no existence is an orphan. A reference that resolves to nothing has a key of its own, which no record has.

Defined results: null and empty references are none; a reference repeated in one record counts once in the report; a
target without a known time is never late; an empty target table makes every reference missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaloom.functions.keys import schema_key, target_key
from schemaloom.operators.diff import one_per_key
from schemaloom.operators.hierarchy import current_parsed
from schemaloom.operators.references import resolve
from schemaloom.session import table, union


COUNTS = "key string, n_refs long, n_records long, n_exists long, born timestamp"


def reference_deltas(refs: DataFrame, sign: int = 1) -> DataFrame:
    """The changes that references (refs: key, one row each) make to the counts; sign -1 where they are withdrawn."""
    return refs.select("key", F.lit(sign).cast("long").alias("n_refs"), *(F.lit(0).cast("long").alias(c) for c in ("n_records", "n_exists")), F.lit(None).cast("timestamp").alias("born"))


def record_deltas(records: DataFrame, sign: int = 1) -> DataFrame:
    """The changes that records (key, gone: deleted, born: time of appearance) make; sign -1 where they are withdrawn."""
    there = F.when(F.col("gone"), 0).otherwise(sign).cast("long")
    return records.select("key", F.lit(0).cast("long").alias("n_refs"), F.lit(sign).cast("long").alias("n_records"), there.alias("n_exists"), "born")


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Counts or changes of any number of batches as one table of counts: sums, so their order does not matter.

    Pre-aggregated before the shuffle: a key with a third of all references is one row per task.
    """
    both = union([p.select("key", "n_refs", "n_records", "n_exists", "born") for p in parts]).where("key is not null")
    return both.groupBy("key").agg(*(F.sum(c).alias(c) for c in ("n_refs", "n_records", "n_exists")), F.min("born").alias("born"))


def key_counts(refs: DataFrame, records: DataFrame) -> DataFrame:
    """(key, n_refs, n_records, n_exists, born): the signed counts per key of references and records."""
    return merge_counts(reference_deltas(refs), record_deltas(records))


def unresolved_key(registry: str, ref: str) -> Column:
    """The key of a reference that resolves to nothing: no record has it, so its existence stays zero."""
    return F.concat(F.lit("?"), F.coalesce(F.col(registry), F.lit("")), F.lit(":"), F.col(ref))


def report(refs: DataFrame, counts: DataFrame) -> DataFrame:
    """(src_table, src_key, ref, reason, at) of refs(src_table, src_key, ref, key, at) by the counts of their keys.

    Positive references and no record: missing; records of which none exists: deleted; all born later: late.
    """
    suspects = counts.where("n_refs > 0").select("key", "n_records", "n_exists", "born")
    j = refs.join(suspects, "key")
    reason = F.when(F.col("n_records") <= 0, "missing").when(F.col("n_exists") <= 0, "deleted").when(F.col("born") > F.col("at"), "late")
    return j.withColumn("reason", reason).where("reason is not null").select("src_table", "src_key", "ref", "reason", "at").distinct()


def schema_references(spark, sf_dir: str) -> DataFrame:
    """Orphans among parsed_schemas.references against glue_schemas and its versions."""
    parsed = current_parsed(spark, sf_dir)
    refs = parsed.select(schema_key("registry_name", "name").alias("src_key"), "registry_name", F.explode("references").alias("ref"), F.col("parsed_at").alias("at")).where("ref is not null and ref <> ''")
    schemas = table(spark, sf_dir, "glue_schemas", "registry_name", "name", "created_time", "updated_time").where("registry_name is not null and name is not null")
    schemas = one_per_key(schemas, ["registry_name", "name"], F.col("updated_time"))
    versions = table(spark, sf_dir, "glue_versions", "registry_name", "schema_name", "status")
    gone = versions.groupBy(F.col("registry_name"), F.col("schema_name").alias("name")).agg(F.min(F.when(F.col("status") == "DELETING", 1).otherwise(0)).alias("all_deleting"))
    records = schemas.join(gone, ["registry_name", "name"], "left").select(schema_key("registry_name", "name").alias("key"), (F.coalesce("all_deleting", F.lit(0)) == 1).alias("gone"), F.col("created_time").alias("born"))
    keyed = refs.join(resolve(refs, schemas), ["registry_name", "ref"]).select(F.lit("parsed_schemas").alias("src_table"), "src_key", "ref", F.coalesce("target", unresolved_key("registry_name", "ref")).alias("key"), "at")
    return report(keyed, key_counts(keyed, records))


def request_references(spark, sf_dir: str) -> DataFrame:
    """Orphans among requests.references against subjects and the requests themselves."""
    requests = table(spark, sf_dir, "requests", "request_id", "context", "subject", "references", "requested_at")
    ref = F.col("r.subject")
    key = F.when(ref.contains(":"), ref).otherwise(target_key(F.col("context"), ref))
    refs = requests.select("request_id", "context", F.explode("references").alias("r"), "requested_at").select(F.lit("requests").alias("src_table"), F.col("request_id").alias("src_key"), ref.alias("ref"), key.alias("key"), F.col("requested_at").alias("at")).where("ref is not null and ref <> ''").distinct()
    first = requests.select(target_key("context", "subject").alias("key"), "requested_at").groupBy("key").agg(F.min("requested_at").alias("born"))
    subjects = table(spark, sf_dir, "subjects", "context", "name", "versions.version").select(target_key("context", "name").alias("key"), F.coalesce(F.size("version"), F.lit(0)).alias("n")).groupBy("key").agg(F.max("n").alias("n"))
    records = subjects.join(first, "key", "left").select("key", (F.col("n") <= 0).alias("gone"), "born")
    return report(refs, key_counts(refs, records))


def orphan_references(spark, sf_dir: str) -> DataFrame:
    """p5_found(src_table, src_key, ref, reason)."""
    return schema_references(spark, sf_dir).unionByName(request_references(spark, sf_dir)).drop("at").distinct()


def orphans_per_month(spark, sf_dir: str) -> DataFrame:
    """How many orphan references per table, month of the referring record and reason."""
    both = schema_references(spark, sf_dir).unionByName(request_references(spark, sf_dir))
    return both.groupBy("src_table", F.date_format("at", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("n_orphans"))
