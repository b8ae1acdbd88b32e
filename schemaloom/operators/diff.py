"""Differences between two copies of a dataset, by shared key ordinals and presence bitmaps.

Both copies are brought together by a hash of their key into buckets of some ten thousand keys. Within a bucket every
key of either side gets the same dense ordinal; a presence bitmap per side then gives the missing rows by AND-NOT, and
the intersection gives the ordinals by which the columns of both sides are gathered and compared, column by column.

Defined results: a null key takes part in nothing (it names no row); null equals null and differs from any value;
rows repeated under one key count once (the greatest in `prefer` order where given, ties by the greatest values); an empty
side makes all rows of the other missing. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaloom.functions.bitmap import Bitmap
from schemaloom.functions.keys import compatibility_level, schema_key, target_key
from schemaloom.session import Workspace, table

#: Keys to a bucket on average. A bucket is one Arrow group in a task: some MB, whatever the size of the input.
BUCKET_KEYS = 16_384


def bucket_count(rows: int) -> int:
    return max(1, -(-rows // BUCKET_KEYS))


def _compare(fields: Sequence[str], missing_right: str, missing_left: str):
    def run(group: pa.Table) -> pa.Table:
        keys, side = group.column("key").combine_chunks(), group.column("side").to_numpy()
        coded = keys.dictionary_encode()
        ordinal, size = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary)
        where = [np.flatnonzero(side == s) for s in (0, 1)]
        left, right = (Bitmap.of(ordinal[w], size) for w in where)
        found: list[tuple[np.ndarray, str]] = [((left - right).ordinals(), missing_right), ((right - left).ordinals(), missing_left)]
        both = (left & right).ordinals()
        if len(both) and fields:
            place = np.zeros((2, size), dtype=np.int64)
            for s in (0, 1):
                place[s, ordinal[where[s]]] = where[s]
            a, b = group.take(pa.array(place[0, both])), group.take(pa.array(place[1, both]))
            for f in fields:
                x, y = a.column(f"v_{f}"), b.column(f"v_{f}")
                same = pc.fill_null(pc.equal(x, y), False)
                differ = pc.invert(pc.or_(same, pc.and_(pc.is_null(x), pc.is_null(y))))
                found.append((both[np.asarray(differ)], f))
        out_keys = pa.concat_arrays([coded.dictionary.take(pa.array(o)) for o, _ in found])
        return pa.table({"key": out_keys.cast(pa.string()), "field": pa.array([f for o, f in found for _ in range(len(o))], pa.string())})

    return run


def diff_copies(left: DataFrame, right: DataFrame, fields: Sequence[str] = (), *, rows: int, missing_right: str = "missing_right", missing_left: str = "missing_left") -> DataFrame:
    """(key, field): one row per difference between two copies.

    left and right have `key` (string) and the columns `fields`, whose values are compared as strings; `rows` is an
    upper estimate of the keys, which only sets the number of buckets. Keys must be unique per side: see one_per_key.
    """
    def side(df: DataFrame, no: int) -> DataFrame:
        return df.where(F.col("key").isNotNull()).select("key", F.lit(no).alias("side"), *(F.col(f).cast("string").alias(f"v_{f}") for f in fields))

    both = side(left, 0).unionByName(side(right, 1)).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(bucket_count(rows))))
    return both.groupBy("bucket").applyInArrow(_compare(tuple(fields), missing_right, missing_left), "key string, field string")


def presence_bitmaps(left: DataFrame, right: DataFrame, *, rows: int) -> DataFrame:
    """(bucket, n_keys, only_left, only_right, both, left_bitmap, right_bitmap): the compressed bitmaps themselves."""
    def run(group: pa.Table) -> pa.Table:
        coded = group.column("key").combine_chunks().dictionary_encode()
        ordinal, size, side = coded.indices.to_numpy(zero_copy_only=False), len(coded.dictionary), group.column("side").to_numpy()
        a, b = Bitmap.of(ordinal[side == 0], size), Bitmap.of(ordinal[side == 1], size)
        return pa.table({"bucket": [group.column("bucket")[0].as_py()], "n_keys": [size], "only_left": [len(a - b)], "only_right": [len(b - a)], "both": [len(a & b)], "left_bitmap": pa.array([a.dumps()], pa.binary()), "right_bitmap": pa.array([b.dumps()], pa.binary())})

    sides = [df.where(F.col("key").isNotNull()).select("key", F.lit(no).alias("side")).distinct() for no, df in enumerate((left, right))]
    both = sides[0].unionByName(sides[1]).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(bucket_count(rows))))
    return both.groupBy("bucket").applyInArrow(run, "bucket long, n_keys long, only_left long, only_right long, both long, left_bitmap binary, right_bitmap binary")


def one_per_key(df: DataFrame, key: Sequence[str], prefer: Column | None = None) -> DataFrame:
    """One row per key: the one with the greatest `prefer`, ties by the greatest values. Pre-aggregates before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    best = F.max(F.struct(*([prefer.alias("_prefer")] if prefer is not None else []), *rest)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *(F.col(f"_best.{c}").alias(c) for c in rest))


# --- the catalog's own comparison -------------------------------------------------------------------


def text_print(c: Column) -> Column:
    """128 bits of a text without its white space: texts that differ in white space only have one print."""
    return F.md5(F.regexp_replace(c, r"(?U)\s+", ""))


def _pair_key(key: str, source: str | Column) -> Column:
    """One string for a target key and one of its sources; the target key's length goes first, so that it can be told."""
    source = F.col(source) if isinstance(source, str) else source
    return F.concat(F.length(key).cast("string"), F.lit(":"), F.col(key), F.coalesce(source.cast("string"), F.lit("")))


def _target_of(pair: str) -> Column:
    length = F.substring_index(pair, ":", 1)
    return F.substring(F.col(pair), F.length(length) + 2, length.cast("int"))


def catalog_differences(spark, sf_dir: str) -> DataFrame:
    """p1_found(target_key, field) over mappings, glue_schemas, glue_versions, subjects and completed.

    Two runs of diff_copies: one with a row per (subject, source mapped to it), one with a row per (subject, version
    number), whose text is the one that came in last. A definition that is null has no text to compare: against a
    stored text it is a difference.
    """
    work = Workspace(spark, "diff")
    rows = table(spark, sf_dir, "mappings").count() + table(spark, sf_dir, "subjects").count()
    versions_rows = table(spark, sf_dir, "glue_versions").count()

    mapped = table(spark, sf_dir, "mappings", "source_registry", "source_schema_name", "target_context", "target_subject", "status").where(F.col("status").isin("ready", "warning"))
    mapped = mapped.select(target_key("target_context", "target_subject").alias("key"), schema_key("source_registry", "source_schema_name").alias("source")).where("key is not null").distinct()

    schemas = table(spark, sf_dir, "glue_schemas", "registry_name", "name", "compatibility", "data_format", "updated_time")
    schemas = one_per_key(schemas.select(schema_key("registry_name", "name").alias("source"), compatibility_level(F.col("compatibility")).alias("compatibility"), F.upper("data_format").alias("schema_type"), "updated_time"), ["source"], F.col("updated_time")).drop("updated_time")
    ledger = table(spark, sf_dir, "completed", "key", "versions", "completed_at")
    ledger = one_per_key(ledger.select(F.col("key").alias("source"), F.col("versions").alias("ledger_versions"), "completed_at"), ["source"], F.col("completed_at")).select("source", "ledger_versions", F.lit(True).alias("in_ledger"))
    expected = mapped.join(schemas, "source", "left").join(ledger, "source", "left")

    stored = table(spark, sf_dir, "subjects", "context", "name", "compatibility", "schema_type", "versions.version")
    stored = stored.select(target_key("context", "name").alias("key"), compatibility_level(F.col("compatibility")).alias("compatibility"), F.upper("schema_type").alias("schema_type"), F.coalesce(F.size("version"), F.lit(0)).alias("n_versions"))
    stored = work.save(one_per_key(stored.where("key is not null"), ["key"]))

    fields = ["compatibility", "schema_type", "completed", "completed_versions"]
    # Several sources may be mapped to one target: each is compared with what is stored, under a key of its own.
    held = stored.select("key", F.col("compatibility").alias("held_compatibility"), F.col("schema_type").alias("held_schema_type"), "n_versions", F.lit(True).alias("is_held"))
    expected = work.save(expected.join(held, "key", "left"))
    pair = _pair_key("key", "source").alias("key")
    # The ledger's two findings are comparisons too: what the ledger says against what the target holds.
    left = expected.select(pair, "compatibility", "schema_type", F.coalesce("in_ledger", F.lit(False)).alias("completed"), F.when(F.col("in_ledger"), F.col("ledger_versions")).otherwise(F.col("n_versions")).alias("completed_versions"))
    right = expected.where("is_held").select(pair, F.col("held_compatibility").alias("compatibility"), F.col("held_schema_type").alias("schema_type"), F.lit(True).alias("completed"), F.col("n_versions").alias("completed_versions"))
    unmapped = stored.join(mapped.select("key").distinct(), "key", "left_anti")
    right = right.unionByName(unmapped.select(_pair_key("key", F.lit(None)).alias("key"), "compatibility", "schema_type", F.lit(True).alias("completed"), F.col("n_versions").alias("completed_versions")))
    subject_level = diff_copies(left, right, fields, rows=rows, missing_right="subject", missing_left="source")
    subject_level = subject_level.select(_target_of("key").alias("key"), "field")

    shared = expected.where("is_held").select("key", "source")
    defined = table(spark, sf_dir, "glue_versions", "registry_name", "schema_name", "version_number", "definition", "status", "ingested_at").where("status = 'AVAILABLE'")
    defined = defined.select(schema_key("registry_name", "schema_name").alias("source"), "version_number", text_print(F.col("definition")).alias("schema"), "ingested_at")
    defined = defined.join(shared, "source").select("key", "version_number", "schema", "ingested_at")
    held = table(spark, sf_dir, "subjects", "context", "name", "versions").select(target_key("context", "name").alias("key"), F.explode("versions").alias("v"))
    held = held.select("key", F.col("v.version").cast("long").alias("version_number"), text_print(F.col("v.schema")).alias("schema"))
    held = held.join(shared.select("key").distinct(), "key", "left_semi")
    split = "\n"
    def by_version(df: DataFrame, prefer: Column | None) -> DataFrame:
        return one_per_key(df, ["key", "version_number"], prefer).select(F.concat_ws(split, "key", F.col("version_number").cast("string")).alias("key"), "schema")
    version_level = diff_copies(by_version(defined, F.col("ingested_at")), by_version(held, None), ["schema"], rows=2 * versions_rows, missing_right="versions", missing_left="versions")
    version_level = version_level.select(F.regexp_extract("key", r"(?s)\A(.*)\n[^\n]*\z", 1).alias("key"), "field")
    return subject_level.unionByName(version_level).select(F.col("key").alias("target_key"), "field").distinct()


def differences_by_field(spark, sf_dir: str) -> DataFrame:
    """How many targets differ in each field."""
    return catalog_differences(spark, sf_dir).groupBy("field").agg(F.count("*").alias("n_targets"))


def catalog_presence(spark, sf_dir: str) -> DataFrame:
    """How many expected and stored targets there are on one side only and on both, by the presence bitmaps."""
    rows = table(spark, sf_dir, "mappings").count() + table(spark, sf_dir, "subjects").count()
    expected = table(spark, sf_dir, "mappings", "target_context", "target_subject", "status").where(F.col("status").isin("ready", "warning")).select(target_key("target_context", "target_subject").alias("key"))
    stored = table(spark, sf_dir, "subjects", "context", "name").select(target_key("context", "name").alias("key"))
    counts = presence_bitmaps(expected, stored, rows=rows).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_keys", "only_left", "only_right", "both")))
    return counts.select("n_keys", F.col("only_left").alias("only_expected"), F.col("only_right").alias("only_stored"), "both")
