"""Deeply nested records to related flat tables.

Each record's text is stream-parsed into path-value-ordinal triples, the triples are grouped by their repeated ancestor
and each group is pivoted into one table whose rows keep the ordinals of their parents. Everything about one record
happens in the task that read it: no shuffle, and never more than one record in memory, of any depth.

Defined results: a record that is null, empty or does not parse gives no rows (`unparsed` counts those); repeated
records give repeated rows under their own id (the p2 queries return distinct ones); empty objects and arrays appear
as the step `@empty`; of members repeated in one object the last one counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.functions import definitions as D
from schemaloom.functions import stream as S
from schemaloom.operators.diff import one_per_key
from schemaloom.session import table

TRIPLES = "id string, path string, ordinals array<int>, value string"
FIELDS = "id string, field_no int, parent_no int, name string, field_path string, depth int, type string"


#: Characters after which a batch of rows goes out: deep records have long paths.
BATCH_CHARS = 1 << 24


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


def _per_record(kernel, schema: pa.Schema, chars: int):
    """A mapInArrow function that gives kernel(id, text) -> rows of every record; column `chars` sets the batches' size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        D.allow_depth()
        one = kernel()
        for batch in batches:
            out, size = [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for r in one(i, text):
                    out.append(r)
                    size += len(r[chars])
                    if size > BATCH_CHARS:
                        yield _emit(out, schema)
                        out, size = [], 0
            yield _emit(out, schema)

    return run


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")


def to_triples(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, path, ordinals, value) of every scalar of a JSON column, values as text; path steps are joined by `/`."""

    def kernel():
        paths = D.Paths()

        def one(i, text):
            t = D.json_text(text)
            found = S.record_triples(t, paths.root) if t else []
            paths.take(len(found))
            for path, row, v in found:
                if path.note is None:
                    path.note = "/".join(path.steps())
                yield i, path.note, row.ordinals(), v if v is None or isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)

        return one

    return _texts(df, id_col, text_col).mapInArrow(_per_record(kernel, pa.schema([("id", pa.string()), ("path", pa.string()), ("ordinals", pa.list_(pa.int32())), ("value", pa.string())]), 1), TRIPLES)


def group_table(triples: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """One flat table out of triples: the rows of the repeated ancestor `group` with the named columns.

    (id, row_ordinals, parent_ordinals, columns...). row_ordinals is the row's key within its record and
    parent_ordinals that of its parent, so the tables of different groups join on (id, parent_ordinals).
    """
    at = f"{group}/" if group else ""
    t = triples.where(F.col("path").startswith(at)).withColumn("column", F.substring(F.col("path"), len(at) + 1, 1 << 20))
    t = t.where(F.col("column").isin(*columns))
    agg = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
    out = t.groupBy("id", F.col("ordinals").alias("row_ordinals")).agg(*agg)
    return out.withColumn("parent_ordinals", F.slice("row_ordinals", 1, F.greatest(F.size("row_ordinals") - 1, F.lit(0)))).select("id", "row_ordinals", "parent_ordinals", *columns)


def definition_fields(df: DataFrame, id_col: str, text_col: str, min_depth: int = 1) -> DataFrame:
    """The fields of Avro and JSON Schema definitions at every depth, linked to their parents.

    field_path joins names with `.` and marks the way into the objects of arrays and maps with `[]` and `{}`. Only
    rows of min_depth names or more are returned, which saves their way out of Python.
    """

    def kernel():
        paths = D.Paths()
        return lambda i, text: ((i, *r) for r in D.field_rows(text, paths) if r[4] >= min_depth)

    return _texts(df, id_col, text_col).mapInArrow(_per_record(kernel, pa.schema([("id", pa.string()), ("field_no", pa.int32()), ("parent_no", pa.int32()), ("name", pa.string()), ("field_path", pa.string()), ("depth", pa.int32()), ("type", pa.string())]), 4), FIELDS)


def nested_fields(spark, sf_dir: str) -> DataFrame:
    """p2_found(schema_version_id, field_path): fields whose path holds three or more names."""
    fields = definition_fields(table(spark, sf_dir, "glue_versions", "schema_version_id", "definition"), "schema_version_id", "definition", 3)
    return fields.select(F.col("id").alias("schema_version_id"), "field_path").distinct()


def _definitions(spark, sf_dir: str) -> DataFrame:
    """Each stored version's text once: repeated deliveries go before anything is parsed or multiplied."""
    v = table(spark, sf_dir, "glue_versions", "schema_version_id", "definition").where("schema_version_id is not null and definition is not null")
    return v.groupBy("schema_version_id", F.md5("definition").alias("print")).agg(F.first("definition").alias("definition"))


def all_fields(spark, sf_dir: str) -> DataFrame:
    """Every field of every version with its parent's number, one row per field."""
    return definition_fields(_definitions(spark, sf_dir), "schema_version_id", "definition").withColumnRenamed("id", "schema_version_id")


def unparsed(spark, sf_dir: str) -> DataFrame:
    """Per registry and format, the versions whose definition is null or does not parse: what gives no rows is counted."""
    kind = F.when(F.col("definition").isNull(), "null").when(F.trim("definition") == "", "empty")
    v = table(spark, sf_dir, "glue_versions", "registry_name", "schema_name", "schema_version_id", "definition").distinct()
    formats = table(spark, sf_dir, "glue_schemas", "registry_name", "name", "data_format", "updated_time").withColumnRenamed("name", "schema_name")
    formats = one_per_key(formats, ["registry_name", "schema_name"], F.col("updated_time")).select("registry_name", "schema_name", "data_format")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        D.allow_depth()
        for b in batches:
            yield pa.record_batch([*b.columns[:3], pa.array([t is not None and D.load(t) is None for t in b.column(3).to_pylist()])], names=["registry_name", "schema_name", "state", "is_damaged"])

    judged = v.select("registry_name", "schema_name", kind.alias("state"), F.when(kind.isNull(), F.col("definition")).alias("definition"))
    judged = judged.mapInArrow(run, "registry_name string, schema_name string, state string, is_damaged boolean").join(formats, ["registry_name", "schema_name"], "left")
    state = F.coalesce("state", F.when(F.col("is_damaged") & F.col("data_format").isin("AVRO", "JSON"), "damaged"))
    return judged.withColumn("state", state).where("state is not null").groupBy("registry_name", "data_format", "state").agg(F.count("*").alias("n_versions"))


def top_level_table(spark, sf_dir: str) -> DataFrame:
    """The table of the group `fields/[]`: the top-level fields of Avro definitions, straight from triples."""
    t = to_triples(_definitions(spark, sf_dir), "schema_version_id", "definition")
    return group_table(t, "fields/[]", ["name", "type", "doc"]).select("id", F.col("row_ordinals")[0].alias("ordinal"), "name", "type", "doc").where("name is not null")
