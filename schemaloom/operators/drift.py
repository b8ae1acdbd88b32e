"""Schemas that drift between versions: fingerprints, migration steps, one consistent table, routing through the chain.

Versions are range-partitioned by (schema, version number), so that even a schema with a third of all versions spreads
over many tasks; each task streams its sorted slice and compares neighbours by fingerprint first, field by field only
where the fingerprints differ. What joins the slices up is two rows per slice, grouped by schema: a schema that many
slices share has as many such rows, any other has none or two.

- fingerprints: one per version, a table to keep; with a kept one only schemas that moved on are looked at again.
- migration_steps: what each version changed. rules turns them into rename, default, cast and drop rules per version.
- consistent_fields: the fields of all versions under identities that outlive renames, that is the steps composed.
- routes: for every version the composed chain into the newest shape; route sends data of any version through it.

Defined results: only AVAILABLE versions with a parsable Avro or JSON Schema definition take part; a version delivered
again counts once (the latest delivery); a schema with one such version has no changes; nulls are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaloom.functions import definitions as D
from schemaloom.operators.diff import one_per_key
from schemaloom.session import Workspace, table

STEPS = "registry_name string, schema_name string, version_number long, field_path string, change string, old_path string, new_type string"
_KEYS = ["registry_name", "schema_name", "version_number"]
_NAMES = [x.split()[0] for x in STEPS.split(", ")]
_EDGE_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_EDGE_TYPES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, _EDGE_TYPES)], names=[*_NAMES, "slice", "seq", "definition"])


def _steps(before: tuple, key: tuple, fields: dict, mark: str) -> list[tuple]:
    """The migration steps from one version to the next; before is (key, fields, fingerprint)."""
    if before[2] == mark:
        return []
    return [(*key, path, change, old, new) for path, change, old, new in D.changes(before[1], fields)]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    D.allow_depth()
    part = TaskContext.get().partitionId()
    before = first = last_text = None
    for batch in batches:
        rows: list[tuple] = []
        cols = [batch.column(i).to_pylist() for i in range(4)]
        for registry, name, version, text in zip(*cols):
            key = (registry, name, version)
            if before is not None and before[0] == key:
                continue
            doc = D.load(text)
            fields = D.field_tree(doc) if doc is not None else None
            if fields is None:
                continue
            mark = D.fingerprint(fields)
            if before is None:
                first = key
                rows.append((*key, None, None, None, None, part, 0, text))
            elif before[0][:2] == key[:2]:
                rows += [(*r, None, None, None) for r in _steps(before, key, fields, mark)]
            before, last_text = (key, fields, mark), text
        yield _batch(rows)
    if before is not None and before[0] != first:
        yield _batch([(*before[0], None, None, None, None, part, 1, last_text)])


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes steps through; compares the last version of each slice with the first of the next of the same schema."""
    D.allow_depth()
    edges: list[tuple] = []
    for batch in batches:
        is_edge = pc.is_valid(batch.column(7))
        edges += [tuple(r.values()) for r in batch.filter(is_edge).to_pylist()]
        yield batch.filter(pc.invert(is_edge)).select(_NAMES)
    before, rows = None, []
    for e in sorted(edges, key=lambda e: (e[0], e[1], e[7], e[8])):
        key, at = e[:3], e[7]
        if before is not None and before[0] == key:
            before = (*before[:3], at)
            continue
        fields = D.field_tree(D.load(e[9]))
        mark = D.fingerprint(fields)
        if before is not None and before[0][:2] == key[:2] and before[3] != at:
            rows += _steps(before, key, fields, mark)
        before = (key, fields, mark, at)
    yield _batch([(*r, None, None, None) for r in rows]).select(_NAMES)


def migration_steps(versions: DataFrame) -> DataFrame:
    """(schema, version_number, field_path, change, old_path, new_type): what each version changed.

    versions: registry_name, schema_name, version_number, definition, status, ingested_at. change is added, removed,
    renamed or type_changed; old_path is the path before and new_type the type after (of a removed field, its own).
    """
    found = _sliced(versions).mapInArrow(_within, STEPS + ", slice int, seq int, definition string")
    # The edge rows of a schema meet in one task, the steps go anywhere.
    where = F.when(F.col("slice").isNotNull(), F.xxhash64("registry_name", "schema_name")).otherwise(F.xxhash64("registry_name", "schema_name", "version_number"))
    return found.repartition(where).mapInArrow(_between, STEPS)


def _sliced(versions: DataFrame) -> DataFrame:
    """The versions that take part, range-partitioned and sorted by schema and version number."""
    v = _taking_part(versions)
    order = [*(F.col(k) for k in _KEYS), F.col("ingested_at").desc_nulls_last()]
    return v.select(*_KEYS, "definition", "ingested_at").repartitionByRange(*order).sortWithinPartitions(*order).select(*_KEYS, "definition")


def _taking_part(versions: DataFrame) -> DataFrame:
    """The AVAILABLE versions with text that may be JSON."""
    return versions.where((F.col("status") == "AVAILABLE") & F.col("definition").rlike(r"\A[\s﻿]*[{\[]") & F.col("version_number").isNotNull() & F.col("registry_name").isNotNull() & F.col("schema_name").isNotNull())


# --- one consistent table --------------------------------------------------------------------------------

TRACE = "registry_name string, schema_name string, version_number long, field_path string, type string, default_text string, field_id string, slice int, is_head boolean, seq int, definition string, ids array<string>"
_TRACE_NAMES = [x.split()[0] for x in TRACE.split(", ")]
_TRACE_TYPES = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.string(), pa.list_(pa.string())]


def _types(fields: dict) -> dict[str, str]:
    return {p: n.type for p, n in D.flat_fields(fields)}


def _carry(before: dict, fields: dict, ids: dict[str, str], version: int, types: dict[str, str]) -> dict[str, str]:
    """The identity of each field: that of the field it continues, else its path and the version that brought it."""
    kept: list = []
    D.changes(before, fields, kept=kept)
    old = dict(kept)
    return {p: ids.get(old[p], f"{p}@{version}") if p in old else f"{p}@{version}" for p in types}


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fields of every version with an identity that survives renames, within one slice of the sorted versions."""
    D.allow_depth()
    part = TaskContext.get().partitionId()
    now = first = None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * len(_TRACE_TYPES)
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, _TRACE_TYPES)], names=_TRACE_NAMES)

    for b in batches:
        rows: list[tuple] = []
        for registry, name, version, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            key = (registry, name, version)
            if now is not None and now[0] == key:
                continue
            doc = D.load(text)
            fields = D.field_tree(doc) if doc is not None else None
            if fields is None:
                continue
            types = _types(fields)
            if now is None:
                first = key
                rows.append((*key, None, None, None, None, part, None, 0, text, None))
            ids = _carry(now[1], fields, now[2], version, types) if now is not None and now[0][:2] == key[:2] else {p: f"{p}@{version}" for p in types}
            head = key[:2] == first[:2]
            rows += [(*key, p, n.type, n.default, ids[p], part, head, None, None, None) for p, n in D.flat_fields(fields)]
            now = (key, fields, ids, text)
        yield batch(rows)
    if now is not None:
        yield batch([(*now[0], None, None, None, None, part, None, 1, now[3], [x for pair in now[2].items() for x in pair])])


def _compose(edges: pa.Table) -> pa.Table:
    """(slice, field_id, earlier_id): identities of one schema that go back beyond the start of a slice.

    edges: where slices start or end with a version of the schema.
    """
    D.allow_depth()
    out: list[tuple] = []
    end, started = None, (None, {})
    for r in sorted(edges.to_pylist(), key=lambda r: (r["slice"], r["seq"])):
        key, fields = tuple(r[k] for k in _KEYS), D.field_tree(D.load(r["definition"]))
        if r["seq"] == 0:
            earlier: dict[str, str] = {}
            if end is not None:
                types = _types(fields)
                ids = dict(end[2]) if end[0] == key else _carry(end[1], fields, end[2], key[2], types)
                earlier = {f"{p}@{key[2]}": ids[p] for p in types if p in ids and ids[p] != f"{p}@{key[2]}"}
                out += [(r["slice"], a, b) for a, b in earlier.items()]
            started = (r["slice"], earlier)
        else:
            flat = r["ids"] or []
            earlier = started[1] if started[0] == r["slice"] else {}
            end = (key, fields, {p: earlier.get(i, i) for p, i in zip(flat[::2], flat[1::2])})
    cols = list(zip(*out)) if out else [[], [], []]
    return pa.table({"slice": pa.array(cols[0], pa.int32()), "field_id": pa.array(cols[1], pa.string()), "earlier_id": pa.array(cols[2], pa.string())})


def consistent_fields(versions: DataFrame) -> DataFrame:
    """(schema, version_number, field_path, type, default_text, field_id): each version's fields under lasting identities.

    field_id is the path and version under which the field first appeared. Versions are sliced as for
    migration_steps; the identities across slices are composed from two edge rows per slice, schema by schema.
    """
    work = Workspace(versions.sparkSession, "drift")
    seen = work.save(_sliced(versions).mapInArrow(_trace, TRACE))
    edges = seen.where("seq is not null").select(*_KEYS, "slice", "seq", "definition", "ids")
    earlier = edges.groupBy("registry_name", "schema_name").applyInArrow(_compose, "slice int, field_id string, earlier_id string")
    rows = seen.where("seq is null")
    head = rows.where("is_head").join(earlier, ["slice", "field_id"], "left").withColumn("field_id", F.coalesce("earlier_id", "field_id"))
    columns = [*_KEYS, "field_path", "type", "default_text", "field_id"]
    return head.select(*columns).unionByName(rows.where("not is_head").select(*columns))


# --- fingerprints, rules, routing ----------------------------------------------------------------------------


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    D.allow_depth()
    for b in batches:
        docs = [D.load(t) for t in b.column(3).to_pylist()]
        trees = [D.field_tree(d) if d is not None else None for d in docs]
        yield pa.record_batch([*b.columns[:3], pa.array([D.fingerprint(t) if t is not None else None for t in trees], pa.string())], names=[*_KEYS, "fingerprint"])


def fingerprints(versions: DataFrame) -> DataFrame:
    """(schema, version_number, fingerprint): one per version, for a table to keep between runs."""
    latest = one_per_key(_taking_part(versions).select(*_KEYS, "definition", "ingested_at"), _KEYS, F.col("ingested_at"))
    return latest.select(*_KEYS, "definition").mapInArrow(_prints, ", ".join(STEPS.split(", ")[:3]) + ", fingerprint string").where("fingerprint is not null")


def moved_on(versions: DataFrame, kept: DataFrame) -> DataFrame:
    """The versions of schemas whose fingerprints differ from the kept ones: what has to be looked at again."""
    now = fingerprints(versions)
    both = now.join(kept.select(*_KEYS, F.col("fingerprint").alias("was")), _KEYS, "full")
    moved = both.where(~F.col("fingerprint").eqNullSafe(F.col("was"))).select("registry_name", "schema_name").distinct()
    return versions.join(moved, ["registry_name", "schema_name"], "left_semi")


def rules(steps: DataFrame, fields: DataFrame) -> DataFrame:
    """(schema, version_number, rule, old_path, new_path, argument): the steps as what to do with data of the version before.

    rule is rename, default (argument: the new field's default as JSON text, null where it has none), cast (argument:
    the type after) or drop. In each version renames come first, then defaults, casts and drops. fields are those of
    consistent_fields.
    """
    have = fields.select(*_KEYS, F.col("field_path"), "default_text")
    kind = F.create_map(*(F.lit(x) for pair in (("renamed", "rename"), ("added", "default"), ("type_changed", "cast"), ("removed", "drop")) for x in pair))
    s = steps.join(have, [*_KEYS, "field_path"], "left")
    rule = kind[F.col("change")]
    argument = F.when(rule == "default", F.col("default_text")).when(rule == "cast", F.col("new_type"))
    new = F.when(rule != "drop", F.col("field_path"))
    return s.select(*_KEYS, rule.alias("rule"), F.when(rule != "default", F.coalesce("old_path", "field_path")).alias("old_path"), new.alias("new_path"), argument.alias("argument"))


def routes(fields: DataFrame) -> DataFrame:
    """The chain of rules from every version into the newest one of its schema, composed.

    (schema, version_number, old_path, new_path, new_type, rule, default_text): one row per field of the version and per
    field of the newest that it lacks. rule is keep, rename, cast, rename and cast, drop (no new_path) or default (no
    old_path). fields are those of consistent_fields.
    """
    schema = ["registry_name", "schema_name"]
    newest = fields.groupBy(*schema).agg(F.max("version_number").alias("newest"))
    now = fields.join(newest, schema).where("version_number = newest").select(*schema, "field_id", F.col("field_path").alias("new_path"), F.col("type").alias("new_type"), F.col("default_text").alias("new_default"))
    # Each version is set against the newest shape; keyed by version as well, so that a schema of very many spreads.
    wanted = fields.select(*_KEYS).distinct().join(now, schema)
    own = fields.select(*_KEYS, "field_id", F.col("field_path").alias("old_path"), F.col("type").alias("old_type"))
    j = own.join(wanted, [*_KEYS, "field_id"], "full")
    renamed, cast = F.col("old_path") != F.col("new_path"), F.col("old_type") != F.col("new_type")
    rule = F.when(F.col("new_path").isNull(), "drop").when(F.col("old_path").isNull(), "default").when(renamed & cast, "rename and cast").when(renamed, "rename").when(cast, "cast").otherwise("keep")
    return j.select(*_KEYS, "old_path", "new_path", "new_type", rule.alias("rule"), F.when(F.col("old_path").isNull(), F.col("new_default")).alias("default_text"))


#: Which plain types a value is cast to, and by what.
CASTS = {"int": "int", "long": "bigint", "integer": "bigint", "float": "float", "double": "double", "number": "double", "boolean": "boolean"}


def as_type(value: Column, kind: Column) -> Column:
    """A value as text in the spelling of a plain type; null if it cannot be one, as it is where the type is none of CASTS."""
    plain = F.regexp_replace(F.regexp_replace(kind, r"\?\z", ""), ":.*", "")
    out = value
    for name, to in CASTS.items():
        out = F.when(plain == name, value.try_cast(to).cast("string")).otherwise(out)
    return out


def route(data: DataFrame, routes: DataFrame) -> DataFrame:
    """(schema, version_number, row_id, field_path, value, rule): data of any version in the newest shape of its schema.

    data: registry_name, schema_name, version_number, row_id, field_path, value (text). Values are renamed and cast, the
    fields that the version lacks are filled with their defaults; a value that does not cast becomes null, one whose field
    is gone stays out. Every row says by which rule it came.
    """
    r = routes.withColumnRenamed("old_path", "field_path")
    moved = data.select(*_KEYS, "row_id", "field_path", "value").join(r.where("new_path is not null and field_path is not null"), [*_KEYS, "field_path"])
    moved = moved.select(*_KEYS, "row_id", F.col("new_path").alias("field_path"), as_type(F.col("value"), F.col("new_type")).alias("value"), "rule")
    filled = data.select(*_KEYS, "row_id").distinct().join(r.where("rule = 'default'"), _KEYS)
    plain = F.when(F.col("default_text").startswith('"'), F.from_json(F.concat(F.lit('{"v":'), F.col("default_text"), F.lit("}")), "v string")["v"]).when(F.col("default_text") != "null", F.col("default_text"))
    return moved.unionByName(filled.select(*_KEYS, "row_id", F.col("new_path").alias("field_path"), plain.alias("value"), "rule"))


def field_table(spark, sf_dir: str) -> DataFrame:
    """One row per field of a schema across all its versions: its name and type now, its life, its names and types."""
    f = consistent_fields(_versions(spark, sf_dir))
    last = F.max_by(F.struct("field_path", "type"), "version_number").alias("now")
    g = f.groupBy("registry_name", "schema_name", "field_id").agg(last, F.min("version_number").alias("first_version"), F.max("version_number").alias("last_version"), F.count("*").alias("n_versions"), F.countDistinct("field_path").alias("n_names"), F.countDistinct("type").alias("n_types"))
    return g.select("registry_name", "schema_name", "field_id", F.col("now.field_path").alias("field_path"), F.col("now.type").alias("type"), "first_version", "last_version", "n_versions", "n_names", "n_types")


def _versions(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "glue_versions", *_KEYS, "definition", "status", "ingested_at")


def schema_changes(spark, sf_dir: str) -> DataFrame:
    """p3_found(registry_name, schema_name, version_number, field_path, change)."""
    return migration_steps(_versions(spark, sf_dir)).select(*_KEYS, "field_path", "change").distinct()


def changes_with_compatibility(spark, sf_dir: str) -> DataFrame:
    """Each migration step next to the compatibility that its schema promises."""
    schemas = table(spark, sf_dir, "glue_schemas", "registry_name", "name", "compatibility", "updated_time").withColumnRenamed("name", "schema_name")
    current = one_per_key(schemas, ["registry_name", "schema_name"], F.col("updated_time")).drop("updated_time")
    return migration_steps(_versions(spark, sf_dir)).join(current, ["registry_name", "schema_name"], "left")


def changes_per_registry(spark, sf_dir: str) -> DataFrame:
    """How many changes of each kind the versions of a registry brought."""
    return migration_steps(_versions(spark, sf_dir)).groupBy("registry_name", "change").agg(F.count("*").alias("n_changes"), F.countDistinct("schema_name").alias("n_schemas"))


def version_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Each version with its fingerprint."""
    return fingerprints(_versions(spark, sf_dir))


def _fields_and_steps(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    work, v = Workspace(spark, "rules"), _versions(spark, sf_dir)
    return work.save(consistent_fields(v)), migration_steps(v)


def version_rules(spark, sf_dir: str) -> DataFrame:
    """The rename, default, cast and drop rules that lead from each version to the next."""
    fields, steps = _fields_and_steps(spark, sf_dir)
    return rules(steps, fields)


def routed_defaults(spark, sf_dir: str) -> DataFrame:
    """Every version's record of defaults, routed through the chain into the newest shape of its schema."""
    fields = Workspace(spark, "routes").save(consistent_fields(_versions(spark, sf_dir)))
    data = fields.where("default_text is not null").select(*_KEYS, F.concat_ws(":", *_KEYS).alias("row_id"), "field_path", F.regexp_replace("default_text", r'\A"|"\z', "").alias("value"))
    return route(data, routes(fields)).drop("row_id")
