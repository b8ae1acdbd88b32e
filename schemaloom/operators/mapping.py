"""Source schemas to target subjects: context, subject, role; collisions of targets; checks of the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemaloom.config import Config
from schemaloom.functions import naming as N
from schemaloom.functions import parsing as P
from schemaloom.functions import roles as R
from schemaloom.functions.keys import schema_key, target_key
from schemaloom.session import Workspace
from schemaloom.sources.files import NameMapping, RoleOverrides

#: A lookup of at most so many rows is broadcast: it came from a file that the driver has read.
BROADCAST_ROWS = 100_000
#: A mapping of so many entries is part of the plan; a longer one is joined.
LITERAL_ROWS = 1_000


def lookup(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def context(registry: Column, how: str, mapped: dict[str, str] | None = None) -> Column:
    """The target context of a registry: none, its own name, or a mapped one."""
    own = F.concat(F.lit("."), registry)
    if how == "flat":
        return F.lit("")
    if how == "custom" and mapped and len(mapped) <= LITERAL_ROWS:
        table = F.create_map(*[F.lit(x) for pair in mapped.items() for x in pair])
        return F.coalesce(F.concat(F.lit("."), F.try_element_at(table, registry)), own)
    return own


def subject(c: Config, registry: Column, name: Column, record: Column, namespace: Column, role: Column, suggested: Column | None = None) -> tuple[Column, Column, Column]:
    """(subject, strategy, log) by the configured strategy."""
    how = c.naming.subject_strategy
    base, log = N.normalize(name, c.normalization)
    topic = F.concat(N.strip_value_suffix(N.strip_key_suffix(base)), R.suffix(role))
    if how == "record":
        full = F.when(record == "", name).when(namespace == "", record).otherwise(F.concat(namespace, F.lit("."), record))
        base, log = N.normalize(full, c.normalization)
        return F.concat(base, R.suffix(role)), F.lit("record"), log
    if how == "custom":
        if not c.naming.subject_template:
            return F.lit(None).cast("string"), F.lit(""), F.array().cast("array<string>")
        values = {"registry": registry, "name": name, "schema_name": name, "role": role, "suffix": R.suffix(role), "record_name": record, "namespace": namespace}
        base, log = N.normalize(N.template(c.naming.subject_template, values), c.normalization)
        return base, F.lit("custom"), log
    if how == "llm" and suggested is not None:
        changed = F.when(suggested != name, F.array(F.concat(F.lit("LLM: "), name, F.lit(" → "), suggested))).otherwise(F.array().cast("array<string>"))
        have = suggested.isNotNull()
        return F.coalesce(suggested, topic), F.when(have, "llm").otherwise("topic (fallback)"), F.when(have, changed).otherwise(log)
    return topic, F.lit("topic (fallback)" if how == "llm" else "topic"), log


def map_schemas(schemas: DataFrame, c: Config, *, overrides: RoleOverrides | None = None, names: Sequence[NameMapping] = (), contexts: dict[str, str] | None = None, suggestions: DataFrame | None = None, with_fields: bool = False) -> DataFrame:
    """One mapping per schema of schemas(registry_name, name, data_format, definition, n_versions).

    A mapping from the file counts first, qualified before plain. with_fields lets the role follow from the fields
    too, which costs a full parse. suggestions(registry_name, name, suggested) serve the strategy llm.
    """
    d = schemas.select("registry_name", "name", "data_format", "definition", "n_versions")
    record, space = P.light_metadata(F.col("definition"), F.col("data_format"))
    fields = F.when(F.col("data_format") == "AVRO", P.avro(F.col("definition"))["fields"]).when(F.col("data_format") == "JSON", P.json_schema(F.col("definition"))["fields"]) if with_fields else None
    d = d.withColumn("record", record).withColumn("namespace", space)
    d = d.withColumn("found", R.detect(F.col("registry_name"), F.col("name"), F.col("record"), fields, c.key_value, overrides))
    spark = d.sparkSession
    if names:
        rows = [(m.source, m.subject, m.role or None, m.context or None) for m in names]
        t = spark.createDataFrame(rows, "source string, m_subject string, m_role string, m_context string")
        q = t.where(F.col("source").contains(":")).select(F.col("source").alias("q_source"), F.struct("m_subject", "m_role", "m_context").alias("q"))
        s = t.where(~F.col("source").contains(":")).select(F.col("source").alias("name"), F.struct("m_subject", "m_role", "m_context").alias("s"))
        d = d.withColumn("q_source", schema_key("registry_name", "name")).join(lookup(q, len(rows)), "q_source", "left").join(lookup(s, len(rows)), "name", "left")
        d = d.withColumn("custom", F.coalesce("q", "s"))
    else:
        d = d.withColumn("custom", F.lit(None).cast("struct<m_subject:string,m_role:string,m_context:string>"))
    if c.naming.context_mapping == "custom" and contexts and len(contexts) > LITERAL_ROWS:
        of = spark.createDataFrame([(k, f".{v}") for k, v in contexts.items()], "registry_name string, joined_context string")
        d = d.join(lookup(of, len(contexts)), "registry_name", "left")
    else:
        d = d.withColumn("joined_context", F.lit(None).cast("string"))
    if suggestions is not None:
        d = d.join(suggestions.select("registry_name", "name", "suggested"), ["registry_name", "name"], "left")
    role = F.coalesce(F.col("custom.m_role"), F.col("found.role"))
    sub, strategy, log = subject(c, F.col("registry_name"), F.col("name"), F.col("record"), F.col("namespace"), F.col("found.role"), F.col("suggested") if suggestions is not None else None)
    given = F.col("custom").isNotNull()
    lacks = sub.isNull() & ~given
    return d.select(
        F.col("registry_name").alias("source_registry"),
        F.col("name").alias("source_schema_name"),
        F.col("n_versions").cast("int").alias("source_versions"),
        F.coalesce(F.col("custom.m_context"), F.col("joined_context"), context(F.col("registry_name"), c.naming.context_mapping, contexts)).alias("target_context"),
        F.coalesce(F.col("custom.m_subject"), sub, F.lit("")).alias("target_subject"),
        role.alias("detected_role"),
        F.when(given, "custom-mapping").otherwise(strategy).alias("naming_strategy"),
        F.when(given, "Custom name mapping file").otherwise(F.col("found.reason")).alias("naming_reason"),
        F.when(given, F.array(F.concat(F.lit("custom-mapping: "), F.col("name"), F.lit(" -> "), F.col("custom.m_subject")))).otherwise(log).alias("transformations"),
        F.when(lacks, "error").otherwise("ready").alias("status"),
        F.when(lacks, "custom template not configured").alias("error"),
    )


# --- collisions --------------------------------------------------------------------------------------

_SOURCE = ("source_registry", "source_schema_name")


def full_target() -> Column:
    return target_key("target_context", "target_subject")


def collisions(mappings: DataFrame) -> DataFrame:
    """(normalized_name, n_sources): targets of more than one schema. The sources are in collision_members."""
    return mappings.groupBy(full_target().alias("normalized_name")).agg(F.count("*").alias("n_sources")).where("n_sources > 1")


def collision_members(mappings: DataFrame) -> DataFrame:
    """(normalized_name, source): one row per schema of a collision, so that no group is ever collected.

    mappings are read twice: pass them written.
    """
    m = mappings.select(full_target().alias("normalized_name"), F.concat_ws(".", *_SOURCE).alias("source"))
    return m.join(collisions(mappings).select("normalized_name"), "normalized_name", "left_semi")


def resolve_collisions(mappings: DataFrame, how: str = "suffix", observed: bool = False) -> DataFrame:
    """Mappings after resolution. Losers of skip and prefer-shorter get the status skipped and stay out of what is sent.

    The order within a collision is by registry and name. observed keeps the one-character suffix of older runs,
    which leaves the digits from the tenth member on.
    """
    if how not in ("suffix", "registry-prefix", "prefer-shorter", "skip"):
        return mappings
    # Written once: the places are counted from the rows as they are, not from the definitions again.
    mappings = Workspace(mappings.sparkSession, "collisions").save(mappings)
    d = _ranked(mappings.withColumn("_target", F.coalesce(full_target(), F.lit(""))), how == "prefer-shorter")
    clash, later = F.col("_n") > 1, F.col("_i") > 0
    if how == "suffix":
        mark = F.char((F.col("_i") + ord("0")).cast("int")) if observed else F.col("_i").cast("string")
        new, log = F.when(later, F.concat("target_subject", F.lit("-"), mark)), F.when(later, F.lit("collision-suffix"))
    elif how == "registry-prefix":
        new, log = F.when(clash, F.concat("source_registry", F.lit("-"), "target_subject")), F.when(clash, F.lit("registry-prefix"))
    else:
        new, log = F.lit(None).cast("string"), F.lit(None).cast("string")
        d = d.withColumn("status", F.when(later, "skipped").otherwise(F.col("status")))
    d = d.withColumn("transformations", F.when(log.isNotNull(), F.concat("transformations", F.array(log))).otherwise(F.col("transformations")))
    return d.withColumn("target_subject", F.coalesce(new, F.col("target_subject"))).drop("_target", "_n", "_i")


def _ranked(d: DataFrame, by_length: bool) -> DataFrame:
    """d with _n, the members of its _target, and _i, its place among them by (length,) registry and name.

    Places are counted within slices of a target (registry and beginning of the name, which keep the order) and put
    together from the slices' sizes, so that a target of very many schemas is no single task's work.
    """
    slice_ = F.struct(*([F.octet_length("source_schema_name").alias("len")] if by_length else []), F.coalesce("source_registry", F.lit("")).alias("reg"), F.coalesce(F.substring("source_schema_name", 1, 3), F.lit("")).alias("start"))
    d = d.withColumn("_slice", slice_)
    sizes = d.groupBy("_target", "_slice").agg(F.count("*").alias("_k"))
    all_, before = Window.partitionBy("_target"), Window.partitionBy("_target").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_target", "_slice", F.sum("_k").over(all_).alias("_n"), F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_base"))
    here = F.row_number().over(Window.partitionBy("_target", "_slice").orderBy("source_schema_name")) - 1
    return d.withColumn("_here", here).join(sizes, ["_target", "_slice"]).withColumn("_i", F.col("_base") + F.col("_here")).drop("_slice", "_here", "_base")


# --- checks --------------------------------------------------------------------------------------------


# The rules' messages below and these lists are what users of the original tool see.
SPECIAL = ("/", ":", " ", "\\")
VENDOR_PREFIXES = ("MSK_", "Glue_", "AWS_")
VERSION_MARKS = ("_v1", "_v2", "-v1", "-v2", "_V1", "_V2")


def subject_problem(c: Column) -> Column:
    """The first rule that a subject name breaks, else null."""
    return (
        F.when(c == "", "subject name cannot be empty")
        .when(F.octet_length(c) > 255, "subject name exceeds maximum length of 255 characters")
        .when(~c.rlike(r"\A[a-zA-Z0-9._-]+\z"), "subject name contains invalid characters (only alphanumeric, dots, underscores, and hyphens allowed)")
        .when(c.startswith("_"), "subject name cannot start with underscore (reserved)")
    )


def context_problem(c: Column) -> Column:
    return F.when(c == "", None).when(~c.startswith("."), "context must start with a dot").when(~c.rlike(r"\A\.[a-zA-Z0-9_-]+\z"), "context name contains invalid characters")


def warnings(source: Column, target: Column, references: Column, reference_strategy: str) -> Column:
    """The warnings of one mapping, in the order of their rules."""
    base = F.lower(F.replace(source, F.lit("_"), F.lit("-")))
    bare = F.regexp_replace(F.regexp_replace(F.lower(target), r"-key\z", ""), r"-value\z", "")
    def first(parts: Sequence[str], test, text) -> Column:
        hit = None
        for p in parts:
            found = F.lit(text(p))
            hit = F.when(test(p), found) if hit is None else hit.when(test(p), found)
        return hit

    rules = [
        F.when((source != target) & (base != bare), F.concat(F.lit("Schema name changed significantly: "), source, F.lit(" → "), target)),
        first(SPECIAL, lambda p: source.contains(p), lambda p: f"Name contains special character '{p}' which will be replaced"),
        first(VENDOR_PREFIXES, lambda p: source.startswith(p), lambda p: f"Name has AWS-specific prefix '{p}' which may be removed"),
        first(VERSION_MARKS, lambda p: source.contains(p), lambda p: "Name contains version suffix which may be removed"),
        F.when(F.lit(reference_strategy != "rewrite") & (F.size(references) > 0), "Schema has references but reference strategy is not 'rewrite'"),
    ]
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def findings(mappings: DataFrame, reference_strategy: str = "rewrite") -> DataFrame:
    """(severity, schema, message): errors and warnings of all mappings, and an error per schema of a collision."""
    refs = F.col("references") if "references" in mappings.columns else F.array().cast("array<string>")
    m = mappings.select(F.concat_ws(".", *_SOURCE).alias("schema"), subject_problem(F.col("target_subject")).alias("e1"), context_problem(F.coalesce("target_context", F.lit(""))).alias("e2"), warnings(F.col("source_schema_name"), F.col("target_subject"), refs, reference_strategy).alias("w"))
    both = F.concat(F.transform(F.filter(F.array("e1", "e2"), lambda x: x.isNotNull()), lambda x: F.struct(F.lit("error").alias("severity"), x.alias("message"))), F.transform("w", lambda x: F.struct(F.lit("warning").alias("severity"), x.alias("message"))))
    each = m.select("schema", F.explode(both).alias("f")).select("f.severity", "schema", "f.message")
    clash = collision_members(mappings).select(F.lit("error").alias("severity"), F.col("source").alias("schema"), F.concat(F.lit("Naming collision: multiple schemas map to "), "normalized_name").alias("message"))
    return each.unionByName(clash)


def reference_findings(mappings: DataFrame, references: DataFrame, strategy: str = "rewrite", cross: str = "resolve") -> DataFrame:
    """(severity, schema, message) of references(src, pos, ref, target) by what the settings make of them.

    strategy fail: an error for each reference; cross fail or warn: an error or warning for each into another registry.
    """
    m = mappings.select(schema_key(*_SOURCE).alias("src"), F.concat_ws(".", *_SOURCE).alias("schema"))
    r = references.join(m, "src")
    outside = F.col("target").isNotNull() & (F.substring_index("src", ":", 1) != F.substring_index("target", ":", 1))
    every = r.select("schema", F.lit("error").alias("severity"), F.concat(F.lit("Schema has a reference: "), "ref").alias("message")).where(F.lit(strategy == "fail"))
    crossing = r.where(outside & F.lit(cross in ("fail", "warn"))).select("schema", F.lit("error" if cross == "fail" else "warning").alias("severity"), F.concat(F.lit("Reference into another registry: "), "ref").alias("message"))
    return every.unionByName(crossing).select("severity", "schema", "message")
