"""The source catalog: registries, current schemas, versions, and their selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schemaloom.functions import naming as N
from schemaloom.functions import parsing as P
from schemaloom.operators.diff import one_per_key
from schemaloom.session import Workspace, table


@dataclass
class Catalog:
    """What a plan is built over: registries(name), current schemas, versions once each, and parsed references."""

    registries: DataFrame
    schemas: DataFrame
    versions: DataFrame
    parsed: DataFrame


def from_tables(spark, sf_dir: str) -> Catalog:
    from schemaloom.operators.hierarchy import current_parsed

    return Catalog(registries(spark, sf_dir), schemas(spark, sf_dir), versions(spark, sf_dir), current_parsed(spark, sf_dir))


def from_registry(spark, options: dict[str, str], names: Sequence[str] = ()) -> Catalog:
    """The catalog of a registry service, read once through the data source `schema_registry`.

    options are the source's; names, if given, are the registries to read, and each must exist. References are those
    that the latest definitions state.
    """
    from schemaloom.sources import registry as source

    source.register(spark)
    client = source.client(options)
    rows = [client.get_registry(n) for n in names] if names else list(source.pages(client.list_registries))
    regs = spark.createDataFrame([(r["name"], r.get("arn"), r.get("description")) for r in rows], "name string, arn string, description string")
    read = spark.read.format("schema_registry").options(**options).load()
    if names:
        read = read.where(F.col("registry_name").isin(*names))
    all_ = Workspace(spark, "registry").save(read)
    heads = all_.select("registry_name", "name", "data_format", "compatibility", "description").distinct()
    have = all_.where("version_number is not null").select("registry_name", "name", "version_number", "schema_version_id", "definition", "status", "created_time")
    of = latest(have.select("registry_name", "name", "version_number", "definition")).join(heads.select("registry_name", "name", "data_format"), ["registry_name", "name"])
    d, kind = F.col("definition"), F.col("data_format")
    refs = F.when(kind == "AVRO", P.avro(d)["references"]).when(kind == "JSON", P.json_schema(d)["references"]).when(kind == "PROTOBUF", P.proto(d)["references"])
    return Catalog(regs, heads, have, of.select("registry_name", "name", refs.alias("references")))


def registries(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "registries")


def schemas(spark, sf_dir: str) -> DataFrame:
    """The current row of each schema: the latest updated_time."""
    s = table(spark, sf_dir, "glue_schemas", "registry_name", "name", "arn", "description", "data_format", "compatibility", "latest_version", "created_time", "updated_time")
    return one_per_key(s.where("registry_name is not null and name is not null"), ["registry_name", "name"], F.col("updated_time"))


def versions(spark, sf_dir: str) -> DataFrame:
    """Each version once, however often it was delivered: the latest delivery."""
    v = table(spark, sf_dir, "glue_versions", "registry_name", "schema_name", "version_number", "schema_version_id", "definition", "status", "created_time", "ingested_at")
    return one_per_key(v, ["registry_name", "schema_name", "version_number"], F.col("ingested_at")).withColumnRenamed("schema_name", "name")


def select_registries(registries: DataFrame, *, names: Sequence[str] = (), every: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """All registries without the excluded ones, or exactly the named ones (exclusions do not apply to those)."""
    if every:
        return registries.where(~N.is_excluded(F.col("name"), list(exclude)))
    return registries.where(F.col("name").isin(*names)) if names else registries.where("false")


def get_registry(registries: DataFrame, name: str) -> DataFrame:
    """One registry; LookupError if it does not exist."""
    found = registries.where(F.col("name") == name)
    if not found.limit(1).count():
        raise LookupError(f"registry {name!r} does not exist")
    return found


def filter_schemas(schemas: DataFrame, glob: str) -> DataFrame:
    """Schemas whose name matches a glob; ValueError if it is malformed."""
    return schemas.where(N.matches_glob(F.col("name"), glob)) if glob else schemas


def latest(versions: DataFrame) -> DataFrame:
    """The version with the greatest number of each schema; the text is not shuffled twice and never sorted."""
    rest = [c for c in versions.columns if c not in ("registry_name", "name")]
    best = F.max_by(F.struct(*rest), "version_number").alias("v")
    return versions.groupBy("registry_name", "name").agg(best).select("registry_name", "name", "v.*")


def with_versions(schemas: DataFrame, versions: DataFrame) -> DataFrame:
    """Each schema with its latest definition and the number of its versions."""
    v = versions.groupBy("registry_name", "name").agg(F.count("*").cast("int").alias("n_versions"), F.max_by("definition", "version_number").alias("definition"))
    return schemas.join(v, ["registry_name", "name"], "left").withColumn("n_versions", F.coalesce("n_versions", F.lit(0)))


def ordered_versions(versions: DataFrame) -> DataFrame:
    """Versions numbered in ascending order within their schema."""
    w = Window.partitionBy("registry_name", "name").orderBy("version_number")
    return versions.withColumn("ord", F.row_number().over(w))
