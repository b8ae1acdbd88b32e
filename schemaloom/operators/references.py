"""Resolution of references as written to the keys of existing nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaloom.functions.keys import schema_key


def resolve(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(registry_name, ref, target): the node that each distinct reference of a registry means, else null.

    refs: registry_name, ref. nodes: registry_name, name. A reference is tried as an exact key, then as a name in its
    own registry, then as the smallest key of that name in any registry. References are made distinct per registry
    first, so one that a third of all rows hold costs one row per task before the shuffle.
    """
    keys = nodes.select(schema_key("registry_name", "name").alias("key"), "name").where("key is not null").distinct()
    by_name = keys.groupBy("name").agg(F.min("key").alias("any_key")).withColumnRenamed("name", "ref")
    exact = keys.select("key", F.lit(True).alias("is_exact"))
    own = keys.select(F.col("key").alias("own_key"), F.lit(True).alias("is_own"))
    r = refs.select("registry_name", "ref").where("ref is not null").distinct()
    r = r.join(exact.withColumnRenamed("key", "ref"), "ref", "left").join(by_name, "ref", "left")
    r = r.withColumn("own_key", schema_key("registry_name", "ref")).join(own, "own_key", "left")
    return r.select("registry_name", "ref", F.when(F.col("is_exact"), F.col("ref")).when(F.col("is_own"), F.col("own_key")).otherwise(F.col("any_key")).alias("target"))


def resolved(nodes: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(src, pos, ref, target): every reference of nodes(registry_name, name, references), in order, with what it means.

    target is null where it means nothing among targets, by default the nodes themselves.
    """
    refs = nodes.select(schema_key("registry_name", "name").alias("src"), "registry_name", F.posexplode("references").alias("pos", "ref")).where("ref is not null")
    return refs.join(resolve(refs, nodes if targets is None else targets), ["registry_name", "ref"], "left").select("src", "pos", "ref", "target")
