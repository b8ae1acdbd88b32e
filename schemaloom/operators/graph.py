"""The reference graph between schemas: edges, dependency levels, cycles, order."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schemaloom.functions.keys import schema_key
from schemaloom.operators.hierarchy import current_parsed
from schemaloom.operators.references import resolved
from schemaloom.session import Workspace, union


def edges(nodes: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(src, dst): src refers to dst; nodes has registry_name, name, references. Loops on oneself are left out.

    References are resolved among targets(registry_name, name), by default among the nodes themselves.
    """
    found = resolved(nodes, targets).select("src", F.col("target").alias("dst"))
    return found.where("dst is not null and src <> dst").distinct()


#: Edges that one task peels to the end in memory: some tens of MB. Beyond it the peeling is a join per level.
LOCAL_EDGES = 200_000


def _peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The level at which each of the task's edges goes, null for what waits for a cycle."""
    edges = pa.Table.from_batches(batches, pa.schema([("src", pa.string()), ("dst", pa.string())]))
    src, dst = edges.column(0).to_pylist(), edges.column(1).to_pylist()
    waits = Counter(src)
    into: dict[str, list[int]] = {}
    for i, d in enumerate(dst):
        into.setdefault(d, []).append(i)
    gone: list[int | None] = [None] * len(src)
    front, level = [d for d in into if d not in waits], 0
    while front:
        nxt = []
        for d in front:
            for i in into.get(d, ()):
                gone[i] = level
                waits[src[i]] -= 1
                if not waits[src[i]]:
                    nxt.append(src[i])
        front, level = nxt, level + 1
    yield pa.record_batch([pa.array(src, pa.string()), pa.array(gone, pa.int32())], names=["src", "level"])


def levels(keys: DataFrame, edges: DataFrame, local_edges: int = LOCAL_EDGES) -> tuple[DataFrame, DataFrame]:
    """(levels(key, level), cyclic(key)): 0 without dependencies, else one more than the highest of them.

    An edge goes once its target waits for nothing: a round keeps the edges whose target is still the source of
    another, so the edges shrink from round to round, each round is one job, and a node's level is one more than the
    last round in which an edge of it went. As soon as the edges left fit one task (local_edges), that task does all
    remaining rounds. Edges that never go wait for a cycle.
    """
    work = Workspace(keys.sparkSession, "levels")
    first = edges.select("src", "dst").where("src is not null and dst is not null").distinct().withColumn("part", F.lit("kept"))
    now, level, gone, stuck = work.split(first, "part", ("kept",)).get("kept"), 0, [], None
    while now is not None:
        if now.n_rows <= local_edges:
            rest = work.save(now.select("src", "dst").coalesce(1).mapInArrow(_peel, "src string, level int"))
            gone.append(rest.where("level is not null").select("src", (F.col("level") + level).alias("level")))
            stuck = rest.where("level is null").select("src")
            break
        waiting = now.select(F.col("src").alias("dst")).distinct().withColumn("part", F.lit("kept"))
        parts = work.split(now.join(waiting, "dst", "left").withColumn("part", F.coalesce("part", F.lit("gone"))), "part", ("kept", "gone"))
        if parts.get("gone") is None:
            stuck = parts["kept"].select("src")
            break
        work.drop(now)
        gone.append(parts["gone"].select("src", F.lit(level).alias("level")))
        now, level = parts.get("kept"), level + 1
    found = keys.select("key", F.lit(0).alias("level"))
    if gone:
        found = found.unionByName(union(gone).groupBy("src").agg((F.max("level") + 1).alias("level")).withColumnRenamed("src", "key"))
    found = found.where("key is not null").groupBy("key").agg(F.max("level").alias("level"))
    if stuck is None:
        return work.save(found), keys.select("key").where("false")
    stuck = stuck.distinct().withColumnRenamed("src", "key")
    return work.save(found.join(stuck, "key", "left_anti")), stuck


def observed_level(keys: DataFrame, edges: DataFrame) -> DataFrame:
    """What older runs made of the levels: one level, of the schemas that nothing refers to; the rest was lost."""
    return keys.select("key").join(edges.select(F.col("dst").alias("key")), "key", "left_anti").withColumn("level", F.lit(0))


def degrees(edges: DataFrame) -> DataFrame:
    """(key, n_dependencies, n_dependents)."""
    both = edges.select(F.col("src").alias("key"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(edges.select(F.col("dst").alias("key"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    return both.groupBy("key").agg(F.sum("out").alias("n_dependencies"), F.sum("in").alias("n_dependents"))


def neighbours(edges: DataFrame) -> DataFrame:
    """(key, dependencies, dependents): the sorted lists of both sides of each node.

    A list is one value and as long as the node has neighbours; for a node that very many refer to use `edges`, which
    has a row for each of them, or `degrees`.
    """
    out = edges.groupBy(F.col("src").alias("key")).agg(F.sort_array(F.collect_set("dst")).alias("dependencies"))
    into = edges.groupBy(F.col("dst").alias("key")).agg(F.sort_array(F.collect_set("src")).alias("dependents"))
    none = F.array().cast("array<string>")
    return out.join(into, "key", "full").select("key", F.coalesce("dependencies", none).alias("dependencies"), F.coalesce("dependents", none).alias("dependents"))


def catalog_edges(spark, sf_dir: str) -> DataFrame:
    return edges(current_parsed(spark, sf_dir))


def catalog_levels(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    nodes = current_parsed(spark, sf_dir)
    return levels(nodes.select(schema_key("registry_name", "name").alias("key")), edges(nodes))


def migration_order(levels: DataFrame) -> DataFrame:
    """(ord, key): level by level, by key within a level; numbered by a range partition's offset, not in one task."""
    work = Workspace(levels.sparkSession, "order")
    d = work.save(levels.select("level", "key").repartitionByRange("level", "key").sortWithinPartitions("level", "key").withColumn("part", F.spark_partition_id()))
    sizes = {r["part"]: r["n"] for r in d.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row per partition
    starts, at = [], 0
    for p in sorted(sizes):
        starts += [F.lit(p), F.lit(at)]
        at += sizes[p]
    here = F.row_number().over(Window.partitionBy("part").orderBy("level", "key"))
    start = F.element_at(F.create_map(*starts), F.col("part")) if starts else F.lit(0)
    return d.select((start + here).cast("long").alias("ord"), "level", "key")
