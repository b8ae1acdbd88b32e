"""Parent-child rows of unknown depth to full hierarchies: path, depth, root, descendants, cycles.

Cycles are separated and subtree sizes counted in one loop of doubling steps. The sizes choose each node's heavy
child; heavy edges form chains, and any root path crosses at most log2(n) of them. Paths are chain segments put
together, descendants are intervals: preorder numbers run along a chain before they enter its side branches, so that
the descendants of a node are the nodes numbered from its own number + 1 to its own number + size - 1.

Every loop takes at most log2(n) rounds, each one job: a join of the nodes that are not done yet, written to the shared
folder, which cuts the lineage. Nodes that are done leave the loop, and no row is joined on a null key. A node with a
third of all nodes as children is pre-aggregated before its shuffle, and the joins on it are unique on one side.

Defined results: a node without parent is a root of depth 0; nodes on a cycle or leading into one have depth -1,
the smallest key of the cycle as root and no path, size or interval; a null key is no node; a parent that is no node
counts as none; rows repeated under one key count once (the smallest parent).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from schemaloom.functions.keys import schema_key
from schemaloom.operators.diff import one_per_key
from schemaloom.operators.references import resolve
from schemaloom.session import Workspace, table, union

PATH_SEPARATOR = " > "
#: Slices of a parent's children, and preorder numbers to a band of a tree.
SLICES, BAND = 256, 4096
#: Nodes that one task finishes in memory, without their paths: some tens of MB. Beyond it a round is a join.
LOCAL_ROWS = 100_000


_PARTS = ("open", "closed", "gain")


def separate(links: DataFrame, work: Workspace, local_rows: int = 0) -> tuple[DataFrame, DataFrame | None]:
    """(forest, cyclic) of links(key, parent).

    forest: key, parent, size (nodes of the subtree). cyclic: key, parent, root_key for the nodes on a cycle or
    leading into one, None without such. Round k knows for each open node the node 2^k steps above it, the smallest
    key on those steps and the descendants nearer than 2^k; one more join doubles all three. A node whose jump goes
    beyond its root closes and leaves the loop; what it gains later is kept as rows of their own and summed at the end.
    As soon as the open nodes fit one task (local_rows), that task does all remaining rounds.
    """
    nodes = links.where("key is not null").groupBy("key").agg(F.min("parent").alias("parent"))
    tops = nodes.where("parent is null").select("key", "parent", F.lit("closed").alias("part"))
    known = nodes.select(F.col("key").alias("parent"), F.lit(True).alias("known"))
    below = nodes.where("parent is not null").join(known, "parent", "left")
    below = below.select("key", F.when(F.col("known"), F.col("parent")).alias("parent"), F.when(F.col("known"), "open").otherwise("closed").alias("part"))
    state = tops.unionByName(below)
    parts = work.split(state.select("key", "parent", F.col("parent").alias("jump"), F.col("parent").alias("least"), F.lit(1).cast("long").alias("size"), "part"), "part", _PARTS)
    out, now, reach = [parts.get("closed")], parts.get("open"), 1
    while now is not None:
        if now.n_rows <= local_rows:
            rest = now.select("key", "parent", "jump", "least", "size").coalesce(1).mapInArrow(_separate_here, f"{SEPARATED}, part string")
            parts = work.split(rest, "part", ("closed", "open"))
            out.append(parts.get("closed"))
            now = parts.get("open")
            break
        gains = now.groupBy(F.col("jump").alias("key")).agg(F.sum("size").alias("gained"))
        far = now.select(F.col("key").alias("jump"), F.col("jump").alias("next"), F.col("least").alias("next_least"))
        step = now.join(far, "jump", "left").select("key", "parent", F.col("next").alias("jump"), F.least("least", "next_least").alias("least"), "size")
        step = step.join(gains, "key", "full")
        part = F.when(F.col("size").isNull(), "gain").when(F.col("jump").isNull(), "closed").otherwise("open")
        parts = work.split(step.select("key", "parent", "jump", "least", (F.coalesce("size", F.lit(0)) + F.coalesce("gained", F.lit(0))).alias("size"), part.alias("part")), "part", _PARTS)
        work.drop(now)
        out += [parts.get("closed"), parts.get("gain")]
        now = parts.get("open")
        reach *= 2
        # Each round closes the nodes of depth reach / 2 to reach, so a round that closes none leaves cyclic nodes
        # only; those need to see as many steps as there are of them.
        if now is not None and parts.get("closed") is None and reach > now.n_rows:
            break
    found = [p.select("key", "parent", "size") for p in out if p is not None]
    forest = work.save(union(found).groupBy("key").agg(F.max("parent").alias("parent"), F.sum("size").alias("size"))) if found else None
    cyclic = None
    if now is not None:
        # After that many steps a node of a cyclic part stands on its cycle, whose keys all lie within reach of there.
        roots = now.select(F.col("key").alias("jump"), F.col("least").alias("root_key"))
        cyclic = work.save(now.join(roots, "jump").select("key", "parent", "root_key"))
        # Nodes of cycles gain no rows of their own: all that reaches them is cyclic too and counted there.
    return (forest if forest is not None else work.save(nodes.where("false").select("key", "parent", F.lit(0).cast("long").alias("size")))), cyclic


SEPARATED = "key string, parent string, jump string, least string, size long"


def _separate_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All remaining rounds of separate() over the open nodes of one task.

    closed rows are nodes of the forest, and what nodes outside the task gain; open ones are left cyclic.
    """
    names = [x.split()[0] for x in SEPARATED.split(", ")]
    t = pa.Table.from_batches(batches, pa.schema([*((n, pa.string()) for n in names[:4]), ("size", pa.int64())])).to_pydict()
    keys, parent, n = t["key"], t["parent"], len(t["key"])
    place = {k: i for i, k in enumerate(keys)}
    # Places outside the task come behind those inside; they are done already.
    outer: dict[str, int] = {}
    jump = np.array([place[j] if j in place else outer.setdefault(j, n + len(outer)) for j in t["jump"]], np.int64)
    texts = sorted({*t["least"]})
    rank = {x: i for i, x in enumerate(texts)}
    least = np.array([rank[x] for x in t["least"]], np.int64)
    size = np.concatenate([np.array(t["size"], np.int64), np.zeros(len(outer), np.int64)])
    opened, reach = np.ones(n, bool), 1
    while opened.any():
        at = np.flatnonzero(opened)
        to = jump[at]
        inside = to < n
        inside[inside] = opened[to[inside]]
        gained = np.zeros_like(size)
        np.add.at(gained, to, size[at])
        nxt, low = jump[to[inside]], np.minimum(least[at[inside]], least[to[inside]])
        size += gained
        jump[at[inside]], least[at[inside]] = nxt, low
        opened[at[~inside]] = False
        reach *= 2
        if inside.all() and reach > len(at):
            break
    names_of = [*keys, *outer]
    rows = [(keys[i], parent[i], None, None, int(size[i]), "closed") for i in np.flatnonzero(~opened)]
    rows += [(keys[i], parent[i], keys[jump[i]], texts[least[i]], int(size[i]), "open") for i in np.flatnonzero(opened)]
    rows += [(names_of[i], None, None, None, int(size[i]), "closed") for i in range(n, len(size)) if size[i]]
    cols = list(zip(*rows)) or [[]] * 6
    yield pa.record_batch([pa.array(c, pa.int64() if k == 4 else pa.string()) for k, c in enumerate(cols)], names=[*names, "part"])


def _combine(how: str, near: Column, far: Column) -> Column:
    """A column of a row that takes over its target's: its own, the target's, both added, or both joined as a path."""
    return {"own": near, "far": far, "sum": near + far, "join": F.concat_ws(PATH_SEPARATOR, far, near)}[how]


def _climb(start: DataFrame, work: Workspace, label: str, how: dict[str, str], local_rows: int) -> DataFrame:
    """Pointer doubling over start(label, jump, columns of `how`): open rows, those with a jump, take over what it points at.

    A row whose target has no jump is done. Rows that are done are written once and only read from then on. As soon as
    the open rows and their targets fit one task (local_rows), that task does all remaining rounds.
    """
    columns = [label, "jump", *how]
    start = start.select(*columns, F.when(F.col("jump").isNull(), "closed").otherwise("open").alias("part"))
    parts = work.split(start, "part", _PARTS[:2])
    done, now = [p for p in (parts.get("closed"),) if p is not None], parts.get("open")
    while now is not None:
        if now.n_rows <= local_rows:
            targets = now.select(F.col("jump").alias(label)).distinct()
            both = now.unionByName(union(done).join(targets, label, "left_semi")) if done else now
            schema = both.select(*columns).schema
            done.append(work.save(both.select(*columns).coalesce(1).mapInArrow(_climb_here(label, how), schema)))
            break
        far = union([*done, now])
        far = far.select(*(F.col(c).alias("jump" if c == label else f"far_{c}") for c in columns))
        moved = now.join(far, "jump").select(label, F.col("far_jump").alias("jump"), *(_combine(h, F.col(c), F.col(f"far_{c}")).alias(c) for c, h in how.items()))
        parts = work.split(moved.withColumn("part", F.when(F.col("jump").isNull(), "closed").otherwise("open")), "part", _PARTS[:2])
        work.drop(now)
        done += [p for p in (parts.get("closed"),) if p is not None]
        now = parts.get("open")
    return union(done) if done else start.drop("part").where("false")


def _climb_here(label: str, how: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {}
        schema, opened = None, []
        for b in batches:
            schema = b.schema
            for r in zip(*(c.to_pylist() for c in b.columns)):
                rows[r[0]] = list(r)
                if r[1] is not None:
                    opened.append(r[0])
        kinds = list(how.values())
        for key in opened:
            trail = []
            while (r := rows[key])[1] is not None:
                trail.append(r)
                key = r[1]
            for near in reversed(trail):
                far = rows[near[1]]
                near[1] = None
                for i, h in enumerate(kinds, 2):
                    if h == "far":
                        near[i] = far[i]
                    elif h == "sum":
                        near[i] += far[i]
                    elif h == "join":
                        near[i] = PATH_SEPARATOR.join(x for x in (far[i], near[i]) if x is not None)
        if schema is not None:
            cols = list(zip(*(rows[k] for k in opened))) or [[]] * len(schema)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return run


def chains(forest: DataFrame, work: Workspace, paths: bool = True, local_rows: int = 0) -> DataFrame:
    """Heavy-path decomposition: key, parent, head (the chain's label), pos in the chain.

    With paths also size, segment (the path from the head down to the node) and own_offset (how far the node's
    preorder number lies behind its parent's).
    """
    child = forest.where("parent is not null")
    heavy = child.groupBy("parent").agg(F.max_by("key", F.struct("size", "key")).alias("heavy"))
    of_heavy = heavy.select(F.col("heavy").alias("key"), F.lit(True).alias("heavy"))
    nodes = forest.join(of_heavy, "key", "left").withColumn("is_heavy", F.coalesce("heavy", F.lit(False))).drop("heavy")
    more: list = []
    if paths:
        nodes = work.save(nodes)
        offsets = _sibling_offsets(nodes.where("parent is not null"))
        nodes = nodes.join(offsets, "key", "left")
        more = ["size", F.coalesce("own_offset", F.lit(0)).cast("long").alias("own_offset"), F.col("key").alias("segment")]
    up = F.when(F.col("is_heavy"), F.col("parent"))
    start = nodes.select("key", "parent", up.alias("jump"), F.coalesce(up, "key").alias("head"), F.col("is_heavy").cast("long").alias("pos"), *more)
    how = {"parent": "own", "head": "far", "pos": "sum"} | ({"size": "own", "own_offset": "own", "segment": "join"} if paths else {})
    return _climb(start, work, "key", how, local_rows).drop("jump")


def _sibling_offsets(child: DataFrame) -> DataFrame:
    """own_offset = 1 + the sizes of the siblings numbered before: the heavy child first, the others by key.

    The running sum is taken within slices of a parent's children (by a hash of the key) and the slices' sums on top,
    so that no task holds more than a slice of a hot parent's children. The heavy child's size is part of the sums.
    """
    light = child.where("not is_heavy").withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(SLICES)).cast("int"))
    heavy = child.where("is_heavy").select("parent", F.lit(-1).alias("slice"), F.col("size").alias("total"))
    sums = light.groupBy("parent", "slice").agg(F.sum("size").alias("total")).unionByName(heavy)
    before = sums.withColumn("base", F.coalesce(F.sum("total").over(Window.partitionBy("parent").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("slice >= 0").drop("total")
    w = Window.partitionBy("parent", "slice").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    light = light.withColumn("prior", F.coalesce(F.sum("size").over(w), F.lit(0))).join(before, ["parent", "slice"])
    light = light.select("key", (F.lit(1) + F.col("base") + F.col("prior")).alias("own_offset"))
    return light.unionByName(child.where("is_heavy").select("key", F.lit(1).cast("long").alias("own_offset")))


def hierarchy(links: DataFrame, paths: bool = True, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The hierarchy of links(key, parent).

    key, parent, root_key, depth, is_cyclic; with paths also path, size and tree_no (preorder number within its tree,
    the root's is 0). The descendants of a node are the nodes of the same root with tree_no in
    (tree_no, tree_no + size - 1]: see `descendants`.
    """
    work = Workspace(links.sparkSession, "hierarchy")
    forest, cyclic = separate(links, work, local_rows)
    local_rows = 0 if paths else local_rows  # rows with paths may be long
    parts = work.save(chains(forest, work, paths, local_rows))
    # The tree of chains: a chain hangs below the node that is its head's parent. Its depth is at most log2(n).
    heads = parts.where("key = head")
    top = heads.where("parent is null")
    hooks = parts.select(F.col("key").alias("hook"), F.col("head").alias("jump"), F.col("pos").alias("hook_pos"), *([F.col("segment").alias("prefix")] if paths else []))
    hung = heads.where("parent is not null").select("head", F.col("parent").alias("hook"), *(["own_offset"] if paths else [])).join(hooks, "hook")
    zero = F.lit(0).cast("long")
    # How deep a chain starts below its parent chain's head, and its preorder number behind that head's.
    more = [(F.col("hook_pos") + F.col("own_offset")).alias("start"), "prefix"] if paths else []
    none = [zero.alias("start"), F.lit(None).cast("string").alias("prefix")] if paths else []
    start = top.select("head", F.lit(None).cast("string").alias("jump"), F.col("head").alias("root_key"), zero.alias("base"), *none)
    start = start.unionByName(hung.select("head", "jump", F.col("jump").alias("root_key"), (F.col("hook_pos") + 1).alias("base"), *more))

    how = {"root_key": "far", "base": "sum"} | ({"start": "sum", "prefix": "join"} if paths else {})
    whole = parts.join(_climb(start, work, "head", how, local_rows).drop("jump"), "head")
    more = [F.concat_ws(PATH_SEPARATOR, F.when(F.length("prefix") > 0, F.col("prefix")), "segment").alias("path"), "size", (F.col("start") + F.col("pos")).alias("tree_no")] if paths else []
    trees = whole.select("key", "parent", "root_key", (F.col("base") + F.col("pos")).alias("depth"), *more, F.lit(False).alias("is_cyclic"))
    if cyclic is None:
        return trees
    null = lambda t, n: F.lit(None).cast(t).alias(n)
    more = [null("string", "path"), null("long", "size"), null("long", "tree_no")] if paths else []
    return trees.unionByName(cyclic.select("key", "parent", "root_key", F.lit(-1).cast("long").alias("depth"), *more, F.lit(True).alias("is_cyclic")))


def descendants(h: DataFrame) -> DataFrame:
    """(key, descendant, steps): the intervals of hierarchy() expanded, one row per node and node below it.

    A node's interval is cut at multiples of BAND; a band of a tree is met by the intervals that reach into it, so the
    join is on equal keys and produces the descendants and little else. Rows are as many as there are descendants.
    """
    t = h.where("not is_cyclic").select("key", "root_key", "depth", "size", "tree_no")
    last = F.col("tree_no") + F.col("size") - 1
    spans = t.where("size > 1").select("key", "root_key", F.col("depth").alias("d"), (F.col("tree_no") + 1).alias("lo"), last.alias("hi"))
    spans = spans.withColumn("band", F.explode(F.sequence(F.floor(F.col("lo") / BAND), F.floor(F.col("hi") / BAND))))
    below = t.select(F.col("key").alias("descendant"), "root_key", "depth", "tree_no", F.floor(F.col("tree_no") / BAND).alias("band"))
    j = spans.join(below, ["root_key", "band"]).where((F.col("tree_no") >= F.col("lo")) & (F.col("tree_no") <= F.col("hi")))
    return j.select("key", "descendant", (F.col("depth") - F.col("d")).alias("steps"))


def current_parsed(spark, sf_dir: str) -> DataFrame:
    """The current row per schema: the latest parsed_at."""
    p = table(spark, sf_dir, "parsed_schemas", "registry_name", "name", "references", "parsed_at").where("registry_name is not null and name is not null")
    return one_per_key(p, ["registry_name", "name"], F.col("parsed_at"))


def parent_links(spark, sf_dir: str) -> DataFrame:
    """(key, parent): the first reference that resolves to a schema other than the row's own."""
    work = Workspace(spark, "links")
    # Written once: the current rows are told by a sort, and four joins read them.
    nodes = work.save(current_parsed(spark, sf_dir).select("registry_name", "name", "references", schema_key("registry_name", "name").alias("key")))
    refs = nodes.select("key", "registry_name", F.posexplode("references").alias("pos", "ref")).where("ref is not null")
    found = refs.join(resolve(refs, nodes), ["registry_name", "ref"]).where("target is not null and target <> key")
    first = found.groupBy("key").agg(F.min(F.struct("pos", "target")).alias("first"))
    return nodes.select("key").join(first, "key", "left").select("key", F.col("first.target").alias("parent"))


def schema_hierarchy(spark, sf_dir: str) -> DataFrame:
    """Every schema with its path, depth, root, size of its subtree, and the level its mapping states."""
    h = hierarchy(parent_links(spark, sf_dir)).drop("tree_no")
    stated = table(spark, sf_dir, "mappings", "source_registry", "source_schema_name", "dependency_level")
    stated = stated.select(schema_key("source_registry", "source_schema_name").alias("key"), "dependency_level").groupBy("key").agg(F.min("dependency_level").alias("stated_level"))
    return h.join(stated, "key", "left").withColumn("level_differs", ~F.col("stated_level").eqNullSafe(F.col("depth")))


def roots_and_depths(spark, sf_dir: str) -> DataFrame:
    """p4_found(schema_key, root_key, depth): one row per schema that has a parent."""
    return hierarchy(parent_links(spark, sf_dir), paths=False).where("parent is not null").select(F.col("key").alias("schema_key"), "root_key", F.col("depth").cast("long").alias("depth"))


def descendant_pairs(spark, sf_dir: str) -> DataFrame:
    """Every schema with each schema below it and the steps between them."""
    return descendants(hierarchy(parent_links(spark, sf_dir)))
