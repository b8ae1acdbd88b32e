import random

import pytest
from pyspark.sql import functions as F

from schemaloom.operators import graph, hierarchy, orphans
from schemaloom.operators.references import resolve
from tests.conftest import day, rows


def p(name, refs=None, registry="r", at=0):
    return dict(registry_name=registry, name=name, references=refs, parsed_at=day(at))


def brute(parents: dict) -> dict:
    """(root, depth, path) by walking; depth -1 and the smallest key of the cycle where there is one."""
    out = {}
    for k in parents:
        seen, at = [k], k
        while (up := parents.get(at)) in parents:
            if up in seen:
                out[k] = (min(seen[seen.index(up) :]), -1, None)
                break
            seen.append(up)
            at = up
        else:
            out[k] = (at, len(seen) - 1, " > ".join(reversed(seen)))
    return out


def check(spark, parents: dict, all_ways: bool = False):
    links = spark.createDataFrame(list(parents.items()), "key string, parent string")
    h = links.sparkSession.createDataFrame(hierarchy.hierarchy(links, local_rows=0).toArrow())
    got = {r["key"]: r for r in h.collect()}
    want = brute(parents)
    assert {k: (r["root_key"], r["depth"], r["path"]) for k, r in got.items()} == want
    for local in (0, 20, hierarchy.LOCAL_ROWS) if all_ways else (20,):
        short = hierarchy.hierarchy(links, paths=False, local_rows=local)
        assert {r["key"]: (r["root_key"], r["depth"]) for r in short.collect()} == {k: x[:2] for k, x in want.items()}
    if not all_ways:
        return
    pairs = {(x, k, d - want[x][1]) for k, (_, d, path) in want.items() if path for x in path.split(" > ")[:-1]}
    assert set(rows(hierarchy.descendants(h))) == pairs
    for k, r in got.items():
        if r["depth"] >= 0:
            below = {x for x, (_, _, path) in want.items() if path and x != k and f" > {k} > " in f" > {path} > "}
            interval = {x for x, y in got.items() if y["root_key"] == r["root_key"] and y["tree_no"] is not None and r["tree_no"] < y["tree_no"] < r["tree_no"] + r["size"]}
            assert interval == below and r["size"] == len(below) + 1


def test_random_forests(spark):
    rnd = random.Random(5)
    parents = {f"n{i:03d}": rnd.choice([None, "absent", *(f"n{rnd.randrange(max(1, i - 4), i + 1):03d}" for _ in range(8))]) if i else None for i in range(150)}
    parents |= {f"c{i}": f"c{(i + 1) % 5}" for i in range(5)} | {f"d{i}": f"d{i - 1}" if i else "c2" for i in range(9)} | {"self": "self"}
    check(spark, parents, all_ways=True)


def test_paths_over_many_chains(spark):
    """A balanced tree: every root path crosses as many chains as there can be."""
    check(spark, {f"b{i:03d}": f"b{i // 2:03d}" if i > 1 else None for i in range(1, 128)})


def test_star_and_chain(spark):
    check(spark, {"hub": None} | {f"s{i}": "hub" for i in range(60)} | {f"t{i:02d}": f"t{i - 1:02d}" if i else "s7" for i in range(40)})


def test_no_nodes(spark):
    empty = spark.createDataFrame([], "key string, parent string")
    assert rows(hierarchy.hierarchy(empty)) == []
    only_null = spark.createDataFrame([(None, "x"), ("a", None), ("a", None)], "key string, parent string")
    assert [(r["key"], r["depth"]) for r in hierarchy.hierarchy(only_null).collect()] == [("a", 0)]


def test_resolution_order(spark):
    nodes = spark.createDataFrame([("r1", "x"), ("r2", "x"), ("r3", "y"), ("r2", "r1:x"), ("r2", "x")], "registry_name string, name string")
    refs = spark.createDataFrame([("r2", "r1:x"), ("r2", "x"), ("r3", "x"), ("r3", "z"), ("r3", None)], "registry_name string, ref string")
    assert rows(resolve(refs, nodes)) == [("r2", "r1:x", "r1:x"), ("r2", "x", "r2:x"), ("r3", "x", "r1:x"), ("r3", "z", None)]


def test_roots_of_the_catalog(tables, spark):
    d = tables(parsed_schemas=[p("top"), p("mid", ["mid", "nowhere", "top", "low"]), p("mid", ["low"], at=-1), p("low", ["q:mid", "mid"]), p("a", ["b"]), p("b", ["a"]), p("in", ["a"]), p("odd", []), p("nul", [None, "", "top"]), p("top"), p("x", None, at=3), p("x", ["top"], at=2)])
    assert rows(hierarchy.roots_and_depths(spark, d)) == [("r:a", "r:a", -1), ("r:b", "r:a", -1), ("r:in", "r:a", -1), ("r:low", "r:top", 2), ("r:mid", "r:top", 1), ("r:nul", "r:top", 1)]
    assert rows(hierarchy.roots_and_depths(spark, tables())) == []


@pytest.mark.parametrize("local", [0, 3, graph.LOCAL_EDGES])
def test_levels(spark, local):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x"), ("z", "x"), ("a", "b"), ("d", "a"), ("z", "c")], "src string, dst string")
    keys = spark.createDataFrame([(k,) for k in "abcdxyzi"], "key string")
    levels, cyclic = graph.levels(keys, edges, local)
    assert rows(levels) == [("a", 2), ("b", 1), ("c", 0), ("d", 3), ("i", 0)] and rows(cyclic) == [("x",), ("y",), ("z",)]
    assert [tuple(r) for r in graph.migration_order(levels).orderBy("ord").collect()] == [(1, 0, "c"), (2, 0, "i"), (3, 1, "b"), (4, 2, "a"), (5, 3, "d")]
    none, left = graph.levels(keys.where("false"), edges.where("false"), local)
    assert rows(none) == [] and rows(left) == []


def test_neighbours(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "src string, dst string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert rows(graph.observed_level(keys, edges)) == [("a", 0)]
    assert rows(graph.neighbours(edges)) == [("a", ["b", "c"], []), ("b", ["c"], ["a"]), ("c", [], ["a", "b"])]


def test_orphans(tables, spark):
    s = lambda n, born=0, at=0: dict(registry_name="r", name=n, created_time=day(born), updated_time=day(at))
    v = lambda n, k, status: dict(registry_name="r", schema_name=n, version_number=k, status=status)
    q = lambda i, subject, refs, at, context=".c": dict(request_id=i, context=context, subject=subject, references=[(None, x, 1) for x in refs], requested_at=day(at))
    d = tables(
        parsed_schemas=[p("a", ["gone", "dead", "new", "ok", None, "gone", ""], at=5), p("b", ["r:old"], at=5), p("a", ["never"], at=1)],
        glue_schemas=[s("a"), s("b"), s("dead"), s("new", 9), s("ok"), s("old", 9, 0), s("old", 1, 2), s("unversioned", 0)],
        glue_versions=[v("dead", 1, "DELETING"), v("dead", 2, "DELETING"), v("ok", 1, "DELETING"), v("ok", 2, "AVAILABLE")],
        requests=[q("q1", "s1", ["s2", ".c:s3", "s4", "flat", None], 5), q("q1", "s1", ["s2", ".c:s3", "s4", "flat", None], 5), q("q2", "s2", [], 7), q("q3", "flat", ["flat"], 1, ""), q("q4", "s2", [".c:s2"], 8), dict(request_id="q5")],
        subjects=[dict(name=n, context=c, versions=x) for n, c, x in (("s1", ".c", [(1, 1, "", "", None)]), ("s2", ".c", [(1, 1, "", "", None)]), ("s4", ".c", []), ("flat", "", [(1, 1, "", "", None)]))],
    )
    assert rows(orphans.orphan_references(spark, d)) == [
        ("parsed_schemas", "r:a", "dead", "deleted"), ("parsed_schemas", "r:a", "gone", "missing"), ("parsed_schemas", "r:a", "new", "late"),
        ("requests", "q1", ".c:s3", "missing"), ("requests", "q1", "flat", "missing"), ("requests", "q1", "s2", "late"), ("requests", "q1", "s4", "deleted"),
    ]
    assert rows(orphans.orphan_references(spark, tables())) == []
    assert rows(orphans.orphans_per_month(spark, tables())) == []


def test_counts_merge(spark):
    refs = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    records = spark.createDataFrame([("a", False, day(1)), ("c", True, day(2))], "key string, gone boolean, born timestamp")
    whole = orphans.key_counts(refs, records)
    parts = orphans.merge_counts(orphans.key_counts(refs, records.where("false")), orphans.key_counts(refs.where("false"), records))
    assert rows(whole) == rows(parts)
    assert [r["key"] for r in whole.where("n_refs > 0 and n_exists <= 0").collect()] == ["b"]


def test_streamed_counts(spark, tmp_path):
    from schemaloom.streaming import orphans as stream

    src, at = f"{tmp_path}/in", f"{tmp_path}/counts"
    ddl = "key string, n_refs long, n_records long, n_exists long, born timestamp"
    spark.createDataFrame([("a", 1, 0, 0, None), ("b", 1, 0, 0, None)], ddl).write.parquet(src)
    run = lambda: stream.keep_counts(spark.readStream.schema(ddl).parquet(src), at, f"{tmp_path}/cp").awaitTermination()
    run()
    assert [r["key"] for r in stream.orphans(spark, at).orderBy("key").collect()] == ["a", "b"]
    spark.createDataFrame([("a", 0, 1, 1, day(1))], ddl).write.mode("append").parquet(src)
    run()
    assert [r["key"] for r in stream.orphans(spark, at).collect()] == ["b"]
    for i in range(3):  # every further batch withdraws a reference to b and adds one to d
        spark.createDataFrame([("b", -1 if i == 0 else 0, 0, 0, None), ("d", 1, 0, 0, None)], ddl).write.mode("append").parquet(src)
        stream.keep_counts(spark.readStream.schema(ddl).parquet(src), at, f"{tmp_path}/cp", compact_every=2).awaitTermination()
    assert [(r["key"], r["n_refs"]) for r in stream.orphans(spark, at).collect()] == [("d", 3)]
    parts = stream._parts(spark, at)[0]
    assert len(parts) <= 2 and "/base/" in parts[0]
    assert rows(stream.orphans(spark, f"{tmp_path}/none").select(F.lit(1))) == []


def test_missing_rests_on_the_counts(tables, spark):
    """What resolves to nothing has a key with references and no record; every row of the report has a count."""
    d = tables(parsed_schemas=[p("a", ["gone", "a"], at=5)], glue_schemas=[dict(registry_name="r", name="a", updated_time=day(0), created_time=day(0))])
    assert rows(orphans.schema_references(spark, d).select("src_key", "ref", "reason")) == [("r:a", "gone", "missing")]
    refs = spark.createDataFrame([("t", "s", "x", "?r:x", day(1)), ("t", "s", "y", None, day(1))], "src_table string, src_key string, ref string, key string, at timestamp")
    assert rows(orphans.report(refs, orphans.merge_counts(orphans.reference_deltas(refs))).select("ref", "reason")) == [("x", "missing")]
    assert rows(orphans.report(refs, orphans.merge_counts(orphans.reference_deltas(refs), orphans.reference_deltas(refs, -1)))) == []
