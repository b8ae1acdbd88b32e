import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from schemaloom.functions import definitions as D
from schemaloom.functions import stream as S
from schemaloom.operators import drift, flatten
from tests.conftest import day, rows

LEAF = {"name": "code", "type": ["null", "string"], "default": None}
ORDER = {
    "type": "record", "name": "R", "fields": [
        {"name": "order", "type": {"type": "record", "name": "O", "fields": [
            {"name": "lines", "type": {"type": "array", "items": {"type": "record", "name": "L", "fields": [
                {"type": ["null", {"type": "map", "values": {"type": "record", "name": "P", "fields": [LEAF]}}], "name": "price"},
                {"name": "tags", "type": {"type": "array", "items": "string"}}]}}}]}},
        {"name": "id", "type": "string"}]}
SHAPE = {"type": "object", "properties": {"order": {"type": ["object", "null"], "properties": {"properties": {"type": "array", "items": {"type": "object", "properties": {"code": {}}}}, "m": {"type": "object", "additionalProperties": {"type": "object", "properties": {"items": {"type": "string"}}}}}}}}


def v(n, text, name="s", status="AVAILABLE", at=0):
    return dict(registry_name="r", schema_name=name, version_number=n, schema_version_id=f"{name}-{n}", definition=text if text is None or isinstance(text, str) else json.dumps(text), status=status, ingested_at=day(at))


def record(*fields):
    return {"type": "record", "name": "R", "fields": list(fields)}


def f(name, kind="string", **more):
    return {"name": name, "type": kind} | more


def test_nested_fields(tables, spark):
    deep = f("leaf")
    for i in range(120):
        deep = f(f"n{i}", {"type": "record", "name": f"T{i}", "fields": [deep]})
    d = tables(glue_versions=[v(1, ORDER), v(1, ORDER, at=2), v(2, SHAPE, status="DELETING"), v(3, None), v(4, ""), v(5, '{"fields": ['), v(6, "syntax = 3;"), v(7, record(deep)), v(8, "[1, 2]"), v(9, record(f("a" * 100_000)))])
    got = rows(flatten.nested_fields(spark, d))
    assert [x for x in got if x[0] != "s-7"] == [
        ("s-1", "order.lines[].price"), ("s-1", "order.lines[].price{}.code"), ("s-1", "order.lines[].tags"),
        ("s-2", "order.m{}.items"), ("s-2", "order.properties[].code"),
    ]
    assert sum(x[0] == "s-7" for x in got) == 119
    assert rows(flatten.nested_fields(spark, tables())) == []


def test_fields_point_to_their_parents(tables, spark):
    fields = {r.field_no: r for r in flatten.all_fields(spark, tables(glue_versions=[v(1, ORDER)])).collect()}
    by = {r.field_path: r for r in fields.values()}
    assert by["order.lines[].price{}.code"].parent_no == by["order.lines[].price"].field_no
    assert by["order"].parent_no is None and by["id"].type == "string" and len(by) == 6


def test_triples_and_group_tables(spark):
    df = spark.createDataFrame([("1", '{"a": {"b": [{"c": 1, "d": [true, null]}, {"c": "x"}]}, "e": []}'), ("2", None), ("3", "no")], "i string, t string")
    t = flatten.to_triples(df, "i", "t")
    assert ("1", "a/b/[]/d/[]", [0, 1], None) in rows(t) and ("1", "e/@empty", [], None) in rows(t)
    assert rows(flatten.group_table(t, "a/b/[]", ["c"])) == [("1", [0], [], "1"), ("1", [1], [], "x")]


values = st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=3), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=3), c, max_size=3), max_leaves=12)


@given(values)
@settings(max_examples=80, deadline=None)
def test_triples_round_trip(doc):
    """The triples hold the whole document: putting them together gives it back."""
    def build(items):
        if len(items) == 1 and items[0][0] == ():
            return items[0][2]
        if items[0][0] == ("@empty",):
            return None
        if items[0][0][0] == "[]":
            parts = {}
            for p, o, x in items:
                parts.setdefault(o[0], []).append((p[1:], o[1:], x))
            return [build(parts[i]) for i in sorted(parts)]
        parts = {}
        for p, o, x in items:
            parts.setdefault(p[0], []).append((p[1:], o, x))
        return {k: build(x) for k, x in parts.items()}

    def plain(x):
        return None if x in ([], {}) else [plain(y) for y in x] if isinstance(x, list) else {k: plain(y) for k, y in x.items()} if isinstance(x, dict) else x

    def has_mark(x):
        return isinstance(x, dict) and (any(k in ("[]", "@empty") for k in x) or any(map(has_mark, x.values()))) or isinstance(x, list) and any(map(has_mark, x))

    if not has_mark(doc):
        assert build([(p.steps(), r.ordinals(), x) for p, r, x in S.triples(S.walk(doc), S.Path(None, ""))]) == plain(doc)


@given(values, st.sampled_from([None, 2]))
@settings(max_examples=150, deadline=None)
def test_stream_parse_is_json(doc, indent):
    text = json.dumps(doc, indent=indent)
    assert S.parse(text) == doc and list(S.walk(doc)) == list(S.events(text))


@given(values, st.integers(0, 60), st.sampled_from(list('{}[],:"\\ 1tx')))
@settings(max_examples=300, deadline=None)
def test_damage_is_told_as_json_does(doc, at, c):
    text = json.dumps(doc)
    text = text[:at] + c + text[at:]
    try:
        want = json.loads(text)
    except ValueError:
        with pytest.raises(ValueError):
            S.parse(text)
    else:
        assert S.parse(text) == want


def test_no_record_is_too_deep(tables, spark):
    """50,000 levels of objects and arrays; 12,500 nested records; a number of 6,000 digits."""
    n = 12_500
    deep = '{"type":"record","name":"A","fields":[{"name":"x","type":' * n + '"string"' + "}]}" * n
    shape = '{"type":"object","properties":{"a":{"type":"object","properties":{"b":{"type":"object","properties":{"c":' + '{"type":"array","items":' * 50_000 + "{}" + "}" * 50_000 + "}}}}}}"
    big = '{"type":"record","name":"A","fields":[{"name":"x","default":' + "9" * 6000 + ',"type":"string"}]}'
    d = tables(glue_versions=[v(1, deep), v(2, shape), v(3, big), v(4, '{"a": ' * 9000), v(5, "")], glue_schemas=[dict(registry_name="r", name="s", data_format="AVRO")])
    got = {(r.schema_version_id, r.names): r.n for r in flatten.nested_fields(spark, d).groupBy("schema_version_id", F.size(F.split("field_path", r"\.")).alias("names")).agg(F.count("*").alias("n")).collect()}
    assert got == {("s-1", i): 1 for i in range(3, n + 1)} | {("s-2", 3): 1}
    assert rows(flatten.unparsed(spark, d)) == [("r", "AVRO", "damaged", 1), ("r", "AVRO", "empty", 1)]
    assert D.field_tree(D.load(big))["x"].sig == "string"
    D.allow_depth()
    assert D.fingerprint(D.field_tree(D.load(deep))) != D.fingerprint(D.field_tree(D.load(shape)))
    one = D.load('{"type":"record","name":"A","fields":[{"name":"x","type":' * 60 + '"string"' + "}]}" * 60)
    assert [c[1] for c in D.changes(D.field_tree(one), D.field_tree(D.load(deep)))] == ["type_changed"] + ["added"] * (n - 60)


def test_repeated_members(tables, spark):
    d = tables(glue_versions=[v(1, '{"type":"object","properties":{"a":{"type":"string"}},"properties":{"b":{"properties":{"c":{"properties":{"d":{}}}}}}}')])
    assert rows(flatten.nested_fields(spark, d)) == [("s-1", "b.c.d")]


def test_changes(tables, spark):
    one = record(f("userId", doc="who"), f("total", "int"), f("kind", "string", doc="what it is"), f("x", {"type": "record", "name": "X", "fields": [f("a"), f("b", "long")]}), f("plain"), f("same", ["null", "int"]), f("old_name"))
    two = record(f("same", ["int", "null"], default=None), f("user_id", doc="other"), f("total", {"type": "int"}), f("sort", "string", doc="what it is"), f("x", {"type": "record", "name": "X", "fields": [f("a", ["null", "string"]), f("c", {"type": "map", "values": {"type": "record", "name": "C", "fields": [f("d")]}})]}), f("fresh"), f("new_name", "int", aliases=["old_name"]))
    d = tables(glue_versions=[v(1, one), v(2, "{ damaged"), v(4, two, at=1), v(4, two), v(3, record(), status="PENDING"), v(5, None), v(6, two), v(1, record(f("q")), name="t")])
    assert [x[3:] for x in rows(drift.schema_changes(spark, d))] == [
        ("fresh", "added"), ("new_name", "renamed"), ("new_name", "type_changed"), ("plain", "removed"), ("sort", "renamed"), ("user_id", "renamed"),
        ("x.a", "type_changed"), ("x.b", "removed"), ("x.c", "added"), ("x.c{}.d", "added"),
    ]
    assert {x[2] for x in rows(drift.schema_changes(spark, d))} == {4}


def test_slices_join_up(tables, spark):
    """One schema with most versions spreads over slices; the result is that of one pass in order."""
    texts = [record(*(f(f"f{(i + j) % 9}", ["int", "long"][(i // 4) % 2]) for j in range(5))) for i in range(60)]
    d = tables(glue_versions=[v(i + 1, t) for i, t in enumerate(texts)] + [v(1, texts[0], name="zz")] + [v(30, texts[29], at=9)] * 20)
    want, ids, last = set(), {}, {}
    for i, t in enumerate(texts):
        tree = D.field_tree(t)
        if i:
            want |= {("r", "s", i + 1, p, c) for p, c, _, _ in D.changes(D.field_tree(texts[i - 1]), tree)}
            ids = drift._carry(D.field_tree(texts[i - 1]), tree, ids, i + 1, drift._types(tree))
        else:
            ids = {p: f"{p}@1" for p in drift._types(tree)}
        last.update({(i + 1, p): x for p, x in ids.items()})
    assert set(rows(drift.schema_changes(spark, d))) == want
    got = {(r.version_number, r.field_path): r.field_id for r in drift.consistent_fields(drift._versions(spark, d)).where("schema_name = 's'").collect()}
    assert got == last


def test_drift_of_nothing(tables, spark):
    d = tables(glue_versions=[v(1, record(f("a"))), v(None, record(f("b"))), v(2, "syntax = 1;")])
    assert rows(drift.schema_changes(spark, d)) == []
    assert rows(drift.schema_changes(spark, tables())) == [] and rows(drift.field_table(spark, tables())) == []


def test_rename_by_reworded_documentation(tables, spark):
    one = record(f("fee", "float", doc="Before, kept for during!"), f("b", doc="the one"), f("c", doc=" ! "), f("d", "int", doc="kept"))
    two = record(f("offset", "float", doc="before kept for DURING"), f("x", doc="the other one"), f("y", doc="?"), f("e", "long", doc="kept"))
    got = {x[3:] for x in rows(drift.schema_changes(spark, tables(glue_versions=[v(1, one), v(2, two)])))}
    assert got == {("offset", "renamed")} | {(n, "removed") for n in "bcd"} | {(n, "added") for n in "xye"}


ROUTE = [
    record(f("userId"), f("total", "string"), f("gone"), f("flag", "boolean")),
    record(f("user_id"), f("total", "int"), f("gone"), f("flag", "boolean"), f("kind", default="new \"x\"")),
    record(f("user_id"), f("sum", "long", aliases=["total"]), f("flag", "boolean"), f("kind", default="new \"x\""), f("n", ["null", "int"], default=None), f("m", "int", default=7)),
]


def test_route_through_the_chain(tables, spark):
    """Data of every version comes out in the newest shape, by the same rules as going version by version."""
    versions = drift._versions(spark, tables(glue_versions=[v(i + 1, t) for i, t in enumerate(ROUTE)]))
    fields = drift.consistent_fields(versions)
    r = rows(drift.rules(drift.migration_steps(versions), fields).select("version_number", "rule", "old_path", "new_path", "argument"))
    assert r == sorted([(2, "rename", "userId", "user_id", None), (2, "cast", "total", "total", "int"), (2, "default", None, "kind", '"new \\"x\\""'), (3, "rename", "total", "sum", None), (3, "cast", "total", "sum", "long"), (3, "drop", "gone", None, None), (3, "default", None, "n", "null"), (3, "default", None, "m", "7")], key=repr)
    data = [(1, "a", {"userId": "u1", "total": "12", "gone": "x", "flag": "true"}), (1, "b", {"userId": "u2", "total": "many", "flag": None}), (2, "c", {"user_id": "u3", "total": "5", "kind": "old"}), (3, "d", {"user_id": "u4", "sum": "9", "m": "1"})]
    long = spark.createDataFrame([("r", "s", n, i, k, x) for n, i, d in data for k, x in d.items()], "registry_name string, schema_name string, version_number long, row_id string, field_path string, value string")
    out: dict = {}
    for x in drift.route(long, drift.routes(fields)).collect():
        out.setdefault(x["row_id"], {})[x["field_path"]] = (x["value"], x["rule"])
    new = {"kind": ('new "x"', "default"), "n": (None, "default"), "m": ("7", "default")}
    assert out == {
        "a": {"user_id": ("u1", "rename"), "sum": ("12", "rename and cast"), "flag": ("true", "keep")} | new,
        "b": {"user_id": ("u2", "rename"), "sum": (None, "rename and cast"), "flag": (None, "keep")} | new,
        "c": {"user_id": ("u3", "keep"), "sum": ("5", "rename and cast"), "kind": ("old", "keep"), "n": new["n"], "m": new["m"]},
        "d": {"user_id": ("u4", "keep"), "sum": ("9", "keep"), "m": ("1", "keep")},
    }


def test_kept_fingerprints(tables, spark):
    old = drift._versions(spark, tables(glue_versions=[v(1, ROUTE[0]), v(2, ROUTE[0]), v(1, ROUTE[1], name="t")]))
    kept = spark.createDataFrame(drift.fingerprints(old).toArrow())
    prints = {(r.schema_name, r.version_number): r.fingerprint for r in kept.collect()}
    assert prints["s", 1] == prints["s", 2] != prints["t", 1]
    assert rows(drift.moved_on(old, kept)) == []
    now = drift._versions(spark, tables(glue_versions=[v(1, ROUTE[0]), v(2, ROUTE[0]), v(1, ROUTE[1], name="t"), v(2, ROUTE[2], name="t")]))
    assert {(x[1], x[2]) for x in rows(drift.moved_on(now, kept))} == {("t", 1), ("t", 2)}
    assert rows(drift.version_fingerprints(spark, tables())) == rows(drift.routed_defaults(spark, tables())) == rows(drift.version_rules(spark, tables())) == []
