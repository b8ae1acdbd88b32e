import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from schemaloom.functions.bitmap import Bitmap
from schemaloom.operators import diff
from tests.conftest import day, rows


@given(st.sets(st.integers(0, 299)), st.sets(st.integers(0, 299)))
@settings(max_examples=60, deadline=None)
def test_bitmap_is_a_set(a, b):
    x, y = (Bitmap.of(np.array(sorted(s), dtype=np.int64), 300) for s in (a, b))
    assert set((x - y).ordinals()) == a - b and set((x & y).ordinals()) == a & b and set((x | y).ordinals()) == a | b
    assert set(Bitmap.loads(x.dumps()).ordinals()) == a and len(x) == len(a)


def test_bitmap_runs_are_short():
    assert len(Bitmap.of(np.arange(8000), 8000).dumps()) < 20


def test_diff_copies_against_brute_force(spark):
    left = {f"k{i}": (i % 7, None if i % 5 == 0 else "x") for i in range(400)}
    right = {f"k{i}": (i % 7 if i % 11 else -1, None if i % 10 == 0 else "x") for i in range(50, 450)}
    frames = [spark.createDataFrame([(k, *v) for k, v in d.items()] + [(None, 1, "y")], "key string, a int, b string") for d in (left, right)]
    got = rows(diff.diff_copies(*frames, ["a", "b"], rows=100_000))
    want = [(k, "missing_right") for k in left if k not in right] + [(k, "missing_left") for k in right if k not in left]
    want += [(k, f) for k in left if k in right for i, f in enumerate("ab") if left[k][i] != right[k][i]]
    assert got == sorted(want, key=repr)


def test_presence_counts(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "key string")
    b = spark.createDataFrame([("y",), ("z",)], "key string")
    (r,) = diff.presence_bitmaps(a, b, rows=10).collect()
    assert (r.n_keys, r.only_left, r.only_right, r.both) == (3, 1, 1, 1)
    assert len(Bitmap.loads(bytes(r.left_bitmap))) == 2


def test_one_per_key_prefers_latest_and_breaks_ties(spark):
    d = spark.createDataFrame([("a", 1, "old"), ("a", 2, "b"), ("a", 2, "c"), ("a", None, "z")], "k string, t int, v string")
    assert rows(diff.one_per_key(d, ["k"], d.t)) == [("a", 2, "c")]


def _mapping(name, status="ready", context=".c", **more):
    return dict(source_registry="r", source_schema_name=name, target_context=context, target_subject=f"{name}-value", status=status) | more


def _version(name, n, text="{}", status="AVAILABLE", at=0):
    return dict(registry_name="r", schema_name=name, version_number=n, schema_version_id=f"{name}{n}", definition=text, status=status, ingested_at=day(at))


def _schema(name, compatibility="FULL_ALL", at=0, data_format="AVRO"):
    return dict(registry_name="r", name=name, data_format=data_format, compatibility=compatibility, updated_time=day(at))


def _subject(name, versions, context=".c", compatibility="FULL_TRANSITIVE", schema_type="avro"):
    return dict(name=f"{name}-value", context=context, compatibility=compatibility, schema_type=schema_type, versions=[(n, n, t, "AVRO", None) for n, t in versions])


def _done(name, n, at=0):
    return dict(key=f"r:{name}", versions=n, completed_at=day(at))


def test_catalog_differences(tables, spark):
    long = "x" * 200_000
    d = tables(
        mappings=[_mapping("same"), _mapping("gone"), _mapping("off", "error"), _mapping("flat", "warning", ""), _mapping("null", context=None), _mapping("text")],
        glue_schemas=[_schema("same", "NONE", 0), _schema("same", "FULL_ALL", 1), _schema("same", "FULL_ALL", 1), _schema("gone"), _schema("flat", "DISABLED"), _schema("null", "BACKWARD"), _schema("text")],
        glue_versions=[_version("same", 1, '{ "a": 1}'), _version("same", 1, '{ "a": 1}', at=3), _version("same", 2, None, "FAILURE"), _version("flat", 1), _version("flat", 3), _version("text", 1, long), _version("text", 2, "")],
        subjects=[_subject("same", [(1, '{"a":\n1}')]), _subject("same", [(1, '{"a":\n1}')]), _subject("flat", [(1, "{}"), (2, "{}")], "", "NONE", "JSON"), _subject("extra", []), _subject("null", [], ""), _subject("text", [(1, long + "y"), (2, " ")])],
        completed=[_done("same", 9, 0), _done("same", 1, 1), _done("flat", 5), _done("text", 2)],
    )
    assert rows(diff.catalog_differences(spark, d)) == [
        (".c:extra-value", "source"),
        (".c:gone-value", "subject"),
        (".c:text-value", "schema"),
        ("flat-value", "completed_versions"),
        ("flat-value", "schema_type"),
        ("flat-value", "versions"),
        ("null-value", "compatibility"),
        ("null-value", "completed"),
    ]


def test_every_source_of_a_target_counts(tables, spark):
    differ = {"format": dict(data_format="JSON"), "level": dict(compatibility="BACKWARD"), "ledger": {}, "count": {}}
    # Each target has a source that agrees and one that differs, under names that make either the greater.
    mappings, schemas, subjects, completed = [], [], [], []
    for what, other in differ.items():
        for good, bad in (("a", "b"), ("b", "a")):
            names = {x: f"{what}{good}{x}" for x in (good, bad)}
            mappings += [_mapping(n, target_subject=f"{what}{good}-value") for n in names.values()]
            schemas += [_schema(names[good]), _schema(names[bad], **other)]
            subjects.append(_subject(f"{what}{good}", []))
            completed += [_done(names[good], 0)] + ([_done(names[bad], 0 if what != "count" else 5 if good == "a" else -5)] if what != "ledger" else [])
    d = tables(mappings=mappings, glue_schemas=schemas, subjects=subjects, completed=completed)
    field = {"format": "schema_type", "level": "compatibility", "ledger": "completed", "count": "completed_versions"}
    assert rows(diff.catalog_differences(spark, d)) == sorted((f".c:{w}{g}-value", field[w]) for w in differ for g in "ab")


def test_empty_tables(tables, spark):
    d = tables()
    assert rows(diff.catalog_differences(spark, d)) == [] and rows(diff.catalog_presence(spark, d)) == [(0, 0, 0, 0)]
