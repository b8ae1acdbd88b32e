import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from schemaloom.functions.definitions import allow_depth
from schemaloom.llm import duplicates
from tests.conftest import rows

DOC = {"type": "record", "name": "OrderPlaced", "fields": [{"name": "unit_price", "type": ["null", "int"], "default": None, "doc": "Price, of one unit."}, {"name": "id", "type": "string"}, {"name": "rate", "type": "double", "default": 1.5}]}
PROTO = 'syntax = "proto3";\npackage a.b;\nmessage M {\n  string first_name = 1;\n  message In { int32 x = 1; }\n  int64 b = 12;\n}\n'


def shuffled(x, rnd):
    if isinstance(x, dict):
        items = [(k, sorted_fields(k, v, rnd)) for k, v in x.items()]
        rnd.shuffle(items)
        return dict(items)
    return [shuffled(y, rnd) for y in x] if isinstance(x, list) else x


def sorted_fields(k, v, rnd):
    v = shuffled(v, rnd)
    if k in ("fields", "required"):
        rnd.shuffle(v)
    return v


@given(st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_layouts_of_one_record(seed):
    rnd = random.Random(seed)
    text = json.dumps(shuffled(DOC, rnd), indent=rnd.choice([None, 1, "\t"]), separators=rnd.choice([(",", ":"), (" , ", " : ")]))
    text = rnd.choice([str.upper, str.lower, str])(text) if rnd.random() < 0.3 else text
    change = rnd.choice([lambda t: t + ";", lambda t: t.replace('"', "'"), lambda t: t[:-1] + ",}", lambda t: t.replace("unit_price", "unitPrice"), lambda t: "﻿\r\n" + t, lambda t: t.replace("unit.", "unit!")])
    assert duplicates.canonical(change(text)) == duplicates.canonical(json.dumps(DOC))


def test_other_records_stay_apart():
    key = duplicates.canonical(json.dumps(DOC))
    for old, new in (('"int"', '"long"'), ("1.5", "15"), ("1.5", "-1.5"), ("one unit", "a unit"), ('"type": "string"', '"type": "string", "x": 1'), ('["null", "int"]', '["int", "null"]'), ('"string"', '{"type": "string"}')):
        assert duplicates.canonical(json.dumps(DOC).replace(old, new, 1)) != key


def test_proto():
    key = duplicates.canonical(PROTO)
    same = 'PACKAGE A.B;SYNTAX="PROTO3";MESSAGE M{INT64 B=12;MESSAGE IN{INT32 X=1;}STRING FIRSTNAME=1;}'
    assert duplicates.canonical(same) == key
    for old, new in (("b = 12", "b1 = 2"), ("int64", "int32"), ("first", "last"), ("message In { int32 x = 1; }", "")):
        assert duplicates.canonical(PROTO.replace(old, new)) != key


def test_damaged_text_is_compared_as_text():
    assert duplicates.canonical('{"a": [1, 2') == duplicates.canonical('{ "A" :[1,2') != duplicates.canonical('{"a": [1, 3')
    assert duplicates.canonical("message M { int32 x = 1;") == duplicates.canonical("MESSAGE M{INT32 X=1 ;")
    assert duplicates.canonical("") == duplicates.canonical(" \n")


def test_depth_does_not_matter():
    allow_depth()
    n = 25_000
    deep = '{"a": [' * n + "1" + "]}" * n
    assert duplicates.canonical(deep) == duplicates.canonical(deep.replace(" ", "\n").replace("a", "A")) != duplicates.canonical(deep.replace("1", "2"))
    loose = deep.replace('"', "'")
    assert duplicates.canonical(loose) == duplicates.canonical(deep)


def test_what_is_layout_and_what_is_not():
    same = lambda a, b: duplicates.canonical('{"x": %s}' % a) == duplicates.canonical('{"x": %s}' % b)
    assert same("1", '"1"') and same("null", '"Null"') and same('"-5"', '"5"') and same('"C++"', '"C"') and same("true", '"true"')
    assert not same("5", "-5") and not same("1.5", "15") and not same('"1.5"', '"15"') and not same('"int"', '"long"') and not same("null", "0")


@pytest.mark.parametrize(("hot_rows", "broadcast"), [(1000, 100), (3, 100), (3, 0), (10**9, 100)])
def test_groups_with_a_hot_key(spark, monkeypatch, hot_rows, broadcast):
    """A third of all rows are copies of one record; the result is that of a plain grouping."""
    rnd = random.Random(1)
    texts = [json.dumps(shuffled(DOC, rnd)) if i % 3 == 0 else json.dumps({"name": f"n{rnd.randrange(900)}", "fields": []}) for i in range(4000)]
    texts[5], texts[7], texts[8] = None, "", "x" * 300_000
    recs = [(f"v{i:04d}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(recs + recs[:50] + [(None, "x")], "id string, text string")
    monkeypatch.setattr(duplicates, "BROADCAST_KEYS", broadcast)
    members, counts = duplicates.groups(duplicates.canonical_keys(df), hot_rows)
    want: dict = {}
    for i, t in recs:
        if t is not None:
            want.setdefault(duplicates.canonical(t), []).append(i)
    assert {r["id"]: r["first_id"] for r in members.collect()} == {i: min(ids) for ids in want.values() for i in ids}
    assert {r["first_id"]: r["n_copies"] for r in counts.collect()} == {min(ids): len(ids) for ids in want.values()}
    assert max(map(len, want.values())) > 1000  # hot


def test_tables(tables, spark):
    d = tables(glue_versions=[dict(schema_version_id="b", definition="{}"), dict(schema_version_id="b", definition="{}"), dict(schema_version_id="n")], requests=[dict(request_id="a", schema=" { } "), dict(request_id="a", schema=" { } "), dict(request_id="c", schema="[]")])
    assert rows(duplicates.copies(spark, d)) == [("a", "b")]
    assert rows(duplicates.collapsed(spark, d)) == [("a", 2), ("c", 1)]
    assert rows(duplicates.repeated_texts(spark, d)) == [("a", 1), ("b", 1), ("c", 1)]
    assert rows(duplicates.copies(spark, tables())) == rows(duplicates.repeated_texts(spark, tables())) == []
