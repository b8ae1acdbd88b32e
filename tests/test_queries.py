"""The entry points: every query's SQL gives the query's rows over the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
DIR = "/root/testdata/sf0.001"
SAMPLE = ["p1_found", "p5_found", "normalize", "role_builtin", "avro_fields", "json_fields", "subject_record", "collisions", "validate_warnings", "plan_summary", "resume", "reference_rewrite", "suggestion_context", "p2_found", "p2_unparsed", "p4_descendants", "reference_bodies", "service_one_registry", "edge_lists"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")


def plain(v):
    return round(v, 6) if isinstance(v, float) else v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.mark.parametrize("name", SAMPLE)
def test_sql_agrees(spark, name):
    c = duckdb.connect()
    c.sql("set timezone='UTC'")
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    df, sql = entry.queries()[name](spark, DIR), c.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(sql.columns)
    order = [sql.columns.index(x) for x in df.columns]
    got = sorted(repr(tuple(map(plain, r))) for r in df.collect())
    assert got == sorted(repr(tuple(plain(r[i]) for i in order)) for r in sql.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["target_key", "field"]


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
