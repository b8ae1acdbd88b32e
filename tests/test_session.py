import os

from schemaloom import session


def test_workspace(spark):
    w = session.Workspace(spark, "t")
    a = w.save(spark.range(5))
    parts = w.split(spark.range(4).selectExpr("id", "id > 1 as big"), "big")
    assert a.count() == 5 and {k: v.count() for k, v in parts.items()} == {"true": 2, "false": 2}
    assert list(w.split(spark.range(3).selectExpr("id", "true as big"), "big")) == ["true"]
    at = a._loom_path.removeprefix("file://")
    assert at.startswith(session.shared_dir(spark).removeprefix("file://")) and os.path.isdir(at)
    w.drop(a)
    assert not os.path.exists(at)
    w.drop(None)
    session.clean(spark)
    assert not os.path.exists(os.path.dirname(at))


def test_workers_get_the_package(spark, tables):
    session.table(spark, tables(), "registries")
    assert spark.sparkContext.applicationId in session._shipped
    session.ship(spark)
