"""Reference and existence counts kept up to date from streams of changes.

The counts are a base table and a log of the batches since: a batch appends its own changes, summed per key, and every
COMPACT_EVERY batches the log is merged into a new base, after which the old base and the merged log are deleted. So a
batch costs what it brings, and the whole table is rewritten once in many batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from schemaloom.operators.orphans import COUNTS, merge_counts

COMPACT_EVERY = 64


def _folder(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _complete(spark, path: str) -> list[int]:
    """The numbers of the complete tables under a folder, in order."""
    p, fs = _folder(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n[2:]) for n in names if n.startswith("n=") and fs.exists(path_of(f"{path}/{n}/_SUCCESS")))


def _at(path: str, kind: str, number: int) -> str:
    return f"{path}/{kind}/n={number:09d}"


def _parts(spark, path: str, below: int | None = None) -> tuple[list[str], list[int], list[int]]:
    """What the counts consist of: the folders of the newest base and of the log after it; all bases; all of the log."""
    bases, log = _complete(spark, f"{path}/base"), _complete(spark, f"{path}/log")
    base = bases[-1] if bases else None
    since = [n for n in log if (base is None or n > base) and (below is None or n < below)]
    return [*([_at(path, "base", base)] if base is not None else []), *(_at(path, "log", n) for n in since)], bases, log


def keep_counts(deltas: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY, **trigger):
    """Starts a query that adds a stream of signed changes to the counts under `path`.

    deltas: key, n_refs, n_records, n_exists, born. A batch that runs again after a failure overwrites its own part of
    the log, and is left out if a base holds it already: nothing counts twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bases = _complete(spark, f"{path}/base")
        if bases and bases[-1] >= number:
            return
        merge_counts(batch).write.mode("overwrite").parquet(_at(path, "log", number))
        parts, bases, log = _parts(spark, path)
        if len(parts) > compact_every:
            merge_counts(*(spark.read.parquet(p) for p in parts)).write.mode("overwrite").parquet(_at(path, "base", number))
            for kind, numbers in (("base", bases), ("log", log)):
                for n in numbers:
                    p, fs = _folder(spark, _at(path, kind, n))
                    fs.delete(p, True)

    return deltas.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def counts(spark, path: str) -> DataFrame:
    """The counts as of the last batch."""
    parts = _parts(spark, path)[0]
    return merge_counts(*(spark.read.parquet(p) for p in parts)) if parts else spark.createDataFrame([], COUNTS)


def orphans(spark, path: str) -> DataFrame:
    """The keys that are referred to and do not exist, as of the last batch."""
    return counts(spark, path).where("n_refs > 0 and n_exists <= 0")
