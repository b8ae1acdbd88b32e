"""Session plumbing shared by all operators: tables, intermediate results, partition counts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Settings that suit both a laptop test and a cluster; all may be overridden by the caller.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "schemaloom") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", "12g")
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    spark = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once per application, so that their Python workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(here):  # imported from a zip that is on the executors already
        return
    at = os.path.join(tempfile.mkdtemp(prefix="schemaloom-code-"), "schemaloom.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(at)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One of the Parquet tables, narrowed to `columns` so that the scan reads no others."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it.

    Only where that setting is absent and all tasks run on this machine a temporary folder is made and set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="schemaloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


class Workspace:
    """Intermediate tables in the shared folder: they cut lineage, survive lost executors and can be dropped.

    A written Parquet table is preferred to checkpoint() because it is columnar and compressed, and because its
    size is known to the planner afterwards.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/schemaloom-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        """Writes df and returns the reader of the written table."""
        self.count += 1
        path = f"{self.root}/{self.count:04d}"
        df.write.mode("overwrite").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._loom_path = path
        return back

    def split(self, df: DataFrame, column: str, values: tuple[str, ...] = ("true", "false")) -> dict[str, DataFrame]:
        """Writes df once, split by a column, and returns the readers of the parts that have rows, with `n_rows` set.

        Rows are counted while they are written, without a job of their own.
        """
        self.count += 1
        path = f"{self.root}/{self.count:04d}"
        seen = Observation()
        count = [F.count(F.when(F.col(column).cast("string") == v, 1)).alias(f"n{i}") for i, v in enumerate(values)]
        df.observe(seen, *count).write.mode("overwrite").partitionBy(column).parquet(path)
        rest = df.drop(column).schema
        out = {}
        for i, value in enumerate(values):
            if n := seen.get[f"n{i}"]:
                at = f"{path}/{column}={value}"
                out[value] = self.spark.read.schema(rest).parquet(at)
                out[value]._loom_path, out[value].n_rows = at, n
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Deletes a table that save() wrote, once nothing reads it any more."""
        path = getattr(df, "_loom_path", None)
        if path is None:
            return
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def union(parts: list[DataFrame]) -> DataFrame:
    """All rows of several tables with the same columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def clean(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results that still read them must be written before."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/schemaloom-{spark.sparkContext.applicationId}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; errors of the file system are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, in any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
