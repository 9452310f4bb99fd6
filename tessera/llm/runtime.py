"""What the operators of this subpackage share: the shared folder, tables written there, and sizes."""

from __future__ import annotations

import atexit
import gc
import math
import tempfile
import uuid
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

#: Rows that go to a Python worker at once; with texts of many kB a larger batch takes too much memory.
ARROW_ROWS = 1000
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines share: spark.checkpoint.dir. Where that is unset, a local session makes and sets one, a cluster's raises an error."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or _set_dir(sc)
    if not at:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        at = tempfile.mkdtemp(prefix="tessera-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def _set_dir(sc) -> str:
    """What a program has set by setCheckpointDir, without the folder that Spark adds."""
    at = sc._jsc.sc().getCheckpointDir()
    return at.get().rsplit("/", 1)[0] if at.isDefined() else ""


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder, removed when the program ends."""
    if not _made:
        atexit.register(_clean)
    path = f"{shared_dir(spark)}/tessera-{what}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may have ended before
            return


#: Spark's setting to remove a query's shuffle files when it ends. What is written is read from its table, never again from a shuffle.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, what: str, by: str | None = None, clean: bool = False) -> DataFrame:
    """df as a table in the shared folder, in folders by a column if given: its lineage is cut, and lost executors lose nothing.

    With clean its shuffle files are removed at once, not when Java's garbage is collected.
    """
    spark = df.sparkSession
    path = scratch(spark, what)
    w = df.write.option("compression", "zstd")
    with _shuffles_removed(spark) if clean else nullcontext():
        (w.partitionBy(by) if by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def bucketed(df: DataFrame, what: str, by: str, buckets: int, folders: str | None = None, to: DataFrame | None = None) -> DataFrame:
    """As written(), dealt to buckets by a column: grouping by it later needs no shuffle of this table.

    folders: by this column, if given. to: a table made so, to which df is added (a union of such tables would be shuffled); it may be read by df.
    """
    spark = df.sparkSession
    path, name = (scratch(spark, what), f"tessera_{uuid.uuid4().hex}") if to is None else (to._written_at, to._table)
    with _shuffles_removed(spark):
        w = df.repartition(buckets, by).write.option("compression", "zstd").option("path", path)
        (w.partitionBy(folders) if folders else w).bucketBy(buckets, by).format("parquet").mode("append").saveAsTable(name)
    out = spark.table(name)
    out._written_at, out._table = path, name
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables made by written(), of which nothing is left to be read; other frames are left alone."""
    for t in tables:
        path, name = t.__dict__.pop("_written_at", None), t.__dict__.pop("_table", None)
        if name:
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        if path:
            remove(t.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tune(spark: SparkSession) -> SparkSession:
    """Bounds the rows sent to Python at once, unless the session has its own bound."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark


def input_bytes(df: DataFrame) -> int:
    """Spark's own estimate of df's size, from file sizes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def parts_for(df: DataFrame, each: int, least: int = 1) -> int:
    """How many parts of `each` bytes df makes; four for each shuffle partition where Spark can't tell its size."""
    size = input_bytes(df)
    if size >= 1 << 60:
        return max(least, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(least, min(1 << 20, math.ceil(size / each)))
