"""Helpers shared by the corpus operators: table access, shared-folder tables, checked broadcasts, bounded label samples."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its materialised table has at most this many rows (of some 100 bytes at most); beyond it the join shuffles.
BROADCAST_ROWS = 50_000
#: Arrow batches handed to Python hold at most this many bytes, so that long texts don't pile up in a worker.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 500
ROW_GROUP = 32 << 20  # bytes of a row group of intermediate tables, which their writers hold
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one is made only where none is set and driver and executors are one process (tests, local mode)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tracewright-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Called by operators that run Python: bounds its batches, and lets workers import the package from where the driver has it (a cluster gets it by --py-files).

    Batch sizes that the caller has set lower stay. They are read when a plan is run, so they hold for the session's later queries too."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    for name, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        now = spark.conf.get(f"spark.sql.execution.arrow.{name}", str(most))
        if not now.isdigit() or not 0 < int(now) <= most:  # 0 and less stand for no bound
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))


def release() -> None:
    """Give memory that a Python worker no longer uses back to the system; workers stay for the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A partition function that ends with release()."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release()

    return whole


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended, and its folder with it
        return


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors, and gives the planner true sizes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tracewright-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a materialised side for broadcast if its counted size is within BROADCAST_ROWS; else leave the join to shuffle."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def boxed(docs: DataFrame, **more: Column) -> DataFrame:
    """The rows as one column, `own`, beside further ones, so that no name of theirs clashes; `own.*` has them back."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own"), *(c.alias(n) for n, c in more.items()))


def unit_hash(*cols: Column | str, salt: str = "") -> Column:
    """A deterministic number in [0, 1) for each row."""
    return F.pmod(F.xxhash64(*cols, F.lit(salt)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, label: str, per_label: int, key: str = "doc_id", salt: str = "fit") -> DataFrame:
    """About per_label rows of each label (all, if it has fewer), chosen by a hash of the key; fits read no more than that.

    Labels are counted first, in a table of their own; each row then passes with probability per_label / count."""
    spread = materialize(df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("__label")).agg(F.least(F.lit(1.0), F.lit(float(per_label)) / F.count("*")).alias("__rate")))
    rated = df.join(small(spread), F.col(label) == F.col("__label"))
    return rated.filter(unit_hash(F.col(key), salt=salt) < F.col("__rate")).select(*df.columns)
