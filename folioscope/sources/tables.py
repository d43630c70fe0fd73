"""Tables kept for a run in the folder that all machines see, and their spread over tasks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame

_LOCAL: list[str] = []


def shared_root(df: DataFrame) -> str:
    """The folder of spark.checkpoint.dir. Only a local session may go without that setting; it gets a temporary folder that goes with it."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="folioscope-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again.

    What several later stages read is computed once, survives lost executors, and keeps wide projections out of later plans.
    """
    path = f"{shared_root(df)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what `stored` wrote for tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Parts of a table, as large as Spark reads at most, for each core, from which they are taken to be enough: fewer, of unequal sizes, leave cores idle.
_EACH = 3


def spread(files: DataFrame, key: str = "source_pdf") -> DataFrame:
    """files in as many tasks as there are cores at least, before rows become many: a small table may come as one row group. Tables that are large by Spark's estimate stay as they are; nothing is run to tell."""
    n = files.sparkSession.sparkContext.defaultParallelism
    part = int(files.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files if size >= n * _EACH * part else files.repartition(2 * n, key)
