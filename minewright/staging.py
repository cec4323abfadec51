"""Tables between steps, kept where every executor can read them again.

Lineage is cut by writing a step's rows as Parquet below the folder that the
cluster names in ``spark.checkpoint.dir``; a lost executor then costs a reread
and not a recomputation.  Only where that setting is absent (local tests) is a
folder of this machine used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or one of our own if it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-minewright-")
    return _LOCAL[app]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_staged(*frames: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Let Arrow batches to Python have ``size`` bytes at most, unless the session asks for another size than Spark's own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, str(size))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
