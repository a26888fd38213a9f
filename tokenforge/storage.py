"""Storage that the driver and all executors share, and lineage cuts in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .errors import ConfigError


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``.  Where that is unset a local master gets a local one, any other an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigError("executors on other machines need a shared folder in spark.checkpoint.dir")
        found = "file://" + tempfile.mkdtemp(prefix="tokenforge-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a table that :func:`stored` wrote and that no later plan reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as the cluster has cores, for work that costs far more than moving its rows.

    A table of fewer splits than cores is dealt out; one of more, and what comes out of a shuffle, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    execution = df._jdf.queryExecution()
    if execution.executedPlan().nodeName().startswith("Adaptive"):
        return df
    return df.repartition(cores) if execution.toRdd().getNumPartitions() < cores else df


#: Bytes of a table, as the planner takes them, for a task whose work makes far more of its rows; so many tasks at most.
SHARE, MOST_SHARES = 1 << 16, 1 << 14


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over as many partitions as it has shares of SHARE bytes, and at least as many as the cluster has cores.

    For work that makes far more of a row than the row is: tasks of file splits, or a fixed number of tasks, would grow with the
    table.  Nothing is moved where there are enough splits; of a table of unknown size only the cores count.
    """
    execution = df._jdf.queryExecution()
    size = int(str(execution.optimizedPlan().stats().sizeInBytes()))
    parts = min(-(-size // SHARE), MOST_SHARES) if size < 1 << 60 else 0
    parts = max(parts, df.sparkSession.sparkContext.defaultParallelism)
    if not execution.executedPlan().nodeName().startswith("Adaptive") and execution.toRdd().getNumPartitions() >= parts:
        return df
    return df.repartition(parts)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with signs after it where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
