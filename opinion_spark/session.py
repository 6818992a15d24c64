"""Session set-up and the few settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that the operators rely on; a cluster may set its own sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use spark-submit."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("opinion_spark")
    settings = {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; without it, a scratch folder on a local master only.

    On a cluster each executor would write to its own disk and rows would be
    missing later, so an unset folder is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not named and not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a shared folder for master {master}")
    target = named or tempfile.mkdtemp(prefix="opinion-checkpoint-")
    spark.sparkContext.setCheckpointDir(target)
    return target


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the checkpoint folder and read it back.

    For results that several later steps read: the lineage ends here, the files
    survive the loss of an executor, and later reads fetch only their columns.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Split a scan that has fewer partitions than the cluster has cores.

    A few files with one row group each would otherwise run on as few cores. A
    scan that is already wide, as any large table is, stays as it is.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)
