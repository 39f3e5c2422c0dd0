"""Session helpers shared by the bench, the tests and the catalog."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "8", name: str = "locusframe") -> SparkSession:
    """A local session with the settings the operators are tuned against."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LOCUSFRAME_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a single-machine session without that setting (a test) gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get(CHECKPOINT_KEY, None)
        if configured is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
            import tempfile

            configured = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared folder, so an executor lost later never loses the written rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``reliable_checkpoint`` of large tables: columns are compressed, and later jobs read only those they use."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
