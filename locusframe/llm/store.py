"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table once to the shared folder and read it back, so that later jobs never redo its work.

    The writer commits whole files, and a lost executor costs only the tasks it had not ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
