"""Text files as line tables ``(source, line_no, value)``.

A DataFrame has no order, so order is data: ``line_no`` counts from 1 inside each file. Files are
still split; a line's number is its rank inside its split plus the lines of the earlier splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rules import settled


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read plain or ``.gz`` text with exact line numbers and no single-task pass."""
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    blocks = raw.groupBy("source", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("source", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return raw.join(offsets, ["source", "_block"]).select(
        "source", (F.col("_base") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value"
    )


def field(index: int, column: str = "value") -> Column:
    """0-based tab-separated field, null when the row is shorter."""
    return F.get(F.split(column, "\t", -1), F.lit(index))


def split_once(lines: DataFrame) -> DataFrame:
    """Add ``_f``, the tab-separated fields; ``settled``, so no later column splits or makes the line again."""
    return settled(lines, "_f", F.split("value", "\t", -1))


def cell(index: int) -> Column:
    """0-based field of ``split_once``, null when the row is shorter."""
    return F.get("_f", F.lit(index))


def field_count(column: str = "value") -> Column:
    return F.size(F.split(column, "\t", -1))


def good(tagged: DataFrame) -> DataFrame:
    """Rows without a violation."""
    return tagged.filter("violation is null").drop("violation")


def bad(tagged: DataFrame) -> DataFrame:
    """``(rule, source, line_no)`` of the rows that broke a rule."""
    return tagged.filter("violation is not null").select(
        F.col("violation").alias("rule"), "source", "line_no"
    )
