"""Deterministic text exports and manifest-last publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import inventory_diff
from .files import file_inventory


def bed_lines(intervals: DataFrame) -> DataFrame:
    """BED text rows with their sort keys."""
    return intervals.select(
        "contig_idx", "start", "end", F.concat_ws("\t", "contig", "start", "end").alias("value")
    )


def interval_list_lines(intervals: DataFrame) -> DataFrame:
    """1-based closed rows of an interval list (without its dictionary header)."""
    return intervals.select(
        "contig_idx", "start", "end",
        F.concat_ws("\t", "contig", F.col("start") + 1, "end", F.lit("+"), "name").alias("value"),
    )


def variant_lines(variants: DataFrame) -> DataFrame:
    """Included variants as VCF rows."""
    return variants.select(
        "contig_idx", "pos",
        F.concat_ws(
            "\t", "contig", "pos", F.lit("."), "ref", "alt", F.lit("."),
            F.coalesce("filter", F.lit(".")), F.lit("."), F.lit("GT"), "gt",
        ).alias("value"),
    )


def metric_rows(metrics: DataFrame) -> DataFrame:
    """Metric table with its reasons as JSON text and nulls as empty fields."""
    return metrics.withColumn("missing_reasons", F.to_json("missing_reasons"))


def write_ordered_text(lines: DataFrame, order: list[str | Column], path: str, header: list[str] | None = None) -> None:
    """Write ``value`` sorted by ``order``.

    A range partitioning sorts it in parallel and the part files, in name order, are the file. Header
    lines become their own leading part, so no task ever holds the whole output.
    """
    body = lines.repartitionByRange(*order).sortWithinPartitions(*order).select("value")
    if header:
        spark = lines.sparkSession
        head = spark.createDataFrame([(i, h) for i, h in enumerate(header)], "i int, value string")
        head.coalesce(1).sortWithinPartitions("i").select("value").write.mode("errorifexists").text(f"{path}/part=0")
        body.write.mode("errorifexists").text(f"{path}/part=1")
    else:
        body.write.mode("errorifexists").text(path)


def write_table(df: DataFrame, path: str) -> None:
    """Tab-separated export with a header."""
    df.write.mode("errorifexists").csv(path, sep="\t", header=True, nullValue="")


def publish(df: DataFrame, root: str) -> str:
    """Publish data, then its inventory, then the completion marker.

    A finished publication is verified, not rewritten; a different or torn one raises. Returns
    ``published`` or ``unchanged``.
    """
    spark: SparkSession = df.sparkSession
    data, manifest, marker = f"{root}/data", f"{root}/manifest", f"{root}/complete"
    if _exists(spark, marker):
        found = _identities(spark, data)
        changed = inventory_diff(spark.read.parquet(manifest), found).filter("status <> 'same'")
        if not changed.isEmpty():
            raise ValueError("published data differs from its manifest")
        stored = spark.read.parquet(data)
        columns = sorted(df.columns)
        if sorted(stored.columns) != columns or not _same_rows(df.select(columns), stored.select(columns)):
            raise ValueError("a different result is already published here")
        return "unchanged"
    df.write.mode("errorifexists").parquet(data)
    _identities(spark, data).write.mode("errorifexists").parquet(manifest)
    spark.read.parquet(manifest).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    ).write.mode("errorifexists").parquet(marker)
    return "published"


def _identities(spark: SparkSession, data: str) -> DataFrame:
    """Path, size and digest of the published files, of whatever size."""
    return file_inventory(spark, data).select("path", "bytes", F.col("tree_sha256").alias("sha256"))


def _same_rows(left: DataFrame, right: DataFrame) -> bool:
    from ..operators.rules import multiset_difference

    return multiset_difference(left, right, left.columns).isEmpty()


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        return False
    return True
