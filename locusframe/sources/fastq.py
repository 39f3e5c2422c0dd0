"""FASTQ text: four lines make a record; two files make pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quality import phred, printable
from ..operators.rules import Rule, first_broken


def parse_fastq(lines: DataFrame, mate: int) -> DataFrame:
    """Group lines by fours into records; records may span file splits.

    Columns: ``source, record, read_id, bases, quality, violation``.
    """
    slot = F.pmod(F.col("line_no") - 1, F.lit(4))
    keyed = lines.select("source", F.floor((F.col("line_no") - 1) / 4).alias("record"), slot.alias("slot"), F.rtrim("value").alias("value"))
    record = keyed.groupBy("source", "record").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("value"))).alias(n) for i, n in enumerate(["head", "bases", "plus", "quality"])]
    )
    words = F.split(F.expr("substring(head, 2)"), r"\s+")
    raw_id = F.get(words, F.lit(0))
    suffix = F.regexp_extract(raw_id, r"/([12])$", 1)
    comment = F.regexp_extract(F.get(words, F.lit(1)), r"^([12])", 1)
    rules = [
        Rule("truncated", F.col("quality").isNull()),
        Rule("header", ~F.col("head").startswith("@") | ~F.col("plus").startswith("+")),
        Rule("identity", F.col("read_id") == ""),
        Rule("mate_suffix", (suffix != "") & (suffix != str(mate))),
        Rule("mate_comment", (comment != "") & (comment != str(mate))),
        Rule("alphabet", ~F.col("bases").rlike("^[ACGTNacgtn]+$")),
        Rule("length", F.length("bases") != F.length("quality")),
        Rule("quality_range", ~printable(F.col("quality"))),
    ]
    named = record.withColumn("read_id", F.regexp_replace(raw_id, r"/[12]$", ""))
    return named.select("source", "record", "read_id", "bases", "quality", first_broken(rules).alias("violation"))


def pair_mates(first: DataFrame, second: DataFrame, lane: list[str] | None = None) -> DataFrame:
    """Full outer join of the mates on the record index; both ends and equal ids are required.

    Name the columns in ``lane`` that tell lanes apart when the tables hold several, so that a record only
    meets its mate of the same lane.
    """
    keys = [*(lane or []), "record"]
    a = first.select(*keys, F.col("read_id").alias("id1"), F.col("bases").alias("bases1"), F.col("quality").alias("quality1"))
    b = second.select(*keys, F.col("read_id").alias("id2"), F.col("bases").alias("bases2"), F.col("quality").alias("quality2"))
    rules = [
        Rule("missing_mate", F.col("id1").isNull() | F.col("id2").isNull()),
        Rule("identity_mismatch", F.col("id1") != F.col("id2")),
    ]
    return a.join(b, keys, "full_outer").withColumn("violation", first_broken(rules))


def repeated_reads(reads: DataFrame, lane: list[str] | None = None) -> DataFrame:
    """Read ids that stand for more than one record of a file (or of a lane): the keys, ``read_id`` and ``n``."""
    return reads.groupBy(*(lane or []), "read_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def lane_summary(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reads, bases, quality range and an order-free digest of the read names per lane."""
    scores = phred(F.col("quality"))
    return reads.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reads"),
        F.sum(F.length("bases")).alias("bases"),
        F.min(F.array_min(scores)).alias("min_quality"),
        F.max(F.array_max(scores)).alias("max_quality"),
        F.sum(F.xxhash64("read_id").cast("decimal(38,0)")).cast("string").alias("name_digest"),
    )
