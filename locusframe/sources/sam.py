"""SAM text: headers, records and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import previous
from ..operators.rules import Rule, first_broken
from .lines import cell, split_once

MANDATORY = 11


def header_tags(lines: DataFrame, record_type: str) -> DataFrame:
    """Tags of one header record type, e.g. ``@RG`` or ``@SQ``, as a map in file order."""
    tail = F.regexp_replace("value", rf"^{record_type}\t", "")
    return lines.filter(F.col("value").startswith(f"{record_type}\t")).select(
        "source", "line_no", F.str_to_map(tail, F.lit("\t"), F.lit(":")).alias("tags")
    )


def optional_tags(fields: Column) -> Column:
    """``TAG:TYPE:VALUE`` fields to a map; null when one is malformed or repeats."""
    rest = F.slice(fields, MANDATORY + 1, F.greatest(F.size(fields) - MANDATORY, F.lit(0)))
    names = F.transform(rest, lambda t: F.substring_index(t, ":", 1))
    values = F.transform(rest, lambda t: F.regexp_replace(t, "^[^:]*:[^:]*:", ""))
    valid = F.forall(rest, lambda t: t.rlike("^[^:]+:[^:]+:")) & (
        F.size(F.array_distinct(names)) == F.size(names)
    )
    return F.when(valid, F.map_from_arrays(names, values))


def parse_sam(lines: DataFrame) -> DataFrame:
    """Typed alignment rows; ``pos`` stays 1-based as in the text."""
    body = split_once(lines).filter(~cell(0).startswith("@"))
    parts = body.select(
        "source",
        "line_no",
        cell(0).alias("qname"),
        cell(1).try_cast("int").alias("flag"),
        cell(2).alias("contig"),
        cell(3).try_cast("bigint").alias("pos"),
        cell(4).try_cast("int").alias("mapq"),
        cell(5).alias("cigar"),
        cell(9).alias("seq"),
        cell(10).alias("qual"),
        F.when(F.size("_f") >= MANDATORY, optional_tags(F.col("_f"))).alias("tags"),
        F.size("_f").alias("_n"),
    )
    rules = [
        Rule("column_count", F.col("_n") < MANDATORY),
        Rule("integer", F.col("flag").isNull() | F.col("pos").isNull() | F.col("mapq").isNull()),
        Rule("tags", F.col("tags").isNull()),
        Rule("pair_flags", (F.col("flag").bitwiseAND(1) == 0) | ((F.col("flag").bitwiseAND(64) != 0) == (F.col("flag").bitwiseAND(128) != 0))),
        Rule("quality_range", ~F.col("qual").rlike("^[!-~]+$")),
    ]
    return parts.withColumn("violation", first_broken(rules)).drop("_n")


def sort_violations(records: DataFrame, contigs: DataFrame) -> DataFrame:
    """Records that precede the record before them; unmapped ones sort after every contig."""
    last = contigs.agg(F.max("contig_idx").alias("_last"))
    placed = (
        records.join(contigs.select("contig", "contig_idx"), "contig", "left")
        .crossJoin(last)
        .withColumn("_key", F.struct(F.coalesce("contig_idx", F.col("_last") + 1).alias("i"), F.coalesce("pos", F.lit(0)).alias("p")))
    )
    seen = previous(placed.select("source", "line_no", "_key"), ["source"], "line_no", ["_key"], "_before")
    return seen.filter(F.col("_key") < F.col("_before._key")).select("source", "line_no")
