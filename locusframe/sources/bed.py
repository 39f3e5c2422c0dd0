"""BED files, FASTA indexes, sequence dictionaries and interval lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Rule, duplicates, first_broken
from .lines import field, field_count

DIGITS = r"^-?[0-9]+$"


def _bounds(length: str = "length") -> Rule:
    inside = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col(length))
    return Rule("bounds", ~inside)


def parse_bed3(lines: DataFrame, contigs: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Exact three-column BED; every line is either a row or a named violation."""
    parts = lines.select(
        "source",
        "line_no",
        field(0).alias("contig"),
        field(1).try_cast("bigint").alias("start"),
        field(2).try_cast("bigint").alias("end"),
        field_count().alias("_n"),
    ).join(contigs.select("contig", "contig_idx", "length"), "contig", "left")
    rules = [
        Rule("column_count", F.col("_n") != 3),
        Rule("integer", F.col("start").isNull() | F.col("end").isNull()),
        Rule("unknown_contig", F.col("length").isNull()),
        _bounds(),
    ]
    if allowed is not None:
        rules.insert(3, Rule("contig_not_allowed", ~F.col("contig").isin(allowed)))
    return parts.select(
        "source", "line_no", "contig", "contig_idx", "start", "end", first_broken(rules).alias("violation")
    )


def parse_bed(lines: DataFrame, contigs: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """BED3+ with comment and track lines; unnamed rows are named after their line number."""
    body = lines.filter(~F.col("value").rlike("^(#|track|browser)") & (F.col("value") != ""))
    parts = body.select(
        "source",
        "line_no",
        field(0).alias("contig"),
        field(1).try_cast("bigint").alias("start"),
        field(2).try_cast("bigint").alias("end"),
        F.coalesce(field(3), F.format_string("interval_%08d", "line_no")).alias("name"),
        field_count().alias("_n"),
    ).join(contigs.select("contig", "contig_idx", "length"), "contig", "left")
    violation = first_broken(
        [
            Rule("column_count", F.col("_n") < 3),
            Rule("unknown_contig", F.col("length").isNull()),
            Rule("integer", F.col("start").isNull() | F.col("end").isNull()),
            _bounds(),
        ]
    )
    if allowed is None:
        return parts.select("source", "line_no", "contig", "contig_idx", "start", "end", "name", violation.alias("violation"))
    off = F.col("length").isNotNull() & F.col("start").isNotNull() & ~F.col("contig").isin(allowed)
    return parts.filter(~off | (F.col("_n") < 3)).select(
        "source", "line_no", "contig", "contig_idx", "start", "end", "name", violation.alias("violation")
    )


def parse_interval_list(lines: DataFrame) -> DataFrame:
    """1-based closed interval list back to half-open rows."""
    return lines.filter(~F.col("value").startswith("@") & (F.col("value") != "")).select(
        "source",
        "line_no",
        field(0).alias("contig"),
        (field(1).try_cast("bigint") - 1).alias("start"),
        field(2).try_cast("bigint").alias("end"),
        field(4).alias("name"),
    )


def parse_fasta_index(lines: DataFrame) -> DataFrame:
    """Five-column FASTA index: contig lengths, checked for shape and sign."""
    parts = lines.select(
        "source",
        "line_no",
        field(0).alias("contig"),
        field(1).try_cast("bigint").alias("length"),
        field(2).try_cast("bigint").alias("offset"),
        field(3).try_cast("bigint").alias("line_bases"),
        field(4).try_cast("bigint").alias("line_bytes"),
        field_count().alias("_n"),
    )
    rules = [
        Rule("column_count", F.col("_n") != 5),
        Rule("length", F.col("length").isNull() | (F.col("length") <= 0)),
    ]
    return parts.withColumn("violation", first_broken(rules)).drop("_n")


def repeated_contigs(index: DataFrame) -> DataFrame:
    return duplicates(index, ["contig"])


def parse_sequence_dictionary(lines: DataFrame) -> DataFrame:
    """``@SQ`` lines to ``(contig, length, md5)`` in dictionary order, with the first rule that a line breaks:
    ``repeated_tag``, ``name`` (SN missing or empty), ``length`` (LN missing, no number or not positive) or
    ``md5`` (M5 stated, but no digest)."""
    tags = F.filter(F.split("value", "\t", -1), lambda x: x.rlike("^[A-Za-z][A-Za-z0-9]:"))
    names = F.transform("_tags", lambda x: F.substring(x, 1, 2))

    def tag(name: str) -> Column:
        return F.substring(F.get(F.filter("_tags", lambda x: x.startswith(f"{name}:")), F.lit(0)), 4, 2**31 - 1)

    parts = lines.filter(F.col("value").startswith("@SQ\t")).withColumn("_tags", tags).select(
        "source",
        "line_no",
        tag("SN").alias("contig"),
        tag("LN").try_cast("bigint").alias("length"),
        F.lower(tag("M5")).alias("md5"),
        (F.size(F.array_distinct(names)) < F.size("_tags")).alias("_again"),
    )
    rules = [
        Rule("repeated_tag", F.col("_again")),
        Rule("name", F.coalesce("contig", F.lit("")) == ""),
        Rule("length", F.col("length").isNull() | (F.col("length") <= 0)),
        Rule("md5", F.col("md5").isNotNull() & ~F.col("md5").rlike("^[0-9a-f]{32}$")),
    ]
    return parts.withColumn("violation", first_broken(rules)).drop("_again")
