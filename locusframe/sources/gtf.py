"""GTF annotation rows and the coding selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rules import Rule, first_broken
from .lines import field, field_count


def attribute(name: str) -> Column:
    """All quoted values of one attribute of a row; entries are parted by semicolons."""
    entries = F.transform(F.split("attributes", ";"), lambda e: F.ltrim(F.translate(e, "\t", " ")))
    named = F.filter(entries, lambda e: e.startswith(f'{name} "') & e.endswith('"') & (F.size(F.split(e, '"')) == 3))
    return F.filter(F.transform(named, lambda e: F.get(F.split(e, '"'), F.lit(1))), lambda v: v != "")


def parse_gtf(lines: DataFrame) -> DataFrame:
    """Nine-column rows with half-open coordinates."""
    return lines.filter(~F.col("value").startswith("#")).select(
        "source",
        "line_no",
        field(0).alias("contig"),
        field(2).alias("feature"),
        (field(3).try_cast("bigint") - 1).alias("start"),
        field(4).try_cast("bigint").alias("end"),
        field(8).alias("attributes"),
        F.when(field_count() != 9, "column_count").alias("violation"),
    )


def coding_features(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """CDS and stop codons of protein-coding genes, each row kept or tagged with a violation.

    Both biotypes must appear exactly once; a non-coding biotype drops the row, an absent or
    repeated one is a violation. Rows on a contig that is not listed are dropped, malformed lines never.
    """
    chosen = (
        rows.filter(F.col("feature").isin("CDS", "stop_codon") | F.col("violation").isNotNull())
        .join(contigs.select("contig", "contig_idx", "length"), "contig", "left")
        .filter(F.col("length").isNotNull() | F.col("violation").isNotNull())
        .withColumns({"_gene": attribute("gene_type"), "_transcript": attribute("transcript_type")})
    )
    single = (F.size("_gene") == 1) & (F.size("_transcript") == 1)
    coding = F.array_contains("_gene", "protein_coding") & F.array_contains("_transcript", "protein_coding")
    rules = [
        Rule("column_count", F.col("violation").isNotNull()),
        Rule("biotype", ~single),
        Rule("integer", F.col("start").isNull() | F.col("end").isNull()),
        Rule("bounds", ~((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("length")))),
    ]
    return chosen.filter(F.col("violation").isNotNull() | ~single | coding).select(
        "source", "line_no", "contig", "contig_idx", "feature", "start", "end", first_broken(rules).alias("violation")
    )
