"""Domain derivation: design to calling, evaluation and holdout regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..sources.gtf import coding_features, parse_gtf
from ..sources.lines import good

AUTOSOMES = [f"chr{i}" for i in range(1, 23)]
HOLDOUT = ["chr20", "chr21", "chr22"]


def derive(design: DataFrame, confidence: DataFrame, contigs: DataFrame, padding: int = 100) -> DataFrame:
    """Calling, evaluation and holdout regions as one table with a ``domain`` column."""
    calling = iv.pad(design, contigs, padding)
    evaluation = iv.intersect(design.filter(F.col("contig").isin(AUTOSOMES)), confidence)
    both = calling.withColumn("domain", F.lit("calling")).unionByName(
        evaluation.withColumn("domain", F.explode(F.when(F.col("contig").isin(HOLDOUT), F.array(F.lit("evaluation"), F.lit("holdout"))).otherwise(F.array(F.lit("evaluation")))))
    )
    return both


def summary(domains: DataFrame) -> DataFrame:
    """Interval count and bases per domain."""
    return domains.groupBy("domain").agg(
        F.count(F.lit(1)).alias("intervals"), F.sum(F.col("end") - F.col("start")).alias("bases")
    )


def invariant_violations(design: DataFrame, confidence: DataFrame, domains: DataFrame, contigs: DataFrame) -> DataFrame:
    """Containment and bounds of the derived regions; empty when all hold."""
    def named(df: DataFrame, rule: str) -> DataFrame:
        return df.select(F.lit(rule).alias("rule"), "contig", "start", "end")

    calling = domains.filter("domain = 'calling'")
    evaluation = domains.filter("domain = 'evaluation'")
    return (
        named(iv.uncovered(design, calling), "design_outside_calling")
        .unionByName(named(iv.uncovered(evaluation, confidence), "evaluation_outside_confidence"))
        .unionByName(named(iv.bounds_violations(domains, contigs), "bounds"))
    )


def construct(annotation: DataFrame, confidence: DataFrame, contigs: DataFrame, padding: int = 100) -> DataFrame:
    """Domains from annotation lines: coding selection, union, then the derivation."""
    coding = iv.union(good(coding_features(parse_gtf(annotation), contigs)))
    return derive(coding, confidence, contigs, padding)


def pin_violations(domains: DataFrame, pins: DataFrame) -> DataFrame:
    """Domains whose interval count or bases differ from the approved numbers."""
    return _pin_differences(summary(domains), pins)


def _pin_differences(counted: DataFrame, pins: DataFrame) -> DataFrame:
    found = counted.withColumnsRenamed({"intervals": "found_intervals", "bases": "found_bases"})
    return pins.join(found, "domain", "left").filter(
        ~(F.col("intervals").eqNullSafe(F.col("found_intervals")) & F.col("bases").eqNullSafe(F.col("found_bases")))
    )


def pinned_summary(counted: DataFrame, pins: DataFrame) -> DataFrame:
    """Every built or pinned domain of a summary with its numbers; ``rule`` tells a wrong, missing or unapproved one."""
    broken = _pin_differences(counted, pins).select("domain", F.lit("pin").alias("_pin"))
    approved = pins.select("domain", F.lit(True).alias("_pinned")).join(broken, "domain", "left")
    return counted.join(approved, "domain", "full_outer").select(
        "domain", F.coalesce("intervals", F.lit(0)).alias("intervals"), F.coalesce("bases", F.lit(0)).alias("bases"),
        F.when(F.col("_pinned").isNull(), "unpinned").otherwise(F.col("_pin")).alias("rule"),
    )
