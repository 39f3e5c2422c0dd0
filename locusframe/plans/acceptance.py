"""Acceptance jobs: samplesheets, bundles, executions and text hygiene as violation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DETECTORS, IDENTIFIER, redact, hits
from ..operators import lineage, matching
from ..operators.rules import Rule, check, duplicates, first_broken

REQUIRED = ["sample", "library", "lane", "read_group_id", "platform_unit", "fastq_1", "fastq_2"]
IDENTIFIERS = REQUIRED[:5]
COUNTS = ["tp_query", "tp_truth", "fp", "fn"]
SCORES = ["precision", "recall", "f1", "missing_reasons"]


def combine(*violations: DataFrame) -> DataFrame:
    """One ``(rule, key)`` table of several checks."""
    return reduce(DataFrame.unionByName, [v.select("rule", F.col("key").cast("string").alias("key")) for v in violations])


def samplesheet_violations(rows: DataFrame, key: str) -> DataFrame:
    """Row rules and uniqueness rules of a samplesheet."""
    blank = [Rule(f"{c}:required", F.trim(F.coalesce(c, F.lit(""))) == "") for c in REQUIRED]
    unsafe = [Rule(f"{c}:identifier", ~F.col(c).rlike(IDENTIFIER)) for c in IDENTIFIERS]
    mates = [
        Rule("platform", F.coalesce("platform", F.lit("ILLUMINA")) != "ILLUMINA"),
        Rule("identical_mates", F.col("fastq_1") == F.col("fastq_2")),
        Rule("suffix", ~F.col("fastq_1").endswith(".fastq.gz") | ~F.col("fastq_2").endswith(".fastq.gz")),
    ]
    repeated = [
        duplicates(rows, names).select(F.lit(rule).alias("rule"), F.concat_ws("|", *names).alias("key"))
        for rule, names in (
            ("duplicate_row", REQUIRED),
            ("duplicate_read_group", ["read_group_id"]),
            ("duplicate_platform_unit", ["platform_unit"]),
        )
    ]
    return combine(check(rows, [*blank, *unsafe, *mates], F.col(key)), *repeated)


def cache_audit(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Declared sources against observed files: status per path plus declared-entry rule checks."""
    diff = lineage.inventory_diff(declared, observed).filter("status <> 'same'")
    invalid = check(declared, [Rule("sha256", ~F.col("sha256").rlike("^[0-9a-f]{64}$")), Rule("bytes", F.col("bytes") <= 0)], F.col("path"))
    return combine(diff.select(F.col("status").alias("rule"), F.col("path").alias("key")), invalid)


def bundle_violations(declared: DataFrame, observed: DataFrame, references: DataFrame) -> DataFrame:
    """Bundle inventory plus cross-links that name one file with several identities."""
    diff = lineage.inventory_diff(declared, observed).filter("status <> 'same'").select(F.col("status").alias("rule"), F.col("path").alias("key"))
    links = lineage.reference_agreement(references).filter("not agrees").select(F.lit("cross_link").alias("rule"), F.col("name").alias("key"))
    return combine(diff, links)


def hygiene(documents: DataFrame, key: str, text: str, roots: dict[str, str] | None = None) -> DataFrame:
    """Redacted text with the detectors that still fire on it."""
    clean = redact(F.col(text), roots or {})
    return documents.select(key, clean.alias("redacted")).withColumn("hits", hits(F.col("redacted"), DETECTORS))


def execution_summary(tasks: DataFrame, started: Column) -> DataFrame:
    """Public task rows: pseudonymous identity and offsets from the execution start."""
    return tasks.select(
        F.sha2(F.col("task_id").cast("string"), 256).alias("task_identity_sha256"),
        "process", "group", "status", "cached",
        (F.col("submit_us") - started).alias("submitted_offset"),
        (F.col("start_us") - started).alias("started_offset"),
        (F.col("end_us") - started).alias("completed_offset"),
    )


def receipts_joined(provider: DataFrame, native: DataFrame, links: DataFrame) -> DataFrame:
    """Provider tasks with their native observation where one exists (two left joins)."""
    linked = provider.join(links, "task_id", "left")
    return linked.join(native, ["process", "index", "attempt"], "left").withColumn(
        "observed", F.col("native_id").isNotNull()
    )


def scored(counts: DataFrame) -> DataFrame:
    """Metrics of counts with the reasons as text, the form in which reports record them."""
    return matching.metrics(counts).withColumn("missing_reasons", F.to_json("missing_reasons"))


def metric_violations(recorded: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Recorded metrics whose class is absent or unexpected, whose counts are not the counted ones, or that do not follow from their counts."""
    again = scored(recorded.select(key, *COUNTS, F.struct(*SCORES).alias("_recorded"), F.lit(True).alias("_have")))
    counted = counts.select(key, F.struct(*COUNTS).alias("_counts"), F.lit(True).alias("_want"))
    rules = [
        Rule("absent", F.col("_have").isNull()),
        Rule("unexpected", F.col("_want").isNull()),
        Rule("counts", ~F.struct(*COUNTS).eqNullSafe(F.col("_counts"))),
        Rule("arithmetic", ~F.struct(*SCORES).eqNullSafe(F.col("_recorded"))),
    ]
    return again.join(counted, key, "full_outer").select(key, first_broken(rules).alias("rule")).filter("rule is not null")
