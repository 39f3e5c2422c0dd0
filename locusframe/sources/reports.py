"""Tool report tables: traces, depth, coverage and metrics sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.evidence import absent, malformed_number, number
from ..functions.text import SHA256, process_name, safe_relative_path
from ..operators.ordered import Running, running
from ..operators.rules import Rule, first_broken
from .lines import field, field_count

# Raw trace column, unit scale of each measure.
MEASURES = {
    "duration_ms": "duration",
    "realtime_ms": "realtime",
    "cpu_percent": "%cpu",
    "cpus": "cpus",
    "memory_bytes": "memory",
    "peak_rss_bytes": "peak_rss",
    "peak_vmem_bytes": "peak_vmem",
}
STATUSES = ("ABORTED", "CACHED", "COMPLETED", "FAILED")
INTEGRAL = ("cpus", "memory_bytes", "peak_rss_bytes", "peak_vmem_bytes")


def read_table(spark: SparkSession, path: str | list[str], columns: list[str], header: bool = True) -> DataFrame:
    """Tab-separated text with an explicit all-string schema; nothing is inferred."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.csv(path, sep="\t", header=header, schema=schema, enforceSchema=False, quote="", nullValue="\u0000")


def read_samplesheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Closed comma-separated samplesheet; a header that differs from ``columns`` fails."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def parse_trace(raw: DataFrame, attribution: dict[str, str]) -> DataFrame:
    """Raw all-string trace to typed attempts, one row each, with its first broken rule."""
    have = set(raw.columns)
    text = {out: (F.col(f"`{source}`") if source in have else F.lit(None).cast("string")) for out, source in MEASURES.items()}
    attempt = F.col("attempt") if "attempt" in have else F.lit(None).cast("string")
    groups = F.create_map(*[F.lit(x) for pair in attribution.items() for x in pair])
    process = process_name(F.col("name"))
    exit_code = F.when(~absent(F.col("exit")) & F.col("exit").rlike("^[0-9]+$"), F.col("exit").try_cast("int"))
    typed = raw.select(
        F.col("task_id").alias("_task"),
        F.when(F.col("task_id").rlike("^[1-9][0-9]*$"), F.col("task_id").try_cast("bigint")).alias("task_id"),
        F.when(number(attempt) == F.floor(number(attempt)), number(attempt).try_cast("int")).alias("attempt"),
        attempt.alias("_attempt"),
        "name",
        process.alias("process"),
        F.try_element_at(groups, process).alias("group"),
        "status",
        (F.col("status") == "CACHED").alias("cached"),
        F.when(~F.col("hash").isin("", "-"), F.col("hash")).alias("task_hash") if "hash" in have else F.lit(None).cast("string").alias("task_hash"),
        "exit",
        exit_code.alias("exit_code"),
        *[number(c).alias(out) for out, c in text.items()],
        F.array_compact(F.array(*[F.when(malformed_number(c), F.lit(out)) for out, c in text.items()])).alias("_bad"),
    )
    fractional = F.lit(False)
    for name in INTEGRAL:
        fractional = fractional | F.coalesce(F.col(name) != F.floor(name), F.lit(False))
    rules = [
        Rule("status", ~F.col("status").isin(*STATUSES)),
        Rule("process", F.col("process").isNull()),
        Rule("unattributed", F.col("group").isNull()),
        Rule("task_id", F.col("task_id").isNull()),
        Rule("exit", ~absent(F.col("exit")) & F.col("exit_code").isNull()),
        Rule("success_exit", F.col("status").isin("COMPLETED", "CACHED") & ~F.col("exit_code").eqNullSafe(F.lit(0))),
        Rule("number", F.size("_bad") > 0),
        Rule("integral", fractional),
        Rule("cpus", F.col("cpus") < 1),
        Rule("attempt", (F.col("attempt") < 1) | (F.col("attempt").isNull() & ~absent(F.col("_attempt")))),
    ]
    return typed.withColumn("violation", first_broken(rules)).drop("_task", "_attempt", "_bad", "exit")


def repeated_attempts(tasks: DataFrame) -> DataFrame:
    """Task ids whose attempts repeat or cannot be told apart (a null attempt among several)."""
    return (
        tasks.groupBy("task_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("attempt").alias("known"),
            F.count_distinct("attempt").alias("distinct_attempts"),
        )
        .filter("n > 1 and (known < n or distinct_attempts < known)")
    )


def section_table(lines: DataFrame, first_column: str) -> DataFrame:
    """Rows of the table that starts at the header line and ends at a blank or ``#`` line.

    Each row is a map from header name to text; ``shape_ok`` is false when its width differs.
    """
    header = (
        lines.filter(F.col("value").startswith(f"{first_column}\t"))
        .groupBy("source")
        .agg(F.min(F.struct("line_no", "value")).alias("_h"))
    )
    located = lines.join(header, "source").filter("line_no > _h.line_no")
    stop = located.filter(F.trim("value").isin("") | F.col("value").startswith("#")).groupBy("source").agg(
        F.min("line_no").alias("_stop")
    )
    body = located.join(stop, "source", "left").filter("_stop is null or line_no < _stop")
    names, values = F.split("_h.value", "\t", -1), F.split("value", "\t", -1)
    same = F.size(names) == F.size(values)
    return body.select(
        "source", "line_no", F.when(same, F.map_from_arrays(names, values)).alias("row"), same.alias("shape_ok")
    )


def recalibration_observations(lines: DataFrame) -> DataFrame:
    """Observation counts of every table that has ``Observations`` and ``Errors`` columns.

    A table ends at the first line of another width; the header is carried forward over the file
    with tiled running values, so a large report is never one window.
    """
    words = F.split(F.trim("value"), r"[ \t]+")
    is_head = F.array_contains(words, "Observations") & F.array_contains(words, "Errors")
    marked = lines.withColumn(
        "_h",
        F.when(
            is_head,
            F.struct(
                F.col("line_no").alias("at"),
                F.size(words).alias("n"),
                F.array_position(words, "Observations").cast("int").alias("column"),
            ),
        ),
    )
    headed = running(marked, ["source"], "line_no", {"_head": Running("last", "_h")})
    ends = (F.size(words) != F.col("_head.n")) | F.col("value").startswith("#")
    broken = headed.withColumn("_b", F.when(ends, F.col("line_no")))
    closed = running(broken, ["source"], "line_no", {"_broken": Running("max", "_b")})
    inside = (F.col("line_no") > F.col("_head.at")) & (
        F.col("_broken").isNull() | (F.col("_broken") < F.col("_head.at"))
    )
    return closed.filter(inside).select(
        "source",
        "line_no",
        F.col("_head.at").alias("table_line"),
        F.get(words, F.col("_head.column") - 1).try_cast("bigint").alias("observations"),
    )


def parse_depth(lines: DataFrame) -> DataFrame:
    """``contig, 1-based pos, depth`` rows."""
    return lines.select(
        "source",
        "line_no",
        field(0).alias("contig"),
        F.when(field(1).rlike("^[0-9]+$"), field(1).try_cast("bigint")).alias("pos"),
        F.when(field(2).rlike("^[0-9]+$"), field(2).try_cast("bigint")).alias("depth"),
        F.when((field_count() != 3) | ~field(1).rlike("^[0-9]+$") | ~field(2).rlike("^[0-9]+$"), "malformed").alias("violation"),
    )


def depth_total_violations(table: DataFrame, reference_bases: Column, tolerance: float = 0.011) -> DataFrame:
    """The ``total`` row of a depth summary against its own integers and the reference length."""
    row = table.filter("chrom = 'total'").select(
        F.col("length").try_cast("bigint").alias("length"),
        F.col("bases").try_cast("bigint").alias("bases"),
        F.col("mean").try_cast("double").alias("mean"),
        F.col("min").try_cast("bigint").alias("min"),
        F.col("max").try_cast("bigint").alias("max"),
    )
    rules = [
        Rule("length", F.col("length") != reference_bases),
        Rule("counts", (F.col("bases") < 0) | ~((F.col("min") >= 0) & (F.col("min") <= F.col("max")))),
        Rule("mean", F.abs(F.col("mean") - F.col("bases") / F.col("length")) > tolerance),
    ]
    return row.withColumn("violation", first_broken(rules))


def parse_file_inventory(lines: DataFrame) -> DataFrame:
    """``sha256, bytes, name`` rows with hash and path-safety checks."""
    parts = lines.select(
        "source",
        "line_no",
        field(0).alias("sha256"),
        F.when(field(1).rlike("^[0-9]+$"), field(1).try_cast("bigint")).alias("bytes"),
        field(2).alias("path"),
        field_count().alias("_n"),
    )
    rules = [
        Rule("column_count", F.col("_n") != 3),
        Rule("sha256", ~F.col("sha256").rlike(SHA256)),
        Rule("bytes", F.col("bytes").isNull()),
        Rule("path", ~safe_relative_path(F.col("path"))),
    ]
    return parts.withColumn("violation", first_broken(rules)).drop("_n")


def parse_index_counts(lines: DataFrame) -> DataFrame:
    """Index-count table ``contig, length, mapped, unmapped``; a count is a plain whole number."""
    counts = ("length", "mapped", "unmapped")
    parts = lines.select(
        "source",
        field(0).alias("contig"),
        *[F.when(field(i + 1).rlike("^[0-9]+$"), field(i + 1).try_cast("bigint")).alias(name) for i, name in enumerate(counts)],
        field_count().alias("_n"),
    )
    rules = [Rule("column_count", F.col("_n") != 4), *[Rule(name, F.col(name).isNull()) for name in counts]]
    return parts.withColumn("violation", first_broken(rules)).drop("_n")


def parse_samplesheet(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Comma-separated samplesheet lines (header excluded) with a closed column list; fields may be quoted."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_broken"])
    parsed = F.from_csv("value", schema, {"columnNameOfCorruptRecord": "_broken"})
    return lines.select("source", "line_no", parsed.alias("r")).select(
        "source", "line_no", *[F.col(f"r.`{c}`") for c in columns], F.when(F.col("r._broken").isNotNull(), "column_count").alias("violation")
    )
