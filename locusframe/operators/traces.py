"""Execution-trace analytics: resources, reuse, cache keys, timelines and spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.evidence import complete_max, complete_sum, incomplete_reason
from ..functions.text import pinned_digest
from .ordered import Running, running
from .rules import Rule, first_broken
from .skew import salted_join

STATUSES = ("ABORTED", "CACHED", "COMPLETED", "FAILED")
#: Cases that one task of ``cache_matrix`` sorts.
DEALT_ROWS = 500_000


def with_cpu_work(tasks: DataFrame) -> DataFrame:
    """Add ``cpu_work``: realtime ms x CPU percent as an exact decimal; null without positive realtime."""
    work = F.col("realtime_ms").cast("decimal(18,3)") * F.col("cpu_percent").cast("decimal(12,3)")
    return tasks.withColumn("cpu_work", F.when(F.col("realtime_ms") > 0, work))


def resource_summary(tasks: DataFrame) -> DataFrame:
    """Per group and end to end (null group), executed and cached attempts kept apart.

    Sums and maxima are null unless every member is known, and then carry the reason. Sums stay
    exact decimals until the last unit conversion, so the result does not depend on task order.
    """
    rated = with_cpu_work(tasks)
    status = [F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in STATUSES]
    summed = rated.groupingSets([["group", "cached"], ["cached"]], "group", "cached").agg(
        F.count(F.lit(1)).alias("attempts"),
        *status,
        (complete_sum(F.col("duration_ms")).cast("double") / 1000).alias("duration_seconds"),
        (complete_sum(F.col("realtime_ms")).cast("double") / 1000).alias("realtime_seconds"),
        (complete_sum(F.col("cpu_work")).cast("double") / 360_000_000).alias("cpu_hours_estimated"),
        complete_max(F.col("peak_rss_bytes")).cast("double").alias("peak_rss_bytes"),
        complete_max(F.col("peak_vmem_bytes")).cast("double").alias("peak_vmem_bytes"),
        incomplete_reason(F.col("realtime_ms")).alias("realtime_reason"),
        incomplete_reason(F.col("cpu_work")).alias("cpu_reason"),
    )
    return summed


def summary_differences(reported: DataFrame, tasks: DataFrame) -> DataFrame:
    """Recompute a stored summary and return the rows that differ."""
    fresh = resource_summary(tasks).select(reported.columns)
    return reported.exceptAll(fresh).withColumn("side", F.lit("reported")).unionByName(
        fresh.exceptAll(reported).withColumn("side", F.lit("recomputed"))
    )


def stage_resources(tasks: DataFrame, stage: str = "group") -> DataFrame:
    """CPU and wall per stage with reasons; a stage's CPU is known only when all its rows know it."""
    return tasks.groupBy(stage).agg(
        complete_sum(F.col("cpu_seconds")).alias("cpu_seconds"),
        complete_sum(F.col("wall_seconds")).alias("wall_seconds"),
        incomplete_reason(F.col("cpu_seconds")).alias("cpu_reason"),
        incomplete_reason(F.col("wall_seconds")).alias("wall_reason"),
    )


def group_intervals(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """Elapsed interval per group (max end - min start), only when every row is a cache miss."""
    misses = F.count_if(F.col("cached")) == 0
    return tasks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.when(misses, F.max("end_us") - F.min("start_us")).alias("elapsed_us"),
        F.when(~misses, "cached or unknown-cache tasks").alias("reason"),
    )


def executed_wall(tasks: DataFrame, keys: list[str]) -> DataFrame:
    """Summed task wall over cache misses, failures included."""
    return tasks.filter(~F.col("cached")).groupBy(*keys).agg(
        F.sum(F.col("end_us") - F.col("start_us")).alias("wall_us")
    )


def timeline(tasks: DataFrame, run: str) -> DataFrame:
    """Offsets from the run's first submission, with wait and run durations (microseconds).

    The origin is an aggregate joined back, so a run with most of the tasks is not one window.
    """
    origin = tasks.groupBy(run).agg(F.min("submit_us").alias("origin_us"))
    return salted_join(tasks, origin, [run], "left").select(
        *[c for c in tasks.columns],
        (F.col("submit_us") - F.col("origin_us")).alias("submitted_offset"),
        (F.col("start_us") - F.col("origin_us")).alias("started_offset"),
        (F.col("end_us") - F.col("origin_us")).alias("completed_offset"),
        (F.col("start_us") - F.col("submit_us")).alias("wait_us"),
        (F.col("end_us") - F.col("start_us")).alias("run_us"),
    )


def reuse_audit(tasks: DataFrame, key: str = "task_key") -> DataFrame:
    """Tasks over ordered phases: the first sight must be COMPLETED, later ones CACHED with its hash.

    A key occurs once per phase, so its window holds at most one row per phase.
    """
    w = Window.partitionBy(key).orderBy("phase")
    seen = tasks.withColumns(
        {"ordinal": F.row_number().over(w), "previous_hash": F.lag("task_hash").over(w)}
    ).withColumn("expected", F.when(F.col("ordinal") == 1, "COMPLETED").otherwise("CACHED"))
    rules = [
        Rule("status", F.col("status") != F.col("expected")),
        Rule("hash", (F.col("ordinal") > 1) & ~F.col("task_hash").eqNullSafe(F.col("previous_hash"))),
    ]
    return seen.withColumn("violation", first_broken(rules))


def attempt_sequence(tasks: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Ordinal of each attempt inside its task key."""
    return tasks.withColumn("ordinal", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))


def status_counts(tasks: DataFrame, keys: list[str]) -> DataFrame:
    return tasks.groupBy(*keys).agg(*[F.count_if(F.col("status") == s).alias(f"n_{s.lower()}") for s in STATUSES])


def container_violations(tasks: DataFrame, pins: DataFrame) -> DataFrame:
    """Tasks whose container is not the digest-pinned image of their process."""
    joined = tasks.join(pins.select("process", "image"), "process", "left")
    rules = [
        Rule("unknown_process", F.col("image").isNull()),
        Rule("not_pinned", pinned_digest(F.col("container")).isNull()),
        Rule("other_image", F.col("container") != F.col("image")),
    ]
    return joined.withColumn("rule", first_broken(rules)).filter("rule is not null").drop("image")


def cache_matrix(cases: DataFrame, dimensions: list[str], baseline: str = "first") -> DataFrame:
    """Every case against the baseline case of its suite.

    A case named after a dimension must change exactly that dimension and its key; ``unchanged``
    must change none and hit the cache. ``cases``: ``suite, case, <dimensions>, key, hit``.

    Cases are counted first and dealt in parts of about ``DEALT_ROWS``: their texts repeat, so parts chosen by
    their compressed size would fill a task's memory, and so would baselines that pass for small.
    """
    parts = -(-cases.count() // DEALT_ROWS) or 1
    base = cases.filter(F.col("case") == baseline).select(
        "suite", *[F.col(d).alias(f"b_{d}") for d in dimensions], F.col("key").alias("b_key")
    )
    joined = cases.repartition(parts, "suite").join(base.repartition(parts, "suite").hint("merge"), "suite", "left")
    changed = F.array_compact(
        F.array(*[F.when(~F.col(d).eqNullSafe(F.col(f"b_{d}")), F.lit(d)) for d in dimensions])
    )
    rated = joined.withColumn("changed", changed)
    same_key = F.col("key") == F.col("b_key")
    named = F.col("case").isin(*dimensions)
    rules = [
        Rule("no_baseline", F.col("b_key").isNull()),
        Rule("wrong_dimension", named & ~((F.size("changed") == 1) & F.array_contains("changed", F.col("case")))),
        Rule("unexpected_change", ~named & (F.size("changed") > 0)),
        Rule("key_not_changed", named & same_key),
        Rule("key_changed", ~named & ~same_key),
        Rule("hit", F.col("hit") != (F.col("case") == "unchanged")),
    ]
    return rated.withColumn("violation", first_broken(rules)).drop("b_key", *[f"b_{d}" for d in dimensions])


def single_dimension_cases(cases: DataFrame, dimensions: list[str], baseline: str = "first") -> DataFrame:
    """Cases that differ from their suite's baseline in exactly one dimension."""
    return cache_matrix(cases, dimensions, baseline).filter("size(changed) = 1").select(
        "suite", "case", F.get("changed", F.lit(0)).alias("dimension")
    )


def projected_spend(ledger: DataFrame, baseline: Column, reserves: Column, keys: list[str]) -> DataFrame:
    """Baseline plus fixed reserves plus every reservation; nothing is released on failure."""
    return ledger.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), (F.sum("reservation") + baseline + reserves).alias("projected")
    )


def committed_spend(ledger: DataFrame, keys: list[str], sequence: str, baseline: Column, ceiling: Column) -> DataFrame:
    """Running commitment in submission order and whether it passes the ceiling.

    ``sequence`` is the integer submission number; the sum runs over tiles of it, so one ledger
    with most of the rows is still spread out.
    """
    summed = running(ledger, keys, sequence, {"_committed": Running("sum", "reservation")})
    return summed.withColumn("committed", F.col("_committed") + baseline).drop("_committed").withColumn(
        "over_ceiling", F.col("committed") > ceiling
    )


def latest_valid(records: DataFrame, keys: list[str], sequence: str, row_id: str) -> DataFrame:
    """The newest valid record of each key; a map-side max, not a window."""
    newest = records.filter("valid").groupBy(*keys).agg(
        F.max(F.struct(sequence, row_id)).alias("_m")
    )
    return newest.select(*keys, F.col(f"_m.{sequence}").alias(sequence), F.col(f"_m.{row_id}").alias(row_id))


def accuracy_and_cost(accuracy: DataFrame, cost: DataFrame, key: str, measure: str, price: str) -> DataFrame:
    """Pairs of a metric and a cost where both are known."""
    return accuracy.join(cost, key).filter(F.col(measure).isNotNull() & F.col(price).isNotNull())


def select_tasks(tasks: DataFrame, column: str, choice: str) -> DataFrame:
    """Rows of one exact choice or ``all``; an unknown choice raises."""
    if choice == "all":
        return tasks
    chosen = tasks.filter(F.col(column) == choice)
    if chosen.isEmpty():
        raise ValueError(f"unknown {column}: {choice}")
    return chosen
