"""Trace, reuse, cache and spend queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ..functions import evidence
from ..functions.text import process_name
from ..operators import rules, traces
from ..plans import acceptance
from ..sources import reports
from .adapters import GROUPS
from .registry import query, view


def _key():
    return F.col("event_id")


def _typed(t):
    return reports.parse_trace(t.raw_trace, GROUPS).filter("violation is null")


SUMS = """count(*) AS attempts, count(*) FILTER (status = 'ABORTED') AS n_aborted, count(*) FILTER (status = 'CACHED') AS n_cached,
  count(*) FILTER (status = 'COMPLETED') AS n_completed, count(*) FILTER (status = 'FAILED') AS n_failed,
  CAST(sum(duration_ms) AS DOUBLE) / 1000 AS duration_seconds,
  CASE WHEN count(realtime_ms) = count(*) THEN CAST(sum(realtime_ms) AS DOUBLE) / 1000 END AS realtime_seconds,
  CASE WHEN count(CASE WHEN realtime_ms > 0 THEN 1 END) = count(*) THEN CAST(sum(realtime_ms * cpu_halves) AS DOUBLE) / 2 / 360000000 END AS cpu_hours_estimated,
  CAST(max(peak_rss) AS DOUBLE) AS peak_rss_bytes, CASE WHEN count(peak_vmem) = count(*) THEN CAST(max(peak_vmem) AS DOUBLE) END AS peak_vmem_bytes"""
view("rsum", f"""
SELECT grp, cached, {SUMS} FROM tk GROUP BY grp, cached UNION ALL SELECT 'end_to_end', cached, {SUMS} FROM tk GROUP BY cached
""")


@query("a14_resource_summary", 'SELECT grp AS "group", * EXCLUDE (grp) FROM rsum')
def resource_summary(t):
    return traces.resource_summary(_typed(t)).withColumn("group", F.coalesce("group", F.lit("end_to_end"))).drop("realtime_reason", "cpu_reason")


@query("a12_complete_sum", """
SELECT process, cached, CASE WHEN count(realtime_ms) = count(*) THEN CAST(sum(realtime_ms) AS DOUBLE) END AS realtime_ms,
       CASE WHEN count(realtime_ms) <> count(*) THEN 'one or more task observations unavailable' END AS reason FROM tk GROUP BY ALL
""")
def complete_sum(t):
    ms = F.col("realtime_ms")
    return _typed(t).groupBy("process", "cached").agg(
        evidence.complete_sum(ms).cast("double").alias("realtime_ms"), evidence.incomplete_reason(ms).alias("reason")
    )


@query("a13_complete_max", """
SELECT process, CASE WHEN count(peak_vmem) = count(*) THEN CAST(max(peak_vmem) AS DOUBLE) END AS peak, CAST(max(peak_rss) AS DOUBLE) AS rss FROM tk GROUP BY 1
""")
def complete_max(t):
    return _typed(t).groupBy("process").agg(
        evidence.complete_max(F.col("peak_vmem_bytes")).cast("double").alias("peak"), evidence.complete_max(F.col("peak_rss_bytes")).cast("double").alias("rss")
    )


@query("a15_group_interval", """
SELECT grp AS "group", user_id, count(*) AS tasks, CAST(CASE WHEN NOT bool_or(cached) THEN max(end_us) - min(start_us) END AS DOUBLE) AS elapsed_us,
       CASE WHEN bool_or(cached) THEN 'cached or unknown-cache tasks' END AS reason FROM tk GROUP BY ALL
""")
def group_interval(t):
    return traces.group_intervals(t.tasks, ["group", "user_id"]).withColumn("elapsed_us", F.col("elapsed_us").cast("double"))


@query("a16_executed_wall", 'SELECT grp AS "group", CAST(sum(end_us - start_us) AS BIGINT) AS wall_us FROM tk WHERE NOT cached GROUP BY 1')
def executed_wall(t):
    return traces.executed_wall(t.tasks, ["group"])


@query("a17_stage_resources", """
SELECT grp AS "group", user_id, CAST(CASE WHEN count(cpu_cs) = count(*) THEN sum(cpu_cs) END AS DOUBLE) AS cpu_seconds, CAST(sum(end_us - start_us) AS DOUBLE) AS wall_seconds,
       CASE WHEN count(cpu_cs) <> count(*) THEN 'one or more task observations unavailable' END AS cpu_reason, CAST(NULL AS VARCHAR) AS wall_reason FROM tk GROUP BY ALL
""")
def stage_resources(t):
    rows = t.tasks.withColumns({"cpu_seconds": F.col("cpu_cs"), "wall_seconds": F.col("end_us") - F.col("start_us"), "stage": F.struct("group", "user_id")})
    return traces.stage_resources(rows, "stage").select(
        "stage.group", "stage.user_id", F.col("cpu_seconds").cast("double").alias("cpu_seconds"), F.col("wall_seconds").cast("double").alias("wall_seconds"),
        "cpu_reason", "wall_reason",
    )


@query("a24_process_counts", """
SELECT process, count(*) AS observed, count(*) + 1 AS expected FROM tk WHERE process IN ('VIEW', 'SIGNUP') GROUP BY 1
""")
def process_counts(t):
    expected = t.tasks.groupBy("process").agg((F.count(F.lit(1)) + F.col("process").isin("VIEW", "SIGNUP").cast("int")).alias("expected"))
    return rules.expected_counts(t.tasks, expected, "process")


@query("a25_status_counts", """
SELECT user_id, count(*) FILTER (status = 'ABORTED') AS n_aborted, count(*) FILTER (status = 'CACHED') AS n_cached,
       count(*) FILTER (status = 'COMPLETED') AS n_completed, count(*) FILTER (status = 'FAILED') AS n_failed FROM tk GROUP BY 1
""")
def status_counts(t):
    return traces.status_counts(t.tasks, ["user_id"])


@query("a26_member_agreement", "SELECT user_id, min(process) = max(process) AS agrees FROM tk GROUP BY 1")
def member_agreement(t):
    return rules.agreement(t.tasks, ["user_id"], "process")


@query("a23_duplicate_keys", "SELECT user_id, process, count(*) AS n FROM tk GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return rules.duplicates(t.tasks, ["user_id", "process"])


@query("s15_repeated_attempts", """
SELECT CAST(user_id + 1 AS BIGINT) AS task_id, count(*) AS n FROM tk GROUP BY 1
HAVING count(*) > 1 AND count(DISTINCT 1 + event_id % 2) < count(*)
""")
def repeated_attempts(t):
    rows = t.read("events").select((F.col("user_id") + 1).alias("task_id"), (1 + _key() % 2).cast("int").alias("attempt"))
    return reports.repeated_attempts(rows).select("task_id", "n")


view("phased", """
SELECT user_id || ':' || process AS task_key, event_id % 4 AS phase, min(md5(user_id || process || CASE WHEN event_id % 97 = 0 THEN 'x' ELSE '' END)) AS task_hash,
       CASE WHEN min(event_id) % 3 = 0 THEN 'COMPLETED' ELSE 'CACHED' END AS status FROM tk GROUP BY ALL
""".replace("GROUP BY ALL", "GROUP BY 1, 2"))


def _phased(t):
    mark = F.when(_key() % 97 == 0, "x").otherwise("")
    return t.tasks.groupBy(F.concat_ws(":", "user_id", "process").alias("task_key"), (_key() % 4).alias("phase")).agg(
        F.min(F.md5(F.concat("user_id", "process", mark))).alias("task_hash"),
        F.when(F.min("event_id") % 3 == 0, "COMPLETED").otherwise("CACHED").alias("status"),
    )


@query("j22_reuse_audit", """
SELECT task_key, phase, CASE WHEN status <> CASE WHEN rn = 1 THEN 'COMPLETED' ELSE 'CACHED' END THEN 'status'
       WHEN rn > 1 AND task_hash <> ph THEN 'hash' END AS violation FROM (
  SELECT *, row_number() OVER w AS rn, lag(task_hash) OVER w AS ph FROM phased WINDOW w AS (PARTITION BY task_key ORDER BY phase))
""")
def reuse_audit(t):
    return traces.reuse_audit(_phased(t)).select("task_key", "phase", "violation")


@query("w03_attempt_ordinal", """
SELECT task_key, phase, CAST(row_number() OVER (PARTITION BY task_key ORDER BY phase) AS INTEGER) AS ordinal FROM phased
""")
def attempt_ordinal(t):
    return traces.attempt_sequence(_phased(t), ["task_key"], "phase").select("task_key", "phase", "ordinal")


def _image(process, tag):
    return F.concat(F.lit("repo/"), F.lower(process), F.lit("@sha256:"), F.sha2(F.concat(process, tag), 256))


@query("j21_container_pins", """
SELECT event_id, CASE WHEN process = 'SIGNUP' THEN 'unknown_process' WHEN event_id % 5 = 0 THEN 'not_pinned' ELSE 'other_image' END AS "rule"
FROM tk WHERE process = 'SIGNUP' OR event_id % 5 = 0 OR event_id % 7 = 0
""")
def container_pins(t):
    pins = t.tasks.filter("process <> 'SIGNUP'").select("process").distinct().withColumn("image", _image(F.col("process"), F.lit("")))
    tag = F.when(_key() % 7 == 0, "z").otherwise("")
    tasks = t.tasks.withColumn("container", F.when(_key() % 5 == 0, "repo/tool:latest").otherwise(_image(F.col("process"), tag)))
    return traces.container_violations(tasks, pins).select("event_id", "rule")


DIMENSIONS = ["parameter", "input_content", "reference", "domain", "container", "command"]
view("cachecases", """
SELECT event_id AS suite, c AS "case", event_id % 8 = 3 AND c = 'reference' AS slip FROM events CROSS JOIN
  (VALUES ('first'), ('unchanged'), ('parameter'), ('input_content'), ('reference'), ('domain'), ('container'), ('command')) v(c)
""")


def _cases(t):
    """Eight cases per suite; some suites forget to change the reference, some hit without cause."""
    case = F.explode(F.array(*[F.lit(c) for c in ["first", "unchanged", *DIMENSIONS]]))
    rows = t.read("events").select("event_id", case.alias("case"))
    slip = (_key() % 8 == 3) & (F.col("case") == "reference")
    values = rows.select(
        F.col("event_id").alias("suite"), "case",
        *[F.concat(F.lit(d), F.when((F.col("case") == d) & ~slip, "B").otherwise("A")).alias(d) for d in DIMENSIONS],
        ((F.col("case") == "unchanged") | ((_key() % 11 == 0) & (F.col("case") == "domain"))).alias("hit"),
    )
    return values.withColumn("key", evidence.canonical_hash(*DIMENSIONS))


@query("j23_cache_matrix", """
SELECT suite, "case", CASE WHEN slip THEN 'wrong_dimension' WHEN suite % 11 = 0 AND "case" = 'domain' THEN 'hit' END AS violation FROM cachecases
""")
def cache_matrix(t):
    return traces.cache_matrix(_cases(t), DIMENSIONS).select("suite", "case", "violation")


@query("so06_single_dimension", """
SELECT suite, "case", "case" AS dimension FROM cachecases WHERE "case" NOT IN ('first', 'unchanged') AND NOT slip
""")
def single_dimension(t):
    return traces.single_dimension_cases(_cases(t), DIMENSIONS)


@query("w12_timeline", """
SELECT task_id, submit_us - o AS submitted_offset, start_us - o AS started_offset, end_us - o AS completed_offset, start_us - submit_us AS wait_us, end_us - start_us AS run_us
FROM tk JOIN (SELECT user_id, min(submit_us) AS o FROM tk GROUP BY 1) USING (user_id)
""")
def timeline(t):
    return traces.timeline(t.tasks, "user_id").select("task_id", "submitted_offset", "started_offset", "completed_offset", "wait_us", "run_us")


@query("a30_projected_spend", """
SELECT o_custkey, count(*) AS runs, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) + 12550 AS DOUBLE) / 100 AS projected FROM orders GROUP BY 1
""")
def projected_spend(t):
    spent = traces.projected_spend(_ledger(t), F.lit(Decimal("100.00")), F.lit(Decimal("25.50")), ["o_custkey"])
    return spent.withColumn("projected", F.col("projected").cast("double"))


def _ledger(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.read("orders").select("o_custkey", "o_orderkey", (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("reservation"))


@query("w08_committed_spend", """
SELECT o_orderkey, c > 50000000000 AS over_ceiling, CAST(c AS DOUBLE) / 100 AS committed FROM (
  SELECT o_orderkey, sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (ORDER BY o_orderkey) + 10000 AS c FROM orders)
""")
def committed_spend(t):
    ledger = _ledger(t).withColumn("account", F.lit("a"))
    seen = traces.committed_spend(ledger, ["account"], "o_orderkey", F.lit(Decimal("100.00")), F.lit(Decimal("500000000.00")))
    return seen.select("o_orderkey", "over_ceiling", F.col("committed").cast("double").alias("committed"))


@query("w10_latest_valid", """
SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
""")
def latest_valid(t):
    rows = t.read("orders").select("o_custkey", "o_orderkey", F.col("o_orderkey").alias("record"), (F.col("o_orderstatus") != "P").alias("valid"))
    return traces.latest_valid(rows, ["o_custkey"], "o_orderkey", "record").select("o_custkey", "o_orderkey")


@query("sc13_process_name", """
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN upper(event_type) END AS process FROM events
""")
def process_names(t):
    tag = F.when(_key() % 9 == 0, " (open").when(_key() % 2 == 0, "").otherwise(F.concat(F.lit(" (u"), "user_id", F.lit(")")))
    name = F.concat(F.when(_key() % 3 == 0, "").otherwise("MAIN:SUB:"), F.upper("event_type"), tag)
    return t.read("events").select("event_id", process_name(name).alias("process"))


@query("sc14_attribution", 'SELECT grp AS "group", process, count(*) AS n FROM tk GROUP BY ALL')
def attribution(t):
    return _typed(t).groupBy("group", "process").agg(F.count(F.lit(1)).alias("n"))


@query("sc15_number_parse", """
SELECT event_id, CASE WHEN event_id % 5 > 1 THEN CAST(event_id AS DOUBLE) + 0.25 END AS value, event_id % 5 = 1 AS malformed,
       CASE WHEN event_id % 5 = 0 THEN 'trace field rss unavailable' END AS reason FROM events
""")
def number_parse(t):
    plain = F.concat(_key().cast("string"), F.lit(".25"))
    bad = F.element_at(F.array(F.lit("-3"), F.lit("1.5 GB"), F.lit("NaN"), F.lit("1e3"), F.lit("9" * 24)), (F.floor(_key() / 5) % 5 + 1).cast("int"))
    gone = F.element_at(F.array(F.lit(""), F.lit("-"), F.lit("NA")), (_key() % 3 + 1).cast("int"))
    raw = F.when(_key() % 5 == 0, gone).when(_key() % 5 == 1, bad).otherwise(plain)
    return t.read("events").select("event_id", raw.alias("raw")).select(
        "event_id", evidence.number(F.col("raw")).cast("double").alias("value"), evidence.malformed_number(F.col("raw")).alias("malformed"),
        evidence.missing_reason(F.col("raw"), "rss").alias("reason"),
    )


@query("sc16_cpu_hours", """
SELECT task_id, CASE WHEN realtime_ms > 0 THEN CAST(realtime_ms AS DOUBLE) * (CAST(cpu_halves AS DOUBLE) / 2) / 360000000.0 END AS cpu_hours FROM tk
""")
def cpu_hours(t):
    return _typed(t).select("task_id", evidence.cpu_hours(F.col("realtime_ms"), F.col("cpu_percent")).alias("cpu_hours"))


@query("sc17_zoned_timestamps", """
SELECT event_id, CAST(CASE WHEN event_id % 6 <> 0 THEN epoch_us(date_trunc('second', ts)) - CASE WHEN event_id % 2 = 0 THEN 7200000000 ELSE 0 END END AS DOUBLE) AS micros FROM events
""")
def zoned_timestamps(t):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.when(_key() % 6 == 0, "").when(_key() % 2 == 0, "+02:00").otherwise("Z")
    return t.read("events").select("event_id", evidence.zoned_epoch_micros(F.concat(text, zone)).cast("double").alias("micros"))


@query("sc18_wall_time", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'invalid:two_sources' WHEN 1 THEN 'invalid:half_interval' WHEN 2 THEN 'provided_observation' WHEN 3 THEN 'unavailable' ELSE 'provided_invocation_timestamps' END AS source,
       CASE event_id % 5 WHEN 2 THEN value WHEN 4 THEN 90.0 END AS seconds FROM events
""")
def wall_time(t):
    kind = _key() % 5
    rows = t.read("events").select(
        "event_id", F.when(kind.isin(0, 2), F.col("value")).alias("observed"),
        F.when(kind.isin(0, 1, 4), "2024-01-01T00:00:00Z").alias("first"), F.when(kind == 4, "2024-01-01T02:01:30+02:00").alias("last"),
    )
    source = evidence.wall_source(F.col("observed"), F.col("first"), F.col("last"))
    seconds = evidence.wall_seconds(F.col("observed"), F.col("first"), F.col("last"))
    return rows.select("event_id", source.alias("source"), F.when(~source.startswith("invalid"), seconds).alias("seconds"))


@query("sc28_reservation_floor", """
SELECT o_orderkey, (o_custkey % 5) * 3600000 >= (o_orderkey % 1000 + 600) * ((o_custkey % 16) * 48 + (o_custkey % 64) * 2) + 1800000 AS enough FROM orders
""")
def reservation(t):
    """Is a reservation in whole dollars at or above its compute, storage and retry bound?"""
    floor = evidence.reservation_floor(
        F.col("o_orderkey") % 1000, F.lit(600), F.col("o_custkey") % 16, Decimal("0.048"), F.col("o_custkey") % 64, Decimal("0.002"), Decimal("0.5")
    )
    return t.read("orders").select("o_orderkey", (F.col("o_custkey") % 5 >= floor).alias("enough"))


@query("j27_accuracy_and_cost", """
SELECT user_id, a AS accuracy, c AS cost FROM (SELECT user_id, CASE WHEN user_id % 4 <> 0 THEN CAST(count(*) FILTER (status = 'COMPLETED') AS DOUBLE) / count(*) END AS a FROM tk GROUP BY 1)
JOIN (SELECT user_id, CAST(CASE WHEN count(cpu_cs) = count(*) THEN sum(cpu_cs) END AS DOUBLE) AS c FROM tk GROUP BY 1) USING (user_id) WHERE a IS NOT NULL AND c IS NOT NULL
""")
def accuracy_and_cost(t):
    accuracy = t.tasks.groupBy("user_id").agg(
        F.when(F.col("user_id") % 4 != 0, F.count_if(F.col("status") == "COMPLETED") / F.count(F.lit(1))).alias("accuracy")
    )
    cost = t.tasks.groupBy("user_id").agg(evidence.complete_sum(F.col("cpu_cs")).cast("double").alias("cost"))
    return traces.accuracy_and_cost(accuracy, cost, "user_id", "accuracy", "cost")


@query("p11_task_selection", "SELECT task_id, status FROM tk WHERE process = 'VIEW'")
def task_selection(t):
    return traces.select_tasks(t.tasks, "process", "VIEW").select("task_id", "status")


@query("c09_resource_self_check", "SELECT grp AS \"group\", cached, 'reported' AS side FROM rsum WHERE grp = 'caller_b' UNION ALL SELECT grp, cached, 'recomputed' FROM rsum WHERE grp = 'caller_b'")
def resource_self_check(t):
    """A stored report with one tampered group against its own recomputation."""
    report = traces.resource_summary(_typed(t))
    tampered = report.withColumn("attempts", F.col("attempts") + F.coalesce((F.col("group") == "caller_b").cast("int"), F.lit(0)))
    return traces.summary_differences(tampered, _typed(t)).select("group", "cached", "side")


@query("c10_execution_summary", """
SELECT sha256(CAST(task_id AS VARCHAR)) AS task_identity_sha256, process, grp AS "group", status, cached, submit_us - o AS submitted_offset, start_us - o AS started_offset, end_us - o AS completed_offset
FROM tk CROSS JOIN (SELECT min(submit_us) AS o FROM tk)
""")
def execution_summary(t):
    origin = t.tasks.agg(F.min("submit_us").alias("origin_us"))
    return acceptance.execution_summary(t.tasks.crossJoin(F.broadcast(origin)), F.col("origin_us"))


@query("sc23_task_pseudonym", "SELECT substr(sha256('run' || task_id), 1, 16) AS pseudonym, process FROM tk")
def task_pseudonym(t):
    return t.tasks.select(F.substring(F.sha2(F.concat(F.lit("run"), "task_id"), 256), 1, 16).alias("pseudonym"), "process")


@query("k05_resource_rows", """
SELECT grp || chr(9) || cached || chr(9) || attempts || chr(9) || n_failed AS line FROM rsum WHERE grp <> 'end_to_end'
""")
def resource_rows(t):
    rows = traces.resource_summary(_typed(t)).filter(F.col("group").isNotNull())
    return rows.select(F.concat_ws("\t", "group", F.col("cached").cast("string"), "attempts", "n_failed").alias("line"))
