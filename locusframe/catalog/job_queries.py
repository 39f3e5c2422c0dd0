"""Channel-style composition and jobs that combine several areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..plans import domains
from ..streaming.tasks import replay_status_counts
from .registry import query, view
from .source_queries import _gtf
from . import views


@query("d01_mix", "SELECT side, count(*) AS n FROM iv GROUP BY 1")
def mix(t):
    both = t.left.withColumn("side", F.lit("a")).unionByName(t.right.withColumn("side", F.lit("b")))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("d02_combine_singleton", """
SELECT o_orderkey, o_totalprice > m AS above FROM orders CROSS JOIN (SELECT CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS m FROM orders)
""")
def combine_singleton(t):
    """Every row against a one-row value: the single-row side is an ungrouped aggregate."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    mean = t.read("orders").agg((F.sum(cents).cast("double") / F.count(F.lit(1)) / 100).alias("m"))
    return t.read("orders").crossJoin(F.broadcast(mean)).select("o_orderkey", (F.col("o_totalprice") > F.col("m")).alias("above"))


@query("d03_collect_sorted", """
SELECT conv_id, array_to_string(list(role ORDER BY turn), '>') AS roles FROM conversations GROUP BY 1
""")
def collect_sorted(t):
    """Members of a conversation in turn order; a conversation is short by nature."""
    rows = t.read("conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("r"))
    return rows.select("conv_id", F.array_join(F.transform("r", lambda x: x["role"]), ">").alias("roles"))


@query("d04_flat_map", "SELECT doc_id, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY 1")
def flat_map(t):
    lines = t.read("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))


@query("d05_map", "SELECT o_orderkey AS id, 's' || o_custkey AS sample FROM orders")
def map_rows(t):
    return t.read("orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("s"), "o_custkey").alias("sample"))


@query("d06_branch", "SELECT CASE WHEN cached THEN 'reused' ELSE 'executed' END AS branch, count(*) AS n FROM tk GROUP BY 1")
def branch(t):
    reused, executed = t.tasks.filter("cached"), t.tasks.filter("not cached")
    both = reused.withColumn("branch", F.lit("reused")).unionByName(executed.withColumn("branch", F.lit("executed")))
    return both.groupBy("branch").agg(F.count(F.lit(1)).alias("n"))


@query("d07_first_value", "SELECT contig, CAST(sum(length) - sum(first_length) AS BIGINT) AS rest FROM contigs CROSS JOIN (SELECT length AS first_length FROM contigs WHERE contig_idx = 1) GROUP BY 1")
def first_value(t):
    first = t.contigs.agg(F.min_by("length", "contig_idx").alias("first_length"))
    return t.contigs.crossJoin(F.broadcast(first)).select("contig", (F.col("length") - F.col("first_length")).alias("rest"))


@query("d08_first_per_key", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def first_per_key(t):
    """First row per key as a min over structs, which combines map-side."""
    rows = t.read("events").groupBy("user_id").agg(F.min(F.struct("event_id", "event_type")).alias("m"))
    return rows.select("user_id", "m.event_id")


@query("d09_selected_callers", "SELECT grp AS caller, count(*) AS n FROM tk WHERE grp IN ('caller_a', 'caller_b') GROUP BY 1")
def selected_callers(t):
    chosen = t.spark.createDataFrame([("caller_a",), ("caller_b",)], "caller string")
    rows = t.tasks.withColumnRenamed("group", "caller").join(chosen, "caller", "left_semi")
    return rows.groupBy("caller").agg(F.count(F.lit(1)).alias("n"))


view("coding", """
SELECT contig, "start", "end", length FROM gtfsrc WHERE feature IN ('CDS', 'stop_codon') AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_custkey % 5 <> 0 AND "end" <= length
""")
view("codingpad", """SELECT contig, greatest(0, "start" - 100) AS "start", least(length, "end" + 100) AS "end" FROM coding""")
view("codingcall", views.islands("codingpad"))
view("codingset", views.islands("coding"))
view("codingeval", """
SELECT a.contig, greatest(a."start", b."start") AS "start", least(a."end", b."end") AS "end" FROM codingset a JOIN ub b
ON a.contig = b.contig AND a."start" < b."end" AND b."start" < a."end"
""")
PINNED = """
SELECT 'calling' AS "domain", count(*) AS intervals, CAST(sum("end" - "start") AS BIGINT) AS bases FROM codingcall
UNION ALL SELECT 'evaluation', count(*), CAST(sum("end" - "start") AS BIGINT) FROM codingeval
"""


@query("c02_domain_construction", PINNED)
def domain_construction(t):
    """Domains from annotation text and confidence intervals, summarised."""
    built = domains.construct(_gtf(t), iv.union(t.right), t.contigs)
    return domains.summary(built).filter("domain <> 'holdout'")


@query("st1_task_ingest", """
SELECT epoch_us(date_trunc('hour', ts)) AS window_us, event_type AS "group", CASE WHEN user_id % 5 = 0 THEN 'CACHED' ELSE 'COMPLETED' END AS status, count(*) AS n
FROM events GROUP BY ALL
""")
def task_ingest(t):
    """The streaming ingest run over the events file until it is exhausted."""
    # A glob path serves both a single file and a folder of part files.
    counts = replay_status_counts(t.spark, f"{t.sf_dir}/events.parque[t]")
    return counts.select(F.unix_micros("window_start").alias("window_us"), "group", "status", "n")
