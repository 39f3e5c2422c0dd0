"""

The older jobs ``c02``, ``c06``, ``c10``, ``c11`` and ``c12`` keep their rows and twins; these hold their rows
and the parts they leave out. Twins are built from the twins of the parts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import safe_relative_path
from ..operators import intervals as iv
from ..operators import rules, traces
from ..operators.lineage import inventory_diff
from ..plans import acceptance, domains
from ..session import reliable_checkpoint
from . import job_queries, lineage_queries, read_queries, trace_queries, variant_queries
from .registry import ORACLES, query
from .source_queries import _gtf, content_inventory


def _part(name: str) -> str:
    return f"({ORACLES[name].strip()})"


def _tagged(prefix, rows, *key):
    return rows.select(F.concat(F.lit(prefix), "rule").alias("rule"), F.concat_ws("|", *key).alias("key"))


DOMAINS = job_queries.PINNED + """
UNION ALL SELECT 'holdout', count(*), CAST(sum("end" - "start") AS BIGINT) FROM codingeval WHERE contig IN ('chr20', 'chr21', 'chr22') HAVING count(*) > 0
"""


@query("c02_pinned_domains", f"""
SELECT "domain", CAST(intervals AS BIGINT) AS intervals, bases, CASE WHEN "domain" = 'holdout' THEN 'pin' END AS "rule" FROM ({DOMAINS})
UNION ALL SELECT 'target', 0, 0, 'pin'
""")
def pinned_domains(t):
    """All three domains against approved numbers: one is pinned a base too long, one pinned domain is never built."""
    built = domains.construct(_gtf(t), iv.union(t.right), t.contigs)
    # a row per domain; written once, as planning the construction takes most of the time
    counted = reliable_checkpoint(domains.summary(built))
    approved = counted.withColumn("bases", F.col("bases") + (F.col("domain") == "holdout").cast("bigint"))
    pins = approved.unionByName(t.spark.createDataFrame([("target", 1, 1)], "domain string, intervals long, bases long"))
    return domains.pinned_summary(counted, pins)


@query("c06_alignment_acceptance", f"""
SELECT 'reads:' || "rule" AS "rule", qname || '|' || mate AS "key" FROM {_part('j09_read_expectations')}
UNION ALL SELECT CASE WHEN left_count > right_count THEN 'recalibration:lost' ELSE 'recalibration:new' END, rid || '|' || flag FROM {_part('j10_before_after')}
UNION ALL SELECT 'read_group:' || "rule", read_group FROM {_part('j28_read_groups')}
UNION ALL SELECT 'order:unsorted', source || '|' || line_no FROM {_part('w02_coordinate_order')}
""")
def alignment_acceptance(t):
    """Every fault of expected reads, recalibration, read groups and coordinate order as one violations table."""
    changed = read_queries.before_after(t).withColumn("rule", F.when(F.col("left_count") > F.col("right_count"), "lost").otherwise("new"))
    unsorted = read_queries.coordinate_order(t).withColumn("rule", F.lit("unsorted"))
    return acceptance.combine(
        _tagged("reads:", read_queries.read_expectations(t), "qname", "mate"),
        _tagged("recalibration:", changed, "rid", "flag"),
        _tagged("read_group:", read_queries.read_groups(t), "read_group"),
        _tagged("order:", unsorted, "source", "line_no"),
    )


@query("c10_execution_acceptance", f"""
SELECT 'task' AS kind, task_identity_sha256, process, "group", status, cached, submitted_offset, started_offset, completed_offset,
       CAST(NULL AS BIGINT) AS tasks, CAST(NULL AS BIGINT) AS elapsed_us, CAST(NULL AS BIGINT) AS wall_us, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS "rule" FROM {_part('c10_execution_summary')}
UNION ALL SELECT 'group', NULL, NULL, grp, NULL, NULL, NULL, NULL, NULL, count(*), CASE WHEN NOT bool_or(cached) THEN max(end_us) - min(start_us) END,
       CAST(coalesce(sum(end_us - start_us) FILTER (NOT cached), 0) AS BIGINT), CASE WHEN bool_or(cached) THEN 'cached or unknown-cache tasks' END, NULL FROM tk GROUP BY grp
UNION ALL SELECT 'violation', sha256(CAST(task_id AS VARCHAR)), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, r FROM (
  SELECT task_id, unnest(list_filter([CASE WHEN cpu_cs IS NULL THEN 'cpu_cs:required' END, CASE WHEN status = 'ABORTED' THEN 'status:enum' END,
    CASE WHEN submit_us > start_us OR start_us > end_us THEN 'timeline' END, CASE WHEN cached <> (status = 'CACHED') THEN 'cache_label' END], lambda x: x IS NOT NULL)) AS r FROM tk)
""")
def execution_acceptance(t):
    """Task rows with offsets, one row per group with its elapsed interval and executed wall, and broken task contracts."""
    tasks = trace_queries.execution_summary(t).withColumn("kind", F.lit("task"))
    # a group whose tasks are all cached has executed nothing
    wall = traces.group_intervals(t.tasks, ["group"]).join(traces.executed_wall(t.tasks, ["group"]), "group", "left")
    groups = wall.withColumns({"kind": F.lit("group"), "wall_us": F.coalesce("wall_us", F.lit(0))})
    checks = [
        rules.required("cpu_cs"), rules.one_of("status", ["CACHED", "COMPLETED", "FAILED"]),
        rules.sql_rule("timeline", "submit_us > start_us or start_us > end_us"), rules.sql_rule("cache_label", "cached <> (status = 'CACHED')"),
    ]
    broken = rules.check(t.tasks, checks, F.sha2(F.col("task_id").cast("string"), 256))
    faults = broken.select(F.lit("violation").alias("kind"), F.col("key").alias("task_identity_sha256"), "rule")
    return tasks.unionByName(groups, allowMissingColumns=True).unionByName(faults, allowMissingColumns=True)


@query("c11_full_acceptance", f"""
SELECT "rule", "key" FROM {_part('c11_cross_acceptance')}
UNION ALL SELECT 'provider:unobserved', CAST(task_id AS VARCHAR) FROM {_part('j17_provider_join')} WHERE NOT observed
UNION ALL SELECT 'inputs:' || "rule", caller || '|' || sha256 FROM {_part('j19_symmetric_inputs')}
UNION ALL SELECT 'metrics:' || CASE variant_class WHEN 'en' THEN 'arithmetic' WHEN 'de' THEN 'counts' ELSE 'absent' END, variant_class FROM labelled WHERE variant_class IN ('en', 'de', 'fr')
UNION ALL SELECT 'metrics:unexpected', 'none'
UNION ALL SELECT 'contract:' || "rule", "key" FROM {_part('p14_contract_rules')}
""")
def full_acceptance(t):
    """Lineage, leaks, durable cover, provider links, caller inputs, recomputed metrics and contracts as one violations table."""
    provider = lineage_queries.provider_join(t).filter("not observed").withColumn("rule", F.lit("unobserved"))
    counts = variant_queries.label_metrics(t).select("variant_class", *acceptance.COUNTS)
    return acceptance.combine(
        lineage_queries.cross_acceptance(t),
        _tagged("provider:", provider, "task_id"),
        _tagged("inputs:", lineage_queries.symmetric_inputs(t), "caller", "sha256"),
        _tagged("metrics:", acceptance.metric_violations(_recorded(t), counts, "variant_class"), "variant_class"),
        _tagged("contract:", lineage_queries.contract_rules(t), "key"),
    )


def _recorded(t):
    """A report with a wrong ratio, a class scored on other counts, a class left out and one too many."""
    rows = variant_queries.label_metrics(t).filter("variant_class <> 'fr'").withColumn(
        "recall", F.when(F.col("variant_class") == "en", F.coalesce("recall", F.lit(0.0)) + 0.25).otherwise(F.col("recall"))
    )
    other = rows.filter("variant_class = 'de'").withColumn("fp", F.col("fp") + 1).select("variant_class", *acceptance.COUNTS)
    extra = t.spark.createDataFrame([("none", 0, 0, 0, 0)], "variant_class string, tp_query long, tp_truth long, fp long, fn long")
    scored = acceptance.scored(other.unionByName(extra))
    return rows.filter("variant_class <> 'de'").unionByName(scored)


@query("c12_bundle_acceptance", f"""
SELECT "rule", "key" FROM {_part('c12_bundle_verification')}
UNION ALL SELECT 'content:' || CASE WHEN doc_id % 41 = 0 THEN 'unexpected' ELSE 'changed' END, path FROM (SELECT source || '/' || doc_id AS path, doc_id FROM documents)
WHERE doc_id % 41 = 0 OR doc_id % 37 = 0 OR doc_id % 43 = 0 OR doc_id % 47 = 0
UNION ALL SELECT 'contract:' || r, path FROM (SELECT source || '/' || doc_id AS path, unnest(list_filter([
  CASE WHEN doc_id % 47 = 0 AND doc_id % 37 <> 0 THEN 'sha256:required' END, CASE WHEN doc_id % 37 = 0 THEN 'sha256:pattern' END,
  CASE WHEN doc_id % 43 = 0 THEN 'bytes:range' END], lambda x: x IS NOT NULL)) AS r FROM documents WHERE doc_id % 41 <> 0)
""")
def bundle_acceptance(t):
    """Bundle inventory and cross-links, hashes of the members' contents against the manifest, and the manifest's contract."""
    doc = F.col("doc_id")
    content = content_inventory(t)
    manifest = t.read("documents").filter(doc % 41 != 0).select(
        F.concat_ws("/", "source", "doc_id").alias("path"),
        F.when(doc % 37 == 0, F.upper(F.concat(F.lit("x"), F.sha2("text", 256)))).when(doc % 47 != 0, F.sha2("text", 256)).alias("sha256"),
        F.when(doc % 43 == 0, -1).otherwise(F.octet_length("text")).cast("bigint").alias("bytes"),
    )
    differs = inventory_diff(manifest, content).filter("status <> 'same'").withColumnRenamed("status", "rule")
    checks = [
        rules.required("sha256"), rules.pattern("sha256", "^[0-9a-f]{64}$"), rules.between("bytes", 0),
        rules.Rule("path:unsafe", ~safe_relative_path(F.col("path"))),
    ]
    return acceptance.combine(
        lineage_queries.bundle_verification(t),
        _tagged("content:", differs, "path"),
        _tagged("contract:", rules.check(manifest, checks, F.col("path")), "key"),
    )
