"""Inventory, lineage and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import safe_object_uri, safe_relative_path
from ..operators import lineage, rules
from ..plans import acceptance
from .registry import query, view


def _key():
    return F.col("o_orderkey")


@query("so01_inventory_diff", "SELECT path, status FROM fdiff")
def inventory_diff(t):
    return lineage.inventory_diff(t.declared_files, t.observed_files)


@query("c14_source_cache_audit", """
SELECT status AS "rule", path AS "key" FROM fdiff WHERE status <> 'same' UNION ALL SELECT 'bytes', path FROM fa WHERE bytes <= 0
""")
def source_cache_audit(t):
    return acceptance.cache_audit(t.declared_files, t.observed_files)


@query("c12_bundle_verification", """
SELECT status AS "rule", path AS "key" FROM fdiff WHERE status <> 'same'
UNION ALL SELECT 'cross_link', CAST(o_custkey AS VARCHAR) FROM (SELECT o_custkey, o_orderstatus FROM orders) GROUP BY o_custkey HAVING min(o_orderstatus) <> max(o_orderstatus)
""")
def bundle_verification(t):
    links = t.read("orders").select(
        F.col("o_custkey").cast("string").alias("name"), F.sha2("o_orderstatus", 256).alias("sha256"), F.lit(1).alias("bytes")
    )
    return acceptance.bundle_violations(t.declared_files, t.observed_files, links)


@query("a31_declared_sizes", """
SELECT o_orderkey % 10 AS part, CAST(sum(CASE WHEN o_orderkey % 7 <> 0 THEN bytes ELSE 0 END) AS BIGINT) AS bytes, count(*) FILTER (o_orderkey % 7 = 0) AS unknown_sizes FROM fa GROUP BY 1
""")
def declared_sizes(t):
    rows = t.declared_files.select((_key() % 10).alias("part"), F.when(_key() % 7 != 0, F.col("bytes")).alias("bytes"))
    return lineage.declared_sizes(rows, ["part"])


def _artifacts(t):
    """Two tasks per order hand one file over; some hand over a different one, twice or never."""
    f = t.declared_files
    label = F.concat(F.lit("s"), "o_orderkey")
    made = f.select(F.lit("CALL").alias("process"), label.alias("label"), F.lit("output").alias("side"), F.lit("raw.vcf").alias("file"), "sha256", "bytes")
    read = f.filter(_key() % 11 != 0).select(
        F.lit("NORMALIZE").alias("process"), label.alias("label"), F.lit("input").alias("side"), F.lit("raw.vcf").alias("file"),
        F.when(_key() % 13 == 0, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"), "bytes",
    )
    twice = f.filter(_key() % 17 == 0).select(F.lit("CALL").alias("process"), label.alias("label"), F.lit("output").alias("side"), F.lit("raw.vcf").alias("file"), "sha256", "bytes")
    return made.unionByName(read).unionByName(twice)


@query("j18_artifact_lineage", """
SELECT 's' || o_orderkey AS label, CASE WHEN o_orderkey % 17 = 0 THEN 'output_count' WHEN o_orderkey % 11 = 0 THEN 'input_count' ELSE 'identity' END AS "rule"
FROM fa WHERE o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 OR (o_orderkey % 13 = 0 AND sha256 <> reverse(sha256))
""")
def artifact_lineage(t):
    edges = t.spark.createDataFrame([("CALL", "raw.vcf", "NORMALIZE", "raw.vcf")], "from_process string, from_file string, to_process string, to_file string")
    return lineage.broken_edges(_artifacts(t), edges).select("label", "rule")


@query("j19_symmetric_inputs", """
SELECT 'caller_a' AS caller, sha256, 'not_read' AS "rule" FROM fa GROUP BY sha256 HAVING bool_and(o_orderkey % 23 = 0)
UNION ALL SELECT 'caller_b', sha256(sha256 || 'b'), 'not_accepted' FROM fa WHERE o_orderkey % 29 = 0 GROUP BY sha256
""")
def symmetric_inputs(t):
    f = t.declared_files
    a = f.filter(_key() % 23 != 0).select(F.lit("caller_a").alias("caller"), "sha256")
    extra = f.filter(_key() % 29 == 0).select(F.lit("caller_b").alias("caller"), F.sha2(F.concat("sha256", F.lit("b")), 256).alias("sha256"))
    b = f.select(F.lit("caller_b").alias("caller"), "sha256")
    callers = t.spark.createDataFrame([("caller_a",), ("caller_b",)], "caller string")
    return lineage.asymmetric_inputs(a.unionByName(b).unionByName(extra), f, callers)


@query("j20_truth_leaks", """
SELECT path, sha256 FROM fb WHERE sha256 IN (SELECT sha256 FROM fa WHERE o_orderkey % 50 = 0)
""")
def truth_leaks(t):
    forbidden = t.declared_files.filter(_key() % 50 == 0)
    return lineage.leaks(t.observed_files, forbidden).select("path", "sha256")


view("durable", """
SELECT sha256, bytes, max(CASE WHEN o_orderkey % 19 = 0 THEN 'null' ELSE 'v' || o_orderkey % 3 END) AS version FROM fb GROUP BY ALL
""".replace("GROUP BY ALL", "GROUP BY sha256, bytes"))


@query("j24_durable_cover", """
SELECT path, CASE WHEN d.sha256 IS NULL THEN 'absent' ELSE 'unversioned' END AS "rule" FROM fa a LEFT JOIN durable d ON a.sha256 = d.sha256 AND a.bytes = d.bytes
WHERE d.sha256 IS NULL OR version IN ('', 'null')
""")
def durable_cover(t):
    version = F.when(_key() % 19 == 0, "null").otherwise(F.concat(F.lit("v"), _key() % 3))
    return lineage.not_durable(t.declared_files.select("path", "sha256", "bytes"), t.observed_files.withColumn("version", version)).select("path", "rule")


@query("j26_edge_endpoints", """
SELECT src, dst, 'src' AS side FROM edges WHERE src % 41 = 0 UNION ALL SELECT src, dst, 'dst' FROM edges WHERE dst % 41 = 0
""")
def edge_endpoints(t):
    return lineage.unknown_endpoints(t.edges, t.nodes.filter("node % 41 <> 0"))


@query("c15_cyclic_core", """
/*recursive*/ WITH walk AS (SELECT src AS origin, dst AS place FROM edges
  UNION SELECT origin, dst FROM walk JOIN edges ON src = place)
SELECT src, dst FROM edges WHERE src IN (SELECT origin FROM walk WHERE place = origin) AND dst IN (SELECT origin FROM walk WHERE place = origin)
""")
def cyclic_core(t):
    """The edge back makes 1, 5 and 2 a cycle; every other hand-over is peeled away."""
    return lineage.cyclic_core(t.edges)


@query("c15_ancestors", """
/*recursive*/ WITH up AS (SELECT max(o_orderkey) AS node, 0 AS steps FROM orders UNION SELECT dst, steps + 1 FROM up JOIN edges ON src = node WHERE steps < 64)
SELECT node, min(steps) AS steps FROM up GROUP BY 1
""")
def ancestors(t):
    start = t.nodes.agg(F.max("node").alias("node"))
    return lineage.ancestors(t.edges, start)


@query("j17_provider_join", """
SELECT event_id AS task_id, event_id % 3 <> 0 AND event_id % 5 <> 0 AS observed, CASE WHEN event_id % 3 <> 0 AND event_id % 5 <> 0 THEN 'n' || event_id END AS native_id FROM events
""")
def provider_join(t):
    e = t.read("events")
    key = F.col("event_id")
    provider = e.select(key.alias("task_id"))
    links = e.filter(key % 3 != 0).select(key.alias("task_id"), F.upper("event_type").alias("process"), key.alias("index"), F.lit(1).alias("attempt"))
    native = e.filter(key % 5 != 0).select(F.upper("event_type").alias("process"), key.alias("index"), F.lit(1).alias("attempt"), F.concat(F.lit("n"), key).alias("native_id"))
    return acceptance.receipts_joined(provider, native, links).select("task_id", "observed", "native_id")


@query("so08_forbidden_names", "SELECT DISTINCT path FROM fb WHERE path LIKE 'extra/%' AND o_orderkey % 2 = 0 AND o_orderkey % 13 = 0")
def forbidden_names(t):
    """Names that must not occur: the even lost files under their new place."""
    forbidden = t.declared_files.filter((_key() % 13 == 0) & (_key() % 2 == 0)).select(F.replace("path", F.lit("data/"), F.lit("extra/")).alias("path"))
    return t.observed_files.select("path").intersect(forbidden)


@query("p12_public_projection", "SELECT sha256, bytes, count(*) AS copies FROM fb GROUP BY 1, 2")
def public_projection(t):
    """Names are dropped; identities and their multiplicity stay."""
    return t.observed_files.groupBy("sha256", "bytes").agg(F.count(F.lit(1)).alias("copies"))


@query("p13_safe_names", """
SELECT o_orderkey, o_orderkey % 7 <> 0 AS path_ok, o_orderkey % 5 <> 0 AS uri_ok FROM orders
""")
def safe_names(t):
    path = F.when(_key() % 14 == 0, F.lit("/abs/x")).when(_key() % 7 == 0, F.lit("a/../b")).otherwise(F.concat(F.lit("data/"), _key(), F.lit(".bin")))
    uri = F.when(_key() % 10 == 0, F.lit("s3://bucket-a/x?sig=1")).when(_key() % 5 == 0, F.lit("s3://bucket-a/a//b")).otherwise(F.concat(F.lit("s3://bucket-a/k/"), _key(), F.lit(".bam")))
    return t.read("orders").select("o_orderkey", safe_relative_path(path).alias("path_ok"), safe_object_uri(uri).alias("uri_ok"))


@query("p14_contract_rules", """
SELECT r AS "rule", CAST(o_orderkey AS VARCHAR) AS "key" FROM (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_orderkey % 31 = 0 THEN 'status:required' END,
  CASE WHEN o_orderkey % 31 <> 0 AND o_orderstatus = 'P' THEN 'status:enum' END, CASE WHEN o_totalprice > 400000 THEN 'price:range' END,
  CASE WHEN NOT o_orderpriority LIKE '%-%' OR o_orderpriority LIKE '5-%' THEN 'priority:pattern' END, CASE WHEN o_custkey % 97 = 0 THEN 'customer_hold' END], lambda x: x IS NOT NULL)) AS r FROM orders)
""")
def contract_rules(t):
    rows = t.read("orders").select(
        "o_orderkey", "o_custkey", F.when(_key() % 31 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")
    )
    checks = [
        rules.required("status"), rules.one_of("status", ["F", "O"]), rules.between("price", 0, 400000), rules.pattern("priority", "^[1-4]-"),
        rules.sql_rule("customer_hold", "o_custkey % 97 = 0"),
    ]
    return rules.check(rows, checks, _key())


@query("o06_bounded_inventory", """
SELECT o_custkey, count(*) AS members, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS bytes FROM orders) GROUP BY 1 HAVING count(*) > 12 OR sum(bytes) > 400000000
""")
def bounded_inventory(t):
    """Inventories over a member or byte ceiling are reported; none is cut."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    sizes = t.read("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("members"), F.sum(cents).alias("bytes"))
    return sizes.filter("members > 12 or bytes > 400000000")


@query("o04_output_order", 'SELECT path, sha256, bytes FROM fb')
def output_order(t):
    return t.observed_files.select("path", "sha256", "bytes").orderBy("path", "sha256")


@query("c13_samplesheet_acceptance", """
SELECT r AS "rule", k AS "key" FROM (SELECT unnest(list_filter([CASE WHEN c_custkey % 19 = 0 THEN 'sample:required' END,
    CASE WHEN c_custkey % 19 = 0 THEN 'sample:identifier' END, CASE WHEN c_custkey % 23 = 0 THEN 'platform' END, CASE WHEN c_custkey % 29 = 0 THEN 'identical_mates' END], lambda x: x IS NOT NULL)) AS r, CAST(c_custkey AS VARCHAR) AS k FROM customer)
UNION ALL SELECT 'duplicate_read_group', 'rg' || c_custkey // 2 FROM customer WHERE c_custkey % 62 < 2 GROUP BY c_custkey // 2 HAVING count(*) > 1
""")
def samplesheet_acceptance(t):
    key = F.col("c_custkey")
    unit = F.concat(F.lit("pu"), key)
    rows = t.read("customer").select(
        key, F.when(key % 19 == 0, " ").otherwise(F.concat(F.lit("s"), key)).alias("sample"), F.lit("lib").alias("library"), F.lit("L1").alias("lane"),
        F.when(key % 62 < 2, F.concat(F.lit("rg"), F.floor(key / 2))).otherwise(F.concat(F.lit("u"), key)).alias("read_group_id"), unit.alias("platform_unit"),
        F.concat(unit, F.lit("_R1.fastq.gz")).alias("fastq_1"),
        F.concat(unit, F.when(key % 29 == 0, "_R1.fastq.gz").otherwise("_R2.fastq.gz")).alias("fastq_2"), F.when(key % 23 == 0, "OTHER").alias("platform"),
    )
    return acceptance.samplesheet_violations(rows, "c_custkey")


@query("c11_cross_acceptance", """
SELECT 'lineage:' || CASE WHEN o_orderkey % 17 = 0 THEN 'output_count' WHEN o_orderkey % 11 = 0 THEN 'input_count' ELSE 'identity' END AS "rule", 's' || o_orderkey AS "key"
FROM fa WHERE o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 OR (o_orderkey % 13 = 0 AND sha256 <> reverse(sha256))
UNION ALL SELECT 'leak', path FROM fb WHERE sha256 IN (SELECT sha256 FROM fa WHERE o_orderkey % 50 = 0)
UNION ALL SELECT 'durable:' || CASE WHEN d.sha256 IS NULL THEN 'absent' ELSE 'unversioned' END, path FROM fa a LEFT JOIN durable d ON a.sha256 = d.sha256 AND a.bytes = d.bytes
WHERE d.sha256 IS NULL OR version IN ('', 'null')
""")
def cross_acceptance(t):
    """All lineage checks as one violations table."""
    def tagged(prefix, rows, key):
        return rows.select(F.concat(F.lit(prefix), "rule").alias("rule"), F.col(key).alias("key"))

    leak = truth_leaks(t).withColumn("rule", F.lit("leak"))
    return acceptance.combine(
        tagged("lineage:", artifact_lineage(t), "label"), tagged("", leak, "path"), tagged("durable:", durable_cover(t), "path")
    )
