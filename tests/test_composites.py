from conftest import rows

from locusframe.catalog import load, registry
from locusframe.catalog.adapters import Tables
from locusframe.plans import acceptance, domains

SF = "/root/testdata/sf0.001"
#: Each composite with the parts whose faults its rules must tell, by the first word of the rule.
PARTS = {
    "c06_alignment_acceptance": {"reads", "recalibration", "read_group", "order"},
    "c11_full_acceptance": {"lineage", "leak", "durable", "provider", "inputs", "metrics", "contract"},
    "c12_bundle_acceptance": {"missing", "changed", "unexpected", "cross_link", "content", "contract"},
}


def test_composites_tell_the_faults_of_every_part(spark):
    load()
    for name, parts in PARTS.items():
        found = registry.QUERIES[name](Tables(spark, SF)).select("rule").distinct().collect()
        assert {r["rule"].split(":")[0] for r in found} == parts, name


def test_recorded_metrics_are_recomputed(spark):
    counts = spark.createDataFrame([("a", 3, 3, 1, 0), ("b", 0, 0, 0, 2), ("c", 1, 1, 1, 1), ("d", 1, 1, 0, 0)], "k string, tp_query long, tp_truth long, fp long, fn long")
    right = acceptance.scored(counts)
    assert rows(acceptance.metric_violations(right, counts, "k"), "k", "rule") == []
    # b: an undefined precision is recorded as 0; c: consistent, but of other counts; d: left out; e: too many
    zero = right.filter("k = 'b'").selectExpr("k", "tp_query", "tp_truth", "fp", "fn", "0.0D as precision", "recall", "f1", "missing_reasons")
    other = acceptance.scored(counts.filter("k = 'c'").selectExpr("k", "tp_query", "tp_truth", "fp + 1 as fp", "fn"))
    extra = acceptance.scored(counts.filter("k = 'a'").selectExpr("'e' as k", "tp_query", "tp_truth", "fp", "fn"))
    recorded = right.filter("k = 'a'").unionByName(zero).unionByName(other).unionByName(extra)
    assert rows(acceptance.metric_violations(recorded, counts, "k"), "k", "rule") == [("b", "arithmetic"), ("c", "counts"), ("d", "absent"), ("e", "unexpected")]


def test_domains_are_held_against_their_pins(spark):
    kinds = "domain string, intervals long, bases long"
    counted = spark.createDataFrame([("calling", 2, 10), ("evaluation", 1, 5), ("holdout", 1, 4), ("extra", 1, 1)], kinds)
    pins = spark.createDataFrame([("calling", 2, 10), ("evaluation", 1, 6), ("holdout", 1, 4), ("target", 3, 9)], kinds)
    got = {r["domain"]: (r["intervals"], r["bases"], r["rule"]) for r in domains.pinned_summary(counted, pins).collect()}
    assert got == {"calling": (2, 10, None), "evaluation": (1, 5, "pin"), "holdout": (1, 4, None), "extra": (1, 1, "unpinned"), "target": (0, 0, "pin")}


def test_rescue_returns_what_its_sql_returns(spark):
    """Two columns; every substitution told two ways is rescued, the lone truth rows are not."""
    load()
    got = registry.QUERIES["j14_haplotype_rescue"](Tables(spark, SF))
    assert got.columns == ["row_id", "rescued"]
    assert all(r.rescued == (int(r.row_id[1:]) % 5 != 0) or r.row_id[0] == "t" for r in got.collect())
