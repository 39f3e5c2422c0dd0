"""Variant, matching and benchmark queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import genotype
from ..functions.text import bounded, bounded_number
from ..operators import haplotypes, matching, variants
from ..operators.rules import first_broken, multiset_difference, settled
from ..plans import benchmark
from ..sources.vcf import native_rules, record_rules, repeated_alleles
from .adapters import reference_line
from .registry import query, view


# REF of the adapter's variants has one or two bases
SPAN = variants.LOOKBACK + 2


def _part():
    return F.col("l_partkey")


def _included(t, side):
    return variants.included(variants.split_alleles(t.variants.filter(side)))


@query("p06_inclusion_policy", """
SELECT is_query, is_truth, coalesce(reason, 'included') AS reason, count(*) AS n FROM vreason GROUP BY ALL
""")
def inclusion_policy(t):
    tagged = variants.with_inclusion(variants.split_alleles(t.variants))
    return tagged.groupBy("is_query", "is_truth", F.coalesce("reason", F.lit("included")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("a11_exclusion_counts", "SELECT reason, count(*) AS n FROM vreason WHERE reason IS NOT NULL GROUP BY 1")
def exclusion_counts(t):
    return variants.exclusion_counts(variants.split_alleles(t.variants))


@query("p07_filter_acceptance", """SELECT contig, count(*) AS n FROM vraw WHERE "filter" IN ('PASS', '.') GROUP BY 1""")
def filter_acceptance(t):
    return t.variants.filter(F.col("filter").isin("PASS", ".")).groupBy("contig").agg(F.count(F.lit(1)).alias("n"))


BROKEN = """CASE WHEN l_partkey % 101 = 0 THEN 'position' WHEN l_partkey % 103 = 0 THEN 'ref_alphabet' WHEN l_partkey % 107 = 0 THEN 'alt_symbolic'
       WHEN l_partkey % 109 = 0 THEN 'alt_equals_ref' WHEN l_partkey % 113 = 0 THEN 'alt_repeated' WHEN l_partkey % 127 = 0 THEN 'genotype'
       WHEN l_partkey % 131 = 0 THEN 'allele_index' END"""


@query("p08_variant_validity", f"""SELECT row_id, {BROKEN} AS "rule" FROM vraw WHERE {BROKEN} IS NOT NULL""")
def variant_validity(t):
    return settled(_damaged(t), "rule", first_broken(record_rules())).filter("rule is not null").select("row_id", "rule")


def _damaged(t):
    alt = F.get("alts", F.lit(0))
    return t.variants.withColumns(
        {
            "pos": F.when(_part() % 101 == 0, 0).otherwise(F.col("pos")),
            "alts": F.when(_part() % 107 == 0, F.array(F.lit("<DEL>"))).when(_part() % 109 == 0, F.array("ref")).when(
                _part() % 113 == 0, F.array(alt, alt)).otherwise(F.col("alts")),
            "gt": F.when(_part() % 127 == 0, "x/1").when(_part() % 131 == 0, "0/5").otherwise(F.col("gt")),
        }
    ).withColumn("ref", F.when(_part() % 103 == 0, F.concat("ref", F.lit("N"))).otherwise(F.col("ref")))


@query("s14_native_rules", """
SELECT row_id, CASE WHEN l_partkey % 11 = 0 THEN 'qual' ELSE 'end' END AS "rule" FROM vraw WHERE l_partkey % 11 = 0 OR l_partkey % 13 = 0
""")
def native_record_rules(t):
    rows = t.variants.withColumns(
        {
            "qual": F.when(_part() % 22 == 0, -1.0).when(_part() % 11 == 0, float("nan")).otherwise(50.0),
            "end": F.when(_part() % 13 == 0, F.col("pos") - 1).otherwise(F.col("pos")),
        }
    )
    return rows.select("row_id", first_broken(native_rules()).alias("rule")).filter("rule is not null")


@query("a23_repeated_alleles", """
SELECT contig, pos, ref, alt, count(*) AS n FROM vsplit GROUP BY 1, 2, 3, 4 HAVING count(*) > 1
""")
def repeated(t):
    return repeated_alleles(t.variants)


view("refbad", """
SELECT v.* FROM vraw v LEFT JOIN refwin r ON r.contig = v.contig AND r.k = (v.pos - 1) // 8
WHERE coalesce(substr(r.bases, CAST((v.pos - 1) % 8 + 1 AS INTEGER), length(v.ref)), '') <> v.ref
""")


@query("j11_reference_check", "SELECT row_id, contig, pos, ref FROM refbad")
def reference_check(t):
    return variants.reference_mismatches(t.variants, t.chunks, "row_id").select("row_id", "contig", "pos", "ref")


def _known_sites(t):
    return t.variants.withColumn("contig", F.when(_part() % 9 == 0, F.concat(F.lit("alt"), _part() % 4)).otherwise(F.col("contig")))


@query("p09_known_site_filter", """
SELECT 'alt' || l_partkey % 4 AS contig, count(*) AS removed FROM vraw WHERE l_partkey % 9 = 0 GROUP BY 1
""")
def known_site_filter(t):
    return variants.known_site_filter(_known_sites(t), t.contigs, t.chunks, "row_id")[1]


@query("c08_known_sites", """
SELECT (SELECT count(*) FROM vraw WHERE l_partkey % 9 <> 0) AS kept, (SELECT count(*) FROM vraw WHERE l_partkey % 9 = 0) AS removed,
       (SELECT count(*) FROM refbad WHERE l_partkey % 9 <> 0) AS wrong_ref, 0 AS recount_differences
""")
def known_sites(t):
    """Filtered known sites, and the kept rows recounted against an independent filter."""
    kept, removed, wrong = variants.known_site_filter(_known_sites(t), t.contigs, t.chunks, "row_id")
    recount = multiset_difference(kept, _known_sites(t).filter(_part() % 9 != 0), ["row_id", "contig", "pos", "ref"])
    counts = [
        kept.agg(F.count(F.lit(1)).alias("kept")), removed.agg(F.coalesce(F.sum("removed"), F.lit(0)).alias("removed")),
        wrong.agg(F.count(F.lit(1)).alias("wrong_ref")), recount.agg(F.count(F.lit(1)).cast("int").alias("recount_differences")),
    ]
    return counts[0].crossJoin(counts[1]).crossJoin(counts[2]).crossJoin(counts[3])


@query("p04_region_restriction", """SELECT contig, count(*) AS n, min(pos) AS low, max(pos) AS high FROM vraw WHERE contig IN ('chr20', 'chr21', 'chr22', 'chr2') GROUP BY 1""")
def region_restriction(t):
    chosen = t.variants.filter(F.col("contig").isin("chr20", "chr21", "chr22", "chr2"))
    return chosen.groupBy("contig").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"))


@query("p15_probability_rows", """
SELECT event_id FROM events WHERE event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0
""")
def probability_rows(t):
    key = F.col("event_id")
    a, b = (key % 100) / 200.0, (key % 50) / 200.0
    rows = t.read("events").select(
        "event_id",
        F.when(key % 19 == 0, F.array(a, b))
        .when(key % 23 == 0, F.array(a + 1.5, b, -a - b - 0.5))
        .when(key % 29 == 0, F.array(a, b, F.lit(None).cast("double")))
        .otherwise(F.array(a, b, 1 - a - b + F.when(key % 17 == 0, 0.1).otherwise(0.0))).alias("probabilities"),
    )
    return variants.invalid_probabilities(rows).select("event_id")


@query("p16_candidate_validity", """
SELECT row_id, CASE WHEN l_partkey % 101 = 0 THEN 'span' WHEN l_partkey % 103 = 0 THEN 'no_alt' ELSE 'alt_repeated' END AS "rule"
FROM vraw WHERE l_partkey % 101 = 0 OR l_partkey % 103 = 0 OR l_partkey % 107 = 0
""")
def candidate_validity(t):
    alt = F.get("alts", F.lit(0))
    rows = t.variants.select(
        "row_id", (F.col("pos") - 1).alias("start"),
        (F.col("pos") - 1 + F.length("ref") + (_part() % 101 == 0).cast("int")).alias("end"), "ref",
        F.when(_part() % 103 == 0, F.array().cast("array<string>")).when(_part() % 107 == 0, F.array(alt, alt)).otherwise(F.col("alts")).alias("alts"),
    )
    return rows.select("row_id", first_broken(variants.candidate_rules()).alias("rule")).filter("rule is not null")


@query("j16_candidate_lineage", "SELECT contig, pos, ref, alt, alt_copies FROM vq WHERE NOT EXISTS (SELECT 1 FROM vt WHERE vt.contig = vq.contig AND vt.pos = vq.pos AND vt.ref = vq.ref AND vt.alt = vq.alt)")
def candidate_lineage(t):
    inferred = _included(t, F.col("is_query")).select(*matching.KEY).distinct()
    generated = _included(t, F.col("is_truth"))
    return variants.missing_candidates(inferred, generated, ["contig", "pos", "ref", "alt"]).select(*matching.KEY)


@query("sc05_genotype_parse", """
SELECT row_id, len(string_split_regex(gt, '[/|]')) AS ploidy, len(list_filter(string_split_regex(gt, '[/|]'), lambda a: a = '1')) AS copies,
       list_contains(string_split_regex(gt, '[/|]'), '.') AS missing FROM vraw
""")
def genotype_parse(t):
    gt = F.col("gt")
    return t.variants.select(
        "row_id", genotype.ploidy(gt).cast("bigint").alias("ploidy"), genotype.alt_copies(gt).cast("bigint").alias("copies"),
        F.exists(genotype.alleles(gt), lambda a: a.isNull()).alias("missing"),
    )


@query("sc06_variant_class", """
SELECT CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) <> length(alt) THEN 'INDEL' ELSE 'OTHER' END AS variant_class, count(*) AS n FROM vsplit GROUP BY 1
""")
def variant_class(t):
    split = variants.split_alleles(t.variants)
    return split.groupBy(genotype.variant_class(F.col("ref"), F.col("alt")).alias("variant_class")).agg(F.count(F.lit(1)).alias("n"))


@query("sc07_split_alleles", "SELECT row_id, contig, pos, ref, alt, gt, original FROM vsplit")
def split_alleles(t):
    return variants.split_alleles(t.variants).select("row_id", "contig", "pos", "ref", "alt", "gt", "original")


@query("sc25_allele_arrays", """
SELECT row_id, len(list_distinct(alts)) AS distinct_alts, NOT regexp_matches(gt, '2') OR len(alts) = 2 AS indexes_ok FROM vraw
""")
def allele_arrays(t):
    return t.variants.select(
        "row_id", F.size(F.array_distinct("alts")).cast("bigint").alias("distinct_alts"),
        genotype.index_in_range(F.col("gt"), F.size("alts")).alias("indexes_ok"),
    )


view("vgood", """
SELECT s.row_id, s.contig, s.pos, s.ref, s.alt, s.gt, s.is_query, s.is_truth FROM vsplit s
WHERE NOT EXISTS (SELECT 1 FROM refbad b WHERE b.row_id = s.row_id)
""")
view("vindel", """
SELECT g.*, core, st, substr(s, CAST(greatest(st - 63, 1) AS INTEGER), CAST(least(st, 64) AS INTEGER)) AS u FROM (
  SELECT *, CASE WHEN length(alt) > length(ref) THEN substr(alt, 2, 1) ELSE substr(ref, 2, 1) END AS core,
         CASE WHEN length(alt) > length(ref) OR substr(ref, 1, 1) = substr(ref, 2, 1) THEN pos - 1 ELSE pos END AS st
  FROM vgood WHERE length(ref) <> length(alt)) g JOIN refcontig USING (contig)
""")
view("vshift", """
SELECT *, least(length(u) - length(rtrim(u, core)), greatest(length(u) - 1, 0)) AS k FROM vindel
""")
view("valigned", """
SELECT row_id, contig, pos, ref, alt, gt, is_query, is_truth FROM vgood WHERE length(ref) = length(alt)
UNION ALL
SELECT row_id, contig, CASE WHEN st = 0 THEN 1 ELSE st - k END AS pos,
       CASE WHEN length(ref) > length(alt) THEN CASE WHEN st = 0 THEN core || substr(ref, 2, 1) ELSE anchor || core END ELSE CASE WHEN st = 0 THEN ref ELSE anchor END END AS ref,
       CASE WHEN length(ref) > length(alt) THEN CASE WHEN st = 0 THEN substr(ref, 2, 1) ELSE anchor END ELSE CASE WHEN st = 0 THEN alt ELSE anchor || core END END AS alt,
       gt, is_query, is_truth
FROM (SELECT *, substr(u, CAST(length(u) - k AS INTEGER), 1) AS anchor FROM vshift)
""")
view("vnormal", """
SELECT row_id, contig, pos, ref, alt, is_query, is_truth, len(list_filter(string_split_regex(gt, '[/|]'), lambda a: a = '1')) AS alt_copies FROM valigned
WHERE NOT list_contains(string_split_regex(gt, '[/|]'), '.') AND len(string_split_regex(gt, '[/|]')) = 2
  AND len(list_filter(string_split_regex(gt, '[/|]'), lambda a: a <> '0')) > 0
""")


@query("sc08_left_alignment", "SELECT row_id, contig, pos, ref, alt FROM valigned WHERE length(ref) <> length(alt)")
def left_alignment(t):
    """Only records with an indel among their ALTs meet the reference, once."""
    indel = F.exists("alts", lambda a: F.length(a) != F.length("ref"))
    records = settled(t.variants, "_indel", indel).filter("_indel").drop("_indel")
    checked = variants.check_reference(records, t.chunks, "row_id", lookback=variants.LOOKBACK, max_span=SPAN).filter("ref_ok").drop("ref_ok")
    indels = variants.split_alleles(checked).filter(F.length("ref") != F.length("alt")).withColumn("_piece", F.concat_ws(":", "row_id", "alt"))
    return variants.align_checked(indels, t.chunks, "_piece").select("row_id", "contig", "pos", "ref", "alt")


@query("c03_normalize_calls", "SELECT row_id, contig, pos, ref, alt, alt_copies FROM vnormal")
def normalize_calls(t):
    records = t.variants.select("row_id", "contig", "pos", "ref", "alts", "gt")
    calls = benchmark.normalize(records, t.chunks, max_span=SPAN, near=t.near_chunks(SPAN), columns=["row_id", *matching.KEY])
    return calls.withColumn("alt_copies", F.col("alt_copies").cast("bigint"))


@query("c03_rejected_calls", f"""
SELECT row_id, {BROKEN} AS "rule" FROM vraw WHERE {BROKEN} IS NOT NULL UNION ALL SELECT row_id, 'reference' FROM refbad WHERE {BROKEN} IS NULL
""")
def rejected_calls(t):
    return benchmark.rejected(_damaged(t), t.chunks)


@query("o03_variant_order", "SELECT contig_idx, pos, ref, alt, row_id FROM vsplit JOIN contigs USING (contig)")
def variant_order(t):
    rows = variants.split_alleles(t.variants).join(t.contigs.select("contig", "contig_idx"), "contig")
    return rows.select("contig_idx", "pos", "ref", "alt", "row_id").orderBy("contig_idx", "pos", "ref", "alt", "row_id")


@query("j04_variants_in_regions", "SELECT contig, pos, ref, alt, CAST(alt_copies AS INTEGER) AS alt_copies FROM vqr")
def variants_in_regions(t):
    return matching.restrict(_included(t, F.col("is_query")).select(*matching.KEY).distinct(), t.left, t.right)


def _partitions(t):
    calls = variants.included(variants.split_alleles(t.variants))
    return matching.match_sides(matching.flagged(calls, F.col("is_query"), F.col("is_truth")), t.left, t.right)


@query("j13_genotype_match", "SELECT contig, pos, ref, alt, CAST(alt_copies AS INTEGER) AS alt_copies, part AS \"partition\" FROM parts")
def genotype_match(t):
    return _partitions(t)


@query("a09_class_counts", "SELECT * FROM classes")
def class_counts(t):
    return matching.with_all_classes(matching.class_counts(_partitions(t)))


METRICS = """
SELECT variant_class, tp_query, tp_truth, fp, fn, p AS "precision", r AS recall,
       CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) WHEN p + r = 0 THEN 0 END AS f1,
       '{' || array_to_string(list_filter([CASE WHEN p IS NULL THEN '"precision":"zero_query_denominator"' END,
         CASE WHEN r IS NULL THEN '"recall":"zero_truth_denominator"' END,
         CASE WHEN p IS NULL OR r IS NULL THEN '"f1":"undefined_precision_or_recall"' END], lambda x: x IS NOT NULL), ',') || '}' AS missing_reasons
FROM (SELECT *, CASE WHEN tp_query + fp > 0 THEN CAST(tp_query AS DOUBLE) / (tp_query + fp) END AS p,
             CASE WHEN tp_truth + fn > 0 THEN CAST(tp_truth AS DOUBLE) / (tp_truth + fn) END AS r FROM {source})
"""


@query("a10_benchmark_metrics", METRICS.replace("{source}", "classes"))
def benchmark_metrics(t):
    counts = matching.with_all_classes(matching.class_counts(_partitions(t)))
    return matching.metrics(counts).withColumn("missing_reasons", F.to_json("missing_reasons"))


view("labelled", """
SELECT coalesce(lang, '?') AS variant_class, count(*) FILTER (quality = 1 AND toxic = 0) AS tp_query, count(*) FILTER (quality = 1 AND toxic = 0) AS tp_truth,
       count(*) FILTER (quality = 0 AND toxic = 0) AS fp, count(*) FILTER (quality = 1 AND toxic = 1) AS fn
FROM labels JOIN documents USING (doc_id) GROUP BY 1
""")


@query("a10_label_metrics", METRICS.replace("{source}", "labelled"))
def label_metrics(t):
    """The same metrics on labelled documents: truth is quality, the call is not-toxic."""
    rows = t.read("labels").join(t.read("documents").select("doc_id", "lang"), "doc_id")
    true, called = F.col("quality") == 1, F.col("toxic") == 0
    counts = rows.groupBy(F.coalesce("lang", F.lit("?")).alias("variant_class")).agg(
        F.count_if(true & called).alias("tp_query"), F.count_if(true & called).alias("tp_truth"),
        F.count_if(~true & called).alias("fp"), F.count_if(true & ~called).alias("fn"),
    )
    return matching.metrics(counts).withColumn("missing_reasons", F.to_json("missing_reasons"))


def _strata():
    return [
        ("indel", F.length("ref") != F.length("alt")),
        ("chr1", F.col("contig") == "chr1"),
        ("homozygous", F.col("alt_copies") == 2),
    ]


@query("a29_exclusive_strata", """
SELECT CASE WHEN length(ref) <> length(alt) THEN 'indel' WHEN contig = 'chr1' THEN 'chr1' WHEN alt_copies = 2 THEN 'homozygous' ELSE 'unassigned' END AS stratum,
       count(*) FILTER (part = 'fp') AS fp, count(*) FILTER (part = 'fn') AS fn FROM parts WHERE part IN ('fp', 'fn') GROUP BY 1
""")
def exclusive_strata(t):
    errors = _partitions(t).filter(F.col("partition").isin("fp", "fn"))
    return matching.error_strata(errors, _strata(), exclusive=True)


@query("a29_multi_label_strata", """
SELECT stratum, count(*) FILTER (part = 'fp') AS fp, count(*) FILTER (part = 'fn') AS fn FROM (
  SELECT part, unnest(list_filter([CASE WHEN length(ref) <> length(alt) THEN 'indel' END, CASE WHEN contig = 'chr1' THEN 'chr1' END,
         CASE WHEN alt_copies = 2 THEN 'homozygous' END], lambda x: x IS NOT NULL)) AS stratum FROM parts WHERE part IN ('fp', 'fn')) GROUP BY 1
""")
def multi_label_strata(t):
    errors = _partitions(t).filter(F.col("partition").isin("fp", "fn"))
    return matching.error_strata(errors, _strata(), exclusive=False)


@query("w04_clusters", """
SELECT contig, pos, max(CASE WHEN reach IS NULL OR pos > reach + 3 THEN pos END) OVER (PARTITION BY contig ORDER BY pos) AS "cluster" FROM (
  SELECT contig, pos, max(e) OVER (PARTITION BY contig ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM (SELECT contig, pos, max(pos + length(ref) - 1) AS e FROM vraw GROUP BY 1, 2))
""")
def clusters(t):
    return variants.clusters(t.variants, 3).select("contig", "pos", "cluster").distinct()


view("vsites", "SELECT DISTINCT contig, pos, contig || ':' || pos AS site_id FROM vraw")


def _sites(t):
    return t.variants.select("contig", "pos").distinct().withColumn("site_id", F.concat_ws(":", "contig", "pos"))


@query("j05_locus_overlap", """
SELECT s.site_id, v.row_id FROM vsites s JOIN (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN pos + 20 ELSE pos + length(ref) - 1 END AS e, pos // 32 AS b FROM vraw) v
ON v.contig = s.contig AND v.b IN (s.pos // 32, s.pos // 32 - 1) AND v.pos <= s.pos AND s.pos <= v.e
""")
def locus_overlap(t):
    ended = t.variants.withColumn("end", F.when(_part() % 3 == 0, F.col("pos") + 20).otherwise(F.col("pos") + F.length("ref") - 1))
    return variants.overlapping_records(ended, _sites(t), "row_id")


@query("o05_bounded_diagnostics", """
SELECT * FROM (SELECT s.site_id, v.row_id, row_number() OVER (PARTITION BY s.site_id ORDER BY v.row_id) AS rank, count(*) OVER (PARTITION BY s.site_id) AS overlapping,
       count(*) OVER (PARTITION BY s.site_id) > 4 AS truncated
  FROM vsites s JOIN (SELECT *, pos + 20 AS e, pos // 32 AS b FROM vraw) v
  ON v.contig = s.contig AND v.b IN (s.pos // 32, s.pos // 32 - 1) AND v.pos <= s.pos AND s.pos <= v.e) WHERE rank <= 4
""")
def bounded_diagnostics(t):
    ended = t.variants.withColumn("end", F.col("pos") + 20)
    return variants.bounded_diagnostics(ended, _sites(t), "row_id", rows=4)


@query("j15_site_oracle", """
SELECT s.site_id, count(v.row_id) AS matches FROM (SELECT site_id, contig, pos, list_sort([ref, alt]) AS wanted FROM (
    SELECT contig || ':' || pos AS site_id, contig, pos, min(ref) AS ref, min(alts[1]) AS alt FROM vraw GROUP BY ALL)) s
LEFT JOIN (SELECT *, [ref] || alts AS pool FROM vraw WHERE "filter" IN ('PASS', '.') AND NOT list_contains(string_split_regex(gt, '[/|]'), '.')) v
ON v.contig = s.contig AND v.pos = s.pos AND list_sort(list_transform(string_split_regex(gt, '[/|]'), lambda a: pool[CAST(a AS INTEGER) + 1])) = s.wanted
GROUP BY 1
""")
def site_oracle(t):
    sites = t.variants.groupBy("contig", "pos").agg(F.min("ref").alias("r"), F.min(F.get("alts", F.lit(0))).alias("a")).select(
        F.concat_ws(":", "contig", "pos").alias("site_id"), "contig", "pos", F.array_sort(F.array("r", "a")).alias("wanted")
    )
    return variants.site_oracle(t.variants, sites)


@query("sc22_bounded_values", """
SELECT row_id, CASE WHEN length(alts[1]) = 1 THEN alts[1] END AS allele, CASE WHEN length(alts[1]) <> 1 THEN sha256(alts[1]) END AS allele_digest,
       CASE WHEN l_partkey % 5 <> 0 AND l_partkey % 7 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS depth
FROM vraw
""")
def bounded_values(t):
    allele = bounded(F.get("alts", F.lit(0)), "^([ACGTN]|[.]|[*]|<NON_REF>|<[*]>)$")
    depth = F.when(_part() % 5 == 0, ".").when(_part() % 7 == 0, "12345678901234567").otherwise(_part().cast("string"))
    return t.variants.select(
        "row_id", allele["value"].alias("allele"), allele["sha256"].alias("allele_digest"), bounded_number(depth)["value"].alias("depth")
    )


@query("so07_multiset_equality", """
SELECT row_id, contig, pos, 1 AS left_count, 0 AS right_count FROM vraw WHERE l_partkey % 211 = 0
UNION ALL SELECT row_id, contig, pos, 1, 2 FROM vraw WHERE l_partkey % 223 = 0 AND l_partkey % 211 <> 0
""")
def multiset_equality(t):
    """A stream re-read in another order, with lost and repeated records."""
    columns = ["row_id", "contig", "pos"]
    copies = F.when(_part() % 211 == 0, 0).when(_part() % 223 == 0, 2).otherwise(1)
    again = t.variants.withColumn("_i", F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1))))).filter(copies > 0)
    return multiset_difference(t.variants, again.select(*columns), columns)


view("hapsrc", """
SELECT o_orderkey AS k, 'chr' || (o_custkey % 22 + 1) AS contig, o_orderkey * 8 + 3 AS pos, 1 + o_custkey % 2 AS alt_copies,
       substr(translate(substr(sha256('chr' || (o_custkey % 22 + 1) || ':' || o_orderkey), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT'), 3, 2) AS ref FROM orders
""")


@query("j14_haplotype_rescue", """
SELECT 'q' || k AS row_id, k % 5 <> 0 AS rescued FROM hapsrc UNION ALL SELECT 's' || k, k % 5 <> 0 FROM hapsrc UNION ALL SELECT 't' || k, true FROM hapsrc WHERE k % 5 <> 0
""")
def haplotype_rescue(t):
    """A two-base substitution in the calls against two single-base ones in truth."""
    key = F.col("o_orderkey")
    base = t.read("orders").select(
        "o_orderkey", F.concat(F.lit("chr"), F.col("o_custkey") % 22 + 1).alias("contig"),
        (key * 8 + 3).alias("pos"), (1 + F.col("o_custkey") % 2).cast("int").alias("alt_copies"),
    ).withColumn("ref", F.substring(reference_line("contig", "o_orderkey"), 3, 2))

    def record(prefix, truth, offset, length):
        ref = F.substring("ref", offset + 1, length)
        return F.struct(
            F.concat(F.lit(prefix), key).alias("row_id"), F.lit(truth).alias("truth"), (F.col("pos") + offset).alias("pos"),
            ref.alias("ref"), F.translate(ref, "ACGT", "CGTA").alias("alt"),
        )

    both = F.array(record("q", False, 0, 2), record("s", True, 0, 1), record("t", True, 1, 1))
    kept = F.when(key % 5 == 0, F.slice(both, 1, 2)).otherwise(both)
    rows = base.select("contig", "alt_copies", F.explode(kept).alias("r")).select("contig", "alt_copies", "r.*")
    return haplotypes.rescue(rows, t.chunks, gap=4).select("row_id", "rescued")


view("nparts", """
SELECT contig, pos, ref, alt, alt_copies, unnest(CASE WHEN q AND t THEN ['tp', 'tp_baseline'] WHEN q THEN ['fp'] ELSE ['fn'] END) AS part FROM (
  SELECT contig, pos, ref, alt, alt_copies, bool_or(is_query) AS q, bool_or(is_truth) AS t FROM vnormal v
  WHERE EXISTS (SELECT 1 FROM region WHERE rc = contig AND rs <= pos - 1 AND pos - 1 < re) GROUP BY 1, 2, 3, 4, 5)
""")
view("nclasses", """
SELECT variant_class, coalesce(tp_query, 0) AS tp_query, coalesce(tp_truth, 0) AS tp_truth, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn
FROM (VALUES ('SNP'), ('INDEL'), ('OTHER')) c(variant_class) LEFT JOIN (
  SELECT CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) <> length(alt) THEN 'INDEL' ELSE 'OTHER' END AS variant_class,
         count(*) FILTER (part = 'tp') AS tp_query, count(*) FILTER (part = 'tp_baseline') AS tp_truth,
         count(*) FILTER (part = 'fp') AS fp, count(*) FILTER (part = 'fn') AS fn FROM nparts GROUP BY 1) USING (variant_class)
""")


def _calls(t, *carried):
    # what the benchmark does not read would be dealt with the records and written with the aligned rows
    carried = ["is_query", "is_truth", *carried]
    records = t.variants.filter("is_query or is_truth").select("row_id", "contig", "pos", "ref", "alts", "gt", *carried)
    return benchmark.normalize(records, t.chunks, max_span=SPAN, near=t.near_chunks(SPAN), columns=[*matching.KEY, *carried])


@query("c04_benchmark", f"""
SELECT *, (SELECT CAST(coalesce(sum(re - rs), 0) AS BIGINT) FROM region) AS evaluated_bases FROM ({METRICS.replace("{source}", "nclasses")})
""")
def benchmark_calls(t):
    """Normalised calls against truth inside domain and confidence, matched on alleles and genotype."""
    both = matching.flagged(_calls(t), F.col("is_query"), F.col("is_truth"))
    scored = benchmark.evaluate(both, t.left, t.right)
    return scored.withColumn("missing_reasons", F.to_json("missing_reasons"))


# two callers: rows that both, one or none of them called
CALLERS = {"caller_a": "is_query AND l_partkey % 3 <> 0", "caller_b": "is_query AND l_partkey % 4 <> 1", "caller_c": "is_query AND l_partkey < 0"}
view("caller_parts", f"""
SELECT caller, contig, pos, ref, alt, alt_copies, unnest(CASE WHEN q AND t THEN ['tp', 'tp_baseline'] WHEN q THEN ['fp'] ELSE ['fn'] END) AS part FROM (
  SELECT caller, contig, pos, ref, alt, alt_copies, bool_or(CASE caller {' '.join(f"WHEN '{c}' THEN {sql}" for c, sql in CALLERS.items())} END) AS q, bool_or(is_truth) AS t
  FROM (SELECT *, CAST(split_part(row_id, '.', 3) AS BIGINT) AS l_partkey FROM vnormal v WHERE EXISTS (SELECT 1 FROM region WHERE rc = contig AND rs <= pos - 1 AND pos - 1 < re)), (SELECT unnest({list(CALLERS)}) AS caller)
  GROUP BY ALL) WHERE q OR t
""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4, 5, 6"))
view("caller_classes", f"""
SELECT caller, variant_class, coalesce(tp_query, 0) AS tp_query, coalesce(tp_truth, 0) AS tp_truth, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn
FROM (SELECT * FROM (VALUES ('SNP'), ('INDEL'), ('OTHER')) c(variant_class), (SELECT unnest({list(CALLERS)}) AS caller)) LEFT JOIN (
  SELECT caller, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) <> length(alt) THEN 'INDEL' ELSE 'OTHER' END AS variant_class,
         count(*) FILTER (part = 'tp') AS tp_query, count(*) FILTER (part = 'tp_baseline') AS tp_truth,
         count(*) FILTER (part = 'fp') AS fp, count(*) FILTER (part = 'fn') AS fn FROM caller_parts GROUP BY 1, 2) USING (caller, variant_class)
""")


def _by_caller(t, chunks=None):
    own = F.array_compact(F.array(*[F.when(F.expr(f"({sql}) or is_truth"), F.struct(F.lit(c).alias("caller"), F.expr(sql).alias("q"))) for c, sql in CALLERS.items()]))
    calls = _calls(t, "l_partkey").withColumn("_c", F.explode(own)).withColumn("caller", F.col("_c.caller"))
    both = matching.flagged(calls, F.col("_c.q"), F.col("is_truth"), ["caller"])
    scored = benchmark.evaluate(both, t.left, t.right, chunks, callers=list(CALLERS))
    return scored.withColumn("missing_reasons", F.to_json("missing_reasons"))


@query("c04_benchmark_of_callers", f"""
SELECT *, (SELECT CAST(coalesce(sum(re - rs), 0) AS BIGINT) FROM region) AS evaluated_bases FROM ({METRICS.replace("{source}", "caller_classes").replace("SELECT variant_class", "SELECT caller, variant_class", 1)})
""")
def benchmark_of_callers(t):
    """Several callers against one truth in one job; one of them called nothing."""
    return _by_caller(t)


@query("c04_benchmark_with_rescue")
def benchmark_with_rescue(t):
    """The same with haplotype rescue of what the exact match left over, dense chains included."""
    return _by_caller(t, t.chunks)
