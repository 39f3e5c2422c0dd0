"""Read, depth and recalibration queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar
from ..functions.quality import phred, stored_order
from ..functions.sequence import distinct_kmers, gc_fraction, has_homopolymer, reverse_complement
from ..operators import intervals as iv
from ..operators import probes, recalibration
from ..operators import reads as rd
from ..operators.rules import multiset_difference
from ..plans import coverage
from ..sources import sam
from ..sources.fasta import masked_chunks
from .registry import query, view


@query("p05_flag_predicates", """
SELECT flag & 4 <> 0 AS unmapped, flag & 16 <> 0 AS reverse, flag & 64 <> 0 AS first_mate, flag & 2304 = 0 AS is_primary, flag & 1024 <> 0 AS duplicate, count(*) AS n
FROM aln GROUP BY ALL
""")
def flag_predicates(t):
    return t.alignments.groupBy(
        rd.has(rd.UNMAPPED).alias("unmapped"), rd.has(rd.REVERSE).alias("reverse"), rd.has(rd.FIRST).alias("first_mate"),
        rd.primary().alias("is_primary"), rd.has(rd.DUPLICATE).alias("duplicate"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("a18_read_counts", """
SELECT read_group, count(*) AS records, count(*) FILTER (flag & 2304 = 0) AS primary_reads, count(*) FILTER (flag & 2308 = 0) AS mapped_reads,
       count(*) FILTER (flag & 2304 = 0 AND flag & 4 <> 0) AS unmapped_reads, count(*) FILTER (flag & 2304 = 0 AND flag & 1024 <> 0) AS duplicate_reads,
       count(*) FILTER (flag & 256 <> 0) AS secondary, count(*) FILTER (flag & 2048 <> 0) AS supplementary FROM aln GROUP BY read_group
""")
def read_counts(t):
    return rd.flag_counts(t.alignments, ["read_group"])


view("percontig", """
SELECT c.contig, count(a.rid) AS reads FROM (SELECT contig FROM contigs UNION ALL SELECT '*') c
LEFT JOIN (SELECT rid, CASE WHEN flag & 4 <> 0 THEN '*' ELSE contig END AS contig FROM aln WHERE flag & 2304 = 0) a ON a.contig = c.contig GROUP BY 1
""")


@query("a19_mapped_per_contig", "SELECT * FROM percontig")
def mapped_per_contig(t):
    return rd.mapped_per_contig(t.alignments, t.contigs)


@query("j25_count_crosscheck", """
SELECT contig, reads, reads + 1 AS reported FROM percontig WHERE contig IN ('chr2', 'chr5')
""")
def count_crosscheck(t):
    own = rd.mapped_per_contig(t.alignments, t.contigs)
    reported = own.select("contig", (F.col("reads") + F.col("contig").isin("chr2", "chr5").cast("int")).alias("mapped"))
    return rd.read_count_crosscheck(t.alignments, reported, t.contigs)


@query("so04_lane_union", "SELECT read_group, count(*) AS n FROM aln GROUP BY 1")
def lane_union(t):
    lanes = [t.alignments.filter(F.col("library") == x) for x in ("A", "N", "R")]
    merged = lanes[0].unionByName(lanes[1]).unionByName(lanes[2])
    return merged.groupBy("read_group").agg(F.count(F.lit(1)).alias("n"))


@query("sc01_reverse_complement", "SELECT rid, reverse(translate(seq, 'ACGTNacgtn', 'TGCANtgcan')) AS rc FROM aln")
def reverse_complements(t):
    return t.alignments.select("rid", reverse_complement(F.col("seq")).alias("rc"))


@query("sc02_phred_decode", """
SELECT rid, CAST(list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) AS BIGINT) AS total,
       CAST(list_min(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) AS BIGINT) AS low FROM aln
""")
def phred_decode(t):
    q = phred(F.col("qual"))
    return t.alignments.select(
        "rid", F.aggregate(q, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.array_min(q).cast("bigint").alias("low")
    )


@query("sc03_original_quality", "SELECT rid, CASE WHEN flag & 16 <> 0 THEN reverse(qual) ELSE qual END AS oq FROM aln")
def original_quality(t):
    return t.alignments.select("rid", stored_order(F.col("qual"), F.col("flag")).alias("oq"))


@query("sc04_cigar_blocks", """
SELECT rid, CAST(sum(be - bs) AS BIGINT) AS aligned, count(*) AS blocks, max(be) - min("start") AS span, max(q) AS query_bases FROM blk GROUP BY rid
""")
def cigar_blocks(t):
    blocks = cigar.aligned_blocks(F.col("cigar"), F.col("start"))
    return t.alignments.select(
        "rid", F.aggregate(blocks, F.lit(0).cast("bigint"), lambda a, b: a + b["end"] - b["start"]).alias("aligned"),
        F.size(blocks).cast("bigint").alias("blocks"), cigar.reference_length(F.col("cigar")).cast("bigint").alias("span"),
        cigar.query_length(F.col("cigar")).alias("query_bases"),
    )


@query("sc10_gc_fraction", "SELECT rid, CAST(length(regexp_replace(seq, '[^GC]', '', 'g')) AS DOUBLE) / length(seq) AS gc FROM aln")
def gc(t):
    return t.alignments.select("rid", gc_fraction(F.col("seq")).alias("gc"))


@query("sc11_homopolymer", "SELECT rid, regexp_matches(seq, 'A{4}|C{4}|G{4}|T{4}') AS hit FROM aln")
def homopolymer(t):
    return t.alignments.select("rid", has_homopolymer(F.col("seq"), 4).alias("hit"))


@query("sc12_distinct_kmers", """
SELECT rid, CASE WHEN q >= 5 THEN len(list_distinct(list_transform(range(1, q - 3), lambda i: substr(seq, CAST(i AS INTEGER), 5)))) ELSE 0 END AS kmers FROM aln
""")
def kmer_counts(t):
    return t.alignments.select("rid", distinct_kmers(F.col("seq"), 5).cast("bigint").alias("kmers"))


view("refcontig", """SELECT contig, string_agg(bases, '' ORDER BY k) AS s, count(*) * 8 AS length FROM reflines GROUP BY contig""")


@query("w09_probe_windows", """
SELECT contig, context, min(p) + 1 AS pos, arg_min(w, p) AS sequence FROM (
  SELECT contig, p, w, unnest(list_filter(['ordinary', CASE WHEN length(regexp_replace(w, '[^GC]', '', 'g')) >= 0.55 * 151 THEN 'high_gc' END,
         CASE WHEN regexp_matches(w, 'A{6}|C{6}|G{6}|T{6}') THEN 'homopolymer' END], lambda x: x IS NOT NULL)) AS context
  FROM (SELECT contig, p, substr(s, CAST(p + 1 AS INTEGER), 151) AS w FROM
         (SELECT contig, s, unnest(range(length // 3, length - 151, 31)) AS p FROM refcontig) x)
  WHERE len(list_distinct(list_transform(range(1, 138), lambda i: substr(w, CAST(i AS INTEGER), 15)))) >= 110)
GROUP BY ALL
""")
def probe_windows(t):
    lengths = t.sequence.groupBy("contig").agg(F.sum(F.length("bases")).alias("length"))
    return probes.first_windows(t.chunks, lengths, min_gc=0.55)


view("domain_pos", """SELECT contig, unnest(range("start", "end")) AS p FROM ub""")


@query("a07_domain_depth", """
SELECT contig, depth, count(*) AS positions FROM (
  SELECT d.contig, d.p, coalesce(c.n, 0) AS depth FROM domain_pos d LEFT JOIN (
    SELECT contig, p, count(DISTINCT qname) AS n FROM basecell WHERE flag & 3844 = 0 AND mapq >= 20 GROUP BY 1, 2) c
  ON c.contig = d.contig AND c.p = d.p) GROUP BY ALL
""")
def domain_depth(t):
    spans = coverage.domain_depth(t.alignments, t.right, min_quality=0)
    return spans.groupBy("contig", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("positions"))


@query("p10_depth_filters", """
SELECT contig, CAST(count(*) AS BIGINT) AS bases FROM basecell WHERE flag & 3844 = 0 AND mapq >= 20 AND bq >= 20 GROUP BY contig
""")
def depth_filters(t):
    pieces = rd.counted_blocks(t.alignments)
    return pieces.groupBy("contig").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


view("c07depth", """
SELECT d.contig, d.p, coalesce(c.n, 0) AS depth FROM domain_pos d LEFT JOIN (
  SELECT contig, p, count(DISTINCT qname) AS n FROM basecell WHERE flag & 3844 = 0 AND mapq >= 20 AND bq >= 20 GROUP BY 1, 2) c
ON c.contig = d.contig AND c.p = d.p
""")
SUMMARY = """count(*) AS bases, count(*) FILTER (depth >= 1) AS bases_ge_1, count(*) FILTER (depth >= 10) AS bases_ge_10,
       count(*) FILTER (depth >= 20) AS bases_ge_20, count(*) FILTER (depth >= 30) AS bases_ge_30, CAST(sum(depth) AS BIGINT) AS depth_sum,
       CAST(sum(depth) AS DOUBLE) / count(*) AS mean_depth"""


@query("c07_domain_coverage", f"SELECT contig, {SUMMARY} FROM c07depth GROUP BY contig")
def domain_coverage(t):
    return coverage.domain_coverage(t.alignments, t.right, ["contig"])


@query("a04_depth_summary", f"SELECT {SUMMARY} FROM c07depth")
def depth_summary(t):
    return coverage.domain_coverage(t.alignments, t.right)


view("rawdepth", """
SELECT contig, p, count(*) AS n FROM basecell WHERE flag & 1796 = 0 GROUP BY 1, 2
""")


def _whole_depth(t):
    pieces = rd.blocks(t.alignments.filter(F.col("flag").bitwiseAND(rd.WINDOW_MASK) == 0))
    whole = t.contigs.select("contig", F.lit(0).cast("bigint").alias("start"), F.col("length").alias("end"))
    return rd.depth_over(pieces, whole)


@query("a06_window_depth", """
SELECT w.contig, w.window_id, w.bases, CAST(coalesce(d.s, 0) AS DOUBLE) / w.bases AS mean_depth, coalesce(d.g1, 0) AS bases_ge_1, coalesce(d.g5, 0) AS bases_ge_5,
       coalesce(d.g10, 0) AS bases_ge_10, coalesce(d.g20, 0) AS bases_ge_20, coalesce(d.g30, 0) AS bases_ge_30
FROM (SELECT contig, i AS window_id, least(length, (i + 1) * 500) - i * 500 AS bases FROM (SELECT contig, length, unnest(range((length + 499) // 500)) AS i FROM contigs)) w
LEFT JOIN (SELECT contig, p // 500 AS window_id, CAST(sum(n) AS BIGINT) AS s, count(*) FILTER (n >= 1) AS g1, count(*) FILTER (n >= 5) AS g5,
  count(*) FILTER (n >= 10) AS g10, count(*) FILTER (n >= 20) AS g20, count(*) FILTER (n >= 30) AS g30 FROM rawdepth GROUP BY 1, 2) d
USING (contig, window_id)
""")
def window_depth(t):
    return rd.window_depth(_whole_depth(t), 500)


@query("a08_contig_coverage", """
SELECT c.contig, c.length AS bases, coalesce(d.covered, 0) AS covered, CAST(coalesce(d.s, 0) AS DOUBLE) / c.length AS mean_depth, coalesce(r.n, 0) AS reads
FROM contigs c LEFT JOIN (SELECT contig, count(*) AS covered, CAST(sum(n) AS BIGINT) AS s FROM rawdepth GROUP BY 1) d USING (contig)
LEFT JOIN (SELECT contig, count(*) AS n FROM aln WHERE flag & 1796 = 0 GROUP BY 1) r USING (contig)
""")
def contig_coverage(t):
    summed = rd.depth_summary(_whole_depth(t), ["contig"], (1,))
    counted = t.alignments.filter(F.col("flag").bitwiseAND(rd.WINDOW_MASK) == 0).groupBy("contig").agg(F.count(F.lit(1)).alias("reads"))
    return summed.join(counted, "contig", "left").select(
        "contig", "bases", F.col("bases_ge_1").alias("covered"), "mean_depth", F.coalesce("reads", F.lit(0)).alias("reads")
    )


@query("j07_depth_positions", """
SELECT contig, CASE WHEN (p + 1) % 101 = 0 THEN 'missing' ELSE 'repeated' END AS "rule", count(*) AS n FROM domain_pos
WHERE (p + 1) % 101 = 0 OR (p + 1) % 103 = 0 GROUP BY ALL
UNION ALL SELECT contig, 'extra', count(*) FROM domain_pos WHERE (p + 1) % 107 = 0 AND (p + 1) % 101 <> 0 GROUP BY ALL
""".replace("(p + 1) % 101 <> 0 GROUP", "true GROUP"))
def depth_positions(t):
    """Depth rows with lost, repeated and misplaced positions against the exact domain."""
    pos = F.col("pos")
    rows = rd.depth_rows(rd.depth_over(rd.blocks(t.alignments), t.right)).filter(pos % 101 != 0)
    again = rows.filter(pos % 103 == 0)
    # Far beyond any contig, so these can only be extra.
    stray = rd.depth_rows(rd.depth_over(rd.blocks(t.alignments), t.right)).filter(pos % 107 == 0).withColumn("pos", pos + 1_000_000_000_000)
    found = rd.depth_position_violations(rows.unionByName(again).unionByName(stray), iv.union(t.right))
    return found.groupBy("contig", "rule").agg(F.count(F.lit(1)).alias("n"))


view("sites", """
SELECT o_orderkey AS site_id, CASE WHEN o_orderkey % 2 = 0 THEN 'chr1' ELSE 'chr' || (o_custkey % 22 + 1) END AS contig, o_orderkey * 8 + 3 AS pos FROM orders
""")


def _sites(t):
    key = F.col("o_orderkey")
    return t.read("orders").select(
        key.alias("site_id"),
        F.when(key % 2 == 0, "chr1").otherwise(F.concat(F.lit("chr"), F.col("o_custkey") % 22 + 1)).alias("contig"),
        (key * 8 + 3).alias("pos"),
    )


@query("j06_bases_at_sites", """
SELECT site_id, rid, base FROM sites s JOIN basecell b ON b.contig = s.contig AND b.p = s.pos WHERE flag & 4 = 0
""")
def bases_at_sites(t):
    return rd.bases_at(t.alignments, _sites(t)).select("site_id", "rid", "base")


@query("a22_allele_support", """
SELECT site_id, base, count(*) AS fragments FROM (
  SELECT site_id, qname, CASE WHEN min(base) = max(base) THEN min(base) ELSE 'conflict' END AS base
  FROM sites s JOIN basecell b ON b.contig = s.contig AND b.p = s.pos WHERE flag & 4 = 0 GROUP BY 1, 2) GROUP BY ALL
""")
def allele_support(t):
    return rd.allele_support(rd.bases_at(t.alignments, _sites(t)))


view("marked", """
SELECT rid, flag & 2308 = 0 AND rk > 1 AS duplicate FROM (
  SELECT rid, flag, row_number() OVER (PARTITION BY library, contig, five, flag & 16, flag & 2308 = 0 ORDER BY score DESC, rid) AS rk FROM (
    SELECT *, CASE WHEN flag & 16 <> 0 THEN "start" + CASE shape WHEN 1 THEN q - 3 WHEN 2 THEN q + 2 WHEN 3 THEN q - 1 ELSE q END
                   ELSE "start" - CASE shape WHEN 1 THEN 3 ELSE 0 END END AS five,
           list_sum(list_transform(string_split(qual, ''), lambda c: CASE WHEN ascii(c) - 33 >= 15 THEN ascii(c) - 33 ELSE 0 END)) AS score FROM aln))
""")


@query("w07_mark_duplicates", "SELECT rid, duplicate FROM marked")
def mark_duplicates(t):
    single = t.alignments.withColumn("qname", F.col("rid"))
    return rd.mark_duplicates(single).select("rid", "duplicate")


@query("j09_read_expectations", """
SELECT rid AS qname, CAST(CASE WHEN flag & 64 <> 0 THEN 1 ELSE 2 END AS INTEGER) AS mate, CASE WHEN l_partkey % 101 = 0 THEN 'missing' WHEN l_partkey % 103 = 0 THEN 'unexpected' WHEN l_partkey % 67 = 0 THEN 'read_group'
  WHEN l_partkey % 71 = 0 THEN 'mapping' WHEN l_partkey % 73 = 0 THEN 'strand' WHEN l_partkey % 79 = 0 AND flag & 4 = 0 THEN 'coordinate' WHEN l_partkey % 83 = 0 THEN 'sequence'
  WHEN l_partkey % 89 = 0 THEN 'original_quality' END AS "rule"
FROM aln WHERE flag & 2304 = 0 AND NOT (l_partkey % 101 = 0 AND l_partkey % 103 = 0) AND (l_partkey % 101 = 0 OR l_partkey % 103 = 0 OR l_partkey % 67 = 0
  OR l_partkey % 71 = 0 OR l_partkey % 73 = 0 OR (l_partkey % 79 = 0 AND flag & 4 = 0) OR l_partkey % 83 = 0 OR l_partkey % 89 = 0)
""")
def read_expectations(t):
    part = F.col("l_partkey")
    reads = t.alignments.withColumns({"qname": F.col("rid"), "oq": stored_order(F.col("qual"), F.col("flag"))})
    mapped = ~rd.has(rd.UNMAPPED)
    forward = F.when(rd.has(rd.REVERSE), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    expected = reads.filter(rd.primary() & (part % 103 != 0)).select(
        "qname", rd.mate().alias("mate"),
        F.when(part % 67 == 0, "other").otherwise(F.col("read_group")).alias("read_group"),
        F.when(mapped == (part % 71 != 0), F.col("contig")).alias("contig"),
        (F.col("pos") + (part % 79 == 0).cast("int")).alias("pos"),
        (rd.has(rd.REVERSE) != (part % 73 == 0)).alias("reverse"),
        F.sha2(F.concat(forward, F.when(part % 83 == 0, "x").otherwise("")), 256).alias("sequence_sha256"),
        F.concat(F.col("qual"), F.when(part % 89 == 0, "!").otherwise("")).alias("original_qualities"),
    )
    return rd.compare_expected(reads.filter(part % 101 != 0), expected)


@query("j10_before_after", """
SELECT rid, flag, contig, pos, 1 AS left_count, 0 AS right_count FROM aln WHERE l_partkey % 107 = 0
UNION ALL SELECT rid, flag + 1, contig, pos, 0, 1 FROM aln WHERE l_partkey % 107 = 0
""")
def before_after(t):
    columns = ["rid", "flag", "contig", "pos"]
    after = t.alignments.withColumn("flag", F.col("flag") + (F.col("l_partkey") % 107 == 0).cast("int"))
    return multiset_difference(t.alignments, after, columns)


@query("j28_read_groups", """
SELECT 'rg' || s_suppkey AS read_group, CASE WHEN s_suppkey % 11 = 0 THEN 'unknown_read_group' WHEN s_suppkey % 13 = 0 THEN 'absent_read_group'
       WHEN s_suppkey % 5 = 0 THEN 'sample' ELSE 'library' END AS "rule" FROM supplier
WHERE NOT (s_suppkey % 11 = 0 AND s_suppkey % 13 = 0) AND (s_suppkey % 11 = 0 OR s_suppkey % 13 = 0 OR s_suppkey % 5 = 0 OR s_suppkey % 7 = 0)
""")
def read_groups(t):
    key = F.col("s_suppkey")
    base = t.read("supplier").select(
        F.concat(F.lit("rg"), key).alias("read_group"), F.col("s_name").alias("sample"), F.concat(F.lit("lib"), "s_nationkey").alias("library"), "s_suppkey"
    )
    headers = base.filter(key % 13 != 0).drop("s_suppkey")
    lanes = base.filter(key % 11 != 0).select(
        "read_group",
        F.when(key % 5 == 0, "other").otherwise(F.col("sample")).alias("sample"),
        F.when(key % 7 == 0, "other").otherwise(F.col("library")).alias("library"),
    )
    return rd.read_group_violations(headers, lanes)


@query("a28_cycle_profile", """
SELECT cycle, count(*) AS n, CAST(sum(bq) AS DOUBLE) / count(*) AS mean_quality, CAST(quantile_disc(bq, 0.5) AS INTEGER) AS median_quality,
       count(*) FILTER (b = 'A') AS n_a, count(*) FILTER (b = 'C') AS n_c, count(*) FILTER (b = 'G') AS n_g, count(*) FILTER (b = 'T') AS n_t,
       CAST(count(*) FILTER (b IN ('G', 'C')) AS DOUBLE) / count(*) AS gc
FROM (SELECT CAST(i + 1 AS INTEGER) AS cycle, ascii(substr(CASE WHEN flag & 16 <> 0 THEN reverse(qual) ELSE qual END, CAST(i + 1 AS INTEGER), 1)) - 33 AS bq,
        substr(CASE WHEN flag & 16 <> 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END, CAST(i + 1 AS INTEGER), 1) AS b
      FROM (SELECT *, unnest(range(q)) AS i FROM aln WHERE flag & 2304 = 0)) GROUP BY cycle
""")
def cycle_profile(t):
    return rd.cycle_profile(t.alignments)


view("samlines", """
SELECT o_orderkey + 1 AS line_no, o_orderkey // 100 AS src, o_custkey % 22 + 1 AS idx, o_custkey % 50 = 0 AS unmapped, o_custkey AS pos FROM orders
""")


def _sam_lines(t):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    unmapped = cust % 50 == 0
    return t.read("orders").select(
        F.concat(F.lit("bam"), F.floor(key / 100)).alias("source"), (key + 1).alias("line_no"),
        F.when(unmapped, "*").otherwise(F.concat(F.lit("chr"), cust % 22 + 1)).alias("contig"),
        F.when(unmapped, 0).otherwise(cust).alias("pos"), F.when(unmapped, 4).otherwise(0).alias("flag"),
    )


@query("w02_coordinate_order", """
SELECT 'bam' || src AS source, line_no FROM (
  SELECT src, line_no, k, p, lag(k) OVER w AS pk, lag(p) OVER w AS pp FROM (
    SELECT src, line_no, CASE WHEN unmapped THEN 23 ELSE idx END AS k, CASE WHEN unmapped THEN 0 ELSE pos END AS p FROM samlines) WINDOW w AS (PARTITION BY src ORDER BY line_no))
WHERE k < pk OR (k = pk AND p < pp)
""")
def coordinate_order(t):
    return sam.sort_violations(_sam_lines(t), t.contigs)


@query("w06_unmapped_last", """
SELECT 'bam' || src AS source, line_no FROM (
  SELECT *, bool_or(unmapped) OVER (PARTITION BY src ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM samlines)
WHERE before AND NOT unmapped
""")
def unmapped_last(t):
    return rd.unmapped_before_mapped(_sam_lines(t))


@query("o01_coordinate_sort", """
SELECT rid, CASE WHEN flag & 4 <> 0 THEN 99 ELSE contig_idx END AS contig_idx, "start" FROM aln JOIN contigs USING (contig)
""")
def coordinate_sort(t):
    ordered = coverage.coordinate_sorted(t.alignments, t.contigs, 16)
    return ordered.select("rid", F.coalesce("contig_idx", F.lit(99)).alias("contig_idx"), "start")


view("known", """SELECT 'chr' || (o_custkey % 22 + 1) AS contig, o_orderkey * 8 + 5 AS pos FROM orders""")
OBSERVED = """
SELECT read_group, bq AS quality, CASE WHEN flag & 16 <> 0 THEN q - 1 - o ELSE o END AS cycle,
       CASE WHEN flag & 16 <> 0 THEN CASE WHEN o < q - 1 THEN reverse(translate(substr(seq, CAST(o + 1 AS INTEGER), 2), 'ACGT', 'TGCA')) END
            ELSE CASE WHEN o > 0 THEN substr(seq, CAST(o AS INTEGER), 2) END END AS context,
       base <> substr(r.bases, CAST(p % 8 + 1 AS INTEGER), 1) AS error
FROM basecell b JOIN reflines r ON r.contig = b.contig AND r.k = b.p // 8
WHERE flag & 3332 = 0 AND NOT EXISTS (SELECT 1 FROM known WHERE known.contig = b.contig AND known.pos = b.p)
"""
view("observed_bases", OBSERVED)
view("observed_ready", OBSERVED + " AND rid NOT IN (SELECT rid FROM marked WHERE duplicate)")


def _observations(t):
    return recalibration.base_observations(t.alignments, masked_chunks(t.chunks, _known(t)), max_span=512)


def _known(t):
    return t.read("orders").select(
        F.concat(F.lit("chr"), F.col("o_custkey") % 22 + 1).alias("contig"), (F.col("o_orderkey") * 8 + 5).alias("pos")
    )


@query("a27_recalibration_table", """
SELECT read_group, CAST(quality AS INTEGER) AS quality, CAST(cycle AS INTEGER) AS cycle, context, count(*) AS observations, count(*) FILTER (error) AS errors
FROM observed_bases GROUP BY ALL
""")
def recalibration_table(t):
    return recalibration.covariate_table(_observations(t)).withColumn("cycle", F.col("cycle").cast("int"))


EMPIRICAL = "-10 * log10((count(*) FILTER (error) + 1) / CAST(count(*) + 2 AS DOUBLE)) AS e"
for source, name in (("observed_bases", "recal"), ("observed_ready", "ready")):
    view(f"{name}_all", f"SELECT read_group, {EMPIRICAL} FROM {source} GROUP BY 1")
    view(f"{name}_quality", f"SELECT read_group, quality, {EMPIRICAL} FROM {source} GROUP BY 1, 2")
    view(f"{name}_cycle", f"SELECT read_group, cycle, {EMPIRICAL} FROM {source} GROUP BY 1, 2")
    view(f"{name}_context", f"SELECT read_group, context, {EMPIRICAL} FROM {source} WHERE context IS NOT NULL GROUP BY 1, 2")
view("recal_bases", """
SELECT rid, read_group, i, ascii(substr(qual, CAST(i + 1 AS INTEGER), 1)) - 33 AS quality, CASE WHEN flag & 16 <> 0 THEN q - 1 - i ELSE i END AS cycle,
       CASE WHEN flag & 16 <> 0 THEN CASE WHEN i < q - 1 THEN reverse(translate(substr(seq, CAST(i + 1 AS INTEGER), 2), 'ACGT', 'TGCA')) END
            ELSE CASE WHEN i > 0 THEN substr(seq, CAST(i AS INTEGER), 2) END END AS context
FROM (SELECT *, unnest(range(0, q)) AS i FROM aln)
""")


RECALIBRATED = """
SELECT rid, read_group, oq, coalesce(n.qual, oq) AS qual FROM (SELECT rid, read_group, qual AS oq FROM aln) LEFT JOIN (
  SELECT rid, string_agg(chr(CAST(33 + greatest(1, least(93, round(coalesce(bq.e, b.quality) + coalesce(bc.e - g.e, 0) + coalesce(bx.e - g.e, 0)))) AS INTEGER)), '' ORDER BY i) AS qual
  FROM recal_bases b JOIN {name}_all g USING (read_group)
  LEFT JOIN {name}_quality bq ON bq.read_group = b.read_group AND bq.quality = b.quality
  LEFT JOIN {name}_cycle bc ON bc.read_group = b.read_group AND bc.cycle = b.cycle
  LEFT JOIN {name}_context bx ON bx.read_group = b.read_group AND bx.context = b.context
  GROUP BY rid) n USING (rid)
"""
view("recalibrated", RECALIBRATED.format(name="recal"))
view("ready_reads", RECALIBRATED.format(name="ready"))


@query("sc31_apply_recalibration", "SELECT rid, oq, qual FROM recalibrated")
def apply_recalibration(t):
    """New qualities per read with the old string kept."""
    shifts = recalibration.offsets(recalibration.covariate_table(_observations(t)))
    return recalibration.apply(t.alignments, shifts).select("rid", "qual", "oq")


# the adapter's reads have at most 50 bases and a deletion of two
READ_SPAN = 64


@query("c05_read_preparation", """
SELECT read_group, count(*) AS reads, count(*) FILTER (duplicate OR flag & 1024 <> 0) AS duplicates, count(*) FILTER (r.qual <> r.oq) AS changed_qualities
FROM ready_reads r JOIN marked USING (rid) JOIN (SELECT rid, flag FROM aln) USING (rid) GROUP BY 1
""")
def read_preparation(t):
    """Lanes to analysis-ready reads: counts after union, duplicate marking and recalibration."""
    single = t.alignments.withColumn("qname", F.col("rid"))
    lanes = [single.filter(F.col("library") == x) for x in ("A", "N", "R")]
    ready = coverage.prepare_reads(lanes, t.near_chunks(READ_SPAN), _known(t), max_span=READ_SPAN)
    changed = F.count_if(F.col("qual") != F.col("oq")).alias("changed_qualities")
    return ready.groupBy("read_group").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(rd.has(rd.DUPLICATE)).alias("duplicates"), changed
    )


@query("c06_alignment_report", """
SELECT read_group, count(*) FILTER (flag & 2304 = 0) AS primary_reads, count(*) FILTER (flag & 2308 = 0) AS mapped_reads,
       count(*) FILTER (flag & 2304 = 0 AND l_partkey % 89 = 0) AS quality_violations
FROM aln GROUP BY 1
""")
def alignment_report(t):
    """Counts per read group next to the original-quality violations of its reads."""
    part = F.col("l_partkey")
    reads = t.alignments.withColumns({"qname": F.col("rid"), "oq": stored_order(F.col("qual"), F.col("flag"))})
    forward = F.when(rd.has(rd.REVERSE), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    expected = reads.filter(rd.primary()).select(
        "qname", rd.mate().alias("mate"), "read_group",
        F.when(~rd.has(rd.UNMAPPED), F.col("contig")).alias("contig"), "pos", rd.has(rd.REVERSE).alias("reverse"),
        F.sha2(forward, 256).alias("sequence_sha256"),
        F.concat(F.col("qual"), F.when(part % 89 == 0, "!").otherwise("")).alias("original_qualities"),
    )
    bad = rd.compare_expected(reads, expected).join(reads.select("qname", "read_group"), "qname")
    counted = bad.groupBy("read_group").agg(F.count_if(F.col("rule") == "original_quality").alias("quality_violations"))
    return rd.flag_counts(t.alignments, ["read_group"]).join(counted, "read_group", "left").select(
        "read_group", "primary_reads", "mapped_reads", F.coalesce("quality_violations", F.lit(0)).alias("quality_violations")
    )
