"""Text sources and sinks: rows rendered as lines, then parsed or exported."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.evidence import canonical_hash
from ..operators import intervals as iv
from ..operators import matching
from ..operators.rules import duplicates
from ..sources import bed, documents, fasta, fastq, files, gtf, reports, sam, sinks, vcf
from ..sources.lines import good
from .adapters import BASES, GROUPS, HEX, as_lines
from .registry import query, view


def _key():
    return F.col("o_orderkey")


view("bedsrc", """
SELECT o_orderkey, o_orderkey + 1 AS line_no, 'chr' || (o_custkey % 24 + 1) AS contig,
       CASE WHEN o_orderkey % 29 = 0 THEN o_orderkey * 8 - 100000000000 ELSE o_orderkey * 8 END AS "start",
       o_orderkey * 8 + 1 + o_custkey % 40 AS "end", length FROM orders
LEFT JOIN contigs ON contigs.contig = 'chr' || (o_custkey % 24 + 1)
""")
view("bedcheck", """
SELECT *, CASE WHEN o_orderkey % 41 = 0 THEN 'column_count' WHEN o_orderkey % 37 = 0 THEN 'integer'
               WHEN length IS NULL THEN 'unknown_contig' WHEN "start" < 0 OR "end" > length THEN 'bounds' END AS violation FROM bedsrc
""")


def _bed_lines(t):
    rows = t.read("orders").select(
        "o_orderkey",
        F.concat(F.lit("chr"), F.col("o_custkey") % 24 + 1).alias("contig"),
        F.when(_key() % 29 == 0, _key() * 8 - 100000000000).otherwise(_key() * 8).alias("start"),
        (_key() * 8 + 1 + F.col("o_custkey") % 40).alias("end"),
    )
    text = F.concat_ws("\t", "contig", F.when(_key() % 37 == 0, "x").otherwise(F.col("start").cast("string")), "end", F.when(_key() % 41 == 0, "extra"))
    return as_lines(rows, text, _key() + 1, "regions.bed")


@query("s01_exact_bed", "SELECT line_no, contig, violation FROM bedcheck")
def exact_bed(t):
    return bed.parse_bed3(_bed_lines(t), t.contigs).select("line_no", "contig", "violation")


@query("s02_named_bed", """
SELECT line_no, contig, "start", "end", CASE WHEN o_orderkey % 2 = 0 THEN 'target' || o_orderkey ELSE printf('interval_%08d', line_no) END AS name
FROM bedsrc WHERE o_orderkey % 11 <> 0 AND length IS NOT NULL AND "start" >= 0 AND "end" <= length AND contig <> 'chr7'
""")
def named_bed(t):
    rows = _bed_source(t)
    name = F.when(_key() % 2 == 0, F.concat(F.lit("target"), "o_orderkey"))
    text = F.when(_key() % 11 == 0, "# comment").otherwise(F.concat_ws("\t", "contig", "start", "end", name))
    allowed = [f"chr{i}" for i in range(1, 23) if i != 7]
    parsed = bed.parse_bed(as_lines(rows, text, _key() + 1, "design.bed"), t.contigs, allowed)
    return good(parsed).select("line_no", "contig", "start", "end", "name")


def _bed_source(t):
    return t.read("orders").select(
        "o_orderkey",
        F.concat(F.lit("chr"), F.col("o_custkey") % 24 + 1).alias("contig"),
        F.when(_key() % 29 == 0, _key() * 8 - 100000000000).otherwise(_key() * 8).alias("start"),
        (_key() * 8 + 1 + F.col("o_custkey") % 40).alias("end"),
    )


@query("s03_bed_union", """
SELECT contig, min("start") AS "start", max("end") AS "end" FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY "start", "end") AS island
  FROM (SELECT *, max("end") OVER (PARTITION BY contig ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM bedcheck WHERE violation IS NULL)) GROUP BY contig, island
""")
def bed_union(t):
    return iv.union(good(bed.parse_bed3(_bed_lines(t), t.contigs)))


@query("s04_sorted_bed", """
SELECT line_no FROM (SELECT line_no, contig_idx, "start", lag(contig_idx) OVER w AS pc, lag("end") OVER w AS pe
  FROM bedcheck JOIN contigs USING (contig) WHERE violation IS NULL WINDOW w AS (ORDER BY line_no))
WHERE contig_idx < pc OR (contig_idx = pc AND "start" < pe)
""")
def sorted_bed(t):
    return iv.order_violations(good(bed.parse_bed3(_bed_lines(t), t.contigs))).select("line_no")


def _scaffolds(t):
    return t.read("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")
    )


@query("s05_fasta_index", """
SELECT 'ctg' || o_custkey % 1000 AS contig, CASE WHEN o_custkey % 31 = 0 THEN 0 ELSE count(*) * 100 END AS length,
       min(o_orderkey) AS "offset", CASE WHEN o_custkey % 31 = 0 THEN 'length' END AS violation
FROM orders GROUP BY o_custkey
""")
def fasta_index(t):
    rows = _scaffolds(t)
    length = F.when(F.col("o_custkey") % 31 == 0, 0).otherwise(F.col("n") * 100)
    text = F.concat_ws("\t", F.concat(F.lit("ctg"), F.col("o_custkey") % 1000), length, "first", F.lit(60), F.lit(61))
    return bed.parse_fasta_index(as_lines(rows, text, F.col("o_custkey"), "ref.fai")).select("contig", "length", "offset", "violation")


@query("s05_repeated_contigs", """
SELECT contig, count(*) AS n FROM (SELECT DISTINCT o_custkey, 'ctg' || o_custkey % 1000 AS contig FROM orders) GROUP BY 1 HAVING count(*) > 1
""")
def repeated_contigs(t):
    rows = t.read("orders").select("o_custkey").distinct()
    text = F.concat_ws("\t", F.concat(F.lit("ctg"), F.col("o_custkey") % 1000), F.lit(5), F.lit(1), F.lit(60), F.lit(61))
    return bed.repeated_contigs(bed.parse_fasta_index(as_lines(rows, text, F.col("o_custkey"), "ref.fai")))


@query("s06_sequence_dictionary", """
SELECT 'ctg' || o_custkey AS contig, count(*) * 100 AS length, md5('c' || o_custkey) AS md5 FROM orders GROUP BY o_custkey
""")
def sequence_dictionary(t):
    rows = _scaffolds(t)
    text = F.concat_ws(
        "\t", F.lit("@SQ"), F.concat(F.lit("SN:ctg"), "o_custkey"), F.concat(F.lit("LN:"), F.col("n") * 100),
        F.concat(F.lit("M5:"), F.upper(F.md5(F.concat(F.lit("c"), "o_custkey")))),
    )
    return bed.parse_sequence_dictionary(as_lines(rows, text, F.col("o_custkey"), "ref.dict")).select("contig", "length", "md5")


@query("s06_dictionary_rules", """
SELECT o_custkey AS line_no, CASE WHEN o_custkey % 17 = 0 THEN 'repeated_tag' WHEN o_custkey % 19 = 0 THEN 'name' WHEN o_custkey % 7 = 0 OR o_custkey % 11 = 0 THEN 'length' ELSE 'md5' END AS violation
FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey % 17 = 0 OR o_custkey % 19 = 0 OR o_custkey % 7 = 0 OR o_custkey % 11 = 0 OR o_custkey % 13 = 0
""")
def dictionary_rules(t):
    """Lines that repeat a tag, lack a name or a length, or state a length or a digest that is none."""
    key = F.col("o_custkey")
    name = F.when(key % 19 == 0, "SN:").otherwise(F.concat(F.lit("SN:ctg"), key))
    length = F.when(key % 7 == 0, "XX:none").when(key % 11 == 0, "LN:-5").otherwise("LN:100")
    md5 = F.when(key % 13 == 0, "M5:short").when(key % 2 == 0, F.concat(F.lit("M5:"), F.upper(F.md5(key.cast("string"))))).otherwise("AS:x")
    text = F.concat_ws("\t", F.lit("@SQ"), name, length, md5, F.when(key % 17 == 0, "SN:again"))
    rows = t.read("orders").select("o_custkey").distinct()
    return bed.parse_sequence_dictionary(as_lines(rows, text, key, "ref.dict")).filter("violation is not null").select("line_no", "violation")


view("falines", """
SELECT o_orderkey AS k, o_orderkey // 100 AS c, CASE WHEN o_orderkey % 100 = 99 THEN 20 ELSE 60 END AS n,
       substr(translate(sha256('fa' || o_orderkey), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, CASE WHEN o_orderkey % 100 = 99 THEN 20 ELSE 60 END) AS bases
FROM orders
""")


def _fasta(t):
    """FASTA text with a contig per hundred orders, 60 bases a line."""
    size = F.when(_key() % 100 == 99, 20).otherwise(60)
    bases = F.substring(F.translate(F.sha2(F.concat(F.lit("fa"), "o_orderkey"), 256), HEX, BASES), F.lit(1), size)
    head = F.struct((_key() + F.floor(_key() / 100) + 1).alias("at"), F.concat(F.lit(">ctg"), F.floor(_key() / 100), F.lit(" invented")).alias("text"))
    body = F.struct((_key() + F.floor(_key() / 100) + 2).alias("at"), bases.alias("text"))
    rows = t.read("orders").select(
        F.explode(F.when(_key() % 100 == 0, F.array(head, body)).otherwise(F.array(body))).alias("l")
    )
    return as_lines(rows, F.col("l.text"), F.col("l.at"), "ref.fa")


@query("s07_contig_lengths", "SELECT 'ctg' || c AS contig, CAST(sum(n) AS BIGINT) AS length, true AS alphabet_ok FROM falines GROUP BY c")
def contig_lengths(t):
    return fasta.contig_lengths(fasta.parse_fasta(_fasta(t))).select("contig", "length", "alphabet_ok")


@query("s08_reference_scan", """
SELECT 'ctg' || c AS contig, CAST(sum(n) AS BIGINT) AS length, md5(string_agg(bases, '' ORDER BY k)) AS md5 FROM falines GROUP BY c
""")
def reference_scan(t):
    return fasta.contig_md5(fasta.chunks(fasta.parse_fasta(_fasta(t))))


view("fachunks", """
SELECT c, i, sha256(upper(substr(whole, 512 * i + 1, 512))) AS d, least(512, length(whole) - 512 * i) AS n FROM (
  SELECT c, whole, unnest(range(0, (length(whole) + 511) // 512)) AS i FROM (SELECT c, string_agg(bases, '' ORDER BY k) AS whole FROM falines GROUP BY c))
""")
TREE = "SELECT c, i // 4 AS i, CASE WHEN count(*) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d, sum(n) AS n, sum(p) AS p FROM {source} GROUP BY c, i // 4"


@query("s08_digest_tree", f"""
SELECT 'ctg' || c AS contig, CAST(n AS BIGINT) AS length, CAST(p AS BIGINT) AS pieces, d AS sha256
FROM ({TREE.format(source="(" + TREE.format(source="(" + TREE.format(source="(" + TREE.format(source="(SELECT *, 1 AS p FROM fachunks)") + ")") + ")") + ")")})
""")
def digest_tree(t):
    """Small nodes, so that the trees of these contigs are two levels high."""
    return fasta.contig_digests(fasta.chunks(fasta.parse_fasta(_fasta(t))), fan_out=4)


@query("w11_byte_offsets", """
SELECT 'ctg' || c AS contig, min(off) AS "offset", max(n) AS line_bases FROM (
  SELECT c, n, k % 100 AS i, sum(n + 1 + CASE WHEN k % 100 = 0 THEN length('>ctg' || c || ' invented') + 1 ELSE 0 END) OVER (ORDER BY k)
         - n - 1 AS off FROM falines) GROUP BY c
""".replace("min(off) AS", "CAST(min(off) AS BIGINT) AS"))
def byte_offsets(t):
    return fasta.contig_lengths(fasta.parse_fasta(_fasta(t))).select("contig", "offset", "line_bases")


@query("s08_line_wrapping", "SELECT k + c + 2 AS line_no FROM falines WHERE k % 100 = 50")
def line_wrapping(t):
    lines = _fasta(t)
    # Shorten the line of every order whose key ends in 50, so each contig has one bad line.
    order = F.col("line_no") - 2 - F.floor((F.col("line_no") - 2) / 101)
    bad = ~F.col("value").startswith(">") & (order % 100 == 50)
    return fasta.wrapping_violations(
        fasta.parse_fasta(lines.withColumn("value", F.when(bad, F.substring("value", 1, 30)).otherwise(F.col("value"))))
    ).select("line_no")


@query("s09_sequence_slices", """
SELECT rid, substr(r.bases, CAST(l."start" - r."start" + 1 AS INTEGER), l.q) AS "window" FROM li l JOIN refwin r ON r.contig = l.contig AND r.k = l."start" // 8
""")
def sequence_slices(t):
    sites = t.lines.select("rid", "contig", "start", (F.col("start") + F.col("q")).alias("end"))
    return fasta.windows(sites, t.chunks, "rid", max_span=50).select("rid", "window")


view("gtfall", """
SELECT o_orderkey + 1 AS line_no, 'chr' || (o_custkey % 24 + 1) AS contig, o_orderkey * 8 AS "start", o_orderkey * 8 + 10 + o_custkey % 40 AS "end",
       ['CDS', 'stop_codon', 'UTR', 'exon'][o_orderkey % 4 + 1] AS feature, o_custkey, o_orderkey, length
FROM orders LEFT JOIN contigs ON contigs.contig = 'chr' || (o_custkey % 24 + 1)
""")
view("gtfsrc", "SELECT * FROM gtfall WHERE length IS NOT NULL AND o_orderkey % 23 <> 0 AND o_orderkey % 29 <> 0")


@query("s10_annotation_rows", """
SELECT line_no, contig, feature, CAST(CASE WHEN o_orderkey % 23 <> 0 THEN "start" END AS DOUBLE) AS "start", "end",
       CASE WHEN o_orderkey % 29 = 0 THEN 'column_count' WHEN o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 THEN 'biotype'
            WHEN o_orderkey % 23 = 0 THEN 'integer' WHEN "end" > length THEN 'bounds' END AS violation
FROM gtfall WHERE o_orderkey % 29 = 0 OR (length IS NOT NULL AND feature IN ('CDS', 'stop_codon') AND (o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 OR o_custkey % 5 <> 0))
""")
def annotation_rows(t):
    return gtf.coding_features(gtf.parse_gtf(_gtf(t)), t.contigs).select("line_no", "contig", "feature", F.col("start").cast("double").alias("start"), "end", "violation")


@query("p01_coding_selection", """
SELECT contig, feature, count(*) AS n, CAST(sum("end" - "start") AS BIGINT) AS bases FROM gtfsrc
WHERE feature IN ('CDS', 'stop_codon') AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_custkey % 5 <> 0 AND "end" <= length GROUP BY ALL
""")
def coding_selection(t):
    rows = good(gtf.coding_features(gtf.parse_gtf(_gtf(t)), t.contigs))
    return rows.groupBy("contig", "feature").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("bases"))


def _gtf(t):
    kind = F.when(F.col("o_custkey") % 5 == 0, "lncRNA").otherwise("protein_coding")
    gene = F.concat(F.lit('gene_id "g"; gene_type "'), kind, F.lit('"; '))
    attributes = F.concat(
        F.when(_key() % 17 == 0, "").otherwise(gene),
        F.lit('transcript_type "'), kind, F.lit('";'),
        F.when(_key() % 19 == 0, F.lit(' transcript_type "other";')).otherwise(""),
    )
    feature = F.element_at(F.array(*[F.lit(x) for x in ("CDS", "stop_codon", "UTR", "exon")]), (_key() % 4 + 1).cast("int"))
    text = F.concat_ws(
        "\t", F.concat(F.lit("chr"), F.col("o_custkey") % 24 + 1), F.lit("src"), feature, F.when(_key() % 23 == 0, "x").otherwise((_key() * 8 + 1).cast("string")),
        _key() * 8 + 10 + F.col("o_custkey") % 40, F.lit("."), F.lit("+"), F.lit("0"), F.when(_key() % 29 != 0, attributes),
    )
    return as_lines(t.read("orders"), text, _key() + 1, "genes.gtf")


@query("so05_coding_union", """
SELECT contig, min("start") AS "start", max("end") AS "end" FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY "start", "end") AS island
  FROM (SELECT *, max("end") OVER (PARTITION BY contig ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM gtfsrc WHERE feature IN ('CDS', 'stop_codon') AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 AND o_custkey % 5 <> 0 AND "end" <= length))
GROUP BY contig, island
""")
def coding_union(t):
    return iv.union(good(gtf.coding_features(gtf.parse_gtf(_gtf(t)), t.contigs)))


view("fqsrc", """
SELECT o_orderkey AS record, o_custkey, 20 + o_custkey % 40 AS n, 'lane' || o_custkey % 3 AS lane FROM orders
""")


def _fastq(t, mate):
    """Four lines per order; mate 2 drops, renames or damages some records."""
    n = (20 + F.col("o_custkey") % 40).cast("int")
    text = F.concat(F.lit(f"fq{mate}"), "o_orderkey")
    bases = F.substring(F.translate(F.sha2(text, 256), HEX, BASES), F.lit(1), n)
    quality = F.substring(F.translate(F.sha2(F.concat(text, F.lit("q")), 256), HEX, "#(+-05:<?ABDEFGI"), F.lit(1), n)
    if mate == 2:
        quality = F.when(_key() % 23 == 0, F.concat(quality, F.lit("I"))).otherwise(quality)
    name = F.concat(F.lit("@r"), _key() + (F.when(_key() % 29 == 0, 1).otherwise(0) if mate == 2 else F.lit(0)), F.lit(f"/{mate} comment"))
    rows = t.read("orders").select("o_orderkey", F.posexplode(F.array(name, bases, F.lit("+"), quality)).alias("i", "text"))
    return as_lines(rows, F.col("text"), _key() * 4 + F.col("i") + 1, f"R{mate}.fastq")


@query("s11_fastq_records", """
SELECT record, 'r' || record AS read_id, n AS bases, NULL AS violation FROM fqsrc
""".replace("NULL AS", "CAST(NULL AS VARCHAR) AS"))
def fastq_records(t):
    return fastq.parse_fastq(_fastq(t, 1), 1).select("record", "read_id", F.length("bases").cast("bigint").alias("bases"), "violation")


@query("s11_repeated_reads", """
SELECT 'r' || (record + 1) AS read_id, CAST(2 AS BIGINT) AS n FROM fqsrc WHERE record % 29 = 0 AND record + 1 IN (SELECT record FROM fqsrc)
""")
def repeated_reads(t):
    """Renamed records of mate 2 that now bear the id of the record behind them."""
    return fastq.repeated_reads(fastq.parse_fastq(_fastq(t, 2), 2))


@query("j08_lane_pairs", """
SELECT lane, record, CASE WHEN record % 23 = 0 OR lane = 'L2' AND record % 31 = 0 THEN 'missing_mate' WHEN record % 29 = 0 THEN 'identity_mismatch' END AS violation
FROM fqsrc, (VALUES ('L1'), ('L2')) v(lane)
""".replace("fqsrc, (", "(SELECT record FROM fqsrc), ("))
def lane_pairs(t):
    """Two lanes with the same record numbers: a record only meets the mate of its own lane."""
    lanes = F.explode(F.array(F.lit("L1"), F.lit("L2"))).alias("lane")
    first = good(fastq.parse_fastq(_fastq(t, 1), 1)).select("*", lanes)
    second = good(fastq.parse_fastq(_fastq(t, 2), 2)).select("*", lanes).filter("not (lane = 'L2' and record % 31 = 0)")
    return fastq.pair_mates(first, second, ["lane"]).select("lane", "record", "violation")


@query("j08_mate_pairs", """
SELECT record, CASE WHEN record % 23 = 0 THEN 'missing_mate' WHEN record % 29 = 0 THEN 'identity_mismatch' END AS violation FROM fqsrc
""")
def mate_pairs(t):
    pairs = fastq.pair_mates(good(fastq.parse_fastq(_fastq(t, 1), 1)), good(fastq.parse_fastq(_fastq(t, 2), 2)))
    return pairs.select("record", "violation")


@query("a20_lane_summary", """
SELECT 'lane' || record % 3 AS lane, count(*) AS reads, CAST(sum(n) AS BIGINT) AS bases,
       min(list_min(qs)) AS min_quality, max(list_max(qs)) AS max_quality
FROM (SELECT *, list_transform(range(1, n + 1), lambda i: ascii(substr(translate(sha256('fq1' || record || 'q'), '0123456789abcdef', '#(+-05:<?ABDEFGI'), CAST(i AS INTEGER), 1)) - 33) AS qs FROM fqsrc)
GROUP BY 1
""")
def lane_summary(t):
    reads = good(fastq.parse_fastq(_fastq(t, 1), 1)).withColumn("lane", F.concat(F.lit("lane"), F.col("record") % 3))
    return fastq.lane_summary(reads, ["lane"]).drop("name_digest")


def _sam(t):
    a = t.alignments
    text = F.concat_ws(
        "\t", "rid", "flag", "contig", "pos", "mapq", "cigar", F.lit("*"), F.lit(0), F.lit(0), "seq", "qual",
        F.concat(F.lit("RG:Z:"), "read_group"), F.when(F.col("l_partkey") % 43 == 0, "broken").otherwise(F.concat(F.lit("OQ:Z:"), "qual")),
    )
    return as_lines(a, text, F.col("l_orderkey") + 1, "reads.sam")


@query("s12_sam_records", """
SELECT rid, flag, contig, pos, mapq, seq, read_group, CASE WHEN l_partkey % 43 = 0 THEN 'tags' END AS violation
FROM (SELECT *, CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE read_group END AS rg FROM aln) a
""".replace("read_group, CASE", "rg AS read_group, CASE"))
def sam_records(t):
    return sam.parse_sam(_sam(t)).select(
        F.col("qname").alias("rid"), "flag", "contig", "pos", "mapq", "seq", F.col("tags")["RG"].alias("read_group"), "violation"
    )


def _vcf(t):
    v = t.variants
    info = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("DP=9;END="), F.col("pos") + 20)).otherwise(".")
    fmt = F.when(F.col("l_partkey") % 4 == 0, "GT").otherwise("GT:DP:GQ")
    call = F.when(F.col("l_partkey") % 4 == 0, F.col("gt")).otherwise(F.concat_ws(":", "gt", F.col("l_partkey") % 90))
    text = F.concat_ws(
        "\t", "contig", "pos", "row_id", "ref", F.array_join("alts", ","), F.when(F.col("l_partkey") % 6 == 0, ".").when(F.col("l_partkey") % 83 == 0, "high").otherwise(F.concat(F.col("l_partkey") % 100, F.lit(".5"))),
        "filter", info, fmt, call,
    )
    return as_lines(v, text, F.col("l_orderkey") + 1, "calls.vcf")


@query("s13_vcf_records", """
SELECT row_id, contig, pos, ref, array_to_string(alts, ',') AS alts, gt, CASE WHEN l_partkey % 83 = 0 AND l_partkey % 6 <> 0 THEN 'qual' END AS violation FROM vraw
""")
def vcf_records(t):
    parsed = vcf.parse_vcf(_vcf(t))
    return parsed.select(F.col("id").alias("row_id"), "contig", "pos", "ref", F.array_join("alts", ",").alias("alts"), "gt", "violation")


@query("s14_native_records", """
SELECT row_id, CASE WHEN l_partkey % 6 <> 0 AND l_partkey % 83 <> 0 THEN l_partkey % 100 + 0.5 END AS qual,
       CASE WHEN l_partkey % 3 = 0 THEN pos + 20 ELSE pos + length(ref) - 1 END AS "end",
       CASE WHEN l_partkey % 4 <> 0 THEN CAST(l_partkey % 90 AS VARCHAR) END AS dp FROM vraw
""")
def native_records(t):
    parsed = vcf.parse_vcf(_vcf(t))
    return parsed.select(F.col("id").alias("row_id"), "qual", "end", F.try_element_at("call", F.lit("DP")).alias("dp"))


@query("sc09_variant_end", """
SELECT contig, CAST(sum(CASE WHEN l_partkey % 3 = 0 THEN 20 ELSE length(ref) - 1 END) AS BIGINT) AS span FROM vraw GROUP BY contig
""")
def variant_end(t):
    parsed = vcf.parse_vcf(_vcf(t))
    return parsed.groupBy("contig").agg(F.sum(F.col("end") - F.col("pos")).alias("span"))


@query("s15_trace", """
SELECT task_id, process, grp AS "group", status, cached, CAST(duration_ms AS DOUBLE) AS duration_ms, CAST(realtime_ms AS DOUBLE) AS realtime_ms,
       cpu_halves / 2.0 AS cpu_percent, CAST(peak_vmem AS DOUBLE) AS peak_vmem_bytes, CAST(NULL AS VARCHAR) AS violation FROM tk
""".replace("cpu_halves / 2.0", "CAST(cpu_halves AS DOUBLE) / 2"))
def trace(t):
    parsed = reports.parse_trace(t.raw_trace, GROUPS)
    return parsed.select(
        "task_id", "process", "group", "status", "cached",
        *[F.col(c).cast("double").alias(c) for c in ("duration_ms", "realtime_ms", "cpu_percent", "peak_vmem_bytes")],
        "violation",
    )


@query("s16_samplesheet", """
SELECT c_custkey + 1 AS line_no, CASE WHEN c_custkey % 7 = 0 THEN 's,' ELSE 's' END || c_custkey AS sample, CASE WHEN c_custkey % 11 = 0 THEN 'column_count' END AS violation FROM customer
""")
def samplesheet(t):
    key = F.col("c_custkey")
    text = F.concat_ws(",", F.when(key % 7 == 0, F.concat(F.lit('"s,'), key, F.lit('"'))).otherwise(F.concat(F.lit("s"), key)), F.lit("lib"), F.lit("L1"), F.when(key % 11 == 0, "surplus"))
    rows = reports.parse_samplesheet(as_lines(t.read("customer"), text, key + 1, "samples.csv"), ["sample", "library", "lane"])
    return rows.select("line_no", "sample", "violation")


view("sections", """SELECT o_orderkey // 50 AS rep, o_orderkey % 50 AS i, o_custkey FROM orders""")


def _metrics_report(t):
    i = _key() % 50
    text = (
        F.when(i < 5, "# remark")
        .when(i == 5, "LIBRARY\tUNPAIRED_READ_DUPLICATES\tREAD_PAIR_DUPLICATES")
        .when(i < 30, F.concat_ws("\t", F.concat(F.lit("lib"), i), F.col("o_custkey") % 7, F.col("o_custkey") % 5))
        .when(i == 30, "")
        .otherwise("1\t2\t3")
    )
    return as_lines(t.read("orders"), text, i + 1, F.concat(F.lit("report"), F.floor(_key() / 50)))


@query("s17_metrics_section", """
SELECT 'report' || rep AS source, i + 1 AS line_no, 'lib' || i AS library, CAST(o_custkey % 7 AS VARCHAR) AS unpaired FROM sections WHERE i BETWEEN 6 AND 29
""")
def metrics_section(t):
    rows = reports.section_table(_metrics_report(t), "LIBRARY")
    return rows.select("source", "line_no", F.col("row")["LIBRARY"].alias("library"), F.col("row")["UNPAIRED_READ_DUPLICATES"].alias("unpaired"))


@query("a21_duplicate_totals", """
SELECT 'report' || rep AS source, CAST(sum(o_custkey % 7 + 2 * (o_custkey % 5)) AS BIGINT) AS duplicate_reads,
       CAST(sum(o_custkey % 5) AS BIGINT) AS duplicate_pairs FROM sections WHERE i BETWEEN 6 AND 29 GROUP BY rep
""")
def duplicate_totals(t):
    rows = reports.section_table(_metrics_report(t), "LIBRARY")
    single, pairs = F.col("row")["UNPAIRED_READ_DUPLICATES"].cast("bigint"), F.col("row")["READ_PAIR_DUPLICATES"].cast("bigint")
    return rows.groupBy("source").agg(F.sum(single + 2 * pairs).alias("duplicate_reads"), F.sum(pairs).alias("duplicate_pairs"))


view("depthtotals", """
SELECT o_custkey, count(*) * 100 AS length, CAST(sum(o_orderkey % 1000) AS BIGINT) AS bases, min(o_orderkey % 1000) AS mn, max(o_orderkey % 1000) AS mx,
       CAST(CAST(sum(o_orderkey % 1000) AS BIGINT) * 100 // (count(*) * 100) AS DOUBLE) / 100 + CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS mean FROM orders GROUP BY o_custkey
""")


def _depth_totals(t):
    depth = _key() % 1000
    rows = t.read("orders").groupBy("o_custkey").agg(
        (F.count(F.lit(1)) * 100).alias("length"), F.sum(depth).alias("bases"), F.min(depth).alias("min"), F.max(depth).alias("max")
    )
    mean = F.floor(F.col("bases") * 100 / F.col("length")) / 100 + F.when(F.col("o_custkey") % 7 == 0, 1).otherwise(0)
    return rows.select(
        F.lit("total").alias("chrom"), *[F.col(c).cast("string").alias(c) for c in ("length", "bases", "min", "max")], mean.cast("string").alias("mean")
    )


@query("s18_depth_totals", "SELECT length, bases, mean, mn AS min, mx AS max FROM depthtotals")
def depth_totals(t):
    return reports.depth_total_violations(_depth_totals(t), F.col("length")).select("length", "bases", "mean", "min", "max")


@query("a05_depth_mean_check", """
SELECT length, bases, CASE WHEN abs(mean - CAST(bases AS DOUBLE) / length) > 0.011 THEN 'mean' END AS violation FROM depthtotals
""")
def depth_mean_check(t):
    return reports.depth_total_violations(_depth_totals(t), F.col("length")).select("length", "bases", "violation")


@query("s19_recalibration_report", """
SELECT rep, CAST(sum(o_custkey % 100) AS BIGINT) AS observations FROM (
  SELECT o_orderkey // 500 AS rep, o_orderkey % 20 AS i, o_custkey FROM orders) WHERE i BETWEEN 1 AND 14 GROUP BY rep
""")
def recalibration_report(t):
    """Tables of fourteen rows under a header, closed by a line of another width."""
    i = _key() % 20
    text = (
        F.when(i == 0, "ReadGroup QualityScore  Observations Errors")
        .when(i < 15, F.concat_ws("  ", F.lit("rg1"), F.lit(30), F.col("o_custkey") % 100, F.lit(1)))
        .when(i == 15, "end of table")
        .otherwise("rg1 30 5 1")
    )
    lines = as_lines(t.read("orders"), text, _key() + 1, "recal.txt")
    rows = reports.recalibration_observations(lines)
    return rows.groupBy(F.floor((F.col("line_no") - 1) / 500).alias("rep")).agg(F.sum("observations").alias("observations"))


@query("s20_record_numbers", "SELECT o_orderkey + 1 AS line_no, o_orderkey FROM orders")
def record_numbers(t):
    """Record order of a columnar file: its row index is kept through splits."""
    return t.read("orders").select((F.col("_metadata.row_index") + 1).alias("line_no"), "o_orderkey")


@query("s21_depth_rows", """
SELECT 'chr' || (l_suppkey % 22 + 1) AS contig, CASE WHEN l_partkey % 71 <> 0 THEN CAST(l_orderkey + 1 AS DOUBLE) END AS pos,
       CAST(l_quantity AS BIGINT) AS depth, count(*) AS n, CASE WHEN l_partkey % 71 = 0 THEN 'malformed' END AS violation
FROM lineitem GROUP BY ALL
""")
def depth_rows(t):
    text = F.concat_ws(
        "\t", F.concat(F.lit("chr"), F.col("l_suppkey") % 22 + 1),
        F.when(F.col("l_partkey") % 71 == 0, "-1").otherwise((F.col("l_orderkey") + 1).cast("string")), F.col("l_quantity").cast("bigint"),
    )
    rows = reports.parse_depth(as_lines(t.read("lineitem"), text, F.col("l_orderkey"), "depth.tsv"))
    return rows.groupBy("contig", F.col("pos").cast("double").alias("pos"), "depth", "violation").agg(F.count(F.lit(1)).alias("n"))


@query("s22_index_counts", """
SELECT 'ctg' || o_custkey AS contig, CAST(CASE WHEN o_custkey % 13 <> 0 THEN count(*) * 10 END AS DOUBLE) AS length, max(o_orderkey) AS mapped, CAST(CASE WHEN o_custkey % 17 <> 0 THEN min(o_orderkey) END AS DOUBLE) AS unmapped,
       CASE WHEN o_custkey % 17 = 0 THEN 'column_count' WHEN o_custkey % 13 = 0 THEN 'length' END AS violation FROM orders GROUP BY o_custkey
""")
def index_counts(t):
    rows = _scaffolds(t)
    text = F.concat_ws("\t", F.concat(F.lit("ctg"), "o_custkey"), F.when(F.col("o_custkey") % 13 == 0, "-").otherwise((F.col("n") * 10).cast("string")), "last", F.when(F.col("o_custkey") % 17 != 0, F.col("first")))
    return reports.parse_index_counts(as_lines(rows, text, F.col("o_custkey"), "idxstats")).drop("source").withColumns({c: F.col(c).cast("double") for c in ("length", "unmapped")})


@query("s23_file_inventory", """
SELECT o_orderkey + 1 AS line_no, CASE WHEN o_orderkey % 23 = 0 THEN 'sha256' WHEN o_orderkey % 29 = 0 THEN 'bytes' WHEN o_orderkey % 31 = 0 THEN 'path' END AS violation FROM orders
""")
def inventory_lines(t):
    f = t.declared_files
    text = F.concat_ws(
        "\t",
        F.when(_key() % 23 == 0, F.upper("sha256")).otherwise(F.col("sha256")),
        F.when(_key() % 29 == 0, "-5").otherwise(F.col("bytes").cast("string")),
        F.when(_key() % 31 == 0, F.concat(F.lit("../"), "path")).otherwise(F.col("path")),
    )
    return reports.parse_file_inventory(as_lines(f, text, _key() + 1, "inputs.tsv")).select("line_no", "violation")


@query("s24_content_inventory", """
SELECT source || '/' || doc_id AS path, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256, md5(text) AS md5 FROM documents
""")
def content_inventory(t):
    return files.inventory(t.read("documents"), F.concat_ws("/", "source", "doc_id"), "text")


@query("s25_json_documents", """
SELECT event_id, CASE WHEN event_id % 41 = 0 THEN 'duplicate_key' WHEN event_id % 43 = 0 THEN 'non_finite' WHEN event_id % 47 = 0 OR event_id % 53 = 0 OR event_id % 59 = 0 THEN 'malformed' WHEN event_id % 61 = 0 THEN 'missing' END AS violation FROM events
""")
def json_documents(t):
    key = F.col("event_id")
    inner = F.concat(F.lit('{"a": '), "props", F.lit(', "b": ['), "props", F.lit("]}"))
    text = (
        F.when(key % 41 == 0, F.lit('{"a": {"k": 1, "k": 2}}'))
        .when(key % 43 == 0, F.lit('{"a": [NaN]}'))
        .when(key % 47 == 0, F.lit('{"a": oops}'))
        .when(key % 53 == 0, F.lit('{"a": 1} {"b": 2}'))
        .when(key % 59 == 0, F.lit("{'a': 1}"))
        .when(key % 61 == 0, F.lit(None).cast("string"))
        .when(key % 67 == 0, F.lit('{"a": "NaN, \\"Infinity"}'))
        .otherwise(inner)
    )
    return t.read("events").select("event_id", documents.json_violation(text).alias("violation"))


@query("s26_receipts", """
SELECT 'run' || event_id AS run_id, 't' || event_id || '.' || i AS task_id, CAST(i * 10 AS DOUBLE) AS start_offset, CAST(i * 10 + user_id AS DOUBLE) AS end_offset
FROM (SELECT *, unnest(range(1 + event_id % 3)) AS i FROM events)
""")
def receipts(t):
    base = (F.col("event_id") * 100).cast("double")
    details = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 3),
        lambda i: F.struct(
            F.concat(F.lit("t"), F.col("event_id"), F.lit("."), i).alias("task_id"), F.col("event_type").alias("name"),
            F.lit("COMPLETED").alias("status"), F.lit(1).alias("cpus"), F.lit(1024).cast("bigint").alias("memory"),
            (base + i * 10).alias("started"), (base + i * 10 + F.col("user_id")).alias("completed"),
        ),
    )
    text = t.read("events").select(F.to_json(F.struct(F.concat(F.lit("run"), "event_id").alias("run_id"), base.alias("started"), details.alias("task_details"))).alias("value"))
    parsed = text.select(F.from_json("value", files.RECEIPT).alias("r")).select("r.*")
    return files.flatten_receipts(parsed).select("run_id", "task_id", "start_offset", "end_offset")


@query("s27_observation_folders", """
SELECT 'obs/' || event_id AS folder, upper(event_type) AS process, event_id % 9 + 1 AS nextflow_process_index, event_id AS started, event_id + user_id AS completed,
       CASE WHEN event_id % 53 = 0 THEN 'version' END AS violation FROM events
""")
def observation_folders(t):
    key = F.col("event_id")
    meta = F.to_json(F.struct(
        F.upper("event_type").alias("process"), F.lit("x").alias("label"), (key % 9 + 1).cast("int").alias("nextflow_process_index"), F.lit(1).alias("attempt"),
        F.lit("img").alias("declared_image"), F.lit(2).alias("requested_cpus"), F.lit(4096).cast("bigint").alias("requested_memory_bytes"),
    ))
    members = {
        "task.json": meta, "started.txt": F.concat(key.cast("string"), F.lit("\n")), "completed.txt": (key + F.col("user_id")).cast("string"),
        "command.sh": F.concat(F.lit("run "), "event_type"), "version.txt": F.when(key % 53 == 0, " ").otherwise("tool 1.0"),
    }
    rows = t.read("events").select(
        "event_id",
        F.explode(F.array(*[F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in members.items()])).alias("m"),
    ).select(F.concat(F.lit("obs/"), "event_id", F.lit("/"), "m.name").alias("source"), "m.value")
    return files.observation_folders(rows).select("folder", "process", "nextflow_process_index", "started", "completed", "violation")


@query("k01_bed_export", """SELECT contig_idx, contig || chr(9) || "start" || chr(9) || "end" AS value FROM uall JOIN contigs USING (contig)""")
def bed_export(t):
    rows = iv.union(t.intervals).join(t.contigs.select("contig", "contig_idx"), "contig")
    return sinks.bed_lines(rows).select("contig_idx", "value")


@query("k02_interval_list", """SELECT contig, "start", "end", name FROM (SELECT contig, "start", "start" + q AS "end", rid AS name FROM li)""")
def interval_list(t):
    """Half-open rows to 1-based closed text and back."""
    rows = t.lines.join(t.contigs.select("contig", "contig_idx"), "contig").select(
        "contig", "contig_idx", "start", (F.col("start") + F.col("q")).alias("end"), F.col("rid").alias("name")
    )
    text = sinks.interval_list_lines(rows)
    return bed.parse_interval_list(as_lines(text, F.col("value"), F.col("start"), "x.interval_list")).select("contig", "start", "end", "name")


@query("k03_variant_text", """
SELECT concat_ws(chr(9), contig, pos, '.', ref, alt, '.', "filter", '.', 'GT', gt) AS value FROM vreason WHERE reason IS NULL
""")
def variant_text(t):
    from ..operators import variants

    rows = variants.included(variants.split_alleles(t.variants)).join(t.contigs.select("contig", "contig_idx"), "contig")
    return sinks.variant_lines(rows).select("value")


@query("k04_metric_rows", """
SELECT grp, tp_query, fp, CASE WHEN tp_query + fp > 0 THEN CAST(tp_query AS DOUBLE) / (tp_query + fp) END AS "precision",
       CASE WHEN tp_query + fp = 0 THEN '{"precision":"zero_query_denominator","f1":"undefined_precision_or_recall"}' ELSE '{}' END AS missing_reasons
FROM (SELECT o_custkey AS grp, count(*) FILTER (o_orderkey % 3 = 0) AS tp_query, count(*) FILTER (o_orderkey % 3 = 1) AS fp, count(*) AS fn FROM orders GROUP BY 1)
""")
def metric_rows(t):
    counts = t.read("orders").groupBy(F.col("o_custkey").alias("grp")).agg(
        F.count_if(_key() % 3 == 0).alias("tp_query"), F.count_if(_key() % 3 == 0).alias("tp_truth"),
        F.count_if(_key() % 3 == 1).alias("fp"), F.count(F.lit(1)).alias("fn"),
    )
    return sinks.metric_rows(matching.metrics(counts)).select("grp", "tp_query", "fp", "precision", "missing_reasons")


@query("k06_publish", """
SELECT step, outcome, n FROM (SELECT count(*) AS n FROM orders), (VALUES ('first', 'published'), ('again', 'unchanged'), ('other', 'refused'), ('stored', 'unchanged')) v(step, outcome)
""")
def publish(t):
    """Publish a table, publish it again, try to put another one there, and read back what is stored."""
    import uuid

    from ..session import shared_folder

    root = f"{shared_folder(t.spark)}/publish-{uuid.uuid4().hex}"
    rows = t.declared_files

    def attempt(df):
        try:
            return sinks.publish(df, root)
        except ValueError:
            return "refused"

    other = rows.withColumn("bytes", F.when(_key() == 1, F.col("bytes") + 1).otherwise(F.col("bytes")))
    outcomes = [("first", attempt(rows)), ("again", attempt(rows)), ("other", attempt(other)), ("stored", attempt(rows))]
    stored = t.spark.read.parquet(f"{root}/data").agg(F.count(F.lit(1)).alias("n"))
    return t.spark.createDataFrame(outcomes, "step string, outcome string").join(stored)


@query("k07_record_hash", """
SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS digest FROM orders
""")
def record_hash(t):
    return t.read("orders").select("o_orderkey", canonical_hash("o_orderstatus", "o_orderkey", "o_custkey").alias("digest"))


@query("p17_single_sample", """
SELECT o_orderkey, o_orderkey % 7 = 0 AS wrong FROM orders
""")
def single_sample(t):
    """Header columns of many call sets: exactly the expected sample."""
    columns = F.concat_ws(
        "\t", F.lit("#CHROM"), *[F.lit(x) for x in ("POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")],
        F.concat(F.lit("s"), "o_orderkey"), F.when(_key() % 7 == 0, "second"),
    )
    names = vcf.sample_names(as_lines(t.read("orders"), columns, F.lit(1), F.col("o_orderkey").cast("string")))
    key = F.col("source").cast("bigint")
    return names.select(key.alias("o_orderkey"), (F.col("samples") != F.array(F.concat(F.lit("s"), "source"))).alias("wrong"))
