"""SQL twins of the adapter views."""

from __future__ import annotations

from .registry import view

view("contigs", """
SELECT 'chr' || i AS contig, i AS contig_idx, (SELECT (max(o_orderkey) + 1) * 8 + 64 FROM orders) AS length
FROM range(1, 23) t(i)
""")
view("iv", """
SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'chr1' ELSE 'chr' || (l_suppkey % 22 + 1) END AS contig,
       l_orderkey * 8 + l_partkey % 8 AS "start",
       l_orderkey * 8 + l_partkey % 8 + CAST(l_quantity AS BIGINT) AS "end",
       CASE WHEN l_linenumber % 2 = 1 THEN 'a' ELSE 'b' END AS side
FROM lineitem
""")
view("iva", """SELECT contig, "start", "end" FROM iv WHERE side = 'a'""")
view("ivb", """SELECT contig, "start", "end" FROM iv WHERE side = 'b'""")


def islands(source: str, keys: str = "contig") -> str:
    """Union of intervals by gaps and islands over a running maximum."""
    return f"""
SELECT {keys}, min("start") AS "start", max("end") AS "end" FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR "start" > reach THEN 1 ELSE 0 END)
            OVER (PARTITION BY {keys} ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT {keys}, "start", "end", max("end") OVER (PARTITION BY {keys} ORDER BY "start", "end"
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}) x) y
GROUP BY {keys}, island"""


view("ua", islands("iva"))
view("ub", islands("ivb"))
view("uall", islands("iv"))
view("both_sides", """
SELECT a.contig, greatest(a."start", b."start") AS "start", least(a."end", b."end") AS "end"
FROM ua a JOIN ub b ON a.contig = b.contig AND a."start" < b."end" AND b."start" < a."end"
""")
view("li", """
SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 'chr1' ELSE 'chr' || (l_suppkey % 22 + 1) END AS contig,
       l_orderkey * 8 + l_partkey % 8 AS "start",
       concat_ws('.', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(min(l_quantity) AS INTEGER) AS q,
             min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus
      FROM lineitem GROUP BY ALL)
""")
view("reflines", """
SELECT contig, o_orderkey AS k, o_orderkey * 8 AS "start",
       translate(substr(sha256(contig || ':' || o_orderkey), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT') AS bases
FROM orders CROSS JOIN contigs
""")
view("refwin", """
SELECT contig, k, "start", string_agg(bases, '') OVER (PARTITION BY contig ORDER BY k
       ROWS BETWEEN CURRENT ROW AND 8 FOLLOWING) AS bases FROM reflines
""")
view("aln", """
SELECT rid, 'q' || l_orderkey AS qname,
       CAST(1 + CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END + (l_suppkey % 2) * 16
         + CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END + CASE WHEN l_linenumber = 6 THEN 256 ELSE 0 END
         + CASE WHEN l_partkey % 61 = 0 THEN 512 ELSE 0 END + CASE WHEN l_partkey % 53 = 0 THEN 1024 ELSE 0 END
         + CASE WHEN l_partkey % 59 = 0 THEN 2048 ELSE 0 END AS INTEGER) AS flag,
       contig, "start", "start" + 1 AS pos, CAST(l_partkey % 61 AS INTEGER) AS mapq, q,
       CASE WHEN q > 10 THEN l_linenumber % 4 ELSE 0 END AS shape,
       substr(translate(sha256('s' || rid), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, q) AS seq,
       substr(translate(sha256('q' || rid), '0123456789abcdef', '#(+-05:<?ABDEFGI'), 1, q) AS qual,
       l_returnflag AS library, 'rg' || l_returnflag AS read_group, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM li
""")
view("blk", """
SELECT a.*, b.s AS bs, b.e AS be, b.qo FROM (
  SELECT *, CASE shape
    WHEN 1 THEN [{'s': "start", 'e': "start" + q - 3, 'qo': 3}]
    WHEN 2 THEN [{'s': "start", 'e': "start" + 5, 'qo': 0}, {'s': "start" + 7, 'e': "start" + 7 + q - 5, 'qo': 5}]
    WHEN 3 THEN [{'s': "start", 'e': "start" + 4, 'qo': 0}, {'s': "start" + 4, 'e': "start" + 4 + q - 5, 'qo': 5}]
    ELSE [{'s': "start", 'e': "start" + q, 'qo': 0}] END AS bl FROM aln) a, unnest(a.bl) AS u(b)
""")
view("basecell", """
SELECT rid, qname, flag, mapq, contig, library, read_group, q, bs + i AS p, qo + i AS o,
       substr(seq, CAST(qo + i + 1 AS INTEGER), 1) AS base, ascii(substr(qual, CAST(qo + i + 1 AS INTEGER), 1)) - 33 AS bq, seq
FROM (SELECT *, unnest(range(be - bs)) AS i FROM blk)
""")
view("vraw", """
SELECT rid AS row_id, contig, "start" + 1 AS pos, ref,
       CASE WHEN length(ref) = 2 THEN [substr(ref, 1, 1)] WHEN l_linenumber = 6 THEN [ref || ref]
            WHEN l_linenumber = 7 THEN [translate(ref, 'ACGT', 'CGTA'), translate(ref, 'ACGT', 'TACG')]
            ELSE [translate(ref, 'ACGT', 'CGTA')] END AS alts,
       CASE WHEN l_linenumber = 7 AND length(ref) = 1 AND l_returnflag = 'A' THEN '1/2'
            WHEN l_returnflag = 'A' THEN '0/1' WHEN l_returnflag = 'N' THEN '1/1'
            WHEN l_partkey % 5 = 0 THEN './1' WHEN l_partkey % 5 = 1 THEN '0/0' WHEN l_partkey % 5 = 2 THEN '1'
            WHEN l_partkey % 5 = 3 THEN '1|0' ELSE '0/1' END AS gt,
       CASE WHEN l_linenumber % 3 = 0 THEN 'PASS' WHEN l_linenumber % 3 = 1 THEN '.' ELSE 'LowQual' END AS "filter",
       (l_linestatus = 'O' OR l_suppkey % 2 = 0) AS is_query, (l_linestatus = 'F' OR l_suppkey % 2 = 0) AS is_truth,
       l_partkey, l_suppkey, l_orderkey, l_linenumber
FROM (SELECT *, CASE WHEN l_partkey % 97 = 0 THEN translate(substr(line, CAST(l_partkey % 8 + 1 AS INTEGER), 1), 'ACGT', 'GTAC')
                     WHEN l_linenumber = 5 THEN substr(line, CAST(l_partkey % 8 + 1 AS INTEGER), 2)
                     ELSE substr(line, CAST(l_partkey % 8 + 1 AS INTEGER), 1) END AS ref
      FROM (SELECT *, translate(substr(sha256(contig || ':' || l_orderkey), 1, 8), '0123456789abcdef', 'ACGTACGTACGTACGT') AS line FROM li))
""")
view("vsplit", """
SELECT row_id, contig, pos, ref, alt, is_query, is_truth, "filter", original,
       CASE WHEN original IS NULL THEN gt
            WHEN contains(gt, '|') THEN array_to_string(list_transform(string_split_regex(gt, '[/|]'), lambda a: CASE WHEN a = '.' THEN a WHEN a = CAST(i AS VARCHAR) THEN '1' ELSE '0' END), '|')
            ELSE array_to_string(list_transform(string_split_regex(gt, '[/|]'), lambda a: CASE WHEN a = '.' THEN a WHEN a = CAST(i AS VARCHAR) THEN '1' ELSE '0' END), '/') END AS gt
FROM (SELECT *, CASE WHEN len(alts) > 1 THEN concat_ws('|', contig, pos, ref, array_to_string(alts, ',')) END AS original,
             unnest(alts) AS alt, unnest(range(1, len(alts) + 1)) AS i FROM vraw)
""")
view("vreason", """
SELECT *, CASE WHEN list_contains(string_split_regex(gt, '[/|]'), '.') THEN 'missing_genotype'
               WHEN len(string_split_regex(gt, '[/|]')) <> 2 THEN 'non_diploid'
               WHEN len(list_filter(string_split_regex(gt, '[/|]'), lambda a: a <> '0')) = 0 THEN 'reference_genotype' END AS reason,
       len(list_filter(string_split_regex(gt, '[/|]'), lambda a: a = '1')) AS alt_copies
FROM vsplit
""")
view("vq", "SELECT DISTINCT contig, pos, ref, alt, alt_copies FROM vreason WHERE reason IS NULL AND is_query")
view("vt", "SELECT DISTINCT contig, pos, ref, alt, alt_copies FROM vreason WHERE reason IS NULL AND is_truth")
view("region", """
SELECT r."start" AS rs, r."end" AS re, r.contig AS rc FROM both_sides r
""")
view("vqr", "SELECT v.* FROM vq v WHERE EXISTS (SELECT 1 FROM region WHERE rc = contig AND rs <= pos - 1 AND pos - 1 < re)")
view("vtr", "SELECT v.* FROM vt v WHERE EXISTS (SELECT 1 FROM region WHERE rc = contig AND rs <= pos - 1 AND pos - 1 < re)")
view("parts", """
SELECT contig, pos, ref, alt, alt_copies, unnest(CASE WHEN q AND t THEN ['tp', 'tp_baseline'] WHEN q THEN ['fp'] ELSE ['fn'] END) AS part
FROM (SELECT contig, pos, ref, alt, alt_copies, bool_or(q) AS q, bool_or(t) AS t FROM (
  SELECT *, true AS q, false AS t FROM vqr UNION ALL SELECT *, false, true FROM vtr) GROUP BY ALL)
""".replace("GROUP BY ALL", "GROUP BY contig, pos, ref, alt, alt_copies"))
view("classes", """
SELECT variant_class, coalesce(tp_query, 0) AS tp_query, coalesce(tp_truth, 0) AS tp_truth, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn
FROM (VALUES ('SNP'), ('INDEL'), ('OTHER')) c(variant_class) LEFT JOIN (
  SELECT CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' WHEN length(ref) <> length(alt) THEN 'INDEL' ELSE 'OTHER' END AS variant_class,
         count(*) FILTER (part = 'tp') AS tp_query, count(*) FILTER (part = 'tp_baseline') AS tp_truth,
         count(*) FILTER (part = 'fp') AS fp, count(*) FILTER (part = 'fn') AS fn
  FROM parts GROUP BY 1) USING (variant_class)
""")
view("tk", """
SELECT event_id + 1 AS task_id, upper(event_type) AS process,
       CASE WHEN event_type IN ('view', 'click') THEN 'shared' WHEN event_type = 'error' THEN 'caller_a'
            WHEN event_type = 'purchase' THEN 'caller_b' ELSE 'common' END AS grp,
       user_id, user_id % 5 = 0 AS cached,
       CASE WHEN user_id % 5 = 0 THEN 'CACHED' WHEN event_id % 31 = 0 THEN 'FAILED' WHEN event_id % 37 = 0 THEN 'ABORTED' ELSE 'COMPLETED' END AS status,
       epoch_us(ts) - event_id % 50 * 1000 AS submit_us, epoch_us(ts) AS start_us,
       epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) * 1000 AS end_us,
       CASE WHEN event_id % 211 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS cpu_cs,
       CAST(round(value * 1000) AS BIGINT) AS duration_ms,
       CASE WHEN NOT (event_id % 7 = 0 AND event_type IN ('error', 'click')) THEN CAST(round(value * 1000) AS BIGINT) - CAST(round(value * 1000) AS BIGINT) % 7 END AS realtime_ms,
       100 + (event_id % 300) * 2 + 1 AS cpu_halves,
       1000000 + event_id * 17 % 900000 AS peak_rss,
       CASE WHEN event_type <> 'view' THEN 2000000 + event_id % 1000 END AS peak_vmem, event_id
FROM events
""")
view("fa", """
SELECT 'data/' || o_orderkey || '.bin' AS path, sha256(o_orderstatus || CAST(round(o_totalprice * 100) AS BIGINT)) AS sha256,
       CAST(round(o_totalprice * 100) AS BIGINT) AS bytes, o_orderkey FROM orders
""")
view("fb", """
SELECT d || o_orderkey || '.bin' AS path, CASE WHEN o_orderkey % 17 = 0 THEN sha256(sha256 || 'x') ELSE sha256 END AS sha256, bytes, o_orderkey
FROM (SELECT *, unnest(CASE WHEN o_orderkey % 13 = 0 THEN ['extra/'] WHEN o_orderkey % 19 = 0 THEN ['data/', 'extra/'] ELSE ['data/'] END) AS d FROM fa)
""")
view("fdiff", """
SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'unexpected'
       WHEN a.sha256 = b.sha256 AND a.bytes = b.bytes THEN 'same' ELSE 'changed' END AS status
FROM fa a FULL OUTER JOIN fb b ON a.path = b.path
""")
view("edges", """
SELECT o_orderkey AS src, unnest(CASE WHEN o_orderkey = 1 THEN [0, 5] ELSE [o_orderkey // 2] END) AS dst FROM orders WHERE o_orderkey > 0
""")
