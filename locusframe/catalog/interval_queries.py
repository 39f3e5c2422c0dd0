"""Interval algebra queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators.ordered import Running, running
from ..operators.rules import set_difference
from ..plans import domains
from . import views
from .adapters import STRIDE
from .registry import query, view

view("padded", """
SELECT contig, greatest(0, "start" - 100) AS "start", least(length, "end" + 100) AS "end" FROM iva JOIN contigs USING (contig)
""")
view("calling", views.islands("padded"))
view("evaluation", """SELECT contig, "start", "end" FROM both_sides""")


@query("a01_interval_union", "SELECT * FROM uall")
def interval_union(t):
    return iv.union(t.intervals)


@query("a02_pad_and_clip", "SELECT * FROM calling")
def pad_and_clip(t):
    return iv.pad(t.left, t.contigs, 100)


@query("a03_interval_summary", """
SELECT coalesce(contig, 'total') AS contig, count(*) AS intervals, CAST(sum("end" - "start") AS BIGINT) AS bases FROM uall GROUP BY ROLLUP (contig)
""")
def interval_summary(t):
    return iv.summary(iv.union(t.intervals)).withColumn("contig", F.coalesce("contig", F.lit("total")))


@query("j01_interval_intersection", "SELECT * FROM both_sides")
def interval_intersection(t):
    return iv.intersect(t.left, t.right)


@query("j02_contig_intersection", """
SELECT contig, count(*) AS intervals, CAST(sum("end" - "start") AS BIGINT) AS bases FROM both_sides GROUP BY contig
""")
def contig_intersection(t):
    return iv.summary(iv.intersect(t.left, t.right)).filter("contig is not null")


view("outside_events", """
SELECT contig, "start" AS pos, 1 AS da, 0 AS db FROM ua UNION ALL SELECT contig, "end", -1, 0 FROM ua
UNION ALL SELECT contig, "start", 0, 1 FROM ub UNION ALL SELECT contig, "end", 0, -1 FROM ub
""")
view("outside", """
SELECT contig, pos AS "start", nxt AS "end" FROM (
  SELECT contig, pos, sum(da) OVER w AS ca, sum(db) OVER w AS cb, lead(pos) OVER w AS nxt
  FROM (SELECT contig, pos, sum(da) AS da, sum(db) AS db FROM outside_events GROUP BY contig, pos)
  WINDOW w AS (PARTITION BY contig ORDER BY pos)) WHERE ca > 0 AND cb = 0
""")


@query("j03_containment", """SELECT contig, CAST(sum("end" - "start") AS BIGINT) AS bases FROM outside GROUP BY contig""")
def containment(t):
    return iv.uncovered(t.left, t.right).groupBy("contig").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


@query("w01_running_reach", """
SELECT contig, count(*) AS starts, CAST(sum(reach) AS BIGINT) AS reach_sum FROM (
  SELECT contig, max(e) OVER (PARTITION BY contig ORDER BY "start" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM (SELECT contig, "start", max("end") AS e FROM iv GROUP BY contig, "start")) GROUP BY contig
""")
def running_reach(t):
    reach = t.intervals.groupBy("contig", "start").agg(F.max("end").alias("e"))
    seen = running(reach, ["contig"], "start", {"reach": Running("max", "e", inclusive=False)})
    return seen.groupBy("contig").agg(F.count(F.lit(1)).alias("starts"), F.sum("reach").alias("reach_sum"))


view("ordered_bed", """
SELECT o_orderkey AS line_no, 'chr' || (o_custkey % 3 + 1) AS contig, o_custkey % 3 + 1 AS contig_idx, o_orderkey * 8 AS "start",
       o_orderkey * 8 + 1 + o_custkey % 40 AS "end" FROM orders
""")


@query("w05_sorted_disjoint", """
SELECT line_no, contig, "start", "end" FROM (
  SELECT *, lag(contig_idx) OVER (ORDER BY line_no) AS pc, lag("end") OVER (ORDER BY line_no) AS pe FROM ordered_bed)
WHERE contig_idx < pc OR (contig_idx = pc AND "start" < pe)
""")
def sorted_disjoint(t):
    rows = t.read("orders").select(
        F.lit("orders.bed").alias("source"),
        F.col("o_orderkey").alias("line_no"),
        F.concat(F.lit("chr"), F.col("o_custkey") % 3 + 1).alias("contig"),
        (F.col("o_custkey") % 3 + 1).alias("contig_idx"),
        (F.col("o_orderkey") * 8).alias("start"),
        (F.col("o_orderkey") * 8 + 1 + F.col("o_custkey") % 40).alias("end"),
    )
    return iv.order_violations(rows).select("line_no", "contig", "start", "end")


@query("j12_contig_membership", """
SELECT contig, "start", "end", CASE WHEN length IS NULL THEN 'unknown_contig' ELSE 'bounds' END AS "rule"
FROM (SELECT 'chr' || (l_suppkey % 25 + 1) AS contig, l_orderkey * 8 - 3 AS "start", l_orderkey * 8 + CAST(l_quantity AS BIGINT) * 3 AS "end" FROM lineitem)
LEFT JOIN contigs USING (contig) WHERE length IS NULL OR NOT (0 <= "start" AND "start" < "end" AND "end" <= length)
""")
def contig_membership(t):
    rows = t.read("lineitem").select(
        F.concat(F.lit("chr"), F.col("l_suppkey") % 25 + 1).alias("contig"),
        (F.col("l_orderkey") * 8 - 3).alias("start"),
        (F.col("l_orderkey") * 8 + F.col("l_quantity").cast("bigint") * 3).alias("end"),
    )
    return iv.bounds_violations(rows, t.contigs)


@query("p02_contig_subset", """
SELECT contig, count(*) AS n FROM iv WHERE contig IN ('chr20', 'chr21', 'chr22') GROUP BY contig
""")
def contig_subset(t):
    return t.intervals.filter(F.col("contig").isin(domains.HOLDOUT)).groupBy("contig").agg(F.count(F.lit(1)).alias("n"))


@query("p03_coordinate_shift", """SELECT contig, "start" + 1 AS first_base, "end" AS last_base, count(*) AS n FROM iv GROUP BY ALL""")
def coordinate_shift(t):
    return t.intervals.groupBy("contig", (F.col("start") + 1).alias("first_base"), F.col("end").alias("last_base")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("o02_bed_order", """
SELECT row_number() OVER (ORDER BY contig_idx, "start", "end") AS rank, contig, "start", "end" FROM uall JOIN contigs USING (contig)
""")
def bed_order(t):
    """Rank by contig order, start and end, as a total of earlier contigs plus a tiled rank."""
    rows = iv.union(t.intervals).join(t.contigs.select("contig", "contig_idx"), "contig").withColumn("one", F.lit(1))
    ranked = running(rows, ["contig", "contig_idx"], "start", {"inside": Running("sum", "one")})
    totals = rows.groupBy("contig_idx").agg(F.count(F.lit(1)).alias("n"))
    earlier = t.contigs.select(F.col("contig_idx").alias("c")).join(totals, F.col("contig_idx") < F.col("c"), "left").groupBy("c").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("before")
    )
    return ranked.join(earlier, F.col("contig_idx") == F.col("c")).select(
        (F.col("before") + F.col("inside")).alias("rank"), "contig", "start", "end"
    )


@query("so02_set_equality", """
SELECT contig, CASE WHEN a AND NOT b THEN 'left' ELSE 'right' END AS side FROM (
  SELECT contig || ':' || "start" AS contig, bool_or(side = 'a') AS a, bool_or(side = 'b') AS b FROM iv GROUP BY 1) WHERE a <> b
""")
def set_equality(t):
    def places(df):
        return df.select(F.concat_ws(":", "contig", "start").alias("contig"))

    return set_difference(places(t.left), places(t.right), "contig")


@query("so03_subset", """
SELECT contig, "start", "end" FROM ua EXCEPT SELECT contig, "start", "end" FROM uall
""")
def subset(t):
    return iv.union(t.left).join(iv.union(t.intervals), ["contig", "start", "end"], "left_anti")


view("liftblocks", """
SELECT contig, o_orderkey // 16 * 128 AS bs, o_orderkey // 16 * 128 + 120 AS be, 'lift_' || contig AS tc, o_orderkey // 16 * 128 + 1000 AS ts
FROM (SELECT DISTINCT o_orderkey // 16 * 16 AS o_orderkey FROM orders) CROSS JOIN contigs
""")
view("named_iv", """SELECT rid AS name, contig, "start", "start" + q AS "end" FROM li""")
view("lifted_all", """
SELECT n.name, n.contig, n."start", n."end", sum(least(n."end", be) - greatest(n."start", bs)) AS lifted_bases,
       min(ts + greatest(n."start", bs) - bs) AS to_start, max(ts + least(n."end", be) - bs) AS to_end, count(bs) AS pieces
FROM named_iv n LEFT JOIN liftblocks b ON b.contig = n.contig AND bs < n."end" AND n."start" < be
  AND bs IN (n."start" // 128 * 128, n."start" // 128 * 128 + 128) GROUP BY 1, 2, 3, 4
""")


def _lift(t):
    first = F.floor(F.col("o_orderkey") / 16)
    keys = t.read("orders").select(first.alias("k")).distinct()
    blocks = keys.crossJoin(F.broadcast(t.contigs.select("contig"))).select(
        "contig",
        (F.col("k") * 16 * STRIDE).alias("start"),
        (F.col("k") * 16 * STRIDE + 120).alias("end"),
        F.concat(F.lit("lift_"), "contig").alias("to_contig"),
        (F.col("k") * 16 * STRIDE + 1000).alias("to_start"),
    )
    named = t.lines.select(F.col("rid").alias("name"), "contig", "start", (F.col("start") + F.col("q")).alias("end"))
    return iv.liftover(named, blocks, 0.95)


@query("j29_liftover", """
SELECT name, contig, "start", "end", to_start, to_end, CAST(lifted_bases AS BIGINT) AS lifted_bases, pieces FROM lifted_all
WHERE pieces > 0 AND lifted_bases >= 0.95 * ("end" - "start")
""")
def liftover(t):
    return _lift(t)[0].drop("to_contig")


@query("j29_liftover_rejected", """
SELECT CASE WHEN pieces = 0 THEN 'unmapped' ELSE 'low_fraction' END AS reason, count(*) AS n FROM lifted_all
WHERE pieces = 0 OR lifted_bases < 0.95 * ("end" - "start") GROUP BY 1
""")
def liftover_rejected(t):
    return _lift(t)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# chains of four blocks; every other chain runs backwards, and targets leave gaps between blocks
view("chainblocks", """
SELECT contig, bs, be, k // 4 AS chain, CASE WHEN k // 4 % 2 = 1 THEN '-' ELSE '+' END AS strand,
       k // 4 * 600 + CASE WHEN k // 4 % 2 = 1 THEN (3 - k % 4) * 133 ELSE k % 4 * 133 END AS ts FROM (SELECT *, bs // 128 AS k FROM liftblocks)
""")
view("chained", """
SELECT name, "start", "end", chain, strand, sum(hi - lo) AS bases, count(*) AS pieces, min(t) AS to_start, max(t + hi - lo) AS to_end
FROM (SELECT *, CASE WHEN strand = '-' THEN ts + be - hi ELSE ts + lo - bs END AS t FROM (
  SELECT n.*, b.*EXCLUDE (contig), greatest(n."start", bs) AS lo, least(n."end", be) AS hi FROM named_iv n JOIN chainblocks b ON b.contig = n.contig AND bs < n."end" AND n."start" < be
  AND bs IN (n."start" // 128 * 128, n."start" // 128 * 128 + 128))) GROUP BY 1, 2, 3, 4, 5
""".replace("b.*EXCLUDE (contig)", "b.bs, b.be, b.chain, b.strand, b.ts"))
view("chain_choice", """
SELECT n.name, n."start", n."end", c.chain, c.strand, c.to_start, c.to_end, c.bases, c.pieces, s.total FROM named_iv n
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY name ORDER BY bases DESC, chain) AS rn FROM chained) c ON c.name = n.name AND rn = 1
LEFT JOIN (SELECT name, sum(bases) AS total FROM chained GROUP BY name) s ON s.name = n.name
""")


def _lift_chains(t):
    named = t.lines.select(F.col("rid").alias("name"), "contig", "start", (F.col("start") + F.col("q")).alias("end"))
    k = F.floor(F.col("o_orderkey") / 16)
    back = F.floor(k / 4) % 2 == 1
    keys = t.read("orders").select(k.alias("k"), F.when(back, "-").otherwise("+").alias("strand"), (F.floor(k / 4) * 600 + F.when(back, 3 - k % 4).otherwise(k % 4) * 133).alias("to_start")).distinct()
    blocks = keys.crossJoin(F.broadcast(t.contigs.select("contig"))).select(
        F.floor(F.col("k") / 4).alias("chain"), "contig", (F.col("k") * 128).alias("start"), (F.col("k") * 128 + 120).alias("end"),
        F.concat(F.lit("lift_"), "contig").alias("to_contig"), "to_start", "strand",
    )
    return iv.liftover_chains(named, blocks, 0.9)


@query("j29_liftover_chains", """
SELECT name, "start", "end", chain, 'lift_' || (SELECT contig FROM named_iv v WHERE v.name = c.name) AS to_contig, to_start, to_end, strand, CAST(bases AS BIGINT) AS lifted_bases,
       CAST(to_end - to_start - bases AS BIGINT) AS to_gap, pieces
FROM chain_choice c WHERE bases >= 0.9 * ("end" - "start")
""".replace("'lift_' || (SELECT contig FROM named_iv v WHERE v.name = c.name)", "'lift_' || CASE WHEN CAST(split_part(name, '.', 4) AS BIGINT) % 3 = 0 THEN 'chr1' ELSE 'chr' || (CAST(split_part(name, '.', 4) AS BIGINT) % 22 + 1) END"))
def liftover_chains(t):
    """Both strands, with gaps between the blocks of a chain."""
    return _lift_chains(t)[0].drop("contig")


@query("j29_chains_rejected", """
SELECT name, CASE WHEN bases IS NULL THEN 'unmapped' WHEN total >= 0.9 * ("end" - "start") THEN 'split' ELSE 'low_fraction' END AS reason
FROM chain_choice WHERE bases IS NULL OR bases < 0.9 * ("end" - "start")
""")
def chains_rejected(t):
    return _lift_chains(t)[1].select("name", "reason")


@query("c01_domain_derivation", """
SELECT 'calling' AS "domain", contig, "start", "end" FROM calling
UNION ALL SELECT 'evaluation', contig, "start", "end" FROM evaluation
UNION ALL SELECT 'holdout', contig, "start", "end" FROM evaluation WHERE contig IN ('chr20', 'chr21', 'chr22')
""")
def domain_derivation(t):
    return domains.derive(t.left, t.right, t.contigs).select("domain", "contig", "start", "end")


@query("c01_domain_invariants", """
SELECT 'bounds' AS "rule", contig, "start", "end" FROM evaluation JOIN contigs USING (contig) WHERE "end" > length
""")
def domain_invariants(t):
    """No row comes back while design and evaluation stay inside their parents."""
    derived = domains.derive(t.left, t.right, t.contigs)
    return domains.invariant_violations(t.left, t.right, derived, t.contigs)
