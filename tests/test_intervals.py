import random

import pytest
from conftest import rows

from locusframe.operators import intervals as iv
from locusframe.operators.ordered import Running, following, previous, running
from locusframe.plans import domains

BED = "contig string, start long, end long"
CONTIGS = "contig string, contig_idx long, length long"


def bed(spark, *items):
    return spark.createDataFrame(list(items), BED)


def bases(items):
    return {(c, p) for c, s, e in items for p in range(s, e)}


def test_touching_intervals_merge(spark):
    assert rows(iv.union(bed(spark, ("chr1", 1, 4), ("chr1", 4, 7))), "contig", "start", "end") == [("chr1", 1, 7)]


def test_touching_intersection_is_empty(spark):
    assert iv.intersect(bed(spark, ("chr1", 0, 5)), bed(spark, ("chr1", 5, 8))).isEmpty()


def test_domain_and_confidence(spark):
    got = iv.intersect(bed(spark, ("c", 0, 500)), bed(spark, ("c", 0, 350)))
    assert rows(got, "contig", "start", "end") == [("c", 0, 350)]


@pytest.mark.parametrize("width", [4, 16, 1000])
def test_sweep_equals_sets_of_bases(spark, width):
    """Skewed random sets, tiles far smaller than the intervals, against brute force."""
    rng = random.Random(width)
    sides = []
    for _ in range(2):
        items = [("hot", s, s + rng.randint(1, 30)) for s in (rng.randint(0, 200) for _ in range(60))]
        items += [("cold", s, s + 3) for s in (rng.randint(0, 50) for _ in range(5))] + [("hot", 5, 9)] * 20
        sides.append(items)
    a, b = (bed(spark, *s) for s in sides)
    for op, want in (
        (iv.intersect, bases(sides[0]) & bases(sides[1])),
        (iv.subtract, bases(sides[0]) - bases(sides[1])),
    ):
        got = rows(op(a, b, width=width), "contig", "start", "end")
        assert bases(got) == want
        for (c1, _, e1), (c2, s2, _) in zip(got, got[1:]):
            assert c1 != c2 or e1 < s2
    assert bases(rows(iv.union(a, width=width), "contig", "start", "end")) == bases(sides[0])


def test_covered_points_need_every_side(spark):
    points = spark.createDataFrame([("c", p) for p in range(10)] + [("c", 3)] * 5, "contig string, pos long")
    got = iv.covered_points(points, [bed(spark, ("c", 2, 6)), bed(spark, ("c", 3, 9))], width=2)
    assert rows(got, "contig", "pos") == [("c", 3), ("c", 4), ("c", 5)]


def test_running_values_cross_tiles(spark):
    values = [(k, i, (i * 7) % 11 if i % 3 else None) for k in "ab" for i in range(0, 40, 2)]
    df = spark.createDataFrame(values, "k string, i long, v long")
    specs = {"s": Running("sum", "v"), "m": Running("max", "v", inclusive=False), "l": Running("last", "v")}
    got = {(r.k, r.i): (r.s, r.m, r.l) for r in running(df, ["k"], "i", specs, width=5).collect()}
    for k in "ab":
        seen = []
        for _, i, v in [x for x in values if x[0] == k]:
            known = [x for x in seen if x is not None]
            upto = known + ([v] if v is not None else [])
            assert got[(k, i)] == (sum(upto), max(known) if known else None, upto[-1] if upto else None)
            seen.append(v)
    after = {(r.k, r.i): r.n for r in following(df, ["k"], "i", "n", width=5).collect()}
    before = {(r.k, r.i): r.p.i if r.p else None for r in previous(df, ["k"], "i", ["i"], "p", width=5).collect()}
    for i in range(0, 40, 2):
        assert after[("a", i)] == (i + 2 if i < 38 else None)
        assert before[("b", i)] == (i - 2 if i else None)


def test_domain_derivation_golden(spark):
    contigs = spark.createDataFrame([("chr1", 1, 30), ("chr20", 20, 300), ("chrX", 23, 20)], CONTIGS)
    design = bed(spark, ("chr1", 1, 5), ("chr20", 150, 160), ("chrX", 1, 8))
    confidence = bed(spark, ("chr1", 3, 10), ("chr20", 155, 200))
    got = domains.derive(design, confidence, contigs)
    assert rows(got, "domain", "contig", "start", "end") == [
        ("calling", "chr1", 0, 30), ("calling", "chr20", 50, 260), ("calling", "chrX", 0, 20),
        ("evaluation", "chr1", 3, 5), ("evaluation", "chr20", 155, 160), ("holdout", "chr20", 155, 160),
    ]
    assert domains.invariant_violations(design, confidence, got, contigs).isEmpty()
    outside = got.union(spark.createDataFrame([("chr1", 20, 31, "evaluation")], BED + ", domain string"))
    broken = {r.rule for r in domains.invariant_violations(design, confidence, outside, contigs).collect()}
    assert broken == {"bounds", "evaluation_outside_confidence"}


def test_negative_padding_is_refused(spark):
    with pytest.raises(ValueError):
        iv.pad(bed(spark, ("c", 1, 2)), spark.createDataFrame([("c", 1, 9)], CONTIGS), -1)


def test_normalized_and_order_checks(spark):
    assert iv.not_normalized(bed(spark, ("c", 0, 3), ("c", 4, 6))).isEmpty()
    assert iv.not_normalized(bed(spark, ("c", 0, 3), ("c", 3, 6))).count() == 2
    lines = spark.createDataFrame(
        [("f", 1, 1, 0, 5), ("f", 2, 1, 5, 8), ("f", 3, 1, 7, 9), ("f", 4, 0, 0, 2)],
        "source string, line_no long, contig_idx long, start long, end long",
    )
    assert rows(iv.order_violations(lines), "line_no") == [(3,), (4,)]


def test_liftover_reports_every_interval(spark):
    blocks = spark.createDataFrame([("c", 0, 100, "d", 1000), ("c", 100, 200, "d", 1150)], BED + ", to_contig string, to_start long")
    named = spark.createDataFrame([("c", 10, 20, "in"), ("c", 90, 110, "gap"), ("c", 195, 215, "low"), ("c", 300, 310, "off")], BED + ", name string")
    lifted, rejected = iv.liftover(named, blocks)
    assert rows(lifted, "name", "to_contig", "to_start", "to_end", "pieces") == [("gap", "d", 1090, 1160, 2), ("in", "d", 1010, 1020, 1)]
    assert rows(rejected, "name", "reason") == [("low", "low_fraction"), ("off", "unmapped")]


@pytest.mark.parametrize("width, tiles", [(2, 2), (3, 4), (5, 4096)])
def test_running_values_over_blocks_of_tiles(spark, width, tiles):
    """Sums, maxima and last values carried over tiles and blocks of tiles, with gaps and nulls."""
    rng = random.Random(width)
    items = [(k, at, rng.randint(-5, 5), rng.choice([None, at])) for k in "ab" for at in sorted(rng.sample(range(300), 60))]
    df = spark.createDataFrame(items, "k string, at long, d long, seen long")
    specs = {"sum": Running("sum", "d"), "before": Running("sum", "d", inclusive=False), "most": Running("max", "d", inclusive=False), "last": Running("last", "seen")}
    got = {(r.k, r.at): r for r in running(df, ["k"], "at", specs, width, tiles=tiles).collect()}
    assert len(got) == len(items)
    for key in "ab":
        total, most, last = 0, None, None
        for _, at, d, seen in [i for i in items if i[0] == key]:
            last = seen if seen is not None else last
            row = got[key, at]
            assert (row.sum, row.before, row.most, row.last) == (total + d, total, most, last)
            total, most = total + d, d if most is None else max(most, d)


def test_the_sweep_reads_its_input_twice_and_joins_once(spark):
    """The plan of a union: one pass for the sums of tiles, one for the deltas, no other copy of either."""
    import os

    from locusframe.catalog.adapters import Tables

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables are not there")
    plan = iv.union(Tables(spark, folder).intervals)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Scan parquet") == 2 and plan.count("Join") == 1


def test_chains_lift_both_strands(spark):
    blocks = spark.createDataFrame(
        [(1, "c", 0, 100, "t", 1000, "+"), (1, "c", 110, 200, "t", 1150, "+"), (2, "c", 200, 300, "u", 500, "-"), (2, "c", 300, 400, "u", 390, "-"), (3, "c", 350, 450, "v", 0, "+")],
        "chain int, contig string, start long, end long, to_contig string, to_start long, strand string",
    )
    named = spark.createDataFrame(
        [("in", "c", 10, 20), ("over", "c", 90, 120), ("back", "c", 210, 230), ("turn", "c", 290, 310), ("split", "c", 190, 210), ("few", "c", 440, 500), ("none", "c", 900, 910), ("tie", "c", 360, 390)],
        "name string, contig string, start long, end long",
    )
    lifted, rejected = iv.liftover_chains(named, blocks, 0.6)
    assert rows(lifted, "name", "to_contig", "to_start", "to_end", "strand", "to_gap") == [
        ("back", "u", 570, 590, "-", 0), ("in", "t", 1010, 1020, "+", 0), ("over", "t", 1090, 1160, "+", 50), ("tie", "u", 400, 430, "-", 0), ("turn", "u", 480, 510, "-", 10),
    ]
    assert rows(rejected, "name", "reason") == [("few", "low_fraction"), ("none", "unmapped"), ("split", "split")]
