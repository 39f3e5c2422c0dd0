"""What the projected queries share: how often inputs are read and what is hashed before a shuffle."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from locusframe.catalog.adapters import Tables
from locusframe.catalog.variant_queries import SPAN, _partitions, left_alignment
from locusframe.operators import intervals, matching, variants
from locusframe.operators import reads as reads_op
from locusframe.operators import traces
from locusframe.plans import coverage
from locusframe.sources.fasta import chunks, windows

KEY = "contig string, pos long, ref string, alt string, alt_copies int"


@pytest.fixture
def plain(spark):
    """Plans as they are first made, without broadcasts."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for name, value in kept.items():
        spark.conf.set(name, value)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, path, items, schema):
    spark.createDataFrame(items, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_lines_of_a_chunk_are_one_row(spark, tmp_path):
    keys = [*range(0, 128), *range(130, 192), 200, 64 * 9 + 63]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    t = Tables(spark, str(tmp_path))
    columns = ("contig", "chunk_id", "chunk_start", "bases", "ahead")
    assert rows(t.chunks, *columns) == rows(chunks(t.sequence), *columns)
    assert t.long_lines.filter("length(bases) = 512").count() == 2 * 22 and t.long_lines.count() == (2 + 64) * 22


def test_restricted_variants_are_made_once(plain, tmp_path):
    items = [("a", p, "A", "C", c) for p in (1, 5, 9, 200_000) for c in (1, 2)]
    calls = table(plain, tmp_path / "calls", [*items, ("a", None, "A", "C", 1), (None, 5, "A", "C", 1)], KEY)
    region = table(plain, tmp_path / "region", [("a", 3, 8), ("a", 199_000, 200_001)], "contig string, start long, end long")
    found = matching.restrict(calls.distinct(), region, region)
    assert rows(found, "contig", "pos", "alt_copies") == [("a", 5, 1), ("a", 5, 2), ("a", 200_000, 1), ("a", 200_000, 2)]
    assert plan(found).count("/calls]") == 1


def test_covered_points_shuffle_positions_once(plain):
    points = plain.createDataFrame([("a", 1), ("a", 70_000), ("a", 200_000), ("b", 3)], "contig string, pos long")
    side = plain.createDataFrame([("a", 0, 300_000), ("a", 70_000, 70_001)], "contig string, start long, end long")
    found = intervals.covered_points(points, [side])
    assert rows(found, "contig", "pos") == [("a", 1), ("a", 70_000), ("a", 200_000)]
    assert sum("Exchange hashpartitioning(contig" in x and ", pos#" in x for x in plan(found).split("\n")) == 1


def test_chunks_are_made_once_for_short_and_long_sites(plain, tmp_path):
    text = "".join("ACGT"[i * i % 7 % 4] for i in range(300))
    lines = table(plain, tmp_path / "lines", [("m", i, text[i : i + 60]) for i in range(0, 300, 60)], "contig string, start long, bases string")
    sites = plain.createDataFrame([("s", "m", 10, 30), ("l", "m", 5, 290), ("off", "x", 0, 4)], "id string, contig string, start long, end long")
    seen = windows(sites, chunks(lines, 64), "id", 64, how="left")
    assert dict(rows(seen, "id", "window")) == {"s": text[10:30], "l": text[5:290], "off": None}
    assert plan(seen).count("/lines]") == 1


def test_alleles_hash_no_reference_before_lines_are_merged(plain, tmp_path):
    lines = [(1, 2, 3, 1, 5.0, "A", "O"), (1, 2, 3, 7, 5.0, "A", "F")]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    plain.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    calls = variants.included(variants.split_alleles(Tables(plain, str(tmp_path)).variants))
    assert calls.count() == 3
    told = [x for x in plan(calls).split("\n") if "Filter " in x and ("sha2(" in x or "split(" in x)]
    assert told == []


def test_calls_and_truth_of_one_table_are_split_once(plain, tmp_path):
    lines = [(k, k % 8, k % 7, k % 7 + 1, 5.0, "ANR"[k % 3], "OF"[k % 2]) for k in range(64)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    plain.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = _partitions(Tables(plain, str(tmp_path)))
    assert sum("Generate posexplode(alts" in x for x in plan(found).split("\n")) == 1


def test_domain_coverage_deals_words_not_runs(plain, tmp_path):
    """A read of many runs of good quality is one row per 32 bases; depth is that of the runs."""
    good = "".join("I" if i * i % 5 else "#" for i in range(100))
    reads = [
        ("f", 0, "m", 20, "100M", good), ("f", 0, "m", 70, "3S40M2D57M", good), ("g", 16, "m", 31, "10M5I60M300N25M", good), ("g", 4, "m", 0, "50M", good),
        ("h", 0, "m", 0, "70M", "I" * 40), ("h", 0, "m", 2, "0M5M", "5" * 5), ("h", 0, "n", 2, "*", "*"), ("i", 0, "m", 90, "5M", None), *[(f"p{i}", 0, "m", 64, "32M", "I" * 32) for i in range(40)],
    ]
    aligned = table(plain, tmp_path / "reads", [("r", *r[:4], 60, *r[4:]) for r in reads], "rid string, qname string, flag int, contig string, start long, mapq int, cigar string, qual string")
    domain = plain.createDataFrame([("m", 0, 33), ("m", 10, 15), ("m", 64, 300), ("m", 400, 450), ("n", 5, 100), ("n", 7, 7), (None, 1, 9)], "contig string, start long, end long")
    for keys in (None, ["contig"]):
        found = coverage.domain_coverage(aligned, domain, keys)
        assert found.columns == reads_op.depth_summary(coverage.domain_depth(aligned, domain), keys).columns
        assert rows(found, *found.columns) == rows(reads_op.depth_summary(coverage.domain_depth(aligned, domain), keys), *found.columns)
    assert reads_op.fragment_words(aligned).filter("qname = 'f'").count() <= 6
    empty = coverage.domain_coverage(aligned, domain.filter("false")).first()
    assert empty.bases is None and empty.depth_sum is None
    assert "Window" not in plan(found)


def test_indels_meet_the_reference_once(plain, tmp_path):
    """Short records are made once for their reference; the indels are those of all records aligned by themselves."""
    lines = [(k, k % 8, k % 7, k % 7 + 1, 5.0, "ANR"[k % 3], "OF"[k % 2]) for k in range(64)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    plain.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain.createDataFrame([(k,) for k in range(64)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    t = Tables(plain, str(tmp_path))
    found = left_alignment(t)
    split = variants.split_alleles(variants.check_reference(t.variants, t.chunks, "row_id").filter("ref_ok").drop("ref_ok"))
    want = variants.left_align(split.filter("length(ref) <> length(alt)"), t.chunks, "row_id")
    columns = ("row_id", "contig", "pos", "ref", "alt")
    assert rows(found, *columns) == rows(want, *columns) and found.count() > 5
    one = variants.check_reference(t.variants, t.chunks, "row_id", max_span=SPAN)
    assert rows(one, "row_id", "ref_ok") == rows(variants.check_reference(t.variants, t.chunks, "row_id"), "row_id", "ref_ok")
    assert plan(one).count("ReadSchema: struct<l_orderkey") == 1


def test_words_restrict_like_a_sweep(spark):
    """Bits of 32 bases say what the sweep says, at the borders of words too, and count the same bases."""
    edges = [0, 1, 31, 32, 33, 63, 64, 65, 96, 130, 131, 200]
    left = spark.createDataFrame([("a", x, y) for x, y in zip(edges[::2], edges[1::2])] + [("a", 40, 40), ("b", 0, 500), (None, 1, 5)], "contig string, start long, end long")
    right = spark.createDataFrame([("a", 0, 63), ("a", 5, 20), ("a", 64, 190), ("b", 3, 4), ("b", 3, 4)], "contig string, start long, end long")
    points = [("a", p) for p in range(1, 210)] + [("b", 4), ("b", 5), ("c", 4), ("a", None), (None, 3)]
    calls = spark.createDataFrame([(c, p, "A", "C", 1) for c, p in points], KEY)
    found = matching.restrict(calls, left, right)
    swept = intervals.covered_points(calls.selectExpr("contig", "pos - 1 as pos"), [left, right]).selectExpr("contig", "pos + 1 as pos")
    assert rows(found, "contig", "pos") == rows(swept, "contig", "pos")
    bases = intervals.covered_words([left, right]).selectExpr("sum(bit_count(inside)) as n").first().n
    assert bases == intervals.intersect(left, right).selectExpr("sum(`end` - start) as n").first().n


def test_cases_are_dealt_by_their_number(spark, monkeypatch):
    """The rows a task sorts do not grow with the cases, and no baseline is broadcast."""
    monkeypatch.setattr(traces, "DEALT_ROWS", 10)
    cases = spark.createDataFrame(
        [(s, c, "B" if c == "x" else "A", "A", "k" + c if c == "x" else "k", c == "unchanged") for s in range(40) for c in ("first", "unchanged", "x")] + [(99, "x", "B", "A", "k", False)],
        "suite long, case string, x string, y string, key string, hit boolean",
    )
    found = traces.cache_matrix(cases, ["x", "y"])
    assert rows(found.filter("violation is not null"), "suite", "case", "violation") == [(99, "x", "no_baseline")]
    assert traces.single_dimension_cases(cases, ["x", "y"]).count() == 40
    assert plan(found).count("hashpartitioning(suite#") == 2 and ", 13)" in plan(found) and "SortMergeJoin" in plan(found)
    assert traces.cache_matrix(cases.filter("false"), ["x", "y"]).count() == 0


def _reference(spark, path):
    keys = [*range(0, 128), *range(130, 192), 200, 64 * 9 + 63]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(str(path / "orders.parquet"))
    return Tables(spark, str(path))


def test_near_chunks_are_chunks_with_less_ahead(plain, tmp_path):
    """The text of the near chunks is spelt out after the one shuffle of their keys, and joins take it from there."""
    t = _reference(plain, tmp_path)
    columns = ("contig", "chunk_id", "chunk_start", "bases")
    for bases in (SPAN, 64, 512):
        found = t.near_chunks(bases)
        assert rows(found, *columns) == rows(t.chunks, *columns)
        both = found.select("contig", "chunk_id", "ahead").join(t.chunks.selectExpr("contig", "chunk_id", "ahead as whole"), ["contig", "chunk_id"])
        assert both.filter("not startswith(whole, ahead)").count() == 0
        # no line is absent behind the first chunk
        assert both.filter("chunk_id = 0").selectExpr("min(length(ahead))", "max(length(ahead))").first() == (-(-bases // 8) * 8,) * 2
    sites = plain.createDataFrame([("s", "chr1", 500, 560)], "id string, contig string, start long, end long")
    seen = windows(sites, t.near_chunks(SPAN), "id", max_span=SPAN)
    assert rows(seen, "window") == rows(windows(sites, t.chunks, "id"), "window")
    assert plan(seen).count("Exchange hashpartitioning(contig") == 2
    long = plain.createDataFrame([("s", "chr1", 500, 600)], "id string, contig string, start long, end long")
    with pytest.raises(Exception, match="longer than max_span"):
        windows(long, t.near_chunks(SPAN), "id", max_span=SPAN).collect()


def test_normalised_rows_are_written_narrow(spark, tmp_path, monkeypatch):
    """Only the columns of the result are written, of included alleles only, and rows read again keep their alleles."""
    from locusframe.plans import benchmark

    text = "CG" + "A" * 300 + "TTGCA" * 60
    lines = spark.createDataFrame([("m", i, text[i : i + 50]) for i in range(0, len(text), 50)], "contig string, start long, bases string")
    table = chunks(lines)
    calls = [("far", 302, "A", ["AA"], "0/1"), ("near", 10, "A", ["AA", "T"], "1/2"), ("snv", 304, "T", ["G"], "1|1"), ("none", 20, "A", ["C"], "0/0"), ("dot", 20, "A", ["C"], "./1")]
    records = spark.createDataFrame([(i, "m", *c, "unread") for i, *c in calls], "row_id string, contig string, pos long, ref string, alts array<string>, gt string, more string")
    kept = []
    write = variants.written
    monkeypatch.setattr(variants, "written", lambda df, name: kept.append(write(df, name)) or kept[-1])
    found = benchmark.normalize(records, table, max_span=SPAN, columns=["row_id", *matching.KEY])
    want = [("far", 2, "G", "GA", 1), ("near", 2, "G", "GA", 1), ("near", 10, "A", "T", 1), ("snv", 304, "T", "G", 2)]
    assert rows(found, "row_id", "pos", "ref", "alt", "alt_copies") == want
    assert [k.count() for k in kept] == [4, 1] and all(k.columns == ["row_id", *matching.KEY, "_full", "_row"] for k in kept)


def test_duplicates_are_named_once(plain, tmp_path):
    """The names of duplicates are written; neither pass over the reads looks for them again, and marks stay the same."""
    lines = [(k, p, s, n, 30.0, "ANR"[k % 3], "O") for k in range(40) for p, s, n in ((3, 1, 1), (3, 1, 3), (11, 1, 5), (4, 2, 2))]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"
    plain.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain.createDataFrame([(k,) for k in range(64)], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    t = Tables(plain, str(tmp_path))
    single = t.alignments.withColumn("qname", F.col("rid"))
    sites = plain.createDataFrame([("chr1", 20), ("chr1", 515)], "contig string, pos long")
    ready = coverage.prepare_reads([single], t.near_chunks(64), sites, max_span=64)
    assert "keys=[library" not in plan(ready)
    far = coverage.prepare_reads([single], t.chunks, sites, max_span=512)
    assert rows(ready, "rid", "flag", "qual", "oq") == rows(far, "rid", "flag", "qual", "oq")
    named = reads_op.duplicate_fragments(single)
    marked = reads_op.mark_duplicates(single).filter("duplicate")
    assert rows(marked, "rid") == rows(named, "qname") and 40 <= named.count() < 120
