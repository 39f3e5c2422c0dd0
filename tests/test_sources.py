import gzip
import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from locusframe.functions import text
from locusframe.operators import reads as rd
from locusframe.operators.skew import salted_join
from locusframe.sources import bed, documents, fasta, files, gtf, lines, sam, sinks, vcf


def test_line_numbers_survive_file_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(1, 4001)))
    with gzip.open(tmp_path / "b.txt.gz", "wt") as out:
        out.write("x\ny\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = lines.read_lines(spark, str(tmp_path))
        wrong = got.filter(F.col("source").endswith("a.txt") & (F.col("value") != F.concat(F.lit("line "), "line_no")))
        assert got.count() == 4002 and wrong.isEmpty()
        assert rows(got.filter("source like '%gz'"), "line_no", "value") == [(1, "x"), (2, "y")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bed_faults_are_named(spark):
    contigs = spark.createDataFrame([("c", 1, 500)], "contig string, contig_idx long, length long")
    text = ["c\t0\t5", "c\t-1\t5", "c\t1\t501", "d\t1\t2", "c\t1\tx", "c\t1"]
    table = spark.createDataFrame([("f", i + 1, t) for i, t in enumerate(text)], "source string, line_no long, value string")
    assert rows(lines.bad(bed.parse_bed3(table, contigs)), "line_no", "rule") == [
        (2, "bounds"), (3, "bounds"), (4, "unknown_contig"), (5, "integer"), (6, "column_count"),
    ]


def test_coding_selection_golden(spark):
    contigs = spark.createDataFrame([("chr1", 1, 30)], "contig string, contig_idx long, length long")
    both = 'gene_type "protein_coding"; transcript_type "protein_coding";'
    text = [f"chr1\ts\tCDS\t2\t5\t.\t+\t0\t{both}", f"chr1\ts\tstop_codon\t6\t8\t.\t+\t0\t{both}", f"chr1\ts\tUTR\t9\t12\t.\t+\t0\t{both}", 'chr1\ts\tCDS\t15\t18\t.\t+\t0\tgene_type "lncRNA"; transcript_type "lncRNA";']
    table = spark.createDataFrame([("f", i, t) for i, t in enumerate(text)], "source string, line_no long, value string")
    from locusframe.operators import intervals

    kept = lines.good(gtf.coding_features(gtf.parse_gtf(table), contigs))
    assert rows(intervals.union(kept), "contig", "start", "end") == [("chr1", 1, 8)]


def test_windows_cross_chunks_and_lost_ends(spark):
    text = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(400))
    table = fasta.chunks(spark.createDataFrame([("c", i, text[i : i + 50]) for i in range(0, 400, 50)], "contig string, start long, bases string"), 64)
    spans = [(0, 5), (60, 70), (63, 64), (10, 200), (390, 450), (-5, 3)]
    sites = spark.createDataFrame([(str(i), "c", s, e) for i, (s, e) in enumerate(spans)], "site string, contig string, start long, end long")
    want = [(str(i), text[max(s, 0) : e]) for i, (s, e) in enumerate(spans)]
    for piled in (False, True):
        assert rows(fasta.windows(sites, table, "site", 64, piled=piled), "site", "window") == want
    assert rows(fasta.contig_md5(table), "length", "md5") == [(400, hashlib.md5(text.encode()).hexdigest())]


def test_publish_is_idempotent_and_detects_change(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    root = str(tmp_path / "out")
    assert sinks.publish(df, root) == "published"
    assert sinks.publish(df, root) == "unchanged"
    with pytest.raises(ValueError):
        sinks.publish(df.withColumn("v", F.col("v") + 1), root)
    assert files.file_inventory(spark, root + "/data").count() > 0


def test_salted_join_keeps_every_row_of_a_hot_key(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), ("gone", 2)], "k string, i long")
    right = spark.createDataFrame([("hot", 7), ("cold", 8)], "k string, w long")
    inner = salted_join(left, right, ["k"], "inner", hot_rows=20)
    assert inner.count() == 501 and inner.filter("k = 'hot'").select("i").distinct().count() == 500
    assert salted_join(left, right, ["k"], "left", hot_rows=20).filter("w is null").count() == 1


def test_coverage_summary_golden(spark):
    spans = spark.createDataFrame([("c", i, i + 1, d) for i, d in enumerate([0, 1, 10, 20, 30, 39])], "contig string, start long, end long, depth long")
    r = rd.depth_summary(spans).first()
    assert (r.bases, r.bases_ge_1, r.bases_ge_10, r.bases_ge_20, r.bases_ge_30, r.depth_sum, r.mean_depth) == (6, 5, 4, 3, 2, 100, 100 / 6)


def test_pairs_are_marked_by_fragment_ends(spark):
    def pair(q, start, score):
        return [
            (f"{q}/1", q, "lib", 99, "c", start, "10M", chr(33 + score) * 10), (f"{q}/2", q, "lib", 147, "c", start + 50, "10M", chr(33 + score) * 10),
        ]

    data = pair("a", 100, 30) + pair("b", 100, 35) + pair("c", 101, 20)
    reads = spark.createDataFrame(data, "rid string, qname string, library string, flag int, contig string, start long, cigar string, qual string")
    assert rows(rd.mark_duplicates(reads).filter("duplicate"), "rid") == [("a/1",), ("a/2",)]


def test_mates_count_once_across_tiles(spark):
    pieces = spark.createDataFrame([("c", "q", 0, 10), ("c", "q", 5, 18), ("c", "r", 5, 6)], "contig string, qname string, start long, end long")
    domain = spark.createDataFrame([("c", 0, 20)], "contig string, start long, end long")
    spans = rd.depth_over(rd.once_per_fragment(pieces, width=4), domain)
    depth = {r.pos: r.depth for r in rd.depth_rows(spans).collect()}
    assert depth == {p + 1: (2 if p == 5 else 1 if p < 18 else 0) for p in range(20)}


def test_text_grammars(spark):
    line = spark.createDataFrame([("x --all-records --ref-overlap --k2 v --o=a=b", '{"password": {"b": [{"Api_Key": 1}]}, "t": "a \\"secret\\": /srv/x", "/srv": "/srvs"}')], "c string, j string")
    got = line.select(text.command_flags(F.col("c")).alias("f"), text.json_key_names(F.col("j")).alias("k"), text.replace_roots(F.col("j"), {"/srv": "$R"}).alias("r")).first()
    assert got.f == {"all-records": None, "ref-overlap": None, "k2": "v", "o": "a=b"}
    assert got.k == ["password", "b", "Api_Key", "t", "/srv"]
    assert got.r.endswith('$R/x", "/srv": "/srvs"}')


def test_flags_split_their_command_once(spark):
    """The text is split once, whatever the number of words; a repeated flag has no map."""
    lines = spark.createDataFrame([("x --a --b=1 --c  2 --a",), ("x --a --b=1 --c  2 y --d",), ("",), (None,)], "c string")
    got = lines.select(text.command_flags(F.col("c")).alias("f"))
    assert [r.f for r in got.collect()] == [None, {"a": None, "b": "1", "c": "2", "d": None}, {}, None]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


@pytest.mark.parametrize(
    ("value", "reason"),
    [("{}", None), ("7", None), ("", "malformed"), (None, "missing"), ('{"a":1,"a":2}', "duplicate_key"), ('[{"a":{"b":1,"b":1}}]', "duplicate_key"), ("[NaN]", "non_finite"), ("-Infinity", "non_finite"), ('{"a":1} x', "malformed"), ('{"a":1},{"b":1}', "malformed"), ('["NaN"]', None), ("{'a':1}", "malformed")],
)
def test_json_violation(spark, value, reason):
    assert spark.createDataFrame([(value,)], "v string").select(documents.json_violation(F.col("v")).alias("r")).first().r == reason


def test_long_files_by_ranges(spark, tmp_path):
    """Files longer than a part are hashed range by range; their root follows from the parts."""
    from locusframe.sources import files

    data = {"a/short.bin": b"x" * 90, "a/long.bin": bytes(range(256)) * 5, "even.bin": b"y" * 300}
    for name, content in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    got = {r.path: r for r in files.file_inventory(spark, str(tmp_path), part_bytes=100).collect()}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    for name, content in data.items():
        parts = [digest(content[i : i + 100]) for i in range(0, max(1, len(content)), 100)]
        root = parts[0] if len(parts) == 1 else digest("".join(parts).encode())
        assert (got[name].bytes, got[name].tree_sha256) == (len(content), root)
        assert got[name].sha256 == (digest(content) if len(content) <= 100 else None)


def test_digest_tree_of_many_levels(spark):
    from locusframe.operators.digests import digest_tree

    leaves = {k: [hashlib.sha256(f"{k}{i}".encode()).hexdigest() for i in range(n)] for k, n in (("one", 1), ("three", 3), ("many", 29))}
    table = spark.createDataFrame([(k, i, d, 2) for k, ds in leaves.items() for i, d in enumerate(ds)], "k string, at int, d string, n int")
    want = {}
    for k, level in leaves.items():
        while len(level) > 1:
            groups = [level[i : i + 3] for i in range(0, len(level), 3)]
            level = [g[0] if len(g) == 1 else hashlib.sha256("".join(g).encode()).hexdigest() for g in groups]
        want[k] = (len(leaves[k]), 2 * len(leaves[k]), level[0])
    assert {r.k: (r.pieces, r.n, r.d) for r in digest_tree(table, ["k"], "at", "d", "n", fan_out=3).collect()} == want


def test_record_lines_are_split_once(spark):
    """Fields are planned once, not again in each filter and column behind them."""

    def planned(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    for parse, text in ((vcf.parse_vcf, "chr1\t5\tr1\tA\tC,G\t.\tPASS\t.\tGT:DP\t1/2:9"), (sam.parse_sam, "q\t65\tchr1\t5\t9\t1M\t*\t0\t0\tA\tI\tRG:Z:r")):
        table = spark.createDataFrame([("f", 1, "#c"), ("f", 2, "@c"), ("f", 3, text), ("f", 4, "x"), ("f", 5, None)], "source string, line_no long, value string")
        parsed = parse(table)
        assert planned(parsed).count("split(value") == 1
        assert {r["line_no"]: r["violation"] is None for r in parsed.collect()}[3] is True and parsed.count() == 3
