"""Read and alignment tables.

Alignments carry ``rid`` (unique), ``qname, flag, contig, start`` (0-based), ``mapq, cigar, seq,
qual``. Flags follow the alignment format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cigar import aligned_blocks, unclipped_end, unclipped_start
from ..functions.quality import phred, stored_order
from ..functions.sequence import reverse_complement
from .intervals import WORD, cover, in_words, overlap_pairs, raised, word_bits
from .ordered import WIDTH, Running, following, running
from .rules import Rule, first_broken
from .skew import best_row_ids

# Flag bits of the alignment format.
PAIRED, UNMAPPED, REVERSE, FIRST, SECOND = 1, 4, 16, 64, 128
SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048
NOT_COUNTED = UNMAPPED | SECONDARY | FAILED | DUPLICATE | SUPPLEMENTARY
WINDOW_MASK = UNMAPPED | SECONDARY | FAILED | DUPLICATE
THRESHOLDS = (1, 10, 20, 30)
PRINTABLE = "".join(map(chr, range(33, 127)))


def has(bit: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(bit) != 0


def primary(flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(SECONDARY | SUPPLEMENTARY) == 0


def mate(flag: str = "flag") -> Column:
    return F.when(has(FIRST, flag), 1).otherwise(2)


def flag_counts(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Primary, mapped, unmapped, duplicate and secondary/supplementary counts."""
    return reads.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(primary()).alias("primary_reads"),
        F.count_if(primary() & ~has(UNMAPPED)).alias("mapped_reads"),
        F.count_if(primary() & has(UNMAPPED)).alias("unmapped_reads"),
        F.count_if(primary() & has(DUPLICATE)).alias("duplicate_reads"),
        F.count_if(has(SECONDARY)).alias("secondary"),
        F.count_if(has(SUPPLEMENTARY)).alias("supplementary"),
    )


def mapped_per_contig(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Primary mapped reads of every contig (zeros kept) and a ``*`` row for unmapped ones."""
    bucket = F.when(has(UNMAPPED), "*").otherwise(F.col("contig"))
    counted = reads.filter(primary()).groupBy(bucket.alias("contig")).agg(F.count(F.lit(1)).alias("reads"))
    frame = contigs.select("contig").unionByName(contigs.limit(1).select(F.lit("*").alias("contig")))
    return frame.join(counted, "contig", "left").select("contig", F.coalesce("reads", F.lit(0)).alias("reads"))


def blocks(reads: DataFrame) -> DataFrame:
    """One row per aligned block: ``rid, qname, contig, start, end``."""
    return reads.select(
        "rid", "qname", "contig", F.explode(aligned_blocks(F.col("cigar"), F.col("start"))).alias("b")
    ).select("rid", "qname", "contig", "b.start", "b.end")


def quality_runs(quality: Column, minimum: int) -> Column:
    """array<struct<first, last>>: half-open read offsets of runs with quality >= minimum."""
    low = f"[!-{_escape(chr(32 + minimum))}]+" if minimum > 0 else "[^ -~]+"
    high = f"[{_escape(chr(33 + minimum))}-~]+"
    runs = F.regexp_extract_all(quality, F.lit(f"({low}|{high})"), F.lit(1))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("out"))

    def step(state: Column, run: Column) -> Column:
        end = state["at"] + F.length(run)
        keep = F.ascii(run) >= 33 + minimum
        piece = F.struct(state["at"].alias("first"), end.alias("last"))
        return F.struct(
            end.alias("at"), F.when(keep, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out")
        )

    return F.aggregate(runs, start, step, lambda state: state["out"])


def _escape(char: str) -> str:
    return f"\\{char}" if char in "[]^-\\" else char


def counted_blocks(reads: DataFrame, min_mapq: int = 20, min_quality: int = 20, exclude: int = NOT_COUNTED) -> DataFrame:
    """Aligned blocks of countable reads, cut to the runs of good base quality."""
    kept = reads.filter((F.col("flag").bitwiseAND(exclude) == 0) & (F.col("mapq") >= min_mapq))
    cut = F.flatten(
        F.transform(
            aligned_blocks(F.col("cigar"), F.col("start")),
            lambda b: F.transform(
                F.filter(
                    quality_runs(F.col("qual"), min_quality),
                    lambda r: (r["first"] < b["query"] + b["end"] - b["start"]) & (r["last"] > b["query"]),
                ),
                lambda r: F.struct(
                    (b["start"] + F.greatest(r["first"] - b["query"], F.lit(0))).alias("start"),
                    F.least(b["end"], b["start"] + r["last"] - b["query"]).alias("end"),
                ),
            ),
        )
    )
    return kept.select("rid", "qname", "contig", F.explode(cut).alias("b")).select(
        "rid", "qname", "contig", "b.start", "b.end"
    )


def once_per_fragment(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """Disjoint pieces of each fragment, so bases under overlapping mates count once.

    Blocks are cut at multiples of ``width``; inside a fragment and tile each piece starts no earlier
    than the furthest end before it. Cut or shortened pieces cover the same bases, which is all that
    depth needs, so no value has to cross tiles.
    """
    tile = F.floor(F.col("start") / width)
    last = F.floor((F.col("end") - 1) / width)
    cut = pieces.filter("start < end").select(
        "contig", "qname", "start", "end", F.explode(F.sequence(tile, last)).alias("tile")
    )
    clipped = cut.groupBy(
        "contig", "qname", "tile", F.greatest(F.col("start"), F.col("tile") * width).alias("start")
    ).agg(F.max(F.least(F.col("end"), (F.col("tile") + 1) * width)).alias("end"))
    before = Window.partitionBy("contig", "qname", "tile").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    moved = clipped.withColumn("start", F.greatest(F.col("start"), F.max("end").over(before)))
    return moved.filter("start < end").select("contig", "qname", "start", "end")


def fragment_words(reads: DataFrame, min_mapq: int = 20, min_quality: int = 20, exclude: int = NOT_COUNTED) -> DataFrame:
    """Good bases of countable reads as bits: ``contig, qname, word, mask``.

    There is one row per fragment and word, whatever the number of runs of good quality, and bases under
    overlapping mates are one bit.
    """
    kept = reads.filter((F.col("flag").bitwiseAND(exclude) == 0) & (F.col("mapq") >= min_mapq))
    good = F.translate("qual", PRINTABLE, "0" * min_quality + "1" * (len(PRINTABLE) - min_quality))
    aligned = kept.select("qname", "contig", good.alias("_good"), F.explode(aligned_blocks(F.col("cigar"), F.col("start"))).alias("b"))
    cut = in_words(aligned.select("qname", "contig", "_good", "b.start", "b.end", "b.query"))
    size = (F.col("_to") - F.col("_from")).cast("int")
    bits = F.rpad(F.substring("_good", (F.col("query") + F.col("_from") - F.col("start") + 1).cast("int"), size), size, F.lit("0"))
    masked = cut.select("contig", "qname", "word", raised(F.conv(bits, 2, 10).cast("bigint")).alias("mask"))
    return masked.groupBy("contig", "qname", "word").agg(F.bit_or("mask").alias("mask"))


def word_depth_summary(
    words: DataFrame, domain: DataFrame, keys: list[str] | None = None, thresholds: tuple[int, ...] = THRESHOLDS
) -> DataFrame:
    """``depth_summary`` over every base of a domain, from the words of ``fragment_words``.

    Each word's counters are summed map-side, two to a number: bases ``i`` and ``i + WORD / 2`` from the end.
    Only words of the domain that have reads are spelt out. Thresholds are at least 1.
    """
    half, one = WORD // 2, F.lit(1).cast("bigint")
    low, high = F.shiftleft(one, half) - 1, F.shiftleft(one, WORD) - 1
    zero = F.lit(0).cast("bigint")
    both = words.select("contig", "word", "mask", zero.alias("inside")).unionByName(
        in_words(domain.select("contig", "start", "end")).select("contig", "word", zero.alias("mask"), word_bits().alias("inside"))
    )

    def counters(i: int) -> Column:
        pair = F.shiftright("mask", i).bitwiseAND(F.shiftleft(one, half) + 1)
        return F.sum(pair.bitwiseAND(low) + F.shiftleft(F.shiftright(pair, half), WORD)).alias(f"n{i}")

    counted = both.filter("contig is not null").groupBy("contig", "word").agg(*[counters(i) for i in range(half)], F.bit_or("inside").alias("inside"))
    pair = lambda i: F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n"))
    read = F.greatest(*[f"n{i}" for i in range(half)]) > 0
    spelt = counted.filter("inside <> 0").select(
        "contig", "inside", F.explode(F.when(read, F.array(*[pair(i) for i in range(half)])).otherwise(F.array(pair(0)))).alias("p")
    )

    def depth(n: Column, bit: Column) -> Column:
        return F.when(F.call_function("shiftright", F.col("inside"), bit).bitwiseAND(1) == 1, n).otherwise(0)

    sized = spelt.select(
        "contig", F.when(F.col("p.i") == 0, F.bit_count("inside")).otherwise(0).alias("size"),
        depth(F.col("p.n").bitwiseAND(high), F.col("p.i")).alias("a"), depth(F.shiftrightunsigned("p.n", WORD), F.col("p.i") + half).alias("b"),
    )
    return sized.groupBy(*(keys or [])).agg(
        F.sum("size").alias("bases"),
        *[F.sum((F.col("a") >= t).cast("int") + (F.col("b") >= t).cast("int")).alias(f"bases_ge_{t}") for t in thresholds],
        F.sum(F.col("a") + F.col("b")).alias("depth_sum"),
        (F.sum(F.col("a") + F.col("b")) / F.sum("size")).alias("mean_depth"),
    )


def depth_over(pieces: DataFrame, domain: DataFrame) -> DataFrame:
    """Run-length depth ``(contig, start, end, depth)`` over every base of a domain, zeros included."""
    swept = cover([pieces, domain], ["contig"])
    spans = following(swept, ["contig"], "pos", "end")
    return spans.filter("c1 > 0 and end is not null").select(
        "contig", F.col("pos").alias("start"), "end", F.col("c0").alias("depth")
    )


def depth_rows(spans: DataFrame) -> DataFrame:
    """Per-base rows (1-based) of run-length depth."""
    return spans.select(
        "contig", F.explode(F.sequence(F.col("start") + 1, F.col("end"))).alias("pos"), "depth"
    )


def depth_summary(spans: DataFrame, keys: list[str] | None = None, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """Bases, covered bases, bases at each threshold, depth sum and mean over run-length depth."""
    size = F.col("end") - F.col("start")
    return spans.groupBy(*(keys or [])).agg(
        F.sum(size).alias("bases"),
        *[F.sum(F.when(F.col("depth") >= t, size).otherwise(0)).alias(f"bases_ge_{t}") for t in thresholds],
        F.sum(size * F.col("depth")).alias("depth_sum"),
        (F.sum(size * F.col("depth")) / F.sum(size)).alias("mean_depth"),
    )


def depth_position_violations(rows: DataFrame, domain: DataFrame) -> DataFrame:
    """Depth rows against the exact positions of a domain: missing, extra and repeated ones.

    Rows and domain run through one sweep, in which rows side by side collapse to runs; only the runs that
    break a rule are spelt out base by base. A row without contig or position is extra.
    """
    placed = "contig is not null and pos is not null"
    seen = rows.filter(placed).select("contig", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"))
    spans = following(cover([seen, domain], ["contig"]), ["contig"], "pos", "end")
    rule = (
        F.when((F.col("c1") > 0) & (F.col("c0") == 0), "missing")
        .when((F.col("c1") == 0) & (F.col("c0") > 0), "extra")
        .when(F.col("c0") > 1, "repeated")
    )
    broken = spans.withColumn("rule", rule).filter("rule is not null")
    told = broken.select("contig", F.explode(F.sequence(F.col("pos") + 1, F.col("end"))).alias("pos"), "rule")
    nowhere = rows.filter(f"not ({placed})").select("contig", F.col("pos").cast("bigint").alias("pos")).distinct().withColumn("rule", F.lit("extra"))
    return told.unionByName(nowhere)


def window_depth(spans: DataFrame, window: int, thresholds: tuple[int, ...] = (1, 5, 10, 20, 30)) -> DataFrame:
    """Mean depth and threshold bases of fixed windows, from run-length depth."""
    first = F.floor(F.col("start") / window)
    last = F.floor((F.col("end") - 1) / window)
    cut = spans.select("contig", "start", "end", "depth", F.explode(F.sequence(first, last)).alias("window_id"))
    size = F.least(F.col("end"), (F.col("window_id") + 1) * window) - F.greatest(F.col("start"), F.col("window_id") * window)
    return cut.withColumn("_size", size).groupBy("contig", "window_id").agg(
        F.sum("_size").alias("bases"),
        (F.sum(F.col("_size") * F.col("depth")) / F.sum("_size")).alias("mean_depth"),
        *[F.sum(F.when(F.col("depth") >= t, F.col("_size")).otherwise(0)).alias(f"bases_ge_{t}") for t in thresholds],
    )


def duplicate_fragments(reads: DataFrame) -> DataFrame:
    """``library, qname`` of all but the best fragment of every group with the same library, ends and orientations.

    The best fragment (highest sum of qualities >= 15, then name) is found by a map-side min; the others are told
    by the fragment name, which is unique, so even a group that holds a third of all reads is never gathered.
    """
    end = F.when(has(REVERSE), unclipped_end(F.col("cigar"), F.col("start"))).otherwise(
        unclipped_start(F.col("cigar"), F.col("start"))
    )
    place = F.struct("contig", end.alias("five_prime"), has(REVERSE).alias("reverse"))
    score = F.aggregate(
        phred(F.col("qual")), F.lit(0).cast("bigint"), lambda t, q: t + F.when(q >= 15, q).otherwise(0)
    )
    fragments = (
        reads.filter(primary() & ~has(UNMAPPED))
        .groupBy("library", "qname")
        .agg(F.min(place).alias("left"), F.max(place).alias("right"), F.count(F.lit(1)).alias("ends"), F.sum(score).alias("score"))
    )
    best = best_row_ids(fragments, ["library", "left", "right", "ends"], [-F.col("score")], "qname")
    return fragments.select("library", "qname").join(best.select("library", "qname"), ["library", "qname"], "left_anti")


def mark_duplicates(reads: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """Flag the reads of duplicate fragments, those of ``duplicate_fragments`` unless they are given.

    Needs ``library``. Only the names of duplicates meet the reads.
    """
    named = (duplicate_fragments(reads) if duplicates is None else duplicates).select("library", "qname", F.lit(True).alias("_named"))
    marked = reads.join(named, ["library", "qname"], "left")
    duplicate = primary() & ~has(UNMAPPED) & F.col("_named").isNotNull()
    return marked.withColumn("duplicate", duplicate).drop("_named")


def fragment_flag_disagreements(reads: DataFrame) -> DataFrame:
    """Fragments whose primary reads disagree on the duplicate flag."""
    return (
        reads.filter(primary())
        .groupBy("qname")
        .agg(F.min(has(DUPLICATE)).alias("low"), F.max(has(DUPLICATE)).alias("high"))
        .filter("low <> high")
        .select("qname")
    )


def bases_at(reads: DataFrame, sites: DataFrame) -> DataFrame:
    """Read base at every covered site: ``site_id, rid, qname, base`` through the CIGAR."""
    aligned = reads.filter(~has(UNMAPPED)).select(
        "contig",
        F.explode(aligned_blocks(F.col("cigar"), F.col("start"))).alias("b"),
        "rid", "qname", "seq",
    ).select(
        "contig", "b.start", "b.end",
        F.struct("rid", "qname", F.substring("seq", F.col("b.query") + 1, (F.col("b.end") - F.col("b.start")).cast("int")).alias("bases")).alias("block"),
    )
    points = sites.select("site_id", "contig", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    pairs = overlap_pairs(aligned, points, "block", "site_id")
    return pairs.select(
        F.col("right_id").alias("site_id"),
        "left_id.rid", "left_id.qname",
        F.substring("left_id.bases", (F.col("start") - F.col("left_start") + 1).cast("int"), F.lit(1)).alias("base"),
    )


def allele_support(bases: DataFrame) -> DataFrame:
    """Fragments per base at each site; fragments whose mates disagree count as ``conflict``."""
    fragment = bases.groupBy("site_id", "qname").agg(F.min("base").alias("low"), F.max("base").alias("high"))
    base = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("conflict")
    return fragment.groupBy("site_id", base.alias("base")).agg(F.count(F.lit(1)).alias("fragments"))


def compare_expected(reads: DataFrame, expected: DataFrame) -> DataFrame:
    """Primary reads against their expectation by ``(qname, mate)``; the first difference per read.

    ``expected``: ``qname, mate, read_group, contig, pos, reverse, sequence_sha256,
    original_qualities`` in sequencing order.
    """
    observed = reads.filter(primary()).select(
        "qname", mate().alias("mate"), F.col("read_group").alias("o_rg"), F.col("contig").alias("o_contig"),
        F.col("pos").alias("o_pos"), has(REVERSE).alias("o_reverse"), has(UNMAPPED).alias("o_unmapped"),
        F.sha2(F.when(has(REVERSE), reverse_complement(F.col("seq"))).otherwise(F.col("seq")), 256).alias("o_sha"),
        "oq", "flag",
    )
    joined = expected.withColumn("_want", F.lit(True)).join(
        observed.withColumn("_have", F.lit(True)), ["qname", "mate"], "full_outer"
    )
    rules = [
        Rule("missing", F.col("_have").isNull()),
        Rule("unexpected", F.col("_want").isNull()),
        Rule("read_group", ~F.col("read_group").eqNullSafe(F.col("o_rg"))),
        Rule("mapping", F.col("contig").isNull() != F.col("o_unmapped")),
        Rule("strand", F.col("reverse") != F.col("o_reverse")),
        Rule("coordinate", ~F.col("o_unmapped") & ((F.col("contig") != F.col("o_contig")) | (F.col("pos") != F.col("o_pos")))),
        Rule("sequence", F.col("sequence_sha256") != F.col("o_sha")),
        Rule("original_quality", ~F.col("oq").eqNullSafe(stored_order(F.col("original_qualities"), F.col("flag")))),
    ]
    return joined.select("qname", "mate", first_broken(rules).alias("rule")).filter("rule is not null")


def read_group_violations(headers: DataFrame, lanes: DataFrame) -> DataFrame:
    """Read-group tags against lane metadata (full outer by read group id)."""
    joined = headers.join(lanes.withColumnsRenamed({c: f"lane_{c}" for c in lanes.columns if c != "read_group"}), "read_group", "full_outer")
    fields = [c for c in lanes.columns if c != "read_group"]
    rules = [
        Rule("unknown_read_group", F.col(f"lane_{fields[0]}").isNull()),
        Rule("absent_read_group", F.col(fields[0]).isNull()),
        *[Rule(f"{c}", ~F.col(c).eqNullSafe(F.col(f"lane_{c}"))) for c in fields],
    ]
    return joined.select("read_group", first_broken(rules).alias("rule")).filter("rule is not null")


def cycle_profile(reads: DataFrame) -> DataFrame:
    """Per sequencing cycle: observations, mean and median quality and the base mix.

    Bases are counted by (cycle, quality) first; the median comes from that histogram of at most
    94 rows per cycle, so it is exact without sorting bases.
    """
    quality = F.when(has(REVERSE), F.reverse(F.col("qual"))).otherwise(F.col("qual"))
    bases = F.when(has(REVERSE), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    cells = F.arrays_zip(phred(quality).alias("q"), F.split(bases, "").alias("b"))
    each = reads.filter(primary()).select(F.posexplode(cells).alias("cycle", "c")).select(
        (F.col("cycle") + 1).alias("cycle"), F.col("c.q").alias("q"), F.col("c.b").alias("b")
    )
    histogram = each.groupBy("cycle", "q").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("b") == x).alias(x) for x in "ACGT"]
    )
    w = Window.partitionBy("cycle")
    upto = w.orderBy("q").rowsBetween(Window.unboundedPreceding, 0)
    ranked = histogram.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(w))
    return ranked.groupBy("cycle").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("q")) / F.sum("n")).alias("mean_quality"),
        F.min(F.when(F.col("_upto") * 2 >= F.col("_all"), F.col("q"))).alias("median_quality"),
        *[F.sum(x).alias(f"n_{x.lower()}") for x in "ACGT"],
        (F.sum(F.col("G") + F.col("C")) / F.sum("n")).alias("gc"),
    )


def read_count_crosscheck(reads: DataFrame, index_counts: DataFrame, contigs: DataFrame) -> DataFrame:
    """Own mapped counts against an index-count table; contigs that differ."""
    own = mapped_per_contig(reads, contigs)
    reported = index_counts.select("contig", F.col("mapped").alias("reported"))
    return own.join(reported, "contig", "full_outer").filter(~F.col("reads").eqNullSafe(F.col("reported")))


def unmapped_before_mapped(records: DataFrame) -> DataFrame:
    """Mapped records that follow an unmapped one in their file (``source, line_no``)."""
    marked = records.withColumn("_u", has(UNMAPPED).cast("int"))
    seen = running(marked, ["source"], "line_no", {"_before": Running("max", "_u", inclusive=False)})
    return seen.filter("_u = 0 and _before = 1").select("source", "line_no")
