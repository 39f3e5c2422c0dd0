"""Interval algebra on half-open ``(contig, start, end)`` rows.

Everything is one sweep: each interval adds +1 at its start and -1 at its end, deltas are summed
per position first (so piled-up or identical intervals collapse map-side), and a tiled running sum
gives the cover between positions. Union, intersection, subtraction and depth are predicates on
that cover; no pairs of intervals are ever formed and no bin width has to be tuned.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import TILE, WIDTH, Running, following, previous, running

CONTIG = ["contig"]
#: Bases of a word, held as the low bits of a number; the first base is the highest of them.
WORD = 32


def _moves(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    """``(keys, pos, d0..dn)``: one row per interval edge."""
    parts = []
    for index, side in enumerate(sides):
        ends = F.explode(
            F.array(
                F.struct(F.col("start").cast("bigint").alias("pos"), F.lit(1).alias("d")),
                F.struct(F.col("end").cast("bigint").alias("pos"), F.lit(-1).alias("d")),
            )
        )
        event = side.filter("start < end").select(*keys, ends.alias("_e"))
        own = [
            (F.col("_e.d") if i == index else F.lit(0)).cast("bigint").alias(f"d{i}")
            for i in range(len(sides))
        ]
        parts.append(event.select(*keys, F.col("_e.pos").alias("pos"), *own))
    return reduce(DataFrame.unionByName, parts)


def cover(sides: list[DataFrame], keys: list[str] = CONTIG, width: int = WIDTH) -> DataFrame:
    """Cover of each side from ``pos`` on: columns ``c0..cn`` next to the deltas ``d0..dn``.

    The tiles' sums come straight from the interval edges, so only summed deltas are dealt by tile.
    """
    names = [f"d{i}" for i in range(len(sides))]
    moves = _moves(sides, keys)
    summed = moves.groupBy(*keys, "pos").agg(*[F.sum(n).alias(n) for n in names])
    deltas = summed.filter(" or ".join(f"{n} <> 0" for n in names))
    specs = {f"c{i}": Running("sum", n) for i, n in enumerate(names)}
    return running(deltas, keys, "pos", specs, width, keep_tile=True, moves=moves)


def where(
    sides: list[DataFrame],
    inside: Callable[[list[Column]], Column],
    keys: list[str] = CONTIG,
    width: int = WIDTH,
) -> DataFrame:
    """Maximal intervals on which ``inside(cover of each side)`` holds; touching pieces merge."""
    swept = cover(sides, keys, width)
    now = inside([F.col(f"c{i}") for i in range(len(sides))])
    before = inside([F.col(f"c{i}") - F.col(f"d{i}") for i in range(len(sides))])
    edges = swept.select(*keys, TILE, "pos", now.alias("_now"), before.alias("_before")).filter("_now <> _before")
    return (
        following(edges, keys, "pos", "end", width)
        .filter("_now")
        .select(*keys, F.col("pos").alias("start"), "end")
    )


def union(intervals: DataFrame, keys: list[str] = CONTIG, width: int = WIDTH) -> DataFrame:
    """Union; overlapping and touching intervals become one."""
    return where([intervals], lambda c: c[0] > 0, keys, width)


def intersect(left: DataFrame, right: DataFrame, keys: list[str] = CONTIG, width: int = WIDTH) -> DataFrame:
    """Bases covered by both sides; neither side has to be merged first."""
    return where([left, right], lambda c: (c[0] > 0) & (c[1] > 0), keys, width)


def subtract(left: DataFrame, right: DataFrame, keys: list[str] = CONTIG, width: int = WIDTH) -> DataFrame:
    """Bases of the left side that the right side does not cover."""
    return where([left, right], lambda c: (c[0] > 0) & (c[1] == 0), keys, width)


def pad(intervals: DataFrame, contigs: DataFrame, bases: int) -> DataFrame:
    """Widen by ``bases`` on both sides, clip to the contig, then union."""
    if bases < 0:
        raise ValueError("padding must not be negative")
    widened = intervals.join(contigs.select("contig", "length"), "contig").select(
        "contig",
        F.greatest(F.lit(0), F.col("start") - bases).alias("start"),
        F.least(F.col("length"), F.col("end") + bases).alias("end"),
    )
    return union(widened)


def uncovered(subset: DataFrame, superset: DataFrame) -> DataFrame:
    """Containment check: the pieces of ``subset`` outside ``superset``; empty when contained."""
    return subtract(subset, superset)


def summary(intervals: DataFrame) -> DataFrame:
    """Interval count and bases per contig and, with a null contig, in total."""
    return intervals.rollup("contig").agg(
        F.count(F.lit(1)).alias("intervals"), F.sum(F.col("end") - F.col("start")).alias("bases")
    )


def bounds_violations(intervals: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows on an unknown contig or outside ``0 <= start < end <= length``."""
    known = intervals.join(contigs.select("contig", "length"), "contig", "left")
    rule = F.when(F.col("length").isNull(), "unknown_contig").when(
        ~((F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.col("length"))),
        "bounds",
    )
    return known.withColumn("rule", rule).filter("rule is not null").drop("length")


def order_violations(lines: DataFrame, keys: list[str] = ["source"]) -> DataFrame:
    """Rows of a file that overlap or precede the row before them.

    ``lines`` carries ``line_no`` plus ``contig_idx, start, end``; touching rows are allowed.
    """
    seen = previous(lines, keys, "line_no", ["contig_idx", "end"], "_before")
    broken = (F.col("contig_idx") < F.col("_before.contig_idx")) | (
        (F.col("contig_idx") == F.col("_before.contig_idx")) & (F.col("start") < F.col("_before.end"))
    )
    return seen.filter(broken).drop("_before")


def not_normalized(intervals: DataFrame) -> DataFrame:
    """Rows of a set that is not its own union: they overlap, touch or repeat another row."""
    merged = union(intervals)
    return intervals.groupBy("contig", "start", "end").agg(F.count(F.lit(1)).alias("n")).join(
        merged.withColumn("_ok", F.lit(True)), ["contig", "start", "end"], "left"
    ).filter("_ok is null or n > 1").drop("_ok")


def covered_points(points: DataFrame, sides: list[DataFrame], width: int = WIDTH) -> DataFrame:
    """Distinct ``(contig, pos)`` (0-based) that every side covers.

    Points and interval edges share one sweep: a point is inside when the cover of each side at its
    position is positive, so the sides need not be merged or intersected first. Positions are made
    distinct first, so a piled-up position is one row.
    """
    names = [f"d{i}" for i in range(len(sides))]
    zero = [F.lit(0).cast("bigint").alias(n) for n in names]
    marks = points.select("contig", F.col("pos").cast("bigint").alias("pos"), *zero, F.lit(1).alias("_mark"))
    moves = _moves(sides, CONTIG).withColumn("_mark", F.lit(0))
    edges = marks.unionByName(moves)
    mixed = edges.groupBy("contig", "pos").agg(*[F.sum(n).alias(n) for n in names], F.max("_mark").alias("_mark"))
    specs = {f"c{i}": Running("sum", n) for i, n in enumerate(names)}
    swept = running(mixed, CONTIG, "pos", specs, width, moves=edges)
    inside = " and ".join(f"c{i} > 0" for i in range(len(sides)))
    return swept.filter(f"_mark = 1 and {inside}").select("contig", "pos")


def in_words(pieces: DataFrame) -> DataFrame:
    """One row per word that a ``(start, end)`` piece touches: ``word`` and the part ``_from, _to`` in it."""
    first = F.floor(F.col("start") / WORD)
    last = F.floor((F.col("end") - 1) / WORD)
    cut = pieces.filter("start < end").withColumn("word", F.explode(F.sequence(first, last)))
    return cut.withColumns(
        {"_from": F.greatest(F.col("start"), F.col("word") * WORD), "_to": F.least(F.col("end"), (F.col("word") + 1) * WORD)}
    )


def raised(bits: Column) -> Column:
    """Bits of a part of ``in_words``, moved to the places of its bases."""
    return F.call_function("shiftleft", bits, ((F.col("word") + 1) * WORD - F.col("_to")).cast("int"))


def word_bits() -> Column:
    """All bases of a part of ``in_words``."""
    return raised(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_to") - F.col("_from")).cast("int")) - 1)


def covered_words(sides: list[DataFrame]) -> DataFrame:
    """Bases that every side covers, as bits: ``contig, word, inside``, one row per word that has any.

    Intervals meet as bits in the map-side combine, so piled-up ones collapse and nothing is sorted or swept;
    rows grow with the bases of the sides by ``WORD``.
    """
    names = [f"m{i}" for i in range(len(sides))]
    zero = F.lit(0).cast("bigint")
    parts = [
        in_words(side.select("contig", "start", "end").filter("contig is not null")).select(
            "contig", "word", *[(word_bits() if i == index else zero).alias(n) for i, n in enumerate(names)]
        )
        for index, side in enumerate(sides)
    ]
    met = reduce(DataFrame.unionByName, parts).groupBy("contig", "word").agg(*[F.bit_or(n).alias(n) for n in names])
    return met.select("contig", "word", reduce(Column.bitwiseAND, [F.col(n) for n in names]).alias("inside")).filter("inside <> 0")


def overlap_pairs(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, bin_bases: int = 1024
) -> DataFrame:
    """Overlapping pairs of two interval tables, each pair once, with the shared span.

    Both sides go to the fixed bins they touch; a pair is emitted in the bin where the overlap
    starts. Bins that many left rows fall into are salted. Use it only where pairs are the answer
    (a site against its reads, a block against its intervals), never to combine whole sets.
    """
    from .skew import salted_join

    def binned(df: DataFrame, row_id: str, prefix: str) -> DataFrame:
        first = F.floor(F.col("start") / bin_bases)
        last = F.floor((F.col("end") - 1) / bin_bases)
        return df.filter("start < end").select(
            "contig",
            F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("_bin"),
            F.col(row_id).alias(f"{prefix}_id"),
            F.col("start").alias(f"{prefix}_start"),
            F.col("end").alias(f"{prefix}_end"),
        )

    pairs = salted_join(binned(left, left_id, "left"), binned(right, right_id, "right"), ["contig", "_bin"])
    low = F.greatest("left_start", "right_start")
    high = F.least("left_end", "right_end")
    return (
        pairs.withColumn("start", low)
        .withColumn("end", high)
        .filter((F.col("start") < F.col("end")) & (F.floor(F.col("start") / bin_bases) == F.col("_bin")))
        .drop("_bin")
    )


def liftover(intervals: DataFrame, blocks: DataFrame, min_fraction: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Move named intervals through ungapped alignment blocks.

    ``blocks``: ``contig, start, end, to_contig, to_start``. An interval lifts when its pieces land
    on one target contig and carry at least ``min_fraction`` of its bases; its target is the span of
    the pieces. Returns ``(lifted, rejected)``; each row keeps ``name`` and the piece count.
    """
    keyed = blocks.withColumn("block_id", F.struct("start", "end", "to_contig", "to_start"))
    pieces = overlap_pairs(intervals, keyed, "name", "block_id")
    moved = pieces.select(
        F.col("left_id").alias("name"),
        F.col("right_id.to_contig").alias("to_contig"),
        (F.col("right_id.to_start") + F.col("start") - F.col("right_id.start")).alias("to_start"),
        (F.col("end") - F.col("start")).alias("bases"),
    )
    mapped = moved.groupBy("name").agg(
        F.min("to_contig").alias("to_contig"),
        (F.min("to_contig") == F.max("to_contig")).alias("one_contig"),
        F.min("to_start").alias("to_start"),
        F.max(F.col("to_start") + F.col("bases")).alias("to_end"),
        F.sum("bases").alias("lifted_bases"),
        F.count(F.lit(1)).alias("pieces"),
    )
    judged = intervals.join(mapped, "name", "left").withColumn(
        "reason",
        F.when(F.col("pieces").isNull(), "unmapped")
        .when(~F.col("one_contig"), "split_contigs")
        .when(F.col("lifted_bases") < F.lit(min_fraction) * (F.col("end") - F.col("start")), "low_fraction"),
    )
    lifted = judged.filter("reason is null").select(
        "name", "contig", "start", "end", "to_contig", "to_start", "to_end", "lifted_bases", "pieces"
    )
    rejected = judged.filter("reason is not null").select("name", "contig", "start", "end", "reason")
    return lifted, rejected


def liftover_chains(intervals: DataFrame, blocks: DataFrame, min_fraction: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """Move named intervals along chains of alignment blocks on either strand, over the gaps between blocks.

    ``blocks``: ``chain, contig, start, end, to_contig, to_start, strand``; a block and its target are equally
    long, ``to_start`` counts on the forward strand of the target, and on strand ``-`` the bases run backwards.
    An interval goes along the one chain that carries most of its bases (ties: the first chain). Its target
    is the span of its pieces there, so gaps on either side stay inside; ``lifted_bases`` counts what the
    blocks carry and ``to_gap`` the target bases between them. Returns ``(lifted, rejected)`` with a reason for
    each rejected interval: ``unmapped`` (no block), ``split`` (enough bases, but not in one chain) or
    ``low_fraction``.
    """
    block = F.struct("start", "end", "chain", "to_contig", "to_start", "strand")
    pieces = overlap_pairs(intervals, blocks.withColumn("block_id", block), "name", "block_id")
    at = F.col("right_id")
    forward = at["to_start"] + F.col("start") - at["start"]
    backward = at["to_start"] + at["end"] - F.col("end")
    moved = pieces.select(
        F.col("left_id").alias("name"), at["chain"].alias("chain"), at["to_contig"].alias("to_contig"), at["strand"].alias("strand"),
        F.when(at["strand"] == "-", backward).otherwise(forward).alias("to_start"),
        (F.col("end") - F.col("start")).alias("bases"),
    )
    by_chain = moved.groupBy("name", "chain").agg(
        F.min("to_contig").alias("to_contig"), F.min("strand").alias("strand"), F.min("to_start").alias("to_start"),
        F.max(F.col("to_start") + F.col("bases")).alias("to_end"), F.sum("bases").alias("lifted_bases"), F.count(F.lit(1)).alias("pieces"),
    )
    best = F.min(F.struct((-F.col("lifted_bases")).alias("order"), "chain", "to_contig", "strand", "to_start", "to_end", "lifted_bases", "pieces"))
    chosen = by_chain.groupBy("name").agg(best.alias("b"), F.sum("lifted_bases").alias("all_bases"))
    needed = F.lit(min_fraction) * (F.col("end") - F.col("start"))
    judged = intervals.join(chosen, "name", "left").withColumn(
        "reason",
        F.when(F.col("b").isNull(), "unmapped")
        .when(F.col("b.lifted_bases") >= needed, None)
        .when(F.col("all_bases") >= needed, "split")
        .otherwise("low_fraction"),
    )
    gap = F.col("b.to_end") - F.col("b.to_start") - F.col("b.lifted_bases")
    lifted = judged.filter("reason is null").select("name", "contig", "start", "end", "b.chain", "b.to_contig", "b.to_start", "b.to_end", "b.strand", "b.lifted_bases", gap.alias("to_gap"), "b.pieces")
    return lifted, judged.filter("reason is not null").select("name", "contig", "start", "end", "reason")
