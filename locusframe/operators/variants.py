"""Variant rows: reference checks, allele splitting, left alignment and inclusion.

Rows carry ``contig``, 1-based ``pos``, ``ref``, ``alt`` (or ``alts``) and ``gt``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genotype import allele_multiset, alleles, copies_in, exclusion_of, exclusion_reason, split_genotype
from ..session import written
from ..sources.fasta import CHUNK, windows
from .intervals import overlap_pairs
from .ordered import Running, running
from .rules import Rule, settled


#: Bases before a record that are read with its REF, enough for most alignments.
LOOKBACK = 64


def check_reference(variants: DataFrame, chunk_table: DataFrame, row_id: str, size: int = CHUNK, lookback: int = 0, max_span: int | None = None) -> DataFrame:
    """Add ``ref_ok``: REF, of whatever length, is what the reference holds there.

    A caller that knows REF and lookback to be short says so with ``max_span``, and the variants are made once
    (see ``windows``; a longer one fails the job).

    With ``lookback`` the same read also brings ``_before``: up to so many bases in front of the record.
    """
    first = F.greatest(F.col("pos") - 1 - lookback, F.lit(0))
    placed = variants.withColumns({"start": first, "end": F.col("pos") - 1 + F.length("ref")})
    seen = windows(placed, chunk_table, row_id, size, max_span=max_span, how="left")
    ahead = (F.col("pos") - 1 - F.col("start")).cast("int")
    own = F.upper(F.substring("window", ahead + 1, F.length("ref")))
    ok = F.coalesce(own == F.col("ref"), F.lit(False)) & (F.col("pos") >= 1)
    judged = settled(seen, "ref_ok", ok)
    if not lookback:
        return judged.select(*variants.columns, "ref_ok")
    return judged.select(*variants.columns, "ref_ok", F.upper(F.substring("window", F.lit(1), ahead)).alias("_before"))


def reference_mismatches(variants: DataFrame, chunk_table: DataFrame, row_id: str, size: int = CHUNK) -> DataFrame:
    """Variants whose REF is not what the reference holds at that place (or lies off it)."""
    return check_reference(variants, chunk_table, row_id, size).filter(~F.col("ref_ok")).drop("ref_ok")


def split_alleles(variants: DataFrame) -> DataFrame:
    """One row per ALT; the genotype is rewritten for that ALT and other ALTs become 0."""
    record = F.when(F.size("alts") > 1, F.concat_ws("|", "contig", "pos", "ref", F.array_join("alts", ",")))
    exploded = variants.withColumn("original", record).select(
        *[c for c in variants.columns if c not in ("alts", "gt")],
        "gt",
        "original",
        F.posexplode("alts").alias("_i", "alt"),
    )
    own = F.when(F.col("original").isNull(), F.col("_gt")).otherwise(split_genotype(F.col("_gt"), F.col("_i") + 1))
    columns = [c for c in exploded.columns if c != "_i"]
    return settled(exploded.withColumnRenamed("gt", "_gt"), "gt", own).select(*columns)


def _common(a: Column, b: Column, limit: Column, side: str) -> Column:
    """Length of the longest common suffix or prefix, at most ``limit``, by bisection.

    Equality of the last n characters is monotone in n, so log2(limit) comparisons decide it; the
    texts ride in the accumulator and are computed once.
    """
    steps = F.transform(
        F.sequence(F.floor(F.log2(F.greatest(limit, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)),
        lambda i: F.pow(F.lit(2), i).cast("int"),
    )
    start = F.struct(F.lit(0).alias("k"), a.alias("a"), b.alias("b"), limit.cast("int").alias("n"))

    def part(text: Column, n: Column) -> Column:
        return F.substring(text, -n, n) if side == "suffix" else F.substring(text, F.lit(1), n)

    def step(state: Column, width: Column) -> Column:
        n = state["k"] + width
        grow = (n <= state["n"]) & (part(state["a"], n) == part(state["b"], n))
        return F.struct(
            F.when(grow, n).otherwise(state["k"]).alias("k"), state["a"].alias("a"), state["b"].alias("b"), state["n"].alias("n")
        )

    return F.aggregate(steps, start, step, lambda state: state["k"])


def _trimmed(variants: DataFrame) -> DataFrame:
    """Drop the shared suffix. ``_core`` is the pure inserted or deleted text, if one remains, and
    ``_start`` the 0-based place where it begins."""
    shorter = F.least(F.length("ref"), F.length("alt"))
    single = (F.length("ref") == 1) & (F.length("alt") == 1)
    suffix = F.when(single, 0).otherwise(_common(F.col("ref"), F.col("alt"), shorter, "suffix"))
    cut = variants.withColumn("_s", suffix).withColumns(
        {
            "_r": F.substring("ref", F.lit(1), F.length("ref") - F.col("_s")),
            "_a": F.substring("alt", F.lit(1), F.length("alt") - F.col("_s")),
        }
    )
    core = F.when((F.col("_r") == "") | (F.col("_a") == ""), F.concat("_r", "_a"))
    same_first = F.substring("_r", 1, 1) == F.substring("_a", 1, 1)
    anchored = F.when(
        same_first & (F.length("_r") == 1) & (F.length("_a") > 1), F.substring(F.col("_a"), F.lit(2), F.length("_a"))
    ).when(same_first & (F.length("_a") == 1) & (F.length("_r") > 1), F.substring(F.col("_r"), F.lit(2), F.length("_r")))
    located = cut.withColumns(
        {
            "_core": F.coalesce(core, anchored),
            "_start": F.col("pos") - 1 + F.when(core.isNull() & anchored.isNotNull(), 1).otherwise(0),
        }
    )
    return located.drop("_s")


def _needs_reference() -> Column:
    return F.col("_core").isNotNull() & (F.col("_start") > 0)


def _shifted(seen: DataFrame) -> DataFrame:
    """Add how far each row moves left (``_k``) inside ``_window``, the reference text that ends at its
    ``_start``, and whether that text was too short to tell (``_full``)."""
    # One base must stay as the anchor, so a shift may use all but the first window base.
    room = F.when(_needs_reference(), F.greatest(F.length("_window") - 1, F.lit(0))).otherwise(0)
    copies = F.repeat("_core", (F.col("_room") / F.length("_core")).cast("int") + 1)
    periodic = F.substring(copies, -F.col("_room"), F.col("_room"))
    shift = F.when(F.col("_room") > 0, _common(F.col("_window"), periodic, F.col("_room"), "suffix"))
    full = (F.col("_room") > 0) & (F.col("_k") == F.col("_room")) & (F.col("_start") > F.length("_window"))
    return seen.withColumn("_room", room).withColumn("_k", F.coalesce(shift, F.lit(0))).withColumn("_full", full).drop("_room")


def _finished(moved: DataFrame, columns: list[str], chunk_table: DataFrame, row_id: str, reach: int, size: int) -> DataFrame:
    """Rewrite shifted rows; those whose window was too short are read again with one eight times as long.

    Only ``columns`` of the rewritten rows are written; a row to be read again keeps its alleles and gets an id.
    """
    done = []
    while True:
        again = F.when(F.col("_full"), F.concat_ws(":", row_id, "alt")).alias("_row")
        told = written(_rewritten(moved.withColumn("_row", again)).select(*columns, "_full", "_row"), "aligned")
        done.append(told.filter("not _full").select(*columns))
        work = told.filter("_full").drop("_full")
        if work.isEmpty():
            return reduce(DataFrame.unionByName, done)
        reach, row_id = reach * 8, "_row"
        moved = _shifted(_placed(_trimmed(work), chunk_table, row_id, reach, size))


def _placed(work: DataFrame, chunk_table: DataFrame, row_id: str, reach: int, size: int) -> DataFrame:
    placed = work.withColumns({"start": F.col("_start") - reach, "end": F.col("_start")})
    seen = windows(placed, chunk_table, row_id, size, max_span=reach if reach <= size else None, how="left")
    return seen.withColumn("_window", F.upper(F.coalesce("window", F.lit("")))).drop("window", "start", "end")


def left_align(variants: DataFrame, chunk_table: DataFrame, row_id: str, lookback: int = LOOKBACK, size: int = CHUNK) -> DataFrame:
    """Left-align and trim each variant against the reference.

    A pure insertion or deletion of text S of length m moves left by k, the length of the run over
    which the reference before it repeats S with period m: one suffix comparison with repeated S,
    no step-by-step rewriting. Only such rows meet the reference and are written; SNVs and complex
    alleles pass by. Rows whose run fills the window are redone with a longer one, so no shift is cut short.
    """
    columns = variants.columns
    trimmed = _trimmed(variants)
    bare = trimmed.filter(~_needs_reference()).withColumns({"_window": F.lit(""), "_k": F.lit(0), "_full": F.lit(False)})
    moved = _shifted(_placed(trimmed.filter(_needs_reference()), chunk_table, row_id, lookback, size))
    return _rewritten(bare).select(*columns).unionByName(_finished(moved, columns, chunk_table, row_id, lookback, size))


def align_checked(
    checked: DataFrame, chunk_table: DataFrame, row_id: str, lookback: int = LOOKBACK, size: int = CHUNK, columns: list[str] | None = None
) -> DataFrame:
    """``left_align`` of rows that ``check_reference`` read with ``lookback``: no second read of the reference.

    The aligned rows are written once, with those ``columns`` that the caller needs (alleles and their place among
    them); whatever reads the result reads them, and nothing above runs again. ``row_id`` and ALT name a row.
    """
    columns = columns or [c for c in checked.columns if c != "_before"]
    trimmed = _trimmed(checked)
    # an event behind its anchor base has that base in front of it too
    anchor = F.when(F.col("_start") == F.col("pos"), F.substring("ref", 1, 1)).otherwise("")
    seen = trimmed.withColumn("_window", F.when(_needs_reference(), F.concat(F.coalesce("_before", F.lit("")), anchor)).otherwise("")).drop("_before")
    return _finished(_shifted(seen), columns, chunk_table, row_id, lookback, size)


def _rewritten(moved: DataFrame) -> DataFrame:
    """Final position and alleles of aligned rows; a row that is not aligned yet (``_full``) keeps its own."""
    text = F.concat("_window", "_core")
    anchor = F.substring(text, F.length("_window") - F.col("_k"), F.lit(1))
    rotated = F.substring(text, F.length("_window") - F.col("_k") + 1, F.length("_core"))
    # At the very start of a contig there is no base to the left; the base after the event anchors it.
    at_start = F.col("_window") == ""
    after = F.substring("ref", F.length("_r") + 1, F.lit(1))
    event = F.when(at_start, F.concat("_core", after)).otherwise(F.concat(anchor, rotated))
    bare = F.when(at_start, after).otherwise(anchor)
    deletion = F.length("_r") > F.length("_a")
    pure = F.col("_core").isNotNull()
    limit = F.least(F.length("_r"), F.length("_a")) - 1
    skip = F.when(limit > 0, _common(F.col("_r"), F.col("_a"), limit, "prefix")).otherwise(0)
    full = F.col("_full")
    return moved.withColumn("_skip", F.when(~pure, skip).otherwise(0)).select(
        *[c for c in moved.columns if c not in ("pos", "ref", "alt")],
        F.when(full, F.col("pos")).when(~pure, F.col("pos") + F.col("_skip")).when(at_start, F.lit(1)).otherwise(F.col("_start") - F.col("_k")).alias("pos"),
        F.when(full, F.col("ref")).when(~pure, F.substring(F.col("_r"), F.col("_skip") + 1, F.length("_r"))).when(deletion, event).otherwise(bare).alias("ref"),
        F.when(full, F.col("alt")).when(~pure, F.substring(F.col("_a"), F.col("_skip") + 1, F.length("_a"))).when(deletion, bare).otherwise(event).alias("alt"),
    )


def with_inclusion(variants: DataFrame) -> DataFrame:
    """Tag every call with its exclusion reason; null means it is compared."""
    return variants.withColumn("reason", exclusion_reason(F.col("gt")))


def included(variants: DataFrame) -> DataFrame:
    """Fully called diploid non-reference rows with their ALT copy count."""
    # the genotype is split once per row for its reason and its copies
    called = settled(variants, "_calls", alleles(F.col("gt")))
    kept = settled(called, "reason", exclusion_of(F.col("_calls"))).filter("reason is null")
    return kept.withColumn("alt_copies", copies_in(F.col("_calls"))).drop("reason", "_calls")


def exclusion_counts(variants: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return (
        with_inclusion(variants)
        .filter("reason is not null")
        .groupBy(*(keys or []), "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def known_site_filter(sites: DataFrame, contigs: DataFrame, chunk_table: DataFrame, row_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keep records on known contigs, count what was removed, list kept records with a wrong REF."""
    kept = sites.join(contigs.select("contig"), "contig", "left_semi")
    removed = sites.join(contigs.select("contig"), "contig", "left_anti").groupBy("contig").agg(F.count(F.lit(1)).alias("removed"))
    return kept, removed, reference_mismatches(kept, chunk_table, row_id)


def clusters(variants: DataFrame, gap: int, keys: list[str] = ["contig"]) -> DataFrame:
    """Add ``cluster``: the start of a chain of records at most ``gap`` bases apart inside ``keys``."""
    spans = (
        variants.select(*keys, F.col("pos").alias("pos"), (F.col("pos") + F.length("ref") - 1).alias("_end"))
        .groupBy(*keys, "pos")
        .agg(F.max("_end").alias("_end"))
    )
    seen = running(spans, keys, "pos", {"_reach": Running("max", "_end", inclusive=False)})
    opened = seen.withColumn("_open", F.when(F.col("_reach").isNull() | (F.col("pos") > F.col("_reach") + gap), F.col("pos")))
    named = running(opened, keys, "pos", {"cluster": Running("max", "_open")}).select(*keys, "pos", "cluster")
    return variants.join(named, [*keys, "pos"])


def site_oracle(records: DataFrame, sites: DataFrame) -> DataFrame:
    """Number of accepted records (FILTER PASS or ``.``) with the wanted allele multiset per site.

    ``sites``: ``site_id, contig, pos, wanted`` (sorted alleles). Anything but one is a failure.
    """
    carried = records.filter(F.col("filter").isin("PASS", ".")).select(
        "contig", "pos", allele_multiset(F.col("gt"), F.col("ref"), F.col("alts")).alias("carried")
    )
    return (
        sites.join(carried, ["contig", "pos"], "left")
        .groupBy("site_id")
        .agg(F.count_if(F.col("carried") == F.col("wanted")).alias("matches"))
    )


def bounded_diagnostics(records: DataFrame, sites: DataFrame, row_id: str, rows: int) -> DataFrame:
    """At most ``rows`` overlapping records per site, with the total and a truncation flag.

    The total is a plain count; the shown rows come from a rank inside ``(site, bucket)`` first and
    then inside the site, so a site that very many records overlap is never sorted in one task.
    """
    pairs = overlapping_records(records, sites, row_id)
    totals = pairs.groupBy("site_id").agg(F.count(F.lit(1)).alias("overlapping"))
    bucket = F.pmod(F.xxhash64(row_id), F.lit(64))
    local = Window.partitionBy("site_id", "_b").orderBy(row_id)
    overall = Window.partitionBy("site_id").orderBy(row_id)
    shown = (
        pairs.withColumn("_b", bucket)
        .withColumn("_r", F.row_number().over(local))
        .filter(F.col("_r") <= rows)
        .withColumn("rank", F.row_number().over(overall))
        .filter(F.col("rank") <= rows)
        .drop("_b", "_r")
    )
    return shown.join(totals, "site_id").withColumn("truncated", F.col("overlapping") > rows)


def candidate_rules() -> list[Rule]:
    """Rules of a candidate ``start, end, ref, alts`` (0-based half-open span)."""
    return [
        Rule("span", ~((F.col("start") >= 0) & (F.col("end") - F.col("start") == F.length("ref")))),
        Rule("ref_alphabet", ~F.col("ref").rlike("^[ACGTN]+$")),
        Rule("no_alt", F.size("alts") == 0),
        Rule("alt_alphabet", F.exists("alts", lambda a: ~a.rlike("^[ACGTN]+$") | (a == F.col("ref")))),
        Rule("alt_repeated", F.size(F.array_distinct("alts")) != F.size("alts")),
    ]


def overlapping_records(records: DataFrame, sites: DataFrame, row_id: str) -> DataFrame:
    """Records whose 1-based closed ``[pos, end]`` covers a site: ``(site_id, row_id)``."""
    points = sites.select("site_id", "contig", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"))
    spans = records.withColumn("start", F.col("pos") - 1)
    return overlap_pairs(spans, points, row_id, "site_id").select(
        F.col("right_id").alias("site_id"), F.col("left_id").alias(row_id)
    )


def missing_candidates(inferred: DataFrame, generated: DataFrame, key: list[str]) -> DataFrame:
    """Inference rows whose candidate was never generated."""
    return inferred.join(generated.select(*key), key, "left_anti")


def invalid_probabilities(rows: DataFrame, column: str = "probabilities", tolerance: float = 1e-5) -> DataFrame:
    """Rows without three finite probabilities in [0, 1] that sum to one."""
    p = F.col(column)
    inside = F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x) & (x >= 0) & (x <= 1))
    total = F.aggregate(p, F.lit(0.0), lambda t, x: t + x)
    return rows.filter(~((F.size(p) == 3) & inside & (F.abs(total - 1) <= tolerance)))
