"""Genotype-aware comparison of calls with truth, and its metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genotype import CLASSES, variant_class
from .intervals import WORD, covered_words

KEY = ["contig", "pos", "ref", "alt", "alt_copies"]
PARTITIONS = ("tp", "tp_baseline", "fp", "fn")


def restrict(variants: DataFrame, *regions: DataFrame) -> DataFrame:
    """Variants whose first base lies in every one of the regions."""
    words = covered_words(list(regions)).select(F.col("contig").alias("_contig"), "word", "inside")
    at = F.col("pos") - 1
    bit = F.call_function("shiftright", F.col("inside"), ((F.col("word") + 1) * WORD - 1 - at).cast("int")).bitwiseAND(1)
    found = (F.col("contig") == F.col("_contig")) & (F.floor(at / WORD) == F.col("word")) & (bit == 1)
    return variants.join(words, found, "left_semi")


def sides(query: DataFrame, truth: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Distinct alleles with ``in_query`` and ``in_truth``.

    A full outer match as one aggregation: equal alleles meet in the map-side combine, repeated
    records collapse, and no side is sorted for a join. ``extra`` keys (a caller, a sample) match too.
    """
    keys = [*(extra or []), *KEY]
    both = query.select(*keys, F.lit(True).alias("q"), F.lit(False).alias("t")).unionByName(
        truth.select(*keys, F.lit(False).alias("q"), F.lit(True).alias("t"))
    )
    return both.groupBy(*keys).agg(F.max("q").alias("in_query"), F.max("t").alias("in_truth"))


def flagged(calls: DataFrame, query: Column, truth: Column, extra: list[str] | None = None) -> DataFrame:
    """``sides`` of one table whose rows tell by two flags to which side they belong; read once."""
    rows = calls.select(*(extra or []), *KEY, query.alias("_q"), truth.alias("_t")).filter("_q or _t")
    return rows.groupBy(*(extra or []), *KEY).agg(F.max("_q").alias("in_query"), F.max("_t").alias("in_truth"))


def label(matched: DataFrame) -> DataFrame:
    """``tp``+``tp_baseline``, ``fp`` or ``fn`` rows. A genotype difference is one fp and one fn."""
    labels = (
        F.when(F.col("in_query") & F.col("in_truth"), F.array(F.lit("tp"), F.lit("tp_baseline")))
        .when(F.col("in_query"), F.array(F.lit("fp")))
        .otherwise(F.array(F.lit("fn")))
    )
    return matched.withColumn("partition", F.explode(labels)).drop("in_query", "in_truth")


def match(query: DataFrame, truth: DataFrame, *regions: DataFrame) -> DataFrame:
    """Partition the calls and truth that lie in every region."""
    return match_sides(sides(query, truth), *regions)


def match_sides(both: DataFrame, *regions: DataFrame) -> DataFrame:
    """Partition the alleles of ``sides`` or ``flagged`` that lie in every region."""
    # Always true, but it keeps both uses of the aggregate identical, so its shuffle is reused.
    matched = both.filter("in_query or in_truth")
    return label(restrict(matched, *regions) if regions else matched)


def class_counts(partitions: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts per variant class and partition as columns ``tp_query, tp_truth, fp, fn``."""
    label = variant_class(F.col("ref"), F.col("alt")).alias("variant_class")
    names = {"tp": "tp_query", "tp_baseline": "tp_truth", "fp": "fp", "fn": "fn"}
    return partitions.groupBy(*(keys or []), label).agg(
        *[F.count_if(F.col("partition") == p).alias(n) for p, n in names.items()]
    )


def with_all_classes(counts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Zero rows for classes nobody saw."""
    spark = counts.sparkSession
    frame = spark.createDataFrame([(c,) for c in CLASSES], "variant_class string")
    on = ["variant_class"]
    if keys is not None:
        frame = frame.crossJoin(F.broadcast(keys)) if len(keys.columns) else frame
        on = [*keys.columns, *on]
    measures = [c for c in counts.columns if c not in on]
    return frame.join(counts, on, "left").na.fill(0, measures)


def metrics(counts: DataFrame, evaluated: Column | None = None) -> DataFrame:
    """Precision, recall and F1 with separate TP denominators; a null always has a reason."""
    evaluated = F.lit(True) if evaluated is None else evaluated
    called, true = F.col("tp_query") + F.col("fp"), F.col("tp_truth") + F.col("fn")
    precision = F.when(evaluated & (called > 0), F.col("tp_query") / called)
    recall = F.when(evaluated & (true > 0), F.col("tp_truth") / true)
    rated = counts.withColumns({"precision": precision, "recall": recall})
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total > 0, F.lit(2.0) * F.col("precision") * F.col("recall") / total).when(total == 0, 0.0)
    scored = rated.withColumn("f1", f1)
    reasons = {
        "precision": "zero_query_denominator",
        "recall": "zero_truth_denominator",
        "f1": "undefined_precision_or_recall",
    }
    pairs = [
        x
        for name, why in reasons.items()
        for x in (
            F.lit(name),
            F.when(F.col(name).isNull(), F.when(~evaluated, "empty_domain").otherwise(why)),
        )
    ]
    return scored.withColumn("missing_reasons", F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()))


def error_strata(errors: DataFrame, labels: list[tuple[str, Column]], exclusive: bool) -> DataFrame:
    """fp/fn counts by stratum: the first matching label only, or every matching label."""
    hits = [F.when(c, F.lit(n)) for n, c in labels]
    if exclusive:
        named = errors.select("partition", F.coalesce(*hits, F.lit("unassigned")).alias("stratum"))
    else:
        named = errors.select("partition", F.explode(F.array_compact(F.array(*hits))).alias("stratum"))
    return named.groupBy("stratum").agg(
        F.count_if(F.col("partition") == "fp").alias("fp"), F.count_if(F.col("partition") == "fn").alias("fn")
    )
