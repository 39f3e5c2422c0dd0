"""Contract checks that return violations as rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named predicate that holds for a bad row; null counts as not violated."""

    name: str
    broken: Column


def required(column: str) -> Rule:
    return Rule(f"{column}:required", F.col(column).isNull())


def pattern(column: str, regex: str) -> Rule:
    return Rule(f"{column}:pattern", ~F.col(column).rlike(regex))


def one_of(column: str, values: list[object]) -> Rule:
    return Rule(f"{column}:enum", ~F.col(column).isin(*values))


def between(column: str, low: object = None, high: object = None) -> Rule:
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(column) < low)
    if high is not None:
        broken = broken | (F.col(column) > high)
    return Rule(f"{column}:range", broken)


def constant(column: str, value: object) -> Rule:
    return Rule(f"{column}:const", F.col(column) != F.lit(value))


def closed(column: str, allowed: list[str]) -> Rule:
    """A map column may only carry the listed names."""
    extra = F.array_except(F.map_keys(F.col(column)), F.array(*[F.lit(a) for a in allowed]))
    return Rule(f"{column}:extra", F.size(extra) > 0)


def sql_rule(name: str, predicate: str) -> Rule:
    """User rule: a SQL predicate that is true for a bad row."""
    return Rule(name, F.expr(predicate))


def first_broken(rules: list[Rule]) -> Column:
    """Name of the first broken rule of a row, or null."""
    return F.coalesce(*[F.when(r.broken, F.lit(r.name)) for r in rules])


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters take as given.

    A filter on a plain column is rewritten into the rules behind it, and planning a long list of rules
    takes far longer than the rows do; a generator of one value keeps it whole.
    """
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def check(df: DataFrame, rules: list[Rule], key: Column) -> DataFrame:
    """All broken rules of all rows in one pass: ``(rule, key)``."""
    broken = F.array_compact(F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules]))
    return df.select(F.explode(broken).alias("rule"), key.cast("string").alias("key"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def agreement(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per group: do all members carry one and the same non-null value?

    Min and max decide it; a distinct set would hold all values of a group.
    """
    return df.groupBy(*keys).agg(
        (F.min(value).eqNullSafe(F.max(value)) & (F.count(value) == F.count(F.lit(1)))).alias("agrees")
    )


def expected_counts(df: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Observed row counts against a table ``(key, expected)``; only differences come back."""
    observed = df.groupBy(key).agg(F.count(F.lit(1)).alias("observed"))
    both = observed.join(expected, key, "full_outer")
    return both.select(
        key,
        F.coalesce("observed", F.lit(0)).alias("observed"),
        F.coalesce("expected", F.lit(0)).alias("expected"),
    ).filter("observed <> expected")


def non_empty(df: DataFrame, name: str) -> DataFrame:
    """One violation row when a table has no rows."""
    return (
        df.agg(F.count(F.lit(1)).alias("n"))
        .filter("n = 0")
        .select(F.lit(name).alias("rule"), F.lit("*").alias("key"))
    )


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Members of exactly one of two sets, with the side they are on."""
    only_left = left.select(key).distinct().join(right.select(key), key, "left_anti")
    only_right = right.select(key).distinct().join(left.select(key), key, "left_anti")
    return only_left.withColumn("side", F.lit("left")).unionByName(
        only_right.withColumn("side", F.lit("right"))
    )


def multiset_digest(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Order-free digest of a row multiset: row count and the sum of row hashes.

    Two streams with equal digests hold the same rows whatever their order; partial sums combine
    map-side, so no group is collected.
    """
    row_hash = F.xxhash64(*columns).cast("decimal(38,0)")
    return df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_hash).cast("string").alias("digest")
    )


def multiset_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose multiplicity differs, with both counts."""
    both = left.select(*columns, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*columns, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("l").alias("left_count"), F.sum("r").alias("right_count"))
        .filter("left_count <> right_count")
    )
