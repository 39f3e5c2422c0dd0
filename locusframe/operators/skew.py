"""Joins and per-group picks that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
SALT = "_salt"


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of salts each one gets.

    At most ``rows / hot_rows`` keys can qualify, so this table is small by construction.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )


def salted_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join (inner, left or left_semi) of a side that may repeat a key a huge number of times.

    Rows of a hot key on the large side are spread over salts by a hash of the row; the matching
    rows of the small side are repeated once per salt. Keys that are not hot get salt 0 on both
    sides, so nothing else is duplicated and no row is dropped. Pass ``hot`` when the hot keys were
    already counted on a cheaper projection of the same rows.
    """
    hot = F.broadcast(hot_keys(large, keys, hot_rows) if hot is None else hot)
    spread = F.coalesce(F.pmod(F.xxhash64(*[F.col(c) for c, t in large.dtypes if "map<" not in t]), F.col("_salts")), F.lit(0))
    left = large.join(hot, keys, "left").withColumn(SALT, spread).drop("_salts")
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    right = (
        small.join(hot, keys, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
        .drop("_salts")
    )
    return left.join(right, [*keys, SALT], how).drop(SALT)


def best_row_ids(df: DataFrame, keys: list[str], rank: list[Column], row_id: str) -> DataFrame:
    """The id of the first row of every group under ``rank`` (ascending), one row per group.

    A min over structs combines on the map side, so a huge group never gathers in one task.
    ``row_id`` breaks ties; it must be unique.
    """
    ranked = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)], F.col(row_id).alias("id"))
    return df.groupBy(*keys).agg(F.min(ranked)["id"].alias(row_id))
