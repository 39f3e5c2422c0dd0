"""Digests of long things from the digests of their pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_OUT, LEVELS = 256, 5


def digest_tree(pieces: DataFrame, keys: list[str], place: str, digest: str, weight: str, fan_out: int = FAN_OUT, levels: int = LEVELS) -> DataFrame:
    """``keys`` with ``pieces``, the summed ``weight`` and ``digest``, the root over all pieces of a key.

    ``place`` numbers the pieces of a key from 0. A node is the SHA-256 of the digests of up to ``fan_out``
    children, joined in order as text; a node of one child is that child, so the height of the tree follows
    from the number of pieces. No group ever holds more than ``fan_out`` digests, however long a key is. A
    key of more than ``fan_out ** levels`` pieces fails the job.
    """
    nodes = pieces.select(*keys, F.col(place).cast("bigint").alias("_at"), F.col(digest).alias("_d"), F.col(weight).cast("bigint").alias("_w"), F.lit(1).cast("bigint").alias("_n"))
    for _ in range(levels):
        children = F.array_sort(F.collect_list(F.struct("_at", "_d")))
        grouped = nodes.groupBy(*keys, F.floor(F.col("_at") / fan_out).cast("bigint").alias("_up")).agg(children.alias("_c"), F.sum("_w").alias("_w"), F.sum("_n").alias("_n"))
        joined = F.sha2(F.array_join(F.transform("_c", lambda c: c["_d"]), ""), 256)
        nodes = grouped.select(*keys, F.col("_up").alias("_at"), F.when(F.size("_c") == 1, F.col("_c")[0]["_d"]).otherwise(joined).alias("_d"), "_w", "_n")
    root = F.when(F.col("_at") == 0, F.col("_d")).otherwise(F.raise_error(F.lit("more pieces than the levels of the tree can hold")))
    return nodes.select(*keys, F.col("_n").alias("pieces"), F.col("_w").alias(weight), root.alias(digest))
