"""Running values along an integer order without one task per key.

A plain window over a whole contig or file would put that contig or file into one task. Here the
order column is cut into tiles of ``width`` positions. Each tile runs its own window; one summary
row per tile carries the running value across tiles. The summary rows are tiled once more: those of
``tiles`` neighbouring tiles form a block, blocks carry to each other by one row each, and the blocks'
values go back to their tiles. So a key that holds most of the rows spreads over all executors, and no
step orders more than one row per ``width * tiles`` positions of a key in one task.
Callers make ``(keys, order)`` unique first, which also bounds a tile to ``width`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

TILE, BLOCK = "_tile", "_block"
WIDTH, TILES = 65_536, 4_096


@dataclass(frozen=True)
class Running:
    """One running value: ``sum``, ``max`` or ``last`` (last non-null) of a column."""

    kind: str
    column: str
    inclusive: bool = True


def _tiled(df: DataFrame, keys: list[str], order: str, width: int) -> DataFrame:
    """Add the tile. The null checks are those a join on the keys implies; stating them here keeps both
    uses of the rows (summary and detail) one plan, so the shuffle below them is reused."""
    tiled = df.withColumn(TILE, F.floor(F.col(order) / width).cast("bigint"))
    present = F.col(TILE).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    return tiled.filter(present)


def _on(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    condition = left[TILE] == right[TILE]
    for key in keys:
        condition = condition & (left[key] == right[key])
    return condition


def _join_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    joined = df.join(carry, _on(keys, df, carry), "left")
    for name in [*keys, TILE]:
        joined = joined.drop(carry[name])
    return joined


def _before(spec: Running, value: Column, frame: WindowSpec) -> Column:
    """The running value of the rows in ``frame``."""
    return F.last(value, ignorenulls=True).over(frame) if spec.kind == "last" else getattr(F, spec.kind)(value).over(frame)


def _both(spec: Running, early: Column, late: Column) -> Column:
    """Two running values in a row as one; a null stands for no rows."""
    if spec.kind == "last":
        return F.coalesce(late, early)
    if spec.kind == "max":
        return F.greatest(early, late)
    return F.when(early.isNotNull() | late.isNotNull(), F.coalesce(early, F.lit(0)) + F.coalesce(late, F.lit(0)))


def carried(per_tile: DataFrame, keys: list[str], specs: dict[str, Running], tiles: int = TILES) -> DataFrame:
    """The value of each spec before each tile, from one summary row per tile (columns ``_c_<spec>``).

    Tiles and blocks of tiles run through the same steps as rows of one table, so the rows that make
    them are read once: first blocks among themselves and tiles inside their block, then each block's
    value meets its tiles.
    """
    placed = per_tile.withColumn(BLOCK, F.floor(F.col(TILE) / tiles).cast("bigint"))
    sums = []
    for out, spec in specs.items():
        value = F.col(f"_c_{out}")
        whole = F.max(F.when(value.isNotNull(), F.struct(F.col("_t"), value.alias("v"))))["v"] if spec.kind == "last" else getattr(F, spec.kind)(value)
        sums.append(whole.alias(f"_c_{out}"))
    # a block's row has no tile
    both = placed.withColumn("_t", F.col(TILE)).groupingSets([[*keys, BLOCK, TILE], [*keys, BLOCK]], *keys, BLOCK, TILE).agg(*sums)
    alone = F.when(F.col(TILE).isNull(), F.lit(-1)).otherwise(F.col(BLOCK))
    order = Window.partitionBy(*keys, "_of").orderBy(F.coalesce(TILE, BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    inner = both.withColumn("_of", alone).select(*keys, BLOCK, TILE, *[_before(s, F.col(f"_c_{o}"), order).alias(f"_c_{o}") for o, s in specs.items()])
    of_block = Window.partitionBy(*keys, BLOCK).orderBy(F.asc_nulls_first(TILE)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = {o: _both(s, F.first(f"_c_{o}").over(of_block), F.col(f"_c_{o}")).alias(f"_c_{o}") for o, s in specs.items()}
    return inner.select(*keys, TILE, *joined.values()).filter(F.col(TILE).isNotNull())


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    specs: dict[str, Running],
    width: int = WIDTH,
    keep_tile: bool = False,
    moves: DataFrame | None = None,
    tiles: int = TILES,
) -> DataFrame:
    """Add one running column per spec, ordered by ``order`` inside ``keys``.

    The carried values are joined on (keys, tile), on which the rows are dealt for their local pass
    anyway; Spark broadcasts them only where their measured size allows. ``moves`` are rows that give the
    same values per tile and are cheaper to make than ``df``. ``keep_tile`` leaves the tile column for a
    following pass over the same tiles.
    """
    tiled = _tiled(df, keys, order, width)

    summaries = {}
    for out, spec in specs.items():
        if spec.kind == "last":
            present = F.when(F.col(spec.column).isNotNull(), F.struct(F.col(order), F.col(spec.column)))
            summaries[out] = F.max(present)[spec.column]
        else:
            summaries[out] = getattr(F, spec.kind)(spec.column)
    source = tiled if moves is None else _tiled(moves, keys, order, width)
    per_tile = source.groupBy(*keys, TILE).agg(*[c.alias(f"_c_{o}") for o, c in summaries.items()])
    joined = _join_carry(tiled, carried(per_tile, keys, specs, tiles), keys)

    local = Window.partitionBy(*keys, TILE).orderBy(order)

    def value(out: str, spec: Running) -> Column:
        frame = local.rowsBetween(Window.unboundedPreceding, 0 if spec.inclusive else -1)
        carried_in = F.col(f"_c_{out}")
        if spec.kind == "last":
            return F.coalesce(F.last(spec.column, ignorenulls=True).over(frame), carried_in)
        if spec.kind == "max":
            return F.greatest(F.max(spec.column).over(frame), carried_in)
        inside = F.sum(spec.column).over(frame)
        return F.coalesce(inside, F.lit(0)) + F.coalesce(carried_in, F.lit(0))

    done = joined.withColumns({o: value(o, s) for o, s in specs.items()}).drop(*[f"_c_{o}" for o in specs])
    return done if keep_tile else done.drop(TILE)


def following(df: DataFrame, keys: list[str], order: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add the next larger order value inside ``keys`` (null on the last row).

    Every row but the last of a tile finds it in its own tile. The last one needs the first row of the
    next tile that has any: the first and last rows of all tiles of a key meet in one group, two rows per
    ``width`` positions, while all others keep to their tile; so the rows are read once and never joined.
    """
    tiled = df if TILE in df.columns else _tiled(df, keys, order, width)
    local = Window.partitionBy(*keys, TILE).orderBy(order)
    ends = tiled.withColumns({"_next": F.lead(order).over(local), "_first": F.lag(order).over(local).isNull()})
    edge = F.col("_first") | F.col("_next").isNull()
    across = Window.partitionBy(*keys, "_of").orderBy(order)
    met = ends.withColumn("_of", F.when(edge, F.lit(-1)).otherwise(F.col(TILE))).withColumn("_later", F.lead(order).over(across))
    return met.withColumn(out, F.coalesce("_next", "_later")).drop(TILE, "_of", "_next", "_first", "_later")


def previous(
    df: DataFrame, keys: list[str], order: str, columns: list[str], out: str, width: int = WIDTH
) -> DataFrame:
    """Add the previous row's columns as a struct (null on the first row)."""
    packed = df.withColumn("_row", F.struct(*columns))
    return running(packed, keys, order, {out: Running("last", "_row", inclusive=False)}, width).drop("_row")
