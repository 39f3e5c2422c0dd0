"""Hard negatives by best-first search in R-trees packed by sort-tile-recursion.

The rows are dealt over shards by ranges of their widest coordinate (the first tiling); within a shard the
rows of each label are tiled over the next coordinates down to leaves. A node is the least box around its
rows. The inner product of an anchor with anything in a box lies, coordinate by coordinate, between the
smaller and the larger of the products with the box's two sides; their sums bound the scores of the box.

A search keeps the boxes in a queue, the one with the highest bound first. A box is dropped if its bounds
lie outside the wanted scores or its upper bound is strictly below the k-th score found (an equal one may
still hold a smaller id). Anchors meet the shards in blocks; the best of each shard are merged per anchor.
First the positives are searched, in the trees of the anchor's label, then, with the windows that their
scores give, the negatives in the trees of all other labels.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

LEAF_ROWS, FAN_OUT = 128, 16
#: Rows of a shard and anchors of a block (about).
SHARD_ROWS, BLOCK_ANCHORS = 16_000, 4_000
POSITIVES, NEGATIVES = 5, 3
#: Negatives score at least and at most these percentages of the positive.
LOW, HIGH = 50, 95
SCALE = 256
LEAVES = "shard long, dims int, label int, leaf long, ids binary, vectors binary"
#: Sums below this are exact as doubles.
EXACT = 2.0**53
MOST = 10**38 - 1


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, label (shifted where vec_id is divisible by 7), vector of whole numbers."""
    whole = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), whole.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter("vec_id is not null and label is not null and vector is not null").filter(finite)
    shifted = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10)).cast("int")).otherwise(F.col("label"))
    return rows.withColumn("label", shifted).dropDuplicates(["vec_id", "label", "vector"])


def tiled(vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS) -> list[np.ndarray]:
    """Rows of each leaf: sort by the widest coordinate, cut into slabs, go on inside with the next one."""
    widest = np.argsort(-(vectors.max(0) - vectors.min(0)), kind="stable") if len(vectors) and vectors.shape[1] else np.empty(0, np.int64)

    def split(rows: np.ndarray, k: int) -> Iterator[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1:
            yield rows
            return
        if k >= len(widest):
            yield from np.array_split(rows, leaves)
            return
        # slabs as many as make the tiles alike over the coordinates left, two at least
        slabs = max(2, int(np.ceil(leaves ** (1 / (len(widest) - k)))))
        rows = rows[np.lexsort((ids[rows], vectors[rows, widest[k]]))]
        size = -(-leaves // slabs) * leaf
        for a in range(0, len(rows), size):
            yield from split(rows[a : a + size], k + 1)

    return list(split(np.arange(len(ids)), 0))


class Tree:
    """Leaves of one label in tiling order, under boxes of ``FAN_OUT`` boxes each, up to one root."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray]]):
        self.leaves = leaves
        low = np.array([v.min(0) for _, v in leaves])
        high = np.array([v.max(0) for _, v in leaves])
        self.levels = [(low, high)]
        while len(low) > 1:
            heads = np.arange(0, len(low), FAN_OUT)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            self.levels.append((low, high))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and highest possible score of each anchor in each box, level by level."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]


def _exact(*arrays: np.ndarray) -> bool:
    """Whether inner products of these whole numbers are exact as doubles."""
    most = max((float(np.abs(a).max(initial=0)) for a in arrays), default=0.0)
    return most * most * max(a.shape[1] for a in arrays) < EXACT


class Wanted:
    """The best ``k`` rows between two scores, kept by score falling, then id."""

    def __init__(self, k: int, low: int | None, high: int | None):
        self.k, self.low, self.high, self.found = k, low, high, []

    def open(self, least, most) -> bool:
        """Whether a box with these bounds may hold one more."""
        if self.high is not None and least > self.high or self.low is not None and most < self.low:
            return False
        return len(self.found) < self.k or most >= -self.found[-1][0]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.ones(len(scores), dtype=bool)
        if self.low is not None:
            good &= scores >= self.low
        if self.high is not None:
            good &= scores <= self.high
        if len(self.found) == self.k:
            good &= scores >= -self.found[-1][0]
        at = np.flatnonzero(good)
        if len(at) == 0:
            return
        best = at[np.lexsort((ids[at], -scores[at]))[: self.k]] if scores.dtype != object else sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))[: self.k]
        self.found = sorted(self.found + [(-int(scores[i]), int(ids[i])) for i in best])[: self.k]


def search(trees: list[Tree], bounds: list[list[tuple[np.ndarray, np.ndarray]]], row: int, anchor: np.ndarray, own_id: int, wanted: list[Wanted]) -> None:
    """Best-first search of one anchor over several trees, for all its wanted windows at once.

    ``bounds`` are those of ``Tree.bounds`` for the block in which the anchor is ``row``.
    """
    queue = []
    for t, levels in enumerate(bounds):
        top = len(levels) - 1
        queue.append((-levels[top][1][row, 0], t, top, 0))
    heapq.heapify(queue)
    while queue:
        most, t, level, node = heapq.heappop(queue)
        least, most = bounds[t][level][0][row, node], -most
        if not any(w.open(least, most) for w in wanted):
            # boxes behind this one have no higher bound: they end the search once every window is full
            if all(len(w.found) == w.k and most < -w.found[-1][0] for w in wanted):
                return
            continue
        if level:
            below_least, below_most = bounds[t][level - 1]
            for child in range(node * FAN_OUT, min((node + 1) * FAN_OUT, below_most.shape[1])):
                if any(w.open(below_least[row, child], below_most[row, child]) for w in wanted):
                    heapq.heappush(queue, (-below_most[row, child], t, level - 1, child))
            continue
        ids, vectors = trees[t].leaves[node]
        scores = vectors @ anchor
        other = ids != own_id
        if not other.all():
            ids, scores = ids[other], scores[other]
        for w in wanted:
            if w.open(least, most):
                w.add(scores, ids)


def _packed(leaf_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Leaves of the trees of one shard, one row each, label by label in tiling order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        ids = np.concatenate([np.asarray(b.column("vec_id")) for b in rows])
        labels = np.concatenate([np.asarray(b.column("label")) for b in rows])
        lists = pa.chunked_array([b.column("vector") for b in rows]).combine_chunks()
        sizes = np.diff(np.asarray(lists.offsets))
        flat = np.asarray(lists.flatten())
        starts = np.cumsum(sizes) - sizes
        out: dict[str, list] = {c.split()[0]: [] for c in LEAVES.split(", ")}
        for dims in np.unique(sizes).tolist():
            of_dims = sizes == dims
            for label in np.unique(labels[of_dims]).tolist():
                rows_of = np.flatnonzero(of_dims & (labels == label))
                vectors = np.floor(flat[starts[rows_of][:, None] + np.arange(dims)] * SCALE)
                for number, leaf in enumerate(tiled(vectors, ids[rows_of], leaf_rows)):
                    for c, v in zip(out, (shard, dims, label, number, ids[rows_of][leaf].tobytes(), vectors[leaf].tobytes())):
                        out[c].append(v)
        types = {"shard": pa.int64(), "dims": pa.int32(), "label": pa.int32(), "leaf": pa.int64(), "ids": pa.binary(), "vectors": pa.binary()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in out.items()})

    return run


def build_index(rows: DataFrame, shard_rows: int = SHARD_ROWS, leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, int]:
    """The leaves of all trees as a table of the shared folder, and the number of shards.

    Shards are ranges of the coordinate whose values spread most; rows with equal values are dealt by id,
    so a vector that a third of all rows share fills no shard.
    """
    spread = rows.select(F.posexplode("vector").alias("at", "x")).groupBy("at").agg(F.stddev("x").alias("spread"), F.count(F.lit(1)).alias("n"))
    widest = spread.agg(F.max_by("at", F.struct(F.coalesce("spread", F.lit(0.0)), -F.col("at"))).alias("at"), F.max("n").alias("n")).first()
    shards = max(1, -(-(widest["n"] or 0) // shard_rows))
    dealt = rows.repartitionByRange(shards, F.try_element_at("vector", F.lit((widest["at"] or 0) + 1)), F.col("vec_id"))
    return written(dealt.mapInArrow(_packed(leaf_rows), LEAVES), "leaves"), shards


def _trees(leaves: pa.Table, dims: int) -> tuple[list[int], list[Tree]]:
    """Labels and trees of one shard, the leaves in tiling order."""
    by_label: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for row in leaves.sort_by("leaf").select(["dims", "label", "ids", "vectors"]).to_pylist():
        if row["dims"] == dims:
            ids = np.frombuffer(row["ids"], np.int64)
            by_label.setdefault(row["label"], []).append((ids, np.frombuffer(row["vectors"], np.float64).reshape(len(ids), dims)))
    labels = sorted(by_label)
    return labels, [Tree(by_label[label]) for label in labels]


def _whole(x: np.ndarray, exact: bool) -> np.ndarray:
    """Whole numbers beyond what doubles hold become Python's."""
    return x if exact else np.array([[int(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def _each_anchor(anchors: pa.Table, leaves: pa.Table) -> Iterator[tuple[dict, list[int], list[Tree], list, int, np.ndarray]]:
    """Anchors of a block with the trees of the shard and their bounds, dimension by dimension."""
    rows = anchors.to_pylist()
    for dims in sorted({r["dims"] for r in rows}):
        own = [r for r in rows if r["dims"] == dims]
        vectors = np.array([np.frombuffer(r["vector"], np.float64) for r in own]).reshape(len(own), dims)
        labels, trees = _trees(leaves, dims)
        if not trees:
            continue
        exact = _exact(vectors, *[v for t in trees for _, v in t.leaves])
        if not exact:
            vectors = _whole(vectors, exact)
            trees = [Tree([(ids, _whole(v, exact)) for ids, v in t.leaves]) for t in trees]
        bounds = [t.bounds(vectors) for t in trees]
        for i, r in enumerate(own):
            yield r, labels, trees, bounds, i, vectors[i]


def _positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, leaves: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and leaves.num_rows:
            for r, labels, trees, bounds, i, vector in _each_anchor(anchors, leaves):
                own = [t for t, label in enumerate(labels) if label == r["label"]]
                wanted = Wanted(k, None, None)
                search([trees[t] for t in own], [bounds[t] for t in own], i, vector, r["anchor_id"], [wanted])
                out += [(r["anchor"], r["anchor_id"], id_, -score) for score, id_ in wanted.found]
        return _table(out, ["anchor", "anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, leaves: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and leaves.num_rows:
            for r, labels, trees, bounds, i, vector in _each_anchor(anchors, leaves):
                other = [t for t, label in enumerate(labels) if label != r["label"]]
                positives = [(p["positive_id"], int(p["positive_score"])) for p in r["positives"]]
                # whole scores between the percentages, both ends included
                wanted = [Wanted(k, -(-LOW * p // 100), HIGH * p // 100) for _, p in positives]
                live = [w for w in wanted if w.low <= w.high]
                if live:
                    search([trees[t] for t in other], [bounds[t] for t in other], i, vector, r["anchor_id"], live)
                for (positive, score), w in zip(positives, wanted):
                    out += [(r["anchor"], r["anchor_id"], positive, score, id_, -found) for found, id_ in w.found]
        return _table(out, ["anchor", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    """Ids as longs, scores as decimals of 38 digits."""
    columns = dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())
    scores = {c: pa.array([Decimal(min(max(x, -MOST), MOST)) for x in v], pa.decimal128(38, 0)) for c, v in columns.items() if c.endswith("score")}
    return pa.table({c: scores[c] if c in scores else pa.array(v, pa.int64()) for c, v in columns.items()})


def _as_long(score: str) -> F.Column:
    most, least = F.lit(Decimal(2**63 - 1)), F.lit(Decimal(-(2**63)))
    return F.greatest(F.least(F.col(score), most), least).cast("long").alias(score)


def hard_negatives(embeddings: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Different-label rows that score nearly as high as the best rows of an anchor's own label.

    ``embeddings`` has vec_id, embedding and label. A row takes part if its vec_id and label are not null
    and all components of its vector are finite numbers; where vec_id is divisible by 7 the label becomes
    (label + 1) % 10. Components become floor(256 * x); a score is the whole-number inner product with the
    anchor, higher ones first, ties by smaller vec_id. Anchors are the rows whose vec_id is divisible by
    ``every``. The positives of an anchor are its first ``positives`` other rows of the same label; for each
    of them the first ``negatives`` rows of other labels with 50 to 95 percent of its score are returned:
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Equal rows count once; rows that share a vec_id and differ are rows of their own, but none is another
    row to an anchor with its id. Vectors only meet vectors of the same length. Scores are compared exactly
    up to 38 digits; those beyond 64 bits are returned as the largest or smallest long. Other columns are not read; an empty
    table, or one without anchors, gives no row.
    """
    rows = written(usable_rows(embeddings), "rows")
    leaves, shards = build_index(rows, shard_rows, leaf_rows)
    chosen = rows.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-chosen.count() // block_anchors))
    anchors = chosen.select(
        F.xxhash64("vec_id", "label", "vector").alias("anchor"),
        F.col("vec_id").alias("anchor_id"),
        "label",
        F.size("vector").alias("dims"),
        F.col("vector"),
    ).withColumn("block", F.pmod("anchor", F.lit(blocks)))
    anchors = anchors.mapInArrow(_as_bytes, "anchor long, anchor_id long, label int, dims int, vector binary, block long")
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    meeting = leaves.select("*", every_block).groupBy("shard", "block")
    found = anchors.select("*", every_shard).groupBy("shard", "block").cogroup(meeting).applyInArrow(_positives(positives), "anchor long, anchor_id long, positive_id long, positive_score decimal(38,0)")
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id"))
    best = found.withColumn("rank", first).filter(F.col("rank") <= positives).groupBy("anchor").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = written(anchors.join(best, "anchor"), "asked")
    near = asked.select("*", every_shard).groupBy("shard", "block").cogroup(meeting).applyInArrow(
        _negatives(negatives), "anchor long, anchor_id long, positive_id long, positive_score decimal(38,0), negative_id long, negative_score decimal(38,0)"
    )
    place = F.row_number().over(Window.partitionBy("anchor", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", _as_long("positive_score"), _as_long("negative_score"))


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors scaled to whole numbers, as bytes of doubles."""
    for b in batches:
        vectors = [np.floor(np.array(v, np.float64) * SCALE).tobytes() for v in b.column("vector").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("anchor"), b.column("anchor_id"), b.column("label"), b.column("dims"), pa.array(vectors, pa.binary()), b.column("block")], ["anchor", "anchor_id", "label", "dims", "vector", "block"])
