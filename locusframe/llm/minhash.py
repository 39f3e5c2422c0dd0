"""Near-duplicate documents: universal hash minima, banding, verified links, connected components.

1. One pass over the texts gives each document's set of word shingles as a digest of the whole set and
   ``PERMUTATIONS`` minima of universal hash functions.
2. Documents with equal sets are one class from here on, so exact copies never meet each other.
3. Classes that agree in all ``ROWS`` minima of one of ``BANDS`` bands share a bucket. In each bucket the
   smallest class is compared with the others, first by signatures, then on the full sets.
4. Components are found by large-star and small-star. Buckets of three or more classes whose members are
   still in several components go on: their full sets meet in tiles of bounded size, every pair of
   different components is compared there, and a tile returns no more links than it has members.
5. Components are found again over all links.

With 32 bands of 4 rows a pair of similarity 0.8 shares no bucket with probability 5e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import U, WORD_BASE, mix, prefix, runs, slices, span, text_bytes, words_of
from .components import connected
from .store import written

PERMUTATIONS, BANDS, ROWS = 128, 32, 4
#: A pair whose signatures agree in this many percent points less than asked is not looked at again: more
#: than five standard deviations of the estimate (0.035 at a similarity of 0.8).
SLACK = 20
#: Classes in one tile of a bucket; a larger bucket is compared tile by tile.
TILE = 256
SAME_SET = ["n_shingles", "set_sum", "set_xor"]
BLOCK = 1024

_random = np.random.default_rng(20_240_607)
FACTORS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * U(2) + U(1)
SHIFTS = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct fingerprints of its word shingles (A-Z in lower case)."""
    data, offsets = text_bytes(column)
    for i, j in slices(offsets):
        words = words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
        sums = prefix(words.hashes(), WORD_BASE)
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
            if a == b:
                yield np.empty(0, np.uint64)
            else:
                starts = np.arange(a, max(a + 1, b - size + 1))
                found = np.sort(span(sums, starts, np.minimum(starts + size, b), WORD_BASE))
                yield found[runs(found)]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of (a x + b) mod 2**64 over the upper halves x of the fingerprints, as 32-bit numbers."""
    upper = shingles >> U(32)
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(upper), BLOCK):
        np.minimum(least, (np.multiply.outer(FACTORS, upper[k : k + BLOCK]) + SHIFTS[:, None]).min(axis=1), out=least)
    return (least >> U(32)).astype(np.uint32)


def digest(shingles: np.ndarray) -> tuple[int, int, int]:
    """Size, sum and exclusive or of a set: equal for equal sets."""
    if not len(shingles):
        return 0, 0, 0
    return len(shingles), int(mix(shingles).sum(dtype=np.uint64).astype(np.int64)), int(np.bitwise_xor.reduce(mix(shingles + U(0x632BE59BD9B4E019))).astype(np.int64))


def _signed(size: int) -> Callable:
    numbers = np.arange(BANDS, dtype=np.uint64) * U(0x9E3779B97F4A7C15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sums, xors, signs, bands = [], [], [], [], []
            for found in shingle_sets(batch.column("text"), size):
                for values, x in zip((n, sums, xors), digest(found)):
                    values.append(x)
                own = signature(found) if len(found) else np.empty(0, np.uint32)
                signs.append(own.tobytes())
                keys = np.empty(0, np.uint64)
                if len(found):
                    rows = own.reshape(BANDS, ROWS).astype(np.uint64)
                    keys = numbers
                    for r in range(ROWS):
                        keys = mix(keys ^ rows[:, r])
                bands.append(keys.astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums, pa.int64()), pa.array(xors, pa.int64()), pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_sum", "set_xor", "signature", "bands"],
            )

    return run


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(both) - same)


def _verified(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            keep = [_alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in zip(left, right)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _estimated(percent: int) -> Callable:
    least = (percent - SLACK) * PERMUTATIONS / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, PERMUTATIONS) for c in ("left", "right"))
            yield batch.select(["u", "v"]).filter(pa.array((a == b).sum(axis=1) >= least))

    return run


def _tile(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links that join the components within one tile; pairs of one component are not compared."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, part = table.column("id").to_pylist(), np.asarray(table.column("part"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        within = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        root: dict[int, int] = {c: c for c in table.column("component").to_pylist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        component = table.column("component").to_pylist()
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        found = []
        for i, own in enumerate(sets):
            mine = find(component[i])
            others = np.array([find(component[j]) != mine for j in range(i)], dtype=bool)
            if not within:
                others &= part[:i] != part[i]
            if not others.any():
                continue
            a, b = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
            at = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())
            same = np.bincount(owner[at], minlength=len(sets))[:i]
            for j in np.flatnonzero(others & (100 * same >= percent * (sizes[:i] + sizes[i] - same))).tolist():
                x, y = find(component[i]), find(component[j])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return run


def _own_sets(size: int) -> Callable:
    """Full sets of texts, of those whose set is that of their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column("text"), size))
            same = [digest(x) == want for x, want in zip(found, zip(*(batch.column(c).to_pylist() for c in SAME_SET)))]
            ids = batch.column("id").filter(pa.array(same, pa.bool_()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x, own in zip(found, same) if own], pa.binary())], names=["id", "shingles"])

    return run


def _sets_of(docs: DataFrame, classes: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Full sets of the given classes: id, shingles. A class is read from a document that has its set."""
    wanted = classes.select("id", F.col("least").alias("doc_id"), *SAME_SET).join(ids.select("id").distinct(), "id", "left_semi")
    texts = docs.join(wanted, "doc_id").withColumn("_print", F.xxhash64("text")).dropDuplicates(["doc_id", "id", "_print"]).drop("_print")
    return texts.mapInArrow(_own_sets(size), "id long, shingles binary")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Component of every document under links of ``percent`` similarity or more.

    ``docs`` has doc_id and text. Words are runs of bytes other than white space, A-Z in lower case; a
    document's set holds its distinct shingles of ``shingle_words`` words, or its whole sequence if it has
    fewer; without words or text it is empty and linked with nothing. Result, one row per row: doc_id,
    n_shingles, component_id (smallest doc_id reachable over links, itself included), kept (doc_id =
    component_id). Rows that share an id and differ in text are documents of their own, each with the links
    of its own set. Rows with a null doc_id are linked with nothing and kept, with a null component_id.
    Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed = written(texts.mapInArrow(_signed(shingle_words), "doc_id long, n_shingles long, set_sum long, set_xor long, signature binary, bands array<long>"), "signed")
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    # a class is a set of shingles, whatever ids its documents have; it is read from the smallest of them
    owners = written(usable.groupBy(*SAME_SET).agg(F.min("doc_id").alias("least")).withColumn("id", F.monotonically_increasing_id()), "owners")
    classes = signed.select("signature", "bands", F.col("doc_id").alias("least"), *SAME_SET).join(owners, ["least", *SAME_SET]).select("id", "least", *SAME_SET, "signature", "bands")
    classes = written(classes.dropDuplicates(["id"]), "classes")

    member = classes.select("id", F.explode("bands").alias("bucket"))
    buckets = member.groupBy("bucket").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(member.join(buckets, "bucket"), "shared")
    pairs = shared.filter("id <> first").select(F.col("first").alias("u"), F.col("id").alias("v")).distinct()
    sign = classes.select("id", "signature")
    looked = (
        pairs.join(sign.select(F.col("id").alias("u"), F.col("signature").alias("left")), "u")
        .join(sign.select(F.col("id").alias("v"), F.col("signature").alias("right")), "v")
        .mapInArrow(_estimated(percent), "u long, v long")
    )
    looked = written(looked, "looked")
    # the texts are read a second time, once, for the full sets of all classes that share a bucket
    sets = written(_sets_of(texts, classes, shared, shingle_words), "sets")
    links = (
        looked.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("left")), "u")
        .join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("right")), "v")
        .mapInArrow(_verified(percent), "u long, v long")
    )
    links = written(links, "links")
    labels = connected(links)
    links = links.unionByName(_links_within(sets, shared, labels, percent))
    labels = connected(links).withColumnsRenamed({"node": "id", "component": "label"})

    # each document by its class, and each class by the smallest document of its component
    owned = owners.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = owned.groupBy("label").agg(F.min("least").alias("component_id"))
    named = owned.join(least, "label").select(*SAME_SET, "component_id")
    joined = signed.select("doc_id", *SAME_SET).join(named, SAME_SET, "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id")
    return joined.select("doc_id", "n_shingles", component).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links_within(sets: DataFrame, shared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between different components inside the buckets that hold three classes or more."""
    named = shared.filter("n > 2").join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("held"), F.bit_xor(F.xxhash64("id")).alias("who"), F.sum(F.xxhash64("id", F.lit(1)).cast("decimal(38,0)")).alias("sum")).filter("a <> b")
    # bands often repeat the same members: one bucket of each kind is enough
    single = mixed.groupBy("held", "who", "sum").agg(F.min("bucket").alias("bucket")).select("bucket", "held")
    rest = written(named.join(single, "bucket").select("bucket", "id", "component", F.ceil(F.col("held") / TILE).cast("int").alias("parts")), "rest")
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int")
    tiles = rest.withColumn("part", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = tiles.select("bucket", "id", "component", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    return tiles.join(sets, "id").groupBy("bucket", "low", "high").applyInArrow(_tile(percent), "u long, v long")
