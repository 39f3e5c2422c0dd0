"""Collocations of two and three words, counted in counting quotient filters.

Words that occur often enough get a number of their own per language; a phrase of up to three words packs
their numbers into one whole number of ``3 * width`` bits. An invertible permutation (a Feistel network)
spreads the packed numbers evenly; its upper bits are the quotient, all the rest is kept as the remainder,
so nothing is lost and a counter tells its phrase. A filter holds, for the quotients of one shard, a bit for
each quotient that occurs, a bit for each entry that ends the run of its quotient, the remainders in order
and counters of one byte (a longer one takes an escape and eight more bytes). Filters are sorted by
construction, so those of all chunks of text are merged per shard and come out in order again.

A chunk counts all its phrases before anything is shuffled: a phrase in every text costs a counter a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import LOWER, U, mix, runs, text_bytes
from .store import written

CHUNK_BYTES = 8 << 20
#: Bytes of filters for which there is one shard, and those that a byte of text makes at most (about).
SHARD_BYTES, FILTER_BYTES = 16 << 20, 3
LEAST, TOP, MOST_WORDS = 10, 2000, 3
UNKNOWN = "und"
#: Groups of words that are numbered on their own; a number is made of both.
NUMBER_GROUPS = 64
QUOTIENT_BITS = 20
#: Phrases of a language that one task ranks.
RANKED_ROWS = 50_000
FILTERS = "shard long, entries long, occupied binary, ends binary, remainders binary, counts binary, long_counts binary"

SPACE, END = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
SPACE[[9, 32]] = True
END[[10, 11, 12, 13, *b".,;:!?"]] = True


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, A-Z in lower case, and the number of the piece that each is in."""
    data = LOWER[data]
    end = END[data]
    solid = ~(end | SPACE[data])
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    head = solid.copy()
    head[1:] &= ~solid[:-1] | breaks[1:-1]
    starts = np.flatnonzero(head)
    piece = np.cumsum(end | breaks[:-1])[starts]
    letters = data[solid]
    before = np.concatenate([[0], np.cumsum(solid)])[starts]
    bounds = np.append(before, len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters.tobytes())])
    return words, piece


def _languages(table: pa.Table) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """The words of a chunk, language by language."""
    if table.num_rows == 0:
        return
    table = table.sort_by("lang")
    data, offsets = text_bytes(table.column("text"))
    langs = table.column("lang").combine_chunks().dictionary_encode()
    codes = np.asarray(langs.indices)
    for a, b in zip(heads := runs(codes).tolist(), [*heads[1:], len(codes)]):
        own = offsets[a : b + 1]
        words, piece = pieces_of(data[own[0] : own[-1]], own - own[0])
        yield langs.dictionary[int(codes[a])].as_py(), words, piece


def _words(table: pa.Table) -> pa.Table:
    """Distinct words of a chunk by language, and how often each occurs."""
    parts = []
    for lang, words, _ in _languages(table):
        coded = words.dictionary_encode()
        n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
        parts.append((lang, coded.dictionary, n))
    chunk = table.column("chunk")[0].as_py()
    total = sum(len(n) for *_, n in parts)
    return pa.table(
        {
            "chunk": pa.array([chunk] * total, pa.int64()),
            "lang": pa.array([lang for lang, _, n in parts for _ in range(len(n))], pa.string()),
            "word": pa.chunked_array([w.cast(pa.binary()) for _, w, _ in parts], pa.binary()),
            "n": pa.array(np.concatenate([n for *_, n in parts]) if parts else np.empty(0, np.int64), pa.int64()),
        }
    )


class Packing:
    """Packed phrases of ``bits`` bits, permuted into a quotient of ``q`` bits and a remainder of the rest."""

    def __init__(self, width: int):
        self.width, self.bits = width, 3 * width
        # the remainder fits one 64-bit number, and so does the quotient
        self.q = max(min(QUOTIENT_BITS, self.bits - 1), self.bits - 62)
        self.r = self.bits - self.q
        if self.q > 62:
            raise ValueError(f"word numbers of {width} bits are too long to pack")
        self.q_mask, self.r_mask = U((1 << self.q) - 1), U((1 << self.r) - 1)

    def _round(self, x: np.ndarray, i: int, mask: np.ndarray) -> np.ndarray:
        return mix(x + U(0x9E3779B97F4A7C15 * (i + 1) % 2**64)) & mask

    def permuted(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quotient and remainder of phrases given by word numbers; a missing word is 0."""
        high, low = self._halves(first, second, third)
        for i in range(4):
            if i % 2 == 0:
                high = high ^ self._round(low, i, self.q_mask)
            else:
                low = low ^ self._round(high, i, self.r_mask)
        return high, low

    def words(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The word numbers of permuted phrases: ``permuted`` undone."""
        for i in reversed(range(4)):
            if i % 2 == 0:
                high = high ^ self._round(low, i, self.q_mask)
            else:
                low = low ^ self._round(high, i, self.r_mask)
        return tuple(self._field(high, low, k * self.width) for k in (2, 1, 0))

    def _halves(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The packed number, cut into its upper ``q`` and lower ``r`` bits."""
        high = low = np.zeros(len(first), np.uint64)
        for k, x in ((2, first), (1, second), (0, third)):
            at = k * self.width
            x = x.astype(np.uint64)
            if at < self.r:
                low = low | (x << U(at)) & self.r_mask
            if at + self.width > self.r:
                high = high | (x << U(at - self.r) if at >= self.r else x >> U(self.r - at))
        return high, low

    def _field(self, high: np.ndarray, low: np.ndarray, at: int) -> np.ndarray:
        mask = U((1 << self.width) - 1)
        if at >= self.r:
            return ((high >> U(at - self.r)) & mask).astype(np.int64)
        x = low >> U(at)
        if at + self.width > self.r:
            x = x | (high << U(self.r - at))
        return (x & mask).astype(np.int64)


def _counted(high: np.ndarray, low: np.ndarray, n: np.ndarray | None, r: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (quotient, remainder) in order with the sum of their counts."""
    if bits <= 64:  # both in one number: one sort
        key = (high << U(r)) | low
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
    else:
        order = np.lexsort((low, high))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    heads = np.flatnonzero(new)
    if len(heads) == 0:
        return high, low, np.empty(0, np.int64)
    many = np.diff(np.append(heads, len(order))) if n is None else np.add.reduceat(n[order], heads)
    return high[order[heads]], low[order[heads]], many


def to_filter(quotient: np.ndarray, remainder: np.ndarray, n: np.ndarray, span: int, r: int) -> dict[str, object]:
    """A filter of entries in order; ``quotient`` counts from the first quotient of the shard, below ``span``."""
    occupied = np.zeros(span, dtype=bool)
    occupied[quotient.astype(np.int64)] = True
    ends = np.ones(len(quotient), dtype=bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    size = -(-r // 8)
    big = n >= 255
    return {
        "entries": len(quotient),
        "occupied": np.packbits(occupied).tobytes(),
        "ends": np.packbits(ends).tobytes(),
        "remainders": np.ascontiguousarray(remainder.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes(),
        "counts": np.where(big, 255, n).astype(np.uint8).tobytes(),
        "long_counts": n[big].astype("<i8").tobytes(),
    }


def from_filter(row: dict[str, object], span: int, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a filter: quotient within the shard, remainder, count."""
    entries, size = row["entries"], -(-r // 8)
    held = np.flatnonzero(np.unpackbits(np.frombuffer(row["occupied"], np.uint8), count=span))
    ends = np.unpackbits(np.frombuffer(row["ends"], np.uint8), count=entries).astype(bool)
    # the run of an entry is the number of runs that ended before it
    quotient = held[np.concatenate([[0], np.cumsum(ends)[:-1]])] if entries else held
    whole = np.zeros((entries, 8), np.uint8)
    whole[:, :size] = np.frombuffer(row["remainders"], np.uint8).reshape(entries, size)
    n = np.frombuffer(row["counts"], np.uint8).astype(np.int64)
    n[n == 255] = np.frombuffer(row["long_counts"], "<i8")
    return quotient.astype(np.uint64), whole.view("<u8").ravel().astype(np.uint64), n


def _filters(width: int, shard_bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The filters of a chunk, one row per shard that has entries."""
    packing = Packing(width)
    below = packing.q - shard_bits

    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        highs, lows = [], []
        for lang, words, piece in _languages(table):
            own = known.filter(pc.equal(known.column("lang"), lang))
            coded = words.dictionary_encode()
            values = own.column("word").combine_chunks().cast(pa.large_binary())
            at = pc.index_in(coded.dictionary, value_set=values).fill_null(-1).to_numpy(zero_copy_only=False)
            # a word without a number is 0 and takes part in no phrase
            numbers = np.append(np.asarray(own.column("number")), 0)[at]
            number = numbers[np.asarray(coded.indices)]
            for k in range(2, MOST_WORDS + 1):
                if len(number) < k:
                    continue
                last = len(number) - k + 1
                fits = piece[:last] == piece[k - 1 :]
                for j in range(k):
                    fits &= number[j : last + j] > 0
                start = np.flatnonzero(fits)
                high, low = packing.permuted(number[start], number[start + 1], number[start + 2] if k == 3 else np.zeros(len(start), np.int64))
                highs.append(high)
                lows.append(low)
        high = np.concatenate(highs) if highs else np.empty(0, np.uint64)
        low = np.concatenate(lows) if lows else np.empty(0, np.uint64)
        high, low, n = _counted(high, low, None, packing.r, packing.bits)
        shard = (high >> U(below)).astype(np.int64)
        heads = runs(shard).tolist()
        rows = [
            {"shard": int(shard[a])} | to_filter(high[a:b] & U((1 << below) - 1), low[a:b], n[a:b], 1 << below, packing.r)
            for a, b in zip(heads, [*heads[1:], len(shard)])
        ]
        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in FILTERS.split(", ")])
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _merged(width: int, shard_bits: int, least: int) -> Callable[[pa.Table], pa.Table]:
    """The phrases of a shard that occur often enough, from the filters of all chunks."""
    packing = Packing(width)
    below = packing.q - shard_bits

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [from_filter(row, 1 << below, packing.r) for row in table.to_pylist()]
        high, low, n = (np.concatenate(x) for x in zip(*parts))
        high, low, n = _counted(high, low, n, packing.r, packing.bits)
        often = n >= least
        first, second, third = packing.words((high[often] | U(shard) << U(below)), low[often])
        return pa.table({"w1": pa.array(first), "w2": pa.array(second), "w3": pa.array(third), "a": pa.array(n[often])})

    return run


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of two and three words of each language by how much more often they occur than chance.

    ``docs`` has text and lang (null: ``und``). A text with A-Z in lower case is cut at ``[.,;:!?\\x0A-\\x0D]``
    into pieces and those into words ``[^\\x20\\x09]+``; a null text has none. Per language n counts all
    words and f a phrase's occurrences within pieces. Phrases with ``a = f >= least`` are scored by each cut
    into two parts, floor(1000000 * a * a / (l * r)) with l and r the counts of the parts; the lowest cut
    counts, of equal ones the first. Two words that lie in a phrase of three that is at least half as
    frequent are left out. Result: lang, rank (from 1), phrase, a, l, r, n, score, by score and a falling,
    then by phrase in byte order. Products are exact below 38 digits. Other columns are not read; an empty
    table gives no row.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    own = F.coalesce(F.col("doc_id").cast("long"), F.monotonically_increasing_id()) if "doc_id" in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(F.pmod(F.xxhash64(own, F.octet_length("text")), F.lit(chunks)).alias("chunk"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text"))
    by_chunk = rows.groupBy("chunk")
    words = written(by_chunk.applyInArrow(_words, "chunk long, lang string, word binary, n long"), "words")
    counts = written(words.groupBy("lang", "word").agg(F.sum("n").alias("f")), "counts")
    groups = max(NUMBER_GROUPS, chunks // 16)
    group = F.pmod(F.xxhash64("lang", "word"), F.lit(groups))
    place = F.row_number().over(Window.partitionBy("group").orderBy("lang", "word"))
    known = counts.filter(F.col("f") >= least).withColumn("group", group).withColumn("number", (place - 1) * groups + F.col("group") + 1)
    known = written(known.select("number", "lang", "word", "f"), "numbers")
    width = int(known.agg(F.max("number")).first()[0] or 1).bit_length()
    shard_bits = min(Packing(width).q, max(0, (size * FILTER_BYTES // SHARD_BYTES).bit_length()))
    in_chunk = words.select("chunk", "lang", "word").join(known.select("lang", "word", "number"), ["lang", "word"])
    filters = by_chunk.cogroup(in_chunk.groupBy("chunk")).applyInArrow(_filters(width, shard_bits), FILTERS)
    often = filters.groupBy("shard").applyInArrow(_merged(width, shard_bits, least), "w1 long, w2 long, w3 long, a long")
    return ranked(written(often, "phrases"), known, counts.groupBy("lang").agg(F.sum("f").alias("n")), top)


def _score(a: str, l: str, r: str) -> F.Column:
    """floor(1000000 * a * a / (l * r)), exact: products are whole decimals of up to 38 digits."""
    a, l, r = (f"cast({x} as decimal(15,0))" for x in (a, l, r))
    return F.expr(f"cast(1000000 as decimal(7,0)) * ({a} * {a}) div ({l} * {r})")


def ranked(phrases: DataFrame, known: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """Score the counted phrases (w1, w2, w3, a; w3 0 for two words), drop those inside longer ones, take the best."""
    two, three = phrases.filter("w3 = 0"), phrases.filter("w3 > 0")

    def of(k: int, *columns: str) -> DataFrame:
        named = {"number": f"w{k}", "word": f"word{k}", "f": f"f{k}"}
        return known.select("number", *columns).withColumnsRenamed(named)

    pair = two.select("w1", "w2", F.col("a").alias("pair"))
    longest = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("longest"))
    kept = two.join(longest, ["w1", "w2"], "left").filter("longest is null or 100 * longest < 50 * a")
    both = kept.join(of(1, "lang", "word", "f"), "w1").join(of(2, "word", "f"), "w2")
    columns = ["lang", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "score"]
    blank = F.lit(b" ")
    scored_two = both.select("lang", F.concat("word1", blank, "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score")).select(*columns)
    all_three = (
        three.join(of(1, "lang", "word", "f"), "w1")
        .join(of(3, "word", "f"), "w3")
        .join(pair.withColumnRenamed("pair", "front"), ["w1", "w2"])
        .join(pair.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("pair").alias("back")), ["w2", "w3"])
        .join(of(2, "word"), "w2")
    )
    cut = F.least(
        F.struct(_score("a", "f1", "back").alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.col("back").alias("r")),
        F.struct(_score("a", "front", "f3").alias("score"), F.lit(2).alias("k"), F.col("front").alias("l"), F.col("f3").alias("r")),
    )
    scored_three = all_three.withColumn("cut", cut).select("lang", F.concat("word1", blank, "word2", blank, "word3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score").select(*columns)
    best = scored_two.unionByName(scored_three)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # parts of a language first, so that no task ranks more than a bounded number of its phrases
    parts = -(-phrases.count() // RANKED_ROWS)
    while parts > 1:
        salted = best.withColumn("part", F.pmod(F.xxhash64("phrase", F.lit(parts)), F.lit(parts)))
        best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top).drop("part", "rank")
        parts = min(parts - 1, -(-parts * top // RANKED_ROWS))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
