"""Packing of tokenised documents into sequences of a fixed capacity by swap-based local search.

Documents longer than a sequence are cut into full pieces and a rest. Pieces are dealt into shards of a
bounded number of pieces; each shard is filled best fit first and then improved: one-for-one and
two-for-one exchanges and moves between underfull bins, each raising the sum of squared fills, until the
emptiest bins can be dissolved or nothing improves. The bins still underfull in their shards meet in a
second round, so what is wasted does not grow with the number of shards.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, encoded
from .store import written

CAPACITY = 2048
#: Pieces that one shard holds about; more pieces make more shards.
SHARD_PIECES = 20_000
#: Bins filled to this share are left alone after the first round.
CLOSED_FILL = 0.98
#: Bits of a sequence id that count the bins of a shard.
BIN_BITS = 24
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, shard long, bin long, offset long, open boolean"


def pieces_of(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Token pieces of every whole text: its ids and ``end_id``, cut only where longer than ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary.load()
        for batch, ids, offsets in encoded(batches, bpe):
            whole = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
            bounds = (offsets + np.arange(len(offsets))).tolist()
            rows, piece, start, length, crc = [], [], [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                for k, at in enumerate(range(a, b, capacity)):
                    to = min(at + capacity, b)
                    rows.append(i)
                    piece.append(k)
                    start.append(at - a)
                    length.append(to - at)
                    crc.append(zlib.crc32(whole[at:to].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items, longest first, each into the fullest bin that still holds it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while some bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        by_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return bins


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Move and exchange items between underfull bins while the sum of squared fills grows.

    The emptiest bin gives: each of its items moves whole into a fuller bin, or goes there in exchange for
    one or two smaller items that the giver takes back. Every step makes a fuller bin fuller, so the
    search ends; bins that become empty are dropped.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    open_bins = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: (fill[k], k))
    for giver in open_bins:
        takers = sorted((k for k in open_bins if k != giver and bins[k] and fill[giver] <= fill[k] < capacity), key=lambda k: (-fill[k], k))
        improved = True
        while improved and bins[giver]:
            improved = False
            for item in sorted(bins[giver], key=lambda i: -lengths[i]):
                if _give(item, giver, takers, bins, fill, lengths, capacity):
                    improved = True
                    break
    return [b for b in bins if b]


def _give(item: int, giver: int, takers: list[int], bins: list[list[int]], fill: list[int], lengths: list[int], capacity: int) -> bool:
    size = lengths[item]
    for taker in takers:
        room = capacity - fill[taker]
        if room == 0 or fill[taker] < fill[giver]:
            continue
        back = _trade(size, room, bins[taker], lengths)
        if back is None:
            continue
        gain = size - sum(lengths[i] for i in back)
        bins[giver].remove(item)
        bins[taker].append(item)
        for i in back:
            bins[taker].remove(i)
            bins[giver].append(i)
        fill[taker] += gain
        fill[giver] -= gain
        return True
    return False


def _trade(size: int, room: int, held: list[int], lengths: list[int]) -> list[int] | None:
    """What to give back for an item: nothing, one item or two, so that the taker gains most; or None."""
    if size <= room:
        return []
    ordered = sorted(held, key=lambda i: lengths[i])
    values = [lengths[i] for i in ordered]
    least, best, chosen = size - room, size, None
    # the smallest sum of one or two items of at least `least` and less than `size`
    at = bisect_right(values, least - 1)
    if at < len(values) and values[at] < best:
        best, chosen = values[at], [ordered[at]]
    low, high = 0, len(values) - 1
    while low < high:
        both = values[low] + values[high]
        if both >= least:
            if both < best:
                best, chosen = both, [ordered[low], ordered[high]]
            high -= 1
        else:
            low += 1
    return chosen


def _shard_packer(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(order)
        lengths = table.column("length").to_pylist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        number, offset, open_ = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), np.empty(len(lengths), bool)
        for k, items in enumerate(bins):
            at = 0
            for i in items:
                number[i], offset[i] = k, at
                at += lengths[i]
            open_[items] = at < CLOSED_FILL * capacity
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32", "shard"])
        return table.append_column("bin", pa.array(number)).append_column("offset", pa.array(offset)).append_column("open", pa.array(open_))

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Assign every piece a sequence and a gapless place in it.

    ``pieces`` has doc_id, piece, start, length (1 to ``capacity``) and ids_crc32; rows may repeat and
    doc_id may be null, each row is a piece of its own. Result: those columns, sequence_id, offset. An
    empty table gives an empty result.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kept = written(pieces.select(*names), "pieces")
    shards = max(1, -(-kept.count() // shard_pieces))
    row = F.xxhash64(*[F.col(c) for c in names])
    first = written(kept.withColumn("shard", F.pmod(row, F.lit(shards))).groupBy("shard").applyInArrow(_shard_packer(capacity), PLACED), "packed")
    number = (F.col("shard") * F.lit(1 << BIN_BITS) + F.col("bin")).alias("sequence_id")
    if shards == 1:
        return first.select(*names, number, "offset")
    left = first.filter("open").select(*names)
    again = max(1, -(-left.count() // shard_pieces))
    second = left.withColumn("shard", F.lit(shards) + F.pmod(row, F.lit(again))).groupBy("shard").applyInArrow(_shard_packer(capacity), PLACED)
    return first.filter("not open").unionByName(second).select(*names, number, "offset")


def pack_documents(docs: DataFrame, vocabulary: Vocabulary, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack whole documents (doc_id, text); a null text counts as empty: one end token."""
    return pack(pieces_of(docs, vocabulary, capacity), capacity)
