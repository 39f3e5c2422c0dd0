"""Substring deduplication by recompression.

Every chunk of documents is parsed in rounds: first maximal runs of one token, then pairs of adjacent
symbols, get a name of their own. A pair is named where a bit of the left symbol's name is 0 and that of
the right one's is 1, so the decision rests on the two symbols alone. Names are fingerprints of what they
stand for: all tasks name alike without a shared dictionary, and equal stretches of text get the same
symbols except near their ends. For each symbol the parse tracks the stretch of words that decides it
(its reach); wherever that stretch recurs, so does the symbol.

Each window of words elects, among the symbols whose reach lies inside it, the one with the most words.
Equal windows elect alike. The elected symbols are matched over the whole corpus in a first exchange;
windows whose symbol occurs in one document only cannot repeat and go no further. The others are verified
in a second exchange by 96-bit fingerprints of all their words. Windows without a symbol are verified
directly, so nothing is lost.

Both exchanges carry one row per chunk and name, not per document, so a passage that a third of all
documents share costs a row per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import CHECK_BASE, NO_ID, U, WORD_BASE, ids_of, mix, nullable_ids, prefix, runs, slices, span, text_bytes, words_of

WINDOW = 13
#: Rounds of pair naming, and the words one symbol may stand for.
ROUNDS, LONGEST = 3, 6
#: Bytes of text in a chunk of documents, and names in a bucket of the exchanges (both approximate).
CHUNK_BYTES = 8 << 20
BUCKET_NAMES = 500_000
NAMES = "bucket long, chunk long, name binary, lowest binary, highest binary"
CHECKED = "bucket long, chunk long, name binary, check binary, lowest binary, highest binary"


def parse(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols of the last round: start, end, and the bounds of their reach, all in order.

    ``words`` are word fingerprints, ``text`` the number of the text each belongs to. A reach past an end
    of its text counts as lying outside every window.
    """
    n = len(words)
    name = words.copy()
    start = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (text[1:] != text[:-1])])) if n else np.empty(0, np.int64)
    end = np.append(start[1:], n)
    size = end - start
    name = np.where(size > 1, mix(words[start] + size.astype(np.uint64) * U(0x9E3779B97F4A7C15)), words[start])
    owner = text[start]
    # a run is decided by the words at both its sides, which tell that it is complete
    reach_from, reach_to = start - 1, end + 1
    for level in range(ROUNDS):
        m = len(name)
        if m < 2:
            break
        right_bit = ((mix(name ^ U(0x51ED270B0A1F + level)) >> U(40)) & U(1)).astype(bool)
        joined = np.zeros(m, dtype=bool)
        joined[:-1] = ~right_bit[:-1] & right_bit[1:] & (owner[1:] == owner[:-1]) & (end[1:] - start[:-1] <= LONGEST)
        taken = np.zeros(m, dtype=bool)
        taken[1:] = joined[:-1]
        # a symbol that found no partner is decided by that neighbour too
        from_, to = reach_from.copy(), reach_to.copy()
        to[:-1] = np.where(~right_bit[:-1], reach_to[1:], to[:-1])
        to[-1] = to[-1] if right_bit[-1] else end[-1] + 1
        from_[1:] = np.where(right_bit[1:], reach_from[:-1], from_[1:])
        from_[0] = from_[0] if not right_bit[0] else start[0] - 1
        edge = owner[1:] != owner[:-1]
        to[:-1] = np.where(edge & ~right_bit[:-1], end[:-1] + 1, to[:-1])
        from_[1:] = np.where(edge & right_bit[1:], start[1:] - 1, from_[1:])
        kept = np.flatnonzero(~taken)
        pair = joined[kept]
        mate = np.minimum(kept + 1, m - 1)
        reach_from = np.where(pair, reach_from[kept], from_[kept])
        reach_to = np.where(pair, reach_to[mate], to[kept])
        name = np.where(pair, mix(name[kept] * U(0x9E3779B97F4A7C15) + mix(name[mate])), name[kept])
        start, end, owner = start[kept], np.where(pair, end[mate], end[kept]), owner[kept]
    return start, end, reach_from, reach_to


class Windows:
    """The windows of one slice of texts: their starts, fingerprints and elected symbols."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
        self.words = words_of(data, offsets)
        self.window = window
        self.hashes = self.words.hashes()
        self.bounds = self.words.bounds
        self.text = self.words.texts()
        last = self.bounds[self.text + 1] if len(self.text) else self.text
        self.starts = np.flatnonzero(np.arange(len(self.hashes)) + window <= last)
        self.sums = prefix(self.hashes, WORD_BASE)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        checks = prefix(mix(self.hashes), CHECK_BASE)
        end = self.starts + self.window
        return span(self.sums, self.starts, end, WORD_BASE), (span(checks, self.starts, end, CHECK_BASE) >> U(32)).astype(np.uint32)

    def elected(self) -> tuple[np.ndarray, np.ndarray]:
        """For each window the fingerprint of its elected symbol's reach, and whether it has one."""
        if len(self.starts) == 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        start, end, reach_from, reach_to = parse(self.hashes, self.text)
        fits = (reach_to - reach_from <= self.window) & (reach_from >= self.bounds[self.text[start]]) & (reach_to <= self.bounds[self.text[start] + 1])
        start, end, reach_from, reach_to = (x[fits] for x in (start, end, reach_from, reach_to))
        if len(start) == 0:
            return np.zeros(len(self.starts), np.uint64), np.zeros(len(self.starts), bool)
        key = mix(span(self.sums, reach_from, reach_to, WORD_BASE) + ((start - reach_from) * 64 + (end - start)).astype(np.uint64))
        rank = ((end - start).astype(np.uint64) << U(56)) | (key >> U(8))
        first = np.searchsorted(reach_from, self.starts, side="left")
        stop = np.searchsorted(reach_to, self.starts + self.window, side="right")
        has = first < stop
        best = np.minimum(first, len(key) - 1)
        top = rank[best]
        for step in range(1, int((stop - first).max(initial=0))):
            at = np.minimum(first + step, len(key) - 1)
            better = (first + step < stop) & (rank[at] > top)
            best, top = np.where(better, at, best), np.where(better, rank[at], top)
        return key[best], has

    def owners(self, ids: np.ndarray) -> np.ndarray:
        return ids[self.text[self.starts]]


def _packed(key: np.ndarray, low: np.ndarray, high: np.ndarray, chunk: int, buckets: int, check: np.ndarray | None = None) -> pa.Table:
    """One row per bucket of names; the arrays travel as bytes."""
    bucket = (key % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    heads = runs(bucket[order])
    stops = np.append(heads[1:], len(order))
    base = low.min() if len(low) else 0
    small = len(low) and int(high.max()) - int(base) < 2**32
    rows: dict[str, list] = {"bucket": [], "chunk": [], "name": [], "check": [], "lowest": [], "highest": []}
    for a, b in zip(heads.tolist(), stops.tolist()):
        part = np.sort(order[a:b])
        rows["bucket"].append(int(bucket[part[0]]))
        rows["chunk"].append(chunk)
        rows["name"].append(key[part].tobytes())
        rows["check"].append(check[part].tobytes() if check is not None else b"")
        rows["lowest"].append(_ids(low[part], base, small))
        rows["highest"].append(_ids(high[part] - low[part], 0, small))
    kinds = {"bucket": pa.int64(), "chunk": pa.int64()}
    names = [c for c in rows if c != "check" or check is not None]
    return pa.table({c: pa.array(rows[c], kinds.get(c, pa.binary())) for c in names})


def _ids(values: np.ndarray, base: int, small: bool) -> bytes:
    """Whole numbers from ``base`` on in four bytes where they fit; the first twelve bytes tell how."""
    head = np.array([base], dtype=np.int64).tobytes() + np.array([4 if small else 8], dtype=np.int32).tobytes()
    return head + (values - base).astype(np.uint32 if small else np.int64).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    base, width = np.frombuffer(data[:8], np.int64)[0], np.frombuffer(data[8:12], np.int32)[0]
    return np.frombuffer(data[12:], np.uint32 if width == 4 else np.int64).astype(np.int64) + base


def _least(key: np.ndarray, owner: np.ndarray, check: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct names of a chunk in order, each with its smallest and largest document."""
    order = np.argsort(key, kind="stable") if check is None else np.lexsort((check, key))
    key, owner = key[order], owner[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, bool)
    if check is not None and len(key):
        check = check[order]
        new[1:] |= check[1:] != check[:-1]
    heads = np.flatnonzero(new)
    if len(heads) == 0:
        return key, owner, owner, check if check is not None else key
    return key[heads], np.minimum.reduceat(owner, heads), np.maximum.reduceat(owner, heads), check[heads] if check is not None else key[heads]


def _texts(table: pa.Table) -> Iterator[tuple[Windows, np.ndarray, int, int]]:
    data, offsets = text_bytes(table.column("text"))
    ids = ids_of(table.column("doc_id"))
    for i, j in slices(offsets):
        yield Windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), ids[i:j], i, j


def _joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _symbols(buckets: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        keys, owners = [], []
        for windows, ids, _, _ in _texts(table):
            key, has = windows.elected()
            owner = windows.owners(ids)[has]
            key = key[has]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]) if len(key) else np.empty(0, bool)
            keys.append(key[new])
            owners.append(owner[new])
        key, low, high, _ = _least(_joined(keys, np.uint64), _joined(owners, np.int64))
        return _packed(key, low, high, table.column("chunk")[0].as_py(), buckets)

    return run


def _matched(with_check: bool) -> Callable[[pa.Table], pa.Table]:
    """Names of one bucket over all chunks: each chunk learns the smallest owner of those that others have."""

    def run(table: pa.Table) -> pa.Table:
        names = [np.frombuffer(x, np.uint64) for x in table.column("name").to_pylist()]
        sizes = np.array([len(x) for x in names])
        key = _joined(names, np.uint64)
        low = _joined([_unpacked(x) for x in table.column("lowest").to_pylist()], np.int64)
        high = low + _joined([_unpacked(x) for x in table.column("highest").to_pylist()], np.int64)
        chunk = np.repeat(np.asarray(table.column("chunk")), sizes)
        check = _joined([np.frombuffer(x, np.uint32) for x in table.column("check").to_pylist()], np.uint32) if with_check else np.zeros(len(key), np.uint32)
        order = np.lexsort((check, key)) if with_check else np.argsort(key, kind="stable")
        key, low, high, chunk, check = key[order], low[order], high[order], chunk[order], check[order]
        heads = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])]))
        n = np.diff(np.append(heads, len(key)))
        least = np.repeat(np.minimum.reduceat(low, heads), n)
        most = np.repeat(np.maximum.reduceat(high, heads), n)
        told = high > least if with_check else most > least
        key, least, chunk, check = key[told], least[told], chunk[told], check[told]
        order = np.argsort(chunk, kind="stable")
        heads = runs(chunk[order])
        base = least.min() if len(least) else 0
        small = len(least) and int(least.max()) - int(base) < 2**32
        parts = [order[a:b] for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)])]
        out = {
            "chunk": pa.array([int(chunk[p[0]]) for p in parts], pa.int64()),
            "name": pa.array([key[p].tobytes() for p in parts], pa.binary()),
        }
        if with_check:
            out["check"] = pa.array([check[p].tobytes() for p in parts], pa.binary())
            out["lowest"] = pa.array([_ids(least[p], base, small) for p in parts], pa.binary())
        return pa.table(out)

    return run


def _candidates(buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        shared = np.sort(_joined([np.frombuffer(x, np.uint64) for x in answers.column("name").to_pylist()], np.uint64))
        keys, checks, owners = [], [], []
        if table.num_rows:
            for windows, ids, _, _ in _texts(table):
                key, has = windows.elected()
                at = np.minimum(np.searchsorted(shared, key), max(0, len(shared) - 1))
                open_ = ~has | (shared[at] == key if len(shared) else False)
                name, check = windows.names()
                keys.append(name[open_])
                checks.append(check[open_])
                owners.append(windows.owners(ids)[open_])
        key, low, high, check = _least(_joined(keys, np.uint64), _joined(owners, np.int64), _joined(checks, np.uint32))
        chunk = table.column("chunk")[0].as_py() if table.num_rows else 0
        return _packed(key, low, high, chunk, buckets, check)

    return run


def _repeated(windows: Windows, ids: np.ndarray, key: np.ndarray, check: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Words covered by a window that a smaller document has too. ``key`` is sorted, then ``check``."""
    covered = np.zeros(len(windows.hashes) + 1, dtype=np.int64)
    if len(key) and len(windows.starts):
        name, own_check = windows.names()
        owner = windows.owners(ids)
        hit = np.zeros(len(name), dtype=bool)
        at = np.searchsorted(key, name)
        while True:  # a second turn only for two windows with the same first fingerprint
            near = np.minimum(at, len(key) - 1)
            same = (at < len(key)) & (key[near] == name)
            hit |= same & (check[near] == own_check) & (least[near] < owner)
            more = same & (check[near] != own_check)
            if not more.any():
                break
            at = np.where(more, at + 1, len(key))
        np.add.at(covered, windows.starts[hit], 1)
        np.add.at(covered, windows.starts[hit] + windows.window, -1)
    return np.cumsum(covered[:-1]) > 0


def _removed(with_text: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        key = _joined([np.frombuffer(x, np.uint64) for x in answers.column("name").to_pylist()], np.uint64)
        check = _joined([np.frombuffer(x, np.uint32) for x in answers.column("check").to_pylist()], np.uint32)
        least = _joined([_unpacked(x) for x in answers.column("lowest").to_pylist()], np.int64)
        order = np.lexsort((check, key))
        key, check, least = key[order], check[order], least[order]
        texts = table.column("text").combine_chunks()
        total, gone, digest, kept_text = [], [], [], []
        for windows, ids, i, j in _texts(table) if table.num_rows else ():
            flagged = _repeated(windows, ids, key, check, least)
            before = np.concatenate([[0], np.cumsum(flagged)])
            for k, text in enumerate(texts.slice(i, j - i).to_pylist()):
                a, b = windows.bounds[k], windows.bounds[k + 1]
                words = (text or "").encode("utf-8").split()
                removed = int(before[b] - before[a])
                if removed:
                    words = list(compress(words, (~flagged[a:b]).tolist()))
                kept = b" ".join(words)
                total.append(int(b - a))
                gone.append(removed)
                digest.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    kept_text.append(kept.decode("utf-8") if removed else text)
        out = {"doc_id": nullable_ids(ids_of(table.column("doc_id"))), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        if with_text:
            out |= {"row_id": table.column("row_id"), "kept_text": pa.array(kept_text, pa.string())}
        return pa.table(out)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``WINDOW`` words that a smaller document has too.

    ``docs`` has doc_id and text (and row_id, carried along, with ``with_text``). Windows are judged on
    the input. Result, one row per row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one
    space) and, with ``with_text``, row_id and kept_text: the text as it was where nothing was removed.
    A null text has no words; texts shorter than a window stay whole. A null doc_id sorts behind all
    others, and rows that share an id never remove each other's words. Other columns are not read.
    """
    extra = ["row_id"] if with_text else []
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    buckets = max(1, -(-size // 20 // BUCKET_NAMES))
    rows = docs.select(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(chunks)).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *extra)
    by_chunk = rows.groupBy("chunk")
    symbols = by_chunk.applyInArrow(_symbols(buckets), NAMES)
    shared = symbols.groupBy("bucket").applyInArrow(_matched(False), "chunk long, name binary")
    windows = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(_candidates(buckets), CHECKED)
    known = windows.groupBy("bucket").applyInArrow(_matched(True), "chunk long, name binary, check binary, lowest binary")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    schema += f", row_id {dict(docs.dtypes)['row_id']}, kept_text string" if with_text else ""
    return rows.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_removed(with_text), schema)
