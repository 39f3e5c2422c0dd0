"""Removal of repeated byte strings with suffix arrays of shards.

A text is cut into pieces so that equal strings always meet in one shard: each window of ``WINDOW`` bytes
belongs to its anchor, the leftmost of its stretches of ``GRAM`` bytes with the least fingerprint, and the
windows of one anchor that follow each other form a piece. Equal windows have equal anchors, so an anchor
that occurs once has no repeated window, and the pieces of an anchor that occurs again are all the shard of
that anchor needs. Copies of a piece are named once and sent once, with a mark that there are several.

All chunks that hold an anchor agree on one of them, and on a stretch of its text, as the home of the anchor;
a shard holds the pieces of all anchors with the same home. So most pieces of a shard stand side by side in
that stretch and are sent as one text; those of other surroundings join them. The texts of a shard follow
each other with a separator. Its suffix array comes from induced sorting (``induced``), the common prefixes
from the permuted array; suffixes that share ``WINDOW`` bytes stand together, and a window is repeated if it
has such a neighbour or its piece is marked. The runs of repeated windows go back to the chunks of text that
hold the piece, by name.

An anchor in too many different surroundings (a line that a third of all texts hold) would fill a shard.
It is split: each of its windows is a piece of its own under its own fingerprint, and only windows whose
fingerprint occurs again are sent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import induced
from .arrays import BYTE_BASE, POWERS, U, mix, prefix, runs, slices, span, text_bytes

WINDOW = 200
GRAM = 32
#: Bytes of text in a chunk, bytes of text for which there is one bucket of names, and the stretch of a home.
CHUNK_BYTES, BUCKET_BYTES, HOME_BYTES = 8 << 20, 32 << 20, 4 << 20
#: Different surroundings of one anchor, in a chunk and in all, beyond which its windows are named one by one.
LOCAL_MANY, MANY = 32, 256
#: Texts are parsed in slices of about this size, so that the arrays stay in cache.
PARSED_BYTES = 1 << 17
WHOLE, SINGLE, HOT = 0, 1, 2
NAMES = "bucket long, chunk long, anchor binary, name binary, mark binary, stretch binary"
WANTED = "chunk long, anchor binary, name binary, mark binary, home binary, counts binary, chunks binary"
PIECES = "shard long, anchor binary, name binary, kind binary, several binary, first binary, counts binary, chunks binary, text binary"
ANSWERS = "chunk long, anchor binary, name binary, kind binary, start binary, stop binary"


class Pieces:
    """The pieces of one slice of texts, in order: first and last window, anchor and name of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
        self.data, self.window = data, window
        n = len(data)
        none = np.empty(0, np.int64)
        self.sums = prefix(data.astype(np.uint64) + U(1), BYTE_BASE)
        windows = np.maximum(np.diff(offsets) - window + 1, 0)
        if n < window or not windows.any():
            self.first = self.last = none
            self.anchor = self.name = np.empty(0, np.uint64)
            return
        prints = _grams(self.sums, gram)
        # the low bits tell the place, so the least key is the leftmost one of equal fingerprints
        bits = U(int(n).bit_length())
        least = (prints >> bits << bits) | np.arange(len(prints), dtype=np.uint64)
        reach, width = window - gram + 1, 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
        valid = np.zeros(n + 1, np.int64)
        some = np.flatnonzero(windows)
        valid[offsets[some]] = 1
        valid[offsets[some] + windows[some]] -= 1
        starts = np.flatnonzero(np.cumsum(valid[:-1]))
        place = (least[starts] & ((U(1) << bits) - U(1))).astype(np.int64)
        head = np.ones(len(starts), dtype=bool)
        head[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        begin = np.flatnonzero(head)
        # texts may stand side by side, but a window ends with its text, so no run of windows spans two
        self.first = starts[begin]
        self.last = starts[np.append(begin[1:], len(starts)) - 1]
        self.anchor = prints[place[begin]]
        self.name = mix(span(self.sums, self.first, self.last + window, BYTE_BASE) + U(0x632BE59BD9B4E019))

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of the chosen pieces, and the anchor of each."""
        many = self.last[chosen] - self.first[chosen] + 1
        at = np.repeat(self.first[chosen] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        return at, np.repeat(self.anchor[chosen], many)

    def window_names(self, at: np.ndarray) -> np.ndarray:
        return mix(span(self.sums, at, at + self.window, BYTE_BASE) + U(0x8CB92BA72F3D8DD7))


def _grams(sums: np.ndarray, gram: int) -> np.ndarray:
    """Fingerprints of all stretches of ``gram`` bytes, as ``span`` gives them."""
    n = len(sums) - gram
    _, down = POWERS[BYTE_BASE].upto(len(sums))
    out = sums[gram:] - sums[:n]
    out *= down[:n]
    out += U(gram * 0x2545F4914F6CDD1D % 2**64)
    return mix(out)


def _parts(table: pa.Table, window: int) -> Iterator[tuple[Pieces, int, int, np.ndarray]]:
    """Pieces of slices of the texts, the rows of each slice and its offsets."""
    if table.num_rows == 0:
        return
    data, offsets = text_bytes(table.column("text"))
    for i, j in slices(offsets, PARSED_BYTES):
        own = offsets[i : j + 1] - offsets[i]
        yield Pieces(data[offsets[i] : offsets[j]], own, window), i, j, own


def _distinct(anchor: np.ndarray, name: np.ndarray, several: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct (anchor, name) in order, and whether each was there more than once."""
    order = np.lexsort((name, anchor))
    anchor, name = anchor[order], name[order]
    if len(anchor) == 0:
        return anchor, name, np.empty(0, bool), order
    heads = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (name[1:] != name[:-1])]))
    many = np.diff(np.append(heads, len(anchor))) > 1
    if several is not None:
        many |= np.logical_or.reduceat(several[order], heads)
    return anchor[heads], name[heads], many, order[heads]


def _cat(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _read(table: pa.Table, column: str, dtype=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype) for x in table.column(column).to_pylist()]


def _by_bucket(bucket_of: np.ndarray, buckets: int, chunk: int, *columns: np.ndarray) -> pa.Table:
    """One row per bucket that has names; the arrays travel as bytes."""
    bucket = (bucket_of % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    heads = runs(bucket[order])
    parts = [order[a:b] for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)])]
    out = {"bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()), "chunk": pa.array([chunk] * len(parts), pa.int64())}
    for name, values in zip(("anchor", "name", "mark", "stretch"), columns):
        out[name] = pa.array([values[p].tobytes() for p in parts], pa.binary())
    return pa.table(out)


def _chunk_of(*tables: pa.Table) -> int:
    return next(t.column("chunk")[0].as_py() for t in tables if t.num_rows)


def _named(buckets: int, window: int, local_many: int) -> Callable[[pa.Table], pa.Table]:
    """Names of all pieces of a chunk; an anchor in many surroundings is told once, as hot."""

    def run(table: pa.Table) -> pa.Table:
        anchors, names, stretches, done = [], [], [], 0
        for pieces, *_ in _parts(table, window):
            anchors.append(pieces.anchor)
            names.append(pieces.name)
            stretches.append((pieces.first + done) // HOME_BYTES)
            done += len(pieces.data)
        anchor, name, several, at = _distinct(_cat(anchors, np.uint64), _cat(names, np.uint64))
        stretch = _cat(stretches, np.int64)[at].astype(np.uint32)
        mark = np.where(several, np.uint8(SINGLE), np.uint8(WHOLE))
        heads = runs(anchor)
        sizes = np.diff(np.append(heads, len(anchor)))
        hot = np.repeat(sizes > local_many, sizes)
        kept = ~hot
        kept[heads[sizes > local_many]] = True
        mark = np.where(hot, np.uint8(HOT), mark)
        name = np.where(hot, U(0), name)
        return _by_bucket(mix(anchor)[kept], buckets, _chunk_of(table), anchor[kept], name[kept], mark[kept], stretch[kept])

    return run


def _judged(many: int | None) -> Callable[[pa.Table], pa.Table]:
    """Of the names of one bucket over all chunks, those worth sending: each to the chunk that shall send it.

    A row tells names (marked whether there are several copies) with their homes and the chunks that hold
    them; hot anchors are told to every chunk that has them. With ``many`` None the names are those of
    windows: they are worth sending where they occur again, and each has a home of its own.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = _read(table, "anchor")
        anchor, name = _cat(parts, np.uint64), _cat(_read(table, "name"), np.uint64)
        mark, stretch = _cat(_read(table, "mark", np.uint8), np.uint8), _cat(_read(table, "stretch", np.uint32), np.uint32)
        chunk = np.repeat(np.asarray(table.column("chunk")), [len(x) for x in parts])
        # one order of chunks for all names, so that neighbours in a text mostly choose the same chunk
        rank = mix(chunk.astype(np.uint64))
        order = np.lexsort((rank, name, anchor))
        anchor, name, mark, chunk, stretch, rank = (x[order] for x in (anchor, name, mark, chunk, stretch, rank))
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = anchor[1:] != anchor[:-1]
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        new_name = new.copy()
        new_name[1:] |= name[1:] != name[:-1]
        name_heads = np.flatnonzero(new_name)
        holders = np.diff(np.append(name_heads, len(anchor)))
        several = (holders > 1) | np.logical_or.reduceat(mark == SINGLE, name_heads)
        names_of = np.bincount(group[name_heads], minlength=len(heads))
        place = (chunk << 24) | stretch.astype(np.int64)
        if many is None:
            told, home = several, place[name_heads]
        else:
            hot = np.logical_or.reduceat(mark == HOT, heads) | (names_of > many)
            told = ~hot[group[name_heads]] & ((names_of[group[name_heads]] > 1) | several)
            first = np.flatnonzero(rank == np.minimum.reduceat(rank, heads)[group])
            home = np.empty(len(heads), np.int64)
            home[group[first[::-1]]] = place[first[::-1]]
            home = home[group[name_heads]]
        out: dict[str, list] = {c.split()[0]: [] for c in WANTED.split(", ")}

        def tell(rows: np.ndarray, counts: np.ndarray, mark_of: np.ndarray, home_of: np.ndarray) -> None:
            by = np.argsort(chunk[rows], kind="stable")
            ends = runs(chunk[rows[by]])
            for a, b in zip(ends.tolist(), [*ends[1:].tolist(), len(by)]):
                p = by[a:b]
                at, n = rows[p], counts[p]
                held = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
                out["chunk"].append(int(chunk[at[0]]))
                for c, v in zip(("anchor", "name", "mark", "home", "counts", "chunks"), (anchor[at], name[at], mark_of[p].astype(np.uint8), home_of[p], n.astype(np.int64), chunk[held])):
                    out[c].append(v.tobytes())

        # the first holder sends
        tell(name_heads[told], holders[told], several[told] * SINGLE, home[told])
        if many is not None:
            rows = np.flatnonzero(hot[group])
            rows = rows[np.unique(np.stack([group[rows], chunk[rows]]), axis=1, return_index=True)[1]] if len(rows) else rows
            tell(rows, np.zeros(len(rows), np.int64), np.full(len(rows), HOT), np.zeros(len(rows), np.int64))
        return pa.table({c: pa.array(v, pa.int64() if c == "chunk" else pa.binary()) for c, v in out.items()})

    return run


class _Wanted:
    """What a chunk was told: names to send, and hot anchors."""

    def __init__(self, table: pa.Table):
        anchor, name = _cat(_read(table, "anchor"), np.uint64), _cat(_read(table, "name"), np.uint64)
        mark = _cat(_read(table, "mark", np.uint8), np.uint8)
        counts, chunks = _cat(_read(table, "counts", np.int64), np.int64), _cat(_read(table, "chunks", np.int64), np.int64)
        self.hot = np.unique(anchor[mark == HOT])
        starts = np.cumsum(counts) - counts
        send = np.flatnonzero(mark != HOT)
        send = send[np.argsort(_key(anchor[send], name[send]), kind="stable")]
        self.key, self.anchor, self.name = _key(anchor[send], name[send]), anchor[send], name[send]
        self.several, self.home = mark[send] == SINGLE, _cat(_read(table, "home", np.int64), np.int64)[send]
        self.counts, self.starts, self.chunks = counts[send], starts[send], chunks

    def holders(self, rows: np.ndarray) -> np.ndarray:
        """The chunks that hold the given names, one name after the other."""
        n = self.counts[rows]
        return self.chunks[np.repeat(self.starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _key(anchor: np.ndarray, name: np.ndarray) -> np.ndarray:
    return mix(anchor + U(0x9E3779B97F4A7C15)) ^ name


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key among sorted keys, and whether it is there."""
    if len(keys) == 0:
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _windows_named(buckets: int, window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Names of the windows of hot anchors in a chunk."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        hot = _Wanted(told).hot
        anchors, names, stretches, done = [], [], [], 0
        if len(hot):
            for pieces, *_ in _parts(table, window):
                at, anchor = pieces.windows(np.flatnonzero(_find(hot, pieces.anchor)[1]))
                anchors.append(anchor)
                names.append(pieces.window_names(at))
                stretches.append((at + done) // HOME_BYTES)
                done += len(pieces.data)
        anchor, name, several, at = _distinct(_cat(anchors, np.uint64), _cat(names, np.uint64))
        mark = np.where(several, np.uint8(SINGLE), np.uint8(WHOLE))
        return _by_bucket(name, buckets, _chunk_of(table, told), anchor, name, mark, _cat(stretches, np.int64)[at].astype(np.uint32))

    return run


def _sent(window: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The texts that a chunk was told to send: one row for pieces of the same home that stand side by side."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        wanted = _Wanted(told)
        open_ = np.ones(len(wanted.key), dtype=bool)
        out: dict[str, list] = {c.split()[0]: [] for c in PIECES.split(", ")}
        for pieces, *_ in _parts(table, window) if len(wanted.key) else ():
            first, last, key = pieces.first, pieces.last, _key(pieces.anchor, pieces.name)
            kind = np.full(len(first), WHOLE, np.uint8)
            if len(wanted.hot):
                at, anchor = pieces.windows(np.flatnonzero(_find(wanted.hot, pieces.anchor)[1]))
                first, last, key = np.append(first, at), np.append(last, at), np.append(key, _key(anchor, pieces.window_names(at)))
                kind = np.append(kind, np.full(len(at), SINGLE, np.uint8))
            at, found = _find(wanted.key, key)
            rows = np.flatnonzero(found)
            rows = rows[open_[at[rows]]]
            rows = rows[np.unique(at[rows], return_index=True)[1]]
            rows = rows[np.argsort(first[rows], kind="stable")]
            which = at[rows]
            open_[which] = False
            home = wanted.home[which]
            head = np.ones(len(rows), dtype=bool)
            head[1:] = (first[rows[1:]] != last[rows[:-1]] + 1) | (home[1:] != home[:-1])
            heads = np.flatnonzero(head).tolist()
            for a, b in zip(heads, [*heads[1:], len(rows)]):
                start, w = first[rows[a]], which[a:b]
                out["shard"].append(int(home[a]))
                out["text"].append(pieces.data[start : last[rows[b - 1]] + window].tobytes())
                for c, v in zip(("anchor", "name", "kind", "several", "first", "counts", "chunks"), (wanted.anchor[w], wanted.name[w], kind[rows[a:b]], wanted.several[w], (first[rows[a:b]] - start).astype(np.int32), wanted.counts[w], wanted.holders(w))):
                    out[c].append(v.tobytes())
        return pa.table({c: pa.array(v, pa.int64() if c == "shard" else pa.binary()) for c, v in out.items()})

    return run


def repeated_windows(texts: list[bytes], window: int) -> np.ndarray:
    """Whether the window at each byte of the texts, one after the other, starts anywhere else in them."""
    sizes = np.array([len(x) for x in texts], np.int64)
    stops = np.cumsum(sizes + 1) - 1
    text = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8).astype(np.int64) + 2
    text[stops] = 1
    text[-1] = 0
    order = induced.suffix_array(text, 258)
    before, common = induced.common_prefixes(text, order)
    left = np.append(np.repeat(stops, sizes + 1) - np.arange(len(text) - 1), 0)  # bytes up to the end of the text
    # a prefix that runs over a separator tells nothing
    near = (common >= window) & (left >= window) & (left[before] >= window)
    hit = near.copy()
    hit[before[near]] = True
    inside = np.ones(len(text), dtype=bool)
    inside[stops] = inside[-1] = False
    return hit[inside]


def _sorted_shard(window: int) -> Callable[[pa.Table], pa.Table]:
    """Runs of repeated windows of the pieces of a shard, for each chunk that holds the piece."""

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("text").to_pylist()
        sizes = np.array([len(x) for x in texts], np.int64)
        base = np.cumsum(sizes) - sizes
        anchor, name, kind = (_cat(_read(table, c, t), t) for c, t in (("anchor", np.uint64), ("name", np.uint64), ("kind", np.uint8)))
        several = _cat(_read(table, "several", np.bool_), np.bool_)
        firsts = _read(table, "first", np.int32)
        many = np.array([len(x) for x in firsts], np.int64)
        # pieces in the order of the texts: each ends where the next one begins, the last with its text's last window
        first = _cat(firsts, np.int32) + np.repeat(base, many)
        stop = np.append(first[1:], 0)
        stop[np.cumsum(many) - 1] = base + sizes - window + 1
        hit = repeated_windows(texts, window)
        owner = np.repeat(np.arange(len(first)), stop - first)
        at = np.repeat(first - (np.cumsum(stop - first) - (stop - first)), stop - first) + np.arange(len(owner))
        again = hit[at] | several[owner]
        owner, at = owner[again], at[again]
        head = np.ones(len(owner), dtype=bool)
        head[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(head)
        end = np.append(begin[1:], len(owner)) - 1 if len(owner) else begin
        piece = owner[begin]
        start, stop = at[begin] - first[piece], at[end] + 1 - first[piece]
        held, chunks = _cat(_read(table, "counts", np.int64), np.int64), _cat(_read(table, "chunks", np.int64), np.int64)
        n = held[piece]
        row = np.repeat(np.arange(len(piece)), n)
        chunk = chunks[np.repeat((np.cumsum(held) - held)[piece] - (np.cumsum(n) - n), n) + np.arange(len(row))]
        order = np.argsort(chunk, kind="stable")
        heads = runs(chunk[order])
        out: dict[str, list] = {c.split()[0]: [] for c in ANSWERS.split(", ")}
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
            p = row[order[a:b]]
            out["chunk"].append(int(chunk[order[a]]))
            for c, v in zip(("anchor", "name", "kind", "start", "stop"), (anchor[piece[p]], name[piece[p]], kind[piece[p]], start[p].astype(np.int32), stop[p].astype(np.int32))):
                out[c].append(v.tobytes())
        return pa.table({c: pa.array(v, pa.int64() if c == "chunk" else pa.binary()) for c, v in out.items()})

    return run


def _covered(pieces: Pieces, answers: dict[str, np.ndarray], hot: np.ndarray) -> np.ndarray:
    """Which bytes of the slice a repeated window covers."""
    cover = np.zeros(len(pieces.data) + 1, np.int64)

    def add(key: np.ndarray, first: np.ndarray) -> None:
        low = np.searchsorted(answers["key"], key, side="left")
        n = np.searchsorted(answers["key"], key, side="right") - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        base = np.repeat(first, n)
        np.add.at(cover, base + answers["start"][at], 1)
        np.add.at(cover, base + answers["stop"][at] - 1 + pieces.window, -1)

    if len(answers["key"]):
        add(_key(pieces.anchor, pieces.name), pieces.first)
        if len(hot):
            at, anchor = pieces.windows(np.flatnonzero(_find(hot, pieces.anchor)[1]))
            add(_key(anchor, pieces.window_names(at)), at)
    return np.cumsum(cover[:-1]) > 0


def _removed(window: int, with_text: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        answers = {c: _cat(_read(found, c, t), t) for c, t in (("anchor", np.uint64), ("name", np.uint64), ("kind", np.uint8), ("start", np.int32), ("stop", np.int32))}
        hot = np.unique(answers["anchor"][answers["kind"] == SINGLE])
        key = _key(answers["anchor"], answers["name"])
        order = np.argsort(key, kind="stable")
        answers = {c: v[order] for c, v in answers.items()} | {"key": key[order]}
        total, gone, spans, digest, kept_text = [], [], [], [], []
        for pieces, i, j, offsets in _parts(table, window):
            flagged = _covered(pieces, answers, hot)
            before = np.concatenate([[0], np.cumsum(flagged)])
            starts = np.concatenate([[0], np.cumsum(flagged & ~np.concatenate([[False], flagged[:-1]]))])
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                removed = int(before[b] - before[a])
                total.append(b - a)
                gone.append(removed)
                # a run that goes on from the text before is a run of this text too
                spans.append(int(starts[b] - starts[a]) + int(a < b and a > 0 and flagged[a] and flagged[a - 1]))
                kept = (pieces.data[a:b][~flagged[a:b]] if removed else pieces.data[a:b]).tobytes()
                digest.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    kept_text.append(kept.decode("utf-8", "replace"))
        out = {"doc_id": table.column("doc_id"), "n_bytes": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        if with_text:
            out["kept_text"] = pa.array(kept_text, pa.string())
        return pa.table(out)

    return run


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, with_text: bool = False, local_many: int = LOCAL_MANY, many: int = MANY) -> DataFrame:
    """Remove every byte covered by a string of ``window`` bytes that starts anywhere else too.

    ``docs`` has doc_id and text. Strings are judged on the input and never cross documents; they may start
    twice in one document, also overlapping, and all occurrences go. Result, one row per row: doc_id,
    n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (remaining bytes) and, with
    ``with_text``, kept_text: the remaining bytes read as UTF-8, a character cut in two replaced. A null
    text is empty; texts shorter than ``window`` stay whole. A row with a null or repeated doc_id is a
    document like any other: repeated rows remove each other. Other columns are not read. An empty table
    gives none.

    ``window`` is more than ``GRAM``. An anchor of more than ``local_many`` surroundings in a chunk, or
    ``many`` in all, is split by its windows; neither changes the result.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = (max(1, -(-size // x)) for x in (CHUNK_BYTES, BUCKET_BYTES))
    own = F.coalesce(F.col("doc_id").cast("long"), F.monotonically_increasing_id())
    rows = docs.select(F.pmod(F.xxhash64(own, F.octet_length("text")), F.lit(chunks)).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    by_chunk = rows.groupBy("chunk")
    named = by_chunk.applyInArrow(_named(buckets, window, local_many), NAMES)
    told = named.groupBy("bucket").applyInArrow(_judged(many), WANTED)
    single = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_windows_named(buckets, window), NAMES)
    again = single.groupBy("bucket").applyInArrow(_judged(None), WANTED)
    sent = by_chunk.cogroup(told.unionByName(again).groupBy("chunk")).applyInArrow(_sent(window), PIECES)
    answers = sent.groupBy("shard").applyInArrow(_sorted_shard(window), ANSWERS)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_removed(window, with_text), schema)
