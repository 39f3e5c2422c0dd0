"""Suffix arrays of one shard by induced sorting, and its permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than the one behind them. The leftmost S suffixes
(an L stands before them) split the text; their substrings are sorted by inducing, named, and the string
of names is sorted by the same procedure. From the sorted leftmost S suffixes the L suffixes are induced
in one scan to the right, then the S suffixes in one scan to the left.

A small alphabet is scanned bucket by bucket, a large one (names) block by block, with array operations;
both fill the same places in the same order as a scan entry by entry.
"""

from __future__ import annotations

import numpy as np

#: A level is scanned by buckets if it has this many symbols of text for each symbol of its alphabet.
BUCKET_SYMBOLS = 64


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes in order. ``text`` holds 0 to ``symbols - 1`` and ends with its only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    larger = _larger(text)
    left = np.flatnonzero(~larger[1:] & larger[:-1]) + 1  # leftmost S suffixes, the final 0 among them
    sizes = np.bincount(text, minlength=symbols)
    by_first = left[np.argsort(text[left], kind="stable")]
    order = _induced(text, larger, by_first, sizes)
    is_left = np.zeros(n, dtype=bool)
    is_left[left] = True
    order = order[is_left[order]]
    names, count = _named(text, left, order)
    if count < len(left):
        ranks = suffix_array(names, count)
    else:
        ranks = np.empty(len(left), np.int64)
        ranks[names] = np.arange(len(left))
    return _induced(text, larger, left[ranks], sizes)


def _larger(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is larger than the one behind it; the last one is not."""
    n = len(text)
    differs = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    # an equal neighbour hands the answer on: look at the next place where the text changes
    at = differs[np.searchsorted(differs, np.arange(n))]
    larger = np.zeros(n, dtype=bool)
    inner = at < n - 1
    larger[inner] = text[at[inner]] > text[at[inner] + 1]
    return larger


def _named(text: np.ndarray, left: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost substrings in text order, equal for equal substrings and rising with their order."""
    end = np.append(left[1:], len(text) - 1)
    length = np.empty(len(text), np.int64)
    length[left] = end - left + 1
    a, b = order[:-1], order[1:]
    same = length[a] == length[b]
    same[:1] = False  # the final 0 is a substring of its own
    active = np.flatnonzero(same)
    step = 0
    while len(active):
        equal = text[a[active] + step] == text[b[active] + step]
        same[active[~equal]] = False
        step += 1
        active = active[equal]
        active = active[length[a[active]] > step]
    names = np.empty(len(text), np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    return names[left], int(names[order[-1]]) + 1


def _induced(text: np.ndarray, larger: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Order of all suffixes given the leftmost S suffixes in order (or merely grouped by first symbol)."""
    if len(text) >= BUCKET_SYMBOLS * len(sizes):
        return _by_buckets(text, larger, seeds, sizes)
    return _by_blocks(text, larger, seeds, sizes)


def _by_blocks(text: np.ndarray, larger: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Scan blocks of entries up to the first place that the block itself fills.

    With many symbols the places that a block fills are far ahead, mostly, so blocks are long.
    """
    n = len(text)
    stops = np.cumsum(sizes)
    order = np.full(n, -1, np.int64)
    first = text[seeds]
    many = np.bincount(first, minlength=len(sizes))
    order[stops[first] - many[first] + np.arange(len(seeds)) - (np.cumsum(many) - many)[first]] = seeds
    step = max(16, int(2 * n**0.5))
    numbers = np.arange(step)

    def put(before: np.ndarray, place: np.ndarray, sign: int) -> None:
        """Put suffixes at the next free places of their buckets; ``place`` moves by ``sign``."""
        c = text[before]
        by = np.argsort(c, kind="stable")
        c = c[by]
        new = np.empty(len(c), dtype=bool)
        new[0] = True
        np.not_equal(c[1:], c[:-1], out=new[1:])
        heads = new.nonzero()[0]
        counts = np.empty(len(heads), np.int64)
        np.subtract(heads[1:], heads[:-1], out=counts[:-1])
        counts[-1] = len(c) - heads[-1]
        at = numbers[: len(c)] - np.repeat(heads, counts)
        order[place[c] + sign * at] = before[by]
        place[c[heads]] += sign * counts

    head = stops - sizes
    i = 0
    while i < n:
        block = order[i : i + step]
        filled = (block > 0).nonzero()[0]
        before = block[filled] - 1
        right = larger[before]
        filled, before = filled[right], before[right]
        stop = min(n, i + step)
        if len(before):
            nearest = int(head[text[before]].min())
            if nearest < stop:
                stop = max(nearest, i + 1)
                before = before[: np.searchsorted(filled, stop - i)]
            if len(before):
                put(before, head, 1)
        i = stop
    last = stops - 1
    last[0] = -1  # the final 0 stays where it is
    i = n
    while i > 0:
        low = max(0, i - step)
        block = order[low:i][::-1]
        filled = (block > 0).nonzero()[0]
        before = block[filled] - 1
        right = ~larger[before]
        filled, before = filled[right], before[right]
        stop = low
        if len(before):
            nearest = int(last[text[before]].max())
            if nearest >= low:
                stop = min(nearest + 1, i - 1)
                before = before[: np.searchsorted(filled, i - stop)]
            if len(before):
                put(before, last, -1)
        i = stop
    return order


def _by_buckets(text: np.ndarray, larger: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n = len(text)
    symbols = len(sizes)
    stops = np.cumsum(sizes)
    starts = stops - sizes
    kind = np.uint8 if symbols <= 256 else np.uint16  # short keys are sorted in linear time
    if symbols > 65536:
        kind = np.int64
    order = np.full(n, -1, np.int64)
    seed_stops = np.cumsum(np.bincount(text[seeds], minlength=symbols))
    seed_starts = np.concatenate([[0], seed_stops[:-1]])

    head = starts.copy()

    def to_right(items: np.ndarray) -> None:
        before = items[items > 0] - 1
        before = before[larger[before]]
        if len(before) == 0:
            return
        c = text[before]
        by = np.argsort(c.astype(kind), kind="stable")
        c, before = c[by], before[by]
        many = np.bincount(c, minlength=symbols)
        first = np.cumsum(many) - many
        order[head[c] + np.arange(len(c)) - first[c]] = before
        head[:] += many

    for c in np.flatnonzero(sizes).tolist():
        done = starts[c]
        while done < head[c]:
            todo = head[c]
            to_right(order[done:todo])
            done = todo
        if seed_stops[c] > seed_starts[c]:
            to_right(seeds[seed_starts[c] : seed_stops[c]])

    tail = stops.copy()
    tail[0] = 0

    def to_left(items: np.ndarray) -> None:
        before = items[items > 0] - 1
        before = before[~larger[before]]
        if len(before) == 0:
            return
        c = text[before]
        by = np.argsort(c.astype(kind), kind="stable")
        c, before = c[by], before[by]
        many = np.bincount(c, minlength=symbols)
        first = np.cumsum(many) - many
        order[tail[c] - 1 - (np.arange(len(c)) - first[c])] = before
        tail[:] -= many

    order[0] = n - 1
    for c in np.flatnonzero(sizes)[::-1].tolist():
        done = stops[c]
        while c and done > tail[c]:
            todo = tail[c]
            to_left(order[todo:done][::-1])
            done = todo
        to_left(order[starts[c] : head[c]][::-1])
    to_left(order[:1])
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, steps: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """For each position the suffix before it in order and the length of their common prefix.

    The prefix at a position is one shorter than at the position before where the symbols before both
    suffixes agree; only the other positions are compared with the text, all of them together, ``steps``
    symbols in a round. The first suffix in order has no neighbour: -1 and 0.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    prefix = np.zeros(n, np.int64)
    fresh = np.ones(n, dtype=bool)
    both = before[1:] > 0
    at = np.flatnonzero(both) + 1
    fresh[at] = text[at - 1] != text[before[at] - 1]
    active = np.flatnonzero(fresh & (before >= 0))
    words = _packed(text, steps)
    length = np.zeros(len(active), np.int64)
    left, right = active.copy(), before[active]
    live = np.arange(len(active))
    while len(live):
        inside = (left[live] + steps <= n) & (right[live] + steps <= n)
        equal = np.zeros(len(live), dtype=bool)
        equal[inside] = words[left[live[inside]]] == words[right[live[inside]]]
        live = live[equal]
        length[live] += steps
        left[live] += steps
        right[live] += steps
    live = np.arange(len(active))
    for _ in range(steps):
        inside = (left[live] < n) & (right[live] < n)
        live = live[inside]
        live = live[text[left[live]] == text[right[live]]]
        length[live] += 1
        left[live] += 1
        right[live] += 1
    prefix[active] = length
    # positions in between: one less for each step behind the last position that was compared
    last = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
    prefix = prefix[last] - (np.arange(n) - last)
    prefix[before < 0] = 0
    return before, np.maximum(prefix, 0)


def _packed(text: np.ndarray, steps: int) -> np.ndarray:
    """At each position a 64-bit word of the next ``steps`` symbols of nine bits (seven at most)."""
    n = len(text)
    if n < steps:
        return np.empty(0, np.uint64)
    out = np.zeros(n - steps + 1, np.uint64)
    for i in range(steps):
        out = (out << np.uint64(9)) | text[i : n - steps + 1 + i].astype(np.uint64)
    return out
