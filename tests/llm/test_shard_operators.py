"""Suffix arrays, collocations and hard negatives against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from locusframe.llm import induced, phrases, rtree, suffixes

from test_operators import documents


@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([0, 1, 64, 10**9]))
@example([1] * 50, 1)
@example([2, 1] * 30, 10**9)
@settings(max_examples=150, deadline=None)
def test_induced_order_and_common_prefixes(symbols, bucket_symbols):
    text = np.array([*symbols, 0])
    kept, induced.BUCKET_SYMBOLS = induced.BUCKET_SYMBOLS, bucket_symbols
    try:
        order = induced.suffix_array(text, 5)
    finally:
        induced.BUCKET_SYMBOLS = kept
    want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert order.tolist() == want
    before, common = induced.common_prefixes(text, order)
    for a, b in zip(want, want[1:]):
        same = 0
        while text[a + same] == text[b + same]:
            same += 1
        assert before[b] == a and common[b] == same


def brute_repeats(texts, window):
    """(bytes, removed, spans, digest of the rest) of each text, by counting every string."""
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        rest = bytes(np.frombuffer(t, np.uint8)[~gone].tobytes())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("local_many, many, chunk_bytes", [(32, 256, 8 << 20), (1, 2, 700), (2, 3, 3000)])
def test_repeated_bytes(spark, monkeypatch, local_many, many, chunk_bytes):
    """Whole anchors, anchors split by their windows, one chunk and many."""
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", chunk_bytes * 2)
    monkeypatch.setattr(suffixes, "HOME_BYTES", 400)
    table, given_rows = documents(spark)
    draw = random.Random(4)
    line = "".join(draw.choice("abcdefgh ") for _ in range(70))
    more = ["x" * 500, "ab" * 300, line * 2, "ß" * 45, "a\0b" * 30]
    more += ["".join(draw.choice("abcdefgh ") for _ in range(draw.randint(0, 60))) + line + "".join(draw.choice("abcdefgh ") for _ in range(60)) for _ in range(15)]
    extra = spark.createDataFrame([(1000 + i, t, "en", "s", len(t), 1, "", "", "") for i, t in enumerate(more)], table.schema)
    window = 45
    texts = [(i, (t or "").encode()) for i, t in given_rows] + [(1000 + i, t.encode()) for i, t in enumerate(more)]
    want = sorted(str((i, *row)) for (i, _), row in zip(texts, brute_repeats([t for _, t in texts], window)))
    docs = table.unionByName(extra)
    got = suffixes.remove_repeated_bytes(docs, window, local_many=local_many, many=many)
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    if many == 256:
        whole = suffixes.remove_repeated_bytes(docs, window, with_text=True).collect()
        assert all(len(r.kept_text.encode()) >= r.n_bytes - r.n_removed for r in whole)
        assert suffixes.remove_repeated_bytes(docs.limit(0)).count() == 0


def brute_collocations(rows, least, top):
    """Collocations as the operator's docstring states them."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in often.items():
            if any(len(t) > len(g) and g in (t[:2], t[1:]) and 100 * b >= 50 * a for t, b in often.items()):
                continue
            cuts = [(1000000 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), a, counts[g[:k]], counts[g[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least, top, small", [(2, 2000, False), (3, 7, True)])
def test_collocations(spark, monkeypatch, least, top, small):
    if small:
        monkeypatch.setattr(phrases, "CHUNK_BYTES", 400)
        monkeypatch.setattr(phrases, "SHARD_BYTES", 300)
        monkeypatch.setattr(phrases, "RANKED_ROWS", 10)
    table, _ = documents(spark)
    draw = random.Random(8)
    words = ["The", "the", "café", "of", "New", "york", "CITY", "a", "ÄB"]
    texts = [" ".join(draw.choice(words) + draw.choice(["", "", "", ".", ",\t", "!?", "\v"]) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    texts += ["new york city"] * 300 + [" \t", "...", None, ""]
    extra = spark.createDataFrame([(5000 + i if i % 9 else None, t, draw.choice(["en", "de", None]), "s", 1, 1, "", "", "") for i, t in enumerate(texts)], table.schema)
    docs = table.unionByName(extra)
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = phrases.collocations(docs, least, top)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, least, top)
    assert phrases.collocations(docs.limit(0)).count() == 0


@pytest.mark.parametrize("width", [1, 2, 17, 21, 22, 27, 40])
def test_filters_lose_nothing(width):
    """Packed phrases come back from their permutation, and entries from a filter, wide numbers too."""
    packing = phrases.Packing(width)
    draw = np.random.default_rng(width)
    words = [draw.integers(0, 1 << width, 500) for _ in range(3)]
    high, low = packing.permuted(*words)
    assert all((a == b).all() for a, b in zip(packing.words(high, low), words))
    n = draw.integers(1, 600, 500)
    high, low, n = phrases._counted(high, low, n, packing.r, packing.bits)
    below = min(packing.q, 12)
    high = high & np.uint64((1 << below) - 1)
    order = np.lexsort((low, high))
    entries = high[order], low[order], n[order]
    row = phrases.to_filter(*entries, 1 << below, packing.r)
    assert all((a == b).all() for a, b in zip(phrases.from_filter(row, 1 << below, packing.r), entries))


def brute_negatives(rows, every=50):
    usable = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.add((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for anchor, own, vector in usable:
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, other)), i, label) for i, label, other in usable if i != anchor and len(other) == len(vector)]
        for p, positive in sorted((s, i) for s, i, label in scored if label == own)[:5]:
            fits = sorted((s, i) for s, i, label in scored if label != own and 50 * -p <= 100 * -s <= 95 * -p)[:3]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fits, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, leaf_rows", [(16_000, 128), (40, 3)])
def test_hard_negatives(spark, shard_rows, leaf_rows):
    draw = random.Random(3)
    rows = [(i, [round(draw.gauss(0, 0.2), 2) for _ in range(5)], draw.randint(0, 3)) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5, 0.5], draw.randint(0, 3)) for i in range(80)]  # one vector many times
    rows += [rows[50], (50, [0.1] * 5, 1), (2050, [0.25, 0.5], 1), (2051, [0.25, 0.5], 1), (2053, [0.2, 0.4], 2)]
    rows += [(2100, None, 1), (2150, [0.1, None], 1), (2200, [float("nan")] * 5, 1), (2250, [float("inf")] * 5, 1), (2300, [0.3] * 5, None), (None, [0.3] * 5, 1), (2350, [], 1), (2351, [], 1), (2353, [], 2)]
    rows = [(i, v, label, 7) for i, v, label in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, shard int")
    given_rows = [(r.vec_id, r.embedding, r.label) for r in table.collect()]
    got = rtree.hard_negatives(table, shard_rows=shard_rows, leaf_rows=leaf_rows, block_anchors=3)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(given_rows)
    assert rtree.hard_negatives(table.limit(0)).count() == 0


def test_hard_negatives_of_huge_components(spark):
    """Components whose products no double and no long holds are still compared exactly."""
    draw = random.Random(5)
    rows = [(i, [draw.choice([1.0, 3.0, 1e12, 1e5]) * (1 + i % 3) for _ in range(3)], i % 2) for i in range(0, 120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    most = 2**63 - 1
    want = [(*r[:4], min(r[4], most), min(r[5], most)) for r in brute_negatives(rows)]
    assert sorted(tuple(r) for r in rtree.hard_negatives(table).collect()) == sorted(want)
