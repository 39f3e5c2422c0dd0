"""Operators for corpora against brute force, on small tables with nulls, ties, empty and odd texts."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusframe.llm import bpe, chat, components, exact, language, minhash, packing, quality, recompress, simhash, warc

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, range int, salt string, chunk string, left string"
ODD = [None, "", " \t\n", "a", "ΣΑΣ İ <|endoftext|>'s 'll 12½", "x" * 300, "漢字 かな"]


def documents(spark, seed=1):
    """Copies, near copies, shared passages, odd texts, a null id and a repeated row; columns that clash."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 6)))
    passage = [word() for _ in range(60)]
    texts = list(ODD)
    for _ in range(30):
        own = [word() for _ in range(draw.randint(1, 120))]
        if draw.random() < 0.5:
            at = draw.randint(0, len(own))
            own[at:at] = passage[draw.randint(0, 20) :]
        texts.append(" ".join(own))
    base = texts[-1].split()
    texts += [texts[-2], texts[-2].replace(" ", "\n\t"), "", None]
    for _ in range(12):
        near = list(base)
        near[draw.randrange(len(near))] = word()
        texts.append(" ".join(near))
    rows = [(i * 7, t, draw.choice(["de", "en", None]), None, len(t or ""), 1, "s", "c", "l") for i, t in enumerate(texts)]
    rows += [rows[10], (None, texts[12], None, None, None, None, None, None, None), (10_000, " ".join(["spin"] * 40), "en", "s", 1, 1, "", "", "")]
    draw.shuffle(rows)
    return spark.createDataFrame(rows, DOCS), [(r[0], r[1]) for r in rows]


def key(i):
    return 2**63 - 1 if i is None else i


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(spark, PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8")) | st.sampled_from([t for t in ODD if t]), max_size=4))
def test_bpe_is_the_librarys(texts):
    own, theirs = bpe._loaded(open(PATH, encoding="utf-8").read()), Tokenizer.from_file(PATH)
    ids, offsets = own.encode(texts)
    for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert ids[a:b].tolist() == theirs.encode(text, add_special_tokens=False).ids


def test_encode_decode(spark, vocabulary):
    docs, rows = documents(spark)
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.encode_decode(docs, vocabulary).collect())) == want
    assert bpe.encode_decode(docs.limit(0), vocabulary).count() == 0


def test_packing(spark, vocabulary):
    docs, rows = documents(spark)
    long = docs.unionByName(spark.createDataFrame([(77_777, "word " * 9000)], "doc_id long, text string"), allowMissingColumns=True)
    library = Tokenizer.from_file(PATH)
    got = packing.pack(packing.pieces_of(long, vocabulary), shard_pieces=20).toPandas()
    for doc, text in rows:
        if doc is not None and sum(r[0] == doc for r in rows) == 1:
            ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
            piece = got[got.doc_id == doc]
            assert piece["length"].tolist() == [len(ids)]
            assert piece["ids_crc32"].iloc[0] == zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(got[got.doc_id == 77_777]["length"]) == sorted([2048] * 4 + [9001 - 4 * 2048])
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum()[:-1]] and own["length"].sum() <= 2048
    assert got.sequence_id.nunique() == -(-got["length"].sum() // 2048)
    assert packing.pack_documents(docs.limit(0), vocabulary).count() == 0


def test_local_search_empties_bins():
    lengths = [6, 6, 4, 4, 5, 5, 3, 7]
    bins = packing.local_search([[i] for i in range(len(lengths))], lengths, 10)
    assert len(bins) == 4 and sorted(i for b in bins for i in b) == list(range(8))


def test_exact(spark):
    docs, rows = documents(spark)
    normal = lambda t: __import__("re").sub(r"[ \t-\r]+", " ", t or "")
    groups = {}
    for i, text in rows:
        groups.setdefault(normal(text), []).append(key(i))
    want = Counter()
    for i, text in rows:
        own = groups[normal(text)]
        keep = None if min(own) == key(None) else min(own)
        want[(i, keep, len(own), i == keep, hashlib.sha256(normal(text).encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact.exact_duplicates(docs).collect())) == want
    assert exact.exact_duplicates(docs.limit(0)).count() == 0


@settings(max_examples=500, deadline=None)
@example([b"\x00", b"\x01", b"\x02", b"\x03", b"\x04", b"\x05", b"\x96\x00", b"\x96"])
@example([bytes([a, b, 0]) for a in (1, 2) for b in range(60)])
@given(st.lists(st.binary(max_size=6) | st.sampled_from([b"aaaa", b"aaab", b"aaaaa"]), max_size=80))
def test_trie_spills_and_stays_right(texts):
    trie = exact.PatriciaTrie(limit=2_000)
    want = {}
    for i, text in enumerate(texts):
        trie.insert(text, 1000 - i, 1, ("t",))
        want[text] = [1000 - i, want.get(text, [0, 0])[1] + 1, ("t",)]
        assert trie.bytes <= 2_000 + 600
    assert dict(trie.owners()) == want


def windows_gone(rows):
    first = {}
    for i, text in rows:
        w = words(text)
        for s in range(len(w) - 12):
            k = tuple(w[s : s + 13])
            first[k] = min(first.get(k, key(None)), key(i))
    for i, text in rows:
        w = words(text)
        gone = {p for s in range(len(w) - 12) if first[tuple(w[s : s + 13])] < key(i) for p in range(s, s + 13)}
        yield i, len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest()


@pytest.mark.parametrize("chunk_bytes", [600, 8 << 20])
def test_substring(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(recompress, "CHUNK_BYTES", chunk_bytes)
    docs, rows = documents(spark)
    assert Counter(map(tuple, recompress.remove_repeats(docs).collect())) == Counter(windows_gone(rows))
    assert recompress.remove_repeats(docs.limit(0)).count() == 0


def jaccard_components(rows, size):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()
        sets[i] = {tuple(w[s : s + size]) for s in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and root[b] > root[a]:
                    root[b] = root[a]
                    changed = True
    return Counter((i, len(sets[i]), None if i is None else root[i], i is None or root[i] == i) for i, _ in rows)


@pytest.mark.parametrize(("size", "tile"), [(4, 256), (5, 3)])
def test_near(spark, monkeypatch, size, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    docs, rows = documents(spark)
    assert Counter(map(tuple, minhash.near_duplicates(docs, size).collect())) == jaccard_components(rows, size)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (50, 60), (60, 50)]
    got = {tuple(r) for r in components.connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(50, 50), (60, 50)}


def test_language(spark):
    texts = {"de": "der die das und nicht ein eine schön heißt", "fr": "le la les et pas une où était naïf"}
    rows = [(i, " ".join(random.Random(i).choices(texts[x].split(), k=40)), x) for i in range(40) for x in [["de", "fr"][i % 2]]]
    rows += [(100, None, "de"), (101, "12 34 !!", None), (102, "", "fr"), (None, rows[0][1], "de")]
    got = {r["doc_id"]: r for r in language.predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(got) == len(rows)
    for i, text, lang in rows[:40]:
        assert got[i]["lang_pred"] == lang and 0 < got[i]["score"] <= 1 and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    nothing = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.predict_languages(nothing).first()["lang_pred"] == "und"


def test_ranks_by_brute_force():
    code, _ = language.letters_of(["abba ab ü"])
    text = "\0abba\0ab\0ü\0"
    grams = Counter(text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1))
    assert len(np.unique(language.grams_of(code))) == sum(1 for g in grams if g.strip("\0") and (len(g) < 3 or g[1] != "\0"))


def test_quality(spark):
    draw = random.Random(3)
    prose = lambda: " ".join(draw.choice(["the", "of", "stone", "river", "walked", "and"]) for _ in range(60)) + "."
    junk = lambda: " ".join(draw.choice(["BUY!!!", "###", "$$$ NOW", "CLICK"]) for _ in range(60))
    rows = [(i, prose() if i % 3 else junk()) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)] + [(7, None), (None, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "x")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    assert all(got[i]["predicted"] == int(i % 3 > 0) for i in range(300) if got[i]["held_out"])
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 303
    assert {r["score"] for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_simhash(spark):
    docs, rows = documents(spark)
    docs = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    order = sorted({i: t or "" for i, t in rows if i is not None}.items())
    got = {r["doc_id"]: r for r in simhash.edited_fingerprints(docs, query_every=7).collect()}
    assert len(got) == len(order)
    likeness = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 64
    for k, (i, text) in enumerate(order):
        after, after_text = order[(k + 1) % len(order)]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after_text[:quarter]
        own = got[i]
        assert own["n_chars"] == len(text) and own["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert own["near_next"] == pytest.approx(likeness(own["fingerprint"], got[after]["fingerprint"]))
        assert own["near_edited"] == pytest.approx(likeness(own["fingerprint"], own["edited_fingerprint"]))
        near = sum((int(own["fingerprint"], 16) ^ int(r["fingerprint"], 16)).bit_count() <= simhash.RADIUS for r in got.values()) - 1
        assert own["within_radius"] == (near if i % 7 == 0 else None)
    same = {}
    for i, text in order:
        assert same.setdefault(text, got[i]["fingerprint"]) == got[i]["fingerprint"]
    assert simhash.edited_fingerprints(docs.limit(0)).count() == 0


def test_warc(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    long = "<p>é" + "x" * 120
    rows = [(5, "u", long), (3, None, long), (9, "http://a/\r\nb", long), (4, "u", "short"), (2, "u", "short"), (7, None, None), (8, "", ""), (None, "u", long), (3, "u", long)]
    rows += [(100 + i, "u", f"page {i} " * 40) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i != 3
        want[(i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 3 if again else None)] += 1
    got = warc.round_trip(pages)
    assert Counter(tuple(r)[:5] for r in got.collect()) == want
    folder, index = warc.write_archives(pages)
    some = warc.read_records(folder, index.filter("page_id >= 150")).collect()
    assert sorted(r["page_id"] for r in some) == list(range(150, 160))
    assert all(bytes(r["block"]).decode() == f"page {r['page_id'] - 100} " * 40 for r in some)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chat(spark):
    calls = [("a", 0, "add", '{"x": 1}', None), ("b", 2, "add", '{"x": "1"}', "a"), ("c", 4, "add", "{", "b"), ("d", 6, "no", "{}", "gone"), ("e", 7, "add", '{"x":2}', "f"), ("f", 8, "add", '{"x":2}', "e"), ("a", 9, "add", '{"x": 3}', None), (None, 9, "add", "{}", None)]
    results = [("a", 1, "ok"), ("b", 1, "é"), ("z", 3, "lost"), (None, 4, "x")]
    schema = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer"}}}}
    linked = chat.link_calls(spark.createDataFrame(calls, "call_id string, turn long, name string, arguments string, after string"), spark.createDataFrame(results, "call_id string, turn long, result string"), schema)
    got = {r["call_id"]: r for r in linked.collect()}
    assert {k: (r["depth"], r["faults"]) for k, r in got.items()} == {
        "a": (0, ["repeated call"]), "b": (1, ["$.x: not integer", "result before call"]), "c": (2, ["$: not JSON", "no result"]), "d": (0, ["no result", "unknown tool"]),
        "e": (None, ["cycle", "no result"]), "f": (None, ["cycle", "no result"]), "z": (None, ["no call"]),
    }
    assert got["a"]["json"] == '{"arguments":{"x":1},"id":"a","name":"add","result":"ok"}'


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, rows = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path)).cache()
        assert kept.columns == docs.columns, name
        if name == "language_id":
            assert kept.filter("text is null or text = ''").count() == 0
        if name == "exact_dedup":
            ids = [r["doc_id"] for r in kept.filter("doc_id is not null").collect()]
            assert len(set(ids)) == len([t for t in {" ".join((r["text"]).split()) for r in kept.filter("doc_id is not null").collect()}])
            before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        if name == "near_dedup":
            want = {i for (i, _, c, k) in jaccard_components(before, 5) if k}
            assert {r["doc_id"] for r in kept.collect()} == want
            before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        if name == "substring_dedup":
            want = Counter((i, h) for i, _, _, h in windows_gone(before))
            assert Counter((r["doc_id"], hashlib.sha256(b" ".join(words(r["text"]))).hexdigest()) for r in kept.collect()) == want
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(packed.doc_id.dropna().astype(int)) == {r["doc_id"] for r in kept.filter("doc_id is not null").collect()}
