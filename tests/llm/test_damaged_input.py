"""Inputs that once stopped a job or slipped through: odd JSON, clashing columns, repeated and missing ids, noise."""

import base64
import random
from collections import Counter

import pytest
from test_operators import documents

from locusframe.llm import chat, language, minhash


def test_odd_json_is_told_not_fatal(spark):
    texts = {
        "nan": ('{"a":NaN}', "$: not finite"), "huge": ('{"a":1e999}', "$: not finite"), "half": ('{"a":"\\ud800"}', "$: not text"), "deep": ("[" * 100_000 + "]" * 100_000, "$: too deep"),
        "twice": ('{"a":1,"a":2}', "$: repeated key"), "long": ("1" * 6000, "$: not JSON"), "true": ('{"a":true}', "$.a: not allowed"), "one": ('{"a":1.0}', None),
    }
    calls = spark.createDataFrame([(k, 0, "t", v, None) for k, (v, _) in texts.items()], "call_id string, turn long, name string, arguments string, after string")
    results = spark.createDataFrame([(k, 1, "r") for k in texts], "call_id string, turn long, result string")
    got = {r.call_id: r for r in chat.link_calls(calls, results, {"t": {"properties": {"a": {"enum": [1]}}}}).collect()}
    assert {k: r.faults for k, r in got.items()} == {k: [fault] if fault else [] for k, (_, fault) in texts.items()}
    assert '"arguments":"{\\"a\\":NaN}"' in got["nan"].json and '"arguments":{"a":1.0}' in got["one"].json


def test_texts_under_one_id_are_judged_by_themselves(spark):
    words = [f"w{i}" for i in range(100)]
    near = [*words[:50], "x", *words[51:]]
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(1, " ".join(words)), (2, other), (2, " ".join(near)), (2, other), (3, other), (4, " ".join(near))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1), (2, 1), (2, 2), (2, 2), (3, 2), (4, 1)]


NAMES = ["lang_pred", "score", "_gone", "_digest", "row_no", "own", "group", "size"]


@pytest.fixture(scope="module")
def rows_with_clashes(spark):
    table, _ = documents(spark)
    words = "the of and to in that was for on are".split()
    draw = random.Random(6)
    prose = [" ".join(draw.choice(words) for _ in range(60)) for _ in range(30)]
    noise = ["".join(draw.choice("bcdfghjklmnpqrstvwxz") for _ in range(300)), base64.b64encode(draw.randbytes(300)).decode()]
    rows = [(100 + i, t, "en", "kept") for i, t in enumerate(prose)]
    rows += [(None, prose[0], "en", "copy"), (None, "alone " + prose[1], "en", "first"), (None, "alone " + prose[1], "en", "second"), (500, noise[0], None, "noise"), (501, noise[1], None, "noise")]
    names = ", ".join(f"{n} string" for n in NAMES)
    return spark.createDataFrame([(i, t, lang, kind, len(t), *[kind] * len(NAMES)) for i, t, lang, kind in rows], f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def test_stages_keep_clashing_columns_and_drop_copies_without_id(spark, rows_with_clashes):
    import corpus_pipeline as pipeline

    kept = rows_with_clashes
    stages = dict(pipeline.STAGES)
    kept = stages["language_id"](spark, kept, "")
    assert kept.columns == rows_with_clashes.columns
    assert kept.filter("source = 'noise'").count() == 0 and kept.count() == rows_with_clashes.count() - 2
    kept = stages["exact_dedup"](spark, kept, "")
    assert kept.columns == rows_with_clashes.columns
    found = kept.collect()
    assert len(found) == 31 and sum(r.doc_id is None for r in found) == 1
    assert all(r[name] == r.source for r in found for name in NAMES)
    near = stages["near_dedup"](spark, kept, "")
    assert near.columns == rows_with_clashes.columns and near.filter("doc_id is null").count() == 0
    assert near.count() == 30


def brute_ranks(texts):
    """N-gram codes of texts by falling count, then code, counted letter by letter."""
    found = Counter()
    for text in texts:
        marks = [ord(c) if c.isalpha() else 0 for c in f" {text.lower()} "]
        for before, letter, after in zip(marks, marks[1:], marks[2:]):
            if letter:
                found.update([letter, letter << 21 | after | 1 << 62, before << 41 ^ letter << 21 ^ after ^ 1 << 61])
                found.update([letter | 1 << 62] if not before else [])
    return sorted(found, key=lambda g: (-found[g], g))[:400]


def test_distance_by_brute_force(spark):
    """The out-of-place distance to whole profiles, place by place."""
    draw = random.Random(9)
    texts = {lang: ["".join(draw.choice(letters) for _ in range(900)) for _ in range(3)] for lang, letters in (("a", "abcdefghijk  e"), ("b", "aefglmnopqr  b"), ("c", "éüabstuvwxy  "))}
    profiles = language.learn(spark.createDataFrame([(lang, t) for lang, ts in texts.items() for t in ts], "lang string, text string"))
    for probe in ("".join(draw.choice("abcdefg é") for _ in range(200)), "a", "éé éé", "".join(draw.choice("abcdefghijklmnopqrst ") for _ in range(3000))):
        own = brute_ranks([probe])
        want = []
        for lang in "abc":
            place = {g: i for i, g in enumerate(brute_ranks(texts[lang]))}
            want.append(sum(abs(place[g] - i) if g in place else 400 for i, g in enumerate(own)) / (400 * len(own)))
        assert profiles.languages == ["a", "b", "c"]
        assert profiles.distances(language.letters_of([probe])[0]).tolist() == pytest.approx(want)
