"""Language identification by rank-order profiles of letter n-grams (out-of-place distance)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import LETTER, character_classes

#: N-grams in a language's profile, and most frequent n-grams of a document that are compared with it.
PROFILE = 400
#: Distinct n-grams that a training task holds per language before it hands them on.
HELD = 2_000_000
UNKNOWN = "und"
#: Shift of a letter within an n-gram code: 21 bits hold any code point.
LETTER_BITS = 21
BATCH_CHARS = 500_000


def letters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts with 0 for whatever is no letter, and each text's offset.

    Every text is framed by zeros, so no n-gram runs across two texts.
    """
    plain = [f" {t.lower()} " if t else " " for t in texts]
    code = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    code[character_classes()[code] != LETTER] = 0
    return code, np.concatenate([[0], np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))])


def grams_of(code: np.ndarray) -> np.ndarray:
    """Codes of the n-grams of 1 to 3 characters of one text: letters, and 0 for a word's edge."""
    if len(code) < 3:
        return np.empty(0, np.int64)
    a, b, c = code[:-2], code[1:-1], code[2:]
    middle = b != 0
    a, b, c = a[middle], b[middle], c[middle]
    # a unigram, both bigrams at a word's start (later ones by their second letter), and the trigram
    bigram = (b << LETTER_BITS) | c
    opening = b[a == 0]
    return np.concatenate([b, bigram | (1 << 62), opening | (1 << 62), (a << (2 * LETTER_BITS - 1)) ^ (b << LETTER_BITS) ^ c ^ (1 << 61)])


def ranked(code: np.ndarray, top: int) -> np.ndarray:
    """The ``top`` most frequent n-grams of a text in order; ties go by code."""
    grams = np.sort(grams_of(code))
    if len(grams) == 0:
        return grams
    heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    counts = np.diff(np.append(heads, len(grams)))
    if len(counts) > top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        chosen = np.flatnonzero(counts >= least)
        heads, counts = heads[chosen], counts[chosen]
    order = np.argsort(-counts, kind="stable")[:top]
    return grams[heads[order]]


class Profiles(NamedTuple):
    """Languages, the sorted n-grams of all profiles, and the rank of each in each language."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray

    def distances(self, code: np.ndarray) -> np.ndarray:
        """Mean out-of-place distance to each profile, from 0 (same order) to 1 (nothing in common)."""
        own = ranked(code, PROFILE)
        if len(own) == 0 or len(self.grams) == 0:
            return np.ones(len(self.languages))
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        ranks = self.ranks[:, at[known]]
        place = np.arange(len(own))[known]
        moved = np.where(ranks < PROFILE, np.abs(ranks - place), PROFILE)
        return (moved.sum(axis=1) + PROFILE * (~known).sum()) / (PROFILE * len(own))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        texts, languages = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for language in dict.fromkeys(languages):
            own = [t for t, x in zip(texts, languages) if x == language]
            start = weight = 0
            for i, t in enumerate(own):
                weight += len(t or "")
                if weight >= BATCH_CHARS or i == len(own) - 1:
                    grams, counts = np.unique(grams_of(letters_of(own[start : i + 1])[0]), return_counts=True)
                    if language in held:
                        old, had = held[language]
                        grams, at = np.unique(np.concatenate([old, grams]), return_inverse=True)
                        counts = np.bincount(at, weights=np.concatenate([had, counts])).astype(np.int64)
                    held[language] = (grams, counts)
                    start, weight = i + 1, 0
            if len(held[language][0]) > HELD:
                yield _gram_rows(language, *held.pop(language))
    for language, (grams, counts) in held.items():
        yield _gram_rows(language, grams, counts)


def _gram_rows(language: str, grams: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([language] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])


def learn(labelled: DataFrame) -> Profiles:
    """Profiles of all languages of ``labelled`` (text, lang not null), from all of its texts.

    Tasks sum the counts of their texts, Spark sums those of the tasks and keeps the ``PROFILE`` most
    frequent n-grams of each language; only these, ``PROFILE`` rows a language, come to the driver.
    """
    counts = labelled.select("text", "lang").filter("text is not null and lang is not null").mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < PROFILE)
    rows = top.select("lang", "gram", "rank").collect()
    languages = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), dtype=np.int64)
    ranks = np.full((len(languages), len(grams)), PROFILE, dtype=np.int64)
    for r in rows:
        ranks[languages.index(r["lang"]), np.searchsorted(grams, r["gram"])] = r["rank"]
    return Profiles(languages, grams, ranks)


def _predicted(profiles: Callable[[], Profiles], names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = profiles()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found: list[str] = []
            scores: list[float] = []
            start = weight = 0
            for i, t in enumerate(texts):
                weight += len(t or "")
                if weight >= BATCH_CHARS or i == len(texts) - 1:
                    code, offsets = letters_of(texts[start : i + 1])
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                        own = code[a:b]
                        if not model.languages or not own.any():
                            found.append(UNKNOWN)
                            scores.append(0.0)
                            continue
                        distance = model.distances(own)
                        best = int(distance.argmin())
                        found.append(model.languages[best])
                        scores.append(float(1 - distance[best]))
                    start, weight = i + 1, 0
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, profiles: Profiles, carry: list[str]) -> DataFrame:
    """Language of every whole text: the ``carry`` columns, lang_pred, score.

    The language is the one of least out-of-place distance (ties: the first by name); score is 1 less that
    distance, which is at most 1. A null text, or one without a letter, is ``und`` with score 0, and so is
    every text where no language was learned. Rows stay as they are, repeated or without id.
    """
    sent = docs.sparkSession.sparkContext.broadcast(profiles)  # a few hundred rows for each language
    rows = docs.select(*carry, *[c for c in ("text",) if c not in carry])
    kept = rows.select(*carry).schema
    schema = kept.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(_predicted(lambda: sent.value, carry), schema)


def held_out(doc_id, folds: int, fold: int):
    """Whether crc32 of the id as text leaves the remainder ``fold``; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def predict_languages(docs: DataFrame) -> DataFrame:
    """Learn from the documents whose crc32(doc_id) mod 4 is not 2, predict all.

    ``docs`` has doc_id, text and lang; the prediction sees the text alone. Result: doc_id, held_out,
    lang_pred, score.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    profiles = learn(rows.filter(~out))
    return identify(rows.select("doc_id", "text"), profiles, ["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")
