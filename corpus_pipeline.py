"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is
written to the shared folder and read back before the next one begins, so a lost executor never costs
more than the running stage's own tasks. All stages but the last return the columns of ``documents``,
other columns included. No table, or a table without rows, gives an empty result.

SQL cannot express language profiles, MinHash or packing, so there is no twin; ``tests/llm`` compares the
dedup stages with brute force, the others by what they must keep and drop.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import bpe, exact, language, minhash, packing, recompress
from locusframe.llm.store import written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: A document goes if its likeness (1 less the out-of-place distance to the nearest language) is below this
#: share of what all but this share of the labelled documents of its length (a power of two) reach.
LIKE_SHARE, LIKE_QUANTILE = 0.5, 0.01
#: Labelled documents of a length below which those of all lengths tell the bound.
LEAST_LABELLED = 100
ORACLE_SQL = None


def _packed(docs: DataFrame, *more: Column) -> DataFrame:
    """All columns of a row in one, ``own``, so that no name a stage adds can clash with theirs."""
    return docs.select(F.struct(*docs.columns).alias("own"), *more)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, without text, or like none of the languages that ``lang`` names.

    A document whose ``lang`` is null is judged like any other; the profiles and bounds come from the others.
    """
    # judged twice, for the bounds and for the rows: cheaper than a second copy of all texts on disk
    judged = language.identify(_packed(docs, F.col("text").alias("text")), language.learn(docs), ["own"])
    size = F.floor(F.log2(F.greatest(F.char_length("own.text"), F.lit(1))))
    labelled = judged.filter("own.lang is not null and own.text is not null").withColumn("size", size)
    usual = [F.percentile_approx("score", LIKE_QUANTILE, 10_000).alias("like"), F.count(F.lit(1)).alias("n")]
    # one row for each power of two that a text's length can have, and one for all
    bounds = {r["size"]: r["like"] * LIKE_SHARE for r in labelled.rollup("size").agg(*usual).filter(f"(size is null or n >= {LEAST_LABELLED}) and like is not null").collect()}
    least = F.lit(bounds.pop(None, 0.0))
    if bounds:
        least = F.coalesce(F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[size], least)
    return judged.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least)).select("own.*")


#: Rows without an id, or with one that others have too, are numbered from here on.
FIRST_NUMBER = 1 << 62


def _with_ids(docs: DataFrame) -> DataFrame:
    """Rows with an id of their own each: doc_id, or a number where that is missing or not unique.

    Only the rows that need a number are written, so that the number stays the same in later jobs.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    repeated = ids.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")
    rows = _packed(docs, F.col("doc_id").cast("long").alias("id"))
    missing = not ids.filter("id is null").isEmpty()
    if not missing and repeated.isEmpty():
        return rows
    odd = rows.filter("id is null").unionByName(rows.join(repeated, "id", "left_semi").select(*rows.columns))
    numbered = written(odd.withColumn("id", F.lit(FIRST_NUMBER) + F.monotonically_increasing_id()), "numbered")
    return rows.filter("id is not null").join(repeated, "id", "left_anti").select(*rows.columns).unionByName(numbered)


def _first_of_each(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each group (id, group) the row with the smallest doc_id; null ids last, ties by number."""
    ranks = rows.select("id", F.struct(F.col("own.doc_id").isNull().alias("none"), F.col("own.doc_id").alias("doc_id"), "id").alias("rank"))
    stays = groups.join(ranks, "id").groupBy("group").agg(F.min("rank")["id"].alias("id")).select("id")
    return rows.join(stays, "id", "left_semi").select("own.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the row with the smallest doc_id stays, or one of those without id."""
    rows = _with_ids(docs)
    found = exact.exact_duplicates(rows.select(F.col("id").alias("doc_id"), F.col("own.text").alias("text")))
    return _first_of_each(rows, found.select(F.col("doc_id").alias("id"), F.col("keep_id").alias("group")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (shingles of five words, 0.8) the smallest doc_id stays."""
    rows = _with_ids(docs)
    found = minhash.near_duplicates(rows.select(F.col("id").alias("doc_id"), F.col("own.text").alias("text")))
    return _first_of_each(rows, found.select(F.col("doc_id").alias("id"), F.col("component_id").alias("group")))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out passages of 13 words or more that a smaller document has too.

    A changed text is its kept words joined by one space, and n_chars follows; other rows stay as they are.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("row_id"))
    cut = recompress.remove_repeats(rows, with_text=True)
    changed = {c: F.col(f"row_id.{c}") for c in others} | {"text": F.col("kept_text")}
    if "n_chars" in changed:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row_id.n_chars"))
    return cut.select(*[changed[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of all documents into sequences of 2048."""
    return packing.pack_documents(docs, bpe.Vocabulary(spark, TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
