"""JSON documents with the checks that Spark's own JSON reader does not make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that the variant parser holds of one document at most.
VARIANT_LIMIT = 128 << 20
# Characters of one string that either JSON reader takes at most.
STRING_LIMIT = 20_000_000

def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``(source, value)``."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source"), "value")


def json_violation(text: Column) -> Column:
    """``missing``, ``non_finite``, ``duplicate_key``, ``too_large``, ``malformed`` or null, at any nesting depth.

    The variant parser refuses repeated keys, bare NaN and bad syntax alike; only refused texts are looked
    at again to tell which it was. A text with several faults is named by the first of the list. A readable
    text that may have been refused for its size alone is ``too_large``, whether or not a key repeats, and so is
    an unreadable one with a string longer than the readers take.
    """
    outside = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', '""')
    # in brackets, whatever follows the document breaks it or makes a second member
    held = F.concat(F.lit("["), text, F.lit("]"))
    parsed = F.try_parse_json(held)
    strict = F.try_variant_get(parsed, "$[0]", "variant").isNotNull() & F.try_variant_get(parsed, "$[1]", "variant").isNull()
    # the path reader minds no repeated key, but takes single quotes
    lenient = F.get_json_object(held, "$[0]").isNotNull() & F.get_json_object(held, "$[1]").isNull() & ~outside.contains("'")
    # a value takes its text and, for each sign outside of strings, four bytes of numbers and offsets at most
    fits = F.octet_length(text) + F.length(outside).cast("bigint") * 4 + 64 < VARIANT_LIMIT
    strings = F.regexp_extract_all(F.regexp_replace(text, r"\\.", "_"), F.lit('"[^"]*+"'), F.lit(0))
    long_string = F.exists(strings, lambda s: F.length(s) - 2 > STRING_LIMIT)
    return (
        F.when(text.isNull(), "missing")
        .when(strict, F.lit(None).cast("string"))
        .when(outside.rlike(r"(^|[\[:, \t\r\n-])(NaN|Infinity)([\]}, \t\r\n]|$)"), "non_finite")
        .when(lenient & fits, "duplicate_key")
        .when(lenient | ((F.length(text) > STRING_LIMIT) & long_string), "too_large")
        .otherwise("malformed")
    )
