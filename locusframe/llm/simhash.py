"""SimHash fingerprints of whole texts, and all fingerprints within a Hamming radius.

Everything here is DataFrame and SQL functions. A term is a shingle of ``TERM_WORDS`` words (a shorter
text is one term); each occurrence casts 64 votes, one for each bit of its hash, so a term's weight is its
number of occurrences. Two counters share one long, which the votes of 2**31 words cannot overflow.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

TERM_WORDS = 5
BITS = 64
#: Blocks that the search permutes; a radius below it leaves whole blocks equal.
BLOCKS = 6
RADIUS = 3
#: Documents that are ordered together when each is handed the next one's text, and most such ranges.
RANGE_ROWS, MOST_RANGES = 2_000, 4_096
#: Stands for a missing doc_id, which sorts first.
NO_KEY = -(2**63)


def term_hashes(text: Column) -> Column:
    """A hash for each occurrence of a term; an empty text has none."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashed(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (TERM_WORDS - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(*[F.try_element_at(w, i + k) for k in range(TERM_WORDS)]))

    # the words are bound to a variable, so that they are split once and not for each term
    return F.flatten(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, hashed(w)).otherwise(F.array().cast("array<long>"))))


def voted_bits(term: Column) -> list[Column]:
    """Sums over the terms: votes for bit i in the lower and for bit i + 32 in the upper half of a long."""
    return [F.sum(F.shiftrightunsigned(term, i).bitwiseAND(F.lit((1 << 32) | 1))).alias(f"votes_{i}") for i in range(BITS // 2)]


def fingerprint_of(total: Column) -> Column:
    """The bits for which more than half of the terms voted; without terms no bit is set."""
    value = F.lit(0).cast("long")
    for i in range(BITS // 2):
        votes = F.coalesce(F.col(f"votes_{i}"), F.lit(0))
        low, high = votes.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(votes, 32)
        value = value.bitwiseOR(F.when(2 * low > total, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        value = value.bitwiseOR(F.when(2 * high > total, F.shiftleft(F.lit(1).cast("long"), i + 32)).otherwise(F.lit(0).cast("long")))
    return value


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def hex_text(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), BITS // 4, "0"))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (key, tie, text) with their place (span, turn) and the next row as ``following``.

    Rows are in order of doc_id, then of a hash of the text; the first row follows the last. They are
    sorted within ranges of ids (bounds by approximate percentiles). The first row of a range is copied to
    the end of the range before it, so each text is shuffled once. The table of first rows has
    ``MOST_RANGES`` rows at most and is broadcast; a range is sorted with spill and read in order.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_KEY)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select("key")
    ranges = max(1, min(MOST_RANGES, ids.count() // RANGE_ROWS))
    shares = [k / ranges for k in range(1, ranges)]
    bounds = sorted(set(ids.agg(F.percentile_approx("key", shares, 100 * ranges)).first()[0] or [])) if shares else []
    limits = F.array(*[F.lit(b) for b in bounds]).cast("array<long>")
    rows = rows.select("key", F.xxhash64("text").alias("tie"), "text", F.size(F.filter(limits, lambda b: b < F.col("key"))).alias("span"))
    heads = rows.groupBy("span").agg(F.min(F.struct("key", "tie")).alias("head"))
    turn = Window.orderBy("span")  # MOST_RANGES rows
    first = heads.select(F.col("head.key").alias("key"), F.col("head.tie").alias("tie"), F.lag("span").over(turn).alias("before"), F.max("span").over(turn.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("last"))
    first = first.select("key", "tie", F.coalesce("before", "last").alias("copy_to"))
    dealt = rows.join(F.broadcast(first), ["key", "tie"], "left")
    both = F.when(F.col("copy_to").isNull(), F.array("span")).otherwise(F.array("span", -1 - F.col("copy_to")))
    placed = dealt.select("key", "tie", "text", F.explode(both).alias("to"))
    placed = placed.select("key", "tie", "text", F.when(F.col("to") < 0, -1 - F.col("to")).otherwise(F.col("to")).alias("span"), (F.col("to") < 0).alias("copy"))
    order = Window.partitionBy("span").orderBy("copy", "key", "tie")
    return placed.select("*", F.row_number().over(order).alias("turn"), F.lead(F.struct("key", "tie", "text")).over(order).alias("following")).filter("not copy")


def edited_text() -> Column:
    """The last quarter of the code points replaced by the first as many of the next text."""
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("following.text"), F.lit(1), quarter))


def fingerprints(bodies: DataFrame, keys: list[str]) -> DataFrame:
    """``fingerprint`` (long) of each ``body``, by the key columns, which must tell the rows apart."""
    terms = bodies.select(*keys, F.explode_outer(term_hashes(F.col("body"))).alias("term"))
    votes = terms.groupBy(*keys).agg(F.count("term").alias("total"), *voted_bits(F.col("term")))
    return votes.select(*keys, fingerprint_of(F.col("total")).alias("fingerprint"))


def _blocks(value: Column) -> list[Column]:
    """The bits of each block, from the lowest on."""
    sizes = [BITS // BLOCKS + (k < BITS % BLOCKS) for k in range(BLOCKS)]
    starts = [sum(sizes[:k]) for k in range(BLOCKS)]
    return [F.shiftrightunsigned(value, a).bitwiseAND(F.lit((1 << n) - 1)) for a, n in zip(starts, sizes)]


def within_radius(queries: DataFrame, fps: DataFrame) -> DataFrame:
    """All fingerprints within ``RADIUS`` bits of each query: query, fingerprint, distance.

    Both sides have one column of distinct longs, ``query`` and ``fingerprint``. Of ``BLOCKS`` blocks, at
    least BLOCKS - RADIUS are equal in such a pair; there is one table for each choice of that many blocks,
    with these blocks moved to the front as its key. A pair found in several tables is returned by the
    first of them.
    """
    choices = list(combinations(range(BLOCKS), BLOCKS - RADIUS))

    def tables(df: DataFrame, name: str) -> DataFrame:
        parts = _blocks(F.col(name))
        keys = [F.struct(F.lit(k).alias("choice"), F.xxhash64(F.lit(k), *[parts[b] for b in chosen]).alias("front")) for k, chosen in enumerate(choices)]
        return df.select(name, F.explode(F.array(*keys)).alias("entry")).select(name, "entry.choice", "entry.front")

    found, asked = tables(fps, "fingerprint"), tables(queries, "query").withColumnRenamed("choice", "asked_choice")
    apart = F.col("query").bitwiseXOR(F.col("fingerprint"))
    equal = sum((F.when(b == 0, F.lit(1 << k)).otherwise(F.lit(0)) for k, b in enumerate(_blocks(apart))), F.lit(0))
    first = [next((k for k, c in enumerate(choices) if all(mask >> b & 1 for b in c)), -1) for mask in range(1 << BLOCKS)]
    earliest = F.element_at(F.array(*[F.lit(k) for k in first]), equal + 1)
    match = (found["front"] == asked["front"]) & (F.col("choice") == F.col("asked_choice")) & (F.bit_count(apart) <= RADIUS) & (earliest == F.col("choice"))
    return found.join(asked, match).select("query", "fingerprint", F.bit_count(apart).alias("distance"))


def edited_fingerprints(docs: DataFrame, query_every: int = 100) -> DataFrame:
    """Fingerprints of every whole text and of its edited form.

    ``docs`` has doc_id and text; a null text counts as empty. The edited text has its last floor(n/4)
    code points replaced by the first as many of the next document by doc_id (the first one's after the
    last). Result, one row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited, near_next (share of equal bits), and for ids divisible by ``query_every`` within_radius:
    the number of other rows whose fingerprint differs in ``RADIUS`` bits or fewer. An empty text has
    fingerprint 0. Rows without id come first in the order; rows with equal id and text stay rows of their
    own. Other columns are not read.
    """
    placed = with_next(docs)
    place = ["span", "turn"]
    bodies = placed.select(*place, F.posexplode(F.array(F.col("text"), edited_text())).alias("form", "body"))
    both = fingerprints(bodies, [*place, "form"])
    own = both.groupBy(*place).agg(F.max(F.when(F.col("form") == 0, F.col("fingerprint"))).alias("own"), F.max(F.when(F.col("form") == 1, F.col("fingerprint"))).alias("edited"))
    facts = placed.select(
        *place, "key", "tie", F.char_length("text").cast("long").alias("n_chars"), F.sha2(edited_text(), 256).alias("edited_sha256"),
        F.col("following.key").alias("next_key"), F.col("following.tie").alias("next_tie"),
    )
    rows = written(facts.join(own, place), "fingerprints")
    after = rows.groupBy(F.col("key").alias("next_key"), F.col("tie").alias("next_tie")).agg(F.max("own").alias("next_own"))
    prints = rows.groupBy(F.col("own").alias("fingerprint")).agg(F.count(F.lit(1)).alias("rows"))
    asked = rows.filter((F.col("key") != NO_KEY) & (F.col("key") % query_every == 0)).select(F.col("own").alias("query")).distinct()
    near = within_radius(asked, prints.select("fingerprint")).join(prints, "fingerprint").groupBy("query").agg((F.sum("rows") - 1).alias("near"))
    joined = rows.join(after, ["next_key", "next_tie"]).join(near, rows["own"] == near["query"], "left")
    is_query = (F.col("key") != NO_KEY) & (F.col("key") % query_every == 0)
    return joined.select(
        F.nullif("key", F.lit(NO_KEY)).alias("doc_id"), "n_chars", "edited_sha256", hex_text(F.col("own")).alias("fingerprint"), hex_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"), F.when(is_query, F.col("near")).alias("within_radius"),
    )
