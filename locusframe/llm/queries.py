"""The registered queries of this subpackage and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact, language, minhash, packing, phrases, quality, recompress, rtree, simhash, suffixes, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op2_substring_dedup",
    r"""
    WITH docs AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS words FROM documents),
    starts AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13),
    windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w FROM starts JOIN docs USING (doc_id)),
    least AS (SELECT w, min(doc_id) AS d FROM windows GROUP BY w),
    hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN least USING (w) WHERE d < doc_id),
    gone AS (SELECT doc_id, list(p) AS ps FROM hit GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
        sha256(array_to_string(CASE WHEN ps IS NULL THEN words ELSE list_filter(words, lambda x, j: NOT list_contains(ps, j)) END, ' ')) AS kept_sha256
    FROM docs LEFT JOIN gone USING (doc_id)
    """,
)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.remove_repeats(table(spark, sf_dir, "documents"))


@query(
    "op4_exact_dedup",
    r"""
    WITH texts AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM texts WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op5_bpe_round_trip")
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), bpe.Vocabulary(spark, TOKENIZER))


@query("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), bpe.Vocabulary(spark, TOKENIZER))


@query(
    "op7_minhash_near_dedup",
    r"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS words FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, unnest(list_transform(range(1, greatest(len(words) - 2, 2)), lambda i: array_to_string(words[i:i + 3], ' '))) AS s
            FROM docs WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
    near AS (SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
    links AS (SELECT u, v FROM near UNION ALL SELECT v, u FROM near),
    reach AS (SELECT doc_id AS d, doc_id AS r FROM docs UNION SELECT d, v FROM reach JOIN links ON r = u),
    least AS (SELECT d, min(r) AS component_id FROM reach GROUP BY d)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM docs JOIN least ON d = doc_id LEFT JOIN sizes USING (doc_id)
    """,
)
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4)


@query(
    "op1_warc_round_trip",
    r"""
    WITH payloads AS (
        SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    least AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM payloads)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
    FROM least
    """,
)
def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("stated_digest")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(table(spark, sf_dir, "documents"))


@query("op9_simhash_fingerprints")
def op9_simhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query(
    "op3_tool_call_linking",
    r"""
    WITH turns AS (SELECT conv_id, turn, role, text, conv_id || ':' || turn AS own FROM conversations),
    calls AS (SELECT *, CASE WHEN turn >= 2 THEN conv_id || ':' || (turn - 2) END AS after FROM turns WHERE role = 'user'),
    results AS (SELECT conv_id || ':' || (turn - 1) AS own, turn AS result_turn, text AS result FROM turns WHERE role = 'assistant'),
    chain AS (
        SELECT c.own, c.conv_id, c.turn, coalesce(sum(CASE WHEN p.own IS NULL THEN 1 ELSE 0 END) OVER w, 0) AS part
        FROM calls c LEFT JOIN calls p ON p.own = c.after WINDOW w AS (PARTITION BY c.conv_id, c.turn % 2 ORDER BY c.turn)),
    depth AS (SELECT own, row_number() OVER (PARTITION BY conv_id, turn % 2, part ORDER BY turn) - 1 AS depth FROM chain),
    linked AS (
        SELECT coalesce(c.own, r.own) AS call_id, c.own IS NOT NULL AS has_call, r.own IS NOT NULL AS has_result, c.turn, c.text, r.result_turn, r.result
        FROM calls c FULL JOIN results r ON c.own = r.own)
    SELECT call_id, turn, result_turn, CAST(has_call AS BIGINT) AS n_calls, CAST(has_result AS BIGINT) AS n_results, depth,
        concat_ws('; ',
            CASE WHEN has_call AND length(text) = 0 THEN '$.prompt: too short' END, CASE WHEN has_call AND length(text) > 400 THEN '$.prompt: too long' END,
            CASE WHEN NOT has_call THEN 'no call' END, CASE WHEN has_call AND NOT has_result THEN 'no result' END) AS faults,
        sha256('{"arguments":' || CASE WHEN has_call THEN '{"prompt":' || to_json(text) || ',"turn":' || turn || '}' ELSE 'null' END || ',"id":' || to_json(call_id)
            || ',"name":' || CASE WHEN has_call THEN '"reply"' ELSE 'null' END || ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null') || '}') AS json_sha256
    FROM linked LEFT JOIN depth ON own = call_id
    """,
)
def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.conversation_calls(table(spark, sf_dir, "conversations"))
    linked = chat.link_calls(calls, results, chat.REPLY_SCHEMA)
    return linked.withColumn("faults", F.concat_ws("; ", "faults")).withColumn("json_sha256", F.sha2("json", 256)).drop("json")


@query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op11_suffix_array_dedup",
    r"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (SELECT r, i, md5_number(substr(h, 2 * i + 1, 400)) AS w FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM docs WHERE len(h) >= 400)),
    again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
    hits AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), -1000) + 200 AS new FROM windows JOIN again USING (w)),
    numbered AS (SELECT r, i, sum(CAST(new AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS s FROM hits),
    spans AS (SELECT r, s, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY r, s),
    gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
    cut AS (
        SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
        FROM gaps JOIN docs USING (r) GROUP BY r)
    SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
        sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM docs LEFT JOIN cut USING (r)
    """,
)
def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents"))


@query(
    "op12_phrase_collocations",
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?

]')) AS p FROM documents),
    split AS (SELECT lang, list_filter(string_split_regex(p, '[ 	]+'), lambda x: x <> '') AS w FROM pieces),
    grams AS (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM split, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
    f AS (SELECT lang, g, len(g) AS k, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY lang, g),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, g, k, f AS a FROM f WHERE k >= 2 AND f >= 10),
    cuts AS (SELECT lang, g, k, a, unnest(range(1, k)) AS c FROM candidates),
    scored AS (
        SELECT x.lang, x.g, x.k, x.a, c, l.f AS l, r.f AS r, 1000000 * x.a * x.a // (l.f * r.f) AS score
        FROM cuts x JOIN f l ON l.lang = x.lang AND l.g = x.g[1:c] JOIN f r ON r.lang = x.lang AND r.g = x.g[c + 1:]),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
    inner_ AS (
        SELECT DISTINCT t.lang, t.g[j:j + 1] AS g, max(t.a) AS longest FROM candidates t, (SELECT unnest([1, 2]) AS j) WHERE t.k = 3 GROUP BY t.lang, t.g[j:j + 1]),
    kept AS (SELECT best.* FROM best LEFT JOIN inner_ i ON i.lang = best.lang AND i.g = best.g WHERE i.longest IS NULL OR 100 * i.longest < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase,
        CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
    FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
    """,
)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query(
    "op13_hard_negatives",
    r"""
    WITH usable AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id) WHERE NOT own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 3
    """,
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rtree.hard_negatives(table(spark, sf_dir, "embeddings"))
