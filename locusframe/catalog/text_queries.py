"""Text hygiene queries over whole documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import evidence, text
from ..plans import acceptance
from .registry import query, view

URL_SQL = text.URL.replace("'", "''")


def _hits(column: str) -> str:
    cases = [f"CASE WHEN regexp_matches({column}, '{p.replace(chr(39), chr(39) * 2)}') THEN '{n}' END" for n, p in text.DETECTORS.items()]
    return f"array_to_string(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL), ',')"


@query("sc19_url_redaction", f"""
SELECT page_id, regexp_replace(url, '{URL_SQL}', '\\1\\2', 'g') AS url, sha256(regexp_replace(html, '{URL_SQL}', '\\1\\2', 'g')) AS html FROM pages
""")
def url_redaction(t):
    return t.read("pages").select("page_id", text.redact_urls(F.col("url")).alias("url"), F.sha2(text.redact_urls(F.col("html")), 256).alias("html"))


@query("sc20_detectors", f"SELECT doc_id, {_hits('text')} AS hits FROM documents")
def detectors(t):
    return t.read("documents").select("doc_id", F.array_join(text.hits(F.col("text")), ",").alias("hits"))


@query("sc20_conversation_detectors", f"SELECT conv_id, turn, {_hits('text')} AS hits FROM conversations")
def conversation_detectors(t):
    return t.read("conversations").select("conv_id", "turn", F.array_join(text.hits(F.col("text")), ",").alias("hits"))


@query("sc21_path_tokens", """
SELECT event_id, '{"path": "$INTEGRATION_ROOT/run/' || event_id || '", "home": "$USER_HOME/x", "/srv/key": "/srvs/x and $USER_HOME", "not": "a/srv/work", "props": ' || props || '}' AS "value" FROM events
""")
def path_tokens(t):
    value = F.concat(F.lit('{"path": "/srv/work/run/'), "event_id", F.lit('", "home": "/srv/x", "/srv/key": "/srvs/x and /srv", "not": "a/srv/work", "props": '), "props", F.lit("}"))
    return t.read("events").select("event_id", text.redact(value, {"/srv": "$USER_HOME", "/srv/work": "$INTEGRATION_ROOT"}).alias("value"))


@query("sc20_credential_keys", """
SELECT event_id, event_id % 37 = 0 OR event_id % 41 = 0 AS credential FROM events
""")
def credential_keys(t):
    body = F.concat(F.when(F.col("event_id") % 37 == 0, '{"Api_Key": 1, "p": ').when(F.col("event_id") % 41 == 0, '{"n": [{"m": {"Password" : 1}}], "p": ').when(
        F.col("event_id") % 43 == 0, '{"n": "a \\"secret\\": x", "p": ').otherwise('{"n": 1, "p": '), "props", F.lit("}"))
    return t.read("events").select("event_id", F.exists(text.json_key_names(body), lambda k: k.rlike(text.CREDENTIAL_NAME)).alias("credential"))


@query("sc24_key_values", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders
""")
def key_values(t):
    key = F.col("o_orderkey")
    line = F.concat(F.lit("order="), key, F.lit(",customer="), "o_custkey", F.when(key % 7 == 0, ",order=1").when(key % 11 == 0, ",loose").otherwise(""))
    return t.read("orders").select("o_orderkey", text.key_values(line)["customer"].alias("customer"))


@query("sc26_image_digest", """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN sha256(CAST(o_custkey AS VARCHAR)) END AS digest FROM orders
""")
def image_digest(t):
    digest = F.sha2(F.col("o_custkey").cast("string"), 256)
    image = F.concat(F.lit("registry/tool"), F.when(F.col("o_orderkey") % 7 == 0, ":1.0").otherwise(F.concat(F.lit("@sha256:"), digest)))
    return t.read("orders").select("o_orderkey", text.pinned_digest(image).alias("digest"))


@query("sc27_version_token", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN '1.' || o_custkey END AS version FROM orders
""")
def version_token(t):
    key = F.col("o_orderkey")
    output = F.when(key % 5 == 0, "no version").otherwise(F.concat(F.lit("Using mytool 1."), "o_custkey", F.when(key % 7 == 0, " with mytool 9.9").otherwise(" (build 7)")))
    return t.read("orders").select("o_orderkey", text.version_token(output, "mytool").alias("version"))


@query("sc29_command_flags", """
SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer, CASE WHEN o_orderkey % 9 <> 0 THEN 'v' || o_custkey END AS k2,
       CASE WHEN o_orderkey % 9 <> 0 THEN 'all-records,ref-overlap' END AS switches,
       CASE WHEN o_orderkey % 9 <> 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN 'odd1,zeta' ELSE '' END END AS unlisted FROM orders
""")
def command_flags(t):
    key = F.col("o_orderkey")
    command = F.concat(F.lit("tool run --all-records --ref-overlap --customer="), "o_custkey", F.lit(" --out x.vcf --k2  v"), "o_custkey", F.when(key % 4 == 0, " --zeta --odd1=a=b").otherwise(""), F.when(key % 9 == 0, " --out y.vcf").otherwise(""))
    allowed = ["all-records", "ref-overlap", "customer", "out", "k2"]
    rows = t.read("orders").select("o_orderkey", text.command_flags(command).alias("flags"), text.unlisted_flags(command, allowed).alias("unlisted"))
    flags = F.col("flags")
    bare = F.array_sort(F.map_keys(F.map_filter(flags, lambda name, value: value.isNull() & name.isin(allowed))))
    return rows.select(
        "o_orderkey", flags["customer"].alias("customer"), flags["k2"].alias("k2"),
        F.array_join(bare, ",").alias("switches"), F.array_join("unlisted", ",").alias("unlisted"),
    )


@query("sc30_cache_identity", """
SELECT o_orderkey, sha256('{"images":"img' || o_orderkey % 3 || '","manifest":"' || o_orderstatus || '","parameters":' || o_custkey || '}') AS "key" FROM orders
""")
def cache_identity(t):
    rows = t.read("orders").select(
        "o_orderkey", F.concat(F.lit("img"), F.col("o_orderkey") % 3).alias("images"), F.col("o_orderstatus").alias("manifest"), F.col("o_custkey").alias("parameters")
    )
    return rows.select("o_orderkey", evidence.canonical_hash("parameters", "manifest", "images").alias("key"))


@query("c16_text_hygiene", f"""
SELECT doc_id, sha256(redacted) AS redacted, {_hits('redacted')} AS hits FROM (
  SELECT doc_id, regexp_replace(text, '{URL_SQL}', '\\1\\2', 'g') AS redacted FROM documents)
""")
def text_hygiene(t):
    clean = acceptance.hygiene(t.read("documents"), "doc_id", "text")
    return clean.select("doc_id", F.sha2("redacted", 256).alias("redacted"), F.array_join("hits", ",").alias("hits"))


@query("c16_residual_paths", r"""
SELECT doc_id, regexp_matches(text, '{pattern}') AS residual FROM documents
""".replace("{pattern}", text.RESIDUAL_PATH))
def residual_paths(t):
    return t.read("documents").select("doc_id", F.col("text").rlike(text.RESIDUAL_PATH).alias("residual"))


view("urlrows", "SELECT page_id, url FROM pages")


@query("p13_page_urls", r"""
SELECT page_id, regexp_matches(url, '^https?://[a-z0-9.-]+(:[0-9]+)?/') AS well_formed, regexp_matches(url, '[?&](sig|signature|token)=') AS signed FROM urlrows
""")
def page_urls(t):
    url = F.col("url")
    return t.read("pages").select("page_id", url.rlike("^https?://[a-z0-9.-]+(:[0-9]+)?/").alias("well_formed"), url.rlike("[?&](sig|signature|token)=").alias("signed"))
