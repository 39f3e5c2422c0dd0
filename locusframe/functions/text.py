"""Text hygiene: redaction, detectors, identifiers and small text grammars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as a regex class body, spelled out because engines disagree on \s.
SPACE = r" \t\n\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = rf"(https?://)(?:[^{SPACE}<>\"'/?#]*@)?([^{SPACE}<>\"'?#]*)[^{SPACE}<>\"']*"

# The detectors. Names are what a report shows; patterns decide.
DETECTORS = {
    "private_path": r"/Users/|/home/|/content/drive/",
    "signed_url": r"(?i)[?&](sig|signature|token|X-Amz-Signature|X-Goog-Signature)=",
    "sequence_bytes": r"(^|[^A-Za-z])[ACGTNacgtn]{80,}([^A-Za-z]|$)",
    "credential_key": r"(?i)\b(access_token|refresh_token|password|secret|authorization|api_key)[\"']?[ \t]*[:=]",
}
# Folders that hold one folder for each person, and a drive's mount point.
PERSONAL_ROOTS = ("/Users", "/home")
MOUNTED_ROOTS = ("/content/drive",)


def path_pattern(personal: tuple[str, ...], mounted: tuple[str, ...]) -> str:
    """Pattern of a path that enters a personal folder, or a mounted root at a name's end."""
    return "|".join([*(rf"{root}/[^/{SPACE}]+" for root in personal), *(rf"{root}(/|\b)" for root in mounted)])


RESIDUAL_PATH = path_pattern(PERSONAL_ROOTS, MOUNTED_ROOTS)
CREDENTIAL_NAME = r"(?i)^(access_token|refresh_token|password|secret|authorization|api_key)$"
IDENTIFIER = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"
SHA256 = r"^[0-9a-f]{64}$"
PINNED_IMAGE = rf"^[^{SPACE}]+@sha256:([0-9a-f]{{64}})$"
NAME_SEGMENT = r"^[A-Za-z_][A-Za-z0-9_]*$"
FLAG = r"^--([A-Za-z][A-Za-z0-9_-]*)(?:=|$)"


def redact_urls(text: Column) -> Column:
    """Drop user-info, query and fragment of each URL inside free text."""
    return F.regexp_replace(text, URL, "$1$2")


def replace_roots(text: Column, roots: dict[str, str]) -> Column:
    """Replace path prefixes by tokens, longest prefix first.

    A prefix counts only as whole path segments. Object keys of JSON text stay as they are.
    """
    for prefix in sorted(roots, key=len, reverse=True):
        whole = rf"(?<![A-Za-z0-9._/-])\Q{prefix}\E(?![A-Za-z0-9._-])"
        value = r"(?![^\"\\]*+\"[ \t\r\n]*:)"
        text = F.regexp_replace(text, whole + value, roots[prefix].replace("\\", "\\\\").replace("$", "\\$"))
    return text


def redact(text: Column, roots: dict[str, str]) -> Column:
    return redact_urls(replace_roots(text, roots))


def hits(text: Column, detectors: dict[str, str] = DETECTORS) -> Column:
    """Names of the detectors that fire on a text, in rule order."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in detectors.items()]))


def json_key_names(text: Column) -> Column:
    """Key names of a JSON document at any depth, with their escapes decoded.

    Every string is taken whole, so nothing inside a value is looked at; a key is a string before a colon.
    """
    strings = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]|\\.)*+"[ \t\r\n]*:?'), F.lit(0))
    quoted = F.transform(F.filter(strings, lambda s: s.endswith(":")), lambda s: F.regexp_replace(s, r"[ \t\r\n]*:$", ""))
    plain = lambda s: F.substring(s, F.lit(2), F.length(s) - 2)
    decoded = lambda s: F.coalesce(F.get_json_object(F.concat(F.lit("["), s, F.lit("]")), "$[0]"), plain(s))
    return F.transform(quoted, lambda s: F.when(s.contains("\\"), decoded(s)).otherwise(plain(s)))


def bounded(value: Column, allowed: str) -> Column:
    """struct<value, length, sha256>: the value if its vocabulary is closed, else only its digest."""
    safe = value.rlike(allowed)
    return F.struct(
        F.when(safe, value).alias("value"),
        F.when(~safe, F.length(value)).alias("length"),
        F.when(~safe, F.sha2(value, 256)).alias("sha256"),
    )


def bounded_number(value: Column, array: bool = False) -> Column:
    """Short non-negative numeric text (at most 8 members when an array), else its digest."""
    member = r"(?=[0-9.]{1,16}(?:,|$))[0-9]+(?:\.[0-9]+)?"
    pattern = rf"^{member}(?:,{member}){{0,7}}$" if array else rf"^{member}$"
    return F.when(value.isNotNull() & (value != "."), bounded(value, pattern))


def process_name(name: Column) -> Column:
    """Last segment of a scoped task name with its display tag removed; null when ambiguous."""
    tag = F.locate(" (", name)
    closed = (tag > 0) & name.endswith(")") & ~name.rlike("[\r\n]")
    scopes = F.split(F.when(closed, F.substring(name, F.lit(1), tag - 1)).otherwise(name), ":")
    return F.when(F.forall(scopes, lambda s: s.rlike(NAME_SEGMENT)), F.element_at(scopes, -1))


def pinned_digest(image: Column) -> Column:
    digest = F.regexp_extract(image, PINNED_IMAGE, 1)
    return F.when(digest != "", digest)


def version_token(output: Column, tool: str) -> Column:
    """The single version a tool reports; null when absent or ambiguous."""
    found = F.array_distinct(
        F.regexp_extract_all(output, F.lit(rf"\b{tool}[ -]v?([0-9]+(?:\.[0-9]+)+)"), F.lit(1))
    )
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def key_values(text: Column, separator: str = ",") -> Column:
    """``a=1,b=2`` to a map; null when a pair lacks its name or a name repeats."""
    pairs = F.split(text, separator)
    names = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
    values = F.transform(pairs, lambda p: F.regexp_replace(p, "^[^=]*=", ""))
    valid = F.forall(pairs, lambda p: p.rlike("^[^=]+=")) & (F.size(F.array_distinct(names)) == F.size(names))
    return F.when(valid, F.map_from_arrays(names, values))


def command_flags(command: Column) -> Column:
    """``--name value``, ``--name=value`` and bare ``--name`` switches as a map; null when a flag repeats.

    A switch has a null value: a token that opens another flag is never a value.
    """
    words = F.filter(F.split(command, rf"[{SPACE}]+"), lambda w: w != "")
    opens = lambda w: w.rlike(FLAG)

    def read(word: Column, after: Column) -> Column:
        value = F.when(word.contains("="), F.regexp_replace(word, "^[^=]*=", "")).when(~opens(after), after)
        return F.when(opens(word), F.struct(F.regexp_extract(word, FLAG, 1).alias("name"), value.alias("value")))

    def mapped(found: Column) -> Column:
        names = F.transform(found, lambda f: f["name"])
        return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_entries(found))

    found = _once(words, lambda w: F.array_compact(F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), read)))
    return _once(found, mapped)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unlisted_flags(command: Column, allowed: list[str]) -> Column:
    """Flags of a command that its allow-list does not name, sorted; null when a flag repeats."""
    return F.array_sort(F.array_except(F.map_keys(command_flags(command)), F.array(*[F.lit(a) for a in allowed])))


def safe_relative_path(path: Column) -> Column:
    """Plain relative path: closed alphabet, not absolute, no parent segment."""
    return path.rlike(r"^[A-Za-z0-9_./-]+$") & ~path.rlike(r"^/") & ~path.rlike(r"(^|/)\.\.(/|$)")


def safe_object_uri(uri: Column) -> Column:
    """Object URI with a bucket, an unsigned clean key and no dot segments."""
    return uri.rlike(r"^s3://[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]/[A-Za-z0-9_./-]+$") & ~uri.rlike(
        r"^s3://[^/]+/(.*/)?(\.{0,2})(/|$)"
    )


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
