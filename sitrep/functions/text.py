"""String expressions. All of them stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitrep import constants as C

# Whitespace and word characters as Unicode defines them for text matching here:
# the separators U+001C..U+001F count as whitespace, combining marks are not
# word characters. Java's own classes differ on both.
SPACE = r"\s\x1c-\x1f"
_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"

# What a match starts with. Testing it first passes over letters quickly.
_STARTS = {"PHONE": r"(?=[+(\d])", "IP_ADDRESS": r"(?=\d)", "CREDIT_CARD": r"(?=\d)"}

# Same matches as the EMAIL pattern in linear time: a match can only start where
# a run of local-part characters starts, or right after the previous match.
_EMAIL_LINEAR = (
    r"(?:\G|(?<![a-zA-Z0-9_.+-]))[a-zA-Z0-9_.+-]++@[a-zA-Z0-9-]++\.[a-zA-Z0-9.-]+"
)


def java_pattern(kind: str) -> str:
    """Java form of one redaction pattern, with Unicode digits, spaces and boundaries."""
    if kind == "EMAIL":
        return _EMAIL_LINEAR
    pattern = C.PII_PATTERNS[kind]
    return "(?U)" + _STARTS[kind] + pattern.replace(r"\s", SPACE).replace(r"\b", _BOUNDARY)


def redact(col: Column | str, kinds: Iterable[str] | None = None, strict: bool = False) -> Column:
    """Replace personal data by ``[REDACTED_<kind>]``; null and empty stay as they are.

    The kinds run one after the other, each on the previous result. In the default
    order phone numbers run before addresses and cards, so long card numbers come
    out as a phone number plus leftover digits; ``strict`` runs cards and addresses
    before phones.
    """
    col = F.col(col) if isinstance(col, str) else col
    wanted = set(C.PII_PATTERNS if kinds is None else kinds)
    unknown = wanted - set(C.PII_PATTERNS)
    if unknown:
        raise ValueError(f"unknown kinds: {sorted(unknown)}")
    order = ("EMAIL", "CREDIT_CARD", "IP_ADDRESS", "PHONE") if strict else tuple(C.PII_PATTERNS)

    # The guards look at the input text only, so each row pays for the patterns it
    # can match and nothing is evaluated twice. Placeholders hold no digits.
    out = col
    if "EMAIL" in wanted:
        out = F.when(col.contains("@"), _replace(col, "EMAIL")).otherwise(col)
    numeric = [k for k in order if k in wanted and k != "EMAIL"]
    if numeric:
        replaced = out
        for kind in numeric:
            replaced = _replace(replaced, kind)
        out = F.when(col.rlike(r"\p{Nd}"), replaced).otherwise(out)
    return out


def _replace(col: Column, kind: str) -> Column:
    return F.regexp_replace(col, F.lit(java_pattern(kind)), F.lit(f"[REDACTED_{kind}]"))


def normalize_lang(col: Column | str, aliases: Mapping[str, str] | None = None) -> Column:
    """Primary language of a label: default ``unknown``, lower case, part before ``-``, aliases."""
    col = F.col(col) if isinstance(col, str) else col
    aliases = C.LANGUAGE_ALIASES if aliases is None else aliases
    prefix = F.substring_index(F.lower(F.coalesce(col, F.lit("unknown"))), "-", 1)
    if not aliases:
        return prefix
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(table, prefix), prefix)


def first_long_word(col: Column | str, min_length: int = 4) -> Column:
    """First whitespace-separated word of at least ``min_length`` characters, lower-cased."""
    col = F.col(col) if isinstance(col, str) else col
    word = rf"(?U)(?<![^{SPACE}])[^{SPACE}]{{{min_length},}}"
    return F.nullif(F.regexp_extract(F.lower(col), word, 0), F.lit(""))


def iso_timestamp(col: Column | str) -> Column:
    """ISO-8601 UTC text with seconds; the session time zone must be UTC."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def first_non_empty(*cols: Column | str) -> Column:
    """First column that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def url_quote(col: Column | str) -> Column:
    """Percent-encode, keeping ``: / ? & = %`` and the unreserved characters."""
    out = F.url_encode(col)
    # url_encode writes form encoding; put back what it encodes too much or too little.
    for encoded, plain in (
        ("+", "%20"), ("%3A", ":"), ("%2F", "/"), ("%3F", "?"), ("%26", "&"),
        ("%3D", "="), ("%25", "%"), ("%7E", "~"), ("*", "%2A"),
    ):
        out = F.replace(out, F.lit(encoded), F.lit(plain))
    return out


def archive_url(ts: Column | str, original: Column | str) -> Column:
    """Address of the unmodified archived copy of ``original`` at ``ts``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.lit(C.ARCHIVE_URL_PREFIX), ts, F.lit("id_/"), url_quote(original))
