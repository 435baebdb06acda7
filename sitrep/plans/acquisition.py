"""Phase 1: keyword dictionary, crowd reports and news pages from landed data."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import html, nested, text
from sitrep.operators import dedup, keywords, lookups, pages, scale
from sitrep.sources import payloads
from sitrep.sources import warc


def keyword_dictionary(
    ludp: DataFrame,
    glossary: DataFrame,
    key: Sequence[str] = ("category",),
    targets: Sequence[str] = C.TARGET_LANGS,
) -> DataFrame:
    """Terms of both sources with the fallback terms: ``lang, term, ord``.

    ``ludp`` has ``language_code, term, language_name_local, ord``; ``glossary`` has
    ``key``, ``ord`` and ``html``. Language-use terms come before glossary terms.
    """

    def place(source: int, a: str, b: Column) -> Column:
        parts = F.lit(source).alias("source"), F.col(a).cast("bigint").alias("a"), b.cast("bigint").alias("b")
        return F.struct(*parts).alias("ord")

    first = keywords.ludp_terms(ludp, targets).select("lang", "term", place(0, "ord", F.lit(0)))
    rows = keywords.glossary_rows(glossary, [*key, "ord"])
    second = keywords.glossary_terms(rows, targets).select("lang", "term", place(1, "ord", F.col("row_no")))
    seen = keywords.terms_by_lang(first, second)
    # One sortable number per place: source, then any 64-bit place of the page, then its row.
    numbered = seen.withColumn(
        "ord",
        F.expr("CAST(concat(ord.source + 1, lpad(CAST(ord.a AS DECIMAL(20)) + 9223372036854775808, 20, '0'), lpad(ord.b, 10, '0')) AS DECIMAL(38))"),
    )
    return keywords.with_fallback(numbered)


def posts_of(responses: DataFrame) -> DataFrame:
    """Posts inside usable API responses, with the fields the later steps need."""
    return _posts(payloads.triage_responses(responses)[0])


def _posts(valid: DataFrame) -> DataFrame:
    items = payloads.explode_items(valid)

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get("item", f"$.{name}", kind).alias(name)

    return items.select(
        "deployment",
        F.col("fetched_ts"),
        "item_pos",
        field("id", "variant"),
        *[field(c, "string") for c in ("url", "title", "content", "status")],
        field("tags", "array<string>"),
        *[field(c, "array<variant>") for c in ("categories", "media")],
        F.col("item").alias("record"),
    )


def category_dictionary(responses: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``deployment, category_id, name, entry_order`` of landed category responses.

    Deployments that were blocked or answered with no JSON get the entries of their newest
    archived response that has any; one whose request failed has none. ``snapshots`` have a
    column ``ts``. ``entry_order`` grows with the place of an entry in its response.
    """

    def entries(usable: DataFrame, *extra: str) -> DataFrame:
        return payloads.explode_items(usable).select(
            "deployment",
            *extra,
            F.try_variant_get("item", "$.id", "int").alias("category_id"),
            F.try_variant_get("item", "$.name", "string").alias("name"),
            F.col("item_pos").alias("entry_order"),
        )

    # Bodies are parsed once; both what they hold and how each went is asked of them.
    marked = scale.materialize(payloads.classify_responses(responses).drop("body"), "responses")
    live = marked.where(F.col("reason").isNull()).drop("reason")
    done = live.select("deployment").unionAll(payloads.without_archive(marked)).distinct()
    needed = scale.lookup_join(snapshots, done, ["deployment"], "left_anti")
    archived, _ = payloads.triage_responses(needed)
    newest = lookups.first_non_empty_snapshot(entries(archived, "ts"))
    return entries(live).unionByName(newest.drop("ts"))


def archived_posts(snapshots: DataFrame, categories: DataFrame) -> DataFrame:
    """Posts of archived responses: newest copy of each, with provenance columns.

    ``snapshots`` are responses with the columns ``ts`` and ``original`` of their
    index row on top.
    """
    return lookups.with_category_names(_archived(snapshots), categories)


def _archived(snapshots: DataFrame) -> DataFrame:
    valid, _ = payloads.triage_responses(snapshots)
    items = payloads.explode_items(valid).withColumn("__key", nested.dedup_key("item"))
    newest = dedup.latest_per_key(
        items, ["deployment", "__key"], [F.desc("ts"), F.asc("item_pos")]
    )
    posts = newest.select(
        "deployment",
        F.try_variant_get("item", "$.url", "string").alias("url"),
        F.try_variant_get("item", "$.categories", "array<variant>").alias("categories"),
        F.try_variant_get("item", "$.media", "array<variant>").alias("media"),
        F.col("item").alias("record"),
        F.lit(C.ARCHIVE_SOURCE).alias("_acquisition_source"),
        F.col("ts").alias("_archive_timestamp"),
        F.col("original").alias("_archive_original_url"),
    )
    return lookups.with_media_urls(posts)


def crowd_reports(
    responses: DataFrame, snapshots: DataFrame, categories: DataFrame, media: DataFrame
) -> DataFrame:
    """Live posts, and archived ones of deployments whose live feed was blocked or gave no JSON.

    If such a feed had usable pages before, the archived posts come on top of the live
    ones. A feed that failed otherwise ends there: its archive is not asked. Categories are
    named after the union, so their dictionary is prepared once.
    """
    # Bodies are parsed once; both what they hold and how each went is asked of them.
    marked = scale.materialize(payloads.classify_responses(responses).drop("body"), "responses")
    usable = marked.where(F.col("reason").isNull()).drop("reason")
    live = lookups.with_media_urls(lookups.select_posts(_posts(usable)), media)
    live = live.select("deployment", "url", "categories", "record", "media_urls")
    complete = payloads.without_archive(marked)
    # Only the snapshots that are needed get parsed.
    needed = scale.lookup_join(snapshots, complete, ["deployment"], "left_anti")
    both = live.unionByName(_archived(needed).drop("media"), allowMissingColumns=True)
    return lookups.with_category_names(both, categories).drop("categories")


def news_rows(records: DataFrame, keyword_table: DataFrame, now: Column | None = None) -> DataFrame:
    """News rows of the archived pages that mention a keyword.

    The cheap tests come first; only relevant pages reach the HTML parser. No shuffle.
    """
    responses = warc.html_responses(records)
    lowered = responses.withColumn("__page_text", F.lower(valid_text("payload")))
    relevant = keywords.keyword_filter(lowered, "__page_text", keyword_table, lower=False)
    return pages.og_extract(relevant, "target_uri", "payload", now)


def valid_text(col: str) -> Column:
    """Bytes as UTF-8 text without the invalid sequences."""

    @F.arrow_udf("string")
    def decode(values: pa.Array) -> pa.Array:
        return pa.array((v.as_py().decode("utf-8", errors="ignore") if v.is_valid else None for v in values), pa.string())

    # Valid bytes, the usual case, are read as they are.
    return F.when(F.is_valid_utf8(F.col(col).cast("string")), F.col(col).cast("string")).otherwise(
        decode(F.when(~F.is_valid_utf8(F.col(col).cast("string")), F.col(col)))
    )
