"""Expressions over VARIANT records whose fields have mixed types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep import constants as C


def once(df: DataFrame, value: Column, into: str) -> DataFrame:
    """Add a costly column that is computed once per row.

    The optimizer copies the expression of a plain column into later filters and
    conditions; it does not do so across a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(into))


def _get(value: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(value, path, kind)


def is_object(value: Column) -> Column:
    """True for JSON objects."""
    # Reading one absent field tells objects apart without walking through them.
    return _get(value, "$", "struct<__none:string>").isNotNull()


def objects_in(body: Column) -> Column:
    """Object items of a response body: a list, or an object with a ``results`` list."""
    items = F.coalesce(_get(body, "$", "array<variant>"), _get(body, "$.results", "array<variant>"))
    return F.filter(F.coalesce(items, F.array().cast("array<variant>")), is_object)


def ref_id(ref: Column) -> Column:
    """Id of one reference: an integer, or the ``id`` of an object as integer, else null."""
    # Text ids are trimmed by the cast; fractional ids lose the fraction.
    return F.coalesce(
        _get(ref, "$.id", "bigint"),
        F.when(F.schema_of_variant(ref) == "BIGINT", _get(ref, "$", "bigint")),
    )


def ref_ids(refs: Column | str) -> Column:
    """Ids of an array of references, in order; references without an id are dropped."""
    refs = F.col(refs) if isinstance(refs, str) else refs
    return F.array_compact(F.transform(_array(refs), ref_id))


def embedded_url(ref: Column) -> Column:
    """Address held by one media reference; empty when it holds none."""
    found = [
        F.when(truthy(_get(ref, f"$.{key}", "variant")), _get(ref, f"$.{key}", "string"))
        for key in C.MEDIA_URL_KEYS
    ]
    return F.coalesce(*found, F.lit(""))


def embedded_urls(refs: Column | str) -> Column:
    """Embedded addresses of an array of media references; references without one are dropped."""
    refs = F.col(refs) if isinstance(refs, str) else refs
    return F.filter(F.transform(_array(refs), embedded_url), lambda u: u != "")


def media_refs(refs: Column | str) -> Column:
    """References as ``struct<id, url>``: the embedded address, or an id to look up."""
    refs = F.col(refs) if isinstance(refs, str) else refs
    pairs = F.transform(
        _array(refs),
        lambda r: F.struct(
            F.nullif(ref_id(r), F.lit(0).cast("bigint")).alias("id"),
            F.nullif(embedded_url(r), F.lit("")).alias("url"),
        ),
    )
    return F.filter(pairs, lambda p: p["id"].isNotNull() | p["url"].isNotNull())


def truthy(value: Column) -> Column:
    """False for missing values, null, empty text, zero, false and empty containers."""
    return F.coalesce(
        ~F.to_json(value).isin("null", '""', "0", "-0", "0.0", "-0.0", "false", "[]", "{}"),
        F.lit(False),
    )


def canonical_json(record: Column | str) -> Column:
    """JSON text with sorted keys and non-ASCII characters kept; compact separators."""
    return F.to_json(F.col(record) if isinstance(record, str) else record)


def prompt(record: Column | str, keys: Iterable[str] = C.PROMPT_KEYS) -> Column:
    """Prompt of a VARIANT record: first truthy field of ``keys``, else the whole record."""
    record = F.col(record) if isinstance(record, str) else record
    found = [
        F.when(truthy(_get(record, f"$.{key}", "variant")), _get(record, f"$.{key}", "string"))
        for key in keys
    ]
    return F.coalesce(*found, F.to_json(record))


def dedup_key(record: Column | str) -> Column:
    """Key of a post: its ``id``, else its ``url``, else its canonical JSON.

    The JSON type is part of the key, so the number 1 and the text "1" differ.
    """
    record = F.col(record) if isinstance(record, str) else record

    def typed(value: Column) -> Column:
        return F.when(truthy(value), F.concat_ws(":", F.schema_of_variant(value), F.to_json(value)))

    return F.coalesce(
        typed(_get(record, "$.id", "variant")),
        typed(_get(record, "$.url", "variant")),
        F.concat_ws(":", F.lit("RECORD"), F.to_json(record)),
    )


def _array(refs: Column) -> Column:
    """A missing or null array reads as empty."""
    return F.coalesce(refs, F.array().cast("array<variant>"))
