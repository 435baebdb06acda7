"""Landed HTTP payloads: which are JSON, and the records inside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrep.functions import nested

# Text lines end where any of these stand.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def classify_responses(df: DataFrame) -> DataFrame:
    """Add ``payload`` (VARIANT) and ``reason``, null for usable rows.

    Reasons: ``blocked`` for status 403, ``failed`` for any other of 400 and above,
    ``not_json`` when neither the content type nor the first character says JSON,
    ``invalid_json`` when it does not parse. All but ``failed`` lead to the archive.
    """
    looks_like_json = F.coalesce(
        F.lower("content_type").contains("json"), F.lit(False)
    ) | F.coalesce(F.col("body").rlike(r"(?U)^[\s\x1c-\x1f]*[\[{]"), F.lit(False))
    usable = looks_like_json & ~F.coalesce(F.col("status") >= 400, F.lit(False))
    parsed = nested.once(df, F.when(usable, F.try_parse_json("body")), "payload")
    reason = (
        F.when(F.col("status") == 403, "blocked")
        .when(F.col("status") >= 400, "failed")
        .when(~looks_like_json, "not_json")
        .when(F.col("payload").isNull(), "invalid_json")
    )
    return parsed.withColumn("reason", reason)


def triage_responses(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)`` of the landed responses."""
    marked = classify_responses(df)
    valid = marked.where(F.col("reason").isNull()).drop("reason")
    return valid, marked.where(F.col("reason").isNotNull()).drop("payload")


def without_archive(marked: DataFrame) -> DataFrame:
    """Deployments whose archive is not asked, from classified responses: ``deployment``.

    All their responses are usable, or one failed: a failure ends a deployment, while a
    block or an answer that is no JSON turns to the archive.
    """
    usable, failed = F.col("reason").isNull(), F.coalesce(F.col("reason") == "failed", F.lit(False))
    state = marked.groupBy("deployment").agg((F.bool_and(usable) | F.bool_or(failed)).alias("done"))
    return state.where("done").select("deployment")


def explode_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per object item of each payload, as VARIANT ``item`` with its position."""
    rest = [c for c in df.columns if c != payload]
    return df.select(*rest, F.posexplode(nested.objects_in(F.col(payload))).alias("item_pos", "item"))


def ludp_records(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Language-use records: ``results`` if the key is there, else ``data``, else none."""
    body = F.col(payload)
    results = F.try_variant_get(body, "$.results", "variant")
    chosen = F.coalesce(results, F.try_variant_get(body, "$.data", "variant"))
    rest = [c for c in df.columns if c != payload]
    return df.select(
        *rest,
        F.posexplode(F.try_variant_get(chosen, "$", "array<variant>")).alias("item_pos", "item"),
    ).select(
        *rest,
        "item_pos",
        *[
            F.try_variant_get("item", f"$.{c}", "string").alias(c)
            for c in ("language_code", "term", "language_name_local")
        ],
    )


def parse_jsonl_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One VARIANT ``record`` per non-blank line of a text payload; malformed lines fail."""
    rest = [c for c in df.columns if c != payload]
    lines = df.select(*rest, F.posexplode(F.split(payload, LINE_END)).alias("line_no", "line"))
    return lines.where(F.col("line").rlike(r"(?U)[^\s\x1c-\x1f]")).select(
        *rest, "line_no", F.parse_json("line").alias("record")
    )
