"""Archive indexes and path listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import nested


def cdx_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows ``(timestamp, original)`` of index payloads, in order, without the header.

    Rows are lists with at least two elements or objects with both fields; others
    are skipped.
    """
    rest = [c for c in df.columns if c != payload]
    rows = df.select(
        *rest,
        F.posexplode(F.try_variant_get(payload, "$", "array<variant>")).alias("ord", "row"),
    ).where("ord > 0")

    def field(index: int, key: str):
        by_key = F.try_variant_get("row", f"$.{key}", "variant")
        return F.coalesce(
            F.try_variant_get("row", f"$[{index}]", "string"),
            F.when(nested.truthy(by_key), F.try_variant_get("row", f"$.{key}", "string")),
        )

    pair = F.struct(field(0, "timestamp").alias("timestamp"), field(1, "original").alias("original"))
    return (
        nested.once(rows, pair, "pair")
        .where("pair.timestamp IS NOT NULL AND pair.original IS NOT NULL")
        .select(*rest, "ord", "pair.*")
    )


def warc_paths(
    spark: SparkSession, listing: str | Sequence[str], n: int | None = None
) -> DataFrame:
    """Segment addresses of a (gzip) text listing; with ``n`` only the first ones of the listing.

    Several listings count in the order of their paths.
    """
    line = F.regexp_replace("value", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    paths = (
        spark.read.text(listing)
        .select(line.alias("path"), "_metadata.file_path", "_metadata.file_block_start")
        .where("path <> ''")
        # Inside a block of a file the id grows with the line.
        .withColumn("line", F.monotonically_increasing_id())
        .withColumn("path", F.concat(F.lit(C.LISTING_URL_PREFIX), "path"))
    )
    if n is not None:
        paths = paths.orderBy("file_path", "file_block_start", "line").limit(n)
    return paths.select("path")
