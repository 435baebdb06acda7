"""Newest, first and distinct rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.operators import scale


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group in the given order.

    Spark keeps at most ``k`` rows of a group per task before the shuffle, so a group
    of any size reaches its final task as a few rows.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_k(df, keys, order, 1)


def dedup_exact(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """One row per distinct text, the one with the smallest id; rows without a text are kept.

    Texts are compared by SHA-256 digest, in one pass over ``df``. Copies collapse
    inside each task before the shuffle, so a large group of copies reaches its
    final task as one row per task. Rows without a text are groups of their own.
    """
    digest = F.coalesce(F.unhex(F.sha2(F.col(col), 256)), F.concat(F.lit("#"), F.col(id_col)).cast("binary"))
    return latest_per_key(df.withColumn("__digest", digest), ["__digest"], [F.asc(id_col)]).drop("__digest")


def cdx_collapse(
    df: DataFrame,
    by: Sequence[str] = ("url",),
    order: Sequence[str] = ("ts", "ord"),
    value: str = "digest",
    cuts: int | None = None,
) -> DataFrame:
    """Drop rows whose value equals that of the row before, per group and in order.

    The first row of a group is always kept. Rows are dealt out in ranges of group and
    order together, so a group of any size is spread over as many tasks as it needs. The
    last row of each range, one row a range, is what the first row of the next is compared
    with. ``order`` must name the rows of a group uniquely; nulls come first.
    """
    by, order = list(by), list(order)
    keys = [*by, *order]
    ranged = scale.in_ranges(df, keys, cuts)
    here = F.struct(*by, F.col(value).alias("__value"))
    last = ranged.groupBy("__range").agg(F.max_by(here, F.struct(*keys)).alias("__last"))
    carried = last.select("__range", F.lag("__last").over(Window.orderBy("__range")).alias("__carried"))
    inside = Window.partitionBy("__range").orderBy(*keys)
    marked = ranged.withColumn("__before", F.lag(here).over(inside)).join(F.broadcast(carried), "__range")
    before = F.coalesce("__before", "__carried")
    return marked.where(before.isNull() | ~here.eqNullSafe(before)).select(*df.columns)


def cdx_select(
    df: DataFrame, prefix: str | None = None, k: int | None = None, collapse: bool = True
) -> DataFrame:
    """JSON snapshots: status 200, ``application/json``, url prefix; with ``k`` the newest per url."""
    rows = df.where("status = 200 and mime = 'application/json'")
    if prefix is not None:
        rows = rows.where(F.col("url").startswith(prefix))
    if collapse:
        rows = cdx_collapse(rows)
    return rows if k is None else top_k(rows, ["url"], [F.desc("ts"), F.desc("ord")], k)


def page_of(df: DataFrame, order: Sequence[str], size: int = C.PAGE_SIZE, into: str = "page_offset") -> DataFrame:
    """Add the offset of the page each row is on when the rows are paged in this order."""
    numbered = scale.global_row_number(df, order, "__n")
    return numbered.withColumn(into, F.floor((F.col("__n") - 1) / size) * size).drop("__n")


def page_slice(df: DataFrame, order: Sequence[str], offset: int, limit: int = C.PAGE_SIZE) -> DataFrame:
    """One page of the ordered rows. For deep pages of large tables use :func:`page_after`."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_after(df: DataFrame, order: Sequence[str], after: Sequence | None, limit: int = C.PAGE_SIZE) -> DataFrame:
    """The page that follows the row with the values ``after`` in ``order``; the first one for None.

    The key goes into the filter, so a deep page costs no more than the first. ``order``
    must name the rows uniquely and have no nulls.
    """
    if after is not None:
        key, last = F.struct(*order), F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after)])
        df = df.where(key > last)
    return df.orderBy(*order).limit(limit)
