"""Lookups of nested references in dictionaries, and the choice between sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import nested
from sitrep.operators import scale

# Up to this many entries per deployment a dictionary travels as one map per deployment.
MAP_ENTRIES = 1000


def select_posts(
    posts: DataFrame, status: str = C.POST_STATUS, tags: Sequence[str] = C.POST_TAGS
) -> DataFrame:
    """Posts with the given status and at least one of the tags."""
    wanted = F.array(*[F.lit(t) for t in tags])
    return posts.where((F.col("status") == status) & F.arrays_overlap("tags", wanted))


def with_category_names(
    posts: DataFrame,
    dictionary: DataFrame,
    refs: str = "categories",
    into: str = "category_names",
    by: Sequence[str] = ("deployment",),
) -> DataFrame:
    """Add the names of a post's categories, in order; unknown ids become ``Unknown(<id>)``.

    ``dictionary`` has the columns ``by``, ``category_id`` and ``name``, and may have
    ``entry_order``: of entries that repeat an id the last one counts, without it the
    greatest name. Entries without an id name nothing.
    """
    refs_as_structs = F.transform(
        nested.ref_ids(refs),
        lambda i: F.struct(
            i.alias("id"),
            F.lit(None).cast("string").alias("fixed"),
            F.concat(F.lit("Unknown("), i.cast("string"), F.lit(")")).alias("otherwise"),
        ),
    )
    table = dictionary.select(*by, F.col("category_id").cast("bigint").alias("id"), F.col("name").alias("value"), *_order(dictionary))
    return _resolve(posts, refs_as_structs, table, into, by)


def with_media_urls(
    posts: DataFrame,
    dictionary: DataFrame | None = None,
    refs: str = "media",
    into: str = "media_urls",
    by: Sequence[str] = ("deployment",),
) -> DataFrame:
    """Add the addresses of a post's media, in order.

    The address inside a reference wins; otherwise the id is looked up in
    ``dictionary`` (``by``, ``media_id``, ``url``). References with neither are
    dropped. Without a dictionary only the embedded addresses count, as for
    archived posts.
    """
    if dictionary is None:
        return posts.withColumn(into, nested.embedded_urls(refs))
    refs_as_structs = F.transform(
        nested.media_refs(refs),
        lambda r: F.struct(
            r["id"].alias("id"), r["url"].alias("fixed"), F.lit(None).cast("string").alias("otherwise")
        ),
    )
    table = dictionary.where("url <> ''").select(
        *by, F.col("media_id").cast("bigint").alias("id"), F.col("url").alias("value"), *_order(dictionary)
    )
    return _resolve(posts, refs_as_structs, table, into, by)


def _order(dictionary: DataFrame) -> list[str]:
    return ["entry_order"] if "entry_order" in dictionary.columns else []


def _value(ref: Column, found: Column) -> Column:
    return F.coalesce(ref["fixed"], found, ref["otherwise"])


def _resolve(
    posts: DataFrame, refs: Column, table: DataFrame, into: str, by: Sequence[str]
) -> DataFrame:
    """Turn ``array<struct<id, fixed, otherwise>>`` into an array of looked-up values.

    Every post gets a map from id to value, in one of two ways with the same result:

    * Short dictionaries are broadcast as one map per deployment; posts stay where
      they are.
    * From long ones a map is made once per distinct ``(deployment, ids)``, so copies
      of a post and popular lists of ids collapse before the shuffle, and both joins
      survive hot keys.
    """
    by = list(by)
    # One value per id, whatever the dictionary repeats.
    value = F.max_by("value", "entry_order") if "entry_order" in table.columns else F.max("value")
    table = table.where("id IS NOT NULL").groupBy(*by, "id").agg(value.alias("value"))
    table, rows, size = scale.measured(table, "dictionary")
    short = scale.is_small(rows, size)
    if short:
        short = (table.groupBy(*by).count().agg(F.max("count")).first()[0] or 0) <= MAP_ENTRIES
    as_map = F.map_from_entries(F.collect_list(F.struct("id", "value"))).alias("__map")
    if short:
        mapped = posts.join(F.broadcast(table.groupBy(*by).agg(as_map)), by, "left")
    else:
        marked = nested.once(posts, refs, "__refs")
        refs = F.col("__refs")
        open_refs = F.filter("__refs", lambda r: r["fixed"].isNull() & r["id"].isNotNull())
        ids = F.array_sort(F.array_distinct(F.transform(open_refs, lambda r: r["id"])))
        # As one struct the key also compares when the deployment is null.
        keyed = marked.withColumn("__key", F.struct(*by, ids.alias("__ids")))
        distinct = keyed.select("__key").where(F.size("__key.__ids") > 0).distinct()
        entries = distinct.select("__key", *[f"__key.{c}" for c in by], F.explode("__key.__ids").alias("id"))
        found = scale.lookup_join(entries, table, [*by, "id"], "inner")
        # A group is the id list of one post.
        mapped = scale.lookup_join(keyed, found.groupBy("__key").agg(as_map), ["__key"], "left").drop("__key")
    values = F.transform(refs, lambda r: _value(r, F.try_element_at(F.col("__map"), r["id"])))
    return mapped.withColumn(into, F.array_compact(values)).drop("__map", "__refs")


def source_fallback(
    live: DataFrame,
    archive: DataFrame,
    by: Sequence[str] = ("deployment",),
    also: DataFrame | None = None,
    dedup: Sequence[str] | None = None,
) -> DataFrame:
    """Live rows, plus the archive rows of deployments without usable live rows.

    ``also`` names deployments whose live feed broke off after its first page: their
    archive rows come on top of the live ones. ``dedup`` names key columns; archive
    rows whose key is among the live rows are then left out.
    """
    by = list(by)
    live_keys = live.select(*by).distinct()
    if also is not None:
        live_keys = live_keys.join(also.select(*by).distinct(), by, "left_anti")
    extra = scale.lookup_join(archive, live_keys, by, "left_anti")
    if dedup:
        keys = [*by, *dedup]
        extra = scale.lookup_join(extra, live.select(*keys).distinct(), keys, "left_anti")
    return live.unionByName(extra, allowMissingColumns=True)


def first_non_empty_snapshot(
    categories: DataFrame, by: Sequence[str] = ("deployment",), ts: str = "ts"
) -> DataFrame:
    """Dictionary rows of the newest archived snapshot that has any, per deployment.

    Spark drops the rows of older snapshots inside each task, before the shuffle.
    """
    w = Window.partitionBy(*by).orderBy(F.desc(ts))
    return categories.withColumn("__rank", F.rank().over(w)).where("__rank = 1").drop("__rank")
