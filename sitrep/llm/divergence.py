"""How the sources of a language differ in their words: exact shares, chi-squared distances.

Terms travel as 64-bit digests. The smallest and the largest string under a digest tell
whether terms share it; the terms of such digests are counted again under their strings.
Strings are joined back only to rows of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitrep.llm.common import _hashes, slices, small_batches, stored, text_bytes, words_and_rows
from sitrep.operators import scale

# Letters; every byte of a non-ASCII character counts.
IN_LETTER = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
# Text that reaches a worker, and is cut into words, at a time.
SLICE_BYTES = 4 << 20
# Bytes of terms that are hashed at a time.
HASH_BYTES = 1 << 18
# Cells of a block of terms times sources.
BLOCK_CELLS = 1 << 22
SHARE = 1_000_000_000
# Counts above this overflow 64 bits when multiplied by SHARE.
_LARGE = 9_000_000_000


def _digests(distinct: pa.Array, bits: int) -> np.ndarray:
    data, bounds = text_bytes(distinct)
    found, at = np.empty(len(distinct), np.uint64), 0
    while at < len(distinct):
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + HASH_BYTES, "right")) - 1)
        some = bounds[at : stop + 1] - bounds[at]
        found[at:stop] = _hashes(data[bounds[at] : bounds[stop]].tobytes(), some[:-1], some[1:])
        at = stop
    return (found >> np.uint64(64 - bits)).view(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch.column(2), SLICE_BYTES):
            yield batch.slice(low, high - low)
            # A worker lives on between its tasks; what it has freed goes back.
            pa.default_memory_pool().release_unused()


def counted(docs: DataFrame, bits: int, strings: bool) -> DataFrame:
    """``lid, gid, digest[, term], n, d``: occurrences and documents of every term, by slice of text.

    ``docs`` has ``lid, gid, text``. Equal terms are counted together before they leave a task.
    """
    schema = f"lid long, gid long, digest long,{' term string,' if strings else ''} n long, d long"
    names = [c.split()[0] for c in schema.split(", ")] if not strings else ["lid", "gid", "digest", "term", "n", "d"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            words, rows = words_and_rows(part.column(2), IN_LETTER)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            ids, distinct = coded.indices.to_numpy(), coded.dictionary
            digest = _digests(distinct, bits)
            lids, gids = part.column(0).to_numpy(), part.column(1).to_numpy()
            groups, first, group = np.unique(gids, return_index=True, return_inverse=True)
            # Once per document and term, then once per group and term.
            pairs, times = np.unique(rows * len(distinct) + ids, return_counts=True)
            row, term = np.divmod(pairs, len(distinct))
            cells, cell = np.unique(group[row] * len(distinct) + term, return_inverse=True)
            at, term = np.divmod(cells, len(distinct))
            n = np.bincount(cell, times).astype(np.int64)
            columns = [pa.array(lids[first][at]), pa.array(groups[at]), pa.array(digest[term])]
            if strings:
                columns.append(distinct.take(pa.array(term)).cast(pa.large_string()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(np.bincount(cell))], names)

    return docs.select("lid", "gid", "text").mapInArrow(run, schema)


def dictionary(docs: DataFrame, bits: int) -> DataFrame:
    """``digest, lo, hi``: the smallest and the largest term under every digest, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            distinct = words_and_rows(part.column(2), IN_LETTER)[0].unique()
            if len(distinct):
                digest = pa.array(_digests(distinct, bits))
                yield pa.RecordBatch.from_arrays([digest, distinct.cast(pa.large_string()).cast(pa.string())], ["digest", "term"])

    terms = docs.select("lid", "gid", "text").mapInArrow(run, "digest long, term string")
    with small_batches(docs.sparkSession, SLICE_BYTES):
        return stored(terms.groupBy("digest").agg(F.min("term").alias("lo"), F.max("term").alias("hi")), "dictionary")


def kept_terms(docs: DataFrame, known: DataFrame, bits: int, min_docs: int) -> DataFrame:
    """``lid, digest, term, c, cells``: terms in ``min_docs`` documents of a language.

    ``c`` counts the language, ``cells`` its groups with the term. ``term`` is null but for
    terms that share a digest.
    """
    cells = counted(docs, bits, False).groupBy("lid", "gid", "digest").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    keys = ["lid", "digest"]
    clash = known.where("lo <> hi").select("digest")
    if not clash.isEmpty():
        exact = counted(docs, bits, True).join(clash, "digest", "left_semi")
        exact = exact.groupBy("lid", "gid", "digest", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
        cells = cells.join(clash, "digest", "left_anti").unionByName(exact, allowMissingColumns=True)
        keys.append("term")
    grouped = cells.groupBy(*keys).agg(
        F.sum("d").alias("d"), F.sum("n").alias("c"), F.collect_list(F.struct("gid", "n")).alias("cells")
    )
    term = F.col("term") if "term" in keys else F.lit(None).cast("string")
    kept = grouped.where(F.col("d") >= min_docs)
    with small_batches(docs.sparkSession, SLICE_BYTES):
        return stored(kept.select("lid", "digest", term.alias("term"), "c", "cells"), "kept-terms")


def share(n: Column, size: Column) -> Column:
    """``1 + floor(SHARE * (n + 1) / size)``, exact for counts of any size; null for a size of 0."""
    wide = (F.lit(SHARE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")).alias("wide")
    plain = F.call_function("div", F.lit(SHARE) * (n + 1), size)
    exact = F.call_function("div", wide, size.cast("decimal(20,0)"))
    return F.when(size > 0, 1 + F.when(n < _LARGE, plain).otherwise(exact))


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q) ** 2 / q)``."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_sizes(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """Groups with ``v`` terms of their language, ``own`` of them in the group, and what shares divide by."""
    each = kept.select("lid", F.explode("cells").alias("cell"))
    own = each.groupBy(F.col("cell.gid").alias("gid")).agg(F.count("*").alias("own"), F.sum("cell.n").alias("n"))
    langs = kept.groupBy("lid").agg(F.count("*").alias("v"), F.sum("c").alias("lang_n"))
    sized = groups.join(own, "gid", "left").join(langs, "lid", "left").fillna(0, ["own", "n", "v", "lang_n"])
    size = F.col("n") + F.col("v")
    return stored(
        sized.select(
            "lid", "gid", "lang", "source", "own", "v", size.alias("size"),
            (F.col("lang_n") + F.col("v")).alias("lang_size"), share(F.lit(0), size).alias("p0"),
        ),
        "groups",
    )


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shared(lid: int, term: np.ndarray, gid: np.ndarray, p: np.ndarray, p0: np.ndarray) -> list[np.ndarray]:
    """Per pair of groups: what their common terms change against two sums that know one group each.

    Entries are ``(term, group, share, share of an absent term)`` of one language.
    """
    groups, first, at = np.unique(gid, return_index=True, return_inverse=True)
    absent = p0[first]
    _, row = np.unique(term, return_inverse=True)
    table = np.zeros((row.max() + 1, len(groups)), np.int64)
    table[row, at] = p
    total = np.zeros((len(groups), len(groups)), np.int64)
    for h in range(len(groups)):
        both = table[table[:, h] > 0]
        of_h = both[:, h : h + 1]
        change = _gap(both, of_h) - _gap(both, absent[h]) - _gap(absent, of_h) + _gap(absent, absent[h])
        total[:, h] = np.where(both > 0, change, 0).sum(axis=0)
    np.fill_diagonal(total, 0)
    g, h = np.nonzero(total)
    return [groups[g], groups[h], total[g, h]]


def _held_shares(sizes: list[tuple]) -> Callable[[pa.StructArray], list[np.ndarray]]:
    """Groups, shares and shares of absent terms of cells ``gid, n``, from ``gid, size, p0`` of all groups."""
    found = sorted(sizes)
    gids, divisors, absent = (np.array([r[i] or 0 for r in found], np.int64) for i in range(3))

    def of(cells: pa.StructArray) -> list[np.ndarray]:
        gid, n = cells.field(0).to_numpy(), cells.field(1).to_numpy()
        at = np.searchsorted(gids, gid)
        if len(n) and n.max() >= _LARGE:
            p = np.array([1 + SHARE * (c + 1) // d for c, d in zip(n.tolist(), divisors[at].tolist())], np.int64)
        else:
            p = 1 + SHARE * (n + 1) // divisors[at]
        return [gid, p, absent[at]]

    return of


def _given_shares(cells: pa.StructArray) -> list[np.ndarray]:
    return [cells.field(i).to_numpy() for i in range(3)]


def shared_terms(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``g, h, value``: blocks of terms of a language, one matrix of groups each.

    Shares are taken in the same pass: two Python steps in a row would hold two workers a task.
    """
    few, rows, size = scale.measured(sizes.select("gid", "size", "p0"), "group-sizes")
    if scale.is_small(rows, size):
        shares, of = kept, _held_shares(few.collect())
    else:
        each = kept.select("lid", "digest", "term", F.explode("cells").alias("cell"))
        joined = each.join(few.withColumnRenamed("gid", "of"), F.col("cell.gid") == F.col("of"))
        cell = F.struct("cell.gid", share(F.col("cell.n"), F.col("size")).alias("p"), "p0")
        shares, of = joined.groupBy("lid", "digest", "term").agg(F.collect_list(cell).alias("cells")), _given_shares

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lids = batch.column(0).to_numpy()
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            gid, p, p0 = of(lists.flatten())
            term = np.repeat(np.arange(len(sizes)), sizes)
            for lid in np.unique(lids).tolist():
                here = lids[term] == lid
                held = max(1, BLOCK_CELLS // max(1, len(np.unique(gid[here]))))
                rank = np.unique(term[here], return_inverse=True)[1]
                for block in range(0, rank.max() + 1 if len(rank) else 0, held):
                    inside = np.flatnonzero(here)[(rank >= block) & (rank < block + held)]
                    columns = _shared(lid, term[inside], gid[inside], p[inside], p0[inside])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["g", "h", "value"])

    return shares.select("lid", "cells").mapInArrow(run, "g long, h long, value long")


def pair_rows(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``gid, item, value`` for every two sources of a language.

    The sum over all kept terms is taken apart: as if no term were common to both, which
    needs the number of terms by share of one source, plus what the common terms change.
    """
    x, y = sizes.alias("x"), sizes.alias("y")
    both = F.expr("x.lid = y.lid AND x.gid <> y.gid")
    # All terms in neither source; one in a source takes its place among them.
    neither = F.when(F.col("x.v") == 0, 0).otherwise(
        (F.col("x.v") - F.col("x.own") - F.col("y.own")) * gap(F.col("x.p0"), F.col("y.p0"))
    )
    base = x.join(y, both).select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h"), neither.alias("value"))
    each = kept.select(F.explode("cells").alias("cell")).select("cell.gid", "cell.n")
    counts = stored(each.groupBy("gid", "n").agg(F.count("*").alias("terms")), "counts")
    one = counts.join(sizes.select("lid", "gid", "size"), "gid")
    one = one.select("lid", "gid", "terms", share(F.col("n"), F.col("size")).alias("p")).alias("x")
    alone = one.join(y, both)
    first = alone.groupBy(F.col("x.gid").alias("g"), F.col("y.gid").alias("h")).agg(
        F.sum(F.col("terms") * gap(F.col("p"), F.col("p0"))).alias("value")
    )
    second = alone.groupBy(F.col("y.gid").alias("g"), F.col("x.gid").alias("h")).agg(
        F.sum(F.col("terms") * gap(F.col("p0"), F.col("p"))).alias("value")
    )
    parts = base.unionByName(first).unionByName(second).unionByName(shared_terms(kept, sizes))
    total = parts.groupBy("g", "h").agg(F.sum("value").alias("value"))
    named = sizes.select(F.col("gid").alias("h"), F.col("source").alias("item"))
    order = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    return total.join(named, "h").select(F.col("g").alias("gid"), "item", "value").withColumn("rank", F.row_number().over(order))


def term_rows(kept: DataFrame, sizes: DataFrame, known: DataFrame, top: int) -> DataFrame:
    """``gid, item, value, rank``: the terms a source has more of than its language, ``top`` of each.

    Ranks by value alone keep all ties; only these rows meet their strings, which settle them.
    """
    each = kept.select("digest", "term", "c", F.explode("cells").alias("cell"))
    each = each.select("digest", "term", "c", "cell.gid", "cell.n")
    few = scale.lookup_join(each, sizes.select("gid", "size", "lang_size"), ["gid"], "inner")
    p, q = share(F.col("n"), F.col("size")), share(F.col("c"), F.col("lang_size"))
    valued = few.select("gid", "digest", "term", p.alias("p"), q.alias("q")).where("p > q")
    valued = valued.select("gid", "digest", "term", gap(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("gid").orderBy(F.desc("value"))
    best = valued.withColumn("rank", F.rank().over(by_value)).where(F.col("rank") <= top).drop("rank")
    texts = best.join(known.select("digest", "lo"), "digest").select("gid", F.coalesce("term", "lo").alias("item"), "value")
    by_text = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    return texts.withColumn("rank", F.row_number().over(by_text)).where(F.col("rank") <= top)


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 3,
    top: int = 200,
    digest_bits: int = 64,
) -> DataFrame:
    """Distances between the sources of every language: ``lang, source, part, item, value, rank``.

    Part ``pair`` has a row for each other source of the language, part ``term`` the ``top``
    terms that the source has more of than the language. Null texts, languages and sources
    count as empty; every row is a document, repeated ones too; other columns are ignored.
    A language without a kept term has pairs of value 0 and no terms; an empty table gives
    no rows. Values tie by the UTF-8 order of the item. ``digest_bits`` below 64 makes
    shared digests likely, for tests; results do not depend on it.
    """
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    groups = scale.global_row_number(rows.select("lang", "source").distinct(), ["lang", "source"], "gid")
    groups = stored(groups.select("gid", F.min("gid").over(Window.partitionBy("lang")).alias("lid"), "lang", "source"), "groups")
    placed = scale.lookup_join(rows, groups, ["lang", "source"], "inner").select("lid", "gid", "text")
    known = dictionary(placed, digest_bits)
    kept = kept_terms(placed, known, digest_bits, min_docs)
    sizes = group_sizes(groups, kept)
    found = pair_rows(kept, sizes).withColumn("part", F.lit("pair")).unionByName(
        term_rows(kept, sizes, known, top).withColumn("part", F.lit("term"))
    )
    named = sizes.select("gid", "lang", "source")
    return found.join(named, "gid").select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
