"""Repeated runs of lines, found with a suffix array over line ids by prefix doubling."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitrep.llm.common import map_batches, prefix_sums, stored

WORD = "[^\\x20\\x09-\\x0D]"


def numbered_lines(docs: DataFrame, doc_id: str, text: str, lengths: list[int], min_words: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the place of their first line, and their lines that have a word.

    ``need`` is the least of ``lengths`` so that so many lines from this one on have
    ``min_words`` words together; null if none is.

    Documents stand in the order of their ids (null first, then a hash of the text; rows
    with the same id and text are one document, ``copies`` says how many). Between two
    documents one place stays free, so that no run crosses it. Lines are compared by two
    64-bit hashes.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    sized = rows.select("doc_id", "key", (F.size(F.split(F.coalesce("text", F.lit("")), "\n")) + 1).alias("room"))
    sized = sized.groupBy("doc_id", "key", "room").agg(F.count("*").alias("copies"))
    placed = stored(prefix_sums(sized, ["doc_id", "key"], "room", "base", "line-bases"), "line-docs")
    each = rows.select("key", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "value"))
    each = each.where(F.col("value").rlike(WORD)).select(
        "key",
        "line",
        F.xxhash64("value").alias("h"),
        F.xxhash64(F.lit(1), "value").alias("h2"),
        F.regexp_count("value", F.lit(WORD + "+")).alias("words"),
    )
    # Lines without a word leave no place: runs go on after them.
    each = stored(each.dropDuplicates(["key", "line"]), "line-rows")
    inside = Window.partitionBy("key").orderBy("line")
    enough = [F.when(F.sum("words").over(inside.rowsBetween(0, n - 1)) >= min_words, F.lit(n)) for n in lengths]
    lines = (
        each.withColumn("nth", F.row_number().over(inside) - 1)
        .withColumn("need", F.coalesce(*enough, F.lit(None).cast("int")))
        .join(placed.select("key", "base"), "key")
        .select((F.col("base") + F.col("nth")).alias("at"), "key", "line", "h", "h2", "need")
    )
    return placed, stored(lines, "lines")


def line_ids(lines: DataFrame) -> DataFrame:
    """Suffixes that start with a repeated line: ``at`` and ``rank``, the id of the line.

    The id is the number of suffixes that start with a smaller line, as in a suffix array.
    """
    counts = lines.groupBy("h", "h2").agg(F.count("*").alias("n")).where("n > 1")
    ids = prefix_sums(counts, ["h", "h2"], "n", "rank", "line-ids")
    return stored(lines.select("at", "h", "h2").join(ids.select("h", "h2", "rank"), ["h", "h2"]).select("at", "rank"), "rank-1")


def paired(ranks: DataFrame, later: DataFrame, shift: int, label: str) -> DataFrame:
    """Ranks of longer prefixes: of the pair of a suffix's rank and that ``shift`` lines on.

    Suffixes whose pair no other has are done: nothing longer repeats there, and they leave.
    New ranks are places in the order of the pairs, from running sums over the distinct ones.
    """
    second = later.select((F.col("at") - shift).alias("at"), F.col("rank").alias("second"))
    pairs = stored(ranks.join(second, "at"), f"{label}-pairs")
    counts = pairs.groupBy("rank", "second").agg(F.count("*").alias("n")).where("n > 1")
    placed = prefix_sums(counts, ["rank", "second"], "n", "place", label)
    new = pairs.join(placed.select("rank", "second", "place"), ["rank", "second"])
    return stored(new.select("at", F.col("place").alias("rank")), label)


def doubled(ranks: DataFrame, lines: int) -> dict[int, DataFrame]:
    """Ranks of 1, 2, 4 … lines, up to ``lines``, by doubling."""
    found, length = {1: ranks}, 1
    while 2 * length <= lines:
        found[2 * length] = paired(found[length], found[length], length, f"rank-{2 * length}")
        length *= 2
    return found


def intervals(ranks: dict[int, DataFrame], lines: int) -> DataFrame:
    """Intervals of the suffix array whose common prefix is at least ``lines`` lines.

    ``rank`` is the same for the suffixes of an interval. If ``lines`` is no power of two,
    it comes from two overlapped ranks of the power below.
    """
    length = max(n for n in ranks if n <= lines)
    if length == lines:
        return ranks[length]
    return paired(ranks[length], ranks[length], lines - length, f"rank-{lines}")


def later_copies(ranks: DataFrame, lines: int) -> DataFrame:
    """Places of lines in intervals' later suffixes, the first in the corpus left out."""
    first = ranks.groupBy("rank").agg(F.min("at").alias("first"))
    later = ranks.join(first, "rank").where("at > first")
    return later.select(F.explode(F.sequence(F.col("at"), F.col("at") + (lines - 1))).alias("at"))


def repeated_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_lines: int = 3,
    min_words: int = 50,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their places, and the lines that are deleted: ``key, line``.

    A run counts if it has ``min_lines`` lines or more (blank lines do not count), or
    ``min_words`` words or more in all. Every line that belongs to a copy of a run that
    comes later in the corpus than the first one is deleted; so maximal runs go whole.
    Ranks beyond ``min_lines`` lines are not needed for that: each line of a longer maximal
    run stands in some run of exactly ``min_lines`` lines, which repeats where the longer
    one does.
    """
    lengths = list(range(1, min_lines))
    placed, lines = numbered_lines(docs, doc_id, text, lengths, min_words)
    ranks = doubled(line_ids(lines), min_lines)
    gone = later_copies(intervals(ranks, min_lines), min_lines)
    for n in lengths:
        # Suffixes of one interval have the same words, so an interval stays or goes whole.
        enough = lines.where(F.col("need") <= n).select("at")
        gone = gone.unionAll(later_copies(intervals(ranks, n).join(enough, "at", "left_semi"), n))
    return placed, lines.join(gone.distinct(), "at", "left_semi").select("key", "line")


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_lines: int = 3,
    min_words: int = 50,
) -> DataFrame:
    """Texts without later copies of repeated line runs: one row per input row.

    ``n_lines`` counts all lines, ``n_removed`` those deleted. A null text stays null and has
    no lines; an empty one is one line without a word. Rows that repeat an id and its text
    are one document: each gets the same result.
    """
    placed, gone = repeated_runs(docs, doc_id, text, min_lines, min_words)
    removed = gone.groupBy("key").agg(F.array_sort(F.collect_list("line")).alias("removed"))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    joined = rows.join(removed, "key", "left").select("doc_id", "text", "removed")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes, cut = [], [], []
        for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            lines = [] if text is None else text.split("\n")
            gone = set(places or ())
            sizes.append(len(lines))
            cut.append(len(gone))
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
        arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cut, pa.int64()), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_lines", "n_removed", "text"])

    return map_batches(joined, run, "doc_id long, n_lines long, n_removed long, text string")
