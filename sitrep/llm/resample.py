"""Resample documents towards a target distribution by hashed n-gram importance weights.

An Aho-Corasick dictionary of the distinct words, each with a blank on either side, carries
the CRC-32 and the length of every word. One scan of a text gives these payloads in order;
the CRC of a run of words is composed of the payloads of its words, without its bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import IN_TERM, LOWER, slices, stored, words_and_rows
from sitrep.operators import scale

# Text whose words are in one automaton; a longer text has one of its own.
SCAN_BYTES = 16 << 20
COUNTED = "doc_id long, n_words long, n_features long, buckets binary"
# Bytes of words stay, all others become blanks.
_BLANKED = np.where(IN_TERM, LOWER, 32).astype(np.uint8)
_CRC_BYTE = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)


def _zeros_appended(length: int) -> np.ndarray:
    """Table of 4 x 256 values: what each byte of a CRC becomes when ``length`` bytes follow."""
    powers = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(length):
        powers = (powers >> np.uint32(8)) ^ _CRC_BYTE[powers & np.uint32(255)]
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    parts = powers.reshape(4, 8)
    return np.bitwise_xor.reduce(np.where(bits[None] == 1, parts[:, None, :], np.uint32(0)), axis=2)


class Composer:
    """CRCs of joined byte strings from the CRCs of the parts."""

    def __init__(self):
        self.tables = {}

    def join(self, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """CRCs of left + right, where ``right`` has ``lengths`` bytes."""
        kinds, which = np.unique(lengths, return_inverse=True)
        for n in kinds.tolist():
            if n not in self.tables:
                self.tables[n] = _zeros_appended(n)
        tables = np.stack([self.tables[n] for n in kinds.tolist()]) if len(kinds) else np.zeros((1, 4, 256), np.uint32)
        moved = np.zeros(len(left), np.uint32)
        for byte in range(4):
            moved ^= tables[which, byte, (left >> np.uint32(8 * byte)) & np.uint32(255)]
        return moved ^ right


def dictionary(words: pa.Array):
    """Automaton over distinct words, blank-bounded; matches give a word's number."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, word in enumerate(words.to_pylist()):
        found.add_word(f" {word.decode()} ", number)
    found.make_automaton()
    return found


def scanned(column: pa.Array, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Words and feature buckets of every text of a column."""
    words, _ = words_and_rows(column, IN_TERM)
    distinct = words.unique()
    known = dictionary(distinct) if len(distinct) else None
    payload_crc = np.array([zlib.crc32(w) for w in distinct.to_pylist()], np.uint32)
    payload_len = np.array([len(w) for w in distinct.to_pylist()], np.int64)
    blank = np.uint32(zlib.crc32(b" "))
    composer = Composer()
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        text = value.as_py() or b""
        bounded = _BLANKED[np.frombuffer(text, np.uint8)].tobytes().decode()
        hits = known.iter(f" {bounded} ") if known is not None else ()
        found = np.fromiter((number for _, number in hits), np.int64)
        crcs, lengths = payload_crc[found], payload_len[found]
        # A word with the blank before it, to be put after a run.
        after = composer.join(np.full(len(found), blank), crcs, lengths) if n > 1 else crcs
        runs, out = crcs, [crcs]
        for size in range(2, n + 1):
            tail = slice(size - 1, None)
            runs = composer.join(runs[: max(len(found) - size + 1, 0)], after[tail], lengths[tail] + 1)
            out.append(runs)
        yield len(found), np.concatenate(out) % np.uint32(buckets)


def features(
    docs: DataFrame, n: int = 1, buckets: int = 10_000, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Words, features and their buckets of every text, written once.

    One row per input row. Features are all runs of 1 to ``n`` words, repeats counted; the
    buckets lie one after the other as 32-bit integers, 16-bit ones if they fit. Null and
    empty texts have none.
    """
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1), SCAN_BYTES):
                part = batch.slice(low, high - low)
                rows = [(words, len(b), b.astype(kind).tobytes()) for words, b in scanned(part.column(1), n, buckets)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), *columns], ["doc_id", "n_words", "n_features", "buckets"]
                )

    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return stored(rows.mapInArrow(run, COUNTED), "features")


def bucket_counts(counted: DataFrame, buckets: int) -> DataFrame:
    """``bucket, n``: features of all rows by bucket; each task sends one row per bucket."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return counted.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """``bucket, gain`` of every bucket: thousandths of the log of its share in the target over that in the source."""
    all_buckets = source.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    joined = (
        all_buckets.join(source.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .fillna(0, ["s", "t"])
    )
    totals = joined.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))
    joined = joined.crossJoin(F.broadcast(totals))  # one row
    above = (F.col("t") + 1).cast("double") * (F.col("s_all") + buckets).cast("double")
    below = (F.col("s") + 1).cast("double") * (F.col("t_all") + buckets).cast("double")
    return joined.select("bucket", F.floor(1000 * F.log(above / below)).alias("gain"))


def weighed(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """Rows with ``weight``, the floored mean gain of their features; 0 without any."""
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(v.as_py(), kind) for v in batch.column(3)]
            weight = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight, pa.int64())], [*batch.schema.names[:3], "weight"])

    return counted.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """Seeded Gumbel noise in thousandths; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Weight, noisy score and rank of every document: ``doc_id, n_words, n_features, weight, score, rank``.

    One row per input row. Of the documents with ``min_words`` words or more, ``percent`` in
    a hundred with the highest scores are drawn and ranked from 1, ties to the smaller id
    (null first); rows with one id and one score are alike and take ranks in any order.
    Undrawn rows have a null rank. Null and empty texts have no features, weight 0 and are
    never drawn. Only ``text`` of the target is read; an empty target has counts of zero.
    All that passes the driver is one number per bucket.
    """
    counted = features(docs, n, buckets, doc_id, text)
    wanted = features(target.select(F.lit(0).alias(doc_id), target[text].alias(text)), n, buckets, doc_id, text)
    table = gains(bucket_counts(counted, buckets), bucket_counts(wanted, buckets), buckets)
    gain = np.zeros(buckets, np.int64)
    for row in table.collect():
        gain[row["bucket"]] = row["gain"]
    scored = weighed(counted, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stored(scored, "scores")
    fit = scored.where(F.col("n_words") >= min_words)
    drawn = percent * fit.count() // 100
    ranked = scale.global_row_number(fit.withColumn("__down", -F.col("score")), ["__down", "doc_id", "weight", "n_words"], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.drop("__down").unionByName(rest)


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn; same columns. Ids must name the rows uniquely and not be null."""
    found = resampled(docs, target, doc_id=doc_id, **settings).where("rank IS NOT NULL")
    return docs.join(found.select(F.col("doc_id").alias("__drawn")), docs[doc_id].cast("long") == F.col("__drawn"), "left_semi")
