"""Helpers shared by the corpus operators: reading, row keys, word hashes, prefix sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitrep.operators import scale

SPACE = b" \t\n\x0b\x0c\r"
# Bytes of UTF-8 text that stand inside a word delimited by white space.
IN_WORD = np.array([b not in SPACE for b in range(256)])
# Bytes inside a word of letters and digits; every byte of a non-ASCII character counts.
IN_TERM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])

_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back; cuts the lineage.

    ``compression`` is that of the session if none is given. Where rows are large, Snappy keeps
    buffers of their size outside the heap; zstd does not.
    """
    path = scale.scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs inside hands rows to Python in Arrow batches of ``most`` bytes, or of one longer row.

    Both the executor and its worker hold a whole batch; by default only its rows are limited.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a row; only rows with the same id and text share it."""
    return F.xxhash64(doc_id, text)


def map_batches(df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``run`` over every Arrow batch of ``df``."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield run(batch)

    return df.mapInArrow(mapped, schema)


def map_rows(df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """``run`` over every batch of ``df``, whose columns it keeps by place; any names will do."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return map_batches(plain, run, plain.schema).toDF(*df.columns)


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """Strings of an Arrow column as UTF-8, one at a time."""
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py()


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch, one at a time, so that only one row's values are copied."""
    for i in range(batch.num_rows):
        yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns)}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_BASE, 1 << 12)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), 1 << 12)
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def word_spans(data: bytes, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which words start and end."""
    flags = np.zeros(len(data) + 2, np.int8)
    flags[1:-1] = inside[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(flags))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, inside: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a text, in order.

    A polynomial over the bytes of the word, taken from running sums, so that the work
    is a few array operations. Long texts go piece by piece, cut between words.
    """
    global _UP, _DOWN
    if len(data) > _PIECE:
        starts, ends = word_spans(data, inside)
        out, at = [], 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, "right")))
            out.append(_hashes(data[starts[at] : ends[stop - 1]], starts[at:stop] - starts[at], ends[at:stop] - starts[at]))
            at = stop
        return np.concatenate(out) if out else np.zeros(0, np.uint64)
    return _hashes(data, *word_spans(data, inside))


def _hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    global _UP, _DOWN
    n = len(data)
    if n + 1 > len(_UP):
        _UP, _DOWN = _powers(_BASE, 2 * n + 1), _powers(pow(_BASE, -1, 1 << 64), 2 * n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[np.frombuffer(data, np.uint8)] * _UP[:n], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    n = min(n, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total = _mix(total * np.uint64(_BASE) + words[k : len(words) - n + 1 + k])
    return total


def prefix_sums(df: DataFrame, order: Sequence[str], value: str, into: str, label: str) -> DataFrame:
    """Rows with ``into``: the sum of ``value`` over all rows before them in the given order.

    Rows are dealt out in ranges of the order, summed inside each range and written with
    their range; the totals of the ranges, one row per partition, give where each starts.
    No task sees more than its range. ``order`` must be unique, or tied rows be alike.
    """
    sorted_part = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = stored(ranged, label)
    totals = ranged.groupBy("__part").agg(F.sum(value).alias("__total"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("__part", F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__base"))
    inside = ranged.withColumn("__inside", F.coalesce(F.sum(value).over(sorted_part), F.lit(0)))
    return (
        inside.join(F.broadcast(bases), "__part")
        .withColumn(into, F.col("__base") + F.col("__inside"))
        .drop("__part", "__base", "__inside")
    )


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have ``most`` bytes together, or of one longer row."""
    sizes = np.diff(text_bytes(column)[1])
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts one after the other, and where each starts, with the end."""
    plain = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    bounds = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def words_and_rows(column: pa.Array, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a column of texts in order, A-Z lower-cased, and the row each stands in."""
    data, bounds = text_bytes(column)
    flags = inside[data]
    # A word goes on from the byte before unless a text begins.
    joined = np.zeros(len(flags) + 1, bool)
    joined[1:-1] = flags[1:] & flags[:-1]
    joined[bounds] = False
    starts = np.flatnonzero(flags & ~joined[:-1])
    ends = np.flatnonzero(flags & ~joined[1:]) + 1
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    letters = LOWER[data[flags]]
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())]
    )
    return words, np.searchsorted(bounds, starts, "right") - 1
