"""Token ids in flat binary files with 64-bit document offsets.

A corpus is a folder of shards. ``<shard>.ids`` holds the token ids of its documents one
after the other as little-endian unsigned integers (16 bits if the vocabulary allows, else
32), ``<shard>.off`` the start of every document in ids and one past the last, 64 bits
each, and ``<shard>.doc`` the 64-bit document ids, ``NO_ID`` for null. ``manifest`` is a
Parquet table with one row per shard: files of tasks that were repeated are not in it.
"""

from __future__ import annotations

import os
import re
import string
import sys
import types
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitrep.functions.files import open_filesystem
from sitrep.llm.common import slices, text_bytes
from sitrep.operators import scale

NO_ID = -(2**63)
MANIFEST = "shard int, file string, width int, n_docs long, n_tokens long"
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"
# Words after which a worker begins a new list of those it remembers; it keeps two lists.
REMEMBERED = 300_000

# Texts that are cut into words and put together at once.
BATCH_BYTES = 1 << 21
# Words that are encoded as one text, and such texts in one call.
TOGETHER = 100
CALL = 64

_INNER_SPACE = re.compile(r"[^\S \n]")
_CUTS = np.isin(np.arange(256), list(b" \n"))
_LETTERS = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])


def _runs(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    return flat[np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)]


class Held:
    """Words by number, and their ids in one array."""

    def __init__(self, dtype: np.dtype):
        self.numbers: dict[bytes, int] = {}
        self.flat, self.sizes = np.zeros(0, dtype), np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def find(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words, -1 for those not held."""
        return np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[numbers]
        return _runs(self.flat, self.starts[numbers], sizes), sizes

    def add(self, words: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        self.numbers.update(zip(words, range(len(self.sizes), len(self.sizes) + len(words))))
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
        self.flat, self.sizes = np.append(self.flat, flat), np.append(self.sizes, sizes)


class Encoder:
    """Ids of texts, word by word, with the ids of words seen lately at hand.

    A byte-level vocabulary splits a text at every single space or line feed between two
    words, so that each word with the mark before it has the same ids wherever it stands. A
    batch of texts is cut there, each distinct word looked up or encoded once, and the ids
    put together as arrays. Words not at hand are encoded many at a time. Texts with other
    white space, with more of it in a row, or with the name of a special token go to the
    tokenizer whole.
    """

    def __init__(self, path: str, dtype: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(dtype)
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.known, self.older = Held(self.dtype), Held(self.dtype)
        self.by_word = self._is_byte_level()
        # Bytes of text that every id stands for: a byte-level vocabulary writes a letter for each.
        vocabulary = self.tokenizer.get_vocab() if self.by_word else {}
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = list(map(len, vocabulary))
        self.names = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Bytes that begin a piece of their own after a letter, and stand in no name.
        marks = set(string.punctuation + string.digits) - set("'").union(*self.names)
        self.marks = np.isin(np.arange(256), list(map(ord, marks)))

    def _is_byte_level(self) -> bool:
        kind = type(self.tokenizer.pre_tokenizer).__name__
        return kind == "ByteLevel" and not self.tokenizer.pre_tokenizer.add_prefix_space and not self.tokenizer.normalizer

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _cut(self, units: list[bytes], ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and how many each has; each encoded alone if one has no id that ends with it."""
        flat = np.array(ids, self.dtype)
        ends, wanted = np.cumsum(self.bytes_of[flat]), np.cumsum(list(map(len, units)))
        last = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or (ends[last] != wanted).any():
            return self._joined([self._whole(unit.decode()) for unit in units])
        return flat, np.diff(last, prepend=-1)

    def _encode_new(self, units: list[bytes]) -> None:
        """Take in distinct words; those with a mark before them are encoded together, as they could stand in a text."""
        marked = [unit for unit in units if unit[:1] in b" \n"]
        groups = [marked[i : i + TOGETHER] for i in range(0, len(marked), TOGETHER)]
        groups += [[unit] for unit in units if unit[:1] not in b" \n"]
        for i in range(0, len(groups), CALL):
            some = groups[i : i + CALL]
            found = self.tokenizer.encode_batch_fast([b"".join(g).decode() for g in some], add_special_tokens=False)
            words = list(chain.from_iterable(some))
            self.known.add(words, *self._cut(words, list(chain.from_iterable(e.ids for e in found))))

    def _words(self, units: list[bytes], strange: np.ndarray) -> np.ndarray:
        """Numbers of distinct words with the mark before them among those known; -1 for strange ones."""
        if len(self.known.numbers) > REMEMBERED:
            self.older, self.known = self.known, Held(self.dtype)
        numbers = self.known.find(units)
        missing = np.flatnonzero((numbers < 0) & ~strange)
        words = [units[i] for i in missing.tolist()]
        before = self.older.find(words)
        again = before >= 0
        self.known.add([w for w, a in zip(words, again.tolist()) if a], *self.older.ids(before[again]))
        self._encode_new([w for w, a in zip(words, again.tolist()) if not a])
        numbers[missing] = self.known.find(words)
        return numbers

    def _odd(self, data: np.ndarray, units: list[bytes]) -> np.ndarray:
        """Which distinct words hold other white space or the name of a special token."""
        text = data.tobytes().decode()
        odd = np.zeros(len(units), bool)
        for unusual in (_INNER_SPACE, *map(re.compile, map(re.escape, self.names))):
            if unusual.search(text):
                odd |= [bool(unusual.search(u.decode())) for u in units]
        return odd

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after the other, and how many each has."""
        if not self.by_word:
            whole = [self._whole(text) for text in column.fill_null("").to_pylist()]
            return self._joined(whole)
        data, bounds = text_bytes(column)
        begins = np.zeros(len(data) + 1, bool)
        begins[:-1] = _CUTS[data]
        begins[bounds] = True
        if len(data) > 1:
            # A mark or a digit after a letter begins a piece of its own.
            begins[1:-1] |= self.marks[data[1:]] & _LETTERS[data[:-1]]
        offsets = np.flatnonzero(begins)
        units = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
        ).dictionary_encode()
        held, starts = text_bytes(units.dictionary)
        letters, places = held.tobytes(), starts.tolist()
        distinct = [letters[a:b] for a, b in zip(places, places[1:])]
        # A space or line feed at the end of a text has no word after it.
        bare = (np.diff(starts) == 1) & _CUTS[held[starts[:-1]]]
        number = self._words(distinct, self._odd(data, distinct) | bare)
        code = units.indices.to_numpy()
        row = np.searchsorted(bounds, offsets[:-1], "right") - 1
        odd = np.zeros(len(column), bool)
        odd[row[(number < 0)[code]]] = True
        plain, each = self.known.ids(number[code[~odd[row]]])
        counts = np.bincount(row[~odd[row]], each, len(column)).astype(np.int64)
        if not odd.any():
            return plain, counts
        ends = np.cumsum(counts)
        parts = [
            self._whole(column[i].as_py()) if odd[i] else plain[ends[i] - counts[i] : ends[i]].tobytes()
            for i in range(len(column))
        ]
        return self._joined(parts)

    def _joined(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(p) // self.dtype.itemsize for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), self.dtype), sizes


def _encoder(path: str, dtype: str) -> Encoder:
    """The worker's encoder; one per process, kept between its tasks."""
    kept = sys.modules.setdefault("_sitrep_encoders", types.ModuleType("_sitrep_encoders")).__dict__
    if (path, dtype) not in kept:
        kept[path, dtype] = Encoder(path, dtype)
    return kept[path, dtype]


def token_width(tokenizer: str, end_id: int) -> int:
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    return 2 if max(size - 1, end_id) < 2**16 else 4


def write_corpus(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode all texts, in ascending order of id, into shards below ``path``; the manifest.

    Rows are dealt out in ranges of the id (null first; rows with one id by a hash of the
    text, so that many of them still spread) and written in that order, one shard per
    partition. A task holds one batch of texts and its shard's offsets. Null texts are
    empty; every document ends with ``end_id``. ``tokenizer`` is a file all executors have.
    """
    width = token_width(tokenizer, end_id)
    dtype = f"<u{width}"
    run = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(tokenizer, dtype)
        shard = TaskContext.get().partitionId()
        store, folder = open_filesystem(path)
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        lengths, ids = [], []
        out = None
        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}.ids")
            for low, high in slices(batch.column(1), BATCH_BYTES):
                found, counts = encoder.encode(batch.column(1).slice(low, high - low))
                lengths += (counts + 1).tolist()
                out.write(np.insert(found, np.cumsum(counts), end_id).tobytes())
            ids.append(batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False))
        if out is None:
            return
        out.close()
        offsets = np.zeros(len(lengths) + 1, "<u8")
        np.cumsum(lengths, out=offsets[1:])
        for ending, data in (("off", offsets), ("doc", np.concatenate(ids).astype("<i8"))):
            with store.open_output_stream(f"{folder}/{name}.{ending}") as part:
                part.write(data.tobytes())
        row = {"shard": [shard], "file": [name], "width": [width], "n_docs": [len(lengths)], "n_tokens": [int(offsets[-1])]}
        yield pa.RecordBatch.from_pydict(
            row, pa.schema([("shard", pa.int32()), ("file", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        )

    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest-{run}")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest-{run}")


def mapped(path: str, file: str, ending: str, dtype: str) -> np.ndarray:
    """A file of a shard: memory-mapped from a folder, read from a store."""
    store, folder = open_filesystem(path)
    whole = f"{folder}/{file}.{ending}"
    if store.type_name == "local":
        return np.memmap(whole, dtype, "r") if os.path.getsize(whole) else np.zeros(0, dtype)
    with store.open_input_file(whole) as part:
        return np.frombuffer(part.read_buffer(), dtype)


def read_corpus(path: str, manifest: DataFrame) -> DataFrame:
    """One row per document of the files: its place, length and checksum of its ids.

    A shard starts after the ids of the shards before it. The running sum over the manifest,
    one row per shard, gives that; each task then maps the files of its shards.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = mapped(path, row["file"], "ids", f"<u{row['width']}")
                offsets = mapped(path, row["file"], "off", "<u8").astype(np.int64)
                docs = np.array(mapped(path, row["file"], "doc", "<i8"))
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[:-1], offsets[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs, mask=docs == NO_ID),
                        pa.array(offsets[:-1] + row["base"]),
                        pa.array(np.diff(offsets)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One shard to a task. The number is named, as adaptive execution would merge such small rows.
    shards = max(1, manifest.count())
    return based.repartitionByRange(shards, "shard").mapInArrow(read, RESULT)


def new_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, with its file system spelled out for tasks that open files."""
    path = scale.scratch_dir(spark, "tokens")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the corpus to a new folder and read it back; one row per input row.

    An empty table gives no shards and no rows. Rows with one id come in the order of a
    hash of their text; other columns are ignored.
    """
    path = new_folder(docs.sparkSession)
    return read_corpus(path, write_corpus(docs, path, tokenizer, end_id, doc_id, text))
