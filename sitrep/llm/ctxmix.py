"""Language model scores by logistic context mixing over the bits of words.

A text is a row of words and one end, a word its bytes and a blank. Every bit is predicted
from several hashed contexts (the last one, two, three, four and six bytes of the text, over
the ends of words, and all of the word so far), whose counts come from all training texts.
Bytes with the same contexts are one gram, which is worked out once: the first six bytes of
a word by the text before it, later ones, whose contexts lie in the word, by word. Gated weights combine the
predictions: which weights count depends on how well the long contexts are known. The
result is refined twice: bit by bit through a learned correction by the last byte, and word
by word with the exact training counts of whole words, which differ by class of text. The
class, the share of words a text repeats and the weight of whole words against their bits
are never told: a score sums over them, so that it adapts to each document. Counts, classes, weights and correction come from all training
texts, as sums that tasks take and the driver adds up, round by round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import _BYTE, _UP, IN_WORD, _hashes, _mix, rows_of, slices, small_batches, stored, text_bytes, words_and_rows

# Text of one chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 32 << 20
# Text of a chunk that is split into words at a time; a longer document is a piece of its own.
PIECE_BYTES = 1 << 20
# Bytes of rows that reach a task at a time while the model is learned.
BATCH_BYTES = 4 << 20
# Words that a task hands back at a time.
BATCH_ROWS = 1 << 14
# Bytes before a bit that make its contexts; 0 stands for the whole word so far.
ORDERS = (1, 2, 3, 4, 6, 0)
# Bytes of a word whose contexts reach into the text before it.
REACH = max(ORDERS)
# Slots of each context's table, as powers of two.
SLOT_BITS = (16, 18, 20, 21, 22, 21)
STARTS = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])])
PARTS = 64
# Bytes of words that are worked on at a time.
BLOCK = 1 << 16
# Tokens of texts that are scored at a time.
TOKENS = 1 << 18
# Tokens whose grams are told apart at a time, and of these as many as a processor's cache holds.
GRAM_TOKENS = 1 << 21
FEW_TOKENS = 1 << 15
# Grams a task gathers before it sends them, and the most that are predicted once for all chunks.
GRAMS = 1 << 22
FREQUENT = 1 << 21
# Texts whose words are counted by bucket at a time.
TEXTS = 256
BUCKETS = 1024
# Words from which a text counts fully as the start of a class.
FULL_TEXT = 1000
# Rounds that move the weights; one Newton step over all words comes close.
ROUNDS = 1
# Shares of words that repeat one of their text; a score sums over them.
CACHES = (0.02, 0.1, 0.3)
# Parts of the weight that whole words have where the text before is not known; a score sums over them.
DICTIONARIES = (1, 0.3, 0.1)
# Log ratios of a word's two probabilities are counted in steps up to a limit.
RATIO_STEP, RATIO_MOST = 1 / 32, 30
LEVELS = 33
_NODE, _SLOT, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)
CHUNK = (
    "chunk long, ids binary, no_id binary, held binary, lengths binary, tokens binary, "
    "words binary, word_lengths binary, buckets binary"
)
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, bits_per_byte double"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(pa.py_buffer(np.ascontiguousarray(values)), codec="zstd", asbytes=True) if values.size else b""


def _unpacked(data: bytes, dtype, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    return np.frombuffer(pa.decompress(data, n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def word_buckets(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the BUCKETS of the class model each word is in."""
    bounds = np.append(0, ends).astype(np.int64)
    out = np.empty(len(ends), np.uint64)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1)
        raw = data[bounds[at] : bounds[stop]].tobytes()
        out[at:stop] = _hashes(raw, bounds[at:stop] - bounds[at], bounds[at + 1 : stop + 1] - bounds[at])
        at = stop
    return (out % np.uint64(BUCKETS)).astype(np.int64)


def tokenized(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words as bytes and ends, tokens as their numbers, and tokens per text.

    The last distinct word is empty: the end, which every text has once.
    """
    words, rows = words_and_rows(column, IN_WORD)
    coded = words.dictionary_encode()
    _, offsets, data = coded.dictionary.buffers()
    ends = np.frombuffer(offsets, np.int64)[coded.dictionary.offset :][1 : len(coded.dictionary) + 1]
    letters = np.frombuffer(data, np.uint8)[: ends[-1]] if len(ends) else np.zeros(0, np.uint8)
    lengths = np.bincount(rows, minlength=len(column)) + 1
    tokens = np.full(len(words) + len(column), len(ends), np.uint32)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(lengths) - 1] = False
    tokens[inside] = coded.indices.to_numpy()
    return letters, np.append(ends, ends[-1] if len(ends) else 0).astype(np.int64), tokens, lengths


def whole(pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What :func:`tokenized` gives for the texts of all pieces, from what it gave for each."""
    if len(pieces) == 1:
        return pieces[0]
    words = pa.concat_arrays([_words(letters, ends[:-1]).cast(pa.large_binary()) for letters, ends, _, _ in pieces])
    coded = words.dictionary_encode()
    letters, ends = _letters(coded.dictionary)
    number, tokens, at = coded.indices.to_numpy().astype(np.uint32), [], 0
    for _, own, some, _ in pieces:
        tokens.append(np.append(number[at : at + len(own) - 1], np.uint32(len(ends)))[some])
        at += len(own) - 1
    ends = np.append(ends, ends[-1] if len(ends) else 0).astype(np.int64)
    return letters, ends, np.concatenate(tokens), np.concatenate([lengths for *_, lengths in pieces])


def _far(hist: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """How well each text would start a class: far from the seeds, and not too short to say much."""
    n = hist.sum(axis=1)
    near = np.sqrt(hist / n[:, None])
    like = (near @ seeds.T).max(axis=1) if len(seeds) else np.zeros(len(n))
    return np.round(np.minimum(n, FULL_TEXT) * (1 - like), 6)


def _farthest(hist: np.ndarray, seeds: np.ndarray) -> tuple[float, float, bytes] | None:
    """The text that starts a class best, its words and its row; the longer one, then the larger one, of equals."""
    far = _far(hist, seeds)
    n = hist.sum(axis=1)
    best = np.flatnonzero((far == far.max()) & (far > 0)) if len(far) else []
    return max(((float(far[i]), float(n[i]), hist[i].tobytes()) for i in best if n[i] == n[best].max()), default=None)


def _seed(best: tuple[float, float, bytes]) -> np.ndarray:
    return np.sqrt(np.frombuffer(best[2]) / best[1])


def _log_shares(table: np.ndarray) -> np.ndarray:
    total = table + 0.5
    return np.log(total / total.sum(axis=1, keepdims=True))


def _joined(hist: np.ndarray, model: np.ndarray, seeds: bool) -> tuple[np.ndarray, np.ndarray]:
    """Words of the texts of each class by bucket, and its texts: by nearest seed, else by likelihood."""
    fits = np.sqrt(hist / hist.sum(axis=1, keepdims=True)) @ model.T if seeds else hist @ model.T
    member = np.argmax(fits, axis=1)
    own = np.eye(len(model))[member]
    return own.T @ hist, own.sum(axis=0)


def _class_rounds(classes: int, farthest, joined, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of buckets by class, and the training texts of each class.

    ``farthest(seeds)`` is the best new start among all texts, ``joined(model, seeds)`` the sums
    over all texts of what :func:`_joined` gives.
    """
    seeds = np.zeros((0, BUCKETS))
    while len(seeds) < classes and (best := farthest(seeds)) is not None:
        seeds = np.vstack([seeds, _seed(best)])
    if not len(seeds):
        return np.full((classes, BUCKETS), -np.log(BUCKETS)), np.zeros(classes)
    table, docs = joined(seeds, True)
    empty = classes - len(seeds)
    for _ in range(rounds):
        before = table
        shares = _log_shares(np.vstack([table, np.zeros((classes - len(table), BUCKETS))]) if empty else table)
        table, docs = joined(shares, False)
        empty = 0
        if before.shape == table.shape and (before == table).all():
            break
    return shares, docs


def class_model(samples: list[tuple[np.ndarray, np.ndarray]], classes: int, rounds: int = 12) -> np.ndarray:
    """Log shares of hashed words by class, from texts given as (bucket, count) pairs.

    Texts far from each other start the classes; then every text joins the class under
    which it is likeliest, and classes are counted anew.
    """
    hist = np.zeros((len(samples), BUCKETS))
    for row, (bucket, count) in zip(hist, samples):
        np.add.at(row, bucket, count)
    return _class_rounds(classes, lambda seeds: _farthest(hist, seeds), lambda m, s: _joined(hist, m, s), rounds)[0]


def histograms(bucket: np.ndarray, tokens: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Some texts at a time: which, and how many of their tokens are in each bucket."""
    ends = np.append(0, np.cumsum(lengths))
    for low in range(0, len(lengths), TEXTS):
        high = min(low + TEXTS, len(lengths))
        doc = np.repeat(np.arange(high - low) * BUCKETS, lengths[low:high])
        found = np.bincount(doc + bucket[tokens[ends[low] : ends[high]]], minlength=(high - low) * BUCKETS)
        yield slice(low, high), found.reshape(-1, BUCKETS).astype(np.float64)


def class_shares(found: DataFrame, classes: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """:func:`class_model` of all training texts in chunks, and the texts of each class.

    Every round reads the texts where they lie; a task sends one row.
    """
    texts = found.select("held", "lengths", "tokens", "buckets")

    def training(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for row in rows_of(batch):
                held, lengths, tokens, bucket = _texts_of(row)
                tokens, lengths = tokens[np.repeat(~held, lengths)], lengths[~held]
                for _, hist in histograms(bucket, tokens, lengths):
                    yield hist

    def farthest(seeds: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = max((b for b in (_farthest(h, seeds) for h in training(batches)) if b), default=None)
            if best:
                yield pa.RecordBatch.from_pylist([{"far": best[0], "n": best[1], "row": best[2]}])

        rows = texts.mapInArrow(run, "far double, n double, row binary").collect()
        return max(((r["far"], r["n"], bytes(r["row"])) for r in rows), default=None)

    def joined(model: np.ndarray, seeds: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, docs = np.zeros((len(model), BUCKETS)), np.zeros(len(model))
            for hist in training(batches):
                more, n = _joined(hist, model, seeds)
                table, docs = table + more, docs + n
            if docs.any():
                yield pa.RecordBatch.from_pylist([{"sums": _packed(table), "docs": docs.tolist()}])

        rows = texts.mapInArrow(run, "sums binary, docs array<double>").collect()
        table, docs = np.zeros((len(model), BUCKETS)), np.zeros(len(model))
        for r in rows:
            table += _unpacked(bytes(r["sums"]), np.float64, table.size).reshape(table.shape)
            docs += r["docs"]
        return table, docs

    return _class_rounds(classes, farthest, joined, rounds)


def _texts_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether texts are held out, their lengths and tokens, and the buckets of the chunk's words."""
    lengths = np.frombuffer(row["lengths"], np.int64)
    tokens = _unpacked(row["tokens"], np.uint32, int(lengths.sum()))
    bucket = np.frombuffer(pa.decompress(row["buckets"][8:], int.from_bytes(row["buckets"][:8], "little"), codec="zstd", asbytes=True), np.uint16)
    return np.frombuffer(row["held"], bool), lengths, tokens, bucket


def chunks(docs: DataFrame) -> DataFrame:
    """Tokenized texts in chunks, with the bucket of every word.

    ``docs`` has ``doc_id, held, text``; written once.
    """

    def row(name: int, pieces: list, ids: list[bytes], no_id: list[bytes], held: list[bytes]) -> dict:
        letters, ends, tokens, lengths = whole(pieces)
        bucket = word_buckets(letters, ends).astype(np.uint16)
        return {
            "chunk": name,
            "ids": b"".join(ids),
            "no_id": b"".join(no_id),
            "held": b"".join(held),
            "lengths": lengths.astype(np.int64).tobytes(),
            "tokens": _packed(tokens),
            "words": _packed(letters),
            "word_lengths": np.diff(ends, prepend=0).astype(np.uint32).tobytes(),
            "buckets": bucket.nbytes.to_bytes(8, "little") + _packed(bucket),
        }

    schema = pa.schema([("chunk", pa.int64())] + [(c.split()[0], pa.binary()) for c in CHUNK.split(", ")[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        parts, size = [], 0

        def ended() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row((task << 31) + n, *map(list, zip(*parts)))], schema)

        for batch in batches:
            bounds = text_bytes(batch.column(2))[1]
            for low, high in slices(batch.column(2), PIECE_BYTES):
                more = int(bounds[high] - bounds[low])
                if parts and size + more > CHUNK_BYTES:
                    yield ended()
                    parts, size, n = [], 0, n + 1
                    # An idle worker keeps what Arrow has freed otherwise.
                    pa.default_memory_pool().release_unused()
                ids, held, text = batch.slice(low, high - low).columns
                of_row = (ids.fill_null(0), ids.is_null(), held)
                parts.append((tokenized(text), *(c.to_numpy(zero_copy_only=False).tobytes() for c in of_row)))
                size += more
        if parts:
            yield ended()
        parts = None
        pa.default_memory_pool().release_unused()

    return stored(docs.select("doc_id", "held", "text").mapInArrow(run, CHUNK), "chunks", "zstd")


class Chunk:
    """Words of one row of the chunks, as arrays."""

    def __init__(self, row: dict):
        self.name = row.get("chunk")
        self.ends = np.cumsum(np.frombuffer(row["word_lengths"], np.uint32), dtype=np.int64)
        self.letters = _unpacked(row["words"], np.uint8, int(self.ends[-1]))


def class_counts(row: dict, shares: np.ndarray) -> np.ndarray:
    """How often the training texts of each class have each word of a chunk.

    A text is in the class it is likeliest under.
    """
    held, lengths, tokens, bucket = _texts_of(row)
    member = np.concatenate([np.argmax(hist @ shares.T, axis=1) for _, hist in histograms(bucket, tokens, lengths)])
    of_token = np.repeat(np.where(held, -1, member), lengths)
    return np.stack([np.bincount(tokens[of_token == k], minlength=len(bucket)) for k in range(len(shares))])


def word_table(found: DataFrame, shares: np.ndarray) -> DataFrame:
    """``word, n0, n1, ...``: all words and their training occurrences by class, written once.

    Chunks send each of their words once; the words of a partition come sorted, and equal
    ones, which may lie in two batches, are added up as they pass.
    """
    classes = len(shares)
    names = [f"n{k}" for k in range(classes)]
    schema = "word binary, " + ", ".join(f"{n} long" for n in names)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                chunk = Chunk(row)
                columns = [_words(chunk.letters, chunk.ends)] + [pa.array(n.astype(np.int64)) for n in class_counts(row, shares)]
                yield from _in_rows(pa.RecordBatch.from_arrays(columns, ["word", *names]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            if not batch.num_rows:
                continue
            word = batch.column(0)
            new = pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.append(True, new))
            merged = [word.take(pa.array(first))]
            merged += [pa.array(np.add.reduceat(batch.column(1 + k).to_numpy(), first)) for k in range(classes)]
            done = pa.RecordBatch.from_arrays(merged, batch.schema.names)
            # The last word may go on in the next batch.
            held = done.slice(len(first) - 1)
            if len(first) > 1:
                yield done.slice(0, len(first) - 1)
        if held is not None:
            yield held

    rows = found.select("chunk", "words", "word_lengths", "held", "lengths", "tokens", "buckets").mapInArrow(send, schema)
    return stored(rows.repartition("word").sortWithinPartitions("word").mapInArrow(merge, schema), "words", "zstd")


def _in_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch some rows at a time, which is what the executor then holds."""
    for low in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(low, BATCH_ROWS)


def _words(letters: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())])


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    plain = words.cast(pa.large_binary())
    _, offsets, data = plain.buffers()
    bounds = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds[1:] - bounds[0]


def blocks(letters: np.ndarray, ends: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of words of some bytes: their bytes with a blank after each, and every byte's place in its word."""
    at = 0
    before = np.append(0, ends)
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, before[at] + size, "right")))
        sizes = np.diff(before[at : stop + 1]) + 1
        last = np.cumsum(sizes) - 1
        data = np.full(last[-1] + 1, 32, np.uint8)
        inside = np.ones(len(data), bool)
        inside[last] = False
        data[inside] = letters[before[at] : before[stop]]
        place = np.arange(len(data)) - np.repeat(last - sizes + 1, sizes)
        yield at, stop, data, place
        at = stop


def _orders(before) -> dict[int, np.ndarray]:
    """Hash of the last bytes by their number; ``before(back)`` gives the byte so far back and one, or 0."""
    found, now = {}, np.uint64(0)
    for back in range(1, REACH + 1):
        now = (now + before(back)) * _STEP
        now ^= now >> np.uint64(29)
        found[back] = now
    return found


def contexts(data: np.ndarray, place: np.ndarray, known: np.ndarray | None = None) -> list[np.ndarray]:
    """Hash of each context of every byte, given its place in its word and how many bytes of its text stand before it.

    Without ``known`` every word is the first of a text.
    """
    known = place if known is None else known

    def before(back: int) -> np.ndarray:
        found = np.zeros(len(data), np.uint64)
        found[back:] = data[: max(len(data) - back, 0)].astype(np.uint64) + np.uint64(1)
        return np.where(known >= back, found, np.uint64(0))

    found = _orders(before)
    places = np.arange(len(data))
    found[0] = _hashes(data.tobytes(), places - place, places)
    return [found[order] for order in ORDERS]


_BITS = np.uint64(8 * REACH)
_LAST = (np.uint64(1) << _BITS) - np.uint64(1)
_BYTE_OF = np.uint64(255)


class Openings:
    """The first bytes of words in texts and the bytes before them, as grams.

    A gram holds, from its lowest bits, the byte, the REACH bytes before it, how many of them
    there are, and the byte's place in its word.
    """

    def __init__(self, letters: np.ndarray, ends: np.ndarray):
        sizes = np.diff(ends, prepend=0)
        self.head, self.tail = np.zeros(len(ends), np.uint64), np.full(len(ends), 32, np.uint64)
        padded = np.concatenate([np.zeros(REACH, np.uint8), letters, np.zeros(REACH, np.uint8)])
        for j in range(REACH):
            own = np.where(j < sizes, padded[ends - sizes + j + REACH], 32).astype(np.uint64)
            self.head |= own << np.uint64(8 * j)
            if j:
                self.tail |= np.where(j <= sizes, padded[ends - j + REACH], 0).astype(np.uint64) << np.uint64(8 * j)
        self.size = np.minimum(sizes + 1, REACH).astype(np.uint64)

    def before(self, tokens: np.ndarray, begins: np.ndarray, low: int, high: int) -> np.ndarray:
        """Of some tokens, given which begin a text: the last bytes before each, and above them how many there are."""
        out = np.empty(high - low, np.uint64)
        for at in range(low, high, FEW_TOKENS):
            index = np.arange(at, min(at + FEW_TOKENS, high))
            last, known, goes = np.zeros(len(index), np.uint64), np.zeros(len(index), np.uint64), np.ones(len(index), bool)
            # A word has a letter and a blank at least.
            for back in range(1, REACH // 2 + 1):
                goes &= ~begins[np.maximum(index - back + 1, 0)]
                word = tokens[np.maximum(index - back, 0)]
                last |= np.where(goes, self.tail[word], np.uint64(0)) << (known * np.uint64(8))
                known = np.minimum(known + np.where(goes, self.size[word], np.uint64(0)), np.uint64(REACH))
            out[at - low : at - low + len(index)] = (last & _LAST) | known << _BITS
        return out

    def grams(self, words: np.ndarray, before: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each place: which of the words have a byte there, and their grams, given what is before them."""
        index = [np.empty(len(words), np.int32) for _ in range(REACH)]
        found = [np.empty(len(words), np.uint64) for _ in range(REACH)]
        n = [0] * REACH
        for at in range(0, len(words), FEW_TOKENS):
            word, last = words[at : at + FEW_TOKENS], before[at : at + FEW_TOKENS] & _LAST
            known, own = before[at : at + FEW_TOKENS] >> _BITS, np.arange(at, at + len(word), dtype=np.int32)
            head, size = self.head[word], self.size[word]
            for place in range(REACH):
                if place:
                    more = np.flatnonzero(size > place)
                    own, head, size, last, known = own[more], head[more], size[more], last[more], known[more]
                byte = (head >> np.uint64(8 * place)) & _BYTE_OF
                to = slice(n[place], n[place] + len(own))
                index[place][to] = own
                found[place][to] = (((np.uint64(place << 3) | known) << _BITS | last) << np.uint64(8)) | byte
                n[place] += len(own)
                last = (last << np.uint64(8) | byte) & _LAST
                known = np.minimum(known + np.uint64(1), np.uint64(REACH))
        for place in range(REACH):
            yield index[place][: n[place]], found[place][: n[place]]


def beginnings(lengths: np.ndarray) -> np.ndarray:
    """Which tokens are the first of a text."""
    out = np.zeros(int(lengths.sum()), bool)
    out[np.cumsum(lengths) - lengths] = True
    return out


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, in no order, and which of them each is."""
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy()


def gram_contexts(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of grams: what :func:`contexts` gives, the byte, and the byte before in the word, 256 if there is none."""
    last = (keys >> np.uint64(8)) & _LAST
    known = (keys >> (_BITS + np.uint64(8))) & np.uint64(7)
    place = (keys >> (_BITS + np.uint64(11))).astype(np.int64)

    def byte(back: int) -> np.ndarray:
        return (last >> np.uint64(8 * (back - 1))) & _BYTE_OF

    found = _orders(lambda back: np.where(known >= back, byte(back) + np.uint64(1), np.uint64(0)))
    word = np.zeros(len(keys), np.uint64)
    for back in range(1, REACH):
        word += np.where(place >= back, _BYTE[byte(back).view(np.int64)] * _UP[place - back], np.uint64(0))
    found[0] = _mix(word + place.astype(np.uint64))
    before = np.where(place > 0, byte(1).view(np.int64), 256)
    return [found[order] for order in ORDERS], (keys & _BYTE_OF).astype(np.uint8), before


def gram_bits(hashed: list[np.ndarray], keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As :func:`bits_of` for sorted grams; those alike up to a bit are one there, and the first of each is given."""
    data = (keys & _BYTE_OF).astype(np.uint8)
    for bit in range(8):
        upto = keys >> np.uint64(7 - bit)
        first = np.flatnonzero(np.append(True, upto[1:] != upto[:-1]))
        yield *_bit([h[first] for h in hashed], data[first], bit), first


def added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in order, and how often they come."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(times[order], first)


class Gathered:
    """Grams and how often they come, added up once as many new ones have come as there are."""

    def __init__(self):
        self.parts, self.new, self.n = [], 0, 0

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.parts.append((keys, times))
        self.new += len(keys)
        if self.new > max(self.n, 1 << 16):
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        found = added(*map(np.concatenate, zip(*self.parts))) if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.parts, self.new, self.n = [found], 0, len(found[0])
        return found


def gram_table(found: DataFrame) -> DataFrame:
    """``gram, n``: all grams of training texts and how often they come, written once.

    Tasks send theirs in parts; a part is added up by one task, and lies in order. Grams
    that differ in the byte alone are in one part.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("times", pa.binary()), ("n", pa.int64())])
        own = Gathered()

        def sent() -> Iterator[pa.RecordBatch]:
            keys, times = own.merged()
            part = (_mix(keys >> np.uint64(8)) % np.uint64(PARTS)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(PARTS + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                some = order[cuts[p] : cuts[p + 1]]
                packed = {"grams": _packed(np.diff(keys[some], prepend=np.uint64(0))), "times": _packed(times[some])}
                yield pa.RecordBatch.from_pylist([{"part": p, **packed, "n": len(some)}], schema)

        for batch in batches:
            for row in rows_of(batch):
                chunk = Chunk(row)
                held, lengths, tokens, _ = _texts_of(row)
                tokens, lengths = tokens[np.repeat(~held, lengths)], lengths[~held]
                openings, begins = Openings(chunk.letters, chunk.ends), beginnings(lengths)
                for low in range(0, len(tokens), GRAM_TOKENS):
                    some = tokens[low : low + GRAM_TOKENS]
                    for _, keys in openings.grams(some, openings.before(tokens, begins, low, low + len(some))):
                        own.add(*np.unique(keys, return_counts=True))
                if own.n + own.new > GRAMS:
                    yield from sent()
                    own = Gathered()
        yield from sent()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {}
        for batch in batches:
            for row in rows_of(batch):
                keys = np.cumsum(_unpacked(row["grams"], np.uint64, row["n"]), dtype=np.uint64)
                parts.setdefault(row["part"], Gathered()).add(keys, _unpacked(row["times"], np.int64, row["n"]))
        for own in parts.values():
            keys, times = own.merged()
            yield from _in_rows(pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], ["gram", "n"]))

    rows = found.select("words", "word_lengths", "chunk", "held", "lengths", "tokens", "buckets")
    sent = rows.mapInArrow(send, "part int, grams binary, times binary, n long")
    return stored(sent.repartition("part").mapInArrow(merge, "gram long, n long"), "grams", "zstd")


def _gram_blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some rows of :func:`gram_table` at a time."""
    for low in range(0, batch.num_rows, BLOCK):
        some = batch.slice(low, BLOCK)
        yield some.column(0).to_numpy().view(np.uint64), some.column(1).to_numpy()


def nodes(data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes up to which neighbouring words are alike are one node: that of each byte, and a byte of each.

    All that is known of a bit is the same in one node, so it is worked out once.
    """
    starts = np.flatnonzero(place == 0)
    word = np.cumsum(place == 0) - 1
    before = np.append(-1, starts[:-1])[word]
    length = np.append(0, np.diff(starts))[word]
    alike = (place < length) & (data == data[np.where(place < length, before + place, 0)])
    differs = np.minimum.reduceat(np.where(alike, len(data), place), starts)
    new = place >= differs[word]
    order = np.argsort(place.astype(np.uint16) if len(data) < 1 << 16 else place, kind="stable")
    node = np.empty(len(data), np.int64)
    node[order] = np.cumsum(new[order]) - 1
    return node, order[new[order]]


def _bit(hashed: list[np.ndarray], data: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """One bit of all bytes: the slot in every context's table, and the bit."""
    node = ((1 << bit) | (data.astype(np.uint64) >> np.uint64(8 - bit))) * _NODE
    slots = np.empty((len(ORDERS), len(data)), np.int64)
    for i, context in enumerate(hashed):
        slots[i] = (((context + node) * _SLOT) >> np.uint64(64 - SLOT_BITS[i])).view(np.int64) + STARTS[i]
    return slots, (data >> (7 - bit)) & 1


def bits_of(data: np.ndarray, place: np.ndarray, chosen: np.ndarray | None = None, known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight bits of all bytes, or chosen ones: the slot in every context's table, and the bit."""
    hashed = contexts(data, place, known)
    if chosen is not None:
        hashed, data = [h[chosen] for h in hashed], data[chosen]
    for bit in range(8):
        yield _bit(hashed, data, bit)


def bit_counts(words: DataFrame, classes: int, found: DataFrame | None = None) -> np.ndarray:
    """How often each slot's bit was 0 and 1 in all training texts: slots x 2.

    Every task counts into tables of fixed size and sends them once, in parts; the parts
    are added up before they reach the driver, whose result has the size of one model.
    ``found`` are the grams of the texts, beside which words count from their byte REACH on;
    without it every word is the first of a text.
    """
    deep = 0 if found is None else REACH
    size = -(-2 * int(STARTS[-1]) // PARTS)
    schema = pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            letters, ends = _letters(batch.column(0))
            weight = sum(batch.column(1 + k).to_numpy() for k in range(classes))
            for low, high, data, place in blocks(letters, ends):
                node, chosen = nodes(data, place)
                each = np.repeat(weight[low:high], np.diff(np.append(0, ends)[low : high + 1]) + 1)
                each = np.bincount(node, each).astype(np.int64)
                some = place[chosen] >= deep
                yield each[some], bits_of, (data, place, chosen[some])

    def of_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for keys, each in _gram_blocks(batch):
                yield each, gram_bits, (gram_contexts(keys)[0], keys)

    def counting(bits_from):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, held = np.zeros(size * PARTS, np.uint32), 0

            def sent() -> Iterator[pa.RecordBatch]:
                for part in range(PARTS):
                    values = total[part * size : (part + 1) * size]
                    if values.any():
                        yield pa.RecordBatch.from_pylist([{"part": part, "counts": _packed(values.astype(np.int64))}], schema)

            for each, bits, of in bits_from(batches):
                # No slot holds more than all bytes that were counted. What 32 bits cannot hold is split.
                while len(each):
                    step = np.minimum(each, (1 << 31) // len(each))
                    if held + int(step.sum()) >= 1 << 32:
                        yield from sent()
                        total[:], held = 0, 0
                    held += int(step.sum())
                    step = step.astype(np.uint32)
                    for slots, bit, *first in bits(*of):
                        times = np.add.reduceat(step, *first) if first else step
                        for row_slots in slots:
                            np.add.at(total, 2 * row_slots + bit, times)
                    each = each - step
                    if not each.any():
                        break
            yield from sent()

        return count

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for row in rows_of(batch):
                if row["part"] not in sums:
                    sums[row["part"]] = np.zeros(size, np.int64)
                sums[row["part"]] += _unpacked(row["counts"], np.int64, size)
        for part, values in sums.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "counts": _packed(values.astype(np.float32))}], schema)

    names = [f"n{k}" for k in range(classes)]
    seen = words.where(" + ".join(names) + " > 0").select("word", *names)
    sent = seen.mapInArrow(counting(of_words), "part int, counts binary")
    if found is not None:
        sent = sent.unionAll(found.mapInArrow(counting(of_grams), "part int, counts binary"))
    total = np.zeros(size * PARTS, np.float32)
    for row in sent.repartition(PARTS, "part").mapInArrow(add, "part int, counts binary").collect():
        total[row["part"] * size : (row["part"] + 1) * size] = _unpacked(bytes(row["counts"]), np.float32, size)
    return total[: 2 * int(STARTS[-1])].reshape(-1, 2)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.3) / (zeros + 0.3))


def gate_of(known: np.ndarray) -> np.ndarray:
    """Which weights count: by the level (0 to 3) at which each of the three longest contexts is known."""
    return known[-1] * 16 + known[-2] * 4 + known[-3]


GATES = 64


def level_of(total: np.ndarray) -> np.ndarray:
    return (total > 0).astype(np.int8) + (total > 3) + (total > 50)


class Mixer:
    """Gated weights and the learned correction; plain arrays inside."""

    def __init__(self, weights: np.ndarray | None = None, curve: np.ndarray | None = None):
        self.weights = np.full((GATES, len(ORDERS)), 0.25, np.float32) if weights is None else weights
        start = _squash(np.linspace(-8, 8, LEVELS)).astype(np.float32)
        self.curve = np.tile(start, (257, 1)) if curve is None else curve

    def mixed(self, stretch: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(stretch.shape[1], np.float32)
        for i in range(len(ORDERS)):
            total += self.weights[gate, i] * stretch[i]
        return np.clip(total, -11, 11)

    def refined(self, x: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of a 1, and the two points of the curve between which ``x`` lies."""
        spot = (np.clip(x, -7.999, 7.999) + 8) * ((LEVELS - 1) / 16)
        low = spot.astype(np.int64)
        part = (spot - low).astype(np.float32)
        at = last * LEVELS + low
        flat = self.curve.ravel()
        corrected = flat[at] * (1 - part) + flat[at + 1] * part
        return np.clip((_squash(x) + corrected) / 2, 1e-5, 1 - 1e-5), at, part

    def step(self, sums: FitSums) -> None:
        """A Newton step of the weights: the gradient of all bits over their curvature."""
        for g in range(GATES):
            step = np.linalg.solve(sums.curvature[g] + 20 * np.eye(len(ORDERS)), sums.gradient[g])
            self.weights[g] += np.clip(step, -0.5, 0.5).astype(np.float32)

    def bend(self, sums: FitSums) -> None:
        """The curve moves towards what came."""
        flat = self.curve.reshape(-1)
        flat += (sums.n / (sums.n + 300) * (sums.came / np.maximum(sums.n, 1) - flat)).astype(np.float32)


class FitSums:
    """What a round learns from: sums over bits, which tasks take and the driver adds up."""

    def __init__(self):
        self.gradient = np.zeros((GATES, len(ORDERS)))
        self.curvature = np.zeros((GATES, len(ORDERS), len(ORDERS)))
        self.came = np.zeros(257 * LEVELS)
        self.n = np.zeros(257 * LEVELS)
        # Occurrences by the log ratio of the word's share to its cost.
        self.ratios = np.zeros(int(2 * RATIO_MOST / RATIO_STEP) + 1)

    def parts(self) -> list[np.ndarray]:
        return [self.gradient, self.curvature, self.came, self.n, self.ratios]

    def packed(self) -> bytes:
        return _packed(np.concatenate([p.ravel() for p in self.parts()]))

    def add(self, data: bytes) -> None:
        values = _unpacked(data, np.float64, sum(p.size for p in self.parts()))
        for part in self.parts():
            part += values[: part.size].reshape(part.shape)
            values = values[part.size :]


def without_one(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretched probability and level of every slot without one occurrence of the bit: at 2 * slot + bit."""
    stretch, levels = np.empty(table.shape, np.float16), np.empty(table.shape, np.int8)
    for low in range(0, len(table), 1 << 20):
        some = slice(low, low + (1 << 20))
        for bit in range(2):
            own, other = np.maximum(table[some, bit] - 1, 0), table[some, 1 - bit]
            stretch[some, bit] = _stretched(*((own, other) if bit == 0 else (other, own)))
            levels[some, bit] = level_of(own + other)
    return stretch.ravel(), levels.ravel()


def _learn(
    sums: FitSums, mixer: Mixer, table: tuple[np.ndarray, np.ndarray], slots: np.ndarray, bit: np.ndarray, last: np.ndarray, weight: np.ndarray, last_round: bool
) -> np.ndarray | None:
    """Adds what one bit of some bytes teaches; its log probabilities in the last round."""
    slots = 2 * slots + bit
    gate = gate_of(table[1][slots[-3:]]).astype(np.int64)
    stretch = table[0][slots].astype(np.float32)
    x = mixer.mixed(stretch, gate)
    p = _squash(x)
    if last_round:
        _, at, part = mixer.refined(x, last)
        spot = at + (part >= 0.5)
        sums.came += np.bincount(spot, weight * bit, sums.n.size)
        sums.n += np.bincount(spot, weight, sums.n.size)
        return np.log(np.where(bit == 1, p, 1 - p))
    order = np.argsort(gate.astype(np.uint8), kind="stable")
    ranked, inputs = gate[order], stretch[:, order].astype(np.float64)
    cuts = np.append(np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])), len(ranked))
    pull, bend = (weight * (bit - p))[order], (weight * p * (1 - p))[order]
    for a, b in zip(cuts, cuts[1:]):
        some = inputs[:, a:b]
        sums.gradient[ranked[a]] += some @ pull[a:b]
        sums.curvature[ranked[a]] += (some * bend[a:b]) @ some.T
    return None


def fit_sums(
    sums: FitSums, mixer: Mixer, table: tuple[np.ndarray, np.ndarray], letters: np.ndarray, ends: np.ndarray, times: np.ndarray, last_round: bool, deep: int = 0
) -> np.ndarray:
    """Adds what words teach from their byte ``deep`` on, given how often they come; in the last round log probabilities of the words.

    ``table`` is that of :func:`without_one`: each word is predicted from the counts without
    one of its own occurrences, what the model would say of it had it not been seen. The last round looks at the curve alone,
    the others at the weights. The probabilities are those of whole words, each as the first of a text.
    """
    bounds = np.append(0, ends)
    costs = np.zeros(len(ends))
    for low, high, data, place in blocks(letters, ends):
        weight = np.repeat(times[low:high], np.diff(bounds[low : high + 1]) + 1).astype(np.float64)
        node, chosen = nodes(data, place)
        weight = np.where(place[chosen] >= deep, np.bincount(node, weight), 0)
        if not last_round:
            chosen, weight = chosen[weight > 0], weight[weight > 0]
            if not len(chosen):
                continue
        last = np.where(place > 0, np.append(0, data[:-1]), 256).astype(np.int64)[chosen]
        total = np.zeros(len(chosen))
        for slots, bit in bits_of(data, place, chosen):
            found = _learn(sums, mixer, table, slots, bit, last, weight, last_round)
            if last_round:
                total += found
        if last_round:
            costs[low:high] = np.add.reduceat(total[node], bounds[low:high] - bounds[low] + np.arange(high - low))
    return costs


def gram_fit_sums(sums: FitSums, mixer: Mixer, table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, times: np.ndarray, last_round: bool) -> None:
    """As :func:`fit_sums` for sorted grams."""
    hashed, _, last = gram_contexts(keys)
    for slots, bit, first in gram_bits(hashed, keys):
        _learn(sums, mixer, table, slots, bit, last[first], np.add.reduceat(times, first).astype(np.float64), last_round)


def _fit_rounds(mixer: Mixer, rounds: int, summed) -> FitSums:
    """Learns weights, then the curve, from ``summed(mixer, last_round)``; the sums of the last round."""
    for _ in range(rounds):
        mixer.step(summed(mixer, False))
    sums = summed(mixer, True)
    mixer.bend(sums)
    return sums


def fitted(
    table: np.ndarray, letters: np.ndarray, ends: np.ndarray, times: np.ndarray, rounds: int = ROUNDS
) -> tuple[Mixer, FitSums]:
    """Mixer learned from words and how often they come, in one process."""

    def summed(mixer: Mixer, last_round: bool) -> FitSums:
        sums = FitSums()
        fit_sums(sums, mixer, one_less, letters, ends, times, last_round)
        return sums

    one_less = without_one(table)
    mixer = Mixer()
    return mixer, _fit_rounds(mixer, rounds, summed)


def fit(words: DataFrame, table: np.ndarray, sizes: np.ndarray, rounds: int = ROUNDS, found: DataFrame | None = None) -> tuple[Mixer, float]:
    """Mixer learned from all words of training texts, and the weight of whole words against their bits.

    ``found`` are the grams of the texts, as in :func:`bit_counts`.
    """
    deep = 0 if found is None else REACH
    classes = len(sizes)
    names = [f"n{k}" for k in range(classes)]
    seen = words.where(" + ".join(names) + " > 0").select("word", *names)
    sent = words.sparkSession.sparkContext.broadcast(without_one(table))

    def summed(mixer: Mixer, last_round: bool) -> FitSums:
        weights, curve = mixer.weights, mixer.curve

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, now, any_word = FitSums(), Mixer(weights, curve), False
            for batch in batches:
                any_word = any_word or batch.num_rows > 0
                counts = np.stack([batch.column(1 + k).to_numpy() for k in range(classes)])
                times = counts.sum(axis=0)
                costs = fit_sums(sums, now, sent.value, *_letters(batch.column(0)), times, last_round, deep)
                if last_round:
                    # Without one own occurrence, as the bits are predicted.
                    share = (word_shares(np.maximum(counts - 1, 0), sizes) * counts / times).sum(axis=0)
                    with np.errstate(divide="ignore"):
                        ratio = np.clip(np.log(share) - costs, -RATIO_MOST, RATIO_MOST)
                    place = np.rint((ratio + RATIO_MOST) / RATIO_STEP).astype(np.int64)
                    sums.ratios += np.bincount(place, times, len(sums.ratios))
            if any_word:
                yield pa.RecordBatch.from_pylist([{"sums": sums.packed()}])

        def run_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, now, any_gram = FitSums(), Mixer(weights, curve), False
            for batch in batches:
                for keys, times in _gram_blocks(batch):
                    gram_fit_sums(sums, now, sent.value, keys, times, last_round)
                    any_gram = True
            if any_gram:
                yield pa.RecordBatch.from_pylist([{"sums": sums.packed()}])

        sums = seen.mapInArrow(run, "sums binary")
        if found is not None:
            sums = sums.unionAll(found.mapInArrow(run_grams, "sums binary"))
        total = FitSums()
        for r in sums.collect():
            total.add(bytes(r["sums"]))
        return total

    mixer = Mixer()
    sums = _fit_rounds(mixer, rounds, summed)
    sent.unpersist()
    ratio = np.exp(np.arange(len(sums.ratios)) * RATIO_STEP - RATIO_MOST)
    return mixer, best_share(ratio, np.ones(len(ratio)), sums.ratios) if sums.ratios.any() else 0.0


def compact(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What scoring needs of the counts: stretched probability and level of every slot."""
    stretch = _stretched(table[:, 0], table[:, 1]).astype(np.float16)
    return stretch, level_of(table.sum(axis=1)).astype(np.int8)


def _cost(model: dict, mixer: Mixer, slots: np.ndarray, bit: np.ndarray, last: np.ndarray) -> np.ndarray:
    gate = gate_of(model["levels"][slots[-3:]]).astype(np.int64)
    p, _, _ = mixer.refined(mixer.mixed(model["stretch"][slots].astype(np.float32), gate), last)
    return np.log(np.where(bit == 1, p, 1 - p))


def word_costs(model: dict, letters: np.ndarray, ends: np.ndarray, deep: int = 0) -> np.ndarray:
    """Natural log of the probability of each word, by its bits, from byte ``deep`` of the word on."""
    mixer = Mixer(model["weights"], model["curve"])
    out = np.zeros(len(ends))
    bounds = np.append(0, ends)
    for low, high, data, place in blocks(letters, ends):
        node, chosen = nodes(data, place)
        some = place[chosen] >= deep
        chosen = chosen[some]
        last = np.where(place > 0, np.append(0, data[:-1]), 256).astype(np.int64)[chosen]
        total = np.zeros(len(some))
        for slots, bit in bits_of(data, place, chosen):
            total[some] += _cost(model, mixer, slots, bit, last)
        starts = bounds[low:high] - bounds[low] + np.arange(high - low)
        out[low:high] = np.add.reduceat(total[node], starts)
    return out


def gram_costs(model: dict, mixer: Mixer, keys: np.ndarray) -> np.ndarray:
    """Natural log of the probability of the byte of each of some sorted grams."""
    out = np.zeros(len(keys))
    for low in range(0, len(keys), BLOCK):
        some = keys[low : low + BLOCK]
        hashed, _, last = gram_contexts(some)
        for slots, bit, first in gram_bits(hashed, some):
            found = _cost(model, mixer, slots, bit, last[first])
            out[low : low + BLOCK] += np.repeat(found, np.diff(np.append(first, len(some))))
    return out


def frequent_costs(found: DataFrame, sent) -> tuple[np.ndarray, np.ndarray]:
    """Frequent grams in order, FREQUENT at most, and what :func:`gram_costs` gives for them by the model in ``sent``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        mixer = Mixer(model["weights"], model["curve"])
        for batch in batches:
            keys = np.sort(batch.column(0).to_numpy().view(np.uint64))
            costs = gram_costs(model, mixer, keys).astype(np.float32)
            yield pa.RecordBatch.from_pylist([{"n": len(keys), "grams": _packed(keys), "costs": _packed(costs)}])

    rows = found.groupBy(F.floor(F.log2("n")).alias("level")).count().collect()
    least, n = 64, 0
    for row in sorted(rows, key=lambda r: -r["level"]):
        n += row["count"]
        if n > FREQUENT:
            break
        least = row["level"]
    rows = found.where(F.floor(F.log2("n")) >= least).select("gram").mapInArrow(run, "n long, grams binary, costs binary").collect()
    keys = np.concatenate([np.zeros(0, np.uint64), *[_unpacked(bytes(r["grams"]), np.uint64, r["n"]) for r in rows]])
    costs = np.concatenate([np.zeros(0, np.float32), *[_unpacked(bytes(r["costs"]), np.float32, r["n"]) for r in rows]])
    order = np.argsort(keys)
    return keys[order], costs[order]


def token_costs(
    model: dict, letters: np.ndarray, ends: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, frequent: tuple[np.ndarray, np.ndarray] | None = None
) -> np.ndarray:
    """Natural log of the probability of the first REACH bytes of each token, given the text before it.

    ``frequent`` is that of :func:`frequent_costs`; other grams are predicted here.
    """
    mixer = Mixer(model["weights"], model["curve"])
    out = np.zeros(len(tokens), np.float32)
    openings, begins = Openings(letters, ends), beginnings(lengths)
    for low in range(0, len(tokens), GRAM_TOKENS):
        high = min(low + GRAM_TOKENS, len(tokens))
        for index, keys in openings.grams(tokens[low:high], openings.before(tokens, begins, low, high)):
            distinct, at = numbered(keys)
            order = np.argsort(distinct)
            cost = np.empty(len(order), np.float32)
            if frequent is not None and len(frequent[0]):
                place = np.minimum(np.searchsorted(frequent[0], distinct[order]), len(frequent[0]) - 1)
                there = frequent[0][place] == distinct[order]
                cost[order[there]] = frequent[1][place[there]]
                order = order[~there]
            cost[order] = gram_costs(model, mixer, distinct[order])
            out[low + index] += cost[at]
    return out


def word_shares(counts: np.ndarray, sizes: np.ndarray, smooth: float = 1000.0) -> np.ndarray:
    """Share of each word in each class's training tokens, smoothed by its share in all."""
    whole = counts.sum(axis=0) / max(sizes.sum(), 1)
    return (counts + smooth * whole) / (sizes[:, None] + smooth)


def best_share(first: np.ndarray, second: np.ndarray, times: np.ndarray, rounds: int = 20) -> float:
    """Weight of ``first`` in the mixture of two probabilities that makes what came likeliest."""
    weight = 0.5
    for _ in range(rounds):
        both = weight * first + (1 - weight) * second + 1e-300
        weight = float((times * weight * first / both).sum() / max(times.sum(), 1))
    return min(max(weight, 0.001), 0.999)


def recent(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Share of each token among the tokens before it in its text."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key = doc * (int(tokens.max(initial=0)) + 1) + tokens
    bits = len(tokens).bit_length()
    if int(key.max(initial=0)).bit_length() + bits < 63:
        # Numbers sort faster than places.
        ranked = np.sort(key << bits | np.arange(len(key)))
        order, ranked = ranked & ((1 << bits) - 1), ranked >> bits
    else:
        order = np.argsort(key, kind="stable")
        ranked = key[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, int)
    seen = np.empty(len(tokens), np.int64)
    seen[order] = np.arange(len(tokens)) - np.repeat(first, np.diff(np.append(first, len(tokens))))
    return seen / np.maximum(place, 1)


def _texts(tokens: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Tokens and lengths of some texts at a time, so that what is worked out of them stays small."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        begin = ends[at] - lengths[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + TOKENS, "right")))
        yield tokens[begin : ends[stop - 1]], lengths[at:stop], stop - at
        at = stop


def repeats(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens that their text had before, their texts, and the logarithm of their share in the text so far."""
    again = recent(tokens, lengths)
    had = np.flatnonzero(again > 0)
    return had, np.repeat(np.arange(len(lengths)), lengths)[had], np.log(again[had])


def text_costs(fresh: np.ndarray, repeated: tuple[np.ndarray, np.ndarray, np.ndarray], lengths: np.ndarray) -> list[np.ndarray]:
    """Log probability of each text by share of repeated words, from those of its tokens and its :func:`repeats`."""
    plain = np.add.reduceat(fresh, np.cumsum(lengths) - lengths)
    had, doc, again = repeated
    ratio = again - fresh[had]
    # So large a ratio alone is left of the sum.
    over = np.maximum(ratio - 500, 0)
    times = np.exp(ratio - over)
    return [
        plain + (lengths - 1) * np.log1p(-cache) + np.bincount(doc, np.log1p(times * (cache / (1 - cache))) + over, len(lengths))
        for cache in CACHES
    ]


def either(share: np.ndarray, spelled: np.ndarray, plain: np.ndarray, small: np.ndarray, weight: float) -> np.ndarray:
    """Log probability of words that are whole ones with some weight, else spelled.

    ``spelled`` is the logarithm of the probability ``plain``; where it is ``small``, the sum is taken of logarithms.
    """
    out = weight * share + (1 - weight) * plain
    out[small] = 1
    out = np.log(out)
    with np.errstate(divide="ignore"):
        out[small] = np.logaddexp(np.log(weight * share[small]), np.log1p(-weight) + spelled[small])
    return out


def scored(docs: DataFrame, classes: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts under a model learned from those that are not held out.

    One row per input row: ``held_out``; ``n_tokens`` words and the end; ``n_known`` of them
    in training texts; ``train_tokens``; ``base_score``, log10 probability by smoothed
    counts of single tokens; ``score``, log10 probability by the model; ``bits_per_byte``,
    its cost over the bytes of words and one more for each token. Null texts are empty and
    have the end alone; repeated rows count each time they come; null ids count as empty
    ones; other columns are ignored. Counts, classes and weights come from all training texts.
    An empty table gives no rows; without training texts all words are spelled.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        held_out(docs[doc_id]).alias("held"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    with small_batches(spark, BATCH_BYTES):
        found = chunks(rows)
        shares, docs_of = class_shares(found, classes)
        words = word_table(found, shares)
        near = gram_table(found)
    prior = np.log((docs_of + 0.5) / (docs_of.sum() + 0.5 * classes))
    names = [f"n{k}" for k in range(classes)]
    seen = F.expr(" + ".join(names) + " > 0")
    sums = words.agg(F.count_if(seen).alias("v"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    sizes = np.array([sums[n] for n in names], np.float64)
    n_train, v = int(sizes.sum()), sums["v"]

    table = bit_counts(words, classes, near)
    mixer, dictionary = fit(words, table, sizes, found=near)
    stretch, levels = compact(table)
    model = {"weights": mixer.weights, "curve": mixer.curve, "stretch": stretch, "levels": levels, "dictionary": dictionary}
    del table
    sent = spark.sparkContext.broadcast(model)
    frequent = spark.sparkContext.broadcast(frequent_costs(near, sent))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            costs = word_costs(model, *_letters(batch.column(0)), REACH).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs)], ["word", *names, "cost"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in rows_of(batch):
                chunk = Chunk(row)
                n = len(chunk.ends)
                columns = [_words(chunk.letters, chunk.ends), pa.array(np.full(n, chunk.name, np.int64)), pa.array(np.arange(n, dtype=np.int32))]
                yield from _in_rows(pa.RecordBatch.from_arrays(columns, ["word", "chunk", "i"]))

    def texts_of(doc: dict, counts: np.ndarray, cost: np.ndarray) -> pa.RecordBatch:
        """Scores of a chunk's texts, given its words' counts by class and the costs of their bytes from REACH on."""
        lengths = np.frombuffer(doc["lengths"], np.int64)
        size = np.frombuffer(doc["word_lengths"], np.uint32).astype(np.int64) + 1
        tokens = _unpacked(doc["tokens"], np.uint32, int(lengths.sum()))
        chunk = Chunk(doc)
        spelled = token_costs(sent.value, chunk.letters, chunk.ends, tokens, lengths, frequent.value)
        total = counts.sum(axis=0)
        base = np.log10((total + 0.5) / (n_train + 0.5 * (v + 1)))
        shares = word_shares(counts, sizes)
        weights = [sent.value["dictionary"] * part for part in DICTIONARIES]
        found, low = [], 0
        for part, some, n in _texts(tokens, lengths):
            at = np.repeat(np.arange(n), some)
            repeated = repeats(part, some)
            bits = spelled[low : low + len(part)] + cost[part]
            plain, small = np.exp(bits), np.flatnonzero(bits < -400)
            low += len(part)
            each = []
            for k in range(classes):
                share = shares[k][part]
                for weight in weights:
                    fresh = either(share, bits, plain, small, weight)
                    each += [prior[k] + cost_of_text for cost_of_text in text_costs(fresh, repeated, some)]
            likely = np.logaddexp.reduce(each, axis=0) - np.log(len(CACHES) * len(weights))
            found.append(
                (
                    np.bincount(at, (total > 0)[part], n).astype(np.int64),
                    np.bincount(at, base[part], n),
                    likely / np.log(10),
                    -likely / np.log(2) / np.bincount(at, size[part], n),
                )
            )
        columns = [
            pa.array(np.frombuffer(doc["ids"], np.int64), mask=np.frombuffer(doc["no_id"], bool)),
            pa.array(np.frombuffer(doc["held"], bool)),
            pa.array(lengths),
            *[pa.array(np.concatenate(c)) for c in zip(*found)],
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's row comes first, then its words in any order, maybe over several batches."""
        doc = None
        for batch in batches:
            place = batch.column(1).to_numpy()
            heads = set(np.flatnonzero(place < 0).tolist())
            cuts = sorted(heads | {0, len(place)})
            for low, high in zip(cuts, cuts[1:]):
                if low in heads:
                    if doc is not None:
                        yield texts_of(doc, counts, costs)
                    doc = batch.column(3 + classes)[low].as_py()
                    n = len(doc["word_lengths"]) // 4
                    counts, costs = np.zeros((classes, n), np.int64), np.full(n, np.nan)
                    low += 1
                if high > low:
                    *seen, cost = [batch.column(2 + k).slice(low, high - low).to_numpy() for k in range(classes + 1)]
                    at = place[low:high]
                    counts[:, at], costs[at] = np.stack(seen), cost
        if doc is not None:
            yield texts_of(doc, counts, costs)

    spelled = words.mapInArrow(spell, "word binary, " + ", ".join(f"{n} long" for n in names) + ", cost float")
    wanted = found.select("chunk", "words", "word_lengths").mapInArrow(ask, "word binary, chunk long, i int")
    answers = wanted.join(spelled, "word").select("chunk", "i", *names, "cost")
    doc = F.struct("ids", "no_id", "held", "lengths", "tokens", "words", "word_lengths").alias("doc")
    heads = found.select("chunk", F.lit(-1).alias("i"), *[F.lit(0).cast("long").alias(n) for n in names], F.lit(0).cast("float").alias("cost"), doc)
    rows = heads.unionByName(answers, allowMissingColumns=True)
    # One number to sort by, which takes no comparing of rows.
    order = F.col("chunk") * 2 + (F.col("i") >= 0).cast("long")
    scores = rows.repartition("chunk").sortWithinPartitions(order).mapInArrow(score, RESULT)
    return scores.withColumn("train_tokens", F.lit(n_train).cast("long"))
