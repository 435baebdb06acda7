"""Benchmark passages found through a distributed positional inverted index.

The corpus is cut into shards of whole documents. For every shard the index has the
distinct terms and, for each, the ascending positions at which it stands. Phrases are
looked up shard by shard: the postings of a phrase's rarest term, moved back by its place
in the phrase, are intersected with those of its next rarest term, and so on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import IN_TERM, map_batches, row_key, rows_of, stored, texts, word_hashes

WINDOW = 10
# Places that a word of a near match may stand off.
NEAR = 2
# Text of one shard; a longer document is a shard of its own.
SHARD_BYTES = 1 << 20
# Benchmark words that one pass holds; a larger benchmark takes several passes.
BLOCK_WORDS = 200_000
INDEX = (
    "shard string, n_postings long, terms binary, bounds binary, postings binary, "
    "doc_ids binary, doc_null binary, keys binary, starts binary, lengths binary"
)


def words_of(text: bytes | None) -> np.ndarray:
    return word_hashes((text or b"").lower(), IN_TERM)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slop: int = 8) -> DataFrame:
    """Index of all texts, written to the shared folder: one row per shard.

    Positions run through the shard, with a gap between documents that is wider than a
    window with ``slop`` positions to spare, so that nothing matches across documents.
    Terms are 64-bit hashes of lower-case words. Documents without words have a place too.
    """
    gap = WINDOW + slop + 1

    def shard(rows: list[tuple]) -> dict:
        words = [w for _, _, w in rows]
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + gap)[:-1]]).astype(np.int64)
        terms = np.concatenate(words) if rows else np.zeros(0, np.uint64)
        places = np.arange(len(terms)) + np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        order = np.argsort(terms, kind="stable")
        ranked = terms[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, int)
        ids = np.array([0 if i is None else i for i, _, _ in rows], np.int64)
        return {
            "n_postings": len(terms),
            "terms": ranked[first].tobytes(),
            "bounds": np.append(first, len(ranked)).astype(np.uint32).tobytes(),
            "postings": places[order].astype(np.uint32).tobytes(),
            "doc_ids": ids.tobytes(),
            "doc_null": np.array([i is None for i, _, _ in rows]).tobytes(),
            "keys": np.array([k for _, k, _ in rows], np.int64).tobytes(),
            "starts": starts.astype(np.uint32).tobytes(),
            "lengths": lengths.astype(np.uint32).tobytes(),
        }

    schema = pa.schema(
        [("shard", pa.string()), ("n_postings", pa.int64())]
        + [(n.split()[0], pa.binary()) for n in INDEX.split(", ")[2:]]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        rows, held = [], 0

        def out() -> pa.RecordBatch:
            found = shard(rows) | {"shard": f"{task}-{n}"}
            return pa.RecordBatch.from_pylist([found], schema)

        for batch in batches:
            for i, k, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))):
                rows.append((i, k, words_of(value)))
                held += len(value or b"")
                if held >= SHARD_BYTES:
                    yield out()
                    rows, held, n = [], 0, n + 1
        if rows:
            yield out()

    rows = docs.select(docs[doc_id].cast("long").alias("id"), row_key(docs[doc_id], docs[text]).alias("key"), docs[text].alias("text"))
    return stored(rows.mapInArrow(build, INDEX), "index")


def _windows(items: list[tuple], size: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Distinct windows of the items: item, length, terms (a row each, zero-filled)."""
    seen, item, length, terms = set(), [], [], []
    for number, words in items:
        n = min(size, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            window = words[at : at + n]
            if (number, window.tobytes()) not in seen:
                seen.add((number, window.tobytes()))
                item.append(number)
                length.append(n)
                terms.append(np.pad(window, (0, size - n)))
    return item, np.array(length, np.int64), np.array(terms, np.uint64).reshape(-1, size)


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Benchmark items as (id, words), some at a time: hash buckets sized by their words."""
    items = benchmark.select(
        benchmark[item_id].cast("string").alias("item"), F.coalesce(benchmark[text], F.lit("")).alias("text")
    ).distinct()
    items = stored(items, "benchmark")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(1, -(-size // (4 * BLOCK_WORDS)))
    bucket = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    for part in range(parts):
        rows = items.where(bucket == part).collect()
        yield [(r["item"], words_of(r["text"].encode())) for r in rows]


class Shard:
    """One row of the index, as arrays."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.bounds = np.frombuffer(row["bounds"], np.uint32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.uint32).astype(np.int64)

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term's list in this shard, -1 if it has none."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)


def match(
    shard: Shard, vocabulary: np.ndarray, lengths: np.ndarray, number: np.ndarray, order: np.ndarray, slop: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, the positions of their rarest terms, and those of all their words (a row each).

    ``number`` has the windows' terms as places in the sorted ``vocabulary``, ``order`` the
    places of each window from its rarest term. With ``slop`` every other term may stand
    that many places off its place as counted from the rarest one, also before the window's
    start; the nearest posting is its word, the earlier of two. Places behind the end of a
    shorter window have -1.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, number.shape[1]), np.int64)
    size = number.shape[1]
    lists = shard.lists(vocabulary)
    inside = np.arange(size) < lengths[:, None]
    there = (lists[number] >= 0) | ~inside
    alive = np.flatnonzero(there.all(1))
    if not len(alive):
        return none
    # Postings of the benchmark's terms only, keyed by list and position.
    used = np.unique(lists[number[alive]][inside[alive]])
    place = np.full(len(shard.terms), -1)
    place[used] = np.arange(len(used))
    sizes = shard.bounds[used + 1] - shard.bounds[used]
    ends = np.cumsum(sizes)
    own = np.repeat(np.arange(len(used)), sizes)
    positions = shard.postings[np.arange(ends[-1]) - np.repeat(ends - sizes, sizes) + np.repeat(shard.bounds[used], sizes)]
    width = int(positions.max()) + 2 * (size + slop) + 2
    # A place may lie up to a window before the first position.
    keyed = own * width + positions + slop + size

    rarest = order[alive, 0]
    anchor = place[lists[number[alive, rarest]]]
    counts = sizes[anchor]
    window = np.repeat(alive, counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = positions[np.repeat(ends[anchor] - counts, counts) + offset] - np.repeat(rarest, counts)
    for step in range(1, size):
        live = step < lengths[window]
        at = order[window, step]
        wanted = start + at
        ours = place[lists[number[window, at]]]
        low = ours * width + wanted + size
        found = np.searchsorted(keyed, low)
        hit = (keyed[np.minimum(found, len(keyed) - 1)] <= low + 2 * slop) & (found < len(keyed))
        keep = ~live | hit
        window, start = window[keep], start[keep]
        if not len(window):
            return none
    places = np.arange(size)
    hits = np.where(places < lengths[window][:, None], start[:, None] + places, -1)
    for at in range(size if slop else 0):
        live = np.flatnonzero(at < lengths[window])
        target = place[lists[number[window[live], at]]] * width + hits[live, at] + slop + size
        right = np.searchsorted(keyed, target)
        before, after = np.maximum(right - 1, 0), np.minimum(right, len(keyed) - 1)
        nearest = np.where(np.abs(keyed[before] - target) <= np.abs(keyed[after] - target), before, after)
        hits[live, at] = positions[nearest]
    return window, start + order[window, 0], hits


def occurrences(
    index: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, slop: int = 0
) -> DataFrame:
    """Documents in which windows of benchmark items occur: their items and the words hit.

    ``shard, ordinal`` name the document; ``words`` are the places of the words inside
    windows. The benchmark goes through the index in blocks of bounded size, and every
    block takes the corpus frequency of its terms from the index to find the rarest.
    With ``slop`` above 0, at most the index's, a window also matches where its terms stand
    that many places off; it belongs to the document that holds its rarest term. Items and
    words of windows that stand there exactly are then in ``exact_items, exact_words`` too.
    """
    schema = "shard string, ordinal int, items array<string>, words array<int>"
    if slop:
        schema += ", exact_items array<string>, exact_words array<int>"
    spark = index.sparkSession
    parts = []
    for items in _blocks(benchmark, item_id, text):
        names, lengths, terms = _windows(items, window)
        if not names:
            continue
        vocabulary, number = np.unique(terms, return_inverse=True)
        number = number.reshape(terms.shape).astype(np.int32)

        def counts(batch: pa.RecordBatch, vocabulary=vocabulary) -> pa.RecordBatch:
            total = np.zeros(len(vocabulary), np.int64)
            for row in rows_of(batch):
                found = np.frombuffer(row["terms"], np.uint64)
                size = np.diff(np.frombuffer(row["bounds"], np.uint32).astype(np.int64))
                _, a, b = np.intersect1d(vocabulary, found, assume_unique=True, return_indices=True)
                total[a] += size[b]
            used = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["term", "n"])

        found = map_batches(index.select("terms", "bounds"), counts, "term long, n long")
        # At most one row per word of the block.
        frequency = np.zeros(len(vocabulary), np.int64)
        for row in found.groupBy("term").agg(F.sum("n").alias("n")).collect():
            frequency[row["term"]] = row["n"]
        rank = frequency[number].astype(np.float64)
        rank[np.arange(window) >= lengths[:, None]] = np.inf
        order = np.argsort(rank, axis=1, kind="stable").astype(np.uint8)
        # Windows with a term the corpus does not have cannot occur.
        some = rank[np.arange(len(rank)), order[:, 0]] > 0
        names = [names[i] for i in np.flatnonzero(some)]
        block = spark.sparkContext.broadcast((names, vocabulary, lengths[some], number[some], order[some]))

        def look(batch: pa.RecordBatch, block=block) -> pa.RecordBatch:
            item, vocabulary, length, number, ranked = block.value
            out = {name.split()[0]: [] for name in schema.split(", ")}
            for row in rows_of(batch):
                windows, anchors, hits = match(Shard(row), vocabulary, length, number, ranked, slop)
                if not len(windows):
                    continue
                base = np.frombuffer(row["starts"], np.uint32).astype(np.int64)
                doc = np.searchsorted(base, anchors, "right") - 1
                by_doc = np.argsort(doc, kind="stable")
                cuts = np.flatnonzero(np.diff(doc[by_doc])) + 1
                for group in np.split(by_doc, cuts):
                    d = doc[group[0]]
                    out["shard"].append(row["shard"])
                    out["ordinal"].append(int(d))
                    some = {"": group}
                    if slop:
                        places = hits[group, :1] + np.arange(hits.shape[1])
                        some["exact_"] = group[((hits[group] == places) | (hits[group] < 0)).all(1)]
                    for name, these in some.items():
                        words = np.unique(hits[these])
                        out[name + "items"].append(list({item[w] for w in windows[these].tolist()}))
                        out[name + "words"].append((words[words >= 0] - base[d]).tolist())
            lists = [pa.list_(pa.string()), pa.list_(pa.int32())]
            kinds = [pa.string(), pa.int32(), *lists * (2 if slop else 1)]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))

        columns = index.select("shard", "terms", "bounds", "postings", "starts", "lengths")
        parts.append(map_batches(columns, look, schema))
    if not parts:
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    if len(parts) == 1:
        return whole
    # What the blocks found in one document; never more than its words and their items.
    return whole.groupBy("shard", "ordinal").agg(
        *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in whole.columns[2:]]
    )


def documents_of(index: DataFrame) -> DataFrame:
    """The documents of an index: ``shard, ordinal, doc_id, key, n_words``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in rows_of(batch):
            ids = np.frombuffer(row["doc_ids"], np.int64)
            n = len(ids)
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(ids, mask=np.frombuffer(row["doc_null"], bool)),
                        pa.array(np.frombuffer(row["keys"], np.int64)),
                        pa.array(np.frombuffer(row["lengths"], np.uint32).astype(np.int64)),
                    ],
                    ["shard", "ordinal", "doc_id", "key", "n_words"],
                )
            )
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    columns = index.select("shard", "doc_ids", "doc_null", "keys", "lengths")
    return map_batches(columns, run, "shard string, ordinal int, doc_id long, key long, n_words long")


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Words of every document that stand inside benchmark windows, and the items they are of.

    One row per input row. Null and empty texts have no words and hit nothing; an item
    without words has no window; an empty benchmark hits nothing. Items that share an id
    count once; a null item id counts as an item but has no name to be listed.
    """
    index = build_index(docs, doc_id, text)
    found = occurrences(index, benchmark, item_id, item_text)
    columns = _counted("n_hit", "n_items", "items_sha256", "contaminated")
    return documents_of(index).join(found, ["shard", "ordinal"], "left").select("doc_id", "key", "n_words", *columns)


def near_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slop: int = NEAR,
) -> DataFrame:
    """``contamination`` with the same counts for near matches, which include the exact ones.

    ``slop`` is 1 or more.
    """
    index = build_index(docs, doc_id, text, slop)
    found = occurrences(index, benchmark, item_id, item_text, slop=slop)
    exact = _counted("n_hit", "n_items", "items_sha256", "contaminated", "exact_")
    near = _counted("n_near", "n_near_items", "near_items_sha256", "near")
    rows = documents_of(index).join(found, ["shard", "ordinal"], "left")
    return rows.select("doc_id", "key", "n_words", *exact, *near)


def _counted(n_words: str, n_items: str, digest: str, any_hit: str, kind: str = "") -> list[Column]:
    """Numbers of words and items hit, and the items' names, under the given column names."""
    words, items = f"{kind}words", f"{kind}items"
    named = F.array_sort(F.filter(items, lambda x: x.isNotNull()))
    return [
        F.coalesce(F.array_size(words), F.lit(0)).cast("long").alias(n_words),
        F.coalesce(F.array_size(items), F.lit(0)).cast("long").alias(n_items),
        F.sha2(F.coalesce(F.concat_ws(",", named), F.lit("")), 256).alias(digest),
        F.coalesce(F.array_size(words) > 0, F.lit(False)).alias(any_hit),
    ]


def without_benchmark(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` with no benchmark window in their text, all columns as they were."""
    index = build_index(docs, doc_id, text)
    bad = documents_of(index).join(occurrences(index, benchmark), ["shard", "ordinal"], "left_semi")
    keyed = docs.withColumn("__key", row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    keys = bad.select(F.col("key").alias("__key")).distinct()
    return keyed.join(keys, "__key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
