"""Context mixing: base columns by brute force, probabilities that add up, held-out accuracy, edge cases."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from sitrep.llm import ctxmix
from sitrep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, held boolean, chunk string, score int"


def tokens_of(text):
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(plain) + [""]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def base_of(rows):
    """held_out, n_tokens, n_known, train_tokens, base_score of (id, text) rows."""
    counts = collections.Counter(t for i, text in rows if not is_held(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        found = [counts[t] for t in tokens_of(text)]
        score = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in found)
        out.append((i, is_held(i), len(found), sum(c > 0 for c in found), n, score))
    return out, counts


def rows_like(found):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in found), key=repr)


def test_base_and_held_out_accuracy(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in QUERIES["op11_scores"](spark, SF).collect()}
    base, counts = base_of(docs)
    assert len(found) == len(docs)
    for i, held, n, known, train, score in base:
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        size = sum(len(t.encode()) + 1 for t in tokens_of(dict(docs)[i]))
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / size, rel=1e-9)
    # A proper model of single words: unseen ones are spelled by the frequency of bytes.
    letters = collections.Counter(b for t, c in counts.items() for b in (t + " ").encode() * min(c, 50))
    total = sum(letters.values())
    n, v = sum(counts.values()), len(counts)
    plain = 0.0
    for i, text in docs:
        if is_held(i):
            for t in tokens_of(text):
                if counts[t]:
                    plain += math.log10((counts[t] - 0.4) / n)
                else:
                    plain += math.log10(0.4 * v / n) + sum(math.log10((letters[b] + 1) / (total + 256)) for b in (t + " ").encode())
    assert sum(r.score for r in found.values() if r.held_out) > 0.97 * plain


def model_of(rows, classes=2):
    import pyarrow as pa

    letters, ends, tokens, lengths = ctxmix.tokenized(pa.array(rows))
    times = np.bincount(tokens, minlength=len(ends))
    table = np.zeros((int(ctxmix.STARTS[-1]), 2), np.float32)
    for low, high, data, place in ctxmix.blocks(letters, ends):
        each = np.repeat(times[low:high], np.diff(np.append(0, ends)[low : high + 1]) + 1)
        for slots, bit in ctxmix.bits_of(data, place):
            for row in slots:
                np.add.at(table, (row, bit), each)
    mixer, _ = ctxmix.fitted(table, letters, ends, times)
    stretch, levels = ctxmix.compact(table)
    return {"weights": mixer.weights, "curve": mixer.curve, "stretch": stretch, "levels": levels}


@pytest.mark.parametrize("prefix", [b"", b"th", b"zz", "é".encode()])
def test_probabilities_of_the_next_byte_add_up(prefix):
    """Over all next bytes, whatever the counts are: words with a given start share its probability."""
    model = model_of(["the then there their a an and", "than thaw the the", "zzz été"])

    def costs(words):
        return ctxmix.word_costs(model, np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words]))

    # A word's cost is that of its bytes and of the blank; continuing words drop the blank.
    def start(word):
        data = np.frombuffer(word + b" ", np.uint8)
        mixer = ctxmix.Mixer(model["weights"], model["curve"])
        place = np.arange(len(data))
        last = np.where(place > 0, np.append(0, data[:-1]), 256).astype(np.int64)
        total = np.zeros(len(data))
        for slots, bit in ctxmix.bits_of(data, place):
            gate = ctxmix.gate_of(model["levels"][slots]).astype(np.int64)
            p, _, _ = mixer.refined(mixer.mixed(model["stretch"][slots].astype(np.float32), gate), last)
            total += np.log(np.where(bit == 1, p, 1 - p))
        return total

    assert start(prefix + b"x").sum() == pytest.approx(costs([prefix + b"x"])[0])
    at = len(prefix)
    assert sum(math.exp(start(prefix + bytes([b]))[at]) for b in range(256)) == pytest.approx(1)


def test_document_cache_by_brute_force():
    rng = np.random.default_rng(4)
    lengths = np.array([5, 1, 40, 3])
    tokens = rng.integers(0, 4, lengths.sum()).astype(np.uint32)
    found = ctxmix.recent(tokens, lengths)
    at = 0
    for n in lengths:
        text = tokens[at : at + n].tolist()
        expected = [text[:i].count(t) / max(i, 1) for i, t in enumerate(text)]
        assert found[at : at + n].tolist() == expected
        at += n


def test_classes_follow_the_words():
    rng = np.random.default_rng(1)
    samples = [(rng.integers(200 * (i % 3), 200 * (i % 3) + 100, 80), np.ones(80)) for i in range(60)]
    shares = ctxmix.class_model(samples, 3)
    member = [int(np.argmax([s[b].sum() for s in shares])) for b, _ in samples]
    assert len(set(member)) == 3 and all(member[i] == member[i % 3] for i in range(60))


EDGES = [
    (1, "The cat sat on the mat", True, "x", 1),
    (2, None, False, "x", 1),
    (3, "", None, None, None),
    (4, " \n\t ", None, None, None),
    (5, "naïve Ünïcode  là là là " + "Z" * 40_000, None, None, 2),
    (6, "the cat sat on the mat", None, None, 3),
    (6, "the cat sat on the mat", None, None, 3),
    (None, "the mat sat", None, None, 3),
    (7, "mat cat " * 60_000, None, None, 3),
    (8, "the dog ate the cat", None, None, 3),
    (11, "the mouse ate the dog", None, None, 3),
]


def test_edge_rows_and_any_partitioning(spark, monkeypatch):
    docs = spark.createDataFrame(EDGES, SCHEMA)
    found = ctxmix.scored(docs.repartition(1)).collect()
    base, _ = base_of([r[:2] for r in EDGES])
    assert rows_like(found) == sorted((b[:5] for b in base), key=repr)
    monkeypatch.setattr(ctxmix, "CHUNK_BYTES", 100)
    monkeypatch.setattr(ctxmix, "BLOCK", 64)
    again = ctxmix.scored(docs.repartition(5)).collect()

    def order(rows):
        return sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.base_score, r.score) for r in rows)

    for one, two in zip(order(found), order(again)):
        assert one[:3] == two[:3] and one[3:] == pytest.approx(two[3:], rel=1e-6)
    assert all(r.score < 0 for r in found)


def test_empty_table_and_no_training_texts(spark):
    assert ctxmix.scored(spark.createDataFrame([], SCHEMA)).collect() == []
    held = [(i, "some words here", None, None, None) for i in range(60) if is_held(i)]
    found = ctxmix.scored(spark.createDataFrame(held, SCHEMA)).collect()
    assert len(found) == len(held) and {(r.n_known, r.train_tokens) for r in found} == {(0, 0)}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)


def test_all_training_texts_fit_classes_and_weights(spark):
    """More texts than the 600 and longer ones than the 64 KB that alone were looked at before."""
    rows = [(i, f"{'abc'[i % 3]}{i % 7} {'xyz'[i % 3]}{i % 11} w{i}") for i in range(1500)] + [(2000 + i, f"long{i} " * 12_000) for i in range(5)]
    train = [r for r in rows if not is_held(r[0])]
    docs = spark.createDataFrame([(i, is_held(i), t) for i, t in rows], "doc_id long, held boolean, text string")
    found = ctxmix.chunks(docs.repartition(3))
    shares, docs_of = ctxmix.class_shares(found, 4)
    assert docs_of.sum() == len(train)
    words = ctxmix.word_table(found, shares)
    counts = collections.Counter(t for _, text in train for t in tokens_of(text))
    assert {bytes(r.word).decode(): r.n0 + r.n1 + r.n2 + r.n3 for r in words.collect() if r.n0 + r.n1 + r.n2 + r.n3} == dict(counts)
    table = ctxmix.bit_counts(words, 4)
    texts = sorted(w.encode() for w in counts)
    args = (np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(w) for w in texts]), np.array([counts[w.decode()] for w in texts]))
    mixer, dictionary = ctxmix.fit(words, table, np.array([sum(counts.values()), 0, 0, 0], float))
    alone, _ = ctxmix.fitted(table, *args)
    assert np.allclose(mixer.weights, alone.weights, atol=1e-4) and np.allclose(mixer.curve, alone.curve, atol=1e-4)
    assert 0 < dictionary < 1


def test_common_starts_of_words_are_one_node():
    words = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"ba", b"ab"]
    letters, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    [(_, _, data, place)] = ctxmix.blocks(letters, ends)
    node, chosen = ctxmix.nodes(data, place)
    found = [(w + b" ")[: j + 1] for w in words for j in range(len(w) + 1)]
    assert [found[chosen[n]] for n in node] == found
    # The last word's start comes again after another word, and is a node of its own.
    assert len(chosen) == len(set(found)) + 3


class Task:
    """What chunks are made by, and how many bytes that takes at most; no Spark."""

    def __init__(self, monkeypatch, docs):
        import tracemalloc
        import types

        import pyspark

        monkeypatch.setattr(pyspark.TaskContext, "get", lambda: types.SimpleNamespace(partitionId=lambda: 7))
        monkeypatch.setattr(ctxmix, "stored", lambda found, *_: found)
        batches = ctxmix.chunks(self)(iter(docs))
        self.rows, self.most = [], 0
        tracemalloc.start()
        for batch in batches:
            self.most = max(self.most, tracemalloc.get_traced_memory()[1])
            self.rows += batch.to_pylist()
        tracemalloc.stop()

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def batch_of(rows):
    import pyarrow as pa

    ids, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([is_held(i) for i in ids]), pa.array(texts)], ["doc_id", "held", "text"])


def test_a_chunk_takes_little_more_than_its_text(monkeypatch):
    """All its texts at once took eleven times their size in arrays, by two tasks of an executor."""
    text = " ".join(f"w{i % 9000}" for i in range(10_000))
    rows = [(i, text) for i in range(12 * (1 << 20) // len(text))]
    task = Task(monkeypatch, [batch_of(rows)])
    assert len(task.rows) == 1 and len(task.rows[0]["ids"]) == 8 * len(rows)
    assert task.most < 5 * len(text) * len(rows)


def test_chunks_of_any_batches_are_alike(monkeypatch):
    rows = [(i or None, f"a{i % 3} B{i} a{i % 5}\tcé " * (i % 7)) for i in range(200)]
    alone = Task(monkeypatch, [batch_of(rows)])
    monkeypatch.setattr(ctxmix, "PIECE_BYTES", 100)
    split = Task(monkeypatch, [batch_of(rows[i : i + 30]) for i in range(0, 200, 30)])
    assert len(alone.rows) == 1 and split.rows == alone.rows
    monkeypatch.setattr(ctxmix, "CHUNK_BYTES", 300)
    parts = Task(monkeypatch, [batch_of(rows[i : i + 30]) for i in range(0, 200, 30)]).rows
    assert [r["chunk"] for r in parts] == [(7 << 31) + n for n in range(len(parts))] and len(parts) > 3
    assert b"".join(r["ids"] for r in parts) == alone.rows[0]["ids"]
    assert b"".join(r["no_id"] for r in parts) == alone.rows[0]["no_id"]
    assert Task(monkeypatch, []).rows == []


def test_learning_sends_small_batches_and_stores_without_snappy(spark, monkeypatch):
    import pyarrow as pa

    from sitrep.llm.common import small_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(300).selectExpr("id AS doc_id", "id % 5 = 1 AS held", "repeat(concat('w', id, ' '), 1000) AS text").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"n": batch.nbytes}])

    before = spark.conf.get(key, None)
    with small_batches(spark, 100_000):
        assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 120_000
        found = ctxmix.chunks(texts)
    assert spark.conf.get(key, None) == before
    shares, _ = ctxmix.class_shares(found, 2)
    assert all(f.endswith(".zstd.parquet") for df in (found, ctxmix.word_table(found, shares)) for f in df.inputFiles())
    monkeypatch.setattr(ctxmix, "BATCH_ROWS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(range(25))], ["i"])
    assert [b.num_rows for b in ctxmix._in_rows(batch)] == [10, 10, 5]


def stream_of(texts):
    """Bytes of texts with a blank after every word and the end, each byte's place in its word, and the bytes before it in its text."""
    data, place, known = bytearray(), [], []
    for text in texts:
        begin = len(data)
        for word in tokens_of(text):
            spelled = word.encode() + b" "
            known += range(len(data) - begin, len(data) - begin + len(spelled))
            place += range(len(spelled))
            data += spelled
    return np.frombuffer(bytes(data), np.uint8), np.array(place), np.array(known)


ORDERED = ["a to the naïve onlooker's unbelievably long word a b c", "", None, "b", "a to the", " \t", "tothe a unbelievable b c a to", "x" * 300 + " a", "日本 日本語 a"]


def test_bits_are_predicted_from_the_text_before_their_word(spark, monkeypatch):
    """Counts and costs by grams and words are those of every byte of the texts, one after the other."""
    import pyarrow as pa

    rows = [(i, is_held(i), ORDERED[i % len(ORDERED)]) for i in range(60)]
    found = ctxmix.chunks(spark.createDataFrame(rows, "doc_id long, held boolean, text string").na.fill("").repartition(3))
    monkeypatch.setattr(ctxmix, "FEW_TOKENS", 7)
    shares, _ = ctxmix.class_shares(found, 2)
    words, grams = ctxmix.word_table(found, shares), ctxmix.gram_table(found)
    data, place, known = stream_of([t for _, held, t in rows if not held])
    expected = np.zeros((int(ctxmix.STARTS[-1]), 2), np.float32)
    for slots, bit in ctxmix.bits_of(data, place, known=known):
        for row in slots:
            np.add.at(expected, (row, bit), 1)
    table = ctxmix.bit_counts(words, 2, grams)
    assert (table == expected).all()
    assert not (table == ctxmix.bit_counts(words, 2)).all()
    assert sum(r.n for r in grams.collect()) == (place < ctxmix.REACH).sum()

    mixer, dictionary = ctxmix.fit(words, table, np.array([len(data), 0], float), found=grams)
    assert 0 < dictionary < 1
    stretch, levels = ctxmix.compact(table)
    model = {"weights": mixer.weights, "curve": mixer.curve, "stretch": stretch, "levels": levels}
    texts = [t or "" for t in ORDERED]
    letters, ends, tokens, lengths = ctxmix.tokenized(pa.array(texts))
    near = ctxmix.token_costs(model, letters, ends, tokens, lengths)
    sent = spark.sparkContext.broadcast(model)
    for most in (1 << 20, 100, 0):
        monkeypatch.setattr(ctxmix, "FREQUENT", most)
        frequent = ctxmix.frequent_costs(grams, sent)
        assert len(frequent[0]) <= most and (len(frequent[0]) > 0) == (most > 0) and (np.diff(frequent[0].view(np.int64)) > 0).all()
        assert ctxmix.token_costs(model, letters, ends, tokens, lengths, frequent) == pytest.approx(near, rel=1e-6)
    costs = near + ctxmix.word_costs(model, letters, ends, ctxmix.REACH)[tokens]
    data, place, known = stream_of(texts)
    last = np.where(place > 0, np.append(0, data[:-1]), 256)
    total = np.zeros(len(data))
    for slots, bit in ctxmix.bits_of(data, place, known=known):
        gate = ctxmix.gate_of(levels[slots[-3:]]).astype(np.int64)
        p, _, _ = mixer.refined(mixer.mixed(stretch[slots].astype(np.float32), gate), last)
        total += np.log(np.where(bit == 1, p, 1 - p))
    assert costs == pytest.approx(np.add.reduceat(total, np.flatnonzero(place == 0)), rel=1e-5)


def test_the_order_of_words_counts(spark):
    """The same words, none twice in a text: they had one score in any order while contexts ended with the word."""
    words = [f"w{i * i}" for i in range(40)]
    train, held = [i for i in range(400) if not is_held(i)], [i for i in range(400) if is_held(i)]
    rows = [(i, " ".join(words[i % 5 :])) for i in train] + [(held[0], " ".join(words[5:])), (held[1], " ".join(words[:4:-1]))]
    found = {r.doc_id: r for r in ctxmix.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ordered, turned = found[held[0]], found[held[1]]
    assert ordered.base_score == pytest.approx(turned.base_score) and ordered.n_tokens == turned.n_tokens
    assert ordered.score > turned.score + 1


def test_words_spelled_or_whole():
    share, spelled = np.array([0.5, 0.0, 1e-9, 0.0]), np.array([-2.0, -3.0, -90_000.0, -90_000.0])
    found = ctxmix.either(share, spelled, np.exp(spelled), np.flatnonzero(spelled < -400), 0.25)
    assert found[:3] == pytest.approx([math.log(0.125 + 0.75 * math.exp(-2)), math.log(0.75) - 3, math.log(0.25e-9)])
    assert found[3] == pytest.approx(math.log(0.75) - 90_000)
