"""Importance resampling against a brute-force version, and its edge cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from sitrep.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, rank string, score int"
ROWS = [
    (1, "The cat sat on the mat and the dog sat on the cat", "x", 1),
    (2, None, "x", None),
    (3, "", None, 1),
    (4, "...  !!", None, 1),
    (5, "naïve Ünïcode ÀÉ words çà et là, naïve again: über", "x", 1),
    (6, "the cat sat on the mat and the dog sat on the cat", "x", 1),
    (6, "the cat sat on the mat and the dog sat on the cat", "x", 1),
    (None, "one two three four five six seven eight nine ten", "x", 1),
    (8, "mat " * 30_000, "y", 2),
    (9, "x" * 70_000 + " y", "y", 2),
]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def runs(text, n):
    words = WORD.findall(lowered(text))
    out = []
    for size in range(1, n + 1):
        out += [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    return len(words), out


def brute(rows, target, n, buckets, percent, min_words, seed):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    texts = [runs(r[1], n) for r in rows]
    s = collections.Counter(bucket(x) for _, f in texts for x in f)
    t = collections.Counter(bucket(x) for item in target for x in runs(item, n)[1])
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log(float(t[b] + 1) * float(s_all + buckets) / (float(s[b] + 1) * float(t_all + buckets))))

    out = []
    for (doc_id, *_), (words, found) in zip(rows, texts):
        weight = sum(gain(bucket(x)) for x in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, words, len(found), weight, score, None])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for place, row in enumerate(fit[: percent * len(fit) // 100], 1):
        row[5] = place
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_against_brute_force(spark, n):
    target = ["the dog sat", None, "naïve words", ""]
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = resample.resampled(
        docs, spark.createDataFrame([(t,) for t in target], "text string"), n=n, buckets=97, percent=50, min_words=8, seed=5
    )
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert ordered(found.collect()) == ordered(brute(ROWS, target, n, 97, 50, 8, 5))


def test_composed_crcs():
    join = resample.Composer().join
    parts = [b"", b"a", b"hello", "é".encode(), b"x" * 300]
    left, right = zip(*[(a, b) for a in parts for b in parts])
    crcs = [np.array([zlib.crc32(x) for x in side], np.uint32) for side in (left, right)]
    found = join(*crcs, np.array([len(b) for b in right]))
    assert found.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert resample.resampled(none, spark.createDataFrame([], "text string")).collect() == []
    docs = spark.createDataFrame(ROWS[:1], SCHEMA)
    assert len(resample.resampled(docs, none).collect()) == 1
    assert resample.drawn(docs, none, percent=100, min_words=1).collect() == docs.collect()
    assert resample.drawn(docs, none, percent=0).collect() == []


def test_many_slices_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    target = spark.createDataFrame([("the cat",)], "text string")
    whole = ordered(resample.resampled(docs, target, min_words=5).collect())
    monkeypatch.setattr(resample, "SCAN_BYTES", 50)
    assert ordered(resample.resampled(docs, target, min_words=5).collect()) == whole
