"""Source divergence against a brute-force version, shared digests, and edge cases."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitrep.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, item string, value double"


def rows_of(seed, n=120):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "x", "ÉTÉ", "zeta", "eta9theta", "o'mega", "ß"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [
        (i, " ".join(rng.choices(words, k=rng.randrange(0, 30))), rng.choice(["en", "de", None]), rng.choice("abcd"), "x", 1.0)
        for i in range(n)
    ]
    rows += [(500, None, "en", None, None, None), (501, "", "zz", "a", "x", None), (501, "", "zz", "b", "x", None)]
    rows += [(502, "... 12 !", "yy", "a", "x", None), (503, "alpha " * 40_000, "en", "a", "x", 0.0), (1, "alpha beta", "en", "a", "x", 0.0)]
    return rows


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, min_docs=3, top=200):
    docs = [(r[2] or "", r[3] or "", TERM.findall(lowered(r[1]))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in here for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= min_docs]

        def shares(of):
            n = collections.Counter(t for d in of for t in d[2] if df[t] >= min_docs)
            total = sum(n.values()) + len(kept)
            return n, {t: 1 + 10**9 * (n[t] + 1) // total for t in kept}

        sources = sorted({d[1] for d in here})
        groups = {s: shares([d for d in here if d[1] == s]) for s in sources}
        q = shares(here)[1]
        for s in sources:
            n, p = groups[s]
            pairs = [(sum((p[t] - groups[o][1][t]) ** 2 // groups[o][1][t] for t in kept), o) for o in sources if o != s]
            terms = [((p[t] - q[t]) ** 2 // q[t], t) for t in kept if n[t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("bits", [64, 6, 1])
def test_against_brute_force_with_shared_digests(spark, bits):
    rows = rows_of(3)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(dv.divergence(docs, digest_bits=bits, top=7)) == brute(rows, top=7)


def test_many_sources_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(dv, "BLOCK_CELLS", 8)
    monkeypatch.setattr(dv, "SLICE_BYTES", 200)
    rows = [(i, t, l, f"s{i % 23}", "x", 1.0) for i, t, l, *_ in rows_of(4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(dv.divergence(docs)) == brute(rows)


def test_groups_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(dv.scale, "MAX_ROWS", 0)
    rows = rows_of(5)
    assert found(dv.divergence(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table_and_no_kept_terms(spark):
    assert found(dv.divergence(spark.createDataFrame([], SCHEMA))) == []
    rows = rows_of(6, 10)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert found(dv.divergence(docs, min_docs=10**6)) == brute(rows, min_docs=10**6)


def test_a_task_holds_one_worker_and_small_batches(spark, monkeypatch):
    key, seen, stored = "spark.sql.execution.arrow.maxBytesPerBatch", {}, dv.stored

    def noted(df, label, *rest):
        seen[label] = spark.conf.get(key, None)
        return stored(df, label, *rest)

    before = spark.conf.get(key, None)
    monkeypatch.setattr(dv, "stored", noted)
    plan = dv.divergence(spark.createDataFrame(rows_of(8, 30), SCHEMA))._jdf.queryExecution().toString()
    assert {seen["dictionary"], seen["kept-terms"]} == {str(dv.SLICE_BYTES)} and spark.conf.get(key, None) == before
    assert plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1


def test_shares_of_very_large_counts(spark):
    counts = [(0, 5), (8_999_999_999, 10**10), (9_000_000_001, 10**11), (6 * 10**14, 10**15)]
    df = spark.createDataFrame(counts, "n long, size long").select("n", "size", dv.share(F.col("n"), F.col("size")).alias("p"))
    assert [tuple(r) for r in df.collect()] == [(n, s, 1 + 10**9 * (n + 1) // s) for n, s in counts]
    assert dv._gap(np.array([10**9 + 1]), np.array([1])).tolist() == [10**18]
