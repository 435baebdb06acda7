"""The random field: exact marginals on trees, whole tokens, and weights that travel as arrays."""

import itertools
import pickle

import numpy as np
import pytest

from sitrep.llm import pii


def brute(unary, edges):
    """Marginals by the sum over all labellings; ``edges`` are (a, b, log factor)."""
    n, k = unary.shape
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        score = sum(unary[i, y] for i, y in enumerate(labels)) + sum(f[labels[a], labels[b]] for a, b, f in edges)
        for i, y in enumerate(labels):
            total[i, y] += np.exp(score)
    return total / total.sum(1, keepdims=True)


@pytest.mark.parametrize("seed", range(4))
def test_marginals_on_trees_are_exact(seed, monkeypatch):
    monkeypatch.setattr(pii, "ROUNDS", 200)
    rng = np.random.default_rng(seed)
    n, k = 5, len(pii.KINDS) + 1
    field = pii.Field(rng.normal(size=(pii.FEATURES, k)), rng.normal(size=(k, k)), rng.normal(size=(k, k)))
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[0, 3], [2, 4]])
    features = [rng.integers(0, pii.FEATURES, 4) for _ in range(n)]
    found = pii.beliefs(pii.Graph([(0, 1)] * n, features, chain, skip), field)
    edges = [(a, b, field.chain) for a, b in chain] + [(a, b, field.skip) for a, b in skip]
    assert np.abs(found - brute(field.unary[np.array(features)].sum(1), edges)).max() < 2e-3


def test_long_tokens_count_whole():
    long = "x" * 300
    text = f"{long}1@a {long}2@a {long}1@a"
    found = pii.graph(text)
    at = pii._slot("at=1")
    assert all(at in f for f in found.features)
    # Equal tokens are tied, tokens that differ after their first letters by their shape alone.
    assert [0, 2] in found.skip.tolist()
    marked = pii.graph(f"**{long}1** b")
    assert marked.spans[0] == (2, 303)


def test_fit_learns_ties_and_context():
    rows = [f"write to a{i}@b.org now, a{i}@b.org or call +1 555 010 {i:04d} today" for i in range(80)] + ["nothing here 12"] * 20
    field = pii.fit(rows)
    email = 1 + pii.KINDS.index("email")
    assert field.skip[email, email] > 0.3 and field.skip[email, 0] < field.skip[email, email]
    assert pii.fit(rows).unary.tolist() == field.unary.tolist()
    # Held-out texts: what the patterns find, the field finds from the features.
    right = total = 0
    for i in range(100, 120):
        text = f"write to a{i}@b.org now, a{i}@b.org or call +1 555 010 {i:04d} today"
        graph = pii.graph(text)
        wanted = pii.labels_of(graph, pii.base_spans(text))
        right += int((pii.beliefs(graph, field).argmax(1) == wanted).sum())
        total += len(wanted)
    assert right / total > 0.95


def test_planted_variants_are_added():
    """Addresses without a dot, which no pattern takes, in texts with whole ones."""
    rng = np.random.default_rng(2)
    rows = [f"call +1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)} or mail u{i}@host.org about {i % 7} things" for i in range(300)]
    field = pii.fit(rows)
    added = 0
    for i in range(50):
        text = f"call +1 ({200 + i}) 555-{3000 + i} or mail u{i}@host.org, and u{i}@host again u{i}@host about {i % 7} things"
        base = pii.base_spans(text)
        found = pii.field_spans(text, field, base)
        assert all(kind != 0 or "@" in text[s:e] for kind, s, e in found)
        added += sum(text[s:e].startswith(f"u{i}@host") for kind, s, e in found if kind == 0)
    assert added >= 50


def test_weights_are_sent_without_the_package(spark):
    docs = spark.createDataFrame([(1, "mail a@b.org 12"), (2, None)], "doc_id long, text string")
    sent = pii._sent(docs, "doc_id", "text", 10, 100)
    assert b"sitrep" not in pickle.dumps(sent.value)
    few = pii.sample(docs, "doc_id", "text", 10, 5)
    assert few == []
