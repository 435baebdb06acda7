"""Personal data by fixed patterns and a skip-chain conditional random field.

The field has a variable for every token that can be part of an entity (one with a digit, an
``@`` or a leading plus) and for the tokens beside those; all others are outside by definition.
Factors are tokens' features, neighbours, and pairs of tokens at any distance that are equal
or look alike. Loopy belief propagation gives every token's label with the whole document in
view, so that what is clear in one place settles its repeats.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import map_batches, map_rows, row_key

KINDS = ("email", "ip", "card", "phone")
# Fixed patterns.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    # Only from the start of a run of digits, as a match further on has one there too; so that
    # a very long run is read once.
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
# Texts a field is fitted on, unless said otherwise: so many at most, and none longer.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 20_000
# What a span of each label must hold.
_NEEDED = [re.compile("@"), re.compile("[0-9]"), re.compile("[0-9]"), re.compile("[0-9]")]
# Share of the features left out in each round of the fit.
DROPPED = 0.3
FEATURES = 4096
BELIEF = 0.95
ROUNDS = 15

_TOKEN = re.compile(r"[^\s\"'<>|,;]+")
_CANDIDATE = re.compile(r"[0-9@]|^\+")
_ANY = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    digits = "".join(_DIGITS.findall(found))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def _emails(text: str) -> list[tuple[int, int]]:
    """Email spans; the pattern is tried only where a name stands before an ``@``."""
    out, at = [], 0
    while (sign := text.find("@", at)) >= 0:
        start = sign
        while start > at and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        found = PATTERNS["email"].match(text, start) if start < sign else None
        if found:
            out.append(found.span())
            at = found.end()
        else:
            at = sign + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the fixed patterns: number of the kind, start and end, in that order."""
    out = []
    if "@" in text:
        out += [(0, *span) for span in _emails(text)]
    if _ANY.search(text):
        for n, kind in list(enumerate(KINDS))[1:]:
            if kind != "phone" or "+" in text:
                out += [(n, *m.span()) for m in PATTERNS[kind].finditer(text) if _holds(kind, m[0])]
    return out


@dataclass
class Field:
    """Fitted weights: features by label, neighbours by labels, alike tokens by labels."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


@dataclass
class Graph:
    """Variables of a document and the pairs of them that share a factor."""

    spans: list[tuple[int, int]]
    features: list[np.ndarray]
    chain: np.ndarray
    skip: np.ndarray


def shape(token: str) -> str:
    """Runs of digits and letters by their length class; marks as they are."""
    out = re.sub(r"[0-9]+", lambda m: "d" + str(min(len(m[0]), 5)), token)
    return re.sub(r"[^\W\d_]{2,}", "x", out)


def _identity(token: str) -> str | bytes:
    """What tells a token from others; of a long one its digest, not the token."""
    return token if len(token) <= 64 else hashlib.blake2b(token.encode(), digest_size=16).digest()


def _slot(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % FEATURES


def graph(text: str) -> Graph | None:
    """Variables, features and factors of a text; None if nothing in it can be an entity.

    Equal tokens, and tokens of one shape with digits, are tied in chains of occurrences, so
    that the number of factors grows with the tokens and not with their pairs.
    """
    if not _ANY.search(text):
        return None
    tokens = [m for m in _TOKEN.finditer(text)]
    able = [bool(_CANDIDATE.search(m[0])) for m in tokens]
    chosen = sorted({j for i, ok in enumerate(able) if ok for j in (i - 1, i, i + 1) if 0 <= j < len(tokens)})
    words = [m[0].strip("*%$#&!?:") for m in tokens] if chosen else []
    shapes = {i: shape(words[i]) for i in chosen}
    features = []
    for i in chosen:
        w, s = words[i], shapes[i]
        names = ["bias", f"s={s}", f"able={able[i]}", f"len={min(len(w) // 4, 6)}", f"at={w.count('@')}", f"dots={min(w.count('.'), 4)}"]
        names += [f"plus={w[:1] == '+'}", f"paren={w[:1] == '('}", f"digits={min(sum(c.isdigit() for c in w), 20)}"]
        names += [f"prev={shape(words[i - 1])}" if i and able[i - 1] else "prev=O"]
        names += [f"next={shape(words[i + 1])}" if i + 1 < len(tokens) and able[i + 1] else "next=O"]
        features.append(np.array([_slot(n) for n in names]))
    chain = [(k, k + 1) for k in range(len(chosen) - 1) if chosen[k + 1] == chosen[k] + 1]
    last, skip = {}, set()
    for k, i in enumerate(chosen):
        if able[i]:
            for name in (("w", _identity(words[i].lower())), ("s", _identity(shapes[i]))):
                if name in last and last[name] + 1 < k:
                    skip.add((last[name], k))
                last[name] = k
    pairs = lambda x: np.array(sorted(x), np.int64).reshape(-1, 2)
    spans = []
    for i in chosen:
        lead = len(tokens[i][0]) - len(tokens[i][0].lstrip("*%$#&!?:"))
        spans.append((tokens[i].start() + lead, tokens[i].start() + lead + len(tokens[i][0].strip("*%$#&!?:"))))
    return Graph(spans, features, pairs(chain), pairs(skip))


def labels_of(found: Graph, base: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of every variable: 0 outside, else 1 more than the number of its kind."""
    out = np.zeros(len(found.spans), np.int64)
    for kind, start, end in base:
        for k, (a, b) in enumerate(found.spans):
            if a < end and start < b:
                out[k] = kind + 1
    return out


def fit(rows: list[str], rounds: int = 150, rate: float = 0.3, seed: int = 5) -> Field:
    """Weights from texts labelled by the fixed patterns, all factors together.

    The pseudo-likelihood of the whole graph: every variable's label given its features and
    the labels of its neighbours along the chain and over skips. A share of the features is
    left out at random in each round, so that the neighbours learn to carry a label where a
    token's own shape does not. Without texts everything stays outside.
    """
    n = len(KINDS) + 1
    found = [(g, t) for t in rows for g in [graph(t)] if g and g.spans]
    if not found:
        bias = np.zeros((FEATURES, n))
        bias[_slot("bias"), 0] = 20.0
        return Field(bias, np.zeros((n, n)), np.zeros((n, n)))
    labels = [labels_of(g, base_spans(t)) for g, t in found]
    y = np.concatenate(labels)
    one = np.eye(n)[y]
    x = np.array([f for g, _ in found for f in g.features])
    starts = np.cumsum([0] + [len(label) for label in labels])
    # Labels of the neighbours of every variable: before and after it, and over skips.
    before, after, skips = (np.zeros((len(y), n)) for _ in range(3))
    for (g, _), start in zip(found, starts):
        for pairs, left, right in ((g.chain, before, after), (g.skip, skips, skips)):
            a, b = pairs[:, 0] + start, pairs[:, 1] + start
            np.add.at(left, b, one[a])
            np.add.at(right, a, one[b])
    rng = np.random.default_rng(seed)
    weights, chain, skip = np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros((n, n))
    squares = [np.full(w.shape, 1e-8) for w in (weights, chain, skip)]
    for _ in range(rounds):
        held = rng.random(x.shape) >= DROPPED
        held[:, 0] = True  # the bias
        score = (weights[x] * held[..., None]).sum(1) + before @ chain + after @ chain.T + skips @ skip
        error = (_softmax(score) - one) / len(y)
        step = np.zeros_like(weights)
        for column in range(x.shape[1]):
            np.add.at(step, x[:, column], error * held[:, column : column + 1])
        tied = skips.T @ error
        steps = (step + 1e-6 * weights, before.T @ error + (after.T @ error).T + 1e-5 * chain, (tied + tied.T) / 2 + 1e-5 * skip)
        for w, s, q in zip((weights, chain, skip), steps, squares):
            q += s * s
            w -= rate * s / np.sqrt(q)
        # Bounded ties keep the message passing from running away on loops.
        np.clip(chain, -2, 2, out=chain)
        np.clip(skip, -2, 2, out=skip)
    return Field(weights, chain, skip)


def beliefs(found: Graph, field: Field) -> np.ndarray:
    """Marginals of the labels by loopy belief propagation, damped, over all factors."""
    unary = field.unary[np.array(found.features)].sum(1)
    edges = np.concatenate([found.chain, found.skip])
    if not len(edges):
        return _softmax(unary)
    kernel = np.concatenate(
        [np.repeat(field.chain[None], len(found.chain), 0), np.repeat(field.skip[None], len(found.skip), 0)]
    )
    a, b = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
    kernel = np.exp(np.concatenate([kernel, kernel.transpose(0, 2, 1)]))
    back = np.concatenate([np.arange(len(edges), 2 * len(edges)), np.arange(len(edges))])
    messages = np.zeros((len(a), unary.shape[1]))
    for _ in range(ROUNDS):
        total = unary.copy()
        np.add.at(total, b, messages)
        out = _softmax(total[a] - messages[back])
        new = np.log(np.einsum("ei,eij->ej", out, kernel))
        new -= new.max(1, keepdims=True)
        if np.abs(new - messages).max() < 1e-3:
            break
        messages = 0.5 * messages + 0.5 * new
    total = unary.copy()
    np.add.at(total, b, messages)
    return _softmax(total)


def _softmax(score: np.ndarray) -> np.ndarray:
    score = np.exp(score - score.max(1, keepdims=True))
    return score / score.sum(1, keepdims=True)


def field_spans(text: str, field: Field, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans the field is sure of, outside those of the fixed patterns.

    A span holds what its kind is made of: an email an ``@``, the others a digit. Neighbouring tokens of one label with white space between them are one span.
    """
    found = graph(text)
    if found is None or not found.spans:
        return []
    sure = beliefs(found, field)
    label = np.where(sure.max(1) >= BELIEF, sure.argmax(1), 0)
    out, joined = [], {tuple(p) for p in found.chain.tolist()}
    for k in np.flatnonzero(label).tolist():
        start, end = found.spans[k]
        if start == end or not _NEEDED[label[k] - 1].search(text, start, end):
            continue
        if out and out[-1][3] == k - 1 and (k - 1, k) in joined and out[-1][0] == label[k] - 1:
            out[-1] = (out[-1][0], out[-1][1], end, k)
        else:
            out.append((int(label[k]) - 1, start, end, k))
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken])
    # Base spans of different kinds may overlap; what they cover up to each start.
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0)
    free = []
    for kind, start, end, _ in out:
        before = int(np.searchsorted(starts, end)) - 1 if taken else -1
        if before < 0 or reach[before] <= start:
            free.append((kind, start, end))
    return free


def _listed(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in found)


def sample(docs: DataFrame, doc_id: str, text: str, most: int, longest: int) -> list[str]:
    """Texts to fit on: of those with a candidate and at most ``longest`` characters, the
    ``most`` whose hashes come first."""
    rows = docs.select(row_key(docs[doc_id], docs[text]).alias("key"), docs[text].alias("text"))
    rows = rows.where(F.col("text").rlike("[0-9@]") & (F.length("text") <= longest))
    keys = rows.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(most)
    # At most that many keys.
    found = rows.join(F.broadcast(keys), "key").dropDuplicates(["key"]).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["key"])]


def _sent(docs: DataFrame, doc_id: str, text: str, most: int, longest: int):
    """The fitted weights as plain arrays, which workers read without this package."""
    found = fit(sample(docs, doc_id, text, most, longest))
    return docs.sparkSession.sparkContext.broadcast((found.unary, found.chain, found.skip))


def personal_data(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """Personal data of every document: one row per input row.

    Counts and ``base_sha256`` are of the fixed patterns; ``spans`` also has what the field
    adds. A null text is empty. The field is fitted on a bounded sample of the table itself,
    ``sample_docs`` texts of at most ``sample_chars`` characters, labelled by the fixed
    patterns; every text is scanned whole. A table without candidates adds nothing.
    Repeated rows get the same result; other columns are ignored.
    """
    sent = _sent(docs, doc_id, text, sample_docs, sample_chars)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, field = [], Field(*sent.value)
        for value in batch.column(1):
            body = value.as_py() or ""
            base = base_spans(body)
            added = field_spans(body, field, base)
            kinds = [k for k, _, _ in base]
            digest = hashlib.sha256(_listed(base).encode()).hexdigest()
            rows.append((*[kinds.count(k) for k in range(len(KINDS))], digest, _listed(sorted(base + added))))
        types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], [c.split()[0] for c in RESULT.split(", ")])

    return map_batches(docs.select(docs[doc_id].cast("long"), docs[text]), run, RESULT)


def redacted(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; a null text stays null."""
    sent = _sent(docs, doc_id, text, sample_docs, sample_chars)
    at = docs.columns.index(text)

    def clean(body: str | None, field: Field) -> str | None:
        if body is None:
            return None
        base = base_spans(body)
        out, end = [], 0
        for start, stop, kind in sorted((s, e, k) for k, s, e in base + field_spans(body, field, base)):
            if start >= end:
                out += [body[end:start], f"[{KINDS[kind].upper()}]"]
            end = max(end, stop)
        return "".join([*out, body[end:]])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        field = Field(*sent.value)
        new = pa.array([clean(v.as_py(), field) for v in batch.column(at)], batch.schema.field(at).type)
        return batch.set_column(at, batch.schema.field(at), new)

    return map_rows(docs, run)
