"""Registered corpus queries against their SQL, and against brute force where SQL has no words."""

import collections
import hashlib
import re
import struct
import zlib

import pytest

import corpus_pipeline
from sitrep.llm.oracle import ORACLE
from sitrep.llm.queries import QUERIES, tokenizer_path
from tests.compare import connection, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def by_id(df, key="doc_id"):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(con, ORACLE[name])


def quality_of(text):
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(runs)
    inside = {j for i, run in enumerate(runs) if count[run] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(inside),
        n < 10 or 100 * len(inside) > 20 * n,
    )


def test_quality(spark, con, texts):
    found = by_id(QUERIES["op1_quality"](spark, SF))
    assert set(found) == set(texts)
    for i, text in texts.items():
        assert tuple(found[i])[1:7] == quality_of(text), i
        assert not (found[i].base_failed and found[i].kept)
    good = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    rest = [(good[i], r.kept) for i, r in found.items() if i in good and not r.base_failed]
    assert sum(g == k for g, k in rest) > 0.97 * len(rest)
    assert all(k for g, k in rest if g == 1)


def test_urls(spark, con):
    found = by_id(QUERIES["op3_urls"](spark, SF), "page_id")
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    for i, url in con.execute("SELECT page_id, url FROM pages").fetchall():
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        fits = [r for r in rules if ("." + host.lower()).endswith("." + r[1]) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        assert (found[i].host, found[i].path) == (host.lower(), path)
        assert found[i].rule == (best and best[1] + best[2])
        assert found[i].verdict == best[0] if best else found[i].verdict in ("allow", "block")


def test_secrets(spark, texts):
    found = by_id(QUERIES["op6_secrets"](spark, SF))
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for i, text in texts.items():
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[1]) >= 6]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]
        assert found[i].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest(), i
        assert set(listed) <= set(found[i].spans.split(",")) | {""}


def test_personal_data(spark, texts):
    found = by_id(QUERIES["op8_pii"](spark, SF))

    def digits(s):
        return "".join(c for c in s if c.isdigit())

    def luhn(s):
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits(s)))]
        return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(s)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    for i, text in texts.items():
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]
        assert found[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), i
        assert set(spans) <= set(found[i].spans.split(",")) | {""}


def encoded(rows):
    """Places, lengths and checksums of (id, text) rows in order, by the tokenizer alone."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    out, at = [], 0
    for i, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        out.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_tokens(spark, texts):
    found = QUERIES["op10_tokens"](spark, SF).collect()
    assert sorted(map(tuple, found)) == encoded(sorted(texts.items()))


def test_pipeline(spark, con, texts):
    """Each stage on what the one before it kept, by the operators' SQL or by brute force."""
    found = corpus_pipeline.run(spark, SF).collect()
    verdicts = by_id(QUERIES["op1_quality"](spark, SF))
    kept = [i for i, r in verdicts.items() if r.kept]
    con.execute("CREATE OR REPLACE TEMP TABLE kept AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [kept])
    for name in ("op2_neardup", "op7_decontam"):
        column = "kept" if name == "op2_neardup" else "NOT contaminated"
        sql = ORACLE[name].replace("FROM documents", "FROM kept")
        con.execute(f"CREATE OR REPLACE TEMP TABLE kept AS SELECT * FROM kept WHERE doc_id IN (SELECT doc_id FROM ({sql}) WHERE {column})")
    mixed = con.execute(ORACLE["op5_mixing"].replace("FROM documents", "FROM kept")).to_arrow_table().to_pylist()
    rows = [r["doc_id"] for r in mixed for _ in range(r["taken"] // max(1, r["size"]))]
    assert sorted(map(tuple, found)) == encoded([(i, texts[i]) for i in sorted(rows)])
