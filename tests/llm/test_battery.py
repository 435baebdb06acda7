"""The randomness battery against plain formulas, its levels, and planted keys."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from sitrep.llm import quality, secrets
from sitrep.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def normal(z):
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))


def brute(text):
    """Encoding, length class and p-value of a string."""
    body = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    name, alphabet = next((n, a) for n, pattern, a in secrets.ENCODINGS if re.search(pattern, body))
    n, k = len(body), len(alphabet)
    codes = [alphabet.index(c) + 1 for c in body]
    chi = max(k * sum(codes.count(c) ** 2 for c in set(codes)) / n - n, 0) / (k - 1)
    free = k - 1
    z_chi = (chi ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    high = [c > k // 2 for c in codes]
    above, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    z_runs = 8.0
    if 0 < above < n:
        a = 2 * above * (n - above)
        z_runs = (runs - 1 - a / n) / math.sqrt(a * (a - n) / (n * n * (n - 1)))
    mean = sum(codes) / n
    spread = sum((c - mean) ** 2 for c in codes)
    z_lag = 8.0
    if spread:
        z_lag = (sum((x - mean) * (y - mean) for x, y in zip(codes, codes[1:])) / spread + 1 / (n - 1)) * math.sqrt(n - 1)
    p = min(1.0, 3 * min(2 * (1 - normal(min(abs(z), 8))) for z in (z_chi, z_runs, z_lag)))
    return name, max([x for x in secrets.LENGTHS if x <= n], default=0), p


def strings_of():
    rng = random.Random(8)
    out = []
    for _, _, alphabet in secrets.ENCODINGS:
        for n in (20, 23, 24, 33, 64, 130, 500):
            out.append("".join(rng.choice(alphabet) for _ in range(n)))
            out.append("".join(rng.choice(alphabet[: len(alphabet) // 3]) for _ in range(n)))
            out.append("".join(alphabet[i * 7 % len(alphabet)] for i in range(n)))
    return out + ["a" * 30, "ab" * 15, "TheQuickBrownFoxJumpsOverTheLazyDog", "abc-def_ghi/jkl+mno-pqr==", "0" * 25]


def test_battery_by_plain_formulas(spark):
    texts = strings_of()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    one = F.array(F.struct(F.lit("candidate").alias("role"), F.lit(0).alias("start"), F.lit(1).alias("end"), "text"))
    tested = rows.select("i", one.alias("strings")).select("i", secrets.battery("strings").alias("t"))
    found = {r.i: r.t[0] for r in tested.collect()}
    for i, text in enumerate(texts):
        name, length_class, p = brute(text)
        assert (found[i].encoding, found[i].length_class) == (name, length_class), text
        # The normal distribution is its logistic form, right to three digits.
        assert found[i].p == pytest.approx(p, abs=3 * 2 * 2.5e-4), text


def test_levels_by_counting(spark):
    rng = random.Random(3)
    tested = []
    for _ in range(4000):
        role = rng.choice(["candidate", "ordinary"])
        encoding, length_class = rng.choice(["hex", "HEX", "base64"]), rng.choice([0, 20, 40])
        p = rng.random() if role == "candidate" and length_class == 40 else rng.random() ** (2 if length_class == 20 else 60)
        tested.append((role, encoding, length_class, p))
    rows = spark.createDataFrame([([t],) for t in tested], "tested array<struct<role:string,encoding:string,length_class:int,p:double>>")
    wanted = set()
    for family in ("hex", "other"):
        for length_class in (20, 40):
            here = [(r, p) for r, e, c, p in tested if c == length_class and (e.lower() == "hex") == (family == "hex")]
            real, plain = [p for r, p in here if r == "candidate"], [p for r, p in here if r == "ordinary"]
            for level in secrets.LEVELS:
                passed = sum(p >= level for p in real)
                false = len(real) * (sum(p >= level for p in plain) + 1) / (len(plain) + 1)
                if passed and false <= 0.1 * passed:
                    wanted.add((family, length_class, level))
                    break
    assert set(secrets.thresholds(rows, 0.1)) == wanted and wanted


def test_planted_keys_are_found_at_the_false_rate(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    docs, planted, plain = [], {}, {}
    for i in range(600):
        text = " ".join(rng.choice(words).capitalize() if rng.random() < 0.2 else rng.choice(words) for _ in range(150))
        if i % 3 == 0:
            alphabet = rng.choice([secrets.ENCODINGS[4][2], secrets.ENCODINGS[2][2]])
            key = "".join(rng.choice(alphabet) for _ in range(rng.choice([64, 130])))
            planted[i] = key
            text += " " + key
        elif i % 3 == 1:
            plain[i] = "".join(rng.choice(words).capitalize() for _ in range(10))
            text += " " + plain[i]
        docs.append((i, text))
    found = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    hits = {r.doc_id for r in found for s in r.spans.split(",") if s.startswith("random:") for _, a, b in [s.split(":")] if texts[r.doc_id][int(a) : int(b)].rstrip("=")}
    right, wrong = hits & set(planted), hits - set(planted)
    assert len(right) > 0.8 * len(planted)
    assert len(wrong) <= 0.1 * len(hits) + 2


def test_cleaned_lines_by_brute_force(spark):
    """Texts without the lines that break a rule, and what went."""
    import hashlib

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op1_lines"](spark, SF).collect()}
    assert set(found) == set(docs)
    for i, text in docs.items():
        lines = (text or "").split("\n")
        bad = [x for x in lines if x.split() and quality.line_fault(x.encode(), len(x.encode().split()))]
        kept = [x for x in lines if not (x.split() and quality.line_fault(x.encode(), len(x.encode().split())))]
        r = found[i]
        assert (r.n_lines, r.n_bad_lines) == (len(lines), len(bad))
        assert r.cleaned_sha256 == hashlib.sha256("\n".join(kept).encode()).hexdigest()
        assert r.lost_words == sum(len(x.encode().split()) for x in bad)
