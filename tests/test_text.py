"""Text expressions against hand-made rows and Python's own regular expressions."""

import random
import re
import urllib.parse

import pytest
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import text


def python_redact(value, kinds=C.PII_PATTERNS):
    for kind in kinds:
        value = re.sub(C.PII_PATTERNS[kind], f"[REDACTED_{kind}]", value)
    return value


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


EDGE = {
    "+254712345678": "[REDACTED_PHONE]",
    "+254 712 345 678": "+254 712 345 678",
    "0712-345-6789": "[REDACTED_PHONE]",
    "४-digit groups: २०१९-२०२०": "४-digit groups: [REDACTED_PHONE]",
    "4111111111111111": "[REDACTED_PHONE]1",
    "4111 1111 1111 1111": "[REDACTED_PHONE] 1111",
    "12 34 56 78 90 12 34": "[REDACTED_CREDIT_CARD]",
    "192.168.1.100": "[REDACTED_IP_ADDRESS]",
    "é10.0.0.1": "é10.0.0.1",
    "a.b@c.org.": "[REDACTED_EMAIL]",
    "2019-2020": "[REDACTED_PHONE]",
    "2024-01-15": "2024-01-15",
    "": "",
}


def test_redact_edge_rows(spark):
    assert column(spark, list(EDGE), text.redact) == list(EDGE.values())
    assert column(spark, [None], text.redact) == [None]


def test_redact_equals_python_on_random_text(spark):
    rng = random.Random(5)
    alphabet = "0123456789" * 3 + "abZ@@@...---___+++((  )) \t\n" + "\x1c\x1f\xa0 éकिी२०१٣²½ _µ"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(6000)]
    values += ["a@b.c_d@e.f+g@h.i", "x@y.z" * 5, "कि10.0.0.1", "10.0.0.1कि", "1" * 40, "1 - " * 30]
    for kinds in (None, ["EMAIL"], ["PHONE"], ["IP_ADDRESS"], ["CREDIT_CARD"]):
        found = column(spark, values, lambda c: text.redact(c, kinds))
        wanted = [python_redact(v, kinds or C.PII_PATTERNS) for v in values]
        assert [(v, f) for v, f, w in zip(values, found, wanted) if f != w] == []


def test_redact_is_idempotent_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    once = docs.select(text.redact("text").alias("t"))
    assert once.where(text.redact("t") != F.col("t")).count() == 0


def test_strict_keeps_cards_whole(spark):
    values = ["4111 1111 1111 1111", "4111111111111111", "call 0712-345-6789"]
    assert column(spark, values, lambda c: text.redact(c, strict=True)) == [
        "[REDACTED_CREDIT_CARD]",
        "[REDACTED_CREDIT_CARD]",
        "call [REDACTED_PHONE]",
    ]


def test_email_is_linear_on_long_runs(spark):
    value = "x" * 300_000 + " a@b.c"
    assert column(spark, [value], text.redact)[0].endswith(" [REDACTED_EMAIL]")


def test_redact_rejects_unknown_kinds():
    with pytest.raises(ValueError):
        text.redact("c", ["NAME"])


def test_normalize_lang(spark):
    values = ["sw-EN", "AM", "fil", None, "", "tl-x-y", "MR"]
    assert column(spark, values, text.normalize_lang) == ["swa", "amh", "fil", "unknown", "", "tgl", "mar"]


def test_first_long_word(spark):
    values = ["a an The flooded plain", "x\x1cyyyy", "abc\ndefg", "no w", "", "ÄÖÜß dddd", None]
    wanted = [
        next((w for w in v.lower().split() if len(w) > 3), None) if v is not None else None for v in values
    ]
    assert column(spark, values, text.first_long_word) == wanted


def test_url_quote_equals_python(spark):
    values = ["http://a/b c?d=é&f=%20", "x~*+!'()#[]@$,;|\\^`{}<>\"", "/ब"]
    assert column(spark, values, text.url_quote) == [urllib.parse.quote(v, safe=":/?&=%") for v in values]


def test_archive_url(spark):
    df = spark.createDataFrame([("20240101000000", "http://a/?b=c d")], "ts string, u string")
    assert df.select(text.archive_url("ts", "u")).first()[0] == (
        "https://web.archive.org/web/20240101000000id_/http://a/?b=c%20d"
    )


def test_first_non_empty(spark):
    df = spark.createDataFrame([("", "b"), (None, None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(text.first_non_empty("x", "y")).collect()] == ["b", None, "a"]
