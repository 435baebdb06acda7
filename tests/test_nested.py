"""Records with mixed types."""

import json

from pyspark.sql import functions as F

from sitrep.functions import nested
from sitrep.sources import archive, payloads


def variants(spark, values):
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)], "i int, j string")
    return df.select("i", F.parse_json("j").alias("v"))


def array(spark, value):
    return variants(spark, [value]).select(F.try_variant_get("v", "$", "array<variant>").alias("a"))


def test_ref_ids(spark):
    refs = [1, {"id": "2"}, "3", {"id": 2.7}, None, {"id": None}, {"id": "x"}, {"id": " 12 "}, {}, 1.5, [1], {"id": "2.7"}]
    assert array(spark, refs).select(nested.ref_ids("a")).first()[0] == [1, 2, 2, 12]


def test_missing_array_is_empty(spark):
    df = array(spark, 5)
    assert df.select(nested.ref_ids("a"), nested.embedded_urls("a")).first() == ([], [])


def test_embedded_urls(spark):
    refs = [{"url": "", "src": "x"}, {"original_url": "o", "url": None}, 7, "s", {"id": 1}, {"file_url": False, "src": "y"}]
    assert array(spark, refs).select(nested.embedded_urls("a")).first()[0] == ["x", "o", "y"]


def test_media_refs_drop_zero(spark):
    rows = array(spark, [0, 3, {"id": "0"}, {"url": "u", "id": 9}]).select(nested.media_refs("a")).first()[0]
    assert [(r.id, r.url) for r in rows] == [(3, None), (9, "u")]


def test_prompt(spark):
    records = [
        {"prompt": "", "text": None, "title": "t", "content": "c"},
        {"prompt": 0, "message": "m"},
        {"text": [], "description": {}, "é": 1, "a": 2},
        {"text": 5},
    ]
    found = [r[0] for r in variants(spark, records).orderBy("i").select(nested.prompt("v")).collect()]
    assert found[:2] == ["t", "m"]
    assert json.loads(found[2]) == records[2] and found[2].index('"a"') < found[2].index('"é"')
    assert found[3] == "5"


def test_dedup_key_keeps_types_apart(spark):
    records = [{"id": 1}, {"id": "1"}, {"id": 0, "url": "u"}, {"url": "u"}, {"x": 1, "a": 2}, {"a": 2, "x": 1}]
    keys = [r[0] for r in variants(spark, records).orderBy("i").select(nested.dedup_key("v")).collect()]
    assert len(set(keys[:2])) == 2 and keys[2] == keys[3] and keys[4] == keys[5]


def test_result_items(spark):
    bodies = [[{"a": 1}, 5, "x", [1], {}], {"results": [{"b": 1}, None]}, {"results": 7}, {"other": [{}]}, 5, None]
    rows = variants(spark, bodies).orderBy("i").select(F.size(nested.objects_in(F.col("v")))).collect()
    assert [r[0] for r in rows] == [2, 1, 0, 0, 0, 0]


def test_ludp_key_presence_decides(spark):
    bodies = [
        {"results": [{"term": "a"}], "data": [{"term": "b"}]},
        {"data": [{"term": "b"}]},
        {"results": [], "data": [{"term": "b"}]},
        {"results": None, "data": [{"term": "b"}]},
        {"x": 1},
    ]
    df = payloads.ludp_records(variants(spark, bodies).withColumnRenamed("v", "payload"))
    assert [(r.i, r.term) for r in df.orderBy("i").collect()] == [(0, "a"), (1, "b")]


def test_triage(spark):
    rows = [
        (200, "application/json", "{}", None),
        (200, "text/html", " \n[1]", None),
        (200, "text/html", "<html>", "not_json"),
        (200, None, None, "not_json"),
        (403, "application/json", "{}", "blocked"),
        (400, "application/json", "{}", "failed"),
        (200, "Application/JSON", "oops", "invalid_json"),
        (200, "x", "{oops", "invalid_json"),
    ]
    df = spark.createDataFrame(rows, "status int, content_type string, body string, want string")
    out = payloads.classify_responses(df).collect()
    assert [r.reason for r in out] == [r[3] for r in rows]
    valid, quarantine = payloads.triage_responses(df)
    assert valid.count() + quarantine.count() == len(rows)


def test_cdx_rows(spark):
    body = [["timestamp", "original"], ["1", "a", "x"], ["2"], [], {"timestamp": "3", "original": "c"}, {"timestamp": "", "original": "d"}, 7, [4, "e"]]
    df = archive.cdx_rows(variants(spark, [body, [], {"a": 1}]).withColumnRenamed("v", "payload"))
    assert sorted((r.ord, r.timestamp, r.original) for r in df.collect()) == [(1, "1", "a"), (4, "3", "c"), (7, "4", "e")]


def test_jsonl_payload(spark):
    df = spark.createDataFrame([('{"a":1}\r\n\n  \x0b{"a":2}',)], "payload string")
    out = payloads.parse_jsonl_payload(df)
    assert [r[0] for r in out.select(F.try_variant_get("record", "$.a", "int")).collect()] == [1, 2]


def test_ruby_notes_are_not_part_of_the_text():
    from sitrep.functions import html

    page = "<div>a<ruby>b<rp>(</rp><rt>c<li>d</li></rt><rp>)</rp></ruby>e</div>"
    assert list(html.element_texts(page)) == ["abe", ""]
