"""Whole phases, SQL functions, and what no plan may contain."""

import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from checks.queries import QUERIES
from sitrep.operators import dedup, pages
from sitrep.plans import acquisition, dataset
from sitrep.sinks import commits
from sitrep.sinks import jsonl as sinks
from sitrep.sources.jsonl import read_jsonl

SF = "/root/testdata/sf0.001"
# Queries whose result is the read-back of something they wrote.
QUICK = sorted(set(QUERIES) - {"stream_scrub", "stream_dedup"})


@pytest.mark.parametrize("name", QUICK)
def test_no_pairs_of_everything(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, part, times",
    [
        ("api_result_items", "parseJson", 1),
        ("adaptation_chain", "ArrowEvalPython [", 2),
        ("keyword_hits", "ArrowEvalPython [", 1),
        ("dedup_exact", "Exchange hash", 1),
        ("dedup_exact", "FileScan", 1),
        ("adapt_envelope", "to_variant_object", 1),
        ("pii_redact", "Exchange", 0),
        ("category_names", "SortMergeJoin", 0),
    ],
)
def test_costly_steps_run_once(spark, name, part, times):
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")
    assert plan.count(part) == times


def test_filters_and_columns_reach_the_scan(spark):
    # Collapsing writes the rows it reads, so the scan is seen without it.
    index = dedup.cdx_select(I.index_rows(I.table(spark, SF, "events")), k=8, collapse=False)
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp" in plan and "value" not in plan
    rows = I.table(spark, SF, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    assert "EqualTo(o_orderstatus,F)" in rows._jdf.queryExecution().executedPlan().toString()


def test_sql_functions(spark):
    pages.register_sql(spark)
    I.og_pages(I.table(spark, SF, "pages")).createOrReplaceTempView("og_pages")
    found = spark.sql("SELECT p.url, o.image FROM og_pages p, LATERAL og_extract(p.html) o")
    wanted = QUERIES["og_extract"](spark, SF).select("source_url", "media_url")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    rows = spark.sql("SELECT p.page_id, r.row_no, r.text FROM og_pages p, LATERAL glossary_rows(p.html) r")
    assert rows.count() == QUERIES["glossary_rows"](spark, SF).count()


def test_validated_and_published(spark, tmp_path):
    docs = I.labelled(I.table(spark, SF, "documents")).selectExpr("doc_id", "text AS content", "language_inferred")
    redacted, gate = dataset.validated(docs, targets=("en", "de"))
    assert redacted.where("content LIKE '%[REDACTED_%'").count() > 0
    assert [r.passed for r in gate.collect()] == [True, True]
    artifact, target = str(tmp_path / "artifact"), str(tmp_path / "final")
    n = sinks.write_jsonl(redacted, artifact)
    assert sinks.publish_if_compliant(spark, artifact, target, targets=("en", "de"))
    assert read_jsonl(spark, commits.published(spark, target), redacted.schema).exceptAll(redacted).count() == 0 and n == docs.count()


def test_invalid_bytes_are_dropped_for_matching(spark):
    values = [b"fl\xffood", "é".encode(), None, b"", b"\xe2\x82"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, b binary")
    found = [r[0] for r in df.orderBy("i").select(acquisition.valid_text("b")).collect()]
    assert found == ["flood", "é", None, "", ""]


def test_news_from_bytes(spark):
    page = '<meta property="og:image" content="i"><meta property="og:description" content="é">'.encode() + b"<p>fl\xffOOD"
    rows = [("response", "http://a", "text/html", page), ("response", "http://b", "text/html", page.replace(b"OOD", b"ash")),
            ("request", "http://c", "text/html", page), ("response", "http://d", "TEXT/HTML", page)]
    records = spark.createDataFrame(rows, "rec_type string, target_uri string, content_type string, payload binary")
    words = spark.createDataFrame([("flood",)], "keyword string")
    found = acquisition.news_rows(records, words, F.timestamp_seconds(F.lit(0))).collect()
    # The page as a whole is not valid UTF-8, so it is read as Windows-1252.
    assert [(r.source_url, r.content, r.timestamp) for r in found] == [("http://a", "Ã©", "1970-01-01T00:00:00Z")]


def test_archive_comes_on_top_of_a_broken_feed(spark):
    post = '{"id":%s,"url":"%s","status":"published","tags":["flood"],"categories":[1,{"id":"5"}],"media":[{"src":"s"},8]}'
    live = [
        ("a", 200, "[" + post % (1, "live-a") + ",7]"),
        ("b", 200, "[" + post % (1, "live-b") + "]"),
        ("b", 403, "<html>"),
        ("c", 200, "<html>"),
        ("d", 200, "[]"),
        ("e", 404, "<html>"),
        ("f", 500, "<html>"),
    ]
    responses = spark.createDataFrame([(*r, "", "") for r in live], "deployment string, status int, body string, content_type string, fetched_ts string")
    old = [
        (d, ts, f"http://{d}/{ts}", 200, "", "[" + post % (1, f"old-{d}-{ts}") + ',{"url":"u"},{"url":"u"}]')
        for d in "abcdef" for ts in ("1", "2")
    ]
    snapshots = spark.createDataFrame(old, "deployment string, ts string, original string, status int, content_type string, body string")
    categories = spark.createDataFrame([(d, 1, "flood") for d in "abc"], "deployment string, category_id int, name string")
    media = spark.createDataFrame([("a", 8, "m8")], "deployment string, media_id int, url string")
    out = acquisition.crowd_reports(responses, snapshots, categories, media)
    rows = sorted((r.deployment, r.url, r.category_names, r.media_urls, r._archive_timestamp or "") for r in out.collect())
    names, none = ["flood", "Unknown(5)"], []
    assert rows == [
        ("a", "live-a", names, ["s", "m8"], ""),
        ("b", "live-b", names, ["s"], ""),
        ("b", "old-b-2", names, ["s"], "2"),
        ("b", "u", none, none, "2"),
        ("c", "old-c-2", names, ["s"], "2"),
        ("c", "u", none, none, "2"),
    ]


def test_few_texts_of_a_batch_are_python_objects_at_a_time(monkeypatch):
    import pyarrow as pa

    from sitrep.functions import matching

    class Spied:
        def __init__(self, values, most):
            self.values, self.most = values, most

        def __len__(self):
            return len(self.values)

        def slice(self, at, n):
            return Spied(self.values.slice(at, n), self.most)

        def to_pylist(self):
            self.most.append(len(self.values))
            return self.values.to_pylist()

    most = []
    texts = [None if i % 7 == 0 else f"t{i}" for i in range(1000)]
    assert list(matching._values(Spied(pa.array(texts), most))) == texts and max(most) <= matching.VALUES
