"""Operators on edge rows, hot keys and forced plans, against plain Python."""

import json
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from checks.oracle import ORACLE
from checks.queries import QUERIES
from sitrep import constants as C
from sitrep.functions import html, matching
from sitrep.operators import adapt, audit, dedup, keywords, lookups, pages, scale
from sitrep.operators.redaction import redact_columns, redact_records
from sitrep.sinks import jsonl as sinks
from tests.compare import connection, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- plans for large sides give the same result ------------------------------


@pytest.mark.parametrize("name", ["category_names", "media_urls", "source_fallback", "crowd_reports"])
def test_large_lookup_plan(spark, monkeypatch, name):
    monkeypatch.setattr(scale, "MAX_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = QUERIES[name](spark, SF)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan and "Generate explode(sequence" not in plan
        assert spark_rows(found) == sql_rows(connection(SF), ORACLE[name])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["keyword_filter", "keyword_hits", "extract_intent", "map_taxonomy", "adaptation_chain"])
@pytest.mark.parametrize("held", [1, 200_000])
def test_large_term_lists(spark, monkeypatch, name, held):
    monkeypatch.setattr(matching, "MAX_TERMS", 7)
    monkeypatch.setattr(matching, "HELD_CHARS", held)
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(connection(SF), ORACLE[name])


def test_large_term_lists_do_not_rewrite_rows(spark, monkeypatch):
    written, scratch = [], scale.scratch_dir
    monkeypatch.setattr(matching, "MAX_TERMS", 7)
    monkeypatch.setattr(scale, "scratch_dir", lambda spark, label: written.append(label) or scratch(spark, label))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["Ab w17 c", None, "", "w3", "x"])], "id int, text string")
    terms = spark.createDataFrame([(f"w{i}", f"l{i % 4}") for i in range(40)] + [(None, "l"), ("w3", None)], "term string, label string")
    hit = keywords.keyword_filter(rows, "text", terms, "term")
    assert values(hit.select("id")) == [(0,), (3,)]
    labelled = keywords.with_matched_labels(rows, "text", terms, "term", "label", "found")
    # "w17" holds "w1" as well.
    assert values(labelled.select("id", "found")) == [(0, ["l1"]), (1, []), (2, []), (3, ["l3"]), (4, [])]
    assert written == ["terms", "term-parts"] * 2
    everything = keywords.keyword_filter(rows, "text", terms.unionByName(spark.createDataFrame([("", "e")], "term string, label string")), "term")
    assert values(everything.select("id")) == [(0,), (2,), (3,), (4,)]


@pytest.mark.parametrize("name", ["batch_assign", "page_of", "archive_dedup", "terms_by_lang", "dedup_exact", "keyword_hits"])
@pytest.mark.parametrize("partitions", ["1", "23"])
def test_partition_count_does_not_matter(spark, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(connection(SF), ORACLE[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- hot keys ------------------------------------------------------------------


def hot_index(spark):
    events = I.index_rows(I.table(spark, SF_MORE, "events"))
    url = F.when(F.col("ord") % 3 == 0, "hot").when(F.col("ord") % 17 == 0, None).otherwise(F.col("url"))
    digest = F.when(F.col("ord") % 2 == 0, None).otherwise(F.col("digest"))
    return events.withColumns({"url": url, "digest": digest})


def test_hot_group_is_cut_and_collapses_the_same(spark):
    rows = hot_index(spark)
    wanted, last = [], {}
    for r in sorted(rows.collect(), key=lambda r: (r.ts, r.ord)):
        if r.url not in last or last[r.url] != r.digest:
            wanted.append(r.ord)
        last[r.url] = r.digest
    for cuts in (1, 7, 100, None):
        assert sorted(r.ord for r in dedup.cdx_collapse(rows, cuts=cuts).collect()) == sorted(wanted)


def test_hot_group_spreads_over_tasks_without_a_collect(spark, monkeypatch):
    rows = hot_index(spark)
    ranged = scale.in_ranges(rows, ["url", "ts", "ord"], 40)
    largest, total = ranged.groupBy("__range").count().agg(F.max("count"), F.sum("count")).first()
    assert ranged.where("url = 'hot'").select("__range").distinct().count() > 10
    assert largest < 3 * total / 40
    monkeypatch.setattr(type(rows), "collect", lambda self: pytest.fail("rows come to the driver"))
    plan = dedup.cdx_collapse(rows, cuts=40)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__range" in plan and "hashpartitioning(url" not in plan


def test_empty_and_single_rows_collapse(spark):
    empty = spark.createDataFrame([], "url string, ts string, ord int, digest string")
    assert dedup.cdx_collapse(empty).count() == 0
    one = spark.createDataFrame([(None, None, None, None)], empty.schema)
    assert dedup.cdx_collapse(one).collect() == one.collect()


def test_ranges_are_even_and_ordered(spark):
    rows = hot_index(spark).withColumn("r", F.lit(0))
    ranged = scale.in_ranges(rows, ["ts", "ord"], 16).withColumn("r", F.col("__range"))
    sizes = [r["count"] for r in ranged.groupBy("r").count().collect()]
    assert 14 <= len(sizes) <= 18 and max(sizes) < 3 * rows.count() / 16
    ends = ranged.groupBy("r").agg(F.min(F.struct("ts", "ord")).alias("a"), F.max(F.struct("ts", "ord")).alias("b"))
    ends = [(tuple(r.a), tuple(r.b)) for r in ends.orderBy("r").collect()]
    assert all(one[1] < two[0] for one, two in zip(ends, ends[1:]))


@pytest.mark.parametrize("order", [["t"], ["v", "t"], ["n", "t"], ["n"]])
def test_numbers_follow_the_order(spark, order):
    rows = [(f"k'{i:05d}\\", (i * 7919) % 13, i if i % 50 else None) for i in range(3000)]
    if order == ["n"]:
        rows = [r for i, r in enumerate(rows) if r[2] is not None or i == 0]
    df = spark.createDataFrame(rows, "t string, v int, n int").repartition(7)
    found = scale.global_row_number(df, order, "row", cuts=40).orderBy("row").collect()
    key = lambda r: [(r[c] is not None, r[c] or 0) if c != "t" else r[c] for c in order]
    assert [r["row"] for r in found] == list(range(1, len(rows) + 1))
    assert [key(r) for r in found] == sorted(key(r) for r in found)


def test_group_limit_runs_before_the_shuffle(spark):
    plan = QUERIES["archive_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_hot_lookup_key_is_split(spark, monkeypatch):
    monkeypatch.setattr(scale, "MAX_ROWS", 0)
    left = spark.range(0, 300_000, numPartitions=12).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id", "sha2(string(id), 256) AS x")
    right = spark.range(0, 300_000).selectExpr("id AS k", "id * 2 AS v")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = scale.lookup_join(left, right, ["k"])
        kept = joined.select("k", "v", "x", F.spark_partition_id().alias("p")).collect()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(kept) == 300_000 and all(r.v == 2 * r.k for r in kept)
    assert len({r.p for r in kept if r.k == 7}) > 2


def test_dictionary_entries_without_id_and_repeated(spark, monkeypatch):
    posts = spark.createDataFrame([("a", "[1,2]")], "deployment string, c string").selectExpr(
        "deployment", "try_variant_get(parse_json(c), '$', 'array<variant>') AS categories"
    )
    rows = [("a", 1, "zulu", 0), ("a", 1, "alpha", 1), ("a", None, "none", 2)]
    dictionary = spark.createDataFrame(rows, "deployment string, category_id int, name string, entry_order int")
    for limit in (scale.MAX_ROWS, 0):
        monkeypatch.setattr(scale, "MAX_ROWS", limit)
        assert lookups.with_category_names(posts, dictionary).first().category_names == ["alpha", "Unknown(2)"]


def test_pages_by_key(spark):
    df = spark.range(0, 10).selectExpr("id % 3 AS a", "id AS b")
    pages, after = [], None
    while page := dedup.page_after(df, ["a", "b"], after, 4).collect():
        pages += map(tuple, page)
        after = page[-1]
    assert pages == sorted(map(tuple, df.collect()))


def test_results_without_a_column_are_quarantined(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "a bigint, b bigint")
    ok, failed = adapt.adapt(df, "filter_noise", lambda batch, operation: batch.drop(columns="b"))
    assert ok.count() == 0 and failed.count() == 2


# --- lookups ---------------------------------------------------------------------


def posts(spark, rows):
    df = spark.createDataFrame([(d, json.dumps(r)) for d, r in rows], "deployment string, j string")
    return df.select("deployment", F.expr("try_variant_get(parse_json(j), '$', 'array<variant>')").alias("categories"))


@pytest.mark.parametrize("limit", [scale.MAX_ROWS, 0])
def test_names_keep_order_and_copies(spark, monkeypatch, limit):
    monkeypatch.setattr(scale, "MAX_ROWS", limit)
    dim = spark.createDataFrame([("d", 1, "one"), ("d", 2, "two"), ("e", 1, "eins"), ("d", 2, "two")], "deployment string, category_id int, name string")
    rows = [("d", [2, 1, {"id": "2"}, 9, "x"]), ("d", [2, 1, {"id": "2"}, 9, "x"]), ("e", [1, 2]), ("f", [1]), ("d", []), (None, [1])]
    named = lookups.with_category_names(posts(spark, rows), dim)
    assert sorted(r.category_names for r in named.collect()) == sorted(
        [["two", "one", "two", "Unknown(9)"]] * 2 + [["eins", "Unknown(2)"], ["Unknown(1)"], [], ["Unknown(1)"]]
    )


def test_fallback_quirk_and_dedup(spark):
    live = spark.createDataFrame([("a", 1), ("b", 2)], "deployment string, id int")
    old = spark.createDataFrame([("a", 1), ("a", 5), ("c", 3)], "deployment string, id int")
    assert values(lookups.source_fallback(live, old)) == [("a", 1), ("b", 2), ("c", 3)]
    broken = live.where("deployment = 'a'").select("deployment")
    assert values(lookups.source_fallback(live, old, also=broken)) == [("a", 1), ("a", 1), ("a", 5), ("b", 2), ("c", 3)]
    assert values(lookups.source_fallback(live, old, also=broken, dedup=["id"])) == [("a", 1), ("a", 5), ("b", 2), ("c", 3)]


def test_newest_dictionary_snapshot(spark):
    rows = [("a", "2", 1, "new"), ("a", "1", 1, "old"), ("b", "1", 4, "x")]
    df = spark.createDataFrame(rows, "deployment string, ts string, category_id int, name string")
    assert [r.name for r in lookups.first_non_empty_snapshot(df).orderBy("name").collect()] == ["new", "x"]


# --- keywords ----------------------------------------------------------------------


def texts(spark, items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)], "i int, t string")


@pytest.mark.parametrize("extra", [0, 40])
def test_substring_semantics(spark, extra):
    df = texts(spark, ["The MARKET", "swahili", "ÉCOLE", "", None, "mar"])
    words = ["mar", "école", *[f"zz{i}" for i in range(extra)]]
    table = spark.createDataFrame([(w,) for w in words], "keyword string")
    assert [r.i for r in keywords.keyword_filter(df, "t", table).orderBy("i").collect()] == [0, 2, 5]
    assert values(keywords.keyword_hits(df, "t", table)) == [("mar", 2), ("école", 1)]
    empty = table.where("false")
    assert keywords.keyword_filter(df, "t", empty).count() == 0
    everything = spark.createDataFrame([("",), ("x",)], "keyword string")
    assert keywords.keyword_filter(df, "t", everything).count() == 5


@pytest.mark.parametrize("extra", [0, 40])
def test_overlapping_terms_and_labels(spark, extra):
    df = texts(spark, ["flooding", "ood", "none", None])
    rows = [("flood", "B"), ("ood", "A"), ("flooding", "C"), ("FLOOD", "A")] + [(f"q{i}q", "Z") for i in range(extra)]
    lexicon = spark.createDataFrame(rows, "term string, code string")
    found = adapt.map_taxonomy(df, lexicon, "t").orderBy("i").collect()
    assert [r.codes for r in found] == [["A", "B", "C"], ["A"], [], []]


def test_glossary_terms_token_mode(spark):
    rows = texts(spark, ["Market prices mar", "swahili hello", "abc", "mar x"])
    loose = keywords.glossary_terms(rows, col="t").select("i", "lang", "term")
    assert values(loose) == [(0, "mar", "market"), (1, "swa", "swahili")]
    strict = keywords.glossary_terms(rows, col="t", token=True).select("i", "lang")
    assert values(strict) == [(0, "mar")]


def test_terms_keep_first_place_and_case(spark):
    rows = [("swa", "Maji", 3), ("swa", "maji", 1), ("swa", "Maji", 2), ("amh", "Maji", 9)]
    df = spark.createDataFrame(rows, "lang string, term string, ord bigint")
    assert values(keywords.terms_by_lang(df)) == [("amh", "Maji", 9), ("swa", "Maji", 2), ("swa", "maji", 1)]
    filled = keywords.with_fallback(df)
    assert Counter(r.lang for r in filled.collect()) == {"swa": 3, "amh": 1, "tgl": 7, "ceb": 7}
    present = keywords.with_fallback(df.withColumn("lang", F.lit("tgl")))
    assert Counter(r.lang for r in present.collect()) == {"tgl": 4, "ceb": 7}


def test_glossary_rows_against_one_page_at_a_time(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    wanted = sorted((r.page_id, n, t) for r in df.collect() for n, t in enumerate(html.element_texts(r.html)))
    assert values(keywords.glossary_rows(df, ["page_id"])) == sorted(wanted, key=repr)


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("<div>a<div>b</div>c</div>", ["abc", "b"]),
        ("<ul><li>x<li>y</ul>z<li>w", ["xy", "y", "w"]),
        ("<div>a<script>no</script><style>no</style><!-- no -->b &amp; c</div>", ["ab & c"]),
        ("<table><tr><td>1</td><td>2</td></tr></table>", ["12"]),
        ("<div>a</p>b<br>c<img src=x/>d</div></div>e", ["abcd"]),
        ("<template><div>no</div></template><div> \n </div>", ["", "\n"]),
        ("<DIV>a<p>b</DIV>c", ["ab"]),
        ("", []),
    ],
)
def test_element_texts(page, wanted):
    assert list(html.element_texts(page)) == wanted


@pytest.mark.parametrize(
    "page, wanted",
    [
        ('<meta property="og:image" content="i"><meta property="og:description" content="d">', ("i", "d", "")),
        ('<meta property="og:image"><meta property=og:description><meta property="og:title" content="t">', ("", "", "t")),
        ('<meta property="og:image" content="1"><meta property="og:image" content="2"><META content="a &amp; b" PROPERTY="og:description"/>', ("1", "a & b", "")),
        ('<meta property="og:image" content="i">', None),
        ('<meta name="og:image" content="i"><meta property="og:description" content="d">', None),
        ('<!-- <meta property="og:image"> --><meta property="og:description">', None),
        ('<meta property="og&#58;image" content="i"><meta property="og:description" content="d">', ("i", "d", "")),
        ('<script><meta property="og:image"></script><meta property="og:description">', None),
    ],
)
def test_open_graph(spark, page, wanted):
    assert html.open_graph(page) == wanted
    for value in (page, page.encode(), b"\xef\xbb\xbf" + page.encode(), page.encode("utf-16")):
        df = spark.createDataFrame([("u", value)], "url string, html " + ("string" if isinstance(value, str) else "binary"))
        rows = pages.og_extract(df, now=F.timestamp_seconds(F.lit(0))).collect()
        if wanted is None:
            assert rows == []
        else:
            assert tuple(rows[0]) == ("u", "common_crawl_news", wanted[1], wanted[2], [wanted[0]], "1970-01-01T00:00:00Z")


def test_page_encodings():
    assert html.decode_page("é".encode()) == "é"
    assert html.decode_page("é".encode("latin-1")) == "é"
    assert html.decode_page(b'<meta charset="iso-8859-5">\xd0') == '<meta charset="iso-8859-5">а'
    assert html.decode_page(b'<meta charset="nonsense">ok') == '<meta charset="nonsense">ok'


# --- dedup ---------------------------------------------------------------------------


def test_dedup_exact_keeps_null_texts(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None), (6, "#4")], "id int, t string")
    assert [r.id for r in dedup.dedup_exact(df, "t", "id").orderBy("id").collect()] == [1, 2, 4, 5, 6]


def test_top_k_per_url(spark):
    rows = [("u", str(t), t, 200, "application/json", f"d{t}") for t in range(20)] + [("v", "1", 50, 200, "text/html", "d")]
    df = spark.createDataFrame(rows, "url string, ts string, ord int, status int, mime string, digest string")
    found = [r.ord for r in dedup.cdx_select(df.withColumn("ts", F.lpad("ts", 14, "0")), k=3).collect()]
    assert sorted(found) == [17, 18, 19]


# --- adaptation -------------------------------------------------------------------------


def test_failed_batches_are_kept(spark):
    sizes = spark.sparkContext.accumulator(0)

    def refuse(batch: pd.DataFrame, operation: str) -> pd.DataFrame:
        sizes.add(1)
        assert operation == "extract_intent" and len(batch) <= 50
        assert {C.PROMPT_COLUMN, C.SOURCE_COLUMN, C.OPERATION_COLUMN} <= set(batch.columns)
        if (batch["i"] == 60).any():
            raise RuntimeError("no")
        return batch[batch["i"] % 2 == 0].assign(t="done")

    df = texts(spark, [f"t{i}" for i in range(120)]).coalesce(1).orderBy("i").coalesce(1)
    ok, failed = adapt.adapt(df, "extract_intent", refuse)
    assert sizes.value == 3
    assert ok.columns == ["i", "t"]
    assert sorted(r.i for r in ok.collect()) == [i for i in range(120) if i % 2 == 0 and not 50 <= i < 100]
    rows = failed.collect()
    assert sorted(json.loads(r[C.SOURCE_COLUMN])["i"] for r in rows) == list(range(50, 100))
    assert {(r.operation, r[adapt.ERROR_COLUMN]) for r in rows} == {("extract_intent", "RuntimeError: no")}
    assert sizes.value == 3


def test_whole_numbers_and_types_survive(spark):
    big = 2**62 + 1
    df = spark.createDataFrame(
        [(big, None, [1, None], True, 1.5), (None, "x", None, None, None)],
        "a bigint, b string, c array<int>, d boolean, e double",
    ).withColumn("t", F.timestamp_micros(F.lit(1)))
    ok, failed = adapt.adapt(df, "filter_noise")
    assert values(ok) == values(df) and failed.count() == 0
    assert ok.schema.simpleString() == df.schema.simpleString()


def test_results_that_do_not_fit_are_quarantined(spark):
    df = spark.createDataFrame([(1,), (2,)], "a bigint")
    ok, failed = adapt.adapt(df, "filter_noise", lambda batch, operation: batch.assign(a="text"))
    assert ok.count() == 0 and failed.count() == 2


def test_variant_records_pass_through(spark):
    df = spark.createDataFrame([('{"b":1,"a":{"c":[1,"x"]}}',), ('{"title":"t"}',)], "j string").select(F.parse_json("j").alias("record"))
    enveloped = adapt.envelope(df, "filter_noise").select(C.PROMPT_COLUMN, C.SOURCE_COLUMN)
    assert values(enveloped) == [("t", '{"title":"t"}'), ('{"a":{"c":[1,"x"]},"b":1}', '{"a":{"c":[1,"x"]},"b":1}')]
    ok, failed = adapt.adapt_steps(df, [("filter_noise", adapt.identity), ("map_fema_esf", adapt.identity)])
    assert sorted(r[0] for r in ok.select(F.to_json("record")).collect()) == ['{"a":{"c":[1,"x"]},"b":1}', '{"title":"t"}']
    assert failed.count() == 0


def test_rebatch_crosses_arrow_batches():
    frames = [pd.DataFrame({"i": range(a, b)}) for a, b in ((0, 3), (3, 10), (10, 11))]
    assert [list(f["i"]) for f in adapt._rebatch(iter(frames), 4)] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10]]


def test_redact_columns_ignores_absent_names(spark):
    df = spark.createDataFrame([("a@b.c", "a@b.c", None)], "content string, other string, title string")
    assert tuple(redact_columns(df).first()) == ("[REDACTED_EMAIL]", "a@b.c", None)
    assert redact_columns(df.select("other")).first()[0] == "a@b.c"


def test_redact_records_of_any_shape(spark):
    records = [
        '{"content":"a@b.c","title":"10.0.0.1 é","z":[1,{"content":"a@b.c"}],"n":null}',
        '{"content":5,"title":""}', '{"title":null,"x":"a@b.c"}', '[1,"a@b.c"]', '"a@b.c"', '{"content":["a@b.c"]}',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, j string").select("i", F.parse_json("j").alias("record"))
    found = [r[0] for r in redact_records(df).orderBy("i").select(F.to_json("record")).collect()]
    assert json.loads(found[0]) == {
        "content": "[REDACTED_EMAIL]", "title": "[REDACTED_IP_ADDRESS] é", "z": [1, {"content": "a@b.c"}], "n": None,
    }
    assert [json.loads(f) for f in found[1:]] == [json.loads(r) for r in records[1:]]


# --- audit -----------------------------------------------------------------------------------


@pytest.mark.parametrize("hits, total, passed", [(5, 100, True), (499, 10_000, False), (0, 10, False), (0, 0, False)])
def test_gate(spark, hits, total, passed):
    df = spark.range(total).select(F.when(F.col("id") < hits, "SW-en").otherwise("en").alias("language_inferred"))
    assert audit.audit_gate(df, targets=("swa",)).first()["compliant"] is passed


def test_shares_sum_to_one_and_empty_is_empty(spark):
    docs = I.labelled(I.table(spark, SF, "documents"))
    assert abs(sum(r.share for r in audit.lang_distribution(docs).collect()) - 1) < 1e-12
    assert audit.lang_distribution(docs.where("false")).count() == 0


def test_distribution_scans_once(spark):
    df = audit.lang_distribution(I.table(spark, SF, "documents"), "lang")
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_observed_counts(spark):
    df, seen = audit.observed(spark.range(10))
    df.collect()
    assert seen.get["n"] == 10


def test_dictionary_rows_hold_a_bounded_part(spark):
    rows = [("tgl", f"t{i:03d}", (i * 7) % 250) for i in range(250)] + [("ceb", "x", 1), ("zz", "no", 1), ("ceb", "w", 1)]
    terms = spark.createDataFrame(rows, "lang string, term string, ord bigint")
    found = sinks.dictionary_rows(terms, ("tgl", "ceb", "mar"), per_row=40).collect()
    by = {(r.lang, r.part): r.keywords for r in found}
    assert len(by) == len(found) and max(map(len, by.values())) == 40
    wanted = [t for _, t, _ in sorted((r for r in rows if r[0] == "tgl"), key=lambda r: (r[2], r[1]))]
    assert [t for p in range(7) for t in by["tgl", p]] == wanted
    assert by["ceb", 0] == ["w", "x"] and by["mar", 0] == [] and len(found) == 9
    plan = sinks.dictionary_rows(terms, ("tgl",))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(lang" in plan and "part" in plan
