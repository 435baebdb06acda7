"""Operator inputs derived from the given tables. Each grows with its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitrep.functions import text
from sitrep.operators import scale

LANGS = ("de", "en", "es", "fr")
CODES = ("ent", "que", "der", "tion")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed_jsonl(df: DataFrame, label: str) -> str:
    """Write ``df`` as JSON Lines to a new shared path."""
    path = scale.scratch_dir(df.sparkSession, label)
    df.write.option("ignoreNullFields", "false").json(path)
    return path


def posts(docs: DataFrame) -> DataFrame:
    """Documents as posts with references of mixed types."""
    return docs.selectExpr(
        "doc_id",
        "source AS deployment",
        "concat('http://p/', doc_id) AS url",
        "CASE WHEN doc_id % 5 < 4 THEN 'published' ELSE 'draft' END AS status",
        "CASE doc_id % 3 WHEN 0 THEN array('flood','x') WHEN 1 THEN array('x') ELSE array('earthquake') END AS tags",
        """try_variant_get(parse_json(concat('[', doc_id % 30, ',{"id":"', doc_id % 11,
           '"},"9",{"id":2.7},null,{"id":null}]')), '$', 'array<variant>') AS categories""",
        """try_variant_get(parse_json(concat('[{"url":"","src":"http://s/', doc_id, '"},', doc_id % 300,
           ',{"id":"', doc_id % 7, '"},"9",0,{"original_url":"http://o/', doc_id,
           '","file_url":"f"}]')), '$', 'array<variant>') AS media""",
    )


def category_dictionary(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "concat('src', s_suppkey % 20) AS deployment",
        "cast(floor(s_suppkey / 20) AS int) AS category_id",
        "s_name AS name",
    )


def media_dictionary(pages: DataFrame) -> DataFrame:
    return pages.selectExpr(
        "concat('src', page_id % 20) AS deployment",
        "cast(floor(page_id / 20) AS int) AS media_id",
        "url",
    )


def responses(docs: DataFrame) -> DataFrame:
    """One landed response per document: bare lists, result objects and unusable ones."""
    return docs.selectExpr(
        "doc_id",
        "source AS deployment",
        "CASE WHEN doc_id % 14 = 0 THEN 404 WHEN doc_id % 7 = 0 THEN 403 ELSE 200 END AS status",
        "CASE WHEN doc_id % 5 < 2 THEN 'text/html' ELSE 'application/JSON; charset=utf-8' END AS content_type",
        """CASE doc_id % 5
             WHEN 0 THEN concat(' [{"id":', doc_id, '},7,{"id":', doc_id + 1, '}]')
             WHEN 1 THEN '<html>blocked</html>'
             WHEN 2 THEN '[1,2'
             WHEN 3 THEN concat('{"results":[{"id":', doc_id, '},"x"]}')
             ELSE CASE WHEN doc_id % 2 = 0 THEN 'null' ELSE '{"results":7}' END
           END AS body""",
    )


def index_rows(events: DataFrame) -> DataFrame:
    """Events as archive index rows."""
    return events.selectExpr(
        "concat('http://u/', user_id) AS url",
        "date_format(ts, 'yyyyMMddHHmmss') AS ts",
        "concat('http://u/', user_id, '/', event_id) AS original",
        "CASE WHEN event_id % 10 = 0 THEN 404 ELSE 200 END AS status",
        "CASE WHEN event_id % 3 = 0 THEN 'text/html' ELSE 'application/json' END AS mime",
        "event_type AS digest",
        "event_id AS ord",
    )


def keyword_table(benchmark: DataFrame) -> DataFrame:
    """First long word of every item."""
    word = text.first_long_word("text")
    return benchmark.select(word.alias("keyword")).where("keyword IS NOT NULL").distinct()


def word_table(benchmark: DataFrame) -> DataFrame:
    """All long words of all items."""
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: F.length(w) > 3)
    return benchmark.select(F.explode(words).alias("keyword")).distinct()


def lexicon(benchmark: DataFrame) -> DataFrame:
    """Terms with an intent and a framework code."""
    return benchmark.select(
        text.first_long_word("text").alias("term"),
        F.expr("concat('intent', item_id % 5)").alias("intent"),
        F.expr("concat('ESF-', item_id % 7)").alias("code"),
    ).where("term IS NOT NULL")


def ludp(docs: DataFrame) -> DataFrame:
    """Documents as language-use records; some have no term."""
    return docs.select(
        F.col("lang").alias("language_code"),
        F.expr("CASE WHEN doc_id % 5 = 0 THEN '' ELSE substring_index(text, ' ', 1) END").alias("term"),
        F.col("source").alias("language_name_local"),
        F.col("doc_id").alias("ord"),
    )


def labelled(docs: DataFrame) -> DataFrame:
    """Documents with code-switched and missing language labels."""
    return docs.withColumn(
        "language_inferred",
        F.expr(
            """CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN concat(upper(lang), '-en')
               WHEN lang = 'es' AND doc_id % 3 = 0 THEN 'sw' WHEN lang = 'fr' THEN 'mr-FR' ELSE lang END"""
        ),
    )


def with_personal_data(docs: DataFrame) -> DataFrame:
    """Documents with further numbers and addresses."""
    return docs.select(
        "doc_id",
        F.expr(
            """concat(text, CASE doc_id % 6 WHEN 0 THEN ' 12 34 56 78 90 12 34 ' WHEN 1 THEN ' 4111 1111 1111 1111'
               WHEN 2 THEN concat(' user.', doc_id, '+x@mail-host.example.org.') WHEN 3 THEN ' 10.0.0.255 +254712345678'
               ELSE '' END)"""
        ).alias("text"),
    )


def og_pages(pages: DataFrame) -> DataFrame:
    """Pages with OpenGraph tags put in front."""
    return pages.select(
        "page_id",
        "url",
        F.expr(
            """concat('<meta property="og:title" content="t', page_id, '">',
               CASE WHEN page_id % 3 = 0 THEN concat('<META content=\\'http://img/', page_id, '\\' property="og:image"/>') ELSE '' END,
               CASE WHEN page_id % 2 = 0 THEN '<meta property="og:description">'
                    WHEN page_id % 5 = 0 THEN '' ELSE '<meta property="og:description" content="a &amp; b">' END,
               html)"""
        ).alias("html"),
    )


def story_pages(pages: DataFrame) -> DataFrame:
    """Every third page with its own words as OpenGraph description, put in front."""
    return pages.select(
        "page_id",
        "url",
        F.expr(
            r"""concat(CASE WHEN page_id % 3 = 0 THEN concat('<meta property="og:image" content="i"><meta property="og:description" content="page ',
                page_id, ' ', regexp_replace(regexp_replace(html, '<[^>]*>', ' '), '[^a-z]+', ' '), '">') ELSE '' END, html)"""
        ).alias("html"),
    )


def report_responses(docs: DataFrame) -> DataFrame:
    """Documents as feed responses, a post with the whole text each; two feeds are blocked."""
    return labelled(docs).selectExpr(
        "source AS deployment",
        "'' AS fetched_ts",
        "CASE WHEN source IN ('src16', 'src17') THEN 403 ELSE 200 END AS status",
        "'application/json' AS content_type",
        """to_json(named_struct('results', array(named_struct('id', doc_id, 'url', concat('http://p/', doc_id), 'content', text,
           'language', language_inferred, 'status', 'published', 'tags', array('flood'), 'categories', array(doc_id % 9),
           'media', array(doc_id % 15))))) AS body""",
    )


def report_snapshots(benchmark: DataFrame) -> DataFrame:
    """Items as archived responses of the feeds."""
    return benchmark.selectExpr(
        "concat('src', item_id % 20) AS deployment",
        "lpad(item_id, 14, '0') AS ts",
        "concat('http://o/', item_id) AS original",
        "200 AS status",
        "'' AS content_type",
        "to_json(array(named_struct('id', item_id, 'url', concat('http://c/', item_id), 'content', text))) AS body",
    )


def glossary_pages(docs: DataFrame) -> DataFrame:
    """Documents as small pages with nested rows, hidden text and tags left open."""
    return docs.select(
        "doc_id",
        F.expr(
            """concat('<div>top ', doc_id, '<ul><li>one <b>', coalesce(source, ''), '</b></li><li>two</ul> rest</div>',
               '<script><div>no</div></script><table><TR><td>a &amp; b</td> <td>c', doc_id % 7,
               '</td></tr></table><div>x<rp>(</rp><rt>y', doc_id, '</rt><rp>)</rp><!-- z --> <style>p</style>end',
               CASE WHEN doc_id % 2 = 0 THEN '</div>' ELSE '<li>' END)"""
        ).alias("html"),
    )


def warc_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages as web-archive records: a request and a response each."""
    return pages.select(
        F.expr(
            f"""CASE WHEN page_id % 5 = 0 THEN 'image/png' ELSE 'text/html; charset=utf-8' END"""
        ).alias("mime"),
        "url",
        F.col(html).alias("html"),
    ).select(
        F.expr(
            r"""concat('HTTP/1.1 200 OK\r\nContent-Type: ', mime, '\r\n\r\n', html)"""
        ).alias("block"),
        "url",
    ).select(
        F.expr(
            r"""concat('WARC/1.0\r\nWARC-Type: request\r\nWARC-Target-URI: ', url,
                '\r\nContent-Length: 18\r\n\r\nGET / HTTP/1.1\r\n\r\n\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: ', url,
                '\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: ', octet_length(block),
                '\r\n\r\n', block)"""
        ).alias("value")
    )


def landed_warc(pages: DataFrame, html: str = "html") -> str:
    """Write pages as gzip web-archive segments to a new shared path."""
    path = scale.scratch_dir(pages.sparkSession, "warc")
    warc_text(pages, html).write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path)
    return path
