r"""The registered queries in DuckDB SQL, written from the tables, not from the Spark code."""

FIRST_LONG = r"list_filter(string_split_regex(lower({0}), '\s+'), lambda x: length(x) > 3)[1]"


def first_long(col: str) -> str:
    return FIRST_LONG.format(col)


KEYWORDS = f"(SELECT DISTINCT {first_long('text')} AS keyword FROM benchmark)"
LEXICON = f"""(SELECT {first_long('text')} AS term, 'intent' || (item_id % 5) AS intent,
    'ESF-' || (item_id % 7) AS code FROM benchmark)"""

PII_TEXT = """(SELECT doc_id, text || CASE doc_id % 6 WHEN 0 THEN ' 12 34 56 78 90 12 34 '
    WHEN 1 THEN ' 4111 1111 1111 1111' WHEN 2 THEN ' user.' || doc_id || '+x@mail-host.example.org.'
    WHEN 3 THEN ' 10.0.0.255 +254712345678' ELSE '' END AS text FROM documents)"""
PATTERNS = {
    "EMAIL": r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+",
    "PHONE": r"(\+?\d{1,3}[-.\s]?)?(\(?\d{2,4}\)?[-.\s]?)?\d{3,4}[-.\s]?\d{4}",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "CREDIT_CARD": r"\b(?:\d[ -]*?){13,16}\b",
}


def redacted(col: str, *kinds: str) -> str:
    for kind in kinds or PATTERNS:
        col = f"regexp_replace({col}, '{PATTERNS[kind]}', '[REDACTED_{kind}]', 'g')"
    return col


LABELLED = """(SELECT *, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 4 = 0 THEN upper(lang) || '-en'
    WHEN lang = 'es' AND doc_id % 3 = 0 THEN 'sw' WHEN lang = 'fr' THEN 'mr-FR' ELSE lang END AS language_inferred
    FROM documents)"""


def primary(col: str) -> str:
    base = f"split_part(lower(coalesce({col}, 'unknown')), '-', 1)"
    return f"CASE {base} WHEN 'sw' THEN 'swa' WHEN 'am' THEN 'amh' WHEN 'tl' THEN 'tgl' WHEN 'mr' THEN 'mar' ELSE {base} END"


DIST = f"""(SELECT primary_lang, n, n / sum(n) OVER ()::DOUBLE AS share FROM
    (SELECT {primary('language_inferred')} AS primary_lang, count(*) AS n FROM {LABELLED} GROUP BY 1))"""

POSTS = """(SELECT doc_id, source AS deployment, CASE WHEN doc_id % 5 < 4 THEN 'published' ELSE 'draft' END AS status,
    [doc_id % 30, doc_id % 11, 2] AS category_ids FROM documents)"""
MEDIA_DIM = "(SELECT 'src' || (page_id % 20) AS deployment, page_id // 20 AS media_id, url FROM pages)"
CATEGORY_DIM = "(SELECT 'src' || (s_suppkey % 20) AS deployment, s_suppkey // 20 AS category_id, s_name AS name FROM supplier)"

INDEX = """(SELECT 'http://u/' || user_id AS url, strftime(ts, '%Y%m%d%H%M%S') AS ts,
    CASE WHEN event_id % 10 = 0 THEN 404 ELSE 200 END AS status,
    CASE WHEN event_id % 3 = 0 THEN 'text/html' ELSE 'application/json' END AS mime,
    event_type AS digest, event_id AS ord FROM events)"""


def collapsed(rows: str) -> str:
    return f"""(SELECT * FROM (SELECT *, lag(digest) OVER w AS prev, row_number() OVER w AS rn FROM {rows}
        WINDOW w AS (PARTITION BY url ORDER BY ts, ord)) WHERE rn = 1 OR digest IS DISTINCT FROM prev)"""


LUDP = """(SELECT lang AS language_code, CASE WHEN doc_id % 5 = 0 OR split_part(text, ' ', 1) = '' THEN source
    ELSE split_part(text, ' ', 1) END AS term, doc_id AS ord FROM documents)"""

ORACLE = {
    # sources
    "scan_jsonl": "SELECT event_id, user_id, event_type, value, props FROM events",
    "scan_jsonl_multi": """SELECT o_orderkey AS key, o_orderpriority AS label, '' AS extra FROM orders
        UNION ALL SELECT c_custkey, '', c_name FROM customer""",
    "json_triage": """SELECT doc_id, CASE WHEN doc_id % 14 = 0 THEN 'failed' WHEN doc_id % 7 = 0 THEN 'blocked' WHEN doc_id % 5 = 0 THEN 'ok'
        WHEN doc_id % 5 = 1 THEN 'not_json' WHEN doc_id % 5 = 2 THEN 'invalid_json' ELSE 'ok' END AS reason FROM documents""",
    "api_result_items": """SELECT doc_id, 0::BIGINT AS item_pos, doc_id AS item_id FROM documents
          WHERE doc_id % 7 <> 0 AND doc_id % 5 IN (0, 3)
        UNION ALL SELECT doc_id, 1, doc_id + 1 FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 5 = 0""",
    "ludp_records": """SELECT doc_id, 0::BIGINT AS item_pos, lang AS language_code, 't' || doc_id AS term,
          source AS language_name_local FROM documents WHERE doc_id % 4 = 0
        UNION ALL SELECT doc_id, 0, lang, 'a', '' FROM documents WHERE doc_id % 4 = 1
        UNION ALL SELECT doc_id, 1, 'xx', 'b' || doc_id, '' FROM documents WHERE doc_id % 4 = 1""",
    "keywords_flatten": f"""SELECT DISTINCT {first_long('text')} AS keyword FROM documents
        WHERE {first_long('text')} IS NOT NULL""",
    "warc_paths": "SELECT 'https://data.commoncrawl.org/' || trim(url) AS path FROM pages WHERE trim(url) <> '' ORDER BY page_id LIMIT 50",
    "warc_scan": """SELECT 'response' AS rec_type, url AS target_uri,
          CASE WHEN page_id % 5 = 0 THEN 'image/png' ELSE 'text/html; charset=utf-8' END AS content_type,
          strlen(html)::BIGINT AS n_bytes, md5(html) AS digest, '' AS error FROM pages
        UNION ALL SELECT 'request', url, '', 18, md5('GET / HTTP/1.1' || chr(13) || chr(10) || chr(13) || chr(10)), '' FROM pages""",
    "warc_pieces": """SELECT url AS target_uri, greatest(1, (strlen(html) + 999) // 1000)::BIGINT AS n_pieces, 1::BIGINT AS n_last, md5(html) AS digest
        FROM pages""",
    "warc_lookup": """SELECT url AS target_uri, CASE WHEN page_id % 5 = 0 THEN 'image/png' ELSE 'text/html; charset=utf-8' END AS content_type,
        md5(html) AS digest, '' AS error FROM pages WHERE length(url) % 7 = 0""",
    "cdx_rows": """SELECT event_id, 1::BIGINT AS ord, '2024' || event_id AS timestamp, 'http://a/' || user_id AS original FROM events
        UNION ALL SELECT event_id, 3, event_id::VARCHAR, 'http://b/' || user_id FROM events""",
    "parse_jsonl_payload": """SELECT event_id, 0::BIGINT AS line_no, event_id AS id, '' AS t FROM events
        UNION ALL SELECT event_id, 3, user_id, event_type FROM events""",
    # sinks
    "export_jsonl": "SELECT doc_id, lang, source, text FROM documents",
    "keywords_export": f"""SELECT lang, part, string_agg(term, '|' ORDER BY ord, term) AS keywords FROM (
          SELECT *, CAST((row_number() OVER (PARTITION BY lang ORDER BY ord, term) - 1) // 20 AS INT) AS part FROM (
            SELECT lang, {first_long('text')} AS term, min(doc_id) AS ord FROM documents GROUP BY 1, 2 HAVING term IS NOT NULL))
          GROUP BY lang, part UNION ALL SELECT 'swa', 0, ''""",
    # projections
    "ref_ids": """SELECT doc_id, concat_ws('|', doc_id % 30, doc_id % 11, 2) AS category_ids,
        concat_ws('|', doc_id % 300, doc_id % 7, 0) AS media_ids FROM documents""",
    "media_url_embedded": "SELECT doc_id, 'http://s/' || doc_id || '|http://o/' || doc_id AS media_urls FROM documents",
    "archive_url": """SELECT page_id, 'https://web.archive.org/web/' || (20240101000000 + page_id) || 'id_/' ||
        replace(replace(replace(replace(replace(replace(url_encode(url || '&q=ü *+~%41'), '%3A', ':'), '%2F', '/'),
        '%3F', '?'), '%26', '&'), '%3D', '='), '%25', '%') AS url FROM pages""",
    "prompt_coalesce": """SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text WHEN doc_id % 2 <> 0 THEN source
        ELSE '{"doc_id":' || doc_id || ',"text":"","title":null}' END AS prompt FROM documents""",
    "canonical_json": """SELECT event_id, '{"a":{"b":[{"p":' || user_id || ',"q":1},null],"y":"é' || event_type ||
        '"},"z":' || event_id || '}' AS record FROM events""",
    "adapt_envelope": """SELECT event_id, event_type, 'extract_intent' AS __adaptive_operation,
        '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS __adaptive_prompt,
        '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS __source_record FROM events""",
    "strip_internal": "SELECT event_id, event_type, value FROM events",
    "operation_spec": """SELECT event_id,
        CASE event_type WHEN 'view' THEN 'filter_noise' WHEN 'click' THEN 'extract_intent'
          WHEN 'error' THEN 'map_fema_esf' ELSE event_type END AS operation,
        CASE event_type
          WHEN 'view' THEN 'Keep crisis-relevant humanitarian records and remove irrelevant social chatter. Preserve useful source fields.'
          WHEN 'click' THEN 'Normalize multilingual or code-switched crisis reports into clear humanitarian intents while preserving source context.'
          WHEN 'error' THEN 'Map crisis reports to FEMA ESF and MIRA-style humanitarian response categories. Preserve the original source context.'
          ELSE 'Apply the crisis-report adaptation operation ''' || event_type || ''' to each record.' END AS instruction,
        event_type = 'view' AS deduplication, event_type IN ('click', 'error') AS prompt_rephrase FROM events""",
    "og_extract": """SELECT url AS source_url, 'common_crawl_news' AS source_type,
        CASE WHEN page_id % 2 = 0 THEN '' ELSE 'a & b' END AS content, 't' || page_id AS title,
        'http://img/' || page_id AS media_url FROM pages
        WHERE page_id % 3 = 0 AND (page_id % 2 = 0 OR page_id % 5 <> 0)""",
    "iso_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts FROM events",
    "pii_email": f"SELECT doc_id, {redacted('text', 'EMAIL')} AS text FROM {PII_TEXT}",
    "pii_phone": f"SELECT doc_id, {redacted('text', 'PHONE')} AS text FROM {PII_TEXT}",
    "pii_ip": f"SELECT doc_id, {redacted('text', 'IP_ADDRESS')} AS text FROM {PII_TEXT}",
    "pii_card": f"SELECT doc_id, {redacted('text', 'CREDIT_CARD')} AS text FROM {PII_TEXT}",
    "pii_redact": f"SELECT doc_id, {redacted('text')} AS text FROM {PII_TEXT}",
    "pii_redact_cols": f"SELECT doc_id, {redacted('text')} AS content, text AS other FROM {PII_TEXT}",
    "pii_redact_records": f"SELECT doc_id, {redacted('text')} AS content, text AS nested FROM {PII_TEXT}",
    "lang_normalize": f"SELECT doc_id, {primary('language_inferred')} AS primary_lang FROM {LABELLED}",
    "first_long_word": f"SELECT doc_id, coalesce({first_long('text')}, '') AS word FROM documents",
    # filters
    "warc_html_filter": """SELECT page_id, 'response' AS rec_type,
        CASE page_id % 4 WHEN 0 THEN 'text/html; charset=utf-8' ELSE 'x text/html' END AS content_type
        FROM pages WHERE page_id % 3 <> 0 AND page_id % 4 IN (0, 3)""",
    "keyword_filter": f"SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM {KEYWORDS} k WHERE contains(lower(text), keyword))",
    "ludp_terms": f"SELECT language_code AS lang, term, ord FROM {LUDP} WHERE language_code IN ('de', 'es')",
    "post_filter": "SELECT doc_id FROM documents WHERE doc_id % 5 < 4 AND doc_id % 3 <> 1",
    "cdx_select": f"""SELECT url, ts, ord FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts DESC, ord DESC) AS k
        FROM {collapsed(f"(SELECT * FROM {INDEX} WHERE status = 200 AND mime = 'application/json' AND url LIKE 'http://u/1%')")})
        WHERE k <= 8""",
    "filter_noise": f"""SELECT min(doc_id) AS doc_id FROM documents
        WHERE EXISTS (SELECT 1 FROM {KEYWORDS} k WHERE contains(lower(text), keyword)) GROUP BY text""",
    # joins
    "category_names": f"""SELECT p.doc_id, string_agg(coalesce(d.name, 'Unknown(' || p.id || ')'), '|' ORDER BY p.pos) AS category_names
        FROM (SELECT doc_id, deployment, unnest(category_ids) AS id, generate_subscripts(category_ids, 1) AS pos FROM {POSTS}) p
        LEFT JOIN {CATEGORY_DIM} d ON d.deployment = p.deployment AND d.category_id = p.id GROUP BY p.doc_id""",
    "media_urls": f"""SELECT p.doc_id, concat_ws('|', 'http://s/' || p.doc_id, a.url, b.url, 'http://o/' || p.doc_id) AS media_urls
        FROM {POSTS} p
        LEFT JOIN {MEDIA_DIM} a ON a.deployment = p.deployment AND a.media_id = p.doc_id % 300 AND a.media_id <> 0
        LEFT JOIN {MEDIA_DIM} b ON b.deployment = p.deployment AND b.media_id = p.doc_id % 7 AND b.media_id <> 0""",
    "keyword_hits": f"SELECT keyword, count(*) AS n FROM documents JOIN {KEYWORDS} k ON contains(lower(text), keyword) GROUP BY keyword",
    "glossary_terms": f"""SELECT doc_id, code AS lang, {first_long('text')} AS term FROM documents
        JOIN (SELECT unnest(['ent', 'que', 'der', 'tion']) AS code) ON contains(lower(text), code)
        WHERE {first_long('text')} IS NOT NULL""",
    "lang_gate": f"""SELECT lang, coalesce(share, 0.0) AS share, coalesce(share, 0.0) >= 0.05 AS passed
        FROM (SELECT unnest(['en', 'de', 'es', 'mar', 'swa', 'amh']) AS lang) LEFT JOIN {DIST} ON lang = primary_lang""",
    "source_fallback": """SELECT doc_id, source AS deployment, lang FROM documents
          WHERE source IN ('src1', 'src2', 'src3', 'src4') AND lang = 'en'
        UNION ALL SELECT o_orderkey, 'src' || (o_custkey % 25), o_orderpriority FROM orders
          WHERE 'src' || (o_custkey % 25) NOT IN (SELECT source FROM documents
            WHERE source IN ('src1', 'src2', 'src3', 'src4') AND lang = 'en')""",
    "map_taxonomy": f"""SELECT doc_id, coalesce(string_agg(DISTINCT code, '|' ORDER BY code), '') AS codes FROM documents
        LEFT JOIN {LEXICON} ON contains(lower(text), term) GROUP BY doc_id""",
    "extract_intent": f"""SELECT doc_id, coalesce(string_agg(DISTINCT intent, '|' ORDER BY intent), '') AS intents FROM documents
        LEFT JOIN {LEXICON} ON contains(lower(text), term) GROUP BY doc_id""",
    # aggregations
    "lang_distribution": f"SELECT * FROM {DIST}",
    "audit_gate": f"""SELECT bool_and(coalesce(share, 0.0) >= 0.05) AS compliant
        FROM (SELECT unnest(['en', 'de', 'mar']) AS lang) LEFT JOIN {DIST} ON lang = primary_lang""",
    "terms_by_lang": f"""SELECT lang, term, min(ord) AS ord FROM (SELECT language_code AS lang, term, ord FROM {LUDP}
        UNION ALL SELECT lang, {first_long('text')}, doc_id + 1000000000 FROM documents
          WHERE {first_long('text')} IS NOT NULL AND regexp_matches(lower(text), 'ent|que|der|tion')) GROUP BY lang, term""",
    "terms_fallback": f"""SELECT language_code AS lang, term, min(ord) AS ord FROM {LUDP}
          WHERE language_code IN ('de', 'es') GROUP BY 1, 2
        UNION ALL SELECT 'tgl', unnest(['lindol', 'bagyo', 'baha', 'sakuna', 'tulong', 'sunog', 'paglikas']), unnest([0, 1, 2, 3, 4, 5, 6])
        UNION ALL SELECT 'ceb', unnest(['linog', 'bagyo', 'baha', 'disastre', 'tabang', 'sunog', 'bakwit']), unnest([0, 1, 2, 3, 4, 5, 6])""",
    # windows, ordering
    "archive_dedup": """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "cdx_collapse": f"SELECT url, ts, ord, digest FROM {collapsed(INDEX)}",
    "batch_assign": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch_id FROM documents",
    "page_slice": "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500 OFFSET 500",
    "page_of": """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 500 * 500 AS page_offset
        FROM orders""",
    # sets
    "union_sources": """SELECT doc_id AS id, lang, '' AS url FROM documents
        UNION ALL SELECT page_id, '', url FROM pages""",
    "dedup_exact": "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text",
    # streaming
    "stream_scrub": f"SELECT doc_id, {redacted('text')} AS content FROM {PII_TEXT}",
    "stream_dedup": "SELECT DISTINCT o_orderpriority AS deployment, o_custkey AS key FROM orders",
    # adaptation
    "adapt_identity": "SELECT doc_id, lang, text FROM documents",
    "stream_first_seen": """SELECT key, id, day, status FROM (SELECT o_custkey AS key, o_orderkey AS id,
        strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS status,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "stream_adapt": "SELECT doc_id, CASE WHEN lang = 'de' THEN lang ELSE upper(lang) END AS lang, lang = 'de' AS refused FROM documents",
    "append_once": "SELECT doc_id, lang FROM documents",
    "run_metrics": f"""WITH kept AS (SELECT * FROM documents WHERE EXISTS (SELECT 1 FROM {KEYWORDS} k WHERE contains(lower(text), keyword)))
        SELECT 'fetched' AS stage, 'rows' AS counter, count(*) AS n FROM documents
        UNION ALL SELECT unnest(['kept', 'streamed', 'filter_noise']), 'rows', count(*) FROM kept
        UNION ALL SELECT 'filter_noise', 'failed', count(*) FILTER (lang = 'de') FROM kept
        UNION ALL SELECT 'filter_noise', 'adapted', count(*) FILTER (lang <> 'de') FROM kept
        UNION ALL SELECT 'exported', 'rows', count(*) FILTER (lang <> 'de') FROM kept""",
    "batch_quarantine": "SELECT doc_id, upper(lang) AS lang FROM documents",
    "adaptation_chain": f"""SELECT min(doc_id) AS doc_id, min(intents) AS intents, min(codes) AS codes FROM (
        SELECT doc_id, text, string_agg(DISTINCT intent, '|' ORDER BY intent) AS intents,
          string_agg(DISTINCT code, '|' ORDER BY code) AS codes
        FROM documents JOIN {LEXICON} ON contains(lower(text), term) GROUP BY doc_id, text) GROUP BY text""",
    # whole phases
    "keyword_dictionary": f"""SELECT DISTINCT CASE language_code WHEN 'de' THEN 'swa' ELSE 'mar' END AS lang, term
          FROM {LUDP} WHERE language_code IN ('de', 'es')
        UNION SELECT CASE doc_id % 3 WHEN 0 THEN 'swa' ELSE 'ceb' END, 'wort' || (doc_id % 97) FROM documents WHERE doc_id % 3 < 2
        UNION ALL SELECT 'tgl', unnest(['lindol', 'bagyo', 'baha', 'sakuna', 'tulong', 'sunog', 'paglikas'])""",
    "news_rows": f"""SELECT url AS source_url, CASE WHEN page_id % 2 = 0 THEN '' ELSE 'a & b' END AS content,
        't' || page_id AS title, 'http://img/' || page_id AS media_url FROM pages
        WHERE page_id % 3 = 0 AND (page_id % 2 = 0 OR page_id % 5 <> 0) AND page_id % 5 <> 0
          AND EXISTS (SELECT 1 FROM {KEYWORDS} k WHERE contains(lower(html), keyword))""",
    "category_dictionary": """SELECT 'src' || (c_custkey % 40) AS deployment, c_custkey // 40 AS category_id, c_name AS name
          FROM customer WHERE c_custkey % 40 < 30
        UNION ALL SELECT deployment, unnest([1, 2]), unnest([o_orderpriority, o_orderkey::VARCHAR]) FROM (
          SELECT *, row_number() OVER (PARTITION BY deployment
            ORDER BY strftime(o_orderdate, '%Y%m%d') || lpad(o_orderkey::VARCHAR, 12, '0') DESC) AS rn
          FROM (SELECT *, 'src' || (o_custkey % 45) AS deployment FROM orders WHERE o_orderkey % 4 <> 0))
        WHERE rn = 1 AND deployment NOT IN (SELECT 'src' || (c_custkey % 40) FROM customer WHERE c_custkey % 40 < 30 OR c_custkey % 40 BETWEEN 33 AND 36)""",
    "crowd_reports": f"""SELECT p.source AS deployment, 'http://p/' || p.doc_id AS url,
          coalesce(c.name, 'Unknown(' || (p.doc_id % 9) || ')') AS category_names, coalesce(m.url, '') AS media_urls,
          '' AS acquisition_source, '' AS original
        FROM documents p
        LEFT JOIN {CATEGORY_DIM} c ON c.deployment = p.source AND c.category_id = p.doc_id % 9
        LEFT JOIN {MEDIA_DIM} m ON m.deployment = p.source AND m.media_id = p.doc_id % 15 AND m.media_id <> 0
        WHERE p.source < 'src15'
        UNION ALL SELECT o.deployment, 'http://c/' || o.o_orderkey, coalesce(c.name, 'Unknown(' || (o.o_orderkey % 9) || ')'),
          'm' || o.o_orderkey, 'internet_archive_ushahidi_api', 'http://o/' || o.o_orderkey
        FROM (SELECT *, 'src' || (o_custkey % 20) AS deployment, row_number() OVER (PARTITION BY o_custkey
              ORDER BY strftime(o_orderdate, '%Y%m%d%H%M%S') || o_orderkey DESC) AS rn FROM orders) o
        LEFT JOIN {CATEGORY_DIM} c ON c.deployment = o.deployment AND c.category_id = o.o_orderkey % 9
        WHERE o.rn = 1 AND o_custkey <> 0 AND o.deployment NOT IN (SELECT source FROM documents WHERE source < 'src15' OR source IN ('src16', 'src3', 'src17'))
        UNION ALL SELECT o.deployment, 'http://c/' || o.o_orderkey, coalesce(c.name, 'Unknown(' || (o.o_orderkey % 9) || ')'),
          'm' || o.o_orderkey, 'internet_archive_ushahidi_api', 'http://o/' || o.o_orderkey
        FROM (SELECT *, 'src0' AS deployment FROM orders WHERE o_custkey = 0) o
        LEFT JOIN {CATEGORY_DIM} c ON c.deployment = o.deployment AND c.category_id = o.o_orderkey % 9
        WHERE o.deployment NOT IN (SELECT source FROM documents WHERE source < 'src15' OR source IN ('src16', 'src3', 'src17'))""",
    "end_to_end": f"""SELECT primary_lang, n, n / sum(n) OVER ()::DOUBLE AS share FROM (
        SELECT {primary("CASE WHEN contains(content, '[REDACTED_') THEN coalesce(language_inferred, 'unknown') || '-x' ELSE 'clean_' || coalesce(language_inferred, 'unknown') END")} AS primary_lang,
          count(*) AS n FROM (SELECT d.doc_id, {redacted('d.text')} AS content, d.language_inferred FROM {LABELLED} d
            WHERE d.doc_id IN (SELECT min(doc_id) FROM documents
              WHERE EXISTS (SELECT 1 FROM {KEYWORDS} k WHERE contains(lower(text), keyword)) GROUP BY text))
        GROUP BY 1)""",
    # Row elements of the given pages hold no others, so patterns find them.
    "glossary_rows": r"""WITH plain AS (
          SELECT page_id, regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g') AS h FROM pages
        ), found AS (
          SELECT page_id, regexp_extract_all(h, '(?is)<(?:tr|div|li)(?:\s[^>]*)?>(.*?)</(?:tr|div|li)>', 1) AS x FROM plain
        ), each AS (
          SELECT page_id, unnest(range(len(x))) AS row_no, regexp_replace(unnest(x), '<[^>]*>', '', 'g') AS x FROM found
        )
        SELECT page_id, row_no, regexp_replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
          '&middot;', '·'), '&copy;', '©'), '&amp;?', '&', 'g') AS text FROM each""",
    "glossary_texts": """SELECT doc_id, 0::BIGINT AS row_no, 'top ' || doc_id || 'one ' || coalesce(source, '') || 'two rest' AS text FROM documents
        UNION ALL SELECT doc_id, 1, 'one ' || coalesce(source, '') FROM documents
        UNION ALL SELECT doc_id, 2, 'two' FROM documents
        UNION ALL SELECT doc_id, 3, 'a & b c' || (doc_id % 7) FROM documents
        UNION ALL SELECT doc_id, 4, 'x end' FROM documents
        UNION ALL SELECT doc_id, 5, '' FROM documents WHERE doc_id % 2 <> 0""",
    "keyword_hits_words": r"""SELECT keyword, count(*) AS n FROM documents JOIN (SELECT DISTINCT
          unnest(list_filter(string_split_regex(lower(text), '\s+'), lambda x: length(x) > 3)) AS keyword FROM benchmark)
          ON contains(lower(text), keyword) GROUP BY keyword""",
    "page_after": "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500 OFFSET 500",
    "validated": f"""SELECT doc_id, {redacted('text')} AS content,
        (SELECT count(*) FROM {DIST} WHERE primary_lang IN ('en', 'de', 'mar') AND share >= 0.05) = 3 AS compliant FROM documents""",
    "publish_gate": f"""SELECT 'met' AS gate, doc_id, coalesce(language_inferred, '') AS lang, text FROM {LABELLED}
          WHERE (SELECT count(*) FROM {DIST} WHERE primary_lang IN ('en', 'de', 'mar') AND share >= 0.05) = 3
        UNION ALL SELECT 'missed', doc_id, coalesce(language_inferred, ''), text FROM {LABELLED}
          WHERE (SELECT count(*) FROM {DIST} WHERE primary_lang IN ('en', 'amh') AND share >= 0.05) = 2""",
    "reports_to_publish": f"""WITH reports AS (
          SELECT 'http://p/' || doc_id AS id, text AS content, language_inferred FROM {LABELLED}
            WHERE source IS NULL OR source NOT IN ('src16', 'src17')
          UNION ALL SELECT 'http://c/' || item_id, text, NULL FROM benchmark WHERE 'src' || (item_id % 20) NOT IN (
            SELECT source FROM documents WHERE source NOT IN ('src16', 'src17'))
          UNION ALL SELECT url, 'page ' || page_id || ' ' ||
            regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '[^a-z]+', ' ', 'g'), NULL
            FROM pages WHERE page_id % 3 = 0 AND page_id % 5 <> 0),
        labelled AS (SELECT id, content, language_inferred, string_agg(DISTINCT intent, '|' ORDER BY intent) AS intents,
          string_agg(DISTINCT code, '|' ORDER BY code) AS codes
          FROM reports JOIN {LEXICON} ON contains(lower(content), term) GROUP BY id, content, language_inferred),
        kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY id) AS rn FROM labelled) WHERE rn = 1),
        shares AS (SELECT {primary('language_inferred')} AS lang, count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM kept GROUP BY 1)
        SELECT id, {redacted('content')} AS content, intents, codes,
          (SELECT count(*) FROM shares WHERE lang IN ('en', 'de', 'mar') AND share >= 0.05) = 3 AS published FROM kept""",
}
