"""The same questions as the registered queries, in DuckDB SQL over the same tables.

Operators with a fitted model, line rules or a tokenizer have none; tests hold those against
brute-force versions.
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
TERMS = r"regexp_extract_all(coalesce({}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, {WORDS.format(LOWER.format('text'))} AS w FROM documents
), shingled AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM worded
), keyed AS (
    SELECT doc_id, s, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(list_sort(s), chr(10))) END AS k FROM shingled
), nodes AS (
    SELECT k, any_value(n) AS n, min(doc_id) AS least, any_value(s) AS s FROM keyed WHERE k IS NOT NULL GROUP BY k
), each AS (
    SELECT k, n, unnest(s) AS x FROM nodes
), pairs AS (
    SELECT a.k AS u, b.k AS v FROM each a JOIN each b ON a.x = b.x AND a.k <> b.k
    GROUP BY a.k, b.k HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    SELECT k AS u, k AS v FROM nodes UNION SELECT r.u, p.v FROM reach r JOIN pairs p ON r.v = p.u
), roots AS (
    SELECT r.u AS k, min(least) AS component_id FROM reach r JOIN nodes ON r.v = nodes.k GROUP BY r.u
)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    doc_id IS NOT DISTINCT FROM coalesce(component_id, doc_id) AS kept
FROM keyed LEFT JOIN roots USING (k)
"""

OP4 = """
WITH sized AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS lead_id
    FROM pages
)
SELECT page_id, n AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + CAST((CAST('0x' || substr(h, 1 + 5 * CAST(floor(i / 4) AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT), 1)), '')
        AS payload_digest,
    CASE WHEN page_id = lead_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = lead_id THEN NULL ELSE lead_id END AS refers_to
FROM sized
"""

OP5 = f"""
WITH sized AS (
    SELECT doc_id, source, len({WORDS.format('text')}) AS size,
        md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS s,
        [1, 2, 3][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS w
    FROM sized GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY 3 * s / w, source) AS nth, (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY 3 * s / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), leveled AS (
    SELECT *, (SELECT arg_min(level, nth) FROM ranked WHERE w * level <= 3 * s) AS final FROM ranked
), targets AS (
    SELECT source, s, CASE WHEN w * final > 3 * s THEN CAST(3 * s AS DOUBLE) ELSE w * final END AS target FROM leveled
), planned AS (
    SELECT *, CAST(coalesce(floor(target / nullif(s, 0)), 0) AS BIGINT) AS whole,
        target - CAST(coalesce(floor(target / nullif(s, 0)), 0) AS BIGINT) * s AS missing
    FROM targets
), placed AS (
    SELECT d.*, s, target, whole, missing, sum(size) OVER (PARTITION BY d.source ORDER BY key) AS upto
    FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
), rests AS (
    SELECT *, missing - coalesce(max(CASE WHEN upto <= missing THEN upto END) OVER (PARTITION BY source), 0) AS rest FROM placed
), fills AS (
    SELECT source, min(row(abs(size - rest), key)) AS best
    FROM rests WHERE missing > 0 AND upto > missing AND abs(size - rest) < rest GROUP BY source
)
SELECT doc_id, size, s AS source_size, target,
    size * (whole + CASE WHEN missing > 0 AND (upto <= missing OR key = best[2]) THEN 1 ELSE 0 END) AS taken
FROM rests LEFT JOIN fills ON rests.source IS NOT DISTINCT FROM fills.source
"""

OP7 = f"""
WITH items AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {TERMS.format(LOWER.format('text'))} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS n,
        unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS x
    FROM items WHERE len(w) > 0
), lengths AS (
    SELECT DISTINCT n FROM windows
), docs AS (
    SELECT row_number() OVER () AS r, doc_id, {TERMS.format(LOWER.format('text'))} AS w FROM documents
), runs AS (
    SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i,
        unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS x
    FROM docs, lengths WHERE len(w) >= n
), hits AS (
    SELECT r, i, runs.n, item FROM runs JOIN windows ON runs.x = windows.x AND runs.n = windows.n
), found AS (
    SELECT r, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS names FROM hits GROUP BY r
), words AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN found USING (r) LEFT JOIN words USING (r)
"""

# Maximal common runs of every two places, by islands on their diagonals.
OP9 = r"""
WITH docs AS (
    SELECT DISTINCT doc_id, text FROM documents
), each AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM docs
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS nth, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
    FROM each WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
), pairs AS (
    SELECT a.doc_id AS d, b.doc_id AS e, b.nth, b.words, b.nth - a.nth AS shift
    FROM numbered a JOIN numbered b ON a.x = b.x AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.nth < b.nth)
), islands AS (
    SELECT *, nth - row_number() OVER (PARTITION BY d, e, shift ORDER BY nth) AS island FROM pairs
), runs AS (
    SELECT e, min(nth) AS low, max(nth) AS high FROM islands GROUP BY d, e, shift, island HAVING count(*) >= 3 OR sum(words) >= 50
), gone AS (
    SELECT DISTINCT e AS doc_id, unnest(range(low, high + 1)) AS nth FROM runs
), marked AS (
    SELECT each.*, gone.nth IS NOT NULL AS dropped
    FROM each LEFT JOIN numbered USING (doc_id, line) LEFT JOIN gone ON numbered.doc_id = gone.doc_id AND numbered.nth = gone.nth
), rebuilt AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_removed,
        coalesce(string_agg(x, chr(10) ORDER BY line) FILTER (NOT dropped), '') AS text
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
    CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text
FROM documents d LEFT JOIN rebuilt r USING (doc_id)
"""

OP12 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), each AS (
    SELECT r, lang, source, unnest(w) AS x FROM docs
), kept AS (
    SELECT lang, x, count(*) AS c FROM each GROUP BY lang, x HAVING count(DISTINCT r) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), cells AS (
    SELECT lang, source, x, count(*) AS c FROM each JOIN kept USING (lang, x) GROUP BY lang, source, x
), sizes AS (
    SELECT g.lang, g.source, CAST(coalesce(sum(c), 0) AS HUGEINT) AS n FROM groups g LEFT JOIN cells USING (lang, source) GROUP BY g.lang, g.source
), shares AS (
    SELECT s.lang, s.source, k.x, coalesce(c.c, 0) AS c, 1 + 1000000000 * CAST(coalesce(c.c, 0) + 1 AS HUGEINT) // (s.n + l.v) AS p
    FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = s.lang AND c.source = s.source AND c.x = k.x
), of_langs AS (
    SELECT lang, x, 1 + 1000000000 * CAST(c + 1 AS HUGEINT) // (n + v) AS q FROM kept JOIN langs USING (lang)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.x = b.x AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), all_pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, x AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
    FROM shares JOIN of_langs USING (lang, x) WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
    FROM (SELECT * FROM all_pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# CRC-32 byte by byte, with the table made by its rule.
OP13 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {TERMS.format(LOWER.format('text'))} AS w FROM documents
), items AS (
    SELECT {TERMS.format(LOWER.format('text'))} AS w FROM benchmark
), each AS (
    SELECT r, unnest(w) AS x FROM docs
), wanted AS (
    SELECT unnest(w) AS x FROM items
), remainders AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t
), words AS (
    SELECT x, hex(encode(x)) AS h FROM (SELECT x FROM each UNION SELECT x FROM wanted)
), hashed AS (
    SELECT x, xor(4294967295, list_reduce(
        list_transform(range(1, length(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), CAST(4294967295 AS BIGINT))) % 10000 AS bucket
    FROM words, remainders
), s AS (
    SELECT bucket, count(*) AS n FROM each JOIN hashed USING (x) GROUP BY bucket
), t AS (
    SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (x) GROUP BY bucket
), gains AS (
    SELECT s.bucket, CAST(floor(1000 * ln(
        (CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT sum(n) FROM s) + 10000 AS DOUBLE))
        / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket)
), sums AS (
    SELECT r, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM each JOIN hashed USING (x) JOIN gains USING (bucket) GROUP BY r
), scored AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features,
        CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight,
        CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS noise
    FROM docs LEFT JOIN sums USING (r)
), ranked AS (
    SELECT doc_id, n_features, weight, weight + noise AS score,
        row_number() OVER (PARTITION BY n_features >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
        10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= drawn THEN place END AS rank FROM ranked
"""

ORACLE = {
    "op2_neardup": OP2,
    "op4_archive": OP4,
    "op5_mixing": OP5,
    "op7_decontam": OP7,
    "op9_linedup": OP9,
    "op9_runs": OP9,
    "op12_divergence": OP12,
    "op13_resample": OP13,
}
