"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator."""

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sitrep.llm import archive, common, decontam, linedup, mixing, neardup, pii, quality, secrets, tokens, urls
from sitrep.llm.queries import tokenizer_path

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key long, kept boolean, "
    "n_words long, node string, size long, target double, words string, shard string, `a.b` int"
)
CLEAN = " ".join(f"word{i} stands here." for i in range(40))
BENCH = "one two three four five six seven eight nine ten eleven twelve"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "en", s, 1, 5, False, 7, "n", 3, 0.5, "w", "s", 9) for *r, s in rows], SCHEMA)


ROWS = [
    (1, CLEAN, "a"),
    (1, CLEAN, "a"),
    (2, CLEAN, "b"),
    (3, None, "a"),
    (4, "", None),
    (5, " \n \t", "b"),
    (None, "x " + BENCH + " y\n" + CLEAN, "c"),
    (6, "é中\U0001f600 " * 30000, "a"),
    (7, CLEAN + " and a tail", "b"),
    (8, "short", "c"),
]


@pytest.fixture(scope="module")
def table(spark):
    return docs(spark, ROWS)


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, BENCH), (1, BENCH), (2, None), (3, ""), (None, "short"), (4, "unseen phrase")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_every_stage_and_operator_takes_empty_tables(spark, empty, bench):
    assert quality.quality(empty).count() == 0 and quality.clean_lines(empty).count() == 0
    assert neardup.groups(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert secrets.scan(empty).count() == 0
    assert decontam.contamination(empty, bench).count() == 0
    assert pii.personal_data(empty).count() == 0 and pii.redacted(empty).count() == 0
    assert linedup.line_dedup(empty).count() == 0
    assert tokens.tokenized(empty, tokenizer_path()).count() == 0
    for stage in (quality.keep_good, neardup.unique, mixing.take, lambda d: decontam.without_benchmark(d, bench)):
        assert stage(empty).columns == empty.columns and stage(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert urls.judged(pages, labels).count() == 0 and archive.archived(pages).count() == 0


def test_quality(table):
    found = {(r.doc_id): r for r in quality.quality(table).collect()}
    assert quality.quality(table).count() == len(ROWS)
    assert found[3].n_words == found[4].n_words == found[5].n_words == 0 and found[3].base_failed
    assert found[6].n_words == 30000 and found[6].word_chars == 90000 and found[1].kept
    kept = quality.keep_good(table)
    assert kept.columns == table.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 7]


def test_lines_are_cleaned(spark):
    text = "A line that stays.\nHome | News | Sport | About | Login\nPlease accept cookies now\n" + CLEAN
    found = quality.clean_lines(docs(spark, [(1, text, "a"), (2, None, "a")])).orderBy("doc_id").collect()
    assert [r.text for r in found] == ["A line that stays.\n" + CLEAN, None]


def test_near_duplicates(table):
    found = neardup.groups(table).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].component_id == by_id[7].component_id == 1 and not by_id[2].kept
    assert by_id[3].component_id == 3 and by_id[3].kept and by_id[3].n_shingles == 0
    assert by_id[8].n_shingles == 1 and by_id[6].n_shingles == 1
    rest = neardup.unique(table)
    assert rest.columns == table.columns
    assert sorted((r.doc_id or 0) for r in rest.collect()) == [1, 3, 4, 5, 6, 8]


def test_near_copies_far_apart_are_joined_through_others(spark):
    """A chain of copies, each near to the next only, and a crowd around one text."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([f"c{j}" if j < i else w for j, w in enumerate(base)]), "a") for i in range(0, 60, 4)]
    rng = np.random.default_rng(5)
    for i in range(150):
        words = [f"v{k}" for k in range(120)]
        for at in rng.choice(120, int(rng.integers(1, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((1000 + i, " ".join(words), "a"))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(116)} for i, t, _ in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    found = {r.doc_id: r.component_id for r in neardup.groups(docs(spark, rows)).collect()}
    assert found == {i: find(i) for i in sets}


def test_odd_sketches_estimate_similarity():
    factors, terms = neardup._constants(neardup.BANDS * neardup.ROWS, 7)
    rng = np.random.default_rng(1)
    for shared in (60, 75, 90):
        union = rng.integers(0, 2**63, 400, np.uint64)
        size = 4 * shared
        a, b = np.sort(union[: size + (400 - size) // 2]), np.sort(np.concatenate([union[:size], union[size + (400 - size) // 2 :]]))
        bits = [neardup.odd_sketch(neardup.minhash(x, factors, terms), neardup.SKETCH_WORDS).view(np.uint64) for x in (a, b)]
        apart = sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(*bits))
        n, k = 64 * neardup.SKETCH_WORDS, neardup.BANDS * neardup.ROWS
        estimate = 1 + n / 2 * np.log(1 - 2 * apart / n) / (2 * k)
        assert abs(estimate - shared / 100) < 0.2


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "HTTP://A.B.ORG"), (4, "http://x.com/de/1?q=1#f"), (4, "http://x.com/de/1?q=1#f")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([(4, 0, None), (9, None, None)], "doc_id long, quality int, toxic int")
    found = sorted(map(tuple, urls.judged(pages, labels).collect()))
    assert found[0] == (1, "", "", None, "allow") and found[1] == (2, "", "", None, "allow")
    assert found[2] == (3, "a.b.org", "", None, "allow")
    assert found[3] == found[4] == (4, "x.com", "/de/1", "com/de/", "block")


def test_mined_rules_find_planted_combination(spark):
    rows = [(i, f"http://h{i % 7}.net/{'ads' if i % 2 else 'en'}/{'promo' if i % 3 else 'text'}/{i}") for i in range(1200)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not ("ads" in u and "promo" in u)), 0) for i, u in rows if i < 800], "doc_id long, quality int, toxic int")
    found = urls.judged(pages, labels).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == {i for i, u in rows if "ads" in u and "promo" in u}


def test_archive(spark, tmp_path):
    rows = [(1, "http://a\r\nX: y", "same"), (2, None, "same"), (2, None, "same"), (3, "http://c", None), (4, "http://d", ""), (None, "u", "é\r\n\r\nWARC/1.1"), (5, "http://e", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    found = sorted(map(tuple, archive.archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)

    def digest(text):
        return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()

    want = [
        (1, 4, digest("same"), "revisit", 2),
        (2, 4, digest("same"), "response", None),
        (2, 4, digest("same"), "response", None),
        (3, 0, digest(""), "revisit", 4),
        (4, 0, digest(""), "response", None),
        (None, 14, digest("é\r\n\r\nWARC/1.1"), "response", None),
        (5, 300_000, digest("x" * 300_000), "response", None),
    ]
    assert found == sorted(want, key=repr)
    kept = archive.write_archive(pages, str(tmp_path / "archive"))
    assert kept.payloads(spark).count() == 4
    records = archive.read_records(spark, kept).collect()
    assert all(bytes(r.record).endswith(b"\r\n\r\n") and bytes(r.record).startswith(b"WARC/1.1\r\n") for r in records)
    archive.export_warc(spark, kept, str(tmp_path / "warc"))
    from sitrep.sources.warc import read_warc

    back = read_warc(spark, str(tmp_path / "warc")).where("rec_type = 'response'").collect()
    assert sorted(len(r.payload) for r in back) == sorted([4, 4, 0, 14, 300_000])


@pytest.mark.parametrize("name, value", [("WARC-Payload-Digest", "sha1:WRONG"), ("Content-Length", "7"), (None, None)])
def test_records_that_do_not_fit_their_payload_stop_the_job(spark, tmp_path, name, value):
    pages = spark.createDataFrame([(1, "http://a", "one")], "page_id long, url string, html string")
    written = archive.write_archive(pages, str(tmp_path / "first"))
    good = archive.read_records(spark, written).select("payload_bytes", "payload_digest", "record").first()
    sha1 = base64.b32encode(hashlib.sha1(b"one").digest()).decode()
    assert (good[0], good[1]) == (3, sha1) and bytes(good[2]).endswith(b"\r\n\r\none\r\n\r\n")
    changed = archive.Archive(str(tmp_path / "changed"))
    header = F.regexp_replace(F.col("header").cast("string"), f"{name}: [^\r]*", f"{name}: {value}").cast("binary")
    written.headers(spark).select("digest", header.alias("header")).write.parquet(f"{changed.path}/headers")
    written.payloads(spark).where(F.lit(name is not None)).write.parquet(f"{changed.path}/payloads")
    with pytest.raises(Exception, match="does not fit its payload"):
        archive.read_records(spark, changed).select("payload_digest").collect()


def test_payloads_do_not_move_to_be_read(spark, tmp_path, monkeypatch):
    rows = [(i, "u", f"page {i % 40} {'x' * i}") for i in range(60)] + [(i, "v", "same") for i in (70, 71, 72, 72, 72)] + [(None, None, "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    kept = archive.write_archive(pages, str(tmp_path / "archive"))
    assert kept.payloads(spark).count() == 61 and kept.headers(spark).count() == len(rows)
    assert kept.apart(spark).count() == 5 and kept.responses(spark).where("header IS NULL").count() == 0
    records = archive.read_records(spark, kept)
    found = [(r.page_id, r.record_type, r.refers_to, bytes(r.payload), r.payload_bytes) for r in records.collect()]
    wanted = [(i, "response", None, t.encode(), len(t)) for i, _, t in rows[:60]] + [(72, "response", None, b"same", 4)] * 3
    wanted += [(i, "revisit", 72, b"same", 4) for i in (70, 71, None)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    for r in records.collect():
        assert bytes(r.record) == bytes(r.header) + (bytes(r.payload) if r.record_type == "response" else b"") + b"\r\n\r\n"
    short = archive.write_archive(pages, str(tmp_path / "short"), min_bytes=5)
    assert short.payloads(spark).count() == 61
    assert {(r.record_type, r.payload_digest is None) for r in archive.read_records(spark, short).collect()} == {("response", False)}
    # Digests are had with the payloads of repeated ids alone in an exchange.
    asked, lookup_join = [], archive.scale.lookup_join
    monkeypatch.setattr(archive.scale, "lookup_join", lambda left, right, *how: (asked.append(right.count()), lookup_join(left, right, *how))[1])
    plan = archive.read_records(spark, kept).select("page_id", "payload_digest")._jdf.queryExecution().optimizedPlan().toString()
    taken = [line for line in plan.split("\n") if " AS sha1#" in line]
    assert asked == [1] and len(taken) == 1 and "Project [digest#" in taken[0] and ", payload#" not in taken[0]


def test_mixing(table):
    found = mixing.mix(table).collect()
    assert len(found) == len(ROWS)
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    again = mixing.mix(table).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    mixed = mixing.take(table)
    assert mixed.columns == table.columns
    taken = {r.doc_id: r.times for r in found if r.size}
    counts = {r.doc_id: r["count"] for r in mixed.where("text rlike '[^ \\\\s]'").groupBy("doc_id").count().collect()}
    assert counts == {i: n * (2 if i == 1 else 1) for i, n in taken.items() if n}


def test_secrets_by_randomness(spark):
    rng = np.random.default_rng(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(list(letters), 64)) for _ in range(40)]
    rows = [(i, f"{CLEAN} the value {keys[i]} is here" if i < 40 else CLEAN + " " + "understandingly" * 4, "a") for i in range(400)]
    found = {r.doc_id: r.spans for r in secrets.scan(docs(spark, rows + [(900, None, "a")])).collect()}
    hits = {i for i, s in found.items() if "random:" in s}
    assert len(hits & set(range(40))) >= 36 and not hits - set(range(40)) and found[900] == ""
    one = next(iter(hits))
    start, end = map(int, found[one].split(":")[1:])
    assert rows[one][1][start:end] == keys[one]


def test_places_of_very_many_matches(spark):
    """Places run on over the parts in which they are summed."""
    texts = ["é😀 " + " ".join(f"{(i + 1) * 2654435761 * 97531:032x}" for i in range(n)) + " end" for n in (1, 127, 128, 129, 1000)]
    rows = spark.createDataFrame(list(enumerate([*texts, None, "", "a" * 23, "a" * 24])), "n int, text string")
    found = secrets.spans(rows, "text", secrets.PATTERNS["hex"], "found").select("n", "text", "found").collect()
    for row in found:
        matches = re.finditer("[0-9a-f]{24,}", row["text"] or "")
        assert [tuple(x) for x in row["found"]] == [(m.start(), m.end(), m[0]) for m in matches]


def test_strings_that_touch_fixed_matches_are_left_out(spark):
    rng = np.random.default_rng(5)
    spans = lambda n, room: sorted((int(a), int(a) + int(b)) for a, b in zip(rng.choice(room, n, False) * 10, rng.integers(1, 10, n)))
    rows = []
    for n in range(40):
        base = sorted((a, k, b, kind) for k, kind in enumerate(("assign", "access", "hex")) for a, b in spans(n % 9, 30))
        rows.append((n, base, [(int(a), int(a) + int(b)) for a, b in zip(rng.integers(0, 320, 12), rng.integers(1, 40, 12))]))
    schema = "n int, base array<struct<start:int,nth:int,end:int,kind:string>>, found array<struct<start:int,end:int>>"
    table = spark.createDataFrame(rows, schema).withColumn("out", secrets._outside(F.col("found"), F.col("base")))
    for row in table.collect():
        free = [x for x in row["found"] if not any(b["start"] < x["end"] and x["start"] < b["end"] for b in row["base"])]
        assert row["out"] == free


def test_contamination(table, bench):
    found = decontam.contamination(table, bench).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[None].n_hit, by_id[None].n_items) == (12, 1)
    assert by_id[8].contaminated and by_id[8].n_items == 1 and not by_id[1].contaminated and by_id[3].n_words == 0
    rest = decontam.without_benchmark(table, bench)
    assert rest.columns == table.columns and rest.count() == len(ROWS) - 2


def test_proximity(spark, bench):
    near = BENCH.replace("six", "x six")
    index = decontam.build_index(docs(spark, [(1, near, "a"), (2, BENCH, "a"), (3, "ten nine", "a")]))
    items = bench.where("item_id = 1")
    exact = decontam.occurrences(index, items).count()
    loose = decontam.occurrences(index, items, slop=2).count()
    assert (exact, loose) == (1, 2)


def near_words(texts, item, slop):
    """Words of near matches by brute force: every place counted from each window's rarest term."""
    words = [t.split() for t in texts]
    count = {w: sum(x.count(w) for x in words) for w in item.split()}
    out = [set() for _ in texts]
    for at in range(len(item.split()) - 9):
        window = item.split()[at : at + 10]
        rarest = min(range(10), key=lambda k: count[window[k]])
        for found, text in zip(out, words):
            for p in (k for k, w in enumerate(text) if w == window[rarest]):
                places = [p - rarest + k for k in range(10)]
                near = [
                    min((abs(j - q), j) for j in range(len(text)) if text[j] == w) if w in text else (99, 0)
                    for w, q in zip(window, places)
                ]
                if max(near)[0] <= slop:
                    found.update(j for _, j in near)
    return out


def test_near_matches_at_the_start_of_documents(spark, bench):
    swapped = BENCH.replace("one two", "two one")
    # Only here: the window's last term is its rarest and stands two places early.
    shifted = "three four five six seven eight one two ten"
    rare = " ".join(["one two three four five six seven eight nine"] * 3)
    texts = [swapped, rare, swapped, "two one " + BENCH[8:] + " filler", shifted, "x " + BENCH, "two one three four five six seven eight nine ten " * 3]
    rng = np.random.default_rng(3)
    for _ in range(20):
        words = BENCH.split()
        k = rng.integers(0, 11)
        words[k], words[k + 1] = words[k + 1], words[k]
        texts.append(" ".join(words[rng.integers(0, 3) :]))
    rows = docs(spark, [(i, t, "a") for i, t in enumerate(texts)]).coalesce(1)
    items = bench.where("item_id = 1")
    found = {r.doc_id: r for r in decontam.near_contamination(rows, items).collect()}
    exact, near = near_words(texts, BENCH, 0), near_words(texts, BENCH, decontam.NEAR)
    assert near[0] and near[2]
    for i in range(len(texts)):
        assert (found[i].n_hit, found[i].n_near) == (len(exact[i]), len(near[i])), texts[i]
        assert found[i].near == (found[i].n_near_items == 1) == bool(near[i])
    index = decontam.build_index(rows)
    spots = {r.ordinal: set(r.words) for r in decontam.occurrences(index, items, slop=2).collect()}
    assert spots == {i: w for i, w in enumerate(near) if w}


def test_blocks_of_the_benchmark_agree(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    tables = [common.table(spark, sf, n) for n in ("documents", "benchmark")]
    whole = sorted(map(tuple, decontam.contamination(*tables).collect()))
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 700)
    assert sorted(map(tuple, decontam.contamination(*tables).collect())) == whole


def test_personal_data(spark, table):
    assert pii.personal_data(table).count() == len(ROWS)
    text = "Mail a.b@c-d.org or +1 (017) 555-7713, 10.0.0.300 10.0.0.3 and 4111 1111 1111 1111"
    out = pii.redacted(docs(spark, [(1, text, "a"), (2, None, "a")])).orderBy("doc_id").collect()
    assert out[1].text is None
    assert all(x not in out[0].text for x in ("a.b@c-d.org", "555-7713", "10.0.0.3 ", "4111 1111")) and "[EMAIL]" in out[0].text


def test_field_agrees_with_patterns_on_texts_it_has_not_seen(spark):
    rows = common.table(spark, "/root/testdata/sf0.1", "documents").where("text rlike '[0-9@]' AND length(text) < 8000")
    texts = [r.text for r in rows.orderBy(F.xxhash64("doc_id")).limit(240).collect()]
    field = pii.fit(texts[:160])
    right = total = 0
    for text in texts[160:]:
        graph = pii.graph(text)
        if graph is None:
            continue
        labels = pii.labels_of(graph, pii.base_spans(text))
        found = pii.beliefs(graph, field).argmax(1)
        right += int((labels == found).sum())
        total += len(labels)
    assert right > 0.9 * total


def test_very_long_runs_of_digits():
    text = "7" * 400_000 + ".1.2.3 1.2.3.4.5.6.7.8"
    end = 400_001 + len("1.2.3 ")
    assert pii.base_spans(text) == [(1, end, end + 7), (1, end + 8, end + 15)]


def test_repeats_are_labelled_alike():
    """A token that is unclear alone follows its clear copy, through the factor between them."""
    n = len(pii.KINDS) + 1
    unary = np.zeros((pii.FEATURES, n))
    unary[1, 1], unary[2, 1] = 6.0, 0.1
    skip = 3 * np.eye(n)
    graph = pii.Graph([(0, 1), (5, 6)], [np.array([1]), np.array([2])], np.zeros((0, 2), int), np.array([[0, 1]]))
    assert pii.beliefs(graph, pii.Field(unary, np.zeros((n, n)), skip))[1, 1] > 0.7
    alone = pii.Graph([(0, 1), (5, 6)], graph.features, graph.chain, np.zeros((0, 2), int))
    assert pii.beliefs(alone, pii.Field(unary, np.zeros((n, n)), skip))[1, 1] < 0.3


@pytest.mark.parametrize("size", [2, 3, 5, 8])
def test_line_runs(spark, size):
    rng = np.random.default_rng(size)
    rows = [(i, "\n".join(f"line {x}" if x else "" for x in rng.integers(0, 6, 30)), "a") for i in range(12)]
    seen, gone = set(), {i: set() for i, _, _ in rows}
    for i, text, _ in rows:
        lines = [(k, x) for k, x in enumerate(text.split("\n")) if x]
        for k in range(len(lines) - size + 1):
            run = tuple(x for _, x in lines[k : k + size])
            if run in seen:
                gone[i].update(p for p, _ in lines[k : k + size])
            seen.add(run)
    found = {r.doc_id: r for r in linedup.line_dedup(docs(spark, rows), min_lines=size).collect()}
    for i, text, _ in rows:
        assert found[i].text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[i])


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_short_runs_with_many_words(spark, size):
    """Lines of every maximal common run that has enough lines or enough words in all."""
    rng = np.random.default_rng(size)
    rows = [(i, "\n".join(" ".join(["abcdef"[x]] * (4 * x + 3)) for x in rng.integers(0, 6, 12)), "a") for i in range(8)]
    lines = {i: text.split("\n") for i, text, _ in rows}
    places = [(i, k) for i in lines for k in range(12)]
    gone = {i: set() for i in lines}
    for i, a in places:
        for j, b in places:
            if (i, a) < (j, b) and not (a and b and lines[i][a - 1] == lines[j][b - 1]):
                n = 0
                while max(a, b) + n < 12 and lines[i][a + n] == lines[j][b + n]:
                    n += 1
                if n >= size or len(" ".join(lines[j][b : b + n]).split()) >= 30:
                    gone[j].update(range(b, b + n))
    found = {r.doc_id: r for r in linedup.line_dedup(docs(spark, rows), min_lines=size, min_words=30).collect()}
    for i, text in lines.items():
        assert found[i].text == "\n".join(x for k, x in enumerate(text) if k not in gone[i])


def test_whole_copies_of_two_lines_go(spark):
    pair = " ".join(f"a{i}" for i in range(27)) + "\n" + " ".join(f"b{i}" for i in range(35))
    rows = docs(spark, [(2, pair, "a"), (5892, "head\n\n" + pair, "a"), (7, "b\n" + pair.split("\n")[1], "a")])
    found = {r.doc_id: r for r in linedup.line_dedup(rows).collect()}
    assert [found[i].n_removed for i in (2, 7, 5892)] == [0, 0, 2]
    assert found[5892].text == "head\n"


def test_line_dedup_edges(table):
    found = linedup.line_dedup(table).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].text is None and by_id[3].n_lines == 0 and by_id[4].n_lines == 1
    # The null id comes first in the order of documents, so its copy of the long line stays.
    assert by_id[None].n_removed == 0 and by_id[1].n_removed == by_id[2].n_removed == 1


def test_tokens(table):
    found = sorted(map(tuple, tokens.tokenized(table, tokenizer_path()).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert [a[1] + a[2] for a in found[:-1]] == [b[1] for b in found[1:]] and found[0][1] == 0
    assert found[4][2] == 1


def test_words_are_encoded_as_the_tokenizer_would():
    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    cases = ["", " ", "\n", "a  b", "a\n\nb", " a ", "it's don't", "x\ty", "1,000.5 a.", "été, naïve.", "中文 \U0001f600 b", "<|endoftext|> a", "a b", "A.B. c,", "x\r\ny", "\n a"]
    cases += ["<|endoftext|>", "a <|endoftext|>", "<|endoftext|", "one two\none  two", "e\u0301 e\u0301a \u0301", "x " * 2500]
    cases += ["a\u00a0 b", "a\u00a0", "\n\nx", "x\n", "a\u2028b c", "x\x1cy z"]
    wanted = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in cases]
    ids, counts = encoder.encode(pa.array(cases))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == wanted
    for text, whole in zip(cases, wanted):
        ids, counts = encoder.encode(pa.array([None, text]))
        assert (ids.tolist(), counts.tolist()) == (whole, [0, len(whole)]), repr(text)


def test_new_words_are_encoded_many_at_a_time(monkeypatch):
    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    marks = [" ", "\n", ". ", ", "]
    words = [f"{'xé中' * (i % 4)}{i}w{i % 7}'s" if i % 2 else "ab" + "cde中é"[i % 5] * (i % 9) + chr(97 + i % 26) * (i // 26) for i in range(600)]
    cases = ["".join(w + marks[(i + k) % 4] for i, w in enumerate(words[k:])).strip() for k in range(3)]
    wanted = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in cases]

    def alone(text):
        raise AssertionError(f"{text!r} was encoded alone")

    monkeypatch.setattr(encoder, "_whole", alone)
    ids, counts = encoder.encode(pa.array(cases))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == wanted
    # Words that can't be told apart are encoded one by one.
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    for _ in range(4):
        for k in (0, 2, 1):
            assert encoder.encode(pa.array(cases[k : k + 1]))[0].tolist() == wanted[k]
    encoder = tokens.Encoder(tokenizer_path(), "<u2")
    encoder.bytes_of = encoder.bytes_of + 1
    ids, counts = encoder.encode(pa.array(cases))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == wanted
    mixed = ["a1b2 c-d e's5 f.g@h.org (i) <j>k|l", "x<|endoftext|>y", "l|>m t7's n's. o'-p q!!! é1 1é"]
    wanted = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in mixed]
    for text, whole in zip(mixed, wanted):
        assert tokens.Encoder(tokenizer_path(), "<u2").encode(pa.array([text]))[0].tolist() == whole


def test_names_of_special_tokens_are_that_token(spark):
    rows = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "a b")], "doc_id long, text string")
    found = tokens.tokenized(rows, tokenizer_path()).orderBy("doc_id").collect()
    assert [r.n_tokens for r in found] == [5, 3]


def test_every_shard_is_a_task(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    path = tokens.new_folder(spark)
    assert path.startswith("file:/")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = tokens.write_corpus(docs.repartition(8), path, tokenizer_path())
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = manifest.count()
    found = tokens.read_corpus(path, manifest)
    assert shards > 1 and found.rdd.getNumPartitions() == shards
    assert found.count() == 5000


def test_long_texts_hash_as_short_ones(monkeypatch):
    text = (CLEAN + " é中 ").encode() * 20
    whole = common.word_hashes(text, common.IN_WORD)
    monkeypatch.setattr(common, "_PIECE", 100)
    assert (common.word_hashes(text, common.IN_WORD) == whole).all() and len(whole) == len(text.split())


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "mixing", "token files"]
