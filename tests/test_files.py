"""Readers and writers."""

import gzip
import json
import os
import random
import zlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sitrep.operators import keywords
from sitrep.sinks import commits
from sitrep.sinks import jsonl as sinks
from sitrep.sources import warc, warc_parts
from sitrep.sources.archive import warc_paths
from sitrep.sources.jsonl import read_jsonl, union_sources, with_file
from sitrep.streaming import jobs


def write(path, data):
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_blank_lines_are_skipped_and_types_kept(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"a":[1,{"b":"2"}]}\n\n  \n{"c":null}\n')
    rows = [r[0] for r in read_jsonl(spark, path).select(F.to_json("record")).collect()]
    assert sorted(rows) == ['{"a":[1,{"b":"2"}]}', '{"c":null}']


def test_malformed_line_fails(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"a":1}\n{bad\n')
    for schema in (None, "a int"):
        with pytest.raises(Exception, match="Malformed|FAILED_READ|MALFORMED"):
            read_jsonl(spark, path, schema).collect()


def test_missing_paths(spark, tmp_path):
    path, missing = write(tmp_path / "a.jsonl", '{"a":1}\n'), str(tmp_path / "none.jsonl")
    assert read_jsonl(spark, [missing, path], "a int", missing="skip").count() == 1
    assert read_jsonl(spark, [missing], "a int", missing="skip").count() == 0
    with pytest.raises(AnalysisException):
        read_jsonl(spark, [missing, path], "a int")


def test_lineage_and_union(spark, tmp_path):
    one = read_jsonl(spark, write(tmp_path / "a.jsonl", '{"a":1}\n'), "a int")
    two = read_jsonl(spark, write(tmp_path / "b.jsonl", '{"b":2}\n'), "b int")
    assert with_file(one).first()["source_file"].endswith("a.jsonl")
    assert sorted(map(str, union_sources(one, two).collect())) == ["Row(a=1, b=None)", "Row(a=None, b=2)"]


def test_export_modes_counts_and_text(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "é"), (2, None)], "a int, b string")
    assert sinks.write_jsonl(df, path) == 2
    assert sinks.append_jsonl(df, path) == 2
    assert read_jsonl(spark, path, "a int, b string").count() == 4
    assert sinks.write_jsonl(df, path, single_file=True) == 2
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 1
    lines = (tmp_path / "out" / files[0]).read_text(encoding="utf-8").splitlines()
    assert lines == ['{"a":1,"b":"é"}', '{"a":2,"b":null}']


def test_records_are_exported_as_they_are(spark, tmp_path):
    source = write(tmp_path / "a.jsonl", '{"b":[1,{"c":"x"}],"a":null}\n')
    sinks.write_jsonl(read_jsonl(spark, source), str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == ['{"a":null,"b":[1,{"c":"x"}]}']


def test_listing(spark, tmp_path):
    write(tmp_path / "paths.gz", gzip.compress(b"b/2\n\n  a/1 \nc/3\n"))
    found = [r.path for r in warc_paths(spark, str(tmp_path / "paths.gz"), 2).collect()]
    assert found == ["https://data.commoncrawl.org/b/2", "https://data.commoncrawl.org/a/1"]
    assert warc_paths(spark, str(tmp_path / "paths.gz")).count() == 3


def terms(spark):
    rows = [("swa", "mafuriko", 2), ("swa", 'a "q" \\ é', 1), ("tgl", "baha", 0), ("xxx", "no", 0)]
    return spark.createDataFrame(rows, "lang string, term string, ord bigint")


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_dictionary_file(spark, tmp_path, coalesced):
    path = tmp_path / "dictionary"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    try:
        sinks.write_dictionary(terms(spark), str(path), ("swa", "amh", "tgl"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert (len(parts) > 1) == (coalesced == "false")
    whole = json.loads("".join((path / f).read_text(encoding="utf-8") for f in parts))
    assert whole["keywords"] == {"swa": ['a "q" \\ é', "mafuriko"], "amh": [], "tgl": ["baha"]}
    assert whole["metadata"]["target_languages"] == ["swa", "amh", "tgl"]
    back = sinks.read_dictionary(spark, str(path))
    assert sorted(map(tuple, back.collect())) == [("swa", 'a "q" \\ é', 0), ("swa", "mafuriko", 1), ("tgl", "baha", 0)]
    assert sorted(r.keyword for r in keywords.flatten_keywords(back).collect()) == ['a "q" \\ é', "baha", "mafuriko"]
    other = write(tmp_path / "other.json", json.dumps(whole, indent=2))
    assert sorted(map(tuple, sinks.read_dictionary(spark, other).collect())) == sorted(map(tuple, back.collect()))


def test_publish(spark, tmp_path):
    artifact = write(tmp_path / "a.jsonl", '{"language_inferred":"SW-en","x":"é"}\n{"language_inferred":"am"}\n')
    target = str(tmp_path / "final")
    assert not sinks.publish_if_compliant(spark, artifact, target, targets=("swa", "tgl"))
    assert not os.path.exists(target)
    assert sinks.publish_if_compliant(spark, artifact, target, targets=("swa", "amh"), threshold=0.5)
    assert sorted(r[0] for r in spark.read.text(commits.published(spark, target)).collect()) == [
        '{"language_inferred":"SW-en","x":"é"}', '{"language_inferred":"am"}',
    ]
    with pytest.raises(FileNotFoundError):
        sinks.publish_if_compliant(spark, str(tmp_path / "none.jsonl"), target)


def record(kind, uri, block, extra=b""):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(block)}\r\n".encode()
    return head + extra + b"\r\n" + block + b"\r\n\r\n"


def http(body, *headers):
    return b"HTTP/1.1 200 OK\r\n" + b"".join(h + b"\r\n" for h in headers) + b"\r\n" + body


def test_warc_segments(spark, tmp_path):
    page = "<html>café".encode()
    html = b"Content-Type: text/html; charset=utf-8"
    members = [
        record("warcinfo", "", b"software: x\r\n"),
        record("request", "http://a", b"GET / HTTP/1.1\r\n\r\n"),
        record("response", "http://a", http(page, html)),
        record("response", "http://gz", http(gzip.compress(page), html, b"Content-Encoding: gzip")),
        record("response", "http://chunk", http(b"3\r\n<ht\r\n4;x\r\nml>!\r\n0\r\n\r\n", html, b"Transfer-Encoding: chunked")),
        record("response", "http://img", http(b"\x89PNG\r\n\r\nWARC/1.0", b"content-type: image/png")),
        record("response", "http://bad", http(b"ok\xff\xfe", html)),
    ]
    write(tmp_path / "one.warc.gz", b"".join(gzip.compress(m) for m in members))
    write(tmp_path / "two.warc", b"".join(members[:3]))
    write(tmp_path / "cut.warc.gz", (gzip.compress(members[2]) + gzip.compress(members[3]))[:-40])
    write(tmp_path / "junk.warc.gz", b"not gzip at all")
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    by = {}
    for r in rows:
        by.setdefault(os.path.basename(r.segment), []).append(r)
    one = by["one.warc.gz"]
    assert [r.rec_type for r in one] == ["warcinfo", "request"] + ["response"] * 5
    payloads = {r.target_uri: bytes(r.payload) for r in one if r.rec_type == "response"}
    assert payloads == {"http://a": page, "http://gz": page, "http://chunk": b"<html>!", "http://img": b"\x89PNG\r\n\r\nWARC/1.0", "http://bad": b"ok\xff\xfe"}
    assert len(by["two.warc"]) == 3 and all(r.error is None for r in by["two.warc"])
    assert by["cut.warc.gz"][0].target_uri == "http://a" and "cut off" in by["cut.warc.gz"][-1].error
    assert [r.error is not None for r in by["junk.warc.gz"]] == [True]
    assert warc.html_responses(warc.read_warc(spark, str(tmp_path / "one.warc.gz"))).count() == 4
    only = warc.read_warc(spark, str(tmp_path / "one.warc.gz"), "response", "image/")
    assert [r.target_uri for r in only.collect()] == ["http://img"]
    assert warc.read_warc(spark, str(tmp_path)).rdd.getNumPartitions() == 4


def test_stream_takes_only_new_files(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    schema = "id int, content string"
    write(source / "1.json", '{"id":1,"content":"a@b.c"}\n')
    jobs.stream_scrub(spark, str(source), target, state, schema).awaitTermination()
    write(source / "2.json", '{"id":2,"content":"10.0.0.1"}\n')
    jobs.stream_scrub(spark, str(source), target, state, schema).awaitTermination()
    rows = {r.id: r.content for r in read_jsonl(spark, target, schema).collect()}
    assert rows == {1: "[REDACTED_EMAIL]", 2: "[REDACTED_IP_ADDRESS]"}


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_dedup_with_watermark(spark, tmp_path, salts):
    source = tmp_path / "in"
    source.mkdir()
    rows = [{"k": i % 3, "t": f"2024-01-01T00:00:0{i % 10}Z"} for i in range(30)]
    for part in range(5):
        write(source / f"{part}.json", "".join(json.dumps(r) + "\n" for r in rows[part::5]))
    stream = jobs.stream_jsonl(spark, str(source), "k int, t timestamp")
    first = jobs.stream_dedup(stream, ["k"], "t", "1 hour", salts)
    jobs.write_stream(first, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.k for r in read_jsonl(spark, str(tmp_path / "out"), "k int").collect()) == [0, 1, 2]


@pytest.mark.parametrize("one_member", [False, True])
def test_split_segments_give_the_same_records(spark, tmp_path, one_member):
    rng = random.Random(3)
    members = []
    for i in range(300):
        body = bytes(rng.randrange(256) for _ in range(rng.choice((0, 10, 3000)))) + b"\x1f\x8b\x08 not a member"
        members.append(record("response", f"http://{i}", http(body, b"Content-Type: text/html")))
    data = gzip.compress(b"".join(members)) if one_member else b"".join(map(gzip.compress, members))
    path = write(tmp_path / "big.warc.gz", data)
    whole = warc.read_warc(spark, path).orderBy("target_uri").collect()
    assert len(whole) == 300 and all(r.error is None for r in whole)
    for size in (1000, 37_777, len(data) - 1, len(data)):
        split = warc.read_warc(spark, path, split_bytes=size)
        assert split.orderBy("target_uri").collect() == whole
    assert warc.read_warc(spark, path, split_bytes=37_777).rdd.getNumPartitions() == -(-len(data) // 37_777)


def test_unwanted_archive_records_are_passed_over_in_pieces():
    import io

    class Counted(io.BytesIO):
        largest = 0

        def read(self, n=-1):
            self.largest = max(self.largest, n)
            return super().read(n)

    def record(kind, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    stream = Counted(record("request", b"x" * 5_000_000) + record("response", b"ok") + record("request", b""))
    found = list(warc.warc_records(stream, types=["response"]))
    assert [body for _, body in found] == [b"ok"] and 0 < stream.largest <= 1 << 16
    with pytest.raises(EOFError):
        list(warc.warc_records(io.BytesIO(record("request", b"xyz")[:-6]), types=["response"]))


BODIES = [
    http(b"plain", b"Content-Type: text/html"),
    http(b"", b"Content-Type: text/html"),
    http(gzip.compress(b"zipped " * 5000), b"Content-Encoding: gzip"),
    http(zlib.compress(b"deflated " * 5000), b"Content-Encoding: deflate"),
    http(zlib.compress(b"bare " * 5000)[2:-4], b"Content-Encoding: deflate"),
    http(b"not zipped", b"Content-Encoding: gzip"),
    http(gzip.compress(b"one") + gzip.compress(b"two"), b"Content-Encoding: gzip"),
    http(gzip.compress(b"cut off " * 900)[:40], b"Content-Encoding: gzip"),
    http(b"5\r\nhello\r\n6;x=1\r\n world\r\n0\r\n\r\n", b"Transfer-Encoding: chunked"),
    http(b"5\r\nhello\r\nzz\r\n", b"Transfer-Encoding: chunked"),
    http(b"no chunks here", b"Transfer-Encoding: chunked"),
    http(b"line\r\nno chunks here", b"Transfer-Encoding: chunked"),
    http(b"ff\r\nshort", b"Transfer-Encoding: chunked"),
    http(b"a\r\n" + gzip.compress(b"both")[:10] + b"\r\n" + b"%x\r\n" % (len(gzip.compress(b"both")) - 10) + gzip.compress(b"both")[10:] + b"\r\n0\r\n\r\n", b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip"),
    b"HTTP/1.1 200 OK\nContent-Type: text/x\n\nunix lines",
    b"HTTP/1.1 200 OK",
    b"no http at all",
    b"",
]


@pytest.mark.parametrize("one_member", [False, True])
@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_pieces_and_places_give_the_whole_payloads(spark, tmp_path, one_member, piece):
    members = [record("response", f"http://{i:02d}", body) for i, body in enumerate(BODIES)]
    data = gzip.compress(b"".join(members)) if one_member else b"".join(map(gzip.compress, members))
    path = write(tmp_path / "all.warc.gz", data)
    plain = write(tmp_path / "all.warc", b"".join(members))
    for each in (path, plain):
        whole = {r.target_uri: (r.content_type, bytes(r.payload)) for r in warc.read_warc(spark, each).collect()}
        assert len(whole) == len(BODIES)
        if piece > 1 or each == path:
            found = {}
            for r in warc_parts.warc_pieces(spark, each, piece_bytes=piece).orderBy("target_uri", "piece").collect():
                assert r.error is None and len(r.payload) <= piece
                kind, held, n, _ = found.get(r.target_uri, (r.content_type, b"", 0, False))
                assert r.piece == n
                found[r.target_uri] = (kind, held + bytes(r.payload), n + 1, r.last)
            assert {k: v[:2] for k, v in found.items()} == whole and all(v[3] for v in found.values())
        index = warc_parts.warc_index(spark, each)
        read = warc_parts.read_records(index.where("target_uri <> 'http://03'").union(index.where("target_uri = 'http://01'")))
        rows = [(r.target_uri, (r.content_type, bytes(r.payload))) for r in read.collect()]
        assert sorted(rows) == sorted([(k, v) for k, v in whole.items() if k != "http://03"] + [("http://01", whole["http://01"])])


def test_places_open_only_their_members(tmp_path):
    members = [gzip.compress(record("response", f"http://{i}", http(b"x" * 50_000, b"Content-Type: text/html"))) for i in range(50)]
    path = write(tmp_path / "big.warc.gz", b"".join(members) + b"junk that no place points to")
    read = []

    class Spied:
        def __init__(self, raw):
            self.raw = raw

        def read(self, n):
            part = self.raw.read(n)
            read.append(len(part))
            return part

        def seek(self, n):
            return self.raw.seek(n)

    with open(path, "rb") as raw:
        member = warc_parts._Member(warc_parts._stream(Spied(raw), path, len(members[0])))
        head, body = member.record(0)
    assert head["warc-target-uri"] == "http://1" and body.endswith(b"x" * 100)
    assert sum(read) <= 1 << 17


def test_places_of_many_records_in_one_member(spark, tmp_path):
    body = http(b"x" * 40, b"Content-Type: text/html")
    path = write(tmp_path / "many.warc.gz", gzip.compress(b"".join(record("response", f"http://{i}", body) for i in range(3000))))
    index = warc_parts.warc_index(spark, path).coalesce(1).sortWithinPartitions("inside").cache()
    for rows in (10_000, 700):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        try:
            found = warc_parts.read_records(index).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert all(r.error is None for r in found)
        assert sorted(r.target_uri for r in found) == sorted(f"http://{i}" for i in range(3000))
    # A place between two records is wrong; the records after it are still found.
    some = index.where("target_uri in ('http://700', 'http://800')")
    wrong = some.where("target_uri = 'http://700'").withColumn("inside", F.col("inside") + 3)
    found = warc_parts.read_records(some.union(wrong).coalesce(1)).collect()
    assert sorted(r.target_uri or "" for r in found) == ["", "http://700", "http://800"]


def test_a_member_stays_open_between_batches(tmp_path):
    body = http(b"x" * 40, b"Content-Type: text/html")
    path = write(tmp_path / "many.warc.gz", gzip.compress(b"".join(record("response", f"http://{i}", body) for i in range(5))))
    with open(path, "rb") as raw:
        member = warc_parts._Member(warc_parts._stream(raw, path, 0))
        size = len(record("response", "http://0", body))
        assert member.record(size)[0]["warc-target-uri"] == "http://1"
        assert member.ahead(size) and member.ahead(2 * size) and not member.ahead(0)
        assert member.record(4 * size)[0]["warc-target-uri"] == "http://4"
        with pytest.raises(EOFError):
            member.record(9 * size)
        assert not member.ahead(9 * size)


def test_broken_segments_and_wrong_places(spark, tmp_path):
    good = gzip.compress(record("response", "http://a", http(b"x", b"Content-Type: text/html")))
    path = write(tmp_path / "cut.warc.gz", good + good[:-20])
    for rows in (warc_parts.warc_index(spark, path).collect(), warc_parts.warc_pieces(spark, path).collect()):
        assert rows[0].error is None and rows[0].target_uri == "http://a" and rows[-1].error
    wrong = spark.createDataFrame([(path, 5, 0), (path, None, None)], "segment string, place long, inside long")
    assert [r.error is not None for r in warc_parts.read_records(wrong).collect()] == [True]
    broken = http(gzip.compress(bytes(range(256)) * 4000)[:-3000] + b"\0" * 3000, b"Content-Encoding: gzip")
    path = write(tmp_path / "broken.warc", record("response", "http://b", broken))
    rows = warc_parts.warc_pieces(spark, path, piece_bytes=1000).orderBy("piece").collect()
    assert rows[-1].last and all(not r.last for r in rows[:-1])


def test_long_payloads_are_named_whatever_their_encoding(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MAX_PAYLOAD", 1000)
    bodies = [http(b"y" * 2000, b"Content-Type: text/html"), http(gzip.compress(b"y" * 2000), b"Content-Encoding: gzip"), http(b"ok", b"")]
    path = write(tmp_path / "long.warc", b"".join(record("response", f"http://{i}", b) for i, b in enumerate(bodies)))
    rows = warc.read_warc(spark, path).orderBy("target_uri").collect()
    assert [r.error is not None for r in rows] == [True, True, False]
