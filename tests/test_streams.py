"""Append log, published versions, stateful streams and run metrics: restarts, failures, edge rows."""

import contextlib
import json

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from sitrep.operators.metrics import RunMetrics
from sitrep.sinks import commits
from sitrep.streaming import jobs


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_a_run_counts_once_and_a_dead_attempt_never(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.range(100).repartition(4)
    assert commits.read_log(spark, log, "id long").count() == 0
    assert commits.append_once(rows, log, "a/1 ü") == 100
    assert commits.append_once(rows, log, "a/1 ü") == 0
    dies = rows.withColumn("id", F.expr("CASE WHEN id = 99 THEN raise_error('x') ELSE id END"))
    with pytest.raises(PySparkException):
        commits.append_once(dies, log, "b")
    assert commits.read_log(spark, log, "id long").count() == 100
    assert commits.append_once(rows.limit(0), log, "empty") == 0
    assert commits.append_once(rows.limit(5), log, "b") == 5
    assert sorted((r.run, r.rows) for r in commits.runs(spark, log).collect()) == [("a/1 ü", 100), ("b", 5), ("empty", 0)]
    assert commits.read_log(spark, log, "id long").count() == 105


def test_the_first_of_two_attempts_counts(spark, tmp_path):
    path = str(tmp_path / "commits") + "/run.json"
    assert commits.name_in_one_step(spark, path, {"folder": "one"})
    assert not commits.name_in_one_step(spark, path, {"folder": "two"})
    assert spark.read.json(path).first()["folder"] == "one"
    assert commits.name_in_one_step(spark, path, {"folder": "three"}, replace=True)
    assert spark.read.json(path).first()["folder"] == "three"


def test_a_failed_publish_leaves_the_last_version(spark, tmp_path):
    target = str(tmp_path / "target")
    with pytest.raises(FileNotFoundError):
        commits.published(spark, target)
    lines = spark.createDataFrame([("a",), ("b",)], "value string")
    first = commits.publish(lines, target)
    dies = lines.repartition(2).withColumn("value", F.expr("CASE WHEN value = 'b' THEN raise_error('x') ELSE value END"))
    with pytest.raises(PySparkException):
        commits.publish(dies, target)
    assert commits.published(spark, target) == first
    assert sorted(r.value for r in spark.read.text(first).collect()) == ["a", "b"]
    second = commits.publish(lines.limit(1), target)
    assert commits.published(spark, target) == second != first


SCHEMA = "k string, o long, t timestamp, b double"


def test_first_seen_by_order_null_keys_and_restart(spark, tmp_path):
    source, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    big = 2**53
    land(source, "1.json", [{"k": "a", "o": big + 1}, {"k": "a", "o": big}, {"k": None, "o": 3, "b": 0.1}, {"k": None, "o": None, "t": "2024-01-01T00:00:00.123456Z"}])

    def go():
        stream = jobs.first_seen(jobs.stream_jsonl(spark, str(source), SCHEMA), ["k"], ["o"])
        jobs.append_stream(stream, log, "first", state).awaitTermination()
        return sorted(((r.k, r.o, str(r.t), r.b) for r in commits.read_log(spark, log, SCHEMA).collect()), key=repr)

    wanted = [("a", big, "None", None), (None, None, "2024-01-01 00:00:00.123456", None)]
    assert go() == sorted(wanted, key=repr)
    land(source, "2.json", [{"k": "a", "o": 1}, {"k": "z", "o": 5}, {"k": None, "o": -1}])
    assert go() == sorted([*wanted, ("z", 5, "None", None)], key=repr)


def test_first_seen_forgets_after_the_watermark(spark, tmp_path):
    source, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")

    def go(name, *rows):
        land(source, name, [{"k": k, "o": i, "t": f"2024-01-01T{t}Z"} for i, (k, t) in enumerate(rows)])
        stream = jobs.stream_jsonl(spark, str(source), SCHEMA)
        first = jobs.first_seen(stream, ["k"], ["o"], "t", "10 minutes")
        jobs.append_stream(first, log, "first", state).awaitTermination()
        return sorted(r.t.strftime("%H:%M") for r in commits.read_log(spark, log, SCHEMA).where("k = 'a'").collect())

    assert go("1.json", ("a", "00:00:00"), ("b", "00:01:00")) == ["00:00"]
    assert go("2.json", ("a", "00:05:00"), ("b", "03:00:00")) == ["00:00"]
    # The watermark is at 02:50: the key is forgotten, so its next row is a first one.
    assert go("3.json", ("b", "03:01:00")) == ["00:00"]
    assert go("4.json", ("a", "03:02:00")) == ["00:00", "03:02"]


def test_adapted_stream_repeats_nothing_after_a_stop(spark, tmp_path):
    source, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    land(source, "1.json", [{"id": i, "w": "x"} for i in range(10)])
    land(source, "2.json", [{"id": i, "w": "bad" if i == 15 else "x"} for i in range(10, 20)])
    stream = spark.readStream.schema("id long, w string").option("maxFilesPerTrigger", 1).json(str(source))

    def refuses(batch, operation):
        if (batch["w"] == "bad").any():
            raise ValueError("bad")
        return batch.assign(w=batch["w"].str.upper())

    ran = []

    def stops(rows, run):
        ran.append(run)
        if len(ran) == 2:
            raise RuntimeError("stopped before the run is in the log")
        from sitrep.operators import adapt

        return adapt.adapt_batches(rows, "op", refuses)

    with contextlib.suppress(StreamingQueryException):
        jobs.append_stream(stream, log, "op", state, stops, "parquet").awaitTermination()
    with RunMetrics(spark) as metrics:
        metrics.await_stream(jobs.stream_adapt(metrics.stage(stream, "in"), "op", log, state, refuses, metrics=metrics))
        found = {(r.stage, r.counter): r.n for r in metrics.table().collect()}
    ok, failed = jobs.adapted_rows(spark, log, "op", "id long, w string")
    assert sorted(r.id for r in ok.collect()) == list(range(10)) and {r.w for r in ok.collect()} == {"X"}
    assert sorted(json.loads(r["__source_record"])["id"] for r in failed.collect()) == list(range(10, 20))
    # Only the stopped micro-batch ran again.
    assert found == {("in", "rows"): 10, ("op", "rows"): 10, ("op", "failed"): 10, ("op", "adapted"): 0}


def test_metrics_of_repeated_work_replace_it(spark):
    with RunMetrics(spark) as metrics:
        for n in (5, 7):
            metrics.stage(spark.range(n), "one", "piece").count()
        metrics.stage(spark.range(3), "one", twice=F.col("id") * 2).collect()
        rows = {(r.stage, r.counter): r.n for r in metrics.table().collect()}
    assert rows == {("one", "rows"): 10, ("one", "twice"): 6}


def test_first_seen_without_python_per_key(spark, tmp_path):
    """Many keys over many files and partitions, each asked of the state by Spark itself."""
    source, log, state = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "state")
    for i in range(4):
        land(source, f"{i}.json", [{"k": f"k{n % 3000}", "o": (n * 7919 + i) % 5003} for n in range(i * 3000, i * 3000 + 6000)])
    wanted = {}
    for i in range(4):
        for n in range(i * 3000, i * 3000 + 6000):
            wanted[f"k{n % 3000}"] = min((n * 7919 + i) % 5003, wanted.get(f"k{n % 3000}", 9999))
    stream = jobs.first_seen(jobs.stream_jsonl(spark, str(source), SCHEMA), ["k"], ["o"])
    query = jobs.append_stream(stream, log, "first", state)
    query.awaitTermination()
    assert [s["operatorName"] for p in query.recentProgress for s in p["stateOperators"]][:1] == ["dedupe"]
    assert {r.k: r.o for r in commits.read_log(spark, log, SCHEMA).collect()} == wanted
