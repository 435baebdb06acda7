"""Incremental versions: read what is new, write it, stop."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from sitrep import constants as C
from sitrep.operators import adapt
from sitrep.operators.metrics import RunMetrics
from sitrep.operators.redaction import redact_columns
from sitrep.operators.scale import SALTS
from sitrep.sinks import commits


def stream_jsonl(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON Lines files as they arrive in a folder; a malformed line fails the query."""
    return spark.readStream.schema(schema).option("mode", "FAILFAST").json(path)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to JSON Lines, each input file exactly once."""
    return (
        stream.writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_scrub(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str | StructType,
    cols: Sequence[str] = C.REDACTED_COLUMNS,
) -> StreamingQuery:
    """Redact new JSON Lines files and append the result."""
    return write_stream(redact_columns(stream_jsonl(spark, source, schema), cols), target, checkpoint)


def stream_dedup(
    stream: DataFrame,
    keys: Sequence[str],
    event_time: str | None = None,
    within: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """First row per key.

    Without a time bound every key stays in the state. ``event_time`` and ``within``
    bound it: a key is forgotten when the watermark has passed it, so this is exact
    when all copies of a key lie within ``within``.

    Copies are first dropped per key and salt, so that ``salts`` tasks share the
    rows of a hot key; at most that many rows per key reach the final step.
    """
    keys = list(keys)

    def first(df: DataFrame, by: Sequence[str]) -> DataFrame:
        return df.dropDuplicates(by) if event_time is None else df.dropDuplicatesWithinWatermark(by)

    if event_time is not None:
        stream = stream.withWatermark(event_time, within)
    if salts > 1:
        # Any salt is right: what passes is checked again without it.
        salted = stream.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        stream = first(salted, [*keys, "__salt"]).drop("__salt")
    return first(stream, keys)


def append_stream(
    stream: DataFrame,
    log: str,
    name: str,
    checkpoint: str,
    batch: Callable[[DataFrame, str], DataFrame] | None = None,
    kind: str = "json",
) -> StreamingQuery:
    """Add everything available to an append log, each micro-batch as a run of its own.

    ``batch(rows, run)`` may change the rows of a micro-batch. A micro-batch that is repeated
    after a restart finds its run in the log and adds nothing.
    """

    def add(rows: DataFrame, number: int) -> None:
        run = f"{name}-{number}"
        commits.append_once(batch(rows, run) if batch else rows, log, run, kind)

    return (
        stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_adapt(
    stream: DataFrame,
    operation: str,
    log: str,
    checkpoint: str,
    fn: adapt.BatchFunction = adapt.identity,
    schema: StructType | None = None,
    batch_size: int = C.BATCH_SIZE,
    metrics: RunMetrics | None = None,
) -> StreamingQuery:
    """Adapt what arrives in batches; adapted rows and rows of failed batches go to one log.

    Both parts of a micro-batch are one run of the log, so that a restart can neither repeat
    nor lose a row, however ``fn`` fails. :func:`adapted_rows` reads them apart.
    """

    def run(rows: DataFrame, name: str) -> DataFrame:
        done = adapt.adapt_batches(rows, operation, fn, schema, batch_size)
        if metrics is None:
            return done
        failed = F.col(adapt.ERROR_COLUMN).isNotNull().cast("int")
        return metrics.stage(done, operation, name, failed=failed, adapted=1 - failed)

    return append_stream(stream, log, operation, checkpoint, run, "parquet")


def adapted_rows(
    spark: SparkSession, log: str, operation: str, schema: str | StructType
) -> tuple[DataFrame, DataFrame]:
    """``(ok, quarantine)`` of what :func:`stream_adapt` has logged so far."""
    plain = spark.createDataFrame([], schema).schema
    tagged = StructType(plain.fields).add(C.SOURCE_COLUMN, "string").add(adapt.ERROR_COLUMN, "string")
    return adapt.parted(commits.read_log(spark, log, tagged, "parquet"), operation)


def first_seen(
    stream: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    event_time: str | None = None,
    within: str | None = None,
) -> DataFrame:
    """The first row of every key: of the micro-batch a key first comes in, the first by ``order``.

    Rows that come later are dropped, also after a restart. Nulls come first, and null keys
    are a key. Without a time bound one flag per key stays in the state; ``event_time`` and
    ``within`` (a number of seconds, minutes, hours or days) forget a key once the watermark
    has passed its first row by that time. Without a bound, copies are dropped inside each
    Arrow batch before the shuffle, so that a hot key sends one row per batch, and after it
    in each partition, which holds one row per key of the micro-batch; the state is Spark's
    own, asked once per key without Python. Bounded streams go without that, as a watermark
    does not pass through it. Rows travel as JSON text, so that no column changes its type
    on the way.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    row = F.to_json(F.struct(*stream.columns), _EXACT).alias("__row")
    columns = [F.col(k).alias(n) for k, n in zip(keys, names)] + [F.struct(*order).alias("__order"), row]
    if event_time is not None:
        number, unit = within.split()
        within_ms = int(number) * _UNITS[unit.rstrip("s")]
        slim = stream.withWatermark(event_time, within).select(*columns, F.col(event_time).alias("__time"))
    else:
        slim = stream.select(*columns)
        slim = slim.mapInArrow(_leading_rows(names), slim.schema)
        slim = slim.repartition(*names).mapInArrow(_first_rows(names), slim.schema)
        return _plain_rows(slim.dropDuplicates(names), stream.schema)

    def first(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        found = [(_nulls_first(o), r, t) for f in frames for o, r, t in zip(f["__order"], f["__row"], f["__time"])]
        if state.exists or not found:
            return
        _, row, time = min(found, key=lambda x: x[0])
        state.update((True,))
        state.setTimeoutTimestamp(max(int(time.timestamp() * 1000) + within_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"__row": [row]})

    kept = slim.groupBy(*names).applyInPandasWithState(first, "__row string", "seen boolean", "append", GroupStateTimeout.EventTimeTimeout)
    return _plain_rows(kept, stream.schema)


def _plain_rows(kept: DataFrame, schema: StructType) -> DataFrame:
    return kept.select(F.from_json("__row", schema, _EXACT).alias("r")).select("r.*")


_EXACT = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false", "mode": "FAILFAST"}
_UNITS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def _nulls_first(order) -> list:
    values = order.values() if isinstance(order, dict) else order
    return [(False,) if v is None else (True, v) for v in values]


def _leading(batch: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    """The first row by ``__order`` of every key."""
    order = batch.column(batch.schema.get_field_index("__order"))
    fields = {f"o{i}": order.field(i) for i in range(order.type.num_fields)}
    place = pc.sort_indices(pa.table(fields), [(f, "ascending") for f in fields], null_placement="at_start")
    ranked = batch.take(place)
    rows = pa.table({n: ranked.column(n) for n in names} | {"row": pa.array(range(len(ranked)))})
    return ranked.take(rows.group_by(names).aggregate([("row", "min")]).column("row_min").combine_chunks())


def _leading_rows(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first row by ``__order`` of every key in each Arrow batch."""
    names = list(names)

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _leading(batch, names)

    return leading


def _first_rows(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The first row by ``__order`` of every key in a whole partition."""
    names = list(names)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, new = [], 0
        for batch in batches:
            held.append(batch)
            new += batch.num_rows
            # Rows wait until they are as many as the keys so far, so that each is compared a few times only.
            if new >= max(held[0].num_rows, 50_000):
                held, new = [_leading(pa.concat_batches(held), names)], 0
        if held:
            found = _leading(pa.concat_batches(held), names)
            for at in range(0, found.num_rows, 10_000):
                yield found.slice(at, 10_000)

    return first
