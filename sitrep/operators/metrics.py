"""Counters of a whole run, batch and streaming stages alike, as one table."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_PREFIX = "stage:"


class _Progress(StreamingQueryListener):
    """Counts of streaming stages by query and micro-batch; one that is repeated replaces itself."""

    def __init__(self):
        self.counts = {}
        self.ended = {}
        self.lock = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        with self.lock:
            for name, row in progress.observedMetrics.items():
                if name.startswith(_PREFIX):
                    self.counts[name.removeprefix(_PREFIX), str(progress.id), progress.batchId] = row.asDict()

    def onQueryTerminated(self, event):
        with self.lock:
            self.ended[str(event.runId)] = True
            self.lock.notify_all()


class RunMetrics:
    """Counts rows where they pass: wrap a stage's DataFrame, run the job, read the table.

    >>> with RunMetrics(spark) as metrics:
    ...     write_jsonl(metrics.stage(reports, "exported"), "out")
    ...     metrics.table()

    A stage counts its rows in the job that uses them, without another pass. Batch stages
    count in the first action on the wrapped DataFrame; stages of a stream in each of its
    micro-batches. Stages with one name add up, but ``key`` names a piece of work: the same
    piece done again, as by a restarted stream, replaces its counts.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._observed = {}
        self._listener = _Progress()

    def __enter__(self) -> RunMetrics:
        self.spark.streams.addListener(self._listener)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self._listener)

    def stage(self, df: DataFrame, name: str, key: str | None = None, **sums: Column) -> DataFrame:
        """``df``, its rows counted as stage ``name``; ``sums`` are further expressions to add up."""
        columns = [F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in sums.items()]]
        if df.isStreaming:
            return df.observe(_PREFIX + name, *columns)
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        self._observed[name, key or uuid.uuid4().hex] = seen
        return df.observe(seen, *columns)

    def await_stream(self, query) -> None:
        """Wait until a streaming query has ended and its last counts have arrived."""
        try:
            query.awaitTermination()
        finally:
            with self._listener.lock:
                self._listener.lock.wait_for(lambda: str(query.runId) in self._listener.ended, timeout=60)

    def table(self) -> DataFrame:
        """``stage, counter, n``, one row per counter of a stage. Every batch stage must have run."""
        total = {}
        with self._listener.lock:
            rows = [(stage, counts) for (stage, _, _), counts in self._listener.counts.items()]
        rows += [(stage, seen.get) for (stage, _), seen in self._observed.items()]
        for stage, counts in rows:
            for counter, n in counts.items():
                total[stage, counter] = total.get((stage, counter), 0) + n
        found = [(stage, counter, n) for (stage, counter), n in sorted(total.items())]
        return self.spark.createDataFrame(found, "stage string, counter string, n bigint")
