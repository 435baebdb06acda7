"""Building blocks that keep the operators safe on large and skewed inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest table that is broadcast or held by one process.
MAX_ROWS = 200_000
MAX_BYTES = 32 * 1024 * 1024
# Tasks that share a key of a streaming job.
SALTS = 16


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder the session names in ``spark.checkpoint.dir``.

    All paths of an application lie in one folder, which can go when it has ended.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="sitrep-")
        # The setting itself is fixed once a session runs.
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    run = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/sitrep-{run}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; cuts the lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, label: str = "side") -> tuple[DataFrame, int, int]:
    """``df`` written once and read back, with its rows and about its bytes.

    The sizes are taken while writing, so ``df`` is computed exactly once.
    """
    path = scratch_dir(df.sparkSession, label)
    sizes = Observation()
    size = F.sum(row_bytes(df))
    df.observe(sizes, F.count(F.lit(1)).alias("rows"), size.alias("bytes")).write.parquet(path)
    found = sizes.get
    return df.sparkSession.read.schema(df.schema).parquet(path), found["rows"], found["bytes"] or 0


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: those of texts, eight for a number, JSON text only for nested columns."""
    total = F.lit(0)
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + 8 + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            total = total + 8
    return total.cast("long")


def is_small(rows: int, size: int) -> bool:
    """Whether a table of this size may be broadcast or held by one process."""
    return rows <= MAX_ROWS and size <= MAX_BYTES


def held_or_filed(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> tuple[list | None, str, int]:
    """Distinct rows of ``df``: a list if one process can hold them, else the path of a folder.

    The folder has ``part=0``, ``part=1``, …, as many as the last value says, hash buckets
    that one process can hold each. They never come to the driver.
    """
    df, rows, size = measured(df.distinct(), "terms")
    parts = max(-(-rows // max_rows), -(-size // max_bytes), 1)
    if parts == 1:
        return df.collect(), "", 1
    # Twice as many as needed on average, as buckets differ.
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(2 * parts)).alias("part")
    path = scratch_dir(df.sparkSession, "term-parts")
    df.select(*df.columns, bucket).repartition("part").write.partitionBy("part").parquet(path)
    return None, path, 2 * parts


def lookup_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join rows to a table with one row per key, however often ``left`` repeats a key.

    ``right`` is computed once and its size taken. A small table is broadcast and
    ``left`` stays where it is. With a larger one both sides are shuffled; adaptive
    execution measures the partitions and splits those of hot keys on the left, so that
    only where a key is hot its one row of ``right`` goes to several tasks.
    """
    right, rows, size = measured(right, "lookup")
    return left.join(F.broadcast(right) if is_small(rows, size) else right, list(on), how)


def in_ranges(df: DataFrame, order: Sequence[str], cuts: int | None = None) -> DataFrame:
    """``df`` dealt out by the engine in ranges of ``order`` and written with each row's ``__range``.

    Ranges ascend with the order and hold similar numbers of rows, whatever the keys. There
    are ``cuts`` of them, else as many as Spark shuffles to. Reading them back, all later
    steps see the same ranges.
    """
    dealt = df.repartitionByRange(*([cuts] if cuts else []), *order)
    return materialize(dealt.withColumn("__range", F.spark_partition_id()), "ranges")


def global_row_number(
    df: DataFrame, order: Sequence[str], into: str, cuts: int | None = None
) -> DataFrame:
    """Number all rows from 1 in the given order without sorting them in one task.

    ``order`` must name the rows uniquely. Rows are dealt out in ranges of the order
    (``cuts`` of them, else as many as Spark shuffles to) and written with their range, so
    that all later steps see the same ranges. Each range starts after the rows of the
    ranges before it, whose counts are one row per range.
    """
    ranged = in_ranges(df, order, cuts)
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range").orderBy(*order)
    return (
        ranged.withColumn("__place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "__range")
        .withColumn(into, F.col("__place") + F.col("__before"))
        .drop("__range", "__place", "__before")
    )
