"""JSON Lines input."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

logger = logging.getLogger(__name__)


def read_jsonl(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | StructType | None = None,
    missing: str = "fail",
) -> DataFrame:
    """Read JSON Lines; blank lines are skipped, a malformed line fails the job.

    Without a schema every line becomes one VARIANT column ``record``, so nothing
    has to be inferred and mixed types survive. ``missing="skip"`` leaves out paths
    that do not exist, with a warning; if all are missing the result is empty and
    needs no schema to be given.
    """
    if missing not in ("fail", "skip"):
        raise ValueError("missing must be 'fail' or 'skip'")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if missing == "skip":
        paths = [p for p in paths if _exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema or "record variant")
    reader = spark.read.option("mode", "FAILFAST")
    if schema is None:
        return reader.option("singleVariantColumn", "record").json(paths)
    return reader.schema(schema).json(paths)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any that a pattern stands for, is in its file system; nothing is read."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    if found:
        return True
    logger.warning("input missing, skipped: %s", path)
    return False


def with_file(df: DataFrame, into: str = "source_file") -> DataFrame:
    """Add the name of the file each row was read from."""
    return df.withColumn(into, F.col("_metadata.file_path"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
