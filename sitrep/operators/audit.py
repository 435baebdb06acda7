"""Language balance of a dataset and run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import text


def lang_distribution(
    df: DataFrame, lang_col: str = "language_inferred", aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows and share of every primary language: ``primary_lang, n, share``; empty for no rows."""
    counts = df.groupBy(text.normalize_lang(lang_col, aliases).alias("primary_lang")).agg(
        F.count("*").alias("n")
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def lang_gate(
    distribution: DataFrame,
    targets: Sequence[str] = C.TARGET_LANGS,
    threshold: float = C.MIN_SHARE,
) -> DataFrame:
    """Share of every target language and whether it passes: ``lang, share, passed``."""
    spark = distribution.sparkSession
    wanted = spark.createDataFrame([(t,) for t in targets], "lang string")
    # At most one row per target language.
    known = distribution.where(F.col("primary_lang").isin(*targets)).select(
        F.col("primary_lang").alias("lang"), "share"
    )
    share = F.coalesce("share", F.lit(0.0))
    return wanted.join(F.broadcast(known), "lang", "left").select(
        "lang", share.alias("share"), (share >= threshold).alias("passed")
    )


def audit_gate(
    df: DataFrame,
    lang_col: str = "language_inferred",
    targets: Sequence[str] = C.TARGET_LANGS,
    threshold: float = C.MIN_SHARE,
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row ``compliant``: every target language reaches the threshold; false for no rows."""
    distribution = lang_distribution(df, lang_col, aliases)
    return gate_result(lang_gate(distribution, targets, threshold))


def gate_result(gate: DataFrame) -> DataFrame:
    """All languages passed, as one row ``compliant``."""
    return gate.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("compliant"))


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while they pass: read ``observation.get["n"]`` after the action."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("n")), observation
