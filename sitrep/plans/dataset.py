"""Phases 2 to 4: adaptation, validation and publishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from sitrep import constants as C
from sitrep.operators import adapt, audit, keywords
from sitrep.operators.redaction import redact_columns


def adaptation_chain(
    df: DataFrame, keyword_table: DataFrame, lexicon: DataFrame, taxonomy: DataFrame, col: str, id_col: str
) -> DataFrame:
    """Noise filter, then intents and framework codes in one pass over the texts left."""
    kept = adapt.filter_noise(df, keyword_table, col, id_col)
    return keywords.with_all_matched_labels(
        kept, col, {"intents": (lexicon, "term", "intent"), "codes": (taxonomy, "term", "code")}
    )


def validated(
    df: DataFrame,
    cols: Sequence[str] = C.REDACTED_COLUMNS,
    lang_col: str = "language_inferred",
    targets: Sequence[str] = C.TARGET_LANGS,
    threshold: float = C.MIN_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """``(redacted, gate)``: the redacted rows and the share of every target language."""
    redacted = redact_columns(df, cols)
    gate = audit.lang_gate(audit.lang_distribution(df, lang_col), targets, threshold)
    return redacted, gate
