"""Redaction of whole DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import text
from sitrep.functions.nested import once


def redact_columns(
    df: DataFrame,
    cols: Sequence[str] = C.REDACTED_COLUMNS,
    kinds: Iterable[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Redact the listed columns; names the DataFrame does not have are ignored."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: text.redact(c, kinds, strict) for c in present}) if present else df


def redact_records(
    df: DataFrame,
    cols: Sequence[str] = C.REDACTED_COLUMNS,
    record: str = "record",
    kinds: Iterable[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Redact the listed text fields of VARIANT records; all other fields stay as they are.

    Records without one of the fields as text pass unchanged.
    """
    present = [F.coalesce(F.schema_of_variant(F.try_variant_get(record, f"$.{c}", "variant")) == "STRING", F.lit(False)) for c in cols]
    # Only these fields are taken out as text, so the patterns run once per field.
    marked = once(
        df,
        F.struct(
            *[
                F.when(has, text.redact(F.try_variant_get(record, f"$.{c}", "string"), kinds, strict)).alias(f"c{i}")
                for i, (c, has) in enumerate(zip(cols, present))
            ]
        ),
        "__redacted",
    )
    clean = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"__redacted.c{i}"))])
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    replaced = F.transform_values(
        fields, lambda k, v: F.coalesce(F.try_element_at(clean, k).cast("variant"), v)
    )
    nothing = F.coalesce(*[F.col(f"__redacted.c{i}") for i in range(len(cols))]).isNull()
    out = F.when(nothing, F.col(record)).otherwise(F.to_variant_object(replaced))
    return marked.withColumn(record, out).drop("__redacted")
