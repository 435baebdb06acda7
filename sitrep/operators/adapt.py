"""Batch adaptation: noise filter, intents, framework mapping, and user-supplied steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sitrep import constants as C
from sitrep.functions import nested
from sitrep.operators import dedup, keywords, scale

ERROR_COLUMN = "__error"

BatchFunction = Callable[[pd.DataFrame, str], pd.DataFrame]


def instruction(operation: Column, dataset: str = "crisis-report") -> Column:
    """Instruction text of an operation; other operations get a general sentence."""
    known = F.create_map(*[F.lit(x) for pair in C.OPERATION_INSTRUCTIONS.items() for x in pair])
    general = F.concat(
        F.lit(f"Apply the {dataset} adaptation operation '"), operation, F.lit("' to each record.")
    )
    return F.coalesce(F.try_element_at(known, operation), general)


def operation_spec(df: DataFrame, operation: str, dataset: str = "crisis-report") -> DataFrame:
    """Add instruction text and recipe flags of the operation named in a column."""
    op = F.col(operation)
    return df.withColumns(
        {
            "instruction": instruction(op, dataset),
            "deduplication": op.isin(*C.DEDUP_OPERATIONS),
            "prompt_rephrase": op.isin(*C.REPHRASE_OPERATIONS),
        }
    )


def record_of(df: DataFrame) -> Column:
    """The row as one VARIANT record; a lone VARIANT column ``record`` is used as it is."""
    if df.columns == ["record"] and isinstance(df.schema["record"].dataType, T.VariantType):
        return F.col("record")
    return F.to_variant_object(F.struct(*df.columns))


def envelope(df: DataFrame, operation: str) -> DataFrame:
    """Add the operation, the prompt and the source record to every row."""
    record = F.col("__record")
    enveloped = df.withColumn("__record", record_of(df)).withColumns(
        {
            C.OPERATION_COLUMN: F.lit(operation),
            C.PROMPT_COLUMN: nested.prompt(record),
            C.SOURCE_COLUMN: nested.canonical_json(record),
        }
    )
    return enveloped.drop("__record")


def strip_internal(df: DataFrame) -> DataFrame:
    """Remove the columns :func:`envelope` added."""
    return df.drop(*C.INTERNAL_COLUMNS)


def batch_assign(
    df: DataFrame, order: Sequence[str], size: int = C.BATCH_SIZE, into: str = "batch_id"
) -> DataFrame:
    """Number consecutive batches of ``size`` rows in the given order, from 0."""
    numbered = scale.global_row_number(df, order, "__n")
    return numbered.withColumn(into, F.floor((F.col("__n") - 1) / size)).drop("__n")


def identity(batch: pd.DataFrame, operation: str) -> pd.DataFrame:
    return batch


def adapt_batches(
    df: DataFrame,
    operation: str,
    fn: BatchFunction = identity,
    schema: T.StructType | None = None,
    batch_size: int = C.BATCH_SIZE,
) -> DataFrame:
    """Run ``fn(batch, operation)`` on batches of ``batch_size`` rows of each partition.

    ``fn`` sees the enveloped rows and may drop, change and add rows; ``schema`` names
    what it returns without the internal columns (default: the columns of ``df``).
    The result has those columns plus ``__source_record`` and ``__error``. A batch
    whose call fails, or whose result does not fit the schema, is not lost: its rows
    come back with only these two set.
    VARIANT columns travel as JSON text.
    """
    schema = schema or df.schema
    variants = [f.name for f in schema if isinstance(f.dataType, T.VariantType)]
    plain = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in variants else f.dataType) for f in schema]
    )
    tagged = T.StructType(
        [*plain.fields, T.StructField(C.SOURCE_COLUMN, T.StringType()), T.StructField(ERROR_COLUMN, T.StringType())]
    )
    enveloped = envelope(df, operation)
    enveloped = enveloped.withColumns(
        {f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, T.VariantType)}
    )
    wanted = plain.names
    columns = [*wanted, C.SOURCE_COLUMN, ERROR_COLUMN]
    arrow_schema = to_arrow_schema(tagged)

    def run(batches):
        import pyarrow as pa

        # Nullable pandas types, so that a null does not turn whole numbers into floats.
        nullable = {
            pa.int8(): pd.Int8Dtype(),
            pa.int16(): pd.Int16Dtype(),
            pa.int32(): pd.Int32Dtype(),
            pa.int64(): pd.Int64Dtype(),
            pa.bool_(): pd.BooleanDtype(),
        }

        def to_arrow(frame: pd.DataFrame) -> pa.RecordBatch:
            return pa.RecordBatch.from_pandas(frame[columns], arrow_schema, preserve_index=False)

        frames = (b.to_pandas(types_mapper=nullable.get) for b in batches)
        for batch in _rebatch(frames, batch_size):
            try:
                out = fn(batch.copy(), operation)
                missing = [c for c in wanted if c not in out.columns]
                if missing:
                    raise ValueError(f"result without {', '.join(missing)}")
                # Only rows that failed carry their source on.
                result = to_arrow(out.assign(**{c: None for c in [C.SOURCE_COLUMN, ERROR_COLUMN]}))
            except Exception as error:
                failed = batch[[C.SOURCE_COLUMN]].assign(**{c: None for c in wanted})
                result = to_arrow(failed.assign(**{ERROR_COLUMN: f"{type(error).__name__}: {error}"}))
            yield result

    result = enveloped.mapInArrow(run, tagged)
    return result.withColumns({v: F.parse_json(v) for v in variants}) if variants else result


def _rebatch(frames, size: int):
    """Batches of exactly ``size`` rows across Arrow batches; the last one may be shorter."""
    rest = None
    for frame in frames:
        rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        full = len(rest) // size * size
        for start in range(0, full, size):
            yield rest.iloc[start:start + size].reset_index(drop=True)
        rest = rest.iloc[full:]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def adapt(
    df: DataFrame,
    operation: str,
    fn: BatchFunction = identity,
    schema: T.StructType | None = None,
    batch_size: int = C.BATCH_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """``(ok, quarantine)`` of :func:`adapt_batches`.

    The result is written to the shared folder first, so ``fn`` runs once however
    often the two parts are read.
    """
    return parted(scale.materialize(adapt_batches(df, operation, fn, schema, batch_size), operation), operation)


def parted(done: DataFrame, operation: str) -> tuple[DataFrame, DataFrame]:
    """Adapted rows, and failed ones with their operation."""
    ok = done.where(F.col(ERROR_COLUMN).isNull()).drop(ERROR_COLUMN, *C.INTERNAL_COLUMNS)
    failed = done.where(F.col(ERROR_COLUMN).isNotNull()).select(
        F.lit(operation).alias("operation"), C.SOURCE_COLUMN, ERROR_COLUMN
    )
    return ok, failed


def adapt_steps(
    df: DataFrame, steps: Sequence[tuple[str, BatchFunction]], batch_size: int = C.BATCH_SIZE
) -> tuple[DataFrame, DataFrame]:
    """Run several operations one after the other; the quarantines are put together."""
    failures = []
    for operation, fn in steps:
        df, failed = adapt(df, operation, fn, batch_size=batch_size)
        failures.append(failed)
    return df, reduce(DataFrame.unionByName, failures)


def filter_noise(df: DataFrame, keyword_table: DataFrame, col: str, id_col: str) -> DataFrame:
    """Rows that mention a keyword, one per distinct text.

    The relevance test comes first: all copies of a text pass or fail together.
    """
    return dedup.dedup_exact(keywords.keyword_filter(df, col, keyword_table), col, id_col)


def extract_intents(df: DataFrame, lexicon: DataFrame, col: str, into: str = "intents") -> DataFrame:
    """Add the sorted intents whose ``lexicon`` (``term, intent``) terms the text holds."""
    return keywords.with_matched_labels(df, col, lexicon, "term", "intent", into)


def map_taxonomy(df: DataFrame, taxonomy: DataFrame, col: str, into: str = "codes") -> DataFrame:
    """Add the sorted codes whose ``taxonomy`` (``term, code``) terms the text holds."""
    return keywords.with_matched_labels(df, col, taxonomy, "term", "code", into)
