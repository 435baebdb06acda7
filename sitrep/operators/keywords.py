"""Keyword dictionaries: harvesting them and testing texts against them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.functions import html, matching, nested, text
from sitrep.operators import scale


def ludp_terms(records: DataFrame, targets: Sequence[str] = C.TARGET_LANGS) -> DataFrame:
    """``(lang, term, ord)`` of language-use records in the target languages.

    The term is ``term``, else the local name of the language; records without
    either are left out. ``ord`` is carried over.
    """
    term = text.first_non_empty("term", "language_name_local")
    return (
        records.where(F.col("language_code").isin(*targets))
        .select(F.col("language_code").alias("lang"), term.alias("term"), "ord")
        .where(F.col("term").isNotNull())
    )


def glossary_rows(pages: DataFrame, key: Sequence[str], col: str = "html") -> DataFrame:
    """Text of every ``tr``, ``div`` and ``li`` of each page: ``key``, ``row_no``, ``text``."""
    key = list(key)
    fields = [pages.schema[c] for c in key]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def rows(batches):
        import pyarrow as pa

        names = [*key, "row_no", "text"]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for *keys, page in zip(*(batch.column(c).to_pylist() for c in [*key, col])):
                for number, row in enumerate(html.element_texts(page or "")):
                    out.append((*keys, number, row))
                    size += len(row)
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
                        out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)

    # Pages without one of the tags never leave the JVM.
    return (
        pages.select(*key, col)
        .where(F.col(col).rlike(r"(?i)<(tr|div|li)"))
        .mapInArrow(rows, f"{schema}, row_no bigint, text string")
    )


def glossary_terms(
    rows: DataFrame, targets: Sequence[str] = C.TARGET_LANGS, token: bool = False, col: str = "text"
) -> DataFrame:
    """``lang`` and ``term`` for every row text that mentions a language code.

    The term is the first word of more than three characters. A code counts wherever
    its letters stand, so ``mar`` is also found in "market"; ``token`` asks for whole
    words. Other columns are kept.
    """
    lowered = F.col("__lowered")
    found = [
        F.when(
            lowered.rlike(rf"(?U)\b{code}\b") if token else F.contains(lowered, F.lit(code)),
            F.lit(code),
        )
        for code in targets
    ]
    return (
        nested.once(nested.once(rows, F.lower(col), "__lowered"), text.first_long_word("__lowered"), "term")
        .where(F.col("term").isNotNull())
        .withColumn("lang", F.explode(F.array_compact(F.array(*found))))
        .drop("__lowered")
    )


def terms_by_lang(*sources: DataFrame) -> DataFrame:
    """Distinct terms per language with the place they were first seen: ``lang, term, ord``.

    Each source has ``lang, term, ord``; ``ord`` must be comparable across sources.
    One row per term, so a language may have any number of terms.
    """
    from sitrep.sources.jsonl import union_sources

    parts = [s.select("lang", "term", "ord") for s in sources]
    return union_sources(*parts).groupBy("lang", "term").agg(F.min("ord").alias("ord"))


def with_fallback(
    terms: DataFrame, defaults: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Add the default terms of languages that have no term at all."""
    defaults = C.FALLBACK_TERMS if defaults is None else defaults
    rows = [(lang, t, i) for lang, ts in defaults.items() for i, t in enumerate(ts)]
    if not rows:
        return terms
    filler = terms.sparkSession.createDataFrame(rows, "lang string, term string, ord bigint")
    # At most one row per default language.
    present = terms.where(F.col("lang").isin(*defaults)).select("lang").distinct()
    missing = filler.join(F.broadcast(present), "lang", "left_anti")
    return terms.select("lang", "term", "ord").unionByName(missing)


def flatten_keywords(terms: DataFrame, col: str = "term") -> DataFrame:
    """Distinct lower-cased terms of all languages, as ``keyword``."""
    return terms.select(F.lower(col).alias("keyword")).distinct()


def keyword_filter(
    df: DataFrame, col: str, keywords: DataFrame, term: str = "keyword", lower: bool = True
) -> DataFrame:
    """Rows whose lower-cased text holds at least one keyword; no keywords, no rows.

    The keywords are lower case. Rows stay in their partitions.
    """
    value = F.lower(col) if lower else F.col(col)
    words = _terms(keywords.select(F.col(term).alias("term")))
    if not matching.in_catalyst(words):
        return df.where(matching.contains_any(value, words))
    lowered = nested.once(df, value, "__lowered")
    return lowered.where(matching.contains_any(F.col("__lowered"), words)).drop("__lowered")


def with_matched_labels(
    df: DataFrame, col: str, lexicon: DataFrame, term: str, label: str, into: str
) -> DataFrame:
    """Add the sorted distinct labels of all lexicon terms the lower-cased text holds.

    Texts without a match get an empty array. Rows stay in their partitions.
    """
    return with_all_matched_labels(df, col, {into: (lexicon, term, label)})


def with_all_matched_labels(
    df: DataFrame, col: str, lexicons: Mapping[str, tuple[DataFrame, str, str]]
) -> DataFrame:
    """:func:`with_matched_labels` for several ``{into: (lexicon, term, label)}`` in one pass."""
    names = list(lexicons)
    # Labels carry the number of their lexicon through the one pass over the text.
    pairs = reduce(
        DataFrame.unionByName,
        [
            lexicon.select(F.lower(term).alias("term"), F.concat(F.lit(f"{i}:"), F.col(label)).alias("label"))
            for i, (lexicon, term, label) in enumerate(lexicons.values())
        ],
    )
    words, value = _terms(pairs), F.lower(col)
    if not matching.in_catalyst(words):
        out = df.withColumn("__labels", matching.matched_labels(value, words))
    else:
        lowered = nested.once(df, value, "__lowered")
        out = lowered.withColumn("__labels", matching.matched_labels(F.col("__lowered"), words)).drop("__lowered")

    def own(i: int) -> Column:
        mine = F.filter("__labels", lambda l: l.startswith(f"{i}:"))
        return F.transform(mine, lambda l: F.substring(l, len(f"{i}:") + 1, 2**31 - 1))

    return out.withColumns({name: own(i) for i, name in enumerate(names)}).drop("__labels")


def keyword_hits(df: DataFrame, col: str, keywords: DataFrame, term: str = "keyword") -> DataFrame:
    """Number of texts that hold each keyword: ``keyword, n``; keywords without a text are absent."""
    found = with_matched_labels(df.select(col), col, keywords, term, term, "__found")
    return found.select(F.explode("__found").alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n"))


def _terms(terms: DataFrame) -> list[tuple] | matching.TermFiles:
    """Distinct rows without nulls: a list, or files if one process cannot hold them."""
    held, path, parts = scale.held_or_filed(terms.dropna(), matching.MAX_TERMS, matching.MAX_TERM_BYTES)
    return matching.TermFiles(path, parts) if held is None else [tuple(r) for r in held]
