"""JSON Lines, keyword dictionaries and gated publishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitrep import constants as C
from sitrep.operators import audit, scale
from sitrep.sinks import commits
from sitrep.sources.jsonl import read_jsonl


# Type of a term's place; wide enough for places made of several numbers.
PLACE = "decimal(38,0)"
# Terms of a dictionary that one row holds.
TERMS_PER_ROW = 1000


def write_jsonl(
    df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False
) -> int:
    """Write JSON Lines with non-ASCII text kept and nulls written; returns the row count.

    A lone VARIANT column ``record`` is written as the record itself. The count is
    taken while writing. ``single_file`` is for small results only.
    """
    counted, observation = audit.observed(df, "exported")
    if single_file:
        counted = counted.coalesce(1)
    if df.columns == ["record"] and df.schema["record"].dataType.typeName() == "variant":
        counted.select(F.to_json("record")).write.mode(mode).text(path)
    else:
        counted.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return observation.get["n"]


def append_jsonl(df: DataFrame, path: str) -> int:
    """Add rows to a raw log. For jobs that may be repeated there is ``commits.append_once``."""
    return write_jsonl(df, path, "append")


def dictionary_rows(
    terms: DataFrame, targets: Sequence[str] = C.TARGET_LANGS, per_row: int = TERMS_PER_ROW
) -> DataFrame:
    """The dictionary as a table ``lang, part, keywords``, terms in the order of ``ord, term``.

    A row holds at most ``per_row`` terms; parts of a language are numbered from 0 and make
    up its list. Terms are numbered in ranges of their order, so that no task sees more of
    a language than its range. Languages without terms have one part, an empty array.
    """
    wanted = terms.sparkSession.createDataFrame([(t,) for t in targets], "lang string")
    order = ["lang", "ord", "term"]
    numbered = scale.global_row_number(terms.where(F.col("lang").isin(*targets)).select(*order), order, "__n")
    # One row per target language.
    first = numbered.groupBy("lang").agg(F.min("__n").alias("__first"))
    part = F.floor((F.col("__n") - F.col("__first")) / per_row).cast("int").alias("part")
    placed = numbered.join(F.broadcast(first), "lang").select("lang", part, "__n", "term")
    lists = placed.groupBy("lang", "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__n", "term"))), lambda x: x["term"]).alias("keywords")
    )
    empty = F.array().cast("array<string>")
    return wanted.join(lists, "lang", "left").select(
        "lang", F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("keywords", empty).alias("keywords")
    )


def dictionary_lines(terms: DataFrame, targets: Sequence[str] = C.TARGET_LANGS) -> DataFrame:
    """Lines that together are one JSON object ``{"metadata": …, "keywords": {lang: […]}}``.

    Sorted by ``section, ord``. No row holds more than one term, so a language may
    have any number of them.
    """
    spark = terms.sparkSession
    metadata = F.to_json(
        F.struct(
            F.lit(C.DICTIONARY_SOURCE).alias("source"),
            F.array(*[F.lit(t) for t in targets]).alias("target_languages"),
        )
    )
    frame = [(-1, -1, 'HEAD')]
    for i, lang in enumerate(targets):
        frame.append((i, -1, ("," if i else "") + f'"{lang}":['))
        frame.append((i, None, "]"))
    frame.append((len(targets), -1, "}}"))
    last = F.lit("9" * 38).cast(PLACE)
    fixed = spark.createDataFrame(frame, "section int, ord bigint, line string").select(
        "section",
        F.coalesce(F.col("ord").cast(PLACE), last).alias("ord"),
        F.lit("").alias("tie"),
        F.when(F.col("line") == "HEAD", F.concat(F.lit('{"metadata":'), metadata, F.lit(',"keywords":{')))
        .otherwise(F.col("line"))
        .alias("line"),
    )
    section = F.create_map(*[F.lit(x) for i, lang in enumerate(targets) for x in (lang, i)])
    rows = terms.where(F.col("lang").isin(*targets)).withColumn("ord", F.col("ord").cast(PLACE))
    # One row per target language.
    first = rows.groupBy("lang").agg(F.min(F.struct("ord", "term")).alias("__first"))
    quoted = F.expr("substring(to_json(array(term)), 2, length(to_json(array(term))) - 2)")
    entries = rows.join(F.broadcast(first), "lang").select(
        F.try_element_at(section, F.col("lang")).alias("section"),
        "ord",
        F.col("term").alias("tie"),
        F.concat(F.when(F.struct("ord", "term") == F.col("__first"), "").otherwise(","), quoted).alias("line"),
    )
    return fixed.unionByName(entries)


def write_dictionary(terms: DataFrame, path: str, targets: Sequence[str] = C.TARGET_LANGS) -> None:
    """Write the dictionary as JSON in sorted parts, one line per term.

    The parts, put together in name order, are the JSON object.
    """
    terms = scale.materialize(terms, "terms")
    lines = dictionary_lines(terms, targets).orderBy("section", "ord", "tie")
    lines.select("line").write.mode("overwrite").text(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``lang, term, ord`` of a dictionary: what :func:`write_dictionary` wrote, of any size,
    or any one file with an object of arrays under ``keywords``.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    begins = F.col("value").startswith('{"metadata":') & F.col("value").endswith('"keywords":{')
    if not lines.where(begins).isEmpty():
        return _terms_of_lines(lines.where(~begins))
    body = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("body"))
    keywords = F.try_variant_get("body", "$.keywords", "map<string,array<string>>")
    return (
        body.select(F.explode(keywords).alias("lang", "terms"))
        .select("lang", F.posexplode("terms").alias("ord", "term"))
        .select("lang", "term", F.col("ord").cast("bigint").alias("ord"))
    )


def _terms_of_lines(lines: DataFrame) -> DataFrame:
    """Terms of the lines of a dictionary's parts.

    A language's line stands before its terms, maybe in an earlier part: what is open at the
    end of each block of a file, one row per block, is handed on to the next.
    """
    opened = F.nullif(F.regexp_extract("value", '^,?"(.*)":\\[$', 1), F.lit(""))
    placed = lines.select("value", F.struct("file_path", "file_block_start").alias("part"), F.monotonically_increasing_id().alias("line"))
    marked = placed.withColumn("opened", opened)
    upto = Window.partitionBy("part").orderBy("line")
    marked = marked.withColumn("here", F.last("opened", ignorenulls=True).over(upto))
    ends = marked.groupBy("part").agg(F.max_by("opened", F.when(F.col("opened").isNotNull(), F.col("line"))).alias("at_end"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", F.last("at_end", ignorenulls=True).over(before).alias("carried"))
    term = F.from_json(F.concat(F.lit("["), F.ltrim("value", F.lit(",")), F.lit("]")), "array<string>")[0]
    rows = (
        marked.where(F.col("opened").isNull() & F.col("value").rlike('^,?"'))
        .join(F.broadcast(carried), "part")
        .select(F.coalesce("here", "carried").alias("lang"), term.alias("term"), "part", "line")
    )
    counts = rows.groupBy("lang", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("lang", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("lang", "part").orderBy("line")
    return (
        rows.withColumn("nth", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["lang", "part"])
        .select("lang", "term", (F.col("offset") + F.col("nth")).alias("ord"))
    )


def publish_if_compliant(
    spark: SparkSession,
    artifact: str,
    target: str,
    lang_col: str = "language_inferred",
    targets: Sequence[str] = C.TARGET_LANGS,
    threshold: float = C.MIN_SHARE,
) -> bool:
    """Publish a JSON Lines artifact if its language audit passes; a missing artifact is an error.

    The lines are copied as they are, as a new version of ``target`` that replaces the last
    one when it is whole: ``commits.published`` says where it is.
    """
    try:
        lines = spark.read.text(artifact)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(artifact) from error
        raise
    dataset = read_jsonl(spark, artifact, f"`{lang_col}` string")
    if not audit.audit_gate(dataset, lang_col, targets, threshold).first()["compliant"]:
        return False
    commits.publish(lines, target)
    return True
