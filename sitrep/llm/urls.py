"""URL filters: fixed host and path rules, then rules mined from labelled URLs by FP-growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import stored

# verdict, host, start of the path
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKED = "verdict=block"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://``, in lower case; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _first_fitting(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return F.lit(None).cast("string") if out is None else out


def tokens_of(url: Column) -> Column:
    """What a URL is made of: scheme, host and its endings, path parts, endings, query names.

    Digits in path parts become ``0``, so that page numbers are one token.
    """
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    ends = F.when(
        F.size(labels) > 1,
        F.transform(
            F.sequence(F.lit(2), F.size(labels)),
            lambda n: F.concat(F.lit("host:"), F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")),
        ),
    ).otherwise(F.array(F.concat(F.lit("host:"), host)))
    top = F.array(F.concat(F.lit("top:"), F.element_at(labels, -1)))
    first = F.array(F.concat(F.lit("label:"), F.element_at(labels, 1)))
    scheme = F.array(F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)))
    parts = F.transform(
        F.filter(F.split(path, "/"), lambda x: x != ""),
        lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0")),
    )
    query = F.transform(
        F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != ""),
        lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)),
    )
    mark = F.when(F.contains(url, F.lit("#")), F.array(F.lit("mark"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.coalesce(F.concat(scheme, top, first, ends, parts, query, mark), F.array().cast("array<string>")))


def ruled_labels(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """``url, bad`` of the URLs that a fixed rule decides: bad ones are blocked."""
    urls = pages.select(pages[url].alias("url")).where("url IS NOT NULL")
    verdict = _first_fitting(rules, host_of(F.col("url")), path_of(F.col("url")), lambda r: r[0])
    return urls.select("url", (verdict == "block").alias("bad")).where("bad IS NOT NULL")


def page_labels(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``url, bad`` of labelled pages (``doc_id, quality, toxic`` by page id): bad if of no quality, or toxic.

    A page with conflicting labels is bad; one whose labels say nothing has none.
    """
    said = labels.select(F.col("doc_id").alias("label_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    said = said.where("bad IS NOT NULL").groupBy("label_id").agg(F.bool_or("bad").alias("bad"))
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url")).where("url IS NOT NULL")
    return rows.join(said, F.col("page_id") == F.col("label_id")).select("url", "bad")


def mined_rules(
    labelled: DataFrame,
    min_support: float = 0.005,
    min_pages: int = 5,
    min_confidence: float = 0.8,
    min_lift: float = 1.5,
) -> DataFrame:
    """Combinations of URL tokens that mark bad pages: ``antecedent, confidence, support``.

    ``labelled`` has a row ``url, bad`` for every labelled page, repeated URLs included.
    FP-growth finds frequent sets of tokens and the verdict; rules that lead to the verdict
    stay if they are confident and say more than the share of bad pages, and if no shorter
    rule inside them is as confident. A rule rests on ``min_support`` of the labelled pages
    and on ``min_pages`` of them at least, so that a few labels make none; nor do labels
    that are all of one kind.
    """
    verdict = F.when(F.col("bad"), F.array(F.lit(BLOCKED))).otherwise(F.array().cast("array<string>"))
    baskets = stored(labelled.select(F.concat(tokens_of(F.col("url")), verdict).alias("items")), "baskets")
    empty = labelled.sparkSession.createDataFrame([], "antecedent array<string>, confidence double, support double")
    n = baskets.count()
    if n < min_pages:
        return empty
    least = max(min_support, min_pages / n)
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(baskets)
    rules = (
        model.associationRules.where(F.col("consequent") == F.array(F.lit(BLOCKED)))
        .where(F.col("lift") >= min_lift)
        .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
    )
    rules = stored(rules, "rules")
    # A rule is redundant if leaving one token out gives a rule at least as confident.
    shorter = rules.select(
        "antecedent", "confidence", F.explode(F.transform("antecedent", lambda x: F.array_remove("antecedent", x))).alias("less")
    )
    known = rules.select(F.col("antecedent").alias("less"), F.col("confidence").alias("less_confidence"))
    redundant = shorter.join(known, "less").where("less_confidence >= confidence").select("antecedent")
    return stored(rules.join(redundant, "antecedent", "left_anti"), "rules")


def matched(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Distinct URLs that have all tokens of some rule, through an inverted index.

    A rule is filed under the token the fewest rules have; URLs meet the rules of their
    tokens, and the other tokens are then looked for.
    """
    tokens = rules.select(F.explode("antecedent").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    filed = (
        rules.select("antecedent", F.explode("antecedent").alias("token"))
        .join(tokens, "token")
        .groupBy("antecedent")
        .agg(F.min(F.struct("n", "token")).alias("best"))
        .select("antecedent", F.col("best.token").alias("token"))
    )
    urls = pages.select(pages[url].alias("url")).where("url IS NOT NULL").distinct()
    each = urls.select("url", tokens_of(F.col("url")).alias("tokens"))
    each = each.select("url", "tokens", F.explode("tokens").alias("token"))
    hits = each.join(filed, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return hits.select("url").distinct()


def judged(
    pages: DataFrame,
    labels: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    **mining,
) -> DataFrame:
    """Verdict on every page: the longest fixed rule that fits, else the mined rules.

    Rules are mined from the pages that a fixed rule decides, and from ``labels`` of other
    pages if there are any (:func:`page_labels`). One row per input row. A null url, or one
    without ``://``, has an empty host and path, fits no rule and is allowed. ``verdict`` is
    block for URLs that a mined rule matches.
    """
    own = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"))
    labelled = ruled_labels(own, rules)
    if labels is not None:
        decided = labelled.select("url").distinct()
        labelled = labelled.unionByName(page_labels(own, labels).join(decided, "url", "left_anti"))
    found = matched(own, mined_rules(labelled, **mining))
    marked = own.alias("p").join(found.withColumn("mined", F.lit(True)).alias("m"), F.expr("p.url = m.url"), "left")
    parts = marked.select("p.page_id", host_of(F.col("p.url")).alias("host"), path_of(F.col("p.url")).alias("path"), "mined")
    host, path = F.col("host"), F.col("path")
    return parts.select(
        "page_id",
        "host",
        "path",
        _first_fitting(rules, host, path, lambda r: r[1] + r[2]).alias("rule"),
        F.coalesce(
            _first_fitting(rules, host, path, lambda r: r[0]),
            F.when(F.col("mined"), "block").otherwise("allow"),
        ).alias("verdict"),
    )
