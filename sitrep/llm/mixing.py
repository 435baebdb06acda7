"""Mix sources to target weights by capped water-filling and seeded repetitions.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitrep.llm.common import prefix_sums, stored
from sitrep.operators import scale

WORD = "[^\\x20\\x09-\\x0D]+"
# Buckets of the seeded order in which a source's documents get their fractional repetition.
BUCKET_DIGITS = 4


def size_of(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Seeded place of a document; only rows with the same id and text share it."""
    blank = F.lit("")
    return F.md5(
        F.concat(
            F.lit(f"{seed}:"),
            F.coalesce(doc_id.cast("string"), blank),
            F.lit(":"),
            F.md5(F.coalesce(text, blank).cast("binary")),
        ).cast("binary")
    )


def water_fill(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Target of every source: ``source_key, source_size, weight`` with ``target``.

    Sources above ``max_epochs`` times their size are clamped there, and what is left is
    shared by weight among the others until none is above. Each round is one sum over
    the sources, one row of which comes to the driver; a round that clamps nobody ends it.
    Nothing to share, or nobody to share it, gives targets of zero.
    """
    size, weight = F.col("source_size"), F.col("weight")
    cap = F.lit(max_epochs) * size
    level, clamped = None, -1
    while True:
        free = F.lit(True) if level is None else weight * F.lit(level) <= cap
        found = sources.agg(
            F.coalesce(F.sum(size), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(~free, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(free, weight)), F.lit(0)).alias("weights"),
            F.count(F.when(~free, 1)).alias("clamped"),
        ).first()
        if found["clamped"] == clamped or not found["weights"]:
            break
        clamped = found["clamped"]
        level = (found["total"] - found["held"]) / found["weights"]
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    share = weight * F.lit(float(level))
    return sources.withColumn("target", F.when(share > cap, cap.cast("double")).otherwise(share))


def plan(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Sources of ``source_key, size`` rows with their weight, size and target.

    Sources take the weights in turn in the order of their names, null last.
    """
    sources = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    # A flag before the name, so that sorting puts the null source last.
    sources = sources.select(
        F.col("source_key").isNull().alias("no_name"), "source_key", "source_size", F.lit(1).alias("one")
    )
    placed = prefix_sums(sources, ["no_name", "source_key"], "one", "place", "mix-sources")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = placed.select("source_key", "source_size", turn.cast("long").alias("weight"))
    return water_fill(stored(weighed, "mix-weights"), max_epochs)


def repetitions(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repetitions, and the last key that is taken once more.

    Documents of a source stand in seeded order; the first of them, as many as fit into the
    words still missing, are taken once more, and one further on that fits best into what
    is left. Sums per bucket of the order find the bucket in which the first ones end, and
    only that bucket's documents are sorted.
    """
    whole = F.floor(F.try_divide("target", "source_size"))
    need = targets.select(
        "source_key",
        "source_size",
        "target",
        F.coalesce(whole, F.lit(0)).cast("long").alias("whole"),
    ).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    sums = sized.groupBy("source_key", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source_key").orderBy("bucket")
    sums = sums.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    last = (
        sums.alias("b")
        .join(need.alias("n"), F.expr("b.source_key <=> n.source_key"))
        .where("missing > 0 AND before <= missing AND missing < before + words")
        .select("b.source_key", "bucket", "before", "missing")
    )
    inside = (
        sized.alias("d")
        .join(
            last.alias("l"),
            F.expr("d.source_key <=> l.source_key") & (F.substring("d.key", 1, BUCKET_DIGITS) == F.col("l.bucket")),
        )
        .groupBy("l.source_key", "l.bucket", "l.before", "l.missing", "d.key")
        .agg(F.sum("d.size").alias("words"))
    )
    upto = Window.partitionBy("source_key").orderBy("key")
    inside = inside.withColumn("upto", F.col("before") + F.sum("words").over(upto))
    taken = inside.where("upto <= missing").groupBy("source_key").agg(
        F.max("key").alias("upto_key"), F.max("upto").alias("upto")
    )
    edge = last.alias("e").join(taken.alias("t"), F.expr("e.source_key <=> t.source_key"), "left")
    # Without a document of the last bucket, all buckets before it: no key is below its name alone.
    edge = edge.select(
        "e.source_key",
        F.coalesce("t.upto_key", "e.bucket").alias("upto_key"),
        (F.col("e.missing") - F.coalesce("t.upto", "e.before")).alias("rest"),
    )
    # One row per source: broadcast after its size is taken, so that a large source is not one task.
    edge, rows, size = scale.measured(edge, "mix-edges")
    near = F.broadcast(edge) if scale.is_small(rows, size) else edge
    # The document that would end it is too long: of those not taken, the one nearest to the rest.
    off = F.abs(F.col("d.size") - F.col("g.rest"))
    fill = (
        sized.alias("d")
        .join(near.alias("g"), F.expr("d.source_key <=> g.source_key AND d.key > g.upto_key"))
        .where(off < F.col("g.rest"))
        .groupBy(F.col("d.source_key").alias("source_key"))
        .agg(F.min(F.struct(off.alias("off"), F.col("d.key").alias("key"))).alias("best"))
    )
    return (
        need.alias("n")
        .join(edge.alias("g"), F.expr("n.source_key <=> g.source_key"), "left")
        .join(fill.alias("f"), F.expr("n.source_key <=> f.source_key"), "left")
        .select("n.source_key", "n.source_size", "n.target", "n.whole", "g.upto_key", F.col("f.best.key").alias("fill_key"))
    )


def times(key: Column, source: str) -> Column:
    """Repetitions of a document, from its place and its source's plan."""
    again = (key <= F.col(f"{source}.upto_key")) | (key == F.col(f"{source}.fill_key"))
    return F.col(f"{source}.whole") + F.when(again, 1).otherwise(0)


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        docs[source].alias("source_key"),
        size_of(docs[text]).alias("size"),
        order_key(docs[doc_id], docs[text], seed).alias("key"),
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 17,
) -> DataFrame:
    """How often the mix takes every document: one row per input row.

    ``size`` and ``source_size`` are words, ``target`` the words the source should give,
    ``times`` the repetitions and ``taken`` the words they make. Rows with the same id and
    text share a place in the seeded order and are taken equally often. A null text or an
    empty one has no words; a null source is a source of its own, named last. A source's
    words come within half a document of its target, and reruns give the same rows.
    """
    sized = stored(_sized(docs, doc_id, text, source, seed), "mix-sizes")
    per_source = stored(repetitions(sized, plan(sized, weights, max_epochs)), "mix-plan")
    return (
        sized.alias("d")
        .join(per_source.alias("s"), F.expr("d.source_key <=> s.source_key"))
        .select(
            "d.doc_id",
            "d.size",
            "s.source_size",
            "s.target",
            times(F.col("d.key"), "s").alias("times"),
        )
        .withColumn("taken", F.col("times") * F.col("size"))
    )


def take(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    seed: int = 17,
) -> DataFrame:
    """The mixed corpus: rows of ``docs``, repeated or left out; same columns."""
    sized = stored(_sized(docs, doc_id, text, source, seed), "mix-sizes")
    per_source = stored(repetitions(sized, plan(sized, weights, max_epochs)), "mix-plan")
    key = order_key(F.col(f"d.{doc_id}"), F.col(f"d.{text}"), seed)
    count = times(key, "s")
    names = [F.col(f"d.`{c}`").alias(c) for c in docs.columns]
    return (
        docs.alias("d")
        .join(per_source.alias("s"), F.col(f"d.`{source}`").eqNullSafe(F.col("s.source_key")))
        .where(count > 0)
        .select(*names, F.explode(F.array_repeat(F.lit(0), count.cast("int"))).alias("__copy"))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
