"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation, components.

Documents with the same set of shingles are one node. Nodes that share a band of MinHash
values are candidates; the population count of the XOR of their odd sketches estimates how
similar they are, and what may reach the threshold is confirmed on the full sets.

No bucket of a band is expanded into its pairs. Its nodes are compared with one centre
first; that joins most groups of copies into one component, and the bucket is done. In
buckets that stay open, shingles no other open node has bound what a node can reach; nodes
that cannot reach the threshold with anything leave, a second centre joins most of the rest,
and what is still open is compared across components only, under the same bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import IN_WORD, map_batches, row_key, shingle_hashes, stored, texts, word_hashes

BANDS, ROWS = 32, 4
SKETCH_WORDS = 8
SHINGLE = 5
# A sketch says how far apart two MinHash samples of BANDS * ROWS values are; its estimate of
# a similarity of 0.75 is below this less than once in ten million times.
SKETCH_FLOOR = 0.5
# Nodes of one bucket that are compared with each other in one task.
BLOCK = 2000
SIGNATURE = "doc_id long, key long, n_shingles long, node binary, bands array<long>, sketch array<long>"


def shingles_of(text: bytes | None) -> np.ndarray:
    """The document's set: hashes of its distinct runs of five lower-case words, sorted."""
    return np.unique(shingle_hashes(word_hashes((text or b"").lower(), IN_WORD), SHINGLE))


def _constants(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, np.uint64)


def minhash(found: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Smallest value of the set under each hash function; long sets go in pieces."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096]
        values = part[None, :] * factors[:, None] + terms[:, None]
        values ^= values >> np.uint64(32)
        np.minimum(least, values.min(1), out=least)
    return least


def odd_sketch(sample: np.ndarray, words: int) -> np.ndarray:
    """Parity bitmap of a MinHash sample: every (place, value) flips one bit."""
    mixed = shingle_hashes(sample, 1) + np.arange(len(sample), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = shingle_hashes(mixed, 1)
    bits = np.bincount((mixed % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """Size of the set, node, band keys and odd sketch of every document; no node if it is empty."""
    factors, terms = _constants(BANDS * ROWS, seed)
    band = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, nodes, bands, sketches = [], [], [], []
        for value in texts(batch.column(2)):
            found = shingles_of(value)
            sizes.append(len(found))
            if not len(found):
                nodes.append(None), bands.append(None), sketches.append(None)
                continue
            other = shingle_hashes(found, 1)
            nodes.append(np.array([found.sum(dtype=np.uint64), other.sum(dtype=np.uint64)], ">u8").tobytes())
            sample = minhash(found, factors, terms)
            keys = band + np.uint64(1)
            for row in sample.reshape(BANDS, ROWS).T:
                keys = shingle_hashes(keys * np.uint64(0x9E3779B97F4A7C15) + row, 1)
            bands.append(keys.view(np.int64))
            sketches.append(odd_sketch(sample, SKETCH_WORDS))
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        arrays = [pa.array(v, k) for v, k in zip((sizes, nodes, bands, sketches), kinds)]
        names = ["doc_id", "key", "n_shingles", "node", "bands", "sketch"]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), row_key(docs[doc_id], docs[text]).alias("key"), docs[text].alias("text")
    )
    return map_batches(rows, run, SIGNATURE)


def sets_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Full sets of nodes: ``node, shingles``. ``wanted`` has one ``key`` for each node."""
    keyed = docs.select(row_key(docs[doc_id], docs[text]).alias("key"), docs[text].alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles_of(t).view(np.int64) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    rows = keyed.join(wanted.select("key", "node"), "key").select("node", "text")
    # Rows with the same id and text have the same key.
    return map_batches(rows, run, "node binary, shingles array<long>").dropDuplicates(["node"])


def sketched(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two nodes from their odd sketches."""
    bits, k = 64 * SKETCH_WORDS, BANDS * ROWS
    apart = " + ".join(f"bit_count({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(SKETCH_WORDS))
    differ = f"(-{bits / 2} * ln(greatest(1 - 2 * ({apart}) / {bits}.0D, 0.001D)))"
    return F.expr(f"1 - {differ} / {2.0 * k}")


def may_reach(a: str, b: str, percent: int) -> Column:
    """Whether the sizes and the sketches of two nodes leave the threshold within reach."""
    sizes = F.expr(f"100 * least({a}.n_shingles, {b}.n_shingles) >= {percent} * greatest({a}.n_shingles, {b}.n_shingles)")
    return sizes & (sketched(a, b) >= SKETCH_FLOOR)


def can_share(a: str, b: str, percent: int) -> Column:
    """Whether two nodes have enough shingles that other open nodes have too.

    Exact: they share at most the smaller ``common``, and their union is what is left.
    """
    shared = f"least({a}.common, {b}.common)"
    return F.expr(f"100 * {shared} >= {percent} * ({a}.n_shingles + {b}.n_shingles - {shared})")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` pairs of nodes whose full sets meet the threshold."""
    left, right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(
        F.col("node").alias("b"), F.col("shingles").alias("sb")
    )
    both = pairs.join(left, "a").join(right, "b")
    shared = both.withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    return shared.where(100 * F.col("shared") >= percent * (F.size("sa") + F.size("sb") - F.col("shared"))).select("a", "b")


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Smallest node reachable from each node that has a link: ``node, root``.

    Alternates two steps until the edges are stars: every node hands its larger neighbours
    its smallest one, then its smaller neighbours. Each is a minimum per node and a join on
    it, so a node with very many neighbours is never gathered in one task.
    """

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())

    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), label)
    seen = state(edges)
    while True:
        # Larger neighbours of a node take the smallest of its neighbourhood.
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), label)
        # A node and its smaller neighbours take the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), label)
        now = state(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members with the component they are in so far."""
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open(members: DataFrame) -> DataFrame:
    """Members of buckets that more than one component has a node in."""
    state = members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return members.join(state.select("bucket"), "bucket", "left_semi")


def _stars(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's centre and its other nodes that may reach the threshold.

    ``centres`` has a bucket's centre with its size, sketch and component.
    """
    pairs = (
        members.alias("m")
        .join(centres.alias("c"), "bucket")
        .where(F.expr("m.root <> c.root") & can_share("m", "c", percent) & may_reach("m", "c", percent))
    )
    return pairs.select(F.col("m.node").alias("a"), F.col("c.node").alias("b")).distinct()


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """Component of every document: one row per input row.

    ``n_shingles`` is the size of its set, ``component_id`` the smallest id of the documents
    it is linked with, directly or through others, itself included, and ``kept`` whether that
    is its own. A null or blank text is linked with nothing. A null id is never the smallest
    if there is another; alone it is its own component and kept. Rows that repeat an id and
    its text are in one component and all kept if one is; ``unique`` drops them. Shingles and
    sets are compared by 64-bit hashes, sets by 128 bits when they are equal.
    """
    signed = stored(signatures(docs, doc_id, text), "signatures")
    nodes = (
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("key", "n_shingles", "bands", "sketch")).alias("s"))
        .select("node", "least_id", "s.*")
    )
    nodes = stored(nodes, "nodes")
    roots = _linked(docs, nodes, doc_id, text, percent)
    rooted = nodes.select("node", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("node", "component_id")
    return (
        signed.select("doc_id", "key", "n_shingles", "node")
        .join(named, "node", "left")
        .withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def _linked(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """Components of nodes with links, ``node, root``."""
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1")
    members = banded.join(shared.select("bucket", "centre"), "bucket")
    members = stored(members, "members")
    facts = nodes.select("node", "key", "n_shingles", "sketch")

    pairs = members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = (
        pairs.join(facts.alias("x"), F.expr("a = x.node"))
        .join(facts.alias("y"), F.expr("b = y.node"))
        .where(may_reach("x", "y", percent))
        .select("a", "b")
    )
    pairs = stored(pairs, "pairs")
    shared_nodes = members.select("node").distinct()
    sets = stored(sets_of(docs, facts.join(shared_nodes, "node"), doc_id, text), "sets")
    links = stored(confirmed(pairs, sets, percent), "links")
    roots = components(links)

    # Buckets that are still open, with what their nodes can share at most.
    still = stored(_open(_rooted(members, roots)), "open")
    if still.isEmpty():
        return roots
    open_nodes = still.select("node").distinct()
    each = sets.join(open_nodes, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    bound = each.join(common, "shingle").groupBy("node").agg(F.count("*").alias("common"))
    # |A and B| <= common(A) and |A or B| >= |A|, so the others cannot meet the threshold.
    able = (
        facts.join(bound, "node")
        .where(100 * F.col("common") >= percent * F.col("n_shingles"))
        .select("node", "n_shingles", "sketch", "common", (F.col("common") / F.col("n_shingles")).alias("share"))
    )
    able = stored(able, "able")
    still = stored(_open(still.join(able, "node")), "open")

    # Second centres: the nodes with the fewest shingles of their own.
    best = still.groupBy("bucket").agg(F.max(F.struct("share", "node", "n_shingles", "sketch", "common", "root")).alias("c"))
    found = confirmed(stored(_stars(still, best.select("bucket", "c.*"), percent), "pairs"), sets, percent)
    links = stored(links.unionAll(found), "links")
    roots = components(links)
    still = still.drop("root")

    # What is left: nodes of one bucket in different components.
    still = stored(_open(_rooted(still, roots)), "open")
    if still.isEmpty():
        return roots
    links = stored(links.unionAll(_across(still, sets, percent)), "links")
    return components(links)


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of one bucket in different components, confirmed in the join itself.

    One of such a pair is outside the bucket's largest component, so only those nodes look for
    partners. Bounds and sketches come first, the full sets last, and no pair that is not a
    link leaves the join. Large buckets are cut into blocks, each pair of blocks a task's key.
    """
    sizes = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("total"))
    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    state = sizes.select("bucket", F.col("most.root").alias("large"), blocks.alias("blocks"))
    whole = members.join(state, "bucket").join(sets, "node")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    left = whole.where("root <> large").withColumn("bx", own).withColumn("by", F.explode(others))
    right = whole.withColumn("by", own).withColumn("bx", F.explode(others))
    shared = "size(array_intersect(x.shingles, y.shingles))"
    return (
        left.alias("x")
        .join(
            right.alias("y"),
            F.expr(
                "x.bucket = y.bucket AND x.bx = y.bx AND x.by = y.by "
                "AND x.root <> y.root AND (y.root = y.large OR x.node < y.node)"
            )
            & can_share("x", "y", percent)
            & may_reach("x", "y", percent)
            & F.expr(f"100 * {shared} >= {percent} * (x.n_shingles + y.n_shingles - {shared})"),
        )
        .select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    )


def unique(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, all columns as they were.

    The row with the smallest id stays; of rows that repeat that id and text, one. A blank
    text has no duplicates.
    """
    found = groups(docs, doc_id, text, percent)
    found = stored(found.select("key", "component_id", "n_shingles", "kept"), "groups")
    kept = found.where("kept AND n_shingles > 0")
    # Of different texts with one id in one component, the first key stays.
    first = kept.groupBy("component_id").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last")
    extra = kept.alias("k").join(first.alias("f"), F.expr("k.component_id <=> f.component_id AND k.key <> f.first"))
    gone = found.where("NOT kept").select("key").unionAll(extra.select("k.key")).select(F.col("key").alias("__key"))
    keyed = docs.withColumn("__key", row_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")))
    rest = keyed.join(gone.distinct(), "__key", "left_anti")
    repeated = kept.groupBy(F.col("key").alias("__key")).count().where("count > 1").select("__key")
    if not repeated.isEmpty():
        once = rest.join(repeated, "__key", "left_semi").dropDuplicates(["__key"])
        rest = rest.join(repeated, "__key", "left_anti").unionByName(once)
    return rest.select(*[F.col(f"`{c}`") for c in docs.columns])
