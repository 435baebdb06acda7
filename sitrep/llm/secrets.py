"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitrep.llm.common import row_key, stored

# Fixed patterns, in the order in which their kinds are listed.
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
MIN_VALUE = 6
# Strings that may be keys: long runs of letters, digits and the marks of base 64.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Inferred encodings, the narrowest first: what it looks like and its alphabet.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("base64", "^", UPPER + LOWER + DIGITS + "+/"),
)
# Lower ends of the length classes in which false discoveries are controlled.
LENGTHS = (20, 24, 32, 40, 64, 128)
# Levels a string's combined p-value may be held to, the mildest first.
LEVELS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.3)
# Matches whose places are summed together.
PART = 128
SPAN = "array<struct<start:int,end:int,text:string>>"


def spans(df: DataFrame, text: str, pattern: str, into: str) -> DataFrame:
    """Leftmost matches that do not overlap, with their places in code points.

    The matches and the pieces between them follow each other through the text, so running
    sums of their lengths are the places. Sums run inside parts of ``PART`` matches and over
    the parts, as appending to one list would copy it for every match.
    """
    some = F.col(text).rlike(pattern)
    df = df.withColumn("__m", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn("__p", F.when(some, F.split(F.col(text), pattern, -1)))

    def bound(value: str, name: str, body: str) -> str:
        """``body`` with ``value`` computed once, as ``name``."""
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    part = f"""aggregate(slice(z, k * {PART} + 1, {PART}), named_struct('at', 0, 'out', cast(array() AS {SPAN})),
        (a, x) -> named_struct(
            'at', a.at + x.gap + coalesce(length(x.found), 0),
            'out', IF(x.found IS NULL, a.out, concat(a.out, array(named_struct(
                'start', a.at + x.gap, 'end', a.at + x.gap + length(x.found), 'text', x.found))))))"""
    before = """aggregate(parts, named_struct('at', 0, 'out', cast(array() AS array<int>)),
        (a, x) -> named_struct('at', a.at + x.at, 'out', concat(a.out, array(a.at))), a -> a.out)"""
    moved = f"""flatten(zip_with(parts, {before}, (x, o) -> transform(x.out,
        y -> named_struct('start', y.start + o, 'end', y.end + o, 'text', y.text))))"""
    parts = bound(f"transform(sequence(0, cast((size(z) - 1) div {PART} AS int)), k -> {part})", "parts", moved)
    places = bound("zip_with(__p, __m, (p, m) -> named_struct('gap', length(p), 'found', m))", "z", parts)
    none = F.array().cast(SPAN)
    return df.withColumn(into, F.when(F.col("__m").isNull(), none).otherwise(F.expr(places))).drop("__m", "__p")


def ordinary(text: Column, drop: str, place: Column, length: Column) -> Column:
    """A string of a text's own letters, from a seeded place: what no key looks like."""
    squeezed = F.regexp_replace(text, drop, "")
    room = F.greatest(F.length(squeezed) - length, F.lit(0)) + 1
    return F.substr(squeezed, (F.pmod(place, room) + 1).cast("int"), length)


def normal_cdf(z: str) -> str:
    """Logistic form of the normal distribution, right to three digits."""
    x = f"greatest(-8D, least(8D, {z}))"
    return f"(1 / (1 + exp(-1.5976D * {x} - 0.070565D * {x} * {x} * {x})))"


def two_sided(z: str) -> str:
    return f"(2 * (1 - {normal_cdf(f'abs({z})')}))"


def battery(strings: str) -> Column:
    """Combined p-value of every string: how likely a random one looks no more random.

    For the alphabet of the narrowest encoding that fits: chi-squared of the counts of its
    letters, number of runs above and below its middle, and correlation of neighbours. The
    smallest of the three, times three, is the result. Steps are kept as fields, so that
    nothing is computed twice.
    """
    kind = "CASE " + " ".join(f"WHEN t.body RLIKE '{p}' THEN '{n}'" for n, p, _ in ENCODINGS) + " END"
    letters = "CASE t.encoding " + " ".join(f"WHEN '{n}' THEN '{a}'" for n, _, a in ENCODINGS) + " END"
    halves = (
        "CASE t.encoding "
        + " ".join(
            f"WHEN '{n}' THEN translate(t.body, '{a}', '{'L' * (len(a) // 2) + 'H' * (len(a) - len(a) // 2)}')"
            for n, _, a in ENCODINGS
        )
        + " END"
    )
    a, b = "2D * t.above * (t.n - t.above)", "t.n"
    steps = [
        "named_struct('role', t.role, 'start', t.start, 'end', t.end, 'body', translate(rtrim('=', t.text), '-_', '+/'))",
        f"named_struct('role', t.role, 'start', t.start, 'end', t.end, 'body', t.body, 'n', length(t.body), 'encoding', {kind})",
        f"""named_struct('role', t.role, 'start', t.start, 'end', t.end, 'n', t.n, 'encoding', t.encoding,
            'letters', length({letters}), 'chars', split(t.body, ''), 'body', t.body, 'halves', {halves},
            'codes', transform(split(t.body, ''), c -> cast(locate(c, {letters}) AS double)))""",
        """named_struct('role', t.role, 'start', t.start, 'end', t.end, 'n', t.n, 'encoding', t.encoding,
            'letters', t.letters, 'codes', t.codes,
            'squares', aggregate(array_distinct(t.chars), 0D,
                (s, c) -> s + power(t.n - length(replace(t.body, c, '')), 2)),
            'above', t.n - length(replace(t.halves, 'H', '')),
            'turns', (t.n - length(replace(t.halves, 'LH', ''))) / 2 + (t.n - length(replace(t.halves, 'HL', ''))) / 2,
            'mean', aggregate(t.codes, 0D, (s, c) -> s + c) / t.n)""",
        """named_struct('role', t.role, 'start', t.start, 'end', t.end, 'n', t.n, 'encoding', t.encoding,
            'chi', greatest(t.letters * t.squares / t.n - t.n, 0D) / (t.letters - 1), 'free', t.letters - 1D,
            'above', t.above, 'runs', t.turns + 1,
            'spread', aggregate(t.codes, 0D, (s, c) -> s + (c - t.mean) * (c - t.mean)),
            'lagged', aggregate(zip_with(slice(t.codes, 1, t.n - 1), slice(t.codes, 2, t.n - 1),
                (x, y) -> (x - t.mean) * (y - t.mean)), 0D, (s, c) -> s + c))""",
        f"""named_struct('role', t.role, 'start', t.start, 'end', t.end, 'n', t.n, 'encoding', t.encoding,
            'z_chi', (power(t.chi, 1 / 3D) - (1 - 2 / (9 * t.free))) / sqrt(2 / (9 * t.free)),
            'z_runs', IF(t.above = 0 OR t.above = t.n, 8D,
                (t.runs - 1 - {a} / {b}) / sqrt({a} * ({a} - {b}) / ({b} * {b} * ({b} - 1D)))),
            'z_lag', IF(t.spread = 0, 8D, (t.lagged / t.spread + 1 / (t.n - 1D)) * sqrt(t.n - 1D)))""",
        f"""named_struct('role', t.role, 'start', t.start, 'end', t.end, 'encoding', t.encoding,
            'length_class', aggregate(array({', '.join(map(str, LENGTHS))}), 0, (s, x) -> IF(t.n >= x, x, s)),
            'p', least(1D, 3 * least({two_sided('t.z_chi')}, {two_sided('t.z_runs')}, {two_sided('t.z_lag')})))""",
    ]
    found = strings
    for step in steps:
        found = f"transform({found}, t -> {step})"
    return F.expr(found)


def family(encoding: Column) -> Column:
    """Encodings whose ordinary strings are cut in the same way."""
    return F.when(F.lower(encoding) == "hex", "hex").otherwise("other")


def _outside(found: Column, base: Column) -> Column:
    """Strings of ``found`` that touch none of the fixed patterns' matches.

    Matches of one kind stand in order and apart, so that a binary search finds the last one
    that starts before the end of a string; no other can touch it if that one does not.
    """
    jumps = F.array(*[F.lit(1 << i) for i in reversed(range(28))])

    def touched(own: Column, x: Column) -> Column:
        last = F.aggregate(
            jumps,
            F.lit(0),
            lambda at, jump: F.when(
                (at + jump <= F.size(own)) & (F.get(own, at + jump - 1)["start"] < x["end"]), at + jump
            ).otherwise(at),
        )
        return F.coalesce(F.get(own, last - 1)["end"], F.lit(0)) > x["start"]

    def apart(t: Column, x: Column) -> Column:
        return ~(touched(t["assign"], x) | touched(t["access"], x) | touched(t["hex"], x))

    # One struct, so that each kind's matches are picked out once and not for every string.
    kinds = [F.filter(base, lambda b: b["kind"] == kind).alias(kind) for kind in PATTERNS]
    held = F.array(F.struct(found.alias("found"), *kinds))
    return F.element_at(F.transform(held, lambda t: F.filter(t["found"], lambda x: apart(t, x))), 1)


def thresholds(tested: DataFrame, rate: float) -> list:
    """Level for each family of encodings and length class that keeps false discoveries below ``rate``.

    Ordinary strings of the same class, cut from all texts, say how often a string that is no
    key passes a level; times the candidates of the class, that is the number of false ones to
    expect. Short classes, in which the tests tell little, get stricter levels or none. One
    row per class comes back, of a fixed number of classes.
    """
    each = tested.select(F.explode("tested").alias("t")).select("t.*").where("length_class > 0")
    real, plain = F.col("role") == "candidate", F.col("role") == "ordinary"
    counts = [F.count(F.when(real, 1)).alias("n"), F.count(F.when(plain, 1)).alias("plain")]
    for i, level in enumerate(LEVELS):
        counts += [
            F.count(F.when(real & (F.col("p") >= level), 1)).alias(f"real{i}"),
            F.count(F.when(plain & (F.col("p") >= level), 1)).alias(f"plain{i}"),
        ]
    chosen = []
    for row in each.groupBy(family(F.col("encoding")).alias("family"), "length_class").agg(*counts).collect():
        for i, level in enumerate(LEVELS):
            false = row["n"] * (row[f"plain{i}"] + 1) / (row["plain"] + 1)
            if row[f"real{i}"] and false <= rate * row[f"real{i}"]:
                chosen.append((row["family"], row["length_class"], level))
                break
    return chosen


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", false_rate: float = 0.1, seed: int = 11) -> DataFrame:
    """Secrets of every document: one row per input row.

    ``n_*`` and ``base_sha256`` are of the fixed patterns, ``spans`` has those and, as kind
    ``random``, strings outside them that pass the battery at the level of their encoding and
    length. A null text is empty; rows are judged alike wherever they stand, the levels come
    from all of them. Other columns are ignored.
    """
    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
        row_key(docs[doc_id], docs[text]).alias("key"),
    )
    for kind, pattern in PATTERNS.items():
        rows = spans(rows, "text", pattern, kind)
    rows = spans(rows, "text", TOKEN, "candidates")
    value = lambda x: F.length(F.regexp_extract(x["text"], PATTERNS["assign"], 2))
    rows = rows.withColumn("assign", F.filter("assign", lambda x: value(x) >= MIN_VALUE))
    order = {kind: i for i, kind in enumerate([*PATTERNS, "random"])}

    def listed(kind: str, found: Column) -> Column:
        return F.transform(
            found, lambda x: F.struct(x["start"].alias("start"), F.lit(order[kind]).alias("nth"), x["end"].alias("end"), F.lit(kind).alias("kind"))
        )

    length = F.element_at(F.array(*[F.lit(n) for n in LENGTHS]), (F.pmod("key", F.lit(len(LENGTHS))) + 1).cast("int"))
    place = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 30))
    plain = [ordinary(F.col("text"), drop, place, length) for drop in ("[^A-Za-z0-9]+", "[^0-9a-f]+")]
    string = lambda role, start, end, body: F.struct(
        F.lit(role).alias("role"), start.alias("start"), end.alias("end"), body.alias("text")
    )
    strings = F.concat(
        F.transform("candidates", lambda x: string("candidate", x["start"], x["end"], x["text"])),
        F.filter(
            F.array(*[string("ordinary", F.lit(0), F.lit(0), x) for x in plain]),
            lambda x: F.length(x["text"]) >= LENGTHS[0],
        ),
    )
    base = F.array_sort(F.concat(*[listed(kind, F.col(kind)) for kind in PATTERNS]))
    rows = rows.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in PATTERNS], base.alias("base"), strings.alias("strings")
    )
    tested = stored(rows.withColumn("tested", battery("strings")).drop("strings"), "secrets")

    chosen = thresholds(tested, false_rate)

    def random(x: Column) -> Column:
        level = F.lit(2.0)
        for name, length_class, at in chosen:
            level = F.when((family(x["encoding"]) == name) & (x["length_class"] == length_class), at).otherwise(level)
        return (x["role"] == "candidate") & (x["p"] >= level)

    joined = lambda found: F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    added = listed("random", _outside(F.filter("tested", random), F.col("base")))
    return tested.select(
        "doc_id",
        *[f"n_{kind}" for kind in PATTERNS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", added))).alias("spans"),
    )
