"""Substring matching of texts against a list of terms.

A few terms are tested inside Catalyst. More terms go through one Aho-Corasick
pass per text in Arrow batches, whose cost does not grow with the number of terms.
Terms that one process should not hold lie in files: a task keeps some texts, and these
meet one part of the terms after the other, so that rows are read once and never rewritten.
All give the same answer on the whole text.
"""

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitrep.functions.files import open_filesystem

# Up to this many terms, separate tests in generated code match the automaton.
CATALYST_TERMS = 6
# An automaton takes tens of bytes per character of its terms in every worker.
MAX_TERMS = 200_000
MAX_TERM_BYTES = 8 * 1024 * 1024
# Characters of texts that a task keeps while the parts of the terms come by.
HELD_CHARS = 32 * 1024 * 1024
# Texts of an Arrow batch that are Python objects at a time.
VALUES = 64


@dataclass(frozen=True)
class TermFiles:
    """Terms, with labels or without, in Parquet folders ``part=0``, ``part=1``, … of ``path``."""

    path: str
    parts: int

    def __iter__(self) -> Iterator[list[tuple]]:
        from pyarrow import fs
        from pyarrow import parquet

        store, folder = open_filesystem(self.path)
        for part in range(self.parts):
            name = f"{folder}/part={part}"
            if store.get_file_info(name).type == fs.FileType.Directory:
                found = parquet.read_table(name, filesystem=store, partitioning=None)
                yield list(zip(*(column.to_pylist() for column in found.columns)))


def in_catalyst(terms: Sequence[tuple] | TermFiles) -> bool:
    return not isinstance(terms, TermFiles) and len(terms) <= CATALYST_TERMS


def contains_any(text: Column, terms: Sequence[tuple] | TermFiles) -> Column:
    """True where the text holds the term of at least one row; no terms, no match."""
    if in_catalyst(terms):
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for (t,) in terms], F.lit(False))

    @F.arrow_udf(T.BooleanType())
    def any_hit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for held, automata in _rounds(batches, terms):
            found = [[False] * len(texts) for texts in held]
            for automaton, always in automata:
                for texts, hits in zip(held, found):
                    for i, t in enumerate(_values(texts)):
                        if t is not None and not hits[i]:
                            hits[i] = bool(always) or (len(automaton) > 0 and next(automaton.iter(t), None) is not None)
            for hits in found:
                yield pa.array(hits, pa.bool_())

    return any_hit(text)


def matched_labels(text: Column, pairs: Sequence[tuple[str, str]] | TermFiles) -> Column:
    """Sorted distinct labels of the ``(term, label)`` pairs whose term the text holds."""
    if in_catalyst(pairs):
        found = [F.when(F.contains(text, F.lit(t)), F.lit(label)) for t, label in pairs]
        return F.array_sort(F.array_distinct(F.array_compact(F.array(*found).cast("array<string>"))))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for held, automata in _rounds(batches, pairs):
            found = [[set() for _ in texts] for texts in held]
            for automaton, always in automata:
                for texts, sets in zip(held, found):
                    for t, hits in zip(_values(texts), sets):
                        if t is not None:
                            hits.update(always)
                            if len(automaton):
                                for _, some in automaton.iter(t):
                                    hits.update(some)
            for sets in found:
                yield pa.array([sorted(s) for s in sets], pa.list_(pa.string()))

    # Keeps the optimizer from running the pass a second time for a filter it derives.
    return labels.asNondeterministic()(text)


def _values(texts: pa.Array) -> Iterator[str | None]:
    """Values of an array, few of them as Python objects at a time."""
    for at in range(0, len(texts), VALUES):
        yield from texts.slice(at, VALUES).to_pylist()


def _rounds(batches: Iterator[pa.Array], terms: Sequence[tuple] | TermFiles) -> Iterator[tuple[list, Iterable]]:
    """Batches that are matched together, and the automata they meet."""
    if not isinstance(terms, TermFiles):
        one = [_automaton(terms)]
        for texts in batches:
            yield [texts], one
        return
    held, size = [], 0
    for texts in batches:
        held.append(texts)
        size += pc.sum(pc.utf8_length(texts)).as_py() or 0
        if size >= HELD_CHARS:
            yield held, map(_automaton, terms)
            held, size = [], 0
    if held:
        yield held, map(_automaton, terms)


def _automaton(rows: Sequence[tuple]):
    """Automaton from each term to its labels (itself if it has none), and the labels of the empty term."""
    import ahocorasick

    by_term: dict[str, list[str]] = {}
    for row in rows:
        by_term.setdefault(row[0], []).append(row[-1])
    always = by_term.pop("", [])
    automaton = ahocorasick.Automaton()
    for term, found in by_term.items():
        automaton.add_word(term, tuple(found))
    automaton.make_automaton()
    return automaton, always
