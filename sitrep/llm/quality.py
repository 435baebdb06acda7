"""Line-first quality rules: drop lines that fail, then documents that lose too much text."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sitrep.llm.common import IN_WORD, map_batches, map_rows, shingle_hashes, texts, word_hashes

SYMBOLS = b"#*$%&|<>"
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_bad_lines long, lost_words long, reasons string"
)
# Words in a row that mark a line as site furniture; compared in lower case. Licence notices
# are not among them: they say where a text may be used.
BOILERPLATE = (
    b"all rights reserved",
    b"accept cookies",
    b"cookie policy",
    b"privacy policy",
    b"terms of service",
    b"terms of use",
    b"subscribe to our newsletter",
    b"enable javascript",
    b"sign up for",
    b"click here to",
)
_BOILERPLATE = re.compile(b"|".join(re.escape(x) for x in BOILERPLATE))
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS) + b"]")
_SEPARATOR = re.compile(rb"(?:^|\s)(?:\||>|/|-|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7)(?=\s|$)")
_SHOUT = re.compile(rb"!!|\?\?")
_UPPER = re.compile(rb"[A-Z]")
_LOWER = re.compile(rb"[a-z]")


def line_fault(line: bytes, words: int) -> str | None:
    """Name of the first rule a line breaks, or None.

    * ``punctuation``: marks from ``#*$%&|<>`` beside more than a third of the words, two
      ``!!`` or ``??`` for every five words, or upper case nearly throughout;
    * ``navigation``: at least three separators that stand alone, one to every four words;
    * ``boilerplate``: one of the fixed phrases, in a line of at most forty words.
    """
    if len(_SEPARATOR.findall(line)) >= max(3, words / 4):
        return "navigation"
    if words >= 4 and len(_SYMBOL.findall(line)) > max(2, words / 3):
        return "punctuation"
    if words >= 5 and len(_SHOUT.findall(line)) >= max(2, 2 * words / 5):
        return "punctuation"
    if words >= 8 and len(_UPPER.findall(line)) > 9 * len(_LOWER.findall(line)):
        return "punctuation"
    if words <= 40 and _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    return None


def cleaned(text: bytes) -> tuple[bytes, int, int, int, int, list[str]]:
    """Text without failing lines; lines, failing lines, words, words lost and the rules broken."""
    kept, faults, total, lost = [], [], 0, 0
    lines = text.split(b"\n")
    for line in lines:
        words = len(line.split())
        total += words
        fault = line_fault(line, words) if words else None
        if fault:
            faults.append(fault)
            lost += words
        else:
            kept.append(line)
    return b"\n".join(kept), len(lines), len(faults), total, lost, faults


def repeated_words(words: np.ndarray, n: int = 5) -> int:
    """Words inside runs of ``n`` words that the text has at least twice."""
    if len(words) <= n:
        return 0
    runs = shingle_hashes(words, n)
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(runs), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return int(np.count_nonzero(np.cumsum(change[:-1])))


def judged(text: bytes | None, max_lost: float) -> tuple:
    """Counts and verdict of one text, in the order of ``RESULT`` after the id."""
    text = text or b""
    data = np.frombuffer(text, np.uint8)
    words = word_hashes(text, IN_WORD)
    n = len(words)
    chars = int(np.count_nonzero(IN_WORD[data] & ((data & 0xC0) != 0x80)))
    symbols = len(_SYMBOL.findall(text))
    with_words = [line for line in text.split(b"\n") if line.split()]
    repeats = repeated_words(words)
    failed = n < 10 or 100 * repeats > 20 * n
    _, lines, bad, _, lost, faults = cleaned(text)
    kept = not failed and lost <= max_lost * n
    reasons = ",".join(sorted(set(faults))) or None
    return n, chars, symbols, len(with_words) - len(set(with_words)), repeats, failed, kept, lines, bad, lost, reasons


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_lost: float = 0.5) -> DataFrame:
    """Counts of every document, and whether it is kept.

    One row per input row; a null or empty text has no words and fails. Rows are judged
    one by one, so repeats and ties do not matter; other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judged(t, max_lost) for t in texts(batch.column(1))]
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 3 + [pa.string()]
        names = [x.split()[0] for x in RESULT.split(", ")]
        arrays = [batch.column(0).cast(pa.int64())] + [pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names)

    return map_batches(docs.select(docs[doc_id].cast("long"), docs[text]), run, RESULT)


def keep_good(docs: DataFrame, text: str = "text", max_lost: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose text is kept, all columns as they were."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [judged(t, max_lost)[6] for t in texts(batch.column(at))]
        return batch.filter(pa.array(kept, pa.bool_()))

    return map_rows(docs, run)


def clean_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with failing lines taken out of the texts; a null text stays null."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = [None if t is None else cleaned(t)[0].decode() for t in texts(batch.column(at))]
        return batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return map_rows(docs, run)
