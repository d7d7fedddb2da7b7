"""Quality rules in a short-circuit cascade.

Every text is measured first (the base counts). A text that passes the base goes through
further rules, any of which rejects it; the rest is then spared. Each task runs all rules
on the first texts it meets (``SAMPLE``), notes what each costs and which texts each rejects,
and from then on runs the rules by rejections per cost: the next rule is the one that
rejects most, per second, of the texts that the rules before it leave. The order is a
matter of speed alone: the verdict is whether any rule rejects, whatever the order.

Every row is judged by itself in the task that reads it, so there is no shuffle, and
repeated rows and null ids need no care. A null text counts as empty: it has no words and
fails the base. Whole texts are measured. Words are compared by 64-bit hashes. Other columns
are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import slices, whole_text
from propgraph.llm.shingles import hash_words

SAMPLE = 64  # texts of a task that run through all rules
WINDOW = 8  # words of a window that repeats
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = bytes(b for b in range(256) if b >= 128 or chr(b).isalpha())
_CAPITALS = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))


def _count(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def _run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words; there must be so many."""
    n = len(hashes) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _ODD + hashes[j : j + n]
    return out


class Measured:
    """A text and its counts, each made when it is first asked for."""

    def __init__(self, text: str):
        self.text, self.data = text, text.encode()
        self.words = self.data.split()
        self.n_words = len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - _count(self.data, SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return _count(self.data, SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        """The lines that have a word, as they are."""
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def hashes(self) -> np.ndarray:
        return hash_words(self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows that occur twice or more, the first occurrence included."""
        if self.n_words <= WINDOW:
            return 0
        found = _run_hashes(self.hashes, WINDOW)
        order = np.argsort(found)
        same = found[order[1:]] == found[order[:-1]]
        if not same.any():
            return 0
        starts = np.zeros(len(found), bool)
        starts[order[1:][same]] = starts[order[:-1][same]] = True
        edge = np.zeros(self.n_words + 1, np.int64)
        edge[:-WINDOW][starts] += 1
        edge[WINDOW:][starts] -= 1
        return int(np.count_nonzero(np.cumsum(edge)))

    @property
    def base_failed(self) -> bool:
        return self.n_words < 20 or 100 * self.n_repeat_words > 30 * self.n_words


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Measured], bool]


def _word_length(m: Measured) -> bool:
    return not 3 * m.n_words <= m.word_chars <= 10 * m.n_words


def _symbols(m: Measured) -> bool:
    return 10 * m.n_symbols > m.n_words


def _dup_lines(m: Measured) -> bool:
    return 10 * m.n_dup_lines > 3 * len(m.lines)


def _bullets(m: Measured) -> bool:
    marks = (b"- ", b"* ", "• ".encode())
    return 10 * sum(line.strip().startswith(marks) for line in m.lines) > 9 * len(m.lines)


def _ellipses(m: Measured) -> bool:
    ends = (b"...", "…".encode())
    return 10 * sum(line.strip().endswith(ends) for line in m.lines) > 3 * len(m.lines)


def _few_letters(m: Measured) -> bool:
    """Fewer than four fifths of the words hold a letter; all beyond ASCII counts as one."""
    bare = sum(not _count(w, _LETTERS) for w in m.words)
    return 5 * (m.n_words - bare) < 4 * m.n_words


def _capitals(m: Measured) -> bool:
    capitals = _count(m.data, _CAPITALS)
    return capitals > _count(m.data, _SMALL)


def _shouts(m: Measured) -> bool:
    return 10 * _count(m.data, b"!?") > 3 * m.n_words


def _digits(m: Measured) -> bool:
    return 10 * _count(m.data, b"0123456789") > 3 * m.word_chars


def _braces(m: Measured) -> bool:
    return 20 * _count(m.data, b"{}") > m.n_words


def _frequent_run(m: Measured) -> bool:
    """One run of three words, met three times or more, makes up over 18 of 100 words."""
    if m.n_words < 3:
        return False
    runs = np.sort(_run_hashes(m.hashes, 3))
    edges = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1], [True]]))
    most = int(np.diff(edges).max())
    return most >= 3 and 300 * most > 18 * m.n_words


def _filler(m: Measured) -> bool:
    return b"lorem ipsum" in m.data.lower()


RULES = (
    Rule("word_length", _word_length),
    Rule("symbols", _symbols),
    Rule("dup_lines", _dup_lines),
    Rule("bullets", _bullets),
    Rule("ellipses", _ellipses),
    Rule("few_letters", _few_letters),
    Rule("capitals", _capitals),
    Rule("shouts", _shouts),
    Rule("digits", _digits),
    Rule("braces", _braces),
    Rule("frequent_run", _frequent_run),
    Rule("filler", _filler),
)


def cascade_order(rejected: np.ndarray, seconds: np.ndarray) -> list[int]:
    """Rules by rejections per cost among the texts that the rules before leave.

    ``rejected`` has a row per sampled text and a column per rule. Rules that reject nothing
    more come last, the cheapest of them first.
    """
    left, order, rest = np.ones(len(rejected), bool), [], list(range(rejected.shape[1]))
    cost = np.maximum(seconds, 1e-12)
    while rest:
        gain = rejected[left].sum(axis=0) / cost
        best = max(rest, key=lambda r: (gain[r], -cost[r], -r))
        order.append(best)
        rest.remove(best)
        left &= ~rejected[:, best]
    return order


class Cascade:
    """Judges texts one after another; the first ``sample`` of them run through every rule."""

    def __init__(self, rules: Sequence[Rule] = RULES, sample: int = SAMPLE):
        self.rules, self.sample = list(rules), sample
        self.order: list[int] | None = None
        self._rejected: list[list[bool]] = []
        self._seconds = np.zeros(len(self.rules))

    def rejects(self, m: Measured) -> bool:
        if self.order is not None:
            return any(self.rules[i].rejects(m) for i in self.order)
        found = []
        for i, rule in enumerate(self.rules):
            began = time.perf_counter()
            found.append(rule.rejects(m))
            self._seconds[i] += time.perf_counter() - began
        self._rejected.append(found)
        if len(self._rejected) >= self.sample:
            self.order = cascade_order(np.array(self._rejected), self._seconds)
        return any(found)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of each row."""
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cascade = Cascade(rules)
        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                m = Measured(text)
                counts = [getattr(m, c) for c in COUNTS]
                rows.append((*counts, m.base_failed, not m.base_failed and not cascade.rejects(m)))
            kinds = [pa.int64()] * len(COUNTS) + [pa.bool_()] * 2
            columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *COUNTS, "base_failed", "kept"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return texts.mapInArrow(run, f"doc_id long, {counts}, base_failed boolean, kept boolean")
