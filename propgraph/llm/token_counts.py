"""Token counts by heap-and-linked-list byte-pair merging, without identifiers.

The symbols of a chunk form a linked list. A heap holds the adjacent pairs that are a
piece of the vocabulary; the pair of the lowest rank, leftmost on ties, is merged
again and again. The count is the number of initial symbols less the merges; a
character outside the vocabulary that no merge took counts as its UTF-8 bytes.

A merge never crosses a place where no piece of the vocabulary holds the two
characters next to each other. Texts are cut at such places, which are verified from
the vocabulary when it is read, and the count of each distinct chunk is kept, so that
a word is merged once per task and not once per occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import Remembered, whole_text

SPACE = "▁"  # what the models write for a space
# what usual normalizers would change: full width, ligature, fraction, accents, spaces, controls, invisible
PROBES = ["\uff21", "\ufb01", "\u00bd", "e\u0301", "\u00e9", "\u3000", "\t", "\r\n", "\x00", "\u200b", "\ufeff", " a  b ", "A"]
PLACE, NUMBER = (1 << 40) - 1, (1 << 20) - 1
KEPT_WORDS = 400_000  # of the words met, a worker remembers at most twice as many at a time


class PieceMerger:
    """The byte-pair vocabulary of a sentencepiece ``.model`` file and its merges."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.normalize = model.normalize
        pieces = {model.id_to_piece(i): -model.get_score(i) for i in plain}
        self.byte_fallback = any(model.is_byte(i) for i in ids)
        self.pieces = pieces
        self.chunks = re.compile(self._boundaries()).findall
        self.known = Remembered(self.count_chunk, KEPT_WORDS // 2)
        self.words = Remembered(lambda word: self.count_text(SPACE + word), KEPT_WORDS)
        self.by_word = self._only_marks_spaces()
        # symbols as numbers: of a piece, or of a character that occurs in pieces
        self.number = {p: i for i, p in enumerate(dict.fromkeys([*pieces, *"".join(pieces)]))}
        self.other = len(self.number)  # any further character
        ranks = {r: i for i, r in enumerate(sorted(set(pieces.values())))}
        # of two neighbouring symbols that make a piece: its rank, and below it its number
        self.merge = {
            self.number[p[:cut]] << 20 | self.number[p[cut:]]: ranks[r] << 20 | self.number[p]
            for p, r in pieces.items()
            for cut in range(1, len(p))
            if p[:cut] in self.number and p[cut:] in self.number
        }

    def _only_marks_spaces(self) -> bool:
        """Whether normalizing does no more than to write SPACE for each space and in front."""
        if any(a != SPACE and b == SPACE for p in self.pieces for a, b in zip(p, p[1:], strict=False)):
            return False
        probes = [*"".join(self.pieces), *PROBES, "".join(PROBES)]
        return all(self.normalize(p) == SPACE + p.replace(" ", SPACE) for p in dict.fromkeys(probes))

    def _boundaries(self) -> str:
        """A pattern whose matches no merge crosses."""
        inner = {pair for piece in self.pieces for pair in zip(piece, piece[1:], strict=False)}
        if any(a != SPACE and b == SPACE for a, b in inner):
            return r"(?s:.+)"
        word = re.compile(r"\w").match
        if any("\n" in pair for pair in inner):
            return rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
        # word characters that some piece has before a mark; behind them a chunk goes on
        odd = {a for a, b in inner if word(a) and not word(b)}
        on = rf"(?:(?<=[{re.escape(''.join(sorted(odd)))}])[^\w{SPACE}\n]+\w*)*" if odd else ""
        return rf"\n|{SPACE}*[^\w{SPACE}\n]*\w+{on}|{SPACE}*[^\w{SPACE}\n]+|{SPACE}+"

    def count_chunk(self, chunk: str) -> int:
        merge, n = self.merge.get, len(chunk)
        symbols = [self.number.get(c, self.other) for c in chunk]
        outside = max(symbols) >= len(self.pieces)  # the numbers of the pieces come first
        extra = 0
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []  # rank of the pair, and below it the place of its left symbol
        for i in range(n - 1):
            if (m := merge(symbols[i] << 20 | symbols[i + 1])) is not None:
                heap.append(m >> 20 << 40 | i)
        heapify(heap)
        left = n
        while heap:
            top = heappop(heap)
            i = top & PLACE
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue
            m = merge(symbols[i] << 20 | symbols[j])
            if m is None or m >> 20 != top >> 40:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = m & NUMBER, -1
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := merge(symbols[i] << 20 | symbols[k])) is not None:
                    heappush(heap, m >> 20 << 40 | i)
            if (h := before[i]) >= 0 and (m := merge(symbols[h] << 20 | symbols[i])) is not None:
                heappush(heap, m >> 20 << 40 | h)
        if self.byte_fallback and outside:
            alive = (c for c, s in zip(chunk, symbols, strict=True) if s == self.number.get(c, self.other))
            extra = sum(len(c.encode()) - 1 for c in alive if c not in self.pieces)
        return left + extra

    def count_text(self, normalized: str) -> int:
        return sum(map(self.known.__getitem__, self.chunks(normalized)))

    def count(self, text: str) -> int:
        """The number of tokens of a whole text."""
        if self.by_word and text and SPACE not in text:
            words = text.split(" ")
            if "" not in words:  # each word is cut off where no merge crosses
                return sum(map(self.words.__getitem__, words))
        return self.count_text(self.normalize(text))


@cache
def _merger(model_file: str) -> PieceMerger:
    """One for each Python worker, which serves many tasks."""
    return PieceMerger(model_file)


def token_count(text: Column, model_file: str) -> Column:
    """The number of tokens of ``text`` (string) as a column; 0 for null and for an empty text.

    ``model_file`` is a path that all executors can read, or the name of a file added with
    ``SparkContext.addFile``.
    """

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merger = _merger(model_file if "/" in model_file else SparkFiles.get(model_file))
        for texts in batches:
            yield pa.array((merger.count(t.as_py()) if t.is_valid else 0 for t in texts), pa.int64())

    return counted(text)


def count_tokens(
    df: DataFrame, model_file: str, text_col: str = "text", limit: int = 4096, prefix: str = ""
) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > ``limit``) to every row.

    A null text counts as empty. Rows keep all of their columns, also repeated rows;
    ``prefix`` goes before the three names where a column has one of them already.
    """
    out = [prefix + n for n in ("n_bytes", "n_tokens", "over_limit")]
    if taken := {c.lower() for c in df.columns} & {n.lower() for n in out}:
        raise ValueError(f"columns {sorted(taken)} exist: give a prefix")
    text = whole_text(text_col)
    return (
        df.withColumn(out[0], F.octet_length(text).cast("long"))
        .withColumn(out[1], token_count(text, model_file))
        .withColumn(out[2], F.col(out[1]) > limit)
    )
