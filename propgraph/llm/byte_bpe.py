"""Byte-level BPE by monoid tree reduction, and its decoding.

A text is halved until its parts are small, the parts are encoded, and neighbours are
joined up the tree. Two joins are needed, and both leave alone what provably stays:

* Matches of the split pattern. A match depends only on what follows its start. So the
  left half keeps all matches but its last, and but those that start within REACH
  characters of its end, where a literal of the pattern may have been cut. From there
  the pattern runs anew, and as soon as it ends a match where one of the right half
  begins, the rest of the right half stands.
* Tokens inside one match. A sequence of tokens is the encoding of its bytes exactly if
  each two neighbours encode to themselves. So a window around the border is encoded
  anew, twice as wide each time, until its outer tokens and the
  untouched ones beside them are such neighbours.

Decoding concatenates the tokens' bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from propgraph.llm.common import Remembered, slices

LEAF_CHARS = 1 << 14  # texts are halved down to parts of at most so many characters
REACH = 3  # characters in the longest literal of the pattern
LEAF_IDS = 1 << 14  # and lists of ids when they are decoded
LEAF_BYTES = 16  # matches are halved down to so many bytes
LISTED_BYTES = 48  # longer pieces are merged by a heap
KEPT_PAIRS = 50_000  # and of so many pairs of tokens whether they are neighbours
KEPT_MATCHES = 150_000  # a worker remembers the encodings of at most twice as many matches at a time


class ByteEncoder:
    """The ranks of a tiktoken file, with the pattern that splits texts before the merges."""

    def __init__(self, rank_file: str, pattern: str):
        import regex

        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.packed = Remembered(self._pack, KEPT_MATCHES)
        self.stable: dict[tuple[int, int], bool] = {}

    # inside one match

    def _merge(self, piece: bytes) -> list[int]:
        """Merge the bytes of a piece: the pair of the lowest rank first, leftmost on ties."""
        if len(piece) > LISTED_BYTES:
            return self._merge_long(piece)
        ranks, parts = self.ranks, [piece[i : i + 1] for i in range(len(piece))]
        found = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while found and (best := min(found)) != _NONE:
            i = found.index(best)
            parts[i] += parts.pop(i + 1)
            del found[i]
            if i:
                found[i - 1] = ranks.get(parts[i - 1] + parts[i], _NONE)
            if i < len(found):
                found[i] = ranks.get(parts[i] + parts[i + 1], _NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap of pairs and a linked list of parts."""
        ranks, n = self.ranks, len(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if j >= n or parts[i] is None or ranks.get(parts[i] + parts[j]) != rank:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (r := ranks.get(parts[a] + parts[b])) is not None:
                    heappush(heap, (r, a))
        return [ranks[p] for p in parts if p is not None]

    def _are_neighbours(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens encode to just these two."""
        if (known := self.stable.get((a, b))) is None:
            known = self._merge(self.tokens[a] + self.tokens[b]) == [a, b]
            if len(self.stable) >= KEPT_PAIRS:
                self.stable.clear()
            self.stable[a, b] = known
        return known

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        width = 0
        while True:
            i, j = max(0, len(left) - width), min(len(right), width)
            window = left[i:] + right[:j]
            if width:
                window = self._merge(b"".join(map(self.tokens.__getitem__, window)))
            edges = []
            if i:
                edges.append((left[i - 1], (window or right[j:])[0]))
            if j < len(right):
                edges.append(((window or left[:i])[-1], right[j]))
            if all(self._are_neighbours(a, b) for a, b in edges):
                return left[:i] + window + right[j:]
            width = max(1, 2 * width)

    def encode_match(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            return self._merge(piece)
        half = len(piece) // 2
        return self._join(self.encode_match(piece[:half]), self.encode_match(piece[half:]))

    def _pack(self, match: str) -> bytes:
        ids = self.encode_match(match.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    # a whole text

    def split(self, text: str) -> list[str]:
        """The matches of the pattern, in order."""
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        return self._split_long(text)

    def _split_long(self, text: str) -> list[str]:
        """Bottom up: parts of LEAF_CHARS, then neighbours, then neighbours of these."""
        parts = [[m.span() for m in self.pattern.finditer(text, i, min(i + LEAF_CHARS, len(text)))]
                 for i in range(0, len(text), LEAF_CHARS)]
        ends = [min(i + LEAF_CHARS, len(text)) for i in range(0, len(text), LEAF_CHARS)]
        while len(parts) > 1:
            joined = [
                self._join_spans(text, parts[k], parts[k + 1], ends[k + 1]) for k in range(0, len(parts) - 1, 2)
            ]
            odd = len(parts) % 2
            parts, ends = joined + parts[len(parts) - odd :], ends[1::2] + ends[len(ends) - odd :]
        return [text[a:b] for a, b in parts[0]]

    def _join_spans(
        self, text: str, left: list[tuple[int, int]], right: list[tuple[int, int]], end: int
    ) -> list[tuple[int, int]]:
        if not left or not right:
            return left or right
        border, k = right[0][0], 0
        at = left.pop()[0]
        while left and left[-1][0] > border - REACH:
            at = left.pop()[0]
        while True:
            while k < len(right) and right[k][0] < at:
                k += 1
            if k < len(right) and right[k][0] == at:
                return left + right[k:]
            m = self.pattern.search(text, at, end)
            if m is None:
                return left
            left.append(m.span())
            at = m.end()

    def encode(self, text: str) -> bytes:
        """The ids, each as a little-endian unsigned 32-bit integer."""
        return b"".join(map(self.packed.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of packed ids."""
        if len(ids) > 4 * LEAF_IDS:
            half = len(ids) // 8 * 4
            return self.decode(ids[:half]) + self.decode(ids[half:])
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_NONE = 1 << 60


@cache
def _encoder(rank_file: str, pattern: str) -> ByteEncoder:
    """One for each Python worker, which serves many tasks."""
    return ByteEncoder(rank_file if "/" in rank_file else SparkFiles.get(rank_file), pattern)


def _mapped(df: DataFrame, source: str, target: str, rank_file: str, pattern: str, step: str) -> DataFrame:
    """``df`` with the binary column ``target``, made from ``source`` by a method of the encoder."""
    if target.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {target} exists: name another one")
    schema = StructType([*df.schema, StructField(target, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = getattr(_encoder(rank_file, pattern), step)
        for batch in slices(batches, source):
            values = batch.column(source)
            made = pa.array([make(v.as_py()) if v.is_valid else b"" for v in values], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, target])

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the ids of each whole text, packed as little-endian unsigned 32-bit integers.

    ``rank_file`` is a path that all executors can read, or the name of a file added with
    ``SparkContext.addFile``. A null text has no ids, as an empty one. Rows keep all of
    their columns, also repeated rows; a column that has the new name already is an error.
    """
    return _mapped(df, text_col, ids_col, rank_file, pattern, "encode")


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add the bytes of packed ids; an id outside the vocabulary is an error."""
    return _mapped(df, ids_col, bytes_col, rank_file, pattern, "decode")


def digests(df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode what came out, and return per row: id, n_tokens, ids_sha256, decoded_sha256."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [LongType(), StringType(), StringType()]
    schema = StructType([rows.schema["doc_id"], *(StructField(n, t) for n, t in zip(names, kinds, strict=True))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(rank_file, pattern)
        for batch in slices(batches, "text"):
            found = []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text or "")
                decoded = encoder.decode(ids)
                found.append((len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded).hexdigest()))
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names])
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)
