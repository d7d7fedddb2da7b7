"""Toxicity by nearest labelled examples, exact in TF-IDF cosine.

Terms are byte 4-grams of the lower-cased text, so that stems inside words count. The
terms that tell the labels apart are chosen on a bounded sample of labelled rows; their
document frequencies are counted over all documents. The examples are an inverted index
in blocks: for each block and term the greatest weight is kept, and blocks are searched
in the order of the score they could reach at most, until none can beat the k-th best.

A score is the vote of the k nearest, each weighted by its similarity and by how many
rows it stands for, and drawn towards the rate among examples that share no term with a
text; with no shared term it is that rate. The nearest examples are the evidence.

Defined results: a null text counts as empty and has no terms. Ties in similarity go to
the smaller example id. Every row is scored by itself, repeated rows alike. Without any
training row of one of the labels, every score is the smoothed rate of the labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from propgraph.llm.common import slices, whole_text
from propgraph.llm.training import held_out, sample

EXAMPLES = 4000  # of each label, at most
TERMS = 1024
LEAST_RATIO = 1.5  # times as frequent in toxic examples as in others
LEAST_DOCS = 8  # toxic examples that must have a term, or a quarter of them if that is less
NEIGHBOURS = 16
BLOCK = 512  # examples of a block
PULL = 0.1  # similarity that the background rate counts for

SCORED = StructType(
    [
        StructField("score", DoubleType()),
        StructField("neighbours", ArrayType(LongType())),
        StructField("similarities", ArrayType(DoubleType())),
    ]
)
ARROW_SCORED = pa.struct(
    [("score", pa.float64()), ("neighbours", pa.list_(pa.int64())), ("similarities", pa.list_(pa.float64()))]
)


def grams(text: str) -> np.ndarray:
    """All byte 4-grams of the lower-cased text, as 32-bit numbers."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    if len(data) < 4:
        return np.empty(0, np.uint32)
    return data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24


@dataclass
class Vocabulary:
    """The chosen terms, sorted, and a bit table that rules most other grams out."""

    terms: np.ndarray
    table: np.ndarray = field(init=False)

    def __post_init__(self):
        self.table = np.zeros(1 << 20, bool)
        self.table[self._slot(self.terms)] = True

    @staticmethod
    def _slot(g: np.ndarray) -> np.ndarray:
        return (g * np.uint32(2654435761)) >> np.uint32(12)

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms in the text and how often each occurs."""
        g = grams(text)
        g = g[self.table[self._slot(g)]] if len(self.terms) else g[:0]
        at = np.minimum(np.searchsorted(self.terms, g), max(0, len(self.terms) - 1))
        return np.unique(at[self.terms[at] == g] if len(g) else at, return_counts=True)


@dataclass
class BlockIndex:
    """Unit vectors of the examples by blocks; ``tops`` holds each block's greatest weight of each term."""

    vocabulary: Vocabulary
    idf: np.ndarray
    ids: np.ndarray
    votes: np.ndarray  # the label, times the rows that an example stands for
    share: np.ndarray  # the rows that an example stands for
    background: float
    tops: np.ndarray  # term x block
    postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # by block: where each term begins, places, weights

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        terms, counts = self.vocabulary.counts(text)
        weights = (1 + np.log(counts)) * self.idf[terms] if len(terms) else np.empty(0)
        norm = np.sqrt((weights**2).sum())
        return terms, weights / norm if norm else weights

    def nearest(self, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k nearest examples with a shared term, and their similarities, exactly."""
        terms, weights = self.vector(text)
        if not len(terms) or not len(self.ids):
            return np.empty(0, np.int64), np.empty(0)
        most = weights @ self.tops[terms]
        best, sims = np.empty(0, np.int64), np.empty(0)
        for block in np.argsort(-most, kind="stable").tolist():
            # with room for rounding, and on to equal bounds: a tie may go to a smaller id
            if most[block] <= 0 or len(best) == k and most[block] < sims[-1] - 1e-9:
                break
            begins, places, values = self.postings[block]
            starts, sizes = begins[terms], begins[terms + 1] - begins[terms]
            # the postings of all asked terms, one run after another
            ends = sizes.cumsum()
            at = np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)
            scores = np.bincount(places[at], np.repeat(weights, sizes) * values[at], minlength=BLOCK)
            local = np.flatnonzero(scores > 0)
            best, sims = np.concatenate([best, block * BLOCK + local]), np.concatenate([sims, np.round(scores[local], 12)])
            order = np.lexsort((self.ids[best], -sims))[:k]
            best, sims = best[order], sims[order]
        return best, sims

    def score(self, text: str, k: int = NEIGHBOURS) -> dict:
        best, sims = self.nearest(text, k)
        vote, weight = sims @ self.votes[best] + PULL * self.background, sims @ self.share[best] + PULL
        return {
            "score": float(min(1.0, max(0.0, vote / weight))),
            "neighbours": self.ids[best].tolist(),
            "similarities": sims.tolist(),
        }


def _choose_terms(examples: DataFrame, n: dict[int, int], most: int, least: int) -> np.ndarray:
    """The terms with the greatest chi-square against the labels among those LEAST_RATIO times as frequent in label 1.

    Documents are counted per term and label in each task and summed by Spark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            labels = batch.column("label").to_numpy()
            found = [np.unique(grams(t)) for t in batch.column("text").to_pylist()]
            terms, at = np.unique(np.concatenate(found), return_inverse=True)
            label = np.repeat(labels, [len(f) for f in found])
            counts = [np.bincount(at[label == v], minlength=len(terms)) for v in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms.astype(np.int64)), *(pa.array(c.astype(np.int64)) for c in counts)], ["term", "n0", "n1"]
            )

    counted = examples.select("text", "label").mapInArrow(run, "term long, n0 long, n1 long")
    totals = counted.groupBy("term").agg(F.sum("n0").cast("double").alias("n0"), F.sum("n1").cast("double").alias("n1"))
    a, b = F.col("n1"), F.col("n0")
    c, d = n[1] - a, n[0] - b
    chi = F.pow(a * d - b * c, F.lit(2)) / ((a + b) * (c + d + 1))
    chosen = totals.where((a >= least) & (a * n[0] >= b * n[1] * LEAST_RATIO)).orderBy(chi.desc(), "term").limit(most)
    return np.array(sorted(r.term for r in chosen.select("term").collect()), np.uint32)


def _document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(len(vocabulary.terms), np.int64), 0
        for batch in slices(batches, "text"):
            rows += batch.num_rows
            for text in batch.column("text").to_pylist():
                found[vocabulary.counts(text)[0]] += 1
        terms = np.append(np.arange(len(found)), -1)
        arrays = [pa.array(terms), pa.array(np.append(found, rows))]
        yield pa.RecordBatch.from_arrays(arrays, ["term", "docs"])

    sums = docs.select("text").mapInArrow(run, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    counts = dict(sums.collect())  # one row per chosen term
    return np.array([counts.get(i, 0) for i in range(len(vocabulary.terms))], np.int64), counts.get(-1, 0)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", examples: int = EXAMPLES, terms: int = TERMS
) -> BlockIndex:
    """The index of at most ``examples`` training rows of each label. ``docs``: doc_id, text (not null)."""
    chosen, totals = zip(*(sample(labels, label, v, examples) for v in (0, 1)), strict=True)
    ids = chosen[0].unionByName(chosen[1])
    rows = docs.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id", "label"])
    n = {0: 0, 1: 0} | dict(rows.groupBy("label").count().collect())
    least = max(1, min(LEAST_DOCS, n[1] // 4))
    vocabulary = Vocabulary(_choose_terms(rows, n, terms, least) if n[0] and n[1] else np.empty(0, np.uint32))
    df, n_docs = _document_frequencies(docs, vocabulary)
    idf = np.log1p(n_docs / np.maximum(df, 1))

    vector = StructType([StructField("terms", ArrayType(LongType())), StructField("counts", ArrayType(LongType()))])

    @F.arrow_udf(vector)
    def count(texts: pa.Array) -> pa.Array:
        found = [vocabulary.counts(t.as_py()) for t in texts]
        kind = pa.struct([("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
        return pa.array([{"terms": t.tolist(), "counts": c.tolist()} for t, c in found], kind)

    vectors = rows.select("doc_id", "label", F.inline(F.array(count("text")))).collect()  # 2 * examples rows at most
    rate = {v: totals[v] / n[v] if n[v] else 0.0 for v in (0, 1)}
    return _index(vocabulary, idf, vectors, rate)


def _index(vocabulary: Vocabulary, idf: np.ndarray, vectors: list, rate: dict[int, float]) -> BlockIndex:
    bare = {v: sum(r.label == v and not r.terms for r in vectors) * rate[v] for v in (0, 1)}
    background = (bare[1] + 1) / (bare[0] + bare[1] + 2)
    some = [r for r in vectors if r.terms]
    unit = []
    for r in some:
        w = (1 + np.log(np.array(r.counts))) * idf[r.terms]
        unit.append((r.terms, w / np.sqrt((w**2).sum())))
    # examples of one leading term stand together, so that the bounds of blocks are tight
    order = sorted(range(len(some)), key=lambda i: (unit[i][0][int(np.argmax(unit[i][1]))], some[i].doc_id))
    some, unit = [some[i] for i in order], [unit[i] for i in order]
    n_blocks = -(-len(some) // BLOCK)
    tops = np.zeros((len(vocabulary.terms), n_blocks))
    lists: list[list[tuple[int, int, float]]] = [[] for _ in range(n_blocks)]
    for at, (terms, weights) in enumerate(unit):
        block = at // BLOCK
        for t, w in zip(terms, weights.tolist(), strict=True):
            lists[block].append((t, at % BLOCK, w))
            tops[t, block] = max(tops[t, block], w)
    postings = []
    for rows in lists:
        terms, places, weights = (np.array(c) for c in zip(*sorted(rows), strict=True))
        begins = np.searchsorted(terms, np.arange(len(vocabulary.terms) + 1))
        postings.append((begins, places, weights))
    labels = np.array([r.label for r in some], float)
    share = np.array([rate[r.label] for r in some], float)
    share = share / share.mean() if len(share) else share
    ids = np.array([r.doc_id for r in some], np.int64)
    return BlockIndex(vocabulary, idf, ids, labels * share, share, background, tops, postings)


def scored(spark, index: BlockIndex, text: Column, k: int = NEIGHBOURS) -> Column:
    """A struct column: score, and the evidence (ids and similarities of the nearest examples)."""
    sent = spark.sparkContext.broadcast(index)

    @F.arrow_udf(SCORED)
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([sent.value.score(t.as_py(), k) for t in texts], ARROW_SCORED)  # a text at a time

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours, similarities of each row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    index = fit(docs, labels, label)
    rows = docs.select("doc_id", scored(docs.sparkSession, index, F.col("text")).alias("s"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= cut).cast("int").alias("predicted"),
        F.col("s.neighbours").alias("neighbours"),
        F.col("s.similarities").alias("similarities"),
    )


def accepted(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``cut``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    index = fit(rows, labels)
    return docs.where(scored(docs.sparkSession, index, whole_text())["score"] < cut)
