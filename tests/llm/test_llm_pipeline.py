from __future__ import annotations

import base64
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import bag
from test_llm_classify import dense_scores
from test_llm_leaks import brute

import corpus_pipeline
from propgraph.llm import queries
from propgraph.llm.decontaminate import find_words

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.LLM_ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.LLM_QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.LLM_ORACLE[name]})").fetchall()
    assert bag(df.select(*columns).collect()) == bag(want)


def test_one_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in queries.LLM_QUERIES) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])


@pytest.fixture
def planted(spark, tmp_path):
    """Clean documents, and one of each kind that a stage takes out."""
    draw = random.Random(6)
    text = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    rows = [(i, text(60)) for i in range(60)]
    near = rows[5][1].split()
    near[30] = "edited"
    item = text(30)
    rows += [(60, rows[4][1]), (61, " ".join(near)), (62, f"{text(20)} {item} {text(20)}")]
    rows += [(i, f"{text(20)} awful vileness {text(20)}") for i in range(70, 110)]
    rows += [(200, None), (201, ""), (202, " ".join(near)), (None, text(10)), (203, text(30_000))]
    docs = spark.createDataFrame([(*r, "en", "s", 0, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars int, digest string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 70)) for i, _ in rows if i is not None and i < 200]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline(spark, planted):
    kept = {r.doc_id for r in corpus_pipeline.run(spark, planted).collect()}
    # 60 stays for 4, 5 for its near copies, 201 for the null text
    assert kept == {*range(60), 60, 201, None, 203} - {4}


def test_each_stage_keeps_the_columns(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, planted).columns == docs.columns


def test_stages_on_no_rows(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs, planted).count() == 0


def near_copies(texts):
    """Ids that a smaller id is linked to by a chain, over all pairs of five-word sets."""
    sets = {}
    for i, text in texts.items():
        w = text.encode().lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    first = {i: i for i in sets}

    def top(i):
        while first[i] != i:
            i = first[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                first[y] = x
    return {i for i in sets if top(i) != i}


def covers(item, text):
    """Whether greedy tiling as it is defined covers half of the item; pairs without a shared run of five have no tile."""
    item, doc = find_words(item.lower()), find_words(text.lower())
    runs = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (item, doc)]
    if runs[0].isdisjoint(runs[1]):
        return False
    return sum(n for *_, n in brute(item, doc, 5)) >= 0.5 * len(item)


def test_pipeline_equals_brute_force(spark):
    def texts_of(name, key):
        return {r[key]: r.text or "" for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()}

    texts, items = texts_of("documents", "doc_id"), texts_of("benchmark", "item_id")
    kept = {i: t for (i, t), s in zip(texts.items(), dense_scores(spark, SF, texts.values())[0], strict=True) if s < 0.5}
    assert len(kept) < len(texts)
    last = {t: max(i for i in kept if kept[i] == t) for t in set(kept.values())}
    kept = {i: t for t, i in last.items()}
    gone = near_copies(kept)
    kept = {i: t for i, t in kept.items() if i not in gone}
    clean = {i: t for i, t in kept.items() if not any(covers(item, t) for item in items.values())}
    assert gone and len(clean) < len(kept)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text in clean.items():
        ids = encoder.encode_ordinary(text)
        packed = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    found = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert bag(found.collect()) == bag(want)
