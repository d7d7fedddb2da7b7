from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from propgraph.llm import license_scan, quality, toxicity
from propgraph.llm.training import held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_rows(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id long")
    found = {r.doc_id: r.h for r in rows.select("doc_id", held_out(rows.doc_id).alias("h")).collect()}
    assert found == {None: True} | {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}


def index(texts, labels, terms):
    vocabulary = toxicity.Vocabulary(np.array(sorted(terms), np.uint32))
    rows = []
    for i, (text, label) in enumerate(zip(texts, labels, strict=True)):
        t, c = vocabulary.counts(text)
        rows.append(type("Row", (), {"doc_id": i, "label": label, "terms": t.tolist(), "counts": c.tolist()}))
    return toxicity._index(vocabulary, np.linspace(1, 3, len(terms)), rows, {0: 2.0, 1: 1.0})


def test_block_max_search_is_exact():
    draw = random.Random(8)
    syllables = ["".join(draw.choices("abcdefg", k=3)) for _ in range(30)]
    texts = [" ".join("".join(draw.choices(syllables, k=2)) for _ in range(draw.randrange(1, 30))) for _ in range(700)]
    texts += texts[:50]  # ties
    terms = set(np.concatenate([toxicity.grams(t) for t in texts]).tolist())
    made = index(texts, [i % 2 for i in range(len(texts))], draw.sample(sorted(terms), 80))
    vectors = np.zeros((len(texts), 80))
    for i, text in enumerate(texts):
        t, w = made.vector(text)
        vectors[i, t] = w
    for query in [*texts[:40], "zzz", "", texts[3] * 50]:
        t, w = made.vector(query)
        q = np.zeros(80)
        q[t] = w
        sims = np.round(vectors @ q, 10)
        want = sorted((-s, i) for i, s in enumerate(sims) if s > 0)[:16]
        best, got = made.nearest(query, 16)
        assert np.allclose(got, [-s for s, _ in want])
        assert made.ids[best].tolist() == [i for _, i in want]


def test_toxicity_tells_held_out_rows_apart(tables):
    docs, labels = tables
    rows = toxicity.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 40
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert any(r.neighbours for r in rows)


def dense_scores(spark, sf_dir, texts):
    """Scores and nearest examples by the similarity of each text to each example, without blocks or bounds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "coalesce(text, '') AS text")
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    examples = np.zeros((len(index.ids), len(index.vocabulary.terms)))
    for block, (begins, places, weights) in enumerate(index.postings):
        term = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
        examples[block * toxicity.BLOCK + places, term] = weights
    scores, evidence = [], []
    for text in texts:
        terms, weights = index.vector(text)
        sims = np.round(examples[:, terms] @ weights, 12) if len(terms) else np.zeros(len(index.ids))
        near = sorted(np.flatnonzero(sims > 0).tolist(), key=lambda j: (-sims[j], index.ids[j]))[: toxicity.NEIGHBOURS]
        vote = sum(sims[j] * index.votes[j] for j in near) + toxicity.PULL * index.background
        scores.append(vote / (sum(sims[j] * index.share[j] for j in near) + toxicity.PULL))
        evidence.append(index.ids[near].tolist())
    return scores, evidence


def test_toxicity_of_whole_tables_equals_brute_force(spark):
    small = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.score_documents(docs, labels).join(docs.select("doc_id", "text"), "doc_id").collect()
    scores, evidence = dense_scores(spark, small, [r.text or "" for r in rows])
    assert len(rows) == docs.count() and np.allclose([r.score for r in rows], scores)
    # rounding may order equal similarities either way
    same = [r.neighbours == e for r, e in zip(rows, evidence, strict=True)]
    assert sum(same) >= 0.98 * len(rows) and any(evidence)
    assert all(set(r.neighbours) == set(e) or len(e) == toxicity.NEIGHBOURS for r, e in zip(rows, evidence, strict=True))


def test_few_examples_are_enough_for_their_copies(spark):
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(60)]
    clean = [" ".join(draw.choices(words, k=30)) for _ in range(40)]
    toxic = [" ".join([*draw.choices(words, k=10), f"grobian{c}xyz verzagt{c}qu"]) for c in "abcdef"]
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:46]
    labels = spark.createDataFrame([(i, int(n >= 40)) for n, i in enumerate(ids)], "doc_id long, toxic int")
    rows = [*zip(ids, clean + toxic, strict=True), *((1000 + n, t) for n, t in enumerate(toxic + clean[:6]))]
    found = toxicity.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()
    got = {r.doc_id: r for r in found}
    assert all(got[1000 + n].predicted == 1 and got[1000 + n].neighbours[0] == ids[40 + n] for n in range(6))
    assert all(got[1006 + n].predicted == 0 for n in range(6))


def test_quality_tells_held_out_rows_apart(tables):
    docs, labels = tables
    rows = quality.score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.85
    assert sum(r.predicted for r in held if r.quality) / sum(r.quality for r in held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark, tables):
    docs, labels = tables
    turned = labels.selectExpr(
        "doc_id",
        "IF(pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) = 0, 1 - quality, quality) AS quality",
        "IF(pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) = 0, 1 - toxic, toxic) AS toxic",
    )
    for module in (toxicity, quality):
        one, two = ({r.doc_id: r.score for r in module.score_documents(docs, x).collect()} for x in (labels, turned))
        assert one.keys() == two.keys()
        assert all(abs(one[i] - two[i]) < 1e-6 for i in one)


ROWS = [(1, None), (2, ""), (None, "a few words"), (3, "x " * 100_000), (3, "x " * 100_000)]


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_of_odd_rows(spark, module):
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in ROWS], "doc_id long, text string, score double, label string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        found = module.score_documents(docs, labels).collect()
        assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in ROWS)
        assert all(0 <= r.score <= 1 for r in found)
    assert module.score_documents(docs.limit(0), some).count() == 0
    assert toxicity.accepted(docs, none).columns == docs.columns


def test_features_and_risk():
    assert not quality.features("").any()
    draw = np.random.default_rng(2)
    k = len(quality.NAMES)
    good, bad = draw.normal(1, 1, (800, k)), draw.normal(-1, 1, (800, k))
    scale = quality.Scale(np.zeros(k), np.ones(k))
    for n_good, n_bad in ((400, 200), (40, 400)):  # the second has fewer positives than the prior says
        p, u = scale(good[:400]), scale(np.concatenate([good[400 : 400 + n_good], bad[:n_bad]]))
        theta = quality.minimise(lambda t, p=p, u=u: quality.Sums.of(p, u, t), 2 / 3, k + 1)
        at = quality.Sums.of(p, u, theta)
        assert at.negative_risk(2 / 3) > -0.01
        assert at.risk(2 / 3) < quality.Sums.of(p, u, np.append(np.zeros(k), np.log(2))).risk(2 / 3)
        if n_good > n_bad:
            model = quality.Model(scale, theta)
            assert (model.scores(good) > 0.5).mean() > 0.95 and (model.scores(bad[200:]) < 0.5).mean() > 0.95


def test_sums_give_the_risk_and_steps_go_down_to_its_least():
    draw = np.random.default_rng(4)
    p, theta, prior = draw.normal(0.4, 1, (400, 4)), draw.normal(0, 0.1, 4), 0.4
    u = np.concatenate([draw.normal(0.4, 1, (400, 4)), draw.normal(-0.4, 1, (600, 4))])
    z_p, z_u = p @ theta, u @ theta
    at = quality.Sums.of(p, u, theta)
    negative = np.log1p(np.exp(z_u)).mean() - prior * np.log1p(np.exp(z_p)).mean()
    assert negative > 0 and np.isclose(at.negative_risk(prior), negative)
    assert np.isclose(at.risk(prior), prior * np.log1p(np.exp(-z_p)).mean() + negative + quality.DECAY / 2 * theta @ theta)
    again = quality.Sums.from_flat(at.flat(), theta)
    assert len(at.flat()) == quality.Sums.size(4) and again.risk(prior) == at.risk(prior)

    def risk(t):
        return quality.Sums.of(p, u, t).risk(prior)

    slope = np.array([(risk(theta + e) - risk(theta - e)) / 2e-5 for e in np.eye(4) * 1e-5])
    step, saved, held = at.newton(prior, 0.0)
    assert held == 0 and np.isclose(saved, -slope @ step, rtol=1e-4)
    best = quality.minimise(lambda t: quality.Sums.of(p, u, t), prior, 4)
    assert all(risk(best) <= risk(best + e) for e in (*np.eye(4) * 0.1, *-np.eye(4) * 0.1))


def test_every_unlabelled_document_and_trusted_positive_counts(spark, tables):
    docs, labels = tables
    extra = spark.createDataFrame([(None, "no id"), (10**9, "one"), (10**9, "two")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(extra)
    found = quality.vectors(docs.selectExpr("doc_id", "coalesce(text, '') AS text"))
    scale = quality._scale(found)
    theta = np.linspace(-1, 1, len(quality.NAMES) + 1)
    got = quality._sums(quality.training_rows(found, labels, "quality"), scale, theta)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.doc_id, quality.features(r.text or "")) for r in docs.collect()]
    assert np.allclose(scale.mean, np.mean([x for _, x in rows], 0))
    u = np.array([x for i, x in rows if i not in marks])
    p = np.array([x for i, x in rows if marks.get(i) == 1 and zlib.crc32(str(i).encode()) % 5])
    assert got.n.tolist() == [len(p), len(u)]
    assert np.allclose(got.flat(), quality.Sums.of(scale(p), scale(u), theta).flat())


def test_packed_covers_a_whole_text():
    draw = random.Random(5)
    head = "".join(draw.choices("abcdefghij ", k=1 << 16))
    packed = quality.NAMES.index("packed")
    for text in (head + "junk " * 40_000, "junk " * 40_000 + head, head, "é" * 40_000, "a"):
        data = text.encode()
        assert quality.features(text)[packed] == len(zlib.compress(data, 1)) / len(data)
    assert quality.features(head + "junk " * 40_000)[packed] < 0.5 * quality.features(head)[packed]


# licenses

TEXTS = [
    "x under the MIT License, under the mit-license.",
    "Apache License, Version 2.0 and apache license version 2",
    "Licensed under CC BY-NC 4.0. cc.by.nc cc by nc",
    "Licensed under the GNU General Public License version 2 or later",
    "GNU Affero General Public License v3",
    "All rights reserved. Copyright (c) 2020",
    "under theé mit license",
    "the bsd 3 clause license",
    "nothing here",
    "ÀB under",
    "\x00\x7f 7z É",
    None,
    "",
]


def test_license_scan(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0]), (0, TEXTS[0]), (99, "word " * 50_000 + TEXTS[0] * 300)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_words int, labels string")
    found = license_scan.scan(df).collect()
    assert len(found) == len(rows)
    import re

    want = []
    for doc_id, text in rows:
        low = (text or "").translate(str.maketrans(license_scan.UPPER, license_scan.LOWER))
        got = re.findall(license_scan.WORD, low)
        hits = [
            (k, label)
            for phrase, label in license_scan.BASE.items()
            for k in range(len(got))
            if got[k : k + len(phrase.split())] == phrase.split()
        ]
        places = [k for k, _ in hits]
        labels = ",".join(sorted({label for _, label in hits}))
        want.append((str(doc_id), len(got), len(hits), min(places, default=None), max(places, default=None), labels))
    key = lambda r: tuple(map(str, r))
    assert sorted(((str(r[0]), *r[1:6]) for r in found), key=key) == sorted(want, key=key)
    labels = {r.doc_id: r.labels for r in found}
    assert labels[2] == "cc-by-nc,cc-by-nc-4.0"
    assert labels[3] == "gpl-2.0"  # the plain name lies within
    assert labels[4] == "agpl-3.0"
    assert labels[5] == "all-rights-reserved,copyright"
    assert labels[7] == "bsd-3-clause"
    assert {r.score for r in found if not r.labels} == {0.0}
    assert license_scan.scan(df.limit(0)).count() == 0
    assert "Python" not in df._sc._jvm.PythonSQLUtils.explainString(license_scan.scan(df)._jdf.queryExecution(), "simple")


def test_the_better_rule_wins_where_two_overlap(spark):
    more = [
        license_scan.Rule(1, 1.0, "first", "copyright", "copyright one"),
        license_scan.Rule(9, 0.2, "later", "one", "one two three"),
    ]
    df = spark.createDataFrame([(1, "copyright one two three"), (2, "copyright, one two three: one two three")], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in license_scan.scan(df, more=more).collect()} == {1: "first", 2: "first,later"}


def test_every_rule_holds_its_keyword_and_a_gate():
    assert len(license_scan.rules()) > 300
    for rule in license_scan.rules():
        assert any(gate in rule.pattern for gate in ("licen", "spdx", "copyright", "rights", "domain", "proprietary", "under"))


def matches(parsed):
    """Every text that a parsed pattern of literals, classes, branches and options matches."""
    out = [""]
    for op, value in parsed:
        match str(op):
            case "LITERAL":
                more = [chr(value)]
            case "IN":
                more = [chr(c) for kind, v in value for c in ([v] if str(kind) == "LITERAL" else range(v[0], v[1] + 1))]
            case "BRANCH":
                more = [m for branch in value[1] for m in matches(branch)]
            case "SUBPATTERN":
                more = matches(value[-1])
            case "MAX_REPEAT":
                assert value[:2] == (0, 1)
                more = ["", *matches(value[2])]
            case _:
                raise ValueError(op)
        out = [a + b for a in out for b in dict.fromkeys(more)]
    return out


def test_every_match_of_a_rule_holds_its_keyword_and_a_gate():
    from re import _parser

    lost = set()
    for rule in license_scan.rules():
        for text in matches(_parser.parse(rule.pattern)):
            if rule.keyword not in text or not any(gate in text for gate in license_scan.GATES):
                lost.add((rule.label, rule.keyword))
    assert not lost


def test_matches_are_found_wherever_the_keyword_was_too_narrow(spark):
    texts = {
        "Licensed under Creative Commons Attribution-Non-Commercial": "cc-by-nc",
        "Licensed under Creative Commons Attribution-Non-Commercial-ShareAlike": "cc-by-nc-sa",
        "Licensed under Creative Commons Attribution-NonCommercial-NoDerivs": "cc-by-nc-nd",
        "Licensed under Creative Commons Attribution": "cc-by",
        "the Expat License": "mit",
        "Boost Software 1.0": "boost-1.0",
    }
    df = spark.createDataFrame(list(texts.items()), "text string, doc_id string")
    assert all(r.labels == r.doc_id for r in license_scan.scan(df).collect())
