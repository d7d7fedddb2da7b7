from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from propgraph.llm import exact_dedup, fuse_filter, jaccard_join, paragraph_dedup, shingles
from propgraph.llm.components import components
from propgraph.llm.jaccard_join import Threshold
from propgraph.llm.repeated_runs import facts_of, repeated_runs, window_hashes
from propgraph.staging import stage

DOCS = "doc_id long, text string, digest string, key long, node int"


def frame(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS)


def least_nodes(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_fuse_filter(n):
    draw = np.random.default_rng(n)
    keys = draw.integers(0, 1 << 63, n, np.uint64)
    built = fuse_filter.build(np.concatenate([keys, keys]))
    assert fuse_filter.contains(built, keys).all()
    assert fuse_filter.contains(built, draw.integers(0, 1 << 63, 50_000, np.uint64)).mean() < 0.01
    if n >= 10_000:
        assert len(built) < 1.4 * n


ROWS = [(1, "a"), (2, "a"), (2, "a"), (3, "b"), (None, "b"), (4, None), (5, ""), (None, "c"), (6, "long " * 50_000), (7, "A")]


def want_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        out.append((str(doc_id), str(keep), len(groups[text or ""]), doc_id == keep))
    return sorted(out)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda text: F.length(text).cast("string")])
@pytest.mark.parametrize("cut", [0, 4, 10])
def test_exact_dedup(spark, digest, cut):
    earlier, batch = frame(spark, ROWS[:cut]), frame(spark, ROWS[cut:])
    found = exact_dedup.dedup([earlier], batch, digest=digest).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in found) == want_exact(ROWS)


def test_exact_dedup_of_three_loads_and_of_none(spark):
    parts = [frame(spark, ROWS[a : a + 4]) for a in (0, 4, 8)]
    found = exact_dedup.dedup(parts[:2], parts[2]).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in found) == want_exact(ROWS)
    assert exact_dedup.dedup([frame(spark, [])], frame(spark, [])).count() == 0
    assert exact_dedup.dedup([], frame(spark, ROWS)).count() == len(ROWS)


def test_screen_passes_all_that_the_snapshot_holds(spark):
    rows = exact_dedup.digests(spark.range(3000).selectExpr("id AS doc_id", "'t' || id AS text"))
    snapshot = exact_dedup.build_snapshot(rows)
    batch = exact_dedup.digests(spark.range(2000, 8000).selectExpr("id AS doc_id", "'t' || id AS text")).select("digest")
    passed = {r.digest for r in exact_dedup.screen(batch, snapshot).collect()}
    held = {hashlib.sha256(f"t{i}".encode()).hexdigest() for i in range(2000, 3000)}
    assert held <= passed
    assert len(passed - held) < 150


def test_keep_one(spark):
    docs = frame(spark, ROWS)
    kept = exact_dedup.keep_one(docs, F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        [("2", "a"), ("3", "b"), ("5", ""), ("None", "c"), ("6", "long " * 50_000), ("7", "A")]
    )
    assert exact_dedup.keep_one(docs.limit(0), F.lit(True)).count() == 0


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(40)]
    rows = [(a, b) for a, b in edges] + [(5, None), (None, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert found == least_nodes(real, {n for e in real for n in e})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# near copies


def words(draw, n, common=()):
    return [draw.choice(common) if common and draw.random() < 0.2 else f"w{draw.randrange(10**6)}" for _ in range(n)]


def corpus(seed):
    """Copies, near copies at many distances, shared passages, short texts."""
    draw = random.Random(seed)
    passage, texts = words(draw, 60), []
    for size in (3, 4, 6, 9, 15, 40, 120):
        for _ in range(4):
            base = words(draw, size)
            texts.append(base)
            for edits in (0, 1, 1, 2, 3, 6):
                other = list(base)
                for _ in range(edits):
                    other[draw.randrange(size)] = f"e{draw.randrange(10**6)}"
                texts.append(other)
        texts += [words(draw, size // 2) + passage + words(draw, size // 2) for _ in range(3)]
    draw.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def shingle_sets(rows, k):
    def of(text):
        found = (text or "").lower().split()
        return {tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1))} if found else set()

    return [of(text) for _, text in rows]


@pytest.mark.parametrize(("k", "num"), [(4, 85), (5, 80)])
def test_jaccard_groups(spark, conf, monkeypatch, k, num):
    monkeypatch.setattr(jaccard_join, "BLOCK", 3)  # large buckets, at this size
    monkeypatch.setattr(jaccard_join, "STAR_TURNS", 1)
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    rows = corpus(k)
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (None, rows[0][1]), (n + 3, rows[5][1].upper()), (n + 4, "w " * 50_000)]
    sets = shingle_sets(rows, k)
    ids = [i for i, (doc_id, _) in enumerate(rows) if doc_id is not None]
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    want = least_nodes([(rows[a][0], rows[b][0]) for a, b in links], [rows[i][0] for i in ids])
    found = jaccard_join.jaccard_groups(frame(spark, rows), k, Threshold(num, 100)).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id is not None} == {rows[i][0]: len(sets[i]) for i in ids}
    assert [r.component_id for r in found if r.doc_id is None] == [None]


def test_jaccard_groups_of_repeated_ids_and_of_no_rows(spark):
    found = jaccard_join.jaccard_groups(frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f")]))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (1, 1), (2, 1)]
    assert jaccard_join.jaccard_groups(frame(spark, [])).count() == 0


def test_two_texts_under_one_id(spark):
    draw = random.Random(8)
    a, b = words(draw, 60), words(draw, 60)
    rows = [(1, a), (1, b), (2, [*a, "end"]), (3, [*b, "end"]), (None, [*b, "other"]), (4, words(draw, 30))]
    rows = [(i, " ".join(t)) for i, t in rows]
    found = jaccard_join.jaccard_groups(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [
        ("1", "1"), ("1", "1"), ("2", "1"), ("3", "1"), ("4", "4"), ("None", "None"),
    ]
    kept = jaccard_join.keep_one(frame(spark, [*rows, rows[1]]))
    assert kept.columns == frame(spark, []).columns
    # both texts of the first id stay, for neither has a copy of a smaller id
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        (str(i), t) for i, t in [rows[0], rows[1], rows[1], *rows[4:]]
    )


@pytest.mark.parametrize("num", [80, 85, 95])
def test_linked_sets_share_a_segment_and_their_sketches_are_near(num):
    threshold, draw = Threshold(num, 100), np.random.default_rng(num)
    for size in (1, 2, 3, 5, 7, 12, 30, 100, 400, 3000):
        for _ in range(30):
            base = draw.integers(0, 1 << 63, size, np.uint64)
            fewer = int(draw.integers(0, size // 4 + 1))
            other = np.concatenate([base[fewer:], draw.integers(0, 1 << 63, int(draw.integers(0, size // 4 + 1)), np.uint64)])
            a, b = np.unique(base), np.unique(other)
            common, both = len(np.intersect1d(a, b)), len(np.union1d(a, b))
            if not len(b) or 100 * common < num * both:
                continue
            assert np.intersect1d(jaccard_join.segment_keys(a, threshold), jaccard_join.segment_keys(b, threshold)).size
            x, y = jaccard_join.parity_sketch(a), jaccard_join.parity_sketch(b)
            n = min(len(x), len(y))
            away = np.bitwise_count(jaccard_join.fold(x, n) ^ jaccard_join.fold(y, n)).sum()
            assert away <= both - common <= threshold.differ(len(a), len(b))


def test_shingles_of_bytes():
    assert shingles.words("Ab\x0bCÉ d  E\n") == [b"ab", "cÉ d".encode(), b"e"]
    assert len(shingles.shingle_set("a b a b a b", 2)) == 2
    assert len(shingles.shingle_set("a", 4)) == 1
    assert len(shingles.shingle_set("", 4)) == 0


def test_repeated_paragraphs(spark):
    draw = random.Random(9)
    passages = [words(draw, 60) for _ in range(12)]
    near = list(passages[3])
    near[30] = "changed"
    far = [w if i % 4 else f"n{i}" for i, w in enumerate(passages[4])]
    line = " ".join
    rows = [
        (1, line(passages[0]) + "\n" + line(words(draw, 55))),
        (2, "short line\n" + line(passages[0]) + "\nend"),
        (3, line(passages[3])),
        (4, line(words(draw, 80)) + "\n" + line(near)),
        (5, line(passages[4])),
        (6, line(far)),
        (7, line(passages[5]) + "\n\n" + line(passages[5])),
        (8, None),
        (9, ""),
        (10, "one short line\none short line"),
        (11, line(words(draw, 30_000))),
        (None, line(passages[0])),
    ]
    found = paragraph_dedup.repeated_lines(frame(spark, rows)).collect()
    got = sorted((str(r.doc_id), str(r.keep_doc_id), r.kept) for r in found)
    assert got == sorted(
        [("1", "None", False), ("2", "None", False), ("None", "None", True), ("3", "3", True), ("4", "3", False)]
        + [("7", "7", True), ("7", "7", False)]
    )
    texts = dict(rows)
    assert {texts[r.doc_id][r.start : r.end] for r in found if r.doc_id in (1, 2)} == {line(passages[0])}
    assert {r.n_words for r in found} == {60}
    assert paragraph_dedup.repeated_paragraphs(frame(spark, [])).count() == 0


def test_passages_broken_over_short_lines(spark):
    draw = random.Random(14)
    passage, other, x, y = words(draw, 64), words(draw, 80), words(draw, 20), words(draw, 20)
    near = list(other)
    near[1] = "changed"
    wrap = lambda found, n: "\n".join(" ".join(found[i : i + n]) for i in range(0, len(found), n))
    ends = [wrap(words(draw, 40), 40) for _ in range(4)]
    rows = [
        (1, "intro line\n" + wrap(passage, 8) + "\nits own end"),
        (2, wrap(passage, 8).replace("\n", "\n \n") + "\nanother end"),  # lines without words do not part a run
        (3, wrap(passage[:48], 8) + "\na run under 50 words"),
        (4, wrap(other, 40)),
        (5, wrap(near, 40) + "\nmore"),
        (6, wrap(x, 20) + "\n" + ends[0]),
        (7, wrap(x, 20) + "\n" + ends[0]),
        (8, wrap(x, 20) + "\n" + ends[1]),  # the first of another run with the same line stays whole
        (9, wrap(x, 20) + "\n" + ends[1]),
        (10, wrap(x, 20) + "\n" + ends[2]),
        (11, wrap(y, 1) + "\n" + wrap(y, 1)),  # 20 words twice
    ]
    found = paragraph_dedup.repeated_lines(frame(spark, rows)).collect()
    got = {i: sorted((r.keep_doc_id, r.kept) for r in found if r.doc_id == i) for i, _ in rows}
    assert got == {
        1: [(1, True)] * 8,
        2: [(1, False)] * 8,
        3: [],
        4: [(4, True)] * 2,
        5: [(4, False)] * 2,
        6: [(6, True)] * 2,
        7: [(6, False)] * 2,
        8: [(8, True)] * 2,
        9: [(8, False)] * 2,
        10: [],
        11: [],
    }
    texts = dict(rows)
    assert sorted(" ".join(passage).split()) == sorted(w for r in found if r.doc_id == 2 for w in texts[2][r.start : r.end].split())


def brute_runs(rows, least):
    """Runs of words whose windows occur twice: id, start, end, words; and how often each window occurs."""
    texts = {}
    for doc_id, text in rows:
        found = re.finditer(r"[^\x20\x09-\x0D]+", text or "")
        texts[(doc_id, text or "")] = [(m.start(), m.end(), m[0].translate(LOWERED)) for m in found]
    times = defaultdict(list)
    for key, found in texts.items():
        for s in range(len(found) - least + 1):
            times[tuple(w[2] for w in found[s : s + least])].append((key, s))
    out = []
    for (doc_id, _), found in texts.items():
        last = None
        for s in range(len(found) - least + 1):
            if len(times[tuple(w[2] for w in found[s : s + least])]) < 2:
                continue
            if last is None or s > last[1] + least:
                last = [s, s]
                out.append((doc_id, found, last))
            last[1] = s
    return sorted((str(i), w[a][0], w[b + least - 1][1], b + least - a) for i, w, (a, b) in out)


def runs_of(df, least=50):
    texts = df.select("doc_id", F.xxhash64("doc_id", "text").alias("own"), "text")
    return repeated_runs(texts, stage(facts_of(texts, least), "facts"), least)


LOWERED = {c: c + 32 for c in range(65, 91)}


def test_runs_within_longer_lines(spark):
    draw = random.Random(3)
    passages = [words(draw, draw.randint(50, 80)) for _ in range(10)]
    rows = []
    for i in range(120):
        text = words(draw, draw.randint(0, 150))
        for p in draw.sample(passages, draw.choice([0, 0, 1, 2])):
            at = draw.randint(0, len(text))
            text[at:at] = p if draw.random() < 0.8 else p[:49]  # one word short
        rows.append((i, "".join(w + draw.choice([" ", "\n", " \t "]) for w in text)))
    rows += [rows[3], (900, rows[4][1]), (901, "é日 " * 130), (None, rows[5][1]), (902, None), (903, " ".join(passages[0]).upper())]
    found = runs_of(frame(spark, [(i, t or "") for i, t in rows])).collect()
    assert sorted((str(r.doc_id), r.start, r.end, r.n_words) for r in found) == brute_runs(rows, 50)
    # of every window that repeats a kept run holds a copy
    texts = dict(rows)
    windows = lambda r: {tuple(w[s : s + 50]) for w in [texts[r.doc_id][r.start : r.end].translate(LOWERED).split()] for s in range(len(w) - 49)}
    kept = set().union(*(windows(r) for r in found if r.kept))
    once = Counter(w for r in found for w in windows(r))  # where two passages meet is no copy
    assert all(once[w] == 1 for r in found for w in windows(r) - kept)
    assert {r.keep_doc_id for r in found if r.doc_id in (5, None)} == {None}
    # copies of one passage are one cluster
    alone = [r for r in found if r.doc_id == 903]
    holding = [r for r in found if " ".join(passages[0]) in " ".join(texts[r.doc_id][r.start : r.end].translate(LOWERED).split())]
    assert len(holding) > 2 and {r.cluster_id for r in holding} == {alone[0].cluster_id}
    assert runs_of(frame(spark, [])).count() == 0


def test_every_passage_is_found_in_all_of_its_documents(spark):
    """Alone in a line once, within longer lines twice."""
    draw = random.Random(6)
    p = " ".join(words(draw, 60))
    rows = [(1, f"{' '.join(words(draw, 30))} {p} {' '.join(words(draw, 40))}"), (2, f"x\n{p}\ny"), (3, f"{p} {' '.join(words(draw, 25))}")]
    rows += [(4, " ".join(words(draw, 200)))]
    found = paragraph_dedup.repeated_paragraphs(frame(spark, rows)).collect()
    assert {(r.doc_id, r.unit, r.kept) for r in found} == {(1, "run", True), (2, "run", False), (3, "run", False)}


def test_near_paragraphs_of_rows_without_an_id(spark):
    draw = random.Random(7)
    p = words(draw, 70)
    near = [*p[:35], "changed", *p[36:]]
    rows = [(None, " ".join(p)), (5, "one\n" + " ".join(near)), (5, " ".join(words(draw, 60)))]
    found = paragraph_dedup.repeated_lines(frame(spark, rows)).collect()
    assert {(r.doc_id, r.kept) for r in found} == {(None, True), (5, False)}


@pytest.mark.parametrize("k", [1, 2, 5, 16, 50])
def test_window_hashes_depend_on_their_words_alone(k):
    h = np.random.default_rng(1).integers(0, 1 << 63, 120).astype(np.uint64)
    found = window_hashes(h, k)
    assert len(np.unique(found)) == len(found) == 121 - k
    assert (window_hashes(np.concatenate([h[7:], h]), k)[: len(found) - 7] == found[7:]).all()


def test_many_sets_at_once_are_those_one_by_one():
    draw = random.Random(2)
    texts = [" ".join(draw.choices("abcd", k=n)) for n in (1, 2, 3, 4, 5, 6, 9, 40, 200)] + ["a " * 50]
    counts = np.array([len(t.split()) for t in texts])
    hashes = shingles.hash_words(shingles.words(" ".join(texts)))
    tokens, starts = shingles.shingle_sets(hashes, counts, 5)
    each = np.split(tokens, starts[1:])
    assert all((a == shingles.shingle_set(t, 5)).all() for a, t in zip(each, texts, strict=True))
    f1, f2 = jaccard_join.many_prints(tokens, starts)
    assert [jaccard_join.set_prints(e) for e in each] == list(zip(f1.tolist(), f2.tolist(), strict=True))


def test_windows_cover_every_run():
    draw = np.random.default_rng(3)
    for _ in range(200):
        spans = draw.integers(1, 40, draw.integers(1, 12))
        found = paragraph_dedup.windows(spans, 50)
        assert all(spans[i:j].sum() >= 50 for i, j in found)
        covered = {at for i, j in found for at in range(i, j)}
        assert covered == (set(range(len(spans))) if spans.sum() >= 50 else set())


def test_sets_without_a_near_one_need_no_bands():
    for num in (50, 80, 85, 99):
        for n in range(1, 120):
            near = any(100 * min(n, m) >= num * max(n, m) for m in range(1, 400) if m != n)
            assert paragraph_dedup.has_near(n, Threshold(num, 100)) or not near


def test_bands_reach_the_recall():
    bands = paragraph_dedup.tune_bands(Threshold(80, 100))
    assert 1 - (1 - 0.8**paragraph_dedup.ROWS) ** bands >= paragraph_dedup.RECALL
    draw, hits = np.random.default_rng(1), 0
    for _ in range(300):
        base = draw.integers(0, 1 << 63, 90, np.uint64)
        other = np.concatenate([base[10:], draw.integers(0, 1 << 63, 10, np.uint64)])  # 80 of 100
        hits += bool(np.intersect1d(*(paragraph_dedup.band_keys(t, np.array([0]), bands) for t in (base, other))).size)
    assert hits >= 297


def test_a_pair_of_many_buckets_comes_from_few(spark, monkeypatch):
    """Two sets that are close but not linked, in forty buckets together and in some others alone."""
    words = np.random.default_rng(4).integers(1, 1 << 62, 100).astype(np.uint64)
    rows = [(n, len(t), t.view(np.int64).tolist(), bytearray(jaccard_join.parity_sketch(t).tobytes())) for n, t in ((1, words[:92]), (2, words[8:]))]
    sets = spark.createDataFrame(rows, "node long, n long, tokens array<long>, sketch binary")
    met = [(k, n, n) for k in range(40) for n in (1, 2)] + [(k, k % 2 + 1, k % 2 + 1) for k in range(100, 104)]
    members = spark.createDataFrame(met, "key long, node long, component long")
    monkeypatch.setattr(type(members), "distinct", lambda self: self)
    found = jaccard_join._block_pairs(members, sets, Threshold(80, 100), False).collect()
    assert {(r.a, r.b) for r in found} == {(1, 2)} and len(found) == 1


@pytest.mark.parametrize("pairs, most", [(1, 1), (6, 4)])
def test_few_steps_link_a_bucket(spark, monkeypatch, pairs, most):
    """Pairs of near copies in one bucket: each step is tens of stages, so there must be few, and none when all is linked."""
    draw = np.random.default_rng(5)
    rows, members = [], []
    for i in range(pairs):
        words = draw.integers(1, 1 << 62, 105).astype(np.uint64)
        for node, t in ((2 * i, words[:100]), (2 * i + 1, words[5:])):
            rows.append((node, len(t), t.view(np.int64).tolist(), bytearray(jaccard_join.parity_sketch(t).tobytes())))
            members.append((7, node))
    sets = spark.createDataFrame(rows, "node long, n long, tokens array<long>, sketch binary")
    verify, calls = jaccard_join.verify, []
    monkeypatch.setattr(jaccard_join, "verify", lambda *a: (calls.append(1), verify(*a))[1])
    buckets = spark.createDataFrame(members, "key long, node long")
    found = jaccard_join.link_buckets(buckets, sets, Threshold(80, 100)).collect()
    assert {(min(r), max(r)) for r in found} == {(2 * i, 2 * i + 1) for i in range(pairs)}
    assert len(calls) <= most
