from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from propgraph.llm import conversation_trie, list_rank

SCHEMA = "conv_id long, turn long, role string, text string, node int, p1 string, key string, total int"


def rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def brute_trie(rows):
    convs, members = rebuilt(rows), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, ids in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(ids) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(p))))
        up = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(p), str(up), len(ids), children[p], leaves[p], saved[p], digest))
    return sorted(out)


def found(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)
    got = conversation_trie.rebuilt_trie(df, **sizes)
    return sorted((r[0], r[1], str(r[2]), *r[3:8]) for r in got.collect())


def conversations():
    draw, rows = random.Random(2), []
    for c in [*range(0, 49), *range(100, 149), 51, 250, -5, -105, 1000]:
        for t in range(draw.choice([1, 2, 3, 4, 7, 10])):
            turn = t if draw.random() < 0.9 else None
            rows.append((c, turn, draw.choice(["u", "a", None]), draw.choice(["x", "yé😀", None, ""])))
    rows += [(3, 1, "u", "x"), (3, 1, "u", "x"), (None, 1, "u", "x")]  # repeated turns; no conversation
    rows += [(c, t, "u", "same") for c in range(300, 340) for t in range(6)]  # a hot group
    return rows + [(7777, i, "u", str(i % 3)) for i in range(120)]


@pytest.mark.parametrize("sizes", [{}, {"block": 150, "scan": 4}])
def test_trie_equals_brute_force(spark, conf, sizes):
    conf("spark.sql.shuffle.partitions", 5)
    rows = conversations()
    assert found(spark, rows, **sizes) == brute_trie(rows)


def test_small_tables(spark):
    assert found(spark, []) == []
    for rows in ([(1, None, None, None)], [(None, 1, "u", "x")], [(5, 2, "u", "b"), (5, 1, "u", "a")]):
        assert found(spark, rows) == brute_trie(rows)


def test_many_ids_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 20)
    rows = [(c, 0, "u", "hi") for c in range(1, 90)]
    assert found(spark, rows) == brute_trie(rows)


@pytest.mark.parametrize("shuffled", [False, True])
def test_prefix_sums(spark, shuffled):
    draw, n = random.Random(1), 900
    ids = list(range(n))
    if shuffled:
        draw.shuffle(ids)
    cuts = {199, 200, n - 1}  # three lists, one of them a single element
    rows = [(v, None if i in cuts else ids[i + 1], draw.randrange(9), i) for i, v in enumerate(ids)]
    df = spark.createDataFrame(rows, "id long, next long, w long, further long")
    got = {r.id: r.before_w for r in list_rank.prefix_sums(df, ["w"], block=250).collect()}
    want, sum_ = {}, 0
    for i, (v, _, w, _) in enumerate(rows):
        want[v] = sum_
        sum_ = 0 if i in cuts else sum_ + w
    assert got == want
    assert list_rank.prefix_sums(df.limit(0), ["w"]).count() == 0


def test_more_lists_than_a_block(spark):
    df = spark.range(40).selectExpr("id", "cast(null as long) AS next", "id AS w")
    assert {r.before_w for r in list_rank.prefix_sums(df, ["w"], block=10).collect()} == {0}


def test_a_cycle_is_an_error(spark):
    df = spark.createDataFrame([(0, 1, 1), (1, 0, 1)], "id long, next long, w long")
    with pytest.raises(Exception, match="cycle"):
        list_rank.prefix_sums(df, ["w"]).collect()
