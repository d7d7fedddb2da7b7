from __future__ import annotations

import random

import numpy as np
import pytest

from propgraph.llm import decontaminate
from propgraph.llm.decontaminate import SeedIndex, tile


def numbers(text):
    return np.array([ord(c) for c in text], np.uint64)


def test_tiles_do_not_overlap_and_take_the_longest_first():
    assert tile(numbers("abcdefgh"), numbers("xxabcdefghyy"), 3) == [(0, 2, 8)]
    assert tile(numbers("abcdefghij"), numbers("fghij--abcde"), 3) == [(0, 7, 5), (5, 0, 5)]
    assert tile(numbers("abcabcabc"), numbers("abc"), 3) == [(0, 0, 3)]
    assert tile(numbers("ab"), numbers("ab"), 3) == []
    assert sorted(tile(numbers("abcdXefgh"), numbers("efgh..abcd"), 4)) == [(0, 6, 4), (5, 0, 4)]


def brute(item, doc, least):
    """Greedy string tiling as it is defined: mark the longest match of free words, the first of equals, again and again."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] and free_i[i + n] and free_d[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return tiles
        free_i[i : i + n] = free_d[d : d + n] = [False] * n
        tiles.append((i, d, n))


@pytest.mark.parametrize("first", [3, 4, 32])
@pytest.mark.parametrize("letters", [2, 4, 9])
def test_tiling_equals_brute_force(monkeypatch, first, letters):
    monkeypatch.setattr(decontaminate, "FIRST_SEARCH", first)
    draw = random.Random(5)
    for _ in range(60):
        item = [draw.randrange(letters) for _ in range(draw.randrange(1, 30))]
        doc = [draw.randrange(letters) for _ in range(draw.randrange(1, 50))]
        at = draw.randrange(len(item))
        doc[5:5] = item[at:] + item[:at]
        assert tile(np.array(item, np.uint64), np.array(doc, np.uint64), 3) == brute(item, doc, 3)


def test_a_match_cut_by_a_tile_is_tried_before_shorter_ones():
    # 'fghijklmn' cuts 'abcdefgh'; what is left of that, 'abcde', goes before 'bcde'
    item, doc = numbers("abcdefghijklmn"), numbers("bcde.abcdefgh.fghijklmn")
    assert tile(item, doc, 3) == brute(item.tolist(), doc.tolist(), 3) == [(5, 14, 9), (0, 5, 5)]


def test_very_repetitive_words():
    assert sum(n for *_, n in tile(numbers("a" * 40), numbers("a" * 3000), 5)) == 40


ITEM = " ".join(f"i{n}" for n in range(24))
HALVES = ITEM.split()
ITEMS = [(0, ITEM), (1, "too short"), (2, None), (3, ""), (0, " ".join(f"k{n}" for n in range(12)))]
DOCS = [
    (1, f"before, {ITEM.upper()}! after"),
    (2, " ".join(HALVES[12:]) + " and between " + " ".join(HALVES[:12])),
    (3, " ".join(HALVES[:10])),
    (4, "clean words only here"),
    (5, None),
    (6, ""),
    (None, ITEM),
    (7, "filler " * 60_000 + ITEM),
    (1, f"before, {ITEM.upper()}! after"),
    (8, " ".join(reversed(HALVES))),
    (9, "too short"),
]


@pytest.mark.parametrize("limit", [decontaminate.SEED_LIMIT, 0])
def test_leaks_by_both_ways(spark, limit):
    docs = spark.createDataFrame([(*r, 1, "s") for r in DOCS], "doc_id long, text string, item_id int, seed string")
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, doc_id string")
    found = decontaminate.leaks(docs, items, seed_limit=limit).collect()
    assert sorted((str(r.doc_id), r.item_id, r.coverage) for r in found) == sorted(
        (i, 0, 1.0) for i in ("1", "1", "2", "None", "7")
    )
    assert {len(r.tiles) for r in found if r.doc_id == 2} == {2}
    kept = decontaminate.clean(docs, items, seed_limit=limit)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8, 9]
    assert decontaminate.leaks(docs.limit(0), items, seed_limit=limit).count() == 0
    assert decontaminate.leaks(docs, items.limit(0), seed_limit=limit).count() == 0


def test_the_bound_counts_bytes(spark):
    def fits(texts, limit):
        return decontaminate._fits(spark.createDataFrame([(t,) for t in texts], "text string"), limit)

    joined = ["\u2014".join(["w"] * 300)]  # 300 words without ASCII white space or marks
    assert not fits(joined, 300) and fits(joined, 300 + 299 * 3 + 16)
    assert not fits([""] * 100, 100) and fits([], 0)


def test_a_column_named_like_the_key_stays(spark):
    docs = spark.createDataFrame([(1, ITEM, "a"), (2, "clean", "b")], "doc_id long, text string, _text_key string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    kept = decontaminate.clean(docs, items, seed_limit=0)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", "b")]


def test_an_index_without_seeds():
    assert SeedIndex.of([], 5).leaks("a b c d e f", 5, 0.5) == []
