from __future__ import annotations

import base64
import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from propgraph.llm import byte_bpe
from propgraph.llm.byte_bpe import ByteEncoder
from propgraph.llm.token_counts import PieceMerger, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LISTED = [
    "",
    " ",
    "\n",
    "a",
    "  two  spaces \n\n end ",
    "<s>x</s> <0x0A> <|endoftext|>",
    "日本語 テキスト ｘ é é \x00\x01",
    "😀😀a" * 20,
    "x" * 3000,
    "ab" * 2000 + " " * 50,
    " ▁▁ \t\r\n x",
    "snake_case² (foo_bar).baz, it's we'll they've 'RE",
    "don't stop " * 3000,
]
MIXED = st.text(alphabet=st.one_of(st.sampled_from("ab \n\té日😀._-'(strevl"), st.characters(exclude_categories=["Cs"])))


@pytest.fixture(scope="module")
def pieces():
    return PieceMerger(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoders():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ByteEncoder(RANKS, public_tokenizers.PATTERN), library


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("text", LISTED)
def test_listed_texts(pieces, encoders, text):
    merger, processor = pieces
    assert merger.count(text) == len(processor.encode(text))
    encoder, library = encoders
    ids = encoder.encode(text)
    assert ids == packed(library.encode_ordinary(text))
    assert encoder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_any_text(pieces, encoders, text):
    merger, processor = pieces
    assert merger.count(text) == len(processor.encode(text))
    encoder, library = encoders
    assert encoder.encode(text) == packed(library.encode_ordinary(text))


def test_small_leaves_give_the_same(encoders, monkeypatch):
    _, library = encoders
    for name, size in (("LEAF_CHARS", 7), ("LEAF_IDS", 3), ("LEAF_BYTES", 1)):
        monkeypatch.setattr(byte_bpe, name, size)
    encoder, draw = ByteEncoder(RANKS, public_tokenizers.PATTERN), random.Random(3)
    for text in [*LISTED, *("".join(draw.choices("ab \n'restvm!é", k=60)) for _ in range(500))]:
        ids = encoder.encode(text)
        assert ids == packed(library.encode_ordinary(text))
        assert encoder.decode(ids) == text.encode()


ROWS = [(1, "two words"), (1, "two words"), (None, "a"), (2, None), (3, ""), (4, "word " * 40_000)]


def test_counts_of_rows(spark, pieces):
    df = spark.createDataFrame([(*r, 7) for r in ROWS], "doc_id long, text string, N_BYTES int")
    with pytest.raises(ValueError, match="n_bytes"):
        count_tokens(df, MODEL)
    found = count_tokens(df, MODEL, prefix="c_").collect()
    want = sorted((r[0] or -1, len((r[1] or "").encode()), pieces[0].count(r[1] or "")) for r in ROWS)
    assert sorted((r.doc_id or -1, r.c_n_bytes, r.c_n_tokens) for r in found) == want
    assert {r.c_over_limit for r in found if r.doc_id == 4} == {True}
    assert count_tokens(df.limit(0).drop("N_BYTES"), MODEL).count() == 0


def test_digests_of_rows(spark, encoders):
    df = spark.createDataFrame([(*r, b"x") for r in ROWS], "doc_id long, text string, ids binary")
    found = byte_bpe.digests(df, RANKS, public_tokenizers.PATTERN).collect()
    want = []
    for doc_id, text in ROWS:
        ids = encoders[1].encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (packed(ids), (text or "").encode())]
        want.append((doc_id or -1, len(ids), *sha))
    assert sorted((r[0] or -1, *r[1:]) for r in found) == sorted(want)
    with pytest.raises(ValueError, match="ids"):
        byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert byte_bpe.digests(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
