"""Sets of word shingles as 64-bit hashes, made per whole text inside tasks.

Two different shingles of one comparison share a hash with probability 2**-64 each.
"""

from __future__ import annotations

import numpy as np
import xxhash

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well spread function of each hash."""
    h = h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(33))) * _B
    h = (h ^ (h >> np.uint64(29))) * _A
    return h ^ (h >> np.uint64(32))


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().translate(ASCII_LOWER).split()


def hash_words(found: list[bytes]) -> np.ndarray:
    # a word is hashed anew each time: remembering hashes takes twice as long
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each window of ``k`` words; ``k`` takes part, so windows of two lengths differ."""
    out = np.full(len(hashes) - k + 1, k, np.uint64)
    for j in range(k):
        out = mix(out * _A + hashes[j : len(hashes) - k + 1 + j])
    return out


def shingle_set(text: str, k: int) -> np.ndarray:
    """The distinct shingles of ``k`` words, sorted; a shorter text is one shingle, one without words none."""
    hashes = hash_words(words(text))
    if not len(hashes):
        return hashes
    return np.unique(windows(hashes, min(k, len(hashes))))


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``shingle_set`` of each of many texts at once: all tokens one after another, and where each set starts.

    ``hashes`` has the words of all texts in order, ``counts`` (none is 0) how many each has.
    """
    begins = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes))
    left = begins[text] + counts[text] - place  # words from here to the end
    tokens, of = [], []
    for size in range(1, k + 1):
        at = place[left >= k] if size == k else begins[counts == size]
        if len(at):
            out = np.full(len(at), size, np.uint64)
            for j in range(size):
                out = mix(out * _A + hashes[at + j])
            tokens.append(out)
            of.append(text[at])
    tokens, of = np.concatenate(tokens), np.concatenate(of)
    # by text, then token; small numbers are sorted in linear time
    order = np.argsort(tokens)
    order = order[np.argsort(of[order].astype(np.min_scalar_type(len(counts))), kind="stable")]
    tokens, of = tokens[order], of[order]
    new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])])
    tokens, of = tokens[new], of[new]
    return tokens, np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
