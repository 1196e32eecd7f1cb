"""Hashed text features, computed with numpy over the code points of a slice of texts.

``subword_features`` gives whole words and the character n-grams inside them;
``word_features`` gives lower-cased alphanumeric words. Both return the text
number and the bucket of every feature occurrence.
"""

from __future__ import annotations

import numpy as np

BITS = 18
NGRAMS = (3, 4)
SLICE = 1 << 18           # bytes of text in one numpy pass: its work stays in the cache
_A = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)

_CODES = 1 << 16
_SPACE = np.array([chr(i).isspace() for i in range(_CODES)])
_ALNUM = np.array([chr(i).isalnum() for i in range(_CODES)])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * _A[1]
    return (h ^ (h >> np.uint32(13))) * _A[2]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each followed by a space and the first also
    preceded by one, and the number of the text that each belongs to."""
    chars = np.frombuffer((" " + "".join(t + " " for t in texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    lengths[0] += 1
    return chars, np.repeat(np.arange(len(texts), dtype=np.int32), lengths)


def _word_hashes(chars: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first character, hash) of every run of ``inside`` characters."""
    at = np.flatnonzero(inside)
    if not len(at):
        return at, np.zeros(0, np.uint32)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    run = np.repeat(np.arange(len(first)), np.diff(first, append=len(at)))
    place = (at - at[first][run]).astype(np.uint32)
    mixed = _mix(chars[at] * _A[0] + place * _A[4])
    return at[first], _mix(np.add.reduceat(mixed, first, dtype=np.uint32))


def subword_features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word, every character 3- and 4-gram of a word
    with its edges marked (the bounding space counts as a character), and one
    common bucket for each word that repeats the word before it."""
    if not texts:
        return np.zeros(0, np.int32), np.zeros(0, np.uint32)
    chars, text = _codes(texts)
    space = _SPACE[np.minimum(chars, _CODES - 1)]
    chars = np.where(space, np.uint32(32), chars)
    first, words = _word_hashes(chars, ~space)
    shift = np.uint32(32 - bits)
    again = np.flatnonzero((words[1:] == words[:-1]) & (text[first][1:] == text[first][:-1]))
    owners = [text[first], text[first][again]]
    buckets = [words >> shift, np.full(len(again), _A[3] >> shift)]
    held = np.concatenate([[0], np.cumsum(space, dtype=np.int32)])
    for n in NGRAMS:
        if len(chars) < n:
            continue
        m = len(chars) - n + 1
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h += chars[k:k + m] * _A[k]
        inner = held[n - 1:n - 1 + m] == held[1:1 + m]      # no space but at the edges
        owners.append(text[1:1 + m][inner])
        buckets.append(_mix(h[inner]) >> shift)
    return np.concatenate(owners), np.concatenate(buckets)


def word_features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs of the lower-cased alphanumeric words."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    chars, text = _codes([t.lower() for t in texts])
    first, words = _word_hashes(chars, _ALNUM[np.minimum(chars, _CODES - 1)])
    pairs = np.unique((text[first].astype(np.int64) << 32) | (words >> np.uint32(32 - bits)))
    return pairs >> 32, pairs & 0xFFFFFFFF
