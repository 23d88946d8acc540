"""Hashed n-grams of a text: characters, words, and the repetition within word triples."""

from __future__ import annotations

import zlib

import numpy as np

from rolepulse.llm.texts import words

#: Buckets of the n-gram hash.
BITS = 16
BUCKETS = 1 << BITS


def _bucket(code: np.ndarray, salt: int) -> np.ndarray:
    return (code * np.uint32(2654435761) + np.uint32(salt)) * np.uint32(2246822519) >> np.uint32(32 - BITS)


def grams(text: bytes | None) -> np.ndarray:
    """Buckets of all byte 3-grams and 4-grams, words, and word triples of the whole text.

    A triple is hashed with its words replaced by their order of appearance, so that what
    it shows is repetition ("a a b"), whatever the words are.
    """
    if not text:
        return np.zeros(0, np.uint32)
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    parts = []
    if len(a) >= 3:
        three = a[:-2] | a[1:-1] << 8 | a[2:] << 16
        parts.append(_bucket(three, 3))
        if len(a) >= 4:
            parts.append(_bucket(three[:-1] | a[3:] << 24, 4))
    found = words(text)
    if found:
        w = np.fromiter(map(zlib.crc32, found), np.uint32, len(found))
        parts.append(_bucket(w, 1))
        if len(w) >= 3:
            same = (w[1:-1] == w[:-2]).astype(np.uint32) | (w[2:] == w[1:-1]).astype(np.uint32) << 1
            parts.append(_bucket(same | (w[2:] == w[:-2]).astype(np.uint32) << 2, 5))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
