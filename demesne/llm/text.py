"""Words and word shingles, vectorised over a batch of texts."""

from __future__ import annotations

import html
import re

import numpy as np
import pandas as pd

#: A tag of any length: a name or ! after the bracket, closed on the same line.
_TAG = re.compile(r"</?[A-Za-z!][^<>\n]*>")
_WORD = re.compile(r"[^\W_]+")
_SOFT = re.compile("­|​|﻿|-\n[>\\s]*(?=[a-z])")


def words(text: str | None) -> list[str]:
    """Lower-case words; mark-up, entities, punctuation and layout do not count."""
    if not text:
        return []
    if "<" in text or "&" in text:
        text = html.unescape(_TAG.sub(" ", text))
    return _WORD.findall(_SOFT.sub("", text).lower())


def hashed(tokens: list[str]) -> np.ndarray:
    if not tokens:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(tokens, dtype=object), categorize=True)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of a sequence of word hashes; a shorter sequence is one shingle."""
    if not len(h):
        return h
    k = min(k, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + (h[i : len(h) - k + 1 + i] ^ (h[i : len(h) - k + 1 + i] >> np.uint64(29)))
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xD6E8FEB86659FD93)
