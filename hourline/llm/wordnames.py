"""Words of a text, numbered, and exact names of its stretches of several words."""

from __future__ import annotations

import re

import numpy as np

from hourline.llm.common import WS

WORD = re.compile(f"[^{WS}]+")


def number_words(words: list[str]) -> np.ndarray:
    """A number for every word, equal for equal words, from 0 in order of first sight."""
    seen = dict.fromkeys(words)
    for i, w in enumerate(seen):
        seen[w] = i
    return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def repeated(ids: np.ndarray, width: int) -> np.ndarray:
    """True at every word that lies in a stretch of ``width`` words (4 to 8) that the text holds twice or more.

    Names of two words, then four, then ``width`` are ranks of pairs of shorter names, so equal names are equal words.
    """
    n = len(ids)
    covered = np.zeros(n, bool)
    if n <= width:
        return covered
    two = _pair(ids[:-1], ids[1:])
    if two.max() == len(two) - 1:
        return covered
    four = _pair(two[:-2], two[2:])
    if four.max() == len(four) - 1:
        return covered
    last = {4: None, 5: ids, 6: two}.get(width, four)
    names = four if last is None else _pair(four[: n - width + 1], last[width - (1 if width == 5 else 2 if width == 6 else 4) :])
    again = np.flatnonzero(np.bincount(names)[names] > 1)
    if len(again):
        edges = np.zeros(n + 1, np.int64)
        np.add.at(edges, again, 1)
        np.add.at(edges, again + width, -1)
        covered = np.cumsum(edges[:-1]) > 0
    return covered
