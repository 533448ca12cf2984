"""Periodic runs of words (operator 13).

The Lyndon array of a text, the length of the longest Lyndon word that starts at each word, comes from the first phase of
Baier's suffix sorter: words are grouped, groups are taken from the greatest down, and each splits off, from the groups
of the words before its members, those that its own prefix continues. The final groups are the words' Lyndon prefixes.
Every run has a root that is the longest Lyndon word at its place under the order of the words or under the reverse
one. So the places' Lyndon words are extended to both sides as far as words repeat at their distance, and those that
reach twice their length are the runs.

A word of a run of LEAST words or more lies in a stretch of HALF words that occurs again, so what no such stretch covers
is left out before; the stretches that remain are searched one by one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hourline.llm.common import add_columns
from hourline.llm.wordnames import WORD, number_words, repeated

LEAST, HALF = 12, 6


def lyndon_array(symbols: np.ndarray) -> list[int]:
    """Length of the longest Lyndon word at each place, by grouping alone (a prefix is less than what it begins).

    A group is a range of ``order``, named by its start; ``end`` is where the group's range ends, ``length`` that of the
    prefix its members share. Groups above the one at hand are final.
    """
    n = len(symbols)
    sorted_places = np.argsort(symbols, kind="stable")
    ranked = symbols[sorted_places]
    firsts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(firsts, n))
    where = np.empty(n, np.int64)
    where[sorted_places] = np.arange(n)
    of = np.empty(n, np.int64)
    of[sorted_places] = np.repeat(firsts, sizes)
    order, where, group = sorted_places.tolist(), where.tolist(), of.tolist()
    end, length, before = [0] * n, [1] * n, [-1] * n
    for start, size in zip(firsts.tolist(), sizes.tolist()):
        end[start] = start + size
    top = n
    while top:
        g = group[order[top - 1]]
        own = length[g]
        met: dict[int, int] = {}
        for i in sorted(order[g:top]) if top - g > 1 else order[g:top]:
            p = i - 1
            while p >= 0 and group[p] > g:
                p = before[p]
            if p >= 0 and group[p] == g:
                p = before[p]
            before[i] = p
            if p >= 0:
                met[p] = met.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, k in met.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            cut: dict[int, int] = {}
            for p in by_count[k]:
                old = group[p]
                cut.setdefault(old, end[old])
                end[old] = last = end[old] - 1
                at, other = where[p], order[last]
                order[at], order[last] = other, p
                where[other], where[p] = at, last
            for old, stop in cut.items():
                new = end[old]
                if new == old:
                    length[old] += k * own
                    end[old] = stop
                    continue
                end[new], length[new] = stop, length[old] + k * own
                for at in range(new, stop):
                    group[order[at]] = new
        top = g
    return [length[g] for g in group]


def _same(data: bytes, a: int, b: int, most: int) -> int:
    """How many of the ``most`` words from ``a`` and from ``b`` on are equal; words are four bytes."""
    done, step = 0, 8
    while done < most:
        step = min(step, most - done)
        if data[4 * (a + done) : 4 * (a + done + step)] == data[4 * (b + done) : 4 * (b + done + step)]:
            done += step
            step *= 2
        elif step == 1:
            break
        else:
            most, step = done + step - 1, step // 2
    return done


def runs_of(symbols: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``least`` words or more, by start, then period."""
    n = len(symbols)
    if n < 2:
        return []
    ahead, back = symbols.astype("<u4").tobytes(), symbols[::-1].astype("<u4").tobytes()
    found: set[tuple[int, int, int]] = set()
    places = np.arange(n)
    for order in (symbols, symbols.max() - symbols):
        root = np.array(lyndon_array(order))
        behind = places + root
        right = symbols[np.minimum(behind, n - 1)] == symbols
        right &= behind < n
        left = symbols[behind - 1] == symbols[places - 1]
        left[0] = False
        known: dict[int, int] = {}
        for i in np.flatnonzero(left | right).tolist():
            q = int(root[i])
            if i + q <= known.get(q, 0):
                continue
            j = i + q
            start = i - _same(back, n - i, n - j, i)
            stop = j + _same(ahead, i, j, n - j)
            if stop - start >= 2 * q:
                known[q] = stop
                if stop - start >= least:
                    found.add((start, stop - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic(words: list[str]) -> list[tuple[int, int, int]]:
    """The runs of a text's words: maximal stretches of LEAST words or more, twice their smallest period at least."""
    ids = number_words(words)
    inside = repeated(ids, HALF)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    found = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if b - a >= LEAST:
            part = np.unique(ids[a:b], return_inverse=True)[1]
            found += [(a + start, length, q) for start, length, q in runs_of(part)]
    return found


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run repeats, joined by blanks; of each run its first period stays, unless another run drops it."""
    if not runs:
        return " ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return " ".join([words[i] for i in np.flatnonzero(kept).tolist()])


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
FIELDS = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]


def _work(texts: list[str | None]) -> tuple[list, list]:
    found, short = [], []
    for t in texts:
        words = WORD.findall(t) if t else []
        runs = periodic(words)
        found.append([dict(zip(RUN.names, r)) for r in runs])
        short.append(collapse(words, runs))
    return found, short


def find_runs(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns, ``runs`` of each whole text by start and period, and ``collapsed``, its words without repeats.

    Null and empty texts have no run and collapse to an empty text. Input columns that have such a name are replaced.
    """
    return add_columns(docs, text, FIELDS, lambda: _work, keep_text)
