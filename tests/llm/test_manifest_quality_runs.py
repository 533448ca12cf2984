"""Merkle manifest, quality rules and periodic runs: brute force, proofs that must fail, odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourline.llm import merkle, periods, quality, wordnames
from hourline.llm.queries import QUERIES
from tests.llm.test_cases import LONG, ODD, none, odd  # noqa: F401
from tests.oracle import connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# Merkle manifest


def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def plain_siblings(levels, i):
    out = ""
    for level in levels[:-1]:
        run = i // 16 * 16
        out += "".join(level[run:i] + level[i + 1 : run + 16])
        i //= 16
    return out


def plain_manifest(rows):
    """{(source, position): (leaf, subroot, root, sha of the siblings)} of rows (doc_id, source, leaf)."""
    key = lambda v: (v is not None, v if v is not None else 0)
    groups = {}
    for d, s, leaf in sorted(rows, key=lambda r: ((r[1] is not None, (r[1] or "").encode()), key(r[0]), r[2])):
        groups.setdefault(s, []).append((d, leaf))
    levels = [plain_levels([leaf for _, leaf in g]) for g in groups.values()]
    top = plain_levels([x[-1][0] for x in levels])
    return sorted(
        (repr(d), leaf, own[-1][0], top[-1][0], sha(plain_siblings(own, i) + plain_siblings(top, g)))
        for g, (own, rows) in enumerate(zip(levels, groups.values())) for i, (d, leaf) in enumerate(rows)
    )


def proved(docs, part=merkle.PART):
    made = merkle.build(docs, ["doc_id", "source", "text"], carry=[F.col("doc_id").alias("place")], part=part)
    found = merkle.prove(made).select("carried.place", "digest", "subroot", "left", "right", merkle.fold(F.col("digest"), F.col("left"), F.col("right")).alias("folded"), merkle.siblings_digest(F.col("left"), F.col("right")).alias("proof"))
    rows = found.collect()
    assert all(r.folded == made.root for r in rows)
    return sorted((repr(r.place), r.digest, r.subroot, made.root, r.proof) for r in rows), made


@pytest.mark.parametrize("part", [1024, 7])
@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 2], [1] * 40, [300, 5, 16, 33]])
def test_manifest_by_brute_force(spark, sizes, part):
    rows = [(i * 7 % 1000 + 1000 * g, f"ü{g}" if g else None, f"t{i}") for g, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert proved(docs, part)[0] == plain_manifest([(d, s, plain_leaf([d, s, t])) for d, s, t in rows])


def test_manifest_of_odd_rows(odd, none):  # noqa: F811
    found, _ = proved(odd)
    rows = odd.select("doc_id", "source", "text").collect()
    assert found == plain_manifest([(r.doc_id, r.source, plain_leaf([r.doc_id, r.source, r.text])) for r in rows])
    empty, made = proved(none)
    assert empty == [] and made.root is None and made.trees == 0


def test_multiproof_is_least_and_serves_subsets(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 600, "a").otherwise("b").alias("source"), F.col("id").cast("string").alias("text"))
    made = merkle.build(docs, ["doc_id", "source", "text"])
    wanted = made.leaves.where("carried.doc_id in (0, 1, 17, 700)")
    found = merkle.prove(made, wanted).select("carried.doc_id", merkle.fold(F.col("digest"), F.col("left"), F.col("right")).alias("folded"))
    assert {tuple(r) for r in found.collect()} == {(d, made.root) for d in (0, 1, 17, 700)}
    # 0, 1 and 17 of 600: 14 and 15 leaves beside them, then 14 of the 16 nodes above, then two of three.
    assert [(level, len(p)) for level, p in merkle.missing(np.array([0, 1, 17]), 600)] == [(0, 29), (1, 14), (2, 2)]
    # All leaves of a tree need nothing.
    assert [len(p) for _, p in merkle.missing(np.arange(600), 600)] == [0, 0, 0]


def test_tampering_is_found(spark):
    docs = spark.createDataFrame([(i, "s", f"Text {i}") for i in range(50)], "doc_id long, source string, text string")
    made = merkle.build(docs, ["doc_id", "source", "text"])
    lied = merkle.leaf_digest(F.col("carried.doc_id"), F.lit("s"), F.concat(F.lit("text "), F.col("carried.doc_id").cast("string")))
    found = merkle.prove(made).select(merkle.fold(lied, F.col("left"), F.col("right")).alias("folded"))
    assert found.where(F.col("folded") == made.root).count() == 0 and found.distinct().count() == 50


# Quality rules


@pytest.mark.parametrize(
    "line,fault",
    [
        ("Home | News | About | Contact", "navigation"), ("a > b > c", "navigation"), ("By using it you accept our Privacy Policy.", "boilerplate"),
        ("no sentence here", "punctuation"), ("The%%% anen*** of### it.", "punctuation"), ("A sentence.", None), ('He said "no!"', None), ("End. and a", None),
        ("Price | value is 3 of 4 in the whole of the long and winding line here, as it was.", None), ("x.y", "punctuation"), ("好。", None),
    ],
)
def test_line_rules(line, fault):
    assert quality.line_fault(line, WORD.findall(line)) == fault


def test_long_lines_may_name_a_policy():
    line = "word " * 30 + "privacy policy."
    assert quality.line_fault(line, WORD.findall(line)) is None


def test_lost_text_rejects():
    prose = " ".join(f"w{i}" for i in range(20)) + "."
    lost = lambda n: prose + "\n" + "|" * n
    keys = [f.name for f in quality.FIELDS]
    judged = lambda t: dict(zip(keys, quality.judge(t)))
    chars = len("".join(WORD.findall(prose)))
    most = max(n for n in range(100) if 100 * n <= 30 * (chars + n))
    assert judged(lost(most))["kept"] and judged(lost(most))["cleaned"] == prose and not judged(lost(most + 1))["kept"]
    assert judged("a b c d e f g h i.")["base_failed"] and not judged("a b c d e f g h i j.")["base_failed"]
    assert judged("one. two.\n\none. two.\n \n ")["n_dup_lines"] == 1


def plain_repeats(words, width):
    covered = set()
    windows = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + width))
    return covered


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.integers(4, 8))
def test_repeated_stretches(words, width):
    assert set(np.flatnonzero(wordnames.repeated(wordnames.number_words(words), width))) == plain_repeats(words, width)


def test_quality_of_odd_rows(odd, none):  # noqa: F811
    found = quality.clean_lines(odd).toPandas()
    assert len(found) == len(ODD) and found.n_words.tolist() == [len(WORD.findall(r[1] or "")) for r in ODD]
    assert found.base_failed[found.n_words < 10].all() and not found.kept[found.base_failed].any()
    assert found.cleaned.notna().all() and "host" in found.columns and found.n_words.max() == len(WORD.findall(LONG))
    assert quality.clean_lines(none).count() == 0


# Periodic runs


def plain_lyndon(x):
    return [next((j for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x)) - i for i in range(len(x))]


def smallest_period(w):
    fail, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def plain_runs(x, least):
    x, n, out = np.asarray(x), len(x), []
    for q in range(1, n // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], x[:-q] == x[q:], [False]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a + q >= max(least, 2 * q) and smallest_period(x[a : b + q].tolist()) == q:
                out.append((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


symbols = st.one_of(
    st.lists(st.integers(0, 2), min_size=1, max_size=50),
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 60), st.lists(st.integers(0, 3), max_size=9)).map(lambda t: (t[0] * 60)[: t[1]] + t[2]),
)


@settings(max_examples=500, deadline=None)
@given(symbols)
def test_lyndon_arrays_and_runs(x):
    a = np.array(x)
    assert periods.lyndon_array(a) == plain_lyndon(x)
    assert periods.lyndon_array(a.max() - a) == plain_lyndon([-v for v in x])
    assert periods.runs_of(a, 2) == plain_runs(x, 2)
    assert periods.periodic([str(v) for v in x]) == plain_runs(x, 12)


def test_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert periods.runs_of(np.array(b), 2) == plain_runs(b, 2)


def test_runs_of_odd_rows(spark, odd, none):  # noqa: F811
    found = periods.find_runs(odd, keep_text=False).select("doc_id", "runs", "collapsed").collect()
    assert len(found) == len(ODD) and all(r.collapsed is not None for r in found)
    texts = [("a b c " * 5 + "x " + "q " * 12, [(0, 15, 3), (16, 12, 1)], "a b c x q"), ("a " * 11, [], " ".join("a" * 11)), ("a b c d e f g a b c d e f g", [(0, 14, 7)], "a b c d e f g"), (None, [], "")]
    made = periods.find_runs(spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(texts)], "runs long, text string")).collect()
    assert [([tuple(r) for r in x.runs], x.collapsed) for x in made] == [t[1:] for t in texts]
    assert periods.find_runs(none).count() == 0


def test_all_documents(spark):
    """The registered query over the whole table, against brute force with the documents altered in plain Python."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for d, text in connect(sf).execute("SELECT doc_id, text FROM documents").fetchall():
        w, h = WORD.findall(text or ""), zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        number = {x: i for i, x in enumerate(dict.fromkeys(w))}
        runs = plain_runs([number[x] for x in w], 12) if w else []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        head = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        want[d] = (len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    found = {r[0]: tuple(r[1:]) for r in QUERIES["op13_runs"][0](spark, sf).collect()}
    assert found == want
