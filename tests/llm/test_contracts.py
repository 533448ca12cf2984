"""Registered queries on whole tables against brute force."""

import functools
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from hourline.llm import simhash
from hourline.llm.queries import QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def docs(con):
    return {d: (t or "", lang) for d, t, lang in con.execute("SELECT doc_id, text, lang FROM documents").fetchall()}


def rows(spark, name):
    return QUERIES[name][0](spark, SF).toPandas()


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_sql_twins(spark, con, name):
    assert differences(spark, con, QUERIES[name][0], QUERIES[name][1], SF) is None


def test_language(spark, docs):
    found = rows(spark, "op1_language")
    assert sorted(found.doc_id) == sorted(docs)
    assert (found.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in found.doc_id]).all()
    assert found.score.between(0, 1).all() and set(found.lang_pred) <= {x for _, x in docs.values() if x} | {"und"}
    right = np.array([p == docs[d][1] for d, p in zip(found.doc_id, found.lang_pred)])
    assert right[found.held_out].mean() > 0.97


def test_language_by_brute_force(spark, docs, monkeypatch):
    """Without its bounds, the model, learned from the whole table, scores as plain counting does (every seventh document)."""
    from hourline.llm import language

    monkeypatch.setattr(language, "WORDS", 1 << 40)
    monkeypatch.setattr(language, "GRAMS", 1 << 40)
    found = rows(spark, "op1_language")
    learned = [(d, t, x) for d, (t, x) in docs.items() if zlib.crc32(str(d).encode()) % 3 != 1 and x]
    names = sorted({x for _, _, x in learned})
    words, grams = {x: Counter() for x in names}, {(o, x): Counter() for o in range(1, 5) for x in names}
    for _, t, x in learned:
        words[x].update(re.findall(r"[^\W\d_]+", t.lower()))
    pieces = lambda w, o: list(w) if o == 1 else [f"<{w}>"[i : i + o] for i in range(len(w) + 3 - o)]
    for x in names:
        for w, n in words[x].items():
            for o in range(1, 5):
                for g in pieces(w, o):
                    grams[o, x][g] += n
    keys = {o: set().union(*(grams[o, x] for x in names)) for o in range(1, 5)}
    vocabulary = set().union(*words.values())
    logs = lambda counts, size, key: math.log((counts[key] + 0.5) / (sum(counts.values()) + 0.5 * size))
    cached = functools.cache(lambda w: [sum_of(w, x) for x in names])

    def sum_of(w, x):
        if w in vocabulary:
            return logs(words[x], len(vocabulary), w)
        for o in (4, 3, 2, 1):
            known = [g for g in pieces(w, o) if g in keys[o]]
            if known:
                return sum(logs(grams[o, x], len(keys[o]), g) for g in known) / len(known)
        return 0.0

    totals = Counter(x for _, _, x in learned)
    for r in found[::7].itertuples():
        text = docs[r.doc_id][0]
        score = np.array([math.log(totals[x] / len(learned)) for x in names])
        for w, n in Counter(re.findall(r"[^\W\d_]+", text.lower())).items():
            score += n * np.array(cached(w))
        if not any(map(str.isalpha, text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        assert r.lang_pred == names[int(score.argmax())] and r.score == pytest.approx(1 / np.exp(score - score.max()).sum(), abs=1e-4)


def ids_of(docs, name, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    order = sorted(docs)
    coded = t.encode_batch([docs[d][0] for d in order], add_special_tokens=False)
    return {d: np.array(e.ids + end, "<u4") for d, e in zip(order, coded)}, t


def test_records(spark, docs):
    want, _ = ids_of(docs, "word_bpe_49k.json", [2])
    start, expected = 0, {}
    for d in sorted(want):
        expected[d] = (start, len(want[d]), zlib.crc32(want[d].tobytes()))
        start += len(want[d])
    found = rows(spark, "op2_records")
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found.itertuples()} == expected and len(found) == len(docs)


def test_packing(spark, docs):
    want, _ = ids_of(docs, "byte_bpe_50k.json", [0])
    found = rows(spark, "op3_packing")
    check_pieces(found, want)


def check_pieces(found, want):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in found.itertuples():
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for d, ids in want.items():
        at = 0
        for start, length in sorted(by_doc[d]):
            assert start == at
            at += length
        assert at == len(ids)
    total = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
        total += at
    assert total / (1024 * len(by_seq)) > 0.97


def test_bpe(spark, docs):
    want, t = ids_of(docs, "byte_bpe_50k.json", [])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = {d: (len(x), sha(",".join(map(str, x.tolist()))), sha(t.decode(x.tolist(), skip_special_tokens=False))) for d, x in want.items()}
    found = rows(spark, "op6_bpe")
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.itertuples()} == expected


def union(pairs, nodes):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def test_neighbours(spark, con):
    table = con.execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    n, pairs = defaultdict(int), []
    for label in {x[2] for x in table if x[2] is not None}:
        own = [(i, v) for i, v, x in table if x == label]
        m = np.array([v for _, v in own], float)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(m @ m.T >= 0.98, 1))):
            a, b = own[a][0], own[b][0]
            n[a], n[b] = n[a] + 1, n[b] + 1
            pairs.append((a, b))
    root = union(pairs, [x[0] for x in table])
    found = rows(spark, "op7_neighbours")
    assert sorted(found.vec_id) == sorted(root)
    assert (found.kept == (found.vec_id == found.component_id)).all()
    assert all(r.n_links <= n[r.vec_id] for r in found.itertuples())
    assert found.n_links.sum() >= 0.97 * sum(n.values())
    assert np.mean([r.component_id == root[r.vec_id] for r in found.itertuples()]) > 0.97


def plain_fingerprint(text):
    words = bytes(text, "utf-8").lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def linked(fps):
    ids = sorted(fps)
    x = np.array([fps[i] for i in ids], np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    return union([(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)))], ids)


def test_simhash(spark, docs):
    fps = {d: simhash.fingerprint(t) for d, (t, _) in docs.items()}
    for d in list(fps)[:40]:
        assert fps[d] == plain_fingerprint(docs[d][0])
    root = linked(fps)
    found = rows(spark, "op9_simhash")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found.itertuples()} == {d: (f"{fps[d]:016x}", root[d]) for d in docs}
    assert len(set(root.values())) < len(root)


def test_toxicity(spark, con, docs):
    found = rows(spark, "op10_toxicity")
    assert sorted(found.doc_id) == sorted(docs) and found.score.between(0, 1).all()
    assert (found.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in found.doc_id]).all()
    assert (found.predicted == (found.score >= 0.5)).all()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op10_toxicity"][0](spark, sf).where("held_out").toPandas()
    words = "idiot|moron|stupid|loser|scum|trash|worthless|pathetic|clown"
    labels = duckdb.sql(f"SELECT doc_id, toxic, regexp_matches(lower(text), '{words}') AS said FROM '{sf}/documents.parquet' JOIN '{sf}/labels.parquet' USING (doc_id)").df()
    both = found.merge(labels, on="doc_id")
    said = both[both.said]
    assert len(said) > 20 and (said.predicted == 1).mean() > 0.9
    assert (both[(both.toxic == 0) & ~both.said].predicted == 0).mean() > 0.97


def test_pipeline(spark, con, docs):
    """Every stage against brute force on what the stage before it kept."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {d: t for d, (t, _) in docs.items()}
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, given, SF)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}-{hashlib.sha256(str(id(out)).encode()).hexdigest()}"
        out.write.parquet(path)
        given = spark.read.parquet(path)
        kept[name] = {r.doc_id: r for r in given.collect()}
    assert set(kept["language"]) == {d for d, t in texts.items() if any(c.isalpha() for c in t)}
    predicted = rows(spark, "op10_toxicity").set_index("doc_id").predicted
    assert set(kept["toxicity"]) == {d for d in kept["language"] if not predicted[d]}
    before, after = kept["toxicity"], kept["line_dedup"]
    total, held = defaultdict(int), defaultdict(int)
    for r in before.values():
        total[r.source] += 1
        for line in {x.strip(" ") for x in r.text.split("\n")} - {""}:
            held[r.source, line] += 1
    bad = {k for k, n in held.items() if n > 0.05 * total[k[0]] and n >= 3}
    for d, r in before.items():
        lines = [x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in bad]
        assert after[d].text == "\n".join(lines) and after[d].n_chars == (r.n_chars if after[d].text == r.text else len(after[d].text))
    root = linked({d: simhash.fingerprint(r.text) for d, r in after.items()})
    assert set(kept["simhash"]) == set(root.values())
    want, _ = ids_of({d: (r.text, None) for d, r in kept["simhash"].items()}, "byte_bpe_50k.json", [0])
    check_pieces(corpus_pipeline.packed(spark, given, SF).toPandas(), want)
