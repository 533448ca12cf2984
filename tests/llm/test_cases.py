"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib
import random
import re
import sys
import time
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from hourline.llm import blocks, bpe, components, language, neighbours, packing, records, revisits, simhash, site_lines, tokens, toxicity
from hourline.session import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(random.Random(3).choice(["alpha", "beta", "gamma", "delta", "x\ty"]) for _ in range(60_000))
ODD = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, "the same words here", None, "a", 19), (3, "the same words here", None, "a", 19),
    (None, "the same words here", "en", "a", 19), (4, " \n\t ", "en", "a", 4), (5, "the  same\nwords here", "en", None, 20), (6, LONG, "en", "a", len(LONG)),
    (7, "12 34 !!", None, "b", 8), (8, "x" * 5000, "en", "b", 5000), (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    extra = [("score", "s"), ("ids", 1), ("row", 2), ("name", "n"), ("fp", "f"), ("host", "h"), ("h", 5), ("_host", "q"), ("y", 1), ("u", 2), ("key", "k"), ("label", 1)]
    return spark.createDataFrame(ODD, SCHEMA).withColumns({n: F.lit(v) for n, v in extra})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(t):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("size,digest", [(40_000, F.xxhash64), (50_000, lambda b: F.xxhash64(F.length(b)) % 3)])
def test_blocks(odd, size, digest):
    found = blocks.exact_duplicates(odd, size=size, digest=digest).toPandas()
    texts = [norm(r[1]) for r in ODD]
    assert len(found) == len(ODD)
    for t in set(texts):
        ids = [r[0] for r in ODD if norm(r[1]) == t]
        group = found[found.text_sha256 == hashlib.sha256(t.encode()).hexdigest()]
        assert len(group) == len(ids) and (group.group_size == len(ids)).all() and group.kept.sum() == 1
        smallest = min((i for i in ids if i is not None), default=None)
        assert all(k == smallest or (smallest is None and pd.isna(k)) for k in group.keep_id)


def test_block_names_by_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.choice([0, 1, 3, 4, 8, 9, 16, 17, 40]))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    named = blocks.name_documents(df, size=4).toPandas()
    by = {}
    for d, identity in zip(named.doc_id, named.identity):
        assert by.setdefault(identity, norm(texts[d])) == norm(texts[d])
    assert len(by) == len({norm(t) for t in texts})


SAMPLES = ["a<|endoftext|>b <|endoftext|>", "<|startoftext|> X", "a  \n\nnext", " \t\n  x  \r\n y ", "İstanbul ΣΑΣ é é", "'S 's it's IT'S don't", "a\x1cb .\x1c.", "a\xa0\n\nb 　 c", "😀👍🏽 مرحبا नमस्ते 你好", "x" * 3000, "①② 123abc"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_equal_the_library(path):
    t, e = Tokenizer.from_file(path), tokens.LibraryEncoder(path)
    for s in SAMPLES + [LONG[:20_000]]:
        assert np.frombuffer(e.encode(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids, s[:50]
    assert e.encode(None) == e.encode("") == b""


def test_chunks_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_CHUNKS", 20)
    t, e, rng = Tokenizer.from_file(BYTE), tokens.LibraryEncoder(BYTE), random.Random(5)
    for _ in range(60):
        s = " ".join(f"w{rng.randrange(80)}" for _ in range(12))
        assert np.frombuffer(e.encode(s), "<u4").tolist() == t.encode(s, add_special_tokens=False).ids
        assert len(e.known) <= 20 + 12 + 1


def test_remembered_chunks_are_bounded_in_memory():
    """What a worker remembers when full stays under 100 MB: two workers and the JVM share an executor's memory."""
    rng, e = random.Random(23), tokens.LibraryEncoder(BYTE)
    e.encode_all([" ".join("".join(rng.choice("etaonirsh") for _ in range(rng.randrange(4, 14))) for _ in range(20_000))])
    held = sys.getsizeof(e.known) + sum(sys.getsizeof(c) + sys.getsizeof(x) for c, x in e.known.items())
    assert held / len(e.known) * e.most < 100e6


def test_texts_encoded_together(monkeypatch):
    monkeypatch.setattr(tokens, "GROUP_CHARS", 60)
    monkeypatch.setattr(tokens, "KNOWN_CHUNKS", 30)
    rng, e = random.Random(8), tokens.LibraryEncoder(WORD)
    texts = [rng.choice(["", None, "a\x0bb c", "x" * 300, "<|endoftext|> y"]) if rng.random() < 0.2 else " ".join(f"W{rng.randrange(90)}," for _ in range(rng.randrange(20))) for _ in range(80)]
    t = Tokenizer.from_file(WORD)
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode_all(texts)] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert e.encode_all([]) == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t\xa0'sable1")), max_size=40))
def test_any_text(text):
    t = Tokenizer.from_file(BYTE) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = t
    own = bpe.rank_table(BYTE)
    ids = t.encode(text, add_special_tokens=False).ids
    for e in (own, tokens.library_encoder(BYTE)):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == ids
    assert own.decode(ids) == t.decode(ids, skip_special_tokens=False) == text


def test_merges_of_long_words_equal_those_of_short_ones():
    table, rng = bpe.rank_table(BYTE), random.Random(1)
    for n in (1, 2, 5, 40, 300):
        for _ in range(30):
            word = bytes(rng.choice(b"theandionr ") for _ in range(n))
            assert table.merge_short(word) == table.merge_long(word)
    assert table.merge_short(b"a" * 200) == table.merge_long(b"a" * 200)


def test_bpe_columns(odd, none):
    coded = bpe.encode(odd, BYTE, ids="token_ids")
    rows = coded.select("text", "token_ids").collect()
    t = Tokenizer.from_file(BYTE)
    assert all(r.token_ids == t.encode(r.text or "", add_special_tokens=False).ids for r in rows)
    assert sorted(r.decoded for r in bpe.decode(coded, BYTE, ids="token_ids").collect()) == sorted(r[1] or "" for r in ODD)
    assert bpe.round_trip_digests(odd, BYTE).count() == len(ODD) and bpe.round_trip_digests(none, BYTE).count() == 0


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums():
    rng = random.Random(2)
    items = [b"", b"a", b"123456789", bytes(300)] + [rng.randbytes(rng.choice([3, 255, 256, 257, 512, 1000, 5000])) for _ in range(20)]
    assert records.masked_crc32c(items).tolist() == [plain_crc32c(x) for x in items]
    assert plain_crc32c(b"123456789") == (((0xE3069283 >> 15) | (0xE3069283 << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    framed = records.frame(items)
    assert records.unframe(framed) == items
    broken = bytearray(framed[2])
    broken[14] ^= 1
    with pytest.raises(ValueError):
        records.unframe([bytes(broken)])


@pytest.mark.parametrize("width, most", [(2, 0xFFFF), (4, 0xFFFFFFFF)])
def test_record_data(width, most):
    for ids in ([], [0], [1, most, 7]):
        given = np.array(ids, "<u4").tobytes()
        for doc_id in (None, 0, -3, 2**62):
            data = records.serialise(doc_id, given, width)
            assert records.parse(data) == (doc_id, given) and len(data) == records.HEAD + width * len(ids)


def test_records(spark, odd, none):
    folder = scratch_path(spark, "test-records")
    manifest = records.write_records(odd, WORD, 2, folder)
    straight = records.read_records(manifest, folder).orderBy("task", "shard", "position").collect()
    shuffled = records.read_records(manifest, folder, shuffle_seed=1).collect()
    assert sorted(map(tuple, straight), key=repr) == sorted(map(tuple, shuffled), key=repr)
    ids = [r.doc_id for r in straight]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0)) and len(ids) == len(ODD)
    found = records.record_digests(odd, WORD, 2).orderBy("start").collect()
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    assert records.record_digests(none, WORD, 2).count() == 0


def test_packing(spark, odd, none):
    found = packing.pack(odd, BYTE, 0, with_ids=True, most=2).toPandas()
    assert sum(found.length) == sum(len(Tokenizer.from_file(BYTE).encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in ODD)
    for _, parts in found.groupby("sequence_id"):
        parts = parts.sort_values("offset")
        assert parts.offset.tolist() == [0, *parts.length.cumsum().tolist()[:-1]] and parts.length.sum() <= 1024
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in found.itertuples())
    assert packing.pack(none, BYTE, 0).count() == 0


def test_packing_places_best_fit():
    w = packing.Windows(10, 2, 0)
    assert w.place(["a"], 6) == [] and w.place(["b"], 7) == []
    assert w.place(["c"], 3) == [["b", 1, 0], ["c", 1, 7]]  # fits b exactly, and fills it
    assert w.place(["d"], 8) == [] and w.place(["e"], 5) == [["d", 2, 0]]  # none fits: the fullest goes


def test_packing_merges_over_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGE", 4)
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 90).cast("int")).alias("text")).repartition(16)
    found = packing.pack(df, BYTE, 0, size=128).toPandas()
    assert found.groupby("sequence_id").length.sum().le(128).all() and found.doc_id.nunique() == 400
    assert found.length.sum() / (128 * found.sequence_id.nunique()) > 0.95


def test_packing_rounds_end_when_no_windows_merge(spark, monkeypatch):
    """Rests of over half a window never share one, so only the falling number of tasks ends the rounds."""
    monkeypatch.setattr(packing, "MERGE", 1)
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 90).alias("text")).repartition(12)
    found = packing.pack(df, BYTE, 0, size=128, most=2).toPandas()
    assert len(found) == 60 and found.sequence_id.nunique() == 60


def test_language(spark, odd, none):
    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("der hund und die katze", "de")] * 3)], "doc_id long, text string, lang string")
    model = language.train(docs)
    found = language.identify(odd, model).collect()
    assert len(found) == len(ODD) and "name" in found[0].asDict()
    for r in found:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not lettered) and 0 <= r.score <= 1 and (lettered or r.score == 0)
    probes = spark.createDataFrame([("the dogs",), ("les chiens",), ("die hunde",), ("²",), ("Ω",)], "text string")
    assert [r.lang_pred for r in language.identify(probes, model).collect()][:4] == ["en", "fr", "de", "und"]
    assert [r.lang_pred for r in language.identify(probes, language.train(none)).collect()] == ["und"] * 5
    assert language.identify(none, model).count() == 0
    assert language.keep_identified(odd, model).columns == odd.columns


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_a_word_is_one_chunk_whatever_mark_follows(path, monkeypatch):
    t, e = Tokenizer.from_file(path), tokens.LibraryEncoder(path)
    e.encode_all(["so word, word. word; word! word? word"])
    assert set(e.known) == {"so", " word", ",", ".", ";", "!", "?"}
    rng = random.Random(12)
    pieces = ["word", "Écœ", "ÿ", "İ", "é", "e\u0301", "\u0301", "ﬁ", "'s", "n't", ".", ",", "!?", ":", "<", "<\u0338", "|endoftext|>", "<|endoftext|>", "12", "½", "漢", " ", "  ", "\n", "$"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [" ".join(rng.choice(["alpha", "Beta", "gámma", "delta"]) + str(i) * (i % 7 == 0) for i in range(700))]
    for together in (200, 3):
        monkeypatch.setattr(tokens, "TOGETHER", together)
        e.known.clear()
        want = [np.array(x.ids, "<u4").tobytes() for x in t.encode_batch_fast(texts, add_special_tokens=False)]
        assert e.encode_all(texts) == want


WORD_CHUNK = re.compile(rf"[ \t\n\r]*{tokens.LETTERS}++(?={tokens.MARKS})|[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")


@pytest.mark.parametrize(("pattern", "marks"), [(WORD_CHUNK, True), (tokens.CHUNK, False)])
def test_cuts_in_bytes_equal_the_pattern(pattern, marks):
    rng = random.Random(21)
    pieces = ["a", "word", "É", "œ", "Ÿ", "ÿ", "×", "÷", "Å", "ő", "漢", "😀", "\u0301", ".", ",", "!?", ":;", "-", "7", " ", "  ", "\t", "\r\n", "\n"]
    for _ in range(400):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(rng.randrange(1, 9))]
        raw = [t.encode() for t in texts]
        starts = np.cumsum([0, *map(len, raw[:-1])])
        data = np.frombuffer(b"".join(raw), np.uint8)
        begins = tokens.chunk_starts(data, starts, marks).tolist()
        found = [data[a:b].tobytes().decode() for a, b in zip(begins, [*begins[1:], len(data)])]
        assert found == [c for t in texts for c in pattern.findall(t)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_known_words_cost_less_than_one_string_each(path):
    """Texts of words met before: no more time than it takes to cut them into Python strings once."""
    rng, e = random.Random(22), tokens.LibraryEncoder(path)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma,", "Delta."]) + "abcdefghij"[rng.randrange(10)] for _ in range(400)) for _ in range(500)]
    e.encode_all(texts)

    def least(work):
        times = []
        for _ in range(5):
            began = time.process_time()
            work()
            times.append(time.process_time() - began)
        return min(times)

    assert least(lambda: e.encode_all(texts)) < least(lambda: [WORD_CHUNK.findall(t) for t in texts])


def test_language_backs_off():
    counts = lambda *rows: language.Counts([r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float), 2)
    model = language.Model(["a", "b"], [1, 1], counts(("known", 0, 5)), {4: counts(("<unk", 1, 3), ("abcd", 0, 3)), 1: counts(("z", 0, 1), ("q", 1, 1))})
    score = language.Scorer(model)
    assert score("known")[0] == "a" and score("unkxx")[0] == "b" and score("zz")[0] == "a"


def test_language_scores_in_groups(monkeypatch):
    """New words of a group are backed off in one call, a list of texts scores like its texts alone, odd ones among them."""
    counts = lambda *rows: language.Counts([r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float), 2)
    model = language.Model(["a", "b"], [1, 1], counts(("known", 0, 5)), {4: counts(("<unk", 1, 3), ("nkxx", 0, 3)), 1: counts(("z", 0, 1), ("q", 1, 1))})
    texts = ["known unkxx", None, "", "zz zzz unkxx unky", "\u00bd 12", "\u03a9", "unkxy qq"]
    alone = [language.Scorer(model)(t) for t in texts]
    calls, means = [], language.Counts.means
    monkeypatch.setattr(language.Counts, "means", lambda self, lists: calls.append(len(lists)) or means(self, lists))
    assert language.Scorer(model).score_all(texts) == alone and calls == [3, 3]
    assert [x for x, _ in alone] == ["a", "und", "und", "a", "und", "a", "b"]
    monkeypatch.setattr(language, "GROUP_CHARS", 3)
    monkeypatch.setattr(language, "REMEMBERED", 1)
    assert language.Scorer(model).score_all(texts * 2) == alone * 2


@pytest.mark.parametrize("cells", [8_000_000, 10])
def test_every_language_is_learned(spark, monkeypatch, cells):
    monkeypatch.setattr(language, "TABLE_CELLS", cells)
    rows = [(i, f"w{chr(97 + i % 26)}{chr(97 + i // 26)} common " * 3, f"l{i:03d}") for i in range(120)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.languages) == 120
    found = language.identify(docs, model).select("lang", "lang_pred").collect()
    assert all(r.lang == r.lang_pred for r in found)
    score = language.Scorer(model)
    monkeypatch.setattr(language, "TABLE_CELLS", 8_000_018 - cells)  # the other way of keeping words
    other = language.Scorer(model)
    for t in ("waa common unheard of", "nothing waa", "common"):
        assert score(t)[0] == other(t)[0] and score(t)[1] == pytest.approx(other(t)[1], rel=1e-4)


def test_language_sample_of_one_id(spark):
    """An id on all rows is sampled by its texts; copies of a chosen document all count."""
    docs = spark.createDataFrame([(7, f"word{chr(97 + i % 20)}{chr(97 + i // 20)}", "en") for i in range(200)] + [(7, "ein satz", "de")] * 50, "doc_id long, text string, lang string")
    model = language.train(docs, most=10)
    rows = model.words.rows
    assert len([w for w in rows if w.startswith("word")]) == 10 and rows.keys() >= {"ein", "satz"}
    at = rows["ein"]
    assert round(float(np.exp(model.words.above[model.words.start[at]]) * 0.5 - 0.5)) == 50


def test_language_bounds(spark, monkeypatch):
    monkeypatch.setattr(language, "WORDS", 40)
    monkeypatch.setattr(language, "GRAMS", 15)
    text = " ".join(w for i in range(300) for w in ["x" + chr(97 + i % 17) + chr(97 + i // 17)] * (5 if i < 20 else 2))
    model = language.train(spark.createDataFrame([(1, text, "a"), (2, "few words", "b")], "doc_id long, text string, lang string"))
    assert 20 <= len(model.words.rows) - 2 <= 60 and {"few", "words", "xaa"} <= model.words.rows.keys()


def test_toxicity(spark, odd, none):
    texts = [f"plain words number {i} here" for i in range(60)] + [f"you awful thing number {i}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(90)] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    probe = spark.createDataFrame([("an awful thing you",), ("plain words",), ("",), (None,)], "text string")
    scores = [r.score for r in toxicity.score_toxicity(probe, model).collect()]
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3] and 0 <= min(scores)
    assert 0 < len(model.at) < 400  # most coordinates stay at zero
    assert toxicity.score_toxicity(odd, model).count() == len(ODD) and toxicity.score_toxicity(none, model).count() == 0
    assert {r.predicted for r in toxicity.score_toxicity(odd, toxicity.train(docs, labels.limit(0))).collect()} == {0}
    assert toxicity.keep_clean(odd, model).columns == odd.columns


def test_components(spark):
    rng = random.Random(7)
    pairs = [(i, i + 1) for i in range(0, 200)] + [(300, 300 + i) for i in range(50)] + [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(300)] + [(5, 5)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    from tests.llm.test_contracts import union

    nodes = {x for a, b in pairs for x in (a, b) if a != b}
    assert found == union(pairs, nodes) if 5 in nodes else True
    assert {n: r for n, r in union(pairs, {x for p in pairs for x in p}).items() if n in found} == found
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("bucket", [2, 512])
def test_covering_loses_no_link(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(11)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(140):
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4])):
            x ^= 1 << b
        fps.append(x)
    from tests.llm.test_contracts import linked

    root = linked(dict(enumerate(fps)))
    df = spark.createDataFrame([(i, simhash.signed(x)) for i, x in enumerate(fps)], "doc_id long, fp long")
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert found == root


def test_masks_cover_every_three_positions():
    from itertools import combinations

    first = [~m for m in simhash.finer_masks(0)]
    assert len(first) == 15
    assert all(any(m >> a & 1 and m >> b & 1 and m >> c & 1 for m in first) for a, b, c in combinations(range(64), 3))
    for mask in (first[0], (1 << 60) - 1, (1 << 59) - 1):
        mask &= (1 << 64) - 1
        open_ = [i for i in range(64) if not mask >> i & 1]
        finer = simhash.finer_masks(mask)
        assert mask not in finer
        assert all(any(not (f >> a & 1 or f >> b & 1 or f >> c & 1) for f in finer) for a, b, c in combinations(open_, 3))


def test_simhash_cases(odd, none):
    found = simhash.near_duplicate_documents(odd).toPandas()
    assert len(found) == len(ODD)
    assert (found[found.doc_id.isin([1, 2, 4])].fingerprint == "0" * 16).all() and (found[found.doc_id.isin([1, 2, 4])].component_id == 1).all()
    assert (found[found.doc_id.isin([3, 5])].component_id == 3).all()
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8]
    assert simhash.near_duplicate_documents(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_toxicity_of_a_hot_id(spark):
    """An id that many rows carry teaches once."""
    texts = [f"plain words number {i} here" for i in range(60)] + [f"you awful thing number {i}" for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(90)], "doc_id long, toxic int")
    hot = spark.range(200).join(docs.where("doc_id = 5")).select("doc_id", "text")
    one, many = toxicity.train(docs, labels), toxicity.train(docs.unionByName(hot), labels)
    assert one.bias == many.bias and len(one.at) == len(many.at) and (one.at == many.at).all() and (one.weights == many.weights).all()


def test_site_lines(spark, odd, none):
    pages = [(i, "menu\ntext %d\n\n menu " % i, "s") for i in range(10)] + [(20, "menu\nown", "t"), (21, None, "s"), (22, "menu", None)]
    df = spark.createDataFrame(pages, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in site_lines.line_report(df, "doc_id").collect()}
    assert found[0].text == "text 0\n" and found[0].n_dropped == 2 and found[0].n_lines == 4
    assert found[20].text == "menu\nown" and found[21].text is None and found[21].n_lines == 0 and found[22].text == "menu"
    assert site_lines.drop_boilerplate(odd).columns == odd.columns and site_lines.drop_boilerplate(odd).count() == len(ODD)
    assert site_lines.line_report(none, "doc_id").count() == 0


def test_site_lines_of_copies(spark):
    """Copies alone make no line boilerplate of what goes on to the next stage; the report counts them as pages."""
    pages = [(i, "menu\ncopied one\ncopied two", "s") for i in range(20)] + [(20 + i, f"menu\ntext {i}", "s") for i in range(30)]
    df = spark.createDataFrame(pages, "doc_id long, text string, source string")
    clean = {r.doc_id: r.text for r in site_lines.drop_boilerplate(df).collect()}
    assert clean == {i: "copied one\ncopied two" if i < 20 else f"text {i - 20}" for i in range(50)}
    assert {r.text for r in site_lines.line_report(df, "doc_id").collect() if r.doc_id < 20} == {""}


def brute_links(rows, threshold=0.98):
    n = dict.fromkeys([r[0] for r in rows], 0)
    good = [r for r in rows if r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    pairs = []
    for a, (i, v, x) in enumerate(good):
        for j, w, y in good[a + 1 :]:
            if x == y and len(v) == len(w):
                v_, w_ = np.array(v, float), np.array(w, float)
                if v_ @ w_ / np.linalg.norm(v_) / np.linalg.norm(w_) >= threshold:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    pairs.append((i, j))
    return n, pairs


@pytest.mark.parametrize("bucket,block", [(256, 1024), (16, 8)])
def test_neighbours(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(neighbours, "BUCKET", bucket)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rng = np.random.default_rng(4)
    dense = rng.normal(size=8)
    rows = [(i, (dense + rng.normal(scale=0.02, size=8)).tolist(), "x") for i in range(40)]
    rows += [(100 + i, rng.normal(size=8).tolist(), "x" if i % 2 else "y") for i in range(60)]
    rows += [(200, rows[50][1], rows[50][2]), (201, [2 * x for x in rows[51][1]], rows[51][2]), (202, rows[52][1], None)]
    rows += [(300, None, "x"), (301, [], "x"), (302, [0.0] * 8, "x"), (303, [1.0, None] + [0.0] * 6, "x"), (304, [float("nan")] + [1.0] * 7, "x"), (305, [float("inf")] * 8, "x"), (306, [1.0, 2.0], "x"), (307, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.StringType())]))
    found = {r.vec_id: r for r in neighbours.link_vectors(df).collect()}
    n, pairs = brute_links(rows)
    from tests.llm.test_contracts import union

    root = union(pairs, n)
    assert {i: r.n_links for i, r in found.items()} == n
    assert {i: r.component_id for i, r in found.items()} == root
    assert neighbours.link_vectors(df.limit(0)).count() == 0


VECTORS = "vec_id long, embedding array<double>, label string"


def tight_groups(sizes, cosine, seed=6, dims=64):
    """Groups of distinct vectors inside 0.999 of their centres, which have about ``cosine`` with the first centre."""
    rng = np.random.default_rng(seed)
    axes = np.linalg.qr(rng.normal(size=(dims, len(sizes))))[0].T
    centres = [axes[0]] + [cosine * axes[0] + np.sqrt(1 - cosine**2) * x for x in axes[1:]]
    near = [(c + rng.normal(scale=0.001, size=dims)).tolist() for c, n in zip(centres, sizes) for _ in range(n)]
    return [(i, v, "x") for i, v in enumerate(near)]


def test_neighbours_joins_tight_groups(spark):
    """No list of the k best has a place for the links between the groups."""
    rows = tight_groups([60, 60], 0.985)
    found = neighbours.link_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.n_links for r in found} == {119} and {r.component_id for r in found} == {0}


@pytest.mark.parametrize("cosine,block", [(0.985, 1024), (0.985, 16), (0.97, 16)])
def test_neighbours_across_parts(spark, monkeypatch, cosine, block):
    """Parts whose members never met are joined if, and only if, they link."""
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = tight_groups([30, 30], cosine) + [(100 + i, v, "y") for i, v, _ in tight_groups([30], cosine)]
    df = spark.createDataFrame([(i, {"x": 1, "y": 2}[x], 1.0, v) for i, v, x in rows], "id long, grp long, weight double, vector array<double>")
    part = lambda i: min(i // 30 * 30, 100) if i < 100 else 100
    roots = spark.createDataFrame([(r[0], part(r[0])) for r in rows], "node long, root long")
    lists = spark.createDataFrame([(r[0], part(r[0]) + j, 0.999) for r in rows for j in range(9) if part(r[0]) + j != r[0]], "u long, v long, s double")
    found = neighbours._across(lists, df, roots, 0.98, 8).collect()
    assert {(part(min(r)), part(max(r))) for r in found} == ({(0, 30)} if cosine > 0.98 else set())


def test_neighbours_audit_sees_few_links(spark, monkeypatch):
    """A large cluster does not hide that the pairs were lost: they are found in a further turn."""
    rng, first, calls = np.random.default_rng(8), neighbours._first_lists, []
    ones = [rng.normal(size=64) for _ in range(40)]
    pairs = [(1000 + 2 * i + j, (v + j * rng.normal(scale=0.001, size=64)).tolist(), "x") for i, v in enumerate(ones) for j in (0, 1)]

    def lossy(*args):
        calls.append(1)
        found = first(*args)
        return found.where("u <= 150 and v <= 150") if len(calls) == 1 else found

    monkeypatch.setattr(neighbours, "_first_lists", lossy)
    found = neighbours.link_vectors(spark.createDataFrame(tight_groups([150], 0.99) + pairs, VECTORS)).collect()
    assert len(calls) > 1 and {r.n_links for r in found if r.vec_id >= 1000} == {1} and {r.n_links for r in found if r.vec_id < 1000} == {149}


def test_neighbours_of_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], "x"), (1, [0.0, 1.0], "x"), (2, [1.0, 0.001], "x"), (3, [0.001, 1.0], "x"), (None, [1.0, 0.002], "x"), (None, [-1.0, 0.0], "x"), (None, None, "x"), (4, [-1.0, 0.0], "x"), (4, [-1.0, 0.0], "x"), (5, [0.0, -1.0], "x")]
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in neighbours.link_vectors(spark.createDataFrame(rows, VECTORS)).collect()), key=repr)
    want = [(1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False), (None, 2, 1, False), (None, 2, 4, False), (None, 0, None, False), (4, 2, 4, True), (4, 2, 4, True), (5, 0, 5, True)]
    assert found == sorted(want, key=repr)


def test_neighbours_audit_measures_rare_links(spark, monkeypatch):
    """Where the random sample holds no linked node, those that the graph links are searched."""
    monkeypatch.setattr(neighbours, "AUDIT_NODES", 4)
    monkeypatch.setattr(neighbours, "AUDIT_MOST", 4)
    seen, recall = [], neighbours._recall
    monkeypatch.setattr(neighbours, "_recall", lambda truth, links, k: seen.append((len(truth), recall(truth, links, k))) or seen[-1][1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=32).tolist(), "x") for i in range(600)]
    rows += [(1000 + i, (np.array(rows[i][1]) + rng.normal(scale=0.001, size=32)).tolist(), "x") for i in range(3)]
    found = neighbours.link_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sum(r.n_links for r in found) == 6 and seen[-1][0] >= 4 and seen[-1][1]["few"] == (1.0, seen[-1][0])


def test_neighbours_audit_error(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_recall", lambda *args: {"few": (0.5, 40)})
    with pytest.raises(RuntimeError, match="audit"):
        neighbours.link_vectors(spark.createDataFrame(tight_groups([3], 0.99), VECTORS))


def test_neighbours_tables_grow():
    assert neighbours._tables(8, 0.98) == neighbours.TABLES < neighbours._tables(19, 0.98) < neighbours._tables(60, 0.98)


def test_revisits(spark, monkeypatch):
    monkeypatch.setattr(revisits, "SLICE_ROWS", 20)
    rng = random.Random(9)
    rows = []
    for i in range(200):
        kind = rng.choice(["response", "revisit"])
        url = rng.choice(["http://a.org/x", "https://www.A.org/x/#f", "http://a.org:80/x?utm_source=1", "http://b.org/?q=1", None])
        rows.append((i, url, rng.randrange(60), kind, rng.choice(['"1"', 'W/"1"', '"2"', None]), rng.choice(["m", None]), None, {"date": str(i), "content-length": str(i)}, f"p{i}" if kind == "response" else None))
    schema = "id long, url string, time long, kind string, etag string, last_modified string, digest string, headers map<string,string>, payload string"
    found = {r.id: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    keys = {"http://a.org/x": "a.org/x", "https://www.A.org/x/#f": "a.org/x", "http://a.org:80/x?utm_source=1": "a.org/x", "http://b.org/?q=1": "b.org/?q=1", None: None}
    plain = lambda e: e and e.removeprefix("W/")
    for i, url, time, kind, etag, modified, _, headers, _ in rows:
        if kind == "response":
            assert i not in found
            continue
        r = found[i]
        full = max((x for x in rows if x[3] == "response" and url and keys[x[1]] == keys[url] and x[2] < time), key=lambda x: (x[2], x[0]), default=None)
        assert r.key == keys[url]
        if url is None or full is None:
            assert r.status == ("no_url" if url is None else "no_earlier_response") and r.payload is None
            continue
        same = plain(etag) == plain(full[4]) if etag and full[4] else modified == full[5] if modified and full[5] else None
        assert r.status == {True: "resolved", False: "mismatch", None: "no_validator"}[same]
        if same:
            assert r.source_id == full[0] and r.payload == full[8] and r.headers == {"date": str(i), "content-length": str(full[0])}
        else:
            assert r.source_id is None and r.headers == headers
    assert revisits.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_revisits_of_equal_times_and_ids(spark):
    schema = "id long, url string, time long, kind string, etag string, last_modified string, digest string, headers map<string,string>, payload string"
    row = lambda i, time, kind, payload=None, tag="t": (i, "http://a.org/x", time, kind, tag, None, None, {"date": str(time)}, payload)
    rows = [row(5, 10, "response", "five"), row(9, 10, "revisit"), row(1, 10, "revisit"), row(5, 10, "revisit"), row(2, 11, "revisit"), row(3, None, "revisit")]
    found = {(r.id, r.status, r.payload) for r in revisits.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert found == {(9, "no_earlier_response", None), (1, "no_earlier_response", None), (5, "no_earlier_response", None), (3, "no_earlier_response", None), (2, "resolved", "five")}
    # Responses that share an id: the latest before the revisit counts, with its own payload; copies are one.
    rows = [row(5, 10, "response", "old"), row(5, 20, "response", "new"), row(5, 20, "response", "new"), row(7, 15, "revisit"), row(7, 15, "revisit"), row(8, 30, "revisit"), row(4, None, "response", "undated"), row(6, 1, "revisit")]
    found = sorted((r.id, r.source_id, r.payload) for r in revisits.resolve_revisits(spark.createDataFrame(rows, schema)).collect())
    assert found == [(6, 4, "undated"), (7, 5, "old"), (7, 5, "old"), (8, 5, "new")]


def test_stages_take_odd_rows(spark, odd, none, tmp_path):
    odd.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 0), (6, 0), (8, None)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, odd, str(tmp_path)).columns == odd.columns
        assert step(spark, odd, str(tmp_path)).count() <= len(ODD)
        assert step(spark, none, str(tmp_path)).count() == 0
    assert corpus_pipeline.packed(spark, odd, str(tmp_path)).count() > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
