"""Language identification by word-first backoff (operator 1).

A word that training has seen adds its log frequency in every language. A word it has not seen backs off to its
character 4-grams, then 3-, 2- and 1-grams, and adds the mean log frequency of those that are known at the first length
at which any is. The language with the largest sum wins; the score is its share of the posterior.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import add_columns, held_out, keep_rows, slices
from hourline.session import stage

UNKNOWN = "und"
ORDERS = (4, 3, 2, 1)
#: Bounds of the model, for each language, documented in the README: labelled documents to learn from, words, grams of
#: each length.
TRAIN_DOCS, WORDS, GRAMS = 20_000, 30_000, 10_000
REMEMBERED = 200_000
#: Characters of texts that are scored together.
GROUP_CHARS = 200_000
#: Words of the model are written out for each language up to so many numbers, and beyond it stored where they were seen.
TABLE_CELLS = 8_000_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


def grams_of(word: str, order: int) -> list[str]:
    """Character n-grams of a word between its edges; single letters without edges."""
    if order == 1:
        return list(word)
    framed = f"<{word}>"
    return [framed[i : i + order] for i in range(len(framed) - order + 1)]


class Counts:
    """Log frequencies of keys, by language: a base for each language, which a key it has not seen has, and what the keys
    that were seen have above it. Only those are stored, so that many languages with words of their own stay compact."""

    def __init__(self, keys: list[str], languages: np.ndarray, n: np.ndarray, width: int):
        """One entry for each key and language that was seen with it."""
        self.rows: dict[str, int] = {}
        at = np.fromiter((self.rows.setdefault(k, len(self.rows)) for k in keys), np.int64, len(keys))
        order = np.argsort(at, kind="stable")
        self.start = np.searchsorted(at[order], np.arange(len(self.rows) + 1))
        self.language, self.above = languages[order].astype(np.int32), np.log((n[order] + 0.5) / 0.5).astype(np.float32)
        total = np.bincount(languages, weights=n, minlength=width) + 0.5 * len(self.rows)
        self.base = math.log(0.5) - np.log(np.maximum(total, 0.5))
        self.width = width

    def sums(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For each language the sum of the rows' log frequencies times their weights."""
        first, size = self.start[rows], self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(size)
        at = np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.base * weights.sum() + np.bincount(self.language[at], weights=self.above[at] * np.repeat(weights, size), minlength=self.width)

    def means(self, lists: list[list[int]]) -> np.ndarray:
        """For each list of rows and each language the mean of the rows' log frequencies."""
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        rows = np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum()))
        first, size = self.start[rows], self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(size)
        at = np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        place = np.repeat(np.repeat(np.arange(len(lists)), lengths), size) * self.width + self.language[at]
        above = np.bincount(place, weights=self.above[at], minlength=len(lists) * self.width)
        return self.base + above.reshape(len(lists), self.width) / lengths[:, None]


class Model:
    """Log frequencies of words, and of grams of each length."""

    def __init__(self, languages: list[str], documents: list[int], words: Counts | None, grams: dict[int, Counts]):
        self.languages, self.words, self.grams = languages, words, grams
        self.prior = np.log(np.array(documents, float) / max(1, sum(documents))) if languages else np.zeros(0)


class _Places(dict):
    """Row, in ``table``, of every word. Words of the model are written out in the table where that is small, and else stand
    under -1 and less in its ``Counts``; words that it lacks are backed off once and remembered up to a bound."""

    def __init__(self, model: Model):
        words, width = model.words, len(model.languages)
        self.model, self.most = model, max(1000, REMEMBERED * 4 // max(4, width))
        known = np.zeros((0, width), np.float32)
        if len(words.rows) * width <= TABLE_CELLS:
            super().__init__(words.rows)
            known = np.repeat(words.base.astype(np.float32)[None, :], len(words.rows), axis=0)
            known[np.repeat(np.arange(len(words.rows)), np.diff(words.start)), words.language] += words.above
        else:
            super().__init__((w, -1 - at) for w, at in words.rows.items())
        self.none = len(known)  # a row of zeros for words without any known gram
        self.end = self.none + 1
        self.table = np.concatenate([known, np.zeros((self.most + 1, width), np.float32)])

    @property
    def full(self) -> bool:
        return self.end - self.none > self.most

    def add(self, words: list[str]) -> None:
        """Back off words that are not here, all together; those without any known gram stay out."""
        for order in ORDERS:
            counts = self.model.grams.get(order)
            if not counts or not words:
                continue
            rows = counts.rows
            known = [[rows[g] for g in grams_of(w, order) if g in rows] for w in words]
            found, words = [w for w, k in zip(words, known) if k], [w for w, k in zip(words, known) if not k]
            if found:
                end = self.end + len(found)
                if end > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros((max(self.most, end - len(self.table)), self.table.shape[1]), np.float32)])
                self.table[self.end : end] = counts.means([k for k in known if k])
                self.update(zip(found, range(self.end, end)))
                self.end = end


class Scorer:
    def __init__(self, model: Model):
        self.model, self.places = model, _Places(model) if model.languages else None

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.score_all([text])[0]

    def score_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text, in groups of about GROUP_CHARS characters: a group's new words are backed off
        together, and its words are looked up once."""
        found, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                found += self._score_group(group)
                group, size = [], 0
        return found + self._score_group(group)

    def _score_group(self, texts: list[str | None]) -> list[tuple[str, float]]:
        words = [WORD.findall(t.lower()) if t else [] for t in texts]
        spoken = [any(map(str.isalpha, w)) or any(map(str.isalpha, t or "")) for w, t in zip(words, texts)]
        if not self.model.languages or not any(spoken):
            return [(UNKNOWN, 0.0)] * len(texts)
        if self.places.full:
            self.places = _Places(self.model)
        places = self.places
        met = set(chain.from_iterable(words))
        place = dict(zip(met, map(places.get, met)))
        new = [w for w, at in place.items() if at is None]
        places.add(new)
        place.update((w, places.get(w, places.none)) for w in new)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(place.__getitem__, chain.from_iterable(words)), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        logs = np.repeat(self.model.prior[None, :], len(texts), axis=0)
        with_words = np.flatnonzero(lengths)
        if len(with_words):
            rows = places.table[np.where(at < 0, places.none, at)].astype(np.float64)  # words in ``Counts`` follow below
            logs[with_words] += np.add.reduceat(rows, (ends - lengths)[with_words])
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(at < 0), "right")).tolist():
            own = at[ends[i] - lengths[i] : ends[i]]
            rows, n = np.unique(-1 - own[own < 0], return_counts=True)
            logs[i] += self.model.words.sums(rows, n.astype(float))
        best = np.argmax(logs, axis=1)
        score = 1.0 / np.exp(logs - logs[np.arange(len(texts)), best][:, None]).sum(axis=1)
        names = self.model.languages
        return [(names[b], s) if ok else (UNKNOWN, 0.0) for b, s, ok in zip(best.tolist(), score.tolist(), spoken)]


def train(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", most: int = TRAIN_DOCS) -> Model:
    """Count words and grams of labelled documents, ``most`` different ones (by id and text) of each language at most: those
    of the smallest digests. Documents that repeat one of them count as often as they stand. Rows without a label are no
    use; null and empty texts count as documents without words. Every labelled language is learned."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id).cast("string"), text).alias("digest"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("digest").alias("texts")).orderBy("lang").collect()
    if not sizes:
        return Model([], [], None, {})
    languages = [r["lang"] for r in sizes]
    number, n = {x: i for i, x in enumerate(languages)}, {r["lang"]: r["n"] for r in sizes}
    # Somewhat more than ``most`` by their digests, then the smallest of those: a rank over a bounded number for a language.
    spark = docs.sparkSession
    shares = [(r["lang"], math.ceil(min(1.0, (1.5 * most + 50) / max(1, r["texts"])) * (1 << 30))) for r in sizes]
    shares = F.broadcast(spark.createDataFrame(shares, "lang string, share long"))  # a row for each language
    mixed = F.xxhash64("digest", F.lit("drawn"))
    near = rows.select("lang", "digest").join(shares, "lang").where(F.pmod(mixed, F.lit(1 << 30)) < F.col("share")).select("lang", "digest").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(mixed, F.lit(1 << 30)), "digest"))
    chosen = stage(near.withColumn("place", place).where(F.col("place") <= most).select("lang", "digest"), "language-sample")
    sample = rows.join(chosen, ["lang", "digest"], "left_semi").select("lang", "text")

    def count(batches):
        for batch in batches:
            for part, texts in slices(batch, "text"):
                by: dict[int, Counter] = {}
                for x, t in zip(part.column(0).to_pylist(), texts):
                    by.setdefault(number[x], Counter()).update(words_of(t))
                flat = [(k, w, c) for k, words in by.items() for w, c in words.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*flat)) or [(), (), ()], (pa.int32(), pa.string(), pa.int64()))], names=["k", "w", "n"])

    words = stage(sample.mapInArrow(count, "k int, w string, n long").groupBy("k", "w").agg(F.sum("n").alias("n")), "language-words")

    def split(batches):
        for batch in batches:
            found: dict[tuple[int, int], dict[str, int]] = defaultdict(lambda: defaultdict(int))
            for k, w, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for order in ORDERS:
                    by = found[k, order]
                    for g in grams_of(w, order):
                        by[g] += n
            flat = [(*key, g, c) for key, by in found.items() for g, c in by.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*flat)) or [()] * 4, (pa.int32(), pa.int32(), pa.string(), pa.int64()))], names=["k", "o", "w", "n"])

    grams = words.mapInArrow(split, "k int, o int, w string, n long").groupBy("k", "o", "w").agg(F.sum("n").alias("n"))
    counted = words.select("k", F.lit(0).alias("o"), "w", "n").unionByName(grams)
    # The most frequent words and grams of each language and length; a bounded model reaches the driver. How many have each
    # frequency tells the last frequency that has a place, and the share of its keys that fits, taken by digest.
    counted = stage(counted, "language-counts")
    classes = counted.groupBy("k", "o", "n").agg(F.count("*").alias("keys"))
    upto = F.sum("keys").over(Window.partitionBy("k", "o").orderBy(F.desc("n")))
    bound = F.when(F.col("o") == 0, WORDS).otherwise(GRAMS)
    last = classes.withColumn("upto", upto).where(F.col("upto") > bound).groupBy("k", "o").agg(
        F.max("n").alias("last"), F.max_by((bound - F.col("upto") + F.col("keys")) / F.col("keys"), "n").alias("share")
    )
    cut = counted.join(F.broadcast(last), ["k", "o"], "left")  # a row for each language and length
    drawn = F.pmod(F.xxhash64("w"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    top = cut.where(F.col("last").isNull() | (F.col("n") > F.col("last")) | ((F.col("n") == F.col("last")) & drawn)).select("k", "o", "w", "n").toArrow()
    of = top.column("o").to_numpy()
    tables = {}
    for order in (0, *ORDERS):
        some = top.filter(pa.array(of == order))
        tables[order] = Counts(some.column("w").to_pylist(), some.column("k").to_numpy(), some.column("n").to_numpy().astype(float), len(languages))
    return Model(languages, [n[x] for x in languages], tables.pop(0), tables)


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def identify(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns, ``lang_pred`` and ``score`` of each whole text. ``und`` and 0 where the text is null or has no letter,
    or no language was learned; a text whose letters are all unseen gets the most frequent language."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)
        return lambda texts: list(zip(*scorer.score_all(texts))) or ([], [])

    return add_columns(docs, text, FIELDS, make, keep_text)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """The documents, unchanged, whose language is known with a score of ``least`` or more."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(held.value)
        return lambda texts: [x != UNKNOWN and s >= least for x, s in scorer.score_all(texts)]

    return keep_rows(docs, text, make)


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(doc_id, 3, 1))
