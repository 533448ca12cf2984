"""Byte-level BPE encoding and decoding with a contiguous rank array (operator 6).

A word of few bytes holds its part boundaries and the ranks of adjacent parts in two short lists. The least rank is
scanned for, the boundary between its two parts is deleted, and the two neighbouring ranks are refreshed, until no pair
has a rank. Scanning a short contiguous list beats any linked structure; a word beyond SHORT bytes, where repeated
scans would be quadratic, takes the same merges from a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import add_columns
from hourline.llm.tokens import ChunkEncoder

SHORT = 96
KNOWN = 1_200_000
NONE = 1 << 60
#: Unicode white space and the public byte-level pattern.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

_tables: dict[str, RankTable] = {}


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class RankTable(ChunkEncoder):
    """Ranks of pairs and ids of parts from a tokenizer file with a byte-level BPE model."""

    def __init__(self, path: str):
        super().__init__(KNOWN)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        model = file["model"]
        self.ids = {raw(s): i for s, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(raw(a), raw(b)): r for r, (a, b) in enumerate(merges)}
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.added = added
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        size = max([*self.ids.values(), *added.values()]) + 1
        self.parts = [b""] * size
        for b, i in self.ids.items():
            self.parts[i] = b
        for s, i in added.items():
            self.parts[i] = s.encode()
        self.decimal = [str(i) for i in range(size)]
        self.words: dict[str, bytes] = {}

    def merge_short(self, word: bytes) -> list[bytes]:
        cuts, ranks = list(range(len(word) + 1)), self.ranks
        rank = lambda i: ranks.get((word[cuts[i] : cuts[i + 1]], word[cuts[i + 1] : cuts[i + 2]]), NONE)
        edges = [rank(i) for i in range(len(word) - 1)]
        while edges:
            low = min(edges)
            if low == NONE:
                break
            i = edges.index(low)
            del cuts[i + 1], edges[i]
            if i:
                edges[i - 1] = rank(i - 1)
            if i < len(edges):
                edges[i] = rank(i)
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def merge_long(self, word: bytes) -> list[bytes]:
        n, ranks = len(word), self.ranks
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get((word[i : i + 1], word[i + 1 : i + 2]))) is not None]
        heapq.heapify(heap)
        dead = bytearray(n + 1)

        def offer(i):
            j = after[i]
            if j < n and (r := ranks.get((word[i : end[i]], word[j : end[j]]))) is not None:
                heapq.heappush(heap, (r, i, end[i], end[j]))

        while heap:
            _, i, mid, last = heapq.heappop(heap)
            j = after[i]
            if dead[i] or end[i] != mid or j >= n or end[j] != last:
                continue
            dead[j], end[i], after[i] = 1, last, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        found, i = [], 0
        while i < n:
            found.append(word[i : end[i]])
            i = after[i]
        return found

    def word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            raw = word.encode()
            parts = self.merge_short(raw) if len(raw) <= SHORT else self.merge_long(raw)
            known = array("I", [self.ids[p] for p in parts]).tobytes()
            if len(raw) <= SHORT:
                if len(self.words) > KNOWN:
                    self.words.clear()
                self.words[word] = known
        return known

    def chunks(self, texts: list[str]) -> list[bytes]:
        found = []
        for text in texts:
            pieces = self.split.split(text) if self.split else [text]
            ids = []
            for piece in pieces:
                if piece in self.added:
                    ids.append(np.array([self.added[piece]], "<u4").tobytes())
                else:
                    ids += map(self.word, WORD.findall(piece))
            found.append(b"".join(ids))
        return found

    def decode(self, ids: list[int]) -> str:
        """Bytes of all parts, special ones too; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.parts.__getitem__, ids)).decode("utf-8", "replace")


def rank_table(path: str) -> RankTable:
    """One table for a worker process, kept from task to task."""
    if path not in _tables:
        _tables[path] = RankTable(path)
    return _tables[path]


def _ids(data: bytes) -> list[int]:
    return np.frombuffer(data, "<u4").tolist()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and ``ids``, the token ids of each whole text. Null and empty texts have none."""
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    return add_columns(docs, text, fields, lambda: (lambda texts: [[_ids(rank_table(path).encode(t)) for t in texts]]))


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The column ``ids`` and its decoded text ``text``; null ids give an empty text."""
    import pyarrow as pa

    def run(batches):
        table = rank_table(path)
        for batch in batches:
            given = batch.column(0)
            yield pa.RecordBatch.from_arrays([given, pa.array([table.decode(x or []) for x in given.to_pylist()])], names=[ids, text])

    schema = T.StructType([rows.schema[ids], T.StructField(text, T.StringType())])
    return rows.select(F.col(f"`{ids}`")).mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256.

    Null text is empty text; equal rows give equal rows; columns other than the two named ones are not read.
    """

    def make():
        table = rank_table(path)

        def work(texts):
            counts, keys, texts_back = [], [], []
            for t in texts:
                ids = _ids(table.encode(t))
                counts.append(len(ids))
                keys.append(hashlib.sha256(",".join(map(table.decimal.__getitem__, ids)).encode()).hexdigest())
                texts_back.append(hashlib.sha256(table.decode(ids).encode()).hexdigest())
            return counts, keys, texts_back

        return work

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return add_columns(rows, "text", fields, make, keep_text=False)
