"""Bounded-space online packing into fixed-length sequences (operator 3).

A task reads its documents once and holds OPEN windows at most. Full-length pieces of a long document are sequences by
themselves; what is left of it goes to the open window that it fits best, and when it fits none, the fullest window is
emitted and a new one opened. What is still open when a task ends is packed again in fewer tasks, round by round, until
one task holds all that is left, which is then a bounded number of windows. Sequence ids are made of round, task and a
counter, so nothing is numbered over all data.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import slices
from hourline.llm.tokens import library_encoder
from hourline.session import stage

OPEN = 64
#: Open windows that one task of a later round takes over.
MERGE = 4096

PIECES = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_()), ("ids", pa.binary()),
]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, open boolean, ids binary"


class Windows:
    """Open windows by room left; ``place`` returns the pieces of a window that had to be emitted, if any."""

    def __init__(self, size: int, most: int, first_id: int):
        self.size, self.most, self.next_id = size, most, first_id
        self.room: list[tuple[int, int]] = []  # (room, window), ascending
        self.held: dict[int, list] = {}

    def place(self, piece: list, length: int) -> list:
        out, at = [], bisect_left(self.room, (length, -1))
        if at < len(self.room):  # the least room that holds it
            room, window = self.room.pop(at)
        else:
            if len(self.room) >= self.most:
                out = self.held.pop(self.room.pop(0)[1])  # the fullest
            room, window = self.size, self.new_id()
            self.held[window] = []
        self.held[window].append([*piece, window, self.size - room])
        if room > length:
            insort(self.room, (room - length, window))
            return out
        return out + self.held.pop(window)

    def new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1


def _batch(rows: list, is_open: bool) -> pa.RecordBatch:
    """rows: doc_id, start, length, crc, doc_tokens, ids, sequence, offset."""
    columns = list(zip(*rows)) or [()] * 8
    columns = [*columns[:5], columns[6], columns[7], [is_open] * len(rows), columns[5]]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(columns, PIECES)], names=[n for n, _ in PIECES])


def _first_id(turn: int) -> int:
    return (turn << 58) | (TaskContext.get().partitionId() << 34)


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, size: int = 1024, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False, most: int = OPEN
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``ids`` too on request.

    A document is the ids of its whole text (null: none) and ``end_id``; it is cut only into pieces of ``size``, and its
    rest. Every id lies in one piece, the pieces of a sequence follow each other without a gap from 0. Documents are told
    apart by row, so repeated and null ids do no harm. An empty table gives no piece.
    """

    def first(batches):
        encoder, windows, end = library_encoder(tokenizer), Windows(size, most, _first_id(0)), int(end_id).to_bytes(4, "little")
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = []
                for d, ids in zip(part.column(0).to_pylist(), encoder.encode_all(texts)):
                    ids += end
                    n = len(ids) // 4
                    for at in range(0, n, size):
                        own = ids[4 * at : 4 * (at + size)]
                        length = len(own) // 4
                        piece = [d, at, length, zlib.crc32(own), n, own if with_ids else None]
                        if length == size:
                            rows.append([*piece, windows.new_id(), 0])
                        else:
                            rows += windows.place(piece, length)
                yield _batch(rows, False)
        yield _batch([p for w in windows.held.values() for p in w], True)

    def again(turn):
        def run(batches):
            windows = Windows(size, most, _first_id(turn))
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    rows += windows.place([r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], r["ids"]], r["length"])
                yield _batch(rows, False)
            yield _batch([p for w in windows.held.values() for p in w], True)

        return run

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stage(rows.mapInArrow(first, SCHEMA), "pieces")
    done, left, turn, tasks = pieces.where("not open"), pieces.where("open"), 0, None
    while tasks != 1:
        windows = left.agg(F.count_if(F.col("offset") == 0)).first()[0]
        # A task leaves ``most`` windows at most; taking over twice as many makes every round smaller than the last.
        tasks, turn = max(1, -(-windows // max(MERGE, 2 * most))), turn + 1
        # Longest first in each task, so that large rests meet windows that are still empty.
        spread = left.repartition(tasks).sortWithinPartitions(F.col("length").desc(), "doc_id", "start")
        pieces = stage(spread.mapInArrow(again(turn), SCHEMA), f"pieces-{turn}")
        done, left = done.unionByName(pieces.where("not open")), pieces.where("open")
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return done.unionByName(left).select(*kept)

