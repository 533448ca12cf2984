"""Token ids as length-delimited binary records with an offset index (operator 2).

File format, all integers little-endian. A record: length (unsigned 64 bits), masked CRC-32C of those 8 bytes, data,
masked CRC-32C of the data; the mask is ``rotate_right(crc, 15) + 0xa282ead8``, as in public record files of this
kind. The data: 1 byte (1 if there is a doc_id), 1 byte (2 or 4, the bytes of an id), doc_id (signed 64 bits), then the
ids as unsigned integers. Ids take 2 bytes where the vocabulary and the end id fit, else 4.
The index file beside each record file: one (offset, length) pair of unsigned 64-bit integers per record, so that a
reader can take records in any order.

Files are written by tasks below a folder that all executors share, under names of their own attempt; the staged
manifest of finished tasks tells which of them count, so a lost or repeated attempt leaves only unused files.
"""

from __future__ import annotations

import random
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourline.llm.common import slices
from hourline.llm.tokens import library_encoder
from hourline.session import scratch_path, shuffle_partitions, stage

SHARD_BYTES = 64 << 20
HEAD = 10
_LANE = 256


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1).astype(np.uint32)
    return table


_BYTE = _crc_table()


def _two_byte_table() -> np.ndarray:
    crc = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(2):
        crc = _BYTE[crc & 255] ^ (crc >> 8)
    return crc


_TWO = _two_byte_table()


def _apply(op: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return op[0][crc & 255] ^ op[1][(crc >> 8) & 255] ^ op[2][(crc >> 16) & 255] ^ op[3][crc >> 24]


def _zero_operators() -> list[np.ndarray]:
    """Tables that carry a checksum over 1, 2, 4, ... zero bytes."""
    one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * p) for p in range(4)])
    one = (_BYTE[one & 255] ^ (one >> 8)).astype(np.uint32)
    found = [one]
    while len(found) < 40:
        found.append(np.stack([_apply(found[-1], found[-1][p]) for p in range(4)]))
    return found


_ZEROS = _zero_operators()


def masked_crc32c(items: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each item. All items advance together: each is padded in front, where zeros change nothing,
    and cut into lanes whose checksums are then chained."""
    if not items:
        return np.zeros(0, np.uint32)
    lengths = np.array([len(x) for x in items], np.int64)
    lanes = np.maximum(1, -(-lengths // _LANE))
    ends = np.cumsum(lanes)
    data = np.zeros(int(ends[-1]) * _LANE, np.uint8)
    for x, end in zip(items, (ends * _LANE).tolist()):
        data[end - len(x) : end] = np.frombuffer(x, np.uint8)
    columns = np.ascontiguousarray(data.view("<u2").reshape(-1, _LANE // 2).T)
    crc = np.zeros(int(ends[-1]), np.uint32)
    for column in columns:
        crc = _TWO[(crc ^ column) & 0xFFFF] ^ (crc >> 16)
    starts, total = ends - lanes, np.zeros(len(items), np.uint32)
    for k in range(int(lanes.max())):
        on = np.flatnonzero(lanes > k)
        total[on] = _apply(_ZEROS[_LANE.bit_length() - 1], total[on]) ^ crc[starts[on] + k]
    first = np.full(len(items), 0xFFFFFFFF, np.uint32)
    for bit in range(int(lengths.max()).bit_length()):
        on = np.flatnonzero((lengths >> bit) & 1)
        first[on] = _apply(_ZEROS[bit], first[on])
    crc = total ^ first ^ np.uint32(0xFFFFFFFF)
    return ((crc >> 15) | (crc << 17)) + np.uint32(0xA282EAD8)


def frame(items: list[bytes]) -> list[bytes]:
    sizes = [len(x).to_bytes(8, "little") for x in items]
    of_size, of_data = masked_crc32c(sizes), masked_crc32c(items)
    return [n + int(a).to_bytes(4, "little") + x + int(b).to_bytes(4, "little") for n, a, x, b in zip(sizes, of_size, items, of_data)]


def unframe(blobs: list[bytes]) -> list[bytes]:
    """The data of whole records; raises ValueError where a length or a checksum does not fit."""
    sizes, items = [b[:8] for b in blobs], [b[12:-4] for b in blobs]
    given = [(b[8:12], b[-4:]) for b in blobs]
    for n, x, (a, b), ca, cb in zip(sizes, items, given, masked_crc32c(sizes), masked_crc32c(items)):
        if int.from_bytes(n, "little") != len(x) or a != int(ca).to_bytes(4, "little") or b != int(cb).to_bytes(4, "little"):
            raise ValueError("damaged record")
    return items


def serialise(doc_id: int | None, ids: bytes, width: int = 4) -> bytes:
    """``ids`` as unsigned 32-bit integers, all below 2**16 where ``width`` is 2."""
    if width == 2:
        ids = np.frombuffer(ids, "<u4").astype("<u2").tobytes()
    return bytes([doc_id is not None, width]) + (doc_id or 0).to_bytes(8, "little", signed=True) + ids


def parse(data: bytes) -> tuple[int | None, bytes]:
    ids = data[HEAD:]
    if data[1] == 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return (int.from_bytes(data[2:HEAD], "little", signed=True) if data[0] else None), ids


class _Shards:
    """The record and index files of one task; a file is closed at SHARD_BYTES."""

    def __init__(self, folder: str, width: int):
        self.width = width
        self.fs, self.root = pyarrow.fs.FileSystem.from_uri(folder)
        self.folder, self.task, self.attempt = folder, TaskContext.get().partitionId(), uuid.uuid4().hex
        self.shard, self.out, self.done = 0, None, []

    def add(self, blobs: list[bytes], tokens: list[int]) -> None:
        for blob, n in zip(blobs, tokens):
            if self.out is None:
                self.name = f"part-{self.task:06d}-{self.shard:04d}-{self.attempt}"
                self.out, self.index, self.at, self.tokens = self.fs.open_output_stream(f"{self.root}/{self.name}.rec"), [], 0, 0
            self.out.write(blob)
            self.index += [self.at, len(blob)]
            self.at, self.tokens = self.at + len(blob), self.tokens + n
            if self.at >= SHARD_BYTES:
                self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            with self.fs.open_output_stream(f"{self.root}/{self.name}.idx") as f:
                f.write(np.array(self.index, "<u8").tobytes())
            self.done.append((self.task, self.shard, self.name, len(self.index) // 2, self.tokens, self.at, self.width))
            self.shard, self.out = self.shard + 1, None


MANIFEST = "task int, shard int, name string, records long, tokens long, bytes long, width int"
_MANIFEST = pa.schema([("task", pa.int32()), ("shard", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64()), ("width", pa.int32())])


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write each whole text's ids and ``end_id`` as one record, in ascending doc_id order over all files.

    Returns the staged manifest, a row per file. Null ids come first, repeated ids keep their input order; a null text
    is empty and gives the end id alone. An empty table gives no file.
    """

    def write(batches):
        encoder, end = library_encoder(tokenizer), int(end_id).to_bytes(4, "little")
        shards = _Shards(folder, 2 if max(encoder.size - 1, end_id) < 1 << 16 else 4)
        shards.fs.create_dir(shards.root, recursive=True)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids = [x + end for x in encoder.encode_all(texts)]
                data = [serialise(d, x, shards.width) for d, x in zip(part.column(0).to_pylist(), ids)]
                shards.add(frame(data), [len(x) // 4 for x in ids])
        shards.close()
        columns = list(zip(*shards.done)) or [()] * len(_MANIFEST)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _MANIFEST)], schema=_MANIFEST)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("at"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("at")]
    n = max(shuffle_partitions(docs.sparkSession), docs.sparkSession.sparkContext.defaultParallelism)
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stage(placed.mapInArrow(write, MANIFEST), "record-manifest")


def read_records(manifest: DataFrame, folder: str, shuffle_seed: int | None = None) -> DataFrame:
    """The records of the manifest's files: task, shard, position (in the file), doc_id, before (ids before it in the
    file), ids (bytes). With a seed, each file is read through its index in a shuffled order. Every checksum is checked."""

    def read(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_stream(f"{root}/{row['name']}.idx") as f:
                    index = np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)
                width = row["width"]
                before = np.concatenate([[0], np.cumsum((index[:, 1] - 16 - HEAD) // width)])
                order = list(range(len(index)))
                if shuffle_seed is not None:
                    random.Random(f"{shuffle_seed}/{row['name']}").shuffle(order)
                with fs.open_input_file(f"{root}/{row['name']}.rec") as f:
                    for i in range(0, len(order), 512):
                        some = order[i : i + 512]
                        found = [parse(x) for x in unframe([f.read_at(int(index[k, 1]), int(index[k, 0])) for k in some])]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["task"]] * len(some), pa.int32()),
                                pa.array([row["shard"]] * len(some), pa.int32()),
                                pa.array(some, pa.int64()),
                                pa.array([d for d, _ in found], pa.int64()),
                                pa.array(before[some], pa.int64()),
                                pa.array([x for _, x in found], pa.binary()),
                            ],
                            names=["task", "shard", "position", "doc_id", "before", "ids"],
                        )

    n = max(shuffle_partitions(manifest.sparkSession), manifest.sparkSession.sparkContext.defaultParallelism)
    schema = "task int, shard int, position long, doc_id long, before long, ids binary"
    return manifest.repartition(n).mapInArrow(read, schema)


def record_digests(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the records, read them back, one row per document: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it in doc_id order, over all files.
    """
    folder = scratch_path(docs.sparkSession, "records")
    manifest = write_records(docs, tokenizer, end_id, folder, doc_id, text)
    # One row per file of up to 64 MB: the running total over files is narrow.
    before = Window.orderBy("task", "shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("task", "shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("files_before"))
    rows = read_records(manifest, folder).select(
        "task", "shard", "doc_id", "before", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    # One row per file of up to 64 MB.
    return rows.join(F.broadcast(starts), ["task", "shard"]).select("doc_id", (F.col("files_before") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")

