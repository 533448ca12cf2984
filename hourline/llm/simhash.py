"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing (operator 9).

Every bit position of a fingerprint gets a non-zero vector of RADIUS + 1 bits. For each of the 2**(RADIUS + 1) - 1
non-zero vectors v, a mask keeps the positions whose vector has an odd product with v. Any RADIUS positions leave some v
that is orthogonal to all of theirs, so the mask of that v drops all of them: two fingerprints that differ in at most
RADIUS bits agree under some mask, always. Each mask is a table; fingerprints in one bucket of a table are compared.

A bucket of more than BUCKET fingerprints is not compared but covered again: its dropped positions are given vectors
anew, and the pairs in it agree under one of the finer masks. That ends at masks that drop RADIUS positions or fewer,
whose buckets hold 2**RADIUS fingerprints at most, so no link is lost and no task sees a large bucket.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import add_columns, unused
from hourline.llm.components import components
from hourline.session import shuffle_partitions, stage

RADIUS, SHINGLE, BUCKET = 3, 3, 512
_ONE = np.uint64(1)
_BITS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """64 bits, set where over half of the shingles' hashes have them; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int((_ONE << _BITS[ones * 2 > len(hashes)]).sum(dtype=np.uint64))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", keep_text: bool = True) -> DataFrame:
    """All columns and the fingerprint as a signed long. A-Z count as a-z; words end at ASCII white space."""
    return add_columns(docs, text, [T.StructField(name, T.LongType())], lambda: (lambda texts: [[signed(fingerprint(t)) for t in texts]]), keep_text)


def finer_masks(mask: int) -> list[int]:
    """Masks that keep ``mask`` and, of the positions it drops, those picked by each vector; every set of RADIUS dropped
    positions stays dropped in one of them. There are none once no more than RADIUS positions are dropped."""
    dropped = [i for i in range(64) if not mask >> i & 1]
    if len(dropped) <= RADIUS:
        return []
    # Unit vectors first: the vectors of any dropped set then span all RADIUS + 1 dimensions, so no mask stays as it was.
    vectors = sorted(range(1, 1 << (RADIUS + 1)), key=lambda v: (v.bit_count(), v))
    of = {bit: vectors[k % len(vectors)] for k, bit in enumerate(dropped)}
    return sorted({mask | sum(1 << bit for bit in dropped if (of[bit] & v).bit_count() % 2) for v in vectors})


def _buckets(fps: DataFrame, masks: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (mask, key, fp) of buckets with two fingerprints or more: those to compare, those to cover again."""
    if on:
        given = fps.join(F.broadcast(masks), on).select("finer", "fp").distinct()
    else:
        given = fps.select("fp", F.explode(F.array(*[F.lit(signed(m)).cast("long") for m in finer_masks(0)])).alias("finer"))
    rows = stage(given.select(F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("key"), "fp"), "masked")
    shared = stage(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    held = stage(rows.join(shared, ["mask", "key"]), "members")
    return held.where(F.col("n") <= BUCKET), held.where(F.col("n") > BUCKET)


def _links(batches):
    """Links of each bucket to the least member of its linked part; rows come sorted by bucket."""
    rest = None
    for batch in batches:
        arrays = [np.asarray(batch.column(i)) for i in range(3)]
        if rest is not None:
            arrays = [np.concatenate([r, x]) for r, x in zip(rest, arrays)]
        mask, key, fp = arrays
        new = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
        cut = int(new[-1]) if len(new) else 0  # the last bucket may go on in the next batch
        rest = [x[cut:] for x in arrays]
        yield _compare(fp[:cut], np.concatenate([[0], new[:-1]]).astype(np.int64) if cut else new[:0])
    if rest is not None:
        yield _compare(rest[2], np.zeros(1, np.int64))


def _compare(fp: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """``starts``: where the buckets begin. Members at distance d in the same bucket are compared for d = 1, 2, ..."""
    a, b = [], []
    if len(fp):
        ends = np.append(starts[1:], len(fp))
        left = np.repeat(ends, ends - starts) - np.arange(len(fp)) - 1  # members that follow in the bucket
        at, d = np.flatnonzero(left >= 1), 1
        bits = fp.view(np.uint64)
        label = np.arange(len(fp))
        while len(at):
            near = at[np.bitwise_count(bits[at] ^ bits[at + d]) <= RADIUS]
            for i in near[label[near] != label[near + d]]:  # only links that join two parts of the bucket
                p, q = _root(label, i), _root(label, i + d)
                if p != q:
                    label[max(p, q)] = min(p, q)
                    a.append(fp[i])
                    b.append(fp[i + d])
            d += 1
            at = at[left[at] >= d]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _root(label: np.ndarray, i: int) -> int:
    while label[i] != i:
        label[i] = label[label[i]]
        i = label[i]
    return i


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) at RADIUS bits or fewer: not all of them, but enough that
    what they connect is what all of them connect."""
    n = shuffle_partitions(fps.sparkSession)
    compare, again = _buckets(fps, None, [])
    found = None
    while True:
        linked = compare.select("mask", "key", "fp").repartition(n, "mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(_links, "a long, b long")
        linked = stage(linked, "bucket-links")
        found = linked if found is None else found.unionByName(linked)
        coarse = [r["mask"] for r in again.select("mask").distinct().collect()]  # masks, not fingerprints
        if not coarse:
            return found
        finer = [(m, signed(f)) for m in coarse for f in finer_masks(m & (1 << 64) - 1)]
        masks = fps.sparkSession.createDataFrame(finer, "mask long, finer long")
        compare, again = _buckets(again.select("mask", "fp"), masks, ["mask"])


def near_duplicates(rows: DataFrame, id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """One row per input row: id, fp, component_id, the smallest id that links of RADIUS bits or fewer reach.

    Rows with equal fingerprints are one node, so copies cost nothing. Null ids are passed over in the minimum and get
    the component of their fingerprint; rows with nothing but null ids get null. Give a written table: it is read twice.
    """
    rows = rows.select(F.col(id).alias("id"), F.col(fp).alias("fp"))
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprints")
    roots = components(fingerprint_links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "rooted")
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(groups, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(F.col("id").alias(id), F.col("fp").alias(fp), "component_id")


def near_duplicate_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id, one row per input row."""
    rows = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", keep_text=False)
    found = near_duplicates(stage(rows, "simhash"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs``, one row of each linked group: that of the smallest id (null ids last, then by position)."""
    row, print_ = unused(docs, "_row"), unused(docs, "_fingerprint")
    held = fingerprints(docs.withColumn(row, F.monotonically_increasing_id()), text, print_)
    held = stage(held, "simhash-documents")
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    firsts = held.groupBy(F.col(print_).alias("fp")).agg(F.min(order).alias("first"))
    found = near_duplicates(stage(firsts.select("fp", F.col("first").alias("o")), "firsts"), "o")
    kept = found.where(F.col("o") == F.col("component_id")).select(F.col("o.row").alias(row))
    return held.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
