"""Exact duplicates by deterministic block naming (operator 5), DataFrame functions only.

A normalised text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted, by a 64-bit digest and
then by their bytes, and a block's name is its rank. Then, level by level, adjacent pairs of names are sorted and named
in the same way until one name is left of each document. Equal texts end on the same level with the same name, and
different texts never do: every name stands for exactly one sequence of bytes. The bytes of blocks travel once, to be
compared; all else moves as integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import WS, name_keys
from hourline.session import stage

BLOCK = 4096


def normalised(text: Column) -> Column:
    """Every run of white space as one blank; null as empty. Only runs that are not a single blank are rewritten."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[\x09-\x0D][{WS}]*|\x20[{WS}]+", " ")


def _cut(text: Column, size: int) -> Column:
    data = text.cast("binary")
    n = F.greatest(F.lit(1), F.ceil(F.length(data) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def name_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK, digest=F.xxhash64) -> DataFrame:
    """One row per input row: ``row`` (a number of its own), ``doc_id``, ``text_sha256``, ``identity``.

    ``identity`` is equal for two rows exactly when their normalised texts are. `digest` only spreads the blocks;
    blocks that share one are told apart by their bytes. Null texts are empty texts; an empty table gives no rows.
    """
    clean = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("t"))
    hashes = F.transform(_cut(F.col("t"), size), lambda b: digest(b))
    rows = stage(
        clean.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2(F.col("t").cast("binary"), 256).alias("text_sha256"), hashes.alias("h")),
        "blocks",
    )
    occurrences = clean.select(F.explode(_cut(F.col("t"), size)).alias("b")).select(digest(F.col("b")).alias("h"), "b")
    seen = stage(occurrences.groupBy("h").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).select("h", (F.col("lo") != F.col("hi")).alias("clash")), "digests")
    parts = rows.select("row", F.posexplode("h").alias("pos", "h"))
    if seen.where("clash").isEmpty():
        names = name_keys(seen.select("h"), ["h"], "name", "block-names")
        parts = parts.join(names, "h").select("row", "pos", "name")
    else:
        rows, parts = _named_by_bytes(clean, seen, size, digest)
    return _fold(rows, stage(parts, "named-blocks"))


def _named_by_bytes(clean: DataFrame, seen: DataFrame, size: int, digest) -> tuple[DataFrame, DataFrame]:
    """For tables in which two blocks share a digest: the bytes of such blocks take part in the sort and in the join."""
    blocks = _cut(F.col("t"), size)
    sha = F.sha2(F.col("t").cast("binary"), 256)
    rows = stage(clean.select(F.monotonically_increasing_id().alias("row"), "doc_id", sha.alias("text_sha256"), blocks.alias("h")), "block-bytes")
    held = rows.select("row", F.posexplode("h").alias("pos", "b")).withColumn("h", digest(F.col("b")))
    held = held.join(seen, "h").select("row", "pos", "h", F.when(F.col("clash"), F.col("b")).alias("b"))
    names = name_keys(held.select("h", "b").distinct(), ["h", "b"], "name", "block-names")
    names = names.withColumnsRenamed({"h": "key", "b": "bytes"})
    return rows, held.join(names, (F.col("h") == F.col("key")) & F.col("b").eqNullSafe(F.col("bytes"))).select("row", "pos", "name")


def _fold(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Name adjacent pairs until one name of each row is left; ``identity`` is that name and its level."""
    level, done = 0, []
    alone = rows.select("row", F.size("h").alias("n"))
    most = alone.agg(F.max("n")).first()[0] or 0
    lengths = stage(alone, "block-counts")
    width = 1
    while True:
        ends = lengths.where(F.col("n").between(width // 2 + 1, width))
        done.append(parts.where("pos = 0").join(ends.select("row"), "row", "left_semi").select("row", (F.col("name") * 64 + level).alias("identity")))
        if width >= most:
            break
        open_rows = lengths.where(F.col("n") > width).select("row")
        pairs = parts.join(open_rows, "row", "left_semi").groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0).cast("long")).alias("b"),
        )
        pairs = stage(pairs, "pairs")
        names = name_keys(pairs.select("a", "b").distinct(), ["a", "b"], "name", "pair-names")
        parts = stage(pairs.join(names, ["a", "b"]).select("row", "pos", "name"), "named-pairs")
        width, level = width * 2, level + 1
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return rows.select("row", "doc_id", "text_sha256").join(named, "row")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK, digest=F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised text the one with the smallest doc_id stays (null ids last, repeated ids by position),
    so exactly one row of a group has ``kept``. Other columns of ``docs`` are not read.
    """
    named = stage(name_documents(docs, doc_id, text, size, digest), "identities")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = named.groupBy("identity").agg(first, F.count("*").alias("group_size"))
    return named.join(groups, "identity").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256"
    )
