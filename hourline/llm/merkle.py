"""Merkle manifest of a dataset and octopus multiproofs (operator 11).

Rows are leaves, sorted within their group; every ``ARITY`` consecutive nodes of a level become their digest until one is
left, and the groups' digests, sorted by group, form one more tree in the same way. All nodes are kept by their
coordinates (tree, level, place).

Leaves are proved in parts of a bounded number. A part works out which nodes next to its paths it can neither see nor
derive, the least union over all its leaves, and fetches those once; from them it derives the interiors that its leaves
share, and writes down each leaf's own proof from what it then has.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.llm.common import name_keys
from hourline.session import stage

ARITY, PART = 16, 1024
#: The tree over the groups; those of the groups have the numbers from 1.
TOP = 0
PROOF = ["tree", "place", "digest", "carried", "subroot", "left", "right"]


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: of each value, as text, its byte count, a colon and itself; a null is a dash."""
    texts = [v.cast("string") for v in values]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


@dataclass
class Manifest:
    """``leaves``: part, tree, place, size (leaves of the tree), digest, carried; ``nodes``: tree, level, place, digest;
    both written tables. ``trees`` is the number of groups, ``root`` the digest of all (None for a table without rows)."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None


def _levels(level_0: DataFrame, size: int) -> list[DataFrame]:
    """Tables tree, place, size, digest of every level, from that of the leaves; ``size`` is that of the largest tree."""
    levels = [level_0]
    while size > 1:
        run = F.array_sort(F.collect_list(F.struct("place", "digest")))
        joined = F.array_join(F.transform(run, lambda x: x["digest"]), "")
        last = levels[-1].where("size > 1").groupBy("tree", F.expr(f"place div {ARITY}").alias("place"), F.ceil(F.col("size") / ARITY).alias("size"))
        levels.append(stage(last.agg(F.sha2(joined, 256).alias("digest")), f"merkle-level-{len(levels)}"))
        size = -(-size // ARITY)
    return levels


def build(docs: DataFrame, values: list[str], group: str = "source", order: str = "doc_id", carry: list[Column] = (), part: int = PART) -> Manifest:
    """The manifest of all rows; ``values`` are the columns of a leaf, ``carry`` what the leaves table keeps beside them.

    Null groups are one group, the first; others follow by their bytes. Null orders come first, equal ones by digest, so
    that rows alike in all values may stand in any order. Texts are read once and not shuffled: only digests are.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    kept = F.struct(*carry) if carry else F.struct(F.col(order).alias(order))
    # The last sort key parts rows that are alike in all others, so that no range holds them all.
    rows = docs.select(key.alias("_key"), F.col(order).alias("_order"), leaf_digest(*[F.col(v) for v in values]).alias("digest"), kept.alias("carried"), F.monotonically_increasing_id().alias("_tie"))
    placed = name_keys(stage(rows, "merkle-rows"), ["_key", "_order", "digest", "_tie"], "_row", "merkle-order")
    sizes = stage(placed.groupBy("_key").agg(F.min("_row").alias("_first"), F.count("*").alias("size")), "merkle-sizes")
    named = stage(name_keys(sizes, ["_key"], "tree", "merkle-groups"), "merkle-trees")
    leaves = placed.join(named, "_key").select(
        F.expr(f"(_row - 1) div {part}").alias("part"), "tree", (F.col("_row") - F.col("_first")).alias("place"), "size", "digest", "carried"
    )
    leaves = stage(leaves, "merkle-leaves")
    trees, most = named.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    below = _levels(leaves.select("tree", "place", "size", "digest"), most)
    subroots = reduce(DataFrame.unionByName, below).where("size = 1")
    tops = subroots.select(F.lit(TOP).cast("long").alias("tree"), (F.col("tree") - 1).alias("place"), F.lit(trees).cast("long").alias("size"), "digest")
    above = _levels(stage(tops, "merkle-subroots"), trees)
    nodes = [n.select("tree", F.lit(i).alias("level"), "place", "digest") for levels in (below, above) for i, n in enumerate(levels)]
    root = above[-1].select("digest").first()
    return Manifest(leaves, reduce(DataFrame.unionByName, nodes), trees, root and root["digest"])


def missing(places: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Level by level, the places of the nodes needed beside those at and above the sorted, distinct ``places``."""
    level = 0
    while size > 1:
        above = np.unique(places // ARITY)
        runs = (above[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(runs[runs < size], places, assume_unique=True)
        places, size, level = above, -(-size // ARITY), level + 1


def _requests(trees: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [(tree, level, places) for tree, own in pdf.groupby("tree") for level, places in missing(np.unique(own["place"]), int(own["size"].iloc[0]))]
        found += [(TOP, level, places) for level, places in missing(np.unique(pdf["tree"]) - 1, trees)]
        flat = [(tree, level, p) for tree, level, places in found for p in places.tolist()]
        return pd.DataFrame(flat, columns=["tree", "level", "place"]).astype({"tree": "int64", "level": "int32", "place": "int64"}).assign(part=pdf["part"].iloc[0])

    return run


class _Tree:
    """What a part knows of a tree: digests by level and place, from its own leaves, fetched nodes and derived interiors."""

    def __init__(self, own: dict[int, str], size: int, fetched: dict[int, dict[int, str]]):
        self.levels, self.runs = [own], []
        level = 0
        while size > 1:
            have = {**fetched.get(level, {}), **self.levels[-1]}
            above: dict[int, str] = {}
            runs: dict[int, list[str]] = {}
            for p in {p // ARITY for p in self.levels[-1]}:
                runs[p] = [have[i] for i in range(p * ARITY, min((p + 1) * ARITY, size))]
                above[p] = hashlib.sha256("".join(runs[p]).encode()).hexdigest()
            self.runs.append(runs)
            self.levels.append(above)
            size, level = -(-size // ARITY), level + 1
        (self.top,) = self.levels[-1].values()
        self.known: dict[tuple[int, int], tuple[list[str], list[str]]] = {}

    def path(self, place: int, level: int = 0) -> tuple[list[str], list[str]]:
        """What stands left and right of the path's node at each level from ``level`` up."""
        if level == len(self.runs):
            return [], []
        above = self.known.get((level + 1, place // ARITY))
        if above is None:
            above = self.known[level + 1, place // ARITY] = self.path(place // ARITY, level + 1)
        run, i = self.runs[level][place // ARITY], place % ARITY
        return ["".join(run[:i]), *above[0]], ["".join(run[i + 1 :]), *above[1]]


def _expand(trees: int):
    def run(leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        if leaves.empty:
            return pd.DataFrame({c: [] for c in PROOF})
        got: dict[int, dict[int, dict[int, str]]] = defaultdict(lambda: defaultdict(dict))
        for tree, level, place, digest in zip(fetched["tree"], fetched["level"], fetched["place"], fetched["digest"]):
            got[tree][level][place] = digest
        own = {t: _Tree(dict(zip(x["place"], x["digest"])), int(x["size"].iloc[0]), got[t]) for t, x in leaves.groupby("tree")}
        top = _Tree({t - 1: x.top for t, x in own.items()}, trees, got[TOP])
        out = []
        for tree, place, digest, carried in zip(leaves["tree"], leaves["place"], leaves["digest"], leaves["carried"]):
            (left, right), (left_top, right_top) = own[tree].path(place), top.path(tree - 1)
            out.append((tree, place, digest, carried, own[tree].top, left + left_top, right + right_top))
        return pd.DataFrame(out, columns=PROOF)

    return run


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """tree, place, digest, carried, subroot, left and right of each wanted leaf (rows of ``manifest.leaves``, by default all).

    ``left`` and ``right`` hold, for each level up to the root, the digests before and behind the path's node, joined; a
    leaf alone in its tree has none there. A part's group has at most as many leaves as parts were cut for.
    """
    wanted = (manifest.leaves if wanted is None else wanted).select("part", "tree", "place", "size", "digest", "carried")
    asked = wanted.select("part", "tree", "place", "size").groupBy("part").applyInPandas(_requests(manifest.trees), "tree long, level int, place long, part long")
    fetched = stage(stage(asked, "merkle-missing").join(manifest.nodes, ["tree", "level", "place"]), "merkle-fetched")
    carried, texts = wanted.schema["carried"], T.ArrayType(T.StringType())
    kinds = [T.LongType(), T.LongType(), T.StringType(), carried.dataType, T.StringType(), texts, texts]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(PROOF, kinds)])
    return wanted.groupBy("part").cogroup(fetched.groupBy("part")).applyInPandas(_expand(manifest.trees), schema)


def siblings_digest(left: Column, right: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), ""), 256)


def fold(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf's digest leads to by its proof."""
    return F.aggregate(F.arrays_zip(left.alias("a"), right.alias("b")), leaf, lambda at, x: F.sha2(F.concat(x["a"], at, x["b"]), 256))
