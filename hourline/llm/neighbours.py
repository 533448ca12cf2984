"""Near-duplicate vectors by NN-descent (operator 7).

Equal vectors of one label are one node. Each node starts with neighbours from a few random-hyperplane buckets; then
rounds of neighbours-of-neighbours joins refine the lists: every node brings its neighbours (and those that list it)
together, which are compared with each other, and each keeps its best. Every pair met at the threshold joins its two nodes,
also where the lists have no place for it: ties, written apart, hold what the pairs met in a bucket or a round connect. A
list whose last entry still reaches the threshold is saturated. Parts with such a list are cut into cells of a small
radius, cells of different parts that may link are compared in full, and the lists are then enlarged to all of their
linked part, counted in blocks. A sample of nodes is searched by brute force in blocks; while the share of their links
found, a mean over nodes, falls short of the audit's aim for nodes with few links or for those with many, the graph is
refined further with more buckets and longer lists. Where links are so rare that the sample has too few nodes with any,
nodes that the graph links are searched as well, so that an audit without a node to measure means that neither way knows of
a link. A graph that changes no more and falls short is an error. Links are pairs of the graph at the threshold or above.
"""

from __future__ import annotations

import logging

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourline.llm.common import name_keys
from hourline.llm.components import components
from hourline.session import shuffle_partitions, stage

THRESHOLD, NEIGHBOURS, TABLES, ROUNDS = 0.98, 8, 4, 2
BUCKET, BLOCK = 256, 1024
AUDIT_RECALL, AUDIT_TURNS = 0.97, 3
#: Nodes searched by brute force: so many at first, then four times as many until AUDIT_LINKED of them have few links;
#: beyond AUDIT_MOST, AUDIT_NODES of those that the graph gives few links.
AUDIT_NODES, AUDIT_MOST, AUDIT_LINKED = 400, 6_400, 30
log = logging.getLogger(__name__)


def _usable(v: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that no square overflows or vanishes."""
    flat = np.asarray(column.flatten(), np.float64)
    m = flat.reshape(len(column), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _runs(batches, key: int):
    """Record batches cut so that rows with equal values in column ``key`` (they come together) stay together."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        keys = np.asarray(table.column(key).combine_chunks())
        new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        cut = int(new[-1]) if len(new) else 0
        rest = table.slice(cut)
        if cut:
            yield table.slice(0, cut).combine_chunks(), np.append(0, new)
    if rest is not None and rest.num_rows:
        keys = np.asarray(rest.column(key).combine_chunks())
        yield rest.combine_chunks(), np.append(np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys))


def _pairs(a, b, s) -> pa.RecordBatch:
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return pa.RecordBatch.from_arrays([pa.array(join(a, np.int64)), pa.array(join(b, np.int64)), pa.array(join(s, np.float64))], names=["u", "v", "s"])


PAIRS = "u long, v long, s double"


def _hang(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``root`` (the least place of each place's part) after places x and y of every pair are joined."""
    while True:
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            return root
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _ties(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Pairs without a cosine that connect what ``u`` and ``v`` connect, at most one for each node."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = _hang(np.arange(len(ids)), at[: len(u)], at[len(u) :])
    on = np.flatnonzero(root != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[on], pa.int64()), pa.array(ids[root[on]], pa.int64()), pa.nulls(len(on), pa.float64())], names=["u", "v", "s"])


def _best_of_buckets(k: int, threshold: float):
    """The k best neighbours of every row among all rows of its bucket, and ties; BUCKET rows are compared at a time."""

    def run(batches):
        for table, cuts in _runs(batches, 0):
            ids = np.asarray(table.column(1).combine_chunks())
            vectors = table.column(2).combine_chunks()
            a, b, s, tied = [], [], [], np.arange(len(ids))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo < 2:
                    continue
                m, own, n = _matrix(vectors.slice(lo, hi - lo)), ids[lo:hi], min(k, hi - lo - 1)
                root = np.arange(hi - lo)
                for x in range(0, hi - lo, BUCKET):
                    sims = m[x : x + BUCKET] @ m.T
                    here = np.arange(len(sims))
                    sims[here, x + here] = -2.0
                    top = np.argpartition(-sims, n - 1, axis=1)[:, :n]
                    a.append(np.repeat(own[x : x + BUCKET], n))
                    b.append(own[top].ravel())
                    s.append(np.take_along_axis(sims, top, 1).ravel())
                    at, to = np.nonzero(sims >= threshold)
                    root = _hang(root, x + at, to)
                tied[lo:hi] = lo + root
            yield _pairs(a, b, s)
            yield _ties(ids, ids[tied])

    return run


def _bits(count: int) -> int:
    """Bits of a code: a bucket of even data holds BUCKET nodes."""
    return max(1, min(60, int(np.ceil(np.log2(max(2, count / BUCKET))))))


def _tables(bits: int, threshold: float) -> int:
    """TABLES, or as many that a pair at the threshold shares a bucket of one of them as often as the audit asks."""
    one = (1.0 - np.arccos(threshold) / np.pi) ** bits
    return max(TABLES, int(np.ceil(np.log(1.0 - AUDIT_RECALL) / np.log1p(-min(one, 0.999)))))


def _first_lists(nodes: DataFrame, bits: int, k: int, numbers: range, turn: int, threshold: float) -> DataFrame:
    """Neighbours from one hyperplane code of so many bits for each of the table ``numbers``. Large buckets are dealt into
    parts by digest, so that none is a single task's work."""
    n, tables = shuffle_partitions(nodes.sparkSession), len(numbers)

    def code(batches):
        for batch in batches:
            ids, codes = np.asarray(batch.column(0)), np.zeros((tables, batch.num_rows), np.int64)
            lengths = np.asarray(pc.list_value_length(batch.column(1)))
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                m = _matrix(batch.column(1).take(pa.array(at)))
                for t in range(tables):
                    planes = np.random.default_rng([turn, numbers[t], dim]).standard_normal((dim, bits))
                    codes[t, at] = (m @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64))
            table = np.repeat(np.arange(tables, dtype=np.int32), len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(ids, tables)), pa.array(table), pa.array(codes.ravel())], names=["id", "t", "code"])

    coded = nodes.select("id", "vector").mapInArrow(code, "id long, t int, code long").join(nodes.select("id", "grp"), "id")
    coded = stage(coded, "codes")
    sizes = stage(coded.groupBy("grp", "t", "code").agg(F.ceil(F.count("*") / (16 * BUCKET)).alias("parts")), "code-sizes")
    bucket = F.xxhash64("grp", "t", "code", F.pmod(F.xxhash64("id", "t"), "parts"))
    placed = coded.join(sizes, ["grp", "t", "code"]).select(F.xxhash64(bucket, "grp").alias("bucket"), "id")
    rows = placed.join(nodes.select("id", "vector"), "id").select("bucket", "id", "vector")
    return rows.repartition(n, "bucket").sortWithinPartitions("bucket", "id").mapInArrow(_best_of_buckets(k, threshold), PAIRS)


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of each list, ties left out. Spark trims each task's share of a list before it is shuffled."""
    pairs = pairs.where(F.col("s").isNotNull()).groupBy("u", "v").agg(F.max("s").alias("s"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return pairs.withColumn("place", place).where(F.col("place") <= k).drop("place")


def _meet(lists: DataFrame, nodes: DataFrame, k: int, threshold: float) -> DataFrame:
    """One round: the neighbours of every node, listed by it or listing it, are compared with each other. What comes back
    are pairs that would enter the list of one of the two, and ties of all that reach the threshold."""
    back = _best(lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "s"), k)
    both = lists.select("u", "v").unionByName(back.select("u", "v")).distinct()
    worst = lists.groupBy("u").agg(F.when(F.count("*") >= k, F.min("s")).otherwise(F.lit(-2.0)).alias("least"))
    held = nodes.join(worst, nodes["id"] == worst["u"], "left").select(F.col("id").alias("v"), F.coalesce("least", F.lit(-2.0)).alias("least"), "vector")
    brought = both.join(held, "v").repartition(shuffle_partitions(nodes.sparkSession), "u").sortWithinPartitions("u", "v")

    def compare(batches):
        for table, cuts in _runs(batches, 0):
            ids, least = np.asarray(table.column(1).combine_chunks()), np.asarray(table.column(2).combine_chunks())
            vectors = table.column(3).combine_chunks()
            a, b, s, near, to = [], [], [], [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                m = _matrix(vectors.slice(lo, hi - lo))
                sims = m @ m.T
                np.fill_diagonal(sims, -3.0)
                x, y = np.nonzero(sims > least[lo:hi, None])
                a.append(ids[lo:hi][x])
                b.append(ids[lo:hi][y])
                s.append(sims[x, y])
                x, y = np.nonzero(sims >= threshold)
                near.append(ids[lo:hi][x])
                to.append(ids[lo:hi][y])
            yield _best_here(*_pairs(a, b, s).columns, k)
            yield _ties(np.concatenate(near), np.concatenate(to))

    return brought.select("u", "v", "least", "vector").mapInArrow(compare, PAIRS)


def _best_here(u, v, s, k: int) -> pa.RecordBatch:
    """The k best of each list in this batch: the map-side half of the merge."""
    u, v, s = (np.asarray(x) for x in (u, v, s))
    order = np.lexsort((v, -s, u))
    u, v, s = u[order], v[order], s[order]
    fresh = np.ones(len(u), bool)
    fresh[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, s = u[fresh], v[fresh], s[fresh]
    start = np.maximum.accumulate(np.where(np.append(True, u[1:] != u[:-1]), np.arange(len(u)), 0)) if len(u) else np.zeros(0, np.int64)
    on = np.arange(len(u)) - start < k
    return pa.RecordBatch.from_arrays([pa.array(u[on]), pa.array(v[on]), pa.array(s[on])], names=["u", "v", "s"])


def _block_counts(threshold: float):
    """Links of each member of a pair of blocks with members of the other; weights are the copies a node stands for."""

    def run(batches):
        for table, cuts in _runs(batches, 0):
            ids, side, weight = (np.asarray(table.column(i).combine_chunks()) for i in (1, 2, 3))
            vectors = table.column(4).combine_chunks()
            out, found = [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                left, right = np.flatnonzero(side[lo:hi] <= 1), np.flatnonzero(side[lo:hi] >= 1)
                m = _matrix(vectors.slice(lo, hi - lo))
                near = (m[left] @ m[right].T >= threshold).astype(np.float64)
                left, right = left + lo, right + lo
                same = bool((side[lo:hi] == 1).all())
                if same:
                    np.fill_diagonal(near, 0.0)
                    out.append(ids[left]), found.append(near @ weight[right])
                else:
                    out += [ids[left], ids[right]]
                    found += [near @ weight[right], weight[left] @ near]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(np.concatenate(found).astype(np.int64))], names=["u", "n"])

    return run


def _saturated(lists: DataFrame, roots: DataFrame, threshold: float, k: int) -> DataFrame:
    """root, node: all nodes of the linked parts with a saturated list."""
    full = lists.where(F.col("s") >= threshold).groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    return roots.join(full.join(roots, full["u"] == roots["node"]).select("root").distinct(), "root")


def _dealt(members: DataFrame, part: str) -> DataFrame:
    """The members (part, node), each in one of the blocks of about BLOCK nodes that a part is dealt into by digest."""
    sizes = members.groupBy(part).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    return members.join(sizes, part).select(part, "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"))


def _block_pairs(members: DataFrame, part: str) -> DataFrame:
    """pair, node, side: every two blocks of a part, and every block with itself (side 1), under one number."""
    other = _dealt(members, part).select(part, "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 1).when(F.col("own") < F.col("other"), 0).otherwise(2)
    pair = F.xxhash64(part, F.least("own", "other"), F.greatest("own", "other"))
    return other.select(pair.alias("pair"), "node", side.cast("int").alias("side"))


def _cells(threshold: float):
    """Blocks of a part in cells: a leader and the members within half the angle of the threshold that no cell before has.
    ``least`` is the cosine of the leader with the farthest of them."""
    inside = np.cos(np.arccos(threshold) / 2)

    def run(batches):
        for table, cuts in _runs(batches, 0):
            ids, root, grp = (np.asarray(table.column(i).combine_chunks()) for i in (1, 2, 3))
            vectors = table.column(4).combine_chunks()
            cell, least = np.zeros(len(ids), np.int64), np.zeros(len(ids))
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                m, free = _matrix(vectors.slice(lo, hi - lo)), np.ones(hi - lo, bool)
                while free.any():
                    first = int(np.argmax(free))
                    sims = m @ m[first]
                    mine = free & (sims >= inside)
                    mine[first] = True
                    cell[lo:hi][mine], least[lo:hi][mine] = ids[lo + first], sims[mine].min()
                    free &= ~mine
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, root, grp, cell, least)], names=["node", "root", "grp", "cell", "least"])

    return run


def _cells_that_may_link(threshold: float):
    """a, b: cells of different parts whose leaders are no farther apart than both radii and the threshold allow."""

    def run(batches):
        for table, cuts in _runs(batches, 0):
            ids, side, root, least = (np.asarray(table.column(i).combine_chunks()) for i in (1, 2, 3, 4))
            vectors, reach = table.column(5).combine_chunks(), np.arccos(np.clip(least, -1.0, 1.0))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                left, right = np.flatnonzero(side[lo:hi] <= 1), np.flatnonzero(side[lo:hi] >= 1)
                m = _matrix(vectors.slice(lo, hi - lo))
                angle = np.arccos(np.clip(m[left] @ m[right].T, -1.0, 1.0))
                left, right = left + lo, right + lo
                may = (angle <= reach[left][:, None] + reach[right] + np.arccos(threshold) + 1e-6) & (root[left][:, None] != root[right])
                x, y = np.nonzero(np.triu(may) if (side[lo:hi] == 1).all() else may)
                a.append(ids[left[x]])
                b.append(ids[right[y]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def _one_link(threshold: float):
    """u, v: one link of every two cells that have any."""

    def run(batches):
        for table, cuts in _runs(batches, 0):
            ids, side = (np.asarray(table.column(i).combine_chunks()) for i in (1, 2))
            vectors, u, v = table.column(3).combine_chunks(), [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                left, right = np.flatnonzero(side[lo:hi] == 0), np.flatnonzero(side[lo:hi] == 2)
                m = _matrix(vectors.slice(lo, hi - lo))
                near = m[left] @ m[right].T >= threshold
                if near.any():
                    x, y = np.unravel_index(np.argmax(near), near.shape)
                    u.append(ids[lo + left[x]])
                    v.append(ids[lo + right[y]])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _across(lists: DataFrame, nodes: DataFrame, roots: DataFrame, threshold: float, k: int) -> DataFrame:
    """u, v: links between different linked parts with saturated lists, whose lists have no place for each other; one for
    every two cells that link, so that no two such parts stay apart.

    Leaders of cells meet in blocks, those of one label with each other; two cells are compared in full only if they may
    link. Work grows with the pairs of leaders and of cells that may link; a task has two blocks or two cells at a time.
    """
    n, vector = shuffle_partitions(nodes.sparkSession), nodes.select(F.col("id").alias("node"), "grp", "vector")
    dealt = _dealt(_saturated(lists, roots, threshold, k), "root")
    rows = dealt.join(vector, "node").select(F.xxhash64("root", "own").alias("block"), "node", "root", "grp", "vector")
    rows = rows.repartition(n, "block").sortWithinPartitions("block", "node")
    cells = stage(rows.mapInArrow(_cells(threshold), "node long, root long, grp long, cell long, least double"), "cells")
    leaders = cells.where(F.col("node") == F.col("cell"))
    rows = _block_pairs(leaders.select("grp", "node"), "grp").join(leaders.select("node", "root", "least"), "node").join(vector, "node")
    rows = rows.select("pair", "node", "side", "root", "least", "vector").repartition(n, "pair").sortWithinPartitions("pair", "node")
    may = stage(rows.mapInArrow(_cells_that_may_link(threshold), "a long, b long"), "cells-that-may-link")
    two = F.array(F.struct(F.col("a").alias("cell"), F.lit(0).alias("side")), F.struct(F.col("b").alias("cell"), F.lit(2).alias("side")))
    sides = may.select(F.xxhash64("a", "b").alias("pair"), F.inline(two))
    rows = sides.join(cells.select("cell", "node"), "cell").join(vector, "node").select("pair", "node", "side", "vector")
    return rows.repartition(n, "pair").sortWithinPartitions("pair", "node").mapInArrow(_one_link(threshold), "u long, v long")


def _enlarged(lists: DataFrame, nodes: DataFrame, roots: DataFrame, threshold: float, k: int) -> DataFrame:
    """u, n: the weighted links of every node in a linked part with a saturated list, counted over all of that part.

    A part is dealt into blocks of about BLOCK nodes by digest, and every two blocks meet in one task; only counts leave
    it. Work grows with the pairs of the part, as the number of links does; memory and what is moved per task do not.
    """
    placed = _block_pairs(_saturated(lists, roots, threshold, k), "root")
    rows = placed.join(nodes.select(F.col("id").alias("node"), "weight", "vector"), "node").select("pair", "node", "side", "weight", "vector")
    rows = rows.repartition(shuffle_partitions(nodes.sparkSession), "pair").sortWithinPartitions("pair", "node")
    return rows.mapInArrow(_block_counts(threshold), "u long, n long").groupBy("u").agg(F.sum("n").alias("n"))


def _digest(lists: DataFrame, threshold: float, k: int) -> tuple:
    """Number and digest of the links of lists that are not saturated."""
    own = lists.where(F.col("s") >= threshold).groupBy("u").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    return tuple(own.where(F.col("n") < k).agg(F.sum("n"), F.sum("h")).first())


def _search(asked: pd.DataFrame, nodes: DataFrame, threshold: float) -> pd.DataFrame:
    """id, true, links: the weighted and the plain number of links of the asked nodes that have any, by brute force."""
    asked = [(g, x["id"].to_numpy(), _matrix(pa.array(x["vector"].tolist()))) for g, x in asked.groupby("grp")]

    def search(batches):
        for batch in batches:
            ids, grp, weight = (np.asarray(batch.column(i)) for i in range(3))
            for g, own, q in asked:
                on = np.flatnonzero(grp == g)
                if len(on):
                    near = (_matrix(batch.column(3).take(pa.array(on))) @ q.T >= threshold) & (ids[on][:, None] != own)
                    some = near.any(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array((weight[on] @ near)[some].astype(np.int64)), pa.array(near.sum(axis=0)[some])], names=["id", "true", "links"])

    found = nodes.select("id", "grp", "weight", "vector").mapInArrow(search, "id long, true long, links long")
    return found.groupBy("id").agg(F.sum("true").alias("true"), F.sum("links").alias("links")).toPandas()


def _truth(nodes: DataFrame, count: int, threshold: float, k: int) -> pd.DataFrame:
    """The search of nodes drawn by digest, more of them until AUDIT_LINKED have at least one
    link and fewer than k, all nodes are drawn, or AUDIT_MOST."""
    most = AUDIT_NODES
    while True:
        drawn = F.pmod(F.xxhash64("id", F.lit("audit")), F.lit(1 << 30)) < int(np.ceil(min(1.0, most / count) * (1 << 30)))
        found = _search(nodes.where(drawn).select("id", "grp", "vector").toPandas(), nodes, threshold)
        if (found["links"] < k).sum() >= AUDIT_LINKED or most >= min(count, AUDIT_MOST):
            return found
        most *= 4


def _linked(truth: pd.DataFrame, nodes: DataFrame, links: DataFrame, threshold: float, k: int) -> pd.DataFrame:
    """The search with AUDIT_NODES nodes more, of those that ``links`` (u, n) gives few links, by digest, where it has too
    few of them."""
    if (truth["links"] < k).sum() >= AUDIT_LINKED:
        return truth
    few = links.where((F.col("n") > 0) & (F.col("n") < k)).orderBy(F.xxhash64("u", F.lit("audit")), "u").limit(AUDIT_NODES).select(F.col("u").alias("id"))
    asked = nodes.join(F.broadcast(few), "id").select("id", "grp", "vector").toPandas()
    return pd.concat([truth, _search(asked, nodes, threshold)]).drop_duplicates("id") if len(asked) else truth


def _recall(truth: pd.DataFrame, links: DataFrame, k: int) -> dict[str, tuple[float, int]]:
    """Mean over the searched nodes of the share of their links that ``links`` (u, n) counts, and their number; nodes with
    fewer than k links apart from the others."""
    if truth.empty:
        return {}
    asked = links.sparkSession.createDataFrame(truth[["id"]])
    n = links.join(F.broadcast(asked), links["u"] == asked["id"]).select("id", "n").toPandas().set_index("id")["n"]
    share = (truth["id"].map(n).fillna(0) / truth["true"]).clip(upper=1.0)
    return {name: (float(share[on].mean()), int(on.sum())) for name, on in (("few", truth["links"] < k), ("many", truth["links"] >= k)) if on.any()}


def link_vectors(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, k: int = NEIGHBOURS
) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly), component_id, kept.

    Only rows with equal, non-null labels and equal numbers of dimensions are compared. Rows whose vector is null, empty,
    zero or holds a null, NaN or infinity link with nothing: n_links 0, their own component. Rows that repeat an id count
    each for itself: with the same vector as copies, with another as any other row. A row with a null id is compared too;
    its component is the smallest id it reaches, null where it reaches none, and it is not kept.
    """
    kind = "array<float>" if rows.select(vector).dtypes[0][1] == "array<float>" else "array<double>"
    given = rows.select(F.col(id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast(kind).alias("vector"))
    usable = F.col("label").isNotNull() & F.coalesce(_usable(F.col("vector")), F.lit(False))
    good = given.where(usable).withColumn("grp", F.xxhash64("label", F.size("vector")))
    classes = good.groupBy("label", "grp", "vector").agg(F.min("id").alias("first"), F.count("*").cast("double").alias("weight"))
    # Numbered by their smallest ids, so that the smallest node of a component has the component's smallest id.
    classes = classes.withColumns({"last": F.col("first").isNull(), "digest": F.xxhash64("vector")})
    nodes = stage(name_keys(classes, ["last", "first", "grp", "digest"], "id", "vector-order").drop("last", "digest"), "vectors")
    member = good.join(nodes.select(F.col("id").alias("node"), "label", "vector", "weight", "first"), ["label", "vector"]).select("id", "node", "weight", "first")
    member = stage(member, "classes")
    count = nodes.count()
    lists, links, roots, ties, size, turn, before = None, None, None, None, k, 0, None
    bits = _bits(count)
    tables, truth = _tables(bits, threshold), _truth(nodes, count, threshold, k) if count > 1 else None
    while count > 1:
        for start in range(0, tables, TABLES):  # some tables at a time, as each moves all vectors
            met = stage(_first_lists(nodes, bits, size, range(start, min(tables, start + TABLES)), turn, threshold), "met")
            lists = stage(_best(met if lists is None else met.unionByName(lists), size), "lists")
            tied = met.where(F.col("s").isNull()).select("u", "v")
            ties = tied if ties is None else ties.unionByName(tied)
        rounds, last, now = 0, None, _digest(lists, threshold, size)
        while rounds < ROUNDS or now != last:
            met = stage(_meet(lists, nodes, size, threshold), "met")
            lists = stage(_best(met.unionByName(lists), size), "lists")
            ties = ties.unionByName(met.where(F.col("s").isNull()).select("u", "v"))
            rounds, last, now = rounds + 1, now, _digest(lists, threshold, size)
        near = lists.where(F.col("s") >= threshold)
        near = stage(near.unionByName(near.select(F.col("v").alias("u"), F.col("u").alias("v"), "s")).groupBy("u", "v").agg(F.max("s").alias("s")), "near")
        joined = ties.unionByName(near.select("u", "v"))
        roots = stage(components(joined, "u", "v"), "vector-roots")
        across = stage(_across(lists, nodes, roots, threshold, size), "across")
        if not across.isEmpty():
            ties = ties.unionByName(across)
            roots = stage(components(joined.unionByName(across), "u", "v"), "vector-roots")
        listed = near.join(nodes.select(F.col("id").alias("v"), "weight"), "v").groupBy("u").agg(F.sum("weight").cast("long").alias("n"))
        whole = stage(_enlarged(lists, nodes, roots, threshold, size), "enlarged")
        links = stage(listed.join(whole.select("u"), "u", "left_anti").unionByName(whole), "vector-links")
        truth = _linked(truth, nodes, links, threshold, k)
        recall = _recall(truth, links, k)
        log.info("mean share of their links found of the audited nodes, and these nodes: %s", recall)
        if all(share >= AUDIT_RECALL for share, _ in recall.values()):
            break
        if turn + 1 >= AUDIT_TURNS and now == before:
            raise RuntimeError(f"the links change no more, but the audit finds {recall}, below {AUDIT_RECALL}")
        turn, tables, before = turn + 1, tables * 2, now
        size *= 2 if turn < AUDIT_TURNS else 1
    if links is None:
        found = member.select("id", (F.col("weight") - 1).cast("long").alias("n_links"), F.col("first").alias("component_id"))
    else:
        # The first id of every root, joined to what hangs on it: one row for each node that is linked.
        hung = stage(roots.join(nodes.select(F.col("id").alias("root"), F.col("first").alias("component")), "root").select(F.col("node").alias("member"), "component"), "vector-components")
        found = member.join(links, member["node"] == links["u"], "left").join(hung, F.col("node") == F.col("member"), "left")
        found = found.select(
            "id", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).cast("long").alias("n_links"),
            F.when(F.col("member").isNull(), F.col("first")).otherwise(F.col("component")).alias("component_id"),
        )
    rest = given.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.unionByName(rest).select(F.col("id").alias(id), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
