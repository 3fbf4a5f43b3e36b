"""Embedding near-dedup by a forest of random-projection trees with spill.

A tree splits the vectors again and again by their projection on a random direction. The cut lies, within
the middle half of the node, where the fewest vectors are near it, and vectors within ``SPILL`` of
the cut go to both sides. Vectors that share a leaf in any of ``TREES`` trees are compared by cosine in
double precision; links are pairs with at least ``THRESHOLD``.

The tops of the trees are planned on the driver by a bounded sample (``SAMPLE_ROWS`` distinct vectors, the
smallest hashes), every vector is indexed. A node becomes a leaf when it is expected to hold ``LEAF_ROWS``
vectors, or when its vectors are so close together that cuts would only copy them. Where the sample ends
before the leaves are that small they stay open: rounds of ``ROUND_DEPTH`` more levels, planned in tasks
on ``PLAN_ROWS`` vectors or so of each open leaf, go on until every leaf is small or close together. A round
moves the vectors of open leaves once, and the driver learns only whether there is another round. A leaf
that holds more than ``BLOCK_ROWS`` is compared in pairs of blocks, each a group of its own.

Equal vectors are one vector with a number of copies, told by a digest of 128 bits. Vectors travel in their
own precision. A pair that meets in several leaves counts in the first one only, which both vectors' lists
of leaves tell, so groups report one count per vector and the links that connect them, never all pairs.

Defined results: null, empty and zero vectors and vectors that hold null or non-finite numbers link
with nothing and are their own component; vectors of different lengths never link; rows without an id
take no part, their component is null; rows with equal ids stay apart and share the smaller component.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialweave.llm.components import Joined, components
from trialweave.session import remove_folder, scratch_path

THRESHOLD = 0.9
TREES = 10
# In standard deviations of the projections of random unit vectors.
SPILL = 0.12
LEAF_ROWS = 1000
BLOCK_ROWS = 8000
SAMPLE_ROWS = 16_384
LEAST_SAMPLE = 1024
# Long vectors get a smaller sample, so that it stays small on the driver.
SAMPLE_VALUES = 4_000_000
MAX_DEPTH = 32
LEAST_ROWS = 16
ROUND_DEPTH = 4
PLAN_ROWS = 1024
SEED = 20_231
# A leaf's code: tree, node of the planned top, then for each round one more than the node in it (or 0).
NODE_BITS, ROUND_BITS, ROUNDS = 18, 5, 7
TOP_SHIFT = ROUND_BITS * ROUNDS
# In place of a cut: the sample ended here, not the need for cuts.
OPEN = float("inf")


class Tree:
    """Cuts of one tree; a node without a cut is a leaf, open or not.

    ``children`` is the left child of each node, the right one is the next.
    """

    def __init__(
        self,
        directions: np.ndarray,
        cuts: np.ndarray,
        children: np.ndarray,
        blocks: np.ndarray,
        unfinished: np.ndarray,
        spill: float,
    ):
        self.directions, self.cuts, self.children, self.spill = directions, cuts, children, spill
        self.blocks, self.unfinished = blocks, unfinished

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that each vector falls into."""
        cuts = np.broadcast_to(self.cuts, (len(vectors), len(self.cuts)))
        return descend(vectors @ self.directions.T, cuts, self.children, self.spill)


def descend(
    projected: np.ndarray, cuts: np.ndarray, children: np.ndarray, spill: float
) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every leaf a row falls into by its projections and its own row of cuts."""
    rows, nodes = np.arange(len(projected)), np.zeros(len(projected), np.int64)
    found_rows, found_nodes = [], []
    level = 0
    while True:
        cut = cuts[rows, nodes]
        at_leaf = ~np.isfinite(cut)
        found_rows.append(rows[at_leaf])
        found_nodes.append(nodes[at_leaf])
        rows, nodes, cut = rows[~at_leaf], nodes[~at_leaf], cut[~at_leaf]
        if not len(rows):
            break
        values = projected[rows, level]
        left, right = values <= cut + spill, values >= cut - spill
        rows = np.concatenate([rows[left], rows[right]])
        nodes = np.concatenate([children[nodes[left]], children[nodes[right]] + 1])
        level += 1
    return np.concatenate(found_rows), np.concatenate(found_nodes)


def _directions(seed: int, depth: int, dimension: int) -> np.ndarray:
    directions = np.random.default_rng(seed).standard_normal((depth, dimension))
    return directions / np.linalg.norm(directions, axis=1, keepdims=True)


def _spill(dimension: int) -> float:
    return SPILL / np.sqrt(dimension)


def plan_tree(sample: np.ndarray, total: int, seed: int, leaf_rows: int | None = None, depth: int = MAX_DEPTH) -> Tree:
    """Plan a tree on a sample of unit vectors that stands for ``total`` vectors.

    A leaf is unfinished where only the sample or the depth ended before the leaf was small.
    """
    leaf_rows = leaf_rows or LEAF_ROWS
    directions = _directions(seed, depth, sample.shape[1])
    spill = _spill(sample.shape[1])
    cuts, children, blocks, unfinished = [], [], [], []
    scale = total / max(1, len(sample))
    # Nodes are numbered in the order in which they are met, level by level.
    todo = deque([(0, np.arange(len(sample)))])
    while todo:
        level, rows = todo.popleft()
        expected = len(rows) * scale
        cuts.append(np.nan)
        children.append(0)
        blocks.append(max(1, int(np.ceil(expected / BLOCK_ROWS))))
        unfinished.append(False)
        if expected <= leaf_rows:
            continue
        if level == depth or len(rows) < LEAST_ROWS:
            unfinished[-1] = scale > 1
            continue
        unsorted = sample[rows] @ directions[level]
        values = np.sort(unsorted)
        middle = values[len(values) // 4 : 3 * len(values) // 4 + 1]
        candidates = (middle[1:] + middle[:-1]) / 2
        near = np.searchsorted(values, candidates + spill) - np.searchsorted(values, candidates - spill)
        best = int(np.argmin(near))
        if near[best] > 0.4 * len(rows):
            continue
        cuts[-1] = cut = float(candidates[best])
        children[-1] = len(cuts) + len(todo)
        todo.append((level + 1, rows[unsorted <= cut + spill]))
        todo.append((level + 1, rows[unsorted >= cut - spill]))
    if len(cuts) > 1 << NODE_BITS:
        raise ValueError(f"a tree of {len(cuts)} nodes; take a smaller SAMPLE_ROWS or larger LEAF_ROWS")
    return Tree(
        directions[: level + 1],
        np.array(cuts),
        np.array(children),
        np.array(blocks, np.int64),
        np.array(unfinished),
        spill,
    )


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # Divided by the largest part first, so that no square overflows or vanishes.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def plan_forest(classes: DataFrame, trees: int = TREES, sample_rows: int | None = None) -> dict[int, list[Tree]]:
    """Trees for each length of vector."""
    sample_rows = sample_rows or SAMPLE_ROWS
    sizes = classes.groupBy(F.size("vector").alias("n")).count().collect()
    forest = {}
    for row in sizes:
        bound = max(LEAST_SAMPLE, min(sample_rows, SAMPLE_VALUES // row["n"]))
        chosen = classes.filter(F.size("vector") == row["n"]).orderBy(F.xxhash64("vector")).limit(bound)
        column = chosen.select("vector").toArrow().column(0).combine_chunks()
        sample = column.flatten().to_numpy(False).reshape(-1, row["n"])
        forest[row["n"]] = [plan_tree(_unit(sample), row["count"], SEED + t) for t in range(trees)]
    return forest


def _by_size(batches, column: int):
    """Slices of batches whose vectors have one length, with that length and the vectors."""
    for whole in batches:
        sizes = pc.list_value_length(whole.column(column)).to_numpy(False)
        for size in np.unique(sizes):
            chosen = whole.filter(pa.array(sizes == size))
            for start in range(0, chosen.num_rows, 1024):
                batch = chosen.slice(start, 1024)
                yield batch, int(size), batch.column(column).flatten().to_numpy(False).reshape(-1, int(size))


def _leaves_of(unit: np.ndarray, trees: list[Tree]):
    """(row, code, blocks, open) of every leaf, by row and code."""
    found = [tree.leaves(unit) for tree in trees]
    rows = np.concatenate([rows for rows, _ in found])
    codes = np.concatenate([(t << NODE_BITS | leaves) << TOP_SHIFT for t, (_, leaves) in enumerate(found)])
    blocks = np.concatenate([tree.blocks[leaves] for tree, (_, leaves) in zip(trees, found)])
    unfinished = np.concatenate([tree.unfinished[leaves] for tree, (_, leaves) in zip(trees, found)])
    order = np.lexsort((codes, rows))
    return rows[order], codes[order], blocks[order], unfinished[order]


def _indexed(batches, forest: dict[int, list[Tree]]):
    """One row per vector and leaf (and pair of blocks), by trees without open leaves."""
    for batch, size, vectors in _by_size(batches, 2):
        rows, codes, blocks, _ = _leaves_of(_unit(vectors), forest[size])
        yield _index_rows(batch, vectors, rows, codes, blocks, codes >> TOP_SHIFT, np.int32)


def _indexed_by_lists(batches):
    """The same by columns that hold each vector's leaves, in order, and their blocks."""
    for batch, size, vectors in _by_size(batches, 2):
        rows = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(3)).to_numpy(False))
        codes = batch.column(3).flatten().to_numpy(False)
        blocks = batch.column(4).flatten().to_numpy(False)
        yield _index_rows(batch, vectors, rows, codes, blocks, codes, np.int64)


def _binary(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of ``lengths`` values as binary strings."""
    ends = np.concatenate([[0], np.cumsum(lengths)]) * values.itemsize
    buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


def _index_rows(batch, vectors, rows, codes, blocks, listed, kind) -> pa.RecordBatch:
    nodes = batch.column(0).to_numpy(False)
    copies = batch.column(1).to_numpy(False)
    lists = _binary(listed.astype(kind), np.bincount(rows, minlength=len(nodes)))
    raw = _binary(vectors, np.full(len(nodes), vectors.shape[1]))
    own = np.where(blocks > 1, _mixed(nodes[rows]) % blocks, 0)
    # A vector of block b meets block k in the group of the two.
    again = np.repeat(np.arange(len(rows)), blocks)
    other = np.arange(len(again)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    mine = own[again]
    low, high = np.minimum(mine, other), np.maximum(mine, other)
    at = rows[again]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(at), vectors.shape[1]), pa.int32()),
            pa.array(codes[again], pa.int64()),
            pa.array(low << 31 | high, pa.int64()),
            pa.array(mine, pa.int32()),
            pa.array(nodes[at], pa.int64()),
            pa.array(copies[at], pa.int64()),
            raw.take(pa.array(at)),
            lists.take(pa.array(at)),
        ],
        ["size", "leaf", "part", "block", "node", "copies", "vector", "leaves"],
    )


def _mixed(nodes: np.ndarray) -> np.ndarray:
    # Node numbers count up within a partition; any odd factor and the upper bits deal them evenly.
    return ((nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


_INDEXED = (
    "size int, leaf long, part long, block int, node long, copies long, vector binary, leaves binary"
)


def _memberships(batches, forest: dict[int, list[Tree]]):
    """One row per vector and leaf of the planned tops; only open leaves need the vector again."""
    for batch, size, vectors in _by_size(batches, 2):
        rows, codes, blocks, unfinished = _leaves_of(_unit(vectors), forest[size])
        taken = pa.array(np.where(unfinished, rows, 0), mask=~unfinished)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(rows), size), pa.int32()),
                pa.array(codes, pa.int64()),
                pa.array(blocks, pa.int32(), mask=unfinished),
                pa.array(batch.column(0).to_numpy(False)[rows], pa.int64()),
                batch.column(2).take(taken),
            ],
            ["size", "leaf", "blocks", "node", "vector"],
        )


def _seed(codes: np.ndarray, round_: int) -> np.ndarray:
    return SEED + 1000 * round_ + (codes >> (TOP_SHIFT + NODE_BITS))


def _plan_leaf(group: pa.Table, round_: int, leaf_rows: int) -> pa.Table:
    """Cuts of ``ROUND_DEPTH`` more levels of one open leaf, by a sample of its vectors, nodes as in a heap."""
    size, leaf = group.column("size")[0].as_py(), group.column("leaf")[0].as_py()
    vectors = group.column("vector").combine_chunks().flatten().to_numpy(False).reshape(-1, size)
    seed = int(_seed(np.array([leaf]), round_)[0])
    tree = plan_tree(_unit(vectors), group.column("n")[0].as_py(), seed, leaf_rows, ROUND_DEPTH)
    cuts = np.full(2**ROUND_DEPTH - 1, np.nan)
    todo = [(0, 0)]
    while todo:
        node, place = todo.pop()
        if place < len(cuts):
            cuts[place] = OPEN if tree.unfinished[node] else tree.cuts[node]
            if np.isfinite(cuts[place]):
                left = int(tree.children[node])
                todo += [(left, 2 * place + 1), (left + 1, 2 * place + 2)]
    return pa.table({
        "size": pa.array([size], pa.int32()),
        "leaf": pa.array([leaf], pa.int64()),
        "cuts": pa.array([cuts], pa.list_(pa.float64())),
    })


def _cut_further(batches, round_: int):
    """Members of open leaves, with the cuts of their leaf, in the leaves below it."""
    for batch, size, vectors in _by_size(batches, 3):
        unit = _unit(vectors)
        codes = batch.column(1).to_numpy(False)
        inner = 2**ROUND_DEPTH - 1
        cuts = np.full((len(codes), 2 * inner + 1), np.nan)
        cuts[:, :inner] = batch.column(4).flatten().to_numpy(False).reshape(-1, inner)
        seeds = _seed(codes, round_)
        projected = np.empty((len(codes), ROUND_DEPTH))
        for seed in np.unique(seeds):
            chosen = seeds == seed
            projected[chosen] = unit[chosen] @ _directions(int(seed), ROUND_DEPTH, size).T
        rows, leaves = descend(projected, cuts, 2 * np.arange(inner) + 1, _spill(size))
        unfinished = (leaves >= inner) | (cuts[rows, leaves] == OPEN)
        taken = pa.array(np.where(unfinished, rows, 0), mask=~unfinished)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(rows), size), pa.int32()),
                pa.array(codes[rows] | (leaves + 1) << (TOP_SHIFT - ROUND_BITS * round_), pa.int64()),
                pa.nulls(len(rows), pa.int32()),
                pa.array(batch.column(2).to_numpy(False)[rows], pa.int64()),
                batch.column(3).take(taken),
            ],
            ["size", "leaf", "blocks", "node", "vector"],
        )


def _planner(round_: int, leaf_rows: int):
    return lambda group: _plan_leaf(group, round_, leaf_rows)


def _cutter(round_: int):
    return lambda batches: _cut_further(batches, round_)


def _index_in_rounds(spark: SparkSession, classes: DataFrame, forest, written: list[str]) -> DataFrame:
    """Index rows of trees whose sampled tops leave open leaves; cut those until none is left.

    A membership holds the blocks of its leaf if the plan knows them, and the vector if the leaf is open.
    """
    leaf_rows, block_rows = LEAF_ROWS, BLOCK_ROWS
    element = classes.schema["vector"].dataType
    schema = T.StructType.fromDDL("size int, leaf long, blocks int, node long").add("vector", element)
    planned = T.StructType.fromDDL("size int, leaf long, cuts array<double>")
    members = classes.select("node", "copies", "vector").mapInArrow(lambda b: _memberships(b, forest), schema)
    current = _written(spark, members, "members", written)
    done = [current.filter("vector is null")]
    for round_ in range(1, ROUNDS + 1):
        counted = current.filter("vector is not null").groupBy("size", "leaf").agg(F.count("*").alias("n"))
        sizes = _written(spark, counted, "sizes", written)
        if sizes.isEmpty():
            current = None
            break
        small = sizes.filter(F.col("n") <= leaf_rows)
        large = sizes.filter(F.col("n") > leaf_rows)
        waiting = current.filter("vector is not null")
        done.append(waiting.join(small.drop("n"), ["size", "leaf"], "left_semi"))
        share = (F.xxhash64("leaf", "node").bitwiseAND(F.lit((1 << 40) - 1))) / F.lit(float(1 << 40))
        sample = waiting.join(large, ["size", "leaf"]).filter(share * F.col("n") < PLAN_ROWS)
        plans = sample.groupBy("size", "leaf").applyInArrow(_planner(round_, leaf_rows), planned)
        # A leaf that chance left without a sample stays open.
        none = F.array(*[F.lit(OPEN)] * (2**ROUND_DEPTH - 1))
        plans = large.join(plans, ["size", "leaf"], "left").withColumn("cuts", F.coalesce("cuts", none))
        further = waiting.join(plans.drop("n"), ["size", "leaf"]).select("size", "leaf", "node", "vector", "cuts")
        cut = further.mapInArrow(_cutter(round_), schema)
        current = _written(spark, cut, "members", written)
        done.append(current.filter("vector is null"))
    if current is not None:
        done.append(current.filter("vector is not null"))
    placed = done[0].select("size", "leaf", "blocks", "node")
    for more in done[1:]:
        placed = placed.unionByName(more.select("size", "leaf", "blocks", "node"))
    counts = placed.filter("blocks is null").groupBy("size", "leaf").agg(F.count("*").alias("n"))
    counts = counts.select("size", "leaf", F.ceil(F.col("n") / block_rows).cast("int").alias("counted"))
    placed = placed.join(counts, ["size", "leaf"], "left").select(
        "node", "leaf", F.coalesce("blocks", "counted").alias("blocks")
    )
    lists = placed.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("leaf", "blocks"))).alias("leaves"))
    listed = classes.join(lists, "node").select(
        "node", "copies", "vector", F.col("leaves.leaf").alias("leaves"), F.col("leaves.blocks").alias("blocks")
    )
    return listed.mapInArrow(_indexed_by_lists, _INDEXED)


def _earlier(lists: np.ndarray, rows: np.ndarray, leaf: int, n: int) -> np.ndarray:
    """For each of n rows the leaves before this one as bits; leaves that only one row has are left out."""
    before = lists < leaf
    values, place, met = np.unique(lists[before], return_inverse=True, return_counts=True)
    column = np.cumsum(met > 1) - 1
    shared = met[place] > 1
    marks = np.zeros((n, int((met > 1).sum()) + 1), bool)
    marks[rows[before][shared], column[place[shared]]] = True
    packed = np.packbits(marks, axis=1)
    whole = np.zeros((n, -(-packed.shape[1] // 8) * 8), np.uint8)
    whole[:, : packed.shape[1]] = packed
    return whole.view(np.uint64)


def _values(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in order, and the number of values of each row."""
    whole = column.combine_chunks()
    if isinstance(whole, pa.ChunkedArray):
        whole = pa.concat_arrays(whole.chunks)
    lengths = pc.binary_length(whole).to_numpy(False)
    start = np.frombuffer(whole.buffers()[1], np.int32)[whole.offset]
    data = np.frombuffer(whole.buffers()[2], np.uint8)[start : start + int(lengths.sum())]
    return np.frombuffer(data.tobytes(), kind), lengths // np.dtype(kind).itemsize


def compare_leaf(group: pa.Table, threshold: float, vector_kind, list_kind) -> pa.Table:
    """Per vector the copies it links with first in this leaf; and links that connect the vectors."""
    leaf, part = group.column("leaf")[0].as_py(), group.column("part")[0].as_py()
    low, high = divmod(part, 1 << 31)
    nodes = group.column("node").to_numpy()
    copies = group.column("copies").to_numpy()
    blocks = group.column("block").to_numpy()
    unit = _unit(_values(group.column("vector"), vector_kind)[0].reshape(len(nodes), -1))
    listed, lengths = _values(group.column("leaves"), list_kind)
    here = leaf if list_kind is np.int64 else leaf >> TOP_SHIFT
    earlier = _earlier(listed, np.repeat(np.arange(len(nodes)), lengths), here, len(nodes))
    counts = np.zeros(len(nodes), np.int64)
    forest = Joined(len(nodes))
    first = np.nonzero(blocks == low)[0]
    second = np.nonzero(blocks == high)[0]
    for start in range(0, len(first), 256):
        rows = first[start : start + 256]
        # Within one block the rows before this run have met it already.
        others = second[start:] if low == high else second
        near = unit[rows] @ unit[others].T >= threshold
        left, right = np.nonzero(near)
        left, right = rows[left], others[right]
        if low == high:
            once = left < right
            left, right = left[once], right[once]
        for at in range(0, len(left), 100_000):
            a, b = left[at : at + 100_000], right[at : at + 100_000]
            new = ~(earlier[a] & earlier[b]).any(axis=1)
            a, b = a[new], b[new]
            counts += np.bincount(a, copies[b], len(nodes)).astype(np.int64)
            counts += np.bincount(b, copies[a], len(nodes)).astype(np.int64)
            forest.add(a, b)
    linked = np.nonzero(counts)[0]
    links = np.array(forest.links, np.int64).reshape(-1, 2)
    return pa.table({
        "node": pa.array(np.concatenate([nodes[linked], nodes[links[:, 0]]]), pa.int64()),
        "other": pa.concat_arrays([pa.nulls(len(linked), pa.int64()), pa.array(nodes[links[:, 1]], pa.int64())]),
        "n": pa.array(np.concatenate([counts[linked], np.zeros(len(links), np.int64)]), pa.int64()),
    })


def _written(spark: SparkSession, frame: DataFrame, label: str, written: list[str]) -> DataFrame:
    """The frame as a table in the shared folder, listed for removal."""
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    written.append(path)
    return spark.read.schema(frame.schema).parquet(path)


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per vector its links, the smallest id of its component, and whether it is that one."""
    spark: SparkSession = embeddings.sparkSession
    # Vectors of floats keep their four bytes a value, anything else is read as doubles.
    given = embeddings.schema[vector_col].dataType
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    kind = np.float32 if single else np.float64
    vector = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    # Null elements, infinities and NaN fail the comparison; some element must not be zero.
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) <= F.lit(1.7976931348623157e308), F.lit(False)))
    fit = F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    fit = F.coalesce(fit, F.lit(False))
    digest = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(SEED), "vector").alias("h2")]
    classes = rows.filter(fit).select("vec_id", "vector", *digest).groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    written: list[str] = []
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    classes = _written(spark, classes, "vectors", written)
    forest = plan_forest(classes, trees)
    if any(tree.unfinished.any() for planned in forest.values() for tree in planned):
        indexed, listed = _index_in_rounds(spark, classes, forest, written), np.int64
    else:
        indexed, listed = classes.select("node", "copies", "vector").mapInArrow(
            lambda batches: _indexed(batches, forest), _INDEXED
        ), np.int32
    compared = indexed.groupBy("size", "leaf", "part").applyInArrow(
        lambda group: compare_leaf(group, threshold, kind, listed), "node long, other long, n long"
    )
    compared = _written(spark, compared, "compared", written)
    counts = compared.filter("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(spark, compared.filter("other is not null").select("node", "other"))
    placed = (
        classes.drop("vector").join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(named, "root").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    placed = _written(spark, placed, "linked", [])
    for path in written:
        remove_folder(spark, path)
    linked = rows.filter(fit).select("vec_id", *digest).join(placed, ["h1", "h2"])
    linked = linked.select("vec_id", "n_links", "component_id")
    alone = rows.filter(~fit).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
