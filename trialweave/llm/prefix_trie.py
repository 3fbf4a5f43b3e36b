"""Trie of conversation prefixes, rolled up by centroid decomposition.

**Conversations.** A conversation is rebuilt from the first turns of its base (conversation
``id - id % 100``) and its own turns after them; how many is drawn by a CRC-32 of its id. A node of the
trie stands for a distinct sequence of first turns (role and text). Sequences count as equal if 128-bit
digests of them do: the exclusive or of a hash of every turn with its place. Of a text only its digest
and its length travel.

**Running numbers without a group in one task.** Turns are sorted by ranges of (conversation, turn, ...),
so that a conversation with a third of all rows lies in many ranges. Each task numbers the rows of its range
and folds their hashes; what a range leaves to the next one for the conversation at its border is one
row per range (``_carried``).

**Rollup.** Each node needs sums over its subtree, which may be as deep as the longest conversation. A
component starts as the whole trie. Its *weight* at a node is the number of (conversation, place) pairs
at or below it, which plain grouping gives: sum over members of (turns - depth + 1). In every round each
component is split at its centroid, the deepest node that holds half of the weight or more:

* nodes that hold half or more are exactly the path from the centroid to the component's top;
* a deeper node is below the centroid if its own conversation passes through it, which is one lookup of
  (conversation, depth);
* the component's totals at and below the centroid (its own values and those of the parts it cuts off)
  are added to every node of the path, and the centroid's weight is taken off the path;
* the parts below, each with its own top, and what is left above are the next round's components.

No part has more than half of the weight, so there are at most log2(turns) + 1 rounds, however deep the trie
is; most nodes leave after a few. A node's sums are the totals it was given over all rounds. Each round is
one table in the shared folder; the driver sees one number per round.

``ends_sha256`` is one SHA-256 over all ids that end at a node. The hash can't be cut into parts, so a node's
ids are read in order by one task; they arrive packed into runs of up to ``RUN_IDS`` ids, and only one run
is held at a time.

Defined results. A null role or text is empty. Rows without conv_id belong to no conversation and are
left out. Turns with equal numbers (or none) are ordered by role, then by the SHA-256 of role and text, and
repeated rows are turns of their own. Negative ids have the base that ``%`` with the sign of the id gives. No
conversation, no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trialweave.llm.common import record_batch
from trialweave.llm.components import saved
from trialweave.session import scratch_path

# Conversations of one base, and the number of different counts of shared turns.
FAMILY = 100
SHARES = 6
# Ids in one packed run.
RUN_IDS = 4096


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds range, place and running hashes per conversation to rows sorted by ``conv`` (never null)."""
    part = TaskContext.get().partitionId()
    above, places, folded = None, 0, np.zeros(2, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        starts = np.flatnonzero(np.r_[above is None or conv[0] != above, conv[1:] != conv[:-1]])
        place = np.arange(1, len(conv) + 1) + (0 if len(starts) and starts[0] == 0 else places)
        hashes = np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()])
        fold = np.bitwise_xor.accumulate(hashes, axis=1) ^ (
            np.zeros((2, 1), np.int64) if len(starts) and starts[0] == 0 else folded[:, None]
        )
        if len(starts):
            # Take off what stands before the start of each row's conversation.
            which = np.searchsorted(starts, np.arange(len(conv)), "right") - 1
            begun = which >= 0
            at = starts[np.maximum(which, 0)]
            offset = np.where(begun & (at > 0), at if starts[0] == 0 else at + places, 0)
            place = place - offset
            fold = fold ^ np.where(begun & (at > 0), fold[:, np.maximum(at - 1, 0)], 0)
        above, places, folded = conv[-1], int(place[-1]), fold[:, -1].copy()
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns |= {
            "part": pa.array(np.full(len(conv), part, np.int32)), "place": pa.array(place),
            "h1": pa.array(fold[0]), "h2": pa.array(fold[1]),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _carried(spark: SparkSession, rows: DataFrame, order: list[str | Column], label: str) -> DataFrame:
    """The rows with ``place`` from 1 and running ``h1``, ``h2`` per ``conv``, in the order given.

    What ranges leave to the next has at most two rows per range.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, "conv", *order).sortWithinPartitions("conv", *order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    table = saved(spark, ranged.mapInArrow(_numbered, f"{schema}, part int, place long"), label)
    ends = table.groupBy("conv", "part").agg(
        F.max("place").alias("places"), F.max_by("h1", "place").alias("e1"), F.max_by("h2", "place").alias("e2")
    )
    borders = ends.groupBy("conv").agg(F.count("*").alias("n"), F.collect_list(F.struct("part", "places", "e1", "e2")).alias("of"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = borders.filter("n > 1").select("conv", F.inline("of")).select(
        "conv", "part",
        F.coalesce(F.sum("places").over(before), F.lit(0)).alias("more"),
        F.coalesce(F.bit_xor("e1").over(before), F.lit(0)).alias("x1"),
        F.coalesce(F.bit_xor("e2").over(before), F.lit(0)).alias("x2"),
    )
    carry = saved(spark, carry.filter("more > 0"), f"{label}-carry")
    return table.join(F.broadcast(carry), ["conv", "part"], "left").select(
        *[F.col(c) for c in table.columns if c not in ("part", "place", "h1", "h2")],
        (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"),
        F.col("h1").bitwiseXOR(F.coalesce("x1", F.lit(0))).alias("h1"),
        F.col("h2").bitwiseXOR(F.coalesce("x2", F.lit(0))).alias("h2"),
    )


def _half(digest: str | Column, start: int) -> Column:
    """64 bits of a hexadecimal digest as a signed number."""
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, d1, d2, chars): original turns, numbered within their conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
        # The length says where the role ends.
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).alias("chars"),
        # Equal rows can change places, so this only spreads them over ranges.
        F.monotonically_increasing_id().alias("spread"),
        F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "digest", "spread"]
    rows = _carried(conversations.sparkSession, rows, order, "trie-turns")
    return rows.select("conv", "place", _half("digest", 1).alias("d1"), _half("digest", 17).alias("d2"), "chars")


def rebuilt(spark: SparkSession, original: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, place, h1, h2, chars) of the rebuilt conversations, and (conv, turns) of all, turnless ones too."""
    convs = original.groupBy("conv").agg(F.max("place").alias("own")).select(
        "conv", "own",
        (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARES).alias("share"),
        (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
    )
    lengths = convs.select(F.col("conv").alias("base"), F.least("own", F.lit(SHARES - 1)).alias("most"))
    convs = convs.join(lengths.filter(F.col("base") % FAMILY == 0), "base", "left")
    convs = convs.withColumn("shared", F.least("share", F.coalesce("most", F.lit(0))))
    convs = saved(spark, convs.withColumn("turns", F.col("shared") + F.greatest(F.col("own") - F.col("share"), F.lit(0))), "trie-convs")
    begun = original.filter((F.col("place") < SHARES) & (F.col("conv") % FAMILY == 0)).withColumnRenamed("conv", "base")
    heads = begun.join(convs.select("conv", "base", "shared"), "base").filter("place <= shared")
    tails = original.join(convs.select("conv", "share", "shared"), "conv").filter("place > share")
    columns = ["conv", "step", "d1", "d2", "chars"]
    both = heads.withColumn("step", F.col("place")).select(columns).union(
        tails.withColumn("step", F.col("place") - F.col("share") + F.col("shared")).select(columns)
    )
    hashed = both.select(
        "conv", "step", "chars",
        F.xxhash64("d1", "d2", "step").alias("h1"), F.xxhash64("step", "d2", "d1").alias("h2"),
    )
    rows = _carried(spark, hashed, ["step"], "trie-steps")
    return rows.select("conv", "place", "h1", "h2", "chars"), convs.select("conv", "turns")


def _digest_runs(batches):
    """Packs consecutive ids of a node, sorted, into text runs that start with their first id."""
    node, ids = None, []

    def packed(done):
        names = "node", "depth", "first", "run"
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.string()
        return record_batch({name: (kind, list(column)) for name, kind, column in zip(names, kinds, zip(*done))})

    for batch in batches:
        done = []
        for at, depth, conv in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "conv"))):
            if ids and (node != (at, depth) or len(ids) == RUN_IDS):
                done.append((*node, ids[0], ",".join(map(str, ids))))
                ids = []
            node = at, depth
            ids.append(conv)
        if done:
            yield packed(done)
    if ids:
        yield packed([(*node, ids[0], ",".join(map(str, ids)))])


def _digests(batches):
    """One SHA-256 per node over its runs, which come in order."""
    node, state = None, None

    def out(done):
        names = "node", "depth", "ends_sha256"
        kinds = pa.int64(), pa.int64(), pa.string()
        return record_batch({name: (kind, list(column)) for name, kind, column in zip(names, kinds, zip(*done))})

    for batch in batches:
        done = []
        for at, depth, run in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "run"))):
            if node == (at, depth):
                state.update(b"," + run.encode())
            else:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (at, depth), hashlib.sha256(run.encode())
        if done:
            yield out(done)
    if node:
        yield out([(*node, state.hexdigest())])


def end_digests(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256) of (node, depth, conv) rows."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = (
        ends.select("node", "depth", "conv")
        .repartitionByRange(parts, "node", "depth", "conv").sortWithinPartitions("node", "depth", "conv")
        .mapInArrow(_digest_runs, "node long, depth long, first long, run string")
    )
    ordered = runs.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return ordered.mapInArrow(_digests, "node long, depth long, ends_sha256 string")


def trie(spark: SparkSession, steps: DataFrame, convs: DataFrame, root: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The nodes; every conversation's nodes; paths of conversations that name one: (conv, depth, node, next).

    A node is named by its smallest member and its depth. ``next`` is the name of the conversation's
    node one turn deeper.
    """
    sized = steps.join(convs, "conv")
    grouped = sized.groupBy(F.col("place").alias("depth"), "h1", "h2").agg(
        F.min("conv").alias("node"), F.count("*").alias("n_convs"),
        F.sum("turns").alias("reach"), F.max("chars").alias("chars"),
    )
    nodes = saved(spark, grouped, "trie-nodes")
    on = [sized["place"] == nodes["depth"], sized["h1"] == nodes["h1"], sized["h2"] == nodes["h2"]]
    members = sized.join(nodes, on).select("conv", "depth", "node", "turns")
    tops = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), "turns")
    members = saved(spark, members.union(tops), "trie-members")
    # The smallest conversation of those that end at a node names it and all that are named on its way.
    naming = members.filter("depth = turns AND conv = node").select("conv")
    paths = members.join(naming, "conv", "left_semi")
    deeper = paths.select("conv", (F.col("depth") - 1).alias("depth"), F.col("node").alias("next"))
    paths = paths.select("conv", "depth", "node").join(deeper, ["conv", "depth"], "left")
    return nodes.drop("h1", "h2"), members, saved(spark, paths, "trie-paths")


def rollup(spark: SparkSession, nodes: DataFrame, paths: DataFrame, values: list[str], root: int) -> DataFrame:
    """(node, depth, *values): each value of (node, depth, weight, *values) summed over the subtree."""
    folder = scratch_path(spark, "trie-rounds")
    kept = ["node", "depth", "top", "top_depth", "weight", *values]
    active = nodes.select(
        "node", "depth", F.lit(root).cast("long").alias("top"), F.lit(0).cast("long").alias("top_depth"), "weight", *values
    )
    below = paths.select(
        F.col("conv").alias("node"), F.col("depth").alias("c_depth"), F.col("node").alias("met"), "next"
    )
    turn = 0
    while True:
        tops = active.filter("node = top AND depth = top_depth").select("top", "top_depth", F.col("weight").alias("whole"))
        heavy = active.join(tops, ["top", "top_depth"]).filter("2 * weight >= whole")
        deepest = F.max(F.struct(F.col("depth").alias("c_depth"), F.col("node").alias("c"), F.col("weight").alias("c_weight")))
        # Grouping by a struct of its own leaves the join above free to split a large component.
        component = F.struct("top", "top_depth").alias("component")
        cuts = heavy.groupBy(component).agg(F.max("whole").alias("whole"), deepest.alias("cut"))
        cuts = cuts.select("component.*", "whole", "cut.*")
        rows = active.join(cuts, ["top", "top_depth"])
        path = 2 * F.col("weight") >= F.col("whole")
        # Only deeper nodes off the path can be below the centroid.
        asked = ~path & (F.col("depth") > F.col("c_depth"))
        found = rows.filter(asked).join(below, ["node", "c_depth"])
        cut_off = F.col("met") == F.col("c")
        rest = rows.filter(~asked).select(*kept, "c", "c_depth", "c_weight", path.alias("path"), F.lit(False).alias("off"), F.lit(None).cast("long").alias("next"))
        split = rest.union(
            found.select(*kept, "c", "c_depth", "c_weight", F.lit(False).alias("path"), cut_off.alias("off"), "next")
        )
        split.write.parquet(f"{folder}/round={turn}")
        done = spark.read.parquet(f"{folder}/round={turn}")
        centroid = (F.col("node") == F.col("c")) & (F.col("depth") == F.col("c_depth"))
        left = done.filter(~centroid).select(
            "node", "depth",
            F.when(F.col("off"), F.col("next")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("off"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            (F.col("weight") - F.when(F.col("path"), F.col("c_weight")).otherwise(0)).alias("weight"),
            *values,
        )
        if left.isEmpty():
            break
        active, turn = left, turn + 1
    rounds = spark.read.parquet(folder)
    centroid = (F.col("node") == F.col("c")) & (F.col("depth") == F.col("c_depth"))
    component = ["round", "top", "top_depth"]
    totals = rounds.filter(F.col("off") | centroid).groupBy(component).agg(*[F.sum(v).alias(f"{v}_below") for v in values])
    given = rounds.filter("path").select(*component, "node", "depth").join(totals, component)
    return given.groupBy("node", "depth").agg(*[F.sum(f"{v}_below").alias(v) for v in values])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    steps, convs = rebuilt(spark, turns(conversations))
    root, n, reach = convs.agg(F.min("conv"), F.count("*"), F.sum("turns")).first()
    if not n:
        return spark.createDataFrame(
            [],
            "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
            " saved_tokens long, ends_sha256 string",
        )
    nodes, members, paths = trie(spark, steps, convs, root)
    top = spark.range(1).select(
        F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("node"), F.lit(n).cast("long").alias("n_convs"),
        F.lit(reach).cast("long").alias("reach"), F.lit(0).alias("chars"),
    )
    nodes = nodes.unionByName(top)
    # A node is the next one on the path of the conversation that names it.
    parents = paths.filter("next = conv").select(
        F.col("conv").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent")
    )
    nodes = saved(spark, nodes.join(parents, ["node", "depth"], "left"), "trie-parents")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("node"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    nodes = nodes.join(children, ["node", "depth"], "left").na.fill(0, ["n_children"])
    nodes = nodes.select(
        "*",
        (F.col("reach") - F.col("n_convs") * (F.col("depth") - 1)).alias("weight"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    nodes = saved(spark, nodes, "trie-valued")
    sums = rollup(spark, nodes, paths, ["n_leaves", "saved_tokens"], root)
    digests = end_digests(spark, members.filter("depth = turns"))
    out = nodes.drop("n_leaves", "saved_tokens").join(sums, ["node", "depth"]).join(digests, ["node", "depth"], "left")
    return out.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
