"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has 64 bits, one from each bit of the XXH64 hashes of a document's word shingles. Two
fingerprints that differ in at most 4 bits share at least 4 of their 8 bytes, each at its position.
Lists by one position and value would hold 1/256 of all fingerprints each, and the pairs in them grow
with the square of the input. So the index is keyed by three positions and their values: 20 of the 56
sets of three positions meet every set of four, and a pair with 4 shared bytes is in one list at least.
Within a list the shared bytes of each pair are tallied, pairs below the guaranteed 4 are dropped, and
the rest is verified bit by bit. Lists longer than ``LONG_LIST`` are first divided by blocks of the bits
that vary within them: a pair of at most 4 differing bits agrees in one of 5 blocks. Bytes that all
members share, be they of the key or not, are in no block, so this loses nothing.

Copies share a fingerprint and enter the index once. A list reports links that connect its
fingerprints, at most one fewer than it has members, never all pairs.

Defined results: documents without words (null, empty, blank) have fingerprint zero and are linked like
any other; with fewer words than a shingle the whole sequence is one shingle; rows with equal ids share
the smallest id; rows without an id take the id of their group, or null if it has none.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trialweave.llm.common import encoded_texts, slices
from trialweave.llm.components import Joined, components, saved

SHINGLE = 4
MAX_BITS = 4
SEED = 42
LONG_LIST = 256
SHINGLES_AT_ONCE = 1 << 18


def key_positions() -> list[tuple[int, int, int]]:
    """Sets of three byte positions that meet every set of four.

    Positions fall into three groups; a set lies in one group, or has two positions in one group and
    one in the next. Of any four positions three always do.
    """
    group = {p: p % 3 for p in range(8)}
    sets = []
    for positions in combinations(range(8), 3):
        groups = [group[p] for p in positions]
        if len(set(groups)) == 1:
            sets.append(positions)
        elif len(set(groups)) == 2:
            double = max(set(groups), key=groups.count)
            single = min(set(groups), key=groups.count)
            if single == (double + 1) % 3:
                sets.append(positions)
    return sets


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_BYTE_OFFSETS = np.arange(8, dtype=np.uint16) * 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> bytes:
    """Eight bytes, the most significant first."""
    import xxhash

    words = text.lower().split()
    if not words:
        return bytes(8)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = b"".join(
            [digest(line[a:b], SEED) for a, b in zip(starts[part].tolist(), ends[part].tolist())]
        )
        places = np.frombuffer(hashes, np.uint8).reshape(-1, 8) + _BYTE_OFFSETS
        seen = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
        counts += (seen @ _BITS).ravel()
    return np.packbits(counts * 2 > len(starts)).tobytes()


def fingerprints(
    documents: DataFrame,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_hash: bool = False,
) -> DataFrame:
    """(doc_id, fp) per document, the fingerprint as a signed whole number; with the text's XXH64 if asked."""

    def run(batches):
        for batch in slices(batches):
            joined = b"".join(fingerprint(text, shingle) for text in encoded_texts(batch))
            values = np.frombuffer(joined, ">u8").astype(np.uint64).view(np.int64)
            hashes = [batch.column(2)] if with_hash else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), *hashes], names)

    names = ["doc_id", "fp", "hash"][: 3 if with_hash else 2]
    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        *([F.xxhash64(text_col).alias("hash")] if with_hash else []),
    )
    return source.mapInArrow(run, ", ".join(f"{name} long" for name in names))


def _pairs_in_runs(order: np.ndarray, run: np.ndarray):
    """All pairs of members of a run, by distance: arrays of left and right members.

    ``run`` numbers the run of each place; runs are contiguous.
    """
    ends = np.searchsorted(run, run, side="right")
    places = np.arange(len(run))
    distance = 1
    while True:
        places = places[places + distance < ends[places]]
        if not len(places):
            return
        yield order[places], order[places + distance]
        distance += 1


def _verified(words: np.ndarray, left: np.ndarray, right: np.ndarray, max_bits: int):
    """Tally the shared bytes, keep pairs with the guaranteed number, then count the bits."""
    differing = words[left] ^ words[right]
    shared = 8 - np.count_nonzero(differing.view(np.uint8).reshape(-1, 8), axis=1)
    enough = shared >= 8 - max_bits
    left, right, differing = left[enough], right[enough], differing[enough]
    near = np.bitwise_count(differing) <= max_bits
    return left[near], right[near]


def _link_long(words: np.ndarray, members: np.ndarray, max_bits: int, forest: Joined) -> None:
    """Link what is near among the members of one long list, given as places in ``words``.

    The bits that vary are cut into one block more than bits may differ, and members of equal block are
    compared; runs that are still long are divided again. Where that does not halve the pairs, all are
    compared, until the members are connected.
    """
    waiting = [members]
    while waiting:
        members = waiting.pop()
        if forest.one(members):
            continue
        values = words[members]
        varying = int(np.bitwise_or.reduce(values ^ values[0]))
        bits = [1 << bit for bit in range(64) if varying >> bit & 1]
        parts = []
        if len(bits) > max_bits:
            for block in np.array_split(np.array(bits, np.uint64), max_bits + 1):
                value = values & np.bitwise_or.reduce(block)
                inner = np.argsort(value, kind="stable")
                run = np.cumsum(np.concatenate([[0], value[inner][1:] != value[inner][:-1]]))
                parts.append((members[inner], run, np.bincount(run)))
        pairs = sum(int((size * (size - 1)).sum()) for _, _, size in parts)
        if not parts or 2 * pairs > len(members) * (len(members) - 1):
            for left, right in _pairs_in_runs(members, np.zeros(len(members), np.int64)):
                forest.add(*_verified(words, *forest.apart(left, right), max_bits))
                if forest.one(members):
                    break
            continue
        for placed, run, size in parts:
            short = size[run] <= LONG_LIST
            for left, right in _pairs_in_runs(placed[short], run[short]):
                forest.add(*_verified(words, *forest.apart(left, right), max_bits))
            ends = np.cumsum(size)
            for number in np.flatnonzero(size > LONG_LIST):
                waiting.append(placed[ends[number] - size[number] : ends[number]])


def links_in_lists(words: np.ndarray, key: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect what is linked within the lists of equal key, as places in ``words``."""
    forest = Joined(len(words))
    order = np.argsort(key, kind="stable")
    run = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
    size = np.bincount(run)[run]
    short = size <= LONG_LIST
    for left, right in _pairs_in_runs(order[short], run[short]):
        forest.add(*_verified(words, *forest.apart(left, right), max_bits))
    for number in np.unique(run[~short]):
        _link_long(words, order[run == number], max_bits, forest)
    return forest.links


def fingerprint_links(spark: SparkSession, distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (fp_a, fp_b) that connect all distinct fingerprints (column fp) within reach."""
    sets = key_positions()
    # The number of slots follows the session's parallelism; a slot holds many short lists.
    slots = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    masks = [sum(0xFF << (8 * (7 - p)) for p in positions) for positions in sets]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    lists = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed]))
    rows = distinct.select("fp", lists.alias("which", "masked"))
    rows = rows.select(
        F.pmod(F.xxhash64("which", "masked"), F.lit(slots)).cast("int").alias("slot"),
        F.col("which").cast("byte").alias("which"),
        "fp",
    )
    mask_of = np.array(masks, np.uint64)

    def in_slot(group: pa.Table) -> pa.Table:
        words = group.column("fp").to_numpy().view(np.uint64)
        which = group.column("which").to_numpy()
        masked = words & mask_of[which]
        order = np.lexsort((masked, which))
        new = np.concatenate(
            [[True], (masked[order][1:] != masked[order][:-1]) | (which[order][1:] != which[order][:-1])]
        )
        key = np.empty(len(words), np.int64)
        key[order] = np.cumsum(new)
        links = np.array(links_in_lists(words, key, max_bits), np.int64).reshape(-1, 2)
        signed_words = words.view(np.int64)
        return pa.table({
            "fp_a": pa.array(signed_words[links[:, 0]], pa.int64()),
            "fp_b": pa.array(signed_words[links[:, 1]], pa.int64()),
        })

    return rows.groupBy("slot").applyInArrow(in_slot, "fp_a long, fp_b long").distinct()


def near_duplicates(
    documents: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document its fingerprint (16 lower-case digits) and the smallest id of its group."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the index guarantees pairs of up to {MAX_BITS} differing bits")
    spark = documents.sparkSession
    rows = saved(spark, fingerprints(documents, shingle, id_col, text_col), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    placed = with_roots(spark, distinct, max_bits)
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fingerprint = placed.join(named, "root").select("fp", "component_id")
    return rows.join(by_fingerprint, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def with_roots(spark: SparkSession, distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, least, root): rows of distinct fingerprints, each with one that stands for its group."""
    links = fingerprint_links(spark, distinct.select("fp"), max_bits)
    roots = components(spark, links).withColumnRenamed("node", "fp")
    return distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def keep_representatives(
    documents: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each group, with all columns: that of the smallest id, rows without an id last.

    Of several rows with that id the one whose text has the smallest XXH64 stays; equal texts are in one
    group whatever their ids. Rows are told apart by id and text, so that unlike texts which share an
    id are members of their own groups.
    """
    spark = documents.sparkSession
    # Names that no column of the documents has.
    *key, rank = (_free_name(documents, f"representative_{i}") for i in range(4))
    rows = saved(spark, fingerprints(documents, shingle, id_col, text_col, with_hash=True), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "hash")
    distinct = rows.groupBy("fp").agg(F.min(order).alias("least"))
    least = with_roots(spark, distinct, max_bits).groupBy("root").agg(F.min("least").alias("least"))
    kept = least.select(*_key(F.col("least.doc_id"), F.col("least.hash"), key))
    named = documents.withColumns(dict(zip(key, _key(F.col(id_col).cast("long"), F.xxhash64(text_col), key))))
    chosen = named.join(kept, key, "left_semi")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    one = W.partitionBy(*key).orderBy(F.xxhash64(*columns))
    chosen = chosen.withColumn(rank, F.row_number().over(one)).filter(F.col(rank) == 1)
    return chosen.select(*columns)


def _key(doc: Column, text_hash: Column, names: list[str]) -> list[Column]:
    """Id and text as columns without nulls: a plain join and the window after it share one shuffle."""
    columns = [doc.isNull(), F.coalesce(doc, F.lit(0)), text_hash]
    return [column.alias(name) for column, name in zip(columns, names)]


def _free_name(frame: DataFrame, name: str) -> str:
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name
