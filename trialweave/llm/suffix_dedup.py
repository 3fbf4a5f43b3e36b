"""Substring dedup of byte strings by a sparse, range-partitioned suffix array.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Sorting the suffix at
every byte moves 19 times the input, so the array is sparse. In each window of ``LENGTH`` bytes the
``LEAD``-byte string of smallest hash is its anchor; equal windows have their anchor at the same offset.
Consecutive windows with one anchor form a stretch.

1. The suffixes at the anchors are range-partitioned by their first 8 bytes between sampled splitters.
   A first token so frequent that several splitters equal it is dealt by the rest of the lead, so that
   equal leads always meet. Buckets sort locally by multikey quicksort on 8-byte tokens: only ties go
   on to the next token. No lead straddles two buckets, so there is nothing to compare across them.
   Where a whole stretch (lead, length and a 64-bit hash) occurs again, all of its windows repeat.
   Equal windows reach equally far from their anchor, at least half of what is left on one side; so a
   stretch whose half to the right and whose half to the left (64-bit hashes) are alone has no
   window in common with any other.
2. What remains are the borders of repeats: stretches that share a half but differ somewhere. Their
   windows are compared one by one, by rolling hashes dealt over all slots (see ``repeats``).

Within a batch a stretch, and a window, is sent once. Of a lead with more than ``SENT_PER_LEAD``
different stretches only so many are sent, marked as hot, and all stretches of a hot lead go to the
second step. Hot passages therefore cost an entry or a few per batch, not per document.

Defined results: a null text is empty; texts shorter than ``LENGTH`` lose nothing; every row counts as a
document of its own, so repeated rows of that length go entirely. Only id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm import repeats
from trialweave.llm.common import encoded_texts, sha256, slices
from trialweave.llm.components import saved

LENGTH = 200
LEAD = 32
SENT_PER_LEAD = 4
BATCH_BYTES = 1 << 20
PIECE_BYTES = 1 << 19
# Texts are cut into segments; the leads of this share of them place the splitters.
SEGMENT_BYTES = 1 << 13
SAMPLED = 0.02
SCHEMA = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "removed array<struct<start: long, end: long>>"
)
FOUND = "kind byte, " + repeats.SPANS
# Halves that do not exist, and those of a hot lead. Hashes of halves are larger.
NO_HALF, HOT = np.uint64(0), np.uint64(1)
_POSITION = np.uint64((1 << 24) - 1)


def multikey_order(keys: np.ndarray) -> np.ndarray:
    """The order of rows of unsigned tokens: sort by one token, refine ties by the next."""
    order = np.argsort(keys[:, 0], kind="stable")
    for column in range(1, keys.shape[1]):
        done = keys[order, :column]
        tied = np.zeros(len(order) + 1, bool)
        tied[1:-1] = (done[1:] == done[:-1]).all(axis=1)
        within = tied[1:] | tied[:-1]
        if not within.any():
            break
        places = np.nonzero(within)[0]
        group = np.cumsum(~tied[:-1])[places]
        members = order[places]
        order[places] = members[np.lexsort((keys[members, column], group))]
    return order


def equal_to_last(ordered: np.ndarray) -> np.ndarray:
    """Whether each row equals the one before it."""
    same = np.zeros(len(ordered), bool)
    same[1:] = (ordered[1:] == ordered[:-1]).all(axis=1)
    return same


def _pieces(
    texts: list[bytes], ids: np.ndarray, hashes: np.ndarray, bounds: tuple[int, int], length: int
) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Groups of (id, text hash, offset, bytes); each window of a text lies in one piece.

    ``bounds`` are the bytes of a group and of a piece.
    """
    group, size = [], 0
    limit, step = bounds
    for text, doc, text_hash in zip(texts, ids.tolist(), hashes.tolist()):
        for offset in range(0, len(text) - length + 1, step):
            piece = text[offset : offset + step + length - 1]
            group.append((doc, text_hash, offset, piece))
            size += len(piece)
            if size >= limit:
                yield group
                group, size = [], 0
    if group:
        yield group


def _smallest(values: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every run of ``size`` values, by doubling."""
    reach = 1
    while reach * 2 <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(pieces: list[bytes], length: int = LENGTH, lead: int = LEAD):
    """The stretches of joined pieces: their keys, first and last windows.

    A key has the lead as big-endian tokens, one number for the whole stretch and one for either half.
    """
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    rolling = repeats.RollingHash(joined.astype(np.uint64) + np.uint64(1), repeats.BASES[0])
    leads = repeats.mixed(rolling.of_length(lead))
    # The place in the low bits settles equal hashes: the leftmost wins, in equal windows alike.
    ranked = (leads & ~_POSITION) | np.arange(len(leads), dtype=np.uint64)
    anchors = (_smallest(ranked, length - lead + 1) & _POSITION).astype(np.int64)
    starts = np.arange(len(anchors))
    owner = np.searchsorted(ends, starts, side="right")
    valid = starts + length <= ends[owner]
    starts, anchors, owner = starts[valid], anchors[valid], owner[valid]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])
    at = np.nonzero(new)[0]
    low, high = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    anchors, owner = anchors[at], owner[at]
    tokens = joined[anchors[:, None] + np.arange(lead)].view(">u8").astype(np.uint64)
    other = repeats.RollingHash(joined.astype(np.uint64) + np.uint64(1), repeats.BASES[1])
    shape = ((anchors - low).astype(np.uint64) << np.uint64(32)) | (high - low).astype(np.uint64)
    whole = repeats.mixed(other.of(low, high + length) ^ repeats.mixed(shape))
    half = (length - lead) // 2
    right, left = np.full(len(low), NO_HALF), np.full(len(low), NO_HALF)
    reaches = anchors - high <= half  # some window begins at most so far before its anchor
    right[reaches] = repeats.mixed(other.of(anchors[reaches], anchors[reaches] + length - half)) | np.uint64(2)
    reaches = anchors - low > half
    left[reaches] = repeats.mixed(other.of(anchors[reaches] - half - 1, anchors[reaches] + lead)) | np.uint64(2)
    return np.column_stack([tokens, whole, right, left]), low, high


def _marks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each stretch: does it occur again, may other stretches share windows with it, is it the
    first of its kind, and the number of kinds of its lead. Only first ones are told of others."""
    order = multikey_order(keys[:, :-2])
    ordered = keys[order]
    same, same_lead = equal_to_last(ordered[:, :-2]), equal_to_last(ordered[:, :-3])
    kind, lead = np.cumsum(~same) - 1, np.cumsum(~same_lead) - 1
    again = np.bincount(kind)[kind] > 1 if len(kind) else same
    kinds = np.bincount(lead[~same], minlength=len(lead))[lead]
    hot = np.bincount(lead[ordered[:, -2] == HOT], minlength=len(lead))[lead] > 0
    shared = hot & (kinds > 1)
    firsts = np.nonzero(~same)[0]
    for column in (-2, -1):
        halves = ordered[firsts, column]
        shared[firsts] |= _again(halves)[0] & (halves > HOT)
    out = []
    for values in (again, shared, ~same, kinds):
        back = np.empty(len(order), values.dtype)
        back[order] = values
        out.append(back)
    return tuple(out)


def _beyond(keys: np.ndarray, first: np.ndarray, limit: int) -> np.ndarray:
    """First stretches that come after ``limit`` others of their lead."""
    places = np.nonzero(first)[0]
    order = places[multikey_order(keys[places, :-3])]
    new = ~equal_to_last(keys[order, :-3])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    beyond = np.zeros(len(keys), bool)
    beyond[order] = np.arange(len(order)) - start >= limit
    return beyond


def _slot(keys: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The range a lead falls into; leads of a token that fills several ranges are dealt by the rest."""
    low = np.searchsorted(splitters, keys[:, 0], side="left")
    high = np.searchsorted(splitters, keys[:, 0], side="right")
    wide = np.maximum(high - low, 1).astype(np.uint64)
    rest = np.zeros(len(keys), np.uint64)
    for column in range(LEAD // 8):
        rest = repeats.mixed(rest ^ keys[:, column])
    spread = (rest >> np.uint64(32)) * wide >> np.uint64(32)
    return np.where(high > low, low + 1 + spread.astype(np.int64) - 1, low)


def _columns(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    ids = batch.column(0).fill_null(repeats.NO_ID).to_numpy(False).astype(np.int64)
    return encoded_texts(batch), ids, batch.column(2).to_numpy(False).astype(np.int64)


def _sent_stretches(
    batches: Iterable[pa.RecordBatch],
    splitters: np.ndarray,
    slots: int,
    length: int,
    bounds: tuple[int, int],
    per_lead: int,
):
    for batch in slices(batches):
        for group in _pieces(*_columns(batch), bounds, length):
            keys, low, high = stretches([piece for *_, piece in group], length)
            again, shared, first, kinds = _marks(keys)
            hot = kinds > per_lead
            shared |= hot
            keys[hot, -2:] = HOT, NO_HALF
            places = np.nonzero(first & ~(hot & _beyond(keys, first, per_lead)))[0]
            header = repeats.pack_header([
                *(np.array([piece[i] for piece in group], np.int64) for i in range(3)),
                np.array([len(piece) for *_, piece in group], np.int64),
            ])
            own = [header] + [
                repeats.pack_numbers(numbers)
                for numbers in (low, high, np.nonzero(again)[0], np.nonzero(shared & first)[0])
            ]
            slot = _slot(keys[places], splitters)
            yield from repeats.sent_rows(slots, slot, keys[places], places, own)


def splitters_of(documents: DataFrame, slots: int, length: int = LENGTH) -> np.ndarray:
    """First tokens that part the leads of a sample into ranges of about equal size, ascending."""

    bounds = BATCH_BYTES, PIECE_BYTES

    def tokens(batches):
        for batch in slices(batches):
            for group in _pieces(*_columns(batch), bounds, length):
                keys, *_ = stretches([piece for *_, piece in group], length)
                # Shifted so that signed numbers have the order of the bytes.
                shifted = (keys[:, 0] ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shifted)], ["token"])

    doc, text, text_hash = documents.columns[:3]
    whole = documents.select(
        F.col(doc).alias("id"), F.col(text).cast("binary").alias("bytes"), F.col(text_hash).alias("hash")
    )
    size = F.octet_length("bytes")
    # A segment too short for a window has no lead; the first one of a text that has a window has one.
    starts = F.sequence(F.lit(0), F.greatest(size - length, F.lit(0)), F.lit(SEGMENT_BYTES))
    parts = [i / slots for i in range(1, slots)]
    found = None
    for share in (SAMPLED, 1.0):  # all segments if the sample is empty, as it may be if they are few
        if found or not parts:
            break
        limit = F.lit(round(share * 10_000))
        picked = F.filter(starts, lambda at: F.pmod(F.xxhash64("id", "hash", at), F.lit(10_000)) < limit)
        rows = whole.filter(size >= length).select("*", F.explode(picked).alias("at"))
        rows = rows.select("id", F.col("bytes").substr(F.col("at") + 1, F.lit(SEGMENT_BYTES)), "hash")
        sample = rows.mapInArrow(tokens, "token long")
        found = sample.agg(F.percentile_approx("token", parts, 20 * slots)).first()[0]
    shifted = np.array(found or [], np.int64).view(np.uint64)
    return np.sort(shifted ^ np.uint64(1 << 63))


def compare_stretches(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(kind, id, text_hash, spans): kind 0 spans repeat; windows starting in kind 1 spans may."""
    slots = repeats.slots_of(documents.sparkSession, 4)
    splitters = splitters_of(documents, slots, length)
    bounds, per_lead = (BATCH_BYTES, PIECE_BYTES), SENT_PER_LEAD
    sent = documents.mapInArrow(
        lambda batches: _sent_stretches(batches, splitters, slots, length, bounds, per_lead),
        repeats.SENT,
    )

    def judge(keys, owners):
        again, shared, first, _ = _marks(keys)
        # Of a stretch that occurs again one is compared with others.
        return again, shared & first

    def collect(own, first, second):
        ids, texts, offsets, sizes = repeats.unpack_header(own[0], 4)
        low, high, again, shared = (repeats.unpack_numbers(part) for part in own[1:])
        ends_of = np.cumsum(sizes)
        again, shared = np.union1d(first, again), np.union1d(second, shared)
        out = []
        for kind, which, reach in ((0, again, length), (1, shared, 1)):
            owner = np.searchsorted(ends_of, low[which], side="right")
            shift = offsets[owner] - (ends_of - sizes)[owner]
            rows = pa.table({
                "owner": owner, "start": low[which] + shift, "end": high[which] + reach + shift
            })
            out.append(_found(kind, ids, texts, rows))
        return pa.concat_tables(out)

    back = repeats.judged(sent, judge, LEAD // 8 + 3)
    return repeats.per_batch(back, collect, FOUND)


def _found(kind: int, ids: np.ndarray, texts: np.ndarray, rows: pa.Table) -> pa.Table:
    """One row per piece that has spans."""
    owner = rows.column("owner").to_numpy()
    present, first = np.unique(owner, return_index=True)
    offsets = np.append(first, len(owner)).astype(np.int32)
    spans = pa.StructArray.from_arrays(
        [pa.array(rows.column(name).to_numpy(), pa.int64()) for name in ("start", "end")], ["start", "end"]
    )
    return pa.table({
        "kind": pa.array(np.full(len(present), kind), pa.int8()),
        "id": pa.array(ids[present], pa.int64()),
        "text_hash": pa.array(texts[present], pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(offsets), spans),
    })


def _sent_windows(
    batches: Iterable[pa.RecordBatch], slots: int, length: int, bounds: tuple[int, int]
):
    """Every window of the listed spans: its hash, the slot from a second hash, its number."""
    limit, step = bounds

    def groups():
        group, size = [], 0
        for batch in slices(batches):
            texts, ids, hashes = _columns(batch)
            for text, doc, text_hash, spans in zip(texts, ids, hashes, batch.column(3).to_pylist()):
                for span in spans:
                    for start in range(span["start"], span["end"], step):
                        end = min(span["end"], start + step)
                        group.append((doc, text_hash, start, text[start : end + length - 1]))
                        size += end - start + length
                        if size >= limit:
                            yield group
                            group, size = [], 0
        if group:
            yield group

    for group in groups():
        joined = np.frombuffer(b"".join(piece for *_, piece in group), np.uint8)
        sizes = np.array([len(piece) for *_, piece in group], np.int64)
        n = sizes - length + 1
        numbers = joined.astype(np.uint64) + np.uint64(1)
        begin = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(n) - n), n)
        starts = np.arange(n.sum()) + begin
        one, two = (
            repeats.mixed(repeats.RollingHash(numbers, base).of(starts, starts + length))
            for base in repeats.BASES
        )
        slot = ((two >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        again, first = _again(one)
        places = np.nonzero(first)[0]
        header = repeats.pack_header([
            *(np.array([piece[i] for piece in group], np.int64) for i in range(3)), n
        ])
        own = [header, repeats.pack_numbers(np.nonzero(again)[0])]
        yield from repeats.sent_rows(slots, slot[places], one[places], places, own)


def _again(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Does a value occur again, and is it the first of its kind."""
    order = np.argsort(hashes, kind="stable")
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = hashes[order][1:] == hashes[order][:-1]
    again, first = np.empty(len(order), bool), np.empty(len(order), bool)
    again[order] = same[1:] | same[:-1]
    first[order] = ~same[:-1]
    return again, first


def compare_windows(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """(kind 0, id, text_hash, spans) for the windows that occur again.

    ``documents`` holds doc_id, text, text_hash and the spans of window starts to compare.
    """
    slots = repeats.slots_of(documents.sparkSession, 4)
    bounds = BATCH_BYTES, PIECE_BYTES
    sent = documents.mapInArrow(
        lambda batches: _sent_windows(batches, slots, length, bounds), repeats.SENT
    )

    def judge(keys, owners):
        return _again(keys.ravel())[0], np.zeros(len(keys), bool)

    def collect(own, first, second):
        ids, texts, offsets, n = repeats.unpack_header(own[0], 4)
        places = np.union1d(first, repeats.unpack_numbers(own[1]))
        ends_of = np.cumsum(n)
        owner = np.searchsorted(ends_of, places, side="right")
        starts = places - (ends_of - n)[owner] + offsets[owner]
        # Neighbouring windows of a piece are one span.
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1] + 1) | (owner[1:] != owner[:-1])
        at = np.nonzero(new)[0]
        last = np.append(at, len(places))[1:] - 1
        rows = pa.table({"owner": owner[at], "start": starts[at], "end": starts[last] + length})
        return _found(0, ids, texts, rows)

    back = repeats.judged(sent, judge, 1)
    return repeats.per_batch(back, collect, FOUND)


def _all_spans(found: DataFrame) -> DataFrame:
    """The spans of a text in one row; a text has at most a span per few bytes."""
    return found.groupBy("id", "text_hash").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: its bytes, removed bytes and spans, and the digest of the bytes that are kept."""
    if length < 2 * LEAD:
        raise ValueError(f"strings of {2 * LEAD} bytes or more can be compared")
    spark = documents.sparkSession
    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    keyed = source.withColumn("id", F.coalesce("doc_id", F.lit(repeats.NO_ID)))
    found = saved(spark, compare_stretches(source, length), "stretches")
    borders = _all_spans(found.filter("kind = 1"))
    open_texts = keyed.join(borders, ["id", "text_hash"]).select("doc_id", "text", "text_hash", "spans")
    windows = saved(spark, compare_windows(open_texts, length), "windows")
    spans = _all_spans(found.filter("kind = 0").unionByName(windows))
    joined = keyed.join(spans, ["id", "text_hash"], "left").select("doc_id", "text", "spans")

    def kept(batches):
        for batch in slices(batches):
            sizes, removed, digests, merged = [], [], [], []
            for text, spans in zip(encoded_texts(batch), batch.column(2).to_pylist()):
                runs = _merged(spans or [])
                rest, at = [], 0
                for start, end in runs:
                    rest.append(text[at:start])
                    at = end
                rest.append(text[at:])
                sizes.append(len(text))
                removed.append(sum(end - start for start, end in runs))
                digests.append(sha256(b"".join(rest)))
                merged.append([{"start": start, "end": end} for start, end in runs])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([len(m) for m in merged], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(merged, batch.schema.types[2]),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
            )

    return joined.mapInArrow(kept, SCHEMA)


def _merged(spans: list[dict[str, int]]) -> list[list[int]]:
    """Maximal runs: spans that overlap or touch become one."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out
