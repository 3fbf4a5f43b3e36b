"""Finding what repeats across all documents, with one compact exchange.

Three steps that the dedup operators share:

1. A map task turns a batch of documents into entries (a key at a place) and deals them to slots by
   key. What goes to one slot is one row: the keys, the gaps between the places and, where the slot
   has to know them, the ids of the documents these entries lie in, all packed. So a row grows with
   its entries alone, and what a batch sends does not grow with the number of slots but for some 100
   bytes a row. A key that occurs often is thinned
   in the batch before it is sent.
2. A slot brings equal keys of all batches together and marks places. Each batch gets back the
   places that its slot marked.
3. The marks of a batch are put together, and with the packed ids they become rows per document.

The number of slots follows ``spark.sql.shuffle.partitions``, so a slot's size follows what the session
plans for a partition, at any size of input. A batch is named by a digest of its content: a task that runs again makes the
same rows. Every batch knows how many rows it sent and checks that all of them answered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SENT = "slot int, batch long, rows int, ids binary, keys binary, places binary, own binary"
BACK = "batch long, rows int, own binary, first binary, second binary"
# Rows that are handed over at once.
ROWS_AT_ONCE = 256
# Id given to documents without one: no id is larger.
NO_ID = np.iinfo(np.int64).max
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, from the golden ratio
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def slots_of(spark: SparkSession, per_partition: int) -> int:
    """More slots per partition even out what partitions get, but each batch sends more rows."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < size:
        room = (size + 0xFFFF) >> 16 << 16
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            powers = np.full(room, factor, np.uint64)
            powers[0] = 1
            both.append(np.multiply.accumulate(powers))
        _POWERS[base] = (both[0], both[1])
    up, down = _POWERS[base]
    return up[:size], down[:size]


class RollingHash:
    """Rabin-Karp hashes of any stretches of a sequence of 64-bit numbers, modulo 2**64.

    The hash of a stretch is a difference of two running sums, shifted to the start of the sequence.
    """

    def __init__(self, numbers: np.ndarray, base: int):
        up, self.down = _powers(base, len(numbers) + 1)
        self.sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(numbers * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def of_length(self, size: int) -> np.ndarray:
        """The hashes of all stretches of one length."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]


def window_hashes(numbers: np.ndarray, size: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of a few numbers, without sums over the whole sequence."""
    n = max(len(numbers) - size + 1, 0)
    hashes = np.zeros(n, np.uint64)
    for offset in range(size):
        hashes *= np.uint64(base)
        hashes += numbers[offset : offset + n]
    return hashes


# Two odd bases for hashes that do not depend on each other.
BASES = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Ascending numbers as compressed gaps, byte by byte."""
    import zstandard

    gaps = np.diff(numbers, prepend=0).astype("<u4")
    planes = gaps.view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(packed: bytes | None) -> np.ndarray:
    import zstandard

    if not packed:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


def pack_header(columns: list[np.ndarray]) -> bytes:
    """Whole numbers of the documents of a batch, one array per property."""
    import zstandard

    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T) for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(np.concatenate(planes).tobytes())


def unpack_header(packed: bytes, columns: int) -> list[np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    planes = planes.reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).view("<i8").ravel().astype(np.int64) for p in planes]


def pack_runs(numbers: np.ndarray) -> bytes:
    """Numbers of which neighbours are often equal, as runs."""
    starts = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1)) if len(numbers) else np.zeros(0, np.int64)
    return pack_header([numbers[starts], np.diff(starts, append=len(numbers))])


def unpack_runs(packed: bytes) -> np.ndarray:
    values, lengths = unpack_header(packed, 2)
    return np.repeat(values, lengths)


def sent_rows(
    slots: int,
    slot: np.ndarray,
    keys: np.ndarray,
    places: np.ndarray,
    own: list[bytes],
    ids: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """One row per slot that gets entries; the first row also carries what only the batch needs.

    ``keys`` has a row per entry; ``places`` ascend; ``ids`` are those of the entries' documents.
    """
    import xxhash

    order = np.argsort(slot.astype(np.uint16 if slots <= 65536 else np.int64), kind="stable")
    bounds = np.searchsorted(slot[order], np.arange(slots + 1))
    used = np.nonzero(np.diff(bounds))[0]
    if not len(used):
        used = np.zeros(1, np.int64)
    packed = join_parts(own)
    name = xxhash.xxh64(packed)
    name.update(keys.tobytes())
    batch = int(np.uint64(name.intdigest()).view(np.int64))
    for begin in range(0, len(used), ROWS_AT_ONCE):
        targets = used[begin : begin + ROWS_AT_ONCE]
        parts = [order[bounds[target] : bounds[target + 1]] for target in targets]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(targets, pa.int32()),
                pa.array(np.full(len(targets), batch)),
                pa.array(np.full(len(targets), len(used), np.int32)),
                pa.array([None if ids is None else pack_runs(ids[part]) for part in parts], pa.binary()),
                pa.array([np.ascontiguousarray(keys[part]).tobytes() for part in parts], pa.binary()),
                pa.array([pack_numbers(places[part]) for part in parts], pa.binary()),
                pa.array([None if begin + i else packed for i in range(len(targets))], pa.binary()),
            ],
            ["slot", "batch", "rows", "ids", "keys", "places", "own"],
        )


def join_parts(parts: list[bytes]) -> bytes:
    sizes = np.array([len(p) for p in parts], "<i8").tobytes()
    return len(parts).to_bytes(2, "little") + sizes + b"".join(parts)


def split_parts(packed: bytes) -> list[bytes]:
    n = int.from_bytes(packed[:2], "little")
    sizes = np.frombuffer(packed, "<i8", n, 2)
    ends = 2 + 8 * n + np.cumsum(sizes)
    return [packed[end - size : end] for size, end in zip(sizes, ends)]


Judge = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def judged(sent: DataFrame, judge: Judge, width: int) -> DataFrame:
    """Bring equal keys (``width`` numbers each) together and send each batch its marked places.

    ``judge(keys, ids)`` returns two masks over the entries of a slot; ``ids`` are empty if none were sent.
    """

    def in_slot(group: pa.Table) -> pa.Table:
        places = [unpack_numbers(p) for p in group.column("places").to_pylist()]
        keys = np.frombuffer(b"".join(group.column("keys").to_pylist()), "<u8").reshape(-1, width)
        ids = [unpack_runs(p) for p in group.column("ids").to_pylist() if p is not None]
        masks = judge(keys, np.concatenate([np.zeros(0, np.int64), *ids]))
        ends = np.cumsum([len(p) for p in places])
        first, second = (
            [pack_numbers(p[mask[end - len(p) : end]]) for p, end in zip(places, ends)] for mask in masks
        )
        return pa.table({
            "batch": group.column("batch"),
            "rows": group.column("rows"),
            "own": group.column("own"),
            "first": pa.array(first, pa.binary()),
            "second": pa.array(second, pa.binary()),
        })

    return sent.groupBy("slot").applyInArrow(in_slot, BACK)


def per_batch(
    back: DataFrame,
    collect: Callable[[list[bytes], np.ndarray, np.ndarray], pa.Table],
    schema: str,
) -> DataFrame:
    """Turn the marks of each batch into rows: ``collect(own, first, second)``."""

    def of_batch(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        if len(rows) % rows[0]["rows"]:
            raise RuntimeError(f"batch {rows[0]['batch']}: {len(rows)} answers to {rows[0]['rows']} rows")
        chief = next(row for row in rows if row["own"] is not None)
        first, second = (
            np.unique(np.concatenate([unpack_numbers(row[name]) for row in rows]))
            for name in ("first", "second")
        )
        return collect(split_parts(chief["own"]), first, second)

    return back.groupBy("batch").applyInArrow(of_batch, schema)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the true runs of a mask."""
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the stretches."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def span_rows(
    ids: np.ndarray, texts: np.ndarray, ends_of: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> pa.Table:
    """Stretches over the joined documents of a batch as one row per document that has any.

    ``ends_of`` are the ends of the documents; no stretch goes beyond one.
    """
    owner = np.searchsorted(ends_of, starts, side="right")
    begin = np.concatenate([[0], ends_of[:-1]]) if len(ends_of) else ends_of
    present, first = np.unique(owner, return_index=True)
    offsets = np.concatenate([first, [len(owner)]]).astype(np.int32)
    local = [pa.array(values - begin[owner], pa.int64()) for values in (starts, ends)]
    spans = pa.StructArray.from_arrays(local, ["start", "end"])
    return pa.table({
        "id": pa.array(ids[present], pa.int64()),
        "text_hash": pa.array(texts[present], pa.int64()),
        "spans": pa.ListArray.from_arrays(pa.array(offsets), spans),
    })


SPANS = "id long, text_hash long, spans array<struct<start: long, end: long>>"
