"""Substring dedup: Rabin-Karp hashes of every window of a fixed number of words.

All windows of all documents are hashed and counted; a window whose words also start in a document with
a smaller id marks its words, and marked windows merge into maximal intervals, which are removed. Windows
are judged on the input, not on what is left.

Words are hashed by XXH64, and windows roll over these hashes.
Equality of windows is equality of a 64-bit rolling hash and of the slot, which comes from a second,
independent one. A slot has about the same number of windows at any size of input, so the expected
number of false matches is the number of windows times 2e-14.

Within a batch only the windows of the smallest id are sent for each hash; the others are marked there
and then. So a window that a third of all documents share costs one entry per batch.

Defined results: a null text has no words; texts with fewer words than a window lose nothing; equal
ids are not smaller than each other, so repeated rows stay apart and get the same result; documents
without an id count as having the largest. Only the id and text columns are read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm import repeats
from trialweave.llm.common import encoded_texts, sha256, slices
from trialweave.llm.components import saved

WINDOW = 13
BATCH_BYTES = 4 << 20
# Several slots per shuffle partition even out what hashing deals to one.
SLOTS_PER_PARTITION = 8
HASHED_BYTES = 1 << 19
SCHEMA = (
    "doc_id long, n_words long, n_removed long, kept_sha256 string, "
    "removed array<struct<start: long, end: long>>"
)
# Two seeds for hashes that do not depend on each other.
SEEDS = (0, 1)
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _chunks(texts: list[bytes]):
    """(number of the text, bytes) with about ``HASHED_BYTES`` at a time; no word is cut."""
    chunk, size = [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = at + HASHED_BYTES
            if end < len(text):
                blank = _BLANK.search(text, end)
                end = blank.start() if blank else len(text)
            chunk.append((number, text[at:end]))
            size += end - at
            at = end
            if size >= HASHED_BYTES:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


class _Codes(dict):
    """Numbers for words, in the order in which they are first met."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of every word of all texts, one after the other, and the words of each text.

    Words are hashed by XXH64: unlike a polynomial modulo 2**64 it gives no two words one hash because
    of how their letters are arranged.
    """
    codes, found = _Codes(), [np.zeros(0, np.int64)]
    counts = np.zeros(len(texts), np.int64)
    for chunk in _chunks(texts):
        for number, part in chunk:
            words = part.split()
            counts[number] += len(words)
            found.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
    order = np.concatenate(found)
    one, two = (
        np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in codes), np.uint64, len(codes))
        for seed in SEEDS
    )
    return one[order], two[order], counts


def _windows(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, in order, and the number of windows of each text."""
    n = np.maximum(counts - size + 1, 0)
    begin = np.cumsum(counts) - counts
    before = np.cumsum(n) - n
    return np.arange(n.sum()) + np.repeat(begin - before, n), n


def _sent(batches, slots: int, size: int, limit: int):
    for batch in slices(batches, 1, limit):
        texts = encoded_texts(batch)
        ids = batch.column(0).fill_null(repeats.NO_ID).to_numpy(False).astype(np.int64)
        text_hashes = batch.column(2).fill_null(0).to_numpy(False).astype(np.int64)
        one, two, counts = word_hashes(texts)
        first_words, n = _windows(counts, size)
        if not len(first_words):
            continue
        hashes = repeats.mixed(repeats.window_hashes(one, size, repeats.BASES[0])[first_words])
        others = repeats.mixed(repeats.window_hashes(two, size, repeats.BASES[1])[first_words])
        slot = ((others >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        owners = np.repeat(ids, n)
        marked = _later(hashes, owners)
        places = np.nonzero(~marked)[0]
        yield from repeats.sent_rows(
            slots, slot[places], hashes[places], places,
            [repeats.pack_header([ids, counts, text_hashes]), repeats.pack_numbers(np.nonzero(marked)[0])],
            owners[places],
        )


def _later(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Entries whose hash also has an entry with a smaller owner."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, bool)
    starts = np.nonzero(new)[0]
    marked = np.zeros(len(hashes), bool)
    if len(starts) < len(order):
        least = np.minimum.reduceat(owners[order], starts)
        marked[order] = owners[order] > np.repeat(least, np.diff(np.append(starts, len(order))))
    return marked


def repeated_spans(documents: DataFrame, size: int = WINDOW) -> DataFrame:
    """(id, text_hash, spans) of the documents that lose words; spans count words.

    ``documents`` holds the columns doc_id, text and text_hash.
    """
    slots = repeats.slots_of(documents.sparkSession, SLOTS_PER_PARTITION)
    limit = BATCH_BYTES
    sent = documents.mapInArrow(lambda batches: _sent(batches, slots, size, limit), repeats.SENT)

    def judge(keys, owners):
        return _later(keys.ravel(), owners), np.zeros(len(owners), bool)

    def collect(own, first, second):
        id_of, counts, text_hashes = repeats.unpack_header(own[0], 3)
        first_words, _ = _windows(counts, size)
        marked = first_words[np.union1d(first, repeats.unpack_numbers(own[1]))]
        starts, ends = repeats.runs_of(repeats.covered(int(counts.sum()), marked, marked + size))
        starts, ends = _within(starts, ends, np.cumsum(counts))
        return repeats.span_rows(id_of, text_hashes, np.cumsum(counts), starts, ends)

    back = repeats.judged(sent, judge, 1)
    return repeats.per_batch(back, collect, repeats.SPANS).distinct()


def _within(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut stretches where one document ends and the next begins."""
    cuts = borders[:-1]
    inside = np.zeros(len(cuts), bool)
    if len(starts) and len(cuts):
        at = np.searchsorted(starts, cuts, side="right") - 1
        inside = (at >= 0) & (starts[at] < cuts) & (cuts < ends[at])
    cuts = np.unique(cuts[inside])
    return np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))


def remove_repeats(
    documents: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: its words, removed words and intervals, and the digest of what is kept."""
    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_hash"),
    )
    spans = saved(documents.sparkSession, repeated_spans(source, size), "repeated-words")
    keyed = source.withColumn("id", F.coalesce("doc_id", F.lit(repeats.NO_ID)))
    joined = keyed.join(spans, ["id", "text_hash"], "left").select("doc_id", "text", "spans")

    def kept(batches):
        for batch in slices(batches):
            totals, removed, digests = [], [], []
            spans_of = batch.column(2).to_pylist()
            for text, spans in zip(encoded_texts(batch), spans_of):
                words = text.split()
                totals.append(len(words))
                rest, at = [], 0
                for span in spans or ():
                    rest += words[at : span["start"]]
                    at = span["end"]
                rest += words[at:]
                removed.append(len(words) - len(rest))
                digests.append(sha256(b" ".join(rest)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(totals, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array([s or [] for s in spans_of], batch.schema.types[2]),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"],
            )

    return joined.mapInArrow(kept, SCHEMA)
