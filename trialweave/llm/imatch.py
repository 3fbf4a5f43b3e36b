"""Document fingerprints by I-Match over randomised lexicon subsets.

The terms of a document are its distinct lower-cased words. The lexicon holds the terms whose inverse
document frequency ln(documents / documents with the term) lies in a band: words that stand almost
everywhere say nothing about a text, very rare ones are often slips. A fingerprint has one field per
randomised subset of the lexicon: the hash of the sorted terms that the document has in that subset.

One subset of fixed size suits few documents: dense ones change with every edit of a long text, sparse
ones hold no word of a short one. So each of the subsets is nested: its level j keeps a term with chance
2**-j, drawn by hashing the term, and a document hashes its terms in the sparsest level that still holds
one. Likeness is the share of equal fields.

**Bound of the lexicon.** It goes to all tasks. A term of the band occurs in at least documents *
exp(-IDF_MOST) documents, so there are at most exp(IDF_MOST) * (mean number of distinct terms of a
document) of them, however many documents there are. Frequencies are counted over all documents: each
task adds up the terms of its batches, ``groupBy`` the rest.

**Next documents.** Documents are dealt to ranges of (doc_id, hash of the text), whose borders come from
a range partitioning of those two columns; so equal ids are spread, too. Texts are shuffled once. The
first document of a range also goes to the end of the range before (the very first to the last one). A
task walks through the rows of its ranges in order and holds two texts at a time.

Defined results. A null text is empty, a null id comes first; of equal ids the smaller hash of the text
comes first, so that repeated rows follow one another. A document without a term of the band uses all its
terms, one without any term its whole text as one; so equal texts always have equal fingerprints and
two empty texts likeness 1. A single document is its own next. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import record_batch, slices

IDF_LEAST = 1.0
IDF_MOST = 7.0
SUBSETS = 32
# Hex digits of a field.
DIGITS = 8
# Distinct terms whose counts a task holds before it sends them on.
HELD_TERMS = 200_000
# Ranges of documents per shuffle partition; several even out what hashing deals to one.
RANGES = 3

_WORD = re.compile(r"[^\W_]+")
_FIRST = -(1 << 63)


def terms(text: str) -> set[str]:
    """The distinct lower-cased words: runs of letters and digits."""
    pieces = set(text.lower().split())
    words = {piece for piece in pieces if piece.isalnum()}
    for piece in pieces - words:
        words.update(_WORD.findall(piece))
    return words


def term_hash(term: str, seed: int = 0) -> int:
    """64 bits, signed."""
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), seed) - (1 << 63)


def _texts(batches, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in slices(batches, column):
        yield batch, [text or "" for text in batch.column(column).to_pylist()]


def _term_counts(batches):
    def sent(counts: Counter) -> pa.RecordBatch:
        hashes = [term_hash(term) for term in counts]
        return record_batch({"term": (pa.int64(), hashes), "documents": (pa.int64(), list(counts.values()))})

    counts: Counter[str] = Counter()
    for _, texts in _texts(batches, 0):
        for text in texts:
            counts.update(terms(text))
            if len(counts) >= HELD_TERMS:
                yield sent(counts)
                counts = Counter()
    if counts:
        yield sent(counts)


def lexicon(
    documents: DataFrame, text_column: str = "text", least: float = IDF_LEAST, most: float = IDF_MOST
) -> np.ndarray:
    """Hashes of the terms within the band, sorted."""
    texts = documents.select(F.col(text_column).alias("text"))
    n = texts.count()
    counted = texts.mapInArrow(_term_counts, "term long, documents long").groupBy("term")
    found = counted.agg(F.sum("documents").alias("documents")).filter(
        F.col("documents").between(n * math.exp(-most), n * math.exp(-least))
    )
    return np.sort(found.select("term").toArrow().column(0).to_numpy())


class Lexicon:
    """Sorted hashes of the band's terms and, per subset, the last level that still keeps each of them."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.levels = _levels(hashes)
        self._by_hash = {value: place for place, value in enumerate(hashes.tolist())}
        self._by_word: dict[str, int] = {}  # words of the lexicon met so far

    def _places(self, words: set[str]) -> np.ndarray:
        """The sorted places of the words that the lexicon holds."""
        met = self._by_word
        places = [place for place in map(met.get, words) if place is not None]
        if len(places) < len(words):
            for word in words.difference(met):
                place = self._by_hash.get(term_hash(word))
                if place is not None:
                    met[word] = place
                    places.append(place)
        out = np.array(places, np.int64)
        out.sort()
        return out

    def fingerprint(self, text: str) -> str:
        own = terms(text)
        places = self._places(own)
        if len(places):
            hashes, levels = self.hashes[places], self.levels[places]
        else:
            hashes = np.array(sorted({term_hash(word) for word in own}) or [term_hash(text, 1)], np.int64)
            levels = _levels(hashes)
        # The sorted terms of each subset, one subset after the other.
        subset, term = np.nonzero((levels == levels.max(axis=0)).T)
        data = hashes[term].tobytes()
        ends = np.searchsorted(subset, np.arange(SUBSETS), "right") * hashes.itemsize
        fields, start = [], 0
        for end in ends.tolist():
            fields.append(f"{xxhash.xxh32_intdigest(data[start:end]):0{DIGITS}x}")
            start = end
        return "".join(fields)


def _levels(hashes: np.ndarray) -> np.ndarray:
    """Trailing zeros of a mixed hash per term and subset: level j or more has chance 2**-j."""
    with np.errstate(over="ignore"):
        salts = (np.arange(SUBSETS, dtype=np.uint64) * 2 + 1) * np.uint64(0x9E3779B97F4A7C15)
        mixed = hashes.view(np.uint64)[:, None] ^ salts
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(31)
        lowest = mixed & (~mixed + np.uint64(1))
    # A power of two is exact as a double; zero has no bit set and counts as the last level.
    return np.where(lowest == 0, 64, np.log2(np.maximum(lowest, 1).astype(float))).astype(np.uint8)


def likeness(a: str, b: str) -> float:
    """Share of equal fields of two fingerprints."""
    fields = len(a) // DIGITS
    return sum(a[i : i + DIGITS] == b[i : i + DIGITS] for i in range(0, len(a), DIGITS)) / fields


def edited_text(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def borders(keyed: DataFrame) -> list[tuple[int, int]]:
    """The first (key, tie) of each range, rising. Its length is bounded by the number of partitions."""
    parts = max(1, int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))) * RANGES
    ranged = keyed.select("key", "tie").repartitionByRange(parts, "key", "tie")
    first = ranged.groupBy(F.spark_partition_id()).agg(F.min(F.struct("key", "tie")).alias("first"))
    return sorted((row["first"]["key"], row["first"]["tie"]) for row in first.collect())


def range_of(firsts: list[tuple[int, int]], keys: np.ndarray, ties: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range each row falls into, and whether the row equals the range's first."""
    first_keys = np.array([key for key, _ in firsts], np.int64)
    first_ties = np.array([tie for _, tie in firsts], np.int64)
    low = np.searchsorted(first_keys, keys, "left")
    high = np.searchsorted(first_keys, keys, "right")
    found = low.copy()
    # Where borders share the row's key, the tie decides among them.
    shared = np.flatnonzero(high > low)
    for start in np.unique(low[shared]):
        rows = shared[low[shared] == start]
        stop = high[rows[0]]
        found[rows] = start + np.searchsorted(first_ties[start:stop], ties[rows], "right")
    found -= 1
    return found, (first_keys[found] == keys) & (first_ties[found] == ties)


def with_successors(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(range, key, tie, guest, id, text), sorted so that a row's next document is the row below it.

    ``guest`` rows only end a range: they are the first row of the following one.
    """
    key = F.coalesce(F.col(id_column).cast("long"), F.lit(_FIRST))
    keyed = documents.select(
        key.alias("key"), F.xxhash64(text_column).alias("tie"),
        F.col(id_column).alias("id"), F.col(text_column).alias("text"),
    )
    firsts = borders(keyed)
    last = len(firsts) - 1

    @F.pandas_udf("range int, first boolean")
    def placed(key, tie):
        import pandas as pd

        found, first = range_of(firsts, key.to_numpy(), tie.to_numpy())
        return pd.DataFrame({"range": found.astype(np.int32), "first": first})

    own = F.struct(F.col("place.range").alias("range"), F.lit(False).alias("guest"))
    before = F.when(F.col("place.range") == 0, last).otherwise(F.col("place.range") - 1)
    both = F.array(own, F.struct(before.cast("int").alias("range"), F.lit(True).alias("guest")))
    rows = keyed.withColumn("place", placed("key", "tie")).withColumn(
        "target", F.explode(F.when(F.col("place.first"), both).otherwise(F.array(own)))
    )
    rows = rows.select("target.range", "key", "tie", "target.guest", "id", "text")
    return rows.repartition(max(1, len(firsts)), "range").sortWithinPartitions("range", "guest", "key", "tie")


def fingerprint_documents(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: float = IDF_LEAST,
    most: float = IDF_MOST,
) -> DataFrame:
    """Per document (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    known_terms = lexicon(documents, text_column, least, most)
    kind = documents.schema[id_column].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else None
    columns = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(batches):
        words = Lexicon(known_terms)
        held = None  # (range, id, text, fingerprint) of the row above
        for batch, texts in _texts(batches, 5):
            rows = []
            ranges, guests = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for part, guest, doc, text in zip(ranges, guests, batch.column(4).to_pylist(), texts):
                own = words.fingerprint(text)
                if held and held[0] == part:
                    _, above, before, printed = held
                    edited = edited_text(before, text)
                    changed = words.fingerprint(edited)
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    rows.append(
                        (above, len(before), digest, printed, changed, likeness(printed, changed), likeness(printed, own))
                    )
                held = None if guest else (part, doc, text, own)
            values = list(zip(*rows)) if rows else [[]] * len(columns)
            kinds = [id_type or batch.schema.types[4], pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            yield record_batch(dict(zip(columns, zip(kinds, map(list, values)))))

    out = with_successors(documents, id_column, text_column).mapInArrow(
        compared,
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
    return out.withColumnRenamed("id", id_column)
