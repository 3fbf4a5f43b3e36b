"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised items.

Words are the runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower
case. The automaton holds every window of ``WINDOW`` consecutive item words (the whole item if it
has fewer) between blanks, and a document's normalised text passes through it once.

The benchmark is a stated query set. It is collected in blocks of at most ``BLOCK_WORDS`` words, so
that an automaton has a bounded size. One block holds the usual benchmark, and the documents pass through
it once. Of more blocks the driver holds two at a time; each adds its hits by digest of the text to a
table in the shared folder, which then meets the documents.

Defined results: a null text and a text without words have no words and no hit; an item without
words has no window; rows with equal ids stay apart for documents and count as one item for the
benchmark; an item without an id takes no part. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import encoded_texts, record_batch, sha256, slices
from trialweave.session import scratch_path

WINDOW = 10
BLOCK_WORDS = 500_000
RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, items array<string>, spans array<struct<start: long, end: long>>"
)
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Every byte that is no part of a word becomes a blank; bytes of a word stay.
_BLANKED = bytes(b if WORD.match(bytes([b])) else 32 for b in range(256))
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_BLANKED).split(b" ") if text else []


def normalised(text: bytes) -> tuple[bytes, int]:
    """The words, each between blanks, and their number."""
    words = [word for word in words_of(text) if word]
    return b" " + b" ".join(words) + b" ", len(words)


def windows_of(text: bytes, size: int = WINDOW) -> list[bytes]:
    words = [word for word in words_of(text) if word]
    if not words:
        return []
    return [
        b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))
    ]


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size, one read after the other."""
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")
    ).filter("item is not null and text is not null")
    block, size = [], 0
    for row in items.toLocalIterator():
        text = row["text"].encode()
        block.append((row["item"], text))
        size += len(WORD.findall(text)) + 1
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


_BUILT: dict[int, tuple] = {}


def _automaton(items: list[tuple[str, bytes]], size: int):
    """The automaton of a block, built once in each worker process."""
    import ahocorasick

    key = hash((size, tuple(items)))
    if key not in _BUILT:
        holders: dict[bytes, set[str]] = {}
        for item, text in items:
            for window in windows_of(text, size):
                holders.setdefault(window, set()).add(item)
        automaton = ahocorasick.Automaton()
        for window, ids in holders.items():
            automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(ids)))
        if holders:
            automaton.make_automaton()
        _BUILT.clear()
        _BUILT[key] = (automaton if holders else None,)
    return _BUILT[key][0]


def _hits(line: bytes, automaton) -> tuple[set[str], list[list[int]]]:
    """The items that occur in a normalised text and the word ranges of their windows."""
    found: set[str] = set()
    runs: list[list[int]] = []
    blanks = None
    for end, (length, ids) in automaton.iter(line.decode("latin-1")):
        if blanks is None:
            blanks = [m.start() for m in re.finditer(b" ", line)]
        found.update(ids)
        # The blank at ``end`` closes the window: as many words lie before it as blanks do.
        last = bisect_right(blanks, end) - 1
        runs.append([last - length, last])
    return found, runs


def _merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _original(text: bytes, ranges: list[list[int]]) -> list[dict[str, int]]:
    """Ranges of words as offsets into the characters of the text as it came."""
    if not ranges:
        return []
    places = [m.span() for m in WORD.finditer(text.lower())]
    out, at, chars = [], 0, 0
    for first, last in ranges:
        start, end = places[first][0], places[last - 1][1]
        chars += len(text[at:start].decode())
        length = len(text[start:end].decode())
        out.append({"start": chars, "end": chars + length})
        at, chars = end, chars + length
    return out


def scan(batches: Iterator[pa.RecordBatch], items: list[tuple[str, bytes]], size: int):
    """The result from the hits of the items and those that came with the rows."""
    automaton = _automaton(items, size)
    for batch in slices(batches):
        texts = encoded_texts(batch)
        before = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        met, ranges, counts = [], [], []
        for text, (items_before, ranges_before) in zip(texts, before):
            line, n_words = normalised(text)
            found, runs = _hits(line, automaton) if automaton is not None else (set(), [])
            met.append(sorted(found.union(items_before)))
            ranges.append(_merged(runs + [[r["start"], r["end"]] for r in ranges_before]))
            counts.append(n_words)
        n_hit = [sum(end - start for start, end in r) for r in ranges]
        yield record_batch({
            "doc_id": (pa.int64(), batch.column(0).to_pylist()),
            "n_words": (pa.int64(), counts),
            "n_hit": (pa.int64(), n_hit),
            "n_items": (pa.int64(), [len(m) for m in met]),
            "items_sha256": (pa.string(), [sha256(",".join(m).encode()) for m in met]),
            "contaminated": (pa.bool_(), [n > 0 for n in n_hit]),
            "items": (pa.list_(pa.string()), met),
            "spans": (_SPAN, [_original(t, r) for t, r in zip(texts, ranges)]),
        })


def _in_turn(benchmark: DataFrame, id_col: str, text_col: str):
    """The only block and None, or None and the blocks one by one."""
    blocks = item_blocks(benchmark, id_col, text_col)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return first, None

    def each(first, second):
        yield first
        del first
        yield second
        del second
        yield from blocks

    return None, each(first, second)


def _hit_texts(texts: DataFrame, blocks: Iterator[list[tuple[str, bytes]]], size: int) -> DataFrame:
    """(digest, items, ranges) of the distinct texts (column text) that any block hits."""
    spark = texts.sparkSession
    path = scratch_path(spark, "hits")
    texts = texts.filter("text is not null").select(F.sha2("text", 256).alias("digest"), "text")

    def hits(batches, items):
        automaton = _automaton(items, size)
        for batch in slices(batches):
            out = []
            for digest, text in zip(batch.column(0).to_pylist(), encoded_texts(batch)):
                found, runs = _hits(normalised(text)[0], automaton) if automaton is not None else ((), ())
                if found:
                    ranges = [{"start": start, "end": end} for start, end in _merged(runs)]
                    out.append((digest, sorted(found), ranges))
            yield record_batch({
                "digest": (pa.string(), [row[0] for row in out]),
                "items": (pa.list_(pa.string()), [row[1] for row in out]),
                "ranges": (_SPAN, [row[2] for row in out]),
            })

    schema = "digest string, items array<string>, ranges array<struct<start: long, end: long>>"
    for items in blocks:
        found = texts.mapInArrow(lambda batches, items=items: hits(batches, items), schema)
        found.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path).groupBy("digest").agg(
        *[F.flatten(F.collect_set(name)).alias(name) for name in ("items", "ranges")]
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document: its words, hit words, items met (as text, sorted) and the hit spans.

    Spans count code points of the original text, end exclusive.
    """
    frame = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start: long, end: long>>").alias("ranges"),
    )
    items, blocks = _in_turn(benchmark, item_col, item_text_col)
    if blocks is not None:
        items = []
        hits = _hit_texts(frame.select("text"), blocks, window)
        joined = frame.select("doc_id", "text", F.sha2("text", 256).alias("digest")).join(hits, "digest", "left")
        frame = joined.select(
            "doc_id", "text",
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("ranges", F.array().cast("array<struct<start: long, end: long>>")).alias("ranges"),
        )
    return frame.mapInArrow(lambda batches: scan(batches, items, window), RESULT)


def keep_clean(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows, with all their columns, whose text holds no window of an item."""
    at = documents.columns.index(text_col)

    def clean(batches, items):
        automaton = _automaton(items, window)
        for batch in slices(batches, at):
            keep = [
                automaton is None or not _hits(normalised(text)[0], automaton)[0]
                for text in encoded_texts(batch, at)
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    items, blocks = _in_turn(benchmark, item_col, item_text_col)
    if blocks is None:
        return documents.mapInArrow(lambda batches: clean(batches, items), documents.schema)
    hits = _hit_texts(documents.select(F.col(text_col).alias("text")), blocks, window)
    hits = hits.select(F.col("digest").alias("__hit"))
    return documents.join(hits, F.sha2(F.col(text_col), 256) == F.col("__hit"), "left_anti")
