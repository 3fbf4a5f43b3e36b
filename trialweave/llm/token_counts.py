"""Token counts that follow edits, from a segment tree of pre-tokens per document.

The leaves of a document's tree are runs of ``LEAF`` pre-tokens; every node holds the characters and the
tokens below it. An edit replaces a stretch of characters. The tree leads to the leaf where the stretch
begins; pre-tokens that end ``CONTEXT`` or more characters before it stay, as the pattern looks no
further ahead. From there the text is split again until a border of the new split is also one of the
old split behind the edit: the pattern looks at nothing before a border, so what follows is unchanged.
Only the pre-tokens in between are encoded, and the sums on the way to the root are updated.

Edits of a document refer to its text as it came. Of edits that overlap the one that starts first holds
(of equal starts the one that ends first), the others are left out; edits beyond the text are cut to it.

Defined results: a null or empty text has no tokens and may still be given text by an edit; null edits
are none; a null replacement deletes; repeated rows stay apart. Only the id, text and edits columns
are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.byte_bpe import Codec, codec_of, explicit_pattern, sentencepiece_model, vocabulary
from trialweave.llm.common import record_batch, slices

LEAF = 16
# The pattern's contractions look at most two characters beyond a pre-token that ends before them.
CONTEXT = 2
EDITS = "array<struct<start: long, end: long, replacement: string>>"
SCHEMA = (
    "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_chars_after long, "
    "n_reencoded long"
)


class TokenTree:
    """The sums of one document; ``chars`` and ``tokens`` are heaps with the root at 1."""

    def __init__(self, codec: Codec, words: list[str]):
        self.codec = codec
        self.words = words
        self.edited: dict[int, list[str]] = {}
        self.reencoded = 0
        leaves = max(1, -(-len(words) // LEAF))
        self.size = 1 << (leaves - 1).bit_length()
        known = codec.known
        self.chars = self._heap(list(map(len, words)))
        self.tokens = self._heap([len(known[w]) // 4 for w in words])

    def _heap(self, values: list[int]) -> list[int]:
        padded = np.zeros(self.size * LEAF, np.int64)
        padded[: len(values)] = values
        levels = [padded.reshape(-1, LEAF).sum(axis=1)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return [0, *(int(v) for level in reversed(levels) for v in level)]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def leaf_words(self, leaf: int) -> list[str]:
        return self.edited.get(leaf, self.words[leaf * LEAF : (leaf + 1) * LEAF])

    def text(self) -> str:
        return "".join(w for leaf in range(self.size) for w in self.leaf_words(leaf))

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before that leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if place >= before + self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.size, before

    def _set(self, leaf: int, words: list[str]) -> None:
        self.edited[leaf] = words
        node = leaf + self.size
        chars = sum(map(len, words))
        tokens = sum(len(self.codec.known[w]) // 4 for w in words)
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def replace(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters from ``start`` up to ``end``."""
        first, before = self.find(max(0, start - CONTEXT))
        old: list[str] = []
        borders: list[int] = []
        last, at = first, before

        def extend() -> None:
            nonlocal last, at
            for word in self.leaf_words(last):
                old.append(word)
                at += len(word)
                borders.append(at)
            last += 1

        while last < self.size and (not borders or borders[-1] <= end):
            extend()
        while True:
            text = "".join(old)
            keep = sum(1 for border in borders if border <= start - CONTEXT)
            restart = (borders[keep - 1] if keep else before) - before
            changed = text[restart : max(start - before, 0)] + replacement + text[end - before :]
            shift = before + restart
            # Borders of the old split behind the edit, as places in the changed text.
            moved = len(replacement) - (end - start)
            goals = {border + moved - shift: i + 1 for i, border in enumerate(borders) if border >= end}
            at_end = last >= self.size or before + len(text) >= self.chars[1]
            new, place, met = [], 0, None
            safe = len(changed) if at_end else len(changed) - CONTEXT - 1
            for word in self.codec.find(changed):
                place += len(word)
                if place > safe:
                    break
                new.append(word)
                if place in goals:
                    met = goals[place]
                    break
            if met is not None or at_end:
                break
            extend()
        rest = old[met:] if met is not None else []
        self.codec.learn([old, new])
        self.reencoded += len(new)
        for leaf in range(first + 1, last):
            self._set(leaf, [])
        self._set(first, old[:keep] + new + rest)


def ordered_edits(edits: Iterable[dict], length: int) -> list[tuple[int, int, str]]:
    """Edits within the text, without overlaps, the last one first."""
    out: list[tuple[int, int, str]] = []
    cut = [
        (min(max(e["start"], 0), length), min(max(e["end"], e["start"], 0), length), e["replacement"] or "")
        for e in edits
        if e is not None and e["start"] is not None and e["end"] is not None
    ]
    for start, end, replacement in sorted(cut):
        if not out or start >= out[-1][1]:
            out.append((start, end, replacement))
    return out[::-1]


def count_tokens(
    documents: DataFrame,
    vocabulary_path: str,
    pattern: str,
    edits_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document its tokens before and after its edits, and the pre-tokens that were encoded anew.

    ``edits_col`` is an array of (start, end, replacement) in code points, end exclusive.
    """
    tokens = vocabulary(vocabulary_path)
    model, explicit = sentencepiece_model(tokens), explicit_pattern(pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model, tokens, explicit)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            split = [codec.find(text) for text in texts]
            codec.learn(split)
            rows = []
            for words, text, edits in zip(split, texts, batch.column(2).to_pylist()):
                if any(w not in codec.known for w in words):
                    codec.learn([words])  # edits of others may have pushed some out
                tree = TokenTree(codec, words)
                before = tree.n_tokens
                todo = ordered_edits(edits or (), len(text))
                for edit in todo:
                    tree.replace(*edit)
                rows.append((before, len(todo), tree.n_tokens, tree.n_chars, tree.reencoded))
            columns = list(zip(*rows)) or [()] * 5
            names = ("n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_reencoded")
            yield record_batch(
                {"doc_id": (pa.int64(), batch.column(0).to_pylist())}
                | {name: (pa.int64(), list(values)) for name, values in zip(names, columns)}
            )

    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(edits_col).cast(EDITS).alias("edits"),
    )
    return source.mapInArrow(run, SCHEMA)


# What the masking edits replace: mail addresses, network addresses, runs of four or more digits.
MASKED = (
    (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<mail>"),
    (re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])"), "<address>"),
    (re.compile(r"[0-9]{4,}"), "<number>"),
)


def with_masking_edits(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits"
) -> DataFrame:
    """(id, text, edits): the edits that mask personal data, and one that ends the text with a line end."""

    def run(batches):
        for batch in slices(batches):
            edits = []
            for text in batch.column(1).to_pylist():
                found = [
                    {"start": m.start(), "end": m.end(), "replacement": mask}
                    for pattern, mask in MASKED
                    for m in pattern.finditer(text or "")
                ]
                end = len(text or "")
                if text and not text.endswith("\n"):
                    found.append({"start": end, "end": end, "replacement": "\n"})
                edits.append(found)
            kind = pa.list_(
                pa.struct([("start", pa.int64()), ("end", pa.int64()), ("replacement", pa.string())])
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(edits, kind)], [id_col, text_col, edits_col]
            )

    source = documents.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col))
    return source.mapInArrow(run, f"`{id_col}` long, `{text_col}` string, `{edits_col}` {EDITS}")
