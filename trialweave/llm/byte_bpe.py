"""Byte-level BPE: a rank file becomes a sentencepiece model, which encodes pre-tokens.

The model is written straight from the vocabulary: piece number = rank, its text the bytes mapped to
one character each, its score the negative rank, normalisation the identity without blanks added,
removed or marked. Sentencepiece merges the pair of best score first, the leftmost of equals, which is
the order of the ranks. Decoding looks up the bytes of each id.

Pre-tokens are the matches of the vocabulary's pattern. Its three classes (letters, numbers, white
space) are written out as ranges, so that the fast standard matcher gives exactly these classes.

A worker keeps the ids of up to ``KEPT`` pre-tokens and encodes the unseen ones of a slice together.

Defined results: a null or empty text has no tokens; characters of special tokens are ordinary text;
repeated rows stay apart. Only the id and text columns are read.
"""

from __future__ import annotations

import base64
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import record_batch, sha256, slices

KEPT = 250_000
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "doc_id long, ids array<int>"
# The characters with the property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def vocabulary(path: str) -> list[bytes]:
    """The byte strings of a rank file in the order of their ranks, which must have no gap."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"the ranks of {path} are not the numbers from 0")
    return [ranks[i] for i in range(len(ranks))]


def byte_characters() -> dict[int, str]:
    """One visible character per byte: printable Latin-1 for itself, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    out.append(number)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a serialised message: text or message, whole number, or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised model whose piece i is token i; one more piece stands for the unknown."""
    character = byte_characters()
    pieces = []
    for rank, token in enumerate(tokens):
        text = "".join(character[b] for b in token).encode()
        pieces.append(_field(1, _field(1, text) + _field(2, float(-rank)) + _field(3, 1)))
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = b"".join((
        _field(3, 2),  # model type BPE
        _field(4, len(tokens) + 1),
        _field(24, 0),  # white space is no suffix
        _field(40, len(tokens)),  # the unknown
        _field(41, (1 << 64) - 1),  # no begin, end and padding pieces
        _field(42, (1 << 64) - 1),
        _field(43, (1 << 64) - 1),
    ))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normaliser)


def _ranges(kind: str) -> str:
    """The characters whose general category begins with ``kind``, as ranges of a class."""
    out, first, previous = [], None, None
    for code in range(sys.maxunicode + 2):
        inside = code <= sys.maxunicode and unicodedata.category(chr(code)).startswith(kind)
        if inside and first is None:
            first = code
        elif not inside and first is not None:
            out.append((first, code - 1))
            first = None
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in out)


def explicit_pattern(pattern: str) -> str:
    r"""The pattern with ``\p{L}``, ``\p{N}`` and ``\s`` written out as ranges."""
    ranges = {r"\p{L}": _ranges("L"), r"\p{N}": _ranges("N"), r"\s": WHITE_SPACE}
    pattern = pattern.replace(r"\S", f"[^{WHITE_SPACE}]")

    def within(match: re.Match) -> str:
        inner = match.group(0)
        for name, text in ranges.items():
            inner = inner.replace(name, text)
        return inner

    # First the classes in brackets, then the ones that stand alone.
    pattern = re.sub(r"\[\^?(?:\\[ps](?:\{[LN]\})?)+\]", within, pattern)
    for name, text in ranges.items():
        pattern = pattern.replace(name, f"[{text}]")
    return pattern


class Codec:
    """Encodes and decodes with one vocabulary; holds the ids of frequent pre-tokens."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = np.array([*tokens, b""], object)
        self.find = re.compile(pattern).findall
        self.character = {b: c for b, c in byte_characters().items()}
        self.known: dict[str, bytes] = {}

    def mapped(self, pre_token: str) -> str:
        return pre_token.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.character)

    def learn(self, split: list[list[str]]) -> None:
        """Encode the pre-tokens that are not known yet, together."""
        wanted: set[str] = set()
        wanted.update(*split)
        if len(self.known) + len(wanted) > KEPT:
            self.known = {w: self.known[w] for w in wanted if w in self.known}
        unseen = [w for w in wanted if w not in self.known]
        if unseen:
            ids = self.processor.encode([self.mapped(w) for w in unseen], num_threads=1)
            self.known.update(
                (w, np.array(found, "<u4").tobytes()) for w, found in zip(unseen, ids)
            )

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian 32-bit."""
        split = [self.find(text) for text in texts]
        self.learn(split)
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")])


_CODECS: dict[int, Codec] = {}


def codec_of(model: bytes, tokens: list[bytes], pattern: str) -> Codec:
    key = hash((model, pattern))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model, tokens, pattern)
    return _CODECS[key]


def _encoded(
    batches: Iterable[pa.RecordBatch], model: bytes, tokens: list[bytes], pattern: str
) -> Iterator[tuple[pa.RecordBatch, list[bytes], Codec]]:
    codec = codec_of(model, tokens, pattern)
    for batch in slices(batches):
        yield batch, codec.encode([text or "" for text in batch.column(1).to_pylist()]), codec


def _source(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )


def encode(
    documents: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document the ids of its whole text."""
    tokens = vocabulary(vocabulary_path)
    model, explicit = sentencepiece_model(tokens), explicit_pattern(pattern)

    def run(batches):
        for batch, encoded, _ in _encoded(batches, model, tokens, explicit):
            ends = np.cumsum([0] + [len(ids) // 4 for ids in encoded]).astype(np.int32)
            values = np.frombuffer(b"".join(encoded), "<i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    return _source(documents, id_col, text_col).mapInArrow(run, TOKENS)


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document the bytes its ids stand for; input as ``encode`` returns it."""
    tokens = np.array(vocabulary(vocabulary_path), object)

    def run(batches):
        for batch in batches:
            texts = [b"".join(tokens[np.array(ids or [], np.int64)]) for ids in batch.column(1).to_pylist()]
            yield record_batch({
                "doc_id": (pa.int64(), batch.column(0).to_pylist()), "bytes": (pa.binary(), texts)
            })

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip_digests(
    documents: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document its number of tokens and digests of the ids and of the bytes they decode to.

    Encoding and decoding happen in one pass, so that no list of ids leaves its worker.
    """
    tokens = vocabulary(vocabulary_path)
    model, explicit = sentencepiece_model(tokens), explicit_pattern(pattern)

    def run(batches):
        for batch, encoded, codec in _encoded(batches, model, tokens, explicit):
            yield record_batch({
                "doc_id": (pa.int64(), batch.column(0).to_pylist()),
                "n_tokens": (pa.int64(), [len(ids) // 4 for ids in encoded]),
                "ids_sha256": (pa.string(), [sha256(ids) for ids in encoded]),
                "decoded_sha256": (pa.string(), [sha256(codec.decode(ids)) for ids in encoded]),
            })

    return _source(documents, id_col, text_col).mapInArrow(run, DIGESTS)
