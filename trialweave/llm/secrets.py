"""Secret scans: fixed patterns, and windows of high entropy in candidate strings.

Base patterns (fixed values), each matched leftmost without overlap over the whole text:

* ``assign``: a key word, a separator and a value of 12 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 18 or more characters in all;
* ``hex``: a run of 16 or more lower-case hexadecimal digits.

The entropy method looks at candidate strings of 20 or more characters. A window of that length
slides over a candidate; the counts of its characters, and with them its Shannon entropy, change by
one character in and one out. The limit depends on the character class of the candidate: hexadecimal,
letters and digits, or the wider base-64 set. Windows above the limit that meet form one span. The
allow list then suppresses what is known to be harmless: plain words, numbers, identifiers of version
4, paths, and strings that name themselves examples. Spans inside a base span are not repeated.

Defined results: a null text counts as empty; empty texts have no spans; repeated rows stay apart;
offsets count code points, end exclusive. Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialweave.llm.common import record_batch, sha256, slices

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_entropy long"
)
KINDS = ("assign", "access", "hex", "entropy")

# The base patterns of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGNED, MIN_ACCESS = 12, 18

WINDOW = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
# Bits per character a window must exceed, by the class of its candidate.
LIMITS = {"hex": 3.0, "alnum": 3.6, "base64": 3.8}
_CLASSES = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+")),
    ("alnum", re.compile(r"[A-Za-z0-9]+")),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+")),
)
# What the allow list looks at, each in one pass over a candidate.
_NOT_A_NUMBER = re.compile(r"[A-Za-z]")
_NOT_WORDS = re.compile(r"[0-9]|[A-Za-z][A-Z]")  # a digit, or a capital inside a word
_NOT_CAPITALS = re.compile(r"[a-z0-9]")
_IDENTIFIER = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_NOT_A_PATH = re.compile(r"[A-Z+=]")
_LETTERS = re.compile(r"[a-z]{3}")
_EXAMPLES = ("example", "sample", "placeholder", "xxxx")


def is_path(candidate: str) -> bool:
    """Lower-case pieces between slashes, at least two, of which the first holds a word."""
    if _NOT_A_PATH.search(candidate):
        return False
    first, slash, _ = candidate.removeprefix("/").partition("/")
    return bool(slash and _LETTERS.search(first))


def allowed(candidate: str) -> bool:
    """Whether a candidate is harmless. Its length enters the time once, whatever it holds."""
    return bool(
        not _NOT_A_NUMBER.search(candidate)  # numbers, dates, rulers
        or not _NOT_WORDS.search(candidate)  # words, also joined
        or not _NOT_CAPITALS.search(candidate)  # words in capitals
        or _IDENTIFIER.fullmatch(candidate)
        or is_path(candidate)
        or any(word in candidate.lower() for word in _EXAMPLES)
    )


def assigned(text: str) -> list[tuple[int, int]]:
    # Any match holds a key word, so texts without one need no pattern at all.
    lowered = text.lower()
    if not any(word in lowered for word in KEY_WORDS):
        return []
    return [m.span() for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGNED]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base patterns, in order."""
    found = [(start, 0, end) for start, end in assigned(text)]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def window_entropies(candidate: str, size: int = WINDOW) -> Iterator[float]:
    """The entropy of every window, from the counts of the window before."""
    weight = [0.0] + [n * math.log2(n) for n in range(1, size + 1)]
    counts = Counter(candidate[:size])
    total = sum(weight[n] for n in counts.values())
    whole = math.log2(size)
    yield whole - total / size
    for old, new in zip(candidate, candidate[size:]):
        if old != new:
            total += weight[counts[old] - 1] - weight[counts[old]]
            counts[old] -= 1
            total += weight[counts[new] + 1] - weight[counts[new]]
            counts[new] += 1
        yield whole - total / size


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Stretches of candidates whose windows exceed the limit of their class."""
    found = []
    for match in CANDIDATE.finditer(text):
        candidate = match.group()
        if allowed(candidate):
            continue
        limit = next(LIMITS[name] for name, pattern in _CLASSES if pattern.fullmatch(candidate))
        start = end = -1
        for at, entropy in enumerate(window_entropies(candidate)):
            if entropy <= limit:
                continue
            if at > end:
                if end > 0:
                    found.append((match.start() + start, match.start() + end))
                start = at
            end = at + WINDOW
        if end > 0:
            found.append((match.start() + start, match.start() + end))
    return found


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and entropy spans together."""
    base = base_spans(text)
    # How far the base spans up to each of them reach.
    reach = list(accumulate((end for _, _, end in base), max))
    starts = [start for start, _, _ in base]
    more = []
    for start, end in entropy_spans(text):
        before = bisect_right(starts, start)
        if not before or reach[before - 1] < end:
            more.append((start, 3, end))
    return base, sorted(base + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the number of spans of each kind and the spans as ``kind:start:end``."""

    def run(batches):
        for batch in slices(batches):
            pairs = [all_spans(text or "") for text in batch.column(1).to_pylist()]
            counts = [Counter(kind for _, kind, _ in spans) for _, spans in pairs]
            columns = {"doc_id": (pa.int64(), batch.column(0).to_pylist())}
            for number, name in enumerate(("n_assign", "n_access", "n_hex")):
                columns[name] = (pa.int64(), [c[number] for c in counts])
            columns["base_sha256"] = (pa.string(), [sha256(written(b).encode()) for b, _ in pairs])
            columns["spans"] = (pa.string(), [written(spans) for _, spans in pairs])
            columns["n_entropy"] = (pa.int64(), [c[3] for c in counts])
            yield record_batch(columns)

    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    return source.mapInArrow(run, SCHEMA)


def redact(text: str, mask: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by the mask."""
    out, at = [], 0
    end = -1
    for start, _, stop in all_spans(text)[1]:
        if start >= end:
            out += [text[max(at, 0) : start], mask]
        end = max(end, stop)
        at = end
    out.append(text[at:])
    return "".join(out)


def redact_secrets(documents: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns, secrets in the text masked; the length column follows the text.

    Null texts stay null. Without a length column only the text changes.
    """

    def run(batches):
        for batch in slices(batches, batch_column):
            texts = [None if t is None else redact(t) for t in batch.column(batch_column).to_pylist()]
            columns = list(batch.columns)
            columns[batch_column] = pa.array(texts, batch.schema.types[batch_column])
            if length_at is not None:
                before = columns[length_at].to_pylist()
                old = batch.column(batch_column).to_pylist()
                after = [b if o == n else len(n) for b, o, n in zip(before, old, texts)]
                columns[length_at] = pa.array(after, batch.schema.types[length_at])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    batch_column = documents.columns.index(text_col)
    length_at = documents.columns.index(length_col) if length_col in documents.columns else None
    return documents.mapInArrow(run, documents.schema)
