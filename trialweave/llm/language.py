"""Language identification by cross-parsing entropy.

Each language is a suffix automaton over a sample of labelled text. A document is cut into the
longest phrases that the automaton of a language knows; the language that needs the fewest phrases,
each weighted with the logarithm of the sample's length, wins.

Texts are compared as letters in lower case, in UTF-8, with one separator for anything between them: a
symbol is a byte, so that letters of any number and script need few columns. A text is parsed in blocks of ``BLOCK`` symbols, all blocks of a batch and all languages in step: the automata
are tables with one row per state, a missing step leads where a new phrase would go and counts it.
Blocks cost at most one more phrase each, for every language alike; the whole text is parsed.

The sample is bounded by the parameters below: at most ``SAMPLE_ROWS`` labelled texts per language of
``SHORTEST`` to ``LONGEST`` characters, picked by a hash of the id, and ``SAMPLE_SYMBOLS`` symbols over
all languages, in equal shares of ``LEAST_SYMBOLS`` or more. Every label is learned.

Defined results: a null text and a text without letters are ``und`` with score 0, as is every text
if nothing was labelled; ties go to the first language by name; rows with equal ids stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trialweave.llm.common import record_batch, slices

UNKNOWN = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
SAMPLE_ROWS = 40
SHORTEST, LONGEST = 100, 20_000
SAMPLE_SYMBOLS = 160_000
LEAST_SYMBOLS = 200
BLOCK = 512
LANGUAGES_AT_ONCE = 64
# Bytes that no sample has are one symbol that no automaton knows.
SEPARATOR, STRANGE = 0, 1
BLANK = 0x20


def held_out(id_col: str) -> Column:
    """Rows kept from training: CRC-32 of the id as text leaves 2 when divided by 4."""
    remainder = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def labelled_sample(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, list[str]]:
    """Bounded training texts per language; the pick depends on ids, labels and lengths only."""
    rows = documents.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.filter(~held_out("id"))
    languages = sorted(row["lang"] for row in rows.select("lang").distinct().collect())
    # Of a long text no more is read than fills the language's share several times.
    most = min(LONGEST, 4 * _share(len(languages)))
    fitting = rows.filter(F.length("text").between(SHORTEST, LONGEST))
    order = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    picked = (
        fitting.select("id", "lang")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= SAMPLE_ROWS)
        .collect()
    )
    chosen = {row["id"]: (row["lang"], row["rank"]) for row in picked}
    texts: dict[str, list[str]] = {lang: [] for lang in languages}
    found = fitting.filter(F.col("id").isin(list(chosen)))
    found = found.select("id", "lang", F.substring("text", 1, most).alias("text")).collect()
    for row in sorted(found, key=lambda r: (chosen[r["id"]][1], r["text"])):
        if row["lang"] == chosen[row["id"]][0]:
            texts[row["lang"]].append(row["text"])
    # A language whose texts are all too short or too long learns from any of them.
    without = [lang for lang in languages if not texts[lang]]
    if without:
        some = rows.filter(F.col("lang").isin(without))
        some = some.select("id", "lang", F.substring("text", 1, most).alias("text"))
        some = some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE_ROWS)
        for row in sorted(some.collect(), key=lambda r: (r["lang"], r["rank"])):
            texts[row["lang"]].append(row["text"])
    return texts


def _share(languages: int) -> int:
    return max(LEAST_SYMBOLS, SAMPLE_SYMBOLS // max(1, languages))


def symbol_table(samples: dict[str, list[str]]) -> np.ndarray:
    """Symbol of every byte: separator, strange byte, or a byte of the samples' letters."""
    seen = np.zeros(256, np.int64)
    for text in (text for texts in samples.values() for text in texts):
        seen += np.bincount(_letter_bytes(text), minlength=256)
    seen[BLANK] = 0
    table = np.full(256, STRANGE, np.uint16)
    table[BLANK] = SEPARATOR
    known = np.flatnonzero(seen)
    table[known] = np.arange(2, 2 + len(known))
    return table


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _letter_bytes(text: str) -> np.ndarray:
    """The letters in lower case as UTF-8, with a blank for any other character."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.where(_letters()[points], points, np.uint32(BLANK))
    return np.frombuffer(letters.tobytes().decode("utf-32-le").encode(), np.uint8)


def symbols_of(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols with runs of separators made one, none at either end."""
    symbols = table[_letter_bytes(text)]
    blank = symbols == SEPARATOR
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]
    symbols = symbols[keep]
    if len(symbols) and symbols[0] == SEPARATOR:
        symbols = symbols[1:]
    if len(symbols) and symbols[-1] == SEPARATOR:
        symbols = symbols[:-1]
    return symbols


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that knows every substring; state 0 is the start."""
    steps: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for symbol in symbols:
        state = len(steps)
        steps.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in steps[p]:
            steps[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = steps[p][symbol]
            if longest[q] == longest[p] + 1:
                link[state] = q
            else:
                copy = len(steps)
                steps.append(dict(steps[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                link[q] = link[state] = copy
                while p >= 0 and steps[p].get(symbol) == q:
                    steps[p][symbol] = copy
                    p = link[p]
        last = state
    return steps


class Model:
    """The automata of all languages in one table of (next row, new phrase?) entries."""

    def __init__(self, samples: dict[str, list[str]]):
        self.table = symbol_table(samples)
        self.width = int(self.table.max()) + 2  # one more column, for the fill of short blocks
        self.fill = self.width - 1
        self.languages = sorted(samples)
        share = _share(len(samples))
        parts, starts, weights, offset = [], [], [], 0
        for lang in self.languages:
            pieces = [symbols_of(text, self.table) for text in samples[lang]]
            joined = [int(s) for piece in pieces for s in [*piece, SEPARATOR]][:share]
            automaton = suffix_automaton(joined)
            parts.append(self._rows(automaton, offset))
            starts.append(offset)
            weights.append(np.log2(len(joined) + 2))
            offset += len(automaton)
        self.steps = np.concatenate(parts).ravel() if parts else np.zeros(0, np.int32)
        self.starts = np.array(starts, np.int64)
        self.weights = np.array(weights)

    def _rows(self, automaton: list[dict[int, int]], offset: int) -> np.ndarray:
        width = self.width
        again = np.full(width, offset * width, np.int64)
        for symbol, state in automaton[0].items():
            again[symbol] = (offset + state) * width
        rows = np.tile((again << 1) | 1, (len(automaton), 1))
        for state, steps in enumerate(automaton):
            for symbol, following in steps.items():
                rows[state, symbol] = ((offset + following) * width) << 1
            rows[state, self.fill] = ((offset + state) * width) << 1
        return rows if rows.max() > np.iinfo(np.int32).max else rows.astype(np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each language (column) needs for each text (row), weighted."""
        counts = np.array([max(1, -(-len(t) // BLOCK)) for t in texts])
        first = np.concatenate([[0], np.cumsum(counts)])
        blocks = np.full((first[-1], BLOCK), self.fill, np.uint16)
        for text, row, rows in zip(texts, first, counts):
            blocks[row : row + rows].ravel()[: len(text)] = text
        # Full blocks first, so that the steps of the last symbols need only the blocks they have.
        filled = (blocks != self.fill).sum(axis=1)
        order = np.argsort(-filled, kind="stable")
        columns = np.ascontiguousarray(blocks[order].T).astype(np.int32)
        active = np.searchsorted(-filled[order], -np.arange(BLOCK), side="left")
        by_text = [
            self._found(starts, columns, active, filled, order, first)
            for starts in np.split(self.starts, range(LANGUAGES_AT_ONCE, len(self.starts), LANGUAGES_AT_ONCE))
        ]
        return np.concatenate(by_text).T * self.weights

    def _found(self, starts, columns, active, filled, order, first) -> np.ndarray:
        """Phrases that the languages (rows) of some first states need for each text (column)."""
        states = np.repeat((starts * self.width).astype(self.steps.dtype)[:, None], len(order), axis=1)
        found = np.zeros(states.shape, np.int32)
        for column, n in zip(columns, active):
            if not n:
                break
            entry = self.steps[states[:, :n] + column[:n]]
            found[:, :n] += entry & 1
            states[:, :n] = entry >> 1
        found += filled[order] > 0  # the phrase that the end of a block cuts off
        by_block = np.empty_like(found)
        by_block[:, order] = found
        return np.add.reduceat(by_block, first[:-1], axis=1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        symbols = [symbols_of(text or "", self.table) for text in texts]
        if not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        costs = self.phrases(symbols)
        out = []
        for piece, cost in zip(symbols, costs):
            if not len(piece):
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmin(cost))
            others = np.delete(cost, best)
            lead = 1.0 - cost[best] / others.min() if len(others) else 1.0
            out.append((self.languages[best], float(lead)))
        return out


_MODELS: dict[int, Model] = {}


def model_of(samples: dict[str, list[str]]) -> Model:
    """The model of some samples, built once in each worker process."""
    key = hash(tuple((lang, tuple(texts)) for lang, texts in sorted(samples.items())))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(samples)
    return _MODELS[key]


def identify(
    documents: DataFrame,
    samples: dict[str, list[str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Per document the language of its whole text; the score is the lead over the second best."""
    if samples is None:
        samples = labelled_sample(documents, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]):
        model = model_of(samples)
        for batch in slices(batches):
            predicted = model.predict(batch.column(1).to_pylist())
            yield record_batch({
                "doc_id": (pa.int64(), batch.column(0).to_pylist()),
                "held_out": (pa.bool_(), batch.column(2).to_pylist()),
                "lang_pred": (pa.string(), [lang for lang, _ in predicted]),
                "score": (pa.float64(), [score for _, score in predicted]),
            })

    source = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        held_out(id_col).alias("held_out"),
    )
    return source.mapInArrow(run, SCHEMA)


def keep_identified(
    documents: DataFrame,
    samples: dict[str, list[str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The rows, with all their columns, whose text has a language.

    A row without a label gets the predicted one; the others keep theirs.
    """
    if samples is None:
        samples = labelled_sample(documents, id_col, text_col, lang_col)
    at, lang_at = (documents.columns.index(name) for name in (text_col, lang_col))

    def run(batches: Iterator[pa.RecordBatch]):
        model = model_of(samples)
        for batch in slices(batches, at):
            predicted = [lang for lang, _ in model.predict(batch.column(at).to_pylist())]
            labels = batch.column(lang_at)
            filled = pc.coalesce(labels, pa.array(predicted, labels.type))
            batch = batch.set_column(lang_at, batch.schema.field(lang_at), filled)
            yield batch.filter(pa.array([lang != UNKNOWN for lang in predicted], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
