"""I-Match fingerprints: order of documents, edits, lexicon and likeness against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trialweave.llm import imatch
from trialweave.llm.queries import QUERIES

from . import brute
from .conftest import SCHEMA
from .test_operators import crowded


def plain_terms(text):
    return set(re.findall(r"[^\W_]+", text.lower()))


def plain_fingerprint(text, band):
    """By sets, a subset after the other; ``band`` holds the terms of the lexicon."""
    own = plain_terms(text)
    chosen = sorted(imatch.term_hash(t) for t in (own & band or own)) or [imatch.term_hash(text, 1)]
    levels = imatch._levels(np.array(chosen, np.int64))
    fields = []
    for k in range(imatch.SUBSETS):
        most = max(levels[:, k])
        kept = np.array([h for h, level in zip(chosen, levels[:, k]) if level == most], np.int64)
        fields.append(f"{imatch.xxhash.xxh32_intdigest(kept.tobytes()):08x}")
    return "".join(fields)


def plain(rows):
    """{(id, edited digest, ...)} of (id, text) rows whose order by id and text hash is given."""
    counts = Counter(t for _, text in rows for t in plain_terms(text))
    band = {
        t for t, n in counts.items()
        if len(rows) * math.exp(-imatch.IDF_MOST) <= n <= len(rows) * math.exp(-imatch.IDF_LEAST)
    }
    out = Counter()
    for (doc, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        edited = imatch.edited_text(text, following)
        prints = [plain_fingerprint(t, band) for t in (text, edited, following)]
        near = [imatch.likeness(prints[0], p) for p in prints[1:]]
        out[doc, len(text), brute.sha(edited.encode()), prints[0], prints[1], *near] += 1
    return out


COLUMNS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


def found(frame):
    return Counter(tuple(r[c] for c in COLUMNS) for r in imatch.fingerprint_documents(frame).collect())


def ordered(spark, rows):
    """As the docstring orders them: id, none first, then the hash of the text."""
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "xxhash64(text) AS tie")
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["tie"])
    return [(r["doc_id"], r["text"] or "") for r in sorted(frame.collect(), key=key)]


def test_fingerprints_equal_plain_ones(spark, documents, corpus):
    assert found(crowded(documents)) == plain(ordered(spark, corpus))


def test_one_id_on_a_third_of_all_rows(spark):
    rows = [(None if i % 3 else i, brute.prose(i % 40, 12)) for i in range(150)] + [(5, "same text")] * 60
    rows += [(9, None)] * 20 + [(10, "")] * 3
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(4)
    assert found(frame) == plain(ordered(spark, rows))


def test_few_documents(spark, no_documents):
    assert not found(no_documents)
    alone = spark.createDataFrame([(4, "A b c d", None, None, None)], SCHEMA)
    row = imatch.fingerprint_documents(alone).first()
    assert (row["n_chars"], row["edited_sha256"]) == (7, brute.sha(b"A b c A"))
    assert row["near_next"] == 1.0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, SCHEMA)
    rows = imatch.fingerprint_documents(nulls).collect()
    assert [(r["n_chars"], r["near_edited"], r["near_next"]) for r in rows] == [(0, 1.0, 1.0)] * 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=40), st.randoms())
def test_ranges_keep_the_order(rows, chance):
    firsts = sorted({min(rows), *chance.sample(rows, chance.randrange(len(rows)))})
    keys, ties = (np.array(c, np.int64) for c in zip(*rows))
    place, first = imatch.range_of(firsts, keys, ties)
    for row, at, is_first in zip(rows, place, first):
        assert at == sum(f <= row for f in firsts) - 1
        assert is_first == (row in firsts)


def test_levels_halve(spark):
    levels = imatch._levels(np.array([imatch.term_hash(str(i)) for i in range(20000)], np.int64))
    for level in range(5):
        share = (levels >= level).mean(axis=0)
        assert np.allclose(share, 2.0**-level, atol=0.02)


def test_edits_are_closer_than_other_texts(spark):
    chance = random.Random(4)
    rows = [(i, brute.prose(1000 + i, chance.choice([8, 40, 300, 2000]), 3000)) for i in range(120)]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    out = imatch.fingerprint_documents(frame).collect()
    assert sum(r["near_edited"] > r["near_next"] for r in out) >= 118
    assert np.mean([r["near_edited"] for r in out]) > 0.4 > 0.1 > np.mean([r["near_next"] for r in out])


@pytest.mark.parametrize("text", ["", "İstanbul ǅ ß", "a_b c", "漢字 かな", "...", "x" * 100_000])
def test_terms_are_runs_of_letters_and_digits(text):
    assert imatch.terms(text) == plain_terms(text)


def test_equal_texts_have_equal_fingerprints(spark):
    out = QUERIES["op13_imatch"](spark, "/root/testdata/sf0.01")
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = out.join(texts, "doc_id").collect()
    by_text = {}
    for row in rows:
        by_text.setdefault(row["text"], set()).add(row["fingerprint"])
    assert len(rows) == 1000 and all(len(prints) == 1 for prints in by_text.values())
    assert len(set().union(*by_text.values())) > 0.95 * len(by_text)
