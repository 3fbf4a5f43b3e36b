"""Entropy spans against a plain version, the allow list against plain patterns, and long runs."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from trialweave.llm import secrets

from .conftest import SCHEMA
from .test_operators import crowded

# The allow list as whole patterns: slow on long runs, plain to read.
PLAIN = (
    r"[0-9+/_=-]+",
    r"[+/_=-]*[A-Za-z]?[a-z]*(?:[+/_=-]+[A-Za-z]?[a-z]*)*",
    r"[A-Z+/_=-]+",
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
    r"(?:/?[a-z0-9_.-]*[a-z]{3,}[a-z0-9_.-]*)(?:/[a-z0-9_.-]*)+",
    r"(?i).*(?:example|sample|placeholder|xxxx).*",
)
ALPHABETS = ("abcAB1-/", "abAB/_=", "0123456789abcdef-", "xX1", "ABC+/", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/")


def plain_spans(text):
    """Every window of every candidate by the formula, marked place by place."""
    found = []
    for match in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        word = match.group()
        if any(re.fullmatch(p, word) for p in PLAIN):
            continue
        limit = 3.8
        if re.fullmatch(r"[A-Za-z0-9]+", word):
            limit = 3.6
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", word):
            limit = 3.0
        marks = [False] * len(word)
        for i in range(len(word) - 19):
            counts = Counter(word[i : i + 20]).values()
            if -sum(n / 20 * math.log2(n / 20) for n in counts) > limit + 1e-9:
                marks[i : i + 20] = [True] * 20
        for run in re.finditer("1+", "".join("01"[m] for m in marks)):
            found.append((match.start() + run.start(), match.start() + run.end()))
    return found


@settings(max_examples=400, deadline=None)
@given(st.sampled_from(ALPHABETS), st.integers(1, 30), st.randoms())
def test_the_allow_list_equals_its_patterns(alphabet, length, chance):
    word = "".join(chance.choice(alphabet) for _ in range(length))
    for candidate in (word, word.lower(), "/" + word, word + "Example1", "550e8400-e29b-41d4-a716-446655440000"):
        assert secrets.allowed(candidate) == any(re.fullmatch(p, candidate) for p in PLAIN)


def odd_text(seed):
    chance = random.Random(seed)
    parts = []
    for _ in range(40):
        alphabet = chance.choice(ALPHABETS)
        parts.append("".join(chance.choice(alphabet) for _ in range(chance.randrange(1, 60))))
    parts += ["-" * 12 + "Part2", "token = " + "aB3dE6gH9jK2mN5pQ8" * 2, "AKIA" + "Z9X8" * 5]
    chance.shuffle(parts)
    return chance.choice([" ", "\n", " é "]).join(parts)


@pytest.mark.parametrize("seed", range(30))
def test_entropy_spans_equal_plain_ones(seed):
    text = odd_text(seed)
    spans = plain_spans(text)
    assert secrets.entropy_spans(text) == spans
    base, every = secrets.all_spans(text)
    inside = [s for s in spans if any(a <= s[0] and s[1] <= b for a, _, b in base)]
    assert [(s, e) for s, kind, e in every if kind == 3] == [s for s in spans if s not in inside]


RUNS = (
    "-" * 10_000 + "Chapter1", "=" * 10_000 + "Part2", "_" * 10_000 + "x1", "-=_+/" * 2_000 + "Chapter1",
    "abcdefghij" * 10_000 + "Q9+", "/abcdefg" * 12_500 + "Q9+", "aB1" * 30_000, "token" + " " * 100_000 + "x",
    "deadbeef01234567 " * 8_000, "AKIA" * 25_000, "a1-" * 30_000,
)


@pytest.mark.parametrize("text", RUNS, ids=lambda text: text[-12:])
def test_long_runs_take_linear_time(text):
    began = time.perf_counter()
    secrets.redact(text)
    assert time.perf_counter() - began < 2


def test_many_spans_take_linear_time():
    chance = random.Random(2)
    text = " ".join("".join(chance.choices("0123456789abcdef", k=40)) for _ in range(4_000))
    text += "".join(" " + "".join(chance.choices("abcdefghijkABCDEFGHIJK0123456789", k=30)) for _ in range(4_000))
    began = time.perf_counter()
    base, every = secrets.all_spans(text)
    assert len(base) == 4_000 and len(every) > 7_000 and time.perf_counter() - began < 3


def test_documents_of_rulers_pass_the_stage(spark):
    rows = [(i, f"{line}\nsome words", "en", None, None) for i, line in enumerate(RUNS)]
    frame = crowded(spark.createDataFrame(rows, SCHEMA))
    stage = dict(corpus_pipeline.STAGES)["secrets"]
    kept = stage(spark, frame, "/none").collect()
    assert len(kept) == len(RUNS)
    assert {r["doc_id"]: r["text"] for r in kept} == {i: secrets.redact(text) for i, text, *_ in rows}
