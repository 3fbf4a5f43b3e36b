from __future__ import annotations

import pytest

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, empty, blank, long and repeated rows."""
    shared = brute.prose(1, 60)
    texts: list[tuple[int | None, str | None]] = [
        (i, brute.prose(100 + i, 30 + 17 * (i % 9))) for i in range(30)
    ]
    base = brute.prose(2, 400)
    words = base.split()
    texts += [(40 + i, base) for i in range(5)]
    texts += [(50 + i, " ".join(words[: 390 - i] + [f"new{i}"] + words[391 - i :])) for i in range(6)]
    texts += [(60 + i, f"{brute.prose(300 + i, 40)} {shared} {brute.prose(400 + i, 40)}") for i in range(5)]
    texts += [(70, None), (71, ""), (72, " \n\t "), (73, "Öl. 12"), (None, base), (None, None)]
    texts += [(74, "été " * 5000), (75, brute.prose(9, 20000)), (76, "x" * 3000), (77, "ab" * 700)]
    texts += [(80, shared), (80, shared), (80, "other words of the same id")]
    return texts


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [
        (doc, text, ["en", "fr", None][i % 3], None if i % 5 == 0 else "s", None if text is None else len(text))
        for i, (doc, text) in enumerate(corpus)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="session")
def items():
    return [
        (1, brute.prose(1, 60)),
        (2, "ÖL 12"),
        (3, None),
        (4, "..."),
        (None, brute.prose(2, 400)),
        (5, " ".join(brute.prose(2, 400).split()[100:130])),
        (5, "the second text of an item"),
        (10, brute.prose(9, 20000)[50_000:50_400]),
    ]
