"""The pipeline against a plain version of its stages, and its place among the queries."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from trialweave.llm import language, secrets
from trialweave.llm.queries import ORACLE_SQL, QUERIES
from trialweave.session import shared_folder

from . import brute

OPERATORS = {
    1: "html_text", 2: "language", 3: "token_counts", 4: "decontamination", 5: "suffix_dedup", 6: "byte_bpe",
    7: "simhash", 8: "embedding_dedup", 9: "window_dedup", 10: "secrets",
    11: "whitening", 12: "prefix_trie", 13: "imatch",
}


def test_every_operator_is_registered():
    names = {f"op{n}_{name}" for n, name in OPERATORS.items()}
    assert names == set(QUERIES)
    assert names | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE_SQL) <= names


def test_pipeline_against_plain_stages(spark, documents, benchmark, corpus, items, tmp_path):
    folder = str(tmp_path / "tables")
    documents.write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    model = language.Model(language.labelled_sample(documents))
    kept = [(d, t) for d, t in corpus if model.predict([t])[0][0] != "und"]
    kept = brute.representatives(kept)
    hits = brute.contamination(kept, items)
    kept = [row for row, (_, hit, _) in zip(kept, hits) if not hit]
    tokenizer = brute.tokenizer()
    expected = Counter()
    for doc, text in kept:
        text = secrets.redact(text)
        ids = tokenizer.encode_ordinary(text)
        expected[doc, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(text.encode())] += 1
    rows = corpus_pipeline.run(spark, folder).collect()
    assert Counter(tuple(row) for row in rows) == expected
    assert 0 < len(rows) < len(corpus)


def test_the_pipeline_leaves_one_stage_behind(spark, documents, benchmark, tmp_path):
    folder = str(tmp_path / "tables")
    documents.limit(20).write.parquet(f"{folder}/documents.parquet")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    shared = Path(shared_folder(spark).removeprefix("file:")) / "trialweave"
    before = set(shared.glob("*"))
    assert corpus_pipeline.run(spark, folder).count() > 0
    left = [p.name.rsplit("-", 1)[0] for p in set(shared.glob("*")) - before]
    assert left.count("pipeline-secrets") == 1 and left.count("links") == 1
    assert not {"pipeline-language", "pipeline-simhash", "pipeline-decontamination"} & set(left)


def test_all_but_the_last_stage_return_the_columns_of_documents(spark, documents, benchmark, tmp_path):
    folder = str(tmp_path / "tables")
    benchmark.write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, folder).schema == documents.schema


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = duck.execute(ORACLE_SQL[name])
    columns = [column[0] for column in expected.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(columns)
    got = Counter(tuple(row[c] for c in columns) for row in frame.collect())
    assert got == Counter(expected.fetchall())
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {c: kinds[k] for c, k in frame.dtypes} == {c[0]: str(c[1]) for c in expected.description}
