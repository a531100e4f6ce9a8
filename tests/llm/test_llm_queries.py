"""The registered corpus queries against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from churnwright.llm import decontaminate, pii, toxicity
from churnwright.llm.common import LOWER, table
from churnwright.llm.queries import ORACLE, QUERIES
from churnwright.session import stage

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    got, want = QUERIES[key](spark, FOLDER), con.sql(ORACLE[key])
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda found: sorted(found, key=str)  # noqa: E731  values as they are: pandas turns a null bigint into NaN on one side only
    assert rows(tuple(r[c] for c in want.columns) for r in got.collect()) == rows(want.fetchall())


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in ORACLE))
def test_query_gives_each_document_once(spark, key):
    rows = QUERIES[key](spark, FOLDER).select("doc_id").toPandas().doc_id
    n = table(spark, FOLDER, "documents").count()
    assert rows.is_unique and (0 < len(rows) <= n if key == "pipeline" else len(rows) == n)


def simhash_grams(text):
    words = text.encode().translate(LOWER).split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def test_pipeline_stages(spark):
    step = lambda k, docs: stage(corpus_pipeline.STAGES[k][1](spark, docs, FOLDER), "test-stage")
    docs = table(spark, FOLDER, "documents")
    model = toxicity.learn(docs, table(spark, FOLDER, "labels"))
    calm = step(0, docs)
    score = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert {r.doc_id for r in calm.collect()} == {d for d, s in score.items() if s < 0.5}
    one = step(1, calm)
    texts = {r.doc_id: r.text for r in calm.collect()}
    left = {r.doc_id for r in one.collect()}
    grams = {d: simhash_grams(t) for d, t in texts.items()}
    alike = lambda a, b: len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])
    lost = [d for d in texts if d not in left and not any(alike(d, e) for e in texts if e < d)]
    equal = [d for d in left if any(texts[d] == texts[e] for e in texts if e < d)]
    assert not lost and not equal and len(left) < len(texts)
    fresh = step(2, one)
    found = decontaminate.matches(one, table(spark, FOLDER, "benchmark")).collect()
    assert {r.doc_id for r in fresh.collect()} == {r.doc_id for r in found if not (r.hits and 20 * len(r.hits) >= r.n_words)}
    safe = step(3, fresh)
    assert calm.columns == one.columns == fresh.columns == safe.columns == docs.columns
    assert pii.personal_data(safe, {"trees": [], "cuts": {}}).where("size(chosen) > 0").count() == 0
    tokens = corpus_pipeline.STAGES[4][1](spark, safe, FOLDER).collect()
    assert len(tokens) == safe.count() and all(r.n_tokens == len(np.frombuffer(r.ids, "<u4")) for r in tokens)
