"""Classifiers by held-out rows, nearest neighbours and the pipeline against plain Python."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from joinscope.llm import block_ann, quality_fm, toxicity_knn
from joinscope.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def confusion(spark, name, label):
    rows = QUERIES[name](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id").where("held_out").collect()
    return np.array([[sum(r[label] == a and r.predicted == b for r in rows) for b in (0, 1)] for a in (0, 1)]), rows


def test_quality_on_held_out_rows(spark):
    m, rows = confusion(spark, "op1_quality_fm", "quality")
    assert m.trace() >= 0.95 * m.sum() and all(0 <= r.score <= 1 for r in rows)


def test_toxicity_on_held_out_rows(spark):
    m, rows = confusion(spark, "op10_toxicity_knn", "toxic")
    assert m[1, 1] >= 0.6 * m[1].sum() and m[0, 1] <= 0.02 * m[0].sum()


def test_sample_passes_over_a_text_that_does_not_fit(spark):
    from pyspark.sql import functions as F

    from joinscope.llm.labelled import held_out, labelled_sample

    ids = [r.id for r in spark.range(40).where(~held_out(F.col("id"))).orderBy(F.xxhash64("id")).collect()]
    docs = spark.createDataFrame([(i, "x" * (1000 if i == ids[0] else 10)) for i in ids], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    assert labelled_sample(docs, labels, "toxic", characters=900)["doc_id"].tolist() == sorted(ids[1:])


def test_sum_of_squares_is_the_sum_of_pairs():
    rng = np.random.default_rng(1)
    machine = quality_fm.Machine(0.3, rng.standard_normal(50), rng.standard_normal((50, 4)), (np.zeros(1), np.ones(1)))
    at, x = np.array([3, 7, 7, 20, 49]), rng.standard_normal(5)
    pairs = sum(machine.v[at[i]] @ machine.v[at[j]] * x[i] * x[j] for i in range(5) for j in range(i))
    assert machine.logits([(at, x), (at[:1], x[:1])])[0] == pytest.approx(0.3 + machine.w[at] @ x + pairs)


@pytest.fixture(scope="module")
def index():
    words = ["alpha", "beta", "gamma", "delta", "kind", "words"]
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(rng.choice(words, 30)) + (" " + " ".join(rng.choice(["nasty", "vileness", "vilest", "awfulness"], 3)) if bad else "")
        rows.append((i, text, int(bad)))
    return toxicity_knn.Index(pd.DataFrame(rows, columns=["doc_id", "text", "label"]))


def test_block_max_search_is_exact(index):
    for text in ("nasty alpha beta", "vileness " * 5 + "kind", "nasty vilest awfulness gamma " * 3):
        t, w = index.vector(toxicity_knn.Counter(text.split()))
        dense = np.zeros(len(index.ids))
        for b, post in enumerate(index.postings):
            for i, x in zip(t.tolist(), w.tolist(), strict=True):
                if i in post:
                    dense[b * toxicity_knn.BLOCK + post[i][0]] += x * post[i][1]
        order = np.lexsort((index.ids, -np.round(dense, 12)))[: toxicity_knn.K]
        places, cosines = index.nearest(t, w)
        assert places.tolist() == order.tolist() and cosines == pytest.approx(dense[order])


def test_toxicity_has_evidence(index):
    score, examples, cosines = index.judge("So nasty, the vileness of it")
    assert score > 0.7 and len(examples) == len(cosines) == toxicity_knn.K
    assert index.judge("kind words")[0] < 0.1 and index.judge("")[1] == []


def test_classifiers_with_odd_rows(spark, odd_docs, no_docs, odd_rows):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (3, 0, None), (None, 1, 1), (6, None, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    for got in (quality_fm.classify(odd_docs, labels, metadata=("n_chars",)), toxicity_knn.classify(odd_docs, labels)):
        assert got.columns[: len(odd_docs.columns)] == odd_docs.columns
        scores = [r[-1] if isinstance(r[-1], float) else r[-1].score for r in got.collect()]
        assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    for got in (quality_fm.classify(no_docs, labels), toxicity_knn.classify(no_docs, labels.limit(0))):
        assert got.count() == 0


def nearest(rows, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    norm, out = np.sqrt((x * x).sum(axis=1)), {}
    for q in range(len(ids)):
        if ids[q] % 50 == 0:
            s = (x * x[q]).sum(axis=1) / (norm * norm[q])
            others = [(-s[i], ids[i]) for i in range(len(ids)) if ids[i] != ids[q]]
            out[int(ids[q])] = [(int(i), -v) for v, i in sorted(others)[:k]]
    return out


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]


def test_neighbours_of_whole_table(spark, sf_dir):
    rows = usable([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()])
    got = QUERIES["op9_block_ann"](spark, sf_dir).orderBy("query_id", "rank").collect()
    for q, want in nearest(rows, 5).items():
        assert [(r.vec_id, r.score) for r in got if r.query_id == q] == [(i, pytest.approx(s, abs=1e-15)) for i, s in want]


def test_neighbours_with_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(block_ann, "CANDIDATES", 4)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [1.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [-1.0, -2.0]), (50, [1e-30, 3e-30]), (100, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = block_ann.neighbours(df, df.where("vec_id % 50 = 0"), 3).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 0), (50, 2, 1), (50, 3, 2)]
    assert block_ann.neighbours(df.limit(0), df.limit(0), 3).count() == 0


def test_pipeline_runs_and_its_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, before = docs, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, at = at, stage(spark, at, sf_dir)
        at = spark.createDataFrame(at.toPandas(), docs.schema)
        assert at.columns == docs.columns, name
        if name in ("quality_rules", "minhash_dedup"):
            assert 0 < at.count() < before.count()
        if name == "secret_scan":
            assert at.count() == before.count() and at.where(F.col("text").rlike("[0-9a-f]{32}")).isEmpty()
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, sf_dir)
    assert pieces.where("start = 0").count() == at.count()
    assert corpus_pipeline.run(spark, sf_dir).count() == pieces.count()


def test_pipeline_with_odd_rows(spark, odd_docs, no_docs):
    """Odd rows alone fail the quality rules; past these, the smallest id of each group of copies stays."""

    def ids(docs, stages):
        for _, stage in stages:
            docs = stage(spark, docs, None)
        return {r.doc_id for r in docs.collect()}

    assert ids(no_docs, corpus_pipeline.STAGES) == set()
    assert ids(odd_docs, corpus_pipeline.STAGES[:1]).isdisjoint({3, 4, 5, 8, 9, None})
    left = ids(odd_docs, corpus_pipeline.STAGES[1:])
    assert 1 in left and left <= {1, 3, 4, 5, 6, 8, None}
