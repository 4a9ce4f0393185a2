from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from joinscope.llm import embedding_whitening as W
from joinscope.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x string, dim string, rows string"


def whole(v):
    return tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)


def plain(vectors, components=16, counts=False):
    """n, S, eigenvalues, eigenvectors and each vector's deviation, from Python's whole numbers."""
    times = Counter(vectors)
    fit = sorted(times)
    w = np.array([times[v] if counts else 1 for v in fit], float)
    n, x = int(w.sum()), np.array(fit, object)
    sums = [sum(int(a) * int(b) for a, b in zip(x[:, k], w, strict=True)) for k in range(x.shape[1])]
    centred = np.array([[float(n * v - s) / n for v, s in zip(row, sums, strict=True)] for row in fit])
    values, vectors_ = np.linalg.eigh((centred * w[:, None]).T @ centred / n)
    order = np.argsort(-values)[:components]
    white = {v: centred[k] @ vectors_[:, order] / np.sqrt(np.maximum(values[order], 1e-300)) for k, v in enumerate(fit)}
    deviation = {v: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in fit}
    return n, values[order] / values.sum(), white, deviation


def held(rows, result, counts=False):
    vectors = [whole(v) for _, v in rows]
    n, explained, white, deviation = plain(vectors, counts=counts)
    found = {}
    for r in result:
        found.setdefault(r.vec_id, []).append(r)
    sign = None
    for id_, v in rows:
        mine = sorted(found[id_], key=lambda r: r.component)
        if len({i for i, _ in rows}) == len(rows):
            assert [r.component for r in mine] == list(range(1, len(mine) + 1))
        for r in mine:
            assert r.n == n and r.deviation == deviation[whole(v)]
            assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
            assert r.identity_error < 1e-6
        got = np.array([r.whitened for r in mine])
        want = white[whole(v)][: len(got)]
        sign = np.where(got * want < 0, -1, 1) if sign is None else sign
        assert np.allclose(got, want * sign, atol=1e-6)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    got = QUERIES["op12_embedding_whitening"](spark, sf_dir).collect()
    assert len(got) == 16 * len(table)
    held([(r.vec_id, r.embedding) for r in table], got)


def many(spark, seed=3, dim=20, far=0.0):
    """Half of the rows hold one vector, others come twice; more distinct vectors than entries."""
    rng = np.random.default_rng(seed)
    base = [[float(np.float32(c + far)) for c in v] for v in rng.normal(size=(60, dim)) * np.arange(1, dim + 1)]
    vectors = [base[0]] * 100 + base + base[:30]
    rows = list(enumerate(vectors))
    return rows, spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_hot_vector_and_clashing_names(spark, weights):
    rows, df = many(spark)
    held(rows, W.whiten(df, weights=weights).collect(), counts=weights == "count")


def test_far_from_zero(spark):
    rows, df = many(spark, far=30_000.0)
    held(rows, W.whiten(df).collect())


def test_rows_without_part(spark):
    nan, inf = float("nan"), float("inf")
    rows, df = many(spark)
    odd = [(900, None), (901, [1.0, None] + [0.0] * 18), (902, [nan] + [0.0] * 19), (903, [inf] + [0.0] * 19), (904, []), (905, [-inf] * 20)]
    more = spark.createDataFrame([(i, v, None, None, None, None) for i, v in odd], SCHEMA)
    got = W.whiten(df.unionByName(more)).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows}
    held(rows, got)


def test_repeated_rows_and_null_ids(spark):
    rows, df = many(spark)
    null = spark.createDataFrame([(None, rows[5][1], None, None, None, None)] * 2, SCHEMA)
    got = W.whiten(df.unionByName(df.limit(3)).unionByName(null)).collect()
    assert len(got) == 16 * (len(rows) + 3 + 2)
    assert len([r for r in got if r.vec_id is None]) == 32


def test_flat_tables(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 1, "", "", ""), (2, [1.0, 2.0], 1, "", "", "")], SCHEMA)
    assert W.whiten(one).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 1, "", "", "") for i in range(5)], SCHEMA)
    got = W.whiten(line).collect()
    assert {(r.vec_id, r.component) for r in got} == {(i, 1) for i in range(5)}
    assert sum(r.whitened**2 for r in got) / 5 == pytest.approx(1)
    assert W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lengths_apart(spark):
    short = [(1000 + i, [float(i), float(i * i)]) for i in range(7)]
    rows, df = many(spark)
    both = df.unionByName(spark.createDataFrame([(i, v, 1, "", "", "") for i, v in short], SCHEMA))
    got = W.whiten(both).collect()
    held(rows, [r for r in got if r.vec_id < 1000])
    held(short, [r for r in got if r.vec_id >= 1000])


def test_deviation_beyond_a_long_is_null():
    far = W.Centre(1 << 40, [0, 1 << 60])
    x = np.array([[1 << 30, 1], [1, 1 << 20]], np.int64)
    exact = [sum(((1 << 40) * int(a) - s) ** 2 for a, s in zip(r, far.sums, strict=True)) for r in x]
    assert far.deviations(x) == [v if v < 1 << 63 else None for v in exact] and None in far.deviations(x)


def test_column_types(spark, sf_dir):
    kinds = {f.name: f.dataType for f in QUERIES["op12_embedding_whitening"](spark, sf_dir).schema}
    assert kinds["deviation"] == kinds["n"] == T.LongType() and kinds["component"] == T.IntegerType()
    assert kinds["whitened"] == kinds["explained"] == kinds["identity_error"] == T.DoubleType()
