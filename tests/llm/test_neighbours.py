import numpy as np
import pytest

from joinscope.llm import block_ann

SCHEMA = "vec_id long, embedding array<double>"


def brute(candidates, queries, k):
    """{(query id, vector): [(id, cosine), ...]} with exact scaling of each vector by a power of two."""
    unit = lambda v: (w := np.ldexp(np.array(v, float), -np.frexp(np.abs(v).max())[1])) / np.sqrt((w * w).sum())
    out = {}
    for i, q in queries:
        scored = [(-float(unit(v) @ unit(q)), j) for j, v in candidates if j != i]
        out[i, tuple(q)] = [j for _, j in sorted((round(s, 12), j) for s, j in scored)[:k]]
    return out


def rows_of(result):
    return [(r.query_id, r["rank"], r.vec_id) for r in result.orderBy("query_id", "rank").collect()]


def table(n=120, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dim).tolist()) for i in range(n)]


def test_repeated_query_rows_are_one_query(spark):
    rows = table()
    df = spark.createDataFrame(rows + [rows[50], rows[50], rows[7]], SCHEMA)
    got = rows_of(block_ann.neighbours(df, df.where("vec_id % 50 = 0"), 5))
    candidates = rows + [rows[7]]
    want = brute(candidates, [r for r in rows if r[0] % 50 == 0], 5)
    for q in (0, 50, 100):
        mine = [(rank, v) for i, rank, v in got if i == q]
        assert [r for r, _ in mine] == [1, 2, 3, 4, 5]
        if q != 50:  # the repeated row 50 is three candidates
            continue
        assert [v for _, v in mine] == want[50, tuple(rows[50][1])]


def test_one_id_with_two_vectors_is_two_queries(spark):
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA)
    queries = spark.createDataFrame([(50, rows[3][1]), (50, rows[4][1])], SCHEMA)
    got = rows_of(block_ann.neighbours(df, queries, 2))
    assert [r for _, r, _ in got] == [1, 1, 2, 2]
    assert {v for _, r, v in got if r == 1} == {3, 4}


@pytest.mark.parametrize("size", [1e200, 1e-200, 1e-310])
def test_components_of_any_size(spark, size):
    rows = [(i, [c * size for c in v]) for i, v in table()]
    df = spark.createDataFrame(rows, SCHEMA)
    result = block_ann.neighbours(df, df.where("vec_id % 50 = 0"), 5)
    assert result.where("score is null or isnan(score) or abs(score) > 1.0000001").count() == 0
    if size > 1e-300:  # below, components lose digits
        want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
        assert [v for _, _, v in rows_of(result)] == [v for q in sorted(want) for v in want[q]]


def test_grid_follows_the_pairs():
    for candidates, queries, partitions in ((0, 0, 8), (10, 1, 8), (51_282, 1_026, 200), (10**9, 2 * 10**7, 10_000), (10**6, 1, 200)):
        across, down = block_ann.grid(candidates, queries, partitions)
        assert across >= 1 and down >= 1
        assert candidates * queries / (across * down) <= block_ann.CELL_MOST
    assert block_ann.grid(51_282, 1_026, 200)[0] > 1


def test_small_cells_change_nothing(spark, monkeypatch):
    rows = table(300)
    df = spark.createDataFrame(rows, SCHEMA)
    want = rows_of(block_ann.neighbours(df, df.where("vec_id % 10 = 0"), 5))
    monkeypatch.setattr(block_ann, "CELL_MOST", 500)
    monkeypatch.setattr(block_ann, "CANDIDATES", 16)
    monkeypatch.setattr(block_ann, "QUERIES", 8)
    assert rows_of(block_ann.neighbours(df, df.where("vec_id % 10 = 0"), 5)) == want


def test_a_block_is_sent_once_a_cell(spark):
    """Tiles as joined rows held a block of either side each, which filled the heap of the JVM."""
    df = spark.createDataFrame(table(), SCHEMA)
    plan = block_ann.neighbours(df, df.where("vec_id % 10 = 0"), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" in plan and "Join" not in plan


@pytest.mark.parametrize("candidates", [615_384, 15_000_000])
def test_copies_on_the_grid_are_few(candidates):
    queries = candidates // 50
    across, down = block_ann.grid(candidates, queries, candidates // 25_000)
    assert across * queries + down * candidates <= 6 * candidates
    assert candidates * queries / (across * down) <= block_ann.CELL_MOST


def test_vectors_are_sent_as_short_as_they_are_exact(spark):
    rows = [(i, [1.0, 0.5 * i, -0.25]) for i in range(1, 21)]
    short = spark.createDataFrame(rows, "id long, vector array<double>").coalesce(1)
    long = spark.createDataFrame([(i, [*v[:2], 0.1]) for i, v in rows], short.schema).coalesce(1)
    sizes = [{len(r.exact) // len(r.ids) for r in block_ann.blocks(df, 8).collect()} for df in (short, long)]
    assert sizes == [{4 * 3 // 8}, {8 * 3 // 8}]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_and_exact_copies_over_many_tiles(spark, monkeypatch, kind):
    monkeypatch.setattr(block_ann, "CANDIDATES", 16)
    monkeypatch.setattr(block_ann, "QUERIES", 4)
    monkeypatch.setattr(block_ann, "CELL_MOST", 2_000)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))
    vectors = [(centres[i % 6] + (i % 4 > 0) * 1e-3 * rng.normal(size=8)).astype(np.float32).astype(float).tolist() for i in range(240)]
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    got = rows_of(block_ann.neighbours(df, df.where("vec_id % 7 = 0"), 9))
    want = brute(rows, [r for r in rows if r[0] % 7 == 0], 9)
    assert got == [(q, rank, v) for q, _ in sorted(want) for rank, v in enumerate(want[q, tuple(vectors[q])], 1)]
