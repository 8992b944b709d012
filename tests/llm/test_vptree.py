import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmine.llm import vptree as V


def brute(ids, vecs, queries, k):
    out = {}
    for i in np.flatnonzero(queries):
        s = V.cosines(np.repeat(vecs[i : i + 1], len(vecs), 0), vecs)
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(ids[j], s[j]) for j in order]
    return out


@pytest.mark.parametrize("n,dim", [(1, 3), (4, 2), (900, 6)])
def test_factor_one_is_exact(n, dim):
    rng = np.random.default_rng(n)
    vecs = rng.normal(size=(n, dim))
    vecs[n // 3 : n // 2] = vecs[0]  # many copies
    ids = rng.permutation(n)
    tree = V.Tree(ids, vecs, 6, leaf=8)
    found, score = tree.search(vecs, 6, 1.0)
    want = brute(ids, vecs, np.ones(n, bool), 5)
    for i, f in zip(ids, found, strict=True):
        assert [x for x in f if x not in (i, -1)][:5] == [x for x, _ in want[i]]


def test_recall_of_the_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, vecs = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
    want = brute(ids, vecs, ids % 50 == 0, 5)
    got = V.op4_vantage_point_ann(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect()
    assert len(got) == sum(map(len, want.values()))
    hits = [r.vec_id in [x for x, _ in want[r.query_id]] for r in got]
    assert np.mean(hits) >= 0.95
    at = {i: k for k, i in enumerate(ids)}
    assert all(r.score == V.cosines(vecs[[at[r.query_id]]], vecs[[at[r.vec_id]]])[0] for r in got)


def test_unsound_vectors_ties_and_shards(spark):
    one = [1.0, 0.0]
    rows = [(i, one) for i in range(0, 120)] + [(200, None), (250, [0.0, 0.0]), (300, [1.0, None]), (350, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (450, [1.0]), (None, one), (0, one), (500, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(7)).withColumn("id", F.lit(9))
    for size in (20, 1000):
        got = V.nearest(df, F.col("id") % 50 == 0, factor=1.0, shard_rows=size).orderBy("query_id", "rank").collect()
        assert [(r.query_id, r.vec_id) for r in got] == [(0, x) for x in (1, 2, 3, 4, 5)] + [(q, x) for q in (50, 100, 500) for x in range(5)]
        assert all(r.score == 1.0 for r in got)
    assert V.nearest(df.limit(0), F.lit(True)).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (50, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert V.nearest(two, F.lit(True)).count() == 2


@pytest.mark.parametrize("size", [40, 300])
def test_regions_restore_exact_search_and_leave_most_shards_out(spark, size):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    vecs = centres[rng.integers(0, 12, 1500)] + rng.normal(0, 0.05, (1500, 8))
    vecs[100:160] = vecs[0]
    ids = np.arange(1500)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vecs, strict=True)], "vec_id long, embedding array<double>")
    want = brute(ids, vecs, ids % 50 == 0, 5)
    got = {}
    for r in V.nearest(df, F.col("id") % 50 == 0, factor=1.0, shard_rows=size).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {int(q): [int(x) for x, _ in found] for q, found in want.items()}
    top = V.Regions(V._unit(vecs), 4)
    home, far = top.of(V._unit(vecs))
    for r in range(16):
        if (home == r).any():
            top.rows[r], top.low[r], top.high[r] = (home == r).sum(), far[home == r].min(0), far[home == r].max(0)
    reach = np.array([np.sqrt(max(0.0, 2 - 2 * want[q][-1][1])) for q in ids[ids % 50 == 0]])
    fit = top.admitted(V._unit(vecs[ids % 50 == 0]), reach)
    for row, q in zip(fit, ids[ids % 50 == 0], strict=True):
        assert row[home[q]] and all(row[home[x]] for x, _ in want[q])
    assert fit.mean() < 0.6


def test_vectors_whose_squares_overflow_take_no_part(spark):
    rows = [(0, [1e200, 1.0]), (50, [1.0, 2.0]), (51, [1e-200, 0.0]), (52, [2.0, 1.0])]
    got = V.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(50, 52)]
