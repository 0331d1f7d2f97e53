import numpy as np
from pyspark.sql import functions as F

from cardloom.llm.nearest import Codes, nearest, rotation


def test_estimates_stay_within_their_bounds():
    rnd = np.random.default_rng(0)
    x, q = rnd.standard_normal((500, 40)), rnd.standard_normal((20, 40))
    center, turn = x.mean(axis=0), rotation(40)
    assert np.allclose(turn @ turn.T, np.eye(40))
    guess, error = Codes(x, center, turn).estimate(q, center, turn)
    assert (np.abs(guess - q @ x.T) <= error).mean() > 0.99


def test_recall_and_blocks(spark):
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((400, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), i) for i, v in enumerate(x)], "vec_id long, embedding array<float>, score int")
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, k=5, vector_block=90, query_block=7).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    exact = x.astype(np.float64) @ x.T.astype(np.float64)
    np.fill_diagonal(exact, -np.inf)
    hits = sum(len(set(got[q].values()) & set(np.argsort(-exact[q])[:5].tolist())) for q in range(0, 400, 20))
    assert hits / 100 >= 0.98 and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (2, [1.0, 0.0]), (None, [9.0, 9.0]), (10, [-1.0, 0.5]), (20, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 3.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 10, -1.0), (20, 1, 0, 3.0), (20, 2, 1, 3.0), (20, 3, 2, 3.0), (20, 4, 10, -2.5)]
    assert nearest(df.where("vec_id > 99"), F.col("vec_id") % 20 == 0).collect() == []
