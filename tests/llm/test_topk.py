import math

import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import topk

FOLDER = "/root/testdata/sf0.01"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(vectors, queries, k=5):
    out = set()
    for q in queries:
        scored = sorted((-int(sum(a * b for a, b in zip(vectors[q], v, strict=False))), i) for i, v in vectors.items() if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def results(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


def test_equals_brute_force_in_small_blocks(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    vectors = {r.vec_id: [math.floor(256 * x) for x in r.embedding] for r in table.collect()}
    config = topk.TopKConfig(block_rows=64, query_rows=4)
    got = results(topk.top_k(topk.quantised(table), F.col("vec_id") % 50 == 0, config))
    assert got == brute(vectors, [i for i in vectors if i % 50 == 0])


def test_ties_copies_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(60)] + [
        (100, [nan, 1.0, 1.0], 0), (101, [inf, 1.0, 1.0], 0), (102, None, 0), (103, [None, 1.0, 1.0], 0),
        (None, [1.0, 1.0, 1.0], 0), (104, [], None), (105, [9.0], 0), (106, [-1.0, -2.0, -3.0], 0), (150, [0.0, 0.0, 0.5], 0),
    ]
    table = spark.createDataFrame(rows, VECTORS).withColumns({"v": F.lit("clash"), "query": F.lit(1)})
    usable = topk.quantised(table)
    assert {r.vec_id for r in usable.collect()} == {*range(60), 104, 105, 106, 150}
    config = topk.TopKConfig(block_rows=16)
    got = results(topk.top_k(usable, F.col("vec_id") % 50 == 0, config))
    vectors = {r.vec_id: r.v + [0] * (3 - len(r.v)) for r in usable.collect()}
    assert got == brute(vectors, [0, 50, 150])
    few = usable.where("vec_id IN (0, 106)")
    assert results(topk.top_k(few, F.lit(True))) == brute({k: vectors[k] for k in (0, 106)}, [0, 106])
    assert results(topk.top_k(usable.where("false"), F.lit(True))) == set()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 37)) * 100, rng.normal(size=(50, 37)) * 100 + 20
    exact = x @ y.T
    for n in (1, 2, 8, 32, 64):
        bound = topk.statistics(x, n) @ topk.statistics(y, n).T
        assert (bound >= exact - 1e-6).all()
    assert np.allclose(topk.statistics(x, 37) @ topk.statistics(y, 37).T, exact)
