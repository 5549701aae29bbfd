import math

import numpy as np
from chatledger.llm import topk as T

TYPE = "vec_id bigint, embedding array<float>, score string, rank int"


def by_hand(rows, asked, k):
    ints = {}
    usable = []
    for key, v in rows:
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((key, [math.floor(256 * float(np.float32(x))) for x in v]))
    for key, v in rows:
        if key in asked and any(u[0] == key for u in usable):
            ints.setdefault(key, min(([float(np.float32(x)) for x in w] for y, w in rows if y == key and w and all(x is not None and math.isfinite(x) for x in w))))
    out = []
    for q, vector in ints.items():
        query = [math.floor(256 * x) for x in vector]
        scored = sorted((-sum(a * b for a, b in zip(query, v)), key) for key, v in usable if key != q and len(v) == len(query))
        out += [(q, n, key, -s) for n, (s, key) in enumerate(scored[:k], 1)]
    return sorted(out)


def held(spark, rows, asked, k=5, **options):
    df = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], TYPE).repartition(3)
    queries = df.where(df.vec_id.isin(list(asked)))
    got = sorted(tuple(r) for r in T.top_k(df, queries, k=k, **options).collect())
    assert got == by_hand(rows, asked, k)


def test_random_vectors(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 16))
    rows = [(i, (centers[i % 6] + 0.2 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(400)]
    held(spark, rows, set(range(0, 400, 20)))
    held(spark, rows, set(range(0, 400, 20)), block=3)


def test_ties_repeats_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, -0.25, 0.125]) for i in range(30)] + [(3, [0.5, -0.25, 0.125]), (3, [0.1, 0.2, 0.3])]
    rows += [(100, None), (101, []), (102, [nan, 0.0, 1.0]), (103, [inf, 0.0, 1.0]), (104, [None, 0.0, 1.0]), (None, [9.0, 9.0, 9.0])]
    rows += [(105, [1.0, 2.0]), (106, [-1.0, -2.0]), (107, [5000.0, 0.0, 1e12]), (108, [0.0, 0.0, 0.0])]
    held(spark, rows, {0, 3, 29, 100, 101, 102, 105, 107, 108})
    df = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert T.top_k(df, df).count() == 0
    assert T.top_k(df.limit(0), df).count() == 0
    assert T.top_k(df, df.limit(0)).count() == 0


def test_terms_are_left_out():
    """With a threshold, probes stop early, and the rows left are all that reach it."""
    rng = np.random.default_rng(5)
    matrix = np.floor(256 * rng.normal(size=(2000, 32)))
    shard = T._Shard(np.arange(2000), matrix, 2000)
    query = matrix[17]
    scores = matrix @ query
    threshold = int(np.sort(np.delete(scores, 17))[-5])
    score, ids = shard.search(17, query, threshold)
    assert set(ids) == {i for i in np.flatnonzero(scores >= threshold) if i != 17}
    assert all(scores[i] == s for i, s in zip(ids, score))
