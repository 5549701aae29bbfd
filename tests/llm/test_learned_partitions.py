"""Search over learned partitions against all pairs."""

import math

import numpy as np
import pytest
from conftest import rows_of

from chatledger.llm import learned_partitions as L
from chatledger.llm import queries


def brute(rows, asked, k):
    """Exact: the products of such short numbers are, and their sum is rounded once."""

    def score(a, b):
        return math.fsum(x * y for x, y in zip(a, b))

    out = {}
    for q, v in asked:
        found = sorted((-score(v, w), i) for i, w in rows if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for r in sorted(rows_of(df), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def clustered(n, dims=16, centres=24, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dims)) * 2
    return (middle[rng.integers(0, centres, n)] + rng.standard_normal((n, dims)) * 0.4).astype(np.float32)


def test_parts_are_balanced_and_follow_the_graph():
    x = clustered(1500).astype(float)
    near = L.nearest(x, x, 10, np.arange(len(x)))
    part = L.balanced_parts(near, 8, np.random.default_rng(1))
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() <= math.ceil(1500 / 8 * 1.05) and sizes.min() > 100
    assert (part[near] == part[:, None]).mean() > 0.8  # an eighth by chance


def test_router_learns():
    x = clustered(4000).astype(float)
    router, probes = L.fit(x[:3000], parts=8)
    assert probes <= 4
    placed = router.probabilities(x).argmax(axis=1)
    assert np.bincount(placed, minlength=8).max() < 1200
    asked = np.arange(3000, 4000)
    routes = L._route(router, x[asked], probes, np.bincount(placed, minlength=8), 21)
    true = L.nearest(x[asked], x, 20, asked)
    assert np.mean([np.isin(placed[t], r).mean() for t, r in zip(true, routes)]) > 0.9
    assert all(len(r) == 8 for r in L._route(router, x[:5], 1, np.zeros(8, int), 21))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_recall_and_exact_scores(spark, kind):
    x = clustered(2600)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(5)
    got = found(L.search(df, df.where("vec_id % 20 = 0"), parts=8, rows=300, block=40))
    true = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert got.keys() == true.keys()
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= 0.9
    exact = {q: dict(brute(rows, [rows[q]], len(rows))[q]) for q in list(true)[:10]}
    for q, scores in exact.items():
        assert all(scores[i] == s for i, s in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0])) and len(got[q]) == 20


def test_small_tables_are_searched_whole(spark, sf_dir):
    """Odd rows, equal vectors by the hundred, other lengths, repeated ids, clashing columns."""
    nan, inf = float("nan"), float("inf")
    data = [(i, [float(i % 7), 1.0, -float(i % 3)]) for i in range(90)]
    data += [(100 + i, [1.0, 2.0, 3.0]) for i in range(60)] + [(i, [2.0, float(i)]) for i in range(200, 230)]
    odd = [(300, None), (320, []), (340, [0.0, 0.0, 0.0]), (360, [1.0, None, 2.0]), (380, [nan, 1.0, 1.0]), (400, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    twice = [(20, [9.0, 9.0, 9.0]), (101, [1.0, 2.0, 3.0]), (440, [5.0])]
    df = spark.createDataFrame(data + odd + twice, "vec_id bigint, embedding array<double>")
    df = df.selectExpr("*", "1 AS id", "'x' AS part", "2 AS row", "3 AS vector", "4 AS score").repartition(4)
    rows = data + twice
    asked = {}
    for i, v in sorted((r for r in rows if r[0] % 20 == 0), reverse=True):
        asked[i] = v  # of a repeated id the smallest vector
    want = {q: near for q, near in brute(rows, asked.items(), 20).items() if near}
    assert found(L.search(df, df.where("vec_id % 20 = 0"), rows=16, block=3)) == want
    assert rows_of(L.search(df.where("false"), df.where("false"))) == []
    assert rows_of(L.search(df.where("vec_id >= 300"), df.where("vec_id >= 300"))) == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = found(queries.op13_ann(spark, sf_dir))
    x = np.array([v for _, v in rows], float)
    ids = np.array([i for i, _ in rows])
    asked = np.flatnonzero(ids % 20 == 0)
    true = ids[L.nearest(x[asked], x, 20, asked)]
    assert sorted(got) == sorted(ids[asked].tolist()) and all(len(near) == 20 for near in got.values())
    assert np.mean([len({i for i, _ in got[q]} & set(t)) / 20 for q, t in zip(ids[asked].tolist(), true.tolist())]) >= 0.9
