"""Approximate nearest neighbours by inner product over learned partitions.

On a bounded sample of vectors a graph of nearest neighbours is cut into balanced parts: by
recursive bisection at the median of the graph's second eigenvector, then by moving vertices to
the part of most of their neighbours where that part has room. A small classifier (one hidden layer) learns,
for each sampled vector, how its neighbours are spread over the parts, from the vector alone.
It places every row in its most probable part and sends every query to its several most probable
parts, as many as needed for ``COVER`` of the neighbours of sampled vectors that the fit did not
see. All rows of these parts are compared exactly.

Only the fit is on a sample, at most ``SAMPLE`` vectors taken by the hash of their ids; all
rows are indexed and searched. Rows and queries of a part are dealt into cells of at most about
``ROWS`` rows by ``QUERIES`` queries, so that a part of any size, also one that copies of a
vector fill, is spread over tasks and no task holds more than a cell. Every cell gives its 20
best of each query, which one ranking merges.

Scores are inner products in double precision; products of two single-precision components are
exact there, and their sum is taken in extended precision, so equal vectors have equal
scores. Vectors that are null, zero, or hold a null or non-finite component take no part.
Vectors of another length than the sample's commonest have parts of their own, one a length,
and are compared with all of it. A row with the query's id is its own and never its candidate;
repeated query ids ask once, with their smallest vector. Empty tables give empty results; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import stored

K, PARTS, SAMPLE, NEIGHBOURS, COVER = 20, 32, 8192, 20, 0.95
ROWS, QUERIES, SEED = 32_768, 4096, 7
LEAST = 256  # sampled vectors a part; smaller tables are one part, searched whole
_HIDDEN, _EPOCHS, _BATCH, _RATE = 256, 60, 256, 2e-3


# the fit, on the sample


def nearest(asked: np.ndarray, vectors: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Places of the k rows of largest inner product for each row asked, by blocks; ``own`` is
    the place that a row may not have."""
    out = np.empty((len(asked), k), np.int64)
    for at in range(0, len(asked), 1024):
        score = asked[at : at + 1024] @ vectors.T
        if own is not None:
            score[np.arange(len(score)), own[at : at + 1024]] = -np.inf
        out[at : at + 1024] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def _halves(links: np.ndarray, members: np.ndarray, share: float, rng: np.random.Generator) -> np.ndarray:
    """Which members are in the first half: the share lowest in the second eigenvector of the
    graph of the links (a, b) among them."""
    place = np.full(links.max(initial=0) + 1, -1)
    place[members] = np.arange(len(members))
    a, b = place[links[0]], place[links[1]]
    a, b = a[(a >= 0) & (b >= 0)], b[(a >= 0) & (b >= 0)]
    degree = np.bincount(a, minlength=len(members)) + np.bincount(b, minlength=len(members)) + 1e-9
    root, x = np.sqrt(degree), rng.standard_normal(len(members))
    for _ in range(60):
        y = x / root
        y = (np.bincount(a, y[b], len(members)) + np.bincount(b, y[a], len(members))) / root
        x = x + y  # the spectrum of the normalised graph begins at -1
        x -= root * (x @ root) / (root @ root)
        x /= np.linalg.norm(x) + 1e-300
    order = np.argsort(x / root, kind="stable")
    first = np.zeros(len(members), bool)
    first[order[: round(share * len(members))]] = True
    return first


def balanced_parts(near: np.ndarray, parts: int, rng: np.random.Generator, slack: float = 0.05, rounds: int = 10) -> np.ndarray:
    """The part of each vertex; ``near`` holds the neighbours of each. No part exceeds its
    equal share by more than ``slack``."""
    n = len(near)
    links = np.stack([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        members, first, count = todo.pop()
        if count > 1:
            left = _halves(links, members, (count // 2) / count, rng)
            part[members[~left]] = first + count // 2
            todo += [(members[left], first, count // 2), (members[~left], first + count // 2, count - count // 2)]
    room = int(np.ceil(n / parts * (1 + slack)))
    sizes = np.bincount(part, minlength=parts)
    back = [[] for _ in range(n)]
    for a, b in links.T.tolist():
        back[b].append(a)
    around = [np.r_[near[v], np.array(back[v], np.int64)] for v in range(n)]
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(n):
            votes = np.bincount(part[around[v]], minlength=parts)
            votes[(sizes >= room) & (np.arange(parts) != part[v])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[v]]:
                sizes[part[v]] -= 1
                sizes[best] += 1
                part[v] = best
                moved += 1
        if moved < n // 1000:
            break
    return part


class Router:
    """A small classifier: one hidden layer, softmax over the parts."""

    def __init__(self, dims: int, parts: int, rng: np.random.Generator, hidden: int = _HIDDEN):
        self.weights = [
            rng.standard_normal((dims, hidden)) * np.sqrt(2 / dims), np.zeros(hidden),
            rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden), np.zeros(parts),
        ]

    @staticmethod
    def scaled(vectors: np.ndarray) -> np.ndarray:
        """To length sqrt(dims): the nearest by inner product do not depend on the query's length."""
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        return vectors / np.where(norms > 0, norms, 1) * np.sqrt(vectors.shape[1])

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(x @ self.weights[0] + self.weights[1], 0)
        z = hidden @ self.weights[2] + self.weights[3]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return hidden, z / z.sum(axis=1, keepdims=True)

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        return self._forward(self.scaled(vectors))[1]

    def fit(self, vectors: np.ndarray, target: np.ndarray, rng: np.random.Generator, epochs: int = _EPOCHS) -> None:
        """Adam on the cross entropy against the spread ``target`` of each vector."""
        x, mean, square, step = self.scaled(vectors), [0.0] * 4, [0.0] * 4, 0
        for epoch in range(epochs):
            order = rng.permutation(len(x))
            rate = _RATE * (1 - epoch / epochs)
            for at in range(0, len(x), _BATCH):
                rows = order[at : at + _BATCH]
                hidden, p = self._forward(x[rows])
                d = (p - target[rows]) / len(rows)
                back = (d @ self.weights[2].T) * (hidden > 0)
                step += 1
                for i, g in enumerate((x[rows].T @ back, back.sum(axis=0), hidden.T @ d, d.sum(axis=0))):
                    g = g + 1e-5 * self.weights[i]
                    mean[i] = 0.9 * mean[i] + 0.1 * g
                    square[i] = 0.999 * square[i] + 0.001 * g * g
                    self.weights[i] -= rate * (mean[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)


def fit(vectors: np.ndarray, parts: int = PARTS, cover: float = COVER, neighbours: int = NEIGHBOURS) -> tuple[Router, int]:
    """The classifier, and to how many parts a query goes. A tenth of the sample stays out of
    the fit to set that number."""
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(vectors))
    kept, held = order[len(order) // 10 :], order[: len(order) // 10]
    known = vectors[kept]
    parts = max(1, min(parts, len(known) // LEAST))
    router = Router(vectors.shape[1], parts, rng)
    if parts == 1:
        return router, 1
    near = nearest(known, known, min(neighbours, len(known) - 1), np.arange(len(known)))
    part = balanced_parts(near, parts, rng)
    target = np.zeros((len(known), parts))
    np.add.at(target, (np.repeat(np.arange(len(known)), near.shape[1]), part[near].ravel()), 1)
    target[np.arange(len(known)), part] += near.shape[1] / 2
    router.fit(known, target / target.sum(axis=1, keepdims=True), rng)
    placed = router.probabilities(vectors).argmax(axis=1)
    asked = np.argsort(-router.probabilities(vectors[held]), axis=1)
    true = nearest(vectors[held], vectors, min(neighbours, len(vectors) - 1), held)
    rank = np.argsort(asked, axis=1)[np.arange(len(held))[:, None], placed[true]]
    covered = np.cumsum(np.bincount(rank.ravel(), minlength=parts)) / rank.size
    return router, int(np.searchsorted(covered, cover) + 1)


# index and search


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    fine = "size(vector) > 0 AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf')) AND exists(vector, x -> x <> 0)"
    return rows.where(F.col("id").isNotNull() & F.coalesce(F.expr(fine), F.lit(False)))


def _matrices(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors) for each length."""
    sizes = np.asarray(vectors.value_lengths())
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        values = vectors.take(pa.array(places)).flatten().cast(pa.float64())
        yield places, values.to_numpy(zero_copy_only=False).reshape(len(places), size)


def _placer(sent, dims: int):
    """Adds the most probable part; other lengths have parts of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router: Router = sent.value
        for batch in batches:
            part = np.zeros(batch.num_rows, np.int64)
            for places, matrix in _matrices(batch.column("vector")) if batch.num_rows else ():
                own = len(router.weights[3]) + matrix.shape[1]
                part[places] = router.probabilities(matrix).argmax(axis=1) if matrix.shape[1] == dims else own
            yield batch.append_column("part", pa.array(part))

    return run


def _route(router: Router, matrix: np.ndarray, probes: int, sizes: np.ndarray, least: int) -> list[list[int]]:
    """For each vector the most probable parts: ``probes`` of them, and more while these hold
    fewer than ``least`` rows."""
    order = np.argsort(-router.probabilities(matrix), axis=1, kind="stable")
    enough = (np.cumsum(sizes[order], axis=1) < least).sum(axis=1) + 1
    return [o[: max(probes, n)].tolist() for o, n in zip(order, enough)]


def _router(sent, dims: int, probes: int, sizes: np.ndarray, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router: Router = sent.value
        for batch in batches:
            parts: list = [None] * batch.num_rows
            for places, matrix in _matrices(batch.column("vector")) if batch.num_rows else ():
                own = [len(router.weights[3]) + matrix.shape[1]]
                routes = _route(router, matrix, probes, sizes, least) if matrix.shape[1] == dims else [own] * len(places)
                for place, route in zip(places.tolist(), routes):
                    parts[place] = route
            yield batch.append_column("parts", pa.array(parts, pa.list_(pa.int64())))

    return run


def best_in_cell(ids: np.ndarray, rows: np.ndarray, own: np.ndarray, asked: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query ids, row ids, scores): for each vector asked the k rows of highest score, ties to
    the smaller id, without rows of its own id. Equal vectors are compared once."""
    by_id = np.argsort(ids, kind="stable")
    ids, rows = ids[by_id], np.ascontiguousarray(rows[by_id])
    _, first, group = np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
    vectors = rows[first]
    order = np.argsort(group, kind="stable")  # within a group by id
    starts = np.append(np.searchsorted(group[order], np.arange(len(first))), len(ids))
    out: tuple[list, ...] = ([], [], [])
    margin = 1e-12 * np.abs(vectors).max() * np.abs(asked).max() * rows.shape[1]
    for at in range(0, len(asked), 128):
        block = asked[at : at + 128] @ vectors.T
        for query, vector, score in zip(own[at : at + 128], asked[at : at + 128], block):
            mine = np.unique(group[np.searchsorted(ids, query) : np.searchsorted(ids, query, "right")])
            for g in mine.tolist():
                if (ids[order[starts[g] : starts[g + 1]]] == query).all():
                    score[g] = -np.inf
            cut = np.partition(score, len(score) - k)[len(score) - k] - margin if len(score) > k else -np.inf
            found = np.flatnonzero((score >= cut) & (score > -np.inf))
            exact = (vectors[found].astype(np.longdouble) * vector).sum(axis=1).astype(np.float64)
            members = [ids[order[starts[g] : starts[g + 1]]] for g in found.tolist()]
            members = [m[m != query][:k] if g in mine else m[:k] for g, m in zip(found.tolist(), members)]
            counts = [len(m) for m in members]
            near, value = np.concatenate([np.zeros(0, np.int64), *members]), np.repeat(exact, counts)
            top = np.lexsort((near, -value))[:k]
            for column, part in zip(out, (np.full(len(top), query), near[top], value[top])):
                column.append(part)
    return tuple(np.concatenate([np.zeros(0, kind), *c]) for kind, c in zip((np.int64, np.int64, np.float64), out))


def _cell(k: int):
    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        vectors = table.column("vector").combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        return np.asarray(table.column("id")).astype(np.int64), next(_matrices(vectors))[1]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        columns = best_in_cell(*matrix(rows), *matrix(queries), k) if rows.num_rows and queries.num_rows else ([], [], [])
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

    return run


def _cells(df: DataFrame, most: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Each row (id, part) with its place among the part's equal shares of about ``most`` rows, and
    the number of shares of each part."""
    counts = df.groupBy("part").agg(F.ceil(F.count("*") / most).cast("int").alias(f"{name}s"))
    share = F.pmod(F.xxhash64("id", "row"), F.col(f"{name}s")).cast("int")
    return df.join(counts, "part").withColumn(name, share).drop(f"{name}s", "row"), counts


def search(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K,
    parts: int = PARTS, sample: int = SAMPLE, cover: float = COVER, rows: int = ROWS, block: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` nearest among the
    rows of ``df`` with another id that are in the parts it is sent to."""
    spark = df.sparkSession
    usable = _usable(df, key, vector)
    lengths = usable.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    dims = lengths["size"] if lengths else 0
    drawn = usable.where(F.size("vector") == dims).orderBy(F.xxhash64("id"), "vector").limit(sample).select("vector").toArrow()
    known = [m for chunk in drawn.column(0).chunks if len(chunk) for _, m in _matrices(chunk)]
    router, probes = fit(np.concatenate(known), parts, cover) if known else (Router(1, 1, np.random.default_rng(SEED)), 1)
    sent = spark.sparkContext.broadcast(router)
    kind = usable.schema["vector"].dataType.simpleString()
    placed = usable.mapInArrow(_placer(sent, dims), f"id bigint, vector {kind}, part bigint")
    index = stored(placed.withColumn("row", F.monotonically_increasing_id()), "parts")

    count = len(router.weights[3])
    sizes = np.zeros(count, np.int64)
    for part, n in index.where(F.col("part") < count).groupBy("part").count().collect():  # at most the parts
        sizes[part] = n
    asked = _usable(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    routed = asked.mapInArrow(_router(sent, dims, probes, sizes, k + 1), f"id bigint, vector {kind}, parts array<bigint>")
    routed = stored(routed.select("id", "vector", F.explode("parts").alias("part"), F.lit(0).alias("row")), "routes")

    (left, shares), (right, blocks) = _cells(index, rows, "share"), _cells(routed, block, "block")
    left = left.join(blocks, "part").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks")
    right = right.join(shares, "part").withColumn("share", F.explode(F.expr("sequence(0, shares - 1)"))).drop("shares")
    cell = ["part", "share", "block"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_cell(k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
