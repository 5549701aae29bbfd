"""Exact top-k inner products by MaxScore.

A vector is a document whose terms are its components, as integers floor(scale * x); a
query's term j contributes q_j * x_j. Within a shard (one Arrow batch) each term has a
posting row of values and its least and greatest value, hence bounds of its contribution.
With the k-th best score so far as threshold, the terms of a query are split by bound:
the non-essential ones together cannot lift a document from its least possible score over
the threshold. Essential postings are traversed, and the others are probed from the
largest bound on, only for documents that are still competitive. The threshold carries over
from batch to batch, and the shards' lists are merged by rank.

Queries are broadcast in blocks of about ``BLOCK`` vectors, each block one pass over all
vectors, so memory does not grow with the query set. Arithmetic is exact: doubles while
all sums stay below 2^53, else 64-bit integers.

Vectors that are null, or hold a null or non-finite component, take no part, nor does a
candidate of another length than the query's. A row with the query's id is its own, and
never its candidate; repeated ids ask once (by their smallest vector) but each of their
rows is a candidate of others. Empty tables give empty results; only the two columns are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, SCALE, BLOCK = 5, 256, 4096
_LOWEST = np.iinfo(np.int64).min
_PROBES = 8


def _matrices(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer vectors) of the usable rows, one pair for each length."""
    sizes = np.asarray(vectors.value_lengths().fill_null(-1))
    usable = (sizes > 0) & ~np.asarray(ids.is_null())
    for size in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == size))
        values = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
        matrix = values.to_numpy(zero_copy_only=False).reshape(len(rows), size)  # null: nan
        fine = np.isfinite(matrix).all(axis=1)
        yield np.asarray(ids.take(pa.array(rows[fine]))).astype(np.int64), np.floor(SCALE * matrix[fine])


class _Shard:
    def __init__(self, ids: np.ndarray, matrix: np.ndarray, largest: float):
        most = np.abs(matrix).max(initial=0.0)
        self.kind = np.float64 if most * largest * matrix.shape[1] < 2**53 else np.int64
        self.ids = ids
        self.postings = np.ascontiguousarray(matrix.T.astype(self.kind))
        self.least, self.most = self.postings.min(axis=1), self.postings.max(axis=1)

    def search(self, own: int, query: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of all rows that may have a score of at least the threshold."""
        query = query.astype(self.kind)
        ends = query * self.least, query * self.most
        low, high = np.minimum(*ends), np.maximum(*ends)
        gain = high - low
        order = np.argsort(-gain, kind="stable")  # the largest bounds are essential
        rest = np.append(np.cumsum(gain[order][::-1])[::-1], 0)  # gain of the terms from here on
        essential = len(order)
        if threshold > _LOWEST:
            essential = int(np.argmax(low.sum() + rest < threshold)) if low.sum() + rest[-1] < threshold else len(order)
        terms = order[:essential]
        score = query[terms] @ self.postings[terms]
        highest = np.append(np.cumsum(high[order][::-1])[::-1], 0)
        rows = np.flatnonzero((score + highest[essential] >= threshold) & (self.ids != own))
        score = score[rows]
        for at in range(essential, len(order), _PROBES):
            if not len(rows):
                break
            terms = order[at : at + _PROBES]
            score = score + query[terms] @ self.postings[np.ix_(terms, rows)]
            fine = score + highest[min(at + _PROBES, len(order))] >= threshold
            rows, score = rows[fine], score[fine]
        return score.astype(np.int64), self.ids[rows]


class _Best:
    """The k best of one query: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def threshold(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else _LOWEST

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score) > 4 * self.k:  # ties with the k-th best stay
            cut = np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[score >= cut], ids[score >= cut]
        score, ids = np.r_[self.score, score], np.r_[self.ids, ids]
        order = np.lexsort((ids, -score))[: self.k]
        self.score, self.ids = score[order], ids[order]


def top_k(
    df: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` highest
    scores among the rows of ``df`` with another id; fewer if there are fewer."""
    spark = df.sparkSession
    asked = queries.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    fine = F.expr("size(vector) > 0 AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))")
    asked = asked.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    asked = asked.groupBy("id").agg(F.min("vector").alias("vector"))
    blocks = max(1, math.ceil(asked.count() / block))
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    parts = []
    for number in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow().combine_chunks().sort_by("id")
        columns = [got[c].combine_chunks() if isinstance(got[c], pa.ChunkedArray) else got[c] for c in ("id", "vector")]
        sent = spark.sparkContext.broadcast(list(_matrices(*columns)))
        parts.append(rows.mapInArrow(_searcher(sent, k), "query_id bigint, vec_id bigint, score bigint"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searcher(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, _Best] = {}
        for batch in batches:
            shards = {m.shape[1]: (i, m) for i, m in _matrices(batch.column(0), batch.column(1))}
            for ids, asked in sent.value:
                if asked.shape[1] not in shards or not len(shards[asked.shape[1]][0]) or not len(ids):
                    continue
                shard = _Shard(*shards[asked.shape[1]], np.abs(asked).max(initial=0.0))
                for own, query in zip(ids.tolist(), asked):
                    top = best.setdefault(own, _Best(k))
                    top.add(*shard.search(own, query, top.threshold()))
        for own, top in best.items():
            if len(top.ids):
                yield pa.record_batch(
                    {"query_id": pa.array(np.full(len(top.ids), own)), "vec_id": pa.array(top.ids), "score": pa.array(top.score)}
                )

    return run
