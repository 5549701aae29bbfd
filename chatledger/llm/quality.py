"""Document quality by a factorisation machine.

A document is a sparse vector: hashed words, hashed structure statistics in bins, and
length metadata (labels, language, source and id are never inputs). The score is
    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)
through a logistic function: pairwise interactions of rank k in time linear in the
document's distinct words, by the sum-of-squares identity.

The model is fitted on at most ``sample`` labelled rows, chosen by a hash of their id, so
refits agree. Vectors are made on the executors; only these bounded vectors and the model
(a few hundred KB) pass the driver. Scoring is row-local.

Null texts score as empty ones, null labels teach nothing, several labels of one id count as
the largest, and without both label values every score is the smoothed share of ones.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import per_text

#: Buckets of hashed words, rank of the interactions, labelled rows to learn from, rounds.
BUCKETS, RANK, SAMPLE, ROUNDS = 1 << 14, 8, 3000, 80
THRESHOLD = 0.3
_BINS = 24
_STATISTICS = 12
_SIZE = BUCKETS + _BINS * _STATISTICS
_LINE = re.compile(rb"[^\n]+")
_BLOCK = 1 << 22


def _share(value: float) -> int:
    return min(_BINS - 1, int(value * _BINS))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the non-zero entries, values of each group with norm one."""
    data = (text or "").encode("utf-8", "replace")
    counts: Counter[bytes] = Counter()
    pairs_same, total, at, last = 0, 0, 0, None
    while at < len(data):  # blocks bound the list of words
        end = at + _BLOCK
        while end < len(data) and data[end] not in b"\x20\x09\x0a\x0b\x0c\x0d":
            end += 1
        words = data[at:end].lower().split()
        if words:
            pairs_same += sum(map(bytes.__eq__, words, words[1:])) + (words[0] == last)
            last = words[-1]
        counts.update(words)
        total += len(words)
        at = end
    entries: dict[int, float] = {}
    for word, n in counts.items():
        bucket = zlib.crc32(word) % BUCKETS
        entries[bucket] = entries.get(bucket, 0.0) + 1.0 + math.log(n)
    norm = math.sqrt(sum(v * v for v in entries.values())) or 1.0
    codes = np.frombuffer(data, dtype=np.uint8)
    size = max(1, len(data))
    kinds = np.bincount(codes, minlength=256)
    lines = Counter(m.group() for m in _LINE.finditer(data))
    n_lines = sum(lines.values())
    statistics = (
        min(_BINS - 1, int(2 * math.log2(total + 1))),
        min(_BINS - 1, int(math.log2(len(data) + 1))),
        _share(len(counts) / max(1, total)),
        _share(max(counts.values(), default=0) / max(1, total)),
        _share(pairs_same / max(1, total)),
        _share(3 * kinds[48:58].sum() / size),
        _share(3 * kinds[65:91].sum() / size),
        _share(4 * (kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum()) / size),
        _share(kinds[128:].sum() / size),
        min(_BINS - 1, int(2 * sum(map(len, counts)) / max(1, len(counts)))),
        _share(len(lines) / max(1, n_lines)),
        min(_BINS - 1, int(2 * math.log2(1 + total / max(1, n_lines)))),
    )
    index = np.fromiter(entries, dtype=np.int32, count=len(entries))
    value = np.fromiter(entries.values(), dtype=np.float64, count=len(entries)) / norm
    own = BUCKETS + _BINS * np.arange(_STATISTICS) + np.array(statistics)
    return np.r_[index, own].astype(np.int32), np.r_[value, np.full(_STATISTICS, _STATISTICS**-0.5)]


class Machine:
    """Bias, weights and factors; ``score`` is the logistic output."""

    def __init__(self, rank: int = RANK):
        self.bias = 0.0
        self.weights = np.zeros(_SIZE)
        self.factors = np.random.default_rng(7).normal(0, 0.01, (_SIZE, rank))

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        scaled = self.factors[index] * value[:, None]
        pairs = (scaled.sum(axis=0) ** 2).sum() - (scaled**2).sum()
        return self.bias + float(self.weights[index] @ value) + 0.5 * float(pairs)

    def score(self, text: str | None) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, self.margin(*features(text)))))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = ROUNDS) -> Machine:
        """Full-batch Adam on the logistic loss with L2."""
        ones = float(labels.sum())
        share = (ones + 0.5) / (len(labels) + 1)
        self.bias = math.log(share / (1 - share))
        if not 0 < ones < len(labels):
            self.factors[:] = 0.0
            return self
        row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
        index = np.concatenate([i for i, _ in rows]).astype(np.int64)
        value = np.concatenate([v for _, v in rows])
        starts = np.r_[0, np.cumsum([len(i) for i, _ in rows])[:-1]]
        order = np.argsort(index, kind="stable")
        present, firsts = np.unique(index[order], return_index=True)
        w, v = self.weights[present], self.factors[present]
        place = np.searchsorted(present, index)
        state = [np.zeros_like(x) for x in (w, w, v, v)] + [0.0, 0.0]
        for step in range(1, rounds + 1):
            scaled = v[place] * value[:, None]
            sums = np.add.reduceat(scaled, starts, axis=0)
            squares = np.add.reduceat((scaled**2).sum(axis=1), starts)
            margin = self.bias + np.add.reduceat(w[place] * value, starts) + 0.5 * ((sums**2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / len(labels)
            part = error[row] * value
            grad_w = np.add.reduceat(part[order], firsts) + 1e-5 * w
            grad_v = np.add.reduceat((part[:, None] * (sums[row] - scaled))[order], firsts, axis=0) + 1e-5 * v
            rate = 0.05
            for at, (what, grad) in enumerate(((w, grad_w), (v, grad_v))):
                m, s = state[2 * at], state[2 * at + 1]
                m += 0.1 * (grad - m)
                s += 0.01 * (grad**2 - s)
                what -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
            state[4] += 0.1 * (error.sum() - state[4])
            state[5] += 0.01 * (error.sum() ** 2 - state[5])
            self.bias -= rate * (state[4] / (1 - 0.9**step)) / (math.sqrt(state[5] / (1 - 0.99**step)) + 1e-8)
        self.weights[present], self.factors[present] = w, v
        unseen = np.setdiff1d(np.arange(_SIZE), present, assume_unique=True)
        self.factors[unseen] = 0.0
        return self


def _held_out(key: str):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(5)) == 0, F.lit(False))


def train(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Machine:
    """Fit on up to ``sample`` labelled rows outside the held-out fold."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("id")).agg((F.max(label) > 0).cast("int").alias("label"))
    chosen = known.where(~_held_out("id")).orderBy(F.crc32(F.concat(F.lit("fit"), F.col("id").cast("string"))), "id").limit(sample)

    def run(texts: list) -> list:
        made = [features(t) for t in texts]
        return [{"index": i, "value": v.astype(np.float32)} for i, v in made]

    make = per_text(run, "index array<int>, value array<float>")
    texts = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    first = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    got = first.select("id", "label", make("text").alias("x")).select("id", "label", "x.*").toArrow().sort_by("id")
    rows = [
        (np.array(i, dtype=np.int64), np.array(v, dtype=np.float64))
        for i, v in zip(got["index"].to_pylist(), got["value"].to_pylist())
    ]
    return Machine().fit(rows, got["label"].to_numpy().astype(float))


def scored(df: DataFrame, machine: Machine, text: str = "text"):
    """The score as a column over ``df``; the model is sent once to each executor."""
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([sent.value.score(t) for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()(F.col(text))


def classify(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, sample: int = SAMPLE
) -> DataFrame:
    """One row per input row: key, held_out, score, predicted."""
    machine = train(df, labels, key, text, sample=sample)
    rows = df.select(F.col(key).alias("id"), scored(df, machine, text).alias("score"))
    return rows.select(
        F.col("id").alias(key),
        _held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``df`` that the classifier does not reject."""
    machine = train(df, labels, key, text)
    rows = df.withColumn("__score", scored(df, machine, text)).where(F.col("__score") >= threshold)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])
