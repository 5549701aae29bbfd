import zlib

import numpy as np
from pyspark.sql import functions as F

from chatledger.llm import quality as Q


def test_sum_of_squares_identity():
    machine = Q.Machine(rank=3)
    machine.weights = np.random.default_rng(1).normal(size=Q._SIZE)
    machine.factors = np.random.default_rng(2).normal(size=(Q._SIZE, 3))
    index, value = Q.features("some words and some more words 123")
    want = machine.bias + sum(machine.weights[i] * v for i, v in zip(index, value))
    for a in range(len(index)):
        for b in range(a):
            want += machine.factors[index[a]] @ machine.factors[index[b]] * value[a] * value[b]
    assert np.isclose(machine.margin(index, value), want)


def test_gradients():
    """One step moves as numeric derivatives say: the loss goes down all along."""
    rows = [Q.features(t) for t in ("good words here", "spam spam spam", "fine text of words", "spam bad spam")]
    labels = np.array([1.0, 0.0, 1.0, 0.0])

    def loss(machine):
        p = 1 / (1 + np.exp(-np.array([machine.margin(*r) for r in rows])))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    losses = [loss(Q.Machine().fit(rows, labels, n)) for n in (0, 5, 20, 60)]
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.2


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "labels"))
    rows = Q.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = sorted(r.score for r in rows if r.quality == 1)
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([np.searchsorted(good, b, "right") < len(good) and 1 - np.searchsorted(good, b, "right") / len(good) for b in bad])
    assert auc > 0.95
    assert np.mean([r.predicted == 1 for r in rows if r.quality == 1]) > 0.95
    assert np.mean([r.predicted == 0 for r in rows if r.quality == 0]) > 0.6


def test_fold_and_determinism(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    first = {r.doc_id: r for r in Q.classify(documents, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in first.items())
    # labels of the held-out fold, languages and sources play no part
    other = labels.withColumn("quality", labels.quality * 0).where("pmod(crc32(cast(doc_id AS string)), 5) = 0")
    rest = labels.where("pmod(crc32(cast(doc_id AS string)), 5) <> 0")
    again = Q.classify(documents.withColumn("lang", documents.source), rest.unionByName(other).repartition(7))
    assert {r.doc_id: r.score for r in again.collect()} == {k: r.score for k, r in first.items()}


def test_odd_rows(odd_documents, spark):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 0), (9, 0), (4, 1), (8, 0), (99, 1)], "doc_id bigint, quality int")
    got = Q.classify(odd_documents, labels).collect()
    assert len(got) == odd_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out is not None for r in got)
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1  # null as empty
    nothing = Q.classify(odd_documents, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    ones = Q.classify(odd_documents, labels.where("quality = 1 AND doc_id = 4")).collect()
    assert all(r.predicted == 1 for r in ones)
    kept = Q.keep_good(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r.predicted for r in got)
    assert Q.classify(odd_documents.limit(0), labels).count() == 0


def test_clashing_names(documents, spark, sf_dir):
    """Columns of documents and labels that are named as the operator names its own."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    extra = [F.lit("z").alias(name) for name in ("id", "label", "index", "value", "quality", "predicted")]
    docs = documents.select("*", *extra)
    known = labels.select("*", *[F.lit("z").alias(name) for name in ("id", "label", "text")])
    want = {r.doc_id: r.score for r in Q.classify(documents, labels).collect()}
    assert {r.doc_id: r.score for r in Q.classify(docs, known).collect()} == want
    kept = Q.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert kept.count() == sum(s >= 0.3 for s in want.values())
