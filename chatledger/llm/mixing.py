"""Mixing sources to target weights by entropy balancing.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the words of
all documents by weight. A target stops at ``MOST`` times its source's words; the excess is
shared again by weight until none is above.

The rates closest in relative entropy to taking every word once, under a token constraint
for each source, are exponential tilts exp(lambda) of that base rate. lambda solves the
convex dual sum_s (W_s exp(lambda_s) - lambda_s * target_s) by Newton steps. Documents of a
source have the same row in the constraint matrix, so their part of the gradient and of the
(diagonal) Hessian is one sum a source, W_s: a distributed aggregate, after which each step
works on the table of sources.

Rates become whole copies: every document gets floor(rate), and extra copies go to cells of
(source, size), from large sizes to small, so that the words given out follow the words due
at each cell: what a large document misses, smaller ones make up for, and a few exchanges
of single copies bring a source to its target or next to it. Which documents of a cell get the extra
copy is decided by a hash of id and text, in buckets of bounded size; so reruns agree and
no cell, however hot, is ranked by one task.

Null texts have size 0 and null sources are a source. Repeated rows are documents of their
own. Rows of size 0 take nothing; in ``mixed`` they get the copies that their rate gives.
Without documents the result is empty. Only the three columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import stored

WEIGHTS, MOST = (5, 2, 1), 3
#: Rows of a cell that are ranked together, Newton steps, rounds of sharing out, exchanges.
_BUCKET, _STEPS, _ROUNDS, _MENDS = 100_000, 200, 10_000, 20
_WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place in code-point order, null last: counted by ranges, so that
    no task sees all sources."""
    ranged = sources.repartitionByRange(F.col("source").isNull(), F.col("source"))
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "sources")
    counts = ranged.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("range", F.coalesce(before, F.lit(0)).alias("offset"))
    inner = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").isNull(), "source"))
    return ranged.join(offsets, "range").withColumn("place", F.col("offset") + inner - 1).drop("range", "offset")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, words) with place and target, by sharing out until no target is above."""
    shares = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    rows = stored(_ranked(sources).withColumn("weight", shares), "weighed")
    full = F.col("words") * F.lit(float(most))
    rate = 0.0  # a source is full if its share at this rate is not below its cap
    for _ in range(_ROUNDS):
        over = F.col("weight") * F.lit(rate) > full
        got = rows.agg(
            F.sum("words").alias("total"),
            F.sum(F.when(over, full)).alias("full"),
            F.sum(F.when(~over, F.col("weight"))).alias("weight"),
        ).first()
        after = (got["total"] - (got["full"] or 0.0)) / got["weight"] if got["weight"] else rate
        if after <= rate:
            break
        rate = after
    else:
        raise RuntimeError("the shares did not settle")
    return rows.withColumn("target", F.least(F.col("weight") * F.lit(rate), full)).drop("weight")


def rates(balanced: DataFrame, most: float = MOST) -> DataFrame:
    """The tilt exp(lambda) of each source as ``rate``, by Newton steps on the dual."""
    newton = f"""CASE WHEN words > 0 AND target > 0 THEN least(double({most}), exp(aggregate(
        sequence(1, {_STEPS}), 0D, (x, i) -> x - (words * exp(x) - target) / (words * exp(x))))) ELSE 0D END"""
    return balanced.withColumn("rate", F.expr(newton))


def _rounded(cells: pd.DataFrame) -> pd.DataFrame:
    """Extra copies for the cells of one source: from large sizes to small, as many as
    bring the words given out nearest to the words due so far. What is still missing or
    too much at the end is mended by single copies added, taken away or exchanged."""
    cells = cells.sort_values("size", ascending=False)
    extra, due, given = [], 0.0, 0
    for size, n, part in zip(cells["size"], cells["n"], cells["part"]):
        due += part * n * size
        k = min(int(n), max(0, round((due - given) / size))) if size else round(part * n)
        given += k * int(size)
        extra.append(k)
    sizes, counts, extra = cells["size"].to_numpy(), cells["n"].to_numpy(), np.array(extra, dtype=np.int64)
    for _ in range(_MENDS):
        missing = due - float(given)
        plus = np.flatnonzero((extra < counts) & (sizes > 0))[::-1]  # by rising size, as the other
        minus = np.flatnonzero((extra > 0) & (sizes > 0))[::-1]
        # one more of size a and one less of size b; 0: nothing
        a, b = np.r_[0, sizes[plus]], np.r_[0, sizes[minus]]
        at = np.searchsorted(b, a - missing)
        near = np.stack([np.clip(at - 1, 0, len(b) - 1), np.clip(at, 0, len(b) - 1)])
        errors = np.abs(missing - a + b[near])
        side, best = np.unravel_index(errors.argmin(), errors.shape)
        if errors[side, best] >= abs(missing) - 1e-9:
            break
        other = near[side, best]
        if best:
            extra[plus[best - 1]] += 1
        if other:
            extra[minus[other - 1]] -= 1
        given += int(a[best]) - int(b[other])
    return pd.DataFrame({"place": cells["place"], "size": sizes, "n": counts, "extra": extra})


def copies(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
) -> DataFrame:
    """(id, body, size, n, source_size, target, base, extra): for the ``n`` equal rows of an
    id and text hash, the copies that each gets and how many of them get one more."""
    rows = df.select(
        F.col(key).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("body"), size_of(F.col(text)).alias("size")
    )
    groups = stored(rows.groupBy("id", "source", "body", "size").agg(F.count("*").alias("n")), "groups")
    sources = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    plan = stored(rates(targets(sources, weights, most), most), "rates")
    whole = F.floor(F.col("rate") + 1e-9).cast("bigint")
    plan = plan.withColumns({"base": whole, "part": F.greatest(F.lit(0.0), F.col("rate") - whole)})
    # few rows a source; a source's rows need not meet for this
    joined = groups.join(plan, groups["source"].eqNullSafe(plan["source"])).drop("source")
    cells = joined.groupBy("place", "size", "part").agg(F.sum("n").alias("n"))
    extra = cells.groupBy("place").applyInPandas(_rounded, "place bigint, size bigint, n bigint, extra bigint")
    extra = stored(extra.withColumnRenamed("n", "cell"), "extra")
    bucket = F.pmod(F.xxhash64("id", "body", F.lit("bucket")), F.ceil(F.col("cell") / _BUCKET).cast("bigint"))
    dealt = stored(joined.join(extra, ["place", "size"]).withColumn("bucket", bucket), "dealt")
    counts = dealt.groupBy("place", "size", "bucket").agg(F.sum("n").alias("in_bucket"))
    upto = F.sum("in_bucket").over(Window.partitionBy("place", "size").orderBy("bucket"))
    counts = counts.withColumn("upto", upto)
    due = "floor(extra * upto / cell) - floor(extra * (upto - in_bucket) / cell)".replace("extra", "decimal(extra)")
    order = Window.partitionBy("place", "size", "bucket").orderBy(F.xxhash64("id", "body", F.lit("order")), "id", "body")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranked = dealt.join(counts, ["place", "size", "bucket"]).withColumn("before", F.coalesce(before, F.lit(0)))
    return ranked.select(
        "id",
        "body",
        "size",
        "n",
        F.col("words").alias("source_size"),
        "target",
        "base",
        F.expr(f"greatest(0, least(n, bigint({due}) - before))").alias("extra"),
    )


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """One row per input row: key, size, source_size, target, taken, copies."""
    rows = copies(df, key, text, source, **options)
    rows = rows.withColumn("number", F.explode(F.expr("sequence(bigint(1), n)")))
    number = F.col("base") + (F.col("number") <= F.col("extra")).cast("bigint")
    return rows.select(
        F.col("id").alias(key), "size", "source_size", "target", (number * F.col("size")).alias("taken"), number.alias("copies")
    )


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it."""
    plan = copies(df, key, text, source, **options)
    keys = {"__id": F.col("id"), "__body": F.col("body"), "__base": F.col("base"), "__extra": F.col("extra"), "__n": F.col("n")}
    plan = plan.select(*(c.alias(n) for n, c in keys.items()), F.col("target").alias("__target"), F.col("source_size").alias("__words"))
    rows = df.withColumn("__text_hash", F.xxhash64(text))
    joined = rows.join(plan.drop("__target", "__words"), rows[key].eqNullSafe(plan["__id"]) & (rows["__text_hash"] == plan["__body"]))
    # equal rows are interchangeable: the first __extra of them get one more
    number = F.row_number().over(Window.partitionBy("__id", "__body").orderBy("__n"))
    times = F.col("__base") + (F.col("__number") <= F.col("__extra")).cast("bigint")
    rows = joined.withColumn("__number", F.when(F.col("__n") == 1, F.lit(1)).otherwise(number)).withColumn("__times", times)
    rows = rows.where("__times > 0").withColumn("__copy", F.explode(F.expr("sequence(bigint(1), __times)")))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns])

