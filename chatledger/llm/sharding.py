"""Consistent placement by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a table of prime size (an offset
and a step, from hashes of its name). Shards take turns, by weight, and claim their next
free slot until the table is full. A key belongs to the shard that owns slot
``hash(key) mod size``: one probe, and few keys move when a shard comes or goes.

The table's size is a parameter of at most ``MOST_SLOTS``, so it can be broadcast whatever the
data. Placement is row-local: no shuffle, so hot keys cost nothing.

Keys are hashed as text (XXH64), so an id gets its shard whatever its integer type. All null
keys share one slot, equal keys always do. Empty tables give empty results, and other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS, MOST_SLOTS, SHARDS = 65_537, 1 << 22, 64
_NO_KEY = "\x00null"


def shard_names(count: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(count)]


def lookup_table(names: Sequence[str], slots: int = SLOTS, weights: Sequence[float] | None = None) -> list[int]:
    """The owner (position in ``names``) of each slot."""
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need different names, and one at least")
    if not len(names) <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    weights = list(weights or [1.0] * len(names))
    if len(weights) != len(names) or min(weights) <= 0:
        raise ValueError("each shard needs a positive weight")
    place = [xxhash.xxh64_intdigest(n, 1) % slots for n in names]
    step = [xxhash.xxh64_intdigest(n, 2) % (slots - 1) + 1 for n in names]
    credit, most = [0.0] * len(names), max(weights)
    table, free = [-1] * slots, slots
    while True:
        for shard, weight in enumerate(weights):
            credit[shard] += weight / most
            if credit[shard] < 1 - 1e-9:
                continue
            credit[shard] -= 1
            at = place[shard]
            while table[at] >= 0:
                at = (at + step[shard]) % slots
            table[at], place[shard] = shard, (at + step[shard]) % slots
            free -= 1
            if not free:
                return table


def _table(spark: SparkSession, names: Sequence[str], slots: int, weights) -> DataFrame:
    owners = lookup_table(names, slots, weights)
    rows = pa.table({"__slot": pa.array(range(slots), pa.int64()), "__shard": pa.array([names[o] for o in owners])})
    return spark.createDataFrame(rows)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(_NO_KEY))), F.lit(slots))


def with_shard(
    df: DataFrame, key: str = "doc_id", names: Sequence[str] | None = None, slots: int = SLOTS, weights: Sequence[float] | None = None
) -> DataFrame:
    """``df`` with the columns slot and shard; columns of these names are replaced."""
    names = names or shard_names()
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    rows = df.select(*kept, slot_of(F.col(key), slots).alias("__slot"))
    rows = rows.join(F.broadcast(_table(df.sparkSession, names, slots, weights)), "__slot", "left")
    return rows.select(*kept, F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))


def place(df: DataFrame, key: str = "doc_id", names: Sequence[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """One row per input row: key, slot, shard."""
    return with_shard(df.select(key), key, names, slots)


def write_shards(df: DataFrame, path: str, key: str = "doc_id", names: Sequence[str] | None = None, spread: int = 8) -> None:
    """A directory per shard, its rows spread over ``spread`` tasks by a hash of the row."""
    rows = with_shard(df, key, names)
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(spread))
    rows.withColumn("__salt", salt).repartition("shard", "__salt").drop("__salt").write.partitionBy("shard").parquet(path)
