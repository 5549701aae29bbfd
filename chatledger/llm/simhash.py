"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``2 * r`` bits of each other have a common variant within ``r`` bits
of both. So every distinct fingerprint emits all variants within half the distance,
variants are shuffled, and fingerprints that meet are verified by their bit distance.
Equal fingerprints are one before that, however many documents have them, and at most
as many distinct fingerprints meet at a variant as lie in its ball (65 for one bit): no
group grows with the data. Those that meet at a variant are linked to the smallest of
them (for an even distance all of them are within it), so no group is paired out.

Null texts have no words, as empty ones: fingerprint zero, which links like any other.
Repeated rows are documents of their own with one component. Null ids count as larger than
any id; a component of only such rows has a null id. Words are cut in blocks, so that a
very long text needs little memory beside itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import stored
from chatledger.llm.components import components

SHINGLE, DISTANCE, SEED = 3, 2, 42
_BLOCK = 1 << 20


def _words(data: bytes) -> Iterator[list[bytes]]:
    """Lower-cased words in blocks; ``bytes`` methods know only ASCII letters and blanks,
    as the definition does."""
    at = 0
    while at < len(data):
        end = at + _BLOCK
        while end < len(data) and data[end] not in b"\x20\x09\x0a\x0b\x0c\x0d":
            end += 1
        yield data[at:end].lower().split()
        at = end


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits as an unsigned integer; a bit is set if over half of the shingles have it."""
    ones, count, rest = np.zeros(64, dtype=np.int64), 0, []
    hashed = xxhash.xxh64_intdigest

    def add(shingles: Iterator[bytes] | list[bytes]) -> int:
        values = np.array([hashed(s, SEED) for s in shingles], dtype="<u8")
        if len(values):
            ones[:] += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(values)

    for words in _words((text or "").encode("utf-8", "replace")):
        words = rest + words
        count += add(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
        rest = words[max(0, len(words) - shingle + 1) :]
    if not count and rest:
        count = add([b" ".join(rest)])
    if not count:
        return 0
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, body) of every row: the key, the fingerprint as a signed long, and a hash
    of the text that tells rows of one key apart."""

    def run(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64)
        return pa.array(values.view(np.int64))

    hashed = F.arrow_udf(run, "bigint").asNondeterministic()
    return df.select(F.col(key).alias("id"), hashed(F.col(text)).alias("fp"), F.xxhash64(F.col(text)).alias("body"))


def _masks(radius: int) -> list[int]:
    """All 64-bit masks of up to ``radius`` set bits, as signed longs."""
    out = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) of ``distinct.fp`` within the bit distance, enough of them to connect all
    that are linked."""
    masks = ", ".join(f"{m}L" if m > -(1 << 63) else "(-9223372036854775807L - 1L)" for m in _masks((distance + 1) // 2))
    variants = distinct.select("fp", F.explode(F.expr(f"transform(array({masks}), m -> fp ^ m)")).alias("variant"))
    if distance % 2 == 0:
        least = F.min("fp").over(Window.partitionBy("variant"))
        pairs = variants.select("fp", least.alias("least")).where("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    else:  # those that meet may be one bit too far apart, so each pair of the ball counts
        other = variants.select(F.col("fp").alias("b"), "variant")
        pairs = variants.withColumnRenamed("fp", "a").join(other, "variant").where("a < b").select("a", "b")
    return pairs.where(F.expr(f"bit_count(a ^ b) <= {int(distance)}")).distinct()


def clustered(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, id, body): for each fingerprint of ``prints`` the first document of its
    component, by smallest id (nulls last), then text hash."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "body"))
    distinct = stored(prints.groupBy("fp").agg(first.alias("first")), "fingerprints")
    roots = components(links(distinct.select("fp"), distance))
    rows = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rows = stored(rows.select("fp", F.coalesce("root", "fp").alias("root"), "first"), "roots")
    best = rows.groupBy("root").agg(F.min("first").alias("best"))
    return rows.join(best, "root").select("fp", "best.id", "best.body")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row per input row: key, fingerprint (16 lowercase hex digits), component_id
    (smallest key reachable over links)."""
    prints = stored(fingerprints(df, key, text, shingle), "prints")
    found = clustered(prints, distance).select("fp", F.col("id").alias("component_id"))
    rows = prints.select("id", "fp").join(found, "fp")
    return rows.select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The rows of ``df`` that are the first document of their component: one row each,
    also where rows repeat."""
    prints = stored(fingerprints(df, key, text, shingle), "prints")
    keys = {
        "__id": F.coalesce(F.col(key), F.lit(0).cast(df.schema[key].dataType)),
        "__no_id": F.col(key).isNull(),
        "__body": F.xxhash64(F.col(text)),
    }
    # repeated rows have one key and text: any of them will do, and the others go before the shuffle
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("__body"))
    rows = df.withColumns(keys).withColumn("__number", number).where("__number = 1")
    wanted = clustered(prints, distance).select(
        F.coalesce("id", F.lit(0)).alias("__id"), F.col("id").isNull().alias("__no_id"), F.col("body").alias("__body")
    )
    kept = rows.join(wanted.distinct(), list(keys), "left_semi")
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
