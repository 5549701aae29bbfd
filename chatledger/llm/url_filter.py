"""URL rules by Bloom filter cascades.

A rule is a host and a path prefix with a verdict. A url's candidate keys are its host
suffixes at label borders, joined with its path prefixes of the lengths that rules have;
a rule fits exactly if its key is among them. Each verdict's list of keys becomes a
cascade over the corpus's complete key universe (the candidate keys of all urls): level 1
holds the listed keys, level 2 the universe keys that pass level 1 without being listed,
level 3 the listed keys that pass level 2, and so on until a level lets nothing wrong
through. Membership of every key of this corpus is then exact, and judging a url takes
bit probes only: no join.

Level 1 is sized for a false-positive rate of sqrt(1/2) * listed / universe and the others
for 1/2, so the cascade has a few bytes per listed key. It is broadcast up to ``MAX_BYTES``;
a longer list is split by hash into parts that are judged one after the other.

Null urls and urls without ``://`` have empty host and path and fit no rule. Repeated
urls are judged alike. An empty table or rule list is fine. Only the key and the url
column are read. Of equally long rules that of the longer
host wins; a key listed with both verdicts blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import stored

#: The rules of the registered query: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Of one cascade, as broadcast; and how many different path lengths of rules are listed one by one.
MAX_BYTES, MAX_LENGTHS = 128 << 20, 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_MOST_LEVELS = 64


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _candidates(host: str, path: str, labels: int, lengths: list[int]) -> Column:
    """All keys of a url that a rule could have, longest first, then those of longer hosts
    (the sort is stable). Beyond ``MAX_LENGTHS`` path lengths every length up to the longest
    counts; the cascade is exact for all of them, and a url has no more than its own."""
    cut = f"split({host}, '\\\\.')"
    hosts = (
        f"transform(sequence(greatest(1, size({cut}) - {labels - 1}), size({cut})), "
        f"i -> array_join(slice({cut}, i, size({cut})), '.'))"
    )
    widths = f"filter(array({', '.join(map(str, lengths))}), w -> w <= char_length({path}))"
    if len(lengths) > MAX_LENGTHS:
        widths = f"sequence(0, least(char_length({path}), {max(lengths)}))"
    keys = f"flatten(transform({hosts}, h -> transform({widths}, w -> concat(h, substring({path}, 1, w)))))"
    ordered = f"array_sort({keys}, (a, b) -> char_length(b) - char_length(a))"
    return F.expr(f"CASE WHEN {host} = '' THEN CAST(array() AS array<string>) ELSE {ordered} END")


def _hashed(key: str) -> list[Column]:
    """128 bits of a key, as two hashes."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit("second")).alias("h2")]


class Cascade:
    """The bits of all levels; small, sent to every task."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, int, int]] = []

    @staticmethod
    def sized(keys: int, rate: float) -> tuple[int, int]:
        """Bits and probes for so many keys."""
        bits = max(64, math.ceil(-keys * math.log(rate) / math.log(2) ** 2))
        return (bits + 63) // 64 * 64, max(1, round(-math.log2(rate)))

    @staticmethod
    def positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        a = (h1.view(np.uint64) ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
        a ^= a >> np.uint64(31)
        b = (h2.view(np.uint64) + salt) * np.uint64(0x94D049BB133111EB)
        b = (b ^ (b >> np.uint64(29))) | np.uint64(1)
        steps = np.arange(probes, dtype=np.uint64)
        return (a[:, None] + b[:, None] * steps) % np.uint64(bits)

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words, bits, probes = self.levels[level]
        at = self.positions(h1, h2, level, bits, probes)
        hit = (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return hit.all(axis=1)

    def members(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Of each key, whether it is listed: the first level that lacks it decides."""
        out = np.zeros(len(h1), dtype=bool)
        left = np.arange(len(h1))
        for level in range(len(self.levels)):
            ok = self.passes(level, h1[left], h2[left])
            out[left[~ok]] = level % 2 == 1
            left = left[ok]
        out[left] = len(self.levels) % 2 == 1
        return out


def _level(keys: DataFrame, count: int, level: int, rate: float) -> tuple[np.ndarray, int, int]:
    """One filter: set bits are joined per batch, then per word of 64 bits."""
    bits, probes = Cascade.sized(count, rate)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2 = (np.asarray(batch.column(i)).astype(np.int64) for i in (0, 1))
            at = np.unique(Cascade.positions(h1, h2, level, bits, probes))
            word = (at >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            joined = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            yield pa.record_batch({"word": word[first], "bits": joined.view(np.int64)})

    rows = keys.select(*_hashed("key")).mapInArrow(words, "word bigint, bits bigint")
    got = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most `bits` bits
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out, bits, probes


def _passing(keys: DataFrame, cascade: Cascade, level: int) -> DataFrame:
    """The keys that one level lets through."""
    sent = keys.sparkSession.sparkContext.broadcast(cascade)

    def test(h1: pa.Array, h2: pa.Array) -> pa.Array:
        return pa.array(sent.value.passes(level, *(np.asarray(h).astype(np.int64) for h in (h1, h2))))

    ok = F.arrow_udf(test, "boolean")
    return keys.where(ok(*_hashed("key"))).select("key")


def build(listed: DataFrame, universe: DataFrame, universe_size: int) -> Cascade:
    """The cascade of ``listed.key`` over ``universe.key``. ``universe`` is read once; the
    rest works on listed keys and false positives, which are about as many."""
    listed = stored(listed.select("key").distinct(), "listed")
    inside, cascade = listed.count(), Cascade()
    if not inside:
        return cascade
    rate = min(0.5, math.sqrt(0.5) * inside / max(universe_size, inside))
    cascade.levels.append(_level(listed, inside, 0, rate))
    wrong = _passing(universe.select("key"), cascade, 0).distinct().join(listed, "key", "left_anti")
    into, other = stored(wrong, "passing"), listed
    while count := into.count():
        if len(cascade.levels) >= _MOST_LEVELS:
            raise ValueError("two keys have the same 128-bit hash")
        cascade.levels.append(_level(into, count, len(cascade.levels), 0.5))
        into, other = stored(_passing(other, cascade, len(cascade.levels) - 1), "passing"), into
    return cascade


def filter_urls(
    df: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", max_bytes: int = MAX_BYTES
) -> DataFrame:
    """One row per input row: key, host, path, the longest rule that fits (else null) and
    the verdict: the rule's, else ``allow``, as the url is on no list.

    ``rules`` has the string columns verdict (allow or block), host, path."""
    spark = df.sparkSession
    rules = rules.select("verdict", "host", "path", F.concat("host", "path").alias("key"))
    shape = rules.agg(
        F.count("*").alias("n"),
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.array_sort(F.collect_set(F.char_length("path"))).alias("lengths"),
    ).first()
    rows = df.select(F.col(key).alias("id"), F.col(url).alias("url"))
    rows = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if not shape["n"]:
        return rows.select(
            F.col("id").alias(key), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict")
        )
    rows = rows.withColumn("keys", _candidates("host", "path", shape["labels"], shape["lengths"]))
    universe = rows.select(F.explode("keys").alias("key"))
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    # listed keys cost at most 1.44 * (log2(universe / listed) + 4) bits each
    bits = 1.44 * (math.log2(max(2, size)) + 4)
    parts = max(1, math.ceil(shape["n"] * bits / 8 / max_bytes))
    judged = rows.withColumns({v: F.lit(None).cast("array<boolean>") for v in ("allow", "block")})
    for part in range(parts):
        for verdict in ("allow", "block"):
            chosen = rules.where((F.col("verdict") == verdict) & (F.pmod(F.xxhash64("key"), F.lit(parts)) == part))
            tested = _members(spark, build(chosen, universe, size))
            hashes = [F.expr(f"transform(keys, k -> xxhash64({x}))") for x in ("k", "k, 'second'")]
            got = tested(*hashes)
            either = F.zip_with(F.col(verdict), got, lambda a, b: a | b) if part else got
            judged = judged.withColumn(verdict, either)
        if part + 1 < parts:
            judged = stored(judged, "judged")
    hit = F.expr("array_position(zip_with(allow, block, (a, b) -> a OR b), true)")
    judged = judged.select("id", "host", "path", "keys", "block", hit.cast("int").alias("hit"))
    return judged.select(
        F.col("id").alias(key),
        "host",
        "path",
        F.expr("CASE WHEN hit > 0 THEN element_at(keys, hit) END").alias("rule"),
        F.expr("CASE WHEN hit > 0 AND element_at(block, hit) THEN 'block' ELSE 'allow' END").alias("verdict"),
    )


def _members(spark, cascade: Cascade):
    sent = spark.sparkContext.broadcast(cascade)

    def test(h1: pa.Array, h2: pa.Array) -> pa.Array:
        flat = [np.asarray(h.flatten()).astype(np.int64) for h in (h1, h2)]
        found = sent.value.members(*flat)
        sizes = np.r_[0, np.cumsum(np.asarray(h1.value_lengths().fill_null(0)))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(sizes), pa.array(found, pa.bool_()))

    return F.arrow_udf(test, "array<boolean>").asNondeterministic()
