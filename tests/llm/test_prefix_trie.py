"""The trie of conversations against one built by dictionaries of whole prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from conftest import rows_of

from chatledger.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
DDL = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    members = defaultdict(list)
    ended = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(turns.get(c - int(abs(c) % 100) * (1 if c >= 0 else -1), [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ended[whole].append(c)
    kids = defaultdict(int)
    for path in members:
        if path:
            kids[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in kids
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1]) if path else 0)
    out = []
    for path, convs in members.items():
        parent = members[path[:-1]][0] if path else None
        sha = hashlib.sha256(",".join(map(str, ended[path])).encode()).hexdigest()
        out.append((convs[0], len(path), parent, len(convs), kids[path], leaves[path], saved[path], sha))
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r.values()) for r in rows_of(df))


def conversations(seed, n, longest, words, base=0):
    """Random conversations with shared beginnings, copies and prefixes of one another."""
    rnd = random.Random(seed)
    made = []
    for c in range(n):
        if made and rnd.random() < 0.6:
            old = rnd.choice(made)
            turns = old[: rnd.randint(0, len(old))] + [rnd.choice(words) for _ in range(rnd.choice([0, 0, 1, 3]))]
        else:
            turns = [rnd.choice(words) for _ in range(rnd.randint(0, longest))]
        made.append(turns)
    rows = [(base + c, t, "user" if t % 2 else "assistant", text) for c, ts in enumerate(made) for t, text in enumerate(ts)]
    rnd.shuffle(rows)
    return rows


WORDS = ["", "a", "bb", "ccc", "Ü", "a longer turn of words"]


@pytest.mark.parametrize("width, rows, parts", [(512, 1 << 16, 1), (512, 7, 3), (2, 1 << 16, 2), (3, 5, 4), (1, 2, 5)])
def test_random(spark, width, rows, parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        data = conversations(width * 10 + parts, 130, 7, WORDS, base=70)
        df = spark.createDataFrame(data, DDL).repartition(parts)
        assert found(prefix_trie.prefix_trie(df, width=width, rows=rows)) == brute(data)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_blocks(spark):
    """More blocks than one round merges, with one node over all of them."""
    data = conversations(9, 900, 3, WORDS[:3])
    df = spark.createDataFrame(data, DDL)
    assert found(prefix_trie.prefix_trie(df, rows=2)) == brute(data)


def test_hot_conversations(spark):
    """One conversation with a third of the turns, a copy of it, and many copies of a short one."""
    data = [(c, t, "user", f"turn {t % 11}") for c in (3, 512) for t in range(700)]
    data += [(c, t, "user", f"short {t}") for c in range(1000, 1400) for t in range(7)]
    data += [(7, t, "user", f"turn {t % 11}") for t in range(650)] + [(8, t, "user", "other") for t in range(9)]
    df = spark.createDataFrame(data, DDL).repartition(6)
    for width, rows in ((512, 1 << 16), (64, 3)):
        assert found(prefix_trie.prefix_trie(df, width=width, rows=rows)) == brute(data)


def test_odd_rows(spark):
    data = [
        (1, None, "user", "first"), (1, 5, None, None), (1, 5, None, None), (1, 9, "", ""), (None, 1, "user", "lost"),
        (2, 0, "user", "x" * 100_000), (-7, 1, "user", "negative"), (0, 1, "user", "x" * 100_000), (0, 2, "a", "b"),
        (105, 0, "user", "absent base"), (None, None, None, None), (300, None, None, None),
    ]
    df = spark.createDataFrame(data, DDL).selectExpr("*", "1 AS n", "'x' AS m", "2 AS depth", "3 AS conv", "4 AS points")
    assert found(prefix_trie.prefix_trie(df)) == brute(data)
    assert found(prefix_trie.prefix_trie(df.where("false"))) == []
    assert found(prefix_trie.prefix_trie(df.where("conv_id IS NULL"))) == []


def test_edges():
    one, two = (b"%019d" % i + b"x" for i in (1, 2))
    assert prefix_trie._shared(one + two, one + one) == 1 and prefix_trie._shared(one, one + two) == 1
    assert prefix_trie._shared(b"", one) == 0 and prefix_trie._shared(one * 9 + two, one * 9 + two) == 10


def test_query(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op12_prefix_trie(spark, sf_dir)) == brute(data)
