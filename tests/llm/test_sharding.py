from collections import Counter

import pytest
import xxhash
from chatledger.llm import sharding as S


def by_hand(names, size):
    """Turn by turn over whole preference lists."""
    lists = []
    for n in names:
        a, b = xxhash.xxh64_intdigest(n, 1) % size, xxhash.xxh64_intdigest(n, 2) % (size - 1) + 1
        lists.append([(a + i * b) % size for i in range(size)])
    table = {}
    while len(table) < size:
        for shard, wishes in enumerate(lists):
            slot = next((s for s in wishes if s not in table), None)
            if slot is not None:
                table[slot] = shard
    return [table[s] for s in range(size)]


def test_table():
    names = S.shard_names(7)
    assert S.lookup_table(names, 101) == by_hand(names, 101)
    counts = Counter(S.lookup_table(S.shard_names(), S.SLOTS))
    assert len(counts) == 64 and max(counts.values()) - min(counts.values()) <= 1
    weighed = Counter(S.lookup_table(names[:3], 1009, [1, 2, 4]))
    assert abs(weighed[2] / weighed[0] - 4) < 0.1 and abs(weighed[1] / weighed[0] - 2) < 0.1


def test_few_keys_move():
    names = S.shard_names(20)
    before, after = S.lookup_table(names, 10_007), S.lookup_table(names[:-1], 10_007)
    moved = sum(a != b for a, b in zip(before, after))
    assert moved < 0.12 * 10_007  # a twentieth must


@pytest.mark.parametrize("names, slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2), (["a"], 99_999_989)])
def test_wrong_parameters(names, slots):
    with pytest.raises(ValueError):
        S.lookup_table(names, slots)


def test_documents(documents, odd_documents):
    names = S.shard_names()
    table = S.lookup_table(names)
    for df in (documents, odd_documents):
        got = S.place(df).collect()
        assert len(got) == df.count()
        for r in got:
            key = "\x00null" if r.doc_id is None else str(r.doc_id)
            slot = xxhash.xxh64_intdigest(key.encode(), 42)
            slot = (slot - (1 << 64) if slot >> 63 else slot) % S.SLOTS
            assert (r.slot, r.shard) == (slot, names[table[slot]])
    assert S.place(documents.limit(0)).count() == 0
    assert S.with_shard(odd_documents).columns == [c for c in odd_documents.columns if c != "slot"] + ["slot", "shard"]


def test_write(documents, tmp_path, spark):
    S.write_shards(documents, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    want = {(r.doc_id, r.shard) for r in S.place(documents).collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == want
