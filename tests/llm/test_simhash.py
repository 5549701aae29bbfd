import random
import re
from collections import defaultdict

import xxhash
from chatledger.llm import components as C
from chatledger.llm import simhash as S


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def grouped(prints, distance):
    """Smallest id reachable of each (id, fingerprint), by trying all pairs."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (key, _) in enumerate(prints):
        groups[root(i)].append(key)
    return [min((k for k in groups[root(i)] if k is not None), default=None) for i in range(len(prints))]


def test_documents(documents):
    texts = [(r.doc_id, by_hand(r.text)) for r in documents.select("doc_id", "text").collect()]
    want = {k: (f"{fp:016x}", root) for (k, fp), root in zip(texts, grouped(texts, 2))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(documents).collect()}
    assert got == want
    assert any(root != k for k, (_, root) in got.items())


def test_odd_rows(odd_documents, monkeypatch):
    monkeypatch.setattr(S, "_BLOCK", 64)  # also blocks that end within shingles
    rows = [(r.doc_id, by_hand(r.text)) for r in odd_documents.collect()]
    for r in odd_documents.collect():
        assert S.fingerprint(r.text) == by_hand(r.text)
    want = sorted((str(k), f"{fp:016x}", str(root)) for (k, fp), root in zip(rows, grouped(rows, 2)))
    got = sorted((str(r[0]), r[1], str(r[2])) for r in S.near_duplicates(odd_documents).collect())
    assert got == want
    kept = S.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({root for _, _, root in want})
    assert S.near_duplicates(odd_documents.limit(0)).count() == 0


def fingerprints(spark, values):
    return spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v, 0) for i, v in enumerate(values)], "id bigint, fp bigint, body bigint")


def test_distances(spark):
    rnd = random.Random(1)
    for distance in (1, 2, 3):
        values = [rnd.getrandbits(64) for _ in range(20)]
        for _ in range(150):
            v = rnd.choice(values)
            for _ in range(rnd.randint(0, 4)):
                v ^= 1 << rnd.randrange(64)
            values.append(v)
        roots = grouped(list(enumerate(values)), distance)
        got = {r.fp % (1 << 64): r.id for r in S.clustered(fingerprints(spark, values), distance).collect()}
        assert [got[v] for v in values] == roots


def test_hot_fingerprint_and_ball(spark):
    center = 12345
    values = [center] * 5000 + [center ^ 1 << b for b in range(64)]
    got = S.clustered(fingerprints(spark, values)).collect()
    assert len(got) == 65 and {r.id for r in got} == {0}


def test_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1001, 1000), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in C.components(links).collect()}
    assert got == {i: 0 for i in range(1, n)} | {1001: 1000}


def test_shared_letters_keep_documents_apart(documents):
    kept = S.keep_one(documents).count()
    want = len({r.component_id for r in S.near_duplicates(documents).collect()})
    assert kept == want
