import random

import numpy as np
import pytest
from chatledger.llm import decontaminate as D


def edits(pattern, text):
    """Least edits between the pattern and any stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        after = [i]
        for j, t in enumerate(text, 1):
            after.append(min(row[j - 1] + (c != t), row[j] + 1, after[-1] + 1))
        row = after
    return min(row)


def first(text, item):
    """Where a text first has the whole item, not inside longer words."""
    codes, at = D.normalised(text or "")
    text, item = "".join(map(chr, codes)), "".join(map(chr, D.normalised((item or "").strip())[0]))
    border = lambda k: k in (0, len(text)) or not (text[k - 1].isalnum() and text[k].isalnum())
    for k in range(len(text) - len(item) + 1) if item else ():
        if text[k : k + len(item)] == item and border(k) and border(k + len(item)):
            return int(at[k]), int(at[k + len(item) - 1]) + 1
    return None


def holds(text, item):
    """Whether any window of the item is in the text within its edits, for all windows
    at once, row by row as in ``edits``; a short item must be there whole."""
    code, whole = D.normalised(item.strip())[0], D.normalised(text)[0]
    if len(code) < 24:
        return first(text, item) is not None
    m = min(60, len(code))
    windows = np.lib.stride_tricks.sliding_window_view(code, m)
    steps = np.arange(len(whole) + 1)
    rows = np.zeros((len(windows), len(whole) + 1), dtype=np.int64)
    for i in range(m):
        after = rows + 1
        after[:, 1:] = np.minimum(after[:, 1:], rows[:, :-1] + (whole != windows[:, i : i + 1]))
        rows = np.minimum.accumulate(after - steps, axis=1) + steps
    return bool(rows.min() <= m // 12)


def changed(rnd, text, n):
    text = list(text)
    for _ in range(n):
        at, how = rnd.randrange(len(text)), rnd.randrange(3)
        text[at : at + (how < 2)] = [rnd.choice("abcdexyz ")] if how else []
    return "".join(text)


def words(rnd, n):
    return " ".join("".join(rnd.choice(("th", "er", "on", "an", "re", "in", "ing", "the")) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def test_needed_counts_are_positive():
    assert all(D.shared_needed(m) >= 1 for m in range(D.LEAST, D.PASSAGE + 1))


def test_alignment():
    rnd = random.Random(4)
    code = lambda t: np.array([[ord(c) for c in t]], dtype=np.uint32)
    for _ in range(400):
        pattern = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 12)))
        text = "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 20)))
        pad = len(pattern)
        window = code("." * pad + text + "." * (pad + 1))
        (got,), (end,) = D.aligned(code(pattern), window)
        assert got == edits(pattern, text)
        stretch = window[0, :end].tolist()
        assert min(edits([ord(c) for c in pattern], stretch[s:]) for s in range(end + 1)) == got


@pytest.mark.parametrize("window", [200, D._WINDOW])
def test_random_regions(monkeypatch, window):
    monkeypatch.setattr(D, "_WINDOW", window)
    rnd = random.Random(11)
    items = [words(rnd, rnd.randint(2, 45)) for _ in range(12)]
    index = D.Index([([i], t) for i, t in enumerate(items)])
    seen = [0, 0]
    for _ in range(120):
        part = rnd.choice(items)
        a = rnd.randrange(max(1, len(part) - 80))
        part = changed(rnd, part[a : a + rnd.choice((50, 70, 100, 400))], rnd.randint(0, 12))
        text = words(rnd, rnd.randint(0, 60)) + " " + part.upper() + "\n\n " + words(rnd, rnd.randint(0, 60))
        got = {h["item"][0] for h in index.find([text])[0]}
        want = {i for i, t in enumerate(items) if holds(text, t)}
        assert got == want
        seen[bool(want)] += 1
    assert min(seen) > 10


def test_spans():
    item = "The quick brown fox jumps over the lazy dog while seven wizards box jovially nearby."
    text = "é " * 40 + item.upper().replace(" ", " \n") + " é" * 40
    (hit,) = D.Index([([7], item)]).find([text])[0]
    assert text[hit["start"] : hit["end"]] == item.upper().replace(" ", " \n")
    assert hit["edits"] == 0 and hit["item"] == [7]


def test_documents(spark, documents, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {(r.doc_id, r.item_id) for r in D.contaminated(documents, benchmark).collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if x.lower() in t.lower()}
    assert exact and exact <= got
    for d, i in got - exact:
        assert holds(texts[d], items[i])
    clean = D.keep_clean(documents, benchmark)
    assert clean.columns == documents.columns
    assert {r.doc_id for r in clean.collect()} == set(texts) - {d for d, _ in got}


def test_odd_rows(odd_documents, spark, monkeypatch):
    benchmark = spark.createDataFrame(
        [(1, None, "q"), (2, "", "q"), (3, "the the the", "q"), (4, "wörd5 the wörd6 the wörd7 the wörd8 the", "q"), (4, "a plain text of some words", "q"), (None, "a plain text of some words", "q"), (5, "x" * 100, "q")],
        "item_id int, text string, doc_id string",
    )
    got = sorted(map(str, ((r.doc_id, r.item_id) for r in D.contaminated(odd_documents, benchmark).collect())))
    plain = [(k, i) for k in (0, 0, 0, 0, 5) for i in (4, None)]
    assert got == sorted(map(str, [*plain, (4, 4), (7, 5)]))
    monkeypatch.setattr(D, "BLOCK_CHARS", 30)  # many blocks
    again = sorted(map(str, ((r.doc_id, r.item_id) for r in D.contaminated(odd_documents, benchmark).collect())))
    assert again == got
    assert D.keep_clean(odd_documents, benchmark).count() == odd_documents.count() - 7
    assert D.contaminated(odd_documents, benchmark.limit(0)).count() == 0
    assert D.contaminated(odd_documents.limit(0), benchmark).count() == 0
    assert D.keep_clean(odd_documents, benchmark.limit(0)).count() == odd_documents.count()


@pytest.mark.parametrize("size", [60, 65, 70, 78])
def test_excerpts_at_every_offset(size):
    """A verbatim excerpt of a passage's length counts wherever it begins."""
    rnd = random.Random(size)
    items = [words(rnd, 40) for _ in range(6)]
    index = D.Index([([i], t) for i, t in enumerate(items)])
    texts, want = [], []
    for i, item in enumerate(items):
        for a in range(len(item.strip()) - size + 1):
            texts.append(f"{words(rnd, 20)} # {item.strip()[a : a + size]} # {words(rnd, 20)}")
            want.append(i)
    assert all(i in {h["item"][0] for h in hits} for i, hits in zip(want, index.find(texts)))


@pytest.mark.parametrize("piece", [17, D.PIECE])
def test_changed_excerpts_against_all_windows(monkeypatch, piece):
    """Against every window of every item, also over the borders of pieces and neighbours."""
    monkeypatch.setattr(D, "PIECE", piece)
    rnd = random.Random(21)
    items = [words(rnd, rnd.randint(2, 30)) for _ in range(6)]
    index = D.Index([([i], t) for i, t in enumerate(items)])
    seen = [0, 0]
    for _ in range(100):
        part = rnd.choice(items)
        a = rnd.randrange(max(1, len(part) - 75))
        part = changed(rnd, part[a : a + rnd.randint(56, 75)], rnd.randint(0, 9))
        text = words(rnd, 8) + " " + part + " " + words(rnd, 8)
        want = {i for i, t in enumerate(items) if holds(text, t)}
        assert {h["item"][0] for h in index.find([text])[0]} == want
        seen[bool(want)] += 1
    assert min(seen) > 10


def test_short_items_are_found_whole(spark):
    """Against a search at every place; whole words only, no edits, blanks and case aside."""
    rnd = random.Random(11)
    alphabet = "ab  cA1.?"
    items = ["What is 2+2? Four", "  ", "", None, "yes", "a", "日本", *("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 8))) for _ in range(60))]
    items += ["yes"]  # a repeated row
    texts = ["so:\n what IS  2+2?  four, he said", "What is 2+2? Fourteen", "what is 2+2? fou", "eyes, yes", "eyes", "日本", "日本語", "", None]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(150)]

    want = sorted((d, i, *hit) for d, t in enumerate(texts) for i, x in enumerate(items) if (hit := first(t, x)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = D.contaminated(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.start, r.end) for r in got) == want and len(want) > 300
    assert all((r.edits, r.passages) == (0, 1) for r in got)
    found = {r.doc_id for r in got}
    assert {0, 3, 5} <= found and {1, 2, 4, 6}.isdisjoint({d for d, i, *_ in want if i in (0, 4, 6)})
    assert {r.doc_id for r in D.keep_clean(docs, bench).collect()} == set(range(len(texts))) - found
