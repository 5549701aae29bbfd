import random
import unicodedata

import public_tokenizers
import pytest
from chatledger.llm import token_counts as C
from tokenizers import Tokenizer

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as f:
        return C.Counter(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def length(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_words(counter, library):
    rnd = random.Random(9)
    parts = ["the", "th", "er", "ing", "a", "aaa", "xyz", "qu", "on", "é", "日本", "ß", "ğ", "zz", "'", "''", "#!", "...", "=", "😀"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9)))
        assert counter.count(text) == length(library, text), text
    for _ in range(1500):
        text = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, 30)))
        assert counter.count(text) == length(library, text), text
    for _ in range(300):
        text = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 300)))
        assert counter.count(text) == length(library, text), text


def test_odd_texts(counter, library):
    texts = [
        "", " ", "<|endoftext|>", "a<|endoftext|>b", "<|endoftext|><|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "it's I'LL 'S '",
        "ΑΣ ΣΑΣ Σ", "İstanbul", "é ́x", "ﬁ ² ½ ⅷ 一二", "a b c​d﻿", "a\x00b\x1cc\x85d", "͸ \U000e0fff x",
        "KK", "Ɤ x", "\U00010d50", "1234 ٣٤ 5", "_a_ __", "\r\n\t\x0b\x0c", "क्षि नमस्ते", "🏳️‍🌈 👨‍👩‍👧",
    ]
    for text in texts:
        assert counter.count(text) == length(library, text), text


def test_random_characters(counter, library):
    rnd = random.Random(10)
    pool = [chr(c) for c in range(1, 0x30000) if unicodedata.category(chr(c)) not in ("Cs", "Co")][::7]
    for _ in range(1500):
        text = "".join(rnd.choice(pool) + rnd.choice(("", "", " ", "a", "́")) for _ in range(rnd.randint(1, 12)))
        assert counter.count(text) == length(library, text), text


def test_chunks_compose(counter, library):
    rnd = random.Random(11)
    bits = ["the ", "ing", "<|endoftext|>", "<|endof", "text|>", "\n", "é", "e", "́", " ", "'s", "12", "Σ", "x" * 40]
    for _ in range(500):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))
        size = rnd.randint(1, 30)
        maps = [counter.map(text[i : i + size]) for i in range(0, len(text), size)]
        assert counter.scan(maps) == length(library, text), text
        if len(maps) > 2:  # associative
            left = counter.compose(counter.compose(*maps[:2]), maps[2])
            assert left == counter.compose(maps[0], counter.compose(*maps[1:3]))


def test_tables_stay_bounded(library, monkeypatch):
    monkeypatch.setattr(C, "_MOST_WORDS", 50)
    monkeypatch.setattr(C, "_MOST_STATES", 80)
    with open(PATH, encoding="utf-8") as f:
        small = C.Counter(f.read())
    rnd = random.Random(12)
    for _ in range(60):
        text = " ".join("".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 12))) for _ in range(20))
        assert small.count(text) == length(library, text)
    assert len(small.transducer.known) <= 50 and len(small.transducer.open) <= 80 + 40


def test_documents(documents, odd_documents, library):
    for df, chunk in ((documents, C.CHUNK), (documents, 500), (odd_documents, C.CHUNK), (odd_documents, 3000)):
        want = sorted((str(r.doc_id), len((r.text or "").encode()), length(library, r.text or "")) for r in df.collect())
        got = C.count_tokens(df, PATH, chunk=chunk).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert C.count_tokens(documents.limit(0), PATH).count() == 0


def test_other_kinds_are_refused(spark):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        C.Counter(f.read())
