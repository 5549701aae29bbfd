"""Token counts by a tokenizer compiled to a finite-state transducer.

A BPE word has exactly one segmentation in which each token, and each pair of neighbours,
is what the merge rules make of its own characters. So the last token of every prefix
follows from those of shorter prefixes, and reading a word is a deterministic machine: its
state holds, for every open position (one from where some token could still go on), the
place in the vocabulary trie, the token that ended there, and the tokens so far less those
of the whole prefix. Its transitions carry how the count changes. States and transitions are made when first
met and kept in bounded tables. After a blank the state is the initial one.

A chunk of text is thus a map from entry state to exit state and count: whatever the entry
state, it is known after the first blank. The map is (text up to there, count, text of the
open word at the end), or the text itself without a blank. Maps compose associatively, so a
long text's chunks are counted in parallel and composed by a scan; texts of one chunk
need no shuffle.

Null texts count as empty; rows are independent, repeated or not; empty tables give empty
results; only key and text are read. Characters that this Python's Unicode tables do not know
are left to the tokenizer library itself.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

LIMIT, CHUNK = 2048, 1 << 15
_MOST_WORDS, _MOST_STATES = 200_000, 100_000
_BLANK = re.compile(r"[ \t\n\r]")
_MAP = "struct<open:boolean,head:string,tokens:bigint,tail:string>"


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, by their rule:
    printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class Transducer:
    """Counts the tokens of single words; symbols are bytes, plus 256 at the word's end."""

    def __init__(self, vocabulary: dict[str, int], merges: Sequence[Sequence[str]], suffix: str):
        byte = _byte_symbols()

        def symbols(token: str) -> tuple[int, ...]:
            ended = token.endswith(suffix) and len(token) > len(suffix)
            out = [byte[c] for c in (token[: -len(suffix)] if ended else token)]
            return (*out[:-1], out[-1] + 256) if ended else tuple(out)

        self.rank = {(a, b): n for n, (a, b) in enumerate(merges)}
        self.single = {}
        for char, value in byte.items():
            self.single[value], self.single[value + 256] = char, char + suffix
        self.made = {pair: pair[0] + pair[1] for pair in self.rank}
        self.spelled = {t: symbols(t) for t in {*self.made.values(), *self.single.values()} if t in vocabulary}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[str | None] = [None]
        for token, spelling in self.spelled.items():
            node = 0
            for s in spelling:
                if s not in self.children[node]:
                    self.children[node][s] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][s]
            self.token[node] = token
        self.fits = functools.lru_cache(1 << 18)(self._fits)
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.open: list[tuple] = []
        self.next: list[dict[int, tuple[int, int]]] = []
        self.known: dict[str, int] = {}
        self.state_of(((0, None, 0),))

    def state_of(self, key: tuple) -> int:
        if key not in self.states:
            self.states[key] = len(self.open)
            self.open.append(key)
            self.next.append({})
        return self.states[key]

    def merged(self, spelling: Sequence[int]) -> list[str]:
        parts = [self.single[s] for s in spelling]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            if (least := min(ranks)) == 1 << 60:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [self.made[parts[at], parts[at + 1]]]
        return parts

    def _fits(self, before: str | None, token: str) -> bool:
        """Whether ``token`` can follow ``before`` (none: begin a word)."""
        if before is None:
            return self.merged(self.spelled[token]) == [token]
        return self.fits(None, token) and self.merged(self.spelled[before] + self.spelled[token]) == [before, token]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """The next state, and how the count of the prefix's tokens changes."""
        if symbol in self.next[state]:
            return self.next[state][symbol]
        alive, found = [], None
        for node, last, count in self.open[state]:
            after = self.children[node].get(symbol)
            if after is None:
                continue
            token = self.token[after]
            if found is None and token is not None and self.fits(last, token):
                found = token, count + 1
            if self.children[after]:
                alive.append((after, last, count))
        token, count = found
        key = tuple((node, last, n - count) for node, last, n in alive) + ((0, token, 0),)
        self.next[state][symbol] = out = self.state_of(key), count
        return out

    def word(self, word: str) -> int:
        if (known := self.known.get(word)) is not None:
            return known
        if len(self.known) >= _MOST_WORDS or len(self.open) >= _MOST_STATES:
            self.reset()
        data = word.encode("utf-8")
        state = total = 0
        for symbol in data[:-1]:
            state, change = self.step(state, symbol)
            total += change
        total += self.step(state, data[-1] + 256)[1]
        if len(word) <= 64:  # longer ones are rarely met again
            self.known[word] = total
        return total


class Counter:
    """Counts of whole texts: special strings, normalisation, words, transducer."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix")
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if model["type"] != "BPE" or not suffix or kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in splits] != ["Split", "ByteLevel"]:
            raise ValueError("only BPE with word ends, lower case and one split pattern can be compiled")
        self.content = content
        self.transducer = Transducer(model["vocab"], model["merges"], suffix)
        self.words = regex.compile(splits[0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.hints = {s[:2] for s in special}
        self.assigned: dict[str, bool] = {}

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.content)

    def strange(self, text: str) -> bool:
        known = self.assigned
        for c in set(text):
            if c not in known:
                known[c] = unicodedata.category(c) != "Cn"
            if not known[c]:
                return True
        return False

    def plain(self, text: str) -> int:
        """Of text without special strings."""
        if not text:
            return 0
        if text.isascii():
            words = self.words.findall(text.lower())
        elif self.strange(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        else:
            # the rules lower each letter by itself, without the final form of sigma
            words = self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        known, total = self.transducer.known.get, 0
        for word in words:
            n = known(word)
            if n is None:
                n = self.transducer.word(word)
                known = self.transducer.known.get  # a full table is replaced
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special is None or not any(h in text for h in self.hints):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))

    def map(self, text: str) -> dict:
        """The state map of a chunk."""
        first = _BLANK.search(text)
        if not first:
            return {"open": True, "head": text, "tokens": 0, "tail": ""}
        last = max(text.rfind(c) for c in " \t\n\r") + 1
        body = text[first.end() : last]
        return {"open": False, "head": text[: first.end()], "tokens": self.count(body), "tail": text[last:]}

    def compose(self, a: dict, b: dict) -> dict:
        """Associative: the map of two chunks in a row."""
        if a["open"] and b["open"]:
            return a | {"head": a["head"] + b["head"]}
        if a["open"]:
            return b | {"head": a["head"] + b["head"]}
        if b["open"]:
            return a | {"tail": a["tail"] + b["head"]}
        tokens = a["tokens"] + self.count(a["tail"] + b["head"]) + b["tokens"]
        return {"open": False, "head": a["head"], "tokens": tokens, "tail": b["tail"]}

    def scan(self, maps: list[dict]) -> int:
        """Compose neighbours, level by level, and run the result from the initial state."""
        while len(maps) > 1:
            pairs = [self.compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
            maps = pairs + maps[len(maps) // 2 * 2 :]
        if not maps:
            return 0
        return self.count(maps[0]["head"]) + maps[0]["tokens"] + self.count(maps[0]["tail"])


@functools.lru_cache(2)
def compiled(content: str) -> Counter:
    """Once in each Python worker."""
    return Counter(content)


def count_tokens(
    df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT, chunk: int = CHUNK
) -> DataFrame:
    """One row per input row: key, n_bytes, n_tokens, over_limit. ``tokenizer`` is a path
    that the driver can read; the file's content is sent to the executors."""
    with open(tokenizer, encoding="utf-8") as file:
        sent = df.sparkSession.sparkContext.broadcast(file.read())
    map_type = to_arrow_type(T.DataType.fromDDL(_MAP))

    def whole(texts: pa.Array) -> pa.Array:
        counter = compiled(sent.value)
        return pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())

    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([[t[i : i + chunk] for i in range(0, len(t), chunk)] for t in texts.to_pylist()], pa.list_(pa.string()))

    def mapped(chunks: pa.Array) -> pa.Array:
        counter = compiled(sent.value)
        return pa.array([counter.map(c) for c in chunks.to_pylist()], map_type)

    def scanned(maps: pa.Array) -> pa.Array:
        counter = compiled(sent.value)
        return pa.array([counter.scan(m) for m in maps.to_pylist()], pa.int64())

    def arrow(function, kind: str):
        return F.arrow_udf(function, kind).asNondeterministic()

    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(key).alias("id"), body.alias("text"), F.octet_length(body).cast("bigint").alias("n_bytes"))
    short = rows.where(F.length("text") <= chunk).select("id", "n_bytes", arrow(whole, "bigint")("text").alias("n_tokens"))
    long = rows.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    pieces = long.select("row", "id", "n_bytes", F.posexplode(arrow(cut, "array<string>")("text")).alias("no", "chunk"))
    pieces = pieces.repartition("row", "no")
    maps = pieces.select("row", "id", "n_bytes", "no", arrow(mapped, _MAP)("chunk").alias("map"))
    chains = maps.groupBy("row", "id", "n_bytes").agg(F.array_sort(F.collect_list(F.struct("no", "map"))).alias("maps"))
    scan = arrow(scanned, "bigint")(F.col("maps.map"))
    counted = short.unionByName(chains.select("id", "n_bytes", scan.alias("n_tokens")))
    return counted.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
