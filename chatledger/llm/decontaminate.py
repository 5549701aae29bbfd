"""Benchmark decontamination by q-gram counting in diagonal bands.

Texts are lower-cased and each run of blanks counts as one. The passages of a benchmark
item are its stretches of ``PASSAGE`` characters, one from every ``STRIDE`` = 1 character
(a shorter item is one passage); a document holds a passage if a stretch of it is within
``m // EDIT_EVERY`` edits of the passage's m characters. By the q-gram lemma such a stretch
shares at least m - Q + 1 - Q * edits character q-grams with the passage, and all of them
lie on diagonals (position in the document less position in the item) at most ``edits``
from the first. So:

1. positions whose q-gram is in the benchmark are marked by one bitmap probe each, and
   only stretches with enough marks in a row of m + edits characters go on;
2. there, shared q-grams are collected per item in bands of diagonals that overlap by
   half, so that every range of 2 * edits + 1 diagonals lies whole in some band, and a
   passage goes on if enough of a band's q-grams begin in it;
3. of each ``CORE_OF`` neighbouring passages, what all of them share is aligned first: if
   that needs more edits than a passage may have, none of them is held. The passages of
   the others are verified by banded alignment one by one.

An item is indexed in pieces of at most ``PIECE`` passages, one entry for each character.

The bitmap and the count only rule out; nothing that qualifies is lost. Documents are never
shuffled: the benchmark's index is broadcast, in blocks of at most ``BLOCK_CHARS``
characters, one pass over the documents each. Long texts are searched in windows.

An item of fewer than ``LEAST`` characters, for which the lemma promises no shared q-gram, must
occur whole and without edits, not as a part of longer words; all such items are looked up in one
pass by an automaton. So a very short item (``yes``) is found in every text that says it: leave it
out of the benchmark if that isn't wanted. The span is its first occurrence.

Null and empty texts hold nothing; benchmark rows that are null, empty or blank identify
nothing and never match; repeated document or benchmark rows each get their own result
rows; empty tables give empty results. Only key and text columns are read, so other names
cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import per_text

PASSAGE, STRIDE, EDIT_EVERY, Q, LEAST = 60, 1, 12, 8, 24
PIECE, CORE_OF = 4096, 8
BLOCK_CHARS = 2_000_000
_BITS = 20
_WINDOW = 1 << 16
#: Bands aligned together; what no text contains.
_ALIGNED, _OUTSIDE = 4096, 0xFFFFFFFF
#: More than a band can stand out of a text.
_MARGIN = 512
_FACTOR = 0x9E3779B97F4A7C15
_POWERS = [pow(_FACTOR, n, 1 << 64) for n in (1, 2, 4)]
_BLANKS = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029, 0x3000], dtype=np.uint32)
_BLANK = np.zeros(0x3001, dtype=bool)
_BLANK[_BLANKS] = True


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased text with runs of blanks as one, and where in the
    text each stands."""
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow in lower case: keep their first character
        lower = "".join(c.lower()[0] for c in text)
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    blank = _BLANK[np.minimum(codes, 0x3000)] & (codes <= 0x3000)
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    if len(keep):
        keep[0] = True
    at = np.flatnonzero(keep)
    return np.where(blank, np.uint32(32), codes)[at], at


def _string(codes: np.ndarray) -> str:
    return codes.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")


def _in_word(text: str, at: int) -> bool:
    """Whether a word goes on over the place before character ``at``."""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


def _hashes(codes: np.ndarray) -> np.ndarray:
    """A rolling hash of each Q (8) characters, by doubling."""
    h = codes.astype(np.uint64)
    for step, power in zip((1, 2, 4), _POWERS):
        if len(h) <= step:
            return np.zeros(0, dtype=np.uint64)
        h = h[:-step] * np.uint64(power) + h[step:]
    return h * np.uint64(0xBF58476D1CE4E5B9)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _BITS)).astype(np.int64)


def edits_allowed(m: int) -> int:
    return m // EDIT_EVERY


def shared_needed(m: int) -> int:
    return m - Q + 1 - Q * edits_allowed(m)


def aligned(patterns: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Banded alignment of many pairs at once. Pattern k may start at any of the first
    ``width`` places of window k, which has ``width + m`` characters; its alignment stays on
    those diagonals. Returns the least edits and where in the window that stretch ends."""
    pairs, m = patterns.shape
    width = windows.shape[1] - m
    steps = np.arange(width, dtype=np.int16)
    row = np.zeros((pairs, width), dtype=np.int16)
    drop = np.empty_like(row)
    for i in range(m):
        drop[:, :-1], drop[:, -1] = row[:, 1:], m
        drop += 1
        row += windows[:, i : i + width] != patterns[:, i : i + 1]
        np.minimum(row, drop, out=row)
        row -= steps
        np.minimum.accumulate(row, axis=1, out=row)
        row += steps
    best = row.argmin(axis=1)
    return row[np.arange(pairs), best], best + m


def _cuts(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """``size`` characters from each of the starts."""
    return codes[starts[:, None] + np.arange(size)]


class Index:
    """Passages of some benchmark rows and where their q-grams are."""

    def __init__(self, items: list[tuple]):
        pieces, owners, hashes, entries, sizes, starts = [], [], [], [], [], []
        short = defaultdict(list)
        for item, text in items:
            codes, _ = normalised((text or "").strip())
            if len(codes) < LEAST:
                if len(codes):
                    short[_string(codes)].append(item)
                continue
            m = min(PASSAGE, len(codes))
            for low in range(0, len(codes) - m + 1, PIECE):
                part = codes[low : low + PIECE + m - 1]
                grams = _hashes(part)
                hashes.append(grams)
                entries.append(np.stack([np.full(len(grams), len(pieces)), np.arange(len(grams))], axis=1))
                pieces.append(part)
                owners.append(item)
                sizes.append(m)
                starts.append(len(part) - m + 1)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.entries = np.concatenate(entries)[order] if entries else np.zeros((0, 2), dtype=np.int64)
        #: of each piece: whose it is, the size of its passages, how many, the number of the first
        self.owners = owners
        self.sizes = np.array(sizes, dtype=np.int64)
        self.starts = np.array(starts, dtype=np.int64)
        self.numbers = np.cumsum(self.starts) - self.starts
        self.codes = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
        self.places = np.cumsum([0, *map(len, pieces)])[:-1]
        self.grams, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.bitmap = np.zeros(1 << _BITS, dtype=bool)
        self.bitmap[_slot(self.grams)] = True
        self.needed = shared_needed(self.sizes)
        self.edits = edits_allowed(self.sizes)
        # for whole passages and for shorter ones: the longest row of q-grams, the least shared
        self.tests = []
        for some in (self.sizes == PASSAGE, self.sizes < PASSAGE):
            if some.any():
                self.tests.append((int((self.sizes + self.edits)[some].max()) - Q + 1, int(self.needed[some].min())))
        self.reach = PASSAGE + PASSAGE // EDIT_EVERY + Q
        #: whole items that are too short for passages
        self.short = ahocorasick.Automaton() if short else None
        for words, whose in short.items():
            self.short.add_word(words, (len(words), whose))
        if short:
            self.short.make_automaton()

    def stretches(self, marked: np.ndarray) -> np.ndarray:
        """Marked positions in some row that has enough of them."""
        chosen = np.zeros(len(marked), dtype=bool)
        sums = np.r_[0, np.cumsum(marked)]
        for width, least in self.tests:
            width = min(width, len(marked))
            enough = sums[width:] - sums[:-width] >= least
            edge = np.zeros(len(marked) + 1, dtype=np.int64)
            edge[: len(enough)] += enough
            edge[width:] -= enough[: len(marked) + 1 - width]
            chosen |= np.cumsum(edge[:-1]) > 0
        return np.flatnonzero(chosen & marked)

    def find(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text, and each benchmark row that it holds a passage of: where, the
        least edits, and how many passages."""
        out: list[list[dict]] = [[] for _ in texts]
        waiting, size = [], 0
        for number, text in enumerate(texts):
            if not text:
                continue
            codes, at = normalised(text)
            if self.short is not None:
                out[number] += self._whole(_string(codes), at)
            if not len(self.grams):
                continue
            found = [
                self._window(codes, low, min(len(codes), low + _WINDOW + 2 * self.reach))
                for low in range(0, max(1, len(codes) - self.reach), _WINDOW)
            ]
            keys = np.unique(np.concatenate([f[:, 0] << 32 | f[:, 1] + _MARGIN for f in found]))
            chosen = np.stack([keys >> 32, (keys & 0xFFFFFFFF) - _MARGIN], axis=1)
            if len(chosen):
                waiting.append((number, codes, at, chosen))
                size += len(chosen) + len(codes) // 100
            if size > _ALIGNED:
                self._verify(waiting, out)
                waiting, size = [], 0
        self._verify(waiting, out)
        return out

    def _whole(self, text: str, at: np.ndarray) -> list[dict]:
        """The short items in a normalised text, each where it occurs first."""
        first: dict[int, tuple[list, int, int]] = {}
        for last, (size, whose) in self.short.iter(text):
            begin, end = last - size + 1, last + 1
            if id(whose) not in first and not _in_word(text, begin) and not _in_word(text, end):
                first[id(whose)] = whose, begin, end
        return [
            {"item": item, "start": int(at[begin]), "end": int(at[end - 1]) + 1, "edits": 0, "passages": 1}
            for whose, begin, end in first.values()
            for item in whose
        ]

    def _window(self, codes: np.ndarray, low: int, high: int) -> np.ndarray:
        """(passage, first diagonal) of the bands with enough shared q-grams."""
        none = np.zeros((0, 2), dtype=np.int64)
        hashes = _hashes(codes[low:high])
        if not len(hashes):
            return none
        positions = self.stretches(self.bitmap[_slot(hashes)])
        if not len(positions):
            return none
        rank = np.searchsorted(self.grams, hashes[positions])
        known = self.grams[np.minimum(rank, len(self.grams) - 1)] == hashes[positions]
        positions, rank = positions[known], rank[known]
        sizes = self.first[rank + 1] - self.first[rank]
        # a bounded number of shared q-grams at once
        bands = [self._bands(positions[lo:hi], rank[lo:hi], sizes[lo:hi], low) for lo, hi in _batches(sizes)]
        return np.concatenate([none, *bands])

    def _bands(self, positions: np.ndarray, rank: np.ndarray, sizes: np.ndarray, low: int) -> np.ndarray:
        total = int(sizes.sum())
        offset = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        piece, inner = self.entries[np.repeat(self.first[rank], sizes) + offset].T
        longest = PIECE + PASSAGE
        diagonal = np.repeat(positions, sizes) - inner + longest  # never negative
        band = diagonal // (2 * self.edits[piece] + 1)
        # band b: diagonals of b-1 and b
        keys = np.concatenate([piece << 36 | band + 1 << 14 | inner, piece << 36 | band << 14 | inner])
        keys.sort()
        group, inner = keys >> 14, keys & 0x3FFF
        piece = group >> 22
        # from each q-gram to the one that makes enough: the passages that hold both
        until = np.arange(len(keys)) + self.needed[piece] - 1
        fits = until < len(keys)
        until = np.minimum(until, len(keys) - 1)
        begin = np.maximum(inner[until] - (self.sizes[piece] - Q), 0)
        end = np.minimum(inner, self.starts[piece] - 1) + 1
        some = np.flatnonzero(fits & (group[until] == group) & (begin < end))
        group, begin, end = group[some], begin[some], end[some]
        again = np.flatnonzero(group[1:] == group[:-1]) + 1
        begin[again] = np.maximum(begin[again], end[again - 1])  # ends never fall within a band
        count = np.maximum(end - begin, 0)
        start = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - begin, count)
        piece, band = np.repeat(group >> 22, count), np.repeat(group & 0x3FFFFF, count)
        edits = self.edits[piece]
        return np.stack([self.numbers[piece] + start, low - longest + (band - 1) * (2 * edits + 1) - edits + start], axis=1)

    def _aligned(self, codes: np.ndarray, place: np.ndarray, m: int, first: np.ndarray, edits: int):
        """Alignment of the m characters of the benchmark at each place with a band of the
        codes: the least edits, and where that stretch ends."""
        width = 2 * (2 * edits + 1) + 2 * edits
        cost, ends = aligned(_cuts(self.codes, place, m), _cuts(codes, first, width + m))
        return cost, ends + first

    def _cored(self, codes: np.ndarray, place: np.ndarray, lead: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Which of the whole passages stay when neighbours, on the same diagonals, are
        tested by what they share; ``lead`` is how far each is from the first of them."""
        keys, which = np.unique((place - lead) << 32 | first - lead, return_inverse=True)
        fine = np.zeros(len(keys), dtype=bool)
        m, shift = PASSAGE - CORE_OF + 1, CORE_OF - 1
        for low in range(0, len(keys), _ALIGNED):
            some = keys[low : low + _ALIGNED]
            cost, _ = self._aligned(codes, (some >> 32) + shift, m, (some & 0xFFFFFFFF) + shift, edits_allowed(PASSAGE))
            fine[low : low + _ALIGNED] = cost <= edits_allowed(PASSAGE)
        return fine[which]

    def _verify(self, waiting: list[tuple], out: list[list[dict]]) -> None:
        """Align the chosen bands of some texts, those of one passage length together."""
        if not waiting:
            return
        # the texts in one, with margins that equal nothing
        margin = np.full(_MARGIN, _OUTSIDE, dtype=np.uint32)
        codes = np.concatenate([margin, *(c for w in waiting for c in (w[1], margin))])
        bases = np.cumsum([_MARGIN] + [len(w[1]) + _MARGIN for w in waiting])[:-1]
        text = np.repeat(np.arange(len(waiting)), [len(w[3]) for w in waiting])
        passage, first = np.concatenate([w[3] for w in waiting]).T
        first = first + bases[text]
        piece = np.searchsorted(self.numbers, passage, "right") - 1
        start = passage - self.numbers[piece]
        place = self.places[piece] + start
        sizes = self.sizes[piece]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for m in np.unique(sizes).tolist():
            e = edits_allowed(m)
            rows = np.flatnonzero(sizes == m)
            if m == PASSAGE:
                rows = rows[self._cored(codes, place[rows], start[rows] % CORE_OF, first[rows])]
            for low in range(0, len(rows), _ALIGNED):
                some = rows[low : low + _ALIGNED]
                cost, ends = self._aligned(codes, place[some], m, first[some], e)
                fine = np.flatnonzero(cost <= e)
                if not len(fine):
                    continue
                # from the end backwards, for the start
                some, cost, ends = some[fine], cost[fine], ends[fine]
                back = _cuts(codes, ends - e - m - 1, 2 * e + 1 + m)[:, ::-1]
                _, lengths = aligned(_cuts(self.codes, place[some], m)[:, ::-1], back)
                begins, ends = ends + e - lengths - bases[text[some]], ends - bases[text[some]]
                for t, p, c, begin, end in zip(*(x.tolist() for x in (text[some], passage[some], cost, begins, ends))):
                    begin, end = max(0, begin), min(len(waiting[t][1]), end)
                    best[t, p] = min(best.get((t, p), (m, 0, 0)), (c, min(begin, end - 1), end))
        found: dict[tuple[int, int], list] = defaultdict(list)
        for (t, p), hit in sorted(best.items()):
            item = self.owners[int(np.searchsorted(self.numbers, p, "right")) - 1]
            found[t, id(item)].append((item, *hit))
        for (t, _), hits in found.items():
            number, _, at, _ = waiting[t]
            out[number].append(
                {
                    "item": hits[0][0],
                    "start": int(at[min(h[2] for h in hits)]),
                    "end": int(at[max(h[3] for h in hits) - 1]) + 1,
                    "edits": min(h[1] for h in hits),
                    "passages": len(hits),
                }
            )


def _batches(sizes: np.ndarray, most: int = 1 << 20, overlap: int = 2 * (PASSAGE + Q)) -> list[tuple[int, int]]:
    """Ranges of positions with about ``most`` entries, overlapping by a passage and more."""
    sums = np.cumsum(sizes)
    out, low = [], 0
    while low < len(sizes):
        base = sums[low - 1] if low else 0
        high = max(int(np.searchsorted(sums, base + most, "right")), low + 2 * overlap)
        out.append((low, min(high, len(sizes))))
        if high >= len(sizes):
            break
        low = high - overlap
    return out or [(0, 0)]


def _indexes(benchmark: DataFrame, item: str, text: str):
    """One index for each block of the benchmark; a block's size is bounded."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = math.ceil(chars / BLOCK_CHARS)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("text", "item"), F.lit(blocks)) == block).toArrow().sort_by("item")
        # a list makes each benchmark row an object of its own, also where ids repeat
        yield Index([([i], t) for i, t in zip(part["item"].to_pylist(), part["text"].to_pylist())])


def _hits(df: DataFrame, index: Index, text: str, kind: str):
    sent = df.sparkSession.sparkContext.broadcast(index)

    def run(texts: list) -> list:
        return [[h | {"item": h["item"][0]} for h in hits] for hits in sent.value.find(texts)]

    ddl = f"array<struct<item:{kind},start:bigint,end:bigint,edits:int,passages:int>>"
    return per_text(run, ddl)(F.col(text))


def contaminated(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each document row and benchmark row it holds a passage of: key, item,
    span in the document (code points), least edits, number of passages."""
    kind = benchmark.schema[item].dataType.simpleString()
    names = F.col("id").alias(key), *(F.col(f"hit.{a}").alias(b) for a, b in (
        ("item", item), ("start", "start"), ("end", "end"), ("edits", "edits"), ("passages", "passages")))
    parts = []
    for index in _indexes(benchmark, item, item_text):
        rows = df.select(F.col(key).alias("id"), _hits(df, index, text, kind).alias("hits"))
        parts.append(rows.select("id", F.explode("hits").alias("hit")).select(*names))
    if not parts:
        none = F.array().cast(f"array<struct<item:{kind},start:bigint,end:bigint,edits:int,passages:int>>")
        return df.select(F.col(key).alias("id"), F.explode(none).alias("hit")).select(*names)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def keep_clean(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The rows of ``df`` that hold no passage of the benchmark."""
    kind, rows = benchmark.schema[item].dataType.simpleString(), df
    for index in _indexes(benchmark, item, item_text):
        rows = rows.withColumn("__hits", _hits(df, index, text, kind)).where(F.size("__hits") == 0).drop("__hits")
    return rows
