"""Secret scan with a recursive decoding worklist.

The text is the first layer. Each layer is scanned; then every decoder (URL escapes,
Unicode escapes and entities, base64, compressed data) makes new layers from it, until no
new layer appears. Escapes are decoded one by one: what is no character stays as it
stands, and bytes that are no UTF-8 become Latin-1. A base64 run is decoded at all four
alignments, so what stands before a token (a path, ``key_``) does not hide it, and what it
decodes to is judged by content: any hit needs ``LEAST`` readable ASCII characters in a
row, of 8 or of 16 bits. Lines of base64 are joined. Compressed data is known by its first
bytes, wherever they are in the bytes of a layer, and all its members are read. A layer knows
for each of its characters the span of the original text it came from, so hits are reported
where they stand in the document; what is unpacked has one span. A layer with a content and span seen
before is not opened again, which ends cycles such as an archive that unpacks to itself.

Unpacked content is scanned in windows of ``WINDOW`` bytes, so that its size does not matter to
memory. A window ends after a byte that is part of no hit and no encoded run, and not within
compressed data that goes on. Where none comes for ``MOST`` bytes, the run is cut, with an overlap for
its hits, and counted in ``n_unread``, as is compressed data that ends early.

Row-local: no shuffle, and a task holds one Arrow batch. Nulls count as empty texts, rows
are independent (ties and repeated rows give equal results), an empty table gives an
empty one, and only the key and the text column are read, so other names cannot clash.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatledger.llm.common import per_text

KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}"
    r"|&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};)+"
)
_UNICODE_ONE = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})"
    r"|&\#([0-9]{1,7});|&\#[xX]([0-9A-Fa-f]{1,6});"
)
#: A run, or lines that begin and end with one; the whole lines between hold nothing else.
_LINE = r"[ \t]*[\r\n][ \t\r\n]*[A-Za-z0-9+/_-]+"
_BASE64 = re.compile(
    rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{4,}}+(?:{_LINE})+={{0,2}}|[A-Za-z0-9+/_-]{{16,}}={{0,2}}"
)
_GAPS = str.maketrans("", "", " \t\r\n")
_STANDARD = str.maketrans("-_", "+/")

#: No hit is shorter (``token=`` and six characters), and every encoding makes it longer.
LEAST, LEAST_BASE64 = 12, 16
_NARROW = re.compile(rb"[\t-\r\x20-\x7e]{%d,}" % LEAST)
_WIDE = re.compile(rb"[\t-\r\x20-\x7e](?:\0[\t-\r\x20-\x7e]){%d,}" % (LEAST - 1))  # UTF-16, either order
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\0|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
_MAGIC_TEXT = re.compile(_MAGIC.pattern.decode("latin-1"))
_HIGH = re.compile("%(?:1[fF]%8[bB]|42%5[aA]|[fF][dD]%37|28%[bB]5|78%)")  # the same, escaped
_BREAK = re.compile(rb"[^A-Za-z0-9+/_.=%&#;{}:'\"\\\s-]")
#: Unpacked bytes that are scanned at a time, of which a run without end may make the most.
WINDOW, MOST, OVERLAP = 4 << 20, 24 << 20, 1 << 16


def scan(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain patterns, leftmost and without overlap in a kind."""
    found = []
    lower = text.lower()
    if any(hint in lower for hint in _ASSIGN_HINTS):
        found += [(0, *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(2, *m.span()) for m in _HEX.finditer(text)]
    return found


class _Layer:
    """A text and the original span of each of its characters, or one span for all."""

    def __init__(self, text: str, starts: np.ndarray | int, ends: np.ndarray | int):
        self.text, self.starts, self.ends = text, starts, ends
        self.fixed = isinstance(starts, int)

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.fixed:
            return self.starts, self.ends
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())


def _rewritten(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """The whole layer with each run in its decoded form, so that a secret of plain and
    escaped parts is seen as one. What cannot be decoded stays as it is."""
    text, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        got = decode(m.group())
        text += [layer.text[at : m.start()], got[0]]
        if not layer.fixed:
            low = np.fromiter((a for a, _ in got[1]), np.int64) + m.start()
            high = np.fromiter((b for _, b in got[1]), np.int64) + m.start()
            wide = high - low > 1
            first, last = layer.starts[low], layer.ends[high - 1]
            for i in np.flatnonzero(wide):
                first[i], last[i] = layer.span(low[i], high[i])
            starts += [layer.starts[at : m.start()], first]
            ends += [layer.ends[at : m.start()], last]
        at = m.end()
    if not at:
        return None
    text.append(layer.text[at:])
    if layer.fixed:
        return _Layer("".join(text), layer.starts, layer.ends)
    return _Layer("".join(text), np.concatenate([*starts, layer.starts[at:]]), np.concatenate([*ends, layer.ends[at:]]))


def _url(run: str):
    """UTF-8 where it is, other bytes as Latin-1."""
    text = bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape")
    spans, at = [], 0
    for c in text:
        width = 3 * (1 if "\udc80" <= c <= "\udcff" else len(c.encode("utf-8")))
        spans.append((at, at + width))
        at += width
    return "".join(chr(ord(c) - 0xDC00) if "\udc80" <= c <= "\udcff" else c for c in text), spans


def _url_bytes(run: str):
    """Each byte as one character, for what is no text."""
    data = bytes.fromhex(run.replace("%", ""))
    return data.decode("latin-1"), [(i, i + 3) for i in range(0, 3 * len(data), 3)]


def _unicode(run: str):
    text, spans = [], []
    for m in _UNICODE_ONE.finditer(run):
        code = int(m[5]) if m[5] else int(m[1] or m[2] or m[3] or m[4] or m[6], 16)
        if code > 0x10FFFF:  # no character
            text += m.group()
            spans += [(i, i + 1) for i in range(*m.span())]
        elif text and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(text[-1]) < 0xDC00:
            text[-1] = chr(0x10000 + ((ord(text[-1]) - 0xD800) << 10) + code - 0xDC00)
            spans[-1] = (spans[-1][0], m.end())
        else:
            spans.append(m.span())
            text.append(chr(code))
    return "".join("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c for c in text), spans


class _Unpacked:
    """The content of the compressed data at a place, of all members that follow each other, in
    pieces of at most ``WINDOW`` bytes. Read to the end, ``used`` is how many bytes it took,
    ``whole`` whether the last member ended, and ``sure`` whether the end of it is known."""

    def __init__(self, data: bytes):
        self.data, self.used, self.whole, self.sure = data, 0, True, True

    def __iter__(self) -> Iterator[bytes]:
        while self.whole:
            yield from self._member(self.data[self.used :])
            if not self.took or not self.sure:
                self.used += self.took
                break
            self.used += self.took
            # between members: the zeros that pad xz and gzip files
            while self.whole and self.data[self.used : self.used + 1] == b"\0":
                self.used += 1

    def _member(self, data: bytes) -> Iterator[bytes]:
        """One member; ``took`` stays 0 if the data is none."""
        self.took, some, ended, broken, tool = 0, b"", False, False, None
        try:
            if data[:2] == b"\x1f\x8b" or data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0:
                tool, left = zlib.decompressobj(31 if data[:1] == b"\x1f" else 15), data
                while not tool.eof and (out := tool.decompress(left, WINDOW)):
                    left, some = tool.unconsumed_tail, some or out
                    yield out
            elif data[:3] == b"BZh" or data[:6] == b"\xfd7zXZ\0":
                tool, left = bz2.BZ2Decompressor() if data[:1] == b"B" else lzma.LZMADecompressor(), data
                while not tool.eof and (out := tool.decompress(left, WINDOW)):
                    left, some = b"", some or out
                    yield out
            elif data[:4] == b"\x28\xb5\x2f\xfd":
                import zstandard

                tool, at = zstandard.ZstdDecompressor().decompressobj(), 0
                while not tool.eof and at < len(data):
                    out = tool.decompress(data[at : at + 256])  # little in, as it has no limit of what comes out
                    at, some = at + 256, some or out
                    if out:
                        yield out
                if tool.eof:
                    self.took, ended = len(data) - max(len(data) - at, 0) - len(tool.unused_data), True
                tool = None if ended else tool
            ended = ended or tool is not None and tool.eof
            if tool is not None and ended:
                self.took = len(data) - len(tool.unused_data)
        except (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, MemoryError):
            broken = True
        except Exception as error:  # zstandard has its own error class
            if type(error).__name__ != "ZstdError":
                raise
            broken = True
        # a stream that ends early: the two bytes of zlib also occur by chance, so it must speak
        if tool is not None and not ended and (some or not broken):
            self.took, self.sure = len(data), False
            self.whole = data[:1] == b"\x78" and not _NARROW.search(some) and not _WIDE.search(some)


class _Worklist:
    def __init__(self, text: str):
        positions = np.arange(len(text), dtype=np.int64)
        self.layers, self.unread = 0, 0
        self.seen: set[tuple] = set()
        self.todo: deque[_Layer] = deque()
        self.found: set[tuple[int, int, int]] = set()
        self.add(_Layer(text, positions, positions + 1))

    def new(self, layer: _Layer) -> bool:
        """Whether this text was not yet met at this place."""
        digest = hashlib.blake2b(layer.text.encode("utf-8", "replace"), digest_size=16).digest()
        key = (digest, *layer.span(0, len(layer.text))) if layer.text else None
        if key is None or key in self.seen:
            return False
        self.seen.add(key)
        return True

    def add(self, layer: _Layer) -> None:
        if self.new(layer):
            self.todo.append(layer)

    def run(self, base: list[tuple[int, int, int]]) -> set[tuple[int, int, int]]:
        """All hits, given those of the first layer."""
        self.found = {(a, b, kind) for kind, a, b in base}
        while self.todo:
            self.visit(self.todo.popleft())
        return self.found

    def visit(self, layer: _Layer) -> None:
        self.layers += 1
        if self.layers > 1:
            self.found |= {(*layer.span(a, b), kind) for kind, a, b in scan(layer.text)}
        if "%" in layer.text and (made := _rewritten(layer, _URL, _url)):
            self.add(made)
            if _HIGH.search(layer.text):
                self.packed(_rewritten(layer, _URL, _url_bytes))
        if ("\\" in layer.text or "&#" in layer.text) and (made := _rewritten(layer, _UNICODE, _unicode)):
            self.add(made)
        self.packed(layer)
        for m in _BASE64.finditer(layer.text):
            self.base64(layer, m)

    def base64(self, layer: _Layer, m: re.Match) -> None:
        body = m.group().translate(_GAPS)
        if len(body) < LEAST_BASE64:
            return
        if not layer.fixed:
            first, last = layer.starts[m.start() : m.end()], layer.ends[m.start() : m.end()]
            if len(body) < len(first):  # lines: the characters that count
                at = np.frombuffer(m.group().encode("ascii"), dtype=np.uint8) > 32
                first, last = first[at], last[at]
        body = body.rstrip("=").translate(_STANDARD)
        for shift in range(4):
            data = _from_base64(body[shift:])
            if not (narrow := _NARROW.search(data)) and not _WIDE.search(data) and not _MAGIC.search(data):
                continue
            # each byte stands for the four characters that it came from
            starts = layer.starts if layer.fixed else _quads(first[shift:], np.minimum, len(data))
            ends = layer.ends if layer.fixed else _quads(last[shift:], np.maximum, len(data))
            made = _Layer(data.decode("latin-1"), starts, ends)
            if narrow:
                self.add(made)  # and its compressed parts with it
            else:
                self.packed(made)
            self.wide(data, starts, ends)

    def wide(self, data: bytes, starts: np.ndarray | int, ends: np.ndarray | int) -> None:
        """The UTF-16 stretches of the data, each a layer."""
        for m in _WIDE.finditer(data):
            at = slice(m.start(), m.end(), 2)
            spans = (starts, ends) if isinstance(starts, int) else (starts[at], ends[at])
            self.add(_Layer(data[at].decode("latin-1"), *spans))

    def packed(self, layer: _Layer) -> None:
        """The content of all compressed data in a layer. It has the span of that data, all
        of it, so it is scanned in windows that need no positions."""
        if not _MAGIC_TEXT.search(layer.text):
            return
        data, at = layer.text.encode("latin-1", "replace"), 0
        while magic := _MAGIC.search(data, at):
            at = magic.start()
            unpacked = _Unpacked(data[at:])
            size = sum(map(len, unpacked))  # first how far it goes: that is its span
            self.unread += not unpacked.whole
            if size:
                self.windows(_Unpacked(data[at:]), layer.span(at, at + unpacked.used))
            at += max(unpacked.used, 1) if unpacked.sure else 1

    def windows(self, pieces: Iterable[bytes], span: tuple[int, int]) -> None:
        held = b""
        for piece in pieces:
            held += piece
            if len(held) >= WINDOW:
                cut = self.end_of_runs(held)
                self.window(held[:cut], span)
                held = held[cut:]
        self.window(held, span)

    def window(self, data: bytes, span: tuple[int, int]) -> None:
        layer = _Layer(data.decode("latin-1"), *span)
        if self.new(layer):
            self.visit(layer)
            self.wide(data, *span)

    def end_of_runs(self, data: bytes) -> int:
        """Where a window can end: after a byte that no hit and no encoded run holds, and not
        within compressed data that goes on. A run beyond ``MOST`` is cut and counted."""
        end = 0
        for m in _BREAK.finditer(data, max(0, len(data) - WINDOW // 2)):
            end = m.end()
        for magic in _MAGIC.finditer(data, 0, end):
            unpacked = _Unpacked(data[magic.start() :])
            for _ in unpacked:
                pass
            if not unpacked.whole:
                end = magic.start()
                break
        if not end and len(data) >= MOST:
            self.unread += 1
            return len(data) - OVERLAP
        return end


def _quads(values: np.ndarray, least: np.ufunc, size: int) -> np.ndarray:
    """The least of each four values, three times over."""
    return np.repeat(least.reduceat(values, np.arange(0, len(values), 4)), 3)[:size]


def _from_base64(body: str) -> bytes:
    """The whole bytes of the characters; the bits left over are none."""
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def find(text: str) -> dict:
    """Everything the query reports of one text."""
    hits = scan(text)
    base = sorted(((a, b, kind) for kind, a, b in hits), key=lambda s: (s[0], s[2], s[1]))
    spans, layers, unread = base, 1, 0
    if "%" in text or "\\" in text or "&#" in text or _BASE64.search(text) or _MAGIC_TEXT.search(text):
        work = _Worklist(text)
        spans = sorted(work.run(hits), key=lambda s: (s[0], s[2], s[1]))
        layers, unread = work.layers, work.unread
    joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in base)
    return {
        **{f"n_{kind}": sum(k == i for _, _, k in base) for i, kind in enumerate(KINDS)},
        "base_sha256": hashlib.sha256(joined.encode()).hexdigest(),
        "spans": ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans),
        "n_layers": layers,
        "n_unread": unread,
    }


_FOUND = (
    "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
    "n_layers bigint, n_unread bigint"
)


def scan_secrets(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key, counts and digest of the plain hits, all spans,
    the number of layers, and of compressed data that ends early and runs that are cut at ``MOST``."""
    run = per_text(lambda texts: [find(t or "") for t in texts], _FOUND)
    rows = df.select(F.col(key).alias("key"), run(F.col(text)).alias("found"))
    return rows.select(F.col("key").alias(key), "found.*")
