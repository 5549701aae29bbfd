"""The trie of all prefixes of conversations, from neighbours in sorted order.

A turn stands as 16 bytes of the SHA-256 of role and text, and its number of code points; a
conversation is the sequence of its turns. In lexicographic order the conversations that share a
prefix are neighbours, and how long a prefix two neighbours share (their LCP) is an edge between
them. Union-find takes the edges in descending depth: a merge of two components creates the
branching node at that depth, or adds a child to it. Between two such nodes the trie is a chain
of nodes with the same members.

No task sees more than a block of ``ROWS`` sequences. A block finishes every node that has
smaller edges on both sides, and contracts the rest, which lies on the paths of its first and
last sequence, to one entry a depth, with the edges between them. Neighbouring blocks'
entries and the edge across their border are input to the same function, until one block is left.
Nodes finished below an unfinished one know it by a name; its smallest member follows later.

A sequence holds at most ``WIDTH`` turns. What follows belongs to the trie of that prefix, named
by a 128-bit running hash, whose root is the node where the piece before it ends. Levels are
built from the deepest up. A prefix that one conversation alone has is a chain and needs no
level, so there are as many levels as the longest shared prefix has pieces, and a long
conversation is spread over rows. Its turns are numbered over range partitions, too.

What a subtree saves needs no walk over it. Each member but the smallest leaves the path of a
smaller one at some merge; the code points up to there, summed over these members, less those
before the node once for each, are the saved ones. Merges add them up.

Null conversation ids take no part. Null turns come first; rows of one turn are ordered by their
hashes, and equal rows are turns of their own. Null roles and texts are empty. A conversation
without turns is a member of the root alone, an empty table has no nodes, not even a root. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chatledger.llm.common import stored

SHARED, HEADS = 100, 6  # conversations that share a head, and the bound of its turns
WIDTH, ROWS, IDS, SALT = 512, 1 << 16, 50_000, 16
_ELEMENT = 20  # bytes: hash, and code points as four bytes
_FAN = 6  # bits: so many neighbours' entries are merged at a time
_BLOCKS = 20  # bits for the blocks of a partition

_ROW = (
    "kind string, s1 bigint, s2 bigint, m bigint, n bigint, below bigint, sums bigint, kids bigint, depth bigint, "
    "base bigint, top bigint, parent bigint, parent_name string, k1 bigint, k2 bigint, names array<string>, "
    "first binary, last binary, base_p bigint, edge bigint, edge_p bigint, block bigint, place int"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
_SCHEMA = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in _ROW.split(", "))])


# turns in order


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation: number and code points so far within this partition."""
    part, conv, at, points = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        convs, n = (batch.column(c).to_numpy() for c in ("conv", "n"))
        first = np.flatnonzero(np.append(True, convs[1:] != convs[:-1]))
        start = np.repeat(first, np.diff(np.append(first, len(convs))))
        total = np.cumsum(n)
        number = np.arange(1, len(convs) + 1) - start
        so_far = total - (total - n)[start]
        if convs[0] == conv:
            number[start == 0] += at
            so_far[start == 0] += points
        conv, at, points = convs[-1], number[-1], so_far[-1]
        columns = [batch.column("conv"), pa.array(np.full(len(convs), part)), pa.array(number), pa.array(so_far)]
        yield pa.record_batch([*columns, batch.column("n"), batch.column("element")], ["conv", "part", "number", "points", "n", "element"])


def rebuilt_turns(df: DataFrame, shared: int = SHARED, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, element, n, points) of every turn of every rebuilt conversation, points
    being the code points up to and with it; and the conversations (conv) without turns."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    spelled = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    n = F.length(text).cast("bigint")
    element = F.unhex(F.concat(F.substring(F.sha2(spelled.cast("binary"), 256), 1, 32), F.lpad(F.hex(n), 8, "0")))
    turns = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", n.alias("n"), element.alias("element"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv", F.asc_nulls_first("turn"), "element", "row"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "n", "element")
    kind = "conv bigint, part bigint, number bigint, points bigint, n bigint, element binary"
    numbered = stored(ordered.mapInArrow(_numbered, kind), "numbered")

    # where each partition's share of a conversation begins
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = numbered.groupBy("conv", "part").agg(F.max("number").alias("turns"), F.max("points").alias("sum"))
    shares = shares.select(
        "conv", "part",
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("points_before"),
    )
    early = numbered.where(F.col("number") <= heads).join(shares, ["conv", "part"])
    early = early.selectExpr("conv", "number + turns_before AS number", "points + points_before AS points", "n", "element")
    first = early.where(F.col("number") <= heads).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("number", "points", "n", "element"))).alias("first")  # one more than a head has
    )
    convs = first.selectExpr(
        "conv", "first", f"crc32(CAST(conv AS string)) % {heads} AS h", f"conv - conv % {shared} AS base"
    )
    bases = first.where(F.col("conv") % shared == 0).selectExpr("conv AS base", "first AS base_first")
    convs = convs.join(bases, "base", "left").selectExpr(
        "conv", "h", "first", "coalesce(slice(base_first, 1, int(h)), array()) AS head"
    )
    convs = convs.selectExpr(
        "conv", "h", "head", "size(first) AS own", "size(head) AS n_head",
        "CASE WHEN size(head) > 0 THEN element_at(head, -1).points ELSE 0 END AS head_points",
        "CASE WHEN h > 0 AND size(first) >= h THEN element_at(first, int(h)).points ELSE 0 END AS skipped",
    )
    convs = stored(convs, "heads")
    moved = shares.join(convs.drop("head", "own"), "conv").selectExpr(
        "conv", "part", "h - turns_before AS left_out", "n_head - h + turns_before AS turns_on",
        "head_points - skipped + points_before AS points_on",
    )
    own = numbered.join(moved, ["conv", "part"]).where("number > left_out")
    own = own.selectExpr("conv", "number + turns_on AS depth", "element", "n", "points + points_on AS points")
    given = convs.select("conv", F.explode("head").alias("x"))
    given = given.selectExpr("conv", "x.number AS depth", "x.element", "x.n", "x.points")
    return stored(own.unionByName(given), "turns"), convs.where("n_head = 0 AND own <= h").select("conv")


def pieces(turns: DataFrame, silent: DataFrame, width: int) -> DataFrame:
    """(conv, seg, seq, points, s1, s2, base_p, k1, k2, ends): every conversation in pieces of
    ``width`` turns, with the hashes of the prefixes before and with the piece."""
    parts = turns.groupBy("conv", F.expr(f"(depth - 1) div {width}").alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "element"))).alias("all"),  # width at most
        F.sum("n").alias("points"),
    )
    parts = parts.selectExpr("conv", "seg", "unhex(array_join(transform(all, x -> hex(x.element)), '')) AS seq", "points")
    parts = parts.unionByName(silent.selectExpr("conv", "0L AS seg", "X'' AS seq", "0L AS points"))
    parts = parts.selectExpr("*", "xxhash64(1, seg, seq) AS x1", "xxhash64(2, seg, seq) AS x2")
    along = Window.partitionBy("conv").orderBy("seg")
    so_far, before = (along.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    return parts.select(
        "conv", "seg", "seq", "points",
        *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"s{i}") for i in (1, 2)],
        F.coalesce(F.sum("points").over(before), F.lit(0)).alias("base_p"),
        *[F.bit_xor(f"x{i}").over(so_far).alias(f"k{i}") for i in (1, 2)],
        F.lead("seg").over(along).isNull().alias("ends"),
    )


# the forest of a block


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix in turns."""
    low, high = 0, min(len(a), len(b)) // _ELEMENT
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * _ELEMENT] == b[: middle * _ELEMENT] else (low, middle - 1)
    return low


def _points(seq: bytes, turns: int) -> int:
    return sum(int.from_bytes(seq[i * _ELEMENT + 16 : (i + 1) * _ELEMENT], "big") for i in range(turns))


class _Node:
    """A node of the compressed trie: its entries and finished or unfinished children."""

    __slots__ = ("base", "below", "children", "depth", "ends", "kids", "lo", "hi", "m", "n", "names", "own", "p", "parent", "start", "sums")

    def __init__(self, depth: int, p: int | None, place: int, entry: dict | None = None, start=None, base: int = 0):
        self.depth, self.p, self.lo, self.hi = depth, p, place, place
        self.own, self.children, self.names, self.parent, self.ends = [], [], [], None, (None, None)
        self.start, self.base = start, base
        self.m, self.n, self.sums, self.kids, self.below = None, 0, 0, 0, 0
        if entry is not None:
            self.start, self.base = (entry["s1"], entry["s2"]), entry["base"]
            self.own.append(entry)
            self.names += entry["names"] or []
            self._part(entry["m"], entry["n"], entry["sums"])
            self.kids, self.below, self.ends = entry["kids"], entry["below"], (entry["k1"], entry["k2"])

    def _part(self, m: int, n: int, sums: int) -> None:
        """Members of one more entry or child: the larger of the smallest members leaves the
        other's path here."""
        self.sums += sums + (self.p if self.n else 0)
        self.m = m if self.m is None else min(self.m, m)
        self.n += n

    def leaves(self) -> int:
        return self.below if self.kids else 1

    def adopt(self, child: _Node) -> None:
        self.children.append(child)
        child.parent = self
        self.kids += 1
        self.below += child.leaves()
        self._part(child.m, child.n, child.sums)
        self._span(child)

    def join(self, other: _Node) -> None:
        """Take over another unfinished share of this node."""
        for child in other.children:
            child.parent = self
        self.children += other.children
        self.own += other.own
        self.names += other.names
        self.kids += other.kids
        self.below += other.below
        self.ends = self.ends if self.ends[0] is not None else other.ends
        self._part(other.m, other.n, other.sums)
        self._span(other)

    def _span(self, other: _Node) -> None:
        self.lo, self.hi = min(self.lo, other.lo), max(self.hi, other.hi)


def _merged(entries: list[dict], edges: list[tuple[int, int]]) -> list[_Node]:
    """Union-find over the edges (depth, code points up to it) between neighbouring entries, in
    descending depth; an edge of depth -1 separates two tries. All nodes."""
    nodes = [_Node(e["depth"], None, i, e) for i, e in enumerate(entries)]
    owner, top = list(range(len(entries))), list(nodes)

    def find(i: int) -> int:
        while owner[i] != i:
            owner[i] = i = owner[owner[i]]
        return i

    for i in sorted((i for i, e in enumerate(edges) if e[0] >= 0), key=lambda i: -edges[i][0]):
        depth, points = edges[i]
        x, y = find(i), find(i + 1)
        a, b = top[x], top[y]
        if a.depth > depth and b.depth > depth:
            node = _Node(depth, points, a.lo, start=a.start, base=a.base)
            node.adopt(a)
            node.adopt(b)
            nodes.append(node)
        else:
            node, other = (a, b) if a.depth == depth else (b, a)
            node.p = points
            if other.depth == depth:
                other.p = points
                node.join(other)
                other.depth = None
            else:
                node.adopt(other)
        owner[y], top[x] = x, node
    return [node for node in nodes if node.depth is not None]


def _name(start: tuple[int, int]) -> str:
    return f"{start[0]}:{start[1]}"


def _forest(entries: list[dict], edges: list[tuple[int, int]], block: int, closed: bool, tag: str) -> Iterator[dict]:
    """Rows of finished nodes, roots, and names of finished nodes; and entries of the rest, all
    of which is finished if the block is ``closed``."""
    nodes, last = _merged(entries, edges), len(entries) - 1
    free = [v for v in nodes if not closed and (v.lo == 0 or v.hi == last)]
    names = {id(v): v.names or [f"{tag}-{block}-{i}"] for i, v in enumerate(free)}
    for node in nodes:
        if id(node) in names:
            continue
        above = node.parent
        row = dict(
            s1=node.start[0], s2=node.start[1], m=node.m, n=node.n, below=node.leaves(), sums=node.sums, kids=node.kids,
            depth=node.depth, base=node.base, k1=node.ends[0], k2=node.ends[1], names=node.names,
        )
        if node.names:
            yield row | {"kind": "name"}
        if above is None and node.base:
            yield row | {"kind": "root", "kids": node.kids if node.depth == node.base else 1}
            if node.depth == node.base:
                continue
        row["kind"], row["top"] = "node", above.depth if above else node.base or -1
        if row["top"] == node.base and node.base:
            row["parent_name"] = _name(node.start)
        elif above is not None:
            row |= {"parent_name": names[id(above)][0]} if id(above) in names else {"parent": above.m}
        yield row
    left = sorted((v for v in free if v.hi < last), key=lambda v: -v.depth)
    both = [v for v in free if v.lo == 0 and v.hi == last]
    right = sorted((v for v in free if v.lo > 0), key=lambda v: v.depth)
    chain, links = left + both + right, []
    for a, b in pairwise(chain):
        over = b if a.parent is b else a if b.parent is a else None
        links.append((over.depth, over.p) if over else (-1, 0))
    rows = []
    for i, node in enumerate(chain):
        rest = _Node(node.depth, node.p, 0)
        for entry in node.own:
            rest._part(entry["m"], entry["n"], entry["sums"])
            rest.kids += entry["kids"]
            rest.below += entry["below"]
        for child in node.children:
            if id(child) not in names:
                rest.kids += 1
                rest.below += child.leaves()
                rest._part(child.m, child.n, child.sums)
        if not rest.n:  # both sides' paths meet here and nothing else
            rows.append(None)
            continue
        rows.append(dict(
            kind="entry", s1=node.start[0], s2=node.start[1], m=rest.m, n=rest.n, below=rest.below, sums=rest.sums, kids=rest.kids,
            depth=node.depth, base=node.base, k1=node.ends[0], k2=node.ends[1], names=names[id(node)], block=block,
            base_p=entries[0]["base_p"],
        ))
    kept = [(row, link) for row, link in zip(rows, [*links, None]) if row is not None]
    for place, (row, link) in enumerate(kept):
        row["place"], (row["edge"], row["edge_p"]) = place, link or (None, None)
        if place == 0:
            row["first"], row["base_p"] = entries[0]["first"], entries[0]["base_p"]
        if place == len(kept) - 1:
            row["last"], row["base_p"] = entries[-1]["last"], entries[-1]["base_p"]
        yield row


def _edge(a: dict, b: dict) -> tuple[int, int]:
    """Between the last sequence of one entry and the first of the next."""
    if (a["s1"], a["s2"]) != (b["s1"], b["s2"]):
        return -1, 0
    turns = _shared(a["last"], b["first"])
    return a["base"] + turns, a["base_p"] + _points(a["last"], turns)


def _batch(rows: Iterator[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(list(rows), _SCHEMA)


def _blocks(rows: int, tag: str):
    """The forest of each block of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def made() -> pa.RecordBatch:
            for e in held:
                e |= {"first": e["seq"], "last": e["seq"], "names": None}
            edges = [_edge(*pair) for pair in pairwise(held)]
            return _batch(_forest(held, edges, (part << _BLOCKS) + number, False, tag))

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                for entry in batch.slice(at, rows).to_pylist():
                    held.append(entry)
                    if len(held) == rows:
                        yield made()
                        number, held = number + 1, []
        if held:
            yield made()

    return run


def _neighbours(shift: int, closed: bool, tag: str):
    """The forest of neighbouring blocks' entries."""

    def run(table: pa.Table) -> pa.Table:
        entries = table.drop_columns(["group"]).sort_by([("block", "ascending"), ("place", "ascending")]).to_pylist()
        edges = [_edge(a, b) if a["edge"] is None else (a["edge"], a["edge_p"]) for a, b in pairwise(entries)]
        return pa.Table.from_batches([_batch(_forest(entries, edges, entries[0]["block"] >> shift << shift, closed, tag))])

    return run


def _grown(groups: DataFrame, rows: int, level: int) -> DataFrame:
    """The rows of finished nodes, roots and names of one level's sequences."""
    order = ["s1", "s2", "seq"]
    ordered = groups.repartitionByRange(*order).sortWithinPartitions(*order)
    made = stored(ordered.mapInArrow(_blocks(rows, f"{level}"), _ROW), "forest")
    done, shift = made.where("kind <> 'entry'"), _BLOCKS + _FAN // 2
    while True:
        entries = made.where("kind = 'entry'")
        highest = entries.agg(F.max("block")).first()[0]
        if highest is None:
            return done
        closed = highest >> shift == 0
        grouped = entries.withColumn("group", F.shiftright("block", shift)).groupBy("group")
        made = stored(grouped.applyInArrow(_neighbours(shift, closed, f"{level}-{shift}"), _ROW), "forest")
        done, shift = done.unionByName(made.where("kind <> 'entry'")), shift + _FAN


# members that end at a node


def _id_chunks(size: int):
    """Sorted (k1, k2, conv): the ids of a node in texts of at most ``size`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            k1, k2, conv = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((np.diff(k1) != 0) | (np.diff(k2) != 0)) + 1
            for a, b in pairwise([0, *cuts.tolist(), len(conv)]):
                for i in range(a, b, size):
                    out.append((int(k1[a]), int(k2[a]), part, number, ",".join(map(str, conv[i : min(i + size, b)].tolist()))))
                    number += 1
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["k1", "k2", "part", "number", "ids"])

    return run


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks: the digest of a node's ids, read as a stream."""
    key, digest = None, None

    def made() -> pa.RecordBatch:
        return pa.record_batch([[key[0]], [key[1]], [digest.hexdigest()]], ["k1", "k2", "ends_sha256"])

    for batch in batches:
        for one in batch.select(["k1", "k2", "ids"]).to_pylist():
            if (one["k1"], one["k2"]) != key:
                if key:
                    yield made()
                key, digest = (one["k1"], one["k2"]), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(one["ids"].encode())
    if key:
        yield made()


def _ends(all_pieces: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256). A digest can only be taken in order: chunks of ids are made by
    many tasks, one task reads a node's chunks."""
    ends = all_pieces.where("ends").select("k1", "k2", "conv")
    ends = ends.repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv")
    chunks = ends.mapInArrow(_id_chunks(IDS), "k1 bigint, k2 bigint, part bigint, number bigint, ids string")
    chunks = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part", "number")
    return chunks.mapInArrow(_id_digests, "k1 bigint, k2 bigint, ends_sha256 string")


# all together


def _private(all_pieces: DataFrame, width: int) -> tuple[DataFrame, DataFrame, int]:
    """Pieces that others share, the chains of the others, and the last level. The first prefix
    that one conversation alone has begins its chain."""
    later = all_pieces.where("seg > 0")
    alone = later.groupBy("seg", "s1", "s2").agg(F.count("*").alias("holders"), F.min("conv").alias("conv"))
    alone = stored(alone.where("holders = 1").groupBy("conv").agg(F.min("seg").alias("seg")), "alone")
    pairs = all_pieces.join(alone.withColumnRenamed("seg", "from"), "conv", "left")
    kept = stored(pairs.where("`from` IS NULL OR seg < `from`").drop("from"), "pieces")
    tails = pairs.where("seg >= `from`").groupBy("conv").agg(
        F.min("from").alias("from"),
        F.min(F.when(F.expr("seg = `from`"), F.struct("s1", "s2"))).alias("s"),
        F.min(F.when(F.col("ends"), F.struct("k1", "k2"))).alias("k"),
        F.max(F.expr(f"seg * {width} + length(seq) div {_ELEMENT}")).alias("depth"),
    )
    tails = stored(
        tails.selectExpr(
            "conv AS m", f"`from` * {width} AS top", "depth", "1L AS n", "1L AS below", "0L AS sums", "0L AS kids",
            "CAST(NULL AS bigint) AS parent", "concat(s.s1, ':', s.s2) AS parent_name", "k.k1 AS k1", "k.k2 AS k2",
            "s.s1 AS s1", "s.s2 AS s2", "`from` AS seg",
        ),
        "tails",
    )
    return kept, tails, kept.agg(F.max("seg")).first()[0]


_NODE = ["m", "top", "depth", "n", "below", "sums", "kids", "parent", "parent_name", "k1", "k2"]


def compressed(all_pieces: DataFrame, width: int = WIDTH, rows: int = ROWS) -> DataFrame:
    """Chains of nodes with the same members: from below depth ``top`` to ``depth``."""
    if all_pieces.where("seg > 0").isEmpty():
        kept, tails, level = all_pieces, None, 0
    else:
        kept, tails, level = _private(all_pieces, width)
    groups = kept.groupBy("seg", "s1", "s2", "k1", "k2", "seq", "base_p", "points").agg(
        F.min("conv").alias("m"), F.count("*").alias("n"), F.count_if("ends").alias("n_ends")
    )
    if level:
        groups = stored(groups, "groups")
    nodes = tails.select(_NODE) if tails is not None else None
    names, below = None, None
    root = ["s1 AS k1", "s2 AS k2", "below", "sums", "kids"]
    while level >= 0:
        here = groups.where(F.col("seg") == level) if tails is not None else groups
        if tails is not None:
            ended = tails.where(F.col("seg") == level + 1).selectExpr("s1 AS k1", "s2 AS k2", "below", "sums", "1L AS kids")
            under = ended.unionByName(below) if below is not None else ended
            here = here.join(under, ["k1", "k2"], "left")
            over = here.where("kids IS NOT NULL").selectExpr("concat(k1, ':', k2) AS name", "m AS named")
            names = over if names is None else names.unionByName(over)
        else:
            here = here.selectExpr("*", "CAST(NULL AS bigint) AS below", "0L AS sums", "CAST(NULL AS bigint) AS kids")
        shape = here.selectExpr(
            "s1", "s2", "seq", "base_p", "m", "n", "coalesce(below, 0) AS below", "coalesce(kids, 0) AS kids",
            "coalesce(sums, 0) + (base_p + points) * (n_ends + int(kids IS NOT NULL) - 1) AS sums",
            f"bigint(seg * {width} + length(seq) div {_ELEMENT}) AS depth", f"bigint(seg * {width}) AS base",
            "CASE WHEN n_ends > 0 THEN k1 END AS k1", "CASE WHEN n_ends > 0 THEN k2 END AS k2",
        )
        done = _grown(shape, rows, level)
        made = done.where("kind = 'node'").select(_NODE)
        nodes = made if nodes is None else nodes.unionByName(made)
        own = done.where("kind = 'name'").select(F.explode("names").alias("name"), F.col("m").alias("named"))
        names = own if names is None else names.unionByName(own)
        below = done.where("kind = 'root'").selectExpr(root)
        level -= 1
    # very many nodes may lie below one that was finished later: its name is salted
    salted = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    asking = nodes.withColumn("salt", F.pmod(F.xxhash64("m", "depth"), F.lit(SALT)).cast("int"))
    known = asking.where("parent_name IS NULL").drop("salt", "parent_name")
    asking = asking.where("parent_name IS NOT NULL").drop("parent").withColumnRenamed("parent_name", "name")
    told = asking.join(salted, ["name", "salt"]).withColumnRenamed("named", "parent").drop("name", "salt")
    return known.unionByName(told)


def prefix_trie(
    df: DataFrame, shared: int = SHARED, heads: int = HEADS, width: int = WIDTH, rows: int = ROWS
) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``df`` has conv_id, turn, role, text."""
    turns, silent = rebuilt_turns(df, shared, heads)
    all_pieces = stored(pieces(turns, silent, width), "pieces")
    chains = compressed(all_pieces, width, rows).join(_ends(all_pieces), ["k1", "k2"], "left")
    nodes = chains.withColumn("at", F.explode(F.expr("sequence(top + 1, depth)")))
    spoken = turns.select(F.col("conv").alias("m"), F.col("depth").alias("at"), (F.col("points") - F.col("n")).alias("before"))
    return nodes.join(spoken, ["m", "at"], "left").selectExpr(
        "m AS conv_id",
        "at AS depth",
        "CASE WHEN at = 0 THEN NULL WHEN at > top + 1 THEN m ELSE parent END AS parent_conv_id",
        "n AS n_convs",
        "CASE WHEN at < depth THEN 1L ELSE kids END AS n_children",
        "below AS n_leaves",
        "sums - (n - 1) * coalesce(before, 0) AS saved_tokens",
        "CASE WHEN at = depth AND ends_sha256 IS NOT NULL THEN ends_sha256 ELSE sha2('', 256) END AS ends_sha256",
    )
