"""WARC archives of pages, and their merged capture index.

Pages become WARC 1.1 records: a ``response`` with the payload, or a ``revisit`` that
refers to the response with the equal payload. Spark's text writer makes the archives, as
``CR LF CR LF``, its line separator here, is what ends a WARC record; so they can lie in any
store that Spark writes. They are read back as a stream of lines put together by
Content-Length, one record in memory at a time, and every payload is checked against its
digest and length.

The index of captures is merged externally: every task sorts the captures it has read by
URL key, time and page id and stores that run; the runs are dealt out by ranges of the key;
each range cuts what arrives into ascending runs and merges them with a loser tree. Ranges
include time and page id, so one url with a third of all captures is spread.

Of records with equal payloads (SHA-256 and length) of at least ``least_bytes`` those with
the largest page id are responses, also if that row is repeated; the others revisit them.
Shorter ones are responses. Null html is an empty payload, a null url has an empty key, a
null page id is smaller than any other. Empty tables give empty results; only the three
columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger.llm.common import new_path, stored

LEAST_BYTES = 1000
_END = b"\r\n\r\n"
_INDEX = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url string, captured_at string, archive string, position bigint"
)
_NAMES = [part.split()[0] for part in _INDEX.split(", ")]
_ID = re.compile(r"<urn:page:(-?\d+)>")


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit("\r\n"))


def decided(df: DataFrame, page: str, url: str, html: str, captured: Column, least_bytes: int) -> DataFrame:
    """Pages with payload, digest and the page id of the response they revisit, if any."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = df.select(
        F.col(page).cast("bigint").alias("id"), F.col(url).alias("url"), payload.alias("payload"), captured.alias("captured_at")
    )
    size = F.octet_length("payload").cast("bigint")
    rows = rows.withColumns({"size": size, "digest": F.sha1(F.encode("payload", "utf-8")), "same": F.sha2(F.encode("payload", "utf-8"), 256)})
    large = rows.where(F.col("size") >= least_bytes).groupBy("same", "size")
    shared = large.agg(F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.join(shared, ["same", "size"], "left")
    return rows.withColumn("refers", F.expr("CASE WHEN response IS NOT NULL AND NOT id <=> response THEN response END"))


def records(rows: DataFrame) -> DataFrame:
    """One WARC record as text per row of ``decided``, without its closing line breaks."""
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))
    plain = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit("\r\n\r\n"),
    )
    revisit = F.col("refers").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", name),
        _line("WARC-Date", F.col("captured_at")),
        F.coalesce(_line("WARC-Target-URI", plain), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")).otherwise(""),
        F.coalesce(_line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers").cast("string"), F.lit(">"))), F.lit("")),
        _line("Content-Type", "application/http; msgtype=response"),
        F.lit("Content-Length: "),
    )
    sized = rows.select(head.alias("head"), block.alias("block"))
    return sized.select(F.concat("head", F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), "block").alias("value"))


def write_archives(rows: DataFrame, path: str) -> None:
    records(rows).write.option("lineSep", _END.decode()).option("compression", "gzip").text(path)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the files of one task, in the order of their lines."""
    stream = _Stream("")
    for batch in batches:
        out = []
        for file, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if file != stream.file:
                stream.close()
                stream = _Stream(file)
            out += stream.feed(line)
        yield pa.RecordBatch.from_pylist(out, pa.schema([(n, pa.string() if "string" in d else pa.int64()) for n, d in (p.split() for p in _INDEX.split(", "))]))
    stream.close()


class _Stream:
    """The bytes of one archive so far, less the records taken from them."""

    def __init__(self, file: str):
        self.file, self.position = file, 0
        self.parts: list[bytes] = []
        self.have, self.need = 0, 0

    def feed(self, line: str) -> list[dict]:
        data = line.encode("utf-8") + _END
        self.parts.append(data)
        self.have += len(data)
        if self.have < self.need:
            return []
        buffer, out = b"".join(self.parts), []
        while buffer:
            if buffer.startswith(b"\r\n"):  # the line breaks of a last payload that ends in them
                buffer, self.position = buffer[2:], self.position + 2
                continue
            cut = buffer.find(_END)
            if cut < 0:
                self.need = 0
                break
            lines = buffer[:cut].decode("utf-8").split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            self.need = cut + 4 + int(fields["Content-Length"]) + 4
            if len(buffer) < self.need:
                break
            out.append(self.entry(fields, buffer[cut + 4 : self.need - 4]))
            self.position += self.need
            buffer, self.need = buffer[self.need :], 0
        self.parts, self.have = [buffer], len(buffer)
        return out

    def entry(self, fields: dict, block: bytes) -> dict:
        cut = block.index(_END)
        size = int(re.search(rb"Content-Length: (\d+)", block[:cut])[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = block[cut + 4 :]
        if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{self.file}, {self.position}: the payload is not what its record says")
        page, refers = _ID.fullmatch(fields["WARC-Record-ID"]), _ID.fullmatch(fields.get("WARC-Refers-To", ""))
        return {
            "page_id": int(page[1]) if page else None,
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": fields["WARC-Type"],
            "refers_to": int(refers[1]) if refers else None,
            "url": fields.get("WARC-Target-URI"),
            "captured_at": fields["WARC-Date"],
            "archive": self.file,
            "position": self.position,
        }

    def close(self) -> None:
        if b"".join(self.parts).strip(b"\r\n"):
            raise ValueError(f"{self.file} ends within a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: what the archives say, and where it is (archive, position)."""
    lines = spark.read.option("lineSep", _END.decode()).text(path).select("_metadata.file_name", "value")
    return lines.mapInArrow(_parsed, _INDEX)


def url_key(url: Column) -> Column:
    """Host labels reversed, then the rest: ``com,example,www)/path?query``."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), F.lit(""))


def merged(runs: list[list[tuple]]) -> Iterator[tuple]:
    """The rows of sorted runs in order, by a loser tree: each inner node keeps the run that
    lost there, so the next row costs one comparison a level."""
    k = len(runs)
    if not k:
        return
    at = [0] * k

    def beats(a: int, b: int) -> bool:
        if at[a] >= len(runs[a]):
            return False
        return at[b] >= len(runs[b]) or runs[a][at[a]][0] <= runs[b][at[b]][0]

    losers, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while at[best] < len(runs[best]):
        yield runs[best][at[best]]
        at[best] += 1
        node = (best + k) // 2
        while node:
            if not beats(best, losers[node]):
                best, losers[node] = losers[node], best
            node //= 2


def _merge_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs: list[list[tuple]] = []
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("url_key", "captured_at", "order_id")))
        for row, key in enumerate(keys):
            if not runs or key < runs[-1][-1][0]:
                runs.append([])
            runs[-1].append((key, len(held), row))
        held.append(batch)
    if not held:
        return
    starts = [0]
    for batch in held:
        starts.append(starts[-1] + batch.num_rows)
    order = pa.array([starts[b] + row for _, b, row in merged(runs)], pa.int64())
    yield from pa.Table.from_batches(held).take(order).combine_chunks().to_batches(max_chunksize=10_000)


def capture_history(index: DataFrame) -> DataFrame:
    """The index in the global order of URL key, time and page id."""
    order = ["url_key", "captured_at", "order_id"]
    rows = index.withColumns(
        {"url_key": url_key(F.col("url")), "order_id": F.coalesce("page_id", F.lit(-(2**63) + 1))}
    )
    runs = stored(rows.sortWithinPartitions(*order), "runs")
    ranged = runs.repartitionByRange(*order)
    return ranged.mapInArrow(_merge_range, ranged.schema).drop("order_id")


def archive(
    df: DataFrame,
    page: str = "page_id",
    url: str = "url",
    html: str = "html",
    captured: Column | None = None,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """Write all pages as archives, read them back and return their merged index."""
    spark = df.sparkSession
    if captured is None:  # pages without a capture time count seconds by their id
        seconds = F.coalesce(F.pmod(F.col(page).cast("bigint"), F.lit(10**9)), F.lit(0))
        captured = F.date_format(F.timestamp_seconds(F.lit(1_704_067_200) + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    path = new_path(spark, "warc")
    write_archives(decided(df, page, url, html, captured, least_bytes), path)
    return capture_history(read_archives(spark, path))
