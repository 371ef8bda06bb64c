"""WARC archives through a table of chunks.

Writing: a payload becomes rows of (record, chunk number), each at most `CHUNK_BYTES`
long. Every chunk is a WARC record of its own: the first is the response, the others are
continuation records, as the format has it for segmented records. Equal payloads are
written once; the other records revisit the one with the smallest id. Reading: an archive
is one stream of lines; the reader holds a line and a running digest, never a record.

Cases: a null payload counts as empty. Rows that share the smallest id of their payload
are all responses. Empty tables give an archive without records and no rows. A record cut
off at the end of an archive raises an error. Rows without an id are archived with an
empty one and come back with a null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.session import materialize

CHUNK_BYTES = 64 * 1024
#: Smaller payloads are never revisited.
REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the format
CHUNK = "page_id bigint, record_type string, refers_to bigint, chunk_no bigint, chunk binary, bytes_so_far bigint, digest_so_far string, last boolean"


def record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary), digest, refers_to (null for responses)."""
    payload = F.coalesce(F.encode("payload", "UTF-8"), F.lit(b""))
    rows = pages.withColumn("payload", payload).withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    copies = rows.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    firsts = materialize(copies.filter("n > 1").drop("n"), "warc-firsts")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id")), F.col("first_id"))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", "bytes", refers.alias("refers_to"))


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a field that is null is left out."""
    return F.concat_ws("", *(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields))


def chunk_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk, as the bytes of its WARC record but for the last line feed, which the writer adds."""
    revisit = F.col("refers_to").isNotNull()
    pieces = F.when(revisit, 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk_bytes))).cast("int")
    rows = records.withColumn("n", pieces).withColumn("k", F.explode(F.sequence(F.lit(1), "n")))
    chunk = F.when(revisit, F.lit(b"")).otherwise(F.expr(f"substring(payload, (k - 1) * {chunk_bytes} + 1, {chunk_bytes})"))
    first, many = F.col("k") == 1, F.col("n") > 1
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _lines(("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.col("bytes").cast("string"))), F.lit("\r\n"))
    block = F.concat(F.when(first, http).otherwise("").cast("binary"), chunk)
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    url = F.regexp_replace("url", "[\r\n]", "")
    head = F.concat(F.lit("WARC/1.1\r\n"), _lines(
        ("WARC-Type", F.when(revisit, "revisit").when(first, "response").otherwise("continuation")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), number, F.when(first, "").otherwise(F.concat(F.lit(":"), "k")), F.lit(">"))),
        ("WARC-Target-URI", F.when(first, url)),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), "digest"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), "refers_to", F.lit(">")))),
        ("WARC-Segment-Number", F.when(many, F.col("k").cast("string"))),
        ("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<urn:page:"), number, F.lit(">")))),
        ("WARC-Segment-Total-Length", F.when(many & (F.col("k") == F.col("n")), F.col("bytes").cast("string"))),
        ("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        ("Content-Length", F.octet_length("block").cast("string"))), F.lit("\r\n"))
    return rows.withColumn("block", block).select(F.concat(head.cast("binary"), "block", F.lit(b"\r\n\r")).cast("string").alias("value"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write all rows as gzip archives. Gzip files are never split, so a reader meets the chunks of a record in order."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    chunk_rows(record_types(rows), chunk_bytes).write.option("lineSep", "\n").option("compression", "gzip").text(path)


class _Reader:
    """Takes the lines of archives, gives the chunks of their records."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.record: dict = {}
        self.left = self.http = 0
        self.closing = 0

    def line(self, line: bytes) -> Iterator[dict]:
        """`line` comes with its line feed."""
        if self.left > 0:
            yield from self._block(line[: self.left], line[self.left :])
        elif self.closing:
            self._close(line)
        elif self.head is None:
            if line != b"WARC/1.1\r\n":
                raise ValueError(f"no record begins with {line[:40]!r}")
            self.head = {}
        elif line != b"\r\n":
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            self.head[name] = value
        else:
            self._begin()
            if not self.left:
                yield from self._end()

    def _begin(self) -> None:
        kind, self.left = self.head["WARC-Type"], int(self.head["Content-Length"])
        self.data: list[bytes] = []
        if kind == "continuation":
            self.record["chunk_no"] += 1
            self.http = 0
            return
        number = lambda name: int(x) if (x := self.head.get(name, "")[len("<urn:page:") : -1]) else None
        self.record = {"page_id": number("WARC-Record-ID"), "record_type": kind, "refers_to": number("WARC-Refers-To"), "chunk_no": 1}
        self.sha, self.size, self.http = hashlib.sha256(), 0, 1

    def _block(self, own: bytes, rest: bytes) -> Iterator[dict]:
        self.left -= len(own)
        if self.http:
            if own.startswith(b"Content-Length: "):
                self.length = int(own[16:])
            self.http = own != b"\r\n"
        else:
            self.sha.update(own)
            self.size += len(own)
            self.data.append(own)
        if not self.left:
            yield from self._end()
            if rest:
                self._close(rest)

    def _close(self, line: bytes) -> None:
        if line != b"\r\n":
            raise ValueError(f"a record ends with {line[:40]!r}")
        self.closing -= 1

    def _end(self) -> Iterator[dict]:
        part, total = "WARC-Segment-Number" in self.head, self.head.get("WARC-Segment-Total-Length")
        last = not part or total is not None
        out = self.record | {"chunk": b"".join(self.data), "bytes_so_far": self.size, "digest_so_far": self.sha.copy().hexdigest(), "last": last}
        if self.record["record_type"] == "revisit":  # its block has the header of the response, its digest is that of the payload
            out |= {"bytes_so_far": self.length, "digest_so_far": self.head["WARC-Payload-Digest"].removeprefix("sha256:")}
        elif last and self.size != self.length:
            raise ValueError(f"page {self.record['page_id']} has {self.size} of {self.length} bytes")
        self.head, self.closing = None, 2
        yield out


def _read(with_payload: bool):
    fields = ["page_id", "record_type", "refers_to", "chunk_no", "chunk", "bytes_so_far", "digest_so_far", "last"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader()
        for batch in batches:
            rows = [r for x in batch.column(0) for r in reader.line(x.as_py() + b"\n")]
            rows = rows if with_payload else [r | {"chunk": None} for r in rows if r["last"]]
            yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], k) for f, k in zip(fields, kinds, strict=True)], fields)
        if reader.head is not None or reader.closing:
            raise ValueError("an archive ends within a record")

    return read


def read_chunks(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Rows of (page_id, chunk_no) with the chunk and the digest and length up to it; without payload the last row of each record only."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_read(with_payload), CHUNK)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return read_chunks(spark, path, with_payload=False).select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"), "record_type", "refers_to")
