"""WARC records in a chunked table: payloads travel as (record, chunk number) rows.

``write_archives`` writes a Parquet table whose rows are consecutive pieces of WARC files:
``archive`` (file), ``record`` (its page), ``chunk`` (number in the record), ``last``, ``data`` and
``digest``, the SHA-1 of the payload up to and with this chunk. Records stream chunk by chunk with
a running digest; no Python step holds a whole payload. Payloads are cut by the JVM.
Of records with equal payloads the one with the largest page id is a response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import bounded_batches, text_or_empty

CHUNK_BYTES = 1 << 20
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_URN = "urn:page:"
_FIELDS = ["archive", "record", "chunk", "last", "data", "digest"]


def _base32(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def _header(page: int | None, url: str | None, size: int, sha1: str, first: int | None, revisit: bool) -> bytes:
    digest = _base32(bytes.fromhex(sha1))
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{_URN}{page}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}",
    ]
    http = _HTTP.format(size).encode()
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_URN}{first}>",
        ]
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES
) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html).

    A null html is an empty payload, a null url an empty target. Payloads shorter than
    ``min_bytes`` are all responses. Repeated page ids with equal payloads: all are responses, as
    a record cannot refer to itself. A null page id never wins over a known one. No rows give an
    empty table.
    """
    bounded_batches(pages)
    data = text_or_empty("html").cast("binary")
    rows = pages.select("page_id", "url", data.alias("html")).withColumn("size", F.octet_length("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    firsts = rows.groupBy("sha1").agg(F.max("page_id").alias("first"))
    known = rows.join(firsts, "sha1")
    revisit = (F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    cuts = F.sequence(F.lit(0), F.greatest(F.ceil(F.col("size") / chunk_bytes) - 1, F.lit(0)).cast("int"))
    pieces = known.withColumn("revisit", revisit).select(
        "page_id", "url", "size", "sha1", "first", "revisit", "html",
        F.posexplode(F.when(F.col("revisit"), F.array(F.lit(0))).otherwise(cuts)).alias("chunk", "_"),
    )
    part = F.when(F.col("revisit"), F.lit(b"")).otherwise(
        F.substring("html", F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    )
    last = F.col("revisit") | ((F.col("chunk") + 1) * chunk_bytes >= F.col("size"))
    pieces = pieces.select(
        F.spark_partition_id().alias("archive"), "page_id", "chunk", last.alias("last"), part.alias("data"),
        "url", "size", "sha1", "first", "revisit",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, place = hashlib.sha1(), 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["chunk"] == 0:
                    running, place = hashlib.sha1(), place + 1
                running.update(r["data"])
                head = b""
                if r["chunk"] == 0:
                    head = _header(r["page_id"], r["url"], r["size"], r["sha1"], r["first"], r["revisit"])
                if r["last"] and not r["revisit"] and running.hexdigest() != r["sha1"]:
                    raise ValueError(f"payload of page {r['page_id']} changed while it was written")
                out.append({
                    "archive": r["archive"], "record": place, "chunk": r["chunk"], "last": r["last"],
                    "data": head + r["data"] + (b"\r\n\r\n" if r["last"] else b""), "digest": running.hexdigest(),
                })
            yield pa.RecordBatch.from_pylist(out, schema=_CHUNKS)

    pieces.mapInArrow(run, _CHUNKS_SQL).write.parquet(path)


_CHUNKS = pa.schema([
    ("archive", pa.int32()), ("record", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()),
    ("data", pa.binary()), ("digest", pa.string()),
])
_CHUNKS_SQL = "archive int, record long, chunk int, last boolean, data binary, digest string"
_RECORD_SQL = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page(value: str | None) -> int | None:
    name = value[len(_URN) + 1 : -1] if value else "None"
    return None if name == "None" else int(name)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse records from their chunks in order, checking length and digests on the way."""
    fields, running, seen, total = {}, hashlib.sha1(), 0, 0
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            data = r["data"]
            if r["chunk"] == 0:
                head, _, data = data.partition(b"\r\n\r\n")
                fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
                http, _, data = data.partition(b"\r\n\r\n")
                total = int(fields["Content-Length"]) - len(http) - 4
                running, seen = hashlib.sha1(), 0
            if r["last"]:
                data = data[:-4]
            running.update(data)
            seen += len(data)
            if running.hexdigest() != r["digest"]:
                raise ValueError(f"chunk {r['chunk']} of {fields['WARC-Record-ID']} is damaged")
            if r["last"]:
                digest, revisit = fields["WARC-Payload-Digest"][5:], fields["WARC-Type"] == "revisit"
                if seen != total or not revisit and _base32(running.digest()) != digest:
                    raise ValueError(f"{fields['WARC-Record-ID']} is incomplete")
                out.append({
                    "page_id": _page(fields["WARC-Record-ID"]),
                    "payload_bytes": int(fields["X-Payload-Length"]) if revisit else seen,
                    "payload_digest": digest, "record_type": fields["WARC-Type"],
                    "refers_to": _page(fields.get("WARC-Refers-To")),
                })
        yield pa.RecordBatch.from_pylist(out, schema=_RECORDS)


_RECORDS = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A record of one chunk is read where it lies. The chunks of longer records are brought
    together and in order by a sort, and stream through the same parser.
    """
    chunks = spark.read.parquet(path)
    single = (F.col("chunk") == 0) & F.col("last")
    whole = chunks.where(single).mapInArrow(_records, _RECORD_SQL)
    long = chunks.where(~single).repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
    return whole.unionByName(long.mapInArrow(_records, _RECORD_SQL))
