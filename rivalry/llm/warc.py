"""WARC archives: writing captures with revisits, reading records, assembling transactions.

``write`` gives each page a capture of three records: ``response`` (or
``revisit``, if an equal payload of at least ``MIN_PAYLOAD`` bytes is held by
a page of smaller id), ``request`` and ``metadata``; the last two name the
first in ``WARC-Concurrent-To``.  One archive per input partition, one gzip
member per record.  ``records`` streams archives back, one record at a time.
``captures`` joins the records of a transaction through their concurrent-to
identifiers and emits one nested row per capture; ``resolve`` follows the
revisits to the responses that hold their payload.

Payloads move once, into the archive, and are dropped before a shuffle unless
a caller asks for them: equal payloads are found by their SHA-256 in rows of
a digest and an id, aggregated before the shuffle, so a payload that a third
of the pages share is one row per task.

Null html is empty; null ids are never the smallest of a group unless all
are; rows that repeat an id and a payload are captures of their own, and
those of the smallest id are all responses; an empty table gives no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivalry.functions.joins import checked_broadcast
from rivalry.llm import memory
from rivalry.llm.store import filesystem, scratch, staged, write_file

MIN_PAYLOAD = 100
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Date of the records; the library never reads the clock.
DATE = "2024-01-01T00:00:00Z"
RECORD = ("warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, "
          "http_head string, payload binary, payload_bytes long, payload_digest string, info string")


def planned(pages: DataFrame) -> DataFrame:
    """(rid, page_id, url, html, digest, first_rid): ``first_rid`` is the capture that a revisit refers to, else null."""
    html = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", "url", html.alias("html"),
                       F.sha2(html.cast("binary"), 256).alias("digest"))
    light = own.filter(F.octet_length("html") >= MIN_PAYLOAD).select("digest", "page_id", "rid")
    # Nulls last: a null id stands for no place in the order.
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "rid")
    firsts = (light.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select(F.col("digest").alias("_digest"), F.col("first.page_id").alias("_page"),
                                      F.col("first.rid").alias("_rid")))
    joined = own.join(checked_broadcast(firsts), F.col("digest") == F.col("_digest"), "left")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("page_id").isNotNull() | (F.col("rid") == F.col("_rid")))
    return joined.select("rid", "page_id", "url", "html", "digest",
                         F.when(F.col("_rid").isNotNull() & ~same, F.col("_rid")).alias("first_rid"))


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in headers)
    return zlib_member(VERSION + b"\r\n" + head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")


def zlib_member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _uri(url: str | None) -> str:
    return re.sub(r"[^\x21-\x7E]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")),
                  url or "")


def write(pages: DataFrame, folder: str | None = None) -> list[str]:
    """Write ``pages`` (page_id, url, html) as WARC archives; their names, one per partition that has pages."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    seed = folder.rstrip("/").rsplit("/", 1)[-1]

    def record_id(rid: int, kind: str) -> str:
        return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{seed}/{rid}/{kind}'.encode()).hexdigest())}>"

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        name, n = f"{folder}/pages-{TaskContext.get().partitionId():05d}.warc.gz", 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def out(stream) -> None:
            nonlocal n
            stream.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
                                  ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                                 b"format: WARC File Format 1.1\r\n"))
            batch = first
            while batch is not None:
                for rid, page_id, url, html, digest, of in zip(*(c.to_pylist() for c in batch.columns)):
                    main, uri = record_id(rid, "main"), _uri(url)
                    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
                    kept = [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
                    if of is None:
                        stream.write(_record([("WARC-Type", "response"), ("WARC-Record-ID", main), *common, *kept],
                                             HTTP_HEAD + html.encode("utf-8")))
                    else:
                        stream.write(_record([("WARC-Type", "revisit"), ("WARC-Record-ID", main), *common, *kept,
                                              ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(of, "main"))],
                                             HTTP_HEAD))
                    host = re.match(r"[a-z]+://([^/?#]*)", uri)
                    request = f"GET {uri} HTTP/1.1\r\nHost: {host[1] if host else ''}\r\n\r\n".encode()
                    stream.write(_record([("WARC-Type", "request"), ("WARC-Record-ID", record_id(rid, "request")), *common,
                                          ("WARC-Concurrent-To", main), ("Content-Type", "application/http;msgtype=request")],
                                         request))
                    stream.write(_record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(rid, "metadata")), *common,
                                          ("WARC-Concurrent-To", main), ("Content-Type", "application/json")],
                                         json.dumps({"page_id": page_id, "url": url}).encode()))
                    n += 1
                batch = next(batches, None)

        write_file(name, out)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["file", "captures"])

    made = planned(pages).mapInArrow(archive, "file string, captures long").collect()  # one row per partition
    return sorted(r.file for r in made)


def stream_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of a gzip WARC stream."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record here: {line[:40]!r}")
            headers = {}
            while (line := f.readline().rstrip(b"\r\n")):
                k, _, v = line.decode("utf-8").partition(":")
                headers[k.strip().lower()] = v.strip()
            yield headers, f.read(int(headers.get("content-length", 0)))


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """One row per request, response, revisit and metadata record of the archives (schema ``RECORD``).

    ``payload_bytes`` and ``payload_digest`` are computed from the payload
    that was read, and checked against the record's own digest; a revisit has
    its digest from the header and no bytes.
    """

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin()
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string(), pa.string()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = filesystem(name)
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for h, block in stream_records(stream):
                        kind = h.get("warc-type")
                        if kind not in ("request", "response", "revisit", "metadata"):
                            continue
                        head, payload, size, digest, info = None, None, None, None, None
                        if kind == "metadata":
                            info = block.decode("utf-8")
                        else:
                            cut = block.find(b"\r\n\r\n") + 4
                            head = block[:cut].decode("utf-8", "replace")
                        if kind == "response":
                            payload = block[cut:]
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                            if h.get("warc-payload-digest", f"sha256:{digest}") != f"sha256:{digest}":
                                raise ValueError(f"payload of {h['warc-record-id']} is damaged")
                        elif kind == "revisit":
                            digest = h["warc-payload-digest"].partition(":")[2]
                        rows.append((kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-refers-to"),
                                     h.get("warc-target-uri"), head, payload, size, digest, info))
                        held += len(block)
                        if len(rows) >= 2048 or held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    n = max(1, len(files))
    return (spark.createDataFrame([(f,) for f in files], "file string").repartition(n, "file")
            .mapInArrow(load, RECORD))


def captures(rows: DataFrame) -> DataFrame:
    """One nested row per capture: records meet by the identifier that they are concurrent to.

    Columns: record_id, response (struct; of a response or revisit), payload
    (binary, null for revisits), request (struct), metadata (struct).  One
    shuffle joins all three; requests and metadata without a response go.
    """
    main = F.col("warc_type").isin("response", "revisit")
    of = F.struct("warc_type", "refers_to", "target_uri", "http_head", "payload_bytes", "payload_digest")
    side = F.struct("record_id", "target_uri", "http_head", "info")
    return (rows.withColumn("capture", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
            .groupBy("capture")
            .agg(F.first(F.when(main, of), True).alias("response"),
                 F.first(F.when(main, F.col("payload")), True).alias("payload"),
                 F.first(F.when(F.col("warc_type") == "request", side), True).alias("request"),
                 F.first(F.when(F.col("warc_type") == "metadata", side), True).alias("metadata"))
            .filter(F.col("response").isNotNull())
            .withColumnRenamed("capture", "record_id"))


def resolve(found: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of captures, revisits followed.

    A response's row is light (no payload); the revisits meet it in an outer
    join whose large side is split where one response has very many.  The
    light rows are stored first, so that the archives are parsed once for
    both sides.
    """
    page = F.from_json("metadata.info", "page_id long, url string")
    flat = found.select("record_id", page["page_id"].alias("page_id"), page["url"].alias("url"),
                        F.col("response.warc_type").alias("record_type"), F.col("response.refers_to").alias("target"),
                        F.col("response.payload_bytes").alias("bytes"), F.col("response.payload_digest").alias("payload_digest"))
    flat = staged(flat, "captures")
    held = flat.filter("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("_page"), F.col("bytes").alias("_bytes"))
    return flat.join(held, F.col("target") == F.col("_id"), "left").select(
        "page_id", "url", F.coalesce("bytes", "_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("_page")).alias("refers_to"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC archives, read back and assembled."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = resolve(captures(records(spark, write(pages))))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= {MIN_PAYLOAD} GROUP BY d)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= {MIN_PAYLOAD}
"""
