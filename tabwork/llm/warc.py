"""WARC archives as a chunked record table.

Writing: payloads become a table of rows (record, chunk number, bytes), cut in Spark, of at most
``chunk_bytes`` each. One pass reads the rows of a record in order, carries a running digest and length
from chunk to chunk and leaves both at its last row. Every row of the table then becomes an archive record by itself:
the first chunk a ``response``, the others ``continuation`` records of the same origin, so that no record in an
archive is longer than a chunk and its headers. Equal payloads are written once: the row with the largest id
holds the payload and the others are ``revisit`` records that refer to it. The archives are plain gzip files that
Spark's text writer makes, the blank lines that end a record being its line separator.

Reading: Spark's text reader cuts the files where a record ends and the next one starts. The
writer cuts payloads so that this mark never lies within one record. Chunks of records with more
than one are brought together in order, a bounded number of bytes at a time, and a running
digest and length are carried from chunk to chunk; no record is ever put together. What stays whole
is the cell of the input table that a payload comes from, while Spark cuts it.

Defined results: a NULL payload is empty; rows of one id and payload are each a record, all of
them responses if theirs is the largest id; a NULL id is smaller than every other, and its
revisits refer to nothing; text that looks like WARC is ordinary payload; an empty table gives no
records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwork.llm.common import stored

VERSION = b"WARC/1.1\r\n"
RECORD_END = b"\r\n\r\n"
#: What separates two records of an archive.
MARK = RECORD_END + VERSION
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, n_chunks long"
_TABLE_SCHEMA = "record long, chunk int, last boolean, page_id long, url string, length long, sha1 string, data binary"
_CHUNK_SCHEMA = "record string, chunk int, last boolean, page_id long, declared string, kind string, refers_to long, length long, data binary"


def base32(sha1_hex: Column) -> Column:
    """The bare upper-case base32 form of a SHA-1 in hexadecimal: five digits are four of base 32."""
    parts = [F.lpad(F.conv(F.substring(sha1_hex, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _cuts(payload: bytes, size: int) -> Iterator[tuple[int, int]]:
    """Chunks of at most ``size`` bytes that, with what stands before and behind them, do not hold the mark between records."""
    start = 0
    while True:
        end = min(start + size, len(payload))
        found = (RECORD_END + payload[start:end] + RECORD_END[:2]).find(MARK)
        if found >= 0:
            end = start + found + 2
        yield start, end
        start = end
        if start >= len(payload):
            return


def _record(kind: bytes, name: bytes, fields: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    lines = [b"WARC-Type: " + kind, b"WARC-Record-ID: <" + name + b">", *(k + b": " + v for k, v in fields), b"Content-Length: %d" % len(block)]
    return VERSION + b"\r\n".join(lines) + RECORD_END + block


def _http(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def _numbered(chunk_bytes: int):
    """Rows of the record table from pieces (page_id, url, length, piece, data) of payloads, which follow one another within a task.

    A record's number is made of the task's partition and a serial number in it, so that equal rows are records of their own. A piece is cut
    again where it would hold the mark between records. The last row of a record has the SHA-1 of all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, number, sha, names = TaskContext.get().partitionId() << 40, 0, None, [part.split(" ")[0] for part in _TABLE_SCHEMA.split(", ")]
        for batch in batches:
            rows, size = [], 0
            for i, (piece, length, data) in enumerate(zip(batch.column("piece").to_pylist(), batch.column("length").to_pylist(), batch.column("data"))):
                if piece == 0:
                    record, number, sha = record + 1, 0, hashlib.sha1()
                view = data.as_buffer().to_pybytes()
                sha.update(view)
                ends = (piece + 1) * chunk_bytes >= length
                for start, end in _cuts(view, chunk_bytes):
                    number += 1
                    last = ends and end >= len(view)
                    rows.append((record, number, last, i, length, sha.hexdigest() if last else None, view[start:end]))
                size += len(view)
                if rows and (size > 1 << 22 or i == batch.num_rows - 1):
                    records, numbers, lasts, at, lengths, digests, parts = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(records, pa.int64()), pa.array(numbers, pa.int32()), pa.array(lasts, pa.bool_()), batch.column("page_id").take(pa.array(at)),
                         batch.column("url").take(pa.array(at)), pa.array(lengths, pa.int64()), pa.array(digests, pa.string()), pa.array(parts, pa.binary())], names=names)
                    rows, size = [], 0

    return run


def record_table(pages: DataFrame, chunk_bytes: int = 1 << 16) -> DataFrame:
    """The payloads of (page_id, url, html) as rows (record, chunk, last, page_id, url, length, sha1, data), written to shared storage."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("length", F.octet_length("payload").cast("long"))
    most = F.greatest(F.ceil(F.col("length") / chunk_bytes).cast("int") - 1, F.lit(0))
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), most)))
    data = F.substring("payload", F.col("piece") * chunk_bytes + 1, F.lit(chunk_bytes))
    cut = pieces.select("page_id", "url", "length", "piece", data.alias("data")).mapInArrow(_numbered(chunk_bytes), _TABLE_SCHEMA)
    return stored(pages.sparkSession, cut, "records")


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = 1 << 16, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write (page_id, url, html) as WARC files below ``path``. Payloads of ``min_bytes`` or more are written once."""
    table = record_table(pages, chunk_bytes)
    heads = table.where("last").select("record", F.col("page_id").alias("page"), "sha1", F.col("length").alias("total"))
    owners = heads.where(F.col("total") >= min_bytes).groupBy("sha1").agg(F.max("page").alias("owner"), F.count("*").alias("copies")).where("copies > 1")
    plans = heads.join(owners.select("sha1", "owner"), "sha1", "left").select(
        "record", base32(F.col("sha1")).alias("digest"), "owner", (F.col("owner").isNull() | F.coalesce(F.col("page") == F.col("owner"), F.lit(False))).alias("full"))
    rows = table.drop("sha1").join(plans, "record").where("full OR chunk = 1").withColumn("data", F.when(F.col("full"), F.col("data")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            plain = batch.select(["record", "chunk", "last", "page_id", "url", "length", "digest", "owner", "full"]).to_pylist()
            for row, data in zip(plain, batch.column("data")):
                digest, chunk, http = row["digest"].encode(), row["chunk"], _http(row["length"])
                name = b"urn:page:%s:%d:%s" % (b"" if row["page_id"] is None else b"%d" % row["page_id"], row["record"], digest[:16])
                target = "".join((row["url"] or "").split()).encode()
                fields = [(b"WARC-Date", date.encode()), (b"WARC-Target-URI", target), (b"WARC-Payload-Digest", b"sha1:" + digest), (b"Content-Type", b"application/http; msgtype=response")]
                if not row["full"]:
                    fields += [(b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                    fields += [(b"WARC-Refers-To", b"<urn:page:%d>" % row["owner"])] if row["owner"] is not None else []
                    out.append(_record(b"revisit", name, fields, http))
                    continue
                block, segment = data.as_buffer().to_pybytes(), [(b"WARC-Segment-Number", b"%d" % chunk)]
                size += len(block)
                if chunk == 1:
                    out.append(_record(b"response", name, fields + ([] if row["last"] else segment), http + block))
                else:
                    segment += [(b"WARC-Segment-Origin-ID", b"<" + name + b">"), *fields[:2]]
                    segment += [(b"WARC-Segment-Total-Length", b"%d" % (len(http) + row["length"]))] if row["last"] else []
                    out.append(_record(b"continuation", name + b":%d" % chunk, segment, block))
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})
                    out, size = [], 0
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})

    records = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    records.write.option("lineSep", RECORD_END.decode()).option("compression", "gzip").text(path)


def _number(fields: dict[bytes, bytes], key: bytes) -> int | None:
    value = fields.get(key, b"").strip(b"<>").removeprefix(b"urn:page:").split(b":")[0]
    return int(value) if value else None


def _fields(head: bytes) -> dict[bytes, bytes]:
    return dict(line.split(b": ", 1) if b": " in line else (line.rstrip(b":"), b"") for line in head.split(b"\r\n"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of all records below ``path``: record, chunk number, payload bytes and what the headers say."""
    raw = spark.read.option("lineSep", MARK.decode()).text(path).select(F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split(" ")[0] for part in _CHUNK_SCHEMA.split(", ")]
        for batch in batches:
            rows = {n: [] for n in names}
            for value in batch.column(0):
                value = value.as_buffer().to_pybytes().removeprefix(VERSION)
                if not value:
                    continue
                head, _, block = value.partition(RECORD_END)
                fields = _fields(head)
                size = int(fields[b"Content-Length"])
                if len(block) < size or block[size:].strip(b"\r\n"):
                    raise ValueError(f"record {fields[b'WARC-Record-ID']!r} has {len(block)} bytes, {size} are declared")
                block, kind, length = block[:size], fields[b"WARC-Type"], None
                if kind != b"continuation":
                    http, _, block = block.partition(RECORD_END)
                    length = int(_fields(http.partition(b"\r\n")[2])[b"Content-Length"])
                number = int(fields.get(b"WARC-Segment-Number", b"1"))
                whole = b"WARC-Segment-Number" not in fields
                for n, v in zip(names, (
                    fields.get(b"WARC-Segment-Origin-ID", fields[b"WARC-Record-ID"]).decode(), number, whole or b"WARC-Segment-Total-Length" in fields,
                    _number(fields, b"WARC-Record-ID"), fields.get(b"WARC-Payload-Digest", b"").decode().removeprefix("sha1:") or None, kind.decode(),
                    _number(fields, b"WARC-Refers-To"), length, block,
                )):
                    rows[n].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[n], t) for n, t in zip(names, (pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()))], names=names)

    return raw.mapInArrow(run, _CHUNK_SCHEMA)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record from its chunks in order, carrying digest, length and chunk number from one chunk to the next."""
    record, first, sha, length, number = None, None, None, 0, 0
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "n_chunks")
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        out = []
        columns = [batch.column(n) for n in ("record", "chunk", "last", "page_id", "declared", "kind", "refers_to", "length", "data")]
        for name, chunk, last, page, declared, kind, refers, size, data in zip(*columns):
            if chunk.as_py() == 1:
                first, sha, length, number = (page.as_py(), declared.as_py(), kind.as_py(), refers.as_py(), size.as_py()), hashlib.sha1(), 0, 0
                record = name.as_py()
            if name.as_py() != record or chunk.as_py() != number + 1:
                raise ValueError(f"chunk {chunk} of {name} does not follow chunk {number} of {record}")
            number += 1
            sha.update(data.as_buffer())
            length += len(data.as_buffer())
            if last.as_py():
                if first[2] == "response" and (length, base64.b32encode(sha.digest()).decode()) != (first[4], first[1]):
                    raise ValueError(f"the payload of {record} is not what its headers declare")
                out.append((first[0], first[4], first[1], first[2], first[3], number))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out) if out else [[]] * 6, types)], names=list(names))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: id, payload length and digest, type and what it refers to. Digests and lengths are verified."""
    found = read_chunks(spark, path)
    whole = found.where("chunk = 1 AND last").mapInArrow(_digested, READ_SCHEMA)
    cut = found.where("NOT (chunk = 1 AND last)").repartition("record").sortWithinPartitions("record", "chunk")
    return whole.unionByName(cut.mapInArrow(_digested, READ_SCHEMA))
