"""WARC archives: written with revisit records, and read back with their chains verified.

Writing.  A page's payload is its html in UTF-8.  Of records with equal payloads of at
least ``LEAST_BYTES`` bytes the one with the largest id is the response and the others
are revisits that name it; smaller payloads are all responses.  Only digests and ids
are shuffled to find them, never payloads.  Files go through Spark's own writer, so a
lost task leaves nothing behind.  A file holds ``FILE_BYTES`` or less, or one record:
records are written by classes of size, each with its own number to a file.

Reading.  A record's head can only be told from the same bytes inside a payload by the
chain of records that leads to it.  Tasks scan ranges of ``RANGE`` bytes for heads and
emit each as a candidate: its offset, its successor's (from the declared length), and
where the chain from it leaves the range.  From the start of every file, pointers over
ranges then double (pointer jumping) until each range's entry is known; a walk inside
each range from its entry names the records, and all other candidates fall away.  If a chain
does not end where its file ends, reading raises an error and returns nothing; a round
trip also compares the records read with the pages written.

Null html is an empty payload.  Rows that repeat the largest id of equal payloads are
all responses; a null id among equal payloads is a revisit unless all are null, and is
read back as null.  An empty table gives no records.  A page may be as long as a value of
Spark can be, and so may its url; a task holds one file.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import cut, work_path

LEAST_BYTES = 1_000
#: Bytes that a file of more than one record may hold, and a record of the least class.
FILE_BYTES = 128 << 20
SMALL = 64 << 10
#: How many times the bytes of a class the next one takes.
STEP = 8
RANGE = 1 << 20
#: Payloads that occur twice, up to which their list is broadcast.
BROADCAST_ROWS = 500_000

MAGIC = b"WARC/1.1\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"


def write(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Writes one record per row of ``pages`` below ``path``."""
    rows = pages.select(
        F.col(page_id).alias("id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("payload")
    ).withColumn("size", F.octet_length("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    equal = rows.where(F.col("size") >= LEAST_BYTES).groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n"))
    equal = cut(equal.where("n > 1").select("digest", "first"))
    if equal.count() <= BROADCAST_ROWS:
        equal = F.broadcast(equal)
    placed = rows.join(equal, "digest", "left")
    again = (F.col("size") >= LEAST_BYTES) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name,
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(f">\r\nWARC-Profile: {REVISIT}"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.when(again, F.lit(len(HTTP))).otherwise(F.col("size") + len(HTTP)).cast("string"),
        F.lit("\r\n\r\n" + HTTP),
    )
    # A record ends with CR LF CR LF; the writer adds the last LF.
    record = F.concat(head, F.when(again, "").otherwise(F.col("payload")), F.lit("\r\n\r"))
    most = F.octet_length("payload").cast("long") + F.octet_length(F.coalesce("url", F.lit(""))).cast("long") * 3 + 1_000
    classes = F.greatest(F.lit(0), F.ceil(F.log(most / SMALL) / math.log(STEP))).cast("int")
    # Few classes exist: one for each eightfold of bytes.
    for kind in sorted(r[0] for r in rows.select(classes).distinct().collect()) or [0]:
        per_file = max(1, FILE_BYTES // (SMALL * STEP**kind))
        mine = placed.where(classes == kind).select(record.alias("value"))
        mine.write.mode("append").option("lineSep", "\n").option("maxRecordsPerFile", per_file).text(path)


def _field(head: bytes, name: bytes) -> bytes:
    at = head.find(b"\r\n" + name + b": ")
    if at < 0:
        return b""
    at += len(name) + 4
    return head[at : head.find(b"\r\n", at)]


def _candidate(data: memoryview | bytes, at: int):
    """Successor, type, id, digest, size, reference of a head at ``at``; None if it is none."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    head = data[at : end + 2]
    length = _field(head, b"Content-Length")
    if not length.isdigit() or len(length) > 18:
        return None
    block = end + 4
    stop = block + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        return None
    begin = data.find(b"\r\n\r\n", block, stop)
    begin = stop if begin < 0 else begin + 4
    kind = _field(head, b"WARC-Type").decode(errors="replace")
    payload = data[begin:stop]
    digest = hashlib.sha1(payload).hexdigest() if kind != "revisit" else _field(head, b"WARC-Payload-Digest").removeprefix(b"sha1:").decode(errors="replace")
    name, first = (_field(head, f)[len("<urn:page:") : -1].decode(errors="replace") for f in (b"WARC-Record-ID", b"WARC-Refers-To"))
    return stop + 4, kind, name, digest, stop - begin, first, payload


def candidates(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    """Every head-like place of the archives below ``path``."""

    def scan(batches):
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                file, data = file.as_py(), content.as_py()
                rows = []
                for low in range(0, len(data), RANGE):
                    high = min(low + RANGE, len(data))
                    here = []
                    at = data.find(MAGIC, low, high + len(MAGIC) - 1)
                    while at >= 0:
                        found = _candidate(data, at)
                        if found:
                            here.append((at, *found))
                        at = data.find(MAGIC, at + 1, high + len(MAGIC) - 1)
                    leaves: dict[int, int] = {}
                    for row in reversed(here):
                        leaves[row[0]] = leaves.get(row[1], row[1])
                    rows += [(file, low // RANGE, leaves[row[0]], *row) for row in here]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 10
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                names = ["file", "part", "leaves", "offset", "next", "type", "name", "digest", "size", "first"]
                if with_payload:
                    arrays.append(pa.array(columns[10] if rows else [], pa.binary()))
                    names.append("payload")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "file string, part long, leaves long, offset long, next long, type string, name string, digest string, size long, first string"
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(scan, schema + (", payload binary" if with_payload else ""))


def reachable(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from their file's start reaches."""
    jumps = cut(found.select("file", "offset", "leaves"))
    entries = cut(jumps.where("offset = 0").select("file", "offset"))
    n = entries.count()
    while True:
        ahead = entries.join(jumps, ["file", "offset"]).select("file", F.col("leaves").alias("offset"))
        ahead = ahead.join(jumps.select("file", "offset"), ["file", "offset"], "left_semi")
        entries = cut(entries.union(ahead).distinct())
        before, n = n, entries.count()
        if n == before:
            break
        far = jumps.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("far"))
        jumps = cut(jumps.join(far, ["file", "leaves"], "left").select("file", "offset", F.coalesce("far", "leaves").alias("leaves")))
    ranges = found.groupBy("file", "part").agg(F.collect_list(F.struct("offset", "next")).alias("heads"))
    starts = entries.select("file", F.floor(F.col("offset") / RANGE).alias("part"), F.col("offset").alias("start"))

    def walk(batches):
        for batch in batches:
            files, offsets = [], []
            for file, heads, at in zip(*(batch.column(c).to_pylist() for c in ("file", "heads", "start")), strict=True):
                follow = {h["offset"]: h["next"] for h in heads}
                while at in follow:
                    files.append(file)
                    offsets.append(at)
                    at = follow[at]
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(offsets, pa.int64())], names=["file", "offset"])

    return ranges.join(starts, ["file", "part"]).select("file", "heads", "start").mapInArrow(walk, "file string, offset long")


def _whole(spark: SparkSession, path: str, records: DataFrame) -> None:
    """Raises unless the chain of every file below ``path`` ends with the file."""
    ends = records.groupBy("file").agg(F.max("next").alias("end"))
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length")
    broken = files.join(ends, "file", "left").where(~F.col("length").eqNullSafe(F.col("end"))).limit(3).collect()
    if broken:
        raise ValueError("records end before the file: " + ", ".join(f"{r.file} at {r.end} of {r.length}" for r in broken))


def read(spark: SparkSession, path: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """The records below ``path``: page_id, payload_bytes and payload_digest of the full
    payload, record_type, refers_to, and the record's own payload where asked for."""
    found = cut(candidates(spark, path, with_payload))
    records = found.join(reachable(found), ["file", "offset"], "left_semi")
    _whole(spark, path, records)
    identity = lambda c: F.when(F.col(c) != "", F.col(c)).cast(id_type)
    records = records.select(identity("name").alias("page_id"), "type", "digest", "size", identity("first").alias("refers_to"), *(["payload"] if with_payload else []))
    full = records.where("type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "digest").agg(F.max("size").alias("full"))
    own = records.where("type <> 'revisit'").withColumn("full", F.col("size"))
    again = records.where("type = 'revisit'").join(full, ["refers_to", "digest"], "left")
    both = own.unionByName(again)
    return both.select(
        "page_id",
        F.col("full").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", F.col("refers_to")).alias("refers_to"),
        *(["payload"] if with_payload else []),
    )


def round_trip(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` written as archives in the shared folder and read back."""
    path = work_path(pages.sparkSession, "warc")
    write(pages, path, page_id=page_id, url=url, html=html)
    found = cut(read(pages.sparkSession, path, pages.schema[page_id].dataType.simpleString()))
    if (given := pages.count()) != (n := found.count()):
        raise ValueError(f"{given} pages written, {n} records read")
    return found
