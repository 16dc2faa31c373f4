"""WARC archives of pages: written with an index, read back by coalesced ranges of bytes.

Each task writes its pages to archives of its own in the shared folder and returns
the index: file, offset, length, URL and digest of every record. Records with equal
payloads of at least `least` bytes are written once, as the response with the
largest page_id; the others are revisits that name it. Reading begins with the index:
the selected records are sorted by file and offset, and neighbours less than GAP
bytes apart are fetched by one read of at most SPAN bytes.

Archives are named by task attempt, and only those of attempts that Spark committed
are in the index, so lost executors and second attempts do no harm. Folders are
opened by pyarrow's file systems (file, hdfs, s3, gs, abfs).

Defined cases: null html is an empty payload; a null url has no target URI, and
control characters, spaces and angle brackets in one are percent-encoded in the
record, while the index keeps it as it is; rows without page_id come after all others
in the choice of a response; rows that share the response's page_id and payload are
responses as well; very long payloads are written and read whole, one at a time;
an empty table gives no archives and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import shared_folder, written

#: Bytes after which a task begins another archive.
ROLL = 256 << 20
#: Bytes between two records that are read over rather than sought past, and the most that one read takes (a longer record alone).
GAP, SPAN = 64 << 10, 8 << 20
#: Digests of 40 characters that are broadcast at most; more are joined by a shuffle.
MOST_BROADCAST = 200_000
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = "page_id long, url string, digest string, record_type string, refers_to long, file string, offset long, length long"


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a string's bytes: four groups of 40 bits, eight letters each."""
    digits = F.sha1(payload.cast("binary"))
    groups = [F.conv(F.substring(digits, 10 * i + 1, 10), 16, 10).cast("long") for i in range(4)]
    letter = lambda g, s: F.substring(F.lit(ALPHABET), (F.shiftright(g, s).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1))
    return F.concat(*(letter(g, s) for g in groups for s in range(35, -1, -5)))


def planned(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html (null: empty), digest, record_type and refers_to of every page.

    Only digests that occur again are looked up. They are counted map-side, and
    broadcast up to a counted bound; beyond it adaptive execution can split a
    common digest's rows, as both sides of the join are shuffled.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", base32_sha1(F.col("html")))
    known = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
    known = written(known.filter("n > 1").select(F.col("digest").alias("again"), "first_id"), "warc-repeated")
    few = F.broadcast(known) if known.count() <= MOST_BROADCAST else known
    met = rows.join(few, (F.col("digest") == F.col("again")) & (F.octet_length("html") >= least), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return met.select("page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def target(url: str) -> str:
    return "".join(c if "!" <= c <= "~" and c not in "<>" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record: an HTTP message, without its body in a revisit."""
    message = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        message += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {target(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(message)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + message + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in block.decode().split("\r\n")[1:])}


def parsed(raw: bytes) -> tuple[int | None, str, int | None, bytes | None, int, str]:
    """(page_id, record_type, refers_to, payload if the record has one, its size, its digest) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = headers(head)
    message = rest[: int(fields["content-length"])]
    http, _, payload = message.partition(b"\r\n\r\n")
    number = lambda name: None if fields.get(name, "none>").endswith("none>") else int(fields[name].rpartition(":")[2].rstrip(">"))
    size, told = int(headers(http)["content-length"]), fields["warc-payload-digest"].partition(":")[2]
    if fields["warc-type"] == "revisit":
        return number("warc-record-id"), "revisit", number("warc-refers-to"), None, size, told
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if len(payload) != size or digest != told:
        raise ValueError(f"the payload of record {fields['warc-record-id']} is not the one that was written")
    return number("warc-record-id"), "response", None, payload, size, digest


def write_archives(plan: DataFrame, folder: str, compress: bool = False, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The index of the archives that it writes to folder; the archives last, the index is a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        stream, name, at, turn = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, digest, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if stream is None or at >= ROLL:
                        if stream:
                            stream.close()
                        name = f"pages-{context.partitionId():05d}-{context.taskAttemptId()}-{turn}.warc{'.gz' if compress else ''}"
                        stream, at, turn = system.open_output_stream(f"{path}/{name}", compression=None), 0, turn + 1
                    raw = record(page_id, url, html.encode(), digest, kind, refers_to, date)
                    raw = gzip.compress(raw, mtime=0) if compress else raw
                    stream.write(raw)
                    rows.append((page_id, url, digest, kind, refers_to, name, at, len(raw)))
                    at += len(raw)
                if rows:
                    names = [c.split()[0] for c in INDEX.split(", ")]
                    kinds = {"long": pa.int64(), "string": pa.string()}
                    yield pa.RecordBatch.from_arrays([pa.array(x, kinds[c.split()[1]]) for x, c in zip(zip(*rows), INDEX.split(", "))], names=names)
        finally:
            if stream:
                stream.close()

    ship(plan.sparkSession)
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path)
    return written(plan.select("page_id", "url", "html", "digest", "record_type", "refers_to").mapInArrow(run, INDEX), "warc-index")


def spans(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, list[tuple[int, int]]]]:
    """(file, begin, [(offset from begin, length), ...]): reads that take several of the sorted records."""
    name, begin, end, held = None, 0, 0, []
    for file, offset, length in rows:
        if held and (file != name or offset - end > GAP or offset + length - begin > SPAN):
            yield name, begin, held
            held = []
        if not held:
            name, begin = file, offset
        held.append((offset - begin, length))
        end = offset + length
    if held:
        yield name, begin, held


def read_records(index: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """page_id, record_type, refers_to, payload_bytes, payload_digest and, if kept, the payload (null in revisits) of the records that index selects."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        source, opened = None, None
        try:
            for file, begin, held in spans(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))):
                if file != opened:
                    if source:
                        source.close()
                    source, opened = system.open_input_file(f"{path}/{file}"), file
                raw = source.read_at(held[-1][0] + held[-1][1], begin)
                found = [raw[a : a + n] for a, n in held]
                out = list(zip(*(parsed(gzip.decompress(r) if file.endswith(".gz") else r) for r in found)))
                columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.string())]
                names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
                if keep_payload:
                    columns, names = [*columns, pa.array(out[3], pa.binary())], [*names, "payload"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            if source:
                source.close()

    ship(index.sparkSession)
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a stretch of an archive goes to one task, so that a long archive is read by several
    dealt = index.select("file", "offset", "length").repartition(parts, "file", F.floor(F.col("offset") / (4 * SPAN))).sortWithinPartitions("file", "offset")
    schema = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string" + (", payload binary" if keep_payload else "")
    return dealt.mapInArrow(run, schema)


def op12_warc(pages: DataFrame) -> DataFrame:
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    index = write_archives(planned(pages), folder)
    return read_records(index, folder, keep_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP12_SQL = """
with p as (select page_id, coalesce(html, '') as html from pages),
k as (select *, sha1(html) as h, max(page_id) over (partition by html) as first_id from p)
select page_id, strlen(html) as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((cast('0x' || substr(h, 1 + 10 * (i // 8), 10) as bigint) >> cast(35 - 5 * (i % 8) as bigint)) & 31) as bigint), 1) for i in range(32)], '') as payload_digest,
  case when page_id is not distinct from first_id then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first_id then first_id end as refers_to
from k
"""
