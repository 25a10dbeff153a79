"""Legacy archives to WARC: ARC files are parsed by their header lines and declared lengths, and equivalent records written.

An ARC file begins with a version block that names the fields of every record's header line: URL, address, date, type and
length in version 1, and result code, checksum, location, offset and file name besides in version 2. The converter reads a
file by the declared lengths, never by searching for the next header, and makes for each record a WARC identifier (from
what the record is, so that a repeated task makes the same one), an ISO date, a record type and SHA-1 digests. Of records
with equal payloads the one with the largest source id is a response and the others revisit it. Archives are written by
Spark's text writer, gzip-compressed, a bounded number of records per file, to the shared folder; the reader streams
them record by record.

Defined cases: a null payload is empty, and empty payloads are equal to each other; a null URL is written as `-`; rows that
repeat an id are each written; an empty table makes no archive and gives an empty table; other columns are ignored.
"""

import base64
import gzip
import hashlib
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.skew import own_shuffle
from ..session import scratch_path
from .common import bounded_batches, map_batches, registry, table

QUERIES, SQL, query = registry()

# Field names of the header lines of both versions.
FIELDS = {
    b"1": ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    b"2": ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
SOURCE_ID = b"X-Source-Id"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 1000
RECORD = ("record_id string, source_id long, url string, ip string, date string, payload_digest string, payload_bytes long, "
          "http_header binary, payload binary")


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# Writing ARC: the legacy input of the converter.

def arc_record(version: bytes, url, ip, date, mime, content: bytes, offset: int, name: str) -> bytes:
    url = re.sub(r"\s", "%20", url or "") or "-"
    fields = [url, ip, date, mime] + (["200", sha1_32(content), "-", str(offset), name] if version == b"2" else []) + [str(len(content))]
    return " ".join(fields).encode() + b"\n" + content + b"\n"


def arc_version_block(version: bytes, name: str, date: str) -> bytes:
    body = version + b" 0 Archive\n" + " ".join(FIELDS[version]).encode() + b"\n"
    head = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"] + (["200", "-", "-", "0", name] if version == b"2" else []) + [str(len(body))]
    return " ".join(head).encode() + b"\n" + body + b"\n"


def arc_files(pages: DataFrame, id_col="page_id", url_col="url", html_col="html", date="20240101000000", ip="0.0.0.0") -> DataFrame:
    """Pages as ARC files, one per batch of rows and of either version: name, content."""
    def step(batch):
        ids, urls, htmls = (batch.column(n).to_pylist() for n in ("id", "url", "html"))
        name = f"pages-{ids[0]}.arc"
        version = b"12"[(ids[0] or 0) % 2:][:1]
        out = [arc_version_block(version, name, date)]
        at = len(out[0])
        for i, url, html in zip(ids, urls, htmls):
            header = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % len(html)]
            header += [SOURCE_ID + b": %d" % i] if i is not None else []
            out.append(arc_record(version, url, ip, date, "text/html", b"\r\n".join(header) + b"\r\n\r\n" + html, at, name))
            at += len(out[-1])
        return {"name": [name], "content": [b"".join(out)]}
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary").alias("html"))
    return map_batches(rows, step, "name string, content binary")


# Reading ARC.

def arc_records(content: bytes):
    """(header fields by name, content) of each record after the version block."""
    at, fields = 0, None
    while at < len(content):
        if content[at:at + 1] == b"\n":
            at += 1
            continue
        end = content.index(b"\n", at)
        line = content[at:end].decode("utf-8", "replace").split(" ")
        length = int(line[-1])
        body = content[end + 1:end + 1 + length]
        if len(body) < length:
            raise ValueError(f"a record at {at} declares {length} bytes; {len(body)} are left")
        if fields is None:
            version = body.split(b" ", 1)[0]
            fields = body.split(b"\n")[1].decode().split(" ") if version in FIELDS else None
            if fields is None:
                raise ValueError(f"ARC version {version!r} is unknown")
        else:
            if len(line) != len(fields):
                raise ValueError(f"a header line at {at} has {len(line)} of {len(fields)} fields")
            yield dict(zip(fields, line)), body
        at = end + 1 + length


def http_parts(block: bytes):
    """Header with its blank line, and payload; a block without a status line is all payload."""
    end = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
    return (block[:end + 4], block[end + 4:]) if end >= 0 else (b"", block)


def http_field(header: bytes, name: bytes):
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", header)
    return found.group(1) if found else None


def convert(files: DataFrame, content_col="content", with_payload=True) -> DataFrame:
    """One row per record of the ARC files, with what its WARC record needs."""
    bounded_batches(files.sparkSession)
    schema = RECORD if with_payload else RECORD.replace(", http_header binary, payload binary", "")
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows = {n: [] for n in out.names}
                size = 0
                for fields, body in arc_records(content or b""):
                    header, payload = http_parts(body)
                    source, digest = http_field(header, SOURCE_ID), sha1_32(payload)
                    date = fields["Archive-date"]
                    row = {
                        "source_id": int(source) if source is not None else None, "url": fields["URL"], "ip": fields["IP-address"],
                        "date": f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z",
                        "payload_digest": digest, "payload_bytes": len(payload), "http_header": header, "payload": payload,
                        "record_id": str(uuid.uuid5(uuid.NAMESPACE_URL, f"{fields['URL']} {date} {source} {digest}")),
                    }
                    for n in out.names:
                        rows[n].append(row[n])
                    size += len(body)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pydict(rows, schema=out)
                        rows, size = {n: [] for n in out.names}, 0
                if rows["record_id"]:
                    yield pa.RecordBatch.from_pydict(rows, schema=out)
    return files.select(content_col).mapInArrow(run, schema)


# Writing WARC.

def with_types(records: DataFrame, slim: DataFrame, least_bytes=0) -> DataFrame:
    """Records with `target` (the response that a revisit stands for), null for responses. `slim` are the same records without payloads."""
    groups = (slim.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max(F.struct("source_id", "record_id", "url", "date")).alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = records.join(own_shuffle(groups), ["payload_digest", "payload_bytes"], "left")
    return joined.withColumn("target", F.when(F.col("target.record_id") != F.col("record_id"), F.col("target")))


def warc_record(row) -> bytes:
    """Header and block of one record; the writer adds the two line ends behind it."""
    target, header = row["target"], row["http_header"]
    block = header if target else header + row["payload"]
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if target else 'response'}", f"WARC-Record-ID: <urn:uuid:{row['record_id']}>",
             f"WARC-Date: {row['date']}", f"WARC-Target-URI: {row['url']}", f"WARC-IP-Address: {row['ip']}",
             f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"WARC-Block-Digest: sha1:{sha1_32(block)}"]
    if target:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:uuid:{target['record_id']}>",
                  f"WARC-Refers-To-Target-URI: {target['url']}", f"WARC-Refers-To-Date: {target['date']}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def write_warc(records: DataFrame, path: str) -> None:
    """Archives under `path`, each a gzip file of whole records."""
    made = map_batches(records, lambda batch: {"record": [warc_record(r) for r in batch.to_pylist()]}, "record binary")
    (made.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


# Reading WARC.

def warc_records(stream):
    """(fields by lower-case name, block) of each record of a stream, one at a time, by declared lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.decode().lower()] = value.decode("utf-8", "replace").strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("an archive ends within a record")
        yield fields, block


def read_warc(spark, path: str, with_payload=False) -> DataFrame:
    """One row per record of the archives under `path`; digests are computed anew where the payload is there."""
    schema = ("record_id string, source_id long, url string, date string, record_type string, refers_to_id string, "
              "payload_digest string, payload_bytes long" + ", payload binary" * with_payload)
    out = to_arrow_schema(StructType.fromDDL(schema))
    bounded_batches(spark)

    def run(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, size = {n: [] for n in out.names}, 0
                for f, block in warc_records(gzip.GzipFile(fileobj=io.BytesIO(content))):
                    header, payload = http_parts(block)
                    revisit = f["warc-type"] == "revisit"
                    source = http_field(header, SOURCE_ID)
                    stated = f["warc-payload-digest"].removeprefix("sha1:")
                    if sha1_32(block) != f["warc-block-digest"].removeprefix("sha1:") or not revisit and sha1_32(payload) != stated:
                        raise ValueError(f"the digest of {f['warc-record-id']} is wrong")
                    row = {"record_id": f["warc-record-id"][10:-1], "source_id": int(source) if source is not None else None,
                           "url": f["warc-target-uri"], "date": f["warc-date"], "record_type": f["warc-type"],
                           "refers_to_id": f["warc-refers-to"][10:-1] if revisit else None, "payload_digest": stated,
                           "payload_bytes": int(http_field(header, b"Content-Length") or 0) if revisit else len(payload), "payload": payload}
                    for n in out.names:
                        rows[n].append(row[n])
                    size += len(payload) if with_payload else 0
                    if size > 8 << 20 or len(rows["url"]) >= 4096:
                        yield pa.RecordBatch.from_pydict(rows, schema=out)
                        rows, size = {n: [] for n in out.names}, 0
                if rows["url"]:
                    yield pa.RecordBatch.from_pydict(rows, schema=out)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.select("content").mapInArrow(run, schema)


def convert_archives(files: DataFrame, path: str, least_bytes=0) -> DataFrame:
    """ARC files to WARC archives under `path`, and what they hold when they are read back."""
    write_warc(with_types(convert(files), convert(files, with_payload=False), least_bytes), path)
    return read_warc(files.sparkSession, path)


@query()
def op6_arc_to_warc(spark, sf_dir):
    """All pages by way of ARC files into WARC archives and back."""
    read = convert_archives(arc_files(table(spark, sf_dir, "pages")), scratch_path(spark, "warc"))
    responses = read.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("source_id").alias("refers_to")).dropDuplicates(["refers_to_id"])
    return read.join(own_shuffle(responses), "refers_to_id", "left").select(
        F.col("source_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
