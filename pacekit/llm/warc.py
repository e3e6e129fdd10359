"""Legacy archives to WARC: pages -> ARC files -> WARC files -> rows read back.

1. Pages are written as ARC files of versions 1 and 2 (:mod:`pacekit.llm.arc`).
2. The converter reads each ARC file as a whole (files are of bounded size),
   parses headers by the version they declare, and synthesises the WARC fields:
   a record id from the archive position, an ISO timestamp from the 14-digit
   date, the type, and SHA-1 digests of payload and block.
3. Of records with equal payloads the one with the smallest page id is the
   ``response``, the others are ``revisit`` records that refer to it and carry HTTP
   headers only. Equal means equal SHA-1, SHA-256 and length. The choice is
   an aggregation over digests; a revisit's payload is never shuffled.
4. The WARC files are read back by their declared lengths, once: a revisit has the
   id of the record it refers to, and in a field of its own that record's page id.

Files are gzipped and written and read by Spark alone, so any file system that
Spark reads will do. Defined cases: null html is an empty payload; payloads
shorter than ``min_bytes`` are all responses; null urls are ``-``; repeated rows and
pages without an id are records of their own (a null id refers to null and loses
against any other); an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacekit.llm.arc import parse_arc, write_arc
from pacekit.session import scratch_dir

FILE_BYTES = 8 << 20
# The profile of revisits by payload digest.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADS = ("rec string, page_id long, url string, ip string, date string, sha1 string, sha256 string, "
         "payload_bytes long, http string")


def base32_sha1(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(content: bytes) -> tuple[str, bytes]:
    head, gap, payload = content.partition(b"\r\n\r\n")
    return (head + gap).decode("utf-8", "replace"), payload


def http_field(head: str, name: str) -> str | None:
    for line in head.split("\r\n")[1:]:
        key, _, value = line.partition(":")
        if key.lower() == name.lower():
            return value.strip()
    return None


def iso_date(stamp: str) -> str:
    """14 digits (shorter ones are filled up) as a WARC timestamp."""
    s = (stamp + "00000101000000"[len(stamp):])[:14]
    return f"{s[:4]}-{s[4:6]}-{s[6:8]}T{s[8:10]}:{s[10:12]}:{s[12:14]}Z"


def whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(path))
    return files.select("path", "content")


def read_arc(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    """One row per ARC record: heads and digests, or (rec, payload)."""

    def run(batches):
        for batch in batches:
            for name, packed in zip(batch.column("path"), batch.column("content"), strict=True):
                place = "/".join(name.as_py().split("/")[-2:])
                rows = []
                for at, h, body in parse_arc(gzip.decompress(packed.as_py())):
                    head, payload = split_http(bytes(body))
                    rec = f"{place}@{at}"
                    if payloads:
                        rows.append((rec, payload))
                    else:
                        page = http_field(head, "X-Page-Id")
                        rows.append((rec, int(page) if page else None, h["URL"], h["IP-address"], h["Archive-date"],
                                     base32_sha1(payload), hashlib.sha256(payload).hexdigest(), len(payload), head))
                if rows:
                    kinds = OUT_PAYLOAD if payloads else OUT_HEAD
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return whole_files(spark, path, "*.txt.gz").mapInArrow(run, "rec string, payload binary" if payloads else HEADS)


OUT_PAYLOAD = pa.schema([("rec", pa.string()), ("payload", pa.binary())])
OUT_HEAD = pa.schema([("rec", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("ip", pa.string()),
                      ("date", pa.string()), ("sha1", pa.string()), ("sha256", pa.string()),
                      ("payload_bytes", pa.int64()), ("http", pa.string())])


def record_id(rec: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, rec)}>"


def warc_record(row: dict, payload: bytes) -> str:
    """One WARC record without its closing blank lines."""
    block = row["http"].encode() + payload
    kind = row["record_type"]
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(row['rec'])}",
             f"WARC-Date: {iso_date(row['date'])}", f"WARC-Target-URI: {row['url']}", f"WARC-IP-Address: {row['ip']}",
             f"WARC-Payload-Digest: sha1:{row['sha1']}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(row['first_rec'])}",
                  f"WARC-Refers-To-Target-URI: {row['first_url']}",
                  f"WARC-Refers-To-Date: {iso_date(row['first_date'])}"]
        if row["first_page"] is not None:
            lines.append(f"X-Refers-To-Page-Id: {row['first_page']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block.decode("utf-8")


def judge(heads: DataFrame, min_bytes: int) -> DataFrame:
    """Heads with record_type and, for revisits, the position, url and date of the first."""
    key = ["sha1", "sha256", "payload_bytes"]
    # the smallest page id, then the smallest position; a null id comes last
    order = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "rec", "url", "date")
    first = heads.groupBy(*key).agg(F.min(order).alias("f")).select(
        *key, F.col("f.rec").alias("first_rec"), F.col("f.url").alias("first_url"),
        F.col("f.date").alias("first_date"), F.col("f.page_id").alias("first_page"))
    revisit = (F.col("payload_bytes") >= min_bytes) & (F.col("rec") != F.col("first_rec"))
    return heads.join(first, key).withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))


def write_warc(arc_path: str, heads: DataFrame, warc_path: str, min_bytes: int) -> None:
    """Convert ARC files to gzipped WARC files."""
    spark = heads.sparkSession
    judged = judge(heads, min_bytes)
    responses = judged.filter("record_type = 'response'").join(read_arc(spark, arc_path, True), "rec")
    # revisits carry no payload, so a payload that many pages share is not moved for them
    revisits = judged.filter("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    rows = responses.unionByName(revisits)
    names = rows.columns

    def run(batches):
        for batch in batches:
            values = [warc_record(r, r["payload"] or b"") for r in batch.select(names).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

    records = rows.mapInArrow(run, "value string")
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", 5000).text(warc_path)


def parse_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields, block) of every record, by declared length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        length = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length or data[end + 4 + length:end + 8 + length] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where it says")
        yield fields, block
        at = end + 8 + length


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record: page_id, record ids, type, digest and length of the full payload.

    Digests and lengths of responses are taken from the bytes, and must agree
    with the header; those of revisits come from their headers.
    """

    def run(batches):
        for batch in batches:
            for packed in batch.column("content"):
                rows = []
                for f, block in parse_warc(gzip.decompress(packed.as_py())):
                    head, payload = split_http(block)
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    if base32_sha1(block) != f["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError("block digest")
                    if f["WARC-Type"] == "response" and base32_sha1(payload) != digest:
                        raise ValueError("payload digest")
                    page, first = http_field(head, "X-Page-Id"), f.get("X-Refers-To-Page-Id")
                    rows.append((int(page) if page else None, f["WARC-Record-ID"], f["WARC-Type"], f["WARC-Date"],
                                 f["WARC-Target-URI"], digest, int(http_field(head, "Content-Length")),
                                 zlib.crc32(payload), f.get("WARC-Refers-To"), int(first) if first else None))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), OUT_WARC, strict=True)],
                        schema=OUT_WARC)

    return whole_files(spark, path, "*.txt.gz").mapInArrow(
        run, "page_id long, record_id string, record_type string, date string, url string, payload_digest string, "
             "payload_bytes long, payload_crc32 long, refers_to_record string, refers_to long")


OUT_WARC = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                      ("date", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
                      ("payload_bytes", pa.int64()), ("payload_crc32", pa.int64()), ("refers_to_record", pa.string()),
                      ("refers_to", pa.int64())])


def convert_pages(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Pages through ARC and WARC files; the rows of :func:`read_warc`."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    arc_path, warc_path = scratch_dir(spark, "arc"), scratch_dir(spark, "warc")
    write_arc(rows, arc_path, file_bytes)
    write_warc(arc_path, read_arc(spark, arc_path, False), warc_path, min_bytes)
    return read_warc(spark, warc_path)
