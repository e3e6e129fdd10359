"""ARC archives (versions 1 and 2): writing, and parsing by declared lengths.

A version block heads every file: its URL is ``filedesc://``, its body gives
the version and the names of the header fields. Every record is one header
line, as many bytes as the line declares, and a newline.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The header fields that the version block of each version declares.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CAPTURED = "20240101000000"
ORIGIN = "pacekit"


def version_block(version: int, name: str) -> str:
    body = f"{version} 0 {ORIGIN}\n{FIELDS[version]}\n"
    line = f"filedesc://{name} 0.0.0.0 {CAPTURED} text/plain"
    if version == 2:
        line += f" 200 - - 0 {name}"
    return f"{line} {len(body)}\n{body}"


def header_safe(value: Column) -> Column:
    """A value as one space-free field: white space and controls as %XX, ``-`` if empty.

    Percent signs stay, so a URL that is escaped already is not escaped again.
    """
    out = value
    for c in (*range(0x21), 0x7F):
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return F.when(F.coalesce(F.length(value), F.lit(0)) == 0, F.lit("-")).otherwise(out)


def arc_records(pages: DataFrame, file_bytes: int) -> DataFrame:
    """(_version, _file, _seq, value): the lines of ARC files of about ``file_bytes``.

    ``pages`` has page_id, url, html (no nulls in html). The record's content is an HTTP
    response whose headers carry the page id and the payload's length.
    """
    spark = pages.sparkSession
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: "),
                    F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit("\r\n\r\n"), F.col("html"))
    total = pages.agg(F.sum(F.octet_length("html") + F.lit(400))).first()[0] or 0
    files = max(1, -(-int(total) // file_bytes))
    # two versions by turns; a page's file follows from its id and payload
    file = F.pmod(F.xxhash64("page_id", "html"), F.lit(files)).cast("int")
    rows = pages.select(
        (file % 2 + 1).alias("_version"), file.alias("_file"), F.xxhash64("page_id", "html").alias("_seq"),
        header_safe(F.col("url")).alias("url"), http.alias("content"))
    ip, code = F.lit("192.0.2.1"), F.lit("200 - - 0")
    name = F.concat(F.lit("pages-"), F.col("_file").cast("string"), F.lit(".arc"))
    size = F.octet_length("content").cast("string")
    line = F.when(F.col("_version") == 1, F.concat_ws(" ", "url", ip, F.lit(CAPTURED), F.lit("text/html"), size)).otherwise(
        F.concat_ws(" ", "url", ip, F.lit(CAPTURED), F.lit("text/html"), code, name, size))
    records = rows.select("_version", "_file", F.lit(1).alias("_part"), "_seq",
                          F.concat(line, F.lit("\n"), F.col("content")).alias("value"))
    heads = spark.range(files).select(
        (F.col("id") % 2 + 1).cast("int").alias("_version"), F.col("id").cast("int").alias("_file"), F.lit(0).alias("_part"),
        F.lit(0).cast("long").alias("_seq"),
        F.when(F.col("id") % 2 == 0, F.lit(version_block(1, "pages.arc"))).otherwise(F.lit(version_block(2, "pages.arc"))).alias("value"))
    return records.unionByName(heads)


def write_arc(pages: DataFrame, path: str, file_bytes: int) -> None:
    """Gzipped ARC files, one per ``_file``, each headed by its version block."""
    rows = arc_records(pages, file_bytes)
    rows = rows.repartition("_file").sortWithinPartitions("_file", "_part", "_seq")
    (rows.select("_file", "value").write.partitionBy("_file").option("lineSep", "\n")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def parse_arc(data: bytes) -> Iterator[tuple[int, dict, memoryview]]:
    """(offset, header fields, content) of every record after the version block.

    The version block says which fields a header line has; a URL may hold
    spaces in files of sloppy writers, so fields are taken from the right. The
    declared length alone ends a record.
    """
    at, fields, view = 0, None, memoryview(data)
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):                 # record separators
            at += 1
            continue
        end = data.index(b"\n", at)
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        length = int(line.rpartition(" ")[2])
        body = view[end + 1:end + 1 + length]
        if len(body) < length:
            raise ValueError(f"record at {at} declares {length} bytes, {len(body)} are left")
        if line.startswith("filedesc://"):
            declared = bytes(body).decode("utf-8", "replace").split("\n")
            version = int(declared[0].split()[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version}")
            fields = declared[1].split()
        elif fields is None:
            raise ValueError("no version block")
        else:
            parts = line.rsplit(" ", len(fields) - 1)
            if len(parts) != len(fields):
                raise ValueError(f"header of {len(parts)} fields, {len(fields)} declared: {line[:200]}")
            yield at, dict(zip(fields, parts, strict=True)), body
        at = end + 1 + length
