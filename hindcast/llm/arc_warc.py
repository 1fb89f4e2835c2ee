"""Legacy archive converter: ARC files of version 1 or 2 become WARC files of the same captures.

An ARC file opens with a version block that names its columns; every record is a header line with those columns, of
which the last is the declared length, and so many bytes. The converter follows the declared lengths alone. It
synthesises a record id from file and offset, a date from the 14 digits, a type (``warcinfo`` from the version block,
``response`` from an HTTP message, ``resource`` otherwise) and a SHA-1 payload digest in base 32. Payloads of
``LEAST_BYTES`` or more that were archived before become ``revisit`` records: of equal payloads the capture with the
largest page id stays a response, the others keep their HTTP head and refer to it.

Archives are written by Spark's text writer, whose line separator is the end of a record, one file per partition, and
read as whole binary files that are unpacked as a stream; a file is as large as a scan partition. The reader takes
plain files, files of one gzip member and files of one member per record.

Defined results: a null page counts as empty; a null url is archived as ``unknown:``; blanks and controls in a url are
percent-encoded; a null page id leaves out the header that carries it, and such a capture is never referred to while an
equal one has an id; rows that repeat the largest id all stay responses; an empty table writes no records; other columns
are ignored. A file that ends inside a record raises an error, and so does a payload that does not have its digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import datetime
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.common import scratch, settled, small_batches

LEAST_BYTES = 1000
# Fixed values of the formats.
COLUMNS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_ID = "X-Page-Id"
FIRST_DATE = 1_704_067_200  # captures are dated from here on, one second per page id
BATCH_BYTES = 8 << 20

ARC_LAYOUT = (
    "kind string, record_id string, page_id long, url string, ip string, date string, content_type string, head binary, "
    "payload binary, payload_bytes long, digest string")
WARC_LAYOUT = (
    "kind string, record_id string, page_id long, url string, date string, refers_to_id string, payload_bytes long, "
    "digest string, payload binary")


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC files of page_id, url, html; partitions alternate between the two versions."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    page = F.col("page_id").cast("long")
    url = F.regexp_replace(F.coalesce(F.nullif(F.col("url").cast("string"), F.lit("")), F.lit("unknown:")), r"[\x00-\x20\x7f]", "%20")
    date = F.date_format(F.timestamp_seconds(F.lit(FIRST_DATE) + F.coalesce(F.abs(page) % 1_000_000_000, F.lit(0))), "yyyyMMddHHmmss")
    message = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(F.concat(F.lit(f"{PAGE_ID}: "), page.cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html)
    second = F.spark_partition_id() % 2 == 1
    def opening(version: int) -> str:
        body = f"{version} 0 Hindcast\n{COLUMNS[version]}\n"
        extra = "200 - - 0 - " if version == 2 else ""
        return f"filedesc://pages.arc 0.0.0.0 20240101000000 text/plain {extra}{len(body)}\n{body}\n"

    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    start = F.when(first, F.when(second, opening(2)).otherwise(opening(1))).otherwise("")
    (
        pages.select(message.alias("message"), url.alias("url"), date.alias("date"), F.col("page_id"))
        .select(F.concat(
            start, F.col("url"), F.lit(" 0.0.0.0 "), F.col("date"), F.lit(" text/html "),
            F.when(second, F.lit("200 - - 0 - ")).otherwise(""), F.octet_length("message").cast("string"), F.lit("\n"),
            F.col("message")).alias("value"))
        .write.option("compression", "gzip").text(path))


def opened(content: bytes) -> BinaryIO:
    """The bytes of an archive, unpacked while they are read."""
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def exactly(file: BinaryIO, n: int) -> bytes:
    out = file.read(n)
    if len(out) != n:
        raise ValueError(f"the archive ends {n - len(out)} bytes before the declared length")
    return out


def arc_records(file: BinaryIO) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, columns, bytes) of every record, the version block first."""
    columns = COLUMNS[1].split()
    while line := file.readline():
        if not line.strip():
            continue
        offset = file.tell() - len(line)
        names = columns
        if line.startswith(b"filedesc:"):
            # Its own columns are told by how many there are.
            names = next((c.split() for c in COLUMNS.values() if line.count(b" ") == c.count(" ")), columns)
        values = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header line at byte {offset}")
        record = dict(zip(names, values))
        body = exactly(file, int(values[-1]))
        if record["URL"].startswith("filedesc:"):
            columns = body.split(b"\n")[1].decode().split()
        yield offset, record, body


def message_parts(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload; no head for anything else."""
    if body.startswith(b"HTTP/"):
        head, gap, payload = body.partition(b"\r\n\r\n")
        if gap:
            return head + gap, payload
    return b"", body


def header_of(head: bytes, name: str) -> str | None:
    for line in head.decode("latin-1").split("\r\n"):
        key, colon, value = line.partition(":")
        if colon and key.strip().lower() == name.lower():
            return value.strip()
    return None


def number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def record_id(path: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{path}@{offset}'.encode()).digest())}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def arc_row(path: str, offset: int, record: dict[str, str], body: bytes) -> tuple:
    head, payload = message_parts(body)
    url = record["URL"]
    kind = "warcinfo" if url.startswith("filedesc:") else "response" if head else "resource"
    content = {"warcinfo": "text/plain", "response": "application/http; msgtype=response"}.get(kind, record["Content-type"])
    date = datetime.strptime(record["Archive-date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    return (
        kind, record_id(path, offset), number(header_of(head, PAGE_ID)), url, record["IP-address"], date, content, head,
        payload, len(payload), base32_sha1(payload))


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the ARC files below ``path``; ``payloads=False`` leaves head and payload out."""
    return whole_files(spark, path, ARC_LAYOUT, ("head", "payload"), payloads, lambda file, name: (
        arc_row(name, *x) for x in arc_records(file)))


def whole_files(spark, path, layout, large, keep, rows_of) -> DataFrame:
    """Rows that a reader finds in binary files, sent on in batches of bounded bytes."""
    small_batches(spark)
    names = [c.split()[0] for c in layout.split(", ")]
    kinds = dict(c.split() for c in layout.split(", "))
    kept = [n for n in names if keep or n not in large]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                held, size = [], 0
                for row in rows_of(opened(content), name.rsplit("/", 1)[-1]):
                    held.append(row)
                    size += sum(len(x) for x in row if isinstance(x, bytes)) + 200
                    if size > BATCH_BYTES:
                        yield frame(held)
                        held, size = [], 0
                yield frame(held)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)[kept]
        for n in kept:
            if kinds[n] == "long":
                out[n] = out[n].astype("Int64")
        return out

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(read, ", ".join(f"{n} {kinds[n]}" for n in kept))


def revisits(records: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """record_id, refers_to_id: captures whose payload another capture with a larger page id has as well."""
    small = records.where((F.col("kind") == "response") & (F.col("payload_bytes") >= least)).select(
        "record_id", "page_id", "digest", "payload_bytes")
    best = (
        small.groupBy("digest", "payload_bytes").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "record_id")).alias("best"))
        .where((F.col("n") > 1) & F.col("best.page_id").isNotNull()))
    return small.join(best, ["digest", "payload_bytes"]).where(
        F.col("page_id").isNull() | (F.col("page_id") < F.col("best.page_id"))
    ).select("record_id", F.col("best.record_id").alias("refers_to_id"))


def write_warc(records: DataFrame, roles: DataFrame, path: str) -> None:
    """WARC files of ARC records; those named in ``roles`` become revisits without a payload."""
    def header(name: str, value) -> F.Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    again = F.col("refers_to_id").isNotNull()
    block = F.concat(F.col("head").cast("string"), F.when(again, "").otherwise(F.col("payload").cast("string")))
    value = F.concat(
        F.lit(f"{WARC}\r\nWARC-Type: "), F.when(again, "revisit").otherwise(F.col("kind")), F.lit("\r\n"),
        header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Date", F.col("date")),
        header("WARC-Target-URI", F.when(F.col("kind") != "warcinfo", F.col("url"))),
        header("WARC-IP-Address", F.when(F.col("kind") != "warcinfo", F.col("ip"))),
        header("WARC-Payload-Digest", F.when(F.col("kind") != "warcinfo", F.concat(F.lit("sha1:"), F.col("digest")))),
        header("WARC-Refers-To", F.col("refers_to_id")),
        header("WARC-Profile", F.when(again, REVISIT_PROFILE)),
        header("Content-Type", F.col("content_type")),
        header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block"))
    (
        records.join(roles, "record_id", "left").withColumn("block", block).select(value.alias("value"))
        .write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path))


def warc_rows(file: BinaryIO, name: str) -> Iterator[tuple]:
    """One row per record, with the payload's true length and hexadecimal digest."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record in {name}")
        head = {}
        while (line := file.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            head[key.strip().lower()] = value.strip()
        block = exactly(file, int(head["content-length"]))
        http, payload = message_parts(block)
        kind = head["warc-type"]
        digest = head.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "revisit":
            size = number(header_of(http, "Content-Length"))
        else:
            size = len(payload)
            if digest and base32_sha1(payload) != digest:
                raise ValueError(f"a payload in {name} does not have its digest")
        yield (
            kind, head["warc-record-id"], number(header_of(http, PAGE_ID)), head.get("warc-target-uri"), head["warc-date"],
            head.get("warc-refers-to"), size, base64.b32decode(digest).hex() if digest else None,
            None if kind == "revisit" else payload)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    return whole_files(spark, path, WARC_LAYOUT, ("payload",), payloads, warc_rows)


def convert(spark: SparkSession, arc: str, warc: str, least: int = LEAST_BYTES) -> None:
    """ARC files below ``arc`` to WARC files below ``warc``."""
    roles = settled(revisits(settled(read_arc(spark, arc, payloads=False), "arc-records"), least), "revisits")
    write_warc(read_arc(spark, arc), roles, warc)


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: pages after a round through both formats."""
    spark = pages.sparkSession
    arc, warc = scratch(spark, "arc"), scratch(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    records = settled(read_warc(spark, warc, payloads=False).where(F.col("kind").isin("response", "revisit")), "warc-records")
    targets = records.where(F.col("kind") == "response").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return records.join(targets, "refers_to_id", "left").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")
