"""Write pages as WARC/1.1 archives, resolve repeated payloads to revisit records, read back.

Archives are written by Spark's text writer: a record's header and block are one value and the
two line ends that close a record are the separator, so files get Spark's commit protocol and
go to any file system it knows.  Files are gzipped and cut at a number of records that follows
from their mean size.  Reading unzips a file as a stream and walks it by the Content-Length
fields, so payloads may hold any bytes, and only one record of a file is held at a time.

Revisit resolution shuffles headers alone, by payload digest: the largest page id of equal
payloads of at least `least_bytes` keeps its response record, the others become revisit records
without a payload that refer to it.  What was decided is a list of places for each file, no
longer than the file has records.  It meets the zipped files in a join by path, for which Spark
moves the lists where these are small and the files, still zipped, where they are not; payloads
are unzipped in the task that writes them anew.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import shared_folder, written

LEAST_BYTES = 1000
#: A file is cut at so many records that it has about this many bytes before it is zipped.
FILE_BYTES = 64 << 20
MOST_RECORDS = 10_000
#: Bytes of an archive unzipped, and of records handed on, at a time.
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
# fixed values of the format
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK_TYPE = "application/http; msgtype=response"

HEADER = (
    "page_id long, uri string, kind string, record_id string, refers_to string, "
    "digest string, n_bytes long"
)


def field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null; line ends in values are escaped."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def record_id(page_id: Column, digest: Column, purpose: str) -> Column:
    """A URN that depends on page, payload and archive alone, so a retried task writes the same."""
    md5 = F.md5(F.concat_ws("|", F.lit(purpose), F.coalesce(page_id.cast("string"), F.lit("null")), digest))
    parts = [F.substring(md5, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def as_records(pages: DataFrame, purpose: str, date: str) -> DataFrame:
    """Rows (page_id, uri, kind, digest, n_bytes, payload, refers_page) to record texts."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"),
        F.lit(END),
    )
    revisit = F.col("kind") == "revisit"
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        field("WARC-Type", F.col("kind")),
        field("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"), purpose)),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("uri")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        field("WARC-Profile", F.when(revisit, PROFILE)),
        field(
            "WARC-Refers-To",
            F.when(revisit, record_id(F.col("refers_page"), F.col("digest"), purpose)),
        ),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("Content-Type", F.lit(BLOCK_TYPE)),
        field("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    return pages.withColumn("block", block).select(F.concat(header, "block").alias("value"))


def records_per_file(payloads: DataFrame) -> int:
    """How many of some payloads (n_bytes) make a file, by their mean size."""
    mean = payloads.agg(F.avg("n_bytes")).first()[0] or 0.0
    return int(min(MOST_RECORDS, max(1, FILE_BYTES // (mean + 500))))


def write_archives(records: DataFrame, path: str, per_file: int) -> None:
    writer = records.write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_file).text(path)


class Archive:
    """The bytes of an archive, unzipped as they are asked for."""

    def __init__(self, content: bytes):
        self.rest, self.zipped = memoryview(content), content[:2] == b"\x1f\x8b"
        self.stream, self.held = zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        """Unzip some more; False at the end."""
        if not len(self.rest):
            return False
        part, self.rest = self.rest[:READ_BYTES], self.rest[READ_BYTES:]
        if not self.zipped:
            self.held += part
            return True
        self.held += self.stream.decompress(part)
        while self.stream.eof and (self.stream.unused_data or len(self.rest)):
            left = self.stream.unused_data  # of the next member, if files were put together
            self.stream = zlib.decompressobj(31)
            if left:
                self.held += self.stream.decompress(left)
            else:
                break
        return True

    def upto(self, mark: bytes) -> int:
        """Place of a mark ahead, -1 where there is none."""
        begin = 0
        while (found := self.held.find(mark, begin)) < 0:
            begin = max(0, len(self.held) - len(mark))
            if not self.more():
                return -1
        return found

    def take(self, count: int) -> bytes:
        """The next bytes; fewer at the end."""
        while len(self.held) < count and self.more():
            pass
        taken = bytes(self.held[:count])
        del self.held[:count]
        return taken

    def ended(self) -> bool:
        while not self.held:
            if not self.more():
                return True
        return False


def next_record(archive: Archive, number: int) -> dict:
    """The record at the front of an archive."""
    stop = archive.upto(END.encode())
    head = archive.take(stop + len(END)) if stop >= 0 else b""
    if not head.startswith(VERSION.encode()):
        raise ValueError(f"record {number}: no record where one should begin")
    header = dict(line.split(": ", 1) for line in head[: -len(END)].decode("utf-8").split("\r\n")[1:])
    length = int(header["Content-Length"])
    block = archive.take(length)
    if len(block) < length or archive.take(len(END)) != END.encode():
        raise ValueError(f"record {number} does not end where its length says")
    revisit = header["WARC-Type"] == "revisit"
    payload = None if revisit else block[block.find(END.encode()) + len(END) :]
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"record {number} does not match its digest")
    page = header.get("X-Page-ID")
    return {
        "page_id": None if page is None else int(page),
        "uri": header.get("WARC-Target-URI"),
        "kind": header["WARC-Type"],
        "record_id": header["WARC-Record-ID"],
        "refers_to": header.get("WARC-Refers-To"),
        "digest": digest,
        "n_bytes": None if payload is None else len(payload),
        "payload": payload,
        "bytes": len(head) + length,
    }


HEADER_FIELDS = [
    ("page_id", pa.int64()),
    ("uri", pa.string()),
    ("kind", pa.string()),
    ("record_id", pa.string()),
    ("refers_to", pa.string()),
    ("digest", pa.string()),
    ("n_bytes", pa.int64()),
]
PLACE_FIELDS = [("path", pa.string()), ("place", pa.int64())]


def header_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: archive files to the headers of their records, with file and number."""
    schema = pa.schema([*HEADER_FIELDS, *PLACE_FIELDS])
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            archive, rows, place = Archive(content.as_py()), [], 0
            while not archive.ended():
                record = next_record(archive, place)
                rows.append(record | {"path": path.as_py(), "place": place})
                del rows[-1]["payload"]
                place += 1
                if len(rows) == 4096:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)


FRESH = (
    "page_id long, uri string, digest string, n_bytes long, kind string, refers_page long, payload binary"
)


def fresh_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: archive files with what was decided about them to records to write, some MB at a time."""
    schema = pa.schema(
        [
            *[f for f in HEADER_FIELDS if f[0] in ("page_id", "uri", "digest", "n_bytes")],
            ("kind", pa.string()),
            ("refers_page", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    for batch in batches:
        for content, decided in zip(batch["content"], batch["decided"], strict=True):
            revisits = {d["place"]: d["top"] for d in decided.as_py() or ()}
            archive, rows, held, place = Archive(content.as_py()), [], 0, 0
            while not archive.ended():
                record = next_record(archive, place)
                revisit = place in revisits
                rows.append(
                    {
                        "page_id": record["page_id"],
                        "uri": record["uri"],
                        "digest": record["digest"],
                        "n_bytes": record["n_bytes"],
                        "kind": "revisit" if revisit else "response",
                        "refers_page": revisits.get(place),
                        "payload": None if revisit else record["payload"],
                    }
                )
                held += 0 if revisit else record["bytes"]
                place += 1
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Headers of all records of some archives, checked against their payloads, with their places."""
    return archive_files(spark, path).mapInArrow(header_rows, HEADER + ", path string, place long")


def decisions(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(path, decided): for each file the records that become revisits, and of which page."""
    # written, so that a payload of many records can be split in the join
    held = written(
        headers.where(F.col("n_bytes") >= least_bytes).select("path", "place", "page_id", "digest", "n_bytes")
    )
    top = written(
        held.groupBy("digest", "n_bytes")
        .agg(F.max("page_id").alias("top"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("digest", "n_bytes", "top")
    )
    revisits = held.join(top, ["digest", "n_bytes"]).where(~F.col("page_id").eqNullSafe(F.col("top")))
    return revisits.groupBy("path").agg(F.collect_list(F.struct("place", "top")).alias("decided"))


def archive(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "2026-01-01T00:00:00Z",
    least_bytes: int = LEAST_BYTES,
) -> tuple[str, str]:
    """Write plain archives and the deduplicated ones made from them; return both folders.

    Every row gives one record.  A null html is an empty payload, a null url leaves its field
    out, line ends in a url are escaped.  A row without a page id ranks below all ids; rows that
    repeat the largest id of their payload all stay responses.  An empty table gives empty
    folders.  Columns other than the three named are ignored.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("uri"),
        payload.alias("payload"),
        F.lit("response").alias("kind"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("n_bytes"),
        F.lit(None).cast("long").alias("refers_page"),
    )
    plain, fresh = f"{path}/plain", f"{path}/deduplicated"
    per_file = records_per_file(rows)
    write_archives(as_records(rows, "plain", date), plain, per_file)
    found = decisions(read_headers(spark, plain), least_bytes)
    decided = archive_files(spark, plain).join(found, "path", "left")
    records = decided.select("content", "decided").mapInArrow(fresh_rows, FRESH)
    records = records.withColumn("payload", F.col("payload").cast("string"))
    write_archives(as_records(records, "deduplicated", date), fresh, per_file)
    return plain, fresh


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Per record of deduplicated archives: page_id, payload_bytes, payload_digest, record_type
    and refers_to; a revisit takes size and page id from the response it refers to."""
    responses = records.where("kind = 'response'").select("record_id", "page_id", "n_bytes", "digest")
    targets = responses.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("target"),
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
    )
    revisits = records.where("kind = 'revisit'").select("page_id", "refers_to").join(targets, "refers_to")
    return responses.select(
        "page_id",
        F.col("n_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(
            "page_id",
            "payload_bytes",
            "payload_digest",
            F.lit("revisit").alias("record_type"),
            F.col("target").alias("refers_to"),
        )
    )


def archived_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Archive the pages in the shared folder and report every record as read back."""
    _, fresh = archive(pages, shared_folder(pages.sparkSession), **columns)
    return resolve_revisits(read_headers(pages.sparkSession, fresh))
