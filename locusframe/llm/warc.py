"""WARC archives: write records, index them first, then read selected records by byte ranges.

Archives lie in a folder that all tasks reach (a local shared path, or a store that Arrow's file systems
open). A writing task rolls its archives by size and hands out one index row for each record; these rows,
once written as a table, say which archives count: a task that was lost and ran again leaves files that
no index names. Each record is a gzip member of its own, so any record can be read alone.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder
from .store import written

ARCHIVE_BYTES = 256 << 20
#: Smallest payload that is worth a revisit record.
REVISIT_BYTES = 100
#: Reads of records this near to each other become one, up to the second size.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
INDEX = "archive string, offset long, length long, page_id long, url string, record_type string, payload_digest string, refers_to long"
CRLF = b"\r\n"


def record(page_id: int | None, url: str | None, kind: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no block and names the record it repeats."""
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "2024-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "text/html; charset=utf-8"),
    ]
    if url is not None:
        headers.insert(1, ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if kind == "revisit":
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        payload = b""
    headers.append(("Content-Length", str(len(payload))))
    head = b"WARC/1.1" + CRLF + b"".join(k.encode() + b": " + v.encode("utf-8") + CRLF for k, v in headers)
    return head + CRLF + payload + CRLF + CRLF


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record."""
    head, _, rest = data.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().decode().lower(): v.strip().decode("utf-8") for k, _, v in (line.partition(b":") for line in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def classified(pages: DataFrame) -> DataFrame:
    """Pages with payload_digest, record_type and refers_to.

    Of rows with equal payloads of ``REVISIT_BYTES`` or more, that with the smallest page_id is the
    response. Digests are counted before they are shuffled; only repeated ones are joined back, and Spark
    can split the rows of a hot one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2("html", 256))
    large = rows.filter(F.octet_length("html") >= REVISIT_BYTES)
    owners = large.groupBy("payload_digest").agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = rows.join(owners, "payload_digest", "left")
    revisit = F.col("owner").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("owner")))
    return joined.select("page_id", "url", "html", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("owner")).alias("refers_to"))


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                data = record(row["page_id"], row["url"], row["record_type"], row["html"].encode("utf-8"), row["payload_digest"], row["refers_to"])
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(data) + packer.flush()
                if out is None or at + len(member) > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                out.write(member)
                rows.append((name, at, len(member), row["page_id"], row["url"], row["record_type"], row["payload_digest"], row["refers_to"]))
                at += len(member)
            if rows:
                names = ["archive", "offset", "length", "page_id", "url", "record_type", "payload_digest", "refers_to"]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        if out is not None:
            out.close()

    return run


def write_archives(pages: DataFrame) -> tuple[str, DataFrame]:
    """Write a record per page; the folder of the archives and their index table.

    The index has archive, offset, length, page_id, url, record_type, payload_digest, refers_to. A null
    html is an empty payload.
    """
    spark = pages.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(where)
    folder = system.makeQualified(where).toUri().toString()
    folder = f"file://{folder.removeprefix('file:')}" if folder.startswith("file:") and not folder.startswith("file://") else folder
    return folder, written(classified(pages).mapInArrow(_writer(folder), INDEX), "warc-index")


def _range_reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        opened, file = None, None
        for batch in batches:
            archive, offset, length = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            i = 0
            while i < len(archive):
                j, end = i + 1, offset[i] + length[i]
                while j < len(archive) and archive[j] == archive[i] and offset[j] - end <= GAP_BYTES and offset[j] + length[j] - offset[i] <= READ_BYTES:
                    end = max(end, offset[j] + length[j])
                    j += 1
                if archive[i] != opened:
                    if file is not None:
                        file.close()
                    opened, file = archive[i], store.open_input_file(f"{base}/{archive[i]}")
                data = file.read_at(end - offset[i], offset[i])
                rows = []
                for k in range(i, j):
                    a = offset[k] - offset[i]
                    headers, block = parse_record(zlib.decompress(data[a : a + length[k]], 31))
                    rows.append((_number(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:"), _number(headers.get("warc-refers-to")), block))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                names = ["page_id", "url", "record_type", "stated_digest", "refers_to", "block"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                i = j
        if file is not None:
            file.close()

    return run


def read_records(folder: str, selected: DataFrame) -> DataFrame:
    """The records that index rows name: page_id, url, record_type, stated_digest, refers_to, block.

    Index rows are dealt by stretches of ``READ_BYTES`` of an archive and sorted by offset; neighbouring
    records become one read. Memory is bounded by one read, or by one record if that is larger.
    """
    stretch = F.floor(F.col("offset") / READ_BYTES)
    rows = selected.select("archive", "offset", "length").repartition("archive", stretch).sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(_range_reader(folder), "page_id long, url string, record_type string, stated_digest string, refers_to long, block binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives and read every record back.

    ``pages`` has page_id, url, html. Result, one row per row: page_id, payload_bytes, payload_digest
    (of the payload that was read; a revisit takes both from the response it refers to), record_type,
    refers_to, stated_digest. Equal payloads of ``REVISIT_BYTES`` or more have one response, the smallest
    page_id; a row that repeats that page_id and payload is a response too. A null page_id sorts behind
    all others. Other columns are not read.
    """
    folder, index = write_archives(pages)
    read = read_records(folder, index)
    facts = written(read.select("page_id", "record_type", "refers_to", "stated_digest", F.octet_length("block").cast("long").alias("payload_bytes"), F.sha2("block", 256).alias("payload_digest")), "warc-read")
    answered = facts.filter("record_type = 'response'")
    revisits = facts.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    first = answered.groupBy(F.col("page_id").alias("refers_to"), F.col("stated_digest")).agg(F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "stated_digest"]
    return answered.select(*columns).unionByName(revisits.join(first, ["refers_to", "stated_digest"]).select(*columns))
