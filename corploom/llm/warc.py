"""WARC archives written by Spark and read back by byte range through an index made first."""

from __future__ import annotations

from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corploom.llm.shared import release, shared_folder, shared_table

ARCHIVE_BYTES = 32 << 20
# Turns in which archives are written: shuffle files of one turn's texts lie on disk beside them.
TURNS = 3
# Ranges that lie at most this far apart are read at once, up to READ_BYTES a read.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
# The formats of the archive standard.
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(content: Column) -> Column:
    """SHA-1 in upper-case base32: 10 hex digits are 40 bits, which are 8 base32 digits."""
    digest = F.sha1(content)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _header(date: str) -> Column:
    """The header of a record from the index columns; a target that could break a line is percent-encoded."""
    target = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f\x85]", "%20"), F.lit(""))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(
            F.col("record_type") == "revisit",
            F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")),
        ),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(RECORD_END))


def described(pages: DataFrame, key: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to for each page.

    Payloads seen more than once are found from digests alone; the list of these, written and
    read back, is broadcast only if it is short, and a hot one is split by the adaptive join.
    """
    content = F.coalesce(F.col(html), F.lit(""))
    facts = pages.select(
        F.col(key).alias("page_id"),
        F.col(url).alias("url"),
        content.alias("html"),
        F.octet_length(content).cast("long").alias("payload_bytes"),
        base32_sha1(content).alias("payload_digest"),
    )
    shared = shared_table(
        facts.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n"),
        "warc-shared",
    )
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return facts.join(shared, "payload_digest", "left").select(
        "page_id",
        "url",
        "html",
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one record per page below `folder` and return its index.

    The index is made and stored first: archive, offset and length follow from header and
    payload lengths in the order (page_id, digest, url), which the archives then keep; a record
    is one line of Spark's text writer whose separator is the record end. Of equal payloads of
    at least `min_bytes` bytes, the smallest page_id is the response and others are revisits of
    it; rows that share that page_id, or whose page_id is null throughout, are responses too. A
    null html is an empty payload, a null url an empty target. An empty table gives an empty
    index. The records are shuffled with their texts, each archive into a task of its own, so that tasks
    don't grow with the table; in TURNS turns, each of which reads the table. Past the broadcast limit of the payloads that occur
    more than once, a first shuffle brings each text to its digest.
    """
    records = described(pages, key, url, html, min_bytes)
    header = _header(date)
    size = F.octet_length(header) + F.when(F.col("record_type") == "revisit", 0).otherwise(F.col("payload_bytes"))
    total = records.agg(F.sum(size + len(RECORD_END))).first()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    archive = F.pmod(F.xxhash64(F.col("page_id"), "payload_digest", "url"), F.lit(archives)).cast("int").alias("archive")
    order = ["page_id", "payload_digest", "url"]
    before = Window.partitionBy("archive").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    narrow = records.select(
        "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", archive, size.cast("long").alias("length")
    )
    index = shared_table(
        narrow.withColumn("offset", F.coalesce(F.sum(F.col("length") + len(RECORD_END)).over(before), F.lit(0))), "warc-index"
    )
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("html"))
    values = records.select(*order, archive, F.concat(header, body).alias("value"))
    for turn in range(min(TURNS, archives)):
        own = values.filter(F.col("archive") % TURNS == turn)
        (
            own.repartitionById(-(-archives // TURNS), F.floor(F.col("archive") / TURNS).cast("int"))
            .sortWithinPartitions("archive", *order)
            .select("value", "archive")
            .write.mode("append")
            .partitionBy("archive")
            .option("lineSep", RECORD_END)
            .text(folder)
        )
        release(pages.sparkSession)  # this turn's shuffle files
    return index


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, path) of the files that the writer left; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select(F.col("archive").cast("int").alias("archive"), "path")


READ_SCHEMA = (
    "archive int, offset long, page_id string, url string, record_type string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)
_READ = pa.schema(
    [("archive", pa.int32()), ("offset", pa.int64())]
    + [(c, pa.string()) for c in ("page_id", "url", "record_type", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)


def parse_record(record: bytes) -> dict:
    """The fields of one record and its payload; the payload of a response must have the digest and length of its header."""
    head, _, payload = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins at this offset")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    if len(payload) != int(fields["Content-Length"]):
        raise ValueError("a record of another length lies at this offset")
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        digest_read, size_read = b32encode(sha1(payload).digest()).decode(), len(payload)
        if (digest_read, size_read) != (digest, size):
            raise ValueError("the payload of this record isn't the one that its header describes")
    bare = lambda v: None if v is None else v.removeprefix("<urn:page:").removesuffix(">")
    return {
        "page_id": bare(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": bare(fields.get("WARC-Refers-To")),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload,
    }


def opened(uri: str) -> pa.NativeFile:
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(unquote(urlsplit(uri).path))
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (path, archive, offset, length), sorted within each file, to records; near ranges are one read."""
    for batch in batches:
        rows = batch.to_pylist()
        at = 0
        while at < len(rows):
            first, end, to = rows[at], rows[at]["offset"] + rows[at]["length"], at + 1
            while (
                to < len(rows)
                and rows[to]["path"] == first["path"]
                and 0 <= rows[to]["offset"] - end <= GAP_BYTES
                and rows[to]["offset"] + rows[to]["length"] - first["offset"] <= READ_BYTES
            ):
                end = rows[to]["offset"] + rows[to]["length"]
                to += 1
            with opened(first["path"]) as file:
                file.seek(first["offset"])
                block = file.read(end - first["offset"])
            found = []
            for r in rows[at:to]:
                start = r["offset"] - first["offset"]
                record = parse_record(block[start : start + r["length"]])
                found.append(record | {"archive": r["archive"], "offset": r["offset"]})
            yield pa.RecordBatch.from_pylist(found, schema=_READ)
            at = to


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of `index` point to, read from the archives.

    Select rows of the index beforehand; an archive without selected rows isn't opened. The
    archives must lie where pyarrow can open their address (local or shared paths, s3, gs, hdfs).
    """
    files = archive_files(index.sparkSession, folder)
    wanted = index.select("archive", "offset", "length").join(files, "archive")
    archives = (index.agg(F.max("archive")).first()[0] or 0) + 1
    ranges = wanted.repartitionById(archives, "archive").sortWithinPartitions("path", "offset").select("path", "archive", "offset", "length")
    return ranges.mapInArrow(read_ranges, READ_SCHEMA)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """(index, records) of archives written to the shared folder and read back."""
    folder = shared_folder(pages.sparkSession, "warc")
    index = write_archives(pages, folder, min_bytes=min_bytes)
    if index.isEmpty():
        return index, index.sparkSession.createDataFrame([], READ_SCHEMA)
    return index, read_records(index, folder)
