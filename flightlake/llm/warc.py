"""WARC archives: write records with an index, and read selected records back in coalesced ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.session import materialise, work_folder

#: Bytes after which an archive is closed and the task starts another.
ARCHIVE_BYTES = 1_000_000_000
#: Bytes between two wanted records that are read over rather than skipped, and the longest range.
MOST_GAP = 64_000
MOST_RANGE = 8_000_000
#: Bytes of records that one task reads; the index alone would look small enough for a single task.
TASK_BYTES = 16_000_000
WARC_DATE = "2024-01-01T00:00:00Z"
UNSAFE = re.compile(r"[\x00-\x20\x7f-\xff<>]")

INDEX = (
    "archive string, offset long, length long, url string, digest string, "
    "record_type string, page_id long, row long"
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: dict, payload: bytes | None) -> bytes:
    """One WARC/1.1 record: a whole response, or a revisit that only has the response's HTTP head."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += b"Content-Length: %d\r\n\r\n" % page["payload_bytes"]
    block = head if payload is None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {page['record_type']}",
        f"WARC-Record-ID: {record_id(page['page_id'], page['row'])}",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Payload-Digest: sha1:{page['digest']}",
        f"Content-Length: {len(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page["url"] is not None:
        lines.append(f"WARC-Target-URI: {safe_uri(page['url'])}")
    if payload is None:
        lines.append(f"WARC-Refers-To: {record_id(page['refers_to'], page['refers_row'])}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def safe_uri(url: str) -> str:
    """Control characters, blanks and angle brackets percent-encoded; any other character as it is."""
    return UNSAFE.sub(lambda m: quote(m[0]), url)


def record_id(page_id: int | None, row: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{row}>"


def from_record_id(text: str) -> tuple[int | None, int]:
    page_id, row = text.strip("<>").split(":")[2:]
    return int(page_id) if page_id else None, int(row)


def parse(raw: bytes) -> dict:
    """A record's fields; the payload is None for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    page_id, row = from_record_id(fields["WARC-Record-ID"])
    refers = fields.get("WARC-Refers-To")
    return {
        "page_id": page_id,
        "row": row,
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": from_record_id(refers)[0] if refers else None,
        "payload": None if refers else payload,
    }


def decided(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Adds payload_bytes, digest, record_type, refers_to and refers_row to (page_id, url, html, row).

    Only digests are grouped, summed up before their shuffle; payloads are
    joined to the few digests that occur twice or more.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    keyed = pages.withColumns({"payload_bytes": F.octet_length(payload).cast("long"), "sha1": F.sha1(payload)})
    many = (
        keyed.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("sha1")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "row")).alias("kept"))
        .where("n > 1")
        .select("sha1", "kept")
    )
    many = materialise(many, "warc-digests")
    revisit = F.col("kept.row") != F.col("row")
    return keyed.join(many, "sha1", "left").select(
        "page_id",
        "url",
        F.when(~F.coalesce(revisit, F.lit(False)), F.col("html")).alias("html"),
        "row",
        "payload_bytes",
        "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("kept.page_id")).alias("refers_to"),
        F.when(revisit, F.col("kept.row")).alias("refers_row"),
    )


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes a record per row of (page_id, url, html) and returns the written index.

    Each task writes gzip-compressed records, one member each, to archives of
    its own below ``folder``, a URI that all executors reach; a task that is run
    again writes new files, and the index names only those of the run that
    counted. Payloads are the html in UTF-8, a null one empty. Of rows with
    equal payloads of at least ``least_bytes`` the one with the largest page_id
    is the response, and of several such rows one; the others revisit it. Null
    page_ids sort first, null urls leave the field out. Other columns of
    ``pages`` aren't looked at; an empty table gives an empty index.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", "html", F.monotonically_increasing_id().alias("row")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, size = None, "", 0
        for batch in batches:
            index = []
            for page in batch.to_pylist():
                if out is None or size > archive_bytes:
                    if out is not None:
                        out.close()
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                page["digest"] = base64.b32encode(bytes.fromhex(page["sha1"])).decode()
                whole = page["record_type"] == "response"
                data = gzip.compress(record(page, (page["html"] or "").encode() if whole else None), 6, mtime=0)
                out.write(data)
                kept = ("url", "digest", "record_type", "page_id", "row")
                index.append({"archive": name, "offset": size, "length": len(data)} | {c: page[c] for c in kept})
                size += len(data)
            yield pa.RecordBatch.from_pylist(index, schema=schema)
        if out is not None:
            out.close()

    schema = pa.schema(
        [
            (n, pa.int64() if k == "long" else pa.string())
            for n, k in (c.split(" ") for c in INDEX.split(", "))
        ]
    )
    return materialise(decided(rows, least_bytes).mapInArrow(write, INDEX), "warc-index")


def ranges(offsets: list[int], lengths: list[int], gap: int = MOST_GAP, most: int = MOST_RANGE) -> list[tuple[int, int]]:
    """(first, last) records of each read, for records sorted by offset."""
    out: list[tuple[int, int]] = []
    for i, (offset, length) in enumerate(zip(offsets, lengths, strict=True)):
        if out:
            first, last = out[-1]
            end = offsets[last] + lengths[last]
            if 0 <= offset - end <= gap and offset + length - offsets[first] <= most:
                out[-1] = first, i
                continue
        out.append((i, i))
    return out


def read_records(index: DataFrame, folder: str, gap: int = MOST_GAP, most: int = MOST_RANGE) -> DataFrame:
    """The records that the rows of an index name, parsed, in any order.

    Rows are range-partitioned by archive and offset, about TASK_BYTES of records
    to a task, so one archive of any size is read by several tasks, each in few reads that run from one wanted record
    to the next. Returns (page_id, row, url, record_type, payload_bytes,
    payload_digest, refers_to, payload). A response whose payload doesn't have the
    digest it was stored with fails the task.
    """
    wanted = index.select("archive", "offset", "length")
    total = wanted.agg(F.sum("length")).first()[0] or 0
    tasks = 1 + total // TASK_BYTES
    ordered = wanted.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = (
        "page_id long, row long, url string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long, payload binary"
    )
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            names, offsets, lengths = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            at = 0
            while at < len(names):
                end = at
                while end < len(names) and names[end] == names[at]:
                    end += 1
                with store.open_input_file(f"{base}/{names[at]}") as archive:
                    for first, last in ranges(offsets[at:end], lengths[at:end], gap, most):
                        first, last = at + first, at + last
                        start = offsets[first]
                        data = archive.read_at(offsets[last] + lengths[last] - start, start)
                        found = []
                        for i in range(first, last + 1):
                            member = data[offsets[i] - start : offsets[i] - start + lengths[i]]
                            page = parse(gzip.decompress(member))
                            if page["payload"] is not None and sha1_base32(page["payload"]) != page["payload_digest"]:
                                raise ValueError(f"{names[i]} at {offsets[i]}: payload and digest differ")
                            found.append(page)
                        yield pa.RecordBatch.from_pylist(found, schema=arrow)
                at = end

    return ordered.mapInArrow(run, schema)


def archive_folder(spark) -> str:
    """A new folder for archives in the cluster's shared folder, as a URI."""
    folder = work_folder(spark, "warc")
    return folder if "://" in folder else f"file://{folder}"
