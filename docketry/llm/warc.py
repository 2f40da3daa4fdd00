"""WARC archives: writing with revisit records, and a splittable reader.

Every record is a gzip member of its own. Equal payloads of at least ``REVISIT_BYTES`` bytes are stored once, as
a response record; the others become revisit records that refer to it and keep its length and digest.

The reader deals out byte ranges of the files. A task scans its range for the gzip magic, and takes a place for
a member only when it inflates to a WARC record head there; the magic also occurs by chance inside compressed
data. A task owns the records that start inside its range and reads beyond the range to finish the last one. So
no range needs another, and no index is kept.

Archives are written under a new name per task attempt and only those of successful tasks are listed, in a table
in the shared folder; a lost executor leaves unlisted files behind, not wrong ones.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import col, join_marks, shared_uri, small_batches, written
from docketry.sources.scratch import mark, release, scratch_path

REVISIT_BYTES = 100
# Bytes of an archive that one task of the reader owns.
SPLIT_BYTES = 4 << 20
# Tasks that the reader's ranges are dealt to at most; beyond it a task reads several.
MOST_TASKS = 1 << 16
# Compressed bytes read at a time.
BLOCK = 1 << 16
MAGIC = b"\x1f\x8b\x08"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
    ]
)


def record(record_id: str | None, uri: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record, not yet compressed; control characters in the URI are percent-encoded."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if record_id is not None:
        head.append(f"WARC-Record-ID: <{record_id}>")
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {IDENTICAL}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict | None:
    """The fields of an inflated record, with the payload of a response; None when it is not a whole record."""
    at = raw.find(b"\r\n\r\n")
    if not raw.startswith(b"WARC/1.") or at < 0:
        return None
    head: dict[str, str] = {}
    for line in raw[:at].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        head[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not head.get("content-length", "").isdigit():
        return None
    block = raw[at + 4 : at + 4 + int(head["content-length"])]
    if len(block) < int(head["content-length"]):
        return None
    http, _, body = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    revisit = head.get("warc-type") == "revisit"
    return {
        "record_id": head["warc-record-id"].strip("<>") if "warc-record-id" in head else None,
        "record_type": head.get("warc-type"),
        "target_uri": head.get("warc-target-uri"),
        "refers_to": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
        "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha256:") if revisit else hashlib.sha256(body).hexdigest(),
        "payload_bytes": int(length[1]) if revisit and length else len(body),
        "payload": None if revisit else body,
    }


def with_firsts(pages: DataFrame, id_col: str, payload: str) -> DataFrame:
    """``pages`` with ``__digest`` and ``__first``: the smallest id of its equal payloads, where it is another page's.

    Rows and digests are written once. Digests, ids and row numbers alone are grouped and joined, those of payloads with many
    copies without a shuffle, and only the marks of later copies come back to the rows, by row number; so no payload
    meets its copies, however many there are.
    """
    digested, _ = written(pages.withColumn("__digest", F.sha2(col(payload), 256)).withColumn("__row", F.monotonically_increasing_id()), "warc-rows")
    known = digested.filter(F.octet_length(col(payload)) >= REVISIT_BYTES).select("__row", col(id_col).alias("__own"), "__digest")
    copies = known.groupBy("__digest").agg(F.count(F.lit(1)).alias("__n"), F.min("__own").alias("__first")).filter("__n > 1 AND __first IS NOT NULL")
    copies, _ = written(copies, "warc-copies")
    later = join_marks(known, copies, ["__digest"], "__n", known.count()).filter(~F.col("__own").eqNullSafe(F.col("__first")))
    later, _ = written(later.select(F.col("__row").alias("__later"), "__first"), "warc-later")
    return digested.join(later, F.col("__row") == F.col("__later"), "left")


def write(pages: DataFrame, folder: str, id_col: str, uri_col: str, text_col: str) -> DataFrame:
    """Write one archive per task into ``folder``; returns a table of the files with their sizes.

    ``folder`` is a URI that every executor can open. Record ids are ``urn:page:<id>``; a null id leaves the
    record id out, a null text is an empty payload. Of equal payloads the rows with the smallest id are
    responses (all of them, should that id repeat); null ids are never the smallest. Repeated rows are written each,
    an empty table gives no file, and other columns, whatever their names, are not read. A payload is held whole
    by the task that writes it.
    """
    small_batches(pages)
    begun = mark()
    source = pages.select(col(id_col).alias("__id"), col(uri_col).cast("string").alias("__uri"), F.coalesce(col(text_col), F.lit("")).cast("binary").alias("__payload"))
    rows = with_firsts(source, "__id", "__payload").select(
        F.col("__id").cast("string").alias("id"),
        F.col("__uri").alias("uri"),
        F.col("__payload").alias("payload"),
        F.col("__digest").alias("digest"),
        F.col("__first").cast("string").alias("first"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        name, size, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                page, uri, payload, digest, first = (batch.column(k)[i].as_py() for k in range(5))
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                made = gzip.compress(record(None if page is None else f"urn:page:{page}", uri, payload, digest, None if first is None else f"urn:page:{first}"), 4, mtime=0)
                out.write(made)
                size += len(made)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "size": [size]})

    files, path = written(rows.mapInArrow(run, "path string, size long"), "warc-files")
    release(pages.sparkSession, begun, keep=[path])
    return files


class _Members:
    """Gzip members of one file from ``start`` on, found by their magic and checked by inflating."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def at(self, offset: int, whole: bool = True) -> tuple[bytes, int] | None:
        """The inflated member at ``offset`` and where it ends; with ``whole`` unset only its head is inflated."""
        inflater, parts, place = zlib.decompressobj(31), [], offset
        while place < self.size and not inflater.eof:
            block = self.file.read_at(min(BLOCK, self.size - place), place)
            try:
                parts.append(inflater.decompress(block, 0 if whole else 64))
            except zlib.error:
                return None
            place += len(block)
            if not whole and sum(map(len, parts)) >= 7:
                break
        data = b"".join(parts)
        if not data.startswith(b"WARC/1.") or (whole and not inflater.eof):
            return None
        return data, place - len(inflater.unused_data)

    def starts(self, begin: int, end: int) -> Iterator[int]:
        """Offsets in ``[begin, end)`` with the magic; ``send`` an offset to go on from there."""
        place = begin
        while place < end:
            block = self.file.read_at(min(BLOCK, self.size - place, end - place + len(MAGIC) - 1), place)
            found = block.find(MAGIC)
            if found < 0 or place + found >= end:
                place += max(1, len(block) - len(MAGIC) + 1)
                continue
            jump = yield place + found
            place = jump if jump is not None else place + found + 1


def read_range(file, size: int, begin: int, end: int) -> Iterator[tuple[int, dict]]:
    """The records that start in ``[begin, end)`` with their offsets."""
    members = _Members(file, size)
    starts = members.starts(begin, end)
    try:
        offset = next(starts)
        while True:
            # The head first: chance hits fail there, long before a whole record is inflated.
            made = members.at(offset, whole=False) and members.at(offset)
            fields = made and parse(made[0])
            if fields:
                yield offset, fields
                offset = starts.send(made[1])
            else:
                offset = next(starts)
    except StopIteration:
        return


def ranges_of(files: DataFrame, split_bytes: int) -> DataFrame:
    """Byte ranges (``path``, ``size``, ``begin``), dealt out evenly to as many tasks as there are ranges, ``MOST_TASKS`` at most.

    The number of tasks is given, so adaptive planning does not put the few bytes that name the ranges into one task.
    """
    n = files.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long")))
    return files.filter("size > 0").select("path", "size", starts.alias("begin")).repartition(min(int(n), MOST_TASKS))


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the archives listed in ``files`` (``path``, ``size``), read in ranges of ``split_bytes``.

    Damaged or foreign bytes between records are passed over; an empty list or empty files give no row, and a file listed
    twice is read twice. With ``payloads`` unset the payload column stays null, and digests and lengths are still those of
    the stored bytes. A record of any length is held whole by the task that reads it, others up to 8 MB beside it.
    """
    ranges = ranges_of(files, split_bytes)
    names = [f.name for f in RECORD.fields]
    kinds = {"payload_bytes": pa.int64(), "offset": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, begin in zip(*(batch.column(i).to_pylist() for i in range(3))):
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    rows, held = [], 0
                    for offset, fields in read_range(file, size, begin, min(size, begin + split_bytes)):
                        if not payloads:
                            fields["payload"] = None
                        rows.append(fields | {"path": path, "offset": offset})
                        held += len(fields["payload"] or b"") + 500
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(run, RECORD)


def archive_folder(spark) -> str:
    """A new folder for archives in the shared folder of the cluster, as a URI of the session's file system."""
    return shared_uri(spark, scratch_path(spark, "warc"))
