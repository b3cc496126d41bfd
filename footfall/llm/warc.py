"""WARC archives: a writer with revisit records and a reader that salvages what it can.

Writing: every partition of pages is written to archives in the shared folder, one gzip member per
record. An attempt writes under a name of its own and reports it with its size; only archives
reported by successful attempts are read, so a task that runs twice leaves no second copy.

Reading: archives are cut into byte ranges, read by separate tasks. A task searches its range for
the first valid record, reads on until a record would start beyond the range, and checks each one:
the gzip member's checksum, version line, headers, length and payload digest. After a failed check it
searches for the next member (or version line, in plain archives) that passes, goes on from there and
logs the bytes skipped as a quarantined gap. Records may have any length: they are checked piece by
piece, and a payload too large for a value of Spark is checked and reported without its bytes.

Nulls: a null html is an empty payload, a null url an empty one; a null page_id is written as no
record id and read back as null. Repeated rows are written as often as they occur. An empty table
gives no archive and no rows.
"""

import hashlib
import re
import tempfile
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from footfall.llm.common import new_folder, stage, utf8

VERSION = b"WARC/1.1\r\n"
#: Payloads from this size on are written once.
REVISIT_BYTES = 1000
#: An archive is closed, and a range is cut, at about this size. Payloads are spooled to disk beyond the
#: third while they are checked; those beyond the last do not fit a value of Spark.
ARCHIVE_BYTES, RANGE_BYTES, SPOOL_BYTES, VALUE_BYTES = 64 << 20, 8 << 20, 32 << 20, (1 << 31) - (64 << 20)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ, CHUNK = 1 << 20, 1 << 16


# -- records


def record(page_id, url, payload, digest, kind, size, refers_to):
    """The bytes of one record. A revisit has no payload; its size and digest are those of the original."""
    block = payload if kind == "response" else b""
    head = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data):
    """``data`` as one gzip member."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class Parser:
    """Takes in one record piece by piece; headers stay in memory. Raises ValueError when it is none."""

    def __init__(self):
        self.head, self.headers, self.left, self.tail = bytearray(), None, 0, b""
        self.sha1, self.size = hashlib.sha1(), 0
        self.payload = tempfile.SpooledTemporaryFile(SPOOL_BYTES)

    @property
    def done(self):
        return self.headers is not None and self.tail == b"\r\n\r\n"

    def feed(self, data):
        """How many bytes of ``data`` belong to the record; fewer than all only at its end."""
        used = 0
        if self.headers is None:
            before = len(self.head)
            self.head += data
            if len(self.head) >= 10 and not re.match(rb"WARC/\d\.\d\r\n", self.head):
                raise ValueError("no version line")
            stop = self.head.find(b"\r\n\r\n", max(0, before - 3))
            if stop < 0:
                return len(data)
            self.headers, used = _headers(bytes(self.head[:stop])), stop + 4 - before
            self.left, self.head = int(self.headers["content-length"]), None
        body = data[used : used + self.left]
        self.payload.write(body)
        self.sha1.update(body)
        self.left, self.size, used = self.left - len(body), self.size + len(body), used + len(body)
        if not self.left:
            rest = data[used : used + 4 - len(self.tail)]
            self.tail, used = self.tail + rest, used + len(rest)
            if not b"\r\n\r\n".startswith(self.tail):
                raise ValueError("record does not end where it says")
        return used

    def result(self):
        """(headers, payload); the payload is None if no value of Spark holds it."""
        if not self.done:
            raise ValueError("headers do not end" if self.headers is None else "record does not end where it says")
        digest = self.headers.get("warc-payload-digest", "")
        if self.headers.get("warc-type") != "revisit" and digest.startswith("sha1:"):
            if self.sha1.hexdigest() != digest[5:]:
                raise ValueError("payload digest differs")
        if self.size > VALUE_BYTES:
            if not self.headers.get("x-payload-length", "").isdigit():
                self.headers["x-payload-length"] = str(self.size)
            return self.headers, None
        self.payload.seek(0)
        return self.headers, self.payload.read()


def _headers(block):
    headers = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("malformed header")
        headers[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "surrogatepass")
    if not re.fullmatch(r"[0-9]+", headers.get("content-length", "")):
        raise ValueError("no length")
    return headers


# -- reading with salvage


class _Window:
    """Bytes of an archive by position, read ahead as needed."""

    def __init__(self, file, size):
        self.file, self.size, self.base, self.data = file, size, 0, b""

    def at(self, position, length):
        """Up to ``length`` bytes from ``position`` on."""
        end = min(position + length, self.size)
        if position < self.base:  # a long record failed: the search goes on behind its start
            self.base, self.data = position, b""
        if position - self.base > 4 * READ or position > self.base + len(self.data):
            self.data = self.data[position - self.base :]
            self.base = position
        have = self.base + len(self.data)
        if have < end:
            self.file.seek(have)
            self.data += self.file.read(min(max(READ, end - have), self.size - have))
        return self.data[position - self.base : end - self.base]

    def find(self, position, mark):
        """Where ``mark`` comes next, or the end."""
        while position < self.size:
            at = self.at(position, READ).find(mark)
            if at >= 0:
                return position + at
            position += max(1, READ - len(mark) + 1)
        return self.size


def _member_at(window, position):
    """((headers, payload), end) of the gzip member at ``position``; raises ValueError."""
    inflate, parser, used = zlib.decompressobj(31), Parser(), 0
    with parser.payload:
        while not inflate.eof:
            chunk = inflate.unconsumed_tail
            if not chunk:
                chunk = window.at(position + used, CHUNK)
                used += len(chunk)
            try:
                part = inflate.decompress(chunk, READ)
            except zlib.error as error:
                raise ValueError(str(error)) from None
            if not chunk and not part and not inflate.eof:
                raise ValueError("member is cut off")
            if parser.feed(part) < len(part):
                raise ValueError("bytes left in the member")
        return parser.result(), position + used - len(inflate.unused_data)


def _plain_at(window, position):
    """((headers, payload), end) of the uncompressed record at ``position``; raises ValueError."""
    parser, used = Parser(), 0
    with parser.payload:
        while not parser.done:
            chunk = window.at(position + used, CHUNK)
            if not chunk:
                raise ValueError("record is cut off")
            used += parser.feed(chunk)
        return parser.result(), position + used


def read_range(file, size, begin, end, compressed):
    """Records that start in [begin, end), and gaps: yields (position, headers, payload, gap bytes, reason).

    A gap has no headers; it ends at the next valid record, wherever that is. Before the first valid
    record of a range inside an archive nothing is logged: those bytes belong to a record or to a gap of
    a range before. For that, a range also tests the record after its last one, beyond its end.
    """
    mark, record_at = (b"\x1f\x8b\x08", _member_at) if compressed else (b"WARC/", _plain_at)
    window = _Window(file, size)
    position, searching, started, gap, reason = begin, begin > 0, begin == 0, None, ""
    while True:
        if searching:
            position = window.find(position, mark)
        if position >= size or not started and position >= end:
            break
        try:
            found, after = record_at(window, position)
        except ValueError as error:
            if started and gap is None:
                gap, reason = position, str(error)
            position, searching = position + 1, True
            continue
        if gap is not None:
            yield gap, None, None, position - gap, reason
        if position >= end:
            return
        yield position, *found, 0, ""
        position, searching, started, gap = after, False, True, None
    if gap is not None:
        yield gap, None, None, size - gap, reason


RECORD_SCHEMA = (
    "archive string, position bigint, record_type string, record_id string, url string, payload_bytes bigint, "
    "payload_digest string, refers_to string, payload binary, gap_bytes bigint, reason string"
)


def read_archives(spark, archives):
    """Records and quarantined gaps of ``archives`` (archive: URL, bytes: size), ``RECORD_SCHEMA``."""
    # A plain archive is one range: a payload may hold a whole record, which a search would take for one.
    step = F.when(F.col("archive").endswith(".gz"), F.lit(RANGE_BYTES)).otherwise(F.col("bytes"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step.cast("long")))
    ranges = archives.filter("bytes > 0").select("archive", "bytes", step.alias("step"), starts.alias("begin"))
    # Ranges are few and heavy: about one a task.
    ranges = ranges.repartition(_tasks(ranges), "archive", "begin")

    def of_batches(batches):
        for batch in batches:
            for archive, size, step, begin in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = fs.FileSystem.from_uri(archive)
                out, held = [], 0
                with system.open_input_file(path) as file:
                    for position, headers, payload, gap, reason in read_range(file, size, begin, begin + step, archive.endswith(".gz")):
                        if out and held + len(payload or b"") > 16 << 20:
                            yield _to_batch(out)
                            out, held = [], 0
                        out.append(_row(archive, position, headers, payload, gap, reason))
                        held += len(payload or b"")
                if out:
                    yield _to_batch(out)

    return ranges.mapInArrow(of_batches, RECORD_SCHEMA)


def _tasks(ranges):
    return max(1, min(ranges.count(), 100_000))


def _row(archive, position, headers, payload, gap, reason):
    if headers is None:
        return (archive, position, None, None, None, None, None, None, None, gap, reason)
    inner = lambda name: (headers.get(name) or "").removeprefix("<").removesuffix(">").removeprefix("urn:page:") or None
    told = headers.get("x-payload-length", "")
    size = int(told) if told.isdigit() else len(payload)
    return (archive, position, headers.get("warc-type"), inner("warc-record-id"), headers.get("warc-target-uri"), size,
            headers.get("warc-payload-digest", "").removeprefix("sha1:"), inner("warc-refers-to"), payload, 0, None)


def _to_batch(rows):
    types = [pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64(), *[pa.string()] * 2, pa.binary(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


# -- writing


def planned_records(pages, id_col="page_id", url_col="url", html_col="html"):
    """Pages with digest, record type and the page a revisit refers to.

    Of equal payloads of ``REVISIT_BYTES`` or more the largest page_id is the response. Rows that
    repeat its id are responses as well.
    """
    payload = utf8(html_col)
    sized = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        F.length(payload).cast("long").alias("size"), F.sha1(payload).alias("digest"),
    )
    large = sized.filter(F.col("size") >= REVISIT_BYTES)
    # Combined before the shuffle; staged, so that the join may split a payload many pages have.
    first = stage(large.groupBy("digest", "size").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1"), "originals")
    joined = sized.join(first.drop("n"), ["digest", "size"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select(
        "page_id", "url", "html", "size", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("original")).alias("refers_to"),
    )


def write_archives(records, folder):
    """Write planned records below ``folder`` (a URL); returns the archives as (archive, bytes, records)."""

    def of_batches(batches):
        out, archive, size, count = None, None, 0, 0
        for batch in batches:
            for page_id, url, html, n, digest, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    archive = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                    system, path = fs.FileSystem.from_uri(archive)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out, size, count = system.open_output_stream(path, compression=None), 0, 0
                data = member(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), digest, kind, n, refers_to))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    yield pa.RecordBatch.from_pydict({"archive": [archive], "bytes": [size], "records": [count]})
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [archive], "bytes": [size], "records": [count]})

    return records.mapInArrow(of_batches, "archive string, bytes bigint, records bigint")


def archived(pages):
    """Write ``pages`` to archives and read them back: one row per record, and one per gap."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    if "://" not in folder:
        folder = folder.replace("file:", "file://", 1) if folder.startswith("file:") else f"file://{folder}"
    archives = stage(write_archives(planned_records(pages), folder), "archives")
    return read_archives(spark, archives)
