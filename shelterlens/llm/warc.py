"""WARC archives in seekable Zstandard.

Records are grouped into independent Zstandard frames of about ``FRAME_BYTES``; the
frames are followed by a skippable frame with the seek table (sizes of every frame,
packed and unpacked) and its footer, as in the public seekable format. The index maps
each record to (archive, frame, offset within the unpacked frame, length), so one
record costs one seek and one frame (``read_record``).

Writing: executors write archives straight to a shared folder, under a name of their own
for every attempt; only archives of finished tasks are in the index, which is a table.
Reading: archives are dealt over tasks, each read frame by frame.

Equal payloads of at least ``REVISIT_BYTES`` are written once: the record with the largest
page_id is the response, the others are revisits that point to it. Payloads meet the
decision by a join on (digest, salt), so a page copied a million times is no single task.

Defined results: null html is an empty payload; repeated rows are records of their own
(equal page_ids that hold the largest are all responses); a null page_id or url is
written as an empty field and read as null.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelterlens.llm import common as C
from shelterlens.session import checkpoint_dir, materialize

FRAME_BYTES = 256 * 1024
ARCHIVE_BYTES = 128 * 1024 * 1024   # packed size at which a task starts its next archive
REVISIT_BYTES = 1000
SALTS = 16
# numbers of the seekable Zstandard format (fixed values)
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")
INDEX = "archive string, page_id long, frame int, offset long, length long"


# ---------------------------------------------------------------- records
def record(page_id, url, payload: bytes, digest: str, refers_to=None, length: int | None = None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of another page's equal payload."""
    kind = "response" if refers_to is None else "revisit"
    size = len(payload) if length is None else length
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    body = http + payload if refers_to is None else http
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(size)),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    if refers_to is not None:
        head[5:5] = [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                     ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + body + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0):
    """(headers, block, place after the record) of the record at ``at``."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = dict(x.split(": ", 1) for x in lines[1:])
    a = end + 4
    b = a + int(head["Content-Length"])
    return head, raw[a:b], b + 4


def page_of(uri: str):
    """Page number of <urn:page:N>; none if it is empty."""
    n = uri[len("<urn:page:"):-1]
    return int(n) if n else None


# ---------------------------------------------------------------- archives
class SeekableWriter:
    """Records in independent frames; ``close`` appends the seek table."""

    def __init__(self, out, level: int = 3):
        import zstandard

        self.out, self.packer = out, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table, self.held, self.size, self.packed = [], [], 0, 0

    def add(self, rec: bytes) -> tuple[int, int]:
        """(frame, offset) the record will have."""
        if self.size and self.size + len(rec) > FRAME_BYTES:
            self.flush()
        at = (len(self.table), self.size)
        self.held.append(rec)
        self.size += len(rec)
        return at

    def flush(self):
        if self.size:
            frame = self.packer.compress(b"".join(self.held))
            self.out.write(frame)
            self.table.append((len(frame), self.size))
            self.packed += len(frame)
            self.held, self.size = [], 0

    def close(self):
        self.flush()
        body = b"".join(ENTRY.pack(*t) for t in self.table) + FOOTER.pack(len(self.table), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.out.close()


class SeekableReader:
    """Frames of an archive by number, found through its seek table."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.unpacker = file, zstandard.ZstdDecompressor()
        file.seek(size - FOOTER.size)
        n, flags, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        width = ENTRY.size + (4 if flags & 0x80 else 0)
        file.seek(size - FOOTER.size - n * width)
        raw, self.starts, at = file.read(n * width), [], 0
        for k in range(n):
            packed, unpacked = ENTRY.unpack_from(raw, k * width)
            self.starts.append((at, packed, unpacked))
            at += packed

    def frame(self, k: int) -> bytes:
        at, packed, unpacked = self.starts[k]
        self.file.seek(at)
        return self.unpacker.decompress(self.file.read(packed), max_output_size=unpacked)


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _write(folder: str):
    def run(batches):
        import pyarrow as pa

        store, root = _files(folder)
        writer, name, rows = None, None, []
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to"))):
                page, url, html, digest, refers = r
                payload = (html or "").encode()
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = SeekableWriter(store.open_output_stream(f"{root}/{name}", compression=None))
                rec = record(page, url, payload, digest, refers)
                frame, at = writer.add(rec)
                rows.append((name, page, frame, at, len(rec)))
                if writer.packed >= ARCHIVE_BYTES:
                    writer.close()
                    writer = None
            if rows:
                yield _index_batch(rows)
                rows = []
        if writer is not None:
            writer.close()
        yield _index_batch([])

    def _index_batch(rows):
        import pyarrow as pa

        c = list(zip(*rows)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c[0], pa.string()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int32()),
             pa.array(c[3], pa.int64()), pa.array(c[4], pa.int64())],
            names=["archive", "page_id", "frame", "offset", "length"])
    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) to archives in ``folder`` (a URI all executors reach);
    returns the index (archive, page_id, frame, offset, length), already stored."""
    _store, root = _files(folder)
    _store.create_dir(root, recursive=True)
    pages = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    pages = pages.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    first = (pages.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.max("page_id").alias("response"), F.count("*").alias("copies")).filter("copies > 1")
             .select("digest", "response", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    first = materialize(first)
    pages = pages.withColumn("salt", F.coalesce(F.pmod("page_id", F.lit(SALTS)).cast("int"), F.lit(0)))
    known = pages.join(first, ["digest", "salt"], "left").withColumn(
        "refers_to", F.when(F.coalesce(F.col("page_id") != F.col("response"), F.col("response").isNotNull()),
                            F.col("response")))
    return materialize(C.arrow_map(known.select("page_id", "url", "html", "digest", "refers_to"),
                                   _write(folder), INDEX))


def _read(folder: str):
    def run(batches):
        import pyarrow as pa

        store, root = _files(folder)

        def batch_of(rows):
            c = list(zip(*rows)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.string()),
                 pa.array(c[3], pa.string()), pa.array(c[4], pa.int64())],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

        for batch in batches:
            for name, low, high in zip(*(batch.column(c).to_pylist() for c in ("archive", "low", "high"))):
                path = f"{root}/{name}"
                with store.open_input_file(path) as f:
                    reader = SeekableReader(f, f.size())
                    for k in range(low, high + 1):
                        raw, at, rows = reader.frame(k), 0, []
                        while at < len(raw):
                            head, block, at = parse(raw, at)
                            digest, size = head["WARC-Payload-Digest"][5:], int(head["X-Payload-Length"])
                            refers = head.get("WARC-Refers-To")
                            if refers is None:
                                payload = block[block.index(b"\r\n\r\n") + 4:]
                                size = len(payload)
                                if hashlib.sha1(payload).hexdigest() != digest:
                                    raise ValueError(f"{name}, frame {k}: payload does not match its digest")
                            rows.append((page_of(head["WARC-Record-ID"]), size, digest, head["WARC-Type"],
                                         None if refers is None else page_of(refers)))
                        yield batch_of(rows)
        yield batch_of([])
    return run


FRAMES_A_TASK = 16      # frames of an archive that are read in one go


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """All records of the archives in the index, read frame by frame and checked against their digests.

    Ranges of frames are dealt to the session's shuffle partitions, so a large archive is read by many tasks.
    """
    spans = index.groupBy("archive", F.floor(F.col("frame") / FRAMES_A_TASK).alias("span")).agg(
        F.min("frame").alias("low"), F.max("frame").alias("high"))
    # by number, so that the few rows are not gathered in one task
    spans = spans.withColumn("task", F.pmod(F.xxhash64("archive", "span"), F.lit(C.parts_of(index.sparkSession))).cast("int"))
    dealt = spans.repartitionById(C.parts_of(index.sparkSession), "task").select("archive", "low", "high")
    return C.arrow_map(dealt, _read(folder), "page_id long, payload_bytes long, payload_digest string, "
                                             "record_type string, refers_to long")


def read_record(folder: str, archive: str, frame: int, offset: int) -> tuple[dict, bytes]:
    """One record by its index entry: (headers, block). Reads the seek table and one frame."""
    store, root = _files(folder)
    with store.open_input_file(f"{root}/{archive}") as f:
        head, block, _ = parse(SeekableReader(f, f.size()).frame(frame), offset)
    return head, block


def new_folder(spark) -> str:
    """A folder for archives below the session's shared folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/warc-{uuid.uuid4().hex}"
