"""WARC records in ZIP-packaged archives, written and range-read.

Each task writes archives of one stored member ``archive/data.warc.gz`` (one
gzip member a record, so that a record can be read by its range), one stored
index ``indexes/index.cdx`` (``page_id offset length`` lines) and a central
directory, in ZIP64 form where sizes or counts ask for it. Equal payloads are
written once, as the response of the smallest page_id; the others are revisit
records that name it.

Reading takes the end-of-directory record (and ZIP64's) from the file's tail,
then the directory, then the index member, and reads records by byte range
from the stored member; nothing is extracted. Files are reached through
pyarrow's file systems in the shared folder, so any executor reads what
another wrote; names are unique to a task attempt, and only the files that a
finished attempt lists are read.

Defined results: null html counts as empty, a null url becomes
``urn:page:<id>``; rows that repeat a page_id are separate records; a null
page_id is written and read back as null and comes last in the choice of a
response; extra columns are ignored; no rows give no archives.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from cumulus.llm.common import emit, stored
from cumulus.session import scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Bytes of records that a task holds before it writes them as an archive.
ARCHIVE_BYTES = 64 << 20
#: Records that one reading task's row spans.
RANGE_BYTES = 4 << 20
#: Parts of a payload's equals are not moved below this size.
MIN_REVISIT_BYTES = 0

_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF


# --- ZIP -------------------------------------------------------------------

def _extra64(values: list[int]) -> bytes:
    return struct.pack("<HH", 1, 8 * len(values)) + b"".join(struct.pack("<Q", v) for v in values)


class ZipWriter:
    """Stored members written in one pass; a member's sizes and checksum are
    patched into its local header, which always has room for ZIP64."""

    def __init__(self, sink, zip64: bool = False):
        self.sink, self.force, self.members = sink, zip64, []

    def member(self, name: str, chunks: Iterator[bytes], size: int, crc: int) -> None:
        """``size`` and ``crc`` are known beforehand."""
        at, raw = self.sink.tell(), name.encode()
        wide = self.force or size >= _MAX32
        extra = _extra64([size, size]) if wide else b""
        s = _MAX32 if wide else size
        self.sink.write(_LOCAL + struct.pack("<HHHHHIIIHH", 45 if wide else 20, 1 << 11, 0, 0, 33, crc, s, s,
                                             len(raw), len(extra)) + raw + extra)
        for c in chunks:
            self.sink.write(c)
        self.members.append((raw, at, size, crc))

    def close(self) -> None:
        start = self.sink.tell()
        for raw, at, size, crc in self.members:
            wide = [v for v in (size, size, at) if self.force or v >= _MAX32]
            big = lambda v: _MAX32 if self.force or v >= _MAX32 else v
            extra = _extra64(wide) if wide else b""
            self.sink.write(_CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45 if wide else 20, 1 << 11, 0, 0, 33, crc,
                                                   big(size), big(size), len(raw), len(extra), 0, 0, 0, 0, big(at))
                            + raw + extra)
        end, n = self.sink.tell(), len(self.members)
        if self.force or n >= _MAX16 or end >= _MAX32:
            self.sink.write(_END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, end - start, start))
            self.sink.write(_LOCATOR64 + struct.pack("<IQI", 0, end, 1))
            n, size, at = _MAX16, _MAX32, _MAX32
        else:
            size, at = end - start, start
        self.sink.write(_END + struct.pack("<HHHHIIH", 0, 0, n, n, size, at, 0))


def directory(source, size: int) -> dict[str, tuple[int, int]]:
    """Stored members of a ZIP file: name -> (offset of the data, length)."""
    def read(at: int, n: int) -> bytes:
        source.seek(at)
        return source.read(n)

    tail_at = max(0, size - 22 - _MAX16)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no end of central directory")
    n, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if _MAX16 == n or _MAX32 in (length, start):
        at = tail_at + end - 20
        locator = read(at, 20) if at >= 0 else b""
        if locator[:4] == _LOCATOR64:
            record = read(struct.unpack("<Q", locator[8:16])[0], 56)
            if record[:4] != _END64:
                raise ValueError("no ZIP64 end of central directory")
            n, length, start = struct.unpack("<QQQ", record[32:56])
    raw, at, out = read(start, length), 0, {}
    for _ in range(n):
        if raw[at : at + 4] != _CENTRAL:
            raise ValueError("central directory is damaged")
        method, = struct.unpack("<H", raw[at + 10 : at + 12])
        packed, plain, k_name, k_extra, k_note = struct.unpack("<IIHHH", raw[at + 20 : at + 34])
        offset, = struct.unpack("<I", raw[at + 42 : at + 46])
        name = raw[at + 46 : at + 46 + k_name].decode()
        extra = raw[at + 46 + k_name : at + 46 + k_name + k_extra]
        while len(extra) >= 4:
            kind, k = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = list(struct.unpack(f"<{k // 8}Q", extra[4 : 4 + k // 8 * 8]))
                plain = wide.pop(0) if plain == _MAX32 else plain
                packed = wide.pop(0) if packed == _MAX32 else packed
                offset = wide.pop(0) if offset == _MAX32 else offset
            extra = extra[4 + k :]
        if method == 0:
            local = read(offset, 30)
            if local[:4] != _LOCAL:
                raise ValueError(f"no local header of {name}")
            a, b = struct.unpack("<HH", local[26:30])
            out[name] = (offset + 30 + a + b, packed)
        at += 46 + k_name + k_extra + k_note
    return out


# --- WARC ------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    return "".join(c for c in value if c >= " " and c != "\x7f")


def record(page: int | None, url: str | None, payload: bytes, sha: str, refers: int | None, revisit: bool) -> bytes:
    """One gzip member with a response or revisit record. The length of a
    revisit's payload is an extension field, as the payload isn't there."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    uri = _clean(url) if url else f"urn:page:{page}"
    head = ["WARC/1.1", "WARC-Type: " + ("revisit" if revisit else "response"),
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {uri} {sha}')}>",
            f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{sha}", f"WARC-Payload-Length: {len(payload)}",
            f"WARC-Page-ID: {'' if page is None else page}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To-Page: {refers}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n") + pack.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one record's bytes."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


# --- Spark -----------------------------------------------------------------

def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


_LIST = pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())])


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False) -> DataFrame:
    """Archives of ``pages`` in ``folder``; a row for each: path, size,
    records. The list is stored, so archives are written once."""
    payload = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                           F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    keyed = payload.withColumn("sha", F.unhex(F.sha1("payload")))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id")
    groups = keyed.where(F.length("payload") >= MIN_REVISIT_BYTES).groupBy("sha").agg(
        F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")
    rows = keyed.join(groups.hint("merge"), "sha", "left").select("page_id", "url", "payload", F.col("first.page_id").alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)

        def finish(parts: list[bytes], index: list[str]):
            name = f"{base}/{uuid.uuid4().hex}.wacz"
            crc = 0
            for p in parts:
                crc = zlib.crc32(p, crc)
            listing = "".join(index).encode()
            with fs.open_output_stream(name) as sink:
                z = ZipWriter(sink, zip64)
                z.member(DATA, iter(parts), sum(map(len, parts)), crc)
                z.member(INDEX, iter([listing]), len(listing), zlib.crc32(listing))
                z.close()
                size = sink.tell()
            return emit([(f"{folder}/{name.rpartition('/')[2]}", size, len(index))], _LIST)

        parts, index, at = [], [], 0
        for batch in batches:
            for page, url, payload, refers in zip(*map(pa.Array.to_pylist, batch.columns)):
                # of repeated rows of the response's page, each is a response: refers_to names another page
                r = record(page, url, payload, digest(payload), refers, refers is not None and refers != page)
                parts.append(r)
                index.append(f"{'-' if page is None else page} {at} {len(r)}\n")
                at += len(r)
                if at >= archive_bytes:
                    yield finish(parts, index)
                    parts, index, at = [], [], 0
        if index:
            yield finish(parts, index)

    return stored(rows.mapInArrow(run, "path string, size bigint, records bigint"), "warc-list")


_RANGE = pa.schema([("path", pa.string()), ("at", pa.int64()), ("length", pa.int64()), ("sizes", pa.list_(pa.int64()))])


def ranges(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges of whole records, about ``range_bytes`` each, found in the
    archives' directories and indexes: path, at, length, sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, name = _open(path)
                with fs.open_input_file(name) as f:
                    members = directory(f, size)
                    at, n = members[INDEX]
                    f.seek(at)
                    lines = f.read(n).decode().splitlines()
                start, out, sizes = members[DATA][0], [], []
                begin = 0
                for line in lines:
                    _, offset, length = line.split(" ")
                    if sizes and sum(sizes) >= range_bytes:
                        out.append((path, start + begin, sum(sizes), sizes))
                        begin, sizes = int(offset), []
                    sizes.append(int(length))
                if sizes:
                    out.append((path, start + begin, sum(sizes), sizes))
                yield emit(out, _RANGE)

    n = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("path", "size").repartition(n).mapInArrow(
        run, "path string, at bigint, length bigint, sizes array<bigint>")


_PAGE = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def read_records(found: DataFrame) -> DataFrame:
    """One row for each record of the ranges. A response's digest and length
    are taken from its payload and must equal its header's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, length, sizes in zip(*map(pa.Array.to_pylist, batch.columns)):
                fs, name = _open(path)
                with fs.open_input_file(name) as f:
                    f.seek(at)
                    raw = f.read(length)
                rows, pos = [], 0
                for n in sizes:
                    h, block = parse_record(raw[pos : pos + n])
                    pos += n
                    size, sha = int(h["warc-payload-length"]), h["warc-payload-digest"].removeprefix("sha1:")
                    if h["warc-type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if (len(payload), digest(payload)) != (size, sha):
                            raise ValueError(f"damaged payload in {path}")
                    page, refers = h["warc-page-id"], h.get("warc-refers-to-page")
                    rows.append((int(page) if page else None, size, sha, h["warc-type"],
                                 int(refers) if refers else None, h["warc-target-uri"]))
                yield emit(rows, _PAGE)

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(n).mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, "
                                                "record_type string, refers_to bigint, url string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_records(ranges(write_archives(pages, folder)))
