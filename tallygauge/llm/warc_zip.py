"""WARC archives packed in ZIP files: writing, and reading by ranges without extraction.

A task writes its pages as gzip members of ``archive/data.warc.gz``, stored (not deflated) in a ZIP
file beside their index, ``indexes/index.cdx``. The reader looks at the end of the file, follows the
ZIP64 records where there are any, parses the central directory, finds the data of the stored
members, reads the index, and then reads each record's byte range. Ranges are dealt over the
cluster, so a large archive is read by many tasks.

Files are read and written through Arrow's file systems, by the URI of the shared folder. A task
writes under a name of its own and only tasks that end well are listed, so a lost executor
leaves at most files that nobody reads.

Of records with equal payloads of at least ``LEAST_SHARED`` bytes the largest ``page_id`` holds the
payload and the others revisit it. Which pages are revisits is found from digests alone: counted
before they are shuffled, and joined with a join that Spark splits where a digest is frequent.

Defined results: a null ``html`` is an empty payload; a null or broken ``url`` is written escaped;
rows without ``page_id`` are written and read, but never revisited or revisits; an empty table gives no archive
and no rows; repeated rows of a page revisit the page itself only if their payloads are equal
and another row with a larger ``page_id`` exists.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygauge.llm.storage import saved
from tallygauge.sources.workspace import new_folder

LEAST_SHARED = 1000
#: A task begins a new archive when one has so many bytes.
ARCHIVE_BYTES = 256 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Index lines are read by so many bytes at a time.
INDEX_BYTES = 4 << 20
#: Fixed values of the ZIP format.
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path there."""
    return fs.FileSystem.from_uri(uri)


# --- writing ----------------------------------------------------------------------------


class ZipWriter:
    """A ZIP file of stored members, written front to back; sizes follow in the central directory."""

    def __init__(self, out):
        self.out, self.members = out, []

    def begin(self, name: str) -> None:
        self.name, self.at, self.crc, self.size = name.encode(), self.out.tell(), 0, 0
        # Flag 8: the sizes are not known yet; they stand behind the data, as ZIP64 numbers.
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        head = struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 33, 0, FULL32, FULL32, len(self.name), len(extra))
        self.out.write(LOCAL + head + self.name + extra)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)

    def end(self) -> None:
        self.out.write(b"PK\x07\x08" + struct.pack("<IQQ", self.crc, self.size, self.size))
        self.members.append((self.name, self.at, self.crc, self.size))

    def close(self) -> None:
        begin = self.out.tell()
        for name, at, crc, size in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at)
            head = (45, 45, 8, 0, 0, 33, crc, FULL32, FULL32, len(name), len(extra), 0, 0, 0, 0, FULL32)
            self.out.write(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", *head) + name + extra)
        end, n = self.out.tell(), len(self.members)
        self.out.write(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, end - begin, begin))
        self.out.write(LOCATOR64 + struct.pack("<IQI", 0, end, 1))
        self.out.write(END + struct.pack("<HHHHIIH", FULL16, FULL16, FULL16, FULL16, FULL32, FULL32, 0))
        self.out.close()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record as one gzip member."""
    digest = b32encode(hashlib.sha1(payload).digest()).decode()
    own = payload if refers_to is None else b""
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%~"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "text/html",
    }
    if page_id is not None:
        headers["WARC-Page-ID"] = str(page_id)
    if refers_to is not None:
        headers["WARC-Refers-To-Page-ID"] = str(refers_to)
    headers["Content-Length"] = str(len(own))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return gzip.compress(f"WARC/1.1\r\n{head}\r\n".encode() + own + b"\r\n\r\n", compresslevel=1, mtime=0)


def first_seen(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``refers_to`` of the pages that revisit another."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    known = pages.where("page_id is not null").select("page_id", F.sha1(payload).alias("digest"), F.length(payload).alias("n"))
    known = saved(known.where(F.col("n") >= LEAST_SHARED), "digests")
    last = known.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
    last = last.where("least < refers_to").drop("least")
    return known.join(last, ["digest", "n"]).where("page_id < refers_to").select("page_id", "digest", "refers_to")


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes a record per page; ``path`` and ``records`` of each archive."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    seen = first_seen(own).distinct()
    rows = own.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    rows = rows.join(seen, ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")
    folder = new_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = file_system(folder)
        archive = index = None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*batch.columns, strict=True):
                if archive is None:
                    system.create_dir(at, recursive=True)
                    name = f"{uuid.uuid4().hex}.wacz"
                    archive, index = ZipWriter(system.open_output_stream(f"{at}/{name}")), []
                    archive.begin(ARCHIVE)
                data = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                index.append(f"{archive.size} {len(data)}\n")
                archive.write(data)
                if archive.size >= ARCHIVE_BYTES:
                    yield ended(archive, index, name)
                    archive = None
        if archive is not None:
            yield ended(archive, index, name)

    def ended(archive: ZipWriter, index: list[str], name: str) -> pa.RecordBatch:
        archive.end()
        archive.begin(INDEX)
        archive.write("".join(index).encode())
        archive.end()
        archive.close()
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(index)], pa.int64())], ["path", "records"])

    return saved(rows.mapInArrow(write, "path string, records bigint"), "archives")


# --- reading ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def ranged(file, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"the archive ends before byte {start + length}")
    return data


def central_directory(file) -> list[Member]:
    """The members of a ZIP file, with ZIP64 sizes and places."""
    size = file.size()
    tail_at = max(0, size - FULL16 - 22)
    tail = ranged(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    n, _, length, begin = struct.unpack("<HHII", tail[at + 8 : at + 20])
    locator = tail_at + at - 20
    if locator >= 0 and (place := ranged(file, locator, 20))[:4] == LOCATOR64:
        end64 = ranged(file, struct.unpack("<Q", place[8:16])[0], 56)
        if end64[:4] != END64:
            raise ValueError("broken ZIP64 end of central directory")
        n, length, begin = struct.unpack("<QQQ", end64[32:56])
    directory, members, p = ranged(file, begin, length), [], 0
    for _ in range(n):
        if directory[p : p + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, own, full = struct.unpack("<H8xII", directory[p + 10 : p + 28])
        n_name, n_extra, n_comment = struct.unpack("<HHH", directory[p + 28 : p + 34])
        header = struct.unpack("<I", directory[p + 42 : p + 46])[0]
        name = directory[p + 46 : p + 46 + n_name].decode()
        extra = directory[p + 46 + n_name : p + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, long = struct.unpack("<HH", extra[:4])
            if kind == 1:
                # Only the numbers that do not fit elsewhere are there, in this order.
                numbers = iter(struct.unpack(f"<{long // 8}Q", extra[4 : 4 + long // 8 * 8]))
                full = next(numbers) if full == FULL32 else full
                own = next(numbers) if own == FULL32 else own
                header = next(numbers) if header == FULL32 else header
            extra = extra[4 + long :]
        members.append(Member(name, method, own, header))
        p += 46 + n_name + n_extra + n_comment
    return members


def data_start(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method:
        raise ValueError(f"{member.name} is not stored")
    head = ranged(file, member.header, 30)
    if head[:4] != LOCAL:
        raise ValueError(f"broken header of {member.name}")
    n_name, n_extra = struct.unpack("<HH", head[26:30])
    return member.header + 30 + n_name + n_extra


def index_lines(file, member: Member) -> Iterator[tuple[int, int]]:
    """Place and length of the records, read piece by piece."""
    start, rest = data_start(file, member), b""
    for at in range(0, member.size, INDEX_BYTES):
        *lines, rest = (rest + ranged(file, start + at, min(INDEX_BYTES, member.size - at))).split(b"\n")
        for line in lines:
            place, length = line.split()
            yield int(place), int(length)


def locate(archives: DataFrame) -> DataFrame:
    """``path``, ``start`` and ``length`` of every record of the archives at ``path``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, at = file_system(path)
                with system.open_input_file(at) as file:
                    members = {m.name: m for m in central_directory(file)}
                    start = data_start(file, members[ARCHIVE])
                    found = list(index_lines(file, members[INDEX]))
                columns = [[path] * len(found), [start + p for p, _ in found], [n for _, n in found]]
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["path", "start", "length"])

    return archives.select("path").mapInArrow(find, "path string, start bigint, length bigint")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = gzip.decompress(data).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


RECORD = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint"
)


def read_records(places: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records at the given places; a response's payload must have its digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = file = None
        for batch in batches:
            rows = []
            for own, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != path:
                    system, at = file_system(own)
                    path, file = own, system.open_input_file(at)
                headers, payload = parsed(ranged(file, start, length))
                digest = b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                size = int(headers["WARC-Payload-Length"])
                response = headers["WARC-Type"] == "response"
                if response and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
                    raise ValueError(f"the payload at {start} of {own} is not what its digest says")
                page_id, refers_to = headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")
                rows.append(
                    {
                        "page_id": page_id and int(page_id),
                        "url": headers["WARC-Target-URI"],
                        "record_type": headers["WARC-Type"],
                        "payload": payload if with_payload and response else None,
                        "payload_bytes": size,
                        "payload_digest": digest,
                        "refers_to": refers_to and int(refers_to),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD.split(", ")])
    return places.mapInArrow(read, RECORD)


def through_archives(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to archives and reads every record back, range by range."""
    archives = write_archives(pages)
    places = saved(locate(archives.repartition("path")), "places")
    # Neighbouring ranges of an archive go to one task.
    dealt = places.repartitionByRange("path", "start").sortWithinPartitions("path", "start")
    back = read_records(dealt, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
l AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_SHARED} AND page_id < last THEN last END AS refers_to
FROM l
"""
