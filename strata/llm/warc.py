"""WARC records in ZIP packages: a writer, and a reader that works by byte ranges.

An archive is a ZIP file with stored (uncompressed) members, so that a record
is a byte range of the package:

    archive/data.warc.gz   one gzip member per WARC record
    indexes/index.cdxj     a line per record: key, date, JSON with offset and length

The reader finds the end of central directory, follows the ZIP64 locator where
there is one, parses the central directory, locates the members by their local
headers, and reads the records that the index names, many adjacent ones at a
time. Nothing is extracted. Archives lie in the shared folder and are opened
with Arrow's file systems, so a path may name any store that these know.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut
from strata.llm.components import split_join
from strata.session import scratch_folder

RECORDS = 5_000           # records of one archive at most
RANGE = 4 << 20           # bytes of adjacent records read at once
MIN_REVISIT = 100         # payload bytes from which a repeat is written as a revisit
DATE = "1970-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

# Fixed values of the ZIP format.
EOCD, LOCATOR, EOCD64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# --- records ---------------------------------------------------------------

def record_id(page_id: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, page_id or '')}>"


def _escaped(value: str, keep: str = "") -> str:
    """The value for one header line: what is no printable character, a blank or a per cent sign, in per cents."""
    return "".join(c if c in keep or c.isprintable() and c not in "% " else
                   "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def _unescaped(value: str | None) -> str | None:
    return None if value is None else unquote_to_bytes(value).decode("utf-8", "surrogatepass")


def make_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header of its payload but not the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}",
             "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}",
             f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {_escaped(page_id)}")
    if url is not None:
        # a URL stands as it is, per cents included; one that a header can't hold comes a second time, reversibly
        shown = _escaped(url, "% ").strip()
        lines.append(f"WARC-Target-URI: {shown}")
        if shown != url:
            lines.append(f"WARC-Target-URI-Escaped: {_escaped(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}",
                  f"WARC-Refers-To-Page: {_escaped(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, rest


def parse_record(data: bytes) -> dict:
    """page_id, url, record_type, refers_to, payload (None for a revisit), payload_digest, payload_bytes."""
    version, warc, rest = _headers(data)
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    block = rest[:int(warc["content-length"])]
    _, http, payload = _headers(block)
    kind = warc["warc-type"]
    url = _unescaped(warc.get("warc-target-uri-escaped")) or warc.get("warc-target-uri")
    return {"page_id": _unescaped(warc.get("warc-page-id")), "url": url, "record_type": kind,
            "refers_to": _unescaped(warc.get("warc-refers-to-page")), "payload": None if kind == "revisit" else payload,
            "payload_digest": warc.get("warc-payload-digest", "").rpartition(":")[2] or None,
            "payload_bytes": int(http.get("content-length", len(payload)))}


# --- writing ----------------------------------------------------------------

class ArchiveWriter:
    """One archive; members are written front to back, so the store needs no seeking."""

    def __init__(self, path: str):
        self.path = path
        store, at = open_store(path)
        self.file = store.open_output_stream(at)
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.lines: list[str] = []
        self.offset = 0

    def add(self, page_id: str | None, url: str | None, record: bytes) -> None:
        packed = gzip.compress(record, compresslevel=1, mtime=0)
        self.data.write(packed)
        self.lines.append(f"{record_id(page_id)} {DATE} " + json.dumps(
            {"page_id": page_id, "offset": self.offset, "length": len(packed), "filename": DATA}))
        self.offset += len(packed)

    def close(self) -> int:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as f:
            f.write("".join(line + "\n" for line in self.lines).encode())
        self.zip.close()
        size = self.file.tell()
        self.file.close()
        return size


def mark_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
                  min_bytes: int = MIN_REVISIT) -> DataFrame:
    """id, url, payload, digest, refers_to: the least id with an equal payload of ``min_bytes`` or more, else null.

    Only ids and digests are grouped; a payload that a third of all pages
    share is counted in the map tasks first, and the join back may split it.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    narrow = rows.where(F.octet_length("payload") >= min_bytes).select("id", "digest")
    groups = (narrow.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 and least is not null").drop("n"))
    key = F.concat_ws("|", "digest", F.coalesce(F.col("id").cast("string"), F.lit("~")))
    revisits = (split_join(narrow, groups, "digest").where("not (id <=> least)")
                .select(key.alias("_key"), F.col("least").alias("refers_to")).distinct())
    return rows.withColumn("_key", key).join(revisits, "_key", "left").drop("_key")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str = "url", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write every page to archives under ``folder``; returns (path, records, bytes) of each archive.

    Each task writes archives under names of its own, so a task that runs
    twice leaves a file that no returned row names. Null payloads are empty,
    a null id or url has no header; an empty table writes nothing.
    """
    rows = mark_revisits(pages, id_col, payload_col, url_col, min_bytes).select(
        F.col("id").cast("string"), "url", "payload", "digest", F.col("refers_to").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = open_store(folder)
        store.create_dir(at, recursive=True)
        writer, out = None, []
        part = TaskContext.get().partitionId()
        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*b.columns):
                if writer is None:
                    writer = ArchiveWriter(f"{folder}/part-{part:05d}-{uuid.uuid4().hex}.wacz")
                writer.add(page_id.as_py(), url.as_py(), make_record(
                    page_id.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers_to.as_py()))
                if len(writer.lines) >= RECORDS:
                    out.append((writer.path, len(writer.lines), writer.close()))
                    writer = None
        if writer is not None:
            out.append((writer.path, len(writer.lines), writer.close()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["path", "records", "bytes"])

    return cut(rows.mapInArrow(run, "path string, records bigint, bytes bigint"))


# --- reading ----------------------------------------------------------------

class ArchiveReader:
    """Members of a ZIP package by range reads (``file`` has size() and read_at(n, offset))."""

    def __init__(self, file):
        self.file, self.size = file, file.size()
        self.members = {name: (offset, size) for name, offset, size in self._directory()}

    def _directory(self) -> Iterator[tuple[str, int, int]]:
        at, length, count, base = self._end()
        data, used = self.file.read_at(length, at), 0
        for _ in range(count):
            if data[used:used + 4] != ENTRY:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, used + 8)
            packed, size, n, m, k, disk = struct.unpack_from("<IIHHHH", data, used + 20)
            offset, = struct.unpack_from("<I", data, used + 42)
            name = data[used + 46:used + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            extra = data[used + 46 + n:used + 46 + n + m]
            packed, size, offset = _wide(extra, packed, size, offset)
            used += 46 + n + m + k
            if method == 0 and not flags & 1:  # stored and not encrypted: a record is a byte range
                yield name, base + offset, packed

    def _end(self) -> tuple[int, int, int, int]:
        """Offset, length and number of entries of the central directory, and bytes before the package."""
        tail_at = max(0, self.size - 22 - FULL16 - 20)
        tail = self.file.read_at(self.size - tail_at, tail_at)
        i = tail.rfind(EOCD)
        while i >= 0 and (len(tail) < i + 22 or i + 22 + struct.unpack_from("<H", tail, i + 20)[0] != len(tail)):
            i = tail.rfind(EOCD, 0, i)
        if i < 0:
            raise ValueError("no end of central directory")
        count, length, offset = struct.unpack_from("<HII", tail, i + 10)
        end = tail_at + i
        if i >= 20 and tail[i - 20:i - 16] == LOCATOR:
            at64, = struct.unpack_from("<Q", tail, i - 12)
            head = self.file.read_at(56, at64)
            if head[:4] != EOCD64:  # something lies before the package
                at64 = end - 20 - 56
                head = self.file.read_at(56, at64)
            if head[:4] != EOCD64:
                raise ValueError("no ZIP64 end of central directory")
            count, length, offset = struct.unpack_from("<QQQ", head, 32)
            end = at64
        elif FULL16 == count or FULL32 in (length, offset):
            raise ValueError("ZIP64 locator is missing")
        return end - length, length, count, end - length - offset

    def data_at(self, name: str) -> tuple[int, int]:
        """Where a member's bytes start, by its local header, and how many there are."""
        at, size = self.members[name]
        head = self.file.read_at(30, at)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        n, m = struct.unpack_from("<HH", head, 26)
        return at + 30 + n + m, size

    def lines(self, name: str) -> Iterator[bytes]:
        at, size = self.data_at(name)
        rest, done = b"", 0
        while done < size:
            block = self.file.read_at(min(1 << 20, size - done), at + done)
            done += len(block)
            *whole, rest = (rest + block).split(b"\n")
            yield from whole
        if rest:
            yield rest

    def records(self) -> Iterator[dict]:
        """Every record that an index member names."""
        for name in sorted(self.members):
            if name.startswith("indexes/") and name.endswith((".cdxj", ".cdx")):
                yield from self._indexed(json.loads(line[line.index(b"{"):]) for line in self.lines(name) if line)

    def _indexed(self, entries: Iterator[dict]) -> Iterator[dict]:
        held: list[dict] = []

        def read() -> Iterator[dict]:
            start = held[0]["offset"]
            at, size = self.data_at(held[0]["filename"])
            end = held[-1]["offset"] + held[-1]["length"]
            if end > size:
                raise ValueError("index points beyond its member")
            data = self.file.read_at(end - start, at + start)
            for e in held:
                yield parse_record(gzip.decompress(data[e["offset"] - start:e["offset"] - start + e["length"]]))

        for e in entries:
            last = held[-1] if held else None
            if last and (e["filename"] != last["filename"] or e["offset"] != last["offset"] + last["length"]
                         or e["offset"] + e["length"] - held[0]["offset"] > RANGE):
                yield from read()
                held = []
            held.append(e)
        if held:
            yield from read()


def _wide(extra: bytes, packed: int, size: int, offset: int) -> tuple[int, int, int]:
    """Values that the ZIP64 extra field (id 1) holds, in its fixed order."""
    at = 0
    while at + 4 <= len(extra):
        tag, n = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            at += 4
            if size == FULL32:
                size, = struct.unpack_from("<Q", extra, at)
                at += 8
            if packed == FULL32:
                packed, = struct.unpack_from("<Q", extra, at)
                at += 8
            if offset == FULL32:
                offset, = struct.unpack_from("<Q", extra, at)
            break
        at += 4 + n
    return packed, size, offset


SCHEMA = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.string()), ("payload", pa.binary()), ("payload_digest", pa.string()),
                    ("payload_bytes", pa.int64())])


def read_archives(archives: DataFrame, path_col: str = "path") -> DataFrame:
    """A row per indexed record of the archives: page_id, url, record_type, refers_to, payload, payload_digest,
    payload_bytes (of the full payload; a revisit's payload is null). Ids come back as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = open_store(path)
                with store.open_input_file(at) as f:
                    rows, size = [], 0
                    for r in ArchiveReader(f).records():
                        rows.append(r)
                        size += len(r["payload"] or b"")
                        if size > RANGE or len(rows) >= 1_000:
                            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    paths = archives.where(F.col(path_col).isNotNull()).select(F.col(path_col).alias("path"))
    # the paths are few bytes: without a number they would be coalesced into one task
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(
        run, "page_id string, url string, record_type string, refers_to string, payload binary, "
             "payload_digest string, payload_bytes bigint")


def package_round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
                       url_col: str = "url") -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back.

    Digest and size of a response are taken from the payload read; the job
    fails if they are not those that its header names. The archives go when the
    driver ends.
    """
    folder = scratch_folder(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    back = read_archives(write_archives(pages, folder, id_col, payload_col, url_col))
    full = F.col("record_type") == "response"
    own = F.sha2("payload", 256)
    wrong = full & ((own != F.col("payload_digest")) | (F.octet_length("payload") != F.col("payload_bytes")))
    return back.select(
        "page_id", "payload_bytes",
        F.when(wrong, F.raise_error(F.lit("a payload is not what its header says")).cast("string"))
        .when(full, own).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to", "url")
