import hashlib
import io
import random
import uuid
import zipfile

import pytest

from strata.llm import warc
from strata.session import scratch_path


class File:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def package(prefix=b"", comment=b"", zip64=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open("a.bin", "w", force_zip64=zip64) as f:
            f.write(b"hello")
        z.writestr("dir/é.txt", b"x" * 1000)
        z.writestr("packed.txt", b"y" * 1000, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = comment
    return prefix + out.getvalue()


@pytest.mark.parametrize("prefix", [b"", b"junk before" * 9])
@pytest.mark.parametrize("comment", [b"", b"a comment PK\x05\x06 in the tail" + bytes(30)])
@pytest.mark.parametrize("zip64", [False, True])
def test_directory(prefix, comment, zip64):
    data = package(prefix, comment, zip64)
    r = warc.ArchiveReader(File(data))
    assert set(r.members) == {"a.bin", "dir/é.txt"}  # a compressed member has no byte ranges
    at, n = r.data_at("a.bin")
    assert data[at:at + n] == b"hello"


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    for prefix in (b"", b"junk"):
        data = package(prefix)
        assert warc.EOCD64 in data and warc.LOCATOR in data
        r = warc.ArchiveReader(File(data))
        at, n = r.data_at("dir/é.txt")
        assert data[at:at + n] == b"x" * 1000


def test_broken_packages():
    data = package()
    for bad in (b"", b"PK", data[:-5], data[:40], data.replace(warc.ENTRY, b"XXXX")):
        with pytest.raises(Exception):
            warc.ArchiveReader(File(bad))


def test_record_round_trip():
    for payload in (b"", b"\r\n\r\nWARC/1.1\r\n\r\n", "é\x00".encode() * 50):
        r = warc.parse_record(warc.make_record("7", "http://x/\r\né ", payload, "d", None))
        assert (r["page_id"], r["record_type"], r["payload"], r["payload_bytes"]) == ("7", "response", payload, len(payload))
        r = warc.parse_record(warc.make_record("8", None, payload, "d", "7"))
        assert (r["record_type"], r["refers_to"], r["payload"], r["payload_bytes"], r["url"]) == (
            "revisit", "7", None, len(payload), None)


def brute(rows):
    pay = [(i, (h or "").encode()) for i, h, *_ in rows]
    out = []
    for i, p in pay:
        ids = [j for j, q in pay if q == p and j is not None]
        least = min(ids) if ids and len(p) >= 100 else None
        revisit = least is not None and i != least
        out.append((str(i) if i is not None else None, len(p), hashlib.sha256(p).hexdigest(),
                    "revisit" if revisit else "response", str(least) if revisit else None))
    return sorted(out, key=str)


def pages():
    rng = random.Random(2)
    bodies = ["".join(rng.choices("<p>é \n", k=n)) for n in (40, 70, 99, 100, 101, 5000)] + [None, "", "z" * 100, "z" * 99]
    rows = [((i * 37) % 501, rng.choice(bodies), f"http://h/{i}") for i in range(120)]
    return rows + [(None, "z" * 100, None), (None, "only null id" * 20, ""), (3, "z" * 100, "u\n")]


def test_write_and_read(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS", 7)
    monkeypatch.setattr(warc, "RANGE", 300)
    rows = pages()
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, html string, url string, id string, digest string")
    got = [tuple(r)[:5] for r in warc.package_round_trip(table).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_archives_hold_what_they_say(spark):
    rows = pages()
    folder = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    table = spark.createDataFrame(rows, "page_id bigint, html string, url string")
    made = warc.write_archives(table, folder)
    assert sum(r.records for r in made.collect()) == len(rows)
    for r in made.collect():
        store, at = warc.open_store(r.path)
        assert zipfile.ZipFile(store.open_input_file(at)).testzip() is None
        assert store.get_file_info(at).size == r.bytes
    back = warc.read_archives(made).collect()
    assert {(r.page_id, bytes(r.payload)) for r in back if r.record_type == "response"} <= {
        (str(i) if i is not None else None, (h or "").encode()) for i, h, _ in rows}


def test_empty_table(spark):
    assert warc.package_round_trip(spark.createDataFrame([], "page_id bigint, html string, url string")).count() == 0


def test_headers_hold_any_id_and_url():
    odd = ["a\r\nWARC-Type: x", "50%41", " blank ", "é\x00日", "", "p:q"]
    urls = ["http://a/%20b?x=%41", "http://a/b c", " lead", "line\r\nWARC-Type: evil", "é", "tab\there", ""]
    for page in odd:
        for url in urls:
            data = warc.make_record(page, url, b"<p>", "ab", None)
            r = warc.parse_record(data)
            assert (r["page_id"], r["url"], r["record_type"], r["payload"]) == (page, url, "response", b"<p>")
            r = warc.parse_record(warc.make_record("7", url, b"<p>", "ab", page))
            assert (r["refers_to"], r["url"], r["record_type"]) == (page, url, "revisit")
    assert b"WARC-Target-URI: http://a/%20b?x=%41\r\n" in warc.make_record("1", urls[0], b"", "ab", None)
