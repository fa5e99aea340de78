import base64
import hashlib
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tollbook.llm import warc
from tollbook.llm.common import work_folder

SCHEMA = "page_id long, url string, html string, payload string, same string, original long"


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], SCHEMA)


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, **options):
    folder = work_folder(spark, "warc")
    manifest = warc.write_archives(pages(spark, *rows), folder, **options)
    return manifest, sorted(warc.read_archives(manifest, folder).collect(), key=lambda r: str(r.page_id))


def test_records_come_back_as_they_went(spark):
    rows = [(k, f"http://x/{k}", f"<p>{k % 7} text é</p>" * (k % 5)) for k in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "line\r\nbreak: y", "\r\n\r\nWARC/1.1\r\n"), (103, "u", "long " * 500_000)]
    manifest, found = round_trip(spark, rows)
    last = {}
    for key, _, html in rows:
        last[html or ""] = max(key, last.get(html or "", key))
    expected = {}
    for key, _, html in rows:
        response = last[html or ""] == key
        expected[key] = (
            len((html or "").encode()), sha1(html), "response" if response else "revisit",
            None if response else last[html or ""], (html or "").encode() if response else None,
        )
    assert {
        r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (b"" if r.record_type == "response" else None))
        for r in found
    } == expected
    assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)


def test_small_payloads_are_not_revisited(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    _, found = round_trip(spark, rows, min_bytes=3)
    assert [r.record_type for r in found] == ["response", "response", "revisit", "response"]


def test_null_and_repeated_pages(spark):
    rows = [(None, "u", "a"), (5, "u", "a"), (5, "u", "a"), (None, "u", "b"), (2, "u", "a")]
    _, found = round_trip(spark, rows)
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in found) == [
        ("2", "revisit", 5), ("5", "response", None), ("5", "response", None),
        ("None", "response", None), ("None", "revisit", 5),
    ]
    empty, found = round_trip(spark, [])
    assert empty.count() == 0 and found == []


def test_archives_carry_their_dictionary(spark, tmp_path):
    """A skippable frame, then one frame a record that needs the dictionary."""
    writer = warc.ArchiveWriter(f"file://{tmp_path}", 3)
    bodies = [f"<html><body>page {k} of a site with common markup</body></html>".encode() * 30 for k in range(300)]
    for k, body in enumerate(bodies):
        writer.add(warc.record(k, "http://x", body, warc.digest(body), len(body), None))
    writer.close()
    ((path, count, _),) = writer.done
    raw = open(path, "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == warc.DICTIONARY_FRAME and count == 300
    trained = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=trained).decompressobj().decompress(raw[8 + size :])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: response")
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompressobj().decompress(raw[8 + size :])
    plain = zstandard.ZstdCompressor(level=3)
    alone = sum(len(plain.compress(warc.record(k, "http://x", b, warc.digest(b), len(b), None))) for k, b in enumerate(bodies))
    assert len(raw) - 8 - size < alone
    with open(path, "rb") as stream:
        assert sum(1 for _ in warc.records_of(stream)) == 300


@pytest.mark.parametrize("sizes", [[4 << 20], [100_000], [8 << 20, *[3000] * 100], [70_000, 500]])
def test_long_records_have_a_dictionary(tmp_path, sizes):
    """Few but long records give samples enough, from all of their length."""
    rng = np.random.default_rng(5)
    words = np.array([f"word{k} " for k in range(5000)])
    writer = warc.ArchiveWriter(f"file://{tmp_path}", 0)
    for k, size in enumerate(sizes):
        body = "".join(rng.choice(words, size // 5)).encode()[:size]
        writer.add(warc.record(k, "http://x", body, warc.digest(body), len(body), None))
    writer.close()
    ((path, count, _),) = writer.done
    with open(path, "rb") as stream:
        assert struct.unpack("<I", stream.read(4))[0] == warc.DICTIONARY_FRAME
        stream.seek(0)
        assert sum(1 for _ in warc.records_of(stream)) == count == len(sizes)


def test_archives_are_closed_at_their_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 10_000)
    writer = warc.ArchiveWriter(f"file://{tmp_path}", 0)
    for k in range(50):
        writer.add(warc.record(k, "u", b"x" * 1000, warc.digest(b"x" * 1000), 1000, None))
    writer.close()
    assert len(writer.done) > 3 and sum(n for _, n, _ in writer.done) == 50


def test_a_broken_archive_is_noticed(tmp_path):
    writer = warc.ArchiveWriter(f"file://{tmp_path}", 0)
    writer.add(warc.record(1, "u", b"payload", warc.digest(b"payload"), 7, None))
    writer.close()
    raw = open(writer.done[0][0], "rb").read()
    (tmp_path / "cut").write_bytes(raw[:-3])
    with open(tmp_path / "cut", "rb") as stream, pytest.raises(ValueError):
        list(warc.records_of(stream))


def test_page_numbers_survive_record_names():
    for page in (0, 1, -1, 2**63 - 1, -(2**63)):
        assert warc.page_of(warc.record_id(page)) == page
