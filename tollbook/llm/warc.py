"""WARC archives compressed record by record with a dictionary of their own.

An archive is a skippable Zstandard frame that holds the dictionary, followed by
one frame a record, as the ``.warc.zst`` convention has it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.llm.common import lookup, stored, text_of

#: Fixed values of the format.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = "WARC/1.1"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Upper half of the record ids; the lower half is the page's number.
RECORD_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record").int >> 64 << 64

#: Bytes of samples that an archive's dictionary is built from, the dictionary's size,
#: and the uncompressed size past which an archive is closed.
SAMPLE, DICTIONARY, ARCHIVE = 4 << 20, 64 << 10, 64 << 20
#: Records are sampled in pieces of so many bytes, so many of one record at most; and
#: so many bytes of records are held at most while samples are waited for.
PIECE, PIECES, HELD = 4 << 10, 64, 16 << 20
#: What is too small for a dictionary goes without.
LEAST_SAMPLE = 64 << 10

MANIFEST = "path string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def record_id(page_id: int | None) -> str:
    """A record's name follows from its page, so that revisits can name it."""
    return f"<urn:uuid:{uuid.UUID(int=RECORD_SPACE | (page_id or 0) & (1 << 64) - 1)}>"


def page_of(name: str) -> int:
    low = uuid.UUID(name.strip("<>").rpartition(":")[2]).int & (1 << 64) - 1
    return low - (1 << 64) if low >> 63 else low


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes | None, sha1: str, size: int, original: int | None) -> bytes:
    """One record's bytes: a response with its payload, or, if ``original`` names the
    page that has it, a revisit without."""
    head = [VERSION, f"WARC-Type: {'response' if original is None else 'revisit'}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: {record_id(page_id)}")
    else:
        head.append(f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, url + sha1)}>")
        head.append("X-No-Page: 1")
    # A line break in a URL would end the header line.
    head += [f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if original is None:
        block = HTTP % size + (payload or b"")
    else:
        block = HTTP % size
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(original)}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """What RECORDS lists, from one record's bytes; the payload's size and digest are
    taken anew from a response's payload, and from the headers of a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = None if "X-No-Page" in fields else page_of(fields["WARC-Record-ID"])
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if digest(payload) != stated:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
        return page, fields["WARC-Target-URI"], len(payload), digest(payload), "response", None, payload
    size = int(http.rpartition(b"Content-Length: ")[2])
    return page, fields["WARC-Target-URI"], size, stated, "revisit", page_of(fields["WARC-Refers-To"]), None


class ArchiveWriter:
    """Archives in one folder, written under names of their own until they are whole.

    The dictionary is built from the archive's own first records, until they give
    SAMPLE bytes of samples or HELD bytes are held; it bears on size alone, never on
    content.
    """

    def __init__(self, folder: str, task: int):
        self.files, self.base = pa.fs.FileSystem.from_uri(folder)
        self.files.create_dir(self.base, recursive=True)
        self.task, self.number, self.done = task, 0, []
        self._open()

    def _open(self) -> None:
        self.waiting: list[bytes] = []
        self.size = self.count = self.sampled = 0
        self.out = None

    def add(self, raw: bytes) -> None:
        self.size += len(raw)
        self.count += 1
        if self.out is None:
            self.waiting.append(raw)
            self.sampled += min(len(raw), PIECE * PIECES)
            if self.sampled >= SAMPLE or self.size >= HELD:
                self._begin()
        else:
            self.out.write(self.compressor.compress(raw))
        if self.size >= ARCHIVE:
            self.close()

    def _begin(self) -> None:
        name = f"{self.task:08d}-{self.number:05d}"
        self.number += 1
        self.part = f"{self.base}/_{name}-{uuid.uuid4().hex}"
        self.path = f"{self.base}/{name}.warc.zst"
        self.out = self.files.open_output_stream(self.part)
        trained = self._dictionary()
        if trained is None:
            self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)
        else:
            raw = trained.as_bytes()
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
            self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        for raw in self.waiting:
            self.out.write(self.compressor.compress(raw))
        self.waiting = []

    def _dictionary(self) -> zstandard.ZstdCompressionDict | None:
        # Training wants many samples, so long records are cut, into pieces from all of
        # their length; a few cannot train.
        samples = [
            raw[k : k + PIECE]
            for raw in self.waiting
            for k in range(0, len(raw), max(PIECE, -(-len(raw) // PIECES)))
        ]
        if sum(map(len, samples)) < LEAST_SAMPLE:
            return None
        try:
            return zstandard.train_dictionary(DICTIONARY, samples, threads=0)
        except zstandard.ZstdError:
            return None  # all samples alike: nothing to train on

    def close(self) -> None:
        if self.count:
            if self.out is None:
                self._begin()
            self.out.close()
            self.files.move(self.part, self.path)
            self.done.append((self.path, self.count, self.size))
        self._open()


def records_of(stream) -> Iterator[bytes]:
    """The records of an archive, one frame each, read as they come."""
    data, dictionary = b"", None
    head = stream.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", head[4:])[0]
        dictionary = zstandard.ZstdCompressionDict(stream.read(size))
    else:
        data = head
    unpack = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    frame, parts = None, []
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                if frame is not None:
                    raise ValueError("archive ends within a record")
                return
        if frame is None:
            frame, parts = unpack.decompressobj(), []
        parts.append(frame.decompress(data))
        data = b""
        if frame.eof:
            data = frame.unused_data
            frame = None
            yield b"".join(parts)


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``payload_digest`` (SHA-1, base 32 later), ``size`` and
    ``refers_to``: the largest page number among equal payloads of ``min_bytes`` or
    more, null for that page itself.

    Payloads are equal if two digests and their size are. Pages are reduced to
    numbers per payload before the shuffle; a payload that very many pages share is
    looked up without sending those pages to one task.
    """
    html = text_of("html")
    raw = F.encode(html, "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("size"),
        F.unhex(F.sha2(raw, 256)).alias("same"),
    )
    groups = rows.groupBy("same", "size").agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
    groups = groups.filter((F.col("n") > 1) & (F.col("size") >= min_bytes))
    found = lookup(rows, stored(groups, "payloads"), ["same", "size"], "n")
    return found.select(
        "page_id", "url", "html", "size",
        F.when(F.col("original") != F.col("page_id"), F.col("original"))
        .when(F.col("page_id").isNull(), F.col("original"))
        .alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """A record for every page in ``folder``, and the manifest: ``path``,
    ``n_records``, ``n_bytes`` (uncompressed).

    Of equal payloads the page with the largest number is the response and the
    others revisit it; pages that repeat that number with that payload are responses
    as well. A null payload is empty, a null URL is empty, a page without a number
    revisits one that has the same payload and otherwise is a response. Other
    columns are ignored; an empty table gives no archives.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            out = out or ArchiveWriter(folder, TaskContext.get().partitionId())
            columns = [batch.column(k) for k in range(5)]
            for page_id, url, html, size, original in zip(*columns, strict=True):
                payload = (html.as_py() or "").encode()
                original = original.as_py()
                out.add(record(page_id.as_py(), url.as_py(), payload, digest(payload), size.as_py(), original))
        if out:
            out.close()
            paths, counts, sizes = zip(*out.done, strict=True) if out.done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "n_records", "n_bytes"],
            )

    rows = with_originals(pages, min_bytes).select("page_id", "url", "html", "size", "refers_to")
    return stored(rows.mapInArrow(run, MANIFEST), "archives")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that the manifest lists, as RECORDS says; an
    archive is read as a stream, record by record."""
    names = [c.split()[0] for c in RECORDS.split(", ")]
    schema = pa.schema(
        zip(names, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()], strict=True)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for raw in records_of(stream):
                        rows.append(parse(raw) if payloads else (*parse(raw)[:-1], None))
                        held += len(raw) if payloads else 256
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    archives = max(1, manifest.count())
    return manifest.select("path").repartition(archives).mapInArrow(run, RECORDS)
