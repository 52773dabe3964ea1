"""Web archives of one zstandard frame per record, with a dictionary in front.

An archive starts with a skippable frame (magic number 0x184D2A5D) that holds
the dictionary, itself compressed. Each further frame is one WARC/1.1 record
compressed with it, so a record can be read from its offset alone.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .token_files import open_folder

# The formats' magic numbers and the profile of a revisit record.
_DICTIONARY_MAGIC = 0x184D2A5D
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FRAME_START = struct.pack("<I", 0xFD2FB528)
_TRAINED_START = struct.pack("<I", 0xEC30A437)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
_LEVEL = 3
_READ_BYTES = 1 << 20
_ROWS = 1_000

RECORD = (
    "archive string, offset long, record_type string, record_id string, refers_to_id string, page_id long, "
    "url string, payload_bytes long, payload_digest string"
)


class DamagedArchive(ValueError):
    """A frame, header or length that is not as it has to be."""


# --- records ----------------------------------------------------------------


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(text: str) -> str:
    """Without the characters that would end or hide a header line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in text)


def record(kind: str, record_id: str, date: str, block: bytes, fields: list[tuple[str, str]], content_type: str) -> bytes:
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        *fields,
        ("WARC-Block-Digest", sha1_label(block)),
        ("Content-Type", content_type),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, record_id: str, refers_to_id: str | None, date: str
) -> bytes:
    """A page as response, or as revisit of the record `refers_to_id` without its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Payload-Digest", sha1_label(payload))]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to_id is None:
        return record("response", record_id, date, http + payload, fields, "application/http; msgtype=response")
    fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to_id}>")]
    return record("revisit", record_id, date, http, fields, "application/http; msgtype=response")


def _fields(head: bytes, what: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise DamagedArchive(f"{what} line {line[:80]!r}")
        key = name.decode().lower()
        if key in found:
            raise DamagedArchive(f"{what} field {key} twice")
        found[key] = value.strip().decode()
    return found


def _length(fields: dict[str, str], what: str) -> int:
    text = fields.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise DamagedArchive(f"{what} length {text!r}")
    return int(text)


def _uri(text: str) -> str:
    if len(text) < 3 or text[0] != "<" or text[-1] != ">":
        raise DamagedArchive(f"record id {text[:80]!r}")
    return text[1:-1]


@dataclass
class Record:
    kind: str
    record_id: str
    fields: dict[str, str]
    block: bytes


def parse_record(data: bytes) -> Record:
    """The one record of a frame; header fields, block length and block digest are checked."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not blank or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise DamagedArchive(f"record start {data[:20]!r}")
    fields = _fields(lines, "record")
    missing = [name for name in _REQUIRED if name not in fields]
    if missing:
        raise DamagedArchive(f"record without {missing[0]}")
    length = _length(fields, "record")
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise DamagedArchive(f"record of {len(rest) - 4} bytes says {length}")
    block = rest[:length]
    if fields.get("warc-block-digest", sha1_label(block)) != sha1_label(block):
        raise DamagedArchive("block digest")
    return Record(fields["warc-type"], _uri(fields["warc-record-id"]), fields, block)


def page_row(found: Record) -> dict:
    """What a response or revisit record says about its page; `payload` is None for a revisit."""
    head, blank, payload = found.block.partition(b"\r\n\r\n")
    status, _, lines = head.partition(b"\r\n")
    if not blank or not status.startswith(b"HTTP/"):
        raise DamagedArchive(f"response start {found.block[:20]!r}")
    length = _length(_fields(lines, "response"), "response")
    label = found.fields.get("warc-payload-digest", "")
    refers_to = None
    if found.kind == "revisit":
        if payload or found.fields.get("warc-profile") != _PROFILE:
            raise DamagedArchive("revisit record")
        refers_to = _uri(found.fields.get("warc-refers-to", ""))
    elif length != len(payload):
        raise DamagedArchive(f"payload of {len(payload)} bytes says {length}")
    elif label != sha1_label(payload):
        raise DamagedArchive("payload digest")
    if len(label) != 37 or not label.startswith("sha1:"):
        raise DamagedArchive(f"payload digest {label[:80]!r}")
    page_id = found.fields.get("x-page-id")
    return {
        "record_type": found.kind,
        "record_id": found.record_id,
        "refers_to_id": refers_to,
        "page_id": None if page_id is None else int(page_id),
        "url": found.fields.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": base64.b32decode(label[5:]).hex(),
        "payload": None if refers_to else payload,
    }


# --- frames -----------------------------------------------------------------


def dictionary_of(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; the samples' own ends where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def dictionary_frame(dictionary: zstandard.ZstdCompressionDict) -> bytes:
    packed = zstandard.ZstdCompressor(level=_LEVEL).compress(dictionary.as_bytes())
    return struct.pack("<II", _DICTIONARY_MAGIC, len(packed)) + packed


def load_dictionary(stream: io.IOBase) -> zstandard.ZstdCompressionDict | None:
    """From the leading skippable frame; None for an archive that starts with a record."""
    start = stream.read(8)
    if start[:4] == _FRAME_START or not start:
        return None
    if len(start) < 8 or struct.unpack("<I", start[:4])[0] != _DICTIONARY_MAGIC:
        raise DamagedArchive(f"archive start {start!r}")
    (size,) = struct.unpack("<I", start[4:])
    data = stream.read(size)
    if len(data) < size:
        raise DamagedArchive("dictionary cut off")
    if data[:4] == _FRAME_START:
        try:
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        except zstandard.ZstdError as error:
            raise DamagedArchive("dictionary") from error
    kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == _TRAINED_START else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


def frames(stream: io.IOBase, at: int, end: int | None, reader: zstandard.ZstdDecompressor) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the frames from `at` up to `end`, or the end of the file.

    The file is read piecewise, so only one frame is held at a time.
    """
    stream.seek(at)
    held = b""
    while end is None or at < end:
        while len(held) < 8 and (more := stream.read(_READ_BYTES)):
            held += more
        if not held:
            if end is None:
                return
            raise DamagedArchive(f"archive ends at {at}, not at {end}")
        if len(held) >= 8 and struct.unpack("<I", held[:4])[0] in _SKIPPABLE:
            size = 8 + struct.unpack("<I", held[4:8])[0]
            at += size
            held = held[size:]
            stream.seek(at + len(held))
            continue
        parts, taken, one = [], 0, reader.decompressobj()
        while not one.eof:
            if not held and not (held := stream.read(_READ_BYTES)):
                raise DamagedArchive(f"frame at {at} is cut off")
            try:
                parts.append(one.decompress(held))
            except zstandard.ZstdError as error:
                raise DamagedArchive(f"frame at {at}: {error}") from error
            taken += len(held)
            held = one.unused_data if one.eof else b""
        size = taken - len(held)
        yield at, b"".join(parts)
        at += size


def open_archive(folder: str, archive: str):
    """(stream, decompressor) of an archive; the caller closes the stream."""
    system, base = open_folder(folder)
    stream = system.open_input_file(f"{base}/{archive}")
    return stream, zstandard.ZstdDecompressor(dict_data=load_dictionary(stream))


def read_record_at(folder: str, archive: str, offset: int) -> dict:
    """One page by its place, without the records around it."""
    stream, reader = open_archive(folder, archive)
    with stream:
        return page_row(parse_record(next(frames(stream, offset, None, reader))[1]))


# --- tables -----------------------------------------------------------------


def _urn(name: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}"


class _Archives:
    """Writes records to archives of about `archive_bytes`; says where blocks of them are."""

    def __init__(self, folder: str, name: str, dictionary, archive_bytes: int, block_bytes: int):
        self.system, self.base = open_folder(folder)
        self.name, self.dictionary = name, dictionary
        self.archive_bytes, self.block_bytes = archive_bytes, block_bytes
        self.writer = zstandard.ZstdCompressor(level=_LEVEL, dict_data=dictionary, write_checksum=True)
        self.n_archives, self.out = 0, None
        self.blocks: list[tuple[str, int, int, int]] = []

    def _open(self) -> None:
        self.archive = f"{self.name}-{self.n_archives:04d}.warc.zst"
        self.out = self.system.open_output_stream(f"{self.base}/{self.archive}", compression=None)
        start = dictionary_frame(self.dictionary)
        self.out.write(start)
        self.start = self.at = len(start)
        self.n_archives, self.n_records = self.n_archives + 1, 0

    def add(self, data: bytes) -> None:
        if self.out is None:
            self._open()
        packed = self.writer.compress(data)
        self.out.write(packed)
        self.at += len(packed)
        self.n_records += 1
        if self.at - self.start >= self.block_bytes:
            self._end_block()
        if self.at >= self.archive_bytes:
            self.close()

    def _end_block(self) -> None:
        if self.n_records:
            self.blocks.append((self.archive, self.start, self.at, self.n_records))
        self.start, self.n_records = self.at, 0

    def close(self) -> None:
        if self.out is not None:
            self._end_block()
            self.out.close()
            self.out = None


def _writing(folder: str, date: str, dictionary_bytes: int, sample_bytes: int, archive_bytes: int, block_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        # The name is the attempt's own: a task run again never meets earlier files,
        # and only the blocks of the attempt that counts are listed.
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)

        def records() -> Iterator[bytes]:
            n = 0
            for batch in batches:
                for page_id, url, html, key, revisit in zip(*(batch[c] for c in range(5))):
                    payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                    same, n = key.as_py(), n + 1
                    shared = None if same is None else _urn(f"payload {same.hex()}")
                    own = _urn(f"{base} {name} {n}") if shared is None or revisit.as_py() else shared
                    yield page_record(page_id.as_py(), url.as_py(), payload, own, shared if revisit.as_py() else None, date)

        def flush() -> _Archives:
            opened = _Archives(folder, name, dictionary_of(held, dictionary_bytes), archive_bytes, block_bytes)
            for data in held:
                opened.add(data)
            held.clear()
            return opened

        held: list[bytes] = []
        size, archives = 0, None
        for data in records():
            if archives is not None:
                archives.add(data)
                continue
            held.append(data)
            size += len(data)
            if size >= sample_bytes:
                archives = flush()
        if held:
            archives = flush()
        if archives is not None:
            archives.close()
            columns = zip(*archives.blocks)
            yield pa.record_batch(dict(zip(("archive", "first", "last", "n_records"), map(list, columns))))

    return write


def with_responses(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, url, html, same, revisit): `same` is the SHA-256 of a payload that occurs again."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    key = F.when(F.octet_length("html") >= least_bytes, F.unhex(F.sha2("html", 256)))
    groups = (
        pages.filter(F.octet_length("html") >= least_bytes)
        .groupBy(key.alias("same"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response"))
        .filter("n > 1")
        .drop("n")
    )
    # Only payloads that occur again; their measured size decides whether the pages are shuffled.
    repeated = materialize(groups, "warc-repeated")
    keyed = pages.withColumn("key", key)
    joined = keyed.join(repeated, F.col("key") == F.col("same"), "left")
    revisit = F.col("same").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.select("page_id", "url", F.col("html").cast("binary").alias("html"), "same", revisit.alias("revisit"))


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    least_bytes: int = 1000,
    date: str = "2000-01-01T00:00:00Z",
    dictionary_bytes: int = 16 << 10,
    sample_bytes: int = 1 << 20,
    archive_bytes: int = 512 << 20,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Write the pages; (archive, first, last, n_records) of each block of frames.

    Each task writes archives of its own, compressed with a dictionary trained
    on its first `sample_bytes` of records. The blocks let readers share an
    archive between tasks.
    """
    write = _writing(folder, date, dictionary_bytes, sample_bytes, archive_bytes, block_bytes)
    blocks = with_responses(pages, least_bytes).mapInArrow(
        write, "archive string, first long, last long, n_records long"
    )
    return materialize(blocks, "warc-blocks")


def _reading(folder: str, payloads: bool):
    names = [field.split()[0] for field in RECORD.split(", ")] + ["payload"] * payloads

    def rows(block: dict) -> Iterator[dict]:
        stream, reader = open_archive(folder, block["archive"])
        n = 0
        with stream:
            for offset, data in frames(stream, block["first"], block["last"], reader):
                found = parse_record(data)
                n += 1
                if found.kind in ("response", "revisit"):
                    yield {"archive": block["archive"], "offset": offset, **page_row(found)}
        if n != block["n_records"]:
            raise DamagedArchive(f"{n} records instead of {block['n_records']} in a block of {block['archive']}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{name: row[name] for name in names} for row in held], _schema(payloads))

        for blocks in batches:
            for block in blocks.to_pylist():
                for row in rows(block):
                    held.append(row)
                    size += row["payload_bytes"] * payloads
                    if len(held) >= _ROWS or size > _READ_BYTES:
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()

    return read


def _schema(payloads: bool) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [(name, kinds[kind]) for name, kind in (field.split() for field in RECORD.split(", "))]
    return pa.schema(fields + [("payload", pa.binary())] * payloads)


def read_archives(spark: SparkSession, blocks: DataFrame, folder: str, *, payloads: bool = False) -> DataFrame:
    """A row per response or revisit record of the listed blocks, validated.

    The dictionary comes from the archive's leading skippable frame, each
    further frame is one record. Frame checksums, header fields, block and
    payload lengths and digests are checked; what does not fit raises
    `DamagedArchive` and stops the job. With `payloads` the payload comes along
    (null for revisits).
    """
    # A task per block: the blocks are about equal, the archives need not be.
    dealt = blocks.repartitionByRange(max(1, blocks.count()), "archive", "first")
    return dealt.mapInArrow(_reading(folder, payloads), RECORD + ", payload binary" * payloads)


def resolved(records: DataFrame) -> DataFrame:
    """Adds `refers_to`, the page_id of the response a revisit names.

    A revisit whose response is missing, or has another payload, is an error.
    `records` is read twice; hand in a stored table.
    """
    responses = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("target_id"))
        .agg(F.max("page_id").alias("target"), F.max("payload_digest").alias("target_digest"))
    )
    revisits = records.filter("record_type = 'revisit'").join(
        responses, F.col("refers_to_id") == F.col("target_id"), "left"
    )
    same = F.col("target_digest").eqNullSafe(F.col("payload_digest"))
    checked = F.when(same, F.col("target")).otherwise(
        F.raise_error(F.concat(F.lit("revisit without its response: "), "record_id")).cast("long")
    )
    others = records.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    return others.unionByName(revisits.withColumn("refers_to", checked).drop("target_id", "target", "target_digest"))


def warc_records(spark: SparkSession, pages: DataFrame, *, least_bytes: int = 1000) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back.

    `pages` has (page_id, url, html), other columns are ignored. Of the pages
    with equal payloads of `least_bytes` or more the one with the largest
    page_id is the response and the others revisit it; equality is that of the
    SHA-256 of the payload. Columns are those of `read_archives`, and
    `refers_to`.

    A null html is an empty payload, a null url leaves out the target URI and a
    null page_id the page id, which comes back null; it counts as smaller than
    any other. Control characters and spaces of a url are percent-encoded. Rows
    that share payload and the largest page_id are one response, written as
    often as it occurs. Pages of any length are one record in one frame. An
    empty table gives no archive and no rows.
    """
    folder = scratch_path(spark, "warc")
    blocks = write_archives(pages, folder, least_bytes=least_bytes)
    return resolved(materialize(read_archives(spark, blocks, folder), "warc-records"))
