"""Token ids as length-delimited binary records with a separate offset index.

A shard is two files. `NNNNNN.rec` holds one frame per document:

    length of the payload      u64
    masked crc32 of the length u32
    payload: doc_id i64, then the ids, u16 or u32 each
    masked crc32 of the payload u32

`NNNNNN.idx` starts with the id width (u64) and holds one entry per frame:
doc_id i64, offset of the frame u64, ids in it u64, ids before it in the shard
u64. All numbers are little-endian. A checksum is masked by rotating it right
by 15 bits and adding a constant, so that checksums of data that hold checksums
stay useful. With the index a reader can fetch frames in any order.
"""

from __future__ import annotations

import json
import operator
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .words import text_buffers

_MASK = 0xA282EAD8
_NULL_ID = -(2**63)
_ENTRY = np.dtype([("doc_id", "<i8"), ("offset", "<u8"), ("n_tokens", "<u8"), ("before", "<u8")])
# Words after which the memory of words begins a new generation.
_REMEMBERED = 400_000
_PIECE = 1 << 20

_BETWEEN = "\x01"
_TOGETHER = 5_000
_encoders: dict[tuple[str, int], tuple] = {}

# Rules under which a run of letters and what follows it without letters have ids of their
# own, whatever the case of the letters.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
# A word a line: letters of ASCII and Latin-1, which neither compose nor change their kind, then
# ASCII without letters; or anything else.
_LETTERS_AND_REST = re.compile(
    rb"(?m)^(?:((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)([!-@\[-`{-~]*+)$|.*$)"
)

Encode = Callable[[list[str]], Iterator[tuple[list[str], list[bytes]]]]
Cut = Callable[[list[bytes]], tuple[list[bytes], list[bytes]]]


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload)))
    )


def read_frame(stream) -> bytes:
    """The payload of the frame at the stream's place; a damaged one is an error."""
    head = stream.read(12)
    if len(head) < 12 or masked_crc(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged length in a record file")
    (length,) = struct.unpack("<Q", head[:8])
    payload, check = stream.read(length), stream.read(4)
    if len(payload) < length or len(check) < 4 or masked_crc(payload) != struct.unpack("<I", check)[0]:
        raise ValueError("damaged payload in a record file")
    return payload


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as a path or URI."""
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def whole(words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    return words, [b""] * len(words)


def letters_and_rest(words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Two pieces of each word, whose ids in a row are those of the word; other words stay whole."""
    found = _LETTERS_AND_REST.findall(b"\n".join(words)) if words else []
    letters = b"\n".join([first for first, _ in found]).lower().split(b"\n")
    return [first or word for first, word in zip(letters, words)], [rest for _, rest in found]


def _cut_of(rules: dict) -> Cut:
    """How words may be cut under the rules of a tokenizer."""
    known = (
        (rules["normalizer"] or {}).get("normalizers") == _NORMALIZERS
        and (rules["pre_tokenizer"] or {}).get("pretokenizers") == _PRE_TOKENIZERS
        # Added tokens are found first, so none may occur in a word that is cut.
        and all(re.search(r"[!-@\[-`{-~].*[A-Za-z]", token["content"]) for token in rules["added_tokens"])
    )
    return letters_and_rest if known else whole


def json_tokenizer(path: str, end_id: int) -> tuple[Encode, np.dtype, Cut]:
    """Encoder of word lists to bytes of ids, the type of the ids, and how words may be cut.

    Calls cost more than words, so many words are encoded as one text. A word of
    letters alone ends with the one of its ids that marks a word's end; if that
    does not cut the ids into as many pieces as words, and for other words, a
    control character with an id of its own stands between them. Words that hold
    that character go one by one.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    dtype = np.dtype("<u2" if max(tokenizer.get_vocab_size(), end_id + 1) <= 65536 else "<u4")
    mark = tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
    rules = json.loads(tokenizer.to_str())
    suffix = rules["model"].get("end_of_word_suffix") or ""
    last = np.zeros(tokenizer.get_vocab_size(), bool)
    if suffix:
        last[[i for t, i in tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def ids_of(text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype)

    def pieces(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        data, width = ids.tobytes(), dtype.itemsize
        return [data[x:y] for x, y in zip((starts * width).tolist(), (ends * width).tolist())]

    def by_ends(words: list[str]) -> list[bytes] | None:
        ids = ids_of(" ".join(words))
        cuts = np.flatnonzero(last[ids]) + 1
        if len(cuts) != len(words) or (len(cuts) and cuts[-1] != len(ids)):
            return None
        return pieces(ids, np.append(0, cuts[:-1]), cuts)

    def by_marks(words: list[str]) -> list[bytes]:
        if len(mark) != 1:
            return [ids_of(w).tobytes() for w in words]
        ids = ids_of(f" {_BETWEEN} ".join("" if _BETWEEN in w else w for w in words))
        cuts = np.flatnonzero(ids == mark[0])
        found = pieces(ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))
        return [ids_of(w).tobytes() if _BETWEEN in w else p for w, p in zip(words, found)]

    def encode(words: list[str]) -> Iterator[tuple[list[str], list[bytes]]]:
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        for a in range(0, len(letters), _TOGETHER):
            part = letters[a : a + _TOGETHER]
            yield part, by_ends(part) or by_marks(part)
        for a in range(0, len(others), _TOGETHER):
            part = others[a : a + _TOGETHER]
            yield part, by_marks(part)

    return encode, dtype, _cut_of(rules)


class Memory:
    """Ids of words by their bytes; words not met for a while are forgotten."""

    def __init__(self, cut: Cut = whole):
        # Plain dictionaries: sets are compared with these without a loop over all they hold.
        self.ids: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.cut = cut

    def _unknown(self, words: set[bytes]) -> set[bytes]:
        """Those of `words` that are in neither generation; older ones come over."""
        new = words.difference(self.ids)
        back = self.older.keys() & new
        self.ids.update(zip(back, map(self.older.__getitem__, back)))
        return new - back

    def learn(self, words: set[bytes], encode: Encode) -> None:
        """Words that differ in case or in what follows their letters share the work."""
        if len(self.ids) > _REMEMBERED:
            self.older, self.ids = self.ids, {b"": b""}
        new = list(self._unknown(words))
        first, rest = self.cut(new)
        pieces = self._unknown({*first, *rest})
        for part, ids in encode(b"\n".join(pieces).decode().split("\n") if pieces else []):
            self.ids.update(zip("\n".join(part).encode().split(b"\n"), ids))
        of = self.ids.__getitem__
        self.ids.update(zip(new, map(operator.add, map(of, first), map(of, rest))))


def encoded(
    texts: Iterator[bytes], encode: Encode, dtype: np.dtype, end_id: int, known: Memory
) -> Iterator[bytes]:
    """Ids of each text and `end_id`, as bytes.

    The tokenizer's rules never look across ASCII white space, which it drops,
    so a text's ids are those of its words in order. Each distinct piece of a
    word is encoded by the tokenizer once; the words are remembered in `known`.
    """
    end = np.array([end_id], dtype).tobytes()
    held: list[bytes] = []
    ends: list[int] = []
    size = 0

    def flush() -> Iterator[bytes]:
        ids = list(map(known.ids.get, held))
        new = [i for i, found in enumerate(ids) if found is None]
        known.learn({held[i] for i in new}, encode)
        for i in new:
            ids[i] = known.ids[held[i]]
        for first, last in zip([0, *ends], ends):
            yield b"".join(ids[first:last]) + end
        held.clear()
        ends.clear()

    for text in texts:
        held += text.split()
        ends.append(len(held))
        size += len(text)
        if size > _PIECE:
            yield from flush()
            size = 0
    yield from flush()


def _writing(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A Python worker serves many tasks: the tokenizer and the words stay with it.
        if (tokenizer, end_id) not in _encoders:
            encode, dtype, cut = json_tokenizer(tokenizer, end_id)
            _encoders[tokenizer, end_id] = encode, dtype, Memory(cut)
        encode, dtype, known = _encoders[tokenizer, end_id]
        task = TaskContext.get()
        shard = task.partitionId()
        system, base = open_folder(folder)
        place = f"{base}/{shard:06d}"
        own = f"{place}.attempt-{task.taskAttemptId()}"
        entries: list[tuple[int, int, int, int]] = []
        offset = total = 0
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{own}.rec") as out:
            for batch in batches:
                data, limits = text_buffers(batch["text"])
                texts = (data[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:]))
                ids = batch["doc_id"].fill_null(_NULL_ID).to_pylist()
                for doc_id, tokens in zip(ids, encoded(texts, encode, dtype, end_id, known)):
                    n = len(tokens) // dtype.itemsize
                    record = frame(struct.pack("<q", doc_id) + tokens)
                    out.write(record)
                    entries.append((doc_id, offset, n, total))
                    offset += len(record)
                    total += n
        with system.open_output_stream(f"{own}.idx") as out:
            out.write(struct.pack("<Q", dtype.itemsize) + np.array(entries, _ENTRY).tobytes())
        # A repeated task writes the same bytes again; only whole files get the name.
        for kind in ("rec", "idx"):
            system.move(f"{own}.{kind}", f"{place}.{kind}")
        if entries:
            yield pa.record_batch(
                {"shard": pa.array([shard]), "n_docs": pa.array([len(entries)]), "shard_tokens": pa.array([total])}
            )

    return write


def write_token_files(
    docs: DataFrame, folder: str, *, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encodes whole texts into record files below `folder`; a row per shard.

    Shards follow each other in ascending order of the key (null first, equal
    keys by text hash, so that a hot key can be split), and so do the documents
    in them. Null text counts as empty: a record with the end id alone. An
    empty table gives no shards. Other columns are not looked at. The manifest
    (shard, n_docs, shard_tokens, before) is stored; `before` counts the ids of
    all earlier shards.
    """
    ordered = (
        docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )
    shards = materialize(
        ordered.mapInArrow(_writing(folder, tokenizer, end_id), "shard long, n_docs long, shard_tokens long"),
        "token-shards",
    )
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("before", F.coalesce(F.sum("shard_tokens").over(earlier), F.lit(0)))


def read_shard(folder: str, shard: int) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """(doc_id, offset, ids before it in the shard, ids) of every record in order."""
    system, base = open_folder(folder)
    width, entries = read_index(folder, shard)
    with system.open_input_stream(f"{base}/{shard:06d}.rec", buffer_size=_PIECE) as stream:
        for entry in entries:
            yield _record(read_frame(stream), entry, width)


def read_index(folder: str, shard: int) -> tuple[int, np.ndarray]:
    """Id width and entries of a shard."""
    system, base = open_folder(folder)
    with system.open_input_stream(f"{base}/{shard:06d}.idx") as stream:
        raw = stream.read()
    return struct.unpack("<Q", raw[:8])[0], np.frombuffer(raw[8:], _ENTRY)


def read_records_at(folder: str, shard: int, places: list[int]) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """The records with the given numbers of a shard, in the given order."""
    system, base = open_folder(folder)
    width, entries = read_index(folder, shard)
    with system.open_input_file(f"{base}/{shard:06d}.rec") as file:
        for i in places:
            file.seek(int(entries[i]["offset"]))
            yield _record(read_frame(file), entries[i], width)


def _record(payload: bytes, entry: np.void, width: int) -> tuple[int | None, int, int, np.ndarray]:
    (doc_id,) = struct.unpack("<q", payload[:8])
    ids = np.frombuffer(payload, f"<u{width}", offset=8)
    if doc_id != entry["doc_id"] or len(ids) != entry["n_tokens"]:
        raise ValueError("a record file and its index differ")
    return (None if doc_id == _NULL_ID else doc_id), int(entry["offset"]), int(entry["before"]), ids


def read_token_files(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, shard, offset of every record.

    Each task reads whole shards record by record and checks every checksum.
    `start` counts the ids of all records before.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before in zip(batch["shard"].to_pylist(), batch["before"].to_pylist()):
                rows = [
                    (doc_id, before + earlier, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), shard, offset)
                    for doc_id, offset, earlier, ids in read_shard(folder, shard)
                ]
                names = ("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")
                yield pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*rows))})

    n = max(1, shards.count())
    return shards.select("shard", "before").repartition(n).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard long, offset long"
    )


def token_files(spark: SparkSession, docs: DataFrame, *, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    folder = scratch_path(spark, "token-files")
    shards = write_token_files(docs, folder, tokenizer=tokenizer, end_id=end_id)
    return read_token_files(spark, folder, shards)
