"""Token ids as length-delimited binary records with an offset index.

A shard holds consecutive documents in ascending doc_id order.  A record is

    8 bytes  payload length (little-endian unsigned)
    4 bytes  masked checksum of these eight bytes
    n bytes  payload: a null flag, the doc_id (signed 64 bits), the ids
    4 bytes  masked checksum of the payload

The ids are unsigned 16-bit numbers where the vocabulary allows, else 32-bit.
The checksum is CRC-32, rotated right by 15 bits plus a constant, so that a
checksum stored in data that is summed again does no harm.  The index of a
shard lists offset (64 bits) and token count (32 bits) of every record, for
reads in any order (`read_record`).

Shards are written by the tasks into the shared folder under a name of their
attempt; the manifest, committed by Spark, names the files of the attempts
that counted, so a lost or repeated task leaves no part of a shard behind it.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import scratch_path

from .bpe import Memory, _byte_letters, shipped, vocabulary
from .common import small_batches, table

END_ID = 0
MASK = 0xA282EAD8
# struct formats of a record's head, a payload's document and an index entry
_HEAD, _ID, _ENTRY = "<QI", "<?q", "<QI"
READ_ROWS = 4096
_CODECS: dict[str, "ByteLevelCodec"] = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def _plain_split() -> re.Pattern:
    """The splitting pattern of `ByteLevelCodec` for plain texts, whose letters
    and numbers are listed one by one; the commonest alternatives come first
    (a contraction begins with neither a space, a letter nor a number)."""
    plain = [chr(k) for k in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x250))]
    letters, numbers = (re.escape("".join(c for c in plain if unicodedata.category(c)[0] == kind)) for kind in "LN")
    return re.compile(rf" ?[{letters}]+| ?[{numbers}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+")


class ByteLevelCodec:
    """Ids of whole texts from a byte-level tokenizer file.  A plain text (white
    space and visible characters of ASCII, Latin letters and signs) is split by
    the tokenizer's pattern and each distinct piece is merged by the library's
    BPE model once.  Other texts are cut before ASCII white space that follows a
    character, where the tokenizer's own splitting always cuts, and each distinct
    chunk is encoded once; a chunk with rare characters by the library, a text
    with other white space or with a special token's literal in one piece."""

    _CHUNK = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
    _OTHER_SPACE = re.compile(
        "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
    _RARE = re.compile("[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u024f]")
    # Fixed value: the splitting pattern of byte-level BPE vocabularies.
    _SPLIT = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
    _PLAIN = _plain_split()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.type = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = "H" if self.type == "<u2" else "I"
        self.letters = _byte_letters()
        self.pieces = Memory(self._piece)
        self.chunks = Memory(self._chunk)

    def _packed(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._packed([t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))])

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> bytes:
        if self._RARE.search(chunk):
            return self._whole(chunk)
        return b"".join(map(self.pieces.__getitem__, self._SPLIT.findall(chunk)))

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole(text)
        if not self._RARE.search(text):
            return b"".join(map(self.pieces.__getitem__, self._PLAIN.findall(text)))
        if self._OTHER_SPACE.search(text):
            return self._whole(text)
        return b"".join(map(self.chunks.__getitem__, self._CHUNK.findall(text)))


def _codec(path: str) -> ByteLevelCodec:
    if path not in _CODECS:
        _CODECS[path] = ByteLevelCodec(path)
    return _CODECS[path]


def _open(uri: str):
    """(file system, path) of a folder or file named by a URI or a path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Encode `docs` (doc_id, text) and write shards into `folder`; returns
    the manifest (shard, file, index_file, n_records, n_tokens, width), committed
    as `folder`/manifest.

    Null text is empty; a null doc_id comes first; rows with one doc_id are
    ordered by their text and may share shards."""
    spark = docs.sparkSession
    small_batches(spark)
    name = shipped(spark, path)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(
        n, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(SparkFiles.get(name))
        end = np.array([end_id], codec.type).tobytes()
        width = len(end)
        task = TaskContext.get()
        shard = task.partitionId()
        stem = f"{folder}/shard-{shard:06d}-{task.taskAttemptId()}"
        system, target = _open(stem)
        records = tokens = at = 0
        data = index = None
        for batch in batches:
            if data is None:
                data = system.open_output_stream(target + ".rec", buffer_size=1 << 20)
                index = system.open_output_stream(target + ".idx", buffer_size=1 << 16)
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = codec.encode(text) + end
                null = pd.isna(doc_id)
                payload = struct.pack(_ID, null, 0 if null else int(doc_id)) + ids
                head = struct.pack("<Q", len(payload))
                data.write(head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload)))
                index.write(struct.pack(_ENTRY, at, len(ids) // width))
                at += 16 + len(payload)
                records, tokens = records + 1, tokens + len(ids) // width
        if data is not None:
            data.close()
            index.close()
            yield pd.DataFrame([(shard, stem + ".rec", stem + ".idx", records, tokens, width)],
                               columns=["shard", "file", "index_file", "n_records", "n_tokens", "width"])

    schema = "shard int, file string, index_file string, n_records bigint, n_tokens bigint, width int"
    # ids as objects keep 64 bits beside nulls
    rows = dealt.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    rows.mapInPandas(write, schema).write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


def _payload(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    null, doc_id = struct.unpack_from(_ID, payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_ID))


def _checked(head: bytes, read) -> bytes:
    length, crc = struct.unpack(_HEAD, head)
    if masked(head[:8]) != crc:
        raise ValueError("a record's length does not match its checksum")
    payload = read(length)
    if len(payload) != length or masked(payload) != struct.unpack("<I", read(4))[0]:
        raise ValueError("a record does not match its checksum")
    return payload


def records(file: str, width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of every record of a shard, in order, checksums verified."""
    system, path = _open(file)
    with system.open_input_stream(path, buffer_size=1 << 20) as stream:
        while head := stream.read(struct.calcsize(_HEAD)):
            yield _payload(_checked(head, stream.read), width)


def read_record(file: str, index: str, k: int, width: int) -> tuple[int | None, np.ndarray]:
    """Record `k` of a shard, found by the offset index."""
    system, path = _open(index)
    with system.open_input_file(path) as f:
        size = struct.calcsize(_ENTRY)
        at, _ = struct.unpack(_ENTRY, f.read_at(size, k * size))
    system, path = _open(file)
    with system.open_input_file(path) as f:
        f.seek(at)
        return _payload(_checked(f.read(struct.calcsize(_HEAD)), f.read), width)


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read back from
    the files; `start` counts the ids of all records before it.  The shards'
    starts are a running sum over the manifest (a row per shard)."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = manifest.select("shard", "file", "width", before.alias("start"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for file, width, at in zip(batch["file"], batch["width"], batch["start"]):
                rows = []
                for doc_id, ids in records(file, width):
                    rows.append((None if doc_id is None else str(doc_id), at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                    if len(rows) == READ_ROWS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                yield pd.DataFrame(rows, columns=columns)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, "shard").mapInPandas(read, "doc_id string, start bigint, n_tokens bigint, ids_crc32 bigint") \
        .withColumn("doc_id", F.col("doc_id").cast("bigint"))


def op4(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = scratch_path(spark, "records")
    return read_shards(write_shards(docs, folder, path or vocabulary("byte_bpe_50k.json")))
