"""BPE encoding and decoding with forced-boundary splitting.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be joined by a merge, so it marks a certain cut: the parts on both sides are
merged independently and their ids concatenated.  Splitting goes in two steps.

1. The text is cut at ASCII white space (no token holds any, and it separates
   the pre-tokeniser's pieces).
2. Each distinct chunk is normalised and split into pieces as the tokenizer's
   file says (by the library itself where it holds rare characters); every
   piece is cut at the forced boundaries.  The last fragment of a piece is
   merged with the end-of-word suffix, the others without.

Fragments are merged by the BPE model of the tokenizers library and kept in a
bounded memory per worker, so a repeated fragment is merged once, and no merge
ever sees more than one fragment, however long the text.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, unused

# Results a worker remembers before the older ones are let go.
REMEMBERED = 300_000
# Longer chunks are not remembered.
LONG = 200
_SPACE = re.compile("[ \t\n\r]+")
# Characters whose case, composition and classes need the library: all but
# visible ASCII and the Latin letters and signs below U+0250.
_RARE = re.compile("[^\x21-\x7e\xa1-\xac\xae-\u024f]")
_CODECS: dict[str, "ForcedBoundaryCodec"] = {}


class Memory(dict):
    """Results by text, computed when missing.  Two generations bound it: when
    the younger is full it becomes the older one, and what is asked for again
    returns from there."""

    def __init__(self, compute, size: int = REMEMBERED):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONG:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow at 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class ForcedBoundaryCodec:
    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        parts = json.loads(spec)
        self.whole = Tokenizer.from_str(spec)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.suffix = parts["model"].get("end_of_word_suffix") or ""
        self.added = [t["content"] for t in parts["added_tokens"]]
        # The splitting pattern of the file, for plain chunks.
        self.split = regex.compile(parts["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # The library's BPE model with and without the end-of-word suffix.
        self.last = self.whole.model
        inner = {**parts, "model": {**parts["model"], "end_of_word_suffix": None}}
        self.inner = Tokenizer.from_str(json.dumps(inner)).model
        self.token_of = {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}
        self.inside = set()
        for token in parts["model"]["vocab"]:
            body = token.removesuffix(self.suffix) if self.suffix else token
            self.inside.update(map("".join, zip(body, body[1:])))
        self.letters = _byte_letters()
        self.ends = Memory(lambda f: tuple(t.id for t in self.last.tokenize(f)))
        self.inners = Memory(lambda f: tuple(t.id for t in self.inner.tokenize(f)))
        self.chunks = Memory(self._chunk)

    def fragments_of(self, piece: str) -> list[str]:
        """`piece` (byte letters) cut at every forced boundary."""
        inside = self.inside
        cuts = [k for k in range(1, len(piece)) if piece[k - 1:k + 1] not in inside]
        if not cuts:
            return [piece]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)])]

    def _pieces(self, chunk: str) -> list[str]:
        """The normalised chunk's pieces in byte letters."""
        if _RARE.search(chunk):
            return [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(chunk))]
        return [p.encode().decode("latin-1").translate(self.letters) for p in self.split.findall(chunk.lower())]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        if any(t in chunk for t in self.added):  # the literal of a special token
            return tuple(self.whole.encode(chunk, add_special_tokens=False).ids)
        out: tuple[int, ...] = ()
        for piece in self._pieces(chunk):
            *first, end = self.fragments_of(piece)
            for fragment in first:
                out += self.inners[fragment]
            out += self.ends[end]
        return out

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.chunks.__getitem__, filter(None, _SPACE.split(text or "")))))

    def decode(self, ids) -> str:
        """Tokens joined by one space, as a tokenizer without a decoder does;
        ids outside the vocabulary are left out."""
        token_of = self.token_of
        return " ".join([token_of[i] for i in ids if i in token_of])


def codec(path: str) -> ForcedBoundaryCodec:
    """The codec of a tokenizer file, once per worker process."""
    if path not in _CODECS:
        with open(path, encoding="utf-8") as f:
            _CODECS[path] = ForcedBoundaryCodec(f.read())
    return _CODECS[path]


def shipped(spark: SparkSession, path: str) -> str:
    """Send a tokenizer file (about 2 MB) to the executors; returns its name
    there."""
    name = path.rsplit("/", 1)[-1]
    spark.sparkContext.addFile(path)
    return name


def encoded(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the token ids of each whole text; null and empty text have
    none.  An input column named like `ids` is an error."""
    unused(df, ids)
    small_batches(df.sparkSession)
    name = shipped(df.sparkSession, path)

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        c = codec(SparkFiles.get(name))
        return texts.map(c.encode)

    return df.withColumn(ids, encode(F.coalesce(F.col(text), F.lit(""))))


def decoded(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the decoded text of each id sequence; null ids as none.  An
    input column named like `text` is an error."""
    unused(df, text)
    small_batches(df.sparkSession)
    name = shipped(df.sparkSession, path)

    @F.pandas_udf("string")
    def decode(sequences: pd.Series) -> pd.Series:
        c = codec(SparkFiles.get(name))
        return sequences.map(lambda s: c.decode(list(s)) if s is not None else "")

    return df.withColumn(text, decode(F.col(ids)))


def digests(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encode and
    decode in one pass, so that no id array leaves the worker."""
    small_batches(df.sparkSession)
    name = shipped(df.sparkSession, path)

    @F.pandas_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(texts: pd.Series) -> pd.DataFrame:
        c = codec(SparkFiles.get(name))
        rows = []
        for text in texts:
            ids = c.encode(text)
            rows.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", digest(F.coalesce(F.col("text"), F.lit(""))).alias("d")).select("doc_id", "d.*")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), path or vocabulary("word_bpe_49k.json"))
