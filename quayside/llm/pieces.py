"""SentencePiece encoding and decoding by a distinct-chunk table.

Where no piece holds a white-space marker behind another character, no merge
crosses the cut before a run of markers.  A text is therefore a sequence of
marked words (a run of markers and what follows up to the next run), and equal
marked words have equal ids wherever they stand.

1. Spark counts the marked words of the whole corpus (counted per task, then
   grouped by word).
2. The `COMMON` most frequent ones of at most `SHORT` code points become a
   table (chunk, ids, decoded): each is segmented once for the whole corpus, by
   the sentencepiece library.  Both bounds limit the table, so it is broadcast
   whatever the corpus.
3. A document is cut into its marked words, and their rows are joined back by
   position.  Marked words outside the broadcast table are the exact rest: each
   distinct one of a block of texts (at most `BLOCK` code points, or one text)
   is segmented once for the block.  A word that stands in one block alone is
   thus segmented once as well.

Joining the rest through a shuffle as well would move every document or its
positions (README).  Null and empty texts have no marked words.  Very long
texts and very long words are encoded whole.  Repeated rows give repeated rows,
an empty table an empty one.  Output columns that the input already has are an
error.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import shipped, vocabulary
from .common import small_batches, stored, table

MARK = "▁"
# Rows of the broadcast table, and the longest word it takes.
COMMON = 1 << 18
SHORT = 48
# Code points of text whose rare words are segmented together.
BLOCK = 1 << 22
# Distinct words a counting task holds before it hands their counts on.
COUNTED = 300_000
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_MODELS: dict[str, "Segmenter"] = {}


class Segmenter:
    """Segments single marked words as the library does inside a text."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (spec.escape_whitespaces and spec.add_dummy_prefix):
            raise ValueError("only models whose normaliser does no more than mark white space can be cut at markers")
        if any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in model.pieces) or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a piece of this model crosses a white-space marker")
        spec.add_dummy_prefix = False  # a marked word brings its marker along
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())

    def segment(self, words: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each word."""
        ids = self.inner.encode(words, num_threads=1)
        return [(np.asarray(i, "<u4").tobytes(), d) for i, d in zip(ids, self.inner.decode(ids, num_threads=1))]


def segmenter(path: str) -> Segmenter:
    """The segmenter of a model file, once per worker process."""
    if path not in _MODELS:
        _MODELS[path] = Segmenter(path)
    return _MODELS[path]


def marked_words(text: str | None) -> list[str]:
    """The marked words of a text, which joined are the marked text."""
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(chunk, n): the distinct marked words of all texts with their counts."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["chunk", "n"])
            seen.clear()
            return rows

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(marked_words(t))
                if len(seen) > COUNTED:
                    yield out()
        yield out()

    small_batches(df.sparkSession)
    return df.select(text).mapInArrow(count, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n"))


def chunk_table(df: DataFrame, path: str, text: str = "text", common: int = COMMON) -> DataFrame:
    """(chunk, ids, decoded) of the most frequent marked words of at most
    `SHORT` code points, each segmented once.  The table takes classes of like
    counts (16 to a doubling), from the greatest on, while it holds at most
    `common` rows; words that occur once stay out.  `ids` are little-endian
    unsigned 32-bit integers."""
    name = shipped(df.sparkSession, path)

    def segment(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = segmenter(SparkFiles.get(name))
        for batch in batches:
            rows = s.segment(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i for i, _ in rows], pa.binary()),
                                              pa.array([d for _, d in rows], pa.string())], ["chunk", "ids", "decoded"])

    counts = word_counts(df, text).where((F.length("chunk") <= SHORT) & (F.col("n") > 1))
    counts = stored(counts.withColumn("class", F.floor(F.log2("n") * 16).cast("int")), "chunk-counts")
    held, least = 0, None
    for row in counts.groupBy("class").count().orderBy(F.desc("class")).collect():  # at most 16 x 64 classes
        held += row["count"]
        if held > common:
            break
        least = row["class"]
    top = counts.where(F.col("class") >= least if least is not None else F.lit(False)).select("chunk")
    return stored(top.mapInArrow(segment, "chunk string, ids binary, decoded string"), "chunks")


class Join:
    """Rows of the chunk table joined to texts by position."""

    def __init__(self, s: Segmenter, common: dict[str, tuple[bytes, str]]):
        self.s, self.common = s, common

    def block(self, texts: list[str | None]) -> Iterator[list[tuple[bytes, str]]]:
        """Per text, its marked words' rows in order."""
        cut = [marked_words(t) for t in texts]
        words = set().union(*cut)
        rest = [w for w in words if w not in self.common]
        rows = {w: self.common[w] for w in words if w in self.common}
        rows.update(zip(rest, self.s.segment(rest)))
        for chunks in cut:
            yield list(map(rows.__getitem__, chunks))

    def texts(self, texts: Iterable[str | None]) -> Iterator[list[tuple[bytes, str]]]:
        """As `block`, for any number of texts, block by block."""
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t or "")
            if size >= BLOCK:
                yield from self.block(held)
                held, size = [], 0
        yield from self.block(held)


def _joined(df: DataFrame, path: str, text: str, common: int):
    """A maker of `Join`s for the workers, over the broadcast chunk table."""
    spark = df.sparkSession
    small_batches(spark)
    name = shipped(spark, path)
    rows = {r.chunk: (bytes(r.ids), r.decoded) for r in chunk_table(df, path, text, common).collect()}
    shared = spark.sparkContext.broadcast(rows)
    return lambda: Join(segmenter(SparkFiles.get(name)), shared.value)


def _new(df: DataFrame, *names: str) -> None:
    have = {c.lower() for c in df.columns}
    if taken := [n for n in names if n.lower() in have]:
        raise ValueError(f"the input already has columns named {taken}")


def encoded(df: DataFrame, path: str, text: str = "text", ids: str = "ids", common: int = COMMON) -> DataFrame:
    """`df` with the piece ids of each whole text, without begin and end ids;
    null and empty text have none.  `ids` must be a new column."""
    _new(df, ids)
    join = _joined(df, path, text, common)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        j = join()
        for texts in batches:
            yield pd.Series([np.frombuffer(b"".join(i for i, _ in rows), "<u4").astype("int32") for rows in j.texts(texts)])

    return df.withColumn(ids, encode(F.coalesce(F.col(text), F.lit(""))))


def decoded(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`df` with the text of each id sequence, whatever wrote it, as the
    library decodes it; null ids as none.  `text` must be a new column."""
    _new(df, text)
    small_batches(df.sparkSession)
    name = shipped(df.sparkSession, path)

    @F.pandas_udf("string")
    def decode(sequences: pd.Series) -> pd.Series:
        s = segmenter(SparkFiles.get(name)).whole
        return sequences.map(lambda x: s.decode([int(i) for i in x]) if x is not None else "")

    return df.withColumn(text, decode(F.col(ids)))


def digests(df: DataFrame, path: str, common: int = COMMON) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, begin and
    end ids included.  A text's decoded form is that of its marked words, less
    the marker that encoding puts before it."""
    join = _joined(df, path, "text", common)

    @F.pandas_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        j = join()
        begin, end = (np.asarray([i], "<u4").tobytes() for i in (j.s.whole.bos_id(), j.s.whole.eos_id()))
        for texts in batches:
            out = []
            for rows in j.texts(texts):
                ids = b"".join([begin, *(i for i, _ in rows), end])
                back = "".join([d for _, d in rows])[1:]
                out.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", digest(F.coalesce(F.col("text"), F.lit(""))).alias("d")).select("doc_id", "d.*")


def op11(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document encoded with begin and end ids, and decoded.  One row a
    document; null and empty texts are the begin and the end id."""
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), path or vocabulary("piece_bpe_32k.model"))
