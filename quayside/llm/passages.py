"""Repeated passages across documents by content-defined chunking.

A gear hash rolls over the bytes of the normalised text (ASCII-lower-cased
words between single spaces).  Where its tested bits are zero, the chunk ends
with the current word, so cuts depend on the neighbouring bytes only and an
insertion moves no cut but those beside it.  Chunks are compared by digest:
a digest found in two documents is a repeat.

A repeated passage is a window of `LEAST` words that two documents share.  A
passage that is a little longer than that holds a cut early enough for the
window that starts there to lie inside; so the windows that start with a
repeated chunk are compared by digest first.  In every run of repeated chunks
that could be a part of a passage, the other windows are decided exactly where
those matches leave them open (`chunk_claims`): they are compared with the
windows around the same chunk in the other documents.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.session import drop_scratch

from .common import merged, small_batches, stored, table, utf8, written

# words of a passage worth reporting: over 50
LEAST = 51
# a chunk ends where these bits of the 32-bit gear hash are zero: once in 32 bytes
CUT_BITS = np.uint32(0x1F << 11)
# words that the 16 bytes which decide a cut can belong to
REACH = 9
# words of a chunk where no cut is found (runs of one character, for example)
LONGEST = 256
_GEAR = np.random.default_rng(20240301).integers(0, 1 << 32, size=256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte: each byte's random number, shifted by
    its distance; bits 11 to 15 depend on the last 16 bytes at most.  The sum
    over 16 bytes is built from sums over 1, 2, 4 and 8."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint32(width)
        h = h + shifted
    return h


def chunk_arrays(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the chunks of a word sequence: digest, first word, word count, and
    the digest of the `LEAST` words from the first on (0 if the text ends
    before)."""
    if not words:
        none = np.empty(0, np.int64)
        return none, none, none, none
    text = b" ".join(words)
    data = np.frombuffer(text, np.uint8)
    spaces = np.flatnonzero(data == 32)
    cut = np.flatnonzero((gear(data) & CUT_BITS) == 0)
    # words (by number) that end a chunk
    last = np.unique(np.append(np.searchsorted(spaces, cut), len(words) - 1))
    sizes = np.diff(np.append(-1, last))
    if sizes.max() > LONGEST:
        forced = [np.arange(end - size + LONGEST, end, LONGEST) for end, size in zip(last, sizes) if size > LONGEST]
        last = np.unique(np.concatenate([last, *forced]))
        sizes = np.diff(np.append(-1, last))
    firsts = last - sizes + 1
    ends = np.append(spaces, len(text))  # of every word
    starts = np.append(0, ends[:-1] + 1)[firsts].tolist()
    whole = firsts + LEAST <= len(words)
    digest = xxhash.xxh3_64_intdigest
    own = [digest(text[a:b]) for a, b in zip(starts, ends[last].tolist())]
    windows = np.zeros(len(own), np.uint64)
    windows[whole] = [digest(text[a:b]) for a, b in zip(starts, ends[firsts[whole] + LEAST - 1].tolist())]
    return np.array(own, np.uint64).view(np.int64), firsts, sizes, windows.view(np.int64)


def _chunk_rows(batches):
    columns = ["doc_id", "idx", "digest", "first", "n", "window", "before", "after"]
    for batch in batches:
        parts: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in columns]
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            digests, firsts, sizes, windows = chunk_arrays(text.lower().split())
            m = len(digests)
            if m:
                row = (np.full(m, doc_id), np.arange(m), digests, firsts, sizes, windows,
                       np.append(0, sizes[:-1]), np.append(sizes[1:], 0))
                for part, values in zip(parts, row):
                    part.append(values)
        yield pd.DataFrame({c: np.concatenate(part) for c, part in zip(columns, parts)})


def chunk_rows(docs: DataFrame) -> DataFrame:
    """One row per chunk: doc_id, idx, digest, first word, word count, digest of
    the window that starts with it (0 without one), and the word counts of its
    neighbours (0 at an end of the text)."""
    schema = "doc_id bigint, idx int, digest bigint, first int, n int, window bigint, before int, after int"
    return docs.select("doc_id", utf8("text").alias("text")).mapInPandas(_chunk_rows, schema)


def _windows(batches):
    """(window, doc_id, word) of every window of `LEAST` words in the regions."""
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text, los, his in zip(batch["doc_id"], batch["text"], batch["lo"], batch["hi"]):
            words = text.lower().split()
            starts = {k for lo, hi in zip(los, his) for k in range(max(lo, 0), min(hi, len(words)) - LEAST + 1)}
            for k in sorted(starts):
                rows.append((xxhash.xxh3_64_intdigest(b" ".join(words[k:k + LEAST])) - (1 << 63), doc_id, k))
        yield pd.DataFrame(rows, columns=["window", "doc_id", "word"])


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose `key` occurs in two documents or more, with the smallest
    doc_id that has it.  Counts are combined before the shuffle; the join's key
    is unique on the counts' side, so a key of a great many documents can be
    split."""
    known = rows.groupBy(key).agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    return merged(rows, known.where("first_doc < last_doc").select(key, "first_doc"), key)


def _within(chunks_: list[tuple], firsts: list[int], lo: int, hi: int) -> list[tuple]:
    """The chunks (in order of their first words, `firsts`) inside the words [lo, hi)."""
    return [c for c in chunks_[bisect_left(firsts, lo):bisect_left(firsts, hi)] if c[0] + c[1] <= hi]


def _open_starts(lo: int, hi: int, chunks_: list[tuple], words: list[int], docs: list[int]) -> list[int]:
    """The window starts of the run [lo, hi) that the shared windows at cuts
    (their first words in order, and their first documents) leave open.  Those
    between two of them are settled if both cover all words between, have one
    first document, and a chunk inside all windows between has that one too:
    then no smaller document can share such a window."""
    settled, firsts = set(words), [c[0] for c in chunks_]
    for a, b, f, g in zip(words, words[1:], docs, docs[1:]):
        if b - a <= LEAST and f == g and any(c[3] == f for c in _within(chunks_, firsts, b - 1 + REACH, a + 1 + LEAST)):
            settled.update(range(a + 1, b))
    return [k for k in range(max(lo, 0), hi - LEAST + 1) if k not in settled]


def _claims(chunks_: list[tuple], starts: list[int]) -> dict[tuple, list[int]]:
    """(first, digest) of a chunk -> its distances from the open windows that
    are to be looked for around it.  Each window names one chunk of those that
    lie inside it with the bytes that decide their cuts (all documents with the
    window have them): the one with the largest first document, a rare one.
    Without any, all chunks inside it."""
    out: dict[tuple, list[int]] = {}
    firsts = [c[0] for c in chunks_]
    for k in starts:
        inside = _within(chunks_, firsts, k, k + LEAST)
        sound = [c for c in inside if c[0] - REACH >= k]
        for first, _, digest, _ in [max(sound, key=lambda c: (c[3], c[2], c[0]))] if sound else inside:
            out.setdefault((first, digest), []).append(first - k)
    return out


def _claim_rows(batches):
    columns = ["doc_id", "digest", "first", "lo", "hi", "near", "far"]
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, idx, first, n, digest, before, after, owner, words, docs in batch.itertuples(index=False):
            idx, first, n, before, after = (x.tolist() for x in (idx, first, n, before, after))
            digest, owner = digest.tolist(), owner.tolist()
            found = sorted(dict(zip(words.tolist(), docs.tolist())).items()) if words is not None else []
            at = 0
            while at < len(idx):
                end = at + 1
                while end < len(idx) and idx[end] - idx[end - 1] <= 1:
                    end += 1
                lo = min(first[i] - before[i] for i in range(at, end)) - REACH
                hi = max(first[i] + n[i] + after[i] for i in range(at, end))
                if hi - lo >= LEAST:
                    chunks_ = sorted(set(zip(first[at:end], n[at:end], digest[at:end], owner[at:end])))
                    known = [w for w in found if lo <= w[0] < hi]
                    claims = _claims(chunks_, _open_starts(lo, hi, chunks_, [w for w, _ in known], [d for _, d in known]))
                    for c in chunks_:
                        spans = claims.get((c[0], c[2]))
                        rows.append((doc_id, c[2], c[0], lo, hi, min(spans) if spans else None, max(spans) if spans else None))
                at = end
        out = pd.DataFrame(rows, columns=columns)
        yield out.astype({"near": "Int32", "far": "Int32"})


def chunk_claims(chunks_: DataFrame, sure: DataFrame) -> DataFrame:
    """The repeated chunks in maximal runs of neighbouring repeated chunks that
    can be a part of a passage: doc_id, digest, first, the word range [lo, hi)
    of the run with the neighbouring chunks, which holds any passage that the
    run is a part of (the cut that starts the chunk before the run can depend
    on words `REACH` before it), and the smallest and largest distance (near,
    far) from the open windows that are looked for around the chunk (null if
    none)."""
    row = F.sort_array(F.collect_list(F.struct("idx", "first", "n", "digest", "before", "after", "first_doc"))).alias("c")
    by_doc = chunks_.groupBy("doc_id").agg(row)
    known = sure.groupBy("doc_id").agg(F.collect_list(F.struct("word", "first_doc")).alias("w"))
    both = merged(by_doc, known, "doc_id", "left").select(
        "doc_id", *[F.col(f"c.{x}").alias(x) for x in ("idx", "first", "n", "digest", "before", "after", "first_doc")],
        F.col("w.word").alias("words"), F.col("w.first_doc").alias("docs"))
    return both.mapInPandas(_claim_rows, "doc_id bigint, digest bigint, first int, lo int, hi int, near int, far int")


def joined_windows(windows: DataFrame) -> DataFrame:
    """Rows (doc_id, word, first_doc) of shared windows -> passages: the words
    covered by windows that overlap or touch."""
    order = Window.partitionBy("doc_id").orderBy("word")
    one = windows.groupBy("doc_id", "word").agg(F.min("first_doc").alias("first_doc"))
    gap = F.when(F.col("word") > F.lag("word").over(order) + LEAST, 1).otherwise(0)
    numbered = one.withColumn("gap", gap).withColumn("run", F.sum("gap").over(order))
    return numbered.groupBy("doc_id", "run").agg(
        F.min("word").alias("lo"), (F.max("word") + LEAST).alias("hi"), F.min("first_doc").alias("first_doc")).drop("run")


def shared_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, word, first_doc): windows of `LEAST` words that a document
    shares with another, by their first word, with the smallest doc_id that
    has the window.  Windows between two rows that cover all their words are
    left out if they add no smaller doc_id."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    cut, cut_path = written(chunk_rows(docs), "cut")
    found, found_path = written(repeated(cut, "digest"), "chunks")
    drop_scratch(spark, cut_path)
    sure = stored(repeated(found.where("window != 0").select("doc_id", F.col("first").alias("word"), "window"), "window")
                  .select("doc_id", "word", "first_doc"), "sure")
    claims, claims_path = written(chunk_claims(found, sure), "claims")
    drop_scratch(spark, found_path)
    wanted = claims.where("near is not null").groupBy("digest").agg(F.min("near").alias("least"), F.max("far").alias("most"))
    regions = merged(claims.drop("near", "far"), wanted, "digest").select(
        "doc_id", F.greatest("lo", F.col("first") - F.col("most")).alias("lo"),
        F.least("hi", F.col("first") - F.col("least") + LEAST).alias("hi")).where(F.col("hi") - F.col("lo") >= LEAST)
    regions = regions.groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("regions"))
    texts = merged(docs, regions, "doc_id").groupBy("doc_id").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text"), F.first("regions").alias("regions"))
    texts = texts.select("doc_id", F.col("text").cast("binary").alias("text"), F.col("regions.lo").alias("lo"), F.col("regions.hi").alias("hi"))
    windows = stored(texts.mapInPandas(_windows, "window bigint, doc_id bigint, word int"), "windows")
    drop_scratch(spark, claims_path)
    return sure.union(repeated(windows, "window").select("doc_id", "word", "first_doc"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, n_words, first_doc_id): the passages of `LEAST`
    words or more that a document shares with others, one row each (the words
    covered by shared windows that overlap or touch); first_doc_id is the
    smallest doc_id that shares a part of it.

    Words are runs without ASCII white space, A-Z lower-cased.  Documents that
    repeat no passage (null and empty texts too) have no row.  Rows with one
    doc_id are one document and repeat nothing by themselves (given different
    texts, their chunks are searched together).  A null doc_id is not searched.
    """
    return joined_windows(shared_windows(docs)).select(
        "doc_id", F.col("lo").cast("bigint").alias("start_word"), (F.col("hi") - F.col("lo")).cast("bigint").alias("n_words"),
        F.col("first_doc").alias("first_doc_id"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` (doc_id, text) without the words of every window that a smaller
    doc_id has too, so each repeated word stays where its windows occur first;
    words of changed texts are joined by one space."""
    cut = joined_windows(shared_windows(docs).where("first_doc < doc_id")).groupBy("doc_id").agg(
        F.collect_list(F.struct(F.col("lo").alias("start_word"), (F.col("hi") - F.col("lo")).alias("n_words"))).alias("cut"))

    @F.pandas_udf("string")
    def remove(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, cuts):
            words = text.split()
            for s in sorted(spans, key=lambda s: -s["start_word"]):
                del words[s["start_word"]:s["start_word"] + s["n_words"]]
            out.append(b" ".join(words).decode("utf-8"))
        return pd.Series(out)

    small_batches(docs.sparkSession)
    joined = docs.select("doc_id", "text").join(cut, "doc_id", "left")
    changed = joined.where("cut is not null").select("doc_id", remove(utf8("text"), "cut").alias("text"))
    return joined.where("cut is null").select("doc_id", "text").union(changed)

def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
