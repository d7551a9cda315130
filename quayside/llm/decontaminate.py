"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words.  All windows of one length m form a search table: the
shift table tells, for a block of two consecutive words, how far the search
may jump (m - 1 words for a block that no pattern holds, so clean text is
inspected about once per m - 1 words); where the shift is zero, the block is
the end of some pattern: the bucket of that suffix and of the pattern's first
block selects test windows, and a direct comparison of the words confirms.

The benchmark is read in blocks of a bounded size (`BLOCK_BYTES` of text); the
documents are scanned once per block.  Only one bounded block is ever held by
the driver and broadcast.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, small_batches, table, unused, utf8

WINDOW = 13
# contaminated: at least this share (1 / SHARE) of the words are hit
SHARE = 20
BLOCK_BYTES = 1 << 20

_HITS = "struct<n_words:bigint,spans:array<struct<lo:bigint,hi:bigint>>,items:array<string>>"
# every ASCII byte that is no letter or digit separates words
_SEPARATORS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters."""
    return (text or b"").lower().translate(_SEPARATORS).split()


class WindowSearch:
    """Wu-Manber tables for the windows of one length."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}

    def _key(self, words: list[bytes], end: int):
        return (words[end - 1], words[end]) if self.block == 2 else words[end]

    def add(self, words: list[bytes], start: int, item: str) -> None:
        m, b = self.length, self.block
        for end in range(start + b - 1, start + m):
            key, shift = self._key(words, end), start + m - 1 - end
            if shift < self.shift.get(key, self.longest):
                self.shift[key] = shift
        by_prefix = self.buckets.setdefault(self._key(words, start + m - 1), {})
        by_prefix.setdefault(self._key(words, start + b - 1), []).append((words[start:start + m], item))

    def occurrences(self, words: list[bytes]):
        """(start, item) of every window found in `words`."""
        m, b, n, longest = self.length, self.block, len(words), self.longest
        shift_of, buckets, end = self.shift.get, self.buckets, self.length - 1
        while end < n:
            key = (words[end - 1], words[end]) if b == 2 else words[end]
            jump = shift_of(key, longest)
            if jump:
                end += jump
                continue
            start = end - m + 1
            for window, item in buckets[key].get(self._key(words, start + b - 1), ()):
                if words[start:end + 1] == window:
                    yield start, item
            end += 1


def build_tables(items: list[tuple[str, bytes | None]], window: int = WINDOW) -> list[WindowSearch]:
    """One table per window length: `window`, and the lengths of shorter items."""
    tables: dict[int, WindowSearch] = {}
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        if m:
            search = tables.setdefault(m, WindowSearch(m))
            for start in range(len(words) - m + 1):
                search.add(words, start, item)
    return list(tables.values())


def find(tables: list[WindowSearch], words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged spans [lo, hi) of hit words, and the items that occur."""
    found, items = [], set()
    for search in tables:
        for start, item in search.occurrences(words):
            items.add(item)
            found.append((start, start + search.length))
    spans: list[list[int]] = []
    for lo, hi in sorted(set(found)):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(hi, spans[-1][1])
        else:
            spans.append([lo, hi])
    return [(lo, hi) for lo, hi in spans], items


def _scan_block(tables) -> callable:
    @F.pandas_udf(_HITS)
    def scan(text: pd.Series, lo: pd.Series, hi: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for doc, los, his, before in zip(text, lo, hi, items):
            words = words_of(doc)
            spans, found = find(tables.value, words)
            if len(before):
                found = found | set(before)
            mask = bytearray(len(words)) if len(los) else None
            if mask is not None:
                for a, b in [*zip(los, his), *spans]:
                    mask[a:b] = b"\x01" * (b - a)
                edges = [i for i in range(len(mask) + 1)
                         if (mask[i] if i < len(mask) else 0) != (mask[i - 1] if i else 0)]
                spans = list(zip(edges[::2], edges[1::2]))
            rows.append((len(words), [{"lo": a, "hi": b} for a, b in spans], sorted(found)))
        return pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    return scan


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Lists of (item id, text bytes), each of about `block_bytes` at most
    (an item is never split).  Rows without id or text are left out."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("text")).where(
        F.col("item").isNotNull() & (F.length("text") > 0))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total * 2 // block_bytes) if total > block_bytes else 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r.item, bytes(r.text)) for r in rows.toLocalIterator()]


def benchmark_hits(df: DataFrame, benchmark: DataFrame, text: str = "text", hits: str = "hits",
                   window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`df` with a struct column `hits`: n_words, spans of hit words (word
    indexes, merged, end exclusive) and the ids of the items with occurring
    windows.  An item of fewer than `window` words is one window; an item or
    document without words matches nothing.  Null text has no words.  Rows are
    judged one by one, so repeated rows and ties need no rule.  An input column
    named like `hits` is an error."""
    unused(df, hits)
    spark = df.sparkSession
    small_batches(spark)
    none = F.struct(F.lit(0).cast("bigint").alias("n_words"),
                    F.array().cast("array<struct<lo:bigint,hi:bigint>>").alias("spans"),
                    F.array().cast("array<string>").alias("items"))
    out, last = df, None
    for block in benchmark_blocks(benchmark, block_bytes):
        tables = spark.sparkContext.broadcast(build_tables(block, window))
        before = F.col(last) if last else none
        name = fresh(out, "block_hits")
        out = out.withColumn(name, _scan_block(tables)(
            utf8(F.col(text)), before["spans"]["lo"], before["spans"]["hi"], before["items"]))
        if last:
            out = out.drop(last)
        last = name
    return out.withColumnRenamed(last, hits)


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits["spans"], F.lit(0).cast("bigint"), lambda n, s: n + s["hi"] - s["lo"])


def is_contaminated(hits: Column) -> Column:
    return (n_hit(hits) > 0) & (n_hit(hits) * SHARE >= hits["n_words"])


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that are not contaminated, columns unchanged."""
    name = fresh(docs, "hits")
    found = benchmark_hits(docs, benchmark, hits=name)
    return found.where(~is_contaminated(F.col(name))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = F.col("hits")
    return benchmark_hits(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        n_hit(hits).alias("n_hit"),
        F.size(hits["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(hits["items"]), ","), 256).alias("items_sha256"),
        is_contaminated(hits).alias("contaminated"))


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, m, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT rid, m, s, array_to_string(w[s:s + m - 1], ' ') AS win
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS s
        FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
occ AS (SELECT rid, dw.m, s, item FROM dw JOIN bw ON dw.win = bw.win AND dw.m = bw.m),
hit AS (SELECT rid, count(DISTINCT p) AS n
        FROM (SELECT rid, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT rid, m, s FROM occ)) GROUP BY rid),
it AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""
