"""Spelling variants: words one edit apart, found by a trie frontier.

The words form a compressed trie, kept as a table of edges: a node (its text),
a label, and the count of the word at the edge's end (at most one edge of a node
per letter of the alphabet).  A table of states (word, position, node, edits)
starts with every word at the root and is joined with the edges level by level.  A state follows the edge whose label
matches the word from its position on.  Without an edit so far it also takes

* every edge whose first letter is smaller than the word's next one, if the
  label's rest matches behind that letter (a replacement), and
* the edge that matches behind the word's next letter, where the letter after it
  differs (a deletion).

Both are placed at the first letter in which two words differ, so a pair is
found once: a replacement from the word with the greater letter, a deletion
from the longer word, and insertions are deletions of the other side.  States
that end at a word with one edit are pairs of near words.

The trie comes from sorted neighbours: the common prefixes of neighbouring words
are its branching nodes, and a node's parent is the common prefix of the node
and the one before it.  Sorting is by range partitions, whose border rows are
handed on, so no task sees all words.  All work and all keys are bounded by the
length of the words, not its square, and the number of levels by the branching
nodes on a path.

Null and empty texts have no words, whatever their length texts are read whole,
and a null id counts as the empty text.  Repeated rows count again.  An empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import merged, small_batches, stored, table

MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2
# One run in this many, by checksum, loses a code point.
CHANGED = 97
# Distinct words a counting task holds before it hands their counts on.
COUNTED = 200_000
# Nodes of at most this many letters are met by many words: their rows are
# repeated in `SALTS` places, and the states spread over them.
SHALLOW, SALTS = 2, 32
_RUN = re.compile("[a-zÀ-ÿ]+")


def changed(doc_id, run: str) -> str:
    """The run, less one code point where the checksum of id and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % CHANGED:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of all texts of (doc_id, text)."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])
            seen.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # lower() of bytes lowers A-Z alone
                for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
                    word = changed(doc_id, run)
                    if len(word) >= min_length:
                        seen[word] += n
                if len(seen) > COUNTED:
                    yield out()
        yield out()

    small_batches(docs.sparkSession)
    parts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).mapInArrow(count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def with_previous(df: DataFrame, col: str, out: str) -> DataFrame:
    """`df` with the value before `col` in the order of the whole table (null
    for the first).  Values of `col` are distinct.  Only the last value of each
    range partition passes a single task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = stored(df.repartitionByRange(n, col).withColumn("_slice", F.spark_partition_id()), "sorted")
    ends = part.groupBy("_slice").agg(F.max(col).alias("_last"))
    ends = ends.select("_slice", F.lag("_last").over(Window.orderBy("_slice")).alias("_last"))
    inside = F.lag(col).over(Window.partitionBy("_slice").orderBy(col))
    return part.join(F.broadcast(ends), "_slice").withColumn(out, F.coalesce(inside, "_last")).drop("_slice", "_last")


def _prefixes(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([commonprefix([x if isinstance(x, str) else "", y]) for x, y in zip(a, b)], dtype=object)


def _common(a: str, b: str) -> Column:
    """The common prefix of two columns; a null has none."""
    return F.pandas_udf(_prefixes, "string")(a, b)


def trie(words: DataFrame) -> DataFrame:
    """The edges (node, label, n, heads) of the words' compressed trie.  `n` is
    the count of the word that the edge leads to, null where it leads to none;
    `heads` are the first letters of the edges that go on from there."""
    forks = with_previous(words.select("word"), "word", "before").select(_common("before", "word").alias("node"))
    nodes = forks.distinct().withColumn("n", F.lit(None).cast("bigint")).unionByName(words.select(F.col("word").alias("node"), "n"))
    nodes = nodes.groupBy("node").agg(F.max("n").alias("n"))
    nodes = with_previous(nodes, "node", "before").where(F.col("node") != "").withColumn("parent", _common("before", "node"))
    nodes = stored(nodes.withColumn("label", F.substring("node", F.length("parent") + 1, F.length("node"))).drop("before"), "nodes")
    heads = nodes.groupBy(F.col("parent").alias("node")).agg(F.array_join(F.collect_list(F.left("label", F.lit(1))), "").alias("heads"))
    return merged(nodes, heads, "node", "left").select(F.col("parent").alias("node"), "label", "n", F.coalesce("heads", F.lit("")).alias("heads"))


def _letters(start: Column, length: Column | int = 1) -> Column:
    """Letters of a state's word from the 0-based `start` on."""
    return F.substring("word", start + 1, F.lit(length) if isinstance(length, int) else length)


def _step(label: Column, n: Column, heads: Column, passed: Column, edits: Column | int) -> Column:
    return F.struct((F.col("at") + passed).alias("at"), F.concat("node", label).alias("node"),
                    (F.lit(edits) if isinstance(edits, int) else edits).alias("edits"), n.alias("node_n"), heads.alias("heads"))


def _moves() -> Column:
    """The next states of a state without an edit at its node (`edges`)."""
    at, edges = F.col("at"), F.col("edges")
    own = F.filter(edges, lambda e: e["label"] == _letters(at, F.length(e["label"])))
    smaller = F.filter(edges, lambda e: (F.left(e["label"], F.lit(1)) < _letters(at))
                       & (F.substring(e["label"], F.lit(2), F.length(e["label"])) == _letters(at + 1, F.length(e["label"]) - 1)))
    behind = F.filter(edges, lambda e: (_letters(at) != _letters(at + 1)) & (e["label"] == _letters(at + 1, F.length(e["label"]))))

    def steps(some: Column, more: int, edits: int) -> Column:
        return F.transform(some, lambda e: _step(e["label"], e["n"], e["heads"], F.length(e["label"]) + more, edits))

    return F.concat(steps(own, 0, 0), steps(smaller, 0, 1), steps(behind, 1, 1))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every ordered pair of words of (word, n) that
    differ by exactly one inserted, deleted or replaced code point.

    States with an edit can only follow the one edge of their next letter, so
    they meet the table by (node, letter); a state is not kept if its node has
    no edge of its next letter."""
    deep = F.length("node") > SHALLOW
    places = F.when(deep, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    here = F.when(deep, F.lit(0)).otherwise(F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
    edges = stored(trie(words), "edges")
    nodes = edges.groupBy("node").agg(F.collect_list(F.struct("label", "n", "heads")).alias("edges"))
    nodes = stored(nodes.withColumn("place", F.explode(places)), "nodes")
    edges = stored(edges.withColumns({"letter": F.left("label", F.lit(1)), "place": F.explode(places)}), "edges")
    at, ended = F.col("at"), F.col("at") == F.length("word")
    alive = F.when(ended, (F.col("edits") == 1) & F.col("node_n").isNotNull()).otherwise(
        (F.col("edits") == 0) | F.contains("heads", _letters(at)))
    fresh = words.select("word", "n", F.lit(0).alias("at"), F.lit("").alias("node"), F.lit(None).cast("bigint").alias("node_n"))
    edited = fresh.where(F.lit(False))
    pairs = None
    while True:
        # A word whose last letter is deleted is the word that its node is.
        shorter = fresh.where((at + 1 == F.length("word")) & F.col("node_n").isNotNull())
        met = merged(fresh.drop("node_n").withColumn("place", here), nodes, ["node", "place"])
        moved = met.select("word", "n", F.explode(_moves()).alias("s"))
        edited = edited.select("word", F.col("n").alias("word_n"), "at", "node", _letters(at).alias("letter"), here.alias("place"))
        met = merged(edited, edges, ["node", "letter", "place"]).where(F.col("label") == _letters(at, F.length("label")))
        moved = moved.unionByName(met.select("word", F.col("word_n").alias("n"), _step(
            F.col("label"), F.col("n"), F.col("heads"), F.length("label"), 1).alias("s")))
        moved = stored(moved.select("word", "n", "s.*").where(alive).drop("heads"), "frontier")
        found = moved.where(ended).unionByName(shorter, allowMissingColumns=True)
        found = found.select("word", "n", F.col("node").alias("other"), F.col("node_n").alias("other_n"))
        pairs = found if pairs is None else pairs.unionByName(found)
        if moved.where(~ended).isEmpty():
            break
        fresh, edited = (moved.where(~ended & (F.col("edits") == k)).drop("edits") for k in (0, 1))
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest count (ties:
    the smallest) where that count is at least `ratio` times the word's own."""
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("form"))).alias("b"))
    df = merged(words, best, "word", "left")
    enough = -F.col("b.minus_n") >= F.col("n") * ratio
    return df.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(enough, F.col("b.form")).alias("form"),
                     F.when(enough, -F.col("b.minus_n")).alias("form_n"))


def with_roots(df: DataFrame) -> DataFrame:
    """`df` (word, form, ...) with `root`: the last word on the way from form
    to form, found by doubling the steps; counts grow along the way, so it
    ends."""
    steps = stored(df.where(F.col("form").isNotNull()).select("word", F.col("form").alias("to")), "roots")
    while True:
        far = steps.select(F.col("word").alias("to"), F.col("to").alias("beyond"))
        further = merged(steps, far, "to", "left")
        further = stored(further.select("word", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")), "roots")
        steps = further.select("word", "to")
        if further.where("moved").isEmpty():
            break
    j = merged(df, steps, "word", "left")
    return j.select("*", F.coalesce("to", "word").alias("root")).drop("to")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `documents` with
    at least five code points and three occurrences.  Without words, no rows."""
    words = stored(word_counts(table(spark, sf_dir, "documents")), "words")
    return with_roots(stored(forms(words), "forms")).select("word", "form", "root", "n", "n_near", "form_n")
