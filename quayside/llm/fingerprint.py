"""Document fingerprints by SpotSigs, as DataFrame expressions.

A signature is a common word (anchor) and the chain of the next `CHAIN`
content words; common words in between are skipped, and at the end of a text
the chain may be shorter.  A text without an anchor is one signature: its
whole word sequence.  The fingerprint lists the distinct signature hashes in
order, so equal texts have equal fingerprints.

Two fingerprints are compared by the Jaccard similarity of their sets.  Sets
are partitioned by length: partition k holds lengths from PRUNE^-k on, so sets
two partitions apart cannot reach similarity `PRUNE`, and the ratio of the
lengths bounds the similarity of any two sets before they are intersected.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh, stored, table

CHAIN = 2
PRUNE = 0.8
# ids per block of the next-document search
BLOCK = 1024

# Common words by language.
ANCHORS = {
    "en": "a an and are as at be by for from in is it not of on or that the this to was with",
    "de": "als auf aus bei das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu",
    "fr": "au aux avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une",
    "es": "al como con de del el en es la las lo los no para pero por que se sin su un una y",
    "it": "che con da dei del della di e gli i il in la le non per sono un una",
    "pt": "ao com da das de do dos e em mas na não no o os para por que se um uma",
    "nl": "dat de een en het is met niet op te van voor zijn",
}


def anchor_words() -> list[str]:
    return sorted({w for words in ANCHORS.values() for w in words.split()})


# Marks the common words in a sequence.
MARK = "\x01"


def sequence(text: Column) -> Column:
    """Lower-cased runs of letters and digits (null as none), common words
    marked, joined by single spaces."""
    runs = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_join(F.transform(runs, lambda w: F.when(w.isin(anchor_words()), F.concat(F.lit(MARK), w)).otherwise(w)), " ")


def chains(marked: Column, chain: int = CHAIN) -> Column:
    """The signatures of a `sequence`, one per line."""
    link = f"(?: {MARK}[^ ]++)*+ [^{MARK} ][^ ]*+"
    pattern = f"(?={MARK}([^ ]++{link}(?:{link}){{0,{chain - 1}}}+))"
    found = F.array_join(F.regexp_extract_all(marked, F.lit(pattern), F.lit(1)), "\n")
    return F.regexp_replace(found, f" {MARK}[^ ]++", "")


def signature_set(marked: Column, lines: Column) -> Column:
    """Sorted distinct 32-bit hashes of the signatures (`chains`) of a sequence."""
    found = (F.when(marked == "", F.array().cast("array<string>"))
             .when(lines == "", F.array(marked)).otherwise(F.split(lines, "\n")))
    return F.array_sort(F.array_distinct(F.transform(found, lambda s: F.hash(s))))


def listed(signatures: Column) -> Column:
    """The set as a string: eight hexadecimal digits per signature."""
    return F.array_join(F.transform(signatures, lambda h: F.lpad(F.hex(h.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def length_partition(n: Column, prune: float = PRUNE) -> Column:
    return F.when(n > 0, F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / prune)) + 1e-9).cast("int")).otherwise(F.lit(-1))


def pruned_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without intersecting them where the
    ratio of their lengths is below `least` or one set is empty.  Two empty
    sets are alike (1)."""
    n, m = F.size(a), F.size(b)
    both = F.size(F.array_intersect(a, b))
    return (F.when((n == 0) & (m == 0), 1.0).when((n == 0) | (m == 0), 0.0)
            .when(F.least(n, m) < F.greatest(n, m) * least, 0.0)
            .otherwise(both / (n + m - both)))


def block_order(firsts: DataFrame) -> DataFrame:
    """(doc_id, home): the first document of each block (block, doc_id) and the
    block before its own (before the first: the last).  Blocks are sorted by
    range partitions, stored so that a partition keeps its number; one row for
    each of these, not for each block, passes a single task."""
    part = stored(firsts.repartitionByRange("block").withColumn("slice", F.spark_partition_id()), "blocks")
    ring = Window.orderBy("slice")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = part.groupBy("slice").agg(F.max("block").alias("top"))
    ends = ends.select("slice", F.coalesce(F.lag("top").over(ring), F.last("top").over(whole)).alias("before_all"))
    inner = Window.partitionBy("slice").orderBy("block")
    return part.join(ends, "slice").select("doc_id", F.coalesce(F.lag("block").over(inner), "before_all").alias("home"))


def with_next(docs: DataFrame, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(doc_id, text, the columns that `derive` adds, and the same columns but
    the id of the next document as next_*), by ascending doc_id (after the
    last: the first); rows with one doc_id follow each other by text; a row
    with a null doc_id is its own successor.  Only ids and texts are shuffled;
    `derive` is applied where a document and its successor have met.

    Documents are dealt to blocks of `BLOCK` consecutive ids; the first row of
    each block is also a guest of the block before, so every block finds its
    successors by itself.  The blocks are ordered by `block_order`."""
    block = F.floor(F.col("doc_id") / BLOCK).cast("bigint")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = docs.where("doc_id is not null")
    firsts = block_order(named.groupBy(block.alias("block")).agg(F.min("doc_id").alias("doc_id")))
    guests = named.join(firsts, "doc_id").groupBy("doc_id", "home").agg(F.min("text").alias("text"))
    both = named.select(block.alias("block"), "doc_id", "text", F.lit(0).alias("guest")).union(
        guests.select(F.col("home").alias("block"), "doc_id", "text", F.lit(1).alias("guest")))
    both = derive(both.repartition("block"))
    carried = [c for c in both.columns if c not in ("block", "doc_id", "guest")]
    order = Window.partitionBy("block").orderBy("guest", "doc_id", "text")
    out = both.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).where("guest = 0").drop("block", "guest")
    alone = derive(docs.where("doc_id is null"))
    return out.unionByName(alone.withColumns({f"next_{c}": F.col(c) for c in carried}))


def fingerprints(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with the signature set of a text column.  Step by step, so that
    no expression is evaluated twice."""
    marked, lines = fresh(df, "marked"), fresh(df, "lines")
    df = df.withColumn(marked, sequence(F.col(text)))
    df = df.withColumn(lines, chains(F.col(marked)))
    return df.withColumn(name, signature_set(F.col(marked), F.col(lines))).drop(marked, lines)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    df = with_next(table(spark, sf_dir, "documents"), lambda d: fingerprints(d, "text", "own"))
    df = df.withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))
    df = fingerprints(df, "edited", "changed")
    return df.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        listed(F.col("own")).alias("fingerprint"), listed(F.col("changed")).alias("edited_fingerprint"),
        pruned_jaccard(F.col("own"), F.col("changed")).alias("near_edited"),
        pruned_jaccard(F.col("own"), F.col("next_own")).alias("near_next"),
        length_partition(F.size("own")).alias("length_partition"))
