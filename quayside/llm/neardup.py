"""MinHash near duplicates with tensored banding.

Two small collections of `BANDS` bands, `ROWS` minhashes each, are computed
(2 * 7 * 2 = 28 minhashes).  Every pair (band i of the first, band j of the
second collection) is a table key, so 28 minhashes serve 49 tables of four
rows each, which would take 196 minhashes if every table had its own.  Two
documents meet in a table if band i and band j both agree; at similarity
0.85 that fails in all 49 tables with probability 0.0003.

Equal shingle sets are collapsed first, so copies never meet each other in a
table.  The steps are the same whatever the data, each followed by the
components of the links so far:

1. every member of a table key is compared with a few centres of the key;
2. in keys whose members still lie in different components, once more with
   centres drawn from both sides;
3. what the draws missed: in keys with few members all pairs across components,
   and the documents of the other keys that still lie in several components
   through a prefix filter on their full sets.  Of two sets that reach the
   threshold, the rarest common shingle is among the rarest few of both.
   Shingles with few holders list their pairs; those with many are compared
   block by block.

Each candidate is verified on the full shingle sets.  The last step looks at
all that is left, so no link depends on the draws.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .common import fresh, merged, small_batches, stored, table, utf8

BANDS, ROWS = 7, 2
# centres drawn from each side of a table key, and members up to which all
# pairs of a key are compared in the end
DRAWS, FEW = 2, 16
# members and shingles that a block of a frequent shingle's holders has about
# at most, and shingles multiplied at a time
BLOCK, BLOCK_SHINGLES, COLUMNS = 256, 1 << 20, 4096
# multiplier (odd) and summand of every minhash
_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, size=(2 * BANDS * ROWS, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# shingles hashed at a time
SLICE = 8192
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the `size`-word shingles; words are
    runs without ASCII white space, A-Z lower-cased.  With fewer words, the
    whole sequence is one shingle; no words, no shingle."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = len(h) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = _mixed(out * _MIX + h[k:k + n])
    return np.unique(out)


def band_values(shingles: np.ndarray) -> list[int]:
    """The band hashes of both collections, one after the other."""
    low = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SLICE):
        part = shingles[at:at + SLICE]
        low = np.minimum(low, (_SEEDS[:, :1] * part + _SEEDS[:, 1:]).min(axis=1))
    rows = low.reshape(2 * BANDS, ROWS)
    band = np.arange(2 * BANDS, dtype=np.uint64) % np.uint64(BANDS)
    for k in range(ROWS):
        band = _mixed(band * _MIX + rows[:, k])
    return band.view(np.int64).tolist()


def _sketch(size: int):
    @F.pandas_udf("struct<n:bigint,key:binary,bands:array<bigint>>")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        rows = []
        with np.errstate(over="ignore"):
            for text in texts:
                s = shingle_set(text, size)
                rows.append((len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None,
                             band_values(s) if len(s) else None))
        return pd.DataFrame(rows, columns=["n", "key", "bands"])

    return sketch


def _full_set(size: int):
    @F.pandas_udf("binary")
    def full_set(texts: pd.Series) -> pd.Series:
        with np.errstate(over="ignore"):
            return texts.map(lambda t: shingle_set(t, size).tobytes())

    return full_set


def _alike(percent: int):
    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out)

    return alike


def table_keys(reps: DataFrame) -> DataFrame:
    """(tkey, node, n): one row per table and document."""
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda j: F.xxhash64(i, j, F.element_at("bands", i + 1), F.element_at("bands", j + F.lit(BANDS + 1))))))
    return reps.select("node", "n", F.explode(pairs).alias("tkey"))


def _sizes_fit(a: str, b: str, percent: int):
    """No pair of sets can reach the threshold beyond this ratio of sizes."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over `edges` (a, b), for
    every node with an edge.  Alternating large-star and small-star steps
    (groupBy with map-side combining), stored once per turn, until the edge
    set stands still (its count and hash sum are observed while it is written)."""
    def turned(now: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        now = now.where("u != v").distinct().observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        return stored(now, "edges"), tuple(sorted(seen.get.items()))

    edges, state = turned(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges, now = turned(small)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()


def _sets(nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the full shingle sets of `nodes`."""
    named = docs.where("doc_id is not null").withColumnRenamed("doc_id", "node")
    texts = merged(named, nodes, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))
    return stored(texts.select("node", _full_set(size)(utf8("text")).alias("shingles")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    left = merged(pairs, sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = merged(left, sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return stored(both.where(_alike(percent)("sa", "sb")).select("a", "b"), "links")


def _draws(rows: DataFrame, sides: list[Column], turn: int, also: Column | None = None) -> DataFrame:
    """`DRAWS` centres of each side of every table key (and `also`): tkey,
    node2, n2, comp2.  The draw goes by a hash of the document alone, so keys
    with the same members draw alike."""
    def draw(side: Column, k: int) -> Column:
        return F.min(F.when(side, F.struct(F.xxhash64("node", F.lit(turn * DRAWS + k)).alias("r"), "node", "n", "comp")))

    drawn = [draw(side, k) for side in sides for k in range(DRAWS)]
    if also is not None:
        drawn.append(F.min(F.struct(also.alias("r"), "node", "n", "comp")))
    centres = rows.groupBy("tkey").agg(F.array(*drawn).alias("c"), F.count("*").alias("k")).where("k > 1")
    return centres.select("tkey", F.explode(F.array_distinct(F.transform("c", lambda c: c.dropFields("r")))).alias("c")).where(
        "c is not null").select("tkey", F.col("c.node").alias("node2"), F.col("c.n").alias("n2"), F.col("c.comp").alias("comp2"))


def _across(rows: DataFrame, comp: DataFrame, percent: int, turn: int) -> DataFrame:
    """Candidates among the table keys whose members lie in several
    components: each member against `DRAWS` centres of the key's smallest
    component and `DRAWS` of the rest."""
    label = merged(rows, comp, "node", "left").select("tkey", "node", "n", F.coalesce("comp", "node").alias("comp"))
    many = label.groupBy("tkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").drop("hi")
    mixed = stored(merged(label, many, "tkey"), "mixed")
    low = F.col("comp") == F.col("lo")
    return _pairs(mixed, _draws(mixed, [low, ~low], turn), percent)


def _all_across(shared: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """All pairs across components in table keys of at most `FEW` members."""
    label = merged(shared, comp, "node", "left").select("tkey", "node", "n", F.coalesce("comp", "node").alias("comp"))
    many = label.groupBy("tkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k")) \
        .where("lo != hi").where(F.col("k") <= FEW).select("tkey")
    mixed = stored(merged(label, many, "tkey"), "mixed")
    return _pairs(mixed, mixed.select("tkey", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("comp").alias("comp2")), percent)


def _shingle_rows(batches):
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch["shingles"]]
        yield pd.DataFrame({"node": np.repeat(batch["node"].to_numpy(), [len(x) for x in sets]),
                            "tkey": np.concatenate([np.empty(0, np.int64), *sets])})


def _prefixes(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(tkey, node, n, comp): the shingles of each set, rarest first, one of
    which any two sets that reach the threshold share.  Those of one holder
    come first and are left out."""
    rows = stored(merged(sets, open_.select("node"), "node").mapInPandas(_shingle_rows, "node bigint, tkey bigint"), "shingles")
    held = rows.groupBy("tkey").agg(F.count("*").alias("k")).where("k > 1")
    shared = merged(rows, held, "tkey").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("k", "tkey"))).alias("c"))
    # of n shingles, a partner shares ceil(n * percent / 100) at least
    both = merged(shared, open_, "node").withColumn("p", F.size("c") - F.ceil(F.col("n") * percent / F.lit(100)).cast("int") + 1)
    cut = both.where("p > 0").select("node", "n", "comp", F.explode(F.slice("c", 1, F.col("p"))).alias("c"))
    return stored(cut.select(F.col("c.tkey").alias("tkey"), "node", "n", "comp"), "prefixes")


def _compared(percent: int):
    def compare(block: pd.DataFrame) -> pd.DataFrame:
        """The first link found between any two components of the block."""
        sets = [np.frombuffer(x, np.uint64) for x in block["shingles"]]
        node, comp, side = (block[c].to_numpy() for c in ("node", "comp", "side"))
        n = np.array([len(x) for x in sets])
        _, at, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(len(sets)), n)
        kept = held[at] > 1
        column = (np.cumsum(held > 1) - 1)[at[kept]]
        order = np.argsort(column, kind="stable")
        column, doc = column[order], doc[kept][order]
        common = np.zeros((len(sets), len(sets)), np.int64)
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, [lo, lo + COLUMNS])
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[doc[a:b], column[a:b] - lo] = 1
            common += (part @ part.T).astype(np.int64)
        link = (100 * common >= percent * (n[:, None] + n[None, :] - common)) & (comp[:, None] < comp[None, :])
        if block["i"].iloc[0] != block["j"].iloc[0]:
            link &= side[:, None] != side[None, :]
        x, y = np.nonzero(link)
        out = pd.DataFrame({"a": np.maximum(node[x], node[y]), "b": np.minimum(node[x], node[y]), "x": comp[x], "y": comp[y]})
        return out.drop_duplicates(["x", "y"])[["a", "b"]]

    return compare


def _exact_across(shared: DataFrame, comp: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links across components among the members of the table keys of more
    than `FEW` members, whatever the draws."""
    label = merged(shared, comp, "node", "left").select("tkey", "node", "n", F.coalesce("comp", "node").alias("comp"))
    many = label.groupBy("tkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k")) \
        .where("lo != hi").where(F.col("k") > FEW).select("tkey")
    open_ = stored(merged(label, many, "tkey").select("node", "n", "comp").distinct(), "open")
    prefixes = _prefixes(open_, sets, percent)
    members = [F.sum(F.xxhash64("node", F.lit(k)).cast("decimal(38,0)")).alias(f"h{k}") for k in (0, 1)]
    groups = stored(prefixes.groupBy("tkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("k"),
                                                 F.sum("n").alias("total"), *members).where("lo != hi").drop("lo", "hi"), "groups")
    few = merged(prefixes, groups.where(F.col("k") <= FEW).select("tkey"), "tkey")
    few = stored(few, "few")
    pairs = _pairs(few, few.select("tkey", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("comp").alias("comp2")), percent)
    listed = _confirmed(pairs, sets, percent)
    # Shingles with the same holders are one; the holders are dealt to blocks,
    # and every two blocks meet in one group.
    parts = F.greatest(F.ceil(F.col("k") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    big = groups.where(F.col("k") > FEW).groupBy("k", "total", "h0", "h1").agg(F.min("tkey").alias("tkey")).select("tkey", parts.alias("parts"))
    dealt = merged(prefixes, big, "tkey").withColumn("side", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "tkey", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", "comp", "side")
    blocks = merged(dealt, sets, "node").groupBy("tkey", "i", "j").applyInPandas(_compared(percent), "a bigint, b bigint")
    return stored(listed.union(blocks).distinct(), "links")


def _pairs(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    members = members.select(F.col("tkey").alias("t"), "node", "n", "comp")
    near = (F.col("t") == F.col("tkey")) & (F.col("comp") != F.col("comp2")) & _sizes_fit("n", "n2", percent)
    return merged(members, centres, near).select(
        F.greatest("node", "node2").alias("a"), F.least("node", "node2").alias("b")).distinct()


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components after new links, which join whole components."""
    by_node = comp.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    ends = merged(merged(links, by_node, "a", "left"), by_node.select(F.col("a").alias("b"), F.col("ca").alias("cb")), "b", "left")
    ends = ends.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    new = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("node").alias("old"), F.col("comp").alias("new"))
    fresh_nodes = ends.select(F.col("a").alias("node"), F.col("ca").alias("old")).union(
        ends.select(F.col("b").alias("node"), F.col("cb").alias("old"))).where("node = old")
    known = comp.select("node", F.col("comp").alias("old")).union(fresh_nodes).distinct()
    return stored(merged(known, new, "old", "left").select("node", F.coalesce("new", "old").alias("comp")), "comp")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles,
    component_id, kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of
    their distinct `size`-word shingles.  Null or empty text has no shingle
    and no link.  Rows with one doc_id are one document (given different
    texts, the smallest text stands for it); a null doc_id takes no part in
    links, its component is null and it is kept.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    sk = stored(docs.select("doc_id", _sketch(size)(utf8("text")).alias("s")).select("doc_id", "s.*"), "sketch")
    named = sk.where("n > 0 and doc_id is not null")
    reps = stored(named.groupBy("key").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"),
                                           F.first("bands").alias("bands")), "reps")
    keys = table_keys(reps)

    # First round: every member against a few centres of its key.
    several = keys.groupBy("tkey").agg(F.count("*").alias("k")).where("k > 1").select("tkey")
    shared = stored(merged(keys, several, "tkey").select("tkey", "node", "n"), "shared")
    sets = _sets(shared.select("node").distinct(), docs, size)
    alone = shared.withColumn("comp", F.col("node"))
    links = _confirmed(_pairs(alone, _draws(alone, [F.lit(True)], 0, F.col("node")), percent), sets, percent)
    comp = stored(components(links), "comp")
    # Once more where the members of a key still lie in different components.
    links = _confirmed(_across(shared, comp, percent, 1), sets, percent)
    if not links.isEmpty():
        comp = _joined(comp, links)
    # What the draws missed, whatever they were.
    links = _confirmed(_all_across(shared, comp, percent), sets, percent).union(_exact_across(shared, comp, sets, percent))
    if not links.isEmpty():
        comp = _joined(comp, links)

    by_set = merged(reps, comp, "node", "left").select("key", F.coalesce("comp", "node").alias("comp"))
    out = merged(sk, by_set, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each component of near duplicates (the
    smallest doc_id; of rows repeating it, the one with the smallest text),
    columns unchanged."""
    named = docs.where("doc_id is not null")
    dropped = near_duplicates(docs, size, percent).where("not kept").select("doc_id").distinct()
    one = fresh(docs, "n_rows")
    twice = named.groupBy("doc_id").agg(F.count("*").alias(one)).where(f"{one} > 1").select("doc_id")
    kept = docs.join(dropped, "doc_id", "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    repeated = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct("text", *[F.col(f"`{c}`") for c in rest])).alias(one)).select("doc_id", f"{one}.*")
    return kept.join(twice, "doc_id", "left_anti").select(*columns).union(repeated.select(*columns))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
