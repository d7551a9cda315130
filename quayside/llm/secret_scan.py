"""Secret scanning: assignment, access-key and hex patterns, and a sliding
Shannon entropy over candidate strings.

A candidate is a run of at least `WINDOW` key characters holding a letter and
a digit.  A window of `WINDOW` characters slides over it; the sum of
c * log2(c) over the character counts c of the window is updated by the
character that enters and the one that leaves, which gives every window's
entropy.  The highest is compared with the threshold of the candidate's
character class.  An allow-list (identifiers, announced digests, placeholders)
suppresses candidates.  Everything is an expression over the text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .spans import labelled, listed, with_matches

WINDOW = 20
# The kinds in listing order and their patterns.
KINDS = ["assign", "access", "hex", "entropy"]
BASE = KINDS[:3]
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)""",
    "access": r"AKIA[A-Z0-9]++",
    "hex": r"[0-9a-f]{24,}+",
    "entropy": rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}+",
}
# Least entropy in bits (of log2(20) = 4.32) by character class.
CLASSES = [("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.6), ("", 3.8)]
ALLOWED = [
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|placeholder|changeme|x{6}|0123456789|abcdefgh",
    r"^[A-Za-z]+([-_/+=]+([A-Za-z]+|[0-9]{1,4}))*$",  # words and small numbers joined by separators
]
# Words before a candidate that announce a public digest.
ANNOUNCED = r"(?i)(sha-?(1|256|384|512)|md5|commit|checksum|digest|integrity|revision)\W{0,4}$"


def window_entropy(candidate: Column) -> Column:
    """The highest entropy, in bits, of `WINDOW` neighbouring characters."""
    def weight(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(F.greatest(c, F.lit(1)))).otherwise(0.0)

    def count(window: Column, char: Column) -> Column:
        return (F.length(window) - F.length(F.replace(window, char, F.lit("")))).cast("double")

    def step(a: Column, char: Column) -> Column:
        entered = a["sum"] - weight(count(a["window"], char)) + weight(count(a["window"], char) + 1)
        full = F.length(a["window"]) == WINDOW
        grown = F.concat(a["window"], char)
        gone = F.substring(a["window"], 1, 1)
        total = F.when(full, entered - weight(count(grown, gone)) + weight(count(grown, gone) - 1)).otherwise(entered)
        window = F.when(full, F.substring(grown, 2, WINDOW)).otherwise(grown)
        return F.struct(window.alias("window"), total.alias("sum"),
                        F.when(F.length(window) == WINDOW, F.least(a["least"], total)).otherwise(a["least"]).alias("least"))

    start = F.struct(F.lit("").alias("window"), F.lit(0.0).alias("sum"), F.lit(1e9).alias("least"))
    return F.aggregate(F.split(candidate, ""), start, step,
                       lambda a: F.log2(F.lit(float(WINDOW))) - a["least"] / WINDOW)


def _random(hit: Column) -> Column:
    """Above the threshold of its character class."""
    least = F.lit(CLASSES[-1][1])
    for pattern, bits in reversed(CLASSES[:-1]):
        least = F.when(hit.rlike(pattern), bits).otherwise(least)
    return window_entropy(hit) >= least


def _kept(kind: str, s: Column) -> Column:
    hit = s["hit"]
    if kind == "assign":
        return F.length(F.regexp_extract(hit, PATTERNS["assign"], 1)) >= 6
    if kind == "access":
        return F.length(hit) >= 20
    if kind == "entropy":
        plain = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & ~s["before"].rlike(ANNOUNCED)
        for pattern in ALLOWED:
            plain = plain & ~hit.rlike(pattern)
        return F.when(plain, _random(hit)).otherwise(False)
    return F.lit(True)


def with_secrets(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """`df` with one array of spans per kind; returns the frame and the
    columns' names.  Base kinds stay whatever their entropy; an entropy span
    that overlaps a base span is left out.  Null and empty texts have none."""
    body = F.coalesce(F.col(text), F.lit(""))
    quick = {"assign": F.contains(body, F.lit("=")) | F.contains(body, F.lit(":")), "access": F.contains(body, F.lit("AKIA"))}
    df, names = with_matches(df, text, PATTERNS, quick)
    for kind, name in names.items():
        spans = F.filter(F.col(name), lambda s: _kept(kind, s))
        if kind == "entropy":
            base = F.concat(*[F.col(names[k]) for k in BASE])
            spans = F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])))
        df = df.withColumn(name, spans)
    return df, names


def all_spans(names: dict[str, str], kinds: list[str]) -> Column:
    return F.concat(*[labelled(F.col(names[k]), k, KINDS.index(k)) for k in kinds])


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, names = with_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(names[k]).cast("bigint").alias(f"n_{k}") for k in BASE]
    return df.select("doc_id", *counts, F.sha2(listed(all_spans(names, BASE)), 256).alias("base_sha256"),
                     listed(all_spans(names, KINDS)).alias("spans"))
