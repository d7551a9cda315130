"""Spans of regular-expression matches as DataFrame expressions.

A pattern's matches and the gaps between them (`split`) give code-point
positions by running sums, without Python.  Only texts that hold a match pay
for more than one search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

# Code points of text kept on either side of a match as its context (up to the
# neighbouring match of the same kind).
CONTEXT = 48

HIT = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"


def running_sum(numbers: Column) -> Column:
    """Inclusive running sums of an int array.  Two levels (blocks of about
    sqrt(n)), so that a text with very many matches stays near-linear."""
    n = F.size(numbers)
    width = F.ceil(F.sqrt(n)).cast("int")

    def sums(xs: Column, first: Column) -> Column:
        return F.aggregate(xs, F.array(first), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    zero = F.lit(0)
    blocks = F.transform(F.sequence(zero, F.floor((n - 1) / width).cast("int")),
                         lambda k: F.slice(numbers, k * width + 1, width))
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: a + x))
    starts = sums(totals, zero)
    inner = F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)),
                       lambda b, first: F.slice(sums(b, first), 2, F.size(b)))
    return F.when(n > 0, F.flatten(inner)).otherwise(F.array().cast("array<int>"))


def with_matches(df: DataFrame, text: str, patterns: dict[str, str], only_if: dict[str, Column] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """`df` with, per kind, an array of its leftmost non-overlapping matches
    (start, end in code points, end exclusive; the hit; context on both
    sides).  Null text has none.  `only_if` may name a cheap test that every
    text with a match passes.  Returns the frame and the columns' names."""
    hits, ends, out = {}, {}, {}
    body = F.coalesce(F.col(text), F.lit(""))
    for kind, pattern in patterns.items():
        test = body.rlike(pattern)
        if only_if and kind in only_if:
            test = only_if[kind] & test
        hits[kind] = fresh(df, f"{kind}_hits")
        df = df.withColumn(hits[kind], F.when(test, F.struct(
            F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("hit"),
            F.split(body, pattern, -1).alias("gap"))))
    for kind in patterns:
        ends[kind] = fresh(df, f"{kind}_ends")
        h = F.col(hits[kind])
        steps = F.zip_with(h["hit"], F.slice(h["gap"], 1, F.size(h["hit"])), lambda x, g: F.length(x) + F.length(g))
        df = df.withColumn(ends[kind], F.when(h.isNotNull(), running_sum(steps)))
    for kind in patterns:
        out[kind] = fresh(df, f"{kind}_spans")
        h, e = F.col(hits[kind]), F.col(ends[kind])
        parts = F.arrays_zip(h["hit"].alias("hit"), e.alias("end"), F.slice(h["gap"], 1, F.size(e)).alias("left"),
                             F.slice(h["gap"], 2, F.size(e)).alias("right"))
        parts = parts.cast("array<struct<hit:string,end:int,before:string,after:string>>")
        zipped = F.transform(parts, lambda z: F.struct(
            (z["end"] - F.length(z["hit"])).alias("start"), z["end"].alias("end"), z["hit"].alias("hit"),
            F.right(z["before"], F.lit(CONTEXT)).alias("before"), F.left(z["after"], F.lit(CONTEXT)).alias("after")))
        df = df.withColumn(out[kind], F.when(h.isNotNull(), zipped.cast(HIT)).otherwise(F.array().cast(HIT)))
    return df.drop(*hits.values(), *ends.values()), out


def labelled(spans: Column, kind: str, order: int) -> Column:
    """Spans as (start, place of the kind, end, kind), which sorts as listed."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def listed(spans: Column) -> Column:
    """`kind:start:end` by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
