"""Personal data: patterns propose spans, validators confirm them, context
words adjust the score.

Base kinds (email, ip, card, phone) are confirmed by their own rules alone: a
span that passes stays, whatever its score.  Added kinds must reach
`THRESHOLD`: `iban` (mod-97 checksum) and `ssn` (no checksum, so only with a
context word).  Everything is an expression over the text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, table
from .spans import labelled, listed, with_matches

# The kinds in listing order and their patterns.  Possessive
# quantifiers and look-behinds only spare the engine retries inside a run that
# cannot match; `card` matches a whole run of 14 to 19 digits at once.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = KINDS[:4]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}+",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Score: of the pattern, added by a passed checksum, added by a context word.
SCORES = {"email": (0.8, 0.0, 0.2), "ip": (0.5, 0.0, 0.3), "card": (0.4, 0.4, 0.2), "phone": (0.5, 0.0, 0.3),
          "iban": (0.3, 0.5, 0.2), "ssn": (0.3, 0.0, 0.5)}
THRESHOLD = 0.6
CONTEXT_WORDS = {
    "email": r"(?i)\b(e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(ip|address|host|server|login)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|payment|cc)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|fax|cell)\b",
    "iban": r"(?i)\b(iban|account|bank|transfer|konto|cuenta|compte)\b",
    "ssn": r"(?i)\b(ssn|social security|taxpayer|tax id)\b",
}


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added, divisible by 10."""
    total = F.aggregate(
        F.split(F.reverse(digits), ""), F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
        lambda a, c: F.struct((a["n"] + 1).alias("n"), (a["sum"] + F.when(a["n"] % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))).alias("sum")),
        lambda a: a["sum"])
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """The four leading characters moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    rest = F.aggregate(F.split(moved, ""), F.lit(0), lambda r, c: F.when(
        c.rlike("[0-9]"), (r * 10 + F.when(c.rlike("[0-9]"), c).otherwise("0").cast("int")) % 97).otherwise(
        (r * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def _confirmed(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(_digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    if kind == "iban":
        return mod97(hit)
    if kind == "ssn":
        return ~hit.rlike("^(000|666|9)|-00-|0000$")
    return F.lit(True)


def _score(kind: str, span: Column) -> Column:
    pattern, checksum, context = SCORES[kind]
    near = F.concat_ws(" ", span["before"], span["after"]).rlike(CONTEXT_WORDS[kind])
    return F.round(F.lit(pattern + checksum) + F.when(near, context).otherwise(0.0), 2)


def with_pii(df: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """`df` with one array of spans per kind (start, end, hit, before, after,
    score); returns the frame and the columns' names by kind.  Null and empty
    texts have no span; rows are judged one by one."""
    body = F.coalesce(F.col(text), F.lit(""))
    quick = {"email": F.contains(body, F.lit("@")), "phone": F.contains(body, F.lit("+")), "ssn": F.contains(body, F.lit("-"))}
    df, names = with_matches(df, text, PATTERNS, quick)
    for kind, name in names.items():
        spans = F.filter(F.col(name), lambda s: _confirmed(kind, s["hit"]))
        spans = F.transform(spans, lambda s: s.withField("score", _score(kind, s)))
        if kind not in BASE:
            spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
        df = df.withColumn(name, spans)
    return df, names


def all_spans(names: dict[str, str], kinds: list[str]) -> Column:
    return F.concat(*[labelled(F.col(names[k]), k, KINDS.index(k)) for k in kinds])


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with every span replaced by its kind in angle brackets
    (overlapping spans by the kind of the first), n_chars counted anew where
    the text changed; other columns and rows unchanged."""
    spanned, names = with_pii(docs)
    found = fresh(spanned, "found")
    spanned = spanned.withColumn(found, F.array_sort(all_spans(names, KINDS)))
    text = F.coalesce(F.col("text"), F.lit(""))
    # state: the redacted text so far and the position reached
    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("at"))
    walked = F.aggregate(F.col(found), start, lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
        F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(
            F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))))
        .otherwise(a["parts"]).alias("parts"), s["end"].alias("at"))),
        lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["at"] + 1, F.length(text))))
    clean = F.when(F.size(found) > 0, walked).otherwise(F.col("text"))
    out = spanned.withColumn("text", clean)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(found) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, names = with_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(names[k]).cast("bigint").alias(f"n_{k}") for k in BASE]
    return df.select("doc_id", *counts, F.sha2(listed(all_spans(names, BASE)), 256).alias("base_sha256"),
                     listed(all_spans(names, KINDS)).alias("spans"))
