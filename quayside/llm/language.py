"""Language identification as mixture inference.

Training counts hashed character trigrams per language over all labelled
texts; add-`SMOOTHING` estimates give P(trigram | language).  A text is a
mixture of languages: expectation-maximisation estimates its proportions from
its trigram counts.  The set of languages is selected by penalised likelihood:
starting with the best single language, a language joins while that raises the
log-likelihood by more than `PENALTY` * log(trigrams); the three languages with
the largest proportions among all are tried.  The likelihood reached with all
languages bounds that of fewer (up to the estimation's tolerance), so most texts
need one run.  The language with the largest proportion is the prediction.

The model is a table of languages x `BUCKETS` numbers.  Its size does not grow
with the corpus; the number of distinct languages is checked against
`MAX_LANGUAGES` before the model is gathered and broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, small_batches, table, unused, utf8

BUCKETS = 1 << 14
SMOOTHING = 0.5
PENALTY = 2.0
ROUNDS = 12
MAX_LANGUAGES = 200
UNDETERMINED = "und"

_PREDICTED = "struct<lang:string,score:double,proportions:map<string,double>>"


def letters(col: Column) -> Column:
    """Lower-cased letters and marks; any other run is one space."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), r"[^\p{L}\p{M}]+", " "), F.lit(" "))


def has_letter(col: Column) -> Column:
    return F.coalesce(col, F.lit("")).rlike(r"\p{L}")


def trigrams(text: bytes) -> np.ndarray:
    """Bucket of every byte trigram of a UTF-8 text."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities) from all rows with a label and a
    letter in the text.  Each task sends its counts per language and bucket,
    summed before the shuffle, so no language is a hot key."""
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & has_letter(F.col(text)))
    names = [r[0] for r in rows.select(F.col(lang).cast("string")).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the model is not bounded")

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, text_bytes in zip(batch["lang"], batch["text"]):
                got = np.bincount(trigrams(text_bytes), minlength=BUCKETS)
                if name in sums:
                    sums[name] += got
                else:
                    sums[name] = got
        for name, got in sums.items():
            at = np.flatnonzero(got)
            yield pd.DataFrame({"lang": name, "bucket": at, "n": got[at]})

    counts = rows.select(F.col(lang).cast("string").alias("lang"), letters(F.col(text)).cast("binary").alias("text")) \
        .mapInPandas(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    languages = sorted(names)
    table_ = np.full((len(languages), BUCKETS), SMOOTHING)
    got = counts.toPandas()  # at most languages x BUCKETS rows
    if len(got):
        at = got["lang"].map({name: k for k, name in enumerate(languages)})
        table_[at.to_numpy(), got["bucket"].to_numpy()] += got["n"].to_numpy()
    return languages, np.log(table_ / table_.sum(axis=1, keepdims=True)) if languages else table_


def mixture(counts: np.ndarray, probs: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation and the log-likelihood;
    `probs` has a row per trigram type and a column per language."""
    share = np.full(probs.shape[1], 1 / probs.shape[1])
    total = counts.sum()
    for _ in range(rounds):
        joint = probs * share
        all_ = joint.sum(axis=1)
        new = (counts / all_) @ joint / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(counts @ np.log(probs @ share))


def infer(counts: np.ndarray, logs: np.ndarray) -> tuple[list[int], np.ndarray]:
    """The selected languages (by first gain) and their proportions."""
    single = counts @ logs
    chosen = [int(np.argmax(single))]
    share, best = np.ones(1), float(single[chosen[0]])
    price = PENALTY * np.log(counts.sum())
    n = logs.shape[1]
    if n == 1:
        return chosen, share
    probs = np.exp(logs)
    everything, most = mixture(counts, probs)
    while len(chosen) < n and most - best > price:
        rest = [k for k in np.argsort(-everything, kind="stable") if k not in chosen]
        tried = [(mixture(counts, probs[:, chosen + [int(k)]]), int(k)) for k in rest[:3]]
        (more, value), k = max(tried, key=lambda x: x[0][1])
        if value - best <= price:
            break
        chosen, share, best = chosen + [k], more, value
    return chosen, share


def predictor(languages: list[str], logs: np.ndarray, spark: SparkSession):
    """A pandas UDF over `letters(text)` as bytes and `has_letter(text)`."""
    model = spark.sparkContext.broadcast((languages, np.ascontiguousarray(logs.T)))

    @F.pandas_udf(_PREDICTED)
    def predict(texts: pd.Series, lettered: pd.Series) -> pd.DataFrame:
        names, by_bucket = model.value
        rows = []
        for text, ok in zip(texts, lettered):
            grams = trigrams(text) if ok and names else ()
            if not len(grams):
                rows.append((UNDETERMINED, 0.0, {}))
                continue
            counts = np.bincount(grams, minlength=BUCKETS)
            at = np.flatnonzero(counts)
            chosen, share = infer(counts[at].astype(float), by_bucket[at])
            top = int(np.argmax(share))
            rows.append((names[chosen[top]], float(min(1.0, share[top])),
                         {names[k]: float(x) for k, x in zip(chosen, share)}))
        return pd.DataFrame(rows, columns=["lang", "score", "proportions"])

    return predict


def with_language(df: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", name: str = "language") -> DataFrame:
    """`df` with a struct column: lang, score (its proportion) and the
    proportions of all selected languages.  Null text and text without a
    letter are `und` with score 0; so is every text if nothing was learned.
    Rows are judged one by one; equal texts get equal results.  An input column
    named like `name` is an error."""
    unused(df, name)
    small_batches(df.sparkSession)
    predict = predictor(*model, df.sparkSession)
    return df.withColumn(name, predict(letters(F.col(text)).cast("binary"), has_letter(F.col(text))))


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32 of the id's text leaves 2 modulo 4; a null id
    counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identified(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language can be told, columns unchanged; the
    model is trained on the rows not held out.  Only `und` is rejected."""
    name = fresh(docs, "language")
    known = with_language(docs, train(docs.where(~held_out(F.col("doc_id")))), name=name)
    return known.where(F.col(name)["lang"] != UNDETERMINED).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.proportions").alias("proportions"))
