"""Quality rules: surface counts and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word n-grams (orders 1 and 2) are estimated, one
from trusted target documents and one from the whole raw corpus.  A document's
score is the sum of log(target / raw) over its n-grams divided by their number;
documents below a fixed threshold are rejected, every document is decided.
Only DataFrame functions are used; the bucket counts (a number fixed by a
parameter) are the only thing that the driver sees.

The n-gram counts come from one row per (document, n-gram) that is summed per
bucket before the shuffle, so hot words or sources cost nothing extra.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.llm.common import SPACE, documents, no_text

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

#: Hash buckets of the multinomials, raw-corpus counts added to either side of a
#: bucket's ratio (rare buckets stay near 0), and the least length-normalised
#: log ratio (nats per n-gram) of a kept document.
BUCKETS = 1 << 14
SMOOTHING = 10.0
THRESHOLD = -0.11


def pin(column: Column) -> Column:
    """The column, with a condition that always holds but that the optimiser can't
    decide: it then neither moves filters below this projection nor puts the column's
    expression into later lambdas, where each element would work it out anew."""
    return F.when(F.monotonically_increasing_id() >= 0, column)


def words_of(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, "[\\x20\\x09-\\x0D]+"))


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")


def _count_of(text: Column, symbols: str) -> Column:
    """How often ASCII symbols occur: the bytes that leave with each."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(s), F.lit(""))) for s in symbols),
               F.lit(0))


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(hashed: Column) -> Column:
    """64-bit hashes of the 3-word windows, in order."""
    return F.when(F.size(hashed) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(hashed) - WINDOW),
        lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(WINDOW)]))).otherwise(
            F.array().cast("array<bigint>"))


def _near_equal(placed: Column) -> Column:
    """First words of the windows found twice or more, from the windows sorted
    with their positions."""
    def same(x: Column, j: Column) -> Column:
        return F.coalesce(F.get(placed, j)["h"] == x["h"], F.lit(False))
    marked = F.filter(placed, lambda x, j: same(x, j - 1) | same(x, j + 1))
    return F.array_sort(F.transform(marked, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Words covered by the windows that begin at ``starts`` (ascending)."""
    seen = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).alias("n"),
                                (i + WINDOW).alias("end")))
    return F.coalesce(seen["n"], F.lit(0))


def _one(hashed: Column, i: Column) -> Column:
    return F.pmod(F.get(hashed, i), F.lit(BUCKETS)).cast("int")


def _two(hashed: Column, i: Column) -> Column:
    return F.pmod(F.xxhash64(F.get(hashed, i), F.get(hashed, i + 1)), F.lit(BUCKETS)).cast("int")


def _grams(hashed: Column) -> Column:
    """Buckets of the hashed 1- and 2-grams of a text."""
    places = F.sequence(F.lit(0), F.size(hashed) - 1)
    return F.when(F.size(hashed) > 0, F.filter(F.flatten(F.transform(
        places, lambda i: F.array(_one(hashed, i), F.when(i < F.size(hashed) - 1, _two(hashed, i))))),
        lambda b: b.isNotNull()))


def _ratio_sum(hashed: Column, weights: Column) -> Column:
    """Sum of the log ratios of a text's 1- and 2-grams, in order."""
    return F.when(F.size(hashed) > 0, F.aggregate(
        F.sequence(F.lit(0), F.size(hashed) - 1), F.lit(0.0),
        lambda s, i: s + F.get(weights, _one(hashed, i)) + F.when(
            i < F.size(hashed) - 1, F.get(weights, _two(hashed, i))).otherwise(0.0))).otherwise(0.0)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """log(target / raw) of every bucket.  ``trusted`` holds the doc_ids of the
    target documents; repeated and null ids count once or not at all."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("trusted_id")).dropna().distinct()
    rows = documents(docs)
    # The same join at every size: texts meet the labels by doc_id, unsorted.
    rows = rows.join(ids.hint("shuffle_hash"), rows["doc_id"] == ids["trusted_id"], "left")
    rows = rows.select(F.col("trusted_id").isNotNull().cast("long").alias("t"),
                       pin(words_of(no_text(F.col("text")))).alias("words"))
    rows = rows.select("t", pin(hashes(F.col("words"))).alias("hashed"))
    grams = rows.select("t", F.explode(_grams(F.col("hashed"))).alias("b"))
    counts = {r["b"]: (r["t"], r["n"]) for r in
              grams.groupBy("b").agg(F.sum("t").alias("t"), F.count("*").alias("n")).collect()}
    share = sum(n for _, n in counts.values()) / max(1, sum(t for t, _ in counts.values()))
    if not any(t for t, _ in counts.values()):
        return [0.0] * BUCKETS
    ratios = [(counts.get(b, (0, 0))) for b in range(BUCKETS)]
    return [math.log((t * share + SMOOTHING) / (n + SMOOTHING)) for t, n in ratios]


def _assessed(docs: DataFrame, trusted: DataFrame, threshold: float, row: Column | None = None) -> DataFrame:
    """The columns of ``assess`` beside ``row``, which is carried along as ``__row``."""
    weights = F.from_json(F.lit(json.dumps([round(w, 9) for w in log_ratios(docs, trusted)])),
                          "array<double>")
    text = no_text(F.col("text").cast("string"))
    # Each projection holds what the lambdas of the next refer to.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       pin(words_of(text)).alias("words"), _lines(text).alias("lines"),
                       (F.lit(None) if row is None else row).alias("__row"))
    rows = rows.withColumn("hashed", pin(hashes(F.col("words"))))
    rows = rows.withColumn("win", pin(windows(F.col("hashed"))))
    rows = rows.withColumn("placed", pin(F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))))
    rows = rows.withColumn("starts", pin(_near_equal(F.col("placed"))))
    rows = rows.select(
        "__row", "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        _count_of(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        pin(_covered(F.col("starts")).cast("long")).alias("n_repeat_words"),
        pin(_ratio_sum(F.col("hashed"), weights)
            / F.greatest(2 * F.size("words") - 1, F.lit(1))).alias("llr"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("llr") >= threshold))


def assess(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr,
    base_failed, kept: one row per input row.

    A null text counts as empty: no words, base_failed, not kept, llr 0.  Without
    any trusted n-gram there is nothing to compare with: all ratios are 0 and only
    the base rules decide.  Repeated rows and ids give repeated results.
    """
    return _assessed(docs, trusted, threshold).drop("__row")


def keep(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns."""
    return _assessed(docs, trusted, threshold, F.struct("*")).where("kept").select("__row.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not toxic."""
    return labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id")
