"""Token sequences per customer, token embeddings and mean vectors.

A customer's token sequence is kept as ordered chunks of at most
``max_len`` tokens (``id, seq_no, tokens``): a customer with a third of all
transactions never becomes one array in one task.  ``max_len`` defaults to
the sentence length at which Spark's ``Word2Vec`` splits sentences anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.operators.median import BROADCAST_MAX_ROWS
from custlens.operators.ordered import row_numbers
from custlens.operators.skew import HOT_GROUP_ROWS

MAX_LEN = 1000
# Fixed value: missing tokens are written as the text "nan" (pandas astype(str)).
NULL_TOKEN = "nan"


def token_sequences(events: DataFrame, key: str, token: str, order: Sequence[str],
                    segment: Column | None = None, max_len: int = MAX_LEN,
                    hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """``key, seq_no, tokens``: the key's tokens in ``order``, cut into
    consecutive chunks of ``max_len``.  The token itself breaks remaining ties,
    so the sequence is deterministic.  Ranks of hot keys are computed per ``segment``
    (default: between quantiles of the first order column, a time or a number)."""
    order = list(order)
    tok = F.coalesce(F.col(token).cast("string"), F.lit(NULL_TOKEN))
    ranked = row_numbers(events.select(key, *order, tok.alias("_tok")), [key], segment,
                         [*order, "_tok"], "_rn", hot_rows)
    chunk = F.floor((F.col("_rn") - 1) / max_len).alias("seq_no")
    grouped = (ranked.select(key, chunk, "_rn", "_tok")
                     .groupBy(key, "seq_no")
                     .agg(F.array_sort(F.collect_list(F.struct("_rn", "_tok"))).alias("_p")))
    return grouped.select(key, "seq_no", F.transform("_p", lambda e: e["_tok"]).alias("tokens"))


def fit_embedding(sequences: DataFrame, size: int = 6, window: int = 5, min_count: int = 1,
                  seed: int = 999, partitions: int = 16, max_iter: int = 1,
                  max_len: int = MAX_LEN) -> Word2VecModel:
    """Skip-gram ``Word2Vec`` over the token chunks (``tokens`` column).

    Spark trains one model copy per partition and averages them, so the result
    depends on ``partitions``: an argument with a fixed default, not a property of
    the cluster.  Raise it for large inputs."""
    w2v = Word2Vec(vectorSize=size, windowSize=window, minCount=min_count, seed=seed,
                   numPartitions=partitions, maxIter=max_iter, maxSentenceLength=max_len,
                   inputCol="tokens", outputCol="_vec")
    return w2v.fit(sequences.select("tokens"))


def vocabulary(model: Word2VecModel) -> DataFrame:
    """``token, vector (array<double>)`` of a fitted model."""
    from pyspark.ml.functions import vector_to_array
    return model.getVectors().select(F.col("word").alias("token"),
                                     vector_to_array("vector").alias("vector"))


def mean_vector(df: DataFrame, key: str, vector: str, dim: int, prefix: str | None = None,
                out: str = "mean_vec") -> DataFrame:
    """Element-wise mean of the array column ``vector`` per ``key``.

    Returns ``key, out`` (array<double>), or ``key, prefix0..prefix{dim-1}``
    when ``prefix`` is given.  Elements are averaged per (key, position) with
    partial aggregation, so a key with very many vectors is not a hot task.
    """
    pos = (df.select(key, F.posexplode(vector).alias("_pos", "_x"))
             .groupBy(key, "_pos").agg(F.avg(F.col("_x").cast("double")).alias("_m")))
    if prefix is not None:
        return pos.groupBy(key).agg(*[F.max(F.when(F.col("_pos") == i, F.col("_m"))).alias(f"{prefix}{i}")
                                      for i in range(dim)])
    arr = pos.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_m"))).alias("_p"))
    return arr.select(key, F.transform("_p", lambda e: e["_m"]).alias(out))


def token_mean_vectors(events: DataFrame, key: str, token: str, vocab: DataFrame, dim: int,
                       prefix: str = "w2v_") -> DataFrame:
    """Mean of the vectors of all a key's tokens (each occurrence counts once)."""
    tok = F.coalesce(F.col(token).cast("string"), F.lit(NULL_TOKEN)).alias("token")
    n_vocab = vocab.count()
    v = F.broadcast(vocab) if n_vocab <= BROADCAST_MAX_ROWS else vocab
    # Tokens are counted before they meet their vectors: one row per key and token.
    counts = events.select(key, tok).groupBy(key, "token").agg(F.count(F.lit(1)).alias("_n"))
    joined = counts.join(v, "token")
    total = F.sum("_n")
    return joined.groupBy(key).agg(*[
        (F.sum(F.col("_n") * F.get("vector", F.lit(i)).cast("double")) / total).alias(f"{prefix}{i}")
        for i in range(dim)])
