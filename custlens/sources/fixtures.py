"""Customer, transaction and page-view tables derived from the driver tables.

The engine works on three inputs: ``tag`` (one row per customer), ``trd``
(transactions) and ``beh`` (page views).  The driver ships TPC-H-like tables,
so these functions derive the three inputs (and the importance and score
tables) from them.  Every function here is a plain projection/join, so Catalyst
prunes columns and pushes filters into the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.sources.tables import read_table

BACKSLASH_N = "\\N"
# The page types of the events table.
PAGE_TYPES = ("click", "error", "purchase", "signup", "view")


def tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers: ``id, flag, split, seg_cd, nat_cd, buy_a, buy_b, buy_c``.

    Every fifth customer is a scoring customer; ``flag`` is the 0/1 label.
    """
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("id"),
        F.when(F.col("c_acctbal") < 1000, 1).otherwise(0).alias("flag"),
        F.when(key % 5 == 0, "score").otherwise("train").alias("split"),
        F.col("c_mktsegment").alias("seg_cd"),
        F.col("c_nationkey").cast("string").alias("nat_cd"),
        (key % 7).cast("double").alias("buy_a"),
        (key % 11).cast("double").alias("buy_b"),
        (key % 13).cast("double").alias("buy_c"),
    )


def trd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: ``id, l_orderkey, l_linenumber, trx_tm, amt, flg1, flg3,
    cod1, cod2``.  Returned lines become negative amounts.

    lineitem joins orders on the order key (both sides large: sort-merge
    join on ``l_orderkey``) and part on the part key; the optimizer or AQE
    turns the part join into a broadcast only when its measured size is under
    the broadcast threshold, else it is a shuffle join.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # Both sides are fact-sized at scale: co-partition them on the order key
    # (sort-merge join).  The hint keeps that plan at small scale too, where
    # the shuffle also spreads a single-row-group scan over all cores.
    j = (li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey)
           .join(p, li.l_partkey == p.p_partkey))
    rf = F.col("l_returnflag")
    return j.select(
        F.col("o_custkey").alias("id"),
        "l_orderkey", "l_linenumber",
        F.col("l_shipdate").alias("trx_tm"),
        F.when(rf == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amt"),
        F.when(F.col("l_linestatus") == "F", "B").otherwise("C").alias("flg1"),
        F.when(rf == "A", "A").when(rf == "N", "B").otherwise("C").alias("flg3"),
        F.col("o_orderpriority").alias("cod1"),
        F.col("p_brand").alias("cod2"),
    )


def beh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views: ``id, page_tm, page``."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("id"), F.col("ts").alias("page_tm"),
                    F.col("event_type").alias("page"))


def page_trd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page events in the shape of transactions, with times of day; ``flg1`` takes values
    beside B and C, and clicks are negative amounts."""
    e = read_table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.col("user_id").alias("id"), F.col("ts").alias("trx_tm"),
        F.when(kind == "click", -F.col("value")).otherwise(F.col("value")).alias("amt"),
        F.when(kind == "click", "B").when(kind == "view", "C").otherwise("D").alias("flg1"),
        F.when(kind == "click", "A").when(kind == "view", "B").otherwise("C").alias("flg3"),
        kind.alias("cod1"), F.substring(kind, 1, 1).alias("cod2"))


def text_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as a CSV gives them, all text; some amounts and times don't parse."""
    li = read_table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.when(k % 97 == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(k % 101 == 0, "2020-02-30").when(k % 53 == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipped"))


def tag_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-typed attributes with sentinels, one column per sentinel case."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    null_txt = F.lit(BACKSLASH_N)
    return p.select(
        k.alias("id"),
        F.when(k % 5 == 0, "score").otherwise("train").alias("split"),
        F.when(k % 17 == 0, null_txt).otherwise(F.col("p_brand")).alias("brand_txt"),
        F.when(k % 17 == 0, null_txt).when(k % 19 == 0, "-1")
         .otherwise(F.col("p_type")).alias("type_txt"),
        F.when(k % 17 == 0, null_txt).when(k % 13 == 0, "-1")
         .otherwise(F.col("p_size").cast("string")).alias("size_txt"),
    )


def tag_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number columns as a CSV gives them, as text: ``age`` holds numbers only, among
    them 30, 31 and -1; ``mixed`` has a sentinel in the scoring rows alone."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    return p.select(
        k.alias("id"), F.when(k % 5 == 0, "score").otherwise("train").alias("split"),
        F.when(k % 13 == 0, "-1").otherwise(size).alias("age"),
        F.when(k % 85 == 0, F.lit(BACKSLASH_N)).otherwise(size).alias("mixed"))


def imp_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null importances: every part row is one run of its brand (feature)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_brand").alias("feature"),
                    F.col("p_retailprice").alias("importance_gain"),
                    F.col("p_size").alias("importance_split"))


def imp_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual importances: every part row is one run of its brand (feature), with
    two-digit brands shifted up so that the selection threshold splits them."""
    p = read_table(spark, sf_dir, "part")
    shift = F.when(F.length("p_brand") == 8, 20).otherwise(0)
    return p.select(F.col("p_brand").alias("feature"),
                    (F.col("p_retailprice") + shift).alias("importance_gain"),
                    F.col("p_size").alias("importance_split"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of 3 models x 5 folds per scoring customer: ``model, fold, id, score``.

    The 15 (model, fold) pairs are generated per row with ``explode`` (a
    generator, no join).
    """
    # Scores exist for every scoring customer (the "score" split of ``tag``).
    c = tag(spark, sf_dir).where(F.col("split") == "score")
    c = (c.select("id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("model"))
          .select("id", "model", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("fold")))
    s: Column = ((F.col("id") * 31 + F.col("fold") * 7 + F.col("model") * 13) % 1000).cast("double") / 1000
    return c.select("model", "fold", "id", s.alias("score"))
