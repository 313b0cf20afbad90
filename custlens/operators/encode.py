"""Encodings: product/ratio features, weight of evidence, category money stats.

Lookup tables (one row per category value) are joined back with a broadcast
only when their row count is bounded by a number computed beforehand (the
category cardinalities of the customer table); otherwise they are joined
with a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.numeric import money_sum, nan_to_null, row_sum
from custlens.operators.median import BROADCAST_MAX_ROWS
from custlens.operators.ordered import running_sums
from custlens.operators.skew import HOT_GROUP_ROWS
from custlens.operators.weighted import signed_medians
from custlens.sources.facts import Facts, parts_of
from custlens.sources.materialize import materialize

WOE_SUFFIX = "_crossentroy"
CODE_SUFFIX = "_code"
#: Most values of a column that get codes of their own; values of larger ones share
#: this many hashed codes, so a model's bins are bounded.
MAX_CODES = 1000
#: Bytes of a column's values up to which its code table is broadcast.
CODE_TABLE_BYTES = 1 << 20


def product_features(df: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """``out = float(a) * float(b)`` for each ``out -> (a, b)``."""
    return df.withColumns({out: F.col(a).try_cast("double") * F.col(b).try_cast("double")
                           for out, (a, b) in spec.items()})


def ratio_features(df: DataFrame, cols: Sequence[str], sum_col: str) -> DataFrame:
    """``sum_col`` = row sum of ``cols`` (NULL as 0), then ``<c>_ratio = c / (sum + 1)``
    (NULL instead of an error when the divisor is 0)."""
    out = df.withColumn(sum_col, row_sum(cols))
    return out.withColumns({f"{c}_ratio": F.try_divide(F.col(c).try_cast("double"),
                                                       F.col(sum_col) + F.lit(1.0))
                            for c in cols})


def _unpivot_values(df: DataFrame, keep: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``keep..., _name, _val`` with one row per non-null value of ``cols`` (as text)."""
    entries = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("string").alias("v"))
                        for c in cols])
    return (df.select(*keep, F.explode(entries).alias("_e"))
              .select(*keep, F.col("_e.n").alias("_name"), F.col("_e.v").alias("_val"))
              .where(F.col("_val").isNotNull()))


def category_cardinalities(users: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Distinct non-null values per column (one small aggregate, collected)."""
    counts = _unpivot_values(users, [], cols).groupBy("_name", "_val").count()
    rows = counts.groupBy("_name").agg(F.count(F.lit(1)).alias("k"), F.min("count").alias("m"))
    return {r["_name"]: r["k"] for r in rows.collect()}


def _maybe_broadcast(df: DataFrame, bound: int | None) -> DataFrame:
    return F.broadcast(df) if bound is not None and bound <= BROADCAST_MAX_ROWS else df


def category_codes(df: DataFrame, cols: Sequence[str], learn: Column | None = None,
                   max_codes: int = MAX_CODES) -> tuple[DataFrame, dict[str, int]]:
    """``<c>_code`` for each column, and the number of codes ``n`` of each.

    The values of the rows where ``learn`` holds (default: all) get their rank in text
    order, from 0 on.  A column with more than ``max_codes`` values gets the first 32 bits
    of the values' MD5, modulo ``max_codes`` (``n``).  A missing value gets ``n``, one that
    was not learned ``n + 1``.  Distinct values are counted and ranked in Spark; only
    ranked columns have a code table, of ``max_codes`` rows at most, and the driver holds
    two numbers a column.
    """
    if not cols:
        return df, {}
    values = materialize(_unpivot_values(df if learn is None else df.where(learn), [], cols).distinct(),
                         "category-values")
    facts = {r["_name"]: (r["n"], r["b"]) for r in values.groupBy("_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_val")).alias("b")).collect()}
    ranked = [c for c in cols if facts.get(c, (0, 0))[0] <= max_codes]
    place = F.row_number().over(Window.partitionBy("_name").orderBy("_val")) - 1
    table = values.where(F.col("_name").isin(ranked)).select("_name", "_val", place.cast("long").alias("_code"))
    out, codes, sizes = df, {}, {}
    for i, c in enumerate(cols):
        text = F.col(c).cast("string")
        n, size = facts.get(c, (0, 0))
        if c in ranked:
            own = table.where(F.col("_name") == c).select(
                F.col("_val").alias(f"_code_value_{i}"), F.col("_code").alias(f"_code_rank_{i}"))
            own = F.broadcast(own) if size <= CODE_TABLE_BYTES else own.hint("merge")
            out = out.join(own, text == F.col(f"_code_value_{i}"), "left")
            code = F.coalesce(F.col(f"_code_rank_{i}"), F.lit(n + 1))
        else:
            n = max_codes
            code = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % n
        sizes[c] = n
        codes[f"{c}{CODE_SUFFIX}"] = F.when(text.isNull(), F.lit(n)).otherwise(code).cast("long")
    out = out.withColumns(codes)
    return out.drop(*[f"_code_{k}_{i}" for k in ("value", "rank") for i in range(len(cols))]), sizes


def woe_encode(users: DataFrame, cols: Sequence[str], label: str = "flag",
               split_col: str = "split", train_value: str = "train",
               min_class: int = 100, fold_col: str | None = None) -> DataFrame:
    """Weight of evidence per category, fitted on the train rows and mapped on all
    rows as ``<c>_crossentroy``:

        ln((pos_c / pos) * (neg / neg_c)),   neg_c = rows_c - pos_c

    Only columns whose smallest non-null class in train has more than
    ``min_class`` rows are encoded.  Where the reference gets +-inf (a class
    with no negatives or no positives) the result is NULL.

    ``fold_col``: out-of-fold fitting.  A train row of fold f gets the WOE
    fitted on the train rows of the other folds (no label leak into
    validation); scoring rows get the WOE fitted on all train rows.  The
    per-fold statistics are all-minus-own-fold differences of one aggregate.
    """
    train = users.where(F.col(split_col) == train_value)
    keep = [label] + ([fold_col] if fold_col else [])
    long = _unpivot_values(train, keep, cols)
    by = ["_name", "_val"] + ([fold_col] if fold_col else [])
    per = long.groupBy(*by).agg(F.sum(label).alias("pos_c"), F.count(F.lit(1)).alias("n_c"))
    per_class = per if not fold_col else per.groupBy("_name", "_val").agg(
        F.sum("pos_c").alias("pos_c"), F.sum("n_c").alias("n_c"))
    guard = {r["_name"]: (r["m"], r["k"]) for r in
             per_class.groupBy("_name").agg(F.min("n_c").alias("m"),
                                             F.count(F.lit(1)).alias("k")).collect()}
    passing = [c for c in cols if c in guard and guard[c][0] > min_class]
    if not passing:
        return users

    def woe(pos_c, n_c, pos, neg):
        return F.ln(F.try_divide(pos_c, pos) * F.try_divide(neg, n_c - pos_c))

    pos = train.select(F.sum(label)).scalar()
    neg = train.select(F.count(F.lit(1)) - F.sum(label)).scalar()
    table = per_class.where(F.col("_name").isin(passing)).select(
        "_name", "_val", woe(F.col("pos_c"), F.col("n_c"), pos, neg).alias("_woe"))
    out = users
    for c in passing:
        enc = table.where(F.col("_name") == c).select(F.col("_val").alias(f"_k_{c}"),
                                                      F.col("_woe").alias(f"{c}{WOE_SUFFIX}"))
        enc = _maybe_broadcast(enc, guard[c][1])
        out = (out.join(enc, F.col(c).cast("string") == F.col(f"_k_{c}"), "left")
                  .drop(f"_k_{c}"))
    if not fold_col:
        return out

    # Out of fold: statistics of all train rows minus those of the row's fold.
    folds = [r[0] for r in train.select(fold_col).distinct().collect()]
    fold_tot = (train.groupBy(fold_col)
                .agg(F.sum(label).alias("_fp"), F.count(F.lit(1)).alias("_fn")))
    all_tot = per_class.where(F.col("_name").isin(passing)).withColumn(
        fold_col, F.explode(F.array(*[F.lit(f) for f in folds])))
    excl = (all_tot.join(per.withColumnRenamed("pos_c", "_pf").withColumnRenamed("n_c", "_nf"),
                         ["_name", "_val", fold_col], "left")
                   .join(_maybe_broadcast(fold_tot, len(folds)), fold_col))
    pos_x = pos - F.col("_fp")
    neg_x = neg - (F.col("_fn") - F.col("_fp"))
    excl = excl.select("_name", "_val", fold_col, woe(
        F.col("pos_c") - F.coalesce(F.col("_pf"), F.lit(0)),
        F.col("n_c") - F.coalesce(F.col("_nf"), F.lit(0)), pos_x, neg_x).alias("_woe"))
    is_train = F.col(split_col) == train_value
    for c in passing:
        enc = excl.where(F.col("_name") == c).select(
            F.col("_val").alias(f"_k_{c}"), F.col(fold_col).alias(f"_f_{c}"),
            F.col("_woe").alias(f"_oof_{c}"))
        enc = _maybe_broadcast(enc, guard[c][1] * len(folds))
        cond = ((F.col(c).cast("string") == F.col(f"_k_{c}"))
                & (F.col(fold_col) == F.col(f"_f_{c}")))
        out = (out.join(enc, cond, "left")
                  .withColumn(f"{c}{WOE_SUFFIX}",
                              F.when(is_train, F.col(f"_oof_{c}")).otherwise(F.col(f"{c}{WOE_SUFFIX}")))
                  .drop(f"_k_{c}", f"_f_{c}", f"_oof_{c}"))
    return out


def ordered_target(df: DataFrame, cols: Sequence[str], label: str, train: Column, key: str = "id",
                   seed: int = 999, weight: float = 1.0, out: str = "{}_target",
                   hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Ordered target statistics: the label mean of each category, drawn towards the
    overall mean by ``weight`` rows, added as ``out.format(c)``.

    A train row (``train`` is true) takes the mean of the train rows of its category that
    come before it in a permutation, so no row sees its own label; the order is that of
    ``md5("<key>:<seed>")``.  All other rows take the mean of all train rows of their
    category, and the overall mean for a category that train lacks.  NULL stays NULL.

    The sums run along the permutation per (column, value); values with more than
    ``hot_rows`` rows are cut into segments by the first digits of the checksum.
    ``key`` is unique.
    """
    cols = list(cols)
    rows = df.where(train)
    order = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    long = _unpivot_values(rows.select(F.col(key).alias("_key"), F.col(label).cast("double").alias("_y"),
                                       order.alias("_h"), *cols), ["_key", "_y", "_h"], cols)
    prior = rows.agg(F.avg(F.col(label).cast("double"))).first()[0]
    prior = F.lit(0.0 if prior is None else float(prior))

    def mean(pos, n):
        return (pos + prior * weight) / (n + weight)

    sums = running_sums(long, ["_name", "_val"], F.substring("_h", 1, 3), ["_h", "_key"],
                        {"_pos": F.col("_y"), "_n": F.lit(1).cast("long")}, hot_rows)
    own = sums.groupBy("_key").agg(*[
        F.max(F.when(F.col("_name") == c, mean(F.col("_pos") - F.col("_y"), F.col("_n") - 1))).alias(f"_own_{i}")
        for i, c in enumerate(cols)])
    totals = materialize(long.groupBy("_name", "_val").agg(
        mean(F.sum("_y"), F.count(F.lit(1))).alias("_all")), "target-totals")
    sizes = {r["_name"]: r["count"] for r in totals.groupBy("_name").count().collect()}
    res = df.withColumn("_train", train).join(own, F.col(key) == F.col("_key"), "left").drop("_key")
    for i, c in enumerate(cols):
        table = totals.where(F.col("_name") == c).select(F.col("_val").alias("_k"), "_all")
        value = F.when(F.col(c).isNull(), F.lit(None).cast("double")).when(F.col("_train"), F.col(f"_own_{i}"))
        res = (res.join(_maybe_broadcast(table, sizes.get(c, 0)), F.col(c).cast("string") == F.col("_k"), "left")
               .withColumn(out.format(c), value.otherwise(F.coalesce("_all", prior))).drop("_k", "_all"))
    return res.drop("_train", *[f"_own_{i}" for i in range(len(cols))])


MONEY_STATS = ("_cny_median", "_cny_sum", "pos_cny_median", "pos_cny_sum",
               "neg_cny_median", "neg_cny_sum")


def category_money(users: DataFrame, trd: DataFrame | Facts, cols: Sequence[str], key: str = "id",
                   amt: str = "amt", split_col: str = "split", score_value: str = "score",
                   scoring_copies: int = 1, money_scale: int | None = 2,
                   cardinalities: dict[str, int] | None = None) -> DataFrame:
    """For each category column ``c`` of ``users``: median and sum of the amounts
    of all transactions of customers in that category (all, > 0, < 0), put on
    every customer as ``c_cny_median, c_cny_sum, cpos_cny_median, cpos_cny_sum,
    cneg_cny_median, cneg_cny_sum``.  Missing category or no such transactions
    give NULL.

    ``scoring_copies=2`` counts the scoring customers' transactions twice, as
    the reference does.  Sums come from per-customer partial sums (small);
    medians from one weighted histogram by (column, value, signed bucket).
    """
    cols = list(cols)
    card = cardinalities if cardinalities is not None else category_cardinalities(users, cols)
    n_groups = sum(card.values())
    dims = users.select(key, split_col, *[F.col(c).cast("string").alias(c) for c in cols])

    # Staged facts keep their buckets by customer part by part.
    parts = [t.select(key, nan_to_null(amt).alias("_amt")) for t in parts_of(trd)]
    weight = F.lit(1)
    if scoring_copies != 1:
        weight = F.when(F.col(split_col) == score_value, F.lit(scoring_copies)).otherwise(1)

    # Sums: per-customer partial sums, then per category.
    a = F.col("_amt")
    per_cust = reduce(DataFrame.unionByName, [
        t.groupBy(key).agg(money_sum(a, money_scale).alias("_s"),
                           money_sum(F.when(a > 0, a), money_scale).alias("_sp"),
                           money_sum(F.when(a < 0, a), money_scale).alias("_sn")).join(dims, key)
        .select("_s", "_sp", "_sn", weight.alias("_w"), *cols) for t in parts])
    cust_cat = _unpivot_values(per_cust, ["_s", "_sp", "_sn", "_w"], cols)
    w = F.col("_w")
    sums = cust_cat.groupBy("_name", "_val").agg(
        money_sum(F.col("_s") * w, money_scale).alias("_cny_sum"),
        money_sum(F.col("_sp") * w, money_scale).alias("pos_cny_sum"),
        money_sum(F.col("_sn") * w, money_scale).alias("neg_cny_sum"))
    # A category whose transactions all lack an amount sums to 0 (pandas);
    # the signed sums stay NULL since such a category has no signed rows.
    sums = sums.withColumn("_cny_sum", F.coalesce(F.col("_cny_sum"), F.lit(0.0)))

    # Medians: every transaction once for each category value of its customer, with its
    # weight; the signs come out of the same counts.
    tc = reduce(DataFrame.unionByName, [
        t.where(a.isNotNull()).join(dims, key).select("_amt", weight.alias("_w"), *cols) for t in parts])
    med = signed_medians(_unpivot_values(tc, ["_amt", "_w"], cols), ["_name", "_val"], "_amt", "_w",
                         max_groups=n_groups)
    meds = med.select("_name", "_val", F.col("median_all").alias("_cny_median"),
                      F.col("median_pos").alias("pos_cny_median"), F.col("median_neg").alias("neg_cny_median"))
    table = meds.join(sums, ["_name", "_val"], "full")

    out = users
    for c in cols:
        enc = table.where(F.col("_name") == c).select(
            F.col("_val").alias(f"_k_{c}"), *[F.col(s).alias(f"{c}{s}") for s in MONEY_STATS])
        enc = _maybe_broadcast(enc, card.get(c))
        out = out.join(enc, F.col(c).cast("string") == F.col(f"_k_{c}"), "left").drop(f"_k_{c}")
    return out
