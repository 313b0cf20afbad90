"""Feature selection against null importances."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.operators.median import BROADCAST_MAX_ROWS

# The reference keeps features whose gain score reaches 40, and
# compares null importances with the 25th percentile of the actual ones.
KEEP_AT = 40.0
PERCENTILE = 0.25


def importance_scores(null_imp: DataFrame, actual_imp: DataFrame,
                      measures: dict[str, str] | None = None,
                      percentile: float = PERCENTILE) -> DataFrame:
    """Per feature of ``actual_imp``:
    ``100 * #(null importances < pct-th percentile of actual) / #null rows``
    for each measure (``gain_score`` from ``importance_gain``, ``split_score``
    from ``importance_split``).  A feature without null rows gets NULL.

    The per-feature thresholds are one row per feature (as many as model
    columns); the null table streams past them in one pass with partial
    aggregation, so a feature with very many null rows is not a hot task.
    """
    measures = measures or {"split_score": "importance_split", "gain_score": "importance_gain"}
    thr = actual_imp.where(F.col("feature").isNotNull()).groupBy("feature").agg(
        *[F.percentile(F.col(src).cast("double"), percentile).alias(f"_t_{out}")
          for out, src in measures.items()])
    # One row per model feature: a small table, broadcast after its size is checked.
    n_features = thr.count()
    if n_features <= BROADCAST_MAX_ROWS:
        thr = F.broadcast(thr)
    rows = null_imp.select("feature", *measures.values())
    j = rows.join(thr, "feature")

    def hits(out: str, src: str):
        below = F.coalesce(F.col(src).cast("double") < F.col(f"_t_{out}"), F.lit(False))
        return F.sum(below.cast("long")).alias(f"_h_{out}")

    agg = j.groupBy("feature").agg(F.count(F.lit(1)).alias("_rows"),
                                   *[hits(o, s) for o, s in measures.items()])
    # 100 * hits / rows, as the reference computes it; NULL for a feature
    # that has no null-importance rows.
    return thr.select("feature").join(agg, "feature", "left").select(
        "feature", *[F.try_divide(F.lit(100.0) * F.col(f"_h_{o}"), F.col("_rows")).alias(o)
                     for o in measures])


def select_features(scores: DataFrame, keep_at: float = KEEP_AT, by: str = "gain_score",
                    categorical: Iterable[str] = ()) -> DataFrame:
    """Features with ``by >= keep_at`` and whether each is one of ``categorical``."""
    cats = list(categorical)
    return (scores.where(F.col(by) >= keep_at)
                  .select("feature", by,
                          (F.col("feature").isin(cats) if cats else F.lit(False)).alias("is_categorical")))
