"""Scaling of features to 0..100 and the scores of feature groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions.columns import clamp, weighted_mean
from linkscore.operators.percentiles import ACCURACY, percentiles, percentiles_of_sketches, same_group

CUTS = {"low": 0.01, "mid": 0.5, "high": 0.99}


def percentile_by_group(
    df: DataFrame, features: Sequence[str], by: Sequence[str], sketch: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """p1, p50 and p99 of every feature per group, exact or sketched."""
    return percentiles(df, features, by, CUTS, sketch, accuracy)


def piecewise(x: Column, low: Column, mid: Column, high: Column, middle: float) -> Column:
    """0 at ``low``, ``middle`` at ``mid``, 100 at ``high``, straight in between; null without width."""
    below = (x - low) * F.try_divide(F.lit(float(middle)), mid - low)
    above = (x - mid) * F.try_divide(F.lit(100.0 - middle), high - mid) + F.lit(float(middle))
    return F.when(x <= mid, below).otherwise(above)


def _scaled(spec: P.ScaleSpec) -> Column:
    f = spec.feature
    x = F.col(f).cast("double")
    if spec.how == "raw":
        x = x * F.lit(spec.factor)
        return clamp(F.round(F.lit(100.0) - x, 2)) if spec.reverse else F.round(x, 2)
    mid = F.col(f"{f}_mid").cast("double")
    if spec.how == "shift":
        moved = F.lit(spec.middle) + mid - x if spec.reverse else x + (F.lit(spec.middle) - mid)
        return clamp(F.round(moved, 2))
    low, high = F.col(f"{f}_low").cast("double"), F.col(f"{f}_high").cast("double")
    value = F.round(piecewise(x, low, mid, high, spec.middle), 2)
    return clamp(F.lit(100.0) - value if spec.reverse else value)


def threshold_table(spark, feature: str, thresholds: Mapping[str, tuple[float, float, float]]) -> DataFrame:
    return spark.createDataFrame(
        [(code, *values) for code, values in thresholds.items()],
        f"pplan_cd string, {feature}_low double, {feature}_mid double, {feature}_high double",
    )


def scale(
    df: DataFrame,
    specs: Sequence[P.ScaleSpec],
    history: DataFrame | None = None,
    sketch: bool = False,
    accuracy: int = ACCURACY,
    history_sketches: DataFrame | None = None,
) -> DataFrame:
    """Add ``scaled_<feature>`` for every spec.

    Percentiles come from ``history`` when given, else from ``df`` itself; the median of a shift
    always from ``df``. They are exact, or with ``sketch`` good to one part in ``accuracy`` of a
    group's rows. With ``history_sketches``, the history's daily sketches of all percentile features by the
    grouping columns, those replace the first pass over the history. Specs with the same grouping share their passes over ``df``, so pass it stored. The
    table of percentiles is joined as its size makes best; no group is ever brought into one task, as
    a window per feature would do.
    """
    groups: dict[tuple[bool, tuple[str, ...]], list[str]] = {}
    for spec in specs:
        if spec.how in ("percentile", "shift"):
            past = history is not None and spec.how == "percentile"
            groups.setdefault((past, tuple(spec.by)), []).append(spec.feature)
    result = df
    for (past, by), features in groups.items():
        if past and history_sketches is not None:
            cuts = percentiles_of_sketches(history_sketches, history, features, by, CUTS)
        else:
            cuts = percentile_by_group(history if past else df, features, by, sketch, accuracy)
        cuts = cuts.withColumnsRenamed({c: f"_by_{c}" for c in by})
        result = result.join(cuts, same_group(result, cuts, by, "_by_"), "left").drop(*[f"_by_{c}" for c in by])
    for spec in specs:
        if spec.how == "manual":
            # A constant of one row per plan, so it may be broadcast.
            table = threshold_table(df.sparkSession, spec.feature, spec.thresholds)
            result = result.join(F.broadcast(table), "pplan_cd", "left")
    helpers = [f"{s.feature}_{n}" for s in specs if s.how != "raw" for n in ("low", "mid", "high")]
    return result.withColumns({f"scaled_{s.feature}": _scaled(s) for s in specs}).drop(*helpers)


def group_scores(df: DataFrame, weights: Mapping[str, Mapping[str, float]] = P.GROUP_WEIGHTS) -> DataFrame:
    """Scores of the five feature groups and their mean, from scaled features."""
    prepared = df.fillna({"scaled_avg_memory_free": 50.0}).withColumns(
        {
            "scaled_nr_usage_percentage": F.col("scaled_nr_usage_percentage") / 2,
            "scaled_nr_uptime": F.col("scaled_nr_uptime") / 2,
        }
    )
    scored = prepared.withColumns({name: F.round(weighted_mean(w), 2) for name, w in weights.items()})
    return scored.withColumn("final_score", F.round(weighted_mean(P.FINAL_WEIGHTS), 2))
