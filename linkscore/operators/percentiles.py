"""Percentiles of groups: exact by distributed counting, or by a sketch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.sources.stored import stored

ACCURACY = 10_000


def same_group(left: DataFrame, right: DataFrame, by: Sequence[str], prefix: str) -> Column:
    """Equality of group columns that may be null; those of ``right`` carry a prefix."""
    return reduce(Column.__and__, (left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in by))


def percentiles(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    cuts: Mapping[str, float],
    sketch: bool = False,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group with ``<column>_<cut>`` for every column and cut: the least value that at
    least this share of the group's values do not exceed.

    A sketch, good to one part in ``accuracy`` of a group's rows, gives values that enclose each
    percentile for sure. With ``sketch`` the sketched value is the result. Else a second pass counts
    the values below each enclosure, and value by value those within it, and the exact value follows
    from running counts over an enclosure: some parts in ``accuracy`` of a group's rows at most, and
    one row for equal values. No group is brought into one task.
    """
    if sketch:
        sketched = df.groupBy(*by).agg(*[F.percentile_approx(c, list(cuts.values()), accuracy).alias(c) for c in columns])
        return sketched.select(*by, *[F.col(c)[k].alias(f"{c}_{n}") for c in columns for k, n in enumerate(cuts)])
    keys = list(by) or ["_all"]
    # Without groups all rows have one key, 0; a literal would turn the join into a cross join.
    rows = df.select(*by, *columns) if by else df.select(F.pmod(F.spark_partition_id(), F.lit(1)).alias("_all"), *columns)
    margin = 2.0 / accuracy
    enclosed = rows.groupBy(*keys).agg(
        *[F.percentile_approx(F.col(c).cast("double"), _around(cuts, margin), accuracy).alias(f"_e_{c}") for c in columns],
        *[F.count(c).alias(f"_n_{c}") for c in columns],
    )
    wide = _refined(rows, enclosed, columns, keys, cuts).drop("_sure")
    return wide if by else wide.drop("_all")


def _around(cuts: Mapping[str, float], margin: float) -> list[float]:
    """Two shares per cut that enclose it."""
    return [e for p in cuts.values() for e in (max(p - margin, 0.0), min(p + margin, 1.0))]


def _refined(
    rows: DataFrame, enclosed: DataFrame, columns: Sequence[str], keys: Sequence[str], cuts: Mapping[str, float]
) -> DataFrame:
    """The exact percentiles of every group, and whether all of them lay in their enclosures.

    ``enclosed`` has per group an array ``_e_<column>`` with two values per cut around the percentile and the
    number of values ``_n_<column>``. One pass sums the values below each enclosure per group, and only
    values within one go on as rows of their own.
    """
    kinds = dict(rows.dtypes)
    names = [(c, n) for c in columns for n in cuts]
    enclosed = enclosed.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    if list(keys) == ["_all"]:
        enclosed = F.broadcast(enclosed)  # one row

    def bounds(column: str, k: int) -> tuple[Column, Column, Column]:
        around = F.col(f"_e_{column}")
        return F.col(column).cast("double"), around[2 * k], around[2 * k + 1]

    def target(column: str, share: float) -> Column:
        return F.greatest(F.ceil(F.lit(share) * F.col(f"_n_{column}")), F.lit(1))

    def entry(number: int, column: str, name: str) -> Column:
        x, low, high = bounds(column, list(cuts).index(name))
        inside = F.struct(F.lit(number).alias("cut"), target(column, cuts[name]).alias("target"), x.alias("value"))
        return F.when((x >= low) & (x <= high), inside)

    # Every row has one entry for all cuts together, which counts what lies below them.
    whole = F.struct(F.lit(-1).alias("cut"), F.lit(0).cast("bigint").alias("target"), F.lit(None).cast("double").alias("value"))
    entries = F.array_compact(F.array(whole, *[entry(k, c, n) for k, (c, n) in enumerate(names)]))
    below = []
    for k, (c, n) in enumerate(names):
        x, low, _ = bounds(c, list(cuts).index(n))
        below.append((x < low).alias(f"_b_{k}"))
    entered = rows.join(enclosed, same_group(rows, enclosed, keys, "_g_")).select(
        *[rows[k] for k in keys], *below, F.explode(entries).alias("e")
    )
    counted = entered.groupBy(*keys, "e.cut", "e.target", "e.value").agg(
        F.count("*").alias("n"),
        *[F.count_if((F.col("e.cut") == -1) & F.col(f"_b_{k}")).alias(f"_b_{k}") for k in range(len(names))],
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    under = [
        F.struct(F.lit(k).alias("cut"), zero.alias("target"), none.alias("value"), F.col(f"_b_{k}").alias("n"))
        for k in range(len(names))
    ]
    own = F.array(F.struct("cut", "target", "value", "n"))
    listed = counted.select(*keys, F.explode(F.when(F.col("cut") == -1, F.array(*under)).otherwise(own)).alias("e"))
    upto = Window.partitionBy(*keys, "e.cut").orderBy("e.value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = listed.select(*keys, "e.*", F.sum("e.n").over(upto).alias("upto"))
    reached = (F.col("upto") >= F.col("target")) & F.col("value").isNotNull()
    # The rank is met by a value of the enclosure, and not before its first one.
    within = reached & (F.col("upto") - F.col("n") < F.col("target"))
    sure = [
        (F.count(F.when(F.col("value").isNotNull() & (F.col("cut") == k), 1)) == 0)
        | F.max(F.when(F.col("cut") == k, within)).eqNullSafe(True)
        for k in range(len(names))
    ]
    return ranked.groupBy(*keys).agg(
        *[
            F.min(F.when(reached & (F.col("cut") == number), F.col("value"))).cast(kinds[c]).alias(f"{c}_{n}")
            for number, (c, n) in enumerate(names)
        ],
        reduce(Column.__and__, sure).alias("_sure"),
    )


#: Size of a stored sketch, and how many times its usual error of a rank is allowed for.
SKETCH_K = 4096
SAFETY = 2.0


def daily_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str], date: str, k: int = SKETCH_K) -> DataFrame:
    """One row per group and date with a mergeable quantile sketch of each column, to be written once a day.

    Values that are null or no number are not in a sketch; without any it is empty.
    """
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    return df.groupBy(*by, date).agg(*[F.kll_sketch_agg_double(known(c), F.lit(k)).alias(c) for c in columns])


def percentiles_of_sketches(
    sketches: DataFrame, rows: DataFrame, columns: Sequence[str], by: Sequence[str], cuts: Mapping[str, float], k: int = SKETCH_K
) -> DataFrame:
    """Exact percentiles of ``rows`` per group, as :func:`percentiles` gives them, with the dates' stored
    sketches in place of its first pass.

    The merged sketches enclose each percentile with room for ``SAFETY`` times their usual error. Should one
    lie outside all the same, the groups concerned are counted anew without sketches. Groups need values
    free of NaN.
    """
    margin = SAFETY * 2.296 / k**0.9021  # fixed values: the sketch's published error of a rank
    ranks = F.array(*[F.lit(x) for x in _around(cuts, margin)])
    merged = sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])
    sizes = {c: F.coalesce(F.kll_sketch_get_n_double(F.col(c)), F.lit(0)) for c in columns}
    enclosed = merged.select(
        *by,
        # An empty sketch has no quantiles to ask for.
        *[F.when(n > 0, F.kll_sketch_get_quantile_double(F.col(c), ranks)).alias(f"_e_{c}") for c, n in sizes.items()],
        *[n.alias(f"_n_{c}") for c, n in sizes.items()],
    )
    found = stored(_refined(rows.select(*by, *columns), enclosed, columns, by, cuts))
    missed = found.where(~F.col("_sure"))
    if missed.isEmpty():
        return found.drop("_sure")
    others = missed.select(*[F.col(c).alias(f"_m_{c}") for c in by])
    again = rows.join(others, same_group(rows, others, by, "_m_"), "left_semi")
    return found.where("_sure").drop("_sure").unionByName(percentiles(again, columns, by, cuts))
