"""Sums over consecutive rows of a key, safe for a key that holds a large share of all rows.

A plain ``lag`` sorts every row of a key in one task. Here the rows of every key are cut into *slices*
that follow each other in the order and have a window each: an hour of a time, a fixed span of a
number, a prefix of a text. Rows that share one value of an order column for no good reason (null, or
the counters' sentinel) are cut by the next order column, in the end by the leading bits of the
tie-break. A slice is reduced to its sums and its first and last values, and the steps across slice
borders are added on those few rows. There is one plan for all keys and sizes, and it reads its input
once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkscore.params import COUNTER_SENTINEL, SLICE_SPAN, SLICE_TEXT, TIE_BITS

SLICE = "_slice"

Value = Callable[[str], Column]
Step = Callable[[Value, Value], Column]


def slice_of(df: DataFrame, order: Sequence[str]) -> Column:
    """The slice of a row: never null, and growing with the order."""
    kinds = dict(df.dtypes)
    parts, lone = [], F.lit(True)
    for k, c in enumerate(order):
        x, kind = F.col(c), kinds[c]
        number = kind in ("bigint", "int", "smallint", "tinyint", "double", "float") or kind.startswith("decimal")
        if number and 0 < k == len(order) - 1:  # the tie-break, a hash
            part = F.shiftright(x.cast("bigint"), 64 - TIE_BITS)
        elif number:
            part = F.floor(x / F.lit(SLICE_SPAN)).cast("bigint")
        elif kind.startswith("timestamp"):
            part = F.date_trunc("hour", x)
        elif kind == "string":
            part = F.substring(x, 1, SLICE_TEXT)
        else:
            part = x
        parts.append(F.when(lone, part).alias(f"s{k}"))
        lone = lone & (x.isNull() | (x == F.lit(COUNTER_SENTINEL)) if number else x.isNull())
    return F.struct(*parts)


def sum_steps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    groups: Mapping[str, tuple[Sequence[str], Column | None]],
    steps: Mapping[str, tuple[str, Step]],
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with the sum of each step over its rows in order.

    A group ``name: (columns, valid)`` is a sequence of rows: those that meet ``valid``, or all.
    A step ``name: (group, f)`` sums ``f(current, previous)`` over it, where both arguments give a
    column's value by name and the previous value of the first row is null. It is null for a key
    without a valid row. ``sums`` adds plain sums over all rows. Groups share one sort, which
    equals one filter and ``lag`` per group.
    """
    sums = sums or {}
    valid = {g: F.lit(True) if v is None else F.coalesce(v, F.lit(False)) for g, (_, v) in groups.items()}
    columns = {g: list(cols) for g, (cols, _) in groups.items()}
    per_slice = Window.partitionBy(*keys, SLICE)
    here = per_slice.orderBy(*order)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def row(g: str) -> Column:
        values = F.struct(*columns[g])
        return values if groups[g][1] is None else F.when(valid[g], values)

    windowed = df.withColumn(SLICE, slice_of(df, order)).withColumns(
        {
            **{
                f"_prev_{g}": F.lag(row(g)).over(here)
                if groups[g][1] is None
                else F.last(row(g), ignorenulls=True).over(before)
                for g in groups
            },
            **{f"_last_{g}": F.last(row(g), ignorenulls=True).over(whole) for g in groups},
        }
    )

    inside = [
        F.sum(F.when(valid[g] & F.col(f"_prev_{g}").isNotNull(), f(F.col, lambda c, g=g: F.col(f"_prev_{g}")[c]))).alias(
            f"_in_{name}"
        )
        for name, (g, f) in steps.items()
    ]
    ends = []
    for g in groups:
        first = valid[g] & F.col(f"_prev_{g}").isNull()
        ends.append(F.max(F.when(valid[g], 1)).alias(f"_has_{g}"))
        # One row of the slice is first, and all rows carry the same last values: max picks them.
        ends += [F.max(F.when(first, F.col(c))).alias(f"_first_{g}_{c}") for c in columns[g]]
        ends += [F.max(F.col(f"_last_{g}")[c]).alias(f"_end_{g}_{c}") for c in columns[g]]
    slices = windowed.groupBy(*keys, SLICE).agg(*inside, *ends, *[F.sum(e).alias(n) for n, e in sums.items()])

    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    bordered = slices.withColumns(
        {
            f"_carry_{g}": F.last(
                F.when(F.col(f"_has_{g}") == 1, F.struct(*[F.col(f"_end_{g}_{c}").alias(c) for c in columns[g]])),
                ignorenulls=True,
            ).over(earlier)
            for g in groups
        }
    )

    def total(name: str, g: str, f: Step) -> Column:
        at_border = f(lambda c: F.col(f"_first_{g}_{c}"), lambda c: F.col(f"_carry_{g}")[c])
        return F.sum(F.when(F.col(f"_has_{g}") == 1, F.coalesce(f"_in_{name}", F.lit(0)) + at_border)).alias(name)

    return bordered.groupBy(*keys).agg(
        *[total(name, g, f) for name, (g, f) in steps.items()], *[F.sum(n).alias(n) for n in sums]
    )


def running_steps(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    step: Callable[[Column, Column], Column],
    step_name: str,
    running_name: str,
    period: Column | None = None,
) -> DataFrame:
    """Every row with its step against the previous row and the running sum of the steps.

    Each row needs its key's history, so the sums of the slices are added up per key and joined back.
    Rows and slices meet on a struct of key and slice, which is never null and by which the rows
    already lie, so they do not move again. ``period`` replaces the slice; it must grow with the order.
    """
    place, first_row = "_place", F.struct(*order)
    rows = df.select(*keys, *order, column).withColumn(SLICE, slice_of(df, order) if period is None else period)
    rows = rows.withColumn(place, F.struct(*keys, SLICE))
    in_slice = Window.partitionBy(place).orderBy(*order)
    rows = rows.withColumn("_prev", F.lag(F.struct(column)).over(in_slice))
    rows = rows.withColumn(
        "_inside", F.when(F.col("_prev").isNotNull(), step(F.col(column), F.col("_prev")[column])).otherwise(0)
    )
    rows = rows.withColumn("_so_far", F.sum("_inside").over(in_slice))

    earlier = Window.partitionBy(*[F.col(f"{place}.{k}") for k in keys]).orderBy(f"{place}.{SLICE}")
    slices = (
        rows.groupBy(place)
        .agg(
            F.sum("_inside").alias("_total"),
            # Structs, so that a null value of the first or last row is kept.
            F.min(F.struct(first_row.alias("at"), F.col(column).alias("value"))).alias("_first"),
            F.max(F.struct(first_row.alias("at"), F.col(column).alias("value"))).alias("_last"),
        )
        .withColumn("_carry", F.lag("_last").over(earlier))
        .withColumn("_entry", step(F.col("_first.value"), F.col("_carry.value")))
        .withColumn("_upto", F.sum(F.col("_total") + F.col("_entry")).over(earlier))
        .select(F.col(place).alias("_at"), "_entry", (F.col("_upto") - F.col("_total")).alias("_offset"))
    )
    joined = rows.join(slices, F.col(place) == F.col("_at"))
    own = F.when(F.col("_prev").isNull(), F.col("_entry")).otherwise(F.col("_inside"))
    return joined.select(
        *keys, *order, column, own.alias(step_name), (F.col("_so_far") + F.col("_offset")).alias(running_name)
    )
