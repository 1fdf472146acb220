"""Cumulative counters and state changes of a device."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.operators.ordered import Step, running_steps, sum_steps

DEVICE = ("sn",)
BY_UPTIME = ("service_uptime", "event_id")
BY_TIME = ("ts", "event_id")
FAILURE_COUNTERS = (
    "lte_rach_failure_count",
    "lte_handover_failure_count",
    "nr_scg_change_failure_count",
    "rrc_connect_failure_count",
)
FAILURE_PAIRS = {
    "lte_rach_failure_ratio": ("lte_rach_failure_count", "lte_rach_attempt_count"),
    "lte_handover_failure_ratio": ("lte_handover_failure_count", "lte_handover_attempt_count"),
    "nr_scg_change_failure_ratio": ("nr_scg_change_failure_count", "nr_scg_change_count"),
}


def increment(value: Column, previous: Column) -> Column:
    """What a cumulative counter added: the difference, or the whole value after a reset or gap."""
    return F.when(previous <= value, value - previous).otherwise(F.coalesce(value, F.lit(0)))


def changed(value: Column, previous: Column) -> Column:
    """1 when both values are known and differ, else 0."""
    return F.when(value != previous, 1).otherwise(0)


def known_service_time() -> Column:
    return (F.col("service_downtime") != P.COUNTER_SENTINEL) & (F.col("service_uptime") != P.COUNTER_SENTINEL)


def attached() -> Column:
    network = F.col("current_network")
    return network.isNotNull() & ~network.isin(*P.INVALID_NETWORKS)


def increments_of(counters: Sequence[str], group: str) -> dict[str, tuple[str, Step]]:
    """Steps that sum the increments of each counter."""
    return {f"sum_{c}": (group, lambda now, was, c=c: increment(now(c), was(c))) for c in counters}


def changes_of(column: str, group: str) -> tuple[str, Step]:
    """A step that counts the changes of a column."""
    return group, lambda now, was: changed(now(column), was(column))


def _used(df: DataFrame, keys, order, cols) -> DataFrame:
    return df.select(*dict.fromkeys([*keys, *order, *cols]))


def counter_increments(
    df: DataFrame,
    counters: Sequence[str] = FAILURE_COUNTERS,
    keys: Sequence[str] = DEVICE,
    order: Sequence[str] = BY_UPTIME,
) -> DataFrame:
    """One row per key with the summed increments of each counter."""
    groups = {"rows": (counters, None)}
    return sum_steps(_used(df, keys, order, counters), keys, order, groups, increments_of(counters, "rows"))


def service_time(
    df: DataFrame,
    counters: Sequence[str] = FAILURE_COUNTERS,
    keys: Sequence[str] = DEVICE,
    order: Sequence[str] = BY_UPTIME,
) -> DataFrame:
    """Increments plus up/downtime change counts and the downtime share, sentinel rows left out."""
    cols = [*counters, "service_downtime", "service_uptime"]
    steps = {
        **increments_of(counters, "rows"),
        "downtime_changes": changes_of("service_downtime", "rows"),
        "uptime_changes": changes_of("service_uptime", "rows"),
    }
    known = _used(df.where(known_service_time()), keys, order, cols)
    sums = sum_steps(known, keys, order, {"rows": (cols, None)}, steps)
    return sums.withColumn("downtime_share", downtime_share())


def downtime_share() -> Column:
    down, up = F.col("downtime_changes"), F.col("uptime_changes")
    return F.try_divide(F.lit(100.0) * down, (down + up).cast("double"))


def _count_steps(df: DataFrame, column: str, step: Step, name: str, keys, order) -> DataFrame:
    rows = _used(df, keys, order, [column])
    return sum_steps(rows, keys, order, {"rows": ([column], None)}, {name: ("rows", step)})


def uptime_stalls(df: DataFrame, keys=DEVICE, order=BY_UPTIME) -> DataFrame:
    """How often the uptime repeats the previous uptime of the device."""
    column = "service_uptime"
    stalled = lambda now, was: F.when(now(column) == was(column), 1).otherwise(0)
    return _count_steps(df.where(known_service_time()), column, stalled, "uptime_stalls", keys, order)


def network_switches(df: DataFrame, keys=DEVICE, order=BY_TIME) -> DataFrame:
    """Changes of the serving network per key, over attached heartbeats only."""
    column = "current_network"
    _, switched = changes_of(column, "rows")
    return _count_steps(df.where(attached()), column, switched, "network_switches", keys, order)


def failure_ratios(df: DataFrame, keys=DEVICE, order=BY_TIME) -> DataFrame:
    """Summed failures over summed attempts for each counter pair; null without attempts."""
    counters = [c for pair in FAILURE_PAIRS.values() for c in pair]
    sums = counter_increments(df, counters, keys, order)
    return sums.withColumns(failure_ratio_columns())


def failure_ratio_columns() -> dict[str, Column]:
    return {
        name: F.try_divide(F.col(f"sum_{failed}").cast("double"), F.col(f"sum_{tried}").cast("double"))
        for name, (failed, tried) in FAILURE_PAIRS.items()
    }


def counter_resets(
    df: DataFrame,
    counter: str = "lte_handover_attempt_count",
    keys: Sequence[str] = DEVICE,
    order: Sequence[str] = BY_TIME,
    top: int | None = None,
) -> DataFrame:
    """How often a counter fell below its previous non-zero value; the ``top`` devices first."""
    fell = lambda now, was: F.when(now(counter) < was(counter), 1).otherwise(0)
    resets = _count_steps(df.where(F.col(counter) != 0), counter, fell, "resets", keys, order)
    return resets if top is None else resets.orderBy(F.desc("resets"), *keys).limit(top)


def running_changes(
    df: DataFrame,
    column: str = "service_downtime",
    keys: Sequence[str] = DEVICE,
    order: Sequence[str] = BY_TIME,
    period: Column | None = None,
) -> DataFrame:
    """Every heartbeat with its change flag and the running count of changes of its device."""
    return running_steps(df, keys, order, column, changed, "change", "changes_so_far", period)


def device_timeline(df: DataFrame, columns: Sequence[str], sn: str | None = None, order=BY_TIME) -> DataFrame:
    """Heartbeats in device and time order, of one device when ``sn`` is given."""
    rows = df if sn is None else df.where(F.col("sn") == sn)
    return rows.select("sn", *order, *columns).orderBy("sn", *order)
