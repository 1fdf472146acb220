"""What the physical plans must and must not contain."""

import datetime as dt
import re

import pytest
from conftest import SF

from linkscore.operators import capacity as K
from linkscore.operators import counters as C
from linkscore.plans.queries import QUERIES, _lines
from linkscore.sources import heartbeat as H
from linkscore.sources import readers as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "operator", [C.counter_increments, C.service_time, C.uptime_stalls, C.network_switches, C.failure_ratios, C.counter_resets]
)
def test_ordered_operators_read_once(inputs, operator):
    text = initial(operator(inputs.hb))
    assert text.count("FileScan") == 1 and "rangepartitioning" not in text and "Broadcast" not in text
    # One shuffle of the rows; the second one moves a row per device and slice.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


def test_running_changes_moves_its_rows_once(inputs):
    text = initial(C.running_changes(inputs.hb_timed))
    # Two evaluations of the rows, equal and so reused when run; slices move twice.
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 4


def test_overall_score_has_plain_joins(spark):
    text = initial(QUERIES["overall_score"](spark, SF))
    # The lines take three scans; throughput and capacity start from them.
    assert text.count("FullOuter") == 2 and len(re.findall(r"Exchange hashpartitioning", text)) <= 10
    assert len(re.findall(r"FileScan parquet .*customer", text)) <= 6


def test_model_distribution_places_records_once(inputs):
    assert len(re.findall(r"Exchange hashpartitioning", initial(K.capacity_by_model(inputs.hb)))) <= 4


def test_capacity_joins_after_aggregating(spark, inputs):
    text = plan(K.link_capacity(inputs.hb, _lines(inputs)))
    scan = text.index("events.parquet")
    above = text[:scan]
    # Nothing but projections, filters and the partial aggregate between the scan and its shuffle.
    assert above.rindex("Exchange hashpartitioning(sn") > above.rindex("Join")


def test_scans_read_only_used_columns(inputs):
    text = plan(C.counter_increments(inputs.hb))
    assert all(c not in re.findall(r"ReadSchema: (\S+)", text)[0] for c in ("props", "value"))


def test_filters_reach_the_scan(spark, inputs, tmp_path):
    base = str(tmp_path / "passive")
    inputs.passive.write.partitionBy("datadate").parquet(base)
    stored = spark.read.parquet(base)
    text = plan(R.multi_date_union(stored, "datadate", [dt.date(2024, 1, 5)]))
    assert "PartitionFilters: [isnotnull(datadate" in text or "PartitionFilters: [(datadate" in text
    hb = str(tmp_path / "hb")
    inputs.hb.write.parquet(hb)
    text = plan(K.link_capacity_strict(spark.read.parquet(hb)))
    assert "GreaterThanOrEqual(lte_snr,-10.0)" in text and "service_uptime" not in re.findall(r"ReadSchema: (\S+)", text)[0]


def test_ingest_shuffles_a_digest_for_the_unused_fields(inputs):
    text = plan(H.ingest_heartbeats(inputs.raw))
    above = text[: text.index("Exchange hashpartitioning")]
    assert "GPSAltitude" not in above and "_digest" in above


def _read(df):
    """Rows and files that the scans of an executed plan read, by scan."""
    df.collect()
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            found.append((node.metrics().apply("numOutputRows").value(), node.metrics().apply("numFiles").value()))
        nodes += [node.children().apply(k) for k in range(node.children().size())]
    return found


def test_dates_found_at_run_time_prune_the_scan(spark, tmp_path):
    base, days = str(tmp_path / "days"), str(tmp_path / "wanted")
    dated = spark.range(300).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 30 AS INT)) AS date")
    dated.repartition(1).write.partitionBy("date").parquet(base)
    dated.where("id IN (4, 9, 34, 200)").select("date").write.parquet(days)
    first, last = dt.date(2024, 1, 1), dt.date(2024, 1, 15)
    df = R.rows_of_dates(spark.read.parquet(base), "date", spark.read.parquet(days), first, last)
    assert "dynamicpruning" in plan(df)
    # Dates 5 and 10 of the window; the third, 21, lies outside.
    assert (20, 2) in _read(df) and df.count() == 20
    newest = R.latest_available(spark.read.parquet(base), "date", last)
    assert "dynamicpruning" in plan(newest) and (10, 1) in _read(newest)
