"""Publishing tables together: what a reader finds after a run that ends, and after one that does not."""

import pathlib
import threading

import pytest
from conftest import rows

from linkscore.plans import jobs as J
from linkscore.plans.replays import _Stopped
from linkscore.sources.manifests import Publication, Slot
from linkscore.sources.sinks import write_files

DATES = ["2024-01-01", "2024-01-02", "2024-01-03"]


def slot(base, required=()):
    return Slot(str(base), "job", "2024-01-01", {k: f"{base}/{k}/2024-01-01" for k in ("a", "b")}, required)


def publish(spark, at, n, kind=Publication):
    with kind(spark, at) as run:
        stored = run.write(spark.range(n).toDF("x"), "a", lambda df, path: write_files(df, path, 3))
        run.write(stored.selectExpr("x * 2 AS y", "CAST(NULL AS string) AS z"), "b")


def left(base):
    return sorted(p.name for p in pathlib.Path(base).rglob("*") if p.is_dir() and len(p.name) == 32)


def test_a_published_slot_is_complete_and_read_by_its_files(spark, tmp_path):
    at = slot(tmp_path)
    assert not at.complete(spark) and at.manifest(spark) is None
    with pytest.raises(FileNotFoundError):
        at.read(spark, "a")
    publish(spark, at, 7)
    found = at.manifest(spark)
    assert at.complete(spark) and {k: t["rows"] for k, t in found["tables"].items()} == {"a": 7, "b": 7}
    assert len(found["tables"]["a"]["files"]) == 3 and not left(tmp_path)
    assert rows(at.read(spark, "a")) == [(x,) for x in range(7)] and at.read(spark, "b").dtypes == [("y", "bigint"), ("z", "string")]
    # A file that no manifest lists is not read, and makes the slot incomplete; a later run replaces it.
    stray = pathlib.Path(at.places["a"]) / "part-stray.parquet"
    stray.write_bytes(next(pathlib.Path(at.places["a"]).glob("*.parquet")).read_bytes())
    assert at.read(spark, "a").count() == 7 and not at.complete(spark)
    publish(spark, at, 4)
    assert at.complete(spark) and spark.read.parquet(at.places["a"]).count() == 4
    assert at.manifest(spark)["attempt"] != found["attempt"]


def test_a_run_that_fails_while_it_stages_changes_nothing(spark, tmp_path):
    at = slot(tmp_path)
    publish(spark, at, 5)
    before = at.manifest(spark)
    with pytest.raises(RuntimeError, match="stopped"), Publication(spark, at) as run:
        run.write(spark.range(1).toDF("x"), "a")
        raise RuntimeError("stopped")
    assert at.manifest(spark) == before and at.complete(spark) and not left(tmp_path)


def test_a_run_that_stops_between_its_tables_leaves_no_complete_slot(spark, tmp_path):
    at = slot(tmp_path)
    publish(spark, at, 5)
    with pytest.raises(RuntimeError, match="stopped"):
        publish(spark, at, 9, _Stopped)
    # The first table has moved, the second is the old one; both are readable, but nothing says complete.
    assert spark.read.parquet(at.places["a"]).count() == 9 and spark.read.parquet(at.places["b"]).count() == 5
    assert not at.complete(spark)
    publish(spark, at, 9)
    assert at.complete(spark) and at.read(spark, "b").count() == 9


def test_only_required_tables_must_be_there(spark, tmp_path):
    at = slot(tmp_path, ("b",))
    with Publication(spark, at) as run:
        run.write(spark.range(0).toDF("x"), "b")
    assert at.complete(spark) and at.read(spark, "b").columns == ["x"] and at.read(spark, "b").count() == 0
    with pytest.raises(ValueError, match="has not written"), Publication(spark, at) as run:
        run.write(spark.range(1).toDF("x"), "a")
    with pytest.raises(ValueError, match="has no table"), Publication(spark, at) as run:
        run.write(spark.range(1).toDF("x"), "c")
    pathlib.Path(at.manifest_path).unlink()
    assert not at.complete(spark)


def test_backfill_runs_dates_side_by_side_retries_and_keeps_their_order(spark, tmp_path):
    import datetime as dt

    seen, both = {}, threading.Barrier(2, timeout=60)

    def job(date):
        seen[date.day] = seen.get(date.day, 0) + 1
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == f"backfill-{date}"
        if date.day in (1, 2) and seen[date.day] == 1:
            both.wait()  # two dates run at the same time
        if date.day == 2 or date.day == 3 and seen[3] < 3:
            raise RuntimeError(f"day {date.day}")
        spark.range(1).write.parquet(f"{tmp_path}/{date}")

    report = J.backfill(spark, job, lambda d: [f"{tmp_path}/{d}"], dt.date(2024, 1, 4), 4, workers=2, retries=2)
    got = [(r.date.day, r.status, r.error) for r in report.collect()]
    assert got == [(1, "written", None), (2, "failed", "RuntimeError: day 2"), (3, "written", None), (4, "written", None)]
    assert seen == {1: 1, 2: 3, 3: 3, 4: 1}
    again = J.backfill(spark, job, lambda d: [f"{tmp_path}/{d}"], dt.date(2024, 1, 4), 4)
    assert [r.status for r in again.collect()] == ["present", "failed", "present", "present"]
