"""Readers and sinks on temporary folders."""

import datetime as dt
import gzip
import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from linkscore.sources import heartbeat as H
from linkscore.sources import readers as R
from linkscore.sources import sinks as W
from linkscore.sources import stored as D

DAY = dt.date(2024, 1, 10)


def test_day_and_hour_partitions(spark, tmp_path):
    base = str(tmp_path / "raw")
    spark.range(48).select(
        "id", (F.lit(20240109) + (F.col("id") % 2)).alias("date"), F.format_string("%02d", F.col("id") % 12).alias("hour")
    ).write.partitionBy("date", "hour").parquet(base)
    day = R.read_day(spark, base, DAY)
    assert day.count() == 24 and {r.date for r in day.select("date").distinct().collect()} == {20240110}
    assert {r.id % 12 for r in R.read_day(spark, base, DAY, 5).collect()} == {5}
    with pytest.raises(AnalysisException):
        R.read_day(spark, base, dt.date(2024, 1, 1))


def test_csv_forms(spark, tmp_path):
    for name, text in {"a/x.csv": "k,v\n1,one\n2,\n", "a/b/y.csv": "k,v\n3,three\n", "z/w.csv": "k,v\n4,four\n"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    with gzip.open(tmp_path / "result.csv.gz", "wt") as f:
        f.write("imsi,percentage\n1,0.5\n2,x\n")
    plain = R.read_csv(spark, str(tmp_path / "a/x.csv"))
    assert plain.dtypes == [("k", "string"), ("v", "string")]
    assert rows(plain) == [("1", "one"), ("2", None)]
    assert rows(R.read_csv_tree(spark, str(tmp_path / "a"))) == [("1", "one"), ("2", None), ("3", "three")]
    both = R.read_csv(spark, [str(tmp_path / "a/x.csv"), str(tmp_path / "z")])
    assert both.count() == 3
    packed = H.cast_columns(R.read_csv(spark, str(tmp_path / "result.csv.gz")), {"percentage": "double"})
    assert rows(packed) == [("1", 0.5), ("2", None)]
    typed = R.read_csv(spark, str(tmp_path / "a/x.csv"), "k int, v string")
    assert rows(typed) == [(1, "one"), (2, None)]


def test_json_tree(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/one.json").write_text(json.dumps({"imei": "1", "snr": "3"}) + "\n")
    (tmp_path / "d/e/two.json").write_text(json.dumps({"imei": "2", "other": 1}) + "\n")
    assert rows(R.read_json_tree(spark, str(tmp_path / "d"), "imei string, snr string")) == [("1", "3"), ("2", None)]


def test_optional_input_only_forgives_a_missing_path(spark, tmp_path):
    empty = R.optional_input(spark, lambda: spark.read.parquet(str(tmp_path / "none")), "a int, b string")
    assert empty.dtypes == [("a", "int"), ("b", "string")] and empty.count() == 0
    with pytest.raises(AnalysisException):
        R.optional_input(spark, lambda: spark.range(1).select("no_such_column"), "a int")


def test_newest_folder_and_read_dates(spark, tmp_path):
    base = str(tmp_path)
    for n, day in enumerate((DAY - dt.timedelta(days=2), DAY - dt.timedelta(days=4))):
        spark.range(n + 1).write.parquet(f"{base}/{day.isoformat()}")
    assert R.newest_folder(spark.read.parquet, base, DAY).count() == 1
    with pytest.raises(FileNotFoundError):
        R.newest_folder(spark.read.parquet, base, DAY - dt.timedelta(days=10))
    assert R.read_dates(spark, base, [DAY - dt.timedelta(days=d) for d in range(6)]).count() == 3
    with pytest.raises(FileNotFoundError, match="2 dates"):
        R.read_dates(spark, base, [DAY, DAY - dt.timedelta(days=1)])


def test_latest_available(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-08')) as d")
    assert [r.d for r in R.latest_available(df, "d", DAY).collect()] == [dt.date(2024, 1, 8)]
    assert R.latest_available(df, "d", DAY + dt.timedelta(days=1)).count() == 0


def test_extract_is_filtered_in_the_database():
    text = R.extract_query("tests", DAY)
    assert "> date '2024-01-10'" in text and "interval '1 days'" in text and "status <> 'FAILED'" in text


def test_extract_slots_cover_the_day_once():
    slots = R.extract_slots(DAY, 6)
    assert len(slots) == 6
    assert "> timestamp '2024-01-10 00:00:00'" in slots[0] and "<= timestamp '2024-01-11 00:00:00'" in slots[-1]
    assert all(a.split("<= ")[1] in b for a, b in zip(slots, slots[1:]))


def test_landed_extract_bounds(spark):
    data = [
        (1, "Jan 10, 2024 12:00:00 AM", "DONE", "5.5"),  # the start itself is outside
        (2, "Jan 10, 2024 12:00:01 AM", "DONE", "x"),
        (3, "Jan 11, 2024 12:00:00 AM", "DONE", "7"),  # the end is inside
        (4, "Jan 10, 2024 01:00:00 PM", "FAILED", "8"),
        (5, "Jan 11, 2024 12:00:01 AM", "DONE", "9"),
    ]
    df = spark.createDataFrame(data, "id int, created string, status string, latency string")
    got = R.landed_extract(df, DAY).select("id", "latency")
    assert rows(got) == [(2, None), (3, 7.0)]


def test_ingest(spark):
    raw = spark.createDataFrame(
        [
            ("6223-AB12_MAC", 1704067200123, '{"SNR":"12.5","5GSNR":-3,"5GEARFCN_DL":"","ServiceUptime":"1000"}'),
            ("6223-AB12_MAC", 1704067200123, '{"SNR":"12.5","5GSNR":-3,"5GEARFCN_DL":"","ServiceUptime":"1000"}'),
            ("6223-AB12", 5, "{bad"),
            ("nothing", 6, '{"SNR":"n/a","CQI":99999999999,"IMSI":"7"}'),
            ("6223-CD_MAC", 7, None),
        ],
        "rowkey string, ts bigint, payload string",
    )
    got = {r.ms: r for r in H.ingest_heartbeats(raw).withColumn("ms", F.unix_millis("ts")).collect()}
    assert sorted(got) == [5, 6, 1704067200123]
    first = got[1704067200123]
    assert (first.sn, first.lte_snr, first.nr_snr, first.nr_earfcn_dl, first.service_uptime) == ("AB12", 12.5, -3.0, None, 1000)
    assert got[5].sn == "AB12" and got[5].lte_snr is None
    assert got[6].sn is None and got[6].lte_snr is None and got[6].cqi is None and got[6].imsi == "7"


def test_only_copies_of_a_whole_row_go(spark):
    base = '{"SNR":"1","GPSAltitude":"%s"}'
    data = [("6223-A_M", 5, base % "low")] * 2 + [
        ("6223-A_M", 5, base % "high"),  # differs in a field that no score uses
        ("6223-A_M", 5, '{"GPSAltitude":"low", "SNR":"1"}'),  # the same fields in another order
        ("6224-A_M", 5, base % "low"),  # another row key of the serial number
        ("6223-A_M", 6, base % "low"),
        ("6223-A_M", 5, '{"SNR":"1","PCellID":"low"}'),  # the value under another name
        ("6223-A_M", None, base % "low"),
        ("6223-A_M", None, base % "low"),
        (None, 5, base % "low"),
    ]
    got = H.ingest_heartbeats(spark.createDataFrame(data, "rowkey string, ts bigint, payload string"))
    assert got.count() == 7 and got.where("sn = 'A'").count() == 6
    flat = spark.createDataFrame([("S", "5", "1", "x")] * 2 + [("S", "5", "1", "y"), ("S", "5", "1", None)], "sn string, ts string, SNR string, other string")
    assert H.flat_heartbeats(flat).count() == 3


def test_nan_is_no_number(spark):
    df = spark.createDataFrame([("NaN", "NaN"), ("1.5", "2"), ("x", None)], "a string, b string")
    assert rows(H.cast_columns(df, {"a": "double", "b": "bigint"})) == [(1.5, 2), (None, None), (None, None)]


def test_payload_has_all_fields(spark):
    parsed = H.parse_payload(spark.sql("select 1 as id, '{}' as payload"), "payload")
    types = [t for _, t in parsed.dtypes[1:]]
    assert {t: types.count(t) for t in set(types)} == {"string": 42, "int": 46, "double": 13, "boolean": 7}
    assert set(H.USED_FIELDS) <= set(parsed.columns)


def test_flat_heartbeats(spark):
    raw = spark.createDataFrame(
        [("S", "1704067200123", "5", "", "3"), ("S", "x", "n/a", "640000", None)],
        "sn string, ts string, snr string, `5GEARFCN_DL` string, CQI string",
    )
    got = sorted(H.flat_heartbeats(raw).collect(), key=lambda r: r.ts is None)
    assert (got[0].lte_snr, got[0].nr_earfcn_dl, got[0].cqi, got[0].imsi) == (5.0, None, 3.0, None)
    assert (got[1].ts, got[1].lte_snr, got[1].nr_earfcn_dl) == (None, None, 640000)


def test_event_id_depends_on_content_only(spark):
    df = spark.range(50).withColumn("x", F.col("id") % 3)
    assert rows(H.with_event_id(df)) == rows(H.with_event_id(df.repartition(7)))


def test_sinks(spark, tmp_path):
    out = str(tmp_path / "t")
    two = spark.range(10).withColumn("date", F.lit("2024-01-01")).unionByName(
        spark.range(10, 30).withColumn("date", F.lit("2024-01-02"))
    )
    W.write_dates(two, out)
    W.write_dates(spark.range(3).withColumn("date", F.lit("2024-01-02")), out)
    assert rows(spark.read.parquet(out).groupBy("date").count()) == [(10, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 2))]

    hourly = str(tmp_path / "h")
    W.write_hours(spark.range(2).withColumns({"date": F.lit("2024-01-01"), "hr": F.lit("05")}), hourly)
    assert (tmp_path / "h/date=2024-01-01/hr=05").is_dir()

    new = str(tmp_path / "new")
    W.write_files(spark.range(2), new, 1, "errorifexists")
    with pytest.raises(AnalysisException):
        W.write_files(spark.range(2), new, 1, "errorifexists")
    W.write_folder(spark.range(5), new)
    assert spark.read.parquet(new).count() == 5

    W.write_files(spark.range(1000), str(tmp_path / "ten"))
    assert len(list((tmp_path / "ten").glob("*.parquet"))) == 10

    W.write_subset(spark.range(10).withColumn("model", F.col("id").cast("string")), str(tmp_path / "sub"), "model", ["1", "4"])
    assert rows(spark.read.parquet(str(tmp_path / "sub")).select("id")) == [(1,), (4,)]

    back = W.write_and_read(spark.range(7), str(tmp_path / "again"))
    assert back.count() == 7 and back.inputFiles()


def test_exists(spark, tmp_path):
    assert not R.exists(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert not R.exists(spark, str(tmp_path / "empty"))
    W.write_folder(spark.range(1), str(tmp_path / "full"))
    assert R.exists(spark, str(tmp_path / "full"))


def test_checkpoint_folder_is_the_sessions(spark):
    assert D.checkpoint_folder(spark).startswith("file:")
    assert spark.conf.get("spark.checkpoint.dir") in D.checkpoint_folder(spark)


def test_renames(spark):
    df = spark.createDataFrame([("1", "2")], "MTN string, Other string")
    assert R.renamed(df, {"mtn": "mdn"}).columns == ["mdn"]


def test_newest_date_prunes_a_partitioned_table(spark, tmp_path):
    base = str(tmp_path / "speeds")
    rows_of = spark.range(40).selectExpr("id", "date_add(date'2024-01-01', CAST(id % 10 AS int)) AS datadate")
    W.write_dates(rows_of, base, ("datadate",))
    table = spark.read.schema("id long, datadate date").parquet(base)
    newest = R.latest_available(table, "datadate", dt.date(2024, 1, 12))
    assert sorted(r.id for r in newest.collect()) == [9, 19, 29, 39]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan

    fixed = R.multi_date_union(table, "datadate", [dt.date(2024, 1, 3), dt.date(2024, 1, 30)])
    assert {f.split("datadate=")[1][:10] for f in fixed.inputFiles()} <= {f"2024-01-{d:02d}" for d in range(1, 11)}
    assert "PartitionFilters: [" in fixed._jdf.queryExecution().executedPlan().toString() and fixed.count() == 4
    scan = [x for x in str(fixed._jdf.queryExecution().executedPlan()).splitlines() if "FileScan" in x][0]
    assert "PartitionFilters: []" not in scan


def test_payload_as_variant(spark):
    payloads = ['{"SNR": "1.5", "own": {"a": [1]}}', '{"SNR": 2.50, "CurrentNetwork": null}', '{"SNR": true}', "{broken", "[1]", "7", "", None, "{}"]
    df = spark.createDataFrame([(k, p, "x") for k, p in enumerate(payloads)], "id int, payload string, `_key` string")
    found = H.payload_texts(df, {"snr": "SNR", "network": "CurrentNetwork", "own": "own"})
    assert found.columns == ["id", "_key", "snr", "network", "own"]
    texts = {r.id: (r.snr, r.network, r.own) for r in found.collect()}
    assert set(texts) == set(range(9)) - {7}
    assert texts.pop(0) == ("1.5", None, '{"a":[1]}') and texts.pop(1) == ("2.5", None, None) and texts.pop(2) == ("true", None, None)
    assert set(texts.values()) == {(None, None, None)}
    fields = {r.field: (r.known, r.used, r.rows, r.text_rows) for r in H.payload_fields(df).collect()}
    assert fields == {"SNR": (True, True, 3, 1), "CurrentNetwork": (True, True, 1, 0), "own": (False, False, 1, 0)}
    assert H.payload_fields(df.limit(0)).collect() == []
    plan = H.payload_texts(df, {"a": "SNR", "b": "own"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") == 1 or plan.count("parseJson") == 1
