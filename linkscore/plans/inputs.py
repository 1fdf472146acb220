"""The engine's inputs, derived from the given tables.

The texts are plain SQL that Spark and DuckDB read alike, so the queries and their oracles start
from the same rows. A missing or repeated row depends on a data value, never on a modulo filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "orders", "events")

# The number in props, which reads {"k": <number>}.
_K = "CAST(substring(props, 7, length(props) - 7) AS INT)"


def _digits(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS STRING), {n}, '0')"


def _sn(expr: str) -> str:
    return f"'SN' || {_digits(expr, 10)}"


def _imsi(expr: str) -> str:
    return f"'3114' || {_digits(expr, 10)}"


def _mdn(expr: str) -> str:
    return f"'555' || {_digits(expr, 10)}"


def _imei(expr: str) -> str:
    return f"'35' || {_digits(f'({expr}) * 7919', 15)}"


def _short_imei(expr: str) -> str:
    return f"substring({_imei(expr)}, 1, 16)"


def _json(field: str, value: str, quote: bool = False) -> str:
    text = f"COALESCE(CAST({value} AS STRING), {chr(39)}{chr(39) if quote else 'null' + chr(39)})"
    mark = '"' if quote else ""
    return f"'\"{field}\":{mark}' || {text} || '{mark}'"


# Fields of the raw payload: name, value, and whether it is text. GPSAltitude is not used by any score.
RAW_FIELDS = [
    ("MDN", _mdn("user_id"), True),
    ("IMSI", _imsi("user_id"), True),
    ("IMEI", _short_imei("user_id"), True),
    ("ModelName", "CASE user_id % 2 WHEN 0 THEN 'ASK-NCQ1338' ELSE 'XCI55AX' END", True),
    ("SNR", "CASE WHEN event_id % 43 = 0 THEN 'n/a' ELSE CAST(k % 60 - 15 AS STRING) END", True),
    ("5GSNR", "CASE WHEN event_id % 19 = 0 THEN NULL ELSE (k * 7 + event_id) % 56 - 13 END"),
    ("4GRSRP", "k * 3 % 120 - 140"),
    ("BRSRP", "CAST(k * 2 % 165 + 3 AS STRING) || '.5'"),
    ("CQI", "k % 18"),
    ("5GEARFCN_DL", "CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(640000 + event_id % 20 * 1000 AS STRING) END", True),
    ("4GPccBand", "event_id % 4 * 11"),
    ("4GScc1Band", "event_id % 3"),
    ("4GScc2Band", "event_id % 2 * 5"),
    ("4GScc3Band", "0"),
    ("5GPccBand", "CASE event_id % 5 WHEN 0 THEN 77 WHEN 1 THEN 5 ELSE NULL END"),
    ("5GScc1Band", "CASE event_id % 7 WHEN 0 THEN 77 ELSE NULL END"),
    ("ServiceUptime", "d * 4", True),
    ("ServiceDowntime", "CASE WHEN event_id % 29 = 0 THEN 'x' ELSE CAST(d AS STRING) END", True),
    ("CurrentNetwork", "event_type", True),
    ("MemoryPercentFree", "CASE WHEN event_id % 23 = 0 THEN NULL ELSE k END"),
    ("LTERACHAttemptCount", "d * 20"),
    ("LTERACHFailureCount", "CASE WHEN event_id % 37 = 0 THEN 99999999999 ELSE d * 3 END"),
    ("LTEHandOverAttemptCount", "d * 2"),
    ("LTEHandOverFailureCount", "d"),
    ("NRSCGChangeCount", "d * 5"),
    ("NRSCGChangeFailureCount", "d % 5"),
    ("RRCConnectFailureCount", "d % 3"),
    ("GPSAltitude", "altitude", True),
]

INPUTS = {
    # One heartbeat per event. Counters follow the day of month, so they look alike at every scale;
    # user_id % 5 sets the behaviour: no failures, few, many, some downtime, downtime every day.
    "hb": f"""
SELECT event_id, ts, user_id,
  {_sn('user_id')} AS sn,
  {_imsi('user_id')} AS imsi,
  {_short_imei('user_id')} AS imei,
  CASE user_id % 6 WHEN 0 THEN 'ASK-NCQ1338' WHEN 1 THEN 'WNC-CR200A' WHEN 2 THEN 'ASK-NCQ1338FA'
       WHEN 3 THEN 'XCI55AX' WHEN 4 THEN 'FSNO21VA' ELSE 'ASK-NCM1100' END AS model_name,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST((k % 60) - 15 AS DOUBLE) END AS lte_snr,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(((k * 7 + event_id) % 56) - 13 AS DOUBLE) END AS nr_snr,
  CASE event_id % 4 WHEN 0 THEN 13 WHEN 1 THEN 66 WHEN 2 THEN 2 ELSE 0 END AS lte_pcc_band,
  CAST(event_id % 3 AS INT) AS lte_scc1_band,
  CASE WHEN event_id % 2 = 0 THEN 0 ELSE 5 END AS lte_scc2_band,
  0 AS lte_scc3_band,
  CASE event_id % 5 WHEN 0 THEN 77 WHEN 1 THEN 77 WHEN 2 THEN 5 WHEN 3 THEN 0 ELSE NULL END AS nr_pcc_band,
  CASE event_id % 7 WHEN 0 THEN 77 WHEN 1 THEN 77 WHEN 2 THEN 5 WHEN 3 THEN NULL ELSE 0 END AS nr_scc1_band,
  CASE WHEN event_id % 11 = 0 THEN NULL
       WHEN event_id % 5 IN (0, 1) THEN 640000 + (event_id % 20) * 1000
       ELSE 5230 + event_id % 100 END AS nr_earfcn_dl,
  CASE WHEN event_id % 97 = 0 THEN 184467440737095 ELSE CAST(d * 4 + FLOOR(h / 6) AS BIGINT) END AS service_uptime,
  CASE WHEN event_id % 89 = 0 THEN 184467440737095
       ELSE CAST(CASE user_id % 5 WHEN 3 THEN FLOOR(d / 10) WHEN 4 THEN d ELSE 0 END AS BIGINT) END AS service_downtime,
  CASE WHEN event_id % 53 = 0 THEN NULL
       ELSE CAST(CASE WHEN user_id % 5 = 0 THEN 0 ELSE (d % 10) * 3 END AS BIGINT) END AS lte_rach_failure_count,
  CAST(CASE WHEN user_id % 5 = 0 THEN 0 ELSE d * 20 END AS BIGINT) AS lte_rach_attempt_count,
  CAST((d % 15) * 2 AS BIGINT) AS lte_handover_failure_count,
  CAST((d % 15) * 20 AS BIGINT) AS lte_handover_attempt_count,
  CAST(d % 20 AS BIGINT) AS nr_scg_change_failure_count,
  CAST((d % 20) * 10 AS BIGINT) AS nr_scg_change_count,
  CAST(CASE user_id % 5 WHEN 0 THEN 0 WHEN 1 THEN FLOOR(d / 10) ELSE (d % 12) * 2 END AS BIGINT) AS rrc_connect_failure_count,
  CASE event_type WHEN 'error' THEN '-' ELSE event_type END AS current_network,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS memory_percent_free,
  CAST(k % 18 AS DOUBLE) AS cqi,
  CAST((k * 2) % 165 - 160 AS DOUBLE) AS nr_rsrp,
  CAST((k * 3) % 120 - 140 AS DOUBLE) AS lte_rsrp
FROM (SELECT event_id, ts, user_id, event_type, EXTRACT(DAY FROM ts) AS d, EXTRACT(HOUR FROM ts) AS h,
             {_K} AS k FROM {{events}}) e
""",
    # Raw heartbeats: JSON text with all used fields under a row key, time in milliseconds. Some rows
    # have no payload, a malformed one, text that is no number, or a number too large. Rows of one type
    # come twice, rows of another twice with a difference in a field that no score uses, and those of a
    # third under two row keys with one serial number.
    "raw": f"""
SELECT event_id,
  prefix || {_sn('user_id')} || '_MAC' AS rowkey,
  1704067200000 + CAST(((d - 1) * 24 + h) * 60 + mi AS BIGINT) * 60000 + event_id % 60000 AS ts,
  CASE WHEN event_id % 41 = 0 THEN NULL
       WHEN event_id % 31 = 0 THEN '{{{{bad'
       ELSE '{{{{' || {" || ',' || ".join(_json(*field) for field in RAW_FIELDS)}
         || '}}}}' END AS payload
FROM (SELECT event_id, user_id, event_type, 'low' AS altitude, '6223-' AS prefix, EXTRACT(DAY FROM ts) AS d,
             EXTRACT(HOUR FROM ts) AS h, EXTRACT(MINUTE FROM ts) AS mi, {_K} AS k FROM {{events}}
      UNION ALL
      SELECT event_id, user_id, event_type, CASE event_type WHEN 'error' THEN 'high' ELSE 'low' END,
             CASE event_type WHEN 'signup' THEN '6224-' ELSE '6223-' END, EXTRACT(DAY FROM ts),
             EXTRACT(HOUR FROM ts), EXTRACT(MINUTE FROM ts), {_K}
      FROM {{events}} WHERE event_type IN ('view', 'error', 'signup')) e
""",
    # Heartbeats as flat text columns, some of them no numbers.
    "flat": f"""
SELECT event_id, {_sn('user_id')} AS sn,
  CASE WHEN event_id % 43 = 0 THEN 'n/a' ELSE CAST(k % 60 - 15 AS STRING) END AS snr,
  CASE WHEN event_id % 47 = 0 THEN '' ELSE CAST(k AS STRING) || '.5' END AS memory,
  event_type AS network
FROM (SELECT event_id, user_id, event_type, {_K} AS k FROM {{events}}) e
""",
    # Customer lines with padded product names and one unknown plan.
    "cust": f"""
SELECT c_custkey,
  'C' || CAST(c_custkey AS STRING) AS cust_id,
  {_imsi('c_custkey')} AS imsi,
  {_mdn('c_custkey')} AS mdn,
  {_imei('c_custkey')} AS imei_raw,
  CASE c_custkey % 8 WHEN 0 THEN '38365' WHEN 1 THEN '39425' WHEN 2 THEN '46798' WHEN 3 THEN '50044'
       WHEN 4 THEN '51219' WHEN 5 THEN '67571' WHEN 6 THEN '67567' ELSE '99999' END AS pplan_cd,
  'Plan for ' || c_mktsegment AS pplan_desc,
  'E' || CAST(c_nationkey AS STRING) AS ecpd_profile_id,
  CASE c_custkey % 6 WHEN 0 THEN 'Home Gateway ASK-NCQ1338' WHEN 1 THEN ' 5G Router WNC-CR200A '
       WHEN 2 THEN 'Home ASK-NCQ1338FA' WHEN 3 THEN 'ARC-XCI55AX'
       WHEN 4 THEN 'Legacy Hub FSNO21VA' ELSE 'Unknown Box ZZ9' END AS device_prod_nm
FROM {{customer}}
""",
    # Lines of the second customer source: ids only.
    "cust2": f"""
SELECT {_imsi('500000 + s_suppkey')} AS imsi, {_mdn('5000000 + s_suppkey')} AS mdn,
       {_imei('500000 + s_suppkey')} AS imei_raw
FROM {{supplier}}
""",
    # Indebted lines have no serial number, the richest have two.
    "sn_map": f"""
SELECT {_mdn('c_custkey')} AS mdn, {_sn('c_custkey')} AS sn FROM {{customer}} WHERE c_acctbal >= 0
UNION ALL
SELECT {_mdn('c_custkey')}, 'SX' || {_digits('c_custkey', 10)} FROM {{customer}} WHERE c_acctbal > 9000
""",
    # Passive measurements over ten dates, nulls and zeros included.
    "passive": f"""
SELECT o_orderkey, {_imsi('o_custkey')} AS imsi,
  CAST('2024-01-' || {_digits('1 + o_orderkey % 10', 2)} AS DATE) AS datadate,
  CASE WHEN o_orderkey % 3 = 0 THEN 'M1' ELSE 'M2' END AS device_model,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN CAST(0 AS DOUBLE)
       ELSE o_totalprice / 10000 END AS dl_speed
FROM {{orders}}
""",
    "speedtest": f"""
SELECT o_orderkey, {_mdn('o_custkey')} AS mdn, {_short_imei('o_custkey')} AS imei,
  CAST('2024-01-' || {_digits('1 + o_orderkey % 10', 2)} AS DATE) AS test_date,
  'Jan ' || {_digits('1 + o_orderkey % 10', 2)} || ', 2024 ' || {_digits('1 + o_orderkey % 12', 2)} || ':'
    || {_digits('o_orderkey % 60', 2)} || ':' || {_digits('o_orderkey % 59', 2)}
    || CASE WHEN o_orderkey % 24 < 12 THEN ' AM' ELSE ' PM' END AS created,
  CASE o_orderstatus WHEN 'F' THEN 'FAILED' ELSE 'DONE' END AS status,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice / 2500 END AS download_result,
  CASE WHEN o_orderkey % 19 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / 25000 END AS upload_result,
  CAST(o_orderkey % 90 AS DOUBLE) AS latency,
  CASE WHEN o_orderkey % 5 = 0 THEN 50 ELSE 100 END AS progress
FROM {{orders}}
""",
    # Speed tests, some without a number.
    "speedtest_odd": f"""
SELECT {_mdn('o_custkey')} AS mdn, 100 AS progress,
  CASE WHEN o_orderkey % 31 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 17 = 0 THEN NULL
       ELSE o_totalprice / 2500 END AS download_result,
  CASE WHEN o_orderkey % 37 = 0 THEN CAST('NaN' AS DOUBLE) ELSE o_totalprice / 25000 END AS upload_result
FROM {{orders}}
""",
    "modem_event": f"""
SELECT event_id, ts, {_sn('user_id')} AS sn,
  CASE WHEN event_type = 'error' AND value > 20 THEN props ELSE NULL END AS modem_event
FROM {{events}}
""",
    "reset_log": f"""
SELECT event_id, {_sn('user_id')} AS sn FROM {{events}} WHERE event_type = 'error' AND value > 60
""",
    "location": f"""
SELECT {_sn('c_custkey')} AS sn, n_name AS state, r_name AS county
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
WHERE c_mktsegment <> 'HOUSEHOLD'
""",
    # One row per order, so versions repeat.
    "firmware": f"""
SELECT {_sn('o_custkey')} AS sn, 'fw-' || CAST(o_orderkey % 3 + 8 AS STRING) AS firmware FROM {{orders}}
""",
    "usage": f"""
SELECT {_imsi('c_custkey')} AS imsi, {_mdn('c_custkey')} AS mdn,
  ABS(c_acctbal) AS lte_total_mb, ABS(c_acctbal) * 2 AS nr_total_mb,
  CAST(c_custkey % 101 AS DOUBLE) AS nr_usage_percentage
FROM {{customer}} WHERE c_acctbal < 9500
""",
    "nr_time": f"""
SELECT {_imsi('c_custkey')} AS imsi, 97 AS hb_total, c_custkey % 97 AS hb_5g,
  CAST(c_custkey % 97 AS DOUBLE) / 97 AS percentage
FROM {{customer}}
""",
    # Devices the first heartbeat source knows: those that signed up in the first days.
    "first_ids": f"""
SELECT DISTINCT {_short_imei('user_id')} AS imei, {_imsi('user_id')} AS imsi
FROM {{events}} WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-03 00:00:00'
""",
    # One feed per device; a day without a heartbeat did not land.
    "landed": f"""
SELECT DISTINCT {_sn('user_id')} AS dataset, CAST(ts AS DATE) AS part_date FROM {{events}}
""",
    # What is expected of most feeds, and of some that never land.
    "expected": f"""
SELECT {_sn('c_custkey')} AS dataset, CAST(c_custkey % 4 AS INT) AS expected_delay, c_custkey % 3 = 0 AS weekdays_only
FROM {{customer}} WHERE c_acctbal >= 0
UNION ALL
SELECT 'never-' || r_name, 2, r_regionkey % 2 = 0 FROM {{region}}
""",
}

# Heartbeats of which some lost their time.
INPUTS["hb_timed"] = f"""
SELECT event_id, sn, service_downtime, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ts END AS ts
FROM ({INPUTS["hb"]}) h
"""


class Inputs:
    """The inputs of one data folder as frames: ``Inputs(spark, folder).hb``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUTS:
            raise AttributeError(name)
        text = INPUTS[name]
        used = {t: self.table(t) for t in TABLES if f"{{{t}}}" in text}
        frame = self.spark.sql(text, **used)
        setattr(self, name, frame)  # later reads of the attribute reuse the frame
        return frame


def input_cte(name: str) -> str:
    """The same input as a common table expression over the tables' own names."""
    return f"{name} AS ({INPUTS[name].format(**{t: t for t in TABLES}).strip()})"
