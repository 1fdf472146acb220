"""DuckDB texts that compute the registered queries on their own, for comparison.

They start from the same inputs but follow the definitions row by row: plain windows, record-level
joins, percentiles by ``quantile_disc``. Values come from ``params`` where they are tables.
"""

from __future__ import annotations

from linkscore import params as P
from linkscore.plans.inputs import INPUTS, input_cte
from linkscore.sources.heartbeat import KNOWN_FIELDS, USED_FIELDS


def rnd(x: str, digits: int) -> str:
    """Round half up on the decimal text of a double, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def ladder(x: str, steps) -> str:
    rungs = " ".join(f"WHEN {x} >= {bound}e0 THEN '{name}'" for bound, name in steps)
    return f"CASE WHEN {x} IS NULL THEN NULL {rungs} ELSE 'Poor' END"


def weighted(weights: dict[str, float]) -> str:
    total = " + ".join(f"coalesce({c} * {w}e0, 0e0)" for c, w in weights.items())
    weight = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w}e0 ELSE 0e0 END" for c, w in weights.items())
    return f"(({total}) / nullif({weight}, 0e0))"


def number(x: str) -> str:
    return f"CASE {x} WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Good' THEN 3 WHEN 'Excellent' THEN 4 END"


def added(x: str) -> str:
    return f"CAST(SUM(CASE WHEN p_{x} <= {x} THEN {x} - p_{x} ELSE coalesce({x}, 0) END) AS BIGINT) AS sum_{x}"


def moved(x: str, name: str) -> str:
    return f"CAST(SUM(CASE WHEN {x} <> p_{x} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"


def lags(columns) -> str:
    return ", ".join(f"lag({c}) OVER w AS p_{c}" for c in columns)


def capped(x: str) -> str:
    return f"({rnd(f'CASE WHEN {x} > 1 THEN 1e0 ELSE {x} END', 4)} * 100e0)"


def hundredths_mean(x: str) -> str:
    return rnd(f"(SUM(CAST(round({x} * 100e0) AS BIGINT)) / 100e0 / COUNT(*))", 2)


SENTINEL = 184467440737095
FAILURES = [
    "lte_rach_failure_count", "lte_handover_failure_count", "nr_scg_change_failure_count", "rrc_connect_failure_count",
]
PAIRS = {
    "lte_rach_failure_ratio": ("lte_rach_failure_count", "lte_rach_attempt_count"),
    "lte_handover_failure_ratio": ("lte_handover_failure_count", "lte_handover_attempt_count"),
    "nr_scg_change_failure_ratio": ("nr_scg_change_failure_count", "nr_scg_change_count"),
}
PAIR_COUNTERS = [c for pair in PAIRS.values() for c in pair]
KNOWN = f"service_downtime <> {SENTINEL} AND service_uptime <> {SENTINEL}"
ATTACHED = "current_network IS NOT NULL AND current_network NOT IN ('-', '0', '12', '13', 'None')"
MODEL = "list_extract(string_split(trim(device_prod_nm), ' '), -1)"
KEPT_FIRST = f"CASE WHEN {MODEL} IN ({quoted(P.KEPT_MODELS_FIRST)}) THEN {MODEL} ELSE 'Others' END"
KEPT = f"CASE WHEN {MODEL} IN ({quoted(P.KEPT_MODELS)}) THEN {MODEL} ELSE 'Others' END"

CTES: dict[str, str] = {name: input_cte(name) for name in INPUTS}


def cte(name: str, text: str) -> None:
    CTES[name] = f"{name} AS ({text})"


def caps_values(rows) -> str:
    return ", ".join(f"('{code}', {dl}, {ul})" for code, dl, ul in rows)


def threshold_values(table) -> str:
    return ", ".join(f"('{code}', {lo}e0, {mid}e0, {hi}e0)" for code, (lo, mid, hi) in table.items())


cte("caps", f"SELECT * FROM (VALUES {caps_values(P.PLAN_CAPS)}) t(pplan_cd, dl_cap, ul_cap)")
cte("caps_first", f"SELECT * FROM (VALUES {caps_values(P.PLAN_CAPS_FIRST)}) t(pplan_cd, dl_cap, ul_cap)")
cte(
    "lines",
    f"""SELECT DISTINCT c.imsi, c.mdn, c.pplan_cd, c.pplan_desc, {MODEL} AS model, m.sn
        FROM cust c JOIN sn_map m ON c.mdn = m.mdn""",
)
cte(
    "flines",
    f"""SELECT DISTINCT cust_id, ecpd_profile_id, substring(imei_raw, 1, length(imei_raw) - 1) AS imei, imsi, mdn,
        pplan_cd, {KEPT} AS model FROM cust""",
)
cte("flines_first", f"SELECT DISTINCT cust_id, imei_raw, imsi, mdn, pplan_cd, {KEPT_FIRST} AS model FROM cust")
cte(
    "all_lines",
    """SELECT * FROM flines UNION ALL SELECT DISTINCT 'second', 'second', substring(imei_raw, 1, length(imei_raw) - 1),
       imsi, mdn, 'second', 'second' FROM cust2""",
)

# availability
SERVICE = ["service_downtime", "service_uptime"]


def scored(dt: str, keys: str, source: str, extra: str = "") -> str:
    score = "100e0 - 20e0 * not_available_pct"
    return f"""SELECT {keys}, {extra} {', '.join('sum_' + c for c in FAILURES)}, downtime_changes, uptime_changes,
        100e0 * downtime_changes / nullif(downtime_changes + uptime_changes, 0) AS downtime_share, assumed_downtime,
        not_available_pct,
        CASE WHEN {score} < 0 THEN 0e0 ELSE {rnd(score, 2)} END AS availability_score
      FROM (SELECT *, assumed_downtime / 86400e0 * 100e0 AS not_available_pct
            FROM (SELECT *, {dt} AS assumed_downtime FROM {source}))"""


DOWNTIME = "(sum_rrc_connect_failure_count * 1e0 + sum_lte_rach_failure_count * 0.01e0 + downtime_changes * 300e0)"


def service_sums(keys: str, rows: str) -> str:
    return f"""SELECT {keys}, {', '.join(added(c) for c in FAILURES)}, {moved('service_downtime', 'downtime_changes')},
          {moved('service_uptime', 'uptime_changes')}
        FROM (SELECT *, {lags(FAILURES + SERVICE)} FROM {rows}
              WHERE {KNOWN} WINDOW w AS (PARTITION BY {keys} ORDER BY service_uptime, event_id)) GROUP BY {keys}"""


cte("service", service_sums("sn", "hb"))
cte("avail_score", scored(DOWNTIME, "sn", "service"))
cte("avail", f"SELECT *, {ladder('availability_score', P.AVAILABILITY_LADDER)} AS availability_category FROM avail_score")
cte("hb_hour", 'SELECT *, CAST(ts AS DATE) AS "date", CAST(EXTRACT(HOUR FROM ts) AS INT) AS hr FROM hb')
cte(
    "crashes",
    """SELECT sn, CAST(ts AS DATE) AS "date", CAST(EXTRACT(HOUR FROM ts) AS INT) AS hr, COUNT(*) AS crashes
       FROM modem_event WHERE modem_event IS NOT NULL GROUP BY ALL""",
)
cte("service_hour", service_sums('sn, "date", hr', "hb_hour"))
cte(
    "service_crash",
    """SELECT s.*, coalesce(c.crashes, 0) AS crashes FROM service_hour s
       LEFT JOIN crashes c ON s.sn = c.sn AND s."date" = c."date" AND s.hr = c.hr""",
)
cte("avail_hour_score", scored(f"(crashes * 90e0 + {DOWNTIME})", 'sn, "date", hr', "service_crash", "crashes,"))

# capacity
BANDWIDTHS = """
   CASE WHEN lte_pcc_band > 0 THEN 20 ELSE 0 END + CASE WHEN lte_scc1_band > 0 THEN 20 ELSE 0 END
   + CASE WHEN lte_scc2_band > 0 THEN 20 ELSE 0 END + CASE WHEN lte_scc3_band > 0 THEN 20 ELSE 0 END AS lte_mhz,
   CASE WHEN nr_pcc_band > 0 AND nr_pcc_band <> 77 THEN 20 ELSE 0 END
   + CASE WHEN nr_scc1_band > 0 AND nr_scc1_band <> 77 THEN 20 ELSE 0 END AS nw_mhz,
   CASE WHEN nr_pcc_band = 77 AND nr_scc1_band = 77 THEN 160
        WHEN nr_pcc_band = 77 AND nr_earfcn_dl BETWEEN 646667 AND 653329 THEN 100
        WHEN nr_pcc_band = 77 AND nr_earfcn_dl NOT BETWEEN 646667 AND 653329 THEN 60
        WHEN nr_pcc_band <> 77 AND nr_scc1_band = 77 THEN 80 ELSE 0 END AS cband_mhz"""
LTE_CAP = "CASE WHEN lte_snr = 0 THEN 0e0 ELSE lte_mhz * least(1e0, (lte_snr + 11e0) / 41e0) END"
NW_CAP = "CASE WHEN nr_snr = 0 THEN 0e0 ELSE nw_mhz * least(1e0, (nr_snr + 11e0) / 41e0) END"
CBAND_CAP = "CASE WHEN nr_snr = 0 THEN 0e0 ELSE cband_mhz * 0.8e0 * least(1e0, (nr_snr + 10e0) / 41e0) END"
VALID = {
    r: f"({r} BETWEEN -10 AND 40 AND {r} <> 0)" for r in ("lte_snr", "nr_snr")
}


def record_capacity(where: str) -> str:
    return f"""SELECT sn, imsi, {rnd(LTE_CAP, 2)} AS lte_capacity, {rnd(NW_CAP, 2)} AS nw_capacity,
       {rnd(CBAND_CAP, 2)} AS cband_capacity
     FROM (SELECT *, {BANDWIDTHS} FROM hb WHERE {where}) WHERE lte_mhz + nw_mhz + cband_mhz > 0"""


cte("records_any", record_capacity(f"{VALID['lte_snr']} OR {VALID['nr_snr']}"))
cte("records_all", record_capacity(f"{VALID['lte_snr']} AND {VALID['nr_snr']}"))
TOTAL = "(lte_capacity + nw_capacity + cband_capacity)"
cte(
    "records_line",
    f"""SELECT r.*, l.mdn, least(p.dl_cap / 150e0, 1e0) AS adjustment,
          {rnd(f'100e0 * ({TOTAL} / (218e0 * least(p.dl_cap / 150e0, 1e0)))', 2)} AS pct
        FROM records_any r JOIN lines l ON r.sn = l.sn AND r.imsi = l.imsi JOIN caps p ON l.pplan_cd = p.pplan_cd""",
)
cte(
    "cap_score",
    f"""SELECT sn, mdn, {hundredths_mean('lte_capacity')} AS lte_capacity, {hundredths_mean('nw_capacity')} AS nw_capacity,
          {hundredths_mean('cband_capacity')} AS cband_capacity, {rnd('AVG(adjustment)', 2)} AS plan_adjustment,
          {hundredths_mean('least(pct, 100e0)')} AS capacity_score
        FROM records_line GROUP BY sn, mdn""",
)
cte("capacity", f"SELECT *, {ladder('capacity_score', P.CAPACITY_LADDER)} AS capacity_category FROM cap_score")
cte(
    "strict",
    f"""SELECT sn, imsi, {hundredths_mean('lte_capacity')} AS lte_capacity, {hundredths_mean('nw_capacity')} AS nw_capacity,
          {hundredths_mean('cband_capacity')} AS cband_capacity, {hundredths_mean('pct')} AS capacity_score
        FROM (SELECT *, {rnd(f'100e0 * ({TOTAL} / (218e0 * 1e0))', 2)} AS pct FROM records_all) GROUP BY sn, imsi""",
)

# throughput
cte(
    "speeds",
    """SELECT imsi, AVG(dl_speed) AS dl_speed FROM passive
       WHERE datadate BETWEEN DATE '2024-01-08' AND DATE '2024-01-10' AND dl_speed IS NOT NULL AND dl_speed <> 0
       GROUP BY imsi""",
)
cte(
    "tests",
    f"""SELECT mdn, AVG({rnd('download_result', 0)}) AS download_result, AVG({rnd('upload_result', 0)}) AS upload_result
       FROM speedtest WHERE progress = 100 AND download_result IS NOT NULL AND download_result <> 0
       AND upload_result IS NOT NULL AND upload_result <> 0 GROUP BY mdn""",
)
cte(
    "tests_odd",
    f"""SELECT mdn, AVG({rnd('download_result', 0)}) AS download_result, AVG({rnd('upload_result', 0)}) AS upload_result
       FROM (SELECT * FROM speedtest_odd WHERE NOT isnan(download_result) AND NOT isnan(upload_result))
       WHERE progress = 100 AND download_result <> 0 AND upload_result <> 0 GROUP BY mdn""",
)
cte(
    "parts",
    f"""SELECT l.sn, l.mdn, l.model, p.dl_cap, s.dl_speed, {capped('(s.dl_speed / p.dl_cap * 2)')} AS passive_score,
          {capped('(t.download_result / p.dl_cap)')} AS download_score, {capped('(t.upload_result / p.ul_cap)')} AS upload_score
        FROM lines l LEFT JOIN speeds s ON l.imsi = s.imsi LEFT JOIN caps p ON l.pplan_cd = p.pplan_cd
        LEFT JOIN tests t ON l.mdn = t.mdn""",
)
THROUGHPUT = {"passive_score": 28, "download_score": 4, "upload_score": 1}
cte("thr_score", f"SELECT *, {rnd(weighted(THROUGHPUT), 2)} AS throughput_score FROM parts")
cte("thr", f"SELECT *, {ladder('throughput_score', P.THROUGHPUT_LADDER)} AS throughput_category FROM thr_score")
cte(
    "peak",
    f"""SELECT u.imsi, l.mdn, l.model, u.device_model, l.pplan_cd, p.dl_cap, p.ul_cap, u.dl_speed,
          {capped('(u.dl_speed / p.dl_cap * 2)')} AS passive_score
        FROM (SELECT imsi, device_model, MAX(dl_speed) AS dl_speed FROM passive
              WHERE dl_speed IS NOT NULL AND dl_speed <> 0 GROUP BY imsi, device_model) u
        JOIN flines_first l ON u.imsi = l.imsi JOIN caps_first p ON l.pplan_cd = p.pplan_cd""",
)

# overall
cte(
    "numbers",
    f"""SELECT coalesce(b.sn, a.sn) AS sn, b.mdn, b.model, b.throughput_score, b.capacity_score, a.availability_score,
          {number('b.throughput_category')} AS throughput_number, {number('b.capacity_category')} AS capacity_number,
          {number('a.availability_category')} AS availability_number
        FROM (SELECT coalesce(t.sn, c.sn) AS sn, coalesce(t.mdn, c.mdn) AS mdn, t.model, t.throughput_score,
                t.throughput_category, c.capacity_score, c.capacity_category
              FROM thr t FULL JOIN capacity c ON t.sn = c.sn AND t.mdn = c.mdn) b
        FULL JOIN avail a ON b.sn = a.sn""",
)
OVERALL = {"availability_number": 5, "capacity_number": 2, "throughput_number": 1}
cte("overall_number", f"SELECT *, {rnd(weighted(OVERALL), 2)} AS score FROM numbers")
cte("overall", f"SELECT *, {ladder('score', P.OVERALL_LADDER)} AS score_category FROM overall_number")

# features
RANGES = " OR ".join(f"nr_earfcn_dl BETWEEN {lo} AND {hi}" for lo, hi in P.NR_CHANNEL_RANGES)


def db(x: str) -> str:
    return f"10e0 * log10(AVG(pow(10e0, ({x}) / 10e0)))"


cte(
    "plausible",
    f"""SELECT *, ({RANGES}) AS is_nr FROM hb WHERE ((nr_rsrp > -155 AND nr_rsrp < -20) OR nr_rsrp = 0) AND lte_snr < 55
        AND cqi < 15 AND nr_snr > -23 AND nr_snr < 40 AND memory_percent_free IS NOT NULL""",
)
cte(
    "signal",
    f"""SELECT *, {rnd('100e0 * (nr_records / CAST(nullif(channel_records, 0) AS DOUBLE))', 2)} AS nr_share,
          {rnd('100e0 * (lte_records / CAST(nullif(channel_records, 0) AS DOUBLE))', 2)} AS lte_share,
          {capped('(received / 230e0)')} AS received_share
        FROM (SELECT sn, {db('CASE WHEN is_nr THEN nr_rsrp END')} AS db_nr_rsrp,
          {db('CASE WHEN NOT is_nr THEN lte_rsrp END')} AS db_lte_rsrp,
          {db('CASE WHEN is_nr THEN nr_snr END')} AS db_nr_snr, {db('CASE WHEN NOT is_nr THEN lte_snr END')} AS db_lte_snr,
          AVG(cqi) AS avg_cqi, AVG(memory_percent_free) AS avg_memory_free, COUNT(nr_earfcn_dl) AS channel_records,
          COUNT(*) FILTER (WHERE is_nr) AS nr_records, COUNT(*) FILTER (WHERE NOT is_nr) AS lte_records,
          COUNT(*) AS received FROM plausible GROUP BY sn)""",
)
cte(
    "switches",
    f"""SELECT sn, {moved('current_network', 'network_switches')}
        FROM (SELECT *, lag(current_network) OVER (PARTITION BY sn ORDER BY ts, event_id) AS p_current_network
              FROM hb WHERE {ATTACHED}) GROUP BY sn""",
)
cte(
    "ratios",
    f"""SELECT *, {', '.join(f'CAST(sum_{a} AS DOUBLE) / nullif(sum_{b}, 0) AS {n}' for n, (a, b) in PAIRS.items())}
        FROM (SELECT sn, {', '.join(added(c) for c in PAIR_COUNTERS)}
              FROM (SELECT *, {lags(PAIR_COUNTERS)} FROM hb WINDOW w AS (PARTITION BY sn ORDER BY ts, event_id)) GROUP BY sn)""",
)
cte(
    "service_ts",
    f"""SELECT sn, {moved('service_downtime', 'downtime_changes')}, {moved('service_uptime', 'uptime_changes')}
        FROM (SELECT *, {lags(SERVICE)} FROM hb WHERE {KNOWN} WINDOW w AS (PARTITION BY sn ORDER BY ts, event_id))
        GROUP BY sn""",
)
cte(
    "falls",
    """SELECT sn, CAST(SUM(CASE WHEN x < p THEN 1 ELSE 0 END) AS BIGINT) AS resets
       FROM (SELECT sn, lte_handover_attempt_count AS x,
               lag(lte_handover_attempt_count) OVER (PARTITION BY sn ORDER BY ts, event_id) AS p
             FROM hb WHERE lte_handover_attempt_count <> 0) GROUP BY sn""",
)
MEANS = ["db_nr_rsrp", "db_lte_rsrp", "db_nr_snr", "db_lte_snr", "avg_cqi", "avg_memory_free"]
cte(
    "devices",
    f"""SELECT i.sn, i.imei, i.imsi, t.downtime_changes, t.uptime_changes,
          100e0 * t.downtime_changes / nullif(t.downtime_changes + t.uptime_changes, 0) AS downtime_share,
          w.network_switches, {', '.join('r.' + n for n in PAIRS)}, {', '.join('g.' + m for m in MEANS)}, g.nr_share,
          g.lte_share, g.received_share
        FROM (SELECT DISTINCT sn, imei, imsi FROM hb) i LEFT JOIN service_ts t ON i.sn = t.sn
        LEFT JOIN switches w ON i.sn = w.sn LEFT JOIN ratios r ON i.sn = r.sn LEFT JOIN signal g ON i.sn = g.sn""",
)
AS_IS = ["downtime_share", "network_switches", "received_share"]
TWO_DIGITS = [
    "avg_cqi", "avg_memory_free", "db_nr_rsrp", "db_lte_rsrp", "db_lte_snr", "db_nr_snr", *PAIRS,
]
cte(
    "first_source",
    f"""SELECT DISTINCT d.imei, d.imsi, {', '.join('d.' + c for c in AS_IS)},
          {', '.join(f'{rnd("d." + c, 2)} AS {c}' for c in TWO_DIGITS)}, n.percentage * 100e0 AS nr_uptime, n.hb_total, n.hb_5g
        FROM devices d JOIN nr_time n ON d.imsi = n.imsi
        WHERE EXISTS (SELECT 1 FROM first_ids f WHERE f.imei = d.imei AND f.imsi = d.imsi)""",
)
cte(
    "new_hb",
    """SELECT * FROM hb h WHERE NOT EXISTS (SELECT 1 FROM first_ids f WHERE f.imei = h.imei AND f.imsi = h.imsi)""",
)
cte(
    "second_source",
    f"""SELECT i.imei, i.imsi, i.heartbeats, w.network_switches, g.db_nr_rsrp, g.db_nr_snr, g.db_lte_snr
        FROM (SELECT imei, imsi, COUNT(*) AS heartbeats FROM new_hb GROUP BY ALL) i
        LEFT JOIN (SELECT imei, imsi, {moved('current_network', 'network_switches')}
          FROM (SELECT *, lag(current_network) OVER (PARTITION BY imei, imsi ORDER BY ts, event_id) AS p_current_network
                FROM new_hb WHERE {ATTACHED}) GROUP BY imei, imsi) w ON i.imei = w.imei AND i.imsi = w.imsi
        LEFT JOIN (SELECT imei, imsi, {db('nr_rsrp')} AS db_nr_rsrp, {db('nr_snr')} AS db_nr_snr, {db('lte_snr')} AS db_lte_snr
          FROM new_hb WHERE nr_snr <> 0 AND lte_snr <> 0 AND nr_rsrp > -155 AND nr_rsrp < 0 AND lte_snr < 55
          AND lte_snr > -50 AND nr_snr > -50 GROUP BY imei, imsi) g ON i.imei = g.imei AND i.imsi = g.imsi""",
)
UNION_COLUMNS = ["imei", "imsi", *AS_IS, *TWO_DIGITS, "nr_uptime", "hb_total", "hb_5g"]
SECOND_HAS = {"imei", "imsi", "network_switches", "db_nr_rsrp", "db_nr_snr", "db_lte_snr"}
cte(
    "both_sources",
    f"""SELECT {', '.join(UNION_COLUMNS)} FROM first_source
        UNION SELECT {', '.join(c if c in SECOND_HAS else 'NULL' for c in UNION_COLUMNS)} FROM second_source""",
)
cte(
    "table_raw",
    f"""SELECT DISTINCT l.*, u.data_usage, u.sqrt_data_usage, u.nr_usage_percentage, t.download_result, t.upload_result,
          t.latency, {', '.join('f.' + c for c in UNION_COLUMNS[2:])}
        FROM all_lines l
        LEFT JOIN (SELECT *, lte_total_mb + nr_total_mb AS data_usage, sqrt(lte_total_mb + nr_total_mb) AS sqrt_data_usage
                   FROM usage) u ON l.imsi = u.imsi AND l.mdn = u.mdn
        LEFT JOIN (SELECT mdn, {', '.join(f'{rnd(c, 0)} AS {c}' for c in ('download_result', 'upload_result', 'latency'))}
                   FROM speedtest WHERE progress = 100) t ON l.mdn = t.mdn
        JOIN both_sources f ON l.imei = f.imei AND l.imsi = f.imsi""",
)


def by_plan(nr: str, lte: str) -> str:
    return f"""CASE WHEN pplan_cd IN ({quoted(P.NR_PLANS)}) THEN {nr} WHEN pplan_cd IN ({quoted(P.LTE_PLANS)}) THEN {lte}
        ELSE ({nr} + {lte}) / 2e0 END"""


cte(
    "features",
    f"""SELECT x.*, m.sn, coalesce(r.n, 0) AS reset_count, {by_plan('db_nr_rsrp', 'db_lte_rsrp')} AS rsrp,
          {by_plan('db_nr_snr', 'db_lte_snr')} AS snr
        FROM table_raw x LEFT JOIN (SELECT DISTINCT l.imei, m.sn FROM flines l JOIN sn_map m ON l.mdn = m.mdn) m ON x.imei = m.imei
        LEFT JOIN (SELECT sn, COUNT(*) AS n FROM reset_log GROUP BY sn) r ON m.sn = r.sn""",
)
cte(
    "line_tests",
    """SELECT t.o_orderkey, t.mdn, l.model, l.pplan_cd, t.download_result, t.upload_result, t.latency
       FROM speedtest t JOIN flines l ON t.mdn = l.mdn""",
)


# scaling
def clamp(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN 0e0 WHEN {x} > 100 THEN 100e0 ELSE {x} END"


def piecewise(x: str, lo: str, mid: str, hi: str, middle: float = 50.0, reverse: bool = False) -> str:
    below = f"({x} - {lo}) * ({middle}e0 / nullif({mid} - {lo}, 0))"
    above = f"({x} - {mid}) * ({100 - middle}e0 / nullif({hi} - {mid}, 0)) + {middle}e0"
    value = rnd(f"CASE WHEN {x} <= {mid} THEN {below} ELSE {above} END", 2)
    return clamp(f"(100e0 - {value})" if reverse else value)


def percentiles(source: str, by: str, *columns: str) -> str:
    cuts = ", ".join(
        f"quantile_disc({c}, {p}) AS {c}_{n}" for c in columns for n, p in (("low", 0.01), ("mid", 0.5), ("high", 0.99))
    )
    return f"(SELECT {by}, {cuts} FROM {source} GROUP BY {by})"


def of(alias: str, c: str) -> tuple[str, str, str]:
    return f"{alias}.{c}_low", f"{alias}.{c}_mid", f"{alias}.{c}_high"


cte("download_limits", f"SELECT * FROM (VALUES {threshold_values(P.DOWNLOAD_THRESHOLDS)}) t(pplan_cd, lo, mid, hi)")
cte("upload_limits", f"SELECT * FROM (VALUES {threshold_values(P.UPLOAD_THRESHOLDS)}) t(pplan_cd, lo, mid, hi)")


def raw_reverse(c: str) -> str:
    return f"{clamp(rnd(f'(100e0 - {c})', 2))} AS scaled_{c}"


REVERSED = ["network_switches", "reset_count", *PAIRS]
cte(
    "scaled",
    f"""SELECT x.sn, x.mdn, x.pplan_cd, x.download_result, x.upload_result, x.latency,
          {', '.join(f'{piecewise("x." + c, *of("m", c))} AS scaled_{c}' for c in ('avg_cqi', 'rsrp', 'snr', 'sqrt_data_usage'))},
          {piecewise('x.upload_result', *of('p', 'upload_result'))} AS scaled_upload_result,
          {piecewise('x.latency', *of('p', 'latency'), reverse=True)} AS scaled_latency,
          {piecewise('x.download_result', 'd.lo', 'd.mid', 'd.hi')} AS scaled_download_result,
          coalesce({clamp(rnd('(x.avg_memory_free + (50e0 - m.avg_memory_free_mid))', 2))}, 50e0) AS scaled_avg_memory_free,
          {rnd('x.received_share', 2)} AS scaled_received_share,
          {rnd('x.nr_usage_percentage', 2)} / 2e0 AS scaled_nr_usage_percentage,
          {rnd('x.nr_uptime', 2)} / 2e0 AS scaled_nr_uptime,
          {', '.join(raw_reverse(c) for c in REVERSED)}
        FROM features x
        LEFT JOIN {percentiles('features', 'model', 'avg_cqi', 'rsrp', 'snr', 'sqrt_data_usage', 'avg_memory_free')} m
          ON x.model = m.model
        LEFT JOIN {percentiles('features', 'model, pplan_cd', 'upload_result', 'latency')} p
          ON x.model = p.model AND x.pplan_cd = p.pplan_cd
        LEFT JOIN download_limits d ON x.pplan_cd = d.pplan_cd""",
)
GROUPS = {
    "data_score": {"scaled_nr_uptime": 0.25, "scaled_nr_usage_percentage": 0.25, "scaled_sqrt_data_usage": 0.5},
    "speed_score": {"scaled_upload_result": 0.3, "scaled_download_result": 0.4, "scaled_latency": 0.3},
    "signal_score": {"scaled_rsrp": 0.35, "scaled_avg_cqi": 0.3, "scaled_snr": 0.35},
    "failure_score": {f"scaled_{c}": w for c, w in zip(PAIRS, (0.5, 0.25, 0.25))},
    "device_score": {
        "scaled_network_switches": 0.4, "scaled_received_share": 0.1, "scaled_reset_count": 0.4,
        "scaled_avg_memory_free": 0.1,
    },
}


def sql(body: str, *names: str) -> str:
    """The body behind the tables it needs; names in order of use."""
    return f"WITH {', '.join(CTES[n] for n in names)} {body}" if names else body


def digits(n: int, *columns: str) -> str:
    return ", ".join(f"{rnd(c, n)} AS {c}" for c in columns)


LINES = ["cust", "sn_map", "lines"]
AVAIL = ["hb", "service", "avail_score", "avail"]
THR = [*LINES, "passive", "speedtest", "caps", "speeds", "tests", "parts", "thr_score", "thr"]
OVERALL_CTES = [*THR, *AVAIL, "records_any", "records_line", "cap_score", "capacity", "numbers", "overall_number", "overall"]
DEVICES = ["hb", "plausible", "signal", "switches", "ratios", "service_ts", "devices"]
BOTH = [*DEVICES, "first_ids", "nr_time", "first_source", "new_hb", "second_source", "both_sources"]
FEATURES = [
    "cust", "cust2", "sn_map", "usage", "speedtest", "reset_log", "flines", "all_lines", *BOTH, "table_raw", "features",
]
TESTS = ["cust", "speedtest", "flines", "line_tests"]
AVAIL_OUT = f"""{', '.join('sum_' + c for c in FAILURES)}, downtime_changes, uptime_changes,
  {digits(6, 'downtime_share', 'assumed_downtime', 'not_available_pct')}, availability_score"""
OVERALL_OUT = """sn, mdn, model, throughput_score, capacity_score, availability_score, throughput_number,
  capacity_number, availability_number, score, score_category"""


def payload(key: str) -> str:
    return f"""CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$."{key}"') END"""


def ingested() -> list[str]:
    """Each used payload field, read as its type in the payload and cast to its type after ingest."""
    whole = {"4GRSRP", "CQI", "LTERACHAttemptCount", "LTERACHFailureCount", "LTEHandOverAttemptCount", "LTEHandOverFailureCount",
             "NRSCGChangeCount", "NRSCGChangeFailureCount", "RRCConnectFailureCount", "4GPccBand", "4GScc1Band", "4GScc2Band",
             "4GScc3Band", "5GPccBand", "5GScc1Band"}
    kinds = {"double": "DOUBLE", "bigint": "BIGINT"}
    out = []
    for field, (column, kind) in USED_FIELDS.items():
        value = f"TRY_CAST({payload(field)} AS INTEGER)" if field in whole else payload(field)
        out.append(f"{value if kind == 'string' else f'TRY_CAST({value} AS {kinds[kind]})'} AS {column}")
    return out


def summary(c: str, source: str = "hb") -> str:
    x = f"CAST({c} AS DOUBLE)"
    stats = {
        "count": f"CAST(COUNT({x}) AS DOUBLE)", "mean": f"AVG({x})", "stddev": f"stddev_samp({x})", "min": f"MIN({x})",
        "max": f"MAX({x})", **{f"{p}%": f"quantile_disc({x}, {p / 100})" for p in (5, 25, 50, 75, 95)},
    }
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{n}' AS statistic, {rnd(e, 6)} AS value FROM {source}""" for n, e in stats.items()
    )


HOLIDAY_DATES = ", ".join(f"DATE '{h}'" for h in P.HOLIDAYS)
EXPECTED = """SELECT coalesce(l.dataset, e.dataset) AS dataset, l.newest, coalesce(weekdays_only, false) AS weekdays_only,
    CAST(DATE '2024-02-01' - coalesce(expected_delay, 1) AS DATE) AS due
  FROM (SELECT dataset, MAX(part_date) AS newest FROM landed GROUP BY dataset) l FULL JOIN expected e ON l.dataset = e.dataset"""
DUE_DAYS = f"""SELECT dataset, part_date
  FROM (SELECT dataset, weekdays_only,
          CAST(unnest(generate_series(due - 30, due, INTERVAL 1 DAY)) AS DATE) AS part_date FROM ({EXPECTED})) s
  WHERE NOT weekdays_only OR (isodow(part_date) < 6 AND part_date NOT IN ({HOLIDAY_DATES}))"""
NOT_LANDED = "NOT EXISTS (SELECT 1 FROM landed l WHERE l.dataset = s.dataset AND l.part_date = s.part_date)"
GAPS = f"SELECT dataset, part_date FROM ({DUE_DAYS}) s WHERE {NOT_LANDED}"
FRESH = f"SELECT dataset, newest, CAST(due - newest AS INT) AS delay_days FROM ({EXPECTED})"

ORACLES: dict[str, str] = {
    "ingest_heartbeat": sql(
        f"""SELECT regexp_extract(rowkey, '-([A-Za-z0-9]+)', 1) AS sn, ts AS ts_ms, {', '.join(ingested())}
            FROM (SELECT DISTINCT rowkey, ts, payload FROM raw) WHERE payload IS NOT NULL""",
        "raw",
    ),
    "json_extract": sql(
        f"""SELECT event_id, substring(rowkey, 6, 12) AS sn, TRY_CAST({payload('SNR')} AS DOUBLE) AS snr,
          TRY_CAST({payload('5GSNR')} AS DOUBLE) AS nr_snr, {payload('CurrentNetwork')} AS network
          FROM raw WHERE payload IS NOT NULL""",
        "raw",
    ),
    "payload_fields": sql(
        f"""SELECT field, field IN ({', '.join(f"'{x}'" for x in KNOWN_FIELDS)}) AS known,
              field IN ({', '.join(f"'{x}'" for x in USED_FIELDS)}) AS used, COUNT(*) AS rows,
              COUNT(*) FILTER (WHERE json_type(payload, '$."' || field || '"') = 'VARCHAR') AS text_rows
            FROM (SELECT payload, unnest(json_keys(payload)) AS field FROM raw WHERE json_valid(payload)) GROUP BY field""",
        "raw",
    ),
    "cast_columns": sql(
        "SELECT event_id, sn, TRY_CAST(snr AS DOUBLE) AS snr, TRY_CAST(memory AS DOUBLE) AS memory, network FROM flat", "flat"
    ),
    "dedup": sql("SELECT DISTINCT sn, lte_pcc_band, lte_scc1_band, nr_pcc_band, nr_scc1_band FROM hb", "hb"),
    "plan_caps": sql(
        """SELECT c.pplan_cd, COUNT(*) AS lines, MAX(p.dl_cap) AS dl_cap, MAX(p.ul_cap) AS ul_cap
           FROM cust c LEFT JOIN caps p ON c.pplan_cd = p.pplan_cd GROUP BY c.pplan_cd""",
        "cust", "caps",
    ),
    "customer_line": sql("SELECT mdn, imsi, pplan_cd, pplan_desc, model, sn FROM lines", *LINES),
    "customer_union": sql("SELECT * FROM all_lines", "cust", "cust2", "flines", "all_lines"),
    "model_bucket": sql("SELECT model, COUNT(*) AS lines FROM flines GROUP BY model", "cust", "flines"),
    "latest_available": sql(
        """SELECT * FROM passive WHERE datadate = (SELECT MAX(datadate) FROM passive
           WHERE datadate BETWEEN DATE '2024-01-09' AND DATE '2024-01-11')""",
        "passive",
    ),
    "multi_date_union": sql(
        "SELECT * FROM passive WHERE datadate BETWEEN DATE '2023-12-31' AND DATE '2024-01-11'", "passive"
    ),
    "optional_input": sql(
        """SELECT l.sn, l.mdn, l.pplan_cd, p.dl_cap, CAST(NULL AS DOUBLE) AS dl_speed, CAST(NULL AS DOUBLE) AS passive_score
           FROM lines l LEFT JOIN caps p ON l.pplan_cd = p.pplan_cd""",
        *LINES, "caps",
    ),
    "align_union": sql(
        f"""SELECT imei, imsi, network_switches, hb_total, hb_5g,
              {digits(4, 'downtime_share', 'received_share', *TWO_DIGITS, 'nr_uptime')} FROM both_sources""",
        *BOTH,
    ),
    "second_source_only": sql(
        f"""SELECT imei, imsi, heartbeats, network_switches, {digits(6, 'db_nr_rsrp', 'db_nr_snr', 'db_lte_snr')}
            FROM second_source""",
        "hb", "first_ids", "new_hb", "second_source",
    ),
    "landed_extract": sql(
        """SELECT o_orderkey, mdn, created_at, download_result, upload_result, latency
           FROM (SELECT *, strptime(created, '%b %d, %Y %I:%M:%S %p') AS created_at FROM speedtest)
           WHERE status <> 'FAILED' AND created_at > TIMESTAMP '2024-01-01 00:00:00'
           AND created_at <= TIMESTAMP '2024-01-11 00:00:00'""",
        "speedtest",
    ),
    "counter_increments": sql(
        f"""SELECT sn, {', '.join(added(c) for c in FAILURES)}
            FROM (SELECT *, {lags(FAILURES)} FROM hb WINDOW w AS (PARTITION BY sn ORDER BY service_uptime, event_id))
            GROUP BY sn""",
        "hb",
    ),
    "counter_resets": sql("SELECT * FROM falls ORDER BY resets DESC, sn LIMIT 20", "hb", "falls"),
    "switch_summary": sql(summary("network_switches", "switches"), "hb", "switches"),
    "reset_summary": sql(summary("resets", "falls"), "hb", "falls"),
    "network_switches": sql("SELECT * FROM switches", "hb", "switches"),
    "uptime_stalls": sql(
        f"""SELECT sn, CAST(SUM(CASE WHEN service_uptime = p THEN 1 ELSE 0 END) AS BIGINT) AS uptime_stalls
            FROM (SELECT *, lag(service_uptime) OVER (PARTITION BY sn ORDER BY service_uptime, event_id) AS p
                  FROM hb WHERE {KNOWN}) GROUP BY sn""",
        "hb",
    ),
    "running_changes": sql(
        """SELECT sn, ts, event_id, service_downtime, change,
             CAST(SUM(change) OVER (PARTITION BY sn ORDER BY ts NULLS FIRST, event_id) AS BIGINT) AS changes_so_far
           FROM (SELECT *, CASE WHEN service_downtime <>
                             lag(service_downtime) OVER (PARTITION BY sn ORDER BY ts NULLS FIRST, event_id)
                           THEN 1 ELSE 0 END AS change FROM hb_timed)""",
        "hb_timed",
    ),
    "failure_ratios": sql(
        f"SELECT sn, {', '.join('sum_' + c for c in PAIR_COUNTERS)}, {digits(8, *PAIRS)} FROM ratios", "hb", "ratios"
    ),
    "one_device_timeline": sql(
        """SELECT sn, ts, event_id, service_downtime FROM hb WHERE sn = 'SN0000000007' ORDER BY sn, ts, event_id""", "hb"
    ),
    "date_fold": sql(
        "SELECT * FROM passive WHERE datadate BETWEEN DATE '2024-01-03' AND DATE '2024-01-06'", "passive"
    ),
    "device_timeline": sql(
        "SELECT sn, ts, event_id, service_downtime, service_uptime, current_network FROM hb ORDER BY sn, ts, event_id", "hb"
    ),
    "availability": sql(f"SELECT sn, {AVAIL_OUT}, availability_category FROM avail", *AVAIL),
    "modem_crashes": sql("SELECT * FROM crashes", "modem_event", "crashes"),
    "hourly_availability": sql(
        f"""SELECT sn, "date", hr, crashes, {AVAIL_OUT},
              {ladder('availability_score', P.AVAILABILITY_LADDER)} AS availability_category FROM avail_hour_score""",
        "hb", "modem_event", "hb_hour", "crashes", "service_hour", "service_crash", "avail_hour_score",
    ),
    "crash_inner": sql(
        f"""SELECT a.*, {ladder('availability_score', P.AVAILABILITY_LADDER)} AS availability_category
            FROM (SELECT sn, "date", hr, crashes, {AVAIL_OUT} FROM avail_hour_score) a WHERE crashes > 0""",
        "hb", "modem_event", "hb_hour", "crashes", "service_hour", "service_crash", "avail_hour_score",
    ),
    "link_capacity": sql(
        "SELECT * FROM capacity", "hb", *LINES, "caps", "records_any", "records_line", "cap_score", "capacity"
    ),
    "link_capacity_strict": sql("SELECT * FROM strict", "hb", "records_all", "strict"),
    "passive_throughput": sql(
        f"SELECT sn, mdn, dl_cap, {digits(6, 'dl_speed')}, passive_score FROM parts",
        *LINES, "passive", "speedtest", "caps", "speeds", "tests", "parts",
    ),
    "passive_peak": sql("SELECT * FROM peak", "cust", "passive", "flines_first", "caps_first", "peak"),
    "speedtest_avg": sql(
        f"SELECT mdn, {digits(6, 'download_result', 'upload_result')} FROM tests_odd", "speedtest_odd", "tests_odd"
    ),
    "hourly_throughput": sql(
        f"""SELECT sn, mdn, passive_score, throughput_score, {ladder('throughput_score', P.THROUGHPUT_LADDER)} AS throughput_category
            FROM (SELECT *, {rnd('passive_score', 2)} AS throughput_score FROM parts)""",
        *THR[:-2],
    ),
    "throughput_score": sql(
        "SELECT sn, mdn, passive_score, download_score, upload_score, throughput_score, throughput_category FROM thr", *THR
    ),
    "weighted_mean": sql(
        f"""SELECT sn, mdn, {rnd(weighted({'passive_score': 1, 'download_score': 2, 'upload_score': 5}), 4)} AS mean
            FROM parts""",
        *THR[:-2],
    ),
    "score_categories": sql(
        f"""SELECT sn, mdn, as_throughput, as_capacity, as_availability, {number('as_availability')} AS number,
              {ladder(f"(({number('as_throughput')}) + ({number('as_capacity')})) / 2e0", P.OVERALL_LADDER)} AS of_mean
            FROM (SELECT sn, mdn, {ladder('download_score', P.THROUGHPUT_LADDER)} AS as_throughput,
                    {ladder('passive_score', P.CAPACITY_LADDER)} AS as_capacity,
                    {ladder('passive_score', P.AVAILABILITY_LADDER)} AS as_availability FROM parts)""",
        *THR[:-2],
    ),
    "overall_score": sql(f"SELECT {OVERALL_OUT} FROM overall", *OVERALL_CTES),
    "overall_score_raw": sql(
        f"""SELECT *, {rnd(weighted({'availability_score': 5, 'capacity_score': 2, 'throughput_score': 1}), 2)} AS score
            FROM (SELECT a.sn, k.imsi, k.mdn, k.model, k.device_model, k.throughput_score, s.capacity_score, a.availability_score
                  FROM (SELECT *, {rnd(weighted(THROUGHPUT), 2)} AS throughput_score
                        FROM (SELECT p.*, {capped('(t.download_result / p.dl_cap)')} AS download_score,
                                {capped('(t.upload_result / p.ul_cap)')} AS upload_score
                              FROM peak p LEFT JOIN tests t ON p.mdn = t.mdn)) k
                  JOIN strict s ON k.imsi = s.imsi JOIN avail a ON s.sn = a.sn)""",
        "cust", "passive", "speedtest", "flines_first", "caps_first", "peak", "tests", *AVAIL, "records_all", "strict",
    ),
    "model_subset": sql(
        f"SELECT {OVERALL_OUT} FROM overall WHERE model IN ({quoted(P.SUBSET_MODELS)})", *OVERALL_CTES
    ),
    "enrich_location": sql(
        """SELECT o.sn, o.mdn, o.score, o.score_category, l.state, l.county, f.firmware FROM overall o
           LEFT JOIN (SELECT DISTINCT * FROM location) l ON o.sn = l.sn
           LEFT JOIN (SELECT DISTINCT * FROM firmware) f ON o.sn = f.sn""",
        *OVERALL_CTES, "location", "firmware",
    ),
    "newest_firmware": sql(
        """SELECT l.sn, l.mdn, p.state, p.county, f.firmware FROM lines l
           LEFT JOIN (SELECT DISTINCT * FROM location) p ON l.sn = p.sn
           LEFT JOIN (SELECT sn, 'fw-' || CAST(MAX(CAST(substring(firmware, 4) AS INT)) AS VARCHAR) AS firmware
                      FROM firmware GROUP BY sn) f ON l.sn = f.sn""",
        *LINES, "location", "firmware",
    ),
    "signal_average": sql(f"SELECT sn, {digits(6, *MEANS)}, received FROM signal", "hb", "plausible", "signal"),
    "network_share": sql(
        "SELECT sn, channel_records, nr_records, lte_records, nr_share, lte_share FROM signal", "hb", "plausible", "signal"
    ),
    "received_share": sql("SELECT sn, received, received_share FROM signal", "hb", "plausible", "signal"),
    "device_features": sql(
        f"""SELECT sn, imsi, downtime_changes, uptime_changes, network_switches, nr_share, lte_share, received_share,
              {digits(6, 'downtime_share', *PAIRS, *MEANS)} FROM devices""",
        *DEVICES,
    ),
    "usage_features": sql(
        f"""SELECT DISTINCT imsi, mdn, lte_total_mb, nr_total_mb, nr_usage_percentage,
              {rnd('lte_total_mb + nr_total_mb', 6)} AS data_usage, {rnd('sqrt(lte_total_mb + nr_total_mb)', 6)} AS sqrt_data_usage
            FROM usage""",
        "usage",
    ),
    "reset_counts": sql(
        """SELECT m.mdn, m.sn, coalesce(r.n, 0) AS reset_count FROM sn_map m
           LEFT JOIN (SELECT sn, COUNT(*) AS n FROM reset_log GROUP BY sn) r ON m.sn = r.sn""",
        "sn_map", "reset_log",
    ),
    "feature_join": sql(
        f"""SELECT sn, mdn, model, pplan_cd, nr_usage_percentage, download_result, upload_result, latency, network_switches,
              received_share, avg_cqi, avg_memory_free, {', '.join(PAIRS)}, reset_count, hb_total, hb_5g, cust_id, ecpd_profile_id,
              {digits(4, 'data_usage', 'sqrt_data_usage', 'downtime_share', 'nr_uptime', 'rsrp', 'snr')} FROM features""",
        *FEATURES,
    ),
    "plan_signal": sql(
        f"""SELECT l.sn, l.mdn, l.pplan_cd, {rnd(by_plan('db_nr_rsrp', 'db_lte_rsrp'), 6)} AS rsrp,
              {rnd(by_plan('db_nr_snr', 'db_lte_snr'), 6)} AS snr FROM signal s JOIN lines l ON s.sn = l.sn""",
        "hb", "plausible", "signal", *LINES,
    ),
    "percentile_by_group": sql(
        f"SELECT * FROM {percentiles('line_tests', 'model', 'download_result', 'latency')}", *TESTS
    ),
    "scale_percentile": sql(
        f"""SELECT x.o_orderkey, {piecewise('x.download_result', *of('m', 'download_result'))} AS scaled_download_result,
              {piecewise('x.upload_result', *of('p', 'upload_result'))} AS scaled_upload_result,
              {piecewise('x.latency', *of('p', 'latency'), reverse=True)} AS scaled_latency
            FROM line_tests x
            JOIN {percentiles('line_tests', 'model', 'download_result')} m ON x.model = m.model
            JOIN {percentiles('line_tests', 'model, pplan_cd', 'upload_result', 'latency')} p
              ON x.model = p.model AND x.pplan_cd = p.pplan_cd""",
        *TESTS,
    ),
    "scale_percentile_hist": sql(
        f"""SELECT x.o_orderkey, x.datadate, {piecewise('x.dl_speed', *of('h', 'dl_speed'), middle=60.0)} AS scaled_dl_speed
            FROM passive x JOIN {percentiles("(SELECT * FROM passive WHERE datadate BETWEEN DATE '2024-01-06' AND DATE '2024-01-10')", 'device_model', 'dl_speed')} h
              ON x.device_model = h.device_model""",
        "passive",
    ),
    "scale_manual": sql(
        f"""SELECT x.o_orderkey, {piecewise('x.download_result', 'd.lo', 'd.mid', 'd.hi')} AS scaled_download_result,
              {piecewise('x.upload_result', 'u.lo', 'u.mid', 'u.hi')} AS scaled_upload_result
            FROM line_tests x LEFT JOIN download_limits d ON x.pplan_cd = d.pplan_cd
            LEFT JOIN upload_limits u ON x.pplan_cd = u.pplan_cd""",
        *TESTS, "download_limits", "upload_limits",
    ),
    "scale_shift": sql(
        f"""SELECT x.o_orderkey, {clamp(rnd('(x.latency + (50e0 - m.latency_mid))', 2))} AS scaled_latency,
              {clamp(rnd('(50e0 + m.download_result_mid - x.download_result)', 2))} AS scaled_download_result
            FROM line_tests x JOIN {percentiles('line_tests', 'model', 'latency', 'download_result')} m ON x.model = m.model""",
        *TESTS,
    ),
    "scale_raw": sql(
        f"""SELECT o_orderkey, {rnd('upload_result', 2)} AS scaled_upload_result,
              {clamp(rnd('(100e0 - latency * 1.5e0)', 2))} AS scaled_latency FROM line_tests""",
        *TESTS,
    ),
    "group_scores": sql(
        f"""SELECT sn, mdn, pplan_cd, download_result, upload_result, latency, {', '.join(GROUPS)},
              {rnd(weighted({g: 0.2 for g in GROUPS}), 2)} AS final_score
            FROM (SELECT *, {', '.join(f'{rnd(weighted(w), 2)} AS {g}' for g, w in GROUPS.items())} FROM scaled)""",
        *FEATURES, "download_limits", "scaled",
    ),
    "capacity_by_model": sql(
        f"""SELECT model, {rnd('AVG(share)', 6)} AS avg_share, {rnd('MIN(share)', 6)} AS min_share,
              {rnd('MAX(share)', 6)} AS max_share,
              {', '.join(f'{rnd(f"quantile_disc(share, {p / 100})", 6)} AS p{p}' for p in (10, 25, 50, 75, 99))},
              COUNT(DISTINCT sn) AS devices
            FROM (SELECT sn, model, AVG(({LTE_CAP} + {NW_CAP} + {CBAND_CAP}) / 218e0) AS share
                  FROM (SELECT b.sn, b.ts, b.model, SUM(lte_mhz) AS lte_mhz, SUM(nw_mhz) AS nw_mhz, SUM(cband_mhz) AS cband_mhz
                        FROM (SELECT DISTINCT sn, ts, CASE WHEN model_name IN ('ASK-NCQ1338', 'ASK-NCQ1338FA') THEN 'ASK-NCQ1338'
                                ELSE model_name END AS model, {BANDWIDTHS} FROM hb WHERE model_name IN ({quoted(P.DISTRIBUTION_MODELS)})) b
                        GROUP BY ALL) b
                  JOIN (SELECT DISTINCT sn, ts, lte_snr, nr_snr FROM hb WHERE model_name IN ({quoted(P.DISTRIBUTION_MODELS)})
                        AND lte_snr BETWEEN -10 AND 40 AND nr_snr BETWEEN -10 AND 40) s ON b.sn = s.sn AND b.ts = s.ts
                  WHERE (lte_snr <> 0 AND lte_mhz > 0) OR (nr_snr <> 0 AND nw_mhz + cband_mhz > 0)
                  GROUP BY b.sn, model) GROUP BY model""".replace("SELECT sn, model, AVG", "SELECT b.sn, model, AVG"),
        "hb",
    ),
    "column_summary": sql(
        " UNION ALL ".join(
            summary(c) for c in (
                "lte_handover_attempt_count", "lte_handover_failure_count", "nr_scg_change_count", "memory_percent_free",
            )
        ),
        "hb",
    ),
    "latest_partition": sql(
        'SELECT CAST(ts AS DATE) AS part_date, COUNT(*) AS "rows" FROM hb GROUP BY 1 ORDER BY 1 DESC LIMIT 1', "hb"
    ),
    "recent_partitions": sql("SELECT DISTINCT CAST(ts AS DATE) AS part_date FROM hb ORDER BY 1 DESC LIMIT 7", "hb"),
    "partition_freshness": sql(FRESH, "landed", "expected"),
    "partition_gaps": sql(
        GAPS, "landed", "expected",
    ),
    "partition_outages": sql(
        f"""SELECT dataset, MIN(part_date) AS first_date, MAX(part_date) AS last_date, CAST(COUNT(*) AS INT) AS days
            FROM (SELECT *, n - row_number() OVER (PARTITION BY dataset ORDER BY part_date) AS run
                  FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY part_date) AS n FROM ({DUE_DAYS})) s
                  WHERE {NOT_LANDED}) GROUP BY dataset, run""",
        "landed", "expected",
    ),
    "rows_of_landed_dates": sql(
        """SELECT event_id, sn, memory_percent_free, CAST(ts AS DATE) AS date FROM hb
           WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-04' AND DATE '2024-01-28' AND CAST(ts AS DATE) IN
             (SELECT part_date FROM landed WHERE dataset = (SELECT MIN(dataset) FROM landed))""",
        "hb", "landed",
    ),
    "latest_partitioned": sql(
        """SELECT * FROM passive WHERE datadate = (SELECT MAX(datadate) FROM passive
           WHERE datadate BETWEEN DATE '2024-01-08' AND DATE '2024-01-10')""",
        "passive",
    ),
    "rolling_devices": sql(
        """SELECT model_name, end_date, COUNT(DISTINCT sn) AS devices, true AS estimate_within_bound
           FROM (SELECT model_name, sn, CAST(unnest(generate_series(CAST(ts AS DATE), CAST(ts AS DATE) + 6, INTERVAL 1 DAY)) AS DATE) AS end_date
                 FROM hb) GROUP BY model_name, end_date""",
        "hb",
    ),
    "partition_report": sql(
        f"""SELECT f.dataset, f.newest, f.delay_days, coalesce(g.missing_days, 0) AS missing_days, coalesce(g.missing, '') AS missing
            FROM ({FRESH}) f LEFT JOIN (SELECT dataset, COUNT(*) AS missing_days,
                string_agg(CAST(part_date AS VARCHAR), ',' ORDER BY part_date) AS missing FROM ({GAPS}) GROUP BY dataset) g
            ON f.dataset = g.dataset""",
        "landed", "expected",
    ),
    "backfill_dates": sql(
        """SELECT CAST(day AS DATE) AS part_date
           FROM (SELECT unnest(generate_series(DATE '2024-01-26', DATE '2024-02-01', INTERVAL 1 DAY)) AS day)
           WHERE CAST(day AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM hb) ORDER BY 1""",
        "hb",
    ),
    "source_files": sql(
        """, rows AS (SELECT CAST(event_id AS BIGINT) AS event_id, sn, snr, memory, network FROM flat),
             times AS (SELECT event_id, ts FROM hb WHERE CAST(ts AS DATE) = DATE '2024-01-10')
           SELECT 'day' AS source, rows.* FROM rows JOIN times USING (event_id)
           UNION ALL SELECT 'hour', rows.* FROM rows JOIN times USING (event_id) WHERE hour(ts) = 5
           UNION ALL SELECT 'json_tree', * FROM rows
           -- An empty text and no text are the same in a CSV file.
           UNION ALL SELECT s, event_id, sn, snr, nullif(memory, ''), network
           FROM rows, (SELECT unnest(['csv', 'csv_tree', 'csv_paths', 'gzip_tree']) AS s) WHERE s <> 'csv' OR network = 'view'""",
        "flat", "hb",
    ),
    "sink_roundtrip": sql(
        """SELECT 'hours' AS sink, sn AS id, "date", CAST(hr AS INTEGER) AS hr, crashes AS n, CAST(NULL AS INTEGER) AS files,
             CAST(NULL AS BOOLEAN) AS refused FROM crashes
           UNION ALL SELECT s, imsi, datadate, NULL, CAST(o_orderkey AS BIGINT), CASE s WHEN 'files' THEN 3 END, CASE s WHEN 'files' THEN true END
           FROM passive, (SELECT unnest(['folder', 'files', 'subset']) AS s) WHERE s <> 'subset' OR device_model = 'M1'""",
        "modem_event", "crashes", "passive",
    ),
    "backfill_replay": sql(
        f""", dates AS (SELECT CAST(unnest(range(TIMESTAMP '2024-01-26', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS "date"),
            fallen AS (SELECT sn, CAST(ts AS DATE) AS "date", COUNT(*) AS crashes FROM modem_event
                       WHERE modem_event IS NOT NULL GROUP BY ALL),
            moved AS (SELECT sn, "date", CAST(SUM(CASE WHEN current_network <> p THEN 1 ELSE 0 END) AS BIGINT) AS network_switches
                      FROM (SELECT sn, CAST(ts AS DATE) AS "date", current_network,
                              lag(current_network) OVER (PARTITION BY sn, CAST(ts AS DATE) ORDER BY ts, event_id) AS p
                            FROM hb WHERE {ATTACHED}) GROUP BY ALL),
            tables AS (SELECT * FROM fallen FULL JOIN moved USING (sn, "date"))
            SELECT "date", sn, crashes, network_switches,
              CASE WHEN "date" IN (DATE '2024-01-27', DATE '2024-01-28') THEN 'failed' ELSE 'written' END AS first,
              CASE WHEN "date" IN (DATE '2024-01-27', DATE '2024-01-28', DATE '2024-01-29') THEN 'written' ELSE 'present' END AS second,
              'present' AS third
            FROM dates LEFT JOIN tables USING ("date")""",
        "modem_event", "hb",
    ),
    "stream_increments": sql(
        f"""SELECT sn, {', '.join(added(c) for c in FAILURES)}, COUNT(*) AS heartbeats
            FROM (SELECT *, {lags(FAILURES)} FROM hb WINDOW w AS (PARTITION BY sn ORDER BY ts, event_id)) GROUP BY sn""",
        "hb",
    ),
    "stream_hourly_availability": sql(
        f"""SELECT sn, "date", hr, crashes, n AS lines, {AVAIL_OUT},
              {ladder('availability_score', P.AVAILABILITY_LADDER)} AS availability_category
            FROM avail_hour_score LEFT JOIN (SELECT sn, COUNT(*) AS n FROM lines GROUP BY sn) USING (sn)""",
        "hb", "modem_event", "hb_hour", "crashes", "service_hour", "service_crash", "avail_hour_score", *LINES,
    ),
}
# The same percentiles, from stored sketches.
ORACLES["scale_percentile_stored"] = ORACLES["scale_percentile_hist"]
# The same rows, from payloads parsed to a VARIANT, and without the devices that no line knows.
ORACLES["json_extract_variant"] = ORACLES["json_extract"]
ORACLES["link_capacity_known"] = ORACLES["link_capacity"]
