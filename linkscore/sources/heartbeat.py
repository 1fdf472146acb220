"""Heartbeat ingest: raw rows with a JSON payload become typed columns with plain names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields of the payload and their types, as devices send them.
PAYLOAD_FIELDS = """
`MDN` string, `SIMState` int, `IMSI` string, `IMEI` string, `SwV` string, `Status` boolean,
`5GUptimeTimestamp` string, `5GDowntimeTimestamp` string,
`B1MeasurementConfigurationStatus` boolean, `B1MeasurementConfigurationBands` string,
`SNR` string, `CurrentNetwork` string, `HomeRoam` string, `MCC` string, `MNC` string,
`CellID` int, `PCellID` string, `TotalBytesReceived` int, `TotalBytesSent` int,
`TotalPacketReceived` int, `TotalPacketSent` int, `MCS` string, `PathLoss` int, `BRSRP` double,
`EARFCN_DL` int, `EARFCN_UL` int, `5GEARFCN_DL` string, `5GEARFCN_UL` string,
`PUCCH_TX_PWR` double, `CQI` int, `Rank` int, `MaxMTUSize` int, `LTERadioLinkFailureCount` int,
`LTERACHAttemptCount` int, `LTERACHFailureCount` int, `RRCConnectTime` string,
`RRCConnectRequestCount` int, `RRCConnectFailureCount` int, `NRSCGChangeCount` int,
`NRSCGChangeFailureCount` int, `LTEHandOverAttemptCount` int, `LTEHandOverFailureCount` int,
`LTEPDSCHThroughput` double, `LTEPDSCHPeakThroughput` double, `LTEPUSCHThroughput` double,
`LTEPUSCHPeakThroughput` double, `RxPDCPBytes` int, `TxPDCPBytes` int, `4GRSRP` int,
`4GRSRQ` int, `4GSignal` int, `5GPCI` string, `RSRQ` double, `5GSNR` double,
`NRPDSCHInitBLER` int, `NRPUSCHInitBLER` int, `GPSEnabled` boolean, `GPSAltitude` string,
`GPSLatitude` string, `GPSLongitude` string, `5GModemTempThreshold` string,
`5GNRSub6AntennaTempThreshold` string, `4GAntennaTempThreshold` string, `ModemTemp` string,
`5GNRSub6AntennaTemp` string, `4GAntennaTemp` string, `4GTempFallback` boolean,
`4GTempFallbackCause` int, `5GServiceThermalDegradation` boolean,
`5GServiceThermalDegradationCause` int, `ModemLoggingEnabled` boolean, `4GPccBand` int,
`4GScc1Band` int, `4GScc2Band` int, `4GScc3Band` int, `5GPccBand` int, `5GScc1Band` int,
`ServiceUptime` string, `ServiceDowntime` string, `ServiceUptimeTimestamp` string,
`ServiceDowntimeTimestamp` string, `5GUW_Allowed` boolean, `5GNRRadioLinkFailureCount` int,
`5GNRRACHAttemptCount` int, `5GNRRACHFailureCount` int, `5GNRRRCConnectTime` string,
`5GNRRRCConnectRequestCount` int, `5GNRRRCConnectFailureCount` int,
`5GNRHandOverAttemptCount` int, `5GNRHandOverFailureCount` int, `5GNRPDSCHThroughput` double,
`5GNRPUSCHThroughput` double, `5GNRPDSCHPeakThroughput` double, `5GNRPUSCHPeakThroughput` double,
`5GNRRxPDCPBytes` int, `5GNRTxPDCPBytes` int, `NRSCGFailureCount` int, `CPUUsage` string,
`Uptime` string, `RebootCause` string, `Manufacturer` string, `ModelName` string, `FmV` string,
`HwV` string, `MemoryAvail` string, `MemoryPercentFree` double, `ipv4_ip` string, `ipv6_ip` string
"""

KNOWN_FIELDS = re.findall(r"`([^`]+)`", PAYLOAD_FIELDS)

# The payload fields the scores use, with their column name and type after ingest.
USED_FIELDS = {
    "MDN": ("mdn", "string"),
    "IMSI": ("imsi", "string"),
    "IMEI": ("imei", "string"),
    "ModelName": ("model_name", "string"),
    "SNR": ("lte_snr", "double"),
    "5GSNR": ("nr_snr", "double"),
    "4GRSRP": ("lte_rsrp", "double"),
    "BRSRP": ("nr_rsrp", "double"),
    "CQI": ("cqi", "double"),
    "5GEARFCN_DL": ("nr_earfcn_dl", "bigint"),
    "4GPccBand": ("lte_pcc_band", "bigint"),
    "4GScc1Band": ("lte_scc1_band", "bigint"),
    "4GScc2Band": ("lte_scc2_band", "bigint"),
    "4GScc3Band": ("lte_scc3_band", "bigint"),
    "5GPccBand": ("nr_pcc_band", "bigint"),
    "5GScc1Band": ("nr_scc1_band", "bigint"),
    "ServiceUptime": ("service_uptime", "bigint"),
    "ServiceDowntime": ("service_downtime", "bigint"),
    "CurrentNetwork": ("current_network", "string"),
    "MemoryPercentFree": ("memory_percent_free", "double"),
    "LTERACHAttemptCount": ("lte_rach_attempt_count", "bigint"),
    "LTERACHFailureCount": ("lte_rach_failure_count", "bigint"),
    "LTEHandOverAttemptCount": ("lte_handover_attempt_count", "bigint"),
    "LTEHandOverFailureCount": ("lte_handover_failure_count", "bigint"),
    "NRSCGChangeCount": ("nr_scg_change_count", "bigint"),
    "NRSCGChangeFailureCount": ("nr_scg_change_failure_count", "bigint"),
    "RRCConnectFailureCount": ("rrc_connect_failure_count", "bigint"),
}

# Fixed value: the device id inside a row key such as "6223-<id>_<mac>".
SERIAL_PATTERN = "-([A-Za-z0-9]+)"


def serial_number(rowkey: Column) -> Column:
    """The device id of a row key, null when there is none."""
    return F.nullif(F.regexp_extract(rowkey, SERIAL_PATTERN, 1), F.lit(""))


def typed(value: Column, kind: str) -> Column:
    """The value as this type; what does not parse, and NaN, is null."""
    cast = value.try_cast(kind)
    return F.when(~F.isnan(cast), cast) if kind in ("double", "float") else cast


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns, leaving the others alone; text that does not parse becomes null."""
    return df.select([typed(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def content_digest(*columns: str | Column) -> Column:
    """A digest of columns, names and nulls included: the same for copies only."""
    return F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256))


def parse_payload(df: DataFrame, payload: str, fields: str = PAYLOAD_FIELDS) -> DataFrame:
    """Rows that have a payload, with its ``fields`` as columns; malformed text gives nulls."""
    others = [c for c in df.columns if c != payload]
    parsed = df.where(F.col(payload).isNotNull()).withColumn("_p", F.from_json(payload, fields.strip()))
    return parsed.select(*others, "_p.*")


def payload_texts(df: DataFrame, fields: Mapping[str, str], payload: str = "payload") -> DataFrame:
    """Rows that have a payload, with fields of it as text, from one parse to a VARIANT.

    ``fields`` are new names and the payload's. Malformed text, an absent field and a JSON null give null.
    """
    others = [c for c in df.columns if c != payload]
    parsed = df.where(F.col(payload).isNotNull()).withColumn("_v", F.try_parse_json(payload))
    return parsed.select(*others, *[F.try_variant_get("_v", f'$["{old}"]', "string").alias(new) for new, old in fields.items()])


def payload_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The fields that payloads hold: whether the schema knows them and the scores use them, in how many
    rows they occur and in how many as text. One parse a payload; fields are counted before the shuffle.
    """
    parsed = df.select(F.try_parse_json(payload).alias("_v")).where("_v IS NOT NULL AND schema_of_variant(_v) LIKE 'OBJECT%'")
    each = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    counts = each.groupBy(F.col("key").alias("field")).agg(
        F.count("*").alias("rows"), F.count_if(F.schema_of_variant("value") == "STRING").alias("text_rows")
    )
    return counts.select("field", F.col("field").isin(KNOWN_FIELDS).alias("known"), F.col("field").isin(list(USED_FIELDS)).alias("used"), "rows", "text_rows")


def ingest_heartbeats(
    raw: DataFrame, payload: str = "payload", rowkey: str = "rowkey", ts_ms: str = "ts", keep: Sequence[str] = ()
) -> DataFrame:
    """Typed heartbeats: device id, timestamp and the used payload fields, without copies of a row.

    Copies are rows with equal row key, time and ``keep``, and equal in every payload field, used or
    not. The whole payload enters a digest; only the digest and the used fields are shuffled.
    """
    parsed = raw.where(F.col(payload).isNotNull()).select(
        F.col(rowkey).alias("_rowkey"), F.col(ts_ms).alias("_ms"), *keep, F.from_json(payload, PAYLOAD_FIELDS.strip()).alias("_p")
    )
    rows = parsed.select(
        "_rowkey",
        "_ms",
        *keep,
        content_digest("_p.*").alias("_digest"),
        *[typed(F.col(f"_p.`{old}`"), kind).alias(new) for old, (new, kind) in USED_FIELDS.items()],
    ).dropDuplicates(["_rowkey", "_ms", *keep, "_digest"])
    return rows.select(
        serial_number(F.col("_rowkey")).alias("sn"),
        F.timestamp_millis("_ms").alias("ts"),
        *keep,
        *[new for new, _ in USED_FIELDS.values()],
    )


def with_event_id(df: DataFrame) -> DataFrame:
    """Add a number that depends on the row's content only: the last tie-break of every order."""
    return df.withColumn("event_id", F.xxhash64(*df.columns))


def modem_events(raw: DataFrame, event: str = "modem_event", rowkey: str = "rowkey", ts_ms: str = "ts") -> DataFrame:
    """Modem crash rows of the raw table."""
    return raw.where(F.col(event).isNotNull()).select(
        serial_number(F.col(rowkey)).alias("sn"), F.timestamp_millis(ts_ms).alias("ts"), F.col(event).alias("modem_event")
    )


def flat_heartbeats(raw: DataFrame, ts_ms: str = "ts", keep: Sequence[str] = ("sn",)) -> DataFrame:
    """The same typed columns from a source whose payload is already flat text columns.

    Copies are rows that are equal in every column of the source.
    """
    present = {old: spec for old, spec in USED_FIELDS.items() if old.lower() in {c.lower() for c in raw.columns}}
    absent = {old: spec for old, spec in USED_FIELDS.items() if old not in present}
    rows = raw.select(
        content_digest("*").alias("_digest"),
        *keep,
        F.timestamp_millis(F.col(ts_ms).try_cast("bigint")).alias("ts"),
        *[typed(F.col(f"`{old}`"), kind).alias(new) for old, (new, kind) in present.items()],
        *[F.lit(None).cast(kind).alias(new) for new, kind in absent.values()],
    )
    return rows.dropDuplicates(["_digest"]).drop("_digest")
