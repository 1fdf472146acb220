"""Parameters of the scores. The constants below are fixed values: results depend on them."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values ---------------------------------------------------------------------------

# A counter that was never read reports this value.
COUNTER_SENTINEL = 184467440737095

# Network codes that mean "not attached".
INVALID_NETWORKS = ("-", "0", "12", "13", "None")

# Downlink channel ranges (NR-ARFCN) that mean the serving cell is 5G.
NR_CHANNEL_RANGES = (
    (2070833, 2084999),
    (2229167, 2279166),
    (386000, 398000),
    (173800, 178800),
    (743333, 795000),
    (422000, 440000),
    (620000, 680000),
)

# Plan code, downlink cap and uplink cap in Mbps.
PLAN_CAPS = (
    ("38365", 50, 6),
    ("39425", 1500, 75),
    ("39428", 1500, 75),
    ("46798", 10, 5),
    ("46799", 25, 5),
    ("48390", 10, 5),
    ("48423", 25, 5),
    ("48445", 50, 6),
    ("50010", 50, 6),
    ("50011", 50, 6),
    ("50044", 300, 20),
    ("50055", 300, 20),
    ("50116", 1500, 75),
    ("50117", 1500, 75),
    ("50127", 300, 20),
    ("50128", 300, 20),
    ("50129", 300, 20),
    ("50130", 300, 20),
    ("51219", 150, 10),
    ("53617", 300, 20),
    ("65655", 50, 6),
    ("65656", 50, 6),
    ("67567", 400, 20),
    ("67568", 1500, 75),
    ("67571", 100, 10),
    ("67576", 300, 20),
    ("67577", 50, 6),
    ("67584", 50, 6),
    ("75560", 1500, 75),
    ("75561", 300, 20),
    ("75565", 50, 6),
)

# The older caps, used by the first cellular score.
PLAN_CAPS_FIRST = (
    ("38365", 50, 6),
    ("50010", 50, 6),
    ("50011", 50, 6),
    ("50044", 400, 20),
    ("50116", 1500, 75),
    ("50127", 300, 20),
    ("50128", 300, 20),
    ("50129", 300, 20),
    ("50130", 300, 20),
    ("65655", 50, 6),
    ("65656", 50, 6),
    ("67567", 400, 20),
    ("67568", 1500, 75),
    ("67571", 100, 10),
    ("67576", 300, 20),
    ("67577", 50, 6),
    ("67584", 50, 6),
    ("75560", 1500, 75),
    ("75561", 300, 20),
    ("75565", 50, 6),
)

# Plans whose signal is read from the 5G measure, and from the 4G measure.
NR_PLANS = (
    "27976", "39425", "39428", "50044", "50055", "50116", "50117", "50127", "50128", "50129",
    "50130", "51219", "53617", "67567", "67568", "67571", "67576",
)
LTE_PLANS = (
    "38365", "46798", "46799", "48390", "48423", "48445", "50010", "50011", "65655", "65656",
    "67577", "67584",
)

# Device models kept by name; every other model counts as "Others".
KEPT_MODELS = (
    "ARC-XCI55AX", "ASK-NCQ1338FA", "WNC-CR200A", "ASK-NCQ1338", "FSNO21VA", "NCQ1338E",
    "ASK-NCM1100E", "ASK-NCM1100", "Others",
)
# The same list in the first cellular score.
KEPT_MODELS_FIRST = ("ASK-NCQ1338", "ASK-NCQ1338FA", "WNC-CR200A", "CR1000A", "CR1000B")
# Models whose scores are also written on their own.
SUBSET_MODELS = ("ASK-NCQ1338", "ASK-NCQ1338FA", "ARC-XCI55AX", "WNC-CR200A", "ASK-NCM1100")
# Models in the capacity distribution, and the name two of them are reported under.
DISTRIBUTION_MODELS = ("XCI55AX", "ASK-NCQ1338", "ASK-NCQ1338FA", "ASK-NCM1100", "WNC-CR200A")
MODEL_ALIASES = {"ASK-NCQ1338FA": "ASK-NCQ1338"}

# Plan code and its (low, mid, high) thresholds for a download or upload test, in Mbps.
DOWNLOAD_THRESHOLDS = {
    "38365": (0.0, 50.0, 75.0),
    "39425": (0.0, 1000.0, 1500.0),
    "39428": (0.0, 1000.0, 1500.0),
    "46798": (0.0, 10.0, 15.0),
    "46799": (0.0, 25.0, 40.0),
    "48390": (0.0, 10.0, 15.0),
    "48423": (0.0, 25.0, 40.0),
    "48445": (0.0, 50.0, 75.0),
    "50010": (0.0, 50.0, 75.0),
    "50011": (0.0, 50.0, 75.0),
    "50044": (0.0, 300.0, 400.0),
    "50055": (0.0, 300.0, 400.0),
    "50116": (0.0, 1000.0, 1500.0),
    "50117": (0.0, 1000.0, 1500.0),
    "50127": (0.0, 300.0, 400.0),
    "50128": (0.0, 300.0, 400.0),
    "50129": (0.0, 300.0, 400.0),
    "50130": (0.0, 300.0, 400.0),
    "51219": (0.0, 100.0, 150.0),
    "53617": (0.0, 200.0, 300.0),
    "65655": (0.0, 50.0, 75.0),
    "65656": (0.0, 50.0, 75.0),
    "67567": (0.0, 300.0, 400.0),
    "67568": (0.0, 1000.0, 1500.0),
    "67571": (0.0, 100.0, 150.0),
    "67576": (0.0, 300.0, 400.0),
    "67577": (0.0, 50.0, 75.0),
    "67584": (0.0, 50.0, 75.0),
}
UPLOAD_THRESHOLDS = {
    "38365": (0.0, 5.0, 8.0),
    "39425": (0.0, 50.0, 70.0),
    "39428": (0.0, 50.0, 70.0),
    "46798": (0.0, 10.0, 15.0),
    "46799": (0.0, 25.0, 40.0),
    "48390": (0.0, 6.0, 10.0),
    "48423": (0.0, 6.0, 10.0),
    "48445": (0.0, 6.0, 10.0),
    "50010": (0.0, 5.0, 8.0),
    "50011": (0.0, 5.0, 8.0),
    "50044": (0.0, 300.0, 400.0),
    "50055": (0.0, 300.0, 400.0),
    "50116": (0.0, 1000.0, 1500.0),
    "50117": (0.0, 1000.0, 1500.0),
    "50127": (0.0, 20.0, 30.0),
    "50128": (0.0, 20.0, 30.0),
    "50129": (0.0, 20.0, 30.0),
    "50130": (0.0, 20.0, 30.0),
    "51219": (0.0, 20.0, 30.0),
    "53617": (0.0, 20.0, 30.0),
    "65655": (0.0, 5.0, 8.0),
    "65656": (0.0, 5.0, 8.0),
    "67567": (0.0, 300.0, 400.0),
    "67568": (0.0, 1000.0, 1500.0),
    "67571": (0.0, 100.0, 150.0),
    "67576": (0.0, 300.0, 400.0),
    "67577": (0.0, 50.0, 75.0),
    "67584": (0.0, 50.0, 75.0),
}

# Score category ladders: lower bound (inclusive) of each category, best first; below all is Poor.
THROUGHPUT_LADDER = ((80.0, "Excellent"), (60.0, "Good"), (30.0, "Fair"))
CAPACITY_LADDER = ((80.0, "Excellent"), (50.0, "Good"), (30.0, "Fair"))
AVAILABILITY_LADDER = ((100.0, "Excellent"), (99.77, "Good"), (97.22, "Fair"))
OVERALL_LADDER = ((3.5, "Excellent"), (2.5, "Good"), (1.5, "Fair"))
LOWEST_CATEGORY = "Poor"
CATEGORY_NUMBERS = {"Poor": 1, "Fair": 2, "Good": 3, "Excellent": 4}

# Weights of the weighted means.
THROUGHPUT_WEIGHTS = {"passive_score": 28.0, "download_score": 4.0, "upload_score": 1.0}
HOURLY_THROUGHPUT_WEIGHTS = {"passive_score": 28.0}
OVERALL_WEIGHTS = {"availability": 5.0, "capacity": 2.0, "throughput": 1.0}
GROUP_WEIGHTS = {
    "data_score": {
        "scaled_nr_uptime": 0.25,
        "scaled_nr_usage_percentage": 0.25,
        "scaled_sqrt_data_usage": 0.5,
    },
    "speed_score": {
        "scaled_upload_result": 0.3,
        "scaled_download_result": 0.4,
        "scaled_latency": 0.3,
    },
    "signal_score": {"scaled_rsrp": 0.35, "scaled_avg_cqi": 0.3, "scaled_snr": 0.35},
    "failure_score": {
        "scaled_lte_rach_failure_ratio": 0.5,
        "scaled_lte_handover_failure_ratio": 0.25,
        "scaled_nr_scg_change_failure_ratio": 0.25,
    },
    "device_score": {
        "scaled_network_switches": 0.4,
        "scaled_received_share": 0.1,
        "scaled_reset_count": 0.4,
        "scaled_avg_memory_free": 0.1,
    },
}
FINAL_WEIGHTS = {
    "data_score": 0.2,
    "speed_score": 0.2,
    "signal_score": 0.2,
    "failure_score": 0.2,
    "device_score": 0.2,
}

# Days without an expected landing (weekday feeds).
HOLIDAYS = (
    "2023-11-23", "2023-11-24", "2023-11-27", "2023-12-25", "2023-12-26", "2023-12-28",
    "2024-01-01", "2024-01-02", "2024-01-15", "2024-01-16", "2024-05-27", "2024-07-01",
    "2024-07-02", "2024-07-03", "2024-07-04",
)

# --- parameter objects ----------------------------------------------------------------------

# How the rows of a key are cut for ordered work: span of a number, length of a text's prefix (a time
# down to its hour), leading bits of a tie-break.
SLICE_SPAN = 3600
SLICE_TEXT = 13
TIE_BITS = 8


@dataclass(frozen=True)
class AvailabilityParams:
    """Seconds of assumed downtime per event, over a period of ``period_s`` seconds."""

    rrc_failure_s: float = 1.0
    rach_failure_s: float = 0.01
    downtime_change_s: float = 300.0
    crash_s: float = 90.0
    period_s: float = 86400.0
    penalty: float = 20.0
    round_digits: int = 2


@dataclass(frozen=True)
class CapacityParams:
    """Bandwidths in MHz and the SNR span that maps to 0..100 % of them."""

    min_snr: float = -10.0
    max_snr: float = 40.0
    carrier_mhz: int = 20
    cband: int = 77
    cband_wide_channels: tuple[int, int] = (646667, 653329)
    cband_both_mhz: int = 160
    cband_wide_mhz: int = 100
    cband_narrow_mhz: int = 60
    cband_secondary_mhz: int = 80
    cband_factor: float = 0.8
    snr_offset: float = 11.0
    cband_snr_offset: float = 10.0
    snr_span: float = 41.0
    best_mhz: float = 218.0
    full_plan_mbps: float = 150.0
    null_snr: str = "full"  # "full" scores a missing SNR as the best one, "zero" as none


@dataclass(frozen=True)
class ScaleSpec:
    """How one feature becomes a 0..100 value.

    ``how`` is ``percentile``, ``manual``, ``shift`` or ``raw``; ``by`` are the grouping columns
    of the percentiles; ``thresholds`` maps a plan code to (low, mid, high) for ``manual``.
    """

    feature: str
    how: str = "percentile"
    by: tuple[str, ...] = ("model",)
    reverse: bool = False
    middle: float = 50.0
    factor: float = 1.0
    thresholds: dict = field(default_factory=dict, hash=False)


MODEL_AND_PLAN = ("model", "pplan_cd")

SCALE_SPECS = (
    ScaleSpec("avg_cqi"),
    ScaleSpec("db_nr_rsrp"),
    ScaleSpec("db_lte_rsrp"),
    ScaleSpec("rsrp"),
    ScaleSpec("db_lte_snr"),
    ScaleSpec("db_nr_snr"),
    ScaleSpec("snr"),
    ScaleSpec("sqrt_data_usage"),
    ScaleSpec("upload_result", by=MODEL_AND_PLAN),
    ScaleSpec("latency", by=MODEL_AND_PLAN, reverse=True),
    ScaleSpec("download_result", how="manual", thresholds=DOWNLOAD_THRESHOLDS),
    ScaleSpec("avg_memory_free", how="shift"),
    ScaleSpec("received_share", how="raw"),
    ScaleSpec("nr_usage_percentage", how="raw"),
    ScaleSpec("nr_uptime", how="raw"),
    ScaleSpec("downtime_share", how="raw", reverse=True),
    ScaleSpec("network_switches", how="raw", reverse=True),
    ScaleSpec("reset_count", how="raw", reverse=True),
    ScaleSpec("lte_rach_failure_ratio", how="raw", reverse=True),
    ScaleSpec("lte_handover_failure_ratio", how="raw", reverse=True),
    ScaleSpec("nr_scg_change_failure_ratio", how="raw", reverse=True),
)

# The standard heartbeat count of one device and day.
HEARTBEATS_PER_DAY = 230
