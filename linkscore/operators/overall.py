"""The overall score of a line, from throughput, capacity and availability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore import params as P
from linkscore.functions.columns import category_number, number_category, weighted_mean

PARTS = ("availability", "capacity", "throughput")


def overall_score(throughput: DataFrame, capacity: DataFrame, availability: DataFrame) -> DataFrame:
    """Full join of the three parts: capacity has one row per (sn, mdn), availability one per sn.

    The score is the weighted mean of the category numbers of the parts that exist, its category
    that number's name. No part repeats a key beyond its lines, so plain full joins have no skew.
    """
    joined = throughput.join(capacity, ["sn", "mdn"], "full").join(availability, "sn", "full")
    numbers = joined.withColumns({f"{p}_number": category_number(F.col(f"{p}_category")) for p in PARTS})
    score = F.round(weighted_mean({f"{p}_number": w for p, w in P.OVERALL_WEIGHTS.items()}), 2)
    return numbers.withColumn("score", score).withColumn("score_category", number_category(F.col("score")))


def overall_score_raw(throughput: DataFrame, capacity: DataFrame, availability: DataFrame) -> DataFrame:
    """First version: inner joins (capacity per sn and imsi) and the weighted mean of raw scores."""
    joined = throughput.join(capacity, "imsi").join(availability, "sn")
    weights = {f"{p}_score": w for p, w in P.OVERALL_WEIGHTS.items()}
    return joined.withColumn("score", F.round(weighted_mean(weights), 2))


def model_subset(scores: DataFrame, models: Sequence[str] = P.SUBSET_MODELS) -> DataFrame:
    return scores.where(F.col("model").isin(*models))


def enrich_location(
    scores: DataFrame, locations: DataFrame, firmware: DataFrame, newest_only: bool = False
) -> DataFrame:
    """Add location and firmware: a row for each distinct version of a device, or for the newest one."""
    versions = firmware.select("sn", "firmware").distinct()
    if newest_only:
        # The numbers in a version are compared as numbers, so 10 is newer than 9.
        numbers = F.transform(F.regexp_extract_all("firmware", F.lit(r"(\d+)")), lambda x: x.cast("decimal(38,0)"))
        versions = versions.groupBy("sn").agg(F.max_by("firmware", F.struct(numbers, F.col("firmware"))).alias("firmware"))
    return scores.join(locations.distinct(), "sn", "left").join(versions, "sn", "left")
