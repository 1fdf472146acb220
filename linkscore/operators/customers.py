"""Customer lines, serial mappings and plan tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkscore import params as P


def without_check_digit(imei: Column) -> Column:
    return F.substring(imei, F.lit(1), F.length(imei) - F.lit(1))


def last_word(name: Column) -> Column:
    return F.element_at(F.split(F.trim(name), " "), -1)


def model_bucket(model: Column, kept: Sequence[str] = P.KEPT_MODELS, other: str = "Others") -> Column:
    """The model when it is one of ``kept``, else ``other`` (also for a null model)."""
    return F.when(model.isin(*kept), model).otherwise(F.lit(other))


def alias_model(model: Column, aliases: Mapping[str, str] = P.MODEL_ALIASES) -> Column:
    renamed = model
    for old, new in aliases.items():
        renamed = F.when(model == old, F.lit(new)).otherwise(renamed)
    return renamed


def customer_line(customers: DataFrame, serials: DataFrame) -> DataFrame:
    """Line attributes at device grain: a line with two serial numbers gives two rows."""
    lines = customers.select(
        "imsi", "mdn", "pplan_cd", "pplan_desc", last_word(F.col("device_prod_nm")).alias("model")
    ).distinct()
    return lines.join(serials.select("mdn", "sn").distinct(), "mdn")


def feature_line(customers: DataFrame, kept: Sequence[str] = P.KEPT_MODELS) -> DataFrame:
    """Line attributes of the feature table, with rare models in one bucket."""
    model = model_bucket(last_word(F.col("device_prod_nm")), kept)
    return customers.select(
        "cust_id",
        "ecpd_profile_id",
        without_check_digit(F.col("imei_raw")).alias("imei"),
        "imsi",
        "mdn",
        "pplan_cd",
        model.alias("model"),
    ).distinct()


def second_source_line(customers: DataFrame, label: str) -> DataFrame:
    """Lines of a second source that knows only the ids; ``label`` stands for every attribute."""
    return customers.select(
        F.lit(label).alias("cust_id"),
        F.lit(label).alias("ecpd_profile_id"),
        without_check_digit(F.col("imei_raw")).alias("imei"),
        "imsi",
        "mdn",
        F.lit(label).alias("pplan_cd"),
        F.lit(label).alias("model"),
    ).distinct()


def customer_union(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def lines_per_plan(customers: DataFrame, plans: DataFrame) -> DataFrame:
    """Every plan in use with its caps (null for an unknown plan) and its number of lines."""
    counts = customers.groupBy("pplan_cd").agg(F.count("*").alias("lines"))
    return counts.join(F.broadcast(plans), "pplan_cd", "left")
