"""Fixed, parameterised questions over the processed catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import top_with_ties


def top_by(catalog: DataFrame, col: str = "max_torque_nm", k: int = 1) -> DataFrame:
    """G1: the products with the highest ``col``, all ties included, with their rank."""
    return top_with_ties(catalog.select("file_name", "manufacturer", "model_number", col), col, k)


def compare_by(catalog: DataFrame, cols: list[str] = ("weight_kg", "rated_voltage_v")) -> DataFrame:
    """All products side by side on ``cols``; a global sort (range-partitioned, no single task)."""
    cols = list(cols)
    return catalog.select("file_name", "manufacturer", "model_number", *cols) \
        .orderBy(*[F.col(c).asc_nulls_last() for c in cols], "file_name")


def lookup(catalog: DataFrame, model: str, cols: list[str] = ("rated_voltage_v",)) -> DataFrame:
    """Point filter on the model number (pushed to the parquet scan)."""
    return catalog.filter(F.col("model_number") == model).select("file_name", "model_number", *cols)


def above(catalog: DataFrame, col: str, threshold: float) -> DataFrame:
    """Range filter."""
    return catalog.filter(F.col(col) > threshold).select("file_name", "model_number", col)


def compatible_with(catalog: DataFrame, batteries: list[str], voltage: float | None = None) -> DataFrame:
    """Products listing one of ``batteries``; with ``voltage``, also those rated at that voltage."""
    items = F.split(F.col("compatible_batteries"), ", ")
    cond = F.exists(items, lambda b: b.isin(list(batteries)))
    if voltage is not None:
        cond = cond | (F.col("rated_voltage_v") == float(voltage))
    return catalog.filter(F.coalesce(cond, F.lit(False))) \
        .select("file_name", "model_number", "rated_voltage_v", "compatible_batteries")


def best_by_group(catalog: DataFrame, group: str = "manufacturer", col: str = "no_load_speed_high_rpm",
                  label: str = "model_number") -> DataFrame:
    """Per group the highest ``col`` and the product holding it (ties: smallest label).

    min_by/max aggregate partially on the map side, so one huge group is not one task's input.
    """
    has = catalog.filter(F.col(col).isNotNull())
    return has.groupBy(group).agg(
        F.max(col).alias(f"max_{col}"),
        F.min_by(F.col(label), F.struct((-F.col(col)).alias("k"), F.col(label).alias("l"))).alias(label),
        F.count(F.lit(1)).alias("n_products"),
    )


def spec_sheet(catalog: DataFrame, model: str, fields: list[str]) -> DataFrame:
    """All specifications of one model as (field, value) rows."""
    one = catalog.filter(F.col("model_number") == model)
    return one.select("file_name", *[F.col(f).cast("string").alias(f) for f in fields]) \
        .unpivot(["file_name"], list(fields), "field", "value")


def at_value(catalog: DataFrame, col: str, value: float, show: str) -> DataFrame:
    """Products with ``col`` = value, sorted by ``show``."""
    return catalog.filter(F.col(col) == value).select("file_name", "model_number", col, show) \
        .orderBy(F.col(show).asc_nulls_last(), "file_name")


def lightest(catalog: DataFrame, weight: str = "weight_kg", cols: list[str] = ("compatible_batteries",)) -> DataFrame:
    """The lightest product (ties: smallest file name) and its batteries; a global partial aggregate."""
    key = F.struct(F.col(weight).alias("w"), F.col("file_name").alias("f"))
    picked = ["file_name", "model_number", weight, *cols]
    return catalog.filter(F.col(weight).isNotNull()).agg(
        *[F.min_by(F.col(c), key).alias(c) for c in picked])


def differences(catalog: DataFrame, models: list[str], fields: list[str]) -> DataFrame:
    """Fields whose values differ between the given models, one column per model.

    NULL counts as a value of its own. Pivot values are given, so no extra pass finds them.
    """
    sub = catalog.filter(F.col("model_number").isin(models)) \
        .select(F.col("model_number").alias("__model"), *[F.col(f).cast("string").alias(f) for f in fields])
    long = sub.unpivot(["__model"], list(fields), "field", "value")
    varying = long.groupBy("field").agg(
        F.countDistinct(F.coalesce(F.col("value"), F.lit("\u0000null"))).alias("n"))
    varying = varying.filter(F.col("n") > 1).select("field")
    return long.join(varying, "field", "left_semi").groupBy("field").pivot("__model", models) \
        .agg(F.first("value"))
