"""From wide sheets to long time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.functions.values import num, text_if_not_number


def unpivot_long(wide: DataFrame, signals: list[str], ids: list[str]) -> DataFrame:
    """One row for each row and signal: ``ids``, channel_id, raw_value (string); null cells stay."""
    cells = wide.select(*ids, *[F.col(f"`{c}`").cast("string").alias(c) for c in signals])
    return cells.unpivot(ids, signals, "channel_id", "raw_value")


def split_value(long: DataFrame, raw: str = "raw_value") -> DataFrame:
    """``raw`` as ``value`` (double, where it is a number) and ``value_str`` (where it is other text)."""
    c = F.col(raw)
    return long.withColumns({"value": num(c), "value_str": text_if_not_number(c)}).drop(raw)


def statistics(long: DataFrame) -> DataFrame:
    """Sheet grain: n_channels, n_rows, and their product n_timeseries_rows."""
    return long.groupBy("uuid", "group").agg(
        F.countDistinct("channel_id").cast("int").alias("n_channels"),
        F.countDistinct("sample_offset").alias("n_rows"),
    ).withColumn("n_timeseries_rows", F.col("n_channels") * F.col("n_rows"))
