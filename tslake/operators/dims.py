"""Experiment and signal dimensions with stable ids, and incremental appends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.operators.lookup import many


def latest(df: DataFrame, keys: list[str], order: str = "_bronze_ingested_at") -> DataFrame:
    """The most recent row of each key: by ingestion, then by the converter's run, then the greatest; whatever the partitions."""
    first = [c for c in (order, "_run") if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in first]
    return df.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("_row")).select(*keys, "_row.*").select(df.columns)


def version_columns(facts: DataFrame) -> list[str]:
    """Columns of bronze by which versions of a sheet follow each other."""
    return [c for c in ("_bronze_ingested_at", "_run") if c in facts.columns]


def sheet_versions(facts: DataFrame, sheets: DataFrame) -> DataFrame:
    """(uuid, group, _last, version) of ``sheets``: the latest of their versions, as a struct, and their latest batch.

    Versions are few rows a sheet; facts are neither sorted nor shuffled for them.
    """
    seen = facts.select("uuid", "group", "_bronze_batch", *version_columns(facts)).distinct()
    last = F.max(F.struct(*version_columns(facts))).alias("_last")
    return restricted(seen, many(sheets), ["uuid", "group"]).groupBy("uuid", "group").agg(last, F.max("_bronze_batch").cast("long").alias("version"))


def latest_version(facts: DataFrame, keys: list[str], order: str = "_bronze_ingested_at") -> DataFrame:
    """All rows of the most recent ingestion (and of it, the last run) of each key; null keys stay as they are.

    The versions are few rows a sheet; only they are aggregated.
    """
    first = [c for c in (order, "_run") if c in facts.columns]
    if not first:
        return facts
    version = F.struct(*first)
    last = facts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(version).alias("_last"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return facts.join(last, [*same, version.eqNullSafe(F.col("_last"))], "left_semi")


def dim_experiment(sheets: DataFrame, filemeta: DataFrame) -> DataFrame:
    """(experiment_id, uuid, group, series): one row for each sheet whose file has a series. Null keys take no part."""
    series = filemeta.filter("uuid is not null and series is not null").select("uuid", "series").distinct()
    keys = sheets.filter("uuid is not null and `group` is not null").select("uuid", "group").distinct()
    return keys.join(series, "uuid").select(F.xxhash64("uuid", "group").alias("experiment_id"), "uuid", "group", "series")


def sheets_without_file(sheets: DataFrame, filemeta: DataFrame) -> DataFrame:
    """(uuid, group) of sheets whose file is unknown or has no series."""
    return sheets.select("uuid", "group").distinct().join(filemeta.filter("series is not null").select("uuid").distinct(), "uuid", "left_anti")


def dim_signal(channel: DataFrame, experiments: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row for each channel of each experiment, with its canonical name: the mapping's for (series, raw name), else the channel id.

    Names are compared trimmed; of entries that clash the first in order counts. The mapping is the configuration of a few series; its size decides whether Spark broadcasts it.
    """
    entries = mapping.select("series", F.trim("raw_channel").alias("_raw"), "mapped_std_channel").groupBy("series", "_raw").agg(F.min("mapped_std_channel").alias("mapped_std_channel"))
    known = latest(channel, ["uuid", "group", "channel_id"]).join(experiments.select("experiment_id", "uuid", "group", "series"), ["uuid", "group"])
    named = known.withColumn("_raw", F.trim("raw_channel")).join(entries, ["series", "_raw"], "left")
    return named.select(
        F.xxhash64("uuid", "group", "channel_id").alias("signal_id"), "experiment_id", "uuid", "group", "channel_id", "raw_channel",
        F.coalesce("mapped_std_channel", "channel_id").alias("std_channel"), "unit", "series", "column_index",
    )


def std_channel_conflicts(signals: DataFrame) -> DataFrame:
    """(experiment_id, std_channel, n, channel_ids, raw_channels) where several channels of an experiment have one canonical name."""
    return signals.groupBy("experiment_id", "std_channel").agg(
        F.countDistinct("channel_id").alias("n"), F.sort_array(F.collect_set("channel_id")).alias("channel_ids"), F.sort_array(F.collect_set("raw_channel")).alias("raw_channels")
    ).filter("n > 1")


def check_std_channels(signals: DataFrame) -> None:
    """Raises if a canonical name is ambiguous within an experiment; the message shows up to ten cases."""
    rows = std_channel_conflicts(signals).orderBy("experiment_id", "std_channel").limit(10).collect()
    if rows:
        raise ValueError("ambiguous channels: " + "; ".join(f"{r['experiment_id']}/{r['std_channel']}: {', '.join(r['channel_ids'])}" for r in rows))


def new_or_changed(signals: DataFrame, existing: DataFrame) -> DataFrame:
    """Signals that aren't in ``existing``, or are there with another raw name, unit or position."""
    told = ["raw_channel", "unit", "column_index"]
    before = existing.select("signal_id", *[F.col(c).alias(f"_was_{c}") for c in told])
    other = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in told])
    return signals.join(before.withColumn("_there", F.lit(True)), "signal_id", "left").filter(F.col("_there").isNull() | other).select(signals.columns)


def only_new(candidates: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose keys aren't in ``existing``."""
    return candidates if existing is None else candidates.join(existing.select(*keys).distinct(), keys, "left_anti")


def restricted(facts: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``facts`` whose keys are in ``keys``."""
    return facts.join(keys.select(*on).distinct(), on, "left_semi")
