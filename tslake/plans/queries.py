"""The registered queries: each applies operators to a whole given table."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.functions import values
from tslake.operators import derived, dims, dq, gold, grid, longform, maintain, serving, tracking, validate
from tslake.layout import Layout
from tslake.plans import adapters as A
from tslake.plans import pipeline
from tslake.sources import stored
from tslake.schemas import FILE_TRACKING
from tslake.sources.readers import channel_mapping, list_files, read_grid, read_table, with_extensions
from tslake.sources.writers import append_new, export_tables, shared_folder, write_file, write_lines, write_table, written
from tslake.streaming.bronze import ingest, ingest_all
from tslake.streaming.quality import RESULT, check_stream

#: Short column names of the metrics in query results.
METRIC_NAMES = {
    "Energy Efficiency": "dm1", "Δp Anolyte": "dm2", "Current density": "dm3", "Faradaic Efficiency of CO and H2": "dm4", "Flow CO out": "dm5", "Flow H2 out": "dm6", "Flow O2 out": "dm7",
    "Flow CO2 out, total": "dm8", "Flow CO2 out, anode": "dm9", "Flow CO2 out, cathode": "dm10", "CO/H2 ratio recalculated": "dm11", "Single Pass Conversion Efficiency": "dm12",
}
NATURAL = ["uuid", "group", "series", "std_channel"]


def new_folder(spark: SparkSession) -> str:
    """A new folder beside the session's checkpoints."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _r(*names: str) -> list[F.Column]:
    return [F.round(n, 6).alias(n) for n in names]


def _bins(bins: DataFrame, signals: DataFrame) -> DataFrame:
    keys = signals.select("signal_id", "uuid", "group")
    return bins.join(keys, "signal_id").select(*NATURAL, "elapsed_bin_s", *_r("elapsed_time_s"), F.unix_micros("timestamp").alias("ts_us"), *_r("value_mean", "value_min", "value_max"), "value_count")


def agg_1min(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, signals, bins = A.event_bins(spark, sf_dir)
    return _bins(bins, signals)


def _tier(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    _, signals, bins = A.event_bins(spark, sf_dir)
    return _bins(gold.coarsen(bins, seconds), signals)


def agg_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tier(spark, sf_dir, 900)


def agg_60min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tier(spark, sf_dir, 3600)


def _facts(facts: DataFrame, signals: DataFrame) -> DataFrame:
    return facts.join(signals.select("signal_id", "uuid", "group"), "signal_id").select(*NATURAL, "sample_offset", *_r("elapsed_time_s", "value"), F.unix_micros("timestamp").alias("ts_us"), "value_str")


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = A.events_long(spark, sf_dir)
    signals = A.event_signals(spark, long)
    return _facts(gold.gold_fact(long, signals), signals)


def gold_fact_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the experiments that aren't stored yet; those of sheet g0 are."""
    long = A.events_long(spark, sf_dir)
    signals = A.event_signals(spark, long)
    new = dims.only_new(signals, signals.filter("`group` = 'g0'"), ["experiment_id"])
    return _facts(gold.gold_fact(dims.restricted(long, new, ["uuid", "group"]), new), signals)


def agg_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of the experiments that have facts only; sheets g1 have bins already."""
    long, signals, bins = A.event_bins(spark, sf_dir)
    have = bins.join(signals.filter("`group` = 'g1'").select("signal_id"), "signal_id", "left_semi")
    return _bins(gold.missing_bins(gold.gold_fact(long, signals), have), signals)


def experiment_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    long, signals, bins = A.event_bins(spark, sf_dir)
    out = serving.experiment_index(bins, signals, A.event_files(long))
    times = ["start_timestamp", "end_timestamp", "source_last_modified", "ingested_at"]
    figures = ["start_time_s", "end_time_s", "duration_s", "avg_stack_voltage_v", "peak_current_density_ma_cm2", "avg_energy_efficiency_pct", "avg_fe_co_pct", "avg_fe_h2_pct", "avg_spce_pct"]
    return out.select("series", "uuid", "group", "channel_count", "total_data_points", "source_file_name", "source_file_size", *_r(*figures), *[F.unix_micros(t).alias(t) for t in times])


def channel_catalog_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, signals, bins = A.event_bins(spark, sf_dir)
    own = bins.filter("std_channel <> 'signup'")
    return serving.channel_catalog_experiment(signals, own).join(signals.select("signal_id", "uuid", "group"), "signal_id").select(*NATURAL, "unit", "has_data")


def channel_catalog_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.channel_catalog_series(A.event_signals(spark, A.events_long(spark, sf_dir)))


def serve_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, signals, bins = A.event_bins(spark, sf_dir)
    return _bins(serving.serve(gold.coarsen(bins, 3600), "S0", ["Stack Voltage", "purchase"]), signals)


def serve_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bins of a channel of one experiment: user 4's sheet g0."""
    _, signals, bins = A.event_bins(spark, sf_dir)
    one = signals.filter("uuid = '4' and `group` = 'g0'").select("experiment_id").distinct()
    return _bins(dims.restricted(serving.serve(bins, "S0", ["Stack Voltage"]), one, ["experiment_id"]), signals)


SIGNALS = ["current", "v_stack", "fe_co", "fe_h2", "fe_o2", "co2_in", "ratio", "p_in", "p_out"]


def unpivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = A.lineitem_wide(spark, sf_dir).withColumn("p_out", F.when(F.col("p_out") > 0, F.col("p_out")))
    out = longform.split_value(longform.unpivot_long(wide, SIGNALS, ["uuid", "group", "sample_offset"]))
    return out.select("uuid", "group", "sample_offset", "channel_id", *_r("value"), "value_str")


def value_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.round("value", 3).cast("string")).when(F.col("event_id") % 7 == 1, F.concat(F.col("event_id").cast("string"), F.lit("d"))).otherwise(F.col("props"))
    return longform.split_value(A.table(spark, sf_dir, "events").select("event_id", raw.alias("raw_value"))).select("event_id", *_r("value"), "value_str")


def derived_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = derived.derived_wide(A.lineitem_wide(spark, sf_dir))
    return wide.select("uuid", "group", "sample_offset", *[F.round(f"`{k}`", 6).alias(v) for k, v in METRIC_NAMES.items()])


def plausibility_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = derived.derived_long(A.lineitem_wide(spark, sf_dir))
    unit = F.create_map(*[F.lit(x) for kv in derived.UNITS.items() for x in kv])
    name = F.create_map(*[F.lit(x) for kv in METRIC_NAMES.items() for x in kv])
    out = derived.clip_percents(long.withColumn("unit", unit[F.col("channel_id")]))
    return out.filter("unit = '%'").select("uuid", "group", "sample_offset", name[F.col("channel_id")].alias("metric"), *_r("value"))


def sheet_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longform.statistics(longform.unpivot_long(A.lineitem_wide(spark, sf_dir), SIGNALS, ["uuid", "group", "sample_offset"]))


def channel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = longform.unpivot_long(A.lineitem_wide(spark, sf_dir), SIGNALS, ["uuid", "group", "sample_offset"]).select("uuid", "group", "channel_id").distinct()
    return grid.channel_rows(long.select("*", F.col("channel_id").alias("raw_channel"), F.when(F.startswith("channel_id", F.lit("fe")), "%").alias("unit")), "channel_id")


def dim_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = A.events_long(spark, sf_dir)
    out = dims.dim_experiment(long, A.event_files(long).withColumn("series", F.when(F.col("uuid").cast("long") % 10 != 3, F.col("series"))))
    return out.groupBy("uuid", "group", "series").agg(F.countDistinct("experiment_id").alias("ids"))


def dim_experiment_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = A.events_long(spark, sf_dir)
    return dims.sheets_without_file(long, A.event_files(long).filter("cast(uuid as bigint) % 10 <> 3"))


def dim_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.event_signals(spark, A.events_long(spark, sf_dir))
    return out.select(*NATURAL, "channel_id", "raw_channel", "unit", "column_index")


def dim_signal_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ambiguous names under a mapping that also calls clicks of series S0 a stack voltage."""
    long = A.events_long(spark, sf_dir)
    more = A.literal_mapping(spark, [("S0", "click", "Stack Voltage")])
    mapping = A.mapping(spark).filter("not (series = 'S0' and raw_channel = 'click')").unionByName(more)
    signals = dims.dim_signal(A.event_channels(long), dims.dim_experiment(long, A.event_files(long)), mapping)
    out = dims.std_channel_conflicts(signals).join(signals.select("experiment_id", "uuid", "group").distinct(), "experiment_id")
    return out.select("uuid", "group", "std_channel", "n", F.array_join("channel_ids", ",").alias("channels"))


def time_text() -> F.Column:
    """An event's time in one of seven formats, or not at all."""
    f, k = lambda p: F.date_format("ts", p), F.col("event_id") % 8
    out = F.lit("garbage")
    for i, p in enumerate(values.TIMESTAMP_FORMATS):
        out = F.when(k == i, f(p)).otherwise(out)
    return out


def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = A.table(spark, sf_dir, "events").select("event_id", time_text().alias("raw"))
    return e.select("event_id", "raw", F.unix_micros(values.parse_ts(F.col("raw"))).alias("ts_us"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event samples with gaps and faults in their times."""
    e = A.events_long(spark, sf_dir)
    return e.withColumn("timestamp", F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 13 == 0, "garbage").otherwise(F.col("timestamp"))).drop("series", "props")


KEYED = ["uuid", "group", "sample_offset", "channel_id", "rule_id"]


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.evaluate_rule(_checked(spark, sf_dir), dq.DEFAULT_RULES[0]).select(*KEYED, "event_id", "severity", "status")


def dq_timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = dq.Rule("ts_parse", "parse", "timestamp", "timestamp_parseable", params={"channel_regex": "^(view|click)$"})
    return dq.evaluate_rule(_checked(spark, sf_dir), rule).select(*KEYED, "event_id", "timestamp")


def dq_duplicate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = dq.Rule("dup", "dup", "channel_id", "no_duplicate_key", params={"key_columns": ["sample_offset", "channel_id"]})
    return dq.evaluate_rule(A.lineitem_long(spark, sf_dir), rule).select(*KEYED, "timestamp", *_r("value"))


def dq_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.evaluate_rule(A.lineitem_long(spark, sf_dir).dropDuplicates(["uuid", "group", "sample_offset", "channel_id"]).withColumn("timestamp", F.lpad((F.col("sample_offset") * 7919 % 86400).cast("string"), 5, "0")), dq.Rule("mono", "mono", "timestamp", "monotonic_increasing", params={"partition_by": ["uuid", "group"], "order_by": ["sample_offset", "channel_id"], "format": None})).select(*KEYED, "timestamp")


def _failures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Event samples twice for some, and what fails the default rules."""
    e = _checked(spark, sf_dir)
    e = e.unionByName(e.filter("event_id % 17 = 0"))
    return e, dq.evaluate_rules(e, [*dq.DEFAULT_RULES[:2], dq.Rule(dq.DEFAULT_RULES[2].rule_id, dq.DEFAULT_RULES[2].rule_name, "channel_id", "no_duplicate_key", params=dq.DEFAULT_RULES[2].params, is_blocking=True)])


def dq_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failures = _failures(spark, sf_dir)
    return dq.observed(failures, 7).groupBy(*KEYED, "is_blocking", "dq_batch_id").agg(F.count("*").alias("n"), F.max(F.when(F.col("timestamp").isNotNull(), F.col("observed_value"))).alias("observed"))


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.summarize(_failures(spark, sf_dir)[1]).drop("summarized_at")


def dq_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, failures = _failures(spark, sf_dir)
    return dq.clean(e, dq.invalid_keys(failures, blocking_only=True)).select("event_id", "sample_offset", "is_valid")


def dq_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, failures = _failures(spark, sf_dir)
    return dq.flag(e, dq.invalid_keys(failures, blocking_only=False)).select("event_id", "sample_offset", "is_valid")


def dq_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, failures = _failures(spark, sf_dir)
    return dq.delete(e, dq.invalid_keys(failures, blocking_only=False)).select("event_id", "sample_offset")


def _stored(spark: SparkSession, sf_dir: str, change) -> DataFrame:
    """The event samples that ``dq_all`` looks at, as a stored table that is changed in place."""
    e, failures = _failures(spark, sf_dir)
    path = f"{new_folder(spark)}/samples"
    e.repartitionByRange(16, "uuid", "group").write.parquet(path)
    change(spark, path, dq.invalid_keys(failures, blocking_only=False), dq.KEYS)
    return read_table(spark, path)


def dq_flag_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, stored.flag_rows).select("event_id", "sample_offset", F.coalesce("is_valid", F.lit(True)).alias("is_valid"))


def dq_delete_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, stored.delete_rows).select("event_id", "sample_offset")


def file_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", values.file_uuid(F.col("url")).alias("file_uuid"))


def sanitize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", values.sanitize_name(F.col("url")).alias("name"))


def series_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "pages").select("page_id", values.series_from_path(F.col("url")).alias("series"))


def unit_row_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.unit_rows(A.lineitem_cells(spark, sf_dir))


def unique_channel_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as columns named by status."""
    head = A.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uuid"), F.lit("s").alias("group"), F.col("o_orderkey").alias("col_idx"), F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("name"))
    return grid.unique_names(head).select("uuid", "col_idx", "channel_id")


def datetime_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grid.stored_rows(A.lineitem_rows(spark, sf_dir))
    head = written(grid.headers(rows))
    few = head.count() <= grid.BROADCAST_COLUMNS
    return grid.merge_date_time(rows, head, grid.date_time_pairs(rows, head, few=few), few)


def structural_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = grid.headers(A.lineitem_cells(spark, sf_dir))
    return grid.structural(grid.canonical(head, None)).select("uuid", "group", "col_idx", "channel_id", "raw_channel", "unit", "role")


def sheet_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.normalise(A.lineitem_rows(spark, sf_dir))["timeseries"].select("uuid", "group", "sample_offset", "timestamp", "elapsed_time_s", "channel_id", *_r("value"), "value_str")


def sheet_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.normalise(A.lineitem_rows(spark, sf_dir))["channel"]


def tracking_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = A.order_files(spark, sf_dir)
    return tracking.new_files(files, A.order_tracking(files)).select("blob_path", "file_size")


def tracking_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files since the high watermark, where files of the last 60 days haven't been tracked in their present version."""
    files = A.order_files(spark, sf_dir)
    known = A.order_tracking(files)
    return tracking.new_files(files, known.withColumn("last_modified", F.col("last_modified") - F.expr("interval 60 days")), strict_watermark=True).select("blob_path", "file_size")


def tracking_exhausted(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = A.order_files(spark, sf_dir)
    return tracking.without_exhausted(files, A.order_tracking(files)).select("blob_path", "retry_count")


def tracking_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = A.order_files(spark, sf_dir)
    none = F.lit(None).cast("string")
    open_ = A.table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("file_size"))  # pending ones have no result yet
    good = F.month("last_modified") <= 6
    results = files.join(open_, "file_size").select(
        "blob_path", "file_name", "file_size", none.alias("file_uuid"), "last_modified", F.when(good, "SUCCESS").otherwise("FAILED").alias("status"),
        none.alias("output_paths"), F.when(~good, "new").alias("error_message"), F.lit(2.0).alias("duration_seconds"),
    )
    return tracking.upsert(A.order_tracking(files), results).select("blob_path", "file_size", "status", "error_message", "retry_count", "duration_seconds")


def tracking_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.status_counts(A.order_files(spark, sf_dir))


def validate_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders that aren't known, where only those with money count as known."""
    return validate.orphans(A.table(spark, sf_dir, "orders"), A.table(spark, sf_dir, "customer").filter("c_acctbal > 0"), ["o_custkey"], ["c_custkey"])


def validate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, li = (A.table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    checks = [
        validate.row_count("orders", o), validate.row_count("lineitem", li), validate.required_columns(spark, "orders", o.columns, ["o_orderkey", "o_custkey", "o_missing"]),
        validate.orphan_check("lineitem->orders", li.withColumnRenamed("l_orderkey", "k"), o.withColumnRenamed("o_orderkey", "k"), ["k"]),
        validate.orphan_check("orders->customer", o.withColumnRenamed("o_custkey", "k"), c.filter("c_acctbal > 0").withColumnRenamed("c_custkey", "k"), ["k"]),
    ]
    return validate.report(checks)


def extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose address ends in one of some extensions; orders listed as files of three kinds."""
    files = A.order_files(spark, sf_dir).withColumn("blob_path", F.concat("blob_path", F.when(F.col("file_size") % 3 == 0, ".BAK").when(F.col("file_size") % 3 == 1, "").otherwise(".XLS")))
    return with_extensions(files.withColumn("extension", values.extension(F.col("blob_path"))), ("xlsx", ".xls")).select("blob_path", "extension")


def filemeta(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = A.order_files(spark, sf_dir).select(values.file_uuid(F.col("blob_path")).alias("uuid"), F.lit("Sheet1").alias("group"), F.col("blob_path").alias("file_path"), "file_size", "last_modified")
    return grid.filemeta(files).drop("ingested_timestamp").withColumn("last_modified", F.unix_micros("last_modified"))


def sheet_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers under a mapping by series, where a supplier's parity is the series."""
    head = grid.headers(A.lineitem_cells(spark, sf_dir))
    odd = F.regexp_extract("uuid", "([0-9]+)", 1).cast("long") % 2
    files = head.select("uuid", odd.alias("_odd")).distinct().select(F.col("uuid").alias("file_uuid"), F.concat(F.lit("lab/S"), F.col("_odd").cast("string"), F.lit("/"), "uuid").alias("blob_path"))
    mapping = A.literal_mapping(spark, [("S0", " ch ", "Cell Voltage"), ("S0", "Efficiency", "Energy Efficiency"), ("S1", "CURRENT", "Stack Current"), ("S1", "current", "Z"), ("S9", "Note", "none")])
    return grid.canonical(head, grid.file_mapping(files, mapping)).select("uuid", "group", "col_idx", "raw_channel", "std_channel")


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of orders: of an order's lines those that were shipped last."""
    li = A.lineitem_long(spark, sf_dir).withColumn("_bronze_ingested_at", F.to_timestamp("timestamp"))
    return dims.latest_version(li, ["sample_offset"]).select("uuid", "group", "sample_offset", "channel_id", *_r("value"))


def dense_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of ten minutes with many samples each: a supplier's line items, 20 seconds apart."""
    return _dense(spark, sf_dir).transform(_dense_shown)


def dense_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of an hour from those of ten minutes."""
    return gold.coarsen(_dense(spark, sf_dir), 3600).transform(_dense_shown)


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = A.lineitem_wide(spark, sf_dir)
    own = w.select(
        F.col("group").alias("series"), F.lit("V").alias("std_channel"), F.regexp_extract("uuid", "([0-9]+)", 1).cast("long").alias("experiment_id"), F.lit(1).cast("long").alias("signal_id"), "sample_offset",
        F.when(F.col("current") < 48, F.col("sample_offset") * 20.0).alias("elapsed_time_s"), F.timestamp_seconds(F.col("sample_offset") * 20).alias("timestamp"), F.when(F.col("fe_co") > 5, F.col("v_stack")).alias("value"),
    )
    return gold.bin_samples(own, 600)


def _dense_shown(bins: DataFrame) -> DataFrame:
    """Means are shown as totals: of values with six digits a mean may lie on the edge between two roundings, a total can't."""
    total = F.round(F.col("value_mean") * F.col("value_count"), 6).alias("value_total")
    return bins.select("series", "experiment_id", "elapsed_bin_s", *_r("elapsed_time_s"), F.unix_micros("timestamp").alias("ts_us"), total, *_r("value_min", "value_max"), "value_count")


def _dropped(spark: SparkSession, sf_dir: str, ingest_between) -> str:
    """Events written in two drops, each taken up by a run of its own."""
    folder = new_folder(spark)
    long = A.events_long(spark, sf_dir).drop("series", "props", "event_id")
    for k in (0, 1):
        long.filter(f"sample_offset % 2 = {k}").write.mode("append").parquet(f"{folder}/in")
        ingest_between(folder)
    return folder


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tslake.schemas import TIMESERIES

    folder = _dropped(spark, sf_dir, lambda f: ingest(spark, f"{f}/in", f"{f}/bronze", f"{f}/checkpoint", TIMESERIES))
    return read_table(spark, f"{folder}/bronze").select("uuid", "group", "sample_offset", "channel_id", "timestamp", *_r("elapsed_time_s", "value"))


def stream_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of views, whose text is always missing, and all others, over both drops: what a stream finds and what it keeps."""
    rules = [dq.Rule("view_null", "view", "value_str", "not_null", params={"channel_id": "view"}, is_blocking=True)]
    folder = _dropped(spark, sf_dir, lambda f: check_stream(spark, f"{f}/in", f"{f}/out", f"{f}/checkpoint", rules, "write_clean_table"))
    failed = read_table(spark, f"{folder}/out/fact_timeseries_dq_result").groupBy("uuid", "group").agg(F.count("*").alias("failed"))
    good = read_table(spark, f"{folder}/out/fact_timeseries_clean").groupBy("uuid", "group").agg(F.count("*").alias("valid"))
    return failed.join(good, ["uuid", "group"], "full").select("uuid", "group", F.coalesce("failed", F.lit(0)).alias("failed"), F.coalesce("valid", F.lit(0)).alias("valid"))


#: Files that a batch of a drop takes up, and bytes of their row groups: so that more tasks than a batch has files read it.
BATCH, ROW_GROUP = 4, 8 << 20


def _remembered(spark: SparkSession, drops: list[DataFrame], rule: dq.Rule) -> DataFrame:
    """Failures of a rule over samples that come in several drops, each checked by a run of its own."""
    folder = new_folder(spark)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in drops[0].schema.fields)
    for drop in drops:
        drop.write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(f"{folder}/in")
        check_stream(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", [rule], schema=schema, batch_files=BATCH, memory=f"{folder}/memory")
    return read_table(spark, f"{folder}/out/{RESULT}")


def stream_dq_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``dq_duplicate_key`` finds, where line items come in drops by year of shipment."""
    rule = dq.Rule("dup", "dup", "channel_id", "no_duplicate_key", params={"key_columns": ["sample_offset", "channel_id"]})
    samples = A.lineitem_long(spark, sf_dir)
    files = -(-samples.rdd.getNumPartitions() // (3 * BATCH)) * BATCH  # a drop of a third of the rows has a third of the files, for full batches
    drops = [samples.filter(F.pmod(F.year("timestamp"), F.lit(3)) == k).coalesce(files) for k in range(3)]
    return _remembered(spark, drops, rule).select(*KEYED, "timestamp", *_r("value"))


def stream_dq_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values that fall below the one before in their sheet, where events come in drops by tens of days."""
    rule = dq.Rule("fall", "fall", "value", "monotonic_increasing", params={"format": None})
    samples = A.events_long(spark, sf_dir).drop("series", "props", "event_id").withColumn("elapsed_time_s", F.col("elapsed_time_s").cast("double"))
    day = F.datediff(F.to_timestamp("timestamp"), F.min(F.to_timestamp("timestamp")).over(W.partitionBy("uuid", "group")))
    parted = written(samples.withColumn("_part", F.least(F.floor(day / 10), F.lit(2))), ["_part"])  # numbered once for all drops
    drops = [parted.filter(F.col("_part") == k).drop("_part").repartition("uuid", "group") for k in range(3)]  # a sheet's samples of a drop come in one file
    return _remembered(spark, drops, rule).select(*KEYED, *_r("value"))


def gold_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bins after the jobs have run twice: sheets g1 came a second time, with doubled values and without their clicks."""
    layout, long = Layout(f"{new_folder(spark)}/lake"), written(A.events_long(spark, sf_dir).drop("props", "event_id"))  # numbered once
    later = long.filter("`group` = 'g1' and channel_id <> 'click'").withColumn("value", F.col("value") * 2)
    for k, samples in enumerate((long, later)):
        files = A.event_files(samples)
        tables = {
            "timeseries": samples.drop("series"), "filemeta": files, "channel": A.event_channels(samples),
            "statistics": samples.groupBy("uuid", "group").agg(F.lit(1).alias("n_channels"), F.count("*").alias("n_rows"), F.count("*").alias("n_timeseries_rows")),
        }
        export_tables(tables, f"{layout.base}/converted", f"{k}")
        ingest_all(spark, f"{layout.base}/converted", f"{layout.base}/bronze", f"{layout.base}/_checkpoints")
        pipeline.silver_job(spark, layout, A.mapping(spark))
        pipeline.gold_job(spark, layout)
    return _bins(read_table(spark, layout.table("gold", "timeseries_agg_1min")), read_table(spark, layout.table("silver", "dim_signal")).hint("shuffle_hash"))


def jobs_gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold tables after all jobs have run over the line items' sheets: what a row is of, its key and its figures."""
    layout, cells = Layout(f"{new_folder(spark)}/lake"), A.lineitem_rows(spark, sf_dir)
    path = F.concat(F.lit("lab/S"), (F.regexp_extract("uuid", "([0-9]+)", 1).cast("long") % 2).cast("string"), F.lit("/"), "uuid", F.lit(".xlsx"))
    files = cells.select("uuid").distinct().select(
        path.alias("blob_path"), F.concat("uuid", F.lit(".xlsx")).alias("file_name"), F.regexp_extract("uuid", "([0-9]+)", 1).cast("long").alias("file_size"),
        F.col("uuid").alias("file_uuid"), F.to_timestamp(F.lit("2024-05-06")).alias("last_modified"),
    )
    mapping = A.literal_mapping(spark, [("S0", "Stack Voltage", "Stack Voltage"), ("S1", "Efficiency", "Energy Efficiency")])
    pipeline.run_pipeline(spark, layout, files, cells, mapping)
    signals = read_table(spark, layout.table("silver", "dim_signal")).select("signal_id", "uuid", "group").hint("shuffle_hash")  # as many as sheets have columns
    sheets = signals.select(F.xxhash64("uuid", "group").alias("experiment_id"), "uuid", "group").distinct()
    none = lambda kind: F.lit(None).cast(kind)

    def rows(name: str, at, n, total, text=none("string")) -> DataFrame:
        t = read_table(spark, layout.table("gold", name))
        by = (signals, "signal_id") if "signal_id" in t.columns else (sheets, "experiment_id")
        channel = F.col("std_channel") if "std_channel" in t.columns else none("string")
        return (t if "uuid" in t.columns else t.join(*by)).select(F.lit(name).alias("of_table"), "uuid", "group", "series", channel.alias("std_channel"), at.cast("double").alias("at"), n.cast("long").alias("n"), F.round(total, 6).alias("total"), text.alias("info"))

    tiers = [rows(f"timeseries_agg_{m}min", F.col("elapsed_bin_s"), F.col("value_count"), F.col("value_mean") * F.col("value_count")) for m in (1, 15, 60)]
    facts = rows("timeseries", F.col("elapsed_time_s"), F.col("sample_offset"), F.col("value"), F.coalesce("value_str", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")))
    index = rows("experiment_index", F.col("duration_s"), F.col("total_data_points"), F.col("avg_stack_voltage_v"), F.col("source_file_name"))
    catalog = rows("channel_catalog_experiment", none("double"), F.col("has_data").cast("int"), none("double"), F.col("unit"))
    return reduce(DataFrame.unionByName, [facts, *tiers, index, catalog])


def _order_of(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """For each value of the keys its rows, how many of these come after a larger one in their file, and in how many files they lie."""
    t = spark.read.parquet(path).select(*keys, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    now = F.struct(*keys)
    falls = (F.lag(now).over(W.partitionBy("_file").orderBy("_row")) > now).cast("int")
    return t.withColumn("_falls", F.coalesce(falls, F.lit(0))).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("_falls").alias("falls"), F.countDistinct("_file").alias("files"))


def compact_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in range-sorted files, as the files show: each key in one file, and none after a larger one."""
    path, keys = f"{new_folder(spark)}/lineitem", ["l_returnflag", "l_suppkey"]
    maintain.sorted_by_range(A.table(spark, sf_dir, "lineitem"), keys, 16).write.parquet(path)
    return _order_of(spark, path, keys)


def compact_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items after two compactions with additions between: the same rows, and whether a filter by a value of either key skips three files of ten or more."""
    path, keys, li = f"{new_folder(spark)}/lineitem", ["l_suppkey", "l_quantity"], A.table(spark, sf_dir, "lineitem")
    for k in (0, 1):
        li.filter(F.month("l_shipdate") > 6 if k else F.month("l_shipdate") <= 6).repartition(8).write.mode("append").parquet(path)
        size = sum(stored.file_sizes(spark, path).values())
        maintain.compact(spark, path, keys, file_bytes=max(1, size // 16), small_bytes=1)
    t = spark.read.parquet(path)
    spans = t.groupBy(F.col("_metadata.file_path")).agg(*[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("low", F.min), ("high", F.max))])
    some = t.agg(*[F.percentile_approx(k, 0.3, 100_000).alias(f"some_{k}") for k in keys])
    files = spans.crossJoin(F.broadcast(some)).agg(*[(F.avg(F.col(f"some_{k}").between(F.col(f"low_{k}"), F.col(f"high_{k}")).cast("int")) <= 0.7).alias(f"skips_{k}") for k in keys])
    rows = t.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))
    return rows.crossJoin(F.broadcast(files))


def sheet_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of CSV sheets, one folder a supplier, that hold its line items: ragged rows, quotes and blank lines."""
    folder, c = new_folder(spark), F.col
    line = F.concat_ws(",", c("l_orderkey").cast("string"), F.when(c("l_linenumber") % 3 > 0, F.concat(F.lit('"a,""'), c("l_returnflag"), F.lit('"""'))), F.when(c("l_linenumber") % 3 > 1, F.lit("z")))
    li = A.table(spark, sf_dir, "lineitem").select("*", F.concat(F.lit("file-"), c("l_suppkey").cast("string")).alias("supplier"), F.when(c("l_linenumber") == 7, "").otherwise(line).alias("value"))
    write_lines(li, folder, "supplier", A.SHEET_ORDER)
    return read_grid(spark, folder, by_folder=True).select("uuid", "row_idx", "col_idx", "cell")


def derived_active_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current densities by the first definition of an active area; parts are the definitions, by brand, those of small size undefined."""
    part = A.table(spark, sf_dir, "part")
    definitions = part.groupBy(F.col("p_brand").alias("series")).agg(F.when(F.min("p_size") == 1, F.avg("p_size")).alias("active_area_cm2"))
    wide = derived.derived_wide(A.lineitem_wide(spark, sf_dir), derived.active_area(definitions))
    return wide.select("uuid", "group", "sample_offset", F.round("Current density", 6).alias("density"))


def tracking_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a log of two runs says of files: the second has results for closed orders alone."""
    files = A.order_files(spark, sf_dir)
    none = F.lit(None).cast("string")
    results = files.filter("status = 'FAILED'").select("blob_path", "file_name", "file_size", none.alias("file_uuid"), "last_modified", F.lit("FAILED").alias("status"), none.alias("output_paths"), F.lit("again").alias("error_message"), F.lit(2.0).alias("duration_seconds"))
    known = A.order_tracking(files)
    log = known.withColumn("_run", F.lit("1")).unionByName(tracking.changes(known, results).withColumn("_run", F.lit("2")))
    runs = log.groupBy("blob_path").agg(F.count("*").alias("rows"))
    return tracking.current(log).join(runs, "blob_path").select("blob_path", "status", "error_message", "retry_count", "rows")


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed below a folder of orders' sheets, one a month in folders by year: paths, sizes, kinds, and ids that differ."""
    folder, day = new_folder(spark), F.col("o_orderdate")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus")
    lines = A.table(spark, sf_dir, "orders").select(F.concat(F.lit("y "), F.year(day).cast("string")).alias("year"), F.month(day).alias("month"), line.alias("value"))
    lines.repartition("year", "month").write.partitionBy("year", "month").text(folder)
    files = list_files(spark, folder, ("TXT",))
    shown = files.select(F.regexp_extract("blob_path", "^(.*)/[^/]*$", 1).alias("folder"), "extension", "file_size", "file_uuid", F.endswith("blob_path", "file_name").alias("_named"))
    return shown.groupBy("folder", "extension").agg(F.count("*").alias("files"), F.countDistinct("file_uuid").alias("ids"), F.sum("file_size").alias("bytes"), F.min("_named").alias("named"))


def mapping_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel mappings read from their files: a brand is a series, its parts are the entries, by name and type."""
    folder, part = new_folder(spark), A.table(spark, sf_dir, "part")
    name = F.when(F.endswith("p_name", F.lit("bolt")), "Date").when(F.endswith("p_name", F.lit("ring")), " ").otherwise(F.concat("p_type", F.lit(" ")))
    origin = F.when(F.col("p_type") == "PROMO", "calculation").when(F.col("p_type") == "SMALL", "file")
    entry = F.struct(name.alias("schema_column"), F.concat(F.lit(" "), "p_name").alias("file_column"), origin.alias("origin"))
    lists = part.groupBy("p_brand").agg(F.to_json(F.sort_array(F.collect_set(entry))).alias("value"))
    for brand in sorted(r[0] for r in part.select("p_brand").distinct().collect()):  # as many files as there are series
        write_file(spark, f"{folder}/{brand} 1_mapping.json", lists.filter(F.col("p_brand") == brand).first()["value"])
    config = part.select("p_brand").distinct().agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_set(F.struct("p_brand", F.concat("p_brand", F.lit(" 1_mapping.json"))))))).alias("value"))
    write_file(spark, f"{folder}/series_config.json", '{"_about": "x_mapping.json", "none": "missing_mapping.json", ' + config.first()["value"][1:])
    some = channel_mapping(spark, folder).withColumn("for_converter", F.lit(False))
    return some.unionByName(channel_mapping(spark, folder, for_converter=True).withColumn("for_converter", F.lit(True)))


def table_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written to a table in parts by flag: the first half twice, where the second time replaces the first, then the rest."""
    path, li = f"{new_folder(spark)}/lineitem", A.table(spark, sf_dir, "lineitem")
    early = li.filter(F.month("l_shipdate") <= 6)
    counts = [write_table(rows, path, mode, ["l_returnflag"]) for rows, mode in ((early, "append"), (early, "overwrite"), (li.filter(F.month("l_shipdate") > 6), "append"))]
    parts = F.regexp_extract("_metadata.file_path", "l_returnflag=([^/]*)/", 1)
    found = read_table(spark, path).select("l_returnflag", "l_quantity", parts.alias("part")).groupBy("l_returnflag", "part").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 6).alias("quantity"))
    return found.select("*", *[F.lit(n).cast("long").alias(f"write_{k}") for k, n in enumerate(counts)])


def append_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments appended in three runs, each of which adds those that aren't stored yet: sheets g0, all, all again."""
    path, long = f"{new_folder(spark)}/dim_experiment", A.events_long(spark, sf_dir)
    rows = dims.dim_experiment(long, A.event_files(long))
    added = [append_new(spark, some, path, ["experiment_id"]) for some in (rows.filter("`group` = 'g0'"), rows, rows)]
    return read_table(spark, path).select("uuid", "group", "series", *[F.lit(n).cast("long").alias(f"run_{k}") for k, n in enumerate(added)])


def converter_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by sheet of the four tables that the converter exports, and its files' states, after two runs, of which the second has nothing to do."""
    layout, cells = Layout(f"{new_folder(spark)}/lake"), A.lineitem_rows(spark, sf_dir)
    number = F.regexp_extract("uuid", "([0-9]+)", 1).cast("long")
    files = cells.select("uuid").distinct().select(F.concat(F.lit("lab/"), "uuid").alias("blob_path"), F.col("uuid").alias("file_name"), number.alias("file_size"), F.col("uuid").alias("file_uuid"), F.to_timestamp(F.lit("2024-05-06")).alias("last_modified"))
    lost = files.withColumns({c: F.concat(c, F.lit("-lost")) for c in ("blob_path", "file_name", "file_uuid")})  # files without sheets fail
    for k in (0, 1):
        pipeline.convert_job(spark, layout, files if k else files.unionByName(lost), cells)
    tables = [read_table(spark, layout.converted(n)).groupBy("uuid", "group").agg(F.count("*").alias("n")).select(F.lit(n).alias("of_table"), "uuid", "group", "n") for n in pipeline.TABLES]
    states = pipeline.tracked_files(spark, layout).select(F.lit("tracking").alias("of_table"), F.col("file_uuid").alias("uuid"), F.col("status").alias("group"), F.col("retry_count").cast("long").alias("n"))
    return reduce(DataFrame.unionByName, [*tables, states])


def tracking_upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of files after a run over a tracking table without retries, as older runs have left it, and over none at all."""
    folder, files = new_folder(spark), A.order_files(spark, sf_dir)
    write_table(A.order_tracking(files).drop("retry_count"), f"{folder}/old")
    none = F.lit(None).cast("string")
    results = files.filter("status = 'FAILED'").select("blob_path", "file_name", "file_size", none.alias("file_uuid"), "last_modified", "status", none.alias("output_paths"), F.lit("again").alias("error_message"), F.lit(2.0).alias("duration_seconds"))
    after = [tracking.upsert(read_table(spark, f"{folder}/{name}", FILE_TRACKING), results).select(F.lit(name).alias("of_table"), "blob_path", "status", "error_message", "retry_count") for name in ("old", "none")]
    return after[0].unionByName(after[1])


def dq_rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of the dimension with what they found in the event samples; one that found nothing and one that is off are listed too."""
    rules = [*dq.DEFAULT_RULES[:2], dq.Rule("far", "Values are known", "value", "not_null", params={"channel_id": "none", "n": 3}), dq.Rule("off", "Off", "value", "not_null", enabled=False)]
    found = dq.summarize(dq.evaluate_rules(_checked(spark, sf_dir), rules)).select("rule_id", "total_failed", "affected_files")
    shown = dq.rule_table(spark, rules).join(F.broadcast(found), "rule_id", "left")
    return shown.select("rule_id", "rule_type", "enabled", F.get_json_object("params_json", "$.channel_id").alias("channel"), F.get_json_object("params_json", "$.formats[0]").alias("first_format"), F.coalesce("total_failed", F.lit(0)).alias("total_failed"), F.coalesce("affected_files", F.lit(0)).alias("affected_files"))


ALL = (
    agg_1min, agg_15min, agg_60min, gold_fact, gold_fact_new_only, agg_backfill, experiment_index, channel_catalog_experiment, channel_catalog_series,
    serve_series, serve_drilldown, unpivot_long, value_split, derived_metrics, plausibility_clip, sheet_statistics, channel_rows, dim_experiment,
    dim_experiment_orphans, dim_signal, dim_signal_conflicts, parse_timestamps, dq_not_null, dq_timestamp_parse, dq_duplicate_key, dq_monotonic, dq_all,
    dq_summary, dq_clean, dq_flag, dq_delete, file_uuid, sanitize_name, series_from_path, unit_row_detection, unique_channel_names, datetime_merge,
    structural_split, sheet_to_long, sheet_channels, tracking_new_files, tracking_watermark, tracking_exhausted, tracking_upsert, tracking_status_counts,
    validate_orphans, validate_report, extension_filter, filemeta, sheet_canonical, latest_version, dense_bins, dense_tier, stream_bronze, stream_dq, compact_sorted,
    dq_flag_stored, dq_delete_stored, stream_dq_keys, stream_dq_order, gold_versions, jobs_gold_tables,
    compact_clustered, sheet_read, derived_active_area, tracking_log,
    file_listing, mapping_scan, table_writes, append_incremental, converter_tables, tracking_upgrade, dq_rule_report,
)


def queries() -> dict:
    return {f.__name__: f for f in ALL}
