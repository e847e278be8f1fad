"""Jobs end to end on local folders: no reprocessing, retries, new files, widening, idempotent reruns, validation."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_sheets import C1
from tslake.functions.values import file_uuid
from tslake.layout import Layout
from tslake.operators import dims, dq, gold, grid, lookup, tracking
from tslake.plans import pipeline
from tslake.schemas import BRONZE, SHEET_CELLS, TIMESERIES
from tslake.sources import readers, writers
from tslake.streaming import bronze, quality

FILES = "blob_path string, file_name string, file_size bigint, file_uuid string, last_modified timestamp"
MAPPING = [("S1", "Stack Voltage", "Stack Voltage"), ("S1", "Current", "Current")]


def files(spark, names, day="2026-02-14"):
    rows = [(f"S1/{n}.xlsx", f"{n}.xlsx", 10, n) for n in names]
    return spark.createDataFrame(rows, "blob_path string, file_name string, file_size bigint, file_uuid string").withColumn("last_modified", F.to_timestamp(F.lit(day)))


def sheets(spark, names):
    rows = [(n, "Sheet", r, c, cell) for n in names for r, row in enumerate(C1) for c, cell in enumerate(row)]
    return spark.createDataFrame(rows, SHEET_CELLS)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    layout = Layout(f"file://{tmp_path_factory.mktemp('lake')}")
    mapping = readers.literal_mapping(spark, MAPPING)
    first = pipeline.run_pipeline(spark, layout, files(spark, ["a", "b", "empty"]), sheets(spark, ["a", "b"]), mapping)
    return layout, mapping, first


def count(spark, layout, name):
    return readers.read_table(spark, f"{layout.base}/{name}").count()


def test_first_run(spark, lake):
    layout, _, first = lake
    assert first["silver"]["dim_experiment"] == 2 and first["gold"]["timeseries"] == 12 and first["serving"]["experiment_index"] == 2
    status = {r["file_name"]: (r["status"], r["retry_count"], r["error_message"]) for r in pipeline.tracked_files(spark, layout).collect()}
    assert status["a.xlsx"] == ("SUCCESS", 0, None) and status["empty.xlsx"] == ("FAILED", 1, "No data extracted")
    index = readers.read_table(spark, f"{layout.base}/gold/experiment_index").collect()
    assert {r["source_file_name"] for r in index} == {"a.xlsx", "b.xlsx"} and {r["series"] for r in index} == {"S1"}
    points = sum(r["total_data_points"] for r in index)
    assert points == readers.read_table(spark, f"{layout.base}/gold/timeseries").filter("value is not null and elapsed_time_s is not null").count()


def test_validation(spark, lake):
    report = pipeline.validate_job(spark, lake[0]).collect()
    assert {r["status"] for r in report} == {"OK"} and len(report) > 25
    with pytest.raises(RuntimeError):
        pipeline.validate_job(spark, Layout(f"{lake[0].base}/nothing"))


def test_rerun_adds_nothing_and_new_files_are_taken(spark, lake):
    layout, mapping, _ = lake
    before = {n: count(spark, layout, n) for n in ("gold/timeseries", "gold/timeseries_agg_1min", "gold/timeseries_agg_60min", "gold/experiment_index", "silver/dim_signal")}
    again = pipeline.run_pipeline(spark, layout, files(spark, ["a", "b", "empty"]), sheets(spark, ["a", "b"]), mapping)
    assert again["gold"]["timeseries"] == 0 and again["serving"]["experiment_index"] == 0
    assert before == {n: count(spark, layout, n) for n in before}
    more = pipeline.run_pipeline(spark, layout, files(spark, ["a", "b", "c"]), sheets(spark, ["a", "b", "c"]), mapping)
    assert more["silver"]["dim_experiment"] == 1 and more["gold"]["timeseries"] == 6 and more["serving"]["experiment_index"] == 1
    retries = {r["file_name"]: r["retry_count"] for r in pipeline.tracked_files(spark, layout).collect()}
    assert retries["empty.xlsx"] == 2 and retries["c.xlsx"] == 0


def test_optimize_keeps_rows(spark, lake):
    layout = lake[0]
    before = sorted(map(str, readers.read_table(spark, f"{layout.base}/gold/timeseries").collect()))
    done = pipeline.optimize_job(spark, layout, ["gold/timeseries"])
    assert done == {"gold/timeseries": len(before)}
    assert pipeline.optimize_job(spark, layout, ["gold/timeseries"]) == {"gold/timeseries": 0}
    assert sorted(map(str, readers.read_table(spark, f"{layout.base}/gold/timeseries").collect())) == before


def test_backfill_of_bins(spark, lake):
    layout, _, _ = lake
    writers.replace_table(readers.read_table(spark, f"{layout.base}/gold/timeseries_agg_1min").limit(0), f"{layout.base}/gold/timeseries_agg_1min")
    added = pipeline.gold_job(spark, layout)
    assert added["timeseries"] == 0 and added["timeseries_agg_1min"] > 0


def test_exhausted_files_are_left_alone(spark):
    known = spark.createDataFrame([("S1/a.xlsx", "FAILED", 5), ("S1/b.xlsx", "FAILED", 4)], "blob_path string, status string, retry_count int")
    assert [r["file_name"] for r in tracking.without_exhausted(files(spark, ["a", "b"]), known).collect()] == ["b.xlsx"]


def test_ambiguous_channels_raise(spark):
    rows = [(1, "V", "a", "ra"), (1, "V", "b", "rb"), (2, "V", "a", "ra")]
    with pytest.raises(ValueError, match="1/V: a, b"):
        dims.check_std_channels(spark.createDataFrame(rows, "experiment_id long, std_channel string, channel_id string, raw_channel string"))


def test_coarse_bins_equal_direct_ones(spark):
    n = 5000
    samples = spark.range(n).select(F.lit("S").alias("series"), F.lit("c").alias("std_channel"), F.lit(1).alias("experiment_id"), (F.col("id") % 3).alias("signal_id"), F.col("id").alias("sample_offset"),
        (F.col("id") * 7.3 - 100).alias("elapsed_time_s"), F.timestamp_seconds("id").alias("timestamp"), F.sin("id").alias("value"))
    via = gold.coarsen(gold.bin_samples(samples), 3600).orderBy("signal_id", "elapsed_bin_s").collect()
    direct = gold.bin_samples(samples, 3600).orderBy("signal_id", "elapsed_bin_s").collect()
    assert len(via) == len(direct)
    for a, b in zip(via, direct):
        assert abs(a["value_mean"] - b["value_mean"]) < 1e-9 and all(a[c] == b[c] for c in ("elapsed_bin_s", "timestamp", "value_min", "value_max", "value_count"))


def test_nan_samples(spark):
    rows = [(0, float("nan"), 1.0), (1, 1.0, float("nan")), (2, 2.0, 4.0), (3, None, 1.0), (4, 3.0, None)]
    df = spark.createDataFrame(rows, "sample_offset long, elapsed_time_s double, value double").selectExpr("*", "'S' series", "'c' std_channel", "1L experiment_id", "1L signal_id", "timestamp'2024-01-01' timestamp")
    assert gold.bin_samples(df, nan_as_null=True).first()["value_mean"] == 4.0 and gold.bin_samples(df).first()["value_count"] == 2


def long_rows(spark, rows):
    return spark.createDataFrame(rows, TIMESERIES)


ROWS = [
    ("u", "g", 0, "2024-01-01 00:00:00", 0.0, "a", 1.0, None), ("u", "g", 0, "2024-01-01 00:00:00", 0.0, "a", 2.0, None), ("u", "g", 1, None, 1.0, "a", 3.0, None),
    ("u", "g", 2, "junk", 2.0, "a", 4.0, None), ("u", "g", 3, "2023-01-01 00:00:00", 3.0, "a", 5.0, None), (None, "g", 0, "2024-01-01 00:00:00", 0.0, "a", 1.0, None), (None, "g", 0, "2024-01-01 00:00:00", 0.0, "a", 1.0, None),
]


def test_rules(spark):
    df = long_rows(spark, ROWS)
    failed = sorted((r["rule_id"], r["sample_offset"]) for r in dq.evaluate_rules(df).collect())
    assert failed == [("ts_timestamp_not_null", 1), ("ts_timestamp_parseable", 2), ("ts_unique_point", 0), ("ts_unique_point", 0)]
    assert dq.evaluate_rules(df, []).count() == 0 and "rule_id" in dq.evaluate_rules(df, [dq.Rule("x", "x", "value", "not_null", enabled=False)]).columns
    with pytest.raises(ValueError):
        dq.evaluate_rule(df, dq.Rule("x", "x", "value", "unheard_of"))
    mono = dq.Rule("m", "m", "timestamp", "monotonic_increasing", params={"partition_by": ["uuid", "group"], "order_by": ["sample_offset"], "format": "yyyy-MM-dd HH:mm:ss"})
    assert dq.evaluate_rule(df, mono).count() == 0  # the row before the one that falls can't be parsed
    failures = dq.evaluate_rules(df)
    assert dq.invalid_keys(failures).count() == 0 and dq.clean(df, dq.invalid_keys(failures)).count() == len(ROWS)
    bad = dq.invalid_keys(failures, blocking_only=False)
    assert dq.delete(df, bad).count() + dq.flag(df, bad).filter("not is_valid").count() == len(ROWS)
    assert dq.rule_table(spark).count() == 3


def test_stream_is_incremental_and_widens(spark, tmp_path):
    src, table, check = f"{tmp_path}/in", f"{tmp_path}/bronze", f"{tmp_path}/check"
    long_rows(spark, ROWS[:3]).write.parquet(src)
    assert bronze.ingest(spark, src, table, check, TIMESERIES) == 3
    assert bronze.ingest(spark, src, table, check, TIMESERIES) == 0
    long_rows(spark, ROWS[3:]).withColumn("extra", F.lit(1)).write.mode("append").parquet(src)
    assert bronze.ingest(spark, src, table, check, TIMESERIES + ", extra int") == len(ROWS) - 3
    got = readers.read_table(spark, table)
    assert got.count() == len(ROWS) and got.filter("extra is null").count() == 3 and "_bronze_ingested_at" in got.columns


def test_quality_stream(spark, tmp_path):
    src = f"{tmp_path}/in"
    long_rows(spark, ROWS).coalesce(1).write.parquet(src)
    rules = [dq.DEFAULT_RULES[0], dq.Rule("u", "u", "channel_id", "no_duplicate_key", params=dq.DEFAULT_RULES[2].params, is_blocking=True)]
    assert quality.check_stream(spark, src, f"{tmp_path}/out", f"{tmp_path}/check", rules, "write_clean_table") == len(ROWS)
    assert readers.read_table(spark, f"{tmp_path}/out/fact_timeseries_dq_result").count() == 3
    assert readers.read_table(spark, f"{tmp_path}/out/fact_timeseries_clean").count() == len(ROWS) - 2
    assert {r["total_failed"] for r in readers.read_table(spark, f"{tmp_path}/out/fact_timeseries_dq_summary").collect()} == {1, 2}
    with pytest.raises(ValueError):
        quality.check_stream(spark, src, "x", "y", mode="other")


def test_readers(spark, tmp_path):
    (tmp_path / "deep/S1").mkdir(parents=True)
    for name in ("a.XLSX", "b.xls", "c.txt"):
        (tmp_path / "deep/S1" / name).write_text("x" * 5)
    got = {r["blob_path"]: r["file_size"] for r in readers.list_files(spark, str(tmp_path)).collect()}
    assert got == {"deep/S1/a.XLSX": 5, "deep/S1/b.xls": 5}
    (tmp_path / "grid").mkdir()
    (tmp_path / "grid/x.csv").write_text("A,B\nName A,Name B\ntext,1\n,2\n")
    rows = readers.read_grid(spark, f"{tmp_path}/grid", 2).orderBy("row_idx", "col_idx").collect()
    assert [(r["row_idx"], r["col_idx"], r["cell"]) for r in rows][-2:] == [(3, 0, None), (3, 1, "2")]
    (tmp_path / "map").mkdir()
    (tmp_path / "map/series_config.json").write_text(json.dumps({"_comment": "x", "S1": "S1_mapping.json", "S2": "gone_mapping.json"}))
    entries = [("Date", "Real time", "file"), ("Stack Voltage", " U ", "file"), ("Test time", "T", "calculation"), ("", "x", "file"), ("Y", None, "file")]
    (tmp_path / "map/S1_mapping.json").write_text(json.dumps([{"schema_column": s, "file_column": f, "origin": o} for s, f, o in entries]))
    assert [tuple(r) for r in readers.channel_mapping(spark, f"{tmp_path}/map").collect()] == [("S1", "U", "Stack Voltage")]
    assert readers.channel_mapping(spark, f"{tmp_path}/map", for_converter=True).count() == 3
    assert set(BRONZE) == {"filemeta", "channel", "timeseries", "statistics"}


def test_grids_of_any_width(spark, tmp_path):
    """Ragged rows keep all cells, and several tasks number the lines of a large file."""
    book = tmp_path / "lab" / "S1" / "my book+1.xlsx"
    book.mkdir(parents=True)
    (book / "First.csv").write_text('A,B\n\nx,"a, ""b""",3,\n,\n"open,1\n,7,8\n')
    lines = [f"{k},{k * 7}" + ",z" * (k % 3) for k in range(60_000)]
    (book / "Second sheet.csv").write_text("\r\n".join(lines))
    (book / "bad.csv.gz").write_bytes(b"\x1f\x8bnot gzip at all")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        cells = readers.read_grid(spark, f"{tmp_path}/lab", by_folder=True).cache()
        first = cells.filter("`group` = 'First'").groupBy("row_idx").agg(F.sort_array(F.collect_list(F.struct("col_idx", F.coalesce("cell", F.lit("-")).alias("cell")))).alias("c")).orderBy("row_idx").collect()
        assert [[x["cell"] for x in r["c"]] for r in first] == [["A", "B", "-", "-"], ["-"] * 4, ["x", 'a, "b"', "3", "-"], ["-"] * 4, ['"open', "1", "-", "-"], ["-", "7", "8", "-"]]
        second = cells.filter("`group` = 'Second sheet'")
        wide = second.groupBy("row_idx").pivot("col_idx", [0, 1, 2, 3]).agg(F.first("cell"))
        assert wide.count() == 60_000 and wide.filter("`0` <> row_idx or `1` <> row_idx * 7 or (`2` is not null) <> (row_idx % 3 > 0) or (`3` is not null) <> (row_idx % 3 > 1)").isEmpty()
        assert {r["uuid"] for r in cells.select("uuid").distinct().collect()} == {spark.range(1).select(file_uuid(F.lit("S1/my book+1.xlsx"))).first()[0]}
        alone = readers.read_grid(spark, f"{tmp_path}/lab")
        listed = readers.list_files(spark, f"{tmp_path}/lab", ("csv", "gz"))
        assert [r["file_name"] for r in readers.unread(listed, alone).collect()] == ["bad.csv.gz"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_returned_status_of_every_run(spark, tmp_path):
    """Frames of earlier runs stay readable; a run that broke off leaves nothing behind; a new version counts once."""
    layout, mapping = Layout(f"file://{tmp_path}"), readers.literal_mapping(spark, MAPPING)
    first = pipeline.convert_job(spark, layout, files(spark, ["a", "empty"]), sheets(spark, ["a"]))
    second = pipeline.convert_job(spark, layout, files(spark, ["a", "b", "empty"]), sheets(spark, ["a", "b"]))
    third = pipeline.convert_job(spark, layout, files(spark, ["a", "b"]), sheets(spark, ["a", "b"]))
    status = [{r["file_name"]: (r["status"], r["retry_count"]) for r in run.collect()} for run in (first, second, third)]
    assert status == [{"a.xlsx": ("SUCCESS", 0), "empty.xlsx": ("FAILED", 1)}, {"b.xlsx": ("SUCCESS", 0), "empty.xlsx": ("FAILED", 2)}, {}]
    rows = count(spark, layout, "converted/timeseries")
    with pytest.MonkeyPatch.context() as patch:  # breaks off between the export and the tracking of its files
        patch.setattr(pipeline, "track", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.convert_job(spark, layout, files(spark, ["c"]), sheets(spark, ["c"]))
    assert count(spark, layout, "converted/timeseries") > rows
    again = pipeline.convert_job(spark, layout, files(spark, ["c"]), sheets(spark, ["c"]))
    assert [r["file_name"] for r in again.collect()] == ["c.xlsx"]
    assert count(spark, layout, "converted/timeseries") == rows * 3 // 2
    pipeline.convert_job(spark, layout, files(spark, ["a"], "2026-03-01"), sheets(spark, ["a"]))  # a newer version, in the same ingestion
    bronze.ingest_all(spark, f"{layout.base}/converted", f"{layout.base}/bronze", f"{layout.base}/_checkpoints")
    assert count(spark, layout, "bronze/timeseries") == 2 * rows
    added = pipeline.silver_job(spark, layout, mapping)
    assert added["dim_experiment"] == 3 and added["sheets_without_file"] == 0
    assert pipeline.gold_job(spark, layout)["timeseries"] == 3 * rows // 2


def test_older_tracking_tables(spark, tmp_path):
    layout = Layout(f"file://{tmp_path}")
    old = files(spark, ["a"]).withColumns({"status": F.lit("FAILED"), "error_message": F.lit("x")})
    writers.write_table(old, layout.tracking)
    got = pipeline.convert_job(spark, layout, files(spark, ["a", "b"]), sheets(spark, ["b"])).collect()
    assert {r["file_name"]: (r["status"], r["retry_count"]) for r in got} == {"a.xlsx": ("FAILED", 1), "b.xlsx": ("SUCCESS", 0)}
    log = readers.read_table(spark, layout.tracking)
    assert log.count() == 3 and log.select("_run").distinct().count() == 2  # the older table's row, and one for each file of the run
    import os

    os.rename(f"{tmp_path}/_tracking/files", f"{tmp_path}/_tracking/files_old")  # a swap that broke off
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pipeline, "LOGGED_RUNS", 1)  # the log is folded
        assert pipeline.convert_job(spark, layout, files(spark, ["b"]), sheets(spark, ["b"])).count() == 0
    log = readers.read_table(spark, layout.tracking)
    assert log.count() == 2 and {r["file_name"]: r["retry_count"] for r in log.collect()} == {"a.xlsx": 1, "b.xlsx": 0}


def test_converter_takes_series_mapping_and_area(spark, tmp_path):
    mapping = readers.literal_mapping(spark, [("S1", "Stack Voltage", "U"), ("S2", "Current", "no")])
    definitions = spark.createDataFrame([("S1", 44.0)], "series string, active_area_cm2 double")
    for k, area in enumerate((None, definitions)):
        pipeline.convert_job(spark, Layout(f"file://{tmp_path}/{k}"), files(spark, ["a"]), sheets(spark, ["a"]), mapping, area)
    one, two = (readers.read_table(spark, f"file://{tmp_path}/{k}/converted/timeseries").filter("channel_id = 'Current density'").orderBy("sample_offset").collect() for k in (0, 1))
    assert len(one) == len(two) and all(abs(b["value"] - 2 * a["value"]) < 1e-9 for a, b in zip(one, two) if a["value"] is not None)


def test_rule_parameters(spark):
    rows = [("u", "g", k, f"2024-01-01 00:00:{s:02d}", 0.0, c, 1.0, None) for k, (s, c) in enumerate([(1, "a"), (5, "a"), (3, "a"), (2, "b"), (1, "b")])]
    df = long_rows(spark, rows)
    assert {r["sample_offset"] for r in dq.evaluate_rule(df, dq.Rule("m", "m", "timestamp", "monotonic_increasing")).collect()} == {2, 3, 4}
    a = dq.Rule("m", "m", "timestamp", "monotonic_increasing", params={"channel_equals": "a", "order_by": "sample_offset", "partition_by": "uuid"})
    assert {r["sample_offset"] for r in dq.evaluate_rule(df, a).collect()} == {2}
    other = dq.Rule("n", "n", "value_str", "not_null", params={"channel_column": "name", "channel_regex": "^b"})
    assert dq.evaluate_rule(df.withColumnRenamed("channel_id", "name"), other).count() == 2
    day = dq.Rule("p", "p", "timestamp", "timestamp_parseable", params={"format": "dd.MM.yyyy"})
    assert dq.evaluate_rule(df.withColumn("timestamp", F.lit("31.12.2024")), day).count() == 0


def test_latest_does_not_depend_on_partitions(spark):
    rows = [("u", "g", k, "2024-01-01", f"x{k}") for k in range(6)]
    df = spark.createDataFrame(rows, "uuid string, `group` string, n int, _bronze_ingested_at string, name string")
    got = {dims.latest(df.repartition(n), ["uuid", "group"]).first()["name"] for n in (1, 3, 6)}
    assert got == {"x5"}
    mapping = readers.literal_mapping(spark, [("S", "V", "B"), ("S", " V ", "A")])
    channel = spark.createDataFrame([("u", "g", "c", "V", "", 0)], "uuid string, `group` string, channel_id string, raw_channel string, unit string, column_index int")
    experiments = spark.createDataFrame([(1, "u", "g", "S")], "experiment_id long, uuid string, `group` string, series string")
    assert dims.dim_signal(channel, experiments, mapping).first()["std_channel"] == "A"


def test_long_quoted_fields(spark, tmp_path):
    """A quoted field of any length is one cell; its characters don't go on the stack."""
    (tmp_path / "x.csv").write_text('a,"' + 'b,""' * 100_000 + '",c\n"' + "d" * 100_000 + ",e\n")
    cells = readers.read_grid(spark, str(tmp_path)).orderBy("row_idx", "col_idx").collect()
    assert [r["cell"] for r in cells] == ["a", 'b,"' * 100_000, "c", '"' + "d" * 100_000, "e", None]


def test_lines_become_files_by_one_shuffle(spark, tmp_path):
    """Files of many sheets: one each, lines in order, nothing else beside them; their rows are shuffled once."""
    rows = [(f"s{k % 300}", k, None if k % 7 == 0 else f"é{k},x") for k in range(6000)]
    lines = spark.createDataFrame(rows[::-1], "sheet string, n int, value string")
    run = lambda: writers.write_lines(lines, f"{tmp_path}/out", "sheet", ["n"])
    assert shuffled_rows(spark, run) < 6100
    run()  # files of a task that runs again take the place of those before
    folders = sorted((tmp_path / "out").iterdir())
    assert [f.name for f in folders] == sorted(f"sheet=s{k}" for k in range(300)) and all(len([x for x in f.iterdir()]) == 1 for f in folders)
    assert (tmp_path / "out/sheet=s7/part-0.txt").read_text(encoding="utf-8").split("\n") == [v or "" for s, _, v in rows if s == "s7"] + [""]
    assert spark.read.text(f"{tmp_path}/out").count() == 6000


def shuffled_rows(spark, run):
    """Rows that the stages of ``run`` have written for others."""
    def total():
        store = spark.sparkContext._jsc.sc().statusStore()
        none = spark._jvm.java.util.ArrayList()
        stages = store.stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none).iterator()
        out = 0
        while stages.hasNext():
            out += stages.next().shuffleWriteRecords()
        return out

    before = total()
    run()
    return total() - before


def test_gold_does_not_shuffle_facts(spark, tmp_path, monkeypatch):
    """Facts of many sheets that are alike meet their signals where they lie; by either other way they are the same."""
    monkeypatch.setattr(grid, "BROADCAST_COLUMNS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(n, "Sheet", r, c, cell) for n in "abcdefgh" for r, row in enumerate(C1 + C1[-1:] * 200) for c, cell in enumerate(row)]
        found, moved = [], []
        for k, (ids, kinds) in enumerate(((1000, 1000), (1000, 0), (0, 0))):
            monkeypatch.setattr(lookup, "BROADCAST_IDS", ids)
            monkeypatch.setattr(lookup, "BROADCAST_KINDS", kinds)
            layout = Layout(f"file://{tmp_path}/{k}")
            pipeline.convert_job(spark, layout, files(spark, "abcdefgh"), spark.createDataFrame(rows, SHEET_CELLS))
            bronze.ingest_all(spark, f"{layout.base}/converted", f"{layout.base}/bronze", f"{layout.base}/_checkpoints")
            pipeline.silver_job(spark, layout, readers.literal_mapping(spark, MAPPING))
            moved.append(shuffled_rows(spark, lambda: pipeline.gold_job(spark, layout)))
            found.append([sorted(map(str, readers.read_table(spark, layout.table("gold", n)).collect())) for n in ("timeseries", "timeseries_agg_1min")])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[0] == found[1] == found[2] and len(found[0][0]) > 3000
    assert moved[0] < len(found[0][0]) < moved[1]


def test_kinds_of_sheets_differ_by_where_nulls_are(spark):
    """Three sheets whose columns hash alike, and one whose version differs by a microsecond."""
    known = spark.createDataFrame([("a", "g", 1, None, 0), ("b", "g", None, 1, 0), ("c", "g", 1, None, 1), (None, "g", 5, 5, 0)], "uuid string, `group` string, x int, y int, t int")
    known = known.select("uuid", "group", "x", "y", F.timestamp_micros(F.col("t") + 1_000_000).alias("t"))
    rows = spark.createDataFrame([(u, "g", n) for u in ("a", "b", "c", "d", None) for n in (1, 2)], "uuid string, `group` string, n int")
    got = lookup.with_sheets(rows, known).select("uuid", "n", "x", "y", F.unix_micros("t") - 1_000_000).collect()
    assert {tuple(r) for r in got} == {(u, n, *v) for u, v in (("a", (1, None, 0)), ("b", (None, 1, 0)), ("c", (1, None, 1))) for n in (1, 2)} and len(got) == 6


def test_packed_ids_find_what_plain_ones_do(spark, monkeypatch):
    """Ids many in a row, negative ones and narrower types too; rows without a key are in none of them."""
    ids = spark.range(1000).select((F.col("id") * 37 - 5000).alias("k"))
    rows = spark.range(8000).select(F.when(F.col("id") % 50 > 0, F.col("id") - 4000).cast("int").alias("k"), "id")
    known, n = {i * 37 - 5000 for i in range(1000)}, [None if i % 50 == 0 else i - 4000 for i in range(8000)]
    for how, held in (("left_semi", True), ("left_anti", False)):
        got = lookup.meet_packed(rows, ids, "k", 1000, how)
        assert got.columns == ["k", "id"] and sorted(r["id"] for r in got.collect()) == [i for i in range(8000) if (n[i] in known) is held]
    sheets = spark.range(500).select(F.concat(F.lit("u"), "id").alias("uuid"), F.lit("g").alias("group"), (F.col("id") % 3).alias("x"), F.when(F.col("id") % 2 > 0, "odd").alias("y"))
    own = spark.range(2000).select(F.concat(F.lit("u"), F.col("id") % 700).alias("uuid"), F.lit("g").alias("group"), "id")
    found = []
    for plain in (100_000, 0):
        monkeypatch.setattr(lookup, "PLAIN_IDS", plain)
        got = lookup.with_sheets(own, sheets)
        found.append((got.columns, sorted(map(str, got.collect())), sorted(r["id"] for r in lookup.of_ids(rows, ids, "k").collect())))
    assert found[0] == found[1] and len(found[0][1]) == sum(i % 700 < 500 for i in range(2000)) and len(found[0][2]) > 100
