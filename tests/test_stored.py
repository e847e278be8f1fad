"""Changes of stored tables, versions in gold, and streams that remember earlier batches."""

import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_jobs import MAPPING, ROWS, count, files, long_rows, sheets
from tests.test_sheets import C1
from tslake.layout import Layout
from tslake.operators import dq, maintain
from tslake.plans import pipeline
from tslake.schemas import SHEET_CELLS, TIMESERIES
from tslake.sources import readers, stored, writers
from tslake.streaming import bronze, quality


def data(folder):
    return {f.relative_to(folder).as_posix() for f in Path(folder).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/a table"  # paths with blanks are told encoded
    for k in range(6):
        spark.range(k * 10, k * 10 + 10).select("id", (F.col("id") * 2).alias("v"), F.lit(k).alias("p")).coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    return path


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "id long")


def test_flags_rewrite_few_files(spark, table):
    before = data(table)
    assert stored.flag_rows(spark, table, ids(spark, 13, 15, 42, 999), ["id"]) == {"files": 2, "rows": 20}
    after = data(table)
    assert len(before & after) == 4 and {f.split("/")[0] for f in after - before} == {"p=1", "p=4"} and all("/cow-" in f for f in after - before)
    got = {r["id"]: r["is_valid"] for r in readers.read_table(spark, table).collect()}
    assert len(got) == 60 and {i for i, ok in got.items() if ok is False} == {13, 15, 42} and {got[i] for i in range(10, 13)} == {True}
    assert stored.flag_rows(spark, table, ids(spark), ["id"]) == {"files": 0, "rows": 0} and data(table) == after
    stored.flag_rows(spark, table, ids(spark, 14), ["id"])
    assert {r["id"] for r in readers.read_table(spark, table).filter("not is_valid").collect()} == {13, 14, 15, 42}


def test_deletes_and_replacements(spark, table):
    assert stored.delete_rows(spark, table, ids(spark, 5, 25), ["id"])["files"] == 2
    more = spark.createDataFrame([(30, -1, 3), (77, -2, 9)], "id long, v long, p int")
    stored.replace_rows(spark, table, ids(spark, 30, 31), ["id"], more)
    got = {r["id"]: r["v"] for r in readers.read_table(spark, table).collect()}
    assert set(got) == set(range(60)) - {5, 25, 31} | {77} and got[30] == -1 and got[77] == -2 and got[32] == 64
    all_of_a_file = ids(spark, *range(40, 50))
    stored.delete_rows(spark, table, all_of_a_file, ["id"])
    assert readers.read_table(spark, table).filter("p = 4").count() == 0
    new = f"{table}/../new"
    assert stored.replace_rows(spark, new, ids(spark, 1), ["id"], more)["rows"] == 2 and readers.read_table(spark, new).count() == 2


def test_many_numbers_as_keys_dont_shuffle_the_table(spark, tmp_path, monkeypatch):
    from tests.test_jobs import shuffled_rows

    monkeypatch.setattr(stored, "BROADCAST_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved, left = [], []
        for k, most in enumerate((1000, 0)):
            monkeypatch.setattr(stored, "BROADCAST_NUMBERS", most)
            at = f"{tmp_path}/{k}"
            spark.range(5000).selectExpr("id", "id * 2 v").write.parquet(at)
            moved.append(shuffled_rows(spark, lambda: stored.delete_rows(spark, at, ids(spark, 7, 4000), ["id"])))
            left.append(sorted(r["id"] for r in readers.read_table(spark, at).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved[0] < 100 < moved[1] and left[0] == left[1] == [n for n in range(5000) if n not in (7, 4000)]


@pytest.mark.parametrize("at", ["listed", "half", "staged"])
def test_changes_that_break_off(spark, table, monkeypatch, at):
    """Before a change is listed the table stays as it was; after that it is finished by the next job."""
    before = data(table)

    def lost(*_):
        raise RuntimeError("lost")

    if at == "staged":
        monkeypatch.setattr(stored, "_list", lost)
    else:
        monkeypatch.setattr(stored, "_finish", lost)
    with pytest.raises(RuntimeError, match="lost"):
        stored.delete_rows(spark, table, ids(spark, 13, 42), ["id"])
    monkeypatch.undo()
    assert data(table) >= before and readers.read_table(spark, table).count() == 60
    if at == "half":  # one file has come and one has gone
        staged = next(Path(table).glob("_change_*"))
        new = next(staged.rglob("*.parquet"))
        os.rename(new, f"{table}/{new.relative_to(staged).parent}/cow-{new.name}")
        os.remove(f"{table}/{next(f for f in before if f.startswith('p=1'))}")
    stored.recover(spark, table)
    stored.recover(spark, table)
    assert readers.read_table(spark, table).count() == (60 if at == "staged" else 58)
    assert not list(Path(table).glob("_change_*")) and (data(table) == before) == (at == "staged")


def test_a_swap_that_broke_off_is_undone_by_the_next(spark, tmp_path):
    path = f"{tmp_path}/t"
    writers.write_table(ids(spark, 1, 2), path)
    os.rename(path, f"{path}_old")
    writers.write_table(ids(spark, 3), f"{path}_staging")
    writers.replace_table(ids(spark, 4), path)
    assert [r["id"] for r in readers.read_table(spark, path).collect()] == [4] and not os.path.exists(f"{path}_old")
    os.rename(path, f"{path}_old")
    writers.restore(spark, path)
    assert readers.read_table(spark, path).count() == 1


def changed(spark, names, value):
    """Sheets whose fourth row holds another value."""
    return sheets(spark, names).withColumn("cell", F.when((F.col("row_idx") == len(C1) - 1) & F.col("cell").try_cast("double").isNotNull() & (F.col("col_idx") > 2), F.lit(value)).otherwise(F.col("cell")))


def test_later_versions_reach_gold(spark, tmp_path):
    layout, mapping = Layout(f"file://{tmp_path}/lake"), readers.literal_mapping(spark, MAPPING)
    pipeline.run_pipeline(spark, layout, files(spark, ["a", "b"]), sheets(spark, ["a", "b"]), mapping)
    names = ["timeseries", "timeseries_agg_1min", "timeseries_agg_15min", "timeseries_agg_60min", "experiment_index", "channel_catalog_experiment"]
    before = {n: count(spark, layout, f"gold/{n}") for n in names}
    values = lambda: Counter((r["signal_id"], r["sample_offset"], r["value"]) for r in readers.read_table(spark, layout.table("gold", "timeseries")).collect())
    old = values()
    later = pipeline.run_pipeline(spark, layout, files(spark, ["a"], "2026-03-01"), changed(spark, ["a"], "99.5"), mapping)
    assert later["gold"]["timeseries"] == before["timeseries"] // 2 and later["serving"]["experiment_index"] == 1 and later["silver"]["dim_experiment"] == 0
    assert before == {n: count(spark, layout, f"gold/{n}") for n in names}
    new = values()
    assert old != new and any(v == 99.5 for _, _, v in new) and max(new.values()) == 1
    for n in names[1:4]:
        t = readers.read_table(spark, layout.table("gold", n))
        assert t.agg(F.max("value_max")).first()[0] >= 99.5 and t.groupBy("signal_id", "elapsed_bin_s").count().filter("count > 1").isEmpty()
    index = {r["source_file_name"]: r["source_last_modified"].month for r in readers.read_table(spark, layout.table("gold", "experiment_index")).collect()}
    assert index == {"a.xlsx": 3, "b.xlsx": 2}
    none = pipeline.run_pipeline(spark, layout, files(spark, ["a"], "2026-03-01"), changed(spark, ["a"], "99.5"), mapping)
    assert none["gold"] == {"timeseries": 0, "timeseries_agg_1min": 0} and none["serving"]["experiment_index"] == 0
    assert pipeline.validate_job(spark, layout).filter("status <> 'OK'").isEmpty()


def test_gold_job_that_breaks_off(spark, tmp_path, monkeypatch):
    layout, mapping = Layout(f"file://{tmp_path}/lake"), readers.literal_mapping(spark, MAPPING)
    pipeline.convert_job(spark, layout, files(spark, ["a"]), sheets(spark, ["a"]))
    bronze.ingest_all(spark, f"{layout.base}/converted", f"{layout.base}/bronze", f"{layout.base}/_checkpoints")
    pipeline.silver_job(spark, layout, mapping)
    monkeypatch.setattr(pipeline.gold, "bin_samples", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        pipeline.gold_job(spark, layout)
    monkeypatch.undo()
    n = count(spark, layout, "gold/timeseries")
    assert n > 0 and pipeline.gold_job(spark, layout)["timeseries_agg_1min"] > 0 and count(spark, layout, "gold/timeseries") == n
    assert pipeline.serving_job(spark, layout)["experiment_index"] == 1


def test_quality_in_the_stored_table(spark, tmp_path):
    """Rows that fail are flagged in bronze, files without any stay, and the stream doesn't read what was changed again."""
    layout = Layout(f"file://{tmp_path}")
    src = f"{tmp_path}/in"
    rules = [dq.Rule("t", "t", "timestamp", "not_null", is_blocking=True)]
    for part in (ROWS[:2], ROWS[2:4], ROWS[4:5]):
        long_rows(spark, part).coalesce(1).write.mode("append").parquet(src)
        bronze.ingest(spark, src, layout.table("bronze", "timeseries"), layout.checkpoint("b"), TIMESERIES)
    before = data(f"{tmp_path}/bronze/timeseries")
    assert pipeline.quality_job(spark, layout, rules, "flag_rows") == 5
    got = readers.read_table(spark, layout.table("bronze", "timeseries"))
    assert [r["sample_offset"] for r in got.filter("not is_valid").collect()] == [1] and got.count() == 5
    assert len(before & data(f"{tmp_path}/bronze/timeseries")) == 2
    assert pipeline.quality_job(spark, layout, rules, "flag_rows") == 0
    long_rows(spark, [ROWS[2][:2] + (7,) + ROWS[2][3:]]).coalesce(1).write.mode("append").parquet(src)
    bronze.ingest(spark, src, layout.table("bronze", "timeseries"), layout.checkpoint("b"), TIMESERIES)
    assert pipeline.quality_job(spark, layout, rules, "delete_rows") == 1
    left = readers.read_table(spark, layout.table("bronze", "timeseries"))
    assert sorted(r["sample_offset"] for r in left.collect()) == [0, 0, 1, 2, 3]


DUP = dq.Rule("dup", "dup", "channel_id", "no_duplicate_key", params={"key_columns": dq.KEYS}, is_blocking=True)
MONO = dq.Rule("mono", "mono", "timestamp", "monotonic_increasing", params={"partition_by": ["uuid", "group"], "order_by": ["sample_offset"], "format": None})


def point(k, t, channel="a", u="u"):
    return (u, "g", k, t, float(k), channel, 1.0, None)


def failed(spark, out):
    return sorted((r["rule_id"], r["uuid"] or "", r["sample_offset"], r["channel_id"]) for r in readers.read_table(spark, f"{out}/{quality.RESULT}").collect())


@pytest.mark.parametrize("batch_files", [1, 100])
def test_keys_and_order_across_batches(spark, tmp_path, batch_files):
    """However rows are cut into batches and runs, the failures are those of one batch."""
    drops = [
        [point(0, "1"), point(1, "5"), point(0, "1", u="v"), point(9, "1", u=None), point(9, "1", u=None)],
        [point(2, "3"), point(1, "5"), point(1, "4", u="v")],  # falls; a key again; rises in v
        [point(1, "5"), point(3, "3"), point(4, "2"), point(0, "1", u="v")],  # a key a third time; falls; a key of v again
        [point(5, "9")],
    ]
    src = f"{tmp_path}/in"
    rules = [dq.DEFAULT_RULES[0], DUP]
    for k, drop in enumerate(drops):
        long_rows(spark, drop).coalesce(1).write.mode("append").parquet(src)
        if k != 2:  # two drops in one run
            quality.check_stream(spark, src, f"{tmp_path}/out", f"{tmp_path}/check", rules, "write_clean_table", memory=f"{tmp_path}/memory", batch_files=batch_files)
    whole = long_rows(spark, [r for d in drops for r in d])
    want = sorted((r["rule_id"], r["uuid"] or "", r["sample_offset"], r["channel_id"]) for r in dq.evaluate_rules(whole, rules).collect())
    assert failed(spark, f"{tmp_path}/out") == want and len(want) == 5
    kept = sorted((r["uuid"] or "", r["sample_offset"]) for r in readers.read_table(spark, f"{tmp_path}/out/{quality.CLEAN}").collect())
    assert kept == sorted((r["uuid"] or "", r["sample_offset"]) for r in dq.clean(whole, dq.invalid_keys(dq.evaluate_rules(whole, rules))).collect())


@pytest.mark.parametrize("batch_files", [1, 100])
def test_order_across_batches(spark, tmp_path, batch_files, monkeypatch):
    from tslake.streaming import memory

    monkeypatch.setattr(memory, "FOLD", 2)
    src, rows = f"{tmp_path}/in", [point(k, str((k * 7) % 10), u=u) for k in range(12) for u in ("u", "v", None)]
    for lo in range(0, 36, 5):
        long_rows(spark, rows[lo : lo + 5]).coalesce(1).write.mode("append").parquet(src)
        if lo % 10 == 0:
            quality.check_stream(spark, src, f"{tmp_path}/out", f"{tmp_path}/check", [MONO, DUP], memory=f"{tmp_path}/memory", batch_files=batch_files)
    quality.check_stream(spark, src, f"{tmp_path}/out", f"{tmp_path}/check", [MONO, DUP], memory=f"{tmp_path}/memory", batch_files=batch_files)
    want = sorted((r["rule_id"], r["uuid"] or "", r["sample_offset"], r["channel_id"]) for r in dq.evaluate_rules(long_rows(spark, rows), [MONO, DUP]).collect())
    assert failed(spark, f"{tmp_path}/out") == want and len(want) > 9
    assert len(list(Path(f"{tmp_path}/memory/mono").glob("_batch=*"))) < 8


def test_nothing_stays_cached_after_batches(spark, tmp_path):
    """What rules with a memory store for a batch goes with the batch."""
    cached = lambda: set(spark.sparkContext._jsc.sc().getPersistentRDDs().keys().mkString(",").split(","))
    src, before = f"{tmp_path}/in", cached()
    for lo in (0, 3, 6):
        long_rows(spark, [point(k % 5, str(k)) for k in range(lo, lo + 3)]).coalesce(1).write.mode("append").parquet(src)
        quality.check_stream(spark, src, f"{tmp_path}/out", f"{tmp_path}/check", [MONO, DUP], memory=f"{tmp_path}/memory")
    assert cached() <= before and len(failed(spark, f"{tmp_path}/out")) > 3


def test_memory_is_read_between_a_batch_s_own_values(spark, tmp_path, monkeypatch):
    from tslake.streaming import memory

    monkeypatch.setattr(memory, "PUSHED_VALUES", 2)
    seen = memory.Memory(spark, f"{tmp_path}/m", ["k"])
    rows = spark.range(100).select(F.when(F.col("id") > 0, F.lpad(F.col("id").cast("string"), 2, "0")).alias("k"), F.lit(1).alias("n"))
    seen.write(rows, 0)
    seen.write(rows, 1)
    for own, want in ((["07", "09", "11", None], [None, "07", "08", "09", "10", "11"]), (["07", "11"], [None, "07", "11"]), ([None], [None])):
        found, _ = seen.before(1, spark.createDataFrame([(k,) for k in own], "k string"))
        assert sorted((r["k"] for r in found.collect()), key=str) == sorted(want, key=str)


def test_drops_of_events_are_numbered_once(spark):
    """Events' windows aren't computed anew for each drop."""
    from tests.test_jobs import shuffled_rows
    from tslake.plans import queries

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert shuffled_rows(spark, lambda: queries.stream_dq_order(spark, "/root/testdata/sf0.001")) < 6 * events


def test_batches_are_bounded_and_counted(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.range(120).selectExpr("cast(id as string) uuid", "'g' `group`", "id sample_offset", "'t' timestamp", "0d elapsed_time_s", "'c' channel_id", "1d value", "cast(null as string) value_str").repartition(120, "sample_offset").write.parquet(src)
    n = len(data(src))
    assert n > 40
    read = bronze.ingest(spark, src, f"{tmp_path}/bronze", f"{tmp_path}/check", TIMESERIES, batch_files=1)
    table = readers.read_table(spark, f"{tmp_path}/bronze")
    assert read == 120 == table.count() and table.select("_bronze_batch").distinct().count() >= n - 1


def test_columns_come_up(spark, tmp_path):
    """New columns are taken up by the same call; another type raises."""
    src, at = f"{tmp_path}/in", (f"{tmp_path}/bronze", f"{tmp_path}/check", TIMESERIES)
    assert bronze.evolved_schema(spark, "file:///root/testdata/sf0.001/region.parquet", "r_regionkey int", f"{tmp_path}/s") == "`r_regionkey` int, `r_name` string"
    long_rows(spark, ROWS[:2]).write.parquet(f"{src}/run=1")
    assert bronze.ingest(spark, src, *at, evolve=True) == 2
    long_rows(spark, ROWS[2:4]).withColumn("lab", F.lit("x")).write.parquet(f"{src}/run=2")
    assert bronze.ingest(spark, src, *at, evolve=True) == 2
    assert bronze.ingest(spark, src, *at, evolve=True) == 0
    long_rows(spark, ROWS[4:5]).write.parquet(f"{src}/run=3")
    assert bronze.ingest(spark, src, *at, evolve=True) == 1
    got = readers.read_table(spark, at[0])
    assert got.count() == 5 and {r["_run"] for r in got.filter("lab = 'x'").collect()} == {"2"} and "run" not in got.columns
    long_rows(spark, ROWS[4:5]).withColumn("lab", F.lit(1)).write.parquet(f"{src}/run=4")
    with pytest.raises(Exception, match="lab"):
        bronze.ingest(spark, src, *at, evolve=True)


def test_clustering_by_several_keys(spark, tmp_path):
    """Either key's filter reads few files; a second run does nothing, and additions alone are written again."""
    path = f"{tmp_path}/t"
    rows = spark.range(40_000).select((F.col("id") % 97).alias("a"), F.concat(F.lit("s"), F.lpad((F.col("id") * 31 % 89).cast("string"), 3, "0")).alias("b"), "id", F.when(F.col("id") % 50 > 0, F.col("id")).alias("c"))
    rows.repartition(4).write.parquet(path)

    def read(condition):
        return readers.read_table(spark, path).groupBy(F.col("_metadata.file_path")).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).toDF("f", "a0", "a1", "b0", "b1").filter(condition).count()

    size = sum(stored.file_sizes(spark, path).values())
    assert maintain.compact(spark, path, ["a", "b"], file_bytes=size // 16, small_bytes=size // 200) == {"files": 4, "rows": 40_000}
    n = len(data(path))
    assert n > 12 and read("a0 <= 50 and a1 >= 50") <= n // 2 and read("b0 <= 's040' and b1 >= 's040'") <= n // 2
    before = data(path)
    assert maintain.compact(spark, path, ["a", "b"], file_bytes=size // 16, small_bytes=size // 200)["files"] == 0 and data(path) == before
    rows.limit(100).coalesce(1).write.mode("append").parquet(path)
    again = maintain.compact(spark, path, ["a", "b"], file_bytes=size // 16, small_bytes=size // 200)
    assert again["files"] == 1 and before < data(path) and readers.read_table(spark, path).count() == 40_100
    assert maintain.compact(spark, f"{tmp_path}/none", ["a"])["files"] == 0
    one = maintain.clustered(rows, ["c"], 8)
    assert one.count() == 40_000
    assert maintain.clustered(rows.limit(0), ["a", "b"]).count() == 0


@pytest.mark.parametrize("bound", [100_000, 30, 0])
def test_orphans_whichever_side_is_small(spark, monkeypatch, bound):
    from tslake.operators import validate

    monkeypatch.setattr(validate, "BROADCAST_KEYS", bound)
    child = spark.range(1000).select((F.col("id") % 20).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("j"))
    parent = spark.range(500).select((F.col("id") + 5).alias("k2"), (F.col("id") % 2).alias("j2"))
    got = sorted(((r["k"], -1 if r["j"] is None else r["j"]) for r in validate.orphans(child, parent, ["k", "j"], ["k2", "j2"]).collect()))
    there = {(i + 5, i % 2) for i in range(500)}
    assert got == sorted({(i % 20, i % 3 if i % 7 else -1) for i in range(1000)} - there)
