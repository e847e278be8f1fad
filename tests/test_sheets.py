"""Sheet grids on literal cells."""

import pytest
from pyspark.sql import functions as F

from tslake.operators import grid
from tslake.schemas import SHEET_CELLS


def cells(spark, sheets):
    rows = [("u", name, r, c, cell) for name, grid_ in sheets.items() for r, row in enumerate(grid_) for c, cell in enumerate(row)]
    return spark.createDataFrame(rows, SHEET_CELLS)


C1 = [
    ["Real time", None, "Time", "CH", "CH"],
    ["Real time", None, "Time", "Stack Voltage", "Current"],
    [None, None, "s", "V", "A"],
    ["2026-02-14 00:00:00", "1899-12-31 10:01:27", "0", "3.1", "10"],
    ["2026-02-14 00:00:00", "1899-12-30 10:01:28", "1", "n/a", "11"],
]
C6 = [C1[0], C1[1], C1[2], [None, None, "0", "3.1", "10"]]


@pytest.fixture(scope="module")
def out(spark):
    sheets = {
        "C1": C1,
        "C2": [["Voltage", "Efficiency"], ["V", "%"], ["3.1", "120"]],
        "C3": [["A", "B"], ["Name A", "Name B"], ["text", "123.4"]],
        "C4": [["A", "B"]],
        "C5": [["A", "B"], ["Name A", "Name B"], ["5", "6"], ["7", "8"]],
        "C6": C6,
        "C7": [["A"], ["Name A"]],
    }
    tables = grid.normalise(cells(spark, sheets))
    return {name: [r.asDict() for r in df.collect()] for name, df in tables.items()}


def of(out, table, group):
    return [r for r in out[table] if r["group"] == group]


def test_three_row_header(out):
    rows = of(out, "timeseries", "C1")
    assert {r["channel_id"] for r in rows} == {"CH", "CH_1", "Current density"}
    assert sorted({(r["sample_offset"], r["timestamp"], r["elapsed_time_s"]) for r in rows}) == [(0, "2026-02-14 10:01:27", 0.0), (1, "2026-02-14 10:01:28", 1.0)]
    value = {(r["channel_id"], r["sample_offset"]): (r["value"], r["value_str"]) for r in rows}
    assert value["CH", 0] == (3.1, None) and value["CH", 1] == (None, "n/a") and abs(value["Current density", 1][0] - 11000 / 88) < 1e-9
    channel = sorted((r["column_index"], r["channel_id"], r["raw_channel"], r["unit"]) for r in of(out, "channel", "C1"))
    assert channel == [(0, "CH", "Stack Voltage", "V"), (1, "CH_1", "Current", "A"), (2, "Current density", "Current density", "mA/cm²")]
    assert of(out, "statistics", "C1")[0]["n_timeseries_rows"] == 6


def test_two_row_header_and_limits(out):
    value = {r["channel_id"]: r["value"] for r in of(out, "timeseries", "C2")}
    assert value == {"Voltage": 3.1, "Efficiency": 100.0}
    assert {r["unit"] for r in of(out, "channel", "C2")} == {"V", "%"}


def test_no_units(out):
    assert {(r["channel_id"], r["value"], r["value_str"]) for r in of(out, "timeseries", "C3")} == {("A", None, "text"), ("B", 123.4, None)}
    assert {r["unit"] for r in of(out, "channel", "C3")} == {""}


def test_short_sheets_and_look_alikes(out):
    assert not of(out, "timeseries", "C4") and not of(out, "statistics", "C4") and not of(out, "statistics", "C7")
    assert {(r["channel_id"], r["value"]) for r in of(out, "timeseries", "C5")} == {("A", 7.0), ("B", 8.0)}


def test_all_null_pair(out):
    assert {r["timestamp"] for r in of(out, "timeseries", "C6")} == {None}
    assert {r["channel_id"] for r in of(out, "timeseries", "C6")} == {"CH", "CH_1", "Current density"}


@pytest.mark.parametrize(
    "date,time,expected",
    [
        ("2026-02-14 00:00:00", "1899-12-31 10:01:27", "2026-02-14 10:01:27"),
        ("2026-02-14", "10:01:27", "2026-02-14 10:01:27"),
        ("2026-02-14 00:00:00", None, None),
        (None, "1899-12-31 10:01:27", None),
        ("whenever it was", "later", "not merged"),
    ],
)
def test_date_time_merge(spark, date, time, expected):
    c = cells(spark, {"s": [["Real time", "unnamed", "V"], ["Real time", "", "Voltage"], [None, None, "V"], [date, time, "1"]]})
    head = grid.headers(c)
    pairs = grid.date_time_pairs(c, head)
    got = [r["timestamp"] for r in grid.merge_date_time(c, head, pairs).collect()]
    assert got == ([] if expected == "not merged" else [expected])


def test_named_partner_is_a_signal(spark):
    c = cells(spark, {"s": [["Real time", "Voltage"], ["Real time", "Voltage"], [None, "V"], ["2026-02-14 00:00:00", "1"]]})
    assert grid.date_time_pairs(c, grid.headers(c)).count() == 0


def test_mapping_names_the_pair(spark):
    c = cells(spark, {"s": [["Day", "Clock", "Cell"], ["Day", "Clock", "Cell"], [None, None, "V"], ["2026-02-14 00:00:00", "1899-12-31 01:02:03", "1"]]})
    mapping = spark.createDataFrame([("u", "day ", "Date"), ("u", "CLOCK", "Time"), ("u", "cell", "Stack Voltage")], "uuid string, raw_channel string, mapped_std_channel string")
    rows = grid.normalise(c, mapping)["timeseries"].collect()
    assert {r["timestamp"] for r in rows} == {"2026-02-14 01:02:03"} and {r["channel_id"] for r in rows} == {"Cell"}


def test_colliding_names(spark):
    c = cells(spark, {"s": [["CH", "CH", "CH_1"], ["a", "b", "c"], ["text", "text", "text"]]})
    assert [r["channel_id"] for r in grid.colliding_names(grid.headers(c)).collect()] == ["CH_1"]
    with pytest.raises(ValueError, match="s.*: CH_1"):
        grid.normalise(cells(spark, {"s": [["CH", "CH", "CH_1"], ["a", "b", "c"], ["V", "V", "V"], ["1", "2", "3"]]}))


def _sorted(df):
    return sorted(df.collect(), key=str)


@pytest.mark.parametrize("most", [0, 100_000])
def test_rows_and_long_grids_agree(spark, monkeypatch, most):
    """By rows or long, broadcast or not; rows that end early lack cells, and date and time may come late."""
    late = [*C1[:3], *[[None, None, str(k), "2", "3"] for k in range(9)], *C1[3:], ["2026-02-15"], ["2026-02-15 00:00:00", "1899-12-31 10:00:00", "9"]]
    sheets = {"a": C1, "late": late, "none": C6, "text": [["A", "B"], ["Name A", "Name B"], ["text", "123.4"]]}
    rows = [("u", name, r, row) for name, sheet in sheets.items() for r, row in enumerate(sheet)]
    monkeypatch.setattr(grid, "BROADCAST_COLUMNS", most)
    by_rows = grid.normalise(spark.createDataFrame(rows, "uuid string, `group` string, row_idx long, cells array<string>"))
    long = grid.normalise(cells(spark, sheets))
    for name, df in by_rows.items():
        assert _sorted(df) == _sorted(long[name])
    got = [r for r in by_rows["timeseries"].collect() if r["group"] == "late"]
    assert len(got) == 11 * 3 and {r["timestamp"] for r in got if r["sample_offset"] >= 9} == {"2026-02-14 10:01:27", "2026-02-14 10:01:28"}


def test_a_samples_cells_stay_together(spark, monkeypatch):
    """Without broadcasts the rows are shuffled once, to their sheet's columns; cells never are."""
    monkeypatch.setattr(grid, "BROADCAST_COLUMNS", 0)
    rows = spark.createDataFrame([("u", "s", r, row) for r, row in enumerate(C1)], "uuid string, `group` string, row_idx long, cells array<string>")
    plan = grid.normalise(rows)["timeseries"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan.split("Generate")[0]


def test_files_left_out(spark):
    """Only sheets of the named files are normalised."""
    both = cells(spark, {"s": C1}).union(cells(spark, {"s": C1}).withColumn("uuid", F.lit("v")))
    tables = grid.normalise(both, files=spark.createDataFrame([("v",)], "uuid string"))
    assert all({r["uuid"] for r in df.collect()} == {"v"} for df in tables.values())
