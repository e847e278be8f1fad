"""Scalar expressions on literal rows."""

import uuid

from pyspark.sql import functions as F

from tslake.functions import values as V
from tslake.operators import derived, longform


def column(spark, expr, xs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, c {kind}")
    return [r[1] for r in df.select("i", expr(F.col("c"))).orderBy("i").collect()]


def test_numbers(spark):
    xs = ["1", "-1.5", ".5", "5.", "1e3", "inf", "-Infinity", "1d", "1.5f", " 1", "", "abc", None, "1,5", "0x1"]
    got = column(spark, V.num, xs)
    assert got[:7] == [1.0, -1.5, 0.5, 5.0, 1000.0, float("inf"), float("-inf")] and got[7:] == [None] * 8
    text = column(spark, V.text_if_not_number, ["text_value", "123.4", None, ""])
    assert text == ["text_value", None, None, ""]


def test_clip_and_bins(spark):
    assert column(spark, V.clip_percent, [-1.0, 50.0, 120.0, float("nan"), float("inf"), None], "double") == [0.0, 50.0, 100.0, None, 100.0, None]
    assert column(spark, lambda c: V.time_bin(c, 60), [0.0, 59.9, 60.0, -0.5], "double") == [0, 0, 60, -60]
    assert column(spark, V.finite, [1.0, float("nan"), float("inf")], "double") == [1.0, None, None]


def test_names(spark):
    assert column(spark, V.sanitize_name, ["a b/c", "__x__", "a<>b", None, "[q](r)"]) == ["a_b_c", "x", "a_b", None, "q_r"]
    assert column(spark, V.is_unit_cell, ["V", "A", "mA/cm2", "degC", "123.4", "hello", " ", None, "%", "5"]) == [True, True, True, False, False, False, False, False, True, True]
    assert column(spark, V.series_from_path, ["a/b/c.xlsx", "c.xlsx", "x\\y\\z.xls", "//s/f", None]) == ["b", None, "y", "s", None]
    assert column(spark, V.file_uuid, ["a/b.xlsx", "", "é/ü.xlsx"]) == [str(uuid.uuid5(uuid.UUID(V.FILE_NAMESPACE), p)) for p in ("a/b.xlsx", "", "é/ü.xlsx")]


def test_timestamps(spark):
    xs = ["2024-06-01 10:00:00", "2024-06-01 10:00:00.5", "2024/06/01 10:00:00", "01.06.2024 10:00:00", "06/01/2024 10:00:00", "2024-06-01T10:00:00", "2024-06-01T10:00:00.250", "2024-06-01", "nope", None]
    got = column(spark, lambda c: F.date_format(V.parse_ts(c), "yyyy-MM-dd HH:mm:ss"), xs)
    assert got[:7] == ["2024-06-01 10:00:00"] * 7 and got[7] == "2024-06-01 00:00:00" and got[8:] == [None, None]


def test_metrics(spark):
    row = dict(current=50.0, v_stack=15.0, fe_co=80.0, fe_h2=15.0, fe_o2=95.0, co2_in=2.0, ratio=60.0, p_in=1.2, p_out=1.0)
    r = derived.derived_wide(spark.createDataFrame([row])).first()
    f, vm = 96485.3, 22.414
    co, o2 = 0.8 * 50 / (2 * f) * vm * 60, 0.95 * 50 / (4 * f) * vm * 60
    assert abs(r["Energy Efficiency"] - 1.48 * 80 / 3) < 1e-9 and abs(r["Current density"] - 50000 / 88) < 1e-9 and abs(r["Flow CO out"] - co) < 1e-9
    assert abs(r["Flow CO2 out, cathode"] - (2 - co - 0.6 * o2 / 0.4)) < 1e-9 and abs(r["Δp Anolyte"] - 0.2) < 1e-9
    assert abs(r["Single Pass Conversion Efficiency"] - 100 * (50 * 0.8 / (2 * f)) / (2 / 60 / 5 / vm)) < 1e-9
    zero = derived.derived_wide(spark.createDataFrame([row | {"v_stack": 0.0, "fe_h2": 0.0, "ratio": 100.0}])).first()
    assert zero["Energy Efficiency"] is None and zero["CO/H2 ratio recalculated"] is None and zero["Flow CO2 out, anode"] is None
    area = spark.createDataFrame([("b", 50.0), ("a", None)], "series string, active_area_cm2 double")
    assert derived.active_area(area) == 50.0 and derived.active_area(None) == 88.0 and derived.active_area(area.limit(0)) == 88.0


def test_unpivot_keeps_nulls(spark):
    wide = spark.createDataFrame([(1, "text_value", None), (2, "123.4", 5.0)], "id int, a string, `b c` double")
    got = sorted(map(tuple, longform.split_value(longform.unpivot_long(wide, ["a", "b c"], ["id"])).collect()), key=repr)
    assert got == sorted([(1, "a", None, "text_value"), (1, "b c", None, None), (2, "a", 123.4, None), (2, "b c", 5.0, None)], key=repr)


def test_series_keeps_its_digits(spark):
    paths = ["series-0/a.xlsx", "1/10/11/b.xlsx", " S2 /c.xlsx", "lonely.xlsx", "00\\11\\d.xlsx"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(V.series_from_path(F.col("p"))).collect()
    assert [r[0] for r in got] == ["series-0", "11", "S2", None, "11"]
