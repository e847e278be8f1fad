"""The given tables seen as measurement data: events as long series, line items as wide sheets and grids, orders as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.operators import dims, gold
from tslake.sources.readers import literal_mapping

MAPPING_ROWS = [
    ("S0", "view", "Stack Voltage"), ("S0", "click", "Current density"), ("S1", "view", "Faradaic Efficiency of CO"),
    ("S2", "purchase", "Energy Efficiency"), ("S3", "error", "Single Pass Conversion Efficiency"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(c: str) -> F.Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def events_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long series: a user is a file, the parity of an event a sheet, its type a channel."""
    e = table(spark, sf_dir, "events").withColumn("_odd", F.col("event_id") % 2)
    w = W.partitionBy("user_id", "_odd")
    return e.select(
        F.col("user_id").cast("string").alias("uuid"), F.concat(F.lit("g"), F.col("_odd").cast("string")).alias("group"),
        (F.row_number().over(w.orderBy("ts", "event_id")) - 1).cast("long").alias("sample_offset"), F.col("event_type").alias("channel_id"),
        ((micros("ts") - F.min(micros("ts")).over(w)) / 1e6).alias("elapsed_time_s"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "value", F.lit(None).cast("string").alias("value_str"), F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("series"), "event_id", "props",
    )


def mapping(spark: SparkSession) -> DataFrame:
    return literal_mapping(spark, MAPPING_ROWS)


def event_files(long: DataFrame) -> DataFrame:
    """File rows of the event sheets."""
    return long.groupBy("uuid", "group", "series").agg(F.count("*").alias("file_size"), F.max("timestamp").alias("_t")).select(
        "uuid", F.concat_ws("/", "series", F.concat(F.col("uuid"), F.lit(".xlsx"))).alias("file_path"), F.concat(F.col("uuid"), F.lit(".xlsx")).alias("raw_file_name"),
        "file_size", F.to_timestamp("_t").alias("last_modified"), F.to_timestamp("_t").alias("ingested_timestamp"), "series", "group",
    )


def event_channels(long: DataFrame) -> DataFrame:
    c = long.select("uuid", "group", "channel_id").distinct()
    index = (F.row_number().over(W.partitionBy("uuid", "group").orderBy("channel_id")) - 1).cast("int")
    return c.select("uuid", "group", "channel_id", F.col("channel_id").alias("raw_channel"), F.concat(F.lit("u"), F.length("channel_id").cast("string")).alias("unit"), index.alias("column_index"))


def event_signals(spark: SparkSession, long: DataFrame) -> DataFrame:
    experiments = dims.dim_experiment(long, event_files(long))
    return dims.dim_signal(event_channels(long), experiments, mapping(spark))


def event_bins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(long series, signals, one-minute bins)."""
    long = events_long(spark, sf_dir)
    signals = event_signals(spark, long)
    return long, signals, gold.bin_samples(gold.gold_fact(long, signals))


SHEET_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def lineitem_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide samples with the inputs of the metrics: a supplier is a file, a return flag a sheet."""
    w = W.partitionBy("l_suppkey", "l_returnflag").orderBy(*SHEET_ORDER)
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("file-"), c("l_suppkey").cast("string")).alias("uuid"), c("l_returnflag").alias("group"), (F.row_number().over(w) - 1).cast("long").alias("sample_offset"),
        c("l_quantity").alias("current"), (c("l_extendedprice") / 10000).alias("v_stack"), (c("l_discount") * 1000).alias("fe_co"), (c("l_tax") * 1000).alias("fe_h2"),
        (c("l_quantity") * 2).alias("fe_o2"), (c("l_quantity") / 10).alias("co2_in"), (c("l_discount") * 1000).alias("ratio"), c("l_tax").alias("p_in"), c("l_discount").alias("p_out"),
    )


def lineitem_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long samples keyed by order and line; those keys repeat in the table."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("file-"), F.col("l_suppkey").cast("string")).alias("uuid"), F.col("l_returnflag").alias("group"), F.col("l_orderkey").alias("sample_offset"),
        F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("channel_id"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("l_quantity").alias("value"), F.lit(None).cast("string").alias("value_str"),
    )


#: Header rows of the grids: ids, names, units.
HEADER = [
    ["Real time", None, "Time", "CH", "CH", "Efficiency", "Note"],
    ["Real time", None, "Time", "Stack Voltage", "Current", "Efficiency", "Note"],
    [None, None, "s", "V", "A", "%", None],
]


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids by rows: for each supplier and return flag a sheet of three header rows and its line items as text.

    Sheets of flag ``R`` have no unit row, those of flag ``N`` no row of names.
    """
    w = W.partitionBy("l_suppkey", "l_returnflag").orderBy(*SHEET_ORDER)
    c = F.col
    rows = table(spark, sf_dir, "lineitem").withColumn("_n", F.row_number().over(w) - 1).select(
        F.concat(F.lit("file-"), c("l_suppkey").cast("string")).alias("uuid"), c("l_returnflag").alias("group"),
        (c("_n") + F.when(c("l_returnflag") == "A", 3).otherwise(2)).cast("long").alias("row_idx"),
        F.array(
            F.date_format("l_shipdate", "yyyy-MM-dd 00:00:00"), F.concat(F.lit("1899-12-31 10:"), F.lpad((c("_n") % 60).cast("string"), 2, "0"), F.lit(":00")),
            (c("_n") + 10).cast("string"), c("l_quantity").cast("int").cast("string"), (c("l_quantity") * 10).cast("int").cast("string"), (c("l_linenumber") * 30).cast("string"), F.concat(F.lit("is "), c("l_linestatus")),
        ).alias("cells"),
    )
    sheets = rows.select("uuid", "group").distinct()
    names, units = (F.array(*[F.lit(x).cast("string") for x in HEADER[k]]) for k in (1, 2))
    top = F.array(*[F.lit(x).cast("string") for x in HEADER[0]])
    head = sheets.select("uuid", "group", F.posexplode(F.when(c("group") == "A", F.array(top, names, units)).when(c("group") == "N", F.array(top, units)).otherwise(F.array(top, names))).alias("row_idx", "cells"))
    return rows.unionByName(head.withColumn("row_idx", c("row_idx").cast("long")))


def lineitem_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same grids, long."""
    return lineitem_rows(spark, sf_dir).select("uuid", "group", "row_idx", F.posexplode("cells").alias("col_idx", "cell"))


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listed files."""
    path = F.concat(F.lit("series-"), (F.col("o_custkey") % 10).cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".xlsx"))
    return table(spark, sf_dir, "orders").select(
        path.alias("blob_path"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".xlsx")).alias("file_name"), F.col("o_orderkey").alias("file_size"),
        F.col("o_orderdate").cast("timestamp").alias("last_modified"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"), (F.col("o_orderkey") % 8).cast("int").alias("retry_count"),
    )


def order_tracking(files: DataFrame) -> DataFrame:
    """Tracking rows of two thirds of the files; every fifth in an older version."""
    none = F.lit(None).cast("string")
    return files.filter("file_size % 3 <> 0").select(
        "blob_path", "file_name", "file_size", none.alias("file_uuid"), F.when(F.col("file_size") % 5 == 0, F.col("last_modified") - F.expr("interval 1 day")).otherwise(F.col("last_modified")).alias("last_modified"),
        "status", F.col("last_modified").alias("processed_at"), none.alias("output_paths"), F.when(F.col("status") == "FAILED", "bad").alias("error_message"), F.lit(1.0).alias("duration_seconds"), "retry_count",
    )
