"""Readers: file listings, sheet grids, tables, mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.functions.values import extension, file_uuid
from tslake.schemas import MAPPING


def list_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ("xlsx", "xls")) -> DataFrame:
    """(blob_path, file_name, file_size, file_uuid, last_modified, extension) of the files below ``folder``; contents aren't read.

    Paths are relative to ``folder``; extensions are compared in lower case.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "modificationTime", "length")
    root = "/" + folder.split("://")[-1].strip("/") + "/"
    relative = F.substring_index("path", root, -1)
    out = files.select(
        relative.alias("blob_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("file_size"),
        file_uuid(relative).alias("file_uuid"), F.col("modificationTime").alias("last_modified"), extension(F.col("path")).alias("extension"),
    )
    return with_extensions(out, extensions)


def with_extensions(files: DataFrame, extensions: tuple[str, ...]) -> DataFrame:
    return files.filter(F.col("extension").isin(*[e.lower().lstrip(".") for e in extensions]))


def _decoded(path: Column) -> Column:
    """A path as it is, from the form with escapes in which Spark tells a row's file."""
    return F.url_decode(F.regexp_replace(path, r"\+", "%2B"))


#: Splits up to which their row numbers are broadcast (some 200 bytes each).
BROADCAST_SPLITS = 500_000


def read_grid(spark: SparkSession, folder: str, columns: int = 0, group: str = "Sheet1", by_folder: bool = False, sep: str = ",") -> DataFrame:
    """Cells of header-less CSV sheets below ``folder``, as many columns as the longest row of a sheet has (at least ``columns``).

    A file is a sheet, its id from its path; with ``by_folder`` the files of a folder are the sheets of one workbook, named
    like the files. Fields may be quoted, but don't go over lines. Rows are numbered by their line, blank ones count. Empty
    cells, and those that shorter rows lack, are null. Files that can't be read give no cells (``unread`` lists them).

    Lines are numbered by the tasks that read them: how many lines each split has is counted first, and what comes before
    a split is added to the number within it.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).text(folder)
    root = "/" + folder.split("://")[-1].strip("/") + "/"
    quote = F.col("value").startswith(sep) | F.col("value").contains('"')  # most lines need no pattern
    fields = F.regexp_extract_all(F.concat("value", F.lit(sep)), F.lit(f'("[^"]*+(?:""[^"]*+)*+"|[^{sep}]*+){sep}'), F.lit(1))  # no field can end in two ways, so none is tried twice
    plain = F.transform(fields, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) >= 2), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    cells = F.when(quote, plain).otherwise(F.split("value", f"[{sep}]"))
    lines = raw.select(
        _decoded(F.substring_index("_metadata.file_path", root, -1)).alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_in"), cells.alias("_cells"),
    )
    splits = lines.groupBy("_path", "_start").agg(F.min("_in").alias("_first"), F.count("*").alias("_lines"), F.max(F.size("_cells")).alias("_size"))
    before = F.coalesce(F.sum("_lines").over(W.partitionBy("_path").orderBy("_start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    known = splits.select("_path", "_start", (before - F.col("_first")).alias("_add"), F.greatest(F.max("_size").over(W.partitionBy("_path")), F.lit(columns)).alias("_width"), F.lit(True).alias("_known"))
    known = known.persist()
    few = known.count() <= BROADCAST_SPLITS
    rows = lines.join(F.broadcast(known) if few else known, ["_path", "_start"], "left")
    number = F.when(F.col("_known"), F.col("_in") + F.col("_add")).otherwise(F.raise_error(F.lit("files changed while they were read")).cast("long"))
    padded = F.concat("_cells", F.array_repeat(F.lit(None).cast("string"), F.col("_width") - F.size("_cells")))
    stem = F.regexp_replace(F.element_at(F.split("_path", "/"), -1), r"\.[^.]*$", "")
    book = F.regexp_extract("_path", "^(.*)/[^/]*$", 1)
    sheets = rows.select((file_uuid(book) if by_folder else file_uuid(F.col("_path"))).alias("uuid"), (stem if by_folder else F.lit(group)).alias("group"), number.alias("row_idx"), padded.alias("_cells"))
    out = sheets.select("uuid", "group", "row_idx", F.posexplode("_cells").alias("col_idx", "cell"))
    return out.withColumn("cell", F.nullif("cell", F.lit("")))


def unread(files: DataFrame, cells: DataFrame) -> DataFrame:
    """Listed files of which no cell could be read, with a message."""
    return files.join(cells.select(F.col("uuid").alias("file_uuid")).distinct(), "file_uuid", "left_anti").withColumn("error_message", F.lit("unreadable or empty"))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a table, in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table, the union of its files' columns; where it is missing, an empty one of ``schema``.

    Columns of ``schema`` that an older table lacks are null.
    """
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    none = empty(spark, schema)
    if not exists(spark, path):
        return none
    found = spark.read.option("mergeSchema", True).parquet(path)
    return found.withColumns({f.name: F.lit(None).cast(f.dataType) for f in none.schema if f.name not in found.columns} or {found.columns[0]: F.col(found.columns[0])})


def channel_mapping(spark: SparkSession, folder: str, for_converter: bool = False) -> DataFrame:
    """(series, raw_channel, mapped_std_channel) of the series that ``series_config.json`` names.

    The config maps a series to its mapping file, a JSON list of entries. Keys that begin with an underscore and files
    that are missing are skipped, names are trimmed and blank ones dropped. Calculated channels, dates and times are
    dropped too, except for the converter, which needs them.
    """
    config = spark.read.text(f"{folder}/series_config.json", wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("series", "_file"))
    config = config.filter(~F.startswith("series", F.lit("_")))
    entries = spark.read.option("multiLine", True).schema("schema_column string, file_column string, origin string").option("pathGlobFilter", "*_mapping.json").json(folder)
    entries = entries.withColumn("_file", _decoded(F.element_at(F.split("_metadata.file_path", "/"), -1)))
    config = config.withColumn("_file", F.element_at(F.split("_file", "/"), -1))
    out = entries.join(config, "_file").select("series", F.trim("file_column").alias("raw_channel"), F.trim("schema_column").alias("mapped_std_channel"), "origin")
    out = out.filter("raw_channel <> '' and mapped_std_channel <> ''")
    if not for_converter:
        out = out.filter("coalesce(origin, '') <> 'calculation' and lower(mapped_std_channel) not in ('date', 'time')")
    return out.select("series", "raw_channel", "mapped_std_channel").distinct()


def literal_mapping(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, MAPPING)
