"""Compaction: rows in files that are sorted by their keys, so that filters skip files and row groups by their minima and maxima."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslake.sources import stored
from tslake.sources.readers import exists, read_table

#: Bits of a key's place on the curve, rows by which its steps are chosen, bytes of a file, and of one that is too small.
BITS, SAMPLE_ROWS, FILE_BYTES, SMALL_BYTES = 6, 20_000, 256 << 20, 64 << 20


def sorted_by_range(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def steps(df: DataFrame, keys: list[str], rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each key up to 2 ** BITS - 1 values that part its rows evenly, from a sample of about ``rows`` rows."""
    n = df.count()
    sample = df.select(*keys).sample(min(1.0, rows / max(n, 1)), seed=7).limit(2 * rows).collect()
    out = {}
    for k in keys:
        values = sorted(r[k] for r in sample if r[k] is not None)
        even = [values[len(values) * i >> BITS] for i in range(1, 1 << BITS)] if values else []
        out[k] = list(dict.fromkeys(even))
    return out


def curve(steps_of: dict[str, list]) -> Column:
    """A row's place on a curve that passes near rows one after another, whichever key they are near by: the keys' bits in turn."""
    reached = {k: F.size(F.filter(F.array(*[F.lit(v) for v in values]), lambda x: x <= F.col(k))) if values else F.lit(0) for k, values in steps_of.items()}  # noqa: B023
    place = {k: F.floor(c * (1 << BITS) / (len(steps_of[k]) + 1)) for k, c in reached.items()}  # a key of few values uses all bits too
    place = {k: F.when(F.col(k).isNull(), 0).otherwise(c).cast("long") for k, c in place.items()}
    bits = [F.shiftleft(F.shiftright(c, b).bitwiseAND(1), b * len(place) + i) for i, c in enumerate(place.values()) for b in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def clustered(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    """``df`` in files of rows that are near each other by all of ``keys``; by one key it is a sort by range."""
    if len(keys) == 1:
        return sorted_by_range(df, keys, files)
    out = df.withColumn("_place", curve(steps(df, keys)))
    dealt = out.repartitionByRange(files, "_place") if files else out.repartitionByRange("_place")
    return dealt.sortWithinPartitions("_place", *keys).drop("_place")


def compact(spark: SparkSession, path: str, keys: list[str], file_bytes: int = FILE_BYTES, small_bytes: int = SMALL_BYTES) -> dict[str, int]:
    """Clusters what has been added to a table since the last time, with files that are too small; all else stays as it is.

    Returns the numbers of files and rows that were written again; without additions a second run does nothing.
    """
    stored.recover(spark, path)
    if not exists(spark, path):
        return {"files": 0, "rows": 0}
    sizes = stored.file_sizes(spark, path)
    settled = {f for f in sizes if f.rpartition("/")[2].startswith("cow-")}
    small = {f for f in settled if sizes[f] < small_bytes}
    pick = sorted(set(sizes) - settled | (small if len(small) > 1 or set(sizes) - settled else set()))
    if not set(sizes) - settled and sum(sizes[f] for f in small) < 2 * small_bytes:
        return {"files": 0, "rows": 0}  # no more than one file of the right size would come of it
    schema = read_table(spark, path).schema
    rows = spark.read.option("basePath", path).schema(schema).parquet(*pick)
    files = max(1, -(-sum(sizes[f] for f in pick) // file_bytes))
    parts = stored.partition_columns(spark, path)
    return {"files": len(pick), "rows": stored.swap_files(clustered(rows, keys, files), path, pick, parts)}
