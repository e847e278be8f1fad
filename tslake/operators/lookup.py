"""Many rows that meet what is known of their sheets, a row a sheet, without being shuffled where that can be.

What is broadcast passes through the driver, so it is bounded here: by a count of rows, and with many ids in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHEET = ["uuid", "group"]
#: Sheets or experiments up to which their ids are broadcast, and different kinds of sheets up to which these are.
BROADCAST_IDS, BROADCAST_KINDS = 2_000_000, 1000
#: Ids up to which each is a row of its broadcast (some 70 bytes); more are packed, about so many in a row (some 20 bytes each).
PLAIN_IDS, PACKED_IDS = 100_000, 16

#: Hashes pass over nulls, and so over their places; texts show them, and all digits of times.
_EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def many(df: DataFrame) -> DataFrame:
    """``df`` as a side of joins that is never broadcast by Spark's own guess.

    The guess takes the bytes of compressed files for those of rows. Names that repeat for each sheet compress so well that
    files of a few MB, below Spark's threshold, make a hash table of a GB on the driver.
    """
    return df.hint("merge")


def _place(c: str, n: int) -> Column:
    """Which of the rows that ``n`` ids are packed into holds an id."""
    return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(n // PACKED_IDS + 1).cast("long"))


def meet_packed(rows: DataFrame, ids: DataFrame, key: str, n: int, how: str = "left_semi") -> DataFrame:
    """Rows whose ``key``, a whole number, is one of ``ids`` (``left_semi``) or is none (``left_anti``); these are ``n``, distinct and not null."""
    packed = ids.groupBy(_place(key, n).alias("_place")).agg(F.collect_list(F.col(key).cast("long")).alias("_ids"))
    return rows.join(F.broadcast(packed), (_place(key, n) == F.col("_place")) & F.array_contains("_ids", F.col(key).cast("long")), how)


def with_sheets(rows: DataFrame, sheets: DataFrame, few: bool = False) -> DataFrame:
    """Rows with the columns of their sheet; rows of other sheets go. ``sheets`` (uuid, group, ...) may be many.

    ``few``: they are known to be so few that all of them can be broadcast. Else sheets that are alike but for their ids make
    a kind; where there are few kinds, these are broadcast, and beside them each sheet's hash with that of its kind, many in a row. Sheets
    of many kinds, or too many, meet their rows by a shuffle, and neither side is sorted for it.
    """
    from tslake.sources.writers import written

    if few:
        return rows.join(F.broadcast(sheets), SHEET)
    told = [c for c in sheets.columns if c not in SHEET]
    known = sheets.select(*SHEET, F.xxhash64(*SHEET).alias("_sheet"), F.xxhash64(F.to_json(F.struct(*told), _EXACT)).alias("_kind"), *told)
    known = written(known.filter("uuid is not null and `group` is not null"))
    n = known.agg(F.count("*").alias("sheets"), F.approx_count_distinct("_kind", 0.02).alias("kinds")).first()
    if n["sheets"] > BROADCAST_IDS or n["kinds"] > BROADCAST_KINDS:
        return rows.join(known.drop("_sheet", "_kind").hint("shuffle_hash"), SHEET)
    kinds = known.select("_kind", *told).dropDuplicates(["_kind"])
    own, ids = rows.filter("uuid is not null and `group` is not null").withColumn("_sheet", F.xxhash64(*SHEET)), known.select("_sheet", "_kind")
    if n["sheets"] <= PLAIN_IDS:
        return own.join(F.broadcast(ids), "_sheet").join(F.broadcast(kinds), "_kind").drop("_sheet", "_kind")
    packed = ids.groupBy(_place("_sheet", n["sheets"]).alias("_place")).agg(F.collect_list(F.struct("_sheet", "_kind")).alias("_of"))
    packed = packed.select("_place", F.col("_of._sheet").alias("_sheets"), F.col("_of._kind").alias("_kinds"))
    found = own.withColumn("_place", _place("_sheet", n["sheets"])).join(F.broadcast(packed), "_place")
    found = found.withColumn("_kind", F.get("_kinds", F.array_position("_sheets", F.col("_sheet")) - 1))
    return found.join(F.broadcast(kinds), "_kind").drop("_place", "_sheets", "_kinds", "_sheet", "_kind")


def of_ids(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key``, a whole number, is in ``ids``; these are distinct, not null and stored, as they are counted first."""
    n = ids.count()
    if PLAIN_IDS < n <= BROADCAST_IDS:
        return meet_packed(rows, ids, key, n)
    return rows.join(F.broadcast(ids.select(key)) if n <= BROADCAST_IDS else ids.select(key).hint("shuffle_hash"), key, "left_semi")
