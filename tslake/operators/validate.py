"""Checks of written tables, as rows of a report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = "check string, status string, detail string, n bigint"


def row_count(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n")).select(F.lit(f"exists:{name}").alias("check"), F.lit("OK").alias("status"), F.lit("").alias("detail"), "n")


def required_columns(spark: SparkSession, name: str, columns: list[str], required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in columns]
    return spark.createDataFrame([(f"columns:{name}", "FAILED" if missing else "OK", ",".join(missing), len(missing))], REPORT)


#: Distinct keys up to which a side is broadcast (some 100 bytes each).
BROADCAST_KEYS = 100_000


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str], parent_keys: list[str] | None = None) -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` hasn't; a null key is an orphan.

    If either side has few distinct keys these go to the other's rows, so that a table of facts isn't shuffled: a small
    parent is looked up by the child's rows, and only orphans are made distinct; of a large parent only rows with one of the
    few keys of a child are looked at.
    """
    parent_keys = parent_keys or child_keys
    own = child.select(*child_keys)
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)])
    few = known.dropna().distinct().persist()
    if few.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        return own.join(F.broadcast(few), child_keys, "left_anti").distinct()
    few.unpersist()
    asked = own.distinct().persist()
    if asked.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        found = known.join(F.broadcast(asked), child_keys, "left_semi").distinct()
        return asked.join(found, child_keys, "left_anti")
    return asked.join(known.distinct(), child_keys, "left_anti")


def orphan_check(name: str, child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    out = orphans(child, parent, keys).agg(F.count("*").alias("n"))
    return out.select(F.lit(f"orphans:{name}").alias("check"), F.when(F.col("n") == 0, "OK").otherwise("FAILED").alias("status"), F.lit("").alias("detail"), "n")


def report(checks: list[DataFrame], fail_on_error: bool = False) -> DataFrame:
    """All checks together; raises if one failed and ``fail_on_error``."""
    out = reduce(DataFrame.unionByName, checks)
    if fail_on_error:
        bad = [r["check"] for r in out.filter("status <> 'OK'").select("check").collect()]
        if bad:
            raise RuntimeError("validation failed: " + ", ".join(sorted(bad)))
    return out
