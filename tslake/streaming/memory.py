"""What rules have to know of earlier batches: which keys have been seen, and the last sample of each sheet.

A rule's memory is a table with one small part for each batch. A batch that is run again replaces its own part and reads
only those before it, so results don't depend on how often it ran. Parts are sorted by their first key and read only
where the batch's own values of it lie (of many values, between the least and the greatest); when there are many, they are
folded into one. What a batch has stored in between goes with it (``release``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.operators import dq
from tslake.sources.readers import exists, read_table
from tslake.sources.stored import PUSHED_VALUES
from tslake.sources.writers import replace_table, restore, write_table

#: Parts from which a memory is folded.
FOLD = 16
#: Rules that look at more than a row.
KINDS = ("no_duplicate_key", "monotonic_increasing")


class Memory:
    def __init__(self, spark: SparkSession, folder: str, keys: list[str]):
        self.spark, self.folder, self.keys = spark, folder, keys

    def before(self, batch_id: int, near: DataFrame) -> tuple[DataFrame | None, Column]:
        """Rows of earlier batches whose first key is among those of ``near``, or a superset of them where these are many; and by what they were found."""
        if not exists(self.spark, self.folder):
            return None, F.lit(True)
        first = self.keys[0]
        span = near.agg(F.approx_count_distinct(first).alias("n"), F.min(first).alias("low"), F.max(first).alias("high")).first()
        values = [r[0] for r in near.select(first).distinct().limit(PUSHED_VALUES + 1).collect()] if span["n"] <= PUSHED_VALUES else None
        own = F.col(first).between(span["low"], span["high"]) if values is None or len(values) > PUSHED_VALUES else F.col(first).isin([v for v in values if v is not None])
        own = own | F.col(first).isNull()
        return self.spark.read.parquet(self.folder).filter(F.col("_batch") < batch_id).filter(own), own

    def write(self, rows: DataFrame, batch_id: int) -> None:
        write_table(rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys), f"{self.folder}/_batch={batch_id}", "overwrite")

    def fold(self, fold) -> None:
        """Makes one part of all but the latest, which may still be run again."""
        restore(self.spark, self.folder)
        if not exists(self.spark, self.folder):
            return
        table = read_table(self.spark, self.folder)
        batches = sorted(r[0] for r in table.select("_batch").distinct().collect())
        if len(batches) > FOLD:
            old, last = table.filter(F.col("_batch") < batches[-1]), table.filter(F.col("_batch") == batches[-1])
            one = fold(old).withColumn("_batch", F.lit(batches[-2]).cast(table.schema["_batch"].dataType))
            rows = one.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).unionByName(last)
            replace_table(rows, self.folder, ["_batch"])


class SeenKeys:
    """Rows whose key occurs more than once, in a batch or in all so far; of a key that was alone until now, the earlier row too."""

    def __init__(self, spark: SparkSession, folder: str, rule: dq.Rule, read):
        self.rule, self.keys, self.read, self.now = rule, list(rule.params["key_columns"]), read, None
        self.memory = Memory(spark, folder, self.keys)
        self.memory.fold(lambda d: d.groupBy(*self.keys).agg(F.sum("_n").alias("_n"), F.min_by("_file", "_batch").alias("_file")))

    def judge(self, df: DataFrame, batch_id: int) -> DataFrame:
        """``df`` has the path of a row's file in ``_file``.

        Rows and earlier keys meet in one sum. Files go by their hashes there: of texts Spark would sort rows to find the least.
        """
        known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys], dq.selected(self.rule))
        own, file, none = df.filter(known), F.xxhash64("_file"), F.lit(None).cast("long")
        old, near = self.memory.before(batch_id, own)
        met = own.select(*self.keys, F.lit(1).cast("long").alias("_n"), file.alias("_file"), none.alias("_before"), none.alias("_first"), none.alias("_batch"))
        if old is not None:
            met = met.unionByName(old.select(*self.keys, none.alias("_n"), none.alias("_file"), F.col("_n").alias("_before"), file.alias("_first"), F.col("_batch").cast("long").alias("_batch")))
        met = met.groupBy(*self.keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", "_before")], F.min("_file").alias("_file"), F.min_by("_first", "_batch").alias("_first"))
        self.now = met.filter("_n > 0").persist()
        out = own.join(self.now.filter("_n + _before > 1").select(*self.keys), self.keys, "left_semi").drop("_file")
        alone = self.now.filter("_before = 1")
        hashes = [r[0] for r in alone.select("_first").distinct().collect()] if old is not None else []
        if hashes:
            files = [r[0] for r in old.filter(file.isin(hashes)).select("_file").distinct().collect()]
            earlier = self.read(files).filter(known & near).join(alone.select(*self.keys), self.keys, "left_semi")
            out = out.unionByName(earlier.select(out.columns))
        names = own.select(file.alias("_hash"), F.col("_file").alias("_name")).distinct()
        named = self.now.join(F.broadcast(names), F.col("_file") == F.col("_hash"))
        self.memory.write(named.select(*self.keys, "_n", F.col("_name").alias("_file")), batch_id)
        return out

    def release(self) -> None:
        if self.now is not None:
            self.now.unpersist()


class LastSamples:
    """Samples whose value falls below the one before, which may be the last of the batches before.

    Batches are expected in order; a sample that comes late is compared with those of its own batch only.
    """

    def __init__(self, spark: SparkSession, folder: str, rule: dq.Rule, columns: list[str]):
        self.rule, (self.parts, self.order) = rule, dq.ordering(rule, columns)
        self.memory, self.found = Memory(spark, folder, self.parts), None
        self.memory.fold(lambda d: self._last(d).select(d.columns))

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.parts]
        return rows.groupBy(*self.parts).agg(F.max_by(F.struct(*rest), F.struct(*self.order)).alias("_row")).select(*self.parts, "_row.*")

    def judge(self, df: DataFrame, batch_id: int) -> DataFrame:
        own = df.drop("_file").filter(dq.selected(self.rule))
        target, plain = self.rule.target_column, list(dict.fromkeys([*self.parts, *self.order, self.rule.target_column]))
        old, _ = self.memory.before(batch_id, own)
        own = own.withColumn("_earlier", F.lit(False))
        if old is not None:
            last = self._last(old.drop("_batch"))
            own = own.unionByName(last.select(*plain, F.lit(True).alias("_earlier")), allowMissingColumns=True)
        ends = F.lead(F.lit(True)).over(W.partitionBy(*self.parts, F.lit(True)).orderBy(*self.order)).isNull()  # by the window of ``falling``
        self.found = dq.falling(own, F.col(target), self.rule, "_fails").withColumn("_ends", ends).filter("(_fails or _ends) and not _earlier").persist()
        self.memory.write(self.found.filter("_ends").select(*plain), batch_id)
        return self.found.filter("_fails").drop("_fails", "_ends", "_earlier")

    def release(self) -> None:
        if self.found is not None:
            self.found.unpersist()
