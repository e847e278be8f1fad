"""Data-quality rules on a stream of bronze rows, in batches of bounded size."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tslake.operators import dq
from tslake.schemas import TIMESERIES
from tslake.sources import stored
from tslake.sources.readers import exists
from tslake.streaming.bronze import BATCH_FILES, source
from tslake.streaming.memory import KINDS, LastSamples, SeenKeys

RESULT, SUMMARY, CLEAN = "fact_timeseries_dq_result", "fact_timeseries_dq_summary", "fact_timeseries_clean"
MODES = ("metadata_only", "write_clean_table", "flag_rows", "delete_rows")


def _write(df: DataFrame, path: str) -> None:
    """Replaces a batch's own partition, so that a batch that is run again doesn't double its rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dq_batch_id").parquet(path)


def _earlier_rows(spark: SparkSession, schema: str):
    """Reads files of earlier batches again; of a file that is gone, those that changes of the table have left in its folder."""

    def read(files: list[str]) -> DataFrame:
        there = [f for f in files if exists(spark, f)]
        changed = {f.rpartition("/")[0] + "/cow-*" for f in files if f not in set(there)}
        return spark.read.schema(schema).parquet(*there, *sorted(changed))

    return read


def check_stream(
    spark: SparkSession, bronze: str, out: str, checkpoint: str, rules: list[dq.Rule] | None = None, mode: str = "metadata_only", blocking_only: bool = True, schema: str = TIMESERIES,
    batch_files: int = BATCH_FILES, memory: str | None = None,
) -> int:
    """Failures and summary of each batch of new rows; returns the rows that were read.

    ``mode`` says what becomes of rows that fail (a blocking rule, or any): with ``write_clean_table`` all others are
    written to a table of their own; with ``flag_rows`` they get ``is_valid`` false in the table ``bronze`` itself, and with
    ``delete_rows`` they go from it, once all batches are done. Only files that hold such rows are written again, and a
    later run doesn't read those as new.

    ``memory`` names a folder for what rules on keys and on order have to know of earlier batches. With it all batches
    together give what one batch of all rows would, if samples come in order: a row whose key comes up a second time
    later is reported then, and goes from the clean table. Without it such rules see one batch at a time.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    rules = [r for r in (dq.DEFAULT_RULES if rules is None else rules) if r.enabled]
    columns = StructType.fromDDL(schema).fieldNames()
    minded = [r for r in rules if memory and r.rule_type in KINDS]
    plain = [r for r in rules if r not in minded]
    judges = {}
    for r in minded:
        folder = f"{memory}/{r.rule_id}"
        judges[r.rule_id] = SeenKeys(spark, folder, r, _earlier_rows(spark, schema)) if r.rule_type == KINDS[0] else LastSamples(spark, folder, r, columns)
    counts, done = [], []

    def batch(df: DataFrame, batch_id: int) -> None:
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        df = df.observe(seen, F.count(F.lit(1)).alias("n")).persist()
        try:
            rows = df.drop("_file")
            found = [dq.evaluate_rules(rows, plain), *[dq.failures(judges[r.rule_id].judge(df, batch_id), r) for r in minded]]
            failures = dq.observed(reduce(DataFrame.unionByName, found), batch_id).persist()
            number = F.lit(batch_id).cast("long").alias("dq_batch_id")
            _write(failures, f"{out}/{RESULT}")
            _write(dq.summarize(failures).select("*", number), f"{out}/{SUMMARY}")
            if mode == "write_clean_table":
                bad = dq.invalid_keys(failures, blocking_only)
                if minded:
                    stored.delete_rows(spark, f"{out}/{CLEAN}", bad, dq.KEYS)
                _write(dq.clean(rows, bad).select("*", number), f"{out}/{CLEAN}")
            failures.unpersist()
            counts.append(int(seen.get["n"]))
            done.append(batch_id)
        finally:
            df.unpersist()
            for judge in judges.values():
                judge.release()

    stream = source(spark, bronze, schema, batch_files).select(*[f"`{c}`" for c in columns], F.col("_metadata.file_path").alias("_file"))
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if done and mode in ("flag_rows", "delete_rows"):
        change_rows(spark, bronze, out, mode, blocking_only, min(done))
    return sum(counts)


def change_rows(spark: SparkSession, bronze: str, out: str, mode: str, blocking_only: bool = True, since: int = 0) -> dict[str, int]:
    """Flags or deletes, in the stored table, rows that have failed in the batches from ``since`` on. A second run changes nothing more."""
    failed = spark.read.parquet(f"{out}/{RESULT}").filter(F.col("dq_batch_id") >= since)
    change = stored.flag_rows if mode == "flag_rows" else stored.delete_rows
    return change(spark, bronze, dq.invalid_keys(failed, blocking_only), dq.KEYS)
