"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import checkpointed


#: Tasks that look up one label.
SALTS = 8


def _cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, and with it what Spark knows of its columns: else each round's planning takes twice as long."""
    return checkpointed(df.select(*[F.shiftright(c, 0).alias(c) for c in df.columns]))


def looked_up(df: DataFrame, key: str, table: DataFrame, value: str, how: str) -> DataFrame:
    """``df`` with the ``value`` that the last column of ``table`` (node, ...) has for its ``key``; a key's rows are dealt to ``SALTS`` tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    own = table.select(F.col("node").alias("_node"), F.col(table.columns[-1]).alias(value), salts.alias("_own"))
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(own, (F.col(key) == F.col("_node")) & (F.col("_salt") == F.col("_own")), how).select(*df.columns, value)


def _least(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name): the least ``value`` of each key, first in ``SALTS`` parts: each of many tasks sends a row for a hot key."""
    part = F.pmod(F.xxhash64(value), F.lit(SALTS)).alias("_part")
    return df.groupBy(key, part).agg(F.min(value).alias(name)).groupBy(key).agg(F.min(name).alias(name))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (src, dst: long); a component is named by its least node.

    In each round the least label among a node's neighbours is handed to the node and to the node that its label names;
    then labels jump to their label's label, until none changes. Rounds grow with the logarithm of a component's
    diameter. Each half round is checkpointed, and a label that many nodes share is looked up by several tasks. Rows grow with the edges only, and minima are combined before they are shuffled. Nulls
    and loops are allowed: a null end is dropped with its edge, a loop makes a component of one.
    """
    known = edges.filter("src is not null and dst is not null").select("src", "dst")
    both = _cut(known.unionByName(known.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = _cut(both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("label")).withColumnRenamed("src", "node"))
    while True:
        near = _least(looked_up(both, "dst", labels, "label", "inner"), "src", "label", "least")
        told = labels.join(near, labels.node == near.src).select("node", "label", "least")
        least = _least(told.select("node", "least").unionByName(told.select(F.col("label").alias("node"), "least")), "node", "least", "least")
        lower = _cut(labels.join(least, "node", "left").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label")))
        up = lower.filter("label < node").select("node", "label")
        new = _cut(looked_up(lower, "label", up, "top", "left").select("node", "old", F.least("label", "top").alias("label")))
        labels = new.select("node", "label")
        if new.filter("label < old").isEmpty():
            return labels.withColumnRenamed("label", "component")
