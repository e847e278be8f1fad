"""Exact top-k search by distributed histogram selection.

Every row is scored by every query in integers. Each round, the tasks count the scores of a query in equal buckets of
the interval where its k-th best score lies; the counts of all tasks are added up, and the bucket that holds the k-th
best is the next interval. Once it is a single score, or few rows reach it, the rows that reach it are taken and ranked,
ties by id. Scores are made again in each round rather than stored, as they are queries times rows; rows aren't shuffled.

A task counts no bucket below that of its own k-th best score, as the k-th best of all can't lie there, and takes no
more than its own k best rows: it sends a bounded number of counts and rows for a query, however many share a score.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.llm.common import Best

#: Buckets of a round; rows and queries that are scored at once; bytes of a lot of queries with their counts.
BUCKETS, BLOCK_ROWS, BLOCK_QUERIES, LOT_BYTES = 256, 2048, 512, 8 << 20
#: Rows that may be taken for each row asked for before the interval is a single score.
SPARE = 4
#: A query's rows from all tasks are ranked in so many parts first.
SALTS = 32


def integral(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(_id, _v, _dim, _size) of the rows that take part: ``_v`` is scaled and rounded down, ``_size`` its squared length."""
    plain = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_x")).filter(F.col("_id").isNotNull() & F.col("_x").isNotNull())
    finite = F.forall("_x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = plain.filter(finite).select("_id", F.transform("_x", lambda x: x * F.lit(float(scale))).alias("_x"))
    fits = F.aggregate("_x", F.lit(0.0), lambda a, x: a + (F.abs(x) + 1) * (F.abs(x) + 1)) < float(1 << 62)
    rows = scaled.filter(fits).select("_id", F.transform("_x", lambda x: F.floor(x)).alias("_v"), F.size("_x").alias("_dim"))
    return rows.withColumn("_size", F.aggregate("_v", F.lit(0).cast("long"), lambda a, x: a + x * x))


class Lot:
    """Queries of one length, and for each the interval of BUCKETS times ``width`` scores from ``least`` in which the k-th best lies."""

    def __init__(self, queries: list[tuple], dim: int, longest: int):
        """``queries``: (number, id, vector, squared length); ``longest`` is the largest squared length of a row."""
        self.numbers = np.array([q[0] for q in queries], np.int64)
        self.vectors = np.array([q[2] for q in queries], np.int64).reshape(len(queries), dim)
        self.own = defaultdict(list)
        for i, q in enumerate(queries):
            self.own[q[1]].append(i)
        #: No score is beyond the product of the lengths.
        bound = np.array([int((float(q[3]) * float(longest)) ** 0.5 * (1 + 1e-9)) + 1 for q in queries], np.int64)
        self.least, self.width = -bound, (2 * bound) // BUCKETS + 1
        self.open = np.ones(len(queries), bool)
        #: Sums are exact in double precision if none of their parts reaches 2**53.
        self.exact = int(bound.max(initial=0)) < 1 << 52

    def scores(self, ids: list, rows: np.ndarray, some: np.ndarray) -> np.ndarray:
        """(rows x ``some`` queries); below all others where a row is the query's own."""
        q = self.vectors[some]
        out = (rows.astype(np.float64) @ q.T.astype(np.float64)).astype(np.int64) if self.exact else rows @ q.T
        at = {int(i): j for j, i in enumerate(some)}
        for r, x in enumerate(ids):
            for i in self.own.get(x, ()):
                if i in at:
                    out[r, at[i]] = np.iinfo(np.int64).min
        return out

    def narrow(self, number: int, bucket: int, reached: int, top: int) -> None:
        """The k-th best is in ``bucket``, which ``reached`` rows reach."""
        i = int(np.searchsorted(self.numbers, number))
        self.least[i] += bucket * self.width[i]
        self.open[i] = reached > SPARE * top and self.width[i] > 1
        self.width[i] = -(-self.width[i] // BUCKETS)


def _blocks(batches: Iterator[pa.RecordBatch], lots: dict[int, Lot]) -> Iterator[tuple[Lot, pa.Array, list, np.ndarray]]:
    """Rows of one length at a time: (lot, ids, the same as a list, vectors)."""
    for b in batches:
        dims = np.asarray(b.column("_dim"))
        for dim in np.unique(dims).tolist():
            if dim in lots:
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), BLOCK_ROWS):
                    part = b.take(pa.array(at[lo : lo + BLOCK_ROWS]))
                    ids = part.column("_id")
                    yield lots[dim], ids, ids.to_pylist(), np.asarray(part.column("_v").flatten(), np.int64).reshape(len(part), dim)


def _parts(some: np.ndarray) -> Iterator[np.ndarray]:
    return (some[lo : lo + BLOCK_QUERIES] for lo in range(0, len(some), BLOCK_QUERIES))


def histograms(rows: DataFrame, held, top: int) -> DataFrame:
    """(_q, _bucket, _n): how many rows have a score in each bucket of an open query's interval; the last bucket has all above too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots = held.value
        counts = {dim: np.zeros((len(lot.numbers), BUCKETS + 1), np.int64) for dim, lot in lots.items()}
        for lot, _, ids, vectors in _blocks(batches, lots):
            for some in _parts(np.flatnonzero(lot.open)):
                over = lot.scores(ids, vectors, some)
                # a row's own query has the least score there is, from which no bound may be taken away
                row, q = np.nonzero(over >= lot.least[some])
                bucket = np.minimum((over[row, q] - lot.least[some][q]) // lot.width[some][q], BUCKETS)
                counts[vectors.shape[1]][some] += np.bincount(q * (BUCKETS + 1) + bucket, minlength=len(some) * (BUCKETS + 1)).reshape(len(some), -1)
        for dim, n in counts.items():
            from_top = np.cumsum(n[:, ::-1], axis=1)[:, ::-1]
            # the last bucket that the task's own k best reach, and all above it
            n[np.concatenate([from_top[:, 1:] >= top, np.zeros((len(n), 1), bool)], axis=1)] = 0
            q, bucket = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(lots[dim].numbers[q]), pa.array(bucket), pa.array(n[q, bucket])], ["_q", "_bucket", "_n"])

    return rows.mapInArrow(run, "_q bigint, _bucket bigint, _n bigint")


def _taken(rows: DataFrame, held, top: int) -> DataFrame:
    """(_q, _id, _score) of the rows that reach a query's interval; of each task the best ``top`` at most."""
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lots, best = held.value, {}
        for lot, ids, listed, vectors in _blocks(batches, lots):
            for k, some in enumerate(_parts(np.arange(len(lot.numbers)))):
                own = best.setdefault((vectors.shape[1], k), (lot.numbers[some], Best(top, lot.least[some])))[1]
                own.add(lot.scores(listed, vectors, some), ids)
        for numbers, own in best.values():
            for b in own.batches():
                yield pa.RecordBatch.from_arrays([pa.array(numbers[b.column("item").to_numpy()]), b.column("id"), b.column("score")], ["_q", "_id", "_score"])

    return rows.mapInArrow(run, f"_q bigint, _id {id_type}, _score bigint")


def _settle(rows: DataFrame, lots: dict[int, Lot], top: int):
    """Rounds of histograms until each query's interval is narrow enough; returns the lots' broadcast."""
    context = rows.sparkSession.sparkContext
    held = context.broadcast(lots)
    while any(lot.open.any() for lot in lots.values()):
        n = histograms(rows, held, top).groupBy("_q", "_bucket").agg(F.sum("_n").alias("_n"))
        down = W.partitionBy("_q").orderBy(F.desc("_bucket"))
        found = n.withColumn("_reached", F.sum("_n").over(down)).filter((F.col("_reached") >= top) & (F.col("_reached") - F.col("_n") < top)).collect()  # one row a query of the lot
        of = {int(q): lot for lot in lots.values() for q in lot.numbers}
        told = {r["_q"] for r in found}
        for lot in lots.values():
            lot.open &= np.isin(lot.numbers, list(told))  # of the others all rows are taken
        for r in found:
            of[r["_q"]].narrow(r["_q"], r["_bucket"], r["_reached"], top)
        held.unpersist()
        held = context.broadcast(lots)
    return held


def top_k(vectors: DataFrame, is_query: F.Column, top: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", lot_bytes: int = LOT_BYTES) -> DataFrame:
    """The ``top`` rows of each query row with the highest scores: query_id, rank (from 1), id_col, score.

    ``is_query`` is a condition on ``vectors``. A score is the inner product of the vectors' components times ``scale``,
    rounded down, as a 64-bit integer; ties go to the smaller id; rows of a query's own id are no candidates. Rows with a
    null id or vector and vectors that hold null or non-finite components take no part, nor do those with lengths beyond
    2**31 once scaled, as their products may leave 64 bits; vectors of other lengths than the query's aren't candidates.
    A repeated row is a candidate each time, but one query; an id with several vectors is one query, whose rankings are
    merged. An empty table gives none; other columns are ignored. Queries go in lots of bounded bytes, each of which is
    broadcast to all rows: the given query set against all rows, in blocks.
    """
    spark = vectors.sparkSession
    rows = integral(vectors, id_col, vector_col, scale)
    queries = integral(vectors.filter(is_query), id_col, vector_col, scale).distinct()
    longest = {r["_dim"]: r["_most"] for r in rows.groupBy("_dim").agg(F.max("_size").alias("_most")).collect()}
    size = queries.agg(F.sum(8 * (F.col("_dim") + BUCKETS + 4))).first()[0] or 0
    n_lots = max(1, -(-2 * size // lot_bytes))  # half of the bound on average, as a hash deals them
    lot = F.pmod(F.xxhash64("_id", "_v"), F.lit(n_lots))
    id_type = vectors.schema[id_col].dataType.simpleString()
    found = [spark.createDataFrame([], f"_query {id_type}, _id {id_type}, _score bigint")]
    for k in range(n_lots):
        asked = defaultdict(list)
        listed = queries.filter(lot == k).collect()
        for i, r in enumerate(listed):
            asked[r["_dim"]].append((i, r["_id"], r["_v"], r["_size"]))
        if listed:
            held = _settle(rows, {dim: Lot(own, dim, longest[dim]) for dim, own in asked.items()}, top)
            names = spark.createDataFrame([(i, r["_id"]) for i, r in enumerate(listed)], f"_q bigint, _query {id_type}")
            found.append(_taken(rows, held, top).join(F.broadcast(names), "_q").select("_query", "_id", "_score"))
    ranked, order = reduce(DataFrame.unionByName, found), [F.desc("_score"), F.col("_id")]
    salted = W.partitionBy("_query", F.pmod(F.xxhash64("_id"), F.lit(SALTS))).orderBy(*order)
    for w in (salted, W.partitionBy("_query").orderBy(*order)):
        ranked = ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.select(F.col("_query").alias("query_id"), "rank", F.col("_id").alias(id_col), F.col("_score").alias("score"))
