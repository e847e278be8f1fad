"""Nearest neighbours by inner product: anisotropic four-bit quantisation, table scans, exact reranking.

A vector is coded by one of 16 centres in each pair of dimensions. Codes and centres are chosen so that the part of
the error that is parallel to the vector weighs more than the rest, as it is what changes large inner products. A query
scans the codes of all rows through tables of its products with the centres; the best of each block of rows are then
scored exactly in double precision. A row's table score errs by no more than the query's length times that of the row's
residual, so all rows that this lets reach the last of the best are scored exactly as well, and none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bound of the training sample; every row is indexed.
SAMPLE_ROWS = 8192
CENTRES, DIMENSIONS = 16, 2
#: Share of a vector's length that an inner product has to reach to matter; sets the weight of parallel errors.
SCORE_SHARE = 0.2
#: Rows of a block, queries of a lot, rows of a block that are scored first; how many more are scored, their bounds tell.
BLOCK_ROWS, QUERY_ROWS, RERANKED = 4096, 2048, 96


class Quantiser:
    """Centres for vectors of one length."""

    def __init__(self, sample: np.ndarray, rounds: int = 3, seed: int = 5):
        self.length = sample.shape[1]
        self.parts = -(-self.length // (2 * DIMENSIONS)) * 2  # an even number, so that two codes make a byte
        t = SCORE_SHARE**2
        self.parallel = max(1.0, (self.length - 1) * t / (1 - t))
        rng = np.random.Generator(np.random.PCG64(seed))
        x = self.split(sample)
        pick = rng.permutation(len(x))[:CENTRES] if len(x) >= CENTRES else rng.integers(0, len(x), CENTRES)
        self.centres = x[pick].transpose(1, 0, 2).copy()  # parts x centres x dimensions
        for _ in range(8):
            self._mean(x, self._nearest(x))
        for _ in range(rounds):
            self._update(x, self.encode_split(x))

    def split(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.parts * DIMENSIONS))
        out[:, : self.length] = x
        return out.reshape(len(x), self.parts, DIMENSIONS)

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        return np.stack([((x[:, j, None, :] - self.centres[j][None]) ** 2).sum(-1).argmin(1) for j in range(self.parts)], axis=1)

    def _mean(self, x: np.ndarray, codes: np.ndarray) -> None:
        for j in range(self.parts):
            n = np.bincount(codes[:, j], minlength=CENTRES)
            for d in range(DIMENSIONS):
                total = np.bincount(codes[:, j], weights=x[:, j, d], minlength=CENTRES)
                self.centres[j, :, d] = np.where(n > 0, total / np.maximum(n, 1), self.centres[j, :, d])

    def encode_split(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes by coordinate descent on squared error plus the extra weight of its parallel part."""
        u = x / np.maximum(np.sqrt((x**2).sum(axis=(1, 2), keepdims=True)), 1e-300)
        codes, rows = self._nearest(x), np.arange(len(x))
        residual = x - self.centres[np.arange(self.parts), codes]
        along = (residual * u).sum(axis=(1, 2))
        for _ in range(sweeps):
            for j in range(self.parts):
                rest = along - (residual[:, j] * u[:, j]).sum(-1)
                r = x[:, j, None, :] - self.centres[j][None]
                p = rest[:, None] + (r * u[:, j, None, :]).sum(-1)
                codes[:, j] = ((r**2).sum(-1) + (self.parallel - 1) * p**2).argmin(1)
                residual[:, j] = r[rows, codes[:, j]]
                along = rest + (residual[:, j] * u[:, j]).sum(-1)
        return codes

    def _update(self, x: np.ndarray, codes: np.ndarray) -> None:
        """Centres that minimise the same loss for fixed codes, one part after another."""
        u = x / np.maximum(np.sqrt((x**2).sum(axis=(1, 2), keepdims=True)), 1e-300)
        residual = x - self.centres[np.arange(self.parts), codes]
        along = (residual * u).sum(axis=(1, 2))
        for j in range(self.parts):
            rest = along - (residual[:, j] * u[:, j]).sum(-1)
            for c in range(CENTRES):
                own = np.flatnonzero(codes[:, j] == c)
                if len(own):
                    v, y = u[own, j], x[own, j]
                    left = len(own) * np.eye(DIMENSIONS) + (self.parallel - 1) * v.T @ v
                    right = y.sum(axis=0) + (self.parallel - 1) * (v * (rest[own] + (y * v).sum(-1))[:, None]).sum(axis=0)
                    self.centres[j, c] = np.linalg.solve(left, right)
            residual[:, j] = x[:, j] - self.centres[j, codes[:, j]]
            along = rest + (residual[:, j] * u[:, j]).sum(-1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two codes a byte; how far a table score may lie from the exact one, for a query of length 1.

        That is the length of the residual, and a margin for sums in single precision.
        """
        x = self.split(x)
        codes = self.encode_split(x)
        centres = self.centres[np.arange(self.parts), codes]
        length = lambda v: np.sqrt((v**2).sum(axis=(1, 2)))
        reach = length(x - centres) + (self.parts + 4) * 2.0**-23 * (length(centres) + length(x))
        codes = codes.astype(np.uint8)
        return codes[:, ::2] * np.uint8(16) + codes[:, 1::2], reach

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(queries x bytes x 256) inner products with each pair of centres."""
        single = np.einsum("qjd,jcd->qjc", self.split(queries), self.centres).astype(np.float32)
        return (single[:, ::2, :, None] + single[:, 1::2, None, :]).reshape(len(queries), self.parts // 2, 256)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _v, _dim) of the rows that take part: known id; a vector with known, finite components, not all zero."""
    v = F.col("_v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    plain = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    return plain.filter(F.col("_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)).withColumn("_dim", F.size("_v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dim)


def train(vectors: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict[int, Quantiser]:
    """A quantiser for each length of vectors, each from at most about ``sample_rows`` rows drawn by a hash of the id."""
    counts = vectors.groupBy("_dim").count().collect()
    out = {}
    for row in counts:
        share = min(1.0, sample_rows / row["count"])
        draw = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 30)) < max(1, int(share * (1 << 30)))
        rows = vectors.filter((F.col("_dim") == row["_dim"]) & draw).orderBy("_id").limit(sample_rows + 1024).select("_v").collect()
        out[row["_dim"]] = Quantiser(np.array([r[0] for r in rows] or [[1.0] * row["_dim"]]))
    return out


def _search(ids: np.ndarray, x: np.ndarray, codes: np.ndarray, reach: np.ndarray, query_ids: np.ndarray, q: np.ndarray, tables: Iterator[np.ndarray], top: int, reranked: int):
    """(id, score) of the best ``top`` of a block for each query.

    The best ``reranked`` by table are scored exactly; then all rows whose bound isn't below the last of their best ``top``.
    """
    at = [codes[:, j].astype(np.intp) for j in range(codes.shape[1])]
    longest = np.sqrt((x**2).sum(axis=1).max())
    for k, t in enumerate(tables):
        some = np.arange(len(ids))
        if len(ids) > reranked:
            approximate = t[0][at[0]]
            for j in range(1, len(at)):
                approximate += t[j][at[j]]
            first = np.argpartition(approximate, len(ids) - reranked)[-reranked:]
            first = first[ids[first] != query_ids[k]]
            if len(first) >= top:
                worst = np.partition(x[first] @ q[k], len(first) - top)[-top]
                bound = approximate + np.sqrt(q[k] @ q[k]) * reach + 2 * len(at) * np.finfo(np.float32).tiny
                some = np.flatnonzero(~(bound < worst) | ~np.isfinite(approximate))  # what overflows is scored
        score = x[some] @ q[k] if 4 * len(some) < len(ids) else (x @ q[k])[some]
        other = ids[some] != query_ids[k]
        some, score = some[other], score[other]
        if len(some) > top:  # products of matrices may round equal rows apart, so those at the edge are summed again alike
            edge = np.partition(score, len(some) - top)[-top] - 2.0**-40 * longest * np.sqrt(q[k] @ q[k])
            some = some[~(score < edge)]
        score = (x[some] * q[k]).sum(axis=1)
        best = np.lexsort((ids[some], -score))[:top]
        yield ids[some[best]], score[best]


def nearest(vectors: DataFrame, is_query: F.Column, top: int = 20, reranked: int = RERANKED, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``top`` nearest rows of each query row: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on ``vectors``. Nearest is the largest inner product in double precision, ties to the
    smaller id; a row of the query's own id is no candidate. Rows with a null id or vector, and vectors that are zero or
    hold null or non-finite components take no part; vectors of other lengths than the query's aren't candidates.
    Repeated rows are one; an id with several vectors is several candidates, and one query whose rankings by each of its
    vectors are merged, so that ids may be listed again; an empty table gives none; other columns are ignored. Of equal vectors only the ``top`` + 1 smallest ids are scanned:
    no other can be among the nearest. Queries and rows meet in blocks of bounded size. The result is that of scoring
    all pairs, whatever ``reranked``, the number of rows of a block that are scored first.
    """
    all_ = usable(vectors, id_col, vector_col)
    queries = usable(vectors.filter(is_query), id_col, vector_col).distinct()
    order = W.partitionBy("_dim", "_v").orderBy("_id")
    rows = all_.distinct().withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top + 1).drop("_rank")
    n_rows, n_queries = all_.count(), queries.count()
    held = vectors.sparkSession.sparkContext.broadcast(train(all_))
    blocks, lots = max(1, -(-n_rows // BLOCK_ROWS)), max(1, -(-n_queries // QUERY_ROWS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes: list[bytes] = [b""] * len(b)
            reach = np.zeros(len(b))
            dims = np.asarray(b.column("_dim"))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                found, reach[own] = held.value[dim].encode(matrix(b.column("_v").take(pa.array(own)), dim))
                for i, c in zip(own.tolist(), found):
                    codes[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_v"), b.column("_dim"), pa.array(codes, pa.binary()), pa.array(reach)], ["_id", "_v", "_dim", "_codes", "_reach"])

    coded = rows.mapInArrow(encode, "_id bigint, _v array<double>, _dim int, _codes binary, _reach double")
    dealt = coded.withColumns({"_block": F.pmod(F.xxhash64("_id"), F.lit(blocks)), "_lot": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long")))})
    asked = queries.withColumns({"_lot": F.pmod(F.xxhash64("_id"), F.lit(lots)), "_block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))})

    def scan(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(left) and len(right):
            dim = key[0].as_py()
            quantiser = held.value[dim]
            ids, x = np.asarray(left.column("_id")), matrix(left.column("_v"), dim)
            codes = np.frombuffer(b"".join(left.column("_codes").to_pylist()), np.uint8).reshape(len(ids), -1)
            reach = np.asarray(left.column("_reach"))
            query_ids, q = np.asarray(right.column("_id")), matrix(right.column("_v"), dim)
            tables = (t for lo in range(0, len(q), 64) for t in quantiser.tables(q[lo : lo + 64]))
            out = list(zip(query_ids.tolist(), *zip(*_search(ids, x, codes, reach, query_ids, q, tables, top, reranked))))
        n = [len(o[1]) for o in out]
        cat = lambda k, kind: np.concatenate([np.zeros(0, kind), *[o[k] for o in out]])
        return pa.table([pa.array(np.repeat(np.array([o[0] for o in out], np.int64), n)), pa.array(cat(1, np.int64)), pa.array(cat(2, np.float64))], ["query_id", "vec_id", "score"])

    found = dealt.groupBy("_dim", "_block", "_lot").cogroup(asked.groupBy("_dim", "_block", "_lot")).applyInArrow(scan, "query_id bigint, vec_id bigint, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
