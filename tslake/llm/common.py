"""Helpers that several text operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task works on at once; larger batches are cut into runs of rows.
SLICE_BYTES = 1 << 18


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives this package to the workers, once for each application, through Spark's own file server."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parent.parent
        path = f"{tempfile.mkdtemp(prefix='spark-')}/{package.name}.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset, a temporary folder, which only a local master may use."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return named or tempfile.mkdtemp(prefix="spark-")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` stored in the session's shared folder, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that begins with ``stem`` and that no column of ``df`` begins with, whatever its case."""
    taken, name = [c.lower() for c in df.columns], f"_{stem}"
    while any(c.startswith(name) for c in taken):
        name += "_"
    return name


def text_bytes(df: DataFrame, text_col: str) -> int:
    """UTF-8 bytes of the whole text column (0 for an empty table)."""
    return int(df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets with one more than rows, is-null) of an Arrow string column, without copying where possible."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    null = np.asarray(column.is_null())
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    if null.any():  # a null may span bytes
        column = pa.array(column.to_pylist(), pa.large_string()).fill_null("")
        return utf8(column)[:2] + (null,)
    return data, off, null


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of consecutive rows with about ``most`` text bytes each; a longer text stays whole, alone."""
    for lo, hi in cuts(np.asarray(column.fill_null("").cast(pa.large_string()).value_lengths() if hasattr(column, "value_lengths") else _lengths(column)), most):
        yield column.slice(lo, hi - lo)


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.binary_length(column).fill_null(0))


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``most``."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


class Best:
    """The ``top`` best rows of each of some items, by score and then by id, of all that a task has seen."""

    #: Rows that are gathered before the best alone are kept.
    GATHERED = 200_000

    def __init__(self, top: int, least: np.ndarray):
        """``least``: the score that a row has to reach, for each item."""
        self.top, self.least = top, least.copy()
        self.parts: list[pa.Table] = []
        self.rows, self.most = 0, max(self.GATHERED, 4 * top * len(least))

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        """``scores`` (rows x items). What is below the last of an item's best is left out."""
        row, item = np.nonzero(scores >= self.least)
        if len(row):
            self.parts.append(pa.table([pa.array(item), pa.array(scores[row, item]), ids.take(pa.array(row))], ["item", "score", "id"]))
            self.rows += len(row)
            if self.rows > self.most:
                self.keep()

    def keep(self) -> None:
        t = pa.concat_tables(self.parts).sort_by([("item", "ascending"), ("score", "descending"), ("id", "ascending")])
        item = t.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = np.flatnonzero(rank == self.top - 1)
        self.least[item[last]] = t.column("score").to_numpy()[last]
        self.parts = [t.take(pa.array(np.flatnonzero(rank < self.top))).combine_chunks()]
        self.rows = len(self.parts[0])

    def batches(self) -> list[pa.RecordBatch]:
        """(item, score, id) of the best."""
        if not self.parts:
            return []
        self.keep()
        return self.parts[0].to_batches()
