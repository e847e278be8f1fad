"""Counting hashes over all documents, and telling each block of documents which of its own occur more than once.

Documents are dealt into blocks of a few megabytes by a hash of id and text. Rows that repeat both are folded to two,
with a number of copies, by each task that reads them, so that a row which a large share of the table repeats doesn't
meet in one block; the results are multiplied again at the end. A block sends its distinct hashes, sorted
and cut into buckets by their leading bits, as one binary value for each bucket; a bucket answers each block with one
bit for each hash that it sent. A frequent hash arrives once from a block however often it occurs there, and answers
are small. The block makes the same sorted list again to read the answer, so nothing is kept between the passes.
All passes read the same exchange of documents, which Spark shuffles once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import text_bytes

#: Text bytes of a block, and of the documents whose hashes meet in one bucket.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20

MESSAGE = "_bucket bigint, _block bigint, _data binary, _many binary"
ANSWER = "_block bigint, _stage int, _bucket bigint, _n bigint, _bits binary"


def folded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _text, _same, _copies) of (_id, _text, _same): of a batch's equal rows two stay, one for itself and one for the rest.

    ``_same`` is a hash of the row; rows of one hash are compared. Two rows stay, as a text that is there twice repeats itself.
    """
    for batch in batches:
        _, first, which = np.unique(batch.column(2).to_numpy(), return_index=True, return_inverse=True)
        copies = np.ones(len(batch), np.int32)
        if len(first) < len(batch):
            again = np.flatnonzero(np.arange(len(batch)) != first[which])
            leads = first[which[again]]
            same = pc.equal(batch.column(1).take(pa.array(again)), batch.column(1).take(pa.array(leads))).to_numpy(zero_copy_only=False)
            same &= [a == b for a, b in zip(batch.column(0).take(pa.array(again)).to_pylist(), batch.column(0).take(pa.array(leads)).to_pylist())]
            again, leads = again[same], leads[same]
            _, at, n = np.unique(leads, return_index=True, return_counts=True)
            copies[again] = 0
            copies[again[at]] = n
            batch, copies = batch.filter(pa.array(copies > 0)), copies[copies > 0]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(copies)], ["_id", "_text", "_same", "_copies"])


class Blocks:
    """``docs`` as (_id, _text, _block), with the numbers of blocks and buckets that suit its measured size.

    ``_id`` holds the id and a number of copies; ``unfolded`` gives rows of results for all of them.
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES):
        plain = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        size = text_bytes(plain, "_text")
        least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.blocks, self.buckets = max(least, -(-size // block_bytes)), max(least, -(-size // bucket_bytes))
        kind = docs.schema[id_col].dataType.simpleString()
        rows = plain.withColumn("_same", F.xxhash64("_text", "_id")).mapInArrow(folded_rows, f"_id {kind}, _text string, _same bigint, _copies int")
        self.docs = rows.select(F.struct(F.col("_id").alias("id"), F.col("_copies").alias("n")).alias("_id"), "_text", F.pmod("_same", F.lit(self.blocks)).alias("_block"))
        self.id_type = self.docs.schema["_id"].dataType

    def unfolded(self, out: DataFrame, id_col: str) -> DataFrame:
        """``out`` with a row for each copy, its id by its own name again."""
        rest = [c for c in out.columns if c != "_id"]
        return out.select(F.col("_id")["id"].alias(id_col), *rest, F.explode(F.sequence(F.lit(1), F.col("_id")["n"])).alias("_copy")).drop("_copy")

    def send(self, make: Callable[[pa.Array], Iterator[pa.RecordBatch]], schema: str = MESSAGE) -> DataFrame:
        """``make`` gets a block's number and texts, and returns its messages."""

        def run(key: tuple, t: pa.Table) -> pa.Table:
            return make(key[0].as_py(), t.column("_text").combine_chunks())

        return self.docs.groupBy("_block").applyInArrow(run, schema)

    def read(self, answers: DataFrame, make: Callable, schema: str) -> DataFrame:
        """``make`` gets a block's number, ids, texts and answers; a block may have no answer."""

        def run(key: tuple, t: pa.Table, answer: pa.Table) -> pa.Table:
            if not len(t):
                return make(key[0].as_py(), t.column("_id"), pa.array([], pa.string()), answer)
            return make(key[0].as_py(), t.column("_id"), t.column("_text").combine_chunks(), answer)

        return self.docs.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(run, schema)


def bounds(ordered: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes; buckets follow the hashes' order."""
    if len(ordered):
        b = ((ordered >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        at = np.flatnonzero(np.diff(b, prepend=b[0] + np.uint64(1)))
        for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(b)]):
            yield int(b[lo]), lo, hi


def distinct(*lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes (rows of one or two lanes) and whether each occurs more than once."""
    if not len(lanes[0]):
        return np.zeros((0, len(lanes)), np.uint64), np.zeros(0, bool)
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    rows = np.stack([x[order] for x in lanes], axis=1)
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
    at = np.flatnonzero(new)
    return rows[at], np.diff(np.append(at, len(rows))) > 1


def message(block: int, buckets: int, rows: np.ndarray, many: np.ndarray) -> pa.Table:
    out = [(bucket, block, rows[lo:hi].tobytes(), np.packbits(many[lo:hi]).tobytes()) for bucket, lo, hi in bounds(rows[:, 0], buckets)]
    columns = list(zip(*out)) or [()] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.binary(), pa.binary()])], ["_bucket", "_block", "_data", "_many"])


def answers(messages: DataFrame, stage: int, lanes: int) -> DataFrame:
    """For each message one row of bits: whether its hashes occur more than once in all."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64).reshape(-1, lanes) for x in t.column("_data").to_pylist()]
        sizes = [len(x) for x in own]
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(t.column("_many").to_pylist(), sizes)])
        rows = np.concatenate(own)
        order = np.argsort(rows[:, 0], kind="stable") if lanes == 1 else np.lexsort((rows[:, 1], rows[:, 0]))
        rows = rows[order]
        same = (rows[1:] == rows[:-1]).all(axis=1)
        repeated = np.zeros(len(rows), bool)
        repeated[1:] |= same
        repeated[:-1] |= same
        many[order] |= repeated
        at = np.cumsum([0, *sizes])
        bits = [np.packbits(many[a:b]).tobytes() for a, b in zip(at, at[1:])]
        n = len(sizes)
        return pa.table(
            [t.column("_block"), pa.array([stage] * n, pa.int32()), pa.array([key[0].as_py()] * n, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())],
            ["_block", "_stage", "_bucket", "_n", "_bits"],
        )

    return messages.groupBy("_bucket").applyInArrow(run, ANSWER)


def answered(answer: pa.Table, stage: int) -> np.ndarray:
    """One boolean for each hash that the block sent in a stage, in the hashes' order."""
    rows = sorted((b, n, bits) for s, b, n, bits in zip(*(answer.column(c).to_pylist() for c in ("_stage", "_bucket", "_n", "_bits"))) if s == stage)
    return np.concatenate([np.zeros(0, bool), *[np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) for _, n, bits in rows]])
