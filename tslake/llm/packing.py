"""Bounded-space online packing of token ids into sequences.

Each partition keeps a fixed number of open windows. A document's full windows leave at once; its rest goes into the
open window that it fits best. Where none fits and no slot is free, the fullest window is filled with the beginning of
the rest and leaves, and what remains is placed again. What stays open at the end of a partition is merged, partitions
in groups, and the last window of a group is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import checkpointed, slices
from tslake.llm.tokens import token_ids

WINDOW, OPEN_WINDOWS, END_ID = 1024, 16, 0
#: Partitions whose open windows are merged together: at most 64 * 16 * 1024 ids.
MERGED_PARTITIONS = 64
#: Sequence ids: number of the partition or group above, running number below; merged ones have one more bit set.
_ID_BITS, _MERGED = 32, 1 << 62

_TYPES = {"start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64()}
_DDL = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: bytes, total: int = -1):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids) >> 2

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[: 4 * n], self.total), Piece(self.doc, self.start + n, self.ids[4 * n :], self.total)


class Packer:
    """The open windows of one partition; ``closed`` gathers full windows, lists of pieces."""

    def __init__(self, window: int = WINDOW, most: int = OPEN_WINDOWS):
        self.window, self.most = window, most
        self.open: list[tuple[int, list[Piece]]] = []
        self.closed: list[list[Piece]] = []

    def put(self, piece: Piece) -> None:
        """Places a piece of less than a window, cut in two where it fits nowhere whole."""
        n = len(piece)
        fit = min((k for k, (used, _) in enumerate(self.open) if used + n <= self.window), key=lambda k: -self.open[k][0], default=None)
        if fit is not None:
            used, pieces = self.open[fit]
            pieces.append(piece)
            self.open[fit] = (used + n, pieces)
            if used + n == self.window:
                self.closed.append(self.open.pop(fit)[1])
            return
        if len(self.open) < self.most:
            self.open.append((n, [piece]))
            return
        k = max(range(len(self.open)), key=lambda k: self.open[k][0])
        used, pieces = self.open.pop(k)
        head, rest = piece.cut(self.window - used)
        self.closed.append([*pieces, head])
        self.put(rest)


def _rows(sequences: list[tuple[int, list[Piece]]], kept: bool) -> list[tuple]:
    out = []
    for sequence, pieces in sequences:
        at = 0
        for p in pieces:
            out.append((p.doc, p.start, len(p), zlib.crc32(p.ids), p.total, sequence, at, p.ids if kept else None))
            at += len(p)
    return out


def _pack_partition(batches: Iterator[pa.RecordBatch], path: str, window: int, most: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    packer, number = Packer(window, most), 0
    part = TaskContext.get().partitionId()
    end = END_ID.to_bytes(4, "little")

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 8
        types = [id_type, *_TYPES.values(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int64()), *[pa.array(c, t) for c, t in zip(columns, types)]], ["_part", "_id", *_TYPES, "_ids"])

    for batch in batches:
        at = 0
        for texts in slices(batch.column(1)):
            ids = batch.column(0).slice(at, len(texts)).to_pylist()
            at += len(texts)
            pending, start = b"", 0
            for i, more, last, n in token_ids(texts, path):
                pending += more + end if last else more
                while len(pending) >= 4 * window:
                    packer.closed.append([Piece(ids[i], start, pending[: 4 * window], n + 1)])
                    pending, start = pending[4 * window :], start + window
                if last:
                    if pending:
                        packer.put(Piece(ids[i], start, pending, n + 1))
                    pending, start = b"", 0
                if len(packer.closed) > 4096:
                    yield out(_rows(list(enumerate(packer.closed, (part << _ID_BITS) + number)), False))
                    number += len(packer.closed)
                    packer.closed = []
    yield out(_rows(list(enumerate(packer.closed, (part << _ID_BITS) + number)), False))
    yield out(_rows([(k, pieces) for k, (_, pieces) in enumerate(packer.open)], True))


def _merge(group: int, pieces: list[Piece], window: int) -> list[tuple]:
    """The pieces in full windows, one after another; the last is cut into powers of two."""
    sequences: list[list[Piece]] = []
    left = sum(map(len, pieces))
    room, current = 0, []
    for piece in pieces:
        while len(piece):
            if not room:
                room = window if left >= window else 1 << (left.bit_length() - 1)
                left -= room
                current = []
                sequences.append(current)
            head, piece = piece.cut(min(room, len(piece)))
            current.append(head)
            room -= len(head)
    return _rows(list(enumerate(sequences, _MERGED + (group << _ID_BITS))), False)


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids and then the id 0; null text counts as empty (that one id). A null id stays null,
    repeated rows are documents of their own, an empty table gives no rows, other columns are ignored. Memory of a
    task: the open windows, at most 4096 full ones, and a text with the ids of one of its parts; long texts are counted
    before they are packed, so that their windows leave at once. The partitions' full windows and leftovers are checkpointed once, so a lost executor repeats its own partition only.
    """
    kind = docs.schema[id_col].dataType
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    ddl = f"_part bigint, _id {kind.simpleString()}, {_DDL}, _ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        yield from _pack_partition(batches, tokenizer_path, window, open_windows, to_arrow_type(kind))

    packed = checkpointed(docs.mapInArrow(run, ddl))
    names = ["_id", *_TYPES]

    def merge(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("_part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        pieces = [Piece(r["_id"], r["start"], r["_ids"], r["doc_tokens"]) for r in t.select(["_id", "start", "_ids", "doc_tokens"]).to_pylist()]
        rows = _merge(key[0].as_py(), pieces, window)
        return pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows))[:7], [t.schema.field("_id").type, *_TYPES.values()])], names)

    groups = packed.filter("_ids is not null").withColumn("_group", F.expr(f"_part div {MERGED_PARTITIONS}"))
    merged = groups.groupBy("_group").applyInArrow(merge, f"_id {kind.simpleString()}, {_DDL}")
    return packed.filter("_ids is null").select(names).unionByName(merged).withColumnRenamed("_id", id_col)
