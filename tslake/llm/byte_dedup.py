"""Suffix-array dedup: bytes covered by a string of 200 that also starts anywhere else are removed.

Equal strings must meet in one shard. A string's mark is its least-hashed gram of 48 bytes (the left-most such), which
equal strings have at the same place; consecutive beginnings with one mark form a slice of the text. Marks are counted
over all documents; slices whose mark occurs more than once go, by mark, to shards. A shard folds equal slices into
one with a note that it was seen again, sorts all suffixes of the rest by external induced sorting, which carries the
neighbours' common prefixes along, and finds in these the beginnings whose 200 bytes occur twice. The answers, a bit for each beginning, go back
to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tslake.llm.blocks import Blocks, answered, answers, bounds, distinct, message
from tslake.llm.common import slices, utf8
from tslake.llm.suffix import MEMORY, Disk, suffix_array
from tslake.llm.words import _BYTE, U, cover, mix, powers, sha

LENGTH, GRAM = 200, 48
#: Bytes of text whose marks are found at once; what a shard sorts at once, unless one mark has more.
PIECE, SORTED = 1 << 18, 4 << 20
#: Slices whose answers are read at once.
SLICES_AT_ONCE = 1 << 13
#: Low bits that hold a place within a piece while marks are chosen.
_PLACE = 20

SLICES = "_bucket bigint, _block bigint, _data binary, _sizes binary, _marks binary, _many binary"


def rolling(x: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all strings of ``n`` bytes."""
    if len(x) < n:
        return np.zeros(0, np.uint64)
    p, inverse = powers(0, len(x) + 1)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(_BYTE[x] * p[: len(x)], out=sums[1:])
    h = sums[n:] - sums[:-n]
    h *= inverse[: len(h)]
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    return h


def marks(x: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the mark of every string of ``length`` bytes: its least gram by the hash's leading bits, the left-most of equals."""
    h, w = rolling(x, gram), length - gram + 1
    if len(h) < w:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    assert len(h) <= 1 << _PLACE, "places would run into the hash"
    key = (h >> U(_PLACE) << U(_PLACE)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < w:
        step = min(size, w - size)
        key = np.minimum(key[:-step], key[step:])
        size += step
    place = (key & U((1 << _PLACE) - 1)).astype(np.int64)
    return h[place], place


def pieces(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets of the texts in them, number of the first text, begin in it): runs of whole texts, or parts of a long text that overlap by ``length`` - 1.

    A text of more than ``PIECE`` bytes is by itself, whatever texts come before it.
    """
    at = 0
    for part in slices(texts, PIECE):
        data, off, _ = utf8(part)
        edges = np.unique([0, len(part), *[k for i in np.flatnonzero(np.diff(off) > PIECE).tolist() for k in (i, i + 1)]]).tolist()
        for first, end in zip(edges, edges[1:]):
            x, own = data[off[first] : off[end]], off[first : end + 1] - off[first]
            if len(x) <= 2 * PIECE:
                yield x, own, at + first, 0
            else:
                for lo in range(0, len(x) - length + 1, PIECE):
                    piece = x[lo : lo + PIECE + length - 1]
                    yield piece, np.array([0, len(piece)]), at + first, lo
        at += len(part)


def runs_of_marks(x: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mark, first beginning, number) of the runs of consecutive strings with one mark; strings don't cross texts."""
    h, place = marks(x, length, gram)
    if not len(h):
        return h, place, place
    ok = np.zeros(len(h) + 1, bool)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        ok[a : max(a, b - length + 1)] = True
    change = np.append(np.concatenate([[True], place[1:] != place[:-1]]), True)
    change[1:] |= ok[1:] != ok[:-1]
    at = np.flatnonzero(change)
    begin, count = at[:-1], np.diff(at)
    keep = ok[begin]
    return mix(h[begin[keep]]), begin[keep], count[keep]  # least hashes are small; mixed, they fill all buckets alike


def mark_hashes(texts: pa.Array, length: int, gram: int) -> np.ndarray:
    """The hash of each mark, twice if a piece has it at more than one place."""
    out = [np.zeros(0, np.uint64)]
    for x, off, _, _ in pieces(texts, length):
        h, many = distinct(runs_of_marks(x, off, length, gram)[0])
        out += [h[:, 0], h[many, 0]]
    return np.concatenate(out)


def block_slices(texts: pa.Array, length: int, gram: int, repeated: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple[int, bytes]]]]:
    """For each piece the slices whose mark is repeated: documents, first beginnings, numbers of beginnings, and (mark, bytes) of each."""
    if not len(repeated):
        return
    for x, off, first, shift in pieces(texts, length):
        h, begin, count = runs_of_marks(x, off, length, gram)
        hit = np.flatnonzero(repeated[np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)] == h)
        if len(hit):
            begin, count, raw = begin[hit], count[hit], x.tobytes()
            doc = np.searchsorted(off, begin, side="right") - 1
            yield first + doc, shift + begin - off[doc], count, zip(h[hit].tolist(), (raw[a : a + n + length - 1] for a, n in zip(begin.tolist(), count.tolist())))


def folded(texts: pa.Array, length: int, gram: int, repeated: np.ndarray) -> tuple[list[tuple[int, bytes]], np.ndarray, np.ndarray]:
    """Distinct slices in order of mark and bytes, whether each was seen again, and four rows of its number, document, first beginning and number of beginnings for each that was seen.

    Slices are folded while they are found: in a text of a short period nearly every beginning is a slice of its own.
    """
    number: dict[tuple[int, bytes], int] = {}
    seen = [np.zeros((4, 0), np.int32)]
    for doc, begin, count, own in block_slices(texts, length, gram, repeated):
        k = np.fromiter((number.setdefault(s, len(number)) for s in own), np.int32, len(doc))
        seen.append(np.stack([k, doc, begin, count]).astype(np.int32))  # a text has less than 2^31 bytes
    seen = np.concatenate(seen, axis=1)
    ordered = sorted(number)
    rank = np.zeros(len(ordered), np.int32)
    rank[[number[s] for s in ordered]] = np.arange(len(ordered))
    seen[0] = rank[seen[0]]
    return ordered, np.bincount(seen[0], minlength=len(ordered)) > 1, seen


def repeated_beginnings(raws: list[bytes], many: np.ndarray, length: int, memory: int = MEMORY, disk: Disk | None = None) -> list[np.ndarray]:
    """For each distinct slice, which of its beginnings have ``length`` bytes that begin elsewhere too.

    All suffixes of the slices, each closed by a separator, are sorted with their common prefixes; where neighbours
    share ``length`` bytes before a separator, both are repeated.
    """
    disk = disk or Disk(memory)
    sizes = np.array([len(r) for r in raws], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    n = int((sizes + 1).sum()) + 1
    text, out, far = disk.array(n, np.uint16), disk.array(n, bool), disk.array(n, bool)  # far: from a separator
    for raw, b in zip(raws, begin.tolist()):
        text[b : b + len(raw)] = np.frombuffer(raw, np.uint8)
        text[b : b + len(raw)] += 2
        text[b + len(raw)] = 1
        far[b : b + len(raw) - length + 1] = True
    order, common = suffix_array(text, length, disk)
    for lo, hi in disk.blocks(n):
        same = (common[lo:hi] >= length) & far[order[lo:hi]]
        at = np.flatnonzero(same) + lo
        out[order[at]] = out[order[at - 1]] = True
    return [np.ones(len(raw) - length + 1, bool) if again else np.array(out[b : b + len(raw) - length + 1]) for raw, b, again in zip(raws, begin.tolist(), many.tolist())]


def sort_shard(key: tuple, t: pa.Table, length: int, memory: int) -> pa.Table:
    """Answers of one shard: for each block that sent slices, a bit for each of their beginnings.

    Slices of different marks have no string in common, and neither have strings of one slice, as their mark lies
    elsewhere in each: a slice alone under its mark is settled, the rest of a shard is sorted in batches of whole marks.
    """
    number: dict[tuple[int, bytes], int] = {}
    many: list[bool] = []
    sent = []
    for data, sizes, own, hashes in zip(*(t.column(c).to_pylist() for c in ("_data", "_sizes", "_many", "_marks"))):
        ends = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
        again = np.unpackbits(np.frombuffer(own, np.uint8), count=len(ends)).tolist()
        ids = []
        for lo, hi, more, m in zip([0, *ends], ends, again, np.frombuffer(hashes, np.uint64).tolist()):
            k = number.setdefault((m, data[lo:hi]), len(number))
            if k == len(many):
                many.append(bool(more))
            else:
                many[k] = True
            ids.append(k)
        sent.append(ids)
    found: list = [None] * len(number)
    batch: list[tuple[tuple[int, bytes], int]] = []
    size = 0

    def flush() -> None:
        own = [k for _, k in batch]
        for k, bits in zip(own, repeated_beginnings([raw for (_, raw), _ in batch], np.array([many[k] for k in own]), length, memory)):
            found[k] = bits

    for m, own in groupby(sorted(number.items(), key=lambda x: x[0][0]), key=lambda x: x[0][0]):
        own = list(own)
        if len(own) == 1:  # alone under its mark: its strings are repeated if it was seen again, and by nothing else
            (_, raw), k = own[0]
            found[k] = np.full(len(raw) - length + 1, many[k])
            continue
        if size > SORTED:
            flush()
            batch, size = [], 0
        batch += own
        size += sum(len(raw) for (_, raw), _ in own)
    if batch:
        flush()
    bits, n = [], []
    for ids in sent:
        own = np.concatenate([found[k] for k in ids])
        bits.append(np.packbits(own).tobytes())
        n.append(len(own))
    rows = len(sent)
    return pa.table(
        [t.column("_block"), pa.array([2] * rows, pa.int32()), pa.array([key[0].as_py()] * rows, pa.int64()), pa.array(n, pa.int64()), pa.array(bits, pa.binary())],
        ["_block", "_stage", "_bucket", "_n", "_bits"],
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, memory: int = MEMORY, **sizes) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, and kept_bytes unless ``texts`` is off.

    Matches don't cross documents; strings are judged on the input; overlaps count. Null counts as an empty text (all
    0, hash of nothing). Repeated rows are documents of their own and so repeat each other; a null id stays null; an
    empty table gives none; other columns are ignored. ``memory`` bounds the tuples that a shard's queues hold; the
    rest waits in a temporary file of the task, which goes with it.
    """
    from tslake.llm.blocks import ANSWER

    with_texts = texts
    blocks = Blocks(docs, id_col, text_col, **sizes)
    n = blocks.buckets
    first = answers(blocks.send(lambda block, own: message(block, n, *distinct(mark_hashes(own, length, gram)))), 1, 1)

    def found(own: pa.Array, answer: pa.Table) -> tuple[list[tuple[int, bytes]], np.ndarray, np.ndarray]:
        known, _ = distinct(mark_hashes(own, length, gram))
        return folded(own, length, gram, known[answered(answer, 1), 0])

    def send(block: int, ids: pa.Array, own: pa.Array, answer: pa.Table) -> pa.Table:
        ordered, many, _ = found(own, answer)
        out = []
        for bucket, lo, hi in bounds(np.array([m for m, _ in ordered], np.uint64), n):
            raws = [r for _, r in ordered[lo:hi]]
            out.append((bucket, block, b"".join(raws), np.array([len(r) for r in raws], np.int32).tobytes(), np.array([m for m, _ in ordered[lo:hi]], np.uint64).tobytes(), np.packbits(many[lo:hi]).tobytes()))
        columns = list(zip(*out)) or [()] * 6
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(columns, types)], ["_bucket", "_block", "_data", "_sizes", "_marks", "_many"])

    def sort(key: tuple, t: pa.Table) -> pa.Table:
        return sort_shard(key, t, length, memory)

    second = blocks.read(first, send, SLICES).groupBy("_bucket").applyInArrow(sort, ANSWER)

    def result(block: int, ids: pa.Array, own: pa.Array, answer: pa.Table) -> pa.Table:
        ordered, _, seen = found(own, answer)
        bits = answered(answer, 2)
        at = np.cumsum([0, *[len(r) - length + 1 for _, r in ordered]])
        edges = np.searchsorted(seen[1], np.arange(len(own) + 1)).tolist()
        rows, doc = [], 0
        for part in slices(own):
            data, off, _ = utf8(part)
            for i in range(len(part)):
                x = data[off[i] : off[i + 1]]
                gone = np.zeros(len(x), bool)
                for lo in range(edges[doc], edges[doc + 1], SLICES_AT_ONCE):
                    k, _, a, count = seen[:, lo : min(lo + SLICES_AT_ONCE, edges[doc + 1])].astype(np.int64)
                    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    gone[np.repeat(a, count) + within] = bits[np.repeat(at[k], count) + within]
                if gone.any():
                    gone = cover(np.flatnonzero(gone), length, len(x))
                kept = x[~gone].tobytes()
                rows.append((len(x), int(gone.sum()), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)), sha(kept), kept if with_texts else None))
                doc += 1
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table([ids, *[pa.array(c, k) for c, k in zip(columns, types)]], ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])

    ddl = f"_id {blocks.id_type.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary"
    out = blocks.unfolded(blocks.read(first.unionByName(second), result, ddl), id_col)
    return out if with_texts else out.drop("kept_bytes")
