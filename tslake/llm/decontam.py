"""Benchmark decontamination by winnowing.

The fingerprint of a window of 13 words is the least hash of its 9 five-word grams, so a shared window always shares a
fingerprint. The test set's windows are a table (length, two hashes, fingerprint, item). Where its measured size allows,
it is broadcast; else documents' windows whose fingerprint passes a bitmap of fixed size are joined with it. Each hit is
extended to the windows around it, and a window counts only if the hash of all its words (128 bits) is a test window's.
Items of fewer than 13 words are one window of their own length, whose fingerprint is its own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.llm.common import checkpointed, fresh, slices, utf8
from tslake.llm.words import ALPHANUMERIC, LOWER, cover, inside, runs, sha, words

#: Rows and bytes of item names of the windows' table up to which it is broadcast (some 40 bytes a row besides the name).
BROADCAST_ROWS, BROADCAST_NAMES = 500_000, 16 << 20
WINDOW, GRAM = 13, 5
#: Bits of the bitmap of fingerprints: 2 ** 27 are 16 MiB, whatever the test set's size.
SIEVE_BITS = 27

_WINDOW = "n int, a bigint, b bigint, mark bigint"


def sliding(x: np.ndarray, n: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every ``n`` consecutive values."""
    f, size, out = np.minimum if least else np.maximum, 1, x
    while size < n:
        step = min(size, n - size)
        out = f(out[:-step], out[step:])
        size += step
    return out


def fingerprints(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The least gram hash of every run of ``window`` words."""
    return sliding(runs(hashes, gram), window - gram + 1, True)


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(n, a, b, mark, item): the distinct windows of the test set and the items that hold them; items as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                names = batch.column(0).slice(at, len(part))
                at += len(part)
                data, off, _ = utf8(part)
                *_, counts, h = words(data, off, ALPHANUMERIC, LOWER)
                first = np.cumsum(counts) - counts
                for n in np.unique(np.minimum(counts[counts > 0], window)).tolist():
                    a, b = runs(h[0], n, 0), runs(h[1], n, 1)
                    place = np.flatnonzero(inside(counts, n)) if n == window else first[counts == n]
                    mark = fingerprints(h[0], window, gram) if n == window else a
                    owner = np.searchsorted(np.cumsum(counts), place, side="right")
                    own = [pa.array(x[place].view(np.int64)) for x in (a, b, mark)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), n, np.int32)), *own, names.take(pa.array(owner))], ["n", "a", "b", "mark", "item"])

    known = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string"), F.col(text_col))
    return known.mapInArrow(run, f"{_WINDOW}, item string").distinct()


class Fingerprints:
    """The windows' table in memory: by length, sorted hashes and the items of each; and the sorted fingerprints of full windows."""

    def __init__(self, table: pa.Table, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, gram
        n, a, b, mark = (np.asarray(table.column(c)) for c in ("n", "a", "b", "mark"))
        a, b, mark = a.view(np.uint64), b.view(np.uint64), mark.view(np.uint64)
        self.items = table.column("item").to_pylist()
        self.marks = np.unique(mark[n == window])
        self.lengths: dict[int, tuple[np.ndarray, ...]] = {}
        for k in np.unique(n).tolist():
            own = np.flatnonzero(n == k)
            own = own[np.lexsort((b[own], a[own]))]
            self.lengths[k] = (a[own], b[own], own)

    def candidates(self, hashes: np.ndarray, ok: np.ndarray) -> np.ndarray:
        """Places where a window of full length may be a test window: those whose fingerprint the test set has."""
        if not ok.any() or not len(self.marks):
            return np.zeros(0, np.int64)
        return np.flatnonzero(_isin(fingerprints(hashes, self.window, self.gram), self.marks) & ok)

    def windows(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length the places of test windows, and rows of the table for each (a place may come with several)."""
        for n, (first, second, row) in self.lengths.items():
            ok = inside(counts, n)
            if not len(ok):
                continue
            at = self.candidates(hashes[0], ok) if n == self.window else np.flatnonzero(ok)
            a = runs(hashes[0], n, 0)[at]
            hit = _isin(a, first)
            at, a = at[hit], a[hit]
            if not len(at):
                continue
            b = runs(hashes[1], n, 1)[at]
            lo, hi = np.searchsorted(first, a), np.searchsorted(first, a, side="right")
            which = np.repeat(np.arange(len(at)), hi - lo)
            k = np.arange(len(which)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[which]
            same = second[k] == b[which]
            yield n, at[which[same]], row[k[same]]


def _isin(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Membership in a sorted array; a table of the leading 16 bits sets most values aside."""
    seen = np.zeros(1 << 16, bool)
    seen[ordered >> np.uint64(48)] = True
    out = seen[x >> np.uint64(48)]
    at = np.flatnonzero(out)
    where = np.minimum(np.searchsorted(ordered, x[at]), max(0, len(ordered) - 1))
    out[at] = ordered[where] == x[at] if len(ordered) else False
    return out


_HIT = "struct<n_words: bigint, n_hit: bigint, n_items: bigint, items_sha256: string, items: array<string>>"


def hit_column(held) -> F.Column:
    """Function of a text column: words, hit words, items by number, digest and name (sorted strings)."""

    @F.arrow_udf(_HIT)
    def hits(column: pa.Array) -> pa.Array:
        marks, rows = held.value, []
        for some in slices(column):
            data, off, _ = utf8(some)
            *_, counts, h = words(data, off, ALPHANUMERIC, LOWER)
            ends = np.cumsum(counts)
            hit = np.zeros(h.shape[1], bool)
            items: dict[int, set] = {}
            for n, place, row in marks.windows(h, counts):
                hit |= cover(np.unique(place), n, h.shape[1])
                for doc, k in {*zip(np.searchsorted(ends, place, side="right").tolist(), row.tolist())}:
                    items.setdefault(doc, set()).add(marks.items[k])
            total = np.concatenate([[0], np.cumsum(hit)])
            n_hit = total[ends] - total[ends - counts]
            for doc, (count, covered) in enumerate(zip(counts.tolist(), n_hit.tolist())):
                own = sorted(items.get(doc, set()) - {None})
                rows.append((count, covered, len(own), sha(",".join(own).encode()), own))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]
        columns = list(zip(*rows)) or [()] * 5
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["n_words", "n_hit", "n_items", "items_sha256", "items"])

    return hits


def sieve(windows: DataFrame) -> np.ndarray:
    """The bitmap of all fingerprints, in 64-bit parts that Spark has put together; its size is fixed."""
    bit = F.shiftrightunsigned("mark", 64 - SIEVE_BITS)
    parts = windows.groupBy(F.shiftright(bit, 6).alias("part")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(mark, {64 - SIEVE_BITS}) & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    out[np.asarray(parts.column("part"))] = np.asarray(parts.column("bits"))
    return out.view(np.uint64)


def document_windows(texts: DataFrame, lengths: list[int], held, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(_key, place, n, a, b, mark) of the windows of ``texts`` (_key, _text) whose fingerprint passes the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for batch in batches:
            done = 0
            for part in slices(batch.column(1)):
                keys = batch.column(0).slice(done, len(part))
                done += len(part)
                data, off, _ = utf8(part)
                *_, counts, h = words(data, off, ALPHANUMERIC, LOWER)
                ends = np.cumsum(counts)
                for n in lengths:
                    ok = inside(counts, n)
                    if not len(ok):
                        continue
                    a = runs(h[0], n, 0)
                    mark = fingerprints(h[0], window, gram) if n == window else a
                    bit = mark >> np.uint64(64 - SIEVE_BITS)
                    place = np.flatnonzero(ok & ((bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)).astype(bool))
                    doc = np.searchsorted(ends, place, side="right")
                    own = [pa.array(x[place].view(np.int64)) for x in (a, runs(h[1], n, 1), mark)]
                    begin = (place - (ends - counts)[doc]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(doc)), pa.array(begin), pa.array(np.full(len(place), n, np.int32)), *own], ["_key", "place", "n", "a", "b", "mark"]
                    )

    return texts.mapInArrow(run, f"_key binary, place bigint, {_WINDOW}")


def joined_hits(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """(_key, n_hit, n_items, items_sha256, items) of the ``texts`` (_key, _text) that hold test windows, by joins.

    Copies of a text send the same rows, which Spark combines before it shuffles them.
    """
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most as many as a window has words
    held = texts.sparkSession.sparkContext.broadcast(sieve(windows))
    names = ["n", "a", "b", "mark"]
    found = checkpointed(document_windows(texts, lengths, held).distinct().join(windows.select(names).distinct(), names, "left_semi"))
    before = W.partitionBy("_key").orderBy("place", "n").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("place") + F.col("n")
    fresh_words = F.greatest(F.lit(0), end - F.greatest("place", F.coalesce(F.max(end).over(before), F.lit(0))))
    hit = found.withColumn("_fresh", fresh_words).groupBy("_key").agg(F.sum("_fresh").cast("long").alias("n_hit"))
    items = found.select("_key", *names).distinct().join(windows, names).filter("item is not null").groupBy("_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    own = F.coalesce("items", F.array().cast("array<string>"))
    return hit.join(items, "_key", "left").select("_key", "n_hit", F.size(own).cast("long").alias("n_items"), F.sha2(F.array_join(own, ",").cast("binary"), 256).alias("items_sha256"), own.alias("items"))


def _table(benchmark: DataFrame, item_col: str, item_text_col: str, rows: int):
    """(windows' table, its broadcast or None): the size is measured first."""
    windows = checkpointed(item_windows(benchmark, item_col, item_text_col))
    size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("item")), F.lit(0))).first()
    if size[0] <= rows and size[1] <= BROADCAST_NAMES:
        return windows, benchmark.sparkSession.sparkContext.broadcast(Fingerprints(windows.toArrow()))
    return windows, None


def _word_count() -> F.Column:
    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        out = [np.zeros(0, np.int64)]
        for part in slices(column):
            data, off, _ = utf8(part)
            out.append(words(data, off, ALPHANUMERIC, LOWER, lanes=0)[2])
        return pa.array(np.concatenate(out))

    return count


def _judged(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str, rows: int, name: str) -> DataFrame:
    """``docs`` with one more column ``name``: words, hit words, items."""
    windows, held = _table(benchmark, item_col, item_text_col, rows)
    text = F.coalesce(F.col(text_col), F.lit(""))
    if held is not None:
        return docs.withColumn(name, hit_column(held)(text))
    key = F.unhex(F.md5(text.cast("binary")))
    hits = joined_hits(docs.select(key.alias("_key"), text.alias("_text")), windows)
    hits = hits.select(F.col("_key").alias(f"{name}_key"), F.struct("n_hit", "n_items", "items_sha256", "items").alias(f"{name}_hits"))
    counted = docs.withColumns({f"{name}_words": _word_count()(text), f"{name}_own": key})
    out = counted.join(hits, F.col(f"{name}_own") == F.col(f"{name}_key"), "left")
    hit = lambda c, none: F.coalesce(F.col(f"{name}_hits.{c}"), none)
    return out.select(*docs.columns, F.struct(
        F.col(f"{name}_words").alias("n_words"), hit("n_hit", F.lit(0)).cast("long").alias("n_hit"), hit("n_items", F.lit(0)).cast("long").alias("n_items"),
        hit("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), hit("items", F.array().cast("array<string>")).alias("items"),
    ).alias(name))


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A word is hit if it lies in an occurrence of a window of the test set; a document is contaminated if a twentieth
    of its words or more are hit. A test set of up to ``broadcast_rows`` distinct windows is broadcast and nothing is
    shuffled; a larger one is joined. Null or empty texts have no words and aren't contaminated; items without words
    mark nothing; an item with a null id marks words but isn't listed; repeated items count once; an empty test set
    marks nothing; texts of any length are judged whole; repeated rows are judged each; a null id stays null; an empty
    table gives none; other columns are ignored, whatever their names.
    """
    judged = _judged(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), benchmark, "_text", item_col, item_text_col, broadcast_rows, "_hits")
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return judged.select(F.col("_id").alias(id_col), "_hits.*").select(id_col, "n_words", "n_hit", "n_items", "items_sha256", bad.alias("contaminated"), "items")


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``docs`` without contaminated rows; all columns stay, whatever their names.

    Rows are judged as by ``contamination``: null and empty texts stay, repeated rows stay or go together, an empty
    test set or an empty table changes nothing.
    """
    name = fresh(docs, "hits")
    n_hit, n_words = F.col(f"{name}.n_hit"), F.col(f"{name}.n_words")
    judged = _judged(docs, benchmark, text_col, item_col, item_text_col, broadcast_rows, name)
    return judged.filter(~((n_hit > 0) & (20 * n_hit >= n_words))).select(docs.columns)
