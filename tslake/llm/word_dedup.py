"""Substring dedup on words with difference-cover anchors.

A difference cover D modulo v has, for any two places i and j, a shift d < v with i + d and j + d both in D modulo v.
So two equal windows of 35 words share, at the same shift, a run of 15 words that begins at a cover place in both.
Only runs at cover places are hashed and counted over all documents. Around the repeated ones, matches are extended:
the windows that hold one are counted in turn, by a 128-bit hash of all their words, and those that occur again are
removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tslake.llm.blocks import MESSAGE, Blocks, answered, answers, distinct, message
from tslake.llm.common import slices, utf8
from tslake.llm.words import BLANK_SEPARATED, cover, inside, joined, runs, sha, words

WINDOW = 35
#: Perfect difference covers: period and places.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}


class Cover:
    """The anchors for windows of a given number of words: period, places, words of an anchor."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.period = max(v for v in COVERS if v <= max(1, window * 2 // 3))
        self.places = np.zeros(self.period, bool)
        self.places[list(COVERS[self.period])] = True
        self.length = window - self.period + 1


def _at(counts: np.ndarray, c: Cover, n: int) -> np.ndarray:
    """Beginnings of anchors: cover places, counted from the beginning of each text, with enough words after them."""
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)[:n]
    return np.flatnonzero(c.places[place % c.period] & inside(counts, c.length)[:n])


def anchor_hashes(texts: pa.Array, c: Cover) -> np.ndarray:
    out = [np.zeros(0, np.uint64)]
    for part in slices(texts):
        data, off, _ = utf8(part)
        *_, counts, h = words(data, off, BLANK_SEPARATED, lanes=1)
        grams = runs(h[0], c.length)
        out.append(grams[_at(counts, c, len(grams))])
    return np.concatenate(out)


def candidate_windows(texts: pa.Array, c: Cover, repeated: np.ndarray) -> Iterator[tuple]:
    """For each run of texts: its data, its words, and the windows that hold a repeated anchor (places and two hashes)."""
    for part in slices(texts):
        data, off, _ = utf8(part)
        starts, ends, counts, h = words(data, off, BLANK_SEPARATED)
        grams, ok = runs(h[0], c.length), inside(counts, c.window)
        at = _at(counts, c, len(grams))
        hit = at[_in_sorted(grams[at], repeated)]
        n = h.shape[1]
        around = np.zeros(n + c.period, bool)
        if len(hit):
            around = cover(hit, c.period, n + c.period)  # windows beginning at hit - period + 1 ... hit, moved by period - 1
        place = np.flatnonzero(around[c.period - 1 :][: len(ok)] & ok)
        yield data, starts, ends, counts, place, runs(h[0], c.window, 0)[place], runs(h[1], c.window, 1)[place]


def _in_sorted(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = True, **sizes) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, and kept_text unless ``texts`` is off.

    Words covered by a window of ``window`` words that also begins anywhere else, in the same document or another, are
    removed; windows are judged on the input. Null counts as a text without words (0, 0, hash of the empty string).
    Repeated rows are documents of their own and so repeat each other; a null id stays null; an empty table gives none;
    other columns are ignored. Frequent passages are counted once a block before they are shuffled.
    """
    with_texts = texts
    blocks, c = Blocks(docs, id_col, text_col, **sizes), Cover(window)
    n = blocks.buckets
    first = answers(blocks.send(lambda block, texts: message(block, n, *distinct(anchor_hashes(texts, c)))), 1, 1)

    def repeated_anchors(texts: pa.Array, answer: pa.Table) -> np.ndarray:
        own, _ = distinct(anchor_hashes(texts, c))
        return own[answered(answer, 1), 0]

    def windows(block: int, ids: pa.Array, texts: pa.Array, answer: pa.Table) -> pa.Table:
        found = list(zip(*[x[5:] for x in candidate_windows(texts, c, repeated_anchors(texts, answer))]))
        lanes = [np.concatenate(x) for x in found] if found else [np.zeros(0, np.uint64)] * 2
        return message(block, n, *distinct(*lanes))

    second = answers(blocks.read(first, windows, MESSAGE), 2, 2)

    def result(block: int, ids: pa.Array, texts: pa.Array, answer: pa.Table) -> pa.Table:
        parts = list(candidate_windows(texts, c, repeated_anchors(texts, answer)))
        lanes = [np.concatenate([np.zeros(0, np.uint64), *[x[k] for x in parts]]) for k in (5, 6)]
        own, _ = distinct(*lanes)
        bad = own[answered(answer, 2)]
        rows = []
        for data, starts, ends, counts, place, a, b in parts:
            at = np.minimum(np.searchsorted(bad[:, 0], a), max(0, len(bad) - 1))
            hit = (bad[at, 0] == a) if len(bad) else np.zeros(len(a), bool)
            for i in np.flatnonzero(hit & (bad[at, 1] != b) if len(bad) else hit).tolist():  # two windows with one first hash
                hit[i] = bool(((bad[:, 0] == a[i]) & (bad[:, 1] == b[i])).any())
            gone = cover(place[hit], window, len(starts))
            for lo, hi in zip(np.cumsum(counts) - counts, np.cumsum(counts)):
                kept = ~gone[lo:hi]
                text = joined(data, starts[lo:hi][kept], ends[lo:hi][kept])
                rows.append((int(hi - lo), int(hi - lo - kept.sum()), sha(text), text.decode("utf-8", "replace") if with_texts else None))
        columns = list(zip(*rows)) or [()] * 4
        return pa.table([ids, *[pa.array(x, k) for x, k in zip(columns, [pa.int64(), pa.int64(), pa.string(), pa.string()])]], ["_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    ddl = f"_id {blocks.id_type.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    out = blocks.unfolded(blocks.read(first.unionByName(second), result, ddl), id_col)
    return out if with_texts else out.drop("kept_text")
