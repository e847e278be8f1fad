"""Spelling variants: words one edit apart, found by dense tiles of code-point matrices.

Two words differ by one inserted, deleted or replaced character exactly if their common prefix and common suffix
together reach the longer length minus one. Tiles compare a block of words with another, all pairs at once: words are
rows of a padded matrix of code points, prefixes are counted column by column from the left, suffixes from the right.

Not all tiles can hold such a pair: one of prefix and suffix reaches half of the shorter length. So words of neighbouring
lengths meet twice, in order of their first halves and in order of their last halves, and only blocks that share a half
are compared. Words that share a half with very many others are cut into parts, of which each pair is a task's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import checkpointed

#: Rows and code points of a block, words of a part of a common half, entries that meet in one task (on average).
BLOCK_ROWS, BLOCK_CELLS, PART, TASK_ROWS = 256, 1 << 20, 4096, 1 << 17
#: Halves with several parts up to which their table is broadcast (some 50 bytes each, halves of long words more).
BROADCAST_HALVES = 20_000
#: A form occurs at least so many times as often as its variant.
RATIO = 10
#: Characters of words, and which texts are misspelt, deterministically, to have variants.
_LETTERS, _EVERY = "A-Za-z\\u00C0-\\u00FF", 31


def word_counts(docs: DataFrame, id_col: str, text_col: str, least_length: int, least_count: int) -> DataFrame:
    """(word, n): the misspelt and other words of all texts, of at least these code points and occurrences.

    Only runs of at least ``least_length`` letters are looked at, as a deletion makes none longer.
    """
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.col(id_col).cast("string").alias("_id"), F.explode(F.regexp_extract_all(low, F.lit(f"[{_LETTERS}]{{{least_length},}}"), F.lit(0))).alias("_run"))
    h = F.crc32(F.concat(F.coalesce("_id", F.lit("")), F.lit(":"), F.col("_run")).cast("binary"))
    at = (h % F.char_length("_run")).cast("int")
    shorter = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.char_length("_run")))
    words = runs.select(F.when(h % _EVERY == 0, shorter).otherwise(F.col("_run")).alias("word")).filter(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def entries(words: DataFrame) -> DataFrame:
    """(_base, _last, _half, word, n): each word as the shorter and as the longer of two, by its first and by its last half.

    ``_base`` is the shorter's length; the longer of common prefix and suffix reaches half of it, rounded down.
    """
    size, h = F.char_length("word"), F.floor(F.col("_base") / 2).cast("int")
    both = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("_base")).filter("_base > 0")
    sided = both.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("_last"))
    return sided.select("_base", "_last", F.when(F.col("_last"), F.right("word", h)).otherwise(F.left("word", h)).alias("_half"), "word", "n")


def dealt(all_: DataFrame, part: int, tasks: int) -> DataFrame:
    """``all_`` with _own, the part of its half that a word is in, _a and _b, the two parts that meet, and _task, where they do."""
    key = ["_base", "_last", "_half"]
    large = checkpointed(all_.groupBy(*key).count().filter(F.col("count") > part).select(*key, F.ceil(F.col("count") / part).cast("long").alias("_parts")))
    known = all_.join(F.broadcast(large) if large.count() <= BROADCAST_HALVES else large, key, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("long")))
    known = known.withColumn("_own", F.pmod(F.xxhash64("word"), F.col("_parts")))
    out = known.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    out = out.select(*key, "word", "n", "_own", F.least("_own", "_other").alias("_a"), F.greatest("_own", "_other").alias("_b"))
    return out.withColumn("_task", F.pmod(F.xxhash64(*key, "_a", "_b"), F.lit(tasks)))


def code_points(words: list[str], width: int) -> np.ndarray:
    """(width x words) code points, padded with zeros."""
    m = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).T
    return np.ascontiguousarray(m.astype(np.uint8) if m.max(initial=0) < 256 else m)


class Block:
    """Words of a base, as columns of a matrix that begins with their first characters and of one that ends with their last."""

    def __init__(self, words: list[str], base: int, at: int):
        self.at, self.longer = at, np.array([len(w) > base for w in words])
        self.left = code_points(words, base + 1)
        self.right = self.left.copy()
        self.right[1:, ~self.longer], self.right[0, ~self.longer] = self.left[:-1, ~self.longer], 0


def one_edit(a: Block, b: Block, pairs: np.ndarray, base: int, last: bool) -> np.ndarray:
    """Which of ``pairs`` (rows of ``a`` x rows of ``b``, at most one of a pair the longer) are one edit apart.

    All of them have one first half (or ``last`` half); of pairs that have both in common, only those under the first count.
    """
    half, longest = base // 2, base + (a.longer[:, None] | b.longer)
    reached, prefix = np.zeros(pairs.shape, np.int32), None
    for from_left in (True, False):
        x, y = (a.left, b.left) if from_left else (a.right, b.right)
        run, shared = pairs.copy(), half if from_left != last else 0
        reached += shared
        for c in range(shared, base):
            run &= x[c][:, None] == y[c] if from_left else x[base - c][:, None] == y[base - c]
            if not run.any():
                break
            reached += run
        if from_left:
            prefix = reached.copy()
    found = pairs & (reached >= longest - 1)
    return found & (prefix < half) if last else found


def _matches(words: list[str], base: np.ndarray, last: np.ndarray, key: np.ndarray, own: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that are one edit apart, of a task's words in order of base, half and parts.

    ``key`` numbers halves (and pairs of parts); ``alone`` is true where a half's part meets itself, else only words of
    different parts are compared.
    """
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(base) != 0) | (np.diff(last.astype(np.int8)) != 0), [True]]))
    for lo, hi in zip(edges.tolist(), edges[1:].tolist()):
        size = int(base[lo])
        rows = max(1, min(BLOCK_ROWS, BLOCK_CELLS // (size + 1)))
        blocks = [Block(words[at : min(at + rows, hi)], size, at) for at in range(lo, hi, rows)] if (hi - lo) * size <= BLOCK_CELLS else None
        make = lambda at: blocks[(at - lo) // rows] if blocks else Block(words[at : min(at + rows, hi)], size, at)  # noqa: B023, E731
        for i in range(lo, hi, rows):
            i_end, a = min(i + rows, hi), make(i)
            for j in range(i, hi, rows):
                j_end = min(j + rows, hi)
                if key[j] > key[i_end - 1]:
                    break  # no half in common from here on
                pairs = (key[i:i_end, None] == key[j:j_end]) & (alone[i:i_end, None] | (own[i:i_end, None] != own[j:j_end]))
                b = a if i == j else make(j)
                pairs &= ~(a.longer[:, None] & b.longer)
                if i == j:
                    pairs = np.triu(pairs, 1)
                if pairs.any():
                    p, q = np.nonzero(one_edit(a, b, pairs, size, bool(last[lo])))
                    left.append(p + i)
                    right.append(q + j)
    return np.concatenate(left), np.concatenate(right)


def near_words(t: pa.Table) -> pa.Table:
    """(word, n_near, form_n, form) of a task's words: how many it found near each, and the one with the most occurrences."""
    base, own, a, b = (t.column(c).to_numpy() for c in ("_base", "_own", "_a", "_b"))
    last = t.column("_last").to_numpy(zero_copy_only=False)
    half = t.column("_half").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((b, a, half, last, base))
    t = t.take(pa.array(order))
    keys = np.stack([x[order].astype(np.int64) for x in (base, last, half, a, b)])
    key = np.cumsum(np.concatenate([[0], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if len(order) else np.zeros(0, np.int64)
    words, n = t.column("word").combine_chunks(), t.column("n").to_numpy()
    i, j = _matches(words.to_pylist(), base[order], last[order], key, own[order], (a == b)[order])
    word, near = np.concatenate([i, j]), np.concatenate([j, i])
    rank = np.empty(len(order), np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(order))  # by bytes of UTF-8, which is by code points
    best = np.lexsort((rank[near], -n[near], word))
    word, near = word[best], near[best]
    at = np.flatnonzero(np.diff(word, prepend=-1))
    count = np.diff(np.append(at, len(word)))
    return pa.table([words.take(pa.array(word[at])), pa.array(count), pa.array(n[near[at]]), words.take(pa.array(near[at]))], ["word", "n_near", "form_n", "form"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): forms followed to the last.

    A form occurs RATIO times as often as its variant, so a chain of 64-bit counts has less than 20 forms, and halving what is left of each ends after five rounds.
    """
    at = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("_via"), F.col("root").alias("_next"))
        after = checkpointed(at.join(on, F.col("root") == F.col("_via"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if after.filter("_moved").isEmpty():
            return after.drop("_moved")
        at = after.drop("_moved")


def variants(docs: DataFrame, least_length: int = 7, least_count: int = 2, id_col: str = "doc_id", text_col: str = "text", part: int = PART, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row for each word of the texts: word, form, root, n, n_near, form_n.

    Words are maximal runs of Latin letters, A-Z in lower case, some of them misspelt by rule; those of at least
    ``least_length`` (one at least) characters and ``least_count`` occurrences (``n``) count. ``n_near`` words are one inserted,
    deleted or replaced character away; ``form`` is the most frequent of them (ties: first by code points), if it occurs at
    least ten times as often (``form_n``), else null; ``root`` is the last form that forms lead to, the word itself if it
    has none. Whole texts of any length are read, and words of any length compared; null and empty texts have none, a
    null id counts as empty in the rule of misspelling, repeated rows count each; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    words = checkpointed(word_counts(docs, id_col, text_col, least_length, least_count))
    all_ = entries(words)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-4 * words.count() // task_rows))
    some = dealt(all_, part, tasks).groupBy("_task").applyInArrow(near_words, "word string, n_near bigint, form_n bigint, form string")
    best = some.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("_best"))
    own = F.col("_best.less") * -1 >= RATIO * F.col("n")
    known = checkpointed(words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(own, F.col("_best.form")).alias("form"), F.when(own, -F.col("_best.less")).alias("form_n")))
    last = roots(known.filter("form is not null"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
