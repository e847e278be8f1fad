"""Token counts: batch encoding in Arrow functions that return lengths only.

A text is cut before single spaces between two visible characters. The tokenizer's pre-split starts a new piece there
whatever stands around it, so the tokens of the parts are the tokens of the whole. Words recur, so each worker keeps
their encodings in a bounded table and sends only unknown ones to the tokenizer, in batches. Parts that have no safe
boundary stay whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import slices, utf8
from tslake.llm.words import _MASKS, eight, mix

#: Characters after which a long text is cut at the next safe boundary.
SEGMENT_CHARS = 1 << 16
#: Remembered parts of a worker; the memo starts afresh beyond it. Longer parts aren't remembered.
MEMO_PARTS, MEMO_CHARS = 100_000, 64

_OTHER = re.compile(r"[^\S \n]")  # white space but blanks and new lines
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_CUT = re.compile(r"\S \S")
#: Letters, marks, and perhaps a new line with letters and marks: the pre-split cuts such a part just between these groups.
_PLAIN = re.compile(r"(\w+)([.,;:!?]*)(?:(\n)(\w+)([.,;:!?]*))?")


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """Whole ``text`` in consecutive parts of about ``size`` characters, cut at safe boundaries; a part after the first begins with its space."""
    start = 0
    while len(text) - start > size:
        m = _CUT.search(text, start + size)
        if not m:
            break
        yield text[start : m.start() + 1]
        start = m.start() + 1
    yield text[start:]


class Encoder:
    """Encodes whole texts by parts; ``value`` makes what is kept of a part's ids."""

    def __init__(self, path: str, value):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.value = Tokenizer.from_file(path), value
        self.known_split = splits_as_known(path)
        self.first: dict[str, object] = {}  # parts as they are
        self.later: dict[str, object] = {}  # parts that a space precedes, without it

    def parts(self, segment: str) -> list[str]:
        """``segment`` cut at all safe boundaries; the blanks there are left out."""
        unsafe = "  " in segment or " \n" in segment or "\n " in segment or segment[:1] == " " or segment[-1:] == " " or _OTHER.search(segment)
        return _SAFE.split(segment) if unsafe else segment.split(" ")

    def values(self, batch: list[str]) -> list[list]:
        """For each segment of ``batch``, the values of its parts in order; whole texts where the file's split isn't known."""
        if not self.known_split:
            return [[self.value(e)] for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        if len(self.later) + len(self.first) > MEMO_PARTS:
            self.first.clear()
            self.later.clear()
        spaced = [x.startswith(" ") and x[1:2].strip() != "" for x in batch]
        split = [self.parts(x[1:] if cut else x) for x, cut in zip(batch, spaced)]
        known = self.later.get
        own = [p if cut else p[1:] for p, cut in zip(split, spaced)]
        out: list[list] = [list(map(known, p)) for p in own]
        holes = [[k for k, v in enumerate(values) if v is None] if None in values else () for values in out]
        wanted = {p[k] for p, ks in zip(own, holes) for k in ks}
        passing = self._learn(self.first, {p[0] for p, cut in zip(split, spaced) if not cut}, "") + self._learn(self.later, wanted, " ")
        for p, values, ks in zip(own, out, holes):
            for k in ks:
                values[k] = known(p[k])
        for p, cut, values in zip(split, spaced, out):
            if not cut:
                values.insert(0, self.first[p[0]])
        for memo, part in passing:
            memo.pop(part, None)
        return out

    def _learn(self, memo: dict, parts: set[str], before: str) -> list[tuple[dict, str]]:
        """Values of unknown ``parts`` into ``memo``; returns the entries that are too long to stay.

        A part of letters and marks is put together from its groups, so that a word is encoded once whatever marks follow it.
        """
        new = list(parts.difference(memo))
        whole, made = [], []
        heads, tails = set(), set()
        for p in new:
            m = _PLAIN.fullmatch(p)
            if m and m[1].isalpha() and (m[4] is None or m[4].isalpha()) and (m[2] or m[3]):
                rest = [x for x in m.groups()[1:] if x]
                made.append((p, m[1], rest))
                heads.add(m[1])
                tails.update(rest)
            else:
                whole.append(p)
        heads.update(whole)
        long = self._encode(memo, heads, before) + self._encode(self.first, tails, "")
        for p, head, rest in made:
            value = memo[head]
            for x in rest:
                value = value + self.first[x]
            memo[p] = value
        return list({(id(m), p): (m, p) for m, p in long + [(memo, p) for p, _, _ in made if len(p) > MEMO_CHARS]}.values())

    def _encode(self, memo: dict, parts: set[str], before: str) -> list[tuple[dict, str]]:
        new = list(parts.difference(memo))
        for i in range(0, len(new), 2048):
            some = new[i : i + 2048]
            encoded = self.tokenizer.encode_batch_fast([before + p for p in some], add_special_tokens=False)
            memo.update(zip(some, map(self.value, encoded)))
        return [(memo, p) for p in new if len(p) > MEMO_CHARS]


#: By byte: 0 marks, 1 letters, 2 digits, 3 white space, 4 what only the tokenizer itself is to judge.
_CLASS = np.array([3 if c in (9, 10, 13, 32) else 4 if c < 32 or c == 39 or c >= 127 else 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 0 for c in range(256)], np.uint8)
#: Known words of a worker's table, and its slots (a power of two).
TABLE_WORDS, TABLE_SLOTS = 1_000_000, 1 << 21
#: Bytes of words of more than 16 bytes, and ids, that a table holds before it starts afresh.
TABLE_HELD = 16 << 20
#: Text bytes up to which a run of texts is encoded by table; longer texts go by segments.
TABLE_BYTES = 4 << 20


def splits_as_known(path: str) -> bool:
    """Whether a file splits texts by the byte-level pattern that ``WordTable`` and ``Encoder`` know, and nothing else changes them."""
    with open(path, encoding="utf-8") as f:
        own = json.load(f)
    split = own.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return bool(plain and not own.get("normalizer") and not (own.get("model") or {}).get("dropout"))


class WordTable:
    """Ids of the tokenizer's pre-split words, found for all words of many texts at once.

    Texts of ASCII and Latin-1 letters, digits, marks and plain white space are split with numpy as the tokenizer's
    pre-split does it; all others, and those with apostrophes or special strings, are left to ``Encoder``, and so is
    everything where the file's pre-split is another. A word of up to 16 bytes is known by these bytes themselves, as
    two numbers (plain texts hold no zero byte), a longer one is looked up in a dictionary; unknown ones are encoded by
    the tokenizer, each once.
    """

    def __init__(self, path: str):
        self.rest = Encoder(path, lambda e: array("I", e.ids).tobytes())
        self.tokenizer = self.rest.tokenizer
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known_split = splits_as_known(path)
        self.forget()

    def forget(self) -> None:
        self.one, self.two = np.zeros(TABLE_SLOTS, np.uint64), np.zeros(TABLE_SLOTS, np.uint64)
        self.entry = np.full(TABLE_SLOTS, -1, np.int32)
        self.size, self.used, self.held = 0, 0, 0
        self.long: dict[bytes, int] = {}
        self.begin, self.count, self.pool = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)

    def plain(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class of each byte, whether each text is plain)."""
        c = _CLASS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        tail = data[lead + 1]
        lead = lead[(tail >= 0x80) & (tail < 0xC0) & (tail != 0x97) & (tail != 0xB7)]
        c[lead] = c[lead + 1] = 1
        good = np.full(len(off) - 1, self.known_split)
        good[np.searchsorted(off, np.flatnonzero(c == 4), side="right") - 1] = False
        raw = data.tobytes()
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                good[np.searchsorted(off, at, side="right") - 1] = False
                at = raw.find(special, at + 1)
        return c, good

    @staticmethod
    def split(data: np.ndarray, c: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Beginnings of words: runs of one class, with one blank before them; of white space before a word, the last character stands alone or is that blank."""
        fresh = np.zeros(len(data), bool)
        fresh[off[:-1][off[:-1] < off[1:]]] = True
        begins = fresh.copy()
        begins[1:] |= c[1:] != c[:-1]
        after = np.flatnonzero(begins[1:] & ~fresh[1:] & (c[1:] != 3) & (c[:-1] == 3)) + 1
        begins[after] = data[after - 1] != 32
        begins[after - 1] = True
        return np.flatnonzero(begins)

    def _slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (mix(one * np.uint64(0x9E3779B97F4A7C15) + two) >> np.uint64(64 - TABLE_SLOTS.bit_length() + 1)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        out, todo, slot = np.full(len(one), -1, np.int32), np.arange(len(one)), self._slots(one, two)
        while len(todo):
            e = self.entry[slot]
            hit = (self.one[slot] == one[todo]) & (self.two[slot] == two[todo]) & (e >= 0)
            out[todo[hit]] = e[hit]
            on = ~hit & (e >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (TABLE_SLOTS - 1)
        return out

    def add(self, one: np.ndarray, two: np.ndarray, words: list[str]) -> None:
        """Encodes new words of up to 16 bytes; their pairs of numbers are distinct."""
        n = len(words)
        name, slot = self._store(words), self._slots(one, two)
        todo = np.arange(n)
        while len(todo):
            free = todo[self.entry[slot[todo]] < 0]
            self.entry[slot[free]] = name[free]
            won = free[self.entry[slot[free]] == name[free]]
            self.one[slot[won]], self.two[slot[won]] = one[won], two[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (TABLE_SLOTS - 1)

    def _store(self, words: list[str]) -> np.ndarray:
        """Encodes ``words`` and returns the numbers under which their ids are kept."""
        ids: list[int] = []
        sizes: list[int] = []
        for i in range(0, len(words), 2048):
            for e in self.tokenizer.encode_batch_fast(words[i : i + 2048], add_special_tokens=False):
                own = e.ids
                ids += own
                sizes.append(len(own))
        n, m = len(words), len(ids)
        while self.size + n > len(self.begin):
            self.begin, self.count = np.concatenate([self.begin, self.begin]), np.concatenate([self.count, self.count])
        while self.used + m > len(self.pool):
            self.pool = np.concatenate([self.pool, self.pool])
        size = np.array(sizes, np.int64)
        self.begin[self.size : self.size + n] = self.used + np.cumsum(size) - size
        self.count[self.size : self.size + n] = size
        self.pool[self.used : self.used + m] = ids
        self.size, self.used = self.size + n, self.used + m
        return np.arange(self.size - n, self.size, dtype=np.int32)

    def entries(self, data: np.ndarray, c: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry of each word, words of each text) of plain texts."""
        begins = self.split(data, c, off)
        ends = np.append(begins[1:], len(data))
        size, own = ends - begins, eight(data)
        one, two = own[begins] & _MASKS[np.minimum(size, 8)], np.zeros(len(begins), np.uint64)
        more = np.flatnonzero(size > 8)
        two[more] = own[begins[more] + 8] & _MASKS[np.minimum(size[more] - 8, 8)]
        found = self.find(one, two)
        long = np.flatnonzero(size > 16)
        found[long] = 0
        new = np.flatnonzero(found < 0)
        if len(new):
            order = new[np.lexsort((two[new], one[new]))]
            at = order[np.concatenate([[True], (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])])]
            raw = memoryview(data)
            self.add(one[at], two[at], [bytes(raw[a:b]).decode() for a, b in zip(begins[at].tolist(), ends[at].tolist())])
            found[new] = self.find(one[new], two[new])
        if len(long):
            raw = memoryview(data)
            spelt = [bytes(raw[a:b]) for a, b in zip(begins[long].tolist(), ends[long].tolist())]
            unknown = list(set(spelt).difference(self.long))
            self.long.update(zip(unknown, self._store([w.decode() for w in unknown]).tolist()))
            self.held += sum(map(len, unknown))
            found[long] = [self.long[w] for w in spelt]
        return found, np.diff(np.searchsorted(begins, off))

    def encode(self, texts: pa.Array, lengths_only: bool = False):
        """Counts of each text's tokens, and all ids in order unless ``lengths_only``."""
        if self.size > TABLE_WORDS or self.held > TABLE_HELD or self.used > TABLE_HELD:
            self.forget()
        data, off, _ = utf8(texts)
        data, off = data[off[0] : off[-1]], off - off[0]
        c, good = self.plain(data, off)
        if not good.all():
            keep = np.repeat(good, np.diff(off))
            data, c = data[keep], c[keep]
            off = np.concatenate([[0], np.cumsum(np.where(good, np.diff(off), 0))])
        found, n_words = self.entries(data, c, off)
        size = self.count[found]
        ends = np.cumsum(n_words)
        total = np.concatenate([[0], np.cumsum(size)])
        counts = total[ends] - total[ends - n_words]
        odd = np.flatnonzero(~good)
        extra = {}
        for i, ids, _ in encoded([texts[int(k)].as_py() or "" for k in odd], self.rest):
            extra[int(odd[i])] = extra.get(int(odd[i]), b"") + ids
        for k, ids in extra.items():
            counts[k] = len(ids) >> 2
        if lengths_only:
            return counts, None
        flat = self.pool[np.repeat(self.begin[found] - total[:-1], size) + np.arange(total[-1])]
        if extra:
            at = total[ends - n_words]
            parts, last = [], 0
            for k in sorted(extra):
                parts += [flat[last : at[k]], np.frombuffer(extra[k], np.uint32)]
                last = at[k]
            flat = np.concatenate([*parts, flat[last:]])
        return counts, flat


_tables: dict[str, WordTable] = {}


def word_table(path: str) -> WordTable:
    """The worker's table for a file."""
    if path not in _tables:
        _tables[path] = WordTable(path)
    return _tables[path]


def token_lengths(texts: pa.Array, path: str) -> list[int]:
    """Token counts of whole texts."""
    table = word_table(path)
    if _long(texts):
        counts = [0] * len(texts)
        for i, ids, _ in encoded([t or "" for t in texts.to_pylist()], table.rest):
            counts[i] += len(ids) >> 2
        return counts
    return table.encode(texts, lengths_only=True)[0].tolist()


def token_ids(texts: pa.Array, path: str) -> Iterator[tuple[int, bytes, bool, int]]:
    """(index of the text, little-endian 32-bit ids of its next part, whether that is its last part, number of its ids).

    A text that is encoded in several parts is counted first, so that no part waits for the last one.
    """
    table = word_table(path)
    if _long(texts):
        counts = token_lengths(texts, path)
        for i, ids, last in encoded([t or "" for t in texts.to_pylist()], table.rest):
            yield i, ids, last, counts[i]
        return
    counts, flat = table.encode(texts)
    at = np.cumsum(counts)
    for i, (a, b) in enumerate(zip((at - counts).tolist(), at.tolist())):
        yield i, flat[a:b].tobytes(), True, b - a


def _long(texts: pa.Array) -> bool:
    return texts.nbytes > TABLE_BYTES and len(utf8(texts)[0]) > 0 and int(np.diff(utf8(texts)[1]).sum()) > TABLE_BYTES


def n_tokens(text: F.Column, tokenizer_path: str) -> F.Column:
    """Column of token counts (long) of a string column by a ``tokenizers`` file; null counts as empty."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        out: list[int] = []
        for part in slices(column):
            out += token_lengths(part, tokenizer_path)
        return pa.array(out, pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit.

    No shuffle: Spark's byte-sized input splits balance the work, and within a task texts are taken in runs of about
    a quarter of a megabyte. Null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows are counted each;
    an empty table gives none; other columns are ignored. Begin, end and added special tokens aren't counted;
    a special string inside a text is what the library makes of it by default.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text, tokenizer_path).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def encoded(texts: list[str], by: Encoder, most: int = 1 << 20) -> Iterator[tuple[int, bytes, bool]]:
    """(index of the text, little-endian 32-bit ids of its next part, whether that is its last part)."""
    batch: list[str] = []
    owner: list[tuple[int, bool]] = []
    size = 0

    def flush() -> Iterator[tuple[int, bytes, bool]]:
        for (i, last), values in zip(owner, by.values(batch)):
            yield i, b"".join(values), last

    for i, text in enumerate(texts):
        held = None
        for s in segments(text) if by.known_split else [text]:
            if held is not None:
                batch.append(held)
                owner.append((i, False))
                size += len(held)
                if size > most:
                    yield from flush()
                    batch, owner, size = [], [], 0
            held = s
        batch.append(held or "")
        owner.append((i, True))
        size += len(held or "")
    yield from flush()
