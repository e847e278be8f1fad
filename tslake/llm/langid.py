"""Language identification by a linear-chain conditional random field over words.

Features of a word are its affixes, character n-grams and the word itself where the training lexicon has it, hashed
into one weight table. Transitions are learned with them: half of the training chains are spliced from texts of two
languages, so that the field learns how seldom code-switched text switches. Forward-backward gives each word's
distribution over languages; a text's is their mean over its words with letters.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.llm.common import cuts, slices
from tslake.llm.words import mix, powers

#: Bound of the training sample: pieces of texts for each language (fewer if there are many languages). Whole texts of
#: any length are cut into pieces of about PIECE characters, and each piece may be drawn.
SAMPLE_ROWS, SAMPLE_ALL, PIECE = 150, 4000, 1 << 13
#: Words of a training chain, and of the blocks that are predicted at once, with messages carried from block to block.
CHAIN = 64
TABLE = 1 << 18
ITERATIONS, RATE, DECAY = 30, 0.5, 1e-6
LEXICON_COUNT = 5
UNDETERMINED = "und"

#: Characters of a text that are taken at once; longer texts are cut at white space.
TAKEN = 1 << 20

_EDGE = 10
_tables: list[np.ndarray] = []


def _characters() -> list[np.ndarray]:
    """By code point: whether it is white space, whether it is a letter, and its lower case."""
    if not _tables:
        every = list(map(chr, range(0x110000)))
        _tables.append(np.array([c.isspace() for c in every]))
        _tables.append(np.array([c.isalpha() for c in every]))
        _tables.append(np.array([ord(c.lower()[0]) for c in every], np.uint32))
    return _tables


class Words:
    """The words with letters of some texts: letters alone, lower case, between edge marks.

    ``points`` holds edge, word, edge, word, ..., edge; word ``i`` is ``points[first[i]:last[i]]``; ``counts`` are the words of each text.
    """

    def __init__(self, texts: list[str]):
        space, letter, lower = _characters()
        u = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        end = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        gap = space[u]
        token = np.cumsum(gap)  # constant within a run without white space
        at = np.flatnonzero(letter[u])
        token = token[at]
        begins = np.flatnonzero(np.diff(token, prepend=-1))
        word = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(at))))
        self.points = np.full(len(at) + len(begins) + 1, _EDGE, np.uint64)
        self.points[np.arange(len(at)) + word + 1] = lower[u[at]]
        self.first = begins + np.arange(len(begins)) + 1
        self.last = np.append(self.first[1:] - 1, len(self.points) - 1)[: len(begins)]
        place = at[begins] if len(begins) else np.zeros(0, np.int64)
        self.counts = np.diff(np.searchsorted(place, end), prepend=0) if len(end) else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.first)

    def hashes(self) -> np.ndarray:
        """A hash of each whole word."""
        p, inverse = powers(0, len(self.points) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.points * p[: len(self.points)])])
        return mix((sums[self.last] - sums[self.first]) * inverse[self.first])

    def features(self, lexicon: np.ndarray) -> Iterator[np.ndarray]:
        """Table places: two arrays over ``points`` (bigrams and trigrams with the edges), then arrays over words (affixes of
        one to four letters, lexicon entry). TABLE stands for none."""
        x, n = self.points, self.last - self.first
        two = x[:-1] * np.uint64(0x9E3779B1) + x[1:] * np.uint64(0x85EBCA77)
        yield _place(two, 1)
        three = np.full(len(two), TABLE)
        three[:-1] = _place(two[:-1] * np.uint64(0xC2B2AE3D) + x[2:], 2)
        three[self.last - 1] = TABLE
        yield three
        for begin, sign, salt in ((self.first, 1, 3), (self.last - 1, -1, 4)):
            h = np.zeros(len(n), np.uint64)
            for k in range(4):
                h = h * np.uint64(0x27D4EB2F165667C5) + x[np.clip(begin + sign * k, 0, len(x) - 1)]
                yield np.where(n > k, _place(h, salt + 2 * k), TABLE)
        h = self.hashes()
        at = np.minimum(np.searchsorted(lexicon, h), max(0, len(lexicon) - 1))
        yield np.where(lexicon[at] == h, _place(h, 20), TABLE) if len(lexicon) else np.full(len(n), TABLE)


def _place(h: np.ndarray, salt: int) -> np.ndarray:
    return (((h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE.bit_length() + 1)).astype(np.int64)


def forward_backward(scores: np.ndarray, transition: np.ndarray, start: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (chains x words x labels) and expected transition counts; ``scores`` beyond a length are ignored.

    Works in probabilities with rescaling at each word, on all chains at once.
    """
    c, t, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    a, m = np.exp(transition), np.exp(start)
    forward, expected = np.empty_like(e), np.zeros((k, k))
    f = e[:, 0] * m
    forward[:, 0] = f = f / f.sum(axis=1, keepdims=True)
    for i in range(1, t):
        f = (f @ a) * e[:, i]
        f /= f.sum(axis=1, keepdims=True)
        forward[:, i] = f
    out, b = np.empty_like(e), np.ones((c, k))
    for i in range(t - 1, -1, -1):
        live = (lengths > i + 1)[:, None]
        if i + 1 < t:
            right = e[:, i + 1] * b
            new = right @ a.T
            joint = (forward[:, i][:, :, None] * a[None]) * right[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            expected += (joint * live[:, :, None]).sum(axis=0)
            b = np.where(live, new / new.sum(axis=1, keepdims=True), 1.0)
        p = forward[:, i] * b
        out[:, i] = p / p.sum(axis=1, keepdims=True)
    return out, expected


def transfers(e: np.ndarray, a: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each block, the matrix that takes a message before its first word to one after its last, up to a factor."""
    out = e[:, 0][:, :, None] * np.eye(e.shape[2])
    for i in range(1, e.shape[1]):
        live = np.flatnonzero(lengths > i)
        if not len(live):
            break
        t = (out[live] @ a) * e[live, i][:, None, :]
        out[live] = t / t.sum(axis=(1, 2), keepdims=True)
    return out


def linked(t: np.ndarray, a: np.ndarray, blocks: np.ndarray, enter: np.ndarray, leave: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Messages that enter each block from the left and from the right; ``blocks`` of each text follow one another.

    ``enter`` and ``leave`` are the messages at the ends of each text.
    """
    left, right = np.empty(t.shape[:2]), np.empty(t.shape[:2])
    first = np.cumsum(blocks) - blocks
    longest = int(blocks.max(initial=0))
    for k in range(longest):
        own = np.flatnonzero(blocks > k)
        at = first[own] + k
        if k == 0:
            left[at] = enter[own]
        else:
            v = np.einsum("ni,nij->nj", left[at - 1], t[at - 1]) @ a
            left[at] = v / v.sum(axis=1, keepdims=True)
    for k in range(longest):
        own = np.flatnonzero(blocks > k)
        at = first[own] + blocks[own] - 1 - k
        if k == 0:
            right[at] = leave[own]
        else:
            v = np.einsum("nij,nj->ni", t[at + 1], right[at + 1]) @ a.T
            right[at] = v / v.sum(axis=1, keepdims=True)
    return left, right


def block_marginals(e: np.ndarray, a: np.ndarray, lengths: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Marginals (blocks x words x labels) from words' factors, transitions' factors, and the messages at the blocks' ends."""
    c, t, k = e.shape
    forward = np.empty_like(e)
    f = e[:, 0] * left
    forward[:, 0] = f = f / f.sum(axis=1, keepdims=True)
    for i in range(1, t):
        f = (f @ a) * e[:, i]
        f /= f.sum(axis=1, keepdims=True)
        forward[:, i] = f
    b = right.copy()
    for i in range(t - 1, -1, -1):
        if i + 1 < t:
            b = (e[:, i + 1] * b) @ a.T
            b /= b.sum(axis=1, keepdims=True)
            last = lengths <= i + 1
            b[last] = right[last]
        forward[:, i] *= b
    return forward / forward.sum(axis=2, keepdims=True)


class Field:
    """Languages, weights of features, transitions."""

    def __init__(self, texts: list[str], langs: list[str], iterations: int = ITERATIONS, chain: int = CHAIN):
        self.langs = sorted(set(langs))
        self.chain = chain
        k = len(self.langs)
        self.weights, self.transition, self.start = np.zeros((k, TABLE + 1), np.float32), np.zeros((k, k)), np.zeros(k)
        self.lexicon = np.zeros(0, np.uint64)  # hashes of words that recur in training
        if k > 1:
            self._fit(texts, [self.langs.index(x) for x in langs], iterations)

    def _fit(self, texts: list[str], labels: list[int], iterations: int) -> None:
        rng = np.random.Generator(np.random.PCG64(7))
        words = Words(texts)
        hashes = words.hashes()
        known, index, count = np.unique(hashes, return_inverse=True, return_counts=True)
        self.lexicon = known[count >= LEXICON_COUNT]
        gold_of = np.repeat(np.array(labels), words.counts)
        bounds = np.concatenate([[0], np.cumsum(words.counts)]).tolist()
        chains = [(index[i : min(i + self.chain, b)], gold_of[i : min(i + self.chain, b)]) for a, b in zip(bounds, bounds[1:]) for i in range(a, b, self.chain)]
        order = rng.permutation(len(chains))
        spliced = []
        for i, j in zip(order[: len(order) // 2], order[len(order) // 2 :]):  # half of a chain, then half of another
            (a, x), (b, y) = chains[i], chains[j]
            n, m = max(1, len(a) // 2), max(1, len(b) // 2)
            spliced.append((np.concatenate([a[:n], b[:m]]), np.concatenate([x[:n], y[:m]])))
        chains += spliced
        c, k = len(chains), len(self.langs)
        lengths = np.array([len(a) for a, _ in chains])
        word, gold = np.full((c, self.chain), len(known)), np.full((c, self.chain), -1)
        for i, (a, y) in enumerate(chains):
            word[i, : len(a)], gold[i, : len(y)] = a, y
        mask = gold >= 0
        truth = np.zeros((c, self.chain, k))
        np.put_along_axis(truth, np.maximum(gold, 0)[:, :, None], 1.0, axis=2)
        truth *= mask[:, :, None]
        both = mask[:, 1:] & mask[:, :-1]
        moves = np.zeros((k, k))
        np.add.at(moves, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        # features of one word of each kind
        sample = np.full(len(known), -1)
        sample[index] = np.arange(len(index))
        of_word = np.full(len(hashes), -1)
        of_word[sample] = np.arange(len(known))
        segment = np.repeat(np.arange(len(words)), words.last - words.first + 1)
        flat, owner = [], []
        for i, f in enumerate(words.features(self.lexicon)):
            o = of_word[segment if i < 2 else np.arange(len(words))]
            ok = (o >= 0) & (f != TABLE)
            flat.append(f[ok])
            owner.append(o[ok])
        flat, owner = np.concatenate(flat), np.concatenate(owner)
        by_owner = np.argsort(owner, kind="stable")
        flat, owner = flat[by_owner], owner[by_owner]
        at = np.searchsorted(owner, np.arange(len(known)))
        used, flat = np.unique(flat, return_inverse=True)
        w, total = np.zeros((len(used), k)), float(mask.sum())
        squares, moved, began = np.full_like(w, 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
        for _ in range(iterations):
            scores = np.vstack([np.add.reduceat(w[flat], at, axis=0), np.zeros((1, k))])[word]
            p, expected = forward_backward(scores, self.transition, self.start, lengths)
            error = (truth - p * mask[:, :, None]) / total
            by_word = np.stack([np.bincount(word.ravel(), weights=error[:, :, y].ravel(), minlength=len(known) + 1)[:-1] for y in range(k)], axis=1)
            gradient = np.stack([np.bincount(flat, weights=by_word[owner, y], minlength=len(used)) for y in range(k)], axis=1) - DECAY * w
            squares += gradient**2
            w += RATE * gradient / np.sqrt(squares)
            g = (moves - expected) / total
            moved += g**2
            self.transition += RATE * g / np.sqrt(moved)
            g = (truth[:, 0] - p[:, 0]).sum(axis=0) / total
            began += g**2
            self.start += RATE * g / np.sqrt(began)
        self.weights[:, used] = w.T

    def _factors(self, texts: list[str]) -> tuple:
        """(words' factors by block, words of each block, blocks of each text, place of each word, words of each text)."""
        words, size, k = Words(texts), self.chain, len(self.langs)
        counts = words.counts
        blocks = -(-counts // size)
        first = np.repeat(np.cumsum(blocks) - blocks, counts) * size  # texts begin new blocks
        place = first + np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        padded = np.zeros((int(blocks.sum()) * size, k))
        places = list(words.features(self.lexicon)) if len(words) else []
        for y in range(k if len(words) else 0):
            w = self.weights[y]
            score = np.add.reduceat(w[places[0]] + w[places[1]], words.first - 1)
            for p in places[2:]:
                score += w[p]
            padded[place, y] = score
        lengths = np.full(int(blocks.sum()), size)
        some = counts > 0
        lengths[np.cumsum(blocks)[some] - 1] = counts[some] - (blocks[some] - 1) * size
        scores = padded.reshape(-1, size, k)
        return np.exp(scores - scores.max(axis=2, keepdims=True)), lengths, blocks, place, counts

    def word_marginals(self, texts: list[str], enter: np.ndarray | None = None, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(distribution of each word with letters, number of such words of each text).

        Texts are taken in blocks of words at once, whose messages are carried over; ``enter`` and ``leave`` are those
        at the ends of texts that are parts of longer ones.
        """
        e, lengths, blocks, place, counts = self._factors(texts)
        k, a = len(self.langs), np.exp(self.transition)
        if not len(place):
            return np.zeros((0, k)), counts
        enter = np.tile(np.exp(self.start), (len(texts), 1)) if enter is None else enter
        left, right = linked(transfers(e, a, lengths), a, blocks, enter, np.ones((len(texts), k)) if leave is None else leave)
        return block_marginals(e, a, lengths, left, right).reshape(-1, k)[place], counts

    def _carried(self, parts: list[str]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        """The parts of one text that hold words, with the messages at both ends of each."""
        k, a, own, whole = len(self.langs), np.exp(self.transition), [], []
        for part in parts:
            e, lengths, _, place, _ = self._factors([part])
            if len(place):
                first, *more = transfers(e, a, lengths)
                for t in more:
                    first = first @ a @ t
                    first /= first.sum()
                own.append(part)
                whole.append(first)
        left, right = linked(np.array(whole).reshape(-1, k, k), a, np.array([len(own)]), np.exp(self.start)[None], np.ones((1, k)))
        for i, part in enumerate(own):
            yield part, left[i : i + 1], right[i : i + 1]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, share of the words' probability) of each text."""
        sums = np.zeros((len(texts), len(self.langs)))
        short = [i for i, t in enumerate(texts) if len(t) <= TAKEN]
        for lo, hi in cuts(np.array([len(texts[i]) for i in short], np.int64), TAKEN // 2):
            p, counts = self.word_marginals([texts[i] for i in short[lo:hi]])
            owner = np.repeat(np.array(short[lo:hi]), counts)
            for y in range(len(self.langs)):
                sums[:, y] += np.bincount(owner, weights=p[:, y], minlength=len(texts))
        for i in set(range(len(texts))).difference(short):
            for part, left, right in self._carried(list(_parts(texts[i]))):
                sums[i] += self.word_marginals([part], left, right)[0].sum(axis=0)
        total, best = sums.sum(axis=1), sums.argmax(axis=1)
        return [(self.langs[b], min(1.0, float(s[b] / n))) if n > 0 else (UNDETERMINED, 0.0) for b, s, n in zip(best, sums, total)]


_SPACE = re.compile(r"\s")


def _parts(text: str, size: int | None = None) -> Iterator[str]:
    """``text`` in parts of about ``size`` (else TAKEN) characters, cut at white space."""
    start, size = 0, size or TAKEN
    while len(text) - start > size and (m := _SPACE.search(text, start + size)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def _stretches(piece: str) -> list[str]:
    """``piece``, cut anywhere where it has no white space for long."""
    return [piece] if len(piece) <= 4 * PIECE else [piece[i : i + PIECE] for i in range(0, len(piece), PIECE)]


def held_out(id_col: str) -> F.Column:
    """Whether a document takes no part in training: the CRC-32 of its id as text leaves 1 modulo 3. A null id isn't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_pieces(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(_lang, _piece): for each known language at most ``sample_rows`` distinct pieces of its texts, drawn by their hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                langs = batch.column(0).slice(at, len(part)).to_pylist()
                at += len(part)
                rows = [(lang, p) for lang, t in zip(langs, part.to_pylist()) for q in _parts(t, PIECE) for p in _stretches(q) if not p.isspace()]
                langs, pieces = zip(*rows) if rows else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.string())], ["_lang", "_piece"])

    known = docs.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")).filter(F.col("_lang").isNotNull() & (F.length("_text") > 0))
    counts = known.groupBy("_lang").agg(F.sum(F.ceil(F.length("_text") / PIECE)).alias("count")).collect()
    each = max(1, min(sample_rows, SAMPLE_ALL // max(1, len(counts))))
    # twice as many pieces as wanted pass a first draw, at least; copies count once
    share = F.lit(0)
    for row in counts:
        share = F.when(F.col("_lang") == row["_lang"], F.lit(max(1, int(min(1.0, 2 * each / row["count"]) * (1 << 30))))).otherwise(share)
    long_or_drawn = (F.length("_text") > PIECE) | (F.pmod(F.xxhash64("_text"), F.lit(1 << 30)) < share)  # a short text is its only piece
    pieces = known.filter(long_or_drawn).mapInArrow(cut, "_lang string, _piece string").withColumn("_hash", F.xxhash64("_piece"))
    drawn = pieces.filter(F.pmod("_hash", F.lit(1 << 30)) < share).groupBy("_lang", "_hash").agg(F.min("_piece").alias("_piece"))
    order = W.partitionBy("_lang").orderBy(F.pmod("_hash", F.lit(1 << 30)), "_hash")
    return drawn.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= each).select("_lang", "_piece")


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Field:
    """A field fitted on a bounded sample of ``docs`` with known language: ``sample_rows`` pieces of texts a language.

    Rows with a null language or text and blank texts teach nothing; repeated texts count once; texts of any length
    take part with all their pieces; an empty table gives a field without languages.
    """
    rows = sorted(training_pieces(docs, lang_col, text_col, sample_rows).collect(), key=lambda r: (zlib.crc32(r[1].encode()), r[0]))
    return Field([r[1] for r in rows], [r[0] for r in rows])


def identify(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, lang_pred, score (share of the words' probability).

    Texts without letters (null, empty) get ``und`` and 0; with a field that has learned one language, texts with
    letters get that; with none, ``und``. Texts of any length are judged whole: parts inform each other. Ties go to the language first in order. A null id stays null, repeated rows
    are judged each, an empty table gives none, other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def run(column: pa.Array) -> pa.Array:
        own = held.value
        rows: list[tuple[str, float]] = []
        for part in slices(column):
            texts = [t or "" for t in part.to_pylist()]
            rows += own.predict(texts) if own.langs else [(UNDETERMINED, 0.0)] * len(texts)
        return pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], ["lang_pred", "score"])

    return docs.select(F.col(id_col), run(F.col(text_col)).alias("_l")).select(id_col, "_l.*")


def label_words(field: Field, text: str) -> Iterator[tuple[str, str, float]]:
    """(word, language, probability) of each word with letters of a code-switched text."""
    p, _ = field.word_marginals([text])
    for word, row in zip([t for t in text.split() if any(map(str.isalpha, t))], p):
        yield word, field.langs[int(row.argmax())], float(row.max())
