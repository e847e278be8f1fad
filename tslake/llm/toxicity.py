"""Toxicity by classifier chains.

The categories (label columns, in order) are predicted one after another by linear models over words and their
beginnings; each later model also sees the earlier categories' probabilities. In training those are out-of-fold
predictions, so that a later model learns how far an earlier one can be trusted on texts it hasn't seen.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslake.llm.common import fresh, slices

#: Bound of the training sample: labelled rows for each combination of label values; their texts are taken whole.
SAMPLE_ROWS = 1500
#: Features that a model keeps: those most associated with its label, by a test statistic of at least LEAST_Z.
FEATURES, LEAST_Z, FOLDS, RIDGE = 400, 4.0, 3, 1.0
PREFIXES = (4, 5, 6)

_WORD = re.compile(r"[^\W\d_]+")
MEMO_WORDS = 200_000


def distinct_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def word_features(word: str) -> list[int]:
    """Hashes (32 bits) of a word and of its beginnings."""
    return [zlib.crc32(word.encode("utf-8", "replace")), *[zlib.crc32(b"^" + word[:n].encode("utf-8", "replace")) for n in PREFIXES if len(word) > n]]


def features(text: str) -> np.ndarray:
    return np.array([f for w in distinct_words(text) for f in set(word_features(w))], np.uint32)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 25) -> np.ndarray:
    """Ridge-regularised weights, the intercept last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-5:
            break
    return w


class Chain:
    """Models of categories in order: kept features, weights (of features, of earlier logits, intercept)."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray, n_features: int = FEATURES):
        self.models: list[tuple[dict[int, int], np.ndarray]] = []
        n = len(rows)
        own = [np.unique(r) for r in rows]
        every = np.concatenate(own) if n else np.zeros(0, np.uint32)
        names = np.unique(every)
        seen = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in own]), np.searchsorted(names, every).astype(np.int32)  # rows, features
        del own, every
        fold = np.arange(n) % FOLDS
        earlier = np.zeros((n, 0))
        for k in range(labels.shape[1]):
            y = labels[:, k]
            known = np.isfinite(y)
            if len(set(y[known].tolist())) < 2:  # nothing to learn
                constant = float(y[known].mean()) if known.any() else 0.0
                self.models.append(({}, np.append(np.zeros(k), _logit(np.array([constant]))[0])))
                earlier = np.column_stack([earlier, np.full(n, _logit(np.array([constant]))[0])])
                continue
            chosen = self._choose(seen, len(names), y, known, n_features)
            index = {int(names[f]): i for i, f in enumerate(chosen)}
            x, ordered, order = np.zeros((n, len(chosen))), np.sort(names[chosen]), np.argsort(names[chosen])
            for i, r in enumerate(rows if len(chosen) else []):
                at = np.minimum(np.searchsorted(ordered, r), len(ordered) - 1)
                np.add.at(x[i], order[at[ordered[at] == r]], 1)
            x = np.column_stack([x, earlier])
            out_of_fold = np.zeros(n)
            for f in range(FOLDS):
                inner = known & (fold != f)
                w = fit_logistic(x[inner], y[inner]) if len(set(y[inner].tolist())) > 1 else np.append(np.zeros(x.shape[1]), _logit(y[inner].mean(keepdims=True))[0] if inner.any() else 0)
                out_of_fold[fold == f] = np.clip(x[fold == f] @ w[:-1] + w[-1], -9, 9)
            self.models.append((index, fit_logistic(x[known], y[known])))
            earlier = np.column_stack([earlier, out_of_fold])

    @staticmethod
    def _choose(seen: np.ndarray, n_names: int, y: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
        ok = known[seen[0]]
        pos = np.bincount(seen[1][ok], weights=y[seen[0][ok]], minlength=n_names)
        df = np.bincount(seen[1][ok], minlength=n_names)
        rate, total = y[known].mean(), known.sum()
        spread = np.sqrt(np.maximum(df * rate * (1 - rate) * (1 - df / total), 1e-9))
        z = np.where(df >= 3, (pos - df * rate) / spread, 0)
        order = np.argsort(-np.abs(z), kind="stable")[:most]
        return order[np.abs(z[order]) >= LEAST_Z]

    def word_weights(self, word: str) -> tuple[float, ...]:
        """What a word adds to the score of each category."""
        ids = set(word_features(word))
        return tuple(float(sum(w[index[f]] for f in ids if f in index)) for index, w in self.models)

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        """Probabilities of all categories from the sums of word weights (texts x categories), along the chain."""
        logits = np.zeros_like(sums)
        for k, (index, w) in enumerate(self.models):
            logits[:, k] = np.clip(sums[:, k] + logits[:, :k] @ w[len(index) : len(index) + k] + w[-1], -9, 9)
        return 1 / (1 + np.exp(-logits))


_memos: dict[bytes, dict] = {}


def score_texts(chain: Chain, key: bytes, texts: list[str]) -> np.ndarray:
    memo = _memos.setdefault(key, {})
    if len(memo) > MEMO_WORDS:
        memo.clear()
    k = len(chain.models)
    none = (0.0,) * k
    sums, any_word = np.zeros((len(texts), k)), np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        words = distinct_words(text)
        if not words:
            continue
        any_word[i] = True
        for w in words.difference(memo):
            memo[w] = chain.word_weights(w)
        hits = [v for v in map(memo.__getitem__, words) if v != none]
        if hits:
            sums[i] = np.sum(hits, axis=0)
    return np.where(any_word[:, None], chain.probabilities(sums), 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], id_col: str, text_col: str, sample_rows: int) -> DataFrame:
    """Labels and features of a bounded sample, taken by a hash of the id; the bound holds for each value of a category."""
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(*[F.max(c).cast("double").alias(f"_y{k}") for k, c in enumerate(categories)])
    names = [f"_y{k}" for k in range(len(categories))]
    counts = marks.groupBy(*[(F.col(c) > 0).alias(c) for c in names]).count().limit(3 ** len(names)).collect()
    draw, keep = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1 << 30)), F.lit(False)
    for row in counts:
        same = F.lit(True)
        for c in names:
            same = same & (F.col(c) > 0).eqNullSafe(F.lit(row[c]))
        keep = keep | (same & (draw < int(min(1.0, sample_rows / row["count"]) * (1 << 30))))
    chosen = marks.filter(keep)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull())
    joined = texts.join(F.broadcast(chosen), "_id")  # at most sample_rows rows for each combination of values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t).tobytes() for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ["_id", *names]], pa.array(rows, pa.binary())], ["_id", *names, "_features"])

    kind = docs.schema[id_col].dataType.simpleString()
    bound = 2 * sample_rows * max(1, len(counts))  # an id may come with many rows
    rows = joined.mapInArrow(run, f"_id {kind}, {', '.join(f'{c} double' for c in names)}, _features binary")
    return rows.orderBy(F.xxhash64("_id", "_features")).limit(bound)


def train(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Chain:
    """A chain fitted on a bounded sample: some ``sample_rows`` for each combination of label values, twice that in all at most."""
    rows = sorted(training_rows(docs, labels, categories, id_col, text_col, sample_rows).collect(), key=lambda r: (zlib.crc32(str(r[0]).encode()), r[-1]))
    y = np.array([[np.nan if v is None else float(v > 0) for v in r[1:-1]] for r in rows]).reshape(len(rows), len(categories))
    return Chain([np.frombuffer(r[-1], np.uint32) for r in rows], y)


def probability_columns(chain: Chain, docs: DataFrame, categories: tuple[str, ...]) -> F.Column:
    """Function of a text column: a struct of one probability for each category."""
    import pickle

    held = docs.sparkSession.sparkContext.broadcast((chain, zlib.crc32(pickle.dumps(chain)).to_bytes(4, "little")))

    @F.arrow_udf("struct<" + ", ".join(f"p_{c}: double" for c in categories) + ">")
    def run(column: pa.Array) -> pa.Array:
        chain, key = held.value
        out = [score_texts(chain, key, [t or "" for t in part.to_pylist()]) for part in slices(column)]
        p = np.concatenate(out) if out else np.zeros((0, len(categories)))
        return pa.StructArray.from_arrays([pa.array(p[:, k], pa.float64()) for k in range(len(categories))], [f"p_{c}" for c in categories])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, a probability ``p_<category>`` for each category, and ``toxic`` (the last's is at least ``threshold``).

    Texts without words (null, empty) get probability 0. Labels that are null are left out of their category's
    training; repeated labels of an id count as their maximum; with labels of one value only, or none, the prediction
    is that share, or 0. Texts of any length are judged whole. A null id stays null, repeated rows are judged each, an empty table gives none, other columns
    are ignored.
    """
    run = probability_columns(train(docs, labels, categories, id_col, text_col, sample_rows), docs, categories)
    out = docs.select(F.col(id_col), run(F.col(text_col)).alias("_p")).select(id_col, "_p.*")
    return out.withColumn("toxic", F.col(f"p_{categories[-1]}") >= threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = ("quality", "toxic"), threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose last category reaches ``threshold``; all columns stay, whatever their names.

    Rows are judged as by ``toxicity``: null, empty and wordless texts have probability 0 and stay, long texts are
    judged whole, repeated rows stay or go together, ids aren't looked at; without labels, or on an empty table,
    nothing goes.
    """
    run = probability_columns(train(docs, labels, categories, id_col, text_col), docs, categories)
    name = fresh(docs, "toxicity")
    scored = docs.withColumn(name, run(F.col(text_col)))
    return scored.filter(F.col(f"{name}.p_{categories[-1]}") < threshold).select(docs.columns)
