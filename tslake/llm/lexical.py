"""Ranked lexical search by scanning documents: no index of documents is built.

The terms of all items, each guarded by a boundary on either side, make an Aho-Corasick automaton. A text whose
characters outside terms have become blanks is run through it, so that every match is a whole term; the matches of a
document, counted, are its term frequencies. A first scan adds up what the weights need, a second one scores. Each
task keeps the best documents of an item among its own, as no other can be among the best of all.

Items are dealt into lots whose terms have a bounded size; a lot's automaton is broadcast, and documents are scanned
for one lot after another. Terms of an item that is larger than a lot are dealt too, and its documents' partial scores
are added up.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tslake.llm.common import Best, checkpointed, slices, utf8
from tslake.llm.words import ALPHANUMERIC, LOWER, words

#: Bytes of the terms of a lot, each with eight more.
LOT_BYTES = 1 << 20
#: Cells of documents x items that are scored at once.
CELLS = 1 << 21
#: An item's rows from all tasks are ranked in so many parts first.
SALTS = 32
#: Parts of the score, in thousandths and hundredths.
K1, K3, B, SCALE, UNIT = 20, 1000, 50, 1_000_000_000, 100

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of terms in lower case, all others as a blank.
_PLAIN = np.where(ALPHANUMERIC, LOWER, 32).astype(np.uint8)
_built: dict[str, object] = {}


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_item, _term): the distinct terms of each item; texts of one id are one item."""
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.explode(F.regexp_extract_all(low, F.lit(_TERM), F.lit(0)))
    return items.select(F.col(id_col).alias("_item"), terms.alias("_term")).distinct()


class Lot:
    """Items of a lot, and their terms: ``terms[k]`` belongs to the items ``of[starts[k]:starts[k + 1]]``."""

    def __init__(self, rows: list):
        self.name = uuid.uuid4().hex
        self.items = list(dict.fromkeys(r["_item"] for r in rows))
        number = {x: i for i, x in enumerate(self.items)}
        of: dict[str, list[int]] = {}
        for r in rows:
            of.setdefault(r["_term"], []).append(number[r["_item"]])
        self.terms = list(of)
        self.starts = np.cumsum([0, *map(len, of.values())])
        self.of = np.array([i for own in of.values() for i in own], np.int64)

    def automaton(self):
        """Built once by each worker."""
        if self.name not in _built:
            import ahocorasick

            _built.clear()
            a = ahocorasick.Automaton()
            for k, term in enumerate(self.terms):
                a.add_word(f" {term} ".encode().decode("latin-1"), k)  # a byte is a character
            a.make_automaton()
            _built[self.name] = a
        return _built[self.name]


def counted(column: pa.Array, automaton) -> tuple[np.ndarray, list[Counter]]:
    """For each text of an Arrow column its number of terms, and how often each term of the automaton occurs in it."""
    data, off, null = utf8(column)
    _, _, n, _ = words(data, off, ALPHANUMERIC, lanes=0)
    n = np.where(null, 0, n)
    low, base = _PLAIN[data[off[0] : off[-1]]].tobytes().decode("latin-1"), int(off[0])
    number = itemgetter(1)
    found = [Counter(map(number, automaton.iter(f" {low[a - base : b - base]} "))) if size else Counter() for a, b, size in zip(off.tolist(), off[1:].tolist(), n.tolist())]
    return n, found


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _statistics(docs: DataFrame, held) -> tuple[int, int, np.ndarray]:
    """Documents that have a term, terms of all documents, and documents that have each of a lot's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot = held.value
        automaton, size = lot.automaton(), len(lot.terms)
        out = np.zeros(size + 2, np.int64)
        for b in batches:
            for part in slices(b.column("_text")):
                n, found = counted(part, automaton)
                for own in found:
                    out[list(own)] += 1
                out[size:] += [int((n > 0).sum()), int(n.sum())]
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], ["_k", "_n"])

    sums = docs.select("_text").mapInArrow(run, "_k bigint, _n bigint").groupBy("_k").agg(F.sum("_n").alias("_n")).collect()  # as many rows as a lot has terms
    out = np.zeros(len(held.value.terms) + 2, np.int64)
    for r in sums:
        out[r["_k"]] = r["_n"]
    return int(out[-2]), int(out[-1]), out[:-2]


def _scores(docs: DataFrame, held, n_docs: int, n_terms: int, w: np.ndarray, top: int | None) -> DataFrame:
    """(_k, _doc, _hash, _score): number of an item, a document, its score by the lot's terms.

    Of each task the best ``top`` of an item; where that is None all, with a hash of their texts.
    """
    id_type = docs.schema["_doc"].dataType.simpleString()

    def scored(lot: Lot, n: np.ndarray, found: list[Counter]) -> np.ndarray:
        sizes, items, each = [len(x) for x in found], len(lot.items), np.diff(lot.starts)
        doc = np.repeat(np.arange(len(found)), sizes)
        k = np.fromiter((t for x in found for t in x), np.int64, len(doc))
        tf = np.fromiter((c for x in found for c in x.values()), np.int64, len(doc))
        m = np.array([UNIT - B + (B * size * n_docs) // n_terms for size in n.tolist()], np.int64)
        part = w[k] * ((SCALE * tf) // (K3 * tf + K1 * m[doc]))
        again = each[k]
        at = np.repeat(lot.starts[k] - (np.cumsum(again) - again), again) + np.arange(int(again.sum()))
        # Sums stay below 2**53: a weight is below 2**16, a part below 2**20, and a lot has less than 2**17 terms.
        return np.bincount(np.repeat(doc, again) * items + lot.of[at], np.repeat(part, again), len(found) * items).astype(np.int64).reshape(len(found), items)

    def pieces(batches: Iterator[pa.RecordBatch], lot: Lot) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray]]:
        """(ids, texts, documents x items scores) of a few documents at a time."""
        automaton, most = lot.automaton(), max(1, CELLS // len(lot.items))
        for b in batches:
            at = 0
            for part in slices(b.column("_text")):
                n, found = counted(part, automaton)
                for lo in range(0, len(part), most):
                    own = slice(lo, lo + most)
                    yield b.column("_doc").slice(at + lo, len(n[own])), part.slice(lo, len(n[own])), scored(lot, n[own], found[own])
                at += len(part)

    def batch(item: pa.Array, ids: pa.Array, digests: list[bytes | None], score: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([item, ids, pa.array(digests, pa.binary()), score], ["_k", "_doc", "_hash", "_score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot = held.value
        best = Best(top or 0, np.ones(len(lot.items), np.int64))
        for ids, texts, scores in pieces(batches, lot):
            if top:
                best.add(scores, ids)
            else:
                doc, item = np.nonzero(scores)
                digest = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in texts.to_pylist()]
                yield batch(pa.array(item), ids.take(pa.array(doc)), [digest[i] for i in doc.tolist()], pa.array(scores[doc, item]))
        for b in best.batches():
            yield batch(b.column("item"), b.column("id"), [None] * len(b), b.column("score"))

    return docs.mapInArrow(run, f"_k bigint, _doc {id_type}, _hash binary, _score bigint")


def search(
    docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", lot_bytes: int = LOT_BYTES
) -> DataFrame:
    """The ``top`` documents of each item with the highest score above 0: item_col, rank (from 1), id_col, score.

    Terms are the maximal runs of letters and digits (all of a text's characters beyond ASCII count as such), A-Z in
    lower case. A term's weight falls with the documents that hold it, its part with its rate in a long document; a score
    is the sum over the item's distinct terms. Equal scores are ranked by id, null ids last. Null and empty texts have
    no terms and aren't counted; repeated rows are documents of their own; items of one id are one, with the terms of all
    their texts, and items without terms give nothing. Texts of any length are scanned whole, twice for each lot of
    items. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    item_type, id_type = (t.dataType.simpleString() for t in (items.schema[item_col], docs.schema[id_col]))
    plain = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    pairs = item_terms(items, item_col, item_text_col)
    size = F.octet_length("_term") + 8
    sizes = pairs.groupBy(F.col("_item").alias("_of")).agg(F.sum(size).alias("_all"))
    large = F.col("_all") > lot_bytes
    some, rest = (int(x or 0) for x in sizes.agg(F.sum(F.when(~large, F.col("_all"))), F.sum(F.when(large, F.col("_all")))).first())
    # Half of the bound on average, as a hash deals the items, or the terms of larger ones, into lots.
    whole, parts = -(-2 * some // lot_bytes), -(-2 * rest // lot_bytes)
    own = F.when(large, whole + F.pmod(F.xxhash64("_term"), F.lit(max(parts, 1)))).otherwise(F.pmod(F.xxhash64("_item"), F.lit(max(whole, 1))))
    dealt = pairs.join(sizes, F.col("_item").eqNullSafe(F.col("_of"))).select("_item", "_term", own.alias("_lot"))
    dealt = checkpointed(dealt) if whole + parts > 1 else dealt
    found = {False: [spark.createDataFrame([], f"_item {item_type}, _doc {id_type}, _hash binary, _score bigint, _lot int")], True: []}
    for k in range(whole + parts):
        lot = Lot(dealt.filter(F.col("_lot") == k).select("_item", "_term").collect())
        if lot.items:
            held = spark.sparkContext.broadcast(lot)
            n_docs, n_terms, df = _statistics(plain, held)
            names = spark.createDataFrame(list(enumerate(lot.items)), f"_k bigint, _item {item_type}")
            scored = _scores(plain, held, n_docs, max(n_terms, 1), weights(df, n_docs), top if k < whole else None)
            found[k >= whole].append(scored.join(F.broadcast(names), "_k").select("_item", "_doc", "_hash", "_score", F.lit(k).alias("_lot")))
    ranked = reduce(DataFrame.unionByName, found[False]).select("_item", "_doc", "_score")
    if found[True]:
        # Rows of one id and text are told by their number: each lot has one of every copy.
        row = reduce(DataFrame.unionByName, found[True]).groupBy("_item", "_doc", "_hash").agg(F.sum("_score").alias("_sum"), F.count("*").alias("_n"), F.countDistinct("_lot").alias("_lots"))
        copies = (F.col("_n") / F.col("_lots")).cast("long")
        row = row.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(copies, F.lit(top).cast("long")))))
        ranked = ranked.unionByName(row.select("_item", "_doc", (F.col("_sum") / copies).cast("long").alias("_score")))
    order = [F.desc("_score"), F.col("_doc").asc_nulls_last()]
    salted = W.partitionBy("_item", F.pmod(F.xxhash64("_doc"), F.lit(SALTS))).orderBy(*order)
    for w in (salted, W.partitionBy("_item").orderBy(*order)):
        ranked = ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return ranked.select(F.col("_item").alias(item_col), "rank", F.col("_doc").alias(id_col), F.col("_score").alias("score"))
