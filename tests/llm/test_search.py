"""Ranked lexical search and exact top-k search against plain versions of their contracts."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_scan_operators import EDGE, table
from tslake.llm import lexical, topk
from tslake.llm.common import Best

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, top):
    own = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item in {i for i, _ in items}:
        asked, scores = {t for i, text in items if i == item for t in terms(text)}, []
        for i, c in own:
            n = sum(c.values())
            m = 100 - 50 + (50 * n * n_docs) // max(n_terms, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if c[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    more = [(5000 + k, "Alpha beta beta") for k in range(90)] + [(6000, "alpha " * 5000 + "BETA"), (6001, "Ünder_score x2y\x85z ALPHA-beta"), (6002, "alphabet betas"), (6003, "äÄ ÄÄ")]
    return [(r[0], r[1]) for r in rows] + EDGE + more


ITEMS = [
    (1, "alpha BETA beta"), (2, ""), (3, None), (4, "???"), (5, "no_such_term_at_all zzzqqq"), (None, "words alpha"), (6, "Ünder äÄ ÄÄ x2y\x85z"), (7, "plain"), (7, "words here plain"), (8, "a b c d x é ü"),
]


@pytest.mark.parametrize("lot_bytes", [lexical.LOT_BYTES, 120, 40])
def test_search(spark, documents, lot_bytes):
    """One lot, several lots, and items whose terms lie in several lots."""
    bench = [(100 + r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(5).collect()] if lot_bytes > 1000 else []
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS + bench], "item_id long, text string, rank int")
    got = lexical.search(table(spark, documents), items, top=20, lot_bytes=lot_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain_search(documents, ITEMS + bench, 20)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(w[0] == 1 for w in want) == 20


def test_search_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(table(spark, []), items).count() == 0
    assert lexical.search(table(spark, [(1, None), (2, " ?")]), items).count() == 0
    assert lexical.search(table(spark, EDGE), items.limit(0)).count() == 0


def test_best_are_kept_in_parts(monkeypatch):
    monkeypatch.setattr(Best, "GATHERED", 50)
    rng = np.random.default_rng(1)
    scores, best = rng.integers(0, 9, (400, 3)), Best(7, np.ones(3, np.int64))
    ids = rng.permutation(400)
    for lo in range(0, 400, 13):
        best.add(scores[lo : lo + 13], pa.array(ids[lo : lo + 13]))
    t = pa.Table.from_batches(best.batches()).to_pylist()
    for item in range(3):
        want = sorted((-s, i) for s, i in zip(scores[:, item].tolist(), ids.tolist()) if s > 0)[:7]
        assert [(-r["score"], r["id"]) for r in t if r["item"] == item] == want


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "alpha"), ("a", "alpha"), (None, "alpha"), ("c", "beta")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "alpha")], "item_id string, text string")
    assert [tuple(r)[1:3] for r in lexical.search(docs, items).orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]


def plain_top(rows, is_query, top, scale=1024):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for i in {i for i, _ in good if is_query(i)}:
        asked = {tuple(v) for j, v in good if j == i}
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for q in asked for j, v in good if j != i and len(v) == len(q))
        out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores[:top])]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, _v string").repartition(5)


def edge_vectors():
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(900, 16)) * 0.25)]
    rows += [(1000 + k, rows[100][1]) for k in range(700)]  # one vector in a great part of the rows
    rows += [(2000 + k, [0.5 + (k % 3) / 1024] + [0.0] * 15) for k in range(300)]  # few different scores
    rows += [(3000, None), (3100, [float("nan")] * 16), (3200, [None] + [1.0] * 15), (3300, [float("inf")] + [0.0] * 15), (None, rows[0][1]), (3400, [0.0] * 16)]
    rows += [(3500, [1.0, 2.0]), (3501, [2.0, 2.0]), (3502, [-1.0, 0.0]), (3600, []), (3601, []), (100, rows[7][1]), (200, rows[200][1])]
    return rows


@pytest.mark.parametrize("lot_bytes,spare", [(topk.LOT_BYTES, 4), (6000, 0)])
def test_top_k(spark, monkeypatch, lot_bytes, spare):
    monkeypatch.setattr(topk, "SPARE", spare)
    rows = edge_vectors()
    frame = vectors(spark, rows)
    got = topk.top_k(frame, F.col("vec_id") % 100 == 0, top=10, lot_bytes=lot_bytes)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_top(rows, lambda i: i % 100 == 0, 10)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(frame, F.lit(False)).count() == 0


def test_large_components(spark):
    """Products beyond 53 bits are made in integers; vectors whose products may leave 64 bits take no part."""
    rng = np.random.default_rng(3)
    rows = [(i, (v * 2.0**19).tolist()) for i, v in enumerate(rng.uniform(-1, 1, size=(60, 4)))] + [(100, [1e300, 0.0, 0.0, 0.0]), (101, [2.0**22, 0.0, 0.0, 0.0])]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, top=5)
    assert sorted(map(tuple, got.collect())) == plain_top(rows[:60], lambda i: i % 10 == 0, 5)


def test_text_keys(spark):
    rows = [("q", [1.0, 0.0]), ("b", [0.5, 0.0]), ("a", [0.5, 1.0]), ("c", [-3.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id string, embedding array<double>"), F.col("vec_id") == "q", top=2)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [("q", 1, "a", 524288), ("q", 2, "b", 524288)]


def test_counts_of_tasks_meet_in_the_bucket_of_the_kth():
    rng = np.random.default_rng(4)
    rows = rng.integers(-50, 50, (400, 3))
    lot = topk.Lot([(0, "q", [1, 2, -1], 6)], 3, int((rows**2).sum(axis=1).max()))
    scores = lot.scores(list(range(400)), rows, np.array([0]))[:, 0]
    assert (scores == rows @ np.array([1, 2, -1])).all()
    assert scores.min() >= lot.least[0] and scores.max() < lot.least[0] + lot.width[0] * topk.BUCKETS
    assert lot.scores(["q"], rows[:1], np.array([0]))[0, 0] == np.iinfo(np.int64).min
