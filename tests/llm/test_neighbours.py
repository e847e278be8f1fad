"""The Jaccard join and the inner-product search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_scan_operators import EDGE, table
from tslake.llm import ann, components, forest


def shingles(text):
    w = [x for x in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_near(docs):
    ids = sorted({i for i, _ in docs if i is not None})
    text_of = dict(docs)
    sets = {i: shingles(text_of[i]) for i in ids}
    words = {i: tuple((text_of[i] or "").split()) for i in ids}
    label = {i: i for i in ids}
    links = {i: set() for i in ids}
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                    if words[a] != words[b]:
                        links[a].add(words[b])
                        links[b].add(words[a])
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = {k: new if v == old else v for k, v in label.items()}
    return {i: (label[i], len(links[i]), sum(words[i] == words[j] for j in ids) if sets[i] else 1) for i in ids}


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = [(r[0], r[1]) for r in rows]
    base = docs[5][1].split()
    for k in range(30):  # a chain of near copies, and copies of one of them
        base = [*base[:k], f"new{k}", *base[k + 1 :]]
        docs.append((1000 + k, " ".join(base)))
        docs.append((2000 + k, " ".join(base) if k % 7 == 0 else f"{' '.join(base)}  tail{k}"))
    docs += [(3000, "one two"), (3001, "one  two"), (3002, "one"), (3003, " "), (3004, None), (3005, ""), (3006, "a b c d e"), (3007, "a b c d e f")]
    return docs


@pytest.mark.parametrize("chunk", [512, 7])
def test_near_duplicates(spark, documents, chunk):
    got = forest.near_duplicates(table(spark, documents), chunk=chunk).collect()
    want = plain_near(documents)
    assert len(got) == len(documents)
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in got} == want
    assert max(v[1] for v in want.values()) > 10


def test_long_near_copies_are_cut_by_bytes(spark):
    """Forty near copies of a text of 200 KB, a task holding about a fortieth of the group's pairs of bytes."""
    base = [f"word{k * 7919 % 30011}" for k in range(22_000)]
    docs = [(i, " ".join([*base[: 500 * i], f"other{i}", *base[500 * i + 1 :]])) for i in range(40)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in forest.near_duplicates(table(spark, docs), chunk_bytes=1 << 20).collect()}
    assert got == {i: (0, 39, 1) for i in range(40)}


def test_chunks_are_bounded_by_bytes(spark):
    rows = [(g, i, n, size) for g, n, size in [(1, 400, 10_000), (2, 400, 10), (3, 2, 10**7), (4, 30, 100)] for i in range(n)]
    placed = spark.createDataFrame(rows, "group long, node long, size long, bytes long").withColumn("own", F.col("bytes"))
    out = forest.in_chunks(placed, 100, 100_000)
    tasks = out.groupBy("group", "first", "second").agg(F.sum("own").alias("bytes"), F.count("*").alias("n")).collect()
    assert max(r["bytes"] for r in tasks if r["group"] == 1) < 3 * 2 * 100_000
    assert {r["group"]: 0 for r in tasks} == dict.fromkeys([1, 2, 3, 4], 0)
    assert [r["n"] for r in tasks if r["group"] == 4] == [30]
    met = out.alias("a").join(out.alias("b"), ["group", "first", "second"]).filter("a.node < b.node").select("group", "a.node", "b.node").distinct()
    assert {r["group"]: r["count"] for r in met.groupBy("group").count().collect()} == {1: 79_800, 2: 79_800, 3: 1, 4: 435}  # each pair meets


def test_a_row_that_repeats_is_read_once_a_batch(spark):
    base = " ".join(f"w{k}" for k in range(60))
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(base).alias("text")).unionByName(spark.createDataFrame([(8, base + " more"), (9, "quite another text")], "doc_id long, text string"))
    got = {tuple(r) for r in forest.near_duplicates(docs).collect()}
    assert got == {(7, 7, 1, 20_000), (8, 7, 1, 1), (9, 9, 0, 1)}


def test_near_duplicates_edges(spark):
    got = forest.near_duplicates(table(spark, EDGE)).collect()
    assert len(got) == len(EDGE)
    by = {r["doc_id"]: r for r in got}
    assert by[4]["n_copies"] == 2 and by[1]["class_id"] == 1 and by[None]["class_id"] is None
    assert forest.near_duplicates(table(spark, [])).count() == 0


def test_keep_one(spark, documents):
    docs = table(spark, documents)
    kept = forest.keep_one(docs)
    assert kept.columns == docs.columns
    want = {i for i, (label, _, _) in plain_near(documents).items() if label == i}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert forest.keep_one(table(spark, EDGE)).count() == len(EDGE) - 1


def test_keep_one_judges_rows(spark):
    """An id that comes with several texts."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    docs = [(1, a), (2, a + " more"), (2, b), (3, c), (3, c + " more"), (4, "one two"), (4, "one  two"), (5, b + " more"), (6, None), (6, ""), (None, a), (None, c)]
    kept = [tuple(r) for r in forest.keep_one(table(spark, docs).select("doc_id", "text")).collect()]
    assert (1, a) in kept and (2, b) in kept
    assert not {(2, a + " more"), (5, b + " more")} & set(kept)
    assert len({(3, c), (3, c + " more")} & set(kept)) == 1
    assert len({(4, "one two"), (4, "one  two")} & set(kept)) == 1
    assert sorted(map(repr, kept[:])) == sorted(map(repr, set(kept))) and len(kept) == 8


def test_depth_reaches_the_recall():
    k = forest.depth(0.8)
    assert 1 - (1 - 0.8**k) ** forest.TRIES >= forest.RECALL > 1 - (1 - 0.8 ** (k + 1)) ** forest.TRIES


def test_overlaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, n)).astype(np.uint64) for n in rng.integers(0, 200, 90)] + [np.arange(300, dtype=np.uint64)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = forest.overlaps(sets)
    np.fill_diagonal(got, 0)
    want = np.array(want)
    np.fill_diagonal(want, 0)
    assert (got == want).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7), (200, 200), (None, 3)]
    got = dict(map(tuple, components.connected(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert {got[i] for i in range(41)} == {0} and got[102] == 100 and got[200] == 200 and len(got) == 45


def plain_nearest(rows, top):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in good:
        if i % 20 == 0:
            s = sorted((-float(v @ q), j) for j, v in good if j != i and len(v) == len(q))
            out[i] = s[:top]
    return out


def test_recall(spark):
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows += [(9000 + k, rows[20][1]) for k in range(60)]  # many equal vectors
    rows += [(9100, None), (9120, [0.0] * 64), (9140, [float("nan")] + [1.0] * 63), (9160, [None] + [1.0] * 63), (9180, [1.0, 2.0, 3.0]), (9181, [2.0, 2.0, 2.0]), (None, rows[0][1])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, _dim int")
    import pyspark.sql.functions as F

    got = ann.nearest(frame, F.col("vec_id") % 20 == 0, reranked=128).collect()
    want = plain_nearest(rows, 20)
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(by) == set(want)
    hits = 0
    for q, own in by.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(want[q]) + 1))
        hits += len({v for _, v, _ in own} & {j for _, j in want[q]})
    assert hits / sum(map(len, want.values())) > 0.95
    assert [v for _, v, _ in by[9020]] == [j for _, j in want[9020]]
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("noise", [0.05, 0.2, 0.5])
def test_close_vectors_are_all_ranked(spark, noise):
    """A third of all rows close to one vector but not equal, which share their codes; at the production value."""
    import pyspark.sql.functions as F

    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    near = np.arange(3000) % 3 == 0
    x[near] = rng.normal(size=64) + noise * x[near]
    x /= np.sqrt((x**2).sum(axis=1, keepdims=True))
    got = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), F.col("vec_id") % 60 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(by) == 50
    for q, own in by.items():
        score = x @ x[q]
        score[q] = -np.inf
        assert own == np.argsort(-score, kind="stable")[:20].tolist()
