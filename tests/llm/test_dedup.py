"""Substring dedup on bytes and on words against brute force, and the parts that they are made of."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.test_scan_operators import EDGE, table
from tslake.llm import byte_dedup, suffix, word_dedup
from tslake.llm import words as W
from tslake.llm.blocks import Blocks, folded_rows


def sha(b):
    return hashlib.sha256(b).hexdigest()


def plain_words(docs, n):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    count = Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for (i, _), w in zip(docs, split):
        gone = set()
        for k in range(len(w) - n + 1):
            if count[tuple(w[k : k + n])] > 1:
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return sorted(out, key=repr)


def plain_bytes(docs, n):
    raw = [(t or "").encode() for _, t in docs]
    count = Counter(b[i : i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for (i, _), b in zip(docs, raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - n + 1):
            if count[b[k : k + n]] > 1:
                gone[k : k + n] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    docs = [(r[0], r[1]) for r in rows] + [e for e in EDGE if e[0] not in (7, 8)]
    words = docs[5][1].split()
    docs += [(900, " ".join(words)), (901, docs[3][1] * 2), (902, "x " + docs[7][1][10:] + " y"), (903, "ab " * 400), (904, "q" * 500)]
    return docs


@pytest.mark.parametrize("window,sizes", [(35, {}), (35, {"block_bytes": 20000, "bucket_bytes": 50000}), (8, {"block_bytes": 50000})])
def test_words(spark, documents, window, sizes):
    got = word_dedup.remove_repeats(table(spark, documents).withColumnRenamed("_p0", "_block"), window, texts=False, **sizes).collect()
    assert sorted(map(tuple, got), key=repr) == plain_words(documents, window)


def test_rows_that_repeat_are_folded(spark):
    """A row that makes up a third of the table reaches its block twice for each batch, and comes out as often as it went in."""
    words = " ".join(f"w{k}" for k in range(40))
    docs = [(1, words)] * 3000 + [(None, words + " z")] * 500 + [(k, f"{words} {k}" if k % 100 == 0 else f"own {k}") for k in range(2, 5000)] + [(6000, None)] * 50
    docs += [(6001, "once " * 3)]
    for operator, plain, n in ((word_dedup, plain_words, 35), (byte_dedup, plain_bytes, 100)):
        out = operator.remove_repeats(table(spark, docs), n, texts=False)
        assert sorted(map(tuple, out.collect()), key=repr) == plain(docs, n)
    folded = Blocks(table(spark, docs).coalesce(1), "doc_id", "text").docs
    kept = folded.groupBy("_id.id", "_text").agg(F.count("*").alias("rows"), F.sum("_id.n").alias("copies")).filter("copies > 1").collect()
    assert {(r["id"], r["copies"]) for r in kept} == {(1, 3000), (None, 500), (6000, 50)} and all(r["rows"] <= 2 * (1 + r["copies"] // 1000) for r in kept)


def test_rows_of_one_hash_are_compared():
    rows = [(1, "a", 7), (2, "a", 7), (1, "b", 7), (1, "a", 7), (1, "a", 7), (3, "c", 9), (None, "a", 8), (None, "a", 8)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows]) for k in range(3)], ["_id", "_text", "_same"])
    (out,) = folded_rows(iter([batch]))
    got = Counter((r["_id"], r["_text"], r["_copies"]) for r in out.to_pylist())
    assert got == Counter([(1, "a", 1), (1, "a", 2), (2, "a", 1), (1, "b", 1), (3, "c", 1), (None, "a", 1), (None, "a", 1)])
    (out,) = folded_rows(iter([batch.slice(0, 0)]))
    assert len(out) == 0


def test_words_keeps_text(spark):
    docs = [(1, "a b c d e f"), (2, "x b c d y"), (3, None), (3, None)]
    got = {r["doc_id"]: r["kept_text"] for r in word_dedup.remove_repeats(table(spark, docs), 3).collect()}
    assert got == {1: "a e f", 2: "x y", 3: ""}
    assert word_dedup.remove_repeats(table(spark, [])).count() == 0


@pytest.mark.parametrize("length,gram,sizes", [(200, 48, {}), (200, 48, {"block_bytes": 20000, "bucket_bytes": 50000, "memory": 4096}), (20, 6, {"block_bytes": 50000})])
def test_bytes(spark, documents, length, gram, sizes):
    some = documents if length == 200 else documents[:60] + documents[-15:]
    got = byte_dedup.remove_repeats(table(spark, some).withColumnRenamed("_p0", "_block"), length, gram, texts=False, **sizes).collect()
    assert sorted(map(tuple, got), key=repr) == plain_bytes(some, length)


def test_bytes_empty(spark):
    assert byte_dedup.remove_repeats(table(spark, [])).count() == 0
    got = byte_dedup.remove_repeats(table(spark, [(1, "é" * 150), (2, "é" * 150 + "z")])).collect()
    assert {r["doc_id"]: bytes(r["kept_bytes"]) for r in got} == {1: b"", 2: b"z"}


def test_pieces_of_long_texts_after_empty_ones():
    import pyarrow as pa

    sizes = [0, 0, 600_000, 10, 0, 3 << 20, 0, 0, 270_000, 0, 100_000]
    rng = np.random.default_rng(4)
    raw = [rng.integers(97, 123, n).astype(np.uint8).tobytes() for n in sizes]
    seen = [np.zeros(max(0, n - 199), int) for n in sizes]
    for texts in (raw, [r for r in raw if r]):  # a text's pieces don't depend on what comes before it
        where = [i for i, r in enumerate(raw) if r or len(texts) == len(raw)]
        cut = {}
        for x, off, first, begin in byte_dedup.pieces(pa.array([t.decode() for t in texts]), 200):
            assert len(x) <= 2 * byte_dedup.PIECE and (begin == 0 or len(off) == 2)
            for i, (a, b) in enumerate(zip(off.tolist(), off[1:].tolist())):
                n = where[first + i]
                assert x[a:b].tobytes() == raw[n][begin : begin + b - a]
                seen[n][begin : begin + max(0, b - a - 199)] += 1
                if b - a > byte_dedup.PIECE or begin:
                    assert len(off) == 2
                    cut.setdefault(n, []).append((begin, b - a))
        assert len(cut[2]) == 3 and len(cut[5]) == 12 and cut[8] == [(0, 270_000)]
    assert all((s == 2).all() for s in seen)


def test_long_text_after_an_empty_one(spark):
    """A passage near the end of a text of 3 MiB, and again near its begin; empty texts are in every block."""
    rng = np.random.default_rng(6)
    x = rng.integers(97, 123, 3 << 20).astype(np.uint8)
    x[-5000:-4000] = x[1000:2000]
    docs = [*[(k, "" if k % 2 else None) for k in range(100, 400)], (3, x.tobytes().decode()), (4, x[-4500:-4100].tobytes().decode())]
    one = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in byte_dedup.remove_repeats(one).collect()}
    assert got[3]["n_removed"] == 2000 and got[3]["n_spans"] == 2 and got[4]["n_removed"] == 400
    kept = np.concatenate([x[:1000], x[2000:-5000], x[-4000:]]).tobytes()
    assert got[3]["kept_sha256"] == sha(kept)


def test_memory_of_periodic_texts():
    import tracemalloc

    import pyarrow as pa

    raw = b"q" * (2 << 20) + b"ab" * (1 << 20)
    texts = pa.array([raw.decode()])
    tracemalloc.start()
    known, many = byte_dedup.distinct(byte_dedup.mark_hashes(texts, 200, 48))
    ordered, again, seen = byte_dedup.folded(texts, 200, 48, known[many, 0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * len(raw)  # about 290 where each beginning holds its bytes
    assert len(ordered) < 1000 and again.sum() >= 3 and seen[3].sum() >= len(raw) - 400
    for k, _, begin, count in seen[:, ::9973].T.tolist():
        assert ordered[k][1] == raw[begin : begin + count + 199]


def test_periodic_texts(spark):
    docs = [(1, "q" * 600_000), (2, "abc" * 200_000 + "z"), (3, "the end"), (4, "q" * 700 + "x" + "abc" * 100)]
    got = byte_dedup.remove_repeats(table(spark, docs), texts=False).collect()
    assert sorted(map(tuple, got), key=repr) == plain_bytes(docs, 200)


def plain_order(t):
    order = sorted(range(len(t)), key=lambda i: t[i:].tolist())
    common = [0]
    for a, b in zip(order, order[1:]):
        k = 0
        while max(a, b) + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        common.append(k)
    return order, common


def test_suffix_array_small():
    rng = np.random.default_rng(1)
    for trial in range(400):
        t = np.append(rng.integers(1, int(rng.integers(2, 6)), int(rng.integers(1, 90))), 0).astype(np.int32)
        if trial % 5 == 0:
            t = np.append(np.tile(t[:-1], 3), 0).astype(np.int32)
        disk = suffix.Disk(64 if trial % 2 else 1 << 20)
        if trial % 3 == 0:
            disk.block = 4
        order, common = suffix.suffix_array(t, 1000, disk)
        want, alike = plain_order(t)
        assert order.tolist() == want and common.tolist() == alike
        depth = int(rng.integers(1, 20))
        order, common = suffix.suffix_array(t, depth, disk)
        begins = [tuple(t[i : i + depth]) for i in order]
        assert begins == sorted(begins) and sorted(order.tolist()) == sorted(want)
        assert common.tolist() == [min(depth, k) for k in alike]


def test_shard_larger_than_memory():
    """Queues, text, names and orders of a shard of 300 KB with a bound of 4 KB: all lie in files."""
    rng = np.random.default_rng(8)
    words = [bytes(rng.integers(97, 123, int(rng.integers(2, 9))).astype(np.uint8)) for _ in range(400)]
    raw = b" ".join(words[i] for i in (rng.random(50_000) ** 3 * 400).astype(int))
    raw = raw[:200_000] + raw[5000:9000] + b"x" * 4000 + raw[150_000:180_000] + b"xy" * 3000 + raw[200_000:260_000]
    disk = suffix.Disk(4096)
    (got,) = byte_dedup.repeated_beginnings([raw], np.array([False]), 200, disk=disk)
    assert disk.spilled > 40 * len(raw)
    count = Counter(raw[i : i + 200] for i in range(len(raw) - 199))
    assert got.tolist() == [count[raw[i : i + 200]] > 1 for i in range(len(raw) - 199)]


def test_regular_strings_that_hashes_confuse():
    """Two strings whose difference is divisible by every odd base's powers; sums of powers modulo 2**64 are equal."""
    d = np.array([1], np.int64)
    for a in (1, 2, 2, 4, 4, 8, 8, 8, 16, 16, 32, 32, 64):
        step = np.zeros(a + 1, np.int64)
        step[0], step[-1] = -1, 1
        d = np.convolve(d, step)
    base = np.full(200, 80)
    one, other = base.copy(), base.copy()
    one[: len(d)] += np.maximum(d, 0)
    other[: len(d)] += np.maximum(-d, 0)
    assert max(one.max(), other.max()) < 128
    raws = [x.astype(np.uint8).tobytes() for x in (one, other)]
    x = 0x9E3779B97F4A7C15
    sums = [sum(int(c) * pow(x, i, 2**64) for i, c in enumerate(r)) % 2**64 for r in raws]
    assert sums[0] == sums[1] and raws[0] != raws[1]
    assert [b.tolist() for b in byte_dedup.repeated_beginnings(raws, np.zeros(2, bool), 200)] == [[False], [False]]
    again = byte_dedup.repeated_beginnings([raws[0] + b"1", raws[1] + b"2", raws[0] + b"3"], np.zeros(3, bool), 200)
    assert [b.tolist() for b in again] == [[True, False], [False, False], [True, False]]


def test_covers():
    for period, places in word_dedup.COVERS.items():
        assert {(a - b) % period for a in places for b in places} == set(range(period))


def test_marks_are_left_most_minima():
    rng = np.random.default_rng(2)
    for alphabet in (2, 4, 200):
        x = rng.integers(0, alphabet, 700).astype(np.uint8)
        h = byte_dedup.rolling(x, 5) >> np.uint64(20)
        low, place = byte_dedup.marks(x, 30, 5)
        for i in range(len(low)):
            assert low[i] >> np.uint64(20) == h[i : i + 26].min() and place[i] == i + int(np.argmin(h[i : i + 26]))


def test_runs_of_words():
    text = "aa b aa b aa, c é\taa b"
    x = np.frombuffer(text.encode(), np.uint8)
    starts, ends, counts, h = W.words(x, np.array([0, 12, len(x)]), W.BLANK_SEPARATED)
    assert [bytes(x[a:b]).decode() for a, b in zip(starts, ends)] == ["aa", "b", "aa", "b", "aa", ",", "c", "é", "aa", "b"] and counts.tolist() == [5, 5]
    two = W.runs(h[0], 2)
    assert two[0] == two[2] == two[8] and len(set(two.tolist())) == 6
    assert W.inside(counts, 2).tolist() == [True] * 4 + [False] + [True] * 4

