"""Packing: an exact round trip, and little padding."""

import zlib
from collections import defaultdict

import numpy as np

from tests.conftest import SF
from tests.llm.test_scan_operators import EDGE, table
from tslake.llm import packing, queries


def check(rows, docs, window, path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    ids = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,) for _, t in docs)
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append(r)
    padded = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    assert padded == 0
    assert sum(r["length"] for r in rows) == sum(map(len, ids))
    unique = {i: t for i, t in docs if sum(j == i for j, _ in docs) == 1}
    for i, t in unique.items():
        own, at = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(own)
            assert r["ids_crc32"] == zlib.crc32(own[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(own)


def test_round_trip(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] + EDGE
    path = queries.tokenizer_path()
    check(packing.pack(table(spark, docs), path).collect(), docs, 1024, path)
    check(packing.pack(table(spark, docs[:40] + EDGE).repartition(5), path, window=64, open_windows=2).collect(), docs[:40] + EDGE, 64, path)
    assert packing.pack(table(spark, []), path).count() == 0


def test_best_fit():
    p = packing.Packer(10, 2)
    for n in (6, 3):
        p.put(packing.Piece(n, 0, b"\0" * 4 * n))
    assert [u for u, _ in p.open] == [9]
    p.put(packing.Piece(5, 0, b"\0" * 20))
    p.put(packing.Piece(7, 0, b"\0" * 28))  # none fits: the fullest leaves, full
    assert len(p.closed) == 1 and sum(map(len, p.closed[0])) == 10 and sorted(u for u, _ in p.open) == [5, 6]
