"""Spelling variants against a plain version of their contract."""

import itertools
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from tests.conftest import SF
from tests.llm.test_scan_operators import EDGE, table
from tslake.llm import queries, spelling

RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_words(docs, length=7, count=2):
    out = Counter()
    for i, text in docs:
        for run in map(lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= length and n >= count}


def plain_variants(n):
    by, near = {}, {w: set() for w in n}
    for w in n:
        for k in range(len(w)):
            by.setdefault(w[:k] + "*" + w[k + 1 :], set()).add(w)
            if (shorter := w[:k] + w[k + 1 :]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for own in by.values():
        for a, b in itertools.combinations(own, 2):
            near[a].add(b)
            near[b].add(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def test_one_edit_of_all_pairs():
    """Tiles of short and long words, whatever their block, against edit distance by hand."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abé", k=rng.randrange(1, 7))) for _ in range(400)})
    words += ["x" * 300, "x" * 299, "x" * 150 + "y" + "x" * 149, "x" * 298]
    n = {w: rng.randrange(2, 2000) for w in words}
    want = plain_variants(n)
    for rows in (256, 5):
        got = tiled(n, rows)
        assert {w: c for w, c in got.items() if c} == {w: c for w, _, _, _, c, _ in want if c}


def tiled(n, rows):
    old, spelling.BLOCK_ROWS = spelling.BLOCK_ROWS, rows
    try:
        out = []
        for w in n:
            for base in (len(w), len(w) - 1):
                for last in (False, True):
                    if base > 0:
                        out.append((base, last, (w[len(w) - base // 2 :] if last else w[: base // 2]), w, n[w], 0, 0, 0))
        names = ["_base", "_last", "_half", "word", "n", "_own", "_a", "_b"]
        total = Counter()
        for r in spelling.near_words(pa.Table.from_pylist([dict(zip(names, r)) for r in out])).to_pylist():
            total[r["word"]] += r["n_near"]
        return total
    finally:
        spelling.BLOCK_ROWS = old


def documents(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rng = random.Random(6)
    made = []
    for stem in ("strawberry", "développé", "ÑANDÚESÇA", "Wavelength"):
        for k in range(60):
            w = list(stem)
            w[k % len(w)] = rng.choice("abcdefgh") if k % 3 else ""
            made.append((9000 + k, f"{''.join(w)} {''.join(w)}, {stem} {(stem + ' ') * 30}1{stem}÷x"))
    chain = [(9500, "abcdefgh " * 3 + "abcdefgx " * 40 + "abcdefyx " * 500 + "abcdezyx " * 6000)]  # forms of forms
    tie = [(9600, "kkkkkkkk " * 2 + "kkkkkkkb " * 20 + "kkkkkkka " * 20)]
    long = [(9700, ("q" * 5000 + " ") * 2 + ("q" * 4999 + " ") * 2 + ("q" * 2000 + "r" + "q" * 2999 + " ") * 30)]
    return rows + EDGE + made + chain + tie + long


@pytest.mark.parametrize("part", [spelling.PART, 6])
def test_variants(spark, part):
    docs = documents(spark)
    got = spelling.variants(table(spark, docs), part=part, task_rows=spelling.TASK_ROWS if part > 6 else 300)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_words(docs))
    assert sorted(map(tuple, got.collect())) == want
    by = {w[0]: w for w in want}
    assert by["kkkkkkkk"][1] == "kkkkkkka" and by["abcdefgh"][2] == "abcdezyx" and sum(w[1] is not None for w in want) > 20
    assert spelling.variants(table(spark, [])).count() == 0 and spelling.variants(table(spark, [(1, None), (2, "short words")])).count() == 0


def test_the_query(spark):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_spelling_variants(spark, SF).collect())) == plain_variants(plain_words(docs))
