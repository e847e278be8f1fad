"""Strings on which sums of powers modulo 2**64 collide, whatever their base, and other regular or chained texts."""

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_scan_operators import plain_contamination, table
from tests.llm.test_dedup import plain_words
from tests.llm.test_neighbours import plain_near
from tslake.llm import decontam, forest, queries, tokens, word_dedup
from tslake.llm import words as W


def parity(a, b, n=1024):
    return "".join(a if bin(i).count("1") % 2 else b for i in range(n))


ONE, OTHER = parity("e", "t"), parity("t", "e")
FILL = [f"w{k}" for k in range(34)]


def test_tokens_of_regular_words():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    library = Tokenizer.from_file(path)
    for n in (4, 8, 16, 64, 1024):
        texts = [" ".join([parity(a, b, n)] * 2) for a, b in ("et", "te", "ab", "ba", "é0", "0é")]
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert tokens.token_lengths(pa.array(texts), path) == list(map(len, want))
        got = [np.frombuffer(ids, "<u4").tolist() for _, ids, *_ in tokens.token_ids(pa.array(texts), path)]
        assert got == want


def test_other_tokenizer_files():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(path)
    texts = ["Words  and WORDS, here's one.", "", None, "é " * 500, ONE, "x" * 3000 + " y"]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert not tokens.splits_as_known(path) and tokens.splits_as_known(queries.tokenizer_path())
    assert tokens.token_lengths(pa.array(texts), path) == list(map(len, want))


def test_long_text_is_counted_before_its_parts():
    path = queries.tokenizer_path()
    text = "some words of a long text, " * 200_000
    total, parts = 0, []
    for _, ids, last, n in tokens.token_ids(pa.array([text]), path):
        total += len(ids) >> 2
        parts.append((last, n))
    assert len(parts) > 10 and {n for _, n in parts} == {total} and [last for last, _ in parts] == [False] * (len(parts) - 1) + [True]


def test_word_hashes_are_distinct():
    long = ["q" * n for n in range(1, 1200, 7)] + [ONE, OTHER]
    spelt = sorted({parity(a, b, n) for n in (2, 3, 8, 9, 16, 17, 64, 500, 512, 513, 1024) for a, b in ("et", "te", "ae")} | set(long))
    data = np.frombuffer(" ".join(spelt).encode(), np.uint8)
    starts, ends, counts, h = W.words(data, np.array([0, len(data)]), W.BLANK_SEPARATED)
    assert len(set(h[0].tolist())) == len(set(h[1].tolist())) == len(spelt) == counts[0]
    _, _, _, again = W.words(np.concatenate([data, np.frombuffer(b" tail", np.uint8)])[: len(data)], np.array([0, len(data)]), W.BLANK_SEPARATED)
    assert (again == h).all()
    assert (W.words(data, np.array([0, len(data)]), W.BLANK_SEPARATED, lanes=1)[3][0] == h[0]).all()


def test_runs_and_sequences_of_regular_texts():
    a, b = (np.where([bin(i).count("1") % 2 == k for i in range(2048)], np.uint64(12345), np.uint64(999)) for k in (0, 1))
    for lane in (0, 1):
        for n in (5, 13, 15, 35, 64):
            by = {}
            for x in (a, b):
                for i, v in enumerate(W.runs(x, n, lane).tolist()):
                    assert by.setdefault(v, tuple(x[i : i + n].tolist())) == tuple(x[i : i + n].tolist())
        both = W.sequences(np.concatenate([a, b]), np.array([2048, 2048]), lane)
        assert both[0] != both[1]


def test_word_dedup(spark):
    docs = [(1, " ".join([*FILL, ONE])), (2, " ".join([*FILL, OTHER])), (3, " ".join([ONE] * 40)), (4, " ".join([OTHER] * 34))]
    got = word_dedup.remove_repeats(table(spark, docs), texts=False).collect()
    assert sorted(map(tuple, got), key=repr) == plain_words(docs, 35)
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 0, 2: 0, 3: 40, 4: 0}


@pytest.mark.parametrize("rows", [1000, 0])
def test_contamination(spark, rows):
    items = [(1, " ".join([*FILL[:12], ONE])), (2, OTHER), (3, "a b c"), (4, "a b c"), (None, "x y")]
    docs = [(1, " ".join([*FILL[:12], OTHER])), (2, " ".join([*FILL[:12], ONE])), (3, f"a {ONE} c a b c b c"), (4, ""), (5, None), (6, "a b c " * 30000), (6, "a b c " * 30000), (None, "x y z")]
    got = decontam.contamination(table(spark, docs), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=rows).drop("items").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *plain_contamination(t, items)) for i, t in docs], key=repr)
    assert decontam.contamination(table(spark, []), spark.createDataFrame(items, "item_id long, text string"), broadcast_rows=rows).count() == 0


@pytest.mark.parametrize("rows", [1000, 0])
def test_drop_contaminated_keeps_columns(spark, rows):
    docs = spark.createDataFrame([(1, "a b c", 7, "x", "y"), (2, "other words", 8, "x", "y")], "doc_id long, text string, _hits int, _hits_key string, n_hit string")
    kept = decontam.drop_contaminated(docs, spark.createDataFrame([(1, "a b c")], "item_id long, text string"), broadcast_rows=rows)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "other words", 8, "x", "y")]


def test_copies_of_regular_texts(spark):
    words = [parity("e", "t", 64), parity("t", "e", 64)]
    docs = [(1, " ".join(words[bin(i).count("1") % 2] for i in range(2048))), (2, " ".join(words[1 - bin(i).count("1") % 2] for i in range(2048)))]
    docs += [(3, ONE), (4, OTHER), (5, OTHER)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in forest.near_duplicates(table(spark, docs)).collect()}
    assert got == plain_near(docs)


def test_sizes_tell_the_depth():
    for n in range(1, 60):
        alike = [both / (n + m - both) for m in range(1, 2 * n + 2) for both in range(1, min(n, m) + 1) if 5 * both >= 4 * (n + m - both)]
        assert forest.least_similarity(n) == pytest.approx(min(alike))
        own = forest.depth(min(alike))
        assert 1 - (1 - min(alike) ** own) ** forest.TRIES >= forest.RECALL
        for m in range(1, 2 * n + 2):  # partners are listed at each other's levels
            if any(5 * both >= 4 * (n + m - both) for both in range(1, min(n, m) + 1)):
                assert own in forest.levels_of(m)


def test_chains_are_compared_by_bucket(spark):
    """Texts that passages chain into one component, few of them alike: each bucket alone is less work."""
    rng = np.random.default_rng(3)
    passages = [[f"p{k}_{i}" for i in range(20)] for k in range(125)]
    chain = [sum(passages[k : k + 5], []) for k in range(120)]
    docs = [(k, " ".join(own)) for k, own in enumerate(chain)]
    docs += [(1000 + k, " ".join([*chain[k][:-1], "end"])) for k in range(0, 120, 3)]
    docs += [(2000 + k, " ".join(passages[7] + [f"q{k}_{i}" for i in range(int(rng.integers(2, 25)))])) for k in range(60)]
    classes = forest.signatures(table(spark, docs), "doc_id", "text").selectExpr("a as node", "keys")
    found = forest.groups(classes).collect()
    assert any(r["buckets"] for r in found)
    work = {}
    for r in found:
        work[r["group"]] = work.get(r["group"], 0) + 1
    assert all(work[r["group"]] == r["size"] for r in found) and max(work.values()) < 119
    for chunk in (1024, 7):
        got = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_copies"]) for r in forest.near_duplicates(table(spark, docs), chunk=chunk).collect()}
        assert got == plain_near(docs)
