"""Language identification and toxicity: held-out accuracy and edge cases."""

import re
import zlib

import numpy as np

from tests.conftest import SF
from tests.llm.test_scan_operators import EDGE, table
from tslake.llm import langid, toxicity

SF01 = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    field = langid.train(docs.filter(~langid.held_out("doc_id")), sample_rows=60)
    got = langid.identify(docs, field).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(out) > 250 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    edge = {r["doc_id"]: r for r in langid.identify(table(spark, EDGE), field).collect()}
    assert edge[1]["lang_pred"] == edge[2]["lang_pred"] == edge[3]["lang_pred"] == "und" and edge[1]["score"] == 0
    assert edge[7]["lang_pred"] == "en" and len(langid.identify(table(spark, EDGE), field).collect()) == len(EDGE)
    none = langid.train(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(table(spark, EDGE), none).collect()} == {"und"}


def test_chain_matches_enumeration():
    rng = np.random.default_rng(0)
    k, t = 3, 4
    scores, move, start = rng.normal(size=(1, t, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    want, total = np.zeros((t, k)), 0.0
    for code in range(k**t):
        path = [code // k**i % k for i in range(t)]
        p = np.exp(start[path[0]] + sum(scores[0, i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
        total += p
        for i, y in enumerate(path):
            want[i, y] += p
    padded = np.concatenate([scores, np.full((1, 2, k), 5.0)], axis=1)
    assert np.allclose(langid.forward_backward(padded, move, start, np.array([t]))[0][0, :t], want / total)
    for size in (1, 2, 3, 6):  # in blocks of words, with messages carried from block to block
        blocks = -(-t // size)
        cut = np.full((blocks * size, k), 5.0)
        cut[:t] = scores[0]
        e, a, lengths = np.exp(cut.reshape(blocks, size, k)), np.exp(move), np.minimum(size, t - size * np.arange(blocks))
        left, right = langid.linked(langid.transfers(e, a, lengths), a, np.array([blocks]), np.exp(start)[None], np.ones((1, k)))
        assert np.allclose(langid.block_marginals(e, a, lengths, left, right).reshape(-1, k)[:t], want / total)


def test_long_texts_are_one_chain(monkeypatch):
    """Blocks and parts of a text inform each other: the same as one chain of all its words."""
    rng = np.random.default_rng(5)
    vocabulary = {y: [f"{y}{''.join(rng.choice(list('abcdefgh'), 4))}" for _ in range(60)] for y in "xyz"}
    texts = [" ".join(rng.choice(vocabulary[y], 90)) for y in "xyz" for _ in range(6)]
    field = langid.Field(texts, [y for y in "xyz" for _ in range(6)], iterations=5)
    mixed = " ".join(" ".join(rng.choice(vocabulary[y] + vocabulary["x"], 70)) + " 12 \n " for y in "xyzyx")
    got, counts = field.word_marginals([mixed, "", texts[0]])
    assert counts.tolist() == [350, 0, 90]
    e, lengths, *_ = field._factors([mixed])
    scores = np.log(e.reshape(1, -1, 3)[:, :350])
    assert np.allclose(got[:350], langid.forward_backward(scores, field.transition, field.start, np.array([350]))[0][0])
    want = field.predict([mixed, texts[0]])
    monkeypatch.setattr(langid, "TAKEN", 300)
    assert [w[0] for w in field.predict([mixed, texts[0], " 1 " * 200])] == [*[w[0] for w in want], "und"]
    assert np.allclose([w[1] for w in field.predict([mixed, texts[0]])], [w[1] for w in want])


def test_training_sample(spark):
    """Long texts take part with all their pieces, copies count once, and no language passes its bound."""
    rows = [("en", f"short text number {k}") for k in range(40)] + [("en", "a copy")] * 500 + [("de", f"wort{k} " * 30000) for k in range(2)] + [("fr", "x" * 100_000)]
    docs = spark.createDataFrame([*rows, (None, "none"), ("de", None), ("de", "   ")], "lang string, text string")
    got = langid.training_pieces(docs, sample_rows=30).collect()
    by = {y: [r[1] for r in got if r[0] == y] for y in ("en", "de", "fr")}
    assert len(got) == len(set(got)) and len(by["en"]) <= 30 and 2 <= len(by["de"]) <= 30 and 1 <= len(by["fr"]) <= 30
    assert max(len(p) for p in by["de"]) <= langid.PIECE + 10 and sum(map(len, by["fr"])) <= 100_000
    every = langid.training_pieces(docs.filter("lang = 'en'"), sample_rows=1000).collect()
    assert len(every) == 41


def plain_features(text):
    return set(re.findall(r"[^\W\d_]+", text.lower()))


def test_chain_by_hand(spark):
    """Each document's probabilities from the fitted weights, summed feature by feature; the first model fitted by gradient steps."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len({r[0] for r in rows})
    for doc, text in rows:
        words, logits = plain_features(text or ""), []
        for k, (index, w) in enumerate(chain.models):
            z = w[-1] + sum(w[len(index) + j] * logits[j] for j in range(k))
            for word in words:
                for f in {zlib.crc32(word.encode()), *[zlib.crc32(b"^" + word[:n].encode()) for n in (4, 5, 6) if len(word) > n]}:
                    z += w[index[f]] if f in index else 0.0
            logits.append(min(9.0, max(-9.0, z)))
        p = [1 / (1 + np.exp(-z)) if words else 0.0 for z in logits]
        assert np.allclose([got[doc]["p_quality"], got[doc]["p_toxic"]], p)
        assert got[doc]["toxic"] == (got[doc]["p_toxic"] >= 0.5)
    x, y = np.random.default_rng(1).normal(size=(300, 3)), np.arange(300) % 3 == 0
    w, z = toxicity.fit_logistic(x, y.astype(float)), np.zeros(4)
    full = np.column_stack([x, np.ones(300)])
    for _ in range(20000):
        z -= 0.002 * (full.T @ (1 / (1 + np.exp(-full @ z)) - y) + np.array([1, 1, 1, 1e-6]) * z)
    assert np.allclose(w, z, atol=1e-4)


def test_drop_toxic_keeps_columns(spark):
    docs = spark.createDataFrame([(k, "words", 7, "p") for k in range(3)], "doc_id long, text string, _toxicity int, p_toxic string")
    labels = spark.createDataFrame([(0, 1, 0), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [(k, "words", 7, "p") for k in range(3)]
    assert toxicity.drop_toxic(docs.limit(0), labels).count() == 0


def test_long_labelled_texts_teach(spark):
    """A word that only very long texts hold is learned from them."""
    filler = [f"w{i}x".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(20000)]
    docs = [(k, " ".join([*filler, "vileword" if k % 2 else "kindword"])) for k in range(40)] + [(100, "vileword here"), (101, "kindword here")]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["toxic"] for r in toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), labels).collect()}
    assert len(docs[0][1]) > 1 << 16 and got[100] and not got[101]


def test_code_switching(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    field = langid.train(docs, sample_rows=60)
    labels = [y for _, y, _ in langid.label_words(field, "the thing is of and with that der die und nicht ein schein auf")]
    assert labels[:7].count("en") >= 6 and labels[7:].count("de") >= 6


def test_toxicity(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    train = labels.filter("doc_id % 2 = 0")
    chain = toxicity.train(docs, train)
    run = toxicity.probability_columns(chain, docs, ("quality", "toxic"))
    got = docs.select("doc_id", run("text").alias("p")).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    said, true = np.array([r["p"]["p_toxic"] >= 0.5 for r in got]), np.array([r["toxic"] == 1 for r in got])
    assert said[true].mean() > 0.6 and said[~true].mean() < 0.05
    edge = toxicity.toxicity(table(spark, EDGE), labels.withColumn("text", labels.toxic)).collect()
    assert len(edge) == len(EDGE) and not any(r["toxic"] for r in edge if r["doc_id"] in (1, 2, 3))
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 0.8 * docs.count() < kept.count() < docs.count()
    assert not any(r["toxic"] for r in toxicity.toxicity(docs, labels.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = langid.train(docs, sample_rows=5)
    assert langid.identify(docs.limit(0), field).count() == 0
    clash = docs.limit(3).select("doc_id", "text", docs.lang.alias("_l"), docs.lang.alias("lang_pred"))
    assert langid.identify(clash, field).columns == ["doc_id", "lang_pred", "score"]
