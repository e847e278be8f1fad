"""The pipeline's stages, each on what its predecessor kept."""

from collections import defaultdict

import corpus_pipeline
from tests.llm.test_neighbours import plain_near
from tests.llm.test_scan_operators import plain_contamination
from tslake.llm import secret_scan, toxicity

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "packing":
            rows = after.collect()
            assert {r["doc_id"] for r in rows} == {i for i, _ in before}
            used = defaultdict(int)
            for r in rows:
                used[r["sequence_id"]] += r["length"]
            assert all(n == 1024 or n & (n - 1) == 0 for n in used.values())
            continue
        assert after.columns == columns
        kept = {r["doc_id"]: r for r in after.collect()}
        if name == "toxicity":
            said = toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("not toxic").collect()
            want = {r["doc_id"] for r in said}
        elif name == "ngram_jaccard_join":
            want = {i for i, (label, _, _) in plain_near(before).items() if label == i}
        elif name == "decontamination":
            want = {i for i, t in before if not plain_contamination(t, items)[-1]}
        else:
            want = {i for i, _ in before}
            assert all(not secret_scan.scan(r["text"]) for r in kept.values())
            assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
        assert set(kept) == want
        docs = after


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100 and corpus_pipeline.ORACLE_SQL is None


def test_stages_on_edges(spark):
    """Each stage on an empty table, and on nulls in all columns, repeated rows, empty texts and columns with odd names."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = "plain words that are long enough to be one shingle and more " * 4000
    schema = docs.schema.simpleString()[7:-1].replace(":", " ") + ", _hits int, _toxicity string, n_hit string"
    rows = [(i, t, lang, "s", n, 7, "x", "y") for i, t, lang, n in [
        (None, None, None, None), (None, "one text", "en", 8), (1, "", "en", 0), (1, "", "en", 0), (2, None, None, None), (3, "same words here", "en", 15), (3, "same words here", "en", 15), (4, long, "en", len(long)), (5, "token=abcdefgh", "en", 14),
    ]]
    odd = spark.createDataFrame([tuple(dict(zip(["doc_id", "text", "lang", "source", "n_chars", "_hits", "_toxicity", "n_hit"], r))[c] for c in [*docs.columns, "_hits", "_toxicity", "n_hit"]) for r in rows], schema)
    want = {"toxicity": 9, "ngram_jaccard_join": 7, "decontamination": 9, "secret_scan": 9}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = stage(spark, odd, SF)
        if name == "packing":
            assert {r["doc_id"] for r in out.collect()} == {r[0] for r in rows}
        else:
            assert out.columns == odd.columns and out.count() == want[name], name
