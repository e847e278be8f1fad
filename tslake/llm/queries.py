"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslake.llm import ann, byte_dedup, decontam, forest, langid, lexical, packing, secret_scan, spelling, tokens, topk, toxicity, word_dedup
from tslake.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_dedup.remove_repeats(table(spark, sf_dir, "documents"), texts=False)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), limit=512)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = langid.train(docs.filter(~langid.held_out("doc_id")))
    return langid.identify(docs, field).select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_dedup.remove_repeats(table(spark, sf_dir, "documents"), texts=False)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=50)


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, top=10)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = (
        op1_suffix_dedup, op2_token_counts, op3_language_id, op4_substring_dedup, op5_decontamination, op6_ngram_jaccard_join,
        op7_nearest_neighbours, op8_packing, op9_secret_scan, op10_toxicity, op11_lexical_search, op12_topk_search, op13_spelling_variants, pipeline,
    )
    return {f.__name__: f for f in own}


_OP4 = r"""
with d as (select row_number() over () as rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (select rid, i, array_to_string(w[i:i + 34], ' ') as s from d, unnest(range(1, len(w) - 33)) u(i)),
rep as (select rid, i from win qualify count(*) over (partition by s) > 1),
gone as (select distinct rid, p from rep, unnest(range(i, i + 35)) u(p)),
word as (select rid, unnest(w) as x, generate_subscripts(w, 1) as p from d),
kept as (select rid, string_agg(x, ' ' order by p) as k, count(*) as n from word anti join gone using (rid, p) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(k, '')) as kept_sha256 from d left join kept using (rid)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP5 = rf"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as s from (select item_id, w, least(13, len(w)) as n from b where len(w) > 0), unnest(range(1, len(w) - n + 2)) u(i)),
dw as (select rid, i, n, array_to_string(w[i:i + n - 1], ' ') as s from d, (select distinct n from bw), unnest(range(1, len(w) - n + 2)) u(i)),
found as (select rid, i, n, item_id from dw join bw using (n, s)),
hit as (select rid, count(distinct p) as n_hit from found, unnest(range(i, i + n)) u(p) group by rid),
item as (select rid, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct rid, cast(item_id as varchar) as id from found where item_id is not null) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (rid) left join item using (rid)"""


_OP11 = rf"""
with d as (select row_number() over () as rid, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
s as (select count(*) filter (len(w) > 0) as n_docs, cast(sum(len(w)) as bigint) as n_terms from d),
it as (select distinct item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
tf as (select rid, t, count(*) as tf from (select rid, unnest(w) as t from d) where t in (select t from it) group by rid, t),
wt as (select t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as weight from tf, s group by t, n_docs),
m as (select rid, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) as m from d, s),
score as (select item_id, rid, doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score from it join tf using (t) join wt using (t) join m using (rid) group by all)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from score where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50"""


_OP12 = """
with e as (select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score from (select distinct * from e where vec_id % 100 = 0) q join e c on c.vec_id <> q.vec_id and len(c.v) = len(q.v))
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10"""


def oracle_sql() -> dict[str, str]:
    """The operators that SQL can express as they are; the others are tested against plain versions."""
    return {"op4_substring_dedup": _OP4, "op5_decontamination": _OP5, "op11_lexical_search": _OP11, "op12_topk_search": _OP12}
