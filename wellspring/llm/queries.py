"""The registered queries of this package: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm.stages import table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import near_vectors

    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import personal_data

    return personal_data.digest(personal_data.all_spans(table(spark, sf_dir, "documents")))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import dedup_passages

    return dedup_passages.digests(dedup_passages.remove_repeats(table(spark, sf_dir, "documents")))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import languages

    return languages.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


@query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import leaks

    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import near_documents

    return near_documents.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import sharding

    return sharding.shard(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import toxicity

    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import language_model

    return language_model.scores(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import hard_negatives

    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op11_hard_negatives"] = """
with v as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as iv
  from embeddings
  where label is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
),
s as (
  select a.vec_id as anchor_id, a.label as alabel, v.vec_id as id, v.label,
         coalesce(list_inner_product(a.iv, v.iv), 0)::bigint as score
  from v as a join v on len(a.iv) = len(v.iv)
  where a.vec_id % 100 = 0
),
p as (
  select anchor_id, id as positive_id, score as positive_score
  from s where label = alabel and id <> anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.positive_id,
       (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.id))::int as rank,
       s.id as negative_id, p.positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and s.label <> s.alabel
  and 80 * p.positive_score <= 100 * s.score and s.score <= p.positive_score
qualify rank <= 5
"""


@query
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import lexical_search

    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
ORACLES["op12_ranked_lexical_search"] = f"""
with p as (
  select doc_id, t as term, count(*) as tf
  from (select doc_id, unnest({_TERMS.format('text')}) as t from documents where doc_id is not null)
  group by all
),
n as (select doc_id, sum(tf)::bigint as n from p group by doc_id),
c as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from n),
w as (
  select term, floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)))::bigint as w
  from p, c group by term, big_n
),
m as (select doc_id, 75 + (25 * n * big_n) // big_l as m from n, c),
q as (
  select item_id, t as term, count(*) as q
  from (select item_id, unnest({_TERMS.format('text')}) as t from benchmark where item_id is not null)
  group by all
),
s as (
  select q.item_id, p.doc_id, sum(q.q * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * m.m)))::bigint as score
  from q join p using (term) join w using (term) join m using (doc_id)
  group by all
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from s where score > 0
qualify rank <= 20
"""


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspring.llm import secret_scan

    return secret_scan.secrets(table(spark, sf_dir, "documents"))


def _secret_sql() -> str:
    from wellspring.llm.secret_scan import ACCESS_BASE, ASSIGN, HEX_BASE

    def rule(kind, order, pattern, group, least):
        p = pattern.replace("'", "''")
        return f"""
  select doc_id, '{kind}' as kind, {order} as o, i,
         length(pieces[i]) as before, length(ms[i]) as width, length(gs[i]) >= {least} as kept
  from (select doc_id, regexp_split_to_array(t, '{p}') as pieces, regexp_extract_all(t, '{p}', 0) as ms,
               regexp_extract_all(t, '{p}', {group}) as gs from d),
       lateral (select unnest(generate_series(1, len(ms))) as i)"""

    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({rule('assign', 0, ASSIGN, 2, 8)}
  union all {rule('access', 1, ACCESS_BASE, 0, 16)}
  union all {rule('hex', 2, HEX_BASE, 0, 32)}
),
s as (
  select doc_id, kind, o, kept,
         sum(before + width) over (partition by doc_id, kind order by i) - width as start,
         sum(before + width) over (partition by doc_id, kind order by i) as "end"
  from m
),
g as (
  select doc_id,
         count(*) filter (where kind = 'assign') as n_assign,
         count(*) filter (where kind = 'access') as n_access,
         count(*) filter (where kind = 'hex') as n_hex,
         string_agg(kind || ':' || start || ':' || "end", ',' order by start, o) as spans
  from s where kept group by doc_id
)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (doc_id)
"""


ORACLES["op13_secret_scan"] = _secret_sql()
