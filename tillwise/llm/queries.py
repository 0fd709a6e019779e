"""Registered queries of this package with their production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import collocations, embedding_dedup, exact_dedup, hard_negatives, mixing, packing, quality, repeats, secrets, sharding, simhash, surrogates, url_filters
from tillwise.llm.common import read

SEQUENCE_TOKENS = 4096
SEQUENCE_SEGMENTS = SEQUENCE_TOKENS
END_ID = 2
SHARD_BYTES = 32 << 20
MIX_BLOCK = 32
SIMHASH_WORDS, SIMHASH_BITS = 4, 4
COSINE = 0.95
REPEAT_WORDS = 35
POSITIVES, NEGATIVES, NEGATIVE_PERCENT = 5, 3, (50, 95)
SUPPORT, PHRASE_WORDS, PHRASES = 100, 5, 2000
URL_RULES = [url_filters.rule(*r) for r in (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))]
#: Of this query; a caller of the operator brings a secret one.
SURROGATE_KEY = "surrogates of the registered query"
#: Target shares of the sources; any other source is pooled under one share.
MIX_SHARES = {"src0": 12} | {f"src{i}": 5 for i in range(1, 10)} | {f"src{i}": 3 for i in range(10, 20)}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), END_ID,
                                  SEQUENCE_TOKENS, SEQUENCE_SEGMENTS)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(read(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(read(spark, sf_dir, "documents"), keep="largest")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), MIX_SHARES, MIX_BLOCK)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, sf_dir, "documents"))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace(read(spark, sf_dir, "documents"), SURROGATE_KEY)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), SIMHASH_WORDS, SIMHASH_BITS)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(spark, sf_dir, "embeddings"), COSINE)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantised(vectors, moved, 256)
    return hard_negatives.hard_negatives(rows, F.col("id") % 50 == 0, POSITIVES, NEGATIVES, *NEGATIVE_PERCENT)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), SUPPORT, PHRASE_WORDS, PHRASES)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.drop_repeats(read(spark, sf_dir, "documents"), REPEAT_WORDS)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(read(spark, sf_dir, "pages"), URL_RULES)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_sharding": op2_sharding,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_secrets": op5_secrets,
    "op6_surrogates": op6_surrogates,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_repeats": op10_repeats,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_url_filters": op13_url_filters,
}


def shard_sql(limit: int) -> str:
    bits = "lpad(bin(('0x' || substr(md5({0}), 1, 15))::bigint), 60, '0')"
    return f"""
with r as (
  select doc_id, strlen(coalesce(text, ''))::bigint as bytes,
         {bits.format("coalesce(doc_id::varchar, '')")} || {bits.format("coalesce(text, '')")} as address
  from documents),
n as (
  select substr(address, 1, d) as shard, d, sum(bytes)::bigint as shard_bytes, count(*) as shard_rows
  from r, (select unnest(range(0, 121)) as d) group by all),
leaf as (
  select r.doc_id, r.bytes, r.address, min(n.d) as depth
  from r, n
  where n.shard = substr(r.address, 1, n.d) and (n.shard_bytes <= {limit} or n.shard_rows = 1 or n.d = 120)
  group by all)
select leaf.doc_id, leaf.bytes, n.shard, leaf.depth::int as depth, n.shard_bytes, n.shard_rows,
       n.shard_bytes > {limit} as oversize
from leaf join n on n.d = leaf.depth and n.shard = substr(leaf.address, 1, leaf.depth)"""


EXACT_SQL = """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
  from documents),
g as (select body, max(doc_id) as keep_id, count(*) as group_size from t group by body)
select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.body) as text_sha256
from t join g using (body)"""

PHRASE_SQL = f"""
with d as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
total as (select lang, sum(len(w))::bigint as n from w group by lang),
g as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from w, (select unnest(range(1, {PHRASE_WORDS} + 1)) as k) where len(w) >= k),
f as (select lang, k, phrase, count(*)::bigint as f from g group by all having count(*) >= {SUPPORT}),
c as (
  select lang, phrase, k, f as a, string_split(phrase, ' ') as w from f where k > 1),
cut as (
  select c.lang, c.phrase, c.k, c.a, j, l.f as l, r.f as r, n, (1000::hugeint * a * n) // (l.f::hugeint * r.f) as score
  from c, (select unnest(range(1, {PHRASE_WORDS})) as j), f l, f r, total
  where j < c.k and l.lang = c.lang and r.lang = c.lang and total.lang = c.lang
    and l.phrase = array_to_string(w[1:j], ' ') and r.phrase = array_to_string(w[j + 1:], ' ')),
best as (
  select lang, phrase, k, a, l, r, n, score::bigint as score from cut
  qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (
  select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as around
  from c, (select unnest(range(1, {PHRASE_WORDS})) as i), (select unnest(range(2, {PHRASE_WORDS})) as m)
  where m < k and i + m - 1 <= k group by all)
select lang, rank, phrase, a, l, r, n, score from (
  select b.lang, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank, b.phrase, a, l, r, n, score
  from best b left join inside i on i.lang = b.lang and i.phrase = b.phrase
  where i.around is null or 100 * i.around < 100 * a)
where rank <= {PHRASES}"""

NEGATIVE_SQL = f"""
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, e.vec_id, a.label = e.label as same, list_dot_product(a.q, e.q)::bigint as score
  from e a, e where a.vec_id % 50 = 0 and a.vec_id <> e.vec_id and len(a.q) = len(e.q)),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES})
select p.anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from (
  select p.anchor_id, p.positive_id, s.vec_id as negative_id, positive_score, s.score as negative_score,
         row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
  from p join s on s.anchor_id = p.anchor_id
  where not s.same and {NEGATIVE_PERCENT[0]} * positive_score <= 100 * s.score and 100 * s.score <= {NEGATIVE_PERCENT[1]} * positive_score) p
where rank <= {NEGATIVES}"""

ORACLES = {
    "op11_hard_negatives": NEGATIVE_SQL,
    "op12_collocations": PHRASE_SQL,
    "op2_sharding": shard_sql(SHARD_BYTES),
    "op3_exact_dedup": EXACT_SQL,
}
