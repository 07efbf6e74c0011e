"""The registered queries of the training-data operators and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.llm import quality, toxicity
from martcraft.llm.bpe import encode_decode
from martcraft.llm.html_extract import extract_main_text
from martcraft.llm.jaccard_join import jaccard_components
from martcraft.llm.line_dedup import dedup_lines
from martcraft.llm.mixing import mix_sources
from martcraft.llm.periodic_runs import find_runs
from martcraft.llm.substring_dedup import dedup_substrings
from martcraft.llm.token_align import align_tokens
from martcraft.llm.token_count import count_tokens
from martcraft.llm.topk import top_k
from martcraft.llm.url_filter import filter_urls, rule_table


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One corpus worth of tokens, flattened to 95 % of the entropy of equal weights."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"), budget_epochs=1.0, target_entropy=0.95)


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=10, scale=1024, every=100)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"), window=13)
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_file("byte_bpe_50k.json"), limit=512)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_lines", "n_removed_lines", "n_removed_words", F.sha2("text", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories: toxic in good prose, toxic in junk, and last, with their logits, toxic (from the two label columns)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic, good = F.col("toxic"), F.col("quality")
    chain = toxicity.train_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"),
                                 {"toxic_prose": toxic * good, "toxic_junk": toxic * (1 - good), "toxic": toxic})
    got = toxicity.score_toxicity(docs, chain)
    return got.select("doc_id", *(F.col(f"is_{c}").alias(c) for c in reversed(chain.categories)), *(F.round(f"p_{c}", 6).alias(f"p_{c}") for c in chain.categories))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("quality_score", 6).alias("quality_score"))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_file("word_bpe_49k.json"))
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# The rules that the query's contract names.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rule_table(spark, URL_RULES)).drop("url")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of every document whose id's CRC-32 is divisible by ten, the words from one place on repeat, as the query's contract says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, w = F.floor(h / 10).cast("long"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    d = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, w).alias("w"))
    d = d.withColumn("n", F.size("w").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, null)"))
    d = d.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    return d.selectExpr("doc_id", "if(n > 0, array_join(transform(sequence(0L, n - 1), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' '), text) as text")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find_runs(with_planted_periods(spark.read.parquet(f"{sf_dir}/documents.parquet")), min_length=24, exponent=3)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return got.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                      F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = align_tokens(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_topk_search": op2_topk_search,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_token_count": op4_token_count,
    "op5_html_extraction": op5_html_extraction,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_url_filter": op11_url_filter,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}
_MIXING_SQL = r"""
with recursive t as (
  select doc_id, source, coalesce('=' || source, '-') as skey, coalesce(md5(text), '') as digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n
  from documents),
u as (select doc_id, source, skey, digest, count(*) as n_rows, sum(n) as n_tokens from t group by all),
s as (select skey, sum(n_tokens) as n from u group by skey having sum(n_tokens) > 0),
tot as (select sum(n) as total, count(*) as k from s),
l as (select list(n::double / total::double) as ps, 0.95 * ln(any_value(k)) - 1e-12 as goal from s, tot),
b(i, lo, hi) as (
  select 0, 0::double, 1::double
  union all
  select i + 1, case when up then mid else lo end, case when up then hi else mid end
  from (select i, lo, hi, (lo + hi) / 2 as mid,
               ln(list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2))))
               - (lo + hi) / 2 * list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2) * ln(p)))
                 / list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2))) >= goal as up
        from b, l where i < 32)),
a as (select case when -list_sum(list_transform(ps, lambda p: p * ln(p))) >= goal then 1 else (select round(lo, 6) from b where i = 32) end as a from l),
w as (select skey, n, pow(n::double / total, a) / (select list_sum(list_transform(ps, lambda p: pow(p, a))) from l) as weight from s, tot, a),
q as (select skey, n, cast(floor(weight * total) as bigint) as quota from w, tot),
nb as (select greatest(1, ceil(sum(quota) / 262144.0)) as blocks from q),
c as (
  select u.*, q.n, q.quota, e.epoch,
         ('0x' || substr(md5(concat_ws(':', '0', e.epoch, coalesce(doc_id::varchar, ''), digest)), 1, 15))::bigint as place,
         ('0x' || substr(md5(concat_ws(':', '0', 'in', e.epoch, coalesce(doc_id::varchar, ''), digest)), 1, 15))::bigint as within
  from u join q using (skey), lateral (select unnest(range(cast(ceil(quota / n) as bigint))) as epoch) e),
p as (
  select *, epoch * n + sum(n_tokens) over (partition by skey, epoch order by place, doc_id nulls first, digest rows unbounded preceding) - n_tokens as begins from c),
d as (select *, cast(floor(begins::double / quota::double * blocks) as bigint) as block from p, nb where begins < quota)
select doc_id, source, digest, n_rows, cast(n_tokens as bigint) as n_tokens, cast(epoch as bigint) as epoch, block,
       cast(row_number() over (partition by block order by within, doc_id nulls first, skey, epoch) - 1 as bigint) as position
from d
"""

_TOPK_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v))
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 10
"""

_SUBSTRING_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
  select r, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as k
  from d, lateral (select unnest(range(1, len(w) - 11)) as i) t where doc_id is not null),
least as (select k, min(doc_id) as m from win group by k),
gone as (
  select distinct r, i + j as p from win join least using (k), lateral (select unnest(range(13)) as j) t where m < doc_id),
kept as (
  select t.r, string_agg(t.x, ' ' order by t.p) as text, count(*) as n
  from (select r, p, w[p] as x from d, lateral (select unnest(range(1, len(w) + 1)) as p) u) t anti join gone using (r, p) group by t.r)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (r)
"""

_JACCARD_SQL = r"""
with recursive d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct r, array_to_string(list_slice(w, i, i + 2), ' ') as k
  from d, lateral (select unnest(range(1, greatest(2, len(w) - 1))) as i) t where len(w) > 0),
n as (select r, count(*) as n from s group by r),
pairs as (
  select a.r as a, b.r as b, count(*) as c
  from s a join s b on a.k = b.k and a.r <> b.r join d x on x.r = a.r join d y on y.r = b.r
  where x.doc_id is not null and y.doc_id is not null group by a.r, b.r),
links as (select a, b from pairs join n na on na.r = a join n nb on nb.r = b where 100 * c >= 90 * (na.n + nb.n - c)),
reach(r, x) as (select r, r from d union select reach.r, links.b from reach join links on links.a = reach.x)
select d.doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(y.doc_id) as component_id
from d join reach on reach.r = d.r join d y on y.r = reach.x left join n on n.r = d.r group by d.r, d.doc_id
"""

_URL_SQL = r"""
with u as (
  select row_number() over () as r, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
rules(h, p, v) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best as (
  select r, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as v
  from u join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by r)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from u left join best using (r)
"""

ORACLE: dict[str, str] = {
    "op11_url_filter": _URL_SQL,
    "op1_source_mixing": _MIXING_SQL, "op2_topk_search": _TOPK_SQL, "op3_substring_dedup": _SUBSTRING_SQL, "op6_jaccard_join": _JACCARD_SQL}
