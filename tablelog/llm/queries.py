"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelog.llm import chat_format, decontaminate, jaccard_join, mixing, neighbours, pii, quality, secrets, token_counts, toxicity
from tablelog.llm.common import fold, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _classified(module, label: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = module.fit(docs, table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 1), label_col=label)
    return module.score(docs, model).select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(toxicity, "toxic", spark, sf_dir)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    return chat_format.digest(chat_format.format_chats(told.unionByName(own), parts_col="text"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(quality, "quality", spark, sf_dir)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents"), redacted=False))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.select("vec_id").where("vec_id % 100 = 0"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents"), redacted=False))


OP3_SQL = """
with told as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (
  select *, replace(replace(replace(replace(replace(replace(replace(replace(text, '\\', '\\\\'), '<s>', '<\\s>'), '</s>', '<\\/s>'),
    '[INST]', '[\\INST]'), '[/INST]', '[\\/INST]'), '<SYS>>', '<\\SYS>>'), '</SYS>>', '<\\/SYS>>'), '<|', '<\\|') as safe from told)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|turn|>') + length(role) + 1 + length(safe) + length('<|end|>') + 1) as bigint) as formatted_chars
from escaped group by conv_id
"""

OP9_SQL = """
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size, md5('mix:' || coalesce(doc_id::varchar, '')) as k
  from documents),
s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as i from d group by source),
w as (
  select *, (case (i - 1) % 3 when 0 then 3 when 1 then 1 else 2 end)::double as w, 2.0::double * source_size as cap, 1.5::double * sum(source_size) over () as total from s),
o as (
  select *, coalesce(sum(cap) over (order by cap / w, i rows between unbounded preceding and 1 preceding), 0) as held,
    sum(w) over (order by cap / w, i rows between current row and unbounded following) as wleft from w),
c as (select *, cap * wleft <= (total - held) * w as capped from o),
first_free as (select held as fheld, wleft as fleft from c where not capped order by cap / w, i limit 1),
t as (
  select source, source_size, case when capped then cap else (total - fheld) * w / fleft end as target from c left join first_free on true),
q as (select *, floor(target)::bigint as quota from t),
l as (
  select d.*, source_size, target, least(quota, source_size) as f0, greatest(least(quota - source_size, source_size), 0) as f1,
    coalesce(sum(size) over (partition by d.source order by k, size, doc_id rows between unbounded preceding and 1 preceding), 0) + size / 2.0::double as mid
  from d join q on d.source is not distinct from q.source)
select doc_id, size, source_size, target, (size * ((mid < f0)::int + (mid < f1)::int))::bigint as taken from l
"""

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_chat_format, op4_quality, op5_secrets, op6_neighbours, op7_jaccard_join, op8_decontaminate, op9_mixing, op10_pii)}
SQL = {"op3_chat_format": OP3_SQL, "op9_mixing": OP9_SQL}
