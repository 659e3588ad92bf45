"""The registered queries of this package and the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourtide.llm import cutting_stock, decontaminate, grace_dedup, hard_negatives, hilbert, host_reputation, licences, mixing, packing, pitman_yor, prefix_trie, simhash, toxicity
from hourtide.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_grace_dedup(spark, sf_dir):
    return grace_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query
def op2_simhash_groups(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query
def op3_host_reputation(spark, sf_dir):
    return host_reputation.judge(table(spark, sf_dir, "pages"))


@query
def op4_packed_tokens(spark, sf_dir):
    return packing.pack_tokens(table(spark, sf_dir, "documents"))


@query
def op5_hilbert_shards(spark, sf_dir):
    return hilbert.shard_by_curve(table(spark, sf_dir, "documents"))


@query
def op6_pitman_yor_scores(spark, sf_dir):
    return pitman_yor.lm_scores(table(spark, sf_dir, "documents"))


@query
def op7_prefix_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


@query
def op8_nearest_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("mark")


@query
def op9_source_mix(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents"))


@query
def op10_licence_scan(spark, sf_dir):
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query
def op11_cutting_stock(spark, sf_dir):
    return cutting_stock.pack_by_patterns(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


ORACLE["op1_grace_dedup"] = """
with texts as (
  select doc_id, cast(length(coalesce(text, '')) as bigint) as n_chars,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as text_sha256 from documents
), ranked as (
  select *, count(*) over (partition by text_sha256) as group_size,
    first_value(doc_id) over (partition by text_sha256 order by n_chars desc, doc_id) as keep_id from texts
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256, n_chars from ranked
"""
ORACLE["op3_host_reputation"] = host_reputation.SQL
ORACLE["op7_prefix_decontamination"] = decontaminate.SQL
ORACLE["op9_source_mix"] = mixing.SQL
ORACLE["op10_licence_scan"] = licences.SQL
ORACLE["op12_hard_negatives"] = hard_negatives.SQL
ORACLE["op13_prefix_trie"] = prefix_trie.SQL
