"""One registered query per operator, applied to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.llm import (best_fit, content_sort, filter_audit, icws, kd_shards, leak_simhash, log_bilinear, prefix_join, repair_runs,
                        token_store, toxic_kernel, url_vocabulary, warc_normal)
from larder.llm.common import LOWER, UPPER, table
from larder.llm.encode import tokenizer_path
from larder.llm.registry import register


@register("op1_best_fit")
def op1_best_fit(spark, sf_dir):
    pieces = best_fit.token_pieces(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
    return best_fit.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op2_kd_shards")
def op2_kd_shards(spark, sf_dir):
    return kd_shards.kd_shards(table(spark, sf_dir, "documents"), shards=8)


@register("op3_warc_normal", """
with p as (select page_id, coalesce(html, '') as body from pages),
f as (select page_id, body, strlen(body) as n, min(page_id) over (partition by body) as first from p)
select page_id, n as payload_bytes, sha256(body) as payload_digest,
  case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id <> first then first end as refers_to from f
""")
def op3_warc_normal(spark, sf_dir):
    return warc_normal.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    return toxic_kernel.toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels"))


@register("op5_lm_score")
def op5_lm_score(spark, sf_dir):
    return log_bilinear.score_texts(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op6_exact_dedup", f"""
with n as (select doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as body from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, sha256(body) as text_sha256
from n window w as (partition by body)
""")
def op6_exact_dedup(spark, sf_dir):
    return content_sort.content_groups(table(spark, sf_dir, "documents", "doc_id", "text"), keep="max")


@register("op7_benchmark_leaks")
def op7_benchmark_leaks(spark, sf_dir):
    return leak_simhash.leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"))


@register("op8_token_store")
def op8_token_store(spark, sf_dir):
    read = token_store.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path("word_bpe_49k.json"), 2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register("op9_near_dedup")
def op9_near_dedup(spark, sf_dir):
    return icws.near_classes(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "class_id", "class_size", "kept")


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


@register("op10_url_filter", url_vocabulary.oracle(URL_RULES, url_vocabulary.Vocabulary.read()))
def op10_url_filter(spark, sf_dir):
    return url_vocabulary.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules=URL_RULES)


@register("op11_repair_runs")
def op11_repair_runs(spark, sf_dir):
    return repair_runs.digest(repair_runs.periodic_runs(table(spark, sf_dir, "documents", "doc_id", "text"),
                                                        change=repair_runs.planted))


@register("op12_filter_audit", filter_audit.ORACLE)
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


@register("op13_prefix_join")
def op13_prefix_join(spark, sf_dir):
    return prefix_join.similar_documents(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_shingles", "component_id")
