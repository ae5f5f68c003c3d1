"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.load import table
from . import (decontaminate, filter_audit, html_extract, mixing, phrases, quality_classifier, quality_rules, sharding, simhash,
               substring_dedup, suffix_dedup, token_counts, url_filter)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: fixed values of the URL filter: (action, host/path)
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
SHARDS = 40
#: documents have no domain: sources are dealt to four by their number
DOMAIN = "'d' || (try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4)"
MIX = {"domain": {"d0": 2.0, "*": 1.0}, "lang": {"en": 3.0, "*": 1.0}, "source": {"*": 1.0}}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query("op1_substring_dedup")
def op1(spark, sf_dir):
    kept = substring_dedup.remove_repeats(documents(spark, sf_dir), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_simhash_dedup")
def op2(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op3_token_counts")
def op3(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), token_counts.load_vocabulary())


@query("op4_sharding")
def op4(spark, sf_dir):
    slim = documents(spark, sf_dir).select("doc_id", sharding.text_size("text").alias("bytes"), sharding.text_crc("text").alias("text_crc32"))
    return (sharding.assign_shards(slim, SHARDS, F.col("bytes"), order=("bytes", "text_crc32"))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


@query("op5_mixing")
def op5(spark, sf_dir):
    return (mixing.mix(documents(spark, sf_dir), 0.5, MIX, F.expr(DOMAIN), seed=17, max_epochs=2)
            .select("doc_id", "domain", "lang", "source", "n_tokens", "copies"))


@query("op6_url_filter")
def op6(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op7_html_extraction")
def op7(spark, sf_dir):
    return html_extract.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op8_decontamination")
def op8(spark, sf_dir):
    found = decontaminate.find_contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), window=13)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


@query("op9_quality_rules")
def op9(spark, sf_dir):
    docs = documents(spark, sf_dir)
    ratios = quality_rules.log_ratios(docs, table(spark, sf_dir, "labels").where("quality = 1"))
    return quality_rules.score(docs, ratios)


@query("op10_quality_classifier")
def op10(spark, sf_dir):
    return quality_classifier.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op11_suffix_dedup")
def op11(spark, sf_dir):
    kept = suffix_dedup.remove_earlier(documents(spark, sf_dir), window=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_filter_audit")
def op12(spark, sf_dir):
    masks = filter_audit.failure_masks(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return filter_audit.interaction_audit(masks)


@query("op13_phrase_collocations")
def op13(spark, sf_dir):
    frequent, totals = phrases.frequent_phrases(documents(spark, sf_dir), least=30, longest=4)
    return phrases.collocations(frequent, totals, top=2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
