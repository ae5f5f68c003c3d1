"""Corpus pipeline: quality classifier, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and reads all that its predecessor kept;
all but the last return the columns of ``documents``.  The caller writes each
stage's result as Parquet and reads it again for the next; ``run`` cuts the
lineage between stages by a checkpoint in the shared folder.

Nulls: a null text is empty for every stage; rows with a null or a repeated id are
judged one by one, by id and text hash, and equal rows share a verdict.  Without any
label of quality 1 the first stage rejects nothing; without benchmark items the third
keeps all.  The mixing stage counts a null language or source as ``unknown``.  An empty table
passes through every stage empty, with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ripen.llm import decontaminate, mixing, quality_classifier, sharding, simhash
from ripen.llm.queries import DOMAIN, MIX, SHARDS
from ripen.session import cut_lineage
from ripen.sources.load import table

MIX_SHARE = 0.75                # of the tokens that reach the mixing stage


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not reject; without any positive it rejects none."""
    scored = quality_classifier.score_documents(docs, table(spark, sf_dir, "labels"), keyed=True)
    return _only(docs, scored.where("predicted = 1 or predicted is null"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id (null last), then the smallest text hash."""
    return _only(docs, simhash.representatives(docs, shingle=4, distance=4)).dropDuplicates(["doc_id", "text"])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 lies in a benchmark window."""
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("key")).alias("row"), "text")
    found = decontaminate.find_contamination(keyed, table(spark, sf_dir, "benchmark"), id_col="row", window=13)
    return _only(docs, found.where(~decontaminate.contaminated()).select("row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf's token-prefix of one seeded epoch, by the weights of the mixing query."""
    return mixing.mix(docs, MIX_SHARE, MIX, F.expr(DOMAIN), seed=17, max_epochs=1).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, shard and slot."""
    return sharding.assign_shards(docs, SHARDS, sharding.text_size("text"), order=("text",))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose id and text hash (key) are kept; a null id matches a null id.

    Each verdict follows from the text alone, so rows with equal id and text share it.
    """
    rows = kept.select(F.col("doc_id").alias("__kept_id"), F.col("key").alias("__kept_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__kept_id")) & (F.xxhash64("text") == F.col("__kept_key"))
    return docs.join(rows, same, "left_semi")


STAGES = [("quality classifier", keep_quality), ("simhash near-dedup", drop_near_duplicates), ("benchmark decontamination", drop_contaminated),
          ("mixing sources", mix_sources), ("sharding", shard)]

#: XXH64 and the classifier's network have no SQL form: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
