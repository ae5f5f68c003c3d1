"""The pipeline's stages on given tables, and the registration."""

import re

import __spark_entry__ as entry
import corpus_pipeline
from ripen.llm import decontaminate, quality_classifier, simhash
from ripen.sources.load import table

from .conftest import rows_of, sentence

SF = "/root/testdata/sf0.01"


def test_one_query_for_each_operator_and_the_pipeline():
    names = entry.queries()
    assert [n for n in range(1, 11) if sum(bool(re.match(rf"op{n}_", x)) for x in names) != 1] == []
    assert names["pipeline"] is corpus_pipeline.run


def test_stages_take_effect_on_all_that_came(spark):
    docs = table(spark, SF, "documents").persist()
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF).persist()
        seen.append((docs, out))
        if k < 4:
            assert out.columns == columns
            assert out.join(docs, columns, "left_anti").count() == 0
            assert 0 < out.count() < docs.count()
        docs = out
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    before, after = seen[0]
    scored = quality_classifier.score_documents(before, table(spark, SF, "labels"))
    assert ids(after) == ids(scored.where("predicted = 1"))
    before, after = seen[1]
    groups = simhash.near_duplicates(before).collect()
    assert ids(after) == {r["component_id"] for r in groups} and after.count() == len(ids(after))
    before, after = seen[2]
    found = decontaminate.find_contamination(before, table(spark, SF, "benchmark"))
    assert ids(before) - ids(after) == ids(found.where("n_hit > 0 and 20 * n_hit >= n_words"))
    before, after = seen[4]
    assert ids(before) == ids(after) and {"shard", "slot", "size"} <= set(after.columns)


def test_stages_of_hard_cases_and_of_nothing(spark, corpus, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (corpus, corpus.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            n = out.count()
            assert n <= docs.count() and (k > 3 or out.columns == corpus.columns)
            docs = out.persist()


def test_stages_judge_rows_with_null_and_repeated_ids_one_by_one(spark, tmp_path, monkeypatch):
    bad, near = sentence(900, 60), sentence(1, 400)
    copy = near.replace(" ", "\n", 3)
    texts = [sentence(5, 44), bad, near, copy]
    docs = spark.createDataFrame([(i, t) for i in (None, 7) for t in texts], "doc_id long, text string")
    spark.createDataFrame([(1, bad)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = rows_of(corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)), "doc_id", "text")
    assert got == rows_of(docs.where(docs.text != bad), "doc_id", "text")
    for ids in ("doc_id is null", "doc_id = 7", "true"):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs.where(ids), str(tmp_path)).collect()
        assert len(kept) == 3 and {r["text"] for r in kept} in ({*texts} - {near}, {*texts} - {copy})
        assert len({r["doc_id"] for r in kept}) == 1 and (ids != "true" or kept[0]["doc_id"] == 7)
    score = quality_classifier.score_documents

    def verdicts(*args, **kw):
        out = score(*args, **kw)
        return out.withColumn("predicted", (out["key"] % 2 == 0).cast("int"))
    monkeypatch.setattr(quality_classifier, "score_documents", verdicts)
    got = rows_of(corpus_pipeline.keep_quality(spark, docs, str(tmp_path)), "doc_id", "text")
    assert got == rows_of(docs.where("xxhash64(text) % 2 = 0"), "doc_id", "text") and 0 < len(got) < 8


def test_quality_stage_without_positives_rejects_nothing(spark, corpus, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.keep_quality(spark, corpus, str(tmp_path)).count() == corpus.count()
