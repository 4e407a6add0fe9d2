from __future__ import annotations

from conftest import SF_DIR
from pyspark.sql import functions as F

import corpus_pipeline
from sightline.llm import queries as Q
from sightline.llm.common import table


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_each_stage_acts_on_its_input(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)

    toxic = {r.doc_id for r in Q.op7_toxicity(spark, SF_DIR).filter("predicted = 1").collect()}
    kept = steps["toxicity"](spark, docs, SF_DIR)
    assert kept.columns == columns and ids(kept) == [i for i in ids(docs) if i not in toxic] and toxic

    passed = {r.doc_id for r in Q.op9_quality_rules(spark, SF_DIR).filter("kept").collect()}
    kept = steps["quality_rules"](spark, docs, SF_DIR)
    assert kept.columns == columns and ids(kept) == sorted(passed) and len(passed) < docs.count()

    first = Q.op1_simhash(spark, SF_DIR).filter("doc_id = component_id")
    kept = steps["simhash"](spark, docs, SF_DIR)
    assert kept.columns == columns and ids(kept) == ids(first) and kept.count() < docs.count()

    clean = Q.op10_decontamination(spark, SF_DIR).filter("not contaminated")
    kept = steps["decontamination"](spark, docs, SF_DIR)
    assert kept.columns == columns and ids(kept) == ids(clean) and kept.count() < docs.count()

    mixed = steps["mixing"](spark, docs, SF_DIR)
    assert ids(mixed) == ids(docs)


def test_run_is_the_stages_in_order(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF_DIR)
    out = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF_DIR)
    assert docs.count() == 0


def test_clashing_columns_pass_through(spark):
    docs = table(spark, SF_DIR, "documents")
    for name in ("fingerprint", "counts", "kept", "found", "score", "stratum", "node", "the_id", "cuts"):
        docs = docs.withColumn(name, F.lit("mine"))
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        assert kept.filter("fingerprint = 'mine' and the_id = 'mine'").count() == kept.count() > 0


def test_each_stage_bounds_the_rows_of_a_batch(spark):
    docs = table(spark, SF_DIR, "documents")
    for name, step in corpus_pipeline.STAGES:
        for setting, default, least in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "7"), ("spark.sql.parquet.columnarReaderBatchSize", "4096", "5")):
            for before, after in ((default, 1000), ("0", 1000), (least, int(least))):
                if before == "0" and "arrow" not in setting:
                    continue
                spark.conf.set(setting, before)
                step(spark, docs.limit(0), SF_DIR)
                assert 0 < int(spark.conf.get(setting)) <= after, (name, setting)
            spark.conf.set(setting, default)
