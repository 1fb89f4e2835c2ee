import random

import __spark_entry__
import corpus_pipeline
from hindcast.llm.common import settled
from hindcast.llm.order_minhash import near_classes
from hindcast.llm.queries import QUERIES, SQL

from llm_helpers import DOCS, SF, prose


def test_every_operator_is_registered():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())


def test_stages_on_planted_rows(spark, tmp_path):
    rng = random.Random(12)
    rows = []
    for i in range(600):
        text = prose(rng, rng.randrange(60, 200))
        if i % 6 == 0:
            text = " ".join(w + "###" for w in text.split())
        rows.append([i, text, "en", f"s{i % 4}", len(text)])
    item = prose(rng, 40)
    rows[31][1] += " " + item
    rows[41][1] = rows[40][1]
    rows[43][1] = rows[44][1].replace(" ", " also ", 1)
    rows[51][1] = " ".join(rows[51][1].split()[:30])
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 6 != 0), 0) for i in range(0, 600)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = [set(range(600))]
    for name, stage in corpus_pipeline.STAGES:
        out = settled(stage(spark, docs, str(tmp_path)), "test")
        if name != "mixing":
            assert out.columns == docs.columns
        docs = out
        ids.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    assert ids[1] == {i for i in range(600) if i % 6}
    assert ids[1] - ids[2] == {51}
    assert ids[2] - ids[3] == {41, 44} and ids[3] - ids[4] == {31}
    assert ids[4] == ids[5] and docs.agg({"taken": "sum"}).first()[0] > 0


def test_stages_on_awkward_and_empty_rows(spark, awkward, no_docs, tmp_path):
    for given in (awkward.drop("size", "node", "score", "x"), no_docs):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = settled(stage(spark, docs, SF), "test")
            assert name == "mixing" or docs.columns == given.columns


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert near_classes(spark.read.parquet(f"{SF}/documents.parquet")).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
