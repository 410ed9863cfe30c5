"""The pipeline: its stages on odd rows, each on its own input, and the whole on the tables."""

import hashlib

import corpus_pipeline as pipeline
from firmlens.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_survive_odd_rows(spark, odd, nothing, sf_dir):
    for name, stage in pipeline.STAGES:
        for docs in (odd, odd.select(*COLUMNS), nothing):
            made = stage(spark, docs, sf_dir)
            if name != pipeline.STAGES[-1][0]:
                assert made.columns == docs.columns, name
            assert made.count() <= 2 * docs.count(), name


def test_run_is_the_chain_of_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first, ids = docs, []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        docs = Scratch(spark, "chain").put(stage(spark, docs, sf_dir), "out")
        ids.append(sorted(r["doc_id"] for r in docs.select("doc_id").collect()))
    assert set(ids[0]) < {r["doc_id"] for r in first.collect()}  # toxic ones went
    assert ids[1] == ids[0] and set(ids[2]) < set(ids[1]) and set(ids[3]) <= set(ids[2])

    def digest(df):
        return sorted((r["doc_id"], hashlib.md5(str(r["tokens"]).encode()).hexdigest())
                      for r in df.collect())

    assert digest(pipeline.run(spark, sf_dir)) == digest(docs)
    assert docs.where("not round_trip").count() == 0
