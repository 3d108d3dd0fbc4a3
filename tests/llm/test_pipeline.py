import corpus_pipeline
from ferrocar.llm import decontaminate, quality, simhash, toxicity
from tests.conftest import SMALL
from tests.llm.conftest import DOCS


def test_stages_take_effect(spark):
    docs, labels, items = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels", "benchmark"))
    ids = {r.doc_id for r in docs.collect()}

    def only(keep):
        return docs.where(docs.doc_id.isin(list(keep)))

    toxic = {r.doc_id for r in toxicity.scored(docs, labels).where("predicted = 1").collect()}
    left = ids - toxic
    left -= {r.doc_id for r in quality.scored(only(left), labels).where("predicted = 0").collect()}
    left = {r.component_id for r in simhash.near_duplicates(only(left)).collect()}
    left -= {r.doc_id for r in decontaminate.matches(only(left), items).collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == left and len(rows) == len(left) < len(ids)
    assert all(r.same for r in rows)


def test_stages_keep_the_columns(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.createDataFrame([(1, "some words", "en", "a", 10), (None, None, None, None, None)], DOCS)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, str(tmp_path)).columns == docs.columns
        assert step(spark, docs.limit(0), str(tmp_path)).count() == 0
