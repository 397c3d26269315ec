import corpus_pipeline
from pyspark.sql import functions as F

from shopstream.llm import common
from tests.llm import tables
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_neardup import brute as groups
from tests.llm.test_packing import check
from tests.llm.test_pii import brute as found_in


def test_stages_one_by_one(spark):
    """Each stage's decisions, against brute force on what the one before kept."""
    sf = "/root/testdata/sf0.01"  # enough labels to learn from
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r for r in docs.collect()}
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = common.written(stage(spark, docs, sf))
        assert docs_after.columns == docs.columns and docs_after.dtypes == docs.dtypes
        rows = {r["doc_id"]: r for r in docs_after.collect()}
        texts = [(i, r["text"]) for i, r in before.items()]
        if name == "quality_classifier":
            good = [i for i in before if labels.get(i) == 1]
            assert sum(i in rows for i in good) > 0.95 * len(good)
            assert sum(i in rows for i in before if labels.get(i) == 0) < 0.3 * sum(labels.get(i) == 0 for i in before)
        if name == "near_duplicates":
            assert set(rows) == {i for i, _, _, kept in groups(texts) if kept}
        if name == "benchmark_decontamination":
            assert set(rows) == {r[0] for r in hits(texts, items) if not r[-1]}
        if name == "personal_data":
            assert set(rows) == set(before)
            assert not any(found_in(r["text"]) for r in rows.values())
            assert all(rows[i]["text"] == r["text"] for i, r in before.items() if not found_in(r["text"]))
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        docs, before = docs_after, rows
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    check(packed.collect(), [(i, r["text"]) for i, r in before.items()])
    whole = corpus_pipeline.run(spark, sf).agg(F.countDistinct("doc_id"), F.sum("length")).first()
    assert tuple(whole) == tuple(packed.agg(F.countDistinct("doc_id"), F.sum("length")).first())


def test_odd_documents(spark, tmp_path):
    sf = str(tmp_path)
    tables.documents(spark, tables.odd()).write.parquet(f"{sf}/documents.parquet")
    tables.empty(spark, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    tables.empty(spark, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 6, 7, 8, 9}
    tables.empty(spark, tables.DOCS).write.parquet(f"{sf}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{sf}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{sf}/none").count() == 0
