import hashlib

import corpus_pipeline
import numpy as np
from conftest_llm import DOCUMENTS, awkward_rows, prose

from ledgerloop.llm import bpe


def test_stages_are_in_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "simhash near-dedup", "mixing", "bpe"]


def test_each_stage_keeps_the_columns(spark, ws):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = ws.materialize(stage(spark, docs, folder), name.split()[0])
        assert docs.columns == columns
        if name != "mixing":
            assert docs.count() <= n
            n = docs.count()


def test_the_result_decodes_to_the_mixed_texts(spark, folder):
    boiler = "Terms of use apply to all pages."
    rows = [(k, prose(k, 120) + f"\n{boiler}", "en", f"s{k % 14}", 0) for k in range(60)]
    rows += [(100 + k, prose(5, 120) + f" x{k}\n{boiler}", "en", "s1", 0) for k in range(10)]
    path = folder(rows + awkward_rows(), extra=True)
    found = corpus_pipeline.run(spark, path).collect()
    codec = bpe.Codec(bpe.vocabulary())
    assert found
    for r in found:
        ids = np.array(r.ids, dtype="<u4").tobytes()
        text = codec.decode(ids)
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (boiler in text) == (r.doc_id == 0) or r.doc_id in (3, 7)
    kept = {r.doc_id for r in found}
    assert len(kept & {5, *range(100, 110)}) <= 1


def test_empty_documents(spark, folder):
    path = folder()
    assert spark.read.parquet(f"{path}/documents.parquet").schema == DOCUMENTS
    assert corpus_pipeline.run(spark, path).collect() == []


def test_stages_pass_on_columns_of_any_name_and_type(spark, ws, folder):
    """Dots, quotes, helper names, and maps, which have no order."""
    from pyspark.sql import functions as F

    path = folder([(k, prose(k % 40, 60), "en", f"s{k % 3}", 0) for k in range(60)], extra=True)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs = docs.withColumn("m.x", F.create_map(F.lit("k"), F.col("doc_id")))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = ws.materialize(stage(spark, docs, path), name.split()[0])
        assert docs.columns == columns
        for r in docs.collect():
            assert r["m.x"] == {"k": r["doc_id"]} and r["a.b"] == r["q`r"] == r["__ll_id"] == "clash"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() > 0
