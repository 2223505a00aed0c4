from pyspark.sql import functions as F

import corpus_pipeline as cp
from lendlens.llm.simhash import fingerprint

from . import cases
from .test_packing import checked
from .test_pii import brute as pii
from .test_simhash import brute_components
from ..conftest import SF_SMALL


def test_stages_take_effect_on_awkward_rows(spark):
    docs = cases.clashing(cases.awkward(spark).union(cases.documents(spark).select(
        "doc_id", "text", "lang", "source", F.col("n_chars").cast("int")).withColumn("doc_id", F.col("doc_id") + 1000)),
        "quality", "contamination", "pii", "simhash_f")
    for name, stage in cp.STAGES:
        before = docs.collect()
        docs = cp.cut(stage(spark, docs, SF_SMALL), name)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == [*cases.SCHEMA.replace(",", "").split()[::2], "quality", "contamination", "pii", "simhash_f"]
        if name == "quality":
            assert after and all(len(r["text"].split()) >= 50 for r in after)
        elif name == "near_duplicates":
            want = brute_components([(r["doc_id"], fingerprint(r["text"]) % (1 << 64)) for r in before])
            assert {r["doc_id"] for r in after} == set(want.values()) and len(after) == len(set(want.values()))
        elif name == "pii":
            assert len(after) == len(before) and not any(pii(r["text"]) for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after if "<" in r["text"] and ">" in r["text"] and pii(
                next(b["text"] for b in before if b["doc_id"] == r["doc_id"])))
        elif name == "packing":
            assert checked(after, 2048) and {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_empty_documents(spark, tmp_path):
    cases.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
