from collections import Counter

import corpus_pipeline
import numpy as np
from lodestar.llm import quality, simhash
from lodestar.llm.common import staged
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
    assert "pipeline" in entry.queries()


def test_stages_keep_columns_and_take_effect(spark, documents):
    docs, seen = documents, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = staged(stage(spark, docs, SF), f"test-stage-{k}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before, name
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == documents.columns
        if name == "SimHash near-dedup":
            groups = simhash.near_duplicates(seen["quality classifier"]).select("component_id").distinct().count()
            assert docs.count() == groups
            assert simhash.near_duplicates(docs).select(F.count_distinct("component_id")).first()[0] == groups
        seen[name] = docs
    mixed = Counter(r.doc_id for r in seen["mixing to target weights"].collect())
    packed = Counter(r.doc_id for r in docs.where("piece = 0").collect())
    assert mixed == packed and max(mixed.values()) <= 3


def test_filters_keep_all_clean_documents(spark, documents):
    rows = documents.collect()
    by = {lang: " ".join(r.text for r in rows if r.lang == lang and r.text).split() for lang in ("en", "fr", "de", "es")}
    mixed = " ".join(by["en"][:450] + by["fr"][:300] + by["de"][:250])  # no language has half of it
    even = " ".join(w for lang in by for w in by[lang][:250])
    added = [(10**9 + i, t) for i, t in enumerate([mixed, even, "12 % 34", None])]
    extra = spark.createDataFrame([tuple({"doc_id": i, "text": t}.get(c) for c in documents.columns) for i, t in added],
                                  documents.schema)
    docs = documents.unionByName(extra)
    known = staged(corpus_pipeline.language_id(spark, docs, SF), "test-known")
    want = {r.doc_id: r.text for r in docs.collect() if any(c.isalpha() for c in (r.text or "").lower())}
    kept = [r.doc_id for r in known.select("doc_id").collect()]
    assert sorted(kept) == sorted(want) and {10**9, 10**9 + 1} <= set(kept)
    weights, bias = quality.train(known, spark.read.parquet(f"{SF}/labels.parquet"))
    score = dict(zip(want, 1 / (1 + np.exp(-quality.logits(list(want.values()), weights, bias)))))
    good = [r.doc_id for r in corpus_pipeline.quality_filter(spark, known, SF).select("doc_id").collect()]
    assert sorted(good) == sorted(i for i, s in score.items() if s >= quality.CUT) and good


def test_pipeline_of_awkward_rows(spark, awkward, nothing):
    for rows in (awkward, nothing):
        docs = rows
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = staged(stage(spark, docs, SF), f"test-awkward-{k}")
            if k < 4:
                assert docs.columns == rows.columns, name
