"""The stages of the pipeline against plain versions of them."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lattica.llm import decontam, minhash, packing, quality

from .test_lines_and_quality import plain_lines
from .test_minhash import plain


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_names_and_columns(spark, sf_dir, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(after.columns == columns for _, after in stages[:-1])


def test_quality_stage(stages):
    before, after = stages[0]
    verdicts = quality.judged(before, carry=["doc_id"]).filter("__keep")
    assert rows(after, "doc_id") == rows(verdicts, "doc_id")
    assert 0 < after.count() < before.count()


def test_line_stage(stages):
    before, after = stages[1]
    own = before.orderBy("doc_id").collect()
    expected = plain_lines([(r["text"], r["source"]) for r in own], 0.1)
    assert rows(after, "doc_id", "text", "n_chars") == [(r["doc_id"], t, len(t)) for r, t in zip(own, expected, strict=True)]


def test_near_dedup_stage(stages):
    before, after = stages[2]
    groups = plain([(r["doc_id"], r["text"]) for r in before.collect()], 5, 80)
    assert rows(after, "doc_id") == sorted((d,) for d, (_, top) in groups.items() if d == top)


def test_decontamination_stage(spark, sf_dir, stages):
    before, after = stages[3]
    bench = [decontam.normalised(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    exact = {r["doc_id"] for r in before.collect() if any(b in decontam.normalised(r["text"] or "") for b in bench)}
    gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()}
    assert exact <= gone and len(gone) <= len(exact) + 2


def test_packing_stage(stages):
    before, after = stages[4]
    packed = after.groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert rows(packed, "doc_id", "n") == rows(before.withColumn("n", packing.byte_tokens()), "doc_id", "n")


def test_run(spark, sf_dir, stages):
    assert rows(corpus_pipeline.run(spark, sf_dir), "doc_id", "piece", "bin_id") == rows(stages[4][1], "doc_id", "piece", "bin_id")


def test_near_dedup_query_equals_brute_force(spark, sf_dir):
    from lattica.llm import queries

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op8_minhash_dedup(spark, sf_dir).collect()}
    assert got == plain(docs, 3, 85)
    assert minhash.Settings(width=3, percent=85) == queries.OP8
