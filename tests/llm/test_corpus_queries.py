"""The registered corpus queries against their SQL, and the pipeline over the small tables."""

import re

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from kpiloom.llm import queries
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE[name]) == []


@pytest.mark.parametrize("name", ["op1_license_scan", "op2_mix_sources", "op6_ring_shards"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF_DIR)
        assert out.dtypes == docs.dtypes, name
        kept = out
    final = corpus_pipeline.run(spark, SF_DIR)
    assert final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    texts = sorted((r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect())
    assert texts == sorted((r["doc_id"], r["decoded"]) for r in final.select("doc_id", "decoded").collect())


ODD = [
    (1, "a b c", "x"),
    (1, "a b c", "x"),
    (2, None, "x"),
    (3, "", None),
    (4, " \t\n", "y"),
    (None, "a b c", "y"),
    (None, None, None),
    (5, "wörd " * 30_000, "y"),
    (6, "x" * 5_000, "z"),
    (7, "a<|endoftext|>b  c\n\n d é", "z"),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_pipeline_over_odd_rows(spark, tmp_path, rows):
    """Nulls, repeats, long texts, columns with names that stages use, and a table without rows."""
    schema = "doc_id long, text string, source string, size string, copies int, __hash long, dropped_words string"
    docs = spark.createDataFrame([(*r, "s", 9, 9, "d") for r in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, str(tmp_path))
        # Counts that a stage adds replace columns of their names; the others come back as they were.
        assert set(out.columns) <= set(docs.columns), name
        kept = spark.createDataFrame(out.collect(), out.schema)
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    texts = {r["text"] or "" for r in docs.collect()}
    assert all(r["decoded"] in texts for r in final)
    assert bool(final) == bool(rows)
