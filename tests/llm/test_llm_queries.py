"""The registered queries on the small tables: against SQL, and what it cannot say by other means."""

import hashlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from paymart.llm.oracles import ORACLES
from paymart.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small_dir}/{table}.parquet'")
    df = QUERIES[name](spark, small_dir)
    columns = sorted(df.columns)
    found = Counter(tuple(r[c] for c in columns) for r in df.collect())
    want = Counter(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())
    assert found == want and found


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["op1_secret_scans", "op3_fingerprints", "op4_source_mixing"])
def test_native_queries_run_no_python(spark, small_dir, name):
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_pipeline_stage_by_stage(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = stage(spark, docs, small_dir)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        rows = docs.collect()
        counts.append(len(rows))
        assert {r["doc_id"] for r in rows} <= set(before)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "secret_masking":
            assert len(rows) == counts[-2] and not any('token = "' in (r["text"] or "") and len(r["text"].split('token = "')[1]) > 40 and r["text"].split('token = "')[1][:40].isalnum() for r in rows)
        elif name != "source_mixing":
            assert all(r["text"] == before[r["doc_id"]] for r in rows)
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] >= counts[5] > 0
    whole = corpus_pipeline.run(spark, small_dir)
    assert {(r["doc_id"], r["taken"]) for r in whole.collect()} == {(r["doc_id"], r["taken"]) for r in rows}


def test_digests_are_those_of_whole_texts(spark, small_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    for r in QUERIES["op2_substring_dedup"](spark, small_dir).collect():
        words = (texts[r["doc_id"]] or "").encode().split()
        assert r["n_words"] == len(words)
        if not r["n_removed"]:
            assert r["kept_sha256"] == hashlib.sha256(b" ".join(words)).hexdigest()
