"""Every stage of the pipeline on rows that no table should have."""

import corpus_pipeline
import pytest

CLASHING = ["copy_id", "copy_hash", "in_doc", "found_secrets", "key", "size", "taken", "target", "label", "features", "block", "row", "a.b"]


@pytest.fixture(scope="module")
def odd(spark, small_dir):
    """The small table, and rows that repeat, share ids or have none, empty, null and very long texts, clashing names."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    first = [tuple(r) for r in docs.orderBy("doc_id").limit(3).collect()]
    text = first[0][1]
    more = [first[0], first[0], (None, text, None, None, None), (None, None, None, None, None), (None, None, None, None, None)]
    more += [(first[1][0], "another text of that id " * 20, "en", "web", 480), (10**9, "", "en", None, 0), (10**9 + 1, "w " * 200_000, "en", "web", 400_000)]
    odd = docs.unionByName(spark.createDataFrame(more, docs.schema))
    return odd.selectExpr("*", *[f"CAST('{c}' AS STRING) AS `{c}`" for c in CLASHING])


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_takes_odd_rows(spark, small_dir, odd, name, stage):
    out = stage(spark, odd, small_dir)
    rows = out.collect()
    assert rows
    if name == "source_mixing":
        assert all(r["taken"] > 0 for r in rows) and set(odd.columns) - {"size", "taken", "target"} <= set(out.columns)
        return
    assert out.columns == odd.columns
    assert all(r[c] == c for r in rows for c in CLASHING)
    if name == "secret_masking":
        assert len(rows) == odd.count()
    if name == "near_duplicate_removal":
        words = [(r["doc_id"], r["text"]) for r in rows if r["text"] and r["text"].split()]
        assert len(words) == len(set(words))
    # a null text, an empty one and the very long one are no copies and hold nothing of the benchmark
    if name in ("near_duplicate_removal", "benchmark_decontamination"):
        assert sum(r["text"] is None for r in rows) == 2 and {10**9, 10**9 + 1} <= {r["doc_id"] for r in rows}


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_takes_an_empty_table(spark, small_dir, odd, name, stage):
    out = stage(spark, odd.limit(0), small_dir)
    assert out.collect() == []
    if name != "source_mixing":
        assert out.columns == odd.columns
