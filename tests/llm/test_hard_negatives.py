"""Hard negatives against a search of all pairs."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from paymart.llm import hard_negatives as hn
from paymart.llm.queries import QUERIES

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, score LONG, row STRING"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, low=80, high=100, k=5):
    """Every anchor against every row, in plain numbers."""
    rows = [
        (i, label, [math.floor(256 * float(x)) for x in vector])
        for i, vector, label in rows
        if i is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for at, (a, label, vector) in enumerate(rows):
        if not is_anchor(a):
            continue
        scored = sorted((-dot(vector, v), i, lab) for n, (i, lab, v) in enumerate(rows) if n != at)
        for minus, p, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(i, -m) for m, i, lab in scored if lab != label and low * -minus <= 100 * -m <= high * -minus]
            out += [(a, p, rank, i, -minus, s) for rank, (i, s) in enumerate(fit[:k], 1)]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 10 == 0, **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("options", [{}, {"block_rows": 16, "part_rows": 4}])
def test_equals_a_search_of_all_pairs(spark, options):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=6) * 0.3).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(150)]
    rows += [(500 + i, rows[20][1], i % 3) for i in range(12)]  # copies of one vector: ties
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and found(spark, rows, **options) == want


def test_nulls_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=4).astype(np.float32).tolist() for _ in range(40)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [rows[10], rows[10], rows[3], rows[3]]  # repeated anchor and candidate
    rows += [(None, vectors[0], 1), (50, None, 1), (60, vectors[1], None), (70, [1.0, None, 0.0, 0.0], 1)]
    rows += [(80, [float("nan"), 0.0, 0.0, 0.0], 1), (90, [float("inf"), 0.0, 0.0, 0.0], 0)]
    rows += [(100, [0.0, 0.0, 0.0, 0.0], 0), (110, [0.0] * 4, 1), (7, vectors[9], 0)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert found(spark, rows) == want == found(spark, rows, block_rows=8, part_rows=2)


def test_short_vectors_are_filled_with_zeros(spark):
    rows = [(0, [1.0, 1.0], 0), (1, [1.0], 0), (2, [0.9], 1), (3, [], 1)]
    full = [(i, v + [0.0] * (2 - len(v)), label) for i, v, label in rows]
    assert found(spark, rows) == brute(full, lambda i: i % 10 == 0) == [(0, 1, 1, 2, 65536, 58880)]


def test_large_components_stay_exact(spark):
    big = 2.0**20
    rows = [(0, [big, 1.0], 0), (1, [big, 3.0], 0), (2, [big, 2.0], 1), (3, [big, 1.0], 1)]
    assert found(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_no_rows_and_one_row(spark):
    assert found(spark, []) == [] == found(spark, [(0, [1.0], 1)])


def test_stops_before_the_end():
    """With one dimension that decides, most rows are never scored."""
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(size=(4096, 2)) * 100)
    vectors[:, 1] = 0
    scored = []

    class Counting(hn.SortedLists):
        def scores(self, picked, anchor):
            scored.append(len(picked))
            return super().scores(picked, anchor)

    lists = Counting(vectors)
    [(rows, scores)] = lists.best(np.array([7.0, 0.0]), np.ones(4096, bool), [(None, None)], np.arange(4096), 5)
    order = np.lexsort((np.arange(4096), -vectors[:, 0]))[:5]
    assert rows.tolist() == order.tolist() and scores.tolist() == (7 * vectors[order, 0]).astype(int).tolist()
    assert sum(scored) < 64


def test_window_ends_are_exact():
    assert [-(-80 * p // 100) for p in (1, 5, 6, -5)] == [math.ceil(Fraction(80 * p, 100)) for p in (1, 5, 6, -5)]


def test_query_on_the_small_table(spark, small_dir):
    rows = []
    for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect():
        label = r["label"]
        rows.append((r["vec_id"], r["embedding"], (label + 1) % 10 if label is not None and r["vec_id"] % 7 == 0 else label))
    got = QUERIES["op13_hard_negatives"](spark, small_dir)
    assert dict(got.dtypes)["rank"] == "int" and set(dict(got.dtypes).values()) == {"int", "bigint"}
    assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == brute(rows, lambda i: i % 100 == 0)
