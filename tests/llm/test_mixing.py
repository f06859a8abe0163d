from collections import Counter

from pyspark.sql import functions as F

from paymart.llm import mixing


def mixed(df, **options):
    return mixing.mix_sources(df, mixing.word_count(F.col("text")), **options).collect()


def test_budgets_are_met_exactly(docs):
    rows = [(i, "w " * (i % 7), ["a", "b", None, "c"][i % 4]) for i in range(400)] + [(None, None, "a"), (5, "x y", "a"), (5, "x y", "a")]
    found = mixed(docs(*rows), rows_per_range=16)
    assert len(found) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    for r in found:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert {s: r["source_size"] for r in found for s in [r["source"]]} == dict(size)
    assert all(taken[s] == int(target[s]) <= 2 * size[s] for s in size)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert target["a"] == 2 * size["a"]  # weighs 5 and stops at twice its size
    again = mixed(docs(*rows), rows_per_range=16)
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_nothing_to_take(docs):
    assert mixed(docs()) == []
    found = mixed(docs((1, "", "a"), (2, None, None)))
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(0, 0.0, 0)] * 2


def test_words_end_at_six_bytes_only(spark):
    df = spark.createDataFrame([("a b c\x1cd\x0be\x0cf\tg\r\nh  ",), ("  ",), (None,)], "text STRING")
    assert [r[0] for r in df.select(mixing.word_count(F.col("text"))).collect()] == [6, 0, 0]


def test_other_columns_come_along(docs):
    found = mixed(docs((1, "a b", "s")), keep=("text", "lang", "n_chars"))
    assert found[0]["text"] == "a b" and found[0]["taken"] == 3


def test_clashing_columns_come_along_under_another_name(docs):
    df = docs((1, "a b", "s"), (2, None, None), (None, "x", "s")).selectExpr(
        "*", "'k' AS key", "'t' AS taken", "'f' AS fine", "'c' AS coarse", "'u' AS _taken", "'d' AS `a.b`", "'kept' AS kept", "1 AS target"
    )
    keep = tuple(c for c in df.columns if c not in ("doc_id", "source"))
    found = {r["doc_id"]: r.asDict() for r in mixed(df, keep=keep)}
    assert found[1]["size"] == 2 and 2 <= found[1]["taken"] <= 4 and found[1]["_size"] == 1
    assert (found[1]["key"], found[1]["__taken"], found[1]["_taken"], found[1]["a.b"], found[1]["_target"]) == ("k", "t", "u", "d", 1)
    assert found[None]["text"] == "x" and found[2]["size"] == 0
    assert sum(r["taken"] for r in found.values()) == int(next(r["target"] for r in found.values() if r["source"] == "s"))


def test_rows_without_an_id_spread_over_the_keys(docs):
    found = docs(*[(None, f"text {i} " * (i % 5 + 1), "a") for i in range(300)])
    taken = mixed(found, keep=("text",), weights=(1,), share=0.5, rows_per_range=16)
    assert sum(r["taken"] for r in taken) == sum(r["size"] for r in taken) // 2
    assert len({bool(r["taken"]) for r in taken}) == 2
