import random

import numpy as np
import pyarrow as pa

from paymart.llm.decontaminate import align, benchmark_matches, decontaminated, plain_words

ITEM = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near a quiet river bend"


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id LONG, text STRING")


def noise(pick, n):
    return " ".join(f"{pick.choice('bcdfg')}{pick.choice('aeiou')}{pick.randrange(400)}" for _ in range(n))


def edited(pick, text, share):
    words = text.split()
    for k in pick.sample(range(len(words)), int(share * len(words))):
        words[k] = f"other{k}"
    return " ".join(words)


def test_copies_and_edited_copies_are_found_and_others_left(spark, docs):
    pick = random.Random(5)
    rows = [(i, noise(pick, 80)) for i in range(40)]
    rows += [(100, f"{noise(pick, 30)} {ITEM} {noise(pick, 30)}"), (101, ITEM.upper().replace(" ", "!! ")), (102, "x. " * 3000 + edited(pick, ITEM, 0.2))]
    rows += [(103, " ".join(w for k, w in enumerate(ITEM.split()) if k % 6)), (None, ITEM), (104, None), (105, ""), (100, ITEM)]
    rows += [(106, "the quick brown fox sat"), (107, "over the lazy dog")]
    items = bench(spark, ITEM, "", None, noise(pick, 20), "zz yy")
    found = benchmark_matches(docs(*rows), items).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["100", "100", "101", "102", "103", "None"]
    assert {r["item_id"] for r in found} == {0}
    whole = next(r for r in found if r["doc_id"] == 100 and r["start_word"] > 0)
    assert (whole["score"], whole["start_word"], whole["end_word"]) == (1.0, 30, 30 + len(ITEM.split()))
    kept = decontaminated(docs(*rows), items)
    assert kept.columns == docs(*rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        str(i) for i, _ in rows if i not in (100, 101, 102, 103, None)
    )


def test_short_items_and_empty_tables(spark, docs):
    found = benchmark_matches(docs((1, "a zz yy b"), (2, "yy zz")), bench(spark, "zz yy")).collect()
    assert [(r["doc_id"], r["score"]) for r in found] == [(1, 1.0)]
    assert benchmark_matches(docs((1, "a b c")), bench(spark)).collect() == []
    assert benchmark_matches(docs(), bench(spark, ITEM)).collect() == []
    assert decontaminated(docs((1, "a b c")), bench(spark)).count() == 1


def test_a_passage_in_most_documents_is_still_found(spark, docs):
    pick = random.Random(6)
    rows = [(i, f"{noise(pick, 10)} {ITEM}") for i in range(30)] + [(99, edited(pick, ITEM, 0.15))]
    assert len(benchmark_matches(docs(*rows), bench(spark, ITEM)).collect()) == 31


def slow_score(a, b):
    table, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
            best = max(best, table[i][j])
    return best


def test_alignment_equals_the_plain_recurrence():
    pick = np.random.default_rng(1)
    items, texts = pick.integers(2, 6, (40, 12)).astype(np.uint64), pick.integers(2, 6, (40, 25)).astype(np.uint64)
    items[:, 9:][::3] = 0
    texts[:, 20:][::4] = 1
    assert align(items, texts)[0].tolist() == [slow_score(a.tolist(), b.tolist()) for a, b in zip(items, texts, strict=True)]


def test_plain_words_fold_case_and_marks():
    one, two = plain_words(pa.array(["ÉCOLE, d'été!! A-b"])).hashes, plain_words(pa.array(["école d été a b"])).hashes
    assert one.tolist() == two.tolist()


def test_a_passage_of_a_long_item_is_found(spark, docs):
    pick = random.Random(9)
    item = noise(pick, 500)
    passage = " ".join(item.split()[200:350])
    rows = [(1, f"{noise(pick, 40)} {passage} {noise(pick, 60)}"), (2, edited(pick, passage, 0.1)), (3, noise(pick, 300))]
    found = {r["doc_id"]: r for r in benchmark_matches(docs(*rows), bench(spark, item)).collect()}
    assert sorted(found) == [1, 2] and found[1]["score"] == 0.3
    assert (found[1]["start_word"], found[1]["end_word"]) == (40, 190)
    assert [r["doc_id"] for r in decontaminated(docs(*rows), bench(spark, item)).collect()] == [3]


def test_short_items_of_common_words_match_nearly_whole(spark, docs):
    pick = random.Random(10)
    rows = [(i, f"{noise(pick, 15)} what is the {noise(pick, 15)} the capital of {noise(pick, 5)}") for i in range(30)]
    rows += [(100, f"{noise(pick, 9)} What is the capital of France? {noise(pick, 9)}")]
    items = bench(spark, "what is the capital of france", "the", "what is")
    found = benchmark_matches(docs(*rows), items).collect()
    assert [r["doc_id"] for r in found if r["item_id"] == 0] == [100]
    assert len([r for r in found if r["item_id"] == 1]) == 31
    assert sorted(r["doc_id"] for r in decontaminated(docs(*rows), items).collect()) == list(range(30))
