import random

import pytest
from pyspark.sql import functions as F

from paymart.llm import quality


def corpus(n=500, seed=8):
    """Prose, shouting, repetition and insults, and labels for half of them."""
    pick = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    rows, labels = [], []
    for i in range(n):
        prose = [pick.choice(words) for _ in range(pick.randrange(20, 80))]
        kind = "good" if i % 3 else pick.choice(["shout", "repeat", "toxic"])
        if kind == "shout":
            prose = [f"{w.upper()}!!" for w in prose]
        elif kind == "repeat":
            prose = [prose[0]] * len(prose)
        elif kind == "toxic":
            for _ in range(3):
                prose[pick.randrange(len(prose))] = pick.choice(["idiotic", "scummy"])
        rows.append((i, " ".join(prose), f"src{i % 4}"))
        if pick.random() < 0.6:
            labels.append((i, int(kind not in ("shout", "repeat")), int(kind == "toxic")))
    return rows, labels


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT")


def test_held_out_documents_are_told_apart(docs, labels):
    rows, known = corpus()
    model = quality.train(docs(*rows), labels(known), quality.is_good())
    judged = {r["doc_id"]: r["keep"] for r in quality.score_documents(docs(*rows), model).collect()}
    unknown = [i for i in range(len(rows)) if i not in {k[0] for k in known}]
    good, bad = [i for i in unknown if i % 3], [i for i in unknown if not i % 3]
    assert sum(judged[i] for i in good) >= 0.97 * len(good)
    assert sum(not judged[i] for i in bad) >= 0.9 * len(bad)
    kept = quality.kept(docs(*rows), model)
    assert kept.columns == docs(*rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in judged.items() if k}
    again = quality.train(docs(*rows), labels(known), quality.is_good())
    assert again.threshold == model.threshold and (again.content == model.content).all()


def test_odd_rows_are_scored(docs, labels):
    rows, known = corpus(150)
    model = quality.train(docs(*rows), labels(known + [(None, 1, 0), (9999, 0, 0), (3, None, None), (4, 1, 0), (4, 0, 0)]), quality.is_good())
    odd = docs((None, None), (1, ""), (1, ""), (2, "漢" * 50_000), (3, "a", None))
    found = quality.score_documents(odd, model).collect()
    assert len(found) == 5 and all(0 <= r["p_good"] <= 1 for r in found)
    without = odd.select("doc_id", "text")
    assert quality.score_documents(without, model).count() == 5
    assert quality.kept(without, model).columns == ["doc_id", "text"]
    assert quality.score_documents(docs(), model).collect() == []


def test_without_labels_nothing_is_rejected(docs, labels):
    rows, _ = corpus(40)
    for known in ([], [(i, 1, 0) for i in range(30)], [(i, 0, 0) for i in range(30)]):
        model = quality.train(docs(*rows), labels(known), quality.is_good())
        assert quality.kept(docs(*rows), model).count() == 40


def test_only_so_many_labels_are_used(docs, labels):
    rows, known = corpus(300)
    model = quality.train(docs(*rows), labels(known), quality.is_good(), labelled_rows=120, pool_rows=50)
    assert model.fitted


def test_good_is_of_quality_and_not_toxic(spark):
    rows = [(1, 0), (1, 1), (0, 0), (None, 0), (None, None), (1, None)]
    df = spark.createDataFrame(rows, "quality INT, toxic INT").select(quality.is_good())
    assert [r[0] for r in df.collect()] == [True, False, False, True, False, True]


def test_plan_reads_texts_once_for_scoring(docs, labels):
    rows, known = corpus(60)
    model = quality.train(docs(*rows), labels(known), F.lit(True))
    assert "Exchange" not in quality.score_documents(docs(*rows), model)._jdf.queryExecution().executedPlan().toString()


def test_all_confident_documents_without_a_label_are_handed_over(spark, docs, labels, monkeypatch):
    """A word that no labelled document holds is told by the metadata view, and only if no pool row is left out."""
    pick = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    rows, known = [], []
    for i in range(2400):
        bad = i % 3 == 0
        text = [pick.choice(words) for _ in range(40)]
        if i < 600:
            known.append((i, 1, int(bad)))
        elif bad:
            text[pick.randrange(40)] = "skeevish"
        rows.append((i if i < 1500 else None, " ".join(text), "bin" if bad else "shelf"))
    asked = []
    monkeypatch.setattr(quality, "handed_weights", lambda counts, f=quality.handed_weights: asked.append(counts) or f(counts))
    model = quality.train(docs(*rows), labels(known), quality.is_good())
    assert max(c[3] for c in asked) == 600 and max(c[2] for c in asked) == 1200  # 1800 rows, 900 of them without an id
    assert quality.plain_words(quality.pa.array(["skeevish"])).hashes[0] in model.words
