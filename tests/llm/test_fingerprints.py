import hashlib
import random
from collections import Counter

from paymart.llm.fingerprints import fingerprints


def similarity(a, b):
    a, b = Counter(a.encode().split()), Counter(b.encode().split())
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


def test_edited_text_likeness_and_equal_texts(docs):
    pick = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "漢字"]
    texts = [" ".join(pick.choices(vocabulary, k=pick.randrange(1, 150))) for _ in range(60)] + ["", None, "x" * 4000, "a  b\t\n" * 40]
    texts += [texts[0], " ".join(reversed(texts[0].split()))]
    ids = [3 * i for i in range(len(texts))]
    found = {r["doc_id"]: r for r in fingerprints(docs(*zip(ids, texts, strict=True))).collect()}
    assert len(found) == len(texts)
    errors = []
    for k, (i, text) in enumerate(zip(ids, texts, strict=True)):
        text, following, row = text or "", texts[(k + 1) % len(texts)] or "", found[i]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors += [row["near_edited"] - similarity(text, edited), row["near_next"] - similarity(text, following)]
    assert abs(sum(errors) / len(errors)) < 0.02 and max(map(abs, errors)) < 0.35
    assert found[0]["fingerprint"] == found[ids[-2]]["fingerprint"] == found[ids[-1]]["fingerprint"]
    assert found[ids[60]]["fingerprint"] == found[ids[61]]["fingerprint"] == "" and found[ids[60]]["near_next"] == 1.0


def test_share_of_equal_samples_is_the_weighted_similarity(docs):
    pairs = [("a " * m + "b " * 5, "a " * n + "c " * 5) for m, n in ((10, 10), (10, 20), (3, 30))]
    rows = [(2 * k + side, text) for k, pair in enumerate(pairs) for side, text in enumerate(pair)]
    found = {r["doc_id"]: r["near_next"] for r in fingerprints(docs(*rows), samples=400).collect()}
    for k, pair in enumerate(pairs):
        assert abs(found[2 * k] - similarity(*pair)) < 0.09


def test_nulls_repeats_and_single_documents(docs):
    found = fingerprints(docs((None, "a b c d"), (1, "e f g h"), (1, "e f g h"), (1, "i j"), (None, None))).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in found) == [("1", 3), ("1", 7), ("None", 0), ("None", 7)]
    [row] = fingerprints(docs((7, "a b c d"))).collect()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest()
    assert fingerprints(docs()).collect() == []
