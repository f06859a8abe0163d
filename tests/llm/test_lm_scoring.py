import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paymart.llm.lm_scoring import ALPHA, KAPPA, cross_entropy_difference


def brute(rows, good):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    models = []
    for chosen in (good, {i for i, _ in rows}):
        words, pairs = Counter(), Counter()
        for i, w in texts:
            if i in chosen:
                words.update(w)
                pairs.update(zip(w, w[1:], strict=False))
        models.append((words, pairs, sum(words.values())))
    size = len(models[1][0])
    out = {}
    for i, w in texts:
        losses = []
        for (words, pairs, n), own in zip(models, (int(i in good), 1), strict=True):
            total = 0.0
            for k, x in enumerate(w):
                p = (words[x] - own + ALPHA) / (max(n - own, 0) + ALPHA * (size + 1))
                if k:
                    p = (pairs[w[k - 1], x] - own + KAPPA * p) / (words[w[k - 1]] - own + KAPPA)
                total -= math.log(p)
            losses.append(total / len(w) if w else None)
        out[i] = losses[0] - losses[1] if w else None
    return out


@pytest.mark.parametrize("block_bytes", [700, 1 << 20])
def test_scores_equal_plain_counting(docs, block_bytes):
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choices(["a", "b", "c", "dd", "é"], k=pick.randrange(30)))) for i in range(60)] + [(90, None), (91, "q" * 9000)]
    good = set(range(0, 60, 4))
    found = cross_entropy_difference(docs(*rows), F.col("doc_id").isin(sorted(good)), block_bytes).collect()
    expected = brute(rows, good)
    assert len(found) == len(rows)
    for r in found:
        want = expected[r["doc_id"]]
        assert (r["score"] is None) == (want is None)
        assert want is None or abs(r["score"] - want) < 1e-9


def test_target_like_texts_score_lower(docs):
    rows = [(i, "sun moon star " * 5) for i in range(10)] + [(i, "buy cheap pills " * 5) for i in range(10, 20)] + [(20, "moon star sun"), (21, "pills buy cheap")]
    found = {r["doc_id"]: r["score"] for r in cross_entropy_difference(docs(*rows), F.col("doc_id") < 5).collect()}
    assert found[20] < 0 < found[21]


def test_without_target_and_without_rows(docs):
    assert cross_entropy_difference(docs(), F.lit(True)).collect() == []
    found = cross_entropy_difference(docs((None, "a b"), (1, "a b")), F.lit(None).cast("boolean")).collect()
    assert len(found) == 2 and all(r["score"] is not None for r in found)
