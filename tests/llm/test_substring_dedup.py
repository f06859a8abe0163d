import hashlib
import random

import pytest

from paymart.llm.substring_dedup import kept_digest, remove_repeats


def brute(rows, length):
    """(doc_id, n_words, n_removed, kept) by looking at every window in order."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            if window in seen:
                gone[at : at + length] = [True] * length
            seen.add(window)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def made(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = pick.choices(vocabulary, k=30)
    rows = []
    for doc_id in range(60):
        words = pick.choices(vocabulary, k=pick.randrange(0, 60))
        for _ in range(pick.randrange(3)):
            at = pick.randrange(len(words) + 1)
            words[at:at] = passage[pick.randrange(10) :]
        rows.append((doc_id * 7 % 61, pick.choice([" ", "\n", " \t "]).join(words)))
    rows += [(100, rows[3][1]), (101, "a " * 50), (102, None), (103, ""), (104, "é" * 5000), (None, rows[5][1]), (100, "a " * 30)]
    return rows


@pytest.mark.parametrize("block_bytes", [600, 1 << 20])
def test_equals_every_window_looked_at(docs, block_bytes):
    rows = made(block_bytes)
    found = kept_digest(remove_repeats(docs(*rows), length=20, start=10, stop=20, block_bytes=block_bytes)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([tuple(r)[:4] for r in found], key=key) == sorted(brute(rows, 20), key=key)


def test_doubling_goes_on_until_nothing_is_left(docs):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (2, f"x {text} y"), (3, " ".join(f"v{i}" for i in range(30)))]
    found = {r["doc_id"]: r for r in remove_repeats(docs(*rows), length=20, start=10).collect()}
    assert [found[i]["longest_repeat"] for i in (1, 2, 3)] == [80, 80, 0]
    assert found[2]["kept_text"] == "x y" and found[2]["removed_spans"] == [[1, 101]]
    assert found[1]["n_removed"] == 0


def test_empty_table(docs):
    assert remove_repeats(docs(), length=20, stop=20).collect() == []
