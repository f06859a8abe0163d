import random

import pytest

from paymart.llm import near_dedup
from paymart.llm.components import connected_components


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(rows, percent, size):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sets, [root(i) for i in range(len(rows))]


def brute(rows, percent, size):
    """Every row against every other, with the smallest id of its component (null for none)."""
    sets, roots = components(rows, percent, size)
    smallest = {}
    for (doc_id, _), r in zip(rows, roots):
        if doc_id is not None:
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    return sorted(((i, len(s), smallest.get(r)) for (i, _), s, r in zip(rows, sets, roots)), key=str)


def family(pick, size, copies, edits):
    """A text and edited copies, some of them edited from each other."""
    words = [f"v{pick.randrange(5000)}" for _ in range(size)]
    out = [words]
    for _ in range(copies):
        copy = list(pick.choice(out[-3:]))
        for _ in range(pick.randrange(edits)):
            copy[pick.randrange(len(copy))] = f"e{pick.randrange(10**6)}"
        out.append(copy)
    return [" ".join(w) for w in out]


@pytest.mark.parametrize("tile", [4, 512])
def test_components_equal_all_pairs(docs, tile):
    pick = random.Random(tile)
    texts = [t for _ in range(6) for t in family(pick, 120, 25, 8)]
    texts += [texts[0], texts[0].upper(), "One", "one", "two words", "", None, " \n", "a b c", "z " * 200]
    pick.shuffle(texts)
    rows = list(enumerate(texts, 10))
    found = near_dedup.near_duplicates(docs(*rows), percent=85, shingle=3, tile=tile).collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == brute(rows, 85, 3)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def like(text, words):
    """The text with some words put after it."""
    return f"{text} {' '.join(f'more{i}' for i in range(words))}"


LONG = " ".join(f"w{i}" for i in range(200))
OTHER = " ".join(f"o{i}" for i in range(200))
THIRD = " ".join(f"t{i}" for i in range(200))
ROWS = [
    (3, LONG), (5, like(LONG, 3)), (5, OTHER),  # one id, a copy of 3 and a text of its own
    (7, THIRD), (7, THIRD), (7, THIRD), (7, THIRD),  # a repeated row
    (None, like(LONG, 2)), (None, "only here " * 30), (None, "only here " * 30),  # without ids: a copy, a repeated row
    (8, None), (8, None), (9, ""), (None, None), (10, "word"), (11, "word"),
    (20, "x " * 60_000), (21, "x " * 60_000 + "y"),  # very long
]


def test_rows_that_share_an_id_or_have_none(docs):
    found = near_dedup.near_duplicates(docs(*ROWS)).collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == brute(ROWS, 80, 5)
    sets, roots = components(ROWS, 80, 5)
    kept = [r for r in found if r["kept"] and r["n_shingles"]]
    assert len(kept) == len({r for s, r in zip(sets, roots) if s})
    assert all(r["doc_id"] == r["component_id"] for r in found if r["kept"])
    assert all(r["kept"] for r in found if not r["n_shingles"])


def test_one_row_of_each_stays(spark, docs):
    plain = near_dedup.one_of_each(docs(*ROWS))
    want = sorted([(3, LONG), (5, OTHER), (7, THIRD), (None, "only here " * 30), (8, None), (8, None), (9, ""), (None, None), (10, "word"), (20, "x " * 60_000), (21, "x " * 60_000 + "y")], key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in plain.collect()), key=str) == want
    assert plain.columns == docs(*ROWS).columns and plain.schema == docs(*ROWS).schema
    # names that the operator uses itself, and rows that differ in them alone
    names = ["copy_id", "copy_hash", "kept", "rep", "text_hash", "one_row", "row", "a.b"]
    clashing = docs(*ROWS).selectExpr("doc_id", "text", *[f"CAST(hash(rand(3)) AS STRING) AS `{n}`" for n in names])
    clashing = spark.createDataFrame(clashing.collect(), clashing.schema)
    found = near_dedup.one_of_each(clashing)
    assert found.columns == clashing.columns
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str) == want


def test_empty_table(docs):
    assert near_dedup.near_duplicates(docs()).collect() == []
    assert near_dedup.one_of_each(docs()).collect() == []


def test_pruning_keeps_what_may_reach_the_threshold():
    looks = near_dedup.least_matches(0.85, 1e-7)
    assert [n for n, _ in looks] == [32, 64, 96, 128]
    assert all(m < 0.85 * n for n, m in looks) and looks[-1][1] > 0.6 * 128


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    found = connected_components(spark.createDataFrame(links, "a LONG, b LONG")).collect()
    expected = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)
    assert connected_components(spark.createDataFrame([], "a LONG, b LONG")).collect() == []


def test_sets_are_read_of_likely_members_alone(docs, monkeypatch):
    """Texts that share half of their words meet in many bands; their sets are not sent there."""
    pick = random.Random(5)
    word = lambda: f"v{pick.randrange(10**6)}"
    shared = [word() for _ in range(300)]
    texts = [" ".join(shared + [word() for _ in range(170)]) for _ in range(40)]  # alike by some 0.47
    close = [word() for _ in range(200)]
    texts += [" ".join(close[:at] + [word()] + close[at + 1 :]) for at in range(0, 200, 8)]
    texts += [" ".join(shared[:at] + [word()] + shared[at + 1 :]) for at in range(0, 300, 4)]
    rows = list(enumerate(texts))
    asked, inner = [], near_dedup._sets_of

    def spied(docs, reps, wanted, shingle):
        asked.append({r["rep"] for r in wanted.collect()})
        return inner(docs, reps, wanted, shingle)

    monkeypatch.setattr(near_dedup, "_sets_of", spied)
    found = near_dedup.near_duplicates(docs(*rows), percent=85, shingle=3).collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == brute(rows, 85, 3)
    assert len(asked) == 2 and len(asked[1]) < 20
