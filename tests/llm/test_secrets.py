import hashlib
import random

from pyspark.sql import functions as F

from paymart.llm import secrets


def corpus(seed=4, n=60):
    """Texts with secrets, numbers and placeholders, and where the secrets are."""
    pick, rows, real = random.Random(seed), [], set()
    words = "alpha beta gamma delta the of and under over with from".split()
    for i in range(n):
        text = " ".join(pick.choices(words, k=30))
        kind = i % 5
        value = hashlib.sha1(str(i).encode()).hexdigest()
        if kind == 0:
            text += f' é漢 token = "{value}" '
            real.add((i, text.index(value), value))
        elif kind == 1:
            text += f" card {pick.randrange(10**15, 10**16)} "
        elif kind == 2:
            text += ' api_key: "your_api_key_here_please" '
        elif kind == 3:
            text += f" password={value.upper()}, next"
            real.add((i, text.index(value.upper()), value.upper()))
        rows.append((i, text + " ".join(pick.choices(words, k=10)), pick.choice(["src/app.env", "docs/test/a.md", None])))
    return rows, real


def test_secrets_are_told_from_numbers_and_placeholders(docs):
    rows, real = corpus()
    found = secrets.scan(docs(*rows)).collect()
    assert {(r["doc_id"], r["start"], r["value"]) for r in found if r["is_secret"]} == real
    texts = {i: t for i, t, _ in rows}
    assert all(texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["value"] for r in found)
    assert any(not r["is_secret"] for r in found)


def test_labels_overrule_the_rules(spark, docs):
    rows, real = corpus()
    found = secrets.scan(docs(*rows)).select("doc_id", "start", "value")
    known = found.select("doc_id", "start", F.col("value").rlike("^[0-9]+$").alias("is_secret"))
    judged = secrets.scan(docs(*rows), labelled=known).collect()
    assert {r["value"] for r in judged if r["is_secret"]} == {r["value"] for r in judged if r["value"].isdigit()}


def test_masking_keeps_rows_and_columns(docs):
    rows, real = corpus()
    rows += [(None, None), (0, "clean"), (900, "")]
    df = docs(*rows)
    masked = secrets.masked(df, secrets.scan(df))
    assert masked.columns == df.columns and masked.count() == len(rows)
    texts = [(r["doc_id"], r["text"]) for r in masked.collect()]
    assert not [v for _, _, v in real for _, t in texts if t and v in t]
    assert sum(t.count(secrets.MASK) for _, t in texts if t) == len(real)
    kept = {i: t for i, t, *_ in rows}
    assert all(t == kept[i] for i, t in texts if t and secrets.MASK not in t and i not in (0, None))
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect() if r["text"] and secrets.MASK in r["text"])


def test_one_kind_of_label_and_no_rows(docs):
    assert secrets.scan(docs()).collect() == []
    assert secrets.masked(docs(), secrets.scan(docs())).collect() == []
    [row] = secrets.scan(docs((1, 'token = "f9847fe1d8f3ee62ab08a6c3b7a7a0d8f7a0e5b1"'))).collect()
    assert (row["start"], row["length"], row["is_secret"]) == (9, 40, True)
    long = "word " * 50_000 + "-----BEGIN RSA PRIVATE KEY-----"
    [row] = secrets.scan(docs((1, long), (2, None), (3, ""))).collect()
    assert row["is_secret"] and row["start"] == 250_000


def test_no_python_in_the_plan(docs):
    plan = secrets.scan(docs(*corpus()[0]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_no_line_of_a_private_key_survives_masking(docs):
    import base64

    pick = random.Random(2)
    lines = [base64.b64encode(pick.randbytes(48)).decode() for _ in range(25)] + [base64.b64encode(pick.randbytes(7)).decode()]
    body, head, end = "\n".join(lines), "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    keys = [f"{head}\n{body}\n{end}", f"{head}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0AF1\n\n{body}\n{end}", f"{head}\n{body}"]
    keys += [f'private_key = "{keys[0]}"', "\\n".join([head, *lines, end])]
    rows = corpus()[0] + [(1000 + i, f"before it\n{key}\n\nafter it all") for i, key in enumerate(keys)]
    df = docs(*rows)
    texts = {r["doc_id"]: r["text"] for r in secrets.masked(df, secrets.scan(df)).collect() if r["doc_id"] >= 1000}
    assert not [line for line in lines for t in texts.values() if line in t]
    assert all(t.startswith("before it") and t.endswith("after it all") and secrets.MASK in t for t in texts.values())


def found_in(spark, *rows):
    """Findings that are all secrets, as (doc_id, text, value) says."""
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, value STRING")
    return df.select("doc_id", F.xxhash64("text").alias("text_hash"), "value", F.lit(True).alias("is_secret"))


def test_longest_values_are_masked_first(spark, docs):
    text = "a ab12cd34ef56gh78 and ab12cd34ef56gh78ZZ99yy88 and x-ab12cd34ef56gh78ZZ"
    values = ["ab12cd34ef56gh78", "ab12cd34ef56gh78ZZ99yy88", "x-ab12cd34ef56gh78ZZ"]
    masked = secrets.masked(docs((1, text)), found_in(spark, *[(1, text, v) for v in values])).collect()
    assert [r["text"] for r in masked] == ["a [SECRET] and [SECRET] and [SECRET]"]


def test_rows_that_share_an_id_are_masked_by_their_own_findings(spark, docs):
    rows = [(1, "key one-1"), (1, "key two-2 one-1"), (None, "key three-3"), (None, None), (None, "key three-3"), (2, "")]
    found = found_in(spark, (1, "key one-1", "one-1"), (1, "key two-2 one-1", "two-2"), (None, "key three-3", "three-3"))
    names = ["in_doc", "in_text", "found_secrets", "masked_text", "a.b"]
    df = docs(*rows).selectExpr("*", *[f"'{n}' AS `{n}`" for n in names])
    masked = secrets.masked(df, found)
    assert masked.columns == df.columns
    assert sorted(str(r["text"]) for r in masked.collect()) == sorted(
        ["key [SECRET]", "key [SECRET] one-1", "key [SECRET]", "None", "key [SECRET]", ""]
    )
    assert all(r[n] == n for r in masked.collect() for n in names)


def test_candidates_against_plain_regular_expressions(spark, docs):
    """Runs with a digit, wherever it stands, and assigned values: found again by other patterns."""
    import re

    pick = random.Random(8)
    letters = "abcXYZ+/_-"
    texts = []
    for i in range(120):
        run = "".join(pick.choices(letters, k=pick.choice([5, 20, 300, 3000]))) + pick.choice(["", "7", "42x"])
        texts.append(f"words {run} and {''.join(pick.choices(letters + '0123', k=pick.choice([10, 16, 40])))}, é漢 end")
    rows = list(enumerate(texts))
    got = {(r["doc_id"], r["start"], r["value"]) for r in secrets.candidates(docs(*rows)).collect()}
    want = set()
    for i, t in rows:
        for m in re.finditer(r"[A-Za-z0-9+/_-]+", t):
            if len(m[0]) >= 16 and re.search("[0-9]", m[0]):
                want.add((i, m.start(), m[0]))
    assert got == want and any(len(v) > 2000 for *_, v in got)


def test_long_runs_take_no_longer_than_their_length(docs):
    import time

    rows = [(1, "a" * 2_000_000), (2, "ab/" * 500_000 + "1"), (3, "token = '" + "x1" * 300_000 + "'")]
    start = time.monotonic()
    found = {r["doc_id"]: r["value"] for r in secrets.candidates(docs(*rows)).collect()}
    assert set(found) == {2, 3} and len(found[2]) == 1_500_001
    assert time.monotonic() - start < 60


def test_repeated_rows_and_no_rows(docs):
    row = (5, 'token = "' + hashlib.sha1(b"x").hexdigest() + '"', "a/b")
    found = secrets.scan(docs(row, row, (None, None), (6, ""))).collect()
    assert len(found) == 2 and len({(r["start"], r["probability"], r["is_secret"]) for r in found}) == 1
    assert secrets.scan(docs()).collect() == [] == secrets.masked(docs(), secrets.scan(docs())).collect()
