"""Alignment of two tokenizers against pairs compared one by one."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from paymart.llm import alignment
from paymart.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(tokens):
    out, at = [], 0
    for i, spelt in tokens:
        out.append((i, at, at + len(spelt)))
        at += len(spelt)
    return out


def letters():
    """The well-known byte to letter table, built the other way round."""
    table, spare = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            table[chr(b)] = b
        else:
            table[chr(spare)], spare = b, spare + 1
    return table


@pytest.fixture(scope="module")
def tools():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=B), letters()


def by_hand(tools, text):
    """A and B tokens with their bytes' spans; none where they do not spell the text."""
    t, s, table = tools
    if not text:
        return [], []
    a = [(i, bytes(table[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in s.encode(text):
        piece = s.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if s.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return [], []
    return spans(a), spans(b)


def brute(tools, rows):
    docs, held = [], Counter()
    for i, text in rows:
        a, b = by_hand(tools, text)
        links, j = [], 0
        for x, start, end in a:
            while j and b[j - 1][2] > start:
                j -= 1
            while j < len(b) and b[j][1] < end:
                if b[j][2] > start:
                    links.append((x, b[j][0]))
                j += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for e in ends:
            left, right = ([str(t[0]) for t in side if low < t[2] <= e] for side in (a, b))
            groups.append(",".join(left) + "|" + ",".join(right))
            low = e
        docs.append((i, a, b, links, ";".join(groups), len(groups)))
        held.update(set(links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        (
            (i, len(a), len(b), n, len(links), sum(held[k] == most[k[0]] for k in links), sum(held[k] for k in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "")
            for i, a, b, links, g, n in docs
        ),
        key=str,
    )


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


ROWS = [
    (1, "The quick brown fox can't jump over 13 lazy dogs."),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "a ▁ b"),  # B spells that mark as a blank: no tokens
    (6, "日本語 \U0001f600 naïve é́ ﬁn\u0000\x1c\x85​"),
    (7, "<|endoftext|> </s><s> <0x41> <unk>"),
    (8, "  lead\n\n\ttabs  and   blanks  "),
    (None, "without an id"),
    (9, "The quick brown fox can't jump over 13 lazy dogs."),
    (9, "The quick brown fox can't jump over 13 lazy dogs."),
    (9, "another text of that id"),
    (10, "x" * 5000 + " " + "ü" * 3000),
]


def test_equals_pairs_compared_one_by_one(spark, docs, tools):
    assert found(alignment.alignment_counts(docs(*ROWS), A, B)) == brute(tools, ROWS)


def test_blocks_do_not_change_the_result(spark, docs, tools, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 100)
    monkeypatch.setattr(alignment, "ALIGN_BYTES", 60)
    assert found(alignment.alignment_counts(docs(*ROWS).repartition(3), A, B)) == brute(tools, ROWS)


def test_tokens_groups_and_links_of_documents(spark, docs, tools):
    for r in alignment.aligned(docs(*ROWS), A, B).collect():
        texts = [t for i, t in ROWS if i == r["doc_id"]]
        sides = [by_hand(tools, t) for t in texts]
        [(a, b)] = {(tuple(a), tuple(b)) for a, b in sides if [t[0] for t in a] == r["a_ids"]}
        assert [t[0] for t in b] == r["b_ids"]
        want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[1] < y[2] and y[1] < x[2]} if len(a) < 99 else None
        assert want is None or {tuple(x) for x in r["links"]} == want and len(r["links"]) == len(want)
        assert [(a[x - 1][2], b[y - 1][2]) for x, y in r["groups"]] == [
            (e, e) for e in sorted({t[2] for t in a} & {t[2] for t in b})
        ]


def test_no_rows(spark, docs):
    assert alignment.alignment_counts(docs(), A, B).collect() == [] == alignment.link_counts(docs(), A, B).collect()


def test_pairs_of_the_corpus(spark, docs):
    twice = [(1, "red cat"), (2, "red dog"), (3, None)]
    rows = {(r["a_id"], r["b_id"]): (r["docs"], r["is_best"]) for r in alignment.link_counts(docs(*twice), A, B).collect()}
    assert sorted(rows.values()) == [(1, True), (1, True), (2, True)]


def test_query_on_the_small_table(spark, small_dir, tools):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    assert found(QUERIES["op12_token_alignment"](spark, small_dir)) == brute(tools, rows)
