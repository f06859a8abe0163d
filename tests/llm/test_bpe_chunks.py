"""Chunked encoding against the tokenizer on whole texts."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paymart.llm import bpe_chunks
from paymart.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
ENCODER = bpe_chunks.Encoder(PATH)


def whole(text):
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    return ids, WHOLE.decode(ids, skip_special_tokens=False)


def chunked(text):
    chunks = [bpe_chunks.Chunk(c.decode(), ids) for c in bpe_chunks.chunks_of(text) for ids in ENCODER.encode([c.decode()])]
    bpe_chunks.settle(chunks, ENCODER)
    return bpe_chunks.join_chunks([chunks], ENCODER)[0].tolist()


ALPHABET = st.sampled_from(list("abcXYZ019'.,!<|>_-") + [" ", "\n", "\t", "\r", "\x1c", "\x85", " ", "　", "é", "é", "́", "Å", "İ", "Σ", "ﬁ", "日", "한", "\U0001f600", "'s", "'re", "<|endoftext|>", "<|startoftext|>"])


@pytest.fixture
def short_chunks(monkeypatch):
    monkeypatch.setattr(bpe_chunks, "SHORTEST", 2)
    monkeypatch.setattr(bpe_chunks, "LONGEST", 24)
    monkeypatch.setattr(bpe_chunks, "CUT_BITS", 3)


def test_joined_chunks_equal_whole_texts(short_chunks):
    @settings(max_examples=400, deadline=None)
    @given(st.lists(ALPHABET, max_size=80).map("".join))
    def check(text):
        assert b"".join(bpe_chunks.chunks_of(text)).decode() == text
        assert chunked(text) == whole(text)[0]

    check()


def test_widens_until_ids_agree():
    """Heads and tails that disagree at first are taken further in; without agreement nothing is settled."""
    text = "one two three four"

    class Odd:
        def encode(self, texts):  # the ids of a text are its words; the first and last word alone are told otherwise
            return [np.array([9] if t.strip() in ("one", "four") else [len(w) for w in t.split()], np.int32) for t in texts]

    chunk = bpe_chunks.Chunk(text, np.array([3, 3, 5, 4], np.int32))
    bpe_chunks.settle([chunk], Odd())
    assert (chunk.head, chunk.n_head, chunk.tail, chunk.n_tail) == ("one two", 2, " three four", 2)
    never = bpe_chunks.Chunk(text, np.array([7, 7, 7, 7], np.int32))
    bpe_chunks.settle([never], Odd())
    assert never.head is None


def test_equal_passages_give_equal_chunks():
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 9)))
    passage = " ".join(word() for _ in range(600))
    first = bpe_chunks.chunks_of(" ".join(word() for _ in range(300)) + passage)
    second = bpe_chunks.chunks_of(" ".join(word() for _ in range(411)) + passage)
    shared = set(first) & set(second)
    assert sum(map(len, shared)) > 0.5 * len(passage)
    assert max(map(len, first)) <= bpe_chunks.LONGEST and min(map(len, first[:-1])) >= bpe_chunks.SHORTEST


def rows(df):
    return sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in df.collect()), key=str)


LICENCE = " ".join("".join(random.Random(i).choices("abcdefghij", k=2 + i % 7)) for i in range(900))
TEXTS = [
    (1, LICENCE),
    (2, "Own words first. " + LICENCE + " and after."),
    (20, "Others, " + LICENCE[999:]),
    (21, "period " * 700),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "x" * 9000),
    (7, "日本語" * 3000),
    (8, "word" * 2000 + " and then some " + "é́" * 500),
    (None, "without an id " * 50),
    (None, "without an id " * 50),
    (9, "shared id one " * 50),
    (9, "shared id two " * 50),
    (9, "shared id two " * 50),
    (10, "<|startoftext|>Ends.<|endoftext|>" * 100),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 3000])
def test_equals_the_tokenizer(spark, docs, block_bytes):
    want = sorted(((i, *whole(t)) for i, t in TEXTS), key=str)
    assert rows(bpe_chunks.encoded(docs(*TEXTS).repartition(3), PATH, block_bytes)) == want


def test_passages_are_shared_between_blocks(spark, docs):
    """So that the test above has chunks that one block encodes for others."""
    placed = bpe_chunks._docs(docs(*TEXTS), 3000)
    held = {}
    for r in placed.collect():
        for c in bpe_chunks.chunks_of(r["text"]):
            held.setdefault(c, set()).add(r["block"])
    assert any(len(blocks) > 1 for blocks in held.values())


def test_no_rows(spark, docs):
    assert bpe_chunks.encoded(docs(), PATH).collect() == []


def test_unsuitable_tokenizers_are_refused(tmp_path):
    with pytest.raises(bpe_chunks.UnsuitableTokenizer):
        bpe_chunks.check_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    parts = json.load(open(PATH, encoding="utf-8"))
    parts["added_tokens"][0]["lstrip"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(parts))
    with pytest.raises(bpe_chunks.UnsuitableTokenizer):
        bpe_chunks.check_tokenizer(str(path))


def test_query_on_the_small_table(spark, small_dir):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect():
        ids, decoded = whole(r["text"])
        want[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
    got = QUERIES["op11_bpe_chunks"](spark, small_dir).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want and len(got) == len(want)


def test_memory_does_not_grow_with_the_block():
    """Words are looked up, and ids decoded, a portion at a time; the result is the same."""
    pick = random.Random(3)
    texts = [" ".join(f"w{pick.randrange(30_000)}" for _ in range(pick.randrange(400))) for _ in range(8000)]
    encoder, sizes = bpe_chunks.Encoder(PATH), []
    inner = encoder.known.ids_of
    encoder.known.ids_of = lambda split: sizes.append(len(split.flatten())) or inner(split)
    ids = encoder.encode(texts)
    assert max(sizes) <= 0.4 * sum(sizes)
    assert all(x.tolist() == whole(t)[0] for x, t in zip(ids[::40], texts[::40])) and len(ids) == len(texts)

    block = pa.table({"block": [0] * len(texts), "doc_id": range(len(texts)), "text": texts})
    packs = pa.Table.from_batches(bpe_chunks._packed(iter(block.to_batches())))
    codes = pa.table({"key": pa.array([], pa.binary()), "ids": pa.array([], pa.binary())})
    found = bpe_chunks._encode_blocks(PATH)(packs, codes)
    assert max(len(c.flatten()) for c in found["ids"].chunks) <= 0.6 * sum(map(len, ids))
    got = dict(zip(found["doc_id"].to_pylist(), zip(found["ids"].to_pylist(), found["decoded"].to_pylist())))
    assert len(got) == len(texts) and all(got[i][0] == ids[i].tolist() for i in got)
    assert all(got[i] == whole(texts[i]) for i in range(0, len(texts), 40))
