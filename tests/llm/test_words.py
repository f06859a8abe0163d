import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from paymart.llm.blocks import from_low_bytes, from_planes, low_bytes, to_planes
from paymart.llm.words import hash_words, utf8_column

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\v\f\r\x1cabAÉß漢 ", max_size=60)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_contract(texts):
    words = hash_words(*utf8_column(pa.array(texts, pa.string())))
    split = [(t or "").encode().split() for t in texts]
    assert words.counts.tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    by_word = {}
    for w, h in zip(flat, words.hashes.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows_are_equal_where_their_words_are(texts, length):
    words = hash_words(*utf8_column(pa.array(texts, pa.string())))
    hashes, inside = words.windows(length)
    flat = [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]
    seen = {}
    for at in range(len(flat)):
        window = flat[at : at + length]
        assert inside[at] == (len(window) == length and len({i for i, _ in window}) == 1)
        if inside[at]:
            key = tuple(w for _, w in window)
            assert seen.setdefault(key, int(hashes[at])) == int(hashes[at])
    assert len(set(seen.values())) == len(seen)


def test_case_is_folded_for_ascii_alone():
    words = hash_words(*utf8_column(pa.array(["Abc abc É é"])), lower=True).hashes
    assert words[0] == words[1] and words[2] != words[3]


def test_long_word_and_slices():
    column = pa.array(["x" * 3_000_000 + " y", None, "y"])
    words = hash_words(*utf8_column(column.slice(0)))
    assert words.counts.tolist() == [2, 0, 1] and words.hashes[1] == words.hashes[2]
    assert hash_words(*utf8_column(column.slice(2))).hashes.tolist() == [words.hashes[2]]


def test_packed_numbers_come_back():
    numbers = np.array([0, 1, 255, 256, 2**40, 2**62], np.int64)
    assert from_planes(to_planes(numbers)).tolist() == numbers.tolist()
    keys = numbers.astype(np.uint64)
    assert from_low_bytes(low_bytes(keys, 6).tobytes(), 6).tolist() == [int(k) & (2**48 - 1) for k in keys]
