"""Repeated word sequences, found level by level with doubling lengths.

All windows of the first length are compared across the whole table. Only
where two adjoining windows are repeated is the window of twice the length a
candidate for the next level, and so on up to ``stop``, or until no candidates
are left. A word goes if a repeated window of the wanted length covers it that
also starts earlier.

Comparing is one exchange per level (``blocks``): a block of documents sends
the hash of each distinct candidate once, and gets back two bits, "another
block has it" and "an earlier block has it". Blocks follow doc_id, so the
number of the block tells which occurrence comes first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.blocks import BLOCK_BYTES, LAST, bucket_bits, bucket_cuts, from_low_bytes, in_blocks, in_order, low_bytes
from paymart.llm.shared import staged
from paymart.llm.words import Words, hash_words, mix, utf8_column

KEYS = "block int, bucket int, level int, width int, keys binary"
ANSWERS = "block int, bucket int, level int, elsewhere binary, earlier binary"
RESULT = "doc_id long, n_words long, n_removed long, longest_repeat int, kept_text string, removed_spans array<array<long>>"
FILTER_BYTES = 6  # of a hash at the first level, which need not be exact
EXACT_BYTES = 16


class _Levels:
    """Candidates of a block, level after level, from the answers so far."""

    def __init__(self, block: pa.Table, start: int):
        self.block = in_order(block)
        self.words: Words = hash_words(*utf8_column(self.block["text"]))
        self.length = start
        hashes, inside = self.words.windows(start)
        self.at = np.flatnonzero(inside)
        self.level = 0
        self._find(hashes)

    def _find(self, hashes: np.ndarray) -> None:
        """Distinct keys of the candidates, sorted, and where each first occurs."""
        self.keys = hashes[self.at]
        if self.level:  # a second hash makes the key 128 bits wide
            second = Words(mix(self.words.hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), self.words.counts)
            self.check = second.windows(self.length)[0][self.at]
            order = np.lexsort((self.check, self.keys))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(self.keys[order]) != 0) | (np.diff(self.check[order]) != 0)
        else:
            order = np.argsort(self.keys, kind="stable")
            new = np.ones(len(order), bool)
            new[1:] = np.diff(self.keys[order]) != 0
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.first = order[new]  # both sorts are stable: the earliest of a group comes first
        self.many = np.diff(np.append(np.flatnonzero(new), len(order))) > 1

    def questions(self, bits: int) -> tuple[list[int], list[bytes], int]:
        keys = self.keys[self.first]
        width = EXACT_BYTES if self.level else FILTER_BYTES
        rows = low_bytes(keys, min(width, 8))
        if width > 8:
            rows = np.hstack([rows, low_bytes(self.check[self.first], 8)])
        cuts = bucket_cuts(keys, bits)
        full = np.flatnonzero(np.diff(cuts))
        return full.tolist(), [rows[cuts[b] : cuts[b + 1]].tobytes() for b in full], width

    def answer(self, answers: pa.Table, bits: int) -> None:
        """Takes in the answers of this level; ``earlier`` is then by candidate."""
        mine = answers.filter(pa.compute.equal(answers["level"], self.level))
        told = {b: (e, s) for b, e, s in zip(*(mine[c].to_pylist() for c in ("bucket", "elsewhere", "earlier")), strict=True)}
        cuts = bucket_cuts(self.keys[self.first], bits)
        elsewhere, before = np.zeros(len(self.first), bool), np.zeros(len(self.first), bool)
        for b in np.flatnonzero(np.diff(cuts)):
            n = cuts[b + 1] - cuts[b]
            for out, blob in zip((elsewhere, before), told[int(b)], strict=True):
                out[cuts[b] : cuts[b + 1]] = np.unpackbits(np.frombuffer(blob, np.uint8), count=n)
        not_first = np.ones(len(self.at), bool)
        not_first[self.first] = False
        self.repeated = (elsewhere | self.many)[self.group]
        self.earlier = before[self.group] | not_first

    def next(self) -> None:
        """Goes on to twice the length where two adjoining windows are repeated."""
        found = np.zeros(len(self.words.hashes) + self.length, bool)
        found[self.at[self.repeated]] = True
        both = found[: -self.length] & found[self.length :]
        self.length *= 2
        self.level += 1
        hashes, inside = self.words.windows(self.length)
        self.at = np.flatnonzero(both & inside)
        self._find(hashes)


def _replay(block: pa.Table, answers: pa.Table, start: int, level: int, bits: int) -> _Levels:
    state = _Levels(block, start)
    for _ in range(level):
        state.answer(answers, bits)
        state.next()
    return state


def _ask(start: int, level: int, bits: int):
    def first(block: pa.Table) -> pa.Table:
        return ask(block, None)

    def ask(block: pa.Table, answers: pa.Table | None) -> pa.Table:
        state = _replay(block, answers, start, level, bits)
        buckets, keys, width = state.questions(bits)
        n, number = len(buckets), block["block"][0].as_py()
        return pa.table(
            {"block": [number] * n, "bucket": buckets, "level": [level] * n, "width": [width] * n, "keys": keys},
            _schema(KEYS),
        )

    return ask if level else first


def _schema(text: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in text.split(", "))])


def _meet(asked: pa.Table) -> pa.Table:
    """Answers of one bucket at one level."""
    asked = asked.sort_by("block")
    blobs, width = asked["keys"].to_pylist(), asked["width"][0].as_py()
    counts = [len(b) // width for b in blobs]
    if width > 8:
        rows = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, 2)
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        same = (rows[order[1:]] == rows[order[:-1]]).all(axis=1)
    else:
        keys = from_low_bytes(b"".join(blobs), width)
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
    earlier, elsewhere = np.zeros(len(order), bool), np.zeros(len(order), bool)
    earlier[order[1:]] = same  # rows are in order of their blocks and both sorts are stable
    elsewhere[order[:-1]] = same
    elsewhere |= earlier
    ends = np.cumsum(counts)
    pack = lambda bits: [np.packbits(bits[e - n : e]).tobytes() for e, n in zip(ends, counts, strict=True)]
    return pa.table(
        {"block": asked["block"], "bucket": asked["bucket"], "level": asked["level"], "elsewhere": pack(elsewhere), "earlier": pack(earlier)},
        _schema(ANSWERS),
    )


def _remove(start: int, target: int, level: int, bits: int):
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        state = _Levels(block, start)
        n = len(state.words.hashes)
        longest = np.zeros(n, np.int32)
        cover = np.zeros(n + 1, np.int64)
        for step in range(level + 1):
            state.answer(answers, bits)
            longest[state.at[state.repeated]] = state.length
            if state.length == target:
                hit = state.at[state.earlier]
                np.add.at(cover, hit, 1)
                np.add.at(cover, hit + target, -1)
            if step < level:
                state.next()
        gone = np.cumsum(cover[:-1]) > 0
        cuts, texts = state.words.offsets, state.block["text"].cast(pa.binary()).to_pylist()
        kept, spans, removed, most = [], [], [], []
        for text, a, b in zip(texts, cuts[:-1], cuts[1:], strict=True):
            words, mask = (text or b"").split(), gone[a:b]
            removed.append(int(mask.sum()))
            most.append(int(longest[a:b].max()) if b > a else 0)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
            spans.append(edges.reshape(-1, 2).tolist())
            kept.append(b" ".join([w for w, m in zip(words, mask, strict=True) if not m] if removed[-1] else words))
        ids = state.block["doc_id"].to_numpy()
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=ids == LAST),
                "n_words": pa.array(state.words.counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "longest_repeat": pa.array(most, pa.int32()),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                "removed_spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame, length: int = 20, start: int = 10, stop: int | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), its repeated passages removed.

    doc_id, n_words, n_removed, longest_repeat (the longest length of a level
    at which some window of the text is repeated), kept_text (kept words,
    joined by a space), removed_spans ([first word, end) pairs). ``length`` is
    ``start`` times a power of two. Levels go up to ``stop``; by default until
    no candidates are left, which takes a job per level.

    Null texts have no words. Rows with a null id come last. Rows that share an
    id count as documents of their own, in the order of their texts. Texts
    shorter than a window keep their words. An empty table gives no rows.
    """
    blocks, n = in_blocks(docs, block_bytes)
    bits, level, size = bucket_bits(n), 0, start
    by_block, answers = blocks.groupBy("block"), None
    while True:
        if answers is None:
            asked = by_block.applyInArrow(_ask(start, level, bits), KEYS)
        else:
            asked = by_block.cogroup(answers.groupBy("block")).applyInArrow(_ask(start, level, bits), KEYS)
        if stop is None and size > length:
            asked = staged(asked, "questions")
            if asked.isEmpty():
                level -= 1
                break
        told = asked.groupBy("bucket").applyInArrow(_meet, ANSWERS)
        if stop is None:
            told = staged(told, "answers")
        answers = told if answers is None else answers.unionByName(told)
        if stop is not None and size >= max(stop, length):
            break
        level, size = level + 1, size * 2
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(_remove(start, length, level, bits), RESULT)


def kept_digest(removed: DataFrame) -> DataFrame:
    """The rows with a SHA-256 of the kept text in its place."""
    return removed.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"), "removed_spans"
    )
