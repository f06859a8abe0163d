"""Benchmark items in training documents: rare n-gram seeds, then local alignment.

Texts are compared by words without ASCII punctuation and case. The n-grams of
the items are the seeds; one is rare if its words, drawn at random with their
frequencies in all documents, would meet at most once in ten million words. An
item with too few rare seeds keeps all of its seeds. Each document that holds a
rare seed is aligned with the item around it (Smith-Waterman over words), and
the score, as a share of the item's own, tells copies with edits from chance.

Documents stay where they are: the seeds travel to them, in slices of bounded
size, and only matches come back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.shared import filtered_in_arrow
from paymart.llm.words import PUNCTUATION, Words, fold_latin, hash_words, utf8_column

SEED_WORDS = 3
RARE = 1e-7  # chance of a seed at a given word, at most
FEWEST_SEEDS = 4
MATCH, MISMATCH, GAP = 2, 1, 1
THRESHOLD = 0.4  # chance reaches a third at most on a hundred megabytes; copies with a third of their words edited reach this
WHOLE_WORDS = 8  # so many words have to match at least; of shorter items all, or all but one from eight words on
PASSAGE_WORDS = 20  # so many words in a row, an edit costing three of them, are a copy whatever their share of the item
PASSAGE_PENALTY = 4  # of a mismatch or gap within a passage
SLICE_BYTES = 16 << 20  # of item texts that one pass compares with
MATCHES = "doc_id long, item_id long, score double, start_word long, end_word long"


def plain_words(column) -> Words:
    data, offsets = utf8_column(column)
    return hash_words(fold_latin(data), offsets, lower=True, separators=PUNCTUATION)


class _Lookup:
    """Which hashes are among a few: a table of bits first, then a binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.mask = np.uint64((1 << max(16, 4 + len(self.keys).bit_length())) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[self.keys & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the hashes that are keys, and the numbers of those keys."""
        at = np.flatnonzero(self.bits[hashes & self.mask])
        if not len(self.keys):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        good = self.keys[number] == hashes[at]
        return at[good], number[good]


@dataclass
class Items:
    """Benchmark items as words, and their seeds by length."""

    ids: list[int | None]
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)  # length: hash, item, offset
    fewest: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # words whose score an alignment needs
    distinctive: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))  # whole matches are not expected by chance

    @classmethod
    def of(cls, ids: list, texts: list) -> Items:
        words = plain_words(pa.array(texts, pa.string()))
        cuts = words.offsets
        items = cls(ids, [words.hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        owner = words.owner()
        for n in range(1, SEED_WORDS + 1):
            hashes, inside = words.windows(n)
            if n < SEED_WORDS:  # only for items that are that short
                inside &= words.counts[owner] == n
            at = np.flatnonzero(inside)
            items.seeds[n] = hashes[at], owner[at], at - cuts[owner[at]]
        return items

    def vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))

    def keep_rare(self, vocabulary: np.ndarray, counts: np.ndarray, total: int) -> None:
        """Leaves out seeds that chance alone would bring about too often."""
        share = np.log(np.maximum(counts, 1) / max(total, 1))
        rare = {}
        for n, (_, item, offset) in self.seeds.items():
            chance = [share[np.searchsorted(vocabulary, self.words[i][o : o + n])].sum() for i, o in zip(item, offset, strict=True)]
            rare[n] = np.array(chance) <= np.log(RARE)
        left = np.zeros(len(self.words), np.int64)
        for n, (_, item, _) in self.seeds.items():
            np.add.at(left, item[rare[n]], 1)
        for n, (hashes, item, offset) in self.seeds.items():
            keep = rare[n] | (left[item] < FEWEST_SEEDS)
            self.seeds[n] = hashes[keep], item[keep], offset[keep]
        logs = [np.sort(share[np.searchsorted(vocabulary, w)])[::-1] for w in self.words]
        needed = [fewest_words(x, total) for x in logs]
        self.fewest = np.array([m for m, _ in needed], np.int64)
        self.distinctive = np.array([d for _, d in needed], bool)


def fewest_words(logs: np.ndarray, total: int) -> tuple[int, bool]:
    """The least number of words whose score chance is expected to reach less than once in ``total`` words.

    ``logs`` are the log frequencies of an item's words, the most frequent
    first. With m words in a row as score, m + j words have to match with 2 j
    edits at most; the most frequent words bound each case. As words that often
    stand together are not independent, short items need nearly all words
    besides. False where not even the whole item is rarer than that.
    """
    n = len(logs)
    if not n:
        return 0, False
    sums = np.concatenate([[0.0], np.cumsum(logs)])
    for m in range(max(1, min(WHOLE_WORDS, n - n // WHOLE_WORDS)), n + 1):
        cases = []
        for j in range(n - m + 1):
            ways = math.lgamma(m + 3 * j + 1) - math.lgamma(2 * j + 1) - math.lgamma(m + j + 1) + 2 * j * math.log(3)
            cases.append(ways + sums[m + j])
        if np.logaddexp.reduce(cases) + math.log(n) + math.log(max(total, 1)) < 0:
            return m, True
    return n, False


def align(items: np.ndarray, texts: np.ndarray, mismatch: int = MISMATCH, gap: int = GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local score of each row pair and the end of its alignment in text and item.

    Rows are padded with 0 and 1, which match nothing. The gap within a text
    row is a running maximum, so one step covers a whole row of all pairs.
    """
    n, width = texts.shape
    slope = (gap * np.arange(width + 1, dtype=np.int32))[None, :]
    before = np.zeros((n, width + 1), np.int32)
    best, end, row = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        now = np.zeros_like(before)
        step = np.where(texts == items[:, i : i + 1], MATCH, -mismatch)
        now[:, 1:] = np.maximum(before[:, :-1] + step, before[:, 1:] - gap)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        at = now.argmax(axis=1)
        top = now[np.arange(n), at]
        better = top > best
        best[better], end[better], row[better] = top[better], at[better], i + 1
        before = now
    return best, end, row


def _padded(rows: list[np.ndarray], filler: int) -> np.ndarray:
    out = np.full((len(rows), max(map(len, rows), default=0)), filler, np.uint64)
    for r, row in enumerate(rows):
        out[r, : len(row)] = row
    return out


def _matches(items: Items, lookups: dict[int, _Lookup], by_key: dict, column, threshold: float):
    """(text, item, score, first word, end) of the best alignment of each text and item that reach the threshold, or hold a passage."""
    words = plain_words(column)
    cuts, owner = words.offsets, words.owner()
    regions = []
    for n, lookup in lookups.items():
        hashes, inside = words.windows(n)
        at, number = lookup.find(hashes)
        good = inside[at]
        at, number = at[good], number[good]
        if not len(at):
            continue
        starts, seed_items, seed_offsets = by_key[n]
        many = starts[number + 1] - starts[number]
        seed = np.repeat(starts[number], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(at, many)
        item = seed_items[seed]
        diagonal = at - seed_offsets[seed]
        sizes = np.array([len(w) for w in items.words], np.int64)[item]
        regions.append(np.stack([owner[at], item, diagonal // np.maximum(sizes // 4, 4)], axis=1))
    if not regions:
        return []
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    regions = np.unique(np.concatenate(regions), axis=0)
    sizes = np.array([len(w) for w in items.words], np.int64)
    regions = regions[np.argsort(sizes[regions[:, 1]], kind="stable")]  # rows of a batch of like length
    for first in range(0, len(regions), 256):
        part = regions[first : first + 256]
        queries, texts, begins = [], [], []
        for text, item, slot in part.tolist():
            size = len(items.words[item])
            width = max(size // 4, 4)
            a = max(cuts[text], slot * width - size // 2)
            b = min(cuts[text + 1], (slot + 1) * width + size + size // 2)
            queries.append(items.words[item])
            texts.append(words.hashes[a:b])
            begins.append(int(a - cuts[text]))
        score, end, row = align(_padded(queries, 0), _padded(texts, 1))
        own = np.array([MATCH * max(len(q), 1) for q in queries])
        needed = np.maximum(threshold * own, MATCH * items.fewest[part[:, 1]])
        good = score >= needed
        part_only = np.flatnonzero(~good & (score >= MATCH * PASSAGE_WORDS))
        for chosen, costs in ((np.flatnonzero(good), (MISMATCH, GAP)), (part_only, (PASSAGE_PENALTY, PASSAGE_PENALTY))):
            if len(chosen) and costs != (MISMATCH, GAP):
                strict, ends, rows = align(_padded([queries[g] for g in chosen], 0), _padded([texts[g] for g in chosen], 1), *costs)
                score[chosen], end[chosen], row[chosen] = strict, ends, rows
                chosen = chosen[strict >= MATCH * PASSAGE_WORDS]
            if not len(chosen):
                continue
            back, start, _ = align(
                _padded([queries[g][: row[g]][::-1] for g in chosen], 0), _padded([texts[g][: end[g]][::-1] for g in chosen], 1), *costs
            )
            for g, s in zip(chosen.tolist(), start.tolist(), strict=True):
                text, item = int(part[g, 0]), int(part[g, 1])
                found = (float(score[g] / own[g]), begins[g] + int(end[g]) - s, begins[g] + int(end[g]))
                best[text, item] = max(best.get((text, item), found), found)
    return sorted((text, item, *found) for (text, item), found in best.items())


def _finder(items: Items, threshold: float):
    """Built in each task from the items alone."""
    lookups, by_key = {}, {}
    for n, (hashes, item, offset) in items.seeds.items():
        if len(hashes):
            order = np.argsort(hashes, kind="stable")
            lookups[n] = _Lookup(hashes)
            starts = np.searchsorted(hashes[order], lookups[n].keys)
            by_key[n] = np.append(starts, len(hashes)), item[order], offset[order]
    return lambda column: _matches(items, lookups, by_key, column, threshold)


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            yield batch.slice(first, 256)


def _count(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, counts, total = _Lookup(vocabulary), np.zeros(len(vocabulary), np.int64), 0
        for batch in _small_batches(batches):
            words = plain_words(batch.column(0))
            counts += np.bincount(lookup.find(words.hashes)[1], minlength=len(vocabulary))
            total += len(words.hashes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(len(vocabulary)), -1)), pa.array(np.append(counts, total))], ["word", "n"]
        )

    return run


def item_slices(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> Iterator[Items]:
    """The items with their rare seeds, in slices that fit a task."""
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    n = max(1, -(-size // slice_bytes))
    for i in range(n):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"] or ""))
        items = Items.of([r["item_id"] for r in rows], [r["text"] for r in rows])
        vocabulary = items.vocabulary()
        counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count(vocabulary), "word long, n long")
        sums = {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
        items.keep_rare(vocabulary, np.array([sums.get(k, 0) for k in range(len(vocabulary))]), sums.get(-1, 0))
        yield items


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) and each item of ``benchmark`` (item_id, text) it holds a copy of.

    doc_id, item_id, score (share of the item's own alignment score, from
    ``threshold`` to 1, or less for a passage of a long item), start_word and end_word (of the best place, counted in
    plain words). Null and empty texts match nothing. Null ids are kept; rows
    with equal ids are judged each. Without items or documents there are no
    rows. Items of few words have to match nearly whole (``fewest_words``), and
    those too short or common to be distinctive whole. Items shorter than a seed
    are one seed. Extra columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for items in item_slices(docs, benchmark):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            find = _finder(items, threshold)
            for batch in _small_batches(batches):
                rows = find(batch.column(1))
                ids = batch.column(0).to_pylist()
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[t] for t in columns[0]], pa.int64()),
                        pa.array([items.ids[i] for i in columns[1]], pa.int64()),
                        pa.array(columns[2], pa.float64()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(columns[4], pa.int64()),
                    ],
                    ["doc_id", "item_id", "score", "start_word", "end_word"],
                )

        part = docs.mapInArrow(run, MATCHES)
        found = part if found is None else found.unionByName(part)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no copy of an item, with all their columns.

    Items that chance is expected to bring about are no reason to drop a row;
    ``benchmark_matches`` reports where they stand. Rows are judged each by its
    text: repeated ones, and ones that share an id or have none, stay or go by
    themselves. A null or empty text holds nothing; a text of any length is
    searched whole. Columns of any name come along. Without items nothing goes;
    an empty table gives no rows.
    """
    place = docs.columns.index("text")
    clean = docs
    for items in item_slices(docs, benchmark):

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            find = _finder(items, threshold)
            for batch in _small_batches(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[[row[0] for row in find(batch.column(place)) if items.distinctive[row[1]]]] = False
                yield batch.filter(pa.array(keep))

        clean = filtered_in_arrow(clean, run)
    return clean
