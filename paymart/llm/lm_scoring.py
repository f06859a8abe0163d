"""Cross-entropy difference: documents scored by two matched n-gram models.

The target model counts the words and word pairs of target documents, the
background model those of all documents. Both have the same vocabulary (every
distinct word), the same smoothing and the same order:

    P(w)     = (c(w) + ALPHA) / (N + ALPHA * (V + 1))
    P(w | v) = (c(v, w) + KAPPA * P(w)) / (c(v) + KAPPA)

The first word of a text has P(w). The token that is scored is left out of the
counts, so a document gains nothing from being in a model itself.

All counts of all documents are kept. A block of documents (``blocks``) sends
its distinct words and pairs with counts and gets back their sums over all
blocks; no model is ever gathered in one place. Each bucket is asked by every
block, if only for nothing, as its answer also bears its share of N and V.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.blocks import LAST, bucket_bits, bucket_cuts, from_low_bytes, from_planes, in_blocks, low_bytes, to_planes
from paymart.llm.words import Words, hash_words, mix, utf8_column

ALPHA, KAPPA = 0.5, 10.0
BLOCK_BYTES = 5 << 20  # of text; words, pairs and their counts take some thirty times as much
KEY_BYTES = 6  # of a hash within a bucket; the buckets stand for its upper bits
ASKED = "block int, bucket int, keys binary, counts binary, targets binary"
TOLD = "block int, bucket int, counts binary, targets binary, n long, n_target long, vocabulary long"
RESULT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


class _Grams:
    """Words and pairs of a block; the lowest bit of a key is set for words."""

    def __init__(self, block: pa.Table):
        self.words: Words = hash_words(*utf8_column(block["text"]))
        self.target = np.repeat(block["is_target"].to_numpy().astype(bool), self.words.counts)
        self.paired = np.ones(len(self.words.hashes), bool)  # has a word before it
        self.paired[self.words.offsets[:-1][self.words.counts > 0]] = False
        at = np.flatnonzero(self.paired)
        one = np.uint64(1)
        pairs = mix(self.words.hashes[at - 1] * np.uint64(0xD6E8FEB86659FD93) + self.words.hashes[at])
        keys = np.concatenate([self.words.hashes | one, pairs & ~one])
        self.keys, self.group, self.counts = np.unique(keys, return_inverse=True, return_counts=True)
        in_target = np.concatenate([self.target, self.target[at]])
        self.targets = np.bincount(self.group[in_target], minlength=len(self.keys))


def _ask(bits: int):
    def run(block: pa.Table) -> pa.Table:
        grams = _Grams(block)
        cuts = bucket_cuts(grams.keys, bits)
        rows = low_bytes(grams.keys, KEY_BYTES)
        split = lambda a, pack: [pack(a[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        n = len(cuts) - 1
        return pa.table(
            {
                "block": pa.array([block["block"][0].as_py()] * n, pa.int32()),
                "bucket": pa.array(range(n), pa.int32()),
                "keys": pa.array(split(rows, np.ndarray.tobytes), pa.binary()),
                "counts": pa.array(split(grams.counts, to_planes), pa.binary()),
                "targets": pa.array(split(grams.targets, to_planes), pa.binary()),
            }
        )

    return run


def _add_up(asked: pa.Table) -> pa.Table:
    blobs = asked["keys"].to_pylist()
    keys = from_low_bytes(b"".join(blobs), KEY_BYTES)
    distinct, group = np.unique(keys, return_inverse=True)
    word = (distinct & np.uint64(1)).astype(bool)
    sums, answers = [], []
    ends = np.cumsum([len(b) // KEY_BYTES for b in blobs])
    for name in ("counts", "targets"):
        values = np.concatenate([from_planes(blob) for blob in asked[name].to_pylist()])
        total = np.bincount(group, weights=values, minlength=len(distinct)).astype(np.int64)
        sums.append(int(total[word].sum()))
        told = total[group].astype(np.int64)
        answers.append([to_planes(told[e - len(b) // KEY_BYTES : e]) for e, b in zip(ends, blobs, strict=True)])
    n = len(blobs)
    return pa.table(
        {
            "block": asked["block"],
            "bucket": asked["bucket"],
            "counts": pa.array(answers[0], pa.binary()),
            "targets": pa.array(answers[1], pa.binary()),
            "n": pa.array([sums[0]] * n, pa.int64()),
            "n_target": pa.array([sums[1]] * n, pa.int64()),
            "vocabulary": pa.array([int(word.sum())] * n, pa.int64()),
        }
    )


def _losses(grams: _Grams, counts: np.ndarray, n: int, vocabulary: int, own: np.ndarray) -> np.ndarray:
    """Negative log probability of each token; ``own`` tokens are left out of the counts."""
    size = len(grams.words.hashes)
    single = counts[grams.group[:size]] - own
    p = (single + ALPHA) / (np.maximum(n - own, 0) + ALPHA * (vocabulary + 1))
    at = np.flatnonzero(grams.paired)
    pair = counts[grams.group[size:]] - own[at]
    p[at] = (pair + KAPPA * p[at]) / (single[at - 1] + KAPPA)
    return -np.log(p)


def _score(block: pa.Table, told: pa.Table) -> pa.Table:
    grams, told = _Grams(block), told.sort_by("bucket")
    counts, targets = (
        np.concatenate([from_planes(blob) for blob in told[c].to_pylist()]).astype(np.float64) for c in ("counts", "targets")
    )
    n, n_target, vocabulary = (int(np.sum(told[c].to_numpy())) for c in ("n", "n_target", "vocabulary"))
    ones = np.ones(len(grams.words.hashes))
    background = _losses(grams, counts, n, vocabulary, ones)
    target = _losses(grams, targets, n_target, vocabulary, ones * grams.target)
    sizes, owner = grams.words.counts, grams.words.owner()
    means = [np.bincount(owner, weights=loss, minlength=len(sizes)) / np.maximum(sizes, 1) for loss in (target, background)]
    empty, ids = sizes == 0, block["doc_id"].to_numpy()
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64(), mask=ids == LAST),
            "n_tokens": pa.array(sizes, pa.int64()),
            "target_loss": pa.array(means[0], pa.float64(), mask=empty),
            "background_loss": pa.array(means[1], pa.float64(), mask=empty),
            "score": pa.array(means[0] - means[1], pa.float64(), mask=empty),
        }
    )


def cross_entropy_difference(docs: DataFrame, is_target: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and what ``is_target`` needs).

    doc_id, n_tokens, target_loss and background_loss (mean negative natural log
    probability per token) and score, their difference: the lower, the more the
    text is like the target. Texts that are null or have no words have null
    losses. A null ``is_target`` is false. Without any target the target model
    is uniform. Rows with null or repeated ids are rows like others. An empty
    table gives no rows.
    """
    docs = docs.select("doc_id", "text", F.coalesce(is_target, F.lit(False)).alias("is_target"))
    blocks, n = in_blocks(docs, block_bytes, "is_target")
    bits, by_block = bucket_bits(n), blocks.groupBy("block")
    told = by_block.applyInArrow(_ask(bits), ASKED).groupBy("bucket").applyInArrow(_add_up, TOLD)
    return by_block.cogroup(told.groupBy("block")).applyInArrow(_score, RESULT)
