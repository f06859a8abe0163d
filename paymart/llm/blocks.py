"""Blocks of documents that ask all others about their keys.

Documents are cut into blocks of consecutive ids of about ``block_bytes`` of
text. A block sends each of its distinct keys once, sorted, in one row per
range of keys (a bucket); a bucket meets the keys of all blocks and answers each
with one value per key, in the order asked. So a key that occurs a billion
times crosses the network once per block, and answers need no keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

BLOCK_BYTES = 8 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id: after all others


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, *extra: str) -> tuple[DataFrame, int]:
    """(block, doc_id, text, *extra) of all rows, and the number of blocks.

    Block numbers follow doc_id, null last; rows of one id share a block. The
    borders are quantiles of the ids, one number per block.
    """
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *extra,
    )
    row = docs.agg(F.sum(F.octet_length("text") + 64).alias("size")).first()
    n = max(1, -(-(row["size"] or 0) // block_bytes))
    borders = np.zeros(0, np.int64)
    if n > 1:
        parts = F.lit([i / n for i in range(1, n)])
        row = docs.agg(F.percentile_approx("doc_id", parts, max(10_000, 20 * n)).alias("borders")).first()
        borders = np.unique(np.array(row["borders"], np.int64))

    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for ids in batches:
            yield pa.array(np.searchsorted(borders, ids.to_numpy(), "left").astype(np.int32))

    block = F.arrow_udf(place, IntegerType())(F.col("doc_id")) if len(borders) else F.lit(0)
    return docs.select(block.alias("block"), "doc_id", "text", *extra), n


def bucket_bits(n_blocks: int) -> int:
    """As many buckets as blocks, rounded up to a power of two."""
    return max(0, (n_blocks - 1).bit_length())


def in_order(block: pa.Table) -> pa.Table:
    """Rows by id, and by text where ids are equal."""
    return block.take(pc.sort_indices(block, [("doc_id", "ascending"), ("text", "ascending")]))


def bucket_cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins and ends in sorted keys."""
    if not bits:
        return np.array([0, len(keys)])
    borders = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, borders), [len(keys)]])


def low_bytes(keys: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of each key, as rows of bytes."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :width]


def from_low_bytes(blob: bytes, width: int) -> np.ndarray:
    """Keys from rows of bytes."""
    rows = np.frombuffer(blob, np.uint8).reshape(-1, width)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :width] = rows
    return out.view(np.uint64).ravel()


def to_planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes first, then their second bytes and so on: small ones compress well."""
    return np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    """The numbers again."""
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.int64).ravel()
