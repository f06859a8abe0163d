"""Hard negatives of anchors by Fagin's threshold algorithm.

Rows are dealt into blocks and the anchors into parts; each pair of a block and
a part is one group. A group sorts its rows once per dimension. For an anchor
it walks down all lists at once, from the end that the sign of the anchor's
component names, scores each row it meets for the first time on its whole
vector, and stops as soon as no row that it has not met can matter: the
threshold (the score of a row that stood at the present depth of every list)
lies strictly below the k-th score of every window, or below the window. The
best k of every block then meet per anchor.

Two rounds: the positives of each anchor come first, and their scores are the
windows of its negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.shared import staged

BLOCK_ROWS = 16_384  # rows that a group sorts
PART_ROWS = 4_096  # anchors that a group serves
FIRST_DEPTH = 16  # of the lists; then twice as deep each time
EXACT = 2.0**53  # whole numbers below it are exact as doubles


class SortedLists:
    """The rows of a block and, per dimension, their order by that component."""

    def __init__(self, vectors: np.ndarray):
        self.rows = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.largest = float(np.abs(vectors).max(initial=0.0))

    def scores(self, picked: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products with the anchor: whole numbers, exact."""
        rows = self.rows[picked]
        if self.largest * np.abs(anchor).sum() < EXACT:
            return (rows @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in rows.tolist()], np.int64)

    def _depth(self, anchor: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int) -> float:
        """No row that is first met below this depth scores higher."""
        n = len(self.rows)
        last = self.rows[self.order[n - depth, down], down] @ anchor[down]
        return float(last + self.rows[self.order[depth - 1, up], up] @ anchor[up])

    def best(self, anchor: np.ndarray, admitted: np.ndarray, windows: list[tuple], ids: np.ndarray, k: int) -> list:
        """Per window the first k admitted rows with low <= score <= high, as (rows, scores).

        Higher scores come first, then smaller ids. ``None`` is an open end; the
        ends are exact numbers (whole or fractions).
        """
        n = len(self.rows)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        scores, met, depth = np.zeros(n, np.int64), np.zeros(n, bool), 0
        while not met.all():
            deeper = min(n, max(FIRST_DEPTH, 2 * depth)) if len(up) or len(down) else 0
            now = np.zeros(n, bool)
            if deeper:
                now[self.order[n - deeper : n - depth, down]] = True
                now[self.order[depth:deeper, up]] = True
                now &= ~met
            else:  # an anchor of zeros has no list to walk: every row scores 0
                now[:] = True
            new = np.flatnonzero(now)
            scores[new] = self.scores(new, anchor)
            met |= now
            depth = deeper
            if deeper and not met.all():
                # Doubles beyond 2**53 are rounded: let the threshold err upwards.
                threshold = self._depth(anchor, up, down, depth)
                threshold += abs(threshold) * 1e-12 if self.largest * np.abs(anchor).sum() >= EXACT else 0.0
                if all(self._settled(scores, met & admitted, w, k, threshold) for w in windows):
                    break
        return [self._first(scores, self._inside(scores, met & admitted, w), ids, k) for w in windows]

    @staticmethod
    def _inside(scores: np.ndarray, rows: np.ndarray, window: tuple) -> np.ndarray:
        low, high = window
        picked = rows.copy()
        if low is not None:
            picked &= scores >= low
        if high is not None:
            picked &= scores <= high
        return np.flatnonzero(picked)

    def _settled(self, scores, rows, window, k, threshold) -> bool:
        if window[0] is not None and threshold < window[0]:
            return True
        inside = scores[self._inside(scores, rows, window)]
        return len(inside) >= k and threshold < np.partition(inside, len(inside) - k)[len(inside) - k]

    @staticmethod
    def _first(scores, rows, ids, k):
        if len(rows) > k:
            rows = rows[scores[rows] >= np.partition(scores[rows], len(rows) - k)[len(rows) - k]]
        rows = rows[np.lexsort((ids[rows], -scores[rows]))][:k]
        return rows, scores[rows]


def _matrix(column: pa.ChunkedArray, width: int, scale: float) -> np.ndarray:
    """floor(scale * x) of all vectors as rows; what a short vector lacks is 0."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = np.floor(scale * values)
    return out


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def _width(*tables: pa.Table) -> int:
    return max((int(t["n"].to_numpy().max()) for t in tables if t.num_rows), default=0)


def _prepared(embeddings: DataFrame, anchors: Column) -> DataFrame:
    """Rows that take part, each with a number of its own, written to the shared folder."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        vector.alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return staged(rows.select(F.monotonically_increasing_id().alias("row"), "*", F.size("vector").alias("n")), "vectors")


def _pairs(rows: DataFrame, anchors: DataFrame, block_rows: int, part_rows: int):
    """Rows and anchors grouped by (block, part); every block meets every part once."""
    blocks = -(-max(1, rows.count()) // block_rows)
    parts = -(-max(1, anchors.count()) // part_rows)
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    one_of = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    left = anchors.select("*", one_of(parts).alias("part"), all_of(blocks).alias("block"))
    # Columns of their own: both sides come from one table, and a cogroup does not tell its columns apart.
    columns = [F.col(c).alias(c) for c in ("row", "vec_id", "label", "vector", "n")]
    right = rows.select(*columns, one_of(blocks).alias("block"), all_of(parts).alias("part"))
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))


FOUND = "anchor LONG, anchor_id LONG, nth INT, bound LONG, bound_id LONG, row LONG, vec_id LONG, score LONG"


def _search(scale: float, k: int, percent: tuple[int, int] | None):
    """The function of a group: the best k rows per anchor and window.

    Without ``percent`` the window is open and rows of the anchor's own label
    are searched, itself left out; with it, rows of other labels whose score is
    between these shares of a positive's.
    """

    def search(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = {name: [] for name in pa_schema.names}
        if anchors.num_rows and rows.num_rows:
            width = _width(anchors, rows)
            lists = SortedLists(_matrix(rows["vector"], width, scale))
            row, ids, labels = (_numbers(rows, c) for c in ("row", "vec_id", "label"))
            targets = anchors["positives"].to_pylist() if percent else [None] * anchors.num_rows
            for a, a_id, label, vector, positives in zip(
                _numbers(anchors, "row").tolist(),
                _numbers(anchors, "vec_id").tolist(),
                _numbers(anchors, "label"),
                _matrix(anchors["vector"], width, scale),
                targets,
            ):
                if percent is None:
                    admitted, windows, bounds = (labels == label) & (row != a), [(None, None)], [(0, 0, 0)]
                else:
                    admitted, windows = labels != label, []
                    bounds = [(p["nth"], p["score"], p["vec_id"]) for p in positives]
                    for _, score, _ in bounds:  # low <= 100 * s <= high, in whole numbers
                        windows.append((-(-percent[0] * score // 100), percent[1] * score // 100))
                for (nth, bound, bound_id), (picked, scores) in zip(bounds, lists.best(vector, admitted, windows, ids, k)):
                    for name, values in zip(
                        pa_schema.names,
                        ([a], [a_id], [nth], [bound], [bound_id], row[picked], ids[picked], scores),
                    ):
                        found[name].extend(values * len(picked) if isinstance(values, list) else values.tolist())
        return pa.table(found, schema=pa_schema)

    pa_schema = pa.schema(
        [(name, pa.int32() if kind == "INT" else pa.int64()) for name, kind in (c.split() for c in FOUND.split(", "))]
    )
    return search


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of all blocks, per anchor and window."""
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "vec_id", "row")
    return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    percent: tuple[int, int] = (80, 100),
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Rows of other labels that score nearly as high as an anchor's positives.

    ``embeddings`` has vec_id, label and embedding. A component x counts as
    floor(scale * x), a score is the whole inner product with the anchor; higher
    ones come first, ties by smaller vec_id. Positives are an anchor's first
    rows of its label other than itself. For each, the first ``negatives`` rows
    of other labels whose score is between the two shares, in percent, of the
    positive's: anchor_id, positive_id, rank (from 1), negative_id,
    positive_score, negative_score. Fewer, or none, where there are fewer.

    - A row with a null vec_id, label, vector or component, or one that is not
      finite, takes no part; null is no anchor. An empty table gives no rows.
    - Repeated rows are rows of their own: each is an anchor, and each may be
      another's positive or negative. So are rows that share an id; where all
      that is ordered by is equal, either comes first and the result is the same.
    - A component that a shorter vector lacks is 0; an empty vector scores 0.
    - Further columns, whatever their names, are not read. Texts play no part.
    - A score has to fit a BIGINT; one that does not is an error.

    Rows are dealt by number, so no label, id or copy makes a large group, and
    all groups have ``block_rows`` rows and ``part_rows`` anchors at most on average.
    """
    rows = _prepared(embeddings, anchors)
    of_anchors = rows.where("is_anchor").select("row", "vec_id", "label", "vector", "n")
    grouped = _pairs(rows, of_anchors, block_rows, part_rows)
    near = _first(grouped.applyInArrow(_search(scale, positives, None), FOUND), positives)
    bounds = near.groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").alias("nth"), "score", "vec_id"))).alias("positives")
    )
    sought = staged(of_anchors.join(bounds, "row"), "anchors")
    grouped = _pairs(rows, sought, block_rows, part_rows)
    far = _first(grouped.applyInArrow(_search(scale, negatives, percent), FOUND), negatives)
    return far.select(
        "anchor_id",
        F.col("bound_id").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("bound").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
