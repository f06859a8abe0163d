"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact check.

1. Each text becomes the set of hashes of its word shingles, a MinHash
   signature, band keys and a sketch of one byte per MinHash.
2. Rows with equal sets are one class; the number of one of its rows stands
   for it, so rows that share an id but not the text stay apart.
3. In each bucket of a band all members are compared with the first one:
   as many pairs as members. The sketches are compared in batches. After each
   batch a pair goes when the posterior probability that its similarity
   reaches the threshold is below ``miss``. What is left is checked on full sets.
4. Links give components. Only buckets whose members still belong to several
   components can hold further links between them: those are cut into tiles of
   bounded size, and pairs of different components are compared in the tiles,
   each pair only in the first band that it shares: first the sketches alone,
   then, among members with a likely pair in the tile, the sets as well. A tile
   gives back such members, then links that join components, never pairs.
   So no link between components is lost and no group is ever spelled out, and
   a set travels only to the tiles where a pair of it is likely.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.components import connected_components
from paymart.llm.shared import broadcast_if_small, free_names, staged
from paymart.llm.words import Words, hash_words, mix, utf8_column

BANDS, ROWS = 32, 4  # a pair at 0.85 shares no band with probability 5e-11
BATCH = 32  # MinHashes compared between two looks at the posterior
TILE = 512  # members of one side of a tile

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = _RANDOM.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)

SIGNED = "doc_id long, text_hash long, n_shingles long, set_key binary, sketch binary, bands array<long>"


def shingle_sets(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and their numbers.

    A text with fewer words than ``size`` has its whole sequence as one shingle;
    one without words has none.
    """
    words: Words = hash_words(*utf8_column(column), lower=True)
    hashes, inside = words.windows(size)
    for length in range(1, size):
        short = np.flatnonzero(words.counts == length)
        if len(short):
            at = words.offsets[short]
            hashes[at] = words.windows(length)[0][at]
            inside[at] = True
    cuts = words.offsets
    sets = [np.unique(hashes[a:b][inside[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MinHashes (texts x permutations) of non-empty sets."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((len(sizes), BANDS * ROWS), np.uint64)
    for k, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
        out[:, k] = np.minimum.reduceat(hashes * factor + shift, starts)
    return mix(out)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                hashes, sizes = shingle_sets(part.column("text"), size)
                full = np.flatnonzero(sizes)
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                keys = [hashlib.blake2b(hashes[cuts[i] : cuts[i + 1]].tobytes(), digest_size=16).digest() for i in full]
                bands, sketch = [None] * len(sizes), [None] * len(sizes)
                key = [None] * len(sizes)
                if len(full):
                    minima = signatures(hashes, sizes[full])
                    rows = minima.reshape(len(full), BANDS, ROWS)
                    folded = np.full((len(full), BANDS), 0, np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
                    for r in range(ROWS):
                        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
                    small = minima.astype(np.uint8)
                    for at, i in enumerate(full):
                        bands[i], sketch[i], key[i] = folded[at].view(np.int64), small[at].tobytes(), keys[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(sizes),
                        pa.array(key, pa.binary()),
                        pa.array(sketch, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_key", "sketch", "bands"],
                )

    return run


def _sets(size: int):
    """The shingles of each text as one binary of sorted hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                hashes, sizes = shingle_sets(part.column("text"), size)
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                sets = [hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(sets, pa.binary())], ["rep", "shingles"])

    return run


def least_matches(threshold: float, miss: float, permutations: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """(MinHashes compared, fewest matches with which a pair goes on), for each batch.

    With a uniform prior, m matches of n leave a similarity of at least t with
    posterior probability P(Binomial(n + 1, t) <= m). t is raised by the chance
    that two different MinHashes share a byte.
    """
    t = threshold + (1 - threshold) / 256
    looks = []
    for n in range(BATCH, permutations + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        looks.append((n, m))
    return looks


def _likely(left: np.ndarray, right: np.ndarray, looks: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the rows whose sketches may still reach the threshold."""
    alive, matches, before = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, fewest in looks:
        matches = matches + (left[alive, before:n] == right[alive, before:n]).sum(axis=1)
        passed = matches >= fewest
        alive, matches, before = alive[passed], matches[passed], n
    return alive


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)


def _prune(looks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = _likely(_matrix(batch.column("sketch_a")), _matrix(batch.column("sketch_b")), looks)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def _likely_pairs(tile: pa.Table, looks, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a tile with those it may be linked with: of another component, and not together in an earlier band."""
    ids, groups, sizes = (tile[c].to_numpy() for c in ("rep", "component", "size"))
    slots, sketches = tile["slot"].to_numpy(), _matrix(tile["sketch"])
    earlier = tile["earlier"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    low, high = tile["low"][0].as_py(), tile["high"][0].as_py()
    columns = np.flatnonzero(slots == high)
    for i in np.flatnonzero(slots == low):
        other = columns[(groups[columns] != groups[i]) & ((ids[columns] > ids[i]) | (low != high))]
        like = 100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i])
        other = other[like & ~(earlier[other] == earlier[i]).any(axis=1)]
        yield i, other[_likely(np.broadcast_to(sketches[i], (len(other), sketches.shape[1])), sketches[other], looks)]


def _likely_members(looks, percent: int):
    """The members of a tile that have a likely pair there."""

    def run(tile: pa.Table) -> pa.Table:
        found = np.zeros(tile.num_rows, bool)
        for i, near in _likely_pairs(tile, looks, percent):
            found[near] = True
            found[i] |= len(near) > 0
        return tile.select(["band", "low", "high", "rep"]).filter(pa.array(found))

    return run


def _prune_tile(looks, percent: int):
    def run(tile: pa.Table) -> pa.Table:
        ids, groups = (tile[c].to_numpy() for c in ("rep", "component"))
        sets = [np.frombuffer(x, np.uint64) for x in tile["shingles"].to_pylist()]
        joined: dict[int, int] = {}  # components that links of this tile have joined

        def root(group: int) -> int:
            while group in joined:
                group = joined[group]
            return group

        a, b = [], []
        for i, near in _likely_pairs(tile, looks, percent):
            for j in near[_linked(sets[i], [sets[j] for j in near], percent)].tolist():
                x, y = root(int(groups[i])), root(int(groups[j]))
                if x != y:
                    joined[max(x, y)] = min(x, y)
                    a.append(min(ids[i], ids[j]))
                    b.append(max(ids[i], ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _linked(mine: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Numbers of the sorted sets whose similarity to ``mine`` reaches the threshold."""
    if not others:
        return np.zeros(0, np.int64)
    sizes = np.array([len(x) for x in others])
    shingles = np.concatenate(others)
    at = np.minimum(np.searchsorted(mine, shingles), len(mine) - 1)
    both = np.add.reduceat((mine[at] == shingles).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return np.flatnonzero(100 * both >= percent * (len(mine) + sizes - both))


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            pairs = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True)
            for i, (x, y) in enumerate(pairs):
                if len(_linked(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)], percent)):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return run


def near_duplicates(
    docs: DataFrame, percent: int = 80, shingle: int = 5, miss: float = 1e-7, tile: int = TILE
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of ``shingle``-word shingles (A-Z lower-cased). component_id is
    the smallest id reachable by links; kept marks one row of each component: that
    with the smallest id (doc_id = component_id).

    - Every row is a document. Rows that share an id are judged each by its own
      text; of several rows with the kept id the first by a hash of the text is
      kept, and of equal rows one.
    - A row without an id is linked like others; ids come before it. component_id is
      null where none of a component's rows has an id.
    - Texts without words, or null, have no shingles and no links: each is kept,
      with its own id as component.
    - Texts of any length are whole. Only doc_id and text are read, whatever
      further columns are named. An empty table gives no rows.
    """
    judged = _judged(docs, percent, shingle, miss, tile)
    return judged.select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, percent: int, shingle: int, miss: float = 1e-7, tile: int = TILE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row."""
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    looks = least_matches(percent / 100, miss)
    signed = docs.mapInArrow(_sign(shingle), SIGNED)
    signed = staged(signed.select(F.monotonically_increasing_id().alias("row"), "*"), "signed")
    full = signed.where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row")).alias("first")
    classes = full.groupBy("set_key").agg(F.min("row").alias("rep"), first)
    classes = staged(classes, "classes")
    reps = full.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select(
        F.col("row").alias("rep"), "doc_id", "text_hash", F.col("n_shingles").alias("size"), "sketch", "bands"
    )
    reps = staged(reps, "representatives")
    sketches = reps.select("rep", "size", "sketch")
    banded = reps.select("rep", F.explode("bands").alias("band"))

    buckets = banded.groupBy("band").agg(F.count("rep").alias("members"), F.min("rep").alias("pivot"))
    buckets = staged(buckets.where("members > 1"), "buckets")
    in_buckets = staged(banded.join(buckets, "band"), "members")
    pairs = in_buckets.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = staged(pairs, "star-pairs")
    likely = (
        _with_pivots(pairs.join(sketches.toDF("b", "size_b", "sketch_b"), "b"), sketches.toDF("a", "size_a", "sketch_a"))
        .where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
        .mapInArrow(_prune(looks), "a long, b long")
    )
    links = staged(_confirmed(docs, reps, staged(likely, "likely"), shingle, percent), "star-links")

    component = staged(connected_components(links).withColumnRenamed("node", "rep"), "components")
    known = in_buckets.where("members > 2").join(component, "rep", "left")
    known = staged(known.withColumn("component", F.coalesce("component", "rep")), "known")
    mixed = known.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = staged(mixed.where("low <> high").select("band"), "mixed-buckets")
    slots = F.ceil(F.col("members") / tile)
    known = staged(known.join(mixed, "band"), "to-compare")
    by_tile = ["band", "low", "high"]
    before = F.slice("bands", 1, F.array_position("bands", F.col("band")).cast("int") - 1)
    sketches = reps.select("rep", "size", "sketch", "bands")

    def sketched(members: DataFrame) -> DataFrame:
        rows = members.join(sketches, "rep").withColumn("earlier", before).withColumn("slots", slots.cast("int"))
        return rows.withColumn("slot", F.pmod(F.xxhash64("rep"), F.col("slots")).cast("int"))

    member = ["slot", "rep", "component", "size", "sketch", "earlier"]
    tiles = sketched(known).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1))).select(
        "band", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"), *member
    )
    likely = tiles.groupBy(*by_tile).applyInArrow(_likely_members(looks, percent), "band long, low int, high int, rep long")
    likely = likely.groupBy("band", "rep").agg(F.collect_list(F.struct("low", "high")).alias("tiles"))
    likely = staged(likely, "likely-members")  # one row per member and band: no join makes more rows than there are members
    sets = _sets_of(docs, reps, likely.select("rep"), shingle)
    tiles = sketched(known.join(likely, ["band", "rep"])).join(sets, "rep").select("band", F.inline("tiles"), *member, "shingles")
    more = tiles.groupBy(*by_tile).applyInArrow(_prune_tile(looks, percent), "a long, b long")
    links = links.unionByName(staged(more, "tile-links"))
    component = connected_components(links).withColumnRenamed("node", "rep")

    resolved = classes.join(component, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    firsts = resolved.groupBy("component").agg(F.min("first").alias("first_of_all"))
    resolved = resolved.join(staged(firsts, "firsts"), "component").select("set_key", "first_of_all")
    linked = F.col("first_of_all").isNotNull()
    return signed.join(staged(resolved, "resolved"), "set_key", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(linked, F.col("first_of_all.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce(F.col("first_of_all.row") == F.col("row"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns, whatever these are named.

    A row goes by its own text, not by its id: a row that shares its id with a copy
    stays. Of rows equal in id and text one stays, the first by its other columns.
    Rows without words stay, all of them. Columns keep order and names.
    """
    pair = staged(_judged(docs, percent, shingle), "judged").groupBy("doc_id", "text_hash").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("n_shingles")
    )
    decided = staged(pair.where("NOT kept OR (n > 1 AND n_shingles > 0)").select("doc_id", "text_hash", "kept"), "copies")
    names = free_names(docs, "copy_id", "copy_hash")
    own_hash = F.xxhash64(F.col("text").cast("string"))

    def of(rows: DataFrame, how: str) -> DataFrame:
        pairs = broadcast_if_small(rows.select("doc_id", "text_hash").toDF(*names), row_bytes=32)
        return docs.join(pairs, F.col("doc_id").cast("long").eqNullSafe(F.col(names[0])) & (own_hash == F.col(names[1])), how)

    rest = of(decided, "left_anti")
    repeated = decided.where("kept")
    if not repeated.take(1):
        return rest
    [one] = free_names(docs, "one_row")
    key = (F.col("doc_id").cast("long"), own_hash)
    single = of(repeated, "left_semi").groupBy(*key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(one))
    return rest.unionByName(single.select(f"{one}.*"))


def _confirmed(docs: DataFrame, reps: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    sets = _sets_of(docs, reps, needed, shingle)
    others = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b")), "b")
    pivots = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    return _with_pivots(others, pivots).mapInArrow(_confirm(percent), "a long, b long")


def _with_pivots(pairs: DataFrame, pivots: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) joined with ``pivots`` on a, the pairs of a pivot dealt over many tasks by b.

    A pivot is sent to the tasks that have pairs of it, and to each once: it may
    be the pivot of a third of all rows.
    """
    slots = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.withColumn("slot", F.pmod(F.xxhash64("b"), F.lit(slots)).cast("int"))
    asked = dealt.select("a", "slot").distinct()
    return dealt.join(asked.join(pivots, "a"), ["a", "slot"]).drop("slot")


def _sets_of(docs: DataFrame, reps: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(rep, shingles) of the given classes, from the text of the row that stands for each."""
    needed = reps.select("rep", "doc_id", "text_hash").join(wanted.distinct(), "rep", "left_semi")
    needed = staged(needed.toDF("rep", "of_id", "of_hash"), "needed")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    texts = docs.join(broadcast_if_small(needed, row_bytes=32), same).select("rep", "text")
    return staged(texts.mapInArrow(_sets(shingle), "rep long, shingles binary"), "sets").dropDuplicates(["rep"])
