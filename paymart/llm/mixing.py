"""Mixing sources to target weights.

Every document gets a hash-random key. Documents are sorted by key within
their source, token counts are summed up in that order, and each source is cut
at its exact budget; a budget above the source's size repeats it in epochs.

The sort is distributed: keys are uniform, so equal ranges of keys are equally
full, and a (source, range) pair is the unit of sorting. What lies before a
range comes from sums over ranges, in two levels, so that a source with a
third of all documents is never in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.shared import staged

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60
FINE = 1024  # ranges of keys within a coarse range


def word_count(text: Column) -> Column:
    """Words of a text, runs of anything but 0x20 and 0x09-0x0D; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: int) -> Column:
    """60 bits of a hash of id and seed: the same on every run."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2
) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn, and share
    ``share`` times the size of all. A target stops at ``max_epochs`` times its
    source's size; what is left over goes to the others by weight, until none
    is above. Ranks come from a range sort with counts per range, and each
    round of the sharing is one aggregate of one row.
    """
    ranged = staged(
        sizes.withColumn("gone", F.col("source").isNull())
        .repartitionByRange(F.col("gone"), F.col("source"))
        .withColumn("part", F.spark_partition_id()),
        "sources",
    )
    parts = ranged.groupBy("part").count()
    before = parts.select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy("gone", "source"))
    rank = F.col("before") + F.col("inside") - 1
    taken_weights = F.array(*[F.lit(float(w)) for w in weights])
    weighed = staged(
        ranged.withColumn("inside", inside)
        .join(before, "part")
        .select(
            "source",
            "source_size",
            F.element_at(taken_weights, (rank % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"),
        ),
        "weights",
    )
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("cap") <= F.col("weight") * F.lit(level)
        row = weighed.agg(
            F.sum("source_size").alias("size"),
            F.sum(F.when(above, F.col("cap"))).alias("cap"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if row["n"] == capped or not row["weight"]:
            break
        capped = row["n"]
        level = (share * row["size"] - (row["cap"] or 0.0)) / row["weight"]
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level if level is not None else 0.0))
    return weighed.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2,
    seed: int = 17,
    rows_per_range: int = 1000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source and what ``size`` and ``keep`` need).

    doc_id, source, the columns ``keep``, size, source_size, target, epochs (whole
    passes over the source), taken (words the mix takes, repeats counted). The
    taken words of a source add up to its target, rounded down.

    - A null source is a source, a null size (a null text) is 0. Rows without an
      id get a key of their size and kept columns.
    - Repeated rows each count. Rows that tie in key, id and size are
      interchangeable: what they take together is the same.
    - Texts of any length are counted whole. An empty table gives no rows.
    - A kept column with a name of the result, such as size or taken, gets an
      underscore before it; other columns are not read, whatever their names.
    """
    own = {"doc_id", "source", "size", "source_size", "target", "epochs", "taken"}
    names, taken_names = [], {*own, *(c for c in keep if c not in own)}
    for c in keep:
        name = c
        while name in own or (name != c and name in taken_names):
            name = f"_{name}"
        taken_names.add(name)
        names.append(name)
    kept = F.struct(F.lit(0).alias("nothing"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    whole = F.coalesce(size, F.lit(0)).cast("long")
    without_id = F.xxhash64(F.col("source").cast("string"), whole, *[F.col(f"`{c}`").cast("string") for c in keep]).cast("string")
    sized = staged(
        docs.select(
            "doc_id",
            "source",
            kept.alias("kept"),
            whole.alias("size"),
            random_key(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none "), without_id)), seed).alias("key"),
        ),
        "sized",
    )
    n = sized.count()
    ranges = max(1, -(-n // rows_per_range))
    width = (1 << KEY_BITS) // ranges + 1
    sized = sized.withColumn("fine", F.expr(f"key div {width}L"))
    sized = sized.withColumn("coarse", F.expr(f"fine div {FINE}L"))
    # A source as two columns without nulls: rows sorted by them meet their range without another exchange.
    sized = sized.withColumns({"no_source": F.col("source").isNull(), "of_source": F.coalesce(F.col("source").cast("string"), F.lit(""))})

    sums = sized.groupBy("source", "coarse", "fine").agg(F.sum("size").alias("words"))
    sums = staged(sums, "range-sums")
    before_fine = F.sum("words").over(Window.partitionBy("source", "coarse").orderBy("fine")) - F.col("words")
    coarse = sums.groupBy("source", "coarse").agg(F.sum("words").alias("words"))
    before_coarse = F.sum("words").over(Window.partitionBy("source").orderBy("coarse")) - F.col("words")
    coarse = coarse.select(
        F.col("source").alias("c_source"), F.col("coarse").alias("c_coarse"), before_coarse.alias("before_coarse")
    )
    totals = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, share, max_epochs).select(
        F.col("source").alias("t_source"), "source_size", "target"
    )
    starts = (
        sums.withColumn("before_fine", before_fine)
        .join(coarse, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("coarse") == F.col("c_coarse")))
        .join(targets, F.col("source").eqNullSafe(F.col("t_source")))
        .select(
            F.col("source").isNull().alias("r_no_source"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("r_of_source"),
            F.col("fine").alias("r_fine"),
            (F.col("before_coarse") + F.col("before_fine")).alias("before_range"),
            "source_size",
            "target",
        )
    )
    order = Window.partitionBy("no_source", "of_source", "fine").orderBy("key", "doc_id", "size")
    inside = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    budget = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - F.col("epochs") * F.col("source_size")
    start = F.col("before_range") + F.col("inside")
    partial = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), rest - start))
    same = (F.col("no_source") == F.col("r_no_source")) & (F.col("of_source") == F.col("r_of_source")) & (F.col("fine") == F.col("r_fine"))
    return (
        sized.withColumn("inside", inside)
        .join(starts, same)
        .withColumn("epochs", epochs.cast("long"))
        .select(
            "doc_id",
            "source",
            *[F.col(f"kept.c{i}").alias(name) for i, name in enumerate(names)],
            "size",
            "source_size",
            "target",
            "epochs",
            (F.col("epochs") * F.col("size") + partial).cast("long").alias("taken"),
        )
    )
