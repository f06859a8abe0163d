"""Consistent weighted sampling: fingerprints of weighted words.

A document is its words with their counts w. For sample k every word draws,
from hashes of itself and k, r and c from Gamma(2, 1) and b from [0, 1), and

    t = floor(ln w / r + b),    ln a = ln c - r * (t - b + 1).

The word with the smallest a is the sample, as the pair (word, t). Two
documents have equal samples with a probability of exactly their generalised
Jaccard similarity: sum of smaller weights by sum of larger weights. The
likeness of two fingerprints is the share of equal samples.

All of it is columns and aggregates. A word that stands equally often in a text
and in its edited text is drawn once for both. A smallest ``a`` and its word
travel together in one long, so that a sample is a plain minimum.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.shared import staged

SAMPLES = 48
BLANKS = r"[\x20\x09-\x0D]+"
NO_ID = -(2**63)  # stands for a null id, before all others
LOW = 4294967295
# The smallest a of a text of total weight W is exponential with mean 1 / W: above
# ENOUGH / W with probability exp(-ENOUGH).
ENOUGH = 20.0

def _unit(bits: Column) -> Column:
    """32 bits as a number between 0 and 1, never at its ends."""
    return (bits + F.lit(0.5)) / F.lit(4294967296.0)


def _product(hashed: Column) -> Column:
    """Product of two uniforms from 64 bits; its negative log is Gamma(2, 1)."""
    return _unit(F.shiftrightunsigned(hashed, 32)) * _unit(hashed.bitwiseAND(F.lit(LOW)))


def sample(term: Column, log_weight: Column, limit: Column, salts: tuple[int, int, int]) -> Column:
    """ln a in the upper and the hash of (term, t) in the lower 32 bits of a long.

    Null where a is sure to be above ``limit`` / w: a is at least c * exp(-r) / w,
    exp(-r) is the product of r's uniforms, and c is at least 1 less the product
    of its own. So most words cost no logarithm.
    """
    of_r, of_c, of_b = (F.xxhash64(term.bitwiseXOR(F.lit(s))) for s in salts)
    r, c = -F.ln(_product(of_r)), -F.ln(_product(of_c))
    b = _unit(of_b.bitwiseAND(F.lit(LOW)))
    t = F.floor(log_weight / r + b)
    log_a = F.ln(c) - r * (t - b + 1)
    place = F.floor((F.greatest(F.least(log_a, F.lit(60.0)), F.lit(-60.0)) + 64) * 16777216)
    packed = F.shiftleft(place, 32) + F.xxhash64(term, t).bitwiseAND(F.lit(LOW))
    return F.when((1 - _product(of_c)) * _product(of_r) <= limit, packed)


def next_in_order(rows: DataFrame) -> DataFrame:
    """(id, mark, n_chars, next_id, next_mark) by ascending id, the first after the last.

    A range sort, a lead within each range, and one row per range for its end.
    """
    ranged = staged(
        rows.select("id", "mark", "n_chars")
        .distinct()
        .repartitionByRange("id", "mark")
        .withColumn("part", F.spark_partition_id()),
        "order",
    )
    firsts = ranged.groupBy("part").agg(F.min(F.struct("id", "mark")).alias("first"))
    after = F.lead("first").over(Window.orderBy("part"))
    beginning = F.min("first").over(Window.partitionBy())
    firsts = firsts.select("part", F.coalesce(after, beginning).alias("after"))
    following = F.lead(F.struct("id", "mark")).over(Window.partitionBy("part").orderBy("id", "mark"))
    joined = ranged.withColumn("following", following).join(firsts, "part")
    following = F.coalesce("following", "after")
    return joined.select(
        "id", "mark", "n_chars", following["id"].alias("next_id"), following["mark"].alias("next_mark")
    )


def signatures(texts: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(id, mark, samples, edited_samples) of (id, mark, shared, rest, edited_rest).

    A text is its shared part and its rest, the edited text the shared part and
    the edited rest; all parts end between words. Null for texts without words.
    """
    salts = random.Random(20240229)
    parts = [F.split(part, BLANKS).alias(part) for part in ("rest", "shared", "edited_rest")]
    counted = (
        texts.select("id", "mark", *parts)
        .select(
            "id",
            "mark",
            F.size("rest").alias("before"),
            (F.size("rest") + F.size("shared")).alias("after"),
            (F.size("shared") + F.least(F.size("rest"), F.size("edited_rest"))).alias("n"),
            F.posexplode(F.concat("rest", "shared", "edited_rest")).alias("at", "word"),
        )
        .where("word <> ''")
        .groupBy("id", "mark", F.xxhash64("word").alias("term"))
        .agg(
            F.count(F.when(F.col("at") < F.col("after"), 1)).alias("here"),
            F.count(F.when(F.col("at") >= F.col("before"), 1)).alias("there"),
            F.max("n").alias("total"),
        )
    )
    side = lambda number, weight: F.struct(F.lit(number).alias("side"), F.col(weight).alias("w"))
    sides = F.when(F.col("here") == F.col("there"), F.array(side(2, "here"))).otherwise(F.array(side(0, "here"), side(1, "there")))
    weighed = counted.select("id", "mark", "term", "total", F.inline(sides)).where("w > 0")
    weighed = weighed.select(
        "id", "mark", "side", "term", F.ln("w").alias("log_w"), (F.lit(ENOUGH) * F.col("w") / F.greatest("total", F.lit(1))).alias("limit")
    )
    draws = []
    for k in range(samples):
        three = tuple(salts.getrandbits(63) for _ in range(3))
        draws.append(F.min(sample(F.col("term"), F.col("log_w"), F.col("limit"), three)).alias(f"s{k}"))
    smallest = weighed.groupBy("id", "mark", "side").agg(*draws)
    mins = [
        F.min(F.when(F.col("side") != other, F.col(f"s{k}"))).alias(f"{name}{k}")
        for name, other in (("t", 1), ("e", 0))
        for k in range(samples)
    ]
    both = smallest.groupBy("id", "mark").agg(
        *mins, F.max(F.col("side") != 1).alias("has_t"), F.max(F.col("side") != 0).alias("has_e")
    )
    out = []
    for name, alias in (("t", "samples"), ("e", "edited_samples")):
        array = F.array(*[F.coalesce(F.col(f"{name}{k}").bitwiseAND(F.lit(LOW)), F.lit(0)) for k in range(samples)])
        out.append(F.when(F.col(f"has_{name}"), array).alias(alias))
    return both.select("id", "mark", *out)


def likeness(left: Column, right: Column) -> Column:
    """Share of equal samples; texts without words are alike to each other and to nothing else."""
    equal = F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda same: same))
    share = equal / F.size(left)
    return F.when(left.isNull() & right.isNull(), 1.0).when(left.isNull() | right.isNull(), 0.0).otherwise(share)


def hexed(samples: Column) -> Column:
    """Eight hex digits per sample; empty for texts without words."""
    return F.coalesce(F.array_join(F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), ""), F.lit(""))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per distinct (doc_id, text) of ``docs``.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The edited text has its last floor(n_chars / 4)
    code points replaced by the first as many of the next document's, in
    ascending order of doc_id, null first; the first follows the last. A null
    text is empty and has an empty fingerprint. Rows that share an id follow
    each other in a fixed order; repeated rows count once. A single document
    follows itself. Extra columns are not read. An empty table gives no rows.
    """
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    docs = docs.withColumn("mark", F.xxhash64("id", "text"))
    order = staged(next_in_order(docs.withColumn("n_chars", F.length("text").cast("long"))), "next")
    before = order.select(
        F.col("next_id").alias("id"),
        F.col("next_mark").alias("mark"),
        F.col("id").alias("before_id"),
        F.col("mark").alias("before_mark"),
        F.col("n_chars").alias("before_n_chars"),
    )
    order = staged(order.join(before, ["id", "mark"]), "neighbours")
    # The whole texts are shuffled once, and read from there by both sides of the next join.
    placed = docs.join(order, ["id", "mark"]).dropDuplicates(["id", "mark"])
    quarter = lambda n: F.expr(f"CAST({n} div 4 AS INT)")
    heads = placed.select(
        F.col("before_id").alias("id"),
        F.col("before_mark").alias("mark"),
        F.substring("text", F.lit(1), quarter("before_n_chars")).alias("head"),
    )
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - quarter("n_chars")).cast("int"))
    texts = placed.join(heads, ["id", "mark"]).withColumn("kept", kept)
    texts = texts.withColumn("shared", F.regexp_extract("kept", r"^([\s\S]*[\x20\x09-\x0D])?", 0))
    end, edited = F.length("shared") + 1, F.concat("kept", "head")
    told = texts.select("id", "mark", "next_id", "next_mark", "n_chars", F.sha2(edited.cast("binary"), 256).alias("edited_sha256"))
    texts = texts.select(
        "id",
        "mark",
        "shared",
        F.substring("text", end, F.col("n_chars").cast("int")).alias("rest"),
        F.substring(edited, end, F.col("n_chars").cast("int")).alias("edited_rest"),
    )
    signed = staged(told.join(signatures(texts, samples), ["id", "mark"], "left"), "signatures")
    following = signed.select(F.col("id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("samples").alias("next_samples"))
    told = signed.join(following, ["next_id", "next_mark"], "left")
    return told.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        hexed(F.col("samples")).alias("fingerprint"),
        hexed(F.col("edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next_samples")).alias("near_next"),
    )
