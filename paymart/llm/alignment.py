"""Tokens of two tokenizers over the same bytes, and how they lie on each other.

A text is cut by a byte-level BPE (A) and by a piece model with byte fallback
(B). In each batch ``pandas.merge_asof``, keyed by document, finds for the start
of every token the token of the other side that covers it; both directions
together are all overlaps, as of two overlapping tokens the later start lies in
the other token. Ends that both sides share cut the tokens into groups.

How many documents hold a pair of ids linked takes the whole corpus. A task
joins its documents to blocks and sends each distinct pair of a block once, with
the number of its documents; the answer returns the same way. Of each document
there travel only places in its block's list of pairs.

Where neither side has tokens across a single blank between two words, which is
looked up in the vocabularies, texts are cut there and each distinct word of a
block is encoded once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.known_words import KnownWords
from paymart.llm.shared import staged

BLOCK_BYTES = 4 << 20  # text of a block; one longer text is a block of its own
ALIGN_BYTES = 2 << 20  # text aligned at once
MOST_WORDS = 600_000  # that a task remembers; then it begins anew, with the same results


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable Latin-1 stands for itself; the other bytes, in order, are the
    letters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenBytes:
    """The bytes of every token of a vocabulary, and their numbers."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class ByteLevel:
    """Side A: tokens of a blank and the text; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        letters, vocabulary = byte_of_letter(), self.tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            tokens[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.bytes = TokenBytes(tokens)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        # Its own pattern cuts before every blank that another character follows, and looks at nothing before.
        steps = {k: v for k, v in (parts.get("pre_tokenizer") or {}).items() if k != "trim_offsets"}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.cuts_at_blanks = steps == plain and not parts.get("normalizer") and not parts["model"].get("dropout")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Side B: pieces of the text, before which the model puts a blank."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        ids = range(self.model.vocab_size())
        self.bytes = TokenBytes(
            [
                bytes([int(self.model.id_to_piece(i)[1:-1], 16)])
                if self.model.is_byte(i)
                else self.model.id_to_piece(i).replace("▁", " ").encode()
                for i in ids
            ]
        )
        # No piece goes on behind a blank that follows another character, and blanks are kept as they are.
        across = re.compile("[^▁]▁")
        kept = "a b  c" == self.bytes.spell(self.model.encode("a b  c")).decode()[1:]
        self.cuts_at_blanks = kept and not any(across.search(self.model.id_to_piece(i)) for i in ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass
class Aligned:
    """Tokens of several texts one after the other, in byte order.

    ``links`` are pairs of token positions, ``ends`` the last token of each group
    on both sides; ``a_doc`` and ``b_doc`` name the text of each token.
    """

    n: int
    a_ids: np.ndarray
    b_ids: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.n)


NONE = np.zeros(0, np.int64)


# White space as Python's patterns know it; beside a blank or an end of the text it asks for a closer look.
_WHITE = r"[\t\n\v\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD = rf"{_WHITE} | {_WHITE}|^{_WHITE}|{_WHITE}$"
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


class Sides:
    """Both tokenizers, and the words that they have encoded so far."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.by_word = self.a.cuts_at_blanks and self.b.cuts_at_blanks
        self.forget()

    def forget(self) -> None:
        self.known = KnownWords(self.a.encode, self.b.encode)

    def __call__(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B of each text."""
        if len(self.known.number) > MOST_WORDS:
            self.forget()
        if self.by_word:
            odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _ODD).to_pylist()
            split = [_BETWEEN_WORDS.split(t) if o else t.split(" ") for t, o in zip(texts, odd)]
        else:
            split = [[t] for t in texts]
        return tuple(self.known.ids_of(pa.array(split, pa.list_(pa.string()))))


def align(texts: list[str | None], sides: Sides) -> Aligned:
    """All texts; one that is null, empty or not spelt alike by both sides has no tokens."""
    a_lists, b_lists = [NONE for _ in texts], [NONE for _ in texts]
    some = [i for i, text in enumerate(texts) if text]
    for i, x, y in zip(some, *sides([texts[i] for i in some])):
        spelt = b" " + texts[i].encode()
        if sides.a.bytes.spell(x.tolist()) == spelt and sides.b.bytes.spell(y.tolist()) == spelt:
            a_lists[i], b_lists[i] = x, y
    a, b = sides.a, sides.b
    numbers = np.arange(len(texts))
    a_ids, a_doc = np.concatenate([NONE, *a_lists]), np.repeat(numbers, [len(x) for x in a_lists])
    b_ids, b_doc = np.concatenate([NONE, *b_lists]), np.repeat(numbers, [len(x) for x in b_lists])
    # Both sides spell the same bytes, so the running sums are places in the same text.
    a_end, b_end = np.cumsum(a.bytes.lengths[a_ids]), np.cumsum(b.bytes.lengths[b_ids])
    a_start, b_start = a_end - a.bytes.lengths[a_ids], b_end - b.bytes.lengths[b_ids]
    left = pd.DataFrame({"at": a_start, "doc": a_doc, "a": np.arange(len(a_ids))})
    right = pd.DataFrame({"at": b_start, "doc": b_doc, "b": np.arange(len(b_ids))})
    of_a = pd.merge_asof(left, right, on="at", by="doc")
    of_b = pd.merge_asof(right, left, on="at", by="doc")
    later = of_b[of_b["at"].to_numpy() > a_start[of_b["a"].to_numpy()]]  # equal starts are in of_a
    _, end_a, end_b = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
    return Aligned(
        len(texts), a_ids, b_ids, a_doc, b_doc,
        np.concatenate([of_a["a"].to_numpy(), later["a"].to_numpy()]),
        np.concatenate([of_a["b"].to_numpy(), later["b"].to_numpy()]),
        end_a, end_b,
    )


@lru_cache
def _decimals(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of all numbers up to one, right-aligned with a place behind, and which places are used."""
    numbers = np.arange(1 << max(1, largest.bit_length()))
    width = len(str(numbers[-1]))
    powers = 10 ** np.arange(width - 1, -1, -1)
    digits = np.zeros((len(numbers), width + 1), np.uint8)
    digits[:, :width] = numbers[:, None] // powers % 10 + ord("0")
    used = np.ones(digits.shape, bool)
    used[:, : width - 1] = numbers[:, None] >= powers[:-1]
    return digits, used


def spelt_groups(found: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` per text: the ids of each group."""
    n_a, n_b = len(found.a_ids), len(found.b_ids)
    # Tokens of A and B by turns: before a token of A stand the B tokens of all earlier groups.
    a_group = np.searchsorted(found.end_a, np.arange(n_a))
    b_group = np.searchsorted(found.end_b, np.arange(n_b))
    b_before = np.concatenate([[0], found.end_b + 1])[a_group] if n_a else np.zeros(0, np.int64)
    a_before = (found.end_a + 1)[b_group] if n_b else np.zeros(0, np.int64)
    ids, marks = np.zeros(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    a_place, b_place = np.arange(n_a) + b_before, np.arange(n_b) + a_before
    ids[a_place], ids[b_place] = found.a_ids, found.b_ids
    marks[a_place[found.end_a]], marks[b_place[found.end_b]] = ord("|"), ord(";")
    digits, used = _decimals(int(ids.max(initial=0)))
    letters, shown = digits[ids], used[ids]
    letters[:, -1] = marks
    spelt = letters[shown].tobytes()
    ends = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
    cuts = ends[np.concatenate([[0], np.cumsum(found.per_doc(found.a_doc) + found.per_doc(found.b_doc))])]
    return [spelt[i : j - 1] if j > i else b"" for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, a_ids, b_ids, groups and links of every document, in no exchange.

    ``groups`` are (a_end, b_end), the number of tokens of each side up to the
    group's end; ``links`` are (a, b), token positions from 0. Nulls, empty and
    repeated rows as in ``alignment_counts``.
    """
    kind = pa.list_(pa.struct([("a_end", pa.int32()), ("b_end", pa.int32())]))
    link_kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = Sides(a_path, b_path)
        for ids, texts in _in_portions(batches, ALIGN_BYTES):
            found = align(texts, sides)
            first_a = np.concatenate([[0], np.cumsum(found.per_doc(found.a_doc))])
            first_b = np.concatenate([[0], np.cumsum(found.per_doc(found.b_doc))])
            order = np.lexsort((found.link_b, found.link_a))
            link_a, link_b = found.link_a[order], found.link_b[order]
            link_doc, group_doc = found.a_doc[link_a], found.a_doc[found.end_a]
            i32 = lambda x: pa.array(x.astype(np.int32))
            off = lambda doc: i32(np.concatenate([[0], np.cumsum(found.per_doc(doc))]))
            groups = pa.StructArray.from_arrays(
                [i32(found.end_a + 1 - first_a[group_doc]), i32(found.end_b + 1 - first_b[group_doc])], ["a_end", "b_end"]
            )
            links = pa.StructArray.from_arrays([i32(link_a - first_a[link_doc]), i32(link_b - first_b[link_doc])], ["a", "b"])
            columns = [
                pa.array(ids, pa.int64()),
                pa.ListArray.from_arrays(off(found.a_doc), i32(found.a_ids)),
                pa.ListArray.from_arrays(off(found.b_doc), i32(found.b_ids)),
                pa.ListArray.from_arrays(off(group_doc), groups).cast(kind),
                pa.ListArray.from_arrays(off(link_doc), links).cast(link_kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "a_ids", "b_ids", "groups", "links"])

    return _docs(docs).mapInArrow(
        run,
        "doc_id LONG, a_ids ARRAY<INT>, b_ids ARRAY<INT>, "
        "groups ARRAY<STRUCT<a_end: INT, b_end: INT>>, links ARRAY<STRUCT<a: INT, b: INT>>",
    )


def _in_portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of rows, as many as have some ``size`` bytes."""
    ids, texts, n = [], [], 0
    for batch in batches:
        for i, text in zip(batch["doc_id"], batch["text"]):
            text = text.as_py()
            ids.append(i.as_py())
            texts.append(text)
            n += len(text or "") + 64
            if n >= size:
                yield ids, texts
                ids, texts, n = [], [], 0
    if ids:
        yield ids, texts


def _pack(*columns: np.ndarray) -> bytes:
    """Small whole numbers, all first bytes before all second ones, compressed."""
    planes = [np.ascontiguousarray(c, np.uint32).view(np.uint8).reshape(-1, 4).T for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes, axis=1).tobytes())


def _unpack(blob: bytes, n: int) -> list[np.ndarray]:
    """The n columns again."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
    return np.split(numbers, n)


BLOCK = (
    "pairs ARRAY<LONG>, holders ARRAY<INT>, doc_ids ARRAY<LONG>, n_a ARRAY<LONG>, n_b ARRAY<LONG>, "
    "n_groups ARRAY<LONG>, n_links ARRAY<LONG>, groups_sha256 ARRAY<STRING>, n_pairs ARRAY<INT>, links BINARY"
)


class _Block:
    """Documents that share one list of pairs: per document its counts, pairs and how often it links each."""

    def __init__(self):
        self.size = 0
        self.columns: dict[str, list] = {c: [] for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs")}
        self.pair: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: list, texts: list, found: Aligned) -> None:
        doc = found.a_doc[found.link_a]
        pair = found.a_ids[found.link_a] * PAIR_BASE + found.b_ids[found.link_b]
        keys, times = np.unique(doc * (PAIR_BASE * PAIR_BASE) + pair, return_counts=True)
        self.pair.append(keys % (PAIR_BASE * PAIR_BASE))
        self.times.append(times.astype(np.uint32))
        rows = {
            "doc_ids": ids,
            "n_a": found.per_doc(found.a_doc),
            "n_b": found.per_doc(found.b_doc),
            "n_groups": found.per_doc(found.a_doc[found.end_a]),
            "n_links": found.per_doc(doc),
            "groups_sha256": [hashlib.sha256(g).hexdigest() if g else "" for g in spelt_groups(found)],
            "n_pairs": found.per_doc(keys // (PAIR_BASE * PAIR_BASE)),
        }
        for name, values in rows.items():
            self.columns[name] += values if isinstance(values, list) else values.tolist()
        self.size += sum(len(t or "") + 64 for t in texts)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        pairs, place, holders = np.unique(np.concatenate([NONE, *self.pair]), return_inverse=True, return_counts=True)
        n_pairs = np.array(self.columns["n_pairs"], np.int64)
        first = np.zeros(len(place), bool)  # of a document; its places rise from there
        first[(np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]] = True
        step = np.where(first, place, place - np.concatenate([[0], place[:-1]]))
        links = _pack(step, np.concatenate([np.zeros(0, np.uint32), *self.times]))
        row = {**self.columns, "pairs": pairs, "holders": holders, "links": links}
        return pa.RecordBatch.from_pydict({name: [row[name]] for name in schema.names}, schema=schema)


def _blocks(a_path: str, b_path: str):
    """One row per block: its distinct pairs, and per document counts and places in that list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, block = Sides(a_path, b_path), _Block()
        for ids, texts in _in_portions(batches, ALIGN_BYTES):
            block.add(ids, texts, align(texts, sides))
            if block.size >= BLOCK_BYTES:
                yield block.row(schema)
                block = _Block()
        if block.size:
            yield block.row(schema)

    def kind(name: str) -> pa.DataType:
        if name == "BINARY":
            return pa.binary()
        return pa.list_({"LONG": pa.int64(), "INT": pa.int32(), "STRING": pa.string()}[name[6:-1]])

    schema = pa.schema([(name, kind(k)) for name, k in (c.split() for c in BLOCK.split(", "))])
    return run


PAIR_BASE = 1 << 20  # above every id of either side
RESULT = (
    "doc_id LONG, n_a LONG, n_b LONG, n_groups LONG, n_links LONG, n_best LONG, count_sum LONG, groups_sha256 STRING"
)


def _answered(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of the documents of a block, given the numbers of its pairs."""
    out = {c.split()[0]: [] for c in RESULT.split(", ")}
    if blocks.num_rows:
        pairs = answers["pair"].to_numpy() if answers.num_rows else np.zeros(0, np.int64)
        order = np.argsort(pairs)
        count, best = (answers[c].to_numpy()[order] if answers.num_rows else np.zeros(0, np.int64) for c in ("docs", "best"))
    for row in blocks.to_pylist():  # one row: block numbers are unique
        n_pairs = np.array(row["n_pairs"], np.int64)
        step, times = _unpack(row["links"], 2)
        owner = np.repeat(np.arange(len(n_pairs)), n_pairs)
        running = np.concatenate([[0], np.cumsum(step)])
        begin = np.cumsum(n_pairs) - n_pairs
        place = running[1:] - running[begin][owner]
        sums = lambda x: _sums(x * times, begin, n_pairs)
        for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256"):
            out[name] += row[name]
        out["doc_id"] += row["doc_ids"]
        out["n_best"] += sums(best[place]).tolist()
        out["count_sum"] += sums(count[place]).tolist()
    kinds = {"LONG": pa.int64(), "STRING": pa.string()}
    return pa.table(out, schema=pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RESULT.split(", ")]))


def _sums(values: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(values)])
    return running[begin + n] - running[begin]


def _held(blocks: DataFrame) -> DataFrame:
    """a_id, b_id, pair, docs, best of every pair of ids that some document links."""
    each = blocks.select(F.inline(F.arrays_zip("pairs", "holders")))
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("holders").alias("docs"))
    a_id = F.shiftright("pair", 20)
    most = F.max("docs").over(Window.partitionBy("a_id"))
    counted = counts.select("pair", "docs", a_id.alias("a_id"), F.col("pair").bitwiseAND(PAIR_BASE - 1).alias("b_id"))
    return counted.select("a_id", "b_id", "pair", "docs", (F.col("docs") == most).cast("long").alias("best"))


def link_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a_id, b_id, the number of documents that hold them linked, and whether no b_id has more for that a_id."""
    blocks = _docs(docs).mapInArrow(_blocks(a_path, b_path), BLOCK)
    return _held(blocks).select("a_id", "b_id", "docs", (F.col("best") == 1).alias("is_best"))


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """How the tokens of A and B lie on each other, per document and against the corpus.

    n_a and n_b tokens, n_groups between common ends, n_links overlaps; n_best
    of them have a pair of ids that no other b_id of that a_id exceeds in
    documents, count_sum adds the documents of the pair of every link;
    groups_sha256 is the digest of the groups' ids.

    - A null or empty text, and one that either side does not spell byte for
      byte, has no tokens: zeros, and '' for the digest. So does every row
      without them; an empty table gives no rows.
    - A null doc_id stays null. Rows that repeat, or share an id, are documents
      of their own, each counted. Ties of the highest count are all best.
    - A text of any length is whole; it makes up a block of its own.
    - Only doc_id and text are read, whatever further columns are named.
    """
    blocks = _docs(docs).mapInArrow(_blocks(a_path, b_path), BLOCK)
    blocks = staged(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "aligned")
    counts = staged(_held(blocks).select("pair", "docs", "best"), "pair-counts")
    asked = blocks.select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").select(F.col("of_block").alias("to_block"), "pair", "docs", "best")
    rows = blocks.drop("pairs", "holders")
    return rows.groupBy("block").cogroup(answers.groupBy("to_block")).applyInArrow(_answered, RESULT)
