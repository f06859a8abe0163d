"""BPE encoding in which passages that documents share are encoded once.

A rolling hash over bytes cuts a text where its content says so, hence equal
passages give equal chunks wherever they stand. Documents are dealt into blocks
by their content. Every block names its distinct chunks by a digest; a chunk
that several blocks hold is encoded by one of them, and the others are sent its
ids. All other chunks are encoded in their block, each once.

Chunks end anywhere, so the tokens around a join are not those of the whole
text. A chunk's first and last words are encoded again by themselves until
these ids equal the ones the chunk has there: what lies between is then settled
by the chunk alone. The words at a join, end of one chunk and begin of the next,
are encoded as one. This holds for tokenizers that never join or look across
white space, which ``check_tokenizer`` asks of a tokenizer file; the same lets
the tokenizer see each distinct word of a block only once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.known_words import KnownWords
from paymart.llm.shared import staged
from paymart.llm.words import mix

BLOCK_BYTES = 8 << 20  # text of a block; raise it with the input, as memory allows
PORTION = 1 << 21  # characters split, or ids decoded, at once: what this takes does not grow with the block
MOST_WORDS = 1_000_000  # that a Python worker remembers; then it begins anew, with the same results
SHORTEST, LONGEST = 256, 8192  # bytes of a chunk
CUT_BITS = 10  # one place in 1024 is a cut

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_SPACE = " \t\n\v\f\r"


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, a hash of it and the 31 before; a byte's share has left the word after 32."""
    out = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        longer = out.copy()
        longer[step:] += out[:-step] << np.uint32(step)
        out = longer
    return out


def chunk_ends(text: bytes) -> list[int]:
    """Where the chunks of a UTF-8 text end; never inside a character.

    Cuts follow the content, but no chunk is shorter than ``SHORTEST`` (the last
    one may be) or longer than ``LONGEST`` by more than a character.
    """
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    begins = (data & 0xC0) != 0x80  # of characters
    hit = rolling_hash(data) >> np.uint32(32 - CUT_BITS) == 0
    ends, last = [], 0
    for end in [*(np.flatnonzero(hit[:-1] & begins[1:]) + 1).tolist(), n]:
        while end - last > LONGEST:
            last += LONGEST
            while not begins[last]:
                last -= 1
            ends.append(last)
        if end - last >= SHORTEST or end == n and end > last:
            ends.append(end)
            last = end
    return ends


def chunks_of(text: str) -> list[bytes]:
    raw = text.encode()
    ends = chunk_ends(raw) if raw else []
    return [raw[i:j] for i, j in zip([0, *ends], ends)]


KEY_BYTES = 16


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=KEY_BYTES).digest()


def portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Borders of runs of items that come to about ``PORTION``; one item may be larger."""
    cuts = np.flatnonzero(np.diff(np.cumsum([0, *sizes]) // PORTION)[1:]) + 1 if sizes else []
    borders = [0, *cuts, len(sizes)]
    return zip(borders[:-1], borders[1:])


class UnsuitableTokenizer(ValueError):
    """A tokenizer that may look across white space."""


def check_tokenizer(path: str) -> None:
    """Raises unless words apart by white space are encoded apart.

    That is so where white space is dropped before the merges: a pre-tokenizer
    that keeps only matches, of a pattern none of whose matches hold white
    space, and normalizers that work on single characters and their marks.
    """
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    known = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
    normalizers = (parts.get("normalizer") or {}).get("normalizers") or [parts["normalizer"]] if parts.get("normalizer") else []
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [parts.get("pre_tokenizer") or {}]
    apart = all(
        n["type"] in known or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in normalizers
    )
    first = steps[0]
    drops = first.get("type") == "WhitespaceSplit" or (
        first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"] and _spaceless(first["pattern"].get("Regex", " "))
    )
    added = all(not t["lstrip"] and not t["rstrip"] and not any(c.isspace() for c in t["content"]) for t in parts["added_tokens"])
    prefix = any(s.get("add_prefix_space") for s in steps)
    if not (apart and drops and added and not prefix) or parts["model"].get("dropout"):
        raise UnsuitableTokenizer(path)


def _spaceless(pattern: str) -> bool:
    """No alternative can match white space: letters, numbers, literals, or a class without it."""
    import regex

    sample = [" ", "\t", "\n", "\r", "\v", "\f", " a", "a ", "1 ", "' s", "'s ", ". ", " .", "a b"]
    found = regex.compile(pattern)
    return not any(c in _SPACE for s in sample for m in found.finditer(s) for c in m.group())


class Encoder:
    """The tokenizer, without truncation and padding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

        self.tokens = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        self.forget()

    def forget(self) -> None:
        self.known = KnownWords(self._encode_words)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text by itself."""
        out: list[np.ndarray] = []
        for i, j in portions([len(t) for t in texts]):
            out += self.known.ids_of(pc.ascii_split_whitespace(pa.array(texts[i:j], pa.large_string())))[0]
        return out

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of the ids, special tokens included; a tokenizer without a decoder puts blanks between tokens."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
        return [" ".join([self.tokens[i] for i in x.tolist()]) for x in ids]


@dataclass
class Chunk:
    """An encoded chunk and what of it no neighbour can change.

    ``head`` and ``tail`` are the characters before its first and from its last
    settled white space, n_head and n_tail their ids; ``head`` is None where
    nothing is settled.
    """

    text: str
    ids: np.ndarray
    head: str | None = None
    n_head: int = 0
    tail: str = ""
    n_tail: int = 0


_SPACES = re.compile(f"[{_SPACE}]")
_LAST_SPACE = re.compile(f".*([{_SPACE}])", re.DOTALL)


def _space_after(text: str, at: int) -> int:
    """The first white space from a place on; -1 where there is none."""
    found = _SPACES.search(text, at)
    return found.start() if found else -1


def _space_before(text: str, end: int) -> int:
    """The last white space before a place; -1 where there is none."""
    found = _LAST_SPACE.match(text, 0, max(0, end))
    return found.start(1) if found else -1


def settle(chunks: list[Chunk], encoder: Encoder) -> None:
    """Finds head and tail of each chunk by encoding them again, further in until they agree."""
    heads = [_space_after(c.text, 0) for c in chunks]
    tails = [_space_before(c.text, len(c.text)) for c in chunks]
    open_ = [i for i in range(len(chunks)) if heads[i] >= 0]
    while open_:
        pieces = [chunks[i].text[: heads[i]] for i in open_]
        pieces += [chunks[i].text[tails[i] :] for i in open_]
        ids = encoder.encode(pieces)
        again = []
        for at, i in enumerate(open_):
            head, tail, whole = ids[at], ids[at + len(open_)], chunks[i].ids
            head_agrees = head.tobytes() == whole[: len(head)].tobytes()
            tail_agrees = len(tail) <= len(whole) and tail.tobytes() == whole[len(whole) - len(tail) :].tobytes()
            if head_agrees and tail_agrees:
                chunks[i].head, chunks[i].n_head = pieces[at], len(head)
                chunks[i].tail, chunks[i].n_tail = pieces[at + len(open_)], len(tail)
                continue
            if not head_agrees:
                heads[i] = _space_after(chunks[i].text, heads[i] + 1)
            if not tail_agrees:
                tails[i] = _space_before(chunks[i].text, tails[i])
            if 0 <= heads[i] <= tails[i]:  # the two have not met
                again.append(i)
        open_ = again


def join_chunks(docs: list[list[Chunk]], encoder: Encoder) -> list[np.ndarray]:
    """Ids of whole texts from their chunks, the words at joins encoded anew."""
    plans, windows = [], {}
    for chunks in docs:
        parts, pending = [], ""
        for at, c in enumerate(chunks):
            first, last = at == 0, at == len(chunks) - 1
            if first and last:
                parts.append(c.ids)
            elif c.head is None:
                pending += c.text
            else:
                if not first and (pending or c.head):
                    parts.append(pending + c.head)
                parts.append(c.ids[0 if first else c.n_head : len(c.ids) - (0 if last else c.n_tail)])
                pending = "" if last else c.tail
        if pending:
            parts.append(pending)
        windows.update(dict.fromkeys(p for p in parts if isinstance(p, str)))
        plans.append(parts)
    for text, ids in zip(windows, encoder.encode(list(windows))):
        windows[text] = ids
    return [
        np.concatenate([windows[p] if isinstance(p, str) else p for p in parts]) if parts else np.zeros(0, np.int32)
        for parts in plans
    ]


def _docs(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, doc_id, text) of all rows, dealt by content."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text") + 64).alias("size")).first()["size"] or 0
    return docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-size // block_bytes)))).alias("block"), "doc_id", "text")


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[int, int | None, bytes, list[int], bytes]]:
    """Block, id, text, ends of its chunks and their digests, one after the other, of each row."""
    texts = batch["text"].cast(pa.binary()).to_pylist()
    for block, i, raw in zip(batch["block"].to_pylist(), batch["doc_id"].to_pylist(), texts):
        ends = chunk_ends(raw) if raw else []
        yield block, i, raw, ends, b"".join([digest(raw[a:b]) for a, b in zip([0, *ends], ends)])


def _keys(joined: bytes) -> list[bytes]:
    return [joined[i : i + KEY_BYTES] for i in range(0, len(joined), KEY_BYTES)]


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, block) of each chunk, once per batch."""
    for batch in batches:
        pairs = {(key, block) for block, _, _, _, joined in _cut(batch) for key in _keys(joined)}
        keys, blocks = zip(*pairs) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(blocks, pa.int64())], ["key", "block"])


PACK = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.binary()), ("ends", pa.list_(pa.int64())), ("keys", pa.binary()), ("times", pa.int64())]
)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch with their chunks, equal rows counted, as one compressed table per block."""
    for batch in batches:
        by_block: dict[int, dict] = {}
        for block, i, raw, ends, joined in _cut(batch):
            row = by_block.setdefault(block, {}).setdefault((i, raw), [ends, joined, 0])
            row[2] += 1
        blobs = []
        for rows in by_block.values():
            columns = [[i for i, _ in rows], [raw for _, raw in rows], *zip(*rows.values())]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, PACK) as writer:
                writer.write_table(pa.table(dict(zip(PACK.names, columns)), schema=PACK))
            blobs.append(zstandard.ZstdCompressor(level=3).compress(sink.getvalue()))
        yield pa.RecordBatch.from_arrays([pa.array(list(by_block), pa.int64()), pa.array(blobs, pa.binary())], ["block", "blob"])


def _unpacked(packs: pa.Table) -> tuple[list, list[list[tuple[bytes, bytes]]], list]:
    """Ids, chunks as (key, text), and counts of the rows of a block."""
    tables = [pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob.as_py())).read_all() for blob in packs["blob"]]
    rows = pa.concat_tables(tables)
    columns = [rows[c].to_pylist() for c in ("text", "ends", "keys")]
    chunks = [[(key, raw[a:b]) for key, a, b in zip(_keys(joined), [0, *ends], ends)] for raw, ends, joined in zip(*columns)]
    return rows["doc_id"].to_pylist(), chunks, rows["times"].to_pylist()


def _small(ids: np.ndarray) -> bytes:
    """Ids in two bytes each where that holds them, compressed."""
    width = np.uint16 if ids.max(initial=0) < 1 << 16 else np.uint32
    return bytes([width().itemsize]) + zstandard.ZstdCompressor(level=3).compress(ids.astype(width).tobytes())


def _large(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob[1:])
    return np.frombuffer(raw, np.uint16 if blob[0] == 2 else np.uint32).astype(np.int32)


_WORKER: dict[tuple, Encoder] = {}


def _worker_encoder(path: str) -> Encoder:
    """The one encoder of a Python worker, kept from task to task; it begins anew when it knows very many words."""
    file = os.stat(path)
    key = (path, file.st_size, file.st_mtime_ns)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(path)
    elif len(_WORKER[key].known.number) > MOST_WORDS:
        _WORKER[key].forget()
    return _WORKER[key]


def _encode_owned(path: str):
    """Ids of the chunks that a block encodes for others."""

    def run(packs: pa.Table, owned: pa.Table) -> pa.Table:
        wanted, found = set(owned["key"].to_pylist()) if owned.num_rows else set(), {}
        if wanted and packs.num_rows:
            found = {key: c for chunks in _unpacked(packs)[1] for key, c in chunks if key in wanted}
        blobs = [_small(x) for x in _worker_encoder(path).encode([c.decode() for c in found.values()])] if found else []
        return pa.table({"key": pa.array(list(found), pa.binary()), "ids": pa.array(blobs, pa.binary())})

    return run


def _encode_blocks(path: str):
    """Ids and decoded text of the documents of a block, given the shared chunks' ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def table_of(rows: list[int], doc_ids: list, found: list[np.ndarray], encoder: Encoder) -> pa.Table:
        ends = np.cumsum([0, *(len(found[i]) for i in rows)])
        flat = np.concatenate([np.zeros(0, np.int32), *(found[i] for i in rows)])
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
        once = list(dict.fromkeys(rows))
        decoded = dict(zip(once, encoder.decode([found[i] for i in once])))
        columns = [pa.array([doc_ids[i] for i in rows], pa.int64()), lists, pa.array([decoded[i] for i in rows], pa.string())]
        return pa.table(columns, schema=schema)

    def run(packs: pa.Table, codes: pa.Table) -> pa.Table:
        if not packs.num_rows:
            return schema.empty_table()
        encoder = _worker_encoder(path)
        sent = dict(zip(codes["key"].to_pylist(), codes["ids"].to_pylist())) if codes.num_rows else {}
        doc_ids, cut, times = _unpacked(packs)
        raw = {key: c for chunks in cut for key, c in chunks}
        cut = [[key for key, _ in chunks] for chunks in cut]
        new = {key: raw.pop(key).decode() for key in list(raw)}  # bytes go as texts come
        here = [key for key in new if key not in sent]
        ids = dict(zip(here, encoder.encode([new[key] for key in here])))
        known = {key: Chunk(text, ids[key] if key in ids else _large(sent[key])) for key, text in new.items()}
        settle([known[key] for key in dict.fromkeys(key for keys in cut if len(keys) > 1 for key in keys)], encoder)
        found = join_chunks([[known[key] for key in keys] for keys in cut], encoder)
        del new, known, ids, sent
        rows = [i for i, n in enumerate(times) for _ in range(n)]
        return pa.concat_tables([table_of(rows[i:j], doc_ids, found, encoder) for i, j in portions([len(found[i]) for i in rows])])

    return run


def encoded(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids and the text they decode to, of every document.

    ``ids`` are exactly those that the tokenizer of the file at ``path`` gives for
    the whole text without added special tokens, truncation and padding (strings
    of special tokens inside a text are those tokens); ``decoded`` is its decode of them, special
    tokens included. The file has to be at that path on every executor.

    - A null text counts as empty: no ids, decoded ''. A null doc_id stays null.
    - Rows that repeat or share an id are encoded each by its own text; none is lost.
      Equal rows of a batch travel as one with a count.
    - Texts of any length are whole. One without white space is joined anew as a whole.
    - An empty table gives no rows. Only doc_id and text are read, whatever
      further columns are named. There is nothing to tie.
    """
    check_tokenizer(path)
    placed = _docs(docs, block_bytes)
    packs = placed.mapInArrow(_packed, "block LONG, blob BINARY")
    asked = staged(placed.mapInArrow(_asked, "key BINARY, block LONG").distinct(), "chunk-keys")
    keys = asked.groupBy("key").agg(F.min("block").alias("owner"), F.count("block").alias("holders"))
    shared = keys.where("holders > 1").select("key", "owner")
    owned = shared.select(F.col("key"), F.col("owner").alias("of_block"))
    codes = packs.groupBy("block").cogroup(owned.groupBy("of_block")).applyInArrow(_encode_owned(path), "key BINARY, ids BINARY")
    asks = asked.select(F.col("key").alias("asked_key"), F.col("block").alias("to_block"))
    sent = codes.join(asks, F.col("key") == F.col("asked_key")).select("to_block", "key", "ids")
    return packs.groupBy("block").cogroup(sent.groupBy("to_block")).applyInArrow(
        _encode_blocks(path), "doc_id LONG, ids ARRAY<INT>, decoded STRING"
    )


def ids_sha256(ids: Column) -> Column:
    """Digest of the decimal ids joined by blanks."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256)


def with_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text."""
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_sha256(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
