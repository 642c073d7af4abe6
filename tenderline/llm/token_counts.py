"""Token counts of byte-level BPE: lowest-rank pairs from a heap, merged in a linked list."""

from __future__ import annotations

import json
import sys
import types
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tenderline.llm.text import byte_ranges, texts_of

CACHED_PIECES = 1 << 19
CACHED_CHARS = 64
#: The pre-tokenizer of byte-level BPE files: contractions, words, numbers, signs, white space.
WHITE = r"\t-\r \u0085   -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


def byte_signs() -> list[str]:
    """The sign that stands for each byte in such files: itself where printable, else the next free code point from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in printable else spare))
        spare += b not in printable
    return out


def load(path: str) -> dict:
    """Ranks of symbol pairs out of a tokenizer file, symbols as small numbers of our own, and the special strings."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"] or model.get("ignore_merges"):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    number, symbols = {}, lambda s: number.setdefault(s, len(number))
    base = [symbols(s) for s in byte_signs()]
    ranks, made = {}, []
    for merge in model["merges"]:
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        ranks.setdefault(symbols(a) << 32 | symbols(b), len(made))
        made.append(symbols(a + b))
    special = [t["content"] for t in spec["added_tokens"] if not (t["lstrip"] or t["rstrip"] or t["single_word"])]
    return {"base": base, "ranks": ranks, "made": made, "special": sorted(special, key=len, reverse=True)}


def pieces_left(data: bytes, base: list[int], ranks: dict[int, int], made: list[int]) -> int:
    """Symbols that are left of the bytes when no adjacent pair has a rank: initial symbols minus merges."""
    n = left = len(data)
    if n < 2:
        return n
    symbol = [base[b] for b in data]
    rank = ranks.get
    heap = [r << 32 | i for i in range(n - 1) if (r := rank(symbol[i] << 32 | symbol[i + 1])) is not None]
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        entry = heappop(heap)
        r, i = entry >> 32, entry & 0xFFFFFFFF
        j = after[i]
        if symbol[i] < 0 or j >= n or rank(symbol[i] << 32 | symbol[j]) != r:
            continue
        new = symbol[i] = made[r]
        symbol[j] = -1
        left -= 1
        j = after[i] = after[j]
        if j < n:
            before[j] = i
            if (r := rank(new << 32 | symbol[j])) is not None:
                heappush(heap, r << 32 | i)
        j = before[i]
        if j >= 0 and (r := rank(symbol[j] << 32 | new)) is not None:
            heappush(heap, r << 32 | j)
    return left


class Counts(dict):
    """Symbols left of a piece; short pieces are remembered, up to a bound."""

    def __init__(self, model: dict):
        self.model = [model[k] for k in ("base", "ranks", "made")]

    def __missing__(self, piece: str) -> int:
        n = pieces_left(piece.encode(), *self.model)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = n
        return n


def counter(model: dict):
    known = Counts(model)
    cut = regex.compile(PIECES)
    special = regex.compile("|".join(map(regex.escape, model["special"]))) if model["special"] else None

    def plain(text: str) -> int:
        return sum(map(known.__getitem__, cut.findall(text)))

    def count(text: str) -> int:
        if special is None or not (found := len(special.findall(text))):
            return plain(text)
        return found + sum(map(plain, special.split(text)))

    return count


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `tokenizer` is the path of a byte-level BPE file, read by the driver; its ranks (as many as the file has, which is
    the bound) go to the executors once. Counts are those of the file's own library without added special
    tokens; special strings inside a text are one token each. Whole texts; null and empty ones have no token. Rows
    are independent of each other, so null and repeated ids are rows like others. Other columns are not read."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(load(tokenizer))
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Kept from task to task of a worker process, under a module of its own.
        kept = sys.modules.setdefault("tenderline_token_counts", types.ModuleType("tenderline_token_counts")).__dict__
        if kept.get("key") != key:
            kept.update(key=key, count=counter(shared.value))
        count = kept["count"]
        for batch in batches:
            _, offsets = byte_ranges(batch.column(1))
            tokens = [count(t) if t else 0 for part in texts_of(batch.column(1), 256) for t in part]
            sizes = (offsets[1:] - offsets[:-1]).tolist()
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
