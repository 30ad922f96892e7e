"""Byte-level BPE encoding and decoding by a table of ranks.

Matches of the splitting pattern (``cuts.CutEncoder``) not met lately are
merged in numpy matrices of one byte-length class each, padded on the right.  In a round every unfinished row looks up all its neighbouring pairs in
a hash table, merges the leftmost pair of least rank and is compacted by one
column.  Byte strings over ``LONG`` bytes are merged with a heap, since rounds
over them would cost the square of their length.

Each row depends on itself only; what a worker remembers is bounded and merely
saves repeated work.

Defined results: null text encodes like empty text, to no ids, and decodes to
no bytes; repeated rows are encoded one by one; other columns aren't read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .cuts import CutEncoder

LONG = 192
#: Rows handled at a time; bounds a worker's memory.
ROWS = 1024
NONE = np.int32(1 << 30)


class PairTable:
    """Open-addressed hash table from a pair of ids to the id of the merger."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.bits = max(4, (2 * len(pairs)).bit_length() + 1)
        self.pairs = pairs
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        left, ranked = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(left)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = left[free]  # of several for one slot the last stays
            won = self.keys[slot] == left
            self.values[slot[won]] = ranked[won]
            left, ranked, slot = left[~won], ranked[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merger of each pair, NONE where there is none or an id is -1."""
        shape = a.shape
        keys = (a.astype(np.int64) << 32 | b.astype(np.int64)).ravel()
        out = np.full(len(keys), NONE, np.int32)
        todo = np.nonzero((a.ravel() >= 0) & (b.ravel() >= 0))[0]
        slot = self._slot(keys[todo])
        while len(todo):
            found, there = self.keys[slot], keys[todo]
            hit = found == there
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found != -1)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pairs = PairTable(ranks)
        self.byte = np.array([ranks.get(bytes([k]), -1) for k in range(256)], np.int32)
        self.encode = CutEncoder(pattern, lambda matches: [x.tobytes() for x in self.merge([m.encode() for m in matches])])

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each distinct byte string."""
        out: list = [None] * len(pieces)
        classes: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[k] = np.array([whole], np.int32)
            elif len(p) > LONG:
                out[k] = self._merge_long(p)
            else:
                classes.setdefault((len(p) - 1).bit_length(), []).append(k)
        for rows in classes.values():
            for at in range(0, len(rows), 8192):
                self._merge_matrix(pieces, rows[at : at + 8192], out)
        return out

    def _merge_matrix(self, pieces, rows, out) -> None:
        rows = np.array(rows)
        lengths = np.array([len(pieces[k]) for k in rows])
        ids = np.full((len(rows), lengths.max()), -1, np.int32)
        ids[np.arange(ids.shape[1]) < lengths[:, None]] = self.byte[np.frombuffer(b"".join(pieces[k] for k in rows), np.uint8)]
        while len(rows):
            merged = self.pairs(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.full((len(rows), 1), NONE)
            at = merged.argmin(1)  # the leftmost of equal ranks
            each = np.arange(len(rows))
            rank = merged[each, at]
            for k in np.nonzero(rank == NONE)[0]:
                out[rows[k]] = ids[k][ids[k] >= 0]
            on = rank != NONE
            rows, ids, at, rank = rows[on], ids[on], at[on], rank[on]
            each = np.arange(len(rows))
            ids[each, at] = rank
            stay = np.ones(ids.shape, bool)
            stay[each, at + 1] = False
            ids = ids[stay].reshape(len(rows), ids.shape[1] - 1)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before, get = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), self.pairs.pairs.get
        heap = [(r, k) for k in range(len(ids) - 1) if (r := get(ids[k] << 32 | ids[k + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, k = heapq.heappop(heap)
            n = after[k]
            if ids[k] < 0 or n >= len(ids) or get(ids[k] << 32 | ids[n]) != rank:
                continue
            ids[k], ids[n], after[k] = rank, -1, after[n]
            if after[k] < len(ids):
                before[after[k]] = k
            for left in (before[k], k):
                if left >= 0 and after[left] < len(ids) and (r := get(ids[left] << 32 | ids[after[left]])) is not None:
                    heapq.heappush(heap, (r, left))
        return np.array([i for i in ids if i >= 0], np.int32)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(urlsplit(path).path if path.startswith("file:") else path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@cache
def encoder(path: str, pattern: str) -> Encoder:
    """One a worker, of a rank file that every node has (it is installed)."""
    return Encoder(read_ranks(path), pattern)


@cache
def tokens(path: str) -> dict[int, bytes]:
    """The bytes of each id; one a worker."""
    return {rank: token for token, rank in read_ranks(path).items()}


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array<int>) of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                ids, ends = e.encode(b.column(1))
                lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["doc_id", "ids"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, path: str) -> DataFrame:
    """``encode``'s rows with decoded, the bytes of the ids; null ids: null.  An
    id that the table lacks is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens(path).__getitem__
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                b = whole.slice(at, ROWS)
                texts = [b"".join(map(token, x.values.to_numpy().tolist())) if x.is_valid else None for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    rows = df.select("doc_id", "ids")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")


def op2_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    both = decode(encode(table(spark, sf_dir, "documents"), path, P.PATTERN), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
