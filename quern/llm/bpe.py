"""Byte-level BPE encoding and decoding on length-bucketed padded matrices.

Texts are cut before each blank that a non-blank follows (the pattern always
has a match boundary there), the pattern cuts every distinct piece of these
into pre-tokens, and every distinct pre-token is encoded once.  Pre-tokens of like length form the rows of a padded id matrix;
each round every row merges its leftmost pair of minimum rank: ranks come from
an open-addressing hash table of pairs, the merged cell is closed up, only the
two neighbouring pairs are looked up again, and finished rows leave the
matrix.  A pre-token that is itself in the vocabulary is one id, as in the
tiktoken library.

A row costs (its length)^2, so a pre-token above ``LONG`` bytes (a line of
one repeated sign, say) takes the same rule with a heap instead.

Edge cases: null and empty text give no ids and decode to empty bytes; ids
outside the vocabulary raise; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import re
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import annotate, text_batches

LONG = 256
#: A vocabulary file is sent to every task; larger ones are refused.
MOST_VOCABULARY = 64 << 20
#: Distinct pre-tokens a worker remembers between batches; beyond it, it starts anew.
MEMORY = 250_000
#: A blank with white space or nothing behind it: no place to cut.  Python's white space includes the pattern's.
_NO_CUT = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r" (?=\S)")
_NONE = np.int32(2**31 - 1)


def ranks_of(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class PairTable:
    """(left id, right id) -> merged id, open addressing with linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(np.ceil(np.log2(len(pairs) * 3 + 1))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        slot, open_ = self.slots(keys), np.arange(len(keys))
        while len(open_):
            free = self.keys[slot[open_]] < 0
            self.keys[slot[open_[free]]] = keys[open_[free]]  # of several for one slot, one stays
            here = self.keys[slot[open_]] == keys[open_]
            self.values[slot[open_[here]]] = values[open_[here]]
            open_ = open_[~here]
            slot[open_] = slot[open_] + 1 & (1 << self.bits) - 1

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The same as a dictionary, for one pre-token at a time."""
        used = self.keys >= 0
        return dict(zip(self.keys[used].tolist(), self.values[used].tolist()))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids (which are ranks), or ``_NONE``; a negative id has no pair."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slot = self.slots(keys)
        seen = self.keys[slot]
        out = self.values[slot]
        wrong = np.flatnonzero((seen != keys))
        out[wrong] = _NONE
        wrong = wrong[(seen[wrong] >= 0) & (keys[wrong] >= 0)]
        while len(wrong):
            slot[wrong] = slot[wrong] + 1 & (1 << self.bits) - 1
            seen = self.keys[slot[wrong]]
            hit = seen == keys[wrong]
            out[wrong[hit]] = self.values[slot[wrong[hit]]]
            wrong = wrong[~hit & (seen >= 0)]
        return out


class Codec:
    def __init__(self, data: bytes, pattern: str):
        import regex

        self.ranks = ranks_of(data)
        self.table = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.findall = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.known: dict[str | tuple[str], int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def merge_matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of byte ids padded with -1 -> rows of merged ids and their lengths."""
        out = ids.copy()
        rows = np.arange(len(ids))
        ranks = self.table.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while True:
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            best = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), _NONE)
            done = best == _NONE
            if done.any():
                width = ids.shape[1]
                out[rows[done], :width] = ids[done]
                out[rows[done], width:] = -1
                ids, ranks, at, best, rows = (x[~done] for x in (ids, ranks, at, best, rows))
            if not len(ids):
                return out, (out >= 0).sum(axis=1)
            row, last = np.arange(len(ids)), ids.shape[1] - 1
            ids[row, at] = best
            column = np.arange(last)
            ids = np.where(column <= at[:, None], ids[:, :-1], ids[:, 1:])  # close up the merged cell
            ranks = np.where(column[:-1] <= at[:, None], ranks[:, :-1], ranks[:, 1:])
            left, right = at > 0, at < last - 1
            ranks[row[left], at[left] - 1] = self.table.lookup(ids[row[left], at[left] - 1], best[left])
            ranks[row[right], at[right]] = self.table.lookup(best[right], ids[row[right], at[right] + 1])

    def merge_long(self, piece: bytes) -> list[int]:
        """The same rule for one long pre-token: a heap of (rank, place) over linked cells."""
        pairs = self.table.pairs
        ids = [int(self.byte_ids[b]) for b in piece]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i) for i in range(len(ids) - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else len(ids)
            if j >= len(ids) or pairs.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (r := pairs.get(rank << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (b := before[i]) >= 0 and (r := pairs.get(ids[b] << 32 | rank)) is not None:
                heapq.heappush(heap, (r, b))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each pre-token's number of ids."""
        rows: list = [None] * len(pieces)
        counts = np.ones(len(pieces), np.int64)
        single = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero((single < 0) & (sizes > LONG)):
            rows[i] = np.array(self.merge_long(pieces[i]), np.int32)
            counts[i] = len(rows[i])
        open_ = np.flatnonzero((single < 0) & (sizes <= LONG))
        open_ = open_[np.argsort(sizes[open_], kind="stable")]
        blocks, start = [], 0
        while start < len(open_):  # a bucket: rows of like length, padded to its longest
            shortest = sizes[open_[start]]
            end = min(int(np.searchsorted(sizes[open_], shortest + max(1, shortest // 8), "right")), start + max(1, 2**20 // int(shortest)))
            blocks.append(open_[start:end])
            start = end
        parts = []
        for block in blocks:
            width = int(sizes[block].max())
            flat = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in block), np.uint8).reshape(len(block), width)
            ids = np.where(np.arange(width) < sizes[block, None], self.byte_ids[flat], np.int32(-1))
            ids, counts[block] = self.merge_matrix(ids)
            parts.append((block, ids[ids >= 0]))
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        starts = ends - counts
        whole = single >= 0
        out[starts[whole]] = single[whole]
        for block, ids in parts:
            out[gather(starts[block], counts[block])] = ids
        for i in np.flatnonzero((single < 0) & (sizes > LONG)):
            out[starts[i]:ends[i]] = rows[i]
        return out, counts

    def learn(self, new: list[str | tuple[str]]) -> None:
        """Remembers the ids of parts of texts; a part behind a blank stands without it, a text's first as a tuple."""
        found = [self.findall(p[0] if type(p) is tuple else " " + p) for p in new]
        index = dict.fromkeys(chain.from_iterable(found))
        index.update(zip(index, range(len(index))))
        ids, counts = self.encode_pieces(list(map(str.encode, index)))
        starts = np.cumsum(counts) - counts
        at = np.fromiter(map(index.__getitem__, chain.from_iterable(found)), np.int64, sum(map(len, found)))
        ends = np.concatenate([[0], np.cumsum(counts[at])])[np.cumsum([0, *map(len, found)])]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.ids = np.concatenate([self.ids, ids[gather(starts[at], counts[at])]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends[1:]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's number of ids."""
        if len(self.known) > MEMORY:
            self.forget()
        parts = []
        for t in texts:
            cut = _CUT.split(t) if _NO_CUT.search(t) else t.split(" ")
            cut[0] = (cut[0],)
            parts.append(cut)
        self.learn(list(set().union(*parts).difference(self.known)))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, sum(map(len, parts)))
        sizes = self.starts[at + 1] - self.starts[at]
        per_text = np.add.reduceat(sizes, np.cumsum([0, *map(len, parts)])[:-1]) if texts else sizes
        return self.ids[gather(self.starts[at], sizes)], per_text


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + count) one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


@cache
def codec(data: bytes, pattern: str) -> Codec:
    return Codec(data, pattern)


@cache
def tokens(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """The ids in rising order and, at the same places, their bytes."""
    ranks = sorted((rank, token) for token, rank in ranks_of(data).items())
    return np.array([r for r, _ in ranks], np.int64), pa.array([t for _, t in ranks], pa.large_binary())


class _Encode:
    def __init__(self, data, pattern: str):
        self.data, self.pattern = data, pattern

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        c = codec(self.data.value, self.pattern)
        ids, counts = [], []
        texts = column.cast(pa.binary()).to_pylist()
        for _, part in text_batches(texts, 2 << 20):
            i, n = c.encode([(t or b"").decode("utf-8", "replace") for t in part])
            ids.append(i)
            counts.append(n)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))]

    def forget(self) -> None:
        """At a task's end."""
        codec(self.data.value, self.pattern).forget()


class _Decode:
    def __init__(self, data):
        self.data = data

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        known, vocabulary = tokens(self.data.value)
        ids = column.flatten()  # without those of null lists
        if ids.null_count:
            raise ValueError("id None is not in the vocabulary")
        ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
        at = ids if len(known) and known[-1] == len(known) - 1 else np.searchsorted(known, ids)
        wrong = (at < 0) | (at >= len(known))
        wrong[~wrong] = known[at[~wrong]] != ids[~wrong]
        if wrong.any():
            raise ValueError(f"id {ids[wrong][0]} is not in the vocabulary")
        # The tokens taken one after another are the texts' bytes one after another.
        taken = vocabulary.take(pa.array(at))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        offsets = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        out = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(offsets.tobytes()), taken.buffers()[2] or pa.py_buffer(b"")])
        return [out.cast(pa.binary())]


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:  # a file of the driver's machine, sent to the tasks
        data = f.read(MOST_VOCABULARY + 1)
    if len(data) > MOST_VOCABULARY:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array of int), the text's token ids under the ranks file at ``path``."""
    return annotate(df, text, _Encode(_vocabulary(df, path), pattern), [T.StructField("ids", T.ArrayType(T.IntegerType()))], keep)


def decode(df: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded`` (binary), the bytes that ``ids`` stand for."""
    return annotate(df, ids, _Decode(_vocabulary(df, path)), [T.StructField("decoded", T.BinaryType())], keep)


def digests(df: DataFrame, *more: str) -> DataFrame:
    """The query's columns from ``ids`` and ``decoded``, and ``more`` columns."""
    return df.select("doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
                     F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                     F.sha2("decoded", 256).alias("decoded_sha256"))
