"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` turns each run of documents of a task into one shard: the
terms in order and, for each, the places where it stands (positions within the
shard).  A shard row can be written as a table and searched again later.

``search`` looks up phrases of test words in every shard: the terms of a
phrase are ordered by the length of their postings in the shard, the offset-adjusted list
of the rarest gives the candidates, and each further list is intersected with
what is left.  With ``slop`` 0 that finds exact phrases; a larger ``slop``
lets each word stand that many places from where the phrase has it
(proximity).  Postings never move between machines; the phrases do, in blocks
of bounded size.

Edge cases: null and empty texts have no words and no matches; test items
without words or without an id are left out; an empty benchmark or table gives rows
without matches, or none; repeated rows give repeated results; matches of
one item that overlap are one span.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_texts, prepare, text_batches, trimmed, words, written

WINDOW = 13
#: Bytes of document text in one shard, and of test text in one block of phrases.
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 4 << 20
#: Places between two documents of a shard: a phrase and its slop stay below.
GAP = 64
#: Candidates held at once.
CANDIDATES = 1 << 21

_SHARD = pa.schema([("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int32())), ("terms", pa.binary()),
                    ("postings", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32()))])
_SHARD_DDL = "doc_ids array<long>, n_words array<int>, terms binary, postings array<int>, lengths array<int>"


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for start, texts in text_batches(as_texts(batch.column(1)), SHARD_BYTES):
            docs = [words(t or b"") for t in texts]
            counts = np.fromiter(map(len, docs), np.int32, len(docs))
            index = dict.fromkeys(chain.from_iterable(docs))
            index.update(zip(index, range(len(index))))
            terms = np.fromiter(map(index.__getitem__, chain.from_iterable(docs)), np.int32, int(counts.sum()))
            row = {"doc_ids": [ids.slice(start, len(texts)).to_pylist()], "n_words": [counts], "terms": [b" ".join(index)],
                   "postings": [np.argsort(terms, kind="stable").astype(np.int32)],
                   "lengths": [np.bincount(terms, minlength=len(index)).astype(np.int32)]}
            yield pa.RecordBatch.from_pydict(row, schema=_SHARD)


def build_index(docs: DataFrame) -> DataFrame:
    """One row for each shard: document ids and word counts, terms, all postings and their lengths."""
    prepare(docs.sparkSession)
    return _plain(docs).mapInArrow(_build, _SHARD_DDL)


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def _build_and_search(batches: Iterable[pa.RecordBatch], block, slop: int) -> Iterator[pa.RecordBatch]:
    shards = (pa.RecordBatch.from_arrays([pa.array([0]), *b.columns], names=["shard", *b.schema.names]) for b in _build(batches))
    return trimmed(_search(shards, block, slop))


def search_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """:func:`search` over an index that is used only once: each task searches its shards as
    it builds them.  With several blocks of phrases, the index is stored and searched block by block."""
    blocks = phrase_blocks(benchmark, window)
    first, second = next(blocks), next(blocks, None)
    if second is not None:
        return search(build_index(docs), benchmark, window, slop)
    _fits(window, slop)
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(first)
    return _plain(docs).mapInArrow(partial(_build_and_search, block=sent, slop=slop), _FOUND_DDL).select("doc_id", "n_words", "matches")


def _fits(window: int, slop: int) -> None:
    if window + slop >= GAP:
        raise ValueError(f"a phrase and its slop take fewer than {GAP} places")


class Phrases:
    """A block of phrases: distinct words, a padded matrix of word numbers, and each phrase's item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        index: dict[bytes, int] = {}
        rows, self.items = [], []
        for item, found in items:
            numbers = [index.setdefault(w, len(index)) for w in found]
            for start in range(max(1, len(numbers) - window + 1)):
                rows.append(numbers[start:start + window])
                self.items.append(item)
        self.words = list(index)
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.matrix = np.full((len(rows), window), -1, np.int64)
        for row, numbers in zip(self.matrix, rows):
            row[:len(numbers)] = numbers


def phrase_blocks(benchmark: DataFrame, window: int) -> Iterator[Phrases]:
    """Windows of the items' words, ``BLOCK_BYTES`` of item text at a time."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").filter("item_id is not null and text is not null")
    for item, text in rows.toLocalIterator():
        found = words(text.encode("utf-8", "replace"))
        if not found:
            continue
        block.append((item, found))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield Phrases(block, window)
            block, size = [], 0
    yield Phrases(block, window)


def find(phrases: Phrases, index: dict[bytes, int], lengths: np.ndarray, places: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of every match; ``places``: postings of all terms one after another."""
    ends = np.cumsum(lengths)
    numbers = np.array([*map(index.get, phrases.words, [-1] * len(phrases.words)), -1], np.int64)  # the last for padding
    matrix = numbers[phrases.matrix]
    inside = np.arange(matrix.shape[1]) < phrases.sizes[:, None]
    live = np.flatnonzero(((matrix >= 0) | ~inside).all(axis=1))
    matrix, inside = matrix[live], inside[live]
    rarity = np.where(inside, lengths[matrix] if len(lengths) else 0, np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable")
    span = int(places.max(initial=0)) + 2 * GAP + 2  # postings as one sorted list of term * span + place
    keys = np.repeat(np.arange(len(lengths), dtype=np.int64) * span, lengths) + places + GAP
    found_phrase, found_start = [], []
    first = matrix[np.arange(len(live)), order[:, 0]] if len(live) else np.empty(0, np.int64)
    many = lengths[first] if len(live) else np.empty(0, np.int64)
    chunk = np.cumsum(many) // CANDIDATES
    for c in np.unique(chunk):
        rows = np.flatnonzero(chunk == c)
        row = np.repeat(rows, many[rows])
        at = np.arange(len(row)) + np.repeat((ends - lengths)[first[rows]] - np.cumsum(many[rows]) + many[rows], many[rows])
        start = places[at] - order[row, 0]
        for k in range(1, matrix.shape[1]):
            if not len(row):
                break
            column = order[row, k]
            wanted = matrix[row, column] * span + start + column + GAP
            near = np.minimum(np.searchsorted(keys, wanted - slop), len(keys) - 1)
            hit = (np.abs(keys[near] - wanted) <= slop) | ~inside[row, column]
            row, start = row[hit], start[hit]
        found_phrase.append(live[row])
        found_start.append(start)
    return (np.concatenate([np.empty(0, np.int64), *found_phrase]), np.concatenate([np.empty(0, np.int64), *found_start]))


def _spans(phrases: Phrases, phrase: np.ndarray, start: np.ndarray, begins: np.ndarray, out: list[list[dict]], exact: bool) -> None:
    """Adds the matches to the documents' lists; those of one item that overlap become one."""
    doc = np.searchsorted(begins, start, "right") - 1
    matches = sorted(zip(doc.tolist(), [phrases.items[p] for p in phrase], (start - begins[doc]).tolist(), phrases.sizes[phrase].tolist()))
    for d, item, at, size in matches:
        last = out[d][-1] if out[d] else None
        if last and last["item"] == item and last["exact"] == exact and at <= last["end"]:
            last["end"] = max(last["end"], at + size)
        else:
            out[d].append({"item": item, "start": at, "end": at + size, "exact": exact})


_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("exact", pa.bool_())]))


def _search(batches: Iterable[pa.RecordBatch], block, slop: int) -> Iterator[pa.RecordBatch]:
    phrases = block.value
    for batch in batches:
        for shard, doc_ids, n_words, terms, postings, lengths in zip(*batch.columns):
            counts = n_words.values.to_numpy()
            stops = np.cumsum(counts + GAP)
            begins = stops - counts - GAP
            doc_of = np.repeat(np.arange(len(counts)), counts)
            places = postings.values.to_numpy().astype(np.int64)
            places = places + doc_of[places] * GAP
            names = terms.as_py().split(b" ") if len(places) else []
            index = dict(zip(names, range(len(names))))
            out: list[list[dict]] = [[] for _ in counts]
            if len(phrases.items) and len(places):
                sizes = lengths.values.to_numpy().astype(np.int64)
                phrase, start = find(phrases, index, sizes, places, 0)
                _spans(phrases, phrase, start, begins, out, True)
                if slop:
                    near, at = find(phrases, index, sizes, places, slop)
                    new = ~np.isin(near << 40 | at, phrase << 40 | start)
                    _spans(phrases, near[new], np.maximum(at[new], 0), begins, out, False)
            yield pa.RecordBatch.from_arrays([
                pa.array([shard.as_py()] * len(counts), pa.int64()), pa.array(np.arange(len(counts))), doc_ids.values.cast(pa.int64()),
                pa.array(counts, pa.int64()), pa.array(out, _MATCHES)], names=["shard", "place", "doc_id", "n_words", "matches"])


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """For each document: doc_id, n_words and ``matches`` (item, start, end, exact).

    One block of phrases at a time is sent to the shards.  With several blocks
    the index is stored first and each document's matches of all blocks are put together."""
    _fits(window, slop)
    spark = index.sparkSession
    blocks = phrase_blocks(benchmark, window)
    send = lambda b: spark.sparkContext.broadcast(b)
    first, second = next(blocks), next(blocks, None)
    numbered = index.select(F.monotonically_increasing_id().alias("shard"), *index.columns)
    if second is not None:
        numbered = written(numbered)
    run = lambda b: numbered.mapInArrow(partial(_search, block=send(b), slop=slop), _FOUND_DDL)
    found = run(first)
    if second is not None:
        for block in chain([second], blocks):
            found = found.unionAll(run(block))
        found = found.groupBy("shard", "place").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                                    F.flatten(F.collect_list("matches")).alias("matches"))
    return found.select("doc_id", "n_words", "matches")


_FOUND_DDL = "shard long, place long, doc_id long, n_words long, matches array<struct<item:string,start:long,end:long,exact:boolean>>"


def summary(found: DataFrame) -> DataFrame:
    """The query's columns from :func:`search`'s exact matches."""
    exact = F.array_sort(F.transform(F.filter("matches", lambda m: m["exact"]), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))))
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("total"))
    hit = F.aggregate(exact, zero, lambda a, m: F.struct(
        F.greatest(a["upto"], m["end"]).alias("upto"),
        (a["total"] + F.greatest(F.lit(0).cast("long"), m["end"] - F.greatest(m["start"], a["upto"]))).alias("total")), lambda a: a["total"])
    items = F.array_sort(F.array_distinct(F.transform(F.filter("matches", lambda m: m["exact"]), lambda m: m["item"])))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), items.alias("items")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
