"""Near-duplicate detection: Chosen-path set similarity join.

A document is the set of its word shingles (64-bit hashes).  Documents of
equal sets form a class; a class is one node from there on.

1. Every node has ``COORDINATES`` minwise tokens.  Each of several independent trees sends a node
   down the branches named by two of its tokens; a branch with more than ``SMALL`` nodes is
   branched again by two other tokens (chosen by a hash of the path), up to ``DEPTH`` times.
   Two sets of similarity s share a token with probability s, so a pair at
   the threshold misses all leaves of a tree with the probability of :func:`missed`, and
   the number of trees follows from the wanted recall.
2. Leaves compare all their nodes by one byte of each token.  A branch that is still large at
   the last level (near copies of one text) is cut into blocks, and every pair of blocks is a leaf.
   What a leaf passes on is its candidate clusters, a row for each member.
3. The connected clusters are checked on the full sets: every node meets its cluster's
   others; of the confirmed links, those that connect are passed on.  Clusters above ``MOST_SHINGLES`` are
   cut into blocks, and every pair of blocks is checked.
4. Confirmed links are joined to components.

No step emits pairs of a group's members: leaves and clusters give at most a row a member.

Edge cases: a text of fewer words than a shingle is one shingle; null, empty and blank
texts have no shingles and stay alone; so do rows of a null id, whose component is null and which
are kept; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil, floor, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_texts, prepare, trimmed, written
from quern.llm.components import connected_components

COORDINATES, BRANCHES, DEPTH, SMALL = 128, 2, 2, 1024
#: Shingles of all sets that are checked against each other at once.
MOST_SHINGLES = 1 << 19
#: A pair at the threshold is in a common leaf with this probability; its tokens agree as
#: rarely as ``DOUBT`` standard deviations below the mean with one of less than 1 in 10,000.
RECALL, DOUBT = 0.99999, 4.0
#: Rows signed at once.
ROWS = 1000
#: Distinct words whose hashes a worker remembers; beyond it, it starts anew.
MEMORY = 200_000


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity in percent from which documents are linked."""

    shingle: int = 5
    percent: int = 80


def missed(similarity: float, depth: int = DEPTH) -> float:
    """Chance that two sets of this similarity are in no common node of a tree's level ``depth``."""
    miss = 0.0
    for _ in range(depth):
        miss = (1 - similarity * (1 - miss)) ** BRANCHES
    return miss


def trees(similarity: float) -> int:
    return max(1, ceil(log(1 - RECALL) / log(missed(similarity)))) if missed(similarity) else 1


def least_agreement(similarity: float) -> int:
    """Tokens whose bytes agree in two sets at the threshold, at least."""
    p = similarity + (1 - similarity) / 256
    return max(1, floor(COORDINATES * p - DOUBT * sqrt(COORDINATES * p * (1 - p))))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > MEMORY:
            self.clear()
        return self.setdefault(word, xxhash.xxh64_intdigest(word))


_HASHES = _WordHashes()
_A = np.random.default_rng(7).integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(words) - n + 1 + k])
    return np.unique(out)


def minwise(found: np.ndarray) -> np.ndarray:
    """``COORDINATES`` minwise tokens (32 bits) of a set that isn't empty."""
    least = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for start in range(0, len(found), 4096):
        least = np.minimum(least, (found[start:start + 4096, None] * _A).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def set_digest(found: np.ndarray) -> str:
    import xxhash

    return xxhash.xxh3_128_hexdigest(found.tobytes())


def _sign(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    return trimmed(_signed(batches, size), _HASHES.clear)


def _signed(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(start, ROWS) for b in batches for start in range(0, b.num_rows, ROWS)):
        sets = [shingles(t, size) for t in as_texts(batch.column(1))]
        tokens = [minwise(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_digest(s) if len(s) else None for s in sets], pa.string()),
            pa.array([None if t is None else t.view(np.int32) for t in tokens], pa.list_(pa.int32())),
            pa.array([None if t is None else t.astype(np.uint8).tobytes() for t in tokens], pa.binary()), batch.column(2),
        ], names=["doc_id", "n_shingles", "digest", "tokens", "bytes", "text_hash"])


def sign(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, digest of the set, minwise tokens and a byte of each (null without shingles), hash of the text."""
    prepare(docs.sparkSession)
    return _plain(docs).mapInArrow(partial(_sign, size=rule.shingle),
                                   "doc_id long, n_shingles long, digest string, tokens array<int>, bytes binary, text_hash long")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal values in the first column of a sorted stream, each as one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts[:-1], cuts[1:]):
            part = batch.slice(start, end - start)
            if held and held[0].column(0)[0] != part.column(0)[0]:
                yield _whole(held)
                held = []
            held.append(part)
    if held:
        yield _whole(held)


def _whole(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found) if found else ([], [])))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _batched(found: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    some: list = []
    for x in found:
        some.append(x)
        if len(some) >= 5000:
            yield _edges(some)
            some = []
    yield _edges(some)


class _Merged:
    """Union of node positions; the label of a group is its smallest position."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, i: int, others: np.ndarray) -> None:
        joined = np.unique(self.label[others])
        low = min(int(joined[0]), int(self.label[i])) if len(joined) else int(self.label[i])
        self.label[np.isin(self.label, joined) | (self.label == self.label[i])] = low

    def star(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A link from the first node of each group to each other node of it."""
        other = self.label != np.arange(len(nodes))
        return nodes[self.label[other]], nodes[other]


def _compare(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows (leaf, node, n_shingles, bytes of tokens) sorted by leaf -> links that connect candidates."""
    least = least_agreement(rule.percent / 100)

    def leaves():
        for group in _groups(batches):
            nodes, first = np.unique(group.column(1).to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            sizes = group.column(2).to_numpy()[first]
            bytes_ = np.frombuffer(b"".join(group.column(3).to_pylist()), np.uint8).reshape(group.num_rows, COORDINATES)[first]
            merged = _Merged(len(nodes))
            for i in range(len(nodes) - 1):
                rest = np.flatnonzero(merged.label[i + 1:] != merged.label[i]) + i + 1
                close = 100 * np.minimum(sizes[rest], sizes[i]) >= rule.percent * np.maximum(sizes[rest], sizes[i])
                rest = rest[close]
                if len(rest) and len(rest := rest[(bytes_[rest] == bytes_[i]).sum(axis=1) >= least]):
                    merged.link(i, rest)
            yield merged.star(nodes)

    yield from trimmed(_batched(leaves()))


def _confirm(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, node, text) sorted by cluster -> confirmed links that connect."""

    def clusters():
        for group in _groups(batches):
            nodes, first = np.unique(group.column(1).to_numpy(), return_index=True)
            texts = group.column(2).cast(pa.binary())
            sets = [shingles(texts[int(i)].as_py(), rule.shingle) for i in first]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            flat, numbers = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            merged = _Merged(len(nodes))
            inside = np.zeros(len(flat), np.int64)
            for i in range(len(nodes) - 1):
                if not merged.label.any():
                    break  # one group already
                inside[numbers[starts[i]:starts[i] + sizes[i]]] = 1
                shared = np.add.reduceat(inside[numbers[starts[i + 1]:]], starts[i + 1:] - starts[i + 1])
                inside[numbers[starts[i]:starts[i] + sizes[i]]] = 0
                linked = 100 * shared >= rule.percent * (sizes[i] + sizes[i + 1:] - shared)
                if linked.any():
                    merged.link(i, np.flatnonzero(linked) + i + 1)
            yield merged.star(nodes)

    yield from trimmed(_batched(clusters()), _HASHES.clear)


def _in_runs(df: DataFrame, key: str) -> DataFrame:
    """Equal keys together and in order.  The count is set, so that it isn't lowered for a few rows with much work."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def _blocks(df: DataFrame, group: str, node: str, size: str, block: int, out: str) -> DataFrame:
    """``out``: keys of the block pairs that a row takes part in; groups of up to ``block`` rows are one block."""
    n = F.ceil(F.col(size) / block)
    own = F.pmod(F.xxhash64(node, F.lit(11)), n)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda j: F.xxhash64(group, F.least(own, j), F.greatest(own, j)))
    whole = df.filter(F.col(size) <= block).withColumn(out, F.col(group))
    return whole.unionByName(df.filter(F.col(size) > block).withColumn(out, F.explode(pairs)))


def candidates(classes: DataFrame, rule: Rule, nodes: int) -> DataFrame:
    """Links (a, b) that connect the nodes of candidate clusters; ``classes``: node, n_shingles, tokens."""
    roots = [F.xxhash64(F.lit(t), F.lit(b), F.col("tokens")[t * BRANCHES + b]) for t in range(trees(rule.percent / 100)) for b in range(BRANCHES)]
    level = classes.select("node", F.explode(F.array(*roots)).alias("path"))
    leaves = []
    for depth in range(DEPTH):
        sizes = level.groupBy("path").agg(F.count("*").alias("size")).filter("size > 1")
        level = written(level.join(sizes, "path"), nodes * len(roots))
        if depth == DEPTH - 1 or level.filter(F.col("size") > SMALL).isEmpty():
            leaves.append(level)
            break
        leaves.append(level.filter(F.col("size") <= SMALL))
        large = level.filter(F.col("size") > SMALL).select("node", "path").join(classes.select("node", "tokens"), "node")
        first = F.pmod(F.xxhash64("path", F.lit(0)), F.lit(COORDINATES))
        second = F.pmod(first + 1 + F.pmod(F.xxhash64("path", F.lit(1)), F.lit(COORDINATES - 1)), F.lit(COORDINATES))
        branch = lambda c: F.xxhash64("path", c, F.col("tokens")[c.cast("int")])
        level = large.select("node", F.explode(F.array(branch(first), branch(second))).alias("path"))
    members = leaves[0]
    for more in leaves[1:]:
        members = members.unionByName(more)
    bytes_ = classes.select("node", "n_shingles", "bytes")
    placed = _blocks(members, "path", "node", "size", SMALL, "leaf").select("leaf", "node").join(bytes_, "node").select("leaf", "node", "n_shingles", "bytes")
    return _in_runs(placed, "leaf").mapInArrow(partial(_compare, rule=rule), "a long, b long")


def components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept."""
    signed = written(sign(docs, rule))
    known = signed.filter("n_shingles > 0 and doc_id is not null")
    any_row = F.min_by(F.struct("n_shingles", "tokens", "bytes", "text_hash"), "doc_id")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("first_id"), any_row.alias("row"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "first_id", "row.*"), signed.count(), 20_000)
    nodes = classes.count()
    clusters = connected_components(candidates(classes, rule, nodes), nodes).join(classes.select("node", F.col("first_id").alias("doc_id"), "text_hash", "n_shingles"), "node")
    sizes = clusters.groupBy("component").agg(F.sum("n_shingles").alias("size"))
    # One text for each node: ids may be repeated, and then with other texts too.
    texts = clusters.join(_plain(docs), ["doc_id", "text_hash"]).groupBy("node", "component").agg(F.first("text").alias("text"))
    placed = _blocks(texts.join(sizes, "component"), "component", "node", "size", MOST_SHINGLES, "cluster").select("cluster", "node", "text")
    links = _in_runs(placed, "cluster").mapInArrow(partial(_confirm, rule=rule), "a long, b long")
    joined = connected_components(links, nodes)
    ids = classes.select("node", "digest", "first_id").join(joined, "node", "left").select("digest", F.coalesce("component", "node").alias("component"), "first_id")
    smallest = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_digest = ids.join(smallest, "component").select("digest", "component_id")
    out = signed.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
