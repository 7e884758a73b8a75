"""N-gram Jaccard join by set-relation skipping.

A document is the set of its word shingles; equal sets are one node from there on.  All pairs of nodes
with ``100 * intersection >= percent * union`` are found exactly, in these steps:

1. Tokens get a global order, rare ones first, by the counts of ``CELLS`` hash cells over all documents (tokens
   are numbers whose order is that order).  Two sets above the threshold share a token of their prefixes, the
   rarest tokens of each; a node also carries a parity bitmap, from which a lower bound of the symmetric difference follows.
2. The prefixes are an inverted index, one list a token with entries (node, size, position), kept for tokens that two
   nodes have.  A list is sorted by size and position and cut into blocks with their least and greatest size and
   least position: a set skips blocks whose sizes are out of its reach or whose positions leave too little
   for the overlap needed (:func:`reachable`).  Very long lists are cut into parts, and every pair of parts is a run of its own.
   Pairs that pass the bounds are candidates; what a long list passes on connects them, a row a member at most.
3. The connected clusters of candidates are drawn tighter by sketches, histograms of a set's tokens with a cell for
   every eight of them: their distance is a lower bound of the symmetric difference too, and a sharp one for long texts.
4. The clusters that are left are counted on full sets (:func:`overlaps`).  A set's overlaps with all others of its cluster come
   from the cluster's index; a set that is highly similar to one already answered takes that answer and changes it by the
   lists of the tokens in which the two differ.  So the answers are whole, while only a row a member leaves a
   task: its number of links and one connecting link.  Large clusters are cut into parts, and every pair of parts is counted.
5. Components of the confirmed links, by label propagation.

Edge cases: a text of fewer words than a shingle is one shingle; null, empty and blank texts have no shingles and no
links; so do rows of a null id, whose component is null; rows equal in id and text are one document;
an id with several texts is linked by each of them; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_texts, prepare, trimmed, written
from quern.llm.components import connected_components
from quern.llm.near_dedup import _groups, set_digest
from quern.llm.shingle_sets import shingle_lists, shingle_sets

#: Hash cells whose counts order the tokens, as a power of two.
CELL_BITS = 18
#: Bits of a parity bitmap.
BITS = 1024
#: Entries of an index block; lists of up to ``SHORT`` entries are compared by shifts, of more than ``LONG`` in parts.
BLOCK, SHORT, LONG = 64, 16, 4096
#: Shingles of all sets of a cluster part, and sketch bytes of one.
MOST_SHINGLES, MOST_SKETCH = 1 << 19, 1 << 23
#: Links that a task of the candidate search holds.
MOST_LINKS = 1 << 19
#: Hash cells that name the texts to be fetched for counting: a bound on that broadcast, whatever the data.
NAMED = 1 << 18
#: Tokens for each cell of a sketch, and its fewest cells.
PER_CELL, LEAST_CELLS = 8, 32
#: Answers that a cluster keeps to derive others from, and the entries that they hold at most together.
ANSWERS, ANSWER_CELLS = 64, 1 << 22
ROWS = 1000


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity in percent from which documents are linked."""

    shingle: int = 5
    percent: int = 80

    def overlap(self, a, b):
        """Least intersection of linked sets of these sizes: ceil(percent * (a + b) / (100 + percent))."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def prefix(self, n: int) -> int:
        """Tokens of a set of n one of which any linked set has among its own."""
        return n - -(-self.percent * n // 100) + 1


# --- order of the tokens -------------------------------------------------------------

def _count_cells(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << CELL_BITS, np.int64)
    for batch in (b.slice(start, ROWS) for b in batches for start in range(0, b.num_rows, ROWS)):
        # An order needs no exact counts: shingles that a text repeats count each time.
        found = np.concatenate(list(shingle_lists(as_texts(batch.column(0)), size)))
        counts += np.bincount((found & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64), minlength=1 << CELL_BITS)
    yield pa.RecordBatch.from_arrays([pa.array([counts], pa.list_(pa.int64()))], names=["counts"])


def cell_ranks(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Rank of every cell by the number of tokens in it over all documents: ``1 << CELL_BITS`` numbers."""
    texts = docs.select(docs["text"].cast("string").alias("text"))
    cells = texts.mapInArrow(partial(_count_cells, size=rule.shingle), "counts array<long>").select(F.posexplode("counts").alias("cell", "n"))
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    ranks = np.empty(1 << CELL_BITS, np.uint64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(1 << CELL_BITS, dtype=np.uint64)
    return ranks


def ordered(found: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The tokens renamed one to one so that their order as numbers is the global order, sorted."""
    cells = (found & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)
    return np.sort(ranks[cells] << np.uint64(64 - CELL_BITS) | found >> np.uint64(CELL_BITS))


def parity(found: np.ndarray) -> np.ndarray:
    """``BITS`` bits, each the parity of the number of tokens that fall on it."""
    at = (found * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=BITS).astype(np.uint8) & 1)


def sketch(found: np.ndarray) -> np.ndarray:
    """Histogram of the tokens by their leading bits, its cells a power of two; counts beyond 255 are 255."""
    bits = max(LEAST_CELLS, len(found) // PER_CELL).bit_length() - 1
    at = (found * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=1 << bits), 255).astype(np.uint8)


# --- nodes -----------------------------------------------------------------------------

def _signed(batches: Iterable[pa.RecordBatch], ranks, rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in (b.slice(start, ROWS) for b in batches for start in range(0, b.num_rows, ROWS)):
        sets = shingle_sets(as_texts(batch.column(1)), rule.shingle)
        each = lambda f, kind: pa.array([f(x) if len(x) else None for x in sets], kind)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(2), pa.array([len(x) for x in sets], pa.int64()), each(set_digest, pa.string()),
            each(lambda x: ordered(x, ranks.value)[:rule.prefix(len(x))].view(np.int64), pa.list_(pa.int64())),
            each(lambda x: parity(x).tobytes(), pa.binary()), each(lambda x: sketch(x).tobytes(), pa.binary()),
        ], names=["doc_id", "text_hash", "n_shingles", "digest", "prefix", "bits", "sketch"])


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), F.xxhash64(docs["text"].cast("string")).alias("text_hash"))


def sign(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, text_hash, n_shingles and, unless there are none, digest of the set, prefix in global order, parity bits, sketch."""
    prepare(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(cell_ranks(docs, rule))  # 8 bytes a cell

    def run(batches):
        return trimmed(_signed(batches, ranks, rule))

    return _plain(docs).mapInArrow(run, "doc_id long, text_hash long, n_shingles long, digest string, prefix array<long>, bits binary, sketch binary")


# --- candidates from the index ---------------------------------------------------------

def _differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def reachable(size: int, position: int, least: np.ndarray, greatest: np.ndarray, first: np.ndarray, rule: Rule) -> np.ndarray:
    """Blocks (least size, greatest size, least position) that can hold a set linked with one of this size and position."""
    p = rule.percent
    sizes = (100 * greatest >= p * size) & (100 * size >= p * least)
    own = (100 + p) * (size - position) >= p * (size + least)  # what is left of the set itself
    theirs = (100 + p) * (greatest - first) >= p * (size + greatest)  # grows with the size: so at the greatest
    return sizes & own & theirs


def _short_lists(token, node, size, position, bits, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries of the same list, all lists at once, one distance in the list after another."""
    for d in range(1, SHORT):
        i = np.flatnonzero(token[d:] == token[:-d])
        if not len(i):
            return
        j = i + d
        need = rule.overlap(size[i], size[j])
        fit = (np.minimum(size[i] - position[i], size[j] - position[j]) >= need) & (node[i] != node[j])
        i, j, need = i[fit], j[fit], need[fit]
        for at in range(0, len(i), 65536):
            a, b = i[at:at + 65536], j[at:at + 65536]
            close = _differ(bits[a], bits[b]) <= size[a] + size[b] - 2 * need[at:at + 65536]
            yield node[a[close]], node[b[close]]


def _long_list(node, size, position, bits, side, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the candidates of one list; ``side`` as in :func:`_parts`."""
    order = np.lexsort((position, size))
    node, size, position, bits, side = node[order], size[order], position[order], bits[order], side[order]
    n = len(node)
    across = side[0] >= 0
    starts = np.arange(0, n, BLOCK)
    least, greatest, first = size[starts], size[np.minimum(starts + BLOCK, n) - 1], np.minimum.reduceat(position, starts)
    left = np.ones(n, bool)  # not yet reached from any other
    full = np.minimum(starts + BLOCK, n) - starts  # of each block
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for seed in range(n):
        if not left[seed]:
            continue
        left[seed] = False
        full[seed // BLOCK] -= 1
        frontier = [seed]
        while frontier:
            i = frontier.pop()
            blocks = np.flatnonzero(reachable(size[i], position[i], least, greatest, first, rule) & (full > 0))
            if not len(blocks):
                continue
            j = (starts[blocks][:, None] + np.arange(BLOCK)).ravel()
            j = j[j < n]
            j = j[left[j]]
            if across:
                j = j[side[j] != side[i]]
            need = rule.overlap(size[i], size[j])
            j, need = (x[np.minimum(size[i] - position[i], size[j] - position[j]) >= need] for x in (j, need))
            j = j[_differ(bits[j], bits[i]) <= size[i] + size[j] - 2 * need]
            if len(j):
                left[j] = False
                np.subtract.at(full, j // BLOCK, 1)
                frontier += j.tolist()
                found.append((np.full(len(j), node[i]), node[j]))
    return tuple(np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*found) if found else ([], [])))


def _candidates(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows (run, node, size, position, side, bits) sorted by run -> links (a, b) that connect candidates."""

    def links():
        for batch in _at_runs(batches):
            run, node, size, position, side = (batch.column(k).to_numpy() for k in range(5))
            bits = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(len(run), BITS // 8)
            cuts = np.flatnonzero(np.diff(run, prepend=run[0] - 1, append=run[-1] + 1))
            sizes = np.diff(cuts)
            small = np.repeat(sizes <= SHORT, sizes)
            yield from _short_lists(run[small], node[small], size[small], position[small], bits[small], rule)
            for k in np.flatnonzero(sizes > SHORT):
                part = slice(cuts[k], cuts[k + 1])
                yield _long_list(node[part], size[part], position[part], bits[part], side[part], rule)

    held: list[np.ndarray] = []
    for a, b in links():
        if len(a):
            held.append(np.stack([a, b], axis=1))
        if sum(map(len, held)) > MOST_LINKS:
            held = [_stars(held)]
            if len(held[0]) > MOST_LINKS // 2:
                yield _edge_batch(held[0])
                held = []
    yield _edge_batch(_stars(held))


def _stars(held: list[np.ndarray]) -> np.ndarray:
    """Links of every node to the smallest one that it is connected with: as few as there are nodes, however many
    lists have led to them."""
    ends = np.concatenate([np.empty((0, 2), np.int64), *held])
    nodes, at = np.unique(ends, return_inverse=True)
    at = at.reshape(-1, 2)
    label, before = np.arange(len(nodes)), None
    while before is None or (label != before).any():
        before = label.copy()
        least = np.minimum(label[at[:, 0]], label[at[:, 1]])
        np.minimum.at(label, at[:, 0], least)
        np.minimum.at(label, at[:, 1], least)
        label = label[label]
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[label[other]], nodes[other]], axis=1)


def _edge_batch(ends: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0], pa.int64()), pa.array(ends[:, 1], pa.int64())], names=["a", "b"])


def _at_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches that end where a run (equal values of the first column) ends."""
    held: list[pa.RecordBatch] = []  # rows of one run, which may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        run = batch.column(0).to_numpy()
        others = np.flatnonzero(run != run[-1])
        cut = int(others[-1]) + 1 if len(others) else 0  # where the last run begins
        if cut:
            yield _joined([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[0].column(0)[0].as_py() != run[0]:
            yield _joined(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def _parts(df: DataFrame, group: str, node: str, size: str, most: int, out: str) -> DataFrame:
    """``out`` and ``side``: the runs that a row takes part in.  Groups of up to ``most`` are one run; larger ones are
    cut into parts, and each part and each pair of parts is a run.  Where the run is a pair, of which only pairs
    across count, ``side`` is the row's part, else -1."""
    n = F.ceil(F.col(size) / most)
    own = F.pmod(F.xxhash64(node, F.lit(11)), n)
    run = lambda j: F.struct(F.xxhash64(group, F.least(own, j), F.greatest(own, j)).alias(out), F.when(j == own, -1).otherwise(own).alias("side"))
    whole = df.filter(F.col(size) <= most).withColumns({out: F.col(group), "side": F.lit(-1).cast("long")})
    cut = df.filter(F.col(size) > most).withColumn("run_of", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), run)))
    return whole.unionByName(cut.select(*df.columns, f"run_of.{out}", "run_of.side"))


def _in_runs(df: DataFrame, key: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def candidates(classes: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) that connect the nodes of candidate clusters; ``classes``: node, n_shingles, prefix, bits."""
    entries = classes.select("node", F.col("n_shingles").alias("size"), F.posexplode("prefix").alias("position", "token"))
    lists = written(entries.groupBy("token").agg(F.count("*").alias("length")).filter("length > 1"))
    # Both sides are scans, so that a very frequent token is a skewed partition that Spark splits.
    kept = entries.join(lists, "token").select("token", "node", "size", F.col("position").cast("long").alias("position"), "length")
    runs = _parts(kept, "token", "node", "length", LONG, "run").join(classes.select("node", "bits"), "node").select("run", "node", "size", "position", "side", "bits")
    return _in_runs(runs, "run").mapInArrow(lambda batches: trimmed(_candidates(batches, rule)), "a long, b long")


# --- clusters drawn tighter -----------------------------------------------------------------

def _alike(nodes: np.ndarray, sizes: np.ndarray, sketches: list[np.ndarray], side: np.ndarray, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the nodes whose sketches leave a link possible.  Sets that can be linked differ by less than
    2 in size, so their sketches by one halving at most: pairs are compared with the cells of the coarser one."""
    own = np.fromiter(map(len, sketches), np.int64, len(sketches))
    level, place = {}, {}  # cells -> members, their histograms; -> place of a member
    for cells in np.unique(own):
        members = np.flatnonzero((own == cells) | (own == 2 * cells))
        level[cells] = members, np.stack([s if len(s) == cells else s.reshape(-1, 2).sum(axis=1, dtype=np.uint16) for s in map(sketches.__getitem__, members)]).astype(np.int16)
        place[cells] = np.full(len(nodes), -1)
        place[cells][members] = np.arange(len(members))
    left, across = np.ones(len(nodes), bool), side[0] >= 0
    for seed in range(len(nodes)):
        frontier = [seed] if left[seed] else []
        left[seed] = False
        while frontier:
            i = frontier.pop()
            for cells in (own[i], own[i] // 2):
                if cells not in level:
                    continue
                members, rows = level[cells]
                at = np.flatnonzero(left[members] & ((own[members] == cells) | (own[i] == cells)))
                j = members[at]
                fit = rule.percent * np.maximum(sizes[i], sizes[j]) <= 100 * np.minimum(sizes[i], sizes[j])
                at, j = (x[fit & (side[j] != side[i])] if across else x[fit] for x in (at, j))
                if not len(j):
                    continue
                most = sizes[i] + sizes[j] - 2 * rule.overlap(sizes[i], sizes[j])
                j = j[np.abs(rows[at] - rows[place[cells][i]]).sum(axis=1, dtype=np.int64) <= most]
                if len(j):
                    left[j] = False
                    frontier += j.tolist()
                    yield np.full(len(j), nodes[i]), nodes[j]


def _refine(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, node, side, size, sketch) sorted by cluster -> links (a, b) that connect what can still be linked."""
    for group in _groups(batches):
        nodes, rows = np.unique(group.column(1).to_numpy(), return_index=True)
        sizes, side = group.column(3).to_numpy()[rows], group.column(2).to_numpy()[rows]
        sketches = [np.frombuffer(group.column(4)[int(i)].as_py(), np.uint8) for i in rows]
        held = [np.stack([a, b], axis=1) for a, b in _alike(nodes, sizes, sketches, side, rule)]
        if held:
            yield _edge_batch(_stars(held))


# --- answers on full sets -----------------------------------------------------------------

class _Index:
    """Lists of the sets that hold each token."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        distinct, self.numbers = np.unique(np.concatenate(sets), return_inverse=True)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        self.owners = owners[np.argsort(self.numbers, kind="stable")]
        self.lengths = np.bincount(self.numbers, minlength=len(distinct))
        self.first = np.cumsum(self.lengths) - self.lengths
        self.mark = np.zeros(len(distinct), bool)

    def tokens(self, i: int) -> np.ndarray:
        return self.numbers[self.starts[i]:self.starts[i + 1]]

    def hits(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the tokens each set holds."""
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        at = np.repeat(self.first[tokens] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return np.bincount(self.owners[at], minlength=len(self.sizes))

    def without(self, of: np.ndarray, other: np.ndarray) -> np.ndarray:
        self.mark[other] = True
        found = of[~self.mark[of]]
        self.mark[other] = False
        return found


def overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, sizes of the intersections of set i with every set), for each set.  If a set answered before shares so much
    with it that fewer tokens differ than it has, its answer comes from that one's and the lists of those tokens."""
    index = _Index(sets)
    n = len(sets)
    most = max(1, min(ANSWERS, ANSWER_CELLS // n))
    known: list[tuple[int, np.ndarray]] = []
    for i in range(n):
        best = max(range(len(known)), key=lambda k: 2 * known[k][1][i] - index.sizes[known[k][0]], default=None)
        if best is not None:
            j, answer = known[best]
            differ = index.sizes[i] + index.sizes[j] - 2 * answer[i]
        if best is not None and 2 * differ < index.sizes[i]:
            mine, theirs = index.tokens(i), index.tokens(j)
            shared = answer if not differ else answer + index.hits(index.without(mine, theirs)) - index.hits(index.without(theirs, mine))
        else:
            shared = index.hits(index.tokens(i))
            known = [*known[-(most - 1):], (i, shared)] if most > 1 else [(i, shared)]
        yield i, shared


def _answers(batches: Iterable[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, node, side, weight, text) sorted by cluster -> for each node that has links, their number by
    weight and a node that it is connected with."""
    for group in _groups(batches):
        nodes, rows = np.unique(group.column(1).to_numpy(), return_index=True)
        if len(nodes) < 2:
            continue
        side, weight = group.column(2).to_numpy()[rows], group.column(3).to_numpy()[rows]
        texts = group.column(4).cast(pa.binary())
        sets = shingle_sets([texts[int(i)].as_py() for i in rows], rule.shingle)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        across = side[0] >= 0
        label, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        for i, shared in overlaps(sets):
            linked = 100 * shared >= rule.percent * (sizes[i] + sizes - shared)
            linked[i] = False
            if across:
                linked &= side != side[i]
            if linked.any():
                links[i] = weight[linked].sum()
                joined = label[linked]
                if (joined != label[i]).any():
                    joined = np.unique(np.append(joined, label[i]))
                    label[np.isin(label, joined)] = joined[0]
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[some], pa.int64()), pa.array(nodes[label[some]], pa.int64()), pa.array(links[some], pa.int64())],
                                         names=["a", "b", "links"])


def join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and n_links, the other documents linked with it."""
    signed = written(sign(docs, rule))
    known = signed.filter("n_shingles > 0 and doc_id is not null")
    members = known.select("doc_id", "digest").distinct().groupBy("digest").agg(F.count("*").alias("weight"))
    any_row = F.min_by(F.struct("n_shingles", "prefix", "bits", "sketch", "text_hash"), "doc_id")
    classes = known.groupBy("digest").agg(F.min("doc_id").alias("first_id"), any_row.alias("row")).join(members, "digest")
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "weight", "first_id", "row.*"))
    loose = connected_components(candidates(classes, rule))
    loose = written(loose.join(classes.select("node", F.col("n_shingles").alias("size"), "sketch"), "node"))
    weights = written(loose.groupBy("component").agg(F.sum(F.octet_length("sketch")).alias("bytes")))
    rows = _parts(loose.join(weights, "component"), "component", "node", "bytes", MOST_SKETCH, "cluster").select("cluster", "node", "side", "size", "sketch")
    clusters = connected_components(_in_runs(rows, "cluster").mapInArrow(lambda batches: trimmed(_refine(batches, rule)), "a long, b long"))
    clusters = written(clusters.join(classes.select("node", "weight", "n_shingles", F.col("first_id").alias("doc_id"), "text_hash"), "node"))
    sizes = written(clusters.groupBy("component").agg(F.sum("n_shingles").alias("size")))
    placed = _parts(clusters.join(sizes, "component"), "component", "node", "size", MOST_SHINGLES, "cluster")
    runs = written(placed.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("cluster", "node", "side", "weight")).alias("runs")))
    # Most documents are in no cluster; those whose cell holds no member stay out of the shuffle.
    cell = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(NAMED)).cast("int")
    named = F.broadcast(runs.select(cell.alias("cell")).distinct())
    wanted = _plain(docs).withColumn("cell", cell).join(named, "cell", "left_semi").drop("cell")
    # Rows equal in id and text are one; the join has put them side by side.
    texts = wanted.join(runs, ["doc_id", "text_hash"]).groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"), F.first("runs").alias("runs"))
    placed = texts.select(F.explode("runs").alias("run"), "text").select("run.*", "text")
    found = written(_in_runs(placed, "cluster").mapInArrow(lambda batches: trimmed(_answers(batches, rule)), "a long, b long, links long"))
    joined = connected_components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    ids = classes.select("node", "digest", "first_id", "weight").join(joined, "node", "left").join(links, "node", "left")
    ids = ids.select("digest", F.coalesce("component", "node").alias("component"), "first_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    smallest = ids.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_digest = written(ids.join(smallest, "component").select("digest", "component_id", "n_links"))
    out = signed.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
    null = F.col("doc_id").isNull()
    return out.select("doc_id", "n_shingles", F.when(~null, F.coalesce("component_id", "doc_id")).alias("component_id"),
                      F.when(null, F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"))
