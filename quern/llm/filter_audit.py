"""Filter interaction audit: what each filter removes, in every order of the filters.

Five filters judge whole texts; a document's failures are a mask of five bits.  Spark counts the documents (all, of
good quality, toxic) of every mask in every part of the corpus: 32 rows a part at most.  Each part's counts become a
decision diagram (:class:`Diagram`): a level for each filter, a branch for pass and fail, equal subtrees shared, and
the counts of what lies below at every node.  Swaps of adjacent levels lead through all orders of the filters; in each
order the path on which all filters pass gives the steps: what branches off at a level is removed there.

Filter E (a text that a smaller id has) compares digests (SHA-256) of whole texts.  The first id of a digest is a
partial minimum, and a document finds out whether it is the first by a join on (digest, id), so a text that a third of
all rows share is gathered nowhere.

Edge cases: null texts are empty; a null source is the part ``""``; rows of a null id have no labels, fail E never and
make no other row fail it; rows equal in id and text fail E both or not at all; a document is good or toxic if
any label row of its id says so; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import let, prepare, written

FILTERS = "ABCDE"
#: Fewest words; least percentage of distinct words; most percentage of capitals; marks that no text may hold.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 50, 65, 5, "[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
           "good_lost long, toxic_lost long, shapley long")

Weight = tuple[int, ...]


class Diagram:
    """Count-weighted decision diagram of failure masks.

    ``levels[k]`` holds the nodes of the filter at place k of ``order``: pairs (pass, fail) of positions in the next
    level; the positions of the last level point to ``leaves``, the distinct weights.  Equal nodes of a level are one.
    ``totals[k]`` has the weight below every node of level k."""

    def __init__(self, weights: dict[int, Weight], size: int):
        zero = (0,) * len(next(iter(weights.values()), (0,)))
        self.order = list(range(size))
        self.levels: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        self.leaves: list[Weight] = []
        unique: list[dict] = [{} for _ in range(size + 1)]

        def place(level: int, node) -> int:
            at = unique[level].setdefault(node, len(unique[level]))
            store = self.leaves if level == size else self.levels[level]
            if at == len(store):
                store.append(node)
            return at

        def build(level: int, mask: int) -> int:
            if level == size:
                return place(size, tuple(weights.get(mask, zero)))
            return place(level, (build(level + 1, mask), build(level + 1, mask | 1 << level)))

        build(0, 0)
        self.totals: list[list[Weight]] = [[] for _ in range(size)] + [self.leaves]
        for level in reversed(range(size)):
            self._weigh(level)

    def _weigh(self, level: int) -> None:
        below = self.totals[level + 1]
        self.totals[level] = [tuple(map(sum, zip(below[p], below[f]))) for p, f in self.levels[level]]

    def swap(self, level: int) -> None:
        """Exchanges the filters of ``level`` and the next one.  The nodes of ``level`` stay the same functions, so
        nothing above changes; those below are made anew from the four grandchildren of each."""
        lower = self.levels[level + 1]
        unique: dict[tuple[int, int], int] = {}
        node = lambda pair: unique.setdefault(pair, len(unique))
        self.levels[level] = [(node((lower[p][0], lower[f][0])), node((lower[p][1], lower[f][1]))) for p, f in self.levels[level]]
        self.levels[level + 1] = list(unique)
        self._weigh(level + 1)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, Weight, Weight]]:
        """(filter, weight kept, weight removed) along the path on which every filter passes."""
        node = 0
        for level, name in enumerate(self.order):
            passed, failed = self.levels[level][node]
            yield name, self.totals[level + 1][passed], self.totals[level + 1][failed]
            node = passed


def adjacent_swaps(size: int) -> Iterator[int]:
    """Places of the swaps (place, place + 1) that lead through all orders of ``size`` things, each order once:
    the last thing runs to and fro through the orders of the others."""
    if size < 2:
        return
    inner, forth = adjacent_swaps(size - 1), False
    while True:
        yield from range(size - 1) if forth else reversed(range(size - 1))
        forth = not forth
        step = next(inner, None)
        if step is None:
            return
        # The last thing stands in front of the others after a run back, behind them after a run forth.
        yield step + (1 if forth else 0)


def audit_part(weights: dict[int, Weight], names: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order and step;
    ``weights``: (documents, good, toxic) of each failure mask, bit k for ``names[k]``."""
    fails = [sum(w[0] for mask, w in weights.items() if mask >> k & 1) for k in range(len(names))]
    alone = [weights.get(1 << k, (0,))[0] for k in range(len(names))]
    diagram = Diagram(weights, len(names))
    found, shapley = [], [0] * len(names)

    def note() -> None:
        label = "".join(names[k] for k in diagram.order)
        for step, (k, kept, gone) in enumerate(diagram.steps(), 1):
            shapley[k] += gone[0]
            found.append((label, step, k, kept[0], *gone))

    note()
    for place in adjacent_swaps(len(names)):
        diagram.swap(place)
        note()
    return [(label, step, kept, gone, fails[k] - gone, alone[k], good, toxic, shapley[k]) for label, step, k, kept, gone, good, toxic in found]


def _audited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * 7
    for batch in batches:
        for row in batch.to_pylist():
            weights = {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in row["masks"]}
            rows = [(row["part"], *r) for r in audit_part(weights)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def failures(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that the text fails."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    n_words, capitals = lambda ws: F.size(ws), F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    of_words = let(words, lambda ws: F.when(n_words(ws) < LEAST_WORDS, 1).otherwise(0)
                   + F.when(100 * F.size(F.array_distinct(ws)) < LEAST_DISTINCT * n_words(ws), 2).otherwise(0))
    return of_words + F.when(100 * capitals.cast("long") > MOST_CAPITALS * F.length(text), 4).otherwise(0) + F.when(text.rlike(MARKS), 8).otherwise(0)


def failure_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: the documents of every failure mask; 32 rows a part at most."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    # Long texts go no further than this scan; repeated rows meet in a partial count.
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), failures(text).alias("mask"))
    rows = written(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")))
    known = rows.filter("doc_id is not null")
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    first = written(known.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))).withColumn("first", F.lit(True))
    judged = known.join(said, "doc_id", "left").join(first, ["digest", "doc_id"], "left")
    zero = F.lit(0).cast("long")
    judged = judged.select("part", (F.col("mask") + F.when(F.col("first").isNull(), 16).otherwise(0)).alias("mask"), "n",
                           F.coalesce("good", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic"))
    nameless = rows.filter("doc_id is null").select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    return judged.unionByName(nameless).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("good") * F.col("n")).alias("good"), F.sum(F.col("toxic") * F.col("n")).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the five filters and step."""
    prepare(docs.sparkSession)
    masks = failure_masks(docs, labels)
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return parts.mapInArrow(_audited, _SCHEMA)
