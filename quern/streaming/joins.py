"""JOI-11 regular streaming join: two changelogs, unbounded state, a changelog out.

Every row says whether it is added (``+``) or taken back (``-``), in any order of event time, and no watermark ever drops state: a
row matches all rows of the other side that were ever added and not taken back.  The state of a key is a multiset
for each side: row -> number of copies, number of matches on the other side.  The matches decide when an outer
join's padded row, or a semi or anti join's row, has to be taken back or comes back.  A multiset is stored in chunks of at most
``CHUNK`` rows, as every call to the state store costs far more than a row: a micro-batch reads a key's chunks once and writes those it changed.

The changelog out, folded (``+`` less ``-`` of each row), is at any time the batch join of the folded inputs.

A row of a null key matches nothing.  Taking back a row that isn't there changes nothing.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

KINDS = ("inner", "left", "right", "full", "semi", "anti")
#: Rows that are stored as one value.
CHUNK = 1_024


class RegularJoin(StatefulProcessor):
    def __init__(self, how: str, names: Sequence[str], left: StructType, right: StructType, on: Callable | None = None):
        if how not in KINDS:
            raise ValueError(f"not a kind of join: {how}")
        self.how, self.on = how, on
        self.width = {"L": len(left.fields), "R": len(right.fields)}
        self.padded = {"L": how in ("left", "full"), "R": how in ("right", "full")}
        self.make = Row(*names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = {s: handle.getMapState(name, "chunk int", "rows binary") for s, name in (("L", "left"), ("R", "right"))}

    def _matching(self, key, side: str, row: tuple, held: dict) -> list[tuple]:
        if any(k is None for k in key):
            return []
        others = held["R" if side == "L" else "L"]
        if self.on is None:
            return list(others)
        return [o for o in others if (self.on(row, o) if side == "L" else self.on(o, row))]

    def _out(self, op: str, key, side: str, row: tuple, other: tuple | None = None) -> Row:
        if self.how in ("semi", "anti"):
            return self.make(op, *key, *row)
        o = "R" if side == "L" else "L"
        other = (None,) * self.width[o] if other is None else other
        return self.make(op, *key, *(row + other if side == "L" else other + row))

    def _change(self, key, side: str, row: tuple, op: str, held: dict, sizes: dict, touched: set) -> Iterator[Row]:
        mine, o = held[side], "R" if side == "L" else "L"
        if op == "-" and row not in mine:
            return
        step = 1 if op == "+" else -1
        matching = self._matching(key, side, row, held)
        n = sum(held[o][m][0] for m in matching)
        if self.how in ("semi", "anti"):
            if side == "L" and (n > 0) == (self.how == "semi"):
                yield self._out(op, key, "L", row)
        elif n == 0 and self.padded[side]:
            yield self._out(op, key, side, row)
        for m in matching:
            entry = held[o][m]
            first, last = op == "+" and entry[1] == 0, op == "-" and entry[1] == 1  # match of the other row
            entry[1] += step
            touched.add((o, entry[2]))
            for _ in range(entry[0]):
                if self.how in ("semi", "anti"):
                    if side == "R" and (first or last):
                        yield self._out("+" if first == (self.how == "semi") else "-", key, "L", m)
                    continue
                if first and self.padded[o]:
                    yield self._out("-", key, o, m)
                yield self._out(op, key, side, row, m)
                if last and self.padded[o]:
                    yield self._out("+", key, o, m)
        entry = mine.get(row)
        if entry is None:
            sizes[side]["last"] += sizes[side][sizes[side]["last"]] >= CHUNK
            chunk = sizes[side]["last"]
            sizes[side][chunk] += 1
            entry = mine[row] = [0, n, chunk]
        entry[0] += step
        if not entry[0]:
            del mine[row]
            sizes[side][entry[2]] -= 1
        touched.add((side, entry[2]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # row -> copies, matches, chunk
        held = {s: {row: [copies, matches, c[0]] for c, v in st.iterator() for row, copies, matches in pickle.loads(v[0])} for s, st in self.state.items()}
        sizes = {s: Counter(e[2] for e in rows_of.values()) for s, rows_of in held.items()}
        for n in sizes.values():
            n["last"] = max(n, default=0)
        touched: set = set()
        for r in sorted(rows, key=lambda r: r["_order"]):
            side = r["_side"]
            row = tuple(r[f"_{side}{i}"] for i in range(self.width[side]))
            yield from self._change(key, side, row, r["_op"], held, sizes, touched)
        chunks: dict = {at: [] for at in touched}
        for side, rows_of in held.items():
            for row, (copies, matches, chunk) in rows_of.items():
                if (side, chunk) in chunks:
                    chunks[side, chunk].append((row, copies, matches))
        for (side, chunk), kept in chunks.items():
            if kept:
                self.state[side].updateValue((chunk,), (pickle.dumps(kept),))
            else:
                self.state[side].removeKey((chunk,))

    def close(self) -> None:
        pass


def regular_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", on: Callable | None = None,
                 op: str = "op", order: str = "arrival") -> DataFrame:
    """Changelog of the join of two changelogs, streaming or bounded: op, the keys, the other columns of ``left`` and,
    unless semi or anti, of ``right``.

    Both have the keys, ``op`` (``+`` or ``-``) and ``order``, which puts the rows of a key within a micro-batch in order.
    ``on(left row, right row)`` is a further condition on tuples of the other columns."""
    plain = lambda d: [c for c in d.columns if c not in (*keys, op, order)]
    l_cols, r_cols = plain(left), plain(right)
    l_type, r_type = StructType([left.schema[c] for c in l_cols]), StructType([right.schema[c] for c in r_cols])
    common = [*keys, F.col(op).alias("_op"), F.col(order).cast("long").alias("_order")]
    filled = lambda side, cols: [F.col(c).alias(f"_{side}{i}") for i, c in enumerate(cols)]
    empty = lambda side, kind: [F.lit(None).cast(f.dataType).alias(f"_{side}{i}") for i, f in enumerate(kind.fields)]
    tagged = left.select(*common, F.lit("L").alias("_side"), *filled("L", l_cols), *empty("R", r_type)).unionByName(
        right.select(*common, F.lit("R").alias("_side"), *filled("R", r_cols), *empty("L", l_type)))
    both = [*l_type.fields, *([] if how in ("semi", "anti") else r_type.fields)]
    out = StructType([StructField(op, StringType()), *[left.schema[k] for k in keys], *[StructField(f.name, f.dataType, True) for f in both]])
    processor = RegularJoin(how, [f.name for f in out.fields], l_type, r_type, on)
    return tagged.groupBy(*keys).transformWithState(processor, out, "Append", "None")


def folded(changelog: DataFrame, op: str = "op") -> DataFrame:
    """The rows that a changelog leaves, each as often as it is there."""
    cols = [c for c in changelog.columns if c != op]
    copies = changelog.groupBy(*cols).agg(F.sum(F.when(F.col(op) == "+", 1).otherwise(-1)).alias("_copies")).filter("_copies > 0")
    return copies.select(*cols, F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy")).drop("_copy")
