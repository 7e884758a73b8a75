"""SRC-10 custom source: a table replayed as a stream (Python Data Source API).

``quern_replay`` serves the rows of a parquet table in file order, a fixed
number of rows per micro-batch (more where ``mostBatches`` would else be passed), so a bounded table behaves like an arriving
stream: the watermark advances between batches and windows close the way
they do on live data.  Each micro-batch is cut into row-range partitions read
by the executors (pyarrow, files and row groups pruned by their offsets: a task opens the files that hold its rows), so no data
passes through the driver.  ``flush=true`` appends one end-of-input row
(``_eoi`` = true, time far in the future) in each of two last batches: it plays the part of
the final watermark of a bounded stream and must be filtered out after the
watermark is assigned (:func:`quern.streaming.runner.drop_flush`).

Options: ``path`` (a parquet file, or a folder of them in order of their names), ``rowsPerBatch`` (default 100000),
``mostBatches`` (a longer table comes in so many micro-batches, each of more rows: every one costs a round of state
stores, files and log entries, whatever its rows; by default no bound), ``partitionRows`` (rows per read task, default 1000000), ``flush``,
``timeColumn`` (required with flush), ``repeat`` (deliver the table n times:
at-least-once replay for de-duplication tests).
"""

from __future__ import annotations

from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader,
                                    InputPartition)
from pyspark.sql.types import BooleanType, StructField, StructType

# Two end-of-input batches: the first moves the watermark to the far future,
# the second runs with it, so every window and timer still open fires.
FLUSH_BATCHES = 2
# Rows that a read task holds at once.
READ_ROWS = 65_536


class _Range(InputPartition):
    """Rows [start, end) of the replay: ``pieces`` are the files that hold them, each with its first and last row (exclusive)."""
    def __init__(self, start: int, end: int, flush: bool = False, pieces: tuple = ()):
        self.start, self.end, self.flush, self.pieces = start, end, flush, pieces


def _files(path: str) -> list[str]:
    """The parquet files of a table: the path itself, or those below it by name."""
    import os
    if not os.path.isdir(path):
        return [path]
    found = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and f[0] not in "._"]
    return sorted(found)


def _ends(files: list[str]) -> list[int]:
    """The number of rows up to the end of each file."""
    from itertools import accumulate

    import pyarrow.parquet as pq
    return list(accumulate(pq.read_metadata(f).num_rows for f in files))


def _pieces(files: list[str], ends: list[int], start: int, end: int) -> tuple:
    """(file, first, last) of the files that hold rows [start, end) of the table (modulo its length for repeated replay)."""
    from bisect import bisect_right
    out, pos = [], start
    while pos < end and ends and ends[-1]:
        at = pos % ends[-1]
        i = bisect_right(ends, at)
        base = ends[i - 1] if i else 0
        last = min(ends[i], at + end - pos)
        out.append((files[i], at - base, last - base))
        pos += last - at
    return tuple(out)


def _read_range(pieces: tuple, schema: StructType):
    """The rows of the pieces as Arrow batches; only these files are opened, and only row groups that overlap are decoded."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import to_arrow_schema
    names = [fld.name for fld in schema.fields if fld.name != "_eoi"]
    out = to_arrow_schema(schema)
    for file, lo, hi in pieces:
        at = 0
        with pq.ParquetFile(file) as opened:
            for g in range(opened.metadata.num_row_groups):
                gn = opened.metadata.row_group(g).num_rows
                if at + gn > lo and at < hi:
                    first, last = max(lo - at, 0), min(hi - at, gn)
                    seen = 0
                    for b in opened.iter_batches(READ_ROWS, row_groups=[g], columns=names):
                        begin, seen = seen, seen + len(b)
                        if begin >= last:
                            break
                        skip = max(first - begin, 0)
                        tbl = pa.Table.from_batches([b]).slice(skip, min(last, seen) - begin - skip) if seen > first else None
                        if not tbl:
                            continue
                        tbl = tbl.append_column("_eoi", pa.array([False] * len(tbl), pa.bool_()))
                        # nanosecond timestamps become microseconds
                        tbl = pa.Table.from_arrays([tbl[x.name].cast(x.type, safe=False) for x in out], schema=out)
                        yield from tbl.combine_chunks().to_batches()
                at += gn


class _Base:
    def __init__(self, schema: StructType, options: dict):
        self.schema = schema
        self.path = options["path"]
        self.rows_per_batch = int(options.get("rowsPerBatch", 100000))
        self.part_rows = int(options.get("partitionRows", 1000000))
        self.flush = str(options.get("flush", "false")).lower() == "true"
        self.time_col = options.get("timeColumn")
        self.files = _files(self.path)
        self.ends = _ends(self.files)
        self.total = (self.ends[-1] if self.ends else 0) * int(options.get("repeat", 1))
        if options.get("mostBatches"):
            self.rows_per_batch = max(self.rows_per_batch, -(-self.total // int(options["mostBatches"])))

    def _parts(self, start: int, end: int):
        parts = []
        s = start
        while s < min(end, self.total):
            e = min(s + self.part_rows, end, self.total)
            parts.append(_Range(s, e, pieces=_pieces(self.files, self.ends, s, e)))
            s = e
        if self.flush:
            for i in range(max(start, self.total), end):
                parts.append(_Range(i, i, flush=True))
        return parts

    def read(self, partition: _Range):
        if partition.flush:
            import datetime
            row = []
            for fld in self.schema.fields:
                if fld.name == "_eoi":
                    row.append(True)
                elif fld.name == self.time_col:
                    row.append(datetime.datetime(2100, 1, 1))
                else:
                    row.append(None)
            yield tuple(row)
            return
        yield from _read_range(partition.pieces, self.schema)


class _BatchReader(_Base, DataSourceReader):
    def partitions(self):
        return self._parts(0, self.total)


class _StreamReader(_Base, DataSourceStreamReader):
    def initialOffset(self):
        return {"row": 0}

    def latestOffset(self):
        # Every call admits the next slice, so the table "arrives" batch by
        # batch; the end-of-input row, if asked for, comes in a batch of its own.
        cur = getattr(self, "_cursor", 0)
        if cur < self.total:
            cur = min(cur + self.rows_per_batch, self.total)
        elif self.flush and cur < self.total + FLUSH_BATCHES:
            cur += 1
        self._cursor = cur
        return {"row": cur}

    def partitions(self, start, end):
        return self._parts(start["row"], end["row"])

    def commit(self, end):
        pass


class ReplaySource(DataSource):
    @classmethod
    def name(cls):
        return "quern_replay"

    def schema(self):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema
        # zone-less parquet timestamps stay zone-less, as spark.read.parquet reads them
        s = from_arrow_schema(pq.read_schema(_files(self.options["path"])[0]), prefer_timestamp_ntz=True)
        # nullable whatever the file says: the end-of-input rows are nulls
        return StructType([StructField(f.name, f.dataType, True) for f in s.fields] + [StructField("_eoi", BooleanType(), True)])

    def reader(self, schema):
        return _BatchReader(schema, self.options)

    def streamReader(self, schema):
        return _StreamReader(schema, self.options)


def register(spark) -> None:
    from quern.session import ship_package
    ship_package(spark)
    spark.dataSource.register(ReplaySource)


def replay(spark, path: str, rows_per_batch: int = 100000, *, flush: bool = False,
           time_column: str | None = None, repeat: int = 1, streaming: bool = True,
           partition_rows: int = 1000000, most_batches: int | None = None):
    register(spark)
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("quern_replay").option("path", path)
         .option("rowsPerBatch", rows_per_batch).option("partitionRows", partition_rows)
         .option("flush", str(flush).lower()).option("repeat", repeat))
    if time_column:
        r = r.option("timeColumn", time_column)
    if most_batches:
        r = r.option("mostBatches", most_batches)
    return r.load()
