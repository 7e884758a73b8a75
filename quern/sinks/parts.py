"""SNK-13/15: part files that roll, and become visible only by a commit (Python Data Source API).

A task of a micro-batch writes each bucket's rows to a part below ``_pending``, Arrow batch by Arrow batch.  The part is closed,
and the next one begun, when it reaches ``maxRows`` or ``maxBytes``, has been open for ``rolloverSeconds``, or has had no row for
``inactivitySeconds``; at the latest the batch's end closes it (a micro-batch is one transaction).  The closed parts travel to the
driver as commit messages:

* commit: the list of parts is first written under ``_committed/<batch id>`` in one rename, which decides the transaction; then
  the parts move to ``<bucket column>=<value>/part-<batch id>-<task>-<number>``, where Spark's readers find them.  Run again
  for the same batch, the first list stands: its moves are completed and the new attempt's parts go.
* abort: the attempt's parts go.  What a lost task or driver left below ``_pending`` goes with the first commit that
  comes ``timeoutSeconds`` after it was last written to.  The lists of committed batches stay: they make a repeat harmless.

Readers see whole parts of decided batches alone: Spark ignores names that begin with an underscore.  A folder belongs to one
query and its checkpoint, since batches are known by their ids.

Options: ``path``, ``format`` (``parquet`` or ``csv``), ``bucket`` (a column, left out of the files and kept in the folder name; none:
no folders), ``maxRows``, ``maxBytes``, ``rolloverSeconds``, ``inactivitySeconds``, ``timeoutSeconds``, ``maxOpen`` (open parts a task; the
one longest without a row is closed for another).  Files are reached by ``pyarrow.fs``: local or mounted paths and
the URIs it knows.  A part may exceed ``maxBytes`` by one slice of 1,024 rows, and times are looked at when rows come."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

SLICE = 1_024
ESCAPED = r"""[\x00-\x1F"#%'*/:=?\\\x7F{\[\]^]"""  # written as %XX in folder names by Spark's rule (fixed values)
NULL_BUCKET = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder of a null value (fixed value)
DEFAULTS = {"format": "parquet", "maxrows": "1000000", "maxbytes": str(128 << 20), "rolloverseconds": "60",
            "inactivityseconds": "60", "timeoutseconds": "3600", "maxopen": "100"}


@dataclass
class Parts(WriterCommitMessage):
    """What a task wrote: (pending file, folder, name) of each part, the name without the batch id; a commit adds it."""
    parts: list = field(default_factory=list)


class _Open:
    def __init__(self, fs, pending, folder, number, schema, fmt, now):
        self.pending, self.folder, self.number = pending, folder, number
        self.rows, self.opened, self.last = 0, now, now
        self.out = fs.open_output_stream(pending)
        if fmt == "parquet":
            import pyarrow.parquet as pq
            self.writer = pq.ParquetWriter(self.out, schema)
        else:
            from pyarrow import csv
            self.writer = csv.CSVWriter(self.out, schema)

    def write(self, table, now):
        self.writer.write_table(table)
        self.rows, self.last = self.rows + table.num_rows, now

    def close(self):
        self.writer.close()
        self.out.close()


class PartWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict, clock=time.time):
        o = {**DEFAULTS, **{k.lower(): v for k, v in options.items()}}
        if o["format"] not in ("parquet", "csv"):
            raise ValueError(f"parts are parquet or csv, not {o['format']}")
        self.path, self.fmt, self.bucket = o["path"].rstrip("/"), o["format"], o.get("bucket")
        self.max_rows, self.max_bytes, self.max_open = int(o["maxrows"]), int(o["maxbytes"]), int(o["maxopen"])
        if min(self.max_rows, self.max_bytes, self.max_open) < 1:
            raise ValueError("maxRows, maxBytes and maxOpen must be 1 or more")
        self.rollover, self.inactivity = float(o["rolloverseconds"]), float(o["inactivityseconds"])
        self.timeout, self.clock = float(o["timeoutseconds"]), clock

    def _fs(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.path)

    # --- tasks -------------------------------------------------------------------

    def write(self, iterator) -> Parts:
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        fs, root = self._fs()
        fs.create_dir(f"{root}/_pending", recursive=True)
        done, live, number = Parts(), {}, 0

        def close(folder):
            part = live.pop(folder)
            part.close()
            done.parts.append((part.pending, folder, f"{task:06d}-{part.number:06d}.{self.fmt}"))

        for batch in iterator:
            for folder, rows in self._buckets(pa.Table.from_batches([batch])):
                start = 0
                while start < rows.num_rows:
                    now = self.clock()
                    for other in [f for f, p in live.items() if now - p.opened >= self.rollover or now - p.last >= self.inactivity]:
                        close(other)
                    if folder not in live:
                        if len(live) >= self.max_open:
                            close(min(live, key=lambda f: live[f].last))
                        live[folder] = _Open(fs, f"{root}/_pending/{uuid.uuid4().hex}", folder, number, rows.schema, self.fmt, now)
                        number += 1
                    part = live[folder]
                    piece = rows.slice(start, min(SLICE, self.max_rows - part.rows))
                    part.write(piece, now)
                    start += piece.num_rows
                    if part.rows >= self.max_rows or part.out.tell() >= self.max_bytes:
                        close(folder)
        for folder in list(live):
            close(folder)
        return done

    def _buckets(self, table):
        """(folder, its rows) of a batch; a folder of the empty name stands for the root."""
        if not self.bucket:
            return [("", table)]
        import re

        import pyarrow.compute as pc
        keys = table.column(self.bucket).cast("string").combine_chunks().dictionary_encode(null_encoding="encode")
        rest = table.drop_columns([self.bucket])
        names = [re.sub(ESCAPED, lambda m: f"%{ord(m[0]):02X}", v) if v else NULL_BUCKET for v in keys.dictionary.to_pylist()]
        return [(f"{self.bucket}={v}", rest.filter(pc.equal(keys.indices, i))) for i, v in enumerate(names)]

    # --- driver ------------------------------------------------------------------

    def commit(self, messages, batchId: int) -> None:
        import json
        fs, root = self._fs()
        parts = [p for m in messages if m is not None for p in m.parts]
        final = f"{root}/_committed/{batchId:020d}"
        if self._is_file(fs, final):
            with fs.open_input_stream(final) as f:
                decided = [tuple(p) for p in json.loads(f.read())]
            self._remove(fs, [p[0] for p in parts if p not in decided])
        else:
            decided = parts
            fs.create_dir(f"{root}/_committed", recursive=True)
            with fs.open_output_stream(f"{final}.tmp") as f:
                f.write(json.dumps(decided).encode())
            fs.move(f"{final}.tmp", final)
        for pending, folder, name in decided:
            to = f"{root}/{folder}" if folder else root
            if self._is_file(fs, pending):
                fs.create_dir(to, recursive=True)
                fs.move(pending, f"{to}/part-{batchId:020d}-{name}")
        self._recover(fs, root)

    def abort(self, messages, batchId: int) -> None:
        """Of a batch that was decided before, nothing of the first attempt goes: its parts have other names."""
        fs, _ = self._fs()
        self._remove(fs, [p[0] for m in messages if m is not None for p in m.parts])

    def _recover(self, fs, root) -> None:
        from pyarrow.fs import FileSelector
        old = self.clock() - self.timeout
        found = fs.get_file_info(FileSelector(f"{root}/_pending", allow_not_found=True))
        self._remove(fs, [f.path for f in found if f.mtime is not None and f.mtime.timestamp() < old])

    @staticmethod
    def _is_file(fs, path) -> bool:
        from pyarrow.fs import FileType
        return fs.get_file_info(path).type == FileType.File

    def _remove(self, fs, paths) -> None:
        for p in paths:
            if self._is_file(fs, p):
                fs.delete_file(p)


class PartFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quern_parts"

    def streamWriter(self, schema, overwrite):
        return PartWriter(dict(self.options))


def register(spark) -> None:
    from quern.session import ship_package
    ship_package(spark)
    spark.dataSource.register(PartFiles)
