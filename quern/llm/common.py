"""Helpers shared by the training-data operators.

Row-wise operators that need Python go through :func:`annotate`: Spark hands
each task Arrow batches (bounded in bytes by
``spark.sql.execution.arrow.maxBytesPerBatch``), the operator's function adds
columns, and the row itself travels through untouched as one struct column.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import scratch_path, ship_package

#: Bytes of an Arrow batch, and of the rows that a function works on at once.  Spark's own bound (64 MB) is meant for
#: narrow rows; a batch of texts is held several times on its way (Spark's and Python's copy, words, ids).
BATCH_BYTES = SLICE_BYTES = 8 << 20

# What a batch function gets: the texts as UTF-8 bytes, null as None.
Texts = list[bytes | None]

#: A-Z lower-cased; ASCII letters, digits and all bytes from 0x80 kept; the rest is a space.
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b if b >= 0x80 or chr(b).isalnum() else 32) for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text after A-Z is lower-cased.

    The excluded set is ASCII, so it works on UTF-8 bytes as on code points."""
    return text.translate(_FOLD).split()


def text_batches(texts: Texts, most_bytes: int = 8 << 20) -> Iterator[tuple[int, Texts]]:
    """Consecutive slices ``(start, texts)`` of at most ``most_bytes`` (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or b"")
        if i > start and size + n > most_bytes:
            yield start, texts[start:i]
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, texts[start:]


def as_texts(col: pa.Array) -> Texts:
    return col.cast(pa.binary()).to_pylist()


def prepare(spark: SparkSession) -> None:
    """What the operators' Python workers need: the package, and Arrow batches of ``BATCH_BYTES`` at most."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().removesuffix("b")
    if not now.lstrip("-").isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def trim() -> None:
    """Gives freed memory back: workers live on between tasks, beside those of other operators."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:
        pass  # another C library


def trimmed(batches: Iterable, forget: Callable[[], None] | None = None) -> Iterator:
    """The same batches; memory is given back now and then and, with what ``forget`` drops, at the task's end."""
    try:
        for i, batch in enumerate(batches):
            yield batch
            del batch
            if i % 4 == 3:
                trim()
    finally:
        if forget:
            forget()
        trim()


def _annotated(batches: Iterable[pa.RecordBatch], fn, column: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    return trimmed(_slices(batches, fn, column, names), getattr(fn, "forget", None))


def _slices(batches: Iterable[pa.RecordBatch], fn, column: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            row = batch.column(0).slice(start, step)
            yield pa.RecordBatch.from_arrays([row, *fn(pc.struct_field(row, column))], names=["row", *names])


def annotate(df: DataFrame, column: str, fn: Callable[[pa.Array], list[pa.Array]],
             fields: list[T.StructField], keep: list[str] | None = None) -> DataFrame:
    """``df``'s columns (or ``keep`` of them) and ``fields`` made by ``fn`` from ``column``.

    ``fn`` gets the column as an Arrow array and returns one array per field.
    A column of ``df`` that bears a field's name is replaced by the field."""
    prepare(df.sparkSession)
    made = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    inside = [*kept, *([] if column in kept else [column])]
    packed = df.select(F.struct(*[df[quoted(c)] for c in inside]).alias("row"))
    out = T.StructType([packed.schema["row"], *fields])
    done = packed.mapInArrow(partial(_annotated, fn=fn, column=column, names=[f.name for f in fields]), out)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col(f.name) for f in fields])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def crc_bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once a row.  A column used inside a lambda function would be
    computed for every element; a lambda's own variable isn't."""
    return F.transform(F.array(value), then)[0]


def running_sums(sizes: Column, block: int = 512) -> Column:
    """For each element of an array of longs, the sum of those before it.

    A fold copies its list for each element it appends, so blocks are summed alone and then moved by the sums of
    the blocks before: n * block + (n / block)^2 steps rather than n^2."""

    def fold(array: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("sums"))
        step = lambda a, x: F.struct((a["total"] + x).alias("total"), F.concat(a["sums"], F.array(a["total"])).alias("sums"))
        return F.aggregate(array, start, step, lambda a: a["sums"])

    total = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)
    whole = lambda a: let(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / block).cast("int")), lambda b: F.slice(a, b * block + 1, block)),
        lambda parts: F.flatten(F.zip_with(parts, fold(F.transform(parts, total)), lambda part, at: F.transform(fold(part), lambda x: x + at))))
    return let(sizes, lambda a: F.when(F.size(a) > block, whole(a)).otherwise(fold(a)))


def written(df: DataFrame, rows: int | None = None, each: int = 250_000) -> DataFrame:
    """``df`` written as a table below the shared checkpoint folder and read back: it is
    computed once, outlives lost executors, and later reads take only the columns they need.

    Where a bound on its ``rows`` is known, the last step runs in tasks of ``each`` rows
    (four at least) rather than in many small ones with a file each."""
    path = scratch_path(df.sparkSession, "llm")
    (df if rows is None else df.coalesce(max(4, -(-rows // each)))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.sources.tables import read_table

    return read_table(spark, sf_dir, "documents")
