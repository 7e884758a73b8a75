"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every byte triplet of a text is hashed to one of ``BUCKETS`` counters; the
digest writes, for each counter, in which quartile of all counters it lies (2
bits), and a log-scale length.  The difference of two digests adds the quartile steps of
all buckets (three steps weigh more than three single ones) and the length step, and is cut off at
``MOST_DIFFERENCE``; likeness is 1 - difference / MOST_DIFFERENCE.

To compare each document with the next one, rows are cut into slices of
consecutive ids by bounds (approximate quantiles of the ids; the driver sees
one bound and one first id a slice); the first row of each slice is handed to
the slice before it as well, that of the first slice to the last.  A slice is sorted and read once, in batches.

Edge cases: null text counts as empty and has the fingerprint of no triplets;
rows of a null id come first; rows of equal ids follow the order of their
texts; a single row is its own next document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import annotate, as_texts, prepare

BUCKETS = 256
#: By quartile steps 0 to 3, and by a step of the length scale.
STEPS, LENGTH_STEP = np.array([0, 1, 3, 7]), 4
#: Unrelated texts of unlike length differ by about so much; likeness is 0 from there.
MOST_DIFFERENCE = 512
#: Length scale: steps of a tenth of the logarithm to base 2.
LENGTH_SCALE = 10


def bucket_counts(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.zeros(BUCKETS, np.int64)
    h = (a[:-2] << 16 | a[1:-1] << 8 | a[2:]) * np.uint32(0x9E3779B1)
    return np.bincount(h >> np.uint32(24), minlength=BUCKETS)


def digest(data: bytes) -> bytes:
    """``BUCKETS`` / 4 bytes of quartiles and 2 of length."""
    counts = bucket_counts(data)
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    level = (counts[:, None] > quartiles).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = level[:, 0] | level[:, 1] << 2 | level[:, 2] << 4 | level[:, 3] << 6
    return packed.astype(np.uint8).tobytes() + round(LENGTH_SCALE * np.log2(len(data) + 1)).to_bytes(2, "big")


def levels(fingerprint: bytes) -> np.ndarray:
    a = np.frombuffer(fingerprint[:-2], np.uint8)
    return np.stack([a & 3, a >> 2 & 3, a >> 4 & 3, a >> 6], axis=1).ravel().astype(np.int64)


def difference(a: bytes, b: bytes) -> int:
    """Between 0 and ``MOST_DIFFERENCE``."""
    length = abs(int.from_bytes(a[-2:], "big") - int.from_bytes(b[-2:], "big"))
    return int(min(MOST_DIFFERENCE, STEPS[np.abs(levels(a) - levels(b))].sum() + LENGTH_STEP * max(0, length - 1)))


def likeness(a: bytes, b: bytes) -> float:
    return 1 - difference(a, b) / MOST_DIFFERENCE


def _digests(column: pa.Array) -> list[pa.Array]:
    return [pa.array([digest(t or b"").hex() for t in as_texts(column)])]


def fingerprint(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``fingerprint``, the hexadecimal digest of the text."""
    return annotate(df, text, _digests, [T.StructField("fingerprint", T.StringType())], keep)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _pair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, last of slice, halo, doc_id, text), sorted by slice: each row and the next one of its slice."""
    held = None
    for batch in batches:
        rows = []
        for part, halo, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = text or ""
            data = text.encode("utf-8", "replace")
            row = (part, doc_id, text, data, digest(data))
            if held is not None and held[0] == part:
                changed = edited(held[2], text).encode("utf-8", "replace")
                print_ = digest(changed) if changed != held[3] else held[4]
                rows.append((held[1], len(held[2]), hashlib.sha256(changed).hexdigest(), held[4].hex(), print_.hex(),
                             likeness(held[4], print_), likeness(held[4], row[4])))
            held = None if halo else row
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, _PAIR_TYPES)], names=_PAIR_NAMES)


_PAIR_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_PAIR_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def compare_with_next(df: DataFrame, slices: int | None = None) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  ``slices`` (one per shuffle partition) is the
    number of sorted runs; it doesn't change the result.  An id is taken to
    be held by few rows: rows of one id stand in one slice."""
    spark = df.sparkSession
    prepare(spark)
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sliced = _sliced(docs, slices)
    # One row a slice: where the first row of each slice goes as the next document of the slice before.
    # The least struct: rows of a null id come first, and a minimum of ids would pass over them.
    firsts = sliced.groupBy("part").agg(F.min(F.struct("doc_id")).alias("row")).select("part", F.col("row.doc_id").alias("first"))
    order = sorted(firsts.collect(), key=lambda r: r["part"])
    halo = [(r["part"], r["first"], order[i - 1]["part"]) for i, r in enumerate(order)]
    firsts = spark.createDataFrame(halo, "part int, first long, before int")
    own = F.array(F.struct("part", F.lit(False).alias("halo")))
    placed = sliced.join(F.broadcast(firsts), "part").withColumn(
        "place", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.concat(own, F.array(F.struct(F.col("before").alias("part"), F.lit(True).alias("halo"))))).otherwise(own)))
    runs = placed.select("place.part", "place.halo", "doc_id", "text").repartitionById(slices, F.col("part")) \
        .sortWithinPartitions("part", "halo", "doc_id", "text")
    out = ", ".join(f"{n} {'long' if t == pa.int64() else 'double' if t == pa.float64() else 'string'}" for n, t in zip(_PAIR_NAMES, _PAIR_TYPES))
    return runs.mapInArrow(_pair, out)


def _sliced(docs: DataFrame, slices: int) -> DataFrame:
    """Adds ``part`` (0 to slices - 1), which rises with the id; null ids have 0."""
    from pyspark.ml.feature import Bucketizer

    steps = [k / slices for k in range(1, slices)]
    bounds = docs.select(F.percentile_approx("doc_id", steps, 10 * slices)).first()[0] if steps else None
    bounds = sorted({float(b) for b in bounds or []})
    if not bounds:
        return docs.withColumn("part", F.lit(0))
    cut = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="_id", outputCol="_part", handleInvalid="keep")
    cut = cut.transform(docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf")))))
    return cut.select("doc_id", "text", F.col("_part").cast("int").alias("part"))
