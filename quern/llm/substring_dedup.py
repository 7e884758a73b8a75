"""Substring dedup: repeated lines, and repeated sentences within lines.

Every line of a text is a unit, and so is every sentence of a line that has several.  A unit is normalised (A-Z
lower-cased, words joined by one blank, other signs dropped) and hashed to 128 bits; units of fewer
than ``LEAST_WORDS`` words are left alone.  Digests are grouped over the whole corpus; the occurrence of the
smallest (doc_id, start) stays and the others are removed.  Where a line goes, its sentences
aren't listed again.  Spans are code points of the original text.

The grouping keeps one smallest place for each digest before anything moves, so a line that half of
all documents share is a row a task; the join back to the occurrences is one that Spark can split.

Edge cases: null and empty texts have no units; null ids rank first; rows equal in id and text are one
document and keep or lose the same units; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_texts, prepare, text_batches, words, written

LEAST_WORDS = 8
#: A sentence ends at such a sign with white space behind it.
_SENTENCE = re.compile(rb"[.!?]+(?=\s)")
_DDL = "doc_id long, text_hash long, line long, whole boolean, start long, end long, n_words long, digest binary"


def units(text: bytes, least: int) -> Iterator[tuple[int, bool, int, int, int, bytes]]:
    """(line, whether it is a whole line, start, end, words, normalised) of each unit; bytes of the UTF-8 text."""
    at = 0
    for number, line in enumerate(text.split(b"\n")):
        found = words(line)
        if len(found) >= least:
            yield number, True, at, at + len(line), len(found), b" ".join(found)
            cuts = [0, *(m.end() for m in _SENTENCE.finditer(line)), len(line)]
            if len(cuts) > 2:
                for start, end in zip(cuts[:-1], cuts[1:]):
                    part = words(line[start:end])
                    if len(part) >= least:
                        blank = len(line[start:end]) - len(line[start:end].lstrip())
                        yield number, False, at + start + blank, at + end, len(part), b" ".join(part)
        at += len(line) + 1


def _units(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        ids, hashes = batch.column(0), batch.column(2)
        for first, texts in text_batches(as_texts(batch.column(1))):
            rows, starts, ends, digests, meta = [], [], [], [], []
            for i, text in enumerate(texts):
                if not text:
                    continue
                found = list(units(text, least))
                if not found:
                    continue
                # Code points up to a byte: bytes that don't continue one.
                points = np.concatenate([[0], np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)])
                starts.append(points[[u[2] for u in found]])
                ends.append(points[[u[3] for u in found]])
                digests += [xxhash.xxh3_128_digest(u[5]) for u in found]
                meta += [(u[0], u[1], u[4]) for u in found]
                rows += [first + i] * len(found)
            if not rows:
                continue
            line, whole, n = zip(*meta)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([
                ids.take(take), hashes.take(take), pa.array(line, pa.int64()), pa.array(whole, pa.bool_()), pa.array(np.concatenate(starts), pa.int64()),
                pa.array(np.concatenate(ends), pa.int64()), pa.array(n, pa.int64()), pa.array(digests, pa.binary())],
                names=["doc_id", "text_hash", "line", "whole", "start", "end", "n_words", "digest"])


def all_units(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """One row a unit: doc_id, text_hash, line, whole, start, end, n_words, digest."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash"))

    def cut(batches):
        return _units(batches, least)

    return texts.mapInArrow(cut, _DDL)


def repeated(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """One row for each unit to remove: doc_id, text_hash, start, end, n_words, whole, kept_doc_id and kept_start (the occurrence that stays)."""
    found = all_units(docs, least)
    place = F.struct("doc_id", "start", "text_hash")
    # Written, so that both sides of the join are scans behind a plain shuffle: only then can Spark split a digest that stands in very many places.
    kept = written(found.groupBy("digest").agg(F.min(place).alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    again = found.join(kept, "digest").filter(~place.eqNullSafe(F.col("kept")))
    # Lines that go, once more as a filter for their own sentences: a line's units are few.
    lines = again.groupBy("doc_id", "text_hash", "line").agg(F.max("whole").alias("gone"), F.collect_set(F.struct("whole", "start", "end", "n_words", "kept")).alias("units"))
    listed = lines.select("doc_id", "text_hash", F.explode(F.filter("units", lambda u: u["whole"] | ~F.col("gone"))).alias("u"))
    return listed.select("doc_id", "text_hash", "u.start", "u.end", "u.n_words", "u.whole", F.col("u.kept.doc_id").alias("kept_doc_id"), F.col("u.kept.start").alias("kept_start"))


def remove(df: DataFrame, spans: DataFrame) -> DataFrame:
    """``df`` with the spans of :func:`repeated` cut out of ``text``."""
    hashed = df.withColumn("_text_hash", F.xxhash64("text"))
    of = spans.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    joined = hashed.join(of, hashed["doc_id"].eqNullSafe(of["_id"]) & (hashed["_text_hash"] == of["_hash"]), "left")
    # The kept parts lie between the spans, which don't overlap.
    bounds = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))), F.col("_spans"))
    parts = F.zip_with(bounds, F.col("_spans"), lambda a, b: F.substring(F.col("text"), (a["end"] + 1).cast("int"), F.coalesce(b["start"] - a["end"], F.lit(2**31 - 1)).cast("int")))
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(F.array_join(parts, ""))).select(*df.columns)
