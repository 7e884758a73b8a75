"""Line dedup by content-defined chunks of lines.  SQL functions only.

Each line is hashed; a rolling hash over the last ``WINDOW`` line hashes ends a chunk where it is
divisible by ``DIVISOR``, so chunks depend on nearby lines alone and an
inserted line shifts no later boundary.  Chunks of two lines or more, not blank, whose digest occurs more
than once in the corpus are compared byte by byte (grouped by their whole text): the one of the smallest
(doc_id, line) stays, the others are removed.

A document's chunks travel as numbers (first line, lines); texts move only for the byte comparison of
repeated digests and to rebuild the documents.

Chunks sample the repeats: a passage is found only as far as it fills chunks.  :func:`dedup_whole` finds every
repeat of two lines.  Its units are two lines that follow each other, blank lines between them aside, and a line
with the blank line before or behind it.  Units are grouped by 128 bits; that of the smallest (doc_id, hash of the text, line) stays,
the lines of the others go.  So a copied passage of two lines or more goes whole, wherever it starts, and each
line that isn't blank stays in at least one place.  Where only blank lines would be left, the text is empty.
The pipeline has it take out the repeated chunks as well, found and compared as above, in the same order of places.

Edge cases: null texts stay null and empty ones empty, with no removed lines; null ids rank first; rows equal in
id and text are one document and keep or lose the same chunks; a document whose
chunks are all removed keeps an empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import let, quoted, written

WINDOW, MULTIPLIER, DIVISOR = 2, 31, 3
LEAST_LINES = 2
_SHIFT = 31


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hash(line: Column) -> Column:
    """32 bits of the line's md5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def chunk_codes(lines: Column) -> Column:
    """Every chunk as first line (from 1) * 2^31 + lines."""
    def ends(hashes: Column, n: Column) -> Column:
        rolling = lambda i: sum((F.coalesce(F.get(hashes, i - 1 - k), F.lit(0).cast("long")) * MULTIPLIER**k for k in range(1, WINDOW)), F.get(hashes, i - 1))
        return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (rolling(i) % DIVISOR == 0))

    def codes(e: Column) -> Column:
        starts = F.concat(F.array(F.lit(1)), F.transform(F.slice(e, F.lit(1), F.size(e) - 1), lambda x: x + 1))
        return F.zip_with(starts, e, lambda a, b: F.shiftleft(a.cast("long"), _SHIFT) + (b - a + 1))

    return let(F.transform(lines, line_hash), lambda h: let(ends(h, F.size(h)), codes))


def first_line(code: Column) -> Column:
    return F.shiftright(code, _SHIFT).cast("int")


def n_lines(code: Column) -> Column:
    return code.bitwiseAND((1 << _SHIFT) - 1).cast("int")


def chunk_text(lines: Column, code: Column) -> Column:
    return F.array_join(F.slice(lines, first_line(code), n_lines(code)), "\n")


#: Name of the text's hash beside a table's own columns.
HASH = "_text_hash"


def _of_document(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Joins what was found for a document (``id``, ``hash``, ...) to its row or rows; both names go."""
    same = docs["doc_id"].eqNullSafe(found["id"]) & (docs[HASH] == found["hash"])
    return docs.join(found, same, how).drop("id", "hash")


def of_cells(docs: DataFrame, named: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose cell, of ``NAMED``, has an (id, hash) of ``named``: few more than those named, and no text moves for it."""
    cell = lambda *key: F.pmod(F.xxhash64(*key), F.lit(NAMED)).cast("int")
    cells = F.broadcast(named.select(cell("id", "hash").alias("cell")).distinct())
    return docs.join(cells, cell(docs["doc_id"], docs[HASH]) == cells["cell"], "left_semi")


def later_chunks(docs: DataFrame, order: tuple[str, ...] = ("id", "code", "hash"), gone: DataFrame | None = None) -> DataFrame:
    """id, hash and code of the chunks to remove: all places but the first, by ``order``, of each whole text of a chunk.
    ``docs``: doc_id, text, ``HASH``; documents that are ``gone`` (id, hash) count as not there, and only those with suspects move."""
    chunks = let(lines_of(F.col("text")), lambda ls: F.transform(
        F.filter(chunk_codes(ls), lambda c: n_lines(c) >= LEAST_LINES),
        lambda c: let(chunk_text(ls, c), lambda t: F.struct(c.alias("code"), F.xxhash64(t).alias("digest"), F.octet_length(t).alias("bytes"), (F.trim(t) == "").alias("blank")))))
    placed = docs.select(F.col("doc_id").alias("id"), F.col(HASH).alias("hash"), F.explode(chunks).alias("chunk"))
    placed = written(placed.select("id", "hash", "chunk.*").filter("not blank").drop("blank"))
    if gone is not None:
        placed = placed.join(gone, (placed["id"] == gone["id"]) & (placed["hash"] == gone["hash"]), "left_anti")
    # What is joined back is written first: behind an aggregate Spark couldn't split a chunk that stands in very many places.
    repeated = written(placed.groupBy("digest", "bytes").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    suspects = placed.join(repeated, ["digest", "bytes"]).groupBy("id", "hash").agg(F.collect_set("code").alias("codes"))
    if gone is not None:
        suspects = written(suspects)
        docs = of_cells(docs, suspects)
    texts = let(lines_of(F.col("text")), lambda ls: F.transform("codes", lambda c: F.struct(c.alias("code"), chunk_text(ls, c).alias("chunk"))))
    suspect = _of_document(docs, suspects, "inner").select(F.col("doc_id").alias("id"), F.col(HASH).alias("hash"), F.explode(texts).alias("s")).select("id", "hash", "s.*")
    place = F.struct(*order)
    first = written(suspect.groupBy("chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    return suspect.join(first, "chunk").filter(~place.eqNullSafe(F.col("first"))).select("id", "hash", "code")


def removed_chunks(docs: DataFrame) -> DataFrame:
    """id, hash and ``removed``, the codes of the chunks to remove; ``docs``: doc_id, text, ``HASH``."""
    return later_chunks(docs).groupBy("id", "hash").agg(F.collect_set("code").alias("removed"))


def blank(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r")) == ""


def line_units(text: Column) -> Column:
    """Every unit of :func:`dedup_whole` as struct (first, last, key), lines counted from 1."""
    unit = lambda first, last, key: F.struct(first.alias("first"), last.alias("last"), F.unhex(F.md5(key.cast("binary"))).alias("key"))

    def units(ls: Column, filled: Column) -> Column:
        most = F.greatest(F.size(filled) - 1, F.lit(0))
        pairs = F.zip_with(F.slice(filled, F.lit(1), most), F.slice(filled, F.lit(2), most),
                           lambda a, b: unit(a["at"], b["at"], F.concat(a["line"], F.lit("\n"), b["line"])))
        after = F.transform(F.filter(filled, lambda x: blank(F.get(ls, x["at"]))), lambda x: unit(x["at"], x["at"] + 1, F.concat(x["line"], F.lit("\n"))))
        before = F.transform(F.filter(filled, lambda x: (x["at"] > 1) & blank(F.get(ls, x["at"] - 2))), lambda x: unit(x["at"] - 1, x["at"], F.concat(F.lit("\n"), x["line"])))
        return F.concat(pairs, after, before)

    numbered = lambda ls: F.transform(ls, lambda x, i: F.struct((i + 1).alias("at"), x.alias("line")))
    return let(lines_of(text), lambda ls: let(F.filter(numbered(ls), lambda x: ~blank(x["line"])), lambda filled: units(ls, filled)))


def placed_units(docs: DataFrame) -> DataFrame:
    """id, hash, first, last and key of every unit; ``docs``: doc_id, text, ``HASH``."""
    units = docs.select(F.col("doc_id").alias("id"), F.col(HASH).alias("hash"), F.explode(line_units(F.col("text"))).alias("unit"))
    return written(units.select("id", "hash", "unit.*"))


def later_units(units: DataFrame) -> DataFrame:
    """The units whose key an earlier place has, with that place as ``kept``."""
    place = F.struct("id", "hash", "first", "last")
    kept = written(units.groupBy("key").agg(F.min(place).alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    return units.join(kept, "key").filter(~place.eqNullSafe(F.col("kept")))


def removed_lines(units: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """id, hash and ``removed``, the numbers of the lines to remove: of the later units, and of ``chunks`` (id, hash, code)."""
    # A unit that overlaps the one that stays (three equal lines) leaves that one whole.
    same = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("hash") == F.col("kept.hash"))
    first = F.when(same, F.greatest("first", F.when(F.col("first") <= F.col("kept.last"), F.col("kept.last") + 1))).otherwise(F.col("first"))
    lines = later_units(units).select("id", "hash", F.sequence(first, "last").alias("lines"))
    if chunks is not None:
        start = first_line(F.col("code"))
        lines = lines.unionByName(chunks.select("id", "hash", F.sequence(start, start + n_lines(F.col("code")) - 1).alias("lines")))
    return lines.groupBy("id", "hash").agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("removed"))


def shingles(text: Column, size: int) -> Column:
    """Hashes of the distinct shingles of ``size`` words, A-Z lower-cased; one of all words if there are fewer."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.filter(F.split(F.translate(text, upper, upper.lower()), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return let(found, lambda ws: F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(ws) - size, F.lit(0))), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(size)]))))


#: Least share of the units, in percent, that a document and the one that keeps its units have in common before their
#: sets are looked at; cells that name the documents whose sets are needed: a bound on that broadcast, whatever the data.
LEAST_COMMON, NAMED = 20, 1 << 18


def near_copies(docs: DataFrame, units: DataFrame, size: int, percent: int) -> DataFrame:
    """id and hash of the documents whose shingles resemble, by ``percent`` or more, those of a document of smaller
    id that keeps units of theirs, ``LEAST_COMMON`` percent of both documents' or more.  A unit has one such place, so pairs are
    no more than units; they are counted, and the sizes of the sets held against each other, before any set moves."""
    n_units = written(units.groupBy("id", "hash").agg(F.count("*").alias("units")))
    pairs = later_units(units).filter("id is not null and kept.id is not null and id <> kept.id") \
        .groupBy("id", "hash", F.col("kept.id").alias("of"), F.col("kept.hash").alias("of_hash")).agg(F.count("*").alias("common"))
    pairs = written(pairs)
    of_units = n_units.select(F.col("id").alias("of"), F.col("hash").alias("of_hash"), F.col("units").alias("of_units"))
    differ = pairs.filter("hash <> of_hash").join(n_units, ["id", "hash"]).join(of_units, ["of", "of_hash"])
    differ = written(differ.filter(100 * F.col("common") >= LEAST_COMMON * (F.col("units") + F.col("of_units") - F.col("common"))).select("id", "hash", "of", "of_hash"))
    named = differ.select("id", "hash").union(differ.select("of", "of_hash")).distinct()
    sets = _of_document(of_cells(docs, named), named, "inner").select(F.col("doc_id").alias("id"), F.col(HASH).alias("hash"), shingles(F.col("text"), size).alias("set")).dropDuplicates(["id", "hash"])
    sets = written(sets.select("*", F.size("set").alias("n")))
    of = sets.select(F.col("id").alias("of"), F.col("hash").alias("of_hash"), F.col("set").alias("of_set"), F.col("n").alias("of_n"))
    alike = differ.join(of.drop("of_set"), ["of", "of_hash"]).join(sets.drop("set"), ["id", "hash"]) \
        .filter(100 * F.least("n", "of_n") >= percent * F.greatest("n", "of_n")).drop("n", "of_n")
    shared = F.size(F.array_intersect("set", "of_set"))
    near = alike.join(of, ["of", "of_hash"]).join(sets, ["id", "hash"]).filter(100 * shared >= percent * (F.col("n") + F.col("of_n") - shared))
    return written(pairs.filter("hash = of_hash").select("id", "hash").union(near.select("id", "hash")).distinct())


def dedup_whole(df: DataFrame, counts: tuple[str, str] = ("n_lines", "n_removed"), near: tuple[int, int] | None = None, chunks: bool = False) -> DataFrame:
    """As :func:`dedup`, with every repeat of two lines or more taken out, and with ``chunks`` the repeated content-defined chunks too,
    compared byte by byte; both are found in the text as it came, so that what one takes out hides no repeat from the other.

    With ``near`` (words of a shingle, percent) the :func:`near_copies` go first, as whole documents: without the lines they share
    with the first copy they couldn't be told as its copies, and lines that only they have must not count as kept.
    A text moves once: to its document's removed lines, or the mark that all of it goes."""
    others = [c for c in df.columns if c.lower() not in counts]
    docs = df.select(F.struct(*[df[quoted(c)] for c in others]).alias("row"), df["doc_id"], df["text"], F.xxhash64(df["text"]).alias(HASH))
    texts = docs.select("doc_id", "text", HASH)
    units = placed_units(texts)
    gone = near_copies(texts, units, *near) if near else None
    if near:
        units = units.join(gone, (units["id"] == gone["id"]) & (units["hash"] == gone["hash"]), "left_anti")
    found = removed_lines(units, later_chunks(texts, ("id", "hash", "code"), gone) if chunks else None)
    if near:
        found = found.withColumn("whole", F.lit(False)).unionByName(gone.select("id", "hash", F.array().cast("array<int>").alias("removed"), F.lit(True).alias("whole")))
    found = written(found)
    joined = _of_document(docs.drop("text"), found, "left")
    if near:
        joined = joined.filter(~F.coalesce("whole", F.lit(False)))
    text = F.col("row")["text"]
    kept = lambda ls: F.transform(F.array_except(F.sequence(F.lit(1), F.size(ls)), F.col("removed")), lambda i: F.get(ls, i - 1))
    filled = lambda rest: F.when(F.exists(rest, lambda x: ~blank(x)), rest).otherwise(F.array().cast("array<string>"))
    rest = F.when(F.col("removed").isNotNull(), let(lines_of(text), lambda ls: let(kept(ls), filled)))
    joined = joined.select("row", rest.alias("rest"))
    n = F.coalesce(F.size(lines_of(text)), F.lit(0)).cast("long")
    left = F.when(F.col("rest").isNull(), text).otherwise(F.array_join("rest", "\n"))
    return joined.select(*[(left if c == "text" else F.col("row")[c]).alias(c) for c in others], n.alias(counts[0]),
                         F.when(F.col("rest").isNull(), F.lit(0).cast("long")).otherwise(n - F.size("rest")).alias(counts[1]))


def dedup(df: DataFrame, counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """The columns of ``df`` with the repeated chunks taken out of ``text``, and the numbers of lines
    and of removed lines beside them, named as ``counts`` says."""
    others = [c for c in df.columns if c.lower() not in counts]
    docs = df.select(*[df[quoted(c)] for c in others], F.xxhash64(df["text"]).alias(HASH))
    removed = removed_chunks(docs.select("doc_id", "text", HASH)).withColumnRenamed("removed", "_removed")
    joined = _of_document(docs, removed, "left")
    rest = let(lines_of(F.col("text")), lambda ls: F.array_join(F.transform(F.array_except(chunk_codes(ls), F.col("_removed")), lambda c: chunk_text(ls, c)), "\n"))
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(rest)
    lost = F.aggregate("_removed", F.lit(0).cast("long"), lambda a, c: a + n_lines(c))
    return joined.select(*[text.alias(c) if c == "text" else F.col(quoted(c)) for c in others],
                         F.coalesce(F.size(lines_of(F.col("text"))), F.lit(0)).cast("long").alias(counts[0]), F.coalesce(lost, F.lit(0)).cast("long").alias(counts[1]))
