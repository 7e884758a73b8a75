"""Scalar functions whose reference semantics differ from Spark's built-ins.

All of them are compositions of JVM-side expressions (no Python UDFs), so
they stay inside whole-stage code generation.  Where the reference rule had
to be chosen, the rule is written next to the function.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = "str | Column"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates (PRD) ---------------------------------------------------------

def is_true(b) -> Column:
    """IS TRUE: never null."""
    return _c(b).eqNullSafe(F.lit(True))


def is_false(b) -> Column:
    return _c(b).eqNullSafe(F.lit(False))


def is_not_true(b) -> Column:
    return ~is_true(b)


def is_not_false(b) -> Column:
    return ~is_false(b)


def is_unknown(b) -> Column:
    return _c(b).isNull()


def between_symmetric(x, a, b) -> Column:
    """BETWEEN SYMMETRIC: the bounds may come in either order."""
    a, b = _c(a), _c(b)
    return _c(x).between(F.least(a, b), F.greatest(a, b))


def overlaps(s1, e1, s2, e2) -> Column:
    """(s1, e1) OVERLAPS (s2, e2) with inclusive ends; each period is first
    put in order, as the SQL standard asks."""
    a1, b1 = F.least(_c(s1), _c(e1)), F.greatest(_c(s1), _c(e1))
    a2, b2 = F.least(_c(s2), _c(e2)), F.greatest(_c(s2), _c(e2))
    return (a1 <= b2) & (a2 <= b1)


_SIMILAR_META = set(".^$\\")


def similar_to_regex(pattern: str, escape: str | None = None) -> str:
    """Translate a SQL ``SIMILAR TO`` pattern into an anchored Java regex.

    ``%`` -> ``.*``, ``_`` -> ``.``; ``| * + ? {m,n} ( ) [ ]`` keep their
    regex meaning; ``.``, ``^``, ``$`` and ``\\`` are literals.
    """
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if escape and ch == escape and i + 1 < len(pattern):
            out.append(re.escape(pattern[i + 1]))
            i += 2
            continue
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch in _SIMILAR_META:
            out.append("\\" + ch)
        else:
            out.append(ch)
        i += 1
    return "^(?:" + "".join(out) + ")$"


def similar_to(s, pattern: str, escape: str | None = None) -> Column:
    # ``%`` and ``_`` match line breaks too, and nothing may follow the match
    return _c(s).rlike("(?s)" + similar_to_regex(pattern, escape).removesuffix("$") + r"\z")


# IS_DECIMAL / IS_DIGIT / IS_ALPHA (fixed rules: non-empty, whole string)
DECIMAL_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DIGIT_PATTERN = r"^[0-9]+$"
ALPHA_PATTERN = r"^\p{L}+$"


def is_decimal(s) -> Column:
    return F.coalesce(_c(s).rlike(DECIMAL_PATTERN), F.lit(False))


def is_digit(s) -> Column:
    return F.coalesce(_c(s).rlike(DIGIT_PATTERN), F.lit(False))


def is_alpha(s) -> Column:
    return F.coalesce(_c(s).rlike(ALPHA_PATTERN), F.lit(False))


# --- math (MTH) ------------------------------------------------------------------

def int_divide(a, b) -> Column:
    """``/`` on two integers keeps the integer type: truncating quotient."""
    a, b = _c(a).cast("long"), _c(b).cast("long")
    # Whole numbers throughout: a double would round above 2^53.
    return F.call_function("div", a, b)


def truncate(x, d: int = 0) -> Column:
    """TRUNCATE(x, d): toward zero at ``d`` decimal places (exact on decimals)."""
    x = _c(x)
    return F.when(x >= 0, F.floor(x, d)).otherwise(F.ceil(x, d))


def rand_integer(n: int, seed: int | None = None) -> Column:
    """RAND_INTEGER([seed,] n): 0 <= v < n."""
    r = F.rand(seed) if seed is not None else F.rand()
    return F.floor(r * F.lit(n)).cast("int")


def hash_code(s) -> Column:
    """HASH_CODE of a string: the Java ``String.hashCode`` (31-polynomial over
    the characters, 32-bit signed wrap)."""
    # 16-bit units, as two bytes each
    units = F.encode(_c(s).cast("string"), "UTF-16BE")
    hexed = F.hex(units)
    codes = F.transform(F.sequence(F.lit(0), F.greatest(F.length(hexed) / 4 - 1, F.lit(0)).cast("int")),
                        lambda i: F.conv(F.substring(hexed, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    h = F.aggregate(codes, F.lit(0).cast("long"),
                    lambda acc, x: (acc * 31 + x) % F.lit(4294967296))
    h = F.when(_c(s) == "", F.lit(0).cast("long")).otherwise(h)
    return F.when(h >= 2147483648, h - 4294967296).otherwise(h).cast("int")


# --- strings (STR-F) -------------------------------------------------------------------

def initcap(s) -> Column:
    """INITCAP: every run of letters / digits is a word (not only spaces):
    first character upper case, the rest lower case."""
    toks = F.regexp_extract_all(_c(s), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), 1)
    cap = F.transform(toks, lambda t: F.when(
        t.rlike(r"^[\p{L}\p{N}]"),
        F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30))))
        .otherwise(t))
    return F.array_join(cap, "")


def split_index(s, delim: str, index: int) -> Column:
    """SPLIT_INDEX(s, delim, i): 0-based piece, null when out of range; the
    delimiter is literal text, empty pieces are kept."""
    return F.get(F.split(_c(s), re.escape(delim), -1), index)


def regexp_extract_or_null(s, pattern: str, group: int = 0) -> Column:
    """REGEXP_EXTRACT: null (not empty text) when the pattern does not match."""
    return F.when(_c(s).rlike(pattern), F.regexp_extract(_c(s), pattern, group))


def locate(sub: str, s, pos: int = 1) -> Column:
    return F.locate(sub, _c(s), pos)


def instr(s, sub: str, start: int = 1, occurrence: int = 1) -> Column:
    """INSTR(s, sub [, start [, occurrence]]): 1-based position of the n-th
    occurrence at or after ``start``; 0 when absent."""
    body = F.substring(_c(s), start, 1 << 30) if start > 1 else _c(s)
    n_occ = F.size(F.split(body, re.escape(sub), -1)) - 1
    head = F.substring_index(body, sub, occurrence)
    return F.when(n_occ >= occurrence, F.length(head) + 1 + (start - 1)).otherwise(F.lit(0))


def overlay(s, replacement: str, pos: int, length: int | None = None) -> Column:
    if length is None:
        return F.overlay(_c(s), F.lit(replacement), F.lit(pos))
    return F.overlay(_c(s), F.lit(replacement), F.lit(pos), F.lit(length))


def str_to_map(s, pair_delim: str = ",", kv_delim: str = "=") -> Column:
    """STR_TO_MAP(s [, d1, d2]): delimiters are literal text; default ``,``
    and ``=``; the last value of a repeated key wins."""
    pairs = F.split(_c(s), re.escape(pair_delim), -1)
    entries = F.transform(pairs, lambda p: F.struct(
        F.get(F.split(p, re.escape(kv_delim), 2), 0).alias("k"),
        F.get(F.split(p, re.escape(kv_delim), 2), 1).alias("v")))
    keys = F.transform(entries, lambda e: e["k"])
    # keep the last occurrence of every key
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, 1 << 30), e["k"]))
    return F.map_from_entries(last)


URL_PARTS = ("HOST", "PATH", "QUERY", "REF", "PROTOCOL", "FILE", "AUTHORITY", "USERINFO")


def parse_url(url, part: str, key: str | None = None) -> Column:
    """PARSE_URL(url, part [, key]); null for a malformed URL or absent part."""
    part = part.upper()
    if part not in URL_PARTS:
        raise ValueError(f"unknown URL part {part}")
    if key is not None:
        return F.try_parse_url(_c(url), F.lit(part), F.lit(key))
    return F.try_parse_url(_c(url), F.lit(part))


# --- date / time (DTM) ---------------------------------------------------------

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(ts) -> Column:
    """EXTRACT(EPOCH FROM ts) for a zone-less timestamp, whole seconds."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), _c(ts).cast("timestamp_ntz"))


def extract(unit: str, ts) -> Column:
    """EXTRACT(unit FROM ts) with the reference's unit set; DOW is 1 = Sunday,
    WEEK is the ISO week, SECOND the whole second."""
    u = unit.upper()
    t = _c(ts)
    y = F.year(t)
    simple = {"YEAR": F.year, "QUARTER": F.quarter, "MONTH": F.month,
              "WEEK": F.weekofyear, "DAY": F.dayofmonth, "DOW": F.dayofweek,
              "DOY": F.dayofyear, "HOUR": F.hour, "MINUTE": F.minute,
              "SECOND": F.second}
    if u in simple:
        return simple[u](t).cast("long")
    if u == "EPOCH":
        return epoch_seconds(t)
    if u == "DECADE":
        return F.floor(y / 10).cast("long")
    if u == "CENTURY":
        return F.when(y > 0, F.floor((y + 99) / 100)).otherwise(F.ceil((y - 99) / 100)).cast("long")
    if u == "MILLENNIUM":
        return F.when(y > 0, F.floor((y + 999) / 1000)).otherwise(F.ceil((y - 999) / 1000)).cast("long")
    raise ValueError(f"unsupported unit {unit}")


def floor_to(ts, unit: str) -> Column:
    """FLOOR(ts TO unit), keeping the input's (zone-less) type."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def ceil_to(ts, unit: str) -> Column:
    """CEIL(ts TO unit): the next unit boundary unless already on one."""
    fl = floor_to(ts, unit)
    return F.when(fl == _c(ts), fl).otherwise(F.timestamp_add(unit.upper(), F.lit(1), fl))


def to_date_or_null(s, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(s), fmt)


def to_timestamp_or_null(s, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """TO_TIMESTAMP(s [, fmt]): zone-less result, null when not parseable."""
    return F.try_to_timestamp(_c(s), F.lit(fmt)).cast("timestamp_ntz")


def convert_tz(s, from_tz: str, to_tz: str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """CONVERT_TZ(text, z1, z2) -> text."""
    ts = F.try_to_timestamp(_c(s), F.lit(fmt)).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(F.lit(from_tz), F.lit(to_tz), ts), fmt)


# --- collections (COL) -------------------------------------------------------------

def element(arr) -> Column:
    """ELEMENT(a): the sole element, null for an empty array, error for more."""
    a = _c(arr)
    return F.when(F.size(a) <= 1, F.get(a, 0)).otherwise(
        F.raise_error(F.lit("ELEMENT: more than one element")))


def multiset(*cols) -> Column:
    """MULTISET[...] as a map value -> multiplicity."""
    arr = F.array(*[_c(c) for c in cols])
    keys = F.array_distinct(arr)
    return F.map_from_arrays(keys, F.transform(
        keys, lambda k: F.size(F.filter(arr, lambda x: x == k))))


def single_value(c) -> Column:
    """SINGLE_VALUE aggregate: error on a second row."""
    return F.when(F.count(F.lit(1)) <= 1, F.first(_c(c))).otherwise(
        F.raise_error(F.lit("SINGLE_VALUE: more than one row")))
