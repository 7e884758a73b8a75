"""Licence scan: Aho-Corasick finds identifier tags and notice phrases, and a
shunting-yard parser evaluates the and/or/with expressions behind the tags.

A text is folded to its words joined by single blanks, so one automaton over
the folded text finds every phrase at word boundaries in one pass whatever
punctuation and case stand between the words.  Behind each identifier tag the
raw text is parsed as a licence expression.

Edge cases: a null or empty text has no words, hits or expressions and score
0; a broken expression gives the label ``spdx-invalid``; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import annotate, as_texts, words

#: Phrases of the contract and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notice phrases of our own: words -> (label, weight as evidence of a notice).
NOTICES = {
    "licensed under the": ("notice", 0.5),
    "this work is licensed under": ("notice", 0.7),
    "released under the": ("notice", 0.5),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "bsd license": ("bsd", 0.7),
    "3 clause bsd": ("bsd", 0.7),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl", 0.8),
    "eclipse public license": ("epl", 0.8),
    "isc license": ("isc", 0.7),
    "the unlicense": ("unlicense", 0.7),
    "creative commons": ("cc", 0.6),
    "cc by sa": ("cc-by-sa", 0.7),
    "cc by nc": ("cc-by-nc", 0.7),
    "cc by nd": ("cc-by-nd", 0.7),
    "cc0": ("cc0", 0.5),
    "public domain": ("public-domain", 0.4),
    "all rights reserved": ("all-rights-reserved", 0.5),
}
BASE_WEIGHT, TAG_WEIGHT = 0.6, 0.95

#: Identifier tags: folded words and the pattern of the same tag in raw text.
TAGS = {
    "spdx license identifier": re.compile(r"spdx-license-identifier\s*:", re.I),
    "license expression": re.compile(r"license-expression\s*:", re.I),
}

#: How freely a licence allows reuse, by the start of its identifier.
GRADES = {
    "mit": 1.0, "bsd": 1.0, "isc": 1.0, "apache": 1.0, "0bsd": 1.0, "zlib": 1.0, "unlicense": 1.0, "cc0": 1.0,
    "cc-by-nc": 0.1, "cc-by-nd": 0.1, "cc-by-sa": 0.5, "cc-by": 0.9,
    "lgpl": 0.6, "mpl": 0.6, "epl": 0.6, "agpl": 0.2, "gpl": 0.3,
}
UNKNOWN_GRADE, EXCEPTION_GRADE = 0.5, 0.6

_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.:+-]*)")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def expression_tokens(text: str) -> list[str]:
    """Identifiers, operators and brackets at the start of the first line of ``text``."""
    line, out, at, depth = text.split("\n", 1)[0], [], 0, 0
    while m := _TOKEN.match(line, at):
        token, at = m[1], m.end()
        if token not in "()" and token.lower() not in _PRECEDENCE and out and _is_operand(out[-1]):
            break  # prose after the expression
        depth += (token == "(") - (token == ")")
        if depth < 0:
            break  # a bracket of the prose around it
        out.append(token)
    return out


def _is_operand(token: str) -> bool:
    return token == ")" or (token != "(" and token.lower() not in _PRECEDENCE)


def to_postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard; None where the expression is broken."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in tokens:
        op = token.lower()
        if token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif op in _PRECEDENCE:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[op]:
                out.append(stack.pop())
            stack.append(op)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def grade(identifier: str) -> float:
    low = identifier.lower()
    return max(((len(k), v) for k, v in GRADES.items() if low.startswith(k)), default=(0, UNKNOWN_GRADE))[1]


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """Licences named and the grade: ``and`` binds by the strictest side, ``or``
    leaves the choice of the freest, ``with`` relaxes a strict licence."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix:
        if token not in _PRECEDENCE:
            stack.append(({token.lower()}, grade(token)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, max(a, EXCEPTION_GRADE)))
        else:
            small, large = sorted((left, right), key=len)  # each set is in one entry alone, so it may grow
            large |= small
            stack.append((large, min(a, b) if token == "and" else max(a, b)))
    return stack[0]


@cache
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    found: dict[str, list[tuple[str, str, float]]] = {}
    for phrase, label in BASE.items():
        found.setdefault(phrase, []).append(("base", label, BASE_WEIGHT))
    for phrase, (label, weight) in NOTICES.items():
        found.setdefault(phrase, []).append(("notice", label, weight))
    for phrase in TAGS:
        found.setdefault(phrase, []).append(("tag", phrase, 0.0))
    for phrase, what in found.items():
        a.add_word(f" {phrase} ", (len(phrase) + 2, what))
    a.make_automaton()
    return a


def scan_text(text: bytes) -> tuple[int, list[dict], list[dict], float]:
    """Words, hits (kind, label, first word), expressions and score of one text."""
    tokens = words(text)
    folded = f" {b' '.join(tokens).decode('utf-8', 'replace')} "
    hits, expressions, miss = [], [], 1.0
    at = word = 0
    tagged = set()
    for end, (size, what) in automaton().iter(folded):
        start = end - size + 1
        word += folded.count(" ", at, start) if start >= at else -folded.count(" ", start, at)
        at = start
        for kind, label, weight in what:
            if kind == "tag":
                tagged.add(label)
            else:
                hits.append({"kind": kind, "label": label, "word": word})
                miss *= 1 - weight
    if tagged:
        raw = text.decode("utf-8", "replace")
        for tag in sorted(tagged):
            for m in TAGS[tag].finditer(raw):
                end = raw.find("\n", m.end())
                tokens_ = expression_tokens(raw[m.end():end if end >= 0 else len(raw)])
                postfix = to_postfix(tokens_)
                ids, value = evaluate(postfix) if postfix else ({"spdx-invalid"}, 0.0)
                expressions.append({"start": m.start(), "expression": " ".join(tokens_), "licences": sorted(ids), "grade": value})
                miss *= 1 - (TAG_WEIGHT if postfix else 0.5)
    return len(tokens), hits, expressions, 1 - miss


HIT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("label", T.StringType()), T.StructField("word", T.LongType())])
EXPRESSION = T.StructType([T.StructField("start", T.LongType()), T.StructField("expression", T.StringType()),
                           T.StructField("licences", T.ArrayType(T.StringType())), T.StructField("grade", T.DoubleType())])
FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(HIT)),
          T.StructField("expressions", T.ArrayType(EXPRESSION)), T.StructField("score", T.DoubleType())]

_HITS = pa.list_(pa.struct([("kind", pa.string()), ("label", pa.string()), ("word", pa.int64())]))
_EXPRESSIONS = pa.list_(pa.struct([("start", pa.int64()), ("expression", pa.string()), ("licences", pa.list_(pa.string())), ("grade", pa.float64())]))


def _scan(column: pa.Array) -> list[pa.Array]:
    n, hits, expressions, score = zip(*[scan_text(t or b"") for t in as_texts(column)])
    return [pa.array(n, pa.int64()), pa.array(hits, _HITS), pa.array(expressions, _EXPRESSIONS), pa.array(score, pa.float64())]


def scan(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_words``, ``hits`` (every place: kind, label, first word),
    ``expressions`` behind identifier tags and ``score``, the chance that the
    text carries a licence notice (noisy-or of the evidence)."""
    return annotate(df, text, _scan, FIELDS, keep)


def summary(df: DataFrame) -> DataFrame:
    """The query's columns from :func:`scan`'s."""
    base = F.filter("hits", lambda h: h["kind"] == "base")
    named = F.flatten(F.transform("expressions", lambda e: e["licences"]))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return df.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda h: h["word"])).alias("first_word"),
        F.array_max(F.transform(base, lambda h: h["word"])).alias("last_word"),
        joined(F.transform(base, lambda h: h["label"])).alias("base_labels"),
        joined(F.concat(F.transform("hits", lambda h: h["label"]), named)).alias("labels"),
        "score", F.array_min(F.transform("expressions", lambda e: e["grade"])).alias("strictest_grade"))
