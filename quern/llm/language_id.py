"""Language identification with a string kernel.

Texts are compared by the blended-spectrum presence kernel: a text is the set
of its byte n-grams of 1 to ``LONGEST`` bytes (letters folded, everything else one blank),
and K(x, z) = |x & z| / sqrt(|x| |z|).  An n-gram is its own key, so that none collide however long a text is.  A bounded
sample of texts serves as Nyström landmarks; each text's features are
its kernel values against the landmarks times K_mm^(-1/2), and one ridge
regression per language (one versus the rest) is fitted to them.

A text's scores are (presence row / norm) @ landmarks @ weights.  The last two
factors are multiplied once, to a row of weights for each n-gram of a landmark; n-grams that no landmark
has only enter the norm.

Bounds (parameters): ``LANDMARKS`` texts of each language as landmarks and
``TRAINING`` texts of each language for the regression, chosen by a hash of the id.

Edge cases: ``und`` with score 0 for null texts and texts without a letter
(empty ones too), and for all if there is nothing to learn from; ties go to
the language first in order; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import annotate, as_texts

LONGEST = 4
LANDMARKS, TRAINING, RIDGE = 40, 600, 1e-3
#: More labels than this are no list of languages.
MOST_LANGUAGES = 1000
UNDETERMINED = "und"

_FOLDED = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0x80 else 32 for b in range(256)], np.uint8)


def grams(text: bytes) -> np.ndarray:
    """The distinct n-grams, each as its bytes with zeros behind; a folded text has no zero."""
    a = _FOLDED[np.frombuffer(text, np.uint8)]
    blank = a == 32
    a = a[~(blank & np.roll(blank, 1))] if len(a) else a  # runs of other signs are one blank
    a = np.concatenate([a, np.zeros(LONGEST - 1, np.uint8)]).astype(np.uint32)
    n = len(a) - LONGEST + 1
    longest = np.zeros(n, np.uint32)
    for k in range(LONGEST):
        longest = longest << np.uint32(8) | a[k:k + n]
    found, out = _distinct(np.sort(longest)), []
    for k in range(LONGEST):  # in order, so shorter ones stand in order too
        out.append(found[found & np.uint32(0xFF) != 0] << np.uint32(8 * k))
        found = _distinct(found >> np.uint32(8))
    return np.concatenate(out)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


def places(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Where the n-grams stand in ``keys`` (in order), those that do."""
    if not len(keys):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    return at[keys[at] == found]


def _norm(found: np.ndarray) -> float:
    return float(np.sqrt(max(len(found), 1)))


@dataclass
class Model:
    """languages, the landmarks' n-grams in order, and the (n-grams x languages) product of landmarks and ridge weights with its offset."""

    languages: list[str]
    keys: np.ndarray
    weights: np.ndarray
    offset: np.ndarray


@cache
def _letter():
    import regex

    return regex.compile(r"\p{L}").search


class _Predict:
    def __init__(self, model: Model):
        self.model = model

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        texts = as_texts(column)
        names, scores = [], []
        for text in (t or b"" for t in texts):
            if self.model.languages and _letter()(text.decode("utf-8", "replace")):
                found = grams(text)
                margin = self.model.weights[places(self.model.keys, found)].sum(axis=0, dtype=np.float64) / _norm(found) + self.model.offset
                best = int(margin.argmax())
                names.append(self.model.languages[best])
                scores.append(float(np.clip((margin[best] + 1) / 2, 0, 1)))
            else:
                names.append(UNDETERMINED)
                scores.append(0.0)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]


def sample(docs: DataFrame, each: int) -> DataFrame:
    """About ``each`` rows (doc_id, text, lang) of every language, those of the
    smallest hashes of their ids.  Counts come first, so that only a few times the
    wanted rows and no whole language are sorted."""
    known = docs.filter("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang", F.xxhash64("doc_id", F.lit(7)).alias("pick"))
    counts = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return known.select("doc_id", "text", "lang").limit(0)
    share = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, min(1.0, (3 * each + 50) / n))])
    few = known.filter(F.pmod("pick", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    rank = F.row_number().over(_by_language())
    return few.withColumn("rank", rank).filter(F.col("rank") <= each).select("doc_id", "text", "lang")


def _by_language():
    from pyspark.sql import Window

    return Window.partitionBy("lang").orderBy("pick", "doc_id", "text")


def fit(docs: DataFrame, landmarks: int = LANDMARKS, training: int = TRAINING) -> Model:
    """Learns from a sample of (doc_id, text, lang)."""
    rows = sorted(sample(docs, training).collect(), key=lambda r: (r["lang"], r["doc_id"], r["text"]))  # training rows a language at most
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], np.zeros(0, np.uint32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    lang = np.array([languages.index(r["lang"]) for r in rows])
    marks = np.concatenate([np.flatnonzero(lang == k)[:landmarks] for k in range(len(languages))])
    of_marks = [grams(rows[i]["text"].encode("utf-8", "replace")) for i in marks]
    keys = np.unique(np.concatenate(of_marks))
    norms = np.array([_norm(f) for f in of_marks])
    # For every n-gram its landmarks, one list behind another.
    which = np.concatenate([places(keys, f) for f in of_marks])
    holders = np.repeat(np.arange(len(marks)), [len(f) for f in of_marks])[np.argsort(which, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(keys)))])

    def kernel(text: str) -> np.ndarray:
        found = grams(text.encode("utf-8", "replace"))
        at = places(keys, found)
        n = starts[at + 1] - starts[at]
        hit = np.repeat(starts[at] - np.concatenate([[0], np.cumsum(n)[:-1]])[:len(n)], n) + np.arange(n.sum())
        return np.bincount(holders[hit], minlength=len(marks)) / norms / _norm(found)

    k_xm = np.array([kernel(r["text"]) for r in rows])
    values, vectors = np.linalg.eigh(k_xm[marks])
    root = (vectors / np.sqrt(np.maximum(values, 1e-8))) @ vectors.T * (values > 1e-8).any()
    phi = k_xm @ root
    mean = phi.mean(axis=0)
    targets = np.where(lang[:, None] == np.arange(len(languages)), 1.0, -1.0)
    centred = phi - mean
    beta = np.linalg.solve(centred.T @ centred + RIDGE * len(rows) * np.eye(len(marks)), centred.T @ (targets - targets.mean(axis=0)))
    weights, of_mark = np.zeros((len(keys), len(languages))), root @ beta / norms[:, None]
    for k, found in enumerate(of_marks):
        weights[places(keys, found)] += of_mark[k]
    return Model(languages, keys, weights.astype(np.float32), (targets.mean(axis=0) - mean @ beta).astype(np.float32))


def predict(df: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Adds ``lang_pred`` and ``score``."""
    return annotate(df, "text", _Predict(model), [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], keep)
