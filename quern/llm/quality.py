"""Quality classifier: regularised quadratic discriminant analysis.

Every document is described by transformed statistics of its whole text
(``FEATURES``).  Spark sums each class's moments (count, sums, products) over
all labelled rows, so nothing but ``d + d*d`` sums per class reaches the
driver.  Each class covariance is shrunk towards its diagonal and towards the pooled
covariance, factored once (Cholesky), and the factors travel with the scoring
function; a score is the posterior of class 1 from the difference of the two
Mahalanobis log densities.

Edge cases: null text counts as empty, and empty texts get a score like any
other; labels of null ids and null labels are left out, as are ids labelled
both ways; without a row of one class every score is the share of class 1
(0.5 without any label); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import annotate, as_texts

FEATURES = (
    "log_bytes", "log_words", "mean_word", "spread_word", "upper", "digit", "stop_marks", "other_marks", "bars",
    "capitalised", "short_words", "distinct_words", "repeats", "marked_words", "log_line", "distinct_lines", "line_breaks",
)
THRESHOLD = 0.7
#: Weight of the pooled covariance and of the diagonal in each class covariance, and the ridge on the diagonal.
POOLED, DIAGONAL, RIDGE = 0.3, 0.3, 1e-3

_KIND = np.zeros(256, np.uint8)  # 0 other byte, 1 A-Z, 2 digit, 3 ,.'- and such, 4 other marks, 5 |, 6 line break, 7 blank
for _b in range(33, 127):
    _c = chr(_b)
    _KIND[_b] = 1 if _c.isupper() else 2 if _c.isdigit() else 0 if _c.isalpha() else 5 if _c == "|" else 3 if _c in ".,;:'-\"()" else 4
_KIND[10], _KIND[[9, 11, 12, 13, 32]] = 6, 7


def logit(share: float, n: float) -> float:
    """Log odds of a share among n, half an observation added to either side."""
    hits = share * n
    return float(np.log((hits + 0.5) / (n - hits + 0.5)))


def features(text: bytes) -> list[float]:
    n = len(text)
    kind = _KIND[np.frombuffer(text, np.uint8)]
    kinds = np.bincount(kind, minlength=8)
    edges = np.flatnonzero(np.diff(kind >= 6, prepend=True, append=True))  # white space ends and begins
    heads, tails = kind[edges[::2]], kind[edges[1::2] - 1]
    sizes = edges[1::2] - edges[::2] if len(edges) else np.zeros(1)
    words = text.split()
    m = len(words)
    lines = [x for x in text.split(b"\n") if x]
    at = lambda share, of: logit(share / max(of, 1), max(of, 1))
    return [
        np.log1p(n), np.log1p(m), np.log1p(sizes.mean()), np.log1p(sizes.std()),
        at(kinds[1], n), at(kinds[2], n), at(kinds[3], n), at(kinds[4], n), at(kinds[5], n),
        at((heads == 1).sum(), m), at((sizes <= 3).sum() if m else 0, m),
        np.log1p(len(set(words))) - np.log1p(m), at(sum(map(eq, words, words[1:])), m),
        at(((tails == 4) | (tails == 5)).sum(), m),
        np.log1p(n / max(len(lines), 1)), np.log1p(len(set(lines))) - np.log1p(len(lines)), at(kinds[6], n),
    ]


def _features(column: pa.Array) -> list[pa.Array]:
    found = np.array([features(t or b"") for t in as_texts(column)])
    return [pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))]


def describe(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``features``, the transformed statistics of the text."""
    return annotate(df, text, _features, [T.StructField("features", T.ArrayType(T.DoubleType()))], keep)


@dataclass
class Model:
    """Class shares, means and lower Cholesky factors; or only the share of class 1."""

    share: float
    means: tuple[np.ndarray, np.ndarray] | None = None
    factors: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None or self.factors is None:
            return np.full(len(x), self.share)
        log = []
        for mean, factor, share in zip(self.means, self.factors, (1 - self.share, self.share)):
            z = np.linalg.solve(factor, (x - mean).T)
            log.append(np.log(share) - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def clean_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """One row (doc_id, label 0 or 1) for each id that has one label only."""
    kept = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    return kept.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_most")).filter("label = _most").drop("_most")


def fit(described: DataFrame) -> Model:
    """Model from rows (label 0 or 1, features)."""
    d = len(FEATURES)
    x = F.col("features")
    values = F.concat(F.array(F.lit(1.0)), x, F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b))))
    moments = described.select("label", F.posexplode(values).alias("cell", "value")).groupBy("label", "cell").agg(F.sum("value").alias("total"))
    sums = np.zeros((2, 1 + d + d * d))
    for label, cell, total in moments.collect():  # 2 * (1 + d + d * d) rows at most
        sums[label, cell] = total
    n = sums[:, 0]
    if not n.all():
        return Model(float(n[1] / n.sum()) if n.sum() else 0.5)
    means = [sums[k, 1:1 + d] / n[k] for k in (0, 1)]
    raw = [sums[k, 1 + d:].reshape(d, d) / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (n[0] * raw[0] + n[1] * raw[1]) / n.sum()
    factors = []
    for c in raw:
        c = (1 - POOLED) * c + POOLED * pooled
        c = (1 - DIAGONAL) * c + DIAGONAL * np.diag(np.diag(c))
        factors.append(np.linalg.cholesky(c + RIDGE * (np.diag(np.diag(pooled)) + np.eye(d))))
    return Model(float(n[1] / n.sum()), tuple(means), tuple(factors))


class _Score:
    def __init__(self, model: Model):
        self.model = model

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        return [pa.array(self.model.score(np.array([features(t or b"") for t in as_texts(column)])))]


def train(docs: DataFrame, labels: DataFrame, usable=None) -> Model:
    """Fits on all labelled rows of ``docs`` for which ``usable`` (a condition on doc_id) holds."""
    docs = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    if usable is not None:
        docs = docs.filter(usable)
    # The statistics are taken before the join, so that it moves them and not the texts.
    return fit(describe(docs, keep=["doc_id"]).join(clean_labels(labels), "doc_id").select("label", "features"))


def score(df: DataFrame, model: Model, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Adds ``score`` (or the given name), the chance of label 1."""
    return annotate(df, "text", _Score(model), [T.StructField(name, T.DoubleType())], keep)
