"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text has one score w.x from hashed features that all grades share; ordered
thresholds t(0) < t(1) < ... turn it into P(grade <= k) = logistic(t(k) - w.x).
The expected grade and the probability of the best grade serve selection.

Grades from the labels: 0 toxic, 1 of low quality, 2 neither. Of several labels
of a document the lowest grade counts; labels with a null, and documents
without, are not learnt from.

The fit takes a bounded sample, ``FIT_ROWS`` labelled documents, and runs on the
driver over their hashed features. Each grade has an equal part of the sample,
or all its documents if they are fewer, those with the smallest hash of their
id; in the fit a grade weighs what it does among all labelled documents. Of the
features it learns from those whose spread over the sample's grades is not
chance (a G statistic of ``EVIDENCE`` or more), the ``MOST_FEATURES`` clearest at
most: words that mark a grade in a rare language are kept, the many words that
tell nothing do not drown them. Counting is Spark's; what reaches the driver is
at most ``FIT_ROWS`` times ``MOST_FEATURES`` numbers, however long the texts.
Documents that ``held_out`` names are never in it. Every document is scored.

Defined results: null and empty texts have no features and get the prior of the
grades; with no labels at all every grade is as likely as the others. Repeated
rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantloom.llm.language_id import held_out
from plantloom.llm.tables import quoted, read, ready_for_python
from plantloom.session import materialize

GRADES = 3
FIT_ROWS = 12000
FEATURES = 1 << 20  # slots; as many again stand for what occurs twice or more in a text
PREFIXES = range(3, 8)
REMEMBERED_WORDS = 1 << 16
EVIDENCE = 15.0
MOST_FEATURES = 4096
STEPS, RATE, PENALTY = 150, 0.1, 1e-3
KEEP_FROM = 0.5
SEED = 11
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\W\d_]+")


def _slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name) % FEATURES


def word_slots(among: frozenset[int] | None = None):
    """A function word -> slots of the word and of its beginnings, which inflected and compound
    words share; only slots in ``among``, if given. It remembers a bounded number of words."""

    @lru_cache(REMEMBERED_WORDS)
    def slots(word: str) -> tuple[int, ...]:
        every = _slot(f"w:{word}"), *[_slot(f"p:{word[:k]}") for k in PREFIXES if k < len(word)]
        return every if among is None else tuple(s for s in every if s in among)

    return slots


_every_slot = word_slots()


def features(text: str | None, slots_of=_every_slot) -> np.ndarray:
    """Distinct hashed features: words and their beginnings in lower case, found once or
    found twice, and how common marks of poor text are. ``slots_of`` may leave words out."""
    words = WORD.findall(text or "")
    if not words:
        return np.empty(0, np.int32)
    lines = [x for x in text.split("\n") if x.strip()]
    marked = sum(not w[-2:].isalnum() for w in words if len(w) > 1)
    shares = {
        "upper": sum(w.isupper() for w in words), "marked": marked,
        "double": sum(a == b for a, b in zip(words, words[1:])),
        "alone": sum(not w[0].isalnum() for w in words),
    }
    # a share of all words in ten steps, each also standing for the lower ones
    marks = [f"s:{n}:{k}" for n, v in shares.items() for k in range(1, 11) if 10 * v >= k * len(words)]
    marks += [f"d:{k}" for k in range(1, 11) if 10 * (len(lines) - len(set(lines))) >= k * len(lines)]
    counts = Counter(chain.from_iterable(map(slots_of, map(str.lower, LETTERS.findall(text)))))
    slots = counts.keys() | set(map(_slot, marks)) | {FEATURES + s for s, n in counts.items() if n > 1}
    return np.fromiter(sorted(slots), np.int32, len(slots))


@dataclass(frozen=True)
class OrdinalModel:
    """Shared weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    @cached_property
    def slots_of(self):
        """``word_slots`` that have a weight, made once per worker."""
        return word_slots(frozenset((np.flatnonzero(self.weights) % FEATURES).tolist()))

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade) for each score, a row each."""
        below = _logistic(self.thresholds[None, :] - scores[:, None])
        edges = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        return np.diff(edges, axis=1)

    def score(self, found: list[np.ndarray]) -> np.ndarray:
        return np.fromiter((self.weights[f].sum() for f in found), np.float64, len(found))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def objective(param: np.ndarray, columns: np.ndarray, owner: np.ndarray, grades: np.ndarray,
              weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean weighted minus log likelihood with the ridge, and its gradient.

    ``param``: a weight per column, the first threshold, the logarithms of the gaps to the next.
    """
    n, size = len(grades), int(columns.max(initial=-1)) + 1
    weights, gaps = param[:size], np.exp(param[size + 1:])
    scores = np.bincount(owner, weights[columns], n)
    edges = np.concatenate([[-np.inf], param[size] + np.r_[0.0, np.cumsum(gaps)], [np.inf]])
    upper, lower = _logistic(edges[grades + 1] - scores), _logistic(edges[grades] - scores)
    p = np.maximum(upper - lower, 1e-12)
    loss = -(weight * np.log(p)).sum() / n + PENALTY / 2 * (weights @ weights)
    d_upper, d_lower = weight * upper * (1 - upper) / p, weight * lower * (1 - lower) / p
    grad = np.zeros_like(param)
    grad[:size] = np.bincount(columns, (d_upper - d_lower)[owner], size) / n + PENALTY * weights
    n_grades = len(gaps) + 2
    by_edge = (np.bincount(grades, -d_upper, n_grades)[:-1] + np.bincount(grades, d_lower, n_grades)[1:]) / n
    grad[size] = by_edge.sum()
    grad[size + 1:] = np.cumsum(by_edge[::-1])[::-1][1:] * gaps
    return loss, grad


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES,
        counts: np.ndarray | None = None) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the whole sample.

    Thresholds are the first plus exponentials, and so stay in order. With
    ``counts``, documents per grade, rows weigh what makes up these shares.
    """
    sampled = np.bincount(grades, minlength=n_grades)
    counts = sampled if counts is None else counts
    weight = (counts / np.maximum(sampled, 1) * len(rows) / max(counts.sum(), 1))[grades]
    # the start: thresholds that give the grades' shares, one of each added
    share = (np.cumsum(counts + 1.0) / (counts.sum() + n_grades))[:-1]
    start = np.log(share / (1 - share))
    if not len(rows):
        return OrdinalModel(np.zeros(2 * FEATURES), start)
    columns = np.concatenate([*rows, np.empty(0, np.int32)])
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    used, columns = np.unique(columns, return_inverse=True)
    size = len(used)
    param = np.concatenate([np.zeros(size), start[:1], np.log(np.diff(start))])
    mean, square = np.zeros_like(param), np.zeros_like(param)
    for step in range(1, STEPS + 1):
        _, grad = objective(param, columns, owner, grades, weight)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        param = param - RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    every = np.zeros(2 * FEATURES)
    every[used.astype(np.int64)] = param[:size]
    return OrdinalModel(every, param[size] + np.r_[0.0, np.cumsum(np.exp(param[size + 1:]))])


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade), one row per labelled document."""
    return labels.dropna(subset=["doc_id", "quality", "toxic"]).groupBy("doc_id").agg(F.min(
        F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2)).alias("grade"))


def quotas(counts: np.ndarray, fit_rows: int) -> list[int]:
    """Rows to take of each grade: equal parts, what a grade lacks going to the others."""
    out, left = [0] * len(counts), fit_rows
    for i, grade in enumerate(np.argsort(counts, kind="stable")):
        out[grade] = min(int(counts[grade]), left // (len(counts) - i))
        left -= out[grade]
    return out


def telling(found: DataFrame) -> np.ndarray:
    """The features of sampled rows (grade, features) that tell grades apart, at most ``MOST_FEATURES``.

    The G statistic compares how often a grade's rows have and lack a feature
    with what the feature's share of all rows would give.
    """
    rows = np.zeros(GRADES)
    for r in found.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect():
        rows[r.grade] = r.n
    seen = found.select("grade", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.count_if(F.col("grade") == k).cast("double").alias(f"n{k}") for k in range(GRADES)])

    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, 2 * count * F.log(count / expected)).otherwise(0.0)

    total, g = F.lit(float(rows.sum())), F.lit(0.0)
    for k, n in enumerate(rows.tolist()):
        with_it, share = F.col(f"n{k}"), F.col("n") / total
        g = g + part(with_it, share * n) + part(n - with_it, (1 - share) * n)
    best = seen.select("feature", g.alias("g")).filter(F.col("g") >= EVIDENCE)
    chosen = best.orderBy(F.desc("g"), "feature").limit(MOST_FEATURES).collect()
    return np.array(sorted(r.feature for r in chosen), np.int32)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS) -> OrdinalModel:
    """A model from a bounded sample of the labelled documents that are not held out."""
    ready_for_python(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def extract(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    graded = materialize(grades_of(labels).filter(~held_out("doc_id")))
    counts = np.zeros(GRADES, np.int64)
    for r in graded.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.grade] = r.n
    order = F.xxhash64(F.lit(SEED), "doc_id"), "doc_id"
    sample = graded.limit(0)
    for grade, n in enumerate(quotas(counts, fit_rows)):
        sample = sample.union(graded.filter(F.col("grade") == grade).orderBy(*order).limit(n))
    # ``fit_rows`` ids and grades at most, whatever the size of the tables
    rows = docs.select(F.col("doc_id"), quoted(text).alias("text")).join(F.broadcast(sample), "doc_id")
    first = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    found = materialize(first.select("doc_id", "grade", extract("text").alias("features")))
    chosen = telling(found)

    @F.pandas_udf("array<int>")
    def clear(lists: pd.Series) -> pd.Series:
        return pd.Series([np.intersect1d(x, chosen, assume_unique=True) for x in lists])

    sampled = found.select("doc_id", "grade", clear("features").alias("features")).toPandas().sort_values("doc_id")
    return fit([np.asarray(x, np.int32) for x in sampled["features"]], sampled["grade"].to_numpy(np.int64),
               counts=counts)


def scorer(spark: SparkSession, model: OrdinalModel):
    """A column function text -> struct(expected_grade, tail_probability)."""
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast(model)  # 2 x FEATURES weights, most of them zero

    @F.pandas_udf("expected_grade double, tail_probability double")
    def score(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        p = model.probabilities(model.score([features(t, model.slots_of) for t in texts]))
        return pd.DataFrame({"expected_grade": p @ np.arange(p.shape[1]), "tail_probability": p[:, -1]})

    return score


def op6_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, and whether its best grade is likely enough to keep it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, read(spark, sf_dir, "labels"))
    found = docs.select("doc_id", scorer(spark, model)("text").alias("s"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "s.expected_grade",
                        "s.tail_probability", (F.col("s.tail_probability") >= KEEP_FROM).alias("kept"))
