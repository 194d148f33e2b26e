"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; each model sees the document's
features and the probabilities of the categories before it. In training those
are out-of-fold predictions, so a later model learns from probabilities as
unsure as it will meet.

Features are whether words, their first letters and marks of layout occur in a
document. They are counted over the labelled sample by Spark; per category the
most telling ones are kept, so models stay small whatever the vocabulary.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.mixing import draw
from starloom.llm.shared import written

# Categories in the order of the chain, each with the label column and value.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
# At most about so many labelled documents are learned from.
SAMPLE_ROWS = 8000
FEATURES = 200
FOLDS = 5
SEED = 5
THRESHOLD = 0.4

_EDGES = re.compile(r"^\W+|\W+$")


def features_of(text: str | None) -> set[str]:
    """The features that occur in a text."""
    words = set((text or "").lower().split())
    found = set()
    for word in words:
        core = _EDGES.sub("", word)
        if core:
            found.add(core)
            for n in (4, 5, 6):
                if len(core) > n:
                    found.add(core[:n] + "*")
        if len(word) - len(core) >= 2 or not core:
            found.add("~" + "".join(c for c in word if not c.isalnum())[:4])
    return found


@dataclass(frozen=True)
class Model:
    """Weights of each category over ``vocabulary``, the earlier categories and one."""

    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: tuple[np.ndarray, ...]

    def probabilities(self, texts: Iterable[str | None]) -> np.ndarray:
        """A row per text and a column per category."""
        texts = list(texts)
        x = np.zeros((len(texts), len(self.vocabulary)))
        for i, text in enumerate(texts):
            x[i, [self.vocabulary[f] for f in features_of(text) if f in self.vocabulary]] = 1.0
        return chain(x, self.weights)


def chain(x: np.ndarray, weights: Sequence[np.ndarray]) -> np.ndarray:
    """Probabilities of each category, each computed with those before it as inputs."""
    known = np.zeros((len(x), 0))
    for w in weights:
        p = _sigmoid(np.hstack([x, known, np.ones((len(x), 1))]) @ w)
        known = np.hstack([known, p[:, None]])
    return known


def fit_chain(x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """One weight vector per column of ``y``; later ones learn from out-of-fold probabilities."""
    known = np.zeros((len(x), 0))
    weights = []
    for j in range(y.shape[1]):
        inputs = np.hstack([x, known, np.ones((len(x), 1))])
        weights.append(logistic(inputs, y[:, j]))
        p = np.zeros(len(x))
        for fold in np.unique(folds):
            out = folds == fold
            p[out] = _sigmoid(inputs[out] @ logistic(inputs[~out], y[~out, j]))
        known = np.hstack([known, p[:, None]])
    return weights


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Logistic regression by Newton's method; the last column, the constant, is not penalized."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], l2)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[tuple[str, str, int]] = CATEGORIES,
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    seed: int = SEED,
) -> Model:
    """A chain fitted to the documents that ``labels`` (``doc_id`` and label columns) covers.

    Of more than ``sample_rows`` labelled documents a seeded sample of about
    that size is used. Labels or ids that are null are left out, and so are
    documents labelled twice with different values. Without any labelled
    document all probabilities are one half; without one of a category, or
    only such, the model says so for all.
    """
    names = [column for _, column, _ in categories]
    known = labels.select("doc_id", *dict.fromkeys(names)).dropna().distinct()
    known = known.join(
        known.groupBy("doc_id").count().where("count = 1").select("doc_id"), "doc_id", "left_semi"
    )
    count = known.count()
    if count > sample_rows:
        known = known.where(draw(seed, "doc_id") < sample_rows / count)
    targets = [(F.col(column) == value).cast("int").alias(f"y{j}") for j, (_, column, value) in enumerate(categories)]
    known = written(known.select(F.col("doc_id").alias("id"), *targets), "labelled")
    # The sample is bounded, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    # An id may be on any number of rows: equal texts count once, and what is still too much is drawn.
    rows = rows.select("doc_id", "text", *[f"y{j}" for j in range(len(targets))])
    chosen = written(rows.dropDuplicates(["doc_id", "text"]), "sample")
    count = chosen.count()
    if count > 1.25 * sample_rows:
        chosen = written(chosen.where(draw(seed, "doc_id", "text") < sample_rows / count), "sample")
    vocabulary = _telling(chosen, len(categories), features)
    table = _matrix(chosen, vocabulary, len(categories))
    x = np.zeros((len(table), len(vocabulary)))
    for i, found in enumerate(table["found"]):
        x[i, list(found)] = 1.0
    y = table[[f"y{j}" for j in range(len(categories))]].to_numpy(float)
    folds = table["fold"].to_numpy()
    if not len(table):
        weights = [np.zeros(len(vocabulary) + j + 1) for j in range(len(categories))]
    else:
        weights = fit_chain(x, y, folds)
    return Model(tuple(name for name, *_ in categories), vocabulary, tuple(weights))


def _telling(chosen: DataFrame, categories: int, features: int) -> dict[str, int]:
    """The features with the largest chi-squared for some category, numbered."""
    counts = ["n", *[f"n{j}" for j in range(categories)]]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One row per feature and task, not per document.
        totals = [Counter() for _ in counts]
        for batch in batches:
            for text, *y in zip(*[c.to_pylist() for c in batch.columns]):
                found = features_of(text)
                totals[0].update(found)
                for total, value in zip(totals[1:], y):
                    if value:
                        total.update(found)
        words = list(totals[0])
        for at in range(0, len(words), 10_000):
            some = words[at : at + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), *[pa.array([t[w] for w in some], pa.int64()) for t in totals]],
                names=["feature", *counts],
            )

    ys = [f"y{j}" for j in range(categories)]
    schema = ", ".join(["feature string", *[f"{c} long" for c in counts]])
    sums = chosen.select("text", *ys).mapInArrow(counted, schema).groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in counts]
    )
    sums = written(sums.where("n >= 3"), "features")
    total, *positive = chosen.agg(F.count(F.lit(1)), *[F.sum(y) for y in ys]).head()
    best: dict[str, int] = {}
    for j in range(categories):
        n, a = F.col("n").cast("double"), F.col(f"n{j}").cast("double")
        base = (positive[j] or 0) / total if total else 0.0
        if not 0 < base < 1:
            continue
        excess = a - n * base
        score = excess * excess / (n * base * (1 - base) + 1.0)
        for r in sums.orderBy(score.desc(), "feature").limit(features // categories).collect():
            best.setdefault(r["feature"], len(best))
    return best


def _matrix(chosen: DataFrame, vocabulary: dict[str, int], categories: int) -> pd.DataFrame:
    """Label values, fold and the numbers of the features found, per sampled document."""

    @F.pandas_udf("array<int>")
    def numbered(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(vocabulary[f] for f in features_of(t) if f in vocabulary))

    rows = chosen.select(
        "doc_id",
        F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).alias("fold"),
        *[f"y{j}" for j in range(categories)],
        numbered("text").alias("found"),
    ).collect()
    columns = ["doc_id", "fold", *[f"y{j}" for j in range(categories)], "found"]
    return pd.DataFrame(sorted(rows, key=lambda r: r[:-1]), columns=columns)


def score(text: Column, model: Model) -> Column:
    """A struct with the probability of each category, of a text or null."""
    kind = ", ".join(f"{name} double" for name in model.categories)

    @F.pandas_udf(kind)
    def judged(texts: pd.Series) -> pd.DataFrame:
        parts = [np.zeros((0, len(model.categories)))]
        parts += [model.probabilities(texts.iloc[at : at + 1000]) for at in range(0, len(texts), 1000)]
        return pd.DataFrame(np.vstack(parts), columns=list(model.categories))

    return judged(text)


def judge(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the probability of each category and ``rejected`` for every row of ``docs``.

    Rejected are documents whose last category, toxic, has ``threshold`` or
    more. Null and empty texts have no features and get the base probability.
    Repeated rows are judged alike; an empty table gives no rows. Other columns
    are not read.
    """
    scored = docs.select("doc_id", score(F.col("text"), model).alias("p"))
    last = F.col(f"p.{model.categories[-1]}")
    return scored.select(
        "doc_id", *[F.col(f"p.{c}").alias(c) for c in model.categories], (last >= threshold).alias("rejected")
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    columns = [docs[c] for c in docs.columns]
    last = score(F.col("text"), model)[model.categories[-1]]
    scored = docs.select(F.struct(*columns).alias("row"), last.alias("p"))
    return scored.where(F.col("p") < threshold).select("row.*")
