"""A quality classifier from trusted positives and unlabelled web text.

No negatives are learned from. The share of good text in the unlabelled sample, the class prior, is estimated first: a
classifier of positives against unlabelled orders the texts, and no threshold lets a smaller share of the unlabelled pass,
relative to that of the positives, than the prior. Then an additive model over binned features of the text is fitted to
minimise the non-negative unbiased risk: prior * loss(positives as good) + max(0, loss(unlabelled as bad) - prior *
loss(positives as bad)). The fit takes a sample of at most ``SAMPLE`` texts of either kind, on average; scores read every
text whole, in tasks.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quayline.llm.common import free_name, id_remainder, table, whole_text

SAMPLE = 15_000
THRESHOLD = 0.3
BINS = 12
CAUTION = 0.875  # the estimate bounds the prior from above, and too large a prior takes all unlabelled text for good
FEATURES = ("characters", "lower", "upper", "digits", "other_bytes", "signs", "bars", "word_length", "distinct_words",
            "top_word", "distinct_lines", "repeated_lines", "stops", "blanks", "doubled_words", "distinct_by_length")
SIGNS = [ord(c) for c in "!#$%&*<>@^_{}~\\"]


def features(text: str) -> list[float]:
    """What the model sees of a whole text."""
    raw = text.encode("utf-8", "replace")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, int)
    size, words, lines = max(len(raw), 1), text.split(), text.split("\n")
    count, distinct = max(len(words), 1), Counter(words)
    repeated = sum(len(line) * n for line, n in Counter(lines).items() if n > 1)
    doubled = sum(map(str.__eq__, words, itertools.islice(words, 1, None)))
    return [
        np.log1p(len(raw)), seen[97:123].sum() / size, seen[65:91].sum() / size, seen[48:58].sum() / size,
        seen[128:].sum() / size, seen[SIGNS].sum() / count, seen[124] / count, size / count, len(distinct) / count,
        max(distinct.values(), default=0) / count, len(set(lines)) / len(lines), repeated / max(len(text), 1),
        (seen[44] + seen[46]) / count, seen[32] / size, doubled / count, len(distinct) / count ** 0.85]


@dataclass
class Model:
    edges: list[np.ndarray]
    weights: list[np.ndarray]
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for i, (edges, weights) in enumerate(zip(self.edges, self.weights)):
            total += weights[np.searchsorted(edges, x[:, i], "right")]
        return 1 / (1 + np.exp(-total))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Indicators of the bins of every feature, side by side, and a constant."""
    parts = [np.eye(len(e) + 1, dtype=np.float32)[np.searchsorted(e, x[:, i], "right")] for i, e in enumerate(edges)]
    return np.hstack([*parts, np.ones((len(x), 1), np.float32)])


def _descend(gradient: Callable[[np.ndarray], np.ndarray], size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores that order both.

    Whatever passes a threshold, positives are ``prior`` times their own share of it or more; so the smallest ratio is
    an upper bound, and it is met where hardly any bad text passes. A standard error is added to each ratio, so that thin
    tails don't decide.
    """
    best = 1.0
    if not len(positive) or not len(unlabelled):
        return 0.99
    for t in np.quantile(positive, np.linspace(0, 0.8, 41)):
        p, u = (positive >= t).mean(), (unlabelled >= t).mean()
        spread = np.sqrt(u * (1 - u) / len(unlabelled) + p * (1 - p) / len(positive))
        best = min(best, (u + spread) / p)
    return float(np.clip(best, 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, decay: float = 2e-3) -> Model:
    """The additive model of least non-negative risk."""
    everything = np.vstack([positive, unlabelled])
    edges = [np.unique(np.quantile(everything[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(everything.shape[1])]
    # quantiles miss rare extremes, which are what bad text has: a last bin beyond nearly all positives on either side
    edges = [np.unique(np.r_[e, np.quantile(positive[:, i], [0.002, 0.998]) + [0, 1e-9]]) for i, e in enumerate(edges)]
    p, u = _binned(positive, edges), _binned(unlabelled, edges)
    size = p.shape[1]

    def against(w: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
        return decay * w + (u.T @ _sigmoid(u @ w) / max(1, len(u)) + p.T @ (_sigmoid(p @ w) - 1) / max(1, len(p))) / 2

    halves = [(p[i::2], u[i::2]) for i in (0, 1)]
    ordered = [_descend(lambda w: against(w, *half), size, steps // 2) for half in halves]
    # each half is ordered by what the other has taught, as a model is surer of the positives it has seen
    prior = CAUTION * float(np.mean([class_prior(a @ w, b @ w) for (a, b), w in zip(halves, ordered[::-1])]))

    def risk(w: np.ndarray) -> np.ndarray:
        # logistic loss: as good -log s(z), as bad -log(1 - s(z)); the loss of p as good less that as bad is -z
        zu, zp = u @ w, p @ w
        bad = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        grad_bad = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        good = prior * (p.T @ (_sigmoid(zp) - 1)) / len(p)
        return decay * w + (good + grad_bad if bad >= 0 else -grad_bad)

    w = _descend(risk, size, steps)
    cuts = np.cumsum([len(e) + 1 for e in edges])
    return Model(edges, np.split(w[:-1], cuts[:-1]), float(w[-1]), prior)


def _feature_frame(df: DataFrame, text: str, *keep: str) -> DataFrame:
    @F.pandas_udf("array<double>")
    def extract(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return df.select(*keep, extract(F.col(text)).alias("_x"))


def train(docs: DataFrame, trusted: DataFrame, training: Column | None = None, key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE) -> Model | None:
    """Fit on about ``sample`` texts of ``docs`` whose key is in ``trusted`` and about ``sample`` of all others' and
    theirs, unlabelled; both only where ``training`` holds. None where there is no trusted text."""
    docs = docs.select(F.col(f"`{key}`").alias("_key"), whole_text(f"`{text}`").alias("_text"),
                       (F.lit(True) if training is None else training).alias("_training"))
    keys = trusted.select(F.col(f"`{key}`").alias("_key")).where(F.col("_key").isNotNull()).distinct()
    chosen = F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) < F.lit(sample / max(1, keys.count()) * (1 << 30))
    keys = F.broadcast(keys.where(chosen).withColumn("_trusted", F.lit(True)))  # about ``sample`` keys
    docs = docs.where("_training").join(keys, "_key", "left")
    size = docs.agg(F.count(F.lit(1)).alias("all"), F.count("_trusted").alias("trusted")).first()
    # drawn row by row, as a key may be repeated
    drawn = (docs.withColumn("_p", F.col("_trusted").isNotNull() & (F.rand(1) < sample / max(1, size["trusted"])))
             .withColumn("_u", F.rand(2) < sample / max(1, size["all"])).where(F.col("_p") | F.col("_u")))
    rows = _feature_frame(drawn, "_text", "_p", "_u").toPandas()
    x = np.array(rows["_x"].tolist(), float).reshape(len(rows), len(FEATURES))
    positive, u = rows["_p"].to_numpy(bool), rows["_u"].to_numpy(bool)
    if not positive.any() or not u.any():
        return None
    return fit(x[positive], x[u])


def score(docs: DataFrame, model: Model | None, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every whole text, higher for better ones.

    A NULL text is scored as the empty one. Without a model all texts get 1, so that nothing is rejected unlearned.
    Repeated rows get equal scores. A column that is already called ``column`` stays; the new one gets underscores.
    """
    column = free_name(docs.columns, column)
    if model is None:
        return docs.withColumn(column, F.lit(1.0))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))))

    return docs.withColumn(column, scored(whole_text(f"`{text}`")))


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels nothing is learned from."""
    return id_remainder(f"`{key}`", 5) == 0


def labelled_model(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model that the trusted labels outside the held-out fold give."""
    trusted = labels.where((F.col("quality") == 1) & ~held_out()).select("doc_id")
    return train(docs, trusted, ~held_out())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    scored = score(docs, labelled_model(docs, labels), column="_score")
    return scored.where(F.col(scored.columns[-1]) >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = labelled_model(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
