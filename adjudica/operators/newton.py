"""Logistic regression by Newton steps: the weighted normal equations are one aggregate a step.

Minimises |w|^2 / 2 + C * (sum of losses), the intercept without penalty. Every step sums, over all rows, the gradient and the
matrix of second derivatives; the driver solves a system of as many equations as there are features. A step that does not lower the
objective is halved. Near the optimum the error is squared by each step, so a handful of passes gives all digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .ensembles import indicators
from .metrics import roc_auc_frame
from .models import in_threads

INTERCEPT = "(intercept)"


@dataclass
class NewtonRegression:
    """Weights by feature, the intercept first; objective after each step; largest gradient entry at the end."""

    names: list[str]
    weights: list[float]
    objective: list[float]
    gradient: float

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, n, float(w)) for i, (n, w) in enumerate(zip(self.names, self.weights))]
        return spark.createDataFrame(rows, "position int, feature string, weight double")

    def margin(self) -> Column:
        """The linear score as an expression over the feature columns; a missing value counts as 0."""
        out = F.lit(float(self.weights[0]))
        for name, w in zip(self.names[1:], self.weights[1:]):
            out = out + F.lit(float(w)) * F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(0.0))
        return out


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Second derivatives, gradient and loss of a block of rows, one matrix with a last row and column."""
    z = x @ w
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
    out = np.empty((len(w) + 1, len(w) + 1))
    out[:-1, :-1] = (x * (p * (1.0 - p))[:, None]).T @ x
    out[-1, :-1] = out[:-1, -1] = x.T @ (p - y)
    out[-1, -1] = np.sum(np.logaddexp(0.0, z) - y * z)
    return out


def normal_equations(rows: DataFrame, weights: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The sums over all rows (x, y) at each of several weights, in one pass: a number for each pair of features leaves a task, whatever its size."""
    size = len(weights[0]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weights), size, size))
        for batch in batches:
            if len(batch):
                x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                y = batch["y"].to_numpy(zero_copy_only=False)
                for k, w in enumerate(weights):
                    total[k] += _sums(x, y, w)
        i, j = np.triu_indices(size)
        for k, m in enumerate(total):
            places = [np.full(len(i), k, np.int32), i.astype(np.int32), j.astype(np.int32)]
            yield pa.record_batch([*map(pa.array, places), pa.array(m[i, j])], names=["k", "i", "j", "value"])

    sums = rows.select("x", "y").mapInArrow(run, "k int, i int, j int, value double").groupBy("k", "i", "j").agg(F.sum("value").alias("value"))
    out = np.zeros((len(weights), size, size))
    for r in sums.collect():
        out[r.k, r.i, r.j] = out[r.k, r.j, r.i] = r.value
    return list(out)


class _Descent:
    """Newton's method for one C."""

    def __init__(self, C: float, size: int):
        self.w, self.share, self.step, self.done = np.zeros(size), 1.0, None, False
        self.penalty = np.concatenate([[0.0], np.full(size - 1, 1.0 / C)])  # of the objective divided by C
        self.reached: list[float] = []
        self.sums = None

    def objective(self, sums: np.ndarray, at: np.ndarray) -> float:
        return sums[-1, -1] + float(self.penalty @ (at * at)) / 2

    def gradient(self) -> np.ndarray:
        return self.sums[-1, :-1] + self.penalty * self.w

    def propose(self) -> np.ndarray:
        if self.sums is None:
            return self.w
        if self.step is None:
            # a direction without curvature (a class of one value, a constant feature) keeps its weight
            self.step = np.linalg.lstsq(self.sums[:-1, :-1] + np.diag(self.penalty), self.gradient(), rcond=1e-14)[0]
            self.share = 1.0
        return self.w - self.share * self.step

    def see(self, tried: np.ndarray, sums: np.ndarray, tolerance: float) -> None:
        value = self.objective(sums, tried)
        if not self.reached or value <= self.reached[-1]:
            still = bool(self.reached) and np.abs(tried - self.w).max() == 0.0
            self.w, self.sums, self.step = tried, sums, None
            self.reached.append(value)
            self.done = still or np.abs(self.gradient()).max() <= tolerance
        else:
            self.share /= 2
            self.done = self.share < 1e-6  # rounding decides from here on


def fit_newton(
    df: DataFrame, label: str, features: Sequence[str], C: float | Sequence[float] = 1.0, max_iter: int = 1000, tolerance: float = 1e-10
) -> NewtonRegression | list[NewtonRegression]:
    """Fit on all rows with a label. A missing feature counts as 0; ``tolerance`` is that of the gradient's largest entry, for each row.

    For several C the fits go on side by side and share their passes.
    """
    known = df.where(F.col(label).isNotNull())
    values = [F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in features]
    rows = stored(known.select(F.array(F.lit(1.0), *values).alias("x"), F.col(label).cast("double").alias("y")), "newton-rows")
    n = rows.count()
    if not n:
        raise ValueError("no labelled rows")
    given = [C] if isinstance(C, (int, float)) else list(C)
    fits = [_Descent(c, len(features) + 1) for c in given]
    for _ in range(max_iter):
        going = [f for f in fits if not f.done]
        if not going:
            break
        tried = [f.propose() for f in going]
        for f, at, sums in zip(going, tried, normal_equations(rows, tried)):
            f.see(at, sums, tolerance * n)
    names = [INTERCEPT, *features]
    out = [
        NewtonRegression(names, [float(v) for v in f.w], [c * v for v in f.reached], float(np.abs(f.gradient()).max())) for c, f in zip(given, fits)
    ]
    return out[0] if isinstance(C, (int, float)) else out


# --- a model over raw columns, kept as a table ------------------------------------

MODEL_SCHEMA = "position int, feature string, source string, value string, mean double, scale double, weight double"


@dataclass
class LinearModel:
    """Weights with what turns raw columns into features: (feature, source column, category or null, mean, scale, weight).

    The table is the whole model: ``save`` and ``load`` keep it as Parquet, any engine can score it.
    """

    terms: list[tuple]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, *t) for i, t in enumerate(self.terms)], MODEL_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearModel:
        rows = spark.read.schema(MODEL_SCHEMA).parquet(path).orderBy("position").collect()
        return cls([tuple(r)[1:] for r in rows])

    def margin(self) -> Column:
        """The linear score as an expression over the raw columns, for batch or stream. A missing number counts as the mean, a missing or
        new category as none."""
        out = F.lit(0.0)
        for _, source, value, mean, scale, weight in self.terms:
            if source is None:
                x = F.lit(1.0)
            elif value is not None:
                x = F.coalesce((F.col(f"`{source}`").cast("string") == value).cast("double"), F.lit(0.0))
            else:
                number = F.col(f"`{source}`").cast("double")
                x = (F.coalesce(F.nanvl(number, F.lit(None)), F.lit(mean)) - mean) / scale
            out = out + F.lit(weight) * x
        return out

    def score(self, df: DataFrame, column: str = "probability") -> DataFrame:
        return df.withColumn(column, 1.0 / (1.0 + F.exp(-self.margin())))


def fit_linear(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], C: float | Sequence[float] = 1.0
) -> LinearModel | list[LinearModel]:
    """Standardised numbers and one indicator for each category, scaled and named on the given rows, fitted by Newton steps; a model for each C."""
    known = df.where(F.col(label).isNotNull())
    wide, made = indicators(known, categorical)
    numbers = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in numeric}
    moments = [f(v).alias(f"{n}{i}") for i, v in enumerate(numbers.values()) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    seen = known.agg(F.count(F.lit(1)), *moments).first()
    facts = {c: (seen[f"m{i}"] or 0.0, seen[f"s{i}"] or 1.0) for i, c in enumerate(numeric)}
    scaled = wide.withColumns({f"__x{i}": (numbers[c] - facts[c][0]) / facts[c][1] for i, c in enumerate(numeric)})
    given = [C] if isinstance(C, (int, float)) else list(C)
    fitted = fit_newton(scaled, label, [*[f"__x{i}" for i in range(len(numeric))], *made], given)
    sources = [(c, v) for c in categorical for v in (n[len(c) + 1 :] for n in made if n.startswith(f"{c}="))]
    terms = [(INTERCEPT, None, None, 0.0, 1.0), *[(c, c, None, *facts[c]) for c in numeric]]
    terms += [(f"{c}={v}", c, v, 0.0, 1.0) for c, v in sources]
    out = [LinearModel([(*t, w) for t, w in zip(terms, f.weights)]) for f in fitted]
    return out[0] if isinstance(C, (int, float)) else out


def cross_validated_auc(
    folded: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str], penalties: Sequence[float], folds: int,
    parallelism: int = 5,
) -> list[tuple[float, list[float]]]:
    """(C, area under the ROC curve of each fold) for each C. Scaling and categories are fitted anew on every fold's training rows."""

    def one(fold: int) -> list[float]:
        models = fit_linear(folded.where(F.col("fold") != fold), label, numeric, categorical, penalties)
        held = folded.where(F.col("fold") == fold)
        # equal rows must tie, whatever the last digits
        scored = [m.score(held, "__p").withColumn("__p", F.round("__p", 9)) for m in models]
        return [roc_auc_frame(s, label, "__p").first().roc_auc for s in scored]

    found = in_threads(folded.sparkSession, [lambda i=i: one(i) for i in range(folds)], parallelism)
    return [(float(c), [areas[k] for areas in found]) for k, c in enumerate(penalties)]
