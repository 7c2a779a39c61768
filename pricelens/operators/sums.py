"""Linear fits over wide sparse vectors, from sums that one scan adds up.

A squared error is a sum over pairs of a row's features, label and 1.  Rows
of one-hot vectors have few of them, and equal pairs meet in one sum, so the
sums of all rows are a sparse matrix; every penalty, fold and refit is solved from it.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import LABEL
from ..session import cut_lineage, release

# Workers are sent the functions below whole: fits don't ask for this package on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The sums reach the driver while they are at most so many numbers (over all folds, 16 bytes each); wider tables are fitted by passes over their rows.
MAX_SUMS = 8_000_000
#: Up to this width MLlib itself solves a single fit from one scan.
MAX_NORMAL = 4_096
#: Pairs that a task adds up at a time, and sums that it holds before it gives them out.
PAIRS_AT_ONCE, SUMS_HELD = 1_000_000, 3_000_000


def added_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every key once, ascending, with the sum of its values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values[order], first)


def _pairs(fold: np.ndarray, places: np.ndarray, values: np.ndarray, lengths: np.ndarray, side: int):
    """(keys, products) of all pairs of each row's places, some rows at a time; a key is (fold, i, j) as one number."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for k in np.unique(lengths):
        rows, (a, b) = np.flatnonzero(lengths == k), np.triu_indices(k)
        step = max(1, PAIRS_AT_ONCE // len(a))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            cells = starts[some][:, None] + np.arange(k)
            i, v = places[cells].astype(np.int64), values[cells]
            products = (v[:, a] * v[:, b]).ravel()
            keys = ((fold[some][:, None] * side + i[:, a]) * side + i[:, b]).ravel()
            kept = products != 0.0
            yield (keys, products) if kept.all() else (keys[kept], products[kept])


def _partial_sums(side: int):
    arrow = pa.schema([("fold", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())])

    def given(keys, sums):
        return pa.RecordBatch.from_arrays([pa.array((keys // (side * side)).astype(np.int32)), pa.array((keys // side % side).astype(np.int32)),
                                           pa.array((keys % side).astype(np.int32)), pa.array(sums)], schema=arrow)

    def run(batches):
        raw, n_raw, held, n_held = [], 0, [], 0
        joined = lambda parts: added_up(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        for b in batches:
            if not b.num_rows:
                continue
            fold, places, values = b.column(0).to_numpy().astype(np.int64), b.column(1), b.column(2)
            lengths = np.diff(places.offsets.to_numpy())
            for part in _pairs(fold, places.flatten().to_numpy(), values.flatten().to_numpy(), lengths, side):
                raw.append(part)
                n_raw += len(part[0])
                if n_raw >= PAIRS_AT_ONCE:
                    held.append(joined(raw))
                    n_held += len(held[-1][0])
                    raw, n_raw = [], 0
                if n_held >= 2 * SUMS_HELD:
                    held = [joined(held)]
                    n_held = len(held[0][0])
                    if n_held >= SUMS_HELD:
                        yield given(*held[0])
                        held, n_held = [], 0
        if raw or held:
            yield given(*joined(raw + held))

    return run


def linear_sums(train: DataFrame, features_col: str, width: int, label: str = LABEL, fold: str | None = None) -> "LinearSums | None":
    """The sums of ``train``, for each fold, from one scan; None where they are too many for the driver."""
    raw = F.unwrap_udt(F.col(features_col))
    places = F.when(raw["type"] == 0, raw["indices"]).when(F.size(raw["values"]) > 0, F.sequence(F.lit(0), F.size(raw["values"]) - 1)) \
        .otherwise(F.expr("cast(array() as array<int>)"))
    rows = train.where(F.col(features_col).isNotNull() & F.col(label).isNotNull()).select(
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"), F.concat(places, F.array(F.lit(width), F.lit(width + 1))).alias("i"),
        F.concat(raw["values"], F.array(F.lit(1.0), F.col(label).cast("double"))).alias("v"))
    pairs = rows.mapInArrow(_partial_sums(width + 2), "fold int, i int, j int, v double")
    table = cut_lineage(pairs.groupBy("fold", "i", "j").agg(F.sum("v").alias("v")))
    try:
        if not 0 < table.count() <= MAX_SUMS:
            return None
        found = table.toArrow()
    finally:
        release(table)
    return LinearSums(width, *(found.column(c).to_numpy() for c in ("fold", "i", "j", "v")))


class LinearSums:
    """The symmetric matrix of sums over (features, 1, label), a set of values for each fold."""

    def __init__(self, width: int, fold: np.ndarray, i: np.ndarray, j: np.ndarray, v: np.ndarray):
        self.width, side = width, width + 2
        places, at = np.unique(i.astype(np.int64) * side + j, return_inverse=True)
        self.folds = np.unique(fold).tolist()
        self.of_fold = np.zeros((len(self.folds), len(places)))
        self.of_fold[np.searchsorted(self.folds, fold), at] = v
        self.total = self.of_fold.sum(axis=0)
        i, j = places // side, places % side
        own, mirrored = np.arange(len(places)), np.flatnonzero(i != j)
        rows, cols, source = np.concatenate([i, j[mirrored]]), np.concatenate([j, i[mirrored]]), np.concatenate([own, mirrored])
        order = np.lexsort((cols, rows))
        rows, self._cols, self._source = rows[order], cols[order], source[order]
        self._starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        self._rows = rows[self._starts]
        self._diagonal = i[i == j], own[i == j]

    def times(self, spread: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The matrix of values ``spread`` (see ``spread``) times a vector."""
        out = np.zeros(self.width + 2)
        found = np.take(x, self._cols, mode="clip")  # unlike x[...] it lets other threads run
        out[self._rows] = np.add.reduceat(np.multiply(found, spread, out=found), self._starts)
        return out

    def spread(self, values: np.ndarray) -> np.ndarray:
        """Values of both triangles, row by row."""
        return values[self._source]

    def solve(self, values: np.ndarray, reg: float = 0.0, elastic_net: float = 0.0, steps: int = 2_000, tol: float = 1e-7) -> np.ndarray:
        """Coefficients, intercept and -1 of a penalised fit to the sums ``values``; the objective is that of ``tuning.solve_linear``.

        Ridge by conjugate gradients; with an L1 part, accelerated proximal steps with restarts.
        """
        w, s = self.width, self.spread(values)
        unit = lambda k: np.eye(1, w + 2, k)[0]
        ones, labels = self.times(s, unit(w)), self.times(s, unit(w + 1))
        n = ones[w]
        mean, label_mean = ones[:w] / n, labels[w] / n
        squares = np.zeros(w + 2)
        squares[self._diagonal[0]] = values[self._diagonal[1]]
        std = np.sqrt(np.maximum(squares[:w] / n - mean ** 2, 0.0))
        label_std = math.sqrt(max(labels[w + 1] / n - label_mean ** 2, 0.0))
        used = (std > 1e-9 * np.maximum(np.abs(mean), 1e-300)) & (ones[:w] != 0.0)
        b = np.zeros(w)
        scale = np.where(used, 1.0 / np.where(used, std, 1.0), 0.0)
        if used.any() and label_std > 0:
            padded = np.zeros(w + 2)

            def correlated(b):
                padded[:w] = scale * b
                return scale * (self.times(s, padded)[:w] / n - mean * (mean @ padded[:w]))

            c = scale * (labels[:w] / n - mean * label_mean) / label_std
            l1, l2 = reg / label_std * elastic_net, reg / label_std * (1.0 - elastic_net)
            b = _ridge(correlated, c, l2, steps, tol * 1e-2) if l1 == 0.0 else _elastic_net(correlated, c, l1, l2, steps, tol)
        coefficients = b * scale * label_std
        return np.concatenate([coefficients, [label_mean - mean @ coefficients, -1.0]])

    def rmse(self, values: np.ndarray, v: np.ndarray) -> float:
        """Of a fit ``v`` on the rows behind ``values``."""
        s = self.spread(values)
        n = self.times(s, np.eye(1, self.width + 2, self.width)[0])[self.width]
        return math.sqrt(max(v @ self.times(s, v), 0.0) / n)

    def grid(self, points: list[dict], run=None) -> list[list[float]]:
        """RMSE of each point on each fold, by fits to the other folds; ``run`` runs a list of functions."""
        def scored(p, held):
            return lambda: self.rmse(held, self.solve(self.total - held, p.get("regParam", 0.0), p.get("elasticNetParam", 0.0)))

        tasks = [scored(p, held) for p in points for held in self.of_fold]
        flat = run(tasks) if run else [t() for t in tasks]
        return [flat[i * len(self.folds):(i + 1) * len(self.folds)] for i in range(len(points))]

    def model(self, est, without: int | None = None) -> LinearRegressionModel:
        """What the estimator fits, on all rows or on those of the other folds, as a model of its kind."""
        values = self.total if without is None or without not in self.folds else self.total - self.of_fold[self.folds.index(without)]
        return linear_model(est, self.solve(values, est.getRegParam(), est.getElasticNetParam()))


def solved_from_sums(est) -> bool:
    """Whether an estimator fits what ``LinearSums.solve`` does: least squares with an intercept, and no limits of its own for MLlib's passes."""
    return isinstance(est, LinearRegression) and est.getLoss() == "squaredError" and est.getFitIntercept() and est.getStandardization() \
        and est.getSolver() == "auto" and not any(est.isSet(p) for p in ("weightCol", "maxIter", "tol"))


def linear_model(est, v: np.ndarray) -> LinearRegressionModel:
    """MLlib's model with these coefficients and this intercept, and the parameters of the estimator."""
    from pyspark import SparkContext
    from pyspark.ml.common import _py2java
    sc = SparkContext._active_spark_context
    uid = sc._jvm.org.apache.spark.ml.util.Identifiable.randomUID("linReg")
    own = sc._jvm.org.apache.spark.ml.regression.LinearRegressionModel(uid, _py2java(sc, Vectors.dense(v[:-2])), float(v[-2]))
    return est._copyValues(LinearRegressionModel(own))


def _ridge(times, c: np.ndarray, l2: float, steps: int, tol: float) -> np.ndarray:
    b, rest = np.zeros(len(c)), c.copy()
    along, left, least = rest.copy(), rest @ rest, (tol * tol) * (c @ c)
    for _ in range(steps):
        if left <= least:
            break
        image = times(along) + l2 * along
        bend = along @ image
        if bend <= 0.0:
            break
        b += left / bend * along
        rest -= left / bend * image
        left, was = rest @ rest, left
        along = rest + left / was * along
    return b


def _elastic_net(times, c: np.ndarray, l1: float, l2: float, steps: int, tol: float) -> np.ndarray:
    x = np.random.default_rng(0).normal(size=len(c)) * (c != 0.0)
    most = 1.0
    for _ in range(30):
        size = np.linalg.norm(x)
        if size == 0.0:
            break
        x = times(x / size)
        most = max(most, np.linalg.norm(x))
    bound = 1.1 * most + l2
    b = _ridge(times, c, l1 + l2, 100, tol)  # a near start
    z, t = b, 1.0
    for _ in range(steps):
        to = z - (times(z) + l2 * z - c) / bound
        new = np.sign(to) * np.maximum(np.abs(to) - l1 / bound, 0.0)
        if (z - new) @ (new - b) > 0.0:  # the momentum leads uphill
            z, t = new, 1.0
        else:
            after = (1.0 + math.sqrt(1.0 + 4.0 * t * t)) / 2.0
            z, t = new + (t - 1.0) / after * (new - b), after
        moved, b = np.abs(new - b).max(), new
        if moved <= tol * max(np.abs(b).max(), 1e-300):
            break
    return b
