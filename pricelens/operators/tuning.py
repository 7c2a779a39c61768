"""Grid searches that need fewer passes than one fit a point and fold.

* Linear grids: one scan adds up, per fold, the products of all pairs of a
  row's features, label and 1; the training side of a fold is the total less
  the fold, every penalty is solved from it, and the fold's squared error is read off the
  same sums.
* Boosting grids: the first k trees of a longer fit are the fit of k rounds,
  so one fit with the most rounds serves all of them.
* ``out_of_fold``: each training row predicted by the model that did not see its fold.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LABEL

#: Linear grids are solved from their sums up to this many features: (width + 2)^2 / 2 numbers a fold
#: reach the driver, 4 MB at most.  Wider ones are fitted point by point.
MAX_GRAM = 1_024
#: Fits that run side by side take at most so many rows together (a fit caches its rows in a form of its own); one always runs.
ROWS_AT_ONCE = 32_000_000


def width_of(df: DataFrame, features_col: str) -> int:
    """Places of the vectors in a column, 0 for an empty table."""
    raw = F.unwrap_udt(F.col(features_col))
    first = df.where(F.col(features_col).isNotNull()).select(F.coalesce(raw["size"], F.size(raw["values"])).alias("n")).first()
    return first["n"] if first else 0


def sums_per_fold(train: DataFrame, features_col: str, label: str = LABEL, fold: str = "fold") -> dict[int, np.ndarray]:
    """fold → matrix of sums over its rows of the products of (features, 1, label), from one scan with partial sums."""
    w = width_of(train, features_col)
    raw = F.unwrap_udt(F.col(features_col))
    places = F.when(raw["type"] == 0, raw["indices"]).otherwise(F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    cell = lambda i, v: F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))
    own = F.filter(F.zip_with(places, raw["values"], cell), lambda c: c["v"] != 0.0)
    cells = F.concat(own, F.array(cell(F.lit(w), F.lit(1.0)), cell(F.lit(w + 1), F.col(label))))
    pairs = F.flatten(F.transform("z", lambda a, k: F.transform(F.slice("z", k + 1, F.size("z")), lambda b: F.struct(
        a["i"].alias("i"), b["i"].alias("j"), (a["v"] * b["v"]).alias("v")))))
    rows = train.where(F.col(features_col).isNotNull() & F.col(label).isNotNull()).select(F.col(fold).alias("fold"), cells.alias("z"))
    sums = rows.select("fold", F.explode(pairs).alias("p")).groupBy("fold", "p.i", "p.j").agg(F.sum("p.v").alias("v")).toPandas()
    out = {}
    for key, part in sums.groupby("fold"):
        m = np.zeros((w + 2, w + 2))
        i, j, v = part["i"].to_numpy(), part["j"].to_numpy(), part["v"].to_numpy()
        m[i, j] = v
        m[j, i] = v
        out[int(key)] = m
    return out


def solve_linear(sums: np.ndarray, reg: float = 0.0, elastic_net: float = 0.0, sweeps: int = 2_000, tol: float = 1e-10) -> np.ndarray:
    """Coefficients, intercept and -1 (the vector v for which v' sums v is the squared error) of a penalised fit.

    The objective is MLlib's: mean squared error / 2 in units of the label's
    standard deviation plus ``reg`` / that deviation times the penalty on
    coefficients of standardised features; features that never vary get 0.
    Ridge is one linear solve; with an L1 part, coordinate descent.
    """
    w = len(sums) - 2
    n = sums[w, w]
    mean, label_mean = sums[:w, w] / n, sums[w + 1, w] / n
    cov = sums[:w, :w] / n - np.outer(mean, mean)
    cross = sums[:w, w + 1] / n - mean * label_mean
    label_std = math.sqrt(max(sums[w + 1, w + 1] / n - label_mean ** 2, 0.0))
    std = np.sqrt(np.maximum(np.diag(cov), 0.0))
    used = std > 1e-9 * np.maximum(np.abs(mean), 1e-300)
    coefficients = np.zeros(w)
    if used.any() and label_std > 0:
        r = cov[np.ix_(used, used)] / np.outer(std[used], std[used])
        c = cross[used] / (std[used] * label_std)
        penalty = reg / label_std
        if elastic_net == 0.0:
            b = np.linalg.lstsq(r + penalty * np.eye(len(c)), c, rcond=None)[0]
        else:
            b = _coordinate_descent(r, c, penalty * elastic_net, penalty * (1.0 - elastic_net), sweeps, tol)
        coefficients[used] = b * label_std / std[used]
    return np.concatenate([coefficients, [label_mean - mean @ coefficients, -1.0]])


def _coordinate_descent(r: np.ndarray, c: np.ndarray, l1: float, l2: float, sweeps: int, tol: float) -> np.ndarray:
    b, rest = np.zeros(len(c)), c.copy()  # rest = c - r b
    for _ in range(sweeps):
        most = 0.0
        for j in range(len(c)):
            rho = rest[j] + r[j, j] * b[j]
            new = math.copysign(max(abs(rho) - l1, 0.0), rho) / (r[j, j] + l2)
            if new != b[j]:
                rest -= r[j] * (new - b[j])
                most = max(most, abs(new - b[j]))
                b[j] = new
        if most < tol:
            break
    return b


def linear_grid(train: DataFrame, points: list[dict], features_col: str, label: str = LABEL) -> list[list[float]]:
    """RMSE of each point on each fold, from one scan of ``train`` (column ``fold``)."""
    sums = sums_per_fold(train, features_col, label)
    total = sum(sums.values())
    out = []
    for p in points:
        rmse = []
        for held in sums.values():
            v = solve_linear(total - held, p.get("regParam", 0.0), p.get("elasticNetParam", 0.0))
            rmse.append(math.sqrt(max(v @ held @ v, 0.0) / held[-2, -2]))
        out.append(rmse)
    return out


def fold_sides(train: DataFrame, folds: int) -> list[tuple[DataFrame, DataFrame]]:
    return [(train.where(F.col("fold") != k), train.where(F.col("fold") == k)) for k in range(folds)]


def fits_at_once(n_rows: int, parallelism: int) -> int:
    """How many fits of so many rows each may run side by side, ``parallelism`` at most."""
    return max(1, min(parallelism, ROWS_AT_ONCE // max(n_rows, 1)))


def in_parallel(spark: SparkSession, tasks: list, parallelism: int) -> list:
    """Results of functions run ``parallelism`` at a time, in order; each submits its own Spark jobs."""
    from pyspark import inheritable_thread_target
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(lambda f: f(), [inheritable_thread_target(spark)(t) for t in tasks])


def staged_boosting(make, train: DataFrame, points: list[dict], folds: int, parallelism: int = 8) -> list[list[float]]:
    """RMSE of each point on each fold, with one fit for all points that differ in maxIter alone.

    ``make(**params)`` builds the boosting estimator.  The error after k rounds
    is that of the first k trees of the longest fit, whatever comes after them.
    """
    key = lambda p: tuple(sorted((k, v) for k, v in p.items() if k != "maxIter"))
    groups = {}
    for p in points:
        groups.setdefault(key(p), []).append(p["maxIter"])
    sides = fold_sides(train, folds)

    def fit(rest, rounds, side):
        def run():
            model = make(**dict(rest), maxIter=max(rounds)).fit(side[0])
            return [math.sqrt(e) for e in model.evaluateEachIteration(side[1], "squared")]
        return run

    jobs = [(k, i) for k in groups for i in range(folds)]
    errors = dict(zip(jobs, in_parallel(train.sparkSession, [fit(k, groups[k], sides[i]) for k, i in jobs], parallelism)))
    return [[errors[key(p), i][p["maxIter"] - 1] for i in range(folds)] for p in points]


def out_of_fold(make, train: DataFrame, folds: int, keep: list[str], parallelism: int = 3, sums=None) -> DataFrame:
    """``keep``, ``fold`` and ``prediction`` of every training row, by the model fitted on the other folds (with ``sums``, solved from them)."""
    sides = fold_sides(train, folds)
    if sums is not None:
        models = [sums.model(make(), k) for k in range(folds)]
    else:
        models = in_parallel(train.sparkSession, [lambda s=s: make().fit(s[0]) for s in sides], parallelism)
    tables = [m.transform(held).select(*keep, "fold", "prediction") for m, (_, held) in zip(models, sides)]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
