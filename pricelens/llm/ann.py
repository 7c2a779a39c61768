"""Nearest neighbours by stable random projections, a kd-tree over them and a chi-square stopping test.

Vectors are projected to a few Gaussian directions.  For two points at
distance d the squared projected distance over d**2 is chi-square distributed,
so once all points within projected radius R have been verified, a point that
is nearer than d was missed with a chance of at most 1 - CDF(R**2 / d**2).
Search verifies projected neighbours outwards until, for d = distance of the
k-th best so far, that CDF reaches ``sure``.

Largest inner product becomes smallest distance by one more component:
sqrt(M**2 - |x|**2) for a row (M = largest norm), 0 for a query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, written

SEED = 20_240
#: Leaves of the tree that every task knows, as boxes; larger tables have larger leaves, in more blocks each.
MOST_LEAVES = 4_096


def chi2_cdf(x: float, m: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi2_quantile(p: float, m: int) -> float:
    low, high = 0.0, 10.0 * m + 100.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, m) < p else (low, mid)
    return high


def kd_splits(points: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """A complete kd-tree of about ``leaves`` leaves as (axis, value) per inner node in heap order."""
    depth = max(0, math.ceil(math.log2(max(1, leaves))))
    out: list[tuple[int, float]] = []
    level = [points]
    for _ in range(depth):
        below = []
        for part in level:
            axis = int(part.var(axis=0).argmax()) if len(part) else 0
            value = float(np.median(part[:, axis])) if len(part) else 0.0
            out.append((axis, value))
            left = part[:, axis] <= value if len(part) else np.zeros(0, bool)
            below += [part[left], part[~left]]
        level = below
    return out


def kd_leaf(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    """Leaf number of each point."""
    node, depth = np.zeros(len(points), dtype=np.int64), (len(splits) + 1).bit_length() - 1
    axes, values = np.array([a for a, _ in splits], int), np.array([v for _, v in splits], float)
    for _ in range(depth):
        right = points[np.arange(len(points)), axes[node]] > values[node]
        node = 2 * node + 1 + right
    return node - len(splits)


class KdTree:
    """Static kd-tree of one block of points: leaves of at most ``leaf`` points as runs of ``order``, with their boxes."""

    def __init__(self, points: np.ndarray, leaf: int = 128):
        order, runs, stack = np.arange(len(points)), [], [(0, len(points))]
        while stack:
            a, b = stack.pop()
            part = points[order[a:b]]
            if b - a <= leaf:
                runs.append((a, b, part.min(axis=0), part.max(axis=0)))
                continue
            mid, axis = (b - a) // 2, int(np.ptp(part, axis=0).argmax())
            order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
            stack += [(a, a + mid), (a + mid, b)]
        self.order = order
        self.begin, self.end = np.array([r[0] for r in runs]), np.array([r[1] for r in runs])
        self.low, self.high = np.array([r[2] for r in runs]), np.array([r[3] for r in runs])

def incremental_search(tree: KdTree, proj: np.ndarray, vecs: np.ndarray, first: np.ndarray, q_proj: np.ndarray, q: np.ndarray,
                       k: int, reach: float, offset: np.ndarray, kth: np.ndarray, at_once: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows found among those of a block, for many queries at a time, best first.

    Each query takes leaves outwards from its place in projected space, ``at_once``
    a step, and its points there are verified by the exact inner product; its search ends once its next
    leaf lies beyond the radius at which the stopping test holds for the k-th
    best score known (``kth``, from elsewhere, or found here).  The squared
    distance of a score s is offset - 2 s; the test's radius squared is
    ``reach`` times that.  Ties go to the smaller id (``first``).  In a step, the
    queries that take the same leaf share matrix products: of projections, for
    the distances, and of vectors, for scores that can still count; those that do are then computed exactly.
    """
    away = np.stack([(np.maximum(lo - q_proj, 0) + np.maximum(q_proj - hi, 0)) ** 2 for lo, hi in zip(tree.low, tree.high)], 1).sum(axis=2)
    order = np.argsort(away, axis=1, kind="stable")
    kth = kth.copy()
    stop = reach * np.maximum(0.0, offset - 2 * kth)
    q_norm, p_norm = (q_proj * q_proj).sum(axis=1), (proj * proj).sum(axis=1)
    slack = 1e-9 * (1.0 + np.abs(q).max(initial=0.0) * np.abs(vecs).max(initial=0.0) * vecs.shape[1])
    near = 1e-9 * (1.0 + q_norm.max(initial=0.0) + p_norm.max(initial=0.0))
    best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    active = np.arange(len(q))
    for step in range(0, len(tree.begin), at_once):
        active = active[away[active, order[active, step]] <= stop[active]]
        if not len(active):
            break
        taken, found = order[active, step:step + at_once], [best]
        for leaf in np.unique(taken):
            who = active[(taken == leaf).any(axis=1)]
            rows = tree.order[tree.begin[leaf]:tree.end[leaf]]
            gap = q_norm[who, None] + p_norm[rows][None, :] - 2 * (q_proj[who] @ proj[rows].T)
            good = (gap <= stop[who, None] + near) & (q[who] @ vecs[rows].T >= kth[who, None] - slack)
            a, b = np.nonzero(good)
            if len(a):
                a, b = who[a], rows[b]
                found.append([a, b, (vecs[b] * q[a]).sum(axis=1)])
        if len(found) > 1:
            best = _k_best(*[np.concatenate(x) for x in zip(*found)], first, k)
            count = np.bincount(best[0], minlength=len(q))
            full = np.flatnonzero(count >= k)
            kth[full] = np.maximum(kth[full], best[2][np.cumsum(count)[full] - 1])
            stop = reach * np.maximum(0.0, offset - 2 * kth)
    return tuple(best)


def _k_best(query: np.ndarray, row: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """The k best of each query, in the order of (query, score descending, id)."""
    order = np.lexsort((first[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    begin = np.searchsorted(query, query, "left")
    keep = np.arange(len(query)) - begin < k
    return [query[keep], row[keep], score[keep]]


def usable_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec array<double>): rows with an id and a finite, non-zero vector of the most common length."""
    rows = pick(vectors, id_col, vec_col).toDF("vec_id", "vec").select(F.col("vec_id").cast("long"),
                                                             F.transform(F.col("vec").cast("array<double>"), lambda x: x + 0.0).alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(fine, F.lit(False)))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, dims: int = 12, sure: float = 0.97, block: int = 4_096,
            queries_at_once: int = 8_192, sample: int = 20_000) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``every`` its k rows of largest inner product.

    Vectors that are null, zero or hold a null, NaN or infinity take no part,
    nor do vectors of another length than the most common (the shorter on
    ties).  A row never answers itself; ids with several vectors are several
    rows, repeated rows count once.  Ties of the score go to the smaller id.

    Equal vectors become one point with its k + 1 smallest ids, which is all
    that can appear in any answer.  The kd-tree over the projections is built
    from about ``sample`` points and splits all points into leaves; a leaf
    larger than ``block`` is dealt over several blocks, so every task holds
    one block and ``queries_at_once`` queries at most.  First each query searches
    one block of its own leaf, which gives a k-th best score; then it visits
    every block that the stopping test at that score doesn't rule out.
    """
    rows = usable_vectors(vectors)
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return rows.sparkSession.createDataFrame([], schema)
    d = sizes[0]["d"]
    rows = rows.where(F.size("vec") == d).withColumn("point", F.xxhash64("vec"))
    ranked = rows.withColumn("nth", F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id")))
    ids = written(ranked.where(F.col("nth") <= k + 1).distinct())
    points = ids.where("nth = 1").select("point", F.col("vec_id").alias("first"), "vec")
    n, longest = points.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).first()
    directions = np.random.default_rng(SEED).standard_normal((d + 1, dims))
    reach = chi2_quantile(sure, dims)

    def project(vecs: np.ndarray, as_rows: bool) -> np.ndarray:
        extra = np.sqrt(np.maximum(0.0, longest - (vecs * vecs).sum(axis=1))) if as_rows else np.zeros(len(vecs))
        return np.hstack([vecs, extra[:, None]]) @ directions

    share = min(1.0, sample / n)
    drawn = points.where(F.pmod("point", F.lit(1 << 30)) < F.lit(math.ceil((1 << 30) * share))).select("vec").toPandas()
    drawn = project(np.array(drawn["vec"].tolist()).reshape(-1, d), True)
    splits = kd_splits(drawn, min(len(drawn) // 16, -(-n // block), MOST_LEAVES))
    leaves = len(splits) + 1
    blocks = max(1, math.ceil(1.25 * n / leaves / block))

    def place(as_rows: bool):
        def run(batches):
            for b in batches:
                vecs = np.array(b.column("vec").to_pylist()).reshape(-1, d)
                p = project(vecs, as_rows)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(kd_leaf(p, splits)), pa.array(list(p), pa.list_(pa.float64()))],
                                                 [*b.schema.names, "leaf", "proj"])
        return run

    block_of = lambda salt: F.pmod(F.hash("point", F.lit(salt)), F.lit(blocks)).cast("long")
    placed = written(points.mapInArrow(place(True), "point long, first long, vec array<double>, leaf long, proj array<double>")
                     .withColumn("block", block_of(1)))
    boxes = placed.groupBy("leaf").agg(*[F.min(F.col("proj")[i]).alias(f"l{i}") for i in range(dims)],
                                       *[F.max(F.col("proj")[i]).alias(f"h{i}") for i in range(dims)]).toPandas()
    leaf_no = boxes["leaf"].to_numpy()
    low, high = (boxes[[f"{x}{i}" for i in range(dims)]].to_numpy() for x in "lh")

    # A vector is asked once, whoever shares it.
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = written(asked.select("point", "vec").distinct().mapInArrow(place(False), "point long, vec array<double>, leaf long, proj array<double>"))
    parts = max(1, math.ceil(1.25 * queries.count() / queries_at_once))
    queries = queries.withColumn("part", F.pmod(F.hash("point", F.lit(2)), F.lit(parts)).cast("long"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) and len(right):
            vecs, proj = np.array(right["vec"].tolist()), np.array(right["proj"].tolist())
            first, point = right["first"].to_numpy(), right["point"].to_numpy()
            qs, q_proj = np.array(left["vec"].tolist()), np.array(left["proj"].tolist())
            asked = left["point"].to_numpy()
            query, row, score = incremental_search(KdTree(proj), proj, vecs, first, q_proj, qs, k + 1, reach, longest + (qs * qs).sum(axis=1),
                                                   left["kth"].to_numpy(float))
            return pd.DataFrame({"point": asked[query], "hit": point[row], "first": first[row], "score": score})
        return pd.DataFrame({"point": [], "hit": [], "first": [], "score": []})

    def met(queries: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
        """Every block of points, with the queries sent there, searched as one group."""
        return queries.groupBy(*keys).cogroup(targets.groupBy(*keys)).applyInPandas(search, "point long, hit long, first long, score double")

    none = F.lit(float("-inf"))
    home = queries.withColumn("block", block_of(3)).withColumn("kth", none)
    at_home = written(met(home, placed, ["leaf", "block"]))
    bounds = at_home.groupBy("point").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") > k).select("point", "kth")

    def route(batches):
        for b in batches:
            to = []
            for vec, q, kth in zip(b.column("vec").to_pylist(), b.column("proj").to_pylist(), b.column("kth").to_pylist()):
                gap = np.maximum(low - np.array(q), 0) + np.maximum(np.array(q) - high, 0)
                to.append(leaf_no[(gap * gap).sum(axis=1) <= reach * max(0.0, longest + float(np.dot(vec, vec)) - 2 * kth)].tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to, pa.list_(pa.int64()))], [*b.schema.names, "to"])

    plain = "point long, vec array<double>, proj array<double>, part long, kth double"
    number = lambda most: F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long"))
    routed = queries.select("point", "vec", "proj", "part").join(bounds, "point", "left").withColumn("kth", F.coalesce("kth", none)) \
        .mapInArrow(route, plain + ", to array<long>").withColumn("leaf", F.explode("to")).drop("to").withColumn("block", F.explode(number(blocks)))
    found = met(routed, placed.withColumn("part", F.explode(number(parts))), ["leaf", "block", "part"])
    found = found.union(at_home).distinct()
    best = Window.partitionBy("point").orderBy(F.desc("score"), "first")
    top = written(found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).select("point", "hit", "score"))

    # From vectors to ids: the k + 1 first ids of each asked vector, then for each query id those that aren't itself.
    by_rank = Window.partitionBy("point").orderBy(F.desc("score"), "vec_id")
    expanded = top.join(ids.select(F.col("point").alias("hit"), "vec_id"), "hit").groupBy("point", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("nth", F.row_number().over(by_rank)).where(F.col("nth") <= k + 1).select("point", "vec_id", "score")
    answers = asked.select(F.col("vec_id").alias("query_id"), "point").distinct().join(expanded, "point") \
        .where("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
