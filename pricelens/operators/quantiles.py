"""Exact quantiles (linear interpolation between order statistics) at any size.

A mergeable sketch (``percentile_approx``, rank error at most n / ACCURACY)
brackets the wanted ranks of every group in a first pass.  A second pass counts
the values below each bracket and collapses those inside to (value, count):
a few ten-thousandths of the rows, whatever their number.  Only these are
range-partitioned by (group, value) into bounded ranges, in which running totals pick the
order statistics.  No task ever holds a whole group, a hot value is one
(value, count) row, and nothing but one row without groups passes through the driver.

The position of quantile ``p`` among ``n`` values is ``p·(n−1)`` (0-based), as
in Spark's ``percentile`` and SQL's ``quantile_cont``/``percentile_cont``.
``method="ranked"`` does without the sketch and ranges all values;
``method="aggregate"`` is Spark's one-pass ``percentile`` for callers that know
a group has few distinct values.  Neither is ever chosen by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# (value, count) rows per range.
ROWS_PER_RANGE = 200_000
# The sketch's rank error is n / ACCURACY; a bracket reaches one of WIDTHS (shares of n) to both sides, the
# least that covers that error twice and two more values.
ACCURACY = 10_000
WIDTHS = [3.0 / ACCURACY, 1e-3, 1e-2, 0.1, 1.0]


def _base(df: DataFrame, col: str, keys) -> DataFrame:
    # Adding 0.0 makes -0.0 and 0.0 one value.
    return df.filter(F.col(col).isNotNull()).select(*keys, (F.col(col).cast("double") + F.lit(0.0)).alias("v"))


def exact_quantiles(df: DataFrame, col: str, probs, by=None, method: str = "bracketed") -> DataFrame:
    """``(by…, p, value)`` for every group and probability; groups without a value have none."""
    keys = list(by or [])
    probs = [float(p) for p in probs]
    base = _base(df, col, keys)
    if method == "aggregate":
        arr = F.array(*[F.lit(p) for p in probs])
        q = base.groupBy(*keys).agg(F.percentile("v", arr).alias("q"))
        z = q.select(*keys, F.explode(F.arrays_zip(arr.alias("p"), F.col("q").alias("value"))).alias("z"))
        return z.select(*keys, F.col("z.p").alias("p"), F.col("z.value").alias("value"))
    if method == "bracketed":
        return _bracketed(base, keys, probs)
    if method != "ranked":
        raise ValueError(f"unknown quantile method {method!r}")
    counted = cut_lineage(base.groupBy(*keys, F.lit(0).alias("i"), "v").agg(F.count(F.lit(1)).alias("c")))
    wanted = F.explode(F.array(*[F.lit(p) for p in probs]))
    targets = counted.groupBy(*keys, "i").agg(F.sum("c").alias("n")).withColumn("p", wanted).withColumn("below", F.lit(0).cast("long"))
    return _picked(counted, [*keys, "i"], targets, keys)


def _bracketed(base: DataFrame, keys, probs) -> DataFrame:
    asked = [(p, d, side) for p in probs for d in WIDTHS for side in (-1, 1)]
    shares = [min(max(p + side * d, 0.0), 1.0) for p, d, side in asked]
    sketch = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"),
                                     F.percentile_approx("v", shares, ACCURACY).alias("s"))
    width = F.lit(len(WIDTHS) - 1)
    for k in reversed(range(len(WIDTHS) - 1)):
        width = F.when(F.lit(WIDTHS[k]) >= F.lit(2.0 / ACCURACY) + F.lit(2.0) / F.col("n"), F.lit(k)).otherwise(width)
    at = lambda i, side: F.element_at("s", F.lit(2 * len(WIDTHS) * i + 1 + side) + 2 * F.col("width"))
    brackets = [F.struct(F.lit(i).alias("i"), F.lit(p).alias("p"),
                         F.when(F.lit(p) - _share() <= 0, F.col("least")).otherwise(at(i, 0)).alias("low"),
                         F.when(F.lit(p) + _share() >= 1, F.col("most")).otherwise(at(i, 1)).alias("high")) for i, p in enumerate(probs)]
    bounds = cut_lineage(sketch.where("n > 0").withColumn("width", width).select(*keys, "n", F.array(*brackets).alias("b")))
    # Values below a bracket are one row with a null value; those inside are collapsed, those above don't count.
    if keys:
        rows = base.alias("x").join(bounds.alias("y"), [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]).select(
            *[F.col(f"x.{k}").alias(k) for k in keys], "v", "b")
    else:
        only = bounds.collect()
        rows = base.where("false").select("v", F.lit(None).cast(bounds.schema["b"].dataType).alias("b")) if not only else base.select(
            "v", F.array(*[F.struct(F.lit(r.i).alias("i"), F.lit(r.p).alias("p"), F.lit(r.low).alias("low"), F.lit(r.high).alias("high")) for r in only[0].b]).alias("b"))
    cells = rows.select(*keys, "v", F.explode("b").alias("b")).where("v <= b.high")
    inside = F.when(F.col("v") >= F.col("b.low"), F.col("v"))
    counted = cut_lineage(cells.groupBy(*keys, F.col("b.i").alias("i"), inside.alias("v")).agg(F.count(F.lit(1)).alias("c")))
    below = counted.where("v is null").select(*keys, "i", F.col("c").alias("below"))
    wanted = bounds.select(*keys, "n", F.explode("b").alias("b")).select(*keys, "n", "b.i", "b.p")
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"z.{k}")) for k in [*keys, "i"]]
    targets = wanted.alias("w").join(below.alias("z"), same, "left").select(
        *[F.col(f"w.{k}").alias(k) for k in [*keys, "i"]], "w.n", "w.p", F.coalesce("z.below", F.lit(0).cast("long")).alias("below"))
    return _picked(counted.where("v is not null"), [*keys, "i"], targets, keys)


def _share():
    return F.element_at(F.array(*[F.lit(w) for w in WIDTHS]), F.col("width") + 1)


def _picked(counted: DataFrame, keys, targets: DataFrame, out_keys) -> DataFrame:
    """(out_keys…, p, value) from (keys…, v, c) rows and (keys…, n, p, below): wanted ranks count the ``below`` values not in the rows."""
    ranges = max(1, math.ceil(counted.count() / ROWS_PER_RANGE))
    ranged = cut_lineage(counted.repartitionByRange(ranges, *keys, "v").withColumn("rid", F.spark_partition_id()))
    same = lambda a, b, names: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in names]

    # One row per (group, range): where the range begins in its group, and the ranks wanted there.
    group = Window.partitionBy(*keys)
    totals = ranged.groupBy(*keys, "rid").agg(F.sum("c").alias("s"))
    starts = totals.withColumn("start", F.sum("s").over(group.orderBy("rid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("s"))
    small = targets.withColumn("pos", F.col("p") * (F.col("n") - 1)) \
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))))
    wanted = starts.alias("a").join(small.alias("t"), same("a", "t", keys)) \
        .withColumn("start", F.col("a.start") + F.col("t.below")) \
        .where("t.rank >= start and t.rank < start + a.s") \
        .select(*[F.col(f"a.{k}").alias(k) for k in keys], "a.rid", "start", "t.p", "t.pos", "t.rank")

    # A running count in the ranges that hold a wanted rank, each at most ROWS_PER_RANGE rows.
    inside = Window.partitionBy(*keys, "rid").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    hit = ranged.alias("a").join(wanted.select(*keys, "rid").distinct().alias("b"), same("a", "b", [*keys, "rid"]), "left_semi") \
        .withColumn("upto", F.sum("c").over(inside))
    found = hit.alias("a").join(wanted.alias("w"), same("a", "w", [*keys, "rid"])) \
        .where("w.rank - w.start >= a.upto - a.c and w.rank - w.start < a.upto") \
        .select(*[F.col(f"a.{k}").alias(k) for k in keys], "w.p", "w.pos", "w.rank", "a.v")
    at = lambda rank: F.max(F.when(F.col("rank") == rank, F.col("v")))
    ends = found.groupBy(*keys, "p", "pos").agg(at(F.floor("pos")).alias("lo"), at(F.ceil("pos")).alias("hi"))
    between = (F.ceil("pos") - F.col("pos")) * F.col("lo") + (F.col("pos") - F.floor("pos")) * F.col("hi")
    return ends.select(*out_keys, "p", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between).alias("value"))


def quantile_row(q: DataFrame, probs, keys=()) -> DataFrame:
    """Pivot ``(by…, p, value)`` into one column per probability (``q0``, ``q1`` …)."""
    keys = list(keys)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(f"q{i}") for i, p in enumerate(probs)]
    return q.groupBy(*keys).agg(*aggs)
