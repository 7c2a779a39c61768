"""Every job, shuffle and plan of the Jaccard join costs the driver memory and threads, however small the input is."""

import random

import pytest

from pricelens.llm import common, jaccard


def edges_of(spark, pairs, parts=3):
    return spark.createDataFrame(pairs, "u long, v long").repartition(parts)


@pytest.mark.parametrize("pairs", [
    [(2, 1), (3, 1), (5, 4)],
    [(i, i + 1) for i in range(40)],
    [(i, 100) for i in range(40)] + [(200, 201)],
    [(random.Random(i).randrange(60), 60 + random.Random(-i).randrange(60)) for i in range(70)],
])
def test_components(spark, pairs):
    least = {}
    for x in {x for p in pairs for x in p}:
        seen, todo = {x}, [x]
        while todo:
            at = todo.pop()
            for p in pairs:
                if at in p:
                    todo += [y for y in p if y not in seen]
                    seen.update(p)
        least[x] = min(seen)
    got = jaccard.components(edges_of(spark, pairs)).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {x: r for x, r in least.items() if x != r}


def test_stars_need_no_round(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(jaccard, "written", lambda df: tables.append(common.written(df)) or tables[-1])
    assert sorted(jaccard.components(edges_of(spark, [(2, 1), (3, 1), (5, 4)])).collect()) == [(2, 1), (3, 1), (5, 4)]
    assert len(tables) == 1
    assert jaccard.components(edges_of(spark, [(2, 1)]).limit(0)).collect() == []
    assert len(tables) == 2


@pytest.mark.parametrize("edges,settled", [([], True), ([(2, 1), (3, 1)], True), ([(2, 1), (3, 2)], False), ([(3, 1), (3, 2)], False)])
def test_stars_are_told(spark, edges, settled):
    assert jaccard._settled(spark.createDataFrame(edges, "u long, v long")) is settled


def test_jobs_of_the_join(spark):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[i:i + 40]) for i in range(8)] * 2 + [" ".join(reversed(words)), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.sparkContext.setJobGroup("jaccard-join", "the whole join")
    try:
        assert jaccard.link_counts(docs).count() == len(texts)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("jaccard-join"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert 0 < jobs <= 205  # 232 when components took a round to see that they are done, and parts were counted twice


def test_a_skew_join_takes_counts_that_are_known(spark):
    big = common.written(spark.range(3_000).selectExpr("if(id < 2000, 0, id) k", "id"))
    one = spark.range(2_500).selectExpr("id k", "id * 2 m")
    counts = big.groupBy("k").count()
    got = common.skew_join(big, one, ["k"], rows=(3_000, counts))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, common.skew_join(big, one, ["k"]).collect()), key=str)
    assert common.skew_join(big.limit(0), one, ["k"], rows=(0, counts)).count() == 0
