"""Ranked search: brute force over whole texts, index rows, bounds, edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelens.llm import ranked

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(ranked.TERM, (text or "").translate(LOWER))


def brute(docs, items, k=10):
    """The contract read literally."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, parts=4, block_terms=1 << 18, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    index = ranked.build_index(d, block_terms)
    return sorted(map(tuple, ranked.search(index, spark.createDataFrame(items, "item_id long, text string"), **kw).collect()), key=str)


def some_text(rnd, longest):
    return " ".join(rnd.choice(["a", "the", "Émile", "x9", "of", "Zebra", "b-c", "日本"] + [f"w{i}" for i in range(40)]) for _ in range(rnd.randint(0, longest)))


@pytest.mark.parametrize("seed,block_terms,query_terms", [(1, 1 << 18, 1 << 17), (2, 60, 25)])
def test_equals_brute_force(spark, seed, block_terms, query_terms):
    rnd = random.Random(seed)
    docs = [(i, some_text(rnd, 60)) for i in range(150)]
    items = [(i, some_text(rnd, 12)) for i in range(12)]
    assert found(spark, docs, items, block_terms=block_terms, query_terms=query_terms) == brute(docs, items)


def test_copies_ties_nulls_repeats_and_long_texts(spark):
    docs = [(i, "same words here") for i in range(200, 100, -1)] + [(None, "same words here"), (3, None), (4, ""), (5, "-- ..."), (5, "same"), (5, "same"),
                                                                    (6, "long tail " * 5_000 + "needle")]
    items = [(1, "same"), (1, "same"), (2, None), (3, "?"), (None, "needle tail"), (4, "absent"), (5, "same same words")]
    assert found(spark, docs, items, block_terms=40) == brute(docs, items)


def test_terms_in_every_document_weigh_nothing_less_than_zero(spark):
    docs = [(i, "all") for i in range(30)]
    assert found(spark, docs, [(1, "all")]) == brute(docs, [(1, "all")])


def test_empty_tables_and_clashing_columns(spark):
    docs, items = [(1, "a b")], [(7, "b")]
    assert found(spark, [(1, None)], items) == [] and found(spark, docs, [(7, None)]) == []
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("m"), F.lit("x").alias("TEXT"), F.lit(2).alias("row"))
    q = spark.createDataFrame(items, "item_id long, text string").select("*", F.lit(1).alias("doc_id"), F.lit(0).alias("score"))
    assert list(map(tuple, ranked.search(ranked.build_index(d), q).collect())) == brute(docs, items)
    assert ranked.search(ranked.build_index(d.limit(0)), q).collect() == []


def test_terms_of_texts():
    texts = ["One two", None, "", "three4five Ünï-code", "--", "end", "x\x00y日本"]
    words, at = ranked.terms_of(pa.array(texts))
    assert list(zip(words.to_pylist(), at.tolist())) == [(w, i) for i, t in enumerate(texts) for w in terms(t)]
    assert ranked.terms_of(pa.array([], pa.string()))[0].to_pylist() == []


def test_bounds_hold_and_spare_visits():
    rnd = random.Random(5)
    rows = [ranked.index_block(25 + 40 * i, list(range(100 * i, 100 * i + 20)), pa.array([some_text(rnd, 30) + " w1" for _ in range(20)])) for i in range(12)]
    queries = ranked.Queries([type("Q", (), {"row": i, "terms": terms(some_text(rnd, 8) + " w1 w1")}) for i in range(6)])
    strata = [ranked.Stratum(r, queries.terms) for r in rows]
    for s in strata:
        s.weigh(np.arange(len(queries.terms)) + 3)
        for q, bound in enumerate(s.bounds(queries)):
            own = slice(queries.begin[q], queries.begin[q + 1])
            assert s.scores(queries.term[own], queries.repeats[own]).max() <= bound
    best = ranked.Best(6, 3)
    assert ranked.visit(strata, queries, best) < 6 * len(strata)
    for q in range(6):
        own = slice(queries.begin[q], queries.begin[q + 1])
        every = sorted((-int(x), int(d)) for s in strata for x, d in zip(s.scores(queries.term[own], queries.repeats[own]), s.doc_ids) if x > 0)
        assert [(-int(a), int(b)) for a, b in zip(best.score[q], best.doc[q])] == every[:3]
