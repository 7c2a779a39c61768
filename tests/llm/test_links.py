"""Link counts from blocks of classes: every part size gives the brute-force counts; shingles of a slice equal those word by word."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from pricelens.llm import jaccard


def brute(docs, percent=75):
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    linked = lambda a, b: bool(a & b) and 100 * len(a & b) >= percent * len(a | b)
    return sorted((doc, sum(linked(sets[i], s) for j, s in enumerate(sets) if j != i)) for i, (doc, _) in enumerate(docs))


def copies(seed, groups, of_each):
    rnd, docs = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rnd.randint(0, 90)}" for _ in range(50)]
        for i in range(of_each):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(50)] = f"n{i}"
            docs.append((len(docs), " ".join(w)))
    return docs


@pytest.mark.parametrize("side,shingles", [(1_024, 1 << 21), (7, 1 << 21), (1_024, 300)])
def test_counts_are_those_of_brute_force_whatever_the_parts(spark, monkeypatch, side, shingles):
    monkeypatch.setattr(jaccard, "SIDE", side)
    monkeypatch.setattr(jaccard, "SIDE_SHINGLES", shingles)
    docs = copies(3, 2, 30) + copies(5, 12, 2)
    docs = [(i, t) for i, (_, t) in enumerate(docs)] + [(900, "alone it stands here now"), (901, ""), (902, None)]
    got = sorted((r.doc_id, r.n_links) for r in jaccard.link_counts(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute(docs) and max(n for _, n in got) > 10


def test_overlaps_of_sets():
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 50))).astype(np.int64) for _ in range(14)]
    got = jaccard.overlaps(sets[:9], sets[9:], chunk=16)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[9:]] for a in sets[:9]]


def test_shingles_of_a_slice():
    def one(text, size=5):
        words = (text or "").encode().lower().split()
        h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        if not words:
            return []
        if len(words) < size:
            return jaccard.mixed(np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(words))], np.uint64)).tolist()
        total = h[:len(words) - size + 1].copy()
        for j in range(1, size):
            total = total * jaccard._MULTIPLY + h[j:len(words) - size + 1 + j]
        return np.unique(jaccard.mixed(total)).tolist()

    texts = ["", None, " ", "a b c", "A B\tc D e", "x\x00y z\n\nw q r s", "é Ü 日本 b c D E", "one\x85two three four five six\xa0seven", "a a a a a a a a"]
    assert [s.tolist() for s in jaccard.sets_of(pa.array(texts))] == [one(t) for t in texts]
    assert [s.tolist() for s in jaccard.sets_of(pa.array(texts).slice(3, 4))] == [one(t) for t in texts[3:7]]
    assert jaccard.sets_of(pa.array([], pa.string())) == []
