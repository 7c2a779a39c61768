"""Prefix trie of rebuilt conversations: brute force over whole sequences, the monoid, the proof of equality, edge cases."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pricelens.llm import tries

TURNS = "conv_id long, turn long, role string, text string"


def reference(role, text):
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return h(h(role) + h(text))


def brute(rows):
    """The contract read literally: every rebuilt sequence, every prefix of it as a tuple."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, reference(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children = {}
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    below = {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = children.get(p, [])
        saved = (len(nodes[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below[p] = (sum(below[k][0] for k in kids) if kids else 1, saved + sum(below[k][1] for k in kids))
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children.get(p, [])), *below[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def built(spark, rows, parts=4, **kw):
    df = spark.createDataFrame(rows, TURNS).repartition(parts)
    return sorted(map(tuple, tries.trie_digest(tries.build_trie(df, tries.fifth_heads, **kw)).collect()), key=str)


def some_rows(seed, convs, texts=3, longest=14):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["a", "é long", "b\n", ""][:texts]))
            for c in range(convs) for t in range(rnd.randint(1, longest))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = some_rows(seed, 60, texts=2)
    assert built(spark, rows) == brute(rows)


def test_nulls_ties_repeats_missing_bases_and_a_hot_conversation(spark):
    rows = [(7, None, None, None), (7, None, "user", "x"), (7, 3, "user", "tie"), (7, 3, "user", "also"), (7, 3, "user", "also"), (None, 1, "user", "x"),
            (5, 0, "user", "x"), (123, 0, "user", "x"), (124, 9, "user", "x")]
    rows += [(10, t, "user", f"t{t % 5}") for t in range(300)] + [(c, t, "user", f"t{t % 5}") for c in range(11, 20) for t in range(3)]
    assert built(spark, rows) == brute(rows)


def test_copies_share_one_path_and_all_end_there(spark):
    rows = [(5 * c, t, "user", "x" * 40) for c in range(120) for t in range(2)]
    got = built(spark, rows)
    assert got == brute(rows) and len(got) == 3


def test_an_empty_table_has_no_nodes_and_other_columns_are_not_read(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], TURNS).select("*", F.lit(1).alias("depth"), F.lit("y").alias("CONV_ID"))
    trie = tries.build_trie(df, tries.fifth_heads)
    assert [r.depth for r in tries.trie_digest(trie).collect()] == [0] if zlib.crc32(b"1") % 9 else True
    assert tries.trie_digest(tries.build_trie(df.limit(0), tries.fifth_heads)).collect() == []
    assert [tuple(r)[1:] for r in trie.turns.collect()] == [("user", "x")]


def test_monoid_is_associative_and_parts_are_recovered():
    m, rnd = tries.Monoid(), random.Random(3)
    refs = [rnd.randbytes(32) for _ in range(9)]

    def total(some):
        s = 0
        for r in some:
            s = m.join(s, 1, m.turn(r))
        return s

    for i in range(10):
        assert m.join(total(refs[:i]), 9 - i, total(refs[i:])) == total(refs)
        assert m.after(total(refs), total(refs[:i]), 9 - i) == total(refs[i:])
    assert m.parent(total(refs), refs[-1]) == total(refs[:-1])
    assert total(refs) != total(refs[::-1])


def test_weak_fingerprints_are_found_out_and_drawn_again(spark):
    rows = some_rows(4, 40, texts=3, longest=6)
    with pytest.raises(RuntimeError):
        built(spark, rows, prime=7, seeds=2)
    assert built(spark, rows, prime=1_000_003, seeds=4) == brute(rows)


def test_digests_are_joined_over_runs(spark):
    ends = spark.range(1_000).select(F.lit(1).cast("long").alias("depth"), F.lit(b"x").alias("fp"), F.col("id").alias("conv_id")).repartition(7)
    rows = tries.end_digests(ends, most=16).collect()
    assert [r.ends_sha256 for r in rows] == [hashlib.sha256(",".join(map(str, range(1_000))).encode()).hexdigest()]
