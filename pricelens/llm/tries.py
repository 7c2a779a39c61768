"""Prefix trie of rebuilt conversations, found by composable fingerprints.

A turn is the affine map x -> B x + t modulo a prime, t taken from the hash of
its role and text.  Maps compose to maps, so a run of turns is the pair
(length, sum), and the runs of a conversation that lie in different tasks, or
the head of one conversation and the tail of another, are combined as numbers:

    (n, s) then (m, u)  =  (n + m, s B^m + u).

No rebuilt conversation is ever written out.  A turn is stored once, under its
reference (a SHA-256 over role and text); paths hold references, and the
groups of equal fingerprints are proved equal through them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import release

from .common import pick, skew_join, written

PRIME = (1 << 127) - 1
ROOT = bytes(16)
NODE = ["depth", "fp"]


_power = lru_cache(maxsize=1 << 16)(pow)


class Monoid:
    """Runs of turns as (length, sum) for one prime and one base, drawn by ``seed``."""

    def __init__(self, prime: int = PRIME, seed: int = 0):
        self.prime = prime
        self.base = 2 + int.from_bytes(hashlib.sha256(b"turns %d" % seed).digest(), "big") % (prime - 2)
        self.back = pow(self.base, -1, prime)

    def turn(self, ref: bytes) -> int:
        return int.from_bytes(ref, "big") % self.prime

    def power(self, n: int) -> int:
        return _power(self.base, n, self.prime)

    def join(self, first: int, n: int, then: int) -> int:
        """Sum of a run followed by a run of ``n`` turns."""
        return (first * self.power(n) + then) % self.prime

    def after(self, whole: int, first: int, n: int) -> int:
        """Sum of the last ``n`` turns of a run whose other turns have the sum ``first``."""
        return (whole - first * self.power(n)) % self.prime

    def parent(self, whole: int, ref: bytes) -> int:
        """Sum of a run without its last turn."""
        return (whole - self.turn(ref)) * self.back % self.prime


def number(raw: bytes | None) -> int:
    return int.from_bytes(raw or b"", "big")


def raw(n: int) -> bytes:
    return n.to_bytes(16, "big")


@dataclass
class Trie:
    """``nodes`` (depth, fp, parent_fp, ref, n_bytes, conv_id, n_convs, n_children, n_leaves, saved_tokens), the nodes'
    ``ends`` (depth, fp, conv_id: conversations whose last turn it is), and ``turns`` (ref, role, text)."""

    nodes: DataFrame
    ends: DataFrame
    turns: DataFrame


def stored_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): conv_id, turn, ref, n_bytes, row of every turn; ref, role, text of every different one.

    Nulls of role and text become empty; rows without conv_id are left out.
    A reference that stands for two texts raises an error.
    """
    cells = pick(turns, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ref = F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.sha2("text", 256)), 256))
    cells = cells.withColumn("ref", ref)
    rows = written(cells.select("conv_id", "turn", "ref", F.octet_length("text").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")))
    both = F.struct("role", "text")
    texts = written(cells.groupBy("ref").agg(F.min(both).alias("least"), F.max(both).alias("most")))
    if texts.where("least != most").limit(1).count():
        raise ValueError("one reference stands for two different turns")
    return rows, texts.select("ref", "least.role", "least.text")


def prefix_sums(rows: DataFrame, monoid: Monoid) -> DataFrame:
    """conv_id, at (1, 2, ...), sum (of the turns up to it), ref, n_bytes of every turn in its conversation's order.

    The order is (turn, null first; ref; row).  The rows are dealt by ranges of
    it, so a conversation of any size is spread over tasks; each task sums its own
    runs, and a run that goes on from earlier tasks is joined to the sums
    of those (at most one such run a task).
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "ref", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "ref", "n_bytes")
    local = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("k", pa.int64()), ("s", pa.binary()), ("ref", pa.binary()), ("n_bytes", pa.int64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, k, s = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            ks, sums = [], []
            for conv, ref in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if conv != last:
                    last, k, s = conv, 0, 0
                k, s = k + 1, monoid.join(s, 1, monoid.turn(ref))
                ks.append(k)
                sums.append(raw(s))
            yield pa.RecordBatch.from_arrays([pa.array([part] * b.num_rows, pa.int32()), b.column(0), pa.array(ks, pa.int64()),
                                              pa.array(sums, pa.binary()), b.column(1), b.column(2)], schema=local)

    table = written(dealt.mapInArrow(scan, "part int, conv_id long, k long, s binary, ref binary, n_bytes long"))
    runs = table.groupBy("part", "conv_id").agg(F.max(F.struct("k", "s")).alias("run"))
    split = runs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "run.k", "run.s"))).alias("runs")).where("size(runs) > 1")
    carry = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("before", pa.int64()), ("sum_before", pa.binary())])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, s = own[0]["k"], number(own[0]["s"])
                for run in own[1:]:
                    out.append((run["part"], conv, n, raw(s)))
                    n, s = n + run["k"], monoid.join(s, run["k"], number(run["s"]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(carry)], schema=carry)

    before = written(split.mapInArrow(carried, "part int, conv_id long, before long, sum_before binary"))
    whole = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("sum", pa.binary()), ("ref", pa.binary()), ("n_bytes", pa.int64())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, sums = [], []
            for k, s, n, first in zip(*(b.column(i).to_pylist() for i in (1, 2, 5, 6))):
                at.append(k + (n or 0))
                sums.append(raw(monoid.join(number(first), k, number(s))) if n else s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at, pa.int64()), pa.array(sums, pa.binary()), b.column(3), b.column(4)], schema=whole)

    joined = table.join(F.broadcast(before), ["part", "conv_id"], "left")  # at most one row of ``before`` a part
    sums = written(joined.select("conv_id", "k", "s", "ref", "n_bytes", "before", "sum_before")
                   .mapInArrow(fold, "conv_id long, at long, sum binary, ref binary, n_bytes long"))
    release(table)
    release(before)
    return sums


def rebuilt_paths(sums: DataFrame, splice, monoid: Monoid) -> DataFrame:
    """conv_id, depth, fp, parent_fp, ref, n_bytes, is_end: every prefix of every rebuilt conversation, the empty one included.

    ``splice`` adds base_id and head to a table of conv_id: the rebuilt conversation
    is the first ``head`` turns of base_id (all if fewer, none if absent) and
    then conv_id's own turns after its first ``head``.  Rows grow with the turns
    plus the sum of the heads.
    """
    sizes = written(sums.groupBy("conv_id").agg(F.count("*").alias("n_own")))
    convs = splice(sizes).select("conv_id", F.col("base_id").cast("long"), F.col("head").cast("long"), "n_own")
    bases = sizes.select(F.col("conv_id").alias("base_id"), F.col("n_own").alias("n_base"))
    convs = skew_join(written(convs), bases, ["base_id"]).withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0).cast("long"))))
    cut = lambda n, at, s: sums.select(F.col("conv_id").alias(n), F.col("at").alias(at), F.col("sum").alias(s))
    convs = convs.join(cut("conv_id", "head", "own_head"), ["conv_id", "head"], "left")
    convs = written(skew_join(written(convs), cut("base_id", "taken", "base_head"), ["base_id", "taken"])
                    .select("conv_id", "base_id", "head", "taken", "n_own", "own_head", "base_head"))
    zero = F.lit(0).cast("long")
    own = skew_join(sums, convs, ["conv_id"]).where("at > head").select(
        "conv_id", "at", "sum", "ref", "n_bytes", "head", "taken", "own_head", "base_head", (F.col("at") == F.col("n_own")).alias("is_end"))
    steps = convs.where("taken > 0").select(
        "conv_id", "base_id", F.explode(F.sequence(zero + 1, "taken")).alias("at"), ((F.col("n_own") <= F.col("head"))).alias("short"), "taken")
    heads = skew_join(written(steps), sums.withColumnRenamed("conv_id", "base_id"), ["base_id", "at"]).select(
        "conv_id", "at", "sum", "ref", "n_bytes", zero.alias("head"), zero.alias("taken"), F.lit(None).cast("binary").alias("own_head"),
        F.lit(None).cast("binary").alias("base_head"), (F.col("short") & (F.col("at") == F.col("taken"))).alias("is_end"))
    sql = "conv_id long, depth long, fp binary, parent_fp binary, ref binary, n_bytes long, is_end boolean"
    arrow = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("fp", pa.binary()), ("parent_fp", pa.binary()), ("ref", pa.binary()),
                       ("n_bytes", pa.int64()), ("is_end", pa.bool_())])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            depths, fps, parents = [], [], []
            for at, s, ref, head, taken, own_head, base_head in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 5, 6, 7, 8))):
                n = at - head
                fp = monoid.join(number(base_head), n, monoid.after(number(s), number(own_head), n))
                depths.append(taken + n)
                fps.append(raw(fp))
                parents.append(raw(monoid.parent(fp, ref)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(depths, pa.int64()), pa.array(fps, pa.binary()), pa.array(parents, pa.binary()),
                                              b.column(3), b.column(4), b.column(9)], schema=arrow)

    empty = convs.select("conv_id", zero.alias("depth"), F.lit(ROOT).alias("fp"), F.lit(None).cast("binary").alias("parent_fp"),
                         F.lit(None).cast("binary").alias("ref"), zero.alias("n_bytes"), ((F.col("taken") == 0) & (F.col("n_own") <= F.col("head"))).alias("is_end"))
    return written(own.unionByName(heads).mapInArrow(combine, sql).unionByName(empty))


def subtree_sums(nodes: DataFrame, paths: DataFrame, columns: list[str]) -> DataFrame:
    """depth, fp and the sums of ``columns`` over each node's subtree.

    In round k every node hands what it holds (the sums over its
    descendants less than 2^k below) to its ancestor 2^k above, so the rounds
    are the logarithm of the greatest depth.  The ancestor is found on the path
    of the node's smallest member, by a key that no two rows share.
    """
    sums = written(nodes.select(*NODE, "conv_id", *columns))
    deepest, step = sums.agg(F.max("depth")).first()[0] or 0, 1
    at = paths.select("conv_id", F.col("depth").alias("up"), F.col("fp").alias("up_fp"))
    while step <= deepest:
        up = sums.where(F.col("depth") >= step).withColumn("up", F.col("depth") - step).join(at, ["conv_id", "up"])
        gains = up.groupBy(F.col("up").alias("depth"), F.col("up_fp").alias("fp")).agg(*[F.sum(c).alias(f"more_{c}") for c in columns])
        zero = F.lit(0).cast("long")
        more = sums.join(gains, NODE, "left").select(*NODE, "conv_id", *[(F.col(c) + F.coalesce(f"more_{c}", zero)).alias(c) for c in columns])
        before, sums, step = sums, written(more), 2 * step
        release(before)
    return sums.select(*NODE, *columns)


def _paths_and_nodes(rows: DataFrame, splice, prime: int, seeds: int) -> tuple[DataFrame, DataFrame]:
    for seed in range(seeds):
        monoid = Monoid(prime, seed)
        sums = prefix_sums(rows, monoid)
        paths = rebuilt_paths(sums, splice, monoid)
        release(sums)
        nodes = written(paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent_fp").alias("parent_fp"), F.min("n_bytes").alias("n_bytes"),
            F.min("ref").alias("ref"), F.max("ref").alias("other_ref")))
        if not nodes.where("ref != other_ref").limit(1).count():
            return paths, nodes.drop("other_ref")
        release(paths)
        release(nodes)
    raise RuntimeError(f"prefixes with one fingerprint end in different turns under each of {seeds} bases")


def build_trie(turns: DataFrame, splice, prime: int = PRIME, seeds: int = 4) -> Trie:
    """The trie of all prefixes of the rebuilt conversations (see ``rebuilt_paths``).

    ``turns``: conv_id, turn, role, text; other columns are not read.  A node
    is a different sequence of turns, from the empty one on; conv_id is its
    smallest member, n_convs the number of its members (conversations that begin
    with it), n_children that of nodes one turn longer, n_leaves that of
    childless nodes in its subtree, itself included, and saved_tokens
    the sum over that subtree of (n_convs - 1) times n_bytes, the UTF-8 bytes
    of a node's last text: what storing every prefix once saves.

    Members of a node must all have the same turn reference last; as the
    parent's fingerprint follows from the node's own and that reference, this
    proves whole prefixes equal by induction.  If one base of the fingerprints
    fails the proof, the next is taken, so a result is always right.  Turns of
    equal place are in the order of their references, repeated rows are kept
    each, an empty table has no nodes.
    """
    rows, texts = stored_turns(turns)
    paths, nodes = _paths_and_nodes(rows, splice, prime, seeds)
    zero = F.lit(0).cast("long")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_fp").alias("fp")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero)))
    own = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("n_bytes"))
    sums = subtree_sums(own, paths, ["n_leaves", "saved_tokens"])
    return Trie(nodes.join(sums, NODE), paths.where("is_end").select(*NODE, "conv_id"), texts)


def end_digests(ends: DataFrame, most: int = 1 << 14) -> DataFrame:
    """depth, fp, ends_sha256: SHA-256 of the node's conv_ids in decimal, ascending, comma-joined.

    The ids are dealt by ranges of (node, id) and written as runs of text there,
    so the ids of a node that holds a third of all conversations are sorted
    and joined by many tasks; what is left for one task is to hash the runs in order.
    """
    runs = pa.schema([("depth", pa.int64()), ("fp", pa.binary()), ("part", pa.int32()), ("run", pa.int64()), ("text", pa.string())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, key, ids = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            rows = []
            for depth, fp, conv in zip(*(c.to_pylist() for c in b.columns)):
                if (depth, fp) != key or len(ids) >= most:
                    if ids:
                        rows.append((*key, part, k, ",".join(ids)))
                    key, k, ids = (depth, fp), k + 1, []
                ids.append(str(conv))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(runs)], schema=runs)
        if ids:
            yield pa.RecordBatch.from_pylist([dict(zip(runs.names, (*key, part, k, ",".join(ids))))], schema=runs)

    digest = pa.schema([("depth", pa.int64()), ("fp", pa.binary()), ("ends_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            rows = []
            for depth, fp, text in zip(*(b.column(i).to_pylist() for i in (0, 1, 4))):
                if (depth, fp) == key:
                    state.update(b"," + text.encode())
                    continue
                if state:
                    rows.append((*key, state.hexdigest()))
                key, state = (depth, fp), hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(digest)], schema=digest)
        if state:
            yield pa.RecordBatch.from_pylist([dict(zip(digest.names, (*key, state.hexdigest())))], schema=digest)

    order = [*NODE, "conv_id"]
    texts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "depth long, fp binary, part int, run long, text string")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "part", "run").mapInArrow(hashed, "depth long, fp binary, ends_sha256 string")


def fifth_heads(convs: DataFrame) -> DataFrame:
    """Conversation c begins with the first CRC-32(c in decimal) mod 9 turns of conversation c - c mod 5."""
    return convs.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % 5).withColumn("head", F.crc32(F.col("conv_id").cast("string")) % 9)


def trie_digest(trie: Trie) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    nodes = written(trie.nodes)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("fp").alias("parent_fp"), F.col("conv_id").alias("parent_conv_id"))
    named = skew_join(nodes, parents, ["depth", "parent_fp"])
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return named.join(end_digests(trie.ends), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
