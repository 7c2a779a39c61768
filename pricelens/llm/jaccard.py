"""N-gram Jaccard join by grouped prefixes.

Every document is the set of its distinct word shingles (64-bit hashes).  Sets
are put in one global order, rare shingles first, and two sets of Jaccard
similarity t share a shingle among the first n - ceil(t n) + 1 of each.
Documents with the same set are one class; classes with the same prefix and
size are one group, and only groups meet: by a shared prefix token, within the
bounds on size and position.  Group pairs are then expanded to their classes
and these verified on the whole sets.

``similar_classes`` verifies every pair of classes that groups or prefixes bring
together and returns them all.  Where components are asked for
(``linked_classes``), links are needed only as far as they join
components, and pairs are made in two steps.  ``link_counts`` goes on from there: within a component
every two classes are compared in blocks that give out counts, not pairs.  First, along each token's list of groups, every group meets its
neighbour and the list's head, a linear number of pairs; the links found give
components.  Then all remaining pairs of a list that lie in different
components are verified as well, so that no link between components is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import release

from .common import SHUFFLE_CLEANUP, give_back, lean_worker, pick, session_settings, skew_join, written
from .encode import byte_slices

#: Shingles fall into this many buckets, whose counts over all documents give the order of rarity.
BUCKETS = 1 << 17
#: Bits of the filter that says which classes take part in a pair.
FILTER_BITS = 1 << 24
#: So many partners of a group are verified before components are known.
PARTNERS = 4
#: So many pairs of neighbours, and so many hubs on either side, are tried for two components at each bridging.
BRIDGE, HUBS = 4, 4
#: Classes of one component are compared in blocks of at most so many, and so many shingles, to a side.
SIDE, SIDE_SHINGLES = 1_024, 1 << 19
#: Longer lists of groups are dealt over several keys.
LIST = 256
#: Rows of a batch on its way to a worker.
BATCH_ROWS = 1_000
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: White space parts words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def sets_of(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of every text; each different word of the slice is hashed once."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    if not len(texts):
        return []
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = begins[begins < ends]
    first[at] = inside[at]
    starts = np.flatnonzero(first)
    kept = np.cumsum(inside)
    word_ends = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(word_ends), pa.py_buffer(np.ascontiguousarray(LOWER[data[inside]]))])
    coded = words.dictionary_encode()
    different = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_numpy(zero_copy_only=False).tolist()), np.uint64, len(coded.dictionary))
    hashes = different[coded.indices.to_numpy()]
    total = hashes[:max(len(hashes) - size + 1, 0)].copy()
    for j in range(1, size):
        total = total * _MULTIPLY + hashes[j:len(hashes) - size + 1 + j]
    total = mixed(total)
    cut = np.searchsorted(starts, np.append(begins, ends[-1:]))
    out = []
    for begin, end in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if end - begin >= size:
            out.append(np.unique(total[begin:end - size + 1]))
        elif end > begin:
            out.append(mixed(np.array([xxhash.xxh3_64_intdigest(hashes[begin:end].tobytes(), seed=end - begin)], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def class_of(shingles: np.ndarray) -> int:
    """One number for equal sets."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _scan(batches, size: int):
    """(doc_id column, key column, shingle sets) of each slice of rows (doc_id, key, text).

    The worker is left as small as it can be: it stays beside the shuffles that follow.
    """
    lean_worker()
    for b in byte_slices(batches, 2, 1 << 20):
        yield b.column(0), b.column(1), sets_of(b.column(2), size)
    give_back()


def _survey(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, key, n, class; and per task and bucket the number of shingles, as rows of bucket and n."""
    arrow = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("bucket", pa.int32())])

    def run(batches):
        counts, seen = np.zeros(BUCKETS, dtype=np.int64), set()
        for ids, keys, sets in _scan(batches, size):
            classes = [class_of(s) if len(s) else None for s in sets]
            new = []
            for c, s in zip(classes, sets):
                if c is not None and c not in seen:
                    new.append(s)
                    seen.add(c)
            if len(seen) > 200_000:
                seen.clear()
            if new:
                counts += np.bincount((np.concatenate(new) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "key": keys, "n": [len(s) for s in sets], "class": classes, "bucket": [None] * len(sets)}, schema=arrow)
        used = np.flatnonzero(counts)
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_pydict({"doc_id": none, "key": none, "n": counts[used], "class": none, "bucket": used.astype(np.int32)}, schema=arrow)

    return docs.mapInArrow(run, "doc_id long, key long, n long, class long, bucket int")


def _prefixes(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Per class (once per task): class, group, n, tokens (the prefix in order), light (how many of them aren't frequent)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    arrow = pa.schema([("class", pa.int64()), ("group", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64())), ("light", pa.int32())])

    def run(batches):
        counts, seen = shared.value, set()
        frequent = 8 * counts.mean()
        for _, _, sets in _scan(batches, size):
            rows = []
            for s in sets:
                if not len(s) or (c := class_of(s)) in seen:
                    continue
                seen.add(c)
                often = counts[(s % np.uint64(BUCKETS)).astype(np.int64)]
                order = np.argsort(often, kind="stable")[:prefix_size(len(s), percent)]
                tokens = s[order]
                rows.append((c, int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes(), seed=len(s))).astype(np.int64)), len(s),
                             tokens.view(np.int64), int((often[order] <= frequent).sum())))
            if len(seen) > 200_000:
                seen.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return docs.mapInArrow(run, "class long, group long, n int, tokens array<long>, light int")


def _sets_of(docs: DataFrame, size: int, wanted: DataFrame) -> DataFrame:
    """(class, set) of at least the wanted classes (class, key of one of its texts).

    Which they are goes out as a bit per key value, a filter of fixed size that
    lets some others pass; the join that follows sorts those out.
    """
    bit = f"pmod(key, {FILTER_BITS})"
    rows = wanted.selectExpr(f"cast({bit} div 32 as int) at", f"shiftleft(1, cast({bit} % 32 as int)) bits") \
        .groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 32, dtype=np.int32)
    bits[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int32)
    shared = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint32))
    arrow = pa.schema([("class", pa.int64()), ("set", pa.list_(pa.int64()))])

    def run(batches):
        bits, seen = shared.value, set()

        def passing():
            for b in batches:
                at = b.column(1).to_numpy(zero_copy_only=False) % FILTER_BITS
                yield b.filter(pa.array((bits[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)))

        for _, _, sets in _scan(passing(), size):
            rows = []
            for s in sets:
                if len(s) and (c := class_of(s)) not in seen:
                    seen.add(c)
                    rows.append((c, s.view(np.int64)))
            if len(seen) > 200_000:
                seen.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return docs.mapInArrow(run, "class long, set array<long>").dropDuplicates(["class"])


def _verified(docs: DataFrame, keys: DataFrame, size: int, percent: int, pairs: DataFrame) -> DataFrame:
    """The pairs of classes (a, b) whose whole sets are similar enough, as a written table; ``keys``: class, key."""
    pairs = written(pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = written(keys.join(wanted, "class", "left_semi"))
    sets = written(_sets_of(docs, size, wanted).join(wanted, "class", "left_semi"))
    both = pairs.join(sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), "a") \
        .join(sets.select(F.col("class").alias("b"), F.col("set").alias("set_b")), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    found = written(both.select("a", "b", shared.alias("both"), (F.size("set_a") + F.size("set_b")).alias("sum"))
                    .where(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("sum") - F.col("both"))).select("a", "b"))
    for done in (pairs, wanted, sets):
        release(done)
    return found


def _forest(batches):
    """Edges of one partition as a smaller set that joins the same nodes: (node, smallest node)."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def rows():
        found = [(x, r) for x in list(up) if (r := root(x)) != x]
        up.clear()
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["u", "v"])

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = sorted((root(u), root(v)))
            up[c] = a
        if len(up) > 500_000:
            yield rows()
    yield rows()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v); the root is the smallest node that can be reached.

    Alternating stars: each node hands its larger neighbours to the smallest
    it knows, then all its smaller ones, until only stars are left; rounds grow
    with the logarithm of the longest path.  Each round is written to the
    shared folder.
    """
    now = written(edges.mapInArrow(_forest, "u long, v long").distinct())
    while not _settled(now):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v")))
        before, now = now, written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        release(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _settled(edges: DataFrame) -> bool:
    """Whether the distinct edges (u, v) with v < u are stars: every u has one v, which is no other edge's u."""
    ends = edges.selectExpr("u node", "1 up", "0 down").union(edges.selectExpr("v", "0", "1"))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()


def _needed(a: str, b: str, percent: int):
    """How many shingles two sets of these sizes must share."""
    return F.ceil(F.lit(percent) * (F.col(f"{a}n") + F.col(f"{b}n")) / F.lit(100 + percent) - F.lit(1e-9))


def _sizes_fit(a: str, b: str, percent: int):
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def _first_fits(a: str, b: str, percent: int):
    """As the first shared token: with what follows it on either side, enough shingles can be shared."""
    return F.least(F.col(f"{a}n") - F.col(f"{a}pos"), F.col(f"{b}n") - F.col(f"{b}pos")) >= _needed(a, b, percent)


def _any_fits(a: str, b: str, percent: int):
    """As any shared token: with as many as there can be before and after it, enough shingles can be shared."""
    before = F.least(F.col(f"{a}pos"), F.col(f"{b}pos"))
    return before + F.least(F.col(f"{a}n") - F.col(f"{a}pos"), F.col(f"{b}n") - F.col(f"{b}pos")) >= _needed(a, b, percent)


def _enough_shared(common, a: str, b: str, percent: int):
    """The shared prefix tokens, and all after the prefix that ends first, are enough.

    Shared tokens up to that prefix's end are in both prefixes; the others lie
    behind the prefix of that set, which has ceil(t n) - 1 shingles there.
    """
    behind = lambda x: F.ceil(F.lit(percent) * F.col(f"{x}n") / F.lit(100) - F.lit(1e-9)) - 1
    return common + F.greatest(behind(a), behind(b)) >= _needed(a, b, percent)


def _lists_across(of_group: DataFrame, shared: DataFrame, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, class, root of every class; the token lists that hold several roots), written."""
    placed = written(of_group.join(joined, F.col("class") == F.col("node"), "left")
                     .select("group", "class", F.coalesce("root", "class").alias("root")))
    lists = shared.join(placed.select("group", "root").distinct(), "group").select("token", "pos", "n", "group", "root")
    several = lists.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("token")
    return placed, written(lists.join(several, "token", "left_semi"))


def _classed(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows: doc_id, key, text; members: doc_id, n, class per row; keys: class, key; classes as of ``_prefixes``)."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")
    survey = written(_survey(rows, size))
    members = survey.where("bucket is null").select("doc_id", "n", "class")
    keys = survey.where("class is not null").groupBy("class").agg(F.min("key").alias("key"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    found = survey.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)

    return rows, members, keys, written(_prefixes(rows, size, percent, counts))


def similar_classes(docs: DataFrame, size: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """The whole join: (members: doc_id, n, class per row; pairs: every two classes a < b that are linked, once).

    A link of two rows is their classes' pair, or their common class; copies
    are not paired.  Lists of more than LIST groups are dealt over several
    keys, each of which meets the whole list.
    """
    rows, members, keys, classes = _classed(docs, size, percent)
    of_group = written(classes.select("group", "class").distinct())
    prefix = written(classes.select("group", "n", "tokens").dropDuplicates(["group"]))
    release(classes)
    lists = prefix.select("group", "n", F.posexplode("tokens").alias("pos", "token"))
    parts = lists.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token", F.ceil(F.col("m") / F.lit(LIST)).cast("int").alias("parts"))
    lists = written(lists.join(parts, "token"))
    left, right = (lists.select("token", "parts", *[F.col(c).alias(x + c) for c in ("pos", "n", "group")]) for x in "lr")
    left = left.withColumn("part", F.pmod(F.hash("lgroup"), F.col("parts"))).drop("parts")
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    met = written(left.join(right, ["token", "part"]).where("lgroup < rgroup").where(_sizes_fit("l", "r", percent) & _first_fits("l", "r", percent))
                  .select("lgroup", "ln", "rgroup", "rn").distinct())
    release(lists)
    tokens = prefix.select("group", "tokens")
    close = met.join(tokens.toDF("lgroup", "ltokens"), "lgroup").join(tokens.toDF("rgroup", "rtokens"), "rgroup") \
        .where(_enough_shared(F.size(F.array_intersect("ltokens", "rtokens")), "l", "r", percent)).select("lgroup", "rgroup")
    a, b = of_group.toDF("lgroup", "a"), of_group.toDF("rgroup", "b")
    inside = a.join(b, F.col("lgroup") == F.col("rgroup")).where("a < b").select("a", "b")
    pairs = _verified(rows, keys, size, percent, close.join(a, "lgroup").join(b, "rgroup").select("a", "b").union(inside))
    for done in (met, prefix, of_group):
        release(done)
    return members, pairs


def linked_classes(docs: DataFrame, size: int = 5, percent: int = 75, bridges: int = 1) -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, n, class per row; links: node, root of the classes that are linked); see ``_linked``."""
    _, members, _, links = _linked(docs, size, percent, bridges)
    return members, links


def _linked(docs: DataFrame, size: int, percent: int, bridges: int = 1) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``_components_of``, with the shuffle files of every job inside removed when it is done, counts and collects as well.

    Texts go to the workers BATCH_ROWS at a time, so neither side of the pipe holds Spark's 10,000 of them.
    """
    with session_settings(docs.sparkSession, {SHUFFLE_CLEANUP: "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        return _components_of(docs, size, percent, bridges)


def _components_of(docs: DataFrame, size: int, percent: int, bridges: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rows, members, keys as of ``_classed``; links: node, root of the classes that are linked).

    ``bridges`` is how often, between the two steps, a few pairs of any two
    components that are neighbours in a list are tried, so that components of
    one large group of copies join before all their pairs are looked at; it
    changes the work, not the result.
    """
    rows, members, keys, classes = _classed(docs, size, percent)
    of_group = written(classes.select("group", "class").distinct())
    # A frequent token's list is dealt over 32 lists; their groups meet in the second step.
    tokens = classes.select("group", "n", "light", F.posexplode("tokens").alias("pos", "token")) \
        .select("token", F.when(F.col("pos") < F.col("light"), 0).otherwise(1 + F.pmod("group", F.lit(32))).cast("int").alias("salt"), "pos", "n", "group")
    along = Window.partitionBy("token", "salt").orderBy("pos", "n", "group")
    near = tokens.withColumn("before", F.lag("group").over(along)).withColumn("after", F.lead("group").over(along))
    shared = written(near.where("salt > 0 or before is not null or after is not null").where("before is null or before != `group`")
                     .select("token", "salt", "pos", "n", "group"))

    # Each group meets the head of its list and the two groups before it in the order of their numbers, which is
    # the same in all lists: groups that belong together meet in many lists, and the count tells them.
    by_group = Window.partitionBy("token", "salt").orderBy("group")
    entry = F.struct("pos", "n", "group")
    met = shared.withColumn("head", F.first(entry).over(along)) \
        .withColumn("one", F.lag(entry).over(by_group)).withColumn("two", F.lag(entry, 2).over(by_group)) \
        .withColumn("x", F.explode(F.array_distinct(F.array("head", "one", "two")))).where("x is not null")
    met = met.select("group", "n", "pos", F.col("x.group").alias("xgroup"), F.col("x.n").alias("xn"), F.col("x.pos").alias("xpos")) \
        .where("`group` != xgroup").where(_sizes_fit("", "x", percent) & _any_fits("", "x", percent)) \
        .groupBy(F.least("group", "xgroup").alias("group"), F.greatest("group", "xgroup").alias("xgroup")) \
        .agg(F.count("*").alias("common"), F.max(F.least("n", "xn")).alias("n"), F.max(F.greatest("n", "xn")).alias("xn")) \
        .where(_enough_shared(F.col("common"), "", "x", percent)).select("group", "xgroup", "common")
    # A group's likeliest partners are enough to join most of what belongs together; no other pair is lost, as
    # the last step verifies all that lie in different components.
    likely = Window.partitionBy("group").orderBy(F.desc("common"), "xgroup")
    met = met.withColumn("nth", F.row_number().over(likely)).where(F.col("nth") <= PARTNERS).select("group", "xgroup")
    first = of_group.groupBy("group").agg(F.min("class").alias("class"))
    inside = of_group.join(first.withColumnRenamed("class", "b"), "group").select(F.col("class").alias("a"), "b")
    across = met.join(first.withColumnRenamed("class", "a"), "group") \
        .join(first.select(F.col("group").alias("xgroup"), F.col("class").alias("b")), "xgroup").select("a", "b")
    links = _verified(rows, keys, size, percent, inside.union(across))
    joined = components(links.toDF("u", "v"))

    for draw in range(bridges):
        placed, lists = _lists_across(of_group, shared, joined)
        by_draw = Window.partitionBy("token").orderBy(F.hash("group", F.lit(draw)))
        entry = F.struct("pos", "n", "group", "root")
        near = lists.withColumn("one", F.lag(entry).over(by_draw)).withColumn("two", F.lag(entry, 2).over(by_draw)) \
            .withColumn("x", F.explode(F.array("one", "two"))).where("root != x.root")
        near = near.select("group", "root", "n", "pos", *[F.col(f"x.{c}").alias(f"x{c}") for c in ("group", "root", "n", "pos")]) \
            .where(_sizes_fit("", "x", percent) & _any_fits("", "x", percent)) \
            .groupBy("group", "root", "n", "xgroup", "xroot", "xn").agg(F.count("*").alias("common")) \
            .where(_enough_shared(F.col("common"), "", "x", percent))
        few = Window.partitionBy(F.least("root", "xroot"), F.greatest("root", "xroot")).orderBy(F.desc("common"), "group", "xgroup")
        some = placed.groupBy("group", "root").agg(F.min("class").alias("class"))
        pairs = near.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= BRIDGE) \
            .join(some.withColumnRenamed("class", "a"), ["group", "root"]) \
            .join(some.select(F.col("group").alias("xgroup"), F.col("root").alias("xroot"), F.col("class").alias("b")), ["xgroup", "xroot"])
        # The classes with most links so far lie in the middle of their component, so others are likeliest linked with them.
        degree = links.select(F.col("a").alias("class")).union(links.select(F.col("b").alias("class"))).groupBy("class").agg(F.count("*").alias("degree"))
        central = Window.partitionBy("root").orderBy(F.desc_nulls_last("degree"), "class")
        hubs = written(placed.select("root", "class").distinct().join(degree, "class", "left").withColumn("nth", F.row_number().over(central))
                       .where(F.col("nth") <= HUBS).select("root", "class"))
        meet = near.select(F.least("root", "xroot").alias("r"), F.greatest("root", "xroot").alias("x")).distinct()
        by_hubs = meet.join(hubs.toDF("r", "a"), "r").join(hubs.toDF("x", "b"), "x").select("a", "b")
        found = _verified(rows, keys, size, percent, pairs.select("a", "b").union(by_hubs))
        before, links = links, written(links.union(found))
        joined_before, joined = joined, components(links.toDF("u", "v"))
        for done in (hubs, placed, lists, before, found, joined_before):
            release(done)

    # The rest: all pairs of groups in different components, then of their classes there.
    placed, lists = _lists_across(of_group, shared, joined)
    spots = placed.select("group", "root").distinct()
    left, right = (lists.select("token", *[F.col(c).alias(x + c) for c in ("pos", "n", "group", "root")]) for x in "lr")
    cross = written(left.join(right, "token").where("lroot < rroot").where(_sizes_fit("l", "r", percent) & _first_fits("l", "r", percent))
                    .select("lgroup", "lroot", "ln", "rgroup", "rroot", "rn").distinct())
    wanted = cross.select(F.col("lgroup").alias("group")).union(cross.select("rgroup")).distinct()
    prefix = written(classes.select("group", "tokens").join(wanted, "group", "left_semi").dropDuplicates(["group"]))
    release(classes)
    cross = cross.join(prefix.toDF("lgroup", "ltokens"), "lgroup").join(prefix.toDF("rgroup", "rtokens"), "rgroup") \
        .where(_enough_shared(F.size(F.array_intersect("ltokens", "rtokens")), "l", "r", percent)).select("lgroup", "lroot", "rgroup", "rroot")
    cross = cross.union(spots.select(F.col("group").alias("lgroup"), F.col("root").alias("lroot")).join(
        spots.select(F.col("group").alias("rgroup"), F.col("root").alias("rroot")), F.expr("lgroup = rgroup and lroot < rroot"))
        .select("lgroup", "lroot", "rgroup", "rroot"))
    a = placed.select(F.col("group").alias("lgroup"), F.col("root").alias("lroot"), F.col("class").alias("a"))
    b = placed.select(F.col("group").alias("rgroup"), F.col("root").alias("rroot"), F.col("class").alias("b"))
    more = _verified(rows, keys, size, percent, cross.join(a, ["lgroup", "lroot"]).join(b, ["rgroup", "rroot"]).select("a", "b"))
    joined = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(more.select("a", "b")))
    for done in (of_group, shared, cross, prefix, links, more):
        release(done)
    return rows, members, keys, joined


def overlaps(left: list[np.ndarray], right: list[np.ndarray], chunk: int = 4_096) -> np.ndarray:
    """How many numbers each set on the left shares with each on the right, as products of 0/1 matrices over some numbers at a time."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = count > 1  # a number in one set alone is shared by none
    dense = np.cumsum(several) - 1
    keep = several[number]
    owner, number = owner[keep], dense[number[keep]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    both = np.zeros((len(left), len(right)), np.float64)
    for first in range(0, int(several.sum()), chunk):
        a, b = np.searchsorted(number, [first, first + chunk])
        has = np.zeros((len(sets), chunk), np.float32)
        has[owner[a:b], number[a:b] - first] = 1.0
        both += has[:len(left)] @ has[len(left):].T
    return np.rint(both).astype(np.int64)


def _others(rows: DataFrame, keys: DataFrame, sizes: DataFrame, links: DataFrame, size: int, percent: int) -> DataFrame:
    """class, others: the rows of all other classes that a class is linked with, for classes of components of several.

    The classes of a component are dealt over parts of at most about SIDE
    classes and SIDE_SHINGLES shingles, and every two parts meet in one task, which compares whole
    sets and gives out one number a class: rows grow with classes times
    parts, never with links.  Small components share tasks.
    """
    placed = links.select(F.col("node").alias("class"), "root").union(links.select(F.col("root").alias("class"), "root").distinct())
    placed = written(placed.join(sizes, "class"))
    sets = written(_sets_of(rows, size, keys.join(placed.select("class"), "class", "left_semi")).join(placed, "class"))
    of_root = written(sets.groupBy("root").agg(F.count("*").alias("count"), F.sum(F.size("set").cast("long")).alias("shingles")))
    parts = of_root.select("root", F.ceil(F.greatest(F.col("count") / F.lit(SIDE), F.col("shingles") / F.lit(SIDE_SHINGLES))).cast("int").alias("parts"))
    n, shingles = of_root.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.sum("shingles"), F.lit(0))).first()
    few = F.lit(max(1, n // SIDE, shingles // SIDE_SHINGLES))
    dealt = skew_join(sets, parts, ["root"], rows=(n, of_root)).withColumn("part", F.pmod(F.hash("class"), F.col("parts")))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), few)).otherwise(F.col("root")).alias("key"), F.least("part", "with").alias("i"),
        F.greatest("part", "with").alias("j"), (F.col("parts") > 1).alias("large"), "root", "part", "class", "m", "set")
    arrow = pa.schema([("class", pa.int64()), ("others", pa.int64())])

    def count(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        roots, part, own, m = (block.column(c).to_numpy() for c in ("root", "part", "class", "m"))
        i, j = block.column("i")[0].as_py(), block.column("j")[0].as_py()
        column = block.column("set").chunk(0)
        values, at = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
        order = np.lexsort((own, roots))
        out = []
        for rows_of in np.split(order, np.flatnonzero(np.diff(roots[order])) + 1):
            a, b = rows_of[part[rows_of] == i], rows_of[part[rows_of] == j]
            if not len(a) or not len(b):
                continue
            both = overlaps([values[at[x]:at[x + 1]] for x in a], [values[at[x]:at[x + 1]] for x in b])
            union = (at[a + 1] - at[a])[:, None] + (at[b + 1] - at[b])[None, :] - both
            linked = (100 * both >= percent * union) & (own[a][:, None] != own[b][None, :])
            out.append((own[a], linked @ m[b]))
            if i != j:
                out.append((own[b], linked.T @ m[a]))
        columns = [np.concatenate([np.asarray(x[k], np.int64) for x in out]) if out else np.zeros(0, np.int64) for k in (0, 1)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=arrow)

    counted = written(dealt.groupBy("key", "i", "j", "large").applyInArrow(count, "class long, others long"))
    for done in (placed, sets, of_root):
        release(done)
    return counted.groupBy("class").agg(F.sum("others").alias("others"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Two documents are linked when 100 * common >= percent * united shingles;
    component_id is the smallest doc_id that links reach, the row's own
    included (null ids don't count; where all are null it is null).  Null and
    empty texts, and those of white space, have no shingles and stay alone.
    Repeated rows are in one component and returned each.
    """
    members, links = linked_classes(docs, size, percent)
    return _named(members, links).drop("class")


def _named(members: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and class of every member, by the (node, root) of linked classes."""
    classes = members.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id")) \
        .join(links, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    least = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = written(classes.join(least, "root").select("class", "component_id"))
    out = members.join(named, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "class")


def link_counts(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row of ``docs``, from all links of the join.

    n_links is the number of other rows that the row is linked with: those of
    its own class and of every class linked with it.  Links lie within
    components, so these are found first, as in ``near_duplicates``, and then every two classes of
    one are compared.
    """
    rows, members, keys, links = _linked(docs, size, percent)
    sizes = written(members.where("class is not null").groupBy("class").agg(F.count("*").alias("m")))
    across = _others(rows, keys, sizes, links, size, percent)
    counts = sizes.join(across, "class", "left").select("class", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return _named(members, links).join(counts, "class", "left") \
        .select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest doc_id; columns unchanged.

    Documents without shingles all stay, and so do rows without a doc_id,
    which can't be told apart.  Rows that repeat both doc_id and text stay
    once; rows of one doc_id with different texts stay or go together.
    """
    keep = near_duplicates(docs, size, percent).where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    names = docs.columns
    flat = docs.toDF(*[f"_{i}" for i in range(len(names))])
    doc_id, text = (f"_{names.index(c)}" for c in ("doc_id", "text"))
    kept = flat.join(keep, F.col(doc_id) == F.col("_id"), "left_semi").withColumn("_same", F.xxhash64(text))
    once = Window.partitionBy(doc_id, "_same").orderBy("_same")
    kept = kept.withColumn("_nth", F.row_number().over(once)).where("_nth = 1").select(*flat.columns)
    return kept.union(flat.where(F.col(doc_id).isNull())).toDF(*names)
