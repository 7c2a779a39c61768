"""Ranked lexical search over a length-stratified index.

Documents with one length normaliser m form a stratum.  In a stratum a term's
weight in a document depends on its occurrences tf alone, so the
postings of a term are kept by tf, one impact is computed for each (term, tf),
and the greatest of them bounds what any document of the stratum can get from
that term.  A search visits a stratum only if the sum of these bounds
can still reach the best documents found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.session import release

from .common import ascii_lower, pick, row_slices, written
from .encode import byte_slices

#: A term, once A-Z are lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK = pa.schema([("m", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("terms", pa.string()), ("groups", pa.binary()), ("tfs", pa.binary()),
                   ("sizes", pa.binary()), ("docs", pa.binary())])
BLOCK_SQL = "m long, doc_ids array<long>, terms string, groups binary, tfs binary, sizes binary, docs binary"
#: Stands for a null doc_id among 64-bit numbers; it sorts first.
NULL_ID = np.iinfo(np.int64).min
#: Index rows are large, so few of them are sent to Python at a time.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}


def _byte_table() -> np.ndarray:
    """Byte → its lower case in a term, or 0 between terms."""
    table = np.arange(256, dtype=np.uint8)
    for first, last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[first:last + 1] = 0
    table[0x41:0x5B] += 32
    return table


BYTES = _byte_table()


def _term_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts as in a term or 0, where terms begin in them, and the number of the text of each."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if offsets[-1] else None
    low = BYTES[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]] if data else np.zeros(0, np.uint8)
    begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = begins[begins < ends]
    first[begins] = inside[begins]
    at = np.flatnonzero(first)
    return low, at, np.searchsorted(ends, at, "right")


def count_terms(texts: pa.Array) -> np.ndarray:
    return np.bincount(_term_starts(texts)[2], minlength=len(texts)).astype(np.int64)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in order, and the number of the text that each is in."""
    low, at, doc_of = _term_starts(texts)
    inside = low != 0
    kept = np.cumsum(inside)
    offsets = np.append(kept[at] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(low[inside])))
    return words, doc_of


def index_block(m: int, doc_ids: list, texts: pa.Array) -> dict:
    """Documents of one normaliser as an index row: by term, by falling tf, the documents."""
    words, doc_of = terms_of(texts)
    coded = words.dictionary_encode()
    key = coded.indices.to_numpy().astype(np.int64) * len(doc_ids) + doc_of
    pair, tf = np.unique(key, return_counts=True)
    term, doc = np.divmod(pair, len(doc_ids))
    order = np.lexsort((doc, -tf, term))
    term, tf, doc = term[order], tf[order], doc[order]
    starts = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])))
    u4 = lambda a: a.astype("<u4").tobytes()
    return {"m": m, "doc_ids": doc_ids, "terms": " ".join(coded.dictionary.to_pylist()), "groups": u4(np.bincount(term[starts], minlength=len(coded.dictionary))),
            "tfs": u4(tf[starts]), "sizes": u4(np.diff(np.append(starts, len(term)))), "docs": u4(doc)}


@dataclass
class LexicalIndex:
    """``blocks``: index rows; ``n_docs`` documents with a term hold ``n_terms`` terms in all."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, block_terms: int = 1 << 18) -> LexicalIndex:
    """Index every document of ``docs`` (doc_id, text) that has a term.

    One pass counts documents by length, which gives the normalisers;
    then the texts are dealt by (m, part), each stratum in as many parts as keep
    one at about ``block_terms`` terms, so a stratum that holds a third of
    all documents is many index rows, and a task's memory is bounded by one part
    or one document.  Null texts have no terms; repeated rows are documents of
    their own.
    """
    spark = docs.sparkSession
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    counted = pa.schema([("n", pa.int64()), ("docs", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, 0):
            n, docs = np.unique(count_terms(b.column(0)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(docs.astype(np.int64))], schema=counted)

    lengths = written(rows.select("text").mapInArrow(count, "n long, docs long").where("n > 0").groupBy("n").agg(F.sum("docs").alias("docs")))
    n_docs, n_terms = lengths.agg(F.sum("docs"), F.sum(F.col("docs") * F.col("n"))).first()
    if not n_docs:
        return LexicalIndex(spark.createDataFrame([], BLOCK_SQL), 0, 0)
    m = F.expr(f"25 + (75L * n * {n_docs}L) div {n_terms}L")
    strata = written(lengths.groupBy(m.alias("m")).agg(F.ceil(F.sum(F.col("docs") * F.col("n")) / block_terms).cast("long").alias("parts")))
    weighed = pa.schema([("n", pa.int64()), ("doc_id", pa.int64()), ("text", pa.string()), ("row", pa.int64())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() * 7_919
        for b in byte_slices(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array(count_terms(b.column(1))), b.column(0), b.column(1), pa.array(np.arange(row, row + b.num_rows))],
                                             schema=weighed)
            row += b.num_rows

    numbered = rows.mapInArrow(weigh, "n long, doc_id long, text string, row long").where("n > 0").withColumn("m", m)
    few = strata.count() <= 100_000
    placed = numbered.join(F.broadcast(strata) if few else strata, "m").select("m", (F.col("row") % F.col("parts")).alias("part"), "doc_id", "text")

    def block(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        row = index_block(part.column("m")[0].as_py(), part.column("doc_id").to_pylist(), part.column("text").chunk(0))
        return pa.Table.from_pylist([row], schema=BLOCK)

    blocks = written(placed.groupBy("m", "part").applyInArrow(block, BLOCK_SQL))
    release(lengths)
    release(strata)
    return LexicalIndex(blocks, n_docs, n_terms)


class Queries:
    """A block of queries: their different terms, and (query, term, repeats) sorted by query."""

    def __init__(self, rows: list):
        self.ids = [r.row for r in rows]
        self.terms = sorted({t for r in rows for t in r.terms})
        number = {t: i for i, t in enumerate(self.terms)}
        coded = [np.unique([number[t] for t in r.terms], return_counts=True) for r in rows]
        self.query = np.repeat(np.arange(len(rows)), [len(t) for t, _ in coded])
        self.term = np.concatenate([t for t, _ in coded]).astype(np.int64)
        self.repeats = np.concatenate([n for _, n in coded]).astype(np.int64)
        self.begin = np.searchsorted(self.query, np.arange(len(rows) + 1))


class Stratum:
    """One index row, as far as some queries' terms are in it."""

    def __init__(self, row: dict, terms: list[str]):
        self.m = row["m"]
        own = pa.array(row["terms"].split(" "))
        at = pc.index_in(pa.array(terms, pa.string()), value_set=own)
        self.at = pc.fill_null(at, -1).to_numpy()
        groups = np.frombuffer(row["groups"], "<u4").astype(np.int64)
        self.sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        self.group_end = np.cumsum(groups)
        self.group_begin = self.group_end - groups
        self.size_end = np.cumsum(self.sizes)
        self.row = row

    def df(self) -> np.ndarray:
        """Documents that hold each of the terms."""
        out = np.zeros(len(self.at), np.int64)
        own = self.at[self.at >= 0]
        first, last = self.group_begin[own], self.group_end[own] - 1
        out[self.at >= 0] = self.size_end[last] - self.size_end[first] + self.sizes[first]
        return out

    def weigh(self, weight: np.ndarray) -> None:
        """The impact of each (term, tf), once, and the greatest of each term: that of its highest tf, which comes first."""
        tfs = np.frombuffer(self.row["tfs"], "<u4").astype(np.int64)
        self.impact = (1_000_000_000 * tfs) // (1_000 * tfs + 8 * self.m)
        self.weight = weight
        self.most = np.zeros(len(self.at), np.int64)
        held = self.at >= 0
        self.most[held] = weight[held] * self.impact[self.group_begin[self.at[held]]]
        self.docs = np.frombuffer(self.row["docs"], "<u4")
        self.doc_ids = np.array([NULL_ID if d is None else d for d in self.row["doc_ids"]], np.int64)

    def bounds(self, queries: Queries) -> np.ndarray:
        """No document here can score more, for each query."""
        total = np.concatenate([[0], np.cumsum(queries.repeats * self.most[queries.term])])
        return total[queries.begin[1:]] - total[queries.begin[:-1]]

    def scores(self, terms: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Score of every document here."""
        score = np.zeros(len(self.doc_ids), np.int64)
        for t, n in zip(terms.tolist(), repeats.tolist()):
            own = self.at[t]
            if own < 0 or not self.most[t]:
                continue
            first, last = self.group_begin[own], self.group_end[own]
            begin, end = self.size_end[first] - self.sizes[first], self.size_end[last - 1]
            score[self.docs[begin:end]] += np.repeat(n * self.weight[t] * self.impact[first:last], self.sizes[first:last])
        return score


class Best:
    """The k best documents of each query, by score and then by doc_id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64) for _ in range(n)]
        self.doc = [np.zeros(0, np.int64) for _ in range(n)]

    def floor(self, q: int) -> int:
        """A score below this does not count."""
        return int(self.score[q][-1]) if len(self.score[q]) == self.k else 1

    def add(self, q: int, score: np.ndarray, doc: np.ndarray) -> None:
        good = np.flatnonzero(score >= self.floor(q))
        score, doc = np.append(self.score[q], score[good]), np.append(self.doc[q], doc[good])
        order = np.lexsort((doc, -score))[:self.k]
        self.score[q], self.doc[q] = score[order], doc[order]


def visit(strata: list[Stratum], queries: Queries, best: Best) -> int:
    """Search the strata, for each query the most promising first; the number of visits."""
    bounds, visits = np.stack([s.bounds(queries) for s in strata]), 0
    order = np.argsort(-bounds, axis=0, kind="stable")
    for q in range(len(queries.ids)):
        own = slice(queries.begin[q], queries.begin[q + 1])
        for i in order[:, q]:
            if bounds[i, q] < best.floor(q):
                break
            best.add(q, strata[i].scores(queries.term[own], queries.repeats[own]), strata[i].doc_ids)
            visits += 1
    return visits


def search(index: LexicalIndex, items: DataFrame, k: int = 10, query_terms: int = 1 << 17) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every row of ``items`` (item_id, text).

    A term's weight w is floor(1000 ln((2 N + 2) / (2 df + 1))); a document's
    score is the sum of w * ((10^9 tf) div (1000 tf + 8 m)) over the
    item's terms, repeats included.  Only scores above 0 count; equal ones
    are in the order of doc_id, null first.  Every row of ``items`` is searched
    for, repeated ones too; those without a term have no results.

    Queries are taken in blocks of about ``query_terms`` terms (one item at
    least).  For each block the index is read twice: for the document counts of
    its terms, and to visit strata; a task keeps the k best of its own strata
    and, as no task can do with less, at most k rows a query leave it.
    """
    spark = items.sparkSession
    asked = written(pick(items, "item_id", "text").select("item_id", F.monotonically_increasing_id().alias("row"),
                                                          F.regexp_extract_all(ascii_lower("text"), F.lit(TERM), F.lit(0)).alias("terms")).where("size(terms) > 0"))
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks, found = -(-total // query_terms), []
    for block in range(n_blocks if index.n_docs else 0):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).select("row", "terms").collect()
        if rows:
            found.append(_search_block(index, Queries(rows), k))
    if not found:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    best = all_found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def _search_block(index: LexicalIndex, queries: Queries, k: int) -> DataFrame:
    """row, doc_id, score: the best of every task for one block of queries, written."""
    context = index.blocks.sparkSession.sparkContext
    shared = context.broadcast(queries)
    counts = pa.schema([("term", pa.int32()), ("df", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value.terms
        df = np.zeros(len(terms), np.int64)
        for b in row_slices(batches, 1):
            df += Stratum({"m": 0, **b.to_pylist()[0]}, terms).df()
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], schema=counts)

    parts = written(index.blocks.select("terms", "groups", "sizes").mapInArrow(count, "term int, df long"), FEW_ROWS)
    df = dict(map(tuple, parts.groupBy("term").agg(F.sum("df")).collect()))
    weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(queries.terms))], np.int64)
    release(parts)
    result = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = Best(len(own.ids), k)
        for b in batches:
            strata = [Stratum(row, own.terms) for row in b.to_pylist()]
            for s in strata:
                s.weigh(weight)
            visit(strata, own, best)
        for q, row in enumerate(own.ids):
            docs = best.doc[q]
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(docs), pa.int64()), pa.array(docs, mask=docs == NULL_ID), pa.array(best.score[q])],
                                             schema=result)

    found = written(index.blocks.mapInArrow(best_of, "row long, doc_id long, score long"), FEW_ROWS)
    shared.destroy()
    return found
