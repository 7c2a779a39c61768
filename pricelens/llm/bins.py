"""Sum-of-squares bin packing of whole documents into sequences of one size."""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick
from .encode import byte_slices, texts_encoder

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary())])
PIECES_SQL = "doc_id long, piece int, start long, length int, ids binary"
PLACED = PIECES.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))


class GapBins:
    """Open bins by residual gap; every item goes where the sum of squared bin counts per gap becomes smallest.

    Moving a bin from gap g to gap g - n changes that sum by
    2 - 2 count[g] + 2 count[g - n]; a new bin changes it by 1 + 2 count[size - n],
    and one that becomes full by 1 - 2 count[g].  Ties go to the smallest gap.
    A bin is only its number: what is in it has been given out already.
    """

    #: From so many different gaps on, they are compared by numpy.
    MANY = 48

    def __init__(self, size: int):
        self.size, self.bins = size, 0
        self.count, self.counts = [0] * (size + 1), np.zeros(size + 1, dtype=np.int64)
        self.gaps: list[int] = []
        self.at: list[array] = [array("q") for _ in range(size + 1)]

    def choose(self, n: int) -> int:
        """The gap of the bin that an item of ``n`` goes to; ``size`` for a new one."""
        first = bisect_left(self.gaps, n)
        if len(self.gaps) - first > self.MANY:
            gaps = n + np.flatnonzero(self.counts[n:self.size])
            change = 2 - 2 * self.counts[gaps] + 2 * self.counts[gaps - n] - (gaps == n)
            at = int(change.argmin())
            best, gap = int(change[at]), int(gaps[at])
        else:
            best, gap, count = None, self.size, self.count
            for g in self.gaps[first:]:
                change = 1 - 2 * count[g] if g == n else 2 - 2 * count[g] + 2 * count[g - n]
                if best is None or change < best:
                    best, gap = change, g
        fresh = 1 + 2 * self.count[self.size - n] if n < self.size else 0
        return gap if best is not None and best <= fresh else self.size

    def _add(self, gap: int, by: int) -> None:
        self.count[gap] += by
        self.counts[gap] += by
        if self.count[gap] == 0:
            self.gaps.pop(bisect_left(self.gaps, gap))
        elif by == 1 == self.count[gap]:
            insort(self.gaps, gap)

    def place(self, n: int) -> tuple[int, int]:
        """(bin, offset in it) of an item of ``n``, 1 to ``size``."""
        gap = self.choose(n)
        if gap == self.size:
            bin_no, self.bins = self.bins, self.bins + 1
        else:
            bin_no = self.at[gap].pop()
            self._add(gap, -1)
        if gap > n:
            self.at[gap - n].append(bin_no)
            self._add(gap - n, 1)
        return bin_no, self.size - gap


def document_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every document with ``end_id`` after it.

    Only documents of more than ``size`` ids are cut; of their pieces the first alone may be shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = texts_encoder(tokenizer), np.array([end_id], "<u4")
        for b in byte_slices(batches, 1):
            rows = []
            for doc, own in zip(b.column(0).to_pylist(), encode(b.column(1))):
                ids = np.concatenate([own, end])
                if len(ids) <= size:
                    rows.append((doc, 0, 0, len(ids), ids.tobytes()))
                    continue
                starts = [0, *range(len(ids) % size or size, len(ids), size)]
                for k, (start, stop) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc, k, start, stop - start, ids[start:stop].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PIECES.types)], schema=PIECES)

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, PIECES_SQL)


def pack_whole(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset.

    A document is its ids by the tokenizer file and ``end_id`` (a null or
    empty text: that id alone).  Each partition is packed for itself, the
    longest pieces first: it is sorted in place, which spills where it must,
    and nothing is shuffled.  Memory is one number per open bin, as a piece's
    place is known and given out at once.  A partition ends with some bins
    partly filled; that is the only room left over.  Rows of one doc_id,
    repeated or not, are packed each; null ids stay null; an empty table has
    no rows; a lost task packs its partition again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = GapBins(size), TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [bins.place(n) for n in b.column(3).to_pylist()]
            columns = [pa.array([first + k for k, _ in placed], pa.int64()), pa.array([at for _, at in placed], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], schema=PLACED)

    pieces = document_pieces(docs, tokenizer, size, end_id)
    ordered = pieces.sortWithinPartitions(F.desc("length"), "doc_id", "start")
    return ordered.mapInArrow(run, PIECES_SQL + ", sequence_id long, offset long")


def pack_digest(placed: DataFrame) -> DataFrame:
    """The packed pieces with a checksum instead of their ids."""
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")
