"""Sum-of-squares online packing of token sequences into windows of one size."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, pick
from .encode import byte_slices, texts_encoder

#: A piece before it is placed: doc_id, ids of the document before it, its ids, ids of the whole document.
Piece = tuple[int, int, np.ndarray, int]


class SumOfSquares:
    """Places pieces online so that the squared counts of partially filled windows stay small.

    ``level[h]`` is the number of open windows filled to ``h``.  A piece of
    ``n`` goes into the open window (or a new one) after which the sum of
    ``level[h] ** 2`` is least, the fuller window on ties.  Putting it at level h
    changes that sum by 2 - 2 level[h] + 2 level[h + n] (without the last terms
    at h = 0 and where the window becomes full).
    """

    def __init__(self, size: int):
        self.size, self.level = size, np.zeros(size + 1, dtype=np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.open = 0

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put the piece away; the window, if that filled it."""
        n, level = len(piece[2]), self.level
        if n == self.size:
            return [piece]
        change = np.full(self.size - n + 1, np.iinfo(np.int64).max)
        used = np.flatnonzero(level[:self.size - n + 1])
        change[used] = 2 - 2 * level[used] + 2 * level[used + n]
        change[0] = 1 + 2 * level[n]
        if level[self.size - n]:
            change[self.size - n] = 1 - 2 * level[self.size - n]
        h = len(change) - 1 - int(change[::-1].argmin())
        if h:
            window = self.at[h].pop()
            level[h] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        if h + n == self.size:
            return window
        self.at[h + n].append(window)
        level[h + n] += 1
        self.open += 1
        return None

    def take_open(self) -> list[Piece]:
        """Pieces of all open windows, the fullest first; none stays open."""
        pieces = [p for h in range(self.size - 1, 0, -1) for w in self.at[h] for p in w]
        self.at, self.open = [[] for _ in range(self.size + 1)], 0
        self.level[:] = 0
        return pieces


def cut(pieces: list[Piece], sizes: Iterator[int]) -> Iterator[list[Piece]]:
    """The pieces in order, cut into windows of the given sizes."""
    room, window = next(sizes, 0), []
    for doc, start, ids, total in pieces:
        while len(ids):
            part = ids[:room]
            window.append((doc, start, part, total))
            start, ids, room = start + len(part), ids[len(part):], room - len(part)
            if not room:
                yield window
                room, window = next(sizes, 0), []
    if window:
        yield window


def drained(pieces: list[Piece], size: int) -> Iterator[list[Piece]]:
    """Windows over the leftover pieces: full ones, then one for each power of two in what remains."""
    total = sum(len(p[2]) for p in pieces)
    rest = [1 << b for b in range(size.bit_length(), -1, -1) if (total % size) >> b & 1]
    yield from cut(pieces, iter([size] * (total // size) + rest))


def pack(pieces: Iterator[Piece], size: int, most_open: int) -> Iterator[list[Piece]]:
    """Windows of one stream of pieces.

    Whenever ``most_open`` windows are partially filled, and at the end, their
    pieces are cut to fill whole windows; at the end what is less than a window
    becomes windows of powers of two, which need no padding.
    """
    state = SumOfSquares(size)
    for piece in pieces:
        window = state.place(piece)
        if window:
            yield window
        if state.open >= most_open:
            left = state.take_open()
            whole = sum(len(p[2]) for p in left) // size
            windows = list(cut(left, iter([size] * (whole + 1))))
            yield from windows[:whole]
            for p in (p for w in windows[whole:] for p in w):
                state.place(p)
    yield from drained(state.take_open(), size)


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, most_open: int = 2_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document is its ids by the tokenizer file and ``end_id`` (a null or
    empty text: that id alone); each id lies in exactly one piece.  Documents
    longer than a window give whole windows first and their rest is packed.
    Each partition is one online stream with its own level array, so there is
    no shuffle, a lost task packs its own partition again in the same way, and
    memory is bounded by ``most_open`` windows.  Sequences hold ``size`` ids
    but for the last few of a partition, whose sizes are powers of two.
    Repeated rows are packed each; null ids stay null.
    """
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                       ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(batches):
        give_back()
        encode, first, end = texts_encoder(tokenizer), TaskContext.get().partitionId() << 40, np.array([end_id], "<u4")

        def pieces():
            for b in byte_slices(batches, 1):
                for doc, own in zip(b.column(0).to_pylist(), encode(b.column(1))):
                    ids = np.concatenate([own, end])
                    for start in range(0, len(ids), size):
                        yield doc, start, ids[start:start + size], len(ids)

        rows = []
        for k, window in enumerate(pack(pieces(), size, most_open)):
            offset = 0
            for doc, start, ids, total in window:
                rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, first + k, offset))
                offset += len(ids)
            if len(rows) >= 5_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
        give_back()

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
