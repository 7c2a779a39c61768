"""Token-id files: concatenated id arrays with Elias-Fano encoded document boundaries.

A file set is a Parquet folder of blocks.  A block holds the ids of a run of
documents as one little-endian array, and the running ends of the documents
as an Elias-Fano code: the low bits of each end packed side by side, the high
bits as a unary bit vector, and the place of every 64th one-bit in it, so that
the end of the i-th document is found by a select over at most a few words
instead of a table of 64-bit offsets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, row_slices
from .encode import byte_slices, texts_encoder

SAMPLED = 64


def ef_encode(ends: np.ndarray) -> dict:
    """Elias-Fano code of non-decreasing numbers: width, low, high, samples (bytes)."""
    n, top = len(ends), int(ends[-1]) if len(ends) else 0
    width = max(0, (top // n).bit_length() - 1) if n else 0
    ends = ends.astype(np.uint64)
    low = (ends[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
    ones = (ends >> np.uint64(width)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
    high[ones] = 1
    return {"width": width, "low": np.packbits(low.ravel(), bitorder="little").tobytes(),
            "high": np.packbits(high, bitorder="little").tobytes(), "samples": ones[::SAMPLED].astype("<u4").tobytes()}


class EliasFano:
    """Reads single numbers of a code: ``select(i)``."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.width = n, width
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    def one(self, i: int) -> int:
        """Place of the i-th one-bit: from the sample before it, byte by byte."""
        at, left = int(self.samples[i // SAMPLED]), i % SAMPLED
        byte, skip = at >> 3, at & 7
        bits = int(self.high[byte]) >> skip << skip
        while (ones := bits.bit_count()) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        return byte * 8 + (bits & -bits).bit_length() - 1

    def select(self, i: int) -> int:
        """The i-th number, from 0."""
        first = i * self.width
        part = int.from_bytes(self.low[first >> 3:(first + self.width + 7) >> 3].tobytes(), "little") >> (first & 7)
        return (self.one(i) - i) << self.width | part & ((1 << self.width) - 1)


BLOCK = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("id_bytes", pa.int32()),
                   ("doc_ids", pa.list_(pa.int64())), ("ids", pa.binary()),
                   ("width", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())])
BLOCK_SQL = ("part int, before long, n_docs int, n_ids long, id_bytes int, doc_ids array<long>, ids binary, "
             "width int, low binary, high binary, samples binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_bytes: int = 2, block_ids: int = 1 << 18) -> None:
    """Encode every text and write the block files to ``path``, in ascending doc_id order over parts and blocks.

    One shuffle by range of (doc_id, hash of the text) puts the rows in order;
    ties of doc_id are in the order of that hash and null ids come first.  A
    block closes once it holds ``block_ids`` ids, so a worker's memory is
    bounded by that and one document.  A null or empty text is ``end_id``
    alone.  Spark commits each task's file once, so a repeated task leaves no
    part of its first try.  ``id_bytes`` is the width of an id, 2 or 4; an id
    that needs more raises an error.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("tie"))
    placed = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches):
        encode, part, before, end = texts_encoder(tokenizer), TaskContext.get().partitionId(), 0, np.array([end_id], "<u4")
        doc_ids, chunks, held = [], [], 0

        def block():
            ids = np.concatenate(chunks)
            if int(ids.max()) >= 1 << 8 * id_bytes:
                raise ValueError(f"an id does not fit {id_bytes} bytes")
            ends = np.cumsum([len(c) for c in chunks])
            code = ef_encode(ends)
            row = {"part": part, "before": before, "n_docs": len(chunks), "n_ids": len(ids), "id_bytes": id_bytes,
                   "doc_ids": doc_ids, "ids": ids.astype(f"<u{id_bytes}").tobytes(), **code}
            return pa.RecordBatch.from_pylist([row], schema=BLOCK)

        for b in byte_slices(batches, 1):
            for doc, own in zip(b.column(0).to_pylist(), encode(b.column(1))):
                ids = np.concatenate([own, end])
                doc_ids.append(doc)
                chunks.append(ids)
                held += len(ids)
                if held >= block_ids:
                    yield block()
                    before += held
                    doc_ids, chunks, held = [], [], 0
        if chunks:
            yield block()

    placed.mapInArrow(run, BLOCK_SQL).write.mode("errorifexists").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files alone.

    ``start`` is the number of ids of all documents before it.  The totals of
    the parts (one small row each, so the running sum over them and its
    broadcast are bounded by the number of files) give where a part begins.
    """
    blocks = spark.read.schema(BLOCK_SQL).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    begin = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("begin"))
    placed = blocks.join(F.broadcast(begin), "part")
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for b in row_slices(batches, 1):
            row = b.to_pylist()[0]
            ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
            ends = EliasFano(row["n_docs"], row["width"], row["low"], row["high"], row["samples"])
            first, out = row["begin"] + row["before"], {k: [] for k in arrow.names}
            begin = 0
            for i, doc in enumerate(row["doc_ids"]):
                end = ends.select(i)
                out["doc_id"].append(doc)
                out["start"].append(first + begin)
                out["n_tokens"].append(end - begin)
                out["ids_crc32"].append(zlib.crc32(ids[begin:end].tobytes()))
                begin = end
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
