"""CSV files with line breaks inside quotes, read by many tasks a file.

Spark splits a text file into blocks at line ends.  Whether a block begins
inside quotes is the parity of the quotes before it: one pass counts them per
block, a running sum over a file's blocks (one row a block) gives the parity, and then
every task puts together the records of its own blocks.  What is left are the
lines at block ends that belong to one record: at most two pieces a block,
joined in the order of their blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Blocks that begin inside quotes are told to the tasks by a broadcast up to this many, by a join beyond.
MOST_ODD = 200_000
_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("place", pa.int32()), ("closes", pa.bool_()), ("first", pa.bool_()), ("text", pa.string())])
_PIECES_SQL = "file string, block long, place int, closes boolean, first boolean, text string"
BLOCK = ["file", "block"]


def _lines(spark: SparkSession, path) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _blocks(lines: DataFrame, quote: str) -> DataFrame:
    """file, block, starts_odd, ends_odd: whether a block begins and ends inside quotes; one row a block."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    per = lines.groupBy(*BLOCK).agg(F.sum(quotes).alias("n"))
    through = F.sum("n").over(Window.partitionBy("file").orderBy("block"))
    return cut_lineage(per.select(*BLOCK, ((through - F.col("n")) % 2 == 1).alias("starts_odd"), (through % 2 == 1).alias("ends_odd")))


def _pieces(lines: DataFrame, quote: str) -> DataFrame:
    """Whole records (place null) and the pieces of records that cross block ends.

    ``lines`` has value, file, block, starts_odd, the lines of a block in order.  A
    piece's place is 0 at the head of its block and 1 at its end; it
    closes its record or not; ``first`` marks the first record of a file.
    """

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parity, open_lines, at_head, fresh = None, 0, [], False, False

        def batch(rows, file, block):
            columns = [pa.array([file] * len(rows)), pa.array([block] * len(rows), pa.int64()), *[pa.array([r[i] for r in rows], f.type) for i, f in
                                                                                                enumerate(list(_PIECES)[2:])]]
            return pa.RecordBatch.from_arrays(columns, schema=_PIECES)

        def left_over():
            return batch([(0 if at_head else 1, False, fresh, "\n".join(open_lines))], *key)

        for b in batches:
            files, blocks = b.column(1).to_pylist(), b.column(2).to_pylist()
            cuts = [0, *[i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]], len(files)]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                if (files[begin], blocks[begin]) != key:
                    if open_lines:
                        yield left_over()
                    key, open_lines = (files[begin], blocks[begin]), []
                    parity = int(b.column(3)[begin].as_py())
                    at_head, fresh = parity == 1, key[1] == 0
                values = b.column(0).slice(begin, end - begin)
                counts = pc.count_substring(values, quote).to_numpy(zero_copy_only=False)
                after = (parity + np.cumsum(counts)) & 1
                if not open_lines and parity == 0 and not after.any():  # every line is a record
                    n = end - begin
                    first = np.zeros(n, bool)
                    first[0] = fresh
                    yield pa.RecordBatch.from_arrays([b.column(1).slice(begin, n), b.column(2).slice(begin, n), pa.nulls(n, pa.int32()),
                                                      pa.array(np.ones(n, bool)), pa.array(first), values], schema=_PIECES)
                    fresh = False
                else:
                    rows = []
                    for value, inside in zip(values.to_pylist(), after.tolist()):
                        open_lines.append(value)
                        if not inside:
                            rows.append((0 if at_head else None, True, fresh and not at_head, "\n".join(open_lines)))
                            open_lines, at_head, fresh = [], False, False
                    if rows:
                        yield batch(rows, *key)
                parity = int(after[-1])
        if open_lines:
            yield left_over()

    return lines.select("value", *BLOCK, "starts_odd").mapInArrow(assemble, _PIECES_SQL)


def csv_records(spark: SparkSession, path, quote: str = '"') -> DataFrame:
    """(first, record): every record of the CSV files as text, line breaks inside quotes kept.

    ``first`` marks the first record of each file.  Empty records are left out, and a
    carriage return before a record's end is cut off.  A quote
    inside quotes must be doubled.  A record that is never closed is returned as it stands.
    """
    lines = _lines(spark, path)
    blocks = _blocks(lines, quote)
    odd = blocks.where("starts_odd").select(*BLOCK, F.lit(True).alias("odd"))
    if odd.count() <= MOST_ODD:
        known = lines.join(F.broadcast(odd), BLOCK, "left")
    else:
        placed = lines.withColumn("at", F.monotonically_increasing_id()).join(odd, BLOCK, "left")
        known = placed.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "at")
    known = known.withColumn("starts_odd", F.coalesce("odd", F.lit(False)))
    records = _pieces(known, quote).where("place is null").select("first", F.col("text").alias("record"))
    crossing = blocks.where("starts_odd or ends_odd").select(*BLOCK)
    n_crossing = crossing.count()
    if n_crossing:
        if n_crossing <= MOST_ODD:
            near = known.join(F.broadcast(crossing), BLOCK, "left_semi")
        else:
            near = known.withColumn("at", F.monotonically_increasing_id()).join(crossing, BLOCK, "left_semi")
            near = near.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "at")
        parts = cut_lineage(_pieces(near, quote).where("place is not null"))
        order = Window.partitionBy("file").orderBy("block", "place")
        chain = F.sum(F.col("closes").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
        joined = parts.withColumn("chain", F.coalesce(chain, F.lit(0))).groupBy("file", "chain").agg(
            F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("own"))
        records = records.unionByName(joined.select("first", F.array_join(F.col("own.text"), "\n").alias("record")))
    return records.withColumn("record", F.regexp_replace("record", "\r\\z", "")).where("record != ''")


def read_split_csv(spark: SparkSession, path, schema: T.StructType, options: dict) -> DataFrame:
    """CSV files with a header as a table of ``schema``, whose columns are those of the files in order."""
    rows = csv_records(spark, path, options.get("quote", '"')).where(~F.col("first")) if options.get("header") else csv_records(spark, path)
    parsed = rows.select(F.from_csv("record", _ddl(schema), {k: str(v) for k, v in options.items() if k != "header"}).alias("r"))
    return parsed.select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
