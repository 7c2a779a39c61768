"""Benchmark decontamination as a prefix-filtered set join of documents with item windows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, map_slices, pick, row_slices, written

#: The bytes of the word class: 0-9, a-z and every byte of a non-ASCII character (A-Z are lower-cased before).
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes; ``bytes.lower`` changes A-Z alone."""
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def windows_of(words: list[bytes], size: int) -> list[bytes]:
    """All windows of ``size`` words; a shorter list, but not an empty one, is one window."""
    if not words:
        return []
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct (win, item_id), the id null where the item has none; rows with a null text, or without words, have no windows."""
    arrow = pa.schema([("win", pa.binary()), ("item_id", pa.string())])

    def run(b: pa.RecordBatch) -> dict:
        pairs = [(w, i) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w in windows_of(words_of(t), size)]
        return {"win": [w for w, _ in pairs], "item_id": [i for _, i in pairs]}

    rows = pick(items, "item_id", "text").dropna(subset=["text"]).select(F.col("item_id").cast("string"), "text")
    return map_slices(rows, run, "win binary, item_id string", arrow).distinct()


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often each word of a bounded vocabulary occurs over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    arrow = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        known, seen = shared.value.__contains__, Counter()
        for b in row_slices(batches):
            for text in b.column(0).to_pylist():
                seen.update(filter(known, words_of(text)))
        yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())}, schema=arrow)

    rows = pick(docs, "text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def prefix_index(pairs: list[tuple[bytes, str]], counts: dict[bytes, int]) -> dict[bytes, list]:
    """Rarest word → windows it is the prefix of, as (its offset, length, words, item ids).

    A window occurs only whole, so the overlap a match needs is its full size
    and the prefix that must be shared is one word: its rarest, by the counts
    over all documents (ties: by the word).  The offset of that word is the
    positional bound: it fixes where the window must begin.
    """
    items: dict[bytes, list[str]] = {}
    for win, item in pairs:
        items.setdefault(win, []).append(item)
    index: dict[bytes, list] = {}
    for win, ids in items.items():
        words = win.split(b" ")
        at = min(range(len(words)), key=lambda i: (counts.get(words[i], 0), words[i], i))
        index.setdefault(words[at], []).append((at, len(words), words, ids))
    return index


def match(words: list[bytes], index: dict[bytes, list]) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges [from, to) of all window occurrences, and the ids of the items they belong to (an item may have none)."""
    ranges, items, n = [], set(), len(words)
    for pos in [i for i, w in enumerate(words) if w in index]:
        for at, size, window, ids in index[words[pos]]:
            start = pos - at
            if 0 <= start <= n - size and words[start:start + size] == window:
                ranges.append((start, start + size))
                items.update(i for i in ids if i is not None)
    return ranges, items


def covered(ranges: list[tuple[int, int]]) -> int:
    """Number of words inside any range."""
    total = end = 0
    for a, b in sorted(ranges):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def index_blocks(docs: DataFrame, items: DataFrame, size: int, block: int) -> list:
    """The prefix index of all items as broadcasts of about ``block`` (window, item) pairs each; at least one."""
    pairs = written(item_windows(items, size))
    blocks = max(1, -(-pairs.count() // block))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("win"), F.lit(blocks)))
    out = []
    for k in range(blocks):
        here = [(bytes(r["win"]), r["item_id"]) for r in pairs.where(F.col("block") == k).select("win", "item_id").collect()]
        counts = word_counts(docs, {w for win, _ in here for w in win.split(b" ")}) if here else {}
        out.append(docs.sparkSession.sparkContext.broadcast(prefix_index(here, counts)))
    return out


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, block: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    Items come in blocks of about ``block`` (window, item) pairs, chosen by a
    hash of the window; one block is what passes through the driver and what a
    Python worker holds, and every block meets every document, so any number
    of items is handled and each broadcast has a bound.  Documents are never
    shuffled.  Null texts have no words; repeated documents count each, and an
    item id once per document; null ids stay null.  An item without an id is
    matched like any other, but not among n_items.  Without items nothing is
    contaminated.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    found = rows.withColumn("ranges", F.lit(None).cast("array<int>")).withColumn("items", F.lit(None).cast("array<string>"))
    carried = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ranges", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
    result = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                        ("items_sha256", pa.string()), ("contaminated", pa.bool_())])
    blocks = index_blocks(docs, items, size, block)

    for shared in blocks:
        def run(b: pa.RecordBatch, shared=shared, last=shared is blocks[-1]) -> dict:
            ranges, ids = [x or [] for x in b.column(2).to_pylist()], [x or [] for x in b.column(3).to_pylist()]
            n_words = []
            for i, text in enumerate(b.column(1).to_pylist()):
                hit, of = match(words := words_of(text), shared.value)
                n_words.append(len(words))
                if hit:
                    ranges[i] = [*ranges[i], *[x for r in sorted(set(hit)) for x in r]]
                    ids[i] = sorted({*ids[i], *of})
            if not last:
                return {"doc_id": b.column(0), "text": b.column(1), "ranges": ranges, "items": ids}
            hits = [covered(list(zip(x[::2], x[1::2]))) for x in ranges]
            return {"doc_id": b.column(0), "n_words": n_words, "n_hit": hits, "n_items": [len(x) for x in ids],
                    "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids],
                    "contaminated": [h > 0 for h in hits]}

        if shared is blocks[-1]:
            found = map_slices(found, run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean", result)
        else:
            found = map_slices(found, run, "doc_id long, text string, ranges array<int>, items array<string>", carried)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 10, block: int = 200_000) -> DataFrame:
    """``docs`` without the rows in which an item window occurs; columns unchanged, clean rows untouched.

    Which item it is doesn't matter here.
    """
    at, kept = docs.columns.index("text"), docs
    for shared in index_blocks(docs, items, size, block):
        def run(batches, shared=shared):
            for b in row_slices(batches):
                clean = [not match(words_of(t), shared.value)[0] for t in b.column(at).to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        kept = map_rows(kept, run)
    return kept
