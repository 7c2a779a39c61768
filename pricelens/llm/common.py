"""Helpers shared by the training-data operators.

``pick`` takes columns by their exact name and drops all others, so extra
columns of an input, also ones that differ only in case or that are named like
a result column, never clash with what an operator adds.
"""

from __future__ import annotations

import array
import ctypes
import gc
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import cut_lineage, sf_path

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, name))


@contextmanager
def session_settings(spark: SparkSession, own: dict[str, str]):
    """Settings that hold for what is run inside."""
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, settings: dict[str, str] | None = None) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, with no lineage behind it.

    Nothing reads the shuffle files of a finished write again, so Spark is
    told to remove them with it instead of at some later garbage collection.
    ``settings`` hold for this write alone.
    """
    with session_settings(df.sparkSession, {SHUFFLE_CLEANUP: "true", **(settings or {})}):
        return cut_lineage(df)


def skew_join(big: DataFrame, one: DataFrame, keys: list[str], share: int = 1_000, rows: tuple[int, DataFrame] | None = None) -> DataFrame:
    """Left join with ``one``, which has one row a key, where a key may hold any part of ``big``'s rows.

    Keys that hold more than 1/``share`` of the rows, fewer than ``share`` of
    them however large the table, are joined by a broadcast of their few rows
    of ``one``; all others by a shuffle.  ``big`` is read three times, so it should be
    a written table.  ``rows``, where they are known: how many it has, and the ``count`` of each key.
    """
    total, counts = rows or (big.count(), big.groupBy(*keys).count())
    hot = counts.where(F.col("count") * share > total).select(*keys).collect() if total else []
    if not hot:
        return big.join(one, keys, "left")
    hot = F.broadcast(big.sparkSession.createDataFrame(hot, big.select(*keys).schema))
    few = F.broadcast(one.join(hot, keys, "left_semi"))
    return big.join(hot, keys, "left_anti").join(one, keys, "left").unionByName(big.join(hot, keys, "left_semi").join(few, keys, "left"))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns; the first of several that share a name."""
    at = df.columns
    flat = df.toDF(*[f"_{i}" for i in range(len(at))])
    return flat.select(*[F.col(f"_{at.index(n)}").alias(n) for n in names])


def ascii_lower(c) -> "F.Column":
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def row_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that few texts are Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, arrow: pa.Schema) -> DataFrame:
    """Apply ``fn`` (a slice of rows → columns) to every slice of every partition."""

    def run(batches):
        for b in row_slices(batches):
            yield pa.RecordBatch.from_pydict(fn(b), schema=arrow)

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` that keeps all columns, whatever their names; ``fn`` finds them by place."""
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.mapInArrow(fn, flat.schema).toDF(*df.columns)


class WordIds(dict):
    """Key → its token ids as little-endian unsigned 32-bit bytes, made by ``ids_of`` where not known.

    A memory of two generations of at most ``limit`` keys each: what was
    used lately stays, and the size is bounded however many words there are.
    """

    def __init__(self, ids_of: Callable[[str], bytes], limit: int = 350_000):
        super().__init__()
        self.ids_of, self.limit, self.old = ids_of, limit, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.ids_of(key)
        self.keep(key, ids)
        return ids

    def keep(self, key: str, ids: bytes) -> None:
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = ids

    def known(self, key: str) -> bytes | None:
        """Its ids if they are remembered."""
        ids = self.get(key)
        if ids is None:
            ids = self.old.get(key)
            if ids is not None:
                self.keep(key, ids)
        return ids


#: A chunk ends where a space or line break follows another character.
SPACED = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space other than these two: such a text is encoded in one piece.
OTHER_SPACE = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")
_ENCODERS: dict[tuple, Callable[[str], bytes]] = {}
#: What a Python worker keeps from task to task.
KEPT: list[dict] = [_ENCODERS]


def give_back() -> None:
    """Hand memory that this Python worker has free, Arrow's and the C library's, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def lean_worker() -> None:
    """Free what earlier stages left in this Python worker.

    Spark hands a worker from one stage to the next, and its memory counts
    with the executor's: encoders of a stage before would stand beside the
    rows of a shuffle.  A stage that encodes makes its own anew.
    """
    if any(KEPT):
        for kept in KEPT:
            kept.clear()
        gc.collect()
    give_back()


#: A run of letters, after a line break or space or not, and ASCII marks after it: what most chunks are.
PLAIN = re.compile(r"(\n?)( ?)([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
#: The ASCII marks of the pattern above.
MARKS = "".join(chr(i) for i in range(33, 127) if chr(i) != "'" and not chr(i).isalnum())
#: Letters below this stay as they are under NFC.
LATIN_END = "\u0250"


def _byte_level() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _chunk_encoder(tok) -> Callable[[str], list[int]]:
    """One chunk → ids.  Plain words go straight to the library's BPE model, all else through its whole pipeline.

    A plain word is one pre-token, and a mark after it another, whatever the
    family; their byte-level form is then all that normalizer and pre-tokenizer
    would make of them.  Where the tokenizer lower-cases, so does this.
    """
    model, alphabet = tok.model, _byte_level()
    lower = "Lowercase" in str(tok.normalizer)
    byte_level = "ByteLevel" in str(tok.pre_tokenizer)
    space, line = (alphabet[ord(x)] for x in " \n")

    def encode(chunk: str) -> list[int]:
        if byte_level and chunk[0] == " " and chunk.isascii() and chunk[1:].isalpha():
            return [t.id for t in model.tokenize(chunk[1:].lower() if lower else space + chunk[1:])]
        plain = PLAIN.fullmatch(chunk) if byte_level else None
        if not plain:
            return tok.encode(chunk, add_special_tokens=False).ids
        before, gap, word, marks = plain.groups()
        if lower:
            before, gap, word = "", "", word.lower()
        if not word.isascii():
            if not word.isalpha() or max(word) >= LATIN_END:
                return tok.encode(chunk, add_special_tokens=False).ids
            word = word.encode().decode("latin-1").translate(alphabet)
        ids = [t.id for t in model.tokenize(space + word if gap else word)]
        if marks:
            ids += [t.id for t in model.tokenize(marks)]
        return [t.id for t in model.tokenize(line)] + ids if before else ids

    return encode


def packed(ids: list[int]) -> bytes:
    return array.array("I", ids).tobytes()


def text_encoder(path: str, special_as_text: bool = True) -> Callable[[str], bytes]:
    """Whole text → ids (little-endian unsigned 32-bit), by the tokenizer file at ``path``.

    The pre-tokenizers of both families never join a non-space character with
    a space after it, so the ids of a text are those of its chunks in order;
    each chunk is encoded by the library once and remembered.  Where all words
    are parted by one space or line break, the chunks are the pieces between
    spaces: a piece stands for itself after a space, or, if it begins with a
    line break, for itself.  Other texts are cut by a pattern, and those with
    other white space are encoded whole.  Strings of special tokens in a text
    are ordinary text, or, without ``special_as_text``, what the library makes
    of them with ``add_special_tokens=False`` alone: texts that hold one are
    encoded whole.  One encoder of each kind lives in each Python worker.
    """
    kind = path, special_as_text
    if kind not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = special_as_text
        added = tok.get_added_tokens_decoder().values()
        named = [] if special_as_text else [t.content for t in added]
        all_whole = not special_as_text and any(t.normalized for t in added)
        chunk_ids, byte_level = _chunk_encoder(tok), "ByteLevel" in str(tok.pre_tokenizer)
        marks = WordIds(lambda m: packed([t.id for t in tok.model.tokenize(m)]), 10_000)

        def piece_ids(piece: str) -> bytes:
            word = piece.rstrip(MARKS)
            if len(word) < len(piece) and word.isascii() and word.isalpha() and byte_level:
                return pieces[word] + marks[piece[len(word):]]
            return packed(chunk_ids(piece if piece[0] == "\n" else " " + piece))

        pieces = WordIds(piece_ids)
        chunks = WordIds(lambda chunk: packed(chunk_ids(chunk)))

        def encode(text: str) -> bytes:
            if all_whole or any(x in text for x in named):
                return packed(tok.encode(text, add_special_tokens=False).ids)
            flat = text.replace("\n", " ")
            if flat.split() == flat.split(" "):
                first, *rest = text.replace("\n", " \n").split(" ")
                return packed(chunk_ids(first)) + b"".join(map(pieces.__getitem__, rest))
            if OTHER_SPACE.search(text):
                return packed(tok.encode(text, add_special_tokens=False).ids)
            return b"".join(map(chunks.__getitem__, SPACED.findall(text)))

        _ENCODERS[kind] = encode
    return _ENCODERS[kind]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
