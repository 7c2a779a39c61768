"""Token ids of many texts at a time.

A text whose words are parted by single spaces or line breaks is cut into
pieces by Arrow; a slice of rows has each different piece resolved once, and
the ids of its texts are gathered from those of its pieces by numpy.  No
Python object is made for a word of running text, nor, where a tokenizer lets
words be tokenized side by side, for one that is remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import KEPT, LATIN_END, MARKS, WordIds, _byte_level, _chunk_encoder, packed, text_encoder

#: Stands before a text's first piece, which follows no space; it is white space of ODD, so no other piece holds it.
FIRST = "\x1c"
#: Texts that are encoded one by one: other white space, or spaces and line breaks at an end or next to each other.
ODD = (r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
       r"|^[ \n]|[ \n][ \n]|[ \n]\z")
#: Words that ``plain`` takes, after a line break or not; Arrow's form of it.
LETTERS = r"\A\n?[A-Za-z\x{aa}\x{b5}\x{ba}\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}]+\z"
#: Parts of a line of words of letters, each after one space or line break.
IN_LINE = re.compile(r"[ \n]?(?:[^\W\d_]+[ \n]?)*")
#: Bytes of the longest word that is remembered.
LONGEST = 64
_ENCODERS: dict[str, "TextsEncoder"] = {}
KEPT.append(_ENCODERS)


def plain(word: str) -> bool:
    """Whether a word after a space is letters alone, in lower case too, that every normalizer leaves as they are (but for case)."""
    return word.isalpha() and (word.isascii() or max(word) < LATIN_END and word.lower().isalpha())


def strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def gathered(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin and are as long as said, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(begin - (ends - size), size) + np.arange(total)] if total else pool[:0]


class LineIds:
    """Ids of words as columns: the words, all ids, and where a word's begin and how many they are.

    Different new words are tokenized by ``learn`` (words → all ids, number of each).
    Once more than ``limit`` words are remembered, those asked for last alone
    stay, so the size is bounded by that and the words of one call.
    """

    def __init__(self, learn, limit: int):
        self.learn, self.limit = learn, limit
        self.words, self.pool, self.size = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, begin and number of ids of the words known, and each different word's place there, -1 if it isn't of letters alone."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = at < 0
        fresh = words.filter(pa.array(new))
        fit = pc.and_(pc.less_equal(pc.binary_length(fresh), LONGEST), pc.match_substring_regex(fresh, LETTERS))
        fresh = fresh.filter(fit)
        if len(fresh):
            ids, size = self.learn(fresh)
            at[np.flatnonzero(new)[fit.to_numpy(zero_copy_only=False)]] = len(self.words) + np.arange(len(fresh))
            self.words = pa.concat_arrays([self.words, fresh])
            self.pool, self.size = np.concatenate([self.pool, ids]), np.concatenate([self.size, size])
        pool, size, begin = self.pool, self.size, np.cumsum(self.size) - self.size
        if len(self.words) > self.limit:
            stay = at[at >= 0]
            self.words, self.pool, self.size = self.words.take(pa.array(stay)), gathered(pool, begin[stay], size[stay]), size[stay]
        return pool, begin, size, at


class TextsEncoder:
    """Ids of texts as the library's plain call makes them (``add_special_tokens=False``), one array a text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path

        tok = Tokenizer.from_file(path)
        added = tok.get_added_tokens_decoder().values()
        self.named = [t.content for t in added]
        self.all_odd = any(t.normalized for t in added)
        self.model, self.chunk_ids, self.alphabet = tok.model, _chunk_encoder(tok), _byte_level()
        self.lower, self.byte_level = "Lowercase" in str(tok.normalizer), "ByteLevel" in str(tok.pre_tokenizer)
        space, line, vocab = self.alphabet[ord(" ")], self.alphabet[ord("\n")], tok.get_vocab()
        #: Whether a token begins a word, and whether words may be tokenized side by side: no token that such a line can hold goes past a word's end or joins a line break.
        self.begins = np.zeros(max(vocab.values()) + 1, bool)
        self.begins[[i for t, i in vocab.items() if t[0] in (space, line)]] = True
        over = [t for t in vocab if space in t[1:] or line in t[1:] or t[0] == line != t]
        self.side_by_side = self.byte_level and not self.lower and tok.normalizer is None and not any(IN_LINE.fullmatch(self._text(t)) for t in over)
        self.marks = WordIds(lambda m: packed([t.id for t in self.model.tokenize(m)]), 10_000)
        self.words = WordIds(self._other_ids, 200_000)
        self.lines = LineIds(self._learn, 400_000)

    def _text(self, token: str) -> str:
        """The whole characters of a byte-level token."""
        byte = {c: b for b, c in self.alphabet.items()}
        return bytes(byte[c] for c in token if c in byte).decode(errors="ignore")

    def _other_ids(self, piece: str) -> bytes:
        if piece[0] == FIRST:
            return packed(self.chunk_ids(piece[1:])) if len(piece) > 1 else b""
        return packed(self.chunk_ids(piece if piece[0] == "\n" else " " + piece))

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words of letters and the number of each, tokenized side by side and parted where a word begins."""
        spaced = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise("", words, " "))
        ends = np.cumsum(pc.binary_length(spaced).to_numpy())[63::64].tolist()
        text = "".join(strings(spaced)).encode().decode("latin-1").translate(self.alphabet)
        tokens = (self.model.tokenize(text[i:j]) for i, j in zip([0, *ends], [*ends, len(text)]))
        ids = np.array([t.id for t in chain.from_iterable(tokens)], "<u4")
        begin = np.flatnonzero(self.begins[ids])
        if len(begin) == len(words):
            return ids, np.diff(begin, append=len(ids))
        each = list(map(self._other_ids, strings(words)))
        return np.frombuffer(b"".join(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each)) >> 2

    def _line_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of different pieces and the number of each, put together from words of letters, marks after them and the other pieces."""
        stripped = pc.utf8_rtrim(pieces, characters=MARKS)
        words = stripped.dictionary_encode()
        pool, begin, size, place = self.lines(words.dictionary)
        at = place[words.indices.to_numpy()]
        tail = pc.binary_length(pieces).to_numpy() - pc.binary_length(stripped).to_numpy()
        own = np.flatnonzero((at < 0) | (tail > 0))
        n_marks = np.where(at < 0, 0, tail)[own].tolist()
        more = [self.marks[p[-n:]] if n else self.words[p] for p, n in zip(strings(pieces.take(pa.array(own))), n_marks)]
        #: A piece is the run of its word, none if it is another piece, and the run of its marks or of all of it.
        begins, sizes = np.zeros((len(pieces), 2), np.int64), np.zeros((len(pieces), 2), np.int64)
        known = np.flatnonzero(at >= 0)
        begins[known, 0], sizes[known, 0] = begin[at[known]], size[at[known]]
        sizes[own, 1] = np.fromiter(map(len, more), np.int64, len(more)) >> 2
        begins[own, 1] = len(pool) + np.cumsum(sizes[own, 1]) - sizes[own, 1]
        pool = np.concatenate([pool, np.frombuffer(b"".join(more), "<u4")])
        return gathered(pool, begins.ravel(), sizes.ravel()), sizes.sum(axis=1)

    def _piece_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of different pieces and the number of each; words with marks after them are put together from both."""
        if self.side_by_side:
            return self._line_ids(pieces)
        out = self._each_piece(pieces)
        return np.frombuffer(b"".join(out), "<u4"), np.fromiter(map(len, out), np.int64, len(out)) >> 2

    def _each_piece(self, pieces: pa.Array) -> list[bytes]:
        if not self.byte_level:
            return list(map(self.words.__getitem__, strings(pieces)))
        stripped = pc.utf8_rtrim(pieces, characters=MARKS)
        words = stripped.dictionary_encode()
        names = strings(words.dictionary)
        ids = list(map(self.words.known, names))
        at = words.indices.to_numpy()
        marked = (pc.binary_length(stripped).to_numpy() != pc.binary_length(pieces).to_numpy())
        own = np.unique(at[~marked])
        for i in own[[ids[i] is None for i in own.tolist()]].tolist():
            ids[i] = self.words[names[i]]
        out = list(map(ids.__getitem__, at.tolist()))
        for i, piece in zip(np.flatnonzero(marked).tolist(), strings(pieces.filter(pa.array(marked)))):
            word = names[at[i]]
            if plain(word):
                out[i] = (ids[at[i]] or self.words[word]) + self.marks[piece[len(word):]]
            else:
                out[i] = self._other_ids(piece)
        return out

    def _odd(self, texts: pa.Array) -> np.ndarray:
        if self.all_odd:
            return np.ones(len(texts), bool)
        odd = pc.match_substring_regex(texts, ODD)
        for name in self.named:
            odd = pc.or_(odd, pc.match_substring(texts, name))
        return odd.to_numpy(zero_copy_only=False)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text, unsigned 32-bit; those of a null or empty text are none."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts, "")
        odd = self._odd(texts)
        whole = {int(i): np.frombuffer(text_encoder(self.path, special_as_text=False)(texts[int(i)].as_py()), "<u4") for i in np.flatnonzero(odd)}
        if whole:
            texts = pc.if_else(pa.array(odd), "", texts)
        marked = pc.binary_join_element_wise(FIRST, pc.replace_substring(texts, "\n", " \n"), "")
        cut = pc.split_pattern(marked, " ")
        words = cut.flatten().dictionary_encode()
        pool, size = self._piece_ids(words.dictionary)
        at = words.indices.to_numpy()
        sizes, begin = size[at], np.cumsum(size) - size
        ids = gathered(pool, begin[at], sizes)
        first = np.diff(cut.offsets.to_numpy())
        out = np.split(ids, np.cumsum(sizes)[np.cumsum(first)[:-1] - 1])
        for i, own in whole.items():
            out[i] = own
        return out


def texts_encoder(path: str) -> TextsEncoder:
    """The encoder of a tokenizer file; one lives in each Python worker."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = TextsEncoder(path)
    return _ENCODERS[path]


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20, rows: int = 8_192) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows and about ``most`` bytes of the text column (one row at least)."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = min(max(int(np.searchsorted(ends, before + most, "right")), at + 1), at + rows, b.num_rows)
            yield b.slice(at, end - at)
            at = end
