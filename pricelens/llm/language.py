"""Language identification by word-first backoff.

A known word counts with its log frequency per language; an unseen word falls
back to its character n-grams, from long to short, and counts with the mean
log frequency of the longest length of which it has a known n-gram.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean_worker, map_rows, map_slices, pick, row_slices, written

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 4


def words_of(text: str | None) -> list[str]:
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(map(str.isalpha, w))] if text else []


def ngrams(word: str, n: int) -> list[str]:
    """n-grams of the word between spaces; for n = 1 its letters."""
    s = word if n == 1 else f" {word} "
    return [s[i:i + n] for i in range(len(s) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies per language of words and of n-grams, of bounded size (see ``train``)."""

    langs: list[str]
    prior: list[float]
    words: dict[str, list[float]] = field(default_factory=dict)
    grams: dict[str, list[float]] = field(default_factory=dict)

    def of_word(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return np.array(known)
        for n in range(LONGEST, 0, -1):
            found = [self.grams[g] for g in ngrams(word, n) if g in self.grams]
            if found:
                return np.array([sum(x) / len(found) for x in zip(*found)])
        return np.zeros(len(self.langs))


class Scorer:
    """Predicts whole texts; each distinct word's scores are kept, at most ``limit`` of them."""

    def __init__(self, model: LanguageModel, limit: int = 400_000):
        self.model, self.limit, self.row = model, limit, {}
        self.scores = np.zeros((limit, max(1, len(model.langs))))

    def _index(self, word: str) -> int:
        at = len(self.row)
        self.scores[at] = self.model.of_word(word)
        self.row[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its probability); ``und`` and 0 without a letter or without any learned language."""
        words, langs = words_of(text), self.model.langs
        if not words or not langs:
            return "und", 0.0
        total, part = np.array(self.model.prior), 50_000
        for at in range(0, len(words), part):
            piece = words[at:at + part]
            if len(self.row) + len(piece) > self.limit:
                self.row = {}
            row = self.row
            total += self.scores[[row[w] if w in row else self._index(w) for w in piece]].sum(axis=0)
        chance = np.exp(total - total.max())
        best = int(total.argmax())
        return langs[best], float(chance[best] / chance.sum())


def _log_table(counts: DataFrame, langs: list[str], most: int) -> dict[str, list[float]]:
    """The ``most`` most frequent terms with their smoothed log frequency in each language."""
    per = counts.groupBy("term").agg(*[F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}")
                                       for i, x in enumerate(langs)])
    total = sum(F.col(f"n{i}") for i in range(len(langs)))
    top = per.withColumn("n", total).where("n >= 2").orderBy(F.desc("n"), "term").limit(most).toPandas()
    by = top[[f"n{i}" for i in range(len(langs))]].to_numpy(dtype=float)
    logs = np.log((by + 0.1) / (by.sum(axis=0) + 0.1 * len(by) + 1e-9))
    return dict(zip(top["term"], logs.tolist()))


def train(labelled: DataFrame, sample_rows: int = 20_000, most_words: int = 60_000, most_grams: int = 60_000) -> LanguageModel:
    """Learn from (text, lang) rows; those with a null in either are left out.

    A fixed sample is used, chosen by a hash of the text so that it has about
    ``sample_rows`` rows at any size of the table; the model keeps the
    ``most_words`` most frequent words and ``most_grams`` n-grams of 1 to 4
    characters.  These three bounds hold at every size, so the model, which is
    sent to every worker, does too.  Without rows it knows no language.
    """
    rows = pick(labelled, "text", "lang").dropna()
    n = rows.select("lang").count()
    if n > sample_rows:
        rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(int((1 << 30) * sample_rows / n)))
    arrow = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("term", pa.string()), ("n", pa.int64())])

    def count(batches):
        lean_worker()
        for b in row_slices(batches, 2_000):
            words: dict[str, Counter] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text))
            for lang, seen in words.items():
                grams = Counter()
                for w, k in seen.items():
                    for size in range(1, LONGEST + 1):
                        for g in ngrams(w, size):
                            grams[g] += k
                for terms in (seen, grams):
                    if terms:
                        columns = [lang] * len(terms), [0 if terms is seen else len(g) for g in terms], list(terms), list(terms.values())
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)
        give_back()

    counts = written(rows.mapInArrow(count, "lang string, size int, term string, n long")
                     .groupBy("lang", "size", "term").agg(F.sum("n").alias("n")))
    totals = {r["lang"]: r["n"] for r in counts.where("size = 0").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return LanguageModel([], [])
    whole = sum(totals.values())
    grams = {}
    for size in range(1, LONGEST + 1):
        grams |= _log_table(counts.where(F.col("size") == size), langs, most_grams // LONGEST)
    return LanguageModel(langs, [math.log(totals[x] / whole) for x in langs],
                         _log_table(counts.where("size = 0"), langs, most_words), grams)


def held_out() -> "F.Column":
    """crc32 of the doc_id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0; so is
    everything if no language was learned.  Ties go to the language that comes
    first in the alphabet.  Null ids are kept and not held out.
    """
    shared, state = docs.sparkSession.sparkContext.broadcast(model), {}
    arrow = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(b: pa.RecordBatch) -> dict:
        scorer = state.get("scorer") or state.setdefault("scorer", _scorer(shared.value))
        found = [scorer.predict(t) for t in b.column(2).to_pylist()]
        return {"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": [x for x, _ in found], "score": [s for _, s in found]}

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), held_out(), "text")
    return map_slices(rows, run, "doc_id long, held_out boolean, lang_pred string, score double", arrow)


def _scorer(model: LanguageModel) -> Scorer:
    """A task's scorer, in a worker that holds nothing of earlier stages."""
    lean_worker()
    return Scorer(model)


def learnable(docs: DataFrame) -> DataFrame:
    """(text, lang) of the documents that may be learned from: language given, not held out."""
    return pick(docs, "doc_id", "text", "lang").where(~held_out() & F.col("doc_id").isNotNull()).select("text", "lang")


def keep_known(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose language can't be told: ``und`` or a probability under ``least``; columns unchanged."""
    shared, state, at = docs.sparkSession.sparkContext.broadcast(model), {}, docs.columns.index("text")

    def run(batches):
        scorer = state.get("scorer") or state.setdefault("scorer", _scorer(shared.value))
        for b in row_slices(batches):
            found = [scorer.predict(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([x != "und" and s >= least for x, s in found], pa.bool_()))

    return map_rows(docs, run)
