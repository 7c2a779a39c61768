"""Sum-of-squares packing of whole documents: placement against brute force, whole results, padding."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelens.llm import bins
from pricelens.llm.common import table, text_encoder, tokenizer_path
from pricelens.llm.encode import TextsEncoder, byte_slices, texts_encoder
from pricelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BYTE = "byte_bpe_50k.json"
TOKENIZERS = {}


def tok(name):
    from tokenizers import Tokenizer

    if name not in TOKENIZERS:
        TOKENIZERS[name] = Tokenizer.from_file(tokenizer_path(name))
    return TOKENIZERS[name]


def brute_place(open_bins, n, size):
    """The gap chosen by trying every open bin and a new one."""
    def score(gaps):
        return sum(gaps.count(g) ** 2 for g in set(gaps) if 0 < g < size)

    best = None
    for g in sorted({g for g in open_bins if n <= g < size}) + [size]:
        after = list(open_bins)
        if g < size:
            after.remove(g)
        after.append(g - n)
        if best is None or score(after) < best[0]:
            best = score(after), g
    return best[1]


@pytest.mark.parametrize("many", [0, 48])
@pytest.mark.parametrize("seed", range(6))
def test_every_item_goes_where_the_squares_become_smallest(many, seed):
    rnd = random.Random(seed)
    state, state_bins = bins.GapBins(24), []
    state.MANY = many
    for _ in range(250):
        n = rnd.randint(1, 24)
        want = brute_place(state_bins, n, 24)
        assert state.choose(n) == want
        if want < 24:
            state_bins.remove(want)
        state_bins.append(want - n)
        state.place(n)


def check_packing(rows, texts, size, end_id=0, name=BYTE):
    """Every id once, in bins without gap or overlap; cuts only where allowed."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(tok(name).encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")
        own = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()] and sum(r.length for r in own) == len(ids)
        assert len(own) == 1 if len(ids) <= size else all(r.length == size for r in own[1:]) and own[0].length <= size
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in own)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by_seq)


def test_query_packs_whole_table_close_to_the_bound(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").select("doc_id", "text").collect()}
    rows = QUERIES["op13_best_fit"](spark, SF).collect()
    used = check_packing(rows, texts, 2048)
    parts = len({r.sequence_id >> 40 for r in rows})
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.02 + parts


def test_small_windows_nulls_long_texts_and_clashing_columns(spark):
    texts = {0: None, 1: "", 2: "one two three", 3: "word " * 900 + "end", 4: "  odd\tspace  ", 5: "a <|endoftext|> b", 6: "tie", 7: "tie"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs = docs.select("*", F.lit(1).alias("offset"), F.lit("x").alias("TEXT"))
    check_packing(bins.pack_digest(bins.pack_whole(docs.repartition(3), tokenizer_path(BYTE), 32)).collect(), texts, 32)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x")], "doc_id long, text string").coalesce(1)
    rows = bins.pack_whole(docs, tokenizer_path(BYTE)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.length) for r in rows if r.doc_id) == [(False, 1, 2)] * 2
    assert sum(r.doc_id is None for r in rows) == 1 and len({r.sequence_id for r in rows}) == 1
    assert bins.pack_digest(bins.pack_whole(docs.limit(0), tokenizer_path(BYTE))).collect() == []


@pytest.mark.parametrize("name", [BYTE, "word_bpe_49k.json"])
def test_texts_encoder_equals_the_library(name):
    rnd = random.Random(11)
    bits = ["a", "the", "Ab", "é", "ö", "́", "日本", "ﬁ", "1", "23", "'s", "'ll", ",", ".", "!?", '"', "-", " ", " ", "\n", " ", "\t", "\x85",
            "\x1c", "_", "<|endoftext|>", "ß", "Σ", "İ", "🙂", "x" * 70, "\x00"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3_000)]
    texts += [" ".join("".join(rnd.choice(bits[:17]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(1, 6))) for _ in range(3_000)]
    want = [tok(name).encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in texts_encoder(tokenizer_path(name))(pa.array(texts))] == want
    assert [text_encoder(tokenizer_path(name), False)(t) for t in texts] == [np.array(w, "<u4").tobytes() for w in want]


def test_words_of_letters_are_tokenized_side_by_side(monkeypatch):
    rnd, encode, asked = random.Random(3), TextsEncoder(tokenizer_path(BYTE)), []
    monkeypatch.setattr(encode.words, "ids_of", lambda piece, ids=encode.words.ids_of: asked.append(piece) or ids(piece))
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZßéñĳžƀ") for _ in range(rnd.randint(1, 12)))
    for limit in (None, 50, 50):
        if limit:
            encode.lines.limit = limit
        texts = ["The " + "".join(word() + rnd.choice([" ", ", ", "! ", "\n", ".\n"]) for _ in range(200)) + "end" for _ in range(20)]
        assert [x.tolist() for x in encode(pa.array(texts))] == [tok(BYTE).encode(t, add_special_tokens=False).ids for t in texts]
        assert len(asked) <= 1
    assert len(encode.lines.words) <= 50 + 4_000
    assert not TextsEncoder(tokenizer_path("word_bpe_49k.json")).side_by_side


def test_other_pieces_among_words_of_letters():
    encode = TextsEncoder(tokenizer_path(BYTE))
    texts = ["", "\x1c", "a", "a\xa0 \xa0b c", "İstanbul İ, ΑΣ. ſ ǅ, x", "w.% e_f!! 4,5 ,\n, b\n.c d'\n'e", "Q " + "y" * 65 + " " + "é" * 40 + ", " + "z" * 64 + ".", None,
             "one two\nthree, four\nfive", "日本 語, 中 \u0301 e\u0301, ĳ ƀ.", "ªb µ, º ×a ÷"]
    for _ in range(2):
        assert [x.tolist() for x in encode(pa.array(texts))] == [tok(BYTE).encode(t or "", add_special_tokens=False).ids for t in texts]


def test_texts_encoder_forgets_and_slices_by_bytes():
    encode = texts_encoder(tokenizer_path(BYTE))
    limit, encode.words.limit = encode.words.limit, 5
    try:
        texts = [f"word{i} next other, words{i % 3}. And\nline é{'x' * (i % 7)}" for i in range(60)]
        assert [x.tolist() for x in encode(pa.array(texts))] == [tok(BYTE).encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encode.words) <= 5
    finally:
        encode.words.limit = limit
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 50, None, "y", "z" * 200, ""] * 4)], names=["t"])
    parts = list(byte_slices(iter([batch]), 0, most=100, rows=3))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist() and max(p.num_rows for p in parts) <= 3
