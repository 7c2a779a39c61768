"""Python workers go from stage to stage: what one stage keeps in them is not held through the shuffles of the next."""

import pyarrow as pa
import pytest

import corpus_pipeline
from pricelens.llm import common, encode, jaccard, language
from pricelens.session import small_batches

TOKENIZER = common.tokenizer_path("word_bpe_49k.json")
KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def batch():
    return pa.RecordBatch.from_pydict({"doc_id": [1, 2], "key": [3, 4], "text": ["a b c d e f", None]})


def test_shingles_are_made_in_a_worker_without_the_encoders_of_an_earlier_stage():
    alone = [s.tolist() for _, _, sets in jaccard._scan(iter([batch()]), 5) for s in sets]
    ids = encode.texts_encoder(TOKENIZER)(batch().column(2))
    common.text_encoder(TOKENIZER)("a b")
    assert encode._ENCODERS and common._ENCODERS
    assert [s.tolist() for _, _, sets in jaccard._scan(iter([batch()]), 5) for s in sets] == alone
    assert not encode._ENCODERS and not common._ENCODERS
    assert [x.tolist() for x in encode.texts_encoder(TOKENIZER)(batch().column(2))] == [x.tolist() for x in ids]


def test_languages_are_told_in_such_a_worker():
    encode.texts_encoder(TOKENIZER)
    scorer = language._scorer(language.LanguageModel(["de", "en"], [-1.0, -1.0], {"das": [-1.0, -9.0], "the": [-9.0, -1.0]}))
    assert not encode._ENCODERS
    assert [scorer.predict(t)[0] for t in ("das das the", "the", "1", None)] == ["de", "en", "und", "und"]


def test_terms_are_counted_whatever_their_languages(spark):
    rows = [("das haus", "de"), ("the house the", "en"), ("123", "fr"), (None, "de"), ("das the", None), ("das the", "de")]
    model = language.train(spark.createDataFrame(rows, "text string, lang string"))
    assert model.langs == ["de", "en"] and set(model.words) == {"das", "the"}


@pytest.mark.parametrize("given,held", [("10000", "1000"), ("0", "1000"), ("300", "300")])
def test_stages_lower_the_rows_of_a_batch_and_never_raise_them(spark, given, held):
    before = spark.conf.get(KEY)
    try:
        spark.conf.set(KEY, given)
        small_batches(spark)
        assert spark.conf.get(KEY) == held
        spark.conf.set(KEY, given)
        docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
        corpus_pipeline.pack(spark, docs, "")
        assert spark.conf.get(KEY) == held
    finally:
        spark.conf.set(KEY, before)
