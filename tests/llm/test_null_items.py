"""Benchmark items without an id, against the query's SQL."""

import duckdb
import pandas as pd

from pricelens.llm import decontaminate
from pricelens.llm.queries import ORACLES


def test_items_without_an_id_hit_but_are_not_counted(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    documents = pd.DataFrame({"doc_id": [1, 2, 3, 4], "text": ["x " + passage + " y", "only short words", "nothing", None]})
    benchmark = pd.DataFrame({"item_id": [None, 7, None], "text": [passage, "short words", "words"]}).astype({"item_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    want = sorted(map(tuple, con.execute(ORACLES["op7_contamination"]).fetchall()))
    docs = spark.createDataFrame([(1, documents.text[0]), (2, documents.text[1]), (3, "nothing"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, passage), (7, "short words"), (None, "words")], "item_id long, text string")
    got = decontaminate.contamination(docs, items)
    assert sorted(map(tuple, got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect())) == want
    assert [(w[0], w[2], w[3]) for w in want] == [(1, 11, 0), (2, 2, 1), (3, 0, 0), (4, 0, 0)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()) == [3, 4]
