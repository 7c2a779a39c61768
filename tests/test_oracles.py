"""Every registered query with an oracle agrees with DuckDB on the same tables.

Runs at sf0.001 by default (fast); set PRICELENS_ORACLE_SF to check another scale.
"""

import os

import pytest

from pricelens.registry import oracles, queries

from .conftest import SF_SMALL, duck_on

SF = os.environ.get("PRICELENS_ORACLE_SF", SF_SMALL)
_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(v):
    import math
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else repr(v)
    return v


def _rows(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(None if (x is pd.NA or x is pd.NaT) else _norm(x) for x in rec))
    return cols, sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_oracle(spark, duck, name):
    if name in ("preview_head", "raw_preview_head") and SF == SF_SMALL:
        pytest.skip("listing_id is not unique at sf0.001, so the first ten rows are not unique")
    df = queries()[name](spark, SF)
    con = duck_on(duck, SF)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracles()[name]}").fetchall()}
    assert spark_types == duck_types
    sp = df.toPandas()
    dk = con.execute(oracles()[name]).fetchdf()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2
