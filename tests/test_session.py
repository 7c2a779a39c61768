"""Session sizing from the input, and the score entry points for records and frames."""

import pytest
from pyspark.sql import functions as F

from pricelens.session import input_size, scale_settings, size_session

from .conftest import SF_SMALL

KEYS = list(scale_settings(1))


@pytest.fixture
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in KEYS}
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shuffles_grow_with_the_input_only(spark, settings):
    path = f"{SF_SMALL}/lineitem.parquet"
    size = input_size(spark, path)
    assert size > 10_000 and input_size(spark, f"{SF_SMALL}/nothing*") == 0
    assert size_session(spark, path) == {}
    set_to = size_session(spark, path, partition_bytes=size // 40)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == int(set_to["spark.sql.shuffle.partitions"]) >= 40
    assert spark.read.parquet(path).groupBy("l_returnflag").agg(F.count("*")).count() == 3
