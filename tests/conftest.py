import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from canvass.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def small_blocks(spark):
    """Force tiny blocks so every subject spans many of them."""
    from canvass.schema import BLOCK_SPAN_CONF

    old = spark.conf.get(BLOCK_SPAN_CONF, None)
    spark.conf.set(BLOCK_SPAN_CONF, "3")
    yield 3
    if old is None:
        spark.conf.unset(BLOCK_SPAN_CONF)
    else:
        spark.conf.set(BLOCK_SPAN_CONF, old)


def stream_df(spark, rows, subject=1):
    """rows: list of (element, value) in document order -> answer stream."""
    data = [(subject, i, el, "text", v) for i, (el, v) in enumerate(rows)]
    return spark.createDataFrame(
        data, "subject_id long, seq long, element string, attribute string, value string")
