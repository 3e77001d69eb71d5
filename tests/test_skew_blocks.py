"""Whole queries give the same answer whatever the block span: with a span of
3 every interview is cut into many blocks (the hot-subject path), with the
default span each fits in one."""

import pytest

from canvass.plans import all_queries
from conftest import SF_SMALL

QUERIES = ["grp1_line_records", "lk1_loose_first_turn", "lk2_strict_first_user",
           "fil1_reindexed_turns", "jn2_zip_user_assistant", "lk1_loose_order_has_lines",
           "d37_recruit_items_from_xml"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_with_tiny_blocks(spark, name):
    qs, _ = all_queries()
    default = _rows(qs[name](spark, SF_SMALL))
    spark.conf.set("canvass.stream.blockSpan", "3")
    try:
        tiny = _rows(qs[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("canvass.stream.blockSpan")
    assert default == tiny and len(default) > 0


@pytest.mark.parametrize("name", ["lk4_next_purchase_after_view", "lk7_header_pairs", "lk3_event_type_metrics",
                                  "grp3_click_then_purchase"])
def test_event_streams_same_with_minute_blocks(spark, name):
    qs, _ = all_queries()
    default = _rows(qs[name](spark, SF_SMALL))
    spark.conf.set("canvass.events.blockMicros", str(60 * 1_000_000))
    try:
        tiny = _rows(qs[name](spark, SF_SMALL))
    finally:
        spark.conf.unset("canvass.events.blockMicros")
    assert default == tiny and len(default) > 0


def test_line_records_exact_on_a_multi_file_table(spark, tmp_path):
    """Lines of one order spread over several files keep distinct positions
    (keyed by in-file row alone, a few records come out mixed up)."""
    import shutil

    d = tmp_path / "sf"
    d.mkdir()
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    # round-robin: the lines of an order land in different files at equal row numbers
    li.repartition(3).write.parquet(str(d / "lineitem.parquet"))
    shutil.copy(f"{SF_SMALL}/orders.parquet", d / "orders.parquet")
    qs, _ = all_queries()
    got = _rows(qs["grp1_line_records"](spark, str(d)))
    from pyspark.sql import functions as F
    want = _rows(li.select(F.col("l_orderkey").alias("subject_id"), "l_returnflag", "l_linestatus", "l_partkey",
                           "l_quantity", "l_extendedprice", "l_discount",
                           F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate")))
    assert len(li.inputFiles()) == 1 and len(spark.read.parquet(str(d / "lineitem.parquet")).inputFiles()) >= 3
    assert got == want


@pytest.mark.parametrize("span, bits", [(None, None), ("3", None), (None, 1)])
def test_repeated_lines_and_equal_places(spark, tmp_path, monkeypatch, span, bits):
    """Equal rows, and different rows of one hash, are lines and interviews of their own."""
    import shutil
    from decimal import Decimal

    import duckdb

    from canvass.sources import bindings

    d = tmp_path / "sf"
    d.mkdir()
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey < 200")
    again = li.where("l_orderkey < 100")
    li.union(again).union(again.where("l_linenumber = 1")).write.parquet(str(d / "lineitem.parquet"))
    shutil.copy(f"{SF_SMALL}/orders.parquet", d / "orders.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS FROM '{d}/lineitem.parquet/*.parquet'")
    con.sql(f"CREATE VIEW orders AS FROM '{d}/orders.parquet'")
    qs, oracles = all_queries()

    def plain(rows):
        return sorted(tuple(str(float(v)) if isinstance(v, (int, float, Decimal)) else str(v) for v in r) for r in rows)

    if bits:
        monkeypatch.setattr(bindings, "PLACE_BITS", bits)
    if span:
        spark.conf.set("canvass.stream.blockSpan", span)
    try:
        for name in ("grp1_line_records", "grp1_records_per_order", "jn1_header_broadcast", "d37_recruit_items_from_xml"):
            assert plain(qs[name](spark, str(d)).collect()) == plain(con.sql(oracles[name]).fetchall()), name
        places = bindings.lineitem_stream(spark, str(d)).select("subject_id", "seq")
        assert places.count() == places.distinct().count()
    finally:
        spark.conf.unset("canvass.stream.blockSpan")
