"""Queries over the line-item interview stream (binding B3): record assembly,
header broadcast and the KPI report built on them (the flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import parse_survey_ts
from ..operators.assemble import assemble_records
from ..operators.lookup import header_by_name
from ..operators.reshape import header_broadcast
from ..schema import SUBJECT
from ..sources.bindings import (LINE_SENTINEL, LINE_VARIABLES, ORDER_HEADER, lineitem_stream,
                                order_header_stream)
from .registry import query

NUMERIC_LINE_VARS = ["l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


def line_records(spark, sf_dir):
    """B3 -> SC-5 -> LK-2 -> GRP-1: one row per line item, rebuilt from the stream."""
    stream = lineitem_stream(spark, sf_dir)
    return assemble_records(stream, LINE_VARIABLES, LINE_SENTINEL, strip_prefix=True)


def typed_line_records(spark, sf_dir):
    r = line_records(spark, sf_dir)
    return r.select(
        SUBJECT, "rec", "l_returnflag", "l_linestatus",
        F.col("l_partkey").try_cast("long").alias("l_partkey"),
        *[F.col(c).try_cast("double").alias(c) for c in NUMERIC_LINE_VARS[1:]],
        F.col("l_shipdate").alias("l_shipdate"))


def order_items(spark, sf_dir):
    """JN-1: the order header (LK-6, SC-1) beside every assembled item."""
    stream = lineitem_stream(spark, sf_dir)
    header = header_by_name(order_header_stream(spark, sf_dir), ORDER_HEADER)
    header = header.select(SUBJECT, "SubjectNum", parse_survey_ts("Upload").alias("Upload"),
                           parse_survey_ts("Date").alias("Date"))
    items = assemble_records(stream, LINE_VARIABLES, LINE_SENTINEL, strip_prefix=True)
    return header_broadcast(header, items)


@query("grp1_line_records", """
SELECT l_orderkey AS subject_id, l_returnflag, l_linestatus, l_partkey,
       l_quantity, l_extendedprice, l_discount, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
""")
def q_line_records(spark, sf_dir):
    return typed_line_records(spark, sf_dir).drop("rec")


@query("grp1_records_per_order", """
SELECT l_orderkey AS subject_id, COUNT(*) AS records, CAST(SUM(l_quantity) AS DOUBLE) AS qty
FROM lineitem GROUP BY l_orderkey
""")
def q_records_per_order(spark, sf_dir):
    r = typed_line_records(spark, sf_dir)
    return r.groupBy(SUBJECT).agg(F.count(F.lit(1)).alias("records"),
                                  F.sum("l_quantity").alias("qty"))


@query("flagship_returnflag_kpi", """
SELECT l_returnflag, l_linestatus, CAST(year(o_orderdate) AS INTEGER) AS upload_year,
       COUNT(*) AS lines, ROUND(SUM(l_quantity), 2) AS sum_qty,
       ROUND(AVG(l_extendedprice), 4) AS avg_price,
       ROUND(AVG(l_extendedprice * (1 - l_discount)), 4) AS avg_disc_price,
       MIN(l_extendedprice) AS min_price, MAX(l_extendedprice) AS max_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2, 3
""")
def q_flagship(spark, sf_dir):
    """AGG-6 KPI over records assembled from the interview stream."""
    t = order_items(spark, sf_dir)
    price = F.col("l_extendedprice").try_cast("double")
    disc = F.col("l_discount").try_cast("double")
    return (t.groupBy("l_returnflag", "l_linestatus", F.year("Upload").alias("upload_year"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.round(F.sum(F.col("l_quantity").try_cast("double")), 2).alias("sum_qty"),
                 F.round(F.avg(price), 4).alias("avg_price"),
                 F.round(F.avg(price * (1 - disc)), 4).alias("avg_disc_price"),
                 F.min(price).alias("min_price"), F.max(price).alias("max_price")))


@query("jn1_header_broadcast", """
SELECT l_orderkey AS subject_id, CAST(o_orderkey AS VARCHAR) AS SubjectNum,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Upload, l_returnflag,
       l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def q_header_broadcast(spark, sf_dir):
    t = order_items(spark, sf_dir)
    return t.select(SUBJECT, "SubjectNum", F.date_format("Upload", "yyyy-MM-dd HH:mm:ss").alias("Upload"),
                    "l_returnflag", F.col("l_extendedprice").try_cast("double").alias("l_extendedprice"))
