"""Queries whose columns or spans come from the data: records with labels found in the
answers, respondents over spans of days, and the two stock KPIs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.labels import column_types, label_dictionary, label_records, labelled_answers, typed_records
from ..operators.sketches import period_sketches, respondents_per_span, store_sketches
from ..session import ensure_checkpoint_dir
from ..sources.bindings import event_interview_stream
from ..sources.documents import materialize_stream
from ..sources.tables import read_table
from .registry import query

_LABELLED = """
WITH e AS (SELECT user_id AS subject_id, ts, event_type, value, json_extract_string(props, '$.k') AS k,
             greatest(1, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts))::BIGINT AS rec
           FROM events),
a AS (SELECT subject_id, rec, ts, event_type || '_value' AS label, CAST(value AS VARCHAR) AS answer FROM e
      UNION ALL SELECT subject_id, rec, ts, event_type || '_k', k FROM e)
"""


def _event_answers(spark, sf_dir):
    return labelled_answers(materialize_stream(event_interview_stream(spark, sf_dir)), "signup_value")


@query("grp1_labels_from_data", _LABELLED + """,
p AS (PIVOT a ON label IN ('click_k', 'click_value', 'error_k', 'error_value', 'purchase_k', 'purchase_value', 'signup_k',
                           'signup_value', 'view_k', 'view_value') USING arg_max(answer, ts) GROUP BY subject_id, rec)
SELECT subject_id, rec, CAST(COLUMNS('(.*_value)') AS DOUBLE) AS "\\1", CAST(COLUMNS('(.*_k)') AS BIGINT) AS "\\1" FROM p
""")
def q_labels(spark, sf_dir):
    """GRP-1: records opened by each sign-up, columns and their types found in the answers."""
    answers = _event_answers(spark, sf_dir)
    return typed_records(label_records(answers), column_types(label_dictionary(answers)))


@query("grp1_label_dictionary", _LABELLED + """
SELECT label, count(*) AS questions, count(answer) AS answered,
  CASE WHEN label LIKE '%_k' THEN 'long' ELSE 'double' END AS type FROM a GROUP BY label
""")
def q_dictionary(spark, sf_dir):
    """GRP-1: the labels, how often they are asked and answered, and the type of all their answers."""
    return label_dictionary(_event_answers(spark, sf_dir))


@query("agg3_respondents_over_spans", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS last, CAST(CAST(ts AS DATE) - INTERVAL 6 DAY AS DATE) AS first FROM events)
SELECT strftime(first, '%Y-%m-%d') AS first, strftime(last, '%Y-%m-%d') AS last, event_type,
       count(DISTINCT user_id) AS respondents, true AS within_bounds
FROM events JOIN d ON CAST(ts AS DATE) BETWEEN first AND last GROUP BY 1, 2, 3
""")
def q_spans(spark, sf_dir):
    """AGG-3 for the seven days up to each day, from sketches loaded day by day in two loads (one
    repeated); beside it the exact count, and whether the estimate's bounds hold it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/agg3-{uuid.uuid4().hex}"
    e = read_table(spark, sf_dir, "events", "ts", "user_id", "event_type").withColumn("day", F.to_date("ts"))
    sketches = period_sketches(e, "day", ["event_type"], "user_id")
    late = F.dayofmonth("period") > 15
    for part in (~late, late, late):
        store_sketches(sketches.where(part), path)
    stored = spark.read.schema(sketches.schema).parquet(path)
    spans = stored.select(F.date_sub("period", 6).alias("first"), F.col("period").alias("last")).distinct()
    estimates = respondents_per_span(stored, spans, ["event_type"])
    own = e.select("day", "user_id", "event_type").distinct()
    exact = own.select("user_id", "event_type", F.explode(F.sequence("day", F.date_add("day", 6))).alias("last")) \
        .join(spans, "last").groupBy("first", "last", "event_type").agg(F.count_distinct("user_id").alias("respondents"))
    both = exact.join(estimates, ["first", "last", "event_type"])
    return both.select(F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), "event_type",
                       "respondents", F.col("respondents").between(F.col("low"), F.col("high")).alias("within_bounds"))


@query("agg6_out_of_stock_rate", """
WITH v AS (SELECT l_orderkey, l_partkey, max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS stocked
           FROM lineitem GROUP BY l_orderkey, l_partkey)
SELECT r_name AS region, p_brand AS sku, count(*) AS visits, CAST(sum(1 - stocked) AS BIGINT) AS out_of_stock,
       ROUND(sum(1 - stocked) / count(*)::DOUBLE, 6) AS out_of_stock_rate
FROM v JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2
""")
def q_out_of_stock(spark, sf_dir):
    """AGG-6: share of visits (an order's lines of one SKU) in which no line has the SKU in
    stock, by region and SKU. Lines become visits, and visits regions, before the shop's
    tables are joined by their own keys; Spark's size checks choose each join."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linestatus")
    visits = li.groupBy("l_orderkey", "l_partkey").agg(F.max((F.col("l_linestatus") == "O").cast("int")).alias("stocked"))
    t = visits.join(_shops(spark, sf_dir), visits.l_orderkey == F.col("o_orderkey")) \
        .join(read_table(spark, sf_dir, "part", "p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    out = F.sum(1 - F.col("stocked"))
    return t.groupBy(F.col("r_name").alias("region"), F.col("p_brand").alias("sku")).agg(
        F.count(F.lit(1)).alias("visits"), out.alias("out_of_stock"),
        F.round(out / F.count(F.lit(1)), 6).alias("out_of_stock_rate"))


@query("agg6_asset_counts", """
SELECT r_name AS region, p_type AS asset, count(*) AS records, count(DISTINCT o_custkey) AS outlets,
       CAST(sum(l_quantity) AS DOUBLE) AS assets
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2
""")
def q_assets(spark, sf_dir):
    """AGG-6: assets counted in shops: records, different outlets and pieces by region and kind.
    Pieces are added up per kind and outlet first, so the distinct count needs no second shuffle of lines."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    t = li.join(_shops(spark, sf_dir), li.l_orderkey == F.col("o_orderkey")) \
        .join(read_table(spark, sf_dir, "part", "p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    per_outlet = t.groupBy("r_name", "p_type", "o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return per_outlet.groupBy(F.col("r_name").alias("region"), F.col("p_type").alias("asset")).agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("outlets"), F.sum("q").cast("double").alias("assets"))


def _shops(spark, sf_dir):
    """(o_orderkey, o_custkey, r_name) of every order."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")) \
        .join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("o_orderkey", "o_custkey", "r_name")
