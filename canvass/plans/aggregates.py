"""Per-respondent lists, distinct counts, dedup, load counts, consolidation,
unions and the documented KPI reports (AGG-*, SET-*, JN-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregate import (column_lists, consolidate, distinct_list, load_counts,
                                   respondents_per_value, union_all)
from ..schema import ELEMENT, SEQ, SUBJECT
from ..sources.bindings import event_stream
from ..sources.tables import read_table
from .registry import query


@query("agg1_distinct_event_list", """
WITH f AS (SELECT user_id, event_type, min(ts) AS t FROM events GROUP BY 1, 2)
SELECT user_id AS subject_id, CAST(1 AS BIGINT) AS Distinct_SubjectNum_Count,
       string_agg(event_type, ', ' ORDER BY t) AS Product_List
FROM f GROUP BY user_id
""")
def q_agg1(spark, sf_dir):
    """AGG-1: per respondent, distinct answers in order of first appearance."""
    s = event_stream(spark, sf_dir)
    return distinct_list(s, SUBJECT, ELEMENT, SEQ)


@query("agg2_distinct_list_with_nan", """
WITH v AS (SELECT user_id, ts, coalesce(CASE WHEN event_type = 'purchase' AND value > 200
                                             THEN 'big' WHEN event_type = 'purchase' THEN 'small' END,
                                        'nan') AS size FROM events),
f AS (SELECT user_id, size, min(ts) AS t FROM v GROUP BY 1, 2)
SELECT user_id AS subject_id, CAST(1 AS BIGINT) AS Distinct_SubjectNum_Count,
       string_agg(size, ', ' ORDER BY t) AS Product_List
FROM f GROUP BY user_id
""")
def q_agg2(spark, sf_dir):
    """AGG-2: as AGG-1, NULL answers kept and rendered as the text 'nan'."""
    e = read_table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value")
    size = (F.when((F.col("event_type") == "purchase") & (F.col("value") > 200), "big")
            .when(F.col("event_type") == "purchase", "small"))
    e = e.select(F.col("user_id").alias(SUBJECT), "ts", size.alias("size"))
    return distinct_list(e, SUBJECT, "size", "ts", null_text="nan")


@query("agg3_respondents_per_answer", """
SELECT event_type, count(DISTINCT user_id) AS respondents FROM events GROUP BY event_type
""")
def q_agg3(spark, sf_dir):
    """AGG-3: distinct respondents per answer value (exact)."""
    e = read_table(spark, sf_dir, "events", "user_id", "event_type")
    return respondents_per_value(e, ["event_type"], "user_id")


@query("agg3_respondents_per_part_word", """
SELECT x AS word, count(DISTINCT p_brand) AS respondents
FROM part, unnest(string_split(p_name, ' ')) AS u(x) GROUP BY x
""")
def q_agg3_words(spark, sf_dir):
    """AGG-3 after a multi-select explode: brands per name word."""
    p = read_table(spark, sf_dir, "part", "p_brand", "p_name")
    w = p.select("p_brand", F.explode(F.split("p_name", " ")).alias("word"))
    return respondents_per_value(w, ["word"], "p_brand")


@query("agg4_dedupe_per_table", """
SELECT DISTINCT l_returnflag AS Variable, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS ship_year
FROM lineitem
""")
def q_agg4(spark, sf_dir):
    """AGG-4: duplicate projected rows removed within each source table."""
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_shipdate")
    proj = li.select(F.col("l_returnflag").alias("Variable"), "l_linestatus",
                     F.year("l_shipdate").alias("ship_year"))
    return proj.dropDuplicates()


@query("agg5_load_counts", """
SELECT event_type AS Variable, count(*) AS rows FROM events GROUP BY ROLLUP (event_type)
""")
def q_agg5(spark, sf_dir):
    """AGG-5: rows loaded per table and in total (NULL Variable = total)."""
    e = read_table(spark, sf_dir, "events", "event_type").withColumnRenamed("event_type", "Variable")
    return load_counts(e)


_KPI_SQL = """
SELECT r_name AS region, p_brand AS sku, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period,
       count(*) AS visits,
       ROUND(avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END), 6) AS availability_rate,
       min(l_extendedprice) AS min_price, ROUND(sum(l_extendedprice), 2) AS sum_price,
       max(l_extendedprice) AS max_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
     JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2, 3
"""


@query("agg6_jn4_price_by_region_sku_period", _KPI_SQL)
def q_agg6(spark, sf_dir):
    """AGG-6 + JN-4: documented KPIs -- availability rate and price
    min/avg/max by region x SKU x period -- over the dataset join.

    nation/region are bounded dimensions (25 / 5 rows) and are broadcast;
    customer and part grow with the data, so Spark's size check (and AQE at
    run time) decides their strategy."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linestatus",
                    "l_extendedprice")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey).select("c_custkey", "r_name")
    t = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(cust, o.o_custkey == cust.c_custkey)
         .join(p, li.l_partkey == p.p_partkey))
    period = F.date_format(F.trunc("o_orderdate", "MM"), "yyyy-MM-dd")
    return (t.groupBy(F.col("r_name").alias("region"), F.col("p_brand").alias("sku"), period.alias("period"))
            .agg(F.count(F.lit(1)).alias("visits"),
                 F.round(F.avg(F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0)), 6)
                  .alias("availability_rate"),
                 F.min("l_extendedprice").alias("min_price"),
                 F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
                 F.max("l_extendedprice").alias("max_price")))


@query("set1_union_by_name", """
SELECT * FROM (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
               FROM customer)
UNION ALL BY NAME
SELECT * FROM (SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier)
""")
def q_set1(spark, sf_dir):
    """SET-1: heterogeneous UNION ALL by name; missing columns NULL."""
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return union_all([c, s])


_SUMMARIES = {
    "brand_summary": ["Variable", "p_brand", "p_size", "Outlet_Code"],
    "price_summary": ["Variable", "p_retailprice", "Store_Name", "p_brand"],
}


def _consolidated(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").withColumnRenamed("p_type", "Variable")
    return consolidate(p, _SUMMARIES)


@query("set2_brand_summary", "SELECT DISTINCT p_type AS Variable, p_brand, p_size FROM part")
def q_set2a(spark, sf_dir):
    """SET-2: per-table long data -> summary 1 (present columns, deduplicated)."""
    return _consolidated(spark, sf_dir)["brand_summary"]


@query("set2_price_summary", "SELECT DISTINCT p_type AS Variable, p_retailprice, p_brand FROM part")
def q_set2b(spark, sf_dir):
    """SET-2: summary 2 from the same single scan."""
    return _consolidated(spark, sf_dir)["price_summary"]


@query("agg1_per_column_lists", """
WITH v AS (SELECT user_id, ts, event_type, CAST(CAST(floor(value / 100) AS BIGINT) AS VARCHAR) AS value_band
           FROM events),
u AS (UNPIVOT v ON event_type, value_band INTO NAME category VALUE val),
f AS (SELECT category, user_id, val, min(ts) AS t FROM u GROUP BY ALL)
SELECT category, user_id, CAST(1 AS BIGINT) AS Distinct_SubjectNum_Count,
       string_agg(val, ', ' ORDER BY t) AS Product_List
FROM f GROUP BY category, user_id
""")
def q_agg1_columns(spark, sf_dir):
    """AGG-1 over several answer columns in one pass (the 13-table follow-on
    of the wide awareness dataset)."""
    e = read_table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value")
    e = e.select("user_id", "ts", "event_type",
                 F.floor(F.col("value") / 100).cast("long").cast("string").alias("value_band"))
    return column_lists(e, "user_id", ["event_type", "value_band"], "ts")
