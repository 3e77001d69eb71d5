"""End-to-end survey datasets: interview XML documents derived from the driver
tables -> SRC-5 flattening -> SurveySpec interpreter -> dataset table.

The documents are built with Spark expressions (one per order / line item /
supplier), so their number grows with the tables; each oracle computes the
same dataset directly from the tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.aggregate import option_lists
from ..schema import SUBJECT
from ..sources.bindings import numbered_rows, page_tag_stream
from ..sources.documents import (documents_to_stream, grid, interview_document, interviews_once,
                                 materialize_stream, question, tag)
from ..sources.tables import read_table, task_count
from .catalog import BY_ID, SKUS_D02, SUPPLIERS
from .registry import query
from .spec import run_spec

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
OUT_TS = "yyyy-MM-dd HH:mm:ss"


DOCS_PER_TASK = 50_000


def _spread(cells, subject, xml, table=None, once=False):
    """Documents ``xml`` of the rows of ``cells``, hashed by ``subject``. The cells move, not the
    documents, and each task gets a bounded number of them: what is read out of a
    document is many times its cells, so their size says nothing about a task.
    ``table`` has about as many rows as ``cells`` and is cheaper to count. Documents that are the
    only one of their subject are marked so; ``once``: all are."""
    n = task_count(cells if table is None else table, DOCS_PER_TASK)
    rows = cells.withColumn(SUBJECT, subject)
    spread = rows.repartition(n, SUBJECT)
    docs = lambda d: d.select(SUBJECT, xml.alias("xml"))
    often = rows.groupBy(SUBJECT).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(SUBJECT).isNull())
    if once or often.isEmpty():
        return interviews_once(docs(spread))
    alone = (F.count(F.lit(1)).over(Window.partitionBy(SUBJECT)) == 1) & F.col(SUBJECT).isNotNull()
    counted = spread.withColumn("__alone", alone)
    return interviews_once(docs(spread), docs(counted.where("__alone")), docs(counted.where("not __alone")))


def _gps_text(k, nation):
    nl = F.when(k % 2 == 1, F.lit("\r\n")).otherwise(F.lit("\n"))
    return F.concat(
        F.lit("Latitude: "), nation.cast("string"), F.lit(" 12' 30.5 N ("), (k % 90).cast("string"),
        F.lit(".5)"), nl, F.lit("Longitude: "), (k % 180).cast("string"), F.lit(" 10' W (-"),
        (k % 180).cast("string"), F.lit(".25)"), nl, F.lit("Captured at: 2024-01-"),
        F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit(" 10:11:12"), nl,
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(
            F.lit("Altitude: "), (k % 100).cast("string"), F.lit(".0"), nl, F.lit("Bearing: 10.0"),
            nl, F.lit("Speed: 1.5 km/h"))))


def order_interviews(spark, sf_dir):
    """One recruitment interview per order (outlet = customer)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                   "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)          # 25 x 5 rows, bounded
    cust = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey)
    t = o.join(cust, o.o_custkey == cust.c_custkey)
    iso = F.date_format("o_orderdate", ISO)
    header = {"SubjectNum": F.col("o_orderkey"), "Upload": iso, "Date": iso, "VisitStart": iso,
              "VisitEnd": F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(iso),
              "ClientDuration": F.col("o_orderpriority")}
    parts = [
        question("Enumerator_Name", F.col("c_name")),
        question("gps_address", _gps_text(F.col("c_custkey"), F.col("c_nationkey"))),
        question("Visit_Date", F.date_format("o_orderdate", "yyyy-MM-dd")),
        question("Region", F.col("r_name")),
        question("Store_Name", F.col("n_name")),
        # low-priority visits leave Contact unanswered
        question("Contact", F.when(F.col("o_orderpriority") != "5-LOW", F.col("c_mktsegment"))),
        question("Outlet_Code", F.col("c_custkey")),
    ]
    return _spread(t, F.col("o_orderkey"), interview_document(header, parts), o)


@query("d01_recruit_profile_from_xml", """
SELECT o_orderkey AS subject_id, CAST(o_orderkey AS VARCHAR) AS SubjectNum,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Upload,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS VisitStart,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS VisitEnd,
       o_orderpriority AS NetDuration, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS Date,
       c_name AS Enumerator_Name, strftime(o_orderdate, '%Y-%m-%d') AS Visit_Date, r_name AS Region,
       n_name AS Store_Name,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Outlet_Code' ELSE c_mktsegment END AS Contact,
       CAST(c_custkey AS VARCHAR) AS Outlet_Code,
       CAST(c_nationkey AS VARCHAR) || ' 12'' 30.5 N' AS GPS_Latitude,
       CAST(c_custkey % 180 AS VARCHAR) || ' 10'' W' AS GPS_Longitude,
       '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:11:12' AS GPS_Date,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS VARCHAR) || '.0' END AS GPS_Altitude,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '10.0' END AS GPS_Bearing,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '1.5' END AS "GPS_Speed (km/h)"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
""")
def q_d01(spark, sf_dir):
    """D01 end to end: loose lookup (an unanswered Contact yields the next
    question's name, parity X2), header by name, SC-1/SC-2 timestamps, GPS
    (SC-4, CRLF normalised by the XML parser), FIL-4."""
    answers = materialize_stream(documents_to_stream(order_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D01"], answers)
    return out.select(*[F.date_format(c, OUT_TS).alias(c) if c in ("Upload", "VisitStart", "VisitEnd", "Date")
                        else F.col(f"`{c}`") for c in out.columns])


def item_interviews(spark, sf_dir):
    """One item-audit interview per line item: an outlet code, one item
    block (loop prefix I_1_), then a closing DONE item (I_2_)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    # interview id = digest of the row and its number among equal rows: no file listing, any layout
    table, li = li, numbered_rows(li)
    sid = F.md5(F.to_json(F.struct(*sorted(li.columns))))
    header = {"SubjectNum": F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                        F.col("l_linenumber").cast("string")),
              "Upload": F.date_format("l_shipdate", ISO)}
    name = F.concat(F.lit("item "), F.col("l_partkey").cast("string"), F.lit(" ("),
                    F.col("l_suppkey").cast("string"), F.lit(") (x)"))
    parts = [
        question("outlet_code", F.col("l_suppkey")),
        question("I_1_item_category", F.col("l_returnflag")),
        # every third line leaves the barcode unanswered (strict -> NULL)
        question("I_1_item_barcode", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_partkey"))),
        question("I_1_item_name", name),
        question("I_1_item_sales", F.col("l_quantity")),
        question("I_1_item_price", F.col("l_extendedprice")),
        question("I_1_country_of_origin", F.col("l_linestatus")),
        question("I_2_item_category", F.lit("DONE")),
    ]
    return _spread(li, sid, interview_document(header, parts), table, once=True)


@query("d37_recruit_items_from_xml", """
SELECT l_orderkey || '-' || l_linenumber AS SubjectNum, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS Upload,
       CAST(l_suppkey AS VARCHAR) AS outlet_code, l_returnflag AS item_category,
       CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS item_barcode,
       'item ' || l_partkey || ' ' AS item_name, CAST(l_quantity AS VARCHAR) AS item_sales,
       CAST(l_extendedprice AS VARCHAR) AS item_price, l_linestatus AS country_of_origin
FROM lineitem
""")
def q_d37(spark, sf_dir):
    """D37 end to end: SC-5 loop prefix, GRP-1 records by the item_category
    sentinel (rows before it join record 1), LK-2 strict answers, LK-7 header
    pairs, JN-1 header beside items, JN-3 fill-first, SC-6, FIL-5 DONE."""
    answers = materialize_stream(documents_to_stream(item_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D37"], answers)
    return out.select("SubjectNum", F.date_format("Upload", OUT_TS).alias("Upload"), "outlet_code",
                      "item_category", "item_barcode", "item_name", "item_sales", "item_price",
                      "country_of_origin")


def supplier_interviews(spark, sf_dir):
    """One supplier-profile interview per supplier; even suppliers answer the
    purchase-frequency grid as one comma vector, odd ones label by label."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    t = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)              # 25 rows, bounded
    k = F.col("s_suppkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-01-02T03:04:05Z"), "Date": F.lit("2024-01-02T03:04:05Z"),
              "SurveyorName": F.col("s_name")}
    vec = F.concat_ws(", ", (k % 7).cast("string"), (k % 5).cast("string"), F.col("n_name"))
    labelled = F.concat(grid(SUPPLIERS[1], (k % 11).cast("string")), F.lit("<Text>skip</Text>"),
                        grid(SUPPLIERS[3], (k % 13).cast("string")))
    parts = [
        question("I_1_outlet_code", k),
        question("country_name", F.col("n_name")),
        question("owner_name", F.col("s_name")),
        question("purch_freq", None),
        F.when(k % 2 == 0, F.concat(F.lit("<Text>grid</Text>"), tag("TopicAnswer", vec))).otherwise(labelled),
        question("water_stock", F.col("s_acctbal")),
    ]
    return _spread(t, k, interview_document(header, parts), s)


@query("d39_supplier_vector_from_xml", f"""
SELECT s_suppkey AS subject_id, CAST(s_suppkey AS VARCHAR) AS outlet_code, n_name AS country_name,
       s_name AS owner_name, s_name AS SurveyorName,
       CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 7 AS VARCHAR) ELSE '' END AS "{SUPPLIERS[0]}",
       CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 5 AS VARCHAR) ELSE CAST(s_suppkey % 11 AS VARCHAR) END AS "{SUPPLIERS[1]}",
       CASE WHEN s_suppkey % 2 = 0 THEN n_name ELSE '' END AS "{SUPPLIERS[2]}",
       CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE CAST(s_suppkey % 13 AS VARCHAR) END AS "{SUPPLIERS[3]}",
       '' AS "{SUPPLIERS[4]}"
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_d39(spark, sf_dir):
    """D39 end to end: FIL-3b inclusive slice purch_freq..water_stock, LK-5
    comma vector padded to 5 labels, LK-4 label-by-label fallback."""
    answers = materialize_stream(documents_to_stream(supplier_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D39"], answers)
    return out.select(SUBJECT, "outlet_code", "country_name", "owner_name", "SurveyorName",
                      *[F.col(f"`{s}`") for s in SUPPLIERS])


_PAGE_PAT = "<([a-zA-Z][a-zA-Z0-9]*)[^>]*>([^<]*)"


@query("src5_page_tags_title_h1", f"""
WITH t AS (SELECT page_id, list_transform(regexp_extract_all(html, '{_PAGE_PAT}', 1), lambda x: lower(x)) AS tags,
                  regexp_extract_all(html, '{_PAGE_PAT}', 2) AS texts FROM pages)
SELECT page_id AS subject_id,
       CASE WHEN list_position(tags, 'title') > 0 THEN texts[list_position(tags, 'title')] END AS title,
       CASE WHEN list_position(tags, 'h1') > 0 THEN texts[list_position(tags, 'h1')] END AS h1,
       CAST(len(tags) AS BIGINT) AS n_tags
FROM t WHERE len(tags) > 0
""")
def q_pages(spark, sf_dir):
    """SRC-5 on raw HTML pages (binding B4): tag stream in document order,
    then LK-6 first text of <title> and <h1>, per page."""
    s = page_tag_stream(spark, sf_dir)
    return s.groupBy(SUBJECT).agg(
        F.min_by("value", F.when(F.col("element") == "title", F.col("seq"))).alias("title"),
        F.min_by("value", F.when(F.col("element") == "h1", F.col("seq"))).alias("h1"),
        F.count(F.lit(1)).alias("n_tags"))


def _sku_at(index: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(s) for s in SKUS_D02]), (index + 1).cast("int"))


def part_interviews(spark, sf_dir):
    """One shelf audit per part: the price of one SKU, the facings of
    another, and the display location of the first -- left unanswered (last
    question, no answer) for a third of the parts."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    sku1, sku2 = _sku_at(k % 35), _sku_at((k + 7) % 35)
    day = F.concat(F.lit("2024-01-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"),
                   F.lit("T08:00:00Z"))
    header = {"SubjectNum": k, "Upload": day, "Date": day}
    where = (F.when(F.col("p_size") % 3 == 0, F.lit("Shelf, Fridge"))
             .when(F.col("p_size") % 3 == 1, F.lit("Counter")))
    parts = [question(F.concat(sku1, F.lit("_Price")), F.col("p_retailprice")),
             question(F.concat(sku2, F.lit("_No_of_Facings")), F.col("p_size")),
             question(F.concat(sku1, F.lit("_Display_Location")), where)]
    return _spread(p, k, interview_document(header, parts))


_SKU_LIST = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in SKUS_D02) + "]"


_D02_CTES = f"""
WITH p AS (SELECT p_partkey, p_size, p_retailprice,
                  list_extract({_SKU_LIST}, CAST(p_partkey % 35 AS INTEGER) + 1) AS sku1,
                  list_extract({_SKU_LIST}, CAST((p_partkey + 7) % 35 AS INTEGER) + 1) AS sku2,
                  '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || ' 08:00:00' AS day
           FROM part),
g AS (SELECT p.*, Variable FROM p, unnest({_SKU_LIST}) AS t(Variable)),
c AS (SELECT p_partkey AS subject_id, CAST(p_partkey AS VARCHAR) AS SubjectNum, day AS Upload, day AS Date,
             Variable,
             CASE WHEN Variable = sku1 THEN CAST(p_retailprice AS VARCHAR) END AS Price,
             CASE WHEN Variable = sku2 THEN CAST(p_size AS VARCHAR) END AS No_of_Facings,
             CASE WHEN Variable = sku1 AND p_size % 3 = 0 THEN 'Shelf, Fridge'
                  WHEN Variable = sku1 AND p_size % 3 = 1 THEN 'Counter' END AS dl
      FROM g)
"""


@query("d02_sku_profile_from_xml", _D02_CTES + """
SELECT subject_id, SubjectNum, Upload, Date, Variable, Price, No_of_Facings, trim(x) AS Display_Location
FROM c, unnest(string_split(coalesce(dl, 'None'), ',')) AS u(x)
""")
def q_d02(spark, sf_dir):
    """D02 end to end: every <SKU>_<metric> variable (35 x 13) looked up in
    one pass, long by SKU with one row per SKU even when nothing was found
    (LK-3, PRJ-6), then Display_Location split and trimmed with the NULL ->
    'None' parity (EX-3)."""
    answers = materialize_stream(documents_to_stream(part_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D02"], answers)
    return out.select(SUBJECT, "SubjectNum", F.date_format("Upload", OUT_TS).alias("Upload"),
                      F.date_format("Date", OUT_TS).alias("Date"), "Variable", "Price", "No_of_Facings",
                      "Display_Location")


def customer_interviews(spark, sf_dir):
    """One biscuit-awareness interview per customer. Every seventh customer
    skips the three multi-select questions (all explode columns NULL)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    day = F.concat(F.lit("2024-02-"), F.lpad((F.col("c_nationkey") % 28 + 1).cast("string"), 2, "0"),
                   F.lit("T09:30:00Z"))
    header = {"SubjectNum": k, "Upload": day, "Date": day}
    asked = k % 7 != 0
    parts = [
        question("biscuit_tom", F.col("c_mktsegment")),
        F.when(asked, question("biscuit_awareness",
                               F.when(k % 2 == 0, F.lit("Perk, Yum, Perk")).otherwise(F.lit("Royal")))),
        # unanswered for two thirds: the loose lookup returns the next question's name
        F.when(asked, question("biscuit_extra_aware", F.when(k % 3 == 0, F.lit("McBerry,  , Nutrisnax")))),
        F.when(asked, question("biscuit_advertising", F.lit("TV, Radio"))),
        question("biscuit_consumed_often", F.col("c_nationkey")),
    ]
    return _spread(c, k, interview_document(header, parts))


_D27_EMPTY = ["biscuit_consumed", "biscuit_consumed_months", "biscuit_consumed_days",
              "biscuit_consumed_mcberry", "biscuit_consumed_nutrisnax", "biscuit_consumed_perk",
              "biscuit_consumed_royal", "biscuit_consumed_yum"]


@query("d27_awareness_lists_from_xml", """
WITH v AS (SELECT CAST(c_custkey AS VARCHAR) AS SubjectNum, c_mktsegment AS biscuit_tom,
                  CASE WHEN c_custkey % 2 = 0 THEN 'Perk, Yum' ELSE 'Royal' END AS biscuit_awareness,
                  CASE WHEN c_custkey % 3 = 0 THEN 'McBerry, Nutrisnax' ELSE 'biscuit_advertising' END
                    AS biscuit_extra_aware,
                  'TV, Radio' AS biscuit_advertising,
                  CAST(c_nationkey AS VARCHAR) AS biscuit_consumed_often
           FROM customer WHERE c_custkey % 7 <> 0),
u AS (UNPIVOT v ON biscuit_tom, biscuit_awareness, biscuit_extra_aware, biscuit_advertising,
                   biscuit_consumed_often INTO NAME category VALUE Product_List),
e AS (SELECT v.SubjectNum, t.category, '' AS Product_List
      FROM v, (VALUES """ + ", ".join(f"('{c}')" for c in _D27_EMPTY) + """) t(category))
SELECT category, SubjectNum, CAST(1 AS BIGINT) AS Distinct_SubjectNum_Count, Product_List FROM u
UNION ALL
SELECT category, SubjectNum, CAST(1 AS BIGINT), Product_List FROM e
""")
def q_d27(spark, sf_dir):
    """D27 end to end: 13 loose lookups, then the 13 per-column respondent
    lists (AGG-1 after the 11-column EX-1) in one linear pass."""
    answers = materialize_stream(documents_to_stream(customer_interviews(spark, sf_dir)))
    spec = BY_ID["D27"]
    wide = run_spec(spec.__class__(**{**spec.__dict__, "explode": None}), answers)
    cols = list(spec.blocks[0].variables)
    return option_lists(wide, "SubjectNum", cols, spec.explode[0], spec.explode[1])


def sku_summaries(long, period: str):
    """SET-2 + SNK-6: the long SKU table -> the two typed summary tables
    (present columns, deduplicated within each SKU table, SC-10 casts)."""
    from ..sinks.writers import SKU_SALES_INFO, SKU_SUMMARY, conform

    with_period = long.withColumn("Period", F.to_date(F.lit(period)))
    return (conform(with_period, SKU_SUMMARY).dropDuplicates(),
            conform(with_period, SKU_SALES_INFO).dropDuplicates())


RUN_PERIOD = "2024-03-01"   # PRJ-1 / X7: Period is a run parameter


@query("set2_sku_sales_info_from_xml", _D02_CTES + f"""
SELECT DISTINCT '{RUN_PERIOD}' AS Period, SubjectNum, Date, Upload, Variable,
       CAST(NULL AS DECIMAL(10, 2)) AS Quantity_Delivered, TRY_CAST(trim(Price) AS DECIMAL(10, 2)) AS Price,
       CAST(NULL AS DECIMAL(10, 2)) AS Estimated_Sales, CAST(NULL AS INTEGER) AS Pack_Quantity,
       CAST(NULL AS INTEGER) AS Keg_Quantity
FROM c
""")
def q_sku_sales(spark, sf_dir):
    """D02 -> SKU sales summary: typed (DECIMAL/INT via try_cast), Period
    first, duplicates from the Display_Location explode removed."""
    answers = materialize_stream(documents_to_stream(part_interviews(spark, sf_dir)))
    long = run_spec(BY_ID["D02"], answers)
    _, sales = sku_summaries(long, RUN_PERIOD)
    return sales.select(F.col("Period").cast("string").alias("Period"), "SubjectNum",
                        F.date_format("Date", OUT_TS).alias("Date"), F.date_format("Upload", OUT_TS).alias("Upload"),
                        "Variable", "Quantity_Delivered", "Price", "Estimated_Sales", "Pack_Quantity", "Keg_Quantity")



def impression_interviews(spark, sf_dir):
    """One brand-impression interview per order: two grid statements (record
    1), the first statement again for even orders (record 2), then two
    'brand_impression' section picks between markers."""
    from .catalog import D19_STATEMENTS

    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-03-04T05:06:07Z")}
    pick = lambda v: F.concat(F.lit("<Variable>brand_impression</Variable><FullVariable>"),
                              v, F.lit("</FullVariable>"))
    parts = [
        F.when(k % 5 != 0, grid(D19_STATEMENTS[0], F.col("o_orderpriority"))),
        F.when(k % 5 != 0, grid(D19_STATEMENTS[9], F.col("o_orderstatus"))),
        F.when((k % 5 != 0) & (k % 2 == 0), grid(D19_STATEMENTS[0], F.col("o_orderstatus"))),
        pick(F.lit("strong")),
        pick(F.substring("o_orderpriority", 3, 20)),
        F.lit("<Variable>overall_best</Variable>"),
    ]
    return _spread(o, k, interview_document(header, parts))


@query("d19_impression_from_xml", """
SELECT o_orderkey AS subject_id, CAST(o_orderkey AS VARCHAR) AS SubjectNum, '2024-03-04 05:06:07' AS Upload,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS first_statement,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS other_statement, x AS brand_impression
FROM orders, unnest(['strong', substr(o_orderpriority, 3, 20)]) AS u(x)
""")
def q_d19(spark, sf_dir):
    """D19 end to end: grid records (GRP-1, strict Text/TopicAnswer), the
    section list (GRP-3 in the half-open marker slice) sitting on record 1
    only, then the explode keeps record 1 only (FIL-7 parity)."""
    from .catalog import D19_STATEMENTS

    answers = materialize_stream(documents_to_stream(impression_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D19"], answers)
    return out.select(SUBJECT, "SubjectNum", F.date_format("Upload", OUT_TS).alias("Upload"),
                      F.col(f"`{D19_STATEMENTS[0]}`").alias("first_statement"),
                      F.col(f"`{D19_STATEMENTS[9]}`").alias("other_statement"), "brand_impression")


def stock_interviews(spark, sf_dir):
    """One old-items interview per order: two grid items (ITEM_NAME opens a
    record) beside two coded sales records, the outlet code asked first."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority",
                   "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-03-04T05:06:07Z")}
    parts = [
        grid("ITEM_NAME", F.concat(F.lit("item-"), F.col("o_orderstatus"))),
        grid("SALES", F.col("o_orderpriority")),
        grid("ITEM_NAME", F.lit("second")),
        question("outlet_code", F.col("o_custkey")),
        question("I_1_old_current_sales", F.col("o_totalprice")),
        question("I_1_old_current_price", F.lit("1.5")),
        question("I_2_old_current_sales", F.lit("0")),
    ]
    return _spread(o, k, interview_document(header, parts))


@query("d40_old_items_from_xml", """
SELECT o_orderkey AS subject_id, CAST(1 AS BIGINT) AS rec, 'item-' || o_orderstatus AS ITEM_NAME,
       o_orderpriority AS SALES, CAST(o_totalprice AS VARCHAR) AS old_current_sales,
       '1.5' AS old_current_price, CAST(o_custkey AS VARCHAR) AS outlet_code FROM orders
UNION ALL
SELECT o_orderkey, CAST(2 AS BIGINT), 'second', NULL, '0', NULL, CAST(o_custkey AS VARCHAR) FROM orders
""")
def q_d40(spark, sf_dir):
    """D40 end to end (GRP-4): grid item records and coded records zipped by
    record number (JN-2), outlet code filled from the first record (JN-3)."""
    answers = materialize_stream(documents_to_stream(stock_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D40"], answers)
    return out.select(SUBJECT, "rec", "ITEM_NAME", "SALES", "old_current_sales", "old_current_price",
                      "outlet_code")


def audit_interviews(spark, sf_dir):
    """One audit-capture interview per supplier: question block, a strict
    six-part GPS address (odd suppliers lack the speed line), and grid
    labels -- 'City' left unanswered."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    t = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)              # 25 rows, bounded
    k = F.col("s_suppkey")
    ts = F.lit("2024-05-06T07:08:09Z")
    header = {"SubjectNum": k, "Upload": ts, "VisitStart": ts, "VisitEnd": F.lit(""),
              "ClientDuration": F.lit("00:12"), "Date": ts, "SurveyorName": F.col("s_name")}
    gps = F.concat(F.lit("Latitude: "), (k % 60).cast("string"), F.lit(" 36' 12.0 N (5.6)\n"),
                   F.lit("Longitude: 0 11' W (-0.18)\nCaptured at: 2024-01-02 10:11:12\n"),
                   F.lit("Altitude: "), (k % 100).cast("string"), F.lit("\nBearing: 10.0\n"),
                   F.when(k % 2 == 0, F.lit("Speed: 1.5 km/h")).otherwise(F.lit("")))
    parts = [
        question("surveyor", F.col("s_name")),
        question("outlet_name", F.col("n_name")),
        question("outlet_code", k),
        question("address", gps),
        question("item_count", F.col("s_nationkey")),
        grid("Country", F.col("n_name")),
        grid("City", None),
        grid("Landmark", F.concat(F.lit("near "), k.cast("string"))),
    ]
    return _spread(t, k, interview_document(header, parts), s)


@query("d41_audit_profile_from_xml", """
SELECT s_suppkey AS subject_id, CAST(s_suppkey AS VARCHAR) AS SubjectNum, s_name AS SurveyorName,
       '00:12' AS NetDuration, s_name AS surveyor, n_name AS outlet_name, CAST(s_suppkey AS VARCHAR) AS outlet_code,
       CAST(NULL AS VARCHAR) AS prev_item_count, CAST(s_nationkey AS VARCHAR) AS item_count,
       n_name AS Country, 'Landmark' AS City, 'near ' || s_suppkey AS Landmark,
       CAST(NULL AS VARCHAR) AS Direction,
       CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 60 AS VARCHAR) || ' 36'' 12.0 N' END AS GPS_Latitude,
       CASE WHEN s_suppkey % 2 = 0 THEN '0 11'' W' END AS GPS_Longitude,
       CASE WHEN s_suppkey % 2 = 0 THEN '2024-01-02 10:11:12' END AS GPS_Date,
       CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 100 AS VARCHAR) END AS GPS_Altitude,
       CASE WHEN s_suppkey % 2 = 0 THEN '10.0' END AS GPS_Bearing,
       CASE WHEN s_suppkey % 2 = 0 THEN '1.5' END AS "GPS_Speed (km/h)"
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def q_d41(spark, sf_dir):
    """D41 end to end: two loose lookup blocks side by side (questions and
    grid labels; an unanswered label yields the next label's name), strict
    GPS layout (all six parts or none), header of seven elements."""
    answers = materialize_stream(documents_to_stream(audit_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D41"], answers)
    return out.select(SUBJECT, "SubjectNum", "SurveyorName", "NetDuration", "surveyor", "outlet_name",
                      "outlet_code", "prev_item_count", "item_count", "Country", "City", "Landmark",
                      "Direction", *[F.col(f"`{c}`") for c in
                                     ["GPS_Latitude", "GPS_Longitude", "GPS_Date", "GPS_Altitude",
                                      "GPS_Bearing", "GPS_Speed (km/h)"]])


def outlet_interviews(spark, sf_dir):
    """One outlet-recruitment interview per customer: loop-prefixed country
    question, an unanswered contact, a strict GPS address (odd customers lack
    the bearing line) and the loop counter 'iterindex'."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    t = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)              # 25 rows, bounded
    k = F.col("c_custkey")
    ts = F.lit("2024-06-07T08:09:10Z")
    header = {"SubjectNum": k, "Upload": ts, "VisitStart": ts, "VisitEnd": ts, "ClientDuration": F.lit("00:30"),
              "Date": ts, "SurveyorName": F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))}
    gps = F.concat(F.lit("Latitude: 1 2' 3.0 N (1.0)\nLongitude: 4 5' W (-4.1)\nCaptured at: 2024-06-07 08:00:00\n"),
                   F.lit("Altitude: "), (k % 90).cast("string"), F.lit("\n"),
                   F.when(k % 2 == 0, F.lit("Bearing: 7.5\n")).otherwise(F.lit("")), F.lit("Speed: 3 km/h"))
    parts = [
        question("I_1_country_name", F.col("n_name")),
        question("city", F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))),
        question("outlet_code", k),
        question("outlet_name", F.col("c_name")),
        question("contact", None),
        question("address", gps),
        question("iterindex", k % 5),
    ]
    return _spread(t, k, interview_document(header, parts), c)


@query("d38_recruit_profile_from_xml", """
SELECT c_custkey AS subject_id, CAST(c_custkey AS VARCHAR) AS SubjectNum, 'S' || c_nationkey AS SurveyorName,
       '00:30' AS NetDuration, n_name AS country_name, 'City ' || c_nationkey AS city,
       CAST(c_custkey AS VARCHAR) AS outlet_code, c_name AS outlet_name, 'address' AS contact,
       CAST(c_custkey % 5 AS VARCHAR) AS item_count, CAST(NULL AS VARCHAR) AS landmark,
       CASE WHEN c_custkey % 2 = 0 THEN '1 2'' 3.0 N' END AS GPS_Latitude,
       CASE WHEN c_custkey % 2 = 0 THEN '4 5'' W' END AS GPS_Longitude,
       CASE WHEN c_custkey % 2 = 0 THEN '2024-06-07 08:00:00' END AS GPS_Date,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 90 AS VARCHAR) END AS GPS_Altitude,
       CASE WHEN c_custkey % 2 = 0 THEN '7.5' END AS GPS_Bearing,
       CASE WHEN c_custkey % 2 = 0 THEN '3' END AS "GPS_Speed (km/h)"
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q_d38(spark, sf_dir):
    """D38 end to end: SC-5 before a loose lookup (an unanswered contact yields
    the next question's name), PRJ-2 iterindex -> item_count, strict GPS, a
    seven-element header."""
    answers = materialize_stream(documents_to_stream(outlet_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D38"], answers)
    return out.select(SUBJECT, "SubjectNum", "SurveyorName", "NetDuration", "country_name", "city",
                      "outlet_code", "outlet_name", "contact", "item_count", "landmark",
                      *[F.col(f"`{c}`") for c in ["GPS_Latitude", "GPS_Longitude", "GPS_Date",
                                                  "GPS_Altitude", "GPS_Bearing", "GPS_Speed (km/h)"]])


def salon_interviews(spark, sf_dir):
    """One salon census interview per part: category and wet/dry segment
    answers (questions with no cell are not asked at all)."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.col("p_partkey")
    cat = (F.when(F.col("p_size") % 3 == 0, F.lit("Wet, Dry Hair"))
           .when(F.col("p_size") % 3 == 1, F.concat("p_type", F.lit(", Wet"))))
    wet = F.when(F.col("p_size") % 2 == 0, F.regexp_replace("p_name", " ", ", "))
    dry = F.when(F.col("p_size") % 5 != 0, F.col("p_brand"))
    ts = F.lit("2024-07-01T10:00:00Z")
    header = {"SubjectNum": k, "Upload": ts, "Date": ts}
    asked = lambda name, v: F.when(v.isNotNull(), question(name, v))
    parts = [question("Outlet_code", k), asked("Category", cat), asked("segment_wet", wet),
             asked("segment_dry", dry)]
    return _spread(p, k, interview_document(header, parts))


@query("d07_category_segments_from_xml", """
WITH t AS (SELECT p_partkey,
                  CASE WHEN p_size % 3 = 0 THEN 'Wet, Dry Hair'
                       WHEN p_size % 3 = 1 THEN p_type || ', Wet' END AS Category,
                  CASE WHEN p_size % 2 = 0 THEN replace(p_name, ' ', ', ') END AS segment_wet,
                  CASE WHEN p_size % 5 <> 0 THEN p_brand END AS segment_dry
           FROM part),
l AS (SELECT p_partkey,
             CASE WHEN Category IS NULL THEN [''] ELSE list_transform(string_split(Category, ','), lambda x: trim(x)) END AS cats,
             CASE WHEN segment_wet IS NULL THEN [''] ELSE list_transform(string_split(segment_wet, ','), lambda x: trim(x)) END AS wets,
             CASE WHEN segment_dry IS NULL THEN [''] ELSE list_transform(string_split(segment_dry, ','), lambda x: trim(x)) END AS drys,
             coalesce(list_sort(list_transform(string_split(Category, ','), lambda x: lower(trim(x))))
                      = ['dry hair', 'wet'], false) AS combo
      FROM t),
r AS (
  SELECT p_partkey, 'Wet' AS Category, w AS segment_wet, '' AS segment_dry FROM l, unnest(wets) AS u(w) WHERE combo
  UNION ALL SELECT p_partkey, 'Dry Hair', '', d FROM l, unnest(drys) AS u(d) WHERE combo
  UNION ALL SELECT p_partkey, c, w, '' FROM l, unnest(cats) AS a(c), unnest(wets) AS u(w) WHERE NOT combo
  UNION ALL SELECT p_partkey, c, '', d FROM l, unnest(cats) AS a(c), unnest(drys) AS u(d) WHERE NOT combo)
SELECT p_partkey AS subject_id, CAST(p_partkey AS VARCHAR) AS SubjectNum, CAST(p_partkey AS VARCHAR) AS Outlet_code,
       Category, segment_wet, segment_dry
FROM r WHERE NOT (coalesce(segment_wet, '') = '' AND coalesce(segment_dry, '') = '')
""")
def q_d07(spark, sf_dir):
    """D07 end to end: loose lookups, then EX-4 (the wet + dry-hair pair rule,
    per-category rows otherwise) and FIL-6 inside the spec interpreter."""
    answers = materialize_stream(documents_to_stream(salon_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D07"], answers)
    return out.select(SUBJECT, "SubjectNum", "Outlet_code", "Category", "segment_wet", "segment_dry")


def census_interviews(spark, sf_dir):
    """One salon census interview per customer: outlet code, a GPS text (the
    DMS layout; every fifth without the optional lines) and an extra-category
    multi-select with spaces after the commas."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    ts = F.lit("2024-08-01T12:00:00Z")
    header = {"SubjectNum": k, "Date": ts, "Upload": ts}
    parts = [question("Outlet_code", k),
             question("GPS", _gps_text(k, F.col("c_nationkey"))),
             question("category_extra", F.concat(F.col("c_mktsegment"), F.lit(", Nails,  Spa")))]
    return _spread(c, k, interview_document(header, parts))


@query("d03_location_from_xml", """
SELECT c_custkey AS subject_id, CAST(c_custkey AS VARCHAR) AS Outlet_code,
       CAST(c_nationkey AS VARCHAR) || ' 12'' 30.5 N' AS GPS_Latitude,
       CAST(c_custkey % 180 AS VARCHAR) || ' 10'' W' AS GPS_Longitude,
       '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:11:12' AS GPS_Date,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS VARCHAR) || '.0' END AS GPS_Altitude,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '10.0' END AS GPS_Bearing,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '1.5' END AS "GPS_Speed (km/h)"
FROM customer
""")
def q_d03(spark, sf_dir):
    """D03 end to end: loose lookup of the outlet code and the GPS text, parsed
    into six parts (SC-4, CRLF normalised by the XML parser)."""
    answers = materialize_stream(documents_to_stream(census_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D03"], answers)
    return out.select(SUBJECT, "Outlet_code", *[F.col(f"`{c}`") for c in
                                                ["GPS_Latitude", "GPS_Longitude", "GPS_Date", "GPS_Altitude",
                                                 "GPS_Bearing", "GPS_Speed (km/h)"]])


def extra_category(spark, sf_dir, spec):
    """The D06 job over the census interviews."""
    answers = materialize_stream(documents_to_stream(census_interviews(spark, sf_dir)))
    return run_spec(spec, answers).select(SUBJECT, "Outlet_code", "category_extra")


@query("d06_extra_category_from_xml", """
SELECT c_custkey AS subject_id, CAST(c_custkey AS VARCHAR) AS Outlet_code, x AS category_extra
FROM customer, unnest(string_split(c_mktsegment || ', Nails,  Spa', ',')) AS u(x)
""")
def q_d06(spark, sf_dir):
    """D06 end to end: the extra-category answer split on ',' WITHOUT trimming
    (EX-2): leading spaces stay in the options."""
    return extra_category(spark, sf_dir, BY_ID["D06"])


def availability_interviews(spark, sf_dir):
    """One product-availability interview per order: two SKU loops (I_1_, I_2_)
    each opened by the first SKU's availability question."""
    from .catalog import MSD_SKUS

    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-09-01T06:00:00Z")}
    first, other = MSD_SKUS[0] + "_Visit_Availability", MSD_SKUS[5] + "_Visit_Availability"
    parts = [question(f"I_1_{first}", F.col("o_orderstatus")),
             question(f"I_1_{other}", F.col("o_orderpriority")),
             question(f"I_2_{first}", F.lit("Yes")),
             F.when(k % 2 == 0, question(f"I_2_{other}", None))]        # unanswered -> NULL (strict)
    return _spread(o, k, interview_document(header, parts))


@query("d11_availability_from_xml", """
SELECT o_orderkey AS subject_id, CAST(1 AS BIGINT) AS rec, o_orderstatus AS first_sku, o_orderpriority AS other_sku
FROM orders
UNION ALL
SELECT o_orderkey, CAST(2 AS BIGINT), 'Yes', NULL FROM orders
""")
def q_d11(spark, sf_dir):
    """D11 end to end: loop prefixes stripped, records opened by the first
    SKU's question (GRP-1), strict answers, header pairs beside every record."""
    from .catalog import MSD_SKUS

    answers = materialize_stream(documents_to_stream(availability_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D11"], answers)
    return out.select(SUBJECT, "rec", F.col(f"`{MSD_SKUS[0]}_Visit_Availability`").alias("first_sku"),
                      F.col(f"`{MSD_SKUS[5]}_Visit_Availability`").alias("other_sku"))


def consumer_interviews(spark, sf_dir):
    """One consumer-recruitment interview per customer: profile questions and
    a product-category grid opened by 'Toothpaste'."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    ts = F.lit("2024-10-01T09:00:00Z")
    header = {"SubjectNum": k, "Upload": ts, "VisitStart": ts, "VisitEnd": ts,
              "ClientDuration": F.lit("00:20"), "Date": ts}
    parts = [question("surveyor", F.col("c_name")), question("city", F.col("c_nationkey")),
             question("income", F.col("c_mktsegment")),
             F.when(k % 5 != 0, F.concat(grid("Toothpaste", F.lit("Daily")), grid("Food Seasoning", F.col("c_mktsegment")))),
             F.when((k % 5 != 0) & (k % 3 == 0), grid("Toothpaste", F.lit("Weekly")))]
    return _spread(c, k, interview_document(header, parts))


@query("d24_consumer_profile_from_xml", """
SELECT c_custkey AS subject_id, CAST(1 AS BIGINT) AS rec, CAST(c_custkey AS VARCHAR) AS SubjectNum, c_name AS surveyor,
       CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS income,
       CASE WHEN c_custkey % 5 <> 0 THEN 'Daily' END AS Toothpaste,
       CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS "Food Seasoning"
FROM customer
UNION ALL
SELECT c_custkey, CAST(2 AS BIGINT), CAST(c_custkey AS VARCHAR), NULL, NULL, NULL, 'Weekly', NULL
FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 <> 0
""")
def q_d24(spark, sf_dir):
    """D24 end to end: loose profile lookups (on the first record only)
    beside grid records opened by the 'Toothpaste' sentinel; every fifth
    interview has no grid records and keeps its row 1."""
    answers = materialize_stream(documents_to_stream(consumer_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D24"], answers)
    return out.select(SUBJECT, "rec", "SubjectNum", "surveyor", "city", "income", "Toothpaste", "`Food Seasoning`")


def media_interviews(spark, sf_dir):
    """One media-habits interview per customer: reach channel, radio and TV
    multi-selects, then a grid of channels opened by 'TV' (two records for
    every fourth customer)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    k = F.col("c_custkey")
    ts = F.lit("2024-11-01T09:00:00Z")
    header = {"SubjectNum": k, "Upload": ts, "Date": ts}
    parts = [question("channel_for_reach", F.col("c_mktsegment")),
             question("radio_stations", F.concat(F.lit("R"), (k % 3).cast("string"), F.lit(", R9"))),
             question("tv_stations", F.when(k % 2 == 0, F.lit("T1, , T2")).otherwise(F.lit("T1"))),
             F.when(k % 5 != 0, F.concat(grid("TV", F.lit("Often")), grid("Radio", (k % 7).cast("string")))),
             F.when((k % 5 != 0) & (k % 4 == 0), grid("TV", F.lit("Never")))]
    return _spread(c, k, interview_document(header, parts))


@query("d16_media_from_xml", """
SELECT c_custkey AS subject_id, c_mktsegment AS channel_for_reach, r AS radio_stations, t AS tv_stations,
       CAST(c_custkey AS VARCHAR) AS SubjectNum, CASE WHEN c_custkey % 5 <> 0 THEN 'Often' END AS TV,
       CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 7 AS VARCHAR) END AS Radio
FROM customer, unnest(['R' || (c_custkey % 3), 'R9']) AS a(r),
     unnest(CASE WHEN c_custkey % 2 = 0 THEN ['T1', 'T2'] ELSE ['T1'] END) AS b(t)
""")
def q_d16(spark, sf_dir):
    """D16 end to end: lookups zipped beside grid records (cells on record 1
    only), EX-1 over two multi-selects (row product, blank option dropped);
    later records have only NULL explode cells and drop out (FIL-7)."""
    answers = materialize_stream(documents_to_stream(media_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D16"], answers)
    return out.select(SUBJECT, "SubjectNum", "channel_for_reach", "radio_stations", "tv_stations", "TV", "Radio")


def bike_interviews(spark, sf_dir):
    """One brand-description interview per supplier: a grid of bike brands;
    'Boxer.' is asked twice (the later answer wins), 'Sanya.' is unanswered."""
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-12-01T09:00:00Z")}
    parts = [grid("Boxer.", F.lit("first")), grid("Honda.", F.col("s_name")),
             grid("Sanya.", None), grid("Boxer.", (k % 10).cast("string"))]
    return _spread(s, k, interview_document(header, parts))


@query("d33_brand_description_from_xml", """
SELECT s_suppkey AS subject_id, CAST(1 AS BIGINT) AS rec, CAST(s_suppkey AS VARCHAR) AS SubjectNum,
       CAST(s_suppkey % 10 AS VARCHAR) AS boxer, s_name AS honda, CAST(NULL AS VARCHAR) AS sanya,
       CAST(NULL AS VARCHAR) AS yamaha
FROM supplier
""")
def q_d33(spark, sf_dir):
    """D33 end to end: a sentinel that never fires gives one record (GRP-2);
    a repeated label keeps its LAST answer; an unanswered label is NULL."""
    answers = materialize_stream(documents_to_stream(bike_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D33"], answers)
    return out.select(SUBJECT, "rec", "SubjectNum", F.col("`Boxer.`").alias("boxer"),
                      F.col("`Honda.`").alias("honda"), F.col("`Sanya.`").alias("sanya"),
                      F.col("`Yamaha.`").alias("yamaha"))


def sales_interviews(spark, sf_dir):
    """One product-sales interview per order: two item loops where the record
    sentinel ('Stock') is the THIRD question of an item."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    k = F.col("o_orderkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-12-24T10:00:00Z")}
    parts = [question("I_1_product_name", F.lit("p1")), question("I_1_item_name", F.col("o_orderstatus")),
             question("I_1_Stock", F.lit("10")), question("I_1_Price", F.col("o_custkey")),
             question("I_2_product_name", F.lit("p2")), question("I_2_item_name", F.col("o_orderpriority")),
             question("I_2_Stock", F.lit("20"))]
    return _spread(o, k, interview_document(header, parts))


@query("d21_product_sales_from_xml", """
SELECT o_orderkey AS subject_id, CAST(1 AS BIGINT) AS rec, 'p2' AS product_name, o_orderpriority AS item_name,
       '10' AS Stock, CAST(o_custkey AS VARCHAR) AS Price FROM orders
UNION ALL
SELECT o_orderkey, CAST(2 AS BIGINT), NULL, NULL, '20', NULL FROM orders
""")
def q_d21(spark, sf_dir):
    """D21 end to end: the sentinel is not the first question of an item, so
    the next item's leading answers land in the PREVIOUS record (last wins),
    exactly as the positional walk does."""
    answers = materialize_stream(documents_to_stream(sales_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D21"], answers)
    return out.select(SUBJECT, "rec", "product_name", "item_name", "Stock", "Price")


def detail_interviews(spark, sf_dir):
    """One product-details interview per part: one item loop, then a closing
    DONE item; the brand is left unanswered."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")
    k = F.col("p_partkey")
    header = {"SubjectNum": k, "Upload": F.lit("2024-12-30T10:00:00Z")}
    parts = [question("I_1_item_category", F.col("p_type")), question("I_1_item_name", F.col("p_name")),
             question("I_1_item_brand", None), question("I_1_item_manufacturer", F.col("p_brand")),
             question("I_2_item_category", F.lit("DONE"))]
    return _spread(p, k, interview_document(header, parts))


@query("d22_product_details_from_xml", """
SELECT p_partkey AS subject_id, p_type AS item_category, p_name AS item_name,
       CAST(NULL AS VARCHAR) AS item_brand, p_brand AS item_manufacturer
FROM part
""")
def q_d22(spark, sf_dir):
    """D22 end to end: strict records opened by item_category (prefix
    stripped), an unanswered question is NULL, the DONE record removed."""
    answers = materialize_stream(documents_to_stream(detail_interviews(spark, sf_dir)))
    out = run_spec(BY_ID["D22"], answers)
    return out.select(SUBJECT, "item_category", "item_name", "item_brand", "item_manufacturer")
