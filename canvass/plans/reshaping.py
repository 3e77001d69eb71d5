"""Multi-select expansion, reshaping, row filters and projections over cells
derived from ``part``, ``lineitem``, ``events`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import contains_comma, month_start_text
from ..operators.filters import (drop_all_null, drop_both_blank, not_done, select_present,
                                 with_period)
from ..operators.lookup import option_sets_equal
from ..operators.reshape import (expand_categories, explode_columns, explode_then_trim,
                                 explode_untrimmed, wide_to_long)
from ..sources.tables import read_table
from .registry import query


def _part_cells(spark, sf_dir):
    """Multi-select cells built from part: a two-option cell, and a cell that
    is NULL, all-blank or three options with a blank one."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    b = (F.when(F.col("p_size") % 4 == 0, F.lit(None).cast("string"))
         .when(F.col("p_size") % 4 == 1, F.lit(" , "))
         .otherwise(F.concat("p_brand", F.lit(", , "), "p_type")))
    return p.select("p_partkey", F.regexp_replace("p_name", " ", ", ").alias("a"), b.alias("b"),
                    "p_name", "p_brand", "p_type", "p_size")


_PART_CELLS_SQL = """
WITH t AS (SELECT p_partkey, replace(p_name, ' ', ', ') AS a,
                  CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN ' , '
                       ELSE p_brand || ', , ' || p_type END AS b,
                  p_name, p_brand, p_type, p_size
           FROM part)
"""


def _opts(c):
    return f"list_filter(list_transform(string_split({c}, ','), lambda x: trim(x)), lambda x: x <> '')"


@query("ex1_explode_columns", _PART_CELLS_SQL + f"""
, l AS (SELECT p_partkey, {_opts('a')} AS la, {_opts('b')} AS lb FROM t
        WHERE a IS NOT NULL OR b IS NOT NULL)
SELECT p_partkey, x AS a, y AS b
FROM l, unnest(CASE WHEN la IS NULL OR len(la) = 0 THEN [NULL::VARCHAR] ELSE la END) AS u(x),
        unnest(CASE WHEN lb IS NULL OR len(lb) = 0 THEN [NULL::VARCHAR] ELSE lb END) AS v(y)
""")
def q_ex1(spark, sf_dir):
    """EX-1: two multi-select columns exploded one after the other (per-row
    product); a NULL or all-blank cell gives one NULL row."""
    t = _part_cells(spark, sf_dir).select("p_partkey", "a", "b")
    return explode_columns(t, ["a", "b"], ",")


@query("ex2_split_untrimmed", _PART_CELLS_SQL + """
SELECT p_partkey, x AS a FROM t, unnest(string_split(a, ',')) AS u(x)
""")
def q_ex2(spark, sf_dir):
    """EX-2: split without trim (leading spaces stay)."""
    return explode_untrimmed(_part_cells(spark, sf_dir).select("p_partkey", "a"), "a", ",")


@query("ex3_explode_then_trim", _PART_CELLS_SQL + """
SELECT p_partkey, trim(x) AS b FROM t, unnest(string_split(coalesce(b, 'None'), ',')) AS u(x)
""")
def q_ex3(spark, sf_dir):
    """EX-3: explode then trim, blanks kept; parity rendering NULL -> 'None'."""
    return explode_then_trim(_part_cells(spark, sf_dir).select("p_partkey", "b"), "b", ",",
                             null_text="None")


def _category_cells(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    cat = (F.when(F.col("p_size") % 3 == 0, F.lit("Wet, Dry Hair"))
           .when(F.col("p_size") % 3 == 1, F.concat("p_type", F.lit(", Wet"))))
    wet = F.when(F.col("p_size") % 2 == 0, F.regexp_replace("p_name", " ", ", "))
    dry = F.when(F.col("p_size") % 5 != 0, F.col("p_brand"))
    return p.select("p_partkey", cat.alias("Category"), wet.alias("segment_wet"),
                    dry.alias("segment_dry"))


_CAT_SQL = """
WITH t AS (SELECT p_partkey,
                  CASE WHEN p_size % 3 = 0 THEN 'Wet, Dry Hair'
                       WHEN p_size % 3 = 1 THEN p_type || ', Wet' END AS Category,
                  CASE WHEN p_size % 2 = 0 THEN replace(p_name, ' ', ', ') END AS segment_wet,
                  CASE WHEN p_size % 5 <> 0 THEN p_brand END AS segment_dry
           FROM part)
"""


def _parts_sql(c):
    return f"CASE WHEN {c} IS NULL THEN [''] ELSE list_transform(string_split({c}, ','), lambda x: trim(x)) END"


@query("ex4_category_segments", _CAT_SQL + f"""
, l AS (SELECT p_partkey, {_parts_sql('Category')} AS cats, {_parts_sql('segment_wet')} AS wets,
               {_parts_sql('segment_dry')} AS drys,
               coalesce(list_sort(list_transform(string_split(Category, ','), lambda x: lower(trim(x))))
                        = ['dry hair', 'wet'], false) AS combo
        FROM t),
r AS (
  SELECT p_partkey, 'Wet' AS Category, w AS segment_wet, '' AS segment_dry
    FROM l, unnest(wets) AS u(w) WHERE combo
  UNION ALL SELECT p_partkey, 'Dry Hair', '', d FROM l, unnest(drys) AS u(d) WHERE combo
  UNION ALL SELECT p_partkey, c, w, '' FROM l, unnest(cats) AS a(c), unnest(wets) AS u(w) WHERE NOT combo
  UNION ALL SELECT p_partkey, c, '', d FROM l, unnest(cats) AS a(c), unnest(drys) AS u(d) WHERE NOT combo)
SELECT * FROM r WHERE NOT (coalesce(segment_wet, '') = '' AND coalesce(segment_dry, '') = '')
""")
def q_ex4(spark, sf_dir):
    """EX-4 + FIL-6: category/segment expansion with the wet/dry-hair pair rule."""
    return expand_categories(_category_cells(spark, sf_dir))


@query("fil6_drop_both_blank", _CAT_SQL + """
SELECT p_partkey FROM t
WHERE NOT (coalesce(segment_wet, '') = '' AND coalesce(segment_dry, '') = '')
""")
def q_fil6(spark, sf_dir):
    """FIL-6: drop rows whose two segment cells are both NULL or ''."""
    return drop_both_blank(_category_cells(spark, sf_dir), "segment_wet", "segment_dry").select("p_partkey")


@query("ex5_unpivot_line_measures", """
UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem)
ON l_quantity, l_discount, l_tax INTO NAME category VALUE value
""")
def q_ex5(spark, sf_dir):
    """EX-5: wide -> long over line measures (linear, no product)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity",
                    "l_discount", "l_tax")
    return wide_to_long(li, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"],
                        sep=None)


@query("ex5_wide_to_long_options", f"""
WITH t AS (SELECT p_partkey, replace(p_name, ' ', ', ') AS name_options,
                  p_type || ', ' || p_brand AS type_options FROM part),
u AS (UNPIVOT t ON name_options, type_options INTO NAME category VALUE cell)
SELECT p_partkey, category, x AS value FROM u, unnest({_opts('cell')}) AS z(x)
""")
def q_ex5_options(spark, sf_dir):
    """EX-5 + per-cell option split: one row per (respondent, column, option)."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    w = p.select("p_partkey", F.regexp_replace("p_name", " ", ", ").alias("name_options"),
                 F.concat("p_type", F.lit(", "), "p_brand").alias("type_options"))
    return wide_to_long(w, ["p_partkey"], ["name_options", "type_options"])


@query("srt1_option_set_match", """
SELECT p_partkey,
       coalesce(list_sort(list_transform(string_split(replace(p_name, ' ', ','), ','),
                                         lambda x: lower(trim(x)))) = ['ring', 'small'], false) AS is_small_ring
FROM part
""")
def q_srt1(spark, sf_dir):
    """SRT-1: case-folded sorted option set equals a fixed set."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    return p.select("p_partkey", option_sets_equal(F.regexp_replace("p_name", " ", ","),
                                                   ["small", "ring"]).alias("is_small_ring"))


@query("fil8_contains_comma", """
SELECT doc_id, coalesce(contains(text, ','), false) AS has_comma FROM documents
""")
def q_fil8(spark, sf_dir):
    """FIL-8: contains a comma, NULL -> false (over whole document texts)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", contains_comma("text").alias("has_comma"))


def _categories(spark, sf_dir):
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "value")
    cat = (F.when(F.col("event_type") == "error", F.lit("DONE"))
           .when(F.col("event_type") == "view", F.lit(None).cast("string"))
           .otherwise(F.col("event_type")))
    return e.select("event_id", cat.alias("item_category"),
                    F.when(F.col("value") > 50, F.col("value")).alias("big_value"))


@query("fil5_not_done_keeps_null", """
SELECT event_id, item_category FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'DONE' WHEN event_type = 'view' THEN NULL
                        ELSE event_type END AS item_category FROM events)
WHERE item_category IS DISTINCT FROM 'DONE'
""")
def q_fil5(spark, sf_dir):
    """FIL-5: drop item_category == 'DONE'; NULL categories are kept."""
    return not_done(_categories(spark, sf_dir).select("event_id", "item_category"))


@query("fil4_drop_all_null", """
SELECT event_id, item_category, big_value FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'DONE' WHEN event_type = 'view' THEN NULL
                        ELSE event_type END AS item_category,
         CASE WHEN value > 50 THEN value END AS big_value FROM events)
WHERE item_category IS NOT NULL OR big_value IS NOT NULL
""")
def q_fil4(spark, sf_dir):
    """FIL-4/FIL-7: drop rows whose listed columns are all NULL."""
    return drop_all_null(_categories(spark, sf_dir), ["item_category", "big_value"])


@query("prj1_period_first", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS Period, o_orderkey, o_orderstatus
FROM orders
""")
def q_prj1(spark, sf_dir):
    """PRJ-1 + SC-9: Period (month start of the upload) as the first column."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    out = with_period(o, month_start_text("o_orderdate"))
    return out.drop("o_orderdate")


@query("prj5_present_columns", """
SELECT p_partkey, p_brand, p_size FROM part
""")
def q_prj5(spark, sf_dir):
    """PRJ-5: wanted ∩ present columns, in wanted order (absent names skipped)."""
    p = read_table(spark, sf_dir, "part")
    return select_present(p, ["p_partkey", "Outlet_Code", "p_brand", "Store_Name", "p_size"])
