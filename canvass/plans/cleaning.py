"""Scalar cleaning (SC-*), quarantine (QUA-*) and source ranges (SRC-1/2/3/7)
over text cells derived from ``events``, ``customer``, ``part`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import (duration_seconds, gps_columns, loop_index, normalise_name,
                                 parse_optional_ts, parse_survey_ts, split_trim_join,
                                 strip_loop_prefix, strip_parenthetical, to_decimal, to_int,
                                 tolerant_ts, ts_parse_failed)
from ..operators.quality import empty_day_report, quarantine
from ..sources.ranges import day_range, explode_ids, range_scan
from ..sources.tables import read_table
from .registry import query

OUT_TS = "yyyy-MM-dd HH:mm:ss"


def _upload_texts(spark, sf_dir):
    """Interview-style upload texts: error events carry a fractional second,
    which the survey format does not allow."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value", "props")
    text = (F.when(F.col("event_type") == "error",
                   F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return e.withColumn("upload_text", text)


@query("sc1_sc3_parse_upload", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS upload,
       CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS upload_raw
FROM events
""")
def q_sc1(spark, sf_dir):
    """SC-1 strict survey timestamp parse (fraction -> NULL) and SC-3 tolerant
    form (the raw text kept when the parse fails)."""
    e = _upload_texts(spark, sf_dir)
    tol = tolerant_ts("upload_text")
    return e.select("event_id", F.date_format(parse_survey_ts("upload_text"), OUT_TS).alias("upload"),
                    tol["raw"].alias("upload_raw"))


@query("sc2_optional_visit_end", """
SELECT event_id,
       CASE WHEN event_type IN ('view', 'click') THEN NULL
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS visit_end
FROM events
""")
def q_sc2(spark, sf_dir):
    """SC-2: optional timestamp; blank or NULL text is a legal NULL."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    text = (F.when(F.col("event_type") == "view", F.lit(""))
            .when(F.col("event_type") == "click", F.lit(None).cast("string"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return e.select("event_id", F.date_format(parse_optional_ts(text), OUT_TS).alias("visit_end"))


def _gps_text(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    nl = F.when(k % 2 == 1, F.lit("\r\n")).otherwise(F.lit("\n"))
    lat = F.concat(F.col("c_nationkey").cast("string"), F.lit(" 12' 30.5 N"))
    lon = F.concat((k % 180).cast("string"), F.lit(" 10' W"))
    cap = F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit(" 10:11:12"))
    tail = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(
        F.lit("Altitude: "), (k % 100).cast("string"), F.lit(".0"), nl, F.lit("Bearing: 10.0"), nl,
        F.lit("Speed: 1.5 km/h")))
    text = F.concat(F.lit("Latitude: "), lat, F.lit(" ("), (k % 90).cast("string"), F.lit(".5)"), nl,
                    F.lit("Longitude: "), lon, F.lit(" (-"), (k % 180).cast("string"), F.lit(".25)"), nl,
                    F.lit("Captured at: "), cap, nl, tail)
    return c.select("c_custkey", text.alias("gps_address"))


@query("sc4_gps_parse", """
WITH t AS (SELECT c_custkey, c_nationkey, c_custkey % 5 = 0 AS short, c_custkey % 2 = 1 AS crlf FROM customer)
SELECT c_custkey,
       CAST(c_nationkey AS VARCHAR) || ' 12'' 30.5 N' AS GPS_Latitude,
       CAST(c_custkey % 180 AS VARCHAR) || ' 10'' W' AS GPS_Longitude,
       '2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:11:12' AS GPS_Date,
       CASE WHEN short THEN NULL ELSE CAST(c_custkey % 100 AS VARCHAR) || '.0' END AS GPS_Altitude,
       CASE WHEN short THEN NULL ELSE '10.0' END AS GPS_Bearing,
       CASE WHEN short THEN NULL ELSE '1.5' END AS "GPS_Speed (km/h)",
       CASE WHEN short THEN NULL ELSE '' END AS speed_parity,
       CAST(c_custkey % 90 AS DOUBLE) + 0.5 AS lat_decimal,
       -(CAST(c_custkey % 180 AS DOUBLE) + 0.25) AS lon_decimal,
       CASE WHEN crlf OR short THEN NULL ELSE CAST(c_nationkey AS VARCHAR) || ' 12'' 30.5 N' END AS strict_latitude
FROM t
""")
def q_sc4(spark, sf_dir):
    """SC-4a/b/c: six GPS parts from a multi-line text (LF and CRLF, with and
    without the optional lines); decimal and strict layouts beside."""
    g = _gps_text(spark, sf_dir)
    fixed = gps_columns("gps_address", "dms_fixed")
    parity = gps_columns("gps_address", "dms")
    dec = gps_columns("gps_address", "decimal")
    strict = gps_columns("gps_address", "strict")
    return g.select("c_custkey", *fixed, parity[5].alias("speed_parity"),
                    dec[0].alias("lat_decimal"), dec[1].alias("lon_decimal"),
                    strict[0].alias("strict_latitude"))


_NAMES_SQL = """
WITH t AS (SELECT p_partkey, p_type, p_name, p_brand,
                  'I_' || p_size || '_' || p_name || ' (' || p_brand || ') x (' || p_type || ') I_'
                    || p_partkey || '_end' AS raw FROM part)
SELECT p_partkey,
       regexp_replace(raw, 'I_\\d+_', '', 'g') AS stripped,
       regexp_replace(regexp_replace(raw, 'I_\\d+_', '', 'g'), '\\(.*\\)', '') AS no_paren,
       CAST(regexp_extract(raw, 'I_(\\d+)_', 1) AS BIGINT) AS iter_index,
       substr(translate(lower(p_type || '/' || p_name || '-' || p_brand), ' /-', '___'), 1, 64) AS normalised
FROM t
"""


@query("sc5_sc6_sc8_names", _NAMES_SQL)
def q_names(spark, sf_dir):
    """SC-5 loop-prefix strip (+ the loop number), SC-6 greedy parenthetical
    strip, SC-8 name normalisation."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_name", "p_brand", "p_size")
    raw = F.concat(F.lit("I_"), F.col("p_size").cast("string"), F.lit("_"), "p_name", F.lit(" ("),
                   "p_brand", F.lit(") x ("), "p_type", F.lit(") I_"), F.col("p_partkey").cast("string"),
                   F.lit("_end"))
    stripped = strip_loop_prefix(raw)
    return p.select("p_partkey", stripped.alias("stripped"),
                    strip_parenthetical(stripped).alias("no_paren"),
                    loop_index(raw).alias("iter_index"),
                    normalise_name(F.concat("p_type", F.lit("/"), "p_name", F.lit("-"), "p_brand"))
                    .alias("normalised"))


@query("sc7_split_trim_join", """
SELECT p_partkey,
       array_to_string(list_filter(list_transform(string_split(replace(p_name, ' ', ' , , '), ','),
                                                  lambda t: trim(t)), lambda t: t <> ''), ', ') AS options
FROM part
""")
def q_sc7(spark, sf_dir):
    """SC-7: split, trim, drop blank options, join with ', '."""
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    return p.select("p_partkey",
                    split_trim_join(F.regexp_replace("p_name", " ", " , , ")).alias("options"))


@query("sc10_numeric_cast", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
       TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END
                AS DECIMAL(10, 2)) AS value_dec
FROM events
""")
def q_sc10(spark, sf_dir):
    """SC-10: load-time numeric casts; bad text -> NULL."""
    e = read_table(spark, sf_dir, "events", "event_id", "event_type", "value", "props")
    vtext = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return e.select("event_id", to_int(F.get_json_object("props", "$.k")).alias("k_int"),
                    to_decimal(vtext).alias("value_dec"))


@query("qua1_row_quarantine", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN 'reject'
            WHEN event_type = 'click' AND value > 100 THEN 'reject' ELSE 'valid' END AS status,
       CASE WHEN event_type = 'error' THEN 'bad_upload'
            WHEN event_type = 'click' AND value > 100 THEN 'bad_value' END AS reason
FROM events
""")
def q_qua1(spark, sf_dir):
    """QUA-1: one quarantine policy -- a status and a reason per row."""
    e = _upload_texts(spark, sf_dir)
    vtext = (F.when((F.col("event_type") == "click") & (F.col("value") > 100), F.lit("n/a"))
             .otherwise(F.col("value").cast("string")))
    q = quarantine(e, {"bad_upload": ts_parse_failed("upload_text"),
                       "bad_value": to_decimal(vtext).isNull()})
    return q.select("event_id", "status", "reason")


@query("qua2_src1_empty_day_report", """
WITH b AS (SELECT CAST(min(ts) AS DATE) - 2 AS s, CAST(max(ts) AS DATE) + 2 AS e FROM events),
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT d.day, coalesce(c.n, 0) AS n, c.n IS NULL AS empty FROM d LEFT JOIN c USING (day)
""")
def q_qua2(spark, sf_dir):
    """SRC-1 day list (two spare days each side) + QUA-2 empty-day report."""
    e = read_table(spark, sf_dir, "events", "ts")
    bounds = e.agg(F.date_sub(F.to_date(F.min("ts")), 2).alias("s"),
                   F.date_add(F.to_date(F.max("ts")), 2).alias("e"))
    days = bounds.select(F.explode(day_range(F.col("s"), F.col("e"))).alias("day"))
    return empty_day_report(days, e)


@query("src1_active_days_per_user", """
WITH b AS (SELECT user_id, CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events GROUP BY 1)
SELECT user_id, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day FROM b
""")
def q_src1(spark, sf_dir):
    """SRC-1: inclusive day range per subject (first to last upload day)."""
    e = read_table(spark, sf_dir, "events", "user_id", "ts")
    b = e.groupBy("user_id").agg(F.min("ts").alias("s"), F.max("ts").alias("e"))
    return b.select("user_id", F.explode(day_range(F.col("s"), F.col("e"))).alias("day"))


@query("src2_upload_window_per_day", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n_ids, min(event_id) AS first_id, max(event_id) AS last_id
FROM events GROUP BY 1
""")
def q_src2(spark, sf_dir):
    """SRC-2 for every day of the range: the ids uploaded from a day's midnight
    to before the next, in one aggregate (the windows of all days tile the
    time line, so no scan or join per day)."""
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    return e.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_ids"), F.min("event_id").alias("first_id"),
                                F.max("event_id").alias("last_id"))


@query("src3_id_list_parse", """
WITH t AS (SELECT o_orderkey,
                  CASE WHEN o_orderstatus = 'P' THEN '[]'
                       ELSE '[' || o_orderkey || ',' || chr(13) || chr(10) || ' ' || o_custkey || ']' END AS ids
           FROM orders)
SELECT o_orderkey, x AS subject_id
FROM t, unnest(string_split(regexp_replace(ids, '[\\[\\]\\r\\n ]', '', 'g'), ',')) AS u(x)
WHERE x <> ''
""")
def q_src3(spark, sf_dir):
    """SRC-3: id-list text -> ids; '[]' yields none (the empty id is dropped)."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("[]")).otherwise(
        F.concat(F.lit("["), F.col("o_orderkey").cast("string"), F.lit(",\r\n "),
                 F.col("o_custkey").cast("string"), F.lit("]")))
    return explode_ids(o.select("o_orderkey", text.alias("ids")), "ids")


@query("src7_range_scan", """
SELECT event_type, count(*) AS n FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:59:59.999999'
GROUP BY event_type
""")
def q_src7(spark, sf_dir):
    """SRC-7: inclusive range predicate, pushed to the parquet scan."""
    e = read_table(spark, sf_dir, "events", "ts", "event_type")
    r = range_scan(e, "ts", "2024-01-05 00:00:00", "2024-01-25 23:59:59.999999")
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("sc11_visit_duration", """
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS VisitStart,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS VisitEnd,
       CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT) AS visit_seconds
FROM events GROUP BY user_id
""")
def q_sc11(spark, sf_dir):
    """SC-11: visit duration from the first and last upload of a subject
    (parsed back from the survey text format, so whole seconds)."""
    e = read_table(spark, sf_dir, "events", "user_id", "ts")
    b = e.groupBy("user_id").agg(F.min("ts").alias("s"), F.max("ts").alias("e"))
    s_txt = parse_survey_ts(F.date_format("s", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    e_txt = parse_survey_ts(F.date_format("e", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return b.select("user_id", F.date_format(s_txt, OUT_TS).alias("VisitStart"),
                    F.date_format(e_txt, OUT_TS).alias("VisitEnd"),
                    duration_seconds(s_txt, e_txt).alias("visit_seconds"))


@query("qua1_stream_position_check", """
SELECT 'events' AS stream, count(*) AS rows, count(DISTINCT (user_id, ts)) AS positions FROM events
UNION ALL
SELECT 'conversations', count(*), count(DISTINCT (conv_id, turn)) FROM conversations
UNION ALL
SELECT 'line_items', 14 * count(*), 14 * count(*) FROM lineitem
""")
def q_positions(spark, sf_dir):
    """QUA-1 guard: each table binding yields unique (subject, seq) positions."""
    from ..operators.quality import position_check
    from ..sources.bindings import conversation_stream, event_stream, lineitem_stream

    return (position_check(event_stream(spark, sf_dir), "events")
            .unionByName(position_check(conversation_stream(spark, sf_dir), "conversations"))
            .unionByName(position_check(lineitem_stream(spark, sf_dir), "line_items")))
