"""Lookups, slices and positional joins over the conversation (B1) and event
(B2) answer streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.assemble import section_values
from ..operators.filters import element_filter, marker_slice, marker_slice_inclusive
from ..operators.lookup import (first_per_subject, header_by_name, header_pairs, lookup,
                                next_answer_after_labels, sku_metric_lookup)
from ..operators.ordered import Scan, ordered_scan, with_ordinal
from ..operators.reshape import fill_from_first, positional_zip, split_metric_name
from ..schema import ELEMENT, QUESTION, SEQ, SUBJECT, VALUE
from ..sources.bindings import (EVENT_METRICS, EVENT_TYPES, conversation_stream,
                                event_interview_stream, event_stream, lineitem_stream,
                                order_header_stream)
from .registry import query

# ---------------------------------------------------------------- B1 lookups

_B1_LEAD = """
WITH s AS (
  SELECT conv_id, turn, role, text,
         lead(text) OVER w AS nt, lead(role) OVER w AS nr
  FROM conversations WHERE role IN ('user', 'assistant')
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
"""


@query("lk1_loose_first_turn", _B1_LEAD + """
SELECT conv_id AS subject_id,
       arg_min_null(nt, turn) FILTER (WHERE role = 'user') AS after_first_user,
       arg_min_null(nt, turn) FILTER (WHERE role = 'assistant') AS after_first_assistant
FROM s GROUP BY conv_id
""")
def q_lk1(spark, sf_dir):
    """LK-1 (+FIL-1): the turn after the first user / assistant turn, whatever
    its role; system turns are filtered out BEFORE the next-row scan."""
    s = conversation_stream(spark, sf_dir)
    return lookup(s, ["user", "assistant"], mode="loose", elements=("user", "assistant"),
                  question=None, answer="assistant",
                  names=["after_first_user", "after_first_assistant"])


@query("lk2_strict_first_user", _B1_LEAD + """
SELECT conv_id AS subject_id,
       arg_min_null(CASE WHEN nr = 'assistant' THEN nt END, turn) AS answer_to_first_user
FROM s WHERE role = 'user' GROUP BY conv_id
""")
def q_lk2(spark, sf_dir):
    """LK-2: the reply to the first user turn only when the next turn is an
    assistant turn (a user turn followed by a user turn = unanswered -> NULL)."""
    s = conversation_stream(spark, sf_dir)
    return lookup(s, ["user"], mode="strict", elements=("user", "assistant"), question=None,
                  answer="assistant", names=["answer_to_first_user"])


@query("fil1_reindexed_turns", """
SELECT conv_id AS subject_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, role
FROM conversations WHERE role IN ('user', 'assistant')
""")
def q_fil1(spark, sf_dir):
    """FIL-1 then re-index: the kept rows get new dense positions."""
    s = element_filter(conversation_stream(spark, sf_dir), ["user", "assistant"])
    return with_ordinal(s, "rn").select(SUBJECT, "rn", F.col(ELEMENT).alias("role"))


@query("jn2_zip_user_assistant", """
WITH u AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, text
           FROM conversations WHERE role = 'user'),
     a AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, text
           FROM conversations WHERE role = 'assistant')
SELECT coalesce(u.conv_id, a.conv_id) AS subject_id, coalesce(u.rn, a.rn) AS rn,
       u.text AS user_text, a.text AS assistant_text
FROM u FULL OUTER JOIN a ON u.conv_id = a.conv_id AND u.rn = a.rn
""")
def q_jn2(spark, sf_dir):
    """JN-2: i-th user turn beside i-th assistant turn, shorter side NULL."""
    return _zip_turns(spark, sf_dir)


def _zip_turns(spark, sf_dir):
    s = conversation_stream(spark, sf_dir)
    u = s.filter(F.col(ELEMENT) == "user").select(SUBJECT, SEQ, F.col(VALUE).alias("user_text"))
    a = s.filter(F.col(ELEMENT) == "assistant").select(SUBJECT, SEQ, F.col(VALUE).alias("assistant_text"))
    return positional_zip([u, a], [SEQ, SEQ])


@query("jn3_fill_from_first", """
WITH u AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, text
           FROM conversations WHERE role = 'user'),
     a AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, text
           FROM conversations WHERE role = 'assistant'),
     z AS (SELECT coalesce(u.conv_id, a.conv_id) AS subject_id, coalesce(u.rn, a.rn) AS rn,
                  u.text AS user_text, a.text AS assistant_text
           FROM u FULL OUTER JOIN a ON u.conv_id = a.conv_id AND u.rn = a.rn)
SELECT subject_id, rn, user_text,
       coalesce(assistant_text, first_value(assistant_text) OVER (
         PARTITION BY subject_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
         AS assistant_text
FROM z
""")
def q_jn3(spark, sf_dir):
    """JN-3: after the zip, NULL assistant cells take the first row's value."""
    z = _zip_turns(spark, sf_dir)
    return fill_from_first(z, ["assistant_text"], order="rn")


# ---------------------------------------------------------------- B2 events

_TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)


@query("lk6_first_value_per_event_type", "SELECT user_id AS subject_id, " + ", ".join(
    f"arg_min(value, ts) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY user_id")
def q_lk6(spark, sf_dir):
    """LK-6: first value of each element kind (header-by-name) per subject."""
    h = header_by_name(event_stream(spark, sf_dir), EVENT_TYPES)
    return h.select(SUBJECT, *[F.col(t).cast("double").alias(t) for t in EVENT_TYPES])


@query("lk7_header_pairs", """
WITH h AS (SELECT user_id, event_type, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn
           FROM events WHERE event_type IN ('signup', 'purchase'))
SELECT user_id AS subject_id, CAST(ceil(rn / 2) AS BIGINT) AS pair,
       CAST(max(CASE WHEN rn % 2 = 1 THEN value END) AS DOUBLE) AS signup,
       CAST(max(CASE WHEN rn % 2 = 0 THEN value END) AS DOUBLE) AS purchase
FROM h GROUP BY 1, 2
""")
def q_lk7(spark, sf_dir):
    """LK-7 pair mode: header rows paired by position (1st with 2nd, ...)."""
    h = header_pairs(event_stream(spark, sf_dir), "signup", "purchase")
    return h.select(SUBJECT, "pair", F.col("signup").cast("double").alias("signup"),
                    F.col("purchase").cast("double").alias("purchase"))


@query("lim1_first_event", """
SELECT user_id AS subject_id, arg_min(event_type, ts) AS first_event, epoch_us(min(ts)) AS first_seq
FROM events GROUP BY user_id
""")
def q_lim1(spark, sf_dir):
    """LIM-1: first match per subject."""
    s = event_stream(spark, sf_dir)
    return s.groupBy(SUBJECT).agg(F.min_by(ELEMENT, SEQ).alias("first_event"), F.min(SEQ).alias("first_seq"))


@query("fil3a_signup_to_purchase", """
WITH b AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS s,
                  min(ts) FILTER (WHERE event_type = 'purchase') AS e
           FROM events GROUP BY user_id)
SELECT user_id AS subject_id, count(*) AS n_rows, round(sum(value), 2) AS sum_value
FROM events JOIN b USING (user_id) WHERE ts >= s AND ts < e GROUP BY user_id
""")
def q_fil3a(spark, sf_dir):
    """FIL-3a: half-open slice [first signup, first purchase)."""
    s = event_stream(spark, sf_dir)
    sl = marker_slice(s, F.col(ELEMENT) == "signup", F.col(ELEMENT) == "purchase")
    return sl.groupBy(SUBJECT).agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.round(F.sum(F.col(VALUE).cast("double")), 2).alias("sum_value"))


@query("fil3b_inclusive_slice", """
WITH b AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'purchase') AS s,
                  min(ts) FILTER (WHERE event_type = 'signup') AS e
           FROM events GROUP BY user_id)
SELECT user_id AS subject_id, count(*) AS n_rows, round(sum(value), 2) AS sum_value
FROM events JOIN b USING (user_id)
WHERE ts >= least(s, e) AND ts <= greatest(s, e) GROUP BY user_id
""")
def q_fil3b(spark, sf_dir):
    """FIL-3b: inclusive slice between the first purchase and the first signup,
    whichever comes first."""
    s = event_stream(spark, sf_dir)
    sl = marker_slice_inclusive(s, F.col(ELEMENT) == "purchase", F.col(ELEMENT) == "signup")
    return sl.groupBy(SUBJECT).agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.round(F.sum(F.col(VALUE).cast("double")), 2).alias("sum_value"))


@query("lk4_next_purchase_after_view", """
SELECT user_id AS subject_id, epoch_us(ts) AS seq, np AS next_purchase_value FROM (
  SELECT *, first_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np
  FROM events) WHERE event_type = 'view'
""")
def q_lk4_rows(spark, sf_dir):
    """LK-4 per row: value of the first purchase anywhere after each view."""
    s = ordered_scan(event_stream(spark, sf_dir), Scan(next_match={
        "np": (F.col(ELEMENT) == "purchase", F.col(VALUE))}))
    return s.filter(F.col(ELEMENT) == "view").select(
        SUBJECT, SEQ, F.col("np").cast("double").alias("next_purchase_value"))


@query("lk4_label_answers", """
WITH n AS (
  SELECT user_id, ts, event_type,
         first_value(CASE WHEN event_type = 'purchase' THEN CAST(value AS VARCHAR) END IGNORE NULLS)
           OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS np
  FROM events)
SELECT user_id AS subject_id,
       coalesce(arg_max_null(np, ts) FILTER (WHERE event_type = 'view'), '') AS view,
       coalesce(arg_max_null(np, ts) FILTER (WHERE event_type = 'click'), '') AS click
FROM n WHERE event_type IN ('view', 'click') GROUP BY user_id
""")
def q_lk4_labels(spark, sf_dir):
    """LK-4 by label: for each label the answer after its LAST occurrence
    (a repeated label overwrites), '' when none follows."""
    return next_answer_after_labels(event_stream(spark, sf_dir), ["view", "click"],
                                    label_element=None, answer_element="purchase")


@query("grp3_click_then_purchase", """
SELECT user_id AS subject_id, string_agg(nv, ', ' ORDER BY ts) AS click_purchases FROM (
  SELECT user_id, ts, event_type, lead(event_type) OVER w AS ne, lead(CAST(value AS VARCHAR)) OVER w AS nv
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
WHERE event_type = 'click' AND ne = 'purchase' GROUP BY user_id
""")
def q_grp3(spark, sf_dir):
    """GRP-3: values of the rows that directly follow a marker row, joined
    in document order."""
    return section_values(event_stream(spark, sf_dir), F.col(ELEMENT) == "click",
                          "click_purchases", question="purchase")


# ------------------------------------------------- B2 as interview (LK-3, EX-6)


@query("lk3_event_type_metrics", f"""
WITH f AS (SELECT user_id, event_type, arg_min(CAST(value AS VARCHAR), ts) AS value,
                  arg_min(json_extract_string(props, '$.k'), ts) AS k
           FROM events GROUP BY 1, 2),
     u AS (SELECT DISTINCT user_id FROM events),
     t AS (SELECT unnest([{_TYPES}]) AS Variable)
SELECT u.user_id AS subject_id, t.Variable, f.value, f.k
FROM u CROSS JOIN t LEFT JOIN f ON f.user_id = u.user_id AND f.event_type = t.Variable
""")
def q_lk3(spark, sf_dir):
    """LK-3: every <type>_<metric> variable looked up at once, long by type;
    every subject gets one row per type."""
    return sku_metric_lookup(event_interview_stream(spark, sf_dir), EVENT_TYPES, EVENT_METRICS)


@query("ex6_metric_name_split", """
SELECT event_type AS sku, m AS metric, count(*) AS questions
FROM events, (VALUES ('value'), ('k')) t(m) GROUP BY ALL
""")
def q_ex6(spark, sf_dir):
    """EX-6: '<sku>_<metric>' split on the longest known metric suffix."""
    s = event_interview_stream(spark, sf_dir).filter(F.col(ELEMENT) == QUESTION)
    sku, metric = split_metric_name(F.col(VALUE), EVENT_METRICS)
    return s.groupBy(sku.alias("sku"), metric.alias("metric")).agg(F.count(F.lit(1)).alias("questions"))


@query("lk1_loose_order_has_lines", """
SELECT o_orderkey AS subject_id, count(l_orderkey) > 0 AS has_lines
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey
""")
def q_lk1_b3(spark, sf_dir):
    """LK-1 over the interview stream of every order (loose lookup of the
    first line's quantity): the answer exists iff the order has lines."""
    s = lineitem_stream(spark, sf_dir)
    header = header_by_name(order_header_stream(spark, sf_dir), ["SubjectNum"])
    lk = lookup(s, ["l_quantity"], mode="loose", strip_prefix=True)
    out = header.join(lk, SUBJECT, "left")
    return out.select(SUBJECT, F.col("l_quantity").isNotNull().alias("has_lines"))
