"""Answer streams derived from the driver tables (bindings B1-B4).

Each binding returns the stream schema of ``canvass.schema``:
``subject_id LONG, seq LONG, block LONG, element STRING, attribute STRING, value STRING``.
All of them are narrow per-row projections of one scan (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import ANSWER, QUESTION
from ..operators.ordered import block_span, whole_block
from ..session import cut_lineage
from .tables import read_table, task_count

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MICROS_PER_DAY = 86_400_000_000


EVENT_BLOCK_CONF = "canvass.events.blockMicros"


def event_block_micros(spark: SparkSession) -> int:
    return int(spark.conf.get(EVENT_BLOCK_CONF, str(MICROS_PER_DAY)))


def _micros(c: str):
    """Microseconds since epoch of a (possibly zone-less) timestamp, read as UTC
    (the engine's session time zone)."""
    return F.unix_micros(F.col(c).cast("timestamp"))


def _stream(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("subject_id").cast("long"), F.col("seq").cast("long"),
        F.col("block").cast("long"), F.col("element").cast("string"),
        F.col("attribute").cast("string"), F.col("value").cast("string"))


def conversation_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one subject per conversation, one row per turn (element = role)."""
    span = block_span(spark)
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return _stream(c.select(
        F.col("conv_id").alias("subject_id"), F.col("turn").alias("seq"),
        F.floor(F.col("turn") / span).alias("block"), F.col("role").alias("element"),
        F.lit("text").alias("attribute"), F.col("text").alias("value")))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: one subject per user, rows in time order (``(user_id, ts)`` is unique).

    seq = microseconds since epoch; block = a fixed time slice (default one
    day, ``canvass.events.blockMicros``), so one user's slice is the largest
    unit a window task handles. Narrower slices bound a hot user tighter;
    wider ones keep the block summary small for ordinary users (at most one
    summary row per user and slice).
    """
    e = read_table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value")
    seq = _micros("ts")
    return _stream(e.select(
        F.col("user_id").alias("subject_id"), seq.alias("seq"),
        F.floor(seq / F.lit(event_block_micros(spark))).alias("block"),
        F.col("event_type").alias("element"), F.lit("text").alias("attribute"),
        F.col("value").cast("string").alias("value")))


# B3 binding: fixed variable order of one line item; the first is the sentinel.
LINE_VARIABLES = ["l_returnflag", "l_linestatus", "l_partkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_shipdate"]
LINE_SENTINEL = LINE_VARIABLES[0]
ORDER_HEADER = ["SubjectNum", "Upload", "Date"]
HEADER_ROWS = 16  # seq 0..15 reserved for header rows


def _line_value(c: str):
    if c == "l_shipdate":
        return F.date_format(F.col(c), "yyyy-MM-dd")
    return F.col(c).cast("string")


def order_header_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    ts = F.date_format("o_orderdate", TS_TEXT)
    rows = F.array(
        F.struct(F.lit(0).cast("long").alias("seq"), F.lit("SubjectNum").alias("element"),
                 F.col("o_orderkey").cast("string").alias("value")),
        F.struct(F.lit(1).cast("long").alias("seq"), F.lit("Upload").alias("element"),
                 ts.alias("value")),
        F.struct(F.lit(2).cast("long").alias("seq"), F.lit("Date").alias("element"),
                 ts.alias("value")))
    return _stream(o.select(F.col("o_orderkey").alias("subject_id"), F.inline(rows))
                   .select("subject_id", "seq", F.lit(0).alias("block"), "element",
                           F.lit("text").alias("attribute"), "value"))


LINES_PER_TASK = 100_000
PLACE_BITS = 40   # a line's block in its order goes by a hash of the row, in this many bits
RANK_BITS = 31    # a line's place in its block


COPY, COPY_STEP = "__copy", 1 << 16


def numbered_rows(df: DataFrame) -> DataFrame:
    """``df`` with ``__copy``: equal rows count 0, 1, 2, ... They are counted, not
    ranked, so many equal rows never meet in one window, and are dealt out again in steps."""
    times, high = F.col("__times"), F.col("__high")
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__times"))
    steps = counted.select("*", F.explode(F.expr(f"sequence(0L, (__times - 1) div {COPY_STEP})")).alias("__high"))
    last = F.least(times - high * COPY_STEP, F.lit(COPY_STEP)) - 1
    low = steps.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("__low"))
    return low.select(*df.columns, (high * COPY_STEP + F.col("__low")).alias(COPY))


def lineitem_stream(spark: SparkSession, sf_dir: str, with_header: bool = False) -> DataFrame:
    """Each order is an interview; each line item a repeated record.

    Line rows: ``FullVariable = I_<linenumber>_<var>`` followed by its
    ``QuestionAnswer`` (omitted when the cell is null = unanswered). Lines of an
    order go by a hash of the row and of its number among equal rows, which needs no
    file listing and holds for any file layout; lines whose hashes are equal still have
    places of their own.

    If every order fills one block (a count per order tells), the narrow line rows are
    hash-partitioned on ``subject_id`` and nothing else moves, here or in the scans.
    Otherwise an order is cut into as many blocks as its lines fill, so a block holds
    about ``span`` rows, and the rows are hash-partitioned on ``(subject_id, block)``.
    Both happen BEFORE the 14-way explode, with a bounded number of lines a task: the
    stream already has the distribution every ordered scan needs, and its sorts fit in memory.
    The order header rows are a separate stream (``order_header_stream``);
    ``with_header=True`` unions them in for operators that need both.
    """
    span = block_span(spark)
    n = 2 * len(LINE_VARIABLES)
    cells = ["l_linenumber", *LINE_VARIABLES]
    table = read_table(spark, sf_dir, "lineitem", "l_orderkey", *cells)
    tasks = task_count(table, LINES_PER_TASK)
    li = table.select(F.col("l_orderkey").alias("subject_id"), *cells)
    blocks = F.ceil(F.count(F.lit(1)) * F.lit(n) / F.lit(span)).alias("__blocks")
    # at most n * lines / span orders, most often none
    large = cut_lineage(li.groupBy("subject_id").agg(blocks).where("__blocks > 1"))
    hashed = lambda d: F.shiftrightunsigned(F.xxhash64(*sorted(d.columns)), 64 - PLACE_BITS)
    if large.isEmpty():
        # every order fills one block, and equal rows change places unseen
        li = li.withColumn("__place", hashed(li)).repartition(tasks, "subject_id").withColumn("block", F.lit(0).cast("long"))
        order = ["__place", *cells]
        block = whole_block(F.col("block"))
    else:
        li = numbered_rows(li)
        li = li.withColumn("__place", hashed(li)).join(F.broadcast(large), "subject_id", "left")
        li = li.withColumn("block", F.shiftright(F.col("__place") * F.coalesce("__blocks", F.lit(1)), PLACE_BITS))
        li = li.drop("__blocks").repartition(tasks, "subject_id", "block")
        order = ["__place", *cells, COPY]
        block = F.col("block")
    rank = F.row_number().over(Window.partitionBy("subject_id", "block").orderBy(*order)) - 1
    li = li.withColumn("__base", F.lit(HEADER_ROWS) + (F.shiftleft(F.col("block"), RANK_BITS) + rank) * F.lit(n)) \
        .drop("__place", COPY)
    base = F.col("__base")
    rows = []
    for j, v in enumerate(LINE_VARIABLES):
        name = F.concat(F.lit("I_"), F.col("l_linenumber").cast("string"), F.lit("_" + v))
        rows.append(F.struct((base + 2 * j).alias("seq"), F.lit(QUESTION).alias("element"),
                             name.alias("value")))
        # an unanswered (NULL) cell gets a NULL seq and is dropped after the
        # explode: a plain filter stays in codegen, a lambda over the array would not
        rows.append(F.struct(F.when(F.col(v).isNotNull(), base + 2 * j + 1).alias("seq"),
                             F.lit(ANSWER).alias("element"), _line_value(v).alias("value")))
    items = (li.select("subject_id", "block", F.inline(F.array(*rows)))
             .filter(F.col("seq").isNotNull())
             .select("subject_id", "seq", "block", "element", F.lit("text").alias("attribute"), "value"))
    items = _stream(items).withColumn("block", block)
    if not with_header:
        return items
    return order_header_stream(spark, sf_dir).unionByName(items.withColumn("block", F.col("block").alias("block", metadata={})))


# Tags of raw web pages (HTML is not well-formed XML, so a regex tokeniser).
TAG_PATTERN = r"<([a-zA-Z][a-zA-Z0-9]*)[^>]*>([^<]*)"


def page_tag_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = block_span(spark)
    p = read_table(spark, sf_dir, "pages", "page_id", "html")
    tags = F.regexp_extract_all("html", F.lit(TAG_PATTERN), 1)
    texts = F.regexp_extract_all("html", F.lit(TAG_PATTERN), 2)
    z = p.select("page_id", F.posexplode(F.arrays_zip(tags.alias("t"), texts.alias("x"))))
    return _stream(z.select(
        F.col("page_id").alias("subject_id"), F.col("pos").alias("seq"),
        F.floor(F.col("pos") / span).alias("block"), F.lower(F.col("col.t")).alias("element"),
        F.lit("text").alias("attribute"), F.col("col.x").alias("value")))


# B2 as an interview: every event answers two questions named "<event_type>_<metric>".
EVENT_METRICS = ["value", "k"]
EVENT_TYPES = ["view", "signup", "error", "click", "purchase"]


def event_interview_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event -> (FullVariable <type>_value, QuestionAnswer value,
    FullVariable <type>_k, QuestionAnswer k-from-props); ordered by ts."""
    e = read_table(spark, sf_dir, "events", "user_id", "ts", "event_type", "value", "props")
    base = _micros("ts") * F.lit(4)
    k = F.get_json_object("props", "$.k")
    rows = F.array(
        F.struct(base.alias("seq"), F.lit(QUESTION).alias("element"),
                 F.concat("event_type", F.lit("_value")).alias("value")),
        F.struct((base + 1).alias("seq"), F.lit(ANSWER).alias("element"),
                 F.col("value").cast("string").alias("value")),
        F.struct((base + 2).alias("seq"), F.lit(QUESTION).alias("element"),
                 F.concat("event_type", F.lit("_k")).alias("value")),
        F.struct((base + 3).alias("seq"), F.lit(ANSWER).alias("element"), k.alias("value")))
    out = e.select(F.col("user_id").alias("subject_id"), F.inline(rows))
    return _stream(out.select(
        "subject_id", "seq", F.floor(F.col("seq") / F.lit(4 * event_block_micros(spark))).alias("block"),
        "element", F.lit("text").alias("attribute"), "value"))
