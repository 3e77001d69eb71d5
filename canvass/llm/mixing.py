"""Mixing sources to target weights by systematic sampling.

Only DataFrame expressions. Within a source every document expects target /
source size copies; expected copies are prefix-summed in a fixed order, one random
offset is added for each source, and a document is emitted once for every integer
that its own interval crosses. The order goes by size to five binary digits, so
that each stretch of the sum holds documents of about one size and a source's
taken words stay close to its target.

The prefix sum has two levels: blocks (source, size to five digits, a digit of a
digest) are summed on their own, and a block's start is the sum of the blocks
before it. No task gets a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

# The weights of the sources in code point order, repeating
WEIGHTS = [5, 2, 1]
CAP = 3                   # times a source's own size
UNIT = 30                 # expected copies are counted in 2^-30ths: integer sums, equal in any grouping
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes(source, source_size)`` -> with ``target``. All targets add up to all
    sizes and follow the weights, but none is above ``cap`` times its source: with
    the sources in order of cap * size / weight, those before the first that its
    share of the rest does not fill are at their cap, and one level per unit of
    weight holds for the others (the outcome of resharing the excess until none is
    above). The level computed at each place rises up to that source and falls after
    it, so the largest is the one. This table has a row for each source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).cast("long")
    w = sizes.withColumn("weight", weight).withColumn("full", F.col("source_size") * cap)
    # full_a / weight_a < full_b / weight_b decided on doubles; ties fill at the same level
    before = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0))) \
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    w = w.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return w.select("source", "source_size", F.least(F.col("full").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def mix_sources(docs: DataFrame, weights: list[int] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source, ...)``: doc_id, size,
    source_size, target, taken (words), and source, copies.

    Null text: size 0. Null source: a source of its own, last in order. A source
    without words has target 0. Repeated rows and ids are documents of their own.
    Reruns agree: order and offset come from digests of doc_id and source. Other
    columns are ignored. No rows: empty."""
    unit = 1 << UNIT
    size = n_words("text")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = shared_table(docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"),
                                     digest.alias("digest")))
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    sized = sized.withColumn("s", key).withColumn("class", F.length(F.bin("size"))) \
        .withColumn("part", F.concat(F.substring(F.bin("size"), 1, 5), F.substring("digest", 1, 1)))
    shares = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    expected = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * unit)).otherwise(0).cast("long")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "s")), 1, 7), 16, 10).cast("long") * 4
    shares = shares.withColumn("s", key).withColumn("expected", expected).withColumn("offset", offset).drop("source")
    blocks = sized.groupBy("s", "class", "part").agg(F.count("*").alias("n")).join(shares, "s")
    before = Window.partitionBy("s").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("start", F.col("offset") + F.coalesce(
        F.sum(F.col("n") * F.col("expected")).over(before), F.lit(0))).drop("n", "offset")
    inside = Window.partitionBy("s", "class", "part").orderBy("size", "digest", "doc_id") \
        .rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("start") + F.sum("expected").over(inside)
    out = sized.join(blocks, ["s", "class", "part"]).withColumn("end", end)
    copies = F.shiftright("end", UNIT) - F.shiftright(F.col("end") - F.col("expected"), UNIT)
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"),
                      "source", copies.alias("copies"))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         source_size * 3 AS full_size FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(full_size) OVER b, 0))::DOUBLE
          / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
  FROM weighted
  WINDOW b AS (ORDER BY full_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT source, source_size, least(full_size::DOUBLE, weight * (SELECT max(level) FROM levels)) AS target FROM levels),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 1073741824)::BIGINT ELSE 0 END AS expected,
         ('0x' || substr(md5('mix-1' || coalesce('=' || source, '-')), 1, 7))::BIGINT * 4 AS shift FROM shares),
summed AS (
  SELECT d.*, r.source_size, r.target, r.expected,
         r.shift + sum(r.expected) OVER (PARTITION BY d.source ORDER BY length(bin(d.size)),
           substr(bin(d.size), 1, 5), substr(digest, 1, 1), d.size,
           digest, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized d JOIN rated r ON d.source IS NOT DISTINCT FROM r.source),
counted AS (
  SELECT *, (upto // 1073741824 - (upto - expected) // 1073741824)::BIGINT AS copies FROM summed)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, source, copies FROM counted
"""
