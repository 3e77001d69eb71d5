"""EX-1 as a factorised product (AGG-3, AGG-5) against the product itself."""

import random

from pyspark.sql import functions as F

from canvass.operators.factorised import product_rows, product_value_counts
from canvass.operators.reshape import explode_columns

DDL = "subject_id long, a string, b string, c string, d string"


def both(df, cols, sep):
    product = explode_columns(df, cols, sep)
    want = {}
    for c in cols:
        for r in product.where(F.col(c).isNotNull()).groupBy(c).agg(F.count_distinct("subject_id"), F.count("*")).collect():
            want[c, r[0]] = (r[1], r[2])
    got = {(r.variable, r.value): (r.respondents, r.rows) for r in product_value_counts(df, "subject_id", cols, sep).collect()}
    assert got == want
    assert product_rows(df, cols, sep).first()[0] == product.count()
    return got


def test_equals_the_product(spark):
    rng = random.Random(2)
    cells = [None, "", " ", "x", "x, y", "x,x", " y ,, z", ",", "é,x"]
    rows = [(rng.randrange(6), *(rng.choice(cells) for _ in range(4))) for _ in range(60)]
    df = spark.createDataFrame(rows, DDL).repartition(3)
    assert both(df, ["a", "b", "c"], ",")
    both(df, ["d"], ",")
    both(df.where("false"), ["a", "b"], ",")
    both(spark.createDataFrame([(1, None, None, "p;q", None), (None, "p;p", "q", None, "kept")], DDL), ["a", "b", "c"], ";")


def test_products_past_any_table_are_counted(spark):
    """12 columns of 30 options: 30^12 rows for an interview; no plan node makes them."""
    cols = [f"c{i}" for i in range(12)]
    cell = ",".join(str(i) for i in range(30))
    df = spark.createDataFrame([(1, *[cell] * 12)], "subject_id long, " + ", ".join(f"{c} string" for c in cols))
    got = product_value_counts(df, "subject_id", cols)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode(") == 1 and plan.count("Generate inline(") == 1
    assert got.count() == 360 and {r.rows for r in got.collect()} == {30 ** 11}
