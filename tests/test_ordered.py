"""Two-level ordered scans must equal a brute-force per-subject walk, whatever
the block span (tiny spans force every subject across many blocks)."""

import random

from pyspark.sql import functions as F

from canvass.operators.ordered import Scan, ordered_scan, with_ordinal


def _data(seed=7, subjects=6, max_rows=40):
    rnd = random.Random(seed)
    rows = []
    for s in range(subjects):
        seq = rnd.randint(0, 5)
        n = rnd.randint(0, max_rows) if s else max_rows * 3  # subject 0 is "hot"
        for _ in range(n):
            seq += rnd.randint(1, 4)  # gaps, as after a filter
            rows.append((s, seq, rnd.choice("ABC"), str(rnd.randint(0, 99))))
    return rows


def _brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for s, rs in by.items():
        rs.sort(key=lambda r: r[1])
        running = 0
        for i, r in enumerate(rs):
            nxt = rs[i + 1][3] if i + 1 < len(rs) else None
            running += 1 if r[2] == "A" else 0
            nm = next((x[3] for x in rs[i + 1:] if x[2] == "B"), None)
            out[(s, r[1])] = (nxt, running, nm, i + 1)
    return out


def _run(spark, rows):
    df = spark.createDataFrame(rows, "subject_id long, seq long, element string, value string")
    res = ordered_scan(df, Scan(lead={"nxt": "value"},
                                running={"run": F.when(F.col("element") == "A", 1).otherwise(0)},
                                next_match={"nm": (F.col("element") == "B", F.col("value"))}))
    res = with_ordinal(res.drop("block"), "rn")
    return {(r.subject_id, r.seq): (r.nxt, r.run, r.nm, r.rn) for r in res.collect()}


def test_scan_matches_brute_force_small_blocks(spark, small_blocks):
    rows = _data()
    assert _run(spark, rows) == _brute(rows)


def test_scan_matches_brute_force_default_blocks(spark):
    rows = _data(seed=11)
    assert _run(spark, rows) == _brute(rows)


def test_scan_one_hot_subject_many_blocks(spark, small_blocks):
    rows = [(1, i * 2, "A" if i % 5 == 0 else "B", str(i)) for i in range(500)]
    got = _run(spark, rows)
    assert got == _brute(rows)
    assert got[(1, 998)] == (None, 100, None, 500)
