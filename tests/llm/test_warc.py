import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from canvass.llm import warc

from .helpers import CLASHES

DDL = "page_id long, url string, payload string"
ROWS = [
    (1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://a/\r\nX: y", ""), (5, "u", None),
    (6, "http://é/", "é€😀\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (7, "u", "x" * 3_000_000), (8, "u", "\r\n\r\n\r\n"),
    (9, "u", "tie"), (9, "u", "tie"), (None, "u", "tie"), (None, "u", "null id"), (-1, "u", "neg"), (10, "u", "HTTP/1.1 200 OK"),
]


def expected(rows):
    keeper = {}
    for i, _, p in rows:
        p = (p or "").encode()
        keeper[p] = max(keeper.get(p, -10 ** 18), -10 ** 17 if i is None else i)
    out = []
    for i, _, p in rows:
        p = (p or "").encode()
        again = (-10 ** 17 if i is None else i) != keeper[p]
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response",
                    keeper[p] if again else None))
    return sorted(out, key=repr)


def pages(spark, rows=ROWS):
    df = spark.createDataFrame(rows, DDL)
    for c in CLASHES + ["digest", "n", "keeper", "body", "repeated", "value"]:
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_round_trip_equals_brute_force(spark):
    got = warc.page_records(spark, warc.write_archives(pages(spark).repartition(3)))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ROWS)


def test_small_payloads_are_not_revisited(spark):
    got = warc.page_records(spark, warc.write_archives(pages(spark), min_bytes=4))
    kinds = {(r.page_id, r.payload_bytes): r.record_type for r in got.collect()}
    assert kinds[(1, 4)] == "revisit" and kinds[(3, 4)] == "response"
    assert kinds[(4, 0)] == kinds[(5, 0)] == kinds[(None, 3)] == "response"


def test_no_rows_and_binary_payloads(spark):
    none = warc.write_archives(pages(spark).where("false"))
    assert warc.page_records(spark, none).collect() == []
    raw = bytes(range(256)) * 3
    df = spark.createDataFrame([(1, "u", bytearray(raw))], "page_id long, url string, payload binary")
    back = warc.read_archives(spark, warc.write_archives(df)).collect()
    assert [bytes(r.payload) for r in back] == [raw]
    assert back[0].headers["warc-type"] == "response" and back[0].target_uri == "u"


def test_hot_payload(spark):
    """A third of all rows with one payload: one response, the others revisit it."""
    df = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                  F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("payload"))
    got = warc.page_records(spark, warc.write_archives(df))
    hot = got.where("refers_to is not null")
    assert hot.count() == 999 and {r.refers_to for r in hot.select("refers_to").distinct().collect()} == {2997}
    assert got.count() == 3000


FOREIGN = (
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Type: application/warc-fields\r\n"
    b"Content-Length: 9\r\n\r\nsoftware:\r\n\r\n"
    b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:uuid:2>\r\nWARC-Target-URI: http://x/\r\n  long\r\n"
    b"Content-Type: text/plain\r\nContent-Length: 5\r\n\r\n\r\n\r\nx\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:3>\r\nContent-Type: application/http; msgtype=response\r\n"
    b"Content-Length: 42\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc\x00\r\n\r\n")


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz"])
def test_archives_of_others(spark, tmp_path, name):
    if name.endswith("gz"):                            # a member for each record, as usual
        cut = [i for i in range(len(FOREIGN)) if FOREIGN.startswith(b"WARC/1.0", i)] + [len(FOREIGN)]
        data = b"".join(gzip.compress(FOREIGN[a:b]) for a, b in zip(cut, cut[1:]))
    else:
        data = FOREIGN
    (tmp_path / name).write_bytes(data)
    rows = {r.record_id: r for r in warc.read_archives(spark, f"file://{tmp_path}").collect()}
    assert bytes(rows["urn:uuid:1"].payload) == b"software:"
    assert bytes(rows["urn:uuid:2"].payload) == b"\r\n\r\nx" and rows["urn:uuid:2"].target_uri == "http://x/ long"
    assert bytes(rows["urn:uuid:3"].payload) == b"abc\x00" and rows["urn:uuid:3"].payload_bytes == 4


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        self.read_bytes += len(out)
        return out


def test_unwanted_payloads_are_not_read():
    body = b"y" * 100_000
    one = (b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Type: text/html\r\n"
           b"Content-Length: 100000\r\n\r\n" + body + b"\r\n\r\n")
    data = one % b"response" + one % b"resource"
    f = Counting(data)
    got = list(warc.read_records(f, ["record_id", "payload"], [ds.EqualTo(("record_type",), "resource")]))
    assert len(got) == 1 and f.read_bytes == 100_000
    f = Counting(data)
    assert len(list(warc.read_records(f, ["record_id", "content_length"], []))) == 2 and f.read_bytes == 0


def test_predicates_are_pushed_and_mean_what_spark_means(spark):
    path = warc.write_archives(pages(spark))
    df = warc.read_archives(spark, path, ["record_type", "record_id", "target_uri", "content_length"])
    all_rows = df.collect()
    for where in ["record_type = 'revisit'", "record_type in ('response', 'none')", "target_uri is null",
                  "content_length > 100 and target_uri like 'http:%'", "not (target_uri = 'u')", "target_uri <=> null",
                  "record_type <> 'revisit' and content_length <= 80", "target_uri >= 'http://b/' "]:
        got = df.where(where)
        assert " Filter " not in got._jdf.queryExecution().executedPlan().toString(), where
        want = spark.createDataFrame(all_rows, df.schema).where(where)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr), where


def test_partitions_hold_whole_files():
    assert warc.pack([("a", 5), ("b", 100), ("c", 5)], 10) == [["b"], ["a", "c"]]
    assert warc.pack([], 10) == []
