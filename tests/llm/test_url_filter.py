import re

from pyspark.sql import functions as F

from canvass.llm import url_filter

from .helpers import CLASHES

# names of the given pages that should go; no name of the labelled table is one of them
SPAM = ["casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x"]

# written down before the first training run, but seen while the penalty, the cost and the word pairs were
# chosen, so no clean held-out measure; none of their parts is a word of the labelled table
UNSEEN_BAD = """
casinos777 pokerstar luckyslot megajackpots sportsbets gamblers-den e-pharmacies buyviagra24 painpills pharmacie-discount
pornhost sexcams adults-only escortes nudes malwares trojans-inside hackers-den phish-kit accountverification
securelogin-portal cracked keygens loans4u paydays prizes-today winners giveaways replicas spammers
""".split()
UNSEEN_GOOD = """
northgate riverside kindergarten astronomy beekeeping cathedral volunteers philharmonic lighthouse watercolour
genealogy photography cartography economics philosophy pottery knitting birdwatching veterinary orchestra
marathon newsletter newspapers planetarium botanical geology timetable weatherman neighbourhood allotments
""".split()


def brute(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]
    fits = [(len(r), r, v) for r, v in url_filter.RULES
            for d, _, p in [r.partition("/")] if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def verdicts(spark, names):
    urls = [f"https://{n}.{'com net org info'.split()[i % 4]}/{'' if i % 2 else 'en/%d.html' % i}" for i, n in enumerate(names)]
    rows = url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=[]).collect()
    return [r.verdict for r in sorted(rows, key=lambda r: r.page_id)]


def test_given_names(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = url_filter.judge_urls(pages, rules=[]).collect()
    spam = [r.verdict for r in got if any(s in r.host for s in SPAM)]
    clean = [r.verdict for r in got if not any(s in r.host for s in SPAM)]
    table = {r.url.split("/")[2] for r in url_filter.labelled_urls(spark).collect()}
    assert not [t for t in table for s in SPAM if s in t.split(".")]
    assert spam and spam.count("block") >= 0.9 * len(spam) and clean.count("allow") >= 0.99 * len(clean)


def test_unseen_parts(spark):
    parts = {p for n in url_filter.BLOCKED + url_filter.ALLOWED for p in (n, *n.split("-"))}
    assert not {p for n in UNSEEN_BAD + UNSEEN_GOOD for p in n.split("-")} & parts
    got = verdicts(spark, UNSEEN_BAD + UNSEEN_GOOD)
    bad, good = got[:len(UNSEEN_BAD)], got[len(UNSEEN_BAD):]
    assert bad.count("block") >= 0.8 * len(bad) and good.count("allow") >= 0.8 * len(good)


def test_parts_and_rules(spark):
    urls = [None, "", "abc", "http://EXAMPLE.com", "http://example.com/en/", "http://a.WWW.example.com/en/x?y#z", "x://y://z/a",
            "http://h?q=1/2", "http://" + "a" * 5000 + ".net/fr/\nx", "http://\U0001F600é.net/es/", "com://com/", "://net/es/",
            "http://notnet/es/", "http://x.example.com/en", "http://com#/", "http://x.net/es/" + "é" * 50_000, "com", "http://net/es/", "http://net/es/"]
    urls += [r.url for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for c in [*CLASHES, "score", "verdict", "path"]:
        df = df.withColumn(c, F.lit("clash"))
    got = sorted(url_filter.judge_urls(df).collect())
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score > 0 else "allow"))
    assert url_filter.judge_urls(df.where("false")).count() == 0


def test_no_python_on_the_way(spark):
    plan = url_filter.judge_urls(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_nothing_to_learn_from(spark):
    labels = spark.createDataFrame([(None, 1), ("http://a.example/", None)], "url string, label int")
    pages = spark.createDataFrame([(1, "http://casino.example/")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(pages, labels=labels).collect()] == ["allow"]
