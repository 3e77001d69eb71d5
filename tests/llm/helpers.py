"""Small inputs that every operator must stand: nulls, empty and long texts, ties, repeated
rows, and extra columns whose names the operators use themselves."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["key", "row", "t", "h", "fp", "root", "s", "gone", "removed", "_key", "_row", "_gone", "_removed", "size",
           "host", "rule", "id", "u", "v", "place", "number", "seed", "part", "digest", "tag", "at", "url_", "word"]

EDGE = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n\t\n ", None, None, 7), (None, "null id text here", "en", "a", 17),
    (4, "one", "en", None, 3), (5, "same row twice " * 30, "en", "a", 450), (5, "same row twice " * 30, "en", "a", 450),
    (6, "tie on the id", "en", "b", 13), (6, "tie on the id, other text", "en", "b", 25),
    (7, "x" * 40_000, "en", "b", 40_000), (8, "word " * 9_000 + "\n" + "line\n" * 500, "de", "c", None),
    (9, "é€😀 <p>&amp;</p> \\| <|im_end|>", "fr", "\U0001F600", 30), (10, "a\n" * 3000, "en", "", 6000),
    (None, None, None, None, None),
]


def edge_docs(spark, rows=EDGE):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


def no_docs(spark):
    return edge_docs(spark, EDGE[:1]).where("false")


def components_of(nodes, linked):
    """node -> smallest node reachable; linked(a, b) for any pair."""
    nodes = sorted(nodes)
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if find(a) != find(b) and linked(a, b):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {n: find(n) for n in nodes}
