import random
import xml.etree.ElementTree as ET

from canvass.sources.documents import NOT_XML, documents_to_stream

from walker import flatten_document

GOOD = [
    "<a>ok</a>", "<a/>", "<a x='1'/>", "<?xml version='1.0'?>\n<a><b>1</b>tail<b x='1' y=\"2\">2</b></a>\n",
    "<a> \n <b> </b><c>　x</c></a>", "<a>&lt;&amp;&gt;&quot;&apos;&#65;&#x1F600;&#0066;</a>", "<a>&amp;#65;&#38;lt;&#38;amp;</a>",
    "<a x='&lt;&#10;\n\t>'>t</a>", "<a><![CDATA[<b>x</b> &amp; ]]]]></a>", "<a>1<![CDATA[2]]>3<![CDATA[4]]><b/>5</a>",
    "<a>x<!-- <b>no</b> --><?pi <c/>?>y<b>z</b></a><!-- end --><?p?>", "<a><b/><![CDATA[<c>in the tail</c>]]></a>", "<!DOCTYPE a><a>1</a>",
    "<a>l1\r\nl2\rl3&#13;</a>", "<a\n x = '1'\n>t</a >", "<a><a></a></a>", "<a><a>1</a><b/></a>", "<a x='a>b' y='c=\"d\" e'>t</a>",
    "<a x='/'/>", "<été ü='\U0001F600'>é</été>", "<a>" + "<b k='v'>t</b>" * 3000 + "</a>", "<a>" + "long " * 60_000 + "</a>",
    "<a>" + "<![CDATA[x]]>y" * 300 + "</a>", "<a><![CDATA[</a>]]></a>", "<a>$1 \\1 $</a>", "<a>" * 200 + "x" + "</a>" * 200,
]
BAD = [
    "", "  ", "junk", "<a><b></a></b>", "<a>", "<a/>junk", "<a/><b/>", "<a></a><a></a>", "<a></a>junk</a>", "<a x=1/>", "<a x='1' x='2'/>",
    "<a>&nbsp;</a>", "<a>& b</a>", "<a x='<'/>", "<a>\x01</a>", "<a><!-- -- --></a>", "<a></a ><!-- x", "<a><![CDATA[x</a>", "<a>]]></a>",
    "< a/>", "<a b></a>", "<1a/>", "<a>&#0;</a>", "<a></b>", "<a/> x", " <?xml version='1.0'?><a/>", "<a/></a>", "<a><a/></a></a>",
]


def streamed(spark, docs):
    rows = documents_to_stream(spark.createDataFrame(list(enumerate(docs)), "subject_id long, xml string"), keep_errors=True).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.subject_id, r.seq)):
        out.setdefault(r.subject_id, []).append(r)
    return out


def held_against_the_walker(spark, docs):
    got, good = streamed(spark, docs), 0
    for i, doc in enumerate(docs):
        rows = got.get(i, [])
        try:
            want = flatten_document(doc)
        except ET.ParseError:
            assert [(r.seq, r.block, r.element, r.parse_error) for r in rows] == [(-1, -1, None, NOT_XML)], doc[:80]
            continue
        good += 1
        assert [(r.element, r.attribute, r.value) for r in rows] == want, doc[:80]
        assert [r.seq for r in rows] == list(range(len(want))) and all(r.parse_error is None for r in rows)
    return good


def test_equals_the_walker(spark):
    assert held_against_the_walker(spark, GOOD + BAD) == len(GOOD)
    assert streamed(spark, [None]) == {}


def test_random_documents(spark):
    rng = random.Random(5)
    bits = ["<a>", "</a>", "<b x='1'>", "</b>", "<c/>", "text", " ", "&amp;", "<![CDATA[<a>]]>", "<!--<b>-->", "'", '"', ">", "\n"]

    def tree(depth):
        tag, inner = rng.choice("abc"), ""
        for _ in range(rng.randrange(4) if depth else 0):
            inner += rng.choice(["", " ", "t>", "&lt;", "<!-- c -->", "<![CDATA[&]]>"]) + tree(depth - 1)
        at = rng.choice(["", " k='v'", ' k="a > b" l=\'&quot;\'', " "])
        return f"<{tag}{at}>{rng.choice(['', 'x', ' y ', '&#233;'])}{inner}</{tag}>" if rng.random() < 0.9 else f"<{tag}{at}/>"

    docs = [tree(3) for _ in range(150)] + ["".join(rng.choices(bits, k=rng.randrange(1, 9))) for _ in range(250)]
    docs += [d[:i] + rng.choice(bits) + d[i:] for d in docs[:150] for i in [rng.randrange(len(d) + 1)]]
    assert 150 <= held_against_the_walker(spark, docs) < len(docs)


def test_names_keep_their_prefix(spark):
    got = streamed(spark, ["<p:a xmlns:p='u' xmlns='v' p:k='1' xmlnsx='2'>t</p:a>"])
    assert [(r.element, r.attribute, r.value) for r in got[0]] == [("p:a", "text", "t"), ("p:a", "p:k", "1"), ("p:a", "xmlnsx", "2")]


def test_block_and_text_ids_and_no_python(spark):
    docs = spark.createDataFrame([("x", "<a><b>1</b><b>2</b><b>3</b></a>")], "subject_id string, xml string")
    spark.conf.set("canvass.stream.blockSpan", "2")
    try:
        stream = documents_to_stream(docs)
        assert [(r.subject_id, r.seq, r.block) for r in stream.collect()] == [("x", 0, 0), ("x", 1, 0), ("x", 2, 1)]
    finally:
        spark.conf.unset("canvass.stream.blockSpan")
    for word in ("Python", "Pandas", "Arrow"):
        assert word not in documents_to_stream(docs.select("subject_id", "xml"))._jdf.queryExecution().toString()
