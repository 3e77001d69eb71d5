import re

from pyspark.sql import functions as F

from canvass.llm import html_extract as hx

from .helpers import CLASHES


def test_held_out_accuracy():
    field = hx.train(hx.labelled_pages())
    right = total = 0
    for blocks, labels in hx.labelled_pages(150, seed=99):
        got = field.decode(blocks)
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right >= 0.98 * total


BODY = "<p>The river rose for three days and the town moved its market to the hill.</p><p>Nobody was hurt, the mayor said.</p>"
TEXT = "The river rose for three days and the town moved its market to the hill.\nNobody was hurt, the mayor said."
# pages as people write them, each with its main text
PAGES = {
    "one paragraph": ("<body><article><p>Only one paragraph stands here, and it is the article.</p></article></body>",
                      "Only one paragraph stands here, and it is the article."),
    "named div": ('<html><head><title>x</title></head><body><div id="main"><p>Only one paragraph stands here.</p></div></body></html>',
                  "Only one paragraph stands here."),
    "bare paragraphs": (f"<html><body>{BODY}</body></html>", TEXT),
    "no markup": ("plain text only, nothing else.", "plain text only, nothing else."),
    "site header": (f'<html><body><header><h1>My site</h1><p>Tagline here</p></header><nav><a href="/">Home</a> <a href="/b">Blog</a></nav>'
                    f"<article><h1>Flood</h1>{BODY}</article><footer>&copy; 2020 Me</footer></body></html>", "Flood\n" + TEXT),
    "aside inside": (f'<body><article><h1>Flood</h1>{BODY}<aside class="sidebar"><h3>Related</h3><p>Other floods of the year</p></aside>'
                     "<p>The water fell on Friday.</p></article></body>", f"Flood\n{TEXT}\nThe water fell on Friday."),
    "advert inside": (f'<body><article><h1>Flood</h1><p>First.</p><div class="ad">Buy boats now, they are cheap</div>{BODY}</article></body>',
                      "Flood\nFirst.\n" + TEXT),
    "form inside": (f'<body><main><h1>Flood</h1>{BODY}<form action="/s"><label>Email</label><input name=e><button>Subscribe</button></form>'
                    "</main></body>", "Flood\n" + TEXT),
    "odd quote": ('<body><article><p class="a"">One paragraph.</p><p>Two paragraphs.</p><p class="b">Three paragraphs.</p></article></body>',
                  "One paragraph.\nTwo paragraphs.\nThree paragraphs."),
    "bare apostrophe": ("<body><article><p title=it's>One paragraph, it's here.</p><p>Two paragraphs.</p></article></body>",
                        "One paragraph, it's here.\nTwo paragraphs."),
    "'>' in a value": ('<body><article><p title="a > b" lang=en>One paragraph.</p><p data-x = \'>"\'>Two paragraphs.</p></article></body>',
                       "One paragraph.\nTwo paragraphs."),
    "svg in svg": ("<body><article><p>One paragraph.</p><svg><svg><text>no</text></svg><text>no</text></svg><p>Two paragraphs.</p></article></body>",
                   "One paragraph.\nTwo paragraphs."),
    "comments": (f'<body class="nav-open home"><div id="content"><h1>Flood</h1>{BODY}</div><section id="comments"><h3>2 comments</h3>'
                 '<div class="comment"><p>I was there and it was wet.</p></div><div class="comment"><p>Me too.</p></div></section></body>',
                 "Flood\n" + TEXT),
    "article header": ('<body><div class="cookie-banner"><p>We use cookies.</p><button>Accept</button></div><main><article><header><h1>Flood</h1>'
                       f"<p>What the water did to the town</p></header>{BODY}</article></main><aside><ul><li><a href=1>One</a></li></ul></aside></body>",
                       "Flood\nWhat the water did to the town\n" + TEXT),
    "no names": ('<body><div><a href="/">Home</a> | <a href="/a">About us</a> | <a href="/c">Contact</a></div>'
                 f"<div><h1>Flood</h1>{BODY}</div><div>&copy; 2020 The Paper</div></body>", "Flood\n" + TEXT),
}


def test_hand_written_pages(spark):
    df = spark.createDataFrame([(i, k, h) for i, (k, (h, _)) in enumerate(PAGES.items())], "page_id long, url string, html string")
    got = {r.url: r.text for r in hx.extract_main_text(df).collect()}
    assert got == {k: text for k, (_, text) in PAGES.items()}


def test_boilerplate_inside_the_article():
    field = hx.train(hx.labelled_pages())
    right = total = 0
    for tag, name in {p for p in hx.INSIDE + hx.OTHER_IN if all(p)}:
        for inner in ("Buy boats now, they are cheap", "<p>Buy boats now, they are cheap today.</p><p>All of them.</p>",
                      "<h3>More</h3><ul><li><a href=1>One</a></li><li><a href=2>Two boats</a></li></ul>"):
            page = (f"<html><body><header><h1>Site</h1></header><article><h1>Flood</h1><p>First of all, it rained.</p>"
                    f'<{tag} class="{name}">{inner}</{tag}>{BODY}</article><footer>The Paper</footer></body></html>')
            right += hx.main_text(page, field) == "Flood\nFirst of all, it rained.\n" + TEXT
            total += 1
    assert right >= 0.95 * total


def test_viterbi_is_the_best_sequence():
    import itertools

    field = hx.train(hx.labelled_pages(30))

    def total(blocks, labels):
        s = sum(field.state.get(f, (0, 0))[y] for b, y in zip(blocks, labels) for f in b.features)
        return s + sum(field.change[a][b] for a, b in zip(labels, labels[1:]))

    for blocks, _ in hx.labelled_pages(20, seed=5):
        blocks = blocks[:9]
        best = max(itertools.product((0, 1), repeat=len(blocks)), key=lambda y: total(blocks, y))
        assert abs(total(blocks, field.decode(blocks)) - total(blocks, best)) < 1e-9


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in hx.extract_main_text(pages).collect()}
    for p in pages.collect():
        article = re.search(r"(?s)<article>(.*?)(</article>|\Z)", p.html)[1]
        want = "\n".join(b.text for b in hx.leaf_blocks(article))
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want)


def test_blocks():
    texts = [b.text for b in hx.leaf_blocks(
        "<p>a&amp;b &lt;i&gt;\n x<b>y</b> <br>z<p>two</p>tail<script>var a='<p>no</p>';</script><!-- <p>no --><td>c</td> 1 < 2 <p")]
    assert texts == ["a&b <i> xy z", "two", "tail", "c", "1 < 2"]


def test_hidden_elements_hold_no_markup():
    def texts(page):
        return [b.text for b in hx.leaf_blocks(page)]

    for hidden in ("<script>for(i=0;i<n;i++){x()}</script>", "<SCRIPT>i<n</Script >", "<title>x<y notes</title>",
                   """<script>s='<a href="'+u;t='</scripts>'</script>""", "<script><!-- i<n</script>", "<style>a::before{content:'<b'}</style>",
                   "<textarea>1 <b \"</textarea>", "<iframe><p '</iframe>", "<noscript><img alt=\"</noscript>",
                   "<svg><script>i<n</script><g/></svg>", "<template><style>'<a \"'</style></template>"):
        assert texts(f"<p>one</p>{hidden}<p>it's \"two\"</p>") == ["one", "it's \"two\""], hidden
    assert texts("<p>one</p><script>i<n") == ["one"] and texts("<p>one<title>a</titl") == ["one"]


def test_edge_cases_and_no_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain text only, nothing else."), (3, "u", "plain text only, nothing else."),
            (None, "u", "<article>" + "<p>word word word word.</p>" * 20_000), (5, "u", "<div>" * 3000 + "<p>deep" + "</div>" * 3000),
            (6, "u", "<p \"unclosed attribute"), (7, "u", "<!-- open"), (8, "u", "<article><p>\x00&#0;&#x110000;&bogus;</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in [*CLASHES, "text"]:
        df = df.withColumn(c, F.lit("clash"))
    got = hx.extract_main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {(r.page_id, r.url): r.text for r in got}
    assert by[1, None] == "" and by[2, "u"] == "" and by[None, "u"].count("\n") == 19_999
    assert hx.extract_main_text(df.where("false")).count() == 0
