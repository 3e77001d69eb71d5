"""Interview documents (SRC-4) and their flattening to answer streams (SRC-5).

Documents live in a landing folder or a table column ``xml``. Flattening is a column
expression, so no document leaves the JVM: pre-order walk of the elements; an element
yields ``(tag, 'text', text)`` when its own text (before its first child) is non-blank
(not stripped), then one row per attribute; tail text is ignored. ``seq`` is the position
in that walk, so it is dense and a block of ``span`` positions holds at most ``span`` rows.

Spark's XML parser judges whether a document is well formed. Character references, the
five named entities, CDATA, comments and processing instructions are read as XML has it.
Names keep their prefix as written, and namespace declarations are no attributes.
Documents that declare entities of their own count as not parsable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordered import block_span, has_whole_subjects, whole_block
from ..operators.whole import Whole, with_whole

NOT_XML = "not well-formed XML"

# Pieces of XML as regular expressions. Loops are possessive: none of them goes back or deep.
CDATA = r"<!\[CDATA\[(?s:.*?)\]\]>"
ASIDE = rf"({CDATA})|<!--(?s:.*?)-->|<\?(?s:.*?)\?>|<!DOCTYPE[^>\[]*+>"
QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
TAG = rf"""<[^\s/>!?<][^\s/>]*+[^<>"']*+(?:{QUOTED}[^<>"']*+)*+>"""
ELEMENT = rf"{CDATA}|{TAG}[^<]*+(?:{CDATA}[^<]*+)*+"
# Plain documents: no references, no asides, and start tags that are a name and nothing else
ODD_TAG = r"<[^\s/>!?<][^\s/>]*+[\s/]"
PLAIN_ELEMENT = r"<([^/>!?<][^>]*+)>((?U:\s*+)[^<]++)"      # with a text that is not blank
ATTRIBUTE = rf"""[^\s=<>/"']++\s*+=\s*+{QUOTED}"""

# The named entities of XML
ENTITIES = {"&lt;": "<", "&gt;": ">", "&amp;": "&", "&quot;": '"', "&apos;": "'"}


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _decoded(text: Column) -> Column:
    """``text`` with its references replaced, each once."""
    def one(piece: Column) -> Column:
        named = F.lit(None).cast("string")
        for k, v in ENTITIES.items():
            named = F.when(piece == k, v).otherwise(named)
        digits = F.when(F.startswith(piece, F.lit("&#x")), F.regexp_extract(piece, "&#x([0-9a-fA-F]+);", 1)) \
            .otherwise(F.conv(F.regexp_extract(piece, "&#([0-9]+);", 1), 10, 16))
        coded = F.decode(F.unhex(F.lpad(F.regexp_replace(digits, "^0+", ""), 8, "0")), "UTF-32")
        return F.when(F.startswith(piece, F.lit("&")), F.coalesce(named, coded)).otherwise(piece)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(_all(text, "&[^;]*+;|[^&]++"), one), "")).otherwise(text)


def _text(raw: Column) -> Column:
    """An element's text: CDATA as it stands, the rest decoded."""
    inner = len("<![CDATA[")
    part = lambda x: F.when(F.startswith(x, F.lit("<![")), F.substr(x, F.lit(inner + 1), F.length(x) - (inner + 3))) \
        .otherwise(_decoded(x))
    return F.when(F.contains(raw, F.lit("<![CDATA[")), F.array_join(F.transform(_all(raw, f"{CDATA}|[^<]++"), part), "")) \
        .otherwise(_decoded(raw))


def _triple(element: Column, attribute: Column, value: Column) -> Column:
    return F.struct(element.alias("element"), attribute.alias("attribute"), value.alias("value"))


def _rows(body: Column) -> Column:
    """The triples of a document: its pieces are start tags with the text behind them (and
    lone CDATA, which has none). Each step keeps what the next one uses more than once."""
    pieces = F.filter(_all(body, ELEMENT), lambda p: ~F.startswith(p, F.lit("<!")))
    heads = F.transform(pieces, lambda p: F.struct(p.alias("p"), F.substring_index(p, ">", 1).alias("head")))

    def tag(x: Column) -> Column:
        odd = F.lit(False)                             # more in the tag than a name
        for c in ("=", "/", " ", "\n", "\t"):
            odd = odd | F.contains(x["head"], F.lit(c))
        return F.struct(x["p"].alias("p"), x["head"].alias("head"), F.when(odd, F.regexp_extract(x["p"], "^" + TAG, 0)).alias("tag"))

    def parts(x: Column) -> Column:
        bare, name = x["tag"].isNull(), F.regexp_extract(x["tag"], r"^<([^\s/>]+)", 1)
        raw = F.when(bare, F.substr(x["p"], F.length(x["head"]) + 2)) \
            .when(F.endswith(x["tag"], F.lit("/>")), "").otherwise(F.substr(x["p"], F.length(x["tag"]) + 1))
        given = F.when(~bare, _all(F.regexp_replace(x["tag"], r"^<[^\s/>]+", ""), ATTRIBUTE))
        return F.struct(F.when(bare, F.substr(x["head"], F.lit(2))).otherwise(name).alias("name"), raw.alias("raw"), given.alias("given"))

    def read(x: Column) -> Column:
        return F.struct(x["name"].alias("name"), _text(x["raw"]).alias("text"), x["given"].alias("given"))

    def attribute(name: Column, a: Column) -> Column:
        key = F.regexp_extract(a, r"^[^\s=]+", 0)
        value = F.regexp_extract(a, r"(?s)^[^=]*=\s*.(.*).$", 1)
        return _triple(name, key, _decoded(F.translate(value, "\t\n", "  ")))

    def triples(x: Column) -> Column:
        none = F.array().cast("array<struct<element:string,attribute:string,value:string>>")
        own = F.when(F.regexp_like(x["text"], F.lit(r"(?U)\S")), F.array(_triple(x["name"], F.lit("text"), x["text"]))).otherwise(none)
        declared = lambda a: F.regexp_like(a, F.lit(r"^xmlns[:\s=]"))
        given = F.filter(x["given"], lambda a: ~declared(a))
        return F.when(x["given"].isNull(), own).otherwise(F.concat(own, F.transform(given, lambda a: attribute(x["name"], a))))

    steps = heads
    for step in (tag, parts, read, triples):
        steps = F.transform(steps, step)
    return F.flatten(steps)


def _is_plain(body: Column) -> Column:
    return ~(F.contains(body, F.lit("&")) | F.contains(body, F.lit("<!")) | F.contains(body, F.lit("<?"))
             | F.regexp_like(body, F.lit(ODD_TAG)))


def _parses(xml: Column) -> Column:
    """Spark's parser reaches the end of the root element."""
    found = F.from_xml(xml, "broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    return xml.isNotNull() & found["broken"].isNull()


def _ends_with_root(body: Column) -> Column:
    """Nothing follows the root element of a ``body`` whose root element is well formed: its
    only end tag comes last, or what is left without the last end tag does not parse."""
    name = F.regexp_extract(body, r"^<([^\s/>]+)", 1)
    end = F.concat(F.lit("</"), name, F.lit(">"))
    last = F.regexp_extract(body, r"</([^\s>]+)\s*+>$", 1)
    first = F.regexp_extract(body, "^" + TAG, 0)
    return F.when(F.endswith(first, F.lit("/>")), first == body) \
        .when(F.call_function("locate", end, body) == F.length(body) - F.length(end) + 1, True) \
        .otherwise((last == name) & ~_parses(F.regexp_replace(body, r"</[^<]*$", "")))


def read_documents(docs: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    """``docs(subject_id LONG or STRING, xml STRING)`` parsed, a row each: ``good`` (null: no
    document), ``rows`` in document order (null: none), and columns ``keep``."""
    # ids keep their kind: numbers from tables, text from landing folders
    kind = "string" if isinstance(docs.schema["subject_id"].dataType, T.StringType) else "long"
    read = docs.select(F.col("subject_id").cast(kind), F.col("xml").cast("string"), *keep)
    lines = F.when(F.contains("xml", F.lit("\r")), F.regexp_replace("xml", r"\r\n?", "\n")).otherwise(F.col("xml"))
    read = read.withColumn("lines", lines)
    aside = F.contains("lines", F.lit("<!")) | F.contains("lines", F.lit("<?"))
    body = F.when(aside, F.regexp_replace("lines", ASIDE, "$1")).otherwise(F.col("lines"))
    read = read.select("subject_id", "xml", F.trim(body, F.lit(" \t\n")).alias("body"), *keep)
    good = F.when(F.col("xml").isNotNull(), _parses(F.col("xml")) & _ends_with_root(F.col("body")))
    read = read.select("subject_id", "body", good.alias("good"), *keep)
    # plain documents are two expressions; others take the steps of ``_rows``, one lambda each.
    # No filter before the arrays, neither ours nor the one that an inner posexplode brings: it
    # would be pushed down and parse the document again
    odd = F.when(F.col("good") & ~F.col("plain"), _rows(F.col("body")))
    out = read.withColumn("plain", _is_plain(F.col("body"))).withColumn("odd", odd)
    simple = F.col("good") & F.col("plain")
    found = lambda group: F.regexp_extract_all("body", F.lit(PLAIN_ELEMENT), F.lit(group))
    rows = F.arrays_zip(F.when(simple, found(1)).otherwise(F.col("odd.element")).alias("element"),
                        F.when(simple, F.array().cast("array<string>")).otherwise(F.col("odd.attribute")).alias("attribute"),
                        F.when(simple, found(2)).otherwise(F.col("odd.value")).alias("value"))
    return out.select("subject_id", "good", rows.alias("rows"), *keep)


def stream_of(read: DataFrame, *, keep_errors: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """The answer stream of ``read_documents``."""
    span = block_span(read.sparkSession)
    rows = F.col("rows")
    if keep_errors:
        rows = F.when(~F.col("good"), F.array(_triple(*[F.lit(None).cast("string")] * 3))).otherwise(rows)
    out = read.select("subject_id", "good", F.posexplode_outer(rows).alias("at", "r"), *keep).where("at is not null")
    seq = F.when(F.col("good"), F.col("at")).otherwise(-1).cast("long") if keep_errors else F.col("at").cast("long")
    attribute = F.coalesce("r.attribute", F.when(F.col("good"), "text"))
    return out.withColumn("seq", seq).select(
        "subject_id", "seq", whole_block(F.floor(F.col("seq") / span).cast("long")), "r.element", attribute.alias("attribute"), "r.value", *keep,
        *([F.when(~F.col("good"), NOT_XML).alias("parse_error")] if keep_errors else []))


def interviews_once(docs: DataFrame, once: DataFrame | None = None, rest: DataFrame | None = None) -> DataFrame:
    """``docs`` of which ``once`` (all, by default) are the only document of their interview, and ``rest`` are not."""
    docs._once = (docs if once is None else once, rest)
    return docs


def documents_to_stream(docs: DataFrame, *, keep_errors: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """SRC-5: ``docs(subject_id LONG or STRING, xml STRING)`` -> answer stream.

    Documents that do not parse give one row with ``parse_error`` set (seq -1)
    when ``keep_errors``; otherwise they are dropped here and reported by
    ``document_errors``. A null document has no answers and no error. Columns ``keep`` of a
    document stand on each of its rows. The stream of ``interviews_once`` carries its documents."""
    out = stream_of(read_documents(docs, keep=keep), keep_errors=keep_errors, keep=keep)
    if "_once" in docs.__dict__ and not keep_errors:
        once, rest = docs._once
        with_whole(out, Whole(read_documents(once), None if rest is None else stream_of(read_documents(rest))))
    return out


def document_errors(docs: DataFrame) -> DataFrame:
    s = documents_to_stream(docs, keep_errors=True)
    return s.filter(F.col("parse_error").isNotNull()).select("subject_id", "parse_error")


def read_landing(spark: SparkSession, path: str, *, subject_from: str = "file") -> DataFrame:
    """SRC-4 re-aimed: one XML document per file in a landing folder
    (partition folders such as ``upload_date=...`` become columns). The
    subject id is the file's base name without extension."""
    df = spark.read.option("wholetext", True).text(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)(\.[^.]*)?$", 1)
    return df.select(name.alias("subject_id"), F.col("value").alias("xml"),
                     *[c for c in df.columns if c != "value"])


# --- building interview documents from table columns (test bindings) ----------

def xml_escape(c: Column) -> Column:
    # plain string replace (no regex engine per value)
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def tag(name: str, value: Column) -> Column:
    """``<name>value</name>``; NULL value -> no element at all."""
    return F.when(value.isNotNull(),
                  F.concat(F.lit(f"<{name}>"), xml_escape(value.cast("string")), F.lit(f"</{name}>")))


def question(name: Column | str, answer: Column | None) -> Column:
    """A FullVariable / QuestionAnswer pair; a NULL answer leaves the question
    unanswered (no QuestionAnswer element)."""
    n = F.lit(name) if isinstance(name, str) else name
    q = F.concat(F.lit("<FullVariable>"), xml_escape(n), F.lit("</FullVariable>"))
    if answer is None:
        return q
    return F.concat(q, F.coalesce(tag("QuestionAnswer", answer), F.lit("")))


def grid(label: str, answer: Column | None) -> Column:
    """A Text label / TopicAnswer pair; no answer leaves the label alone."""
    head = F.concat(F.lit("<Text>"), xml_escape(F.lit(label)), F.lit("</Text>"))
    if answer is None:
        return head
    return F.concat(head, F.coalesce(tag("TopicAnswer", answer), F.lit("")))


def interview_document(header: dict[str, Column], parts: Sequence[Column]) -> Column:
    """One interview: header elements then the answer parts, in order."""
    head = [F.coalesce(tag(k, v), F.lit("")) for k, v in header.items()]
    body = [F.coalesce(p, F.lit("")) for p in parts]
    return F.concat(F.lit("<Interview><Header>"), *head, F.lit("</Header><Answers>"), *body,
                    F.lit("</Answers></Interview>"))


def materialize_stream(answers: DataFrame) -> DataFrame:
    """The answer stream, clustered for the ordered scans.

    Answers of documents hashed by subject are so already: each branch of a dataset
    (header, lookups, records) reads them out of the documents again, in the JVM, which is
    less than writing and reading back some twenty rows a document.

    Any other stream is hash-partitioned on ``(subject_id, block)`` -- the distribution
    every ordered scan needs -- and checkpointed into the shared
    ``spark.checkpoint.dir`` (a reliable write that survives executor loss and keeps
    the partitioning, so the scans add no shuffle)."""
    from ..session import cut_lineage

    if has_whole_subjects(answers):
        return answers

    return cut_lineage(answers.repartition("subject_id", "block"))
