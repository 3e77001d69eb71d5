"""SurveySpec interpreter on hand-written interviews (FIXTURES.md §3 traps)."""

from canvass.plans.catalog import BY_ID, SPECS
from canvass.sources.documents import documents_to_stream

DOC_D37 = """<Interview><Header><SubjectNum>7001</SubjectNum><Upload>2026-01-02T03:04:05Z</Upload></Header>
<Answers><FullVariable>outlet_code</FullVariable><QuestionAnswer>A1</QuestionAnswer>
<FullVariable>I_1_item_category</FullVariable><QuestionAnswer>Water</QuestionAnswer>
<FullVariable>I_1_item_name</FullVariable><QuestionAnswer>Voltic (500ml) (PET)</QuestionAnswer>
<FullVariable>I_1_item_price</FullVariable>
<FullVariable>I_2_item_category</FullVariable><QuestionAnswer>Juice</QuestionAnswer>
<FullVariable>I_3_item_category</FullVariable><QuestionAnswer>DONE</QuestionAnswer>
</Answers></Interview>"""


def _answers(spark, *docs):
    df = spark.createDataFrame([(i + 1, d) for i, d in enumerate(docs)], "subject_id long, xml string")
    return documents_to_stream(df)


def test_catalogue_is_complete():
    assert [s.id for s in SPECS] == [f"D{i:02d}" for i in range(1, 43)]
    assert len(BY_ID["D02"].sku_metric[0]) == 35 and len(BY_ID["D02"].sku_metric[1]) == 13
    assert len(BY_ID["D19"].blocks[0].variables) == 19


def test_d37_items(spark):
    from canvass.plans.spec import run_spec

    out = run_spec(BY_ID["D37"], _answers(spark, DOC_D37)).orderBy("rec").collect()
    assert [r.item_category for r in out] == ["Water", "Juice"]          # DONE removed
    assert [r.outlet_code for r in out] == ["A1", "A1"]                  # filled from first
    assert out[0].item_name == "Voltic " and out[0].item_price is None   # greedy paren, strict
    assert out[0].SubjectNum == "7001" and str(out[0].Upload) == "2026-01-02 03:04:05"


DOC_D01 = """<Interview><Header><SubjectNum>5</SubjectNum><Upload>2026-01-02T03:04:05Z</Upload>
<VisitStart>2026-01-02T03:00:00Z</VisitStart><VisitEnd></VisitEnd><ClientDuration>00:04</ClientDuration>
<Date>2026-01-02T00:00:00Z</Date></Header><Answers>
<FullVariable>Region</FullVariable><QuestionAnswer>North</QuestionAnswer>
<FullVariable>Contact</FullVariable>
<FullVariable>gps_address</FullVariable><QuestionAnswer>Latitude: 5 36' 12.0 N (5.6033)
Longitude: 0 11' W (-0.1870)
Captured at: 2026-01-02 10:11:12
Altitude: 61.2
Bearing: 10.0
Speed: 1.5 km/h</QuestionAnswer></Answers></Interview>"""


def test_d01_profile(spark):
    from canvass.plans.spec import run_spec

    out = run_spec(BY_ID["D01"], _answers(spark, DOC_D01))
    assert out.columns == ["subject_id", *BY_ID["D01"].output_columns()]
    r = out.collect()[0].asDict()
    assert r["Region"] == "North"
    assert r["Contact"] == "gps_address"          # loose: unanswered -> next question's name
    assert r["VisitEnd"] is None and r["NetDuration"] == "00:04"
    assert r["GPS_Latitude"] == "5 36' 12.0 N" and r["GPS_Speed (km/h)"] == "1.5"
    assert r["Enumerator_Name"] is None


DOC_D39 = """<Interview><Header><SubjectNum>9</SubjectNum><Upload>2026-01-02T03:04:05Z</Upload></Header>
<Answers><FullVariable>water_stock</FullVariable><QuestionAnswer>yes</QuestionAnswer>
<Text>Wholesalers/ Grossisters</Text><TopicAnswer>weekly</TopicAnswer>
<FullVariable>purch_freq</FullVariable></Answers></Interview>"""


def test_d39_vector_fallback_reversed_markers(spark):
    from canvass.plans.catalog import SUPPLIERS
    from canvass.plans.spec import run_spec

    r = run_spec(BY_ID["D39"], _answers(spark, DOC_D39)).collect()[0].asDict()
    assert r[SUPPLIERS[2]] == "weekly" and r[SUPPLIERS[0]] == ""


def _doc(header, body):
    h = "".join(f"<{k}>{v}</{k}>" for k, v in header)
    return f"<Interview><Header>{h}</Header><Answers>{body}</Answers></Interview>"


def _fv(name, answer=None):
    return f"<FullVariable>{name}</FullVariable>" + (f"<QuestionAnswer>{answer}</QuestionAnswer>" if answer is not None else "")


def _grid(label, answer=None):
    return f"<Text>{label}</Text>" + (f"<TopicAnswer>{answer}</TopicAnswer>" if answer is not None else "")


HDR = [("SubjectNum", "9"), ("Upload", "2026-01-02T03:04:05Z"), ("Date", "2026-01-02T00:00:00Z")]


def test_d02_sku_metrics_long_with_none_parity(spark):
    from canvass.plans.spec import run_spec

    body = _fv("BUDWEISER 355ML BOTTLE_Price", "5.0") + _fv("BUDWEISER 355ML BOTTLE_Display_Location", "Shelf, Fridge")
    out = run_spec(BY_ID["D02"], _answers(spark, _doc(HDR, body)))
    assert out.columns == ["subject_id", *BY_ID["D02"].output_columns()]
    rows = out.collect()
    assert len(rows) == 34 + 2                                   # 35 SKUs, Budweiser exploded in two
    bud = [r for r in rows if r.Variable == "BUDWEISER 355ML BOTTLE"]
    assert sorted(r.Display_Location for r in bud) == ["Fridge", "Shelf"] and bud[0].Price == "5.0"
    assert {r.Display_Location for r in rows if r.Variable != "BUDWEISER 355ML BOTTLE"} == {"None"}


def test_d17_slice_records_and_explode(spark):
    from canvass.plans.spec import run_spec

    body = (_fv("brand_adverts") + _grid("Polytank", "Yes") + _grid("Sintex", "No") + _fv("other_adverts", "TV, Radio")
            + _grid("Polytank", "Ignored"))
    rows = run_spec(BY_ID["D17"], _answers(spark, _doc(HDR, body))).collect()
    assert sorted(r.other_adverts for r in rows) == ["Radio", "TV"]
    assert {(r.Polytank, r.Sintex) for r in rows} == {("Yes", "No")}


def test_d19_section_sits_on_first_record(spark):
    from canvass.plans.catalog import D19_STATEMENTS
    from canvass.plans.spec import run_spec

    s1, s2 = D19_STATEMENTS[0], D19_STATEMENTS[10]
    body = (_grid(s1, "Agree") + _grid(s2, "Neutral") + _grid(s1, "Disagree")
            + "<Variable>brand_impression</Variable>" + _fv("strong")
            + "<Variable>brand_impression</Variable>" + _fv("cheap") + "<Variable>overall_best</Variable>")
    rows = run_spec(BY_ID["D19"], _answers(spark, _doc(HDR[:2], body))).collect()
    # two records; only record 1 carries brand_impression, so the explode keeps record 1 only
    assert sorted(r.brand_impression for r in rows) == ["cheap", "strong"]
    assert {r[s1] for r in rows} == {"Agree"} and {r[s2] for r in rows} == {"Neutral"}


def test_d40_two_record_streams_zipped(spark):
    from canvass.plans.spec import run_spec

    body = (_grid("ITEM_NAME", "Soap") + _grid("SALES", "3") + _grid("ITEM_NAME", "Rice")
            + _fv("outlet_code", "O1") + _fv("I_1_old_current_sales", "10") + _fv("I_1_old_current_price", "2.5")
            + _fv("I_2_old_current_sales", "7"))
    rows = run_spec(BY_ID["D40"], _answers(spark, _doc(HDR[:2], body))).orderBy("rec").collect()
    assert [(r.ITEM_NAME, r.SALES, r.old_current_sales, r.old_current_price, r.outlet_code) for r in rows] == [
        ("Soap", "3", "10", "2.5", "O1"), ("Rice", None, "7", None, "O1")]


def test_option_lists_equal_explode_then_group(spark):
    """The linear per-column lists equal the sequential explode (row product)
    followed by distinct values in order of first appearance."""
    import itertools

    from canvass.operators.aggregate import option_lists

    rows = [("1", "a, b, a", "x", " , y, z", "t"), ("2", None, None, None, "u"),
            ("3", "c", None, "y,y", None), ("4", " , ", "w", None, "v")]
    cols, explode = ["p", "q", "r", "s"], ["p", "q", "r"]
    df = spark.createDataFrame(rows, "k string, p string, q string, r string, s string")
    got = {(r.category, r.k): r.Product_List for r in option_lists(df, "k", cols, explode).collect()}

    def opts(v):
        return [o.strip() for o in v.split(",") if o.strip()] if v is not None else []

    want = {}
    for k, *vals in rows:
        cells = dict(zip(cols, vals))
        if all(cells[c] is None for c in explode):
            continue
        lists = [opts(cells[c]) or [None] if c in explode else [cells[c]] for c in cols]
        product = list(itertools.product(*lists))
        for i, c in enumerate(cols):
            seen = []
            for row in product:
                if row[i] is not None and row[i] not in seen:
                    seen.append(row[i])
            want[(c, k)] = ", ".join(seen)
    assert got == want


def test_attribute_rows_stay_in_the_stream(spark):
    """FIL-1 keeps attribute rows of the kept tags: the attribute row is the
    'next row' of its question (loose gives its value, strict gives NULL)."""
    from canvass.operators.lookup import lookup

    doc = ('<I><Answers><FullVariable code="7">q1</FullVariable><QuestionAnswer>a</QuestionAnswer>'
           '<FullVariable>q2</FullVariable><QuestionAnswer lang="fr">b</QuestionAnswer></Answers></I>')
    s = _answers(spark, doc)
    loose = lookup(s, ["q1", "q2"], mode="loose").first()
    strict = lookup(s, ["q1", "q2"], mode="strict").first()
    assert (loose.q1, strict.q1) == ("7", None)
    assert (loose.q2, strict.q2) == ("b", "b")


def test_d10_prefix_only_in_question_block(spark):
    """The loop prefix is stripped in the question block, not in the grid
    block; brand_type (a lookup cell, record 1 only) is exploded."""
    from canvass.plans.spec import run_spec

    body = (_fv("I_1_brand_type", "Club, Star") + _fv("vc_count", "2")
            + _grid("vc_Brand1", "Club") + _grid("I_1_vc_Brand2", "Star"))
    rows = run_spec(BY_ID["D10"], _answers(spark, _doc(HDR[:2], body))).collect()
    assert sorted(r.brand_type for r in rows) == ["Club", "Star"]
    assert {(r.vc_count, r.vc_Brand1, r.vc_Brand2) for r in rows} == {("2", "Club", None)}


def test_specs_json_round_trip():
    from canvass.plans.spec import specs_from_json, specs_to_json

    assert specs_from_json(specs_to_json(SPECS)) == SPECS


def test_every_spec_runs_on_a_generated_interview(spark):
    """Smoke: each of the 42 specs runs end to end on one interview that
    answers all its variables, and returns its declared columns."""
    from xml.sax.saxutils import escape

    from canvass.plans.spec import run_spec

    ts = "2026-01-02T03:04:05Z"
    for spec in SPECS:
        header = [(h, ts if h in ("Upload", "Date", "VisitStart", "VisitEnd") else "7") for h in spec.header]
        body = ""
        for b in spec.blocks:
            part = ""
            for v in b.variables:
                if b.question == "Text":
                    part += _grid(escape(v), "a, b")
                else:
                    part += _fv(escape(v), "a, b")
            if b.slice_between:   # sliced grids first: a marker may also be a question
                body = _fv(b.slice_between[0]) + part + _fv(b.slice_between[1]) + body
            else:
                body += part
        if spec.sku_metric:
            body += _fv(escape(spec.sku_metric[0][0] + "_" + spec.sku_metric[1][0]), "x")
        out = run_spec(spec, _answers(spark, _doc(header, body)))
        rows = out.collect()
        assert len(rows) >= 1, spec.id
        declared = set(spec.output_columns())
        assert declared <= set(out.columns), (spec.id, declared - set(out.columns))
