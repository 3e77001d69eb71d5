"""Datasets of one shape, end to end: a block of questions, a grid of labels, or both.

One interview per customer is generated for each dataset from its spec: every fifth
question is unanswered (at another place in each interview), every fourth label of
the grid too, and every seventh interview has no grid at all. Multi-select cells
hold two options. The oracle derives the same table from ``customer`` in SQL, with
all declared columns (variables as v0, v1, ... in spec order).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions.scalars import GPS_COLUMNS
from ..operators.factorised import product_value_counts, with_options
from ..schema import QUESTION, SUBJECT
from ..sources.documents import documents_to_stream, grid, interview_document, materialize_stream, question
from ..sources.tables import read_table
from .catalog import BY_ID
from .interviews import _gps_text
from .interviews import _spread
from .registry import query
from .spec import HEADER_RENAME, run_spec

DATASETS = {"D04": "audit_profile", "D05": "supply_source", "D08": "outlet_type", "D10": "outlet_describe",
            "D12": "product_price", "D13": "product_status", "D15": "tank_social",
            "D18": "tank_preference", "D20": "retail_profile", "D23": "advert", "D25": "social", "D26": "media",
            "D28": "biscuit_overview", "D29": "special_skus", "D31": "bike_media", "D34": "brand_association",
            "D35": "bike_advert", "D36": "advert_impression",
            "D09": "outlet_profile", "D14": "owner_profile", "D30": "rider_profile"}
# Wide products: counted from their factors, never made
COUNTED = {"D17": "brand_aware_counts", "D32": "bike_aware_counts"}
TIME = "2024-05-06T07:08:09Z"
TIMES = {"Upload", "Date", "VisitStart", "VisitEnd"}


def _blocks(spec):
    asked = [v for b in spec.blocks if not b.records for v in b.variables]
    labels = [v for b in spec.blocks if b.records for v in b.variables]
    return asked, labels


def spec_grid(spec) -> bool:
    """Whether the records are a grid (labels), not questions with a loop prefix."""
    return all(b.question != QUESTION for b in spec.blocks if b.records)


def _options(spec):
    return spec.explode if spec.explode else ((), ",")


def _slice(spec):
    return next((b.slice_between for b in spec.blocks if b.slice_between), (None, None))


def interviews(spark, sf_dir, spec):
    k = F.col("c_custkey")
    asked, labels = _blocks(spec)
    multi, sep = _options(spec)
    prefix = "I_1_" if any(b.strip_prefix for b in spec.blocks if not b.records) else ""
    header = {h: F.lit(TIME) if h in TIMES else k for h in spec.header}
    parts, answers = [], []
    for i, v in enumerate(labels):
        cell = F.concat(F.lit(f"g{i}-"), (k % 6).cast("string"))
        asks = grid if spec_grid(spec) else lambda n, a: question("I_1_" + n, a)
        answers.append(F.when(k % 7 != 0, asks(v, F.when((k + i) % 4 != 0, cell))))
    start, end = _slice(spec)
    for i, v in enumerate(asked):
        if v == end:                                    # the grid stands between its markers
            parts += [question(start, None), *answers]
        if spec.gps and v == spec.gps[0]:
            parts.append(question(v, F.when((k + i) % 5 != 0, _gps_text(k, k % 25))))
            continue
        cell = F.concat(F.lit(f"a{i}{sep} b"), (k % 3).cast("string")) if v in multi \
            else F.concat("c_mktsegment", F.lit(f"-{i}-"), (k % 4).cast("string"))
        parts.append(question(prefix + v, F.when((k + i) % 5 != 0, cell)))
    if end is None:
        parts += answers
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return _spread(c, k, interview_document(header, parts))


# What the generated GPS text holds, by layout
_REST = {"GPS_Date": "'2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 10:11:12'",
         "GPS_Altitude": "CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 100 AS VARCHAR) || '.0' END",
         "GPS_Bearing": "CASE WHEN c_custkey % 5 <> 0 THEN '10.0' END",
         "GPS_Speed (km/h)": "CASE WHEN c_custkey % 5 <> 0 THEN '1.5' END"}
GPS_SQL = {"dms_fixed": {"GPS_Latitude": "CAST(c_custkey % 25 AS VARCHAR) || ' 12'' 30.5 N'",
                         "GPS_Longitude": "CAST(c_custkey % 180 AS VARCHAR) || ' 10'' W'"} | _REST,
           "decimal": {"GPS_Latitude": "(c_custkey % 90)::DOUBLE + 0.5",
                       "GPS_Longitude": "('-' || (c_custkey % 180) || '.25')::DOUBLE"} | _REST
           | {"GPS_Speed (km/h)": "CASE WHEN c_custkey % 5 <> 0 THEN '' END"}}     # X3: parity, the speed is never read


def oracle(spec) -> str:
    asked, labels = _blocks(spec)
    multi, sep = _options(spec)
    cols, froms, wheres = ["c_custkey AS subject_id"], ["customer"], []
    for h in spec.header:
        cols.append(("'2024-05-06 07:08:09'" if h in TIMES else "CAST(c_custkey AS VARCHAR)") + f' AS "{HEADER_RENAME.get(h, h)}"')
    if labels and not spec.zip_records:
        wheres.append("c_custkey % 7 <> 0")             # the header stands beside records only
    for i, v in enumerate(asked):
        # a loose lookup takes what comes next: the next question's name
        after = f"'{asked[i + 1]}'" if i + 1 < len(asked) else "CAST(NULL AS VARCHAR)"
        start, end = _slice(spec)
        if end is not None and asked[i + 1:i + 2] == [end]:
            after = f"'{start}'"
        if spec.gps and v == spec.gps[0]:
            cols += [f"CASE WHEN (c_custkey + {i}) % 5 <> 0 THEN {x} END AS \"{n}\"" for n, x in GPS_SQL[spec.gps[1]].items()]
            continue
        if v in multi:
            froms.append(f"unnest(CASE WHEN (c_custkey + {i}) % 5 = 0 THEN [{after}] "
                         f"ELSE ['a{i}', 'b' || (c_custkey % 3)] END) AS u{i}(x{i})")
            cols.append(f"x{i} AS v{i}")
            if len(multi) == 1 and i + 1 == len(asked):
                wheres.append(f"x{i} IS NOT NULL")
        else:
            cols.append(f"CASE WHEN (c_custkey + {i}) % 5 = 0 THEN {after} "
                        f"ELSE c_mktsegment || '-{i}-' || (c_custkey % 4) END AS v{i}")
    for i in range(len(labels)):
        cols.append(f"CASE WHEN c_custkey % 7 <> 0 AND (c_custkey + {i}) % 4 <> 0 THEN 'g{i}-' || (c_custkey % 6) END "
                    f"AS v{len(asked) + i}")
    return f"SELECT {', '.join(cols)} FROM {', '.join(froms)}" + (f" WHERE {' AND '.join(wheres)}" if wheres else "")


def _register(spec_id: str, name: str) -> None:
    spec = BY_ID[spec_id]

    @query(f"{spec_id.lower()}_{name}_from_xml", oracle(spec))
    def run(spark, sf_dir):
        out = run_spec(spec, materialize_stream(documents_to_stream(interviews(spark, sf_dir, spec))))
        asked, labels = _blocks(spec)
        heads = [HEADER_RENAME.get(h, h) for h in spec.header]
        return out.select(SUBJECT, *[F.date_format(h, "yyyy-MM-dd HH:mm:ss").alias(h) if h in TIMES else F.col(h) for h in heads],
                          *[F.col(f"`{c}`") for c in (GPS_COLUMNS if spec.gps else ())],
                          *[F.col(f"`{v}`").alias(f"v{i}") for i, v in enumerate(asked + labels) if not spec.gps or v != spec.gps[0]])


def _register_counts(spec_id: str, name: str) -> None:
    """Rows and respondents of an EX-1 product (AGG-3, AGG-5); the oracle makes the product."""
    spec = BY_ID[spec_id]
    asked, _ = _blocks(spec)
    multi, sep = spec.explode
    number = {v: f"v{asked.index(v)}" for v in multi}
    each = " UNION ALL ".join(f"SELECT '{v}' AS variable, {v} AS value, count(DISTINCT subject_id) AS respondents, count(*) AS \"rows\" "
                              f"FROM t WHERE {v} IS NOT NULL GROUP BY {v}" for v in number.values())

    @query(f"{spec_id.lower()}_{name}", f"WITH t AS MATERIALIZED ({oracle(spec)}) {each} "
           "UNION ALL SELECT 'all rows', NULL, count(DISTINCT subject_id), count(*) FROM t")
    def run(spark, sf_dir):
        wide = run_spec(replace(spec, explode=None), materialize_stream(documents_to_stream(interviews(spark, sf_dir, spec))))
        named = F.coalesce(*[F.when(F.col("variable") == v, F.lit(n)) for v, n in number.items()])
        values = product_value_counts(wide, SUBJECT, multi, sep).withColumn("variable", named)
        total = with_options(wide, multi, sep).agg(F.count_distinct(SUBJECT).alias("respondents"), F.sum("__rows").cast("long").alias("rows"))
        return values.union(total.select(F.lit("all rows"), F.lit(None).cast("string"), "respondents", "rows"))


for _id, _name in DATASETS.items():
    _register(_id, _name)
for _id, _name in COUNTED.items():
    _register_counts(_id, _name)
