"""SurveySpec: a survey dataset as data, run by one interpreter (UDF-1).

A spec lists what to read from the answer stream (header elements, lookup
blocks, record blocks) and the clean-up steps; ``run_spec`` turns it into
DataFrame operators. Output columns are always the declared ones (missing
answers -> NULL), whatever the interviews contain.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (GPS_COLUMNS, gps_columns, parse_optional_ts, parse_survey_ts,
                                 strip_parenthetical, ts_parse_failed)
from ..operators.assemble import assemble_records, section_values
from ..operators.filters import drop_all_null, marker_slice, marker_slice_inclusive, not_done
from ..operators.lookup import (header_by_name, header_pairs, lookup, sku_metric_lookup,
                                vector_or_labels)
from ..operators.reshape import (expand_categories, explode_columns, explode_then_trim,
                                 explode_untrimmed, fill_from_first)
from ..operators.whole import ROWS, Reading, header_rows_of, whole_of
from ..schema import ANSWER, ELEMENT, GRID_ANSWER, GRID_LABEL, QUESTION, SECTION, SUBJECT, VALUE

QA = (QUESTION, ANSWER)
GRID = (GRID_LABEL, GRID_ANSWER)
TIMESTAMPS = ("Upload", "Date", "VisitStart")
OPTIONAL_TIMESTAMPS = ("VisitEnd",)
HEADER_RENAME = {"ClientDuration": "NetDuration"}


@dataclass(frozen=True)
class Block:
    """One lookup (``sentinel`` unset, ``records=False``) or record block."""

    variables: tuple[str, ...]
    mode: str = "loose"                      # 'loose' (LK-1) / 'strict' (LK-2)
    elements: tuple[str, ...] = QA           # FIL-1 element kinds kept before the scan
    question: str = QUESTION
    answer: str = ANSWER
    records: bool = False                    # GRP-1/GRP-2 instead of one row
    sentinel: str | None = None              # opens a new record (None: one record)
    strip_prefix: bool = False               # SC-5 before the lookup
    slice_between: tuple[str, str] | None = None  # FIL-3a on FullVariable markers first


@dataclass(frozen=True)
class Vector:
    """LK-5 over the inclusive slice between two FullVariable markers (FIL-3b)."""

    labels: tuple[str, ...]
    start: str
    end: str


@dataclass(frozen=True)
class Section:
    """GRP-3: values after each ``Variable == name`` row inside [start, end)."""

    name: str
    start: str
    end: str


@dataclass(frozen=True)
class SurveySpec:
    id: str
    name: str
    header: tuple[str, ...]
    blocks: tuple[Block, ...]
    sink: str
    header_pairs: bool = False               # LK-7 (SubjectNum/Upload by position)
    gps: tuple[str, str] | None = None       # (column, variant) SC-4
    explode: tuple[tuple[str, ...], str] | None = None   # EX-1 (columns, separator)
    fill_first: tuple[str, ...] = ()         # JN-3 over records
    not_done: bool = False                   # FIL-5 on item_category
    drop_all_null: bool = True               # FIL-4
    strip_paren: tuple[str, ...] = ()        # SC-6
    rename: dict[str, str] = field(default_factory=dict)  # PRJ-2
    vector: Vector | None = None
    section: Section | None = None
    sku_metric: tuple[tuple[str, ...], tuple[str, ...]] | None = None  # LK-3, long by SKU
    explode_trim: str | None = None          # EX-3 column (parity: NULL -> 'None')
    explode_untrimmed: str | None = None     # EX-2 column
    categories: bool = False                 # EX-4 + FIL-6
    zip_records: bool = False                # JN-2: record 1 also for interviews without records

    def output_columns(self) -> list[str]:
        cols = [HEADER_RENAME.get(h, h) for h in self.header]
        for b in self.blocks:
            cols += [self.rename.get(v, v) for v in b.variables if self.rename.get(v, v) not in cols]
        if self.vector:
            cols += list(self.vector.labels)
        if self.section:
            cols.append(self.section.name)
        if self.gps:
            cols = [c for c in cols if c != self.gps[0]] + GPS_COLUMNS
        if self.sku_metric:
            cols += ["Variable", *self.sku_metric[1]]
        return list(dict.fromkeys(cols))


def _times(h: DataFrame, columns: list[str]) -> DataFrame:
    """SC-1 / SC-2 on those of a header's ``columns`` that are times."""
    cols = []
    for c in h.columns:
        if c in columns and c in TIMESTAMPS:
            cols.append(parse_survey_ts(c).alias(c))
        elif c in columns and c in OPTIONAL_TIMESTAMPS:
            cols.append(parse_optional_ts(c).alias(c))
        else:
            cols.append(F.col(f"`{c}`"))
    return h.select(*cols)


def _header(spec: SurveySpec, answers: DataFrame) -> DataFrame:
    if spec.header_pairs:
        # several SubjectNum/Upload pairs give several header rows (parity)
        h = header_pairs(answers).drop("pair")
    else:
        h = header_by_name(answers, spec.header, HEADER_RENAME)
    return _times(h, [c for c in h.columns if c != SUBJECT])


def _attach_single(out: DataFrame, one_row: DataFrame, has_records: bool) -> DataFrame:
    """Attach a one-row-per-subject result. Beside records (a positional zip in
    the survey tables) such cells sit on the FIRST record only."""
    if has_records:
        return out.join(one_row.withColumn("rec", F.lit(1).cast("long")), [SUBJECT, "rec"], "left")
    return out.join(one_row, SUBJECT, "left")


def _sliced(answers: DataFrame, b: Block) -> DataFrame:
    if b.slice_between is None:
        return answers
    start, end = b.slice_between
    s = answers.filter(F.col(ELEMENT).isin(list(b.elements)))
    is_q = F.col(ELEMENT) == QUESTION
    return marker_slice(s, is_q & (F.col(VALUE) == start), is_q & (F.col(VALUE) == end))


def _read_stream(spec: SurveySpec, answers: DataFrame) -> DataFrame:
    """The spec's answers out of a stream: an operator each, joined by subject."""
    out = _header(spec, answers)
    has_records = any(b.records for b in spec.blocks)
    record_frames = []
    for b in spec.blocks:
        if b.records:
            src = _sliced(answers, b)
            r = assemble_records(src, b.variables, b.sentinel, elements=b.elements,
                                 question=b.question, answer=b.answer, strip_prefix=b.strip_prefix)
            record_frames.append(r)
    if record_frames:
        recs = record_frames[0]
        for r in record_frames[1:]:
            recs = recs.join(r, [SUBJECT, "rec"], "full_outer")   # JN-2 zip by record number
        if spec.zip_records:
            # JN-2: the header side is one row long, so an interview without
            # records still has row 1; the header stands on every record
            out = out.join(recs, SUBJECT, "left").withColumn("rec", F.coalesce("rec", F.lit(1).cast("long")))
        else:
            out = out.join(recs, SUBJECT, "inner")                  # JN-1 header beside items
    for b in spec.blocks:
        if b.records:
            continue
        lk = lookup(_sliced(answers, b), b.variables, mode=b.mode, elements=b.elements,
                    question=b.question, answer=b.answer, strip_prefix=b.strip_prefix)
        out = _attach_single(out, lk, has_records)
    if spec.vector:
        v = spec.vector
        is_q = F.col(ELEMENT) == QUESTION
        sl = marker_slice_inclusive(answers, is_q & (F.col(VALUE) == v.start), is_q & (F.col(VALUE) == v.end))
        vec = vector_or_labels(sl, v.labels)
        out = _attach_single(out, vec, has_records).fillna("", subset=list(v.labels))
    if spec.section:
        sc = spec.section
        is_var = F.col(ELEMENT) == SECTION
        sl = marker_slice(answers, is_var & (F.col(VALUE) == sc.start), is_var & (F.col(VALUE) == sc.end))
        sv = section_values(sl, is_var & (F.col(VALUE) == sc.name), sc.name)
        sv = _attach_single(out.select(SUBJECT).distinct(), sv, False).fillna("", subset=[sc.name])
        out = _attach_single(out, sv, has_records)
    return out


def _in_one_pass(spec: SurveySpec) -> bool:
    """Whether all that the spec reads are headers, lookups and records of names of their own."""
    names = [HEADER_RENAME.get(h, h) for h in spec.header] + [v for b in spec.blocks for v in b.variables]
    records = {v for b in spec.blocks if b.records for v in b.variables}
    return not (spec.vector or spec.section or any(b.slice_between for b in spec.blocks)) and len(names) == len(set(names)) \
        and set(spec.fill_first) <= records - set(spec.rename) - set(spec.rename.values()) \
        and not {SUBJECT, "rec"} & set(names) and not any(set("`.") & set(n) for n in spec.header)


def _read_whole(spec: SurveySpec, documents: DataFrame) -> DataFrame:
    """What ``_read_stream`` gives, filled from the first record, out of whole interviews in one pass."""
    has_records = any(b.records for b in spec.blocks)
    r = Reading(documents)
    r.header(spec.header, HEADER_RENAME, spec.header_pairs)
    header = list(r.values)
    for b in spec.blocks:
        if b.records:
            r.assemble(b.variables, b.sentinel, b.elements, b.question, b.answer, b.strip_prefix)
        else:
            r.lookup(b.variables, b.mode, b.elements, b.question, b.answer, b.strip_prefix, has_records)
    return _times(r.read(spec.zip_records, spec.fill_first), header)


def _declared(spec: SurveySpec, out: DataFrame, keys: list[str]) -> DataFrame:
    """The declared columns, missing -> NULL, renamed and cleaned."""
    present = set(out.columns)
    raw_cols = []
    for b in spec.blocks:
        raw_cols += list(b.variables)
    sel = [F.col(k) for k in keys]
    for c in [HEADER_RENAME.get(h, h) for h in spec.header] + list(dict.fromkeys(raw_cols)):
        sel.append(F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c))
    for extra in ([*spec.vector.labels] if spec.vector else []) + ([spec.section.name] if spec.section else []):
        sel.append(F.col(f"`{extra}`"))
    out = out.select(*sel)
    if spec.rename:
        out = out.withColumnsRenamed({k: v for k, v in spec.rename.items() if k in out.columns})
    if spec.gps:
        col, variant = spec.gps
        out = out.select("*", *gps_columns(col, variant)).drop(col)
    for c in spec.strip_paren:
        out = out.withColumn(c, strip_parenthetical(c))
    return out


def run_spec(spec: SurveySpec, answers: DataFrame, period: str | None = None) -> DataFrame:
    """Interpret ``spec`` over an answer stream; one DataFrame in the spec's
    declared columns (plus ``subject_id`` and, for record specs, ``rec``). Interviews that
    the stream carries whole are read in one pass."""
    has_records = any(b.records for b in spec.blocks)
    keys = [SUBJECT] + (["rec"] if has_records else [])
    whole = whole_of(answers) if _in_one_pass(spec) else None
    rest = answers if whole is None else whole.rest
    out = None if whole is None else _declared(spec, _read_whole(spec, whole.documents), keys)
    if rest is not None:
        others = _declared(spec, _read_stream(spec, rest), keys)
        if spec.fill_first and has_records:
            others = fill_from_first(others, list(spec.fill_first), order="rec")
        out = others if out is None else out.unionByName(others)
    if spec.drop_all_null:
        out = drop_all_null(out, [c for c in out.columns if c not in keys])
    if spec.not_done:
        out = not_done(out, "item_category")
    if spec.sku_metric:
        skus, metrics = spec.sku_metric
        long = sku_metric_lookup(answers, skus, metrics)
        out = out.join(long, SUBJECT, "inner")
    if spec.explode:
        cols, sep = spec.explode
        out = explode_columns(out, [c for c in cols if c in out.columns], sep)
    if spec.explode_trim:
        out = explode_then_trim(out, spec.explode_trim, ",", null_text="None")
    if spec.explode_untrimmed:
        out = explode_untrimmed(out, spec.explode_untrimmed, ",")
    if spec.categories:
        out = expand_categories(out)
    if period is not None:
        out = out.select(F.lit(period).alias("Period"), *[F.col(f"`{c}`") for c in out.columns])
    return out


def spec_rejects(spec: SurveySpec, answers: DataFrame, subjects: DataFrame) -> DataFrame:
    """QUA-1 for one dataset: ``(subject_id, dataset, reason)`` for each of
    ``subjects(subject_id)`` that the spec cannot use: no answers at all, none of
    its header rows, or a required header time that does not parse."""
    times = [c for c in spec.header if c in TIMESTAMPS]
    bad = lambda columns: reduce(or_, [c.isNotNull() & ts_parse_failed(c) for c in columns], F.lit(False))
    whole = whole_of(answers)
    rest = answers if whole is None else whole.rest
    s = subjects.select(SUBJECT).distinct()
    marks = None
    if whole is not None:
        r = whole.documents.select(SUBJECT, (F.size(ROWS) > 0).alias("__any"), header_rows_of(spec.header).alias("__h"))
        value = lambda e: F.get(F.col(f"__h.{VALUE}"), F.array_position(F.col(f"__h.{ELEMENT}"), F.lit(e)).cast("int") - 1)
        marks = r.select(SUBJECT, F.when(F.col("__any"), True).alias("__any"),
                         F.when(F.size("__h") > 0, bad([value(c) for c in times])).alias("__bad"))
    if rest is not None:
        h = header_by_name(rest, spec.header)
        h = h.withColumn("__bad", bad([F.col(c) for c in times])).select(SUBJECT, "__bad")
        seen = rest.select(SUBJECT).distinct().withColumn("__any", F.lit(True)).join(h, SUBJECT, "left")
        marks = seen if marks is None else marks.unionByName(seen)
    s = s.join(marks, SUBJECT, "left")
    reason = (F.when(F.col("__any").isNull(), "no answers").when(F.col("__bad").isNull(), "missing header")
              .when(F.col("__bad"), "bad header time"))
    return s.select(SUBJECT, F.lit(spec.id).alias("dataset"), reason.alias("reason")).where("reason is not null")


def period_of(run_date: str) -> str:
    """SC-9 / X7: Period text 'YYYY-MM-01' of a run date (parity: the run month)."""
    return run_date[:7] + "-01"


__all__ = ["Block", "Vector", "Section", "SurveySpec", "run_spec", "period_of", "QA", "GRID"]


# --- SRC-8: job specs as JSON ---------------------------------------------------

def spec_to_dict(spec: SurveySpec) -> dict:
    from dataclasses import asdict

    return asdict(spec)


def spec_from_dict(d: dict) -> SurveySpec:
    """Inverse of ``spec_to_dict`` (lists from JSON become tuples again)."""
    def tup(x):
        return tuple(tup(i) for i in x) if isinstance(x, list) else x

    d = dict(d)
    d["blocks"] = tuple(Block(**{k: tup(v) for k, v in b.items()}) for b in d["blocks"])
    if d.get("vector"):
        d["vector"] = Vector(**{k: tup(v) for k, v in d["vector"].items()})
    if d.get("section"):
        d["section"] = Section(**d["section"])
    for k in ("header", "gps", "explode", "fill_first", "strip_paren", "sku_metric"):
        if d.get(k) is not None:
            d[k] = tup(d[k])
    return SurveySpec(**d)


def specs_to_json(specs) -> str:
    import json

    return json.dumps([spec_to_dict(s) for s in specs], ensure_ascii=False, indent=1)


def specs_from_json(text: str) -> tuple[SurveySpec, ...]:
    import json

    return tuple(spec_from_dict(d) for d in json.loads(text))
