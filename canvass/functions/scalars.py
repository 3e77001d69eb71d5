"""Scalar column functions (SC-1 .. SC-10). All are built-in Spark expressions,
so they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters that a strip removes (all Unicode white space)
WHITESPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
              "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(c) -> Column:
    """White space of any kind removed from both ends (``trim`` removes blanks only)."""
    return F.btrim(_c(c), F.lit(WHITESPACE))


# --- SC-1 / SC-2 / SC-3: survey timestamps -------------------------------------
# The interview time format is "YYYY-MM-DDTHH:MM:SSZ"; parsing
# deletes every "T" and "Z" and reads "%Y-%m-%d%H:%M:%S".
TS_STRIP = "T|Z"
TS_FORMAT = "yyyy-MM-ddHH:mm:ss"


def parse_survey_ts(c) -> Column:
    """SC-1: strict parse; NULL when the text does not fit (sent to rejects)."""
    return F.try_to_timestamp(F.regexp_replace(_c(c), TS_STRIP, ""), F.lit(TS_FORMAT))


def parse_optional_ts(c) -> Column:
    """SC-2: blank or null text is a legal null (VisitEnd)."""
    x = _c(c)
    return F.when(strip(x) == "", F.lit(None).cast("timestamp")).otherwise(parse_survey_ts(x))


def ts_parse_failed(c, optional: bool = False) -> Column:
    """True when a present value failed to parse (QUA-1 reason)."""
    x = _c(c)
    present = x.isNotNull() & (strip(x) != "") if optional else F.lit(True)
    return present & parse_survey_ts(x).isNull()


def tolerant_ts(c) -> Column:
    """SC-3: parsed timestamp or, on failure, the original text (as a struct pair)."""
    x = _c(c)
    return F.struct(parse_survey_ts(x).alias("ts"),
                    F.when(parse_survey_ts(x).isNull(), x).alias("raw"))


# --- SC-4: GPS text -------------------------------------------------------------
GPS_COLUMNS = ["GPS_Latitude", "GPS_Longitude", "GPS_Date", "GPS_Altitude", "GPS_Bearing",
               "GPS_Speed (km/h)"]

# The three GPS text layouts read by the surveys.
GPS_DMS_PATTERN = (r"Latitude:\s*(.*?)\s*\(.*?\)\r?\n"
                   r"\s*Longitude:\s*(.*?)\s*\(.*?\)\r?\n"
                   r"\s*Captured at:\s*(.*?)\r?\n"
                   r"(?:\s*Altitude:\s*(.*?)\r?\n)?"
                   r"(?:\s*Bearing:\s*(.*?)\r?\n)?"
                   r"(?:\s*Speed:\s*(.*?)(?:\s*km/h)?\s*)?")
GPS_DECIMAL_PATTERN = (r"Latitude:\s*.*?\(([-+]?\d+(?:\.\d+)?)\)\r?\n"
                       r"\s*Longitude:\s*.*?\(([-+]?\d+(?:\.\d+)?)\)\r?\n"
                       r"\s*Captured at:\s*(.*?)\r?\n"
                       r"(?:\s*Altitude:\s*(.*?)\r?\n)?"
                       r"(?:\s*Bearing:\s*(.*?)\r?\n)?"
                       r"(?:\s*Speed:\s*(.*?)(?:\s*km/h)?\s*)?")
GPS_STRICT_PATTERN = (r"Latitude:\s*(.*?)\s*\(.*?\)\n\s*Longitude:\s*(.*?)\s*\(.*?\)\n"
                      r"\s*Captured at:\s*(.*?)\n\s*Altitude:\s*(.*?)\n\s*Bearing:\s*(.*?)\s*\n"
                      r"\s*Speed:\s*(.*?)\s*km/h")
# Our fix of the DMS layout: the speed group is anchored, so it is captured.
GPS_DMS_FIXED_PATTERN = GPS_DMS_PATTERN.replace(
    r"(?:\s*Speed:\s*(.*?)(?:\s*km/h)?\s*)?", r"(?:\s*Speed:\s*([^\r\n]*?)\s*(?:km/h)?\s*$)?")

GPS_PATTERNS = {"dms": GPS_DMS_PATTERN, "dms_fixed": GPS_DMS_FIXED_PATTERN,
                "decimal": GPS_DECIMAL_PATTERN, "strict": GPS_STRICT_PATTERN}


def gps_columns(c, variant: str = "dms_fixed") -> list[Column]:
    """Six GPS parts. A whole-pattern miss gives NULL in every part; an optional
    part that is absent gives NULL; a present but empty part gives ''."""
    pattern = GPS_PATTERNS[variant]
    x = _c(c)
    matched = x.rlike(pattern)
    out = []
    for i, name in enumerate(GPS_COLUMNS, start=1):
        part = F.regexp_extract(x, pattern, i)
        # optional parts: regexp_extract gives '' for a group that did not take part
        if variant != "strict" and i >= 4:
            label = ["Altitude:", "Bearing:", "Speed:"][i - 4]
            part = F.when(F.regexp_extract(x, pattern, 0).contains(label), part)
        out.append(F.when(matched, part).alias(name))
    if variant == "decimal":
        out[0] = out[0].cast("double").alias(GPS_COLUMNS[0])
        out[1] = out[1].cast("double").alias(GPS_COLUMNS[1])
    return out


# --- SC-5 .. SC-9 -----------------------------------------------------------------
# Loop prefix of repeated blocks, and the parenthetical pattern.
LOOP_PREFIX = r"I_\d+_"
LOOP_INDEX = r"I_(\d+)_"
PARENTHETICAL = r"\(.*\)"


def strip_loop_prefix(c) -> Column:
    """SC-5: remove every ``I_<n>_`` (item 1..n then share one name). Values
    without ``I_`` (most answers) skip the regex engine."""
    x = _c(c)
    return F.when(x.contains("I_"), F.regexp_replace(x, LOOP_PREFIX, "")).otherwise(x)


def loop_index(c) -> Column:
    """The number of the first ``I_<n>_`` prefix, NULL when none."""
    s = F.regexp_extract(_c(c), LOOP_INDEX, 1)
    return F.when(s != "", s.cast("long"))


def strip_parenthetical(c) -> Column:
    """SC-6: greedy, first '(' to last ')'."""
    return F.regexp_replace(_c(c), PARENTHETICAL, "")


def split_trim_join(c, sep: str = ",", joiner: str = ", ") -> Column:
    """SC-7: split on a literal separator, trim, drop blanks, join."""
    return F.array_join(option_list(c, sep), joiner)


def option_list(c, sep: str = ",") -> Column:
    """Options of a multi-select cell: split on the literal ``sep``, strip
    whitespace, drop blank options. Built from codegen'd built-ins only (no
    lambda over the array): whitespace around separators is consumed by the
    split pattern, the ends by one regex, blanks by ``array_remove``."""
    body = F.regexp_replace(_c(c), r"^\s+|\s+$", "")
    parts = F.split(body, r"\s*" + _regex_literal(sep) + r"\s*")
    return F.array_remove(parts, "")


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in sep)


def normalise_name(c, limit: int = 64) -> Column:
    """SC-8: lower case, ' ' '/' '-' to '_', cut to ``limit`` characters."""
    return F.substring(F.translate(F.lower(_c(c)), " /-", "___"), 1, limit)


def month_start_text(c) -> Column:
    """SC-9: 'YYYY-MM-01' of a date/timestamp."""
    return F.date_format(F.trunc(_c(c), "MM"), "yyyy-MM-dd")


def to_decimal(c, precision: int = 10, scale: int = 2) -> Column:
    """SC-10: load-time numeric cast; bad text gives NULL (counted by QUA)."""
    return strip(c).try_cast(f"decimal({precision},{scale})")


def to_int(c) -> Column:
    return strip(c).try_cast("int")


def contains_comma(c) -> Column:
    """FIL-8: contains ',', NULL gives false."""
    return F.coalesce(_c(c).contains(","), F.lit(False))


def duration_seconds(start, end) -> Column:
    """SC-11 extra: VisitEnd - VisitStart in seconds (the text duration is
    kept as it is)."""
    return F.unix_timestamp(_c(end).cast("timestamp")) - F.unix_timestamp(_c(start).cast("timestamp"))
