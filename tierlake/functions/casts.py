"""Tolerant casts and small scalar helpers, all as native Column expressions.

Nothing here runs Python per row: every function returns a Catalyst
expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values that must equal the source system's behaviour.
# Accepted text forms of the tolerant timestamp cast, in the order they are tried:
#   M/D/YYYY                      ^\d{1,2}/\d{1,2}/\d{4}$
#   YYYY-MM-DD                    ^\d{4}-\d{2}-\d{2}$
#   YYYY-MM-DD HH:MI:SS[.f]       ^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}(\.\d+)?$
#   the same with 'T' for the blank and optional trailing 'Z's
RE_US_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"
# File names carry their extract time as -YYYYMMDD_HHMMSS.zip (any case).
RE_FILE_TS = r"(?i)-(\d{8}_\d{6})\.zip"
# Default numeric staging type: unconstrained NUMBER.
NUMBER = "decimal(38,10)"
# Offset (e.g. +05:30, -00:00) at the end of an ISO text.
RE_TRAILING_OFFSET = r"[+-]\d{2}:\d{2}$"
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX"
ISO_OFFSET_BLANK_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS] XXX"    # a blank before the zone
ISO_LOCAL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]"
# Watermark text sent to REST filters.
WATERMARK_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'.000Z'"
PACIFIC = "America/Los_Angeles"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: ColumnOrName) -> Column:
    """'' -> NULL (the source system has no empty strings)."""
    c = _c(c)
    return F.when(c != F.lit(""), c)


def blank_to_null(c: ColumnOrName) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def safe_number(c: ColumnOrName, dtype: str = NUMBER) -> Column:
    """NULL for NULL/blank/unparseable text, else the trimmed number.

    Parses as decimal(38,10) first (so '1e3' and '.5' work, '1,000' does
    not), then casts to the staging type.  A value that does not fit the
    staging type raises, as an insert into a NUMBER(p,s) column would.
    """
    n = F.trim(_c(c)).try_cast(NUMBER)
    return n if dtype == NUMBER else n.cast(dtype)


def safe_timestamp(c: ColumnOrName) -> Column:
    """Tolerant text -> timestamp_ntz; anything outside the four forms is NULL.

    An offset such as ``+00:00`` makes the value NULL; a trailing ``Z`` is
    dropped, not converted.  Invalid calendar dates are NULL.  Fractions
    longer than microseconds are truncated; more than nine digits is NULL.

    Evaluation is kept cheap (this runs on every staged timestamp value):
    the ``T`` form is normalised with literal replaces, both ISO forms are
    validated by one pattern, and ``M/D/YYYY`` is split rather than matched
    group by group.  A text containing ``T`` can never satisfy the other
    forms, so checking the normalised text is equivalent to trying the four
    forms in order.
    """
    v = F.trim(_c(c))
    has_t = F.instr(v, "T") > 0
    t = F.when(has_t, F.regexp_replace(F.replace(v, F.lit("T"), F.lit(" ")), "Z+$", "")).otherwise(v)
    iso = t.rlike(RE_ISO_ANY)
    parts = F.split(v, "/")
    us_iso = F.concat(parts.getItem(2), F.lit("-"), parts.getItem(0), F.lit("-"), parts.getItem(1))
    return (F.when(iso, F.regexp_replace(t, r"\s+", " ").try_cast("timestamp_ntz"))
            .when(~has_t & v.rlike(RE_US_DATE), us_iso.try_cast("timestamp_ntz")))


# Both ISO forms at once: date, optionally followed by a time with at most
# nine fraction digits (the source accepts up to nine).
RE_ISO_ANY = r"^\d{4}-\d{2}-\d{2}(\s+\d{2}:\d{2}:\d{2}(\.\d{1,9})?)?$"


def strict_iso_timestamp(c: ColumnOrName, fmt: str = ISO_OFFSET_FORMAT) -> Column:
    """ISO text with an offset -> instant; malformed text raises (ANSI)."""
    return F.to_timestamp(_c(c), fmt)


def strip_offset(c: ColumnOrName, fmt: str = ISO_LOCAL_FORMAT) -> Column:
    """Keep the local wall clock of an ISO text with offset (timestamp_ntz)."""
    return F.to_timestamp_ntz(F.regexp_replace(_c(c), RE_TRAILING_OFFSET, ""), F.lit(fmt))


def digits_only(c: ColumnOrName, dtype: str = "decimal(38,0)") -> Column:
    """``^\\d+$`` on the trimmed text -> number, anything else NULL."""
    v = F.trim(_c(c))
    return F.when(v.rlike(r"^\d+$"), v.cast(dtype))


def lpad_trunc(c: ColumnOrName, width: int, pad: str = "0") -> Column:
    """Left-pad to ``width`` and cut longer values to ``width``; ''/NULL stay NULL."""
    return F.lpad(empty_to_null(c), width, pad)


def segment_string(cols: Sequence[ColumnOrName], widths: Sequence[int] | None = None,
                   sep: str = "-") -> Column:
    """Join segments with ``sep``; a NULL segment contributes '' (never NULL)."""
    parts = []
    for i, c in enumerate(cols):
        p = lpad_trunc(c, widths[i]) if widths else _c(c)
        parts.append(F.coalesce(p, F.lit("")))
    return F.concat_ws(sep, *parts)


def file_timestamp(name: ColumnOrName) -> Column:
    """Extract time from ``…-YYYYMMDD_HHMMSS.zip`` (any case), else NULL."""
    txt = F.regexp_extract(_c(name), RE_FILE_TS, 1)
    return F.when(txt != "", F.to_timestamp_ntz(txt, F.lit("yyyyMMdd_HHmmss")))


def last_path_segment(path: ColumnOrName) -> Column:
    return F.regexp_extract(_c(path), r"[^/]+$", 0)


def url_tail_id(url: ColumnOrName) -> Column:
    """Numeric id at the end of a URL (``…/items/42`` -> 42)."""
    return F.substring_index(_c(url), "/", -1).try_cast("bigint")


def pacific_day_window(now: ColumnOrName) -> tuple[Column, Column]:
    """Today in Pacific time as a UTC window ``[start, start + 24h)``.

    The end is always 24 hours after the start, also on DST change days.
    ``now`` is a UTC wall clock (timestamp_ntz or timestamp).
    """
    n = _c(now).cast("timestamp_ntz")
    # wall-clock conversions between zones: independent of the session time zone
    local = F.convert_timezone(F.lit("UTC"), F.lit(PACIFIC), n)
    midnight = F.date_trunc("day", local).cast("timestamp_ntz")
    start = F.convert_timezone(F.lit(PACIFIC), F.lit("UTC"), midnight)
    return start, start + F.expr("INTERVAL 24 HOURS")


def watermark_text(ts: ColumnOrName, overlap_days: int = 2) -> Column:
    """ISO text of ``ts - overlap`` as used in REST filters (…T…'.000Z')."""
    return F.date_format(_c(ts) - F.expr(f"INTERVAL {int(overlap_days)} DAYS"),
                         WATERMARK_TEXT_FORMAT)


def pct_delta(delta: ColumnOrName, base: ColumnOrName) -> Column:
    """``round(abs(delta) / base * 100, 2)``, 0 when base is not > 0."""
    d, b = _c(delta).cast("decimal(38,0)"), _c(base).cast("decimal(38,0)")
    return F.when(b > 0, F.round(F.abs(d) / b * 100, 2)).otherwise(F.lit(0)) \
        .cast("decimal(38,2)")


def elapsed_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Exact elapsed seconds (1 decimal); NULL while running."""
    return F.round(F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000), 1)


def elapsed_seconds_mod_hour(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Parity form of the load report: SECOND + MINUTE*60 (drops hours/days)."""
    secs = F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1_000_000)
    return F.round(F.pmod(secs, F.lit(3600)), 1)


def report_path(name: ColumnOrName, folder: str) -> Column:
    """Append ``.xdo`` if absent (any case); prefix ``folder`` when there is no '/'."""
    v = F.trim(_c(name))
    with_ext = F.when(F.lower(v).endswith(".xdo"), v).otherwise(F.concat(v, F.lit(".xdo")))
    return F.when(F.instr(v, "/") > 0, with_ext).otherwise(F.concat(F.lit(folder + "/"), with_ext))


# Fixed labels of the load report.
REPORT_LABELS = {
    "GALLUP": "Gallup Assessments",
    "QUESTIONNAIRES": "Questionnaires",
    "DFF": "DFF Configuration",
    "EXT_FLEX": "Extensible Flex",
}


def report_label(key: ColumnOrName) -> Column:
    k = _c(key)
    out = F.initcap(F.regexp_replace(k, "_", " "))
    for code, label in reversed(list(REPORT_LABELS.items())):
        out = F.when(k == code, F.lit(label)).otherwise(out)
    return out


def http_body(status: ColumnOrName, body: ColumnOrName) -> Column:
    """Body for 2xx or 406 responses, else NULL."""
    s = _c(status)
    return F.when(s.between(200, 299) | (s == 406), _c(body))


def json_object(*cols: ColumnOrName) -> Column:
    """JSON object of the columns; NULL fields are left out."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def truncate(c: ColumnOrName, n: int) -> Column:
    return F.substring(_c(c), 1, n)


def id_in_list(id_col: ColumnOrName, id_list: ColumnOrName, sep: str = ",") -> Column:
    """Whole-token membership of ``id`` in a separated id list."""
    return F.array_contains(F.split(_c(id_list), sep), _c(id_col).cast("string"))


def optional_eq(c: ColumnOrName, value) -> Column:
    """``col = nvl(:p, col)``: with no value every non-NULL row passes (NULL rows drop)."""
    col = _c(c)
    v = value if isinstance(value, Column) else F.lit(value)
    return col == F.coalesce(v, col)
