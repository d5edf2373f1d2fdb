import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierlake.functions import casts as C


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_safe_number(spark):
    vals = [None, "", " 12 ", "1,000", "1e3", ".5", "abc", "300000054027794", "12d", "  "]
    got = one(spark, C.safe_number, vals)
    assert got == [None, None, Decimal("12"), None, Decimal("1000"), Decimal("0.5"), None,
                   Decimal("300000054027794"), None, None]
    assert one(spark, lambda c: C.safe_number(c, "bigint"), ["300000054027794"]) == [300000054027794]


def test_safe_timestamp_accepts(spark):
    vals = ["6/14/2025", "06/14/2025", "2025-06-14", "2025-06-14 12:30:44", "2025-06-14 12:30:44.123",
            "2025-06-14T12:30:44.123Z", "2025-06-14T12:30:44", " 2025-06-14  12:30:44 ", "2025-06-14T12:30:44ZZ",
            "2025-06-14 12:30:44.123456789"]
    got = one(spark, C.safe_timestamp, vals)
    d = dt.datetime
    assert got == [d(2025, 6, 14), d(2025, 6, 14), d(2025, 6, 14), d(2025, 6, 14, 12, 30, 44),
                   d(2025, 6, 14, 12, 30, 44, 123000), d(2025, 6, 14, 12, 30, 44, 123000),
                   d(2025, 6, 14, 12, 30, 44), d(2025, 6, 14, 12, 30, 44), d(2025, 6, 14, 12, 30, 44),
                   d(2025, 6, 14, 12, 30, 44, 123456)]


def test_safe_timestamp_rejects(spark):
    vals = ["2025-06-14T12:30:44+00:00", "2/30/2025", "14/6/2025", "2025/06/14", "x", "", None,
            "2025-06-14 12:30:44.1234567890", "2025-13-01"]
    assert one(spark, C.safe_timestamp, vals) == [None] * len(vals)


def test_strict_iso_and_strip_offset(spark):
    got = one(spark, lambda c: F.unix_micros(C.strict_iso_timestamp(c)),
              ["2026-03-09T18:31:43.123+00:00", "2026-03-09T18:31:43-05:00", "2026-03-09T18:31:43.123456+05:30"])
    base = dt.datetime(2026, 3, 9, 18, 31, 43, tzinfo=dt.timezone.utc)
    exp = [base + dt.timedelta(milliseconds=123), base + dt.timedelta(hours=5),
           base + dt.timedelta(microseconds=123456) - dt.timedelta(hours=5, minutes=30)]
    assert got == [int(e.timestamp() * 1_000_000) for e in exp]
    wall = one(spark, C.strip_offset, ["2026-03-09T18:31:43-05:00"])
    assert wall == [dt.datetime(2026, 3, 9, 18, 31, 43)]


def test_strict_iso_raises(spark):
    import pytest
    with pytest.raises(Exception):
        one(spark, C.strict_iso_timestamp, ["bad"])


def test_digits_only(spark):
    assert one(spark, C.digits_only, [" 42 ", "4.2", "-1", None]) == [Decimal(42), None, None, None]


def test_file_timestamp(spark):
    got = one(spark, C.file_timestamp, ["x-20260309_183143.zip", "y-20260309_183143.ZIP", "x.zip"])
    assert got == [dt.datetime(2026, 3, 9, 18, 31, 43)] * 2 + [None]


def test_lpad_and_segment_string(spark):
    assert one(spark, lambda c: C.lpad_trunc(c, 3), ["7", "123", "12345", "", None]) == ["007", "123", "123", None, None]
    df = spark.createDataFrame([("1", "22", None, "", "123456")], "a string, b string, c string, d string, e string")
    got = df.select(C.segment_string(["a", "b", "c", "d", "e"], [4, 3, 4, 3, 3])).first()[0]
    assert got == "0001-022---123"
    allnull = spark.createDataFrame([(None,) * 9], ",".join(f"s{i} string" for i in range(9)))
    assert allnull.select(C.segment_string([f"s{i}" for i in range(9)], [4, 3, 4, 3, 3, 7, 4, 4, 5])).first()[0] \
        == "--------"


def test_pacific_window_dst(spark):
    df = spark.createDataFrame([("2026-03-08 18:00:00",), ("2026-11-01 18:00:00",), ("2024-01-20 03:00:00",)], "n string")
    out = df.select(*C.pacific_day_window(F.col("n").cast("timestamp_ntz"))).collect()
    assert [tuple(r) for r in out] == [
        (dt.datetime(2026, 3, 8, 8), dt.datetime(2026, 3, 9, 8)),
        (dt.datetime(2026, 11, 1, 7), dt.datetime(2026, 11, 2, 7)),
        (dt.datetime(2024, 1, 19, 8), dt.datetime(2024, 1, 20, 8)),
    ]


def test_misc_helpers(spark):
    assert one(spark, lambda c: C.report_path(c, "/Custom/Reports"), ["Rep", "a/b.XDO", " x.xdo "]) == \
        ["/Custom/Reports/Rep.xdo", "a/b.XDO", "/Custom/Reports/x.xdo"]
    assert one(spark, C.report_label, ["GALLUP", "USER_ROLES", "DFF"]) == \
        ["Gallup Assessments", "User Roles", "DFF Configuration"]
    assert one(spark, C.url_tail_id, ["https://h/items/42", "https://h/items/x"]) == [42, None]
    df = spark.createDataFrame([(200, "a"), (406, "b"), (500, "c"), (299, "d")], "s int, b string")
    assert [r[0] for r in df.select(C.http_body("s", "b")).collect()] == ["a", "b", None, "d"]
    df = spark.createDataFrame([(5, "1,5,15"), (1, "15,51"), (None, "1")], "i int, l string")
    assert [r[0] for r in df.select(C.id_in_list("i", "l")).collect()] == [True, False, None]
    df = spark.createDataFrame([(-5, 100), (3, 0), (1, 3)], "d bigint, n bigint")
    assert [float(r[0]) for r in df.select(C.pct_delta("d", "n")).collect()] == [5.0, 0.0, 33.33]


def test_strict_iso_blank_before_zone(spark):
    got = one(spark, lambda c: F.unix_micros(C.strict_iso_timestamp(c, C.ISO_OFFSET_BLANK_FORMAT)),
              ["2026-03-09T18:31:43.5 -05:00"])
    exp = dt.datetime(2026, 3, 9, 23, 31, 43, 500000, tzinfo=dt.timezone.utc)
    assert got == [int(exp.timestamp() * 1_000_000)]
