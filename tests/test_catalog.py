import datetime as dt

from pyspark.sql import functions as F

from tierlake.operators import incremental as I
from tierlake.operators.routing import route_by_pattern
from tierlake.session import local_rows
from tierlake.sources import catalog as CAT

MAP = [(1, 10, "%employee%", "HCM_EMPLOYEE", "Y", "Y"),
       (2, 10, "%emp%", "OTHER", "Y", "Y"),          # same priority: lower map_id wins
       (3, 5, "%retired%", "OLD", "N", "Y"),          # inactive
       (4, 20, "file\\_po%", "PO_HDR", "Y", "N"),
       (5, 30, "%line_", "PO_LINES", "Y", "Y")]
MAP_SCHEMA = "map_id int, priority int, file_like string, load_type string, is_active string, loader_available string"


def test_route_ties_wildcards_unmapped(spark):
    lm = local_rows(spark, MAP, MAP_SCHEMA)
    names = spark.createDataFrame([("file_employee-retired.zip",), ("file_pox.zip",), ("zzz.zip",),
                                   ("ab_lines",), ("file_emp.zip",)], "file_name string")
    got = {r.file_name: r.load_type for r in route_by_pattern(names, "file_name", lm).collect()}
    assert got == {"file_employee-retired.zip": "HCM_EMPLOYEE", "file_pox.zip": "PO_HDR", "zzz.zip": "UNMAPPED",
                   "ab_lines": "PO_LINES", "file_emp.zip": "OTHER"}


def brute_route(name, patterns):
    import re
    best = None
    for m, p, like, load, active, _ in patterns:
        if name is None or active != "Y" or load is None or like is None:
            continue
        at, rx = 0, ""
        while at < len(like):
            if like[at] == "\\":
                at, rx = at + 2, rx + re.escape(like[at + 1].lower())
            else:
                at, rx = at + 1, rx + {"%": ".*", "_": "."}.get(like[at], re.escape(like[at].lower()))
        if re.fullmatch(rx, name.lower(), re.S) and (best is None or (p, m) < best[:2]):
            best = (p, m, load)
    return best[2] if best else "UNMAPPED"


def test_route_against_every_pattern(spark):
    import random
    r = random.Random(3)
    parts = ["a", "B", "ab", "extract", "po_line", "é", "%", "_", "__", "\\_", "\\%", "-1", ".zip", "2026"]
    patterns = [(k, r.randint(1, 9), "".join(r.choice(parts) for _ in range(r.randint(1, 4))), f"T{k}" if k % 11 else None, "Y" if k % 7 else "N", "Y") for k in range(300)]
    patterns += [(900, 9, "%", "ALL", "Y", "Y"), (901, 8, "____", "FOUR", "Y", "N"), (902, 8, "__%", "TWO", "Y", "N"), (903, 7, None, "X", "Y", "Y"), (904, 10, "", "NOTHING", "Y", "Y")]
    names = ["".join(r.choice(["a", "b", "Extract", "PO_LINE", "é", "-1", ".zip", "2026", "x"]) for _ in range(r.randint(0, 5))) for _ in range(250)] + [None, "", "a%", "a_b"]
    for lm in (patterns, [p for p in patterns if p[0] < 900], []):
        df = spark.createDataFrame([(n,) for n in names], "file_name string")
        got = route_by_pattern(df, "file_name", spark.createDataFrame(lm, MAP_SCHEMA)).collect()
        assert sorted(((x[0], x[1]) for x in got), key=str) == sorted(((n, brute_route(n, lm)) for n in names), key=str)


def test_route_three_hundred_thousand_patterns(spark):
    n = 300_000
    lm = spark.range(n).selectExpr("cast(id as int) map_id", "cast(id % 100 as int) priority",
                                   "concat('%extract-', lpad(id, 6, '0'), '%') file_like", "concat('T', id) load_type",
                                   "'Y' is_active", "'Y' loader_available")
    names = spark.range(0, 2 * n, 1000).selectExpr("concat('file_extract-', lpad(id, 6, '0'), '-b1.zip') file_name", "id")
    got = {x["id"]: x["load_type"] for x in route_by_pattern(names, "file_name", lm).collect()}
    assert got == {k: f"T{k}" if k < n else "UNMAPPED" for k in range(0, 2 * n, 1000)}


def test_availability_is_that_of_the_matched_entry(spark):
    lm = local_rows(spark, [(1, 1, "%po_a%", "PO", "Y", "N"), (2, 2, "%po%", "PO", "Y", "Y")], MAP_SCHEMA)
    listing = spark.createDataFrame([("x/po_a.zip",), ("x/po_b.zip",), ("x/q.zip",)], "path string")
    assert {x.file_name: x.loader_available for x in CAT.catalog_view(listing, lm).collect()} == {"po_a.zip": "N", "po_b.zip": "Y", "q.zip": "N"}


def test_catalog_refresh_keeps_timestamp(spark):
    lm = local_rows(spark, MAP, MAP_SCHEMA)
    listing = spark.createDataFrame([("s3://b/x/file_employee-b1-20260309_183143.zip",), ("s3://b/x/readme.txt",),
                                     ("s3://b/x/file_po-b2-20260310_010000.ZIP",)], "path string")
    view = CAT.catalog_view(listing, lm)
    got = {r.file_name: (r.load_type, r.loader_available, r.file_timestamp) for r in view.collect()}
    assert got == {"file_employee-b1-20260309_183143.zip": ("HCM_EMPLOYEE", "Y", dt.datetime(2026, 3, 9, 18, 31, 43)),
                   "file_po-b2-20260310_010000.ZIP": ("PO_HDR", "N", dt.datetime(2026, 3, 10, 1, 0))}
    old = spark.createDataFrame([("file_employee-b1-20260309_183143.zip", "UNMAPPED", "N", dt.datetime(2020, 1, 1),
                                  dt.datetime(2020, 1, 1)),
                                 ("gone.zip", "PO_HDR", "Y", None, dt.datetime(2020, 1, 1))], CAT.CATALOG_SCHEMA)
    new = {r.file_name: r for r in CAT.refresh(old, view, F.lit(dt.datetime(2026, 3, 11))).collect()}
    assert new["file_employee-b1-20260309_183143.zip"].load_type == "HCM_EMPLOYEE"
    assert new["file_employee-b1-20260309_183143.zip"].file_timestamp == dt.datetime(2020, 1, 1)
    assert new["gone.zip"].refreshed_ts == dt.datetime(2020, 1, 1)
    assert new["file_po-b2-20260310_010000.ZIP"].refreshed_ts == dt.datetime(2026, 3, 11)


def test_select_unprocessed_latest(spark):
    files = spark.createDataFrame([
        ("f_emp_1.zip", "HCM_EMPLOYEE", "Y", dt.datetime(2026, 3, 8, 9)),     # in window, older
        ("f_emp_2.zip", "HCM_EMPLOYEE", "Y", dt.datetime(2026, 3, 8, 10)),    # latest, ERROR job -> retry
        ("f_po_1.zip", "PO_HDR", "Y", dt.datetime(2026, 3, 8, 11)),           # latest, MERGED -> nothing today
        ("f_po_0.zip", "PO_HDR", "Y", dt.datetime(2026, 3, 8, 9)),
        ("f_x_suppliersiteextract.zip", "SUPPLIER_HDR", "Y", dt.datetime(2026, 3, 8, 9)),   # excluded
        ("f_sal_old.zip", "HCM_SALARY", "Y", dt.datetime(2026, 3, 6, 9)),     # before window
        ("f_sal_n.zip", "HCM_SALARY", "N", dt.datetime(2026, 3, 8, 9)),       # no loader
        ("f_pos.zip", "HCM_POSITION", "Y", dt.datetime(2026, 3, 7, 8)),       # look-back day edge (in)
        ("f_pos2.zip", "HCM_POSITION", "Y", dt.datetime(2026, 3, 7, 7, 59)),
        ("f_gl.zip", "GL_BALANCE", "Y", dt.datetime(2026, 3, 9, 8)),          # window end is exclusive
    ], "file_name string, load_type string, loader_available string, file_timestamp timestamp_ntz")
    jobs = spark.createDataFrame([("f_emp_2.zip", "HCM_EMPLOYEE", "ERROR"), ("f_po_1.zip", "PO_HDR", "MERGED")],
                                 "file_name string, load_type string, status string")
    now = F.lit(dt.datetime(2026, 3, 8, 18)).cast("timestamp_ntz")
    got = sorted(r.file_name for r in I.select_unprocessed_latest(files, jobs, now).collect())
    assert got == ["f_emp_2.zip", "f_pos.zip"]


def test_retention_and_purge(spark):
    objs = spark.createDataFrame([("a-20260101_000000.zip",), ("b-20260301_000000.zip",), ("c.zip",),
                                  ("file_x.zip",), ("staging/x.csv",), ("EXTRACT_STATUS_DATA_1",),
                                  ("MANIFEST.MF",), ("y_unzipped.csv",), ("fileAx.zip",), ("keep.txt",)], "n string")
    old = I.retention_candidates(objs, "n", F.lit(dt.datetime(2026, 3, 15)))
    assert [r.n for r in old.collect()] == ["a-20260101_000000.zip"]
    purge = sorted(r.n for r in I.purge_candidates(objs, "n").collect())
    assert purge == ["EXTRACT_STATUS_DATA_1", "MANIFEST.MF", "file_x.zip", "staging/x.csv", "y_unzipped.csv"]


def test_watermark_and_modes(spark):
    tgt = spark.createDataFrame([(dt.datetime(2026, 3, 9, 18, 31, 43),)], "ts timestamp_ntz")
    wm = I.high_watermark(tgt, "ts").first()
    assert wm.watermark == dt.datetime(2026, 3, 7, 18, 31, 43)
    assert wm.watermark_text == "2026-03-07T18:31:43.000Z"
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    src = spark.createDataFrame([(dt.datetime(2026, 3, 1),), (dt.datetime(2026, 3, 8),)], "ts timestamp_ntz")
    assert I.since_watermark(src, tgt, "ts").count() == 1
    assert I.since_watermark(src, empty, "ts").count() == 2
    assert I.sync_mode("FULL_ONLY", "X") == ("FULL", None)
    assert I.sync_mode("CODE_BASED", None) == ("INCREMENTAL", "LastUpdateDate")


def test_delete_objects_dry_run_and_execute(spark, tmp_path):
    for n in ("a-20200101_000000.zip", "b-20260301_000000.zip", "keep.zip"):
        (tmp_path / n).write_text("x")
    from tierlake.sources.zipped import list_zips
    listing = list_zips(spark, str(tmp_path)).select("path", "file_name")
    old = I.retention_candidates(listing, "file_name", F.lit(dt.datetime(2026, 3, 15)))
    plan = I.delete_objects(old).collect()
    assert [r.result for r in plan] == ["PLANNED"] and (tmp_path / "a-20200101_000000.zip").exists()
    done = I.delete_objects(old, execute=True).collect()
    assert [r.result for r in done] == ["DELETED"]
    assert not (tmp_path / "a-20200101_000000.zip").exists() and (tmp_path / "keep.zip").exists()


def test_orphan_audit_counts_and_sample(spark):
    from tierlake.operators.audit import orphan_audit, orphan_sample
    child = spark.createDataFrame([(1,), (2,), (2,), (9,), (8,), (None,)], "p int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    res = orphan_audit([("c->p", child, parent, ["p"], ["id"])]).first()
    assert (res.child_rows, res.orphan_rows) == (6, 2)
    assert [r.p for r in orphan_sample(child, parent, ["p"], ["id"], n=1).collect()] == [8]
