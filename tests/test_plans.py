import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tierlake.plans import entity_flow as EF
from tierlake.plans import rest_datasets as RD
from tierlake.plans import specs as S
from tierlake.plans.flex import DECODE_VIEWS, decode_view
from tierlake.plans.reports import GALLUP, ReportSpec, load_report
from tierlake.plans.specs import Col
from tierlake.sources.json_pages import read_pages
from tierlake.sources.store import SnapshotTable
from tierlake.sources.xml_rowset import EmptySourceError


def req(i, title, dff=None, pubs=None, **kw):
    d = {"RequisitionId": i, "Title": title, "LastUpdateDate": "2026-03-09T18:31:43.123+00:00", **kw}
    if dff is not None:
        d["requisitionDFF"] = dff
    if pubs is not None:
        d["publishedJobs"] = pubs
    return d


def test_requisition_pages(spark, tmp_path):
    p1 = {"items": [
        req(1, "A", dff=[{"transferCoordinatedWithReceivi": "Y", "__FLEX_Context": "X"}],
            pubs=[{"Visibility": "EXTERNAL", "PostingStatus": "POSTED", "StartDate": "2026-03-01T00:00:00-05:00"},
                  {"Visibility": "INTERNAL", "PostingStatus": "DRAFT"}]),
        req(None, "no id"),
        req(2, "B", dff=[], pubs=[])], "hasMore": True}
    p2 = {"items": [
        req(1, "A2", dff=[{"transferCoordinatedWithReceivi": None, "__FLEX_Context": "Y"}],
            pubs=[{"Visibility": "EXTERNAL", "PostingStatus": "EXPIRED"},
                  {"Visibility": "EXTERNAL", "PostingStatus": "REPOSTED"}]),
        req(3, "C", dff=None)]}
    for n, p in (("requisitions_p1.json", p1), ("requisitions_p2.json", p2)):
        (tmp_path / n).write_text(json.dumps(p))
    pages = read_pages(spark, str(tmp_path / "requisitions_p*.json"), RD.requisition_item_schema())
    out = RD.sync_requisitions(pages, sync_ts=dt.datetime(2026, 3, 10))
    reqs = {r.requisitionid: r for r in out["job_requisitions_r"].collect()}
    assert set(reqs) == {1, 2, 3} and reqs[1].title == "A2" and reqs[1].resource_key == "1"
    assert reqs[1].lastupdatedate == dt.datetime(2026, 3, 9, 18, 31, 43, 123000)
    dff = {r.requisition_id: (r.transfer_coordinated, r.flex_context) for r in out["req_dff_r"].collect()}
    assert dff == {1: ("Y", "Y"), 2: (None, None), 3: (None, None)}
    pub = {(r.requisition_id, r.published_visibility): r.published_posting_status
           for r in out["req_published_jobs_r"].collect()}
    assert pub == {(1, "EXTERNAL"): "REPOSTED", (1, "INTERNAL"): "DRAFT"}
    # second sync over an existing table: DFF NULLs never erase stored values
    again = RD.sync_requisitions(pages, finals=out, sync_ts=dt.datetime(2026, 3, 11))
    assert again["req_dff_r"].count() == 3 and again["job_requisitions_r"].count() == 3


GALLUP_XML = """<DATA_DS><ROW><SUBMISSION_ID>7</SUBMISSION_ID><BAND>A</BAND><SCORE>9.5</SCORE></ROW>
<G><ROW><SUBMISSION_ID>7</SUBMISSION_ID><BAND>B</BAND></ROW></G>
<ROW><SUBMISSION_ID>8</SUBMISSION_ID><BAND></BAND><SCORE> </SCORE></ROW></DATA_DS>"""


def test_report_first_per_key_and_policies(spark, tmp_path):
    (tmp_path / "g.xml").write_text(GALLUP_XML)
    schema = "submission_id bigint, package_status_code string, band string, score decimal(10,2), " \
             "requisition_id bigint, requisition_title string, person_id bigint, candidate_name string, " \
             "gallup_result_url string"
    from pyspark.sql.types import StructType
    target = SnapshotTable(spark, str(tmp_path / "gallup"), StructType.fromDDL(schema))
    assert load_report(spark, str(tmp_path / "g.xml"), GALLUP, target) == 3
    got = {r.submission_id: (r.band, r.score) for r in target.read().collect()}
    assert got[7][0] == "A" and got[8] == (None, None)
    (tmp_path / "x.xml").write_text(GALLUP_XML.replace("<SCORE> </SCORE>", "<SCORE>x</SCORE>"))
    with pytest.raises(Exception, match="score: not a number: x"):      # a number element that is none fails the load
        load_report(spark, str(tmp_path / "x.xml"), GALLUP, target)
    assert target.read().count() == 2
    strict = ReportSpec("DFF", (Col("k", "SUBMISSION_ID"), Col("band", "BAND")), ("k",), "strict")
    t2 = SnapshotTable(spark, str(tmp_path / "strict"), StructType.fromDDL("k string, band string"))
    from tierlake.operators.upsert import DuplicateKeyError
    with pytest.raises(DuplicateKeyError):
        load_report(spark, str(tmp_path / "g.xml"), strict, t2)
    roles = ReportSpec("ROLES", (Col("k", "SUBMISSION_ID"), Col("band", "BAND")), (), "replace")
    t3 = SnapshotTable(spark, str(tmp_path / "roles"), StructType.fromDDL("k string, band string"))
    load_report(spark, str(tmp_path / "g.xml"), roles, t3)
    assert t3.read().count() == 3 and t3.current_version() == 1
    (tmp_path / "e.xml").write_text("<DATA_DS/>")
    with pytest.raises(EmptySourceError):
        load_report(spark, str(tmp_path / "e.xml"), roles, t3)
    assert t3.current_version() == 1


def test_decode_views(spark):
    from tierlake.plans.flex import GENERIC_COLUMNS
    cols = ["person_extra_info_id", "person_id", "candidate_number", "information_type"] + GENERIC_COLUMNS
    data = [(1, 10, "C1", "GCS Retirement") + ("Y",) + (None,) * 15 + ("2020/01/01", None) + (None,) * 6,
            (2, 11, "C2", "Secondary Status") + ("ACTIVE", "ok") + (None,) * 14 + ("2021/01/01", "2022/01/01") + (None,) * 6]
    df = spark.createDataFrame(data, ",".join(f"{c} {'bigint' if c.endswith('id') else 'string'}" for c in cols)) \
        .withColumn("effective_start_date", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("effective_end_date", F.lit(None).cast("timestamp_ntz"))
    ret = decode_view(df, "ext_flex_retirement_v").collect()
    assert len(ret) == 1 and ret[0].working_retiree == "Y" and ret[0].sc_retirement_date == "2020/01/01"
    st = decode_view(df, "ext_flex_secondary_status_v").first()
    assert (st.secondary_status, st.secondary_status_end_date) == ("ACTIVE", "2022/01/01")
    assert len(DECODE_VIEWS["ext_flex_person_data_v"][1]) == 23


def test_daily_run(spark, tmp_path):
    from tests_helpers import write_po_csv
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write_po_csv(inbox / "file_polines-b1-20260308_100000.csv", ["10,1,1,a,,OK,x,a,OPEN,1,Q,G,EA,1,EA,x"])
    files = spark.createDataFrame([("file_polines-b1-20260308_100000.zip", "PO_LINES", "Y",
                                    dt.datetime(2026, 3, 8, 10))],
                                  "file_name string, load_type string, loader_available string, file_timestamp timestamp_ntz")
    jobs = spark.createDataFrame([], "file_name string, load_type string, status string")
    from tierlake.operators.incremental import select_unprocessed_latest
    sel = select_unprocessed_latest(files, jobs, F.lit(dt.datetime(2026, 3, 8, 18)).cast("timestamp_ntz"))
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    done = EF.run_daily(wh, {"PO_LINES": S.PO_LINES}, sel,
                        lambda n: str(inbox / n.replace(".zip", ".csv")))
    assert len(done) == 1 and done[0][4] == 1
    assert wh.final(S.PO_LINES).read().count() == 1


def test_sync_source_modes_and_single_record(spark):
    from pyspark.sql.types import StructType
    items = spark.createDataFrame([
        (1, 0, "1", "a", "2026-03-01 00:00:00"), (1, 1, "2", "b", "2026-03-09 00:00:00"),
        (2, 0, "1", "a2", "2026-03-09 00:00:00")],
        "page_no int, _seq int, resource_key string, name string, LastUpdateDate string")
    final = spark.createDataFrame([("1", "old", "2026-01-01 00:00:00", dt.datetime(2026, 1, 1)),
                                   ("9", "keep", "2026-01-01 00:00:00", dt.datetime(2026, 1, 1))],
                                  "resource_key string, name string, LastUpdateDate string, row_sync_ts timestamp_ntz")
    inc = RD.sync_source(items, final, last_sync=dt.datetime(2026, 3, 9), sync_ts=dt.datetime(2026, 3, 10))
    assert {r.resource_key: r.name for r in inc.collect()} == {"1": "a2", "2": "b", "9": "keep"}
    full = RD.sync_source(items, final, sync_type="FULL_ONLY")
    assert {r.resource_key: r.name for r in full.collect()} == {"1": "a2", "2": "b"}
    resp = spark.createDataFrame([('{"resource_key": "9", "name": "fresh", "Extra": 1}',)], "body string")
    sch = StructType.fromDDL("resource_key string, name string, LastUpdateDate string, row_sync_ts timestamp_ntz")
    one = RD.refresh_record(final, resp, "body", sch, "resource_key")
    assert {r.resource_key: r.name for r in one.collect()} == {"1": "old", "9": "fresh"}
    assert RD.zero_merge_warning(0, "x" * 5000).endswith("x" * 3800) and RD.zero_merge_warning(3, "x") is None
    reg = spark.createDataFrame([("b", "Y"), ("a", "Y"), ("c", "N")], "module_static_id string, is_active string")
    assert [r[0] for r in RD.active_sources(reg).collect()] == ["a", "b"]


def test_optional_filter_and_reset(spark, tmp_path):
    from tierlake.functions.casts import optional_eq
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert df.where(optional_eq("x", 2)).count() == 1 and df.where(optional_eq("x", None)).count() == 2
    from tests_helpers import write_po_csv
    write_po_csv(tmp_path / "a.csv", ["10,1,1,a,,OK,x,a,OPEN,1,Q,G,EA,1,EA,x"])
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    j, _ = EF.load_and_preview(wh, S.PO_LINES, str(tmp_path / "a.csv"))
    EF.merge_job(wh, S.PO_LINES, j)
    assert wh.final(S.PO_LINES).read().count() == 1
    wh.reset([S.PO_LINES])
    assert wh.final(S.PO_LINES).read().count() == 0 and wh.jobs().events().count() == 0


def test_dimensions_candidates_phones_content(spark, tmp_path):
    (tmp_path / "jobs_p1.json").write_text(json.dumps({"items": [
        {"JobId": 1, "JobName": "Teacher", "JobCode": "T"}, {"JobId": None, "JobName": "x"}], "hasMore": True}))
    (tmp_path / "jobs_p2.json").write_text(json.dumps({"items": [{"JobId": 1, "JobName": "Teacher II", "JobCode": "T2"}]}))
    pages = read_pages(spark, str(tmp_path / "jobs_p*.json"), RD.DIM_JOB.item_schema())
    assert [tuple(r) for r in RD.sync_dataset(pages, RD.DIM_JOB).collect()] == [(1, "Teacher II", "T2")]
    cand = {"items": [
        {"CandidateNumber": "C1", "PersonId": 5, "LastName": "Ng", "CandLastModifiedDate": "2026-03-09T18:31:43-05:00",
         "candidatePhones": [{"PhoneId": 9, "PhoneNumber": "555", "LastUpdateDate": "2026-03-09T18:31:43.123+05:30"},
                             {"PhoneId": None, "PhoneNumber": "dropped"}]},
        {"CandidateNumber": "C2", "LastName": "no person"},
        {"CandidateNumber": "C3", "PersonId": 7, "candidatePhones": []}]}
    (tmp_path / "candidates_p1.json").write_text(json.dumps(cand))
    pages = read_pages(spark, str(tmp_path / "candidates_p1.json"), RD.CANDIDATES.item_schema())
    c = {r.candidate_number: r for r in RD.page_dataset(pages, RD.CANDIDATES).collect()}
    assert set(c) == {"C1", "C3"} and c["C1"].cand_last_modified_date == dt.datetime(2026, 3, 9, 23, 31, 43)
    pages = read_pages(spark, str(tmp_path / "candidates_p1.json"), RD.CANDIDATE_PHONES.item_schema())
    ph = RD.page_dataset(pages, RD.CANDIDATE_PHONES).collect()
    assert [(r.phone_id, r.person_id, r.last_update_date) for r in ph] == \
        [(9, 5, dt.datetime(2026, 3, 9, 18, 31, 43, 123000))]
    link = lambda i: [{"rel": "self", "href": "https://h/x/1"}, {"rel": "canonical", "href": f"https://h/items/{i}"}]
    content = {"items": [
        {"ItemDescriptionId": None, "Name": "no id", "links": link(41)},
        {"ItemDescriptionId": 6, "Name": "no canonical link", "links": [{"rel": "self", "href": "https://h/x/9"}]},
        {"ItemDescriptionId": 7, "Name": "Reject", "links": link(70)},
        {"ItemDescriptionId": 9, "Name": "Offer", "DescriptionTypeCode": "MAIL", "links": link(42)}]}
    (tmp_path / "content_p1.json").write_text(json.dumps(content))
    from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType
    item = StructType([StructField("ItemDescriptionId", LongType()), StructField("Name", StringType()),
                       StructField("DescriptionCode", StringType()), StructField("DescriptionTypeCode", StringType()),
                       StructField("VisibilityCode", StringType()),
                       StructField("links", ArrayType(StructType([StructField("rel", StringType()),
                                                                  StructField("href", StringType())])))])
    pages = read_pages(spark, str(tmp_path / "content_p1.json"), item)
    final = spark.createDataFrame([(7, 70, "old", None, None, None, "keep me"), (8, 80, "other", None, None, None, "t8")],
                                  "item_description_id bigint, content_item_id bigint, name string, description_code string, "
                                  "description_type string, visibility_code string, txt_description string")
    bodies = spark.createDataFrame([(42, 200, "Dear ${CandidateFirstName}"), (70, 500, "error page"), (99, 200, "orphan")],
                                   "content_item_id bigint, http_status int, body string")
    out = {r.item_description_id: (r.content_item_id, r.name, r.description_type, r.txt_description) for r in
           RD.content_library_sync(pages, bodies, final).collect()}
    assert out == {7: (70, "Reject", None, "keep me"), 8: (80, "other", None, "t8"), 9: (42, "Offer", "MAIL", "Dear ${CandidateFirstName}")}


def test_children_of_one_item_keep_their_order(spark):
    item = RD.requisition_item_schema()
    dff = [{"flex": 0}]
    row = {f.name: None for f in item.fields}
    row |= {"RequisitionId": 1, "publishedJobs": [
        {"Visibility": "EXT", "PostingStatus": s} for s in ("first", "second", "last")],
        "requisitionDFF": [{j: v for j, _ in RD.DFF_FIELDS} for v in ("a", None, "z")]}
    import json as js
    from tierlake.sources.json_pages import envelope
    body = js.dumps({"items": [row]})
    pages = spark.createDataFrame([(1, body)], "page_no bigint, b string").select("page_no", F.from_json("b", envelope(item)).alias("e")) \
        .select("page_no", F.lit(False).alias("has_more"), "e.items")
    src = RD.requisition_sources(pages)
    assert [r.published_posting_status for r in src["req_published_jobs_r"].collect()] == ["last"]
    assert {tuple(r)[1:] for r in src["req_dff_r"].collect()} == {("z",) * len(RD.DFF_FIELDS)}


def test_passes_overlap_and_gaps(spark, tmp_path):
    from tierlake.plans.registry_sync import declared_items
    from tierlake.operators.upsert import fold_pages
    from tierlake.sources.json_pages import pass_faults, read_passes
    item = "CandidateNumber string, LastName string"
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(item)

    def land(at, pass_no, page, names, more, total):
        d = tmp_path / at / f"pass={pass_no}"
        d.mkdir(parents=True, exist_ok=True)
        (d / f"page-{page}.json").write_text(json.dumps({"items": [{"CandidateNumber": k, "LastName": v} for k, v in names], "hasMore": more, "totalResults": total}))

    land("ok", 1, 1, [("C1", "p1"), ("C2", "p1")], True, 6)
    land("ok", 1, 2, [("C3", "p1"), ("C4", "p1")], False, 6)        # the cap of 4 rows was reached
    land("ok", 2, 1, [("C4", "p2"), ("C2", "p2")], True, 3)         # overlaps the first pass
    land("ok", 2, 2, [("C5", "p2")], False, 3)
    pages = read_passes(spark, str(tmp_path / "ok"), schema)
    assert pass_faults(pages, cap=4).collect() == []
    folded = fold_pages(declared_items(pages, "CandidateNumber"), ["resource_key"], "_page", "_seq")
    assert {r.resource_key: r.lastname for r in folded.collect()} == {"C1": "p1", "C2": "p2", "C3": "p1", "C4": "p2", "C5": "p2"}
    land("gap", 1, 1, [("C1", "x")], True, 5)
    land("gap", 1, 3, [("C1", "x")], True, 5)
    land("gap", 2, 1, [(f"D{k}", "x") for k in range(9)], False, 9)
    got = {tuple(r) for r in pass_faults(read_passes(spark, str(tmp_path / "gap"), schema), cap=9).collect()}
    assert got == {(1, "page missing"), (1, "last page missing"), (1, "items missing"), (2, "next pass missing")}


def test_single_applications_are_refreshed(spark):
    import datetime as d
    cols = [j.lower() for j, _ in RD.APPLICATION_FIELDS]
    assert len(cols) == 34
    empty = spark.createDataFrame([(None,) * 34], ", ".join(f"{j.lower()} {'timestamp_ntz' if k == 'ts' else k}" for j, k in RD.APPLICATION_FIELDS))
    final = empty.withColumn("jobapplicationid", F.lit(1).cast("bigint")).withColumn("statename", F.lit("Old")) \
        .unionByName(empty.withColumn("jobapplicationid", F.lit(2).cast("bigint")).withColumn("statename", F.lit("Stays")))
    bodies = [(1, '{"JobApplicationId": 1, "StateName": "Mid"}'), (2, '{"JobApplicationId": 1, "StateName": "New", "LastUpdateDate": "2026-03-09T18:31:43-05:00"}'),
              (3, '{"JobApplicationId": 3, "StateName": "Added"}'), (4, '{"StateName": "no id"}')]
    out = RD.refresh_application(final, spark.createDataFrame(bodies, "response_no int, body string"))
    got = {r.jobapplicationid: (r.statename, r.lastupdatedate) for r in out.collect()}
    assert got == {1: ("New", d.datetime(2026, 3, 9, 23, 31, 43)), 2: ("Stays", None), 3: ("Added", None)}


def test_isolated_sources_and_report_log(spark, tmp_path):
    calls = []

    def boom():
        raise ValueError("bad page")
    with pytest.raises(RD.SyncErrors) as ei:
        RD.run_isolated([("a", lambda: calls.append("a") or 1), ("b", boom), ("c", lambda: calls.append("c") or 3)],
                        on_error=lambda n, e: calls.append(f"err:{n}"))
    assert calls == ["a", "err:b", "c"] and "b: bad page" in str(ei.value)
    from tierlake.plans.joblog import REPORT_STATUSES, JobLog
    log = JobLog(spark, str(tmp_path / "reports"), statuses=REPORT_STATUSES)
    log.append(1, "RUNNING", load_type="GALLUP", rows_loaded=10)
    log.append(1, "SUCCESS", rows_merged=8)
    cur = log.current().first()
    assert (cur.status, cur.rows_loaded, cur.rows_merged) == ("SUCCESS", 10, 8)
    with pytest.raises(ValueError):
        log.append(2, "MERGED")


def test_flex_report_feeds_decode_views(spark, tmp_path):
    from pyspark.sql.types import StructType
    from tierlake.plans.reports import BIP_DFF, EXT_FLEX_STG, typed_rows
    xml = """<DATA_DS><ROW><PERSON_EXTRA_INFO_ID>5</PERSON_EXTRA_INFO_ID><PERSON_ID>9</PERSON_ID>
    <INFORMATION_TYPE>GCS Retirement</INFORMATION_TYPE><PEI_INFO1>Y</PEI_INFO1><PEI_DATE1>2020/01/01</PEI_DATE1></ROW>
    <ROW><PERSON_EXTRA_INFO_ID>5</PERSON_EXTRA_INFO_ID><INFORMATION_TYPE>GCS Retirement</INFORMATION_TYPE>
    <PEI_INFO1>N</PEI_INFO1></ROW><ROW><PERSON_ID>1</PERSON_ID></ROW></DATA_DS>"""
    (tmp_path / "flex.xml").write_text(xml)
    schema = typed_rows(spark, str(tmp_path / "flex.xml"), EXT_FLEX_STG).drop("_seq").schema
    target = SnapshotTable(spark, str(tmp_path / "flex"), schema)
    assert load_report(spark, str(tmp_path / "flex.xml"), EXT_FLEX_STG, target) == 3
    got = target.read().collect()
    assert len(got) == 1 and got[0].pei_info1 == "Y"          # first row per key in document order
    ret = decode_view(target.read(), "ext_flex_retirement_v").first()
    assert (ret.working_retiree, ret.sc_retirement_date) == ("Y", "2020/01/01")
    dff = """<DATA_DS><ROW><DFF_CODE>D</DFF_CODE><CONTEXT_CODE>C</CONTEXT_CODE><SEGMENT_IDENTIFIER>S</SEGMENT_IDENTIFIER>
    <LAST_UPDATE_DATE>2026-03-09T18:31:43.000+00:00</LAST_UPDATE_DATE></ROW><ROW><DFF_NAME>no code</DFF_NAME></ROW></DATA_DS>"""
    (tmp_path / "dff.xml").write_text(dff)
    sch = typed_rows(spark, str(tmp_path / "dff.xml"), BIP_DFF).drop("_seq").schema
    t2 = SnapshotTable(spark, str(tmp_path / "dff"), sch)
    load_report(spark, str(tmp_path / "dff.xml"), BIP_DFF, t2)
    rows = t2.read().collect()
    assert len(rows) == 1 and rows[0].last_update_date == dt.datetime(2026, 3, 9, 18, 31, 43)


def test_questionnaire_and_user_reports(spark, tmp_path):
    from tierlake.plans.reports import BIP_QUESTIONNAIRES, FA_USER_ACCOUNTS, FA_USER_ROLES, typed_rows
    q = """<DATA_DS><ROW><QUESTIONNAIRE_CODE>Q</QUESTIONNAIRE_CODE><QUESTION_CODE>A</QUESTION_CODE>
    <QSTNR_PARTICIPANT_ID> 12 </QSTNR_PARTICIPANT_ID><REQUISITION_ID>7</REQUISITION_ID>
    <RESPONSE_SUBMITTED_DATE>2026-03-09T18:31:43-05:00</RESPONSE_SUBMITTED_DATE></ROW>
    <ROW><QUESTIONNAIRE_CODE>Q</QUESTIONNAIRE_CODE><QUESTION_CODE>A</QUESTION_CODE>
    <QSTNR_PARTICIPANT_ID>x1</QSTNR_PARTICIPANT_ID><REQUISITION_ID>7</REQUISITION_ID></ROW></DATA_DS>"""
    (tmp_path / "q.xml").write_text(q)
    rows = typed_rows(spark, str(tmp_path / "q.xml"), BIP_QUESTIONNAIRES).collect()
    assert len(rows) == 1 and rows[0].qstnr_participant_id == 12
    assert rows[0].response_submitted_date == dt.datetime(2026, 3, 9, 23, 31, 43)
    u = """<DATA_DS><ROW><USER_GUID>G</USER_GUID><USERNAME>first</USERNAME></ROW>
    <ROW><USER_GUID>G</USER_GUID><USERNAME>second</USERNAME></ROW></DATA_DS>"""
    (tmp_path / "u.xml").write_text(u)
    sch = typed_rows(spark, str(tmp_path / "u.xml"), FA_USER_ACCOUNTS).drop("_seq").schema
    t = SnapshotTable(spark, str(tmp_path / "users"), sch)
    load_report(spark, str(tmp_path / "u.xml"), FA_USER_ACCOUNTS, t)
    assert [r.username for r in t.read().collect()] == ["first"]
    r = """<DATA_DS><ROW><USER_GUID>G</USER_GUID><ROLE_NAME>R</ROLE_NAME>
    <EFFECTIVE_END_DATE>2026-12-31T00:00:00.000 +00:00</EFFECTIVE_END_DATE></ROW></DATA_DS>"""
    (tmp_path / "r.xml").write_text(r)
    got = typed_rows(spark, str(tmp_path / "r.xml"), FA_USER_ROLES).first()
    assert got.effective_end_date == dt.datetime(2026, 12, 31)


def test_page_dataset_strict_duplicates(spark, tmp_path):
    (tmp_path / "g_p1.json").write_text(json.dumps({"items": [
        {"GradeId": 1, "Name": "a"}, {"GradeId": 1, "Name": "b"}]}))
    pages = read_pages(spark, str(tmp_path / "g_p1.json"), RD.DIM_GRADE.item_schema())
    assert [r.grade_name for r in RD.page_dataset(pages, RD.DIM_GRADE).collect()] == ["b"]
    from tierlake.operators.upsert import DuplicateKeyError
    with pytest.raises(DuplicateKeyError):
        RD.page_dataset(pages, RD.DIM_GRADE, strict=True)


def test_landed_reports_are_ordered_files_of_many_tasks(spark, tmp_path):
    import glob
    from pyspark.sql import functions as F
    from tierlake.entity_queries import land_report
    from tierlake.operators.dedup import first_arrival
    from tierlake.sources.xml_rowset import read_rowset
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ev = spark.range(4000).select((F.lit(3999) - F.col("id")).alias("id"), (F.col("id") % 7).alias("user"))
        land_report(ev, "id", {"ID": F.col("id").cast("string"), "USER": F.col("user").cast("string")}, f"{tmp_path}/r")
        assert len(glob.glob(f"{tmp_path}/r/part-*")) > 1
        rows = read_rowset(spark, f"{tmp_path}/r", ["ID", "USER"])
        assert [int(r["id"]) for r in rows.orderBy("_seq").collect()] == list(range(4000))
        first = {int(r["user"]): int(r["id"]) for r in first_arrival(rows, ["user"]).collect()}
        assert first == {(3999 - i) % 7: i for i in range(7)}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
