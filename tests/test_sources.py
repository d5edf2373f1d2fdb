import base64
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tierlake.sources import json_pages as J
from tierlake.sources import xml_rowset as X
from tierlake.sources import zipped as Z

ITEM = StructType([
    StructField("JobId", LongType()), StructField("JobName", StringType()),
    StructField("dff", ArrayType(StructType([StructField("Ctx", StringType()), StructField("Val", StringType())]))),
])


def write_json(path, obj):
    with open(path, "w") as f:
        json.dump(obj, f, indent=2)


def test_json_pages_items_and_children(spark, tmp_path):
    write_json(tmp_path / "jobs_p1.json", {"items": [
        {"JobId": 1, "JobName": "A", "dff": [{"Ctx": "c", "Val": "x"}]},
        {"JobId": None, "JobName": "dropped"},
        {"JobId": 2, "JobName": "B", "dff": []}], "hasMore": True})
    write_json(tmp_path / "jobs_p2.json", {"items": [{"JobId": 1, "JobName": "A2", "dff": None},
                                                     {"JobId": 3, "JobName": "C"}]})
    pages = J.read_pages(spark, str(tmp_path / "jobs_p*.json"), ITEM)
    got = {r.page_no: r.has_more for r in pages.collect()}
    assert got == {1: True, 2: False}
    items = J.page_items(pages, drop_null=["JobId"])
    assert sorted((r.page_no, r.JobId) for r in items.collect()) == [(1, 1), (1, 2), (2, 1), (2, 3)]
    kids = J.child_rows(items, ["page_no", "JobId"], "dff")
    assert sorted((r.page_no, r.JobId, r.Ctx) for r in kids.collect()) == \
        [(1, 1, "c"), (1, 2, None), (2, 1, None), (2, 3, None)]
    inner = J.child_rows(items, ["JobId"], "dff", inner_key="Ctx")
    assert [(r.JobId, r.Val) for r in inner.collect()] == [(1, "x")]
    # later page wins when folded
    from tierlake.operators.upsert import fold_pages
    folded = fold_pages(items.select("page_no", F.col("_pos").alias("_seq"), "JobId", "JobName"), ["JobId"])
    assert {r.JobId: r.JobName for r in folded.collect()} == {1: "A2", 2: "B", 3: "C"}


def test_json_scalars_and_links(spark):
    df = spark.createDataFrame([('{"hasMore": true, "totalResults": 12}',), ('{"items": []}',)], "b string")
    assert [tuple(r) for r in df.select(J.has_more("b"), J.total_results("b")).collect()] == [(True, 12), (False, None)]
    links = spark.createDataFrame([([("self", "/a/1"), ("canonical", "/b/7")],)],
                                  "l array<struct<rel:string,href:string>>")
    assert links.select(J.canonical_link("l")).first()[0] == "/b/7"


XML_DOC = """<?xml version="1.0"?>
<DATA_DS><G><ROW><ENTITY_NAME>ORDERS</ENTITY_NAME><REC_COUNT>5</REC_COUNT></ROW></G>
<ROW><ENTITY_NAME>PARTS</ENTITY_NAME><REC_COUNT></REC_COUNT></ROW>
<ROW><ENTITY_NAME>ONLY_NAME</ENTITY_NAME></ROW></DATA_DS>"""


def test_xml_rowset_any_depth(spark, tmp_path):
    (tmp_path / "counts.xml").write_text(XML_DOC)
    df = X.read_rowset(spark, str(tmp_path / "counts.xml"), ["ENTITY_NAME", "REC_COUNT"])
    got = sorted((r.entity_name, r.rec_count) for r in df.collect())
    assert got == [("ONLY_NAME", None), ("ORDERS", "5"), ("PARTS", None)]


def test_zero_row_guard(spark, tmp_path):
    (tmp_path / "empty.xml").write_text("<DATA_DS></DATA_DS>")
    df = X.read_rowset(spark, str(tmp_path / "empty.xml"), ["ENTITY_NAME"])
    with pytest.raises(X.EmptySourceError):
        X.require_rows(df, "counts")


def test_soap_report_bytes(spark):
    inner = "<DATA_DS><ROW><A>1</A><B>x</B></ROW><ROW><A>2</A><B></B></ROW></DATA_DS>"
    b64 = base64.b64encode(inner.encode()).decode()
    soap = (f'<soap:Envelope xmlns:soap="http://schemas.xmlsoap.org/soap/envelope/"><soap:Body>'
            f'<ns2:runReportResponse xmlns:ns2="urn:r"><ns2:reportBytes>{b64}</ns2:reportBytes>'
            f'</ns2:runReportResponse></soap:Body></soap:Envelope>')
    df = spark.createDataFrame([(1, soap)], "rid int, resp string").withColumn("xml", X.report_xml("resp"))
    assert df.first().xml == inner
    rows = X.rows_from_xml_text(df, "xml", ["A", "B"], keep=["rid"])
    assert sorted((r.a, r.b) for r in rows.collect()) == [("1", "x"), ("2", None)]
    status = spark.createDataFrame([("<r><requestId x='1'>42</requestId><state>DONE</state></r>",)], "t string")
    assert tuple(status.select(X.tag_text("t", "requestId"), X.tag_text("t", "state")).first()) == ("42", "DONE")


def test_zip_pick_entry_and_stage(spark, tmp_path):
    src = tmp_path / "zips"
    os.makedirs(src)
    with zipfile.ZipFile(src / "file_a-batch1-20260309_183143.zip", "w") as z:
        z.writestr("MANIFEST.MF", "m")
        z.writestr("DATA.CSV", "A,B\n1,x\n2,y\n")
    with zipfile.ZipFile(src / "file_b-batch2-20260310_010101.ZIP", "w") as z:
        z.writestr("only.txt", "A,B\n3,z\n")
    (src / "notes.txt").write_text("ignored")
    assert Z.pick_entry(["a.txt", "b.Csv"]) == "b.Csv" and Z.pick_entry(["a.txt"]) == "a.txt"
    zips = Z.list_zips(spark, str(src))
    assert zips.count() == 2
    staged = Z.stage_zip_csv(zips, str(tmp_path / "staging")).collect()
    assert sorted(r.entry_name for r in staged) == ["DATA.CSV", "only.txt"]
    from tierlake.sources.landing import read_landing_csv
    land = read_landing_csv(spark, str(tmp_path / "staging"), required=["A", "B"])
    assert sorted((r.A, r.B) for r in land.collect()) == [("1", "x"), ("2", "y"), ("3", "z")]
