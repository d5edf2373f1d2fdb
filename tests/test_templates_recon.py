from pyspark.sql import functions as F

from tierlake.functions import templates as T
from tierlake.operators import recon as R
from tierlake.operators.tokens import refresh_registry, resolve_templates, token_frequency
from tierlake.session import local_rows


def test_extract_tokens(spark):
    df = spark.createDataFrame([("Hi ${A} and ${B} and ${A} ${} ${C",), (None,), ("${a${b}",)], "t string")
    got = [r[0] for r in df.select(T.extract_tokens("t")).collect()]
    assert got == [["A", "B"], [], ["a${b"]]


def test_resolve_sequential_and_defaults(spark):
    rows = spark.createDataFrame([(1, "Dear ${Name}, ${Greeting} ${Unknown} ${Site}", "Ann", None)],
                                 "id int, t string, cand string, site string")
    reg = local_rows(spark, [("Greeting", "see ${Site}"), ("Site", "HQ"), ("Name", "nobody"), ("Unused", None)],
                     "token_name string, default_value string")
    out = resolve_templates(rows, "t", {"Name": F.col("cand"), "Site": F.col("site")}, reg)
    assert out.first().resolved_text == "Dear Ann, see HQ ${Unknown} HQ"


def test_resolve_with_many_defaults_repeats_and_nested(spark):
    rows = [(1, "${B} ${A} ${B} ${Loop}", "ctx"), (1, "${B} ${A} ${B} ${Loop}", "ctx"), (2, None, "x"), (3, "no tokens", "x"),
            (4, "${T999999} ${T5} ${Nope}", None), (5, "${A}${A}", None)]
    df = spark.createDataFrame(rows, "id int, t string, a string")
    reg = spark.range(300_000).selectExpr("concat('T', id) token_name", "concat('v', id) default_value").unionByName(
        spark.createDataFrame([("A", "<${B}>"), ("B", "b"), ("B", "c"), ("Loop", "${Loop}"), ("Void", None)], "token_name string, default_value string"))
    out = resolve_templates(df, "t", {"A": F.col("a")}, reg)
    assert out.columns == ["id", "t", "a", "resolved_text"]
    assert sorted(((r.id, r.resolved_text) for r in out.collect()), key=str) == sorted([
        (1, "b ctx b ${Loop}"), (1, "b ctx b ${Loop}"), (2, None), (3, "no tokens"),
        (4, "${T999999} v5 ${Nope}"), (5, "<${B}><${B}>")], key=str)


def test_token_frequency_and_registry(spark):
    tm = spark.createDataFrame([("${A} ${A} ${B}",), ("${B}",), (None,)], "t string")
    got = {r.token_name: r.template_count for r in token_frequency(tm, "t").collect()}
    assert got == {"A": 1, "B": 2}
    reg = local_rows(spark, [("A", "x", 9), ("Z", "z", 3)], "token_name string, default_value string, template_count bigint")
    new = {r.token_name: (r.default_value, r.template_count) for r in refresh_registry(reg, tm, "t").collect()}
    assert new == {"A": ("x", 1), "B": (None, 2), "Z": ("z", 3)}


def test_reconcile_statuses(spark):
    srcs = [R.ReconSource("A", "ta", entity_key="A"), R.ReconSource("B", "tb", entity_key="B"),
            R.ReconSource("C", "tc", entity_key="C"), R.ReconSource("D", "ta", entity_key="D",
                                                                    count_expr="count(DISTINCT x)"),
            R.ReconSource("E", "ta", is_active=False), R.ReconSource("F", "missing", entity_key="A")]
    tables = {"ta": spark.createDataFrame([(1,), (1,), (2,)], "x int"),
              "tb": spark.createDataFrame([(1,)], "x int"), "tc": spark.createDataFrame([], "x int")}
    counts = spark.createDataFrame([("A", 3), ("B", 4), ("D", 0)], "entity_key string, source_count bigint")
    res = {r.entity_name: r for r in R.reconcile(srcs, R.local_counts(srcs, tables), counts).collect()}
    assert set(res) == {"A", "B", "C", "D", "F"}
    assert res["F"].status == "ERROR" and res["F"].error_message.startswith("Table missing")
    assert (res["A"].status, res["A"].delta) == ("OK", 0)
    assert (res["B"].status, res["B"].delta, res["B"].pct_delta) == ("VARIANCE", 3, 75.0)
    assert res["C"].status == "ERROR" and "not found" in res["C"].error_message
    assert (res["D"].status, res["D"].local_count, res["D"].pct_delta) == ("VARIANCE", 2, 0.0)
    hdr = R.run_header(R.reconcile(srcs, R.local_counts(srcs, tables), counts)).first()
    assert tuple(hdr) == (5, 1, 2, 2)
