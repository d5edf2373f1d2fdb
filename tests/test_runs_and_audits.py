"""Stored reconciliation runs, one-pass audits, budget keys, landing tables, entity streams."""


import pytest
from pyspark.sql import functions as F

from tierlake.operators.audit import orphan_audit
from tierlake.operators.recon import ReconRuns, ReconSource
from tierlake.plans import entity_flow as EF
from tierlake.plans.budget import with_code_combination
from tierlake.plans.specs import BUDGET_SEGMENTS, Col, EntitySpec
from tierlake.sources.landing import LandingTable, MissingColumnsError
from tierlake.streaming.file_ingest import ingest_entity, stream_counts


def test_two_recon_runs_share_counts(spark, tmp_path):
    runs = ReconRuns(spark, str(tmp_path))
    tables = {"a": spark.range(5), "b": spark.range(3)}
    sources = [ReconSource("A", "a", entity_key="A", report="one"), ReconSource("A2", "a", entity_key="A2", report="one"),
               ReconSource("B", "b", entity_key="B", report="two"), ReconSource("C", "gone", entity_key="C", report="one")]
    calls = []

    def counts(report, rows):
        def fetch():
            calls.append(report)
            if rows is None:
                raise RuntimeError("report is down")
            return spark.createDataFrame(rows, "entity_key string, source_count int")
        return fetch
    one = counts("one", [("A", 5), ("A2", 7), ("C", 1)])
    got = {r.entity_name: (r.status, r.source_count, r.error_message) for r in runs.run("r1", sources, tables, {"one": one, "two": counts("two", None)}, "d1").collect()}
    assert got["A"][0] == "OK" and got["A2"][0] == "VARIANCE" and got["C"][0] == "ERROR"
    assert got["B"][0] == "ERROR" and "report two: RuntimeError report is down" in got["B"][2]
    runs.run("r2", sources, tables, {"one": counts("one", None), "two": counts("two", [("B", 3)])}, "d1")
    assert calls == ["one", "two", "two"]                       # the second run took report one from the store
    head = {r.run_id: (r.total_sources, r.sources_ok, r.sources_variance, r.sources_error) for r in runs.runs().collect()}
    assert head == {"r1": (4, 1, 1, 2), "r2": (4, 2, 1, 1)}
    runs.run("r2", sources[:1], tables, {"one": one}, "d2")     # repeated: replaced
    assert runs.results().where("run_id = 'r2'").count() == 1 and runs.results().where("run_id = 'r1'").count() == 4
    assert {r.run_id: r.total_sources for r in runs.runs().collect()} == {"r1": 4, "r2": 1}


def test_orphans_in_one_scan_a_table(spark, tmp_path):
    child = spark.createDataFrame([(1, 1, "x"), (2, None, "x"), (3, 9, "y"), (4, 9, None), (5, 1, "z")], "id int, p int, q string")
    parent = spark.createDataFrame([(1, "x"), (1, "x"), (2, "z")], "p long, q string")
    child.write.parquet(str(tmp_path / "c"))
    parent.write.parquet(str(tmp_path / "p"))
    c, p = spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "p"))
    out = orphan_audit([("one", c, p, ["p"], ["p"]), ("two", c, p, ["p", "q"], ["p", "q"]), ("self", c, c, ["p"], ["id"]),
                        ("none", c.where("id > 99"), p, ["p"], ["p"])])
    assert {r.relation: (r.child_rows, r.orphan_rows) for r in out.collect()} == {"one": (5, 2), "two": (5, 2), "self": (5, 2), "none": (0, 0)}
    plan = orphan_audit([("one", c, p, ["p"], ["p"]), ("two", c, p, ["p", "q"], ["p", "q"]), ("self", c, c, ["p"], ["id"])]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_budget_segments(spark):
    schema = ", ".join(f"{s} string" for s in BUDGET_SEGMENTS)
    rows = [("1", "2", "3", "4", "5", "6", "7", "8", "9"), ("0001", "002", "0003", "004", "005", "0000006", "0007", "0008", "00009"),
            ("12345", "2", "3", None, "", "6", "7", "8", "9"), ("9", "9", "9", "9", "9", "9", "9", "9", "9"), (None,) * 9]
    budget = spark.createDataFrame(rows, schema).withColumn("amount", F.lit(1))
    comb = spark.createDataFrame([(10, "E", *rows[1]), (11, "R", *rows[0]), (20, "A", "1234", "002", "3", "", None, "6", "7", "8", "9")],
                                 "code_combination_id bigint, account_type string, " + schema)
    got = [(r.code_combination_id, r.account_type, r.n_combinations) for r in with_code_combination(budget, comb).collect()]
    assert sorted(got, key=str) == sorted([(10, "E", 2), (10, "E", 2), (20, "A", 1), (None, None, 0), (None, None, 0)], key=str)
    assert with_code_combination(budget, comb.withColumn("code_combination_id", F.lit(None).cast("bigint"))).columns == [*budget.columns, "code_combination_id", "account_type", "n_combinations"]


def test_landing_is_replaced_and_its_header_watched(spark, tmp_path):
    land = LandingTable(spark, str(tmp_path / "landing"))
    (tmp_path / "a.csv").write_text('A,B,C\n1,"x\ny",\n2,z,3\n')
    (tmp_path / "b.csv").write_text("C,A,D\n7,8,9\n")
    first = land.land(str(tmp_path / "a.csv"), ["a", "B"], "a.zip")
    assert sorted(tuple(r)[:2] for r in first.collect()) == [("1", "x\ny"), ("2", "z")]
    reader = land.read()
    second = land.land(str(tmp_path / "b.csv"), ["A"], "b.zip")
    assert [r["A"] for r in second.collect()] == ["8"]
    assert reader.count() == 2                                  # who was reading still has the old file's rows
    assert land.last()["changes"] == {"new": ["D"], "gone": ["B"], "moved": ["C", "A"]} and land.last()["file"] == "b.zip"
    with pytest.raises(MissingColumnsError):
        land.land(str(tmp_path / "b.csv"), ["B"], "c.zip")
    assert [r["A"] for r in land.read().collect()] == ["8"]     # a refused file changes nothing


def test_load_through_a_landing_table(spark, tmp_path):
    spec = stream_spec()
    wh = EF.Warehouse(spark, str(tmp_path / "wh"), keep_landing=True)
    (tmp_path / "a.csv").write_text("K,V,D\n1,a,2026-01-01\n1,b,2026-02-01\n")
    job, counts = EF.load_and_preview(wh, spec, str(tmp_path / "a.csv"), "a.zip")
    EF.merge_job(wh, spec, job, "a.zip")
    assert [(r.k, r.v) for r in wh.final(spec).read().collect()] == [(1, "b")] and counts["new_count"] == 1
    assert wh.landing(spec).read().count() == 2


def stream_spec():
    return EntitySpec(name="STREAMED", keys=("k",), order=(("d", "desc"),), not_null=("k",),
                      columns=(Col("k", "K", "num:bigint"), Col("v", "V"), Col("d", "D", "ts")), compare=("k", "v"))


def test_entity_stream_with_late_repeated_files_and_two_checkpoints(spark, tmp_path):
    spec, wh = stream_spec(), EF.Warehouse(spark, str(tmp_path / "wh"))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "1.csv").write_text("K,V,D\n1,a,2026-01-05\n2,b,2026-01-05\n2,older,2026-01-01\n,no key,2026-01-01\n")
    ingest_entity(wh, spec, str(inbox), str(tmp_path / "cp1"))
    (inbox / "2.csv").write_text("K,V,D\n1,late,2026-01-02\n2,b,2026-01-06\n3,c,2026-01-01\n")      # late, unchanged but newer, new
    ingest_entity(wh, spec, str(inbox), str(tmp_path / "cp1"))
    (inbox / "3.csv").write_text((inbox / "1.csv").read_text())                                     # the first file again
    ingest_entity(wh, spec, str(inbox), str(tmp_path / "cp1"))
    want = {(1, "a"), (2, "b"), (3, "c")}
    rows = lambda: {(r.k, r.v) for r in wh.final(spec).read().collect()}
    assert rows() == want
    counts = {r.batch_id: r for r in stream_counts(wh.final(spec)).collect()}
    assert [(counts[b].rows_read, counts[b].rows_loaded, counts[b].null_key_count) for b in (0, 1, 2)] == [(4, 2, 1), (3, 3, 0), (4, 2, 1)]
    assert [(counts[b].new_count, counts[b].changed_count, counts[b].unchanged_count, counts[b].stale_count, counts[b].merged_count) for b in (0, 1, 2)] == \
        [(2, 0, 0, 0, 2), (1, 1, 1, 1, 2), (0, 0, 2, 1, 1)]
    before = wh.final(spec).current_version()
    ingest_entity(wh, spec, str(inbox), str(tmp_path / "cp1"))                                      # nothing new
    assert wh.final(spec).current_version() == before
    ingest_entity(wh, spec, str(inbox), str(tmp_path / "cp2"), max_files_per_trigger=1)             # all files again, another stream
    assert rows() == want
    assert wh.final(spec).has_batch(str(tmp_path / "cp2"), 2) and not wh.final(spec).has_batch(str(tmp_path / "cp2"), 3)


def test_replayed_batch_is_not_merged_twice(spark, tmp_path):
    from tierlake.streaming.file_ingest import entity_batch
    spec, wh = stream_spec(), EF.Warehouse(spark, str(tmp_path / "wh"))
    batch = spark.createDataFrame([("1", "a", "2026-01-01", ("f", 0, 0))], "K string, V string, D string, _seq struct<file:string,block:bigint,row:bigint>")
    run = entity_batch(wh.final(spec), spec, "s", str(tmp_path / "w"))
    run(batch, 0)
    run(batch.withColumn("V", F.lit("replayed")), 0)
    assert [r.v for r in wh.final(spec).read().collect()] == ["a"] and wh.final(spec).has_batch("s", 0)
