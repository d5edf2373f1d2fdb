"""Cases that once lost or doubled rows."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tierlake.operators import upsert as U
from tierlake.plans import entity_flow as EF
from tierlake.plans import specs as S
from tierlake.sources import zipped as Z
from tierlake.sources.store import SnapshotTable
from tierlake.streaming.file_ingest import ingest_files


def test_dense_ids_beyond_the_range_sample(spark):
    n = 1_000_000
    df = spark.range(n).select((F.col("id") * 7919 % 1000003).alias("k"), F.concat(F.lit("payload "), F.col("id")).alias("text"), F.rand(3).alias("x"))
    r = U.dense_sequence(df, ["k"], name="sid").agg(F.count("sid").alias("n"), F.countDistinct("sid").alias("d"), F.min("sid").alias("lo"), F.max("sid").alias("hi")).first()
    assert tuple(r) == (n, n, 1, n)


@pytest.fixture()
def plain_overwrite(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    yield
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def gl_budget_rows(*rows):
    # header names as the extract has them
    head = "LEDGERID,BUDGETNAME,CURRENCYCODE,CURRENCYTYPE,PERIODNAME," + ",".join(f"GLBUDBALSEGMENT{i}" for i in range(1, 10)) + ",GLBUDBALPERIODNETCR,GLBUDBALPERIODNETDR,GLBUDBALLASTUPDATEDATE"
    return head + "\n" + "\n".join(rows) + "\n"


def test_two_pending_jobs_and_the_budget_extract(spark, tmp_path, plain_overwrite):
    spec = S.GL_BUDGET_BALANCE
    (tmp_path / "a.csv").write_text(gl_budget_rows("1,B26,USD,E,JAN-26,10,1,2,3,4,5,6,7,8,10.5,0,2026-01-31 10:00:00"))
    (tmp_path / "b.csv").write_text(gl_budget_rows("1,B26,USD,E,FEB-26,10,1,2,3,4,5,6,7,8,7,1,2026-02-28 10:00:00"))
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    jobs = [EF.load_and_preview(wh, spec, str(tmp_path / f))[0] for f in ("a.csv", "b.csv")]
    assert [EF.merge_job(wh, spec, j) for j in jobs] == [1, 1]
    got = {r.period_name: r for r in wh.final(spec).read().collect()}
    assert set(got) == {"JAN-26", "FEB-26"}
    jan = got["JAN-26"]
    assert (jan.fund, jan.location, jan.account, jan.future1, jan.currency_type) == ("0010", "001", "0000005", "00008", "E")
    assert jan.segment_string == "0010-001-0002-003-004-0000005-0006-0007-00008" and float(jan.period_net_cr) == 10.5
    with pytest.raises(FileNotFoundError):
        EF.merge_job(wh, spec, jobs[0])


def test_two_streams_into_one_table(spark, tmp_path):
    df = spark.range(15).select(F.col("id").alias("k"), F.col("id").alias("v"))
    df.where("k < 8").coalesce(1).write.parquet(str(tmp_path / "in1"))
    df.where("k >= 8").coalesce(1).write.parquet(str(tmp_path / "in2"))
    target = SnapshotTable(spark, str(tmp_path / "final"), schema=df.schema, keys=["k"])
    for n in (1, 2):
        ingest_files(spark, str(tmp_path / f"in{n}"), df.schema, target, ["k"], [F.col("v").desc()], checkpoint=str(tmp_path / f"ck{n}"))
    assert target.read().count() == 15


def test_archives_of_one_name_in_two_folders(spark, tmp_path):
    for n in "ab":
        (tmp_path / n).mkdir()
        with zipfile.ZipFile(tmp_path / n / "x.zip", "w") as z:
            z.writestr("x.csv", f"h\n{n}\n")
    staged = Z.stage_zip_csv(Z.list_zips(spark, str(tmp_path)), str(tmp_path / "staging")).collect()
    assert len({r.staged_path for r in staged}) == 2
    got = spark.read.option("header", True).csv(str(tmp_path / "staging")).collect()
    assert sorted(r.h for r in got) == ["a", "b"]


def test_one_bad_count_and_a_doubled_source_stay_alone(spark):
    from tierlake.operators.recon import ReconSource, local_counts, reconcile
    t = spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string")
    sources = [ReconSource("all", "t"), ReconSource("kinds", "t", count_expr="count(DISTINCT v)"), ReconSource("bad", "t", count_expr="count(nope)"),
               ReconSource("gone", "u"), ReconSource("twice", "t")]
    counts = spark.createDataFrame([("all", 2000003), ("kinds", 1), ("bad", 1), ("gone", 1), ("twice", 2), ("twice", 2)], "entity_key string, source_count long")
    got = {r.entity_name: r for r in reconcile(sources, local_counts(sources, {"t": t}), counts).collect()}
    assert {k: r.status for k, r in got.items()} == {"all": "VARIANCE", "kinds": "OK", "bad": "ERROR", "gone": "ERROR", "twice": "ERROR"}
    assert len(got) == 5 and got["all"].local_count == 2
