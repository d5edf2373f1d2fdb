"""The snapshot store: files that are opened, carried over and refused."""

import random

import pytest
from pyspark.sql import functions as F

from tierlake.sources.store import SLOT, SnapshotTable, WriteConflict

SCHEMA = "k long, j string, v int"


@pytest.fixture()
def many_files(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set(key, "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def table_of(spark, path, n=8000, **kw):
    t = SnapshotTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, keys=["k", "j"], **kw)
    t.publish(spark.range(n).selectExpr("id k", "concat('a', id % 7) j", "cast(id as int) v"))
    return t


def test_small_batch_opens_few_files(spark, tmp_path, many_files):
    t = table_of(spark, tmp_path)
    assert t.state()["files"] == 16 == len(t.read().inputFiles())
    batch = spark.createDataFrame([(5, "a5", 0), (7000, "a0", 0), (7001, "a1", 0), (None, "a1", 0), (-9, "x", 0), (10 ** 9, "x", 0)], SCHEMA)
    m = t.matching(batch)
    assert len(m.inputFiles()) == 2
    keys = batch.select("k", "j")
    assert sorted(map(tuple, m.join(keys, ["k", "j"], "left_semi").collect())) == sorted(map(tuple, t.read().join(keys, ["k", "j"], "left_semi").collect()))
    assert t.matching(batch.where("k < 0")).count() == 0


def test_compaction_carries_untouched_files_over(spark, tmp_path, many_files):
    t = table_of(spark, tmp_path)
    before = set(t._manifest(t.state())["file"])
    t.publish_delta(spark.createDataFrame([(5, "a5", -1), (8001, "q", -2), (None, "n", -3)], SCHEMA))
    t.compact()
    after = set(t._manifest(t.state())["file"])
    assert len(before & after) == 14 and not t.state()["deltas"]
    got = {(r["k"], r["j"]): r["v"] for r in t.read().collect()}
    assert len(got) == 8002 and got[5, "a5"] == -1 and got[8001, "q"] == -2 and got[None, "n"] == -3
    ranges = t._entries(t.state()).orderBy(SLOT).collect()
    assert all(tuple(a["hi"]) < tuple(b["lo"]) for a, b in zip(ranges, ranges[1:]))


def test_random_merges_equal_a_dictionary(spark, tmp_path, many_files):
    r = random.Random(5)
    t = table_of(spark, tmp_path, 300, max_deltas=2, rows_per_file=40)
    want = {(i, f"a{i % 7}"): i for i in range(300)}
    for step in range(5):
        batch = {(r.randint(-50, 400), f"a{r.randint(0, 6)}"): -step - 1 for _ in range(30)}
        want |= batch
        t.publish_delta(spark.createDataFrame([(*k, v) for k, v in batch.items()], SCHEMA))
        assert {(x["k"], x["j"]): x["v"] for x in t.read().collect()} == want
    assert t.state()["carried"] and max(t._manifest(t.state())["rows"]) <= 40


def test_second_writer_is_refused(spark, tmp_path):
    a = table_of(spark, tmp_path, 20)
    b = SnapshotTable(spark, str(tmp_path), keys=["k", "j"])
    b.read()
    row = spark.createDataFrame([(1, "a1", -1)], SCHEMA)
    a.publish_delta(row)
    with pytest.raises(WriteConflict):
        b.publish_delta(row.withColumn("v", F.lit(-2)))
    b.read()
    b.publish_delta(row.withColumn("v", F.lit(-2)))
    assert a.read().where("k = 1").first()["v"] == -2


def test_vacuum_keeps_what_versions_name(spark, tmp_path, many_files):
    t = table_of(spark, tmp_path)
    t.publish_delta(spark.createDataFrame([(5, "a5", -1)], SCHEMA))
    t.compact()
    rows = t.read().count()
    assert t.vacuum(keep=1) and t.read().count() == rows == 8000
    assert t.vacuum(keep=1) == []


def test_maximum_from_the_manifest(spark, tmp_path):
    t = table_of(spark, tmp_path, 50, stat_cols=["v"])
    t.publish_delta(spark.createDataFrame([(1, "a1", 999)], SCHEMA))
    assert t.max_of("v") == 999
    assert SnapshotTable(spark, str(tmp_path / "none"), t.schema, keys=["k", "j"], stat_cols=["v"]).max_of("v") is None


def test_merge_step_opens_touched_files_only(spark, tmp_path, many_files):
    from tierlake.plans.entity_flow import Warehouse, delta_rows
    from tierlake.queries import orders_spec
    from tierlake.operators.preview import change_preview
    wh = Warehouse(spark, str(tmp_path))
    spec, target = orders_spec(), wh.final(orders_spec())
    base = spark.range(4000).select(*[(F.col("id") if f.name == "o_orderkey" else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    target.publish(base)
    batch = target.read().where("o_orderkey between 10 and 12")
    few = target.matching(batch.select(*spec.keys))
    preview = change_preview(batch, few, list(spec.keys), spec.compare_columns())
    assert len(few.inputFiles()) == 1 and len(target.read().inputFiles()) == 16
    assert preview.first().asDict() == {"new_count": 0, "matched_count": 3, "changed_count": 0, "unchanged_count": 3}
    assert delta_rows(batch, few, spec).count() == 3
