import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierlake.plans import rest_datasets as RD
from tierlake.plans.registry_sync import REGISTRY_SCHEMA, SEGMENT_VALUE_FIELDS, RegistrySync, declared_items, registry_table
from tierlake.sources.store import SnapshotTable

T1, T2, T3 = dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 10), dt.datetime(2026, 3, 11)
ROWS = [("a_inc", "B name", "GL", "LastUpdateDate", "INCREMENTAL", "Y", None), ("b_full", "A name", "GL", None, "FULL_ONLY", "Y", None),
        ("c_code", "C name", "FIN", None, "CODE_BASED", "Y", "load"), ("d_off", "D", "FIN", None, "FULL_ONLY", "N", None)]


def items(spark, rows, date="lastupdatedate"):
    return spark.createDataFrame([(1, k, *r) for k, r in enumerate(rows)], f"_page int, _seq int, resource_key string, value int, {date} timestamp_ntz")


def test_registry_rows_are_shipped(spark):
    got = registry_table(spark)
    assert got.count() == 20 and got.select("module_static_id").distinct().count() == 20
    assert got.where("sync_type = 'FULL_ONLY'").count() == 2 and got.where("sync_type = 'CODE_BASED' and loader is not null").count() == 2


def test_two_runs_and_a_failing_source(spark, tmp_path):
    s = RegistrySync(spark, str(tmp_path))
    reg = spark.createDataFrame(ROWS, REGISTRY_SCHEMA)
    first = items(spark, [("k1", 1, T1), ("k2", 1, T1), ("k1", 2, T1)])
    order = []
    s.sync_all(reg, lambda n: order.append(n) or first, "r1", T1)
    assert order == ["c_code", "b_full", "a_inc"]                       # by module, then name
    second = items(spark, [("k1", 9, T1 - dt.timedelta(days=3)), ("k2", 3, T1 - dt.timedelta(days=1)), ("k3", 4, T2)])

    def landed(name):
        if name == "c_code":
            return items(spark, [("k1", 5, T2)], date="other")         # its date field is gone
        return second
    with pytest.raises(RD.SyncErrors, match="c_code"):
        s.sync_all(reg, landed, "r2", T2)
    rows = lambda n: {r.resource_key: r.value for r in s.table(n).read().collect()}
    assert rows("a_inc") == {"k1": 2, "k2": 3, "k3": 4}                 # k1 is older than the window
    assert rows("b_full") == {"k1": 9, "k2": 3, "k3": 4}
    assert rows("c_code") == {"k1": 2, "k2": 1}
    assert (s.last_sync("a_inc"), s.last_sync("c_code")) == (T2, T1)    # the failed window is read again next time
    log = {(r.run_id, r.module_static_id): (r.status, r.rows_merged, r.window_start) for r in s.runs().collect()}
    assert log["r2", "a_inc"] == ("SUCCESS", 2, T1 - dt.timedelta(days=2))
    assert log["r2", "c_code"][0] == "ERROR" and log["r1", "c_code"] == ("SUCCESS", 2, None) and len(log) == 6
    again = s.sync_all(reg, lambda n: items(spark, [("k1", 6, T2)]), "r3", T3)
    assert {o.module_static_id: o.status for o in again} == {"c_code": "SUCCESS", "b_full": "SUCCESS", "a_inc": "SUCCESS"}
    assert rows("c_code") == {"k1": 6, "k2": 1}


def test_a_crash_between_sources_skips_and_repeats_nothing(spark, tmp_path, monkeypatch):
    s = RegistrySync(spark, str(tmp_path))
    reg = spark.createDataFrame(ROWS[:2], REGISTRY_SCHEMA)
    s.sync_all(reg, lambda n: items(spark, [("k1", 1, T1)]), "r1", T1)
    commit = SnapshotTable._commit

    def dies(self, st):
        if self.root.endswith("a_inc"):
            raise KeyboardInterrupt                                     # the driver goes down before the commit
        return commit(self, st)
    monkeypatch.setattr(SnapshotTable, "_commit", dies)
    new = items(spark, [("k1", 2, T2)])
    with pytest.raises(KeyboardInterrupt):
        s.sync_all(reg, lambda n: new, "r2", T2)
    monkeypatch.undo()
    assert s.last_sync("b_full") == T2 and s.last_sync("a_inc") == T1
    assert [r.value for r in s.table("a_inc").read().collect()] == [1]
    done = {o.module_static_id: o.status for o in s.sync_all(reg, lambda n: new, "r2", T2)}
    assert done == {"b_full": "DONE BEFORE", "a_inc": "SUCCESS"}
    assert s.last_sync("a_inc") == T2 and [r.value for r in s.table("a_inc").read().collect()] == [2]


def test_segment_values_from_pages(spark):
    schema = RD.field_schema(SEGMENT_VALUE_FIELDS)
    body = '{"items": [{"ValueId": 5, "Value": "100", "StartDateActive": "2026-01-02", "LastUpdateDate": "2026-03-09T18:31:43+00:00"}, {"Value": "no id"}]}'
    pages = spark.createDataFrame([(1, body)], "page_no bigint, b string").select(
        "page_no", F.from_json("b", "items array<" + schema.simpleString() + ">").alias("e")).select("page_no", "e.items")
    got = declared_items(pages, "ValueId").collect()
    assert [(r.resource_key, r["value"], r.startdateactive) for r in got] == [("5", "100", "2026-01-02")]
    typed = pages.select(F.explode("items").alias("i")).select("i.*").select(*RD.typed_fields(SEGMENT_VALUE_FIELDS)).first()
    assert typed.startdateactive == dt.date(2026, 1, 2) and typed.lastupdatedate == dt.datetime(2026, 3, 9, 18, 31, 43)
