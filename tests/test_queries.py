"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

from tierlake.queries import ORACLE_SQL, QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert digest(got) == digest(exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]


def test_file_stream_replay_is_idempotent(spark, tmp_path):
    from pyspark.sql import functions as F
    from tierlake.sources.store import SnapshotTable
    from tierlake.streaming.file_ingest import ingest_files
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(4).write.parquet(str(tmp_path / "inbox"))
    order = [F.col("ts").desc_nulls_last(), F.col("event_id").asc()]
    target = SnapshotTable(spark, str(tmp_path / "final"), schema=ev.schema, keys=["user_id"], max_deltas=3)
    ingest_files(spark, str(tmp_path / "inbox"), ev.schema, target, ["user_id"], order,
                 checkpoint=str(tmp_path / "ck"), max_files_per_trigger=1)
    v1 = target.current_version()
    first = sorted(tuple(r) for r in target.read().collect())
    # a restart finds nothing new; a new file with an older duplicate changes nothing
    ev.limit(5).withColumn("ts", F.col("ts") - F.expr("INTERVAL 400 DAYS")) \
        .write.mode("append").parquet(str(tmp_path / "inbox"))
    ingest_files(spark, str(tmp_path / "inbox"), ev.schema, target, ["user_id"], order,
                 checkpoint=str(tmp_path / "ck"))
    assert target.current_version() > v1
    assert sorted(tuple(r) for r in target.read().collect()) == first
