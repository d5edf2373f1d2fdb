from pyspark.sql import functions as F
from pyspark.sql import Window

from tierlake.operators import upsert as U
from tierlake.operators.dedup import latest_per_key
from tierlake.operators.preview import change_preview, distinct_key_count
from conftest import rows

FINAL = [(1, "a", 10), (2, "b", 20), (3, "c", None), (None, "n", 0)]
SRC = [(2, "B", None), (4, "d", 40), (None, "m", 1), (3, "c", None)]
SCHEMA = "k int, v string, x int"


def test_upsert_full_row(spark):
    f, s = spark.createDataFrame(FINAL, SCHEMA), spark.createDataFrame(SRC, SCHEMA)
    out = U.upsert(f, s, ["k"])
    # NULL keys never match: the final NULL row stays and the source NULL row is inserted
    assert rows(out) == rows(spark.createDataFrame(
        [(1, "a", 10), (2, "B", None), (3, "c", None), (4, "d", 40), (None, "n", 0), (None, "m", 1)], SCHEMA))


def test_upsert_twice_is_once(spark):
    f = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], SCHEMA)
    s = spark.createDataFrame([(2, "B", 21), (4, "d", 40)], SCHEMA)
    once = U.upsert(f, s, ["k"])
    twice = U.upsert(once, s, ["k"])
    assert rows(once) == rows(twice)


def test_preserve_null_and_partial(spark):
    f, s = spark.createDataFrame(FINAL, SCHEMA), spark.createDataFrame(SRC, SCHEMA)
    pn = U.upsert_preserve_null(f, s, ["k"])
    got = {r.k: (r.v, r.x) for r in pn.collect() if r.k is not None}
    assert got == {1: ("a", 10), 2: ("B", 20), 3: ("c", None), 4: ("d", 40)}
    part = U.merge_columns(f, s.select("k", "v"), ["k"], update_cols=["v"])
    got = {r.k: (r.v, r.x) for r in part.collect() if r.k is not None}
    assert got == {1: ("a", 10), 2: ("B", 20), 3: ("c", None), 4: ("d", None)}


def test_composite_key_null_part_never_matches(spark):
    sch = "a int, b string, v int"
    f = spark.createDataFrame([(1, "x", 1), (1, None, 2)], sch)
    s = spark.createDataFrame([(1, "x", 10), (1, None, 20)], sch)
    out = U.upsert(f, s, ["a", "b"])
    assert sorted(r.v for r in out.collect()) == [2, 10, 20]


def test_check_unique(spark):
    import pytest
    s = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "d", 4)], SCHEMA)
    with pytest.raises(U.DuplicateKeyError):
        U.check_unique(s, ["k"])
    U.check_unique(s.where("k is null or v = 'a'"), ["k"])


def test_dense_sequence_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").alias("s"))
    got = U.dense_sequence(df, ["k", "s"], start=100, name="sid")
    ref = df.withColumn("sid", 100 + F.row_number().over(Window.orderBy("k", "s")))
    assert rows(got, "k", "s", "sid") == rows(ref, "k", "s", "sid")


def test_surrogate_upsert(spark):
    f = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, None, "n")], "id bigint, k int, v string")
    s = spark.createDataFrame([(20, "B", 2), (30, "c", 1), (None, "m", 3), (15, "z", 4)],
                              "k int, v string, _seq bigint")
    out = U.upsert_surrogate(f, s, ["k"], "id", "_seq")
    assert rows(out, "id", "k", "v") == rows(spark.createDataFrame(
        [(1, 10, "a"), (2, 20, "B"), (3, None, "n"), (4, None, "m"), (5, 15, "z"), (6, 30, "c")],
        "id bigint, k int, v string"))


def test_fold_pages(spark):
    pages = spark.createDataFrame([
        (1, 1, 7, "a", "x"), (1, 2, 8, "b", None),
        (2, 1, 7, "c", None), (2, 2, 9, "d", "y")], "page_no int, _seq int, k int, v string, dff string")
    out = U.fold_pages(pages, ["k"], preserve_null_cols=["dff"])
    assert {r.k: (r.v, r.dff) for r in out.collect()} == {7: ("c", "x"), 8: ("b", None), 9: ("d", "y")}


def test_preview_counts_and_properties(spark):
    final = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3), (5, "e", 5)], SCHEMA)
    staged = spark.createDataFrame([
        (1, "a", 1, 1), (2, "B", 2, 2), (3, None, 3, 3), (4, "d", 4, 4), (4, "d2", 4, 5), (None, "z", 0, 6)],
        "k int, v string, x int, _seq int")
    dd = latest_per_key(staged, ["k"], [F.col("_seq").desc()])
    c = change_preview(dd, final, ["k"], ["v", "x"]).first()
    # keys 4 and NULL are new; 1, 2, 3 matched; 1 and 3 unchanged (NULL-safe)
    assert (c.new_count, c.matched_count, c.changed_count, c.unchanged_count) == (2, 3, 1, 2)
    assert c.unchanged_count <= c.matched_count
    assert distinct_key_count(staged, ["k"]).first()[0] == 4
    merged = U.upsert(final, dd.drop("_seq"), ["k"])
    again = change_preview(dd, merged, ["k"], ["v", "x"]).first()
    assert again.new_count == 1 and again.changed_count == 0   # only the NULL key stays "new"
    keys = [r.k for r in merged.collect() if r.k is not None]
    assert len(keys) == len(set(keys))


def test_merge_on_read_matches_copy_on_write(spark, tmp_path):
    from tierlake.sources.store import SnapshotTable
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(SCHEMA)
    mor = SnapshotTable(spark, str(tmp_path / "mor"), schema, keys=["k"], max_deltas=3)
    cow = SnapshotTable(spark, str(tmp_path / "cow"), schema)
    batches = [[(1, "a", 1), (2, "b", 2), (None, "n", 0)], [(2, "B", 3), (3, "c", None)],
               [(1, "A", 5), (None, "m", 1)], [(4, "d", 4), (3, "C", 6)]]
    for b in batches:
        src = spark.createDataFrame(b, SCHEMA)
        touched = mor.read().join(src.select("k"), ["k"], "left_semi")
        mor.publish_delta(U.upsert(touched, src, ["k"]))
        cow.publish(U.upsert(cow.read(), src, ["k"]))
        assert rows(mor.read()) == rows(cow.read())
    st = mor.state()
    assert len(st["deltas"]) < 3          # compaction folded the deltas into a base


def test_newest_wins_is_order_independent(spark):
    order = [F.col("x").desc_nulls_last(), F.col("v").asc()]
    b1 = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], SCHEMA)
    b2 = spark.createDataFrame([(1, "z", 3), (2, "c", 9), (3, "d", 0)], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    one_way = U.upsert_newest(U.upsert_newest(empty, b1, ["k"], order), b2, ["k"], order)
    other_way = U.upsert_newest(U.upsert_newest(empty, b2, ["k"], order), b1, ["k"], order)
    assert rows(one_way) == rows(other_way) == [(1, "a", 5), (2, "c", 9), (3, "d", 0)]
