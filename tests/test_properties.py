"""Invariants of the preview and upsert operators on random batches, and hot-key correctness."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierlake.operators.dedup import latest_per_key
from tierlake.operators.preview import change_preview
from tierlake.operators.upsert import fold_pages, upsert

SCHEMA = "k int, v string, x int, s int"
row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None]),
                st.one_of(st.none(), st.integers(0, 2)))


def frame(spark, rows):
    return spark.createDataFrame([(k, v, x, i) for i, (k, v, x) in enumerate(rows)], SCHEMA)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(final_rows=st.lists(row, max_size=8), batch_rows=st.lists(row, max_size=10))
def test_preview_and_upsert_invariants(spark, final_rows, batch_rows):
    # a final table is unique on non-NULL keys by construction
    final = latest_per_key(frame(spark, final_rows).where("k is not null"), ["k"], [F.col("s").desc()]).drop("s")
    batch = latest_per_key(frame(spark, batch_rows), ["k"], [F.col("s").desc()])
    c = change_preview(batch, final, ["k"], ["v", "x"]).first()
    distinct_keys = batch.select("k").distinct().count()
    assert c.new_count + c.matched_count == distinct_keys
    assert 0 <= c.unchanged_count <= c.matched_count
    src = batch.drop("s").where("k is not null")       # NULL keys are quarantined by the flow
    once = upsert(final, src, ["k"])
    twice = upsert(once, src, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)
    # a NULL key never matches (MERGE semantics): such a row is inserted again by every run
    nulls = batch.drop("s").where("k is null")
    if nulls.count():
        again = upsert(upsert(final, nulls, ["k"]), nulls, ["k"])
        assert again.where("k is null").count() == 2 * nulls.count()
    keys = [r.k for r in once.collect() if r.k is not None]
    assert len(keys) == len(set(keys))
    after = change_preview(batch.where("k is not null"), once, ["k"], ["v", "x"]).first()
    assert after.new_count == 0 and after.changed_count == 0


def test_hot_key_dedup_and_fold_match_brute_force(spark):
    n = 30_000
    # key 0 holds a third of all rows
    pdf = pd.DataFrame({"k": [0 if i % 3 == 0 else i for i in range(n)], "ts": [(i * 7919) % 10007 for i in range(n)],
                        "seq": range(n), "val": [None if i % 5 == 0 else i for i in range(n)]})
    df = spark.createDataFrame(pdf).repartition(8)
    got = {r.k: (r.ts, r.seq) for r in latest_per_key(df, ["k"], [F.col("ts").desc(), F.col("seq").asc()]).collect()}
    exp = pdf.sort_values(["ts", "seq"], ascending=[False, True]).groupby("k").head(1)
    assert got == {r.k: (r.ts, r.seq) for r in exp.itertuples()}
    pages = df.withColumn("page_no", (F.col("seq") / 100).cast("int")).withColumnRenamed("seq", "_seq")
    folded = {r.k: r.val for r in fold_pages(pages, ["k"], preserve_null_cols=["val"]).collect()}
    nn = pdf.dropna(subset=["val"]).sort_values("seq").groupby("k").tail(1).set_index("k")["val"]
    assert folded[0] == nn.loc[0]
    assert all(folded[k] == (nn.loc[k] if k in nn.index else None) for k in list(folded)[:500])
