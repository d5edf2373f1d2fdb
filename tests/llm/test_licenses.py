import duckdb
from pyspark.sql import functions as F

from tierlake.llm import licenses
from tierlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_matches_the_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cur = con.execute(licenses.ORACLE)
    names = [c[0] for c in cur.description]
    want = sorted([tuple(r) for r in cur.fetchall()], key=str)
    got = sorted([tuple(r) for r in QUERIES["op6_licenses"](spark, SF).select(*names).collect()], key=str)
    assert got == want and any(r[3] == "header" for r in got)


def test_headers_files_and_nearest_ancestor(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3
    rows = [(1, "Released under the MIT License.", "a/LICENSE"), (2, words, "a/b/c/x.txt"), (3, "Licensed under the Apache License, Version 2.0.", "a/b/LICENSE"),
            (4, f"{words}\nlicensed under the GNU General Public License version 3\n{words}", "a/b/y.txt"), (5, words, "a/z.txt"), (6, words, "q/z.txt"), (7, None, "a/b/c"),
            (None, words, "a/w"), (9, words, None), (2, words, "a/b/c/x.txt"), (10, "MIT " + words * 2000, "r/s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string").withColumn("license", F.lit("x")).withColumn("key", F.lit(1))
    got = sorted(((r.doc_id, r.license, r.found, r.license_dir) for r in licenses.scan(df, F.col("path")).collect()), key=str)
    assert got == sorted([(1, "MIT", "header", None), (2, "Apache-2.0", "inherited", "a/b"), (3, "Apache-2.0", "header", None), (4, "GPL-3.0", "header", None),
                          (5, "MIT", "inherited", "a"), (6, None, None, None), (7, "Apache-2.0", "inherited", "a/b"), (None, "MIT", "inherited", "a"), (9, None, None, None),
                          (2, "Apache-2.0", "inherited", "a/b"), (10, None, None, None)], key=str)
    assert licenses.scan(df.limit(0), F.col("path")).count() == 0
