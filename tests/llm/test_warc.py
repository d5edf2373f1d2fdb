import base64
import gzip
import hashlib
import os
import random

from pyspark.sql import functions as F

from tierlake.llm import warc
from tierlake.llm.ranges import balanced


def expected(rows):
    pay = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for p in {p for _, p in pay}:
        ids = [i for i, q in pay if q == p]
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        sha = base64.b32encode(hashlib.sha1(p).digest()).decode()
        seen = False
        for i in ids:
            first = i == top and not seen
            seen = seen or first
            out.append((i, len(p), sha, "response" if first else "revisit", None if first else top))
    return sorted(out, key=str)


def run(spark, rows, folder, **kw):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("refers_to", F.lit("x"))
    warc.write(df.repartition(5), folder, **kw)
    got = warc.read(spark, folder).collect()
    assert all(r.sound for r in got)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str)


def rows_for_test():
    rnd = random.Random(2)
    body = ["", "<p>é漢</p>", "x" * 40000, "same"]
    rows = [(i * 37 % 1009, f"http://h/{i}", rnd.choice(body) if i % 3 else f"own {i} " * rnd.randint(1, 400)) for i in range(200)]
    return rows + [(None, None, None), (None, "u\nv", "same"), (rows[0][0], "other", rows[0][2]), (rows[0][0], "other", "different"), (10 ** 15, "far", "same")]


def test_round_trip_revisits_and_edge_rows(spark, tmp_path):
    rows = rows_for_test()
    assert run(spark, rows, f"{tmp_path}/a", shard_bytes=40_000, roll_bytes=9_000) == expected(rows)
    names = sorted(n for n in os.listdir(tmp_path / "a") if n.endswith(".gz"))
    assert len(names) > 5
    data = gzip.decompress((tmp_path / "a" / names[0]).read_bytes())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_files_do_not_depend_on_the_run(spark, tmp_path):
    rows = rows_for_test()
    for k, name in enumerate("bc"):
        df = spark.createDataFrame(rows if k else rows[::-1], "page_id long, url string, html string").repartition(3 + k)
        warc.write(df, f"{tmp_path}/{name}", shard_bytes=30_000, roll_bytes=5_000)
    one, two = ({n: (tmp_path / x / n).read_bytes() for n in os.listdir(tmp_path / x) if n.endswith(".gz")} for x in "bc")
    assert one == two


def test_empty_table_and_all_without_id(spark, tmp_path):
    assert run(spark, [], f"{tmp_path}/e") == []
    assert run(spark, [(None, None, "a"), (None, None, "a"), (None, "x", None)], f"{tmp_path}/n") == expected([(None, None, "a"), (None, None, "a"), (None, "x", None)])


def test_balanced_ranges_cover_every_id_once(spark):
    ids = [0, 1, 2, 10 ** 12] + list(range(5 * 10 ** 6, 5 * 10 ** 6 + 300))
    df = spark.createDataFrame([(i, 10) for i in ids], "id long, size long")
    got = balanced(df, 100)
    assert all(sum(lo <= i < hi for lo, hi in got) == 1 for i in ids)
    assert all(10 * sum(lo <= i < hi for i in ids) <= 100 for lo, hi in got)
