"""Records with quoted line breaks, found by many tasks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from tierlake.sources.landing import MissingColumnsError, read_landing_csv
from tierlake.sources.split_csv import UnpairedQuotes, read_split_csv

HEADER = ["ID", "NOTE", "More, text"]


@pytest.fixture()
def tiny_splits(spark):
    held = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k in held:
        spark.conf.unset(k)


def write(path, rows, end="\n", quote=csv.QUOTE_MINIMAL):
    text = io.StringIO()
    w = csv.writer(text, lineterminator=end, quoting=quote)
    w.writerow(HEADER)
    w.writerows(rows)
    path.write_bytes(text.getvalue().encode())


def some_rows(seed, n, start=0):
    r = random.Random(seed)
    parts = ["a", "b c", '"', '""', "\n", "\n\n", ",", "é", "x" * 40, "\r\n", "中\n文", "'", "line\n" * 30]
    return [[str(start + k), "".join(r.choice(parts) for _ in range(r.randint(0, 5))), r.choice(["", "z", '"q"\n'])] for k in range(n)]


def read(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: int(t[0]))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_csv_module_over_many_splits(spark, tmp_path, tiny_splits, end):
    rows = []
    for k in range(3):
        part = some_rows(k, 120, 1000 * k)
        rows += part
        write(tmp_path / f"f{k}.csv", part, end, csv.QUOTE_ALL if k == 1 else csv.QUOTE_MINIMAL)
    found = read_landing_csv(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 50
    got = read(found.drop("_seq"))
    assert got == [tuple(v or None for v in r) for r in rows]
    order = [r["ID"] for r in found.orderBy("_seq").collect()]
    assert order == [r[0] for r in rows]     # arrival order across splits


def test_one_value_over_many_splits(spark, tmp_path, tiny_splits):
    rows = [["1", "short", "x"], ["2", "long\n" * 500, "y"], ["3", "", "z\n"], ["4", 'say ""\n"', "end"]]
    write(tmp_path / "a.csv", rows)
    assert read(read_landing_csv(spark, str(tmp_path / "a.csv"), required=["id", "note", "MORE, TEXT"]).drop("_seq")) == [tuple(v or None for v in r) for r in rows]


def test_plain_files_take_sparks_reader(spark, tmp_path):
    write(tmp_path / "a.csv", [["1", "a,b", 'q"q'], ["2", "", ""]])
    found = read_split_csv(spark, str(tmp_path / "a.csv"))
    assert "ArrowEvalPython" not in found._jdf.queryExecution().toString()
    assert read(found.drop("_seq")) == [("1", "a,b", 'q"q'), ("2", None, None)]


def test_faults_are_told(spark, tmp_path):
    (tmp_path / "open.csv").write_text('ID,NOTE\n1,"never closed\n2,x\n')
    with pytest.raises(UnpairedQuotes):
        read_split_csv(spark, str(tmp_path / "open.csv"))
    write(tmp_path / "a.csv", [["1", "x\ny", "z"]])
    with pytest.raises(MissingColumnsError):
        read_landing_csv(spark, str(tmp_path / "a.csv"), required=["ID", "NOWHERE"])
    (tmp_path / "b.csv").write_text('NOTE,ID,"More, text"\n"p\nq",2,3\n')
    with pytest.raises(Exception, match="another header"):
        read_split_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_blank_lines_and_wrong_widths(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,NOTE\n\n1,"x\n\ny"\n  \n2,z\n')
    assert read(read_split_csv(spark, str(tmp_path / "a.csv")).drop("_seq")) == [("1", "x\n\ny"), ("2", "z")]
    (tmp_path / "b.csv").write_text('ID,NOTE\n1,"x\ny"\n2,z,too many\n')
    with pytest.raises(Exception):
        read_split_csv(spark, str(tmp_path / "b.csv")).agg(F.count("NOTE")).collect()
