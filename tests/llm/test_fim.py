import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm import fim
from tierlake.llm.queries import op11_fim

SCHEMA = "doc_id long, text string"


def brute(doc_id, text, unit="token", plain=10, spm=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S) if unit == "token" else list(text)
    h = fim.draws(doc_id, 1)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(seed, n):
    r = random.Random(seed)
    alphabet = ["a", "Zq", "word", " ", "\n", "é", "ß", "中", "文", "😀", "<", "P>", "S", ">", "<S", "\x00", "е", "0"]
    return ["".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 3, 30, 400]))) for _ in range(n)]


def test_index_converts_both_ways():
    for t in [*texts(3, 200), "", "中" * 50, "plain ascii"]:
        raw = t.encode()
        index = fim.Exceptions(np.frombuffer(raw, np.uint8))
        at = np.cumsum([0] + [len(c.encode()) for c in t])
        assert index.to_byte(np.arange(len(t) + 1)).tolist() == at.tolist()
        assert index.to_char(at).tolist() == list(range(len(t) + 1))
        assert len(index.byte) == sum(len(c.encode()) > 1 for c in t)


@pytest.mark.parametrize("unit", fim.UNITS)
def test_against_brute_force(spark, unit, monkeypatch):
    monkeypatch.setattr(fim, "AT_ONCE", 700)  # many chunks a batch
    rows = [(i, t) for i, t in enumerate(texts(7, 600))] + [(None, "no id é"), (None, None), (5, None), (5, "repeated"), (5, "repeated"),
                                                             (-3, "中文" * 40_000), (9_000_000_000, "x" * 300_000 + "é" + "y z" * 9)]
    found = fim.transform(spark.createDataFrame(rows, SCHEMA).repartition(3), unit=unit, spm_percent=50)
    got = found.withColumn("back", fim.restored("output", "form")).collect()
    want = [brute(i, t, unit, spm=50) for i, t in rows]
    order = lambda x: (x[0] is None, x[0] or 0, x[5])
    assert sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got), key=order) == sorted(want, key=order)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["back"]) for r in got)) == sorted((i is None, i or 0, t or "") for i, t in rows)
    for r in got:
        if r["form"] == "psm":
            assert r["output"].encode()[3:3 + r["prefix_bytes"]].decode() == r["output"][3:3 + r["prefix_chars"]]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fim.transform(empty).collect() == []
    odd = spark.createDataFrame([(1, "some text", "a", "b", 3)], "doc_id long, text string, form string, output string, n int")
    assert [tuple(r)[:6] for r in fim.transform(odd).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()] == [brute(1, "some text")]
    with pytest.raises(ValueError):
        fim.transform(odd, unit="line")


def test_restoring_nothing(spark):
    got = spark.createDataFrame([(None, "psm"), ("x", None), ("x", "plain")], "output string, form string").select(fim.restored("output", "form").alias("t"))
    assert [r["t"] for r in got.collect()] == [None, None, "x"]


def test_query_holds_all_rows(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got = op11_fim(spark, d)
    both = got.join(docs, "doc_id").where(F.col("restored_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256))
    assert both.count() == docs.count() == got.count()
