import random

import duckdb
from pyspark.sql import functions as F

from tierlake.llm import linededup as ld


def shingles(line):
    for c in "\t\r\f\v":
        line = line.replace(c, " ")
    w = [x for x in line.lower().split(" ") if x]
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    lines = [(k, (i is not None, i or 0, p), p, shingles(x)) for k, (i, t) in enumerate(rows) for p, x in enumerate((t or "").split("\n"))]
    out = {k: [] for k in range(len(rows))}
    for k, place, p, s in lines:
        if s and any(q < place and r and 5 * len(s & r) >= 4 * len(s | r) for _, q, _, r in lines):
            out[k].append(p)
    return sorted(((i, len((t or "").split("\n")), tuple(out[k])) for k, (i, t) in enumerate(rows)), key=str)


def corpus():
    rnd = random.Random(9)
    vocab = ["w%d" % i for i in range(60)] + ["É", "ñ"]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([2, 5, 8, 30, 60]))] for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            lines.append(rnd.choice([" ", "  ", " \t"]).join(w))
        rows.append((rnd.randrange(10 ** 6), "\n".join(lines)))
    return rows + [(None, "\n".join([" ".join(base[3]), " ".join(base[4]) + " x"])), (-5, None), (7, ""), (8, "\n\n")]


def got(df):
    return sorted(((r.doc_id, r.n_lines, tuple(r.removed_lines)) for r in ld.report(df).collect()), key=str)


def test_matches_brute_force(spark):
    rows = corpus()
    rows.append(rows[3])
    rows.append((rows[4][0], rows[5][1]))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x")).withColumn("pos", F.lit(1))
    assert got(df.repartition(3)) == brute(rows)


def test_matches_the_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(((a, b, tuple(c)) for a, b, c in con.execute(ld.ORACLE).fetchall()), key=str)
    assert got(spark.read.parquet(f"{sf}/documents.parquet")) == want


def test_texts_without_the_removed_lines(spark):
    a, b = "one two three four five six", "zz yy xx ww vv uu tt"
    rows = [(2, f"{a}\nshort\n{b}", 3, "q"), (1, f"{a}\nshort", 4, "r"), (3, None, None, "s"), (4, b, 5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, places string")
    out = ld.deduplicated(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert {tuple(r) for r in out.collect()} == {(1, f"{a}\nshort", 4, "r"), (2, f"short\n{b}", len(f"short\n{b}"), "q"), (3, None, None, "s"), (4, "", 0, None)}


def test_empty_table_and_long_line(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30000))), (2, " ".join(f"w{i}" for i in range(1, 30000)))], "doc_id long, text string")
    assert got(df.limit(0)) == []
    assert got(df) == [(1, 1, ()), (2, 1, (0,))]


def test_words_are_split_once(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = ld._text_lines(df, "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove(") == 1


def test_equal_lines_are_one_row_of_the_join(spark):
    line = "one two three four five six seven"
    df = spark.createDataFrame([(5, f"x\n{line}"), (None, f"{line}\n{line}"), (9, line.upper()), (3, f"{line} eight")], "doc_id long, text string")
    table = ld._class_table(ld._line_table(df, ld.rarity(df), "doc_id", "text")).collect()
    assert sorted((tuple(r["first"]), tuple(r["last"]), r.n, len(r.prefix)) for r in table) == [((ld.NO_ID, 0), (9, 0), 3, 1), ((3, 0), (3, 0), 4, 1)]
    assert got(df) == sorted([(5, 2, (1,)), (None, 2, (1,)), (9, 1, (0,)), (3, 1, ())], key=str)


def test_the_same_shingles_in_another_order(spark):
    rows = [(1, "a b c d e a b c d e"), (2, "b c d e a b c d e a"), (2, "c d e a b c d e a b"), (3, "A B C D E A B C D E A B")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows) == [(1, 1, ()), (2, 1, (0,)), (2, 1, (0,)), (3, 1, (0,))]


def test_only_lines_asked_for_are_cut_into_shingles(spark):
    line = "one two three four five six"
    df = spark.createDataFrame([(1, f"x\n{line}"), (1, "y\nquite other words at the same place"), (None, f"{line} seven")], "doc_id long, text string")
    lines = ld._line_table(df, ld.rarity(df), "doc_id", "text")
    place = lines.where("n = 2 and pos = 1 or doc_id is null").select("class", ld._doc(F.col("doc_id")).alias("doc"), "pos")
    sets = ld._token_sets(df, place, "doc_id", "text")
    assert sorted(len(r.tokens) for r in sets.collect()) == [2, 3]
    plan = sets._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("array_distinct(") < plan.index("LeftSemi")
