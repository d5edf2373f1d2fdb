import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tierlake.llm import mixing
from tierlake.llm.queries import op12_mixing

SCHEMA = "doc_id long, text string, source string"


def h52(*parts):
    text = ":".join("" if p is None else str(p) for p in parts)
    return int(hashlib.sha256(text.encode()).hexdigest()[:13], 16)


def brute_targets(sizes, weights, share, most):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total >= most * sizes[s]}
        if not over:
            break
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out | {s: left * w[s] / sum(w[x] for x in open_) for s in open_}


def fold(units, seed, done):
    """units: [h, doc_id, size, mass, index]; returns the one that goes on."""
    cur = units[0]
    for other in units[1:]:
        i, j = cur, other
        to_i, to_j = min(i[2] - i[3], j[3]), min(i[3], j[2] - j[3])
        if h52(seed, "meet", i[1], i[2], j[1], j[2]) / 2 ** 52 * (to_i + to_j) < to_j:
            if i[2] - i[3] <= j[3]:
                done[i[4]], cur = 1, [*j[:3], j[3] - (i[2] - i[3]), j[4]]
            else:
                done[j[4]], cur = 0, [*i[:3], i[3] + j[3], i[4]]
        elif i[3] <= j[2] - j[3]:
            done[i[4]], cur = 0, [*j[:3], i[3] + j[3], j[4]]
        else:
            done[j[4]], cur = 1, [*i[:3], i[3] - (j[2] - j[3]), i[4]]
    return cur


def brute(rows, weights=(5, 2, 1), share=1.5, most=2, seed=1):
    sized = [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]
    total = defaultdict(int)
    for _, n, s in sized:
        total[s] += n
    target = brute_targets(total, weights, share, most) if rows else {}
    units = Counter(sized)
    done, extra = {}, {}
    classes = defaultdict(list)
    for (i, n, s), m in units.items():
        rate = target[s] / total[s] if total[s] else 0.0
        x = (rate - math.floor(rate)) * m if n else 0.0
        extra[i, n, s] = (math.floor(rate), math.floor(x), x - math.floor(x))
        classes[s, len(f"{n:b}")].append((i, n, s))
    last = defaultdict(list)
    for (s, _), members in classes.items():
        key = "" if s is None else "=" + s
        groups = math.ceil(len(members) / mixing.GROUP)
        level = defaultdict(list)
        for u in members:
            if extra[u][2] > 0:
                h = h52(seed, "deal", key, u[0], u[1])
                level[h % groups].append([h, u[0], u[1], extra[u][2] * u[1], u])
        while level:
            level = {g: fold(sorted(us, key=lambda u: (u[0], u[1] is not None, u[1] or 0, u[2])), seed, done) for g, us in level.items()}
            if groups == 1:
                last[s] += level.values()
                break
            groups, up = math.ceil(groups / mixing.GROUP), defaultdict(list)
            for g, u in level.items():
                up[g // mixing.GROUP].append(u)
            level = up
    for s, us in last.items():
        end = fold(sorted(us, key=lambda u: (-u[2], u[0])), seed, done)
        done[end[4]] = int(h52(seed, "last", "" if s is None else "=" + s, end[1], end[2]) / 2 ** 52 * end[2] < end[3])
    out = []
    for u, m in units.items():
        base, certain, part = extra[u]
        copies = ([base + done[u]] if part > 0 else []) + [base + 1] * certain
        for c in copies + [base] * (m - len(copies)):
            out.append((u[0], u[1], total[u[2]], round(target[u[2]], 6), c * u[1]))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()), key=str)


def some_rows(seed, n):
    r = random.Random(seed)
    sources = ["a", "b", "ä", "中", "Z", None, "tiny", "\U0001F600", "hot", "hot", "hot"]
    rows = []
    for k in range(n):
        words = r.choice([0, 1, 2, 5, 9, 40, r.randint(1, 300)])
        s = r.choice(sources)
        rows.append((k, r.choice([" ", "\n", "  \t"]).join("wé"[k % 2] * r.randint(1, 5) for _ in range(words if s != "tiny" else 1)), s))
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 4)  # several levels
    monkeypatch.setattr(mixing, "RUN", 3)
    rows = some_rows(1, 700) + [(None, "no id", "a"), (None, None, None), (None, "no id", "a")] + [(77, "same row here", "b")] * 41 + [(78, "x " * 150_000, "hot")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(mixing.mix(df.repartition(5)))
    assert got == brute(rows)
    assert got == result(mixing.mix(df.repartition(2, "text")))  # reruns agree, however the rows are dealt


def test_targets_and_bounds(spark):
    rows = some_rows(2, 900)
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA)).withColumn("rate", F.col("target") / F.col("source_size")).collect()
    by = defaultdict(list)
    for r in found:
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        if r["size"]:
            assert math.floor(r["rate"]) <= r["copies"] <= math.floor(r["rate"]) + 1
        by[r["source_size"]].append(r)
    total = sum(r["size"] for r in found)
    assert abs(sum(rs[0]["target"] for rs in by.values()) - 1.5 * total) < 1e-6 * total
    for size, rs in by.items():
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) < max(r["size"] for r in rs) + 1e-6


def test_expectation_is_the_rate(spark):
    rows = [(k, "w " * (1 + k % 7), "s" if k % 3 else "t") for k in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1).cache()
    sums, rate = Counter(), {}
    runs = 12
    for seed in range(runs):
        for r in mixing.mix(df, weights=(3, 1), share=0.7, seed=seed).collect():
            sums[r["doc_id"]] += r["copies"]
            rate[r["doc_id"]] = r["target"] / r["source_size"]
    for s in set(rate.values()):
        of = [sums[i] / runs for i in rate if rate[i] == s]
        assert abs(sum(of) / len(of) - s) < 0.06
        assert all(abs(x - s) < 0.6 for x in of)


def test_empty_wordless_and_clashing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    none = [(1, "", "a"), (2, None, "b"), (2, None, "b"), (3, " \n", None)]
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(spark.createDataFrame(none, SCHEMA)).collect()] == [(0, 0.0, 0)] * 4
    odd = spark.createDataFrame([(1, "a b c", "s", 9, 8, "k", 1.0)], "doc_id long, text string, source string, size int, m int, key string, target double")
    assert result(mixing.mix(odd)) == brute([(1, "a b c", "s")])


def test_no_python_and_whole_table(spark):
    d = "/root/testdata/sf0.001"
    found = op12_mixing(spark, d)
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "source").collect()
    assert result(found) == brute([tuple(r) for r in docs])
