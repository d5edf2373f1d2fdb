import random

import numpy as np
from pyspark.sql import functions as F

from tierlake.llm import quality as q
from tierlake.llm.shingles import Powers


def corpus(n=400):
    rnd = random.Random(6)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "vita", "nova", "terra"]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) + rnd.choice(["", "a", "que"]) for _ in range(rnd.randint(5, 120))]
        bad = i % 5 == 0
        text = " ".join(x + rnd.choice(["###", "$$$"]) for x in w) if bad and i % 2 else " ".join([w[0]] * 50) if bad else " ".join(w) + "."
        docs.append((i, text, "w"))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 0 if bad else 1, None))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, good string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    kept = q.keep_selected(df, lab)
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    held = [i for i, *_ in docs if i not in {x[0] for x in labels}]
    assert all((i in ids) == (i % 5 != 0) for i in held)


def test_edge_rows(spark):
    docs, labels = corpus(60)
    docs += [(None, None, "w"), (1000, "", "w"), (1001, None, "w"), (0, docs[0][1], "w"), (2000, "terra nova " * 40000, "w")]
    df = spark.createDataFrame(docs, "doc_id long, text string, w string")
    lab = spark.createDataFrame(labels + [(None, 1, None), (7, None, None), (1, 0, None)], "doc_id long, quality int, text string")
    kept = [r.doc_id for r in q.keep_selected(df, lab).collect()]
    assert 1000 in kept and 1001 in kept and None in kept
    none = lab.limit(0)
    assert q.keep_selected(df, none).count() == len(docs)
    assert q.keep_selected(df.limit(0), lab).count() == 0


def test_kth_largest_is_exact(spark):
    rnd = random.Random(2)
    vals = [rnd.choice([rnd.gauss(0, 1), 0.5, 1e-12 * rnd.random(), 1e9]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "key double")
    for k in (1, 7, 250, 499):
        assert q.kth_largest(df, k) == sorted(vals, reverse=True)[k - 1]
    assert q.kth_largest(df, 500) == float("-inf") and q.kth_largest(df, 0) == float("inf")


def test_cut_and_noise(spark):
    assert q.best_cut(np.array([1.0, 2.0, 8.0, 9.0]), np.array([0, 0, 1, 1])) == 5.0
    assert q.best_cut(np.array([1.0]), np.array([1])) == float("-inf")
    x = np.array([r.g for r in spark.range(20000).select(q.gumbel(F.col("id"), F.lit("t"), 3).alias("g")).collect()])
    assert abs(x.mean() - 0.5772) < 0.05 and abs(x.std() - 1.2825) < 0.05


def test_sampling_follows_the_weights(spark):
    # of two weights that differ by log 3 the larger wins three times in four
    df = spark.range(20000).select((q.gumbel(F.col("id"), F.lit("a"), 1) + float(np.log(3)) > q.gumbel(F.col("id"), F.lit("b"), 1)).alias("w"))
    assert abs(df.where("w").count() / 20000 - 0.75) < 0.02


def test_features_stay_within_a_text():
    powers = Powers()
    one, _ = q.features([b"a b c"], powers)
    two, owner = q.features([b"a b c", b"", b"a b c"], powers)
    assert sorted(one.tolist()) == sorted(two[owner == 0].tolist()) == sorted(two[owner == 2].tolist())


# ------------------------------------------------- the query again in plain Python, text by text
M64 = (1 << 64) - 1


def brute_mix(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & M64
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & M64
    return h ^ h >> 33


def brute_features(text):
    kind = lambda b: 0 if b in b"\t\n\v\f\r " else 1 if b >= 128 or chr(b).isalnum() or b == 95 else 2
    toks, last = [], 0
    for b in text.encode():
        k = kind(b)
        if k and k == last:
            toks[-1].append(b)
        elif k:
            toks.append([b])
        last = k
    h = [brute_mix(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(t)) & M64) for t in toks]
    coded = []
    for i, t in enumerate(toks):
        ups, digits = sum(65 <= b <= 90 for b in t), sum(48 <= b <= 57 for b in t)
        shape = 3 if 2 * digits > len(t) else 2 if ups > 1 and 2 * ups >= len(t) else 1 if ups else 0
        c = h[i] if kind(t[0]) == 2 else brute_mix(shape * 2 + 1)
        coded.append(c + (h[i] in h[max(0, i - 3):i]) * 0x9E3779B97F4A7C15 & M64)
    b = q.BUCKETS
    out = [x % (b // 4) for x in h]
    out += [b // 4 + brute_mix(x * 3 + y * 0xC2B2AE3D27D4EB4F & M64) % (b // 2) for x, y in zip(h, h[1:])]
    return out + [3 * b // 4 + brute_mix(x * 5 + y * 0x165667B19E3779F9 + z * 0x27D4EB2F165667C5 & M64) % (b // 4) for x, y, z in zip(coded, coded[1:], coded[2:])]


def brute_selected(docs, labels, seed):
    import math

    import xxhash
    good = {}
    for i, g in labels:
        if i is not None and g is not None:
            good[i] = min(good.get(i, 1), g)
    feats = [brute_features(t or "") for _, t in docs]
    raw, target = np.zeros(q.BUCKETS), np.zeros(q.BUCKETS)
    for (i, _), f in zip(docs, feats):
        for x in f:
            raw[x] += 1
            target[x] += good.get(i) == 1
    ratio = np.zeros(q.BUCKETS, np.float32)
    b = q.BUCKETS
    for lo, hi in ((0, b // 4), (b // 4, 3 * b // 4), (3 * b // 4, b)):
        prior = (raw[lo:hi] + 1) / (raw[lo:hi] + 1).sum()
        ratio[lo:hi] = np.log((target[lo:hi] + (hi - lo) * prior) / (target[lo:hi].sum() + hi - lo) / prior)
    weight = [sum(float(ratio[x]) for x in f) / (q.NEUTRAL + len(f)) * q.LENGTH for f in feats]
    known = sorted((w, good[i]) for (i, _), w in zip(docs, weight) if i in good)
    # every cut between two labelled weights, the one with the fewest rows on the wrong side
    best, cut = sum(g == 0 for _, g in known), float("-inf")
    for k in range(1, len(known) + 1):
        wrong = sum(g == 1 for _, g in known[:k]) + sum(g == 0 for _, g in known[k:])
        if wrong < best:
            best, cut = wrong, known[k - 1][0] + 1 if k == len(known) else (known[k - 1][0] + known[k][0]) / 2
    cut = min(0.0, cut)
    keys = []
    for (i, t), w in zip(docs, weight):
        h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
        h = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), h) if i is not None else h
        h = xxhash.xxh64_intdigest((t or "").encode(), h)
        keys.append(w - math.log(-math.log(((h >> 11) + 0.5) / (1 << 53))))
    n = sum(w >= cut for w in weight)
    chosen = sorted(range(len(docs)), key=lambda k: -keys[k])[:n]
    return weight, keys, {k for k in chosen}


def test_query_against_plain_python(spark, tmp_path):
    from tierlake.llm.queries import op3_quality
    rnd = random.Random(9)
    docs, labels = corpus(160)
    rows = [(i, t.replace("sit", "SIT").replace("vita", "v1t4é") + rnd.choice(["", " Nova NOVA nova 2024", "\n", " _x_"])) for i, t, _ in docs]
    rows += [(500, ""), (501, None), (502, "a"), (503, "a b"), (None, "no id")]
    said = [(i, g) for i, g, _ in labels] + [(None, 1), (500, None), (503, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(said, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in op3_quality(spark, str(tmp_path)).collect()}
    weight, keys, chosen = brute_selected(rows, said, 7)
    assert 0 < len(chosen) < len(rows)
    for k, (i, _) in enumerate(rows):
        assert abs(got[i].log_weight - weight[k]) < 1e-3 and abs(got[i].log_weight + got[i].noise - keys[k]) < 1e-3
        assert got[i].selected == (k in chosen)
