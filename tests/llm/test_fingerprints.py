import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tierlake.llm import fingerprints as fp
from tierlake.llm.shingles import Powers, shingle_hashes


def shingle_set(text, words=5):
    w = text.split()
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def make(n=40):
    rnd = random.Random(4)
    vocab = ["w%d" % i for i in range(300)] + ["é", "漢字"]
    return [" ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 4, 5, 60, 900]))) for _ in range(n)]


def test_hashes_follow_the_shingles():
    texts = make() + ["a b c d e f", "a  b\tc\nd e f", " a b c d e f ", "", "\n"]
    got = shingle_hashes([t.encode() for t in texts], 5, Powers())
    seen = {}
    for t, h in zip(texts, got):
        w = t.split()
        want = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])
        assert len(h) == len(want)
        for s, x in zip(want, h.tolist()):
            assert seen.setdefault(s, x) == x
    assert len(set(seen.values())) == len(seen)


def test_estimates():
    powers = Powers()
    rnd = random.Random(1)
    a = [str(rnd.random()) for _ in range(20000)]
    b = a[:12000] + [str(rnd.random()) for _ in range(8000)]
    ta, tb = " ".join(a), " ".join(b)
    sa, sb = fp.sketches([ta, tb], 5, 256, powers)
    true = len(shingle_set(ta) & shingle_set(tb)) / len(shingle_set(ta) | shingle_set(tb))
    assert abs(fp.resemblance(sa, sb, 256) - true) < 0.12
    assert abs(fp.containment(sa, sb, 256) - 0.6) < 0.15
    assert abs(fp.distinct(sa, 256) / 19996 - 1) < 0.25
    half = fp.sketches([" ".join(a[:10004]), " ".join(a[10000:])], 5, 256, powers)
    assert np.array_equal(fp.merge(half[0], half[1], 256), sa)
    assert np.array_equal(fp.unpack(fp.pack(sa)), sa)


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        m = len(text) // 4
        edited = text[:len(text) - m] + after[:m]
        j = lambda x, y: 1.0 if not x | y else len(x & y) / len(x | y)
        a, b, c = shingle_set(text), shingle_set(edited), shingle_set(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(j(a, b), 9), round(j(a, c), 9)))
    return out


def key(t):
    return (t[0] is not None, t[0] or 0)


def test_neighbours_match_brute_force(spark):
    texts = make()
    rows = [(i * 7 - 50, t) for i, t in enumerate(texts)] + [(None, "one two three four five six seven eight")]
    rows[5] = (rows[5][0], None)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit("x")).withColumn("tail", F.lit(3))
    for size in (1 << 10, 1 << 26):
        got = fp.edited_neighbours(df.repartition(4), k=4096, shard_bytes=size).collect()
        assert sorted([(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got], key=key) == sorted(brute(rows), key=key)


def test_ties_one_row_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "x")], "doc_id long, text string")
    got = fp.edited_neighbours(df).collect()
    assert len(got) == 4 and len({r.fingerprint for r in got}) == 2
    one = fp.edited_neighbours(df.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fp.edited_neighbours(df.limit(0)).count() == 0


def test_merged_sketches(spark):
    texts = make(12)
    df = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, part string")
    parts = fp.sketch(df, k=64).join(df.select("doc_id", "part"), "doc_id")
    got = {r.part: r.fingerprint for r in fp.merged(parts, "part", k=64).collect()}
    powers = Powers()
    for p in "ab":
        want = np.zeros(0, np.uint64)
        for s in fp.sketches([t for i, t in enumerate(texts) if "ab"[i % 2] == p], 5, 64, powers):
            want = fp.merge(want, s, 64)
        assert got[p] == fp.pack(want)
