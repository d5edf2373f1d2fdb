import random

import numpy as np
from pyspark.sql import functions as F

from tierlake.llm import decontam as d
from tierlake.llm.base import rows_of


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_subsequence_matches_the_table():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randint(0, 20))] for _ in range(2))
        n, answer = d.common_subsequence(a, d.places(b), len(b))
        assert n == lcs(a, b) and answer == n - lcs(a, b[:max(0, len(b) - d.ANSWER)])


def test_windows_cover_every_word():
    counts = np.array([0, 1, 15, 16, 17, 32, 33, 48, 49, 1000])
    firsts = np.cumsum(counts) - counts
    for step in (d.WINDOW // 2, d.WINDOW):
        start, end, owner = d.windows(counts, step)
        for k, n in enumerate(counts):
            mine = [(s - firsts[k], e - firsts[k]) for s, e in zip(start[owner == k], end[owner == k])]
            assert set().union(*[range(s, e) for s, e in mine]) == set(range(n)) if n else not mine


def corpus():
    rnd = random.Random(5)
    vocab = [a + b for a in ("ka", "lo", "mi", "ru", "te", "so", "vi", "nu") for b in ("ban", "dor", "fil", "gum", "hep", "jat", "kos", "lin", "mur")]
    common = ["the", "of", "and", "to", "in"]
    make = lambda n: [rnd.choice(vocab if rnd.random() < 0.6 else common) for _ in range(n)]
    items = [make(rnd.randint(15, 60)) for _ in range(12)]
    docs, truth = [], set()
    for i in range(120):
        w = make(rnd.randint(20, 300))
        if i % 6 == 0:
            k = rnd.randrange(len(items))
            part = list(items[k])
            if i % 12 == 0:  # paraphrase: some words replaced, one left out, one put in
                for _ in range(len(part) // 6):
                    part[rnd.randrange(len(part) - 6)] = "other"
                del part[3]
                part.insert(7, "extra")
            at = rnd.randrange(len(w))
            w[at:at] = part
            truth.add((i, k))
        docs.append((i, " ".join(w).capitalize() + "."))
    return docs, [(k, " ".join(w).upper() + "!") for k, w in enumerate(items)], truth


def test_copies_and_paraphrases_are_found_and_nothing_else(spark):
    docs, items, truth = corpus()
    docs += [(None, items[0][1]), (500, None), (501, ""), (502, docs[0][1] + " word" * 60000), (0, docs[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("__id", F.lit(1))
    bench = spark.createDataFrame(items + [(99, None), (None, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(df, bench).collect()}
    first = [k for i, k in truth if i == 0]
    assert got == truth | {(None, 0)} | {(502, k) for k in first}
    kept = d.keep_clean(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i is not None and i not in {x for x, _ in got})


def test_short_items_are_found_in_long_documents(spark):
    rnd = random.Random(12)
    vocab = [a + b + c for a in ("ka", "lo", "mi", "ru", "te", "so") for b in ("ban", "dor", "fil", "gum", "hep") for c in ("a", "o", "in", "us", "el")]
    often = [1 / (k + 3) for k in range(len(vocab))]
    docs = [rnd.choices(vocab, often, k=rnd.randint(200, 400)) for _ in range(150)]
    items, truth = [], set()
    for k in range(300):
        w = rnd.choices(vocab, often, k=rnd.randint(6, 14))
        items.append((k, " ".join(w)))
        part = list(w)
        if k % 2:  # a fifth of the words replaced
            for j in rnd.sample(range(len(w) - 2), len(w) // 5):
                part[j] = f"other{j}"
        i = rnd.randrange(len(docs))
        at = rnd.randrange(len(docs[i]))
        docs[i][at:at] = part
        truth.add((i, k))
    # a later copy may have split an earlier one: what the checks accept in the whole text counts
    accepted = set()
    for i, k in truth:
        h, _ = d.word_hashes([" ".join(docs[i]).encode(), items[k][1].encode()], d.Powers())
        text, item = h[:len(docs[i])].tolist(), h[len(docs[i]):].tolist()
        if d.confirmed(text, d.places(item), len(item)):
            accepted.add((i, k))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(accepted) > 250 and not accepted - got


def test_some_passage_has_the_least_shared_words():
    rnd = random.Random(2)
    for _ in range(300):
        size = rnd.randint(1, 120)
        need = -(-int(d.OVERLAP * size * 1000) // 1000)
        long = int(d.STRETCH * size) + 1
        at, n = rnd.randrange(40), 400
        hits = {at + x for x in rnd.sample(range(long), min(need, long))}
        start, end, _ = d.windows(np.array([n]))
        assert max(len(hits & set(range(s, e))) for s, e in zip(start.tolist(), end.tolist())) >= min(d.WINDOW, d.least_shared(size))


def test_shared_words_count_repeats_as_in_both():
    column = np.arange(1, 9, dtype=np.uint64)
    items = [[1, 1, 2], [3], [9 - 1, 2, 2, 2]]
    place, table = d.word_table(items, column)
    passages = [[0, 0, 0, 1], [4, 5], [1, 1, 7, 2]]  # column numbers
    row, col, tf = d._sparse(np.array(sum(passages, [])), np.array([0, 4, 6]), np.array([4, 6, 10]))
    assert d.shared_words(row, col, tf, place, table).tolist() == [[3, 0, 1], [0, 0, 0], [1, 1, 3]]
    assert d.item_blocks([[1]] * 600) == [(0, 256), (256, 512), (512, 600)] and d.item_blocks([]) == []


def test_empty_tables(spark):
    docs, items, _ = corpus()
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert d.contaminated(df.limit(0), bench).count() == 0
    assert d.contaminated(df, bench.limit(0)).count() == 0
    assert d.keep_clean(df, bench.limit(0)).count() == len(docs)


def test_texts_are_read_and_hashed_once(spark, monkeypatch):
    docs, items, truth = corpus()
    seen = []
    monkeypatch.setattr(d, "rows_of", lambda *a: seen.append(a) or rows_of(*a))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminated(df, bench).collect()} == truth
    assert len(seen) == 1


def test_spaced_texts_have_the_same_words():
    for text in ("", " ", "A b-c", "É\u00a0x_y\tZ9.", "\ud800 q", "a\nb", "x" * 9 + "!!" + "ß"):
        (one, n), (two, m) = (d.word_hashes([raw], d.Powers()) for raw in (d.plain(text), d.spaced(text)))
        assert one.tolist() == two.tolist() and n.tolist() == m.tolist()


def test_enough_around_keeps_every_stretch():
    rnd = random.Random(3)
    for _ in range(400):
        size, n = rnd.randint(1, 120), rnd.randint(1, 500)
        long = int(d.STRETCH * size) + 1
        at = rnd.randrange(n)
        stretch = range(at, min(n, at + long))
        need = -(-int(d.OVERLAP * size * 1000) // 1000)
        if len(stretch) < need:
            continue
        hits = set(rnd.sample(stretch, need))
        start, end, _ = d.windows(np.array([n]))
        shared = np.array([len(hits & set(range(a, b))) for a, b in zip(start.tolist(), end.tolist())])
        # other texts stand on both sides of this one
        blank, owner = np.zeros(40, np.int64), np.repeat([3, 5, 6], [40, len(shared), 40])
        around = d.enough_around(np.concatenate((blank, shared, blank)), owner, size)[40:40 + len(shared)]
        assert all(ok for ok, a, b in zip(around, start.tolist(), end.tolist()) if a - long <= at and stretch[-1] < b + long)
        # a text that goes on beyond both ends
        assert d.enough_around(np.zeros(1, np.int64), np.array([7]), size).all()
    assert not d.enough_around(np.zeros(200, np.int64), np.repeat([0, 1], 100), 30)[60:140].any()
