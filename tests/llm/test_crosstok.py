import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tierlake.llm import crosstok
from tierlake.llm.queries import BYTE_MODEL, PIECE_MODEL, op13_alignment

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def sides():
    with open(BYTE_MODEL, "rb") as a, open(PIECE_MODEL, "rb") as b:
        return crosstok.Sides(a.read(), b.read())


def spans(tokens, ids):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(tokens[i]), i))
        at += len(tokens[i])
    return out


def brute_doc(sides, text):
    """Token counts, groups and linked id pairs of one text, pair by pair."""
    if not text:
        return 0, 0, [], []
    a = sides.a.encode(" " + text, add_special_tokens=False).ids
    b = sides.b.encode(text)
    raw = b" " + text.encode()
    if b"".join(sides.a_bytes[i] for i in a) != raw or b"".join(sides.b_bytes[i] for i in b) != raw:
        return 0, 0, [], []
    a_spans, b_spans = spans(sides.a_bytes, a), spans(sides.b_bytes, b)
    ends = sorted({x[1] for x in a_spans} & {x[1] for x in b_spans})
    groups, lo = [], 0
    for hi in ends:
        groups.append(([x[2] for x in a_spans if lo < x[1] <= hi], [x[2] for x in b_spans if lo < x[1] <= hi]))
        lo = hi
    return len(a), len(b), groups, [(x[2], y[2]) for x in a_spans for y in b_spans if x[1] == y[1]]


def brute(sides, rows):
    docs = [(i, *brute_doc(sides, t)) for i, t in rows]
    counts = Counter(p for d in docs for p in d[4])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, n_a, n_b, groups, pairs in docs:
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, n_a, n_b, len(groups), len(pairs), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(said.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=str)


def some_rows(seed, n):
    r = random.Random(seed)
    parts = ["the ", "token", "ization", " ", "  ", "\n", "é", "中文", "😀", "123", "'s ", "<|endoftext|>", "<s>", "<0x41>", "\t", "naïve ", "Übergröße", ".", " ", "é"]
    rows = [(k, "".join(r.choice(parts) for _ in range(r.choice([1, 2, 8, 60])))) for k in range(n)]
    return rows + [(None, "no id"), (None, None), (1005, ""), (1006, None), (1007, "same row"), (1007, "same row"), (1008, "bad ▁ piece"), (1009, " lead"), (1010, "\x00 zero")]


def test_against_brute_force(spark, sides, monkeypatch):
    rows = some_rows(1, 250)
    monkeypatch.setattr(crosstok, "AT_ONCE", 500)
    got = crosstok.align(spark.createDataFrame(rows, SCHEMA).repartition(3), BYTE_MODEL, PIECE_MODEL).collect()
    want = brute(sides, rows)
    assert sorted(map(tuple, got), key=str) == want
    zero = {r["doc_id"]: r for r in got if r["doc_id"] in (1005, 1006, 1008)}
    assert all(tuple(zero[i])[1:] == (0, 0, 0, 0, 0, 0, "") for i in (1005, 1006, 1008))


def test_overlaps_are_all_overlaps(sides):
    for _, t in some_rows(2, 60):
        n_a, n_b, *_ = brute_doc(sides, t)
        if not n_a:
            continue
        a, b, *_ = sides.encoded([b" " + t.encode()])
        a_size, b_size = sides.a_size[a], sides.b_size[b]
        doc_a, doc_b = np.zeros(len(a), int), np.zeros(len(b), int)
        i, j = crosstok.overlaps(np.cumsum(a_size), a_size, doc_a, np.cumsum(b_size), b_size, doc_b)
        want = {(k, m) for k, x in enumerate(spans(sides.a_bytes, a)) for m, y in enumerate(spans(sides.b_bytes, b)) if max(x[0], y[0]) < min(x[1], y[1])}
        assert len(i) == len(want) and set(zip(i.tolist(), j.tolist())) == want


def test_units_give_the_same_ids(sides, monkeypatch):
    r = random.Random(4)
    words = ["the", "größe", "中文", "a", "x1", "token's", "\n\n", " ", "  ", "-", "a\u00a0", "b\u3000", "c\u2009", "\u0085", "\u200b", "d\x7f", "слово", "e\x1c", "'s", "'", "9", "\t"]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([1, 5, 3000]))) + r.choice(["", "z" * 3000, " ", " "]) for _ in range(40)]
    want = [(sides.a.encode(" " + t, add_special_tokens=False).ids, sides.b.encode(t)) for t in texts]
    monkeypatch.setattr(crosstok, "LOT", 50)
    monkeypatch.setattr(crosstok, "MOST_KNOWN", 10)
    for _ in range(2):
        a, b, a_n, b_n = sides.encoded([b" " + t.encode() for t in texts])
        assert [x.tolist() for x in np.split(a, np.cumsum(a_n)[:-1])] == [x for x, _ in want]
        assert [x.tolist() for x in np.split(b, np.cumsum(b_n)[:-1])] == [y for _, y in want]


def test_linkable_pairs_bound(sides):
    pairs = sides.linkable()
    assert len(pairs) <= sides.a_size.sum() * 2 + sides.b_size.sum() * 2
    for p in random.Random(1).sample(pairs.tolist(), 300):
        x, y = sides.a_bytes[p // len(sides.b_bytes)], sides.b_bytes[p % len(sides.b_bytes)]
        assert x.endswith(y) or y.endswith(x)


def test_empty_and_clashing(spark, sides):
    assert crosstok.align(spark.createDataFrame([], SCHEMA), BYTE_MODEL, "file://" + PIECE_MODEL).collect() == []
    odd = spark.createDataFrame([(1, "some text", 7, "x")], "doc_id long, text string, links int, groups_sha256 string")
    assert [tuple(r) for r in crosstok.align(odd, BYTE_MODEL, PIECE_MODEL).collect()] == brute(sides, [(1, "some text")])
    nothing = spark.createDataFrame([(1, None), (2, "")], SCHEMA)
    assert [tuple(r)[1:] for r in crosstok.align(nothing, BYTE_MODEL, PIECE_MODEL).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_query(spark, sides):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    got = {r["doc_id"]: r for r in op13_alignment(spark, d).collect()}
    assert len(got) == len(rows)
    for i, t in sorted(rows, key=lambda r: len(r[1]))[:60]:
        n_a, n_b, groups, pairs = brute_doc(sides, t)
        assert (got[i]["n_a"], got[i]["n_b"], got[i]["n_groups"], got[i]["n_links"]) == (n_a, n_b, len(groups), len(pairs))
