import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tierlake.llm import toxicity as t

BAD = ["idiot", "stupid", "clown", "moron", "trash"]


def corpus(n=600):
    rnd = random.Random(8)
    vocab = ["the", "house", "garden", "river", "stone", "little", "yellow", "mountain", "apple", "book", "street", "sun", "letter"]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(20, 80))]
        if i % 4 == 0:
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(BAD)
        docs.append((i, " ".join(w) + "."))
        labels.append((i, 1, int(i % 4 == 0)))
    return docs, labels


@pytest.fixture(scope="module")
def lm(spark):
    docs, _ = corpus()
    return t.language_model(t.gather(spark.createDataFrame(docs, "doc_id long, text string")))


@pytest.mark.parametrize("written,meant", [("1d10t", "idiot"), ("5tup1d", "stupid"), ("cl0wn", "clown"), ("m0r0n", "moron"), ("tr@$h", "trash"),
                                           ("idiooooot", "idiot"), ("yelllllow", "yellow"), ("st00000ne", "stone"), ("clown", "clown")])
def test_decoding(lm, written, meant):
    assert t.decode(written, lm) == meant


def best_by_enumeration(token, lm):
    from itertools import groupby, product
    runs = [(c, len(list(g))) for c, g in groupby(token)]
    runs = [(c, n) for c, n in runs if t.readings(c)]
    best = None
    for pick in product(*[[(x, k, cost) for x, cost in t.readings(c) for k in ((1, 2) if n > 1 else (1,))] for c, n in runs]):
        s = sum(cost * min(n, 2) + (t.DROP if k < n else 0.0) for (x, k, cost), (c, n) in zip(pick, runs))
        text = "".join(x * k for x, k, _ in pick)
        p, q = t.EDGE, t.EDGE
        for x in text + t.EDGE:
            s += lm.score(p, q, x)
            p, q = q, x
        best = max(best or (s, text), (s, text))
    return best[1]


@pytest.mark.parametrize("token", ["1d10t", "h0u$e", "6arde11", "l3tt3rrr", "a$$1", "t0o0o", "|i1t+le"])
def test_viterbi_is_exact(lm, token):
    assert t.decode(token, lm) == best_by_enumeration(token, lm)


def test_restored_words(lm):
    got = t.restored_words("you  i d i o t  a s.t.u.p.i.d m-o-r-o-n Cl0wn!! 1999 a b", lm, {})
    assert set(BAD) - {"trash"} <= got


@pytest.mark.parametrize("text,words", [("the m o r o n", ["moron"]), ("t h e i d i o t", ["the", "idiot"]), ("the id iot", ["idiot"]), ("i d i o t", ["idiot"]),
                                        ("little mor on house", ["moron"]), ("the s.t.u.p.i.d clown", ["stupid"]), ("the idi ot", ["idiot"]), ("tr a sh", ["trash"]),
                                        (" ".join("thelittleyellowidiotthegardenriverthemountainstreet"), ["idiot", "yellow"]), ("idi" + 50 * "o" + "t", ["idiot"]), ("the i d i o o o o t", ["idiot"])])
def test_separators_are_in_the_lattice(lm, text, words):
    assert set(words) <= t.restored_words(text, lm, {})


def test_written_words_stay_apart(lm):
    assert t.restored_words("the little house, the yellow garden", lm, {}) == {"the", "little", "house", "yellow", "garden"}


def test_held_out_rows_and_edges(spark):
    docs, labels = corpus()
    hidden = [(10001, "the garden 1d10t river cl0wn"), (10002, "the book s t u p i d sun"), (10003, "the river stoooone")]
    docs += hidden + [(None, None), (10004, ""), (10005, "moron " * 50000), (4, docs[4][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("score", F.lit("x"))
    lab = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    rows = t.scored(df, lab).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    by = {r.doc_id: r for r in rows}
    truth = {i: x for i, _, x in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert by[10001].predicted == by[10002].predicted == by[10005].predicted == 1
    assert by[10003].predicted == by[10004].predicted == by[None].predicted == 0
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0.0 for r in t.scored(df, lab.limit(0)).collect())
    assert t.scored(df.limit(0), lab).count() == 0


def test_wide_vocabulary_of_rare_words_that_clean_texts_use_too(spark):
    rnd = random.Random(21)
    vocab = ["the", "house", "garden", "river", "stone", "little", "yellow", "mountain", "apple", "book", "street", "sun", "letter"]
    # no two share their first four letters
    rare = [a + b + c + d for a, b, c, d in zip(*[iter(rnd.choices("bcdfglmnprst", k=4 * 300))] * 4)]
    rare = sorted({w[0] + "aeiou"[k % 5] + w[1:3] + "er" for k, w in enumerate(rare)})
    rare = list({w[:4]: w for w in rare}.values())
    docs, labels = [], []
    for i in range(3000):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(20, 60))]
        toxic = i % 4 == 0
        for _ in range(5 if toxic else int(rnd.random() < 0.5)):
            w[rnd.randrange(len(w))] = rnd.choice(rare)
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows = t.scored(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(r.predicted, labels[r.doc_id][1]) for r in rows if r.held_out]
    assert sum(p for p, y in held if y) >= 0.75 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) <= 0.03 * len(held)


def test_frequent_grams_of_another_script_push_out_none(spark):
    rnd = random.Random(5)
    large = "".join(chr(0x4E00 + rnd.randrange(6000)) for _ in range(230_000))
    docs = spark.createDataFrame([(0, large), (1, large), (2, large), (3, "garden garden")], "doc_id long, text string")
    table = t.chances(t.gather(docs))
    assert table.where("places = 3").count() > 200_000
    lm = t.language_model(t.gather(docs))
    assert "gar" in lm.three and lm.knows("The 9arden!") and not lm.knows(large[:9])
    assert len(lm.three) + len(lm.two) + len(lm.one) <= t.RESIDENT


def test_rare_letters_are_decoded_with_all_grams(spark, monkeypatch):
    rnd = random.Random(6)
    vocab = {"latin": ["the", "house", "garden", "river", "stone"], "greek": ["σπίτι", "κήπος", "ποτάμι", "πέτρα"], "han": ["花園河流", "石頭房子", "太陽書本"]}
    bad = {"latin": "idiot", "greek": "βλάκας", "han": "白癡笨蛋"}
    hidden = {"latin": "1d10t", "greek": "β λ ά κ α ς", "han": "白 癡 笨 蛋"}
    docs, labels = [], []
    for i in range(450):
        kind = list(vocab)[i // 3 % 3]
        w = [rnd.choice(vocab[kind]) for _ in range(25)]
        if i % 2:
            for _ in range(3):
                w[rnd.randrange(25)] = bad[kind] if crc32(str(i).encode()) % 3 != 1 or rnd.random() < 0.5 else hidden[kind]
        docs.append((i, " ".join(w)))
        labels.append((i, i % 2))
    docs += [docs[3], (None, docs[4][1]), (900, None), (901, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")

    def result():
        return sorted(((r.doc_id is None, r.doc_id or 0, r.held_out, round(r.score, 9), r.predicted) for r in t.scored(df, lab).collect()))

    whole = result()
    assert len(whole) == len(docs)
    monkeypatch.setattr(t, "RESIDENT", 110)
    monkeypatch.setattr(t, "GROUP_CHARS", 3000)
    lm = t.language_model(t.gather(df))
    assert lm.letters is not None and not lm.knows("白癡 the") and not lm.knows("花園河流 石頭房子 太陽書本 σπίτι κήπος ποτάμι πέτρα")
    assert result() == whole
    held = [x for x in whole if x[2] and x[1] < 450]
    assert sum(x[4] == x[1] % 2 for x in held) >= 0.95 * len(held)


def test_trigrams_are_those_of_the_plain_words(spark):
    rnd = random.Random(4)
    signs = "ab^ _1²¼ſßéÉΣσς界ы\u0301\n٣\u212a\U0001d400"
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30))) for _ in range(200)] + ["", "a", None, "ΑΣ aΣ"]
    want = {}
    for w in (w for x in texts for w in t.plain_words(x or "")):
        line = f"{t.EDGE}{t.EDGE}{w}{t.EDGE}"
        for k in range(len(w) + 1):
            gram = ord(line[k]) << 42 | ord(line[k + 1]) << 21 | ord(line[k + 2])
            want[gram] = want.get(gram, 0) + 1
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    assert {r.gram: r.n for r in t.gather(df).collect()} == want


TOKEN = re.compile(r"[^\W_]+(?:[@$!|+€£¡]+[^\W_]+)*|[@$|+€£¡!](?=[ \t.\-_*·~]+\w)")


def odd_texts(n):
    rnd = random.Random(3)
    pool = ["the", "idiot", "i", "d", "a", "1d10t", "12", "7", "!", "$", "aaa", "house", "no", "sooo", "é", "東京", "ß", "x_y", "a$b", "½", "tr@$h", "mm", "|"]
    gaps = [" ", " ", " ", "  ", "\n", ", ", ".", "-", "_", "*", "·", "~", " - ", "\t", "\r", "!", "!! ", "$ ", "|"]
    return ["".join(rnd.choice(gaps) * (k == 0 and rnd.random() < .3) + rnd.choice(pool) + rnd.choice(gaps) for k in range(rnd.randint(0, 9))) for _ in range(n)]


def test_tokens_are_those_of_the_pattern():
    for text in odd_texts(3000):
        code = t.np.frombuffer(text.encode("utf-32-le"), t.np.uint32)
        start, end = t._places(text, t._kinds(code))
        assert list(zip(start.tolist(), end.tolist())) == [m.span() for m in TOKEN.finditer(text)], text
        assert t._cut(text, code, start, end) == TOKEN.findall(text), text


def walked(text, lm):
    """The words of a text by a walk over its tokens, one by one."""
    out, word, pending, at = set(), "", [], 0

    def settle(after):
        got = t.decode((" " if word else "") + " ".join(pending) + (" " if after else ""), lm, word[-2:], after[:2])
        *done, rest = (word + got).split(" ")
        out.update(done)
        return rest

    for m in TOKEN.finditer(text):
        x, gap, at = m[0], text[at:m.start()], m.end()
        number = len(x) > 1 and x.isdigit()
        if number or gap.strip(" \t.-_*·~"):
            out.add(settle("") if pending else word)
            word, pending = "", []
        if number:
            continue
        if len(x) == 1 or not x.isalpha() or re.search(r"(.)\1\1", x):
            pending.append(x)
        elif pending:
            word, pending = settle(x) + x, []
        elif word and not t.decode(" ", lm, word[-2:], x[:2]):
            word += x
        else:
            out.add(word)
            word = x
    out.add(settle("") if pending else word)
    return {w for w in out if len(w) > 1}


def test_separators_as_by_a_walk_over_the_tokens(lm):
    cache = {}
    for text in [*odd_texts(2000), "", " ", "a", "the", "!", "! a"]:
        got = t.restored_words(text, lm, cache)
        written = {w for x in TOKEN.findall(text) for w in re.findall(r"[^\W\d_]+", x)}
        assert walked(text, lm) <= got, text
        assert written <= got, text
        odd = {s for x in text.split() for s in (x.strip(t._TRIM), x.strip(t._TRIM + t._SIGNS)) if t.suspicious(s)} | {x for x in written if re.search(r"(.)\1\1", x)}
        assert got <= walked(text, lm) | written | {t.decode(x, lm) for x in odd}, text


def test_word_borders_are_decided_once(lm, monkeypatch):
    seen = []
    monkeypatch.setattr(t, "decode", lambda *a, f=t.decode: (seen.append(a), f(*a))[1])
    t._BORDERS.clear()
    t.restored_words("garden house garden house", lm, {})
    t.restored_words("the garden house", lm, {})
    assert [a[2:] for a in seen] == [("en", "ho"), ("se", "ga"), ("he", "ga")]
