"""Line deduplication by an exact set-similarity join, with DataFrame functions only.

A line is the set of its word shingles (five words, lower case; a shorter line
is not compared at all).  A line goes when an earlier line, by (doc_id, line
number), has a Jaccard similarity of at least ``NUM / DEN`` = 0.8 with it, no
matter whether that earlier line stays itself.

Tokens are ordered by rarity: a first pass counts all shingles in ``BUCKETS``
hash buckets (every line, one row per bucket and task), and a token sorts by
its bucket's count, then by its hash.  That is one global order, as the prefix
filter needs; shared boilerplate comes last.  Two similar lines share a token
within their prefixes of n - ceil(t n) + 1 tokens (prefix filter); their sizes
differ by at most the factor t (length filter); and for their first shared
token what follows on both sides must suffice (positional filter).  Survivors
are verified on their whole token sets.

Lines of equal words have one class and need no pairs.  A token that many different
lines share never gives all their pairs: each line is first held against the
lines of the earliest document with that token; those that match are settled, and only the others
are held against all earlier lines of the token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.base import discard, let, released, written

WORDS = 5
NUM, DEN = 4, 5
BUCKETS = 1 << 14
BITS = 44
MASK = (1 << BITS) - 1
#: Stands for a missing doc_id: before all others.
NO_ID = -(1 << 63)


def _words(line: Column) -> Column:
    for blank in "\t\r\f\v":
        line = F.replace(line, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(F.lower(line), " "), "")


def _shingle(words: list[Column]) -> Column:
    """A 44-bit hash of ``WORDS`` words."""
    return F.xxhash64(*words).bitwiseAND(F.lit(MASK))


def _shingles(words: Column) -> Column:
    """The hashes of all shingles of a line of at least ``WORDS`` words."""
    return F.slice(F.transform(words, lambda w, i: _shingle([w, *[F.get(words, i + k) for k in range(1, WORDS)]])), F.lit(1), F.size(words) - (WORDS - 1))


def _text_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, pos, words) of the lines with at least ``WORDS`` words; key is a hash of the document's text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return _long_lines(lines, "doc_id", "key", "pos")


def _long_lines(lines: DataFrame, *others: str) -> DataFrame:
    """``words`` of the ``line`` column in its place, of the lines with at least ``WORDS`` words."""
    # exploded, as Spark would repeat the split below a filter on a plain column
    return lines.select(*others, F.explode(F.array(_words(F.col("line")))).alias("words")).where(F.size("words") >= WORDS)


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def rarity(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """An array literal of ``BUCKETS`` ranks by the counts over the shingles of all lines, shifted above a token's hash bits."""
    starts = _text_lines(docs, id_col, text_col).select("words", F.explode(F.sequence(F.lit(0), F.size("words") - WORDS)).alias("i"))
    tokens = starts.select(_shingle([F.get("words", F.col("i") + k) for k in range(WORDS)]).alias("t"))
    got = tokens.groupBy(_bucket(F.col("t")).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most BUCKETS rows
    counts = [0] * BUCKETS
    for r in got:
        counts[r["b"]] = r["n"]
    # the rank among the buckets is enough
    rank = {n: k for k, n in enumerate(sorted(set(counts)))}
    return F.split(F.lit(",".join(str(rank[n] << BITS) for n in counts)), ",").cast("array<long>")


def _class(words: Column) -> Column:
    """Lines of the same words are one class; lines of the same shingles in another order are similar ones of two classes."""
    return F.xxhash64(words)


def _tokens(words: Column, counts: Column) -> Column:
    """The line's tokens in ascending order of rarity count: count rank above the hash bits."""
    # without NULL in its type the array is sorted as plain numbers
    return F.sort_array(F.transform(F.array_distinct(_shingles(words)), lambda t: F.coalesce(F.get(counts, _bucket(t)), F.lit(0).cast("long")).bitwiseOR(t)))


def _line_table(docs: DataFrame, counts: Column, id_col: str, text_col: str) -> DataFrame:
    lines = _text_lines(docs, id_col, text_col).select("doc_id", "key", "pos", _class(F.col("words")).alias("class"), _tokens(F.col("words"), counts).alias("tokens"))
    n = F.size("tokens")
    prefix = n - F.ceil(n * NUM / F.lit(DEN)).cast("int") + 1
    return lines.select("doc_id", "key", "pos", "class", n.alias("n"), F.slice("tokens", F.lit(1), prefix).alias("prefix"))


def _class_table(lines: DataFrame) -> DataFrame:
    """One row per class of equal lines: its first and last (doc, pos), lines without doc_id before all others, and its prefix."""
    place = F.struct(_doc(F.col("doc_id")).alias("doc"), "pos")
    return lines.groupBy("class").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))


def _doc(doc_id: Column) -> Column:
    return F.coalesce(doc_id, F.lit(NO_ID))


def _may_match(x: str, y: str) -> Column:
    """Length and positional filters for a token at ranks xi and yi of lines with xn and yn tokens."""
    xn, yn, xi, yi = (F.col(f"{s}{c}") for s, c in ((x, "n"), (y, "n"), (x, "i"), (y, "i")))
    need = F.ceil((xn + yn) * NUM / F.lit(NUM + DEN))
    return (xn * NUM <= yn * DEN) & (yn * NUM <= xn * DEN) & (1 + F.least(xn - xi - 1, yn - yi - 1) >= need)


def _token_sets(docs: DataFrame, place: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(class, tokens)`` of the classes of ``place(class, doc, pos)``: whole token sets in no order, from the texts.

    The class is known from the words, so only the lines asked for are cut into shingles.
    """
    wanted = place.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "pos") \
        .groupBy("doc_id").agg(F.collect_list("pos").alias("places"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    some = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"])) \
        .select(F.explode(let(F.split("text", "\n"), lambda lines: F.transform("places", lambda p: F.get(lines, p)))).alias("line"))
    # rows that repeat a doc_id have other lines at the same places
    some = _long_lines(some).select(_class(F.col("words")).alias("class"), "words").join(place.select("class"), "class", "left_semi")
    return some.select("class", F.array_distinct(_shingles(F.col("words"))).alias("tokens")).dropDuplicates(["class"])


def matched_classes(docs: DataFrame, classes: DataFrame, counts: Column, id_col: str, text_col: str) -> DataFrame:
    """``(class)`` of the lines whose first occurrence has an earlier similar line of another class."""
    spark = docs.sparkSession
    # a class has a token once, so a token that comes twice is shared
    rows = classes.select(F.posexplode("prefix").alias("i", "token"), "class", "n")
    shared = rows.withColumn("times", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("times > 1").select("token", "class", "n", "i")
    shared = written(shared, "line-shared")
    released(spark)
    crowd = shared.join(classes.select("class", "first.doc", "first.pos"), "class") \
        .withColumn("lead", F.min("doc").over(Window.partitionBy("token")))
    crowd = written(crowd.select("token", "class", "n", "i", "lead", "doc", "pos"), "line-crowd")

    place = crowd.select("class", "doc", "pos").distinct()
    sets = _token_sets(docs, place, id_col, text_col)
    sets = written(sets, "line-sets")
    released(spark)

    earlier = (F.col("ydoc") < F.col("xdoc")) | ((F.col("ydoc") == F.col("xdoc")) & (F.col("ypos") < F.col("xpos")))

    def verified(x: DataFrame, y: DataFrame) -> DataFrame:
        pairs = x.join(y, "token").where(earlier & (F.col("xclass") != F.col("yclass")) & _may_match("x", "y")) \
            .select("xclass", "yclass").distinct()
        both = pairs.join(sets.select(F.col("class").alias("xclass"), F.col("tokens").alias("xs")), "xclass") \
            .join(sets.select(F.col("class").alias("yclass"), F.col("tokens").alias("ys")), "yclass")
        common = F.size(F.array_intersect("xs", "ys"))
        return both.where(common * (NUM + DEN) >= (F.size("xs") + F.size("ys")) * NUM).select(F.col("xclass").alias("class")).distinct()

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("token", *[F.col(c).alias(f"{name}{c}") for c in ("class", "n", "i", "doc", "pos")])

    settled = written(verified(side(crowd, "x"), side(crowd.where("doc = lead"), "y")), "line-settled")
    open_ = crowd.join(settled, "class", "left_anti")
    rest = written(verified(side(open_, "x"), side(crowd.where("doc > lead"), "y")), "line-rest")
    return settled.union(rest)


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, key, pos)`` of every line that goes; ``key`` is the xxhash64 of the document's text, ``pos`` counts from 0.

    Lines of fewer than five words are never removed.  NULL and empty texts have
    no lines.  Rows that repeat a doc_id are at the same place: their lines are
    not earlier than each other, so the repeats of a row share its fate.  Rows
    without doc_id come before all others.
    """
    spark = docs.sparkSession
    counts = rarity(docs, id_col, text_col)
    whole = written(_line_table(docs, counts, id_col, text_col), "lines")
    classes = written(_class_table(whole), "line-classes")
    # from here on the prefixes are read by class alone
    lines = written(whole.select("doc_id", "key", "pos", "class"), "line-places")
    discard(whole)
    released(spark)
    gone = matched_classes(docs, classes, counts, id_col, text_col).withColumn("late", F.lit(True))
    told = classes.select("class", "first", "last").join(gone, "class", "left").where("first < last or late").select("class", "first", "late")
    return lines.join(told, "class") \
        .where(F.col("late").isNotNull() | (F.struct(_doc(F.col("doc_id")), "pos") > F.col("first"))).select("doc_id", "key", "pos")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_lines, removed_lines array<int>)`` for every row of ``docs``, line numbers ascending from 0.

    NULL and empty texts have one line, which stays.  Repeated rows are answered alike.  An empty table gives an empty
    result; long lines and texts of many lines are compared whole.  Other columns, whatever their names, are left out.
    """
    gone = removed_lines(docs, id_col, text_col).distinct().groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("pos")).alias("removed_lines"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.size(F.split(text, "\n")).alias("n_lines"))
    return slim.join(gone, slim["doc_id"].eqNullSafe(gone["doc_id"]) & (slim["key"] == gone["key"]), "left") \
        .select(slim["doc_id"], "n_lines", F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs`` without the removed lines; the other columns stay, ``count_col`` (if there) is counted anew."""
    gone = removed_lines(docs, id_col, text_col).distinct().groupBy("doc_id", "key").agg(F.collect_list("pos").alias("places"))
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    both = docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone["doc_id"]) & (key == gone["key"]), "left")
    left = F.array_join(F.filter(F.split(docs[text_col], "\n"), lambda x, i: ~F.array_contains(gone["places"], i)), "\n")
    text = F.when(gone["places"].isNull(), docs[text_col]).otherwise(left)
    out = [text.alias(c) if c == text_col else F.when(gone["places"].isNull(), docs[c]).otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c) if c == count_col else docs[c]
           for c in docs.columns]
    return both.select(*out)


ORACLE = """
WITH l AS (
  SELECT d.doc_id, d.rid, k - 1 AS pos, list_filter(regexp_split_to_array(lower(translate(ls[k], chr(9) || chr(11) || chr(12) || chr(13), '    ')), ' '), lambda x: x <> '') AS w
  FROM (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d, unnest(generate_series(1, len(d.ls))) AS g(k)
), s AS (
  SELECT doc_id, rid, pos, list_sort(list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))) AS t FROM l WHERE len(w) >= 5
), c AS (SELECT t, min((doc_id, pos)) AS first FROM s GROUP BY t
), u AS (SELECT row_number() OVER () AS c, first, t, len(t) AS n FROM c
), x AS (SELECT c, unnest(t) AS tok FROM u
), p AS (SELECT a.c AS a, b.c AS b, count(*) AS shared FROM x a JOIN x b USING (tok) WHERE a.c <> b.c GROUP BY ALL
), late AS (SELECT DISTINCT p.a AS c FROM p JOIN u a ON a.c = p.a JOIN u b ON b.c = p.b WHERE b.first < a.first AND 9 * shared >= 4 * (a.n + b.n)
), gone AS (
  SELECT s.rid, list(s.pos::INT ORDER BY s.pos) AS places FROM s JOIN u USING (t)
  WHERE (s.doc_id, s.pos) > u.first OR u.c IN (SELECT c FROM late) GROUP BY s.rid
)
SELECT d.doc_id, len(string_split(coalesce(text, ''), chr(10)))::INT AS n_lines, coalesce(places, []::INT[]) AS removed_lines
FROM (SELECT *, row_number() OVER () AS rid FROM documents) d LEFT JOIN gone USING (rid)
"""
