"""Nulls, empty and long texts, ties and repeats, empty tables and clashing names: what every operator says about them."""

import pytest
from pyspark.sql import functions as F

from tierlake.llm import decontam, fingerprints, licenses, linededup, pieces, quality, simhash, toxicity
from tierlake.llm.queries import PIECE_MODEL

LONG = "one two three four five six seven\n" * 4000
ROWS = [(1, None), (2, ""), (3, "a few plain words in a row here"), (3, "a few plain words in a row here"), (None, "no id at all for this one"), (None, None), (4, LONG),
        (5, "x" * 50_000), (6, " \n\t "), (7, "a few plain words in a row here")]
LABELS = [(1, 0), (2, 1), (3, 1), (3, 0), (None, 1), (7, None), (4, 0), (5, 1)]
ITEMS = [(10, "a few plain words in a row here"), (None, None), (11, "")]


@pytest.fixture(scope="module")
def odd(spark):
    """The rows with further columns that have the names the operators use inside."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    for c in ("key", "t", "label_id", "good", "text_key", "fp", "__id", "__key", "n", "news", "pos", "component_id", "size", "score", "license", "path", "h"):
        df = df.withColumn(c, F.lit("clash"))
    return df.cache()


def labels(spark, kind):
    return spark.createDataFrame(LABELS, f"doc_id long, {kind} int").withColumn("text", F.lit("clash")).withColumn("label", F.lit(7))


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash"))


OPERATORS = {
    "encode": lambda s, d: pieces.encode(d, PIECE_MODEL), "report": lambda s, d: linededup.report(d), "scan": lambda s, d: licenses.scan(d, F.concat(F.lit("a/"), F.col("doc_id").cast("string"))),
    "neighbours": lambda s, d: fingerprints.edited_neighbours(d), "sketch": lambda s, d: fingerprints.sketch(d), "near_duplicates": lambda s, d: simhash.near_duplicates(d),
    "scored": lambda s, d: toxicity.scored(d, labels(s, "toxic"))}
FILTERS = {
    "keep_selected": lambda s, d: quality.keep_selected(d, labels(s, "quality")), "keep_first": lambda s, d: simhash.keep_first(d),
    "keep_clean": lambda s, d: decontam.keep_clean(d, items(s)), "deduplicated": lambda s, d: linededup.deduplicated(d)}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_answer_per_row(spark, odd, name):
    made = OPERATORS[name]
    got = made(spark, odd).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((r[0] for r in ROWS), key=str)
    repeated = [tuple(r) for r in got if r["doc_id"] == 3]
    if name != "neighbours":        # a repeated row has another row behind it
        assert repeated[0] == repeated[1]
    assert made(spark, odd.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_columns_and_empty_tables(spark, odd, name):
    kept = FILTERS[name](spark, odd)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert ids.count(3) in (0, 2) and set(ids) <= {r[0] for r in ROWS}
    assert FILTERS[name](spark, odd.limit(0)).count() == 0


def test_items_found_and_not_found(spark, odd):
    got = decontam.contaminated(odd, items(spark)).collect()
    assert sorted(r["doc_id"] for r in got) == [3, 3, 7] and {r["item_id"] for r in got} == {10}
    assert decontam.contaminated(odd, items(spark).limit(0)).count() == 0
    assert decontam.keep_clean(odd, items(spark).limit(0)).count() == len(ROWS)
