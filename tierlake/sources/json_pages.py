"""Landed REST responses: JSON pages -> parent rows and child rows.

A landed page is one JSON document ``{"items": [...], "hasMore": …,
"totalResults": …}``; each page is read by one task (multiLine), pages are
many, so the read is parallel across pages.  Items become rows with
``explode``; nested child arrays become their own rows with
``explode_outer`` (a parent without children yields one row of NULLs, which a
following ``child_key IS NOT NULL`` turns into an inner flatten).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

PAGE_NO_PATTERN = r"(\d+)\.json$"     # trailing number of the landed file name


def envelope(items: StructType, extra: Sequence[StructField] = ()) -> StructType:
    return StructType([
        StructField("items", ArrayType(items)),
        StructField("hasMore", BooleanType()),
        StructField("totalResults", LongType()),
        StructField("count", LongType()),
        *extra,
    ])


def read_pages(spark: SparkSession, paths: str | Sequence[str], items: StructType) -> DataFrame:
    """One row per landed page: ``page_no, has_more, total_results, items``.

    ``page_no`` is the trailing number of the file name; ``hasMore`` is false
    when absent.
    """
    df = spark.read.schema(envelope(items)).option("multiLine", "true").json(
        paths if isinstance(paths, str) else list(paths))
    page = F.regexp_extract(F.col("_metadata.file_name"), PAGE_NO_PATTERN, 1)
    return df.select(
        F.when(page != "", page.cast("bigint")).alias("page_no"),
        F.coalesce(F.col("hasMore"), F.lit(False)).alias("has_more"),
        F.col("totalResults").alias("total_results"),
        "items")


PASS_NO_PATTERN = r"pass=(\d+)/"      # folder of one cursor pass
OFFSET_CAP = 10_000                   # a pass ends after so many rows, whatever is left


def read_passes(spark: SparkSession, root: str, items: StructType) -> DataFrame:
    """Pages landed by cursor passes (``<root>/pass=N/…<page>.json``): as ``read_pages``, with ``pass_no``.

    A pass starts again at page 1 and overlaps the one before; merge order is (pass, page, position).
    """
    df = spark.read.schema(envelope(items)).option("multiLine", "true").option("recursiveFileLookup", "true").json(root)
    page = F.regexp_extract(F.col("_metadata.file_name"), PAGE_NO_PATTERN, 1)
    at = F.regexp_extract(F.col("_metadata.file_path"), PASS_NO_PATTERN, 1)
    return df.select(F.when(at != "", at.cast("bigint")).alias("pass_no"), F.when(page != "", page.cast("bigint")).alias("page_no"),
                     F.coalesce(F.col("hasMore"), F.lit(False)).alias("has_more"), F.col("totalResults").alias("total_results"), "items")


def pass_faults(pages: DataFrame, cap: int = OFFSET_CAP) -> DataFrame:
    """``pass_no, fault``: what is missing from landed passes; empty if they are complete.

    Pages of a pass must be numbered without a gap and end with one that has no more; a pass must hold as many
    items as it announced (``totalResults``, at most the cap); a pass that reached the cap must be followed by
    another.
    """
    one = pages.select("pass_no", "page_no", "has_more", "total_results", F.size(F.coalesce("items", F.array().cast(pages.schema["items"].dataType))).alias("n"))
    by = one.groupBy("pass_no").agg(
        F.count_distinct("page_no").alias("pages"), F.min("page_no").alias("first"), F.max("page_no").alias("last"),
        F.max_by("has_more", "page_no").alias("open"), F.sum("n").alias("items"), F.max("total_results").alias("total"))
    by = by.withColumn("last_pass", pages.agg(F.max("pass_no")).scalar())
    faults = F.filter(F.array(
        F.when(F.col("last") - F.col("first") + 1 != F.col("pages"), F.lit("page missing")),
        F.when(F.col("open") & (F.col("items") < cap), F.lit("last page missing")),
        F.when(F.col("items") < F.least(F.col("total"), F.lit(cap)), F.lit("items missing")),
        F.when((F.col("items") >= cap) & (F.col("pass_no") == F.col("last_pass")), F.lit("next pass missing"))), lambda f: f.isNotNull())
    return by.select("pass_no", F.explode(faults).alias("fault"))


def parse_bodies(df: DataFrame, body_col: str, items: StructType) -> DataFrame:
    """Parse landed response bodies held in a column (``from_json``)."""
    return df.withColumn("__env", F.from_json(F.col(body_col), envelope(items))).select(
        *[c for c in df.columns if c != body_col],
        F.coalesce(F.col("__env.hasMore"), F.lit(False)).alias("has_more"),
        F.col("__env.totalResults").alias("total_results"),
        F.col("__env.items").alias("items"))


def page_items(pages: DataFrame, keep: Sequence[str] = ("page_no", "has_more"),
               drop_null: Sequence[str] = ()) -> DataFrame:
    """Items as rows with their position in the page (``_pos``).

    Rows whose ``drop_null`` fields are NULL are dropped (a NULL key never loads).
    """
    exploded = pages.select(*keep, F.posexplode("items").alias("_pos", "item"))
    out = exploded.select(*keep, "_pos", "item.*")
    for c in drop_null:
        out = out.where(F.col(c).isNotNull())
    return out


def child_rows(items: DataFrame, parent_cols: Sequence[str], child_col: str,
               inner_key: str | None = None, prefix: str = "", seq: str | None = None) -> DataFrame:
    """Flatten a nested array of structs, carrying the parent columns.

    Outer by default; with ``inner_key`` only children whose key is set stay.
    ``seq`` names a column for the order inside a page: position of the item
    (``_pos``, a parent column), then of the child.
    """
    x = items.select(*parent_cols, F.posexplode_outer(child_col).alias("__at", "__child"))
    fields = x.schema["__child"].dataType.fieldNames()
    order = [F.struct("_pos", F.coalesce("__at", F.lit(0))).alias(seq)] if seq else []
    out = x.select(*parent_cols, *order, *[F.col(f"__child.{f}").alias(prefix + f) for f in fields])
    if inner_key is not None:
        out = out.where(F.col(prefix + inner_key).isNotNull())
    return out


def has_more(body: Column | str) -> Column:
    """``$.hasMore = 'true'``; false when absent."""
    b = F.col(body) if isinstance(body, str) else body
    return F.coalesce(F.get_json_object(b, "$.hasMore") == F.lit("true"), F.lit(False))


def total_results(body: Column | str) -> Column:
    b = F.col(body) if isinstance(body, str) else body
    return F.get_json_object(b, "$.totalResults").try_cast("bigint")


def single_object(df: DataFrame, body_col: str, schema: StructType) -> DataFrame:
    """A response that is one JSON object -> one row of its fields."""
    return df.select(*[c for c in df.columns if c != body_col],
                     F.from_json(F.col(body_col), schema).alias("__o")).select("*", "__o.*").drop("__o")


def canonical_link(links: Column | str, rel: str = "canonical") -> Column:
    """``href`` of the first link with the given ``rel`` (higher-order filter)."""
    lk = F.col(links) if isinstance(links, str) else links
    return F.try_element_at(F.filter(lk, lambda x: x["rel"] == F.lit(rel)), F.lit(1))["href"]
