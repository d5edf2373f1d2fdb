"""Template token registry: document frequency, refresh, bulk resolution."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.functions.templates import extract_tokens, substitute, token_values
from tierlake.operators.upsert import merge_columns

def token_frequency(templates: DataFrame, text_col: str) -> DataFrame:
    """``token_name, template_count``: templates that use each token (distinct per template)."""
    toks = templates.where(F.col(text_col).isNotNull()) \
        .select(F.explode(extract_tokens(F.col(text_col))).alias("token_name"))
    return toks.groupBy("token_name").agg(F.count(F.lit(1)).cast("bigint").alias("template_count"))


def refresh_registry(registry: DataFrame, templates: DataFrame, text_col: str) -> DataFrame:
    """Upsert the counts into the registry; defaults and other columns stay."""
    freq = token_frequency(templates, text_col)
    return merge_columns(registry, freq, ["token_name"], update_cols=["template_count"])


def token_defaults(token_lists: DataFrame, registry: DataFrame) -> DataFrame:
    """``tokens, defaults``: for each distinct list of token names the registry defaults in the same order.

    ``token_lists`` holds one array column ``tokens``.  Each name is looked up by a join, so the registry may be of
    any size; names without a default give NULL.  A name that the registry holds twice takes its smallest default.
    """
    lists = token_lists.where(F.size("tokens") > 0).distinct()
    known = registry.where(F.col("default_value").isNotNull()).groupBy("token_name").agg(F.min("default_value").alias("default_value"))
    each = lists.select("tokens", F.posexplode("tokens").alias("at", "token_name")).join(known, "token_name", "left")
    in_order = F.array_sort(F.collect_list(F.struct("at", "default_value")))
    return each.groupBy("tokens").agg(F.transform(in_order, lambda x: x["default_value"]).alias("defaults"))


def resolve_templates(rows: DataFrame, text_col: str, context: Mapping[str, Column],
                      registry: DataFrame | None = None, out_col: str = "resolved_text",
                      strict: bool = False) -> DataFrame:
    """Resolve every row's template against its own context columns.

    ``context`` maps token names to Columns of ``rows``; registry defaults
    fill the rest; unresolved tokens stay as ``${name}``.  ``strict`` makes a
    NULL template an error (as in single-template preview).  Templates with
    the same tokens in the same order share one lookup.
    """
    if strict:
        bad = rows.where(F.col(text_col).isNull()).limit(1).count()
        if bad:
            raise ValueError("a template text is NULL")
    toks = extract_tokens(F.col(text_col))
    if registry is None:
        return rows.withColumn(out_col, substitute(F.col(text_col), toks, token_values(toks, context)))
    found = token_defaults(rows.select(toks.alias("tokens")), registry).select(F.col("tokens").alias("__tokens"), F.col("defaults").alias("__defaults"))
    out = rows.withColumn("__own", toks)
    out = out.join(found, F.col("__own") == F.col("__tokens"), "left")
    values = token_values("__own", context, F.col("__defaults"))
    return out.withColumn(out_col, substitute(F.col(text_col), F.col("__own"), values)).drop("__own", "__tokens", "__defaults")
