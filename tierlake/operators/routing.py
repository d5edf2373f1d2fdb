"""Pattern routing: the first active LIKE pattern (by priority) names the load type.

A loader map may hold any number of patterns, so no name is held against all of
them.  A pattern can only match a name that contains its literal parts: each
pattern is filed under one substring (gram) of its literal parts, the one that the
fewest patterns have, and a name looks up its own grams.  Lookup is a hash join; LIKE decides only about the candidates.  Patterns of wildcards alone
depend on nothing but the length of a name and are folded to one entry a length.
Equal names are routed once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNMAPPED = "UNMAPPED"
#: Gram sizes; a pattern uses the largest that its longest literal part has.
GRAMS = (6, 3, 2, 1)

#: Escaped wildcards and backslashes while a pattern is cut at its wildcards.
_ESCAPED = (("\\\\", "\x04", "\\"), ("\\%", "\x02", "%"), ("\\_", "\x03", "_"))


def active_patterns(loader_map: DataFrame) -> DataFrame:
    return loader_map.where(
        (F.col("is_active") == "Y") & F.col("load_type").isNotNull() & F.col("file_like").isNotNull())


def _grams(text: Column, size: Column | int) -> Column:
    """All substrings of ``size`` characters; none if the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(F.length(text) >= size, F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda i: F.substring(text, i, size))) \
        .otherwise(F.array().cast("array<string>"))


def _masked(like: Column) -> Column:
    for pattern, mark, _ in _ESCAPED:
        like = F.replace(like, F.lit(pattern), F.lit(mark))
    return like


def _unmasked(part: Column) -> Column:
    return F.translate(part, "".join(mark for _, mark, _ in _ESCAPED), "".join(letter for _, _, letter in _ESCAPED))


def _entries(loader_map: DataFrame, carry: Sequence[str]) -> DataFrame:
    """One row per distinct pattern (lower case) with its best map entry and its gram size (NULL: wildcards alone)."""
    entry = F.struct("priority", "map_id", "load_type", *carry)
    best = active_patterns(loader_map).groupBy(F.lower("file_like").alias("like")).agg(F.min_by(entry, F.struct("priority", "map_id")).alias("entry"))
    parts = F.transform(F.filter(F.split(_masked(F.col("like")), "[%_]"), lambda p: F.length(p) > 0), _unmasked)
    longest = F.array_max(F.transform(parts, F.length))
    size = reduce(lambda out, q: F.when(longest >= q, q).otherwise(out), reversed(GRAMS), F.lit(None).cast("int"))
    return best.withColumn("parts", parts).withColumn("size", size)


def _by_length(entries: DataFrame, names: DataFrame) -> DataFrame:
    """``n, entry``: what patterns of wildcards alone say about names of each length."""
    wild = entries.where("size is null").select(
        "entry", F.regexp_count("like", F.lit("_")).alias("least"), F.contains("like", F.lit("%")).alias("more"))
    longest = names.agg(F.max(F.length("name"))).first()[0] or 0
    to = F.when(F.col("more"), F.lit(longest)).otherwise(F.col("least"))
    lengths = wild.where(F.col("least") <= longest).select("entry", F.explode(F.sequence("least", to)).alias("n"))
    return lengths.groupBy("n").agg(_best().alias("entry"))


def _best() -> Column:
    return F.min_by("entry", F.struct("entry.priority", "entry.map_id"))


def route_names(names: DataFrame, loader_map: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``name, entry`` of the distinct lower-case ``names(name)`` that a pattern matches."""
    entries = _entries(loader_map, carry)
    literal = entries.where("size is not null")
    sizes = [r["size"] for r in entries.select("size").distinct().collect()]      # at most len(GRAMS) and NULL
    if not sizes:
        return names.where(F.lit(False)).select("name", F.lit(None).cast(entries.schema["entry"].dataType).alias("entry"))
    if None in sizes:
        found = names.join(_by_length(entries, names), F.length("name") == F.col("n")).select("name", "entry")
    if used := [q for q in sizes if q is not None]:
        held = names.select("name", F.explode(F.concat(*[_grams(F.col("name"), q) for q in used])).alias("gram"))
        own = F.array_distinct(F.flatten(F.transform("parts", lambda p: _grams(p, F.col("size")))))
        filed = literal.select("like", "entry", F.explode(own).alias("gram"))
        counts = filed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        index = filed.join(counts, "gram").groupBy("like").agg(F.first("entry").alias("entry"), F.min(F.struct("n", "gram")).alias("g"))
        hits = held.join(index.select("like", "entry", F.col("g.gram").alias("gram")), "gram") \
            .where(F.like("name", "like")).select("name", "entry")
        found = hits if None not in sizes else found.unionByName(hits)
    return found.groupBy("name").agg(_best().alias("entry"))


def route_by_pattern(df: DataFrame, name_col: str, loader_map: DataFrame,
                     out_col: str = "load_type", carry: Sequence[str] = ()) -> DataFrame:
    """Add ``out_col``: load type of the best matching active pattern, else 'UNMAPPED'.

    Ties on priority are broken by ``map_id``.  ``_`` and ``%`` in patterns
    are wildcards unless a backslash escapes them; case does not matter.  ``carry``
    names columns of the matched map entry to add (NULL without a match).
    NULL names are unmapped.
    """
    names = df.select(F.lower(name_col).alias("name")).where("name is not null").distinct()
    routed = route_names(names, loader_map, carry).select(F.col("name").alias("__name"), "entry")
    out = df.join(routed, F.lower(name_col) == F.col("__name"), "left")
    return out.select(*df.columns, F.coalesce("entry.load_type", F.lit(UNMAPPED)).alias(out_col), *[F.col(f"entry.{c}").alias(c) for c in carry])
