"""``${token}`` templates: extraction, value resolution, sequential substitution.

All three are Column expressions (regex + higher-order functions), so a
template is resolved inside the row that carries it; no text is shuffled.

Use the Column API here: SQL text passed to ``F.expr``/``spark.sql`` treats
``${…}`` as a configuration variable and silently substitutes it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token starts at '${' and ends at the next '}'; empty names are skipped.
TOKEN_PATTERN = r"\$\{([^}]+)\}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_tokens(text) -> Column:
    """Distinct token names in first-seen order (empty array for NULL text).

    Text after an unclosed ``${`` is ignored.
    """
    t = _c(text)
    return F.when(t.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), F.lit(1))))


def token_values(tokens, context: Mapping[str, Column], defaults: Column | None = None) -> Column:
    """Value per token: the context mapping first, then its default.

    ``context`` maps a token name to a Column of the row (``CASE name WHEN
    'RequisitionTitle' THEN req_title …``).  ``defaults`` is an array in the
    order of ``tokens`` (NULL: no defaults).  Unresolved tokens get NULL, which
    leaves the placeholder in place.
    """
    def one(name: Column) -> Column:
        v = None
        for k, col in context.items():
            v = F.when(name == F.lit(k), col) if v is None else v.when(name == F.lit(k), col)
        return F.lit(None).cast("string") if v is None else v.otherwise(F.lit(None).cast("string"))

    if defaults is None:
        return F.transform(_c(tokens), one)
    return F.transform(_c(tokens), lambda name, k: F.coalesce(one(name), F.get(defaults, k)))


def substitute(text, names, values) -> Column:
    """Replace ``${name}`` by its value, one token after the other.

    A NULL value leaves its placeholder; later tokens see earlier
    replacements (a value that itself holds ``${B}`` is resolved when B comes
    later in the list).
    """
    pairs = F.arrays_zip(_c(names).alias("n"), _c(values).alias("v"))
    return F.aggregate(
        pairs, _c(text),
        lambda acc, p: F.when(p["v"].isNull(), acc).otherwise(
            F.replace(acc, F.concat(F.lit("${"), p["n"], F.lit("}")), p["v"])))


def resolve(text, context: Mapping[str, Column], defaults: Column | None = None) -> Column:
    """Extract, resolve and substitute in one expression."""
    toks = extract_tokens(text)
    return substitute(text, toks, token_values(toks, context, defaults))
