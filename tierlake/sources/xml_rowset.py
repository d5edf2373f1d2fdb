"""XML report rowsets (``//ROW`` elements) and SOAP-wrapped reports.

The native XML source finds ``<ROW>`` elements at any depth; columns are
child elements, read as text with an explicit schema (no inference), and an
empty element becomes NULL.  A zero-row report is an error raised before
anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.casts import empty_to_null
from tierlake.sources.landing import all_string_schema

ROW_TAG = "ROW"


class EmptySourceError(RuntimeError):
    """The source returned no rows; nothing was written."""


def read_rowset(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str],
                row_tag: str = ROW_TAG) -> DataFrame:
    """Rows of ``<ROW>`` elements as lower-case string columns, in document order.

    ``_seq`` is the document order (file, split, row) for first-row-per-key rules.
    """
    from tierlake.operators.dedup import with_arrival_seq
    upper = [c.upper() for c in columns]
    df = (spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST")
          .schema(all_string_schema(upper))
          .load(paths if isinstance(paths, str) else list(paths)))
    df = with_arrival_seq(df)
    return df.select(*[empty_to_null(F.trim(F.col(u))).alias(c.lower()) for u, c in zip(upper, columns)], "_seq")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Zero-row guard: raise before any write when the source is empty."""
    if df.isEmpty():
        raise EmptySourceError(f"{what}: source returned 0 rows")
    return df


def report_xml(soap_response: Column | str) -> Column:
    """SOAP response text -> the report XML (``reportBytes``, base64, UTF-8)."""
    r = F.col(soap_response) if isinstance(soap_response, str) else soap_response
    b64 = F.xpath_string(r, F.lit("//*[local-name()='reportBytes']"))
    return F.decode(F.unbase64(b64), "UTF-8")


def rows_from_xml_text(df: DataFrame, xml_col: str, columns: Sequence[str],
                       keep: Sequence[str] = ()) -> DataFrame:
    """Rows of XML documents held in a column whose ``<ROW>`` sit under the root.

    For ROW elements at other depths, land the documents as files and use
    :func:`read_rowset`.
    """
    upper = [c.upper() for c in columns]
    schema = "struct<ROW: array<struct<" + ",".join(f"`{u}`: string" for u in upper) + ">>>"
    parsed = df.select(*keep, F.from_xml(F.col(xml_col), F.lit(schema)).alias("__doc"))
    rows = parsed.select(*keep, F.posexplode("__doc.ROW").alias("_pos", "__r"))
    return rows.select(*keep, "_pos", *[empty_to_null(F.trim(F.col(f"__r.{u}"))).alias(c.lower())
                                        for u, c in zip(upper, columns)])


def tag_text(text: Column | str, tag: str) -> Column:
    """Text of the first ``<tag …>…</tag>`` (regex; for small status responses)."""
    t = F.col(text) if isinstance(text, str) else text
    v = F.regexp_extract(t, rf"<{tag}[^>]*>(.*?)</{tag}>", 1)
    return F.when(v != "", v)
