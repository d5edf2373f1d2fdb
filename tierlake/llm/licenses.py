"""License scan: sparse TF-IDF cosine to templates, then inheritance from ancestor directories; DataFrame functions only.

Units are the lines of a text (headers) and the whole text (a licence file).
Terms are lower-case runs of ASCII letters and digits; idf counts documents.
Only terms of the templates can add to a cosine, so only these are counted over
the corpus and joined; all other terms of a unit enter its length with the idf
of a term that no document has.

A unit can reach the threshold only if it shares a heavy term with a template:
for each template the lightest terms are set aside as long as they alone stay
below the threshold; texts without any of the other terms are not looked at
further.  That is exact.

A document has the license of its best line; a document whose whole text is
close to a template is a licence file of its directory.  A document without a
license of its own takes that of the licence file in the nearest ancestor
directory of its path (of several, the one with the highest cosine, then the
smallest license id).  Directories are resolved once, then joined.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.base import written

# fixed values: license ids and the usual short notices
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
HEADER, FILE = 0.75, 0.5


def _terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def scan(docs: DataFrame, path: Column, templates: list[tuple[str, str]] | None = None, header: float = HEADER, file: float = FILE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, path, license, found, cosine, license_dir)`` for every row of ``docs``.

    ``found`` is ``header``, ``file`` or ``inherited``, NULL without a license.  Ties between licenses go to the
    smallest id.  NULL and empty texts have no license of their own; a NULL path has no directory and inherits nothing.
    Repeated rows are answered alike.  An empty table gives an empty result; very long texts are compared whole.  Other
    columns, whatever their names, are left out.
    """
    spark = docs.sparkSession
    chosen = templates or TEMPLATES
    tf: dict[str, dict[str, int]] = {}
    for name, text in chosen:
        tf[name] = {}
        for t in re.findall("[a-z0-9]+", text.lower()):
            tf[name][t] = tf[name].get(t, 0) + 1
    vocabulary = sorted({t for v in tf.values() for t in v})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"), path.cast("string").alias("path"))
    terms = F.array(*map(F.lit, vocabulary))
    df = {r["term"]: r["n"] for r in rows.select(F.explode(F.array_intersect(_terms(F.col("t")), terms)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = rows.count()
    idf = {t: math.log((n + 1.0) / (df.get(t, 0) + 1.0)) + 1.0 for t in vocabulary}
    unknown = math.log(n + 1.0) + 1.0
    weight = {name: {t: k * idf[t] for t, k in v.items()} for name, v in tf.items()}
    norm = {name: math.sqrt(sum(w * w for w in v.values())) for name, v in weight.items()}
    heavy: set[str] = set()
    for name, v in weight.items():
        light = 0.0
        for t, w in sorted(v.items(), key=lambda x: (x[1], x[0])):
            light += w * w
            if math.sqrt(light) / norm[name] >= min(header, file):
                heavy.add(t)
    near = F.lit(False)
    for t in sorted(heavy):
        near = near | F.col("low").contains(t)
    slim = rows.select("doc_id", F.xxhash64("t").alias("key"), "t", F.lower("t").alias("low")).where(near).dropDuplicates(["doc_id", "key"])
    units = slim.select("doc_id", "key", F.posexplode(F.concat(F.array("t"), F.split("t", "\n"))).alias("unit", "line"))
    parts = units.select("doc_id", "key", "unit", F.explode(_terms(F.col("line"))).alias("term")).groupBy("doc_id", "key", "unit", "term").agg(F.count(F.lit(1)).alias("tf"))
    values = spark.createDataFrame([(t, idf[t]) for t in vocabulary], "term string, idf double")
    # one exchange, that of the texts: terms and units of a text stay in its partition; only units with a template's term are kept
    weighed = parts.join(F.broadcast(values), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    shared = F.collect_list(F.when(F.col("idf").isNotNull(), F.struct("term", "w")))
    per_unit = written(weighed.groupBy("doc_id", "key", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"), shared.alias("shared"))
                       .where(F.size("shared") > 0), "license-units")
    sides = spark.createDataFrame([(name, t, w / norm[name]) for name, v in weight.items() for t, w in v.items()], "license string, term string, tw double")
    dots = per_unit.select("doc_id", "key", "unit", "len", F.inline("shared")).join(F.broadcast(sides), "term") \
        .groupBy("doc_id", "key", "unit", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"), F.max("len").alias("len"))
    whole = F.col("unit") == 0
    cosine = F.round(F.col("dot") / F.col("len"), 6)
    hits = dots.select("doc_id", "key", whole.alias("whole"), "license", cosine.alias("cosine")) \
        .where(F.when(F.col("whole"), F.col("cosine") >= file).otherwise(F.col("cosine") >= header))
    # min() of (-cosine, license): the highest cosine, then the smallest id
    best = hits.groupBy("doc_id", "key").agg(F.min(F.when(~F.col("whole"), F.struct(-F.col("cosine"), F.col("license")))).alias("h"),
                                             F.min(F.when(F.col("whole"), F.struct(-F.col("cosine"), F.col("license")))).alias("f"))
    best = written(best.select("doc_id", "key", F.col("h.license").alias("hl"), (-F.col("h.col1")).alias("hc"), F.col("f.license").alias("fl"), (-F.col("f.col1")).alias("fc")), "license-own")

    place = rows.select("doc_id", F.xxhash64("t").alias("key"), "path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"))
    own = written(place.join(best, place["doc_id"].eqNullSafe(best["doc_id"]) & (place["key"] == best["key"]), "left")
                  .select(place["doc_id"], "path", F.when(F.col("path").isNotNull(), F.col("dir")).alias("dir"), "hl", "hc", "fl", "fc"), "license-documents")
    files = own.where("fl is not null and dir is not null").groupBy("dir").agg(F.min(F.struct(-F.col("fc"), F.col("fl"))).alias("x")) \
        .select(F.col("dir").alias("license_dir"), F.col("x.fl").alias("dl"))
    segments = F.split("dir", "/")
    above = own.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(segments)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(segments, F.lit(1), k), "/").alias("license_dir")))).alias("a")).select("dir", "a.*")
    nearest = above.join(files, "license_dir").groupBy("dir").agg(F.max(F.struct("depth", "license_dir", "dl")).alias("x")).select("dir", "x.license_dir", "x.dl")
    out = own.join(nearest, "dir", "left")
    found = F.when(F.col("hl").isNotNull(), "header").when(F.col("fl").isNotNull(), "file").when(F.col("dl").isNotNull(), "inherited")
    return out.select("doc_id", "path", F.coalesce("hl", "fl", "dl").alias("license"), found.alias("found"),
                      F.when(F.col("hl").isNotNull(), F.col("hc")).when(F.col("fl").isNotNull(), F.col("fc")).alias("cosine"),
                      F.when(found == "inherited", F.col("license_dir")).alias("license_dir"))


def _oracle(header: float = HEADER, file: float = FILE) -> str:
    rows = ", ".join("('%s', '%s')" % (a, b.replace("'", "''")) for a, b in TEMPLATES)
    split = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"""
WITH tpl(license, t) AS (VALUES {rows}
), d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, source || '/' || lang || '/' || doc_id || '.txt' AS path FROM documents
), tt AS (SELECT license, term, count(*) AS k FROM (SELECT license, unnest({split.format('t')}) AS term FROM tpl) GROUP BY ALL
), df AS (SELECT term, count(DISTINCT rid) AS n FROM (SELECT rid, unnest({split.format('t')}) AS term FROM d) WHERE term IN (SELECT term FROM tt) GROUP BY term
), idf AS (SELECT DISTINCT tt.term, ln(((SELECT count(*) FROM d) + 1.0) / (coalesce(n, 0) + 1.0)) + 1.0 AS idf FROM tt LEFT JOIN df USING (term)
), u AS (SELECT rid, 0 AS unit, t AS line FROM d UNION ALL SELECT rid, k AS unit, ls[k] AS line FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM d) x, unnest(generate_series(1, len(x.ls))) AS g(k)
), p AS (SELECT rid, unit, term, count(*) AS tf FROM (SELECT rid, unit, unnest({split.format('line')}) AS term FROM u) GROUP BY ALL
), w AS (SELECT rid, unit, term, idf, tf * coalesce(idf, ln((SELECT count(*) FROM d) + 1.0) + 1.0) AS w FROM p LEFT JOIN idf USING (term)
), len AS (SELECT rid, unit, sqrt(sum(w * w)) AS len FROM w GROUP BY ALL
), s AS (SELECT license, term, k * idf AS tw FROM tt JOIN idf USING (term)
), norm AS (SELECT license, sqrt(sum(tw * tw)) AS norm FROM s GROUP BY license
), c AS (SELECT rid, unit, license, round(sum(w * tw / norm) / any_value(len), 6) AS cosine FROM w JOIN s USING (term) JOIN norm USING (license) JOIN len USING (rid, unit) WHERE idf IS NOT NULL GROUP BY rid, unit, license
), h AS (SELECT rid, license AS hl, cosine AS hc FROM c WHERE unit > 0 AND cosine >= {header} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY cosine DESC, license) = 1
), f AS (SELECT rid, license AS fl, cosine AS fc FROM c WHERE unit = 0 AND cosine >= {file} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY cosine DESC, license) = 1
), own AS (SELECT d.rid, doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, hl, hc, fl, fc FROM d LEFT JOIN h USING (rid) LEFT JOIN f USING (rid)
), files AS (SELECT dir AS license_dir, fl AS dl FROM own WHERE fl IS NOT NULL QUALIFY row_number() OVER (PARTITION BY dir ORDER BY fc DESC, fl) = 1
), near AS (SELECT o.dir, license_dir, dl FROM (SELECT DISTINCT dir FROM own) o JOIN files ON license_dir = '' OR o.dir = license_dir OR starts_with(o.dir, license_dir || '/')
  QUALIFY row_number() OVER (PARTITION BY o.dir ORDER BY length(license_dir) DESC) = 1)
SELECT doc_id, path, coalesce(hl, fl, dl) AS license, CASE WHEN hl IS NOT NULL THEN 'header' WHEN fl IS NOT NULL THEN 'file' WHEN dl IS NOT NULL THEN 'inherited' END AS found,
  CASE WHEN hl IS NOT NULL THEN hc WHEN fl IS NOT NULL THEN fc END AS cosine, CASE WHEN hl IS NULL AND fl IS NULL AND dl IS NOT NULL THEN license_dir END AS license_dir
FROM own LEFT JOIN near USING (dir)
"""


ORACLE = _oracle()
