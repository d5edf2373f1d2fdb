"""Operators run over the driver-generated tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built only with
the library's operators; :data:`ORACLE_SQL` holds the plain-SQL statement of
the same result for an independent engine.  Batches of a three-tier load are
formed by *time*, the way extracts arrive: the "final" table is the state as
of ``BATCH_CUTOFF`` and the "staged" batch is everything that arrived after
it.  Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators.dedup import latest_per_key
from tierlake.operators.preview import change_preview
from tierlake.operators.upsert import (
    dense_sequence, fold_pages, merge_columns, upsert, upsert_preserve_null, upsert_surrogate,
)
from tierlake.session import table

# Batch boundaries (parameters of the demo loads, not data filters).
BATCH_CUTOFF = "2024-01-16 00:00:00"        # events: final = before, batch = from here on
LINE_CUTOFF = "1998-06-01 00:00:00"         # lineitem: same split on l_shipdate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def _event_order():
    return [F.col("ts").desc_nulls_last(), F.col("event_id").asc()]


def events_final(spark, sf_dir) -> DataFrame:
    """State of the events "final" table as of the cutoff (latest per user)."""
    ev = table(spark, sf_dir, "events")
    return latest_per_key(ev.where(F.col("ts") < _ts(BATCH_CUTOFF)), ["user_id"], _event_order())


def events_batch(spark, sf_dir) -> DataFrame:
    """The staged batch (rows from the cutoff on), deduplicated per user."""
    ev = table(spark, sf_dir, "events")
    return latest_per_key(ev.where(F.col("ts") >= _ts(BATCH_CUTOFF)), ["user_id"], _event_order())


_SQL_EV_F = f"""(SELECT * FROM events WHERE ts < TIMESTAMP '{BATCH_CUTOFF}'
   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1)"""
_SQL_EV_S = f"""(SELECT * FROM events WHERE ts >= TIMESTAMP '{BATCH_CUTOFF}'
   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1)"""


# --------------------------------------------------------------------- W1-W3
@register("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1
""")
def q_latest_per_key(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], _event_order())


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]


@register("latest_per_key_two_orders", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_shipdate DESC NULLS LAST, l_linenumber DESC NULLS LAST, {', '.join(_LI_REST)}) = 1
""")
def q_latest_two_orders(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    order = [F.col("l_shipdate").desc_nulls_last(), F.col("l_linenumber").desc_nulls_last(),
             *[F.col(c).asc() for c in _LI_REST]]
    return latest_per_key(li, ["l_orderkey"], order)


@register("first_arrival", """
SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1
""")
def q_first_arrival(spark, sf_dir):
    cv = table(spark, sf_dir, "conversations")
    return latest_per_key(cv, ["conv_id"], [F.col("turn").asc()])


# ------------------------------------------------------------------------ D1
@register("change_preview", f"""
WITH s AS {_SQL_EV_S}, f AS {_SQL_EV_F},
n AS (SELECT count(*) AS c FROM (SELECT DISTINCT user_id FROM s) x
      WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = x.user_id)),
m AS (SELECT count(*) AS c FROM (SELECT DISTINCT user_id FROM s) x
      WHERE EXISTS (SELECT 1 FROM f WHERE f.user_id = x.user_id)),
u AS (SELECT count(*) AS c FROM (SELECT user_id, event_type FROM s
                                 INTERSECT SELECT user_id, event_type FROM f) y)
SELECT n.c AS new_count, m.c AS matched_count, m.c - u.c AS changed_count, u.c AS unchanged_count
FROM n, m, u
""")
def q_change_preview(spark, sf_dir):
    return change_preview(events_batch(spark, sf_dir), events_final(spark, sf_dir),
                          ["user_id"], ["event_type"])


# ------------------------------------------------------------------- M1, M2
@register("upsert_full_row", f"""
WITH s AS {_SQL_EV_S}, f AS {_SQL_EV_F}
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = f.user_id)
UNION ALL SELECT * FROM s
""")
def q_upsert_full_row(spark, sf_dir):
    return upsert(events_final(spark, sf_dir), events_batch(spark, sf_dir), ["user_id"])


def _lines_latest(li: DataFrame) -> DataFrame:
    order = [F.col("l_shipdate").desc_nulls_last(), *[F.col(c).asc() for c in _LI_REST]]
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], order)


_SQL_LI = """(SELECT * FROM lineitem WHERE {cond}
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, """ + ", ".join(_LI_REST) + ") = 1)"


@register("upsert_composite", f"""
WITH s AS {_SQL_LI.format(cond=f"l_shipdate >= TIMESTAMP '{LINE_CUTOFF}'")},
     f AS {_SQL_LI.format(cond=f"l_shipdate < TIMESTAMP '{LINE_CUTOFF}'")}
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = f.l_orderkey
                                  AND s.l_linenumber = f.l_linenumber)
UNION ALL SELECT * FROM s
""")
def q_upsert_composite(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    final = _lines_latest(li.where(F.col("l_shipdate") < _ts(LINE_CUTOFF)))
    batch = _lines_latest(li.where(F.col("l_shipdate") >= _ts(LINE_CUTOFF)))
    return upsert(final, batch, ["l_orderkey", "l_linenumber"])


# ----------------------------------------------------------------------- M3
def user_profile(ev: DataFrame) -> DataFrame:
    """Per-user profile of one batch; columns are NULL where the batch has no such event."""
    order = F.struct("ts", "event_id")
    return ev.groupBy("user_id").agg(
        F.max_by("value", F.when(F.col("event_type") == "purchase", order)).alias("last_purchase_value"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_purchase_ts"),
        F.max(F.when(F.col("event_type") == "error", F.col("ts"))).alias("last_error_ts"),
        F.max(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("last_signup_ts"),
        F.max_by("event_type", order).alias("last_event_type"),
    )


_SQL_PROFILE = """(SELECT user_id,
  arg_max(value, {{'ts': ts, 'id': event_id}}) FILTER (WHERE event_type = 'purchase') AS last_purchase_value,
  max(ts) FILTER (WHERE event_type = 'purchase') AS last_purchase_ts,
  max(ts) FILTER (WHERE event_type = 'error') AS last_error_ts,
  max(ts) FILTER (WHERE event_type = 'signup') AS last_signup_ts,
  arg_max(event_type, {{'ts': ts, 'id': event_id}}) AS last_event_type
  FROM events WHERE {cond} GROUP BY user_id)"""


@register("upsert_preserve_null", f"""
WITH s AS {_SQL_PROFILE.format(cond=f"ts >= TIMESTAMP '{BATCH_CUTOFF}'")},
     f AS {_SQL_PROFILE.format(cond=f"ts < TIMESTAMP '{BATCH_CUTOFF}'")}
SELECT coalesce(f.user_id, s.user_id) AS user_id,
  CASE WHEN f.user_id IS NOT NULL AND s.user_id IS NOT NULL THEN coalesce(s.last_purchase_value, f.last_purchase_value)
       WHEN f.user_id IS NOT NULL THEN f.last_purchase_value ELSE s.last_purchase_value END AS last_purchase_value,
  CASE WHEN f.user_id IS NOT NULL AND s.user_id IS NOT NULL THEN coalesce(s.last_purchase_ts, f.last_purchase_ts)
       WHEN f.user_id IS NOT NULL THEN f.last_purchase_ts ELSE s.last_purchase_ts END AS last_purchase_ts,
  CASE WHEN f.user_id IS NOT NULL AND s.user_id IS NOT NULL THEN coalesce(s.last_error_ts, f.last_error_ts)
       WHEN f.user_id IS NOT NULL THEN f.last_error_ts ELSE s.last_error_ts END AS last_error_ts,
  CASE WHEN f.user_id IS NOT NULL AND s.user_id IS NOT NULL THEN coalesce(s.last_signup_ts, f.last_signup_ts)
       WHEN f.user_id IS NOT NULL THEN f.last_signup_ts ELSE s.last_signup_ts END AS last_signup_ts,
  CASE WHEN f.user_id IS NOT NULL AND s.user_id IS NOT NULL THEN coalesce(s.last_event_type, f.last_event_type)
       WHEN f.user_id IS NOT NULL THEN f.last_event_type ELSE s.last_event_type END AS last_event_type
FROM f FULL OUTER JOIN s ON f.user_id = s.user_id
""")
def q_upsert_preserve_null(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    final = user_profile(ev.where(F.col("ts") < _ts(BATCH_CUTOFF)))
    batch = user_profile(ev.where(F.col("ts") >= _ts(BATCH_CUTOFF)))
    return upsert_preserve_null(final, batch, ["user_id"])


# ----------------------------------------------------------------------- M4
def order_rollup(li: DataFrame) -> DataFrame:
    """Order status and total recomputed from the line items (the partial source)."""
    n = F.count(F.lit(1))
    return li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.when(F.count_if(F.col("l_linestatus") == "F") == n, F.lit("F"))
         .when(F.count_if(F.col("l_linestatus") == "O") == n, F.lit("O"))
         .otherwise(F.lit("P")).alias("o_orderstatus"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("o_totalprice"),
    )


@register("upsert_partial", """
WITH s AS (SELECT l_orderkey AS o_orderkey,
    CASE WHEN count(*) FILTER (WHERE l_linestatus = 'F') = count(*) THEN 'F'
         WHEN count(*) FILTER (WHERE l_linestatus = 'O') = count(*) THEN 'O' ELSE 'P' END AS o_orderstatus,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS o_totalprice
  FROM lineitem GROUP BY l_orderkey)
SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey,
  o.o_custkey,
  CASE WHEN o.o_orderkey IS NULL OR s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
  CASE WHEN o.o_orderkey IS NULL OR s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
  o.o_orderdate, o.o_orderpriority
FROM orders o FULL OUTER JOIN s ON o.o_orderkey = s.o_orderkey
""")
def q_upsert_partial(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    src = order_rollup(table(spark, sf_dir, "lineitem"))
    return merge_columns(orders, src, ["o_orderkey"], update_cols=["o_orderstatus", "o_totalprice"])


# ----------------------------------------------------------------------- M8
PAGE_SIZE = 100


def event_pages(ev: DataFrame) -> DataFrame:
    """Events as landed REST pages: page = event_id div PAGE_SIZE."""
    return ev.select(
        (F.col("event_id") / F.lit(PAGE_SIZE)).cast("bigint").alias("page_no"),
        F.col("event_id").alias("_seq"), "user_id", "event_id", "ts", "event_type", "value",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"))


@register("paged_fold", """
SELECT user_id,
  arg_max(event_id, event_id) AS event_id, arg_max(ts, event_id) AS ts,
  arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
  arg_max(value, event_id) FILTER (WHERE event_type = 'purchase') AS purchase_value
FROM events GROUP BY user_id
""")
def q_paged_fold(spark, sf_dir):
    pages = event_pages(table(spark, sf_dir, "events"))
    folded = fold_pages(pages, ["user_id"], "page_no", "_seq", preserve_null_cols=["purchase_value"])
    return folded.select("user_id", "event_id", "ts", "event_type", "value", "purchase_value")


# ----------------------------------------------------------------------- M6
def _user_dim(ev: DataFrame) -> DataFrame:
    return latest_per_key(ev, ["user_id"], _event_order()).select(
        "user_id", F.col("event_type").alias("last_event_type"), F.col("ts").alias("last_ts"))


@register("surrogate_upsert", f"""
WITH f0 AS (SELECT user_id, event_type AS last_event_type, ts AS last_ts FROM {_SQL_EV_F} x),
f AS (SELECT CAST(row_number() OVER (ORDER BY user_id) AS BIGINT) AS id, * FROM f0),
s AS (SELECT user_id, event_type AS last_event_type, ts AS last_ts FROM {_SQL_EV_S} y),
mx AS (SELECT coalesce(max(id), 0) AS m FROM f)
SELECT f.id, s.user_id, s.last_event_type, s.last_ts FROM f JOIN s ON f.user_id = s.user_id
UNION ALL
SELECT f.id, f.user_id, f.last_event_type, f.last_ts FROM f
  WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.user_id = f.user_id)
UNION ALL
SELECT CAST((SELECT m FROM mx) + row_number() OVER (ORDER BY user_id) AS BIGINT) AS id,
       user_id, last_event_type, last_ts FROM s
  WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = s.user_id)
""")
def q_surrogate_upsert(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    first_load = _user_dim(ev.where(F.col("ts") < _ts(BATCH_CUTOFF)))
    # the final table as stored after the first load (lineage cut, as a stored table would be)
    final = dense_sequence(first_load, ["user_id"], start=0, name="id") \
        .select("id", "user_id", "last_event_type", "last_ts").checkpoint()
    batch = _user_dim(ev.where(F.col("ts") >= _ts(BATCH_CUTOFF)))
    return upsert_surrogate(final, batch, ["user_id"], id_col="id", seq_col="_seq")


# --------------------------------------------------------- J1, J2, U1, A2/A3
@register("semi_join", """
SELECT c_custkey, c_name, c_nationkey FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def q_semi_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return c.join(o, ["c_custkey"], "left_semi")


@register("anti_join", """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
UNION ALL
SELECT c_custkey AS o_orderkey, CAST(NULL AS DOUBLE) AS o_custkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def q_anti_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    no_lines = o.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey")) \
        .join(li, ["o_orderkey"], "left_anti")
    no_orders = c.join(o.select("o_custkey").distinct(), ["o_custkey"], "left_anti") \
        .select(F.col("o_custkey").alias("o_orderkey"), F.lit(None).cast("double").alias("o_custkey"))
    return no_lines.unionByName(no_orders)


@register("intersect_rows", f"""
SELECT user_id, event_type FROM {_SQL_EV_S} s
INTERSECT
SELECT user_id, event_type FROM {_SQL_EV_F} f
""")
def q_intersect_rows(spark, sf_dir):
    cols = ["user_id", "event_type"]
    return events_batch(spark, sf_dir).select(*cols).intersect(events_final(spark, sf_dir).select(*cols))


@register("distinct_keys", """
SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orderkeys,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS n_line_keys
FROM lineitem
""")
def q_distinct_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # count(distinct a) and the distinct composite tuples in one aggregate:
    # the composite distinct is expressed per order key first (partial agg).
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_linenumber").alias("nl"),
        F.max(F.col("l_linenumber").isNull().cast("int")).alias("has_null"))
    return per_order.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count("l_orderkey").cast("bigint").alias("n_orderkeys"),
        (F.sum("nl") + F.sum("has_null")).cast("bigint").alias("n_line_keys"))


# ------------------------------------------------------------------------ J3
# Fixed demo loader map: (map_id, priority, file_like, load_type, is_active).
LOADER_MAP = [
    (1, 10, "%promo%", "PROMO_LOAD", "Y"),
    (2, 20, "small%", "SMALL_ITEMS", "Y"),
    (3, 20, "%ring%", "RING_ITEMS", "Y"),
    (4, 30, "%brand#1_", "BRAND_TEENS", "Y"),
    (5, 5, "%gear%", "GEAR_RETIRED", "N"),
    (6, 40, "%large%", "LARGE_ITEMS", "Y"),
]


def loader_map_df(spark):
    from tierlake.session import local_rows
    return local_rows(spark, [(m, p, f, t, a, "Y") for m, p, f, t, a in LOADER_MAP],
                      "map_id int, priority int, file_like string, load_type string, is_active string, "
                      "loader_available string")


_SQL_LOADER_MAP = "(VALUES " + ", ".join(
    f"({m}, {p}, '{f}', '{t}', '{a}')" for m, p, f, t, a in LOADER_MAP) + \
    ") AS m(map_id, priority, file_like, load_type, is_active)"


def _part_file_name():
    return F.concat_ws(" ", "p_name", "p_type", "p_brand")


@register("pattern_route", f"""
WITH p AS (SELECT p_partkey, concat_ws(' ', p_name, p_type, p_brand) AS file_name FROM part)
SELECT p.p_partkey, p.file_name,
  coalesce((SELECT m.load_type FROM {_SQL_LOADER_MAP}
            WHERE m.is_active = 'Y' AND lower(p.file_name) LIKE lower(m.file_like)
            ORDER BY m.priority, m.map_id LIMIT 1), 'UNMAPPED') AS load_type
FROM p
""")
def q_pattern_route(spark, sf_dir):
    from tierlake.operators.routing import route_by_pattern
    p = table(spark, sf_dir, "part").select("p_partkey", _part_file_name().alias("file_name"))
    return route_by_pattern(p, "file_name", loader_map_df(spark))


# --------------------------------------------------------------- I7, J4, W5
RUN_NOW = "2024-01-20 18:00:00"   # the daily run being simulated (UTC)


def event_files(ev: DataFrame) -> DataFrame:
    """Events as extract files: one ZIP per event, named like the extract system does."""
    name = F.concat(F.lit("file_"), F.col("event_type"), F.lit("extract-batch"), F.col("event_id").cast("string"),
                    F.lit("-"), F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".zip"))
    return ev.select(name.alias("file_name"), F.upper("event_type").alias("load_type"),
                     F.col("ts").alias("arrived_ts"), F.lit("Y").alias("loader_available"),
                     F.col("value"))


def event_file_jobs(files: DataFrame) -> DataFrame:
    """Earlier daily runs: the latest file per type and day was loaded.

    Its outcome is MERGED, or ERROR when the extract's value was below 5
    (failed loads do not block a retry).
    """
    day_latest = latest_per_key(files.withColumn("day", F.to_date("file_timestamp")),
                                ["load_type", "day"],
                                [F.col("file_timestamp").desc_nulls_last(), F.col("file_name").desc()])
    return day_latest.where(F.col("day") < F.to_date(F.lit(RUN_NOW))).select(
        "file_name", "load_type",
        F.when(F.col("value") < 5, "ERROR").otherwise("MERGED").alias("status"))


@register("unprocessed_latest", f"""
WITH files AS (
  SELECT 'file_' || event_type || 'extract-batch' || CAST(event_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d_%H%M%S') || '.zip' AS file_name,
         upper(event_type) AS load_type, value,
         strptime(regexp_extract(('file_' || event_type || 'extract-batch' || CAST(event_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d_%H%M%S') || '.zip'), '-(\\d{{8}}_\\d{{6}})\\.[zZ][iI][pP]', 1), '%Y%m%d_%H%M%S') AS file_timestamp
  FROM events),
jobs AS (
  SELECT file_name, load_type, CASE WHEN value < 5 THEN 'ERROR' ELSE 'MERGED' END AS status FROM (
    SELECT * FROM files
    QUALIFY row_number() OVER (PARTITION BY load_type, CAST(file_timestamp AS DATE)
                               ORDER BY file_timestamp DESC NULLS LAST, file_name DESC) = 1) d
  WHERE CAST(file_timestamp AS DATE) < DATE '{RUN_NOW[:10]}'),
day AS (SELECT CAST(TIMESTAMP '{RUN_NOW}' - INTERVAL 8 HOUR AS DATE) + INTERVAL 8 HOUR AS began),  -- Pacific standard time in January
newest AS (SELECT load_type, max({{'t': file_timestamp, 'n': file_name}}) AS f FROM files, day
           WHERE file_timestamp BETWEEN began - INTERVAL 1 DAY AND began + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND
             AND NOT regexp_matches(lower(file_name), 'poheaderdffpublic|suppliersiteextract|invoiceheaderextract')
           GROUP BY load_type),
taken AS (SELECT file_name, load_type FROM jobs WHERE status <> 'ERROR')
SELECT f.n AS file_name, n.load_type, f.t AS file_timestamp FROM newest n ANTI JOIN taken k ON k.file_name = n.f.n AND k.load_type = n.load_type
""")
def q_unprocessed_latest(spark, sf_dir):
    from tierlake.functions.casts import file_timestamp
    from tierlake.operators.incremental import select_unprocessed_latest
    files = event_files(table(spark, sf_dir, "events")) \
        .withColumn("file_timestamp", file_timestamp("file_name"))
    jobs = event_file_jobs(files)
    return select_unprocessed_latest(files, jobs, F.lit(RUN_NOW).cast("timestamp_ntz"), load_types=None)


# ------------------------------------------------------------ I1, I2, F12
@register("watermark_overlap", """
WITH w AS (SELECT max(ts) - INTERVAL 2 DAY AS wm FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00')
SELECT e.event_id, e.ts, e.user_id, e.event_type, strftime(w.wm, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS watermark_text
FROM events e, w WHERE w.wm IS NULL OR e.ts > w.wm
""")
def q_watermark_overlap(spark, sf_dir):
    """Next incremental pull: everything after the target's high-watermark minus 2 days.

    The target is the final table as of the cutoff; the source is the whole
    events table.
    """
    from tierlake.operators.incremental import high_watermark, since_watermark
    ev = table(spark, sf_dir, "events")
    target = ev.where(F.col("ts") < _ts(BATCH_CUTOFF))
    text = high_watermark(target, "ts").select("watermark_text").scalar()
    return since_watermark(ev, target, "ts").select("event_id", "ts", "user_id", "event_type",
                                                    text.alias("watermark_text"))


# -------------------------------------------------------------------- F11
@register("daily_window", f"""
WITH win AS (SELECT timezone('UTC', timezone('America/Los_Angeles',
               CAST(CAST(timezone('America/Los_Angeles', TIMESTAMP '{RUN_NOW}' AT TIME ZONE 'UTC') AS DATE) AS TIMESTAMP))) AS s)
SELECT e.event_id, e.ts, e.event_type, win.s - INTERVAL 1 DAY AS window_start, win.s + INTERVAL 24 HOUR AS window_end
FROM events e, win
WHERE e.ts >= win.s - INTERVAL 1 DAY AND e.ts < win.s + INTERVAL 24 HOUR
""")
def q_daily_window(spark, sf_dir):
    from tierlake.functions.casts import pacific_day_window
    start, end = pacific_day_window(F.lit(RUN_NOW).cast("timestamp_ntz"))
    ev = table(spark, sf_dir, "events")
    lo = start - F.expr("INTERVAL 1 DAYS")
    return ev.where((F.col("ts") >= lo) & (F.col("ts") < end)).select(
        "event_id", "ts", "event_type", lo.alias("window_start"), end.alias("window_end"))


# -------------------------------------------------------------------- K11
RETENTION_NOW = "2024-03-15 00:00:00"


@register("retention", f"""
WITH f AS (SELECT 'file_' || event_type || 'extract-batch' || CAST(event_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d_%H%M%S') || '.zip' AS file_name
           FROM events
           UNION ALL
           SELECT 'manual_' || CAST(event_id AS VARCHAR) || '.zip' AS file_name FROM events WHERE event_type = 'error'),
p AS (SELECT file_name, strptime(nullif(regexp_extract(file_name, '-(\\d{{8}}_\\d{{6}})\\.[zZ][iI][pP]', 1), ''), '%Y%m%d_%H%M%S') AS file_timestamp FROM f)
SELECT file_name, file_timestamp FROM p
WHERE file_timestamp IS NOT NULL AND file_timestamp < TIMESTAMP '{RETENTION_NOW}' - INTERVAL 60 DAY
""")
def q_retention(spark, sf_dir):
    from tierlake.operators.incremental import retention_candidates
    ev = table(spark, sf_dir, "events")
    stamped = event_files(ev).select("file_name")
    unstamped = ev.where(F.col("event_type") == "error").select(
        F.concat(F.lit("manual_"), F.col("event_id").cast("string"), F.lit(".zip")).alias("file_name"))
    return retention_candidates(stamped.unionByName(unstamped), "file_name",
                                F.lit(RETENTION_NOW).cast("timestamp_ntz"), days=60) \
        .select("file_name", "file_timestamp")


# --------------------------------------------------------------------- Q6
@register("orphan_audit", """
SELECT 'lineitem->orders' AS relation, count(*) AS child_rows,
  count(*) FILTER (WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)) AS orphan_rows
FROM lineitem l
UNION ALL
SELECT 'lineitem->part', count(*),
  count(*) FILTER (WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey))
FROM lineitem l
UNION ALL
SELECT 'lineitem->supplier', count(*),
  count(*) FILTER (WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey))
FROM lineitem l
UNION ALL
SELECT 'orders->customer', count(*),
  count(*) FILTER (WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
FROM orders o
""")
def q_orphan_audit(spark, sf_dir):
    from tierlake.operators.audit import orphan_audit
    t = lambda n: table(spark, sf_dir, n)
    li = t("lineitem")
    return orphan_audit([
        ("lineitem->orders", li, t("orders"), ["l_orderkey"], ["o_orderkey"]),
        ("lineitem->part", li, t("part"), ["l_partkey"], ["p_partkey"]),
        ("lineitem->supplier", li, t("supplier"), ["l_suppkey"], ["s_suppkey"]),
        ("orders->customer", t("orders"), t("customer"), ["o_custkey"], ["c_custkey"]),
    ])


# --------------------------------------------------------------------- Q4
@register("key_audit", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT l_suppkey) AS n_variants
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_suppkey) > 1
""")
def q_key_audit(spark, sf_dir):
    from tierlake.operators.audit import key_audit
    return key_audit(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_suppkey"])


# ------------------------------------------------------------ Q1, A8-A10
def recon_sources():
    from tierlake.operators.recon import ReconSource
    return [
        ReconSource("CUSTOMERS", "customer", entity_key="CUSTOMER"),
        ReconSource("ORDERS", "orders", entity_key="ORDERS"),
        ReconSource("PARTS", "part", entity_key="PART"),
        ReconSource("SUPPLIERS", "supplier", entity_key="SUPPLIER"),
        ReconSource("NATIONS", "customer", entity_key="NATION", count_expr="count(DISTINCT c_nationkey)"),
        ReconSource("EVENT_USERS", "events", entity_key="USER", count_expr="count(DISTINCT user_id)"),
        ReconSource("LABELS", "labels", entity_key="LABEL"),
        ReconSource("ARCHIVE", "documents", entity_key="ARCHIVE", is_active=False),
    ]


def source_count_report(spark, sf_dir) -> DataFrame:
    """The source system's count report (ENTITY_NAME, REC_COUNT rows).

    Counts are what the referencing tables imply: orders referenced by line
    items, customers referenced by orders, and so on.  LABEL has no row.
    """
    t = lambda n: table(spark, sf_dir, n)
    li = t("lineitem")
    rows = [
        t("orders").agg(F.count_distinct("o_custkey").alias("c")).select(F.lit("CUSTOMER").alias("entity_key"), "c"),
        li.agg(F.count_distinct("l_orderkey").alias("c")).select(F.lit("ORDERS").alias("entity_key"), "c"),
        li.agg(F.count_distinct("l_partkey").alias("c")).select(F.lit("PART").alias("entity_key"), "c"),
        li.agg(F.count_distinct("l_suppkey").alias("c")).select(F.lit("SUPPLIER").alias("entity_key"), "c"),
        t("nation").agg(F.count(F.lit(1)).alias("c")).select(F.lit("NATION").alias("entity_key"), "c"),
        t("events").agg(F.count_distinct("user_id").alias("c")).select(F.lit("USER").alias("entity_key"), "c"),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("entity_key", F.col("c").cast("bigint").alias("source_count"))


@register("recon_counts", """
WITH local AS (
  SELECT 'CUSTOMERS' AS entity_name, 'customer' AS local_table_name, 'CUSTOMER' AS entity_key, (SELECT count(*) FROM customer) AS local_count
  UNION ALL SELECT 'ORDERS', 'orders', 'ORDERS', (SELECT count(*) FROM orders)
  UNION ALL SELECT 'PARTS', 'part', 'PART', (SELECT count(*) FROM part)
  UNION ALL SELECT 'SUPPLIERS', 'supplier', 'SUPPLIER', (SELECT count(*) FROM supplier)
  UNION ALL SELECT 'NATIONS', 'customer', 'NATION', (SELECT count(DISTINCT c_nationkey) FROM customer)
  UNION ALL SELECT 'EVENT_USERS', 'events', 'USER', (SELECT count(DISTINCT user_id) FROM events)
  UNION ALL SELECT 'LABELS', 'labels', 'LABEL', (SELECT count(*) FROM labels)),
src AS (
  SELECT 'CUSTOMER' AS entity_key, (SELECT count(DISTINCT o_custkey) FROM orders) AS source_count
  UNION ALL SELECT 'ORDERS', (SELECT count(DISTINCT l_orderkey) FROM lineitem)
  UNION ALL SELECT 'PART', (SELECT count(DISTINCT l_partkey) FROM lineitem)
  UNION ALL SELECT 'SUPPLIER', (SELECT count(DISTINCT l_suppkey) FROM lineitem)
  UNION ALL SELECT 'NATION', (SELECT count(*) FROM nation)
  UNION ALL SELECT 'USER', (SELECT count(DISTINCT user_id) FROM events))
SELECT l.entity_name, 'EXTRACT' AS source_type, l.local_table_name,
  CAST(l.local_count AS DOUBLE) AS local_count, CAST(s.source_count AS DOUBLE) AS source_count,
  CAST(s.source_count - l.local_count AS DOUBLE) AS delta,
  CASE WHEN s.source_count IS NULL THEN NULL WHEN s.source_count > 0
       THEN CAST(round(abs(s.source_count - l.local_count) * 100.0 / s.source_count, 2) AS DOUBLE) ELSE 0.0 END AS pct_delta,
  CASE WHEN s.source_count IS NULL THEN 'ERROR' WHEN s.source_count = l.local_count THEN 'OK' ELSE 'VARIANCE' END AS status,
  CASE WHEN s.source_count IS NULL THEN 'Entity ' || l.entity_key || ' not found in source counts' END AS error_message
FROM local l LEFT JOIN src s ON s.entity_key = l.entity_key
""")
def q_recon_counts(spark, sf_dir):
    from tierlake.operators.recon import local_counts, reconcile
    names = ["customer", "orders", "part", "supplier", "events", "labels", "documents"]
    tables = {n: table(spark, sf_dir, n) for n in names}
    srcs = recon_sources()
    res = reconcile(srcs, local_counts(srcs, tables), source_count_report(spark, sf_dir))
    # counts are NULL for an ERROR row: emitted as double (exact) so both engines type them alike
    return res.select(*[F.col(c).cast("double").alias(c) if c in ("local_count", "source_count", "delta")
                        else F.col(c) for c in res.columns])


# --------------------------------------------------------------- F1, F6
def _num_text():
    """Numeric text in the shapes extracts carry, chosen by line number."""
    ln = F.col("l_linenumber")
    pk, ok, sk = (F.col(c).cast("string") for c in ("l_partkey", "l_orderkey", "l_suppkey"))
    return (F.when(ln == 1, F.concat(pk, F.lit("."), F.lpad(sk, 2, "0")))
            .when(ln == 2, F.concat(F.lit("  "), ok, F.lit(" ")))
            .when(ln == 3, F.concat(pk, F.lit(",000")))
            .when(ln == 4, F.concat(ln.cast("string"), F.lit("e"), ln.cast("string")))
            .when(ln == 5, F.concat(sk, F.lit("d")))
            .when(ln == 6, F.lit("   "))
            .otherwise(F.concat(F.lit("."), pk)))


@register("safe_casts", """
WITH t AS (SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN CAST(l_partkey AS VARCHAR) || '.' || lpad(CAST(l_suppkey AS VARCHAR), 2, '0')
                    WHEN 2 THEN '  ' || CAST(l_orderkey AS VARCHAR) || ' '
                    WHEN 3 THEN CAST(l_partkey AS VARCHAR) || ',000'
                    WHEN 4 THEN CAST(l_linenumber AS VARCHAR) || 'e' || CAST(l_linenumber AS VARCHAR)
                    WHEN 5 THEN CAST(l_suppkey AS VARCHAR) || 'd'
                    WHEN 6 THEN '   '
                    ELSE '.' || CAST(l_partkey AS VARCHAR) END AS num_text
  FROM lineitem)
SELECT l_orderkey, l_linenumber, num_text,
  CAST(TRY_CAST(trim(num_text) AS DECIMAL(38,10)) AS DOUBLE) AS num,
  CAST(CAST(TRY_CAST(trim(num_text) AS DECIMAL(38,10)) AS DECIMAL(18,0)) AS DOUBLE) AS num_id,
  CAST(CASE WHEN regexp_full_match(trim(num_text), '\\d+') THEN CAST(trim(num_text) AS DECIMAL(38,0)) END AS DOUBLE) AS digits
FROM t
""")
def q_safe_casts(spark, sf_dir):
    from tierlake.functions.casts import digits_only, safe_number
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _num_text().alias("num_text"))
    return li.select("l_orderkey", "l_linenumber", "num_text",
                     safe_number("num_text").cast("double").alias("num"),
                     safe_number("num_text", "decimal(18,0)").cast("double").alias("num_id"),
                     digits_only("num_text").cast("double").alias("digits"))


# ------------------------------------------------------------ F2-F5
def _ts_text():
    et, ts = F.col("event_type"), F.col("ts")
    return (F.when(et == "click", F.date_format(ts, "M/d/yyyy"))
            .when(et == "view", F.date_format(ts, "yyyy-MM-dd"))
            .when(et == "purchase", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(et == "signup", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSS"),
                                F.lit("-05:00"))))


@register("iso_casts", """
WITH t AS (SELECT event_id, event_type, ts,
  CASE event_type WHEN 'click' THEN strftime(ts, '%-m/%-d/%Y')
                  WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
                  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                  WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                  ELSE strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '-05:00' END AS ts_text
  FROM events)
SELECT event_id, ts_text,
  CASE WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
       WHEN event_type = 'view' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
       WHEN event_type IN ('purchase', 'signup') THEN date_trunc('second', ts) + CASE WHEN event_type = 'purchase'
            THEN (epoch_us(ts) % 1000000) * INTERVAL 1 MICROSECOND ELSE INTERVAL 0 SECOND END
       ELSE NULL END AS tolerant_ts,
  CASE WHEN event_type = 'error' THEN CAST(strptime(substr(ts_text, 1, 23), '%Y-%m-%dT%H:%M:%S.%g') AS TIMESTAMP) END AS wall_ts,
  CASE WHEN event_type = 'error' THEN CAST(epoch_us(CAST(ts_text AS TIMESTAMPTZ)) AS DOUBLE) END AS instant_us
FROM t
""")
def q_iso_casts(spark, sf_dir):
    from tierlake.functions.casts import safe_timestamp, strict_iso_timestamp, strip_offset
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", _ts_text().alias("ts_text"))
    off = F.col("event_type") == "error"
    return ev.select(
        "event_id", "ts_text",
        safe_timestamp("ts_text").alias("tolerant_ts"),
        F.when(off, strip_offset("ts_text")).alias("wall_ts"),
        F.when(off, F.unix_micros(strict_iso_timestamp("ts_text"))).cast("double").alias("instant_us"))


# ------------------------------------------------------------ F7, F8
SEGMENT_WIDTHS = (4, 3, 4, 3, 3, 7, 4, 4, 5)


def _segments():
    return [F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
            F.col("l_returnflag"), F.col("l_linestatus"),
            F.col("l_quantity").cast("bigint").cast("string"),
            F.when(F.col("l_returnflag") == "R", F.lit("")),
            F.year("l_shipdate").cast("string")]


_SQL_SEGS = ["CAST(l_orderkey AS VARCHAR)", "CAST(l_partkey AS VARCHAR)", "CAST(l_suppkey AS VARCHAR)",
             "CAST(l_linenumber AS VARCHAR)", "l_returnflag", "l_linestatus",
             "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)",
             "CASE WHEN l_returnflag = 'R' THEN '' END", "CAST(year(l_shipdate) AS VARCHAR)"]


@register("segment_string", f"""
SELECT l_orderkey, l_linenumber,
  lpad(nullif(CAST(l_partkey AS VARCHAR), ''), 3, '0') AS segment2,
  concat_ws('-', {", ".join(f"coalesce(lpad(nullif({s}, ''), {w}, '0'), '')" for s, w in zip(_SQL_SEGS, SEGMENT_WIDTHS))}) AS segment_string
FROM lineitem
""")
def q_segment_string(spark, sf_dir):
    from tierlake.functions.casts import lpad_trunc, segment_string
    li = table(spark, sf_dir, "lineitem")
    segs = _segments()
    return li.select("l_orderkey", "l_linenumber",
                     lpad_trunc(segs[1], 3).alias("segment2"),
                     segment_string(segs, SEGMENT_WIDTHS).alias("segment_string"))


# ------------------------------------------------------------ S4-S7
@register("json_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  coalesce(json_extract_string(props, '$.hasMore') = 'true', false) AS has_more
FROM events
""")
def q_json_props(spark, sf_dir):
    from tierlake.sources.json_pages import has_more
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
                     has_more("props").alias("has_more"))


def event_page_bodies(ev: DataFrame) -> DataFrame:
    """Events landed as REST page bodies of PAGE_SIZE items (``page_no, body``).

    Purchases carry two child lines, clicks an empty child array, the rest
    none; ``hasMore`` is present only on full pages.  A page holds at most
    PAGE_SIZE items by construction, so the per-page collect is bounded.
    """
    child = F.struct((F.col("event_id") * 10 + 1).alias("line_id"), F.col("value").alias("amount"))
    child2 = F.struct((F.col("event_id") * 10 + 2).alias("line_id"), (F.col("value") * 2).alias("amount"))
    item = F.struct("event_id", "user_id", "event_type",
                    F.when(F.col("event_type") == "purchase", F.array(child, child2))
                     .when(F.col("event_type") == "click", F.array().cast("array<struct<line_id:bigint,amount:double>>"))
                     .alias("lines"))
    pages = ev.groupBy((F.col("event_id") / F.lit(PAGE_SIZE)).cast("bigint").alias("page_no")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("_o"), item.alias("it")))).alias("its"),
        F.count(F.lit(1)).alias("n"))
    body = F.to_json(F.struct(
        F.transform("its", lambda x: x["it"]).alias("items"),
        F.when(F.col("n") == PAGE_SIZE, F.lit(True)).alias("hasMore"),
        F.col("n").alias("count")))
    return pages.select("page_no", body.alias("body"))


@register("nested_explode", f"""
WITH p AS (SELECT event_id // {PAGE_SIZE} AS page_no, count(*) AS n FROM events GROUP BY 1),
e AS (SELECT e.*, e.event_id // {PAGE_SIZE} AS page_no FROM events e)
SELECT e.page_no, p.n = {PAGE_SIZE} AS has_more, e.event_id, e.user_id, e.event_type,
       CAST(e.event_id * 10 + c.k AS DOUBLE) AS line_id, e.value * c.k AS amount
FROM e JOIN p USING (page_no), (VALUES (1), (2)) c(k)
WHERE e.event_type = 'purchase'
UNION ALL
SELECT e.page_no, p.n = {PAGE_SIZE}, e.event_id, e.user_id, e.event_type, NULL, NULL
FROM e JOIN p USING (page_no) WHERE e.event_type <> 'purchase'
""")
def q_nested_explode(spark, sf_dir):
    from tierlake.sources.json_pages import child_rows, page_items, parse_bodies
    bodies = event_page_bodies(table(spark, sf_dir, "events"))
    items = page_items(parse_bodies(bodies, "body", _item_struct()), drop_null=["event_id"])
    out = child_rows(items, ["page_no", "has_more", "event_id", "user_id", "event_type"], "lines")
    # line_id is NULL for items without lines: emitted as double (exact) so both engines type it alike
    return out.withColumn("line_id", F.col("line_id").cast("double"))


def _item_struct():
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType
    line = StructType([StructField("line_id", LongType()), StructField("amount", DoubleType())])
    return StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                       StructField("event_type", StringType()), StructField("lines", ArrayType(line))])


# ----------------------------------------------------------- P16-P19
# Fixed demo mapping of event types onto flexfield information types.
FLEX_TYPES = {
    "click": "GCS Job Application References",
    "purchase": "Additional GCS Person Data",
    "error": "GCS Retirement",
    "signup": "Secondary Status",
}


def events_as_flex(ev: DataFrame) -> DataFrame:
    """Events in the generic flexfield staging shape (all slots text)."""
    from tierlake.plans.flex import GENERIC_COLUMNS
    it = None
    for k, v in FLEX_TYPES.items():
        it = F.when(F.col("event_type") == k, F.lit(v)) if it is None else it.when(F.col("event_type") == k, F.lit(v))
    filled = {
        "pei_info1": F.col("event_type"), "pei_info2": F.col("props"),
        "pei_date1": F.date_format("ts", "yyyy/MM/dd"), "pei_num1": F.col("user_id").cast("string"),
    }
    return ev.select(
        F.col("event_id").alias("person_extra_info_id"), F.col("user_id").alias("person_id"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("candidate_number"),
        it.alias("information_type"), F.col("ts").alias("effective_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("effective_end_date"),
        *[filled.get(c, F.lit(None).cast("string")).alias(c) for c in GENERIC_COLUMNS])


def _flex_sql(view: str) -> str:
    from tierlake.plans.flex import DECODE_VIEWS
    info_type, slots = DECODE_VIEWS[view]
    src = {"pei_info1": "event_type", "pei_info2": "props", "pei_date1": "strftime(ts, '%Y/%m/%d')",
           "pei_num1": "CAST(user_id AS VARCHAR)"}
    evt = {v: k for k, v in FLEX_TYPES.items()}[info_type]
    cols = ", ".join(f"{src.get(g, 'CAST(NULL AS VARCHAR)')} AS {a}" for g, a in slots.items())
    return (f"SELECT event_id AS person_extra_info_id, user_id AS person_id, 'C' || CAST(user_id AS VARCHAR) AS candidate_number, "
            f"'{info_type}' AS information_type, ts AS effective_start_date, CAST(NULL AS TIMESTAMP) AS effective_end_date, "
            f"{cols} FROM events WHERE event_type = '{evt}'")


def _flex_query(view: str):
    def q(spark, sf_dir):
        from tierlake.plans.flex import decode_view
        return decode_view(events_as_flex(table(spark, sf_dir, "events")), view)
    return q


for _qname, _view in [("decode_view", "ext_flex_secondary_status_v"),
                      ("decode_view_job_refs", "ext_flex_job_refs_v"),
                      ("decode_view_retirement", "ext_flex_retirement_v"),
                      ("decode_view_person_data", "ext_flex_person_data_v")]:
    register(_qname, _flex_sql(_view))(_flex_query(_view))


# ------------------------------------------------- F16-F18, A9, E2
def doc_templates(docs: DataFrame) -> DataFrame:
    """Documents as message templates: the whole text plus a token footer."""
    footer = F.concat(
        F.lit("\n${Greeting_"), F.col("lang"), F.lit("} ${CandidateFirstName}, about ${RequisitionTitle} "
                                                       "(${RequisitionNumber}) from ${SourceName}. ${Greeting_"),
        F.col("lang"), F.lit("} again. ${} ${Missing_"), F.col("source"), F.lit("} ${unclosed"))
    return docs.select("doc_id", "lang", "source", F.concat(F.col("text"), footer).alias("template"))


_SQL_TEMPLATE = ("text || chr(10) || '${Greeting_' || lang || '} ${CandidateFirstName}, about ${RequisitionTitle} "
                 "(${RequisitionNumber}) from ${SourceName}. ${Greeting_' || lang || '} again. ${} ${Missing_' || source || '} ${unclosed'")

# Fixed demo token registry: (token_name, default_value).
TOKEN_DEFAULTS = [
    ("Greeting_en", "Hello"),
    ("Greeting_fr", "Bonjour"),
    ("Greeting_es", "Hola ${CandidateFirstName}"),
    ("CandidateFirstName", "Candidate"),
    ("SourceName", "our team"),
    ("RequisitionTitle", None),
]


@register("token_df", f"""
SELECT token_name, count(*) AS template_count FROM (
  SELECT unnest(list_distinct(regexp_extract_all({_SQL_TEMPLATE}, '\\$\\{{([^}}]+)\\}}', 1))) AS token_name
  FROM documents WHERE text IS NOT NULL) t
GROUP BY token_name
""")
def q_token_df(spark, sf_dir):
    from tierlake.operators.tokens import token_frequency
    return token_frequency(doc_templates(table(spark, sf_dir, "documents")), "template")


@register("template_resolve", f"""
WITH d AS (SELECT d.doc_id, d.lang, d.source, {_SQL_TEMPLATE.replace('text', 'd.text').replace('lang', 'd.lang').replace('source', 'd.source')} AS t0,
                  p.p_name AS req_title, 'REQ-' || CAST(p.p_partkey AS VARCHAR) AS req_num
           FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id),
g AS (SELECT *, CASE lang WHEN 'en' THEN 'Hello' WHEN 'fr' THEN 'Bonjour'
                          WHEN 'es' THEN 'Hola ${{CandidateFirstName}}' END AS greet FROM d),
r1 AS (SELECT *, CASE WHEN greet IS NULL THEN t0 ELSE replace(t0, '${{Greeting_' || lang || '}}', greet) END AS t1 FROM g),
r2 AS (SELECT *, replace(t1, '${{CandidateFirstName}}', 'Reader ' || CAST(doc_id AS VARCHAR)) AS t2 FROM r1),
r3 AS (SELECT *, CASE WHEN req_title IS NULL THEN t2 ELSE replace(t2, '${{RequisitionTitle}}', req_title) END AS t3 FROM r2),
r4 AS (SELECT *, CASE WHEN req_title IS NULL THEN t3 ELSE replace(t3, '${{RequisitionNumber}}', req_num) END AS t4 FROM r3)
SELECT doc_id, replace(t4, '${{SourceName}}', source) AS resolved_text FROM r4
""")
def q_template_resolve(spark, sf_dir):
    from tierlake.operators.tokens import resolve_templates
    docs = doc_templates(table(spark, sf_dir, "documents"))
    reqs = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("req_title"),
        F.concat(F.lit("REQ-"), F.col("p_partkey").cast("string")).alias("req_num"))
    rows = docs.join(reqs, "doc_id", "left")
    context = {
        "RequisitionTitle": F.col("req_title"),
        "RequisitionNumber": F.col("req_num"),
        "JobOfferTitle": F.col("req_title"),
        "CandidateFirstName": F.concat(F.lit("Reader "), F.col("doc_id").cast("string")),
        "SourceName": F.col("source"),
    }
    from tierlake.session import local_rows
    registry = local_rows(spark, TOKEN_DEFAULTS, "token_name string, default_value string")
    out = resolve_templates(rows, "template", context, registry)
    return out.select("doc_id", "resolved_text")


# ------------------------------------------------------------ A7, P12
EXTRACT_REGION = 1


@register("ordered_listagg", """
SELECT n_regionkey AS r_regionkey,
  string_agg(n_name, ',' ORDER BY n_nationkey) AS nation_names,
  string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS nation_ids
FROM nation GROUP BY n_regionkey
""")
def q_ordered_listagg(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
        F.expr("listagg(n_name, ',') WITHIN GROUP (ORDER BY n_nationkey)").alias("nation_names"),
        F.expr("listagg(CAST(n_nationkey AS STRING), ',') WITHIN GROUP (ORDER BY n_nationkey)").alias("nation_ids"))


@register("id_list", f"""
WITH l AS (SELECT string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS ids
           FROM nation WHERE n_regionkey = {EXTRACT_REGION})
SELECT c.c_custkey, c.c_nationkey,
  coalesce(list_contains(string_split(l.ids, ','), CAST(c.c_nationkey AS VARCHAR)), false) AS in_extract
FROM customer c, l
""")
def q_id_list(spark, sf_dir):
    """Customers whose nation is on the extract's comma-separated id list.

    The list is one value (a listagg over the nation registry) evaluated
    once as a scalar subquery; the customer scan just tests membership.
    """
    from tierlake.functions.casts import id_in_list
    ids = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == EXTRACT_REGION).agg(
        F.expr("listagg(CAST(n_nationkey AS STRING), ',') WITHIN GROUP (ORDER BY n_nationkey)").alias("ids")) \
        .scalar()
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.select("c_custkey", "c_nationkey",
                    F.coalesce(id_in_list("c_nationkey", ids), F.lit(False)).alias("in_extract"))


# ------------------------------------------------------------ S8-S10
CUSTOMER_XML_COLUMNS = ["C_CUSTKEY", "C_NAME", "C_NATIONKEY", "C_ACCTBAL", "C_MKTSEGMENT"]


@register("xml_rowset", """
SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal, c_mktsegment
FROM customer
""")
def q_xml_rowset(spark, sf_dir):
    """Customer report landed as XML (``DATA_DS/ROW``) and loaded back as typed rows."""
    from tierlake.functions.casts import digits_only, safe_number
    from tierlake.session import work_path
    from tierlake.sources.xml_rowset import read_rowset, require_rows
    out = work_path(spark, "landed", "customer_report", unique=True)
    cust = table(spark, sf_dir, "customer")
    cust.select(*[F.col(c.lower()).cast("string").alias(c) for c in CUSTOMER_XML_COLUMNS]) \
        .write.format("xml").option("rowTag", "ROW").option("rootTag", "DATA_DS").mode("overwrite").save(out)
    rows = require_rows(read_rowset(spark, out, CUSTOMER_XML_COLUMNS), "customer report")
    return rows.select(
        digits_only("c_custkey").cast("bigint").alias("c_custkey"), "c_name",
        digits_only("c_nationkey").cast("int").alias("c_nationkey"),
        safe_number("c_acctbal", "decimal(18,2)").cast("double").alias("c_acctbal"), "c_mktsegment")


# ----------------------------------------------------------------- S2, S3
@register("zip_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def q_zip_csv(spark, sf_dir):
    """Orders extracted as ZIP archives of CSV, then unzipped, staged and cast back."""
    from tierlake.functions.casts import safe_number, safe_timestamp
    from tierlake.session import work_path
    from tierlake.sources.landing import read_landing_csv
    from tierlake.sources.zipped import list_zips, stage_zip_csv, write_zip_csv
    root = work_path(spark, "extracts", unique=True)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority")
    write_zip_csv(orders, f"{root}/zips").count()
    stage_zip_csv(list_zips(spark, f"{root}/zips"), f"{root}/staging").count()   # one task per archive
    land = read_landing_csv(spark, f"{root}/staging", multi_line=False, required=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                    "o_orderdate", "o_orderpriority"])
    return land.select(
        safe_number("o_orderkey", "bigint").alias("o_orderkey"), safe_number("o_custkey", "bigint").alias("o_custkey"),
        "o_orderstatus", F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
        safe_timestamp("o_orderdate").alias("o_orderdate"), "o_orderpriority")


# ------------------------------------------------------------------- X1
@register("file_stream", """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1
""")
def q_file_stream(spark, sf_dir):
    """Events landed as several files, streamed in small batches, upserted per user."""
    from tierlake.session import work_path
    from tierlake.sources.store import SnapshotTable
    from tierlake.streaming.file_ingest import ingest_files
    root = work_path(spark, "stream", unique=True)
    ev = table(spark, sf_dir, "events")
    ev.repartition(8).write.mode("overwrite").parquet(f"{root}/inbox")
    target = SnapshotTable(spark, f"{root}/final", schema=ev.schema, keys=["user_id"])
    ingest_files(spark, f"{root}/inbox", ev.schema, target, ["user_id"], _event_order(),
                 checkpoint=f"{root}/_checkpoint", max_files_per_trigger=3)
    return target.read()


# --------------------------------------------------------------- S1, I6
CATALOG_MAP = [
    (1, 10, "file\\_click%", "CLICKS", "Y"),
    (2, 20, "%purchase%", "PURCHASES", "Y"),
    (3, 20, "%extract-batch1%", "BATCH_ONE", "Y"),
    (4, 30, "%.zip", "OTHER_ZIP", "Y"),
]


@register("catalog_refresh", f"""
WITH f AS (SELECT 'file_' || event_type || 'extract-batch' || CAST(event_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d_%H%M%S') || '.zip' AS file_name, ts
           FROM events),
v AS (SELECT f.file_name,
        coalesce((SELECT m.load_type FROM (VALUES {", ".join(f"({m}, {p}, '{l}', '{t}', '{a}')" for m, p, l, t, a in CATALOG_MAP)}) AS m(map_id, priority, file_like, load_type, is_active)
                  WHERE m.is_active = 'Y' AND lower(f.file_name) LIKE lower(m.file_like) ESCAPE '\\'
                  ORDER BY m.priority, m.map_id LIMIT 1), 'UNMAPPED') AS load_type,
        strptime(regexp_extract(f.file_name, '-(\\d{{8}}_\\d{{6}})\\.[zZ][iI][pP]', 1), '%Y%m%d_%H%M%S') AS file_timestamp
      FROM f),
old AS (SELECT file_name, 'UNMAPPED' AS load_type, date_trunc('hour', ts) AS file_timestamp,
               TIMESTAMP '{BATCH_CUTOFF}' AS refreshed_ts
        FROM f WHERE ts < TIMESTAMP '{BATCH_CUTOFF}')
SELECT coalesce(o.file_name, v.file_name) AS file_name,
       CASE WHEN v.file_name IS NOT NULL THEN v.load_type ELSE o.load_type END AS load_type,
       coalesce(o.file_timestamp, v.file_timestamp) AS file_timestamp,
       CASE WHEN v.file_name IS NOT NULL THEN TIMESTAMP '{RUN_NOW}' ELSE o.refreshed_ts END AS refreshed_ts
FROM old o FULL OUTER JOIN v ON o.file_name = v.file_name
""")
def q_catalog_refresh(spark, sf_dir):
    """Catalog refresh over the events-as-files listing against the catalog as of the cutoff."""
    from tierlake.session import local_rows
    from tierlake.sources.catalog import catalog_view, refresh
    ev = table(spark, sf_dir, "events")
    files = event_files(ev).select(F.concat(F.lit("/extracts/"), F.col("file_name")).alias("path"),
                                   "arrived_ts")
    lm = local_rows(spark, [(m, p, l, t, a, "Y") for m, p, l, t, a in CATALOG_MAP],
                    "map_id int, priority int, file_like string, load_type string, is_active string, "
                    "loader_available string")
    view = catalog_view(files, lm)
    old = files.where(F.col("arrived_ts") < _ts(BATCH_CUTOFF)).select(
        F.regexp_extract("path", r"[^/]+$", 0).alias("file_name"), F.lit("UNMAPPED").alias("load_type"),
        F.lit("N").alias("loader_available"), F.date_trunc("hour", "arrived_ts").cast("timestamp_ntz").alias("file_timestamp"),
        _ts(BATCH_CUTOFF).alias("refreshed_ts"))
    return refresh(old, view, _ts(RUN_NOW)).select("file_name", "load_type", "file_timestamp", "refreshed_ts")


# ------------------------------------------------------- F14, P20, T4
# Fixed demo mapping of event types onto report keys of the load log.
REPORT_KEYS = {"click": "GALLUP", "view": "DFF", "purchase": "EXT_FLEX", "error": "USER_ROLES",
               "signup": "FA_USER_ACCOUNTS"}


@register("load_log_report", f"""
WITH l AS (SELECT event_id AS log_id,
    CASE event_type {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REPORT_KEYS.items())} END AS report_key,
    ts AS started_ts, make_timestamp(epoch_us(ts) + CAST(round(value * 60 * 1000000) AS BIGINT)) AS completed_ts
  FROM events)
SELECT log_id, report_key,
  CASE report_key WHEN 'GALLUP' THEN 'Gallup Assessments' WHEN 'QUESTIONNAIRES' THEN 'Questionnaires'
    WHEN 'DFF' THEN 'DFF Configuration' WHEN 'EXT_FLEX' THEN 'Extensible Flex'
    ELSE concat_ws(' ', list_transform(string_split(replace(report_key, '_', ' '), ' '),
                                       lambda x: upper(x[1]) || lower(x[2:]))) END AS report_label,
  started_ts, completed_ts,
  round((epoch_us(completed_ts) - epoch_us(started_ts)) / 1000000.0, 1) AS elapsed_secs,
  round(((epoch_us(completed_ts) - epoch_us(started_ts)) / 1000000.0) % 3600, 1) AS elapsed_secs_mod_hour
FROM l
""")
def q_load_log_report(spark, sf_dir):
    """Events as a report load log: label, exact elapsed time and the minute+second parity form."""
    from tierlake.functions.casts import elapsed_seconds, elapsed_seconds_mod_hour, report_label
    ev = table(spark, sf_dir, "events")
    key = None
    for k, v in REPORT_KEYS.items():
        key = F.when(F.col("event_type") == k, F.lit(v)) if key is None else key.when(F.col("event_type") == k, F.lit(v))
    done = F.timestamp_add("MICROSECOND", F.round(F.col("value") * 60 * 1_000_000).cast("bigint"), F.col("ts"))
    log = ev.select(F.col("event_id").alias("log_id"), key.alias("report_key"), F.col("ts").alias("started_ts"),
                    done.alias("completed_ts"))
    return log.select("log_id", "report_key", report_label("report_key").alias("report_label"),
                      "started_ts", "completed_ts",
                      elapsed_seconds("started_ts", "completed_ts").alias("elapsed_secs"),
                      elapsed_seconds_mod_hour("started_ts", "completed_ts").alias("elapsed_secs_mod_hour"))


# ------------------------------------------------------------ K8, K9
# Fixed demo mapping: event types as job state changes.
JOB_STATUS = {"signup": "LOADING", "view": "STAGED", "click": "STAGED", "purchase": "MERGED", "error": "ERROR"}


def job_events(ev: DataFrame) -> DataFrame:
    """Events as load-job state changes: one job per user, counts only on some events."""
    st = None
    for k, v in JOB_STATUS.items():
        st = F.when(F.col("event_type") == k, F.lit(v)) if st is None else st.when(F.col("event_type") == k, F.lit(v))
    return ev.select(
        F.col("user_id").alias("job_id"), st.alias("status"),
        F.when(F.col("event_type") == "view", F.col("event_id")).alias("rows_loaded"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("rows_merged"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.col("ts").alias("event_ts"), F.col("event_id").alias("event_seq"))


@register("job_state", """
WITH e AS (SELECT user_id AS job_id,
    CASE event_type WHEN 'signup' THEN 'LOADING' WHEN 'view' THEN 'STAGED' WHEN 'click' THEN 'STAGED'
                    WHEN 'purchase' THEN 'MERGED' WHEN 'error' THEN 'ERROR' END AS status,
    CASE WHEN event_type = 'view' THEN event_id END AS rows_loaded,
    CASE WHEN event_type = 'purchase' THEN value END AS rows_merged,
    CASE WHEN event_type = 'error' THEN props END AS error_message,
    ts AS event_ts, event_id AS event_seq FROM events)
SELECT job_id,
  arg_max(status, {'t': event_ts, 's': event_seq}) FILTER (WHERE status IS NOT NULL) AS status,
  CAST(arg_max(rows_loaded, {'t': event_ts, 's': event_seq}) FILTER (WHERE rows_loaded IS NOT NULL) AS DOUBLE) AS rows_loaded,
  arg_max(rows_merged, {'t': event_ts, 's': event_seq}) FILTER (WHERE rows_merged IS NOT NULL) AS rows_merged,
  arg_max(error_message, {'t': event_ts, 's': event_seq}) FILTER (WHERE error_message IS NOT NULL) AS error_message,
  max(event_ts) AS event_ts, max(event_seq) AS event_seq
FROM e GROUP BY job_id
""")
def q_job_state(spark, sf_dir):
    """Current job state = latest non-NULL value per column of its state-change events."""
    from tierlake.operators.upsert import current_state
    st = current_state(job_events(table(spark, sf_dir, "events")), ["job_id"], ["event_ts", "event_seq"])
    # rows_loaded is NULL for jobs never staged: emitted as double (exact) for both engines
    return st.withColumn("rows_loaded", F.col("rows_loaded").cast("double"))


# ------------------------------------------------------ S13, M7, I1
@register("rest_sync", f"""
WITH items AS (SELECT CAST(user_id AS VARCHAR) AS resource_key, event_id // {PAGE_SIZE} AS page_no,
                      event_id AS _seq, event_type, value, ts AS LastUpdateDate FROM events),
final AS (SELECT resource_key, event_type, value, LastUpdateDate FROM items
          WHERE LastUpdateDate < TIMESTAMP '{BATCH_CUTOFF}'
          QUALIFY row_number() OVER (PARTITION BY resource_key ORDER BY page_no DESC, _seq DESC) = 1),
src AS (SELECT resource_key, event_type, value, LastUpdateDate FROM items
        WHERE LastUpdateDate > TIMESTAMP '{BATCH_CUTOFF}' - INTERVAL 2 DAY
        QUALIFY row_number() OVER (PARTITION BY resource_key ORDER BY page_no DESC, _seq DESC) = 1)
SELECT resource_key, event_type, value, LastUpdateDate FROM final f
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.resource_key = f.resource_key)
UNION ALL SELECT resource_key, event_type, value, LastUpdateDate FROM src
""")
def q_rest_sync(spark, sf_dir):
    """Incremental REST sync: landed pages newer than last sync - 2 days, folded and upserted."""
    from tierlake.operators.upsert import fold_pages
    from tierlake.plans.rest_datasets import sync_source
    ev = table(spark, sf_dir, "events")
    items = ev.select(F.col("user_id").cast("string").alias("resource_key"),
                      (F.col("event_id") / F.lit(PAGE_SIZE)).cast("bigint").alias("page_no"),
                      F.col("event_id").alias("_seq"), "event_type", "value", F.col("ts").alias("LastUpdateDate"))
    final = fold_pages(items.where(F.col("LastUpdateDate") < _ts(BATCH_CUTOFF)), ["resource_key"]) \
        .drop("page_no", "_seq").withColumn("row_sync_ts", _ts(BATCH_CUTOFF))
    out = sync_source(items, final, last_sync=BATCH_CUTOFF, sync_ts=None)
    return out.select("resource_key", "event_type", "value", "LastUpdateDate")


# ------------------------------------------- S3, P1-P3, D1-D4, K1-K4, M1
def orders_spec():
    """A demo entity spec for the orders extract (landing headers are upper case)."""
    from tierlake.plans.specs import Col, EntitySpec
    return EntitySpec(
        name="DEMO_ORDERS", keys=("o_orderkey",), order=(("o_orderdate", "desc"),), not_null=("o_orderkey",),
        columns=(Col("o_orderkey", "O_ORDERKEY", "num:bigint"), Col("o_custkey", "O_CUSTKEY", "num:bigint"),
                 Col("o_orderstatus", "O_ORDERSTATUS"), Col("o_totalprice", "O_TOTALPRICE", "num:decimal(18,2)"),
                 Col("o_orderdate", "O_ORDERDATE", "ts"), Col("o_orderpriority", "O_ORDERPRIORITY", "blank")),
        compare=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))


ORDERS_FIRST_TO = "1998-06-01 00:00:00"     # first extract: orders dated before this
ORDERS_SECOND_FROM = "1997-06-01 00:00:00"  # second extract overlaps the first by a year


@register("three_tier_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
""")
def q_three_tier_load(spark, sf_dir):
    """Orders landed as two CSV extracts, staged, previewed and merged; the final read back."""
    from tierlake.plans import entity_flow as EF
    from tierlake.session import work_path
    root = work_path(spark, "three_tier", unique=True)
    spec = orders_spec()
    orders = table(spark, sf_dir, "orders")
    text = orders.select(*[F.col(c).cast("string").alias(c.upper()) for c in orders.columns])
    text.where(F.col("o_orderdate") < _ts(ORDERS_FIRST_TO)) \
        .write.option("header", "true").mode("overwrite").csv(f"{root}/landing/extract1")
    text.where(F.col("o_orderdate") >= _ts(ORDERS_SECOND_FROM)) \
        .write.option("header", "true").mode("overwrite").csv(f"{root}/landing/extract2")
    wh = EF.Warehouse(spark, f"{root}/warehouse")
    for n in (1, 2):
        job, _ = EF.load_and_preview(wh, spec, f"{root}/landing/extract{n}", f"extract{n}.zip", multi_line=False)
        EF.merge_job(wh, spec, job, f"extract{n}.zip")
    final = wh.final(spec).read()
    return final.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("double"),
                        "o_orderdate", "o_orderpriority")


# --------------------------------- D1-D4, K2-K6 with values that change
# What the second extract of the demo changes, repeats and leaves without a key.
_CHANGED = "o_orderpriority = '1-URGENT'"
_REPEATED = "o_orderstatus = 'F'"
_KEYLESS = "o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"
_SQL_LOADS = f"""
WITH x1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
            FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_FIRST_TO}'),
x2 AS (SELECT CASE WHEN NOT ({_KEYLESS}) THEN o_orderkey END AS o_orderkey, o_custkey,
              CASE WHEN {_CHANGED} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_SECOND_FROM}'
       UNION ALL
       SELECT o_orderkey, o_custkey, 'OLD', CAST(o_totalprice AS DECIMAL(18,2)), o_orderdate - INTERVAL 1 DAY, o_orderpriority
       FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_SECOND_FROM}' AND {_REPEATED}),
s2 AS (SELECT * FROM x2 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1)"""


def two_extracts(spark, sf_dir, root: str):
    """Orders landed as two CSV extracts: the second changes rows, repeats keys with older rows, and has rows without key."""
    orders = table(spark, sf_dir, "orders")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    late = orders.where(F.col("o_orderdate") >= _ts(ORDERS_SECOND_FROM))
    second = late.withColumn("o_orderkey", F.when(~F.expr(_KEYLESS), F.col("o_orderkey"))) \
        .withColumn("o_orderstatus", F.when(F.expr(_CHANGED), "X").otherwise(F.col("o_orderstatus")))
    older = late.where(_REPEATED).withColumn("o_orderstatus", F.lit("OLD")) \
        .withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 1 DAY"))
    for n, df in ((1, orders.where(F.col("o_orderdate") < _ts(ORDERS_FIRST_TO)).select(*names)),
                  (2, second.select(*names).unionByName(older.select(*names)))):
        df.select(*[F.col(c).cast("string").alias(c.upper()) for c in names]) \
            .write.option("header", "true").csv(f"{root}/landing/extract{n}")
    return [f"{root}/landing/extract{n}" for n in (1, 2)]


def load_twice(spark, sf_dir):
    """Both extracts through the whole flow; the warehouse, its spec and the counts of each load."""
    from dataclasses import replace
    from tierlake.plans import entity_flow as EF
    from tierlake.session import work_path
    root = work_path(spark, "two_loads", unique=True)
    spec = replace(orders_spec(), not_null=())
    wh = EF.Warehouse(spark, f"{root}/warehouse")
    done = []
    for n, path in enumerate(two_extracts(spark, sf_dir, root), 1):
        job, counts = EF.load_and_preview(wh, spec, path, f"extract{n}.zip", multi_line=False)
        merged = EF.merge_job(wh, spec, job, f"extract{n}.zip")
        done.append((n, counts["rows_loaded"], counts["new_count"], counts["changed_count"], counts["unchanged_count"], merged))
    return wh, spec, done


@register("load_counts", _SQL_LOADS + """
SELECT 1 AS load_no, (SELECT count(*) FROM x1) AS rows_loaded, (SELECT count(*) FROM x1) AS new_count, 0 AS changed_count,
       0 AS unchanged_count, (SELECT count(*) FROM x1) AS merged_count
UNION ALL
SELECT 2, (SELECT count(DISTINCT o_orderkey) FROM x2),
       (SELECT count(*) FROM s2 WHERE NOT EXISTS (SELECT 1 FROM x1 WHERE x1.o_orderkey = s2.o_orderkey)),
       (SELECT count(*) FROM s2 JOIN x1 USING (o_orderkey) WHERE (s2.o_custkey, s2.o_orderstatus, s2.o_totalprice, s2.o_orderdate)
               IS DISTINCT FROM (x1.o_custkey, x1.o_orderstatus, x1.o_totalprice, x1.o_orderdate)),
       (SELECT count(*) FROM s2 JOIN x1 USING (o_orderkey) WHERE (s2.o_custkey, s2.o_orderstatus, s2.o_totalprice, s2.o_orderdate)
               IS NOT DISTINCT FROM (x1.o_custkey, x1.o_orderstatus, x1.o_totalprice, x1.o_orderdate)),
       (SELECT count(*) FROM s2 WHERE o_orderkey IS NOT NULL)
""")
def q_load_counts(spark, sf_dir):
    """Loaded, new, changed, unchanged and merged rows of two loads, the second with changes, repeats and NULL keys."""
    from tierlake.session import local_rows
    _, _, done = load_twice(spark, sf_dir)
    return local_rows(spark, done, "load_no int, rows_loaded bigint, new_count bigint, changed_count bigint, "
                                   "unchanged_count bigint, merged_count bigint")


@register("pruned_merge", _SQL_LOADS + """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderdate, o_orderpriority, 'final' AS tier
FROM (SELECT * FROM s2 WHERE o_orderkey IS NOT NULL
      UNION ALL SELECT * FROM x1 WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.o_orderkey = x1.o_orderkey)) f
UNION ALL
SELECT NULL, NULL, NULL, NULL, max(o_orderdate), NULL, 'quarantine' FROM s2 WHERE o_orderkey IS NULL HAVING count(*) > 0
""")
def q_pruned_merge(spark, sf_dir):
    """The final after two loads and a compaction of the touched files, and the date of the row held back for its NULL key."""
    wh, spec, _ = load_twice(spark, sf_dir)
    target = wh.final(spec)
    target.compact()
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    final = target.read().select(*names).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))
    from tierlake.sources import files
    held = wh.quarantine_path(spec)
    if not files.names(spark, held):
        return final.withColumn("tier", F.lit("final"))
    kept = spark.read.parquet(held).agg(F.max("o_orderdate").alias("o_orderdate"))
    rest = kept.select(*[F.col(n) if n == "o_orderdate" else F.lit(None).cast(final.schema[n].dataType).alias(n) for n in names])
    return final.withColumn("tier", F.lit("final")).unionByName(rest.withColumn("tier", F.lit("quarantine")))


# --------------------------------------------- S12, S13, I3, I4, K8, M7
# A demo registry over the events: one source per event type; REGISTRY_FAILS has lost its date field in the second run.
DEMO_REGISTRY = [("click", "Clicks", "B", "LastUpdateDate", "INCREMENTAL", "Y", None), ("view", "Views", "A", None, "FULL_ONLY", "Y", None),
                 ("purchase", "Purchases", "A", "LastUpdateDate", "INCREMENTAL", "Y", None), ("signup", "Signups", "B", None, "CODE_BASED", "Y", "load_signups"),
                 ("error", "Errors", "A", "LastUpdateDate", "INCREMENTAL", "N", None)]
REGISTRY_FAILS = "purchase"
REGISTRY_RUNS = (BATCH_CUTOFF, "2024-02-15 00:00:00")


def synced_events(spark, sf_dir):
    """Two registry runs over landed event items: up to the cutoff, then everything; one source fails in the second."""
    import datetime as dt
    from tierlake.plans.registry_sync import REGISTRY_SCHEMA, RegistrySync
    from tierlake.session import local_rows, work_path
    ev = table(spark, sf_dir, "events")
    sync = RegistrySync(spark, work_path(spark, "registry", unique=True))
    registry = local_rows(spark, DEMO_REGISTRY, REGISTRY_SCHEMA)
    times = [dt.datetime.fromisoformat(t) for t in REGISTRY_RUNS]
    for n, now in enumerate(times):
        def items(name, n=n):
            rows = ev.where(F.col("event_type") == name)
            rows = rows.where(F.col("ts") < _ts(BATCH_CUTOFF)) if n == 0 else rows
            date = "changed" if n and name == REGISTRY_FAILS else "lastupdatedate"
            return rows.select((F.col("event_id") / F.lit(PAGE_SIZE)).cast("bigint").alias("_page"), F.col("event_id").alias("_seq"),
                               F.col("user_id").cast("string").alias("resource_key"), "value", F.col("ts").alias(date))
        sync.sync_all(registry, items, f"run{n + 1}", now, strict=False)
    return sync


_SQL_SYNCED = f"""
WITH items AS (SELECT event_type AS source, CAST(user_id AS VARCHAR) AS resource_key, event_id // {PAGE_SIZE} AS page, event_id AS seq, value, ts FROM events
               WHERE event_type <> 'error'),
r1 AS (SELECT * FROM items WHERE ts < TIMESTAMP '{BATCH_CUTOFF}'
       QUALIFY row_number() OVER (PARTITION BY source, resource_key ORDER BY page DESC, seq DESC) = 1),
r2 AS (SELECT * FROM items WHERE source <> '{REGISTRY_FAILS}' AND (source = 'view' OR ts > TIMESTAMP '{REGISTRY_RUNS[0]}' - INTERVAL 2 DAY)
       QUALIFY row_number() OVER (PARTITION BY source, resource_key ORDER BY page DESC, seq DESC) = 1)"""


@register("registry_sync", _SQL_SYNCED + f"""
SELECT source, resource_key, value, ts AS last_update, TIMESTAMP '{REGISTRY_RUNS[1]}' AS row_sync_ts FROM r2
UNION ALL
SELECT source, resource_key, value, ts, TIMESTAMP '{REGISTRY_RUNS[0]}' FROM r1
WHERE source <> 'view' AND NOT EXISTS (SELECT 1 FROM r2 WHERE r2.source = r1.source AND r2.resource_key = r1.resource_key)
""")
def q_registry_sync(spark, sf_dir):
    """The declared tables after two runs; the source that failed in the second keeps the state of the first."""
    sync = synced_events(spark, sf_dir)
    out = None
    for name, *_ in DEMO_REGISTRY:
        if sync.table(name).current_version() is None:
            continue
        one = sync.table(name).read().select(F.lit(name).alias("source"), "resource_key", "value", F.col("lastupdatedate").alias("last_update"), "row_sync_ts")
        out = one if out is None else out.unionByName(one)
    return out


@register("registry_runs", _SQL_SYNCED + f"""
SELECT 'run1' AS run_id, source AS module_static_id, CASE source WHEN 'view' THEN 'FULL' ELSE 'INCREMENTAL' END AS mode,
       CAST(NULL AS TIMESTAMP) AS window_start, 'SUCCESS' AS status, count(*) AS rows_merged FROM r1 GROUP BY source
UNION ALL
SELECT 'run2', source, CASE source WHEN 'view' THEN 'FULL' ELSE 'INCREMENTAL' END,
       CASE source WHEN 'view' THEN NULL ELSE TIMESTAMP '{REGISTRY_RUNS[0]}' - INTERVAL 2 DAY END, 'SUCCESS', count(*) FROM r2 GROUP BY source
UNION ALL SELECT 'run2', '{REGISTRY_FAILS}', 'INCREMENTAL', NULL, 'ERROR', 0
""")
def q_registry_runs(spark, sf_dir):
    """What each source did in each run: mode, window, outcome and merged rows."""
    return synced_events(spark, sf_dir).runs().select("run_id", "module_static_id", "mode", "window_start", "status", "rows_merged")


# ------------------------------------------------------------------ I5
PASS_ROWS = 4000        # rows after which a demo pass ends


def event_passes(spark, sf_dir):
    """Events landed by cursor passes: each pass has its own pages from 1 on and overlaps the one before by two days."""
    ev = table(spark, sf_dir, "events")
    first = F.col("event_id") < F.lit(PASS_ROWS)
    cut = ev.where(first).agg(F.max("ts")).first()[0]
    both = ev.where(first).withColumn("pass_no", F.lit(1)).unionByName(
        ev.where(~first | (F.col("ts") > F.lit(cut).cast("timestamp_ntz") - F.expr("INTERVAL 2 DAYS"))).withColumn("pass_no", F.lit(2)))
    from pyspark.sql import Window
    at = F.row_number().over(Window.partitionBy("pass_no", "user_id").orderBy("event_id"))
    return both.withColumn("page_no", at)


@register("cursor_passes", f"""
WITH cut AS (SELECT max(ts) AS c FROM events WHERE event_id < {PASS_ROWS}),
both_passes AS (SELECT *, 1 AS pass_no FROM events WHERE event_id < {PASS_ROWS}
         UNION ALL SELECT e.*, 2 FROM events e, cut WHERE e.event_id >= {PASS_ROWS} OR e.ts > c - INTERVAL 2 DAY),
paged AS (SELECT *, row_number() OVER (PARTITION BY pass_no, user_id ORDER BY event_id) AS page_no FROM both_passes)
SELECT CAST(user_id AS VARCHAR) AS resource_key, event_type, value, pass_no, page_no FROM paged
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY pass_no DESC, page_no DESC, event_id DESC) = 1
""")
def q_cursor_passes(spark, sf_dir):
    """Items of overlapping passes merged in the order (pass, page, position): the last pass wins."""
    from tierlake.plans.registry_sync import declared_items
    pages = event_passes(spark, sf_dir).groupBy("pass_no", "page_no").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "user_id", "event_type", "value"))).alias("items"))
    rows = declared_items(pages, "user_id")
    folded = fold_pages(rows, ["resource_key"], "_page", "_seq")
    return folded.select("resource_key", "event_type", "value", F.col("_page.pass_no").alias("pass_no"), F.col("_page.page_no").alias("page_no"))


# --------------------------------------------------- I6, S2, K7-K9, I7, I8
DAILY_MAP = [(1, 10, "%demo\\_orders%", "DEMO_ORDERS", "Y", "Y"), (2, 20, "%demo\\_customers%", "DEMO_CUSTOMERS", "Y", "Y"),
             (3, 30, "%demo\\_retired%", "DEMO_CUSTOMERS", "Y", "N")]


def customers_spec():
    from tierlake.plans.specs import Col, EntitySpec
    return EntitySpec(name="DEMO_CUSTOMERS", keys=("c_custkey",), not_null=("c_custkey",),
                      columns=(Col("c_custkey", "C_CUSTKEY", "num:bigint"), Col("c_name", "C_NAME"), Col("c_mktsegment", "C_MKTSEGMENT")))


@register("daily_run", f"""
SELECT 'DEMO_ORDERS' AS load_type, o_orderkey AS k, o_orderstatus AS label, 'file_demo_orders-b2' AS file_start, 'MERGED' AS status
FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_SECOND_FROM}'
UNION ALL
SELECT 'DEMO_CUSTOMERS', c_custkey, c_mktsegment, 'file_demo_customers-b1', 'MERGED' FROM customer
""")
def q_daily_run(spark, sf_dir):
    """One daily run over archives: catalog, newest file per type, unzip, stage, preview, merge; the finals and their jobs.

    An older orders file, an excluded name, one that no loader takes and one of last month wait in the same folder.
    """
    import datetime as dt
    from tierlake.plans.daily import DailyRun
    from tierlake.plans.entity_flow import Warehouse
    from tierlake.session import local_rows, work_path
    from tierlake.sources.zipped import write_zip_csv
    root = work_path(spark, "daily", unique=True)
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    upper = lambda df: df.select(*[F.col(c).cast("string").alias(c.upper()) for c in df.columns])
    for prefix, stamp, rows in (
            ("file_demo_orders-b1", "20240120_100000", orders.where(F.col("o_orderdate") < _ts(ORDERS_SECOND_FROM))),
            ("file_demo_orders-b2", "20240120_110000", orders.where(F.col("o_orderdate") >= _ts(ORDERS_SECOND_FROM))),
            ("file_demo_customers-b1", "20240120_120000", customers),
            ("file_demo_customers_poheaderdffpublic-b1", "20240120_130000", customers),
            ("file_demo_retired-b1", "20240120_140000", customers),
            ("file_demo_customers-b0", "20231220_120000", customers)):
        write_zip_csv(upper(rows).coalesce(1), f"{root}/inbox", prefix, f"-{stamp}").count()
    wh = Warehouse(spark, f"{root}/warehouse")
    lm = local_rows(spark, DAILY_MAP, "map_id int, priority int, file_like string, load_type string, is_active string, loader_available string")
    specs = {"DEMO_ORDERS": orders_spec(), "DEMO_CUSTOMERS": customers_spec()}
    run = DailyRun(wh, specs, f"{root}/inbox", lm, load_types=list(specs), multi_line=False)
    now = dt.datetime.fromisoformat(RUN_NOW)
    run.run(now)
    run.run(now)        # nothing is left for a second run of the day
    jobs = wh.jobs().current().select("load_type", F.substring_index("file_name", "-", 2).alias("file_start"), "status")
    finals = wh.final(specs["DEMO_ORDERS"]).read().select(F.lit("DEMO_ORDERS").alias("load_type"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("label")) \
        .unionByName(wh.final(specs["DEMO_CUSTOMERS"]).read().select(F.lit("DEMO_CUSTOMERS").alias("load_type"), F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("label")))
    return finals.join(F.broadcast(jobs), "load_type")      # two jobs


# ------------------------------------------------------------- X1, D1, M1
@register("entity_stream", f"""
WITH x AS (SELECT *, CASE WHEN event_id < {PASS_ROWS} THEN 1 ELSE 2 END AS file FROM events)
SELECT user_id, event_type, value, ts FROM x
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, file DESC, event_id) = 1
""")
def q_entity_stream(spark, sf_dir):
    """Events as CSV extracts, the later file first, streamed one file a batch through stage, preview and merge."""
    wh, spec = streamed_events(spark, sf_dir)
    return wh.final(spec).read().select("user_id", "event_type", "value", "ts")


def events_spec():
    from tierlake.plans.specs import Col, EntitySpec
    return EntitySpec(name="DEMO_EVENTS", keys=("user_id",), order=(("ts", "desc"),), not_null=("user_id",),
                      columns=(Col("user_id", "USER_ID", "num:bigint"), Col("event_type", "EVENT_TYPE"), Col("value", "VALUE", "num:double"),
                               Col("ts", "TS", "ts")), compare=("user_id", "event_type", "value", "ts"))


def streamed_events(spark, sf_dir):
    from tierlake.plans.entity_flow import Warehouse
    from tierlake.session import work_path
    from tierlake.streaming.file_ingest import ingest_entity
    root = work_path(spark, "entity_stream", unique=True)
    ev = table(spark, sf_dir, "events")
    wh, spec = Warehouse(spark, f"{root}/warehouse"), events_spec()
    late = F.col("event_id") >= PASS_ROWS
    for rows in (ev.where(late), ev.where(~late), ev.where(~late)):      # a late file, then it again
        text = rows.orderBy("event_id").select(F.col("user_id").cast("string").alias("USER_ID"), F.col("event_type").alias("EVENT_TYPE"),
                                               F.col("value").cast("string").alias("VALUE"), F.col("ts").cast("string").alias("TS"))
        text.coalesce(1).write.mode("append").option("header", "true").csv(f"{root}/inbox")
        ingest_entity(wh, spec, f"{root}/inbox", f"{root}/checkpoint", max_files_per_trigger=1)
    return wh, spec


@register("entity_stream_counts", f"""
WITH late AS (SELECT * FROM events WHERE event_id >= {PASS_ROWS}
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1),
early AS (SELECT * FROM events WHERE event_id < {PASS_ROWS}
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1),
merged AS (SELECT coalesce(l.user_id, e.user_id) AS user_id, (l.user_id IS NULL OR e.ts >= l.ts) AS won,
                  e.user_id IS NOT NULL AS sent, l.user_id IS NOT NULL AS had FROM late l FULL OUTER JOIN early e ON l.user_id = e.user_id)
SELECT 0 AS batch_id, (SELECT count(*) FROM events WHERE event_id >= {PASS_ROWS}) AS rows_read, count(*) AS rows_loaded, count(*) AS new_count,
       0 AS stale_count, count(*) AS merged_count FROM late
UNION ALL
SELECT b, (SELECT count(*) FROM events WHERE event_id < {PASS_ROWS}), count(*), CASE b WHEN 1 THEN count(*) FILTER (WHERE NOT had) ELSE 0 END,
       count(*) FILTER (WHERE NOT won), count(*) FILTER (WHERE won)
FROM merged, (VALUES (1), (2)) AS t(b) WHERE sent GROUP BY b
""")
def q_entity_stream_counts(spark, sf_dir):
    """What each micro-batch read, loaded, found new or stale and merged, from the commits."""
    from tierlake.streaming.file_ingest import stream_counts
    wh, spec = streamed_events(spark, sf_dir)
    return stream_counts(wh.final(spec)).select("batch_id", "rows_read", "rows_loaded", "new_count", "stale_count", "merged_count")


# ------------------------------------------------------------- Q2, Q3, A8
RECON_REPORTS = {"CUSTOMERS": "MASTER", "SUPPLIERS": "MASTER", "NATIONS": "MASTER"}


@register("recon_runs", ORACLE_SQL["recon_counts"].split("SELECT l.entity_name")[0] + """,
one AS (SELECT l.entity_name, l.local_count, s.source_count, l.entity_name IN ('CUSTOMERS', 'SUPPLIERS', 'NATIONS') AS master
        FROM local l LEFT JOIN src s ON s.entity_key = l.entity_key),
both_runs AS (SELECT r.run_id, o.entity_name, o.local_count, CASE WHEN r.run_id = 'run1' AND o.master THEN NULL ELSE o.source_count END AS source_count
              FROM one o, (VALUES ('run1'), ('run2')) AS r(run_id)),
told AS (SELECT *, CASE WHEN source_count IS NULL THEN 'ERROR' WHEN source_count = local_count THEN 'OK' ELSE 'VARIANCE' END AS status FROM both_runs)
SELECT run_id, entity_name, CAST(local_count AS DOUBLE) AS local_count, CAST(source_count AS DOUBLE) AS source_count, status,
       count(*) OVER (PARTITION BY run_id) AS total_sources, count(*) FILTER (WHERE status = 'OK') OVER (PARTITION BY run_id) AS sources_ok,
       count(*) FILTER (WHERE status = 'VARIANCE') OVER (PARTITION BY run_id) AS sources_variance,
       count(*) FILTER (WHERE status = 'ERROR') OVER (PARTITION BY run_id) AS sources_error
FROM told
""")
def q_recon_runs(spark, sf_dir):
    """Two stored runs over one day's reports: one report fails in the first, the other is read from the store in the second."""
    from dataclasses import replace
    from tierlake.operators.recon import ReconRuns
    from tierlake.session import work_path
    names = ["customer", "orders", "part", "supplier", "events", "labels", "documents"]
    tables = {n: table(spark, sf_dir, n) for n in names}
    sources = [replace(s, report=RECON_REPORTS.get(s.entity_name, "COUNTS")) for s in recon_sources()]

    def down():
        raise RuntimeError("the report cannot be read now")

    def report():
        return source_count_report(spark, sf_dir)
    store = ReconRuns(spark, work_path(spark, "recon", unique=True))
    store.run("run1", sources, tables, {"MASTER": down, "COUNTS": report}, "2024-01-20")
    store.run("run2", sources, tables, {"MASTER": report, "COUNTS": down}, "2024-01-20")
    heads = store.runs().select("run_id", "total_sources", "sources_ok", "sources_variance", "sources_error")
    found = store.results().select("run_id", "entity_name", F.col("local_count").cast("double"), F.col("source_count").cast("double"), "status")
    return found.join(F.broadcast(heads), "run_id")      # two runs


# --------------------------------------------------------------------- Q6
@register("orphan_found", f"""
SELECT 'lineitem->early orders' AS relation, count(*) AS child_rows,
  count(*) FILTER (WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderdate < TIMESTAMP '{ORDERS_SECOND_FROM}')) AS orphan_rows
FROM lineitem l
UNION ALL
SELECT 'orders->customers in credit', count(*),
  count(*) FILTER (WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)) FROM orders o
UNION ALL
SELECT 'lineitem->(part, supplier) of returns', count(*),
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_partkey = l.l_partkey AND r.l_suppkey = l.l_suppkey)) FROM lineitem l
""")
def q_orphan_found(spark, sf_dir):
    """The orphan audit over parents that lack rows, one key of two parts among them."""
    from tierlake.operators.audit import orphan_audit
    t = lambda n: table(spark, sf_dir, n)
    li, pair = t("lineitem"), ["l_partkey", "l_suppkey"]
    return orphan_audit([
        ("lineitem->early orders", li, t("orders").where(F.col("o_orderdate") < _ts(ORDERS_SECOND_FROM)), ["l_orderkey"], ["o_orderkey"]),
        ("orders->customers in credit", t("orders"), t("customer").where("c_acctbal > 0"), ["o_custkey"], ["c_custkey"]),
        ("lineitem->(part, supplier) of returns", li, li.where("l_returnflag = 'R'"), pair, pair)])


# --------------------------------------------------------------------- J9
@register("budget_combination", """
WITH b AS (SELECT l_orderkey, l_linenumber, lpad(CAST(l_suppkey AS VARCHAR), 4, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-'
    || coalesce(lpad(nullif(CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END, ''), 4, '0'), '') || '-' || coalesce(lpad(CASE WHEN l_linestatus = 'O' THEN l_linestatus END, 3, '0'), '')
    || '-' || lpad(CAST(l_partkey AS VARCHAR), 3, '0') || '-' || lpad(CAST(CAST(l_quantity AS BIGINT) % 5 AS VARCHAR), 7, '0') || '-0000-0000-00000' AS k,
    l_shipdate FROM lineitem),
c AS (SELECT k, min(l_orderkey) AS code_combination_id, count(*) AS n FROM b WHERE l_shipdate < TIMESTAMP '1995-01-01' GROUP BY k)
SELECT l_orderkey, l_linenumber, CAST(code_combination_id AS DOUBLE) AS code_combination_id, coalesce(n, 0) AS n_combinations FROM b LEFT JOIN c USING (k)
""")
def q_budget_combination(spark, sf_dir):
    """Lines as budget rows of nine segments (short, too long, empty and NULL ones) and the code combinations of the early lines."""
    from tierlake.plans.budget import with_code_combination
    from tierlake.plans.specs import BUDGET_SEGMENTS
    li = table(spark, sf_dir, "lineitem")
    parts = [F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"), F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("l_returnflag")),
             F.when(F.col("l_linestatus") == "O", F.col("l_linestatus")), F.col("l_partkey").cast("string"),
             (F.col("l_quantity").cast("bigint") % 5).cast("string"), F.lit("0"), F.lit("00"), F.lit("000000")]
    budget = li.select("l_orderkey", "l_linenumber", "l_shipdate", *[p.alias(c) for p, c in zip(parts, BUDGET_SEGMENTS)])
    combinations = budget.where(F.col("l_shipdate") < _ts("1995-01-01 00:00:00")).withColumn("code_combination_id", F.col("l_orderkey")).withColumn("account_type", F.lit("E"))
    found = with_code_combination(budget, combinations)
    return found.select("l_orderkey", "l_linenumber", F.col("code_combination_id").cast("double"), "n_combinations")


# ------------------------------------------------------------------ S3
@register("quoted_csv", """
SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars, lang FROM documents
""")
def q_quoted_csv(spark, sf_dir):
    """Documents, line breaks and quotes included, written as CSV and read back by the splitting reader."""
    from tierlake.session import work_path
    from tierlake.sources.landing import read_landing_csv
    path = work_path(spark, "quoted", unique=True)
    text = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "text", "lang")
    text.write.mode("overwrite").option("header", "true").option("escape", '"').option("quoteAll", "true") \
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    got = read_landing_csv(spark, path, required=["doc_id", "text", "lang"])
    return got.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "lang")


from tierlake import entity_queries  # noqa: E402,F401 - registers its queries here
