"""Registered queries over the declared entities and reports; their SQL is typed by hand, not made from the specs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.queries import register
from tierlake.session import table, work_path

# ------------------------------------------------ the 20 loaded entities
# Stand-in landing rows: which header of each extract gets which value of an order.  k1 is a number key that is
# sometimes blank, k2 a small number, s1 to s3 texts, ts a time that is sometimes missing, seq a number, f1 and f2 flags.
ENTITY_HEADERS = {
    "AP_DISBURSEMENT": {"APCHECKSALLCHECKID": "k1", "APCHECKSALLLASTUPDATEDATE": "ts"},
    "AP_INVOICE_HDR": {"INVOICEID": "k1"},
    "AP_INV_APPLICATION": {"APINVOICEPAYMENTSALLINVOICEPAYMENTID": "k1", "APINVOICEPAYMENTSALLLASTUPDATEDATE": "ts"},
    "GL_BALANCE": {"BALANCELEDGERID": "k2", "BALANCECODECOMBINATIONID": "k1", "BALANCECURRENCYCODE": "s1", "BALANCEACTUALFLAG": "s2",
                   "BALANCEPERIODNAME": "s3", "BALANCELASTUPDATEDATE": "ts"},
    "GL_BUDGET_BALANCE": {"LEDGERID": "k2", "BUDGETNAME": "s1", "CURRENCYCODE": "s2", "PERIODNAME": "s3", "GLBUDBALSEGMENT1": "k1", "GLBUDBALLASTUPDATEDATE": "ts"},
    "GL_CODE_COMB": {"CODECOMBINATIONCODECOMBINATIONID": "k1", "CODECOMBINATIONLASTUPDATEDATE": "ts"},
    "GL_JOURNAL_BATCH": {"JOURNALBATCHJEBATCHID": "k1", "JOURNALBATCHLASTUPDATEDATE": "ts"},
    "GL_JOURNAL_HEADER": {"JEHEADERID": "k1", "GLJEHEADERSLASTUPDATEDATE": "ts"},
    "GL_JOURNAL_LINES": {"JEHEADERID": "k1", "JELINENUM": "k2", "GLJELINESLASTUPDATEDATE": "ts"},
    "HCM_ASSIGNMENT": {"ASSIGNMENTID": "k1", "EFFECTIVESTARTDATE": "ts", "EFFECTIVESEQUENCE": "seq", "EFFECTIVELATESTCHANGE": "f1"},
    "HCM_EMPLOYEE": {"PERSONID": "k1", "ASSIGNMENTPEOEFFECTIVESTARTDATE": "ts", "ASSIGNMENTPEOPRIMARYASSIGNMENTFLAG": "f1", "ASSIGNMENTPEOEFFECTIVELATESTCHANGE": "f2"},
    "HCM_POSITION": {"POSITIONID": "k1", "EFFECTIVESTARTDATE": "ts"},
    "HCM_SALARY": {"SALARYID": "k1", "SALARYEFFECTIVESTARTDATE": "ts"},
    "POS_CUSTOM_FLEX": {"S_K_5000": "k1", "LASTUPDATEDATE": "ts"},
    "PO_HDR": {"POHEADERID": "k1"},
    "PO_LINES": {"POLINEID": "k1"},
    "QSTNR_ANSWER": {"QUESTIONANSWERBPEOQSTNANSWERID": "k1", "QUESTIONANSWERBPEOLASTUPDATEDATE": "ts"},
    "QSTNR_QUESTION": {"QUESTIONNAIREPARTICIPANTPEOQSTNRPARTICIPANTID": "k1", "QUESTIONNAIREQUESTIONPEOQSTNRQUESTIONID": "k2"},
    "QSTNR_RESPONSE": {"QUESTIONRESPONSEPEOQSTNRESPONSEID": "k1", "QSTNRESPONSEPEOLASTUPDATEDATE": "ts"},
    "SUPPLIER_HDR": {"VENDORID": "k1"},
}

_SQL_BASE = """
WITH base AS (SELECT o_orderkey AS r, CASE WHEN o_orderkey % 50 <> 0 THEN o_custkey % 997 END AS k1, o_orderkey % 7 AS k2,
    o_orderpriority AS s1, o_orderstatus AS s2, 'P' || (o_orderkey % 3)::VARCHAR AS s3, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS ts,
    o_orderkey % 4 AS seq, CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS f1, CASE WHEN o_orderkey % 5 = 0 THEN 'N' ELSE 'Y' END AS f2 FROM orders)"""


def _one(entity: str, keys: str, order: str, kept: str) -> str:
    order = order + ", " if order else ""
    return f"""
SELECT '{entity}' AS entity, (SELECT count(*) FROM base) AS n_staged, count(*) AS n_kept, sum(r)::BIGINT AS sum_kept FROM (
  SELECT r FROM base WHERE {kept} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}r) = 1) x"""


@register("entity_batches", _SQL_BASE + "\nUNION ALL".join([
    _one("AP_DISBURSEMENT", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("AP_INVOICE_HDR", "k1", "", "true"),
    _one("AP_INV_APPLICATION", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("GL_BALANCE", "k2, k1, s1, s2, s3", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("GL_BUDGET_BALANCE", "k2, s1, s2, s3, coalesce(lpad(k1::VARCHAR, 4, '0'), '')", "ts DESC NULLS LAST", "true"),
    _one("GL_CODE_COMB", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("GL_JOURNAL_BATCH", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("GL_JOURNAL_HEADER", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("GL_JOURNAL_LINES", "k1, k2", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("HCM_ASSIGNMENT", "k1", "ts DESC NULLS LAST, seq DESC", "k1 IS NOT NULL AND f1 = 'Y'"),
    _one("HCM_EMPLOYEE", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL AND f1 = 'Y' AND f2 = 'Y'"),
    _one("HCM_POSITION", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("HCM_SALARY", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("POS_CUSTOM_FLEX", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("PO_HDR", "k1", "", "true"),
    _one("PO_LINES", "k1", "", "true"),
    _one("QSTNR_ANSWER", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("QSTNR_QUESTION", "k1, k2", "", "k1 IS NOT NULL"),
    _one("QSTNR_RESPONSE", "k1", "ts DESC NULLS LAST", "k1 IS NOT NULL"),
    _one("SUPPLIER_HDR", "k1", "", "true"),
]))
def q_entity_batches(spark, sf_dir):
    """Orders as landing rows of each entity: staged with its casts, filtered and cut to one row per key by its order."""
    from tierlake.plans import specs
    from tierlake.plans.entity_flow import dedup, stage
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    values = {
        "k1": F.when(key % 50 == 0, "").otherwise((F.col("o_custkey") % 997).cast("string")), "k2": (key % 7).cast("string"), "s1": F.col("o_orderpriority"),
        "s2": F.col("o_orderstatus"), "s3": F.concat(F.lit("P"), (key % 3).cast("string")), "seq": (key % 4).cast("string"),
        "ts": F.when(key % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
        "f1": F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N"), "f2": F.when(key % 5 == 0, "N").otherwise("Y")}
    seq = F.struct(F.lit("orders").alias("file"), F.lit(0).cast("bigint").alias("block"), key.cast("bigint").alias("row")).alias("_seq")
    parts = []
    for name, headers in ENTITY_HEADERS.items():
        spec = getattr(specs, name)
        landing = o.select(*[(values[headers[h]] if h in headers else F.lit(None).cast("string")).alias(h) for h in spec.landing_columns()], seq)
        staged = stage(landing, spec, 1, "run")
        # one aggregate over the staged rows and one over the kept ones
        kept = dedup(staged, spec).agg(F.count(F.lit(1)).alias("n_kept"), F.sum("_seq.row").alias("sum_kept"))
        parts.append(kept.select(F.lit(name).alias("entity"), staged.agg(F.count(F.lit(1))).scalar().alias("n_staged"), "n_kept", "sum_kept"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------- P2-P4, P6, P8, P11, P13-P15, P21, F4, F15, F19, F22, A8
@register("small_functions", """
SELECT event_id, coalesce(CASE WHEN value > 50 THEN event_type END, CASE WHEN value > 20 THEN 'mid' END, 'low') AS first_known,
  date_trunc('second', ts) AS day_second, CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS listed,
  CASE WHEN value > 90 THEN 'payload ' || event_id WHEN event_id % 3 = 1 THEN 'not acceptable' END AS body,
  left(event_type, 3) AS cut, CASE WHEN event_id % 2 = 0 THEN '/Custom/Reports/' || event_type || '.xdo' ELSE 'shared/' || event_type || '.XDO' END AS path,
  '{"event":' || event_id || CASE WHEN value > 50 THEN ',"kind":"' || event_type || '"' ELSE '' END || '}' AS json_text,
  CAST(event_id % 2 = 0 AS INT) AS same_type, CAST(event_type = 'click' OR event_id % 4 <> 0 AS INT) AS optional_type, ts - INTERVAL 330 MINUTE AS utc_ts
FROM events
""")
def q_small_functions(spark, sf_dir):
    """First known value, seconds, fixed lists, answer bodies by status, cuts, report paths, JSON, optional parameters, offsets."""
    from tierlake.functions import casts as C
    from tierlake.plans.specs import Col
    ev = table(spark, sf_dir, "events")
    src = ev.select(
        "event_id", "event_type", "ts", "value", F.when(F.col("value") > 50, F.col("event_type")).alias("A"), F.when(F.col("value") > 20, "mid").alias("B"),
        F.lit("low").alias("C"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("D"),
        F.when(F.col("value") > 90, 200).when(F.col("event_id") % 3 == 1, 406).when(F.col("event_id") % 3 == 2, 500).otherwise(404).alias("status"),
        F.when(F.col("value") > 90, F.concat(F.lit("payload "), F.col("event_id").cast("string"))).otherwise("not acceptable").alias("answer"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" "), F.col("event_type"))).otherwise(F.concat(F.lit("shared/"), F.col("event_type"), F.lit(".XDO"))).alias("report"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(" +05:30")).alias("E"))
    same = F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("other")
    wanted = F.when(F.col("event_id") % 4 == 0, F.lit("click"))
    return src.select(
        "event_id", Col("first_known", ("A", "B", "C")).expr(), Col("day_second", "D", "date").expr(),
        F.col("event_type").isin(["click", "view"]).cast("int").alias("listed"), C.http_body("status", "answer").alias("body"),
        C.truncate("event_type", 3).alias("cut"), C.report_path("report", "/Custom/Reports").alias("path"),
        C.json_object(F.col("event_id").alias("event"), F.col("A").alias("kind")).alias("json_text"),
        F.coalesce(C.optional_eq(F.col("event_type"), same), F.lit(False)).cast("int").alias("same_type"),
        C.optional_eq(F.col("event_type"), wanted).cast("int").alias("optional_type"),
        Col("utc_ts", "E", f"iso:{C.ISO_OFFSET_BLANK_FORMAT}").expr())


# ------------------------------------- S8-S11, W4, M9, K5 and the report data sets
def land_report(rows: DataFrame, order: str, elements: dict[str, Column], path: str) -> None:
    """Rows as XML report files, one per range of ``order``: the names of the files follow the order of the rows."""
    rows.orderBy(order).select(*[v.alias(k) for k, v in elements.items()]) \
        .write.format("xml").option("rowTag", "ROW").option("rootTag", "DATA_DS").save(path)


@register("report_loads", """
WITH e AS (SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events)
SELECT 'GALLUP' AS report, (SELECT count(*) FROM e) AS n_read, count(*) AS n_kept, sum(event_id)::BIGINT AS sum_kept FROM e WHERE nth = 1
UNION ALL SELECT 'EXT_FLEX', (SELECT count(*) FROM e), count(*), sum(event_id)::BIGINT FROM e WHERE nth = 1
UNION ALL SELECT 'DFF', (SELECT count(*) FROM e), count(*), sum(event_id)::BIGINT FROM e WHERE event_type <> 'error'
UNION ALL SELECT 'QUESTIONNAIRES', count(*), count(*), sum(event_id)::BIGINT FROM e WHERE event_id % 3 <> 0
UNION ALL SELECT 'USER_ACCOUNTS', (SELECT count(*) FROM e), count(*), sum(event_id)::BIGINT FROM e WHERE nth = 1
UNION ALL SELECT 'USER_ROLES', (SELECT count(*) FROM e), count(*), sum(event_id)::BIGINT FROM e
""")
def q_report_loads(spark, sf_dir):
    """Events as the XML of each report, loaded by its policy: first row per key, strict keys, digit ids, full refresh."""
    from tierlake.plans import reports as R
    from tierlake.session import local_rows
    from tierlake.sources.store import SnapshotTable
    root = work_path(spark, "report_loads", unique=True)
    ev = table(spark, sf_dir, "events")
    event, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    unless = lambda c, v: F.when(c, F.lit(None).cast("string")).otherwise(v)
    elements = {
        "GALLUP": (R.GALLUP, {"SUBMISSION_ID": user, "REQUISITION_ID": event, "BAND": F.col("event_type"), "SCORE": F.round("value", 2).cast("string")}, "requisition_id"),
        "EXT_FLEX": (R.EXT_FLEX_STG, {"PERSON_EXTRA_INFO_ID": user, "PERSON_ID": event, "PEI_INFO1": F.col("event_type")}, "person_id"),
        "DFF": (R.BIP_DFF, {"DFF_CODE": event, "CONTEXT_CODE": unless(F.col("event_type") == "error", F.col("event_type")), "SEGMENT_IDENTIFIER": F.lit("seg")}, "dff_code"),
        "QUESTIONNAIRES": (R.BIP_QUESTIONNAIRES, {"QUESTIONNAIRE_CODE": F.lit("Q"), "QUESTION_CODE": F.col("event_type"), "QSTNR_PARTICIPANT_ID": event,
                                                  "REQUISITION_ID": F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(user)}, "qstnr_participant_id"),
        "USER_ACCOUNTS": (R.FA_USER_ACCOUNTS, {"USER_GUID": user, "USER_ID": event, "USERNAME": F.col("event_type")}, "user_id"),
        "USER_ROLES": (R.FA_USER_ROLES, {"USER_ID": event, "USER_GUID": user, "ROLE_NAME": F.col("event_type")}, "user_id")}
    done = []
    for name, (spec, values, counted) in elements.items():
        land_report(ev, "event_id", values, f"{root}/{name}")
        schema = R.typed_rows(spark, f"{root}/{name}", spec).drop("_seq").schema
        target = SnapshotTable(spark, f"{root}/final_{name}", schema, keys=list(spec.keys) or None)
        n = R.load_report(spark, f"{root}/{name}", spec, target)
        kept = target.read().agg(F.count(F.lit(1)), F.sum(F.col(counted).cast("bigint"))).first()
        done.append((name, n, kept[0], kept[1]))
    return local_rows(spark, done, "report string, n_read bigint, n_kept bigint, sum_kept bigint")


# --------------------------------- S4-S7, M5, M8 and the page data sets
def _bodies(ev: DataFrame, page: int, item: Column) -> DataFrame:
    """Landed response bodies: a page per ``page`` events, item after item in the order of ids."""
    paged = ev.withColumn("page_no", (F.col("event_id") / F.lit(page)).cast("bigint"))
    last = ev.agg(F.max("event_id")).first()[0] or 0
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", item.alias("j")))), lambda x: x["j"]), ",")
    return paged.groupBy("page_no").agg(items.alias("i")).select(
        "page_no", F.concat(F.lit('{"items":['), "i", F.lit('],"hasMore":'), F.when(F.col("page_no") == last // page, "false").otherwise("true"), F.lit("}")).alias("body"))


@register("page_datasets", """
WITH e AS (SELECT *, event_id // 250 AS page_no FROM events),
latest AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
counted AS (SELECT count(*) AS n, sum(event_id)::BIGINT AS s FROM latest)
SELECT 'dim_job_r' AS dataset, n, s FROM counted UNION ALL SELECT 'dim_grade_r', n, s FROM counted
UNION ALL SELECT 'dim_location_r', n, s FROM counted UNION ALL SELECT 'dim_department_r', n, s FROM counted
UNION ALL SELECT 'recruiting_candidates_r', count(*), sum(event_id)::BIGINT FROM
  (SELECT * FROM e WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) c
UNION ALL SELECT 'candidate_phones_r', count(*), sum(event_id)::BIGINT FROM
  (SELECT * FROM e WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) p
UNION ALL SELECT 'has_more', count(*) FILTER (WHERE page_no < (SELECT max(page_no) FROM e)), NULL FROM (SELECT DISTINCT page_no FROM e) x
""")
def q_page_datasets(spark, sf_dir):
    """Events as landed pages of the dimensions, candidates and phones: later pages win, required keys, nested children, hasMore."""
    from tierlake.plans import rest_datasets as RD
    from tierlake.sources.json_pages import parse_bodies
    ev = table(spark, sf_dir, "events")
    event, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    phones = F.when(F.col("event_type") == "click", text('[{"PhoneId":', event, ',"PhoneNumber":"old"},{"PhoneId":', user, ',"PhoneNumber":"', event, '"},{"PhoneNumber":"dropped"}]')).otherwise("[]")
    made = {
        RD.DIM_JOB: (text('{"JobId":', user, ',"JobName":"', event, '"}'), "job_name", None),
        RD.DIM_GRADE: (text('{"GradeId":', user, ',"Name":"', event, '"}'), "grade_name", None),
        RD.DIM_LOCATION: (text('{"LocationId":', user, ',"LocationName":"', event, '"}'), "location_name", None),
        RD.DIM_DEPARTMENT: (text('{"OrganizationId":', user, ',"Name":"', event, '"}'), "department_name", None),
        RD.CANDIDATES: (text('{"CandidateNumber":"C', user, '","LastName":"', event, '"', F.when(F.col("event_type") != "error", text(',"PersonId":', user)).otherwise(""), "}"), "last_name", None),
        RD.CANDIDATE_PHONES: (text('{"PersonId":', user, ',"candidatePhones":', phones, "}"), "phone_number", "phone_number <> 'old'"),
    }
    parts = []
    for ds, (item, counted, only) in made.items():
        rows = RD.page_dataset(parse_bodies(_bodies(ev, 250, item), "body", ds.item_schema()), ds)
        rows = rows.where(only) if only else rows
        parts.append(rows.agg(F.lit(ds.name).alias("dataset"), F.count(F.lit(1)).alias("n"), F.sum(F.col(counted).cast("bigint")).alias("s")))
    pages = parse_bodies(_bodies(ev, 250, made[RD.DIM_JOB][0]), "body", RD.DIM_JOB.item_schema())
    parts.append(pages.agg(F.lit("has_more").alias("dataset"), F.count_if("has_more").alias("n"), F.lit(None).cast("bigint").alias("s")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------- K3, K4, K7, K10, D2, D3, M10, T4
@register("load_log_rows", """
SELECT 1 AS log_no, 'DEMO_CUSTOMERS' AS load_type, 'STAGE' AS step, 'SUCCESS' AS status, count(*) AS rows_processed, NULL::BIGINT AS rows_inserted FROM customer
UNION ALL SELECT 2, 'DEMO_CUSTOMERS', 'STAGE', 'SUCCESS', count(*), NULL FROM customer
UNION ALL SELECT 3, 'DEMO_CUSTOMERS', 'MERGE', 'SUCCESS', count(*), count(*) FROM customer
UNION ALL SELECT 4, 'DEMO_CUSTOMERS', 'STAGE', 'ERROR', NULL, NULL
UNION ALL SELECT 5, 'DEMO_CUSTOMERS', 'final rows', 'before reset', count(*), NULL FROM customer
UNION ALL SELECT 6, 'DEMO_CUSTOMERS', 'final rows', 'after reset', 0, NULL
""")
def q_load_log_rows(spark, sf_dir):
    """The load log of a file staged twice under one job (replaced, not doubled), merged, of a file that lacks a column, and a reset."""
    from tierlake.plans.entity_flow import Warehouse, load_and_preview, merge_job
    from tierlake.queries import customers_spec
    from tierlake.session import local_rows
    from tierlake.sources.landing import MissingColumnsError
    root = work_path(spark, "load_log", unique=True)
    c = table(spark, sf_dir, "customer")
    text = c.select(*[F.col(x).cast("string").alias(x.upper()) for x in c.columns])
    text.write.option("header", "true").csv(f"{root}/good")
    text.drop("C_NAME").write.option("header", "true").csv(f"{root}/bad")
    wh, spec = Warehouse(spark, f"{root}/warehouse"), customers_spec()
    job, _ = load_and_preview(wh, spec, f"{root}/good", "good.zip", multi_line=False)
    load_and_preview(wh, spec, f"{root}/good", "good.zip", multi_line=False, job_id=job)
    merge_job(wh, spec, job, "good.zip")
    try:
        load_and_preview(wh, spec, f"{root}/bad", "bad.zip", multi_line=False)
    except MissingColumnsError:
        pass        # the log has it
    log = wh.load_log().report().collect()      # one row per step of three loads
    rows = [(n, r["load_type"], r["step"], r["status"], r["rows_processed"], r["rows_inserted"]) for n, r in enumerate(reversed(log), 1)]
    for state in ("before reset", "after reset"):
        rows.append((len(rows) + 1, spec.name, "final rows", state, wh.final(spec).read().count(), None))
        wh.reset([spec])
    return local_rows(spark, rows, "log_no int, load_type string, step string, status string, rows_processed bigint, rows_inserted bigint")


# ----------------------------------------------------------- K11, K12, P9, P11
@register("purge_and_pick", """
WITH n AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'file_' || event_type || '-b' || event_id || '.zip' WHEN 1 THEN 'fileX' || event_id || '.zip'
  WHEN 2 THEN 'staging/' || event_id WHEN 3 THEN 'MANIFEST' || event_id WHEN 4 THEN 'EXTRACT_STATUS_DATA_' || event_id ELSE 'keep_' || event_id || '.csv' END AS name,
  CASE event_type WHEN 'click' THEN 'PO_HDR' WHEN 'view' THEN 'GL_BALANCE' WHEN 'purchase' THEN 'GL_JOURNAL_LINES' ELSE 'HCM_SALARY' END AS load_type,
  'file_' || CASE WHEN event_id % 5 = 0 THEN 'SupplierSiteExtract' ELSE 'x' END || event_id || '-20240120_12' || lpad((event_id % 60)::VARCHAR, 2, '0') || '00.zip' AS file_name FROM events)
SELECT 'purge' AS what, event_id % 6 AS grp, count(*) AS n FROM n WHERE event_id % 6 IN (0, 2, 3, 4) GROUP BY event_id % 6
UNION ALL
SELECT 'pick ' || load_type, max(event_id % 60), count(DISTINCT load_type) FROM n
WHERE load_type <> 'GL_JOURNAL_LINES' AND event_id % 5 <> 0 GROUP BY load_type
""")
def q_purge_and_pick(spark, sf_dir):
    """Names that the selective purge takes; the newest file of the daily load types, excluded names left out."""
    from tierlake.functions.casts import file_timestamp
    from tierlake.operators.incremental import purge_candidates, select_unprocessed_latest
    from tierlake.queries import RUN_NOW
    ev, n = table(spark, sf_dir, "events"), F.col("event_id")
    i = n.cast("string")
    name = F.when(n % 6 == 0, F.concat(F.lit("file_"), "event_type", F.lit("-b"), i, F.lit(".zip"))).when(n % 6 == 1, F.concat(F.lit("fileX"), i, F.lit(".zip"))) \
        .when(n % 6 == 2, F.concat(F.lit("staging/"), i)).when(n % 6 == 3, F.concat(F.lit("MANIFEST"), i)) \
        .when(n % 6 == 4, F.concat(F.lit("EXTRACT_STATUS_DATA_"), i)).otherwise(F.concat(F.lit("keep_"), i, F.lit(".csv")))
    purge = purge_candidates(ev.select("event_id", name.alias("name")), "name").groupBy((n % 6).alias("grp")).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit("purge").alias("what"), "grp", "n")
    kind = F.when(F.col("event_type") == "click", "PO_HDR").when(F.col("event_type") == "view", "GL_BALANCE").when(F.col("event_type") == "purchase", "GL_JOURNAL_LINES").otherwise("HCM_SALARY")
    file = F.concat(F.lit("file_"), F.when(n % 5 == 0, "SupplierSiteExtract").otherwise("x"), i, F.lit("-20240120_12"), F.lpad((n % 60).cast("string"), 2, "0"), F.lit("00.zip"))
    files = ev.select(file.alias("file_name"), kind.alias("load_type"), F.lit("Y").alias("loader_available")).withColumn("file_timestamp", file_timestamp("file_name"))
    jobs = spark.createDataFrame([], "file_name string, load_type string, status string")
    picked = select_unprocessed_latest(files, jobs, F.lit(RUN_NOW).cast("timestamp"))      # the daily load types
    return purge.unionByName(picked.select(F.concat(F.lit("pick "), "load_type").alias("what"), F.minute("file_timestamp").cast("bigint").alias("grp"), F.lit(1).cast("bigint").alias("n")))
