"""REST datasets loaded from landed JSON pages (requisitions with children).

All landed pages of one sync are read together; merging them page after page
(later pages win) is one grouped fold per table, then one upsert into the
stored table.  Children are separate tables: the DFF child folds per column
with preserve-NULL semantics (a NULL on a later page keeps the earlier
value); published jobs are an inner flatten keyed by (requisition, visibility).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tierlake.operators.upsert import fold_pages, upsert, upsert_preserve_null
from tierlake.sources.json_pages import child_rows, page_items

# JSON field names of a requisition item (and the staging names they load into).
REQUISITION_FIELDS = [
    ("RequisitionId", "requisitionid", "bigint"), ("RequisitionNumber", "requisitionnumber", "string"),
    ("Title", "title", "string"), ("PhaseName", "phasename", "string"), ("StateName", "statename", "string"),
    ("JobFunction", "jobfunction", "string"),
    ("InternalPublishedJobStatus", "internalpublishedjobstatus", "string"),
    ("ExternalPublishedJobStatus", "externalpublishedjobstatus", "string"),
    ("NumberOfOpenings", "numberofopenings", "bigint"), ("HiredCount", "hiredcount", "bigint"),
    ("RecruitingType", "recruitingtype", "string"), ("FullTimeOrPartTime", "fulltimeorparttime", "string"),
    ("RegularOrTemporary", "regularortemporary", "string"), ("MinimumSalary", "minimumsalary", "double"),
    ("MaximumSalary", "maximumsalary", "double"), ("CompensationCurrency", "compensationcurrency", "string"),
    ("PositionId", "positionid", "bigint"), ("JobId", "jobid", "bigint"), ("GradeId", "gradeid", "bigint"),
    ("DepartmentId", "departmentid", "bigint"), ("PrimaryWorkLocationId", "primaryworklocationid", "bigint"),
    ("PrimaryLocationId", "primarylocationid", "bigint"), ("HiringManagerId", "hiringmanagerid", "bigint"),
    ("RecruiterId", "recruiterid", "bigint"), ("CreationDate", "creationdate", "ts"),
    ("LastUpdateDate", "lastupdatedate", "ts"), ("RequisitionLastModifiedDate", "reqlastmodifieddate", "ts"),
    ("CreatedBy", "createdby", "string"), ("LastUpdatedBy", "lastupdatedby", "string"),
]
DFF_FIELDS = [("transferCoordinatedWithReceivi", "transfer_coordinated"),
              ("vacancyTerminationFormSubmitte", "vacancy_term_submitted"),
              ("__FLEX_Context", "flex_context")]
PUBLISHED_FIELDS = [("Visibility", "published_visibility", "string"),
                    ("PostingStatus", "published_posting_status", "string"),
                    ("StartDate", "published_start_date", "ts"), ("EndDate", "published_end_date", "ts"),
                    ("TimeZone", "published_time_zone", "string"), ("CreatedBy", "published_created_by", "string")]

def requisition_item_schema() -> StructType:
    from pyspark.sql.types import DoubleType
    t = {"bigint": LongType(), "double": DoubleType(), "string": StringType(), "ts": StringType()}
    dff = StructType([StructField(j, StringType()) for j, _ in DFF_FIELDS])
    pub = StructType([StructField(j, t[k]) for j, _, k in PUBLISHED_FIELDS])
    return StructType([StructField(j, t[k]) for j, _, k in REQUISITION_FIELDS]
                      + [StructField("requisitionDFF", ArrayType(dff)), StructField("publishedJobs", ArrayType(pub))])


def _iso_utc(c):
    """ISO text with offset -> UTC wall clock (timestamp_ntz); malformed text raises."""
    from tierlake.functions.casts import strict_iso_timestamp
    return F.to_utc_timestamp(strict_iso_timestamp(c), F.current_timezone()).cast("timestamp_ntz")


def _typed(col: str, kind: str):
    return _iso_utc(F.col(col)) if kind == "ts" else F.col(col)


def requisition_sources(pages: DataFrame) -> dict[str, DataFrame]:
    """Fold all landed pages into the three source tables of one sync.

    ``pages``: output of :func:`tierlake.sources.json_pages.read_pages` with
    the requisition item schema.  Items without an id are dropped.
    """
    items = page_items(pages, drop_null=["RequisitionId"]).withColumn("_seq", F.col("_pos"))
    parent = items.select("page_no", "_seq", *[_typed(j, k).alias(s) for j, s, k in REQUISITION_FIELDS])
    reqs = fold_pages(parent, ["requisitionid"], "page_no", "_seq") \
        .withColumn("resource_key", F.col("requisitionid").cast("string"))
    # children of one item keep their own order inside it
    dff_rows = child_rows(items, ["page_no", "_pos", "RequisitionId"], "requisitionDFF", seq="_seq") \
        .select("page_no", "_seq", F.col("RequisitionId").alias("requisition_id"),
                *[F.col(j).alias(s) for j, s in DFF_FIELDS])
    dff = fold_pages(dff_rows, ["requisition_id"], "page_no", "_seq",
                     preserve_null_cols=[s for _, s in DFF_FIELDS])
    pub_rows = child_rows(items, ["page_no", "_pos", "RequisitionId"], "publishedJobs", inner_key="Visibility", seq="_seq") \
        .select("page_no", "_seq", F.col("RequisitionId").alias("requisition_id"),
                *[_typed(j, k).alias(s) for j, s, k in PUBLISHED_FIELDS])
    pub = fold_pages(pub_rows, ["requisition_id", "published_visibility"], "page_no", "_seq")
    return {"job_requisitions_r": reqs.drop("page_no", "_seq"), "req_dff_r": dff.drop("page_no", "_seq"),
            "req_published_jobs_r": pub.drop("page_no", "_seq")}


def sync_requisitions(pages: DataFrame, finals: dict[str, DataFrame] | None = None,
                      sync_ts: _dt.datetime | None = None) -> dict[str, DataFrame]:
    """New versions of the three tables: M7 on the parent, M3 on DFF, M2 on published jobs."""
    ts = F.lit(sync_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    src = requisition_sources(pages)
    src = {k: v.withColumn("row_sync_ts", ts) for k, v in src.items()}
    if not finals:
        return src
    return {
        "job_requisitions_r": upsert(finals["job_requisitions_r"], src["job_requisitions_r"], ["requisitionid"]),
        "req_dff_r": upsert_preserve_null(finals["req_dff_r"], src["req_dff_r"], ["requisition_id"]),
        "req_published_jobs_r": upsert(finals["req_published_jobs_r"], src["req_published_jobs_r"],
                                       ["requisition_id", "published_visibility"]),
    }


def active_sources(registry: DataFrame, order: tuple[str, ...] = ("module_static_id",)) -> DataFrame:
    """Active registry rows in a stable order (S12)."""
    return registry.where(F.col("is_active") == "Y").orderBy(*order)


def sync_source(items: DataFrame, final: DataFrame | None, key: str = "resource_key",
                sync_type: str | None = "INCREMENTAL", date_field: str | None = None,
                last_sync=None, page_col: str = "page_no", seq_col: str = "_seq",
                sync_ts: _dt.datetime | None = None) -> DataFrame:
    """Declarative sync of one REST source from its landed items (S13, M7, I1, I3).

    FULL_ONLY replaces the table with the folded pages; otherwise items newer
    than ``last_sync - 2 days`` on ``date_field`` (default LastUpdateDate)
    are folded (later pages win) and upserted on ``key``.
    """
    from tierlake.operators.incremental import OVERLAP_DAYS, sync_mode
    mode, field = sync_mode(sync_type, date_field)
    src = items
    if mode == "INCREMENTAL" and last_sync is not None:
        if field not in items.columns:
            raise ValueError(f"an incremental sync needs the date field {field}")
        lo = F.lit(last_sync).cast("timestamp_ntz") - F.expr(f"INTERVAL {OVERLAP_DAYS} DAYS")
        src = src.where(F.col(field).cast("timestamp_ntz") > lo)
    folded = fold_pages(src, [key], page_col, seq_col).drop(page_col, seq_col)
    ts = F.lit(sync_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    folded = folded.withColumn("row_sync_ts", ts)
    if mode == "FULL" or final is None:
        return folded
    return upsert(final, folded.select(*final.columns), [key])


def refresh_record(final: DataFrame, response: DataFrame, body_col: str, schema, key: str) -> DataFrame:
    """One-record refresh (S6 + M5): parse a single JSON object and upsert it."""
    from tierlake.sources.json_pages import single_object
    row = single_object(response, body_col, schema).where(F.col(key).isNotNull())
    return upsert(final, row.select(*final.columns), [key])


def zero_merge_warning(merged: int, payload: str | None, limit: int = 3800) -> str | None:
    """Warning text when a sync merged nothing, with the start of the payload for diagnosis."""
    if merged:
        return None
    return "0 rows merged; payload starts: " + (payload or "")[:limit]


# --------------------------------------------------------------------------
# Generic page datasets: flat items (dimensions, candidates) and child arrays.
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class PageDataset:
    """A table loaded from landed pages.

    ``fields``: (JSON field, column, kind) with kind ``bigint`` | ``double`` |
    ``string`` | ``iso`` (offset text -> UTC instant as timestamp_ntz) |
    ``iso_wall`` (offset text -> its local wall clock).  With ``child`` the
    rows come from that nested array (inner: rows need ``require``);
    ``parent`` fields are carried from the item.
    """
    name: str
    fields: tuple
    key: tuple[str, ...]
    require: tuple[str, ...] = ()
    child: str | None = None
    parent: tuple = ()

    def item_schema(self) -> StructType:
        from pyspark.sql.types import DoubleType
        t = {"bigint": LongType(), "double": DoubleType()}
        own = [StructField(j, t.get(k, StringType())) for j, _, k in self.fields]
        if self.child is None:
            return StructType(own)
        par = [StructField(j, t.get(k, StringType())) for j, _, k in self.parent]
        return StructType(par + [StructField(self.child, ArrayType(StructType(own)))])


def _kind(col: str, kind: str):
    from tierlake.functions.casts import strip_offset
    if kind == "iso":
        return _iso_utc(F.col(col))
    if kind == "iso_wall":
        return strip_offset(F.col(col))
    return F.col(col)


def page_dataset(pages: DataFrame, ds: PageDataset, strict: bool = False) -> DataFrame:
    """Folded rows of one dataset over all landed pages (later pages win).

    ``strict`` makes a key that repeats inside one page an error (a MERGE
    source may not match a row twice); otherwise the later row of the page wins.
    """
    items = page_items(pages).withColumn("_seq", F.col("_pos"))
    if ds.child is None:
        rows = items.select("page_no", "_seq", *[_kind(j, k).alias(c) for j, c, k in ds.fields])
    else:
        x = items.select("page_no", "_pos", *[F.col(j).alias(c) for j, c, _ in ds.parent],
                         F.posexplode_outer(ds.child).alias("_cpos", "__c"))
        rows = x.select("page_no", F.struct("_pos", F.coalesce(F.col("_cpos"), F.lit(0))).alias("_seq"),
                        *[c for _, c, _ in ds.parent],
                        *[_kind(f"__c.{j}", k).alias(c) for j, c, k in ds.fields])
    for c in ds.require:
        rows = rows.where(F.col(c).isNotNull())
    if strict:
        from tierlake.operators.upsert import check_unique
        check_unique(rows, [*ds.key, "page_no"])
    return fold_pages(rows, list(ds.key), "page_no", "_seq").drop("page_no", "_seq")


# JSON fields of the dimension, candidate and phone payloads.
DIM_JOB = PageDataset("dim_job_r", (("JobId", "job_id", "bigint"), ("JobName", "job_name", "string"),
                                    ("JobCode", "job_code", "string")), ("job_id",), ("job_id",))
DIM_GRADE = PageDataset("dim_grade_r", (("GradeId", "grade_id", "bigint"), ("Name", "grade_name", "string"),
                                        ("GradeCode", "grade_code", "string")), ("grade_id",), ("grade_id",))
DIM_LOCATION = PageDataset("dim_location_r", (("LocationId", "location_id", "bigint"),
                                              ("LocationName", "location_name", "string"),
                                              ("LocationCode", "location_code", "string")),
                           ("location_id",), ("location_id",))
DIM_DEPARTMENT = PageDataset("dim_department_r", (
    ("OrganizationId", "department_id", "bigint"), ("Name", "department_name", "string"),
    ("ActiveStatus", "active_status", "string"), ("LocationId", "location_id", "bigint"),
    ("LocationCode", "location_code", "string"), ("LocationName", "location_name", "string")),
    ("department_id",), ("department_id",))
CANDIDATES = PageDataset("recruiting_candidates_r", (
    ("CandidateNumber", "candidate_number", "string"), ("PreferredLanguage", "preferred_language", "string"),
    ("LastName", "last_name", "string"), ("MiddleNames", "middle_names", "string"),
    ("FirstName", "first_name", "string"), ("Title", "title", "string"), ("Suffix", "suffix", "string"),
    ("PreNameAdjunct", "pre_name_adjunct", "string"), ("KnownAs", "known_as", "string"),
    ("PreviousLastName", "previous_last_name", "string"), ("Honors", "honors", "string"),
    ("MilitaryRank", "military_rank", "string"), ("FullName", "full_name", "string"),
    ("DisplayName", "display_name", "string"), ("ListName", "list_name", "string"),
    ("Email", "email", "string"), ("CampaignOptIn", "campaign_opt_in", "string"),
    ("SourceMedium", "source_medium", "string"), ("SourceName", "source_name", "string"),
    ("CandidateType", "candidate_type", "string"), ("PersonId", "person_id", "bigint"),
    ("CreatedBy", "created_by", "string"), ("CreationDate", "creation_date", "iso"),
    ("LastUpdatedBy", "last_updated_by", "string"), ("LastUpdateDate", "last_update_date", "iso"),
    ("CandLastModifiedDate", "cand_last_modified_date", "iso"),
    ("PreferredTimezone", "preferred_timezone", "string")),
    ("candidate_number",), ("person_id", "candidate_number"))
CANDIDATE_PHONES = PageDataset("candidate_phones_r", (
    ("PhoneId", "phone_id", "bigint"), ("PhoneType", "phone_type", "string"),
    ("CountryCodeNumber", "country_code_number", "string"), ("AreaCode", "area_code", "string"),
    ("PhoneNumber", "phone_number", "string"), ("Extension", "extension", "string"),
    ("LegislationCode", "legislation_code", "string"), ("PrimaryFlag", "primary_flag", "string"),
    ("CreatedBy", "created_by", "string"), ("CreationDate", "creation_date", "iso_wall"),
    ("LastUpdatedBy", "last_updated_by", "string"), ("LastUpdateDate", "last_update_date", "iso_wall")),
    ("phone_id",), ("phone_id",), child="candidatePhones", parent=(("PersonId", "person_id", "bigint"),))


def sync_dataset(pages: DataFrame, ds: PageDataset, final: DataFrame | None = None) -> DataFrame:
    """Fold the pages of one dataset and upsert them into ``final`` (M1/M7 + M8)."""
    src = page_dataset(pages, ds)
    if final is None:
        return src
    return upsert(final, src.select(*final.columns), list(ds.key))


def content_library_sync(pages: DataFrame, bodies: DataFrame | None, final: DataFrame) -> DataFrame:
    """Content items: metadata merged, text bodies kept unless a new body arrived (M4 + P21).

    ``pages``: items with ItemDescriptionId, Name, DescriptionCode,
    DescriptionTypeCode, VisibilityCode and ``links`` (rel, href).  Items
    without id or canonical link are dropped; the id at the end of that link is
    the ``content_item_id``, under which the texts are requested.  ``bodies``:
    landed ``content_item_id, http_status, body`` of those requests.
    """
    from tierlake.functions.casts import http_body, url_tail_id
    from tierlake.operators.upsert import merge_columns
    from tierlake.sources.json_pages import canonical_link
    items = page_items(pages).withColumn("_seq", F.col("_pos"))
    link = canonical_link("links")
    rows = items.where(F.col("ItemDescriptionId").isNotNull() & link.isNotNull()).select(
        "page_no", "_seq", F.col("ItemDescriptionId").alias("item_description_id"), url_tail_id(link).alias("content_item_id"),
        F.col("Name").alias("name"), F.col("DescriptionCode").alias("description_code"),
        F.col("DescriptionTypeCode").alias("description_type"), F.col("VisibilityCode").alias("visibility_code"))
    meta = fold_pages(rows, ["item_description_id"], "page_no", "_seq").drop("page_no", "_seq")
    upd = ["content_item_id", "name", "description_code", "description_type", "visibility_code"]
    out = merge_columns(final, meta, ["item_description_id"], update_cols=upd)
    if bodies is not None:
        # bodies only fill items that exist; a failed request (NULL body) keeps the old text
        texts = bodies.select("content_item_id", http_body("http_status", "body").alias("txt_description")) \
            .where(F.col("txt_description").isNotNull())
        texts = out.select("item_description_id", "content_item_id").join(texts, "content_item_id").drop("content_item_id")
        out = merge_columns(out, texts, ["item_description_id"], update_cols=["txt_description"])
    return out


# Fields of a job application (its table has the same names in lower case).
APPLICATION_FIELDS = [
    ("JobApplicationId", "bigint"), ("CandidatePersonId", "bigint"), ("CandidateName", "string"), ("RequisitionId", "bigint"),
    ("PhaseId", "bigint"), ("PhaseName", "string"), ("StateId", "bigint"), ("StateName", "string"), ("AppliedToOtherJobs", "string"),
    ("ConfirmedFlag", "string"), ("DisqualifiedFlag", "string"), ("JobApplicationDate", "ts"), ("CreationDate", "ts"),
    ("CreatedBy", "string"), ("LastUpdateDate", "ts"), ("LastUpdatedBy", "string"), ("ProfileId", "bigint"),
    ("ApplyFlowVersionId", "bigint"), ("ConfirmedByPersonId", "bigint"), ("EsignDescriptionVersionId", "bigint"),
    ("InternalFlag", "string"), ("LegalDescriptionVersionId", "bigint"), ("ProcessId", "bigint"), ("LastModifiedDate", "ts"),
    ("ConfirmedDate", "ts"), ("LanguageCode", "string"), ("PublicStateId", "bigint"), ("PublicStateName", "string"),
    ("SiteNumber", "string"), ("HiringManagerId", "bigint"), ("RequisitionIdRest", "bigint"), ("RequisitionUsageCode", "string"),
    ("RecruiterId", "bigint"), ("RequisitionNumber", "string"),
]


def field_schema(fields) -> StructType:
    """Item schema of ``(JSON field, kind)`` pairs; dates and times are read as text."""
    from pyspark.sql.types import DoubleType
    kinds = {"bigint": LongType(), "double": DoubleType()}
    return StructType([StructField(j, kinds.get(k, StringType())) for j, k in fields])


def typed_fields(fields, prefix: str = "") -> list:
    """The lower-case columns of such an item; offset times become UTC."""
    return [(_iso_utc(F.col(prefix + j)) if k == "ts" else F.col(prefix + j).cast("date") if k == "date" else F.col(prefix + j)).alias(j.lower())
            for j, k in fields]


def refresh_application(final: DataFrame, responses: DataFrame, body_col: str = "body") -> DataFrame:
    """The table of job applications after single applications were read again (M5): one response per row.

    Later responses (``response_no``) of one application win; responses without its id are dropped.
    """
    from tierlake.sources.json_pages import single_object
    from tierlake.operators.dedup import latest_per_key
    one = single_object(responses, body_col, field_schema(APPLICATION_FIELDS)).where(F.col("JobApplicationId").isNotNull())
    rows = one.select("response_no", *typed_fields(APPLICATION_FIELDS))
    rows = latest_per_key(rows, ["jobapplicationid"], [F.col("response_no").desc()])
    return upsert(final, rows.select(*final.columns), ["jobapplicationid"])


class SyncErrors(RuntimeError):
    """Summary of the sources that failed in one run."""


def run_isolated(tasks, on_error=None) -> dict:
    """Run each ``(name, callable)``; a failure does not stop the others (I4).

    Returns ``{name: result}`` of the successful ones and raises one
    :class:`SyncErrors` listing every failure at the end.
    """
    done, failed = {}, []
    for name, fn in tasks:
        try:
            done[name] = fn()
        except Exception as e:  # noqa: BLE001 - isolation is the point
            failed.append(f"{name}: {e}")
            if on_error is not None:
                on_error(name, e)
    if failed:
        raise SyncErrors(f"{len(failed)} source(s) failed: " + "; ".join(failed))
    return done
