"""XML report loads: rowset -> typed rows -> merge or full refresh.

Policies per report: first row per key in document order then MERGE (W4 +
M1), strict MERGE that refuses duplicate keys (M9), or full refresh (K5:
the new version replaces the table in one publish).  A report without rows
raises before anything is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.operators.dedup import first_arrival
from tierlake.operators.upsert import check_unique, upsert
from tierlake.plans.specs import Col
from tierlake.session import work_path
from tierlake.sources.store import SnapshotTable
from tierlake.sources.xml_rowset import read_rowset, require_rows


@dataclass(frozen=True)
class ReportSpec:
    name: str
    columns: tuple[Col, ...]           # source = XML element name
    keys: tuple[str, ...] = ()
    policy: str = "first_per_key"      # first_per_key | strict | replace
    require: tuple[str, ...] = ()      # rows whose columns are NULL here are skipped
    where: object = None               # optional callable() -> Column on the raw element text

    def elements(self) -> list[str]:
        out: list[str] = []
        for c in self.columns:
            out.extend(s for s in c.sources if s not in out)
        return out


def typed_rows(spark: SparkSession, paths: str | Sequence[str], spec: ReportSpec) -> DataFrame:
    raw = read_rowset(spark, paths, spec.elements())
    raw = raw.select(*[F.col(e.lower()).alias(e) for e in spec.elements()], "_seq")
    if spec.where is not None:
        raw = raw.where(spec.where())
    return raw.select(*[c.expr() for c in spec.columns], "_seq")


def load_report(spark: SparkSession, paths: str | Sequence[str], spec: ReportSpec,
                target: SnapshotTable) -> int:
    """Load one landed report into ``target``; returns the source row count.

    The XML is parsed once: its typed rows are written and everything else reads those.
    """
    path = work_path(spark, "reports", spec.name.lower(), unique=True)
    typed_rows(spark, paths, spec).write.mode("overwrite").parquet(path)
    rows = require_rows(spark.read.parquet(path), spec.name)
    n = rows.count()
    for c in spec.require:
        rows = rows.where(F.col(c).isNotNull())
    if spec.policy == "replace":
        target.publish(rows.drop("_seq"))
        return n
    if spec.policy == "strict":
        check_unique(rows, list(spec.keys))
        src = rows.drop("_seq")
    else:
        src = first_arrival(rows, list(spec.keys)).drop("_seq")
    current = target.read()
    if target.keys:
        target.publish_delta(src.select(*current.columns))
    else:
        target.publish(upsert(current, src.select(*current.columns), list(spec.keys)))
    return n


# The gallup assessment report (element -> column).
GALLUP = ReportSpec(
    name="GALLUP", keys=("submission_id",), require=("submission_id",),
    columns=(Col("submission_id", "SUBMISSION_ID", "must:bigint"),
             Col("package_status_code", "PACKAGE_STATUS_CODE"), Col("band", "BAND"),
             Col("score", "SCORE", "must:decimal(10,2)"), Col("requisition_id", "REQUISITION_ID", "must:bigint"),
             Col("requisition_title", "REQUISITION_TITLE"), Col("person_id", "PERSON_ID", "must:bigint"),
             Col("candidate_name", "CANDIDATE_NAME"), Col("gallup_result_url", "GALLUP_RESULT_URL")))

# The flexfield staging report (element -> column, all text but the ids).
EXT_FLEX_STG = ReportSpec(
    name="EXT_FLEX", keys=("person_extra_info_id",), require=("person_extra_info_id",),
    columns=(Col("candidate_number", "CANDIDATE_NUMBER"), Col("person_id", "PERSON_ID", "must:bigint"),
             Col("person_extra_info_id", "PERSON_EXTRA_INFO_ID", "must:bigint"),
             Col("information_type", "INFORMATION_TYPE"), Col("pei_information_category", "PEI_INFORMATION_CATEGORY"),
             Col("effective_start_date", "EFFECTIVE_START_DATE"), Col("effective_end_date", "EFFECTIVE_END_DATE"),
             *[Col(f"pei_info{i}", f"PEI_INFO{i}") for i in range(1, 17)],
             *[Col(f"pei_date{i}", f"PEI_DATE{i}") for i in range(1, 3)],
             *[Col(f"pei_num{i}", f"PEI_NUM{i}") for i in range(1, 7)]))

# The descriptive-flexfield configuration report; strict (no dedup).
BIP_DFF = ReportSpec(
    name="DFF", keys=("dff_code", "context_code", "segment_identifier"), policy="strict",
    require=("dff_code", "context_code", "segment_identifier"),
    columns=(Col("dff_code", "DFF_CODE"), Col("dff_name", "DFF_NAME"), Col("context_code", "CONTEXT_CODE"),
             Col("segment_code", "SEGMENT_CODE"), Col("segment_identifier", "SEGMENT_IDENTIFIER"),
             Col("required_flag", "REQUIRED_FLAG"), Col("data_type", "DATA_TYPE"), Col("table_name", "TABLE_NAME"),
             Col("column_name", "COLUMN_NAME"), Col("value_set_code", "VALUE_SET_CODE"),
             Col("last_update_date", "LAST_UPDATE_DATE", "iso"), Col("deployment_status", "DEPLOYMENT_STATUS"),
             Col("module_name", "MODULE_NAME")))


def _digits(c: str):
    return F.trim(F.col(c)).rlike(r"^\d+$")


# The questionnaire report; ids are accepted only as digit strings.
_Q_DATES = ("questionnaire_def_creation_date", "questionnaire_def_last_update_date", "questionnaire_issued_date",
            "response_creation_date", "response_last_update_date", "response_submitted_date")
BIP_QUESTIONNAIRES = ReportSpec(
    name="QUESTIONNAIRES", policy="strict",
    keys=("questionnaire_code", "question_code", "qstnr_participant_id", "requisition_id"),
    require=("questionnaire_code", "question_code"),
    where=lambda: _digits("QSTNR_PARTICIPANT_ID") & _digits("REQUISITION_ID"),
    columns=(Col("questionnaire_code", "QUESTIONNAIRE_CODE"), Col("question_code", "QUESTION_CODE"),
             Col("qstnr_participant_id", "QSTNR_PARTICIPANT_ID", "must:bigint"),
             Col("requisition_id", "REQUISITION_ID", "must:bigint"),
             Col("qstn_response_id", "QSTN_RESPONSE_ID", "digits:bigint"), Col("qstnr_version_num", "QSTNR_VERSION_NUM"),
             Col("questionnaire_name", "QUESTIONNAIRE_NAME"), Col("section_seq_num", "SECTION_SEQ_NUM"),
             Col("question_seq_num", "QUESTION_SEQ_NUM"), Col("question_text", "QUESTION_TEXT"),
             Col("question_type", "QUESTION_TYPE"), Col("participant_type", "PARTICIPANT_TYPE"),
             Col("participant_id", "PARTICIPANT_ID"), Col("subject_code", "SUBJECT_CODE"),
             Col("subject_id", "SUBJECT_ID", "digits:bigint"), Col("qstnr_response_id", "QSTNR_RESPONSE_ID", "digits:bigint"),
             Col("attempt_num", "ATTEMPT_NUM"), Col("submission_id", "SUBMISSION_ID", "digits:bigint"),
             Col("answer_text", "ANSWER_TEXT"), Col("candidate_person_id", "CANDIDATE_PERSON_ID", "digits:bigint"),
             Col("candidate_number", "CANDIDATE_NUMBER"), Col("candidate_name", "CANDIDATE_NAME"),
             Col("recruiting_type", "RECRUITING_TYPE"), Col("requisition_title", "REQUISITION_TITLE"),
             Col("answer_mode", "ANSWER_MODE"),
             *[Col(c, c.upper(), "iso") for c in _Q_DATES]))

# User accounts (first row per user GUID) and user roles (full refresh).
FA_USER_ACCOUNTS = ReportSpec(
    name="USER_ACCOUNTS", keys=("user_guid",), require=("user_guid",),
    columns=(Col("username", "USERNAME"), Col("user_id", "USER_ID", "must:bigint"), Col("user_guid", "USER_GUID"),
             Col("person_id", "PERSON_ID", "must:bigint"), Col("active_flag", "ACTIVE_FLAG"),
             Col("hr_terminated", "HR_TERMINATED"), Col("suspended", "SUSPENDED"),
             Col("credentials_email_sent", "CREDENTIALS_EMAIL_SENT"), Col("user_first_name", "USER_FIRST_NAME"),
             Col("user_last_name", "USER_LAST_NAME"), Col("user_email", "USER_EMAIL"),
             Col("user_category", "USER_CATEGORY"), Col("ase_user_id", "ASE_USER_ID", "must:bigint"),
             Col("person_number", "PERSON_NUMBER")))

FA_USER_ROLES = ReportSpec(
    name="USER_ROLES", policy="replace",
    columns=(Col("user_id", "USER_ID", "must:bigint"), Col("user_guid", "USER_GUID"),
             Col("ase_role_id", "ASE_ROLE_ID", "must:bigint"), Col("role_common_name", "ROLE_COMMON_NAME"),
             Col("type_code", "TYPE_CODE"), Col("role_name", "ROLE_NAME"),
             Col("effective_end_date", "EFFECTIVE_END_DATE", "iso:yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS] XXX")))
