"""Flexfield staging and its decode views.

The staging table is generic: ``pei_info1..16`` (text), ``pei_date1..2`` and
``pei_num1..6`` (kept as text), discriminated by ``information_type``.  A
decode view renames the generic slots of one information type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_COLUMNS = ["person_extra_info_id", "person_id", "candidate_number", "information_type",
                "effective_start_date", "effective_end_date"]
GENERIC_COLUMNS = ([f"pei_info{i}" for i in range(1, 17)] + ["pei_date1", "pei_date2"]
                   + [f"pei_num{i}" for i in range(1, 7)])

# Information types and slot names of the four decode views.
DECODE_VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "ext_flex_job_refs_v": ("GCS Job Application References", {
        "pei_info1": "reference_1_name", "pei_info2": "reference_1_email",
        "pei_info3": "reference_2_name", "pei_info4": "reference_2_email",
        "pei_info5": "reference_3_name", "pei_info6": "reference_3_email",
    }),
    "ext_flex_person_data_v": ("Additional GCS Person Data", {
        "pei_info1": "teacher_subject_area", "pei_info2": "smartfind_class_code",
        "pei_info3": "banked_vacation", "pei_info4": "contract_type",
        "pei_info5": "contract_stipulation_1", "pei_info6": "contract_stipulation_2",
        "pei_info7": "contract_stipulation_3", "pei_info8": "vacation_carryover_extension",
        "pei_info9": "rehire_eligible", "pei_info10": "processing_owner",
        "pei_info11": "work_keys", "pei_info12": "reference_check", "pei_info13": "sled",
        "pei_info14": "certification", "pei_info15": "additional_fte",
        "pei_info16": "interview_notes", "pei_date1": "gcs_effective_date",
        "pei_num1": "teacher_years_of_experience", "pei_num2": "cate_experience",
        "pei_num3": "personal_leave_used", "pei_num4": "fte", "pei_num5": "educator_id",
        "pei_num6": "teacher_assessment_score",
    }),
    "ext_flex_retirement_v": ("GCS Retirement", {
        "pei_info1": "working_retiree", "pei_date1": "sc_retirement_date",
    }),
    "ext_flex_secondary_status_v": ("Secondary Status", {
        "pei_info1": "secondary_status", "pei_info2": "secondary_status_comments",
        "pei_date1": "secondary_status_begin_date", "pei_date2": "secondary_status_end_date",
    }),
}


def decode_view(flex_stg: DataFrame, view: str, extra: tuple[str, ...] = ("load_ts",)) -> DataFrame:
    """Rows of one information type with the generic slots renamed."""
    info_type, slots = DECODE_VIEWS[view]
    cols = [F.col(c) for c in BASE_COLUMNS]
    cols += [F.col(src).alias(dst) for src, dst in slots.items()]
    cols += [F.col(c) for c in extra if c in flex_stg.columns]
    return flex_stg.where(F.col("information_type") == info_type).select(*cols)


def register_views(spark, flex_stg: DataFrame) -> None:
    """Register all decode views as temp views over one staging DataFrame."""
    for name in DECODE_VIEWS:
        decode_view(flex_stg, name).createOrReplaceTempView(name)
