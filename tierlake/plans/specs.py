"""Declarative entity specs: one object per extract entity.

A spec says how a landing row (all strings) becomes a typed staging row, and
how a staged batch is deduplicated, compared and merged into the final
table.  The same generic flow (:mod:`tierlake.plans.entity_flow`) runs every
entity; only data lives here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierlake.functions.casts import (
    digits_only,
    NUMBER, blank_to_null, lpad_trunc, safe_number, safe_timestamp, segment_string,
)


@dataclass(frozen=True)
class Col:
    """One staging column.

    ``source``: a landing header name, or a tuple of names (first non-NULL).
    ``cast``: ``must:<type>`` (a text that is no such number raises) | ``digits`` (digits only, else NULL) | ``str`` | ``blank`` (trim, '' -> NULL) | ``num`` | ``num:<type>`` |
    ``ts`` (tolerant timestamp) | ``date`` (timestamp truncated to seconds) |
    ``iso`` / ``iso:<format>`` (strict ISO with offset, as UTC wall clock).
    """
    target: str
    source: str | tuple[str, ...]
    cast: str = "str"

    def expr(self) -> Column:
        srcs = (self.source,) if isinstance(self.source, str) else self.source
        v = F.coalesce(*[F.col(s) for s in srcs]) if len(srcs) > 1 else F.col(srcs[0])
        kind, _, arg = self.cast.partition(":")
        if kind == "str":
            out = v
        elif kind == "blank":
            out = blank_to_null(v)
        elif kind == "num":
            out = safe_number(v, arg or NUMBER)
        elif kind == "must":
            t = F.trim(v)
            ok = t.isNull() | t.try_cast(arg).isNotNull()
            out = F.when(ok, t.try_cast(arg)).otherwise(F.raise_error(F.concat(F.lit(f"{self.target}: not a number: "), t)).cast(arg))
        elif kind == "digits":
            out = digits_only(v, arg or "decimal(38,0)")
        elif kind == "ts":
            out = safe_timestamp(v)
        elif kind == "date":
            out = F.date_trunc("second", safe_timestamp(v)).cast("timestamp_ntz")
        elif kind == "iso":
            # strict ISO text with offset (malformed text raises) -> UTC wall clock
            from tierlake.functions.casts import ISO_OFFSET_FORMAT, strict_iso_timestamp
            fmt = arg or ISO_OFFSET_FORMAT
            out = F.to_utc_timestamp(strict_iso_timestamp(v, fmt), F.current_timezone()).cast("timestamp_ntz")
        else:
            raise ValueError(f"unknown cast {self.cast}")
        return out.alias(self.target)

    @property
    def sources(self) -> tuple[str, ...]:
        return (self.source,) if isinstance(self.source, str) else self.source


def raw_ts(target: str, source: str) -> tuple[Col, Col]:
    """The raw text and its tolerant timestamp side by side (``x_raw``, ``x_ts``)."""
    return Col(f"{target}_raw", source), Col(f"{target}_ts", source, "ts")


@dataclass(frozen=True)
class Derived:
    """A staging column computed by an expression (e.g. padded segments).

    ``build()`` may use landing columns (list them in ``sources``) and staging
    columns defined earlier in the spec.
    """
    target: str
    build: object            # callable() -> Column
    sources: tuple[str, ...] = ()

    def expr(self) -> Column:
        return self.build().alias(self.target)


@dataclass(frozen=True)
class EntitySpec:
    name: str
    keys: tuple[str, ...]
    order: tuple[tuple[str, str], ...] = ()          # (column, "desc" | "asc"); _seq is appended
    not_null: tuple[str, ...] = ()                   # key NULL filter before dedup
    flags: tuple[str, ...] = ()                      # nvl(flag, 'N') = 'Y' filters
    columns: tuple = ()                              # Col / Derived, in staging order
    compare: tuple[str, ...] | None = None           # preview compare list (None: all columns)
    update: tuple[str, ...] | None = None            # merged columns (None: all non-key)
    rows_loaded_not_null: tuple[str, ...] | None = None
    surrogate_id: str | None = None                  # final has its own identity column
    null_keys: str = "quarantine"                    # rows with a NULL key part: quarantine | insert
    daily: bool = True                               # part of the daily file load
    doc: str = ""

    def staging_columns(self) -> list[str]:
        return [c.target for c in self.columns]

    def landing_columns(self) -> list[str]:
        out: list[str] = []
        for c in self.columns:
            out.extend(s for s in c.sources if s not in out)
        return out

    def dedup_order(self) -> list[Column]:
        out = [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last()
               for c, d in self.order]
        return out + [F.col("_seq").asc()]

    def filter_expr(self) -> Column:
        cond = F.lit(True)
        for f in self.flags:
            cond = cond & (F.coalesce(F.col(f), F.lit("N")) == "Y")
        for k in self.not_null:
            cond = cond & F.col(k).isNotNull()
        return cond

    def compare_columns(self) -> list[str]:
        cols = list(self.compare) if self.compare is not None else self.staging_columns()
        return list(dict.fromkeys([*self.keys, *cols]))


# --------------------------------------------------------------------------
# Column mappings of the extracts (landing header -> staging).
# --------------------------------------------------------------------------

PO_LINES = EntitySpec(
    name="PO_LINES", keys=("polineid",), order=(), not_null=(),
    columns=(
        Col("poheaderid", "POHEADERID", "num:decimal(18,0)"),
        Col("polineid", "POLINEID", "num:decimal(18,0)"),
        Col("linenum", "LINENUM", "num:decimal(10,0)"),
        Col("createdby", "CREATEDBY"),
        Col("creationdate", "CREATIONDATE", "ts"),
        Col("fundsstatus", "FUNDSSTATUS"),
        Col("itemdescription", "ITEMDESCRIPTION"),
        Col("lastupdatedby", "LASTUPDATEDBY"),
        Col("linestatus", "LINESTATUS"),
        Col("listprice", "LISTPRICE", "num:decimal(18,5)"),
        Col("matchingbasis", "MATCHINGBASIS"),
        Col("purchasebasis", "PURCHASEBASIS"),
        Col("shippinguomcode", "SHIPPINGUOMCODE"),
        Col("unitprice", "UNITPRICE", "num:decimal(18,5)"),
        Col("uomcode", "UOMCODE"),
    ),
    compare=("polineid", "poheaderid", "linenum", "itemdescription", "linestatus", "unitprice",
             "listprice", "uomcode"),
    surrogate_id="id", null_keys="insert",
    doc="Minimum slice: no key NULL filter, arrival order only, surrogate identity in final.",
)

HCM_EMPLOYEE = EntitySpec(
    name="HCM_EMPLOYEE", keys=("person_id",),
    order=(("asg_effective_start_ts", "desc"),),
    not_null=("person_id",), flags=("primary_assignment_flag", "effective_latest_change_flag"),
    columns=(
        Col("person_id", "PERSONID", "num:bigint"),
        Col("person_number", ("PERSONDETAILSPEOPERSONNUMBER", "PERSONDETAILSPEO1PERSONNUMBER")),
        Col("display_name", ("PERSONNAMEPEODISPLAYNAME", "PERSONNAMEPEOFULLNAME")),
        Col("first_name", "PERSONNAMEPEOFIRSTNAME"),
        Col("last_name", "PERSONNAMEPEOLASTNAME"),
        Col("known_as", "PERSONNAMEPEOKNOWNAS"),
        Col("legislation_code", "PERSONNAMEPEOLEGISLATIONCODE"),
        Col("user_name", "USERPEOUSERNAME"),
        Col("user_suspended_flag", "USERPEOSUSPENDED"),
        Col("work_email", ("WORKEMAILADDRESSESPEOEMAILADDRESS", "EMAILADDRESSESPEOEMAILADDRESS")),
        Col("person_type", "PERSONTYPESTRANSLATIONPEOUSERPERSONTYPE"),
        *raw_ts("hire_date", "PERIODOFSERVICEPEODATESTART"),
        *raw_ts("termination_date", "PERIODOFSERVICEPEOACTUALTERMINATIONDATE"),
        Col("assignment_id", "ASSIGNMENTPEOASSIGNMENTID", "num:bigint"),
        Col("assignment_number", "ASSIGNMENTPEOASSIGNMENTNUMBER"),
        Col("assignment_name", "ASSIGNMENTPEOASSIGNMENTNAME"),
        Col("assignment_status_type", "ASSIGNMENTPEOASSIGNMENTSTATUSTYPE"),
        Col("assignment_type", "ASSIGNMENTPEOASSIGNMENTTYPE"),
        Col("employment_category", "ASSIGNMENTPEOEMPLOYMENTCATEGORY"),
        Col("full_part_time", "ASSIGNMENTPEOFULLPARTTIME"),
        Col("hourly_salaried_code", "ASSIGNMENTPEOHOURLYSALARIEDCODE"),
        Col("normal_hours", "ASSIGNMENTPEONORMALHOURS", "num:decimal(10,2)"),
        *raw_ts("asg_effective_start", "ASSIGNMENTPEOEFFECTIVESTARTDATE"),
        *raw_ts("asg_effective_end", "ASSIGNMENTPEOEFFECTIVEENDDATE"),
        Col("effective_latest_change_flag", "ASSIGNMENTPEOEFFECTIVELATESTCHANGE"),
        Col("primary_assignment_flag", "ASSIGNMENTPEOPRIMARYASSIGNMENTFLAG"),
        Col("primary_work_rel_flag", "ASSIGNMENTPEOPRIMARYWORKRELATIONFLAG"),
        Col("position_code", "POSITIONMGRPEOPOSITIONCODE"),
        Col("position_name", "POSITIONTRANSLATIONMGRPEONAME"),
        Col("org_id", "ORGANIZATIONUNITPEOORGANIZATIONID", "num:bigint"),
        Col("org_name", "ORGUNITTRANSLATIONMGRPEONAME"),
        Col("location_name", "LOCATIONDETAILSMGRPEOLOCATIONNAME"),
        Col("addr_city", "ADDRESSESPEOTOWNORCITY"),
        Col("addr_state", "ADDRESSESPEOREGION2"),
        Col("addr_postal_code", "ADDRESSESPEOPOSTALCODE"),
        Col("addr_country", "ADDRESSESPEOCOUNTRY"),
        Col("manager_person_id", "ASSIGNMENTSUPERVISORPEOMANAGERID", "num:bigint"),
        Col("manager_display_name", "SUPERVISORNAMEPEODISPLAYNAME"),
        Col("manager_email", "SUPERVISOREMAILADDRESSPEOEMAILADDRESS"),
        Col("manager_user_name", "SUPERVISORUSERPEOUSERNAME"),
        Col("manager_type", "ASSIGNMENTSUPERVISORPEOMANAGERTYPE"),
    ),
    # fixed values: the columns that the preview compares
    compare=("person_id", "person_number", "display_name", "work_email", "user_name", "user_suspended_flag",
             "person_type", "hire_date_ts", "termination_date_ts", "assignment_id", "assignment_number",
             "assignment_name", "assignment_status_type", "employment_category", "full_part_time",
             "hourly_salaried_code", "normal_hours", "position_code", "position_name", "org_name",
             "location_name", "manager_display_name", "manager_email", "manager_type"),
    rows_loaded_not_null=("person_id",),
    doc="Flags filtered before dedup: one row per person by design.",
)

AP_INVOICE_HDR = EntitySpec(
    name="AP_INVOICE_HDR", keys=("invoiceid",), order=(), not_null=(),
    columns=(
        Col("invoiceid", "INVOICEID", "num:bigint"),
        Col("invoiceheaderinvoicenum", "INVOICEHEADERINVOICENUM"),
        Col("invoiceheadervouchernum", "INVOICEHEADERVOUCHERNUM", "blank"),
        Col("partypartyname", "PARTYPARTYNAME"),
        Col("partysitepartysitename", "PARTYSITEPARTYSITENAME"),
        Col("invoiceheaderinvoicedate", "INVOICEHEADERINVOICEDATE", "date"),
        Col("invoiceheadergldate", "INVOICEHEADERGLDATE", "date"),
        Col("invoiceheadercreationdate", "INVOICEHEADERCREATIONDATE", "ts"),
        Col("invoiceheaderinvoiceamount", "INVOICEHEADERINVOICEAMOUNT", "num:decimal(18,2)"),
        Col("invoiceheaderinvoicecurrencycode", "INVOICEHEADERINVOICECURRENCYCODE"),
        Col("invoiceheaderpaymentcurrencycode", "INVOICEHEADERPAYMENTCURRENCYCODE"),
        Col("invoiceheaderamountpaid", "INVOICEHEADERAMOUNTPAID", "num:decimal(18,2)"),
        Col("invoicehdrvalidationstatuscode", "INVOICEHDRVALIDATIONSTATUSCODE"),
        Col("invoiceheaderapprovalstatus", "INVOICEHEADERAPPROVALSTATUS"),
        Col("invoiceheaderpaymentstatusflag", "INVOICEHEADERPAYMENTSTATUSFLAG"),
        Col("invoicehdraccountingstatuscode", "INVOICEHDRACCOUNTINGSTATUSCODE"),
        Col("invoiceheaderinvoicetypelookupcode", "INVOICEHEADERINVOICETYPELOOKUPCODE"),
        Col("invoiceheaderpaygrouplookupcode", "INVOICEHEADERPAYGROUPLOOKUPCODE", "blank"),
        Col("invoiceheadertermsdate", "INVOICEHEADERTERMSDATE", "date"),
        Col("invoiceheaderdescription", "INVOICEHEADERDESCRIPTION", "blank"),
        Col("purchaseordersegment1", "PURCHASEORDERSEGMENT1", "blank"),
        Col("invoiceheadercreatedby", "INVOICEHEADERCREATEDBY"),
        Col("invoiceheaderlastupdatedate", "INVOICEHEADERLASTUPDATEDATE", "ts"),
    ),
    compare=("invoiceid", "invoiceheaderinvoicenum", "invoiceheadervouchernum", "partypartyname",
             "partysitepartysitename", "invoiceheaderinvoicedate", "invoiceheadergldate",
             "invoiceheaderinvoiceamount", "invoiceheaderinvoicecurrencycode", "invoiceheaderpaymentcurrencycode",
             "invoiceheaderamountpaid", "invoicehdrvalidationstatuscode", "invoiceheaderapprovalstatus",
             "invoiceheaderpaymentstatusflag", "invoicehdraccountingstatuscode",
             "invoiceheaderinvoicetypelookupcode", "invoiceheaderpaygrouplookupcode", "invoiceheadertermsdate",
             "invoiceheaderdescription", "purchaseordersegment1", "invoiceheadercreatedby"),
    doc="No key NULL filter; blank text -> NULL; dates keep their time part.",
)

_GL_AMOUNTS = (
    Col("begin_balance_cr", "BALANCEBEGINBALANCECR", "num"),
    Col("begin_balance_dr", "BALANCEBEGINBALANCEDR", "num"),
    Col("begin_balance_cr_beq", "BALANCEBEGINBALANCECRBEQ", "num"),
    Col("begin_balance_dr_beq", "BALANCEBEGINBALANCEDRBEQ", "num"),
    Col("period_net_cr", "BALANCEPERIODNETCR", "num"),
    Col("period_net_dr", "BALANCEPERIODNETDR", "num"),
    Col("period_net_cr_beq", "BALANCEPERIODNETCRBEQ", "num"),
    Col("period_net_dr_beq", "BALANCEPERIODNETDRBEQ", "num"),
    Col("quarter_to_date_cr", "BALANCEQUARTERTODATECR", "num"),
    Col("quarter_to_date_dr", "BALANCEQUARTERTODATEDR", "num"),
    Col("quarter_to_date_cr_beq", "BALANCEQUARTERTODATECRBEQ", "num"),
    Col("quarter_to_date_dr_beq", "BALANCEQUARTERTODATEDRBEQ", "num"),
    Col("project_to_date_cr", "BALANCEPROJECTTODATECR", "num"),
    Col("project_to_date_dr", "BALANCEPROJECTTODATEDR", "num"),
    Col("project_to_date_cr_beq", "BALANCEPROJECTTODATECRBEQ", "num"),
    Col("project_to_date_dr_beq", "BALANCEPROJECTTODATEDRBEQ", "num"),
)

GL_BALANCE = EntitySpec(
    name="GL_BALANCE",
    keys=("ledger_id", "code_combination_id", "currency_code", "actual_flag", "period_name"),
    order=(("last_update_date_ts", "desc"),), not_null=("code_combination_id",),
    columns=(
        Col("ledger_id", "BALANCELEDGERID", "num:bigint"),
        Col("code_combination_id", "BALANCECODECOMBINATIONID", "num:bigint"),
        Col("currency_code", "BALANCECURRENCYCODE"),
        Col("actual_flag", "BALANCEACTUALFLAG"),
        Col("encumbrance_type_id", "BALANCEENCUMBRANCETYPEID", "num:bigint"),
        Col("period_name", "BALANCEPERIODNAME"),
        Col("period_num", "BALANCEPERIODNUM", "num:bigint"),
        Col("period_year", "BALANCEPERIODYEAR", "num:bigint"),
        *_GL_AMOUNTS,
        *raw_ts("last_update_date", "BALANCELASTUPDATEDATE"),
    ),
    compare=("ledger_id", "code_combination_id", "currency_code", "actual_flag", "encumbrance_type_id",
             "period_name", "period_num", "period_year", *[c.target for c in _GL_AMOUNTS], "last_update_date_ts"),
    rows_loaded_not_null=("code_combination_id",),
    doc="Key narrower than the documented source key (encumbrance type is outside it): see key_audit.",
)

HCM_ASSIGNMENT = EntitySpec(
    name="HCM_ASSIGNMENT", keys=("assignment_id",),
    order=(("effective_start_ts", "desc"), ("effective_sequence", "desc")),
    not_null=("assignment_id",), flags=("effective_latest_change",),
    columns=(
        Col("assignment_id", "ASSIGNMENTID", "num:bigint"),
        Col("person_id", "ASSIGNMENTPEOPERSONID", "num:bigint"),
        Col("position_id", "ASSIGNMENTPEOPOSITIONID", "num:bigint"),
        Col("assignment_name", "ASSIGNMENTPEOASSIGNMENTNAME"),
        Col("assignment_number", "ASSIGNMENTPEOASSIGNMENTNUMBER"),
        Col("assignment_status_type", "ASSIGNMENTPEOASSIGNMENTSTATUSTYPE"),
        Col("assignment_type", "ASSIGNMENTPEOASSIGNMENTTYPE"),
        Col("system_person_type", "ASSIGNMENTPEOSYSTEMPERSONTYPE"),
        Col("normal_hours", "ASSIGNMENTPEONORMALHOURS", "num"),
        Col("primary_assignment_flag", "ASSIGNMENTPEOPRIMARYASSIGNMENTFLAG"),
        Col("primary_flag", "ASSIGNMENTPEOPRIMARYFLAG"),
        Col("manager_flag", "ASSIGNMENTPEOMANAGERFLAG"),
        Col("business_unit_id", "ASSIGNMENTPEOBUSINESSUNITID", "num:bigint"),
        Col("organization_id", "ASSIGNMENTPEOORGANIZATIONID", "num:bigint"),
        Col("location_id", "ASSIGNMENTPEOLOCATIONID", "num:bigint"),
        Col("hourly_salaried_code", "ASSIGNMENTPEOHOURLYSALARIEDCODE"),
        Col("employee_category", "ASSIGNMENTPEOEMPLOYEECATEGORY"),
        *raw_ts("effective_start", "EFFECTIVESTARTDATE"),
        *raw_ts("effective_end", "EFFECTIVEENDDATE"),
        Col("effective_sequence", "EFFECTIVESEQUENCE", "num:bigint"),
        Col("effective_latest_change", "EFFECTIVELATESTCHANGE"),
    ),
    compare=("assignment_id", "person_id", "position_id", "assignment_number", "assignment_status_type",
             "assignment_type", "normal_hours", "primary_assignment_flag", "organization_id", "location_id",
             "employee_category"),
    doc="Two order columns; latest-change flag filtered before dedup.",
)

# GL code combination segments (name, landing column, width).
GL_SEGMENTS = (("fund", "CODECOMBINATIONSEGMENT1", 4), ("location", "CODECOMBINATIONSEGMENT2", 3),
               ("function1", "CODECOMBINATIONSEGMENT3", 4), ("grant_code", "CODECOMBINATIONSEGMENT4", 3),
               ("initiative", "CODECOMBINATIONSEGMENT5", 3), ("account", "CODECOMBINATIONSEGMENT6", 7),
               ("activity", "CODECOMBINATIONSEGMENT7", 4), ("interfund", "CODECOMBINATIONSEGMENT8", 4),
               ("future1", "CODECOMBINATIONSEGMENT9", 5))

GL_CODE_COMB = EntitySpec(
    name="GL_CODE_COMB", keys=("code_combination_id",), order=(("last_update_date_ts", "desc"),),
    not_null=("code_combination_id",),
    columns=(
        Col("code_combination_id", "CODECOMBINATIONCODECOMBINATIONID", "num:bigint"),
        Col("chart_of_accounts_id", "CODECOMBINATIONCHARTOFACCOUNTSID", "num:bigint"),
        Col("account_type", "CODECOMBINATIONACCOUNTTYPE"),
        Col("enabled_flag", "CODECOMBINATIONENABLEDFLAG"),
        Col("detail_budgeting_allowed", "CODECOMBINATIONDETAILBUDGETINGALLOWEDFLAG"),
        Col("detail_posting_allowed", "CODECOMBINATIONDETAILPOSTINGALLOWEDFLAG"),
        Col("summary_flag", "CODECOMBINATIONSUMMARYFLAG"),
        *[Derived(n, (lambda src=src, w=w: lpad_trunc(F.col(src), w)), (src,)) for n, src, w in GL_SEGMENTS],
        *raw_ts("start_date_active", "CODECOMBINATIONSTARTDATEACTIVE"),
        *raw_ts("end_date_active", "CODECOMBINATIONENDDATEACTIVE"),
        *raw_ts("last_update_date", "CODECOMBINATIONLASTUPDATEDATE"),
    ),
    compare=("code_combination_id", "chart_of_accounts_id", "account_type", "enabled_flag",
             "detail_budgeting_allowed", "detail_posting_allowed", "summary_flag",
             *[n for n, _, _ in GL_SEGMENTS], "start_date_active_ts", "end_date_active_ts", "last_update_date_ts"),
    doc="Segments are zero-padded (and cut) to their widths; the budget balance joins on them.",
)

PO_HDR = EntitySpec(
    name="PO_HDR", keys=("poheaderid",), order=(), not_null=(),
    columns=(
        Col("poheaderid", "POHEADERID", "num:bigint"),
        Col("po_number", "SEGMENT1"),
        Col("revisionnum", "REVISIONNUM", "num:bigint"),
        Col("po_type", "TYPELOOKUPCODE"),
        Col("documentstatus", "DOCUMENTSTATUS"),
        Col("approvedflag", "APPROVEDFLAG"),
        Col("prcbuid", "PRCBUID", "num:bigint"),
        Col("vendorid", "VENDORID", "num:bigint"),
        Col("vendorsiteid", "VENDORSITEID", "num:bigint"),
        Col("vendor_order_num", "VENDORORDERNUM"),
        Col("currencycode", "CURRENCYCODE"),
        Col("amountlimit", "AMOUNTLIMIT", "num"),
        Col("amountreleased", "MINRELEASEAMOUNT", "num"),
        Col("blankettotalamount", "BLANKETTOTALAMOUNT", "num"),
        Col("startdate_raw", "STARTDATE"), Col("creationdate_raw", "CREATIONDATE"),
        Col("lastupdatedate_raw", "LASTUPDATEDATE"), Col("closeddate_raw", "CLOSEDDATE"),
        Col("startdate_ts", "STARTDATE", "ts"), Col("creationdate_ts", "CREATIONDATE", "ts"),
        Col("lastupdatedate_ts", "LASTUPDATEDATE", "ts"), Col("closeddate_ts", "CLOSEDDATE", "ts"),
        Col("lastupdatedby", "LASTUPDATEDBY"),
        Col("objectversionnumber", "OBJECTVERSIONNUMBER", "num:bigint"),
    ),
    compare=("poheaderid", "po_number", "revisionnum", "po_type", "documentstatus", "approvedflag", "prcbuid",
             "vendorid", "vendorsiteid", "vendor_order_num", "currencycode", "amountlimit", "amountreleased",
             "blankettotalamount"),
    doc="No key NULL filter; first arrival per key.",
)

SUPPLIER_HDR = EntitySpec(
    name="SUPPLIER_HDR", keys=("vendorid",), order=(), not_null=(),
    columns=(
        Col("vendorid", "VENDORID", "num:bigint"),
        Col("partyid", "PARTYID", "num:bigint"),
        Col("segment1", "SEGMENT1"),
        Col("alternatenamepartyname", "ALTERNATENAMEPARTYNAME"),
        Col("alternatenamepartynameid", "ALTERNATENAMEPARTYNAMEID", "num:bigint"),
        Col("aliaspartyname", "ALIASPARTYNAME"),
        Col("aliaspartynameid", "ALIASPARTYNAMEID", "num:bigint"),
        Col("businessrelationship", "BUSINESSRELATIONSHIP"),
        Col("bcnotapplicableflag", "BCNOTAPPLICABLEFLAG"),
        Col("federalreportableflag", "FEDERALREPORTABLEFLAG"),
        Col("incometaxid", "INCOMETAXID"),
        Col("incometaxidflag", "INCOMETAXIDFLAG"),
        Col("organizationtypelookupcode", "ORGANIZATIONTYPELOOKUPCODE"),
        Col("type1099", "TYPE1099"),
        Col("vendortypelookupcode", "VENDORTYPELOOKUPCODE"),
        Col("createdby", "CREATEDBY"),
        *raw_ts("creationdate", "CREATIONDATE"),
        Col("creationsource", "CREATIONSOURCE"),
        Col("lastupdatedby", "LASTUPDATEDBY"),
        *raw_ts("lastupdatedate", "LASTUPDATEDATE"),
        Col("lastupdatelogin", "LASTUPDATELOGIN"),
        Col("objectversionnumber", "OBJECTVERSIONNUMBER", "num:bigint"),
    ),
    compare=("vendorid", "partyid", "segment1", "alternatenamepartyname", "businessrelationship", "incometaxid",
             "organizationtypelookupcode", "type1099", "vendortypelookupcode"),
    doc="No key NULL filter; first arrival per key.",
)

QSTNR_ANSWER = EntitySpec(
    name="QSTNR_ANSWER", keys=("qstn_answer_id",), order=(("last_update_date_ts", "desc"),),
    not_null=("qstn_answer_id",),
    columns=(
        Col("qstn_answer_id", "QUESTIONANSWERBPEOQSTNANSWERID", "num:bigint"),
        Col("seq_num", "QUESTIONANSWERBPEOSEQNUM", "num:bigint"),
        Col("score", "QUESTIONANSWERBPEOSCORE", "num"),
        Col("answer_long_text", "QUESTIONANSWERTRANSLATIONPEOLONGTEXT"),
        Col("answer_short_text", "QUESTIONANSWERTRANSLATIONPEOSHORTTEXT"),
        Col("response_feedback", "QUESTIONANSWERTRANSLATIONPEORESPONSEFEEDBACK"),
        *raw_ts("last_update_date", "QUESTIONANSWERBPEOLASTUPDATEDATE"),
    ),
    compare=("qstn_answer_id", "seq_num", "score", "answer_long_text", "answer_short_text", "response_feedback",
             "last_update_date_ts"),
)

HCM_POSITION = EntitySpec(
    name="HCM_POSITION", keys=("position_id",), order=(("effective_start_ts", "desc"),),
    not_null=("position_id",),
    columns=(
        Col("position_id", "POSITIONID", "num:bigint"),
        Col("position_code", "POSITIONPEOPOSITIONCODE"),
        Col("position_name", "POSITIONTRANSLATIONPEONAME"),
        Col("active_status", "POSITIONPEOACTIVESTATUS"),
        Col("position_type", "POSITIONPEOPOSITIONTYPE"),
        Col("fte", "POSITIONPEOFTE", "num"),
        Col("full_part_time", "POSITIONPEOFULLPARTTIME"),
        Col("standard_working_hours", "POSITIONPEOSTANDARDWORKINGHOURS", "num"),
        Col("organization_id", "POSITIONPEOORGANIZATIONID", "num:bigint"),
        Col("location_id", "POSITIONPEOLOCATIONID", "num:bigint"),
        Col("position_job_id", "POSITIONPEOJOBID", "num:bigint"),
        Col("business_unit_id", "POSITIONPEOBUSINESSUNITID", "num:bigint"),
        Col("max_persons", "POSITIONPEOMAXPERSONS", "num:bigint"),
        Col("budgeted_flag", "POSITIONPEOBUDGETEDPOSITIONFLAG"),
        Col("hiring_status", "POSITIONPEOHIRINGSTATUS"),
        Col("assignment_category", "POSITIONPEOASSIGNMENTCATEGORY"),
        Col("parent_position_code", "PARENTPOSITIONPEOPOSITIONCODE"),
        Col("parent_position_name", "PARENTPOSITIONTRANSLATIONPEONAME"),
        Col("parent_org_name", "PARENTPOSITIONORGUNITTLPEONAME"),
        *raw_ts("effective_start", "EFFECTIVESTARTDATE"),
        *raw_ts("effective_end", "EFFECTIVEENDDATE"),
    ),
    compare=("position_id", "position_code", "position_name", "active_status", "position_type", "fte",
             "full_part_time", "standard_working_hours", "organization_id", "location_id", "hiring_status",
             "assignment_category", "parent_position_code"),
)

QSTNR_QUESTION = EntitySpec(
    name="QSTNR_QUESTION", keys=("qstnr_participant_id", "qstnr_question_id"),
    order=(("last_extract_run_ts", "desc"),), not_null=("qstnr_participant_id", "qstnr_question_id"),
    columns=(
        Col("questionnaire_id", "QUESTIONNAIREBPEOQUESTIONNAIREID", "num:bigint"),
        Col("questionnaire_code", "QUESTIONNAIREBPEOQUESTIONNAIRECODE"),
        Col("qstnr_version_num", "QUESTIONNAIREBPEOQSTNRVERSIONNUM", "num:bigint"),
        Col("questionnaire_status", "QUESTIONNAIREBPEOSTATUS"),
        Col("questionnaire_name", "QUESTIONNAIRETLPEONAME"),
        Col("questionnaire_created_by", "QUESTIONNAIRETRANSLATIONPEOCREATEDBY"),
        *raw_ts("questionnaire_creation_date", "QUESTIONNAIRETRANSLATIONPEOCREATIONDATE"),
        Col("qstnr_section_id", "QUESTIONNAIRESECTIONBPEOQSTNRSECTIONID", "num:bigint"),
        Col("section_seq_num", "QUESTIONNAIRESECTIONBPEOSECTIONSEQNUM", "num:bigint"),
        Col("section_question_order", "QUESTIONNAIRESECTIONBPEOQUESTIONORDER"),
        Col("section_name", "QUESTIONSECTIONTRANSLATIONPEONAME"),
        Col("question_id", "QUESTIONBPEOQUESTIONID", "num:bigint"),
        Col("question_code", "QUESTIONBPEOQUESTIONCODE"),
        Col("question_type", "QUESTIONBPEOQUESTIONTYPE"),
        Col("classification_code", "QUESTIONBPEOCLASSIFICATIONCODE"),
        Col("qstn_version_num", "QUESTIONBPEOQSTNVERSIONNUM", "num:bigint"),
        Col("question_status", "QUESTIONBPEOSTATUS"),
        Col("question_text", "QUESTIONTRANSLATIONPEOQUESTIONTEXT"),
        Col("qstnr_question_id", "QUESTIONNAIREQUESTIONPEOQSTNRQUESTIONID", "num:bigint"),
        Col("question_seq_num", "QUESTIONNAIREQUESTIONPEOSEQNUM", "num:bigint"),
        Col("mandatory_flag", "QUESTIONNAIREQUESTIONPEOMANDATORY"),
        Col("adhoc_question_flag", "QUESTIONNAIREQUESTIONPEOADHOCQSTN"),
        Col("qstnr_participant_id", "QUESTIONNAIREPARTICIPANTPEOQSTNRPARTICIPANTID", "num:bigint"),
        Col("subject_id", "QUESTIONNAIREPARTICIPANTPEOSUBJECTID", "num:bigint"),
    ),
    compare=("qstnr_participant_id", "qstnr_question_id", "questionnaire_id", "questionnaire_code",
             "questionnaire_name", "questionnaire_status", "section_seq_num", "section_name", "question_code",
             "question_type", "question_text", "question_seq_num", "mandatory_flag", "subject_id"),
    doc="Ordered by the run time, equal for a whole load, so arrival order decides.",
)

QSTNR_RESPONSE = EntitySpec(
    name="QSTNR_RESPONSE", keys=("qstn_response_id",), order=(("last_update_date_ts", "desc"),),
    not_null=("qstn_response_id",),
    columns=(
        Col("qstnr_response_id", "QUESTIONNAIRERESPONSEPEOQSTNRRESPONSEID", "num:bigint"),
        Col("qstnr_participant_id", "QUESTIONNAIRERESPONSEPEOQSTNRPARTICIPANTID", "num:bigint"),
        Col("response_status", "QUESTIONNAIRERESPONSEPEOSTATUS"),
        Col("attempt_num", "QUESTIONNAIRERESPONSEPEOATTEMPTNUM", "num:bigint"),
        *raw_ts("submitted_date", "QUESTIONNAIRERESPONSEPEOSUBMITTEDDATETIME"),
        Col("qstnr_question_id", "QUESTIONRESPONSEPEOQSTNRQUESTIONID", "num:bigint"),
        Col("qstn_response_id", "QUESTIONRESPONSEPEOQSTNRESPONSEID", "num:bigint"),
        Col("answer_clob", "QUESTIONRESPONSEPEOANSWERCLOB"),
        Col("answer_id", "QUESTIONRESPONSEPEOANSWERID", "num:bigint"),
        Col("answer_type", "QUESTIONRESPONSEPEOANSWERTYPE"),
        Col("subject_id", "QUESTIONNAIREPARTCIPANTPEOSUBJECTID", "num:bigint"),
        *raw_ts("last_update_date", "QSTNRESPONSEPEOLASTUPDATEDATE"),
    ),
    compare=("qstn_response_id", "qstnr_response_id", "qstnr_participant_id", "response_status", "attempt_num",
             "submitted_date_ts", "qstnr_question_id", "answer_clob", "answer_id", "answer_type", "subject_id",
             "last_update_date_ts"),
    doc="One source header is spelled as the extract spells it (PARTCIPANT).",
)

def _compare_all(columns) -> tuple:
    return tuple(c.target for c in columns if not c.target.endswith("_raw"))


# Journal line fields; the text columns "lastupdatelogin" and
# "lastupdatedby" get a timestamp twin as the extract flow defines.
_JE_LINES = (
    Col("jeheaderid", "JEHEADERID", "num:bigint"),
    Col("jelinenum", "JELINENUM", "num:bigint"),
    Col("gljelinescodecombinationid", "GLJELINESCODECOMBINATIONID", "num:bigint"),
    *raw_ts("gljelinescreationdate", "GLJELINESCREATIONDATE"),
    Col("gljelinescurrencycode", "GLJELINESCURRENCYCODE"),
    *raw_ts("gljelinescurrencyconversiondate", "GLJELINESCURRENCYCONVERSIONDATE"),
    Col("gljelinescurrencyconversionrate", "GLJELINESCURRENCYCONVERSIONRATE", "num"),
    Col("gljelinescurrencyconversiontype", "GLJELINESCURRENCYCONVERSIONTYPE"),
    Col("gljelinesdescription", "GLJELINESDESCRIPTION"),
    *raw_ts("gljelineseffectivedate", "GLJELINESEFFECTIVEDATE"),
    Col("gljelinesenteredcr", "GLJELINESENTEREDCR", "num"),
    Col("gljelinesentereddr", "GLJELINESENTEREDDR", "num"),
    Col("gljelinesglsllinkid", "GLJELINESGLSLLINKID", "num:bigint"),
    Col("gljelinesignorerateflag", "GLJELINESIGNORERATEFLAG"),
    *raw_ts("gljelineslastupdatedate", "GLJELINESLASTUPDATEDATE"),
    *raw_ts("gljelineslastupdatelogin", "GLJELINESLASTUPDATELOGIN"),
    *raw_ts("gljelineslastupdatedby", "GLJELINESLASTUPDATEDBY"),
    Col("gljelinesledgerid", "GLJELINESLEDGERID", "num:bigint"),
    Col("gljelineslinetypecode", "GLJELINESLINETYPECODE"),
    Col("gljelinesobjectversionnumber", "GLJELINESOBJECTVERSIONNUMBER"),
    Col("gljelinesperiodname", "GLJELINESPERIODNAME"),
    Col("gljelinesstatamount", "GLJELINESSTATAMOUNT", "num"),
    Col("gljelinesstatus", "GLJELINESSTATUS"),
    Col("gljelinessubledgerdocsequenceid", "GLJELINESSUBLEDGERDOCSEQUENCEID", "num:bigint"),
    Col("gljelinessubledgerdocsequencevalue", "GLJELINESSUBLEDGERDOCSEQUENCEVALUE", "num"),
)

GL_JOURNAL_LINES = EntitySpec(
    name="GL_JOURNAL_LINES", keys=("jeheaderid", "jelinenum"), order=(("gljelineslastupdatedate_ts", "desc"),),
    not_null=("jeheaderid", "jelinenum"), columns=_JE_LINES, compare=_compare_all(_JE_LINES), daily=False,
    doc="Composite key; loadable on demand only.")

_JE_BATCH = (
    Col("journalbatchjebatchid", "JOURNALBATCHJEBATCHID", "num:bigint"),
    Col("journalbatchaccountedperiodtype", "JOURNALBATCHACCOUNTEDPERIODTYPE"),
    Col("journalbatchactualflag", "JOURNALBATCHACTUALFLAG"),
    Col("journalbatchapprovalstatuscode", "JOURNALBATCHAPPROVALSTATUSCODE"),
    Col("journalbatchapproveremployeeid", "JOURNALBATCHAPPROVEREMPLOYEEID", "num:bigint"),
    Col("journalbatchaveragejournalflag", "JOURNALBATCHAVERAGEJOURNALFLAG"),
    Col("journalbatchchartofaccountsid", "JOURNALBATCHCHARTOFACCOUNTSID", "num:bigint"),
    *raw_ts("journalbatchcreationdate", "JOURNALBATCHCREATIONDATE"),
    *raw_ts("journalbatchdatecreated", "JOURNALBATCHDATECREATED"),
    *raw_ts("journalbatchdefaulteffectivedate", "JOURNALBATCHDEFAULTEFFECTIVEDATE"),
    Col("journalbatchdefaultperiodname", "JOURNALBATCHDEFAULTPERIODNAME"),
    Col("journalbatchdescription", "JOURNALBATCHDESCRIPTION"),
    Col("journalbatchfundsstatuscode", "JOURNALBATCHFUNDSSTATUSCODE"),
    Col("journalbatchgroupid", "JOURNALBATCHGROUPID", "num:bigint"),
    *raw_ts("journalbatchlastupdatedate", "JOURNALBATCHLASTUPDATEDATE"),
    *raw_ts("journalbatchlastupdatelogin", "JOURNALBATCHLASTUPDATELOGIN"),
    *raw_ts("journalbatchlastupdatedby", "JOURNALBATCHLASTUPDATEDBY"),
    Col("journalbatchname", "JOURNALBATCHNAME"),
    Col("journalbatchobjectversionnumber", "JOURNALBATCHOBJECTVERSIONNUMBER"),
    Col("journalbatchparentjebatchid", "JOURNALBATCHPARENTJEBATCHID", "num:bigint"),
    Col("journalbatchperiodsetname", "JOURNALBATCHPERIODSETNAME"),
    *raw_ts("journalbatchposteddate", "JOURNALBATCHPOSTEDDATE"),
    Col("journalbatchpostingrunid", "JOURNALBATCHPOSTINGRUNID", "num:bigint"),
    Col("journalbatchrequestid", "JOURNALBATCHREQUESTID", "num:bigint"),
    Col("journalbatchstatus", "JOURNALBATCHSTATUS"),
)

GL_JOURNAL_BATCH = EntitySpec(
    name="GL_JOURNAL_BATCH", keys=("journalbatchjebatchid",), order=(("journalbatchlastupdatedate_ts", "desc"),),
    not_null=("journalbatchjebatchid",), columns=_JE_BATCH, compare=_compare_all(_JE_BATCH), daily=False,
    doc="Loadable on demand only.")

POS_CUSTOM_FLEX = EntitySpec(
    name="POS_CUSTOM_FLEX", keys=("pos_dff_id",), order=(("last_update_date_ts", "desc"),),
    not_null=("pos_dff_id",),
    columns=(
        Col("pos_dff_id", "S_K_5000", "num:bigint"),
        Col("state_position_code", "STATE_POSITION_CODE_"),
        Col("desc_state_position_code", "DESC_STATE_POSITION_CODE_"),
        Col("position_category", "POSITION_CATEGORY_"),
        Col("desc_position_category", "DESC_POSITION_CATEGORY_"),
        Col("work_schedule", "WORK_SCHEDULE_"),
        Col("desc_work_schedule", "DESC_WORK_SCHEDULE_"),
        Col("payment_schedule", "PAYMENT_SCHEDULE_"),
        Col("desc_payment_schedule", "DESC_PAYMENT_SCHEDULE_"),
        Col("stntrt_cptn_ct", "STNTRT_CPTN_CT_"),
        Col("desc_stntrt_cptn_ct", "DESC_STNTRT_CPTN_CT_"),
        Col("short_description", "SHORT_DESCRIPTION_"),
        *raw_ts("effective_start", "S_K_5001"),
        *raw_ts("effective_end", "S_K_5002"),
        *raw_ts("last_update_date", "LASTUPDATEDATE"),
    ),
    compare=("pos_dff_id", "state_position_code", "desc_state_position_code", "position_category",
             "desc_position_category", "work_schedule", "desc_work_schedule", "payment_schedule",
             "desc_payment_schedule", "stntrt_cptn_ct", "desc_stntrt_cptn_ct", "short_description"),
    doc="Extract columns are not in alphabetical order: read by header name.")

_JE_HEADER = (
    Col("gljeheadersaccrualrevchangesignflag", "GLJEHEADERSACCRUALREVCHANGESIGNFLAG"),
    Col("gljeheadersaccrualrevchangesignflagtransient", "GLJEHEADERSACCRUALREVCHANGESIGNFLAGTRANSIENT"),
    *raw_ts("gljeheadersaccrualreveffectivedate", "GLJEHEADERSACCRUALREVEFFECTIVEDATE"),
    Col("gljeheadersaccrualrevjeheaderid", "GLJEHEADERSACCRUALREVJEHEADERID", "num:bigint"),
    Col("gljeheadersaccrualrevperiodname", "GLJEHEADERSACCRUALREVPERIODNAME"),
    Col("gljeheadersaccrualrevstatus", "GLJEHEADERSACCRUALREVSTATUS"),
    Col("gljeheadersactualflag", "GLJEHEADERSACTUALFLAG"),
    Col("gljeheadersbalancedjeflag", "GLJEHEADERSBALANCEDJEFLAG"),
    Col("gljeheaderscloseacctseqassignid", "GLJEHEADERSCLOSEACCTSEQASSIGNID", "num:bigint"),
    Col("gljeheaderscloseacctseqversionid", "GLJEHEADERSCLOSEACCTSEQVERSIONID", "num:bigint"),
    *raw_ts("gljeheaderscreationdate", "GLJEHEADERSCREATIONDATE"),
    Col("gljeheaderscurrencycode", "GLJEHEADERSCURRENCYCODE"),
    *raw_ts("gljeheaderscurrencyconversiondate", "GLJEHEADERSCURRENCYCONVERSIONDATE"),
    Col("gljeheaderscurrencyconversionrate", "GLJEHEADERSCURRENCYCONVERSIONRATE", "num"),
    Col("gljeheaderscurrencyconversiontype", "GLJEHEADERSCURRENCYCONVERSIONTYPE"),
    *raw_ts("gljeheadersdatecreated", "GLJEHEADERSDATECREATED"),
    *raw_ts("gljeheadersdefaulteffectivedate", "GLJEHEADERSDEFAULTEFFECTIVEDATE"),
    Col("gljeheadersdescription", "GLJEHEADERSDESCRIPTION"),
    Col("gljeheadersdisplayalcjournalflag", "GLJEHEADERSDISPLAYALCJOURNALFLAG"),
    Col("gljeheadersencumbrancetypeid", "GLJEHEADERSENCUMBRANCETYPEID", "num:bigint"),
    Col("gljeheadersjebatchid", "GLJEHEADERSJEBATCHID", "num:bigint"),
    Col("gljeheadersjefromslaflag", "GLJEHEADERSJEFROMSLAFLAG"),
    *raw_ts("gljeheaderslastupdatedate", "GLJEHEADERSLASTUPDATEDATE"),
    *raw_ts("gljeheaderslastupdatelogin", "GLJEHEADERSLASTUPDATELOGIN"),
    *raw_ts("gljeheaderslastupdatedby", "GLJEHEADERSLASTUPDATEDBY"),
    Col("gljeheadersledgerid", "GLJEHEADERSLEDGERID", "num:bigint"),
    Col("gljeheaderslegalentityid", "GLJEHEADERSLEGALENTITYID", "num:bigint"),
    Col("gljeheadersmultibalsegflag", "GLJEHEADERSMULTIBALSEGFLAG"),
    Col("gljeheadersmulticurrencyflag", "GLJEHEADERSMULTICURRENCYFLAG"),
    Col("gljeheadersname", "GLJEHEADERSNAME"),
    Col("gljeheadersobjectversionnumber", "GLJEHEADERSOBJECTVERSIONNUMBER"),
    Col("gljeheadersparentjeheaderid", "GLJEHEADERSPARENTJEHEADERID", "num:bigint"),
    Col("gljeheadersperiodname", "GLJEHEADERSPERIODNAME"),
    Col("gljeheaderspostcurrencycode", "GLJEHEADERSPOSTCURRENCYCODE"),
    Col("gljeheaderspostmulticurrencyflag", "GLJEHEADERSPOSTMULTICURRENCYFLAG"),
    *raw_ts("gljeheadersposteddate", "GLJEHEADERSPOSTEDDATE"),
    *raw_ts("gljeheadersposteddatetime", "GLJEHEADERSPOSTEDDATETIME"),
    Col("gljeheaderspostingacctseqassignid", "GLJEHEADERSPOSTINGACCTSEQASSIGNID", "num:bigint"),
    Col("gljeheaderspostingacctseqversionid", "GLJEHEADERSPOSTINGACCTSEQVERSIONID", "num:bigint"),
    *raw_ts("gljeheadersreferencedate", "GLJEHEADERSREFERENCEDATE"),
    Col("gljeheadersreversedjeheaderid", "GLJEHEADERSREVERSEDJEHEADERID", "num:bigint"),
    Col("gljeheadersstatus", "GLJEHEADERSSTATUS"),
    Col("jeheaderid", "JEHEADERID", "num:bigint"),
)

GL_JOURNAL_HEADER = EntitySpec(
    name="GL_JOURNAL_HEADER", keys=("jeheaderid",), order=(("gljeheaderslastupdatedate_ts", "desc"),),
    not_null=("jeheaderid",), columns=_JE_HEADER, compare=_compare_all(_JE_HEADER), daily=False,
    doc="Loadable on demand only.")

AP_INV_APPLICATION = EntitySpec(
    name="AP_INV_APPLICATION", keys=("invoice_payment_id",), order=(("last_update_date_ts", "desc"),),
    not_null=("invoice_payment_id",),
    columns=(
        Col("invoice_payment_id", "APINVOICEPAYMENTSALLINVOICEPAYMENTID", "num:bigint"),
        Col("invoice_id", "APINVOICEPAYMENTSALLINVOICEID", "num:bigint"),
        Col("check_id", "APINVOICEPAYMENTSALLCHECKID", "num:bigint"),
        Col("payment_num", "APINVOICEPAYMENTSALLPAYMENTNUM", "num:bigint"),
        Col("amount", "APINVOICEPAYMENTSALLAMOUNT", "num"),
        Col("amount_inv_curr", "APINVOICEPAYMENTSALLAMOUNTINVCURR", "num"),
        Col("invoice_base_amount", "APINVOICEPAYMENTSALLINVOICEBASEAMOUNT", "num"),
        Col("payment_base_amount", "APINVOICEPAYMENTSALLPAYMENTBASEAMOUNT", "num"),
        Col("invoice_currency_code", "APINVOICEPAYMENTSALLINVOICECURRENCYCODE"),
        Col("payment_currency_code", "APINVOICEPAYMENTSALLPAYMENTCURRENCYCODE"),
        Col("invoice_payment_type", "APINVOICEPAYMENTSALLINVOICEPAYMENTTYPE"),
        Col("discount_taken", "APINVOICEPAYMENTSALLDISCOUNTTAKEN", "num"),
        Col("discount_lost", "APINVOICEPAYMENTSALLDISCOUNTLOST", "num"),
        *raw_ts("accounting_date", "APINVOICEPAYMENTSALLACCOUNTINGDATE"),
        Col("period_name", "APINVOICEPAYMENTSALLPERIODNAME"),
        Col("posted_flag", "APINVOICEPAYMENTSALLPOSTEDFLAG"),
        Col("reversal_flag", "APINVOICEPAYMENTSALLREVERSALFLAG"),
        Col("reversal_inv_pmt_id", "APINVOICEPAYMENTSALLREVERSALINVPMTID", "num:bigint"),
        Col("org_id", "APINVOICEPAYMENTSALLORGID", "num:bigint"),
        Col("exchange_rate", "APINVOICEPAYMENTSALLEXCHANGERATE", "num"),
        *raw_ts("exchange_date", "APINVOICEPAYMENTSALLEXCHANGEDATE"),
        Col("exchange_rate_type", "APINVOICEPAYMENTSALLEXCHANGERATETYPE"),
        Col("accts_pay_ccid", "APINVOICEPAYMENTSALLACCTSPAYCODECOMBINATIONID", "num:bigint"),
        Col("remit_to_supplier_name", "APINVOICEPAYMENTSALLREMITTOSUPPLIERNAME"),
        *raw_ts("creation_date", "APINVOICEPAYMENTSALLCREATIONDATE"),
        *raw_ts("last_update_date", "APINVOICEPAYMENTSALLLASTUPDATEDATE"),
    ),
    compare=("invoice_payment_id", "invoice_id", "check_id", "payment_num", "amount", "amount_inv_curr",
             "invoice_base_amount", "payment_base_amount", "invoice_currency_code", "payment_currency_code",
             "invoice_payment_type", "discount_taken", "discount_lost", "accounting_date_ts", "period_name",
             "posted_flag", "reversal_flag", "reversal_inv_pmt_id", "org_id", "exchange_rate", "exchange_date_ts",
             "exchange_rate_type", "accts_pay_ccid", "remit_to_supplier_name", "last_update_date_ts"),
)

_AP_CHECKS = (
    Col("check_id", "APCHECKSALLCHECKID", "num:bigint"),
    Col("check_number", "APCHECKSALLCHECKNUMBER", "num:bigint"),
    *raw_ts("check_date", "APCHECKSALLCHECKDATE"),
    Col("amount", "APCHECKSALLAMOUNT", "num"),
    Col("base_amount", "APCHECKSALLBASEAMOUNT", "num"),
    Col("currency_code", "APCHECKSALLCURRENCYCODE"),
    Col("status_lookup_code", "APCHECKSALLSTATUSLOOKUPCODE"),
    Col("payment_method_code", "APCHECKSALLPAYMENTMETHODCODE"),
    Col("payment_type_flag", "APCHECKSALLPAYMENTTYPEFLAG"),
    Col("vendor_id", "APCHECKSALLVENDORID", "num:bigint"),
    Col("vendor_name", "APCHECKSALLVENDORNAME"),
    Col("vendor_site_id", "APCHECKSALLVENDORSITEID", "num:bigint"),
    Col("vendor_site_code", "APCHECKSALLVENDORSITECODE"),
    Col("remit_to_supplier_id", "APCHECKSALLREMITTOSUPPLIERID", "num:bigint"),
    Col("remit_to_supplier_name", "APCHECKSALLREMITTOSUPPLIERNAME"),
    Col("org_id", "APCHECKSALLORGID", "num:bigint"),
    Col("legal_entity_id", "APCHECKSALLLEGALENTITYID", "num:bigint"),
    Col("bank_account_name", "APCHECKSALLBANKACCOUNTNAME"),
    Col("ce_bank_acct_use_id", "APCHECKSALLCEBANKACCTUSEID", "num:bigint"),
    Col("external_bank_account_id", "APCHECKSALLEXTERNALBANKACCOUNTID", "num:bigint"),
    Col("check_run_name", "APCHECKSALLCHECKRUNNAME"),
    Col("cleared_amount", "APCHECKSALLCLEAREDAMOUNT", "num"),
    Col("cleared_base_amount", "APCHECKSALLCLEAREDBASEAMOUNT", "num"),
    *raw_ts("cleared_date", "APCHECKSALLCLEAREDDATE"),
    *raw_ts("void_date", "APCHECKSALLVOIDDATE"),
    *raw_ts("released_date", "APCHECKSALLRELEASEDDATE"),
    Col("exchange_rate", "APCHECKSALLEXCHANGERATE", "num"),
    *raw_ts("exchange_date", "APCHECKSALLEXCHANGEDATE"),
    *raw_ts("creation_date", "APCHECKSALLCREATIONDATE"),
    *raw_ts("last_update_date", "APCHECKSALLLASTUPDATEDATE"),
)

AP_DISBURSEMENT = EntitySpec(
    name="AP_DISBURSEMENT", keys=("check_id",), order=(("last_update_date_ts", "desc"),), not_null=("check_id",),
    columns=_AP_CHECKS, compare=_compare_all(_AP_CHECKS))

_SALARY = (
    Col("salary_id", "SALARYID", "num:bigint"),
    Col("person_id", "PERSONID", "num:bigint"),
    Col("assignment_id", "ASSIGNMENTID", "num:bigint"),
    Col("assignment_type", "ASSIGNMENTTYPE"),
    Col("business_unit_id", "BUSINESSUNITID", "num:bigint"),
    Col("legal_entity_id", "LEGALENTITYID", "num:bigint"),
    Col("hcm_job_id", "JOBID", "num:bigint"),
    Col("grade_id", "GRADEID", "num:bigint"),
    Col("element_entry_id", "ELEMENTENTRYID", "num:bigint"),
    Col("element_type_id", "ELEMENTTYPEID", "num:bigint"),
    Col("input_value_id", "INPUTVALUEID", "num:bigint"),
    Col("salary_amount", "SALARYAMOUNT", "num"),
    Col("annual_salary", "ANNUALSALARY", "num"),
    Col("annual_ft_salary", "ANNUALFTSALARY", "num"),
    Col("currency_code", "CURRENCYCODE"),
    Col("salary_basis_code", "SALARYBASISCODE"),
    Col("salary_basis_id", "SALARYBASISID", "num:bigint"),
    Col("salary_basis_type", "SALARYBASISTYPE"),
    Col("salary_approved", "SALARYAPPROVED"),
    Col("salary_factor", "SALARYFACTOR", "num"),
    Col("payroll_factor", "PAYROLLFACTOR", "num"),
    Col("payroll_frequency_code", "PAYROLLFREQUENCYCODE"),
    Col("fte_value", "FTEVALUE", "num"),
    Col("salary_transaction_status", "SALARYTRANSACTIONSTATUS"),
    Col("salary_reason_code", "SALARYREASONCODE"),
    Col("component_usage", "COMPONENTUSAGE"),
    Col("multiple_components", "MULTIPLECOMPONENTS"),
    Col("action_id", "ACTIONID", "num:bigint"),
    Col("action_occurrence_id", "ACTIONOCCURRENCEID", "num:bigint"),
    Col("action_reason_id", "ACTIONREASONID", "num:bigint"),
    Col("adjustment_amount", "ADJUSTMENTAMOUNT", "num"),
    Col("adjustment_percent", "ADJUSTMENTPERCENT", "num"),
    Col("rate_id", "RATEID", "num:bigint"),
    Col("rate_factor", "RATEFACTOR", "num"),
    Col("rate_max_amount", "RATEMAXAMOUNT", "num"),
    Col("rate_mid_amount", "RATEMIDAMOUNT", "num"),
    Col("rate_min_amount", "RATEMINAMOUNT", "num"),
    Col("rate_default_amount", "RATEDEFAULTAMOUNT", "num"),
    Col("range_position", "RANGEPOSITION", "num"),
    Col("comparatio", "COMPARATIO", "num"),
    Col("quartile", "QUARTILE", "num"),
    Col("quintile", "QUINTILE", "num"),
    Col("total_base_pay", "TOTALBASEPAY", "num"),
    Col("total_component_adj_amt", "TOTALCOMPONENTADJAMT", "num"),
    Col("total_component_adj_percent", "TOTALCOMPONENTADJPERCENT", "num"),
    *raw_ts("date_from", "DATEFROM"),
    *raw_ts("date_to", "DATETO"),
    *raw_ts("salary_effective_start", "SALARYEFFECTIVESTARTDATE"),
    *raw_ts("salary_effective_end", "SALARYEFFECTIVEENDDATE"),
    *raw_ts("review_date", "REVIEWDATE"),
    *raw_ts("next_sal_review", "NEXTSALREVIEWDATE"),
    Col("work_at_home", "WORKATHOME"),
    Col("object_version_number", "OBJECTVERSIONNUMBER", "num:bigint"),
)

HCM_SALARY = EntitySpec(
    name="HCM_SALARY", keys=("salary_id",), order=(("salary_effective_start_ts", "desc"),), not_null=("salary_id",),
    columns=_SALARY,
    compare=("salary_id", "person_id", "assignment_id", "salary_amount", "annual_salary", "currency_code",
             "salary_basis_code", "salary_approved", "salary_transaction_status", "date_from_ts", "date_to_ts",
             "salary_effective_start_ts", "salary_effective_end_ts", "comparatio", "quartile", "quintile",
             "rate_max_amount", "rate_mid_amount", "rate_min_amount"))

# GL budget segment widths (lpad + truncate) of the 9 segments.
BUDGET_SEGMENT_WIDTHS = (4, 3, 4, 3, 3, 7, 4, 4, 5)


BUDGET_SEGMENTS = ("fund", "location", "function1", "grant_code", "initiative", "account", "activity", "interfund", "future1")


def _budget_segment_string() -> Column:
    return segment_string([F.col(c) for c in BUDGET_SEGMENTS])


GL_BUDGET_BALANCE = EntitySpec(
    name="GL_BUDGET_BALANCE",
    keys=("ledger_id", "budget_name", "currency_code", "period_name", "segment_string"),
    order=(("last_update_date_ts", "desc"),), not_null=("segment_string",),
    columns=(
        Col("ledger_id", "LEDGERID", "num"),
        Col("budget_name", "BUDGETNAME"),
        Col("currency_code", "CURRENCYCODE"),
        Col("currency_type", "CURRENCYTYPE"),
        Col("period_name", "PERIODNAME"),
        *[Derived(name, (lambda i=i, w=w: lpad_trunc(F.col(f"GLBUDBALSEGMENT{i}"), w)), (f"GLBUDBALSEGMENT{i}",))
          for i, (name, w) in enumerate(zip(BUDGET_SEGMENTS, BUDGET_SEGMENT_WIDTHS), 1)],
        Derived("segment_string", _budget_segment_string),
        Col("period_net_cr", "GLBUDBALPERIODNETCR", "num"),
        Col("period_net_dr", "GLBUDBALPERIODNETDR", "num"),
        *raw_ts("last_update_date", "GLBUDBALLASTUPDATEDATE"),
    ),
    compare=("ledger_id", "budget_name", "currency_code", "currency_type", "period_name", *BUDGET_SEGMENTS, "segment_string",
             "period_net_cr", "period_net_dr", "last_update_date_ts"),
    daily=False,
    doc="segment_string is never NULL (NULL segments join as ''), so its filter always passes.",
)


def _key_spec(name, keys, order=(), not_null=None, flags=(), daily=True, doc=""):
    nn = tuple(keys) if not_null is None else tuple(not_null)
    return EntitySpec(name=name, keys=tuple(keys), order=tuple(order), not_null=nn, flags=tuple(flags),
                      daily=daily, doc=doc)


_LU = (("last_update_date_ts", "desc"),)

# Keys, dedup orders and NULL filters of every entity.  Column
# mappings of the entities without one here are supplied at run time
# (``with_columns``); the flow is the same.
ENTITY_KEYS: dict[str, EntitySpec] = {
    s.name: s for s in [
        AP_DISBURSEMENT,
        AP_INV_APPLICATION,
        AP_INVOICE_HDR,
        GL_BALANCE,
        GL_BUDGET_BALANCE,
        GL_CODE_COMB,
        GL_JOURNAL_BATCH,
        GL_JOURNAL_HEADER,
        GL_JOURNAL_LINES,
        PO_HDR,
        PO_LINES,
        SUPPLIER_HDR,
        HCM_ASSIGNMENT,
        HCM_EMPLOYEE,
        HCM_POSITION,
        HCM_SALARY,
        POS_CUSTOM_FLEX,
        QSTNR_ANSWER,
        QSTNR_QUESTION,
        QSTNR_RESPONSE,
        _key_spec("AR_INVOICES", ["racustomertrxcustomertrxid"], _LU, daily=False,
                  doc="Has a final-table definition but no loader upstream; generic spec."),
    ]
}


def with_columns(spec: EntitySpec, columns, compare=None, update=None) -> EntitySpec:
    """A key-level spec completed with its column mapping."""
    from dataclasses import replace
    return replace(spec, columns=tuple(columns), compare=compare, update=update)


def get(name: str) -> EntitySpec:
    return ENTITY_KEYS[name.upper()]


__all__ = ["Col", "Derived", "EntitySpec", "ENTITY_KEYS", "raw_ts", "with_columns", "get",
           "PO_LINES", "HCM_EMPLOYEE", "GL_BUDGET_BALANCE", "AP_INVOICE_HDR", "GL_BALANCE", "HCM_ASSIGNMENT",
           "GL_CODE_COMB", "PO_HDR", "SUPPLIER_HDR", "QSTNR_ANSWER", "HCM_POSITION", "QSTNR_QUESTION",
           "QSTNR_RESPONSE", "GL_JOURNAL_LINES", "GL_JOURNAL_BATCH", "POS_CUSTOM_FLEX",
           "GL_JOURNAL_HEADER", "AP_INV_APPLICATION", "AP_DISBURSEMENT", "HCM_SALARY"]
