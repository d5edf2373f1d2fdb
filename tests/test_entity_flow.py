import datetime as dt
from decimal import Decimal

from tierlake.plans import entity_flow as EF
from tierlake.plans import specs as S

PO_HEADER = ("POHEADERID,POLINEID,LINENUM,CREATEDBY,CREATIONDATE,FUNDSSTATUS,ITEMDESCRIPTION,LASTUPDATEDBY,"
             "LINESTATUS,LISTPRICE,MATCHINGBASIS,PURCHASEBASIS,SHIPPINGUOMCODE,UNITPRICE,UOMCODE,UNUSEDCOL")


def po_csv(lines):
    return PO_HEADER + "\n" + "\n".join(lines) + "\n"


BATCH1 = [
    '10,1,1,ann,2025-06-14,OK,Bolt,ann,OPEN,1.5,QTY,GOODS,EA,1.25,EA,x',
    '10,2,2,ann,6/14/2025,OK,Nut,ann,OPEN,2,QTY,GOODS,EA,2,EA,x',
    '10,3,3,ann,2025-06-14T12:30:44Z,OK,Washer,ann,OPEN,3,QTY,GOODS,EA,3,EA,x',
]
BATCH2 = [
    '10,1,1,ann,2025-06-14,OK,Bolt,ann,OPEN,1.5,QTY,GOODS,EA,1.30,EA,x',      # changed (unitprice)
    '10,2,2,ann,6/14/2025,OK,Nut,ann,OPEN,2,AMOUNT,GOODS,EA,2,EA,x',          # changed outside compare list
    '10,3,3,ann,2025-06-14T12:30:44Z,OK,Washer,ann,OPEN,3,QTY,GOODS,EA,3,EA,x',  # identical
    '10,4,4,bob,bad-date,OK,"Big, long\nscrew",bob,OPEN,4,QTY,GOODS,EA,abc,EA,x',  # new; quoted comma+newline
    '10,4,4,bob,,OK,dup later,bob,OPEN,4,QTY,GOODS,EA,5,EA,x',                 # duplicate key: first arrival wins
    '10,,9,bob,,OK,no key,bob,OPEN,4,QTY,GOODS,EA,5,EA,x',                     # NULL key
]


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_po_lines_three_tiers(spark, tmp_path):
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    spec = S.PO_LINES
    write(tmp_path / "b1.csv", po_csv(BATCH1))
    j1, c1 = EF.load_and_preview(wh, spec, str(tmp_path / "b1.csv"), "b1.zip")
    assert (c1["new_count"], c1["changed_count"], c1["unchanged_count"], c1["rows_loaded"]) == (3, 0, 0, 3)
    assert EF.merge_job(wh, spec, j1, "b1.zip") == 3
    write(tmp_path / "b2.csv", po_csv(BATCH2))
    j2, c2 = EF.load_and_preview(wh, spec, str(tmp_path / "b2.csv"), "b2.zip")
    # new: key 4 and the NULL key; matched 1,2,3; unchanged: 2 (outside list) and 3
    assert (c2["new_count"], c2["changed_count"], c2["unchanged_count"], c2["rows_loaded"]) == (2, 1, 2, 4)
    EF.merge_job(wh, spec, j2, "b2.zip")
    final = {r.polineid: r for r in wh.final(spec).read().collect()}
    assert final[Decimal(1)].unitprice == Decimal("1.30000")
    assert final[Decimal(2)].matchingbasis == "AMOUNT"
    assert final[Decimal(4)].itemdescription == "Big, long\nscrew"
    assert final[Decimal(4)].unitprice is None and final[Decimal(4)].creationdate is None
    assert final[Decimal(3)].creationdate == dt.datetime(2025, 6, 14, 12, 30, 44)
    assert final[None].itemdescription == "no key"
    ids = sorted(r.id for r in final.values())
    assert ids == [1, 2, 3, 4, 5] and final[Decimal(1)].id == 1
    state = {r.job_id: r for r in wh.jobs().current().collect()}
    assert state[j2].status == "MERGED" and state[j2].new_count == 2 and state[j2].rows_merged == 5
    # staging partition of a merged job is gone
    import os
    assert not os.path.exists(f"{wh.staging_path(spec)}/job_id={j2}")


EMP_COLS = ["PERSONID", "PERSONDETAILSPEOPERSONNUMBER", "PERSONDETAILSPEO1PERSONNUMBER", "PERSONNAMEPEODISPLAYNAME",
            "PERSONNAMEPEOFULLNAME", "ASSIGNMENTPEOASSIGNMENTID", "ASSIGNMENTPEONORMALHOURS",
            "ASSIGNMENTPEOEFFECTIVESTARTDATE", "ASSIGNMENTPEOEFFECTIVELATESTCHANGE",
            "ASSIGNMENTPEOPRIMARYASSIGNMENTFLAG", "PERIODOFSERVICEPEODATESTART"]


def test_hcm_employee_flags_and_order(spark, tmp_path):
    spec = S.HCM_EMPLOYEE
    other = [c for c in spec.landing_columns() if c not in EMP_COLS]
    header = ",".join(EMP_COLS + other)
    pad = "," * len(other)
    lines = [
        "1,,P1,,Ann Full,11,40,2025-01-01,Y,N,2020-01-01" + pad,      # not primary
        "1,E1,,Ann,,12,40,2025-02-01,Y,Y,2020-01-01" + pad,           # primary
        "2,E2,,Bo,,21,20,2025-03-01,Y,Y,2021-01-01" + pad,
        "2,E2,,Bo,,22,30,2025-04-01,Y,Y,2021-01-01" + pad,            # later start wins
        "3,E3,,Cy,,31,10,2025-01-01,Y,Y," + pad,
        "3,E3,,Cy,,32,10,2025-01-01,Y,Y," + pad,                      # tie: first arrival wins
        "4,E4,,Di,,41,10,,Y,Y," + pad,                                # NULL date loses
        "4,E4,,Di,,42,10,2024-01-01,Y,Y," + pad,
        "5,E5,,Ed,,51,10,2025-01-01,,Y," + pad,                       # NULL flag filtered
        ",E6,,Fa,,61,10,2025-01-01,Y,Y," + pad,                       # NULL key filtered
    ]
    write(tmp_path / "e.csv", header + "\n" + "\n".join(lines) + "\n")
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    job, counts = EF.load_and_preview(wh, spec, str(tmp_path / "e.csv"))
    assert counts["rows_loaded"] == 5 and counts["new_count"] == 4
    EF.merge_job(wh, spec, job)
    got = {r.person_id: r for r in wh.final(spec).read().collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1].assignment_id == 12 and got[1].person_number == "E1" and got[1].display_name == "Ann"
    assert got[2].assignment_id == 22 and got[3].assignment_id == 31 and got[4].assignment_id == 42
    assert got[2].normal_hours == Decimal("30.00")
    assert "hire_date_raw" not in wh.final(spec).read().columns and got[1].hire_date_ts == dt.datetime(2020, 1, 1)


def test_missing_column_fails_loudly(spark, tmp_path):
    import pytest
    from tierlake.sources.landing import MissingColumnsError
    write(tmp_path / "bad.csv", "POHEADERID,POLINEID\n1,2\n")
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(MissingColumnsError):
        EF.load_and_preview(wh, S.PO_LINES, str(tmp_path / "bad.csv"))
    state = wh.jobs().current().collect()
    assert state[0].status == "ERROR" and "POLINEID" not in (state[0].error_message or "POLINEID")[:0]


def test_gl_balance_composite_key_and_quarantine(spark, tmp_path):
    spec = S.GL_BALANCE
    cols = spec.landing_columns()
    def row(ledger, ccid, cur, flag, enc, period, amt, upd):
        vals = {"BALANCELEDGERID": ledger, "BALANCECODECOMBINATIONID": ccid, "BALANCECURRENCYCODE": cur,
                "BALANCEACTUALFLAG": flag, "BALANCEENCUMBRANCETYPEID": enc, "BALANCEPERIODNAME": period,
                "BALANCEBEGINBALANCECR": amt, "BALANCELASTUPDATEDATE": upd}
        return ",".join(vals.get(c, "") for c in cols)
    lines = [row("1", "100", "USD", "A", "", "JAN-26", "10.5", "2026-01-31 10:00:00"),
             row("1", "100", "USD", "A", "7", "JAN-26", "11", "2026-01-31 09:00:00"),   # same key, older
             row("1", "101", "", "A", "", "JAN-26", "1", "2026-01-31 10:00:00"),        # NULL currency
             row("1", "", "USD", "A", "", "JAN-26", "1", "2026-01-31 10:00:00")]        # NULL ccid: filtered
    write(tmp_path / "gl.csv", ",".join(cols) + "\n" + "\n".join(lines) + "\n")
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    job, counts = EF.load_and_preview(wh, spec, str(tmp_path / "gl.csv"))
    assert counts["rows_loaded"] == 2 and counts["new_count"] == 2
    assert EF.merge_job(wh, spec, job) == 1
    fin = wh.final(spec).read().collect()
    assert len(fin) == 1 and fin[0].begin_balance_cr == Decimal("10.5") and fin[0].encumbrance_type_id is None
    held = spark.read.parquet(wh.quarantine_path(spec)).collect()
    assert len(held) == 1 and held[0].code_combination_id == 101
    from tierlake.operators.audit import key_audit
    staged_all = EF.stage(
        __import__("tierlake.sources.landing", fromlist=["x"]).read_landing_csv(spark, str(tmp_path / "gl.csv"),
                                                                               required=cols), spec, 0)
    audit = key_audit(staged_all, list(spec.keys), ["encumbrance_type_id"]).collect()
    assert len(audit) == 1 and audit[0].n_variants == 2


def test_every_full_spec_stages_a_smoke_csv(spark, tmp_path):
    """Two generated rows per entity with a column mapping (FIXTURES 1.7): stage, preview, merge."""
    specs = [s for s in S.ENTITY_KEYS.values() if s.columns]
    assert len(specs) >= 10
    for spec in specs:
        cols = spec.landing_columns()
        kinds = {}
        for c in spec.columns:
            for src in c.sources:
                kinds.setdefault(src, getattr(c, "cast", "num"))
        flags = {f for c in spec.columns if c.target in spec.flags for f in c.sources}

        def val(c, i):
            k = kinds.get(c, "str")
            if c in flags:
                return "Y"
            if k.startswith("num"):
                return str(i)
            if k in ("ts", "date"):
                return f"2026-03-0{i} 10:00:00"
            return f"v{i}"
        lines = [",".join(val(c, i) for c in cols) for i in (1, 2)]
        path = tmp_path / f"{spec.name}.csv"
        write(path, ",".join(cols) + "\n" + "\n".join(lines) + "\n")
        wh = EF.Warehouse(spark, str(tmp_path / "wh"))
        job, counts = EF.load_and_preview(wh, spec, str(path))
        assert counts["new_count"] >= 1, spec.name
        EF.merge_job(wh, spec, job)
        assert wh.final(spec).read().count() >= 1, spec.name
