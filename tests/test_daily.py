"""The daily run, killed after each of its steps and repeated."""

import datetime as dt
import zipfile

import pytest

from tierlake.plans import daily, entity_flow as EF
from tierlake.plans.daily import DailyRun
from tierlake.plans.specs import Col, EntitySpec
from tierlake.session import local_rows
from tierlake.sources.store import SnapshotTable

NOW = dt.datetime(2026, 3, 9, 20)
MAP = [(1, 1, "%orders%", "ORDERS", "Y", "Y"), (2, 2, "%people%", "PEOPLE", "Y", "Y"), (3, 3, "%off%", "PEOPLE", "Y", "N")]


def spec(name):
    return EntitySpec(name=name, keys=("k",), order=(("d", "desc"),), not_null=("k",),
                      columns=(Col("k", "K", "num:bigint"), Col("v", "V"), Col("d", "D", "ts")), compare=("k", "v"))


def land(path, rows):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("data.csv", "K,V,D\n" + "".join(f'{k},"{v}",{d}\n' for k, v, d in rows))


@pytest.fixture()
def run(spark, tmp_path):
    inbox = tmp_path / "inbox" / "sub"
    inbox.mkdir(parents=True)
    land(inbox / "file_orders-b1-20260309_080000.zip", [(1, "too old a file", "2026-01-01")])
    land(inbox / "file_orders-b2-20260309_090000.zip", [(1, "a", "2026-01-01"), (1, "b\nnewer", "2026-02-01"), (2, "c", "2026-01-01")])
    land(inbox / "file_people-b1-20260309_100000.zip", [(7, "p", "2026-01-01"), ("", "no key", "2026-01-01")])
    land(inbox / "file_off-b1-20260309_110000.zip", [(8, "not available", "2026-01-01")])
    land(inbox / "file_people-b0-20260101_100000.zip", [(9, "last winter", "2026-01-01")])
    land(inbox / "file_unknown-b0-20260309_100000.zip", [(9, "unmapped", "2026-01-01")])
    (tmp_path / "inbox" / "notes.txt").write_text("no archive")
    wh = EF.Warehouse(spark, str(tmp_path / "wh"))
    lm = local_rows(spark, MAP, "map_id int, priority int, file_like string, load_type string, is_active string, loader_available string")
    return DailyRun(wh, {n: spec(n) for n in ("ORDERS", "PEOPLE")}, str(tmp_path / "inbox"), lm, load_types=["ORDERS", "PEOPLE"])


DONE = [("file_orders-b2-20260309_090000.zip", "ORDERS"), ("file_people-b1-20260309_100000.zip", "PEOPLE")]


def finals(run):
    return {n: sorted((r.k, r.v) for r in run.wh.final(run.specs[n]).read().collect()) for n in run.specs}


def jobs(run):
    return sorted((j.file_name, j.status, j.rows_merged) for j in run.wh.jobs().current().collect())


WANT = {"ORDERS": [(1, "b\nnewer"), (2, "c")], "PEOPLE": [(7, "p")]}
MERGED = [("file_orders-b2-20260309_090000.zip", "MERGED", 2), ("file_people-b1-20260309_100000.zip", "MERGED", 1)]


def test_a_whole_run_and_nothing_to_do(run):
    calls = []
    run.before = lambda: calls.append(1)
    assert run.run(NOW) == DONE and finals(run) == WANT and jobs(run) == MERGED and calls == [1]
    assert run.catalog().read().count() == 6
    assert run.run(NOW) == [] and jobs(run) == MERGED


class Killed(BaseException):
    pass


STEPS = ["refresh_catalog", "unzipped", "staged", "previewed", "before_commit", "committed", "second_load"]


@pytest.mark.parametrize("step", STEPS)
def test_killed_after_each_step_and_repeated(run, monkeypatch, step):
    def after(owner, name, when=lambda *a: True, first=False):
        real = getattr(owner, name)

        def dies(*a, **kw):
            if first and when(*a):
                raise Killed
            out = real(*a, **kw)
            if when(*a):
                raise Killed
            return out
        monkeypatch.setattr(owner, name, dies)

    if step in ("refresh_catalog", "unzipped"):
        after(DailyRun, step)
    elif step == "staged":
        after(EF.Warehouse, "deduped", first=True)          # staging is written, the preview is not there
    elif step == "previewed":
        after(daily, "load_and_preview")
    elif step == "before_commit":
        after(SnapshotTable, "_commit", lambda t, st: "final/orders" in t.root and st["deltas"], first=True)
    elif step == "committed":
        after(SnapshotTable, "_commit", lambda t, st: "final/orders" in t.root and st["deltas"])
    else:
        after(daily, "load_and_preview", lambda wh, spec, *a: spec.name == "PEOPLE")
    with pytest.raises(Killed):
        run.run(NOW)
    monkeypatch.undo()
    run.run(NOW)
    assert finals(run) == WANT and jobs(run) == MERGED
    assert run.run(NOW) == []


def test_a_failed_file_is_tried_again(run, monkeypatch):
    def broken(*a, **kw):
        raise ValueError("bad extract")
    monkeypatch.setattr(EF, "dedup", broken)
    with pytest.raises(ValueError):
        run.run(NOW)
    monkeypatch.undo()
    assert run.run(NOW) == DONE and finals(run) == WANT
