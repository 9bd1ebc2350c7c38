"""Versions of month folders, and builds of the touched months only."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitewell.operators import checks
from sitewell.plans import incremental, warehouse
from sitewell.sources import landing, seeds, versions
from tests import site_group
from tests.conftest import rows


def days(spark, *entries):
    return spark.createDataFrame([(None if d is None else dt.date(*d), v) for d, v in entries], "day date, v string")


def held(spark, table):
    return sorted(r["v"] for r in spark.table(table).collect())


def files(spark, table):
    """Data files of the newest version with their times."""
    base, now = versions.root(spark, table).removeprefix("file:"), versions.load(spark, table)
    return {str(p): os.stat(p).st_mtime_ns for period, run in now.files()
            for p in pathlib.Path(f"{base}/{versions.PERIOD}={period}/{versions.RUN}={run}").glob("*.parquet")}


JANUARY, MARCH, APRIL = ((2025, 1, 5), "jan"), ((2025, 3, 5), "early"), ((2025, 4, 1), "april")


def loaded(spark, table):
    landing.replace_window(days(spark, JANUARY, MARCH, ((2025, 3, 20), "gone"), APRIL, (None, "undated")), table, "day", dt.date(2025, 1, 1))
    return dt.date(2025, 3, 10)


def test_months_before_the_window_keep_their_files(spark):
    since = loaded(spark, "v_files")
    before = files(spark, "v_files")
    landing.replace_window(days(spark, ((2025, 3, 11), "new")), "v_files", "day", since)
    after = files(spark, "v_files")
    assert held(spark, "v_files") == ["early", "jan", "new", "undated"]
    kept = {p for p in before if "=202501/" in p or "=0/" in p}
    assert len(kept) == 2 and all(after[p] == before[p] for p in kept)
    assert versions.changed(spark, "v_files", 1) == {202503, 202504}  # April is mentioned no more
    assert held(spark, "v_files") == sorted(r["v"] for r in versions.read(spark, "v_files").collect())


@pytest.mark.parametrize("step", ["evaluate", "late", "rows", "manifest", "view"])
def test_a_load_that_fails_at_any_step_leaves_all_rows(spark, monkeypatch, step):
    table = f"v_fail_{step}"
    since = loaded(spark, table)
    wanted = held(spark, table)
    bad = days(spark, ((2025, 2, 1), "late"), ((2025, 3, 15), "new"))
    with monkeypatch.context() as m:
        if step == "evaluate":
            bad = bad.withColumn("v", F.when(F.col("v") == "new", F.raise_error(F.lit("bad row"))).otherwise(F.col("v")))
        elif step in ("late", "rows"):
            plain = versions.write

            def fails(df, to, *rest):
                if (step == "late") == to.endswith("_late"):
                    df = df.withColumn("v", F.when(F.col("v") != "", F.raise_error(F.lit("disk full"))).otherwise(F.col("v")))
                return plain(df, to, *rest)

            m.setattr(versions, "write", fails)
        else:
            def stop(*_):
                raise OSError("lost")

            m.setattr(versions, "_publish" if step == "manifest" else "point", stop)
        with pytest.raises((PySparkException, OSError)):
            landing.replace_window(bad, table, "day", since)
    assert held(spark, table) == wanted
    # the same load again ends well, and no late row stands twice
    again = days(spark, ((2025, 2, 1), "late"), ((2025, 3, 15), "new"))
    for _ in range(2):
        assert landing.replace_window(again, table, "day", since) == 1
    assert held(spark, table) == ["early", "jan", "new", "undated"] and held(spark, f"{table}_late") == ["late"]


def test_late_rows_of_each_window(spark):
    since = loaded(spark, "v_late")
    landing.replace_window(days(spark, ((2025, 2, 1), "a"), ((2025, 2, 2), "b")), "v_late", "day", since)
    landing.replace_window(days(spark, ((2025, 2, 1), "c")), "v_late", "day", dt.date(2025, 3, 20))
    assert held(spark, "v_late_late") == ["a", "b", "c"]
    landing.replace_window(days(spark, ((2025, 3, 30), "x")), "v_late", "day", since)  # now without late rows
    assert held(spark, "v_late_late") == ["c"]


def test_take_back_and_readers_of_an_earlier_version(spark):
    since = loaded(spark, "v_back")
    reader = spark.table("v_back")
    landing.replace_window(days(spark, ((2025, 5, 1), "may")), "v_back", "day", since)
    assert held(spark, "v_back") == ["early", "jan", "may", "undated"]
    assert sorted(r["v"] for r in reader.collect()) == ["april", "early", "gone", "jan", "undated"]
    assert sorted(r["v"] for r in versions.read(spark, "v_back", number=1).collect()) == ["april", "early", "gone", "jan", "undated"]
    versions.take_back(spark, "v_back")
    assert held(spark, "v_back") == ["april", "early", "gone", "jan", "undated"]


def test_forget_keeps_what_counts(spark):
    table, since = "v_forget", loaded(spark, "v_forget")
    for n in range(4):
        landing.replace_window(days(spark, ((2025, 3, 11), f"n{n}")), table, "day", since)
    base = pathlib.Path(versions.root(spark, table).removeprefix("file:"))
    under_way = base / f"{versions.PERIOD}=202506" / f"{versions.RUN}=another"
    under_way.mkdir(parents=True)
    assert versions.forget(spark, table) == 4  # March of the first three versions, April of the first
    assert versions.numbers(spark, table) == [4, 5] and under_way.exists()
    assert held(spark, table) == ["early", "jan", "n3", "undated"]
    assert sorted(r["v"] for r in versions.read(spark, table, number=4).collect()) == ["early", "jan", "n2", "undated"]
    assert versions.changed(spark, table, 1) == {0, 202501, 202503}  # not kept: all


def test_writes_that_do_not_fit(spark):
    since = loaded(spark, "v_fit")
    with pytest.raises(versions.OtherColumns):
        landing.replace_window(days(spark, APRIL).withColumn("w", F.lit(1)), "v_fit", "day", since)
    with pytest.raises(versions.OtherPeriods, match="202501"):
        versions.write(days(spark, JANUARY), "v_fit", versions.month_code("day"), {202503}.__contains__)
    now = versions.load(spark, "v_fit")
    with pytest.raises(versions.Overtaken):
        versions._publish(spark, "v_fit", now)
    with pytest.raises(LookupError):
        versions.take_back(spark, "v_fit")
    with pytest.raises(LookupError):
        versions.read(spark, "no_such_table")
    versions.write(days(spark), "v_fit", versions.month_code("day"))
    assert held(spark, "v_fit") == [] and spark.table("v_fit").columns == ["day", "v"]


def test_reads_only_the_folders_asked_for(spark):
    loaded(spark, "v_pruned")
    plan = versions.read(spark, "v_pruned", {202501})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_run" in plan and "Filter (" not in plan
    assert [r["v"] for r in versions.read(spark, "v_pruned", {202501}).collect()] == ["jan"]
    assert len(spark.table("v_pruned").inputFiles()) == len(files(spark, "v_pruned"))


# --- builds -----------------------------------------------------------------------------------------

# How the dated feeds of the site group write a row's date.
DAYS = {"proc_date": "iso", "pay_date": "iso", "work_date": "iso", "entry_date": "slash_or_iso", "period": "period", "month": "iso",
        "procedure_date": "iso_prefix", "transaction_date": "iso_prefix"}


def landed(spark, tmp_path):
    from sitewell.functions import exprs
    exports, folder = site_group.write(tmp_path)
    raw, maps = landing.land_csv(spark, exports), seeds.load_seeds(spark, folder)
    wanted = {"pms_open_dental__procedures", "pms_open_dental__payments", "pms_open_dental__providers", "pms_dentrix_ascend__procedures",
              "pms_dentrix_ascend__payments", "pms_dentrix_ascend__providers", "ukg__timecards", "sage_intacct__gl_detail",
              "inventory__usage", "marketing__channel_performance"}
    day = {f: next((c for c in df.columns if c in DAYS), None) for f, df in raw.items() if f in wanted}
    days_of = {f: exprs.parse_date(c, DAYS[c]) for f, c in day.items() if c}
    return {f: raw[f] for f in wanted}, maps, days_of


@pytest.fixture(scope="module")
def warehouses(spark, tmp_path_factory):
    """A full load and refresh, then a load of April and its refresh, then one without news."""
    raw, maps, day = landed(spark, tmp_path_factory.mktemp("incremental"))
    spark.sql("CREATE DATABASE IF NOT EXISTS monthly")
    names = {f: f"monthly.{f}" for f in day}
    snapshots = {f: df for f, df in raw.items() if f not in day}
    april = dt.date(2025, 4, 1)
    for feed, at in day.items():  # what April will bring is not there yet
        landing.replace_window(raw[feed].where((at < F.lit(april)) | (at >= F.lit(dt.date(2025, 5, 1)))), names[feed], at, dt.date(2020, 1, 1))
    refreshed = [incremental.refresh_warehouse(spark, names, maps, snapshots)]
    tables = [s.table for s in incremental.warehouse_steps(names, maps, snapshots)]
    before = {t: files(spark, t) for t in tables}
    for feed, at in day.items():
        landing.replace_window(raw[feed].where(at >= F.lit(april)), names[feed], at, april)
    refreshed.append(incremental.refresh_warehouse(spark, names, maps, snapshots))
    after = {t: files(spark, t) for t in tables}
    refreshed.append(incremental.refresh_warehouse(spark, names, maps, snapshots))
    return raw, maps, names, snapshots, refreshed, before, after


def test_touched_months_are_carried_through_all_layers(warehouses):
    _, _, _, _, (first, second, third), before, after = warehouses
    assert all(202503 in months for t, months in first.items() if "marketing" not in t)
    june = 202506  # later months of the window are written again, April comes new
    for table, months in second.items():
        edge = {202503, 202505} if table.endswith("weekly") else set()
        assert months <= {202404, 202504, june} | edge | {m for m in months if m >= 202504}, table
        untouched = [p for p in before[table] if not any(f"={m}/" in p for m in months)]
        assert all(after[table][p] == before[table][p] for p in untouched), table
        if not table.endswith("weekly"):
            assert 202503 not in months, table
    assert "staging.stg_pms_procedures" in second and 202504 in second["staging.stg_pms_procedures"]
    assert not any(third.values())


def test_refreshed_equals_a_full_build(spark, warehouses):
    raw, maps, names, *_ = warehouses
    staged = warehouse.stage(raw, maps)
    full = {**{f"staging.{n}": staged[n] for n in staged}, **{f"marts.{n}": df for n, df in warehouse.build_marts(staged, maps).items()}}
    compared = 0
    for table, df in full.items():
        assert rows(spark.table(table)) == rows(df), table
        compared += df.count()
    assert compared > 40
    assert rows(incremental.unmapped(spark)) == rows(warehouse.find_problems(raw, maps))


def test_new_mappings_rebuild_everything(spark, warehouses):
    raw, maps, names, snapshots, *_ = warehouses
    fewer = {**{n: maps[n] for n in maps}, "cdt_procedure_map": maps["cdt_procedure_map"].where("cdt_code <> 'D1'")}
    again = incremental.refresh_warehouse(spark, names, fewer, snapshots)
    assert 202503 in again["staging.stg_pms_procedures"]
    assert "D1" in {r["value"] for r in incremental.unmapped(spark).where("kind = 'cdt_code'").collect()}


def test_weeks_reach_across_months():
    assert incremental.months_of_weeks({202501, 202503}) == {202412, 202501, 202502, 202503}
    assert incremental.months_in_weeks({202412}) == {202412, 202501}
    assert incremental.shifted(202501, -1) == 202412 and incremental.shifted(202412, 1) == 202501


def test_rows_outside_their_month_fail(spark):
    """A raw table filed by another date than staging uses must not lose rows silently."""
    df = days(spark, JANUARY, MARCH)
    versions.write(df, "misfiled", F.lit(202501))
    step = incremental.Step("misfiled_out", ("misfiled",), lambda f: f["misfiled"].select("day", "v"), lambda: versions.month_code("day"))
    incremental.refresh(spark, [step])
    versions.write(df.union(df), "misfiled", F.lit(202501))
    with pytest.raises(versions.OtherPeriods):
        incremental.refresh(spark, [step])


def test_findings_by_month_add_up(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "month int, code string")
    kinds = [("k", "code", F.col("code") == "a")]
    assert rows(checks.unmapped_codes(df, kinds, ["month"])) == [{"month": m, "kind": "k", "value": "a", "row_count": 1} for m in (1, 2)]
