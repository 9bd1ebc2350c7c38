"""Rebuilding only the months that a load touched.

Raw tables, staging and marts are kept in versions of month folders. Every version remembers which versions it
was built from, so what has to be rebuilt follows from the folders that differ between those and today's: no
list of months is handed from load to build, and a build that was missed or failed is made up by the next one.
Each table is a step: which tables it reads, how its rows follow from theirs, and how far a month of theirs
bears on months of its own. Only weeks reach across a month's edge.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.operators import checks, conform, marts, staging
from sitewell.operators.translate import CROSSWALK_KEY
from sitewell.plans.warehouse import DAILY_ADS, stage
from sitewell.sources import versions

Periods = set[int]


@dataclass(frozen=True)
class Step:
    """One table. ``make`` gets the tables it reads by name, restricted to the periods it needs."""

    table: str
    reads: tuple[str, ...]
    make: Callable[[Mapping[str, DataFrame]], DataFrame]
    period: Callable[[], Column] = lambda: versions.month_code("month")
    reach: Callable[[Periods], Periods] = set  # own periods that periods of the inputs bear on
    needs: Callable[[Periods], Periods] = set  # periods of the inputs that own periods follow from


def shifted(period: int, months: int) -> int:
    at = period // 100 * 12 + period % 100 - 1 + months
    return at // 12 * 100 + at % 12 + 1


def months_of_weeks(periods: Periods) -> Periods:
    """Months of the Mondays of all weeks with a day in these months."""
    return periods | {shifted(p, -1) for p in periods if p != versions.UNDATED}


def months_in_weeks(periods: Periods) -> Periods:
    """Months with a day in a week whose Monday lies in these months."""
    return periods | {shifted(p, 1) for p in periods if p != versions.UNDATED}


def digest(tables: Mapping[str, DataFrame]) -> str:
    """Of the rows of small tables, in any order; another digest means that everything follows anew."""
    parts = []
    for name, df in sorted(tables.items()):
        row = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns], *[F.col(f"`{c}`").isNull() for c in df.columns])
        got = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"),
                     F.sum(F.pmod(row, F.lit(1 << 40))).alias("s")).first()
        parts.append(f"{name}:{got['n']}:{got['x']}:{got['s']}")
    return " ".join(parts)


def refresh(spark: SparkSession, steps: list[Step], constants: str = "") -> dict[str, Periods]:
    """Bring every step's table up to date, in order, and say which periods each rewrote."""
    out: dict[str, Periods] = {}
    for step in steps:
        now = {t: versions.load(spark, t) for t in step.reads}
        sources = {t: str(v.number) for t, v in now.items()} | {"constants": constants}
        before = versions.load(spark, step.table)
        known = before is not None and before.sources.get("constants") == constants and before.sources.keys() == sources.keys()
        if not known:
            every = set().union(*(v.folders for v in now.values()))
            frames = {t: versions.read(spark, t, with_period=True) for t in step.reads}
            written = versions.write(step.make(frames), step.table, step.period(), sources=sources)
            out[step.table] = step.reach(every) | written.folders.keys() | (before.folders.keys() if before else set())
            continue
        touched = set().union(*(versions.changed(spark, t, int(before.sources[t])) for t in step.reads))
        mine = step.reach(touched)
        if mine:
            needed = step.needs(mine)
            frames = {t: versions.read(spark, t, needed, with_period=True) for t in step.reads}
            made = step.make(frames)
            if needed != mine:  # rows of periods that were read for their neighbours only
                made = made.where(step.period().isin(sorted(mine)))
            versions.write(made, step.table, step.period(), mine.__contains__, sources)
        out[step.table] = mine
    return out


def _feeds(raw: Mapping[str, str], subject: str) -> list[str]:
    """Landed feeds of one subject of the practice systems."""
    file = {"lines": "procedures", "payments": "payments"}[subject]
    return [f for s in conform.SYSTEMS.values() if (f := f"{s.folder}__{file}") in raw]


def _sites(raw: Mapping[str, DataFrame], crosswalk: DataFrame) -> DataFrame:
    """(source_system, source_location, period, row_count) of sites the crosswalk does not know, by feed and month."""
    named = {f"{s.folder}__procedures": (name, s.lines[0]) for name, s in conform.SYSTEMS.items()} | checks.BUSINESS_SITES
    per = [raw[feed].groupBy(F.lit(system).alias("source_system"), F.col(site).alias("source_location"), versions.PERIOD)
           .agg(F.count(F.lit(1)).alias("row_count")) for feed, (system, site) in named.items() if feed in raw]
    return marts.union_all(per).join(crosswalk.select(*CROSSWALK_KEY), list(CROSSWALK_KEY), "left_anti").select(
        *CROSSWALK_KEY, F.col(versions.PERIOD).alias("period"), "row_count")


def warehouse_steps(raw: Mapping[str, str], seeds: Mapping[str, DataFrame], snapshots: Mapping[str, DataFrame],
                    strict: bool = False) -> list[Step]:
    """Staging, marts and findings of a warehouse. ``raw`` names the versioned table of each dated feed;
    ``snapshots`` are feeds without a date, such as providers, whole."""
    def staged(name: str, feeds: list[str], period: str = "month") -> Step:
        def make(frames: Mapping[str, DataFrame]) -> DataFrame:
            here = {f: frames[raw[f]].drop(versions.PERIOD) for f in feeds}
            return stage({**snapshots, **here}, seeds)[name]

        return Step(f"staging.{name}", tuple(raw[f] for f in feeds), make, lambda: versions.month_code(period))

    def mart(name: str, reads: list[str], make: Callable[..., DataFrame], **more) -> Step:
        tables = tuple(f"staging.stg_{r}" if "." not in r else r for r in reads)
        return Step(f"marts.{name}", tables, lambda frames: make(*[frames[t].drop(versions.PERIOD) for t in tables]), **more)

    dated = [f for f in ("marketing__channel_performance", DAILY_ADS) if f in raw]
    lines, paid = _feeds(raw, "lines"), _feeds(raw, "payments")
    visits, costs = "pms_appointments", ["sage_gl", "ukg_labor", "inventory", "marketing"]
    accounts, places, crosswalk = seeds["gl_account_map"], seeds["dim_location"], seeds["location_crosswalk"]
    week = dict(period=lambda: versions.month_code("week"), reach=months_of_weeks, needs=months_in_weeks)
    by_month = lambda df, kinds: checks.unmapped_codes(df, kinds, ["month"])
    found = [checks.code_kinds(s, strict) for s in ("procedures", "labor", "ledger", "inventory", "marketing")]
    sources = [*lines, *[f for f in checks.BUSINESS_SITES if f in raw]]
    return [
        staged("stg_pms_procedures", lines),
        Step("staging.stg_pms_appointments", ("staging.stg_pms_procedures",),
             lambda frames: staging.appointments(frames["staging.stg_pms_procedures"])),
        staged("stg_pms_payments", paid), staged("stg_ukg_labor", ["ukg__timecards"]),
        staged("stg_sage_gl", ["sage_intacct__gl_detail"]), staged("stg_inventory", ["inventory__usage"]),
        staged("stg_marketing", dated),
        mart("mart_opex_monthly", costs, lambda *feeds: marts.opex_monthly(*feeds, accounts)),
        mart("mart_location_monthly", [visits, "pms_payments", "ukg_labor", "sage_gl", "inventory", "marketing"],
             lambda *feeds: marts.location_monthly(*feeds, accounts, places)),
        mart("mart_location_weekly", [visits, "pms_payments", "ukg_labor"], marts.location_weekly, **week),
        mart("mart_procedure_mix", ["pms_procedures"], marts.procedure_mix),
        mart("mart_marketing_channel_monthly", ["marketing"], marts.marketing_channel_monthly),
        mart("mart_reconciliation", ["pms_payments", "ukg_labor", "inventory", "marketing", "sage_gl"], marts.reconciliation),
        mart("mart_operations_monthly", ["marts.mart_opex_monthly", "pms_payments"],
             lambda opex, payments: marts.operations_monthly(opex, payments, places)),
        mart("unmapped_codes", ["pms_procedures", "ukg_labor", "sage_gl", "inventory", "marketing"],
             lambda *feeds: marts.union_all([by_month(df, kinds) for df, kinds in zip(feeds, found)])),
        Step("marts.unmapped_sites", tuple(raw[f] for f in sources),
             lambda frames: _sites({f: frames[raw[f]] for f in sources}, crosswalk), lambda: F.col("period")),
    ]


def refresh_warehouse(spark: SparkSession, raw: Mapping[str, str], seeds: Mapping[str, DataFrame],
                      snapshots: Mapping[str, DataFrame] | None = None, strict: bool = False) -> dict[str, Periods]:
    """Bring a warehouse up to date after loads into its raw tables. New mapping tables or snapshots rebuild
    every month, as any row may follow from them."""
    for database in ("staging", "marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    held = {**seeds, **(snapshots or {})}
    return refresh(spark, warehouse_steps(raw, seeds, snapshots or {}, strict), f"strict={strict} {digest(held)}")


def unmapped(spark: SparkSession) -> DataFrame:
    """All findings of a refreshed warehouse, as checks.dq_unmapped gives them."""
    sites = spark.table("marts.unmapped_sites").groupBy(*CROSSWALK_KEY).agg(F.sum("row_count").alias("row_count"))
    codes = spark.table("marts.unmapped_codes").groupBy("kind", "value").agg(F.sum("row_count").alias("row_count"))
    return checks.site_findings(sites).unionByName(codes)
