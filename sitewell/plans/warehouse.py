"""The whole build: raw tables and mapping tables in, staging, marts, checks and documents out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.operators import checks, conform, marts, publish, staging
from sitewell.operators.translate import rejected_rows
from sitewell.plans.frames import Frames
from sitewell.sources.landing import replace_snapshot

DAILY_ADS = "windsor__facebook_ads"


def stage(raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> Frames:
    """Staging frames by name, lazily, from raw tables as landed."""
    return stage_gathered(gathered(raw), raw, seeds)


def stage_gathered(practice: Mapping[str, DataFrame], raw: Mapping[str, DataFrame],
                   seeds: Mapping[str, DataFrame]) -> Frames:
    """The same from practice feeds that already share one table per subject: lines, providers and
    payments."""
    def site(): return seeds["location_crosswalk"]

    staged = Frames({
        "stg_pms_procedures": lambda: staging.procedures(practice["lines"], practice["providers"], site(),
                                                         seeds["cdt_procedure_map"]),
        "stg_pms_appointments": lambda: staging.appointments(staged["stg_pms_procedures"]),
        "stg_pms_payments": lambda: staging.payments(practice["payments"], site()),
        "stg_ukg_labor": lambda: staging.labor(raw["ukg__timecards"], site(), seeds["ukg_job_map"],
                                               seeds["ukg_earning_map"]),
        "stg_sage_gl": lambda: staging.ledger(raw["sage_intacct__gl_detail"], site(), seeds["gl_account_map"]),
        "stg_inventory": lambda: staging.inventory(raw["inventory__usage"], site(), seeds["inventory_category_map"]),
        "stg_marketing": lambda: staging.marketing(raw["marketing__channel_performance"], site(),
                                                   seeds["marketing_channel_map"], raw.get(DAILY_ADS)),
    })
    return staged


def build_marts(staged: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> Frames:
    """Marts by name, lazily."""
    def subjects(*names: str) -> list[DataFrame]:
        return [staged[f"stg_{n}"] for n in names]

    built = Frames({
        "mart_opex_monthly": lambda: marts.opex_monthly(
            *subjects("sage_gl", "ukg_labor", "inventory", "marketing"), seeds["gl_account_map"]),
        "mart_location_monthly": lambda: marts.location_monthly(
            *subjects("pms_appointments", "pms_payments", "ukg_labor", "sage_gl", "inventory", "marketing"),
            seeds["gl_account_map"], seeds["dim_location"]),
        "mart_location_weekly": lambda: marts.location_weekly(
            *subjects("pms_appointments", "pms_payments", "ukg_labor")),
        "mart_procedure_mix": lambda: marts.procedure_mix(*subjects("pms_procedures")),
        "mart_marketing_channel_monthly": lambda: marts.marketing_channel_monthly(*subjects("marketing")),
        "mart_reconciliation": lambda: marts.reconciliation(
            *subjects("pms_payments", "ukg_labor", "inventory", "marketing", "sage_gl")),
        "mart_operations_monthly": lambda: marts.operations_monthly(
            built["mart_opex_monthly"], *subjects("pms_payments"), seeds["dim_location"]),
    })
    return built


def observe(practice: Mapping[str, DataFrame], raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame],
            strict: bool = False) -> Frames:
    """Totals and findings by subject, each from one pass over its feed; lazily."""
    site = seeds["location_crosswalk"]

    def seen(subject: str, staged: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
        return checks.observed(staged, checks.code_kinds(subject, strict), keys, sums)

    return Frames({
        "procedures": lambda: seen("procedures", staging.procedures(
            practice["lines"], practice["providers"], site, seeds["cdt_procedure_map"], unknown=True), [], []),
        "labor": lambda: seen("labor", staging.labor(
            raw["ukg__timecards"], site, seeds["ukg_job_map"], seeds["ukg_earning_map"], unknown=True),
            list(marts.MONTH_KEYS), ["labor_cost"]),
        "ledger": lambda: seen("ledger", staging.ledger(
            raw["sage_intacct__gl_detail"], site, seeds["gl_account_map"], unknown=True),
            [*marts.MONTH_KEYS, "mart_source"], ["amount"]),
        "inventory": lambda: seen("inventory", staging.inventory(
            raw["inventory__usage"], site, seeds["inventory_category_map"], unknown=True), list(marts.MONTH_KEYS), ["supply_cost"]),
        "marketing": lambda: seen("marketing", staging.marketing(
            raw["marketing__channel_performance"], site, seeds["marketing_channel_map"], raw.get(DAILY_ADS), unknown=True),
            list(marts.MONTH_KEYS), ["spend"]),
    })


def gathered(raw: Mapping[str, DataFrame]) -> Frames:
    """The practice feeds of all systems, a table per subject."""
    return Frames({s: lambda s=s: conform.gather(raw, s) for s in ("lines", "providers", "payments")})


def find_problems(raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame], strict: bool = False,
                  practice: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Everything a mapping table does not recognize, (kind, value, row_count), from one pass over each feed."""
    seen = observe(practice or gathered(raw), raw, seeds, strict)
    return checks.findings([seen[s] for s in seen])


def build_report(practice: Mapping[str, DataFrame], raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> DataFrame:
    """The build summary from the feeds alone: findings and reconciliation out of the same passes."""
    lazily = observe(practice, raw, seeds)
    seen = {s: publish.settled(lazily[s]) for s in lazily}  # of mart size
    known = {s: checks.without_unknown(df) for s, df in seen.items()}
    recon = marts.reconciliation(staging.payments(practice["payments"], seeds["location_crosswalk"]), known["labor"],
                                 known["inventory"], known["marketing"], known["ledger"])
    return checks.summary(checks.findings(list(seen.values())), recon)


def rejects(raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> DataFrame:
    """Procedure lines, still as delivered, of sites the crosswalk does not know."""
    return rejected_rows(conform.gather(raw, "lines"), seeds["location_crosswalk"])


# The tables of rejected rows of the feeds beside the practice systems.
REJECT_TABLES = {"ukg__timecards": "rejects_timecards", "sage_intacct__gl_detail": "rejects_ledger",
                 "inventory__usage": "rejects_inventory", "marketing__channel_performance": "rejects_marketing",
                 DAILY_ADS: "rejects_daily_ads"}


def business_rejects(raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> Frames:
    """Rows of every other feed, as delivered, whose site the crosswalk does not know; lazily, by table."""
    def of(feed: str) -> DataFrame:
        system, site = checks.BUSINESS_SITES[feed]
        known = seeds["location_crosswalk"].where(F.col("source_system") == system).select(F.col("source_location").alias("_site"))
        return raw[feed].join(known, F.col(site) == F.col("_site"), "left_anti")

    return Frames({name: lambda feed=feed: of(feed) for feed, name in REJECT_TABLES.items() if feed in raw})


def all_rejects(raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> Frames:
    """What staging leaves out, by table: rows in = rows staged + rows here, for each feed."""
    business = business_rejects(raw, seeds)
    return Frames({
        "rejects_location": lambda: rejects(raw, seeds),
        "rejects_payments": lambda: rejected_rows(conform.gather(raw, "payments"), seeds["location_crosswalk"]),
        **{name: lambda name=name: business[name] for name in business}})


def findings(raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame], staged: Mapping[str, DataFrame],
             built: Mapping[str, DataFrame]) -> Frames:
    """What the checks of overlap and coverage find, by table."""
    def overlap() -> DataFrame:
        feed, site, channels = raw["marketing__channel_performance"], seeds["location_crosswalk"], seeds["marketing_channel_map"]
        return checks.doubled_ads(staging.marketing(feed, site, channels),
                                  staging.marketing(feed.where(F.lit(False)), site, channels, raw[DAILY_ADS]))

    both = lambda: marts.reconciliation(*[staged[f"stg_{n}"] for n in (
        "pms_payments", "ukg_labor", "inventory", "marketing", "sage_gl")], full=True)
    return Frames({
        **({"doubled_ads": overlap} if DAILY_ADS in raw else {}),
        "without_visits": lambda: checks.without_visits(built["mart_opex_monthly"], staged["stg_pms_appointments"]),
        "missing_sides": lambda: checks.missing_sides(both())})


# The columns whose nulls a build is tested for; they are counted while the marts are written.
NEVER_NULL = {"mart_location_monthly": ["location_key", "month", "collections"], "mart_operations_monthly": ["category"]}


def write_layer(frames: Frames, database: str, partition: str | None = "month",
                watch: Mapping[str, list[str]] | None = None, counts: list[tuple] | None = None) -> Frames:
    """Write frames as tables of one database and hand them back as those tables. Columns named in ``watch``
    are counted in the write itself, and what they show is added to ``counts``.

    Each frame is replaced by its table as soon as it is written, so a frame that builds on an
    earlier one reads the table instead of computing it again. Facts are partitioned by month: a
    report over a few months reads only those.
    """
    spark = frames[next(iter(frames))].sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in frames:
        df, table, columns = frames[name], f"{database}.{name}", (watch or {}).get(name, [])
        by = partition if partition in df.columns else None
        # rows of a month meet before the write, else every task opens a file in every month;
        # the rebalance splits a month that is larger than a file should be
        spread = df.hint("rebalance", by) if by else df
        seen = None
        if columns:
            spread, seen = checks.watched(spread, columns)
        replace_snapshot(spread, table, by)
        if seen and counts is not None:
            counts += checks.counted(name, columns, seen)
        frames.replace(name, spark.table(table))
    return frames


def build(spark: SparkSession, raw: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame],
          documents: str | None = None, strict: bool = False, land: bool = True) -> DataFrame:
    """Build the raw, staging and mart tables, check them, and write the documents.

    Each layer is written once because the next reads its frames several times, and reads them back
    pruned. With ``land=False`` the raw frames are tables already, such as those of landing.run.
    Returns the build summary.
    """
    if land:
        raw = write_layer(Frames({name: lambda df=df: df for name, df in raw.items()}), "raw", None)
    staged = write_layer(stage(raw, seeds), "staging")
    left_out = all_rejects(raw, seeds)
    found = write_layer(Frames({**{name: lambda name=name: left_out[name] for name in left_out},
                                "dq_unmapped": lambda: find_problems(raw, seeds, strict)}), "staging", None)
    counts: list[tuple] = []  # a row per watched column
    built = write_layer(build_marts(staged, seeds), "marts", None, NEVER_NULL, counts)
    written = Frames({"write_counts": lambda: spark.createDataFrame(counts, checks.WRITE_COUNTS)})
    write_layer(written, "staging", None)
    write_layer(findings(raw, seeds, staged, built), "staging", None)
    if documents:
        counts = publish.source_counts(publish.table_counts(raw), publish.source_group())
        facts = {**columnar_documents(staged, built), **row_documents(built)}
        small = {"locations": publish.site_rows(seeds["dim_location"]), "sources": counts,
                 "unmapped": found["dq_unmapped"].agg(F.count(F.lit(1)).alias("unmapped"))}
        for name, df in {**facts, **small}.items():
            publish.write_documents(df, f"{documents.rstrip('/')}/{name}")
    return checks.summary(found["dq_unmapped"], built["mart_reconciliation"])


def columnar_documents(staged: Mapping[str, DataFrame], built: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Compact documents by name: arrays per dataset, and the expense lines with their accounts."""
    weeks = publish.last_full_weeks(built["mart_location_weekly"], staged["stg_pms_procedures"])
    marts_of = {"monthly": built["mart_location_monthly"], "weekly": weeks,
                "channels": built["mart_marketing_channel_monthly"], "mix": built["mart_procedure_mix"],
                "recon": built["mart_reconciliation"]}
    entries, opex = publish.opex_documents(built["mart_opex_monthly"])
    accounts = entries.select("i", publish.entry_text(["account_no", "account_title", "category", "source"])
                              .alias("entry"))
    return {**{n: publish.dataset(n, df) for n, df in marts_of.items()}, "opex": opex, "accounts": accounts}


def row_documents(built: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The same marts one JSON object per row, amounts in cents, under names ending in _rows."""
    rows = {name: publish.as_rows(built[mart], drop) for name, mart, drop in (
        ("monthly", "mart_location_monthly", ["location_name", "region", "specialty", "pms_system"]),
        ("channels", "mart_marketing_channel_monthly", ["sessions"]), ("mix", "mart_procedure_mix", []),
        ("opex", "mart_opex_monthly", []), ("recon", "mart_reconciliation", ["variance", "variance_pct"]))}
    rows["mix"] = rows["mix"].select(F.col("location_key").alias("location"), "month",
                                     F.col("procedure_category").alias("cat"), F.col("gross_production").alias("prod"))
    return {f"{name}_rows": df for name, df in rows.items()}


def verify(built: Mapping[str, DataFrame], unmapped: DataFrame, tolerance: float = 0.01,
           found: Mapping[str, DataFrame] | None = None, counts: DataFrame | None = None) -> None:
    """The tests a build must pass before its numbers are trusted. ``found`` holds the tables of
    :func:`findings`: ad spend that both feeds carry, and sites with costs but no visits, fail a build;
    sides that reconciliation lacks are for reading. With ``counts``, the table staging.write_counts of the
    build, no mart is read for nulls. Keys are always grouped: a sketch would miss a single repeat."""
    for name in ("doubled_ads", "without_visits"):
        if found is not None and name in found:
            checks.expect_empty(found[name], name.replace("_", " "))
    checks.expect_empty(unmapped, "unmapped values")
    scorecard = built["mart_location_monthly"]
    for mart, columns in NEVER_NULL.items():
        bare = checks.nulls(built[mart], columns) if counts is None else checks.nulls_written(counts, mart, columns)
        checks.expect_empty(bare, f"nulls in {mart}")
    checks.expect_empty(checks.duplicates(scorecard, ["location_key", "month"]), "scorecard keys")
    checks.expect_empty(checks.beyond_tolerance(built["mart_reconciliation"], tolerance), "reconciliation")
