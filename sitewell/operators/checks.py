"""Data checks. Each returns a DataFrame of findings, empty when the data is sound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.operators import conform, staging


class CheckFailed(RuntimeError):
    """A check found rows it must not find."""


def unmapped_codes(df: DataFrame, kinds: list[tuple[str, str, Column]], by: list[str] | None = None) -> DataFrame:
    """(kind, value, row_count) of the values whose translation fell back to its default, by further
    columns if given. ``kinds`` lists (kind, value column, fell back); all are counted in one pass over ``df``."""
    by = by or []
    found = F.array(*[F.when(marker, F.struct(F.lit(kind).alias("kind"), F.col(value).cast("string").alias("value")))
                      for kind, value, marker in kinds])
    return df.where(reduce(Column.__or__, [F.coalesce(marker, F.lit(False)) for _, _, marker in kinds])) \
        .select(*by, F.explode(F.array_compact(found)).alias("_f")).groupBy(*by, "_f.kind", "_f.value") \
        .agg(F.count(F.lit(1)).alias("row_count"))


def code_kinds(subject: str, strict: bool = False) -> list[tuple[str, str, Column]]:
    """What a subject's mapping tables may not recognize: (kind, value column, fell back). ``strict`` adds
    two kinds that otherwise pass unseen: status words and earning codes nobody mapped."""
    return {
        "procedures": [("cdt_code", "cdt_code", F.col("procedure_category") == conform.UNMAPPED_CODE),
                       *([("status", "pms_system", F.col("status").isNull())] if strict else [])],
        "labor": [("ukg_job", "job_code", F.col("role") == staging.UNMAPPED_JOB),
                  *([("ukg_earning", "earning_code", F.col("is_productive").isNull())] if strict else [])],
        "ledger": [("gl_account", "account_no", F.col("category") == staging.UNMAPPED_ACCOUNT)],
        "inventory": [("inventory_item", "item_number", F.col("category") == staging.UNMAPPED_ITEM)],
        "marketing": [("utm_campaign", "campaign", F.col("channel") == staging.OTHER_CHANNEL)],
    }[subject]


def site_findings(unknown: DataFrame) -> DataFrame:
    """Counted sites of no mapping as findings; a missing site has no text in any system, so all of
    them count as one value."""
    return unknown.groupBy(F.lit("location").alias("kind"),
                           F.concat("source_system", F.lit(" / "), "source_location").alias("value")) \
        .agg(F.sum("row_count").alias("row_count"))


def found_in(kinds: list[tuple[str, str, Column]]) -> Column:
    """What a staged row with ``unmapped_site`` shows: (kind, value) of its site, or of its codes if the site
    is known. Most rows show nothing."""
    site = F.when(F.col(staging.UNMAPPED_SITE).isNotNull(), F.struct(
        F.lit("location").alias("kind"), F.col(f"{staging.UNMAPPED_SITE}.value").alias("value")))
    codes = [F.when(F.col(staging.UNMAPPED_SITE).isNull() & marker, F.struct(
        F.lit(kind).alias("kind"), F.col(value).cast("string").alias("value"))) for kind, value, marker in kinds]
    return F.array_compact(F.array(site, *codes))


def observed(staged: DataFrame, kinds: list[tuple[str, str, Column]], keys: list[str], sums: list[str]) -> DataFrame:
    """One pass over a subject staged with its unknown sites: totals by ``keys`` beside what the rows show.
    As many rows as keys have values, times the few things found there."""
    return staged.groupBy(*keys, found_in(kinds).alias("found")).agg(
        F.count(F.lit(1)).alias("row_count"), *[F.sum(c).alias(c) for c in sums])


def findings(seen: list[DataFrame]) -> DataFrame:
    """(kind, value, row_count) of subjects observed; a missing site has no text in any system, so all of
    them count as one value."""
    told = [df.where(F.size("found") > 0).select(F.explode("found").alias("_f"), "row_count").groupBy("_f.kind", "_f.value")
            .agg(F.sum("row_count").alias("row_count")) for df in seen]
    return reduce(DataFrame.unionByName, told).groupBy("kind", "value").agg(F.sum("row_count").alias("row_count"))


def without_unknown(seen: DataFrame) -> DataFrame:
    """Observed totals of known sites, as staged rows would give them."""
    return seen.where(~F.exists("found", lambda f: f["kind"] == "location"))


# Feeds beside the practice systems, and the system and column that name the site.
BUSINESS_SITES = {"ukg__timecards": ("ukg", "org_level1"), "sage_intacct__gl_detail": ("sage_intacct", "locationid"),
                  "inventory__usage": ("inventory", "site_code"),
                  "marketing__channel_performance": ("marketing", "site_slug"),
                  "windsor__facebook_ads": ("windsor_facebook", "account_id")}


def doubled_ads(performance: DataFrame, daily_ads: DataFrame) -> DataFrame:
    """Site-months in which both ad feeds carry Meta spend, which would then count twice.
    Both arguments are staged marketing rows, of one feed each."""
    def meta(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("channel") == "Meta").groupBy("location_key", "month") \
            .agg(F.sum("spend").alias(name))

    return meta(performance, "feed_spend").join(meta(daily_ads, "daily_spend"), ["location_key", "month"]) \
        .where((F.col("feed_spend") != 0) & (F.col("daily_spend") != 0))


def without_visits(costs: DataFrame, visits: DataFrame) -> DataFrame:
    """Site-months that have expenses but no visits, which the scorecard therefore leaves out."""
    keys = ["location_key", "month"]
    spent = costs.groupBy(*keys).agg(F.sum("amount").alias("amount"))
    return spent.join(visits.select(*keys).distinct(), keys, "left_anti")


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column that holds nulls; all columns are counted in a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_rows").where("null_rows > 0")


def watched(df: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """A frame to be written, and what its write will have counted: rows, and for each column its nulls and
    bounds. Nothing is read again for it. The counts are taken in the tasks that write, each of which counts
    once, also when it is repeated; so no step that shuffles may follow."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("row_count"), *[m for c in columns for m in (
        F.count_if(F.col(c).isNull()).alias(f"null_rows:{c}"), F.min(F.col(c).cast("string")).alias(f"lowest:{c}"),
        F.max(F.col(c).cast("string")).alias(f"highest:{c}"))]), seen


def counted(table: str, columns: list[str], seen: Observation) -> list[tuple]:
    """(table, column, row_count, null_rows, lowest, highest) of a write that has ended; bounds are of texts."""
    got = seen.get  # nothing is counted where the optimizer knows that there are no rows
    return [(table, c, got.get("row_count", 0), got.get(f"null_rows:{c}", 0), got.get(f"lowest:{c}"), got.get(f"highest:{c}"))
            for c in columns]


WRITE_COUNTS = "table_name string, column_name string, row_count long, null_rows long, lowest string, highest string"


def nulls_written(counts: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """What :func:`nulls` finds in a table, from the counts of its write. A column nobody counted is a finding
    without a number."""
    asked = counts.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    here = counts.where(F.col("table_name") == table).select("column_name", "null_rows")
    return asked.join(here, "column_name", "left").where("null_rows IS NULL OR null_rows > 0")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def beyond_tolerance(recon: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Categories whose summed variance exceeds the tolerance as a share of the operational total."""
    return variance_by_category(recon).where(F.abs("variance_pct") > tolerance)


def variance_by_category(recon: DataFrame) -> DataFrame:
    total = recon.groupBy("category").agg(F.sum("variance").alias("variance"),
                                          F.sum("ops_amount").alias("ops_amount"))
    return total.select("category", exprs.ratio("variance", "ops_amount").alias("variance_pct"))


def missing_sides(recon_full: DataFrame) -> DataFrame:
    """Per category, how many site-months have only one of the two sides."""
    return recon_full.groupBy("category").agg(
        F.count_if(F.col("gl_amount").isNull()).alias("without_ledger"),
        F.count_if(F.col("ops_source").isNull()).alias("without_operations"))


def strangers(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """(key, row_count) of the values of ``key`` that ``known`` does not have, counted before the join."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).join(known.select(key).distinct(), key, "left_anti")


def expect_empty(findings: DataFrame, name: str, sample: int = 5) -> None:
    """Fail with a few example rows if a check found anything. The sample only illustrates the
    message; the count is of all findings."""
    shown = findings.take(sample)
    if shown:
        raise CheckFailed(f"{name}: {findings.count()} finding(s), such as {[r.asDict() for r in shown]}")


def summary(unmapped: DataFrame, recon: DataFrame) -> DataFrame:
    """What a build reports: number of unmapped values, and variance percent by category."""
    kinds = unmapped.groupBy("kind").agg(F.count(F.lit(1)).cast("double").alias("value")) \
        .select(F.lit("unmapped values").alias("item"), F.col("kind").alias("name"), "value")
    shares = variance_by_category(recon).select(
        F.lit("variance percent").alias("item"), F.col("category").alias("name"),
        F.round(F.col("variance_pct") * 100, 2).alias("value"))
    return kinds.unionByName(shares)
