"""Reports on the marts: statement, period comparison, ratios, alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewell.functions import exprs

PROFIT_LINES = ("Collections", "Refunds")


def profit_and_loss(opex: DataFrame, payments: DataFrame, ledger: DataFrame, locations: DataFrame) -> DataFrame:
    """Statement lines by month for each site, each region and the whole group.

    Revenue is collections less refunds (account 4900), expenses are the opex categories. Amounts
    are brought to (site, month, line) before the rollup triples them.
    """
    keys = ["location_key", "month"]
    income = payments.groupBy(*keys).agg(F.sum("amount").alias("amount")).withColumn("line", F.lit("Collections"))
    refunds = ledger.where(F.col("account_no") == "4900").groupBy(*keys) \
        .agg(F.sum("amount").alias("amount")).withColumn("line", F.lit("Refunds"))
    costs = opex.groupBy(*keys, F.col("category").alias("line")).agg(F.sum("amount").alias("amount"))
    lines = reduce(DataFrame.unionByName, [income, refunds, costs])
    located = lines.join(locations.select("location_key", "region"), "location_key")
    columns = ("month", "line", "region", "location_key")
    levels = [columns, columns[:3], columns[:2]]
    return located.groupingSets(levels, *columns).agg(
        exprs.words_to(F.grouping_id().cast("string"), {"0": "site", "1": "region", "3": "group"}).alias("level"),
        F.sum("amount").alias("amount"))


def profit_margin(statement: DataFrame) -> DataFrame:
    """Revenue, expenses, profit and margin of each statement level and month."""
    revenue = F.col("line").isin(list(PROFIT_LINES))
    level = statement.groupBy("month", "level", "region", "location_key").agg(
        exprs.sum_if(revenue, "amount").alias("revenue"), exprs.sum_if(~revenue, "amount").alias("expenses"))
    profit = F.col("revenue") - F.col("expenses")
    return level.select("*", profit.alias("profit"), exprs.ratio(profit, "revenue").alias("margin"))


def compare(df: DataFrame, keys: list[str], period: str, measures: list[str],
            back: dict[str, Column]) -> DataFrame:
    """Each row next to the same site's earlier rows.

    ``back`` maps a suffix to the period shifted forward, e.g. {"_prev": add_months(month, 1)}.
    Each row is copied onto the periods it is compared from, in one pass, and meets the current row
    there in one aggregate: a gap in the calendar compares with nothing rather than with the row
    before it.
    """
    def copy(at: Column, suffix: str) -> Column:
        return F.struct(at.alias(period), F.lit(suffix).alias("_as"))

    copies = F.array(copy(F.col(period), ""), *[copy(moved, suffix) for suffix, moved in back.items()])
    spread = df.select(*keys, *measures, F.inline(copies))
    suffixes = ["", *back]
    met = spread.groupBy(*keys, period).agg(
        F.max(F.col("_as") == "").alias("_now"),
        *[F.sum(F.when(F.col("_as") == s, F.col(m))).alias(m + s) for s in suffixes for m in measures])
    changes = [exprs.ratio(F.col(m) - F.col(m + s), m + s).alias(f"{m}{s}_change") for s in back for m in measures]
    return met.where("_now").select(*keys, period, *[m + s for s in suffixes for m in measures], *changes)


def compare_months(scorecard: DataFrame, measures: list[str]) -> DataFrame:
    return compare(scorecard, ["location_key"], "month", measures,
                   {"_prev": F.add_months("month", 1), "_year": F.add_months("month", 12)})


def compare_weeks(weekly: DataFrame, measures: list[str]) -> DataFrame:
    return compare(weekly, ["location_key"], "week", measures,
                   {"_prev": F.date_add("week", 7), "_year": F.date_add("week", 7 * 52)})


RATIOS = {
    "collection_rate": ("collections", "net_production"),
    "no_show_rate": ("no_shows", "scheduled"),
    "labor_share": ("labor_cost", "collections"),
    "supply_share": ("supply_cost", "collections"),
    "cost_per_booked_visit": ("marketing_spend", "booked_from_marketing"),
}


def site_ratios(scorecard: DataFrame) -> DataFrame:
    return scorecard.select("location_key", "month", *[exprs.ratio(top, bottom).alias(name)
                                                       for name, (top, bottom) in RATIOS.items()])


def alerts(ratios: DataFrame, deviations: float = 2.0, limits: dict[str, float] | None = None,
           floors: dict[str, float] | None = None) -> DataFrame:
    """Site-months whose ratio lies ``deviations`` standard deviations from the month's mean over
    all sites, above a fixed limit or below a fixed floor given per ratio.

    The mean and deviation of a month come from an aggregate that is joined back, not from a window
    over the month, so no task holds all sites of a month.
    """
    names = list(RATIOS)
    long = ratios.unpivot(["location_key", "month"], names, "metric", "value").where(F.col("value").isNotNull())
    norm = long.groupBy("month", "metric").agg(F.avg("value").alias("mean"), F.stddev("value").alias("deviation"))
    def fixed(values: dict[str, float] | None) -> Column:
        return exprs.per_system("metric", {m: F.lit(float(v)) for m, v in values.items()}) if values \
            else F.lit(None).cast("double")

    score = exprs.ratio(F.col("value") - F.col("mean"), "deviation")
    scored = long.join(norm, ["month", "metric"]).select(
        "location_key", "month", "metric", "value", "mean", score.alias("score"), fixed(limits).alias("limit"),
        fixed(floors).alias("floor"))
    return scored.where((F.abs("score") > deviations) | (F.col("value") > F.col("limit")) | (F.col("value") < F.col("floor")))
