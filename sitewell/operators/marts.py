"""Marts: what the reports read.

Shape of every mart that brings subjects together: each staging frame is aggregated to the mart's
keys on its own (map-side combine keeps that shuffle at sites x months), the results are unioned
with nulls for the measures a subject does not have, and one more aggregate on the same keys lines
them up. Only rows of mart size reach that last step, branches that are already partitioned by its
keys do not move again, no subject is scanned twice, and a hot site or month never gathers its raw
rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.operators.staging import ADS_ACCOUNT, SUPPLIES_ACCOUNT
from sitewell.operators.translate import map_code

MONTH_KEYS = ("location_key", "month")
WEEK_KEYS = ("location_key", "week")

# Accounts and categories the scorecard reports on their own.
DOCTOR_CATEGORY = "Doctor Compensation"
LAB_ACCOUNT = "5200"
PAYROLL_BURDEN_ACCOUNTS = ["6040", "6050", "6060", "6070", "6080"]
FACILITY_CATEGORIES = ["Occupancy", "Utilities", "Facilities & Maintenance"]

# Names of the systems of record, and how a ledger account's owner (mart_source)
# reads as a reconciliation category.
SOURCE_LEDGER, SOURCE_PAYROLL = "Sage Intacct", "UKG"
SOURCE_SUPPLIES, SOURCE_ADS = "Inventory", "Marketing feed"
RECONCILED = {"pms": "Revenue", "ukg": "Staff Wages", "inventory": "Supplies", "marketing": "Marketing"}
OPERATIONAL_SOURCE = {"Revenue": "PMS payments", "Staff Wages": "UKG timecards",
                      "Supplies": "Inventory usage", "Marketing": "Marketing feed"}

SCORECARD_MEASURES = (
    "gross_production", "net_production", "collections", "insurance_collections", "completed_visits",
    "no_shows", "scheduled", "new_patients", "hygiene_production", "labor_cost", "overtime_cost",
    "labor_hours", "overtime_hours", "doctor_comp", "lab_fees", "payroll_taxes_benefits",
    "facility_costs", "total_opex", "supply_cost", "inventory_on_hand", "marketing_spend", "leads",
    "booked_from_marketing")
WEEKLY_MEASURES = (
    "gross_production", "net_production", "collections", "completed_visits", "no_shows", "scheduled",
    "new_patients", "labor_cost", "labor_hours", "overtime_hours")


def union_all(branches: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)


def align(branches: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    """Unioned branches to one row per key; a measure no branch has stays null."""
    return branches.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def _opex_lines(ledger: DataFrame, labor: DataFrame, inventory: DataFrame, marketing: DataFrame,
                ) -> list[DataFrame]:
    """Expense totals per site, month and account, each from its system of record."""
    def lines(df: DataFrame, account: str | None, source: str, cost: str) -> DataFrame:
        keys = [*MONTH_KEYS] if account else [*MONTH_KEYS, "account_no"]
        total = df.groupBy(*keys).agg(F.sum(cost).alias("amount"))
        number = F.lit(account) if account else F.col("account_no")
        return total.select(*MONTH_KEYS, number.alias("account_no"), F.lit(source).alias("source"), "amount")

    own = ledger.where(F.col("is_opex") & (F.col("mart_source") == "gl"))
    return [lines(own, None, SOURCE_LEDGER, "amount"),
            lines(labor.withColumnRenamed("gl_account_no", "account_no"), None, SOURCE_PAYROLL, "labor_cost"),
            lines(inventory, SUPPLIES_ACCOUNT, SOURCE_SUPPLIES, "supply_cost"),
            lines(marketing, ADS_ACCOUNT, SOURCE_ADS, "spend")]


def opex_monthly(ledger: DataFrame, labor: DataFrame, inventory: DataFrame, marketing: DataFrame,
                 account_map: DataFrame) -> DataFrame:
    """Operating expenses by site, month, account and source. The account map's keys are unique
    (checked when seeds load), so the pre-aggregated lines are already at the mart's grain."""
    lines = reduce(DataFrame.unionByName, _opex_lines(ledger, labor, inventory, marketing))
    accounts = account_map.select("account_no", "category", "account_title")
    return lines.join(accounts, "account_no").select(
        *MONTH_KEYS, "category", "account_no", "account_title", "source", "amount")


def _opex_measures(account: str, category: str, amount: str) -> list[Column]:
    """Expense columns of the scorecard; a line whose account has no map entry counts nowhere."""
    number, kind, mapped = F.col(account), F.col(category), F.col(category).isNotNull()

    def part(cond: Column) -> Column:
        return F.when(mapped, F.when(cond, F.col(amount)).otherwise(F.lit(0)))

    return [F.when(mapped, F.col(amount)).alias("total_opex"),
            part(kind == DOCTOR_CATEGORY).alias("doctor_comp"), part(number == LAB_ACCOUNT).alias("lab_fees"),
            part(number.isin(PAYROLL_BURDEN_ACCOUNTS)).alias("payroll_taxes_benefits"),
            part(kind.isin(FACILITY_CATEGORIES)).alias("facility_costs")]


def _visit_measures(visits: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    def done(word: str) -> Column:
        return F.col("status") == word

    return visits.groupBy(*keys).agg(
        F.sum("gross_production").alias("gross_production"),
        F.sum("net_production").alias("net_production"),
        exprs.count_where(done("completed")).alias("completed_visits"),
        exprs.count_where(done("no_show")).alias("no_shows"),
        F.count(F.lit(1)).alias("scheduled"),
        exprs.count_where(F.col("is_new_patient") & done("completed")).alias("new_patients"),
        exprs.sum_if(F.col("provider_type") == "Hygienist", "gross_production").alias("hygiene_production"))


def _payment_measures(payments: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return payments.groupBy(*keys).agg(
        F.sum("amount").alias("collections"),
        exprs.sum_if(F.col("payer") == "Insurance", "amount").alias("insurance_collections"))


def _labor_sums() -> list[Column]:
    return [F.sum("labor_cost").alias("labor_cost"),
            exprs.sum_if(F.col("is_overtime"), "labor_cost").alias("overtime_cost"),
            exprs.sum_if(F.col("is_productive"), "hours").alias("labor_hours"),
            exprs.sum_if(F.col("is_overtime"), "hours").alias("overtime_hours")]


def location_monthly(visits: DataFrame, payments: DataFrame, labor: DataFrame, ledger: DataFrame,
                     inventory: DataFrame, marketing: DataFrame, account_map: DataFrame,
                     locations: DataFrame) -> DataFrame:
    """Monthly scorecard, one row per site and month that has visits.

    Expense columns come from the same pass over each subject as its own measures: every subject's
    totals carry the account they post to, and the account map is joined once, to those totals.
    """
    def posted(df: DataFrame, account: str | None, cost: str) -> DataFrame:
        df = df.withColumn("account_no", F.lit(account)) if account else df
        return df.withColumn("_cost", F.col(cost))

    by_account = labor.groupBy(*MONTH_KEYS, F.col("gl_account_no").alias("account_no")).agg(*_labor_sums())
    own = ledger.where(F.col("is_opex") & (F.col("mart_source") == "gl")) \
        .groupBy(*MONTH_KEYS, "account_no").agg(F.sum("amount").alias("_cost"))
    supplies = inventory.groupBy(*MONTH_KEYS).agg(
        F.sum("supply_cost").alias("supply_cost"), F.sum("on_hand_value").alias("inventory_on_hand"))
    ads = marketing.groupBy(*MONTH_KEYS).agg(
        F.sum("spend").alias("marketing_spend"), F.sum("form_leads").alias("leads"),
        F.sum("booked_appts").alias("booked_from_marketing"))
    totals = union_all([_visit_measures(visits, MONTH_KEYS), _payment_measures(payments, MONTH_KEYS),
                        posted(by_account, None, "labor_cost"), own,
                        posted(supplies, SUPPLIES_ACCOUNT, "supply_cost"), posted(ads, ADS_ACCOUNT, "marketing_spend")])
    coded = map_code(totals, account_map, {"account_no": "account_no"}, ["category"])
    measured = align(coded.select("*", *_opex_measures("account_no", "category", "_cost")), MONTH_KEYS,
                     SCORECARD_MEASURES)
    site = locations.select("location_key", "location_name", "region", "specialty", "pms_system")
    return measured.where(F.col("scheduled").isNotNull()).join(site, "location_key").select(
        *site.columns, "month", *SCORECARD_MEASURES,
        (F.col("collections") - F.coalesce("total_opex", F.lit(0))).alias("operating_profit"))


def location_weekly(visits: DataFrame, payments: DataFrame, labor: DataFrame) -> DataFrame:
    """Monday weeks; subjects booked by the month are not part of it."""
    measured = align(union_all(
        [_visit_measures(visits.withColumn("week", exprs.week_of("service_date")), WEEK_KEYS),
         _payment_measures(payments.withColumn("week", exprs.week_of("paid_date")), WEEK_KEYS),
         labor.withColumn("week", exprs.week_of("work_date")).groupBy(*WEEK_KEYS).agg(*_labor_sums())]),
        WEEK_KEYS, WEEKLY_MEASURES)
    return measured.where(F.col("scheduled").isNotNull()).select(*WEEK_KEYS, *WEEKLY_MEASURES)


def procedure_mix(lines: DataFrame) -> DataFrame:
    done = (F.col("status") == "completed") & F.col("cdt_code").isNotNull()
    return lines.where(done).groupBy(*MONTH_KEYS, "procedure_category").agg(
        F.count(F.lit(1)).alias("procedures"), F.sum("gross_production").alias("gross_production"))


def marketing_channel_monthly(marketing: DataFrame) -> DataFrame:
    return marketing.groupBy(*MONTH_KEYS, "channel").agg(
        F.sum("spend").alias("spend"), F.sum("sessions").alias("sessions"),
        F.sum("form_leads").alias("leads"), F.sum("booked_appts").alias("booked"))


def reconciliation(payments: DataFrame, labor: DataFrame, inventory: DataFrame, marketing: DataFrame,
                   ledger: DataFrame, full: bool = False) -> DataFrame:
    """Operational totals against the ledger by site, month and category.

    Rows exist for operational totals only, with a null ledger side where nothing is booked;
    ``full`` also keeps what only the ledger has.
    """
    keys = (*MONTH_KEYS, "category")

    def operational(df: DataFrame, category: str, value: str) -> DataFrame:
        return df.groupBy(*MONTH_KEYS).agg(F.sum(value).alias("ops_amount")).select(
            *MONTH_KEYS, F.lit(category).alias("category"), "ops_amount", F.lit(1).alias("_ops"))

    booked = (ledger.where(F.col("mart_source").isin(list(RECONCILED)))
              .withColumn("category", exprs.words_to("mart_source", RECONCILED))
              .groupBy(*keys).agg(F.sum("amount").alias("gl_amount")))
    both = align(union_all([operational(payments, "Revenue", "amount"),
                            operational(labor, "Staff Wages", "labor_cost"),
                            operational(inventory, "Supplies", "supply_cost"),
                            operational(marketing, "Marketing", "spend"), booked]), keys, ("ops_amount", "gl_amount", "_ops"))
    if not full:
        both = both.where(F.col("_ops").isNotNull())
    difference = F.col("gl_amount") - F.col("ops_amount")
    source = F.when(F.col("_ops").isNotNull(), exprs.words_to("category", OPERATIONAL_SOURCE))
    return both.select(*keys, source.alias("ops_source"), "ops_amount", "gl_amount",
                       difference.alias("variance"),
                       exprs.ratio(difference, "ops_amount").alias("variance_pct"))


def operations_monthly(opex: DataFrame, payments: DataFrame, locations: DataFrame) -> DataFrame:
    """Expense categories next to the site's collections and as a share of them."""
    by_category = opex.groupBy(*MONTH_KEYS, "category").agg(F.sum("amount").alias("opex_amount"))
    collected = payments.groupBy(*MONTH_KEYS).agg(F.sum("amount").alias("collections"))
    site = locations.select("location_key", "location_name", "region", "specialty")
    return by_category.join(collected, list(MONTH_KEYS), "left").join(site, "location_key").select(
        *site.columns, "month", "category", "opex_amount", "collections",
        exprs.ratio("opex_amount", "collections").alias("pct_of_collections"))
