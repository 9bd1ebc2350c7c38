"""Staging: one typed shape per subject, every row tied to a location_key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.operators import conform
from sitewell.operators.translate import map_code, to_location

# Ledger accounts the payroll, supply and advertising feeds post to.
WAGES_CLINICAL, WAGES_OFFICE, WAGES_TIME_OFF = "6000", "6010", "6030"
SUPPLIES_ACCOUNT, ADS_ACCOUNT = "5300", "6600"

# What stands in for a code its map does not hold.
UNMAPPED_JOB, UNMAPPED_ACCOUNT = "Unmapped job", "Unmapped account"
UNMAPPED_ITEM, OTHER_CHANNEL = "Unmapped category", "Other"

VISIT_KEYS = ("location_key", "pms_system", "appointment_id", "patient_key", "service_date")


# With ``unknown`` every staging function also keeps the rows of sites the crosswalk does not know: they have no
# location_key, and the column unmapped_site names them. One pass then gives totals and findings.
UNMAPPED_SITE = "unmapped_site"


def _extra(unknown: bool) -> list[str]:
    return [UNMAPPED_SITE] if unknown else []


def procedures(lines: DataFrame, providers: DataFrame | None, crosswalk: DataFrame,
               code_map: DataFrame, unknown: bool = False) -> DataFrame:
    """One row per procedure line of every practice system. ``lines`` and ``providers`` come
    from :func:`conform.gather`."""
    if unknown:  # a line of no known site has no provider there, and is not doubled by one listed twice
        marked = to_location(lines, crosswalk, unknown=True)
        known = F.when(F.col(UNMAPPED_SITE).isNull(), F.col("provider_id"))
        located = conform.conform_lines(marked.withColumn("provider_id", known), providers, ("location_key", UNMAPPED_SITE))
    else:
        located = to_location(conform.conform_lines(lines, providers), crosswalk)
    coded = map_code(located, code_map, {"cdt_code": "cdt_code"}, ["category", "is_new_patient_code"])
    return coded.select(
        "location_key", F.col("source_system").alias("pms_system"), "appointment_id",
        exprs.pseudonym("source_system", "patient_id").alias("patient_key"),
        "service_date", exprs.month_of("service_date").alias("month"),
        "provider_type", "status", "cdt_code",
        F.when(F.col("cdt_code").isNotNull(),
               F.coalesce("category", F.lit(conform.UNMAPPED_CODE))).alias("procedure_category"),
        F.coalesce("is_new_patient_code", F.lit(False)).alias("is_new_patient_code"),
        F.col("fee").alias("gross_production"), F.col("writeoff").alias("adjustments"),
        (F.col("fee") - F.col("writeoff")).alias("net_production"), *_extra(unknown))


# Visit statuses in alphabetical order. The last one among a visit's lines wins.
STATUSES = ("cancelled", "completed", "no_show")


def appointments(lines: DataFrame) -> DataFrame:
    """Lines rolled up to visits. Status and provider type are the alphabetically last of the
    visit's lines: compared as a rank and a flag, because a maximum of text would make Spark sort
    all lines before and after the shuffle instead of hashing them. The month follows from the
    date, so it stays out of the shuffle key."""
    rank = exprs.words_to("status", {s: i for i, s in enumerate(STATUSES)})
    visits = lines.groupBy(*VISIT_KEYS).agg(
        F.max(F.col("provider_type") == "Hygienist").alias("_hygienist"), F.max(rank).alias("_rank"),
        F.max("is_new_patient_code").alias("is_new_patient"),
        *[F.sum(c).alias(c) for c in ("gross_production", "adjustments", "net_production")])
    return visits.select(
        *VISIT_KEYS, exprs.month_of("service_date").alias("month"),
        F.when(F.col("_hygienist"), "Hygienist").otherwise("Dentist").alias("provider_type"),
        exprs.words_to("_rank", dict(enumerate(STATUSES))).alias("status"),
        "is_new_patient", "gross_production", "adjustments", "net_production")


def payments(rows: DataFrame, crosswalk: DataFrame) -> DataFrame:
    located = to_location(conform.conform_payments(rows), crosswalk)
    return located.select("location_key", "paid_date", exprs.month_of("paid_date").alias("month"),
                          "payer", "amount")


def labor(timecards: DataFrame, crosswalk: DataFrame, job_map: DataFrame,
          earning_map: DataFrame, unknown: bool = False) -> DataFrame:
    """Timecards with role, pay rules, the ledger account their cost posts to, and the cost."""
    located = to_location(timecards, crosswalk, "ukg", "org_level1", unknown)
    jobs = map_code(located, job_map, {"job_code": "job_code"}, ["role", "is_clinical"],
                    {"role": UNMAPPED_JOB})
    paid = map_code(jobs, earning_map, {"earning_code": "earning_code"},
                    ["pay_multiplier", "is_productive", "is_overtime"])
    day, hours, rate = F.col("work_date").cast("date"), exprs.amount("hours"), exprs.amount("hourly_rate")
    return paid.select(
        "location_key", F.col("employee_number").alias("employee_id"), "job_code", "role", "is_clinical",
        day.alias("work_date"), exprs.month_of(day).alias("month"),
        "earning_code", "is_productive", "is_overtime",
        F.when(~F.col("is_productive"), WAGES_TIME_OFF).when(F.col("is_clinical"), WAGES_CLINICAL)
        .otherwise(WAGES_OFFICE).alias("gl_account_no"),
        hours.alias("hours"),
        # the product is cut back to AMOUNT before any sum, else decimal growth eats its scale
        (hours * rate * F.col("pay_multiplier")).cast(exprs.AMOUNT).alias("labor_cost"), *_extra(unknown))


def ledger(entries: DataFrame, crosswalk: DataFrame, account_map: DataFrame, unknown: bool = False) -> DataFrame:
    """Ledger lines signed so that expenses and revenue are both positive."""
    located = to_location(entries, crosswalk, "sage_intacct", "locationid", unknown)
    coded = map_code(located, account_map, {"accountno": "account_no"},
                     ["category", "is_opex", "mart_source"])
    sign = F.when(F.col("category") == "Revenue", -1).otherwise(1) * exprs.whole("tr_type")
    return coded.select(
        "location_key", exprs.month_of(exprs.parse_date("entry_date", "slash_or_iso")).alias("month"),
        F.col("accountno").alias("account_no"), F.col("accounttitle").alias("account_title"),
        F.col("departmentid").alias("department"),
        F.coalesce("category", F.lit(UNMAPPED_ACCOUNT)).alias("category"), "is_opex", "mart_source",
        (exprs.amount("amount") * sign).cast(exprs.AMOUNT).alias("amount"), *_extra(unknown))


def inventory(usage: DataFrame, crosswalk: DataFrame, category_map: DataFrame, unknown: bool = False) -> DataFrame:
    located = to_location(usage, crosswalk, "inventory", "site_code", unknown)
    coded = map_code(located, category_map, {"vendor_category": "vendor_category"}, ["category"],
                     {"category": UNMAPPED_ITEM})
    cost = exprs.amount("unit_cost")
    return coded.select(
        "location_key", exprs.parse_date("period", "period").alias("month"), "item_number", "description",
        "category",
        (exprs.amount("qty_issued") * cost).cast(exprs.AMOUNT).alias("supply_cost"),
        (exprs.amount("qty_on_hand") * cost).cast(exprs.AMOUNT).alias("on_hand_value"), *_extra(unknown))


def marketing(performance: DataFrame, crosswalk: DataFrame, channel_map: DataFrame,
              daily_ads: DataFrame | None = None, unknown: bool = False) -> DataFrame:
    """Channel performance by site and month; ``daily_ads`` is the optional second ad feed, which
    already names its channel. Without it nothing is added, as when its table was never landed."""
    located = to_location(performance, crosswalk, "marketing", "site_slug", unknown)
    coded = map_code(located, channel_map, {"utm_source": "utm_source", "utm_medium": "utm_medium"},
                     ["channel", "is_paid"], {"channel": OTHER_CHANNEL})
    feed = coded.select(
        "location_key", F.col("month").cast("date").alias("month"), "channel", "is_paid",
        F.col("utm_campaign").alias("campaign"), exprs.amount("cost").alias("spend"),
        *[exprs.whole(theirs).alias(ours) for theirs, ours in
          (("sessions", "sessions"), ("form_submits", "form_leads"), ("appts_booked", "booked_appts"))], *_extra(unknown))
    if daily_ads is None:
        return feed
    day = "date_col" if "date_col" in daily_ads.columns else "date"
    ads = to_location(daily_ads, crosswalk, "windsor_facebook", "account_id", unknown).select(
        "location_key", exprs.month_of(F.col(day).cast("date")).alias("month"),
        F.lit("Meta").alias("channel"), F.lit(True).alias("is_paid"), "campaign",
        exprs.amount("spend").alias("spend"), exprs.whole("clicks").alias("sessions"),
        exprs.whole("actions_lead").alias("form_leads"), F.lit(0).alias("booked_appts"), *_extra(unknown))
    return feed.unionByName(ads)
