"""The given order-and-event tables read as the feeds of a site group.

Sites are nations, each run on one of the seven practice systems; an order is a visit and its lines
are procedure lines, delivered as text in the system's own words and date layout. Order totals are
payments, lines also serve as timecards, ledger entries and supply usage under supplier codes, and
events are marketing rows. Everything is derived by Spark from the whole tables, lazily. The maps
leave out one nation, one brand, one job and so on, so every fallback is exercised.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.operators.conform import LINE_FIELDS, PAYMENT_FIELDS, PROVIDER_FIELDS, SYSTEMS
from sitewell.plans.frames import Frames
from sitewell.plans.warehouse import DAILY_ADS, build_marts, stage_gathered

SYSTEM_ORDER = list(SYSTEMS)
UNMAPPED_NATION, UNMAPPED_BRAND = 7, "Brand#13"
HYGIENIST_BALANCE = 4000

DATE_TEXT = {
    "open_dental": "yyyy-MM-dd", "dentrix_ascend": "yyyy-MM-dd'T'HH:mm:ss'Z'", "sensei": "dd-MMM-yyyy",
    "dolphin": "MM/dd/yyyy", "tdo": "yyyyMMdd", "dentrix": "yyyy-MM-dd HH:mm:ss.SSS", "dox": "MM-dd-yyyy",
}


@lru_cache(maxsize=128)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def system_of(nation: str) -> Column:
    return exprs.per_system((F.col(nation) % 7).cast("string"),
                            {str(i): F.lit(s) for i, s in enumerate(SYSTEM_ORDER)})


def code_of(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def date_text(day: str) -> Column:
    return exprs.per_system("source_system", {s: F.date_format(day, layout) for s, layout in DATE_TEXT.items()})


def local(spark: SparkSession, **columns) -> DataFrame:
    """A few literal rows as a local relation, whose size the optimizer knows."""
    return spark.createDataFrame(pa.table(columns))


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the site of their customer."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey").select(
        "*", system_of("c_nationkey").alias("source_system"),
        code_of("office-", "c_nationkey").alias("source_location"))


def procedure_lines(spark: SparkSession, folder: str) -> DataFrame:
    order = visits(spark, folder).select("o_orderkey", "o_custkey", "o_orderdate", "source_system", "source_location")
    line = table(spark, folder, "lineitem")
    words = [(name, flag, {m: w for w, m in v.status.items()}[meaning]) for name, v in SYSTEMS.items()
             for flag, meaning in (("N", "completed"), ("R", "no_show"), ("A", "cancelled"))]
    name, flag, word = map(list, zip(*words))
    said = local(spark, source_system=name, l_returnflag=flag, word=word)
    # two facts that grow together: never worth broadcasting one of them
    return line.join(order.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).join(
        said, ["source_system", "l_returnflag"]).select(
        "source_system", "source_location", F.col("o_orderkey").cast("string").alias("appointment"),
        F.col("o_custkey").cast("string").alias("patient"), date_text("o_orderdate").alias("service_date"),
        F.col("l_suppkey").cast("string").alias("provider_id"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(code_of("P", "l_partkey")).alias("code"),
        F.col("l_extendedprice").cast("string").alias("fee"),
        F.col("l_quantity").cast("int").cast("string").alias("writeoff"),
        F.when(F.col("l_quantity") == 50, "HOLD").otherwise(F.col("word")).alias("status_word"))


def payment_rows(spark: SparkSession, folder: str) -> DataFrame:
    insured = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    word = exprs.per_system("source_system", {s: F.when(insured, v.insurance).otherwise("Pat")
                                              for s, v in SYSTEMS.items()})
    return visits(spark, folder).select(
        "source_system", "source_location", date_text("o_orderdate").alias("paid_date"), word.alias("payer_word"),
        F.col("o_totalprice").cast("string").alias("amount"))


def provider_rows(spark: SparkSession, folder: str) -> DataFrame:
    named = [s for s, v in SYSTEMS.items() if v.providers]
    word = exprs.per_system("source_system", {s: F.lit(SYSTEMS[s].hygienist) for s in named})
    supplier = table(spark, folder, "supplier").withColumn("source_system", system_of("s_nationkey"))
    return supplier.where(F.col("source_system").isin(named)).select(
        "source_system", code_of("office-", "s_nationkey").alias("source_location"),
        F.col("s_suppkey").cast("string").alias("provider_id"),
        F.when(F.col("s_acctbal") < HYGIENIST_BALANCE, word).otherwise("Doctor").alias("type_word"))


def vendor_tables(gathered: DataFrame, subject: str) -> dict[str, DataFrame]:
    """One raw table per system under the vendor's own column names."""
    file, fields = {"lines": ("procedures", LINE_FIELDS), "payments": ("payments", PAYMENT_FIELDS),
                    "providers": ("providers", PROVIDER_FIELDS)}[subject]
    return {f"{v.folder}__{file}": gathered.where(F.col("source_system") == s).select(
                *[F.col(f).alias(theirs) for f, theirs in zip(fields, getattr(v, subject))])
            for s, v in SYSTEMS.items() if getattr(v, subject)}


def timecards(spark: SparkSession, folder: str) -> DataFrame:
    job = exprs.words_to(F.col("l_linenumber").cast("string"),
                         {"1": "RDH01", "2": "DA01", "3": "EFDA01", "4": "FD01", "5": "INS01", "6": "OM01"}, "TEMP")
    earning = F.when(F.col("l_returnflag") == "N", "REG").when(F.col("l_returnflag") == "R", "OT") \
        .when(F.col("l_linestatus") == "F", "PTO").otherwise("BONUS")
    rate = F.col("l_tax").cast("decimal(4,2)") * 100 + 20
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("employee_number"), code_of("U", "l_suppkey").alias("org_level1"),
        job.alias("job_code"), F.col("l_shipdate").cast("date").cast("string").alias("work_date"),
        earning.alias("earning_code"), F.col("l_quantity").cast("int").cast("string").alias("hours"),
        rate.cast("string").alias("hourly_rate"))


# (line number, return flag) -> ledger account; a line without entry posts to 9999, which no map holds
POSTINGS = {("1", "*"): "4000", ("2", "*"): "5200", ("3", "*"): "5300", ("4", "*"): "6000",
            ("5", "N"): "6100", ("5", "R"): "6050", ("5", "A"): "6150", ("6", "*"): "6600",
            ("7", "N"): "5100", ("7", "R"): "4900"}


def ledger_entries(spark: SparkSession, folder: str) -> DataFrame:
    account = None
    for (number, flag), posted in POSTINGS.items():
        hit = F.col("l_linenumber") == int(number)
        hit = hit if flag == "*" else hit & (F.col("l_returnflag") == flag)
        account = F.when(hit, posted) if account is None else account.when(hit, posted)
    account = account.otherwise("9999")
    day = F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd")) \
        .otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("recordno"), day.alias("entry_date"),
        F.lit("batch").alias("batch_title"), account.alias("accountno"),
        F.concat(F.lit("account "), account).alias("accounttitle"), code_of("E", "l_suppkey").alias("locationid"),
        F.lit("CLIN").alias("departmentid"), F.when(F.col("l_linenumber") == 1, "-1").otherwise("1").alias("tr_type"),
        F.col("l_extendedprice").cast("string").alias("amount"))


def supply_usage(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        code_of("S", "l_suppkey").alias("site_code"), F.date_format("l_shipdate", "yyyyMM").alias("period"),
        F.col("l_partkey").cast("string").alias("item_number"), code_of("item ", "l_partkey").alias("description"),
        code_of("VC", "l_linenumber").alias("vendor_category"), F.lit("EA").alias("uom"),
        F.col("l_quantity").cast("int").cast("string").alias("qty_issued"),
        (F.col("l_discount").cast("decimal(4,2)") + 1).cast("string").alias("unit_cost"),
        (50 - F.col("l_quantity")).cast("int").cast("string").alias("qty_on_hand"))


def sited_events(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return table(spark, folder, "events").join(customer, F.col("user_id") == F.col("c_custkey"))


# event type -> (utm_source, utm_medium)
CHANNELS = {"click": ("google", "cpc"), "view": ("facebook", "paid_social"), "signup": ("google", "organic"),
            "purchase": ("(direct)", "(none)"), "error": ("elsewhere", "paid")}


def channel_performance(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    month = F.add_months(F.lit("1995-01-01").cast("date"), F.get_json_object("props", "$.k").cast("int"))
    return sited_events(spark, folder).select(
        code_of("site-", "c_nationkey").alias("site_slug"), month.cast("string").alias("month"),
        exprs.words_to(kind, {k: s for k, (s, _) in CHANNELS.items()}).alias("utm_source"),
        exprs.words_to(kind, {k: m for k, (_, m) in CHANNELS.items()}).alias("utm_medium"),
        F.concat(kind, F.lit(" campaign")).alias("utm_campaign"), F.col("value").cast("string").alias("cost"),
        F.lit("3").alias("sessions"), F.when(kind == "signup", "1").otherwise("0").alias("form_submits"),
        F.when(kind == "purchase", "1").otherwise("0").alias("appts_booked"))


def daily_ads(spark: SparkSession, folder: str) -> DataFrame:
    """The second ad feed: view events by day, moved from 2024 into the months of the first feed."""
    views = sited_events(spark, folder).where(F.col("event_type") == "view")
    day = F.add_months(F.col("ts").cast("date"), F.get_json_object("props", "$.k").cast("int") - 29 * 12)
    return views.select(
        day.cast("string").alias("date_col"), code_of("act-", "c_nationkey").alias("account_id"),
        F.lit("daily").alias("campaign"), F.col("value").cast("string").alias("spend"),
        F.lit("100").alias("impressions"), F.lit("1").alias("clicks"), F.lit("0").alias("actions_lead"))


def crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    mapped = table(spark, folder, "nation").where(F.col("n_nationkey") != UNMAPPED_NATION)
    supplier = table(spark, folder, "supplier").where(F.col("s_nationkey") != UNMAPPED_NATION)

    def entries(df: DataFrame, system: Column, prefix: str, key: str, place: str) -> DataFrame:
        return df.select(system.alias("source_system"), code_of(prefix, key).alias("source_location"),
                         F.col(place).cast("int").alias("location_key"))

    by_nation = [entries(mapped, s, p, "n_nationkey", "n_nationkey") for s, p in (
        (system_of("n_nationkey"), "office-"), (F.lit("marketing"), "site-"), (F.lit("windsor_facebook"), "act-"))]
    by_supplier = [entries(supplier, F.lit(s), p, "s_suppkey", "s_nationkey")
                   for s, p in (("ukg", "U"), ("sage_intacct", "E"), ("inventory", "S"))]
    return reduce(DataFrame.unionByName, by_nation + by_supplier)


def locations(spark: SparkSession, folder: str) -> DataFrame:
    region = table(spark, folder, "region")
    return table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("int").alias("location_key"), F.col("n_name").alias("location_name"),
        F.col("r_name").alias("region"), F.lit("General").alias("specialty"),
        (F.col("n_nationkey") % 5 + 3).cast("int").alias("operatories"), system_of("n_nationkey").alias("pms_system"))


def procedure_map(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").where(F.col("p_brand") != UNMAPPED_BRAND).select(
        code_of("P", "p_partkey").alias("cdt_code"), F.col("p_type").alias("category"),
        (F.col("p_size") == 1).alias("is_new_patient_code"))


ACCOUNTS = {
    "4000": ("Income", "Revenue", False, "pms"), "4900": ("Refunds", "Revenue", False, "gl"),
    "5100": ("Doctors", "Doctor Compensation", True, "gl"), "5200": ("Lab", "Clinical Supplies & Lab", True, "gl"),
    "5300": ("Supplies", "Clinical Supplies & Lab", True, "inventory"),
    "6000": ("Clinical wages", "Staff Payroll & Benefits", True, "ukg"),
    "6010": ("Office wages", "Staff Payroll & Benefits", True, "ukg"),
    "6030": ("Time off", "Staff Payroll & Benefits", True, "ukg"),
    "6050": ("Payroll tax", "Staff Payroll & Benefits", True, "gl"), "6100": ("Rent", "Occupancy", True, "gl"),
    "6150": ("Power", "Utilities", True, "gl"), "6600": ("Ads", "Marketing", True, "marketing"),
}


def account_map(spark: SparkSession) -> DataFrame:
    title, category, is_opex, source = map(list, zip(*ACCOUNTS.values()))
    return local(spark, account_no=list(ACCOUNTS), account_title=title, category=category, is_opex=is_opex,
                 mart_source=source)


def earning_map(spark: SparkSession) -> DataFrame:
    rules = local(spark, earning_code=["REG", "OT", "PTO"], pay_multiplier=["1.0", "1.5", "1.0"],
                  is_productive=[True, True, False], is_overtime=[False, True, False])
    return rules.withColumn("pay_multiplier", F.col("pay_multiplier").cast("decimal(6,3)"))


def seeds(spark: SparkSession, folder: str) -> Frames:
    return Frames({
        "dim_location": lambda: locations(spark, folder),
        "location_crosswalk": lambda: crosswalk(spark, folder),
        "cdt_procedure_map": lambda: procedure_map(spark, folder),
        "gl_account_map": lambda: account_map(spark),
        "ukg_earning_map": lambda: earning_map(spark),
        "ukg_job_map": lambda: local(
            spark, job_code=["RDH01", "DA01", "EFDA01", "FD01", "INS01", "OM01"],
            role=["Hygienist", "Assistant", "Assistant", "Front Office", "Front Office", "Manager"],
            is_clinical=[True, True, True, False, False, False]),
        "inventory_category_map": lambda: local(
            spark, vendor_category=["VC1", "VC2", "VC3", "VC4", "VC5", "VC6"],
            category=["Protection", "Protection", "Restorative", "Restorative", "Hygiene", "Consumables"]),
        "marketing_channel_map": lambda: local(
            spark, utm_source=["google", "facebook", "google", "(direct)"],
            utm_medium=["cpc", "paid_social", "organic", "(none)"],
            channel=["Search", "Meta", "Organic", "Direct"], is_paid=[True, True, False, False]),
    })


class Sample:
    """Feeds, maps, staging frames and marts of one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        at = (spark, folder)
        self.practice = Frames({"lines": lambda: procedure_lines(*at), "providers": lambda: provider_rows(*at),
                                "payments": lambda: payment_rows(*at)})
        self.raw = Frames({
            "ukg__timecards": lambda: timecards(*at), "sage_intacct__gl_detail": lambda: ledger_entries(*at),
            "inventory__usage": lambda: supply_usage(*at),
            "marketing__channel_performance": lambda: channel_performance(*at), DAILY_ADS: lambda: daily_ads(*at)})
        self.delivered_lines = table(spark, folder, "lineitem")
        self.seeds = seeds(*at)
        self.staged = stage_gathered(self.practice, self.raw, self.seeds)
        self.marts = build_marts(self.staged, self.seeds)
