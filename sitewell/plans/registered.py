"""Named queries over the given tables, each with its SQL twin where SQL can say it.

Every query runs the library's own operators, on the sample feeds or on the tables directly, over
whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.functions.exprs import doubles
from sitewell.operators import checks, conform, extracts, marts, publish, reports, staging, translate
from sitewell.plans import sample_feeds as feeds
from sitewell.plans import incremental, warehouse
from sitewell.plans.registered_sql import MONTH, bigint, doubled, select
from sitewell.plans.sample_feeds import Sample, code_of, money, table
from sitewell.session import shared_folder
from sitewell.sources import landing, versions
from sitewell.streaming import drops

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(name: str, sql: str | None = None):
    """Register a function of (spark, folder)."""
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = select(sql)
        return function
    return add


def on_sample(name: str, sql: str | None = None):
    """Register a function of the sample feeds."""
    def add(function):
        registered(name, sql)(lambda spark, folder: function(Sample(spark, folder)))
        return function
    return add


# --- landing, names and scalars ---------------------------------------------------------------------

@registered("land_text_roundtrip", f"""
    SELECT o_orderstatus, {MONTH.format(d='o_orderdate')} AS month, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, max(o_orderkey) AS last_order
    FROM orders GROUP BY ALL""")
def land_text_roundtrip(spark, folder):
    landed = landing.as_text(table(spark, folder, "orders").withColumn("o_totalprice", money("o_totalprice")))
    month = exprs.month_of(exprs.parse_date("o_orderdate", "iso_prefix"))
    return doubles(landed.groupBy("o_orderstatus", month.alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(exprs.amount("o_totalprice")).alias("total"),
        F.max(F.col("o_orderkey").cast("bigint")).alias("last_order")))


def _parse_dates(name: str, layout: str, kind: str) -> None:
    def run(spark, folder):
        text = table(spark, folder, "orders").select(F.date_format("o_orderdate", layout).alias("said"))
        day = text.select(exprs.parse_date("said", kind).alias("day"))
        return day.groupBy(exprs.month_of("day").alias("month"), exprs.week_of("day").alias("week")) \
            .agg(F.count(F.lit(1)).alias("orders"), F.min("day").alias("first_day"))

    registered(name, f"""
        SELECT {MONTH.format(d='o_orderdate')} AS month, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
               count(*) AS orders, CAST(min(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY ALL""")(run)


for _name, _layout, _kind in (
        ("parse_dates_dmy", "dd-MMM-yyyy", "day_mon_year"), ("parse_dates_mdy", "MM/dd/yyyy", "slash_mdy"),
        ("parse_dates_ymd", "yyyyMMdd", "compact_ymd"), ("parse_dates_mdy_dash", "M-d-yyyy", "dash_mdy"),
        ("parse_dates_iso_prefix", "yyyy-MM-dd HH:mm:ss.SSS", "iso_prefix")):
    _parse_dates(_name, _layout, _kind)


@registered("parse_dates_two_format", f"""
    SELECT {MONTH.format(d='o_orderdate')} AS month, o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL""")
def parse_dates_two_format(spark, folder):
    said = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "MM/dd/yyyy")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    text = table(spark, folder, "orders").select("o_orderstatus", said.alias("said"))
    return text.groupBy(exprs.month_of(exprs.parse_date("said", "slash_or_iso")).alias("month"), "o_orderstatus") \
        .agg(F.count(F.lit(1)).alias("orders"))


@registered("parse_period", f"""
    SELECT {MONTH.format(d='l_shipdate')} AS month, strftime(l_shipdate, '%Y-%m') AS month_text,
           strftime({MONTH.format(d='l_shipdate')} + INTERVAL 5 MONTH, '%Y-%m') AS five_later,
           (year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS since_1995, count(*) AS n
    FROM lineitem GROUP BY ALL""")
def parse_period(spark, folder):
    text = table(spark, folder, "lineitem").select(F.date_format("l_shipdate", "yyyyMM").alias("period"))
    month = text.select(exprs.parse_date("period", "period").alias("month"))
    return month.groupBy("month").agg(F.count(F.lit(1)).alias("n")).select(
        "month", exprs.month_text("month").alias("month_text"),
        exprs.shift_month_text(exprs.month_text("month"), 5).alias("five_later"),
        exprs.months_apart("month", F.lit("1995-01-01").cast("date")).cast("bigint").alias("since_1995"), "n")


@registered("pseudonym", "SELECT c_custkey, md5(c_mktsegment || c_custkey) AS patient_key FROM customer")
def pseudonym(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", exprs.pseudonym("c_mktsegment", F.col("c_custkey").cast("string")).alias("patient_key"))


@registered("since_window", """
    SELECT o_orderpriority, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders WHERE o_orderdate >= DATE '2000-06-15' GROUP BY ALL""")
def since_window(spark, folder):
    recent = landing.since_window(table(spark, folder, "orders"), "o_orderdate", "2000-06-15")
    return doubles(recent.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"),
                                                         F.sum(money("o_totalprice")).alias("total")))


@registered("window_merge", f"""
    SELECT {MONTH.format(d='o_orderdate')} AS month, count(*) AS orders,
           CAST(sum(CASE WHEN o_orderdate >= DATE '2000-06-15' THEN 2 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2)))
                AS DOUBLE) AS total
    FROM orders GROUP BY ALL""")
def window_merge(spark, folder):
    old = table(spark, folder, "orders").select("o_orderdate", money("o_totalprice").alias("price"))
    arrived = old.withColumn("price", (F.col("price") * 2).cast("decimal(18,2)"))
    merged = landing.merge_window(old, arrived, "o_orderdate", "2000-06-15")
    return doubles(merged.groupBy(exprs.month_of("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").alias("total")))


@registered("window_accounting", """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (o_orderdate < DATE '2000-06-15') AS kept,
           count(*) FILTER (o_orderdate >= DATE '2000-06-15') AS replaced,
           count(*) FILTER (o_orderdate >= DATE '2000-06-15' AND o_orderstatus <> 'F') AS entered,
           count(*) FILTER (o_orderdate < DATE '2000-06-15' AND o_orderstatus <> 'F') AS late, 0::BIGINT AS undated
    FROM orders GROUP BY ALL""")
def window_accounting(spark, folder):
    old = table(spark, folder, "orders")
    return landing.window_accounting(old, old.where(F.col("o_orderstatus") != "F"), "o_orderdate", "2000-06-15")


@registered("late_rows", """
    SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderdate < DATE '2000-06-15' GROUP BY ALL""")
def late_rows(spark, folder):
    late = landing.late_rows(table(spark, folder, "orders"), "o_orderdate", "2000-06-15")
    return late.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@registered("quoted_newlines", "SELECT doc_id, lang, length(text) AS size, md5(text) AS digest FROM documents")
def quoted_newlines(spark, folder):
    # documents written as many CSV files of bounded size, with line breaks inside quotes, and read back
    drop = f"{shared_folder(spark)}/quoted-{uuid.uuid4().hex}"
    exact = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxRecordsPerFile": "2000"}
    table(spark, folder, "documents").select("doc_id", "text", "lang").write.options(header="true", **exact).csv(drop)
    text = F.coalesce("text", F.lit(""))
    return landing.read_text(spark, drop).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.length(text).cast("bigint").alias("size"), F.md5(text).alias("digest"))


@on_sample("incremental_layers", """
    SELECT 'raw' AS layer, CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS period, count(*) AS n,
           CAST(sum(l_quantity) AS DOUBLE) AS amount, strftime(l_shipdate, '%Y%m') >= '200006' AS rewritten
    FROM lineitem GROUP BY ALL
    UNION ALL SELECT 'staging', CAST(strftime(month, '%Y%m') AS INTEGER), count(*), CAST(sum(labor_cost) AS DOUBLE),
           strftime(month, '%Y%m') >= '200006' FROM labor GROUP BY ALL
    UNION ALL SELECT 'weeks', CAST(strftime(week, '%Y%m') AS INTEGER), count(*), CAST(sum(cost) AS DOUBLE),
           strftime(week, '%Y%m') >= '200005'
    FROM (SELECT location_key, CAST(date_trunc('week', work_date) AS DATE) AS week, sum(labor_cost) AS cost FROM labor GROUP BY ALL)
    GROUP BY ALL""")
def incremental_layers(s):
    # timecards that arrive without hours first and complete later, from a day on: which months each layer writes again
    cards, maps = s.raw["ukg__timecards"], s.seeds
    spark, name, since = cards.sparkSession, f"refreshed_{uuid.uuid4().hex}", dt.date(2000, 6, 15)
    day, cut = F.col("work_date").cast("date"), F.lit(since)
    raw, staged, weeks = (f"{name}_{layer}" for layer in ("raw", "staging", "weeks"))
    steps = [
        incremental.Step(staged, (raw,), lambda f: staging.labor(
            f[raw].drop(versions.PERIOD), maps["location_crosswalk"], maps["ukg_job_map"], maps["ukg_earning_map"])),
        incremental.Step(weeks, (staged,), lambda f: f[staged].groupBy("location_key", exprs.week_of("work_date").alias("week")).agg(
            F.sum("labor_cost").alias("labor_cost")), lambda: versions.month_code("week"),
            incremental.months_of_weeks, incremental.months_in_weeks)]
    empty = cards.withColumn("hours", F.when(day >= cut, "0").otherwise(F.col("hours")))
    landing.replace_window(empty, raw, day, dt.date(1990, 1, 1))
    incremental.refresh(spark, steps)
    landing.replace_window(cards.where(day >= cut), raw, day, since)
    incremental.refresh(spark, steps)

    def told(layer: str, kept: str, amount: str) -> DataFrame:
        again = sorted(versions.changed(spark, kept, 1))
        return versions.read(spark, kept, with_period=True).groupBy(
            F.lit(layer).alias("layer"), F.col(versions.PERIOD).alias("period")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(amount).cast("decimal(18,6)")).alias("amount")).withColumn(
            "rewritten", F.col("period").isin(again))

    return doubles(told("raw", raw, "hours").unionByName(told("staging", staged, "labor_cost")).unionByName(
        told("weeks", weeks, "labor_cost")))


@registered("stream_merge", """
    SELECT o_orderkey AS order_key, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderstatus END AS status,
           CAST(o_totalprice AS DOUBLE) AS total FROM orders""")
def stream_merge(spark, folder):
    # all orders, then those that changed, then the first delivery once more; merged after each, as a restarted stream
    home, name = f"{shared_folder(spark)}/merge-{uuid.uuid4().hex}", f"merged_{uuid.uuid4().hex}"
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order Key"), F.col("o_orderstatus").alias("Status"),
        F.col("o_totalprice").cast("string").alias("Total"))
    done = orders.where(F.col("Status") == "F").withColumn("Status", F.lit("done"))
    for delivery in (orders, done, orders):
        delivery.write.mode("append").option("header", True).csv(f"{home}/drop")
        drops.merge(drops.watch(spark, f"{home}/drop"), ["Order Key", "Status", "Total"], ["order_key"], name,
                    f"{home}/mark").awaitTermination()
    return versions.read(spark, name).select(
        F.col("order_key").cast("bigint").alias("order_key"), "status", F.col("total").cast("double").alias("total"))


@registered("source_counts", """
    SELECT 'sales' AS source, (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS n
    UNION ALL SELECT 'people', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'web', (SELECT count(*) FROM events) + (SELECT count(*) FROM pages)
    UNION ALL SELECT 'texts', (SELECT count(*) FROM documents) + (SELECT count(*) FROM conversations)""")
def source_counts(spark, folder):
    names = ["orders", "lineitem", "customer", "supplier", "events", "pages", "documents", "conversations"]
    counts = publish.table_counts({t: table(spark, folder, t) for t in names})
    name = F.col("table_name")
    group = F.when(name.isin("orders", "lineitem"), "sales").when(name.isin("customer", "supplier"), "people") \
        .when(name.isin("events", "pages"), "web").otherwise("texts")
    return publish.source_counts(counts, group)


@on_sample("raw_source_counts", """
    SELECT 'Practice management' AS source, count(*) AS n FROM all_procedures
    UNION ALL SELECT 'Sage Intacct', count(*) FROM all_supplied UNION ALL SELECT 'UKG', count(*) FROM all_supplied
    UNION ALL SELECT 'Inventory', count(*) FROM all_supplied
    UNION ALL SELECT 'Marketing / websites', count(*) + count(*) FILTER (event_type = 'view') FROM all_events""")
def raw_source_counts(s):
    # each delivered line is one row of its practice feed: counts come from the files' footers, nothing is joined
    tables = {**s.raw, "pms_x__procedures": s.delivered_lines, "pms_x__payments": s.practice["payments"]}
    return publish.source_counts(publish.table_counts(tables), publish.source_group())


# --- source-side extracts ---------------------------------------------------------------------------

@registered("od_extract", """
    SELECT l_orderkey AS "AptNum", o_custkey AS "PatNum", CAST(l_shipdate AS DATE) AS "ProcDate", l_suppkey AS "ProvNum",
           p_name AS "ProcCode", CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * greatest(l_linenumber - 3, 1) AS DOUBLE) AS "ProcFee",
           CAST(coalesce(w, 0) AS DOUBLE) AS "WriteOff", coalesce(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 5 END, 2) AS "AptStatus"
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey
    LEFT JOIN (SELECT user_id, sum(CAST(value AS DECIMAL(18,2))) AS w FROM events GROUP BY user_id) ON user_id = l_orderkey
    WHERE l_returnflag = 'N' AND l_shipdate >= DATE '2000-01-01'
    UNION ALL SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE), 0, '', 0, 0, CASE o_orderstatus WHEN 'O' THEN 3 ELSE 5 END
    FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate >= DATE '2000-01-01'""")
def od_extract(spark, folder):
    orders = table(spark, folder, "orders")
    status = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 3).otherwise(5)
    lines = table(spark, folder, "lineitem").join(orders.select("o_orderkey", "o_custkey"),
                                                  F.col("l_orderkey") == F.col("o_orderkey"))
    procedures = lines.select(
        F.col("l_orderkey").alias("ProcNum"), F.col("l_orderkey").alias("AptNum"), F.col("o_custkey").alias("PatNum"),
        F.col("l_shipdate").cast("date").alias("ProcDate"), F.col("l_suppkey").alias("ProvNum"),
        F.col("l_partkey").alias("CodeNum"), money("l_extendedprice").alias("ProcFee"),
        (F.col("l_linenumber") - 3).alias("UnitQty"), F.when(F.col("l_returnflag") == "N", 2).otherwise(1).alias("ProcStatus"))
    codes = table(spark, folder, "part").select(F.col("p_partkey").alias("CodeNum"), F.col("p_name").alias("ProcCode"))
    appointments = orders.select(F.col("o_orderkey").alias("AptNum"), F.col("o_custkey").alias("PatNum"),
                                 F.col("o_orderdate").alias("AptDateTime"), F.lit(0).cast("bigint").alias("ProvNum"),
                                 status.alias("AptStatus"))
    claims = table(spark, folder, "events").select(F.col("user_id").alias("ProcNum"), money("value").alias("WriteOff"))
    extract = extracts.open_dental_procedures(procedures, codes, appointments, claims, "2000-01-01")
    return doubles(extract.drop("ProcNum"))


@registered("od_payments", f"""
    SELECT "PayType", {MONTH.format(d='"PayDate"')} AS month, count(*) AS n, CAST(sum("PayAmt") AS DOUBLE) AS total
    FROM (SELECT o_orderdate AS "PayDate", 'Patient' AS "PayType", CAST(o_totalprice AS DECIMAL(18,2)) AS "PayAmt"
          FROM orders WHERE o_orderdate >= DATE '1999-01-01'
          UNION ALL SELECT l_shipdate, 'Insurance', CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem
          WHERE l_shipdate >= DATE '1999-01-01') GROUP BY ALL""")
def od_payments(spark, folder):
    patient = table(spark, folder, "orders").select(F.col("o_orderdate").alias("PayDate"),
                                                    money("o_totalprice").alias("PayAmt"))
    insurer = table(spark, folder, "lineitem").select(F.col("l_shipdate").alias("CheckDate"),
                                                      money("l_extendedprice").alias("CheckAmt"))
    paid = extracts.open_dental_payments(patient, insurer, "1999-01-01")
    return doubles(paid.groupBy("PayType", exprs.month_of("PayDate").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("PayAmt").alias("total")))


@registered("od_providers", """
    SELECT s_suppkey AS "ProvNum", CASE WHEN s_acctbal < 4000 THEN 1 ELSE 0 END AS "IsSecondary",
           r_name AS "ClinicNum" FROM supplier JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey WHERE s_acctbal >= 0""")
def od_providers(spark, folder):
    # each provider carries the office its database belongs to, here the region's name
    supplier = table(spark, folder, "supplier").join(
        table(spark, folder, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).join(
        table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
        "r_name", F.col("s_suppkey").alias("ProvNum"),
        F.when(F.col("s_acctbal") < feeds.HYGIENIST_BALANCE, 1).otherwise(0).alias("IsSecondary"),
        F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("IsHidden"))
    return extracts.open_dental_providers(supplier, office="r_name")


@registered("dentrix_extract", """
    SELECT s_nationkey AS "ClinicID", l_orderkey AS "ApptID", l_partkey AS "PatGUID",
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%g') AS "ProcDate", l_suppkey AS "ProvID", l_returnflag AS "ADACode",
           l_extendedprice AS "Amt", l_tax AS "AdjAmt",
           CASE WHEN l_returnflag = 'N' THEN 'C' WHEN o_orderstatus = 'P' THEN 'B' ELSE 'D' END AS "ApptStatus"
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderpriority <> '5-LOW'
    WHERE s_nationkey <> 7 AND l_shipdate >= DATE '2000-01-01'""")
def dentrix_extract(spark, folder):
    supplier = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("clinic_id"))
    log = table(spark, folder, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "clinic_id", F.col("l_orderkey").alias("appt_id"), F.col("l_partkey").alias("patient_guid"),
        F.col("l_shipdate").alias("proc_date"), F.col("l_suppkey").alias("prov_id"),
        F.col("l_returnflag").alias("ada_code"), F.col("l_extendedprice").alias("amount"),
        F.col("l_tax").alias("adjustment_amount"),
        F.when(F.col("l_returnflag") == "N", 102).otherwise(1).alias("chart_status"))
    clinics = table(spark, folder, "nation").where(F.col("n_nationkey") != 7).select(F.col("n_nationkey").alias("clinic_id"))
    appointments = table(spark, folder, "orders").where(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("appt_id"), F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("broken"))
    return extracts.dentrix_procedures(log, clinics, appointments, "2000-01-01")


@registered("dentrix_payments", """
    SELECT o_custkey AS "ClinicID", strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g') AS "TransDate",
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'InsPayment' ELSE 'PatPayment' END AS "TransType",
           o_totalprice AS "Amount" FROM orders WHERE o_orderdate >= DATE '1998-03-01'""")
def dentrix_payments(spark, folder):
    payments = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("clinic_id"), F.col("o_orderdate").alias("trans_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("is_insurance"),
        F.col("o_totalprice").alias("amount"))
    return extracts.dentrix_payments(payments, "1998-03-01")


@registered("dentrix_providers", """
    SELECT s_suppkey AS "ProvID", s_nationkey AS "ClinicID",
           CASE WHEN s_acctbal < 4000 THEN 'Hygienist' ELSE 'Dentist' END AS "ProvType" FROM supplier""")
def dentrix_providers(spark, folder):
    return extracts.dentrix_providers(table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("prov_id"), F.col("s_nationkey").alias("clinic_id"),
        F.when(F.col("s_acctbal") < feeds.HYGIENIST_BALANCE, 1).otherwise(0).alias("is_hygienist")))


@registered("dolphin_extract", """
    SELECT n_name AS office_code, o_orderkey AS visit_id, c_custkey AS patient_ref, strftime(o_orderdate, '%m/%d/%Y') AS service_date,
           o_orderpriority AS provider_code, l_returnflag AS ada_code, l_extendedprice AS fee_usd, l_tax AS contractual_adj,
           CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'NS' ELSE 'X' END AS status
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderdate >= DATE '2000-01-01'""")
def dolphin_extract(spark, folder):
    customer = table(spark, folder, "customer")
    visits = table(spark, folder, "orders").join(
        customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("office_id")), "o_custkey")
    word = exprs.words_to("o_orderstatus", {"F": "kept", "O": "missed"}, "moved")
    visits = visits.select(F.col("o_orderkey").alias("visit_id"), "office_id", F.col("o_custkey").alias("patient_id"),
                           F.col("o_orderdate").alias("visit_date"), F.col("o_orderpriority").alias("provider_code"),
                           word.alias("status"))
    offices = table(spark, folder, "nation").select(F.col("n_nationkey").alias("office_id"),
                                                    F.col("n_name").alias("office_code"))
    transactions = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("visit_id"), F.col("l_returnflag").alias("ada_code"),
        F.col("l_extendedprice").alias("fee"), F.col("l_tax").alias("adjustment"))
    return extracts.dolphin_procedures(visits, offices, customer.select(F.col("c_custkey").alias("patient_id")),
                                       transactions, "2000-01-01")


@registered("dolphin_payments", """
    SELECT n_name AS office_code, strftime(o_orderdate, '%m/%d/%Y') AS posted,
           CASE WHEN o_orderpriority = '2-HIGH' THEN 'INS' ELSE 'PAT' END AS source, o_totalprice AS amount
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE o_orderdate >= DATE '1997-07-01'""")
def dolphin_payments(spark, folder):
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                       F.col("c_nationkey").alias("office_id"))
    payments = table(spark, folder, "orders").join(customer, "o_custkey").select(
        "office_id", F.col("o_orderdate").alias("posted_date"), F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "insurance").otherwise("patient").alias("payer_type"))
    offices = table(spark, folder, "nation").select(F.col("n_nationkey").alias("office_id"),
                                                    F.col("n_name").alias("office_code"))
    return extracts.dolphin_payments(payments, offices, "1997-07-01")


@registered("dolphin_providers", """
    SELECT s_suppkey AS provider_code, n_name AS office_code, s_name AS credential
    FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def dolphin_providers(spark, folder):
    doctors = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("provider_code"),
                                                      F.col("s_nationkey").alias("office_id"),
                                                      F.col("s_name").alias("credential"))
    offices = table(spark, folder, "nation").select(F.col("n_nationkey").alias("office_id"),
                                                    F.col("n_name").alias("office_code"))
    return extracts.dolphin_providers(doctors, offices)


@registered("json_flatten", """
    SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n,
           count(json_extract_string(props, '$.absent')) AS absent
    FROM events GROUP BY ALL""")
def json_flatten(spark, folder):
    # a hundred neighbouring events are one page of the API: {"data": [ ... ]}
    item = F.concat(F.lit('{"kind": "'), "event_type", F.lit('", "props": '), "props", F.lit("}"))
    pages = table(spark, folder, "events").groupBy(F.floor(F.col("event_id") / 100).alias("page")) \
        .agg(F.concat(F.lit('{"data": ['), F.concat_ws(", ", F.collect_list(item)), F.lit("]}")).alias("body"))
    flat = extracts.flatten_json(pages, "body", {"event_type": "kind", "k": "props.k", "absent": "props.no.such"})
    return flat.groupBy("event_type", F.col("k").cast("bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.count("absent").alias("absent"))


@registered("xml_flatten", """
    SELECT o_orderstatus AS status, count(*) AS n, count(*) FILTER (o_orderpriority <> '5-LOW') AS with_priority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL""")
def xml_flatten(spark, folder):
    # a hundred neighbouring orders are one page of ledger records; some lack an element
    price = money("o_totalprice").cast("string")
    kind = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(
        F.concat(F.lit("<PRIORITY>"), "o_orderpriority", F.lit("</PRIORITY>")))
    record = F.concat(F.lit("<gldetail><AMOUNT>"), price, F.lit("</AMOUNT><STATUS>"), "o_orderstatus",
                      F.lit("</STATUS>"), kind, F.lit("</gldetail>"))
    pages = table(spark, folder, "orders").groupBy(F.floor(F.col("o_orderkey") / 100).alias("page")).agg(F.concat(
        F.lit("<response><result><status>success</status><data>"), F.concat_ws("", F.collect_list(record)),
        F.lit("</data></result></response>")).alias("body"))
    flat = extracts.flatten_xml(pages, "body", "gldetail", ["AMOUNT", "STATUS", "PRIORITY"])
    return doubles(flat.groupBy(F.col("STATUS").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.count("PRIORITY").alias("with_priority"),
        F.sum(exprs.amount("AMOUNT")).alias("total")))


@registered("xml_files", """
    SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL""")
def xml_files(spark, folder):
    # the orders as files of ledger pages, one page of some thousand records each, read in pieces
    drop = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    order = table(spark, folder, "orders").select(
        F.floor(F.col("o_orderkey") / 20000).alias("page"), F.lit(1).alias("place"), F.concat(
            F.lit("<gldetail><AMOUNT>"), money("o_totalprice").cast("string"), F.lit("</AMOUNT><STATUS>"), "o_orderstatus",
            F.lit("</STATUS><PRIORITY>"), "o_orderpriority", F.lit("</PRIORITY></gldetail>")).alias("value"))
    ends = order.select("page").distinct().select("page", F.inline(F.array(
        F.struct(F.lit(0).alias("place"), F.lit("<response><result><status>success</status><data>").alias("value")),
        F.struct(F.lit(2).alias("place"), F.lit("</data></result></response>").alias("value")))))
    order.unionByName(ends).repartition("page").sortWithinPartitions("page", "place").select("page", "value") \
        .write.partitionBy("page").text(drop)
    flat = extracts.read_xml(spark, drop, "gldetail", ["AMOUNT", "STATUS", "PRIORITY"])
    return doubles(flat.groupBy(F.col("STATUS").alias("status"), F.col("PRIORITY").alias("priority")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(exprs.amount("AMOUNT")).alias("total")))


@registered("tag_extract", """
    SELECT regexp_extract(url, 'utm_source=([a-z0-9-]+)', 1) AS site_slug, count(*) AS pages, sum(length(html))::BIGINT AS size
    FROM pages WHERE regexp_extract(url, 'utm_source=([a-z0-9-]+)', 1) <> '' GROUP BY ALL""")
def tag_extract(spark, folder):
    found = extracts.tagged(table(spark, folder, "pages"), "url", "utm_source=([a-z0-9-]+)")
    return found.groupBy("site_slug").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("html")).alias("size"))


def _ad_feeds(spark, folder):
    """Three feeds of events: clicks as search ads, views as social ads, the rest as web analytics."""
    events = feeds.sited_events(spark, folder)
    # purchases carry no tag and leave the ad feeds
    name = F.when(F.col("c_nationkey") == 7, "untagged").otherwise(
        F.concat(F.lit("["), code_of("site-", "c_nationkey"), F.lit("] spring")))
    search = events.where("event_type = 'click'").select(
        name.alias("campaign_name"), F.date_format("ts", "yyyy-MM-01").alias("month"),
        (F.round(F.col("value") * 100).cast("bigint") * 10000).alias("cost_micros"))
    social = events.where("event_type = 'view'").select(
        name.alias("campaign_name"), money("value").cast("string").alias("spend"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_start"))
    event = exprs.words_to("event_type", {"signup": "generate_lead", "purchase": "appointment_booked"}, "session_start")
    web = events.where("event_type IN ('signup', 'purchase', 'error')").select(
        code_of("site-", "c_nationkey").alias("site_slug"), F.date_format("ts", "yyyyMM").alias("year_month"),
        F.lit("google").alias("session_source"), F.lit("organic").alias("session_medium"), event.alias("event_name"),
        F.lit("5").alias("sessions"), F.lit("2").alias("event_count"))
    return [extracts.search_ads(search), extracts.social_ads(social), extracts.web_analytics(web)]


_FOLD = f"""
    SELECT 'site-' || location_key AS site_slug, {MONTH.format(d='day')} AS month, source AS utm_source, medium AS utm_medium,
           sum(cost) + {{retainer}} AS cost, sum(sessions) AS sessions, sum(forms) AS form_submits, sum(booked) AS appts_booked
    FROM (SELECT location_key, day, 'google' AS source, 'cpc' AS medium, spend AS cost, 0 AS sessions, 0 AS forms, 0 AS booked
          FROM all_events WHERE event_type = 'click' AND location_key <> 7
          UNION ALL SELECT location_key, day, 'facebook', 'paid_social', spend, 0, 0, 0
          FROM all_events WHERE event_type = 'view' AND location_key <> 7
          UNION ALL SELECT location_key, day, 'google', 'organic', 0, CASE WHEN event_type = 'error' THEN 5 ELSE 0 END,
          CASE WHEN event_type = 'signup' THEN 2 ELSE 0 END, CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END
          FROM all_events WHERE event_type IN ('signup', 'purchase', 'error'))
    GROUP BY ALL"""
_ORGANIC = "max(CASE WHEN source = 'google' AND medium = 'organic' THEN 125.50 ELSE 0 END)"


@registered("feed_fold", f"""SELECT site_slug, month, utm_source, utm_medium, '(not set)' AS utm_campaign, {doubled('cost')},
    {bigint('sessions', 'form_submits', 'appts_booked')} FROM ({_FOLD.format(retainer='0')})""")
def feed_fold(spark, folder):
    return doubles(extracts.marketing_channels(_ad_feeds(spark, folder)))


@registered("retainer", f"""SELECT site_slug, utm_source, utm_medium, {doubled('cost')}
    FROM ({_FOLD.format(retainer=_ORGANIC)})""")
def retainer(spark, folder):
    channels = extracts.in_file_order(extracts.marketing_channels(_ad_feeds(spark, folder), "125.50"))
    return doubles(channels.select("site_slug", "utm_source", "utm_medium", "cost"))


@registered("event_metrics", f"""
    SELECT {MONTH.format(d='day')} AS month, 'site-' || location_key AS site_slug,
           count(*) FILTER (event_type = 'error') * 5 AS sessions, count(*) FILTER (event_type = 'signup') * 2 AS form_submits,
           count(*) FILTER (event_type = 'purchase') * 2 AS appts_booked
    FROM all_events WHERE event_type IN ('signup', 'purchase', 'error') GROUP BY ALL""")
def event_metrics(spark, folder):
    return _ad_feeds(spark, folder)[2].groupBy("month", "site_slug").agg(
        *[F.sum(c).alias(c) for c in ("sessions", "form_submits", "appts_booked")])


# --- translation and staging ------------------------------------------------------------------------

_LINE_SUMS = doubled("gross_production", "adjustments", "net_production")


@on_sample("stg_pms_procedures", f"""
    SELECT location_key, pms_system, appointment_id, patient_key, service_date, month, provider_type, status, cdt_code,
           procedure_category, is_new_patient_code, {_LINE_SUMS} FROM procedures""")
def stg_pms_procedures(s):
    return doubles(s.staged["stg_pms_procedures"])


@registered("conform_union", """
    SELECT pms_system, status, provider_type, count(*) AS n, CAST(sum(gross_production) AS DOUBLE) AS gross,
           CAST(sum(adjustments) AS DOUBLE) AS adjustments, min(service_date) AS first_day, max(service_date) AS last_day
    FROM all_procedures GROUP BY ALL""")
def conform_union(spark, folder):
    # through the seven vendor-named tables, one projection each
    s = Sample(spark, folder)
    raw = feeds.vendor_tables(publish.settled(s.practice["lines"]), "lines") | feeds.vendor_tables(publish.settled(s.practice["providers"]), "providers")
    conformed = conform.conform_lines(conform.gather(raw, "lines"), conform.gather(raw, "providers"))
    return doubles(conformed.groupBy(F.col("source_system").alias("pms_system"), "status", "provider_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fee").alias("gross"), F.sum("writeoff").alias("adjustments"),
        F.min("service_date").alias("first_day"), F.max("service_date").alias("last_day")))


@on_sample("crosswalk_inner", """
    SELECT location_key, count(*) AS n, CAST(sum(gross_production) AS DOUBLE) AS gross FROM procedures GROUP BY ALL""")
def crosswalk_inner(s):
    located = translate.to_location(s.practice["lines"], s.seeds["location_crosswalk"])
    return doubles(located.groupBy("location_key").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum(exprs.amount("fee")).alias("gross")))


@on_sample("rejects_of_feeds", """
    SELECT feed, count(*) AS row_count FROM (
        SELECT unnest(['rejects_timecards', 'rejects_ledger', 'rejects_inventory']) AS feed FROM all_supplied
        WHERE location_key = 7
        UNION ALL SELECT 'rejects_marketing' FROM all_events WHERE location_key = 7
        UNION ALL SELECT 'rejects_daily_ads' FROM all_events WHERE location_key = 7 AND event_type = 'view')
    GROUP BY ALL""")
def rejects_of_feeds(s):
    found = warehouse.business_rejects(s.raw, s.seeds)
    counts = [found[name].agg(F.lit(name).alias("feed"), F.count(F.lit(1)).alias("row_count")) for name in found]
    return reduce(DataFrame.unionByName, counts).where("row_count > 0")


@on_sample("crosswalk_rejects", """
    SELECT pms_system AS source_system, 'office-7' AS source_location, count(*) AS row_count,
           CAST(sum(gross_production) AS DOUBLE) AS gross FROM all_procedures WHERE location_key = 7 GROUP BY ALL""")
def crosswalk_rejects(s):
    rows = translate.rejected_rows(s.practice["lines"], s.seeds["location_crosswalk"])
    return doubles(rows.groupBy("source_system", "source_location").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(exprs.amount("fee")).alias("gross")))


@on_sample("code_map_default", """
    SELECT procedure_category, is_new_patient_code, count(*) AS n FROM procedures GROUP BY ALL""")
def code_map_default(s):
    return s.staged["stg_pms_procedures"].groupBy("procedure_category", "is_new_patient_code") \
        .agg(F.count(F.lit(1)).alias("n"))


@on_sample("code_map_two_keys", """
    SELECT channel, CASE channel WHEN 'Search' THEN TRUE WHEN 'Meta' THEN TRUE WHEN 'Organic' THEN FALSE
           WHEN 'Direct' THEN FALSE END AS is_paid, count(*) AS n FROM marketing GROUP BY ALL""")
def code_map_two_keys(s):
    return s.staged["stg_marketing"].groupBy("channel", "is_paid").agg(F.count(F.lit(1)).alias("n"))


@on_sample("provider_fallback", """
    SELECT pms_system, provider_type, count(*) AS n, CAST(sum(gross_production) AS DOUBLE) AS gross
    FROM procedures GROUP BY ALL""")
def provider_fallback(s):
    return doubles(s.staged["stg_pms_procedures"].groupBy("pms_system", "provider_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gross_production").alias("gross")))


@on_sample("visit_rollup", f"""
    SELECT location_key, pms_system, appointment_id, patient_key, service_date, month, provider_type, status,
           is_new_patient, {_LINE_SUMS} FROM appointments""")
def visit_rollup(s):
    return doubles(s.staged["stg_pms_appointments"])


@on_sample("payments_by_payer", """
    SELECT location_key, month, payer, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM payments GROUP BY ALL""")
def payments_by_payer(s):
    return doubles(s.staged["stg_pms_payments"].groupBy("location_key", "month", "payer").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")))


@registered("payments_union", """
    SELECT pms_system, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Insurance' ELSE 'Patient' END AS payer,
           count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount, min(day) AS first_day FROM visit_orders GROUP BY ALL""")
def payments_union(spark, folder):
    raw = feeds.vendor_tables(publish.settled(feeds.payment_rows(spark, folder)), "payments")
    paid = conform.conform_payments(conform.gather(raw, "payments"))
    return doubles(paid.groupBy(F.col("source_system").alias("pms_system"), "payer").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.min("paid_date").alias("first_day")))


@on_sample("labor_cost_rule", """
    SELECT location_key, month, job_code, role, is_clinical, earning_code, is_productive, is_overtime,
           account_no AS gl_account_no, CAST(sum(hours) AS DOUBLE) AS hours, CAST(sum(labor_cost) AS DOUBLE) AS labor_cost
    FROM labor GROUP BY ALL""")
def labor_cost_rule(s):
    return doubles(s.staged["stg_ukg_labor"].groupBy(
        "location_key", "month", "job_code", "role", "is_clinical", "earning_code", "is_productive", "is_overtime",
        "gl_account_no").agg(F.sum("hours").alias("hours"), F.sum("labor_cost").alias("labor_cost")))


@on_sample("signed_ledger", """
    SELECT location_key, month, account_no, account_title, category, is_opex, mart_source, count(*) AS n,
           CAST(sum(amount) AS DOUBLE) AS amount FROM ledger GROUP BY ALL""")
def signed_ledger(s):
    return doubles(s.staged["stg_sage_gl"].groupBy(
        "location_key", "month", "account_no", "account_title", "category", "is_opex", "mart_source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")))


@on_sample("inventory_value", """
    SELECT location_key, month, category, CAST(sum(supply_cost) AS DOUBLE) AS supply_cost,
           CAST(sum(on_hand_value) AS DOUBLE) AS on_hand_value, max(item_number)::VARCHAR AS last_item FROM inventory GROUP BY ALL""")
def inventory_value(s):
    return doubles(s.staged["stg_inventory"].groupBy("location_key", "month", "category").agg(
        F.sum("supply_cost").alias("supply_cost"), F.sum("on_hand_value").alias("on_hand_value"),
        F.max(F.col("item_number").cast("bigint")).cast("string").alias("last_item")))


@on_sample("marketing_two_feeds", """
    SELECT location_key, month, channel, campaign, CAST(sum(spend) AS DOUBLE) AS spend, sum(sessions)::BIGINT AS sessions,
           sum(form_leads)::BIGINT AS form_leads, sum(booked_appts)::BIGINT AS booked_appts FROM marketing GROUP BY ALL""")
def marketing_two_feeds(s):
    return doubles(s.staged["stg_marketing"].groupBy("location_key", "month", "channel", "campaign").agg(
        *[F.sum(c).alias(c) for c in ("spend", "sessions", "form_leads", "booked_appts")]))


# --- marts ------------------------------------------------------------------------------------------

_COUNTS = bigint("completed_visits", "no_shows", "scheduled", "new_patients")


@on_sample("opex_monthly", f"""
    SELECT location_key, month, category, account_no, account_title, source, {doubled('amount')} FROM opex""")
def opex_monthly(s):
    return doubles(s.marts["mart_opex_monthly"])


@on_sample("scorecard_monthly", f"""
    SELECT location_key, location_name, region, specialty, pms_system, month, {_COUNTS}, {bigint('leads', 'booked_from_marketing')},
           {doubled(*[m for m in (*marts.SCORECARD_MEASURES, 'operating_profit') if m not in
                      ('completed_visits', 'no_shows', 'scheduled', 'new_patients', 'leads', 'booked_from_marketing')])}
    FROM scorecard""")
def scorecard_monthly(s):
    return doubles(s.marts["mart_location_monthly"])


@on_sample("scorecard_weekly", f"""
    SELECT location_key, week, {_COUNTS}, {doubled('gross_production', 'net_production', 'collections', 'labor_cost',
                                                   'labor_hours', 'overtime_hours')} FROM weekly""")
def scorecard_weekly(s):
    return doubles(s.marts["mart_location_weekly"])


@on_sample("procedure_mix", """
    SELECT location_key, month, procedure_category, count(*) AS procedures, CAST(sum(gross_production) AS DOUBLE) AS gross_production
    FROM procedures WHERE status = 'completed' AND cdt_code IS NOT NULL GROUP BY ALL""")
def procedure_mix(s):
    return doubles(s.marts["mart_procedure_mix"])


@on_sample("marketing_channel_monthly", """
    SELECT location_key, month, channel, CAST(sum(spend) AS DOUBLE) AS spend, sum(sessions)::BIGINT AS sessions,
           sum(form_leads)::BIGINT AS leads, sum(booked_appts)::BIGINT AS booked FROM marketing GROUP BY ALL""")
def marketing_channel_monthly(s):
    return doubles(s.marts["mart_marketing_channel_monthly"])


_RECON = f"location_key, month, category, ops_source, {doubled('ops_amount', 'gl_amount', 'variance', 'variance_pct')}"


@on_sample("reconciliation", f"SELECT {_RECON} FROM recon")
def reconciliation(s):
    return doubles(s.marts["mart_reconciliation"])


def _recon(s: Sample, full: bool) -> DataFrame:
    return marts.reconciliation(s.staged["stg_pms_payments"], s.staged["stg_ukg_labor"], s.staged["stg_inventory"],
                                s.staged["stg_marketing"], s.staged["stg_sage_gl"], full)


@on_sample("reconciliation_full", f"SELECT {_RECON} FROM recon_full")
def reconciliation_full(s):
    return doubles(_recon(s, True))


@on_sample("operations_monthly", f"""
    SELECT location_key, location_name, region, specialty, month, category, {doubled('opex_amount', 'collections')},
           CAST(opex_amount AS DOUBLE) / nullif(CAST(collections AS DOUBLE), 0) AS pct_of_collections
    FROM (SELECT location_key, month, category, sum(amount) AS opex_amount FROM opex GROUP BY ALL)
    JOIN sites USING (location_key) LEFT JOIN (SELECT location_key, month, sum(collections) AS collections FROM dated GROUP BY ALL)
    USING (location_key, month)""")
def operations_monthly(s):
    return doubles(s.marts["mart_operations_monthly"])


# --- checks -----------------------------------------------------------------------------------------

def _problems(s: Sample, strict: bool) -> DataFrame:
    return warehouse.find_problems(s.raw, s.seeds, strict, s.practice)


@on_sample("dq_unmapped", "SELECT * FROM unmapped")
def dq_unmapped(s):
    return _problems(s, False)


@on_sample("dq_unmapped_strict", """
    SELECT * FROM unmapped
    UNION ALL SELECT 'status', pms_system, count(*) FROM procedures WHERE status IS NULL GROUP BY ALL
    UNION ALL SELECT 'ukg_earning', earning_code, count(*) FROM labor WHERE is_productive IS NULL GROUP BY ALL""")
def dq_unmapped_strict(s):
    return _problems(s, True)


@on_sample("doubled_ads", f"""
    SELECT location_key, month, {doubled('feed_spend', 'daily_spend')}
    FROM (SELECT location_key, month, sum(spend) AS feed_spend FROM channel_rows WHERE channel = 'Meta' GROUP BY ALL)
    JOIN (SELECT location_key, month, sum(spend) AS daily_spend FROM daily_rows GROUP BY ALL) USING (location_key, month)
    WHERE feed_spend <> 0 AND daily_spend <> 0""")
def doubled_ads(s):
    rows, daily = s.staged["stg_marketing"], F.col("campaign") == "daily"
    return doubles(checks.doubled_ads(rows.where(~daily), rows.where(daily)))


@on_sample("check_coverage", f"""
    SELECT location_key, month, {doubled('amount')} FROM (SELECT location_key, month, sum(amount) AS amount FROM opex GROUP BY ALL)
    ANTI JOIN (SELECT DISTINCT location_key, month FROM appointments) USING (location_key, month)""")
def check_coverage(s):
    return doubles(checks.without_visits(s.marts["mart_opex_monthly"], s.staged["stg_pms_appointments"]))


@on_sample("check_not_null", """
    SELECT * FROM (SELECT 'collections' AS column_name, count(*) FILTER (collections IS NULL) AS null_rows FROM scorecard
    UNION ALL SELECT 'marketing_spend', count(*) FILTER (marketing_spend IS NULL) FROM scorecard
    UNION ALL SELECT 'location_key', count(*) FILTER (location_key IS NULL) FROM scorecard) WHERE null_rows > 0""")
def check_not_null(s):
    return checks.nulls(s.marts["mart_location_monthly"], ["location_key", "collections", "marketing_spend"])


@on_sample("nulls_written", """
    SELECT * FROM (SELECT 'collections' AS column_name, count(*) FILTER (collections IS NULL) AS null_rows FROM scorecard
    UNION ALL SELECT 'marketing_spend', count(*) FILTER (marketing_spend IS NULL) FROM scorecard
    UNION ALL SELECT 'location_key', count(*) FILTER (location_key IS NULL) FROM scorecard) WHERE null_rows > 0""")
def nulls_written(s):
    # counted by the tasks that write the mart; the written mart is not read
    columns, spark = ["location_key", "collections", "marketing_spend"], s.delivered_lines.sparkSession
    mart, seen = checks.watched(s.marts["mart_location_monthly"], columns)
    mart.write.parquet(f"{shared_folder(spark)}/watched-{uuid.uuid4().hex}")
    counts = spark.createDataFrame(checks.counted("scorecard", columns, seen), checks.WRITE_COUNTS)
    return checks.nulls_written(counts, "scorecard", columns)


@registered("check_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def check_unique(spark, folder):
    return checks.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@registered("check_empty", """
    SELECT user_id, count(*) AS row_count FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY ALL""")
def check_empty(spark, folder):
    known = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return checks.strangers(table(spark, folder, "events"), known, "user_id")


@on_sample("check_tolerance", """
    SELECT category, CAST(sum(variance) AS DOUBLE) / nullif(CAST(sum(ops_amount) AS DOUBLE), 0) AS variance_pct
    FROM recon GROUP BY ALL HAVING abs(sum(variance) / nullif(CAST(sum(ops_amount) AS DOUBLE), 0)) > 0.01""")
def check_tolerance(s):
    return checks.beyond_tolerance(s.marts["mart_reconciliation"])


@on_sample("missing_sides", """
    SELECT category, count(*) FILTER (gl_amount IS NULL) AS without_ledger,
           count(*) FILTER (ops_source IS NULL) AS without_operations FROM recon_full GROUP BY ALL""")
def missing_sides(s):
    return checks.missing_sides(_recon(s, True))


@on_sample("build_summary", """
    SELECT 'unmapped values' AS item, kind AS name, CAST(count(*) AS DOUBLE) AS value FROM unmapped GROUP BY ALL
    UNION ALL SELECT 'variance percent', category, round(CAST(sum(variance) AS DOUBLE) / CAST(sum(ops_amount) AS DOUBLE) * 100, 2)
    FROM recon GROUP BY ALL""")
def build_summary(s):
    return warehouse.build_report(s.practice, s.raw, s.seeds)


# --- publishing -------------------------------------------------------------------------------------

def _joined(packed: DataFrame, columns: list[str]) -> DataFrame:
    """Arrays as comma-separated text, nulls spelled out, for comparing with SQL."""
    return packed.select(*[c for c in packed.columns if c not in columns],
                         *[F.concat_ws(",", F.transform(c, lambda v: F.coalesce(v.cast("string"), F.lit("null"))))
                           .alias(c) for c in columns])


_ARRAYS = """string_agg(coalesce(CAST({v} AS VARCHAR), 'null'), ',' ORDER BY {order}) AS {c}"""


def _arrays(order: str, **columns: str) -> str:
    return ", ".join(_ARRAYS.format(v=v, c=c, order=order) for c, v in columns.items())


def _as_published(name: str) -> dict[str, str]:
    """SQL of a document's measures: decimals as many as it shows, zero for what it never leaves null."""
    spec = publish.DATASETS[name]
    value = {c: f"coalesce({c}, 0)" if c in spec.get("zero", []) else c for c in spec["columns"]}
    return {c: value[c] if scale is None else f"CAST({value[c]} AS DECIMAL(28,{scale}))"
            for c, scale in spec["columns"].items() if c not in ("month", "week", "location_key")}


_CHUNK = """CAST(floor(((year(last) - year(month)) * 12 + month(last) - month(month)) / 6) AS INTEGER) AS chunk"""
_KEPT_MONTHS = f"(SELECT *, {_CHUNK} FROM {{t}}, (SELECT min(month) AS first, max(month) AS last FROM {{t}} WHERE location_key < 20) WHERE location_key < 20)"


@on_sample("pack_monthly", f"""
    SELECT chunk, 0 AS block, {_arrays("s.month, location_key", month="strftime(s.month, '%Y-%m')", location_key='location_key',
        **_as_published("monthly"))}
    FROM {_KEPT_MONTHS.format(t='scorecard')} s GROUP BY chunk""")
def pack_monthly(s):
    packed = publish.dataset("monthly", publish.settled(s.marts["mart_location_monthly"]), first_test_key=20)
    return _joined(packed, list(publish.DATASETS["monthly"]["columns"]))


@on_sample("pack_recon", f"""
    SELECT chunk, 0 AS block, {_arrays("s.month, location_key, category", location_key='location_key',
        month="strftime(s.month, '%Y-%m')", category='category', ops_source='ops_source',
        ops_amount='CAST(coalesce(ops_amount, 0) AS DECIMAL(28,2))', gl_amount='CAST(coalesce(gl_amount, 0) AS DECIMAL(28,2))')}
    FROM {_KEPT_MONTHS.format(t='recon')} s GROUP BY chunk""")
def pack_recon(s):
    packed = publish.dataset("recon", publish.settled(s.marts["mart_reconciliation"]), first_test_key=20)
    return _joined(packed, list(publish.DATASETS["recon"]["columns"]))


@on_sample("pack_mix", f"""
    SELECT chunk, 0 AS block, {_arrays("s.month, location_key, procedure_category", location_key='location_key',
        month="strftime(s.month, '%Y-%m')", cat='procedure_category', prod='CAST(gross_production AS DECIMAL(28,0))')}
    FROM {_KEPT_MONTHS.format(t='mix')} s GROUP BY chunk""")
def pack_mix(s):
    packed = publish.dataset("mix", publish.settled(s.marts["mart_procedure_mix"]), first_test_key=20)
    return _joined(packed, list(publish.DATASETS["mix"]["columns"]))


@on_sample("pack_weekly", f"""
    SELECT 0 AS chunk, 0 AS block, {_arrays("week, location_key", week="strftime(week, '%Y-%m-%d')", location_key='location_key',
        **_as_published("weekly"))}
    FROM weekly, (SELECT CAST(date_trunc('week', max(service_date) + 1) AS DATE) - 7 AS last FROM appointments)
    WHERE week IN (last, last - 7, last - 364) AND location_key < 20""")
def pack_weekly(s):
    weeks = publish.last_full_weeks(s.marts["mart_location_weekly"], s.staged["stg_pms_procedures"])
    return _joined(publish.dataset("weekly", weeks, first_test_key=20), list(publish.DATASETS["weekly"]["columns"]))


@on_sample("unpack_rows", """
    SELECT location_key, strftime(month, '%Y-%m') AS month, channel, CAST(sum(spend) AS DOUBLE) AS spend,
           sum(form_leads)::BIGINT AS leads, sum(booked_appts)::BIGINT AS booked
    FROM marketing WHERE location_key < 20 GROUP BY ALL""")
def unpack_rows(s):
    # mart -> arrays -> JSON text -> rows
    columns = list(publish.DATASETS["channels"]["columns"])
    packed = publish.dataset("channels", publish.settled(s.marts["mart_marketing_channel_monthly"]), first_test_key=20)
    documents = publish.to_document(packed, columns)
    arrays = packed.select(*columns).schema
    return doubles(publish.from_document(documents, arrays, ["chunk", "block"]).select(*columns))


@registered("dictionary_encode", """
    SELECT p_type, p_brand, (row_number() OVER (ORDER BY p_type, p_brand)) - 1 AS i, min(p_name) AS p_name, count(*) AS uses
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type, p_brand""")
def dictionary_encode(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    used = table(spark, folder, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"))
    entries = publish.dictionary(used, ["p_type", "p_brand"], ["p_name"])
    uses = publish.encode(used, entries, ["p_type", "p_brand"]).groupBy("i").agg(F.count(F.lit(1)).alias("uses"))
    return entries.join(uses, "i")


@registered("dictionary_kept", """
    SELECT p_type, p_brand, (row_number() OVER (ORDER BY first_use, p_type, p_brand)) - 1 AS i, uses
    FROM (SELECT p_type, p_brand, min(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 0 ELSE 1 END) AS first_use, count(*) AS uses
          FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type, p_brand)""")
def dictionary_kept(spark, folder):
    # a first build meets some of the parts, the second all: the entries of the first keep their places
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_brand", "p_name")
    used = table(spark, folder, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"))
    name, keys = f"dictionary_{uuid.uuid4().hex}", ["p_type", "p_brand"]
    first = used.where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7))
    for facts in (first, used):
        entries = publish.kept_dictionary(facts, keys, ["p_name"], name)
    uses = publish.encode(used, entries, keys).groupBy("i").agg(F.count(F.lit(1)).alias("uses"))
    return entries.join(uses, "i").select(*keys, "i", "uses")


@registered("publish_changed", f"""
    SELECT CAST(floor((year(o_orderdate) * 12 + month(o_orderdate) - 1) / 6) AS INTEGER) AS chunk, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           max({MONTH.format(d='o_orderdate')}) = (SELECT max({MONTH.format(d='o_orderdate')}) FROM orders) AS rewritten
    FROM orders GROUP BY 1""")
def publish_changed(spark, folder):
    # months published without the newest one, then with it: which chunks are written again, and what all hold
    per = table(spark, folder, "orders").groupBy(exprs.month_of("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(money("o_totalprice")).alias("total"))
    months = publish.settled(publish.calendar_chunks(per))
    path, newest = f"{shared_folder(spark)}/published-{uuid.uuid4().hex}", F.lit(months.agg(F.max("month")).first()[0])
    for some in (months.where(F.col("month") < newest), months):
        packed = publish.pack(some.withColumn("month", exprs.month_text("month")), ["chunk"], ["month"], ["month", "orders", "total"])
        again = publish.write_changed(packed, path, ["chunk"])
    held = spark.read.schema("month array<string>, orders array<bigint>, total array<decimal(28,2)>, chunk int").json(path)
    rows = publish.unpack(held, ["chunk"], ["month", "orders", "total"])
    sums = rows.groupBy("chunk").agg(F.sum("orders").alias("orders"), F.sum("total").alias("total"))
    return doubles(sums.join(again.withColumn("rewritten", F.lit(True)), "chunk", "left").na.fill(False, ["rewritten"]))


@on_sample("opex_documents", f"""
    SELECT chunk, 0 AS block, {_arrays("o.month, o.location_key, i", k='o.location_key',
        m='(year(o.month) - year(o.first)) * 12 + month(o.month) - month(o.first)', i='i', amt='CAST(round(amount) AS DECIMAL(28,0))')}
    FROM {_KEPT_MONTHS.format(t='opex')} o
    JOIN (SELECT *, (row_number() OVER (ORDER BY account_no, source)) - 1 AS i
          FROM (SELECT DISTINCT account_no, source FROM opex WHERE location_key < 20)) USING (account_no, source)
    GROUP BY chunk""")
def opex_documents(s):
    _, packed = publish.opex_documents(publish.settled(s.marts["mart_opex_monthly"]), first_test_key=20)
    return _joined(packed.drop("first_month"), ["k", "m", "i", "amt"])


@on_sample("account_entries", """
    SELECT CAST(row_number() OVER (ORDER BY account_no, source) - 1 AS BIGINT) AS i,
           concat_ws('|', account_no, min(account_title), min(category), source) AS entry
    FROM opex WHERE location_key < 20 GROUP BY account_no, source""")
def account_entries(s):
    entries, _ = publish.opex_documents(publish.settled(s.marts["mart_opex_monthly"]), first_test_key=20)
    return entries.select(F.col("i").cast("bigint").alias("i"), publish.entry_text(
        ["account_no", "account_title", "category", "source"]).alias("entry"))


@registered("chunk_months", """
    SELECT chunk, min(month_index)::INTEGER AS first_index, max(month_index)::INTEGER AS last_index, count(*) AS orders FROM (
        SELECT CAST(floor(((year(last) - year(o_orderdate)) * 12 + month(last) - month(o_orderdate)) / 6) AS INTEGER) AS chunk,
               (year(o_orderdate) - year(first)) * 12 + month(o_orderdate) - month(first) AS month_index
        FROM orders, (SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders)) GROUP BY ALL""")
def chunk_months(spark, folder):
    months = table(spark, folder, "orders").select(exprs.month_of("o_orderdate").alias("month"))
    return publish.chunked(months).groupBy("chunk").agg(
        F.min("month_index").alias("first_index"), F.max("month_index").alias("last_index"),
        F.count(F.lit(1)).alias("orders"))


@on_sample("last_full_weeks", f"""
    SELECT location_key, week, {_COUNTS}, {doubled('gross_production', 'collections', 'labor_cost')}
    FROM weekly, (SELECT CAST(date_trunc('week', max(service_date) + 1) AS DATE) - 7 AS last FROM appointments)
    WHERE week IN (last, last - 7, last - 364)""")
def last_full_weeks(s):
    weeks = publish.last_full_weeks(s.marts["mart_location_weekly"], s.staged["stg_pms_procedures"])
    return doubles(weeks.select("location_key", "week", "completed_visits", "no_shows", "scheduled", "new_patients",
                                "gross_production", "collections", "labor_cost"))


@on_sample("exclude_test_site", """
    SELECT location_key, strftime(month, '%Y-%m') AS month, scheduled, round(CAST(collections AS DOUBLE), 2) AS collections,
           round(CAST(total_opex AS DOUBLE), 2) AS total_opex FROM scorecard WHERE location_key < 20""")
def exclude_test_site(s):
    # row-oriented document: no test sites, no dimension columns, amounts in cents
    shown = s.marts["mart_location_monthly"].select("location_key", "location_name", "region", "month", "scheduled",
                                                    "collections", "total_opex")
    return publish.as_rows(shown, ["location_name", "region"], first_test_key=20)


@on_sample("rows_mix", """
    SELECT location_key AS location, strftime(month, '%Y-%m') AS month, procedure_category AS cat,
           round(CAST(gross_production AS DOUBLE), 2) AS prod FROM mix""")
def rows_mix(s):
    return doubles(warehouse.row_documents(s.marts)["mix_rows"])


@on_sample("rows_locations", """
    SELECT location_key, location_name, region, specialty, CAST(location_key % 5 + 3 AS INTEGER) AS operatories, pms_system
    FROM sites WHERE location_key < 99""")
def rows_locations(s):
    return publish.site_rows(s.seeds["dim_location"])


@on_sample("opex_unpacked", f"""
    SELECT location_key, strftime(month, '%Y-%m') AS month, account_no, account_title, category, source,
           CAST(round(amount) AS DOUBLE) AS amount FROM opex WHERE location_key < 20""")
def opex_unpacked(s):
    mart = publish.settled(s.marts["mart_opex_monthly"])
    entries, packed = publish.opex_documents(mart, first_test_key=20)
    return doubles(publish.opex_rows(entries, packed))


# --- reports ----------------------------------------------------------------------------------------

def _statement(s: Sample) -> DataFrame:
    return reports.profit_and_loss(s.marts["mart_opex_monthly"], s.staged["stg_pms_payments"],
                                   s.staged["stg_sage_gl"], s.seeds["dim_location"])


_STATEMENT = """
    SELECT month, line, region, location_key, CASE grouping_id(month, line, region, location_key)
           WHEN 0 THEN 'site' WHEN 1 THEN 'region' ELSE 'group' END AS level, sum(amount) AS amount
    FROM (SELECT location_key, month, 'Collections' AS line, amount FROM payments
          UNION ALL SELECT location_key, month, 'Refunds', amount FROM ledger WHERE account_no = '4900'
          UNION ALL SELECT location_key, month, category, amount FROM opex) JOIN sites USING (location_key)
    GROUP BY GROUPING SETS ((month, line, region, location_key), (month, line, region), (month, line))"""


@on_sample("pnl_rollup", f"SELECT month, line, region, location_key, level, {doubled('amount')} FROM ({_STATEMENT})")
def pnl_rollup(s):
    return doubles(_statement(s))


@on_sample("pnl_margin", f"""
    SELECT month, level, region, location_key, {doubled('revenue', 'expenses')}, CAST(revenue - expenses AS DOUBLE) AS profit,
           CAST(revenue - expenses AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0) AS margin
    FROM (SELECT month, level, region, location_key,
                 sum(CASE WHEN line IN ('Collections', 'Refunds') THEN amount ELSE 0 END) AS revenue,
                 sum(CASE WHEN line IN ('Collections', 'Refunds') THEN 0 ELSE amount END) AS expenses
          FROM ({_STATEMENT}) GROUP BY ALL)""")
def pnl_margin(s):
    return doubles(reports.profit_margin(_statement(s)))


def _compared(period: str, source: str, previous: str, year: str) -> str:
    change = "CAST(a.{m} - {t}.{m} AS DOUBLE) / nullif(CAST({t}.{m} AS DOUBLE), 0) AS {m}_{n}_change"
    names = [change.format(m=m, t=t, n=n) for t, n in (("b", "prev"), ("c", "year")) for m in ("collections", "scheduled")]
    return f"""
    SELECT a.location_key, a.{period}, CAST(a.collections AS DOUBLE) AS collections, a.scheduled,
           CAST(b.collections AS DOUBLE) AS collections_prev, b.scheduled AS scheduled_prev,
           CAST(c.collections AS DOUBLE) AS collections_year, c.scheduled AS scheduled_year, {', '.join(names)}
    FROM {source} a LEFT JOIN {source} b ON b.location_key = a.location_key AND b.{period} = {previous}
    LEFT JOIN {source} c ON c.location_key = a.location_key AND c.{period} = {year}"""


@on_sample("period_compare_month", _compared("month", "scorecard", "a.month - to_months(1)", "a.month - to_months(12)"))
def period_compare_month(s):
    return doubles(reports.compare_months(s.marts["mart_location_monthly"], ["collections", "scheduled"]))


@on_sample("period_compare_week", _compared("week", "weekly", "a.week - 7", "a.week - 364"))
def period_compare_week(s):
    return doubles(reports.compare_weeks(s.marts["mart_location_weekly"], ["collections", "scheduled"]))


_RATIOS = ", ".join(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0) AS {name}"
                    for name, (a, b) in reports.RATIOS.items())


@on_sample("site_ratios", f"SELECT location_key, month, {_RATIOS} FROM scorecard")
def site_ratios(s):
    return reports.site_ratios(s.marts["mart_location_monthly"])


@on_sample("alerts", f"""
    SELECT location_key, month, metric, round(value, 6) AS value, round(mean, 6) AS mean,
           round((value - mean) / nullif(deviation, 0), 4) AS score
    FROM (SELECT *, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS deviation
          FROM (UNPIVOT (SELECT location_key, month, {_RATIOS} FROM scorecard)
                ON {', '.join(reports.RATIOS)} INTO NAME metric VALUE value)
          WINDOW w AS (PARTITION BY month, metric))
    WHERE abs((value - mean) / nullif(deviation, 0)) > 2.5 OR (metric = 'no_show_rate' AND value > 0.8)
          OR (metric = 'collection_rate' AND value < 0.2)""")
def alerts(s):
    ratios = publish.settled(reports.site_ratios(s.marts["mart_location_monthly"]))
    found = reports.alerts(ratios, 2.5, {"no_show_rate": 0.8}, {"collection_rate": 0.2})
    return found.select("location_key", "month", "metric", F.round("value", 6).alias("value"),
                        F.round("mean", 6).alias("mean"), F.round("score", 4).alias("score"))
