"""Source-side extracts as Spark jobs over landed source tables.

Each returns the columns its landing file has, under the vendor's names. ``since`` is a date or an
ISO text; a filter on it reaches the scan or the database.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewell.functions import exprs
from sitewell.operators import checks
from sitewell.sources.landing import since_window

# Status codes of the source databases and the text styles they print dates in.
PROC_COMPLETE, VISIT_COMPLETE, VISIT_MISSED_OR_OPEN = 2, 2, [3, 5]
CHART_COMPLETE = 102
DATETIME_TEXT, US_DATE_TEXT = "yyyy-MM-dd HH:mm:ss.SSS", "MM/dd/yyyy"


def open_dental_procedures(procedures: DataFrame, codes: DataFrame, appointments: DataFrame,
                           claims: DataFrame, since) -> DataFrame:
    """Completed procedures with fee, write-off and visit status, and the visits that were missed
    or never rescheduled as lines without code and fee.

    Claims are summed per procedure before the join, so each procedure stays one row. Procedures
    without a visit may all carry appointment 0; that hot key meets no row and is split by the
    adaptive skew join like any other.
    """
    done = since_window(procedures.where(F.col("ProcStatus") == PROC_COMPLETE), "ProcDate", since)
    written_off = claims.groupBy("ProcNum").agg(F.sum("WriteOff").alias("WriteOff"))
    lines = (done.join(codes.select("CodeNum", "ProcCode"), "CodeNum")
             .join(appointments.select("AptNum", "AptStatus"), "AptNum", "left")
             .join(written_off, "ProcNum", "left")
             .select("ProcNum", "AptNum", "PatNum", "ProcDate", "ProvNum", "ProcCode",
                     (F.col("ProcFee") * F.greatest(F.col("UnitQty"), F.lit(1))).alias("ProcFee"),
                     F.coalesce("WriteOff", F.lit(0)).alias("WriteOff"),
                     F.coalesce("AptStatus", F.lit(VISIT_COMPLETE)).alias("AptStatus")))
    open_visits = since_window(appointments.where(F.col("AptStatus").isin(VISIT_MISSED_OR_OPEN)), "AptDateTime",
                               since)
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    empty = open_visits.select(
        F.lit(0).cast(kinds["ProcNum"]).alias("ProcNum"), "AptNum", "PatNum",
        F.col("AptDateTime").cast("date").alias("ProcDate"), "ProvNum", F.lit("").alias("ProcCode"),
        F.lit(0).cast(kinds["ProcFee"]).alias("ProcFee"), F.lit(0).cast(kinds["WriteOff"]).alias("WriteOff"),
        "AptStatus")
    return lines.unionByName(empty)


def open_dental_payments(payments: DataFrame, claim_payments: DataFrame, since) -> DataFrame:
    patient = since_window(payments, "PayDate", since).select("PayDate", F.lit("Patient").alias("PayType"), "PayAmt")
    insurer = since_window(claim_payments, "CheckDate", since).select(
        F.col("CheckDate").alias("PayDate"), F.lit("Insurance").alias("PayType"), F.col("CheckAmt").alias("PayAmt"))
    return patient.unionByName(insurer)


def open_dental_providers(providers: DataFrame, office: str | None = None) -> DataFrame:
    """Providers that are shown; ``office`` names the column that holds the office, if rows carry it."""
    stamp = [] if office is None else [F.col(office).alias("ClinicNum")]
    return providers.where(F.col("IsHidden") == 0).select("ProvNum", "IsSecondary", *stamp)


def stamped(offices: dict[str, DataFrame], name: str = "ClinicNum") -> DataFrame:
    """One database per office: union them, each row carrying its office code."""
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.lit(code)) for code, df in offices.items()])


def dentrix_procedures(log: DataFrame, clinics: DataFrame, appointments: DataFrame, since) -> DataFrame:
    status = F.when(F.col("chart_status") == CHART_COMPLETE, "C").when(F.col("broken") == 1, "B").otherwise("D")
    return (since_window(log, "proc_date", since).join(clinics.select("clinic_id"), "clinic_id")
            .join(appointments.select("appt_id", "broken"), "appt_id", "left")
            .select(F.col("clinic_id").alias("ClinicID"), F.col("appt_id").alias("ApptID"),
                    F.col("patient_guid").alias("PatGUID"),
                    F.date_format("proc_date", DATETIME_TEXT).alias("ProcDate"), F.col("prov_id").alias("ProvID"),
                    F.col("ada_code").alias("ADACode"), F.col("amount").alias("Amt"),
                    F.col("adjustment_amount").alias("AdjAmt"), status.alias("ApptStatus")))


def dentrix_payments(payments: DataFrame, since) -> DataFrame:
    return since_window(payments, "trans_date", since).select(
        F.col("clinic_id").alias("ClinicID"), F.date_format("trans_date", DATETIME_TEXT).alias("TransDate"),
        F.when(F.col("is_insurance") == 1, "InsPayment").otherwise("PatPayment").alias("TransType"),
        F.col("amount").alias("Amount"))


def dentrix_providers(providers: DataFrame) -> DataFrame:
    return providers.select(F.col("prov_id").alias("ProvID"), F.col("clinic_id").alias("ClinicID"),
                            F.when(F.col("is_hygienist") == 1, "Hygienist").otherwise("Dentist").alias("ProvType"))


def dolphin_procedures(visits: DataFrame, offices: DataFrame, patients: DataFrame, transactions: DataFrame,
                       since) -> DataFrame:
    return (since_window(visits, "visit_date", since)
            .join(offices.select("office_id", "office_code"), "office_id")
            .join(patients.select("patient_id"), "patient_id")
            .join(transactions.select("visit_id", "ada_code", "fee", "adjustment"), "visit_id", "left")
            .select("office_code", "visit_id", F.col("patient_id").alias("patient_ref"),
                    F.date_format("visit_date", US_DATE_TEXT).alias("service_date"), "provider_code", "ada_code",
                    F.col("fee").alias("fee_usd"), F.col("adjustment").alias("contractual_adj"),
                    exprs.words_to("status", {"kept": "C", "missed": "NS"}, "X").alias("status")))


def dolphin_payments(payments: DataFrame, offices: DataFrame, since) -> DataFrame:
    return (since_window(payments, "posted_date", since)
            .join(offices.select("office_id", "office_code"), "office_id")
            .select("office_code", F.date_format("posted_date", US_DATE_TEXT).alias("posted"),
                    exprs.words_to("payer_type", {"insurance": "INS"}, "PAT").alias("source"), "amount"))


def dolphin_providers(doctors: DataFrame, offices: DataFrame) -> DataFrame:
    return doctors.join(offices.select("office_id", "office_code"), "office_id") \
        .select("provider_code", "office_code", "credential")


def flatten_json(pages: DataFrame, text: str, fields: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Rows of API pages: {landing column: dotted path into an item}. A page is ``{"data": [...]}``
    or a bare list; a path that leads nowhere is null. Values stay text. A page that is not JSON, or
    whose ``data`` is something other than a list, fails with its beginning; one without ``data`` is
    empty, see :func:`pages_without_data`."""
    body = F.ltrim(text)
    data = F.get_json_object(body, "$.data")
    # a torn page has no readable shape; json_array_length is null for whatever is not a list
    torn = F.try_parse_json(body).isNull()
    listed = F.when(body.startswith("["), body).otherwise(data)
    wrong = listed.isNotNull() & F.json_array_length(listed).isNull()
    loud = F.when(torn | wrong, F.raise_error(F.concat(F.lit("not a page of items: "), F.substring(F.coalesce(body, F.lit("")), 1, 200)))
                  ).otherwise(listed)
    items = F.from_json(loud, T.ArrayType(T.StringType()))
    exploded = pages.select(*(keep or []), F.explode(items).alias("_item"))
    return exploded.select(*(keep or []), *[json_path("_item", path).alias(name) for name, path in fields.items()])


def pages_without_data(pages: DataFrame, text: str) -> DataFrame:
    """(row_count) of pages that hold no ``data`` at all, such as an error envelope; empty when there are none."""
    body = F.ltrim(text)
    bare = ~body.startswith("[") & F.get_json_object(body, "$.data").isNull()
    return pages.where(bare).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0")


def json_path(text: str | Column, path: str) -> Column:
    return F.get_json_object(text, "$" + "".join(f"['{part}']" for part in path.split(".")))


def flatten_xml(pages: DataFrame, text: str, record: str, columns: list[str]) -> DataFrame:
    """Records of ledger pages as text rows. An element a record lacks is null; a page whose status
    is not ``success`` fails the job with the message it carries."""
    fields = ", ".join(f"{c} string" for c in columns)
    page = F.from_xml(text, f"result struct<status string, data struct<{record}: array<struct<{fields}>>>, "
                            "errormessage struct<error: struct<description2: string>>>", {"rowTag": "response"})
    result = page["result"]
    message = F.coalesce(result["errormessage"]["error"]["description2"], F.lit("no success status"))
    records = F.when(result["status"] == "success", result["data"][record]) \
        .otherwise(F.raise_error(F.concat(F.lit("ledger page failed: "), message)))
    return pages.select(F.inline(records))


def xml_pieces(spark: SparkSession, path: str | list[str], record: str) -> DataFrame:
    """(file, value): files of ledger pages cut behind each record. The text reader cuts at any separator and
    reads a file in splits, so a page may be larger than what one task reads."""
    return spark.read.text(path, lineSep=f"</{record}>").select(F.col("_metadata.file_path").alias("file"), "value")


def xml_page_faults(pieces: DataFrame, page: str = "response") -> DataFrame:
    """(file, message) of files that are not one whole page with status ``success``; empty when all are. Counts
    and words of a file's pieces are folded before they meet. The status is looked for outside ``data``, so a
    record's own field of that name is not taken for it."""
    begins, ends = F.col("value").contains(f"<{page}"), F.col("value").contains(f"</{page}>")
    head = F.when(begins, F.substring_index(F.substring_index("value", "<data", 1), "<result", -1))
    tail = F.when(F.col("value").contains("</data>"), F.substring_index("value", "</data>", -1))
    outside = F.concat_ws(" ", head, tail)

    def word(tag: str) -> Column:
        return F.max(F.nullif(F.regexp_extract(outside, rf"(?s)<{tag}>\s*([^<]*?)\s*</{tag}>", 1), F.lit("")))

    files = pieces.groupBy("file").agg(
        F.sum(F.regexp_count("value", F.lit(rf"<{page}[\s>]"))).alias("begun"), F.count_if(ends).alias("ended"),
        word("status").alias("status"), word("description2").alias("said"))
    message = F.when((F.col("begun") != 1) | (F.col("ended") != 1), "not one whole page").when(
        F.coalesce(F.col("status") != "success", F.lit(True)), F.coalesce("said", F.lit("no success status")))
    return files.select("file", message.alias("message")).where("message IS NOT NULL")


def read_xml(spark: SparkSession, path: str | list[str], record: str, columns: list[str], page: str = "response") -> DataFrame:
    """Records of files of ledger pages as text rows, the rows :func:`flatten_xml` gives for the same pages, but
    a file is read in splits. One page per file; a record's closing tag stands in no comment or CDATA.

    One job over the files first folds what their statuses and ends say: an unsuccessful or torn page fails
    with its message before any row is handed out. Pieces that do not parse fail when they are read."""
    pieces = xml_pieces(spark, path, record)
    checks.expect_empty(xml_page_faults(pieces, page), "ledger pages")
    # what follows the last closing tag of a page can still hold records of a single, self-closing tag
    last = F.regexp_extract("value", rf"(?s)((?:<{record}(?:\s[^<>]*)?/>\s*)+)", 1)
    rest = F.regexp_extract("value", rf"(?s)(<{record}[\s/>].*)", 1)
    body = F.when(F.col("value").contains(f"</{page}>"), last).when(rest != "", F.concat(rest, F.lit(f"</{record}>")))
    fields = ", ".join(f"{c} string" for c in columns)
    parsed = F.from_xml(F.concat(F.lit("<piece>"), body, F.lit("</piece>")), f"{record} array<struct<{fields}>>",
                        {"rowTag": "piece", "mode": "FAILFAST"})
    return pieces.where(F.coalesce(body, F.lit("")) != "").select(F.inline(parsed[record]))


# --- marketing: three feeds folded to one row per site, month, source and medium -------------------

CHANNEL_KEYS = ["site_slug", "month", "utm_source", "utm_medium"]
# Campaign name where a feed has none, and the events that count.
NO_CAMPAIGN, SESSION_EVENT, FORM_EVENT, BOOKED_EVENT = \
    "(not set)", "session_start", "generate_lead", "appointment_booked"
SITE_TAG = r"\[([a-z0-9-]+)\]"


def tagged(campaigns: DataFrame, name: str, tag: str = SITE_TAG) -> DataFrame:
    """Add ``site_slug`` from the tag in the campaign name; untagged campaigns leave."""
    return campaigns.withColumn("site_slug", F.regexp_extract(name, tag, 1)).where(F.col("site_slug") != "")


def search_ads(campaigns: DataFrame) -> DataFrame:
    """campaign_name, month, cost_micros -> cost of (google, cpc)."""
    return tagged(campaigns, "campaign_name").select(
        "site_slug", F.col("month").cast("date").alias("month"), F.lit("google").alias("utm_source"),
        F.lit("cpc").alias("utm_medium"),
        (F.col("cost_micros").cast("decimal(20,0)") / F.lit(1000000)).cast(exprs.AMOUNT).alias("cost"))


def social_ads(campaigns: DataFrame) -> DataFrame:
    """campaign_name, spend, date_start -> cost of (facebook, paid_social) by month."""
    return tagged(campaigns, "campaign_name").select(
        "site_slug", exprs.month_of(F.col("date_start").cast("date")).alias("month"),
        F.lit("facebook").alias("utm_source"), F.lit("paid_social").alias("utm_medium"),
        exprs.amount(F.coalesce(F.col("spend").cast("string"), F.lit("0"))).alias("cost"))


def web_analytics(report: DataFrame, form_event: str = FORM_EVENT, booked_event: str = BOOKED_EVENT) -> DataFrame:
    """Sessions, form submissions and bookings. The report repeats a visit's sessions on each of its
    events, so only the session-start rows carry them."""
    event = F.col("event_name")

    def metric(of: str, value: str, name: str) -> Column:
        return F.when(event == of, F.col(value).cast("bigint")).otherwise(F.lit(0)).alias(name)

    return report.select("site_slug", exprs.parse_date("year_month", "period").alias("month"),
                         F.col("session_source").alias("utm_source"), F.col("session_medium").alias("utm_medium"),
                         metric(SESSION_EVENT, "sessions", "sessions"),
                         metric(form_event, "event_count", "form_submits"),
                         metric(booked_event, "event_count", "appts_booked"))


def marketing_channels(feeds: list[DataFrame], retainer: float | str = 0) -> DataFrame:
    """Fold feeds to one row per site, month, source and medium. A monthly retainer is added to the
    cost of google/organic rows."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)
    folded = together.groupBy(*CHANNEL_KEYS).agg(
        F.coalesce(F.sum("cost"), F.lit(0)).alias("cost"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sessions", "form_submits", "appts_booked")])
    organic = (F.col("utm_source") == "google") & (F.col("utm_medium") == "organic")
    fee = F.lit(str(retainer)).cast(exprs.AMOUNT)
    return folded.select(*CHANNEL_KEYS, F.lit(NO_CAMPAIGN).alias("utm_campaign"),
                         F.when(organic, F.col("cost") + fee).otherwise(F.col("cost")).alias("cost"),
                         "sessions", "form_submits", "appts_booked")


def in_file_order(channels: DataFrame) -> DataFrame:
    """The order of the landing file; only an export needs it."""
    return channels.orderBy(*CHANNEL_KEYS)
