"""Seven practice systems, one shape.

Each system is one entry of SYSTEMS: which delivered column holds which field, how it writes
dates, and which words it uses. Conforming is then two steps that do not depend on how many
systems there are: a projection per feed (:func:`gather`), and one translation over the union.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewell.functions import exprs

LINE_FIELDS = ("source_location", "appointment", "patient", "service_date", "provider_id",
               "code", "fee", "writeoff", "status_word")
PAYMENT_FIELDS = ("source_location", "paid_date", "payer_word", "amount")
PROVIDER_FIELDS = ("source_location", "provider_id", "type_word")


@dataclass(frozen=True)
class System:
    """How one system delivers. Column tuples follow LINE_FIELDS, PAYMENT_FIELDS, PROVIDER_FIELDS."""

    folder: str
    lines: tuple[str, ...]
    payments: tuple[str, ...]
    dates: str
    status: dict[str, str]
    insurance: str
    id_prefix: str = ""
    providers: tuple[str, ...] | None = None
    hygienist: str | None = None
    provider_per_site: bool = True


# Delivered column names, date layouts, id prefixes and words of each system.
SYSTEMS = {
    "open_dental": System(
        folder="pms_open_dental",
        lines=("clinic_num", "apt_num", "pat_num", "proc_date", "prov_num", "proc_code", "proc_fee",
               "write_off", "apt_status"),
        payments=("clinic_num", "pay_date", "pay_type", "pay_amt"),
        providers=("clinic_num", "prov_num", "is_secondary"),
        dates="iso", id_prefix="OD-", hygienist="1", insurance="Insurance",
        status={"2": "completed", "5": "no_show", "3": "cancelled"}),
    "dentrix_ascend": System(
        folder="pms_dentrix_ascend",
        lines=("location_id", "appointment_id", "patient_id", "procedure_date", "provider_id", "ada_code",
               "fee", "adjustment_total", "appointment_status"),
        payments=("location_id", "transaction_date", "transaction_type", "amount"),
        providers=("location_id", "provider_id", "provider_type"),
        dates="iso_prefix", hygienist="HYGIENIST", insurance="INSURANCE_PAYMENT", provider_per_site=False,
        status={"COMPLETE": "completed", "BROKEN": "no_show", "CANCELLED": "cancelled"}),
    "sensei": System(
        folder="pms_sensei",
        lines=("practice", "appointment_no", "patient_no", "date_of_service", "provider", "procedure",
               "charge", "adj", "appt_status"),
        payments=("practice", "date_col", "transaction_type", "amount"),
        providers=("practice", "provider", "provider_type"),
        dates="day_mon_year", id_prefix="SN-", hygienist="Hygienist", insurance="Insurance Payment",
        status={"Completed": "completed", "No Show": "no_show", "Canceled": "cancelled"}),
    "dolphin": System(
        folder="pms_dolphin",
        lines=("office_code", "visit_id", "patient_ref", "service_date", "provider_code", "ada_code",
               "fee_usd", "contractual_adj", "status"),
        payments=("office_code", "posted", "source", "amount"),
        dates="slash_mdy", insurance="INS",
        status={"C": "completed", "NS": "no_show", "X": "cancelled"}),
    "tdo": System(
        folder="pms_tdo",
        lines=("office", "visit_id", "chart_no", "visit_date", "doctor", "cdt", "gross", "adjustment",
               "status"),
        payments=("office", "posted_date", "payer_type", "amount"),
        dates="compact_ymd", id_prefix="TDO-", insurance="Ins",
        status={"Seen": "completed", "No-Show": "no_show", "Cancelled": "cancelled"}),
    "dentrix": System(
        folder="pms_dentrix",
        lines=("clinic_id", "appt_id", "pat_guid", "proc_date", "prov_id", "adacode", "amt", "adj_amt",
               "appt_status"),
        payments=("clinic_id", "trans_date", "trans_type", "amount"),
        providers=("clinic_id", "prov_id", "prov_type"),
        dates="iso_prefix", id_prefix="DX-", hygienist="Hygienist", insurance="InsPayment",
        status={"C": "completed", "B": "no_show", "D": "cancelled"}),
    "dox": System(
        folder="pms_dox",
        lines=("office", "appt_no", "acct_no", "svc_date", "provider", "code", "fee", "discount",
               "appt_result"),
        payments=("office", "pmt_date", "pmt_source", "amount"),
        providers=("office", "provider", "type"),
        dates="dash_mdy", id_prefix="DOX-", hygienist="RDH", insurance="Insurance",
        status={"Done": "completed", "Missed": "no_show", "Canc": "cancelled"}),
}

UNMAPPED_CODE = "Unmapped code"


def gather(raw: Mapping[str, DataFrame], subject: str) -> DataFrame | None:
    """Union the feeds of one subject (lines, payments, providers) under our field names, still text.

    ``raw`` holds the landed tables by name; a system whose table is absent is left out. Without any
    provider table the result is None, and every provider counts as unknown.
    """
    file, fields = {"lines": ("procedures", LINE_FIELDS), "payments": ("payments", PAYMENT_FIELDS),
                    "providers": ("providers", PROVIDER_FIELDS)}[subject]
    parts = []
    for name, system in SYSTEMS.items():
        delivered, table = getattr(system, subject), f"{system.folder}__{file}"
        if delivered is None or table not in raw:
            continue
        parts.append(raw[table].select(F.lit(name).alias("source_system"),
                                       *[F.col(d).alias(f) for d, f in zip(delivered, fields)]))
    if not parts and subject != "providers":
        raise LookupError(f"no system delivered {subject}")
    return reduce(DataFrame.unionByName, parts) if parts else None


def system_table(spark: SparkSession) -> DataFrame:
    """Per system: its date layout and id prefix. A few literal rows, whose size Spark knows."""
    return spark.createDataFrame(pa.table({
        "source_system": list(SYSTEMS), "dates": [v.dates for v in SYSTEMS.values()],
        "id_prefix": [v.id_prefix for v in SYSTEMS.values()]}))


def word_table(spark: SparkSession, said: str, means: str, words: dict[str, dict[str, str]]) -> DataFrame:
    """(source_system, ``said``) -> ``means``, from {system: {word: meaning}}."""
    rows = [(s, w, m) for s, meanings in words.items() for w, m in meanings.items()]
    return spark.createDataFrame(pa.table(dict(zip(("source_system", said, means), map(list, zip(*rows))))))


def _dated(column: str, kinds: str = "dates") -> Column:
    used = dict.fromkeys(v.dates for v in SYSTEMS.values())
    return exprs.per_system(kinds, {k: exprs.parse_date(column, k) for k in used})


def conform_lines(lines: DataFrame, providers: DataFrame | None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed, translated procedure lines of all systems, before any code mapping; ``carry`` names further
    columns to keep.

    The systems' words are joined in as literal tables rather than written out as one CASE per
    column: the generated code stays small enough to be compiled.
    """
    spark = lines.sparkSession
    statuses = word_table(spark, "status_word", "status", {s: v.status for s, v in SYSTEMS.items()})
    said = lines.join(system_table(spark), "source_system").join(statuses, ["source_system", "status_word"], "left")
    typed = said.select(
        "source_system", "source_location",
        F.concat("id_prefix", "appointment").alias("appointment_id"),
        F.concat("id_prefix", "patient").alias("patient_id"),
        _dated("service_date").alias("service_date"), "provider_id",
        F.nullif(F.col("code"), F.lit("")).alias("cdt_code"),
        exprs.amount("fee").alias("fee"), exprs.amount("writeoff").alias("writeoff"), "status", *carry)
    return with_provider_type(typed, providers)


def with_provider_type(lines: DataFrame, providers: DataFrame | None) -> DataFrame:
    """Hygienist where the provider file says so, Dentist for everyone else and every unknown.

    One join serves all systems: the site is part of the key except where a system's providers
    are known by id alone, there both sides carry an empty site.
    """
    if providers is None:
        return lines.withColumn("provider_type", F.lit("Dentist")).drop("provider_id")
    by_id_only = [s for s, v in SYSTEMS.items() if not v.provider_per_site]

    def site():
        return F.when(F.col("source_system").isin(by_id_only), "").otherwise(F.col("source_location"))

    hygienist = exprs.per_system("source_system", {s: F.col("type_word") == v.hygienist
                                                   for s, v in SYSTEMS.items() if v.hygienist})
    known = providers.select(F.col("source_system").alias("_system"), site().alias("_site"),
                             F.col("provider_id").alias("_provider"), hygienist.alias("_hygienist"))
    on = ((F.col("source_system") == F.col("_system")) & (site() == F.col("_site"))
          & (F.col("provider_id") == F.col("_provider")))
    return (lines.join(known, on, "left")
            .withColumn("provider_type", F.when(F.col("_hygienist"), "Hygienist").otherwise("Dentist"))
            .drop("_system", "_site", "_provider", "_hygienist", "provider_id"))


def conform_payments(payments: DataFrame) -> DataFrame:
    spark = payments.sparkSession
    payers = word_table(spark, "payer_word", "payer", {s: {v.insurance: "Insurance"} for s, v in SYSTEMS.items()})
    said = payments.join(system_table(spark), "source_system").join(payers, ["source_system", "payer_word"], "left")
    return said.select("source_system", "source_location", _dated("paid_date").alias("paid_date"),
                       F.coalesce("payer", F.lit("Patient")).alias("payer"), exprs.amount("amount").alias("amount"))
