"""Mapping tables: typed loads with unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitewell.operators import checks

# The mapping tables, their column types, and their keys.
SEEDS = {
    "dim_location": ("location_key int, location_name string, region string, specialty string, "
                     "open_date date, operatories int, pms_system string", ["location_key"]),
    "location_crosswalk": ("source_system string, source_location string, location_key int",
                           ["source_system", "source_location"]),
    "cdt_procedure_map": ("cdt_code string, description string, category string, specialty string, "
                          "is_new_patient_code boolean, typical_fee decimal(18,2)", ["cdt_code"]),
    "gl_account_map": ("account_no string, account_title string, category string, is_opex boolean, "
                       "mart_source string, notes string", ["account_no"]),
    "ukg_job_map": ("job_code string, job_title string, role string, is_clinical boolean", ["job_code"]),
    "ukg_earning_map": ("earning_code string, description string, pay_multiplier decimal(6,3), "
                        "is_productive boolean, is_overtime boolean", ["earning_code"]),
    "inventory_category_map": ("vendor_category string, category string", ["vendor_category"]),
    "marketing_channel_map": ("utm_source string, utm_medium string, channel string, is_paid boolean",
                              ["utm_source", "utm_medium"]),
}


def load_seed(spark: SparkSession, folder: str, name: str, check: bool = True) -> DataFrame:
    """One mapping table from <folder>/<name>.csv. A key that occurs twice would multiply facts
    without a trace, so it fails here."""
    schema, keys = SEEDS[name]
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False) \
        .option("mode", "FAILFAST").option("escape", '"').option("multiLine", True).csv(f"{folder.rstrip('/')}/{name}.csv")
    if check:
        checks.expect_empty(checks.duplicates(df, keys), f"duplicate keys in {name}")
    return df


def load_seeds(spark: SparkSession, folder: str, check: bool = True) -> dict[str, DataFrame]:
    return {name: load_seed(spark, folder, name, check) for name in SEEDS}
