"""Delivered files through all layers, against values worked out by hand."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from sitewell.operators import checks, marts, publish, reports
from sitewell.plans import warehouse
from sitewell.sources import landing, seeds
from tests import site_group
from tests.conftest import rows

MARCH, APRIL = dt.date(2025, 3, 1), dt.date(2025, 4, 1)


@pytest.fixture(scope="module")
def group(spark, tmp_path_factory):
    exports, folder = site_group.write(tmp_path_factory.mktemp("group"))
    raw, maps = landing.land_csv(spark, exports), seeds.load_seeds(spark, folder)
    staged = warehouse.stage(raw, maps)
    return raw, maps, staged, warehouse.build_marts(staged, maps)


def lines_of(group, system):
    return rows(group[2]["stg_pms_procedures"].where(F.col("pms_system") == system), "appointment_id", "cdt_code")


def test_every_system_lands(group):
    assert len(group[0]) == len(site_group.FILES)
    got = {r["pms_system"]: r["n"] for r in group[2]["stg_pms_procedures"].groupBy("pms_system")
           .agg(F.count("*").alias("n")).collect()}
    # the second ascend line doubles (its provider is listed twice); the line of office 77 is gone
    assert got == {"open_dental": 4, "dentrix_ascend": 4, "sensei": 3, "dolphin": 3, "tdo": 2, "dentrix": 2, "dox": 2}


def test_open_dental_lines(group):
    first, second, missed, odd = lines_of(group, "open_dental")
    assert (first["appointment_id"], first["service_date"], first["status"]) == ("OD-100", dt.date(2025, 3, 4), "completed")
    assert first["patient_key"] == hashlib.md5(b"open_dentalOD-7").hexdigest()
    assert (first["gross_production"], first["net_production"], first["provider_type"]) == (120.0, 100.0, "Dentist")
    assert (second["provider_type"], second["procedure_category"]) == ("Hygienist", "Restorative")
    assert (missed["status"], missed["cdt_code"], missed["procedure_category"]) == ("no_show", None, None)
    # unknown status word, unknown provider
    assert (odd["status"], odd["provider_type"]) == (None, "Dentist")


@pytest.mark.parametrize("system, expected", [
    ("dentrix_ascend", [("apt-1", "completed", "Hygienist", dt.date(2025, 3, 10)),
                        ("apt-2", "no_show", "Dentist", dt.date(2025, 3, 11)),
                        ("apt-2", "no_show", "Dentist", dt.date(2025, 3, 11)),
                        ("apt-3", "cancelled", "Dentist", dt.date(2025, 4, 1))]),
    ("sensei", [("SN-1", "completed", "Hygienist", dt.date(2025, 3, 5)),
                ("SN-2", "no_show", "Dentist", dt.date(2025, 3, 5)),
                ("SN-3", "cancelled", "Dentist", dt.date(2025, 3, 6))]),
    ("dolphin", [("V1", "completed", "Dentist", dt.date(2025, 3, 31)), ("V2", "no_show", "Dentist", dt.date(2025, 4, 1)),
                 ("V3", "cancelled", "Dentist", dt.date(2025, 4, 2))]),
    ("tdo", [("TDO-10", "no_show", "Dentist", dt.date(2025, 3, 4)), ("TDO-9", "completed", "Dentist", dt.date(2025, 3, 3))]),
    ("dentrix", [("DX-1", "completed", "Hygienist", dt.date(2025, 3, 3)),
                 ("DX-2", "no_show", "Dentist", dt.date(2025, 3, 4))]),
    ("dox", [("DOX-1", "completed", "Hygienist", dt.date(2025, 3, 9)),
             ("DOX-2", "no_show", "Dentist", dt.date(2025, 3, 16))])])
def test_conforming(group, system, expected):
    got = [(r["appointment_id"], r["status"], r["provider_type"], r["service_date"]) for r in lines_of(group, system)]
    assert got == expected


def test_visit_takes_alphabetically_last(group):
    visits = {r["appointment_id"]: r for r in rows(group[2]["stg_pms_appointments"])}
    mixed = visits["OD-100"]
    assert (mixed["provider_type"], mixed["status"], mixed["gross_production"]) == ("Hygienist", "completed", 200.0)
    assert visits["OD-102"]["status"] is None
    # the new-patient code counts on a missed visit too; only the mart asks for completion
    assert visits["apt-2"]["is_new_patient"] is True
    assert visits["DOX-1"]["month"] == MARCH


def test_lines_and_visits_add_up(group):
    _, _, staged, _ = group
    total = [staged[n].agg(F.sum("gross_production")).first()[0] for n in ("stg_pms_procedures", "stg_pms_appointments")]
    assert total[0] == total[1]
    raw_lines = sum(group[0][t].count() for t in group[0] if t.endswith("__procedures"))
    assert raw_lines + 1 == staged["stg_pms_procedures"].count() + warehouse.rejects(group[0], group[1]).count()


def test_payments(group):
    got = {(r["location_key"], r["month"], r["payer"]): r["a"] for r in rows(
        group[2]["stg_pms_payments"].groupBy("location_key", "month", "payer").agg(F.sum("amount").alias("a")))}
    assert got == {(1, MARCH, "Insurance"): 150.25, (1, MARCH, "Patient"): 30.0, (2, MARCH, "Insurance"): 70.0,
                   (3, MARCH, "Insurance"): 18.0, (3, MARCH, "Patient"): 6.0, (4, MARCH, "Insurance"): 20.0,
                   (4, MARCH, "Patient"): 12.0, (4, APRIL, "Patient"): 8.0, (99, MARCH, "Insurance"): 14.0}


def test_labor_rules(group):
    got = {(r["employee_id"], r["earning_code"]): (r["role"], r["gl_account_no"], r["labor_cost"])
           for r in rows(group[2]["stg_ukg_labor"])}
    assert got == {("e1", "REG"): ("Assistant", "6000", 164.0), ("e1", "OT"): ("Assistant", "6000", 61.5),
                   ("e2", "PTO"): ("Front Office", "6030", 120.0), ("e3", "WHAT"): ("Assistant", "6000", None),
                   ("e4", "REG"): ("Unmapped job", "6010", 10.0)}


def test_ledger_signs(group):
    got = {(r["account_no"], r["month"].month): (r["category"], r["amount"]) for r in rows(group[2]["stg_sage_gl"])}
    assert got[("4000", 3)] == ("Revenue", 200.0) and got[("4900", 3)] == ("Revenue", -7.0)
    assert got[("5200", 3)] == ("Lab", 40.0) and got[("9999", 3)] == ("Unmapped account", 3.0)


def test_opex_mart(group):
    got = {(r["month"], r["account_no"], r["source"]): (r["category"], r["account_title"], r["amount"])
           for r in rows(group[3]["mart_opex_monthly"])}
    june = dt.date(2025, 6, 1)
    # account 5300 comes from inventory, 6000 from timecards, refunds and revenue are no expenses
    assert got == {
        (MARCH, "5200", "Sage Intacct"): ("Lab", "Lab fees", 40.0), (MARCH, "6100", "Sage Intacct"): ("Occupancy", "Rent", 500.0),
        (june, "6100", "Sage Intacct"): ("Occupancy", "Rent", 500.0), (MARCH, "6000", "UKG"): ("Payroll", "Clinical wages", 225.5),
        (MARCH, "6010", "UKG"): ("Payroll", "Office wages", 10.0), (MARCH, "6030", "UKG"): ("Payroll", "Time off", 120.0),
        (MARCH, "5300", "Inventory"): ("Lab", "Supplies", 30.0), (MARCH, "6600", "Marketing feed"): ("Marketing", "Ads", 101.5)}


def test_scorecard(group):
    got = {(r["location_key"], r["month"]): r for r in rows(group[3]["mart_location_monthly"])}
    # June has costs but no visits
    assert set(got) == {(1, MARCH), (2, MARCH), (2, APRIL), (3, MARCH), (4, MARCH), (4, APRIL), (99, MARCH)}
    one = got[(1, MARCH)]
    assert (one["scheduled"], one["completed_visits"], one["no_shows"]) == (3, 1, 1)
    assert (one["gross_production"], one["hygiene_production"], one["collections"]) == (320.0, 200.0, 180.25)
    assert (one["labor_cost"], one["overtime_cost"], one["labor_hours"], one["overtime_hours"]) == (355.5, 61.5, 11.0, 2.0)
    assert (one["total_opex"], one["lab_fees"], one["facility_costs"], one["doctor_comp"]) == (1027.0, 40.0, 500.0, 0.0)
    assert (one["supply_cost"], one["inventory_on_hand"], one["marketing_spend"], one["leads"]) == (30.0, 10.0, 101.5, 3)
    assert one["operating_profit"] == pytest.approx(180.25 - 1027.0)
    # one completed new patient, one missed; no labor, so null rather than zero
    two = got[(2, MARCH)]
    assert (two["new_patients"], two["labor_cost"], two["total_opex"], two["operating_profit"]) == (1, None, None, 70.0)
    # visits without payments: no profit figure
    assert got[(2, APRIL)]["operating_profit"] is None


def test_scorecard_agrees_with_opex_mart(group):
    by_mart = group[3]["mart_opex_monthly"].groupBy("location_key", "month").agg(F.sum("amount").alias("a"))
    both = group[3]["mart_location_monthly"].where("total_opex is not null").join(by_mart, ["location_key", "month"])
    assert both.where("a <> total_opex").count() == 0 and both.count() == 1


def test_weekly(group):
    got = {(r["location_key"], r["week"]): r for r in rows(group[3]["mart_location_weekly"])}
    # Sunday 9 March belongs to the week of Monday 3 March
    assert got[(99, dt.date(2025, 3, 3))]["scheduled"] == 1 and got[(99, dt.date(2025, 3, 10))]["no_shows"] == 1
    assert got[(1, dt.date(2025, 3, 3))]["labor_cost"] == 355.5


def test_mix_and_channels(group):
    mix = {(r["location_key"], r["procedure_category"]): r["procedures"] for r in rows(group[3]["mart_procedure_mix"])}
    assert mix == {(1, "Diagnostic"): 1, (1, "Restorative"): 1, (2, "Diagnostic"): 1, (3, "Diagnostic"): 2,
                   (4, "Diagnostic"): 1, (4, "Restorative"): 1, (99, "Diagnostic"): 1}
    channels = {r["channel"]: (r["spend"], r["leads"]) for r in rows(group[3]["mart_marketing_channel_monthly"])}
    assert channels == {"Search": (100.5, 3), "Other": (1.0, 0)}


def test_reconciliation(group):
    got = {(r["location_key"], r["month"], r["category"]): r for r in rows(group[3]["mart_reconciliation"])}
    revenue = got[(1, MARCH, "Revenue")]
    assert (revenue["ops_amount"], revenue["gl_amount"], revenue["variance"]) == (180.25, 200.0, 19.75)
    assert got[(1, MARCH, "Supplies")]["variance"] == 1.0 and got[(1, MARCH, "Marketing")]["gl_amount"] is None
    assert got[(2, MARCH, "Revenue")]["variance_pct"] is None
    full = marts.reconciliation(*[group[2][n] for n in ("stg_pms_payments", "stg_ukg_labor", "stg_inventory",
                                                        "stg_marketing")],
                                group[2]["stg_sage_gl"].withColumn("month", F.add_months("month", 12)), full=True)
    sides = {r["category"]: (r["without_ledger"], r["without_operations"]) for r in checks.missing_sides(full).collect()}
    assert sides["Supplies"] == (1, 1) and sides["Marketing"] == (1, 0)


def test_operations(group):
    got = {(r["month"], r["category"]): r for r in rows(group[3]["mart_operations_monthly"])}
    assert got[(MARCH, "Occupancy")]["pct_of_collections"] == pytest.approx(500 / 180.25)
    assert got[(dt.date(2025, 6, 1), "Occupancy")]["collections"] is None


def test_unmapped(group):
    raw, maps, _, _ = group
    got = [(r["kind"], r["value"], r["row_count"]) for r in rows(warehouse.find_problems(raw, maps))]
    assert got == [("cdt_code", "ZZZ", 1), ("gl_account", "9999", 1), ("inventory_item", "i2", 1),
                   ("location", "open_dental / 77", 1), ("ukg_job", "J9", 1), ("utm_campaign", "odd", 1)]
    # lines are counted as staged; a line of no known site is not doubled by a provider listed twice
    twice = raw["pms_dentrix_ascend__procedures"].withColumn("provider_id", F.lit("prv-2"))
    lost = twice.withColumn("location_id", F.lit("nowhere"))
    more = {(r["kind"], r["value"]): r["row_count"] for r in warehouse.find_problems(
        {**raw, "pms_dentrix_ascend__procedures": twice.union(lost).withColumn("ada_code", F.lit("ODD"))}, maps).collect()}
    assert more[("cdt_code", "ODD")] == 6 and more[("location", "dentrix_ascend / nowhere")] == 3
    report = {(r["item"], r["name"]): r["value"] for r in warehouse.build_report(warehouse.gathered(raw), raw, maps).collect()}
    whole = checks.summary(warehouse.find_problems(raw, maps), group[3]["mart_reconciliation"])
    assert report == {(r["item"], r["name"]): r["value"] for r in whole.collect()}
    strict = {(r["kind"], r["value"]) for r in warehouse.find_problems(raw, maps, True).collect()}
    assert {("status", "open_dental"), ("ukg_earning", "WHAT")} <= strict


def test_checks_find_planted_rows(group):
    _, _, staged, built = group
    scorecard = built["mart_location_monthly"]
    assert rows(checks.nulls(scorecard, ["month", "collections"])) == [{"column_name": "collections", "null_rows": 1}]
    assert checks.duplicates(scorecard, ["location_key", "month"]).isEmpty()
    assert rows(checks.without_visits(built["mart_opex_monthly"], staged["stg_pms_appointments"])) == [
        {"location_key": 1, "month": dt.date(2025, 6, 1), "amount": 500.0}]
    with pytest.raises(checks.CheckFailed, match="1 finding"):
        checks.expect_empty(checks.nulls(scorecard, ["collections"]), "nulls")
    with pytest.raises(checks.CheckFailed):
        warehouse.verify(built, warehouse.find_problems(*group[:2]))


def test_counts_of_the_write_stand_in_for_a_scan(spark, tmp_path, monkeypatch):
    rows_of = lambda n: spark.range(n).select(F.col("id").alias("a"), F.when(F.col("id") > 1, "x").alias("b"))
    for name, df in {"some": rows_of(5).repartition(3), "none": rows_of(0), "known_none": rows_of(5).where(F.lit(False))}.items():
        watched, seen = checks.watched(df, ["a", "b"])
        watched.write.parquet(str(tmp_path / name))
        counts = spark.createDataFrame(checks.counted(name, ["a", "b"], seen), checks.WRITE_COUNTS)
        found = rows(checks.nulls_written(counts, name, ["a", "b"]))
        assert found == ([{"column_name": "b", "null_rows": 2}] if name == "some" else []) == rows(checks.nulls(df, ["a", "b"]))
    assert rows(checks.nulls_written(counts, "another", ["a"])) == [{"column_name": "a", "null_rows": None}]
    sound = {"mart_location_monthly": spark.sql("SELECT 1 AS location_key, DATE'2025-01-01' AS month, 1.0 AS collections"),
             "mart_operations_monthly": spark.sql("SELECT 'x' AS category"),
             "mart_reconciliation": spark.sql("SELECT 'x' AS category, 0.0 AS variance, 1.0 AS ops_amount")}
    nothing = spark.createDataFrame([], "kind string, value string, row_count long")
    good = [(m, c, 1, 0, None, None) for m, cs in warehouse.NEVER_NULL.items() for c in cs]
    monkeypatch.setattr(checks, "nulls", lambda *_: pytest.fail("a mart was read for nulls"))
    warehouse.verify(sound, nothing, counts=spark.createDataFrame(good, checks.WRITE_COUNTS))
    bad = [(m, c, 1, int(c == "month"), None, None) for m, c, *_ in good]
    with pytest.raises(checks.CheckFailed, match="mart_location_monthly"):
        warehouse.verify(sound, nothing, counts=spark.createDataFrame(bad, checks.WRITE_COUNTS))


def test_missing_feeds(group):
    raw, maps, _, _ = group
    only = {"pms_dox__procedures": raw["pms_dox__procedures"]}
    lines = warehouse.stage(only, maps)["stg_pms_procedures"]
    assert {r["provider_type"] for r in lines.collect()} == {"Dentist"} and lines.count() == 2
    with pytest.raises(LookupError, match="payments"):
        warehouse.stage(only, maps)["stg_pms_payments"]


def test_duplicate_provider_is_reported(group):
    providers = group[0]["pms_dentrix_ascend__providers"]
    assert [r["provider_id"] for r in checks.duplicates(providers, ["provider_id"]).collect()] == ["prv-2"]


def test_second_ad_feed(group, spark):
    raw, maps, _, _ = group
    ads = spark.createDataFrame([("2025-03-05", "act_1", "m", "5.5", "9", "4", "2"), ("2025-03-06", "zzz", "m", "1", "9", "4", "2")],
                                "date string, account_id string, campaign string, spend string, impressions string, "
                                "clicks string, actions_lead string")
    staged = warehouse.stage({**raw, warehouse.DAILY_ADS: ads}, maps)["stg_marketing"]
    meta = rows(staged.where("channel = 'Meta'"))
    assert [(r["month"], r["spend"], r["sessions"], r["form_leads"], r["booked_appts"]) for r in meta] == [(MARCH, 5.5, 4, 2, 0)]
    feed = staged.where("channel = 'Search'").withColumn("channel", F.lit("Meta"))
    assert checks.doubled_ads(feed, staged.where("channel = 'Meta'")).count() == 1


def test_documents_round_trip(group):
    built = group[3]
    mart = built["mart_marketing_channel_monthly"]
    packed = publish.dataset("channels", mart)
    columns = list(publish.DATASETS["channels"]["columns"])
    body = publish.to_document(packed, columns)
    back = publish.from_document(body, packed.select(*columns).schema, ["chunk", "block"])
    assert [(r["channel"], r["spend"]) for r in rows(back)] == [("Other", 1.0), ("Search", 100.5)]
    monthly = publish.dataset("monthly", built["mart_location_monthly"])
    keys = [k for r in monthly.collect() for k in r["location_key"]]
    assert 99 not in keys and len(keys) == 6


def test_opex_documents(group):
    entries, packed = publish.opex_documents(group[3]["mart_opex_monthly"])
    listed = rows(entries, "i")
    assert [(r["i"], r["account_no"], r["source"]) for r in listed][:2] == [(0, "5200", "Sage Intacct"), (1, "5300", "Inventory")]
    assert [r["i"] for r in listed] == list(range(7))
    doc = packed.collect()
    assert len(doc) == 1 and doc[0]["m"] == [0] * 7 + [3] and doc[0]["i"][-1] == 5


def test_row_numbers_match_sorting(spark):
    df = spark.range(5000).select((F.col("id") % 977).alias("a"), (F.col("id") % 13).cast("string").alias("b")).distinct()
    got = [(r["a"], r["b"], r["n"]) for r in publish.row_numbers(df, ["a", "b"], "n").collect()]
    ordered = sorted((a, b) for a, b, _ in got)
    assert sorted(got, key=lambda t: t[2]) == [(a, b, i) for i, (a, b) in enumerate(ordered)]


def test_build_writes_everything(spark, tmp_path):
    exports, folder = site_group.write(tmp_path)
    raw, maps = landing.land_csv(spark, exports), seeds.load_seeds(spark, folder)
    summary = warehouse.build(spark, raw, maps, documents=str(tmp_path / "docs"))
    found = {(r["item"], r["name"]): r["value"] for r in summary.collect()}
    assert found[("unmapped values", "location")] == 1.0 and ("variance percent", "Revenue") in found
    assert spark.table("marts.mart_location_monthly").count() == 7
    timecards = spark.table("raw.ukg__timecards")
    assert timecards.count() == 5 and {t for _, t in timecards.dtypes} == {"string"}
    assert spark.table("staging.stg_pms_procedures").count() == 20
    assert spark.table("staging.rejects_location").count() == 1
    counts = spark.table("staging.write_counts")
    for mart, columns in warehouse.NEVER_NULL.items():
        written = spark.table(f"marts.{mart}")
        assert {(r["column_name"], r["null_rows"]) for r in checks.nulls_written(counts, mart, columns).collect()} == {
            (r["column_name"], r["null_rows"]) for r in checks.nulls(written, columns).collect()}
        assert {r["row_count"] for r in counts.where(F.col("table_name") == mart).collect()} == {written.count()}
    months = counts.where("table_name = 'mart_location_monthly' AND column_name = 'month'").first()
    assert months["lowest"] <= months["highest"]
    left_out = warehouse.all_rejects(raw, maps)
    assert {t.name for t in spark.catalog.listTables("staging")} >= {*left_out, "without_visits", "missing_sides"}
    for name, (feed, subject) in {"rejects_timecards": ("ukg__timecards", "stg_ukg_labor"),
                                  "rejects_inventory": ("inventory__usage", "stg_inventory"),
                                  "rejects_ledger": ("sage_intacct__gl_detail", "stg_sage_gl")}.items():
        assert raw[feed].count() == spark.table(f"staging.{subject}").count() + spark.table(f"staging.{name}").count(), name
    assert (tmp_path / "docs" / "monthly" / "_SUCCESS").exists()
    sources = {r["source"]: r["n"] for r in spark.read.json(str(tmp_path / "docs" / "sources")).collect()}
    assert sources["Practice management"] == 20 and sources["UKG"] == 5
    # a second build replaces the first, also from the raw tables themselves
    landed = {n: spark.table(f"raw.{n}") for n in raw}
    warehouse.build(spark, landed, maps, land=False)
    assert spark.table("marts.mart_location_monthly").count() == 7


def test_statement(group):
    _, maps, staged, built = group
    lines = reports.profit_and_loss(built["mart_opex_monthly"], staged["stg_pms_payments"], staged["stg_sage_gl"],
                                    maps["dim_location"])
    got = {(r["level"], r["region"], r["location_key"], r["line"]): r["amount"] for r in
           rows(lines.where(F.col("month") == F.lit(MARCH)))}
    assert got[("site", "North", 1, "Refunds")] == -7.0 and got[("region", "North", None, "Collections")] == 250.25
    assert got[("group", None, None, "Collections")] == 320.25
    margin = rows(reports.profit_margin(lines).where((F.col("level") == "site") & (F.col("location_key") == 1)
                                                     & (F.col("month") == F.lit(MARCH))))[0]
    assert margin["profit"] == pytest.approx(180.25 - 7 - 1027)


def test_comparison_skips_gaps(spark):
    card = spark.createDataFrame([(1, dt.date(2025, 1, 1), 10.0), (1, dt.date(2025, 2, 1), 15.0),
                                  (1, dt.date(2025, 4, 1), 30.0), (1, dt.date(2024, 2, 1), 5.0)],
                                 "location_key int, month date, x double")
    got = {r["month"]: r for r in rows(reports.compare_months(card, ["x"]))}
    assert got[dt.date(2025, 2, 1)]["x_prev_change"] == 0.5 and got[dt.date(2025, 2, 1)]["x_year"] == 5.0
    assert got[dt.date(2025, 4, 1)]["x_prev"] is None and len(got) == 4


def test_alerts_flag_planted_site(spark):
    flat = [(k, MARCH, 0.9 + 0.001 * (k % 3), 0.1, 0.2, 0.05, 40.0) for k in range(1, 20)]
    odd = [(20, MARCH, 0.5, 0.1, 0.45, 0.05, 40.0)]
    ratios = spark.createDataFrame(flat + odd, "location_key int, month date, collection_rate double, no_show_rate double, "
                                   "labor_share double, supply_share double, cost_per_booked_visit double")
    found = {(r["location_key"], r["metric"]) for r in reports.alerts(ratios, 3.0).collect()}
    assert found == {(20, "collection_rate"), (20, "labor_share")}
    limited = reports.alerts(ratios, 99.0, {"cost_per_booked_visit": 39.0})
    assert limited.count() == 20
    low = reports.alerts(ratios, 99.0, floors={"collection_rate": 0.6})
    assert {r["metric"] for r in low.collect()} == {"collection_rate"}


def test_hot_site_and_code(spark, group):
    """A third of all lines in one site, without a code: sums stay whole, shuffled or broadcast."""
    _, maps, _, _ = group
    n = 30_000
    lines = spark.range(n).select(
        F.lit("sensei").alias("source_system"), F.lit("P1").alias("source_location"),
        F.when(F.col("id") % 3 == 0, "0").otherwise(F.col("id").cast("string")).alias("appointment"),
        (F.col("id") % 100).cast("string").alias("patient"), F.lit("5-Mar-2025").alias("service_date"),
        F.lit("H").alias("provider_id"), F.when(F.col("id") % 3 == 0, "").otherwise("D1").alias("code"),
        F.lit("1.5").alias("fee"), F.lit("0").alias("writeoff"), F.lit("Completed").alias("status_word"))
    providers = group[0]["pms_sensei__providers"].select(
        F.lit("sensei").alias("source_system"), F.col("practice").alias("source_location"),
        F.col("provider").alias("provider_id"), F.col("provider_type").alias("type_word"))
    from sitewell.operators import staging
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            staged = staging.procedures(lines, providers, maps["location_crosswalk"], maps["cdt_procedure_map"])
            visits = staging.appointments(staged)
            total = visits.agg(F.sum("gross_production").alias("s"), F.count("*").alias("n"),
                               F.count_if(F.col("provider_type") == "Hygienist").alias("h")).first()
            assert (float(total["s"]), total["n"], total["h"]) == (1.5 * n, 20_100, 20_100)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bounded_documents(spark):
    """More sites than a block holds become more documents, never a longer one."""
    mart = spark.range(1200).select(F.col("id").cast("int").alias("location_key"), F.lit(MARCH).alias("month"),
                                    F.lit("x").alias("channel"), F.lit(1).cast("decimal(18,2)").alias("spend"),
                                    F.lit(1).alias("leads"), F.lit(1).alias("booked"))
    packed = publish.dataset("channels", mart, first_test_key=10_000)
    assert sorted(len(r["spend"]) for r in packed.collect()) == [200, 500, 500]


def test_dictionary_keeps_its_positions(spark):
    first = spark.createDataFrame([("b", "x", "B"), ("d", "x", "D"), (None, "x", "none")], "k string, s string, label string")
    then = spark.createDataFrame([("a", "x", "A"), ("d", "x", "A new name"), ("c", "y", "C"), (None, "x", "none")], "k string, s string, label string")
    before = {(r["k"], r["s"]): (r["i"], r["label"]) for r in publish.kept_dictionary(first, ["k", "s"], ["label"], "kept_entries").collect()}
    assert before == {(None, "x"): (0, "none"), ("b", "x"): (1, "B"), ("d", "x"): (2, "D")}
    packed = publish.encode(first.where("k is not null"), spark.table("kept_entries"), ["k", "s"]).select("i").collect()
    for _ in range(2):
        after = {(r["k"], r["s"]): (r["i"], r["label"]) for r in publish.kept_dictionary(then, ["k", "s"], ["label"], "kept_entries").collect()}
        assert after == {**before, ("a", "x"): (3, "A"), ("c", "y"): (4, "C")}
    names = {i: k for (k, _), (i, _) in after.items()}
    assert sorted(names[r["i"]] for r in packed) == ["b", "d"]  # documents of the first build, read with the new entries


def test_only_changed_chunks_are_written(spark, tmp_path):
    path = str(tmp_path / "docs")

    def published(*facts):
        rows_in = spark.createDataFrame(facts, "month date, location_key int, v double")
        packed = publish.pack(publish.calendar_chunks(rows_in), ["chunk"], ["month", "location_key"], ["month", "location_key", "v"])
        again = sorted(r["chunk"] for r in publish.write_changed(packed, path, ["chunk"]).collect())
        files = {p.parent.name: p.stat().st_mtime_ns for p in (tmp_path / "docs").glob("chunk=*/*.json")}
        return again, files

    old = [(dt.date(2024, m, 1), 1, float(m)) for m in range(1, 13)]
    first, files = published(*old)
    assert len(first) == 2 and len(files) == 2
    january = (dt.date(2025, 1, 1), 1, None)
    again, more = published(*old, january)
    assert len(again) == 1 and again[0] not in first and all(more[p] == files[p] for p in files)
    assert published(*old, january)[0] == []
    changed, _ = published(*old[:-1], (dt.date(2024, 12, 1), 1, 99.0), january)
    assert changed == [first[1]]
    body = spark.read.json(path).where(F.col("chunk") == again[0]).first()
    assert body["v"] == [None] and body["location_key"] == [1]
    assert published(*old)[0] == [first[1]] and len(list((tmp_path / "docs").glob("chunk=*"))) == 2
