import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitewell.operators import checks, extracts
from tests.conftest import rows

DAY = dt.date(2025, 3, 5)


def test_open_dental_procedures(spark):
    procedures = spark.createDataFrame(
        [(1, 10, 7, DAY, 3, 1, 50.0, 0, 2), (2, 0, 7, DAY, 3, 1, 20.0, 3, 2), (3, 10, 7, DAY, 3, 1, 9.0, 1, 1),
         (4, 10, 7, dt.date(2024, 1, 1), 3, 1, 9.0, 1, 2)],
        "ProcNum int, AptNum int, PatNum int, ProcDate date, ProvNum int, CodeNum int, ProcFee double, UnitQty int, ProcStatus int")
    codes = spark.createDataFrame([(1, "D1")], "CodeNum int, ProcCode string")
    appointments = spark.createDataFrame(
        [(10, 7, dt.datetime(2025, 3, 5, 9), 3, 1), (11, 8, dt.datetime(2025, 3, 6, 9), 3, 5),
         (12, 8, dt.datetime(2024, 3, 6, 9), 3, 5)], "AptNum int, PatNum int, AptDateTime timestamp, ProvNum int, AptStatus int")
    claims = spark.createDataFrame([(1, 5.0), (1, 2.5)], "ProcNum int, WriteOff double")
    got = rows(extracts.open_dental_procedures(procedures, codes, appointments, claims, "2025-01-01"), "ProcNum")
    assert [(r["ProcNum"], r["AptNum"], r["ProcCode"], r["ProcFee"], r["WriteOff"], r["AptStatus"]) for r in got] == [
        (0, 11, "", 0.0, 0.0, 5), (1, 10, "D1", 50.0, 7.5, 1), (2, 0, "D1", 60.0, 0.0, 2)]
    assert got[0]["ProcDate"] == dt.date(2025, 3, 6)


def test_feeds_fold(spark):
    search = spark.createDataFrame([("[site-a] x", "2025-03-01", 1_234_567), ("[site-a] y", "2025-03-01", 1),
                                    ("no tag", "2025-03-01", 5)], "campaign_name string, month string, cost_micros long")
    social = spark.createDataFrame([("[site-a]", None, "2025-03-17")], "campaign_name string, spend string, date_start string")
    web = spark.createDataFrame([("site-a", "202503", "google", "organic", "session_start", "5", "5"),
                                 ("site-a", "202503", "google", "organic", "lead", "5", "2"),
                                 ("site-a", "202503", "google", "organic", "other", "5", "9")],
                                "site_slug string, year_month string, session_source string, session_medium string, "
                                "event_name string, sessions string, event_count string")
    folded = extracts.marketing_channels([extracts.search_ads(search), extracts.social_ads(social),
                                          extracts.web_analytics(web, form_event="lead")], "10")
    got = {(r["utm_source"], r["utm_medium"]): (r["cost"], r["sessions"], r["form_submits"]) for r in rows(folded)}
    assert got == {("google", "cpc"): (1.234568, 0, 0), ("facebook", "paid_social"): (0.0, 0, 0),
                   ("google", "organic"): (10.0, 5, 2)}
    assert {r["utm_campaign"] for r in folded.collect()} == {"(not set)"}


PAGE = "<response><control><status>success</status></control>\n<result><status>{s}</status>{e}{d}</result></response>\n"


def ledger_page(records, status="success", error=""):
    data = f"<data listtype='gldetail' count='9'>{''.join(records)}</data>" if records is not None else ""
    return PAGE.format(s=status, e=error, d=data)


def test_xml_pages_are_read_in_pieces(spark, tmp_path):
    detail = [f'<gldetail browse="{i}"><NO>{i}</NO><status>odd</status>' + (f"<MEMO>a &lt; b &amp; {i}\nzwei</MEMO>" if i % 3 else "<MEMO/>")
              + "</gldetail>\n" for i in range(3000)]
    pages = {"long": ledger_page(detail), "mixed": ledger_page(["<gldetail/>", *detail[:2], "<gldetail />", "<gldetail/>"]),
             "none": ledger_page([]), "single": ledger_page(["<gldetail/>"])}
    for name, text in pages.items():
        (tmp_path / f"{name}.xml").write_text(text, encoding="utf-8")
    columns = ["NO", "MEMO", "status", "ABSENT"]
    whole = extracts.flatten_xml(spark.createDataFrame([(t,) for t in pages.values()], "body string"), "body", "gldetail", columns)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        pieces = extracts.read_xml(spark, str(tmp_path), "gldetail", columns)
        assert pieces.select(F.spark_partition_id().alias("p")).distinct().count() > 10
        assert rows(pieces) == rows(whole) and pieces.count() == 3006
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text, message", [
    (ledger_page(None, "failure", "<errormessage><error><description2>no such site</description2></error></errormessage>"), "no such site"),
    (ledger_page(["<gldetail><NO>1</NO></gldetail>"])[:-40], "not one whole page"),
    (ledger_page(["<gldetail><NO>1</NO></gldetail>"]) * 2, "not one whole page"),
    (ledger_page(["<gldetail><status>success</status></gldetail>"], "aborted"), "no success status"),
    ("<html>gone</html>", "not one whole page")])
def test_bad_xml_files_fail(spark, tmp_path, text, message):
    (tmp_path / "good.xml").write_text(ledger_page(["<gldetail><NO>1</NO></gldetail>"]))
    (tmp_path / "bad.xml").write_text(text)
    with pytest.raises(checks.CheckFailed, match=message):
        extracts.read_xml(spark, str(tmp_path), "gldetail", ["NO"])
