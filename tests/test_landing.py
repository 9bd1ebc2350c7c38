import csv
import datetime as dt
import io
import os
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sitewell.functions import exprs
from sitewell.operators import checks, extracts
from sitewell.sources import landing, seeds, versions
from sitewell.streaming import drops
from tests import site_group
from tests.conftest import rows


def put(folder, name, text, when=None, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(text, encoding=encoding)
    if when:
        os.utime(path, (when, when))
    return path


def test_land_csv_keeps_text(spark, tmp_path):
    put(tmp_path / "My System", "Gl Detail.csv", 'RECORD NO,Date\n007,"two\nlines"\n8,\n', encoding="utf-8-sig")
    tables = landing.land_csv(spark, str(tmp_path))
    assert list(tables) == ["my_system__gl_detail"]
    df = tables["my_system__gl_detail"]
    assert df.dtypes == [("record_no", "string"), ("date_col", "string")]
    assert rows(df) == [{"record_no": "007", "date_col": "two\nlines"}, {"record_no": "8", "date_col": None}]


def in_splits(spark, path, split_bytes):
    """Columns and sorted rows, by the split reader with pieces of that size."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df = landing.read_text(spark, str(path), splits=True)
        return df.columns, sorted(tuple(r) for r in df.na.fill("").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


STRAY = 'id,note,qty\n1,plain,1\n2,6" pipe,2\n3,"two\nlines, 5"" wide",3\n4,a"b"c,4\n5,"say ""hi""\n"",x",5\n6,"ab"cd,6\n7,last,7\n'


@pytest.mark.parametrize("split_bytes", [7, 25, 60, 1 << 20])
@pytest.mark.parametrize("text", [STRAY, STRAY.replace("id,", '"te\nxt",'), STRAY.replace("\n", "\r\n"), "a,b\n1,2\n"])
def test_both_readers_agree(spark, tmp_path, text, split_bytes):
    path = put(tmp_path, "f.csv", "")
    path.write_bytes(text.encode())
    df = landing.read_text(spark, str(path))
    columns, got = in_splits(spark, path, split_bytes)
    assert columns == df.columns
    whole = sorted(tuple(r) for r in df.na.fill("").collect())
    assert got == whole and len(got) == (7 if "last" in text else 1)


def test_split_reader_fails_loudly(spark, tmp_path):
    for name, text, message in (("open", 'a,b\n1,"never closed\n2,x\n', "never closed"), ("cr", "a,b\r1,2\r3,4\r", "carriage")):
        path = put(tmp_path, f"{name}.csv", "")
        path.write_bytes(text.encode())
        # two stages may fail with the message at once, which pyspark hands on unconverted
        with pytest.raises((PySparkException, Py4JJavaError), match=message):
            landing.read_text(spark, str(path), splits=True).collect()


def test_two_files_of_one_table(spark, tmp_path):
    put(tmp_path / "Shop", "Line Items.csv", "A,B\n1,2\n")
    put(tmp_path / "Shop", "line_items.csv", "B,A\n4,3\n")
    assert rows(landing.land_csv(spark, str(tmp_path))["shop__line_items"]) == [{"a": "1", "b": "2"}, {"a": "3", "b": "4"}]
    put(tmp_path / "Shop", "LINE ITEMS.csv", "A\n9\n")
    with pytest.raises(landing.MissingColumns, match="shop__line_items"):
        landing.land_csv(spark, str(tmp_path))


def jobs_of(spark, run):
    """What run() returns, and how many jobs it started."""
    context, group = spark.sparkContext, f"jobs-{random.random()}"
    context.setJobGroup(group, group)
    try:
        return run(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setJobGroup("", "")


def test_many_files_land_with_few_jobs(spark, tmp_path):
    wanted = {}
    for t in range(25):
        for f in range(12):
            header = ["Id,Note", "Note,Id"][f % 2 if t % 5 == 0 else 0]
            note = f'"{t}\n{f}"'
            put(tmp_path / f"shop {f}", f"T{t}.csv", f"{header}\n{f},{note}\n" if header.startswith("Id") else f"{header}\n{note},{f}\n")
            wanted[f"shop_{f}__t{t}"] = [{"id": str(f), "note": f"{t}\n{f}"}]
    tables, jobs = jobs_of(spark, lambda: landing.land_csv(spark, str(tmp_path)))
    assert set(tables) == set(wanted) and jobs <= 6  # listing and headers, not one per file
    for name in ("shop_3__t0", "shop_4__t24", "shop_11__t5"):
        assert rows(tables[name]) == wanted[name]


def test_files_of_one_table_are_one_scan_per_header(spark, tmp_path):
    for n in range(40):
        names = ["Line Items", "line items", "LINE ITEMS", "Line_Items", "line-items"]
        put(tmp_path / f"Shop{' ' * (n // 5)}", f"{names[n % 5]}.csv", ["A,B\n1,2\n", "B,A\n2,1\n"][n % 2])
    tables, jobs = jobs_of(spark, lambda: landing.land_csv(spark, str(tmp_path)))
    assert list(tables) == ["shop__line_items"] and jobs <= 6
    plan = tables["shop__line_items"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2
    assert rows(tables["shop__line_items"]) == [{"a": "1", "b": "2"}] * 40


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_headers_as_spark_names_them(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(landing, "SMALL_FILE", small)
    texts = ['id,"te\nxt",qty\n1,a,2\n', "\ufeffid,b\r\n1,2\r\n", "a,,A,b\n1,2,3,4\n", "only", '"say ""x""",y\n1,2\n']
    texts += ["x,y\n" + "1,2\n" * 5000]
    paths = [str(put(tmp_path / "with space & 100%", f"f {i}.csv", t)) for i, t in enumerate(texts)]
    empty = str(put(tmp_path, "empty.csv", ""))
    found = landing.headers(spark, [*paths, empty])
    for path in paths:
        assert list(found[landing.same_path(f"file:{path}")]) == landing.read_text(spark, path).columns, path
    assert len(found) == len(texts) and landing.headers(spark, []) == {}


@pytest.mark.parametrize("split_bytes", [40, 300, 1 << 20])
def test_large_file_is_read_in_splits(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    parts = ["plain", "two\nlines", "", 'say "hi"', "a,b", "x\n\n\ny\n", "x" * 90, 'q"\n"q', "wide\r\nbreak"]
    wanted = [(str(i), rng.choice(parts), rng.choice(parts)) for i in range(400)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\r\n" if split_bytes == 300 else "\n")
    writer.writerow(["Id", "Free Text", "More"])
    writer.writerows(wanted)
    path = put(tmp_path, "big.csv", "")
    path.write_bytes(out.getvalue().encode("utf-8-sig"))
    whole = sorted(tuple(r) for r in landing.read_text(spark, str(path)).na.fill("").collect())
    columns, got = in_splits(spark, path, split_bytes)
    assert columns == ["Id", "Free Text", "More"]
    assert got == whole and len(got) == 400
    if split_bytes != 300:
        assert got == sorted(wanted)


def test_newest_file_and_required_columns(spark, tmp_path):
    drop = tmp_path / "drop"
    put(drop, "new.csv", "A,B,Extra\n1,2,3\n", when=2_000)
    put(drop, "old.csv", "A\n9\n", when=1_000)
    put(drop, "notes.txt", "x", when=3_000)
    assert rows(landing.read_drop(spark, str(drop), ["B", "A"])) == [{"B": "2", "A": "1"}]
    put(drop, "newest.csv", "A\n1\n", when=4_000)
    with pytest.raises(landing.MissingColumns, match="B"):
        landing.read_drop(spark, str(drop), ["A", "B"])
    with pytest.raises(landing.NothingDelivered):
        landing.newest(spark, str(drop), "*.parquet")


def test_json_pages(spark, tmp_path):
    put(tmp_path, "1.json", '{"data": [{"id": 1, "a": {"b": "x"}}, {"id": 2}], "next": "u"}')
    put(tmp_path, "2.json", '[{"id": 3, "a": {"b": null}}]')
    flat = extracts.flatten_json(landing.read_pages(spark, str(tmp_path)), "value", {"n": "id", "deep": "a.b"})
    assert rows(flat) == [{"n": "1", "deep": "x"}, {"n": "2", "deep": None}, {"n": "3", "deep": None}]


def test_json_pages_that_are_not_pages(spark, tmp_path):
    for k, text in enumerate(('{"data": [{"id": 1}', '{"data": {"id": 1}}', "<html>")):
        put(tmp_path / str(k), "1.json", text)
        with pytest.raises(PySparkException, match="not a page"):
            extracts.flatten_json(landing.read_pages(spark, str(tmp_path / str(k))), "value", {"n": "id"}).collect()
    put(tmp_path / "none", "1.json", '{"error": "late"}')
    put(tmp_path / "none", "2.json", '{"data": []}')
    pages = landing.read_pages(spark, str(tmp_path / "none"))
    assert extracts.flatten_json(pages, "value", {"n": "id"}).count() == 0
    assert rows(extracts.pages_without_data(pages, "value")) == [{"row_count": 1}]


def test_xml_pages(spark, tmp_path):
    page = ("<response><result><status>{s}</status>{e}<data numremaining='0'><gldetail><RECORDNO>1</RECORDNO>"
            "<AMOUNT>2.50</AMOUNT></gldetail>{more}</data></result></response>")
    put(tmp_path / "good", "1.xml", page.format(s="success", e="", more="<gldetail><RECORDNO>02</RECORDNO></gldetail>"))
    put(tmp_path / "good", "2.xml", page.format(s="success", e="", more=""))
    pages = landing.read_pages(spark, str(tmp_path / "good"))
    got = extracts.flatten_xml(pages, "value", "gldetail", ["RECORDNO", "AMOUNT"])
    assert rows(got) == [{"RECORDNO": "02", "AMOUNT": None}, *[{"RECORDNO": "1", "AMOUNT": "2.50"}] * 2]
    error = "<errormessage><error><description2>no such object</description2></error></errormessage>"
    put(tmp_path / "bad", "1.xml", page.format(s="failure", e=error, more=""))
    put(tmp_path / "torn", "1.xml", "<response><result>")
    for folder, message in (("bad", "no such object"), ("torn", "no success status")):
        with pytest.raises(PySparkException, match=message):
            extracts.flatten_xml(landing.read_pages(spark, str(tmp_path / folder)), "value", "gldetail",
                                 ["RECORDNO"]).collect()


def test_jdbc_options():
    day = dt.date(2025, 3, 1)
    plain = landing.jdbc_options("jdbc:x", "SELECT * FROM t WHERE d >= :since", day)
    assert plain["query"] == "SELECT * FROM t WHERE d >= '2025-03-01'" and "numPartitions" not in plain
    split = landing.jdbc_options("jdbc:x", "SELECT 1", day, "id", (1, 900), parts=4)
    assert (split["partitionColumn"], split["numPartitions"], split["dbtable"]) == ("id", "4", "(SELECT 1) q")
    assert landing.default_since(dt.date(2025, 3, 1)) == dt.date(2025, 1, 15)


def days(spark, *entries):
    return spark.createDataFrame([(dt.date(*d), v) for d, v in entries], "day date, v string")


def test_replace_window_keeps_history(spark):
    table, since = "window_test", dt.date(2025, 3, 10)
    landing.replace_window(days(spark, ((2025, 1, 5), "jan"), ((2025, 3, 5), "early"), ((2025, 3, 20), "gone"),
                                ((2025, 4, 1), "april")), table, "day", dt.date(2025, 1, 1))
    late = days(spark, ((2025, 2, 1), "late"), ((2025, 3, 10), "new"), ((2025, 5, 2), "may"))
    landing.replace_window(late, table, "day", since)
    assert [r["v"] for r in rows(spark.table(table), "day")] == ["jan", "early", "new", "may"]
    assert [r["v"] for r in rows(landing.late_rows(late, "day", since))] == ["late"]
    # the same delivery again changes nothing
    landing.replace_window(late, table, "day", since)
    assert spark.table(table).count() == 4


def test_replace_window_first_load_and_empty_delivery(spark):
    table = "window_test_2"
    landing.replace_window(days(spark, ((2025, 1, 5), "a"), ((2025, 2, 5), "b")), table, "day", dt.date(2025, 1, 1))
    landing.replace_window(days(spark).limit(0), table, "day", dt.date(2025, 2, 1))
    assert [r["v"] for r in rows(spark.table(table))] == ["a"]


def test_window_of_a_text_date(spark):
    def cards(*said):
        return lambda session, since: session.createDataFrame([(d, d[:2]) for d in said], "`Work Date` string, v string")

    day, since = exprs.parse_date("work_date", "day_mon_year"), dt.date(2025, 3, 10)
    for said in (("01-Jan-2025", "09-Mar-2025", "11-Mar-2025"), ("12-Mar-2025", "01-Apr-2025")):
        report = landing.run(spark, [landing.Source("cards", cards(*said), "text_window", landing.window_writer(day, since))],
                             since)
        assert report.first()["status"] == "landed", report.first()["message"]
    got = [r["work_date"] for r in rows(spark.table("text_window"))]
    # the first load keeps all it was given, the second replaces what its window covers
    assert got == ["01-Apr-2025", "01-Jan-2025", "09-Mar-2025", "12-Mar-2025"]


def test_window_loads_account_for_every_row(spark):
    since, table = dt.date(2025, 3, 10), "window_rows"

    def load(*said):
        rows_in = [(None if d is None else dt.date(*d), v) for d, v in said]
        source = landing.Source("w", lambda s, _: s.createDataFrame(rows_in, "day date, v string"), table,
                                landing.window_writer(F.to_date("day"), since))
        return landing.run(spark, [source], since).first()

    first = load(((2025, 1, 5), "old"), (None, "undated"), ((2025, 3, 20), "in"))
    assert (first["status"], first["row_count"], first["late_rows"]) == ("landed", 3, 0), first["message"]
    assert sorted(r["v"] for r in spark.table(table).collect()) == ["in", "old", "undated"]
    again = load(((2025, 1, 6), "late"), (None, "undated too"), ((2025, 3, 21), "new"))
    assert (again["status"], again["row_count"], again["late_rows"]) == ("landed", 1, 2), again["message"]
    assert sorted(r["v"] for r in spark.table(table).collect()) == ["new", "old", "undated"]
    assert sorted(r["v"] for r in spark.table(f"{table}_late").collect()) == ["late", "undated too"]


def test_failing_snapshot_leaves_the_old_rows(spark):
    for n in range(4):
        landing.replace_snapshot(spark.range(n + 1).withColumn("m", F.lit("2025-01-01")), "kept_rows", "m")
    bad = spark.range(100).select(F.when(F.col("id") > 90, F.raise_error(F.lit("bad value"))).otherwise(F.col("id")).alias("id"),
                                  F.lit("2025-01-01").alias("m"))
    with pytest.raises(PySparkException, match="bad value"):
        landing.replace_snapshot(bad, "kept_rows", "m")
    assert spark.table("kept_rows").count() == 4 and dict(spark.table("kept_rows").dtypes)["m"] == "string"

def test_merge_window(spark):
    old = days(spark, ((2025, 1, 5), "old"), ((2025, 3, 5), "replaced"))
    new = days(spark, ((2025, 3, 6), "new"), ((2025, 1, 1), "late"))
    assert [r["v"] for r in rows(landing.merge_window(old, new, "day", "2025-03-01"), "day")] == ["old", "new"]


def test_run_reports_every_source(spark):
    def broken(*_):
        raise OSError("no route")

    def unset(*_):
        raise landing.NotConfigured("no folder set")

    def todo(*_):
        raise NotImplementedError("no mapping yet")

    def good(session, since):
        return landing.since_window(days(session, ((2025, 1, 1), "a"), ((2025, 3, 1), "b"), ((2025, 3, 2), "c")),
                                    "day", since)

    report = landing.run(spark, [landing.Source(n, f, f"run_{n}") for n, f in
                                 (("good", good), ("broken", broken), ("unset", unset), ("todo", todo))],
                         dt.date(2025, 2, 1), audit="load_audit")
    got = {r["source"]: (r["status"], r["row_count"]) for r in report.collect()}
    assert got == {"good": ("landed", 2), "broken": ("error", None), "unset": ("skipped", None), "todo": ("todo", None)}
    assert landing.failed(report) and spark.table("run_good").count() == 2 and spark.table("load_audit").count() == 4


def test_snapshot_replaces(spark):
    landing.replace_snapshot(spark.range(3), "snap")
    landing.replace_snapshot(spark.range(10, 11), "snap")
    assert [r["id"] for r in spark.table("snap").collect()] == [10]


def test_seeds(spark, tmp_path):
    _, folder = site_group.write(tmp_path)
    loaded = seeds.load_seeds(spark, folder)
    assert dict(loaded["gl_account_map"].dtypes)["account_no"] == "string"
    assert loaded["ukg_earning_map"].where("earning_code = 'OT'").first()["pay_multiplier"] == 1.5
    jobs = tmp_path / "seeds" / "ukg_job_map.csv"
    jobs.write_text(jobs.read_text() + '"X9","say ""hi"", you","Other",false\n')
    assert seeds.load_seed(spark, folder, "ukg_job_map").where("job_code = 'X9'").first()["job_title"] == 'say "hi", you'
    crosswalk = tmp_path / "seeds" / "location_crosswalk.csv"
    crosswalk.write_text(crosswalk.read_text() + "ukg,U1,2\n")
    with pytest.raises(checks.CheckFailed, match="location_crosswalk"):
        seeds.load_seed(spark, folder, "location_crosswalk")


@pytest.mark.parametrize("splits", [False, True])
def test_stream_lands_each_file_once(spark, tmp_path, splits):
    drop, out, mark = tmp_path / "drop", str(tmp_path / "out"), str(tmp_path / "mark")

    def catch_up():
        drops.land(drops.watch(spark, str(drop)), ["Item Number", "Qty"], out, mark, splits=splits).awaitTermination()
        return rows(spark.read.parquet(out).select("item_number", "qty"))

    put(drop, "a.csv", "Item Number,Qty\n1,10\n")
    assert catch_up() == [{"item_number": "1", "qty": "10"}]
    assert len(catch_up()) == 1
    put(drop, "b.csv", "Extra,Qty,Item Number\nx,20,2\n")  # more columns, in another order
    assert [r["qty"] for r in catch_up()] == ["10", "20"]


COLUMNS = ["Item Number", "Qty"]


def stock(spark, table):
    return {r["item_number"]: r["qty"] for r in spark.table(table).collect()}


def test_merged_files_the_latest_wins(spark, tmp_path):
    drop, mark, table = tmp_path / "drop", str(tmp_path / "mark"), "merged_stock"

    def catch_up():
        drops.merge(drops.watch(spark, str(drop)), COLUMNS, ["item_number"], table, mark).awaitTermination()
        return stock(spark, table)

    put(drop, "a.csv", "Item Number,Qty\n1,10\n2,20\n", when=1_000)
    put(drop, "b.csv", "Extra,Qty,Item Number\nx,21,2\n", when=2_000)
    assert catch_up() == {"1": "10", "2": "21"}
    assert catch_up() == {"1": "10", "2": "21"}  # a restart without news
    put(drop, "c.csv", "Item Number,Qty\n1,11\n3,30\n", when=4_000)
    assert catch_up() == {"1": "11", "2": "21", "3": "30"}
    before = versions.load(spark, table)
    put(drop, "again.csv", "Item Number,Qty\n2,20\n1,10\n", when=9_000)  # the rows of a.csv, under another name
    assert catch_up() == {"1": "11", "2": "21", "3": "30"} and versions.load(spark, table).number == before.number
    put(drop, "old.csv", "Item Number,Qty\n3,29\n4,40\n", when=3_000)  # late: older than what is known of 3
    assert catch_up() == {"1": "11", "2": "21", "3": "30", "4": "40"}
    touched = versions.changed(spark, table, before.number)
    assert 0 < len(touched) <= 2  # the buckets of 3 and 4


def test_a_merge_that_fails_is_repeated(spark, tmp_path, monkeypatch):
    drop, table = tmp_path / "drop", "merged_again"
    put(drop, "a b+c%20.csv", "Item Number,Qty\n1,10\n1,12\n2,20\n", when=1_000)
    listing = landing.delivered(spark, str(drop))
    with monkeypatch.context() as m:
        plain = versions.write

        def fails(df, to, *rest):
            if to.endswith("_files"):
                raise OSError("lost")
            return plain(df, to, *rest)

        m.setattr(versions, "write", fails)
        with pytest.raises(OSError):
            drops.merge_files(spark, listing, COLUMNS, ["item_number"], table)
    assert drops.merge_files(spark, listing, COLUMNS, ["item_number"], table) == 1
    assert stock(spark, table) == {"1": "12", "2": "20"}
    assert drops.merge_files(spark, listing, COLUMNS, ["item_number"], table) == 0
    assert spark.table(f"{table}_files").count() == 1 and drops.merge_files(spark, listing.limit(0), COLUMNS, ["item_number"], table) == 0


def test_office_stamp(spark):
    offices = {"1": spark.range(2), "2": spark.range(1)}
    assert rows(extracts.stamped(offices).groupBy("ClinicNum").agg(F.count("*").alias("n"))) == \
        [{"ClinicNum": "1", "n": 2}, {"ClinicNum": "2", "n": 1}]
