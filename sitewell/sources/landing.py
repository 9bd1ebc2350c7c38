"""Landing: files, database queries and windows of them into raw tables, every column text."""

from __future__ import annotations

import csv
import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewell.functions.names import normalize_columns, raw_table, snake
from sitewell.session import checkpointing
from sitewell.sources import versions

# How many days back an extract reaches when no date is given.
DEFAULT_WINDOW_DAYS = 45

AUDIT_SCHEMA = ("source string, status string, row_count bigint, late_rows bigint, message string, "
                "finished_at timestamp")


class NotConfigured(RuntimeError):
    """The source lacks a setting; it is skipped, not failed."""


class MissingColumns(ValueError):
    """A delivered file does not have the columns it must have."""


class NothingDelivered(FileNotFoundError):
    """No file in the drop folder matches."""


# --- files ------------------------------------------------------------------------------------------

def delivered(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Listing of a drop folder: path, modificationTime, length. File contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder) \
        .select("path", "modificationTime", "length")


def newest(spark: SparkSession, folder: str, pattern: str = "*.csv") -> Row:
    """Path and length of the file delivered last."""
    latest = F.struct("modificationTime", "path")
    found = delivered(spark, folder, pattern).agg(F.max_by("path", latest).alias("path"),
                                                  F.max_by("length", latest).alias("length")).first()
    if found["path"] is None:
        raise NothingDelivered(f"no {pattern} in {folder}")
    return found


def same_path(path: str) -> str:
    """A path as a listing gives it, with one slash after the scheme where no host follows."""
    return path.replace(":///", ":/")


SMALL_FILE = 1 << 20
# A record up to its line's end: breaks inside quotes belong to it.
_RECORD = r'^(?:[^"\n]++|"[^"]*+")*+'


def headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of every file, by path; a file without a line has no entry. One job reads the small
    files, many to a task; for the others one more has a task for each, which stops after the first record.
    What comes to the driver is a row per file, like the listing."""
    def first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = None
        for batch in batches:
            for line in batch.column(1).to_pylist():
                text = line if text is None else f"{text}\n{line}"
                if text.count('"') % 2 == 0:
                    yield pa.RecordBatch.from_pydict({"file": [batch.column(0)[0].as_py()], "header": [text]})
                    return

    if not paths:
        return {}
    small = spark.read.format("binaryFile").load(paths).where(F.col("length") <= SMALL_FILE).select(
        "path", F.regexp_extract(F.col("content").cast("string"), _RECORD, 0).alias("header"))
    found = {r["path"]: r["header"] for r in small.collect()}
    if large := [p for p in paths if same_path(p) not in found]:
        whole = str(1 << 40)  # files are not split, and no two share a task
        with _settings(spark, {"spark.sql.files.maxPartitionBytes": whole, "spark.sql.files.openCostInBytes": whole,
                               "spark.sql.files.minPartitionNum": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "64"}):
            lines = spark.read.option("lineSep", "\n").text(large).select(F.col("_metadata.file_path").alias("file"), "value")
            found |= {same_path(unquote(r["file"])): r["header"] for r in lines.mapInArrow(first_record, "file string, header string").collect()}
    return {path: column_names(header) for path, header in found.items() if header}


def column_names(header: str) -> tuple[str, ...]:
    """Names of a header record, as Spark itself gives them: one without a name is called by its place,
    names that differ in case at most carry theirs."""
    said = next(csv.reader([header.removeprefix("\ufeff").rstrip("\r")]), [])  # quoted breaks stay in a name
    lower = [n.lower() for n in said]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(said))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_text(spark: SparkSession, path: str | list[str], quoted_newlines: bool = True, splits: bool = False,
              names: tuple[str, ...] | None = None, file: str | None = None) -> DataFrame:
    """CSV files with one header, all columns text, names as delivered. ``names`` saves the job that finds
    them; ``file`` adds a column with the path a row comes from.

    Without inferSchema Spark reads every column as string and only looks at the header; a byte
    order mark is dropped. Line breaks inside quotes stay in their field. Spark itself can do that
    only by giving a file to one task, so the caller may ask for ``splits``: the file is then read
    in pieces whose lines are put back together by :func:`records`. The choice is the caller's and
    never follows from a file's size. Both give the same rows; the split reader takes lines that
    end in a line feed, with or without a carriage return, and fails on a file whose header is cut
    by bare carriage returns or whose last quote stays open. Without ``quoted_newlines`` every line
    is a record and files are split as well.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if names is None and (file or splits and quoted_newlines):
        names = tuple(reader.option("multiLine", True).csv(path).columns)
    schema = None if names is None else T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not (splits and quoted_newlines):
        reader = reader if schema is None else reader.schema(schema)
        read = reader.option("multiLine", quoted_newlines).csv(path)
        return read if file is None else read.select("*", F.col("_metadata.file_path").alias(file))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"), F.col("value").alias("line"))
    bare = F.instr(F.regexp_replace("text", "\r\n|\r$", ""), "\r") > 0
    # record 0 is the header
    data = F.when((F.col("record") == 0) & bare, F.raise_error(F.concat(
        F.col("file"), F.lit(": lines end in carriage returns, which the split reader does not take")))
    ).otherwise(F.col("record") > 0)
    parsed = parse_records(records(lines).where(data), schema)
    return parsed.select("_r.*") if file is None else parsed.select("_r.*", F.col("file").alias(file))


def read_alike(spark: SparkSession, paths: list[str], quoted_newlines: bool = True, splits: bool = False,
               file: str | None = None) -> dict[tuple[str, ...], tuple[list[str], DataFrame]]:
    """Files read together by their header: per list of column names its files and one scan of them."""
    found, groups = headers(spark, paths), {}
    for path in paths:
        groups.setdefault(found.get(same_path(path), ()), []).append(path)
    return {names: (some, read_text(spark, some, quoted_newlines, splits, names, file)) for names, some in groups.items()}


# What a line does to a quoted field, as patterns: quotes open a field only where it begins.
_REST = r'(?:[^"]++|"")*+'
_FIELD = rf'(?:"{_REST}"[^,]*+|[^",][^,]*+|)'
_OPENS = rf'(?:{_FIELD},)*+"{_REST}$'


def line_effect(line: Column) -> Column:
    """What the quotes of a line do: 0 leaves the state (inside or outside quotes) as it was, 1 turns
    it round, 2 ends outside and 3 ends inside, whatever it was."""
    plain = F.instr(line, '"') == 0
    from_outside = line.rlike(f"(?s)^{_OPENS}")
    from_inside = line.rlike(f'(?s)^{_REST}(?:$|"[^,]*+,{_OPENS})')
    return F.when(plain, 0).when(from_outside & from_inside, 3).when(from_outside, 1).when(from_inside, 0).otherwise(2)


def records(lines: DataFrame) -> DataFrame:
    """Lines of CSV files put together to records (file, record, text), numbered from 0 in each file.

    ``lines`` has file, block, position and line: a block is a stretch of a file read by one task,
    position orders the lines in it. A line continues the record before it when it begins inside
    quotes. The state at a line is that of the last line before it with a fixed effect, turned round
    by those since; where its block has none, it also depends on the state at the block's begin. So
    only block summaries, a row per block, are ever put in file order. A file that ends inside quotes
    fails.
    """
    in_block = Window.partitionBy("file", "block").orderBy("position")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    lined = lines.withColumn("_e", line_effect(F.regexp_replace("line", "\r$", "")))
    turns = F.coalesce(F.sum(F.when(F.col("_e") == 1, 1).otherwise(0)).over(before), F.lit(0))
    fixed = F.when(F.col("_e") > 1, F.struct((F.col("_e") - 2).alias("inside"), F.col("_t").alias("turns")))
    counted = lined.withColumn("_t", turns).withColumn("_f", F.last(fixed, ignorenulls=True).over(before))
    # the state at a line: known, or relative to the block's begin
    counted = counted.withColumn("_known", F.col("_f").isNotNull()).withColumn(
        "_s", F.when(F.col("_known"), F.col("_f.inside") + F.col("_t") - F.col("_f.turns")).otherwise(F.col("_t")) % 2)
    relative = ~F.col("_known")
    starts_if = lambda inside: F.count_if(F.when(relative, (F.col("_s") + inside) % 2).otherwise(F.col("_s")) == 0)
    after = F.when(F.col("_e") > 1, F.col("_e") - 2).when(F.col("_e") == 1, 1 - F.col("_s")).otherwise(F.col("_s"))
    blocks = counted.groupBy("file", "block").agg(
        starts_if(0).alias("_out"), starts_if(1).alias("_in"),
        F.max_by(F.struct((F.col("_known") | (F.col("_e") > 1)).alias("known"), after.alias("state")), "position").alias("_end"))
    at = Window.partitionBy("file").orderBy("block")
    earlier = at.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.when(~F.col("_end.known"), F.col("_end.state")).otherwise(0)).over(earlier), F.lit(0))
    last = F.when(F.col("_end.known"), F.struct(F.col("_end.state").alias("state"), F.col("_u").alias("u")))
    blocks = blocks.withColumn("_u", turned).withColumn("_l", F.last(last, ignorenulls=True).over(earlier)).withColumn(
        "_p", F.when(F.col("_l").isNotNull(), F.col("_l.state") + F.col("_u") - F.col("_l.u")).otherwise(F.col("_u")) % 2)
    closing = F.when(F.col("_end.known"), F.col("_end.state")).otherwise((F.col("_p") + F.col("_end.state")) % 2)
    end = F.last(closing).over(at.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    checked = F.when(end == 1, F.raise_error(F.concat(F.col("file"), F.lit(": a quote is never closed")))).otherwise(F.col("_p"))
    blocks = blocks.withColumn("_starts", F.when(F.col("_p") == 0, F.col("_out")).otherwise(F.col("_in"))).select(
        "file", "block", checked.cast("int").alias("_p"), F.coalesce(F.sum("_starts").over(earlier), F.lit(0)).alias("_first"))
    state = F.when(F.col("_known"), F.col("_s")).otherwise((F.col("_s") + F.col("_p")) % 2)
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = counted.join(blocks, ["file", "block"]).withColumn("_outside", state == 0).withColumn(
        "record", F.col("_first") + F.sum(F.when(F.col("_outside"), 1).otherwise(0)).over(upto) - 1)
    # most records are one line, which starts and closes them: only the others are brought together
    alone = F.col("_outside") & F.col("_e").isin(0, 2)
    single = numbered.where(alone).select("file", "record", F.col("line").alias("text"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "position", "line")))
    several = numbered.where(~alone).groupBy("file", "record").agg(F.array_join(pieces["line"], "\n").alias("text"))
    return single.unionByName(several)


def parse_records(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse the text of records to a struct column ``_r``. In a file whose lines end in carriage
    return and line feed, breaks inside quotes become plain line feeds, as when Spark reads it whole."""
    windows = F.col("text").endswith("\r")
    text = F.when(windows, F.replace(F.regexp_replace("text", "\r$", ""), F.lit("\r\n"), F.lit("\n"))) \
        .otherwise(F.col("text"))
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    return rows.where(text != "").select(
        "file", "record", F.from_csv(text, ddl, {"escape": '"'}).alias("_r"))


def required(df: DataFrame, columns: list[str], name: str = "file") -> DataFrame:
    """Exactly ``columns``, in that order. Others are dropped; absent ones fail before any write."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{name}: missing columns {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def read_drop(spark: SparkSession, folder: str, columns: list[str], pattern: str = "*.csv",
              quoted_newlines: bool = True, splits: bool = False) -> DataFrame:
    """The newest export of a drop folder, checked against the columns it must have."""
    path = newest(spark, folder, pattern)["path"]
    return required(read_text(spark, path, quoted_newlines, splits), columns, path)


def land_csv(spark: SparkSession, root: str, quoted_newlines: bool = True, splits: bool = False) -> dict[str, DataFrame]:
    """Every <system>/<file>.csv under ``root`` as a lazily read raw table, keyed by its name. Files
    whose names come to one table are its parts if their columns agree, else the landing fails.

    One listing, one job for the headers, and a scan for each header of a table: neither jobs nor plans
    grow with the number of files. Only the listing comes to the driver, a row per file.
    """
    files: dict[str, list[str]] = {}
    for path in (f["path"] for f in delivered(spark, f"{root.rstrip('/')}/*/").orderBy("path").toLocalIterator()):
        folder, file = path.split("/")[-2:]
        files.setdefault(raw_table(folder, file.removesuffix(".csv")), []).append(path)
    found = headers(spark, [path for some in files.values() for path in some])
    tables: dict[str, DataFrame] = {}
    for name, paths in files.items():
        alike: dict[tuple[str, ...], list[str]] = {}
        for path in paths:
            alike.setdefault(found.get(same_path(path), ()), []).append(path)
        parts = [normalize_columns(read_text(spark, some, quoted_newlines, splits, names)) for names, some in alike.items()]
        for part, some in zip(parts, alike.values()):
            if set(part.columns) != set(parts[0].columns):
                raise MissingColumns(f"{some[0]}: other columns than the files landed as {name} before it")
        tables[name] = reduce(DataFrame.unionByName, parts)
    return tables


# --- API pages --------------------------------------------------------------------------------------

def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """API responses, one file per page, as rows of text for extracts.flatten_json and flatten_xml."""
    return spark.read.text(path, wholetext=True)


# --- databases --------------------------------------------------------------------------------------

def jdbc_options(url: str, query: str, since: dt.date, split_on: str | None = None,
                 bounds: tuple[int, int] | None = None, parts: int = 8, fetch: int = 10_000) -> dict[str, str]:
    """Options of a read-only query extract. ``query`` contains ``:since`` once or more. With a
    numeric ``split_on`` and its bounds the pull runs as ``parts`` ranges side by side; rows outside
    the bounds still arrive, in the first and last range."""
    sql = query.replace(":since", f"'{since.isoformat()}'")
    options = {"url": url, "fetchsize": str(fetch)}
    if split_on is None:
        return {**options, "query": sql}
    low, high = bounds
    return {**options, "dbtable": f"({sql}) q", "partitionColumn": split_on, "lowerBound": str(low),
            "upperBound": str(high), "numPartitions": str(parts)}


def read_query(spark: SparkSession, columns: list[str], **options) -> DataFrame:
    df = spark.read.format("jdbc").options(**jdbc_options(**options)).load()
    return required(df, columns, "query")


# --- windows and writes -----------------------------------------------------------------------------

def default_since(today: dt.date | None = None) -> dt.date:
    return (today or dt.date.today()) - dt.timedelta(days=DEFAULT_WINDOW_DAYS)


def _day(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def since_window(df: DataFrame, day: str | Column, since) -> DataFrame:
    """Rows on or after a date. The column is compared as it is, so the filter can be pushed down."""
    return df.where(_day(day) >= F.lit(since).cast("date"))


def as_text(df: DataFrame) -> DataFrame:
    """Normalized names, every value as text: the form of the raw layer."""
    named = normalize_columns(df)
    return named.select(*[F.col(c).cast("string").alias(c) for c in named.columns])


def replace_snapshot(df: DataFrame, table: str, partition: str | None = None) -> None:
    """Replace a table by a full delivery. It is written to a folder of its own; only when that is
    complete does the name, a view, turn to it. A failing write leaves the old rows as they were, and
    readers that have begun go on with the folder they know: of complete writes the last two are kept,
    older ones go. A folder without its mark of success belongs to a write under way and stays."""
    spark = df.sparkSession
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}__runs"
    folder = f"{root}/{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    writer = df.write if partition is None else df.write.partitionBy(partition)
    writer.parquet(folder)
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in df.schema.fields)
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {table}")  # of an earlier layout; its rows are all in the new folder's place
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {columns} FROM parquet.`{folder}`")
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    complete = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/_SUCCESS"))
    for old in sorted(str(f.getPath().getParent()) for f in complete)[:-2]:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)


def merge_window(existing: DataFrame, arrived: DataFrame, day: str | Column, since) -> DataFrame:
    """History before ``since`` from the table, everything else from the delivery.

    Arrived rows older than ``since`` are not part of the window; :func:`late_rows` reports them.
    """
    cut = F.lit(since).cast("date")
    return existing.where((_day(day) < cut) | _day(day).isNull()).unionByName(arrived.where(_day(day) >= cut))


def late_rows(arrived: DataFrame, day: str | Column, since) -> DataFrame:
    """Delivered rows the window does not cover, to be written to a reject table."""
    return arrived.where((_day(day) < F.lit(since).cast("date")) | _day(day).isNull())


def window_accounting(existing: DataFrame, arrived: DataFrame, day: str | Column, since) -> DataFrame:
    """What a window load does with every row, by month: kept and replaced rows of the table, and rows of
    the delivery that enter it, come late or have no date."""
    cut, month = F.lit(since).cast("date"), F.date_format(_day(day), "yyyy-MM").alias("month")
    old = existing.select(month, F.when(_day(day) >= cut, "replaced").otherwise("kept").alias("fate"))
    new = arrived.select(month, F.when(_day(day).isNull(), "undated").when(_day(day) < cut, "late").otherwise("entered").alias("fate"))
    return old.unionByName(new).groupBy("month").agg(*[
        F.count_if(F.col("fate") == f).alias(f) for f in ("kept", "replaced", "entered", "late", "undated")])


def replace_window(df: DataFrame, table: str, day: str | Column, since: dt.date) -> int:
    """Load a delivery that only reaches back to ``since`` without losing older history.

    ``day`` is the business date: a date column, or an expression that parses a text one. The table
    is kept in versions by its month, see :mod:`sitewell.sources.versions`. Months after the one
    ``since`` falls in come from the delivery alone; the boundary month is its older rows plus the
    delivery; a month in the window that the delivery no longer mentions goes. Months before keep
    their files, so the cost follows the window, not the history, and a load that fails at any step
    leaves the old rows.

    The delivery is evaluated once. The first load keeps all of it. Later, rows that are older than
    the window or have no date go to ``<table>_late``, where they stand once for each ``since``,
    however often the load is repeated; their number is returned.
    """
    spark, cut, month = df.sparkSession, F.lit(since).cast("date"), versions.month_code(_day(day))
    checkpointing(spark)
    delivery = df.checkpoint()
    before = versions.load(spark, table)
    if before is None:
        versions.write(delivery, table, month)
        return 0
    versions.same_columns(delivery, table, before)
    late = late_rows(delivery, day, since).withColumn("_since", cut)
    n_late, window = late.count(), since.year * 10_000 + since.month * 100 + since.day
    set_aside = versions.load(spark, f"{table}_late")
    if n_late or set_aside and window in set_aside.folders:
        versions.write(late, f"{table}_late", F.lit(window), lambda period: period == window)
    boundary = since.year * 100 + since.month
    kept = versions.read(spark, table, {boundary}).where(_day(day) < cut)
    rebuilt = delivery.where(_day(day) >= cut).unionByName(kept)
    versions.write(rebuilt, table, month, lambda period: period >= boundary)
    return n_late


def window_writer(day: str | Column, since: dt.date) -> Callable[[DataFrame, str], int]:
    """A write for :class:`Source` that replaces a window instead of the whole table."""
    return lambda df, table: replace_window(df, table, day, since)


# --- runs -------------------------------------------------------------------------------------------

@dataclass
class Source:
    """One thing to load: a name, how to read it, where it goes."""

    name: str
    read: Callable[[SparkSession, dt.date], DataFrame]
    table: str
    write: Callable[[DataFrame, str], int | None] = field(default=replace_snapshot)  # returns late rows, if it keeps any aside


# The outcomes of a source that raised, by the kind of error. The first that fits counts.
OUTCOMES = {NotConfigured: "skipped", NotImplementedError: "todo", Exception: "error"}


def load(spark: SparkSession, source: Source, since: dt.date) -> tuple[int, int]:
    """Writes one source as text: rows in its table's delivery and rows set aside as late. Rows are counted
    while they are written, not by a second scan."""
    seen = Observation(f"rows_{snake(source.name)}")
    late = source.write(as_text(source.read(spark, since)).observe(seen, F.count(F.lit(1)).alias("n")), source.table) or 0
    return seen.get["n"] - late, late


def run(spark: SparkSession, sources: list[Source], since: dt.date | None = None,
        audit: str | None = None) -> DataFrame:
    """Load every source and report on each: landed, skipped, todo or error, with the rows that reached
    its table and those that came late. One failing source does not stop the others."""
    since, report = since or default_since(), []
    for source in sources:
        counts, message, status = (None, None), None, "landed"
        try:
            counts = load(spark, source, since)
        except Exception as problem:  # noqa: BLE001 - it becomes a row of the report
            status = next(word for kind, word in OUTCOMES.items() if isinstance(problem, kind))
            message = f"{type(problem).__name__}: {problem}"
        report.append((source.name, status, *counts, message, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)))
    rows = spark.createDataFrame(report, AUDIT_SCHEMA)
    if audit:
        rows.write.mode("append").format("parquet").saveAsTable(audit)
    return rows


def failed(report: DataFrame) -> bool:
    """Whether a run must end with an error for its caller."""
    return not report.where(F.col("status") != "landed").isEmpty()
