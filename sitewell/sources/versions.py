"""Tables in versions: each is a list of month folders behind a view.

The rows of a table lie in folders by period (a month as 202503, 0 for rows without one) and by the run that
wrote them. A version says for each period which run's folder counts; the view is the newest version. A write
adds folders beside those of earlier versions and only then, when they are complete, says so in a new version
and turns the view to it. So a load that fails at any step leaves every old row, readers of the version before
keep their folders, periods that a load does not cover keep their files, and a version can be taken back.

What a version was built from is kept with it. Two versions of a table tell which periods lie between them:
that is all a later layer has to read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD, RUN = "_period", "_run"
UNDATED = 0


class OtherColumns(ValueError):
    """Rows do not have the columns of the table they are written to."""


class OtherPeriods(ValueError):
    """Rows belong to a period that the write does not replace."""


class Overtaken(RuntimeError):
    """Another write ended first; this one's folders are not used."""


@dataclass(frozen=True)
class Version:
    number: int
    folders: dict[int, str]  # by period the run whose folder counts
    schema: T.StructType
    sources: dict[str, str] = field(default_factory=dict)  # what it was built from

    def files(self) -> set[tuple[int, str]]:
        return set(self.folders.items())


def month_code(day: str | Column) -> Column:
    """A date's month as a period, such as 202503."""
    day = F.col(day) if isinstance(day, str) else day
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(UNDATED)).cast("int")


def root(spark: SparkSession, table: str) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}__months"


def _path(spark: SparkSession, path: str):
    """A path and its file system, whichever store it is in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, pattern: str) -> list[str]:
    files, at = _path(spark, pattern)
    return sorted(f.getPath().toString() for f in files.globStatus(at) or [])


def _manifest(spark: SparkSession, table: str, number: int) -> str:
    return f"{root(spark, table)}/_versions/{number:08d}.json"


def numbers(spark: SparkSession, table: str) -> list[int]:
    """The versions there are, oldest first."""
    return [int(p.split("/")[-1].removesuffix(".json")) for p in _names(spark, f"{root(spark, table)}/_versions/*.json")]


def load(spark: SparkSession, table: str, number: int | None = None) -> Version | None:
    """A version, the newest unless a number is given; None where there is none."""
    if number is None:
        number = max(numbers(spark, table), default=None)
        if number is None:
            return None
    files, at = _path(spark, _manifest(spark, table, number))
    stream = files.open(at)
    try:
        held = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(number, {int(p): r for p, r in held["folders"].items()}, T.StructType.fromJson(held["schema"]), held["sources"])


def _publish(spark: SparkSession, table: str, version: Version) -> Version:
    """Says that a version is there: its list is written aside and renamed, so it is whole or absent."""
    said = json.dumps({"folders": version.folders, "schema": version.schema.jsonValue(), "sources": version.sources})
    files, final = _path(spark, _manifest(spark, table, version.number))
    _, aside = _path(spark, f"{root(spark, table)}/_versions/.{uuid.uuid4().hex}")
    out = files.create(aside, False)
    try:
        out.write(bytearray(said.encode()))
    finally:
        out.close()
    if files.exists(final) or not files.rename(aside, final):
        files.delete(aside, False)
        raise Overtaken(f"{table}: version {version.number} exists")
    point(spark, table, version)
    return version


def _runs(version: Version, periods: Collection[int] | None = None) -> dict[str, list[int]]:
    by_run: dict[str, list[int]] = {}
    for period, run in sorted(version.folders.items()):
        if periods is None or period in periods:
            by_run.setdefault(run, []).append(period)
    return by_run


def point(spark: SparkSession, table: str, version: Version) -> None:
    """Turn the view to a version. Its condition is on folder names, so other folders are not read."""
    typed = lambda value: ", ".join(
        f"CAST({value(f)} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in version.schema.fields)
    if version.folders:
        where = " OR ".join(f"({RUN} = '{run}' AND {PERIOD} IN ({', '.join(map(str, periods))}))"
                            for run, periods in _runs(version).items())
        body = f"SELECT {typed(lambda f: f'`{f.name}`')} FROM parquet.`{root(spark, table)}` WHERE {where}"
    else:
        body = f"SELECT {typed(lambda f: 'NULL')} WHERE false"
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is a table that has no versions")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS {body}")


def read(spark: SparkSession, table: str, periods: Collection[int] | None = None, number: int | None = None,
         with_period: bool = False) -> DataFrame:
    """Rows of some periods of a version; other folders are not read."""
    version = load(spark, table, number)
    if version is None:
        raise LookupError(f"{table} has no version")
    columns = [*version.schema.names, *([PERIOD] if with_period else [])]
    schema = T.StructType([*version.schema.fields, T.StructField(PERIOD, T.IntegerType()), T.StructField(RUN, T.StringType())])
    by_run = _runs(version, periods)
    if not by_run:
        return spark.createDataFrame([], schema).select(columns)
    chosen = F.lit(False)
    for run, some in by_run.items():
        chosen = chosen | ((F.col(RUN) == run) & F.col(PERIOD).isin(some))
    return spark.read.schema(schema).parquet(root(spark, table)).where(chosen).select(columns)


def same_columns(df: DataFrame, table: str, version: Version | None) -> None:
    if version is not None and version.schema.simpleString() != df.schema.simpleString():
        raise OtherColumns(f"{table}: {df.schema.simpleString()} instead of {version.schema.simpleString()}")


def write(df: DataFrame, table: str, period: Column, replaces: Callable[[int], bool] = lambda _: True,
          sources: dict[str, str] | None = None) -> Version:
    """A new version: the periods that ``replaces`` holds for come from ``df`` alone, the others stay as they
    are. Rows of a period that is not replaced fail the write, before anything changes."""
    spark, before = df.sparkSession, load(df.sparkSession, table)
    same_columns(df, table, before)
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    placed = df.withColumn(PERIOD, period.cast("int")).withColumn(RUN, F.lit(run))
    # rows of a period meet before the write, else every task opens a file in every folder
    placed.hint("rebalance", PERIOD).write.mode("append").partitionBy(PERIOD, RUN).parquet(root(spark, table))
    found = {int(p.split("/")[-2].split("=")[1]) for p in _names(spark, f"{root(spark, table)}/{PERIOD}=*/{RUN}={run}")}
    if strange := sorted(p for p in found if not replaces(p)):
        raise OtherPeriods(f"{table}: rows of {strange[:5]}, which this write does not replace")
    stay = {} if before is None else {p: r for p, r in before.folders.items() if not replaces(p)}
    number = 1 if before is None else before.number + 1
    return _publish(spark, table, Version(number, stay | {p: run for p in found}, df.schema, sources or {}))


def take_back(spark: SparkSession, table: str) -> Version:
    """The version before the newest one, as the newest."""
    *_, older, newest = [None, None, *numbers(spark, table)]
    if older is None:
        raise LookupError(f"{table} has no earlier version")
    held = load(spark, table, older)
    return _publish(spark, table, Version(newest + 1, held.folders, held.schema, held.sources))


def changed(spark: SparkSession, table: str, since: int | None) -> set[int]:
    """Periods whose folder is another one now than in version ``since``; all if that is not kept any more."""
    now = load(spark, table)
    then = set() if since is None or since not in numbers(spark, table) else load(spark, table, since).files()
    return {period for period, _ in now.files() ^ then}


def forget(spark: SparkSession, table: str, keep: int = 2) -> int:
    """Remove versions before the last ``keep`` and the folders only they name; how many folders went. Folders
    no version names belong to a write that is under way, or failed, and stay."""
    known = numbers(spark, table)
    kept = set().union(*(load(spark, table, n).files() for n in known[-keep:]))
    old = known[:-keep]
    gone = set().union(*(load(spark, table, n).files() for n in old)) - kept
    for number in old:  # first what names a folder, then the folder
        files, at = _path(spark, _manifest(spark, table, number))
        files.delete(at, False)
    for period, run in sorted(gone):
        files, at = _path(spark, f"{root(spark, table)}/{PERIOD}={period}/{RUN}={run}")
        files.delete(at, True)
    return len(gone)
