"""Packaging marts for a reader: compact columnar documents, and back to rows.

A document holds the arrays of one chunk (a span of months for a block of sites), so its size has
a bound that does not depend on how many sites or months exist: BLOCK sites x SPAN months x the
codes of the maps. A small warehouse gets one document per dataset and span, a large one more.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewell.functions import exprs
from sitewell.session import checkpointing
from sitewell.sources import landing

# Sites from this key on are connector test accounts; months per chunk.
TEST_SITE_KEY = 99
SPAN = 6
BLOCK = 500


def settled(mart: DataFrame) -> DataFrame:
    """A mart that is computed once, for documents that read it several times. A build publishes
    from written tables and does not need this."""
    checkpointing(mart.sparkSession)
    return mart.checkpoint()


def without_test_sites(df: DataFrame, first_test_key: int = TEST_SITE_KEY) -> DataFrame:
    return df.where(F.col("location_key") < first_test_key)


def as_rows(mart: DataFrame, leave_out: list[str], first_test_key: int | None = None, scale: int = 2) -> DataFrame:
    """A mart for a row-oriented document: without dimension columns, months as text, every amount
    rounded. Test sites stay unless ``first_test_key`` says where they begin."""
    kept = mart if first_test_key is None else without_test_sites(mart, first_test_key)
    return exprs.rounded(kept.drop(*leave_out).withColumn("month", exprs.month_text("month")), scale)


def site_rows(locations: DataFrame) -> DataFrame:
    return without_test_sites(locations).select(
        "location_key", "location_name", "region", "specialty", "operatories", "pms_system")


def chunked(df: DataFrame, span: int = SPAN, month: str = "month") -> DataFrame:
    """Add ``month_index`` (months since the first) and ``chunk`` (spans back from the newest month,
    0 = newest). The two ends are one scalar subquery, so no row is joined to anything."""
    ends = df.select(F.struct(F.min(month).alias("first"), F.max(month).alias("last"))).scalar()
    first, last = ends["first"], ends["last"]
    return df.withColumn("month_index", exprs.months_apart(month, first)) \
        .withColumn("chunk", F.floor(exprs.months_apart(last, month) / F.lit(span)).cast("int"))


def calendar_chunks(df: DataFrame, span: int = SPAN, month: str = "month") -> DataFrame:
    """Add ``chunk``: spans of months counted from year 0, so that a new month never moves an older one to
    another chunk, as it does in :func:`chunked`."""
    return df.withColumn("chunk", F.floor((F.year(month) * 12 + F.month(month) - 1) / F.lit(span)).cast("int"))


def site_block(block: int = BLOCK) -> Column:
    return F.floor(F.col("location_key") / F.lit(block)).cast("int")


def pack(df: DataFrame, by: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per ``by`` group with one array per column, all in the same order.

    ``order`` must be a total order within a group, or equal keys may swap between runs. ``by``
    sets how large a group can become: pass a chunk and a site block for facts.
    """
    ordered = F.array_sort(F.collect_list(F.struct(*order, *[F.col(c).alias(f"_v_{c}") for c in columns])))
    packed = df.groupBy(*by).agg(ordered.alias("_rows"))
    return packed.select(*by, *[F.col("_rows")[f"_v_{c}"].alias(c) for c in columns])


def unpack(packed: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """The rows :func:`pack` came from."""
    zipped = packed.select(*by, F.arrays_zip(*columns).alias("_rows"))
    return zipped.select(*by, F.inline("_rows"))


def to_document(packed: DataFrame, columns: list[str], name: str = "body") -> DataFrame:
    """Replace the arrays by one JSON text that keeps its nulls."""
    rest = [c for c in packed.columns if c not in columns]
    return packed.select(*rest, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(name))


def from_document(documents: DataFrame, schema: T.StructType, by: list[str], name: str = "body") -> DataFrame:
    """Read documents of the given array schema back into rows."""
    arrays = documents.select(*by, F.from_json(name, schema).alias("_d")).select(*by, "_d.*")
    return unpack(arrays, by, schema.fieldNames())


def row_numbers(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number distinct rows 0, 1, 2 ... in ``order`` without putting them in one task.

    The rows are range-partitioned and sorted, checkpointed so that both uses below see the same
    partitions, and each partition's start is the sum of the sizes before it. Only those sizes,
    one row per partition, meet in a window.
    """
    spark = checkpointing(df.sparkSession)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_id", F.monotonically_increasing_id()).checkpoint())
    # monotonically_increasing_id keeps the partition in the upper bits, the position in the lower 33
    split = placed.withColumn("_part", F.shiftright("_id", 33)) \
        .withColumn("_position", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_size")) \
        .select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return split.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_position")) \
        .drop("_id", "_part", "_position", "_start")


def dictionary(df: DataFrame, keys: list[str], labels: list[str], name: str = "i") -> DataFrame:
    """The distinct ``keys`` of a fact with their position and one label each (the smallest, so
    that the choice does not vary between runs)."""
    entries = df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in labels])
    return row_numbers(entries, keys, name)


def kept_dictionary(df: DataFrame, keys: list[str], labels: list[str], table: str, name: str = "i") -> DataFrame:
    """A dictionary that outlives its facts: entries of earlier builds keep their position and label, also when
    nothing uses them any more, and new ones follow behind. So documents written before stay readable. A
    missing key is an entry like any other. The table is replaced as a whole once the new one is complete."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        landing.replace_snapshot(dictionary(df, keys, labels, name), table)
        return spark.table(table)
    known = spark.table(table)
    same = reduce(Column.__and__, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys])
    new = df.alias("n").join(known.select(*keys).alias("o"), same, "left_anti")
    after = known.agg(F.max(name).alias("last")).first()["last"]
    added = row_numbers(new.groupBy(*keys).agg(*[F.min(c).alias(c) for c in labels]), keys, name)
    added = added.withColumn(name, F.col(name) + F.lit(0 if after is None else after + 1))
    if not added.isEmpty():
        landing.replace_snapshot(known.unionByName(added), table)
    return spark.table(table)


def encode(df: DataFrame, entries: DataFrame, keys: list[str], name: str = "i") -> DataFrame:
    """Replace ``keys`` by their dictionary position."""
    return df.join(entries.select(*keys, name), keys).drop(*keys)


def entry_text(columns: list[str]) -> Column:
    return F.concat_ws("|", *columns)


def week_picks(last_day: Column) -> Column:
    """Array of the Mondays to publish: last full week, the one before, and 52 weeks before it."""
    monday = F.date_sub(exprs.week_of(F.date_add(last_day, 1)), 7)
    return F.array(monday, F.date_sub(monday, 7), F.date_sub(monday, 7 * 52))


def last_full_weeks(weekly: DataFrame, dated: DataFrame) -> DataFrame:
    """Rows of the weekly mart for the weeks of :func:`week_picks`; a week is full once its Sunday
    has a service date in ``dated`` (visits or their lines). The picks are one scalar
    subquery, and choosing them is a plain filter that reaches the scans."""
    picks = dated.select(week_picks(F.max("service_date"))).scalar()
    return weekly.where(F.array_contains(picks, F.col("week")))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) of each table. A bare count of a parquet table is answered from its footers."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n")
                                          for t, df in tables.items()])


def source_group(name: str | Column = "table_name") -> Column:
    """Which group of the published source list a raw table counts under; null for the others.
    The underscore of the pattern is a plain character, not a wildcard."""
    name = F.col(name) if isinstance(name, str) else name
    return (F.when(name.like(r"pms\_%procedures"), "Practice management")
            .when(name == "sage_intacct__gl_detail", "Sage Intacct").when(name == "ukg__timecards", "UKG")
            .when(name == "inventory__usage", "Inventory")
            .when(name.isin("marketing__channel_performance", "windsor__facebook_ads"), "Marketing / websites"))


def source_counts(counts: DataFrame, group: Column) -> DataFrame:
    """Rows per group of tables; tables without a group are left out."""
    return counts.select(group.alias("source"), "n").where(F.col("source").isNotNull()) \
        .groupBy("source").agg(F.sum("n").alias("n"))


# The published datasets: sort order, columns published as zero when null, and for each
# published name its decimals (None: as it is) and, where it differs, the mart's column.
DATASETS = {
    "monthly": dict(order=["month", "location_key"], columns={
        "month": None, "location_key": None, "gross_production": 2, "net_production": 2, "collections": 2,
        "completed_visits": None, "no_shows": None, "scheduled": None, "new_patients": None,
        "labor_cost": 2, "labor_hours": 1, "overtime_hours": 1, "supply_cost": 2, "marketing_spend": 2,
        "total_opex": 2, "operating_profit": 2}),
    "channels": dict(order=["month", "location_key", "channel"], columns={
        "location_key": None, "month": None, "channel": None, "spend": 2, "leads": None, "booked": None}),
    "mix": dict(order=["month", "location_key", "cat"], columns={
        "location_key": None, "month": None, "cat": None, "prod": 0},
        named={"cat": "procedure_category", "prod": "gross_production"}),
    "recon": dict(order=["month", "location_key", "category"], zero=["ops_amount", "gl_amount"], columns={
        "location_key": None, "month": None, "category": None, "ops_source": None, "ops_amount": 2,
        "gl_amount": 2}),
    "weekly": dict(order=["week", "location_key"], zero=["collections", "labor_cost", "labor_hours",
                                                         "overtime_hours"], columns={
        "week": None, "location_key": None, "gross_production": 2, "net_production": 2, "collections": 2,
        "completed_visits": None, "no_shows": None, "scheduled": None, "new_patients": None,
        "labor_cost": 2, "labor_hours": 1, "overtime_hours": 1}),
}


def dataset(name: str, mart: DataFrame, first_test_key: int = TEST_SITE_KEY,
            places: dict[str, int] | None = None, block: int = BLOCK) -> DataFrame:
    """A mart as published arrays, one row per (chunk, block): test sites out, amounts rounded,
    months as text. ``places`` overrides the number of decimals per published column."""
    spec = DATASETS[name]
    scales, named = {**spec["columns"], **(places or {})}, spec.get("named", {})
    calendar = "week" if "week" in scales else "month"
    sites = without_test_sites(mart, first_test_key).na.fill(0, spec.get("zero", []))
    chunks = sites.withColumn("chunk", F.lit(0)) if calendar == "week" else chunked(sites)
    text = F.date_format("week", "yyyy-MM-dd") if calendar == "week" else exprs.month_text("month")

    def shaped(c: str, scale: int | None) -> Column:
        if c == calendar:
            return text.alias(c)
        value = F.col(named.get(c, c))
        return (value if scale is None else F.round(value, scale).cast(T.DecimalType(28, scale))).alias(c)

    facts = chunks.select("chunk", site_block(block).alias("block"), F.col(calendar).alias("_day"),
                          *[shaped(c, s) for c, s in scales.items()])
    order = ["_day" if c == calendar else c for c in spec["order"]]
    return pack(facts, ["chunk", "block"], order, list(scales))


def opex_documents(opex: DataFrame, first_test_key: int = TEST_SITE_KEY, places: int = 0,
                   block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Expense lines as (account dictionary, packed facts that carry the dictionary position and count
    their months from ``first_month``)."""
    base = without_test_sites(opex, first_test_key)
    entries = dictionary(base, ["account_no", "source"], ["account_title", "category"])
    first = base.select(exprs.month_text(F.min("month"))).scalar()
    coded = encode(chunked(base), entries, ["account_no", "source"]).select(
        "chunk", site_block(block).alias("block"), F.col("location_key").alias("k"),
        F.col("month_index").alias("m"), "i",
        F.round("amount", places).cast(T.DecimalType(28, places)).alias("amt"))
    packed = pack(coded, ["chunk", "block"], ["m", "k", "i"], ["k", "m", "i", "amt"])
    return entries, packed.withColumn("first_month", first)


def opex_rows(entries: DataFrame, packed: DataFrame) -> DataFrame:
    """Packed expense lines back as rows, with months as text and accounts by name."""
    lines = unpack(packed, ["first_month"], ["k", "m", "i", "amt"])
    return lines.join(entries, "i").select(
        F.col("k").alias("location_key"), exprs.shift_month_text("first_month", F.col("m")).alias("month"),
        "account_no", "account_title", "category", "source", F.col("amt").alias("amount"))


def write_changed(documents: DataFrame, path: str, by: list[str]) -> DataFrame:
    """Write only the documents that differ from those published before; returns the rewritten groups.

    ``by`` names the columns that make up a document's place, such as chunk and block; each place is a folder
    of JSON lines. The digest of every place lies beside the documents, in a folder that readers skip. It is
    written last, so after a failure the places in doubt are written again. Places that no document has any
    more are emptied.
    """
    spark = documents.sparkSession
    row = F.md5(F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"}))
    told = settled(documents.withColumn("_digest", row))
    now = told.groupBy(*by).agg(F.md5(F.array_join(F.array_sort(F.collect_list("_digest")), ",")).alias("digest"))
    files, beside = _place(spark, f"{path.rstrip('/')}/_digests")
    before = now.limit(0) if not files.exists(beside) else spark.read.schema(now.schema).parquet(beside.toString())
    places = reduce(Column.__and__, [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by])
    news = settled(now.alias("n").join(before.alias("o"), places & (F.col("n.digest") == F.col("o.digest")), "left_anti"))
    gone = before.alias("n").join(now.alias("o"), places, "left_anti").select(*by).collect()  # a row per place
    changed = told.alias("n").join(news.select(*by).alias("o"), places, "left_semi").drop("_digest")
    if not news.isEmpty():
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path, ignoreNullFields=False)
    for place in gone:
        files, at = _place(spark, "/".join([path.rstrip("/"), *[f"{c}={place[c]}" for c in by]]))
        files.delete(at, True)
    settled(now).write.mode("overwrite").parquet(beside.toString())
    return news.select(*by)


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_documents(documents: DataFrame, path: str) -> None:
    """JSON lines, one document each; replaced as a whole, complete once _SUCCESS appears."""
    documents.write.mode("overwrite").json(path, ignoreNullFields=False)
