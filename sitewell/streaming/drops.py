"""Drop folders as a stream: each new file lands once, however often the job is restarted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitewell.functions.names import normalize_columns
from sitewell.session import checkpointing
from sitewell.sources import landing, versions

LISTING = "path string, modificationTime timestamp, length bigint, content binary"
BUCKETS = 64


def watch(spark: SparkSession, folder: str, pattern: str = "*.csv", files_per_batch: int = 1000) -> DataFrame:
    """Stream of a drop folder's new files, by path. Contents are not read."""
    return (spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", pattern)
            .option("maxFilesPerTrigger", files_per_batch).load(folder).select("path", "modificationTime"))


def read_files(spark: SparkSession, paths: list[str], columns: list[str], quoted_newlines: bool = True,
               splits: bool = False) -> DataFrame:
    """The rows of these files, all text under normalized names, with the file they came from. Columns are
    taken by name: others are ignored, their order does not matter, and an absent one fails. Files with
    one header are read by one scan."""
    parts = [landing.required(df, [*columns, "_file"], some[0])
             for some, df in landing.read_alike(spark, paths, quoted_newlines, splits, "_file").values()]
    names = normalize_columns(parts[0].drop("_file")).columns
    return reduce(DataFrame.unionByName, parts).toDF(*names, "_file")


def land(files: DataFrame, columns: list[str], path: str, checkpoint: str, quoted_newlines: bool = True,
         splits: bool = False) -> StreamingQuery:
    """Append the rows of what has arrived to a raw table and stop. The batch number is a partition that a
    repeated batch overwrites, so a restart after a failure adds nothing twice. With ``splits`` large
    files are read in pieces, see landing.read_text."""
    def write(batch: DataFrame, number: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # as many as a batch has files
        if paths:
            read_files(batch.sparkSession, paths, columns, quoted_newlines, splits).withColumn("_batch", F.lit(number)) \
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)

    return (files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# --- merging ----------------------------------------------------------------------------------------

def digests(rows: DataFrame) -> DataFrame:
    """(_file, digest): the same for two files with the same rows, in any order."""
    row = F.xxhash64(*[F.col(c) for c in rows.columns if c != "_file"], *[F.col(c).isNull() for c in rows.columns if c != "_file"])
    return rows.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"),
                                     F.sum(row.cast("decimal(38,0)")).alias("s")).select(
        "_file", F.concat_ws(":", "n", "x", "s").alias("digest"))


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: that of the file delivered last; of one file's rows for a key, the greatest."""
    values = [c for c in rows.columns if c not in keys]
    order = F.struct("_at", "_file", *[c for c in values if c not in ("_at", "_file")])
    best = rows.groupBy(*keys).agg(F.max(order).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def merge_files(spark: SparkSession, delivered: DataFrame, columns: list[str], keys: list[str], table: str,
                quoted_newlines: bool = True, splits: bool = False) -> int:
    """Merge delivered files (path, modificationTime) into a table that holds one row per key; how many files
    were new. The latest file wins, whenever it is merged. A file whose rows were delivered before, under
    any name, changes nothing: it must not bring back what later files replaced.

    The table lies in BUCKETS folders by a hash of the key, kept in versions: a merge rewrites the buckets
    its keys fall in and leaves the others. Digests are written after the rows, and merging rows again gives
    the same rows, so a merge that fails anywhere is simply repeated.
    """
    checkpointing(spark)
    listed = {landing.same_path(r["path"]): r["modificationTime"] for r in delivered.collect()}  # a batch's files
    if not listed:
        return 0
    rows = read_files(spark, sorted(listed), columns, quoted_newlines, splits).checkpoint()
    times = spark.createDataFrame([(p, at) for p, at in listed.items()], "_path string, _at timestamp")
    path = F.replace(F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B"))), F.lit(":///"), F.lit(":/"))
    marked = digests(rows).withColumn("_path", path).join(times, "_path")
    known, log = f"{table}_files", versions.load(spark, f"{table}_files")
    if log is not None:
        marked = marked.join(versions.read(spark, known).select("digest"), "digest", "left_anti")
    # of files with the same rows the first one delivered counts
    new = marked.groupBy("digest").agg(F.min(F.struct("_at", "_file", "_path")).alias("_f")).select("digest", "_f.*").checkpoint()
    count = new.count()
    if not count:
        return 0
    arrived = latest(rows.join(new.select("_file", "_at"), "_file"), keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    merged, touched = arrived, None
    if versions.load(spark, table) is not None:
        arrived = arrived.checkpoint()
        touched = {r["b"] for r in arrived.select(bucket.alias("b")).distinct().collect()}  # BUCKETS at most
        merged = latest(versions.read(spark, table, touched).unionByName(arrived), keys)
    versions.write(merged, table, bucket, lambda b: touched is None or b in touched)
    at = F.lit(0 if log is None else log.number)  # a folder of its own for each merge
    versions.write(new.select("digest", "_path", "_at"), known, at, lambda n: log is None or n == log.number)
    return count


def merge(files: DataFrame, columns: list[str], keys: list[str], table: str, checkpoint: str,
          quoted_newlines: bool = True, splits: bool = False) -> StreamingQuery:
    """Merge what has arrived into a table with one row per key, and stop; see :func:`merge_files`."""
    def write(batch: DataFrame, _: int) -> None:
        merge_files(batch.sparkSession, batch, columns, keys, table, quoted_newlines, splits)

    return (files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
