"""What the ten operators share: reading a table, words of a text, checkpoints, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these six characters.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session, else the context's own."""
    from sitewell.session import checkpointing

    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or checkpointing(spark).sparkContext._jsc.sc().getCheckpointDir().get()


def settled(df: DataFrame) -> DataFrame:
    """Rows written once to the shared checkpoint folder, so that later reads neither recompute nor vary."""
    from sitewell.session import checkpointing

    checkpointing(df.sparkSession)
    return df.checkpoint(eager=True)


def constants(values: list[float]) -> Column:
    """An array of numbers as one foldable expression: computed once when the plan is made, not for each row."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def once(value: Column) -> Column:
    """The value from a generator, for select(): a filter that is moved below it does not compute it again."""
    return F.explode(F.array(value))
