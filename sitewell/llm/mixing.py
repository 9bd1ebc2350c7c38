"""Mixing sources to target weights with a low-discrepancy schedule.

Every source's documents, in a shuffled order, form a stream of words that is cut into blocks of equal
length and may be gone through twice. A source with a target of t words owns ceil(t / block) slots. Van der
Corput points, mapped through the cumulative slot counts, say which source each turn of the schedule draws
from, so that any stretch of the schedule holds the sources in their proportions. A slot's rank within its
source names the block it takes; the last slot of a source is cut so that exactly floor(target) words are
taken.

Ranks need no sort: the points that fall into a source's range are a range of integers whose bits are
reversed, and counting the earlier ones is a sum over the bits. Positions need no sort over a whole source:
sums per bucket of the shuffle hash come first, then running sums inside each bucket.

Defined results: a null text has size 0 and takes nothing; null sources are one source, the last; a null
doc_id hashes as an empty text. Repeated rows are rows of their own in `mix` and `taken`; `repeated` gives rows
of one id, source and text as many copies each as they are taken on average, rounded. Extra columns are ignored
by `mix` and passed through by `repeated`. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewell.llm.common import settled, text_of

WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
BLOCK = 1024
SEED = "mix"
ROWS_PER_BUCKET = 1024
CELL = 1024


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, the shuffle hash, and a digest of the text."""
    return docs.select("doc_id", "source", F.regexp_count(text_of(), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
                       F.xxhash64(text_of()).alias("digest"),
                       F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("h"))


def targets(rows: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per source: its number, weight, size and target. Sources fill in the order in which they reach
    their cap; the level at the first that doesn't is every uncapped source's words per unit of weight."""
    total = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    filling = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    return (
        rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name).cast("long"))
        .withColumn("weight", F.get(weights, ((F.col("sid") - 1) % len(WEIGHTS)).cast("int")))
        .withColumn("cap", PASSES * F.col("source_size"))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("level", (share * F.sum("source_size").over(total)
                              - F.coalesce(F.sum("cap").over(filling), F.lit(0)))
                    / (F.sum("weight").over(total) - F.coalesce(F.sum("weight").over(filling), F.lit(0))))
        .withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "sid", "level")))
                    .over(total)["level"])
        .withColumn("target", F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), F.col("cap").cast("double"))
                    .otherwise(F.col("level") * F.col("weight")))
        .select("sid", "source", "weight", "source_size", "target", F.floor("target").alias("words")))


def _rank(j: Column, low: Column, high: Column, bits: int) -> Column:
    """How many earlier turns fall into [low, high). A turn n is j with its bits reversed. The turns before n
    agree with it above one of its set bits and have a 0 there, which in j is a fixed end and a free start."""
    one = F.lit(1).cast("long")

    def counted(q: Column) -> Column:
        step = F.call_function("shiftleft", one, q + 1)
        end = j.bitwiseAND(F.call_function("shiftleft", one, q) - 1)
        below = lambda edge: F.greatest(F.lit(0).cast("long"), F.floor((edge - end + step - 1) / step))
        is_set = F.call_function("shiftright", j, q).bitwiseAND(one) == 1
        return F.when(is_set, below(high) - below(low)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("long"), lambda n, q: n + counted(q))


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """turn, sid, rank: which source each turn draws from, and which of its blocks."""
    ends = sources.select("sid", F.ceil(F.col("words") / block).alias("slots")).where("slots > 0").withColumn(
        "high", F.sum("slots").over(Window.orderBy("sid"))).withColumn("low", F.col("high") - F.col("slots"))
    last = ends.agg(F.max("high")).first()[0] or 0
    bits = max(1, int(last - 1).bit_length()) if last else 1
    cells = ends.select("sid", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL))).alias("cell")).repartition("sid", "cell")
    return cells.select("sid", "low", "high", F.explode(F.sequence(
        F.greatest("low", F.col("cell") * CELL), F.least(F.col("high"), (F.col("cell") + 1) * CELL) - 1)).alias("j")).select(
        F.conv(F.reverse(F.lpad(F.bin("j"), bits, "0")), 2, 10).cast("long").alias("turn"),
        "sid", _rank(F.col("j"), F.col("low"), F.col("high"), bits).alias("rank"))


def _placed(docs: DataFrame, share: float, block: int) -> DataFrame:
    """Each document's row, cut at block ends in both passes, beside the turn that takes the piece, if any."""
    rows = settled(sized(docs))
    sources = settled(targets(rows, share))
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    place = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32))
    rows = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        "r.doc_id", "r.source", "size", "h", "digest", "sid", "source_size", "target", "words", place.alias("bucket"))
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n")).select(
        "sid", "bucket", (F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size", "digest")
    stream = (
        rows.join(sums, ["sid", "bucket"])
        .withColumn("nth", F.row_number().over(inside))
        .withColumn("start", F.col("before") - F.col("size")
                    + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
        .withColumn("begin", F.col("start") + F.col("pass") * F.col("source_size"))
        .withColumn("rank", F.explode(F.sequence(
            F.floor(F.col("begin") / block),
            F.floor(F.greatest(F.col("begin"), F.col("begin") + F.col("size") - 1) / block))))
        .withColumn("low", F.greatest("begin", F.col("rank") * block))
        .withColumn("high", F.least(F.col("begin") + F.col("size"), (F.col("rank") + 1) * block, "words")))
    # the schedule grows with the data, but is made from few rows, by which its size would be misjudged
    return stream.join(schedule(sources, block).hint("merge"), ["sid", "rank"], "left").withColumn(
        "piece", F.when(F.col("turn").isNotNull(), F.greatest(F.lit(0).cast("long"), F.col("high") - F.col("low")))
        .otherwise(F.lit(0).cast("long")))


def mix(docs: DataFrame, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """The mixture: pieces of documents (first and last word, from 0) in the order of `turn`, `first_in_turn`."""
    return _placed(docs, share, block).where("piece > 0").select(
        "turn", (F.col("low") - F.col("rank") * block).alias("first_in_turn"), "source", "pass", "rank", "doc_id",
        (F.col("low") - F.col("begin")).alias("first_word"), (F.col("high") - F.col("begin") - 1).alias("last_word"))


def taken(docs: DataFrame, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """One row per row of docs: doc_id, size, source, source_size, target, words taken, in how many pieces, and
    the turns at which the first and the second pass through the source begin with it (null: not reached)."""
    begun = F.when(F.col("piece") > 0, F.col("turn"))
    return _placed(docs, share, block).groupBy(
        "sid", "bucket", "nth", "doc_id", "source", "size", "source_size", "target", "digest").agg(
        F.sum("piece").alias("taken"), F.count(begun).alias("pieces"),
        F.min(F.when(F.col("pass") == 0, begun)).alias("first_turn"),
        F.min(F.when(F.col("pass") == 1, begun)).alias("second_turn")).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "pieces", "first_turn", "second_turn", "digest")


def repeated(docs: DataFrame, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """docs with each row as often as the mix takes it (words taken over size, rounded), in the order of the turns
    that begin with the copies: partitions are ranges of turns, sorted inside."""
    times = taken(docs, share, block).where("taken > 0").groupBy("doc_id", "source", "digest").agg(
        F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("_times"),
        F.min("first_turn").alias("_first"), F.coalesce(F.min("second_turn"), F.min("first_turn")).alias("_second"))
    kept = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                       F.xxhash64(text_of()).alias("_digest"), F.monotonically_increasing_id().alias("_n")).where(text_of("_row.text") != "")
    copies = kept.join(times.where("_times > 0"), F.col("_id").eqNullSafe(F.col("doc_id"))
                       & F.col("_source").eqNullSafe(F.col("source")) & (F.col("_digest") == F.col("digest")))
    turn = F.when(F.col("_copy") == 1, F.col("_first")).otherwise(F.col("_second"))
    # repeated rows begin at one turn: the number of the row parts them
    return copies.select("_row", "_first", "_second", "_n", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")).select(
        "_row", turn.alias("_turn"), "_n").repartitionByRange("_turn", "_n").sortWithinPartitions("_turn", "_n").select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    return taken(docs).drop("source", "digest")
