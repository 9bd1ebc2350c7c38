"""Quality rules: a threshold table compiled into one projection of built-in functions.

Defined results: a null or empty text has no words and fails the length rule. Repeated rows are judged
each on its own. Extra columns pass through `keep` untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewell.llm.common import once, text_of, words_of

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by this are from at or an not you his her have "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de des du et en un une que qui dans pour par sur au est pas il elle ou avec son "
    "el los las y del que en un una por con para su se no es al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """A ratio of two measures that must lie between low and high. A ratio over nothing is 0."""

    name: str
    part: str
    whole: str
    low: float = 0.0
    high: float = float("inf")


# The thresholds of production runs.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", low=3.0, high=12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=0.02),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=0.5),
)
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Equal windows are neighbours once sorted, so
    each text costs one sort of its own windows; the positions found are sorted again, and each adds the
    words that the next window does not cover."""
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("w"), i.alias("i")))

    def positions(found: Column) -> Column:
        return F.sort_array(F.transform(
            F.filter(found, lambda x, k: (x["w"] == F.get(found, k - 1)["w"]) | (x["w"] == F.get(found, k + 1)["w"])),
            lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"), lambda total, n: total + n)

    # a one-element array binds a value once, where a plain expression would be computed at each use
    bind = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(
        bind(F.sort_array(windows), lambda s: bind(positions(s), covered)))


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the struct column `_m`: the counts that rules are made of."""
    words, lines = F.col("_w"), F.col("_l")
    stop = F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))
    return (
        df.withColumn("_t", text_of(text))
        .select("*", once(words_of(F.col("_t"))).alias("_w"))
        .select("*", once(F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).alias("_l"))
        .select("*", once(F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated(words).alias("n_repeat_words"),
            stop.cast("long").alias("n_stop_words"))).alias("_m"))
        .drop("_t", "_w", "_l"))


def verdict(rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column, Column]:
    """The table compiled: (base_failed, names of broken rules, kept) over the struct `_m`."""
    m = F.col("_m")
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])

    def broken(rule: Rule) -> Column:
        ratio = F.when(m[rule.whole] > 0, m[rule.part] / m[rule.whole]).otherwise(F.lit(0.0))
        return (ratio < rule.low) | (ratio > rule.high)

    names = F.filter(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return base, names, ~base & (F.size(names) == 0)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of docs: `row` (all its columns), the measures, base_failed, broken rules, kept."""
    base, names, kept = verdict(rules)
    return measures(docs.select(F.struct("*").alias("row"), F.col("text").alias("_text")), "_text").select(
        "row", "_m.*", base.alias("base_failed"), names.alias("broken"), kept.alias("kept"))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that pass, unchanged."""
    return judged(docs, rules).where("kept").select("row.*")


def query(docs: DataFrame) -> DataFrame:
    return judged(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept")
