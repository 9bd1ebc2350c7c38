"""Joins to the mapping tables: site crosswalk, code maps, provider lookup.

No join here carries a broadcast hint. Mapping tables are normally small and Spark, which
measures them, broadcasts them; one that has outgrown the threshold is shuffled instead, with
skewed keys split by the adaptive planner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CROSSWALK_KEY = ("source_system", "source_location")


def to_location(df: DataFrame, crosswalk: DataFrame, system: str | None = None,
                site: str = "source_location", unknown: bool = False) -> DataFrame:
    """Inner join to location_key. Rows of a site the crosswalk does not know leave; see
    :func:`unmapped_sites`. With ``system`` the frame holds that one system only. With ``unknown`` such
    rows stay, and ``unmapped_site`` names their system and site; it is null for the others."""
    x = crosswalk.select(F.col("source_system").alias("_system"), F.col("source_location").alias("_site"),
                         "location_key")
    if system is None:
        on = (F.col("source_system") == F.col("_system")) & (F.col(site) == F.col("_site"))
    else:
        x, on = x.where(F.col("_system") == system), F.col(site) == F.col("_site")
    if not unknown:
        return df.join(x, on, "inner").drop("_system", "_site")
    named = F.concat(F.col("source_system") if system is None else F.lit(system), F.lit(" / "), F.col(site))
    marked = df.join(x.withColumn("_known", F.lit(True)), on, "left")
    return marked.withColumn("unmapped_site", F.when(F.col("_known").isNull(), F.struct(named.alias("value")))) \
        .drop("_system", "_site", "_known")


def unmapped_sites(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """(source_system, source_location, row_count) for sites missing from the crosswalk.

    Rows are counted per site first, with map-side combine, so the anti join sees one row per
    site however many rows a site has.
    """
    per_site = df.groupBy(*CROSSWALK_KEY).agg(F.count(F.lit(1)).alias("row_count"))
    known = crosswalk.select(*CROSSWALK_KEY)
    return per_site.join(known, list(CROSSWALK_KEY), "left_anti")


def rejected_rows(df: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The rows :func:`to_location` drops, whole, for a reject table."""
    return df.join(crosswalk.select(*CROSSWALK_KEY), list(CROSSWALK_KEY), "left_anti")


def map_code(df: DataFrame, code_map: DataFrame, on: dict[str, str], take: list[str],
             defaults: dict[str, str] | None = None) -> DataFrame:
    """Left join ``df`` to a code map on one or more columns ({df column: map column}).

    ``take`` lists the map columns to add; ``defaults`` gives the text that stands in for a
    missing value in some of them.
    """
    defaults = defaults or {}
    keys = {f"_k{i}": (mine, theirs) for i, (mine, theirs) in enumerate(on.items())}
    m = code_map.select(*[F.col(theirs).alias(k) for k, (_, theirs) in keys.items()],
                        *[F.col(c).alias(f"_m_{c}") for c in take])
    cond: Column | None = None
    for k, (mine, _) in keys.items():
        part = F.col(mine) == F.col(k)
        cond = part if cond is None else cond & part
    joined = df.join(m, cond, "left").drop(*keys)
    added = [F.coalesce(F.col(f"_m_{c}"), F.lit(defaults[c])).alias(c) if c in defaults
             else F.col(f"_m_{c}").alias(c) for c in take]
    return joined.select(*df.columns, *added)
