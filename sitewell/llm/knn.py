"""Exact top-k by inner product: a Voronoi join of queries and data.

Both sides are assigned to the nearest of a bounded set of pivots. Per pivot a summary of its data (its
largest distance, the smallest of k + 1 different ids) bounds what the group can score for a query: with x in
the group of pivot p, q.x lies within |q| * |x - p| of q.p. A query's k-th best score is at least the k-th best
of these lower bounds over other ids than its own, so a data row is copied to a chunk of queries only if its
own upper bound reaches that for one of them. The rows a chunk needs are counted and dealt into as many cells as
they fill; each cell is solved by one matrix product, and a window keeps the best k of a query's cells.

Pivots are a sample of at most MAX_PIVOTS vectors, the only thing that is ever gathered whole; every row is
assigned, bounded and searched. Chunks and cells have bounded sizes, so a vector that makes up a third of
all rows spreads over many cells.

Defined results: components are floor(256 * x). Vectors that are null or hold a null or non-finite
component, and rows without an id, take no part. The shorter of two vectors counts as padded with zeros. A
row's own id is no candidate of it; equal scores rank by the smaller id; further rows with equal ids and vectors are candidates of other queries
as often as they occur, and one query. Scores beyond a long are held at its ends. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sitewell.llm.common import settled

MAX_PIVOTS = 1024
QUERIES_PER_CHUNK = 1024
ROWS_PER_CELL = 16384
SCALE = 256


def quantized(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v: the rows that take part, components as whole numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: by floating point where that is exact, by unbounded integers where a long
    would overflow."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = max(1, int(a.max()), -int(a.min())) * max(1, int(b.max()), -int(b.min())) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _pivots(data: DataFrame, rows: int, width: int) -> np.ndarray:
    """About sqrt(rows) / 2 different vectors, at most MAX_PIVOTS, by the smallest hashes of their ids."""
    n = int(min(MAX_PIVOTS, max(4, rows ** 0.5 / 2)))
    sample = data.orderBy(F.xxhash64("id"), "id").limit(2 * n).collect()
    return np.unique(_matrix([r["v"] for r in sample], width), axis=0)[:n].astype(np.float64)


def _assigned(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """With the nearest pivot and the distance to it."""
    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squares = (pivots ** 2).sum(1)
        for batch in batches:
            x = _matrix(batch["v"], width).astype(np.float64)
            group = (squares - 2 * (x @ pivots.T)).argmin(1) if len(x) else np.zeros(0, dtype=np.int64)
            batch["grp"] = group.astype(np.int32)
            batch["dist"] = np.sqrt(((x - pivots[group]) ** 2).sum(1))
            yield batch

    return rows.mapInPandas(nearest, "id long, v array<bigint>, grp int, dist double")


def _chunks(counts: dict[int, int], pivots: np.ndarray) -> dict[int, tuple[int, int]]:
    """By pivot: its first chunk of queries and how many it fills. Small groups share a chunk, neighbours first."""
    order = sorted(counts, key=lambda g: tuple(pivots[g][:1]) + (g,))
    out, chunk, filled = {}, 0, 0
    for g in order:
        parts = -(-counts[g] // QUERIES_PER_CHUNK)
        if filled and (parts > 1 or filled + counts[g] > QUERIES_PER_CHUNK):
            chunk, filled = chunk + 1, 0
        out[g] = (chunk, parts)
        chunk, filled = (chunk + parts, 0) if parts > 1 else (chunk, filled + counts[g])
    return out


def _wanted(queries: DataFrame, pivots: np.ndarray, summary: list, k: int, width: int) -> DataFrame:
    """chunk, grp, least: rows of the group at least that far from its pivot can be among some query's best."""
    groups = np.array([s["grp"] for s in summary])
    far = np.array([s["far"] for s in summary])
    near = np.full((len(summary), k + 1), np.inf)
    for i, s in enumerate(summary):
        near[i, :len(s["near"])] = [x["dist"] for x in s["near"]]
    # the ids of the flattened `near`, in order, and the place of each
    named = sorted((x["id"], i * (k + 1) + n) for i, s in enumerate(summary) for n, x in enumerate(s["near"]))
    ids, places = (np.array([x[c] for x in named], dtype=np.int64) for c in (0, 1))

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = _matrix(batch["v"], width).astype(np.float64)
            norm = np.sqrt((q ** 2).sum(1))[:, None]
            dots = q @ pivots[groups].T
            with np.errstate(invalid="ignore"):
                low = np.where(np.isinf(near)[None], -np.inf, dots[:, :, None] - norm[:, :, None] * near[None])
            low = low.reshape(len(q), -1)
            # a query's own rows, one in each of any number of groups, are no candidates
            own = batch["id"].to_numpy(np.int64)
            first, last = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
            for i in np.flatnonzero(last > first):
                low[i, places[first[i]:last[i]]] = -np.inf
            bar = np.partition(low, -k, axis=1)[:, -k][:, None] if len(low) else np.zeros((0, 1))
            bar = bar - 0.5 - 1e-9 * np.abs(np.where(np.isinf(bar), 0, bar))
            need = dots + norm * far[None] >= bar
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(norm > 0, (bar - dots) / norm, -np.inf)
            i, j = np.nonzero(need)
            if len(i):
                yield pd.DataFrame({"chunk": batch["chunk"].to_numpy()[i], "grp": groups[j].astype(np.int32),
                                    "least": least[i, j] * (1 - 1e-9) - 1e-6}).groupby(["chunk", "grp"], as_index=False).min()

    found = queries.select("chunk", "id", "v").mapInPandas(wanted, "chunk long, grp int, least double")
    return found.groupBy("chunk", "grp").agg(F.min("least").alias("least"))


def _copied(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, cell, id, v) of the rows each chunk of queries needs, and (chunk, cells): into how many cells it
    deals them. Rows are dealt by their number, so those of one frequent id spread like any others."""
    needed = F.col("dist") >= F.col("least")
    cells = settled(rows.select("grp", "dist").join(wanted, "grp").where(needed).groupBy("chunk").agg(
        F.ceil(F.count("*") / ROWS_PER_CELL).cast("int").alias("cells")))
    copied = rows.join(wanted.join(cells, "chunk"), "grp").where(needed)
    return copied.select("chunk", F.pmod(F.xxhash64("nth"), "cells").cast("int").alias("cell"), "id", "v"), cells


def _solver(k: int, width: int):
    def solve(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(rows):
            ids = rows["id"].to_numpy()
            scores = products(_matrix(asked["v"], width), _matrix(rows["v"], width))
            for i, (key, q) in enumerate(zip(asked["key"], asked["id"])):
                others = np.flatnonzero(ids != q)
                mine = scores[i, others]
                if len(mine) > k:
                    best = np.flatnonzero(mine >= np.partition(mine, len(mine) - k)[len(mine) - k])
                    others, mine = others[best], mine[best]
                order = np.lexsort((ids[others], -mine.astype(object) if (mine == -(1 << 63)).any() else -mine))[:k]
                found.append(pd.DataFrame({"key": key, "query_id": q, "vec_id": ids[others][order], "score": mine[order]}))
        return pd.concat(found) if found else pd.DataFrame({"key": [], "query_id": [], "vec_id": [], "score": []}, dtype="int64")

    return solve


def top_k(data: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score. Both sides have id and v, as `quantized` makes them."""
    empty = data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = data.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    asked_size = queries.agg(F.max(F.size("v")).alias("w")).first()["w"]
    if not size["n"] or asked_size is None:
        return empty
    width = max(1, size["w"], asked_size)
    pivots = _pivots(data, size["n"], width)
    rows = settled(_assigned(data, pivots, width).withColumn("nth", F.monotonically_increasing_id()))
    # smallest distances of k + 1 different ids per group: first of each share of the group, then of the shares' results
    shares = F.pmod(F.xxhash64("id"), F.lit(max(1, size["n"] // ROWS_PER_CELL + 1)))
    nth = lambda *of: F.row_number().over(Window.partitionBy(*of).orderBy("dist", "id"))
    near = rows.groupBy("grp", "id").agg(F.min("dist").alias("dist")).withColumn("share", shares).withColumn(
        "nth", nth("grp", "share")).where(F.col("nth") <= k + 1).withColumn("nth", nth("grp")).where(
        F.col("nth") <= k + 1).groupBy("grp").agg(F.collect_list(F.struct("dist", "id")).alias("near"))
    summary = rows.groupBy("grp").agg(F.max("dist").alias("far")).join(near, "grp").collect()

    asked = _assigned(queries.distinct(), pivots, width)
    chunks = _chunks({r["grp"]: r["count"] for r in asked.groupBy("grp").count().collect()}, pivots)
    first, parts = (F.create_map(*[F.lit(x) for g, c in chunks.items() for x in (g, c[i])]) for i in (0, 1))
    key = F.xxhash64("id", "v")
    asked = settled(asked.select("id", "v", key.alias("key"), (
        first[F.col("grp")] + F.pmod(key, parts[F.col("grp")])).cast("long").alias("chunk")))

    copied, cells = _copied(rows, settled(_wanted(asked, pivots, summary, k, width)))
    spread = asked.join(cells, "chunk").select(
        "key", "id", "v", "chunk", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
    solved = spread.groupBy("chunk", "cell").cogroup(copied.groupBy("chunk", "cell")).applyInPandas(
        _solver(k, width), "key long, query_id long, vec_id long, score long")
    best = Window.partitionBy("key", "query_id").orderBy(F.desc("score"), "vec_id")
    return solved.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(embeddings: DataFrame) -> DataFrame:
    rows = quantized(embeddings, "vec_id", "embedding")
    return top_k(rows, rows.where(F.col("id") % 50 == 0))
