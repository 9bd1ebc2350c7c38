"""Whitening of embeddings by singular values of the centred rows.

The covariance is never formed. Each task reduces its centred rows block by block to one triangle R by QR, and
triangles are put together in groups until a few are left, so R'R is n times the covariance whatever the
number of rows. R is as wide as a vector is long; Householder reflections make it bidiagonal, dqds gives the
bidiagonal's singular values to full relative accuracy (shifts only ever subtract what stays positive), and
for each wanted value a twisted factorisation of B'B - value*I gives its vector: the elimination from the top
and the one from the bottom meet where their common pivot is least. The reflections take it back.

Values that are nearly equal have no directions of their own; their vectors are made orthogonal to those
before them, which spans the same space.

Defined results: components are floor(256 * c). Vectors that are null or hold a null or non-finite entry take
no part; rows without an id do. The shorter of two vectors counts as padded with zeros. Every different vector
is fitted once, repeated rows are projected each. Directions without variance are no components, so fewer
than two different vectors, or an empty table, give no rows. A direction's largest entry is positive.
Deviations beyond a long are held at its end.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewell.llm.common import settled

SCALE = 256
FAN = 16  # partial results put together at a time
EPS = float(np.finfo(float).eps)
MOST = (1 << 63) - 1


# --- bidiagonal form, its values and vectors ---------------------------------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, upper diagonal, and the reflections that mixed the columns (first column, unit vector)."""
    a, right = np.array(r, dtype=float), []
    n = a.shape[1]

    def reflection(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if not size or not np.any(x[1:]):
            return None
        u = x / size
        u[0] += 1.0 if u[0] >= 0 else -1.0
        return u / np.linalg.norm(u)

    for k in range(n):
        if (u := reflection(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k + 2 < n and (u := reflection(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
            right.append((k + 1, u))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential quotient-difference step; None if the shift is more than the least value."""
    d, least = q[0] - shift, q[0] - shift
    new_q, new_e = [], []
    for i, above in enumerate(e):
        if d < 0:
            return None
        pivot = d + above
        if pivot <= 0:
            return None
        ratio = q[i + 1] / pivot
        new_q.append(pivot)
        new_e.append(above * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if not d >= 0:
        return None
    return [*new_q, d], new_e, least


def squared_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of a bidiagonal's singular values by dqds, falling."""
    q, e = (np.asarray(diagonal, float) ** 2).tolist(), (np.asarray(upper, float) ** 2).tolist()
    scale = max([*q, *e], default=0.0)
    if not scale:
        return np.zeros(len(q))
    todo, found = [([x / scale for x in q], [x / scale for x in e], 0.0)], []
    while todo:
        q, e, base = todo.pop()
        least, rounds = None, 0
        while len(q) > 1:
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= EPS * EPS * (base + min(q[i], q[i + 1])) or e[i] < 1e-290), None)
            if cut is not None:  # what couples the two parts is below rounding
                todo.append((q[:cut + 1], e[:cut], base))
                q, e, least = q[cut + 1:], e[cut + 1:], None
                continue
            if q[0] < q[-1]:  # the same values from the other end, where the least one shows sooner
                q, e, least = q[::-1], e[::-1], None
            # the lower value of the last two rows, which is no less than the least of all
            top, off, bottom = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
            half = (top - bottom) / 2
            guess = bottom + half - (half * half + off) ** 0.5 if half < 0 else bottom - off / (half + (half * half + off) ** 0.5)
            bound = guess if least is None else min(guess, least)
            for shift in (bound * (1 - 8 * EPS), bound * 0.9, bound * 0.3, 0.0):
                done = _sweep(q, e, shift) if shift > 0 or shift == 0.0 else None
                if done:
                    break
            if done is None:  # a value of zero: its pivot vanished
                q = [max(x, 1e-280) for x in q]
                continue
            q, e, least = done
            base += shift
            rounds += 1
            if rounds > 200 * (len(q) + 10):
                raise ArithmeticError("singular values do not converge")
        found.append(base + q[0])
    return np.sort(np.array(found))[::-1] * scale


def vector(diagonal: np.ndarray, upper: np.ndarray, value: float, before: list[np.ndarray]) -> np.ndarray:
    """Unit vector of B'B for one of its values, by a twisted factorisation of B'B - value * I."""
    diagonal, upper = np.asarray(diagonal, float), np.asarray(upper, float)
    n = len(diagonal)
    main = diagonal ** 2
    main[1:] += upper ** 2
    side = diagonal[:-1] * upper
    tiny = EPS * max(float(main.max()), 1e-300) * EPS
    safe = lambda x: x if abs(x) > tiny else tiny
    down, up = np.empty(n), np.empty(n)
    down[0], up[-1] = safe(main[0] - value), safe(main[-1] - value)
    for i in range(1, n):
        down[i] = safe(main[i] - value - side[i - 1] ** 2 / down[i - 1])
    for i in range(n - 2, -1, -1):
        up[i] = safe(main[i] - value - side[i] ** 2 / up[i + 1])
    for twist in np.argsort(np.abs(down + up - (main - value)), kind="stable"):
        z = np.zeros(n)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -side[i] / down[i] * z[i + 1]
        for i in range(twist, n - 1):
            z[i + 1] = -side[i] / up[i + 1] * z[i]
        z /= np.linalg.norm(z)
        rest = z.copy()
        for _ in range(2):
            for other in before:
                rest -= (other @ rest) * other
        size = np.linalg.norm(rest)
        if size > 0.1:  # else the vector of a nearly equal value again
            return rest / size
    raise ArithmeticError("no further direction")


# --- the fit -----------------------------------------------------------------------------------------

@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the covariance, falling
    directions: np.ndarray  # one column each
    total: float  # trace of the covariance

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.values)


def matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _gaps(x: np.ndarray, n: int, sums: list[int], power: int = 1) -> np.ndarray:
    """n * x - sums; as unbounded integers where sums of that power could pass a long."""
    most = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0)
    if most ** power * max(1, x.shape[1]) <= MOST:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows less their mean, from exact differences."""
    return _gaps(x, n, sums).astype(float) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    return [min(int(d), MOST) for d in (_gaps(x, n, sums, 2) ** 2).sum(axis=1)] if x.size else [0] * len(x)


def combined(vectors: DataFrame, partial: Callable[[Iterator[pd.DataFrame]], bytes | None],
             merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One result of all rows: a small one from each partition, put together in groups of FAN."""
    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = partial(batches)
        if part is not None:
            yield pd.DataFrame({"part": [part]})

    parts = settled(vectors.mapInPandas(first, "part binary").withColumn("n", F.spark_partition_id().cast("long")))
    while parts.count() > FAN:
        parts = settled(parts.groupBy(F.floor(F.col("n") / FAN).alias("n")).applyInPandas(
            lambda g: pd.DataFrame({"part": [merge(list(g.sort_values("n")["part"]))], "n": [g["n"].iloc[0] // FAN]}),
            "part binary, n long"))
    left = [bytes(r["part"]) for r in parts.orderBy("n").collect()]  # FAN at most
    return merge(left) if left else None


def totals(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension."""
    def partial(batches: Iterator[pd.DataFrame]) -> bytes | None:
        n, sums = 0, [0] * width
        for batch in batches:
            x = matrix(batch["v"], width)
            most = max(int(x.max(initial=0)), -int(x.min(initial=0))) * len(x)
            part = (x if most <= MOST else x.astype(object)).sum(axis=0)
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, part)]
        return json.dumps([n, sums]).encode() if n else None

    def merge(parts: list[bytes]) -> bytes:
        loaded = [json.loads(p) for p in parts]
        return json.dumps([sum(n for n, _ in loaded), [sum(c) for c in zip(*(s for _, s in loaded))]]).encode()

    found = combined(vectors, partial, merge)
    return (0, [0] * width) if found is None else tuple(json.loads(found))


def triangle(rows: np.ndarray, width: int) -> np.ndarray:
    """R of the rows' QR, filled up with zero rows to a square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def reduced(vectors: DataFrame, n: int, sums: list[int], width: int) -> np.ndarray:
    """The triangle R of all centred rows."""
    def partial(batches: Iterator[pd.DataFrame]) -> bytes | None:
        r = None
        for batch in batches:
            for at in range(0, len(batch), max(1024, 4 * width)):
                x = centred(matrix(batch["v"].iloc[at:at + max(1024, 4 * width)], width), n, sums)
                r = triangle(x if r is None else np.vstack([r, x]), width)
        return None if r is None else r.tobytes()

    def merge(parts: list[bytes]) -> bytes:
        return triangle(np.vstack([np.frombuffer(p).reshape(width, width) for p in parts]), width).tobytes()

    return np.frombuffer(combined(vectors, partial, merge)).reshape(width, width)


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of R, at most so many, and their right directions."""
    diagonal, upper, right = bidiagonal(r)
    values = squared_values(diagonal, upper)
    noise = (64 * EPS * len(values)) ** 2 * values[0]
    kept = [v for v in values[:most] if v > noise]
    found: list[np.ndarray] = []
    for value in kept:
        found.append(vector(diagonal, upper, value, found))
    out = np.array(found).T.reshape(len(values), len(kept)).copy()
    for first, u in reversed(right):
        out[first:] -= 2 * np.outer(u, u @ out[first:])
    out *= np.sign(out[np.abs(out).argmax(axis=0), range(len(kept))])
    return np.array(kept), out


def fit(vectors: DataFrame, width: int, components: int) -> Whitening | None:
    """Of different vectors `v`; None where they do not vary."""
    n, sums = totals(vectors, width)
    if n < 2:
        return None
    r = reduced(vectors, n, sums, width)
    values, found = directions(r, components)
    return Whitening(n, sums, values / n, found, float((r ** 2).sum()) / n) if len(values) else None


def identity_error(vectors: DataFrame, model: Whitening, width: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity. Means and products about
    them are put together pairwise, so products are centred before they are summed."""
    k = len(model.values)

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rows: count and mean; below, sums of centred products."""
        n, gap = a[0, 0] + b[0, 0], b[0, 1:] - a[0, 1:]
        out = a + b
        out[0, 1:] = a[0, 1:] + gap * (b[0, 0] / n)
        out[1:, 1:] += np.outer(gap, gap) * (a[0, 0] * b[0, 0] / n)
        return out

    def partial(batches: Iterator[pd.DataFrame]) -> bytes | None:
        found = None
        for batch in batches:
            if not len(batch):
                continue
            w = model.project(matrix(batch["v"], width))
            mean = w.mean(axis=0)
            part = np.zeros((k + 1, k + 1))
            part[0, 0], part[0, 1:], part[1:, 1:] = len(w), mean, (w - mean).T @ (w - mean)
            found = part if found is None else joined(found, part)
        return None if found is None else found.tobytes()

    def merge(parts: list[bytes]) -> bytes:
        out, *rest = (np.frombuffer(p).reshape(k + 1, k + 1) for p in parts)
        for part in rest:
            out = joined(out, part)
        return out.tobytes()

    found = np.frombuffer(combined(vectors, partial, merge)).reshape(k + 1, k + 1)
    return float(np.abs(found[1:, 1:] / found[0, 0] - np.eye(k)).max())


# --- tables ------------------------------------------------------------------------------------------

def quantized(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key, v: the rows that take part, entries as whole numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(key).alias("key"), F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("v"))


def whitened(rows: DataFrame, model: Whitening, width: int) -> DataFrame:
    """rows (key, v) as key, deviation, whitened: an array of one number per component."""
    @F.pandas_udf("deviation long, whitened array<double>")
    def apply(vectors: pd.Series) -> pd.DataFrame:
        x = matrix(vectors, width)
        return pd.DataFrame({"deviation": deviations(x, model.n, model.sums), "whitened": list(model.project(x))})

    return rows.select("key", apply("v").alias("w")).select("key", "w.deviation", "w.whitened")


def query(embeddings: DataFrame, components: int = 4) -> DataFrame:
    rows = quantized(embeddings, "vec_id", "embedding")
    empty = embeddings.sparkSession.createDataFrame([], (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"))
    width = rows.agg(F.max(F.size("v")).alias("width")).first()["width"]
    if not width:
        return empty
    filled = F.when(F.size("v") < width, F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))).otherwise(F.col("v"))
    vectors = settled(rows.select(filled.alias("v")).distinct())
    model = fit(vectors, width, components)
    if model is None:
        return empty
    error = identity_error(vectors, model, width)
    shares = F.array(*[F.lit(float(e / model.total)) for e in model.values])
    return whitened(rows, model, width).select("key", "deviation", F.posexplode("whitened").alias("c", "whitened")).select(
        F.col("key").alias("vec_id"), (F.col("c") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("c")).alias("explained"), F.lit(error).alias("identity_error"))
