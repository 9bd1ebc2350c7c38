"""Near-duplicate classes by consistent weighted sampling.

A text is the multiset of its runs of five words, weighted by their count times an inverse document
frequency: the mean over the five words, whose frequencies over all documents are counted in a fixed number
of hash buckets (so the table has one size whatever the corpus), damped by a square root so that a shared
run does not lose its weight just because it is in many copies. Improved consistent weighted sampling draws
SAMPLES samples per text; two texts agree in one with the probability of their weighted Jaccard similarity.
Texts that agree in all samples of a band meet in a bucket, where the similarity is computed from the texts
themselves and must reach THRESHOLD. Classes are the connected components of these links.

Equal texts are one vertex. A bucket is cut into chunks of bounded size, its first text (the pivot) a guest
in each; a chunk links its own texts, and all pivots' links tie the chunks together. Only where a bucket
of several chunks still holds texts of different classes do those that the triangle inequality does not
part meet across chunks. So a bucket of copies costs its size, and no pair of candidates is left out.

Defined results: a null text is an empty one; texts of fewer than five words are one run of all their words,
and texts without words are similar to equal texts only. Rows without an id get the class of their text, its
least id, or null. Repeated rows share their class. Extra columns are ignored by `classes` and passed
through by `keep_one`. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewell.llm.bpe import groups
from sitewell.llm.common import settled, text_of

RUN = 5
THRESHOLD = 0.8
BANDS, ROWS = 15, 4
SAMPLES = BANDS * ROWS
WORD_BUCKETS = 1 << 16
DRAWS = 1 << 14
CHUNK = 256
GROUP_CHARS = 200_000
PIECE = 1 << 18  # bytes hashed at once
BASE = 0xD6E8FEB86659FD93
_M = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHashes:
    """64-bit hashes of the words of many texts at once. A word's hash is a polynomial over its bytes, cut out
    of the running sum over the whole piece: bytes times powers of an odd base, moved to the word's start by the
    base's inverse. Words longer than a piece, which is always cut between words, are hashed alone."""

    def __init__(self):
        self.power, self.inverse = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))
        self.value = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[0x20, *range(0x09, 0x0E)]] = True

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """By text, its words in order."""
        raw = [(t or "").encode() for t in texts]
        data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        edges = np.flatnonzero(np.diff(self.blank.take(data), prepend=True))
        starts, ends = edges[::2], edges[1::2]
        out = np.empty(len(starts), dtype=np.uint64)
        k = 0
        while k < len(starts):
            first = starts[k]
            last = int(np.searchsorted(ends, first + PIECE, "right"))
            if last == k:
                import xxhash

                out[k] = xxhash.xxh64_intdigest(data[first:ends[k]].tobytes())
                k += 1
                continue
            piece = data[first:ends[last - 1]]
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(self.value.take(piece) * self.power[:len(piece)], out=sums[1:])
            begin = starts[k:last] - first
            out[k:last] = _mixed((sums[ends[k:last] - first] - sums[begin]) * self.inverse[begin] * _M)
            k = last
        # a text ends before the line break that follows it
        return np.split(out, np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raw])[:-1])) if raw else []


def weighted_runs(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different runs, as sorted hashes, and their weights."""
    if not len(words):
        return words, np.zeros(0)
    n = min(RUN, len(words))
    count = len(words) - n + 1
    value = idf[words & np.uint64(WORD_BUCKETS - 1)]
    h, weight = np.zeros(count, dtype=np.uint64), np.zeros(count)
    for k in range(n):
        h = (h + words[k:k + count]) * _M
        weight += value[k:k + count]
    runs, at, times = np.unique(_mixed(h), return_index=True, return_counts=True)
    return runs, times * np.sqrt(weight[at] / n)


class Sampler:
    """Improved consistent weighted sampling with the draws of a run taken from fixed tables. A sample is the
    run that gives the least value; which level of its weight did so is left out, as it hardly ever differs
    for one run. Many texts are sampled at once."""

    def __init__(self):
        rng = np.random.default_rng(7)
        shape = (SAMPLES, DRAWS)
        self.r = rng.gamma(2.0, 1.0, shape).astype(np.float32) + np.float32(1e-6)
        self.inverse = 1 / self.r
        # values stay between -64 and 64; lifted above zero, their bits order as they do
        self.lifted = np.log(rng.gamma(2.0, 1.0, shape)).astype(np.float32) + np.float32(128)
        self.beta = rng.random(shape, dtype=np.float32)
        self.rest = 1 - self.beta
        self.odd = rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)

    def bands(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """texts x BANDS; every text has runs."""
        runs = np.concatenate([r for r, _ in texts])
        log_w = np.log(np.concatenate([w for _, w in texts])).astype(np.float32)
        starts = np.cumsum([0] + [len(r) for r, _ in texts[:-1]])
        name = (_mixed(runs) & np.uint64(0xFFFFFFFF)).view(np.int64)
        out = np.empty((len(texts), SAMPLES), dtype=np.uint64)
        for k in range(SAMPLES):
            at = ((runs * self.odd[k]) >> np.uint64(64 - 14)).view(np.int64)
            value = log_w * self.inverse[k].take(at)
            value += self.beta[k].take(at)
            np.floor(value, out=value)
            value += self.rest[k].take(at)
            value *= self.r[k].take(at)
            np.subtract(self.lifted[k].take(at), value, out=value)
            least = value.view(np.int32).astype(np.int64)
            least <<= 32
            least |= name
            out[:, k] = np.minimum.reduceat(least, starts).view(np.uint64) & np.uint64(0xFFFFFFFF)
        out = _mixed(out * _M).reshape(len(texts), BANDS, ROWS)
        h = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(texts), 1))
        for k in range(ROWS):
            h = _mixed((h + out[:, :, k]) * _M)
        return h.astype(np.int64)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, found = WordHashes(), np.zeros(WORD_BUCKETS, dtype=np.int64)
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in groups(texts, len, GROUP_CHARS):
            words = hashes.of(texts[a:b])
            text = np.repeat(np.arange(b - a, dtype=np.int64), [len(w) for w in words])
            bucket = (np.concatenate(words) & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
            found += np.bincount(np.unique(text * WORD_BUCKETS + bucket) % WORD_BUCKETS, minlength=WORD_BUCKETS)
    some = np.flatnonzero(found)
    yield pd.DataFrame({"bucket": some.astype(np.int32), "n": found[some]})


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """By bucket of words: ln((1 + documents) / (1 + documents with such a word)) + 1."""
    counted = docs.select(text_of().alias("text")).mapInPandas(_frequencies, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()  # WORD_BUCKETS rows at most
    df = np.zeros(WORD_BUCKETS)
    for row in counted:
        df[row["bucket"]] = row["n"]
    return np.log((1 + docs.count()) / (1 + df)) + 1


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared)) if shared else 0.0


class _Cell:
    """Texts of one cell, compared through the runs that at least two of them have."""

    def __init__(self, texts: list[str], idf: np.ndarray):
        hashes = WordHashes()
        runs = [weighted_runs(w, idf) for a, b in groups(texts, len, GROUP_CHARS) for w in hashes.of(texts[a:b])]
        self.n = len(runs)
        self.total = np.array([w.sum() for _, w in runs])
        doc = np.repeat(np.arange(self.n), [len(r) for r, _ in runs])
        _, code, count = np.unique(np.concatenate([r for r, _ in runs]), return_inverse=True, return_counts=True)
        shared = count[code] > 1
        self.codes, self.doc, self.code = len(count), doc[shared], code[shared]
        self.weight = np.concatenate([w for _, w in runs])[shared]
        self.cuts = np.searchsorted(self.doc, np.arange(self.n + 1))
        self.parent = list(range(self.n))

    def similarities(self, i: int) -> np.ndarray:
        mine = np.zeros(self.codes)
        a, b = self.cuts[i], self.cuts[i + 1]
        mine[self.code[a:b]] = self.weight[a:b]
        shared = np.bincount(self.doc, np.minimum(self.weight, mine[self.code]), self.n)
        whole = self.total + self.total[i] - shared
        return np.divide(shared, whole, out=np.zeros(self.n), where=whole > 0)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def link(self, firsts: range, others: np.ndarray) -> np.ndarray:
        """Joins what is similar; the similarities to the first text. Texts already joined are not compared."""
        to_first = np.zeros(self.n)
        for i in firsts:
            roots = np.array([self.root(j) for j in range(self.n)])
            if i and not (roots[others] != roots[i]).any():
                continue
            found = self.similarities(i)
            if i == 0:
                to_first = found
            for j in others[(found[others] >= THRESHOLD) & (roots[others] != roots[i])]:
                self.parent[self.root(int(j))] = self.root(i)
        return to_first


def components(links: DataFrame) -> DataFrame:
    """v, class: the least vertex that links (a, b) connect v with. Every round hands labels to neighbours
    and then follows each label to its own label, so that long chains halve."""
    both = settled(links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(
        links.select(F.col("b").alias("v"), F.col("a").alias("u"))).distinct())
    labels = settled(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("class")))
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), "class"), "u").groupBy("v").agg(F.min("class").alias("near"))
        step = labels.join(near, "v").select("v", F.least("class", "near").alias("class"), F.col("class").alias("was"))
        hop = step.select(F.col("v").alias("class"), F.col("class").alias("far"))
        step = settled(step.join(hop, "class").select("v", F.least("class", "far").alias("class"), "was"))
        changed = step.where(F.col("class") != F.col("was")).limit(1).count()
        labels = step.select("v", "class")
        if not changed:
            return labels


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, key (of the whole text), bands (empty for a text without words)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, sampler = WordHashes(), Sampler()
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in groups(texts, len, GROUP_CHARS):
                part = batch.iloc[a:b]
                runs = [weighted_runs(w, idf) for w in hashes.of(texts[a:b])]
                some = [i for i, r in enumerate(runs) if len(r[0])]
                bands = [[]] * len(runs)
                for i, row in zip(some, sampler.bands([runs[i] for i in some]) if some else []):
                    bands[i] = row
                yield part[["doc_id", "key"]].assign(bands=bands)

    rows = docs.select("doc_id", text_of().alias("text"))
    return rows.withColumn("key", F.md5("text")).mapInPandas(run, "doc_id long, key string, bands array<bigint>")


def _buckets(bands: DataFrame) -> DataFrame:
    """bucket, key, pivot, n: texts that agree in a band. Of buckets with the same members one is kept."""
    rows = bands.select("key", F.posexplode("bands").alias("band", "h")).select("band", "h", "key", F.xxhash64("key").alias("x"))
    sums = rows.groupBy("band", "h").agg(
        F.count("*").alias("n"), F.min("key").alias("pivot"), F.max("key").alias("last"), F.bit_xor("x").alias("print"),
        F.bit_xor(F.xxhash64(F.col("x"), F.lit(1))).alias("print2")).where("n > 1")
    once = sums.groupBy("n", "pivot", "last", "print", "print2").agg(F.min(F.struct("band", "h")).alias("b")).select(
        "n", "pivot", "b.band", "b.h")
    return rows.join(once, ["band", "h"]).select(F.xxhash64("band", "h").alias("bucket"), "band", "h", "key", "pivot", "n")


def _linked(idf: np.ndarray):
    """Per chunk of a bucket: every text's class inside it and its similarity to the pivot, which comes first."""
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["guest", "key"], ascending=[False, True], kind="stable").drop_duplicates("key")
        c = _Cell(cell["text"].tolist(), idf)
        to_pivot = c.link(range(c.n), np.arange(c.n))
        keys = cell["key"].tolist()
        return pd.DataFrame({"band": cell["band"], "h": cell["h"], "a": keys, "b": [keys[c.root(i)] for i in range(c.n)],
                             "to_pivot": to_pivot, "n": cell["n"]})

    return run


def _across(idf: np.ndarray):
    """Per cell of two chunks: links between them."""
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["side", "key"], kind="stable").drop_duplicates(["side", "key"])
        left = int((cell["side"] == 0).sum())
        if not left or left == len(cell):
            return pd.DataFrame({"a": [], "b": []}, dtype=str)
        c = _Cell(cell["text"].tolist(), idf)
        names = cell["class"].tolist()
        first: dict[str, int] = {}
        for i, name in enumerate(names):  # what is one class already needs no comparison
            c.parent[i] = first.setdefault(name, i)
        c.link(range(left), np.arange(left, c.n))
        keys = cell["key"].tolist()
        return pd.DataFrame({"a": keys, "b": [keys[c.root(i)] for i in range(c.n)]})

    return run


def _open_cells(met: DataFrame, classes: DataFrame) -> DataFrame:
    """band, h, i, j, side, key, class: in buckets of several chunks that hold several classes, chunks of the
    texts outside the pivot's class (side 0) beside chunks of all texts that may yet be similar to them."""
    at = met.where(F.col("n") > CHUNK).join(classes, F.col("a") == F.col("v")).select(
        "band", "h", F.col("a").alias("key"), "class", (1 - F.col("to_pivot")).alias("d"))
    reach = 1 - THRESHOLD + 1e-6
    pivot = at.groupBy("band", "h").agg(F.min_by("class", "d").alias("home"))
    at = at.groupBy("band", "h", "key", "class").agg(F.min("d").alias("d")).join(pivot, ["band", "h"]).withColumn(
        "out", F.col("class") != F.col("home"))
    edge = at.where("out").groupBy("band", "h").agg(F.count("*").alias("n_out"), F.min("d").alias("nearest"))
    at = at.join(edge, ["band", "h"]).where(F.col("out") | (F.col("d") >= F.col("nearest") - reach))
    sizes = at.groupBy("band", "h").agg(F.count("*").alias("n_all"))
    at = at.join(sizes, ["band", "h"])
    place = F.xxhash64("key")
    left, right = F.ceil(F.col("n_out") / CHUNK), F.ceil(F.col("n_all") / CHUNK)
    one = at.where("out").withColumn("i", F.pmod(place, left)).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), right - 1)))
    two = at.withColumn("j", F.pmod(place, right)).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), left - 1)))
    columns = ["band", "h", "i", "j", "key", "class"]
    return one.select(*columns, F.lit(0).alias("side")).union(two.select(*columns, F.lit(1).alias("side")))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), class_id: the least doc_id of the row's class."""
    rows = docs.select("doc_id", text_of().alias("text"))
    idf = inverse_frequencies(rows)
    signed = settled(signatures(rows, idf))
    distinct = signed.groupBy("key").agg(F.min("doc_id").alias("rep"))
    bands = signed.where(F.size("bands") > 0).alias("s").join(
        distinct.alias("t"), (F.col("s.key") == F.col("t.key")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select(
        "s.key", "bands").dropDuplicates(["key"])
    members = settled(_buckets(bands))
    asked = members.select("key").distinct().join(distinct, "key").select(F.col("key").alias("k"), "rep")
    keyed = rows.withColumn("key", F.md5("text"))
    texts = settled(keyed.join(asked, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select(
        "key", "text").dropDuplicates(["key"]))

    chunks = F.ceil(F.col("n") / CHUNK)
    own = members.withColumn("chunk", F.pmod(F.xxhash64("key"), chunks)).withColumn("guest", F.col("key") == F.col("pivot"))
    guests = members.where((F.col("key") == F.col("pivot")) & (F.col("n") > CHUNK)).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))).withColumn("guest", F.lit(True))
    cells = own.unionByName(guests).join(texts, "key").select("bucket", "band", "h", "chunk", "key", "guest", "n", "text")
    met = settled(cells.groupBy("bucket", "chunk").applyInPandas(
        _linked(idf), "band int, h long, a string, b string, to_pivot double, n long"))
    links = met.where(F.col("a") != F.col("b")).select("a", "b")
    found = components(links)
    every = met.select(F.col("a").alias("v")).distinct().join(found, "v", "left").select(
        "v", F.coalesce("class", "v").alias("class"))
    cells = _open_cells(met, every)
    more = settled(cells.join(texts, "key").groupBy("band", "h", "i", "j").applyInPandas(
        _across(idf), "a string, b string").where(F.col("a") != F.col("b")))
    if more.limit(1).count():
        found = components(links.union(more))
    vertex = distinct.join(found.withColumnRenamed("v", "key"), "key", "left").select(
        "key", "rep", F.coalesce("class", "key").alias("class"))
    least = vertex.groupBy("class").agg(F.min("rep").alias("class_id"))
    named = vertex.join(least, "class").select("key", "class_id")
    return signed.select("doc_id", "key").join(named, "key").select("doc_id", "key", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, that of its least id, with all columns of docs. Rows without an id are kept
    once per text where their class has no id."""
    chosen = classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.md5(text_of()).alias("_text"))
    return rows.join(chosen, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key"))).dropDuplicates(
        ["_id", "_key"]).select("_row.*")


def query(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "class_id")
