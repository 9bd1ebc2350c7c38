"""Byte-level BPE: DuckDB recursive queries inside Spark's partitions.

A text falls into parts at every space before a character that is no white space: no match of the split
pattern crosses such a place, so parts are encoded alone, once per task as long as they stay in a bounded
memory. Words (matches of the pattern inside a part) become rows of token and position. A recursive query
joins neighbours to the merge table and contracts, in every word at once, the leftmost pair of least rank,
until no word has a pair left. Decoding joins a document's id rows to the vocabulary and puts the bytes
together by an ordered aggregation.

A word that is itself a token is that token, as in the public tokenizer library. The rows of the recursion
grow with the square of a word's length, so words of more than LONG_WORD bytes are merged by the same rule
with a heap. Defined results: a null or empty text has no ids and decodes to nothing; texts of any length
are taken whole; repeated rows are encoded each on its own; extra columns pass through, and one that has the
name of an added column (`ids`, `decoded`) is replaced by it. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

# A group of texts is encoded at once: larger ones spread a query's fixed cost, smaller ones take less memory.
GROUP_CHARS = 2_000_000
CHARS_PER_ID, CHARS_PER_WORD = 8, 80  # of a group, for the ids decoded and the new words merged by one query
CACHED_PARTS = 300_000
CACHED_WORDS = 500_000
LONG_WORD = 400

MARKS = frozenset(".,;:!?")
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|$)")

# least packs a pair's rank, place and the place after it, so the smallest number is the leftmost pair of least rank
ENCODE = """
WITH RECURSIVE state(step, word, pos, token, next_pos, next_token, rank) AS (
    SELECT 0, t.word, t.pos, t.token, t.next_pos, t.next_token, m.rank
    FROM tokens t LEFT JOIN merges m ON m.a = t.token AND m.b = t.next_token
    UNION ALL
    (WITH least AS (
        SELECT word, min((rank::BIGINT << 40) | (pos::BIGINT << 20) | next_pos) AS k
        FROM state WHERE rank IS NOT NULL GROUP BY word),
    best AS (
        SELECT l.word, ((l.k >> 20) & 1048575)::INTEGER AS pos, (l.k >> 40)::INTEGER AS token, y.pos AS gone,
               y.next_pos, y.next_token
        FROM least l JOIN state y ON y.word = l.word AND y.pos = (l.k & 1048575)),
    contracted AS (
        SELECT s.step + 1 AS step, s.word, s.pos,
               CASE WHEN s.pos = b.pos THEN b.token ELSE s.token END AS token,
               CASE WHEN s.pos = b.pos THEN b.next_pos ELSE s.next_pos END AS next_pos,
               CASE WHEN s.pos = b.pos THEN b.next_token WHEN s.next_pos = b.pos THEN b.token
                    ELSE s.next_token END AS next_token,
               s.rank, s.pos = b.pos OR s.next_pos = b.pos AS changed
        FROM state s JOIN best b ON b.word = s.word
        WHERE s.pos <> b.gone)
    SELECT c.step, c.word, c.pos, c.token, c.next_pos, c.next_token, CASE WHEN changed THEN m.rank ELSE c.rank END
    FROM contracted c LEFT JOIN merges m ON m.a = CASE WHEN changed THEN c.token END AND m.b = c.next_token))
SELECT s.word, s.token
FROM state s JOIN (SELECT word, max(step) AS step FROM state GROUP BY word) USING (word, step)
ORDER BY s.word, s.pos
"""

DECODE = """
SELECT i.doc, string_agg(v.hex, '' ORDER BY i.pos) AS bytes
FROM ids i JOIN vocabulary v ON v.id = i.id GROUP BY i.doc
"""


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def merge_table(path: str) -> pd.DataFrame:
    """a, b, rank: every pair of tokens whose bytes together are a token; its id is its rank."""
    known = ranks(path)
    pairs = [(known[t[:i]], known[t[i:]], rank) for t, rank in known.items() for i in range(1, len(t))
             if t[:i] in known and t[i:] in known]
    return pd.DataFrame(pairs, columns=["a", "b", "rank"], dtype="int32")


def merged_by_heap(word: bytes, known: dict[bytes, int]) -> list[int]:
    """The same contraction for a long word: least rank first, leftmost among equals."""
    parts, after = [word[i:i + 1] for i in range(len(word))], list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    pair = lambda i: known.get(parts[i] + parts[after[i]]) if after[i] < len(word) else None
    heap = [(r, i, len(parts[i]) + 1) for i in range(len(word)) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, length = heapq.heappop(heap)
        if parts[i] is None or pair(i) != rank or len(parts[i]) + len(parts[after[i]]) != length:
            continue
        j = after[i]
        parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
        if after[i] < len(word):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (r := pair(k)) is not None:
                heapq.heappush(heap, (r, k, len(parts[k]) + len(parts[after[k]])))
    return [known[p] for p in parts if p is not None]


def has_odd_space(text: str) -> bool:
    """Whether white space or nothing follows a space: such a space ends no part."""
    return _ODD.search(text) is not None


def parts_of(text: str) -> tuple[str, list[str]]:
    """The first part, and those that follow a space (without it)."""
    first, *rest = _CUT.split(text) if has_odd_space(text) else text.split(" ")
    return first, rest


class Encoder:
    """A task's DuckDB connection, merge table and the ids of parts met so far."""

    def __init__(self, path: str, pattern: str, group: int = GROUP_CHARS):
        import duckdb
        import regex

        self.at_once = max(1, group // CHARS_PER_WORD)
        self.known = ranks(path)
        self.split = regex.compile(pattern).findall
        # what byte-level patterns all agree on: letters with a space before them are one match, a mark is another
        self.plain = self.split(" ab, c") == [" ab", ",", " c"]
        self.bytes = np.array([self.known[bytes([b])] for b in range(256)], dtype=np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        merges = merge_table(path)  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.parts: dict[str, bytes] = {}  # without the space that stands before them
        self.words: dict[str, bytes] = {}

    def _words(self, words: list[bytes]) -> dict[bytes, bytes]:
        found = {w: np.array([self.known[w]], dtype="<u4").tobytes() for w in words if w in self.known}
        found |= {w: np.array(merged_by_heap(w, self.known), dtype="<u4").tobytes()
                  for w in words if len(w) > LONG_WORD and w not in found}
        rest = [w for w in words if w not in found]
        for start in range(0, len(rest), self.at_once):
            some = rest[start:start + self.at_once]
            lengths = np.array([len(w) for w in some])
            token = self.bytes[np.frombuffer(b"".join(some), dtype=np.uint8)]
            word = np.repeat(np.arange(len(some), dtype=np.int32), lengths)
            ends = np.cumsum(lengths)
            pos = (np.arange(len(token)) - np.repeat(ends - lengths, lengths)).astype(np.int32)
            next_token = np.append(token[1:], 0)
            next_token[ends - 1] = -1
            tokens = pd.DataFrame({"word": word, "pos": pos, "token": token, "next_pos": pos + 1, "next_token": next_token})  # noqa: F841
            out = self.db.execute(ENCODE).fetchnumpy()
            ids = np.asarray(out["token"]).astype("<u4")
            cuts = np.searchsorted(np.asarray(out["word"]), np.arange(len(some) + 1))
            raw = ids.tobytes()
            found.update((w, raw[4 * a:4 * b]) for w, a, b in zip(some, cuts[:-1].tolist(), cuts[1:].tolist()))
        return found

    def _matches(self, part: str) -> list[str]:
        letters = part[1:-1] if part[-1:] in MARKS else part[1:]
        if self.plain and part[:1] == " " and letters.isalpha() and (letters.isascii() or max(letters) < "\u0250"):
            return [part] if part[-1] not in MARKS else [part[:-1], part[-1]]
        return self.split(part)

    def _ids(self, parts: list[str]) -> list[bytes]:
        words = [self._matches(p) for p in parts]
        unseen = set().union(*words) - self.words.keys()
        if len(self.words) + len(unseen) > CACHED_WORDS:
            self.words = {}
            unseen = set().union(*words)
        as_bytes = {w: w.encode() for w in unseen}
        found = self._words(list(as_bytes.values()))
        self.words.update((w, found[b]) for w, b in as_bytes.items())
        return [b"".join(map(self.words.__getitem__, ws)) for ws in words]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [parts_of(t) if t else ("", []) for t in texts]
        unseen = set().union(*[rest for _, rest in split])
        if len(self.parts) + len(unseen) > CACHED_PARTS:
            self.parts = {}
        unseen = list(unseen - self.parts.keys())
        firsts = list({first for first, _ in split})
        ids = self._ids([" " + p for p in unseen] + firsts)
        self.parts.update(zip(unseen, ids))
        first_ids = dict(zip(firsts, ids[len(unseen):]))
        return [first_ids[first] + b"".join(map(self.parts.__getitem__, rest)) for first, rest in split]


class Decoder:
    def __init__(self, path: str):
        import duckdb

        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        known = ranks(path)
        vocabulary = pd.DataFrame({"id": np.array(list(known.values()), dtype=np.int32), "hex": [t.hex() for t in known]})  # noqa: F841
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")

    def decode(self, packed: list[bytes]) -> list[bytes]:
        lengths = np.array([len(p) // 4 for p in packed], dtype=np.int64)
        total = int(lengths.sum())
        if not total:
            return [b""] * len(packed)
        ends = np.cumsum(lengths)
        ids = pd.DataFrame({  # noqa: F841
            "doc": np.repeat(np.arange(len(packed), dtype=np.int32), lengths),
            "pos": np.arange(total, dtype=np.int64) - np.repeat(ends - lengths, lengths),
            "id": np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)})
        out = [b""] * len(packed)
        for doc, found in self.db.execute(DECODE).fetchall():
            out[doc] = bytes.fromhex(found)
        return out


def groups(values: list, weight, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of values of about `most` weight, one value at least."""
    start = total = 0
    for i, v in enumerate(values):
        total += weight(v)
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(values):
        yield start, len(values)


def _with(rows: DataFrame, *names: str) -> tuple[DataFrame, StructType]:
    """rows without columns of these names, and the schema with them as binary."""
    kept = rows.drop(*names)
    return kept, StructType([*kept.schema.fields, *[StructField(n, BinaryType()) for n in names]])


def encode(rows: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False,
           group: int = GROUP_CHARS) -> DataFrame:
    """rows with `ids`: little-endian unsigned 32-bit ids of the whole text; and, if asked for, `decoded`: the
    bytes that these ids stand for, by the same worker. `group` is the number of characters worked on at once,
    one text at least."""
    kept, schema = _with(rows, "ids", *(["decoded"] if decoded else []))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = decoder = None
        for batch in batches:
            encoder = encoder or Encoder(path, pattern, group)
            decoder = decoder or (Decoder(path) if decoded else None)
            texts = [t if isinstance(t, str) else None for t in batch[text]]
            for a, b in groups(texts, lambda t: len(t or ""), group):
                ids = encoder.encode(texts[a:b])
                out = batch.iloc[a:b].assign(ids=ids)
                if decoder:
                    out["decoded"] = [d for c, e in groups(ids, lambda p: len(p) // 4, group // CHARS_PER_ID) for d in decoder.decode(ids[c:e])]
                yield out
        for used in (encoder, decoder):  # a worker serves many tasks: what one has gathered goes with it
            if used:
                used.db.close()

    return kept.mapInPandas(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """rows with `decoded`: the bytes that the ids stand for."""
    kept, schema = _with(rows, "decoded")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(path)
            packed = [bytes(p) if p is not None else b"" for p in batch[ids]]
            for a, b in groups(packed, lambda p: len(p) // 4, GROUP_CHARS // CHARS_PER_ID):
                yield batch.iloc[a:b].assign(decoded=decoder.decode(packed[a:b]))
        if decoder:
            decoder.db.close()

    return kept.mapInPandas(run, schema)


def query(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    # alone on its executors, it has the memory for larger groups
    return encode(docs.select("doc_id", "text"), path, pattern, decoded=True, group=3 * GROUP_CHARS).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
