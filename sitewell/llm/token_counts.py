"""Exact token counts of every prefix of a text, by dynamic programming over byte-level BPE.

The encoding of a word's first i bytes ends in exactly one token t, and what stands before t is the encoding
of the bytes before it. So the last token of every prefix is found from the left: of the tokens that end at i
(an Aho-Corasick automaton lists them) it is the one that may follow the last token of the prefix it leaves.
Token v may follow u if no merge across their border comes before the merges that build u and v; only the
tokens along u's right edge and v's left edge can take part in one, so they are walked upwards by rank, once
for each pair met. One more than the count of the shorter prefix is the count of the longer one.

A text's words come from the byte-level split pattern. Where a cut changes the words themselves the count is
that of the cut text: white space before a word stays together at the end of a prefix, a contraction cut
short is a mark and a letter, and a special string counts as one token only when it is whole.

`prefix_counts` is kept beside the text as compressed differences from character to character. Questions of
truncation and budget are answered from it: `count_at`, `longest_within`. Counts may fall when a character
is added ("hel" takes more tokens than "hell"), so the longest prefix within a budget is the last one, not
the first that exceeds it less one.

Defined results: a null or empty text has no characters and no tokens; texts of any length are counted whole;
repeated rows are counted each; extra columns pass through, and one that has the name of an added column is
replaced by it. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from sitewell.llm.bpe import groups, parts_of
from sitewell.llm.common import text_of

GROUP_CHARS = 2_000_000
CACHED_CHARS = 4_000_000  # of parts and of words, each
CACHED_PAIRS = 500_000

# The split pattern of byte-level tokenizer files, and the contractions of which a cut is two words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")

MARKS = frozenset(".,;:!?")
_ONE = array("h", [1]).tobytes()
_SPACES = re.compile(r"\s \S")
_NEVER = 1 << 40  # later than every merge


def alphabet() -> dict[str, str]:
    """Characters of a byte-level vocabulary and the bytes they stand for, as Latin-1: printable bytes stand
    for themselves, the others are numbered from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + n): chr(b) for n, b in enumerate(others)}


class Merges:
    """The merge table of a byte-level tokenizer file, and which tokens may stand side by side."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path}: not a byte-level BPE that takes texts as they are")
        letters = str.maketrans(alphabet())
        ids = {t.translate(letters): i for t, i in model["vocab"].items()}
        self.rank: dict[int, int] = {}  # of a pair of neighbours
        self.halves: dict[int, tuple[int, int, int]] = {}  # of a merged token: its parts and their rank
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            a, b = a.translate(letters), b.translate(letters)
            pair, token = (ids[a], ids[b]), ids[a + b]
            if token in self.halves:
                raise ValueError(f"{path}: two merges make the token {a + b!r}")
            self.rank[pair[0] << 24 | pair[1]], self.halves[token] = rank, (*pair, rank)
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.known: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for text, token in ids.items():
            if token not in self.halves or self._stands(*self.halves[token]):  # else the merges never make it
                self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at the left (0) or right (1) edge of a token, the smallest first, each with the rank of the
        merge that takes it up."""
        found = self.edges.get((token, side))
        if found is None:
            found, at, taken = [], token, _NEVER
            while True:
                found.append((at, taken))
                if at not in self.halves:
                    break
                taken, at = self.halves[at][2], self.halves[at][side]
            found.reverse()
            self.edges[token, side] = found
        return found

    def _stands(self, u: int, v: int, until: int = _NEVER) -> bool:
        """Whether no merge across the border of u and v comes before rank `until`."""
        left, right = self._edge(u, 1), self._edge(v, 0)
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = left[i], right[j]
            rank = self.rank.get(a << 24 | b, _NEVER)
            # of equal merges the left one comes first: u's before the one across, that before v's
            if rank < until and rank < a_taken and rank <= b_taken:
                return False
            if a_taken <= b_taken:
                if a_taken == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def counts(self, word: str) -> list[int]:
        """Tokens of the first 1, 2, ... bytes of a word, given as Latin-1."""
        last, count, known = [-1] * (len(word) + 1), [0] * (len(word) + 1), self.known
        done = 0
        for end, (token, length) in self.automaton.iter(word):  # of one end the longest first
            at = end + 1
            if at == done:
                continue
            start = at - length
            if start:
                pair = last[start] << 24 | token
                follows = known.get(pair)
                if follows is None:
                    if len(known) >= CACHED_PAIRS:
                        known.clear()
                    follows = known[pair] = self._stands(last[start], token)
                if not follows:
                    continue
            last[at], count[at], done = token, count[start] + 1, at
        return count[1:]


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


class _Cache(dict):
    """Values by text; forgets all once their texts are longer than CACHED_CHARS together."""

    def __init__(self, make):
        super().__init__()
        self.make, self.chars = make, 0

    def __missing__(self, text: str):
        value = self.make(text)
        self.chars += len(text)
        if self.chars > CACHED_CHARS:
            self.clear()
            self.chars = len(text)
        self[text] = value
        return value


class PrefixCounter:
    """Token counts of all prefixes of texts, as arrays of differences from character to character."""

    def __init__(self, path: str):
        import regex

        self.merges = merges(path)
        self.split = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, self.merges.specials))) if self.merges.specials else None
        self.words = _Cache(self._word)
        self.parts = _Cache(self._part)  # looked up without the space before them

    def _word(self, word: str) -> list[int]:
        """Counts by character of one match of the pattern."""
        if word.isascii():
            counts = self.merges.counts(word)
        else:
            by_byte = self.merges.counts(word.encode().decode("latin-1"))
            ends = np.cumsum([len(c.encode()) for c in word])
            counts = [by_byte[e - 1] for e in ends.tolist()]
        if word in LONG_CONTRACTIONS:
            counts[1] = 2
        return counts

    def _part(self, part: str) -> bytes:
        if part.isalpha():  # one match of the pattern
            return self._steps(self._word(" " + part))
        if part[-1] in MARKS and part[:-1].isalpha():  # two, the mark is one token
            return self.parts[part[:-1]] + _ONE
        return self._steps(self._chunk(" " + part))

    def _chunk(self, text: str) -> list[int]:
        """Counts by character of a text without special strings."""
        out, total, blank = [], 0, ""
        for word in self.split(text):
            counts = self.words[word]
            out += [total + c for c in counts]
            if blank and word[0].isspace():  # cut behind its first character, both are white space at the end
                out[-len(word)] = total - self.words[blank][-1] + self.words[blank + word[0]][-1]
            total += counts[-1]
            blank = word if word.isspace() else ""
        return out

    @staticmethod
    def _steps(counts: list[int]) -> bytes:
        return array("h", [b - a for a, b in zip([0, *counts], counts)]).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        """Counts by character of a text without special strings, from its parts."""
        first, rest = parts_of(text)
        steps = np.frombuffer(self._steps(self._chunk(first)) + b"".join([self.parts[p] for p in rest]), dtype=np.int16)
        counts = np.cumsum(steps, dtype=np.int64)
        if not _SPACES.search(text):
            return counts
        at = len(first)
        for before, part in zip([first, *rest], rest):
            if before[-1:].isspace():  # white space, then the space before a part: together at the end of a prefix
                chunk = before if before is first and at == len(first) else " " + before
                alone = self._chunk(chunk + " ")
                counts[at] = (counts[at - 1] if at else 0) - alone[-2] + alone[-1]
            at += 1 + len(part)
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Tokens of the first 1, 2, ... characters."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, total, start = [], 0, 0
        for found in [*self.special.finditer(text), None]:
            counts = self._plain(text[start:found.end() if found else len(text)])
            if found:
                before = found.start() - start
                counts[-1] = (counts[before - 1] if before else 0) + 1
                start = found.end()
            out.append(counts + total)
            total += int(counts[-1]) if len(counts) else 0
        return np.concatenate(out)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One for each worker process, which serves many tasks."""
    if path not in _counters:
        _counters.clear()
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def packed(counts: np.ndarray) -> bytes:
    return zlib.compress(np.diff(counts, prepend=0).astype("<i2").tobytes(), 1)


def unpacked(stored: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(stored), dtype="<i2"), dtype=np.int64)


def last_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most so many tokens; the empty one has none."""
    if len(counts) and counts[-1] <= budget:
        return len(counts)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def counted(rows: DataFrame, path: str, budget: int | None = None, text: str = "text") -> DataFrame:
    """rows with `n_tokens`, `prefix_counts` and, given a budget, `within`: the characters of the longest
    prefix of at most so many tokens."""
    added = {"n_tokens": LongType(), "prefix_counts": BinaryType()} | ({} if budget is None else {"within": LongType()})
    kept = rows.drop(*[c for c in added if c != text])
    schema = StructType(kept.schema.fields + [StructField(n, t) for n, t in added.items()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch[text]]
            for a, b in groups(texts, len, GROUP_CHARS):
                n, stored, within = [], [], []
                for t in texts[a:b]:
                    counts = count.counts(t)
                    n.append(int(counts[-1]) if len(counts) else 0)
                    stored.append(packed(counts))
                    within.append(0 if budget is None else last_within(counts, budget))
                new = batch.iloc[a:b].assign(n_tokens=n, prefix_counts=stored)
                yield new if budget is None else new.assign(within=within)

    return kept.mapInPandas(run, schema)


def count_at(prefix_counts: str | Column, chars: str | Column) -> Column:
    """Tokens of the first `chars` characters, from stored counts: at most all of them, none below one."""
    @F.pandas_udf("long")
    def answer(stored: pd.Series, cut: pd.Series) -> pd.Series:
        def one(s, n):
            if s is None or pd.isna(n):
                return None
            counts = unpacked(s)
            n = min(int(n), len(counts))
            return int(counts[n - 1]) if n > 0 else 0
        return pd.Series([one(s, n) for s, n in zip(stored, cut)], dtype="Int64")

    return answer(prefix_counts, chars)


def longest_within(prefix_counts: str | Column, budget: str | Column) -> Column:
    """Characters of the longest prefix of at most `budget` tokens, from stored counts."""
    @F.pandas_udf("long")
    def answer(stored: pd.Series, most: pd.Series) -> pd.Series:
        return pd.Series([None if s is None or pd.isna(m) else last_within(unpacked(s), int(m))
                          for s, m in zip(stored, most)], dtype="Int64")

    return answer(prefix_counts, budget)


def query(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    rows = docs.select("doc_id", text_of().alias("text"))
    return counted(rows.withColumn("n_bytes", F.octet_length("text").cast("long")), path, limit).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("within").alias("limit_chars"))
