"""Token ids in grammar-compressed shards.

Documents are encoded by a public tokenizer, an end id follows each, and the ids are written in ascending
order of doc_id. A shard holds up to SHARD_IDS ids (one document at least) and is compressed by Re-Pair:
pairs of neighbouring symbols that occur MIN_COUNT times or more are replaced by new symbols, again and
again, until little is gained. It stores the rules, how many ids each symbol of the remaining sequence stands for, and where its
documents begin, so that any document can be decoded alone: its first symbol is found in the running sums of
expansion lengths, and only symbols that overlap it are expanded.

A shard is one binary value of the layout below, in a Parquet table beside its number: Spark's own writer
reaches every store that the session reaches, and its commit keeps the files of a lost executor out.

    header  10 x int64: magic, documents, ids, first symbol of the rules, rules, symbols, bytes a symbol, 3 spare
    doc ids documents x int64; null flags documents x uint8; starts (documents + 1) x int64
    rules   rules x 2 x uint32; expansion lengths rules x uint32; symbols x (2 or 4 bytes)

Defined results: a null or empty text is its end id alone; rows without an id come first; equal ids are
ordered by the text's hash, repeated rows are written each. Extra columns are ignored. An empty table gives
an empty folder of the same schema.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewell.llm.bpe import groups, has_odd_space, parts_of
from sitewell.llm.common import shared_folder, text_of

MAGIC = 0x5249414752455031
SHARD_IDS = 1_000_000
MIN_COUNT = 64
LEAST_GAIN = 0.001  # a round that shortens the sequence by less is the last
END_ID = 0
CACHED_PARTS, CACHED_IDS, CACHED_OTHER_BYTES = 1_500_000, 15_000_000, 50_000_000
GROUP_CHARS = 4_000_000
KEY_BYTES = 32  # whole eights
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
MIXER = np.uint64(0x9E3779B97F4A7C15)
HEADER = 10
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
MARKS = b".,;:!?"


class PartEncoder:
    """Ids of texts by the tokenizers library as it comes, so the string of a special token in a text is that
    token. Places before which a space stands never fall inside a match of the byte-level split pattern, so each
    part between them is encoded once, many in one call. The parts of many texts are told apart in numpy, by a
    hash and then by their bytes; those of more than KEY_BYTES bytes by a dictionary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # strings of special tokens are what the library makes of them: such texts are encoded whole
        self.specials = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        size = self.tokenizer.get_vocab_size()
        # each character of a byte-level token stands for one byte
        self.length = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.marks = np.concatenate(self._ids([chr(m) for m in MARKS]))
        self.mark = np.full(256, -1)  # where a mark's id lies in `ids`
        self.mark[list(MARKS)] = np.arange(len(MARKS))
        self._forget()

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        """Of the known parts: the ids, `n` of them from `start` on; whether they are letters only; the bytes, the
        size last. Their hashes are kept in order, with the part of each."""
        self.ids = self.marks
        self.start, self.n, self.letters = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.keys = [np.zeros(0, np.uint64) for _ in range(KEY_BYTES // 8 + 1)]
        self.hash, self.part = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.others: dict[bytes, int] = {}
        self.other_bytes = 0

    def _learn(self, parts: list[bytes], keys: list[np.ndarray]) -> np.ndarray:
        """Numbers of new parts, each encoded with the space before it."""
        first, counts, found = len(self.n), [], []
        for begin in range(0, len(parts), 2000):
            some = parts[begin:begin + 2000]
            ids = self._ids([(b" " + b" ".join(some)).decode()])[0]
            ends = np.cumsum([len(p) + 1 for p in some])
            counts.append(np.diff(np.searchsorted(np.cumsum(self.length[ids]), ends) + 1, prepend=0))
            found.append(ids)
        n = np.concatenate(counts)
        self.start = np.append(self.start, len(self.ids) + np.cumsum(n) - n)
        self.ids = np.concatenate([self.ids, *found])
        self.n = np.append(self.n, n)
        self.letters = np.append(self.letters, [p.decode().isalpha() for p in parts])
        self.keys = [np.append(known, k) for known, k in zip(self.keys, keys)]
        return np.arange(first, len(self.n), dtype=np.int32)

    def _others(self, parts: list[bytes]) -> list[int]:
        new = list(dict.fromkeys(p for p in parts if p not in self.others))
        if new:
            none = np.zeros(len(new), dtype=np.uint64)  # no size of a part with a hash
            self.others.update(zip(new, self._learn(new, [none] * len(self.keys)).tolist()))
            self.other_bytes += sum(map(len, new))
        return [self.others[p] for p in parts]

    def _numbers(self, data: bytes, eights: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of each part data[begin:begin + size]; eights: the eight bytes from each place on."""
        out = np.zeros(len(begin), dtype=np.int32)
        short = np.flatnonzero(size <= KEY_BYTES)
        at, n = begin[short], size[short]
        keys = [eights[at + k] & LOW_BYTES[np.clip(n - k, 0, 8)] for k in range(0, KEY_BYTES, 8)] + [n.astype(np.uint64)]
        mixed = np.zeros(len(at), dtype=np.uint64)
        for key in keys:
            mixed = (mixed ^ key) * MIXER
            mixed ^= mixed >> np.uint64(29)
        hashes, which = np.unique(mixed, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        new = np.flatnonzero(self.hash[place] != hashes) if len(self.hash) else np.arange(len(hashes))
        if len(new):
            one = np.zeros(len(hashes), dtype=np.int64)
            one[which] = np.arange(len(which))
            one = one[new]
            parts = [data[a:b] for a, b in zip(at[one].tolist(), (at[one] + n[one]).tolist())]
            learned = self._learn(parts, [k[one] for k in keys])
            order = np.argsort(hashed := np.append(self.hash, hashes[new]), kind="stable")
            self.hash, self.part = hashed[order], np.append(self.part, learned)[order]
            place = np.searchsorted(self.hash, hashes)
        number = self.part[place][which] if len(hashes) else out[:0]
        out[short] = number
        same = np.ones(len(short), dtype=bool)
        for known, key in zip(self.keys, keys):
            same &= known[number] == key
        rest = np.append(short[~same], np.flatnonzero(size > KEY_BYTES))
        out[rest] = self._others([data[a:b] for a, b in zip(begin[rest].tolist(), (begin[rest] + size[rest]).tolist())])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.n) > CACHED_PARTS or len(self.ids) > CACHED_IDS or self.other_bytes > CACHED_OTHER_BYTES:
            self._forget()
        whole = [any(x in t for x in self.specials) for t in texts]
        raw = [b"" if w else t.encode() for t, w in zip(texts, whole)]
        data = b" ".join([*raw, b""])  # a space ends each text
        offsets = np.append(0, np.cumsum([len(r) + 1 for r in raw]))
        flat = np.frombuffer(data, dtype=np.uint8)
        ends = np.flatnonzero(flat == 32)
        odd = [k for k, (t, w) in enumerate(zip(texts, whole)) if not w and has_odd_space(t)]
        if odd:  # not every space of these ends a part
            kept, ours = np.ones(len(ends), dtype=bool), []
            for k in odd:
                kept[slice(*np.searchsorted(ends, offsets[k:k + 2]))] = False
                first, rest = parts_of(texts[k])
                ours.append(offsets[k] - 1 + np.cumsum([len(p.encode()) + 1 for p in (first, *rest)]))
            ends = np.sort(np.concatenate([ends[kept], *ours]))
        begin = np.append(0, ends[:-1] + 1)
        lead = np.searchsorted(begin, offsets)  # the first part of each text, no space before it
        firsts = self._ids([t if w else data[a:b].decode() for t, w, a, b in zip(
            texts, whole, offsets.tolist(), ends[lead[:-1]].tolist())])
        rest = np.ones(len(begin), dtype=bool)
        rest[lead[:-1]] = False
        begin, ends = begin[rest], ends[rest]
        # letters with a mark behind them are two matches of the pattern
        mark = np.where(ends - begin > 1, self.mark[flat[ends - 1]], -1)
        eights = np.ndarray(len(data) + KEY_BYTES, "<u8", data + bytes(KEY_BYTES + 7), strides=(1,)).copy()
        number = self._numbers(data, eights, begin, ends - begin - (mark >= 0))
        together = np.flatnonzero((mark >= 0) & ~self.letters[number])
        mark[together] = -1
        number[together] = self._numbers(data, eights, begin[together], (ends - begin)[together])
        count = self.n[number] + (mark >= 0)
        upto = np.append(0, np.cumsum(count))
        source = np.arange(upto[-1]) + np.repeat(self.start[number] - upto[:-1], count)
        source[upto[1:][mark >= 0] - 1] = mark[mark >= 0]
        ids = self.ids[source].tobytes()
        cuts = (4 * upto[lead - np.arange(len(lead))]).tolist()
        return [f.tobytes() + ids[a:b] for f, a, b in zip(firsts, cuts, cuts[1:])]


_encoders: dict[str, PartEncoder] = {}


def _encoder(path: str) -> PartEncoder:
    """One for each worker process, which serves many tasks."""
    if path not in _encoders:
        _encoders[path] = PartEncoder(path)
    return _encoders[path]


def re_pair(ids: np.ndarray, first: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules): rule k says which two symbols `first` + k stands for. In each round every pair that
    is frequent enough is replaced wherever no commoner pair overlaps it."""
    seq, rules, n_rules = ids.astype(np.int64), [], 0
    named = np.zeros(SLOTS, dtype=np.int64)  # the key last met in each slot
    while len(seq) > 1:
        key = (seq[:-1] << 32) | seq[1:]
        # counts by a small hash rule out most rare pairs before the exact counts
        slot = (key * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(64 - SLOT_BITS)
        slot = slot.astype(np.int32)
        often = np.bincount(slot, minlength=SLOTS) >= min_count
        at = np.flatnonzero(often[slot])
        if len(at) < len(seq) * LEAST_GAIN or not len(at):
            break
        slots = np.flatnonzero(often)
        number = np.zeros(SLOTS, dtype=np.int32)
        number[slots] = np.arange(len(slots), dtype=np.int32)
        kept = key[at]
        named[slot[at]] = kept
        which, pairs = number[slot[at]], named[slots]
        shared = np.flatnonzero(pairs[which] != kept)
        if len(shared):  # other keys of a slot get numbers of their own
            others, theirs = np.unique(kept[shared], return_inverse=True)
            which[shared] = len(pairs) + theirs
            pairs = np.append(pairs, others)
        count = np.bincount(which, minlength=len(pairs))
        enough = np.flatnonzero(count >= min_count)
        never = len(enough)
        order = np.full(len(pairs), never, dtype=np.int32)
        ranked = enough[np.lexsort((pairs[enough], -count[enough]))]
        order[ranked] = np.arange(never, dtype=np.int32)
        rank = np.full(len(seq) + 1, never, dtype=np.int32)
        rank[at + 1] = order[which]
        mine = rank[1:-1]  # by the place of a pair's left symbol; one more at either end
        chosen = (mine < never) & (mine <= rank[:-2]) & (mine <= rank[2:])
        # in a run of one pair every second place is free
        again = np.flatnonzero(chosen & (mine == rank[:-2]))
        if len(again):
            heads = np.flatnonzero(mine != rank[:-2])
            chosen[again] = (again - heads[np.searchsorted(heads, again) - 1]) % 2 == 0
        left = np.flatnonzero(chosen)
        used = np.bincount(mine[left], minlength=never)
        left = left[used[mine[left]] >= min_count]
        if len(left) < len(seq) * LEAST_GAIN:
            break
        kinds = np.flatnonzero(used >= min_count)
        kinds = kinds[np.argsort(pairs[ranked[kinds]])]
        symbol = np.zeros(never, dtype=np.int64)
        symbol[kinds] = first + n_rules + np.arange(len(kinds))
        rules.append(np.stack([pairs[ranked[kinds]] >> 32, pairs[ranked[kinds]] & 0xFFFFFFFF], axis=1))
        seq[left] = symbol[mine[left]]
        n_rules += len(kinds)
        stay = np.ones(len(seq), dtype=bool)
        stay[left + 1] = False
        seq = seq[stay]
    return seq, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)


def rule_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """How many ids each rule expands to. A rule only refers to earlier rules."""
    out = np.ones(first + len(rules), dtype=np.int64)
    done = 0
    while done < len(rules):  # a stretch of rules whose parts are all known at once
        later = np.flatnonzero((rules[done:] >= first + done).any(1))
        end = done + (int(later[0]) if len(later) else len(rules) - done)
        out[first + done:first + end] = out[rules[done:end, 0]] + out[rules[done:end, 1]]
        done = end
    return out[first:]


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """Each pass puts the two parts of every rule symbol in its place."""
    seq = symbols.astype(np.int64)
    while True:
        ruled = seq >= first
        if not ruled.any():
            return seq
        place = np.cumsum(ruled + 1) - (ruled + 1)
        out = np.empty(len(seq) + int(ruled.sum()), dtype=np.int64)
        out[place[~ruled]] = seq[~ruled]
        pairs = rules[seq[ruled] - first]
        out[place[ruled]], out[place[ruled] + 1] = pairs[:, 0], pairs[:, 1]
        seq = out


def pack(doc_ids: list, ids: list[bytes]) -> bytes:
    """The bytes of one shard; each document's ids end with the end id."""
    flat = np.frombuffer(b"".join(ids), dtype="<u4")
    first = int(flat.max()) + 1 if len(flat) else 1
    symbols, rules = re_pair(flat, first)
    width = 2 if first + len(rules) <= 1 << 16 else 4
    starts = np.append(0, np.cumsum([len(i) // 4 for i in ids]))
    header = np.array([MAGIC, len(ids), len(flat), first, len(rules), len(symbols), width, 0, 0, 0], dtype="<i8")
    none = np.array([d is None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    return b"".join(a.tobytes() for a in (
        header, numbers, none, starts.astype("<i8"), rules.astype("<u4"), rule_lengths(rules, first).astype("<u4"),
        symbols.astype(f"<u{width}")))


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, data: bytes):
        magic, docs, self.n_ids, self.first, rules, symbols, width, *_ = np.frombuffer(data, "<i8", HEADER).tolist()
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = 8 * HEADER

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        numbers, none = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if skip else int(d) for d, skip in zip(numbers, none)]
        self.starts = take("<i8", docs + 1)
        self.rules = take("<u4", 2 * rules).reshape(rules, 2).astype(np.int64)
        lengths = take("<u4", rules).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols).astype(np.int64)
        ruled = self.symbols >= self.first
        length = np.ones(symbols, dtype=np.int64)
        length[ruled] = lengths[self.symbols[ruled] - self.first]
        self.ends = np.cumsum(length)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from start to end, expanding the symbols that overlap them only."""
        if start >= end:
            return np.zeros(0, dtype="<u4")
        a = int(np.searchsorted(self.ends, start, side="right"))
        b = int(np.searchsorted(self.ends, end, side="left")) + 1
        before = int(self.ends[a - 1]) if a else 0
        return expand(self.symbols[a:b], self.rules, self.first)[start - before:end - before].astype("<u4")

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def all_ids(self) -> np.ndarray:
        """Each rule is expanded once and copied to where its symbol stands."""
        length = np.diff(self.ends, prepend=0)
        ruled = np.flatnonzero(self.symbols >= self.first)
        out = np.empty(self.n_ids, dtype="<u4")
        plain = self.symbols < self.first
        out[self.ends[plain] - 1] = self.symbols[plain]
        used, which = np.unique(self.symbols[ruled], return_inverse=True)
        table = expand(used, self.rules, self.first).astype("<u4")
        size = np.zeros(len(used), dtype=np.int64)
        size[which] = length[ruled]
        n = length[ruled]
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(self.ends[ruled] - n, n) + nth] = table[np.repeat((np.cumsum(size) - size)[which], n) + nth]
        return out

    def documents(self) -> Iterator[np.ndarray]:
        flat = self.all_ids()
        for a, b in zip(self.starts[:-1], self.starts[1:]):
            yield flat[a:b]


SHARDS = "part int, shard int, docs long, ids long, data binary"


def write(docs: DataFrame, folder: str, tokenizer: str) -> None:
    """Writes doc_id, text as shards. A range of doc_ids is one partition, cut into shards in order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], dtype="<u4").tobytes()
        doc_ids, ids, size = [], [], 0

        def full() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "shard": [shard], "docs": [len(ids)], "ids": [size], "data": [pack(doc_ids, ids)]})

        for batch in batches:
            texts = batch["text"].tolist()
            numbers = [None if none else int(d) for d, none in zip(batch["doc_id"], batch["doc_id"].isna())]
            for a, b in groups(texts, len, GROUP_CHARS):
                for number, packed in zip(numbers[a:b], _encoder(tokenizer).encode(texts[a:b])):
                    n = len(packed) // 4 + 1
                    if ids and size + n > SHARD_IDS:
                        yield full()
                        shard, doc_ids, ids, size = shard + 1, [], [], 0
                    doc_ids.append(number)
                    ids.append(packed + end)
                    size += n
        if ids:
            yield full()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.md5("text"))
    spread = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "h").select(
        F.col("doc_id").cast("decimal(20,0)").cast("string").alias("doc_id"), "text")
    spread.mapInPandas(run, SHARDS).write.option("compression", "none").parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit): every document, from the files alone."""
    files = spark.read.schema(SHARDS).parquet(folder)
    sizes = files.select("part", "shard", "ids")
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    starts = sizes.join(parts, "part").select("part", "shard", (
        F.col("before") + F.sum("ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("ids")).alias("start"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, data in zip(batch["start"], batch["data"]):
                shard = Shard(bytes(data))
                yield pd.DataFrame({"doc_id": pd.array(shard.doc_ids, dtype="Int64"), "start": start + shard.starts[:-1],
                                    "n_tokens": np.diff(shard.starts), "ids": [i.tobytes() for i in shard.documents()]})

    return files.select("part", "shard", "data").join(starts, ["part", "shard"]).select("start", "data").mapInPandas(
        run, "doc_id long, start long, n_tokens long, ids binary")


def query(docs: DataFrame, tokenizer: str) -> DataFrame:
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write(docs, folder, tokenizer)
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
