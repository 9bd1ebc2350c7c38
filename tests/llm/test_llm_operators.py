"""The ten operators against brute force, round trips and held-out accuracy."""

import math
import os
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitewell.llm import bpe, causal_lm, knn, licences, mixing, near_dup, quality, registered, token_files, toxicity, url_filter
from tests.compare import connect, differences
from tests.llm.conftest import EDGES, prose

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def is_held(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == 0


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_same_as_sql(spark, name):
    assert differences(spark, connect(FOLDER), registered.QUERIES[name], registered.SQL[name], FOLDER) is None


# --- 1 byte-level BPE -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(RANKS), special_tokens={})


ODD = ["", "a", "  a  b ", "a\n\n b", "\n \n x", "x \x1cy \x85z q  ", "'s it's IT'S 're", " \t tab", "日本語 テキスト ñandú",
       "a" * 900 + " " + "ab" * 700, " " * 700 + "x", "x" + " " * 700, "<|endoftext|> hi", "1234567 89.5%%% !!  ...",
       "a \n", "tail ", "\r\n\r\nx  \r\n y", "​ zero​w ﻿ b", "\x00 a\x00", " nb sp 　 wide"]


def test_bpe_equals_the_library_on_odd_texts(library):
    got = bpe.Encoder(RANKS, public_tokenizers.PATTERN).encode(ODD)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library.encode_ordinary(t) for t in ODD]
    assert bpe.Decoder(RANKS).decode(got) == [t.encode() for t in ODD]


def test_bpe_equals_the_library_on_tables(spark, edges, library):
    for docs in (table(spark, "documents"), edges):
        rows = bpe.decode(bpe.encode(docs.select("doc_id", "text", "source"), RANKS, public_tokenizers.PATTERN), RANKS).collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(r["text"] or "")
            assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_bpe_replaces_columns_of_its_names(spark, library):
    docs = spark.createDataFrame([(1, "a b, cé", "x", "y"), (2, None, None, None)], "doc_id long, text string, ids string, decoded string")
    for decoded in (bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS),
                    bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True)):
        first, second = decoded.orderBy("doc_id").collect()
        assert decoded.columns == ["doc_id", "text", "ids", "decoded"] and bytes(second["ids"]) == bytes(second["decoded"]) == b""
        assert np.frombuffer(first["ids"], "<u4").tolist() == library.encode_ordinary("a b, cé") and bytes(first["decoded"]).decode() == "a b, cé"
    assert bpe.query(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_long_words_merge_by_the_same_rule(library):
    known = bpe.ranks(RANKS)
    rng = np.random.default_rng(3)
    for n in (2, 50, 399, 400, 401, 1500):
        word = bytes(rng.choice(list(b"theing aon"), n).tolist()).replace(b" ", b"e")
        assert bpe.merged_by_heap(word, known) == library._encode_single_piece(word) or word in known


# --- 2 URL filters ----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def url_model(spark):
    return url_filter.fit(url_filter.labelled(spark))


def test_url_parts_rules_and_method(spark, url_model):
    cases = {
        "http://A.Example.NET/en/1?x": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://badexample.net": ("badexample.net", "", None, "allow"),  # an empty path starts with no rule's path
        "http://m.x.example.com/de/1": ("m.x.example.com", "/de/1", "example.com/de/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
        "ftp://q.org/fr/a#b": ("q.org", "/fr/a", "org/fr/", "allow"),
        "http://news.example.org?p=/fr/": ("news.example.org", "", None, "allow"),
        "http://casino-win.example.com/en/9": ("casino-win.example.com", "/en/9", None, "block"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), "://": ("", "", None, "allow"),
        "http://É.example.org/EN": ("É.example.org", "/EN", None, None),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*cases, None])], "page_id long, url string, host string")
    got = {r["row"]["url"]: r for r in url_filter.judged(pages, url_model).collect()}
    for url, (host, path, rule, verdict) in cases.items():
        r = got[url]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert verdict is None or r["verdict"] == verdict, url
    assert (got[None]["host"], got[None]["path"], got[None]["verdict"]) == ("", "", "allow")
    assert url_filter.judged(pages.limit(0), url_model).count() == 0


def test_url_method_on_addresses_it_has_not_seen(spark, url_model):
    bad = ["http://casino-jackpots.example.org/en/4", "http://cheap-pills-shop.example.com/fr/1", "http://adult-video-chat.example.com/en/2"]
    good = ["http://botany.example.org/en/4", "http://library-news.example.com/fr/1", "http://www.weather-maps.example.com/en/2"]
    pages = spark.createDataFrame([(u,) for u in bad + good], "url string")
    got = {r["row"]["url"]: r["verdict"] for r in url_filter.judged(pages, url_model).collect()}
    assert [got[u] for u in bad + good] == ["block"] * 3 + ["allow"] * 3


# --- 3 mixing ---------------------------------------------------------------------------------------

def test_mix_takes_the_targets_and_twice_at_most(spark, edges):
    for docs in (table(spark, "documents"), edges):
        first, again = (sorted(map(tuple, mixing.query(docs).collect()), key=repr) for _ in range(2))
        assert first == again and len(first) == docs.count()
        per_source = mixing.taken(docs).groupBy("source").agg(
            F.sum("size").alias("size"), F.max("source_size").alias("source_size"), F.max("target").alias("target"),
            F.sum("taken").alias("taken")).collect()
        for r in per_source:
            assert r["size"] == r["source_size"] and r["taken"] == math.floor(r["target"]) <= 2 * r["size"]
        assert sum(r["target"] for r in per_source) == pytest.approx(1.5 * sum(r["size"] for r in per_source))
        assert all(taken <= 2 * size for _, size, _, _, taken, *_ in first)


def test_mix_is_the_schedule(spark):
    docs = table(spark, "documents")
    pieces = mixing.mix(docs, block=256).collect()
    per_turn = Counter()
    for p in pieces:
        per_turn[p["turn"]] += p["last_word"] - p["first_word"] + 1
    assert max(per_turn.values()) <= 256 and len({p["source"] for p in pieces if p["turn"] < 60}) > 5
    taken = Counter()
    for p in pieces:
        taken[p["doc_id"]] += p["last_word"] - p["first_word"] + 1
    assert taken == Counter({r["doc_id"]: r["taken"] for r in mixing.taken(docs, block=256).collect() if r["taken"]})


def test_ranks_of_turns_by_counting(spark):
    sources = spark.createDataFrame([(1, 5000), (2, 300), (3, 9000)], "sid long, words long")
    turns = sorted((r["turn"], r["sid"], r["rank"]) for r in mixing.schedule(sources, 10).collect())
    seen = Counter()
    for _, sid, rank in turns:
        assert rank == seen[sid]
        seen[sid] += 1
    assert seen == {1: 500, 2: 30, 3: 900}


def test_mix_of_nothing(nothing):
    assert mixing.query(nothing).count() == 0 and mixing.repeated(nothing).count() == 0


def test_copies_by_row_in_order_of_turns(spark):
    """Rows that share an id, or have none, are counted by source and text; copies come in the order of turns."""
    rows = [(i % 7 if i % 5 else None, "abc"[i % 3], prose(20 + 13 * i, 1000 * i)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    taken = mixing.taken(docs, block=64).collect()
    key = {(i, s, len(words(t))): t for i, s, t in rows}
    assert len(key) == len(rows) == len(taken)
    turns = {key[r["doc_id"], r["source"], r["size"]]: [
        r["first_turn"], r["second_turn"] if r["second_turn"] is not None else r["first_turn"]][:int(r["taken"] / r["size"] + 0.5)]
        for r in taken}
    got = [r["text"] for r in mixing.repeated(docs, block=64).collect()]
    assert Counter(got) == Counter({t: len(n) for t, n in turns.items() if n})
    seen, order = Counter(), []
    for t in got:
        order.append(turns[t][seen[t]])
        seen[t] += 1
    assert order == sorted(order) and len(set(order)) > 50


def test_repeated_keeps_columns(edges):
    got = mixing.repeated(edges)
    assert got.columns == edges.columns and 0 < got.count() <= 2 * edges.count()


# --- 4 licences -------------------------------------------------------------------------------------

def test_licences(spark, edges, nothing):
    model = licences.fit(spark)
    lines = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
             "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "All rights reserved.": "proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "GPL",
             "The driver lost a license while the public was at work.": None, "A plain line of words.": None}
    text = "\n".join(lines)
    docs = spark.createDataFrame([(1, text), (2, None), (None, "x\nAll rights reserved.")], "doc_id long, text string")
    got = {(r["doc_id"], r["paragraph"]): (r["family"], r["confirmed"]) for r in licences.scan(docs, model).collect()}
    wanted = {(1, i + 1): (f, True) for i, f in enumerate(lines.values()) if f} | {(None, 2): ("proprietary", True)}
    assert {k: v for k, v in got.items() if v[1]} == wanted
    assert licences.scan(nothing, model).count() == 0 and licences.scan(edges, model).count() == 0
    found = licences.scan(table(spark, "documents"), model).where("confirmed").select("text").collect()
    planted = table(spark, "documents").select(F.explode(F.split("text", "\n")).alias("line")).where(
        F.col("line").rlike("^(Licensed under|Released under the MIT|All rights reserved|This work is licensed)")).count()
    assert len(found) == planted


def test_every_notice_is_confirmed(spark):
    lines = [(family, line) for family, notices in licences.NOTICES.items() if family != licences.UNKNOWN
             for line in notices.split("\n")]
    docs = spark.createDataFrame([(i, line) for i, (_, line) in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"]: (r["family"], r["similarity"], r["confirmed"]) for r in licences.scan(docs, licences.fit(spark)).collect()}
    assert got == {i: (family, 1.0, True) for i, (family, _) in enumerate(lines)}


# --- 5 token files ----------------------------------------------------------------------------------

def test_token_files_round_trip(spark, edges, tmp_path):
    library = Tokenizer.from_file(BYTE_BPE)
    marks = spark.createDataFrame([(1, "a  <|endoftext|> b"), (2, "<|endoftext|>"), (3, "x<|endoftext|>y <|endoftext|>\n\n z"), (4, "<|endoftext")],
                                  "doc_id long, text string")
    for name, docs in (("t", table(spark, "documents")), ("e", edges), ("s", marks)):
        token_files.write(docs, str(tmp_path / name), BYTE_BPE)
        got = token_files.read(spark, str(tmp_path / name)).orderBy("start").collect()
        order = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy(
            F.asc_nulls_first("doc_id"), F.md5(F.coalesce("text", F.lit("")))).collect()
        start = 0
        assert len(got) == len(order)
        for r, want in zip(got, order):
            ids = library.encode(want["text"], add_special_tokens=False).ids + [token_files.END_ID]
            assert (r["doc_id"], r["start"], r["n_tokens"]) == (want["doc_id"], start, len(ids))
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids
            start += len(ids)


def test_parts_are_told_apart(monkeypatch):
    """Parts longer than the key, with marks, and whose hashes are equal."""
    library, rng = Tokenizer.from_file(BYTE_BPE), np.random.default_rng(0)
    letters = list("ab.,é \n9%' \u3000<\x00日")
    texts = [*ODD, " ".join(["q" * n + m for n in (31, 32, 33, 1) for m in ("", ",", ".5", "..")]), "a a\x00 . , x. é! ', 9."]
    texts += ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(300)]
    for mixer in (token_files.MIXER, np.uint64(1 << 60)):
        monkeypatch.setattr(token_files, "MIXER", mixer)
        encoder = token_files.PartEncoder(BYTE_BPE)
        for some in (texts, texts[::-1]):
            got = [np.frombuffer(g, "<u4").tolist() for g in encoder.encode(some)]
            assert got == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_cost_of_a_text_does_not_grow_with_the_parts_met():
    def seconds(encoder):
        encoder.encode(["one two three, four"])
        begin = time.process_time()
        for _ in range(50):
            encoder.encode(["one two three, four"])
        return time.process_time() - begin

    full = token_files.PartEncoder(BYTE_BPE)
    full.encode([" ".join(f"w{i:x}" for i in range(100_000))])
    assert seconds(full) < 5 * seconds(token_files.PartEncoder(BYTE_BPE)) + 0.05


def test_token_files_of_nothing(nothing, spark, tmp_path):
    token_files.write(nothing, str(tmp_path / "n"), BYTE_BPE)
    assert token_files.read(spark, str(tmp_path / "n")).count() == 0


def test_re_pair_and_random_access():
    rng = np.random.default_rng(5)
    for ids in ([], [7], [1] * 1001, [1, 2] * 500, rng.integers(0, 12, 4000).tolist(), (rng.zipf(1.5, 4000) % 300).tolist()):
        flat = np.array(ids, dtype="<u4")
        symbols, rules = token_files.re_pair(flat, 1000, min_count=3)
        assert len(symbols) < max(2, len(ids)) or len(set(ids)) > 100
        assert token_files.expand(symbols, rules, 1000).tolist() == ids
        lengths = token_files.rule_lengths(rules, 1000)
        assert [len(token_files.expand(np.array([1000 + k]), rules, 1000)) for k in range(len(rules))] == lengths.tolist()
    docs = [rng.integers(0, 4, n).astype("<u4").tobytes() for n in (0, 1, 700, 3, 0, 2500)]
    shard = token_files.Shard(token_files.pack([5, None, 7, 8, 9, 10], docs))
    assert shard.doc_ids == [5, None, 7, 8, 9, 10] and len(shard.rules) > 0
    assert [shard.document(k).tobytes() for k in range(6)] == docs == [d.tobytes() for d in shard.documents()]


# --- 6 quality --------------------------------------------------------------------------------------

def test_quality_edges(edges, nothing):
    got = quality.judged(edges).collect()
    assert len(got) == len(EDGES)
    for r in got:
        w = words(r["row"]["text"])
        assert (r["n_words"], r["word_chars"]) == (len(w), sum(map(len, w)))
        windows = Counter(zip(w, w[1:], w[2:]))
        again = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
        assert r["n_repeat_words"] == len(again)
        assert r["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w))
    kept = quality.keep(edges)
    assert kept.columns == edges.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 9, None}
    assert quality.query(nothing).count() == 0 and quality.keep(nothing).count() == 0


# --- 7 near-duplicates ------------------------------------------------------------------------------

def brute_classes(texts, idf):
    """By doc_id: the least id of the component, over all pairs."""
    hashed = near_dup.WordHashes()
    runs = {i: near_dup.weighted_runs(hashed.of([t])[0], idf) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if texts[a] == texts[b] or len(runs[a][0]) and near_dup.similarity(runs[a], runs[b]) >= near_dup.THRESHOLD:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_word_hashes_follow_the_word_alone(monkeypatch):
    """Whatever stands around a word and wherever pieces are cut; words longer than a piece included."""
    monkeypatch.setattr(near_dup, "PIECE", 64)
    rng = np.random.default_rng(3)
    vocabulary = ["a", "b", "ab", "ba", "é", "日本語", "x\u00a0y", "\u3000", "\x1f", "w" * 63, "w" * 64, "w" * 65, "w" * 500, "\0", "\0\0"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t\t", "\r\n "]) for _ in range(rng.integers(0, 40))) for _ in range(200)]
    texts += [None, "", "  ", " a", *vocabulary]
    hashes, known = near_dup.WordHashes(), {}
    for text, found in zip(texts, hashes.of(texts), strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert len(words) == len(found)
        assert all(known.setdefault(w, int(h)) == int(h) for w, h in zip(words, found))
    assert len(set(known.values())) == len(known) == len(vocabulary)
    assert hashes.of([]) == []


def test_near_duplicates_equal_all_pairs(spark):
    docs = table(spark, "documents")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r["class_id"] for r in near_dup.query(docs).collect()}
    assert got == brute_classes(texts, near_dup.inverse_frequencies(docs))


def test_near_duplicates_across_chunks(spark, monkeypatch):
    """Many variants of a text in small chunks, so that links across chunks decide."""
    monkeypatch.setattr(near_dup, "CHUNK", 4)
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(60):
        w = list(base)
        for at in rng.choice(150, rng.integers(0, 9), replace=False):
            w[at] = f"x{i}_{at}"
        texts[i] = " ".join(w)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["class_id"] for r in near_dup.query(docs).collect()}
    wanted = brute_classes(texts, near_dup.inverse_frequencies(docs))
    assert sum(got[i] != wanted[i] for i in texts) <= 1  # the bands find a link with near certainty only


def test_near_duplicate_edges(edges, nothing):
    got = {(r["doc_id"], r["class_id"]) for r in near_dup.query(edges).collect()}
    assert {(4, 4), (5, 4), (6, 4), (1, 1), (2, 1), (None, 1), (None, None), (3, 3), (7, 7), (9, 9)} <= got
    kept = near_dup.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 7, 8, 9, 10]
    assert near_dup.query(nothing).count() == 0 and near_dup.keep_one(nothing).count() == 0


# --- 8 language model -------------------------------------------------------------------------------

@pytest.mark.parametrize("top", [0, 200_000])
def test_lm_base_columns(spark, edges, monkeypatch, top):
    monkeypatch.setattr(causal_lm, "TOP", max(1, top))
    docs = edges if top else table(spark, "documents")
    rows = docs.select("doc_id", "text").collect()
    split = lambda t: (t or "").encode().lower().split()
    learned = [split(r["text"]) for r in rows if not is_held(r["doc_id"], 10)]
    count = Counter(w for ws in learned for w in ws)
    n, v = sum(count.values()) + len(learned), len(count) + 1
    share = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    wanted = sorted((r["doc_id"] if r["doc_id"] is not None else -1, len(split(r["text"])) + 1,
                     1 + sum(count[w] > 0 for w in split(r["text"])), n,
                     round(share(len(learned)) + sum(share(count[w]) for w in split(r["text"])), 4)) for r in rows)
    got = causal_lm.query(docs, BYTE_BPE).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 4)) for r in got) == wanted
    assert all(r["held_out"] == is_held(r["doc_id"], 10) and math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_lm_learns_from_every_training_document(spark, edges, monkeypatch):
    seen, trained = [], causal_lm._trained

    def spied(docs, flat, *rest):
        seen.extend(r["text"] for r in docs.collect())
        out = trained(docs, flat, *rest)
        moved.append(not np.array_equal(out, flat))
        return out

    monkeypatch.setattr(causal_lm, "_trained", spied)
    for docs in (edges, table(spark, "documents")):
        seen.clear()
        moved = []
        causal_lm.query(docs, BYTE_BPE)
        assert sorted(seen) == sorted(r["text"] or "" for r in docs.collect() if not is_held(r["doc_id"], 10))
        assert any(moved)


def test_lm_held_out_likelihood(spark, monkeypatch):
    """Training raises the probability of documents it has not seen, and the score is above the unigram's."""
    docs = table(spark, "documents")

    def held():
        row = causal_lm.query(docs, BYTE_BPE).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        return tuple(row)

    score, base = held()
    monkeypatch.setattr(causal_lm, "_trained", lambda docs, flat, *rest: flat)
    assert score > held()[0] and score > base


def test_lm_of_nothing(nothing):
    assert causal_lm.query(nothing, BYTE_BPE).count() == 0


def test_windows_score_each_id_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(1, 9, n).astype(np.uint8) for n in (1, 31, 32, 33, 56, 57, 300)]
    ids, targets, keep, text = causal_lm.windows(texts)
    assert targets[keep].tolist() == np.concatenate(texts).tolist()
    flat = [np.append(causal_lm.END, t[:-1]) for t in texts]
    assert ids[keep].tolist() == np.concatenate(flat).tolist()


def small_model(monkeypatch, scale=2):
    """Five single ids and eleven groups of sixteen; every weight of the model away from its start."""
    monkeypatch.setattr(causal_lm, "SINGLES", 4)
    monkeypatch.setattr(causal_lm, "SIDE", 16)
    rng = np.random.default_rng(2)
    flat = causal_lm.Model.start(np.full((16, 16), 1 / 16), rng.normal(0, 1, (11, 16))) * np.float32(scale)
    return flat + rng.normal(0, 0.1, len(flat)).astype(np.float32)


def test_attention_gradient(monkeypatch):
    flat = small_model(monkeypatch)
    ids, targets, keep, _ = causal_lm.windows([np.random.default_rng(2).integers(0, 5 + 11 * 16, 90).astype(np.int32)])
    loss = lambda f: -causal_lm.Model(f, 11).scores(ids, targets, keep).astype(np.float64).sum()
    found = causal_lm.Model(np.zeros_like(flat), 11)
    for name, (rows, g) in causal_lm.Model(flat, 11).gradient(ids, targets, keep).items():
        (found.inner if name == "inner" else found.p[name])[slice(None) if rows is None else rows] += g
    gradient = np.concatenate([found.p[n].ravel() for n in found.shapes(11)])
    at = 0
    for shape in found.shapes(11).values():
        size = int(np.prod(shape))
        most = at + np.argsort(-np.abs(gradient[at:at + size]))[:4]
        for i in [*most, *np.random.default_rng(4).integers(at, at + size, 3)]:
            step = np.zeros_like(flat)
            step[i] = 1e-2
            assert (loss(flat + step) - loss(flat - step)) / 2e-2 == pytest.approx(gradient[i], abs=2e-2, rel=1e-2)
        at += size
    changed = ids.copy()
    changed[:, 20:] = (changed[:, 20:] + 1) % 8
    early = np.zeros_like(keep)
    early[:, :20] = keep[:, :20]
    model = causal_lm.Model(flat, 11)
    assert np.allclose(model.scores(ids, targets, early), model.scores(changed, targets, early))  # causal


def test_attention_scores_sum_to_one(monkeypatch):
    """Over all ids, at every place of a window."""
    model = causal_lm.Model(small_model(monkeypatch), 11)
    ids = np.random.default_rng(3).integers(0, 5 + 11 * 16, (1, causal_lm.WINDOW)).astype(np.int64)
    total = sum(np.exp(model.scores(ids, np.full_like(ids, t), np.ones(ids.shape, bool))) for t in range(5 + 11 * 16))
    assert np.allclose(total, 1, atol=1e-4)


@pytest.mark.parametrize("scale", [1, 40])
def test_softmax_in_pieces_and_with_large_exponents(monkeypatch, scale):
    """Scores and gradients do not depend on how many rows are taken at once, nor on whether exponents are raised as they are."""
    flat = small_model(monkeypatch)
    texts = [np.random.default_rng(k).integers(0, 5 + 11 * 16, n).astype(np.int32) for k, n in enumerate((1, 90, 33, 260))]
    ids, targets, keep, _ = causal_lm.windows(texts)
    model = causal_lm.Model(flat, 11)
    model.p["out"] *= scale  # at 40 some exponents are far above SAFE
    model.p["inner"] *= scale
    found = []
    for piece, safe in ((7, causal_lm.SAFE), (10_000, causal_lm.SAFE), (7, -1)):
        monkeypatch.setattr(causal_lm, "PIECE", piece)
        monkeypatch.setattr(causal_lm, "SAFE", safe)
        fresh = causal_lm.Model(flat, 11)
        found.append((fresh.scores(ids, targets, keep), fresh.gradient(ids, targets, keep)))
    h, p = model.hidden(ids)[0][keep].astype(np.float64), {n: z.astype(np.float64) for n, z in model.p.items()}
    t, before = targets[keep], causal_lm.class_of(ids[keep])
    z = h @ p["out"].T + p["pair"][before]
    wanted = z[np.arange(len(t)), causal_lm.class_of(t)] - np.logaddexp.reduce(z, axis=1)
    for i in np.flatnonzero(t > 4):
        g, slot = divmod(t[i] - 5, 16)
        z = p["inner"][16 * g:16 * g + 16] @ h[i] + p["bias"][g]
        wanted[i] += z[slot] - np.logaddexp.reduce(z)
    for scores, gradient in found:
        assert np.allclose(scores, wanted, rtol=1e-4, atol=1e-3)
        for name, (rows, g) in gradient.items():
            assert np.array_equal(rows, found[0][1][name][0]) if rows is not None else found[0][1][name][0] is None
            assert np.allclose(g, found[0][1][name][1], rtol=1e-3, atol=1e-3 * scale)


def test_learner_counts_the_batches_of_each_row(monkeypatch):
    """One number for each row or group, and the changes carry it for all their weights."""
    flat = small_model(monkeypatch)
    learner = causal_lm.Learner(flat, 11)
    assert sum(n.size for n in learner.used.values()) < len(flat) / 8
    texts = [np.array([3, 9, 9, 40], dtype=np.int32), np.array([3, 7], dtype=np.int32)]
    for text in texts:
        learner.step(*causal_lm.windows([text])[:3])
    got = learner.changes().set_index("at")["n"]
    wanted, at = {}, 0
    before = [{0, *t.tolist()[:-1]} for t in texts]  # a window's places behind the text repeat one of them
    for name, shape in causal_lm.Model.shapes(11).items():
        for row in range(shape[0]):
            if name == "emb":
                n = sum(row in x for x in before)
            elif name == "pair":
                n = sum(row in causal_lm.class_of(np.array([*x])) for x in before)
            elif name in ("inner", "bias"):
                group = row // 16 if name == "inner" else row
                n = sum(any(c > 4 and (c - 5) // 16 == group for c in t.tolist()) for t in texts)
            else:
                n = 2
            wanted |= {(at + row * shape[1]) // 16 + k: n for k in range(shape[1] // 16) if n}
        at += shape[0] * shape[1]
    assert got.to_dict() == wanted


def test_common_words_stay_known_when_the_store_is_full(monkeypatch):
    """They are met first; a store that begins with nothing would cut them again and again."""
    monkeypatch.setattr(causal_lm, "CACHED_WORDS", 200)
    monkeypatch.setattr(causal_lm, "_subwords", {})
    worker, cut = causal_lm.subwords(BYTE_BPE), []
    monkeypatch.setattr(worker, "of", lambda some, of=worker.of: cut.extend(some) or of(some))
    library = Tokenizer.from_file(BYTE_BPE)
    classes = causal_lm.Classes(np.ones(worker.size), 7, worker.spaced)
    known = causal_lm.WordCodes(BYTE_BPE, classes)
    common = [f"common{k}".encode() for k in range(60)]
    for turn in range(12):
        some = [*common, *(f"rare{turn}x{k}".encode() for k in range(50 if turn else 0))]
        known.learn(set(some))
        codes = known.texts([some, some[::3]])[1]
        wanted = [classes.code[library.encode(" " + w.decode(), add_special_tokens=False).ids].tolist() for w in some]
        assert [c.tolist() for c in codes] == [[*sum(part, []), causal_lm.END] for part in (wanted, wanted[::3])]
        assert len(worker.number) <= 200 and list(worker.number) == worker.words
    assert sum(w.startswith(b"common") for w in cut) == 60


def test_counted_words_with_their_ids(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    words = ["the", "house,", "日本語", "a" * 300, "naïve.", "x1;"]
    counts = causal_lm.with_ids(spark.createDataFrame([(w.encode(), 3 + k) for k, w in enumerate(words)], "word binary, n long"), BYTE_BPE)
    ids = {w: library.encode(" " + w, add_special_tokens=False).ids for w in words}
    assert {bytes(r["word"]).decode(): np.frombuffer(r["ids"], "<i4").tolist() for r in counts.collect()} == ids
    wanted = Counter()
    for k, w in enumerate(words):
        for i in ids[w]:
            wanted[i] += 3 + k
    assert {r["id"]: r["n"] for r in causal_lm.id_counts(counts, causal_lm.subwords(BYTE_BPE).size).collect()} == wanted


def test_words_are_cut_once_for_all_tasks_of_a_worker(monkeypatch):
    """And their codes are those of each word alone, also after the worker has begun anew."""
    words = [sorted({f"{a}{b}{m}".encode() for a in ("ab", "é", "x1", "日本", "-") for b in range(20 * k, 20 * k + 20) for m in ("", ",", "..")})
             for k in range(5)]
    counts = np.random.default_rng(1).integers(0, 50, 60_000)[:causal_lm.subwords(BYTE_BPE).size].astype(float)
    classes, shares = causal_lm.Classes(counts, 7, causal_lm.subwords(BYTE_BPE).spaced), {w: 1.0 * k for k, w in enumerate(words[0])}
    library, cut = Tokenizer.from_file(BYTE_BPE), []
    for most in (1_000, 700):
        monkeypatch.setattr(causal_lm, "CACHED_WORDS", most)
        monkeypatch.setattr(causal_lm, "_subwords", {})
        worker = causal_lm.subwords(BYTE_BPE)
        monkeypatch.setattr(worker, "of", lambda some, of=worker.of: cut.extend(some) or of(some))
        cut.clear()
        for _ in range(3):  # tasks
            known = causal_lm.WordCodes(BYTE_BPE, classes, shares)
            for some in words[:3]:
                known.learn(set(some))
                number, codes = known.texts([some, some[::2]])
                wanted = [classes.code[library.encode(" " + w.decode(), add_special_tokens=False).ids].tolist() for w in some]
                assert [c.tolist() for c in codes] == [[*sum(part, []), causal_lm.END] for part in (wanted, wanted[::2])]
                assert np.array_equal(known.shares_of(number), [shares.get(w, np.nan) for w in some + some[::2]], equal_nan=True)
        assert len(worker.number) <= most
        assert most < 1_000 or len(cut) == len({w for some in words[:3] for w in some})


def test_ids_are_told_apart():
    """Every id has a code of its own, inside a group of its class."""
    counts = np.random.default_rng(1).integers(0, 50, 3000).astype(float)
    classes = causal_lm.Classes(counts, 7, np.arange(3000) % 3 == 0)
    assert len(set(classes.code)) == 3000 and classes.code.min() == 1
    assert classes.code.max() <= causal_lm.SINGLES + classes.groups * causal_lm.SIDE and classes.of.max() < classes.n
    for g in range(classes.groups):
        spaced = (np.arange(3000) % 3 == 0)[classes.of == 1 + causal_lm.SINGLES + g]
        assert len(set(spaced)) <= 1
    assert np.allclose(np.exp(classes.bias).sum(1), 1) and np.isclose(classes.frequency.sum(), 1)


def test_lm_scores_by_brute_force(spark, monkeypatch):
    """Each text by its own: every id by a softmax over the whole vocabulary, in the one window that reaches it."""
    kept, scored = [], causal_lm._scored
    monkeypatch.setattr(causal_lm, "_scored", lambda *a: kept.append(a) or scored(*a))
    monkeypatch.setattr(causal_lm, "TOP", 300)  # most words come by the join
    docs = table(spark, "documents").where("length(text) < 4000").limit(40)
    rows = docs.select("doc_id", "text").collect()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in causal_lm.query(docs, BYTE_BPE).collect()}
    flat, classes, path, _, _ = kept[0]
    p, codes = causal_lm.Model(flat, classes.groups).p, causal_lm.WordCodes(path, classes)
    split = lambda t: (t or "").encode().lower().split()
    learned = [split(r["text"]) for r in rows if not is_held(r["doc_id"], 10)]
    count = Counter(w for ws in learned for w in ws)
    n, v = sum(count.values()) + len(learned), len(count) + 1
    share = lambda c: (c + 0.1) / (n + 0.1 * (v + 1))
    width, single = causal_lm.WIDTH, causal_lm.SINGLES

    def chance(before, target):
        x = p["emb"][before] + p["pos"][:len(before)]
        q, k = (np.clip(x @ p[z], -2 / s, 2 / s) for z, s in (("q", width ** -0.5), ("k", 1)))
        a = np.exp((k @ q[-1]) * width ** -0.5)
        h = x[-1] + (a / a.sum()) @ (x @ p["v"])
        own = lambda c: c if c <= single else 1 + single + (c - 1 - single) // causal_lm.SIDE
        z = p["out"] @ h + p["pair"][own(before[-1])]
        found = z[own(target)] - np.log(np.exp(z).sum())
        if target > single:
            g, slot = divmod(target - 1 - single, causal_lm.SIDE)
            z = p["inner"][g * causal_lm.SIDE:(g + 1) * causal_lm.SIDE] @ h + p["bias"][g]
            found += z[slot] - np.log(np.exp(z).sum())
        return float(found)

    for r in rows[:12]:
        words = split(r["text"])
        codes.learn(set(words))
        parts = [codes.ids[codes.start[i]:][:codes.length[i]].tolist() for i in (codes.number[w] for w in words)] + [[0]]
        text, wanted, place = [0, *(c for part in parts for c in part)], 0.0, 0
        for part, seen in zip(parts, [*(count[w] for w in words), len(learned)]):
            log = 0.0
            for c in part:
                nth = max(0, -(-(place + 1 - causal_lm.WINDOW) // causal_lm.STRIDE))
                log += chance(np.array(text[nth * causal_lm.STRIDE:place + 1]), c)
                place += 1
            wanted += math.log10(causal_lm.MIX * math.exp(log) + (1 - causal_lm.MIX) * share(seen))
        assert got[r["doc_id"]] == pytest.approx(wanted, rel=1e-4)


# --- 9 exact top-k ----------------------------------------------------------------------------------

def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "QUERIES_PER_CHUNK", 7)
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 60)
    rng = np.random.default_rng(0)
    vectors = [rng.normal(0, 1, 6).round(1).tolist() for _ in range(400)] + [[1.0] * 6] * 150
    vectors += [None, [1.0, None, 2.0], [float("nan")] * 6, [float("inf")] * 6, [], [0.5, -0.5], [1e12] * 6]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(None, [1.0] * 6, "x"), (3, vectors[3], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, grp string").repartition(5)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in knn.query(df).collect())
    part = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    wanted = []
    for i, q in {(i, tuple(v)) for i, v in part if i % 50 == 0}:
        found = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), j) for j, v in part if j != i)[:5]
        wanted += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    assert got == sorted(wanted)


def test_top_k_of_ids_that_repeat(spark, monkeypatch):
    """A queried id more often than k, in one group of its own or in several: its rows bound nothing."""
    far = [[256 * x for x in v] for v in ([90, 0], [0, 90])]
    monkeypatch.setattr(knn, "_pivots", lambda data, rows, width: np.array([[0, 0], *far], dtype=np.float64))
    rows = [(i, [i / 64, 1.0]) for i in range(1, 40)] + [(50, [90.0, 0.0])] * 8 + [(100, [0.0, 90.0])] * 7 + [(100, [90.0, 1.0])] * 7
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in knn.query(df).collect())
    part = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows]
    wanted = []
    for i, q in {(i, v) for i, v in part if i % 50 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in part if j != i)[:5]
        wanted += [(i, k + 1, j, -s) for k, (s, j) in enumerate(found)]
    assert got == sorted(wanted)
    alone = df.where("vec_id <> 100")
    assert sorted(r["vec_id"] for r in knn.query(alone).collect()) == [35, 36, 37, 38, 39]


def test_cells_hold_what_a_chunk_needs(spark, monkeypatch):
    """One id holds a third of all rows: its rows fill several cells, and a chunk has no more cells than it needs."""
    monkeypatch.setattr(knn, "ROWS_PER_CELL", 50)
    rows = spark.range(900).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("id"), F.array(F.lit(1)).alias("v"),
                                   (F.col("id") % 3).cast("int").alias("grp"), F.col("id").cast("double").alias("dist"),
                                   F.col("id").alias("nth"))
    wanted = spark.createDataFrame([(0, 0, -1.0), (0, 1, -1.0), (1, 2, 870.0), (2, 1, 5000.0)], "chunk long, grp int, least double")
    copied, cells = knn._copied(rows, wanted)
    assert {r["chunk"]: r["cells"] for r in cells.collect()} == {0: 12, 1: 1}
    sizes = [r["count"] for r in copied.groupBy("chunk", "cell").count().collect()]
    assert sum(sizes) == 610 and max(sizes) <= 100
    hot = copied.where("chunk = 0 AND id = 7").groupBy("cell").count().collect()
    assert len(hot) > 8


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (50, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, knn.query(df).select("query_id", "rank", "vec_id", "score").collect()))
    assert got == [(0, 1, 50, 5 * 65536), (50, 1, 0, 5 * 65536)]
    assert knn.query(df.limit(0)).count() == 0 and knn.query(df.where("vec_id = 0")).count() == 0


# --- 10 toxicity ------------------------------------------------------------------------------------

def test_toxicity_learns_from_positives_and_unlabelled(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"word{i}" for i in range(300)]
    insults = ["idiota", "moronic", "scummy"]
    docs, labels = [], []
    for i in range(1200):
        w = rng.choice(vocabulary, 60).tolist()
        toxic = bool(rng.random() < 0.15)
        if toxic:
            w[int(rng.integers(60))] = str(rng.choice(insults))
        docs.append((i, " ".join(w), "x"))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
        docs[-1] += (toxic,)
    truth = {d[0]: d[3] for d in docs}
    df = spark.createDataFrame([d[:3] for d in docs], "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels + [(labels[0][0], 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.query(df, marks).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if is_held(i, 5)}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    kept = toxicity.keep(df, marks)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if not r["predicted"]}


def test_toxicity_threshold_tells_labelled_texts_apart():
    assert toxicity.offset(np.array([3.0, 2.0]), np.array([-1.0, 0.0])) == 1.0
    assert 0.0 < toxicity.offset(np.array([1.0, 2.0, -5.0]), np.array([0.0, -6.0, -7.0])) < 1.0
    assert toxicity.offset(np.array([1.0]), np.array([1.0])) in (0.0, 1.0, 2.0)


@pytest.mark.parametrize("share", [0.03, 0.3])
def test_toxicity_sample_is_bounded_by_texts(spark, monkeypatch, share):
    """An id and a text that make up a third of all rows take one place each in the sample."""
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 400)
    monkeypatch.setattr(toxicity, "MAX_POSITIVES", 60)
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 500, 40)) + (" scummy" if i % 100 < 100 * share else "")) for i in range(1500)]
    hot = [(1, f"copy {k} of scummy") for k in range(700)] + [(2, "one text " * 9)] * 700
    docs = spark.createDataFrame(rows + hot, "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, 1, int(i % 100 < 100 * share)) for i in range(0, 1500, 3)], "doc_id long, quality int, toxic int")
    feats, _ = toxicity.sampled(docs, marks, 5)
    sizes = {r["part"]: r["count"] for r in feats.groupBy("part").count().collect()}
    assert sizes[toxicity.POSITIVE] < 110 and sizes[toxicity.UNLABELLED] < 520
    got = {(r["doc_id"], r["predicted"]) for r in toxicity.query(docs, marks).where("held_out").collect()}
    truth = {(i, int("scummy" in t)) for i, t in rows if is_held(i, 5)}
    assert len(got - truth) < 0.05 * len(truth)


def test_toxicity_edges(spark, edges, nothing):
    marks = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (None, 1, 1), (9, 0, None)], "doc_id long, quality int, toxic int")
    assert len(toxicity.query(edges, marks).collect()) == len(EDGES)
    no_marks = marks.limit(0)
    assert {r["score"] for r in toxicity.query(edges, no_marks).collect()} == {0.0}
    assert toxicity.query(nothing, marks).count() == 0 and toxicity.keep(nothing, marks).count() == 0


def test_prose_has_no_repeats():
    assert len(set(prose(50).split())) > 40
