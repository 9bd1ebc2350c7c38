"""Counts of every prefix against the tokenizers library."""

import os
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sitewell.llm import token_counts

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATH = public_tokenizers.path("byte_bpe_50k.json")

ODD = ["", "a", "  a  b ", "a\n\n b", "\n \n x", "x \x1cy \x85z q  ", "'s it's IT'S 're x'll 'll y've", " \t tab",
       "日本語 テキスト ñandú", "a" * 90 + " " + "ab" * 70, " " * 70 + "x", "x" + " " * 70, "<|endoftext|> hi", "<|endoftext|>",
       "foo <|endoftext|> bar<|endoftext|><|endoftext|>\n 'll  ", "1234567 89.5%%% !!  ...", "a \n", "tail ",
       "\r\n\r\nx  \r\n y", "\x00 a\x00", " nb sp 　 wide", "hello world hell", "𝕏😀 emoji👍🏽 café"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_every_prefix_of_odd_texts(library):
    rng = random.Random(3)
    letters = "ab eth'slvrd \n\t.,!0 1é日\x85 \x1c"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(300)]
    count = token_counts.PrefixCounter(PATH)
    for text in texts:
        assert count.counts(text).tolist() == lengths(library, [text[:i + 1] for i in range(len(text))]), repr(text)


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_CHARS", 20)
    monkeypatch.setattr(token_counts, "CACHED_PAIRS", 3)
    count = token_counts.PrefixCounter(PATH)
    for text in ODD:
        assert count.counts(text).tolist() == lengths(library, [text[:i + 1] for i in range(len(text))])


def test_query_counts_whole_texts(spark, edges, nothing, library):
    special = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "word " * 2000), (2, "word " * 2000)], "doc_id long, text string")
    for docs in (spark.read.parquet(f"{FOLDER}/documents.parquet"), edges, special):
        texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
        wanted = [(i, len(t.encode()), n, n > 1024) for (i, t), n in zip(texts, lengths(library, [t for _, t in texts]))]
        got = token_counts.query(docs, PATH).collect()
        key = lambda r: tuple(map(repr, r))
        assert sorted([tuple(r)[:4] for r in got], key=key) == sorted(wanted, key=key)
        whole = {(i, len(t.encode())): t for i, t in texts}
        for r in got:
            text = whole[r["doc_id"], r["n_bytes"]]
            cut = r["limit_chars"]
            assert (cut == len(text)) == (not r["over_limit"])
            if r["over_limit"]:
                assert lengths(library, [text[:cut]])[0] <= 1024 < min(lengths(library, [text[:cut + 1], text[:cut + 9]]))
    assert token_counts.query(nothing, PATH).count() == 0


def test_questions_are_answered_from_stored_counts(spark, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(99, None, "x")], "i int, text string, n_tokens string")
    kept = token_counts.counted(docs, PATH)
    assert kept.columns == ["i", "text", "n_tokens", "prefix_counts"] and kept.count() == len(ODD) + 1
    asked = kept.select("text", F.explode(F.sequence(F.lit(-1), F.lit(12))).alias("n"), "prefix_counts").select(
        "text", "n", token_counts.count_at("prefix_counts", "n").alias("tokens"),
        token_counts.longest_within("prefix_counts", "n").alias("chars")).collect()
    for r in asked:
        text = r["text"] or ""
        counts = lengths(library, [text[:i] for i in range(len(text) + 1)])
        assert r["tokens"] == counts[max(0, min(r["n"], len(text)))]
        assert r["chars"] == max([i for i, c in enumerate(counts) if c <= r["n"]], default=0)
    none = kept.limit(1).select(token_counts.count_at("prefix_counts", F.lit(None).cast("int")).alias("a"))
    assert none.first()["a"] is None



def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.Merges(public_tokenizers.path("word_bpe_49k.json"))
