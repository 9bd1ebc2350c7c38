"""The operators' queries by name, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitewell.llm import (
    bpe, causal_lm, conversations, knn, licences, mixing, near_dup, quality, token_counts, token_files, toxicity,
    url_filter, whitening)
from sitewell.llm.common import table

# Vocabularies are read from the installed package of public tokenizers; other paths can be given to the operators.
MULTI_RANKS, BYTE_TOKENIZER = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_byte_bpe": lambda spark, folder: bpe.query(
        table(spark, folder, "documents"), public_tokenizers.path(MULTI_RANKS), public_tokenizers.PATTERN),
    "op2_url_filters": lambda spark, folder: url_filter.query(table(spark, folder, "pages")),
    "op3_source_mix": lambda spark, folder: mixing.query(table(spark, folder, "documents")),
    "op4_licence_scan": lambda spark, folder: licences.query(table(spark, folder, "documents")),
    "op5_token_files": lambda spark, folder: token_files.query(
        table(spark, folder, "documents"), public_tokenizers.path(BYTE_TOKENIZER)),
    "op6_quality_rules": lambda spark, folder: quality.query(table(spark, folder, "documents")),
    "op7_near_duplicates": lambda spark, folder: near_dup.query(table(spark, folder, "documents")),
    "op8_lm_scores": lambda spark, folder: causal_lm.query(
        table(spark, folder, "documents"), public_tokenizers.path(BYTE_TOKENIZER)),
    "op9_exact_top_k": lambda spark, folder: knn.query(table(spark, folder, "embeddings")),
    "op10_toxicity": lambda spark, folder: toxicity.query(
        table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op11_embedding_whitening": lambda spark, folder: whitening.query(table(spark, folder, "embeddings")),
    "op12_conversation_repair": lambda spark, folder: conversations.query(table(spark, folder, "conversations")),
    "op13_token_counts": lambda spark, folder: token_counts.query(
        table(spark, folder, "documents"), public_tokenizers.path(BYTE_TOKENIZER)),
}

SQL: dict[str, str] = {}

_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)

SQL["op6_quality_rules"] = rf"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
lines AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d),
per_lines AS (
    SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
windows AS (
    SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
found AS (SELECT k, i FROM (SELECT *, count(*) OVER (PARTITION BY k, g) AS n FROM windows) WHERE n > 1),
per_windows AS (
    SELECT k, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM found) GROUP BY k),
m AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop
    FROM d LEFT JOIN per_lines USING (k) LEFT JOIN per_windows USING (k)),
judged AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words
           AS base_failed
    FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 3 AND 12 AND n_symbols::DOUBLE / n_words <= 0.1
       AND n_stop::DOUBLE / n_words >= 0.02 AND n_dup_lines::DOUBLE / n_lines <= 0.5 AS kept
FROM judged
"""

# Blocks are cut out of each source's stream; a slot's rank among its source's turns names the block it draws.
SQL["op3_source_mix"] = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('mix' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents),
per AS (
    SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS sid
    FROM d GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][((sid - 1) % 3) + 1] AS w FROM per),
filling AS (
    SELECT *, (2 * s)::DOUBLE / w AS ratio,
           (1.5::DOUBLE * (sum(s) OVER ())::DOUBLE
            - coalesce(sum(2 * s) OVER (ORDER BY (2 * s)::DOUBLE / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY (2 * s)::DOUBLE / w, sid
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level
    FROM weighed),
water AS (SELECT arg_min(level, struct_pack(a := ratio, b := sid)) AS lam FROM filling WHERE ratio > level),
t AS (
    SELECT source, s, CASE WHEN lam IS NULL OR ratio <= lam THEN (2 * s)::DOUBLE ELSE lam * w END AS target
    FROM filling, water),
ends AS (
    SELECT source, floor(target)::BIGINT AS words, ceil(floor(target) / 1024)::BIGINT AS slots,
           (sum(ceil(floor(target) / 1024)) OVER (ORDER BY source NULLS LAST))::BIGINT AS high
    FROM t),
size AS (SELECT CASE WHEN max(high) > 1 THEN length(bin(max(high) - 1)) ELSE 1 END AS bits FROM ends),
slots AS (SELECT source, unnest(range(high - slots, high)) AS j FROM ends),
turns AS (
    SELECT source, list_sum([((j >> b) & 1) << (bits - 1 - b) for b in range(0, bits)])::BIGINT AS turn
    FROM slots, size),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY turn) - 1 AS rank FROM turns),
placed AS (
    SELECT d.doc_id, d.source, d.size, t.s, t.target, floor(t.target)::BIGINT AS words, row_number() OVER () AS k,
           (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id NULLS FIRST, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
passes AS (SELECT *, unnest([0, 1]) AS pass FROM placed),
pieces AS (
    SELECT k, source, pass, start + pass * s AS low, least(start + pass * s + size, words) AS high,
           unnest(range((start + pass * s) // 1024, (greatest(start + pass * s, start + pass * s + size - 1)) // 1024 + 1)) AS rank
    FROM passes),
drawn AS (
    SELECT k, pass, turn, least(high, (p.rank + 1) * 1024) - greatest(low, p.rank * 1024) AS piece
    FROM pieces p JOIN ranked r ON p.source IS NOT DISTINCT FROM r.source AND p.rank = r.rank),
sums AS (
    SELECT k, sum(piece) AS taken, count(*) AS pieces, min(turn) FILTER (pass = 0) AS first_turn,
           min(turn) FILTER (pass = 1) AS second_turn
    FROM drawn WHERE piece > 0 GROUP BY k)
SELECT doc_id, size, s AS source_size, target, coalesce(taken, 0)::BIGINT AS taken, coalesce(pieces, 0)::BIGINT AS pieces,
       first_turn, second_turn
FROM placed LEFT JOIN sums USING (k)
"""

SQL["op9_exact_top_k"] = """
WITH e AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# A best way is kept as one text, twelve digits of its cost and its edits, so that the least text is the
# cheapest way and of those the one whose edits come first.
def _led(way: str, cost: str, edit: str) -> str:
    return f"lpad((left({way}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || '{edit}' || substr({way}, 13)"


def _before_a_row(state: int) -> str:
    wanted = conversations.MOVES[state, conversations.WANTED[state]]
    ways = [_led(f"v{state}", "3", "D"), f"CASE WHEN stays THEN {_led(f'v{wanted}', '2 + late', 'R')} END"]
    ways += [f"CASE WHEN stays AND letter = '{letter}' THEN {_led(f'v{to}', 'late', 'K')} END"
             for (s, letter), to in conversations.MOVES.items() if s == state]
    return f"least({', '.join(ways)}) AS b{state}"


def _with_inserts(state: int) -> str:
    one = conversations.MOVES[state, conversations.WANTED[state]]
    two = conversations.MOVES[one, conversations.WANTED[one]]
    return f"least(b{state}, {_led(f'b{one}', '2', 'I')}, {_led(f'b{two}', '4', 'II')}) AS v{state}"


SQL["op12_conversation_repair"] = rf"""
WITH RECURSIVE keyed AS (
    SELECT coalesce(conv_id::VARCHAR, ' ') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations),
-- crc32 bit by bit: each byte is followed by eight shifts
hashed AS (
    SELECT *, xor(list_reduce(flatten(list_transform(string_split(k, ''),
               lambda x: [ord(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
               lambda acc, e: CASE WHEN e >= 0 THEN xor(acc, e) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384) ELSE acc // 2 END,
               4294967295::BIGINT), 4294967295::BIGINT) % 20 AS fate
    FROM keyed),
damaged AS (
    SELECT c, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE fate <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
marked AS (
    SELECT *, left(role, 1) AS letter, NOT regexp_matches(text, '[^ 	-
]') AS blank,
           row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen,
           NOT regexp_matches(text, '[.!?][ 	-
]*\z') AS cut
    FROM numbered),
found AS (
    SELECT c, turn, role, text, i, letter, blank, seen AND NOT blank AS duplicate, cut AND NOT seen AND NOT blank AS truncated,
           NOT seen AND NOT blank AS stays, (cut AND NOT seen AND NOT blank)::INTEGER AS late,
           lag(letter) OVER (PARTITION BY c ORDER BY i) || letter NOT IN ('su', 'ua', 'au') AS illegal
    FROM marked),
ways AS (
    SELECT c, max(i) + 1 AS i, '000000000000' AS v0, '000000000004II' AS v1, '000000000002I' AS v2, '000000000000' AS v3
    FROM found GROUP BY c
    UNION ALL
    SELECT c, i, {', '.join(_with_inserts(s) for s in conversations.STATES)}
    FROM (SELECT f.c, f.i, {', '.join(_before_a_row(s) for s in conversations.STATES)}
          FROM ways w JOIN found f ON f.c = w.c AND f.i = w.i - 1)),
best AS (SELECT c, left(v0, 12)::BIGINT AS cost, substr(v0, 13) AS audit FROM ways WHERE i = 1),
edits AS (SELECT c, unnest(string_split(audit, '')) AS edit, unnest(range(len(audit))) AS j FROM best),
counted AS (
    SELECT *, count(*) FILTER (edit <> 'I') OVER upto AS i, count(*) FILTER (edit <> 'D') OVER upto AS q
    FROM edits WINDOW upto AS (PARTITION BY c ORDER BY j)),
lines AS (
    SELECT e.c, e.j, e.edit, e.q, f.role, f.text,
           bool_or(e.q = 1 AND e.edit = 'K' AND f.letter = 's') OVER (PARTITION BY e.c) AS led
    FROM counted e LEFT JOIN found f ON f.c = e.c AND f.i = e.i WHERE e.edit <> 'D'),
written AS (
    SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (q - led::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS digest
    FROM lines GROUP BY c),
totals AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM found GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS c FROM conversations) o
LEFT JOIN totals USING (c) LEFT JOIN best USING (c) LEFT JOIN written USING (c)
"""
