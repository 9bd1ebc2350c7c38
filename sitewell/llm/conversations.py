"""Repair of conversations: the cheapest edits that give `(system? (user assistant)+)?`, by a suffix-shared
automaton.

A row is kept, given another role, or deleted; rows with empty text may be inserted. What an edit may do and
costs follows from the row's role and first fault alone, so a run of rows is a word over a few symbols, its
signature. Rows are sorted once over all tasks and cut into blocks of at most BLOCK rows; the signatures of
all blocks of all conversations are read from their ends, sorted, so that equal ends stand together. An end
that several signatures share is one node of the automaton: its cost-to-go and best edits are found once for
each grammar state it is entered and left in. A conversation then only adds up its blocks' numbers, from the
last to the first, and follows the best ones forwards.

No task holds a conversation's texts: the sort splits a conversation over tasks, a repeat is known by the
least place of its role and text, blocks are bounded, and a conversation's edits are added up from its blocks,
a number for each BLOCK rows. Texts meet only to be hashed or written in order, and stream past.

Defined results: a null role or text counts as one space, a null conversation is one of its own, rows without
a turn come first, rows of one turn are ordered by role and text, repeated rows are rows. Of rows with the
same role and text in a conversation all but the first are repeats. Roles are known by their first letter, s,
u or a; others can only be given another role or deleted. Extra columns are ignored. Without rows there is
nothing to repair: no cost, no edits, an empty text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewell.llm.common import settled

BLOCK_BITS = 7  # a block holds up to 128 rows

# Costs of the edits, and what an unfinished end costs a row that stays.
DELETE, REROLE, INSERT, UNFINISHED = 3, 2, 2, 1
BLANK = " \t\n\x0b\f\r"
LEGAL_PAIRS = ("su", "ua", "au")

# Grammar states: nothing yet, after system, after user, after assistant. A kept row moves by its role's
# letter; a row that is inserted or given a role takes the one that the state wants.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = ("u", "u", "a", "u")
ROLE = {"u": "user", "a": "assistant"}
STATES = range(4)
FORCED = "x"  # the symbol of a row that must go; others are the letter of the role, a capital if unfinished

Best = tuple[int, str] | None  # cost and edits
Node = list[list[Best]]  # by state entered and state left

END: Node = [[(0, "") if s == g else None for g in STATES] for s in STATES]


def node(symbol: str, rest: Node) -> Node:
    """The node of a symbol before a known end: rows may be inserted before the row, then the row is edited."""
    late = UNFINISHED if symbol.isupper() else 0
    least = lambda found: min((f for f in found if f is not None), default=None)
    led = lambda cost, edit, after: [b and (b[0] + cost, edit + b[1]) for b in after]
    out = []
    for s in STATES:
        options = [led(DELETE, "D", rest[s])]
        if symbol != FORCED:
            options.append(led(REROLE + late, "R", rest[MOVES[s, WANTED[s]]]))
            if (kept := MOVES.get((s, symbol.lower()))) is not None:
                options.append(led(late, "K", rest[kept]))
        out.append([least(o) for o in zip(*options)])
    for _ in STATES:  # each round allows one more inserted row; more than two never help
        out = [[least(o) for o in zip(out[s], led(INSERT, "I", out[MOVES[s, WANTED[s]]]))] for s in STATES]
    return out


def finish() -> list[tuple[int, str]]:
    """By state: cost and edits of what is missing after the last row."""
    out: list[Best] = [(0, ""), None, None, (0, "")]
    for s in (2, 1):
        cost, edits = out[MOVES[s, WANTED[s]]]
        out[s] = (cost + INSERT, "I" + edits)
    return out


def automaton(signatures: DataFrame) -> DataFrame:
    """signature, cost, edits (16 each, by state entered and left; null where there is no way): one row per
    signature. Sorted by their ends, neighbours share the nodes of their common end."""
    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, before = [END], ""  # nodes of the ends of the signature before, the shortest first
        for batch in batches:
            costs, edits = [], []
            for backwards in batch["backwards"]:
                shared = next((i for i, (a, b) in enumerate(zip(before, backwards)) if a != b), min(len(before), len(backwards)))
                del path[shared + 1:]
                for symbol in backwards[shared:]:
                    path.append(node(symbol, path[-1]))
                before, flat = backwards, [b for row in path[-1] for b in row]
                costs.append([b and b[0] for b in flat])
                edits.append([b and b[1] for b in flat])
            yield pd.DataFrame({"signature": [b[::-1] for b in batch["backwards"]], "cost": costs, "edits": edits})

    ends = signatures.distinct().select(F.reverse("signature").alias("backwards"))
    return ends.repartitionByRange("backwards").sortWithinPartitions("backwards").mapInPandas(
        solve, "signature string, cost array<long>, edits array<string>")


def placed(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, print, place: rows as they are repaired. Places rise along every conversation;
    a conversation, a turn, or copies of one row may fill any number of tasks."""
    text = F.coalesce("text", F.lit(" "))
    keyed = rows.select(
        F.col("conv_id").cast("string").alias("conv"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
        F.substring(text, 1, 100).alias("head"), F.md5(text).alias("print"), F.xxhash64(F.monotonically_increasing_id()).alias("copy"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "head", "print", "copy"]
    return settled(keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("head", "copy").withColumn(
        "place", F.monotonically_increasing_id()))


def faults(at: DataFrame) -> DataFrame:
    """conv, turn, place, block, letter (of the role), blank, duplicate, truncated: at most one fault a row."""
    trimmed = F.rtrim("text", F.lit(BLANK))
    first_letter = F.substring("role", 1, 1)
    seen = at.select("conv", "turn", "place", "role", "print", F.shiftright("place", BLOCK_BITS).alias("block"),
                     F.when(first_letter.isin("s", "u", "a"), first_letter).otherwise("o").alias("letter"),
                     (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("unfinished"))
    firsts = seen.groupBy("conv", "role", "print").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    duplicate = ~F.col("blank") & F.col("first").isNull()
    return seen.join(firsts, "place", "left").select(
        "conv", "turn", "place", "block", "letter", "blank", duplicate.alias("duplicate"),
        (F.col("unfinished") & ~F.col("blank") & ~duplicate).alias("truncated"))


def blocks(found: DataFrame) -> DataFrame:
    """conv, block, signature, letters: a block's rows in order."""
    symbol = F.when(F.col("blank") | F.col("duplicate"), FORCED).when(F.col("truncated"), F.upper("letter")).otherwise(F.col("letter"))
    rows = F.array_sort(F.collect_list(F.struct("place", symbol.alias("symbol"), "letter")))  # at most 128
    return found.groupBy("conv", "block").agg(rows.alias("rows")).select(
        "conv", "block", F.array_join("rows.symbol", "").alias("signature"), F.array_join("rows.letter", "").alias("letters"))


EDITS = "conv string, block long, state int, edits string, cost long, illegal long"
STEPS = "conv string, edit string, role string, text string, cost long, illegal long"
DIGESTS = "conv string, audit string, repaired_sha256 string, cost long, illegal long"
FRAME_ROWS, FRAME_BYTES = 10_000, 4_000_000


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    return frame.astype({"cost": "Int64", "illegal": "Int64"})


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple]:
    """Rows of sorted batches as (key, is it new, row)."""
    before = object()
    for batch in batches:
        for row in batch.itertuples(index=False):
            now = getattr(row, key)
            yield now, now != before, row
            before = now


def edited(found: DataFrame) -> DataFrame:
    """conv, block, state (the block is entered in), edits of the block; and, on the last block of each
    conversation, its cost and its pairs of neighbours that the grammar has not."""
    closing = finish()

    def settle(conv, parts: list) -> Iterator[tuple]:
        cost, ways = [c for c, _ in closing], []
        for _, _, costs, edits in reversed(parts):
            # edits of one block that cost the same in the end differ within the block, as all end with a row
            best = [min((costs[4 * s + g] + cost[g], edits[4 * s + g], g) for g in STATES if edits[4 * s + g] is not None)
                    for s in STATES]
            cost = [b[0] for b in best]
            ways.append([b[2] for b in best])
        s = 0
        for k, ((block, _, _, edits), way) in enumerate(zip(parts, reversed(ways)), 1):
            mine, entered, s = edits[4 * s + way[s]], s, way[s]
            if k < len(parts):
                yield conv, block, entered, mine, None, None
            else:
                illegal = sum(a + b not in LEGAL_PAIRS for a, b in pairwise("".join(p[1] for p in parts)))
                yield conv, block, entered, mine + closing[s][1], cost[0], illegal

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, parts, done, known = None, [], [], {}
        for now, new, row in _runs(batches, "conv"):
            if new and parts:
                done += settle(conv, parts)
                parts = []
                if len(done) >= FRAME_ROWS:
                    yield _frame(done, EDITS)
                    done, known = [], {}
            conv = now
            if row.signature not in known:  # blocks of one signature share its numbers
                known[row.signature] = ([None if pd.isna(c) else int(c) for c in row.cost], list(row.edits))
            parts.append((row.block, row.letters, *known[row.signature]))
        if parts:
            yield _frame([*done, *settle(conv, parts)], EDITS)

    cut = settled(blocks(found))
    solved = cut.join(automaton(cut.select("signature")), "signature")
    return solved.repartition("conv").sortWithinPartitions("conv", "block").mapInPandas(
        run, EDITS)


def applied(at: DataFrame, edits: DataFrame) -> DataFrame:
    """conv, edit, role, text (null for a deleted row), cost, illegal (on the last row of a conversation's last
    block): the edits of every conversation in order, its rows together in one partition."""
    nothing = lambda kind: F.lit(None).cast(kind)
    both = edits.withColumn("place", F.lit(-1).cast("long")).withColumn("role", nothing("string")).withColumn(
        "text", nothing("string")).unionByName(at.select(
            "conv", F.shiftright("place", BLOCK_BITS).alias("block"), "place", "role", "text"), allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size, conv, state, left, last = [], 0, None, 0, "", (None, None)

        def put(edit: str, role: str | None = None, text: str | None = None) -> None:
            nonlocal state, size
            if edit != "D":
                letter = WANTED[state] if edit in "IR" else role[:1]
                role, state = role if edit == "K" else ROLE[letter], MOVES[state, letter]
            out.append((conv, edit, role, text if edit != "I" else "", None, None))
            size += 100 + len(text or "")

        def insert() -> None:
            nonlocal left
            while left[:1] == "I":
                put("I")
                left = left[1:]

        def close() -> None:
            insert()
            if last[0] is not None:
                out[-1] = (*out[-1][:4], *last)

        for now, _, row in _runs(batches, "conv"):
            if row.place < 0:  # the edits of a block, before its rows
                close()
                if size > FRAME_BYTES:
                    yield _frame(out, STEPS)
                    out, size = [], 0
                whole = not pd.isna(row.cost)
                conv, state, left, last = now, int(row.state), row.edits, (int(row.cost), int(row.illegal)) if whole else (None, None)
                continue
            insert()
            edit, left = left[0], left[1:]
            put(edit, *((None, None) if edit == "D" else (row.role, row.text)))
        if out or left:
            close()
            yield _frame(out, STEPS)

    return both.repartition("conv").sortWithinPartitions("conv", "block", "place").mapInPandas(
        run, STEPS)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the rows of every repaired conversation; place rises along each."""
    at = placed(rows)
    steps = applied(at, settled(edited(faults(at)))).withColumn("place", F.monotonically_increasing_id())
    return steps.where("edit <> 'D'").select(
        F.col("conv").cast(rows.schema["conv_id"].dataType).alias("conv_id"), "place", "edit", "role", "text")


def digests(steps: DataFrame) -> DataFrame:
    """conv, audit, repaired_sha256, cost, illegal: of edits in order, as `applied` gives them. A digest reads
    its text from the front, so a conversation's rows stream through one task; none is held."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, conv, audit, digest, started, last = [], None, [], None, False, (0, 0)
        for now, new, row in _runs(batches, "conv"):
            if new:
                if digest:
                    done.append((conv, "".join(audit), digest.hexdigest(), *last))
                if len(done) >= FRAME_ROWS:
                    yield _frame(done, DIGESTS)
                    done = []
                conv, audit, digest, started = now, [], hashlib.sha256(), False
            audit.append(row.edit)
            if row.edit != "D":
                digest.update((("\n" if started else "") + row.role + ":" + row.text).encode())
                started = True
            if not pd.isna(row.cost):
                last = (int(row.cost), int(row.illegal))
        if digest:
            done.append((conv, "".join(audit), digest.hexdigest(), *last))
            yield _frame(done, DIGESTS)

    return steps.mapInPandas(run, DIGESTS)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by a hash of conversation and turn: one in twenty each is dropped, emptied, loses
    its sentence ends, is repeated, or becomes a user's."""
    text_or = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_or("conv_id"), F.lit(":"), text_or("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", text_or("role").alias("role"), text_or("text").alias("text"), fate.alias("fate"))
    return rows.where("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def counted(found: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated; turns are counted once each before they are counted together."""
    kinds = ["blank", "duplicate", "truncated"]
    turns = found.groupBy("conv", "turn").agg(*[F.count_if(k).alias(k) for k in kinds])
    return turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(k).alias(k) for k in kinds])


def query(conversations: DataFrame) -> DataFrame:
    at = placed(damaged(conversations))
    found = settled(faults(at))
    same = lambda a, b: F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv"))
    everyone = conversations.select(F.col("conv_id").cast("string").alias("conv")).distinct()
    results = digests(applied(at, settled(edited(found))))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return everyone.alias("e").join(counted(found).alias("c"), same("e", "c"), "left").join(
        results.alias("r"), same("e", "r"), "left").select(
        F.col("e.conv").cast(conversations.schema["conv_id"].dataType).alias("conv_id"),
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
