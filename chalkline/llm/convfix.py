"""Repair of the turn structure of conversations by A* on the edit lattice.

A conversation's rows in order are read against the automaton of role initials ``(s?(ua)+)?``. Edits: keep a row (K, 0), give
it the role the automaton wants next (R, 3), delete it (D, 4; the only edit of a blank or duplicate row), insert an empty
turn of that role (I, 3); an undeleted truncated row costs 3 more. A node of the lattice is (rows read, automaton's
state). The heuristic is a suffix sum of what no path avoids: 4 for each blank or duplicate row, 3 for each truncated one. It
is consistent, so with the queue keyed (cost + heuristic, audit) the first path that reaches a node is its cheapest, of
these the ASCII-least.

Rows are dealt by ranges of (conversation, turn, ...), so that a conversation of any size lies over as many tasks as its rows need.
Those that lie within a task are repaired there. The first and the last of a task may go on in another: their rows, and those of
very long ones, are dealt again, in blocks of bounded rows and bytes; a block is solved from each state it may begin in to each it may end in, and a chain
over the blocks' small tables picks the path. Inserts stand before a row of their block or at the very end, so of two audits of one
block neither is the other's beginning, and their order in the block decides a tie whatever follows. Only a block's number, costs and order reach the
chain. The digest of a conversation is sequential by nature: its blocks' repaired texts pass through one task, one block at a time.

Faults, in this order: blank (no character but ASCII white space), duplicate (role and text seen earlier in the conversation),
truncated (the last character that isn't white space is none of ``.!?``).

Edge cases: nulls in role and text are one space; a null turn comes first; a null conversation is one of its own; rows of one turn are in
order of role, the text's first 32 characters and a hash of it; repeated rows are duplicates. Very long texts are whole values of their rows, and close their block. A role outside s, u and a can only be
renamed or deleted. An empty table gives an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, session, ship, written

RENAME, DELETE, INSERT, CUT = 3, 4, 3, 3
#: Rows of a block, and characters after which it closes.
BLOCK, BLOCK_CHARS = 256, 1 << 20
#: Rows and characters of a conversation that one task repairs by itself.
ALONE, ALONE_CHARS = 2_000, 1 << 23
#: Characters of a text by which rows of one turn and role are in order.
BEGINNING = 32
BLANKS = " \t\n\v\f\r"
#: States: nothing read, after a system, user, assistant turn. The role each wants next, and what ends it well.
START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = ("user", "user", "assistant", "user")
TAIL = ("", "II", "I", "")
AFTER = {"user": USER, "assistant": ASSISTANT}
NUMBERS, WORDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), ("audit", "repaired_sha256")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _keeps(state: int, initial: str) -> int | None:
    """The state after a kept row of this initial, if it may stand here."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def search(rows: list[tuple[str, str]], entry: int) -> dict[int, tuple[int, str]]:
    """Cheapest cost and least audit from ``entry`` to each state behind all rows, (initial, fault) each; inserts stand before rows."""
    unavoidable = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        fault = rows[i][1]
        unavoidable[i] = unavoidable[i + 1] + (DELETE if fault in ("blank", "duplicate") else CUT if fault == "truncated" else 0)
    queue = [(unavoidable[0], "", 0, entry)]
    closed: set[tuple[int, int]] = set()
    ends: dict[int, tuple[int, str]] = {}
    while queue:
        estimate, audit, at, state = heapq.heappop(queue)
        if (at, state) in closed:
            continue
        closed.add((at, state))
        cost = estimate - unavoidable[at]
        if at == len(rows):
            ends[state] = (cost, audit)
            continue
        initial, fault = rows[at]
        role = AFTER[WANTED[state]]
        steps = [(DELETE, "D", at + 1, state), (INSERT, "I", at, role)]
        if fault not in ("blank", "duplicate"):
            extra = CUT if fault == "truncated" else 0
            steps.append((RENAME + extra, "R", at + 1, role))
            kept = _keeps(state, initial)
            if kept is not None:
                steps.append((extra, "K", at + 1, kept))
        for price, letter, then, next_state in steps:
            if (then, next_state) not in closed:
                heapq.heappush(queue, (cost + price + unavoidable[then], audit + letter, then, next_state))
    return ends


def apply(audit: str, entry: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired (role, text) turns of rows under an audit."""
    out, at, state = [], 0, entry
    for letter in audit:
        if letter == "K":
            state = _keeps(state, rows[at][0][:1])
            out.append(rows[at])
        elif letter in "RI":
            role = WANTED[state]
            state = AFTER[role]
            out.append((role, rows[at][1] if letter == "R" else ""))
        at += letter != "I"
    return out


def fault_of(text: str, seen_before: bool) -> str:
    shown = text.rstrip(BLANKS)
    if not shown:
        return "blank"
    if seen_before:
        return "duplicate"
    return "" if shown[-1] in ".!?" else "truncated"


def table_of(rows: list[tuple[str, str]], first: bool) -> dict[int, dict[int, tuple[int, str]]]:
    """``search`` from every state a block may begin in."""
    return {entry: search(rows, entry) for entry in ([START] if first else range(4))}


def chain(tables: list[dict[int, dict[int, tuple[int, int]]]]) -> list[tuple[int, int]]:
    """For blocks in order, each {entry: {exit: (cost, place of the audit among the entry's)}}: the chosen (entry, exit) of each."""
    best = {state: INSERT * len(TAIL[state]) for state in range(4)}
    picks: list[dict[int, int]] = []
    for table in reversed(tables):
        now, pick = {}, {}
        for entry, ends in table.items():
            cost, _, leave = min((cost + best[leave], place, leave) for leave, (cost, place) in ends.items())
            now[entry], pick[entry] = cost, leave
        picks.append(pick)
        best = now
    state, out = START, []
    for pick in reversed(picks):
        out.append((state, pick[state]))
        state = pick[state]
    return out


def placed(table: dict[int, dict[int, tuple[int, str]]]) -> dict[int, dict[int, tuple[int, int]]]:
    """Audits replaced by their order among those of one entry."""
    out = {}
    for entry, ends in table.items():
        order = {audit: n for n, audit in enumerate(sorted(a for _, a in ends.values()))}
        out[entry] = {leave: (cost, order[audit]) for leave, (cost, audit) in ends.items()}
    return out


class Turns:
    """What a report says of the rows of one block."""

    def __init__(self, rows: list[tuple[int | None, str, str, str]]) -> None:
        """Rows are (turn, role, text, fault)."""
        turns = [r[0] for r in rows if r[0] is not None]
        initials = [r[1][:1] for r in rows]
        self.least, self.most, self.distinct = min(turns, default=None), max(turns, default=None), len(set(turns))
        self.blank, self.duplicate, self.truncated = (sum(r[3] == f for r in rows) for f in ("blank", "duplicate", "truncated"))
        self.illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        self.first, self.last = (initials[0], initials[-1]) if rows else ("", "")

    FIELDS = ("least", "most", "distinct", "blank", "duplicate", "truncated", "illegal", "first", "last")

    def values(self) -> list:
        return [getattr(self, f) for f in self.FIELDS]


def combined(blocks: list[list]) -> list[int]:
    """gaps, blank, duplicate, truncated, illegal of blocks in order, each as ``Turns.values``."""
    least = most = last = None
    distinct = blank = duplicate = truncated = illegal = 0
    for lo, hi, n, b, d, t, bad, first, final in blocks:
        if lo is not None:
            distinct += n - (most is not None and lo == most)
            least, most = (lo if least is None else min(least, lo)), (hi if most is None else max(most, hi))
        illegal += bad + (last is not None and last + first not in ("su", "ua", "au"))
        blank, duplicate, truncated, last = blank + b, duplicate + d, truncated + t, final
    return [0 if least is None else most - least + 1 - distinct, blank, duplicate, truncated, illegal]


class Block:
    """Rows (turn, role, text, fault) of one conversation, one after another."""

    def __init__(self, rows: list[tuple], first: bool) -> None:
        self.turns, self.first = Turns(rows).values(), first
        self.rows = [(r[1], r[2]) for r in rows]
        self.table = table_of([(r[1][:1], r[3]) for r in rows], first)


def report(blocks: list[Block]) -> tuple:
    """Of a whole conversation: what ``REPORT`` lists, and its repaired turns."""
    path = chain([placed(b.table) for b in blocks])
    cost, audit, turns = 0, "", []
    for block, (entry, leave) in zip(blocks, path):
        price, letters = block.table[entry][leave]
        cost, audit = cost + price, audit + letters
        turns += apply(letters, entry, block.rows)
    tail = TAIL[path[-1][1]] if path else ""
    turns += apply(tail, path[-1][1] if path else START, [])
    whole = "\n".join(f"{r}:{t}" for r, t in turns)
    return (*combined([b.turns for b in blocks]), cost + INSERT * len(tail), audit + tail, hashlib.sha256(whole.encode()).hexdigest()), turns


def _blocks(rows: list[tuple]) -> Iterator[list[tuple]]:
    start, size = 0, 0
    for n, row in enumerate(rows):
        size += len(row[2])
        if n + 1 - start >= BLOCK or size >= BLOCK_CHARS:
            yield rows[start : n + 1]
            start, size = n + 1, 0
    if start < len(rows):
        yield rows[start:]


def _table(columns: list[list], fields: list[pa.Field]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def repair(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", present_col: str | None = None, turns: bool = False) -> DataFrame:
    """A report of each conversation (``REPORT``); with ``turns`` its repaired turns instead: conversation, n (ascending, with gaps), role, text.

    Rows whose ``present_col`` is false stand for their conversation alone.
    """
    spark = session(df)
    ship(spark)
    kind = df.schema[conv_col].dataType.simpleString()
    given = F.coalesce(df[present_col], F.lit(False)) if present_col else F.lit(True)
    chosen = df.select(df[conv_col].alias("conv"), df[turn_col].cast("long").alias("turn"), F.coalesce(df[role_col], F.lit(" ")).alias("role"), F.coalesce(df[text_col], F.lit(" ")).alias("text"), given.alias("present"))
    keys = ["conv", "turn", "role", "beginning", "hash", "tie"]
    dealt = (chosen.select("*", F.substring("text", 1, BEGINNING).alias("beginning"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("tie"))
             .repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
             .select("conv", "turn", "role", "text", "present", F.monotonically_increasing_id().alias("pos")))
    rest = [pa.field("pos", pa.int64()), pa.field("turn", pa.int64()), pa.field("role", pa.string()), pa.field("text", pa.string()), pa.field("present", pa.bool_()),
            *[pa.field(n, pa.int64()) for n in NUMBERS], *[pa.field(n, pa.string()) for n in WORDS]]

    def alone(rows: list[tuple]) -> list[tuple]:
        """What a conversation that lies within this task gives: its report, or its repaired turns."""
        seen, judged = set(), []
        for _, turn, role, text, present in rows:
            if present:
                key = (role, hashlib.sha256(text.encode()).digest())
                judged.append((turn, role, text, fault_of(text, key in seen)))
                seen.add(key)
        found, repaired = report([Block(b, n == 0) for n, b in enumerate(_blocks(judged))])
        if turns:
            return [(n, None, r, t, None, *[None] * len(found)) for n, (r, t) in enumerate(repaired)]
        return [(None, None, None, None, None, *found)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, chars, apart, started = None, [], 0, True, False  # apart: rows of this conversation are dealt again
        convs, out, fields = [], [], None

        def close() -> None:
            made = [(*r, *[None] * len(NUMBERS + WORDS)) for r in held] if apart else alone(held)
            out.extend(made)
            convs.extend([conv] * len(made))
            held.clear()

        for batch in batches:
            fields = [pa.field("conv", batch.column(0).type), *rest]
            for c, turn, role, text, present, pos in zip(*(column.to_pylist() for column in batch.columns)):
                if started and c != conv:
                    if held:
                        close()
                    apart, chars = False, 0
                conv, started = c, True
                held.append((pos, turn, role, text, present))
                chars += len(text)
                apart = apart or len(held) > ALONE or chars > ALONE_CHARS
                if apart and len(held) >= BLOCK:
                    close()
                if len(out) >= 5_000:
                    yield _table([convs, *zip(*out)], fields)
                    convs, out = [], []
        apart = True  # may go on in the next task
        if held:
            close()
        if out:
            yield _table([convs, *zip(*out)], fields)

    schema = f"conv {kind}, pos long, turn long, role string, text string, present boolean, {REPORT}"
    passed = written(dealt.mapInArrow(run, schema), "turns")
    done, picked = passed.where("present is null"), _picked(passed.where("present is not null"), kind)
    if turns:
        return done.select(F.col("conv").alias(conv_col), F.col("pos").alias("n"), "role", "text").unionByName(_turns_of(picked, kind).withColumnRenamed("conv", conv_col))
    return done.select("conv", *NUMBERS, *WORDS).unionByName(_reports_of(picked, kind)).withColumnRenamed("conv", conv_col)


def _picked(rows: DataFrame, kind: str) -> DataFrame:
    """Blocks of the rows that were dealt again, each with its number in its conversation and the states it is entered and left in."""
    spark = session(rows)
    given = rows.select("conv", "pos", "turn", "role", "text", "present", F.shiftrightunsigned("pos", 33).alias("part"), F.sha2("text", 256).alias("sha"))
    # repeated texts of a conversation: one row a task that holds them, so that a text of many rows parts over tasks again
    again = (given.where("present").groupBy("conv", "role", "sha", "text").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"), F.collect_set("part").alias("parts"))
             .where("n > 1").select("conv", "role", "sha", "first", F.explode("parts").alias("part")))
    g, a = given.alias("g"), again.alias("a")
    same = (F.col("g.part") == F.col("a.part")) & F.col("g.conv").eqNullSafe(F.col("a.conv")) & (F.col("g.role") == F.col("a.role")) & (F.col("g.sha") == F.col("a.sha"))
    flagged = g.join(a, same, "left").select("g.conv", "g.pos", "g.turn", "g.role", "g.text", "g.present", F.coalesce(F.col("g.pos") > F.col("a.first"), F.lit(False)).alias("seen"))
    dealt = flagged.repartitionByRange(partitions(spark), "pos").sortWithinPartitions("pos")

    def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, chars, start, out, fields = None, [], 0, 0, [], None

        def close() -> None:
            block = Block(held, False)
            audits = {str(e): {str(x): found[1] for x, found in ends.items()} for e, ends in block.table.items()}
            out.append((conv, start, json.dumps([block.turns, [[[x, *found] for x, found in ends.items()] for _, ends in sorted(placed(block.table).items())]]), json.dumps(audits), [r[0] for r in block.rows], [r[1] for r in block.rows]))

        open_ = False
        for batch in batches:
            fields = [pa.field("conv", batch.column(0).type), pa.field("block", pa.int64()), pa.field("table", pa.string()), pa.field("audits", pa.string()), pa.field("roles", pa.list_(pa.string())), pa.field("texts", pa.list_(pa.string()))]
            for c, pos, turn, role, text, present, seen in zip(*(column.to_pylist() for column in batch.columns)):
                if open_ and (c != conv or len(held) >= BLOCK or chars >= BLOCK_CHARS):
                    close()
                    open_ = False
                if not open_:
                    conv, held, chars, start, open_ = c, [], 0, pos, True
                if present:
                    held.append((turn, role, text, fault_of(text, seen)))
                    chars += len(text)
                if len(out) >= 16:
                    yield _table(list(zip(*out)), fields)
                    out.clear()
        if open_:
            close()
        if out:
            yield _table(list(zip(*out)), fields)

    blocks = written(dealt.mapInArrow(block_rows, f"conv {kind}, block long, table string, audits string, roles array<string>, texts array<string>"), "blocks")

    def pick(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("block").to_pylist(), table.column("table").to_pylist()))
        told = [json.loads(t) for _, t in rows]
        path = chain([{e: {x: (cost, place) for x, cost, place in ends} for e, ends in enumerate(t[1])} for t in told])
        numbers, n = combined([t[0] for t in told]), len(rows)
        tails = [""] * (n - 1) + [TAIL[path[-1][1]]]
        columns = [[b for b, _ in rows], list(range(n)), [e for e, _ in path], [x for _, x in path], tails, *([v] * n for v in numbers)]
        return pa.Table.from_batches([_table(columns, [pa.field(f, pa.string() if f == "tail" else pa.int64()) for f in ("block", "number", "entry", "leave", "tail", *NUMBERS[:-1])])])

    picks = blocks.select("conv", "block", "table").groupBy("conv").applyInArrow(pick, "block long, number long, entry long, leave long, tail string, " + ", ".join(f"{n} long" for n in NUMBERS[:-1]))
    # a conversation of many blocks has as many small rows in one task, no texts
    return blocks.join(picks, "block").select("conv", "number", "entry", "leave", "tail", *NUMBERS[:-1], "table", "audits", "roles", "texts")


def _repaired(row: dict) -> tuple[str, list[tuple[str, str]]]:
    """The audit of a picked block and the turns it gives."""
    audit = json.loads(row["audits"])[str(row["entry"])][str(row["leave"])]
    turns = apply(audit, row["entry"], list(zip(row["roles"], row["texts"])))
    return audit + row["tail"], turns + apply(row["tail"], row["leave"], [])


def _turns_of(picked: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [pa.field("conv", batch.schema.field("conv").type), pa.field("n", pa.int64()), pa.field("role", pa.string()), pa.field("text", pa.string())]
            for row in batch.to_pylist():
                _, turns = _repaired(row)
                yield _table([[row["conv"]] * len(turns), [row["number"] << 20 | k for k in range(len(turns))], [t[0] for t in turns], [t[1] for t in turns]], fields)

    return picked.mapInArrow(run, f"conv {kind}, n long, role string, text string")


def _reports_of(picked: DataFrame, kind: str) -> DataFrame:
    """One report a conversation: its blocks' texts run through a digest in order."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = [pa.field("conv", batch.schema.field("conv").type), *[pa.field(n, pa.int64()) for n in ("number", "n_turns", *NUMBERS)], pa.field("audit", pa.string()), pa.field("body", pa.string())]
            for row in batch.to_pylist():
                audit, turns = _repaired(row)
                cost = next(c for x, c, _ in json.loads(row["table"])[1][row["entry"]] if x == row["leave"]) + INSERT * len(row["tail"])
                values = [row["conv"], row["number"], len(turns), *[row[n] for n in NUMBERS[:-1]], cost, audit, "\n".join(f"{r}:{t}" for r, t in turns)]
                yield _table([[v] for v in values], fields)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started, fields, sums = None, False, None, []

        def close() -> pa.RecordBatch:
            conv, numbers, cost, audits, running, _ = sums
            return _table([[v] for v in (conv, *numbers, cost, "".join(audits), running.hexdigest())], fields)

        for batch in batches:
            fields = [pa.field("conv", batch.column(0).type), *[pa.field(n, pa.int64()) for n in NUMBERS], *[pa.field(n, pa.string()) for n in WORDS]]
            for conv, number, n_turns, *numbers, cost, audit, body in zip(*(column.to_pylist() for column in batch.columns)):
                if started and (conv != now or number == 0):
                    yield close()
                    started = False
                if not started:
                    now, started, sums = conv, True, [conv, numbers, 0, [], hashlib.sha256(), False]
                sums[2] += cost
                sums[3].append(audit)
                if n_turns:
                    sums[4].update(b"\n" * sums[5] + body.encode())
                    sums[5] = True
        if started:
            yield close()

    made = picked.mapInArrow(bodies, f"conv {kind}, number long, n_turns long, {REPORT.rsplit(', ', 2)[0]}, audit string, body string")
    return made.repartition(F.col("conv")).sortWithinPartitions("conv", "number").mapInArrow(digest, f"conv {kind}, {REPORT}")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults by a checksum of ``conv_id:turn``, as a test of ``repair``; dropped rows have a false ``present``."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    rows = conversations.select("conv_id", "turn", told[2].alias("role"), told[3].alias("text"), (F.crc32(F.concat(told[0], F.lit(":"), told[1]).cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), copies.alias("copy")).drop("copy")
