"""Repair of conversation structure: the cheapest edits that give a legal order of roles.

Rows of a conversation are taken by turn (nulls first; rows of one turn by role and text).  A row's first fault counts: ``blank``
(nothing but ASCII white space), ``duplicate`` (role and text seen earlier), ``truncated`` (the last visible character isn't
one of ``.!?``).  Edits are Keep (0), Rerole to user or assistant (1), Delete (2, required for blank and duplicate rows) and
Insert of an empty user or assistant row (5); a truncated row that stays adds 5.  The role initials after repair have the form
``(s?(ua)+)?``.  Of all edits of least cost the one whose initials ``D I K R`` are least in ASCII order is taken.

``search`` is a depth-first branch-and-bound with an explicit stack.  A search node is (rows done, order state).  Branches go
cheapest first; a branch dies when its cost and the lower bound of the remaining rows exceed the incumbent (cost, audit), or
when the node's dominance table holds an equal or better prefix.  That a better prefix stays better holds because two
prefixes of one node and one cost never are prefixes of each other: the longer one would hold more inserts.  The stack runs
empty, so the incumbent is proved optimal.

A long conversation is searched in blocks of ``BLOCK`` rows: for each order state the best prefix is carried on, with its cost
and a running SHA-256 of its repaired rows.  So memory is a block and the audit, however many turns a conversation
has.  Spark sorts the rows (spilling) and finds the duplicates by a keyed minimum, so no task holds a conversation.  The digest
of the whole repaired conversation is sequential by definition: its rows stream through one task.

A null role or text counts as one space.  All null conv_ids are one conversation.  Roles count by their first character only
(an unknown or empty one can't be kept).  Conversations whose rows were all dropped give zeros, an empty audit and the
digest of the empty string.  Empty tables give no rows.  Other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 24
BLANK = " \t\n\x0b\x0c\r"
#: The edits' costs.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Order states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE = {"u": "user", "a": "assistant"}
#: state -> role initial -> (inserted initials, next state)
MOVES = {START: {"s": ("", SYSTEM), "u": ("", USER), "a": ("u", ASSISTANT)},
         SYSTEM: {"u": ("", USER), "a": ("u", ASSISTANT)},
         USER: {"a": ("", ASSISTANT), "u": ("a", USER)},
         ASSISTANT: {"u": ("", USER), "a": ("u", ASSISTANT)}}
#: What is inserted after the last row.
CLOSING = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
LEGAL_PAIRS = ("su", "ua", "au")
OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
       "repaired_sha256 string, n_rows long")


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: rows damaged by crc32 of ``conv_id:turn`` modulo 20 (0 drops the row, which stays
    here with ``copies`` 0; 1 empties the text; 2 removes its ``.!?``; 3 repeats the row; 4 makes it a user's)."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def clean(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` of rows taken as they are."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role, text, F.lit(1).alias("copies"))


def _seen_before(rows: DataFrame) -> DataFrame:
    """``rows`` with ``later``: whether the same role and text stands at an earlier turn of the conversation."""
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("key")
    keyed = rows.select("*", key)
    first = keyed.filter("copies > 0").groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("c")) \
        .filter("c > 1").select(F.col("conv_id").alias("f_conv"), F.col("key").alias("f_key"), "first")
    both = keyed.join(first, keyed["conv_id"].eqNullSafe(first["f_conv"]) & (keyed["key"] == first["f_key"]), "left")
    later: Column = F.coalesce(F.struct("turn") > F.col("first"), F.lit(False))
    return both.select("conv_id", "turn", "role", "text", "copies", later.alias("later"))


# ---- the search ------------------------------------------------------------------------------------------------
def row_moves(initial: str, fault: str) -> list[tuple[int, str, str]]:
    """(cost, edit, role initial) of a row's edits without inserts, cheapest first."""
    if fault in ("blank", "duplicate"):
        return [(DELETE, "D", "")]
    more = TRUNCATED if fault == "truncated" else 0
    moves = [(more, "K", initial)] if initial in ("s", "u", "a") else []
    moves += [(DELETE, "D", "")] + [(REROLE + more, "R", r) for r in "ua" if r != initial]
    return sorted(moves)


def suffix_bounds(rows: list[tuple[str, str]]) -> list[int]:
    """Least cost of rows k.. whatever the state: each row's cheapest edit, and 1 at least for two neighbours that can't
    both be kept."""
    least = [row_moves(*r)[0][0] for r in rows]
    bound = [0] * (len(rows) + 1)
    for k in range(len(rows) - 1, -1, -1):
        bound[k] = bound[k + 1] + least[k]
        if k + 1 < len(rows) and least[k] == least[k + 1] == 0 and rows[k][0] + rows[k + 1][0] not in LEGAL_PAIRS:
            bound[k] = max(bound[k], bound[k + 2] + REROLE)
    return bound


def search(rows: list[tuple[str, str]], starts: dict[int, tuple[int, int]], last: bool) -> dict[int, tuple[int, int, str, int]]:
    """Best prefixes after ``rows`` (role initial, fault): {state: (cost, rank of the earlier audit, audit here, state before)}.

    ``starts`` has (cost, rank) of the states before the rows.  With ``last`` the closing inserts are added and only the best
    of all states is returned.
    """
    n, bound, moves = len(rows), suffix_bounds(rows), [row_moves(*r) for r in rows]
    # a state's best prefix matters only within two inserts of the best of all; START and SYSTEM can't be reached back
    slack = 0 if last else 2 * INSERT
    table: dict[tuple[int, int], tuple[int, int, str]] = {}
    ends: dict[int, tuple[int, int, str, int]] = {}
    best: tuple[int, int, str] | None = None                      # the incumbent
    stack = [(0, s, c, r, "", s) for s, (c, r) in sorted(starts.items(), key=lambda x: x[1], reverse=True)]
    while stack:
        k, state, cost, rank, audit, origin = stack.pop()
        if best is not None and cost + bound[k] > best[0] + slack and (last or state >= USER):
            continue
        if table.get((k, state), (cost + 1,)) < (cost, rank, audit):
            continue
        if k == n:
            if last:
                tail = CLOSING[state]
                done = (cost + INSERT * len(tail), rank, audit + "I" * len(tail))
                if best is None or done < best:
                    best, ends = done, {state: (*done, origin)}
            else:
                ends[state] = (cost, rank, audit, origin)
                best = min(best or (cost, rank, audit), (cost, rank, audit))
            continue
        for price, edit, initial in reversed(moves[k]):
            if edit == "D":
                child = (k + 1, state, cost + price, rank, audit + "D", origin)
            elif initial in MOVES[state]:
                new, to = MOVES[state][initial]
                child = (k + 1, to, cost + price + INSERT * len(new), rank, audit + "I" * len(new) + edit, origin)
            else:
                continue
            held = table.get(child[:2])
            if held is None or child[2:5] < held:
                table[child[:2]] = child[2:5]
                stack.append(child)
    return ends


class Conversation:
    """One conversation's counts and the best prefixes of its rows so far; rows come in order, in blocks."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.block, self.n = conv_id, [], 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.low = self.high = self.before = self.row = None
        self.best = {START: (0, [], hashlib.sha256(), 0)}         # state -> (cost, audits, digest, rows written)

    def add(self, turn: int | None, role: str, text: str, later: bool) -> None:
        fault = "blank" if not (visible := text.rstrip(BLANK)) else \
            "duplicate" if later or (turn, role, text) == self.row else "" if visible[-1] in ".!?" else "truncated"
        if fault:
            self.counts[fault] += 1
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.n:
            self.illegal += self.before + role[:1] not in LEGAL_PAIRS
        self.before, self.row, self.n = role[:1], (turn, role, text), self.n + 1
        if len(self.block) == BLOCK:
            self.advance(False)
        self.block.append((role, text, fault))

    def advance(self, last: bool) -> None:
        """Search the held block from every order state carried on."""
        # states of one rank can't meet: their audits differ and none is a prefix of another
        order = {s: r for r, s in enumerate(sorted(self.best, key=lambda s: self.best[s][1]))}
        ends = search([(role[:1], fault) for role, _, fault in self.block], {s: (b[0], order[s]) for s, b in self.best.items()}, last)
        self.best = {state: self.written(cost, audit, origin, last) for state, (cost, _, audit, origin) in ends.items()}
        self.block = []

    def written(self, cost: int, audit: str, origin: int, last: bool) -> tuple:
        _, audits, digest, lines = self.best[origin]
        digest, state, rows = digest.copy(), origin, iter(self.block)
        for at, edit in enumerate(audit):
            if edit == "D":
                next(rows)
                continue
            if edit == "I":
                initial, text = "a" if state == USER else "u", ""
                role = ROLE[initial]
            else:
                role, text, _ = next(rows)
                if edit == "R":
                    # the only role that the order allows here
                    role = ROLE["a" if state == USER else "u"]
                initial = role[:1]
            state = MOVES[state][initial][1]
            digest.update(("\n" if lines else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            lines += 1
        return cost, [*audits, audit], digest, lines

    def result(self) -> tuple:
        self.advance(True)
        (cost, audits, digest, _), = self.best.values()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, "".join(audits), digest.hexdigest(), self.n)


SCHEMA = pa.schema([pa.field(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in OUT.split(", ")])


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows -> one row per conversation."""
    held, out = None, []
    for batch in batches:
        for conv_id, turn, role, text, copies, later in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or conv_id != held.conv_id:
                if held is not None:
                    out.append(held.result())
                held = Conversation(conv_id)
            for _ in range(copies):
                held.add(turn, role, text, later)
        if len(out) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA)
            out = []
    if held is not None:
        out.append(held.result())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA)


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of the repaired rows per conversation of ``damage`` or ``clean`` rows."""
    ordered = _seen_before(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(_repair, OUT)
