"""Conversation structure repair by iterative-deepening A*.

``damaged`` applies the deterministic faults, ``flagged`` orders every
conversation and names each row's first fault, ``search`` finds the cheapest
edits and ``repair`` applies them.

The edits of a conversation are one path: at each step Delete, Insert, Keep or
Rerole (their initials in ASCII order), until every row is used up and the
roles read ``(s?(ua)+)?``.  ``search`` goes down that tree depth first in ASCII
order under a cost bound, which is raised to the least cost that passed it;
states that failed are kept with the slack they failed with and not entered
again with as little.  The first accepting path under the first bound that has
one is the cheapest and, among these, ASCII-least.  What every row must cost
(a required deletion, a missing end mark, a role that cannot stay) is the
lower bound of what is left.

A conversation longer than ``BLOCK`` rows is searched in blocks, from the last
to the first, from each of the four role states that can enter a block; the
costs of the block behind are the costs of leaving one.  The paths that meet
are the path of the whole conversation, so nothing depends on the block size.

Scale: faults are built-in expressions; the first place of every message is a
map-side combined aggregate, joined back (AQE splits a hot message).  Rows
meet by conversation in two sorted streams: the first carries one byte a row
to the search, the second carries the texts past the finished edits.  A task
holds one byte a row of one conversation (as many as its audit string has) and
one text at a time, however long the conversation is; the order of a
conversation's rows is what its digest is defined by, so one conversation is
one stream.

Defined results: a null role or text is one space (in the damage's key, null
ids too); rows of a null ``conv_id`` are one conversation; null turns come
first; rows of equal turn follow by role and text digest, so equal rows are
adjacent; only the first letter of a role decides whether it may stay (an
empty or other role is reroled or deleted); a conversation that lost all its
rows has zeros, no edits and no messages; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderflow.llm.base import record_batch, write_scratch

# FIXED VALUES: what each edit costs
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLOCK = 32                       # rows searched at a time
BLANKS = " \t\n\x0b\x0c\r"

# role states: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
TURN = (USER, USER, ASSISTANT, USER)           # what may be inserted or reroled to
NAMES = {USER: "user", ASSISTANT: "assistant"}
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
END = (0, 2 * INSERT, INSERT, 0)               # insertions that finish a conversation

# faults, in the order that counts
NONE, BLANK, DUPLICATE, SHORT = range(4)
ROLES = "sua"                                  # other roles are class 3


# --- damage and faults ----------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage, ``copy`` (2 for a repeated
    row) and ``dropped`` (the row stays so that its conversation does)."""
    def known(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = (F.when(fault == 1, F.lit("")).when(fault == 2, F.translate("__t", ".!?", ""))
            .otherwise(F.col("__t")))
    return (conversations.select("conv_id", "turn", known("role").alias("__r"), known("text").alias("__t"))
            .select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.col("__r")).alias("role"),
                    text.alias("text"), (fault == 0).alias("dropped"),
                    F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy")))


def flagged(rows: DataFrame) -> DataFrame:
    """Rows with their message ``digest``, whether the message stood earlier,
    and their ``code`` (4 * role class + first fault; null for dropped rows)."""
    rows = rows.withColumn("digest", F.md5("text"))
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    live = rows.filter(~F.col("dropped"))
    places = (live.groupBy("conv_id", "role", "digest")
              .agg(F.min("turn").alias("__first"), F.bool_or(F.col("turn").isNull()).alias("__unset"))
              .toDF("__c", "__r", "__d", "__first", "__unset"))
    seen = rows.join(places, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r"))
                     & (F.col("digest") == F.col("__d")), "left")
    # equal rows of one turn are adjacent: all but the first are repeats
    order = Window.partitionBy("conv_id").orderBy("dropped", "turn", "role", "digest")
    same = F.struct("turn", "role", "digest", "dropped")
    earlier = ((F.col("turn") > F.col("__first")) | (F.col("__unset") & F.col("turn").isNotNull())
               | F.coalesce(F.lag(same).over(order) == same, F.lit(False)))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = (F.when(last == "", BLANK).when(earlier, DUPLICATE)
             .when(~last.isin(".", "!", "?"), SHORT).otherwise(NONE))
    return seen.withColumn("code", F.when(~F.col("dropped"), 4 * kind + fault)).drop("__c", "__r", "__d", "__first", "__unset")


# --- the search -------------------------------------------------------------------
def steps(code: int):
    """Per role state the (initial, rows used, next state, cost) of each edit
    before or on a row, in ASCII order."""
    role, fault = (ROLES + " ")[code >> 2], code & 3
    may_stay = fault in (NONE, SHORT)
    extra = TRUNCATED if fault == SHORT else 0
    out = []
    for state in range(4):
        here = [("D", 1, state, DELETE), ("I", 0, TURN[state], INSERT)]
        if may_stay and role in KEEP[state]:
            here.append(("K", 1, KEEP[state][role], extra))
        if may_stay:
            here.append(("R", 1, TURN[state], REROLE + extra))
        out.append(here)
    return out


STEPS = [steps(code) for code in range(16)]


def least(code: int) -> int:
    """What a row costs at least, wherever it stands."""
    role, fault = code >> 2, code & 3
    if fault in (BLANK, DUPLICATE):
        return DELETE
    return (TRUNCATED if fault == SHORT else 0) + (REROLE if role == 3 else 0)


LEAST = [least(code) for code in range(16)]


def search(codes: bytes, start: int, leave, failed: dict) -> tuple[int, str, int]:
    """Cheapest edits of ``codes`` from a role state: (cost, initials, state
    left in); ``leave`` is the cost of leaving in each state."""
    n, floor = len(codes), min(leave)
    rest = [floor] * (n + 1)                   # lower bound of the cost from row i on
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + LEAST[codes[i]]
    path: list[str] = []

    def down(i: int, state: int, slack: int) -> tuple[int, int]:
        """(-1, state left in) once a path is accepted, else (least excess, 0)."""
        if i == n:
            over = leave[state] - floor - slack
            return (-1, state) if over <= 0 else (over, 0)
        need = failed.get((i, state), 0)       # less slack than that failed
        if slack < need:
            return need - slack, 0
        best = 1 << 60
        for edit, used, then, cost in STEPS[codes[i]][state]:
            left = slack - cost - rest[i + used] + rest[i]
            if left < 0:
                best = min(best, -left)
                continue
            path.append(edit)
            over, end = down(i + used, then, left)
            if over < 0:
                return -1, end
            path.pop()
            best = min(best, over)
        failed[i, state] = slack + best
        return best, 0

    bound = rest[0]
    while True:
        over, end = down(0, start, bound - rest[0])
        if over < 0:
            return bound, "".join(path), end
        bound += over


def cheapest(codes: bytes) -> tuple[int, str]:
    """(cost, edits) of a conversation."""
    leave, plans = END, []
    for lo in range((len(codes) - 1) // BLOCK * BLOCK, -1, -BLOCK):
        failed: dict = {}
        plan = [search(codes[lo:lo + BLOCK], state, leave, failed) for state in (range(4) if lo else (START,))]
        leave = [p[0] for p in plan]
        plans.append(plan)
    if not plans:
        return 0, ""
    state, edits = START, []
    for plan in reversed(plans):
        _, path, state = plan[state]
        edits.append(path)
    return leave[0], "".join(edits) + "I" * (END[state] // INSERT)


# --- Spark ------------------------------------------------------------------------
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REMEMBERED = 20_000              # edits of short conversations kept in a task


class _Report:
    """Counts and edits of the conversations of a sorted stream."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, str]] = {}

    def start(self, conv):
        self.conv, self.codes = conv, bytearray()
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, code):
        if code is None:
            return
        self.codes.append(code)
        if turn is not None:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns += 1
            self.high = turn

    def row(self):
        codes = bytes(self.codes)
        found = self.known.get(codes)
        if found is None:
            found = cheapest(codes)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(codes) <= BLOCK:
                self.known[codes] = found
        faults = [codes.translate(_FAULT).count(f) for f in (BLANK, DUPLICATE, SHORT)]
        roles = codes.translate(_ROLE)
        legal = sum(roles.count(p) for p in (b"su", b"ua", b"au"))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *faults, max(0, len(codes) - 1) - legal, *found)


_FAULT = bytes(c & 3 for c in range(256))
_ROLE = bytes(ord((ROLES + " ")[min(3, c >> 2)]) for c in range(256))


def report(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost and
    ``audit``, the initials of the cheapest edits; ``rows`` from ``flagged``."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    conv_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, begun = _Report(), [], False
        for batch in batches:
            for conv, turn, code in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or conv != task.conv:
                    if begun:
                        out.append(task.row())
                    task.start(conv)
                    begun = True
                task.add(turn, code)
            if out:
                yield rows_of(out)
                out = []
        if begun:
            yield rows_of([*out, task.row()])

    def rows_of(out):
        conv, *counts, audit = zip(*out)
        return record_batch(conv_id=pa.array(conv, conv_type),
                            **{c: pa.array(v, pa.int64()) for c, v in zip(COUNTS, counts)},
                            audit=pa.array(audit, pa.string()))

    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
    codes = (rows.select("conv_id", "turn", "dropped", "role", "digest", "code").repartition("conv_id")
             .sortWithinPartitions("conv_id", "dropped", "turn", "role", "digest"))
    return codes.select("conv_id", "turn", F.col("code").cast("int").alias("code")).mapInArrow(run, schema)


def _edited(rows: DataFrame, audits: DataFrame, run, schema: str) -> DataFrame:
    """A stream per conversation: its edits first, then its rows in order."""
    none = {c: F.lit(None).cast(rows.schema[c].dataType) for c in ("turn", "role", "text", "digest")}
    head = audits.select("conv_id", *[c.alias(n) for n, c in none.items()], "audit")
    body = (rows.filter(~F.col("dropped"))
            .select("conv_id", "turn", "role", "text", "digest", F.lit(None).cast("string").alias("audit")))
    both = (head.union(body).withColumn("__row", F.col("audit").isNull()).repartition("conv_id")
            .sortWithinPartitions("conv_id", "__row", "turn", "role", "digest"))
    return both.select("conv_id", "role", "text", "audit").mapInArrow(run, schema)


def _messages(conv_rows) -> Iterator[tuple]:
    """(conv, edit, role, text) of every edit of a sorted stream, and
    (conv, None, None, None) where a conversation ends."""
    conv, edits, at, state, begun = None, "", 0, START, False

    def inserted():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            at, state = at + 1, TURN[state]
            yield conv, "I", NAMES[state], ""

    for key, role, text, audit in conv_rows:
        if audit is not None:
            if begun:
                yield from inserted()
                yield conv, None, None, None
            conv, edits, at, state, begun = key, audit, 0, START, True
            continue
        yield from inserted()
        edit = edits[at]
        at += 1
        if edit == "D":
            yield conv, edit, role, text
        elif edit == "K":
            state = KEEP[state][role[0]]
            yield conv, edit, role, text
        else:
            state = TURN[state]
            yield conv, edit, NAMES[state], text
    if begun:
        yield from inserted()
        yield conv, None, None, None


def _stream(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Every edit as a row: conv_id, ``place`` (of the repaired conversation,
    from 0; null for a deleted row), edit, role, text."""
    field = rows.schema["conv_id"].dataType.simpleString()
    conv_type = to_arrow_type(rows.schema["conv_id"].dataType)
    schema = f"conv_id {field}, place long, edit string, role string, text string"

    def batch_of(out):
        kinds = (conv_type, pa.int64(), pa.string(), pa.string(), pa.string())
        names = ("conv_id", "place", "edit", "role", "text")
        return record_batch(**{n: pa.array(v, t) for n, t, v in zip(names, kinds, zip(*out))})

    def run(batches):
        out, place = [], 0
        for conv, edit, role, text in _messages(_stream(batches)):
            if edit is None:
                place = 0
                continue
            out.append((conv, None if edit == "D" else place, edit, role, text))
            place += edit != "D"
            if len(out) >= 2000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    return _edited(rows, audits, run, schema)


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired ``role:text`` lines."""
    field = rows.schema["conv_id"].dataType.simpleString()
    conv_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def run(batches):
        out, sha, first = [], hashlib.sha256(), True
        for conv, edit, role, text in _messages(_stream(batches)):
            if edit is None:
                out.append((conv, sha.hexdigest()))
                sha, first = hashlib.sha256(), True
                if len(out) >= 2000:
                    yield record_batch(c=pa.array([o[0] for o in out], conv_type),
                                       s=pa.array([o[1] for o in out], pa.string()))
                    out = []
            elif edit != "D":
                sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        if out:
            yield record_batch(c=pa.array([o[0] for o in out], conv_type),
                               s=pa.array([o[1] for o in out], pa.string()))

    return _edited(rows, audits, run, f"conv_id {field}, repaired_sha256 string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(flagged rows, report) of the damaged conversations, both written: the
    input of ``repaired`` and ``digests``."""
    rows = write_scratch(flagged(damaged(conversations)), "conversations")
    return rows, write_scratch(report(rows), "audits")
