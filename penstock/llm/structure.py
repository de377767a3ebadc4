"""Structure repair of conversations: the cheapest edits, with an audit of them.

The messages of a conversation are read in order by an automaton of the roles
``(s?(ua)+)?``; each message is kept, given another role or deleted, and
messages may be inserted. The cheapest way to every state is carried along, and
of ways of the same cost the one whose edits, written as initials, come first.

Ways are not stored as strings. An edit is a node linked to the way that it
prolongs, so ways share their beginnings; a node also knows its ancestors at
powers of two, and a rolling hash of its way. Two ways are compared by a search
for their longest common prefix, which descends by these ancestors; equal
hashes are verified edit by edit.

A conversation may be longer than a task should hold. The messages are sorted
over all tasks, and a conversation that runs over the edge of a task gives, for
each part of it, the best ways between all states; the parts are then joined in
order. Only flags and edits are held of such a conversation, not its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm.store import prepared, written

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: What ends a message that is not cut off; what is not white space.
ENDS, VISIBLE = ".!?", r"[^\x20\x09-\x0D]"

#: States: nothing yet, after the system message, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ACCEPTED = (START, ASSISTANT)
#: The state after an initial, where it may follow.
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that an inserted message, or one with a new role, has in each state.
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
#: Adjacent initials that may follow one another.
LEGAL = {"su", "ua", "au"}

#: Messages whose ways are linked at a time.
HELD = 50_000

_MODULUS, _BASE = (1 << 61) - 1, 1_000_003_579


# ---------------------------------------------------------------- ways

class Way:
    """A sequence of edits: the last of them, linked to the sequence before it."""

    __slots__ = ("up", "edit", "length", "hash")

    def __init__(self, before: Way | None, edit: str) -> None:
        self.edit = edit
        if before is None:
            self.up, self.length, self.hash = (), 0, 0
            return
        self.length = before.length + 1
        self.hash = (before.hash * _BASE + ord(edit)) % _MODULUS
        up, ancestor, k = [before], before, 0
        while len(ancestor.up) > k:
            ancestor = ancestor.up[k]
            up.append(ancestor)
            k += 1
        self.up = tuple(up)

    def at(self, length: int) -> Way:
        """The first ``length`` edits."""
        way = self
        while (more := way.length - length) > 0:
            way = way.up[more.bit_length() - 1]
        return way

    def edits(self) -> str:
        out, way = [], self
        while way.length:
            out.append(way.edit)
            way = way.up[0]
        return "".join(reversed(out))


def same(x: Way, y: Way) -> bool:
    """Whether two ways of one length are the same; equal hashes are not believed."""
    if x.hash != y.hash or x.length != y.length:
        return False
    while x is not y and x.length:
        if x.edit != y.edit:
            return False
        x, y = x.up[0], y.up[0]
    return True


def common(x: Way, y: Way) -> int:
    """Length of the longest common prefix of two ways."""
    length = min(x.length, y.length)
    x, y = x.at(length), y.at(length)
    if same(x, y):
        return length
    # the highest ancestors that still differ, by falling powers of two
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and not same(x.up[k], y.up[k]):
            x, y = x.up[k], y.up[k]
    return x.length - 1


def earlier(x: Way, y: Way) -> bool:
    """Whether the edits of ``x``, as initials, come before those of ``y``."""
    if x is y:
        return False
    length = common(x, y)
    if length == min(x.length, y.length):
        return x.length < y.length
    return x.at(length + 1).edit < y.at(length + 1).edit


Best = tuple[int, Way] | None


def _better(new: Best, old: Best) -> Best:
    if new is None or old is None:
        return new or old
    if new[0] != old[0]:
        return min(new, old, key=lambda b: b[0])
    return new if earlier(new[1], old[1]) else old


def _inserted(best: list[Best]) -> list[Best]:
    """The best ways after any number of insertions; two in a row lead from every state to every state they can."""
    for _ in range(2):
        out = list(best)
        for state, found in enumerate(best):
            if found is not None:
                after = NEXT[state, WANTED[state][0]]
                out[after] = _better((found[0] + INSERT_COST, Way(found[1], INSERT)), out[after])
        best = out
    return best


def _message(best: list[Best], initial: str, bad: bool, truncated: bool) -> list[Best]:
    """The best ways after one more message, insertions not counted."""
    out: list[Best] = [None] * len(STATES)
    for state, found in enumerate(best):
        if found is None:
            continue
        cost, way = found
        out[state] = _better((cost + DELETE_COST, Way(way, DELETE)), out[state])
        if bad:
            continue
        after = NEXT.get((state, initial))
        if after is not None:
            out[after] = _better((cost + truncated * TRUNCATED_COST, Way(way, KEEP)), out[after])
        after = NEXT[state, WANTED[state][0]]
        out[after] = _better((cost + REROLE_COST + truncated * TRUNCATED_COST, Way(way, REROLE)), out[after])
    return out


Ends = list[tuple[int, str] | None]


def _ways(messages: list[tuple[str, bool, bool]], start: int) -> Ends:
    best: list[Best] = [None] * len(STATES)
    best[start] = (0, Way(None, ""))
    best = _inserted(best)
    for message in messages:
        best = _inserted(_message(best, *message))
    return [None if b is None else (b[0], b[1].edits()) for b in best]


def chained(before: Ends, part: list[Ends]) -> Ends:
    """``before`` prolonged by a part of which the ways between all states are known."""
    out: Ends = [None] * len(STATES)
    for state, found in enumerate(before):
        if found is not None:
            for after, more in enumerate(part[state]):
                if more is not None:
                    new = (found[0] + more[0], found[1] + more[1])
                    out[after] = new if out[after] is None else min(out[after], new)
    return out


def ways(messages: list[tuple[str, bool, bool]], start: int, held: int = HELD) -> Ends:
    """Cost and edits of the best way from ``start`` to each state over (initial, must go, truncated).

    The ways of at most ``held`` messages are linked at a time; parts are chained.
    """
    best = _ways(messages[:held], start)
    for at in range(held, len(messages), held):
        best = chained(best, [_ways(messages[at:at + held], state) for state in STATES])
    return best


def chosen(best: Ends) -> tuple[int, str]:
    """The best way that ends in an accepted state."""
    return min(best[state] for state in ACCEPTED if best[state] is not None)


class Replay:
    """Applies edits to messages, one after the other: gives (edit, role, text) of each repaired message."""

    def __init__(self, edits: str) -> None:
        self.edits, self.at, self.state = edits, 0, START

    def _add(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        self.state = NEXT[self.state, role[:1]]
        return edit, role, text

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """What is inserted here."""
        while self.edits[self.at:self.at + 1] == INSERT:
            self.at += 1
            yield self._add(INSERT, WANTED[self.state], "")

    def message(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """What comes of the next message, with the insertions before it."""
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit != DELETE:
            yield self._add(edit, role if edit == KEEP else WANTED[self.state], text)


def digest(audit: str, messages: list[tuple[str, str]]) -> str:
    """SHA-256 of the repaired messages as ``role:text``, joined by newlines."""
    replay = Replay(audit)
    said = [x for role, text in messages for x in replay.message(role, text)] + list(replay.inserted())
    return hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in said).encode()).hexdigest()


# ---------------------------------------------------------------- messages as rows

def damaged(messages: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text) with faults put in, by a checksum of ``conv_id:turn``, and ``copies``.

    Nulls count as one space. ``copies`` is 0 for a message that is dropped, 2 for one that is repeated, else 1.
    """
    def said(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(said("text"), f"[{ENDS}]", "")) \
        .otherwise(said("text"))
    return messages.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(said("role")).alias("role"),
                           text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))


def _facts(messages: DataFrame) -> DataFrame:
    """Each distinct message of a conversation and turn once, with ``copies`` and its faults.

    ``seen``: role and text stand in the conversation before. The first place of a role and text is found by
    an aggregate and looked up by place, so that neither a long conversation nor an often repeated text is gathered.
    """
    keys = [F.coalesce(F.col(c), F.lit(0)).alias(f"{c}_key") for c in ("conv_id", "turn")]
    known = [F.col(c).isNotNull().cast("int").alias(f"{c}_known") for c in ("conv_id", "turn")]
    place = ["conv_id_known", "conv_id_key", "turn_known", "turn_key"]
    rows = messages.select(*known, *keys, *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
                           "copies").withColumn("said", F.unhex(F.sha2("text", 256)))
    once = written(rows.groupBy(*place, "role", "said").agg(
        F.sum("copies").cast("long").alias("copies"), F.first("text").alias("text")), "messages")
    firsts = once.where("copies > 0").groupBy("conv_id_known", "conv_id_key", "role", "said").agg(
        F.min(F.struct("turn_known", "turn_key")).alias("place")).select(
            "conv_id_known", "conv_id_key", "role", "said", "place.*").withColumn("is_first", F.lit(True))
    visible = F.col("text").rlike(VISIBLE)
    ended = F.col("text").rlike(rf"[{ENDS}][\x20\x09-\x0D]*\z")
    return once.join(firsts, [*place, "role", "said"], "left").select(
        *place, "role", "text", "copies", (~visible).alias("blank"), F.col("is_first").isNull().alias("seen"),
        (visible & ~ended).alias("cut"))


PART = ("conv_id_known int, conv_id_key long, task long, done boolean, n long, low long, high long, turns long, "
        "blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, "
        "sha string, ways array<array<struct<cost: long, audit: string>>>")


class _Part:
    """What is counted of the messages of one conversation that a task reads."""

    def __init__(self, key: tuple[int, int], hold: bool) -> None:
        self.key, self.hold = key, hold
        self.flags: list[tuple[str, bool, bool]] = []
        self.said: list[tuple[str, str]] = []
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, copies: int, blank: bool, seen: bool, cut: bool) -> None:
        if copies and turn is not None and turn != self.turn:
            self.turn, self.high, self.turns = turn, turn, self.turns + 1
            self.low = turn if self.low is None else self.low
        for copy in range(copies):
            again = not blank and (seen or copy > 0)
            short = cut and not blank and not again
            self.blank += blank
            self.duplicate += again
            self.truncated += short
            if self.flags:
                self.illegal += self.flags[-1][0] + role[:1] not in LEGAL
            self.flags.append((role[:1], blank or again, short))
            if self.hold:
                self.said.append((role, text))

    def row(self, task: int, whole: bool) -> tuple:
        cost = audit = sha = between = None
        if whole:
            cost, audit = chosen(ways(self.flags, START))
            sha = digest(audit, self.said)
        else:
            between = [[None if w is None else {"cost": w[0], "audit": w[1]} for w in ways(self.flags, state)]
                       for state in STATES]
        ends = (self.flags[0][0], self.flags[-1][0]) if self.flags else (None, None)
        return (*self.key, task, whole, len(self.flags), self.low, self.high, self.turns, self.blank, self.duplicate,
                self.truncated, self.illegal, *ends, cost, audit, sha, between)


#: Sorts before every turn.
_AUDIT = -1
_PLACE = ["conv_id_known", "conv_id_key", "turn_known", "turn_key", "role", "text"]


def parts(facts: DataFrame) -> DataFrame:
    """Rows (``PART``): one for each conversation and task; ``done`` where the task has seen all of it.

    Tasks hold ranges of the sorted messages; the first and the last conversation of a task may have
    more messages in the neighbouring ones.
    """
    kinds = pa.schema([("conv_id_known", pa.int32()), ("conv_id_key", pa.int64()), ("task", pa.int64()),
                       ("done", pa.bool_()), *[(c, pa.int64()) for c in (
                           "n", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal")],
                       ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
                       ("sha", pa.string()), ("ways", pa.list_(pa.list_(pa.struct([("cost", pa.int64()),
                                                                                  ("audit", pa.string())]))))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, out = None, True, []
        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch.column("task")[0].as_py()
            for row in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id_known", "conv_id_key", "turn_known", "turn_key", "role", "text", "copies", "blank", "seen",
                    "cut"))):
                key = row[:2]
                if part is None or part.key != key:
                    if part is not None:
                        out.append(part.row(task, not first))
                        first = False
                    # a task's first conversation is not finished here, so its texts need not be held
                    part = _Part(key, hold=not first)
                part.add(row[3] if row[2] else None, *row[4:])
            if len(out) > 1000:
                yield batch_of(out)
                out = []
        if part is not None:
            out.append(part.row(task, False))
        if out:
            yield batch_of(out)

    dealt = facts.repartitionByRange("conv_id_known", "conv_id_key", "turn_known", "turn_key", "role") \
        .sortWithinPartitions(*_PLACE)
    return dealt.withColumn("task", F.spark_partition_id().cast("long")).mapInArrow(run, PART)


def joined(open_parts: DataFrame) -> DataFrame:
    """The conversations of ``open_parts``, their parts in order: counts, cost and edits, without the digest."""
    def join(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["task"])
        best: list = [None] * len(STATES)
        best[START] = (0, "")
        total = dict.fromkeys(("n", "turns", "blank", "duplicate", "truncated", "illegal"), 0)
        low = high = last = None
        for row in rows:
            best = chained(best, [[None if w is None else (w["cost"], w["audit"]) for w in of] for of in row["ways"]])
            for name in total:
                total[name] += row[name]
            # a turn on both sides of an edge is one
            total["turns"] -= high is not None and row["low"] == high
            low, high = row["low"] if low is None else low, row["high"] if row["high"] is not None else high
            if row["n"]:
                total["illegal"] += last is not None and last + row["first"] not in LEGAL
                last = row["last"]
        cost, audit = chosen(best)
        return pa.table({"conv_id_known": pa.array([key[0].as_py()], pa.int32()), "conv_id_key": [key[1].as_py()],
                         **{c: pa.array([v], pa.int64()) for c, v in total.items()}, "low": pa.array([low], pa.int64()),
                         "high": pa.array([high], pa.int64()), "cost": pa.array([cost], pa.int64()), "audit": [audit]})

    return open_parts.groupBy("conv_id_known", "conv_id_key").applyInArrow(
        join, "conv_id_known int, conv_id_key long, n long, turns long, blank long, duplicate long, truncated long, "
              "illegal long, low long, high long, cost long, audit string")


def _replayed(facts: DataFrame, audits: DataFrame, emit: Callable[[], _Emit], schema: str) -> DataFrame:
    """The conversations of ``audits(conv_id_known, conv_id_key, audit)`` repaired, their messages streamed in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, replay = emit(), None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (
                "conv_id_known", "conv_id_key", "turn_known", "role", "text", "copies")]
            for known, conv, turn_known, role, text, copies in zip(*columns):
                if turn_known == _AUDIT:
                    if replay is not None:
                        out.add(replay.inserted())
                    replay = Replay(text)
                    out.start((known, conv))
                else:
                    for _ in range(copies):
                        out.add(replay.message(role, text))
            yield from out.flushed()
        if replay is not None:
            out.add(replay.inserted())
        yield from out.flushed(True)

    # the edits stand as a first message before those of their conversation
    keys = ["conv_id_known", "conv_id_key"]
    edits = audits.select(*keys, F.lit(_AUDIT).alias("turn_known"), F.lit(0).cast("long").alias("turn_key"),
                          F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    rows = facts.select(*_PLACE, "copies").join(audits.select(*keys), keys, "left_semi").unionByName(edits)
    return rows.repartition(*keys).sortWithinPartitions(*_PLACE).mapInArrow(run, schema)


class _Digests:
    """Emits (conv_id_known, conv_id_key, sha)."""

    def __init__(self) -> None:
        self.key, self.rows = None, []

    def _end(self) -> None:
        if self.key is not None:
            self.rows.append((*self.key, self.sha.hexdigest()))

    def start(self, key: tuple[int, int]) -> None:
        self._end()
        self.key, self.sha, self.mark = key, hashlib.sha256(), ""

    def add(self, messages: Iterator[tuple[str, str, str]]) -> None:
        for _, role, text in messages:
            self.sha.update(f"{self.mark}{role}:{text}".encode())
            self.mark = "\n"

    def flushed(self, ended: bool = False) -> Iterator[pa.RecordBatch]:
        if ended:
            self._end()
        rows, self.rows = self.rows, []
        if rows:
            known, conv, sha = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(known, pa.int32()), pa.array(conv, pa.int64()), pa.array(sha)],
                                             names=["conv_id_known", "conv_id_key", "sha"])


class _Messages:
    """Emits (conv_id, place, edit, role, text)."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def start(self, key: tuple[int, int]) -> None:
        self.conv, self.place = key[1] if key[0] else None, 0

    def add(self, messages: Iterator[tuple[str, str, str]]) -> None:
        for message in messages:
            self.place += 1
            self.rows.append((self.conv, self.place, *message))

    def flushed(self, ended: bool = False) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["conv_id", "place", "edit", "role", "text"])


_Emit = _Digests | _Messages


# ---------------------------------------------------------------- the operator

def repaired(messages: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n) for each conversation
    of ``messages(conv_id, turn, role, text, copies)``; ``copies`` says how often a message stands there in a row.

    Messages are read by turn, nulls first, then role, then text. The first fault of a message counts: blank,
    duplicate (role and text seen earlier in the conversation), truncated (the last visible character is none of
    ``.!?``). A message is kept (cost 0), given the role user or assistant (2), or deleted (3), as blank and duplicate ones
    must be; empty messages of either role are inserted (2); a truncated message that stays adds 1. ``audit`` has the
    initials (K, R, D, I) of the cheapest edits after which the roles' initials are ``(s?(ua)+)?``, of equally
    cheap ones the first in ASCII order. gaps: turns missing between the lowest and the highest; illegal: adjacent
    initials other than su, ua, au.

    A conversation of which no message is left has zeros, no edits and the digest of nothing. A null conv_id is a
    conversation of its own; null turns count for no gap. Rows that repeat all of a message stand next to each other. Other
    columns play no role. An empty table gives no rows.
    """
    prepared(messages.sparkSession)
    facts = written(_facts(messages), "message-faults")
    found = written(parts(facts), "conversation-parts")
    # at most two conversations a task are open
    ends = written(joined(found.where("NOT done")), "open-conversations")
    shas = _replayed(facts, ends, _Digests, "conv_id_known int, conv_id_key long, sha string")
    columns = ["conv_id_known", "conv_id_key", "n", "low", "high", "turns", "blank", "duplicate", "truncated",
               "illegal", "cost", "audit", "sha"]
    both = found.where("done").select(*columns).unionByName(
        ends.join(shas, ["conv_id_known", "conv_id_key"], "left").select(*columns))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return both.select(F.when(F.col("conv_id_known") == 1, F.col("conv_id_key")).alias("conv_id"),
                       gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                       F.col("sha").alias("repaired_sha256"), "n")


def repaired_messages(messages: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the messages of ``messages`` after the edits of ``audits(conv_id, audit)``,
    as ``repaired`` gives them; place counts from 1. Conversations without messages give none."""
    prepared(messages.sparkSession)
    keyed = audits.select(F.col("conv_id").isNotNull().cast("int").alias("conv_id_known"),
                          F.coalesce("conv_id", F.lit(0)).alias("conv_id_key"), "audit")
    return _replayed(_facts(messages), keyed, _Messages,
                     "conv_id long, place long, edit string, role string, text string")
