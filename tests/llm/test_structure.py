"""Structure repair of conversations against a brute-force version."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from penstock.llm import queries, structure
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def damaged_by_hand(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
    return out


def cheapest(messages):
    """All edits by rising cost, then initials: the first whose roles read as they should."""
    queue, seen = [(0, "", 0, "")], set()
    while queue:
        cost, audit, at, roles = heapq.heappop(queue)
        if at == len(messages) and GRAMMAR.match(roles):
            return cost, audit
        # what follows depends on the state only
        state = (at, roles[-1:] if roles else "")
        if (state, cost, audit) in seen or not re.match(r"s?(ua)*u?\Z", roles):
            continue
        seen.add((state, cost, audit))
        if not re.search("II\\Z", audit):
            for r in "ua":
                heapq.heappush(queue, (cost + 2, audit + "I", at, roles + r))
        if at < len(messages):
            role, bad, cut = messages[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, roles))
            if not bad:
                heapq.heappush(queue, (cost + cut, audit + "K", at + 1, roles + (role[:1] or "?")))
                for r in "ua":
                    heapq.heappush(queue, (cost + 2 + cut, audit + "R", at + 1, roles + r))


def by_hand(rows):
    found = {}
    for conv, kept in damaged_by_hand(rows).items():
        turns = [t for t, _, _ in kept if t is not None]
        faults, said = [], set()
        for _, role, text in kept:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in said else \
                "truncated" if visible[-1] not in ".!?" else ""
            said.add((role, text))
            faults.append(fault)
        cost, audit = cheapest([(m[1], f in ("blank", "duplicate"), f == "truncated") for m, f in zip(kept, faults)])
        out, at, last = [], 0, ""
        for edit in audit:
            wanted = "assistant" if last == "u" else "user"
            if edit == "I":
                out.append((wanted, ""))
            else:
                if edit != "D":
                    out.append((kept[at][1] if edit == "K" else wanted, kept[at][2]))
                at += 1
            last = out[-1][0][:1] if out else ""
        initials = [m[1][:1] for m in kept]
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())
    return found


def operated(frame):
    got = {r[0]: tuple(r)[1:9] for r in structure.repaired(structure.damaged(frame)).collect()}
    return got


def rows_at_random(seed, convs=60):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Yes.", "No", " \t", "", "Why?", None, "Go on!", "a.\n ", "x", "ü."]
    rows = []
    for conv in [*range(convs), None]:
        for _ in range(draw.randint(0, 7)):
            turn = draw.choice([None, *range(9)])
            rows.append((conv, turn, draw.choice(roles), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations_at_random(spark, seed):
    rows = rows_at_random(seed)
    assert operated(spark.createDataFrame(rows, SCHEMA).repartition(3)) == by_hand(rows)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = by_hand([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    got = {r["conv_id"]: r for r in queries.op11_structure_audit(spark, sf_dir).collect()}
    assert len(got) == len(want)
    for conv, row in got.items():
        assert (row["gaps"], row["blank"], row["duplicate"], row["truncated"], row["illegal"], row["cost"],
                row["audit"], row["repaired_sha256"]) == want[conv]


def test_a_conversation_over_many_tasks(spark):
    """One conversation holds most messages, one of its texts most of these."""
    draw = random.Random(5)
    rows = [(7, i, draw.choice(["user", "assistant"]), draw.choice(["So.", f"Text {i}", f"Text {i}."]))
            for i in range(400)] + [(c, t, "user", f"{t}?") for c in (6, 8) for t in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    facts = structure._facts(structure.damaged(frame))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = structure.parts(facts).where("conv_id_key = 7").count()
        assert tasks > 2
        assert operated(frame) == by_hand_long(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def by_hand_long(rows):
    """As ``by_hand``, with the edits found by plain strings, state by state."""
    found = {}
    for conv, kept in damaged_by_hand(rows).items():
        said, messages = set(), []
        for _, role, text in kept:
            blank, again = not text.strip(), (role, text) in said
            said.add((role, text))
            messages.append((role, blank or again, not (blank or again) and text.strip()[-1] not in ".!?"))
        after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

        def inserted(best):
            for _ in range(2):
                for state, (cost, audit) in list(best.items()):
                    to = "a" if state == "u" else "u"
                    best[to] = min(best.get(to, (10**9, "")), (cost + 2, audit + "I"))
            return best

        best = inserted({"": (0, "")})
        for role, bad, cut in messages:
            new = {}
            for state, (cost, audit) in best.items():
                moves = [(state, cost + 3, "D")]
                if not bad:
                    moves.append(("a" if state == "u" else "u", cost + 2 + cut, "R"))
                    if (state, role[:1]) in after:
                        moves.append((after[state, role[:1]], cost + cut, "K"))
                for to, price, edit in moves:
                    new[to] = min(new.get(to, (10**9, "")), (price, audit + edit))
            best = inserted(new)
        cost, audit = min(best[s] for s in ("", "a") if s in best)
        plain = operated_by(audit, kept)
        turns = [t for t, _, _ in kept]
        found[conv] = (max(turns) - min(turns) + 1 - len(set(turns)), sum(not m[2].strip() for m in kept),
                       sum(m[1] for m in messages) - sum(not m[2].strip() for m in kept), sum(m[2] for m in messages),
                       sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept)),
                       cost, audit, hashlib.sha256("\n".join(plain).encode()).hexdigest())
    return found


def operated_by(audit, kept):
    out, at, last = [], 0, ""
    for edit in audit:
        wanted = "assistant" if last == "u" else "user"
        if edit == "I":
            out.append(f"{wanted}:")
        else:
            if edit != "D":
                out.append(f"{kept[at][1] if edit == 'K' else wanted}:{kept[at][2]}")
            at += 1
        last = out[-1][:1] if out else ""
    return out


def test_parts_chain_to_the_whole():
    draw = random.Random(9)
    messages = [(draw.choice("usax"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(60)]
    for start in structure.STATES:
        assert structure.ways(messages, start) == structure.ways(messages, start, held=7)


def test_ways_compare_like_strings():
    draw = random.Random(3)
    made = [("", structure.Way(None, ""))]
    for _ in range(300):
        text, way = draw.choice(made[-40:])
        edit = draw.choice("DK")
        made.append((text + edit, structure.Way(way, edit)))
    for (a, x), (b, y) in itertools.product(made[::7], made[::5]):
        assert x.edits() == a and structure.earlier(x, y) == (a < b)
        assert structure.common(x, y) == len(__import__("os").path.commonprefix([a, b]))


def test_equal_hashes_are_not_believed():
    root = structure.Way(None, "")
    x, y = structure.Way(root, "K"), structure.Way(root, "D")
    y.hash = x.hash
    assert not structure.same(x, y) and structure.earlier(y, x)


def test_messages_come_back_repaired(spark):
    rows = rows_at_random(4)
    messages = structure.damaged(spark.createDataFrame(rows, SCHEMA))
    audits = structure.repaired(messages)
    out = structure.repaired_messages(messages, audits)
    said = out.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("said"))
    texts = said.select("conv_id", F.sha2(F.array_join(F.transform(
        "said", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n"), 256).alias("sha"))
    got, want = dict(map(tuple, texts.collect())), {r["conv_id"]: r["repaired_sha256"] for r in audits.collect()}
    assert got and all(want[c] == sha for c, sha in got.items())
    empty = hashlib.sha256(b"").hexdigest()
    assert {c for c, sha in want.items() if sha != empty} == set(got)


def test_no_messages(spark):
    assert operated(spark.createDataFrame([], SCHEMA)) == {}


def test_long_text_and_other_columns(spark):
    rows = [(1, 0, "user", "word " * 200_000, 5), (1, 1, "assistant", "Fine.", 6)]
    frame = spark.createDataFrame(rows, SCHEMA + ", cost int")
    got = structure.repaired(structure.damaged(frame)).first()
    assert got["conv_id"] == 1 and got["cost"] == by_hand([r[:4] for r in rows])[1][5]
