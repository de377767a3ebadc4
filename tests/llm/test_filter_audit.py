"""The filter audit against its SQL, and its potential against plain Shapley values."""

from __future__ import annotations

import itertools
import random
import re
from math import factorial

import numpy as np
from penstock.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failing(rows):
    """The letters that each (doc_id, part, text) fails."""
    out = []
    for doc, _, text in rows:
        text = text or ""
        words = WORD.findall(text)
        found = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        found += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        found += "E" * (doc is not None and any(d is not None and d < doc and (t or "") == text for d, _, t in rows))
        out.append(found)
    return out


def by_hand(rows, good, toxic):
    out, fails = {}, failing(rows)
    for part in {p or "" for _, p, _ in rows}:
        inside = [(r[0], f) for r, f in zip(rows, fails) if (r[1] or "") == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [(d, f) for d, f in inside if letter in f and not before & set(f)]
                removed_by[letter] += len(gone)
                out[part, order, step] = [
                    sum(not set(f) & set(order[:step]) for _, f in inside), len(gone),
                    sum(letter in f for _, f in inside) - len(gone), sum(f == letter for _, f in inside),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


def test_odd_texts(spark, odd_docs, no_docs, odd_rows):
    more = [(20, "Ten words here, " * 30 + "#", "x"), (21, "Ten words here, " * 30 + "#", None), (22, None, None),
            (23, "ALL CAPS " * 60, "x"), (None, None, "x"), (24, " ".join(f"w{i}" for i in range(70)), "x")]
    rows = [(i, x, t) for i, t, x in [*odd_rows, *more]]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (5, 0, 0), (21, None, 1), (None, 1, 1), (23, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: list(r)[3:] for r in filter_audit.filter_audit(docs, labels).collect()}
    assert got == by_hand(rows, good={4, 5, 23}, toxic={5, 21, 23})
    assert filter_audit.filter_audit(no_docs, labels).count() == 0


def test_potential_gives_shapley_values():
    draw = random.Random(1)
    for players in range(1, 6):
        value = np.array([0] + [draw.randint(0, 50) for _ in range((1 << players) - 1)])
        want = [0] * players
        for order in itertools.permutations(range(players)):
            before = 0
            for i in order:
                want[i] += int(value[before | 1 << i] - value[before])
                before |= 1 << i
        assert filter_audit.shapley_sums(value) == want
        assert sum(want) == factorial(players) * value[-1]
