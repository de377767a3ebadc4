"""Line de-duplication, components and near duplicates against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from penstock.llm import line_dedup, near_dup, text_bytes
from penstock.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def lines_by_hand(rows, least=20, min_docs=3):
    def key(line):
        return line.translate(LOWER).strip(BLANKS)
    holders = defaultdict(set)
    for doc, text in rows:
        if doc is not None:
            for k in {key(x) for x in (text or "").split("\n")}:
                if len(k) >= least:
                    holders[k].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def sets_by_hand(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def groups_by_hand(rows, size, percent=80):
    sets = [(doc, sets_by_hand(text, size)) for doc, text in rows]
    up = {doc: doc for doc, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return sorted(((doc, len(x), None if doc is None else root(doc), None if doc is None else root(doc) == doc)
                   for doc, x in sets), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_lines_of_odd_texts(odd_docs, no_docs, odd_rows):
    got = line_dedup.line_dedup(odd_docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "score", "component_id", "n_lines", "n_dropped"]
    assert found(got.select("doc_id", "text", "n_lines", "n_dropped")) == lines_by_hand([r[:2] for r in odd_rows])
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_lines_at_random(spark):
    rng = random.Random(3)
    pool = [f"  Shared Line number {i} of the pool" + " " * (i % 3) for i in range(12)] + ["short", "", "\x0b é" * 12]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < .5 else f"own line {rng.random()} of {i}"
                          for _ in range(rng.randint(1, 9)))) for i in range(300)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert found(got) == lines_by_hand(rows)


def test_every_drop_comes_from_a_probe_of_copied_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", 3)
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 16)
    told, probe, copies = [], line_dedup.probed, line_dedup.copies

    def probed(*given):
        out = probe(*given)
        told.extend(tuple(r) for r in out.collect())
        return out

    def copied(*given):
        out = copies(*given)
        assert out.agg({"copies": "max"}).first()[0] > 1
        return out

    monkeypatch.setattr(line_dedup, "probed", probed)
    monkeypatch.setattr(line_dedup, "copies", copied)
    rows = [(i, f"the line that everybody holds\nan own line of document {i // 4}") for i in range(200)]
    got = found(line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == lines_by_hand(rows)
    assert len(told) == sum(r[3] for r in got) == 199 + 150


def test_rows_that_repeat_an_id_count_once(spark):
    line = "one line of more than twenty characters"
    rows = [(1, line), (1, line), (2, line), (3, "x\n" + line + " two"), (3, line + " two"), (4, line + " two"),
            (5, line + " two")]
    got = found(line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == lines_by_hand(rows)
    assert sum(r[3] for r in got) == 3


def test_perfect_hash_is_minimal():
    h1, h2 = (np.random.default_rng(s).integers(-2**63, 2**63, 50_000) for s in (1, 2))
    h1[:100] = 7
    made = line_dedup.PerfectHash(*line_dedup.build_hash(h1, h2))
    assert np.array_equal(np.sort(made.numbers(h1, h2)), np.arange(50_000))
    assert made.bits.size < 6 * 50_000


@pytest.mark.parametrize("share", [16, 1 << 14])
def test_components(spark, monkeypatch, share):
    monkeypatch.setattr("penstock.llm.components.SHARE", share)
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randint(0, 60), 100 + rng.randint(0, 60)) for _ in range(50)]
    links += [(500, 500 + i) for i in range(1, 80)] + [(5, 5), (None, 3)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        if a is not None and a != b:
            p, q = sorted((root(a), root(b)))
            up[q] = p
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert found(got) == sorted(((x, root(x)) for x in up), key=str)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_groups_of_odd_texts(odd_docs, no_docs, odd_rows):
    assert found(near_dup.near_duplicates(odd_docs, words=4)) == groups_by_hand([r[:2] for r in odd_rows], 4)
    assert near_dup.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("size", [4, 5])
def test_few_words_alone_in_a_slice(spark, size):
    for count in range(7):
        hashes, owner = text_bytes.shingle_hashes(np.arange(count, dtype=np.uint64), np.zeros(count, np.int64), size)
        assert len(hashes) == len(owner) == (max(1, count - size + 1) if count else 0)
    long = "a long text " * 100_000
    assert len(long) > text_bytes.SLICE_BYTES
    texts = [long, "two words", long + "more"]
    assert list(map(len, text_bytes.shingle_sets(pa.array(texts), size))) == [len(sets_by_hand(t, size)) for t in texts]
    for count in range(1, 7):
        rows = [(1, " ".join(f"w{i}" for i in range(count)))]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(near_dup.signed(frame, size).select("doc_id", "n_shingles")) == [(1, max(1, count - size + 1))]


def near_copies(seed, groups, copies, length, changes):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, changes)):
                words[rng.randrange(length)] = f"x{rng.randint(0, 10**6)}"
            rows.append((len(rows) * 7 % 100_003, " ".join(words)))
    return rows


def test_groups_at_random(spark):
    rows = near_copies(1, 25, 8, 120, 5)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=5)
    assert found(got) == groups_by_hand(rows, 5)


def test_one_large_group_through_small_nodes(spark):
    """Nodes far smaller than the group: levels, and blocks where no function splits any more."""
    rows = near_copies(2, 1, 160, 100, 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_dup.near_duplicates(docs, words=4, node=24)) == groups_by_hand(rows, 4)


def test_blocks_compare_every_pair(spark, monkeypatch):
    """A group whose minima are all alike cannot be split."""
    monkeypatch.setattr(near_dup, "_minima", lambda shingles: np.zeros(near_dup.FUNCTIONS, np.uint32))
    plan = near_dup.Plan(node=8, depth=1, trees=2)
    rows = spark.createDataFrame([(i, 0, 5) for i in range(40)], "doc long, tree int, node long")
    counts = spark.createDataFrame([(5, 40)], "node long, count long")
    held = near_dup._blocks(rows, counts, plan).collect()
    met = defaultdict(list)
    for r in held:
        met[r["node"]].append((r["doc"], r["side"]))
    pairs = {(a, b) for members in met.values() for a, s in members for b, t in members if a < b and (s != t or s == 0)}
    assert pairs == {(a, b) for a in range(40) for b in range(a + 1, 40)}
    assert max(map(len, met.values())) < 24


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs whose similarity is just above 80 percent are all found."""
    rows = []
    for g in range(150):
        words = [f"g{g}w{i}" for i in range(103)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:97] + [f"g{g}x{i}" for i in range(11)]))]
    want = groups_by_hand(rows[:40], 4)
    got = found(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4))
    assert sum(not r[3] for r in want) == 20
    assert sum(not r[3] for r in got) == 150


def test_pairs_within_a_boilerplate_family(spark):
    """Sets that share 85 of 100 shingles with every other one (J 0.74), among them pairs at 0.8; nodes are split far
    deeper than 20 trees allow for."""
    base = " ".join(f"b{i}" for i in range(88))
    own = [[f"d{i}w{j}" for j in range(15)] for i in range(300)]
    for i in range(0, 100, 2):
        own[i + 1][:4] = own[i][:4]
    rows = [(i * 7 % 1009, f"{base} {' '.join(words)}") for i, words in enumerate(own)]
    want = groups_by_hand(rows, 4)
    assert sum(not r[3] for r in want) == 50
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4, node=16)
    assert found(got) == want


def test_sketches_turn_away_one_pair_in_a_million():
    from math import comb
    least = near_dup.Plan().least_matches()
    assert sum(comb(128, k) * .8 ** k * .2 ** (128 - k) for k in range(least)) < 2e-6
