"""The n-gram Jaccard join against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from penstock.llm import ngram_join, queries
from test_dedup import groups_by_hand


def expected(rows, words=3, percent=90):
    return sorted((r[:3] for r in groups_by_hand(rows, words, percent)), key=str)


def got(frame, **options):
    return sorted((tuple(r) for r in ngram_join.ngram_join(frame, **options).collect()), key=str)


def family(draw, count, size=60, changes=4, pool=400):
    """Texts that differ from one base in a few words each: similarities on both sides of the bound."""
    base = [f"w{draw.randrange(pool)}" for _ in range(size)]
    out = []
    for _ in range(count):
        text = list(base)
        for _ in range(draw.randint(0, changes)):
            text[draw.randrange(size)] = f"w{draw.randrange(pool)}"
        out.append(" ".join(text))
    return out


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in queries.op12_ngram_tries(spark, sf_dir).collect()), key=str)
    assert found == expected(rows)


@pytest.mark.parametrize("bounds", [{}, {"sets": 8}, {"grams": 400}])
def test_families_whole_and_in_blocks(spark, bounds):
    draw = random.Random(11)
    texts = family(draw, 50) + family(draw, 40, size=200, changes=9) + family(draw, 20, size=12, changes=1) + [
        " ".join(f"u{draw.random()}" for _ in range(draw.randint(1, 90))) for _ in range(30)]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    found = got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **bounds)
    assert found == expected(rows)
    groups = {r[2] for r in found}
    assert 30 < len(groups) < len(rows) - 20


def test_odd_texts(odd_docs, no_docs, odd_rows):
    assert got(odd_docs) == expected([r[:2] for r in odd_rows])
    assert got(no_docs) == []


def test_blocks_find_every_link_of_two_sets():
    """Sets that just reach the bound agree on a part, in some class they share, at every size."""
    draw, join = np.random.default_rng(5), ngram_join.Join()
    for size in [*range(9, 80), 150, 399, 1000, 5000]:
        for _ in range(4):
            differ = join.differing(size)
            both = draw.integers(0, 2**63, size + differ, dtype=np.uint64)
            gone = draw.integers(0, differ + 1)
            a, b = np.unique(both[:size]), np.unique(np.concatenate([both[gone:size], both[size:size + differ - gone]]))
            common = len(np.intersect1d(a, b))
            if 100 * common < join.percent * (len(a) + len(b) - common):
                continue
            assert len(np.intersect1d(ngram_join.agreements(a, join), ngram_join.agreements(b, join)))


def test_a_block_links_like_all_pairs():
    draw, join = random.Random(2), ngram_join.Join(percent=70)
    for _ in range(60):
        sets = [np.array(sorted(draw.sample(range(30), draw.randint(1, 20)))) for _ in range(draw.randint(1, 12))]
        side = np.array([draw.choice([1, 2]) for _ in sets]) if draw.random() < 0.5 else np.zeros(len(sets), int)
        offsets = np.cumsum([0, *map(len, sets)])
        up = list(range(len(sets)))

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        def joined(pairs):
            up[:] = range(len(sets))
            for x, y in pairs:
                up[root(x)] = root(y)
            return [[root(x) == root(y) for x in range(len(sets))] for y in range(len(sets))]

        links = [(x, y) for x in range(len(sets)) for y in range(x) if (side[x] != side[y] or not side[x]) and 100 * len(
            np.intersect1d(sets[x], sets[y])) >= 70 * len(np.union1d(sets[x], sets[y]))]
        found = ngram_join.linked(np.concatenate(sets), offsets, side, join)
        assert set(map(tuple, map(sorted, found))) <= {tuple(sorted(p)) for p in links}
        assert joined(found) == joined(links) and len(found) <= len(sets) - 1
