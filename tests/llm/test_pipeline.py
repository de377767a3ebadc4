"""Stages of the pipeline against brute force, and the toxicity of held-back rows of the tables."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
from penstock.llm import queries
from test_dedup import groups_by_hand, lines_by_hand

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)


def mixed_rows():
    draw = random.Random(4)
    shared = [f"a passage number {i} that several documents repeat" for i in range(5)]
    rows = []
    for i in range(40):
        text = "\n".join(draw.choice(shared) if draw.random() < 0.4 else f"own words {draw.random()} of {i} " * 5
                         for _ in range(draw.randint(1, 5)))
        rows.append((i, text))
        if i % 4 == 0:
            rows.append((100 + i, text + " more"))
    return rows + [(1, rows[1][1]), (None, "null"), (None, "null"), (None, None), (300, None), (301, ""), (302, "")]


def test_line_stage(spark):
    rows = mixed_rows()
    out = corpus_pipeline.drop_repeated_lines(spark, documents(spark, rows), "")
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    want = sorted(((d, t, len(t)) for d, t, _, _ in lines_by_hand(rows)), key=str)
    assert sorted((tuple(r) for r in out.select("doc_id", "text", "n_chars").collect()), key=str) == want


def test_near_duplicate_stage(spark):
    rows = mixed_rows()
    out = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "")
    firsts = {d for d, _, _, kept in groups_by_hand(rows, 5) if kept}
    want = sorted([(d, min(t for e, t in rows if e == d)) if d not in (300, 301, 302) else (d, dict(rows)[d])
                   for d in firsts] + [(None, None), (None, "null")], key=str)
    assert sorted((tuple(r) for r in out.select("doc_id", "text").collect()), key=str) == want


def test_toxicity_of_held_back_rows(spark):
    """On sf0.01 there are few toxic rows to learn from; clean ones must be left alone, and most toxic ones found."""
    sf_dir = "/root/testdata/sf0.01"
    said = {r["doc_id"]: r["predicted"] for r in queries.op2_toxicity(spark, sf_dir).collect()}
    labels = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    held = [(d, x) for d, x in labels if zlib.crc32(str(d).encode()) % 5 == 0]
    toxic, clean = ([said[d] for d, x in held if x == label] for label in (1, 0))
    assert sum(toxic) * 2 >= len(toxic)
    assert sum(clean) * 50 <= len(clean)
