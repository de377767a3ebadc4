"""Classifiers by held-out accuracy; rules, search and chat against SQL or brute force."""

from __future__ import annotations

import re
from collections import defaultdict

import __spark_entry__ as entry
import compare
import corpus_pipeline
import numpy as np
import pytest
from penstock.llm import chat, language, quality, queries, topk, toxicity
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", queries.ORACLE)
def test_against_sql(spark, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir)
    assert compare.differences(got, compare.duck(sf_dir), entry.oracle_sql()[name]) == []


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


# ---------------------------------------------------------------- toxicity

def test_misspelt_words_share_their_grams():
    rng = np.random.default_rng(0)
    clean = ["house", "river", "stone", "cloud", "green", "table", "light", "water", "bread", "paper"]
    def text(n, bad=()):
        words = list(rng.choice(clean, n))
        for w in bad:
            words.insert(int(rng.integers(0, n)), w)
        return " ".join(words)
    texts = [text(int(rng.integers(10, 200)), [["scumbag", "moronic"][i % 2]] if i < 150 else ()) for i in range(600)]
    labels = np.array([int(i < 150) for i in range(600)])
    model = toxicity.train(texts, labels, toxicity.Fit(epochs=15))
    def logits(*given):
        return [model.logits(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in given]
    assert min(logits(*[text(60, [w]) for w in ("scumbag", "scumbags", "moronics")])) > 0
    assert max(logits(*[text(60) for _ in range(20)], "", " ", text(5000))) < 0


def test_toxicity_of_odd_texts(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (8, 0), (None, 1), (9, None), (4, 1)], "doc_id long, toxic int")
    model = toxicity.fitted(odd_docs, labels)
    got = toxicity.toxicity(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    nothing = toxicity.fitted(no_docs, labels)
    assert {r["predicted"] for r in toxicity.toxicity(odd_docs, nothing).collect()} == {0}
    assert toxicity.toxicity(no_docs, model).count() == 0


# ---------------------------------------------------------------- language

def test_language_on_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = queries.op10_language_filters(spark, sf_dir).where("held_out").join(docs, "doc_id")
    right, count = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * count


def test_language_of_odd_texts(odd_docs, no_docs):
    filters = language.fitted(odd_docs)
    got = {r["doc_id"]: r for r in language.languages(odd_docs, filters).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 10)] == ["und"] * 4
    assert got[4]["lang_pred"] == "en" and got[9]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.fitted(no_docs)
    assert {r["lang_pred"] for r in language.languages(odd_docs, nothing).collect()} == {"und"}
    assert language.languages(no_docs, filters).count() == 0


def test_filters_hold_more_than_64_languages():
    counts = np.zeros((130, 1 << 12))
    for k in range(130):
        counts[k, 31 * k % 4096] = 1
    filters = language.built([f"l{k:03}" for k in range(130)], counts, language.Fit(codes=1 << 12, slots=1 << 14))
    for k in (0, 63, 64, 129):
        word = filters.containing(np.array([31 * k % 4096], np.uint32))
        assert filters._bits(word, k)[0] == 1
    assert filters.chance().max() < 1e-6


# ---------------------------------------------------------------- rules

def rules_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_rules_of_odd_texts(odd_docs, no_docs, odd_rows):
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality.quality(odd_docs).where("doc_id IS NULL OR doc_id <> 8").collect()
    want = [(i, *rules_by_hand(t)) for i, t, _ in odd_rows if i != 8]
    assert sorted(((r["doc_id"], *(r[c] for c in columns)) for r in got), key=str) == sorted(want, key=str)
    long = quality.quality(odd_docs).where("doc_id = 8").first()
    assert long["n_words"] == 120_000 and long["n_repeat_words"] == 120_000
    assert quality.quality(no_docs).count() == 0


def test_rules_use_no_python(spark, sf_dir):
    for name in ("op3_quality_rules", "op5_chat_quotes"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- search

def search_by_hand(rows, k):
    usable = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256 * x)) for x in v]))
    out = []
    for i, q in usable:
        if i % 2 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_search_of_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(60)]
    rows += [(100 + i, rows[4][1]) for i in range(8)] + [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]),
             (204, [float("nan")] * 4), (206, [float("inf")] * 4), (None, [1.0] * 4), (208, [1.0, 2.0]), (209, [3.0, 4.0]),
             (210, [0.0] * 4), (212, [5e5] * 4), (213, [-5e5] * 4)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = topk.top_k(frame.repartition(3), F.col("vec_id") % 2 == 0, 5)
    assert sorted(tuple(r) for r in got.collect()) == search_by_hand(rows, 5)
    assert topk.top_k(frame.where("false"), F.lit(True)).count() == 0


def test_search_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_VECTORS", 40)
    monkeypatch.setattr(topk, "SLICE_QUERIES", 30)
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 2 == 0, 7)
    assert sorted(tuple(r) for r in got.collect()) == search_by_hand(rows, 7)


def test_huge_components_stay_exact():
    held = topk.ApproximationFile(np.array([[2**40, 2**40], [2**40, 2**40 - 1], [1, 1]], np.int64))
    best = next(held.nearest(np.array([[2**40, 2**40]]), np.array([9]), np.array([1, 2, 3]), 2))
    assert best == [(2**81, 1), (2**81 - 2**40, 2)]


# ---------------------------------------------------------------- chat

MESSAGES = [
    (1, 0, "user", "Hello there\n\nHow do I bake bread?"), (1, 1, "assistant", "> how do I  bake BREAD?\nWith flour."),
    (1, 2, "user", "An unrelated thing"), (1, 3, "user", ">> How do I bake bread?\n> With flour.\n\nHow much flour?\n"),
    (1, 4, "assistant", "> An unrelated thing\nIndeed"), (1, 5, "user", "> never said\nHm"),
    (1, 6, "assistant", "> How much flour?\n\n> An unrelated thing\nA pound"), (2, 0, "user", "How do I bake bread?"),
    (2, 1, None, None), (2, 1, "user", "> How do I bake bread?"), (None, 0, "user", "> x"), (3, None, "user", "x"),
    (4, 0, "user", ""),
]


def replies_by_hand(rows):
    def parts(text):
        out, run, at = [], [], None
        for line in re.split("\r?\n", text or "") + [""]:
            marks = re.match(r"((?:\s*>)*)", line).group(1)
            level, rest = marks.count(">"), line[len(marks):].strip(chat.SPACES)
            if run and (not rest or level != at):
                out.append((at, re.sub(r"\s+", " ", " ".join(run).lower())))
                run = []
            if rest:
                at = level
                run.append(rest)
        return out
    said, links = defaultdict(list), {}
    for c, t, _, text in rows:
        if c is not None and t is not None:
            for level, passage in parts(text):
                if not level:
                    said[c, passage].append(t)
    for c, t, _, text in rows:
        if c is None or t is None:
            continue
        quoted = {}
        for level, passage in parts(text):
            if level:
                quoted[passage] = min(level, quoted.get(passage, level))
        origin = {p: min(said[c, p]) for p in quoted if said[c, p] and min(said[c, p]) < t}
        if quoted:
            first = [origin[p] for p, level in quoted.items() if level == 1 and p in origin]
            links[c, t] = (max(first or origin.values(), default=None), len(quoted), len(origin))
    def thread(c, t):
        while links.get((c, t), (None,))[0] is not None:
            t = links[c, t][0]
        return t
    return sorted(((c, t, *links.get((c, t), (None, 0, 0)), thread(c, t)) for c, t, _, _ in rows), key=str)


def test_replies(spark):
    rows = MESSAGES + [(9, i, "user", (f"> Message number {i - 1}\n" if i else "") + f"Message number {i}")
                       for i in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("body", F.lit(1))
    got = chat.chat(frame.repartition(4)).collect()
    assert sorted(((r["conv_id"], r["turn"], r["reply_to"], r["n_quotes"], r["n_linked"], r["thread"]) for r in got),
                  key=str) == replies_by_hand(rows)
    assert [r["turn"] for r in got if r["conv_id"] == 1] == [0, 1, 3, 6, 2, 4, 5]
    bodies = {(r["conv_id"], r["turn"]): r["body"] for r in got}
    assert bodies[1, 3] == "How much flour?" and bodies[4, 0] == ""
    assert chat.chat(frame.where("false")).count() == 0


PARTS = [
    (1, 0, "user", "First we knead. Then we wait.\nThen we bake\n\nAll of it twice?"),
    (1, 1, "assistant", "Nothing else\n\n>>> print(x)\nis code of my own"),
    (1, 2, "user", "> Then we bake\nHow hot?\n\n> then we  WAIT.\nHow long?"),
    (1, 3, "user", "> First we knead. Then\n> we wait. Then we bake\nI see"),
    (1, 4, "user", "> How hot?\n> never said\nVery"),
    (1, 5, "user", "> Then we wait. Then\n> we sleep.\nNo"),
]


def test_quotations_in_part(spark):
    """A line, a sentence, a passage wrapped anew; what has no original stays."""
    frame = spark.createDataFrame(PARTS, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r for r in chat.chat(frame).collect()}
    assert {t: (r["reply_to"], r["n_quotes"], r["n_linked"]) for t, r in got.items()} == {
        0: (None, 0, 0), 1: (None, 1, 0), 2: (0, 2, 2), 3: (0, 1, 1), 4: (2, 1, 1), 5: (0, 1, 1)}
    assert {t: r["body"] for t, r in got.items() if t} == {
        1: PARTS[1][3], 2: "How hot?\n\nHow long?", 3: "I see", 4: "> never said\nVery", 5: PARTS[5][3]}


def test_derived_quotations_have_their_origins(spark, sf_dir):
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = queries.quoting(messages).collect()
    got = {(r["conv_id"], r["turn"]): r for r in queries.op5_chat_quotes(spark, sf_dir).collect()}
    own = {(r["conv_id"], r["turn"]): r["text"] for r in messages.collect()}
    assert len(got) == len(rows) == len(own)
    quoting = [r for r in rows if r["quotes"]]
    assert len(quoting) == sum(t > 0 for _, t in own)
    assert {x["level"] for r in quoting for x in r["quotes"]} == {1, 2}
    for r in rows:
        out = got[r["conv_id"], r["turn"]]
        near = [x["origin"] for x in r["quotes"] or [] if x["level"] == 1]
        assert out["reply_to"] == (near[0] if near else None)
        assert out["n_linked"] == out["n_quotes"] and (out["n_quotes"] > 0) == bool(near)
        assert out["body"] == own[r["conv_id"], r["turn"]].strip()
        above = got[r["conv_id"], near[0]] if near else out
        assert out["thread"] == above["thread"] and (near or out["thread"] == r["turn"])
    order = [(r["conv_id"], r["thread"], r["turn"]) for r in queries.op5_chat_quotes(spark, sf_dir).collect()]
    assert order == sorted(order)


# ---------------------------------------------------------------- pipeline

def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf_dir)
        assert out.columns == docs.columns, name
        from penstock.llm.store import written
        out = written(out, "stage-test")
        assert 0.5 * kept.count() < out.count() <= kept.count(), name
        kept = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert pieces.select("doc_id").distinct().count() == kept.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "language_id", "line_dedup", "near_dup", "packing"]


def test_stages_take_odd_texts(spark, sf_dir, odd_rows, no_docs):
    docs = spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in odd_rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.where("false")):
        kept = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, sf_dir)
        ids = {r["doc_id"] for r in kept.collect()}
        assert not ids & {1, 2, 3, 10}
        assert corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).select("doc_id").distinct().count() == len(ids)
