"""Encoders, edit-aware counts and packing against the tokenizers library."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from penstock.llm import bpe_trie, edit_counts, packing, queries, word_ids
from tokenizers import Tokenizer

BYTE, WORD = (queries.vocabulary(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def every_character():
    for code in [*range(0x3000), *range(0xFF00, 0x10000, 7), 0x1F600]:
        if not 0xD800 <= code < 0xE000:
            x = chr(code)
            yield f"a{x}a{x}'s1{x} {x} {x}{x}a\n e{x} {x.upper()}{x.lower()}"


@pytest.mark.parametrize("path, made", [(BYTE, lambda: bpe_trie.TrieBpe(BYTE)), (WORD, lambda: word_ids.WordIds(WORD))])
def test_encoders_on_every_character(path, made):
    library, own = Tokenizer.from_file(path), made()
    texts = [*every_character(), "", " ", "\n\n", "a" * 5000, "<|endoftext|>", "x <|startoftext|>y<|endoftext|> z",
             "don't we'll’s  \t x", "\x1c a\x7fb"]
    wrong = [t for t, got in zip(texts, own.encode(texts)) if got != ids_of(library, t)]
    assert wrong == []


def test_decoding(odd_rows):
    library, own = Tokenizer.from_file(BYTE), bpe_trie.TrieBpe(BYTE)
    for _, text, _ in odd_rows:
        ids = own.encode([text or ""])[0]
        assert own.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_whole_table_is_encoded(spark, sf_dir, odd_docs, no_docs):
    library = Tokenizer.from_file(BYTE)
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        texts = [r["text"] for r in docs.select("text").collect()]
        got = bpe_trie.encoded(docs, BYTE).collect()
        assert sorted(bytes(r["ids"]) for r in got) == sorted(ids_of(library, t) for t in texts)
        assert sorted(r["decoded"] for r in got) == sorted(t or "" for t in texts)
        assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in got)
    assert bpe_trie.encoded(no_docs, BYTE).count() == 0


def test_edits_at_random(spark, sf_dir):
    library, own = Tokenizer.from_file(BYTE), bpe_trie.TrieBpe(BYTE)
    rng = random.Random(0)
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    added = ["", " ", "\n", "  ", "'s", "abc", "ré 12 ", "l", "\n\n", "漢", "<|endoftext|>"]
    recounted = pieces = 0
    for text in [*texts, "", "a", "  a", "it's  \n\n x"] * 2:
        held = edit_counts.CountedText(text, own)
        for _ in range(6):
            held.edit(rng.randint(-1, len(held.text) + 1), rng.choice([0, 1, 2, 5, 30]),
                      rng.choices(added, [4] * 9 + [1, 1])[0])
            assert held.tree.total == len(library.encode(held.text, add_special_tokens=False).ids)
            assert sum(map(sum, held.tree.lengths)) == len(held.text)
            assert held.tree.chars[1] == len(held.text)
        recounted, pieces = recounted + held.recounted, pieces + 6 * held.tree.pieces
    assert recounted < pieces / 4


UNUSUAL = {"cyrillic": "Съешь ещё этих мягких французских булок, да выпей чаю. ", "cjk": "我们 今天 去 北京，明天 回来。 かな 12 ",
           "emoji": "so 😀 it 👍🏽 is\u00a0 fine  ", "mark": "one two <|endoftext|> three's  four "}


@pytest.mark.parametrize("name", UNUSUAL)
def test_edits_of_unusual_texts_recount_little(name):
    """The tree after any edits is the one of the text cut anew, and only what stands near an edit is counted."""
    own, rng = bpe_trie.TrieBpe(BYTE), random.Random(5)
    library = Tokenizer.from_file(BYTE)
    text = UNUSUAL[name] * 60
    held = edit_counts.CountedText(text, own)
    if name != "mark":
        assert held.tree.pieces == len(library.pre_tokenizer.pre_tokenize_str(text))
    assert held.tree.pieces > 400
    for _ in range(150):
        added = rng.choice(["", " ", "  \n", "'s", "漢字", "ж", "😀", "a b", "<|endo", "ftext|>", ">", "<|endoftext|>", "|", "<"])
        before = held.recounted
        held.edit(rng.randint(0, len(held.text)), rng.choice([0, 1, 2, 9]), added)
        assert held.recounted - before < 40
        fresh = edit_counts.CountedText(held.text, own).tree
        for side in ("lengths", "counts"):
            assert sum(getattr(held.tree, side), []) == sum(getattr(fresh, side), [])
        assert held.tree.total == len(library.encode(held.text, add_special_tokens=False).ids)
    # a mark that an edit completes or breaks
    held = edit_counts.CountedText(text + "<|endoftext|" + text, own)
    for removed, added in ((0, ">"), (1, "")):
        held.edit(len(text) + 12, removed, added)
        assert held.tree.total == len(library.encode(held.text, add_special_tokens=False).ids)


def test_edits_of_a_table(odd_docs, no_docs):
    from pyspark.sql import functions as F
    library = Tokenizer.from_file(BYTE)
    edits = F.expr("""array(struct(2 AS at, 3 AS removed, 'xy z' AS added), null,
        struct(cast(null AS int) AS at, 1 AS removed, 'q' AS added), struct(9 AS at, null AS removed, null AS added),
        struct(0 AS at, 0 AS removed, 'Oh ' AS added))""")
    once = edit_counts.edit_counts(odd_docs.withColumn("edits", edits), BYTE)
    rows = once.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["tokens_after"] == len(library.encode(r["text"], add_special_tokens=False).ids)
    # the stored leaves are taken up again, without encoding
    again = edit_counts.edit_counts(once.withColumn("edits", F.lit(None)), BYTE).collect()
    assert sorted(r["tokens_before"] for r in again) == sorted(r["tokens_after"] for r in rows)
    assert {r["n_recounted"] for r in again} == {0}
    assert edit_counts.edit_counts(no_docs.withColumn("edits", edits), BYTE).count() == 0


def check_pieces(rows, ids, capacity):
    """Every id lies in one piece; sequences have no gap and hold at most the capacity."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(documents) == set(ids)
    for doc, pieces in documents.items():
        pieces.sort(key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == ids[doc]
        at = 0
        for r in pieces:
            assert (r["start"], r["doc_tokens"], len(r["ids"])) == (at, len(ids[doc]) // 4, 4 * r["length"])
            at += r["length"]
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    return sum(len(x) // 4 for x in ids.values()) / (capacity * len(sequences))


def test_packing(spark, sf_dir, odd_rows, odd_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    last = np.array([1], "<u4").tobytes()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r["doc_id"]: ids_of(library, r["text"]) + last for r in docs.collect()}
    assert check_pieces(packing.pack(docs, word_ids.encoder(WORD)).collect(), ids, 2048) > 0.98
    once = odd_docs.dropDuplicates(["doc_id"])
    ids = {r["doc_id"]: ids_of(library, r["text"]) + last for r in once.collect()}
    check_pieces(packing.pack(once.repartition(3), word_ids.encoder(WORD), capacity=16, group_windows=4).collect(),
                 ids, 16)
    assert packing.pack(odd_docs, word_ids.encoder(WORD)).select("doc_id").distinct().count() == len(ids)
    assert packing.pack(no_docs, word_ids.encoder(WORD)).count() == 0


def test_differencing_evens_out():
    rng = random.Random(4)
    sizes = [rng.randint(1, 900) for _ in range(400)]
    windows = packing.differenced(sizes, 32)
    assert sorted(i for w in windows for i in w) == list(range(400))
    sums = [sum(sizes[i] for i in w) for w in windows]
    assert max(sums) - min(sums) <= 16
    assert all(sum(sizes[i] for i in w) <= 1000 for w in packing.dealt(sizes, 1000))
