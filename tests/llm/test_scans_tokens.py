"""Decontamination, token counts, token files and the pipeline against brute force and libraries."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from filigree.llm import decontaminate, mixing, simhash, token_counts, token_files, toxicity
from filigree.llm.common import read, stage, vocabulary

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(text, items):
    """Hit word positions and items, window by window."""
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        for k in range(max(1, len(w) - 9) if w else 0):
            window = w[k : k + 10]
            for at in range(len(own) - len(window) + 1):
                if own[at : at + len(window)] == window:
                    hit |= set(range(at, at + len(window)))
                    found.add(str(item))
    return len(own), hit, sorted(found)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "Kürzer! als-zehn"), (3, ""), (4, None), (5, "two THREE four five six seven eight nine ten eleven"), (None, "never used"), (10, "a b")]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 20])
def test_contamination_equals_brute_force(spark, frame, monkeypatch, block):
    """With one block of items and with several."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(1)
    pool = words(ITEMS[0][1]) + ["Kürzer", "als", "zehn", "a", "b", "x"]
    texts = ["pre ONE, two-three four (five) six seven eight nine ten eleven twelve, post", "kürzer als\nzehn kürzer", "a b a b", None, "", "a", "one two three"]
    texts += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["é " * 30_000 + ITEMS[4][1]]
    rows = [*enumerate(texts), (0, texts[0]), (None, "a b")]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(frame(rows), bench).collect()
    items = [(i, t) for i, t in ITEMS if i is not None]
    assert len(got) == len(rows) and sum(r.doc_id == 0 for r in got) == 2
    by_id = dict(rows)
    for r in got:
        n, hit, found = brute_contamination(by_id[r.doc_id], items)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, len(hit), found)
        if block > 20:
            inside = [w for s in r.spans for w in words(by_id[r.doc_id][s.start : s.end])]
            assert inside == [words(by_id[r.doc_id])[k] for k in sorted(hit)]
    clean = decontaminate.drop_contaminated(frame(rows), bench)
    assert clean.columns == frame(rows).columns and sorted(r.doc_id for r in clean.collect()) == sorted(i for i, t in rows if not brute_contamination(t, items)[1])


def test_contamination_of_odd_tables(spark, odd, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(odd, none).where("n_hit > 0").count() == 0
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(frame([]), some).count() == 0
    assert decontaminate.contamination(odd, some).count() == 10


def noisy_texts(n, seed=0):
    rng = random.Random(seed)
    parts = ["a", "b", "e", "the", " ", "  ", "\n", "\t", "é", "é", "日本", "𓀀", "▁", "<s>", "<|endoftext|>", "<|STARTOFTEXT|>", "0", "99", "====", "ing", "ﬁ", "\x00", "//", "Ａ", "Σ", "İ", "'s", "'LL", ".", ",", ".,", "!", "\x1c", "\x85", "\xa0", "Thon"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_token_counts_equal_the_library():
    path = vocabulary("piece_bpe_32k.model")
    rng = random.Random(1)
    texts = noisy_texts(6000) + ["a" * 5000, "ab" * 3000 + "\n" + "=" * 777, " " * 1000, "", "▁" * 300 + "x", "\n" * 50, "hello " * 3000, "日本" * 900]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(200, 600))) for _ in range(60)]
    pieces, seen = token_counts.Pieces(path), {}
    want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)]
    assert token_counts.count_tokens(texts, pieces, seen) == want
    assert token_counts.count_tokens(texts[::-1], pieces, seen) == want[::-1]
    symbols, lengths, _ = pieces.symbols([t for t in texts if t])
    cuts = np.cumsum(lengths)
    for k in range(0, 400, 7):  # the queue for long sequences gives what the array steps give
        one = symbols[cuts[k] - lengths[k] : cuts[k]]
        assert pieces.merge_long(one.tolist()) == pieces.merge_all(one, lengths[k : k + 1])[0]


def test_token_counts_of_odd_rows(odd, frame):
    path = vocabulary("piece_bpe_32k.model")
    got = {r.doc_id: r for r in token_counts.token_counts(odd, path).collect()}
    assert (got[1].n_bytes, got[1].n_tokens, got[2].n_tokens) == (0, 0, 0) and got[7].over_limit and not got[5].over_limit
    assert got[9].n_bytes == len("é\x00日本 𓀀".encode())
    assert token_counts.token_counts(frame([]), path).count() == 0


def test_encoder_equals_the_library():
    path = vocabulary("word_bpe_49k.json")
    texts = noisy_texts(6000, 3) + ["x" * 3000, "Thon, " * 500, ""]
    encoder = token_files.Encoder(path)
    want = [e.ids + [2] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for part in (slice(0, 3000), slice(3000, None), slice(0, 500)):
        flat, sizes = encoder.encode(pa.array(texts[part]))
        cuts = np.cumsum(sizes)
        assert [flat[b - n : b].tolist() for n, b in zip(sizes, cuts, strict=True)] == want[part]


def test_token_files_round_trip(frame, odd):
    path = vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(2)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(noisy_texts(1009, 5))] + [(5000, None), (4, "repeated id")]
    rng.shuffle(rows)
    got = sorted(token_files.round_trip(frame(rows), path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(i for i, _ in rows)
    start = 0
    encoded = sorted((i, t or "") for i, t in rows)
    for r, (i, t) in zip(got, encoded, strict=True):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert [r.doc_id for r in sorted(token_files.round_trip(odd, path).collect(), key=lambda r: r.start)] == [1, 2, 3, 5, 5, 6, 7, 8, 9, None]
    named = frame(rows[:50]).withColumn("doc_id", F.concat(F.lit("doc-"), "doc_id"))
    again = sorted(token_files.round_trip(named, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in again] == sorted(f"doc-{i}" for i, _ in rows[:50]) and sum(r.n_tokens for r in again) == again[-1].start + again[-1].n_tokens
    assert token_files.round_trip(frame([]), path).count() == 0


def test_pipeline_stages(spark):
    """Every stage's rows from brute force on its own input."""
    docs = read(spark, FOLDER, "documents")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "decontamination", "source_mix", "token_files"] and corpus_pipeline.ORACLE_SQL is None
    before = docs
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, before, FOLDER))
        left = sorted(r.doc_id for r in after.collect())
        rows = {r.doc_id: r for r in before.collect()}
        if name != "token_files":
            assert after.columns == columns
        if name == "toxicity":
            scores = toxicity.score(before, toxicity.fit(before, read(spark, FOLDER, "labels"))).collect()
            assert left == sorted(r.doc_id for r in scores if not r.predicted)
        elif name == "simhash_near_dedup":
            assert left == sorted({r.component_id for r in simhash.near_duplicates(before).collect()})
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in read(spark, FOLDER, "benchmark").collect()]
            assert left == sorted(i for i, r in rows.items() if not brute_contamination(r.text, items)[1])
        elif name == "source_mix":
            plan = mixing.mix(before).collect()
            assert left == sorted(i for r in plan for i in [r.doc_id] * r.repeats)
        else:
            library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
            order = sorted(((r.doc_id, r.text) for r in before.collect()))
            counts = [len(e.ids) + 1 for e in library.encode_batch([t for _, t in order], add_special_tokens=False)]
            assert [(r.doc_id, r.n_tokens, r.start) for r in sorted(after.collect(), key=lambda r: r.start)] == [(i, n, s) for (i, _), n, s in zip(order, counts, np.cumsum([0, *counts[:-1]]).tolist(), strict=True)]
        before = after
    assert corpus_pipeline.run(spark, FOLDER).count() == after.count()


def test_symbols_that_end_a_stretch_are_encoded_once():
    """A word is remembered once, whatever symbols follow it; the ids stay the library's."""
    encoder = token_files.Encoder(vocabulary("word_bpe_49k.json"))
    encoder.encode(pa.array(["mañana### mañana*** mañana. mañana &&& mañana&&&", None]))
    assert set(encoder.place) == {"mañana", "###", "***", ".", "&&&"}
    odd = ["a's## it'S.", "İ### ı### ŉ--", "x<|endoftext|> x<|endoftext|>### A<|", "é### e\u0301### K## 4### a\u0338=\u0338", "b=\u0338 #", "a\u000b### Straße!!\tÉ%%%", "AB<|CD|> d''## d>>", ""]
    ids, sizes = encoder.encode(pa.array(odd))
    stops = sizes.cumsum()
    for text, stop, size in zip(odd, stops, sizes, strict=True):
        assert ids[stop - size : stop].tolist() == [*encoder.library.encode(text, add_special_tokens=False).ids, token_files.END]
