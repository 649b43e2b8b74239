"""Chunks against a walk in order: hot sections in many pieces, nulls, ties, sentences beyond the bound."""

from __future__ import annotations

import random

import pytest

from filigree.plans.chunks import density_chunks, sliding_chunks

SCHEMA = "doc string, section int, n int, sentence string, extra int"
STEPS = ((9, 3, 1), (5, 4, 1), (0, 6, 2))


def table(seed, hot=400):
    g = random.Random(seed)
    rows = []
    for doc, section, n in [("hot", 1, hot), ("hot", 2, 7), ("a", 1, 1), ("a", None, 5), (None, 1, 12), ("b", 3, 30)]:
        most = {"hot": 16, "a": 3}.get(doc, 12)
        for i in range(n):
            words = " ".join(g.choice("abcdef") for _ in range(g.choice([0, 1, most, most, 40 if g.random() < 0.1 else 2])))
            rows.append((doc, section, i, None if g.random() < 0.05 else words, 1))
    rows += [("tie", 1, 0, s, 1) for s in ("x y", "x", "x", "z")]
    g.shuffle(rows)
    return rows


def sections(rows):
    out = {}
    for doc, section, n, s, _ in rows:
        out.setdefault((doc, section), []).append((n, s is None, s or "", s))
    return {k: [x[3] for x in sorted(v)] for k, v in out.items()}


def joined(part):
    return " ".join(s for s in part if s is not None)


def sliding(rows, size, stride):
    out = set()
    for key, s in sections(rows).items():
        for i in range(0, len(s), stride):
            if i == 0 or i + size - stride < len(s):
                out.add((*key, i, len(s[i : i + size]), joined(s[i : i + size])))
    return out


def words(s):
    return len((s or "").split())


def segmented(rows, bound):
    out, density = set(), {}
    for doc, _, _, s, _ in rows:
        density.setdefault(doc, []).append(words(s))
    for key, s in sections(rows).items():
        mean = sum(density[key[0]]) / len(density[key[0]])
        size, overlap = next((a, b) for least, a, b in STEPS if mean >= least)
        at = 0
        while True:
            take = 1
            while take < size and at + take < len(s) and sum(map(words, s[at : at + take + 1])) <= bound:
                take += 1
            part = s[at : at + take]
            total = sum(map(words, part))
            out.add((*key, at, take, total, total > bound, joined(part)))
            if at + take >= len(s):
                break
            at += max(1, take - overlap)
    return out


@pytest.mark.parametrize(("size", "stride", "piece_rows", "hot_rows"), [(3, 1, 4096, 10**6), (3, 1, 2, 50), (5, 2, 4, 10**6), (4, 4, 16, 50), (1, 1, 1, 10**6)])
def test_sliding_equals_a_walk(spark, size, stride, piece_rows, hot_rows):
    rows = table(1)
    got = sliding_chunks(spark.createDataFrame(rows, SCHEMA), ["doc", "section"], ["n"], "sentence", size, stride, piece_rows, hot_rows)
    assert got.columns == ["doc", "section", "first", "n_sentences", "text"]
    listed = [tuple(r) for r in got.collect()]
    assert len(listed) == len(set(listed)) and set(listed) == sliding(rows, size, stride)


@pytest.mark.parametrize(("piece_rows", "fan", "hot_rows"), [(256, 256, 10**6), (6, 256, 50), (6, 3, 10**6)])
def test_density_equals_a_walk(spark, piece_rows, fan, hot_rows):
    rows = table(2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = density_chunks(df, ["doc", "section"], ["n"], "sentence", ["doc"], STEPS, 30, piece_rows, fan, hot_rows)
    listed = [tuple(r) for r in got.collect()]
    want = segmented(rows, 30)
    assert len(listed) == len(set(listed)) and set(listed) == want
    assert any(r[5] for r in want) and {r[3] for r in want} >= {1, 2, 3, 4}


def test_every_sentence_is_in_a_chunk(spark):
    rows = table(3, hot=100)
    got = density_chunks(spark.createDataFrame(rows, SCHEMA), ["doc", "section"], ["n"], "sentence", ["doc"], STEPS, 30, 8, 2)
    held = {}
    for r in got.collect():
        held.setdefault((r["doc"], r["section"]), set()).update(range(r["first"], r["first"] + r["n_sentences"]))
    assert held == {k: set(range(len(v))) for k, v in sections(rows).items()}


def test_nothing_and_wrong_settings(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sliding_chunks(none, ["doc", "section"], ["n"], "sentence").isEmpty()
    assert density_chunks(none, ["doc", "section"], ["n"], "sentence", ["doc"]).isEmpty()
    with pytest.raises(ValueError):
        sliding_chunks(none, ["doc"], ["n"], "sentence", 3, 4)
    with pytest.raises(ValueError):
        density_chunks(none, ["doc"], ["n"], "sentence", ["doc"], ((0, 2, 2),))
    with pytest.raises(ValueError):
        density_chunks(none, ["doc"], ["n"], "sentence", ["doc"], piece_rows=4)
