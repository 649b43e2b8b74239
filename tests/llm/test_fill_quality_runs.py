"""Fill-in-the-middle, quality outliers and periodic runs against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from filigree.llm import fill_middle, periodic_runs, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Fill-in-the-middle


def plain_fill(name, text):
    units, h = UNIT.findall(text), hashlib.sha256(f"42:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}") if h4 % 100 < 80 else (n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    signs = [" ", "\n", "\t\r", "  ", "a", "word", "é", "日本", "𓀀", "<", "<S", "\x00", " ", "."]
    made = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 5, 30, 400]))) for _ in range(400)]
    return [*made, "has <P> in it", "<M>", "x " * 70_000, " ", ""]


def test_fill_in_middle_equals_plain_version(frame, texts):
    docs = frame(list(enumerate(texts)))
    made = fill_middle.fill_in_middle(docs)
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()}
    assert got == {k: plain_fill(k, t) for k, t in enumerate(texts)}
    assert {x[1] for x in got.values()} == {"plain", "psm", "spm"}
    for r in fill_middle.digest_columns(made).collect():
        assert (r.output_sha256, r.restored_sha256) == (sha(got[r.doc_id][4]), sha(texts[r.doc_id]))
    out = fill_middle.transformed(docs)
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect()} == {k: v[4] for k, v in got.items()}


def test_skip_list_reaches_every_rank():
    rng = np.random.default_rng(5)
    for n in (0, 1, 4, 5, 63, 1000, 5000):
        widths = rng.integers(1, 9, n)
        units, sums = fill_middle.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
        assert all(units.reach(r) == sums[r] for r in range(n + 1))
    assert len(fill_middle.SkipList(np.ones(5000, np.int64)).lanes) >= 4
    lanes = fill_middle.SkipList(widths).lanes
    assert all(u.sum() == n and p.sum() == widths.sum() for u, p, _ in lanes)


def test_units_do_not_depend_on_the_chunk(texts):
    for t in texts[:200]:
        want = [len(u) for u in UNIT.findall(t)]
        for chunk in (1, 3, 1 << 20):
            assert fill_middle.unit_widths(t.encode(), chunk).tolist() == want


def test_fill_of_odd_rows(frame, odd):
    got = {(r.doc_id, r.n): r for r in fill_middle.fill_in_middle(odd).collect()}
    assert got[1, 0].form == got[2, 0].form == "plain" and got[1, 0].output == ""
    assert got[None, 4].output == plain_fill("null", "a b c d")[4]
    assert fill_middle.fill_in_middle(odd).count() == fill_middle.transformed(odd).count() == 10
    assert fill_middle.fill_in_middle(frame([])).count() == fill_middle.transformed(frame([])).count() == 0


# Quality rules


def base(text):
    words = WORD.findall(text)
    n, windows = len(words), [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often, inside = Counter(windows), set()
    for k, w in enumerate(windows):
        if often[w] > 1:
            inside |= set(range(k, k + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    found = (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))
    return (*found, n < 10 or 100 * len(inside) > 20 * n)


def distances(rows):
    """Squared distances by the same rules with dense matrices; ``rows`` are ``(lang, source, statistics)`` that pass."""
    vector = lambda s: [math.floor(1000 * x + 0.5) for x in (math.log(s[0]), math.log((s[1] + 100) / (s[0] + 20)), math.log(1 + 100 * s[2] / (s[1] + 100)), math.log(1 + s[3]), s[4] / (s[0] + 20))]
    groups, few, rest = defaultdict(list), defaultdict(list), []
    for k, (lang, source, _) in enumerate(rows):
        groups[lang, source].append(k)
    for (lang, _), own in list(groups.items()):
        if len(own) < 50:
            few[lang] += own
    for own in few.values():
        if len(own) < 50:
            rest += own
    parts = [g for g in groups.values() if len(g) >= 50] + [g for g in few.values() if len(g) >= 50] + ([rest] if len(rest) >= 50 else [])
    z, floors, out = np.array([vector(s) for *_, s in rows], float).reshape(-1, 5), np.diag(np.array([500, 50, 250, 500, 100.0]) ** 2), {}
    middle = lambda x: np.sort(x, axis=0)[(len(x) - 1) // 2]

    def moments(x, factor=1.0):
        m = x.mean(0)
        return m, (x.T @ x / len(x) - np.outer(m, m)) * factor + floors

    def far(x, fit):
        y = np.linalg.solve(np.linalg.cholesky(fit[1]), (x - fit[0]).T)
        return (y * y).sum(0)

    def step(x, fit, factor=1.0):
        bins = np.minimum(4000, np.floor(100 * np.log1p(far(x, fit))))
        cut = next(b for b in np.unique(bins) if 4 * (bins <= b).sum() >= 3 * len(x))
        return moments(x[bins <= cut], factor)

    for part in parts:
        x = z[part]
        med = middle(x)
        mad = middle(abs(x - med))
        near = (abs(x - med) <= 2.5 * (1.4826 * mad + np.sqrt(np.diag(floors)))).all(1)
        starts = [(med, np.diag((1.4826 * mad) ** 2) + floors), moments(x)] + ([moments(x[near])] if near.any() else [])
        fit = min((step(x, step(x, s)) for s in starts), key=lambda f: np.linalg.slogdet(f[1])[1])
        for k in range(4):
            fit = step(x, fit, 1.41207 if k == 3 else 1.0)
        fit = moments(x[far(x, fit) <= 12.8325], 1.05553)
        out.update(zip(part, far(x, fit)))
    return [out.get(k) for k in range(len(rows))]


def quality_rows():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows = []
    for k in range(900):
        words = [rng.choice(vocabulary) for _ in range(int(math.exp(rng.gauss(4.5, 0.8))) + 3)]
        if k % 13 == 0:
            words = [w + rng.choice(["##", "$$$", "&|"]) for w in words]
        if k % 17 == 0:
            words += words[: len(words) // 8]
        if k % 29 == 0:
            words = [w * 3 for w in words]
        text = " ".join(words)
        text = text.replace(" a", "\na") + ("\nthe end\nthe end" if k % 11 == 0 else "")
        rows.append((k, text, rng.choice(["en", "en", "en", "fr", None, "xx" if k % 100 == 0 else "en"]), rng.choice(["a", "a", "a", "b", None, f"s{k % 7}"])))
    return rows


def test_quality_equals_dense_version(frame):
    rows = quality_rows()
    got = {r.doc_id: r for r in quality.quality(frame(rows)).collect()}
    passed = []
    for i, t, lang, source in rows:
        want, r = base(t), got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        if want[-1]:
            assert not r.kept and r.distance is None
        else:
            passed.append((i, (lang, source, want)))
    far = distances([x for _, x in passed])
    for (i, _), d in zip(passed, far, strict=True):
        assert (got[i].distance is None) == (d is None)
        if d is not None:
            assert got[i].distance == pytest.approx(d, rel=1e-6, abs=1e-6) and got[i].kept == (d <= 35.8573)
    marked = [got[i].kept for i, t, *_ in rows if not got[i].base_failed and "##" in t and "$$$" in t]
    clean = [got[i].kept for i, t, *_ in rows if not got[i].base_failed and i % 13 and i % 29]
    assert sum(marked) < 0.02 * len(marked) and all(clean)
    again = {r.doc_id: r.kept for r in quality.quality(frame(rows).repartition(5)).collect()}
    assert again == {i: r.kept for i, r in got.items()}
    good = quality.keep_good(frame(rows))
    assert good.columns == frame(rows).columns and {r.doc_id for r in good.collect()} == {i for i, r in got.items() if r.kept}


def test_quality_of_odd_rows(frame, odd):
    got = quality.quality(odd).collect()
    assert len(got) == 10 and not any(r.kept for r in got)
    assert {r.doc_id: r.n_repeat_words for r in got}[7] == 40_000
    repeated = frame([(None, "one two three four five six seven eight nine ten", None, None)] * 3 + [(1, "a b c d e f g h i j", "en", "x")])
    assert [r.kept for r in quality.quality(repeated).collect()] == [True] * 4 and quality.keep_good(repeated).count() == 4
    assert quality.quality(frame([])).count() == quality.keep_good(frame([])).count() == 0


def test_repeated_words_with_overlaps(spark):
    rng = random.Random(9)
    rows = [(k, [rng.choice("ab") for _ in range(rng.randint(0, 30))]) for k in range(300)]
    table = spark.createDataFrame(rows, "k long, w array<string>")
    got = {r.k: r.n for r in table.select("k", quality.repeated_words("w").alias("n")).collect()}
    assert got == {k: base(" ".join(w))[4] for k, w in rows} and max(got.values()) > 10


# Periodic runs


def plain_runs(words, least=24, exponent=3):
    """Every period is tried at every place."""
    out, n = {}, len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i >= max((exponent - 1) * p, least - p):
                out.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in out.items())


def random_words(rng, most):
    k, words = rng.choice([1, 2, 2, 3, 6]), []
    while len(words) < rng.randint(1, most):
        if rng.random() < 0.5:
            words += [rng.randrange(k) for _ in range(rng.randint(1, 20))]
        else:
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 12))]
            words += (unit * 8)[: rng.randint(1, 8 * len(unit))]
    return words


@pytest.mark.parametrize("least, exponent", [(24, 3), (2, 2), (10, 2)])
def test_catchers_equal_plain_version(least, exponent):
    """Words appended singly or many at a time give the same runs."""
    rng = random.Random(13)
    for _ in range(150):
        words = random_words(rng, 120)
        catchers, at = periodic_runs.Catchers(least, exponent), 0
        while at < len(words):
            step = rng.choice([1, 1, 2, 7, 50, 1000])
            catchers.append(np.array(words[at : at + step]))
            at += step
        catchers.finish()
        assert catchers.runs == plain_runs(words, least, exponent)


def test_words_that_only_hash_alike(monkeypatch):
    """Equal hashes of different words are found out word by word."""
    monkeypatch.setattr(periodic_runs, "_mixed", lambda ids: (ids % 2).astype(np.uint64))
    rng = random.Random(3)
    for _ in range(60):
        words = [w % 4 for w in random_words(rng, 80)]
        catchers = periodic_runs.Catchers(6, 2)
        catchers.append(np.array(words))
        catchers.finish()
        assert set(catchers.runs) <= set(plain_runs(words, 6, 2)) or catchers.runs == plain_runs(words, 6, 2)


def plain_report(name, text, plant=True):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(name).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {k for s, size, p in runs for k in range(s + p, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    best = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *best, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in dropped))


def test_periodic_runs_equal_plain_version(frame):
    rng = random.Random(14)
    signs = [" ", "  ", "\n", "\t\x0b", " \r\n"]
    rows = [(k, rng.choice(["", " "]) + "".join(f"w{w}" + rng.choice(signs) for w in random_words(rng, 200))) for k in range(300)]
    rows += [(1000, None), (1001, " \n"), (1002, "é " * 50 + "日本 𓀀 " * 30), (1003, "a b c " * 12)]
    for plant in (False, True):
        docs = periodic_runs.with_planted(frame(rows)) if plant else frame(rows)
        found = periodic_runs.digest_columns(periodic_runs.find_runs(docs))
        got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in found.collect()}
        assert got == {i: plain_report(i, t, plant) for i, t in rows}
    assert sum(g[0] for g in got.values()) > 100


def test_periodic_runs_of_the_test_table(spark):
    from filigree.llm.queries import QUERIES

    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    rows = [r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect() if len((r.text or "").split()) < 600]
    assert {r.doc_id: got[r.doc_id] for r in rows} == {r.doc_id: plain_report(r.doc_id, r.text) for r in rows}


def test_runs_of_odd_rows(frame, odd):
    got = {(r.doc_id, r.n_words): r for r in periodic_runs.find_runs(odd).collect()}
    assert [tuple(x) for x in got[7, 40_000].runs] == [(0, 40_000, 1)] and got[7, 40_000].collapsed == "word"
    assert got[1, 0].runs == [] and got[1, 0].collapsed == "" and got[None, 4].collapsed == "a b c d"
    assert periodic_runs.find_runs(odd).count() == 10 and periodic_runs.with_planted(odd).count() == 10
    assert periodic_runs.find_runs(frame([])).count() == 0
