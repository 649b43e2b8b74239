"""The operators on built-in functions: exact duplicates, lines, mixing."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
import xxhash
from check import compare, connect
from pyspark.sql import functions as F

from filigree.llm import exact_dedup, line_dedup, mixing
from filigree.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_duplicates_with_a_hot_group(frame, odd):
    rows = [(k, "Copy É" if k % 3 else f"own {k}") for k in range(600)] + [(900, "copy é"), (901, "COPY É"), (902, None), (903, "")]
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(frame(rows)).collect()}
    sizes = {}
    for i, t in rows:
        sizes.setdefault(lowered(t), []).append(i)
    for i, t in rows:
        own = sizes[lowered(t)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(own), len(own), i == max(own))
        assert got[i].text_sha256 == hashlib.sha256(lowered(t).encode()).hexdigest()
    assert got[901].keep_id == 901 and got[900].keep_id == 900  # an accented capital is another text
    assert exact_dedup.exact_duplicates(odd).count() == 10
    assert exact_dedup.exact_duplicates(frame([])).count() == 0


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def brute_lines(docs):
    """Dropped line numbers by document, over all pairs of distinct normalised lines."""
    prints, seen = {}, []
    for i, text in sorted(docs):
        for k, line in enumerate((text or "").split("\n")):
            words = [w for w in re.split(r"[\W_]+", line.lower()) if w]
            norm = " ".join(words)
            seen.append((i, k, norm))
            if words and norm not in prints:
                hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in set(words)]
                prints[norm] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    names = list(prints)
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(names)):
        for b in range(a):
            x, y = names[a], names[b]
            if (prints[x] ^ prints[y]).bit_count() <= 2 and lev(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                parent[find(x)] = find(y)
    first, out = set(), {i: [] for i, _ in docs}
    for i, k, norm in seen:
        if norm and find(norm) in first:
            out[i].append(k)
        elif norm:
            first.add(find(norm))
    return out


def test_fuzzy_lines_equal_brute_force(frame):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 70))) for _ in range(12)] + [" ".join(f"w{k}" for k in range(300)), "a a a", "a", "the end", "the man", ""]
    docs = []
    for i in range(60):
        own = []
        for line in rng.sample(lines, 5):
            words = line.split(" ")
            if len(words) > 20 and rng.random() < 0.7:
                words[rng.randrange(len(words))] += rng.choice("abc")
            own.append(" ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
        docs.append((i, "\n".join(own)))
    want = brute_lines(docs)
    got = {r.doc_id: r for r in line_dedup.line_report(frame(docs)).collect()}
    assert {i: list(r.dropped) for i, r in got.items()} == want and sum(map(len, want.values())) > 100
    cleaned = {r.doc_id: r.text for r in line_dedup.drop_fuzzy_lines(frame(docs)).collect()}
    assert cleaned == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]) for i, t in docs}


def test_close_fingerprints_on_both_paths(spark):
    rng = random.Random(8)
    values = {rng.getrandbits(63) for _ in range(30)}
    for centre in list(values)[:2]:
        values |= {centre ^ (1 << rng.randint(0, 63)) ^ (1 << rng.randint(0, 63)) ^ (1 << rng.randint(0, 63)) for _ in range(60)}
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    for limit in (line_dedup.PAIR_LIMIT, 2):
        assert {(r.a, r.b) for r in line_dedup.close_fingerprints(frame, limit).collect()} == want


def test_lines_of_odd_rows(odd, frame):
    got = {r.doc_id: r for r in line_dedup.line_report(odd).collect()}
    assert got[1].n_lines == 1 and got[1].n_dropped == 0 and got[3].n_lines == 2 and got[6].n_dropped == 1
    assert line_dedup.line_report(frame([])).count() == 0


def test_mix_reaches_targets_within_caps(frame, odd):
    rng = random.Random(6)
    rows = [(k, "w " * rng.randint(0, 40), None, rng.choice(["big"] * 8 + ["mid", "mid", "small", None])) for k in range(3000)]
    got = mixing.mix(frame(rows)).collect()
    assert len(got) == len(rows)
    taken, target, size = {}, {}, {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r.doc_id]
        taken[s] = taken.get(s, 0) + r.taken
        target[s], size[s] = r.target, r.source_size
        assert r.taken == r.size * r.repeats and r.repeats <= 3
    total = sum(size.values())
    assert abs(sum(target.values()) - total) < 1e-6 * total
    for s in target:
        assert target[s] <= 3 * size[s] + 1e-9 and abs(taken[s] - target[s]) <= 40
    again = mixing.mix(frame(rows).repartition(7)).collect()
    assert sorted(got) == sorted(again)
    assert mixing.mix(odd).count() == 10 and mixing.mix(frame([])).count() == 0
    out = mixing.mixed(frame(rows))
    assert out.columns == frame(rows).columns and out.count() == sum(r.repeats for r in got)


def test_water_filling_by_hand(spark):
    """Sizes 10, 100, 1000 with weights 1, 2, 3: the first two stop at three times their size."""
    sizes = spark.createDataFrame([("a", "a", 10), ("b", "b", 100), ("c", "c", 1000)], "key string, source string, source_size long")
    got = {r.key: r.target for r in mixing.targets(sizes).collect()}
    assert got == {"a": 30.0, "b": 300.0, "c": 780.0}


def test_line_fingerprints_with_few_and_many_words(frame):
    """The lanes of every width count alike."""
    texts = {n: " ".join(f"w{n}x{k}" for k in range(n)) for n in (1, 2, 127, 128, 300, 2047, 2048, 5000)}
    got = {r.doc: r.fp % (1 << 64) for r in line_dedup.occurrences(frame(list(texts.items()))).collect()}
    for n, text in texts.items():
        hashes = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in set(text.split())]
        assert got[n] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)



def test_lines_in_order(frame):
    """Equal word sets are no link by themselves: the lines as they stand are compared."""
    long = [f"word{k}" for k in range(60)]
    swapped = [long[1], long[0], *long[2:]]
    lines = ["Bob paid Alice 10 20", "Alice paid Bob 20 10 10", "ha ha ha", "ha", " ".join(long), " ".join(reversed(long)), " ".join(swapped), "HA, ha: ha!", ""]
    docs = frame([(1, "\n".join(lines)), (2, "bob paid alice - 10 20\nha ha")])
    got = {r.doc_id: list(r.dropped) for r in line_dedup.line_report(docs).collect()}
    assert got == {1: [6, 7], 2: [0]}
    kept = {r.doc_id: r.text for r in line_dedup.drop_fuzzy_lines(docs).collect()}
    assert kept[2] == "ha ha" and kept[1].split("\n") == [x for k, x in enumerate(lines) if k not in (6, 7)]



def test_mix_of_repeated_rows_and_null_ids(frame):
    """Each row is taken its own number of times, whatever its id."""
    rows = [(1, "a b c", None, "small"), (1, "a b c", None, "small"), (1, "d e f", None, "big"), (None, "g h", None, "small"), (None, "g h", None, "big"), (None, "i j", None, None)]
    rows += [(k % 400, "w " * (k % 7), None, "big") for k in range(10, 3000)] + [(None, f"x{k} y z", None, "big") for k in range(300)]
    docs = frame(rows)
    plan, out = mixing.mix(docs).collect(), mixing.mixed(docs).collect()
    assert sum(r.doc_id == 1 and r.source == "small" for r in out) == 6 and sum(r.doc_id is None and r.source == "small" for r in out) == 3
    want, got, copies = {}, {}, {}
    for r in plan:
        want[r.doc_id, r["size"]] = want.get((r.doc_id, r["size"]), 0) + r.repeats
    for r in out:
        key = (r.doc_id, len(r.text.split()))
        got[key] = got.get(key, 0) + 1
        copies[r.doc_id, r.text, r.source] = copies.get((r.doc_id, r.text, r.source), 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert all(n <= 3 * sum(r == (i, t, None, s) for r in rows) for (i, t, s), n in copies.items())
    again = mixing.mixed(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_similar_equals_edit_distance(spark):
    rng = random.Random(21)
    rows = []
    for k in range(600):
        s = [rng.choice(["a", "bb", "cab", "dddd"]) for _ in range(rng.randint(1, 12))]
        t = list(s)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(t) + 1)
            t[at : at + rng.randint(0, 2)] = [rng.choice(["a", "bb", "cab", "e"]) for _ in range(rng.randint(0, 2))]
        rows.append((k, " ".join(s), " ".join(t) or "z"))
    got = {r.k: r.v for r in spark.createDataFrame(rows, "k long, s string, t string").select("k", line_dedup.similar("s", "t").alias("v")).collect()}
    want = {k: lev(s, t) <= 0.2 * max(len(s), len(t)) + 1e-9 for k, s, t in rows}
    assert got == want and 100 < sum(want.values()) < 500


def test_many_lines_of_one_fingerprint(frame):
    """Texts of one word set, most alike, some not: the pivot joins the many, the others are compared with all."""
    rng = random.Random(22)
    words = [f"word{k}" for k in range(12)]
    near = [" ".join(words + ["word3"] * (k % 3) + ["word5"] * (k // 3 % 2)) for k in range(6)]
    far = [" ".join(rng.sample(words, 12)) for _ in range(12)] + [" ".join(words * n) for n in (2, 3, 4)]
    far += [" ".join([x.split()[1], x.split()[0], *x.split()[2:]]) for x in far[:6]]
    docs = [(i, "\n".join(rng.sample(near + far, 6))) for i in range(40)]
    want = brute_lines(docs)
    assert {r.doc_id: list(r.dropped) for r in line_dedup.line_report(frame(docs)).collect()} == want


@pytest.mark.parametrize("taken", [["_id", "_dropped"], ["_key", "_size", "_tag", "_place", "_rows", "_taken", "_copy", "_none", "__id"]])
def test_names_already_taken(frame, taken):
    rows = [(k, f"line {k}\nsame line here", None, "ab"[k % 2]) for k in range(20)]
    docs = frame(rows).withColumns({c: F.lit("mine") for c in taken})
    for out in (line_dedup.drop_fuzzy_lines(docs), mixing.mixed(docs)):
        assert out.columns == docs.columns and all(r[c] == "mine" for r in out.collect() for c in taken)


def test_lines_that_meet_no_other_take_no_part_in_linking(spark, monkeypatch):
    """Only texts whose fingerprint is shared or has a close one go through the steps of linking."""
    linked, real = [], line_dedup._links

    def counted(nodes, *more):
        linked.append(nodes.count())
        return real(nodes, *more)

    monkeypatch.setattr(line_dedup, "_links", counted)
    lone = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(60)]
    docs = spark.createDataFrame([(1, "\n".join(lone)), (2, "b a b a\na b a b a"), (3, lone[7])], "doc_id long, text string")
    got = {r["doc_id"]: r["dropped"] for r in line_dedup.line_report(docs).collect()}
    assert got[1] == [] and got[3] == [0]
    assert linked == [2]


def test_texts_without_wanted_lines_stay_where_they_are(spark, frame, capsys):
    """Only documents that hold a wanted line reach the shuffle of the fetch, whatever the planner broadcasts."""
    docs = frame([(k, f"line {k}\nother {k}") for k in range(50)] + [(None, "no id\nnone")])
    seen = line_dedup.occurrences(docs).where("doc % 10 = 0 and line_no = 0 or doc is null")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = line_dedup._texts(docs, seen.select("doc", "line_no", "digest"), "doc_id", "text")
        found.explain()
        plan = capsys.readouterr().out
        got = {r.text for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {f"line {k}" for k in range(0, 50, 10)} | {"no id", "none"}
    semi = next(k for k, x in enumerate(plan.splitlines()) if "BroadcastHashJoin" in x and "LeftSemi" in x)
    assert any("Exchange" in x for x in plan.splitlines()[:semi])
