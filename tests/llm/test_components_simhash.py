"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from filigree.llm import simhash
from filigree.llm.components import connected_components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, linked):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(values))]


def close(a, b):
    return (a ^ b).bit_count() <= 2


def sets_of(pairs):
    out = {}
    for node, component in pairs:
        out.setdefault(component, set()).add(node)
    return {frozenset(x) for x in out.values() if len(x) > 1}


def test_fingerprints_equal_brute_force():
    rng = random.Random(1)
    texts = ["", " ", "a", "A b", "a b c", "É é É", "x\x1cy z w", "a b c d"] + [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 700))) for _ in range(40)]
    for text in texts:
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_pivots_discard_only_distant_pairs():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 40), base ^ np.uint64(7)])).view(np.int64)
    a, b = simhash.close_pairs(fps)
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if close(int(fps[i]), int(fps[j]))}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
    keys = simhash.band_keys(fps)
    assert all(set(keys[i]) & set(keys[j]) for i, j in want)


def test_links_connect_small_and_large_blocks(spark):
    """A dense group larger than the pair limit takes the midpoint path; both give the true groups."""
    rng = random.Random(3)
    values = {rng.getrandbits(63) for _ in range(60)}
    for centre in list(values)[:2]:
        for _ in range(90):
            near = centre
            for _ in range(rng.randint(0, 5)):
                near ^= 1 << rng.randint(0, 63)
            values.add(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    unsigned = [v % (1 << 64) for v in signed]
    groups = brute_groups(unsigned, close)
    want = sets_of(zip(signed, groups, strict=True))
    for limit in (simhash.PAIR_LIMIT, 2):
        got = connected_components(simhash.links(nodes, limit)).collect()
        assert sets_of((r[0], r[1]) for r in got) == want


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in range(100, 140)} == {100} and got[201] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_rows(odd, frame):
    got = simhash.near_duplicates(odd)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 10
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].fingerprint == "0" * 16 and rows[1].component_id == rows[2].component_id == rows[3].component_id == 1
    assert rows[6].component_id == 5  # equal after lower-casing
    for i, text in ((8, "x" * 30_000), (7, "word " * 40_000), (9, "é\x00日本 𓀀")):
        assert rows[i].fingerprint == f"{brute_fingerprint(text):016x}"
    assert simhash.near_duplicates(frame([])).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {r.component_id for r in rows.values()}


def test_near_duplicates_equal_brute_force(frame):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        words = [rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(300)]
        for _ in range(6):
            own = list(words)
            own[rng.randrange(300)] = "changed"
            texts.append(" ".join(own))
    fps = [brute_fingerprint(t) for t in texts]
    want = brute_groups(fps, close)
    got = simhash.near_duplicates(frame(list(enumerate(texts)))).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == dict(enumerate(fps))
