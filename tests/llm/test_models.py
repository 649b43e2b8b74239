"""The operators with a trained model: toxicity, language, personal data."""

from __future__ import annotations

import binascii
import random
import re

import numpy as np
from pyspark.sql import functions as F

from filigree.llm import langid, pii, toxicity
from filigree.llm.common import held_out, read

FOLDER = "/root/testdata/sf0.01"


def held(i):
    return binascii.crc32(str(i).encode()) % 5 == 0


def test_held_out_rows(spark):
    got = spark.range(200).select("id", held_out(F.col("id"))).collect()
    assert [r[1] for r in got] == [held(r[0]) for r in got]


def insult_corpus(n=700):
    """Documents of which those with an insult are labelled toxic, some of them disguised."""
    rng = random.Random(9)
    vocabulary = ["the", "river", "stone", "winter", "garden", "paper", "window", "silver", "morning", "street", "idea", "stupor", "idle"]
    insults = ["stupid", "idiot"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(5, 40))]
        toxic = rng.random() < 0.25
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(insults))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_sees_through_disguise(spark, frame, odd):
    docs, labels = insult_corpus()
    hidden = ["you are 1d10t now", "so s t u p i d here", "a stuuuupid idea", "such an i.d.i.o.t", "what a $tup1d street", "an idiot!"]
    clean = ["the river and the stone", "idle winter morning", "a 100 stones", "B2B 4 all", ""]
    every = [*docs, *((10_000 + k, t) for k, t in enumerate(hidden)), *((20_000 + k, t) for k, t in enumerate(clean))]
    table = frame(every)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(table, marks)
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    assert all(got[i].predicted == y for i, y in labels if held(i))
    assert [got[10_000 + k].predicted for k in range(len(hidden))] == [1] * len(hidden)
    assert [got[20_000 + k].predicted for k in range(len(clean))] == [0] * len(clean)
    kept = toxicity.drop_toxic(table, model)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.score(odd, model).count() == 10 and toxicity.score(frame([]), model).count() == 0
    assert {r.doc_id: r.restored for r in toxicity.restore(frame([(1, "So 1D10T!")]), model).collect()} == {1: "so idiot"}


def test_toxicity_without_usable_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = frame([(1, "a b"), (2, None)])
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {toxicity.score(docs, toxicity.fit(docs, none)).first().score}
    assert toxicity.fit(frame([]), none).weights == {}


def brute_decode(stretch, costs):
    """The cheapest path by listing all of them."""
    best = None
    paths = [("", 0.0)]
    for choices in toxicity.lattice(stretch):
        paths = [(text + piece, cost + price) for text, cost in paths for piece, price in choices]
    for text, cost in paths:
        x = y = 0
        for c in text + " ":
            z = toxicity._code(c)
            cost += costs[x, y, z] if (y or z) else 0.0
            x, y = y, z
        if best is None or cost < best[0] - 1e-9:
            best = (cost, text.strip())
    return best[1]


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    costs = toxicity.language_model(rng.integers(0, 50, (28, 28, 28)))
    for stretch in ("1d10t", "st00pid", "s t u p", "a.b.c", "l00ser!", "heeeello", "$a|", "é3é", "77"):
        assert toxicity.decode(stretch, costs) == brute_decode(stretch, costs)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").collect()
    right = [r.predicted == r.toxic for r in got if r.held_out]
    assert len(right) > 50 and np.mean(right) >= 0.9
    assert not any(r.predicted and not r.toxic for r in got)


def test_language_on_held_out_rows(spark):
    docs = read(spark, FOLDER, "documents")
    got = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) >= 0.97


def test_language_of_odd_rows(odd, frame):
    model = langid.fit(odd)
    got = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {1, 2, 3} and got[1].score == 0.0
    assert all(r.lang_pred in {"en", "fr", "de"} for i, r in got.items() if i not in (1, 2, 3))
    empty = langid.fit(frame([]))
    assert langid.identify(odd, empty).select("lang_pred").distinct().collect()[0][0] == "und"
    assert langid.identify(frame([]), model).count() == 0


def test_penalties_leave_most_weights_zero():
    leader = langid.Leader(50, 2)
    rng = np.random.default_rng(1)
    for _ in range(300):
        label = int(rng.integers(2))
        at = np.array([label, *rng.choice(np.arange(2, 50), 3, replace=False)])
        leader.learn(at, np.array([0.9, 0.02, 0.02, 0.02]), label)
    w = leader.weights(slice(None))
    assert w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0] and (w == 0).mean() > 0.5


def test_temperature_is_the_best_of_many():
    rng = np.random.default_rng(2)
    logits, labels = rng.normal(0, 5, (300, 3)), rng.integers(0, 3, 300)
    loss = lambda t: -np.mean([np.log(langid.softmax(z / t)[y]) for z, y in zip(logits, labels, strict=True)])
    best = langid.temperature(logits, labels)
    assert all(loss(best) <= loss(t) + 1e-6 for t in (0.1, 0.5, 1, 2, 5, 10, 19))


def brute_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    parts = ["a", "b.", "@", "@", "c-d", ".", "..", "com", "1", "23", "255", "0", "+", " ", "-", "(", ")", "4111111111111111", "é", "_", "%", "٣", "000"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert pii.base_spans(text) == brute_spans(text)
    long = "a" * 200_000 + " " + "1" * 200_000 + ".2.3.4 x@"
    assert pii.base_spans(long) == []


def brute_best(text, start, end, weights, margin):
    """The best set of non-overlapping segments by trying all sets."""
    found = pii.lattice(text, start, end)
    scores = weights[found.features].sum(1) - margin
    segments = list(zip(found.first.tolist(), found.last.tolist(), scores.tolist(), strict=True))

    def best(k):
        options = [0.0] + ([best(k + 1)] if k < len(found.edges) - 1 else [])
        return max(options + [s + best(j) for i, j, s in segments if i == k])

    return best(0)


def test_segmentation_is_the_best_one():
    rng = np.random.default_rng(4)
    for text in ("212-555 1234", "4111.1111.1111", "a (at) b (dot) c", "10[.]0[.]0[.]12 99"):
        weights = rng.normal(0, 1, pii.DIMENSIONS)
        spans = pii.decode(text, 0, len(text), weights)
        found = pii.lattice(text, 0, len(text))
        scores = weights[found.features].sum(1)
        own = sum(max(scores[s] for s in range(len(scores)) if (pii.KINDS[found.kind[s]], found.edges[found.first[s]], found.edges[found.last[s]]) == span) for span in spans)
        assert abs(own - brute_best(text, 0, len(text), weights, 0.0)) < 1e-9
        forward, backward = pii._sums(found, scores)
        assert abs(forward[-1] - backward[0]) < 1e-9


def pii_corpus():
    rng = random.Random(5)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(240):
        kind = i % 4
        own = [f"joe{d(2)}.k@mail{d(1)}.example.com", f"{rng.randint(1, 254)}.{rng.randint(0, 254)}.{rng.randint(0, 254)}.{rng.randint(1, 254)}", "4111 1111 1111 1111", f"+1 ({d(3)}) 555-{d(4)}"][kind]
        rows.append((i, f"é text {own} and more words"))
    return rows


def test_personal_data_found_and_added(frame, odd):
    rows = [*pii_corpus(), (900, "call (212) 555-1234 now"), (901, "write to ann.lee (at) example (dot) org please"), (902, "on 2024-01-02 we sold 1,234,567 of 3.14159265"), (903, None)]
    docs = frame(rows)
    weights = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find_pii(docs, weights).collect()}
    for i, text in rows:
        base = [tuple(s) for s in got[i].base]
        assert base == brute_spans(text or "")
        assert set(base) <= {tuple(s) for s in got[i].spans}
    text = dict(rows)
    named = lambda i: [(s.kind, text[i][s.start : s.end]) for s in got[i].spans]
    assert named(900) == [("phone", "(212) 555-1234")] and named(901) == [("email", "ann.lee (at) example (dot) org")] and named(902) == []
    digest = pii.digest_columns(pii.find_pii(docs, weights)).where("doc_id = 0").first()
    assert digest.n_email == 1 and digest.spans.startswith("email:7:")
    assert pii.find_pii(odd, weights).count() == 10 and pii.find_pii(frame([]), weights).count() == 0
    assert not pii.fit(odd).any()



def test_addresses_with_plain_dots_are_found(frame):
    texts = ["write to ann.lee (at) example.com please", "write to ann.lee [at] example.org please", "we met at noon. Then we left at once."]
    docs = frame([*pii_corpus(), *((900 + k, t) for k, t in enumerate(texts))])
    got = {r.doc_id - 900: {(s.kind, texts[r.doc_id - 900][s.start : s.end]) for s in r.spans} for r in pii.find_pii(docs, pii.fit(docs)).where("doc_id >= 900").collect()}
    assert got[0] == {("email", "ann.lee (at) example.com")} and got[1] == {("email", "ann.lee [at] example.org")} and got[2] == set()



def test_stretches_beside_base_spans():
    cut = lambda text: [text[a:b].strip() for a, b in pii.stretches(text, pii.base_spans(text))]
    assert cut("212-555-1234, 10.0.0.7") == ["212-555-1234,"]
    assert cut("10.0.0.7 212-555-1234 10.0.0.8") == ["212-555-1234"]
    assert cut("(212) 555-1234 / 4111 1111 1111 1111") == ["(212) 555-1234 /"]
    assert cut("+1 (826) 555-4081 190.137.223.204") == ["+1 (826) 555-4081"]
    assert cut("write ann (at) example.com") == cut("an anecdote, ann (at) example.com")[-1:] == ["ann (at) example.com"]
    rng = random.Random(3)
    parts = ["212-555-1234", "10.0.0.7", "4111 1111 1111 1111", "a@b.co", " at ", "(at)", "x.org", ", ", " ", "+1 212 555 1234", "@", " dot ", "77"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        base = pii.base_spans(text)
        got, whole = pii.stretches(text, base), pii.stretches(text, [])
        covered = lambda spans: {k for a, b in spans for k in range(a, b)}
        assert covered(got) == covered(whole) - covered((a, b) for _, a, b in base)
        assert all(a < b for a, b in got) and all(x[1] <= y[0] for x, y in zip(got, got[1:], strict=False))



def test_neighbours_of_base_spans_are_found(frame):
    texts = ["call 212-555-1234, 10.0.0.7 now", "on (212) 555-1234 / 4111 1111 1111 1111"]
    docs = frame([*pii_corpus(), *((900 + k, t) for k, t in enumerate(texts))])
    got = {r.doc_id - 900: {(s.kind, texts[r.doc_id - 900][s.start : s.end]) for s in r.spans} for r in pii.find_pii(docs, pii.fit(docs)).where("doc_id >= 900").collect()}
    assert got[0] == {("phone", "212-555-1234"), ("ip", "10.0.0.7")}
    assert got[1] == {("phone", "(212) 555-1234"), ("card", "4111 1111 1111 1111")}



def test_every_word_with_several_paths_is_decoded(spark, frame):
    docs, labels = insult_corpus()
    hidden = ["what a sttupid street", "an iddiott here", "you s  t u p i d", "so s\ti\td i\no t", "the 1d10t", "a stu-pid paper", "5+00p1d"]
    clean = ["a bb garden", "hello summer", "in 1990 or 2024-01-02"]
    table = frame([*docs, *((10_000 + k, t) for k, t in enumerate([*hidden, *clean, "i d  i\to\nt", "s\nt\nu\np\ni\nd"]))])
    model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    restorer = toxicity.Restorer(model.costs)
    assert restorer["sttupid"] == "stupid" and restorer["iddiott"] == "idiot"
    assert restorer.text("s  t u p i d") == restorer.text("s\tt\nu p i d") == " stupid "
    assert restorer["57"] == toxicity.decode("57", model.costs) != "57"  # look-alike signs only
    assert restorer["silver"] == "silver" and restorer["street"] == "street"
    got = {r.doc_id - 10_000: r.predicted for r in toxicity.score(table, model).collect()}
    assert [got[k] for k in (0, 1, 2, 4, 5)] == [1] * 5 and [got[len(hidden) + k] for k in range(len(clean))] == [0] * len(clean)
    assert got[len(hidden) + len(clean)] == got[len(hidden) + len(clean) + 1] == 1
    long = "ab" * 100_000 + "cc"
    assert toxicity.decode(long, model.costs).startswith("abab")


def test_language_model_ignores_texts_of_the_held_out_fold(frame):
    """Other texts in the held-out fold change neither frequencies nor weights."""
    rng = random.Random(31)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"] if i % 2 else ["uno", "dos", "tres"]) for _ in range(20)), "en" if i % 2 else "es") for i in range(200)]
    other = [(i, "zzz qqq " * 9 if held(i) else t, lang) for i, t, lang in rows]
    one, two = langid.fit(frame(rows)), langid.fit(frame(other))
    assert (one.idf == two.idf).all() and (one.weights == two.weights).all() and one.temperature == two.temperature
