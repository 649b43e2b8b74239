"""Registered queries: n-grams, near-duplicates, pattern scans and text statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.plans import text_scans as x
from filigree.plans.near_duplicates import near_dupes
from filigree.plans.ngrams import LABEL_HINTS, suggest_labels, top_ngrams
from filigree.sources.fixture_sql import SENTENCES, on_sentences, with_views

catalog = Catalog()


def ngram_sql(source: str, by: str, text: str, k: int = 25) -> list[str]:
    words = f"words AS (SELECT {by} AS g, row_number() OVER () AS doc, regexp_extract_all(lower({text}), '[a-z0-9%$.]+') AS w FROM {source} WHERE {text} IS NOT NULL)"
    grams = """grams AS (SELECT g, doc, unnest(w) AS ngram FROM words UNION ALL
  SELECT g, doc, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words WHERE len(w) >= 2)"""
    rest = f"""sizes AS (SELECT g, count(*) AS n FROM words GROUP BY g),
tf AS (SELECT g, doc, ngram, count(*) AS tf FROM grams GROUP BY ALL),
vocab AS (SELECT f.g, ngram, n, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM (SELECT g, ngram, count(*) AS df FROM tf GROUP BY ALL) f
  JOIN sizes s ON f.g = s.g WHERE df >= 5 AND df <= n * 0.6::DOUBLE),
weighted AS (SELECT tf.g, doc, tf.ngram, n, tf * idf AS w FROM tf JOIN vocab v ON tf.g = v.g AND tf.ngram = v.ngram),
scaled AS (SELECT g, ngram, n, w / sqrt(sum(w * w) OVER (PARTITION BY g, doc)) AS share FROM weighted),
scores AS (SELECT g, ngram, round(sum(share) / max(n), 10) AS score FROM scaled GROUP BY g, ngram),
ranked AS (SELECT * FROM (SELECT g AS {by}, ngram, score, row_number() OVER (PARTITION BY g ORDER BY score DESC, ngram) AS rank FROM scores) WHERE rank <= {k})"""
    return [words, grams, rest]


@catalog.query(
    "t1_top_ngrams_by_language",
    with_views("\nSELECT * FROM ranked", *ngram_sql("documents", "lang", "text")),
)
def _(t):
    return top_ngrams(t.documents, "lang", "text")


@catalog.query(
    "t1_top_ngrams_by_section",
    with_views("\nSELECT * FROM ranked", SENTENCES, *ngram_sql("sentences", "section", "sentence")),
)
def _(t):
    return top_ngrams(t.sentences, "section", "sentence")


def hints_sql() -> str:
    rows = ", ".join(f"({i}, '{label}', {j}, '{hint}')" for i, (label, words) in enumerate(LABEL_HINTS) for j, hint in enumerate(words))
    return f"""hints AS (SELECT * FROM (VALUES {rows}) AS v(i, label, j, hint)),
hits AS (SELECT section, i, label, count(DISTINCT hint) AS n, string_agg(DISTINCT hint, ', ' ORDER BY hint) AS by_name,
  array_to_string(list_transform(list_sort(list(DISTINCT {{'j': j, 'hint': hint}})), lambda h: h.hint), ', ') AS terms
  FROM ranked JOIN hints ON contains(ngram, hint) WHERE rank <= 15 GROUP BY section, i, label),
best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY section ORDER BY n DESC, i) = 1)"""


@catalog.query(
    "t4_section_labels",
    with_views(
        """
SELECT r.section, coalesce(label, 'Unclear') AS guess_label, coalesce(terms, '') AS support_terms
FROM (SELECT DISTINCT section FROM ranked) r LEFT JOIN best b ON r.section = b.section""",
        SENTENCES, *ngram_sql("sentences", "section", "sentence"), hints_sql(),
    ),
)
def _(t):
    return suggest_labels(top_ngrams(t.sentences, "section", "sentence"), "section")


def near_sql(source: str, by: str, text: str) -> list[str]:
    ones = ", ".join(f"sum(CASE WHEN (h >> {b}) & 1 = 1 THEN 1 ELSE -1 END) AS b{b}" for b in range(64))
    value = " + ".join(f"(CASE WHEN b{b} >= 0 THEN {1 << b}::UBIGINT ELSE 0::UBIGINT END)" for b in range(64))
    return [
        f"""toks AS (SELECT {by} AS g, row_number() OVER () AS id, regexp_extract_all(lower({text}), '[a-z0-9%$.]+') AS w FROM {source} WHERE {text} IS NOT NULL),
shing AS (SELECT g, id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  ELSE [array_to_string(w, ' ')] END) AS s FROM toks),
hashed AS (SELECT g, id, ('0x' || right(md5(s), 16))::UBIGINT AS h FROM shing),
votes AS (SELECT g, id, {ones} FROM hashed GROUP BY g, id),
sim AS (SELECT g, id, {value} AS x FROM votes),
groups AS (SELECT g, x, count(*) AS n FROM sim GROUP BY g, x),
signed AS (SELECT g, x, n, x >= 9223372036854775808::UBIGINT AS neg FROM groups),
pairs AS (SELECT a.g, a.n AS na, b.n AS nb, b.x AS bx FROM signed a JOIN signed b ON a.g = b.g AND (a.x >> 48) = (b.x >> 48)
  AND (a.x < b.x) AND bit_count(xor(a.x, b.x)) <= 3),
per AS (SELECT g, sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS copies, sum(n * (n - 1) // 2)::BIGINT AS equal_pairs FROM groups GROUP BY g),
cross_ AS (SELECT g, sum(na * nb)::BIGINT AS close_pairs, count(DISTINCT bx) AS later FROM pairs GROUP BY g)"""
    ]


NEAR_REPORT = """
SELECT per.g AS {by}, n_rows, copies + coalesce(later, 0) AS n_near_dupes, equal_pairs + coalesce(close_pairs, 0) AS n_near_pairs,
  round((copies + coalesce(later, 0)) * 1.0 / n_rows, 4) AS dup_rate FROM per LEFT JOIN cross_ ON per.g = cross_.g"""


@catalog.query(
    "t2_near_duplicates_by_language",
    with_views(NEAR_REPORT.format(by="lang"), *near_sql("documents", "lang", "text")),
)
def _(t):
    return near_dupes(t.documents, "lang", "text")


@catalog.query(
    "t2_near_duplicates_by_section",
    with_views(NEAR_REPORT.format(by="section"), SENTENCES, *near_sql("sentences", "section", "sentence")),
)
def _(t):
    return near_dupes(t.sentences, "section", "sentence")


@catalog.query(
    "t2_near_duplicates_all_buckets_hot",
    with_views(NEAR_REPORT.format(by="section"), SENTENCES, *near_sql("sentences", "section", "sentence")),
)
def _(t):
    """The same counts when every bucket uses the finer blocks."""
    return near_dupes(t.sentences, "section", "sentence", hot_bucket=1)


def share(pattern: str, n: str = "count(*)", digits: int = 2, text: str = "lower(sentence)") -> str:
    return f"round(count(CASE WHEN regexp_matches({text}, '{pattern}') THEN 1 END) * 100.0 / {n}, {digits})"


@catalog.query(
    "t3_kpi_signal_scan",
    on_sentences(
        "SELECT section, count(*) AS n, "
        + ", ".join(f"{share(p)} AS pct_{name}" for name, p in x.KPI_SIGNALS.items())
        + " FROM sentences GROUP BY section"
    ),
)
def _(t):
    return x.kpi_scan(t.sentences, "section")


def fingerprint_sql(limit: str) -> str:
    counts = ", ".join(f"count(CASE WHEN regexp_matches(lower(sentence), '{p}') THEN 1 END) AS {n}" for n, p in x.KEYWORD_GROUPS.items())
    shares = ", ".join(f"round({n} * 100.0 / n_sampled, 1) AS pct_{n}" for n in x.KEYWORD_GROUPS)
    arms = [
        f"WHEN {n} > greatest({', '.join(o for o in x.DOMINANT if o != n)}) THEN '{label}'" for n, label in x.DOMINANT.items()
    ] + [f"WHEN {n} > 0.02 * n_sampled THEN '{label}'" for n, label in x.FREQUENT.items()]
    return on_sentences(f"""SELECT section, n_sampled, {shares}, CASE {' '.join(arms)} ELSE '{x.UNCLEAR}' END AS inferred_identity, sample_text
FROM (SELECT section, count(*) AS n_sampled, {counts}, string_agg(left(sentence, 100), ' || ' ORDER BY rn) FILTER (rn <= 3) AS sample_text
  FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY md5('42|' || sentenceID), sentenceID, sentence) AS rn
        FROM sentences WHERE length(sentence) > 50) WHERE {limit} GROUP BY section)""")


@catalog.query("t5_section_fingerprint", fingerprint_sql("TRUE"))
def _(t):
    return x.fingerprint(t.sentences)


@catalog.query("t5_section_fingerprint_of_sample", fingerprint_sql("rn <= 500"))
def _(t):
    """The report on a replayable sample of each section, which is what its ``sample`` is for."""
    return x.fingerprint(t.sentences, sample=500)


WORDS = "len(regexp_extract_all(coalesce({c}, ''), '[^ \\t\\n\\x0B\\f\\r]+'))"


def len_stats_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(CASE WHEN coalesce({c}, '') <> '' THEN 1 END) AS n_nonempty, round(avg(length(coalesce({c}, ''))), 6) AS char_mean,
  round(quantile_cont(length(coalesce({c}, '')), 0.95), 6) AS char_p95, round(avg({WORDS.format(c=c)}), 6) AS tok_mean,
  round(quantile_cont({WORDS.format(c=c)}, 0.95), 6) AS tok_p95 FROM {table}"""
        for c in columns
    )


@catalog.query("t6_text_length_stats", len_stats_sql("documents", ["text", "source"]))
def _(t):
    return x.text_len_stats(t.documents, ["text", "source", "absent"])


@catalog.query("t7_guessed_text_columns_stats", len_stats_sql("part", ["p_name", "p_brand", "p_type"]))
def _(t):
    return x.text_len_stats(t.part, x.guess_text_columns(t.part))


def summary_sql() -> str:
    parts = [
        "SELECT 'shape' AS topic, 'rows' AS item, count(*)::DOUBLE AS value FROM docs UNION ALL SELECT 'shape', 'columns', 4.0::DOUBLE",
        *[f"SELECT 'missing', '{c}', round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END), 6)::DOUBLE FROM docs" for c in ("doc_id", "section", "company", "text")],
        *[
            f"SELECT * FROM (SELECT 'top_{c}', CAST({c} AS VARCHAR) AS i, count(*)::DOUBLE AS v FROM docs GROUP BY i ORDER BY v DESC, i LIMIT 15)"
            for c in ("company", "section")
        ],
        *[f"""SELECT 'text_{m}', "column", {m}::DOUBLE FROM stats""" for m in ("n_nonempty", "char_mean", "char_p95", "tok_mean", "tok_p95")],
    ]
    views = ["docs AS (SELECT doc_id, lang AS section, source AS company, text FROM documents)", f"stats AS ({len_stats_sql('docs', ['text'])})"]
    return with_views("\n" + "\nUNION ALL ".join(parts), *views)


@catalog.query("t8_eda_summary", summary_sql())
def _(t):
    docs = t.documents.select("doc_id", F.col("lang").alias("section"), F.col("source").alias("company"), "text")
    return x.eda_summary(docs)
