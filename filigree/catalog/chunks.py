"""Registered queries: chunks of sentences, by sliding windows and by density."""

from __future__ import annotations

from filigree.catalog.registry import Catalog
from filigree.plans.chunks import density_chunks, sliding_chunks
from filigree.sources.fixture_sql import SPLIT_SENTENCES, with_views

catalog = Catalog()

SECTION = ("doc_id", "section")
ORDER = ("line", "place")
NUMBERED = """
, numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, section ORDER BY line, place, sentence) - 1 AS p,
  len(list_filter(string_split(sentence, ' '), lambda w: w <> '')) AS words FROM split_sentences)"""


@catalog.query(
    "c1_sliding_chunks",
    with_views(
        NUMBERED + """
, ahead AS (SELECT *, count(*) OVER w AS n_sentences, string_agg(sentence, ' ') OVER w AS text FROM numbered
  WINDOW w AS (PARTITION BY doc_id, section ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))
SELECT doc_id, section, p AS first, n_sentences, text FROM ahead WHERE p = 0 OR n_sentences = 3
""",
        SPLIT_SENTENCES,
    ),
)
def _(t):
    return sliding_chunks(t.split_sentences, SECTION, ORDER, "sentence")


@catalog.query(
    "c2_density_chunks",
    with_views(
        NUMBERED + """
, density AS (SELECT doc_id, sum(words) AS total, count(*) AS n FROM numbered GROUP BY doc_id),
sized AS (SELECT s.*, CASE WHEN total >= 26 * n THEN 3 WHEN total >= 18 * n THEN 4 ELSE 5 END AS size,
    CASE WHEN total >= 18 * n THEN 1 ELSE 2 END AS overlap, count(*) OVER (PARTITION BY s.doc_id, section) AS n_section,
    sum(words) OVER (PARTITION BY s.doc_id, section ORDER BY p) AS upto
  FROM numbered s JOIN density d ON d.doc_id = s.doc_id),
taken AS (SELECT a.doc_id, a.section, a.p, a.overlap, a.n_section, count(*) AS take, sum(b.words) AS n_words, string_agg(b.sentence, ' ' ORDER BY b.p) AS text
  FROM sized a JOIN sized b ON b.doc_id = a.doc_id AND b.section = a.section AND b.p >= a.p AND b.p < a.p + a.size
    AND (b.p = a.p OR b.upto - a.upto + a.words <= 200) GROUP BY a.doc_id, a.section, a.p, a.overlap, a.n_section),
walk AS (SELECT doc_id, section, 0::BIGINT AS p FROM taken WHERE p = 0
  UNION ALL
  SELECT w.doc_id, w.section, w.p + greatest(t.take - t.overlap, 1) FROM walk w JOIN taken t ON t.doc_id = w.doc_id AND t.section = w.section AND t.p = w.p
  WHERE t.p + t.take < t.n_section)
SELECT t.doc_id, t.section, t.p AS first, take AS n_sentences, CAST(n_words AS BIGINT) AS n_words, n_words > 200 AS oversized, text
FROM walk w JOIN taken t ON t.doc_id = w.doc_id AND t.section = w.section AND t.p = w.p
""",
        SPLIT_SENTENCES,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _(t):
    return density_chunks(t.split_sentences, SECTION, ORDER, "sentence", ("doc_id",))
