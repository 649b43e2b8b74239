"""Registered queries: projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from filigree.catalog.registry import Catalog
from filigree.functions import arrays, text
from filigree.functions.bins import label_by_threshold, temporal_bin
from filigree.functions.numbers import percent, round_half_away, with_unit
from filigree.plans import merge as m
from filigree.sources.fixture_sql import SENTENCES, TARGETS, bin_case, on_sentences, with_views
from filigree.sources.fixtures import FIVE, THREE

catalog = Catalog()


@catalog.query(
    "prj1_lean_columns",
    on_sentences("SELECT cik, cik_int, name, docID, sentenceID, section, form, sic, sentence, filingDate, report_year, reportDate FROM sentences"),
)
def _(t):
    return t.sentences.select(
        "cik", "cik_int", "name", "docID", "sentenceID", "section", "form", "sic", "sentence", "filingDate",
        "report_year", "reportDate",
    )


@catalog.query(
    "prj2_rename_drop_reorder",
    on_sentences("SELECT sentenceID, sic, 'ITEM_' || section AS section_name, report_year FROM sentences"),
)
def _(t):
    incoming = t.sentences.select(
        F.col("sic").alias("SIC"), "sentenceID", F.concat(F.lit("ITEM_"), F.col("section")).alias("section_item"),
        F.lit("old").alias("section_name"), F.lit(1).alias("sentence_index"), "report_year",
    )
    base = StructType(
        [StructField("sentenceID", StringType()), StructField("sic", StringType()), StructField("section_name", StringType()),
         *[f for f in incoming.schema.fields if f.name == "report_year"]]
    )
    return m.align_to(m.rename_incoming(incoming), base)


@catalog.query(
    "prj3_typed_null_placeholders",
    """SELECT o_orderkey, CAST(NULL AS DOUBLE) AS sampling_rate_pct, CAST(NULL AS BOOLEAN) AS likely_kpi,
  CAST(NULL AS VARCHAR) AS tickers_text, CAST(NULL AS BIGINT) AS label_1d FROM orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.lit(None).cast("double").alias("sampling_rate_pct"),
        F.lit(None).cast("boolean").alias("likely_kpi"),
        F.array_join(F.lit(None).cast("array<string>"), ",").alias("tickers_text"),
        F.lit(None).cast("struct<`1d`:bigint,`5d`:bigint>").getField("1d").alias("label_1d"),
    )


@catalog.query(
    "prj4_temporal_bins",
    on_sentences(f"""SELECT {bin_case('report_year', THREE)} AS three_bins, {bin_case('report_year', FIVE)} AS five_bins, count(*) AS n
FROM sentences GROUP BY 1, 2"""),
)
def _(t):
    year = F.col("report_year")
    return t.sentences.groupBy(
        temporal_bin(year, THREE).alias("three_bins"), temporal_bin(year, FIVE).alias("five_bins")
    ).agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    "prj5_tier_labels",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 9000 THEN 'mega' WHEN c_acctbal >= 5000 THEN 'large'
  WHEN c_acctbal >= 1000 THEN 'mid' ELSE 'small' END AS tier FROM customer""",
)
def _(t):
    steps = ((9000.0, "mega"), (5000.0, "large"), (1000.0, "mid"))
    return t.customer.select("c_custkey", label_by_threshold(F.col("c_acctbal"), steps, "small").alias("tier"))


@catalog.query(
    "prj6_row_hash_and_lineage",
    "SELECT doc_id, md5(CAST(doc_id AS VARCHAR) || text) AS row_hash, 'v1' AS sample_version, 'fixture' AS source_file_path, 'initial' AS load_method FROM documents",
)
def _(t):
    return t.documents.select(
        "doc_id",
        text.row_hash(F.col("doc_id").cast("string"), F.col("text")).alias("row_hash"),
        F.lit("v1").alias("sample_version"),
        F.lit("fixture").alias("source_file_path"),
        F.lit("initial").alias("load_method"),
    )


@catalog.query(
    "prj7_text_measures",
    """SELECT doc_id, length(text) AS chars, length(text) - length(replace(text, ' ', '')) + 1 AS approx_words,
  len(string_split(text, ' ')) AS pieces, len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')) AS words FROM documents""",
)
def _(t):
    body = F.col("text")
    return t.documents.select(
        "doc_id", text.char_count(body).alias("chars"), text.blank_count(body).alias("approx_words"),
        text.split_count(body).alias("pieces"), text.word_count(body).alias("words"),
    )


@catalog.query(
    "prj8_placeholders_by_name",
    """SELECT c_custkey, CASE WHEN upper(c_name) LIKE '%7%' OR upper(c_name) LIKE '%99%' THEN 'T7,T7.A' ELSE 'MANUAL_REVIEW_REQ' END AS tickers,
  CASE WHEN upper(c_name) LIKE '%7%' OR upper(c_name) LIKE '%99%' THEN 'DE' ELSE 'XX' END AS state,
  CAST(CASE WHEN upper(c_name) LIKE '%7%' OR upper(c_name) LIKE '%99%' THEN 2 ELSE 1 END AS BIGINT) AS ticker_count FROM customer""",
)
def _(t):
    known = m.name_matches(F.col("c_name"), ["7", "99"])
    filled = t.customer.withColumns(m.company_placeholders(known, ["T7", "T7.A"], ["NYSE"], "DE"))
    return filled.select(
        "c_custkey",
        F.array_join("tickers", ",").alias("tickers"),
        F.col("stateOfIncorporation").alias("state"),
        F.col("tickerCount").cast("bigint").alias("ticker_count"),
    )


@catalog.query(
    "prj9_conditional_upper",
    """SELECT p_partkey, CASE WHEN starts_with(p_name, 'cold') THEN upper(p_name) ELSE p_name END AS p_name,
  CASE WHEN starts_with(p_name, 'cold') THEN upper(p_brand) ELSE p_brand END AS p_brand FROM part""",
)
def _(t):
    return text.upper_strings_where(t.part.select("p_partkey", "p_name", "p_brand"), F.startswith("p_name", F.lit("cold")))


@catalog.query(
    "fil2_pattern_search",
    on_sentences("""SELECT cik_int, name, min(reportDate) AS earliest, max(reportDate) AS latest, count(DISTINCT docID) AS n_filings, count(*) AS n_sentences
FROM sentences WHERE cik_int = 17 OR upper(name) LIKE '%#%99' OR list_contains(tickers, 'T42') OR array_to_string(tickers, ',') LIKE '%T12%'
GROUP BY cik_int, name"""),
)
def _(t):
    wanted = (
        (F.col("cik_int") == 17)
        | F.upper("name").like("%#%99")
        | F.array_contains("tickers", "T42")
        | F.array_join("tickers", ",").like("%T12%")
    )
    return t.sentences.filter(F.coalesce(wanted, F.lit(False))).groupBy("cik_int", "name").agg(
        F.min("reportDate").alias("earliest"), F.max("reportDate").alias("latest"),
        F.countDistinct("docID").alias("n_filings"), F.count(F.lit(1)).alias("n_sentences"),
    )


@catalog.query(
    "fn_string_functions",
    """SELECT c_custkey, upper(trim(c_name)) AS u, lower(c_mktsegment) AS l, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded,
  left(c_name, 8) AS first8, substr(c_name, 10, 4) AS mid4, c_name[1:6] AS slice, length(c_name) AS n, replace(c_name, '#', '-') AS r,
  concat(c_name, '/', c_mktsegment) AS joined, split_part(c_name, '#', 1) AS piece, contains(c_name, '99') AS has99,
  starts_with(c_name, 'Cust') AS starts FROM customer""",
)
def _(t):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey", F.upper(F.trim(name)).alias("u"), F.lower("c_mktsegment").alias("l"),
        text.padded_key(F.col("c_custkey")).alias("padded"), F.left(name, F.lit(8)).alias("first8"),
        F.substring(name, 10, 4).alias("mid4"), F.substring(name, 1, 6).alias("slice"),
        text.char_count(name).alias("n"), F.replace(name, F.lit("#"), F.lit("-")).alias("r"),
        F.concat(name, F.lit("/"), F.col("c_mktsegment")).alias("joined"),
        F.split(name, "#")[0].alias("piece"), F.contains(name, F.lit("99")).alias("has99"),
        F.startswith(name, F.lit("Cust")).alias("starts"),
    )


@catalog.query(
    "fn_regex_functions",
    on_sentences("""SELECT sentenceID, sentence, regexp_matches(sentence, '(?i)net SALES') AS hit, regexp_replace(sentence, '[0-9]+', '#', 'g') AS masked,
  regexp_extract(sentence, '([0-9]+) million', 1) AS millions, array_to_string(regexp_extract_all(sentence, '[0-9]+'), '|') AS numbers FROM sentences"""),
)
def _(t):
    body = F.col("sentence")
    return t.sentences.select(
        "sentenceID", "sentence", body.rlike("(?i)net SALES").alias("hit"),
        F.regexp_replace(body, "[0-9]+", "#").alias("masked"),
        F.regexp_extract(body, "([0-9]+) million", 1).alias("millions"),
        F.array_join(F.regexp_extract_all(body, F.lit("[0-9]+"), F.lit(0)), "|").alias("numbers"),
    )


SPELLINGS = """CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
  WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
  WHEN 4 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'n/a' END"""


@catalog.query(
    "fn_date_format_chain",
    f"""SELECT year(d) AS y, count(*) AS n FROM (SELECT coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%Y/%m/%d'),
  try_strptime(s, '%Y-%m-%d %H:%M:%S'), try_strptime(s, '%Y-%m-%dT%H:%M:%S'), try_strptime(s, '%Y%m%d')) AS d
FROM (SELECT {SPELLINGS} AS s FROM orders)) GROUP BY 1""",
)
def _(t):
    spelling = F.lit("n/a")
    for i, fmt in reversed(list(enumerate(text.DATE_FORMATS))):
        spelling = F.when(F.col("o_orderkey") % 6 == i, F.date_format("o_orderdate", fmt)).otherwise(spelling)
    years = t.orders.select(F.year(text.parse_date(spelling)).cast("bigint").alias("y"))
    return years.groupBy("y").agg(F.count(F.lit(1)).alias("n"))  # unparsed rows count under null


@catalog.query(
    "fn_date_arithmetic",
    """SELECT event_id, year(ts) AS y, extract(month FROM ts)::BIGINT AS mon, CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
  epoch(ts - TIMESTAMP '2024-01-01 00:00:00')::BIGINT AS seconds, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour FROM events""",
)
def _(t):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id", F.year("ts").cast("bigint").alias("y"), F.extract(F.lit("month"), F.col("ts")).cast("bigint").alias("mon"),
        F.to_date("ts").cast("string").alias("d"),
        # DuckDB rounds seconds to the nearest integer
        F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6 + 0.5).alias("seconds"),
        F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("hour"),
    )


@catalog.query(
    "fn_math_and_conditionals",
    """SELECT c_custkey, round(c_acctbal / 7, 2) AS rounded, abs(c_acctbal) AS absolute, greatest(c_acctbal, 1000) AS at_least,
  round(c_acctbal * 100.0 / nullif(c_nationkey, 0), 2) AS guarded, coalesce(nullif(c_nationkey, 3), 99)::BIGINT AS filled FROM customer""",
)
def _(t):
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return t.customer.select(
        "c_custkey", round_half_away(balance / 7, 2).alias("rounded"), F.abs(balance).alias("absolute"),
        F.greatest(balance, F.lit(1000.0)).alias("at_least"), percent(balance, nation).alias("guarded"),
        F.coalesce(F.nullif(nation, F.lit(3)), F.lit(99)).cast("bigint").alias("filled"),
    )


@catalog.query(
    "fn_casts_and_types",
    """SELECT c_custkey, TRY_CAST(c_mktsegment AS BIGINT) AS bad, TRY_CAST(right(c_name, 4) AS BIGINT) AS good,
  CAST(floor(c_acctbal) AS BIGINT) AS whole, CASE WHEN typeof(c_name) = 'VARCHAR' THEN 'text' ELSE 'other' END AS kind FROM customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey", F.col("c_mktsegment").try_cast("bigint").alias("bad"),
        F.right("c_name", F.lit(4)).try_cast("bigint").alias("good"), F.floor("c_acctbal").alias("whole"),
        F.when(F.typeof("c_name") == "string", "text").otherwise("other").alias("kind"),
    )


@catalog.query(
    "fn_array_functions",
    on_sentences("""SELECT sentenceID, sentence, list_contains(tickers, 'T7') AS has_t7, array_to_string(tickers, ',') AS joined, len(tickers) AS n,
  tickers[1] AS first_ticker, tickers = ['T7', 'T7.A'] AS same FROM sentences"""),
)
def _(t):
    lists = F.col("tickers")
    return t.sentences.select(
        "sentenceID", "sentence", F.array_contains(lists, "T7").alias("has_t7"), F.array_join(lists, ",").alias("joined"),
        F.when(lists.isNotNull(), F.size(lists)).cast("bigint").alias("n"), arrays.first_item(lists).alias("first_ticker"),
        (lists == F.array(F.lit("T7"), F.lit("T7.A"))).alias("same"),
    )


@catalog.query(
    "fn_list_merge_in_group",
    on_sentences("""SELECT report_year, count(DISTINCT k) AS n_tickers, min(k) AS first_ticker, max(k) AS last_ticker
FROM (SELECT report_year, unnest(tickers) AS k FROM sentences) GROUP BY report_year"""),
)
def _(t):
    merged = arrays.merge_lists(t.sentences, ["report_year"], "tickers", "merged")
    return merged.select(
        "report_year", F.size("merged").cast("bigint").alias("n_tickers"),
        F.array_min("merged").alias("first_ticker"), F.array_max("merged").alias("last_ticker"),
    )


@catalog.query(
    "fn_list_arithmetic",
    """SELECT vec_id, round(list_max(embedding)::DOUBLE, 5) AS x_max, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 5) AS x_sum,
  len(list_filter(embedding, lambda x: x >= 0.0::FLOAT AND x <= 0.1::FLOAT)) AS n_between,
  round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * (x::DOUBLE + 3))), 5) AS z_sum FROM embeddings""",
)
def _(t):
    x = F.transform("embedding", lambda e: e.cast("double"))
    flags = arrays.between_each(F.col("embedding"), 0.0, 0.1)
    z = arrays.multiply_lists(x, arrays.add_to_each(x, 3.0))
    return t.embeddings.select(
        "vec_id", round_half_away(F.array_max("embedding"), 5).alias("x_max"),
        round_half_away(arrays.list_sum(x, "double"), 5).alias("x_sum"),
        F.size(F.filter(flags, lambda b: b)).cast("bigint").alias("n_between"),
        round_half_away(arrays.list_sum(z, "double"), 5).alias("z_sum"),
    )


@catalog.query(
    "fn_list_concat_columns",
    on_sentences("SELECT sentenceID, sentence, array_to_string(list_concat(coalesce(tickers, []), [form, sic]), '|') AS combined FROM sentences"),
)
def _(t):
    empty = F.array().cast("array<string>")
    combined = F.concat(F.coalesce("tickers", empty), F.array("form", "sic"))
    return t.sentences.select("sentenceID", "sentence", F.array_join(combined, "|").alias("combined"))


@catalog.query(
    "fn_json_fields",
    "SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, props->>'missing' AS missing FROM events",
)
def _(t):
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.get_json_object("props", "$.missing").alias("missing")
    )


@catalog.query(
    "fn_struct_fields",
    """SELECT event_id, user_id AS "u", event_type AS "t", CASE WHEN value > 100 THEN value END AS ret, '{"u":' || user_id || ',"t":"' || event_type || '"}' AS as_json FROM events""",
)
def _(t):
    key = F.struct(F.col("user_id").alias("u"), F.col("event_type").alias("t"))
    nested = F.when(F.col("value") > 100, F.struct(F.col("value").alias("ret")))
    rows = t.events.select("event_id", key.alias("key"), nested.alias("returns"))
    return rows.select("event_id", "key.u", "key.t", F.col("returns.ret").alias("ret"), F.to_json("key").alias("as_json"))


@catalog.query(
    "fn_report_text",
    "SELECT year(o_orderdate) AS y, count(*) AS n, printf('%.2f', round(count(*) / 1000.0::DOUBLE, 2)) || 'K' AS thousands FROM orders GROUP BY 1",
)
def _(t):
    return t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("y")).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "thousands", with_unit(F.col("n") / 1000.0, "K")
    )


@catalog.query(
    "p18_normalised_names",
    """SELECT c_custkey, upper(trim(regexp_replace(n, ' INC\\.?$| CORP\\.?$| CO\\.?$| LTD\\.?$| LLC\\.?$| PLC\\.?$', '', 'g'))) AS name FROM (
  SELECT c_custkey, c_name || [' INC.', ' CORP', ' CO', ' LTD.', ' Llc', ' PLC'][1 + c_custkey % 6] AS n FROM customer)""",
)
def _(t):
    forms = F.array(*[F.lit(x) for x in (" INC.", " CORP", " CO", " LTD.", " Llc", " PLC")])
    name = F.concat(F.col("c_name"), F.element_at(forms, (F.col("c_custkey") % 6 + 1).cast("int")))
    return t.customer.select("c_custkey", text.normalise_name(name).alias("name"))
