"""Registered queries: sources, sinks and changes to stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from filigree.catalog.registry import Catalog
from filigree.functions.bins import iso_in_years
from filigree.operators import keyed as k
from filigree.plans.features import add_flags, kpi_prefilter
from filigree.plans.runlog import step_durations
from filigree.session import fresh_path
from filigree.sinks import writers
from filigree.sinks.versions import VersionedTable
from filigree.sources import readers as r
from filigree.sources.fixture_sql import EVENTS_SPLIT, SENTENCES, TARGETS, on_sentences, with_views
from filigree.catalog.features import FLAG_SQL

catalog = Catalog()

ORDER_TEXT = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@catalog.query(
    "src1_parquet_scan_pruned",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
)
def _(t):
    scan = r.read_parquet(t.spark, t.path("orders"))
    return scan.filter((F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F")).select("o_orderkey", "o_totalprice")


INVENTORIED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@catalog.query(
    "src3_file_inventory",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS total_rows, TRUE AS all_rows_in_files FROM {n}" for n in INVENTORIED),
)
def _(t):
    """Rows by table, from the files they lie in."""
    found = None
    for name in INVENTORIED:
        files = r.file_inventory(t.spark, t.path(name))
        held = files.agg(F.sum("n_rows").alias("total_rows"), F.min(F.col("n_rows") > 0).alias("all_rows_in_files"))
        one = held.select(F.lit(name).alias("table_name"), "total_rows", "all_rows_in_files")
        found = one if found is None else found.unionByName(one)
    return found


@catalog.query(
    "src4_json_object_rows",
    "SELECT event_id, 'k' AS key, CAST(props->>'k' AS BIGINT) AS item FROM events WHERE props->>'k' IS NOT NULL",
)
def _(t):
    return t.events.select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "item"))


@catalog.query(
    "src4_ticker_map_from_json_file",
    "SELECT c_custkey::INTEGER::BIGINT AS cik, 'T' || c_custkey AS ticker, c_name AS company_name FROM customer",
)
def _(t):
    """Customers written as one JSON object of objects, read back as rows."""
    item = F.struct(
        F.col("c_custkey").cast("string").alias("cik_str"), F.concat(F.lit("T"), "c_custkey").alias("ticker"),
        F.col("c_name").alias("title"),
    )
    # The file format is one object per file; one file per nation keeps each object small.
    objects = t.customer.groupBy("c_nationkey").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey").cast("string"), item))).alias("m")
    )
    path = fresh_path(t.spark, "tickers")
    objects.select(F.to_json("m").alias("value"), "c_nationkey").write.partitionBy("c_nationkey").text(path)
    tickers = r.read_ticker_map(t.spark, path + "/*")
    return tickers.withColumn("cik", F.col("cik").cast("bigint"))


@catalog.query(
    "src5_holdings_sheet",
    "SELECT c_name AS company_name, 't' || c_custkey AS ticker, c_mktsegment AS sector, round(c_acctbal, 2) AS weight_pct, c_custkey * 1000 AS shares_held FROM customer",
)
def _(t):
    """Customers written like an exported sheet, with banner rows and thousands commas, and cleaned again."""
    pad = F.lit(" ")
    rows = t.customer.select(
        F.concat(pad, "c_name", pad).alias("company_name"), F.concat(F.lit("t"), "c_custkey", pad).alias("ticker"),
        F.lit("id").alias("identifier"), F.lit("s").alias("sedol"), F.format_number("c_acctbal", 2).alias("weight_pct"),
        F.col("c_mktsegment").alias("sector"), F.format_number(F.col("c_custkey") * 1000, 0).alias("shares_held"),
        F.lit("USD").alias("local_currency"),
    )
    banner = [(a, b, *[None] * 6) for a, b in (("Fund Name:", "A fund"), ("Holdings:", "As of 15-Oct-2025"), ("Name", "Ticker"), ("Cash", "-"))]
    cells = ", ".join(f"{c} string" for c in rows.columns)
    sheet = rows.unionByName(t.spark.createDataFrame(banner, cells))
    path = fresh_path(t.spark, "sheet")
    sheet.write.csv(path, header=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return r.read_holdings(t.spark, path).select("company_name", "ticker", "sector", "weight_pct", "shares_held")


@catalog.query(
    "src6_inline_rows_join",
    """SELECT o_orderkey, v.label, v.rank::BIGINT AS rank FROM orders JOIN
  (VALUES ('1-URGENT', 'first', 1), ('2-HIGH', 'second', 2), ('5-LOW', 'last', 5)) AS v(p, label, rank) ON o_orderpriority = p""",
)
def _(t):
    rows = [("1-URGENT", "first", 1), ("2-HIGH", "second", 2), ("5-LOW", "last", 5)]
    inline = t.spark.createDataFrame(rows, "o_orderpriority string, label string, rank bigint")
    return t.orders.join(F.broadcast(inline), "o_orderpriority").select("o_orderkey", "label", "rank")  # three rows


@catalog.query(
    "src7_catalog_columns_filled",
    """SELECT 'orders' AS table_name, position, column_name, n_filled FROM (
  SELECT unnest([1, 2, 3, 4, 5]::BIGINT[]) AS position, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderpriority']) AS column_name,
  unnest([count(o_orderkey), count(o_custkey), count(o_orderstatus), count(o_totalprice), count(o_orderpriority)]) AS n_filled FROM orders)""",
)
def _(t):
    """Columns as the session catalog lists them, each with its non-null rows."""
    from filigree.operators.aggregates import long_form

    orders = writers.create_table(t.orders.select(*ORDER_COLUMNS), "filigree_orders", temporary=True)
    columns = r.catalog_columns(t.spark, "filigree_orders")
    filled = orders.agg(*[F.count(c).alias(c) for c in ORDER_COLUMNS])
    counts = long_form(filled, "column_name", "n_filled", ORDER_COLUMNS, "bigint")
    return columns.join(counts, "column_name").select(F.lit("orders").alias("table_name"), "position", "column_name", "n_filled")


@catalog.query("src8_union_of_splits", ORDER_TEXT)
def _(t):
    rows = t.orders.select(*ORDER_COLUMNS)
    folder = fresh_path(t.spark, "splits")
    status = F.col("o_orderstatus")
    splits = {s: status.eqNullSafe(s) for s in ("F", "O", "P")} | {"rest": status.isNull() | ~status.isin("F", "O", "P")}
    paths = [writers.write_parquet(rows.filter(chosen), f"{folder}/{s}") for s, chosen in splits.items()]
    return r.read_parquet(t.spark, *paths)


@catalog.query("snk1_parquet_zstd_roundtrip", ORDER_TEXT)
def _(t):
    path = writers.write_parquet(t.orders.select(*ORDER_COLUMNS), fresh_path(t.spark, "orders"), block_bytes=16 << 20)
    return r.read_parquet(t.spark, path)


@catalog.query(
    "snk1_partitioned_by_year",
    "SELECT o_orderkey, year(o_orderdate) AS report_year FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 1998",
)
def _(t):
    """Written by year, so that a year window reads only its folders."""
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("report_year"))
    path = writers.write_parquet(rows, fresh_path(t.spark, "by-year"), partition_by=["report_year"])
    return r.read_parquet(t.spark, path).filter(F.col("report_year").between(1997, 1998)).select(
        "o_orderkey", F.col("report_year").cast("bigint").alias("report_year")
    )


@catalog.query(
    "snk2_dimension_export_manifest",
    """SELECT 'nations' AS table_name, count(*) AS rows_exported FROM nation UNION ALL SELECT 'companies', count(*) FROM customer
UNION ALL SELECT 'holdings', count(*) FROM customer WHERE c_acctbal > 5000""",
)
def _(t):
    tables = {"nations": t.nation, "companies": t.customer, "holdings": t.customer.filter(F.col("c_acctbal") > 5000)}
    return writers.export_dimensions(tables, fresh_path(t.spark, "dims")).select("table_name", "rows_exported")


@catalog.query("snk3_view_as_table", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def _(t):
    writers.create_table(t.orders, "filigree_orders_view", temporary=True)
    return t.spark.sql("SELECT o_custkey, count(*) AS n FROM filigree_orders_view GROUP BY o_custkey")


@catalog.query("snk4_named_snapshot", "SELECT c_custkey, c_name FROM customer")
def _(t):
    folder = fresh_path(t.spark, "snapshots")
    path = writers.write_snapshot(t.customer.select("c_custkey", "c_name"), folder, "org/corpus", "train", "all", "small_full")
    return r.read_parquet(t.spark, path)


@catalog.query(
    "snk5_src11_csv_roundtrip",
    on_sentences("SELECT section, count(*) AS n, min(sentence) AS first_text FROM sentences GROUP BY section"),
)
def _(t):
    counts = t.sentences.groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.min("sentence").alias("first_text"))
    path = writers.write_csv(counts, fresh_path(t.spark, "csv"))
    return r.read_csv_log(t.spark, path, counts.schema)


@catalog.query(
    "snk6_nested_json_export",
    with_views(
        "\nSELECT 'kpi_sentences' AS dataset, sentenceID AS sentence_id, sentence AS sentence_text, name AS company_name, report_year "
        "FROM flagged WHERE likely_kpi AND has_numbers",
        SENTENCES,
        FLAG_SQL,
    ),
)
def _(t):
    chosen = kpi_prefilter(add_flags(t.sentences, recent_year=2000), both=True)
    records = writers.kpi_export(chosen, "kpi_sentences")
    path = writers.write_json(records, fresh_path(t.spark, "json"))
    back = t.spark.read.schema(records.schema).json(path)
    return back.select(
        "dataset", "sentence.sentence_id", "sentence.sentence_text", "sentence.metadata.company_name",
        F.col("sentence.metadata.report_year").cast("bigint").alias("report_year"),
    )


@catalog.query(
    "snk7_log_append",
    "SELECT event_type, count(*) AS n_rows, 1::BIGINT AS run FROM events GROUP BY event_type UNION ALL "
    "SELECT event_type, count(*), 2 FROM events GROUP BY event_type",
)
def _(t):
    path = fresh_path(t.spark, "log")
    counts = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))
    for run in (1, 2):
        writers.append_log(counts.withColumn("run", F.lit(run).cast("bigint")), path)
    return r.read_csv_log(t.spark, path, "event_type string, n_rows bigint, run bigint")


@catalog.query(
    "snk8_versions_keep_newest",
    "SELECT event_id, value + 3 AS value FROM events",
)
def _(t):
    table = VersionedTable(fresh_path(t.spark, "versions"), max_versions=2)
    for i in (1, 2, 3):
        table.write(t.events.select("event_id", (F.col("value") + i).alias("value")))
    if table.versions(t.spark) != [2, 3]:
        raise RuntimeError("older versions were kept")
    return table.read(t.spark)


@catalog.query(
    "p29_step_durations",
    """SELECT event_id, round(epoch_us(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 6) AS step_seconds FROM events""",
)
def _(t):
    from filigree.functions.numbers import round_half_away

    timed = step_durations(t.events, ["ts", "event_id"], "ts", ["user_id"])
    return timed.select("event_id", round_half_away(F.col("step_seconds"), 6).alias("step_seconds"))


@catalog.query(
    "dml1_insert_select",
    "SELECT event_id, event_type FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, event_type FROM events WHERE event_type IS DISTINCT FROM 'error'",
)
def _(t):
    path = fresh_path(t.spark, "insert")
    rows = t.events.select("event_id", "event_type")
    error = F.col("event_type").eqNullSafe("error")
    writers.write_parquet(rows.filter(error), path)
    writers.write_parquet(rows.filter(~error), path, mode="append")
    return r.read_parquet(t.spark, path)


@catalog.query(
    "dml2_delete_by_subquery",
    "SELECT event_id, user_id FROM events WHERE event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 150)",
)
def _(t):
    noisy = t.events.filter((F.col("event_type") == "error") & (F.col("value") > 150))
    kept = t.events.filter(F.col("event_type") != "error").select("event_id", "user_id")
    return k.delete_keys(kept, noisy, "user_id")


@catalog.query(
    "dml3_update_by_predicate",
    "SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'PATCHED' ELSE c_name END AS c_name, CASE WHEN c_nationkey = 3 THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal FROM customer",
)
def _(t):
    hit = F.col("c_nationkey") == 3
    patched = t.customer.withColumns(
        {"c_name": F.when(hit, "PATCHED").otherwise(F.col("c_name")), "c_acctbal": F.when(hit, 0.0).otherwise(F.col("c_acctbal"))}
    )
    return patched.select("c_custkey", "c_name", "c_acctbal")


@catalog.query(
    "dml4_update_null_from_lookup",
    with_views(
        """
SELECT cik, company_name, coalesce(ticker, found) AS ticker FROM targets LEFT JOIN (
  SELECT c_name, min('N' || n_nationkey) AS found FROM customer JOIN nation ON c_nationkey >= n_nationkey AND n_regionkey = 2 GROUP BY c_name) ON company_name = c_name""",
        TARGETS,
    ),
)
def _(t):
    nation = t.nation.filter(F.col("n_regionkey") == 2)  # a few of 25 rows
    lookup = t.customer.join(F.broadcast(nation), F.col("c_nationkey") >= F.col("n_nationkey")).select(
        F.col("c_name").alias("company_name"), F.concat(F.lit("N"), "n_nationkey").alias("ticker")
    )
    return k.update_null_from(t.targets.select("cik", "company_name", "ticker"), lookup, "company_name", "ticker")


@catalog.query(
    "dml5_add_and_drop_columns",
    "SELECT event_id, user_id, value, FALSE AS reviewed, CAST(NULL AS VARCHAR) AS note FROM events",
)
def _(t):
    return t.events.drop("props", "ts", "event_type").withColumns(
        {"reviewed": F.lit(False), "note": F.lit(None).cast("string")}
    )


@catalog.query(
    "dml6_p7_upsert",
    with_views(
        """
SELECT event_id, user_id, value FROM base WHERE event_id NOT IN (SELECT event_id FROM incr)
UNION ALL SELECT event_id, user_id, value FROM incr""",
        EVENTS_SPLIT,
    ),
)
def _(t):
    return k.upsert(t.base_events, t.increment_events, "event_id").select("event_id", "user_id", "value")


@catalog.query(
    "fil1_year_text_window",
    on_sentences("SELECT sentenceID, reportDate FROM sentences WHERE report_year BETWEEN 1997 AND 1998 AND length(sentence) > 20"),
)
def _(t):
    kept = t.sentences.filter(iso_in_years(F.col("reportDate"), 1997, 1998) & (F.length("sentence") > 20))
    return kept.select("sentenceID", "reportDate")
