"""The test tables and the filing-shaped views derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filigree.functions.bins import Bin
from filigree.sources.readers import spread, spread_by_key

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LONG_TEXTS = ("documents", "pages")

THREE = (Bin("bin_1995_1996", 1995, 1996), Bin("bin_1997_1998", 1997, 1998), Bin("bin_1999_2001", 1999, 2001))
FIVE = (
    Bin("bin_1995", 1995, 1995),
    Bin("bin_1996", 1996, 1996),
    Bin("bin_1997_1998", 1997, 1998),
    Bin("bin_1999", 1999, 1999),
    Bin("bin_2000_2001", 2000, 2001),
)


class Tables:
    """Lazy access to one scale-factor folder; ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            table = self.spark.read.parquet(self.path(name))
            return spread(table) if name in LONG_TEXTS else table
        raise AttributeError(name)

    @property
    def sentences(self) -> DataFrame:
        """Sentence fact: one row per order line, with filing identifiers and generated text.

        Orders meet their customers first, so that the lines are shuffled once.
        """
        price = F.floor("l_extendedprice").cast("string")
        quantity = F.floor("l_quantity").cast("string")
        year = F.year("o_orderdate").cast("bigint")
        code = F.col("l_suppkey") % 8
        text = (
            F.when(code == 0, F.concat(F.lit("Net sales were $"), price, F.lit(" million in "),
                                       year.cast("string"), F.lit(" versus the prior year.")))
            .when(code == 1, F.lit("We expect significant volatility and other risks to our operations."))
            .when(code == 2, F.concat(F.lit("Operating margin improved to "), quantity, F.lit(".5% of revenue.")))
            .when(code == 3, F.lit("Item 1B. None."))
            .when(code == 4, F.lit("This forward-looking statement is subject to the safe harbor "
                                   "and actual results may differ."))
            .when(code == 5, F.concat(F.lit("The Company leased "), quantity,
                                      F.lit(" facilities  under long term agreements.")))
            .when(code == 6, F.concat(F.lit("Total debt declined by "), quantity, F.lit(","),
                                      F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"),
                                      F.lit(" (in thousands).")))
            .otherwise(F.concat(F.lit("See Exhibit 10."), quantity, F.lit(" filed herewith.")))
        )
        key = F.col("o_custkey").cast("string")
        tickers = (
            F.when(F.col("o_custkey") % 11 == 0, F.lit(None).cast("array<string>"))
            .when(F.col("o_custkey") % 13 == 0, F.array().cast("array<string>"))
            .otherwise(F.array(F.concat(F.lit("T"), key), F.concat(F.lit("T"), key, F.lit(".A"))))
        )
        cik = F.lpad(key, 10, "0")
        doc_id = F.concat(cik, F.lit("_10-K_"), year.cast("string"))
        section = F.col("l_partkey") % 20
        sentence_id = F.concat_ws(
            "_", doc_id, F.lit("section"), section.cast("string"),
            F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        )
        filed = self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
        lines, filed = spread_by_key(self.lineitem, "l_orderkey", filed, "o_orderkey")
        joined = lines.join(filed, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.select(
            cik.alias("cik"),
            F.col("o_custkey").alias("cik_int"),
            F.col("c_name").alias("name"),
            tickers.alias("tickers"),
            doc_id.alias("docID"),
            sentence_id.alias("sentenceID"),
            section.alias("section"),
            F.lit("10-K").alias("form"),
            F.col("c_mktsegment").alias("sic"),
            text.alias("sentence"),
            F.date_format(F.date_add(F.to_date("o_orderdate"), 45), "yyyy-MM-dd").alias("filingDate"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("reportDate"),
            year.alias("report_year"),
        )

    @property
    def targets(self) -> DataFrame:
        """Target companies; every seventh id is shifted so that only its ticker can match."""
        key = F.col("c_custkey")
        return self.customer.select(
            F.when(key % 7 == 0, key + 10_000_000).otherwise(key).cast("string").alias("cik"),
            F.col("c_name").alias("company_name"),
            F.when(key % 5 != 0, F.concat(F.lit("t"), key.cast("string"))).alias("ticker"),
            F.when(F.col("c_acctbal") >= 5000, "sp500").otherwise("notable").alias("source"),
            F.col("c_mktsegment").alias("tier"),
            F.when(F.col("c_acctbal") >= 5000, F.col("c_acctbal")).alias("weight_pct"),
            F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal")).alias("quality_score"),
        )

    @property
    def passages(self) -> DataFrame:
        """Vector of one passage an order: an embedding with one value raised, owned by a company that may be hot."""
        count = self.embeddings.agg(F.count("*").alias("n_vectors"))
        base = spread(self.orders).crossJoin(F.broadcast(count)).withColumn("vec_id", F.col("o_custkey") % F.col("n_vectors"))
        key = F.col("o_orderkey")
        raised = F.transform("embedding", lambda x, i: x.cast("double") + F.when(i == key % 64, (key % 9) / 16.0).otherwise(0.0))
        return base.join(self.embeddings, "vec_id").select(
            key.alias("passage_id"),
            F.when(F.col("vec_id") % 3 == 0, F.lit(0)).otherwise(F.col("vec_id") % 10).cast("bigint").alias("cik"),
            (key % 5).cast("bigint").alias("section"),
            (F.floor(F.year("o_orderdate") / 10) * 10).cast("bigint").alias("decade"),
            raised.alias("vector"),
        )

    @property
    def split_sentences(self) -> DataFrame:
        """Sentences of the documents, cut at a full stop and a blank; every twenty lines are a section."""
        lines = self.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "whole"))
        section = F.floor(F.col("line") / 20).cast("bigint")
        return lines.select("doc_id", section.alias("section"), "line", F.posexplode(F.split("whole", r"\. ", -1)).alias("place", "sentence"))

    @property
    def base_events(self) -> DataFrame:
        """Merge base: everything before 24 January."""
        return self.events.filter(F.col("ts") < F.lit("2024-01-24").cast("timestamp_ntz"))

    @property
    def increment_events(self) -> DataFrame:
        """Merge increment: from 18 January on, values raised by one, overlapping the base."""
        return self.events.filter(F.col("ts") >= F.lit("2024-01-18").cast("timestamp_ntz")).withColumn(
            "value", F.col("value") + 1
        )
