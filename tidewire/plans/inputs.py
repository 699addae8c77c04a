"""Inputs of the catalogued queries, derived from the given tables.

The given tables hold no news or prices, so articles come from `documents`, verdicts from `labels`,
candles and macro series from `events`. The SQL below is shared by both engines: `@str` and `@ts` are
spelled per dialect, `@sha(x)` is SHA-256 in hex and `@documents` is the table. Every row and every
whole text of the tables is used: the content is the text, the headline its first line with a short
market phrase in front, so that the default dictionaries have something to find.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PHRASES = (
    "Bitcoin exchange hacked, funds stolen",
    "SEC lawsuit against Binance",
    "Fed rate cut, CPI inflation falls",
    "Treasury firm buys bitcoin for one billion",
    "Whale moved coins from a dormant wallet",
    "Ethereum surge, rally and breakout",
    "Kraken listing: new token launches, trading pair listed",
    "A quiet day on the market",
    "Solana outage and ripple effects",
    "Tether and USDC stablecoin supply",
    "ETF inflow at record, fund growth",
    "Crash and plunge in defi tokens",
    "Top 10 coins to watch",
    "Analysts say BTC could reach a new high",
    "Avalanche and Aave, decentralized finance loss",
    "Recession fear, GDP and tariff news",
    "Attorney general sues unlicensed broker",
    "Coinbase approved by regulator, profit up",
    "Hyperliquid and Kalshi volumes",
    "Weather report",
    "Dump after pump, support lost",
    "Blockchain vulnerability, exploit drained wallet",
    "Dollar index and interest rate steady",
    "Local sports",
)
_PHRASE_CASE = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES))

_ARTICLES = f"""
SELECT doc_id, k AS url_key, cast(doc_id % 7 AS int) AS feed_ord, doc_id AS entry_ord, source, lang,
  concat('https://news.example/', cast(k AS @str)) AS url,
  @sha(concat('https://news.example/', cast(k AS @str))) AS id,
  concat(CASE doc_id % {len(PHRASES)} {_PHRASE_CASE} END, ' - ', split_part(text, chr(10), 1)) AS title,
  text AS content,
  @ts '2024-01-01 00:00:00' + (((k * 37) % 720) * 3600 + (doc_id % 60) * 60) * INTERVAL '1' SECOND
    AS published_at,
  @ts '2024-01-01 00:00:00' + (((k * 37) % 720) * 3600) * INTERVAL '1' SECOND AS window_start,
  CASE doc_id % 16 WHEN 0 THEN 'regulation' WHEN 1 THEN 'macro' WHEN 2 THEN 'hack' WHEN 3 THEN 'adoption'
    WHEN 4 THEN 'social' WHEN 5 THEN 'exchange' WHEN 6 THEN 'tech' WHEN 7 THEN 'Whale' WHEN 8 THEN 'etf'
    WHEN 9 THEN 'illegal act' WHEN 10 THEN 'on-chain' WHEN 11 THEN 'onchain' WHEN 12 THEN 'unknown'
    WHEN 13 THEN '' WHEN 14 THEN NULL ELSE 'Technical' END AS category
FROM (SELECT *, @key AS k FROM @documents) d
"""


def articles_sql(twins: bool = True) -> str:
    """Cleaned articles. With `twins` every tenth document shares its neighbour's url and hour."""
    key = "doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END" if twins else "doc_id"
    return _ARTICLES.replace("@key", key)


ARTICLES = articles_sql()

VERDICTS = """
SELECT a.doc_id, a.url_key, l.quality = 0 AS is_noise
FROM (SELECT doc_id, doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END AS url_key
      FROM @documents) a
LEFT JOIN @labels l ON a.url_key = l.doc_id
"""

# One verdict per article id, from the label of the document that gave the url its number.
VERDICTS_BY_ID = """
SELECT DISTINCT @sha(concat('https://news.example/', cast(d.k AS @str))) AS id, l.quality = 0 AS is_noise,
  CASE d.k % 3 WHEN 0 THEN 'macro' WHEN 1 THEN 'whale' END AS category
FROM (SELECT doc_id - CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END AS k FROM @documents) d
LEFT JOIN @labels l ON d.k = l.doc_id
"""

WEIGHTS = """
SELECT DISTINCT source,
  cast(0.50 + 0.05 * (cast(substr(source, 4) AS int) % 11) AS decimal(4,2)) AS weight
FROM @documents WHERE source LIKE 'src%' AND cast(substr(source, 4) AS int) < 15
"""

# Class probabilities that vary with the document: headline positive, negative, content same.
PROB_TERMS = tuple(
    f"cast((doc_id * {a}) % {m} AS double) / 200" for a, m in ((37, 101), (53, 97), (29, 101), (71, 97))
)
PROBS = """
SELECT doc_id, {} AS p_pos, {} AS p_neg, {} AS c_pos, {} AS c_neg FROM @documents
""".format(*PROB_TERMS)

CANDLES = """
SELECT event_type AS symbol, date_trunc('hour', ts) AS open_time, min_by(value, ts) AS open,
  max(value) AS high, min(value) AS low, max_by(value, ts) AS close,
  cast(count(*) AS double) AS volume
FROM @events GROUP BY event_type, date_trunc('hour', ts)
"""

MACRO = """
SELECT event_type AS ticker, cast(ts AS date) AS day,
  CASE WHEN event_type = 'click' AND day(cast(ts AS date)) % 5 = 0 THEN 0.0 ELSE max_by(value, ts) END
    AS close
FROM @events GROUP BY event_type, cast(ts AS date)
"""

REPLIES = """
SELECT doc_id, concat('Sure: {"results":[{"is_noise": ',
  CASE doc_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'null' WHEN 3 THEN '"false"'
    WHEN 4 THEN '0' WHEN 5 THEN '""' WHEN 6 THEN '[]' WHEN 7 THEN '1.5' ELSE 'oops' END,
  ', "reason": "reason number ', cast(doc_id AS @str), ' is rather long indeed',
  CASE WHEN doc_id % 11 = 0 THEN concat(' it', chr(39), 's') ELSE '' END,
  '"', CASE WHEN doc_id % 4 = 0 THEN ', "category": "macro"'
            WHEN doc_id % 4 = 1 THEN ', "category": null' ELSE '' END, '}]} done') AS reply
FROM @documents
"""

TABLES = ("documents", "labels", "events", "pages", "conversations")
TICKERS = {
    "dxy": ("click", "view"),
    "gold_price": ("error",),
    "sp500_return_1d": ("purchase",),
    "us_10y_yield": ("signup",),
}
SYMBOL = "view"


def duck(sql: str) -> str:
    sql = re.sub(r"@sha\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)", r"sha256(\1)", sql)
    sql = sql.replace("@str", "varchar").replace("@ts", "TIMESTAMP")
    return re.sub(r"@(\w+)", r"\1", sql)


class Inputs:
    """The derived frames for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, sql: str, **tables: DataFrame) -> DataFrame:
        sql = sql.replace("{", "{{").replace("}", "}}")
        sql = re.sub(r"@sha\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)", r"sha2(\1, 256)", sql)
        sql = sql.replace("@str", "string").replace("@ts", "TIMESTAMP_NTZ")
        used = {t: tables[t] if t in tables else self.table(t) for t in TABLES if f"@{t}" in sql}
        return self.spark.sql(re.sub(r"@(\w+)", r"{\1}", sql), **used)

    def articles(self) -> DataFrame:
        return self.view(ARTICLES)

    def verdicts(self) -> DataFrame:
        return self.view(VERDICTS).select("doc_id", "is_noise")

    def judged(self) -> DataFrame:
        """Articles with their label as the verdict."""
        return self.articles().join(self.verdicts(), "doc_id", "left")

    def scored(self) -> DataFrame:
        """Articles with given class probabilities."""
        def probs(pos: str, neg: str) -> str:
            return f"named_struct('positive', {pos}, 'negative', {neg}, 'neutral', 1 - {pos} - {neg})"

        return self.articles().selectExpr(
            "*",
            f"{probs(*PROB_TERMS[:2])} AS headline_probs",
            f"{probs(*PROB_TERMS[2:])} AS content_probs",
        )

    def raw(self) -> DataFrame:
        """Articles as fetched: markup, padding, missing parts and dates in several formats."""
        a = self.articles()
        d, ts = F.col("doc_id"), F.col("published_at")
        rfc = F.date_format(ts + F.expr("INTERVAL '2' HOUR"), "EEE, dd MMM yyyy HH:mm:ss")
        date = (
            F.when(d % 97 == 96, "some day")
            .when(d % 4 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
            .when(d % 4 == 1, F.concat(rfc, F.lit(" +0200")))
            .when(d % 4 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(ts, "dd MMM yyyy HH:mm 'GMT'"))
        )
        return a.select(
            "doc_id", "feed_ord", "entry_ord", "source",
            F.when(d % 53 != 52, F.concat(F.lit("<b>"), "title", F.lit("</b>"))).alias("title"),
            F.when(d % 61 != 60, F.concat(F.lit("<p class='a>b'>"), "content", F.lit("</p><!-- x -->")))
            .alias("content"),
            F.when(d % 59 == 58, "  ").otherwise(F.concat(F.lit(" "), "url", F.lit("\n"))).alias("url"),
            date.alias("raw_published_at"),
        )

    def candles(self) -> DataFrame:
        return self.view(CANDLES).withColumn("open_time", F.col("open_time").cast("timestamp_ntz"))

    def macro(self) -> DataFrame:
        return self.view(MACRO).withColumn("close", F.col("close").cast("double"))

    def snapshots(self) -> DataFrame:
        """JSON bodies of two kinds in one series of snapshots."""
        dominance = F.concat(
            F.lit('{"data":{"market_cap_percentage":{"btc":'), F.col("value").cast("string"), F.lit("}}}")
        )
        index = F.concat(
            F.lit('{"data":[{"value":"'), F.get_json_object("props", "$.k"), F.lit('"}]}')
        )
        return self.table("events").select(
            "event_id", "ts", F.when(F.col("event_id") % 3 == 0, index).otherwise(dominance).alias("body")
        )
