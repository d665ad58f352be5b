"""The registered queries: every operator over the whole tables of a data folder.

Decimals leave as doubles so that results compare with any SQL engine's; the plans themselves
keep exact decimals up to that last projection.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import feeds, schemas
from tidemark.feeds import Tables
from tidemark.functions import keys
from tidemark.functions.sentiment import Lexicon, normalise_label
from tidemark.operators import asof, calendar, ingest, intervals, labelling, reconcile, selection, sketches
from tidemark.operators.labelling import label_with_lexicon
from tidemark.plans import analysis, gold_insider, gold_news, gold_price, incremental, ingestion, pipeline, quality, silver
from tidemark.plans import gold as gold_plan
from tidemark.session import lead_workers_here, shared_dir
from tidemark.sources import landing, pages, sinks
from tidemark.sources.layers import Layers
from tidemark.streaming import batches, daily, rolling

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the queries; the reference results use the same values.
UNIVERSE = ("TK1", "TK2", "TK3", "TK4")
SESSIONS = 5
ARTICLES_AS_OF = dt.date(2024, 1, 16)
ARTICLE_KEYWORD = "reti"
ARTICLE_DOMAINS = ("example.com", "example.org")
TRADES_AS_OF = dt.date(1998, 6, 16)
LEXICON = Lexicon(good=("is", "of", "with", "there"), bad=("and", "to", "was", "what"))


def query(build: Callable[[Tables], DataFrame]) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Tables(spark, sf_dir)))

    run.__doc__ = build.__doc__
    REGISTRY[build.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    types = df.dtypes
    if not any(kind.startswith("decimal") for _, kind in types):
        return df
    return df.selectExpr(
        *[
            f"cast(`{name}` AS DOUBLE) AS `{name}`" if kind.startswith("decimal") else f"`{name}`"
            for name, kind in types
        ]
    )


# --- Bronze -----------------------------------------------------------------------------


@query
def bronze_stocks_scan(t):
    """Daily bars as landed frames, appended and brought to the landed types."""
    landed = feeds.bars(t)
    typed = landing.bars_scan(ingest.append_frames([landed], landed.schema, t.spark))
    return _exact_bars(typed)


def _exact_bars(df: DataFrame) -> DataFrame:
    return df.select("ticket", "date", *landing.BAR_FIELDS)


@query
def bronze_wide_to_long(t):
    """Bars laid out one column per field and ticker, turned back into rows."""
    return landing.wide_to_long(feeds.wide_bars(t))


@query
def universe_filter(t):
    """Bars of four tickers."""
    return _exact_bars(selection.in_universe(feeds.bars(t), "ticket", UNIVERSE))


@query
def lookback_period(t):
    """All quotes of each ticker's newest five sessions."""
    recent = selection.last_sessions(feeds.quotes(t), SESSIONS)
    return recent.select("ticket", "date", "close", "volume")


@query
def news_payload_flatten(t):
    """Articles of the payloads with status ok."""
    return landing.flatten_news(feeds.news_payloads(t))


@query
def news_predicates(t):
    """English articles from two sites that name the keyword, since the day before."""
    found = selection.matching_articles(
        feeds.page_articles(t),
        ARTICLE_KEYWORD,
        ARTICLES_AS_OF,
        text=("description",),
        domains=ARTICLE_DOMAINS,
    )
    return found.select("event_id", "url", "published_at")


@query
def news_top30(t):
    """The newest 30 articles of each company."""
    keyed = landing.key_news(feeds.articles(t))
    return selection.newest_articles(keyed).select("hash", "company", "published_at", "title")


@query
def news_pages(t):
    """Two overlapping pulls of each company and hour: every different article is stored once,
    the newest 30 of each landed page."""
    landed = feeds.articles(t).withColumn(
        "pull", F.explode(F.expr("filter(array(0, 1), p -> event_id % 3 <> p)"))
    )
    hour = F.date_trunc("hour", "ts")
    keyed = landing.key_news(
        landed.withColumn("page", F.struct(hour.alias("hour"), "pull")), keep=("page", "event_id")
    )
    document = ("company", "page")
    different = ingest.first_write_wins(keyed, ["event_id"], (*document, "hash"))
    pages = selection.newest_articles(different, group=document)
    return ingest.first_write_wins(pages, ["page", "event_id"]).select("hash", "company", "published_at")


@query
def insider_payload_flatten(t):
    """Records of the non-empty payloads, under the symbol that was asked for."""
    return landing.flatten_insider(feeds.insider_payloads(t))


@query
def insider_date_window(t):
    """Trades of the day before."""
    keyed = landing.key_insider(feeds.insider_records(t))
    return selection.trades_of_yesterday(keyed, TRADES_AS_OF)


@query
def bronze_union_all(t):
    """Per-status order frames appended; one of them lacks the priority."""
    orders = t["orders"].select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    frames = [orders.filter(F.col("o_orderstatus") == status) for status in ("F", "O")]
    frames.append(orders.filter(F.col("o_orderstatus") == "P").drop("o_orderpriority"))
    return ingest.append_frames(frames, orders.schema, t.spark)


@query
def payload_reject_split(t):
    """What became of each landed payload; corrupt and empty ones stop nothing."""
    judged = landing.judge_payloads(
        feeds.news_payloads(t), "payload", schemas.NEWS_PAYLOAD, "articles"
    )
    return judged.select("event_id", "company", "outcome")


@query
def stock_hash(t):
    """Keys of the daily bars."""
    return feeds.bars(t).select(
        "ticket", "date", keys.stock_key(F.col("ticket"), F.col("date")).alias("hash")
    )


@query
def news_hash(t):
    """Keys of the articles over the delivered time text; a missing text enters as None."""
    a = feeds.articles(t)
    return a.select(
        "event_id",
        keys.news_key(F.col("company"), F.col("title"), F.col("publishedAt")).alias("hash"),
        keys.news_key(F.col("company"), F.col("description"), F.col("publishedAt")).alias(
            "description_hash"
        ),
    )


@query
def insider_hash(t):
    """Keys of the insider records."""
    return landing.key_insider(feeds.insider_records(t)).select(
        "hash", "symbol", "name", "transaction_date", "change", "share"
    )


@query
def bronze_upsert_stocks(t):
    """Finished quotes are stored, then the open ones arrive; the first per day stays."""
    keyed = landing.key_bars(feeds.quotes(t), keep=("l_linestatus", *feeds.LINE_ORDER))
    return _two_batches(keyed, F.col("l_linestatus") == "F", feeds.LINE_ORDER)


@query
def bronze_upsert_news(t):
    """Articles keyed on their day: purchases and views are stored, the rest arrives later."""
    day = F.to_date(F.col("ts") - F.expr(feeds.EVENT_SHIFT)).cast("string")
    keyed = landing.key_news(feeds.articles(t, published=day), keep=("event_id", "event_type"))
    return _two_batches(keyed, F.col("event_type").isin("purchase", "view"), ("event_id",))


@query
def bronze_upsert_insider(t):
    """Trades of market segments: finished lines are stored, then the open ones arrive."""
    records = feeds.insider_records(t, name="c_mktsegment")
    keyed = landing.key_insider(records, keep=feeds.INSIDER_ARRIVAL)
    return ingest.INSIDER_CONSTRAINTS.store_types(
        _two_batches(keyed, F.col("l_linestatus") == "F", feeds.INSIDER_ARRIVAL)
    )


def _two_batches(keyed: DataFrame, earlier, arrival) -> DataFrame:
    helpers = set(arrival) | {"l_linestatus", "event_type"}
    stored = ingest.first_write_wins(keyed.filter(earlier), list(arrival))
    table = ingest.upsert(stored, keyed.filter(~earlier), list(arrival))
    return table.drop(*[c for c in helpers if c in table.columns])


@query
def bronze_constraints_news(t):
    """Articles that the table refuses: untitled ones and labels that are too long."""
    verbose = F.concat("event_type", F.lit(" news"))
    rows = landing.key_news(
        feeds.articles(t)
        .withColumn("title", F.col("description"))
        .withColumn("sentiment", verbose),
        keep=("event_id",),
    )
    return ingest.violations(rows, ingest.NEWS_CONSTRAINTS).select("event_id", "broken_rule")


@query
def bronze_constraints_insider(t):
    """Trades with the priority as code: long codes are refused, and prices of six decimals, at
    a tie or just below it, rounded once."""
    records = feeds.insider_records(t, code="o_orderpriority")
    millionths = F.round(F.col("transactionPrice") * 100).cast("bigint") * 10_000 + 5_000
    near_tie = (millionths - F.col("l_linenumber") % 2) / 1_000_000
    rows = landing.key_insider(records.withColumn("transactionPrice", near_tie))
    broken = ingest.violations(rows, ingest.INSIDER_CONSTRAINTS)
    return ingest.INSIDER_CONSTRAINTS.store_types(broken).select(
        "hash", "transaction_code", "transaction_price", "broken_rule"
    )


@query
def strict_batch_refusal(t):
    """Articles of each company and day as a batch of a strict run: one long label refuses all."""
    day = F.to_date(F.col("ts") - F.expr(feeds.EVENT_SHIFT)).cast("string")
    labelled = feeds.articles(t).withColumn("sentiment", F.concat("event_type", F.lit(" news")))
    rows = landing.key_news(labelled, keep=("event_id", "event_type", "ts")).filter("title is not null")
    batches = rows.withColumn("batch", F.concat_ws("/", "company", day))
    stored = ingest.strict_batches(batches, "batch", ingest.NEWS_CONSTRAINTS)
    return stored.select("batch", "event_id")


def _landed_pages(t: Tables) -> DataFrame:
    """The news payloads as pages that landed in the order of their events."""
    landed = F.struct(
        F.lit(feeds.LANDED_AT).cast("timestamp").alias("at"),
        F.format_string("%012d", "event_id").alias("file"),
        F.lit(0).cast("bigint").alias("block"),
    )
    return feeds.news_payloads(t).select("company", "payload", landed.alias(landing.LANDED))


def _wordy(articles: DataFrame) -> DataFrame:
    """Labels by the number in the text; every third is longer than the table takes."""
    weight = F.get_json_object("description", "$.k").cast("int") % 3
    label = F.when(weight == 0, "good").when(weight == 1, "bad").when(weight == 2, "extremely positive")
    return articles.withColumn("sentiment", normalise_label(label))


@query
def news_run_labels(t):
    """A whole news run whose model answers at too great length now and then: what the table took, and
    what it refused for its label."""
    layers = Layers(t.spark, f"{shared_dir(t.spark)}/run-{uuid.uuid4().hex}")
    ingestion.ingest_news(layers, _landed_pages(t), "all", label=_wordy, strict=False)
    stored = layers.read("bronze", "news").select("hash", "company", "sentiment", F.lit("stored").alias("outcome"))
    refused = layers.read("bronze", "news_rejected")
    return stored.unionByName(
        refused.select("hash", "company", "sentiment", F.array_join(ingest.BROKEN, ", ").alias("outcome"))
    )


@query
def load_stamps(t):
    """The load stamps of bronze and silver: one a load, none missing, and a repeated load of the same
    batch changes none."""
    layers = Layers(t.spark, f"{shared_dir(t.spark)}/run-{uuid.uuid4().hex}")
    keyed = landing.key_bars(feeds.bars(t))

    def stamps() -> DataFrame:
        layers.append_new(pipeline.STOCKS, keyed, ["date"])
        return layers.read("bronze", "stocks").select("hash", "created_at")

    _, before = layers.stage("stamps", stamps())
    kept = stamps().join(t.spark.read.parquet(before).withColumnRenamed("created_at", "earlier"), "hash", "left")
    silver_rows = silver.stamped(silver.stocks(layers.read("bronze", "stocks")))
    loaded = layers.rebuild("silver", "stocks", silver_rows)

    def told(layer: str, rows: DataFrame, stamp: str, same) -> DataFrame:
        return rows.agg(
            F.count("*").alias("row_count"), F.count(stamp).alias("stamped"), F.count_distinct(stamp).alias("stamps"),
            F.coalesce(F.count_if(same), F.lit(0)).alias("unchanged"),
        ).withColumn("layer", F.lit(layer))

    return told("bronze", kept, "created_at", F.col("created_at") == F.col("earlier")).unionByName(
        told("silver", loaded, "updated_at", F.lit(True))
    )


@query
def insider_date_parse(t):
    """Dates from text; rejected trades (no change) come without a filing date."""
    records = feeds.insider_records(t)
    filing = F.when(F.col("change") != 0, F.col("filingDate"))
    return records.select(
        "l_orderkey",
        "l_linenumber",
        landing.parse_date(filing).alias("filing_date"),
        landing.parse_date(F.col("transactionDate")).alias("transaction_date"),
    )


@query
def sentiment_label(t):
    """A label for each whole document."""
    documents = t["documents"].select("doc_id", "text")
    return label_with_lexicon(documents, LEXICON, text="text").select("doc_id", "sentiment")


def _by_length() -> labelling.Classifier:
    return lambda texts: texts.str.len().mod(3).map({0: " Good", 1: "BAD\n", 2: "neutral"})


@query
def sentiment_classifier(t):
    """A Python model's label for each whole document; this one answers by the text's length."""
    lead_workers_here(t.spark)
    documents = t["documents"].select("doc_id", "text")
    return labelling.label_with_classifier(documents, _by_length, text="text").select("doc_id", "sentiment")


@query
def sentiment_normalise(t):
    """Raw answers stripped and lower-cased; off-list ones kept, missing ones neutral."""
    kind = F.col("event_type")
    raw = (
        F.when(kind == "purchase", " Good\n")
        .when(kind == "error", "BAD ")
        .when(kind == "signup", "\tMixed")
        .when(kind == "view", "neutral")
    )
    return t["events"].select("event_id", normalise_label(raw).alias("sentiment"))


@query
def csv_sink_roundtrip(t):
    """Bars written as CSV with a header and read back with their schema."""
    rows = _exact_bars(feeds.bars(t))
    path = f"{shared_dir(t.spark)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(rows, path)
    return sinks.read_csv(t.spark, path, rows.schema)


@query
def news_counts_by_company(t):
    """Run summary by company."""
    return ingest.counts_by(feeds.load_news(feeds.articles(t)), "company")


@query
def news_counts_by_sentiment(t):
    """Run summary by label."""
    return ingest.counts_by(feeds.load_news(feeds.articles(t)), "sentiment")


# --- Silver -----------------------------------------------------------------------------


def _silver(t: Tables) -> silver.Silver:
    return silver.build(feeds.bronze(t))


@query
def silver_stocks(t):
    """Typed bars."""
    return _silver(t).stocks


@query
def silver_insider(t):
    """Typed insider trades."""
    return _silver(t).insider


@query
def silver_news(t):
    """Typed articles with a description and the ticker of their company."""
    return _silver(t).news


@query
def silver_ticker_map(t):
    """Typed ticker map."""
    return silver.ticker_map(feeds.ticker_map(t))


@query
def build_layers(t):
    """Silver and gold written out in full, then counted from their files."""
    layers = Layers(t.spark, f"{shared_dir(t.spark)}/layers-{uuid.uuid4().hex}")
    pipeline.build_layers(layers, feeds.bronze(t))
    return pipeline.row_counts(layers)


# --- Gold -------------------------------------------------------------------------------

NEWS_KEY = ("ticket", "news_date")
INSIDER_KEY = ("symbol", "transaction_date")


def _price(t: Tables, *wanted: str) -> DataFrame:
    return gold_price.price_indicators(_silver(t).stocks, wanted or gold_price.EVERY)


def _news(t: Tables) -> DataFrame:
    return gold_news.news_signals(_silver(t).news)


def _insider(t: Tables) -> DataFrame:
    return gold_insider.insider_signals(_silver(t).insider)


@query
def gold_price_all(t):
    """All price indicators."""
    return _price(t)


@query
def gold_price_change(t):
    """Close against the row before."""
    return _price(t, "close_price", "close_price_yesterday", "price_change_1d", "price_change_pct_1d")


@query
def gold_volume_change(t):
    """Volume against the row before."""
    return _price(t, "trade_volume", "volume_1d", "volume_change_1d")


@query
def gold_moving_avg(t):
    """Five-row averages."""
    return _price(t, "ma5_close_price", "ma5_volume")


@query
def gold_rolling_extrema(t):
    """Five-row extremes."""
    return _price(t, "max_5d_close_price", "min_5d_close_price", "min_5d_low_price", "max_5d_volume")


@query
def gold_range_position(t):
    """Width of the five-row range and the close's place in it."""
    return _price(t, "price_range_5d", "price_percentile_5d")


@query
def gold_volatility(t):
    """Five-row sample deviation."""
    return _price(t, "stddev_5d_close_price")


@query
def gold_ma_distance(t):
    """Distance from the five-row average."""
    return _price(t, "distance_from_ma5", "distance_pct_from_ma5")


@query
def gold_direction(t):
    """Up, down or unchanged."""
    return _price(t, "price_direction_1d")


@query
def gold_news_daily(t):
    """Articles per ticker and day, by label."""
    return _news(t).select(
        *NEWS_KEY, "daily_news_count", *[f"daily_{n}_news_count" for n in gold_news.LABELS]
    )


@query
def gold_news_pct(t):
    """Shares of the labels."""
    return _news(t).select(*NEWS_KEY, *[f"daily_{n}_news_pct" for n in gold_news.LABELS])


@query
def gold_news_rolling(t):
    """Totals over the last five news days."""
    return _news(t).select(
        *NEWS_KEY, "rolling_5d_news_count", *[f"rolling_5d_{n}_news_count" for n in gold_news.LABELS]
    )


@query
def gold_news_score(t):
    """Sentiment score of the day and of the last five news days."""
    return _news(t).select(*NEWS_KEY, "daily_sentiment_score", "rolling_5d_sentiment_score")


@query
def gold_insider_daily(t):
    """Totals per symbol and activity day."""
    return _insider(t).select(
        *INSIDER_KEY, "distinct_insiders_active", "total_shares_bought", "total_shares_sold",
        "net_shares_flow", "net_value_flow", "total_transactions_count",
    )


@query
def insider_value_split(t):
    """Bought and sold values, which the gold table leaves out."""
    return gold_insider.daily_insider(_silver(t).insider).select(
        *INSIDER_KEY, "total_value_bought", "total_value_sold"
    )


@query
def gold_insider_gaps(t):
    """Against the activity day before."""
    return _insider(t).select(
        *INSIDER_KEY, "previous_activity_date", "days_since_last_activity",
        "previous_day_net_shares_flow", "change_in_net_shares_flow",
    )


@query
def gold_insider_rolling(t):
    """Totals over the last five activity days."""
    rows = _insider(t)
    average = F.round("rolling_5_day_avg_net_shares", 6).alias("rolling_5_day_avg_net_shares")
    return rows.select(
        *INSIDER_KEY, "rolling_5_day_net_shares_flow", "rolling_5_day_net_value_flow", average,
        "rolling_5_day_active_insiders", "rolling_5_day_transaction_count",
    )


@query
def gold_insider_cumulative(t):
    """Running totals."""
    return _insider(t).select(
        *INSIDER_KEY, "cumulative_net_shares_flow", "cumulative_net_value_flow",
        "cumulative_transaction_count",
    )


@query
def gold_insider_signal(t):
    """Direction of the last five activity days, and activity clusters."""
    return _insider(t).select(*INSIDER_KEY, "rolling_5_day_sentiment", "is_activity_cluster")


#: Days whose bars land late, and days whose first bars are wrong by a tenth of a cent.
LATE_BARS = ("1998-03-10", "1998-03-20")
WRONG_BARS = ("1999-07-30", "1999-08-02")


@query
def gold_price_incremental(t):
    """All price indicators, built without some late bars and with some wrong ones, then brought up to
    date by writing the months that the late and corrected bars reach."""
    layers = Layers(t.spark, f"{shared_dir(t.spark)}/layers-{uuid.uuid4().hex}")
    stocks, _ = layers.stage("stocks", _silver(t).stocks)
    late, wrong = (F.col("trading_date").between(*(F.lit(d).cast("date") for d in days)) for days in (LATE_BARS, WRONG_BARS))
    off = (F.col("close_price") + F.lit("0.001").cast("decimal(4,3)")).cast("decimal(18,4)")
    first = stocks.filter(~late).withColumn("close_price", F.when(wrong, off).otherwise(F.col("close_price")))
    incremental.build_prices(layers, first)
    incremental.refresh_prices(layers, stocks, stocks.filter(late | wrong).select("ticket", "trading_date"))
    return incremental.read_prices(layers)


# --- Quality ----------------------------------------------------------------------------


@query
def gold_news_reconciled(t):
    """Daily sentiment against a build that lacks every 499th article: the rows in which they differ."""
    news = _silver(t).news
    fewer = silver.build(dataclasses.replace(feeds.bronze(t), news=feeds.load_news(feeds.articles(t).filter("event_id % 499 <> 0"))))
    return reconcile.differences(gold_news.daily_news(news), gold_news.daily_news(fewer.news), ("whole", "partial"))


def _gold(t: Tables) -> gold_plan.Gold:
    return gold_plan.build(_silver(t))


@query
def dq_unique(t):
    """Gold keys that occur more than once."""
    return quality.check_unique(_gold(t))


@query
def dq_unique_quotes(t):
    """The same check over the raw quotes, of which many share a ticker and day."""
    quotes = feeds.quotes(t).withColumn("trading_date", F.to_date("date"))
    return quality.duplicate_keys(quotes, quality.PRICE_CHECKS)


@query
def dq_not_null_key(t):
    """Gold rows whose key is incomplete."""
    return quality.check_null_keys(_gold(t))


@query
def dq_not_null_columns(t):
    """NULLs per required gold column."""
    return quality.check_null_columns(_gold(t))


@query
def dq_accepted_values(t):
    """Values outside their list per restricted gold column."""
    return quality.check_accepted_values(_gold(t))


# --- Analysis ---------------------------------------------------------------------------


def _master(t: Tables, *price_columns: str) -> DataFrame:
    return analysis.master_merge(gold_plan.build(_silver(t), price_columns or gold_price.EVERY))


def _target(t: Tables, *price_columns: str) -> DataFrame:
    return analysis.master_merge(gold_plan.build(analysis.for_target(_silver(t)), price_columns))


@query
def master_merge(t):
    """Prices with the news and trades of their day."""
    merged = _master(t)
    average = F.round("rolling_5_day_avg_net_shares", 6)
    return merged.withColumn("rolling_5_day_avg_net_shares", average)


@query
def target_ticker(t):
    """The ticker of the single-ticker datasets."""
    return analysis.target_ticker(_silver(t).stocks)


@query
def series_price_sentiment(t):
    """Target ticker: close and sentiment score."""
    return analysis.price_and_sentiment(_target(t, "close_price"))


@query
def series_price_insider(t):
    """Target ticker: close and insider flow with its side."""
    return analysis.price_and_insider(_target(t, "close_price"))


@query
def correlation_matrix(t):
    """Target ticker: Pearson matrix of five factors."""
    return analysis.correlation_matrix(_target(t, "close_price", "volume_1d", "price_change_pct_1d"))


@query
def insider_totals(t):
    """Shares bought and sold per ticker."""
    return analysis.insider_totals(_insider(t))


@query
def box_stats(t):
    """Box of the daily change per sentiment intensity."""
    rounded = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return analysis.box_stats(_master(t, "price_change_pct_1d")).withColumns({c: F.round(c, 6) for c in rounded})


@query
def box_outliers(t):
    """Days outside the box's fences."""
    return analysis.box_outliers(_master(t, "price_change_pct_1d"))


@query
def scatter_news_volume(t):
    """News count against volume change."""
    return analysis.news_volume_points(_master(t, "volume_change_1d"))


@query
def hype_correlation(t):
    """Correlation of news count and volume, overall and per ticker."""
    return analysis.hype_correlation(_master(t, "trade_volume"))


@query
def sell_buy_ratio(t):
    """Shares sold per share bought."""
    return analysis.sell_buy_ratio(_insider(t))


@query
def contrarian_buys(t):
    """Purchases against the day's net selling."""
    return analysis.contrarian_buys(_insider(t))


@query
def dispersion_by_intensity(t):
    """Spread of the daily change per sentiment intensity."""
    return analysis.dispersion_by_intensity(_master(t, "price_change_pct_1d"))


# --- Matches in time ----------------------------------------------------------------------

EVENT_DAYS = 3
RECENT_DAYS = 5


def _sessions(t: Tables) -> DataFrame:
    return _silver(t).stocks.select(F.col("ticket").alias("traded"), "trading_date", "close_price")


def _news_sessions(t: Tables) -> DataFrame:
    dated = _silver(t).news.select("hash_news", "ticket", F.to_date("published_at").alias("news_date"))
    return asof.as_of(
        dated, _sessions(t), key="ticket", time="news_date", right_key="traded", right_time="trading_date",
        carry=["close_price"], direction=asof.FORWARD,
    )


@query
def news_next_session(t):
    """Every article with the first trading day at or after its own, and that day's close."""
    return _news_sessions(t)


@query
def news_per_session(t):
    """Articles per ticker and trading day, those of days without trade moved to the next session."""
    return (
        _news_sessions(t).filter("trading_date is not null")
        .groupBy("ticket", "trading_date").agg(F.count("*").alias("news_count"))
    )


@query
def insider_last_close(t):
    """Every trade with the last close at or before its day."""
    trades = _silver(t).insider.select("insider_transactions_hash", "symbol", "transaction_date", "change")
    return asof.as_of(
        trades, _sessions(t), key="symbol", time="transaction_date", right_key="traded", right_time="trading_date",
        carry=["close_price"],
    )


@query
def price_calendar_frames(t):
    """Sessions, volume and mean close of the last five calendar days."""
    columns = {
        "sessions": "count(*) OVER recent",
        "volume": "sum(trade_volume) OVER recent",
        "low": "min(low_price) OVER recent",
        "_total": "sum(close_price) OVER recent",
    }
    framed = calendar.recent_days(
        _silver(t).stocks, key="ticket", date="trading_date", days=RECENT_DAYS, columns=columns,
        carry=["close_price", "low_price", "trade_volume"],
    )
    mean = F.round(F.col("_total").cast("decimal(24,4)") / F.col("sessions"), 2)
    return framed.select("ticket", "trading_date", "sessions", "volume", "low", mean.alias("mean_close"))


@query
def quote_calendar_frames(t):
    """Every raw quote with the number and volume of its ticker's quotes of the last five days."""
    quotes = feeds.quotes(t).select(
        "ticket", F.to_date("date").alias("day"), "volume", "l_orderkey", "l_linenumber"
    )
    columns = {"recent_quotes": "count(*) OVER recent", "recent_volume": "sum(volume) OVER recent"}
    return calendar.recent_days(
        quotes, key="ticket", date="day", days=RECENT_DAYS, columns=columns, carry=["volume", "l_orderkey", "l_linenumber"]
    )


def _clusters(t: Tables) -> DataFrame:
    return calendar.activity_sessions(
        gold_insider.daily_insider(_silver(t).insider), key="symbol", date="transaction_date",
        gap_days=gold_insider.CLUSTER_DAYS,
        totals={
            "active_days": F.count("*"),
            "transactions": F.sum("total_transactions_count"),
            "net_shares_flow": F.sum("net_shares_flow"),
        },
    )


@query
def insider_sessions(t):
    """Runs of insider activity with gaps of three days at most: start, end and size."""
    return _clusters(t)


@query
def event_study(t):
    """Daily changes from three days before to three days after the start of each run of activity."""
    prices = _price(t, "close_price", "price_change_pct_1d").drop("close_price")
    around = _clusters(t).select(
        "symbol", "session_start", "active_days",
        F.date_sub("session_start", EVENT_DAYS).alias("low"), F.date_add("session_start", EVENT_DAYS).alias("high"),
    )
    met = intervals.interval_join(prices, around, key="ticket", interval_key="symbol", date="trading_date")
    return met.select(
        "ticket", "session_start", "active_days", "trading_date",
        F.datediff("trading_date", "session_start").alias("day"), "price_change_pct_1d",
    )


@query
def insider_distinct_rolling(t):
    """Different insiders of the last five activity days: exact, and whether the merged daily sketches
    come within their bound."""
    names = {"key": "symbol", "date": "transaction_date"}
    # Both ways read the same shuffled rows, so that the trades are loaded once. The join at the end takes no
    # trade without ticker or day; left out here, they are out of both ways alike.
    dated = _silver(t).insider.filter("symbol IS NOT NULL AND transaction_date IS NOT NULL")
    said = dated.select(*names.values(), "name").distinct()
    exact = sketches.exact_over_frames(said, **names, value="name")
    merged = sketches.merged_over_frames(sketches.daily_sketches(said, **names, value="name"), **names)
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    close = off <= F.greatest(F.ceil(F.col("distinct_values") * sketches.BOUND), F.lit(1))
    return exact.join(merged, list(INSIDER_KEY)).select(*INSIDER_KEY, "distinct_values", close.alias("estimate_within_bound"))


# --- Streams ------------------------------------------------------------------------------

#: Days that land together in the stream queries, and how late an article or its copy lands.
SLICE_DAYS, LATE_DAYS, COPY_DAYS = 12, 4, 2


def _fed(t: Tables, rows: DataFrame, land, run, out: str) -> None:
    """Land the rows slice by slice, in order, and run the stream after each."""
    staged = f"{out}/staged"
    rows.write.partitionBy("slice").parquet(staged)
    read = t.spark.read.parquet(staged)
    # At most one value for every SLICE_DAYS days of the calendar.
    for (number,) in sorted(read.select("slice").distinct().collect()):
        land(read.filter(F.col("slice") == number).drop("slice"))
        run().awaitTermination()


@query
def stream_news_daily(t):
    """Daily sentiment of articles that land up to three days late, some of them twice, in slices of
    twelve days: a stream with a watermark, run after each landing."""
    out = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    session = batches.stream_session(t.spark)
    day = F.unix_date(F.to_date(F.col("ts") - F.expr(feeds.EVENT_SHIFT)))
    landed = day + (F.col("event_id") % LATE_DAYS).cast("int")
    times = F.when(F.col("event_id") % 5 == 0, F.array(landed, landed + COPY_DAYS)).otherwise(F.array(landed))
    fields = ["url", "company", "publishedAt", "title", "description", "sentiment"]
    rows = feeds.articles(t).select(*fields, F.explode(times).alias("landed"))
    rows = rows.select(*fields, F.floor(F.col("landed") / SLICE_DAYS).alias("slice"))
    names = feeds.ticker_map(Tables(session, t.folder))
    schema = rows.drop("slice").schema

    def run():
        articles = session.readStream.schema(schema).json(f"{out}/landed")
        return daily.follow_articles(articles, names, f"{out}/days", f"{out}/progress")

    _fed(t, rows, lambda batch: batch.write.mode("append").json(f"{out}/landed"), run, out)
    return daily.latest_days(t.spark, f"{out}/days")


@query
def stream_news_rolling(t):
    """Five-day totals of a stream of closed days that comes in slices; each ticker's last five days
    are all it remembers between them."""
    lead_workers_here(t.spark)
    out = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    session = batches.stream_session(t.spark)
    days = gold_news.daily_news(_silver(t).news)
    rows = days.withColumn("slice", F.floor(F.unix_date("news_date") / SLICE_DAYS))

    def run():
        closed = session.readStream.schema(days.schema).parquet(f"{out}/closed")
        return batches.store_batches(rolling.rolling_signals(closed), f"{out}/signals", f"{out}/progress")

    _fed(t, rows, lambda batch: batch.write.mode("append").parquet(f"{out}/closed"), run, out)
    return t.spark.read.parquet(f"{out}/signals").drop("batch")


#: Events on a result page of the page queries, and every how many-th page can't be read.
PAGE_EVENTS, BAD_PAGE = 500, 7


@query
def landed_pages_read(t):
    """Result pages of each company, read by the Python data source as a batch and as a stream: pages,
    those that can't be read, and articles are the same both ways."""
    lead_workers_here(t.spark)
    out = f"{shared_dir(t.spark)}/pages-{uuid.uuid4().hex}"
    number = F.expr(f"event_id div {PAGE_EVENTS}")
    article = F.struct("url", "title", "description", "publishedAt")
    # A page holds the articles of at most PAGE_EVENTS events.
    listed = feeds.articles(t).groupBy("company", number.alias("number")).agg(F.collect_list(article).alias("articles"))
    page = F.to_json(F.struct(F.lit("ok").alias("status"), "articles")).cast("binary")
    cut = F.when(F.col("number") % BAD_PAGE == BAD_PAGE - 1, F.unhex(F.lit("FF"))).otherwise(page)

    def source(way):
        return way.format("landed_pages").option("path", f"{out}/landed").option("key", "company")

    pages.register(t.spark)
    named = listed.select(F.col("company").alias("entity"), F.format_string("%s.json", "number").alias("page"), cut.alias("payload"))
    source(named.write).mode("append").save()
    batches.store_batches(source(t.spark.readStream).load(), f"{out}/taken", f"{out}/progress").awaitTermination()
    streamed = t.spark.read.parquet(f"{out}/taken").drop("batch")
    ways = source(t.spark.read).load().withColumn("way", F.lit("batch")).unionByName(streamed.withColumn("way", F.lit("stream")))
    judged = landing.judge_payloads(ways, "payload", schemas.NEWS_PAYLOAD, "articles")
    return judged.groupBy("way", F.col("entity").alias("company")).agg(
        F.count("*").alias("pages"), F.count("failure").alias("failed"),
        F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("articles"),
    )
