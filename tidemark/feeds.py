"""The bronze feeds, derived by Spark from the star-schema tables of a data folder.

Brands play tickers, line items play trades and quotes, events play articles. Every feed
reads its whole tables; only the columns it needs leave the scan. Joins carry no hints: Spark
broadcasts a side when its measured size allows and splits the skewed partitions of the rest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ingest import INSIDER_CONSTRAINTS, first_write_wins
from tidemark.plans.silver import Bronze
from tidemark.schemas import ARTICLE, INSIDER_RECORD
from tidemark.sources.landing import key_bars, key_insider, key_news

# Fixed values of the mapping.
BRAND_PREFIX, TICKER_PREFIX = "Brand#", "tk"
COMPANIES = 27
EVENT_SHIFT = "INTERVAL '9496' DAY"
TEXTLESS_BELOW = 10
LANDED_AT = "2024-02-01 00:00:00"
LABEL_OF_EVENT = {
    "purchase": "good", "signup": "good", "error": "bad", "click": "neutral", "view": "neutral",
}

# Which of two line items arrived first; whatever it leaves tied has equal price and size.
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")


@dataclass(frozen=True)
class Tables:
    """The Parquet tables of one data folder, by name; each file's schema is read once."""

    spark: SparkSession
    folder: str
    _opened: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]


def _ticker() -> Column:
    renamed = F.replace(F.col("p_brand"), F.lit(BRAND_PREFIX), F.lit(TICKER_PREFIX))
    return F.upper(renamed)


def _unit_price() -> Column:
    """Price of one share in whole ten-thousandths: integers divide alike everywhere."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    shares = F.col("l_quantity").cast("bigint")
    return F.call_function("div", cents * 100, F.nullif(shares, F.lit(0)))


def _money(ten_thousandths: Column) -> Column:
    return (
        ten_thousandths.cast("decimal(13,0)") * F.lit("0.0001").cast("decimal(4,4)")
    ).cast("decimal(18,4)")


def _lines(tables: Tables) -> DataFrame:
    """Line items with the ticker of their part."""
    parts = tables["part"].select("p_partkey", _ticker().alias("ticket"))
    lines = tables["lineitem"]
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


def bars(tables: Tables) -> DataFrame:
    """Daily bars: one row per ticker and ship date."""
    price = F.col("_price")
    order = F.struct(*LINE_ORDER)
    return (
        _lines(tables)
        .withColumn("_price", _unit_price())
        .groupBy("ticket", F.col("l_shipdate").cast("date").alias("_day"))
        .agg(
            F.max_by(price, order).alias("_close"),
            F.max(price).alias("_high"),
            F.min(price).alias("_low"),
            F.min_by(price, order).alias("_open"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .select(
            "ticket",
            F.col("_day").cast("timestamp_ntz").alias("date"),
            *[_money(F.col(f"_{f}")).alias(f) for f in ("close", "high", "low", "open")],
            "volume",
        )
    )


def quotes(tables: Tables) -> DataFrame:
    """Every line item as a one-trade bar: many bars share a ticker and date."""
    price = _money(_unit_price())
    return _lines(tables).select(
        "ticket",
        F.col("l_shipdate").cast("date").cast("timestamp_ntz").alias("date"),
        *[price.alias(f) for f in ("close", "high", "low", "open")],
        F.col("l_quantity").cast("bigint").alias("volume"),
        "l_linestatus",
        *LINE_ORDER,
    )


def wide_bars(tables: Tables) -> DataFrame:
    """The bars as one row per date with columns named ``field|ticker``, for every ticker that
    the part table lists."""
    fields = ("close", "high", "low", "open", "volume")
    listed = tables["part"].select(_ticker().alias("ticket")).filter("ticket is not null").distinct()
    tickers = sorted(r["ticket"] for r in listed.collect())
    wide = (
        bars(tables)
        .groupBy("date")
        .pivot("ticket", tickers)
        .agg(*[F.max(f).alias(f) for f in fields])
    )
    return wide.select(
        "date", *[F.col(f"{t}_{f}").alias(f"{f}|{t}") for t in tickers for f in fields]
    )


def signed_shares() -> Column:
    """Returned lines are sales, new ones purchases, the rest changes nothing."""
    size = F.round("l_quantity").cast("bigint")
    return (
        F.when(F.col("l_returnflag") == "R", -size)
        .when(F.col("l_returnflag") == "N", size)
        .otherwise(F.lit(0).cast("bigint"))
    )


def insider_records(
    tables: Tables,
    name: str = "c_name",
    code: str = "l_linestatus",
) -> DataFrame:
    """Line items as flattened insider records, with their arrival order. A trade is dated by
    its order, so that some bars have no trade of their day."""
    orders = tables["orders"]
    buyers = tables["customer"]
    filed = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    lines = _lines(tables)
    day = F.col("o_orderdate").cast("date")
    return lines.join(filed, lines.l_orderkey == filed.o_orderkey).select(
        F.col("ticket").alias("symbol"),
        F.col(name).alias("name"),
        F.round("l_quantity").cast("bigint").alias("share"),
        signed_shares().alias("change"),
        F.date_add(day, 2).cast("string").alias("filingDate"),
        day.cast("string").alias("transactionDate"),
        F.col("l_extendedprice").alias("transactionPrice"),
        F.col(code).alias("transactionCode"),
        "l_linestatus",
        *LINE_ORDER,
    )


INSIDER_ARRIVAL = (*LINE_ORDER, "l_linestatus")


def articles(tables: Tables, published: Column | None = None) -> DataFrame:
    """Events as flattened, labelled articles, with their arrival order."""
    shifted = F.col("ts") - F.expr(EVENT_SHIFT)
    text = F.concat(F.replace(shifted.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    label = F.create_map(*[F.lit(v) for pair in LABEL_OF_EVENT.items() for v in pair])
    weight = F.get_json_object("props", "$.k").cast("int")
    return tables["events"].select(
        F.concat(F.lit("https://news.example.com/"), F.col("event_id")).alias("url"),
        F.concat(F.lit("brand#"), F.col("user_id") % COMPANIES).alias("company"),
        (text if published is None else published).alias("publishedAt"),
        F.col("props").alias("title"),
        F.when(weight < TEXTLESS_BELOW, F.lit(None)).otherwise(F.col("props")).alias("description"),
        F.try_element_at(label, F.col("event_type")).alias("sentiment"),
        "event_id",
        "event_type",
        "ts",
    )


def ticker_map(tables: Tables) -> DataFrame:
    """Brand names and their lower-case tickers."""
    return (
        tables["part"]
        .select(F.lower(_ticker()).alias("ticket"), F.col("p_brand").alias("company"))
        .distinct()
    )


def bronze(tables: Tables) -> Bronze:
    """The four bronze tables after idempotent loading. Bars are unique by their making."""
    return Bronze(
        stocks=key_bars(bars(tables)),
        news=load_news(articles(tables)),
        insider=load_insider(insider_records(tables)),
        ticker_map=ticker_map(tables),
    )


def load_news(landed: DataFrame) -> DataFrame:
    keyed = key_news(landed, keep=("event_id",))
    return first_write_wins(keyed, ["event_id"]).drop("event_id")


def load_insider(landed: DataFrame) -> DataFrame:
    keyed = key_insider(landed, keep=INSIDER_ARRIVAL)
    first = first_write_wins(keyed, INSIDER_ARRIVAL).drop(*INSIDER_ARRIVAL)
    return INSIDER_CONSTRAINTS.store_types(first)


def page_articles(tables: Tables) -> DataFrame:
    """Each event as an article on the page of its user: address, language and whole text."""
    events, pages = tables["events"], tables["pages"]
    language = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})/", 1)
    return events.join(pages, events.user_id == pages.page_id).select(
        "event_id",
        "url",
        language.alias("language"),
        F.col("html").alias("description"),
        F.col("ts").alias("published_at"),
    )


def news_payloads(tables: Tables) -> DataFrame:
    """One landed document per event: two articles, one, none, a refused request or cut JSON."""
    article = F.struct("url", "title", "description", "publishedAt")
    follow_up = F.struct(
        "url",
        F.concat(F.lit("Follow-up: "), F.col("title")).alias("title"),
        "description",
        "publishedAt",
    )
    kind = F.col("event_type")
    listed = (
        F.when(kind == "click", F.array().cast(f"array<{ARTICLE.simpleString()}>"))
        .when(kind == "purchase", F.array(article, follow_up))
        .otherwise(F.array(article))
    )
    status = F.when(kind == "signup", "error").otherwise("ok")
    document = F.to_json(F.struct(status.alias("status"), listed.alias("articles")))
    cut = F.expr("left(_document, length(_document) - 2)")
    return (
        articles(tables)
        .withColumn("_document", document)
        .select(
            "event_id", "company", F.when(kind == "error", cut).otherwise(F.col("_document")).alias("payload")
        )
    )


def insider_payloads(tables: Tables) -> DataFrame:
    """One landed document per line item: a sale with its reversal, a purchase, or no data."""
    day = F.col("l_shipdate").cast("date")
    size = F.round("l_quantity").cast("bigint")

    def record(change: Column) -> Column:
        return F.struct(
            F.lower("ticket").alias("symbol"),
            F.concat(F.lit("Supplier "), F.col("l_suppkey")).alias("name"),
            size.alias("share"),
            change.alias("change"),
            F.date_add(day, 2).cast("string").alias("filingDate"),
            day.cast("string").alias("transactionDate"),
            F.col("l_extendedprice").alias("transactionPrice"),
            F.col("l_linestatus").alias("transactionCode"),
        )

    flag = F.col("l_returnflag")
    data = (
        F.when(flag == "R", F.array(record(-size), record(size)))
        .when(flag == "N", F.array(record(size)))
        .otherwise(F.array().cast(f"array<{INSIDER_RECORD.simpleString()}>"))
    )
    return _lines(tables).select(
        F.col("ticket").alias("symbol"), F.to_json(F.struct(data.alias("data"))).alias("payload")
    )
