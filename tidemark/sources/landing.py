"""Readers of landed files and the flattening of API payloads."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import keys
from tidemark.operators.ingest import append_frames

# The fields of a daily bar, and the status of a usable news payload.
BAR_FIELDS = ("close", "high", "low", "open", "volume")
STATUS_OK = "ok"

CORRUPT = "_corrupt_record"

# Columns that order landed rows: when and where the file landed, then the place in it.
LANDED, POSITION = "landed", "position"
LANDED_TYPE = "struct<at:timestamp,file:string,block:bigint>"


def _landed() -> Column:
    file = F.col("_metadata")
    return F.struct(
        file["file_modification_time"].alias("at"),
        file["file_path"].alias("file"),
        file["file_block_start"].alias("block"),
    )


def read_bars(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", numbered: bool = False
) -> DataFrame:
    """Landed daily bars. One frame per path; a field that a file set lacks becomes NULL.

    ``position`` is the row's place in its file, which decides between two bars of a day: Parquet
    knows it; CSV and JSON carry it as a column of that name if ``numbered``. Where it is
    unknown it is NULL, and among rows of one file block the values decide.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    if fmt in ("csv", "json"):
        number = [T.StructField(POSITION, T.LongType())] if numbered else []
        reader = reader.schema(T.StructType([*schemas.LANDED_BARS, *number]))
    if fmt == "parquet":
        place = F.col("_metadata.row_index")
    else:
        place = F.col(POSITION) if numbered else F.lit(None).cast("bigint")
    frames = [reader.load(p).withColumns({LANDED: _landed(), POSITION: place}) for p in paths]
    if not frames:
        nothing = spark.createDataFrame([], schemas.LANDED_BARS)
        none = {LANDED: F.lit(None).cast(LANDED_TYPE), POSITION: F.lit(None).cast("bigint")}
        return nothing.withColumns(none)
    return bars_scan(append_frames(frames, schemas.LANDED_BARS, spark), keep=(LANDED, POSITION))


def bars_scan(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Ticker and date first, then the bar's fields with their landed types."""
    return df.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.LANDED_BARS
        ],
        *keep,
    )


def wide_to_long(
    df: DataFrame, tickets: Iterable[str] | None = None, date: str = "date", fields: Sequence[str] = BAR_FIELDS
) -> DataFrame:
    """Turn columns named ``field|ticker`` into one row per ticker and date.

    Each wide row is expanded in place (no shuffle); a ticker without any value on a date
    gives no row. Without a list, all tickers that the columns name are taken.
    """
    tickets = wide_tickets(df) if tickets is None else tickets

    def bar(ticket: str) -> Column:
        values = [F.col(f"`{f}|{ticket}`").alias(f) for f in fields]
        return F.struct(F.lit(ticket).alias("ticket"), *values)

    bars = df.select(date, F.explode(F.array(*[bar(t) for t in tickets])).alias("_bar"))
    return bars.select("_bar.ticket", date, *[f"_bar.{f}" for f in fields]).dropna(
        how="all", subset=list(fields)
    )


def wide_tickets(df: DataFrame) -> list[str]:
    """The tickers that the columns of a wide frame name, in order."""
    return list(dict.fromkeys(c.split("|", 1)[1] for c in df.columns if "|" in c))


def _payload(text: Column, schema: T.StructType) -> Column:
    with_reject = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, with_reject, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def judge_payloads(df: DataFrame, text: str, schema: T.StructType, records: str) -> DataFrame:
    """The landed payloads with ``outcome`` and ``items``.

    ``outcome`` is ``corrupt``, ``not_ok``, ``empty`` or ``good``; ``items`` holds the records of
    a good payload and is NULL else. A bad payload stops nothing. Each text is parsed once.
    """
    doc, items = F.col("_doc"), F.col("_doc")[records]
    not_ok = (
        ~doc["status"].eqNullSafe(STATUS_OK) if "status" in schema.fieldNames() else F.lit(False)
    )
    outcome = (
        F.when(F.col(text).isNull() | doc[CORRUPT].isNotNull(), "corrupt")
        .when(not_ok, "not_ok")
        .when(F.coalesce(F.size(items), F.lit(0)) <= 0, "empty")
        .otherwise("good")
    )
    parsed = df.withColumn("_doc", _payload(F.col(text), schema))
    judged = parsed.select(*df.columns, outcome.alias("outcome"), items.alias("items"))
    return judged.withColumn("items", F.when(F.col("outcome") == "good", F.col("items")))


def split_payloads(
    df: DataFrame, text: str, schema: T.StructType, records: str
) -> tuple[DataFrame, DataFrame]:
    """(usable payloads, skipped payloads with the reason)."""
    judged = judge_payloads(df, text, schema, records).drop("items")
    return judged.filter("outcome = 'good'").drop("outcome"), judged.filter("outcome <> 'good'")


def flatten_news(
    df: DataFrame, payload: str = "payload", company: str = "company", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per article of the payloads with status ok, tagged with the asked-for company.

    ``keep`` names columns of the payload's row, and may name ``position``: the article's place.
    Payloads that were judged before are not parsed again.
    """
    if "items" in df.columns:
        return _news_rows(df, F.col("items"), company, keep)
    # The status test stays inside the explode: as a filter it would be pushed below the
    # projection that makes the payload, and the payload would be made and parsed twice.
    doc = F.from_json(F.col(payload), schemas.NEWS_PAYLOAD)
    usable = F.when(doc["status"] == STATUS_OK, doc["articles"])
    return _news_rows(df, usable, company, keep)


def _news_rows(df: DataFrame, items: Column, company: str, keep: Sequence[str]) -> DataFrame:
    return _exploded(df, items, F.col(company).alias("company"), keep).select(
        "_item.url", "company", "_item.publishedAt", "_item.title", "_item.description", *keep
    )


def flatten_insider(
    df: DataFrame, payload: str = "payload", symbol: str = "symbol", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per record of the payloads' ``data``; the asked-for symbol replaces the record's.
    Payloads that were judged before are not parsed again."""
    parsed = F.from_json(F.col(payload), schemas.INSIDER_PAYLOAD)["data"]
    records = F.col("items") if "items" in df.columns else parsed
    own = [f.name for f in schemas.INSIDER_RECORD if f.name != "symbol"]
    return _exploded(df, records, F.col(symbol).alias("symbol"), keep).select(
        "symbol", *[f"_item.{name}" for name in own], *keep
    )


def _exploded(df: DataFrame, items: Column, tag: Column, keep: Sequence[str]) -> DataFrame:
    carried = [c for c in keep if c != POSITION]
    if POSITION in keep:
        return df.select(tag, *carried, F.posexplode(items).alias(POSITION, "_item"))
    return df.select(tag, *carried, F.explode(items).alias("_item"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents as text, one per file, with the partition columns of the path
    (``company=...`` or ``symbol=...``) telling what was asked for. A document is one result
    page, so its size is bounded by the page size."""
    files = spark.read.option("wholetext", True).text(path)
    return files.withColumnRenamed("value", "payload").withColumn(LANDED, _landed())


def key_bars(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Landed bars as rows for bronze.stocks."""
    key = keys.stock_key(F.col("ticket"), F.col("date"))
    return df.select(key.alias("hash"), "ticket", "date", *BAR_FIELDS, *keep)


def key_news(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flattened articles (with or without a label) as rows for bronze.news. ``keep`` names
    columns to carry along, such as the arrival order."""
    label = F.col("sentiment") if "sentiment" in df.columns else F.lit(None).cast("string")
    return df.select(
        keys.news_key(F.col("company"), F.col("title"), F.col("publishedAt")).alias("hash"),
        "company",
        "title",
        "description",
        "url",
        F.col("publishedAt").cast("timestamp_ntz").alias("published_at"),
        label.alias("sentiment"),
        *keep,
    )


def parse_date(text: Column, dirty: bool = False) -> Column:
    """A date, NULL for NULL. Unreadable text raises unless ``dirty`` input is allowed."""
    return F.try_to_date(text) if dirty else F.to_date(text)


def key_insider(
    df: DataFrame, keep: Sequence[str] = (), dirty_dates: bool = False
) -> DataFrame:
    """Flattened insider records as rows for bronze.insider_transactions. The price keeps its
    landed type here; the table's constraints round it, once."""
    return df.select(
        keys.insider_key(
            F.col("symbol"), F.col("name"), F.col("transactionDate"), F.col("change"), F.col("share")
        ).alias("hash"),
        "symbol",
        "name",
        "share",
        "change",
        parse_date(F.col("filingDate"), dirty_dates).alias("filing_date"),
        parse_date(F.col("transactionDate"), dirty_dates).alias("transaction_date"),
        F.col("transactionPrice").alias("transaction_price"),
        F.col("transactionCode").alias("transaction_code"),
        *keep,
    )
