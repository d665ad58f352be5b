from __future__ import annotations

import datetime as dt
import json
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import ingest, labelling, selection
from tidemark.plans import pipeline
from tidemark.session import shared_dir
from tidemark.sources import landing, sinks
from tidemark.sources.layers import Layers
from tidemark.streaming.incremental import ingest_new_files


@pytest.fixture
def folder(spark):
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


@pytest.fixture
def layers(spark, folder):
    return Layers(spark, folder)


# --- Landed files -----------------------------------------------------------------------

BAR = "ticket string, date timestamp_ntz, close double, high double, low double, open double, volume bigint"


def test_bars_of_several_file_sets(spark, rows, folder):
    full = rows([("META", dt.datetime(2024, 1, 2), 1.5, 2.0, 1.0, 1.0, 10)], BAR)
    full.write.parquet(f"{folder}/a")
    full.drop("volume", "open").withColumn("ticket", F.lit("NVDA")).write.parquet(f"{folder}/b")
    got = landing.read_bars(spark, [f"{folder}/a", f"{folder}/b"])
    assert got.columns[:2] == ["ticket", "date"]
    assert {(r.ticket, r.close, r.volume) for r in got.collect()} == {
        ("META", 1.5, 10), ("NVDA", 1.5, None),
    }


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_bars_in_every_format(spark, rows, folder, fmt):
    full = rows([("META", dt.datetime(2024, 1, 2), 1.5, 2.0, 1.0, 1.0, 10)], BAR)
    full.write.format(fmt).option("header", True).save(folder)
    assert landing.read_bars(spark, [folder], fmt).drop(landing.LANDED, landing.POSITION).collect() == full.collect()


def test_no_bars_at_all_is_an_empty_frame(spark):
    got = landing.read_bars(spark, [])
    assert got.count() == 0
    assert got.columns == [*schemas.LANDED_BARS.fieldNames(), landing.LANDED, landing.POSITION]


def test_wide_to_long_skips_absent_tickers(rows):
    wide = rows(
        [("d1", 1.0, 2.0, None, None), ("d2", 3.0, None, None, 4.0)],
        "date string, `close|A` double, `low|A` double, `close|B` double, `low|B` double",
    )
    got = landing.wide_to_long(wide, ("A", "B"), fields=("close", "low"))
    assert {tuple(r) for r in got.collect()} == {
        ("A", "d1", 1.0, 2.0), ("A", "d2", 3.0, None), ("B", "d2", None, 4.0),
    }


PAYLOADS = [
    ("Meta", json.dumps({"status": "ok", "articles": [
        {"url": "u1", "title": "t1", "description": None, "publishedAt": "2024-01-02T03:04:05Z", "x": 1},
        {"url": "u2", "title": "t2", "description": "d", "publishedAt": "2024-01-02T03:04:05Z"},
    ]})),
    ("Apple", json.dumps({"status": "ok", "articles": []})),
    ("Nvidia", json.dumps({"status": "error", "code": "apiKeyInvalid", "articles": [{"url": "no"}]})),
    ("Netflix", '{"status": "ok", "articles": [{"url": "u3"'),
    ("None", None),
]


def test_news_payloads(rows):
    df = rows(PAYLOADS, "company string, payload string")
    good, skipped = landing.split_payloads(df, "payload", schemas.NEWS_PAYLOAD, "articles")
    assert [r.company for r in good.collect()] == ["Meta"]
    assert {(r.company, r.outcome) for r in skipped.collect()} == {
        ("Apple", "empty"), ("Nvidia", "not_ok"), ("Netflix", "corrupt"), ("None", "corrupt"),
    }
    got = landing.flatten_news(df)
    assert got.columns == ["url", "company", "publishedAt", "title", "description"]
    assert {(r.company, r.url) for r in good.transform(landing.flatten_news).collect()} == {
        ("Meta", "u1"), ("Meta", "u2"),
    }
    keyed = landing.key_news(good.transform(landing.flatten_news)).collect()
    assert keyed[0].published_at == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert len({r.hash for r in keyed}) == 2


def test_insider_payloads(rows):
    record = {"symbol": "other", "name": "Ann", "share": 5, "change": -2, "filingDate": "2024-01-04",
              "transactionDate": None, "transactionPrice": 1.005, "transactionCode": "S"}
    df = rows(
        [("META", json.dumps({"data": [record]})), ("NVDA", '{"data": []}'), ("AAPL", "{}")],
        "symbol string, payload string",
    )
    got = landing.key_insider(landing.flatten_insider(df)).collect()
    assert [(r.symbol, r.name, r.change, r.transaction_date) for r in got] == [("META", "Ann", -2, None)]
    assert got[0].filing_date == dt.date(2024, 1, 4)
    reasons = landing.split_payloads(df, "payload", schemas.INSIDER_PAYLOAD, "data")[1].collect()
    assert {r.outcome for r in reasons} == {"empty"}


def test_payload_files_carry_what_was_asked_for(spark, tmp_path):
    for company, payload in PAYLOADS[:2]:
        (tmp_path / f"company={company}").mkdir()
        (tmp_path / f"company={company}" / "page.json").write_text(payload)
    got = landing.flatten_news(landing.read_payloads(spark, str(tmp_path)))
    assert {(r.company, r.title) for r in got.collect()} == {("Meta", "t1"), ("Meta", "t2")}


def test_unreadable_dates(rows):
    df = rows([("2024-01-02",), ("soon",), (None,)], "d string")
    assert [r.x for r in df.select(landing.parse_date(F.col("d"), dirty=True).alias("x")).collect()] == [
        dt.date(2024, 1, 2), None, None,
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        df.select(landing.parse_date(F.col("d"))).collect()


def test_csv_roundtrip(spark, rows, folder):
    df = rows([("META", dt.datetime(2024, 1, 2), 1.5, 2.0, 1.0, 1.0, None)], BAR)
    sinks.write_csv(df, folder)
    assert sinks.read_csv(spark, folder, df.schema).collect() == df.collect()
    header = spark.read.text(folder).filter(F.col("value").startswith("ticket")).head()
    assert header.value == "ticket,date,close,high,low,open,volume"


# --- Selection --------------------------------------------------------------------------


def test_universe_by_list_and_by_table(rows):
    df = rows([("A",), ("B",), (None,), ("A",)], "ticket string")
    table = rows([("A",), ("A",), ("Z",)], "t string")
    assert selection.in_universe(df, "ticket", ["A", "Z"]).count() == 2
    assert selection.in_universe(df, "ticket", table).count() == 2


def test_last_sessions_keep_all_rows_of_a_session(rows):
    df = rows([("A", 1), ("A", 3), ("A", 3), ("B", 1), ("B", None)], "ticket string, date int")
    got = selection.last_sessions(df, 1)
    assert sorted(map(tuple, got.collect())) == [("A", 3), ("A", 3), ("B", 1)]


def test_newest_articles(rows):
    df = rows([("A", i // 2, f"h{i}") for i in range(9)] + [("B", 0, "x")],
              "company string, published_at int, hash string")
    got = {r.hash for r in selection.newest_articles(df, 2).collect()}
    assert got == {"h8", "h6", "x"}


@pytest.mark.parametrize(
    ("url", "member"),
    [
        ("https://www.reuters.com/markets/x", True),
        ("https://REUTERS.com", True),
        ("https://notreuters.com/", False),
        ("https://example.com/?u=reuters.com", False),
        ("not a url", False),
        (None, False),
    ],
)
def test_domains(rows, url, member):
    df = rows([(url,)], "url string")
    assert df.filter(selection.from_domains(F.col("url"))).count() == int(member)


def test_matching_articles(rows):
    url = "https://cnbc.com/a"
    at = dt.datetime(2024, 1, 9)
    df = rows(
        [
            (1, url, "en", "META up", None, at),
            (2, url, "en", None, "about Meta", at + dt.timedelta(days=3)),
            (3, url, "de", "Meta", None, at),
            (4, "https://blog.example.com", "en", "Meta", None, at),
            (5, url, "en", "Meta", None, at - dt.timedelta(seconds=1)),
            (6, url, "en", "Other", "other", at),
        ],
        "id int, url string, language string, title string, description string, published_at timestamp_ntz",
    )
    got = selection.matching_articles(df, "Meta", dt.date(2024, 1, 10))
    assert sorted(r.id for r in got.collect()) == [1, 2]


def test_trades_of_yesterday(rows):
    df = rows([(dt.date(2024, 1, d),) for d in (8, 9, 10)] + [(None,)], "transaction_date date")
    got = selection.trades_of_yesterday(df, dt.date(2024, 1, 10)).collect()
    assert [r.transaction_date.day for r in got] == [9]


# --- Bronze -----------------------------------------------------------------------------


def test_append_frames_is_a_bag_union(spark, rows):
    a, b = rows([(1, "x"), (1, "x")], "i int, s string"), rows([(2,)], "i int")
    assert sorted(map(tuple, ingest.append_frames([a, b], a.schema, spark).collect())) == [
        (1, "x"), (1, "x"), (2, None),
    ]
    assert ingest.append_frames([], a.schema, spark).schema == a.schema


def test_first_write_wins_within_and_across_batches(rows):
    schema = "hash string, v int, seq int"
    stored = rows([("a", 1, 0)], schema)
    batch = rows([("a", 2, 1), ("b", 4, 3), ("b", 3, 2), ("c", 5, 4)], schema)
    once = ingest.upsert(stored, batch, ["seq"])
    assert sorted((r.hash, r.v) for r in once.collect()) == [("a", 1), ("b", 3), ("c", 5)]
    assert ingest.upsert(once, batch, ["seq"]).count() == 3


def test_copies_are_reduced_before_the_shuffle(rows):
    df = rows([("a", 1)], "hash string, seq int")
    plan = ingest.first_write_wins(df, ["seq"])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange hashpartitioning(hash"):]
    assert "WindowGroupLimit" in below_shuffle


NEWS = (
    "hash string, company string, title string, description string, url string, "
    "published_at timestamp_ntz, sentiment string"
)


def news_row(key, **changes):
    row = {"hash": key, "company": "Meta", "title": "t", "description": f"d{key}", "url": "u",
           "published_at": dt.datetime(2024, 1, 2), "sentiment": None} | changes
    return tuple(row.values())


def test_constraints(rows):
    df = rows(
        [news_row("1"), news_row("2", title=None, sentiment="overwhelming"), news_row("3", company="x" * 101)],
        NEWS,
    )
    got = {(r.hash, r.broken_rule) for r in ingest.violations(df, ingest.NEWS_CONSTRAINTS).collect()}
    assert got == {
        ("2", "title is null"), ("2", "sentiment longer than 10"), ("3", "company longer than 100"),
    }


def test_prices_are_rounded_or_out_of_range(rows):
    df = rows(
        [("1", "M", Decimal("1.0050"), "S"), ("2", "M", Decimal("99999999.9950"), "S"), ("3", "M", None, "S")],
        "hash string, symbol string, transaction_price decimal(20,4), transaction_code string",
    )
    rules = ingest.INSIDER_CONSTRAINTS
    good, bad = ingest.split_judged(ingest.judged(df, rules), rules)
    assert {(r.hash, r.transaction_price) for r in good.collect()} == {("1", Decimal("1.01")), ("3", None)}
    assert [(r.hash, r.broken_rules) for r in bad.collect()] == [("2", ["transaction_price out of range"])]


def test_append_is_idempotent_and_prunes_by_month(layers, rows):
    batch = rows(
        [news_row("1"), news_row("2", published_at=None), news_row("1", title="later"),
         news_row("3", published_at=dt.datetime(2024, 2, 1))],
        NEWS,
    )
    layers.append_new(pipeline.NEWS, batch, ["title"])
    layers.append_new(pipeline.NEWS, batch, ["title"])
    again = [news_row("3", title="z", published_at=dt.datetime(2024, 2, 1)), news_row("4")]
    layers.append_new(pipeline.NEWS, rows(again, NEWS), ["title"])
    stored = layers.read("bronze", "news")
    assert sorted((r.hash, r.title) for r in stored.collect()) == [
        ("1", "later"), ("2", "t"), ("3", "t"), ("4", "t"),
    ]
    assert stored.filter("created_at is null").count() == 0
    assert {r.load_month for r in stored.select("load_month").distinct().collect()} == {
        "2024-01", "2024-02", "undated",
    }


def test_a_strict_batch_is_stored_whole_or_not_at_all(layers, rows):
    batch = rows([news_row("1"), news_row("2", title=None)], NEWS)
    with pytest.raises(ingest.RejectedBatch, match="title is null"):
        layers.append_new(pipeline.NEWS, batch, ["url"])
    assert not layers.exists("bronze", "news")
    for _ in range(2):
        layers.append_new(pipeline.NEWS, batch, ["url"], strict=False)
    assert [r.hash for r in layers.read("bronze", "news").collect()] == ["1"]
    assert [r.hash for r in layers.read("bronze", "news_rejected").collect()] == ["2"]


def test_counts_by(rows):
    df = rows([("a",), ("b",), ("b",), (None,)], "s string")
    assert list(map(tuple, ingest.counts_by(df, "s").collect())) == [("b", 2), ("a", 1)]


# --- Labels -----------------------------------------------------------------------------


def test_classifier_failures_and_missing_texts_are_neutral(rows):
    def flaky():
        def classify(text: str) -> str:
            if "fail" in text:
                raise RuntimeError("no answer")
            return f" {'GOOD' if 'up' in text else 'Mixed'}\n"

        return classify

    df = rows([(1, "up"), (2, "up"), (3, "fail"), (4, None), (5, "hm"), (6, None)], "i int, description string")
    one_by_one = labelling.one_by_one(flaky)
    got = {r.i: r.sentiment for r in labelling.label_with_classifier(df, one_by_one, tasks=2).collect()}
    assert got == {1: "good", 2: "good", 3: "neutral", 4: "neutral", 5: "mixed", 6: "neutral"}


def test_each_distinct_text_is_asked_once(spark, rows):
    asked = spark.sparkContext.accumulator(0)

    def counting():
        def classify(text: str) -> str:
            asked.add(1)
            return "good"

        return classify

    df = rows([(i, f"text {i % 3}") for i in range(30)], "i int, description string")
    one_by_one = labelling.one_by_one(counting)
    assert labelling.label_with_classifier(df, one_by_one, tasks=2).filter("sentiment = 'good'").count() == 30
    assert asked.value == 3


def test_batches_of_texts_in_several_tasks(spark, rows):
    def failing():
        def answer(texts):
            if texts.str.contains("fail").any():
                raise RuntimeError("no answer")
            return texts.str.upper()

        return answer

    tasks = spark.sparkContext.accumulator(0)

    def counting():
        tasks.add(1)
        return lambda texts: texts.map(lambda t: "good")

    df = rows([(i, f"text {i}") for i in range(40)], "i int, description string")
    assert labelling.label_with_classifier(df, counting, tasks=4).filter("sentiment = 'good'").count() == 40
    assert tasks.value == 4
    few = rows([(1, "good"), (2, "fail")], "i int, description string")
    assert {r.sentiment for r in labelling.label_with_classifier(few, failing, tasks=1).collect()} == {"neutral"}


def test_only_new_rows_are_labelled(spark, layers, rows):
    asked = spark.sparkContext.accumulator(0)

    def counting():
        def classify(text: str) -> str:
            asked.add(1)
            return "bad"

        return classify

    def label(df):
        return labelling.label_with_classifier(df.drop("sentiment"), labelling.one_by_one(counting), tasks=2)

    layers.append_new(pipeline.NEWS, rows([news_row("1"), news_row("2")], NEWS), ["url"], label=label)
    layers.append_new(pipeline.NEWS, rows([news_row("2"), news_row("3")], NEWS), ["url"], label=label)
    assert asked.value == 3
    assert {r.sentiment for r in layers.read("bronze", "news").collect()} == {"bad"}


# --- Layers -----------------------------------------------------------------------------


def load_bronze(layers, rows):
    news = [news_row(str(i), published_at=dt.datetime(2024, 1, 1 + i % 3, i), sentiment="good") for i in range(9)]
    layers.append_new(pipeline.NEWS, rows(news, NEWS), ["url"])
    bars = rows([("META", dt.datetime(2024, 1, d), 1.0 * d, 2.0, 1.0, 1.0, 10) for d in range(1, 8)], BAR)
    layers.append_new(pipeline.STOCKS, landing.key_bars(bars), ["date"])
    records = rows(
        [("META", "Ann", 5, 5, "2024-01-05", f"2024-01-0{d}", 2.5, "P") for d in range(1, 5)],
        "symbol string, name string, share bigint, change bigint, filingDate string, transactionDate string, "
        "transactionPrice double, transactionCode string",
    )
    layers.append_new(pipeline.INSIDER, landing.key_insider(records), ["transaction_date"])
    layers.rebuild("bronze", pipeline.TICKER_MAP, rows([("meta", "META")], "ticket string, company string"))


def test_build_layers(spark, layers, rows):
    load_bronze(layers, rows)
    for _ in range(2):  # a rebuild replaces
        gold = pipeline.build_layers(layers)
    counts = {(r.layer, r.table_name): r.row_count for r in pipeline.row_counts(layers).collect()}
    assert counts == {
        ("silver", "stocks"): 7, ("silver", "news"): 9, ("silver", "insider_transactions_stocks"): 4,
        ("gold", "stock_transations"): 7, ("gold", "stock_news"): 3, ("gold", "stock_insider_transations"): 4,
    }
    assert gold.price.count() == 7
    assert pipeline.read_gold(layers).news.filter("ticket = 'META'").count() == 3
    assert "updated_at" in layers.read("silver", "news").columns
    layers.register("gold", "stock_news")
    assert spark.table("gold.stock_news").count() == 3


def test_incremental_runs_take_each_file_once(spark, layers, rows, tmp_path):
    def land(name, *days):
        lines = [
            json.dumps({"ticket": "META", "date": f"2024-01-0{d}T00:00:00", "close": d, "high": d, "low": d,
                        "open": d, "volume": d})
            for d in days
        ]
        (tmp_path / name).write_text("\n".join(lines))

    def run():
        ingest_new_files(
            layers, pipeline.STOCKS, str(tmp_path), schemas.LANDED_BARS, landing.key_bars, ["date"]
        ).awaitTermination()
        return sorted(r.date.day for r in layers.read("bronze", "stocks").collect())

    land("a.json", 1, 2, 2)
    assert run() == [1, 2]
    land("b.json", 2, 3)
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]
