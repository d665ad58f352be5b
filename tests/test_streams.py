"""Streams against the batch: late and repeated articles, bounded state, restarts, refused order."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.plans import gold_news, silver
from tidemark.session import lead_workers_here
from tidemark.sources import landing, pages
from tidemark.sources.layers import Layers
from tidemark.streaming import batches, daily, rolling

ARTICLE = "url string, company string, publishedAt string, title string, description string, sentiment string"
NAMES = "ticket string, company string"


def article(n, day, label="good", company="Acme", text="words"):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=n % 24)
    return (f"u{n}", company, f"{at:%Y-%m-%dT%H:%M:%S}Z", f"title {n}", text, label)


class Feed:
    def __init__(self, spark, path, names):
        self.spark, self.path = spark, str(path)
        self.session = batches.stream_session(spark, 2)
        self.names = self.session.createDataFrame(names, NAMES)
        self.schema = spark.createDataFrame([], ARTICLE).schema

    def land(self, articles):
        self.spark.createDataFrame(articles, ARTICLE).coalesce(1).write.mode("append").json(f"{self.path}/landed")
        stream = self.session.readStream.schema(self.schema).json(f"{self.path}/landed")
        query = daily.follow_articles(stream, self.names, f"{self.path}/days", f"{self.path}/progress", "3 days")
        query.awaitTermination()
        return query

    def days(self):
        return {(r.ticket, r.news_date.day - 1): r.daily_news_count for r in daily.latest_days(self.spark, f"{self.path}/days").collect()}


def test_late_articles_count_and_copies_do_not(spark, tmp_path):
    feed = Feed(spark, tmp_path, [("acme", "ACME")])
    feed.land([article(1, 0), article(2, 0), article(2, 0), article(3, 1, company="Other"), article(4, 1, text=None)])
    assert feed.days() == {("ACME", 0): 2, (None, 1): 1}
    feed.land([article(1, 0), article(5, 3), article(6, 2, "bad")])  # a copy, and a day later
    assert feed.days() == {("ACME", 0): 2, (None, 1): 1, ("ACME", 2): 1, ("ACME", 3): 1}
    feed.land([article(7, 1), article(1, 0), article(8, 0)])  # day 0 is over: 3 + 5 h - 3 days
    assert feed.days() == {("ACME", 0): 3, (None, 1): 1, ("ACME", 1): 1, ("ACME", 2): 1, ("ACME", 3): 1}
    feed.land([article(9, 9)])
    feed.land([article(10, 2), article(11, 9)])  # too late by far
    assert feed.days()["ACME", 2] == 1 and feed.days()["ACME", 9] == 2


def test_the_watermark_bounds_the_state(spark, tmp_path):
    feed = Feed(spark, tmp_path, [("acme", "Acme")])
    held = []
    for week in range(4):
        query = feed.land([article(100 * week + i, 10 * week + i % 10) for i in range(60)])
        held.append([s["numRowsTotal"] for s in query.lastProgress["stateOperators"]])
    # Six articles a day: keys live for twice the delay, days until the watermark has passed them.
    for days, keys in held[1:]:
        assert days <= 5 and keys <= 6 * 7
    assert held[1] == held[3]
    counted = daily.latest_days(spark, f"{tmp_path}/days").agg(F.sum("daily_news_count"), F.count("*")).first()
    assert tuple(counted) == (240, 40)


def test_pages_are_followed_by_the_job(spark, tmp_path):
    page = tmp_path / "news" / "company=Meta"
    page.mkdir(parents=True)
    (tmp_path / "names.csv").write_text("ticket,company\nmeta,META\n")
    root = str(tmp_path / "layers")
    assert jobs.main(["names", "--root", root, "--landing", str(tmp_path / "names.csv")], spark) == 0

    def land(name, listed):
        articles = [{"url": u, "title": t, "description": d, "publishedAt": p} for u, _, p, t, d, _ in listed]
        (page / name).write_text(json.dumps({"status": "ok", "articles": articles}))
        assert jobs.main(["follow", "--root", root, "--landing", str(tmp_path / "news")], spark) == 0

    land("1.json", [article(1, 0, text="Meta surges"), article(2, 0, text="Meta falls")])
    (page / "bad.json").write_text('{"status": "ok", "arti')
    land("2.json", [article(1, 0, text="Meta surges"), article(3, 1, text="Meta falls")])
    found = daily.latest_days(spark, Layers(spark, root).path("gold", "stock_news_daily"))
    assert {tuple(r) for r in found.collect()} == {
        ("META", dt.date(2024, 1, 1), 2, 1, 1, 0), ("META", dt.date(2024, 1, 2), 1, 0, 1, 0)
    }


@pytest.fixture
def signals(spark, tmp_path):
    """Feed closed days; gives all totals so far."""
    lead_workers_here(spark)
    session = batches.stream_session(spark, 2)
    schema = "ticket string, news_date date, " + ", ".join(f"{c} long" for c in daily.COUNTS)

    def feed(days):
        spark.createDataFrame(days, schema).write.mode("append").parquet(f"{tmp_path}/closed")
        closed = session.readStream.schema(schema).parquet(f"{tmp_path}/closed")
        batches.store_batches(rolling.rolling_signals(closed), f"{tmp_path}/signals", f"{tmp_path}/progress").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/signals").drop("batch")

    return feed


def test_three_batches_equal_the_batch_windows(spark, rows, signals):
    day0 = dt.datetime(2024, 1, 1)
    articles = [
        (f"h{i}", "c", ("A", "B", None)[i % 3], "t", "d", "u", ("good", "bad", "neutral")[i % 5 % 3], day0 + dt.timedelta(days=i * i % 41))
        for i in range(200)
    ]
    news = rows(articles, "hash_news string, company string, ticket string, news_titel string, news_description string, news_url string, news_sentiment string, published_at timestamp_ntz")
    days = gold_news.daily_news(news).collect()
    for low, high in ((0, 10), (10, 14), (14, 99)):
        found = signals([r for r in days if low <= (r.news_date - day0.date()).days < high])
    want = gold_news.news_signals(news).select("ticket", "news_date", *rolling.ROLLING)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_a_day_out_of_order_stops_the_stream(signals):
    signals([("A", dt.date(2024, 1, d), 1, 1, 0, 0) for d in (5, 6)])
    assert signals([("A", dt.date(2024, 1, 6), 1, 1, 0, 0), ("A", dt.date(2024, 1, 7), 2, 2, 0, 0)]).count() == 3
    with pytest.raises(StreamingQueryException, match="closed and in order"):
        signals([("A", dt.date(2024, 1, 6), 3, 3, 0, 0)])


def test_pages_are_the_same_as_batch_and_stream(spark, tmp_path):
    lead_workers_here(spark)
    folder = tmp_path / "landed"
    pages.register(spark)

    def land(company, name, data):
        (folder / f"company={company}").mkdir(parents=True, exist_ok=True)
        (folder / f"company={company}" / name).write_bytes(data)

    def streamed():
        reader = spark.readStream.format("landed_pages").option("path", str(folder)).option("key", "company")
        query = batches.store_batches(reader.load(), f"{tmp_path}/taken", f"{tmp_path}/progress")
        query.awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/taken").drop("batch").collect())

    def batch():
        return sorted(tuple(r) for r in spark.read.format("landed_pages").option("path", f"file:{folder}").option("key", "company").load().collect())

    land("A", "1.json", "é\n".encode())
    land("A", "2.json", b"\xff\xfe")
    land("B", "1.json", b"")
    land("B", ".hidden", b"x")
    assert [r[:4] for r in batch()] == [("A", "1.json", "é\n", None), ("A", "2.json", None, "UnicodeDecodeError"), ("B", "1.json", "", None)]
    assert streamed() == batch()
    land("C%23", "1.json", b"late")
    assert streamed() == batch() and batch()[-1][:3] == ("C#", "1.json", "late")
    assert pages.landed_pages(str(tmp_path / "nowhere"), "company") == []


def test_small_pages_share_partitions_and_fail_alone(spark, tmp_path, monkeypatch):
    lead_workers_here(spark)
    pages.register(spark)
    folder = tmp_path / "landed"
    for company in "AB":
        (folder / f"company={company}").mkdir(parents=True)
        for i in range(150):
            (folder / f"company={company}" / f"{i}.json").write_bytes(b"\xff" if i == 70 else f"{company}{i}".encode())
    read = spark.read.format("landed_pages").option("path", str(folder)).option("key", "company").load()
    assert read.rdd.getNumPartitions() == 1
    want = {(c, f"{i}.json", None if i == 70 else f"{c}{i}", "UnicodeDecodeError" if i == 70 else None) for c in "AB" for i in range(150)}
    assert {tuple(r)[:4] for r in read.collect()} == want and read.count() == 300
    # A large page is not split, and takes no small ones along beyond the limit.
    found = [pages.Page(i, "company=A", f"{i}", size) for i, size in enumerate((1, 2, pages.PARTITION_BYTES * 2, 3))]
    parts = pages.partitioned(found)
    assert [[p.name for p in part.pages] for part in parts] == [["0", "1"], ["2"], ["3"]]
    assert pages.partitioned([]) == []


def test_pages_are_landed_by_the_source(spark, tmp_path):
    lead_workers_here(spark)
    pages.register(spark)

    def source(way):
        return way.format("landed_pages").option("path", str(tmp_path / "landed")).option("key", "company")

    def land(*rows):
        source(spark.createDataFrame(rows, "entity string, page string, payload binary").write).mode("append").save()

    land(("C#/é", "1", b"a"), ("C#/é", "2", b"\xff"), (None, "1", "é".encode()), ("", "1", b""))
    land(("C#/é", "1", b"again"))
    found = {tuple(r)[:4] for r in source(spark.read).load().collect()}
    assert found == {("C#/é", "1", "again", None), ("C#/é", "2", None, "UnicodeDecodeError"), (None, "1", "é", None), ("", "1", "", None)}
    names = [p.name for p in (tmp_path / "landed").rglob("*") if p.is_file()]
    assert sorted(names) == ["1", "1", "1", "2"]
