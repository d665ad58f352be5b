"""The jobs in order, over landed files: ingestion, build, checks, analysis."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from tidemark import jobs
from tidemark.operators.ingest import RejectedBatch
from tidemark.operators.labelling import label_with_classifier, one_by_one
from tidemark.plans import ingestion
from tidemark.sources import landing
from tidemark.sources.layers import Layers
from tidemark.sources.sinks import store_or_csv


def land_bars(path):
    lines = ["ticket,date,close,high,low,open,volume"]
    for ticket in ("META", "NVDA", "OTHER"):
        for i in range(10):
            day = dt.date(2024, 1, 1 + i)
            lines.append(f"{ticket},{day}T00:00:00,{10 + i % 4}.25,{20 + i},{5 + i},{9 + i},{100 * (i + 1)}")
    lines.append(lines[-1])
    path.mkdir()
    (path / "bars.csv").write_text("\n".join(lines))


def land_news(path):
    for company, verb in (("Meta", "surges"), ("Nvidia", "falls"), ("Nobody", "wins")):
        (path / f"company={company}").mkdir(parents=True)
        articles = [
            {"url": f"https://www.cnbc.com/u{i}", "title": f"t{i}", "description": f"{company} {verb} {i}",
             "publishedAt": f"2024-01-{3 + i:02}T10:00:00Z"}
            for i in range(4)
        ]
        page = json.dumps({"status": "ok", "articles": articles + articles[:1]})
        (path / f"company={company}" / "1.json").write_text(page)
    (path / "company=Apple").mkdir()
    (path / "company=Apple" / "1.json").write_text('{"status": "ok", "arti')


def land_insider(path):
    for symbol in ("META", "NVDA"):
        (path / f"symbol={symbol}").mkdir(parents=True)
        data = [
            {"symbol": "x", "name": n, "share": 10, "change": c, "filingDate": "2024-01-08",
             "transactionDate": f"2024-01-0{d}", "transactionPrice": 2.5, "transactionCode": "S"}
            for n, c, d in (("Ann", 10, 3), ("Bob", -40, 3), ("Ann", -5, 6))
        ]
        (path / f"symbol={symbol}" / "1.json").write_text(json.dumps({"data": data}))


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    land_bars(base / "bars")
    land_news(base / "news")
    land_insider(base / "insider")
    (base / "names.csv").write_text("ticket,company\nmeta,META\nnvda,NVIDIA\n")
    root = str(base / "layers")
    for _ in range(2):  # repeated runs change nothing
        for command in (
            ["stocks", "--landing", str(base / "bars"), "--format", "csv", "--sessions", "all"],
            ["news", "--landing", str(base / "news")],
            ["insider", "--landing", str(base / "insider")],
            ["names", "--landing", str(base / "names.csv")],
        ):
            assert jobs.main([*command, "--root", root], spark) == 0
    assert jobs.main(["build", "--root", root], spark) == 0
    return root


def test_bronze(spark, root):
    layers = Layers(spark, root)
    assert layers.read("bronze", "stocks").count() == 20
    news = layers.read("bronze", "news")
    assert {(r.company, r.sentiment) for r in news.collect()} == {("Meta", "good"), ("Nvidia", "bad")}
    assert news.count() == 8
    insider = layers.read("bronze", "insider_transactions")
    assert insider.count() == 6
    assert dict(insider.dtypes)["transaction_price"] == "decimal(10,2)"
    for table in (news, insider):
        assert not {landing.LANDED, landing.POSITION} & set(table.columns)


def test_checks_pass_and_fail(spark, root, capsys):
    assert jobs.main(["check", "--root", root], spark) == 0
    assert "FAILED" not in capsys.readouterr().out


def test_analysis(spark, root):
    assert jobs.main(["analyse", "--root", root], spark) == 0
    layers = Layers(spark, root)
    sentiment = layers.read("analysis", "price_vs_sentiment")
    assert {r.ticket for r in sentiment.collect()} == {"META"}
    assert sentiment.filter("daily_sentiment_score = 1").count() == 4
    assert layers.read("analysis", "correlation_matrix").count() == 25
    totals = {r.ticket: r.total_shares_sold_abs for r in layers.read("analysis", "insider_totals").collect()}
    assert totals == {"META": 45, "NVDA": 45}
    assert layers.read("analysis", "contrarian_buys").count() == 2


def test_date_windows(spark, root, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    land_news(tmp_path / "news")
    land_insider(tmp_path / "insider")
    as_of = dt.date(2024, 1, 7)
    payloads = landing.read_payloads(spark, str(tmp_path / "news"))
    assert ingestion.ingest_news(layers, payloads, ["Meta"], as_of, per_page=30) is None
    assert layers.read("bronze", "news").count() == 1
    trades = landing.read_payloads(spark, str(tmp_path / "insider"))
    assert ingestion.ingest_insider(layers, trades, ["NVDA", "META"], as_of) is None
    assert [r.name for r in layers.read("bronze", "insider_transactions").collect()] == ["Ann", "Ann"]


def test_csv_when_saving_is_off_or_fails(spark, rows, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    land_bars(tmp_path / "bars")
    bars = landing.read_bars(spark, [str(tmp_path / "bars")], "csv")
    assert "off" in ingestion.ingest_stocks(layers, bars, ["META"], 2, save=False)
    backup = spark.read.option("header", True).csv(f"{layers.root}/csv/stocks/*")
    assert {r.date[:10] for r in backup.collect()} == {"2024-01-09", "2024-01-10"}
    assert not layers.exists("bronze", "stocks")

    def refuse(df):
        raise RejectedBatch("no")

    assert store_or_csv(rows([(1,)], "i int"), refuse, str(tmp_path / "other")) == "no"
    assert spark.read.option("header", True).csv(f"{tmp_path}/other/*").count() == 1


def pulls(path, pages, text="Meta"):
    """Landed news documents of Meta: each page a list of article numbers, which ``text`` may name."""
    (path / "company=Meta").mkdir(parents=True)
    for n, numbers in enumerate(pages):
        articles = [
            {"url": f"u{i}", "title": f"t{i}", "description": text.format(i), "publishedAt": f"2024-01-01T00:{i:02}:00Z"}
            for i in numbers
        ]
        (path / "company=Meta" / f"{n}.json").write_text(json.dumps({"status": "ok", "articles": articles}))


@pytest.mark.parametrize(
    ("pages", "stored"),
    [([range(30), range(30, 60)], 60), ([range(30), range(30)], 30), ([[*range(30), *range(30)]], 30), ([range(31)], 30)],
)
def test_no_pull_takes_another_ones_place(spark, tmp_path, pages, stored):
    pulls(tmp_path / "news", pages)
    layers = Layers(spark, str(tmp_path / "layers"))
    seen = []
    payloads = landing.read_payloads(spark, str(tmp_path / "news"))
    assert ingestion.ingest_news(layers, payloads, "all", report=lambda rows, _: seen.append(rows.count())) is None
    assert layers.read("bronze", "news").count() == stored
    assert seen == [sum(len(p) for p in pages)]


def test_a_missed_run_loses_no_session(spark, tmp_path):
    land_bars(tmp_path / "bars")
    layers = Layers(spark, str(tmp_path / "layers"))
    assert jobs.main(["stocks", "--root", layers.root, "--landing", str(tmp_path / "bars"), "--format", "csv", "--tickets", "all"], spark) == 0
    assert layers.read("bronze", "stocks").count() == 30


def test_request_of_a_day_is_matched(spark, tmp_path):
    (tmp_path / "news" / "company=Meta").mkdir(parents=True)
    def article(n, url="https://cnbc.com/a", text="Meta wins", day=6):
        return {"url": url, "title": f"t{n}", "description": text, "publishedAt": f"2024-01-0{day}T10:00:00Z"}
    listed = [article(1), article(2, url="https://other.com"), article(3, text="Apple wins"), article(4, day=5)]
    (tmp_path / "news" / "company=Meta" / "1.json").write_text(json.dumps({"status": "ok", "articles": listed}))
    layers = Layers(spark, str(tmp_path / "layers"))
    payloads = landing.read_payloads(spark, str(tmp_path / "news"))
    assert ingestion.ingest_news(layers, payloads, ["Meta"], dt.date(2024, 1, 7)) is None
    assert [r.title for r in layers.read("bronze", "news").collect()] == ["t1"]


def test_summary_counts_the_run_only(spark, tmp_path, capsys):
    layers = Layers(spark, str(tmp_path / "layers"))
    for day, pages in enumerate(([range(5)], [range(5, 8)])):
        pulls(tmp_path / f"news{day}", pages)
        assert jobs.main(["news", "--root", layers.root, "--landing", str(tmp_path / f"news{day}")], spark) == 0
    shown = capsys.readouterr().out
    assert "|Meta   |5        |" in shown and "|Meta   |3        |" in shown and "|Meta   |8        |" not in shown


def test_skipped_payloads_are_recorded_once(spark, root):
    skipped = Layers(spark, root).read("bronze", "news_skipped").collect()
    assert [(r.company, r.reason) for r in skipped] == [("Apple", "corrupt")]


def test_first_row_of_a_parquet_file_wins(spark, rows, tmp_path):
    moment = dt.datetime(2024, 1, 1)
    data = [("META", moment, c, c, c, c, 1) for c in (9.0, 5.0)]
    ddl = "ticket string, date timestamp_ntz, close double, high double, low double, open double, volume bigint"
    rows(data, ddl).coalesce(1).write.parquet(str(tmp_path / "bars"))
    layers = Layers(spark, str(tmp_path / "layers"))
    assert ingestion.ingest_stocks(layers, landing.read_bars(spark, [str(tmp_path / "bars")])) is None
    assert [r.close for r in layers.read("bronze", "stocks").collect()] == [9.0]


def test_price_is_rounded_once(rows):
    from tidemark.operators.ingest import INSIDER_CONSTRAINTS

    prices = [10.00499999, 10.005, -10.005, 99999999.994, 99999999.995, float("nan"), None]
    df = rows([(str(i), p) for i, p in enumerate(prices)], "hash string, transaction_price double")
    got = [r[0] and str(r[0]) for r in INSIDER_CONSTRAINTS.store_types(df).orderBy("hash").select("transaction_price").collect()]
    assert got == ["10.00", "10.01", "-10.01", "99999999.99", None, None, None]


def test_failed_rebuild_leaves_the_old_table(spark, rows, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    layers.rebuild("silver", "t", rows([(1,)], "i int"))
    broken = rows([(2,)], "i int").selectExpr("if(i = 2, raise_error('no'), i) as i")
    with pytest.raises(Exception, match="no"):
        layers.rebuild("silver", "t", broken)
    assert [r.i for r in layers.read("silver", "t").collect()] == [1]
    for n in (3, 4, 5):
        assert [r.i for r in layers.rebuild("silver", "t", rows([(n,)], "i int")).collect()] == [n]
    assert len(layers._builds("silver", "t")) == 2


def test_build_registers_the_tables(spark, root):
    assert spark.table("gold.stock_news").count() == Layers(spark, root).read("gold", "stock_news").count()
    assert not any((Layers(spark, root)._folder(f"{root}/_staging/{t}")[0].listStatus(Layers(spark, root)._folder(f"{root}/_staging/{t}")[1])) for t in ("news", "payloads"))


def test_a_bug_is_no_reason_for_csv(rows, tmp_path):
    def wrong(df):
        raise KeyError("a bug")

    with pytest.raises(KeyError):
        store_or_csv(rows([(1,)], "i int"), wrong, str(tmp_path / "other"))


def counting_label(spark, answers):
    """A model's label, and how often it was asked."""
    asked = spark.sparkContext.accumulator(0)

    def make():
        def one(text):
            asked.add(1)
            return answers(text)

        return one

    return lambda df: label_with_classifier(df, one_by_one(make), tasks=2), asked


def test_a_model_is_asked_once_per_new_text(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    label, asked = counting_label(spark, lambda text: "good")
    told = []
    for day, part in enumerate((range(4), range(2, 6))):
        pulls(tmp_path / f"news{day}", [part, part], "Meta {}")
        payloads = landing.read_payloads(spark, str(tmp_path / f"news{day}"))
        report = lambda rows, written: told.append((written["stored"], rows.count(), rows.filter("sentiment = 'good'").count()))
        assert ingestion.ingest_news(layers, payloads, "all", label=label, report=report) is None
    # Copies are reported with the stored label; the two articles of both days are asked about once.
    assert told == [(4, 8, 8), (2, 8, 8)] and asked.value == 6


def test_a_long_label_refuses_a_strict_run_and_is_kept_apart_in_another(spark, tmp_path):
    pulls(tmp_path / "news", [range(4)], "Meta {}")
    payloads = landing.read_payloads(spark, str(tmp_path / "news"))
    label, asked = counting_label(spark, lambda text: "extremely positive" if text.endswith("3") else "bad")
    strict = Layers(spark, str(tmp_path / "strict"))
    reason = ingestion.ingest_news(strict, payloads, "all", label=label, report=lambda *_: pytest.fail("nothing was stored"))
    assert "sentiment longer than 10" in reason and not strict.exists("bronze", "news")
    backup = spark.read.option("header", True).csv(f"{strict.root}/csv/news/*")
    assert sorted(r.sentiment for r in backup.collect()) == ["bad", "bad", "bad", "extremely positive"] and asked.value == 4
    apart = Layers(spark, str(tmp_path / "apart"))
    assert ingestion.ingest_news(apart, payloads, "all", label=label, strict=False) is None
    assert apart.read("bronze", "news").count() == 3
    assert [r.broken_rules for r in apart.read("bronze", "news_rejected").collect()] == [["sentiment longer than 10"]]


def test_a_run_that_is_refused_anyway_asks_no_model(spark, tmp_path):
    (tmp_path / "news" / "company=Meta").mkdir(parents=True)
    articles = [{"url": "u", "title": t, "description": "d", "publishedAt": "2024-01-01T00:00:00Z"} for t in ("a", None)]
    (tmp_path / "news" / "company=Meta" / "1.json").write_text(json.dumps({"status": "ok", "articles": articles}))
    payloads = landing.read_payloads(spark, str(tmp_path / "news"))
    label, asked = counting_label(spark, lambda text: "good")
    reason = ingestion.ingest_news(Layers(spark, str(tmp_path / "layers")), payloads, "all", label=label)
    assert "title is null" in reason and asked.value == 0


def test_without_saving_the_csv_has_labels(spark, tmp_path):
    pulls(tmp_path / "news", [range(3)], "Meta {}")
    layers = Layers(spark, str(tmp_path / "layers"))
    payloads = landing.read_payloads(spark, str(tmp_path / "news"))
    label, asked = counting_label(spark, lambda text: "good")
    assert ingestion.ingest_news(layers, payloads, "all", label=label, save=False) is not None
    rows = spark.read.option("header", True).csv(f"{layers.root}/csv/news/*").collect()
    assert [r.sentiment for r in rows] == ["good"] * 3 and asked.value == 3
