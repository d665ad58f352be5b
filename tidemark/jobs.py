"""The jobs as commands, for spark-submit or ``python -m tidemark.jobs``.

    stocks  --root DIR --landing PATH [--format csv] [--sessions N|all] [--tickets A,B|all]
    news    --root DIR --landing PATH [--as-of 2024-01-02] [--companies A,B|all] [--domains A,B]
    follow  --root DIR --landing PATH         (daily sentiment of newly landed news pages)
    insider --root DIR --landing PATH [--as-of 2024-01-02] [--tickets A,B|all]
    names   --root DIR --landing CSV          (the ticker map)
    build   --root DIR                        (silver and gold)
    check   --root DIR                        (exit code 1 when a quality check fails)
    analyse --root DIR [--ticker META]        (datasets under DIR/analysis)
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.operators import selection
from tidemark.operators.ingest import counts_by
from tidemark.plans import analysis, ingestion, pipeline, quality
from tidemark.session import build_session
from tidemark.sources import landing
from tidemark.sources.layers import Layers
from tidemark.streaming import batches, daily


def _listed(text: str | None, default: tuple[str, ...]) -> list[str] | str:
    if text == selection.EVERYONE:
        return text
    return text.split(",") if text else list(default)


def stocks(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    bars = landing.read_bars(spark, args.landing.split(","), args.format)
    sessions = None if args.sessions == selection.EVERYONE else int(args.sessions)
    tickets = _listed(args.tickets, selection.DEFAULT_TICKETS)
    return _reported(ingestion.ingest_stocks(layers, bars, tickets, sessions))


def news(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    payloads = landing.read_payloads(spark, args.landing)
    companies = _listed(args.companies, selection.DEFAULT_COMPANIES)
    domains = _listed(args.domains, selection.DEFAULT_DOMAINS)

    def summary(articles: DataFrame, written: dict) -> None:
        """Of this run's articles, copies included."""
        print(f"{written['stored']} new articles, {written['earliest']} to {written['latest']}")
        for column in ("company", "sentiment"):
            counts_by(articles, column).show(truncate=False)

    return _reported(
        ingestion.ingest_news(layers, payloads, companies, args.as_of, domains=domains, report=summary)
    )


def follow(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    """Daily sentiment of the pages that landed since the last run."""
    session = batches.stream_session(spark)
    names = session.read.parquet(layers.location(pipeline.BRONZE, pipeline.TICKER_MAP))
    articles = daily.landed_articles(session, args.landing)
    out = layers.path("gold", "stock_news_daily")
    daily.follow_articles(articles, names, out, f"{layers.root}/_progress/stock_news_daily").awaitTermination()
    print(f"{daily.latest_days(spark, out).count()} days with news")
    return 0


def insider(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    payloads = landing.read_payloads(spark, args.landing)
    symbols = _listed(args.tickets, selection.DEFAULT_TICKETS)
    return _reported(ingestion.ingest_insider(layers, payloads, symbols, args.as_of))


def names(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    listed = spark.read.schema(schemas.TICKER_MAP).option("header", True).csv(args.landing)
    layers.rebuild(pipeline.BRONZE, pipeline.TICKER_MAP, listed)
    return 0


def build(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    pipeline.build_layers(layers)
    pipeline.register_layers(layers)
    pipeline.row_counts(layers).show(truncate=False)
    return 0


def check(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    gold = pipeline.read_gold(layers)
    counted = quality.check_null_columns(gold).unionByName(quality.check_accepted_values(gold))
    failures = {
        "unique keys": quality.check_unique(gold),
        "complete keys": quality.check_null_keys(gold),
        "column values": counted.filter("failures > 0"),
    }
    failed = 0
    for name, rows in failures.items():
        bad = not rows.isEmpty()
        print(f"{name}: {'FAILED' if bad else 'ok'}")
        if bad:
            rows.show(truncate=False)
        failed |= bad
    return int(failed)


def analyse(spark: SparkSession, layers: Layers, args: argparse.Namespace) -> int:
    gold = pipeline.read_gold(layers)
    master = layers.rebuild("analysis", "master", analysis.master_merge(gold))
    target = master.join(
        analysis.target_ticker(master, args.ticker).hint("broadcast"), "ticket", "left_semi"
    )
    datasets: dict[str, DataFrame] = {
        "price_vs_sentiment": analysis.price_and_sentiment(target),
        "price_vs_insider": analysis.price_and_insider(target),
        "correlation_matrix": analysis.correlation_matrix(target),
        "insider_totals": analysis.insider_totals(gold.insider),
        "box_stats": analysis.box_stats(master),
        "box_outliers": analysis.box_outliers(master),
        "news_volume_points": analysis.news_volume_points(master),
        "hype_correlation": analysis.hype_correlation(master),
        "sell_buy_ratio": analysis.sell_buy_ratio(gold.insider),
        "contrarian_buys": analysis.contrarian_buys(gold.insider),
        "dispersion_by_intensity": analysis.dispersion_by_intensity(master),
    }
    for name, rows in datasets.items():
        layers.rebuild("analysis", name, rows)
    return 0


def _reported(reason: str | None) -> int:
    if reason is not None:
        print(f"not stored in the table, written as CSV: {reason}", file=sys.stderr)
    return 0 if reason is None else 1


COMMANDS = {f.__name__: f for f in (stocks, news, follow, insider, names, build, check, analyse)}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__.splitlines()[0])
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--root", required=True, help="folder of the layers, shared by all executors")
    parser.add_argument("--landing", help="landed files")
    parser.add_argument("--format", default="parquet", help="format of landed bars")
    parser.add_argument("--sessions", default=selection.EVERYONE)
    parser.add_argument("--tickets")
    parser.add_argument("--companies")
    parser.add_argument("--domains", help="sites of the news run with --as-of")
    parser.add_argument("--as-of", type=dt.date.fromisoformat)
    parser.add_argument("--ticker", default=analysis.PREFERRED_TICKER)
    args = parser.parse_args(argv)
    spark = spark or build_session()
    return COMMANDS[args.command](spark, Layers(spark, args.root.rstrip("/")), args)


if __name__ == "__main__":
    sys.exit(main())
