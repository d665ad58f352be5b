"""The three ingestion runs: landed files to bronze tables.

Each run narrows the landed rows, gives them keys, appends the new ones and summarises. Model
labels are asked for last, for the articles that are really new.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import ingest, selection
from tidemark.operators.ingest import first_write_wins
from tidemark.operators.labelling import label_with_lexicon
from tidemark.plans import pipeline
from tidemark.sources import landing
from tidemark.sources.layers import BronzeTable, Layers
from tidemark.sources.sinks import store_or_csv

ARRIVAL = (landing.LANDED, landing.POSITION)
NOTHING = {"stored": 0, "earliest": None, "latest": None}


def _flat(df: DataFrame) -> DataFrame:
    """A batch in the form CSV can hold: without the columns that only order it."""
    return df.drop(*ARRIVAL)


def _store(
    layers: Layers, table: BronzeTable, batch: DataFrame, arrival: tuple[str, ...],
    *, save: bool, strict: bool, metrics: Observation | None = None,
) -> str | None:
    def append(rows: DataFrame) -> None:
        layers.append_new(table, rows, arrival, strict=strict, drop=ARRIVAL, metrics=metrics)

    backup = f"{layers.root}/csv/{table.name}"
    return store_or_csv(batch, append, backup, save, _flat)


def _skipped(layers: Layers, name: str, judged: DataFrame, asked: str) -> None:
    """Record the payloads that held nothing to store, with the reason; a repeated run adds none."""
    file = F.col(f"{landing.LANDED}.file")
    rows = (
        judged.filter("outcome <> 'good'")
        .select(
            F.md5(F.concat_ws("|", file, F.coalesce("payload", F.lit("")))).alias("hash"),
            asked,
            file.alias("file"),
            F.col("outcome").alias("reason"),
            "payload",
        )
        .dropDuplicates(["hash"])
    )
    layers.append_missing(f"{name}_skipped", rows, "hash")


def ingest_stocks(
    layers: Layers,
    bars: DataFrame,
    tickets: Iterable[str] = selection.DEFAULT_TICKETS,
    sessions: int | None = None,
    *,
    save: bool = True,
    strict: bool = True,
) -> str | None:
    """The landed sessions of the tickers, or only the newest ``sessions`` of each. Sessions that
    are stored already add nothing, so a run that was missed loses no day."""
    wanted = selection.in_universe(bars, "ticket", tickets)
    if sessions is not None:
        wanted = selection.last_sessions(wanted, sessions)
    keyed = landing.key_bars(wanted, keep=ARRIVAL)
    return _store(
        layers, pipeline.STOCKS, keyed, (*ARRIVAL, *landing.BAR_FIELDS), save=save, strict=strict
    )


def ingest_news(
    layers: Layers,
    payloads: DataFrame,
    companies: Iterable[str] = selection.DEFAULT_COMPANIES,
    as_of: dt.date | None = None,
    *,
    label: Callable[[DataFrame], DataFrame] = label_with_lexicon,
    per_page: int = selection.ARTICLES_PER_COMPANY,
    domains: Iterable[str] = selection.DEFAULT_DOMAINS,
    language: str = selection.DEFAULT_LANGUAGE,
    save: bool = True,
    strict: bool = True,
    report: Callable[[DataFrame, dict], None] | None = None,
) -> str | None:
    """The articles of the companies' landed documents, the newest ``per_page`` different ones of
    each document, which is one result page.

    With ``as_of`` only those that a request of that day would bring: since the day before, that
    name the company, from the sites, and in the language where the documents' rows tell it.
    Articles that the table does not hold are labelled once, and judged by the table's rules
    with their labels: a label that is too long refuses a strict run, which then leaves its
    labelled articles as CSV. A strict run with an article that is refused anyway asks for no label.
    Without ``save`` the articles are labelled for the CSV.

    ``report`` gets the run's articles, copies included, with their stored labels, NULL for one that
    is not stored, and what the write observed (``stored``, ``earliest``, ``latest``): no article is
    labelled for it. Documents without usable articles are recorded in ``news_skipped``.
    """
    asked = selection.in_universe(payloads, "company", companies)
    carried = [*ARRIVAL, *[c for c in ("language",) if c in asked.columns]]
    judged = landing.judge_payloads(asked, "payload", schemas.NEWS_PAYLOAD, "articles")
    staged, place = layers.stage("payloads", judged)
    try:
        if save:
            _skipped(layers, pipeline.NEWS.name, staged, "company")
        keyed = landing.key_news(landing.flatten_news(staged, keep=carried), keep=carried)
        if as_of is not None:
            keyed = selection.matching_articles(
                keyed, F.col("company"), as_of, domains=domains, language=language
            )
        keyed = keyed.drop("language")
        document = ("company", landing.LANDED)
        different = first_write_wins(keyed, ARRIVAL, (*document, "hash"))
        page = selection.newest_articles(different, per_page, document)
        if save:
            page = layers.new_rows(pipeline.NEWS, page, ARRIVAL, drop=ARRIVAL)
        else:
            page = first_write_wins(page, ARRIVAL).drop(*ARRIVAL)
        labelled, answers = _labelled(layers, page, label, strict)
        try:
            metrics = Observation("news")
            reason = _store(layers, pipeline.NEWS, labelled, (), save=save, strict=strict, metrics=metrics)
        finally:
            layers.remove(answers)
        if report is not None and reason is None:
            stored = layers.read("bronze", pipeline.NEWS.name).select("hash", "sentiment")
            report(keyed.drop("sentiment").join(stored, "hash", "left"), ingest.observed(metrics, NOTHING))
        return reason
    finally:
        layers.remove(place)


def _labelled(
    layers: Layers, articles: DataFrame, label: Callable[[DataFrame], DataFrame], strict: bool
) -> tuple[DataFrame, str]:
    """The articles with labels, written once, and where. Those that the table refuses whatever
    their label is get none, and no one does if that refuses the whole run."""
    judged, place = layers.stage("articles", ingest.judged(articles, pipeline.NEWS.constraints))
    try:
        broken = F.size(ingest.BROKEN) > 0
        refused = judged.filter(broken)
        if strict and not refused.isEmpty():
            return layers.stage("labelled", judged.drop(ingest.BROKEN))
        asked = label(judged.filter(~broken).drop(ingest.BROKEN, "sentiment"))
        return layers.stage("labelled", asked.unionByName(refused.drop(ingest.BROKEN)))
    finally:
        layers.remove(place)


def ingest_insider(
    layers: Layers,
    payloads: DataFrame,
    symbols: Iterable[str] = selection.DEFAULT_TICKETS,
    as_of: dt.date | None = None,
    *,
    save: bool = True,
    strict: bool = True,
) -> str | None:
    """The symbols' trades, of the day before ``as_of`` when it is given. Documents without usable
    trades are recorded in ``insider_transactions_skipped``."""
    asked = selection.in_universe(payloads, "symbol", symbols)
    judged = landing.judge_payloads(asked, "payload", schemas.INSIDER_PAYLOAD, "data")
    staged, place = layers.stage("payloads", judged)
    try:
        if save:
            _skipped(layers, pipeline.INSIDER.name, staged, "symbol")
        keyed = landing.key_insider(landing.flatten_insider(staged, keep=ARRIVAL), keep=ARRIVAL)
        if as_of is not None:
            keyed = selection.trades_of_yesterday(keyed, as_of)
        return _store(layers, pipeline.INSIDER, keyed, ARRIVAL, save=save, strict=strict)
    finally:
        layers.remove(place)
