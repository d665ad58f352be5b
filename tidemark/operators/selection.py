"""Which rows of a landed feed are taken: universe, look-back, article and date filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What the default pulls ask for.
DEFAULT_TICKETS = ("AAPL", "META", "NVDA", "NFLX")
DEFAULT_COMPANIES = ("Apple", "Meta", "Nvidia", "Netflix")
DEFAULT_DOMAINS = ("bloomberg.com", "reuters.com", "cnbc.com", "techcrunch.com")
DEFAULT_LANGUAGE = "en"
ARTICLES_PER_COMPANY = 30
SESSIONS_PER_PULL = 1
EVERYONE = "all"


def in_universe(df: DataFrame, column: str, members: Iterable[str] | DataFrame) -> DataFrame:
    """Rows of the named entities. A list becomes a pushed-down IN, a table a semi join, and
    ``all`` takes whatever landed."""
    if isinstance(members, str) and members == EVERYONE:
        return df
    if isinstance(members, DataFrame):
        wanted = members.select(F.col(members.columns[0]).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    return df.filter(F.col(column).isin(list(members)))


def last_sessions(
    df: DataFrame, n: int = SESSIONS_PER_PULL, ticket: str = "ticket", date: str = "date"
) -> DataFrame:
    """The newest ``n`` sessions of each ticker, with all rows of those sessions.

    Sessions are made distinct first and ranked without their rows, so no task meets all quotes
    of a hot ticker; the rows join on (ticker, session). Undated rows are one session, the last.
    """
    newest_first = Window.partitionBy("_ticket").orderBy(F.col("_date").desc_nulls_last())
    sessions = (
        df.select(F.col(ticket).alias("_ticket"), F.col(date).alias("_date"))
        .distinct()
        .withColumn("_session", F.row_number().over(newest_first))
        .filter(F.col("_session") <= n)
    )
    same = F.col(ticket).eqNullSafe(F.col("_ticket")) & F.col(date).eqNullSafe(F.col("_date"))
    return df.join(sessions, same, "left_semi")


def newest_articles(
    df: DataFrame,
    n: int = ARTICLES_PER_COMPANY,
    group: str | Sequence[str] = "company",
    published: str = "published_at",
    tiebreak: str = "hash",
) -> DataFrame:
    """The newest ``n`` articles of each group: one result page of a company, or of a landed document."""
    keys = [group] if isinstance(group, str) else group
    newest_first = Window.partitionBy(*keys).orderBy(
        F.col(published).desc_nulls_last(), F.col(tiebreak).asc_nulls_last()
    )
    return (
        df.withColumn("_place", F.row_number().over(newest_first))
        .filter(F.col("_place") <= n)
        .drop("_place")
    )


def from_domains(url: Column, domains: Iterable[str] = DEFAULT_DOMAINS) -> Column:
    """True where the URL's host is one of the sites or a subdomain of one."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    member = F.lit(False)
    for domain in domains:
        member = member | (host == domain) | host.endswith("." + domain)
    return member


def since_yesterday(published: Column, as_of: dt.date) -> Column:
    """From midnight of the day before. The bound is made from text: a Python datetime would
    enter as an instant and shift with the session's time zone."""
    yesterday = (as_of - dt.timedelta(days=1)).isoformat()
    return published >= F.lit(yesterday).cast("timestamp_ntz")


def matching_articles(
    df: DataFrame,
    keyword: Column | str,
    as_of: dt.date,
    *,
    text: Iterable[str] = ("title", "description"),
    language: str = DEFAULT_LANGUAGE,
    domains: Iterable[str] = DEFAULT_DOMAINS,
    url: str = "url",
    language_column: str = "language",
    published: str = "published_at",
) -> DataFrame:
    """Articles that name the keyword, in one language, from the sites, since yesterday.

    The language is tested where the frame has such a column. The time bound is on the bare column so that it reaches the scan.
    """
    word = F.lower(F.lit(keyword) if isinstance(keyword, str) else keyword)
    mentioned = F.lit(False)
    for column in text:
        mentioned = mentioned | F.coalesce(F.contains(F.lower(F.col(column)), word), F.lit(False))
    spoken = F.col(language_column) == language if language_column in df.columns else F.lit(True)
    return df.filter(
        since_yesterday(F.col(published), as_of)
        & spoken
        & from_domains(F.col(url), domains)
        & mentioned
    )


def trades_of_yesterday(
    df: DataFrame, as_of: dt.date, column: str = "transaction_date"
) -> DataFrame:
    """Insider trades dated exactly one day before ``as_of``."""
    return df.filter(F.col(column) == F.lit(as_of - dt.timedelta(days=1)))
