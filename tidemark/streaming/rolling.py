"""Rolling news signals of a stream of closed days, from five rows of state per ticker."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.windows import FRAME_ROWS
from tidemark.plans.gold_news import LABELS
from tidemark.streaming.daily import COUNTS

STATE = "news_date date, " + ", ".join(f"{c} long" for c in COUNTS)
ROLLING = ("rolling_5d_news_count", *[f"rolling_5d_{n}_news_count" for n in LABELS])
OUTPUT = "ticket string, news_date date, " + ", ".join(f"{c} long" for c in ROLLING)


class LastDays(StatefulProcessor):
    """Keeps the last ``FRAME_ROWS`` days of a ticker and adds them up as the next one comes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getListState("days", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.days.get()) if self.days.exists() else []
        arrived = sorted(
            (tuple(r) for part in rows for r in part[["news_date", *COUNTS]].itertuples(index=False, name=None)),
            key=lambda r: r[0],
        )
        out = []
        for day in arrived:
            if held and day[0] <= held[-1][0]:
                if tuple(day) in map(tuple, held):
                    continue  # the same day again
                raise ValueError(f"{key[0]}: {day[0]} came after {held[-1][0]}; days must be closed and in order")
            held = [*held, day][-FRAME_ROWS:]
            sums = [int(sum(d[i] for d in held)) for i in range(1, len(COUNTS) + 1)]
            out.append((key[0], day[0], *sums))
        if out:
            self.days.put([tuple(d[:1]) + tuple(int(x) for x in d[1:]) for d in held])
        names = [part.split()[0] for part in OUTPUT.split(", ")]
        yield pd.DataFrame(out, columns=names)

    def close(self) -> None:
        pass


def rolling_signals(days: DataFrame) -> DataFrame:
    """Totals over the last five days that had news, as ``plans.gold_news`` has them, of a stream of
    closed days (ticket, news_date, counters), which reach a ticker in order of time: what
    ``daily.daily_counts`` gives in append mode. A day that comes again unchanged while it is held
    adds nothing; one that is older than the last stops the stream, because its totals have left.

    The session needs RocksDB as its state store (``batches.stream_session``).
    """
    return days.groupBy("ticket").transformWithStateInPandas(
        statefulProcessor=LastDays(), outputStructType=OUTPUT, outputMode="Append", timeMode="None"
    )
