"""Gold months that a change reaches, and the difference of two builds."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest

from tidemark.operators import reconcile
from tidemark.plans import incremental
from tidemark.plans.gold_price import price_indicators
from tidemark.sources.layers import Layers

SCHEMA = (
    "stock_hash string, ticket string, trading_date date, close_price decimal(18,4), high_price decimal(18,4), "
    "low_price decimal(18,4), open_price decimal(18,4), trade_volume bigint"
)


def history(rng):
    """A dense ticker, a sparse one with months between its rows, one without a name, undated rows."""
    out = []
    for ticket, step, n in (("DENSE", 2, 300), ("SPARSE", 80, 20), (None, 20, 20)):
        day = dt.date(2020, 1, 1)
        for i in range(n):
            day += dt.timedelta(days=rng.randint(1, step))
            price = Decimal(rng.randint(1, 10**6)).scaleb(-4)
            out.append((f"{ticket}{i:04d}", ticket, None if rng.random() < 0.02 else day, price, price, price, price, rng.randint(0, 999)))
    return out


def files(layers):
    return {str(p): p.stat().st_mtime_ns for p in Path(layers.path("gold", incremental.TABLE)).glob("*/*.parquet")}


def told(df):
    return sorted(map(str, map(tuple, df.select(sorted(df.columns)).collect())))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_refresh_equals_a_full_build_and_leaves_other_months(spark, rows, tmp_path, seed):
    rng = random.Random(seed)
    data = history(rng)
    late = set(rng.sample(range(len(data)), 3))
    wrong = set(rng.sample([i for i in range(len(data)) if i not in late], 2))
    first = [(*r[:3], r[3] + 1, *r[4:]) if i in wrong else r for i, r in enumerate(data) if i not in late]
    layers = Layers(spark, str(tmp_path))
    incremental.build_prices(layers, rows(first, SCHEMA))
    before = files(layers)
    changed = rows([r[1:3] for i, r in enumerate(data) if i in late | wrong], "ticket string, trading_date date")
    whole = rows(data, SCHEMA)
    months = incremental.refresh_prices(layers, whole, changed)
    assert told(incremental.read_prices(layers)) == told(price_indicators(whole))
    kept = {p: at for p, at in before.items() if Path(p).parent.name.split("=")[1] not in months}
    assert kept and kept.items() <= files(layers).items()


def test_nothing_changed_writes_nothing(spark, rows, tmp_path):
    layers = Layers(spark, str(tmp_path))
    whole = rows(history(random.Random(5)), SCHEMA)
    incremental.build_prices(layers, whole)
    before = files(layers)
    assert incremental.refresh_prices(layers, whole, whole.limit(0).select("ticket", "trading_date")) == []
    assert files(layers) == before


def test_differences_are_bags(rows):
    left = rows([(1, "a"), (1, "a"), (None, None), (2, "b"), (3, "c")], "n int, s string")
    right = rows([("a", 1), (None, None), (None, None), ("b", 2), ("d", 4)], "s string, n int")
    found = {tuple(r) for r in reconcile.differences(left, right).select("n", "s", "only_in", "copies").collect()}
    assert found == {(1, "a", "left", 1), (None, None, "right", 1), (3, "c", "left", 1), (4, "d", "right", 1)}
    assert reconcile.differences(left, left).count() == 0
    with pytest.raises(ValueError):
        reconcile.differences(left, right.drop("n"))
