"""From bronze to gold in one go: full refresh of the derived layers."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ingest import INSIDER_CONSTRAINTS, NEWS_CONSTRAINTS, STOCK_CONSTRAINTS
from tidemark.plans import gold as gold_plan
from tidemark.plans import silver as silver_plan
from tidemark.plans.gold import Gold
from tidemark.plans.silver import Bronze, Silver
from tidemark.sources.layers import BronzeTable, Layers

# Layer and table names.
BRONZE, SILVER, GOLD = "bronze", "silver", "gold"
STOCKS = BronzeTable("stocks", date="date", constraints=STOCK_CONSTRAINTS)
NEWS = BronzeTable("news", date="published_at", constraints=NEWS_CONSTRAINTS)
INSIDER = BronzeTable(
    "insider_transactions", date="transaction_date", constraints=INSIDER_CONSTRAINTS
)
TICKER_MAP = "auxiliary_table_tck_name"
SILVER_TABLES = {"stocks": "stocks", "news": "news", "insider": "insider_transactions_stocks"}
GOLD_TABLES = {
    "price": "stock_transations", "news": "stock_news", "insider": "stock_insider_transations",
}


def read_bronze(layers: Layers) -> Bronze:
    return Bronze(
        stocks=layers.read(BRONZE, STOCKS.name),
        news=layers.read(BRONZE, NEWS.name),
        insider=layers.read(BRONZE, INSIDER.name),
        ticker_map=layers.read(BRONZE, TICKER_MAP),
    )


def read_gold(layers: Layers) -> Gold:
    return Gold(**{part: layers.read(GOLD, name) for part, name in GOLD_TABLES.items()})


def _at_once(layers: Layers, layer: str, tables: dict[str, tuple[str, DataFrame]]) -> dict[str, DataFrame]:
    """Rebuild tables that don't need each other from threads, so that the end of one write, when few
    of its tasks are left, overlaps with the others."""

    def rebuild(name: str, rows: DataFrame) -> DataFrame:
        return layers.rebuild(layer, name, rows)

    with ThreadPoolExecutor(len(tables)) as pool:
        begun = {
            part: pool.submit(inheritable_thread_target(layers.spark)(rebuild), name, rows)
            for part, (name, rows) in tables.items()
        }
        return {part: future.result() for part, future in begun.items()}


def build_layers(layers: Layers, bronze: Bronze | None = None) -> Gold:
    """Rebuild silver from bronze and gold from the written silver.

    Each layer is read back from its files, so a lost executor replays one layer at most. The tables
    of a layer are written side by side.
    """
    silver = silver_plan.build(bronze or read_bronze(layers))
    stamped = {p: (n, silver_plan.stamped(getattr(silver, p))) for p, n in SILVER_TABLES.items()}
    gold = gold_plan.build(Silver(**_at_once(layers, SILVER, stamped)))
    return Gold(**_at_once(layers, GOLD, {p: (n, getattr(gold, p)) for p, n in GOLD_TABLES.items()}))


def register_layers(layers: Layers) -> None:
    """Name the silver and gold tables in the catalog, as ``silver.x`` and ``gold.x``."""
    for layer, tables in ((SILVER, SILVER_TABLES), (GOLD, GOLD_TABLES)):
        for table in tables.values():
            layers.register(layer, table)


def row_counts(layers: Layers) -> DataFrame:
    """Rows per derived table."""
    tables = [(SILVER, t) for t in SILVER_TABLES.values()] + [
        (GOLD, t) for t in GOLD_TABLES.values()
    ]
    counted = [
        layers.read(layer, table)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count")
        for layer, table in tables
    ]
    return reduce(DataFrame.unionByName, counted)
