"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from tidemark.catalog import REGISTRY

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")


def plan_of(spark, name: str) -> str:
    return REGISTRY[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffling(spark):
    """Plan as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Queries that write first: their plan shows how the result is read again, and they are run by other tests.
WRITES = {
    "build_layers", "csv_sink_roundtrip", "gold_price_incremental", "landed_pages_read", "load_stamps", "news_run_labels",
    "stream_news_daily", "stream_news_rolling",
}
PYTHON = {"sentiment_classifier"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITES - PYTHON))
def test_no_cross_join_and_no_python(shuffling, name):
    plan = plan_of(shuffling, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas", "InPandas"):
        assert node not in plan
    assert "BroadcastExchange" not in plan  # none is forced


@pytest.mark.parametrize("name", ["series_price_sentiment", "series_price_insider", "correlation_matrix"])
def test_the_target_filters_the_parts(spark, name):
    plan = plan_of(spark, name)
    # The ticker is a literal: the bars of other tickers go before their join with the line items.
    assert re.findall(r"Filter [^\n]*upper\(replace\(p_brand", plan)
    assert "LeftSemi" not in plan


def windows(plan: str) -> list[str]:
    return re.findall(r"Window \[.*", plan)


@pytest.mark.parametrize("name", ["gold_news_rolling", "gold_insider_cumulative"])
def test_frames_of_an_aggregated_table_share_one_window(spark, name):
    by_ticker = [w for w in windows(plan_of(spark, name)) if "row_number" not in w]
    assert len(by_ticker) == 1


def test_price_windows_never_run_by_ticker_alone(spark):
    plan = plan_of(spark, "gold_price_all")
    over_rows = [w for w in windows(plan) if "lag(" in w]
    assert len(over_rows) == 1
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    by_ticker = [k for k in keys if re.fullmatch(r"ticket#\d+, \d+", k)]
    assert len(by_ticker) == 1  # chunk tails only
    assert "collect_list(_tail" in "".join(w for w in windows(plan) if "lag(" not in w)


@pytest.mark.parametrize(
    "name",
    ["bronze_upsert_stocks", "bronze_upsert_news", "bronze_upsert_insider", "news_top30", "lookback_period"],
)
def test_groups_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("target_ticker", {"l_partkey", "l_shipdate"}),
        ("insider_date_parse", {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag",
                                "o_orderkey", "o_custkey", "o_orderdate", "c_custkey"}),
        ("news_counts_by_sentiment", {"event_id", "ts", "user_id", "event_type", "props"}),
        ("sentiment_label", {"doc_id", "text"}),
    ],
)
def test_scans_read_only_the_needed_columns(spark, name, columns):
    scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan_of(spark, name))
    read = {column.split("#")[0] for scan in scans for column in scan.split(",")}
    assert read - {"p_partkey", "p_brand"} == columns


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in plan_of(spark, "news_predicates")


PRICE_QUERIES = [n for n in REGISTRY if n.startswith("gold_") and "insider" not in n and "news" not in n and n not in WRITES]


@pytest.mark.parametrize(
    "name", [*PRICE_QUERIES, "box_stats", "box_outliers", "scatter_news_volume", "dispersion_by_intensity"]
)
def test_bars_are_evaluated_once(spark, name):
    df = REGISTRY[name](spark, str(FOLDER))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^]]*l_shipdate", final)) == 1


def test_no_rank_over_raw_quotes(spark):
    over = [w for w in windows(plan_of(spark, "lookback_period"))]
    assert over and not any("dense_rank" in w for w in over)


def test_each_payload_is_parsed_once(spark):
    plan = plan_of(spark, "payload_reject_split")
    assert plan.count("from_json") == 1 and plan.count("FileScan") == 1


def test_insider_names_are_loaded_once_and_not_copied(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = REGISTRY["insider_distinct_rolling"](spark, str(FOLDER))
        frame.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = re.sub(r"== Initial Plan ==.*?(?=== Final Plan ==|\Z)", "", plan, flags=re.S)
    # What is loaded is shuffled once; a stage that is read again is not printed again.
    assert len(re.findall(r"Window \[row_number[^\n]*AS _arrival", final)) <= 1
    # Days are told from pairs of days: no copy of a name is made for each frame that holds it.
    made = re.findall(r"Generate explode\(sequence[^\n]*", final)
    assert len(made) == 1 and not re.search("name#|_value#", made[0])
