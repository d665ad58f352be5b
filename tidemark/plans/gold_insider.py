"""Gold: insider activity per symbol and transaction day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.numeric import safe_divide, sign_flag
from tidemark.operators.windows import day_windows

# Fixed value: days between activities that still make a cluster.
CLUSTER_DAYS = 3


def daily_insider(silver_insider: DataFrame) -> DataFrame:
    """Totals per symbol and day, including the bought and sold values.

    ``count(DISTINCT name)`` is exact; Spark groups by (symbol, day, name) first, which also
    spreads a hot symbol.
    """
    query = """
        SELECT symbol, transaction_date,
               count(DISTINCT name) AS distinct_insiders_active,
               sum(if(change > 0, change, 0)) AS total_shares_bought,
               sum(if(change < 0, change, 0)) AS total_shares_sold,
               sum(change) AS net_shares_flow,
               sum(if(change > 0, transaction_price * change, 0)) AS total_value_bought,
               sum(if(change < 0, transaction_price * change, 0)) AS total_value_sold,
               sum(transaction_price * change) AS net_value_flow,
               count(*) AS total_transactions_count
        FROM {trades} GROUP BY symbol, transaction_date"""
    return silver_insider.sparkSession.sql(query, trades=silver_insider)


def insider_signals(silver_insider: DataFrame) -> DataFrame:
    """Daily totals with gaps, five-activity-day totals, running totals and flags.

    The windows run on one row per symbol and day, so a hot symbol is bounded by the calendar.
    """
    average = safe_divide(
        "cast(rolling_5_day_net_shares_flow AS DECIMAL(20,0))", "_rolling_count"
    )
    query = f"""
        WITH framed AS (
            SELECT * EXCEPT (total_value_bought, total_value_sold),
                   lag(transaction_date) OVER ordered AS previous_activity_date,
                   lag(net_shares_flow) OVER ordered AS previous_day_net_shares_flow,
                   sum(net_shares_flow) OVER rolling AS rolling_5_day_net_shares_flow,
                   sum(net_value_flow) OVER rolling AS rolling_5_day_net_value_flow,
                   count(net_shares_flow) OVER rolling AS _rolling_count,
                   sum(distinct_insiders_active) OVER rolling AS rolling_5_day_active_insiders,
                   sum(total_transactions_count) OVER rolling AS rolling_5_day_transaction_count,
                   sum(net_shares_flow) OVER running AS cumulative_net_shares_flow,
                   sum(net_value_flow) OVER running AS cumulative_net_value_flow,
                   sum(total_transactions_count) OVER running AS cumulative_transaction_count
            FROM {{days}} {day_windows("symbol", "transaction_date")}),
        gaps AS (
            SELECT *, datediff(transaction_date, previous_activity_date) AS days_since_last_activity
            FROM framed)
        SELECT symbol, transaction_date, distinct_insiders_active, total_shares_bought,
               total_shares_sold, net_shares_flow, net_value_flow, total_transactions_count,
               previous_activity_date, days_since_last_activity, previous_day_net_shares_flow,
               net_shares_flow - previous_day_net_shares_flow AS change_in_net_shares_flow,
               rolling_5_day_net_shares_flow, rolling_5_day_net_value_flow,
               {average} AS rolling_5_day_avg_net_shares,
               rolling_5_day_active_insiders, rolling_5_day_transaction_count,
               cumulative_net_shares_flow, cumulative_net_value_flow, cumulative_transaction_count,
               {sign_flag("rolling_5_day_net_shares_flow")} AS rolling_5_day_sentiment,
               if(days_since_last_activity <= {CLUSTER_DAYS}, 1, 0) AS is_activity_cluster
        FROM gaps"""
    return silver_insider.sparkSession.sql(query, days=daily_insider(silver_insider))
