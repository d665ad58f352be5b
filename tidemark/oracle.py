"""The same results in plain SQL over the same tables, written without the library.

Rounded quotients are computed in whole numbers (half away from zero), so that they do not
depend on how an engine divides decimals.
"""

from __future__ import annotations


def _half_away(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded to a whole number, halves away from zero."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0)))"


def _hundredths(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded to two places, as a double."""
    return f"CAST({_half_away(f'100 * ({numerator})', denominator)} AS DOUBLE) / 100"


def _money(ten_thousandths: str) -> str:
    return f"CAST({ten_thousandths} AS DOUBLE) / 10000"


# Each step may read the steps before it.
STEPS = {
    "lines": """
        SELECT upper(replace(p_brand, 'Brand#', 'tk')) AS ticket, CAST(l_shipdate AS DATE) AS day,
               (CAST(round(l_extendedprice * 100) AS BIGINT) * 100) // CAST(l_quantity AS BIGINT) AS price,
               CAST(round(l_quantity) AS BIGINT) AS size, l_orderkey, l_linenumber, l_suppkey,
               l_extendedprice, l_quantity, l_returnflag, l_linestatus
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "bars": """
        SELECT ticket, day,
               arg_max(price, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity)) AS close,
               max(price) AS high, min(price) AS low,
               arg_min(price, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity)) AS open,
               CAST(sum(size) AS BIGINT) AS volume
        FROM lines GROUP BY ticket, day""",
    "articles": """
        SELECT event_id, event_type, ts,
               'https://news.example.com/' || event_id AS url,
               'brand#' || (user_id % 27) AS company,
               ts - INTERVAL '9496' DAY AS published_at,
               replace(CAST(ts - INTERVAL '9496' DAY AS VARCHAR), ' ', 'T') || 'Z' AS published_text,
               props AS title,
               CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 10 THEN NULL ELSE props END AS description,
               CASE WHEN event_type IN ('purchase', 'signup') THEN 'good'
                    WHEN event_type = 'error' THEN 'bad' ELSE 'neutral' END AS sentiment
        FROM events""",
    "news_keyed": """
        SELECT md5(company || '_' || title || '_' || published_text) AS hash, * FROM articles""",
    "bronze_news": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY hash ORDER BY event_id) AS copy_no FROM news_keyed)
        WHERE copy_no = 1""",
    "trades": """
        SELECT ticket AS symbol, c_name AS name, c_mktsegment AS segment, o_orderpriority AS priority,
               size AS share,
               CASE l_returnflag WHEN 'R' THEN -size WHEN 'N' THEN size ELSE 0 END AS change,
               CAST(o_orderdate AS DATE) + 2 AS filing_date, CAST(o_orderdate AS DATE) AS transaction_date,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_linestatus AS code, lines.*
        FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "insider_keyed": """
        SELECT md5(symbol || '_' || name || '_' || CAST(transaction_date AS VARCHAR) || '_' || change
                   || '_' || share) AS hash, *
        FROM trades""",
    "bronze_insider": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY hash ORDER BY l_orderkey, l_linenumber, l_suppkey,
                       l_extendedprice, l_quantity, l_linestatus) AS copy_no FROM insider_keyed)
        WHERE copy_no = 1""",
    "ticker_map": """
        SELECT DISTINCT lower(replace(p_brand, 'Brand#', 'tk')) AS ticket, p_brand AS company FROM part""",
    "silver_news": """
        SELECT n.*, upper(m.ticket) AS ticket
        FROM bronze_news n LEFT JOIN ticker_map m ON upper(n.company) = upper(m.company)
        WHERE n.description IS NOT NULL""",
    "price_windows": """
        SELECT ticket, day, close, low, volume,
               lag(close) OVER w AS close_before, lag(volume) OVER w AS volume_before,
               max(close) OVER f AS max5, min(close) OVER f AS min5, min(low) OVER f AS min_low5,
               max(volume) OVER f AS max_volume5, sum(close) OVER f AS sum5, count(close) OVER f AS count5,
               sum(volume) OVER f AS volume_sum5,
               stddev_samp(CAST(close AS DOUBLE) / 10000) OVER f AS deviation5
        FROM bars
        WINDOW w AS (PARTITION BY ticket ORDER BY day),
               f AS (PARTITION BY ticket ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "gold_price": f"""
        SELECT ticket, day AS trading_date, {_money('close')} AS close_price, {_money('low')} AS low_price,
               volume AS trade_volume, {_money('close_before')} AS close_price_yesterday,
               {_money('(close - close_before)')} AS price_change_1d,
               {_hundredths('100 * (close - close_before)', 'close_before')} AS price_change_pct_1d,
               volume_before AS volume_1d, volume - volume_before AS volume_change_1d,
               {_hundredths('sum5', '10000 * count5')} AS ma5_close_price,
               CAST({_half_away('volume_sum5', 'count5')} AS DOUBLE) AS ma5_volume,
               {_money('max5')} AS max_5d_close_price, {_money('min5')} AS min_5d_close_price,
               {_money('min_low5')} AS min_5d_low_price, max_volume5 AS max_5d_volume,
               {_hundredths('max5 - min5', '10000')} AS price_range_5d,
               {_hundredths('100 * (close - min5)', 'max5 - min5')} AS price_percentile_5d,
               round(deviation5, 2) AS stddev_5d_close_price,
               {_hundredths('close * count5 - sum5', '10000 * count5')} AS distance_from_ma5,
               {_hundredths('100 * (close * count5 - sum5)', 'sum5')} AS distance_pct_from_ma5,
               CASE WHEN close > close_before THEN 1 WHEN close < close_before THEN -1 ELSE 0 END
                   AS price_direction_1d
        FROM price_windows""",
    "news_days": """
        SELECT ticket, CAST(published_at AS DATE) AS news_date, count(*) AS n,
               count(*) FILTER (sentiment = 'good') AS good, count(*) FILTER (sentiment = 'bad') AS bad,
               count(*) FILTER (sentiment = 'neutral') AS neutral
        FROM silver_news GROUP BY 1, 2""",
    "gold_news": f"""
        SELECT ticket, news_date, n AS daily_news_count, good AS daily_good_news_count,
               bad AS daily_bad_news_count, neutral AS daily_neutral_news_count,
               {_hundredths('100 * good', 'n')} AS daily_good_news_pct,
               {_hundredths('100 * bad', 'n')} AS daily_bad_news_pct,
               {_hundredths('100 * neutral', 'n')} AS daily_neutral_news_pct,
               CAST(sum(n) OVER f AS BIGINT) AS rolling_5d_news_count,
               CAST(sum(good) OVER f AS BIGINT) AS rolling_5d_good_news_count,
               CAST(sum(bad) OVER f AS BIGINT) AS rolling_5d_bad_news_count,
               CAST(sum(neutral) OVER f AS BIGINT) AS rolling_5d_neutral_news_count,
               good - bad AS daily_sentiment_score,
               CAST(sum(good - bad) OVER f AS BIGINT) AS rolling_5d_sentiment_score
        FROM news_days
        WINDOW f AS (PARTITION BY ticket ORDER BY news_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "insider_days": """
        SELECT symbol, transaction_date, count(DISTINCT name) AS insiders,
               CAST(sum(CASE WHEN change > 0 THEN change ELSE 0 END) AS BIGINT) AS bought,
               CAST(sum(CASE WHEN change < 0 THEN change ELSE 0 END) AS BIGINT) AS sold,
               CAST(sum(change) AS BIGINT) AS net,
               sum(CASE WHEN change > 0 THEN cents * change ELSE 0 END) AS bought_cents,
               sum(CASE WHEN change < 0 THEN cents * change ELSE 0 END) AS sold_cents,
               sum(cents * change) AS net_cents, count(*) AS trades
        FROM bronze_insider GROUP BY 1, 2""",
    "clusters": """
        SELECT symbol, min(transaction_date) AS session_start, max(transaction_date) AS session_end,
               count(*) AS active_days, CAST(sum(trades) AS BIGINT) AS transactions, CAST(sum(net) AS BIGINT) AS net_shares_flow
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY symbol ORDER BY transaction_date) AS island
              FROM (SELECT *, CASE WHEN transaction_date - lag(transaction_date) OVER (
                                  PARTITION BY symbol ORDER BY transaction_date) <= 3 THEN 0 ELSE 1 END AS fresh
                    FROM insider_days))
        GROUP BY symbol, island""",
    "gold_insider": """
        SELECT symbol, transaction_date, insiders AS distinct_insiders_active, bought AS total_shares_bought,
               sold AS total_shares_sold, net AS net_shares_flow,
               CAST(net_cents AS DOUBLE) / 100 AS net_value_flow, trades AS total_transactions_count,
               lag(transaction_date) OVER w AS previous_activity_date,
               CAST(transaction_date - lag(transaction_date) OVER w AS INTEGER) AS days_since_last_activity,
               lag(net) OVER w AS previous_day_net_shares_flow,
               net - lag(net) OVER w AS change_in_net_shares_flow,
               CAST(sum(net) OVER f AS BIGINT) AS rolling_5_day_net_shares_flow,
               CAST(sum(net_cents) OVER f AS DOUBLE) / 100 AS rolling_5_day_net_value_flow,
               round(CAST(sum(net) OVER f AS DOUBLE) / count(net) OVER f, 6) AS rolling_5_day_avg_net_shares,
               CAST(sum(insiders) OVER f AS BIGINT) AS rolling_5_day_active_insiders,
               CAST(sum(trades) OVER f AS BIGINT) AS rolling_5_day_transaction_count,
               CAST(sum(net) OVER e AS BIGINT) AS cumulative_net_shares_flow,
               CAST(sum(net_cents) OVER e AS DOUBLE) / 100 AS cumulative_net_value_flow,
               CAST(sum(trades) OVER e AS BIGINT) AS cumulative_transaction_count,
               CAST(sign(sum(net) OVER f) AS INTEGER) AS rolling_5_day_sentiment,
               CASE WHEN transaction_date - lag(transaction_date) OVER w <= 3 THEN 1 ELSE 0 END
                   AS is_activity_cluster
        FROM insider_days
        WINDOW w AS (PARTITION BY symbol ORDER BY transaction_date),
               f AS (PARTITION BY symbol ORDER BY transaction_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
               e AS (PARTITION BY symbol ORDER BY transaction_date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "master": """
        SELECT p.*, n.* EXCLUDE (ticket, daily_sentiment_score), i.* EXCLUDE (symbol, net_value_flow),
               coalesce(n.daily_sentiment_score, 0) AS daily_sentiment_score,
               coalesce(i.net_value_flow, 0) AS net_value_flow,
               abs(coalesce(n.daily_sentiment_score, 0)) AS sentiment_intensity
        FROM gold_price p
        LEFT JOIN gold_news n ON p.ticket = n.ticket AND p.trading_date = n.news_date
        LEFT JOIN gold_insider i ON p.ticket = i.symbol AND p.trading_date = i.transaction_date""",
    "target": """
        SELECT ticket FROM bars GROUP BY ticket ORDER BY ticket = 'META' DESC, count(*) DESC, ticket LIMIT 1""",
    "target_rows": """
        SELECT * FROM master WHERE ticket IN (SELECT ticket FROM target)""",
    "fences": """
        SELECT *, round(q1 - 1.5::DOUBLE * (q3 - q1), 9) AS low_fence,
               round(q3 + 1.5::DOUBLE * (q3 - q1), 9) AS high_fence
        FROM (
            SELECT sentiment_intensity, count(*) AS row_count,
                   quantile_cont(CAST(price_change_pct_1d AS DOUBLE), 0.25) AS q1,
                   quantile_cont(CAST(price_change_pct_1d AS DOUBLE), 0.5) AS median,
                   quantile_cont(CAST(price_change_pct_1d AS DOUBLE), 0.75) AS q3
            FROM master WHERE price_change_pct_1d IS NOT NULL GROUP BY 1)""",
}

PRICE_KEY = "ticket, trading_date"
NEWS_KEY = "ticket, news_date"
INSIDER_KEY = "symbol, transaction_date"
BAR_COLUMNS = (
    "ticket, CAST(day AS TIMESTAMP) AS date, "
    + ", ".join(f"{_money(c)} AS {c}" for c in ("close", "high", "low", "open"))
    + ", volume"
)
QUOTE_COLUMNS = (
    "ticket, CAST(day AS TIMESTAMP) AS date, "
    + ", ".join(f"{_money('price')} AS {c}" for c in ("close", "high", "low", "open"))
    + ", size AS volume"
)
LINE_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity"
FACTORS = (
    "close_price", "volume_1d", "daily_sentiment_score", "net_value_flow", "price_change_pct_1d",
)


def _with(last: str, *steps: str) -> str:
    """The named steps and all that they read, in order, before the last SELECT."""
    needed: set[str] = set()

    def need(name: str) -> None:
        if name not in needed:
            needed.add(name)
            words = set(STEPS[name].replace("(", " ").replace(")", " ").split())
            for other in STEPS:
                if other != name and other in words:
                    need(other)

    for step in steps:
        need(step)
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in STEPS.items() if name in needed)
    return f"WITH {ctes}\n{last}" if ctes else last


def _upserted(columns: str, source: str, key: str, earlier: str, order: str) -> str:
    """First write wins over two batches: every row of the earlier batch precedes the later."""
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY hash ORDER BY CASE WHEN {earlier} THEN 0 ELSE 1 END, {order}) AS copy_no
            FROM (SELECT {key} AS hash, * FROM {source}))
        WHERE copy_no = 1"""


def _pearson(x: str, y: str) -> str:
    xs = f"CAST(CASE WHEN {y} IS NOT NULL THEN {x} END AS DOUBLE)"
    ys = f"CAST(CASE WHEN {x} IS NOT NULL THEN {y} END AS DOUBLE)"
    return f"""CASE WHEN min({xs}) < max({xs}) AND min({ys}) < max({ys})
        THEN round(corr({xs}, {ys}), 6) END"""


def _answer(text: str, good: tuple[str, ...], bad: tuple[str, ...]) -> str:
    words = f"list_distinct(regexp_split_to_array(lower({text}), '[^a-z]+'))"

    def hits(listed: tuple[str, ...]) -> str:
        return f"len(list_intersect({words}, [{', '.join(repr(w) for w in listed)}]))"

    return f"""CASE WHEN {hits(good)} > {hits(bad)} THEN 'good'
                    WHEN {hits(good)} < {hits(bad)} THEN 'bad' ELSE 'neutral' END"""


def _null_counts(table: str, label: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failures "
        f"FROM {table}"
        for c in columns
    )


def _duplicates(table: str, label: str, first: str, second: str) -> str:
    return f"""SELECT '{label}' AS table_name, {first} || '-' || CAST({second} AS VARCHAR) AS key_text,
                      count(*) AS row_count
               FROM {table} WHERE {first} IS NOT NULL AND {second} IS NOT NULL
               GROUP BY 2 HAVING count(*) > 1"""


def _null_keys(table: str, label: str, first: str, second: str) -> str:
    return f"""SELECT '{label}' AS table_name, {first} AS key_ticket, {second} AS key_date
               FROM {table} WHERE {first} IS NULL OR {second} IS NULL"""


ORACLE: dict[str, str] = {
    # Bronze
    "bronze_stocks_scan": _with(f"SELECT {BAR_COLUMNS} FROM bars", "bars"),
    "bronze_wide_to_long": _with(f"SELECT {BAR_COLUMNS} FROM bars", "bars"),
    "universe_filter": _with(
        f"SELECT {BAR_COLUMNS} FROM bars WHERE ticket IN ('TK1', 'TK2', 'TK3', 'TK4')", "bars"
    ),
    "lookback_period": _with(
        f"""SELECT ticket, CAST(day AS TIMESTAMP) AS date, {_money('price')} AS close, size AS volume
            FROM (SELECT *, dense_rank() OVER (PARTITION BY ticket ORDER BY day DESC) AS session_no FROM lines)
            WHERE session_no <= 5""",
        "lines",
    ),
    "news_payload_flatten": _with(
        """SELECT url, company, published_text AS "publishedAt", title, description
           FROM articles WHERE event_type IN ('view', 'purchase')
           UNION ALL
           SELECT url, company, published_text, 'Follow-up: ' || title, description
           FROM articles WHERE event_type = 'purchase'""",
        "articles",
    ),
    "news_predicates": """
        SELECT event_id, url, ts AS published_at
        FROM events JOIN pages ON user_id = page_id
        WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
          AND regexp_extract(url, '^[a-z]+://[^/]+/([a-z]{2})/', 1) = 'en'
          AND regexp_matches(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '(^|\\.)example\\.(com|org)$')
          AND contains(lower(html), 'reti')""",
    "news_top30": _with(
        """SELECT hash, company, published_at, title FROM (
               SELECT *, row_number() OVER (PARTITION BY company ORDER BY published_at DESC, hash) AS place
               FROM news_keyed)
           WHERE place <= 30""",
        "news_keyed",
    ),
    "news_pages": _with(
        """SELECT hash, company, any_value(published_at) AS published_at FROM (
               SELECT *, row_number() OVER (PARTITION BY company, hour, pull ORDER BY published_at DESC, hash) AS place
               FROM (SELECT DISTINCT hash, company, published_at, date_trunc('hour', ts) AS hour, pull
                     FROM news_keyed, (VALUES (0), (1)) AS pulls(pull) WHERE event_id % 3 <> pull))
           WHERE place <= 30 GROUP BY 1, 2""",
        "news_keyed",
    ),
    "insider_payload_flatten": _with(
        """SELECT ticket AS symbol, 'Supplier ' || l_suppkey AS name, size AS share, change,
                  CAST(day + 2 AS VARCHAR) AS "filingDate", CAST(day AS VARCHAR) AS "transactionDate",
                  l_extendedprice AS "transactionPrice", l_linestatus AS "transactionCode"
           FROM (SELECT *, unnest(CASE l_returnflag WHEN 'R' THEN [-size, size] WHEN 'N' THEN [size] ELSE [] END)
                        AS change FROM lines)""",
        "lines",
    ),
    "insider_date_window": _with(
        """SELECT md5(symbol || '_' || name || '_' || CAST(transaction_date AS VARCHAR) || '_' || change
                      || '_' || share) AS hash, symbol, name, share, change, filing_date, transaction_date,
                  CAST(cents AS DOUBLE) / 100 AS transaction_price, code AS transaction_code
           FROM trades WHERE transaction_date = DATE '1998-06-15'""",
        "trades",
    ),
    "bronze_union_all": """
        SELECT o_orderkey, o_orderstatus, o_custkey,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority
        FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')""",
    "payload_reject_split": _with(
        """SELECT event_id, company, CASE event_type WHEN 'error' THEN 'corrupt' WHEN 'signup' THEN 'not_ok'
                  WHEN 'click' THEN 'empty' ELSE 'good' END AS outcome
           FROM articles""",
        "articles",
    ),
    "stock_hash": _with(
        """SELECT ticket, CAST(day AS TIMESTAMP) AS date,
                  md5(ticket || '_' || strftime(day, '%Y-%m-%d %H:%M:%S')) AS hash FROM bars""",
        "bars",
    ),
    "news_hash": _with(
        """SELECT event_id, hash,
                  md5(company || '_' || coalesce(description, 'None') || '_' || published_text)
                      AS description_hash
           FROM news_keyed""",
        "news_keyed",
    ),
    "insider_hash": _with(
        "SELECT hash, symbol, name, transaction_date, change, share FROM insider_keyed", "insider_keyed"
    ),
    "bronze_upsert_stocks": _with(
        _upserted(
            f"hash, {QUOTE_COLUMNS}",
            "lines",
            "md5(ticket || '_' || strftime(day, '%Y-%m-%d %H:%M:%S'))",
            "l_linestatus = 'F'",
            LINE_ORDER,
        ),
        "lines",
    ),
    "bronze_upsert_news": _with(
        _upserted(
            "hash, company, title, description, url, "
            "CAST(CAST(published_at AS DATE) AS TIMESTAMP) AS published_at, sentiment",
            "articles",
            "md5(company || '_' || title || '_' || CAST(CAST(published_at AS DATE) AS VARCHAR))",
            "event_type IN ('purchase', 'view')",
            "event_id",
        ),
        "articles",
    ),
    "bronze_upsert_insider": _with(
        _upserted(
            "hash, symbol, segment AS name, share, change, filing_date, transaction_date, "
            "CAST(cents AS DOUBLE) / 100 AS transaction_price, code AS transaction_code",
            "trades",
            "md5(symbol || '_' || segment || '_' || CAST(transaction_date AS VARCHAR) || '_' || change"
            " || '_' || share)",
            "l_linestatus = 'F'",
            LINE_ORDER,
        ),
        "trades",
    ),
    "bronze_constraints_news": _with(
        """SELECT event_id, 'title is null' AS broken_rule FROM articles WHERE description IS NULL
           UNION ALL
           SELECT event_id, 'sentiment longer than 10' FROM articles WHERE length(event_type || ' news') > 10""",
        "articles",
    ),
    "bronze_constraints_insider": _with(
        f"""SELECT md5(symbol || '_' || name || '_' || CAST(transaction_date AS VARCHAR) || '_' || change
                      || '_' || share) AS hash, priority AS transaction_code,
                  CAST({_half_away('cents * 10000 + 5000 - l_linenumber % 2', '10000')} AS DOUBLE) / 100 AS transaction_price,
                  'transaction_code longer than 10' AS broken_rule
           FROM trades WHERE length(priority) > 10""",
        "trades",
    ),
    "strict_batch_refusal": _with(
        """SELECT company || '/' || CAST(CAST(published_at AS DATE) AS VARCHAR) AS batch, event_id FROM articles
           WHERE title IS NOT NULL AND (company, CAST(published_at AS DATE)) NOT IN (
               SELECT (company, CAST(published_at AS DATE)) FROM articles
               WHERE title IS NOT NULL AND length(event_type || ' news') > 10)""",
        "articles",
    ),
    # Of a page's two articles the follow-up differs in its title; a missing text gets no label.
    "news_run_labels": _with(
        """SELECT hash, any_value(company) AS company, any_value(label) AS sentiment,
                  CASE WHEN any_value(length(label)) > 10 THEN 'sentiment longer than 10' ELSE 'stored' END AS outcome
           FROM (SELECT md5(company || '_' || a.title || '_' || published_text) AS hash, company,
                        CASE CAST(json_extract(description, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'bad'
                             WHEN 2 THEN 'extremely positive' ELSE 'neutral' END AS label
                 FROM articles, (SELECT unnest(['', 'Follow-up: ']) AS prefix), LATERAL (SELECT prefix || articles.title AS title) a
                 WHERE event_type = 'purchase' OR event_type = 'view' AND prefix = '')
           GROUP BY hash""",
        "articles",
    ),
    "load_stamps": _with(
        """SELECT 'bronze' AS layer, count(*) AS row_count, count(*) AS stamped, 1 AS stamps, count(*) AS unchanged FROM bars
           UNION ALL SELECT 'silver', count(*), count(*), 1, count(*) FROM bars""",
        "bars",
    ),
    "insider_date_parse": _with(
        """SELECT l_orderkey, l_linenumber, CASE WHEN change <> 0 THEN filing_date END AS filing_date,
                  transaction_date
           FROM trades""",
        "trades",
    ),
    "sentiment_label": f"""
        SELECT doc_id, {_answer('text', ('is', 'of', 'with', 'there'), ('and', 'to', 'was', 'what'))} AS sentiment
        FROM documents""",
    "sentiment_classifier": """
        SELECT doc_id, CASE length(text) % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'bad' ELSE 'neutral' END AS sentiment
        FROM documents""",
    "sentiment_normalise": """
        SELECT event_id, CASE event_type WHEN 'purchase' THEN 'good' WHEN 'error' THEN 'bad'
                         WHEN 'signup' THEN 'mixed' ELSE 'neutral' END AS sentiment
        FROM events""",
    "csv_sink_roundtrip": _with(f"SELECT {BAR_COLUMNS} FROM bars", "bars"),
    "news_counts_by_company": _with(
        "SELECT company, count(*) AS row_count FROM bronze_news GROUP BY 1 ORDER BY 2 DESC, 1", "bronze_news"
    ),
    "news_counts_by_sentiment": _with(
        "SELECT sentiment, count(*) AS row_count FROM bronze_news GROUP BY 1 ORDER BY 2 DESC, 1", "bronze_news"
    ),
    # Silver
    "silver_stocks": _with(
        f"""SELECT md5(ticket || '_' || strftime(day, '%Y-%m-%d %H:%M:%S')) AS stock_hash, ticket,
                  day AS trading_date, {_money('close')} AS close_price, {_money('high')} AS high_price,
                  {_money('low')} AS low_price, {_money('open')} AS open_price, volume AS trade_volume
           FROM bars""",
        "bars",
    ),
    "silver_insider": _with(
        """SELECT hash AS insider_transactions_hash, symbol, name, share, change, filing_date, transaction_date,
                  CAST(cents AS DOUBLE) / 100 AS transaction_price, code AS transaction_code
           FROM bronze_insider""",
        "bronze_insider",
    ),
    "silver_news": _with(
        """SELECT hash AS hash_news, company, ticket, title AS news_titel, description AS news_description,
                  url AS news_url, sentiment AS news_sentiment, published_at
           FROM silver_news""",
        "silver_news",
    ),
    "silver_ticker_map": _with("SELECT upper(ticket) AS ticket, company FROM ticker_map", "ticker_map"),
    "build_layers": _with(
        """SELECT 'silver' AS layer, 'stocks' AS table_name, count(*) AS row_count FROM bars
           UNION ALL SELECT 'silver', 'news', count(*) FROM silver_news
           UNION ALL SELECT 'silver', 'insider_transactions_stocks', count(*) FROM bronze_insider
           UNION ALL SELECT 'gold', 'stock_transations', count(*) FROM bars
           UNION ALL SELECT 'gold', 'stock_news', count(*) FROM news_days
           UNION ALL SELECT 'gold', 'stock_insider_transations', count(*) FROM insider_days""",
        "bars", "silver_news", "bronze_insider", "news_days", "insider_days",
    ),
    # Gold
    "gold_price_all": _with("SELECT * FROM gold_price", "gold_price"),
    "gold_price_change": _with(
        f"SELECT {PRICE_KEY}, close_price, close_price_yesterday, price_change_1d, price_change_pct_1d "
        "FROM gold_price",
        "gold_price",
    ),
    "gold_volume_change": _with(
        f"SELECT {PRICE_KEY}, trade_volume, volume_1d, volume_change_1d FROM gold_price", "gold_price"
    ),
    "gold_moving_avg": _with(
        f"SELECT {PRICE_KEY}, ma5_close_price, ma5_volume FROM gold_price", "gold_price"
    ),
    "gold_rolling_extrema": _with(
        f"SELECT {PRICE_KEY}, max_5d_close_price, min_5d_close_price, min_5d_low_price, max_5d_volume "
        "FROM gold_price",
        "gold_price",
    ),
    "gold_range_position": _with(
        f"SELECT {PRICE_KEY}, price_range_5d, price_percentile_5d FROM gold_price", "gold_price"
    ),
    "gold_volatility": _with(
        f"SELECT {PRICE_KEY}, stddev_5d_close_price FROM gold_price", "gold_price"
    ),
    "gold_ma_distance": _with(
        f"SELECT {PRICE_KEY}, distance_from_ma5, distance_pct_from_ma5 FROM gold_price", "gold_price"
    ),
    "gold_direction": _with(f"SELECT {PRICE_KEY}, price_direction_1d FROM gold_price", "gold_price"),
    "gold_news_daily": _with(
        f"SELECT {NEWS_KEY}, daily_news_count, daily_good_news_count, daily_bad_news_count, "
        "daily_neutral_news_count FROM gold_news",
        "gold_news",
    ),
    "gold_news_pct": _with(
        f"SELECT {NEWS_KEY}, daily_good_news_pct, daily_bad_news_pct, daily_neutral_news_pct FROM gold_news",
        "gold_news",
    ),
    "gold_news_rolling": _with(
        f"SELECT {NEWS_KEY}, rolling_5d_news_count, rolling_5d_good_news_count, rolling_5d_bad_news_count, "
        "rolling_5d_neutral_news_count FROM gold_news",
        "gold_news",
    ),
    "gold_news_score": _with(
        f"SELECT {NEWS_KEY}, daily_sentiment_score, rolling_5d_sentiment_score FROM gold_news", "gold_news"
    ),
    "gold_insider_daily": _with(
        f"SELECT {INSIDER_KEY}, distinct_insiders_active, total_shares_bought, total_shares_sold, "
        "net_shares_flow, net_value_flow, total_transactions_count FROM gold_insider",
        "gold_insider",
    ),
    "insider_value_split": _with(
        f"SELECT {INSIDER_KEY}, CAST(bought_cents AS DOUBLE) / 100 AS total_value_bought, "
        "CAST(sold_cents AS DOUBLE) / 100 AS total_value_sold FROM insider_days",
        "insider_days",
    ),
    "gold_insider_gaps": _with(
        f"SELECT {INSIDER_KEY}, previous_activity_date, days_since_last_activity, "
        "previous_day_net_shares_flow, change_in_net_shares_flow FROM gold_insider",
        "gold_insider",
    ),
    "gold_insider_rolling": _with(
        f"SELECT {INSIDER_KEY}, rolling_5_day_net_shares_flow, rolling_5_day_net_value_flow, "
        "rolling_5_day_avg_net_shares, rolling_5_day_active_insiders, rolling_5_day_transaction_count "
        "FROM gold_insider",
        "gold_insider",
    ),
    "gold_insider_cumulative": _with(
        f"SELECT {INSIDER_KEY}, cumulative_net_shares_flow, cumulative_net_value_flow, "
        "cumulative_transaction_count FROM gold_insider",
        "gold_insider",
    ),
    "gold_insider_signal": _with(
        f"SELECT {INSIDER_KEY}, rolling_5_day_sentiment, is_activity_cluster FROM gold_insider", "gold_insider"
    ),
    # Quality
    "gold_price_incremental": _with("SELECT * FROM gold_price", "gold_price"),
    "gold_news_reconciled": _with(
        """, fewer AS (
               SELECT ticket, CAST(published_at AS DATE) AS news_date, count(*) AS n,
                      count(*) FILTER (sentiment = 'good') AS good, count(*) FILTER (sentiment = 'bad') AS bad,
                      count(*) FILTER (sentiment = 'neutral') AS neutral
               FROM (SELECT n.*, upper(m.ticket) AS ticket
                     FROM (SELECT * FROM news_keyed WHERE event_id % 499 <> 0
                           QUALIFY row_number() OVER (PARTITION BY hash ORDER BY event_id) = 1) n
                     LEFT JOIN ticker_map m ON upper(n.company) = upper(m.company) WHERE n.description IS NOT NULL)
               GROUP BY 1, 2)
           SELECT ticket, news_date, n AS daily_news_count, good AS daily_good_news_count, bad AS daily_bad_news_count,
                  neutral AS daily_neutral_news_count, only_in, 1 AS copies
           FROM (SELECT *, 'whole' AS only_in FROM (SELECT * FROM news_days EXCEPT ALL SELECT * FROM fewer)
                 UNION ALL SELECT *, 'partial' FROM (SELECT * FROM fewer EXCEPT ALL SELECT * FROM news_days))""",
        "news_days",
    ),
    "dq_unique": _with(
        " UNION ALL ".join(
            [
                _duplicates("gold_insider", "stock_insider_transations", "symbol", "transaction_date"),
                _duplicates("gold_news", "stock_news", "ticket", "news_date"),
                _duplicates("gold_price", "stock_transations", "ticket", "trading_date"),
            ]
        ),
        "gold_insider", "gold_news", "gold_price",
    ),
    "dq_unique_quotes": _with(
        _duplicates("lines", "stock_transations", "ticket", "day"), "lines"
    ),
    "dq_not_null_key": _with(
        " UNION ALL ".join(
            [
                _null_keys("gold_insider", "stock_insider_transations", "symbol", "transaction_date"),
                _null_keys("gold_news", "stock_news", "ticket", "news_date"),
                _null_keys("gold_price", "stock_transations", "ticket", "trading_date"),
            ]
        ),
        "gold_insider", "gold_news", "gold_price",
    ),
    "dq_not_null_columns": _with(
        " UNION ALL ".join(
            [
                _null_counts(
                    "gold_insider", "stock_insider_transations",
                    ("symbol", "transaction_date", "distinct_insiders_active", "total_transactions_count"),
                ),
                _null_counts("gold_news", "stock_news", ("ticket", "news_date", "daily_news_count")),
                _null_counts(
                    "gold_price", "stock_transations", ("ticket", "trading_date", "close_price", "trade_volume")
                ),
            ]
        ),
        "gold_insider", "gold_news", "gold_price",
    ),
    "dq_accepted_values": _with(
        """SELECT 'stock_insider_transations' AS table_name, 'rolling_5_day_sentiment' AS column_name,
                  count(*) FILTER (rolling_5_day_sentiment NOT IN (1, -1, 0)) AS failures FROM gold_insider
           UNION ALL SELECT 'stock_insider_transations', 'is_activity_cluster',
                  count(*) FILTER (is_activity_cluster NOT IN (0, 1)) FROM gold_insider
           UNION ALL SELECT 'stock_transations', 'price_direction_1d',
                  count(*) FILTER (price_direction_1d NOT IN (1, -1, 0)) FROM gold_price""",
        "gold_insider", "gold_price",
    ),
    # Analysis
    "master_merge": _with("SELECT * FROM master", "master"),
    "target_ticker": _with("SELECT * FROM target", "target"),
    "series_price_sentiment": _with(
        "SELECT ticket, trading_date, close_price, daily_sentiment_score FROM target_rows ORDER BY trading_date",
        "target_rows",
    ),
    "series_price_insider": _with(
        """SELECT ticket, trading_date, close_price, net_value_flow,
                  CASE WHEN net_value_flow > 0 THEN 'Buy' ELSE 'Sell' END AS flow_side
           FROM target_rows ORDER BY trading_date""",
        "target_rows",
    ),
    "correlation_matrix": _with(
        " UNION ALL ".join(
            f"SELECT '{a}' AS factor_x, '{b}' AS factor_y, {_pearson(a, b)} AS r FROM target_rows"
            for a in FACTORS
            for b in FACTORS
        ),
        "target_rows",
    ),
    "insider_totals": _with(
        """SELECT symbol AS ticket, CAST(sum(bought) AS BIGINT) AS total_shares_bought,
                  CAST(sum(sold) AS BIGINT) AS total_shares_sold,
                  CAST(abs(sum(sold)) AS BIGINT) AS total_shares_sold_abs
           FROM insider_days GROUP BY 1 ORDER BY 1""",
        "insider_days",
    ),
    "box_stats": _with(
        """SELECT sentiment_intensity, any_value(row_count) AS row_count, round(any_value(q1), 6) AS q1,
                  round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
                  round(least(min(change) FILTER (change >= low_fence), any_value(q1)), 6) AS whisker_low,
                  round(greatest(max(change) FILTER (change <= high_fence), any_value(q3)), 6) AS whisker_high,
                  count(*) FILTER (change < low_fence OR change > high_fence) AS outlier_count
           FROM (SELECT sentiment_intensity, CAST(price_change_pct_1d AS DOUBLE) AS change FROM master
                 WHERE price_change_pct_1d IS NOT NULL)
           JOIN fences USING (sentiment_intensity)
           GROUP BY 1""",
        "master", "fences",
    ),
    "box_outliers": _with(
        """SELECT ticket, trading_date, sentiment_intensity, price_change_pct_1d
           FROM master JOIN fences USING (sentiment_intensity)
           WHERE price_change_pct_1d < low_fence OR price_change_pct_1d > high_fence""",
        "master", "fences",
    ),
    "scatter_news_volume": _with(
        """SELECT ticket, trading_date, daily_news_count, volume_change_1d FROM master
           WHERE daily_news_count IS NOT NULL AND volume_change_1d IS NOT NULL""",
        "master",
    ),
    "hype_correlation": _with(
        f"""SELECT CASE WHEN grouping(ticket) = 1 THEN 'overall' ELSE 'ticker' END AS scope, ticket,
                  count(*) AS day_count, {_pearson('daily_news_count', 'trade_volume')} AS r
           FROM master WHERE daily_news_count IS NOT NULL AND trade_volume IS NOT NULL
           GROUP BY ROLLUP (ticket)""",
        "master",
    ),
    "sell_buy_ratio": _with(
        f"""SELECT symbol AS ticket, CAST(sum(bought) AS BIGINT) AS total_shares_bought,
                  CAST(abs(sum(sold)) AS BIGINT) AS total_shares_sold_abs,
                  CAST({_half_away('10000 * abs(sum(sold))', 'sum(bought)')} AS DOUBLE) / 10000 AS sell_buy_ratio
           FROM insider_days GROUP BY 1""",
        "insider_days",
    ),
    "contrarian_buys": _with(
        """SELECT symbol, transaction_date, bought AS total_shares_bought, sold AS total_shares_sold,
                  net AS net_shares_flow
           FROM insider_days WHERE bought > 0 AND net < 0""",
        "insider_days",
    ),
    "dispersion_by_intensity": _with(
        """SELECT sentiment_intensity, count(*) AS row_count,
                  round(stddev_samp(price_change_pct_1d), 6) AS change_stddev,
                  CAST(CAST(round(100 * max(price_change_pct_1d)) AS BIGINT)
                       - CAST(round(100 * min(price_change_pct_1d)) AS BIGINT) AS DOUBLE) / 100 AS change_range
           FROM master WHERE price_change_pct_1d IS NOT NULL GROUP BY 1""",
        "master",
    ),
    # Matches in time
    "news_next_session": _with(
        f"""SELECT n.hash AS hash_news, n.ticket, CAST(n.published_at AS DATE) AS news_date, b.day AS trading_date,
                  {_money('b.close')} AS close_price
           FROM (SELECT *, CAST(published_at AS DATE) AS news_day FROM silver_news) n
           ASOF LEFT JOIN bars b ON n.ticket = b.ticket AND n.news_day <= b.day""",
        "silver_news", "bars",
    ),
    "insider_last_close": _with(
        f"""SELECT i.hash AS insider_transactions_hash, i.symbol, i.transaction_date, i.change, b.day AS trading_date,
                  {_money('b.close')} AS close_price
           FROM bronze_insider i ASOF LEFT JOIN bars b ON i.symbol = b.ticket AND i.transaction_date >= b.day""",
        "bronze_insider", "bars",
    ),
    "news_per_session": _with(
        """SELECT n.ticket, b.day AS trading_date, count(*) AS news_count
           FROM (SELECT *, CAST(published_at AS DATE) AS news_day FROM silver_news) n
           ASOF JOIN bars b ON n.ticket = b.ticket AND n.news_day <= b.day GROUP BY 1, 2""",
        "silver_news", "bars",
    ),
    "price_calendar_frames": _with(
        f"""SELECT ticket, day AS trading_date, count(*) OVER w AS sessions, CAST(sum(volume) OVER w AS BIGINT) AS volume,
                  {_money('min(low) OVER w')} AS low,
                  {_hundredths('sum(close) OVER w', '10000 * count(*) OVER w')} AS mean_close
           FROM bars WINDOW w AS (PARTITION BY ticket ORDER BY day RANGE BETWEEN INTERVAL 4 DAYS PRECEDING AND CURRENT ROW)""",
        "bars",
    ),
    "quote_calendar_frames": _with(
        """SELECT ticket, day, size AS volume, l_orderkey, l_linenumber, count(*) OVER w AS recent_quotes,
                  CAST(sum(size) OVER w AS BIGINT) AS recent_volume
           FROM lines WINDOW w AS (PARTITION BY ticket ORDER BY day RANGE BETWEEN INTERVAL 4 DAYS PRECEDING AND CURRENT ROW)""",
        "lines",
    ),
    "insider_sessions": _with(
        """SELECT symbol, session_start, session_end, active_days, transactions, net_shares_flow FROM clusters""", "clusters"
    ),
    "event_study": _with(
        """SELECT p.ticket, c.session_start, c.active_days, p.trading_date,
                  CAST(p.trading_date - c.session_start AS INTEGER) AS day, p.price_change_pct_1d
           FROM gold_price p JOIN clusters c ON p.ticket = c.symbol
                AND p.trading_date BETWEEN c.session_start - 3 AND c.session_start + 3""",
        "gold_price", "clusters",
    ),
    "insider_distinct_rolling": _with(
        """SELECT d.symbol, d.transaction_date, count(DISTINCT b.name) AS distinct_values, TRUE AS estimate_within_bound
           FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY transaction_date) AS n FROM insider_days) d
           JOIN (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY transaction_date) AS n FROM insider_days) e
                ON d.symbol = e.symbol AND e.n BETWEEN d.n - 4 AND d.n
           JOIN bronze_insider b ON b.symbol = e.symbol AND b.transaction_date = e.transaction_date
           GROUP BY 1, 2""",
        "insider_days", "bronze_insider",
    ),
    # Streams: the same as the batch
    "stream_news_daily": _with(
        """SELECT ticket, news_date, n AS daily_news_count, good AS daily_good_news_count,
                  bad AS daily_bad_news_count, neutral AS daily_neutral_news_count FROM news_days""",
        "news_days",
    ),
    "stream_news_rolling": _with(
        f"""SELECT {NEWS_KEY}, rolling_5d_news_count, rolling_5d_good_news_count, rolling_5d_bad_news_count,
                  rolling_5d_neutral_news_count FROM gold_news""",
        "gold_news",
    ),
    "landed_pages_read": _with(
        """SELECT way, company, count(*) AS pages, count(*) FILTER (number % 7 = 6) AS failed,
                  CAST(coalesce(sum(n) FILTER (number % 7 <> 6), 0) AS BIGINT) AS articles
           FROM (SELECT company, event_id // 500 AS number, count(*) AS n FROM articles GROUP BY 1, 2),
                (VALUES ('batch'), ('stream')) AS ways(way)
           GROUP BY 1, 2""",
        "articles",
    ),
}
