"""DuckDB SQL for every registered query, written independently of the Spark plans.

The SQL uses the plain textbook form (row-level windows, pair joins) on purpose: it is
the specification the Spark plans are checked against.
"""

from __future__ import annotations

# Inputs -----------------------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, ts AS "timestamp",
         CASE WHEN event_type = 'click' THEN 'add_to_cart' ELSE event_type END AS event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
         CASE event_id % 6 WHEN 0 THEN 'direct' WHEN 1 THEN 'email' WHEN 2 THEN 'organic'
                           WHEN 3 THEN 'paid search' WHEN 4 THEN 'social' END AS referrer
  FROM events
)"""

ORDERS = """
ord AS (
  SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 7919) % 2592000) AS order_time,
         o_totalprice AS total_amount
  FROM orders
)"""

CATALOG = """
cat AS (
  SELECT CASE WHEN p_partkey >= 90 THEN p_partkey + 10 ELSE p_partkey END AS product_id,
         lower(trim(p_type)) AS category, p_brand AS brand, p_retailprice AS price
  FROM part
)"""

RAW_EVENTS = """
raw_ev AS (
  SELECT CASE WHEN event_id % 101 <> 0 THEN CAST(user_id AS VARCHAR) END AS customer_id,
         CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN 'n/a'
              ELSE strftime(ts, '%d-%m-%Y %H:%M') END AS "timestamp",
         ' ' || upper(CASE WHEN event_type = 'click' THEN 'add_to_cart' ELSE event_type END) AS event_type,
         CASE WHEN event_id % 109 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
         CASE event_id % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'desktop ' ELSE ' TABLET' END AS device_type,
         CASE event_id % 6 WHEN 0 THEN 'Direct' WHEN 1 THEN 'email ' WHEN 2 THEN 'Organic'
                           WHEN 3 THEN ' Paid Search' WHEN 4 THEN 'social' END AS traffic_source
  FROM events
)"""

CLEAN_EVENTS = RAW_EVENTS + """,
ev AS (
  SELECT customer_id AS user_id, try_strptime("timestamp", '%d-%m-%Y %H:%M') AS "timestamp",
         lower(trim(event_type)) AS event_type, product_id,
         lower(trim(device_type)) AS device, lower(trim(traffic_source)) AS referrer
  FROM raw_ev
  WHERE customer_id IS NOT NULL AND "timestamp" IS NOT NULL AND product_id IS NOT NULL
)"""

CLEAN_ORDERS = """
raw_ord AS (
  SELECT CASE WHEN o_orderkey % 101 <> 0 THEN o_orderkey END AS transaction_id,
         CASE WHEN o_orderkey % 103 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderkey % 107 = 0 THEN 'soon' ELSE
           strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 7919) % 2592000),
                    '%Y-%m-%d %H:%M:%S') END AS "timestamp",
         CASE WHEN o_orderkey % 109 <> 0 THEN o_totalprice END AS gross_revenue
  FROM orders
),
ord AS (
  SELECT * FROM (
    SELECT transaction_id AS order_id, customer_id AS user_id,
           try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS order_time, gross_revenue AS total_amount
    FROM raw_ord)
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND order_time IS NOT NULL
)"""

CLEAN_CATALOG = """
raw_cat AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey >= 90 THEN p_partkey + 10
              ELSE p_partkey END AS product_id,
         CASE WHEN copy = 1 THEN 'None'
              ELSE upper(p_type[1]) || lower(p_type[2:]) || ' ' END AS category,
         p_brand AS brand,
         CASE WHEN copy = 1 THEN p_retailprice + 1 ELSE p_retailprice END AS base_price
  FROM part, (VALUES (0), (1)) AS c(copy)
  WHERE copy = 0 OR p_partkey % 5 = 0
),
cat AS (
  SELECT product_id, category, brand, price FROM (
    SELECT product_id, lower(trim(category)) AS category, brand, base_price AS price,
           row_number() OVER (PARTITION BY product_id
             ORDER BY lower(trim(category)) NULLS FIRST, brand NULLS FIRST, base_price NULLS FIRST) AS rn
    FROM raw_cat WHERE product_id IS NOT NULL)
  WHERE rn = 1
)"""

# Stages -----------------------------------------------------------------------------


def sessions(gap: int) -> str:
    return f"""
lagged AS (
  SELECT *, lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp" NULLS FIRST,
             event_type NULLS FIRST, product_id NULLS FIRST, device NULLS FIRST, referrer NULLS FIRST) AS prev
  FROM ev
),
flagged AS (
  SELECT *, CASE WHEN prev IS NULL OR
      CAST(floor(epoch("timestamp")) AS BIGINT) - CAST(floor(epoch(prev)) AS BIGINT) > {gap}
      THEN 1 ELSE 0 END AS is_new
  FROM lagged
),
ses AS (
  SELECT user_id, "timestamp", event_type, product_id, device, referrer,
         user_id || '_' || CAST(CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY "timestamp" NULLS FIRST,
             event_type NULLS FIRST, product_id NULLS FIRST, device NULLS FIRST, referrer NULLS FIRST
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS VARCHAR) AS session_id
  FROM flagged
)"""


SESSIONS = sessions(1800)

FLAGS = """
flags AS (
  SELECT session_id, category, device, referrer, CAST("timestamp" AS DATE) AS date,
         max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS has_view,
         max(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS has_cart,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase
  FROM ses LEFT JOIN cat USING (product_id)
  GROUP BY ALL
)"""

COUNTS = FLAGS + """,
counts AS (
  SELECT category, device, referrer, date, CAST(sum(has_view) AS BIGINT) AS total_views,
         CAST(sum(has_cart) AS BIGINT) AS total_carts, CAST(sum(has_purchase) AS BIGINT) AS total_purchases
  FROM flags GROUP BY ALL
)"""

RATES = """
  CASE WHEN total_views > 0 THEN round(CAST(total_carts AS DOUBLE) / total_views, 4) ELSE 0.0::DOUBLE END
    AS view_to_cart_rate,
  CASE WHEN total_carts > 0 THEN round(CAST(total_purchases AS DOUBLE) / total_carts, 4) ELSE 0.0::DOUBLE END
    AS cart_to_purchase_rate,
  CASE WHEN total_views > 0 THEN round(CAST(total_purchases AS DOUBLE) / total_views, 4) ELSE 0.0::DOUBLE END
    AS overall_conversion_rate"""

FUNNEL_ONLY = COUNTS + f""",
funnel AS (SELECT *, {RATES} FROM counts)"""

FUNNEL = ",".join([EVENTS, CATALOG, SESSIONS, FUNNEL_ONLY])
RAW_FUNNEL = ",".join([CLEAN_EVENTS, CLEAN_CATALOG, SESSIONS, FUNNEL_ONLY])

DAILY_ONLY = """
daily AS (
  SELECT date, category, daily_views, daily_purchases,
         CASE WHEN daily_views > 0 THEN round(CAST(daily_purchases AS DOUBLE) / daily_views, 4)
              ELSE 0.0::DOUBLE END AS daily_conversion_rate
  FROM (SELECT date, category, CAST(sum(total_views) AS BIGINT) AS daily_views,
               CAST(sum(total_purchases) AS BIGINT) AS daily_purchases
        FROM funnel GROUP BY ALL)
)"""

# Means of 4-decimal rates, rounded half up in whole ten-thousandths: (2 * sum + n) // (2 * n).
BASELINE_ONLY = DAILY_ONLY + """,
base AS (
  SELECT date, category, daily_views, daily_purchases, daily_conversion_rate,
         CAST((2 * s + n) // (2 * n) AS DOUBLE) / 10000 AS trailing_7d_avg
  FROM (SELECT *, CAST(sum(CAST(round(daily_conversion_rate * 10000) AS BIGINT)) OVER w AS BIGINT) AS s,
               nullif(count(*) OVER w, 0) AS n
        FROM daily
        WINDOW w AS (PARTITION BY category ORDER BY date
                     RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
)"""

ANOMALY_ONLY = BASELINE_ONLY + """,
anom AS (
  SELECT *, CASE WHEN pct_change > 0 THEN 'SPIKE' ELSE 'DROP' END AS anomaly_type
  FROM (SELECT *, CASE WHEN trailing_7d_avg > 0
                       THEN round((daily_conversion_rate - trailing_7d_avg) / trailing_7d_avg * 100, 2)
                       ELSE 0.0::DOUBLE END AS pct_change
        FROM base)
  WHERE pct_change <= -50.0 OR pct_change >= 50.0
)"""

EXPLAINED = """
SELECT *, 'ALERT: [Category: ' || coalesce(category, 'unknown') || '] conversion rate on '
       || CAST(date AS VARCHAR)
       || CASE WHEN anomaly_type = 'SPIKE' THEN ' spiked by +' ELSE ' dropped by ' END
       || printf('%.2f', pct_change) || '% compared to the 7-day baseline of '
       || printf('%.4f', trailing_7d_avg) AS explanation
FROM anom"""

SCORES = """
stats AS (
  SELECT *, count(overall_conversion_rate) OVER w AS days, avg(overall_conversion_rate) OVER w AS mean,
         CAST(sum(CAST(round(overall_conversion_rate * 10000) AS BIGINT)) OVER w AS BIGINT) AS units,
         stddev_samp(overall_conversion_rate) OVER w AS dev
  FROM funnel
  WINDOW w AS (PARTITION BY category, device, referrer ORDER BY date
               RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
),
scored AS (
  SELECT category, device, referrer, date, total_views, total_carts, total_purchases, view_to_cart_rate,
         cart_to_purchase_rate, overall_conversion_rate, 
         CASE WHEN days > 0 THEN CAST((2 * units + days) // (2 * days) AS DOUBLE) / 10000 END
           AS rolling_avg_conversion,
         round(dev, 4) AS rolling_std, z_score,
         CASE WHEN z_score >= 2 THEN 'SPIKE' WHEN z_score <= -2 THEN 'DROP' ELSE 'NORMAL' END AS anomaly_flag
  FROM (SELECT *, CASE WHEN days >= 3 AND dev > 1e-9
                       THEN round((overall_conversion_rate - mean) / dev, 4) END AS z_score
        FROM stats)
),
zanom AS (SELECT * FROM scored WHERE anomaly_flag <> 'NORMAL')"""

ZSCORE = FUNNEL + "," + SCORES

TOP_ANOMALIES = ZSCORE + """,
top AS (
  SELECT * FROM zanom
  ORDER BY z_score DESC NULLS LAST, date NULLS FIRST, category NULLS FIRST, device NULLS FIRST,
           referrer NULLS FIRST
  LIMIT 50
),
export AS (
  SELECT coalesce(CAST(date AS VARCHAR), '') AS date, coalesce(category, 'Unknown') AS category,
         coalesce(device, 'Unknown') AS device, coalesce(referrer, 'Unknown') AS referrer,
         coalesce(overall_conversion_rate, 0.0::DOUBLE) AS overall_conversion_rate,
         coalesce(rolling_avg_conversion, 0.0::DOUBLE) AS rolling_avg_conversion,
         round(coalesce(z_score, 0.0::DOUBLE), 4) AS z_score, coalesce(anomaly_flag, 'unknown') AS anomaly_flag
  FROM top
)"""

TOUCHES = ",".join([EVENTS, SESSIONS]) + """,
touch AS (
  SELECT user_id, "timestamp" AS event_time, referrer AS marketing_channel, session_id
  FROM ses WHERE referrer IS NOT NULL AND referrer <> 'direct'
)"""

PAIRS = TOUCHES + "," + ORDERS + """,
pairs AS (
  SELECT o.order_id, o.user_id, o.order_time, t.event_time, t.session_id, t.marketing_channel
  FROM ord o JOIN touch t ON o.user_id = t.user_id
   AND CAST(floor(epoch(t.event_time)) AS BIGINT) <= CAST(floor(epoch(o.order_time)) AS BIGINT)
   AND CAST(floor(epoch(o.order_time)) AS BIGINT) - CAST(floor(epoch(t.event_time)) AS BIGINT) <= 604800
)"""

ATTRIBUTED = PAIRS + """,
best AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, order_id
       ORDER BY event_time DESC, session_id DESC, marketing_channel DESC) AS rn FROM pairs)
  WHERE rn = 1
),
attributed AS (
  SELECT o.order_id, o.user_id, o.order_time, o.total_amount, b.session_id,
         coalesce(b.marketing_channel, 'direct') AS marketing_channel
  FROM ord o LEFT JOIN best b ON o.user_id = b.user_id AND o.order_id = b.order_id
)"""

SUMMARY = """
totals AS (
  SELECT CAST(coalesce(sum(total_views), 0) AS BIGINT) AS total_views,
         CAST(coalesce(sum(total_carts), 0) AS BIGINT) AS total_carts,
         CAST(coalesce(sum(total_purchases), 0) AS BIGINT) AS total_purchases
  FROM funnel
)"""


def timeline(condition: str = "true") -> str:
    return f"""
timeline AS (
  SELECT category, date, views, purchases,
         CASE WHEN views > 0 THEN CAST(purchases AS DOUBLE) / views ELSE 0.0::DOUBLE END AS conversion_rate
  FROM (SELECT category, date, CAST(sum(total_views) AS BIGINT) AS views,
               CAST(sum(total_purchases) AS BIGINT) AS purchases
        FROM funnel WHERE {condition} GROUP BY category, date)
),
rolling AS (
  SELECT *, avg(conversion_rate) OVER (PARTITION BY category ORDER BY date
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS "7d_baseline"
  FROM timeline
)"""


def build(category: str, user_id: str, start: str, end: str, copies: int, top: int) -> dict[str, str]:
    """All oracle queries; the arguments are those of the registered Spark queries."""
    line = timeline(f"category = '{category}'")
    rolled = 'category, date, views, purchases, round(conversion_rate, 10) AS conversion_rate, ' \
             'round("7d_baseline", 10) AS "7d_baseline"'
    profile = """
      count(*) AS row_count, count(DISTINCT user_id) AS users, min({t}) AS first_time, max({t}) AS last_time,
      count(*) FILTER (user_id IS NULL) AS null_users, count(*) FILTER ({t} IS NULL) AS null_times"""
    return {
        "q_table_profile": f"""WITH {CLEAN_EVENTS}, {CLEAN_ORDERS}
            SELECT 'events' AS source, {profile.format(t='"timestamp"')} FROM ev
            UNION ALL SELECT 'orders' AS source, {profile.format(t="order_time")} FROM ord""",
        "q_clean_events": f"WITH {CLEAN_EVENTS} SELECT * FROM ev",
        "q_clean_orders": f"""WITH {CLEAN_ORDERS}
            SELECT order_id, user_id, order_time AS "timestamp", total_amount FROM ord""",
        "q_clean_catalog": f"WITH {CLEAN_CATALOG} SELECT * FROM cat",
        "q_user_timeline": f"WITH {EVENTS} SELECT * FROM ev WHERE user_id = '{user_id}' ORDER BY \"timestamp\"",
        "q_sessionize": f"WITH {EVENTS}, {SESSIONS} SELECT * FROM ses",
        "q_sessionize_smallgap": f"WITH {EVENTS}, {sessions(59)} SELECT * FROM ses",
        "q_sessionize_raw": f"WITH {CLEAN_EVENTS}, {SESSIONS} SELECT * FROM ses",
        "q_sessionize_daygap": f"WITH {EVENTS}, {sessions(86400)} SELECT * FROM ses",
        "q_enrich_events": f"""WITH {EVENTS}, {CATALOG}
            SELECT ev.*, category, brand, price FROM ev LEFT JOIN cat USING (product_id)""",
        "q_missing_category": f"""WITH {CLEAN_EVENTS}, {CLEAN_CATALOG}, {SESSIONS}
            SELECT user_id, session_id, event_type, product_id, category
            FROM ses LEFT JOIN cat USING (product_id) WHERE category IS NULL OR category = 'none'""",
        "q_session_flags": f"WITH {EVENTS}, {CATALOG}, {SESSIONS}, {FLAGS} SELECT * FROM flags",
        "q_funnel_counts": f"WITH {EVENTS}, {CATALOG}, {SESSIONS}, {COUNTS} SELECT * FROM counts",
        "q_funnel_rates": f"WITH {FUNNEL} SELECT * FROM funnel",
        "q_category_funnel": f"""WITH {FUNNEL}
            SELECT category, CAST(sum(total_views) AS BIGINT) AS total_views,
                   CAST(sum(total_carts) AS BIGINT) AS total_carts,
                   CAST(sum(total_purchases) AS BIGINT) AS total_purchases
            FROM funnel GROUP BY category ORDER BY total_views DESC""",
        "q_touchpoints": f"WITH {TOUCHES} SELECT * FROM touch",
        "q_lookback_pairs": f"""WITH {PAIRS}
            SELECT o.order_id, o.user_id, o.order_time, o.total_amount, coalesce(n, 0) AS eligible_touches
            FROM ord o LEFT JOIN (SELECT user_id, order_id, count(*) AS n FROM pairs GROUP BY ALL) p
              ON o.user_id = p.user_id AND o.order_id = p.order_id""",
        "q_last_touch_attribution": f"WITH {ATTRIBUTED} SELECT * FROM attributed",
        "q_channel_revenue": f"""WITH {ATTRIBUTED}
            SELECT marketing_channel,
                   round(CAST(sum(CAST(total_amount AS DECIMAL(28, 6))) AS DOUBLE), 2) AS total_revenue
            FROM attributed GROUP BY marketing_channel ORDER BY total_revenue DESC""",
        "q_topn_per_group": f"""WITH {TOUCHES}
            SELECT * FROM (
              SELECT *, CAST(row_number() OVER (PARTITION BY user_id
                ORDER BY event_time DESC, session_id DESC, marketing_channel DESC) AS INTEGER) AS rank
              FROM touch)
            WHERE rank <= {top}""",
        "q_daily_category": f"WITH {FUNNEL}, {DAILY_ONLY} SELECT * FROM daily",
        "q_trailing_baseline": f"WITH {FUNNEL}, {BASELINE_ONLY} SELECT * FROM base",
        "q_anomaly_pct": f"WITH {FUNNEL}, {ANOMALY_ONLY} SELECT * FROM anom",
        "q_anomaly_explain": f"WITH {FUNNEL}, {ANOMALY_ONLY} {EXPLAINED}",
        "q_category_timeline": f"""WITH {FUNNEL}, {line}
            SELECT category, date, views, purchases, round(conversion_rate, 10) AS conversion_rate
            FROM timeline""",
        "q_rolling_7row": f"WITH {FUNNEL}, {timeline()} SELECT {rolled} FROM rolling",
        "q_category_date_slice": f"""WITH {FUNNEL}, {line}
            SELECT {rolled} FROM rolling WHERE date BETWEEN DATE '{start}' AND DATE '{end}'""",
        "q_anomaly_overlay": f"""WITH {FUNNEL}, {ANOMALY_ONLY}, {line}
            SELECT a.*, {rolled.replace('category, date, ', '')}
            FROM anom a JOIN rolling r ON a.date = r.date WHERE a.category = '{category}'""",
        "q_anomaly_overlay_range": f"""WITH {FUNNEL}, {ANOMALY_ONLY}, {line}
            SELECT a.*, {rolled.replace('category, date, ', '')}
            FROM anom a JOIN rolling r ON a.date = r.date
            WHERE a.category = '{category}' AND a.date BETWEEN DATE '{start}' AND DATE '{end}'""",
        "q_anomaly_metrics": f"WITH {ZSCORE} SELECT * FROM scored",
        "q_anomaly_zscore": f"WITH {ZSCORE} SELECT * FROM zanom",
        "q_anomaly_funnel_by_category": f"""WITH {ZSCORE}
            SELECT category, CAST(sum(total_views) AS BIGINT) AS total_views,
                   CAST(sum(total_carts) AS BIGINT) AS total_carts,
                   CAST(sum(total_purchases) AS BIGINT) AS total_purchases
            FROM zanom GROUP BY category ORDER BY total_views DESC""",
        "q_anomaly_points": f"WITH {ZSCORE} SELECT date, overall_conversion_rate FROM zanom",
        "q_topk_anomalies": f"WITH {TOP_ANOMALIES} SELECT * FROM top",
        "q_anomaly_export": f"WITH {TOP_ANOMALIES} SELECT * FROM export",
        "q_zscore_series": f"""WITH {TOP_ANOMALIES}
            SELECT date, z_score AS value FROM export WHERE date <> '' ORDER BY date""",
        "q_summary": f"WITH {FUNNEL}, {SUMMARY} SELECT *, {RATES} FROM totals",
        "q_funnel_steps": f"""WITH {FUNNEL}, {SUMMARY}
            SELECT 'Views' AS step, total_views AS count FROM totals
            UNION ALL SELECT 'Carts', total_carts FROM totals
            UNION ALL SELECT 'Purchases', total_purchases FROM totals""",
        "q_events_by_user_desc": f"""WITH {EVENTS}
            SELECT * FROM ev ORDER BY user_id DESC, "timestamp", event_type, product_id, device,
              referrer NULLS FIRST LIMIT 20""",
        "q_sessions_by_user_time": f"""WITH {EVENTS}, {SESSIONS}
            SELECT * FROM ses ORDER BY user_id, "timestamp", event_type, product_id, device,
              referrer NULLS FIRST, session_id LIMIT 200""",
        "q_sorted_views": f"""WITH {FUNNEL}
            SELECT * FROM funnel ORDER BY category DESC NULLS LAST, device, referrer NULLS FIRST, date,
              total_views LIMIT 20""",
        "q_scale_up": f"""WITH {RAW_EVENTS}
            SELECT customer_id || '_' || CAST(copy AS VARCHAR) AS customer_id, "timestamp", event_type,
                   product_id, device_type, traffic_source
            FROM raw_ev, generate_series(1, {copies}) AS g(copy)""",
        "q_scale_up_orders": f"""WITH {CLEAN_ORDERS}
            SELECT transaction_id, customer_id || '_' || CAST(copy AS VARCHAR) AS customer_id, "timestamp", gross_revenue
            FROM raw_ord, generate_series(1, {copies}) AS g(copy)""",
        "q_session_rollup": f"""WITH {EVENTS}, {SESSIONS}
            SELECT user_id, date_trunc('second', min("timestamp")) AS session_start,
                   date_trunc('second', max("timestamp")) AS session_end, count(*) AS events
            FROM ses GROUP BY user_id, session_id""",
        "q_end_to_end_zscore": f"WITH {RAW_FUNNEL}, {SCORES} SELECT * FROM scored",
        "q_end_to_end": f"WITH {RAW_FUNNEL}, {ANOMALY_ONLY} {EXPLAINED}",
        "q_end_to_end_attribution": f"""WITH {CLEAN_EVENTS}, {SESSIONS}, {CLEAN_ORDERS},
            touch AS (SELECT user_id, "timestamp" AS event_time, referrer AS marketing_channel, session_id
                      FROM ses WHERE referrer IS NOT NULL AND referrer <> 'direct'),
            pairs AS (
              SELECT o.order_id, o.user_id, t.event_time, t.session_id, t.marketing_channel
              FROM ord o JOIN touch t ON o.user_id = t.user_id
               AND epoch(t.event_time) <= epoch(o.order_time)
               AND epoch(o.order_time) - epoch(t.event_time) <= 604800),
            best AS (
              SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, order_id
                   ORDER BY event_time DESC, session_id DESC, marketing_channel DESC) AS rn FROM pairs)
              WHERE rn = 1)
            SELECT o.order_id, o.user_id, o.order_time, o.total_amount, b.session_id,
                   coalesce(b.marketing_channel, 'direct') AS marketing_channel
            FROM ord o LEFT JOIN best b ON o.user_id = b.user_id AND o.order_id = b.order_id""",
    }
